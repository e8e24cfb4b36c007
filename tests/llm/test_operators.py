"""The operators against brute force, on small fixtures and odd rows."""
import hashlib
import math
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from fieldops.llm import (common, hash_forest, html_mincut, kneser_ney, mixing, packing, quality_cnn, quality_rules, repeats,
                          simhash_golay, substring_dedup, suffix_dedup)
from fieldops.llm.queries import tokenizer_path

SF = "/root/testdata/sf0.001"


def words(text):
    return (text or "").encode().split()


def docs_of(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


def key_of(rows):
    """Documents as the operators tell them apart: (id, text), in their order."""
    return sorted({(-1 if r.doc_id is None else r.doc_id, r.text or "") for r in rows})


# ---------------------------------------------------------------- 10 and 6

def brute_substrings(rows, window):
    first, out = {}, {}
    docs = [(i, t, words(t)) for i, t in key_of(rows)]
    order = defaultdict(list)
    for d in docs:
        order[d[0]].append(d)
    for n, (_, _, ws) in enumerate(docs):
        for s in range(len(ws) - window + 1):
            first.setdefault(tuple(ws[s:s + window]), (n, s))
    for n, (i, t, ws) in enumerate(docs):
        gone = [False] * len(ws)
        for s in range(len(ws) - window + 1):
            if first[tuple(ws[s:s + window])] != (n, s):
                gone[s:s + window] = [True] * window
        left = b" ".join(w for w, g in zip(ws, gone) if not g)
        out[i, t] = (len(ws), sum(gone), hashlib.sha256(left).hexdigest())
    return out


def brute_bytes(rows, size):
    seen, out = Counter(), {}
    docs = key_of(rows)
    for _, t in docs:
        b = t.encode()
        seen.update(b[s:s + size] for s in range(len(b) - size + 1))
    for i, t in docs:
        b = t.encode()
        gone = np.zeros(len(b) + 1, np.int64)
        for s in range(len(b) - size + 1):
            if seen[b[s:s + size]] > 1:
                gone[s] += 1
                gone[s + size] -= 1
        mask = np.cumsum(gone[:-1]) > 0
        left = bytes(np.frombuffer(b, np.uint8)[~mask])
        spans = int((mask[1:] & ~mask[:-1]).sum() + mask[0]) if len(mask) else 0
        out[i, t] = (len(b), int(mask.sum()), spans, hashlib.sha256(left).hexdigest())
    return out


def check_removed(got, rows, expected, columns):
    assert len(got) == len(rows)
    unique = Counter(r.doc_id for r in rows if r.doc_id is not None)
    for r in got:
        if r.doc_id is not None and unique[r.doc_id] == 1:
            want = next(v for (i, _), v in expected.items() if i == r.doc_id)
            assert tuple(r[c] for c in columns) == want, r.doc_id


@pytest.mark.parametrize("group", [4096, 2])
def test_substrings(spark, monkeypatch, group):
    monkeypatch.setattr(repeats, "GROUP", group)  # 2: groups of a gram are dealt over several tasks
    docs = docs_of(spark)
    rows = docs.collect()
    got = substring_dedup.remove_repeats(docs).collect()
    check_removed(got, rows, brute_substrings(rows, 20), ("n_words", "n_removed", "kept_sha256"))
    assert {"lang", "source", "n_chars"} <= set(got[0].asDict())


@pytest.mark.parametrize("group", [4096, 2])
def test_suffixes(spark, monkeypatch, group):
    monkeypatch.setattr(repeats, "GROUP", group)
    docs = docs_of(spark)
    rows = docs.collect()
    got = suffix_dedup.remove_repeats(docs, kept=None).collect()
    check_removed(got, rows, brute_bytes(rows, 400), ("n_bytes", "n_removed", "n_spans", "kept_sha256"))


def test_suffix_levels(spark):
    index = suffix_dedup.SuffixIndex(spark, 40)
    docs = common.with_key(docs_of(spark).select("doc_id", "text"))
    for j in range(7):
        index.add(docs.where(F.col("did") % 7 == j).select("did", "tk", "text"))
        index._merge_equal()
        sizes = [n for n, _ in index.levels]
        assert sum(sizes) == j + 1 and sizes == sorted(set(sizes), reverse=True)
    index.drop()


def test_repeats_of_odd_rows(spark, odd, none):
    rows = odd.collect()
    for fn, brute, columns, size in (
            (substring_dedup.remove_repeats, brute_substrings, ("n_words", "n_removed", "kept_sha256"), 20),
            (suffix_dedup.remove_repeats, brute_bytes, ("n_bytes", "n_removed", "n_spans", "kept_sha256"), 400)):
        got = fn(odd).collect()
        check_removed(got, rows, brute(rows, size), columns)
        same = [r for r in got if r.doc_id == 1 and r.text and r.text.startswith("word0 ")]
        assert len(same) == 2 and len({r.kept_sha256 for r in same}) == 1
        assert fn(none).count() == 0


@pytest.mark.parametrize("window", [1, 2, 3, 5, 8, 11])
def test_doubling_keeps_every_repeat(spark, monkeypatch, window):
    """Few words, so that grams repeat, doubled grams repeat less and windows less still; on both sides of the gram, at
    the ends of documents and of pieces of a document."""
    monkeypatch.setattr(repeats, "_PIECE", 64)
    rng = np.random.default_rng(window)
    rows = [(int(i), " ".join(rng.choice(["a", "b", "c", "dd"], rng.integers(0, 130)))) for i in range(25)]
    rows += [(100, rows[3][1] + " a b " + rows[4][1]), (101, "q q q " + rows[3][1])]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = substring_dedup.remove_repeats(docs, window).collect()
    check_removed(got, docs.collect(), brute_substrings(docs.collect(), window), ("n_words", "n_removed", "kept_sha256"))


def test_doubling_goes_on_until_nothing_repeats(spark):
    text = " ".join(f"a{i}" for i in range(100))
    docs = spark.createDataFrame([(1, text), (2, "x " + text), (3, "lone words " * 3)], "doc_id long, text string")
    found = substring_dedup.longer_repeats(docs).groupBy("length").agg(F.sum(F.col("s1") - F.col("s0") + 1)).collect()
    assert {r[0]: r[1] for r in found} == {20: 81, 40: 61, 80: 21}


# ---------------------------------------------------------------- 5

def brute_fingerprint(text, n=3):
    ws = words(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not ws:
        return 0
    hs = [xxhash.xxh64_intdigest(b" ".join(ws[i:i + n]), 42) for i in range(max(1, len(ws) - n + 1))]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs))


def brute_components(rows):
    fps = [brute_fingerprint(r.text) for r in rows]
    group = list(range(len(rows)))

    def top(i):
        while group[i] != i:
            i = group[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if bin(fps[i] ^ fps[j]).count("1") <= 3:
                group[top(i)] = top(j)
    least = {}
    for i, r in enumerate(rows):
        if r.doc_id is not None:
            least[top(i)] = min(least.get(top(i), r.doc_id), r.doc_id)
    return sorted((str(r.doc_id), fps[i], str(least.get(top(i)))) for i, r in enumerate(rows))


def test_simhash(spark, odd, none):
    for df in (docs_of(spark), odd):
        rows = df.collect()
        got = simhash_golay.near_duplicates(df).collect()
        assert sorted((str(r.doc_id), r.fp % (1 << 64), str(r.component_id)) for r in got) == brute_components(rows)
    assert simhash_golay.near_duplicates(none).count() == 0


def test_golay_links_are_all_links(spark):
    rng = np.random.default_rng(3)
    base = rng.integers(0, 1 << 63, 40, dtype=np.int64)
    near = [int(b) ^ sum(1 << int(k) for k in rng.choice(63, rng.integers(0, 6), replace=False)) for b in base for _ in range(8)]
    fps = sorted({*map(int, base), *near})
    df = spark.createDataFrame([(x,) for x in fps], "fp long")
    got = {(r.a, r.b) for r in simhash_golay.links(df).collect()}
    assert got == {(a, b) for i, a in enumerate(fps) for b in fps[i + 1:] if bin(a ^ b).count("1") <= 3}
    words_ = rng.integers(0, 1 << 23, 2000)
    assert simhash_golay.nearby(words_, 23)[1].sum(axis=1).max() == 6


def test_simhash_links_are_not_broadcast(spark):
    """Keys are many a fingerprint: seen as small as the fingerprints, they would go through the driver."""
    df = common.staged(spark.range(1000).select(F.xxhash64("id").alias("fp"), F.col("id").alias("first_id")), "fps")
    plan = simhash_golay.links(df)._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "Broadcast" not in plan


def test_components_of_a_chain(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(200)] + [(900, 901)], "a long, b long")
    got = {r.node: r.root for r in simhash_golay.components(edges).collect()}
    assert got == {**{i: 0 for i in range(1, 201)}, 901: 900}


# ---------------------------------------------------------------- 1

def test_mix(spark, odd, none):
    for df in (docs_of(spark), odd):
        rows = mixing.mix(df).collect()
        assert len(rows) == df.count()
        total = sum(r["size"] for r in rows)
        assert all(0 <= r.taken <= 2 * r["size"] for r in rows)
        assert abs(sum(r.taken for r in rows) - 1.5 * total) <= 25
        assert sorted(rows, key=str) == sorted(mixing.mix(df).collect(), key=str)
    assert mixing.mix(none).count() == 0 and mixing.mixed_documents(none).count() == 0
    plain = odd.select("doc_id", "text", "lang", "source", "n_chars")
    mixed = mixing.mixed_documents(plain)
    assert mixed.columns == plain.columns
    taken = mixed.agg(F.sum(mixing.size_of(F.col("text")))).first()[0]
    assert taken == sum(r.taken for r in mixing.mix(plain).collect())


def test_mix_in_order(spark, odd):
    """Every stretch of the mix, read by its slots, holds each source in nearly its share of words."""
    from fieldops.llm.queries import op1_mixing
    sf = "/root/testdata/sf0.01"
    docs = common.table(spark, sf, "documents")
    mixed = mixing.mixed_documents(docs, slot="at").select("doc_id", "source", "at", mixing.size_of(F.col("text")).alias("n")).collect()
    first = {r.doc_id: r.first_slot for r in op1_mixing(spark, sf).collect()}
    least = {}
    for r in mixed:
        least[r.doc_id] = min(r["at"], least.get(r.doc_id, r["at"]))
    assert least == {i: s for i, s in first.items() if s is not None}
    total, end = sum(r.n for r in mixed), max(r["at"] for r in mixed) + 1
    share = Counter()
    for r in mixed:
        share[r.source] += r.n / total
    for k in range(6):
        part = Counter()
        for r in mixed:
            if k * end // 6 <= r["at"] < (k + 1) * end // 6:
                part[r.source] += r.n
        off = {s: part[s] / sum(part.values()) - share[s] for s in share}
        assert max(map(abs, off.values())) < 0.05, (k, off)
    few = mixing.mixed_documents(odd.select("doc_id", "text", "lang", "source", "n_chars"), block=4, slot="at")
    assert few.where("at is null").isEmpty() and few.columns[-1] == "at"


def test_targets_by_hand(spark):
    sizes = spark.createDataFrame([("a", 10), ("b", 100), ("c", 100), (None, 90)], "source string, size long")
    got = {r.source: r.target for r in mixing.source_targets(sizes).collect()}
    # weights 5, 2, 1, 5 of 450: a stops at 20; the rest 430 by 2, 1, 5: null stops at 180; 250 by 2, 1
    assert got == pytest.approx({"a": 20, "b": 500 / 3, "c": 250 / 3, None: 180})


def test_schedule_is_even(spark):
    targets = spark.createDataFrame([("a", 9000, 1.0, 9000.0), ("b", 5000, 1.0, 3000.0)],
                                    "source string, source_size long, weight double, target double")
    slots = [r.source for r in mixing.schedule(targets, 10).orderBy("slot").collect()]
    assert len(slots) == 1200 and slots.count("a") == 900
    share = [slots[i:i + 100].count("a") for i in range(0, 1100, 100)]
    assert min(share) >= 72 and max(share) <= 78


# ---------------------------------------------------------------- 8

def test_packing(spark, odd, none):
    from tokenizers import Tokenizer
    tok = Tokenizer.from_file(tokenizer_path())
    for df in (docs_of(spark), odd):
        rows = df.collect()
        got = packing.pack(df, tokenizer_path()).collect()
        want = Counter()
        for r in rows:
            ids = tok.encode(r.text or "", add_special_tokens=False).ids + [2]
            cut = len(ids) % 1024 or 1024
            edges = [0, *range(cut, len(ids) + 1, 1024)]
            for k in range(len(edges) - 1):
                raw = np.array(ids[edges[k]:edges[k + 1]], "<u4").tobytes()
                want[str(r.doc_id), k, edges[k], edges[k + 1] - edges[k], zlib.crc32(raw)] += 1
        assert Counter((str(r.doc_id), r.piece, r.start, r.length, r.ids_crc32) for r in got) == want
        bins = defaultdict(list)
        for r in got:
            bins[r.sequence_id].append((r.offset, r.length))
        for items in bins.values():
            at = 0
            for offset, length in sorted(items):
                assert offset == at
                at += length
            assert at <= 1024
        assert len(bins) <= math.ceil(sum(r.length for r in got) / 1024) * 1.03 + 1
    assert packing.pack(none, tokenizer_path()).count() == 0


def test_local_search_beats_best_fit():
    rng = np.random.default_rng(1)
    lengths = rng.integers(200, 700, 3000)
    start = packing._Bins(1024)
    start.start(lengths)
    where, offset = packing.pack_lengths(lengths)
    assert where.max() + 1 <= len(start.items)
    assert np.bincount(where, lengths).max() <= 1024


def test_local_search_has_no_step_left():
    rng = np.random.default_rng(3)
    for low, high, n in ((5, 60, 400), (340, 360, 300), (1, 40, 500)):
        bins = packing._Bins(1024)
        bins.start(rng.integers(low, high, n))
        bins.search()
        own = [sorted(x.values()) for x in bins.items]
        for a, fill in enumerate(bins.fill):
            gap = 1024 - fill
            for b, less in enumerate(bins.fill):
                if a == b or not gap or not 0 < less <= fill:
                    continue
                one = set(own[b])
                two = {x + y for i, x in enumerate(own[b]) for y in own[b][i + 1:]}
                gains = {m for m in one} | {m - x for x in set(own[a]) for m in one | two}
                assert not any(0 < gain <= gap for gain in gains)


# ---------------------------------------------------------------- 9

def test_kneser_ney(spark, odd, none):
    for df in (docs_of(spark), odd):
        rows = df.collect()
        docs = [(r.doc_id, [*words(re.sub("[A-Z]", lambda m: m[0].lower(), r.text or "")), "END"]) for r in rows]
        out = lambda i: zlib.crc32(("" if i is None else str(i)).encode()) % 7 == 2
        train = [w for i, w in docs if not out(i)]
        c = Counter(x for w in train for x in w)
        pairs = Counter(p for w in train for p in zip(["START", *w[:-1]], w))
        n, v = sum(c.values()), len(c)
        d2 = kneser_ney._discounts(np.array([sum(x == k for x in pairs.values()) for k in (1, 2, 3, 4)]))
        cont = Counter(w for _, w in pairs)
        d1 = kneser_ney._discounts(np.array([sum(x == k for x in cont.values()) for k in (1, 2, 3, 4)]))
        rest = sum(d1[min(x, 3)] for x in cont.values()) / len(pairs)
        total, more = Counter(), defaultdict(float)
        for (h, _), k in pairs.items():
            total[h] += k
            more[h] += d2[min(k, 3)]

        def lower(w):
            return (cont[w] - d1[min(cont[w], 3)]) / len(pairs) + rest / (v + 1)

        def prob(h, w):
            if not total[h]:
                return lower(w)
            k = pairs.get((h, w), 0)
            return (k - d2[min(k, 3)]) / total[h] + more[h] / total[h] * lower(w)

        assert sum(prob("START", w) for w in [*c, "?"]) == pytest.approx(1)
        want = sorted((str(i), out(i), len(w), sum(x in c for x in w), n, round(sum(math.log10((c[x] + 1) / (n + v + 1)) for x in w), 6),
                       round(sum(math.log10(prob(h, x)) for h, x in zip(["START", *w[:-1]], w)), 6)) for i, w in docs)
        got = sorted((str(r.doc_id), r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6), round(r.score, 6))
                     for r in kneser_ney.score_documents(df).collect())
        assert got == want
    assert kneser_ney.score_documents(none).count() == 0


def test_counts_beyond_four_bytes_are_sent_whole():
    keys = np.array([3, 9, 1 << 63], np.uint64)
    for counts in (np.array([1, (1 << 32) - 1, 2]), np.array([1, 1 << 32, (1 << 40) + 5]),
                   np.array([[1 << 32, 0, 1, 7], [2, 3, 4, 5], [6, 7, 8, 1 << 50]])):
        back, same = kneser_ney._unblob(kneser_ney._blob(keys, counts), 1 if counts.ndim == 1 else 4)
        assert back.tolist() == keys.tolist() and same.tolist() == counts.tolist()


# ---------------------------------------------------------------- 2 and 4

def test_classifiers_on_held_out_rows(spark):
    sf = "/root/testdata/sf0.01"
    docs, labels = (spark.read.parquet(f"{sf}/{t}.parquet") for t in ("documents", "labels"))
    mark = {r.doc_id: r.quality for r in labels.collect()}
    got = quality_cnn.score(docs, quality_cnn.learn(docs, labels)).collect()
    assert len(got) == docs.count() and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.7) for r in got)
    held = [r for r in got if r.held_out and r.doc_id in mark]
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in got)
    assert np.mean([r.predicted == mark[r.doc_id] for r in held]) > 0.85
    odd_ids = labels.where("doc_id % 2 = 1")
    rules = quality_rules.judge(docs, quality_rules.learn(docs, odd_ids)).collect()
    unseen = [r for r in rules if r.doc_id in mark and r.doc_id % 2 == 0]
    assert np.mean([(r.probability >= 0.5) == mark[r.doc_id] for r in unseen]) > 0.9


def test_rule_counts(spark, odd, none):
    labels = spark.createDataFrame([(1, 1), (5, 0), (None, 1), (6, None)], "doc_id long, quality int")
    for df in (docs_of(spark), odd):
        model = quality_rules.learn(df, labels)
        for r in quality_rules.judge(df, model).collect():
            text = r.text or ""
            ws = re.findall(r"[^\x20\x09-\x0D]+", text)
            grams = Counter(zip(ws, ws[1:], ws[2:]))
            inside = {k for i in range(len(ws) - 2) if grams[tuple(ws[i:i + 3])] > 1 for k in (i, i + 1, i + 2)}
            lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
            want = (len(ws), sum(map(len, ws)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(inside))
            assert tuple(r[c] for c in quality_rules.COUNTS) == want
            failed = len(ws) < 50 or 100 * len(inside) > 50 * len(ws)
            assert r.base_failed == failed and r.kept == (not failed and r.probability >= 0.5)
    none_labels = labels.where("false")
    assert quality_rules.judge(none, quality_rules.learn(none, none_labels)).count() == 0


def test_repeated_lines_of_texts_that_end_with_a_break():
    texts = ["foo\nfoo\n", "", "x", "foo\n", "\n", "a\na\n\n", "a\n \na\n", "", "b\nb", "\n\nc\nc\n"]
    want = {t: len(ls) - len(set(ls)) for t in texts for ls in [[x for x in t.split("\n") if x.strip()]]}
    for turn in range(len(texts)):  # each in the first, a middle and the last place
        for own in (texts[turn:] + texts[:turn], texts[turn:turn + 1]):
            buf, offs = common.joined([t.encode() for t in own])
            counts, _ = quality_rules._analyse(buf, offs)
            assert counts["n_dup_lines"].tolist() == [want[t] for t in own]


def test_classifier_on_odd_rows(spark, odd, none):
    labels = spark.createDataFrame([(1, 1), (5, 0), (None, 1), (6, None)], "doc_id long, quality int")
    got = quality_cnn.score(odd, quality_cnn.learn(odd, labels)).collect()
    assert len(got) == odd.count() and all(0 <= r.score <= 1 for r in got)
    assert quality_cnn.score(none, quality_cnn.learn(none, labels.where("false"))).count() == 0


def _junk_texts(rng, n):
    """Texts of 3,000 to 4,000 bytes; every other one holds 64 bytes of junk between eight even spots."""
    vocabulary = ["".join(chr(c) for c in rng.integers(97, 123, int(rng.integers(2, 9)))) for _ in range(200)]
    out = []
    for i in range(n):
        size = int(rng.integers(3000, 4000))
        text = bytearray(" ".join(rng.choice(vocabulary, size // 2)).encode()[:size])
        if i % 2:
            spots, k = np.linspace(0, size - 256, 8).astype(int), int(rng.integers(0, 7))
            at = (spots[k] + 256 + spots[k + 1] - 64) // 2
            text[at:at + 64] = bytes(rng.choice(list(b"#@$%{}"), 64).tolist())
        out.append(text.decode())
    return out, [1 - i % 2 for i in range(n)]


def test_training_sees_whole_texts():
    rng = np.random.default_rng(11)
    model = quality_cnn.load(quality_cnn.train(*_junk_texts(rng, 400), 0.5))
    texts, marks = _junk_texts(rng, 200)
    right = (quality_cnn.probability(model, *common.joined([t.encode() for t in texts])) >= 0.5) == np.array(marks)
    assert right[::2].mean() > 0.9 and right[1::2].mean() > 0.9


def test_gradient_over_whole_texts(monkeypatch):
    rng = np.random.default_rng(0)
    model = quality_cnn.load(quality_cnn.train([], [], 0.5))
    model["out"] = rng.normal(size=2 * quality_cnn.FILTERS)
    model["bias"] += np.float32(0.1)  # bytes of zero answer 0 without it, where there is no slope
    texts = [b"some text!! of bytes " * 30, b"", b"other ### words " * 50 + b"end", b"x" * 56]
    y = np.array([1.0, 0.0, 0.0, 1.0])
    buf, offs = common.joined(texts)

    def loss(m):
        z = quality_cnn.features(m, buf, offs).astype(np.float64) @ m["out"] + m["intercept"]
        return np.mean(np.log1p(np.exp(-z * (2 * y - 1))))

    grads = quality_cnn._text_gradients(model, texts, y)
    monkeypatch.setattr(quality_cnn, "SLICE", 3)
    again = quality_cnn._text_gradients(model, texts, y)
    assert all(grads[k] == pytest.approx(again[k], abs=1e-6) for k in grads)
    for name, at in (("filters", (3, 5)), ("embedding", (ord("t"), 1)), ("bias", (5,)), ("intercept", (0,)), ("out", (20,))):
        up, down = ({k: v.copy() for k, v in model.items()} for _ in range(2))
        up[name][at] += 1e-3
        down[name][at] -= 1e-3
        assert grads[name][at] == pytest.approx((loss(up) - loss(down)) / 2e-3, abs=5e-3)


def test_long_texts_held_out(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.1/{t}.parquet") for t in ("documents", "labels"))
    got = quality_cnn.score(docs, quality_cnn.learn(docs, labels)).where("held_out and length(text) > 2048").join(
        labels.where("quality is not null"), "doc_id").select("score", "quality").collect()
    for mark in (0, 1):
        own = [(r.score >= 0.5) == mark for r in got if r.quality == mark]
        assert len(own) > 30 and np.mean(own) > 0.75


def test_network_gradient():
    rng = np.random.default_rng(0)
    model = quality_cnn.load(quality_cnn.train([], [], 0.5))
    model["out"] = rng.normal(size=2 * quality_cnn.FILTERS)
    model = {k: v.astype(np.float64) for k, v in model.items()}
    data = quality_cnn._training_chunks(["some text!! of bytes " * 30, "other ### words " * 50])
    y = np.array([1.0, 0.0])
    grads = quality_cnn._gradients(model, data, y)

    def loss(m):
        emb = m["embedding"][data]
        flat = emb.reshape(-1, data.shape[2] * quality_cnn.DIM)
        k = quality_cnn.KERNEL * quality_cnn.DIM
        n = (data.shape[2] - quality_cnn.KERNEL) // quality_cnn.STRIDE
        x = np.lib.stride_tricks.sliding_window_view(flat, k, axis=1)[:, :: quality_cnn.STRIDE * quality_cnn.DIM][:, :n]
        best = np.maximum((x @ m["filters"] + m["bias"]).max(axis=1), 0).reshape(2, -1, quality_cnn.FILTERS)
        z = np.hstack([best.mean(axis=1), best.max(axis=1)]) @ m["out"] + m["intercept"]
        return np.mean(np.log1p(np.exp(-z * (2 * y - 1))))

    for name, at in (("filters", (3, 5)), ("embedding", (ord("t"), 1)), ("bias", (5,)), ("intercept", (0,))):
        up, down = ({k: v.copy() for k, v in model.items()} for _ in range(2))
        up[name][at] += 1e-6
        down[name][at] -= 1e-6
        assert grads[name][at] == pytest.approx((loss(up) - loss(down)) / 2e-6, abs=1e-3)


# ---------------------------------------------------------------- 3

def test_forest(spark):
    rng = np.random.default_rng(2)
    x = rng.normal(size=(1500, 16)).astype(np.float32)
    x[200:260] = x[7]  # a group of equal vectors
    rows = [(int(i), x[i].tolist()) for i in range(len(x))]
    bad = [(2000, None), (2050, [0.0] * 16), (2100, [float("nan")] * 16), (2150, []), (2200, [1.0, None] * 8),
           (None, x[3].tolist()), (3000, [1.0, 2.0]), (3050, [2.0, 1.0]), (50, x[50].tolist()), (2250, [float("inf")] * 16)]
    df = spark.createDataFrame(rows + bad, "vec_id long, embedding array<float>")
    got = defaultdict(list)
    for r in hash_forest.search(df, df.where("vec_id % 50 = 0")).collect():
        got[r.query_id].append((r["rank"], r.vec_id, r.score))
    unit = x.astype(float) / np.linalg.norm(x.astype(float), axis=1, keepdims=True)
    assert sorted(got) == [*range(0, 1500, 50), 3000, 3050]
    hits = 0
    for q in range(0, 1500, 50):
        s = unit @ unit[q]
        s[q] = -2
        want = np.lexsort((np.arange(len(s)), -s.round(12)))[:5]
        mine = sorted(got[q])
        assert [k for k, _, _ in mine] == [1, 2, 3, 4, 5] and q not in [v for _, v, _ in mine]
        assert all(s[v] == pytest.approx(c, abs=1e-12) for _, v, c in mine)
        hits += len({*want.tolist()} & {v for _, v, _ in mine})
    assert hits / 150 >= 0.9
    assert [v for _, v, _ in sorted(got[250])] == [7, 200, 201, 202, 203]
    assert [v for _, v, _ in got[3000]] == [3050]
    assert hash_forest.search(df.where("false"), df.where("false")).count() == 0


def test_forest_deals_out_full_cells(spark, monkeypatch):
    monkeypatch.setattr(hash_forest, "CELL_ROWS", 40)
    df = spark.read.parquet(f"{SF}/embeddings.parquet")
    got = hash_forest.search(df, df.where("vec_id % 50 = 0")).collect()
    monkeypatch.undo()
    assert sorted(got) == sorted(hash_forest.search(df, df.where("vec_id % 50 = 0")).collect())


def test_forest_ranks_a_share_of_all_vectors(spark):
    rng = np.random.default_rng(4)
    x = rng.normal(size=(6000, 64)).astype(np.float32)
    df = spark.createDataFrame([(i, v) for i, v in enumerate(x.tolist())], "vec_id long, embedding array<float>")
    got = defaultdict(set)
    for r in hash_forest.search(df, df.where("vec_id % 60 = 0"), candidates=16).collect():
        got[r.query_id].add(r.vec_id)
    unit = x.astype(float) / np.linalg.norm(x.astype(float), axis=1, keepdims=True)
    hits = sum(len(got[q] & set(np.argsort(-(unit @ unit[q]))[1:6].tolist())) for q in range(0, 6000, 60))
    assert hits / 500 >= 0.9


def test_forest_ascends_beyond_its_cells(spark, monkeypatch):
    rng = np.random.default_rng(6)
    x = rng.normal(size=(3, 24))[rng.integers(0, 3, 2000)] + 0.05 * rng.normal(size=(2000, 24))  # three clusters
    x[::200] = rng.normal(size=(10, 24))  # and ten vectors outside of them
    rows = [(i, v) for i, v in enumerate(x.astype(np.float32).tolist())]
    rare = rng.normal(size=(9, 3)).astype(np.float32)  # a length of which there are few
    df = spark.createDataFrame(rows + [(10_000 + i, v) for i, v in enumerate(rare.tolist())], "vec_id long, embedding array<float>")
    for cell_rows in (hash_forest.CELL_ROWS, 50):
        monkeypatch.setattr(hash_forest, "CELL_ROWS", cell_rows)
        got = defaultdict(list)
        for r in hash_forest.search(df, df.where("vec_id % 200 = 0 or vec_id >= 10000"), k=30, candidates=60).collect():
            got[r.query_id].append((r["rank"], r.vec_id, r.score))
        assert sorted(got) == [*range(0, 2000, 200), *range(10_000, 10_009)]
        for q, mine in got.items():
            part, first = (rare, 10_000) if q >= 10_000 else (x.astype(np.float32), 0)
            unit = part.astype(float) / np.linalg.norm(part.astype(float), axis=1, keepdims=True)
            s = unit @ unit[q - first]
            assert sorted(k for k, _, _ in mine) == [*range(1, min(30, len(part) - 1) + 1)], q
            assert all(s[v - first] == pytest.approx(c, abs=1e-9) for _, v, c in mine)
            assert q not in [v for _, v, _ in mine]


def test_forest_counts_strings_with_one_prefix_once():
    reps, code = np.array([5, 5, 5, 6]), np.array([0, 1, 1 << 27, 0])
    assert hash_forest._once(reps, code, 0).tolist() == [0, 3]
    assert hash_forest._once(reps, code, 1).tolist() == [0, 2, 3]
    assert hash_forest._once(reps, code, hash_forest.DEPTH).tolist() == [0, 1, 2, 3]


# ---------------------------------------------------------------- 7

PAGE = """<html><head><title>T</title><style>p{}</style></head><body><header class="site-header">Site name</header>
<nav><ul><li><a href="/">Home</a><li><a href="/x">News</a></ul></nav><div class="cookie-notice">We use cookies, accept?</div>
<article><header><h1>Head &amp; line</h1></header><p>First   paragraph of\n the article, with <b>bold</b> and <a href="q">a link</a>.
<p>Second one.<br>Still second &lt;3.<aside class="related">Read more: other things</aside><p>Third &#233;nd</article>
<div id="comments"><p>Great post, says a reader with many words in the comment box.</p></div>
<form>Your mail <input> <button>Go</button></form><script>var a = "<p>no</p>";</script><footer>&copy; all rights</footer>"""


def test_main_text(spark):
    want = ("Head & line\nFirst paragraph of the article, with bold and a link .\n".replace("link .", "link.")
            + "Second one. Still second <3.\nThird énd")
    assert html_mincut.main_text(PAGE) == want
    rows = [(1, "u", PAGE), (1, "u", PAGE), (2, None, None), (None, "u", ""), (3, "u", "<p>" * 50), (4, "u", "</div></p>plain & simple"),
            (5, "u", "<article>" + "<p>word and more words here.</p>" * 3000)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("n_chars", F.lit(0)).withColumn("Text", F.lit(0))
    got = html_mincut.extract(df).collect()
    assert len(got) == 7 and all(r.n_chars == len(r.text) for r in got)
    assert {r.page_id: r.text for r in got}[1] == want
    assert {r.page_id: r.text for r in got}[5].count("\n") == 2999
    assert html_mincut.extract(df.where("false")).count() == 0


def test_pages_that_leave_the_head_open():
    want = html_mincut.main_text(PAGE)
    assert want.startswith("Head & line")
    for page in (PAGE.replace("</head>", ""), PAGE.replace("<body>", ""), PAGE.replace("</head><body>", ""),
                 PAGE.replace("<head>", "<head><head>").replace("</head>", ""),
                 PAGE.replace("</head>", "<noscript><div>no script</div></noscript><meta name=a><script>1</script>")):
        assert html_mincut.main_text(page) == want
    line = "A line of plain text that follows an open head, with quite some words in it."
    assert html_mincut.main_text(f"<html><head><title>T</title>\n{line}") == line
    assert html_mincut.main_text("<html><head><title>T</title><article><p>" + line) == line


def test_min_cut_is_minimal():
    rng = np.random.default_rng(5)
    for _ in range(60):
        n = int(rng.integers(1, 8))
        a, b = rng.integers(0, 9, n).tolist(), rng.integers(0, 9, n).tolist()
        edges = [(int(i), int(j), int(rng.integers(1, 9))) for i, j in rng.integers(0, n, (6, 2)) if i != j]

        def cost(keep):
            return (sum(x for x, k in zip(a, keep) if not k) + sum(x for x, k in zip(b, keep) if k)
                    + sum(c for i, j, c in edges if keep[i] != keep[j]))

        best = min(cost([m >> i & 1 for i in range(n)]) for m in range(1 << n))
        assert cost(html_mincut.min_cut(a, b, edges)) == best


def test_page_texts(spark):
    import html as h
    for r in html_mincut.extract(spark.read.parquet(f"{SF}/pages.parquet").withColumn("src", F.col("html"))).collect():
        art = r.src[r.src.index("<article>") + 9: r.src.index("</article>")]
        parts = [" ".join(h.unescape(re.sub(r"<[^>]*>", " ", re.sub(r"</?b>", "", s))).split()) for s in re.split(r"</?(?:p|h\d)[^>]*>", art)]
        assert r.text == "\n".join(s for s in parts if s)
