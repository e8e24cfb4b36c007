"""Online packing, whitening and tokenizer alignment against brute force, on given tables and odd rows."""
import hashlib
import math
import zlib
from collections import Counter, defaultdict
from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import functions as F

from fieldops.llm import alignment, common, online_packing, suffix_scan, whitening
from fieldops.llm.queries import PIECE_TOKENIZER, op11_online_packing, op12_whitening, op13_alignment, tokenizer_path

SF = "/root/testdata/sf0.001"


# ---------------------------------------------------------------- 11

def token_ids(texts, end):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(tokenizer_path())
    return [[*e.ids, end] for e in t.encode_batch([x or "" for x in texts], add_special_tokens=False)]


def check_packed(rows, docs, capacity, slack):
    """Every id lies in one piece, sequences are gapless; returns the tokens of padding."""
    ids = defaultdict(list)
    for (doc_id, _), own in zip(docs, token_ids([t for _, t in docs], 1)):
        ids[doc_id].append(own)
    spare = {d: [list(own) for own in v] for d, v in ids.items()}
    by_doc = defaultdict(list)
    for r in rows:
        by_doc[r.doc_id].append(r)
    assert set(by_doc) == set(ids)
    for d, pieces in by_doc.items():
        # rows that share an id: each piece must fit one of them, and their ids add up
        assert sum(p.length for p in pieces) == sum(map(len, ids[d]))
        for p in pieces:
            fits = [own for own in spare[d] if len(own) == p.doc_tokens
                    and zlib.crc32(np.array(own[p.start:p.start + p.length], "<u4").tobytes()) == p.ids_crc32]
            assert fits
        if len(ids[d]) == 1:
            at = 0
            for p in sorted(pieces, key=lambda p: p.start):
                assert p.start == at and p.length > 0
                at += p.length
    sequences = defaultdict(list)
    for r in rows:
        sequences[r.sequence_id].append(r)
    padding = 0
    for pieces in sequences.values():
        at = 0
        for p in sorted(pieces, key=lambda p: p.offset):
            assert p.offset == at
            at += p.length
        assert at <= capacity
        gap = 0 if at & (at - 1) == 0 else capacity - at
        assert gap <= slack
        padding += gap
    return padding, len(sequences)


@pytest.mark.parametrize("capacity,windows,slack,fan_in", [(2048, 64, 8, 8), (256, 2, 0, 2), (100, 1, 5, 2)])
def test_online_packing(spark, capacity, windows, slack, fan_in):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")
    pairs = [tuple(r) for r in docs.collect()]
    got = online_packing.pack(docs.repartition(5), tokenizer_path(), capacity, 1, windows, slack, fan_in).collect()
    padding, n = check_packed(got, pairs, capacity, slack)
    assert padding <= 0.05 * capacity * n
    whole = Counter(r.doc_id for r in got)
    cut = sum(1 for r in got if r.start == 0 and r.doc_tokens < capacity and whole[r.doc_id] > 1)
    assert cut <= n + 1  # at most one document a sequence


def test_online_packing_of_odd_rows(spark, odd, none):
    got = online_packing.pack(odd, tokenizer_path()).collect()
    check_packed(got, [(r.doc_id, r.text) for r in odd.collect()], 2048, 8)
    assert online_packing.pack(none, tokenizer_path()).count() == 0
    same = spark.range(5000).select(F.lit(7).cast("long").alias("doc_id"), F.lit("same words here").alias("text"))
    got = online_packing.pack(same, tokenizer_path()).agg(F.sum("length"), F.countDistinct("sequence_id")).first()
    assert got[0] == 5000 * 4 and got[1] <= math.ceil(20000 / 2040) + 11


def test_packer_places_best_fit():
    p = online_packing.Packer(0, 10, 2, 0)

    def add(name, n):
        p.add(online_packing.Piece(name, 0, np.arange(n, dtype="<u4"), n))

    add("a", 7)
    add("b", 5)  # fits none: a second window
    add("c", 3)  # leaves least room beside a: full, emitted
    assert [r[0] for r in p.rows] == ["a", "c"] and p.rooms == [(5, 1)]
    add("d", 8)
    add("e", 6)  # fits none, none may open: the fullest (d) goes, filled by two tokens of e
    assert [(r[0], r[1], r[2]) for r in p.rows[2:]] == [("d", 0, 8), ("e", 0, 2)]
    assert p.open[1][-1].doc_id == "e" and p.open[1][-1].start == 2
    p.finish()
    assert sum(r[2] for r in p.rows) == 29


def test_online_packing_query(spark):
    assert op11_online_packing(spark, SF).columns == [f.split()[0] for f in online_packing.PIECES.split(", ")]


# ---------------------------------------------------------------- 12

def brute_whitening(vectors, k=32):
    """By plain linear algebra on the covariance: (n, deviation by row, values, vectors, trace, centred)."""
    x = [[math.floor(64 * float(c)) + 1_000_000 for c in v] for v in vectors]
    n, sums = len(x), [sum(c) for c in zip(*x)]
    deviation = [sum((n * c - s) ** 2 for c, s in zip(row, sums)) for row in x]
    centred = np.array([[float(Fraction(n * c - s, n)) for c, s in zip(row, sums)] for row in x])
    v = centred.T @ centred / n
    e, q = np.linalg.eigh(v)
    return n, deviation, e[::-1][:k], q[:, ::-1][:, :k], np.trace(v), centred


def check_whitened(rows, ids, vectors):
    n, deviation, e, q, trace, centred = brute_whitening(vectors)
    k = sum(e > len(vectors[0]) * 2.3e-16 * trace)
    assert len(rows) == n * k
    of = {i: j for j, i in enumerate(ids)}
    w = np.zeros((n, k))
    for r in rows:
        j = of[r.vec_id]
        assert r.n == n and r.deviation == deviation[j]
        assert abs(r.explained - e[r.component - 1] / trace) <= 1e-9 * r.explained + 1e-15
        w[j, r.component - 1] = r.whitened
    want = centred @ q[:, :k] / np.sqrt(e[:k])
    sign = np.sign((w * want).sum(0))
    gaps = np.minimum(np.diff(e, prepend=np.inf, append=0)[:-1] * -1, -np.diff(e, append=0))[:k] / e[0]
    distinct = gaps > 1e-6  # components of equal eigenvalues may be turned among themselves
    assert np.abs(w * sign - want)[:, distinct].max(initial=0) < 1e-7
    m = w - w.mean(0)
    error = np.abs(m.T @ m / n - np.eye(k)).max()
    assert {r.identity_error for r in rows} and all(abs(r.identity_error - error) < 1e-9 for r in rows) and error < 1e-4
    return k


def test_whitening(spark):
    table = spark.read.parquet(f"{SF}/embeddings.parquet")
    given = table.select("vec_id", "embedding").collect()
    got = op12_whitening(spark, SF).collect()
    assert check_whitened(got, [r[0] for r in given], [r[1] for r in given]) == 32


@pytest.mark.parametrize("spread", ["flat", "steep", "few"])
def test_filter_is_certified(spark, spread):
    """Spectra that are nearly flat, fall steeply, or have fewer dimensions than components."""
    rng = np.random.default_rng(3)
    d = 90
    scale = {"flat": np.ones(d), "steep": 0.7 ** np.arange(d), "few": np.r_[np.ones(9), np.zeros(d - 9)]}[spread]
    v = 8 * rng.standard_normal((400, d)) * scale
    table = spark.createDataFrame([(i, [float(c) for c in r]) for i, r in enumerate(v)], "vec_id long, embedding array<double>")
    rows = whitening.as_integers(table.repartition(3)).drop("len")
    model = whitening.fit(rows, d, 12, 10)
    n, _, e, q, trace, _ = brute_whitening(v.tolist(), 12)
    k = len(model.values)
    assert k == {"flat": 12, "steep": 12, "few": 9}[spread] and model.passes < 400
    assert np.abs(model.values - e[:k]).max() < 1e-11 * e[0] and abs(model.trace - trace) < 1e-9 * trace
    turn = model.vectors.T @ q[:, :k]
    assert np.abs(np.abs(np.diag(turn)) - 1).max() < 1e-8


def test_whitening_of_odd_rows(spark):
    rng = np.random.default_rng(1)
    full = [[float(x) for x in rng.standard_normal(5)] for _ in range(20)]
    rows = [(i, v, 1) for i, v in enumerate(full)] + [(20, None, 1), (21, [1.0, None, 0.0, 0.0, 0.0], 1), (22, [float("nan")] * 5, 1),
                                                     (23, [float("inf")] + [0.0] * 4, 1), (24, [], 1), (25, [1.0, 2.0], 1),
                                                     (26, [2.0, 4.0], 1), (27, [3.0], 1), (3, full[3], 1)]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>, component int").repartition(3)
    got = [r for r in whitening.whiten(table).collect()]
    five = [r for r in got if r.n == 21]
    assert {r.vec_id for r in five} == set(range(20)) and Counter(r.vec_id for r in five)[3] == 10
    n, deviation, *_ = brute_whitening(full + [full[3]])
    assert {r.vec_id: r.deviation for r in five} == dict(zip([*range(20), 3], deviation))
    assert {(r.vec_id, r.component) for r in got if r.n == 2} == {(25, 1), (26, 1)}  # on a line: one component
    assert not [r for r in got if r.n == 1]
    assert whitening.whiten(table.where("false")).count() == 0
    constant = spark.createDataFrame([(i, [1.0, 2.0]) for i in range(5)], "vec_id long, embedding array<float>")
    assert whitening.whiten(constant).count() == 0
    nulls = spark.createDataFrame([(None, [1.0, 0.0]), (None, [0.0, 3.0]), (1, [5.0, 5.0])], "vec_id long, embedding array<float>")
    assert whitening.whiten(nulls).where("vec_id is null").count() == 4


def test_deviation_beyond_a_long_is_null():
    v = np.array([[3, 4], [1 << 31, 1 << 31], [1 << 32, 0]], np.int64)
    assert whitening._deviation(v).to_pylist() == [25, None, None]
    assert whitening._deviation(v[:1]).to_pylist() == [25]


# ---------------------------------------------------------------- 13

def brute_alignment(docs):
    """Per document, by set intersection of the two tokenizers' ends."""
    import sentencepiece
    from tokenizers import Tokenizer

    a_tok, b_tok = Tokenizer.from_file(tokenizer_path()), sentencepiece.SentencePieceProcessor(model_file=tokenizer_path(PIECE_TOKENIZER))
    a_tok.encode_special_tokens = True
    letters = alignment.byte_letters()

    def piece(i):
        p = b_tok.id_to_piece(i)
        return bytes([int(p[3:5], 16)]) if b_tok.is_byte(i) else p.replace("▁", " ").encode()

    def cut(seq, ends):
        groups, n = [[]], 0
        for i, raw in seq:
            groups[-1].append(i)
            n += len(raw)
            if n in ends:
                groups.append([])
        return groups[:-1]

    of = []
    for doc_id, text in docs:
        groups = []
        if text:
            a = [(i, bytes(letters[c] for c in a_tok.id_to_token(i))) for i in a_tok.encode(" " + text, add_special_tokens=False).ids]
            b = [(i, piece(i)) for i in b_tok.encode(text)]
            if b"".join(r for _, r in a) == (" " + text).encode() == b"".join(r for _, r in b):
                ends = [set(np.cumsum([len(r) for _, r in s]).tolist()) for s in (a, b)]
                groups = list(zip(cut(a, ends[0] & ends[1]), cut(b, ends[0] & ends[1])))
        of.append((doc_id, groups))
    holders, best = Counter(), defaultdict(int)
    for _, g in of:
        holders.update({(x, y) for p, q in g for x in p for y in q})
    for (x, _), n in holders.items():
        best[x] = max(best[x], n)
    out = []
    for doc_id, g in of:
        links = [(x, y) for p, q in g for x in p for y in q]
        line = ";".join(",".join(map(str, p)) + "|" + ",".join(map(str, q)) for p, q in g)
        out.append((doc_id, sum(len(p) for p, _ in g), sum(len(q) for _, q in g), len(g), len(links),
                    sum(holders[x] == best[x[0]] for x in links), sum(holders[x] for x in links),
                    hashlib.sha256(line.encode()).hexdigest() if g else ""))
    return sorted(out, key=str)


def aligned(df, **kw):
    names = ("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")
    rows = alignment.align(df, tokenizer_path(), tokenizer_path(PIECE_TOKENIZER), **kw).collect()
    return sorted((tuple(r[c] for c in names) for r in rows), key=str)


ODD_TEXTS = [(-1, "a  b\n\tc <s>▁ </s>"), (-2, "a  b\n\tc <s> </s><unk> \x00 ﬁ <|endoftext|> 日本語 \U0001f600 é"),
             (-3, "  " * 3000 + "x" * 5000 + "=" * 3001 + "\n" * 700), (-4, "ab" * 40000), (-5, " lead"), (-5, " lead"),
             (-6, " wide"), (-7, "é" * 3000 + "日" * 5000), (-8, "\r\n \r")]


@pytest.mark.parametrize("small", [False, True])
def test_alignment(spark, monkeypatch, small):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").unionByName(
        spark.createDataFrame(ODD_TEXTS, "doc_id long, text string"))
    if small:  # many blocks, and groups of more than 3 links paired by distinct ids
        monkeypatch.setattr(alignment, "WIDE", 3)
        monkeypatch.setattr(alignment, "SLICE", 50)
    want = brute_alignment([tuple(r) for r in docs.collect()])
    assert aligned(docs, block_bytes=5000 if small else alignment.BLOCK_BYTES) == want


def test_alignment_of_odd_rows(spark, odd, none):
    assert aligned(odd) == brute_alignment([(r.doc_id, r.text) for r in odd.collect()])
    assert aligned(none) == []
    empty = none.sparkSession.createDataFrame([(1, None), (2, "")], "doc_id long, text string")
    assert aligned(empty) == [(1, 0, 0, 0, 0, 0, 0, ""), (2, 0, 0, 0, 0, 0, 0, "")]


def test_alignment_query(spark):
    assert set(op13_alignment(spark, SF).columns) == {
        "doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"}


def test_cuts_by_divide_and_conquer():
    rng = np.random.default_rng(5)
    for share in (0.0, 0.02, 0.5, 0.95, 1.0):
        ends_a, ends_b, edges_a, edges_b, base = [], [], [0], [0], 0
        for n in (1, 0, 2, 700, 3, 64):
            own = rng.integers(1, 5, n).cumsum()
            a = own[rng.random(n) < max(share, 0.5)].tolist()
            b = sorted({x if rng.random() < share else x + 0.5 for x in own.tolist()} - {own[-1] + 0.5 if n else 0})
            if n:
                a, b = sorted({*a, own[-1]}), sorted({*b, own[-1]})
            ends_a += [2 * (base + x) for x in a]
            ends_b += [int(2 * (base + x)) for x in b]
            base += int(own[-1]) if n else 0
            edges_a.append(len(ends_a))
            edges_b.append(len(ends_b))
        ends_a, ends_b = np.array(ends_a, np.int64), np.array(ends_b, np.int64)
        stop_a, stop_b = alignment.leaves(ends_a, ends_b, np.array(edges_a), np.array(edges_b))
        both = np.intersect1d(ends_a, ends_b)
        assert ends_a[stop_a - 1].tolist() == both.tolist() == ends_b[stop_b - 1].tolist()


# ---------------------------------------------------------------- 7

LONG = "The river rose for three days before anyone in the valley thought of leaving, and then the road was gone."
ARTICLE_TEXT = "\n".join(["Flood in the valley", LONG, LONG.replace("three", "four")])
BODY = "<h1>Flood in the valley</h1><p>" + LONG + "</p><p>" + LONG.replace("three", "four") + "</p>"
MENU = '<nav><a href="/">Home</a> <a href="/a">About</a></nav>'
FOOT = '<div class="footer">All rights reserved by the valley press and its owners.</div>'


@pytest.mark.parametrize("page", [
    f'<div class="layout has-sidebar">{MENU}<article>{BODY}</article><div class="sidebar">Read also our other pages.</div></div>{FOOT}',
    f'<div class="page no-sidebar"><article>{BODY}</article></div>{FOOT}',
    f'<div class="site sticky-header footer-dark">{MENU}<article>{BODY}</article>{FOOT}</div>',
    f'{MENU}<article><div class="article-body legal">{BODY}</div></article>{FOOT}',
    f'<form action="x.aspx"><input type="hidden">{MENU}<article>{BODY}</article>{FOOT}</form>',
    f'{MENU}<article><blockquote class="notice">{BODY}</blockquote></article>{FOOT}',
    f'<form id="aspnetForm" class="page search-form">{MENU}<div>{BODY}</div>{FOOT}</form>',
    f'{MENU}<div class="site header-fixed"><div>{BODY}</div>{FOOT}</div>',
    f'<article>{BODY}</article><div class="comments"><p>{"I was there. " * 100}</p></div>{FOOT}',
    f'{MENU}<div>{BODY}</div><div class="comments"><p>{"I was there and saw it all. " * 100}</p></div>{FOOT}',
    f'<div class="notice">We use cookies.</div><article><header>{BODY[:BODY.index("<p>")]}</header>{BODY[BODY.index("<p>"):]}</article>{FOOT}'])
def test_articles_survive_the_names_around_them(page):
    from fieldops.llm.html_mincut import main_text
    assert main_text(f"<html><body>{page}</body></html>") == ARTICLE_TEXT


def test_the_cut_changes_labels_for_the_better():
    """Blocks that their own words would lose, and the cut keeps; and one that it drops."""
    from fieldops.llm.html_mincut import content_cost, main_text, read_blocks
    page = f"<body><ul><li><a href=a>One</a><li>Two<li><a href=b>Three</a></ul><div><p>{LONG}</p><p>Why?</p><p>Nobody knew</p><p>{LONG}</p></div></body>"
    own = [t for t, b in read_blocks(page) if content_cost(t, b) > 0]
    assert own == [LONG, LONG]
    assert main_text(page) == "\n".join([LONG, "Why?", "Nobody knew", LONG])
    between = f"<body><ul><li><a href=a>Home page</a></li><li>Eight words stand here between links of menus.</li><li><a href=b>Other page</a></li></ul><div><p>{LONG}</p></div></body>"
    assert len([t for t, b in read_blocks(between) if content_cost(t, b) > 0]) == 2
    assert main_text(between) == LONG


def test_deep_and_broken_nesting_is_linear():
    import time

    from fieldops.llm.html_mincut import main_text
    n = 100_000
    began = time.time()
    assert main_text("<div>" * n + LONG + "</p></span>" * n) == LONG
    assert main_text("<b>" * n + f"<p>{LONG}" + "</i></section>" * n) == LONG
    assert main_text("<ul><li>" * 20_000 + LONG) == LONG
    assert main_text("".join(f"<p>{LONG}" for _ in range(2_000))).count("\n") == 1_999
    assert time.time() - began < 30


# ---------------------------------------------------------------- 4 and 9

def test_lines_with_equal_polynomial_sums_are_not_repeats(spark):
    from fieldops.llm import quality_rules

    def thue_morse(n, a, b):
        out = [0]
        while len(out) < n:
            out += [1 - x for x in out]
        return "".join((a, b)[x] for x in out)

    one, two = thue_morse(2048, "a", "b"), thue_morse(2048, "b", "a")
    texts = [f"{one}\n{two}", f"{one}\n{two}\n{one}", f"{one} x\n{one} x", "short\nshort\n" + one]
    found = []
    for t in texts + [texts[1]]:
        b = np.frombuffer(t.encode(), np.uint8)
        found.append(int(quality_rules._analyse(b, np.array([0, len(b)]))[0]["n_dup_lines"][0]))
    assert found == [0, 1, 1, 1, 1]
    whole = "".join(texts).encode()
    offs = np.concatenate(([0], np.cumsum([len(t.encode()) for t in texts])))
    assert quality_rules._analyse(np.frombuffer(whole, np.uint8), offs)[0]["n_dup_lines"].tolist() == [0, 1, 1, 1]


@pytest.mark.parametrize("letters", [(0, 1), (97, 98, 0), (97,)])
def test_suffix_scan_is_brute_force(letters):
    rng = np.random.default_rng(len(letters))
    for n in (0, 1, 2, 60):
        window, texts, group, place = 12, [], [], []
        pool = [bytes(rng.choice(letters, 40).astype(np.uint8)) for _ in range(4)]
        for _ in range(n):  # contexts of pieces of a few strings, so that many agree in part
            size = int(rng.integers(window, 20))
            text = pool[rng.integers(4)]
            at = int(rng.integers(len(text) - size))
            p = int(rng.integers(size))
            texts.append(text[at: at + size])
            group.append(int(rng.integers(3)))
            place.append(p)
        firsts = rng.random(n) < 0.5
        buf, offs = common.joined(texts)
        own, start, one, one_start = suffix_scan.repeated(buf, offs, np.array(group, np.int64), np.array(place, np.int64), window, firsts)
        sets = {}
        for i, (t, g, p) in enumerate(zip(texts, group, place)):
            for s in range(0, min(p, len(t) - window) + 1):
                sets.setdefault((g, p - s, t[s: s + window]), []).append((i, s))
        want = sorted(x for v in sets.values() if len(v) > 1 for x in v)
        assert sorted(zip(own.tolist(), start.tolist())) == want
        spots = {x: k for k, v in sets.items() for x in v}
        heads = [spots[x] for x in zip(one.tolist(), one_start.tolist())]
        assert all(firsts[i] for i in one)
        # each set whose first text in suffix order has the mark gives one; all-marked sets always do
        assert len(heads) == len(set(heads)) and {k for k, v in sets.items() if all(firsts[i] for i, _ in v)} <= set(heads)
