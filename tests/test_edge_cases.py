"""Hand-made fixtures for the edge cases the reference's data checks guard (FIXTURES.md §2)."""
import datetime as dt

import pytest
from pyspark.sql import functions as F

from fieldops.functions import calendar as cal
from fieldops.functions import clean
from fieldops.functions.scalar import month_diff, strict_greatest
from fieldops.operators.aggs import keep_latest
from fieldops.operators.business_time import business_days, business_minutes
from fieldops.operators.history import scd2_snapshot
from fieldops.operators.joins import effective_dated_join, interval_join, rule_flags, wildcard_rule_match
from fieldops.operators.quality import Check, run_checks
from fieldops.operators.upsert import merge
from fieldops.plans.service import repair_episodes


def ts(s):
    return dt.datetime.fromisoformat(s)


def _cal(spark):
    return cal.business_calendar(spark, 2023, 2025)


def test_easter_rule():
    assert cal.easter(2024) == dt.date(2024, 3, 31)
    assert cal.easter(2000) == dt.date(2000, 4, 23)
    days = {r[2] for r in cal.holiday_rows([2024])}
    assert dt.date(2024, 5, 9) in days and dt.date(2024, 5, 20) in days and len(days) == 11


def test_business_minutes_dst_weekend_holiday(spark):
    rows = [
        (1, ts("2024-03-29 08:00:00"), ts("2024-04-02 08:00:00")),   # Fri → Tue, Easter Monday off, DST Sunday
        (2, ts("2024-03-30 10:00:00"), ts("2024-03-31 12:00:00")),   # weekend only
        (3, ts("2024-07-01 06:30:00"), ts("2024-07-01 07:00:00")),   # 08:30–09:00 Paris: before opening
        (4, ts("2024-07-01 07:00:00"), ts("2024-07-01 07:01:30")),   # 90 s → 1 whole minute
        (5, ts("2024-07-02 10:00:00"), ts("2024-07-01 10:00:00")),   # end before start
        (6, ts("2024-01-02 08:00:00"), None),
    ]
    df = spark.createDataFrame(rows, "id int, s timestamp_ntz, e timestamp_ntz")
    a = {r.id: (r.bm, r.bmn) for r in business_minutes(
        business_minutes(df, "s", "e", _cal(spark), out="bm"), "s", "e", _cal(spark), out="bmn",
        null_without_business_day=True).collect()}
    # Fri 29/03 (CET): 09:00–17:30 local = 08:00–16:30Z → 510; Tue 02/04 (CEST) opens 07:00Z → 60
    assert a[1] == (570, 570)
    assert a[2] == (0, None)
    assert a[3] == (0, 0)
    assert a[4] == (1, 1)
    assert a[5] == (0, None)
    assert a[6] == (0, None)


def test_business_days(spark):
    df = spark.createDataFrame([(1, dt.date(2024, 5, 3), dt.date(2024, 5, 10)),   # Fri → Fri
                                (2, dt.date(2024, 5, 4), dt.date(2024, 5, 5)),    # weekend: none
                                (3, dt.date(2024, 5, 6), dt.date(2024, 5, 6))], "id int, a date, b date")
    got = {r.id: r.business_days for r in business_days(df, "a", "b", _cal(spark)).collect()}
    assert got == {1: 3, 2: None, 3: 0}   # 8 May and Ascension (9 May 2024) are holidays


def test_interval_join_inclusive_double_count(spark):
    visits = spark.createDataFrame([(1, "d", ts("2024-01-01 00:00:00"), ts("2024-01-05 00:00:00")),
                                    (2, "d", ts("2024-01-05 00:00:00"), ts("2024-01-20 00:00:00"))],
                                   "vid int, dev string, prev timestamp_ntz, cur timestamp_ntz")
    facts = spark.createDataFrame([("d", ts("2024-01-05 00:00:00")), ("d", ts("2024-01-19 23:59:00")),
                                   ("x", ts("2024-01-10 00:00:00"))], "dev string, t timestamp_ntz")
    j = interval_join(visits, facts, ["dev"], "prev", "cur", "t", bucket_days=3, how="left", interval_id=["vid"])
    counts = {r.vid: r.n for r in j.groupBy("vid").agg(F.count("t").alias("n")).collect()}
    assert counts == {1: 1, 2: 2}   # the fact exactly on a visit belongs to both intervals


def test_effective_dated_overlap_gap_boundaries(spark):
    periods = spark.createDataFrame([("k", dt.date(2024, 1, 1), dt.date(2024, 1, 31), 10.0),
                                     ("k", dt.date(2024, 1, 15), dt.date(2024, 2, 10), 20.0),
                                     ("k", dt.date(2024, 3, 1), None, 30.0)],
                                    "key string, valid_from date, valid_to date, price double")
    facts = spark.createDataFrame([(1, "k", dt.date(2024, 1, 1)), (2, "k", dt.date(2024, 1, 20)),
                                   (3, "k", dt.date(2024, 2, 10)), (4, "k", dt.date(2024, 2, 20)),
                                   (5, "k", dt.date(2030, 1, 1))], "id int, key string, d date")
    got = {r.id: r.price for r in effective_dated_join(facts, periods, ["key"], "d").collect()}
    assert got == {1: 10.0, 2: 20.0, 3: 20.0, 4: None, 5: 30.0}


def test_wildcard_rules_and_flags(spark):
    facts = spark.createDataFrame([(1, "A", "x"), (2, "B", None), (3, None, "y")], "id int, t string, m string")
    rules = [dict(rid=10, label="any"), dict(rid=11, rt="A", label="A*"), dict(rid=12, rt="A", rm="x", label="Ax"),
             dict(rid=13, rm="y", label="*y"), dict(rid=14, rm="y", label="tie")]
    attrs = [("t", "rt", 16), ("m", "rm", 8)]
    got = {r.id: r.label for r in wildcard_rule_match(facts, rules, attrs, ["rid"]).collect()}
    assert got == {1: "Ax", 2: "any", 3: "*y"}   # NULL in the fact never equals a set rule value
    twice = facts.union(facts)
    assert wildcard_rule_match(twice, rules, attrs, ["rid"]).count() == 6   # equal facts stay
    none = wildcard_rule_match(facts, [], attrs).collect()
    assert [(r.rt, r._score) for r in none] == [(None, 0)] * 3
    rows = spark.createDataFrame([(1, "S", dt.date(2024, 1, 9)), (2, "S", dt.date(2024, 1, 10))],
                                 "id int, sup string, d date")
    f = {r.id: (r.is_claimed, r.takeover) for r in rule_flags(
        rows, [dict(sup="S", date_from="2024-01-01", date_to="2024-01-10", takeover=True)],
        {"sup": "sup"}, date_col="d", flags=["takeover"]).collect()}
    assert f == {1: (True, True), 2: (False, False)}   # date_to is excluded


def test_scd2_changes_deletes_reappearance_idempotent(spark):
    s1 = spark.createDataFrame([(1, "a", 1.0), (2, None, 2.0), (3, "c", 3.0)], "k int, v string, u double")
    s2 = spark.createDataFrame([(1, "a", 9.0), (2, "b", 2.0)], "k int, v string, u double")
    s3 = spark.createDataFrame([(1, "a", 9.0), (2, "b", 2.0), (3, "c", 3.0)], "k int, v string, u double")
    n1, n2, n3 = ts("2024-01-01 00:00:00"), ts("2024-01-02 00:00:00"), ts("2024-01-03 00:00:00")
    h1 = scd2_snapshot(None, s1, ["k"], n1, check_cols=["v"])
    h2 = scd2_snapshot(h1, s2, ["k"], n2, check_cols=["v"], invalidate_hard_deletes=True)
    rows = sorted(((r.k, r.v, r.dbt_valid_from, r.dbt_valid_to) for r in h2.collect()),
                  key=lambda x: (x[0], x[2]))
    assert rows == [(1, "a", n1, None), (2, None, n1, n2), (2, "b", n2, None), (3, "c", n1, n2)]
    h2b = scd2_snapshot(h2, s2, ["k"], n2, check_cols=["v"], invalidate_hard_deletes=True)
    key = lambda r: (r.k, r.dbt_valid_from)
    assert sorted(h2b.collect(), key=key) == sorted(h2.collect(), key=key)   # rerun: no change
    h3 = scd2_snapshot(h2, s3, ["k"], n3, check_cols=["v"], invalidate_hard_deletes=True)
    assert sorted((r.k, r.dbt_valid_from) for r in h3.where("dbt_valid_to is null").collect()) == \
        [(1, n1), (2, n2), (3, n3)]   # key 3 re-appears as a new version


def test_merge_duplicates_and_widening(spark):
    target = spark.createDataFrame([(1, "old", 1), (2, "keep", 1)], "k int, v string, u int")
    batch = spark.createDataFrame([(1, "new1", 2, "x"), (1, "new2", 3, "y"), (3, "ins", 1, "z")],
                                  "k int, v string, u int, extra string")
    got = {r.k: (r.v, r.extra) for r in merge(target, batch, ["k"], ["u"]).collect()}
    assert got == {1: ("new2", "y"), 2: ("keep", None), 3: ("ins", "z")}


def test_keep_latest_nulls_lose(spark):
    df = spark.createDataFrame([(1, None, "a"), (1, 5, "b"), (1, 3, "c")], "k int, o int, v string")
    assert keep_latest(df, ["k"], ["o"]).collect()[0].v == "b"


def test_repair_episode_gap_30_vs_31(spark):
    iv = spark.createDataFrame([
        (1, 7, ts("2024-01-01 10:00:00")), (2, 7, ts("2024-01-31 09:00:00")),   # 30 days: same episode
        (3, 7, ts("2024-03-02 09:00:00")), (4, 7, ts("2024-03-02 15:00:00"))],  # 31 days: new; same day
        "workorder_id int, material_id int, date_done timestamp_ntz").withColumn("technician", F.lit("t")) \
        .withColumn("report", F.lit("r"))
    arts = spark.createDataFrame([(1, "P2"), (1, "P1"), (1, "P1")], "workorder_id int, product_reference string")
    got = {r.workorder_id: (r.is_repair, r.episode_rank, r.nb_visites_episode, r.is_same_day, r.articles)
           for r in repair_episodes(iv, arts).collect()}
    assert got[1] == (False, 1, 2, False, "P1, P2")
    assert got[2] == (True, 2, 2, False, None)
    assert got[3] == (False, 1, 2, False, None)
    assert got[4] == (True, 2, 2, True, None)


def test_cleaning_functions(spark):
    df = spark.createDataFrame([
        ("<X>A&amp;apos;B</X>", " AUCUN ", "1234.0", "1,5", "02/01/0024", '[{"name":"a","value":"1"},{"name":"a","value":"2"}]'),
        ("<Y>z</Y>", "PAS D'ENGAGEMENT", "75001", "x", "2024-01-02 03:04:05", "not json")],
        "xml string, eng string, cp string, num string, d string, j string")
    r = df.select(clean.xml_field("xml", "X").alias("x"), clean.leading_int("eng").alias("e"),
                  clean.clean_code("cp", 5).alias("cp"), clean.parse_decimal("num").alias("n"),
                  clean.parse_ts("d").alias("t"), clean.eav_value("j", "a").alias("a")).collect()
    assert (r[0].x, r[0].e, r[0].cp, r[0].n, r[0].t, r[0].a) == ("A&apos;B", 0, "01234", 1.5, ts("2024-01-02 00:00:00"), "1")
    assert (r[1].x, r[1].e, r[1].cp, r[1].n, r[1].a) == (None, None, "75001", None, None)


def test_scalars(spark):
    r = spark.createDataFrame([(dt.date(2001, 1, 31), dt.date(2001, 3, 1), 1.0, None)],
                              "a date, b date, x double, y double").select(
        month_diff("b", "a").alias("m"), strict_greatest("x", "y").alias("g")).collect()[0]
    assert (r.m, r.g) == (2, None)


def test_quality_thresholds_and_boundary(spark):
    df = spark.createDataFrame([(i, None if i < 12 else "x") for i in range(20)], "k int, v string")
    other = spark.createDataFrame([(1,)], "k int")
    checks = [Check("v_nn", "not_null", "t", "v", warn_if=">10", error_if=">20"),
              Check("fk", "relationships", "t", "k", params={"to": "o", "field": "k"}, parents=("t", "o"))]
    res = {r.check_name: (r.failures, r.status) for r in run_checks({"t": df, "o": other}, checks).collect()}
    assert res == {"v_nn": (12, "warn"), "fk": (19, "error")}
    res2 = run_checks({"t": df, "o": other}, checks, run_tables=["t"]).collect()
    assert [r.check_name for r in res2] == ["v_nn"]


def test_bucketed_lag_matches_plain_window(spark):
    from pyspark.sql import Window
    from fieldops.operators.windows import bucketed_lag
    rows = [(1, ts(f"2024-01-{d:02d} {h:02d}:00:00"), d * 100 + h) for d in (1, 2, 5, 9) for h in (1, 7, 13)]
    rows += [(2, ts("2024-01-03 10:00:00"), 7)]
    df = spark.createDataFrame(rows, "k int, t timestamp_ntz, v int")
    w = Window.partitionBy("k").orderBy("t")
    ref = {(r.k, r.t): (r.pv, r.nv) for r in df.select("k", "t", F.lag("v").over(w).alias("pv"),
                                                       F.lead("v").over(w).alias("nv")).collect()}
    lag = bucketed_lag(df, ["k"], ["t"], ["v"], F.col("t").cast("date"))
    lead = bucketed_lag(df, ["k"], ["t"], ["v"], F.col("t").cast("date"), offset_direction="lead", prefix="next_")
    got_lag = {(r.k, r.t): r.prev_v for r in lag.collect()}
    got_lead = {(r.k, r.t): r.next_v for r in lead.collect()}
    assert got_lag == {k: v[0] for k, v in ref.items()}
    assert got_lead == {k: v[1] for k, v in ref.items()}


def test_bucketed_episodes_match_plain_windows(spark):
    from fieldops.operators.windows import episodes, episodes_bucketed
    days = [1, 2, 3, 10, 11, 30, 31, 32, 33, 60]
    rows = [(1, i, dt.date(2024, 1, 1) + dt.timedelta(days=d)) for i, d in enumerate(days)]
    rows += [(2, 100 + i, dt.date(2024, 3, 1) + dt.timedelta(days=3 * i)) for i in range(5)]
    df = spark.createDataFrame(rows, "k int, id int, d date")
    plain = {r.id: (r.gap_days, r.is_new_episode, r.episode_no, r.episode_rank) for r in
             episodes(df, ["k"], [F.col("d"), F.col("id")], "d", gap_days=2).collect()}
    buck = {r.id: (r.gap_days, r.is_new_episode, r.episode_no, r.episode_rank) for r in
            episodes_bucketed(df, ["k"], ["d", "id"], "d", gap_days=2, bucket=F.trunc("d", "week")).collect()}
    assert plain == buck


def test_uncovered_calendar_day_raises(spark):
    from fieldops.functions.calendar import business_calendar
    from fieldops.operators.business_time import business_days, business_minutes
    cal = business_calendar(spark, 2024, 2024)
    df = spark.createDataFrame([(dt.datetime(2024, 12, 2, 8), dt.datetime(2025, 3, 3, 12))], "a timestamp, b timestamp")
    for fn in (business_days, business_minutes):
        with pytest.raises(Exception, match="not in the business calendar"):
            fn(df, "a", "b", cal).collect()
    first = spark.createDataFrame([(dt.date(2024, 1, 1), dt.date(2024, 1, 3)), (None, dt.date(2024, 1, 3))], "a date, b date")
    assert [r.business_days for r in business_days(first, "a", "b", cal).collect()] == [1, None]


def test_null_keys_are_one_group(spark):
    from fieldops.operators.history import backfill_leading_nulls
    from fieldops.operators.windows import bucketed_lag, bucketed_running, episodes_bucketed
    rows = [(k, dt.date(2024, 1, d), d) for k in (None, "x") for d in (1, 2, 9)]
    df = spark.createDataFrame(rows, "k string, day date, v int")
    lag = bucketed_lag(df, ["k"], ["day"], ["v"], F.col("day"))
    assert sorted((r.k or "", r.v, r.prev_v) for r in lag.collect()) == sorted(
        (k, v, p) for k in ("", "x") for v, p in ((1, None), (2, 1), (9, 2)))
    run = bucketed_running(df, ["k"], ["day"], F.col("day"), sums={"s": F.col("v")})
    assert sorted((r.k or "", r.s) for r in run.collect()) == [("", 1), ("", 3), ("", 12), ("x", 1), ("x", 3), ("x", 12)]
    assert episodes_bucketed(df, ["k"], ["day"], "day", 3, F.col("day")).count() == 6
    holes = spark.createDataFrame([(None, 1, None), (None, 2, "b")], "k string, o int, v string")
    assert [r.v for r in backfill_leading_nulls(holes, ["k"], ["o"], ["v"]).collect()] == ["b", "b"]


def test_equal_facts_stay(spark):
    periods = spark.createDataFrame([("k", dt.date(2024, 1, 1), None, 1.0)], "key string, valid_from date, valid_to date, price double")
    facts = spark.createDataFrame([("k", dt.date(2024, 1, 5))] * 2, "key string, d date")
    assert effective_dated_join(facts, periods, ["key"], "d").count() == 2


def test_upsert_moves_keys_and_raises_on_unreadable_target(spark, tmp_path):
    from fieldops.operators.upsert import upsert_partitions
    path = str(tmp_path / "t")
    schema = "id int, v string, at int, p string"
    for rows in ([(1, "a", 1, "a"), (2, "b", 1, "b")], [(1, "moved", 2, "b")]):
        upsert_partitions(spark, path, spark.createDataFrame(rows, schema), ["id"], ["at"], "p")
    got = sorted((r.id, r.v, r.p) for r in spark.read.parquet(path).collect())
    assert got == [(1, "moved", "b"), (2, "b", "b")]
    bad = tmp_path / "bad" / "p=a"
    bad.mkdir(parents=True)
    (bad / "part-0.parquet").write_bytes(b"not parquet")
    with pytest.raises(Exception):
        upsert_partitions(spark, str(tmp_path / "bad"), spark.createDataFrame([(1, "a", 1, "a")], schema), ["id"], ["at"], "p")


def test_large_partition_value_spans_files(spark, tmp_path):
    from fieldops.sources.tables import write_table
    df = spark.range(100_000).select((F.col("id") % 2).alias("p"), F.col("id"))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # else these few rows are one task
    try:
        write_table(df.repartition(4), str(tmp_path / "w"), ["p"], ["id"])
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert len(list((tmp_path / "w" / "p=0").glob("*.parquet"))) > 1


def test_bucketed_passes_on_random_rows(spark):
    """One-pass episodes and neighbours against plain key-wide windows: ties, NULL keys, single rows, sparse buckets."""
    import random

    from pyspark.sql import Window
    from fieldops.operators.windows import bucketed_neighbours, episodes, episodes_bucketed
    rng = random.Random(4)
    rows = [(rng.choice([1, 2, 3, None]), i, dt.date(2024, 1, 1) + dt.timedelta(days=int(rng.expovariate(1 / 60)))) for i in range(400)]
    rows += [(9, 999, dt.date(2024, 5, 5))]
    df = spark.createDataFrame(rows, "k int, id int, d date").repartition(3)
    names = ["gap_days", "is_new_episode", "episode_no", "episode_rank"]
    for gap in (0, 2, 10):
        plain = {r.id: [r[c] for c in names] for r in episodes(df, ["k"], [F.col("d"), F.col("id")], "d", gap).collect()}
        for bucket in (F.trunc("d", "week"), F.trunc("d", "month"), F.col("d")):
            got = episodes_bucketed(df, ["k"], ["d", "id"], "d", gap, bucket).collect()
            assert {r.id: [r[c] for c in names] for r in got} == plain
            sizes = {(r.k, r.episode_no): r.episode_size for r in got}
            assert all(sum(1 for r in got if (r.k, r.episode_no) == e) == n for e, n in sizes.items())
    w = Window.partitionBy("k").orderBy("d", "id")
    want = {r.id: (r.nd, r.ni, r.n) for r in df.select("id", F.lead("d").over(w).alias("nd"), F.lead("id").over(w).alias("ni"),
                                                       F.row_number().over(w).alias("n")).collect()}
    out = bucketed_neighbours(df, ["k"], ["d", "id"], F.trunc("d", "week"), {"nd": "d", "ni": "id"}, "n")
    assert {r.id: (r.nd, r.ni, r.n) for r in out.collect()} == want
