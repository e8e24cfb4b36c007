"""Streams that stop, restart and are given batches again; upserts that fail on the way."""
import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from fieldops.operators.upsert import finish_upsert, upsert_partitions, upsert_table
from fieldops.sources.manifest import ManifestTable
from fieldops.streaming import streams as st

SCHEMA = "event_id long, user_id long, ts timestamp_ntz, event_type string, value double, props string"


def at(hours):
    return dt.datetime(2024, 1, 1) + dt.timedelta(hours=hours)


def drop(spark, root, n, events):
    """A file drop; events: (event_id, user_id, hours)."""
    rows = [(e, u, at(h) if h is not None else None, "click", 1.0, None) for e, u, h in events]
    spark.createDataFrame(rows, SCHEMA).coalesce(1).write.parquet(f"{root}/drop{n}")


def stream(spark, root):
    return (spark.readStream.schema(st.EVENTS_SCHEMA).option("recursiveFileLookup", "true").option("maxFilesPerTrigger", 1).parquet(root))


def forget_last_commit(checkpoint):
    """The state in which a driver that died after the batch, but before its commit, leaves a stream."""
    names = sorted((n for n in os.listdir(f"{checkpoint}/commits") if n.isdigit()), key=int)
    os.remove(f"{checkpoint}/commits/{names[-1]}")
    crc = f"{checkpoint}/commits/.{names[-1]}.crc"
    if os.path.exists(crc):
        os.remove(crc)


def die_in_batch(monkeypatch, number, before_commit=True):
    """ManifestTable.commit raises once the stream's batch ``number`` comes."""
    real = ManifestTable.commit

    def commit(self, base, parts, schema, batch=None):
        if batch and batch["number"] == number:
            if not before_commit:
                real(self, base, parts, schema, batch)
            raise RuntimeError("killed here")
        return real(self, base, parts, schema, batch)

    monkeypatch.setattr(ManifestTable, "commit", commit)


DROPS = [[(1, 1, 1), (2, 2, 2), (3, None, 3)], [(4, 1, 5), (5, 3, 6)], [(6, 1, 4), (7, 2, 30), (8, 3, 5), (9, None, 2)],
         [(10, 1, 28), (4, 1, 5)]]


def intervals(events):
    out = set()
    for key in {u for _, u, _ in events}:
        own = sorted({(h, e) for e, u, h in events if u == key and h is not None})
        for (h, e), nxt in zip(own, [*own[1:], (None, None)]):
            out.add((key, at(h), e, at(nxt[0]) if nxt[0] is not None else None))
    return out


def held(table):
    rows = [(r.user_id, r.valid_from, r.event_id, r.valid_to) for r in table.read().collect()]
    assert len(rows) == len(set(rows))
    return set(rows)


@pytest.mark.parametrize("before_commit", [True, False])
def test_intervals_survive_a_restart(spark, tmp_path, monkeypatch, before_commit):
    root, out = str(tmp_path / "in"), str(tmp_path / "out")
    for n, events in enumerate(DROPS):
        drop(spark, root, n, events)
        os.utime(next(p for p in (tmp_path / "in" / f"drop{n}").glob("*.parquet")), (1e9 + n, 1e9 + n))

    def run():
        return st.interval_state_stream(spark, stream(spark, root), "user_id", "ts", "event_id", out)

    with monkeypatch.context() as m:
        die_in_batch(m, 1, before_commit)
        with pytest.raises(Exception, match="killed here"):
            run()
    # the late events of drop 2 come after the restart and cut intervals that were closed or open
    everything = [e for d in DROPS for e in d]
    table = run()
    assert held(table) == intervals(everything)
    version = table.manifest()["version"]
    forget_last_commit(f"{out}/_checkpoint")
    assert held(run()) == intervals(everything) and table.manifest()["version"] == version  # given again: nothing changes
    drop(spark, root, 9, [(11, 2, 1.5), (12, 5, 0), (13, 5, None)])  # late by a day, a new key, no time
    assert held(run()) == intervals([*everything, (11, 2, 1.5), (12, 5, 0)])


def test_intervals_read_only_recent_days(spark, tmp_path, monkeypatch):
    root, out = str(tmp_path / "in"), str(tmp_path / "out")
    drop(spark, root, 0, [(10 * d + u, u, 24 * d) for d in range(6) for u in (1, 2)])
    table = st.interval_state_stream(spark, stream(spark, root), "user_id", "ts", "event_id", out)
    days = {v: f for v, f in table.manifest()["parts"].items() if not v.startswith("open-")}
    drop(spark, root, 1, [(99, 1, 24 * 6)])
    st.interval_state_stream(spark, stream(spark, root), "user_id", "ts", "event_id", out)
    assert {v: f for v, f in table.manifest()["parts"].items() if v in days} == days  # their folders stay


def test_upsert_stream_survives_a_restart(spark, tmp_path, monkeypatch):
    root, out = str(tmp_path / "in"), str(tmp_path / "out")
    for n, events in enumerate(DROPS):
        drop(spark, root, n, events)
        os.utime(next(p for p in (tmp_path / "in" / f"drop{n}").glob("*.parquet")), (1e9 + n, 1e9 + n))

    def run():
        return st.upsert_stream(spark, stream(spark, root), out, ["user_id"], ["ts", "event_id"])

    def newest(table):
        return {r.user_id: r.event_id for r in table.read().collect()}

    with monkeypatch.context() as m:
        die_in_batch(m, 2)
        with pytest.raises(Exception, match="killed here"):
            run()
    assert newest(ManifestTable(spark, out)) == {1: 4, 2: 2, 3: 5, None: 3}  # the first two batches
    table = run()
    assert newest(table) == {1: 10, 2: 7, 3: 5, None: 3}  # older rows that come later change nothing
    assert table.read().count() == 4
    version = table.manifest()["version"]
    forget_last_commit(f"{out}/_checkpoint")
    run()
    assert table.manifest()["version"] == version
    with pytest.raises(Exception, match="was written by the stream"):
        st.upsert_stream(spark, stream(spark, root), out, ["user_id"], ["ts", "event_id"], checkpoint=str(tmp_path / "other"))


def test_windows_are_emitted_once(spark, tmp_path):
    root, out = str(tmp_path / "in"), str(tmp_path / "out")

    def run():
        return st.emit_closed(st.tumbling_counts(stream(spark, root), "ts", "1 day", None, [], "value", "6 hours"), out)

    def days():
        return sorted((r.window_start.day, r.n_events) for r in st.emitted(spark, out).collect())

    drop(spark, root, 0, [(1, 1, 1), (2, 1, 20), (3, 1, 26)])  # the watermark is at 20 h
    first = run()
    assert first["emitted"] == 0 and first["state_rows"][-1] == 2
    drop(spark, root, 1, [(4, 1, 22), (5, 1, 40)])  # 22 h is behind the newest event, not behind the watermark
    second = run()
    assert days() == [(1, 3)] and second["emitted"] == 1 and second["state_rows"][-1] == 1 and second["late"] == 0
    drop(spark, root, 2, [(6, 1, 3), (7, 1, 60)])  # 3 h belongs to a day that is closed
    third = run()
    assert third["late"] == 1 and days() == [(1, 3), (2, 2)]
    forget_last_commit(f"{out}/_checkpoint")
    run()
    assert days() == [(1, 3), (2, 2)]


def test_sessions_are_emitted_once(spark, tmp_path):
    root, out = str(tmp_path / "in"), str(tmp_path / "out")

    def run():
        return st.emit_closed(st.sessions(stream(spark, root), "ts", "2 hours", ["user_id"], "6 hours"), out)

    drop(spark, root, 0, [(1, 1, 1), (2, 1, 2), (3, 2, 1), (4, 1, 12)])
    run()
    drop(spark, root, 1, [(5, 1, 11), (6, 2, 40)])
    stats = run()
    got = sorted((r.user_id, r.session_start.hour, r.n_events) for r in st.emitted(spark, out).collect())
    assert got == [(1, 1, 2), (1, 11, 2), (2, 1, 1)] and stats["state_rows"][-1] == 1
    drop(spark, root, 2, [(7, 1, 1)])
    assert run()["late"] == 1


def test_episodes_hold_open_sessions_and_early_events(spark, tmp_path):
    """W04 gives every session: those still open at the end, and events that come long after later ones."""
    from fieldops.catalog import queries
    rows = [(1, 1, at(0)), (2, 1, at(2)), (3, 1, at(5)), (4, 1, at(24 * 30)), (5, 2, at(24 * 30 + 1)), (6, 3, at(24 * 366)), (7, 3, at(24 * 400))]
    events = spark.createDataFrame([(e, u, when, "click", 1.0, None) for e, u, when in rows], SCHEMA)
    events.select("event_id", "ts", "user_id", "event_type", "value", "props").write.parquet(f"{tmp_path}/events.parquet")
    got = sorted((r.user_id, r.session_start, r.n_events) for r in queries()["w04_session_episodes"](spark, str(tmp_path)).collect())
    assert got == [(1, at(0), 2), (1, at(5), 1), (1, at(24 * 30), 1), (2, at(24 * 30 + 1), 1), (3, at(24 * 366), 1), (3, at(24 * 400), 1)]


# ---------------------------------------------------------------- upserts

ROWS = "id int, v string, at int, p string"


def rows(table):
    return sorted((r.id, r.v, r.p) for r in table.read().collect())


def test_upsert_is_seen_whole_or_not_at_all(spark, tmp_path, monkeypatch):
    root = str(tmp_path / "t")
    table = ManifestTable(spark, root)

    def upsert(data):
        upsert_table(spark, root, spark.createDataFrame(data, ROWS), ["id"], ["at"], F.col("p"))

    upsert([(1, "a", 1, "x"), (2, "b", 1, "y"), (3, "c", 1, "z"), (3, "old", 0, "z"), (4, "d", 1, None)])
    before = rows(table)
    assert before == [(1, "a", "x"), (2, "b", "y"), (3, "c", "z"), (4, "d", None)]
    z = table.manifest()["parts"]["z"]
    for step in ("stage", "commit"):
        with monkeypatch.context() as m:
            def killed(*a, **k):
                raise RuntimeError("killed here")
            m.setattr(ManifestTable, step, killed)
            with pytest.raises(RuntimeError, match="killed here"):
                upsert([(1, "moved", 2, "y")])
        assert rows(table) == before
    upsert([(1, "moved", 2, "y")])
    assert rows(table) == [(1, "moved", "y"), (2, "b", "y"), (3, "c", "z"), (4, "d", None)]
    assert "x" not in table.manifest()["parts"] and table.manifest()["parts"]["z"] == z  # untouched: same folder
    upsert([(4, "left the null partition", 2, "x/ä =")])
    assert rows(table)[3] == (4, "left the null partition", "x/ä =")
    old = table.manifest(1)
    assert sorted(r.v for r in table.read(base=old).collect()) == ["a", "b", "c", "d"]  # an earlier version reads as it was
    assert table.vacuum(keep=1) > 0 and len(table.versions()) == 1 and len(rows(table)) == 4


def test_second_of_two_writers_fails(spark, tmp_path):
    table = ManifestTable(spark, str(tmp_path / "t"))
    df = spark.createDataFrame([(1, "a", 1, "x")], ROWS)
    base = table.replace(df, F.col("p"), [], None)
    table.replace(df, F.col("p"), ["x"], base)
    with pytest.raises(RuntimeError, match="another writer"):
        table.replace(df, F.col("p"), ["x"], base)
    with pytest.raises(ValueError, match="not given as touched"):
        table.replace(df, F.col("p"), [], table.manifest())


def test_new_columns_widen_the_table(spark, tmp_path):
    root = str(tmp_path / "t")
    upsert_table(spark, root, spark.createDataFrame([(1, "a", 1, "x"), (2, "b", 1, "y")], ROWS), ["id"], ["at"], F.col("p"))
    wide = spark.createDataFrame([(1, "n", 2, "x", 7)], ROWS + ", extra int")
    upsert_table(spark, root, wide, ["id"], ["at"], F.col("p"))
    assert sorted((r.id, r.v, r.extra) for r in ManifestTable(spark, root).read().collect()) == [(1, "n", 7), (2, "b", None)]


def test_plain_upsert_is_finished_after_a_failure(spark, tmp_path, monkeypatch):
    from fieldops.operators import upsert as U
    path = str(tmp_path / "t")

    def put(data):
        upsert_partitions(spark, path, spark.createDataFrame(data, ROWS), ["id"], ["at"], "p")

    def now():
        return sorted((r.id, r.v, r.p) for r in spark.read.parquet(path).collect())

    put([(1, "a", 1, "x"), (2, "b", 1, "y")])
    with monkeypatch.context() as m:
        m.setattr(U, "finish_upsert", lambda *a: False)  # dies once the journal is written
        put([(1, "moved", 2, "y")])
    assert now() == [(1, "a", "x"), (2, "b", "y")]
    assert finish_upsert(spark, path) and not finish_upsert(spark, path)
    assert now() == [(1, "moved", "y"), (2, "b", "y")]
