"""Mixing sources to target weights by a low-discrepancy schedule, in DataFrame operations only.

1. Each source's documents are put in a shuffled but repeatable order (by a digest) and laid end to
   end: a stream of words, cut into equal blocks.
2. Slot k of the mix takes the point frac(k * golden ratio); the cumulative target weights map the
   point to a source, so that every stretch of the schedule holds each source in nearly its share.
3. Slots are ranked within their source; the slot of rank r takes block r of the source's stream,
   and starts over when the stream is used up.

The schedule leaves a source a few slots short of or beyond its target; short ones get slots at the
end, and slots beyond the target are not taken, so each source ends at its target to the word.

The mix in order is what slots are for: a document is read from the slot on that takes its first word.
``mix`` gives that slot, ``mixed_documents`` on demand the one of every repetition; rows sorted by it
hold each source in nearly its share in every stretch.

No step gathers a source in one task: offsets are running sums within (source, digest bucket) plus
sums over buckets; ranks are counted within runs of slots; slots find their source by an equal
join on cells of the unit interval.

Rows: a null or empty text has size 0 and is never taken.  The null source is a source, the last.
Rows that repeat are documents of their own.  An empty table gives an empty result.  Further
columns are passed on by name in ``row`` (see ``ordered``) and cannot clash.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from fieldops.llm import common as C

WEIGHTS = (5, 2, 1)
SHARE = 1.5
MAX_REPEAT = 2
BLOCK = 1024
#: slots that are ranked together; cells of the unit interval in which slots look for their source
RUN = 4096
CELLS = 4096
GOLDEN = 0.6180339887498949


def size_of(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(C.WORD)), F.lit(0)).cast("long")


def digest(doc_id: Column, text: Column) -> Column:
    """The shuffled order: md5 of the id and the text's length and md5, as hex."""
    return F.md5(F.concat_ws("|", F.coalesce(doc_id.cast("string"), F.lit("null")), F.md5(F.coalesce(text, F.lit("")))))


def source_targets(sizes: DataFrame, weights=WEIGHTS, share: float = SHARE, max_repeat: int = MAX_REPEAT) -> DataFrame:
    """(source, source_size, weight, target) from (source, size): one row per source.

    Targets are proportional to weight up to max_repeat times the source's size; what is above is
    shared again by weight until none is above.  That is a water level: with sources in order of
    size / weight, the first whose share of the rest does not exceed its limit sets the level.
    The windows here run over one row per source."""
    per = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    rank = F.row_number().over(W.partitionBy(F.lit(0)).orderBy(F.col("source").asc_nulls_last())) - 1
    cycle = F.array(*[F.lit(float(w)) for w in weights])
    per = per.withColumn("weight", F.get(cycle, (rank % len(weights)).cast("int")))
    per = per.withColumn("room", (F.col("source_size") * max_repeat).cast("double"))
    every = W.partitionBy(F.lit(0))
    order = every.orderBy(F.col("room") / F.col("weight"), F.col("source").asc_nulls_last())
    prior = order.rowsBetween(W.unboundedPreceding, -1)
    rest = order.rowsBetween(0, W.unboundedFollowing)
    left = F.sum("source_size").over(every) * share - F.coalesce(F.sum("room").over(prior), F.lit(0.0))
    level = left / F.sum("weight").over(rest)
    per = per.withColumn("level", F.when(level * F.col("weight") <= F.col("room"), level))
    whole = order.rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
    per = per.withColumn("level", F.first("level", ignorenulls=True).over(whole))
    target = F.when(F.col("level").isNull(), F.col("room")).otherwise(
        F.least(F.col("room"), F.col("level") * F.col("weight")))
    return per.select("source", "source_size", "weight", target.alias("target"))


def ordered(docs: DataFrame) -> DataFrame:
    """docs (doc_id, text, source, ...) as (source, bucket, rank, size, start, doc_id, row): place of
    each document in its source's shuffled stream; (source, bucket, rank) is unique."""
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")
    keyed = docs.select("doc_id", "source", size_of(F.col("text")).alias("size"),
                        digest(F.col("doc_id"), F.col("text")).alias("d"), row)
    return place(keyed)


def place(keyed: DataFrame) -> DataFrame:
    """Adds bucket, rank and start to (doc_id, source, size, d, ...)."""
    keyed = keyed.withColumn("bucket", F.conv(F.substring("d", 1, 3), 16, 10).cast("int"))
    sums = keyed.groupBy("source", "bucket").agg(F.sum("size").alias("n"))
    before = W.partitionBy("source").orderBy("bucket").rowsBetween(W.unboundedPreceding, -1)
    sums = sums.select(F.col("source").alias("s_"), F.col("bucket").alias("b_"),
                       F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    inner = W.partitionBy("source", "bucket").orderBy("d", "size")
    local = keyed.withColumn("rank", F.row_number().over(inner)).withColumn(
        "local", F.sum("size").over(inner.rowsBetween(W.unboundedPreceding, 0)) - F.col("size"))
    joined = local.join(sums, F.col("source").eqNullSafe(F.col("s_")) & (F.col("bucket") == F.col("b_")))
    return joined.withColumn("start", F.col("base") + F.col("local")).drop("s_", "b_", "base", "local", "d")


def schedule(targets: DataFrame, block: int = BLOCK) -> DataFrame:
    """(slot, source, pass, block, take): the mix in order; slot's source gives `take` words of a block, in the
    pass over its stream that is counted from 0."""
    spark = targets.sparkSession
    per = (targets.where("target >= 0.5")
           .withColumn("goal", F.round("target").cast("long"))
           .withColumn("blocks", F.ceil(F.col("source_size") / block).cast("long")))
    every = W.partitionBy(F.lit(0))
    upto = every.orderBy(F.col("source").asc_nulls_last())
    per = per.withColumn("hi", F.sum("goal").over(upto) / F.sum("goal").over(every))
    per = per.withColumn("lo", F.coalesce(F.lag("hi").over(upto), F.lit(0.0)))
    # slots needed: whole passes over the stream, then blocks of the last one
    full = F.floor(F.col("goal") / F.col("source_size"))
    rest = F.col("goal") - full * F.col("source_size")
    per = C.staged(per.withColumn("need", full * F.col("blocks") + F.ceil(rest / block)), "sources")
    count = per.agg(F.sum("need")).first()[0] or 0
    point = F.col("slot") * F.lit(GOLDEN)
    slots = (spark.range(count).withColumnRenamed("id", "slot")
             .withColumn("x", point - F.floor(point))
             .withColumn("cell", F.floor(F.col("x") * CELLS).cast("int"))
             .withColumn("run", F.floor(F.col("slot") / RUN).cast("long")))
    cells = per.withColumn("cell", F.explode(F.sequence(
        F.floor(F.col("lo") * CELLS).cast("int"), F.least(F.floor(F.col("hi") * CELLS), F.lit(CELLS - 1)).cast("int"))))
    cells = cells.select("cell", "lo", "hi", "source")
    drawn = (slots.join(cells, "cell").where("x >= lo and x < hi")
             .select("slot", "run", "source"))
    runs = drawn.groupBy("source", "run").agg(F.count("*").alias("n"))
    before = W.partitionBy("source").orderBy("run").rowsBetween(W.unboundedPreceding, -1)
    runs = runs.select(F.col("source").alias("s_"), F.col("run").alias("r_"),
                       F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    local = F.row_number().over(W.partitionBy("source", "run").orderBy("slot")) - 1
    ranked = (drawn.withColumn("local", local)
              .join(runs, F.col("source").eqNullSafe(F.col("s_")) & (F.col("run") == F.col("r_")))
              .select("slot", "source", (F.col("base") + F.col("local")).alias("rank")))
    got = ranked.groupBy(F.col("source").alias("s_")).agg(F.count("*").alias("got"))
    short = (per.join(got, F.col("source").eqNullSafe(F.col("s_")), "left")
             .withColumn("got", F.coalesce("got", F.lit(0))).where("need > got")
             .select("source", F.explode(F.sequence(F.col("got"), F.col("need") - 1)).alias("rank")))
    late = short.select((F.lit(count) + F.col("rank")).alias("slot"), "source", "rank")
    plan = ranked.unionByName(late).withColumnRenamed("source", "s_").join(
        per.select("source", "source_size", "goal", "blocks", "need"), F.col("s_").eqNullSafe(F.col("source")))
    number = F.col("rank") % F.col("blocks")
    turn = F.floor(F.col("rank") / F.col("blocks"))
    begin = turn * F.col("source_size") + number * block
    length = F.least(F.lit(block), F.col("source_size") - number * block)
    take = F.least(length, F.col("goal") - begin)
    return (plan.where("rank < need").select("slot", "source", turn.alias("pass"), number.alias("block"), take.alias("take"))
            .where("take > 0"))


def taken_words(placed: DataFrame, slots: DataFrame, block: int = BLOCK, passes: bool = False) -> DataFrame:
    """(source, bucket, rank, taken, first_slot): words the mix takes of each document that it takes from, and the
    slot with the first of them; passes: with ``uses``, all (pass, slot) that take from it."""
    spread = placed.where("size > 0").select(
        "source", "bucket", "rank", "start", "size",
        F.explode(F.sequence(F.floor(F.col("start") / block), F.floor((F.col("start") + F.col("size") - 1) / block))).alias("block"))
    into = spread.withColumn("from", F.greatest(F.col("start") - F.col("block") * block, F.lit(0)))
    into = into.withColumn("to", F.least(F.col("start") + F.col("size") - F.col("block") * block, F.lit(block)))
    uses = slots.select(F.col("source").alias("s_"), F.col("block").alias("b_"), "take", "slot", "pass")
    hit = into.join(uses, F.col("source").eqNullSafe(F.col("s_")) & (F.col("block") == F.col("b_")))
    words = F.greatest(F.least(F.col("to"), F.col("take")) - F.col("from"), F.lit(0))
    hit = hit.withColumn("words", words).where("words > 0")
    return hit.groupBy("source", "bucket", "rank").agg(
        F.sum("words").alias("taken"), F.min("slot").alias("first_slot"),
        *[F.collect_list(F.struct("pass", "slot")).alias("uses")] * passes)


def mix(docs: DataFrame, weights=WEIGHTS, share: float = SHARE, max_repeat: int = MAX_REPEAT,
        block: int = BLOCK) -> DataFrame:
    """(doc_id, size, source_size, target, taken, first_slot) for every row of docs (doc_id, text, source); first_slot
    is where in the mix the document comes first, null where nothing of it is taken."""
    keyed = docs.select("doc_id", "source", size_of(F.col("text")).alias("size"),
                        digest(F.col("doc_id"), F.col("text")).alias("d"))
    placed = C.staged(place(keyed), "placed")
    targets = C.staged(source_targets(placed, weights, share, max_repeat), "targets")
    taken = taken_words(placed, schedule(targets, block), block)
    out = _with_taken(placed, taken)
    per = targets.select(F.col("source").alias("s_"), "source_size", "target")
    return out.join(per, F.col("source").eqNullSafe(F.col("s_"))).select(
        "doc_id", "size", "source_size", "target", "taken", "first_slot")


def _with_taken(placed: DataFrame, taken: DataFrame) -> DataFrame:
    rest = [c for c in taken.columns if c not in ("source", "bucket", "rank")]
    few = taken.select(F.col("source").alias("t_"), F.col("bucket").alias("b_"), F.col("rank").alias("r_"), *rest)
    on = F.col("source").eqNullSafe(F.col("t_")) & (F.col("bucket") == F.col("b_")) & (F.col("rank") == F.col("r_"))
    return placed.join(few, on, "left").drop("t_", "b_", "r_").withColumn("taken", F.coalesce("taken", F.lit(0)).cast("long"))


def mixed_documents(docs: DataFrame, weights=WEIGHTS, share: float = SHARE, max_repeat: int = MAX_REPEAT,
                    block: int = BLOCK, slot: str | None = None) -> DataFrame:
    """The mix as documents: the columns of docs, one row per document and time it is taken; slot: the name of one more
    column with the slot at which the row begins, by which the mix is read in order.

    A whole repetition carries the text unchanged.  Where a source's target ends inside a document,
    the last row carries the words taken, joined by one space; all else goes."""
    placed = ordered(docs)
    small = C.staged(placed.drop("row"), "placed")
    targets = C.staged(source_targets(small, weights, share, max_repeat), "targets")
    taken = C.staged(taken_words(small, schedule(targets, block), block, passes=slot is not None), "taken")
    out = _with_taken(placed, taken).where("taken > 0")
    out = out.withColumn("part", F.explode(F.sequence(F.lit(0), F.ceil(F.col("taken") / F.col("size")) - 1)))
    words = F.least(F.col("size"), F.col("taken") - F.col("part") * F.col("size"))
    cut = F.array_join(F.slice(F.regexp_extract_all("row.text", F.lit(C.WORD), F.lit(0)), F.lit(1), words.cast("int")), " ")
    text = F.when(words == F.col("size"), F.col("row.text")).otherwise(cut)
    began = []
    if slot is not None:
        own = F.filter("uses", lambda u: u["pass"] == F.col("part"))
        began = [F.array_min(F.transform(own, lambda u: u["slot"])).alias(slot)]
    return out.select(*[text.alias(c) if c == "text" else F.col(f"row.`{c}`").alias(c) for c in docs.columns], *began)
