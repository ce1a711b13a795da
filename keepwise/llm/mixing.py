"""Mixing sources to target weights by a low-discrepancy schedule of equal-token blocks.

Each source is shuffled (by a digest of the id; without one, of the text) into one word stream
and cut into blocks of ``block_words``. Slots 0, 1, 2, ... map golden-ratio points through the
cumulative targets to a source, until the slots hold the mix's words; the r-th slot
of a source takes its r-th block (a further pass over the stream after the last one). What a source's slots fetched is
what the mix takes of it: within a few blocks of its target, as the points' discrepancy is small, and every prefix of the mix has the
target shares as nearly. DataFrame operations only; prefix sums and ranks run over buckets, and equal
rows are one row with a count until the end, so no task holds a whole source or a hot text.
"""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from keepwise.llm.common import free_name, saved, word_count

_SCALE = 1 << 31
_GOLDEN = 1327217885  # 2^31 / golden ratio, odd: a full period of low-discrepancy points
_CELLS = 1 << 12
_ROWS_PER_BUCKET = 4096
_SLOTS_PER_CHUNK = 1 << 14
_SLOTS = 1 << 20      # slots of a mix, about, where ``block_words`` is not given
_LEAST_BLOCK = 16
_COPIES = 4096        # equal rows told apart by a task at once
_SOURCE = ["no_source", "source"]


def _targets(sizes: DataFrame, weights: Sequence[float], share: float, passes: int) -> DataFrame:
    """Water filling over the source table: target = min(passes * size, weight * level), summing to share * total."""
    every, ranked = Window.partitionBy(), Window.orderBy(*_SOURCE)
    cycle = F.array(*(F.lit(float(w)) for w in weights))
    t = (sizes.withColumn("weight", F.element_at(cycle, F.pmod(F.row_number().over(ranked) - 1, F.lit(len(weights))) + 1))
         .withColumn("cap", F.col("source_size") * float(passes)))
    before = Window.orderBy(F.col("cap") / F.col("weight"), *_SOURCE).rowsBetween(Window.unboundedPreceding, -1)
    left = share * F.sum("source_size").over(every) - F.coalesce(F.sum("cap").over(before), F.lit(0.0))
    open_weight = F.sum("weight").over(every) - F.coalesce(F.sum("weight").over(before), F.lit(0.0))
    t = (t.withColumn("level", left / open_weight).withColumn("at", F.col("cap") / F.col("weight"))
         .withColumn("level", F.min(F.when(F.col("level") < F.col("at"), F.struct("at", *_SOURCE, "level"))).over(every)["level"]))
    target = F.when(F.col("level").isNull() | (F.col("at") <= F.col("level")), F.col("cap")).otherwise(F.col("weight") * F.col("level"))
    return t.select(*_SOURCE, "source_size", target.alias("target"))


def point(slot: Column) -> Column:
    """The golden-ratio point of a slot, 0 to 2^31 - 1."""
    return F.pmod(F.pmod(slot, F.lit(_SCALE)) * F.lit(_GOLDEN), F.lit(_SCALE))


def _needs(targets: DataFrame, block_words: int | None, passes: int) -> DataFrame:
    """Words wanted of each source (``want``), the words of a block, the blocks that each pass has (``visits``),
    the source's slice of the slot scale (lo, hi) and the number of slots of the mix."""
    t = targets.withColumn("want", F.least(F.round("target").cast("long"), F.col("source_size") * passes))
    every = Window.partitionBy()                                       # one row per source
    total = F.sum("want").over(every)
    words = F.lit(block_words) if block_words else F.greatest(F.lit(_LEAST_BLOCK), F.ceil(total / _SLOTS))
    t = t.withColumn("words", words.cast("long")).withColumn("slots", F.ceil(total / F.col("words")))
    part = [F.ceil(F.least(F.greatest(F.col("want") - p * F.col("source_size"), F.lit(0)), F.col("source_size")) / F.col("words"))
            for p in range(passes)]
    t = t.withColumn("visits", F.array(*part))
    upto = Window.orderBy(*_SOURCE).rowsBetween(Window.unboundedPreceding, 0)
    whole = F.greatest(total, F.lit(1)).cast("decimal(20,0)")
    edge = lambda x: F.floor(x.cast("decimal(18,0)") * F.lit(_SCALE).cast("decimal(10,0)") / whole).cast("long")
    return t.withColumn("hi", edge(F.sum("want").over(upto))).withColumn("lo", edge(F.sum("want").over(upto) - F.col("want")))


def _schedule(needs: DataFrame, slots: int) -> DataFrame:
    """(no_source, source, rank, slot): golden-ratio points mapped through the slices, ranked per source."""
    width = _SCALE // _CELLS
    slices = (needs.filter("hi > lo").select(*_SOURCE, "lo", "hi")
              .withColumn("cell", F.explode(F.sequence(F.floor(F.col("lo") / width), F.floor((F.col("hi") - 1) / width)))))
    drawn = (needs.sparkSession.range(slots).select(F.col("id").alias("slot"), point(F.col("id")).alias("point"))
             .withColumn("cell", F.floor(F.col("point") / width))
             .join(slices, "cell").filter("point >= lo and point < hi")
             .select(*_SOURCE, "slot", F.floor(F.col("slot") / _SLOTS_PER_CHUNK).alias("chunk")))
    counts = drawn.groupBy(*_SOURCE, "chunk").agg(F.count("*").alias("n"))
    earlier = Window.partitionBy(*_SOURCE).orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(*_SOURCE, "chunk", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("offset"))
    return (drawn.withColumn("rank", F.row_number().over(Window.partitionBy(*_SOURCE, "chunk").orderBy("slot")) - 1)
            .join(offsets, [*_SOURCE, "chunk"]).select(*_SOURCE, (F.col("rank") + F.col("offset")).alias("rank"), "slot"))


def _digest(id_col: Column, text: Column) -> Column:
    return F.coalesce(F.md5(id_col.cast("string")), F.md5(F.concat(F.lit("no id "), F.coalesce(text.cast("string"), F.lit("")))))


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
        weights: Sequence[float] = (5, 2, 1), share: float = 1.5, passes: int = 2,
        block_words: int | None = None) -> DataFrame:
    """One row per row of ``docs``: doc_id, source, size, source_size, target, taken, first_slot, slots, digest.

    ``size`` counts words (null text: 0). Sources in code-point order, null last,
    weigh ``weights`` in rotation and share ``share`` times all sizes; a target
    stops at ``passes`` times its source's size and the excess is reshared.
    ``taken`` is what the scheduled blocks fetched of the document, repeats counted, at most ``passes`` times its
    size; no source goes beyond its target. ``first_slot`` is the document's first place in the mix (null: not taken) and ``slots``
    the places where a pass takes its first word. Rows without words take nothing; equal rows are separate rows;
    rows of a null id are told apart by their texts; other columns are ignored; an
    empty table gives an empty table. Reruns agree whatever the partitioning. Without ``block_words`` the mix has about
    a million slots, of 16 words at least.
    """
    text = F.col(text_col).cast("string")
    keys = [*_SOURCE, "digest", "doc_id", "size"]
    rows = docs.select(
        F.col(id_col).cast("long").alias("doc_id"), F.col(source_col).isNull().alias("no_source"),
        F.coalesce(F.col(source_col).cast("string"), F.lit("")).alias("source"), word_count(text).alias("size"), _digest(F.col(id_col), text).alias("digest"))
    rows = saved(rows.groupBy(*keys).agg(F.count("*").alias("equal")), "sizes")          # equal rows: one row and their number
    needs = saved(_needs(_targets(rows.groupBy(*_SOURCE).agg(F.sum(F.col("size") * F.col("equal")).alias("source_size")), weights, share, passes),
                         block_words, passes), "needs")
    n_rows = rows.count()
    most = needs.agg(F.max("slots"), F.max("words")).first()
    slots, words = most[0] or 0, most[1] or 1

    buckets = max(1, -(-n_rows // _ROWS_PER_BUCKET))
    head = F.conv(F.substring("digest", 1, 8), 16, 10).cast("long")
    rows = rows.withColumn("bucket", F.floor(head * F.lit(buckets) / (1 << 32))).withColumn("weight", F.col("size") * F.col("equal"))
    sums = rows.groupBy(*_SOURCE, "bucket").agg(F.sum("weight").alias("n"))
    earlier = Window.partitionBy(*_SOURCE).orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (sums.select(*_SOURCE, "bucket", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("offset"))
               .join(needs.select(*_SOURCE, "source_size", "target"), _SOURCE))
    here = Window.partitionBy(*_SOURCE, "bucket").orderBy("digest", "doc_id", "size")
    placed = (rows.withColumn("start", F.sum("weight").over(here.rowsBetween(Window.unboundedPreceding, 0)) - F.col("weight"))
              .join(offsets, [*_SOURCE, "bucket"]).withColumn("start", F.col("start") + F.col("offset")))
    some = placed.withColumn("at", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("equal") - 1) / _COPIES))))
    copy = F.explode(F.sequence(F.col("at") * _COPIES, F.least(F.col("equal"), (F.col("at") + 1) * _COPIES) - 1))
    placed = some.withColumn("copy", copy).withColumn("start", F.col("start") + F.col("copy") * F.col("size"))
    blocks = F.sequence(F.floor(F.col("start") / words), F.floor((F.col("start") + F.col("size") - 1) / words))
    pieces = (placed.withColumn("block", F.explode_outer(F.when(F.col("size") > 0, blocks)))
              .withColumn("from", F.greatest("start", F.col("block") * words))
              .withColumn("to", F.least(F.col("start") + F.col("size"), (F.col("block") + 1) * words)))

    before = F.expr("aggregate(slice(visits, 1, pass), 0L, (a, x) -> a + x)")
    spans = (needs.select(*_SOURCE, "source_size", "want", F.posexplode("visits").alias("pass", "n"), "visits")
             .select(*_SOURCE, "pass", before.alias("first"), "n", (F.col("want") - F.col("pass") * F.col("source_size")).alias("limit")))
    visits = (_schedule(needs, slots).join(spans, _SOURCE).filter("rank >= first and rank < first + n")
              .select(*_SOURCE, (F.col("rank") - F.col("first")).alias("block"), "limit", "slot")
              .groupBy(*_SOURCE, "block").agg(F.sort_array(F.collect_list(F.struct("slot", "limit"))).alias("visits")))
    took = F.expr("aggregate(visits, 0L, (a, v) -> a + greatest(0L, least(to, v.limit) - from))")
    begins = F.expr("transform(filter(visits, v -> v.limit > from), v -> v.slot)")
    per_row = (pieces.join(visits, [*_SOURCE, "block"], "left")
               .groupBy(*keys, "copy", "source_size", "target", "start")
               .agg(F.sum(F.coalesce(took, F.lit(0))).alias("taken"), F.min(F.array_min(begins)).alias("first_slot"),
                    F.max(F.when(F.col("from") == F.col("start"), begins)).alias("slots")))
    return per_row.select("doc_id", F.when(~F.col("no_source"), F.col("source")).alias("source"), "size", "source_size",
                          "target", "taken", "first_slot", F.coalesce("slots", F.expr("cast(array() as array<long>)")).alias("slots"), "digest")


def mixed_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **settings) -> DataFrame:
    """The whole-document mix: every row of ``docs`` once per pass that takes its first word, with its own columns, in slot order.

    Rows that repeat a doc_id take the places of that id's longest list."""
    places = (mix(docs, id_col, text_col, **settings).filter(F.size("slots") > 0)
              .groupBy("digest").agg(F.max(F.struct(F.size("slots").alias("n"), "slots")).alias("p")).select("digest", "p.slots"))
    key, slot = free_name(docs, "mix_digest"), free_name(docs, "mix_slot")
    keyed = docs.withColumn(key, _digest(F.col(id_col), F.col(text_col)))
    joined = keyed.join(places, keyed[key] == places["digest"]).withColumn(slot, F.explode(places["slots"]))
    return joined.select(*[keyed[c] for c in docs.columns], slot).orderBy(slot).drop(slot)
