"""Mixing sources to target weights by weighted fair queueing.

Each source queues its shuffled documents, then the same queue once more. A copy's virtual finish time is
the source's cumulative tokens up to its end divided by the source's target. The mix is all copies in global
order of that time, truncated at the total budget. The budget is the sum of the targets, so it is used up
just when every source has been served its target, at time 1: truncation is a comparison with 1, and only
the mix itself, not its counts, has to be sorted.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import WORD, cut, row_keys

WEIGHTS = (5, 2, 1)


def targets(sizes: DataFrame, *, weights: tuple[int, ...] = WEIGHTS, share: float = 1.5, most: int = 2) -> DataFrame:
    """Per source: ``rank`` (by code point, null last), ``source_size`` and ``target``.

    The budget, ``share`` of all sizes, is split by weight; a source stops at ``most`` times its size and
    what it leaves is shared again by weight. That ends where every target is the smaller of its limit and
    a common level times its weight; the level is found over the sources in order of limit by weight.
    One row per source, so the windows are over a table of sources, not of documents.
    """
    by = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    order = Window.orderBy(F.col("source").asc_nulls_last())
    by = by.withColumn("rank", F.row_number().over(order) - 1)
    w = F.element_at(F.array(*[F.lit(x) for x in weights]), (F.col("rank") % len(weights) + 1).cast("int"))
    by = by.withColumn("w", w.cast("long")).withColumn("limit", F.lit(most) * F.col("source_size"))
    all_, up = Window.partitionBy(), Window.orderBy(F.col("limit") / F.col("w"), "rank").rowsBetween(Window.unboundedPreceding, -1)
    by = by.withColumns(
        {
            "budget": F.lit(share) * F.sum("source_size").over(all_),
            "left": F.sum("w").over(all_) - F.coalesce(F.sum("w").over(up), F.lit(0)),
            "full": F.coalesce(F.sum("limit").over(up), F.lit(0)),
        }
    )
    # the level if all before this source are full; the first source that it doesn't fill sets it
    level = (F.col("budget") - F.col("full")) / F.col("left")
    by = by.withColumn("level", level).withColumn("fits", F.col("level") * F.col("w") <= F.col("limit"))
    chosen = F.min(F.when(F.col("fits"), F.struct(F.col("limit") / F.col("w"), "rank", "level"))).over(all_)["level"]
    target = F.least(F.col("limit").cast("double"), F.coalesce(chosen * F.col("w"), F.col("limit").cast("double")))
    return by.select("source", "rank", "source_size", target.alias("target"))


def shuffled_key(salt: str) -> Column:
    return F.md5(F.concat(F.lit(salt), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))))


KEYS = ("_row0", "_row1")


def sizes_of(docs: DataFrame) -> DataFrame:
    """(_row0, _row1, doc_id, source, size, times) for each different row; the text is read here and nowhere else."""
    size = F.regexp_count(F.coalesce("text", F.lit("")), F.lit(WORD)).cast("long").alias("size")
    each = docs.select(*[c.alias(k) for k, c in row_keys("doc_id", "source", "text").items()], "doc_id", "source", size)
    return cut(each.groupBy(*KEYS, "doc_id", "source", "size").agg(F.count("*").alias("times")))


def schedule(sized: DataFrame, *, weights=WEIGHTS, share=1.5, most=2, salt: str = "mix-", few_sources: int = 50_000) -> DataFrame:
    """The rows of ``sizes_of`` with ``source_size``, ``target``, ``taken`` and ``finish`` (of the last copy taken, null: none).

    A copy that ends by its source's target is taken whole, the one that is being served then up to there: one
    document a source is cut. No partition holds a source: running sums are by source and a prefix of the
    shuffled key, offsets of the prefixes come from a table of their sums.
    """
    per = cut(targets(sized.select("source", (F.col("size") * F.col("times")).alias("size")), weights=weights, share=share, most=most))
    digits = max(1, min(8, math.ceil(math.log(max(sized.count(), 1) / 2_000 + 1, 16))))
    # few sources, as counted, travel to the documents; many are joined, and a hot one split by adaptive execution
    by_source = per.withColumnRenamed("source", "_source")
    by_source = F.broadcast(by_source) if per.count() <= few_sources else by_source
    queued = sized.join(by_source, F.col("source").eqNullSafe(F.col("_source"))).drop("_source")
    queued = queued.withColumns({"_key": shuffled_key(salt), "_all": F.col("size") * F.col("times")}).withColumn("_part", F.substring("_key", 1, digits))
    within = Window.partitionBy("rank", "_part").orderBy("_key", "doc_id", *KEYS).rowsBetween(Window.unboundedPreceding, 0)
    before = Window.partitionBy("rank").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    cells = queued.groupBy("rank", "_part").agg(F.sum("_all").alias("_cell"))
    cells = cells.select("rank", "_part", F.coalesce(F.sum("_cell").over(before), F.lit(0)).alias("_offset"))
    run = queued.withColumn("_in", F.sum("_all").over(within)).join(cells, ["rank", "_part"])
    start = F.col("_in") + F.col("_offset") - F.col("_all")
    limit = F.floor("target")
    served = [F.greatest(F.least(limit - start - F.lit(copy) * F.col("source_size"), F.col("_all")), F.lit(0)) for copy in range(most)]
    end = F.coalesce(*[F.when(got > 0, start + F.lit(copy) * F.col("source_size") + got) for copy, got in reversed(list(enumerate(served)))])
    taken = F.expr("cast(_served div times as long)")  # equal rows share what they are served
    out = run.withColumns({"_served": sum(served[1:], served[0]), "finish": end / F.col("target")}).withColumn("taken", taken)
    return out.select(*KEYS, "doc_id", "source", "size", "times", "source_size", "target", "taken", "finish")


def mix(docs: DataFrame, **options) -> DataFrame:
    """All columns of ``docs`` (those named like a result are replaced), ``size``, ``source_size``, ``target``, ``taken``, ``finish``.

    Sizes are words; null or empty text has none and takes none. ``taken`` is how many words the mix takes of a
    row, at most twice its size: whole copies but for one document a source, which the end of the budget
    cuts. The shuffle is an md5 order, ties by doc_id and then by a hash of the row, so reruns agree; rows
    of equal doc_id, source and text are queued together and share alike. A null source is a source. An
    empty table gives an empty table. Rows and their schedule meet in a join by a hash of the row.
    """
    docs = docs.drop("size", "source_size", "target", "taken", "finish").withColumns(row_keys("doc_id", "source", "text"))
    planned = schedule(sizes_of(docs), **options).select(*KEYS, "size", "source_size", "target", "taken", "finish")
    return docs.join(planned, list(KEYS)).drop(*KEYS)


def digest(docs: DataFrame) -> DataFrame:
    """The contract's columns; the text travels nowhere."""
    out = schedule(sizes_of(docs)).withColumn("_time", F.explode(F.sequence(F.lit(1), F.col("times").cast("int"))))
    return out.select("doc_id", "size", "source_size", "target", "taken")


def materialise(docs: DataFrame) -> DataFrame:
    """The mix as rows, in global order of finish times: each document as often as it is taken, a document
    without words once. A copy that the end of the budget cuts stays whole if half of it is taken, or else goes."""
    times = F.when(F.col("size") > 0, F.floor(F.col("taken") / F.col("size") + 0.5).cast("int")).otherwise(F.lit(1))
    rows = mix(docs).withColumn("_copy", F.explode(F.array_repeat(F.lit(0), times)))
    return rows.orderBy(F.col("finish").asc_nulls_last(), F.xxhash64("doc_id")).select(*docs.columns)
