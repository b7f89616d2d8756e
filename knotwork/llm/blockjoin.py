"""Self-join of a sorted sequence in intervals, for distances that a few coordinates bound from below.

Rows are sorted by their coordinates and cut into intervals of bounded length. Intervals form a binary
tree; pairs of tree nodes are followed down level by level, and a pair whose bounding boxes are provably
too far apart goes no further. What is left are pairs of intervals, each compared exactly in one task.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import cut


def pack(rows: DataFrame, order: list[str], coords: int, payload: int, size: int) -> DataFrame:
    """Intervals of about ``size`` rows as (block, lo, hi, n, data).

    ``rows`` holds long ``node`` and ``weight``, ``at`` (an array of ``coords`` doubles) and ``body`` (a
    binary of ``payload`` bytes). ``data`` is node, weight, at and body of all rows one after another.
    """
    sub = max(1, size // 8)

    def cut_up(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pid, chunk, held, n = TaskContext.get().partitionId(), 0, [], 0

        def row(table: pa.Table) -> pa.RecordBatch:
            at = np.array(table.column("at").to_pylist(), dtype="<f8").reshape(len(table), coords)
            data = table.column("node").to_numpy().astype("<i8").tobytes() + table.column("weight").to_numpy().astype("<i8").tobytes()
            data += at.tobytes() + b"".join(table.column("body").to_pylist())
            cols = [[pid], [chunk], [len(table)], [at.min(0).tolist()], [at.max(0).tolist()], [data]]
            kinds = [pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.float64()), pa.list_(pa.float64()), pa.binary()]
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds, strict=True)], names=["pid", "chunk", "n", "lo", "hi", "data"])

        for part in parts:
            held.append(part)
            n += len(part)
            while n >= sub:
                table = pa.Table.from_batches(held)
                yield row(table.slice(0, sub))
                chunk, held, n = chunk + 1, table.slice(sub).to_batches(), n - sub
        if n:
            yield row(pa.Table.from_batches(held))

    kinds = "pid long, chunk long, n long, lo array<double>, hi array<double>, data binary"
    parts = rows.repartitionByRange(*order).sortWithinPartitions(*order).select("node", "weight", "at", "body")
    # range bounds come from a sample: what was cut is written down once
    subs = cut(parts.mapInArrow(cut_up, kinds))
    totals = subs.groupBy("pid").agg(F.sum("n").alias("n"))
    # a running sum over one short row for each range partition
    before = Window.orderBy("pid").rowsBetween(Window.unboundedPreceding, -1)
    starts = totals.select("pid", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start"))
    placed = subs.join(starts, "pid").withColumn("rank", F.col("start") + F.col("chunk") * sub)
    placed = placed.withColumn("block", F.floor(F.col("rank") / size)).select("block", "rank", "n", "data")

    def merge(key, table):
        table = table.sort_by("rank")
        got = [unpack(d, n, coords, payload) for d, n in zip(table.column("data").to_pylist(), table.column("n").to_pylist(), strict=True)]
        node, weight, at, body = (np.concatenate(x) for x in zip(*got, strict=True))
        data = node.tobytes() + weight.tobytes() + at.tobytes() + body.tobytes()
        cols = [[key[0].as_py()], [len(node)], [at.min(0).tolist()], [at.max(0).tolist()], [data]]
        kinds = [pa.int64(), pa.int64(), pa.list_(pa.float64()), pa.list_(pa.float64()), pa.binary()]
        return pa.table([pa.array(c, k) for c, k in zip(cols, kinds, strict=True)], names=["block", "n", "lo", "hi", "data"])

    return cut(placed.groupBy("block").applyInArrow(merge, "block long, n long, lo array<double>, hi array<double>, data binary"))


def unpack(data: bytes, n: int, coords: int, payload: int) -> tuple[np.ndarray, ...]:
    at = 16 * n
    node, weight = np.frombuffer(data, "<i8", n), np.frombuffer(data, "<i8", n, 8 * n)
    places = np.frombuffer(data, "<f8", n * coords, at).reshape(n, coords)
    body = np.frombuffer(data, np.uint8, n * payload, at + 8 * n * coords).reshape(n, payload)
    return node, weight, places, body


def near_pairs(blocks: DataFrame, coords: int, near: Callable[[list[Column]], Column]) -> DataFrame:
    """Pairs (i, j), i <= j, of intervals that may hold a pair; ``near`` judges the gaps of two boxes."""
    summary = cut(blocks.select("block", *[F.get("lo", F.lit(c)).alias(f"lo{c}") for c in range(coords)], *[F.get("hi", F.lit(c)).alias(f"hi{c}") for c in range(coords)]), short=True)
    top = summary.agg(F.max("block")).first()[0]
    levels = 0 if top is None else int(top).bit_length()
    pairs = summary.sparkSession.createDataFrame([(0, 0)] if top is not None else [], "i long, j long")
    for level in range(levels + 1):
        boxes = summary.groupBy(F.shiftright("block", levels - level).alias("b")).agg(
            *[F.min(f"lo{c}").alias(f"lo{c}") for c in range(coords)], *[F.max(f"hi{c}").alias(f"hi{c}") for c in range(coords)]
        )
        if level:
            kids = F.array(*[F.struct((2 * F.col("i") + a).alias("i"), (2 * F.col("j") + b).alias("j")) for a in (0, 1) for b in (0, 1)])
            pairs = pairs.select(F.explode(kids).alias("k")).select("k.i", "k.j").where("i <= j")
        left = boxes.select(F.col("b").alias("i"), *[F.col(f"{x}{c}").alias(f"{x}_i{c}") for c in range(coords) for x in ("lo", "hi")])
        right = boxes.select(F.col("b").alias("j"), *[F.col(f"{x}{c}").alias(f"{x}_j{c}") for c in range(coords) for x in ("lo", "hi")])
        gaps = [F.greatest(F.col(f"lo_i{c}") - F.col(f"hi_j{c}"), F.col(f"lo_j{c}") - F.col(f"hi_i{c}"), F.lit(0.0)) for c in range(coords)]
        pairs = pairs.join(left, "i").join(right, "j").where(near(gaps)).select("i", "j")
        if level % 4 == 3:
            pairs = cut(pairs, short=True)
    return cut(pairs, short=True)


def compare(blocks: DataFrame, pairs: DataFrame, run: Callable[[dict], pa.RecordBatch], kinds: str, *, tile: int | None = None) -> DataFrame:
    """Rows of ``run`` of each pair of intervals, a dict of i, j, n_i, data_i, n_j, data_j.

    Intervals form tiles of ``tile`` neighbours, 8 where that leaves all cores enough tasks. A task compares
    what is asked for of two tiles, so that an interval travels once for each tile that it has a partner in.
    """
    if tile is None:
        wanted = 8 * blocks.sparkSession.sparkContext.defaultParallelism
        tile = max(1, min(8, int(blocks.count() / math.sqrt(wanted))))
    asked = pairs.select(F.floor(F.col("i") / tile).alias("a"), F.floor(F.col("j") / tile).alias("b"), "i", "j")
    sent = asked.select("a", "b", F.explode(F.array("i", "j")).alias("block")).distinct().join(blocks.select("block", "n", "data"), "block")

    def tiles(sent: pa.Table, asked: pa.Table) -> Iterator[pa.RecordBatch]:
        rows = {b: (n, d) for b, n, d in zip(*(sent.column(c).to_pylist() for c in ("block", "n", "data")), strict=True)}
        for i, j in zip(asked.column("i").to_pylist(), asked.column("j").to_pylist(), strict=True):
            (n_i, data_i), (n_j, data_j) = rows[i], rows[j]
            yield run({"i": i, "j": j, "n_i": n_i, "data_i": data_i, "n_j": n_j, "data_j": data_j})

    def together(sent: pa.Table, asked: pa.Table) -> pa.Table:
        return pa.Table.from_batches(tiles(sent, asked))

    asked = asked.select(F.col("a").alias("tile_a"), F.col("b").alias("tile_b"), "i", "j")
    return sent.groupBy("a", "b").cogroup(asked.groupBy("tile_a", "tile_b")).applyInArrow(together, kinds)


class Links:
    """Spanning stars of the links among n rows, gathered from batches of pairs."""

    def __init__(self, n: int):
        self.root = np.arange(n)

    def add(self, a: np.ndarray, b: np.ndarray) -> None:
        root = self.root
        while True:
            x, y = root[a], root[b]
            differ = x != y
            if not differ.any():
                return
            a, b, x, y = a[differ], b[differ], x[differ], y[differ]
            np.minimum.at(root, np.maximum(x, y), np.minimum(x, y))
            while True:
                up = root[root]
                if np.array_equal(up, root):
                    break
                root[:] = up

    def stars(self) -> tuple[np.ndarray, np.ndarray]:
        leaf = np.flatnonzero(self.root != np.arange(len(self.root)))
        return leaf, self.root[leaf]
