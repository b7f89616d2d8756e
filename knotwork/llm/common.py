"""Helpers shared by the training-data operators.

Nothing here reads a store from Python or keeps state on one machine: data moves between steps only
through shuffles and ``DataFrame.checkpoint`` in the folder that ``spark.checkpoint.dir`` names.
"""

from __future__ import annotations

import re
import tempfile

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: ASCII white space: the separators of words in every contract.
SPACE = " \t\n\x0b\x0c\r"
#: Java regular expression for one word.
WORD = r"[^\x20\x09-\x0D]+"
GAP = r"[\x20\x09-\x0D]+"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = "abcdefghijklmnopqrstuvwxyz"


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Use the cluster's shared folder. Only a session of one machine that names none gets a folder of its own."""
    if spark.sparkContext.getCheckpointDir() is None:
        named = spark.conf.get("spark.checkpoint.dir", None)
        if named is None and not re.fullmatch(r"local(\[[\d*,]+\])?", spark.sparkContext.master):
            raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
        spark.sparkContext.setCheckpointDir(named or tempfile.mkdtemp(prefix="knotwork-checkpoint-"))


def cut(df: DataFrame, *, short: bool = False) -> DataFrame:
    """Write the rows to the shared checkpoint folder once and go on from there.

    Later plans read the files, so a lost executor costs no earlier stage. ``short`` is for rows of a few
    numbers: they go to no more files than twice the cores, not to one for each shuffle partition.
    """
    ensure_checkpoint_dir(df.sparkSession)
    if short:
        df = df.coalesce(2 * df.sparkSession.sparkContext.defaultParallelism)
    return df.checkpoint(eager=True)


def row_keys(*columns: str) -> dict[str, Column]:
    """``_row0``, ``_row1``: 128 bits that tell rows apart by these columns, nulls included; ids may repeat or be null."""
    parts = [x for c in columns for x in (F.isnull(c), F.col(c).cast("string"))]
    return {f"_row{salt}": F.xxhash64(F.lit(salt), *parts) for salt in (0, 1)}


def ascii_lower(text: Column) -> Column:
    """Lower-case A-Z and nothing else; pure-ASCII values take the vectorised ``lower``."""
    return F.when(F.octet_length(text) == F.char_length(text), F.lower(text)).otherwise(F.translate(text, UPPER, LOWER))


def strip_ascii(text: Column) -> Column:
    return F.btrim(text, F.lit(SPACE))


def sha256_hex(text: Column) -> Column:
    return F.sha2(F.encode(text, "UTF-8"), 256)


def words_of(text: Column) -> Column:
    """Array of words; null text has none."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), GAP), lambda w: w != "")


def components(edges: DataFrame) -> DataFrame:
    """Smallest node reachable from each node of an undirected graph.

    ``edges`` has long columns ``u`` and ``v``. Returns ``node``, ``component`` for every node named by
    an edge; nodes without edges are not in the result. Alternates large-star and small-star rewrites,
    each a partially aggregated minimum and a join that adaptive execution may split on a hub, until no
    edge changes. Nothing but two scalars a round reaches the driver.
    """
    stars = cut(edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), short=True)
    seen = None
    while True:  # each round moves edges to smaller nodes, so it ends
        # large star: every larger neighbour of u moves to the smallest node around u
        both = stars.unionByName(stars.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = (
            both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        )
        # small star: u's smaller neighbours, and u, move to the smallest of them
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        moved = large.join(low, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        stars = cut(moved.unionByName(low.select("u", F.col("m").alias("v"))).distinct(), short=True)
        # the sum of hashes is a fingerprint of the edge set; modulo keeps it in a long
        now = stars.agg(F.count("*"), F.sum(F.pmod(F.xxhash64("u", "v"), F.lit(1 << 40)))).first()
        if now == seen:
            break
        seen = now
    down = stars.groupBy("u").agg(F.min("v").alias("component")).withColumnRenamed("u", "node")
    roots = down.select(F.col("component").alias("node"), "component").distinct()
    return down.unionByName(roots)
