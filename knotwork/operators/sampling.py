"""Splitting and sampling. Chance is an md5 of salt and id, which any engine can repeat, ties by id."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def shuffle_key(column: Column | str, seed: int | str = 42) -> Column:
    c = F.col(column) if isinstance(column, str) else column
    return F.md5(F.concat(c.cast("string"), F.lit(f"-{seed}")))


def rank_in(df: DataFrame, strata: list[str], key: str, seed: int | str = 42, name: str = "rank") -> DataFrame:
    """Place of each row in its stratum's shuffle, from 1."""
    order = Window.partitionBy(*strata).orderBy(shuffle_key(key, seed), key)
    return df.withColumn(name, F.row_number().over(order))


def reservoir(df: DataFrame, strata: list[str], key: str, cap: int, seed: int | str = 42) -> DataFrame:
    """At most ``cap`` random rows a stratum; Spark keeps no more than that of each before the shuffle."""
    return rank_in(df, strata, key, seed, "_rank").where(F.col("_rank") <= cap).drop("_rank")


def match_category(n2: Column, n3: Column) -> Column:
    return F.when((n2 > 0) & (n3 > 0), "both").when(n2 > 0, "s2_only").when(n3 > 0, "s3_only").otherwise("singleton")


def entity_strata(s1: DataFrame, truth: DataFrame) -> DataFrame:
    """(s1_id, country, n_s2, n_s3, category); a blank country counts as US."""
    t = truth.groupBy("s1_id").agg(F.count_if(F.col("candidate_id").startswith("S2-")).alias("n_s2"), F.count_if(F.col("candidate_id").startswith("S3-")).alias("n_s3"))
    e = s1.select(F.col("entity_id").alias("s1_id"), F.coalesce(F.nullif("country", F.lit("")), F.lit("US")).alias("country")).join(t, "s1_id", "left").na.fill(0, ["n_s2", "n_s3"])
    return e.withColumn("category", match_category(F.col("n_s2"), F.col("n_s3")))


def largest_remainder(counts: DataFrame, total: int, strata: list[str]) -> DataFrame:
    """``counts`` (strata, n) with ``quota``: shares of ``total`` by n, whole numbers that sum to it.

    Floors first, then one each by largest remainder, ties by stratum. One row per stratum.
    """
    all_ = Window.partitionBy()
    exact = F.col("n") * F.lit(total) / F.sum("n").over(all_)
    q = counts.withColumn("_exact", exact).withColumn("_floor", F.floor("_exact").cast("long"))
    q = q.withColumn("_left", F.lit(total) - F.sum("_floor").over(all_))
    order = Window.orderBy(F.round(F.col("_exact") - F.col("_floor"), 9).desc(), *strata)
    q = q.withColumn("quota", F.col("_floor") + F.when(F.row_number().over(order) <= F.col("_left"), 1).otherwise(0))
    return q.drop("_exact", "_floor", "_left")


def quota_sample(df: DataFrame, quotas: DataFrame, strata: list[str], key: str, seed: int | str = 42) -> DataFrame:
    """``quota`` random rows of each stratum."""
    r = rank_in(df, strata, key, seed, "_rank")
    return r.join(quotas.select(*strata, "quota"), strata).where(F.col("_rank") <= F.col("quota")).select(*df.columns)


def disjoint_samples(df: DataFrame, strata: list[str], key: str, sizes: list[int], seed: int | str = 42) -> list[DataFrame]:
    """Stratified samples without common rows, the first one served first."""
    out, rest = [], df
    for size in sizes:
        quotas = largest_remainder(df.groupBy(*strata).agg(F.count("*").alias("n")), size, strata)
        got = quota_sample(rest, quotas, strata, key, seed)
        out.append(got)
        rest = rest.join(got.select(key), key, "left_anti")
    return out


def entity_split(spine: DataFrame, truth: DataFrame, *, val_fraction: float = 0.2, seed: int = 42, stratify: bool = True) -> DataFrame:
    """(s1_id, stratum, is_val): a share of each stratum (singleton, matched), one at least, is held out."""
    has = truth.select("s1_id").distinct().withColumn("_has", F.lit(1))
    e = spine.select("s1_id").distinct().join(has, "s1_id", "left")
    e = e.select("s1_id", (F.when(F.col("_has") == 1, "matched").otherwise("singleton") if stratify else F.lit("all")).alias("stratum"))
    n = e.groupBy("stratum").agg(F.count("*").alias("_n"))
    r = rank_in(e, ["stratum"], "s1_id", seed, "_rank").join(n, "stratum")
    return r.select("s1_id", "stratum", (F.col("_rank") <= F.greatest(F.lit(1), F.round(F.col("_n") * val_fraction))).alias("is_val"))


def quarantine(targets: DataFrame, truth: DataFrame, held_out: DataFrame) -> DataFrame:
    """Targets not linked to a held-out entity (s1_id)."""
    linked = truth.join(held_out.select("s1_id"), "s1_id", "left_semi").select(F.col("candidate_id").alias("entity_id")).distinct()
    return targets.join(linked, "entity_id", "left_anti")


def leakage(train: DataFrame, held_out: DataFrame, train_truth: DataFrame, held_truth: DataFrame) -> DataFrame:
    """One row of overlaps, all 0 without leakage: entities, and matched targets by source."""
    s1 = train.select("s1_id").intersect(held_out.select("s1_id")).agg(F.count("*").alias("s1_overlap"))
    both = train_truth.select("candidate_id").intersect(held_truth.select("candidate_id"))
    t = both.agg(F.count_if(F.col("candidate_id").startswith("S2-")).alias("s2_overlap"), F.count_if(F.col("candidate_id").startswith("S3-")).alias("s3_overlap"))
    return s1.join(F.broadcast(t))  # one row each


def assert_no_leakage(audit: DataFrame) -> None:
    row = audit.first().asDict()
    if any(row.values()):
        raise ValueError(f"leakage between splits: {row}")


def assign_folds(spine: DataFrame, k: int, seed: int = 42, key: str = "s1_id") -> DataFrame:
    """``spine`` with ``fold`` 0..k-1 by hash: folds are even up to chance and no task sees all rows."""
    return spine.withColumn("fold", F.pmod(F.conv(F.substring(shuffle_key(key, seed), 1, 8), 16, 10).cast("long"), F.lit(k)).cast("int"))


def cross_validate(spine: DataFrame, k: int, run: Callable[[int, DataFrame, DataFrame], DataFrame], seed: int = 42) -> DataFrame:
    """Union of the scorecards ``run`` (fold, training spine, held-out spine) gives."""
    folds = assign_folds(spine, k, seed).persist()
    out = None
    for i in range(k):
        card = run(i, folds.where(F.col("fold") != i).drop("fold"), folds.where(F.col("fold") == i).drop("fold"))
        out = card if out is None else out.unionByName(card)
    return out


def training_sample(s1: DataFrame, truth: DataFrame, *, size: int, matched_share: float = 0.8, seed: int = 42) -> DataFrame:
    """(s1_id): ``size`` entities, that share of them with a match; ``size`` 0 is all."""
    e = entity_strata(s1, truth).withColumn("matched", F.col("category") != "singleton")
    if not size:
        return e.select("s1_id")
    cap = F.when(F.col("matched"), int(size * matched_share)).otherwise(size - int(size * matched_share))
    return rank_in(e, ["matched"], "s1_id", seed, "_rank").where(F.col("_rank") <= cap).select("s1_id")


def calibrated_distractors(pool: DataFrame, used: DataFrame, *, size: int, empty_rate: float, us_share: float = 0.6, seed: int = 42) -> DataFrame:
    """``size`` unused rows (entity_id): US and India by share, addresses empty at ``empty_rate`` in each."""
    left = pool.join(used.select("entity_id"), "entity_id", "left_anti").where("country in ('US', 'India')")
    left = left.withColumn("_empty", F.coalesce("business_address", F.lit("")) == "")
    n_us = round(size * us_share)
    caps = {("US", True): round(n_us * empty_rate), ("India", True): round((size - n_us) * empty_rate)}
    caps |= {("US", False): n_us - caps["US", True], ("India", False): size - n_us - caps["India", True]}
    cap: Column = F.lit(0)
    for (country, empty), n in caps.items():
        cap = F.when((F.col("country") == country) & (F.col("_empty") == empty), n).otherwise(cap)
    return rank_in(left, ["country", "_empty"], "entity_id", seed, "_rank").where(F.col("_rank") <= cap).drop("_rank", "_empty")


def pool_scan(records: DataFrame, cap: int, seed: int = 42) -> DataFrame:
    """At most ``cap`` rows per country and empty or given address."""
    p = records.withColumn("is_empty", F.coalesce("business_address", F.lit("")) == "")
    return reservoir(p, ["country", "is_empty"], "entity_id", cap, seed)


def smoke_subset(s1: DataFrame, targets: DataFrame, truth: DataFrame, *, entities: int = 20, others: int = 200) -> tuple[DataFrame, DataFrame]:
    """A few entities by id, their true matches, and the first other targets."""
    few = s1.orderBy("entity_id").limit(entities)
    ids = few.select(F.col("entity_id").alias("s1_id"))
    wanted = truth.join(ids, "s1_id", "left_semi").select(F.col("candidate_id").alias("entity_id")).distinct()
    some = targets.orderBy("entity_id").limit(others).select("entity_id")
    return few, targets.join(wanted.union(some).distinct(), "entity_id", "left_semi")


