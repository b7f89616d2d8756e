"""Metrics over pairs and entities as aggregates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

PAIR = ["s1_id", "candidate_id"]


def f05(pred: Column, true: Column, tp: Column) -> Column:
    """One entity's F0.5: 1 if nothing was to be found and nothing was; 0 if only one side is empty or none agree."""
    p, r = tp / pred, tp / true
    return F.when((pred == 0) & (true == 0), 1.0).when((pred == 0) | (true == 0) | (tp == 0), 0.0).otherwise(1.25 * p * r / (0.25 * p + r))


def entity_counts(predicted: DataFrame, truth: DataFrame, spine: DataFrame) -> DataFrame:
    """(s1_id, n_pred, n_true, tp) for each id of ``spine`` (s1_id). Pairs are (s1_id, candidate_id)."""
    p = predicted.select(*PAIR).distinct().withColumn("in_pred", F.lit(1))
    t = truth.select(*PAIR).distinct().withColumn("in_true", F.lit(1))
    both = p.join(t, PAIR, "full_outer").groupBy("s1_id").agg(F.count("in_pred").alias("n_pred"), F.count("in_true").alias("n_true"), F.count_if(F.col("in_pred").isNotNull() & F.col("in_true").isNotNull()).alias("tp"))
    return spine.select("s1_id").distinct().join(both, "s1_id", "left").select("s1_id", *[F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in ("n_pred", "n_true", "tp")])


def entity_f05(predicted: DataFrame, truth: DataFrame, spine: DataFrame) -> DataFrame:
    counts = entity_counts(predicted, truth, spine)
    return counts.withColumn("f05", f05(F.col("n_pred"), F.col("n_true"), F.col("tp")))


def macro_f05(predicted: DataFrame, truth: DataFrame, spine: DataFrame) -> DataFrame:
    """One row: means over all, singleton and matched entities (0 over all of none, 1 over no singleton or match) and counts."""
    e = entity_f05(predicted, truth, spine)
    single, matched = F.col("n_true") == 0, F.col("n_true") > 0
    return e.agg(
        F.coalesce(F.avg("f05"), F.lit(0.0)).alias("macro_f05"),
        F.coalesce(F.avg(F.when(single, F.col("f05"))), F.lit(1.0)).alias("singleton_macro_f05"), F.coalesce(F.avg(F.when(matched, F.col("f05"))), F.lit(1.0)).alias("matched_macro_f05"),
        F.count("*").alias("n_entities"), F.count_if(single).alias("n_singletons"), F.count_if(matched).alias("n_matched"),
    )


def truth_sizes(truth: DataFrame, spine: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(s1_id, true) for each entity, and one row of how many entities there are and how many without truth."""
    true = truth.select(*PAIR).distinct().groupBy("s1_id").agg(F.count("*").alias("true"))
    known = spine.select("s1_id").distinct().join(true, "s1_id", "left").select("s1_id", F.coalesce("true", F.lit(0)).alias("true"))
    return known, known.agg(F.count("*").alias("n"), F.count_if(F.col("true") == 0).alias("single"))


def gain() -> Column:
    """F0.5 of columns pred, true, tp above that of predicting nothing, which is 1 without truth, else 0."""
    return f05(F.col("pred"), F.col("true"), F.col("tp")) - F.when(F.col("true") == 0, 1.0).otherwise(0.0)


def f05_from(gains: DataFrame, total: DataFrame, values: Column, name: str) -> DataFrame:
    """(name, f05) for each of ``values``: the sum over all entities starts from those without truth; ``gains`` correct it."""
    grid = total.select("n", "single", F.explode(values).alias(name))  # one row, times the grid
    return grid.join(gains, name, "left").select(name, F.when(F.col("n") == 0, 0.0).otherwise((F.col("single") + F.coalesce("gain", F.lit(0.0))) / F.col("n")).alias("f05"))


def f05_over(counts: DataFrame, truth: DataFrame, spine: DataFrame, values: Column, name: str) -> DataFrame:
    """(name, f05): macro F0.5 at each of ``values`` from (s1_id, name, pred, tp), where an entity without row has no prediction."""
    known, total = truth_sizes(truth, spine)
    gains = counts.join(known, "s1_id").groupBy(name).agg(F.sum(gain()).alias("gain"))
    return f05_from(gains, total, values, name)


def micro_precision_recall(predicted: DataFrame, truth: DataFrame, spine: DataFrame) -> DataFrame:
    """One row of tp, n_pred, n_true, precision, recall; 1 where there is nothing to divide by."""
    s = entity_counts(predicted, truth, spine).agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("tp", "n_pred", "n_true")])
    return s.select("tp", "n_pred", "n_true", _share("tp", "n_pred").alias("precision"), _share("tp", "n_true").alias("recall"))


def _share(a: str, b: str) -> Column:
    return F.when(F.col(b) == 0, 1.0).otherwise(F.col(a) / F.col(b))


def confusion(scored: DataFrame, threshold: float) -> DataFrame:
    """One row of tp, fp, fn, tn, precision, recall, f1 over candidate pairs (label 0/1, probability)."""
    hit, true = F.col("probability") >= threshold, F.col("label") == 1
    c = scored.agg(F.count_if(hit & true).alias("tp"), F.count_if(hit & ~true).alias("fp"), F.count_if(~hit & true).alias("fn"), F.count_if(~hit & ~true).alias("tn"))
    c = c.withColumns({"_p": F.col("tp") + F.col("fp"), "_t": F.col("tp") + F.col("fn")})
    c = c.withColumns({"precision": _share("tp", "_p"), "recall": _share("tp", "_t"), "_n": 2 * F.col("tp") + F.col("fp") + F.col("fn")})
    return c.withColumn("f1", F.when(F.col("_n") == 0, 1.0).otherwise(2 * F.col("tp") / F.col("_n"))).drop("_p", "_t", "_n")


def roc_auc(scored: DataFrame) -> DataFrame:
    """One row: exact area under the curve, 1 with a single class.

    Rank sums with ties at their mean, over counts by distinct score: the only ordered window runs over
    ranges of scores, not over rows.
    """
    by = scored.groupBy("probability").agg(F.count_if(F.col("label") == 1).alias("pos"), F.count_if(F.col("label") != 1).alias("neg"))
    by = by.withColumn("_cell", F.floor(F.col("probability") * 1024))
    cells = by.groupBy("_cell").agg(F.sum("neg").alias("_n"))
    below = Window.orderBy("_cell").rowsBetween(Window.unboundedPreceding, -1)
    cells = cells.withColumn("_below", F.coalesce(F.sum("_n").over(below), F.lit(0))).drop("_n")
    within = Window.partitionBy("_cell").orderBy("probability").rowsBetween(Window.unboundedPreceding, -1)
    ranked = by.join(cells, "_cell").withColumn("lower", F.col("_below") + F.coalesce(F.sum("neg").over(within), F.lit(0)))
    s = ranked.agg(F.sum(F.col("pos") * (F.col("lower") + F.col("neg") / 2)).alias("u"), F.sum("pos").alias("p"), F.sum("neg").alias("n"))
    return s.select(F.when(F.coalesce(F.col("p") * F.col("n"), F.lit(0)) == 0, 1.0).otherwise(F.col("u") / (F.col("p") * F.col("n"))).alias("roc_auc"))


def beta_scores(precision: Column, recall: Column, beta: float) -> Column:
    """F-beta of two shares: what F1 and F0.5 make of the same precision and recall."""
    b = beta * beta
    return F.when(precision + recall == 0, 0.0).otherwise((1 + b) * precision * recall / (b * precision + recall))


def mean_and_std(folds: DataFrame, columns: list[str]) -> DataFrame:
    """Mean and population deviation of metrics over folds."""
    return folds.agg(*[f(c).alias(f"{n}_{c}") for c in columns for n, f in (("mean", F.avg), ("std", F.stddev_pop))])


def split_statistics(s1: DataFrame, targets: DataFrame, truth: DataFrame) -> DataFrame:
    """One row: shares of countries and match categories, mean matches, shares of empty addresses."""
    t = truth.groupBy("s1_id").agg(F.count_if(F.col("candidate_id").startswith("S2-")).alias("n2"), F.count_if(F.col("candidate_id").startswith("S3-")).alias("n3"))
    e = s1.select(F.col("entity_id").alias("s1_id"), "country").join(t, "s1_id", "left").na.fill(0, ["n2", "n3"])
    share = lambda c: F.avg(F.when(c, 1.0).otherwise(0.0))
    left = e.agg(
        F.count("*").alias("n_s1"), share(F.col("country") == "US").alias("us_share"), share(F.col("country") == "India").alias("india_share"),
        share((F.col("n2") > 0) & (F.col("n3") > 0)).alias("both_share"), share((F.col("n2") > 0) & (F.col("n3") == 0)).alias("s2_only_share"),
        share((F.col("n2") == 0) & (F.col("n3") > 0)).alias("s3_only_share"), share((F.col("n2") == 0) & (F.col("n3") == 0)).alias("singleton_share"),
        F.avg("n2").alias("avg_s2"), F.avg("n3").alias("avg_s3"),
    )
    empty = F.coalesce("business_address", F.lit("")) == ""
    of = lambda k: F.avg(F.when(F.col("entity_id").startswith(k), F.when(empty, 1.0).otherwise(0.0)))
    right = targets.agg(of("S2-").alias("s2_empty_share"), of("S3-").alias("s3_empty_share"))
    return left.join(F.broadcast(right))  # one row each


def file_integrity(lists: DataFrame) -> DataFrame:
    """One row over (s1_id, ids array): rows, non-empty, empty, ids in all, repeated s1 ids."""
    a = lists.agg(F.count("*").alias("n_rows"), F.count_if(F.size("ids") > 0).alias("n_non_empty"), F.count_if(F.size("ids") == 0).alias("n_empty"), F.coalesce(F.sum(F.size("ids")), F.lit(0)).alias("n_ids"), F.count_distinct("s1_id").alias("_d"))
    return a.select("n_rows", "n_non_empty", "n_empty", "n_ids", (F.col("n_rows") - F.col("_d")).alias("n_duplicates"))
