"""Decision layer: features of an entity's scored list, a gate against entities without match, a policy."""

from __future__ import annotations

from dataclasses import asdict, dataclass
from itertools import product

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..sources import io
from . import metrics

ENTITY_FEATURES = ("max_prob", "second_prob", "third_prob", "gap_1_2", "gap_1_3", "n_candidates", "n_over_30", "n_over_50", "mean_prob", "sum_prob", "top1_is_s2", "top1_is_s3")


@dataclass(frozen=True)
class Policy:
    tau_gate: float = 0.30
    t_first: float = 0.52
    t_second: float = 0.35
    delta_margin: float = 0.12
    max_matches: int = 5


GRID = {"tau_gate": (0.25, 0.35, 0.45), "t_first": (0.45, 0.52, 0.60, 0.68), "t_second": (0.25, 0.35, 0.45), "delta_margin": (0.08, 0.12, 0.18), "max_matches": (4, 5, 6)}


def policy_grid() -> list[Policy]:
    """Combinations in order of the grid; a second threshold above the first is left out."""
    return [p for p in (Policy(*v) for v in product(*GRID.values())) if p.t_second <= p.t_first]


def ranked(scored: DataFrame) -> DataFrame:
    """``scored`` with ``rank`` from 1 by probability, ties by candidate."""
    return scored.withColumn("rank", F.row_number().over(Window.partitionBy("s1_id").orderBy(F.col("probability").desc(), "candidate_id")))


def entity_features(scored: DataFrame, spine: DataFrame) -> DataFrame:
    """Twelve columns for each id of ``spine`` (s1_id), all zero without candidates. One group-by over ranks."""
    p, rank = F.col("probability"), F.col("rank")

    def nth(n: int) -> Column:
        return F.coalesce(F.max(F.when(rank == n, p)), F.lit(0.0))

    top = F.max(F.when(rank == 1, F.col("candidate_id")))
    one = ranked(scored).groupBy("s1_id").agg(
        nth(1).alias("max_prob"), nth(2).alias("second_prob"), nth(3).alias("third_prob"),
        F.count("*").cast("double").alias("n_candidates"), F.count_if(p >= 0.30).cast("double").alias("n_over_30"), F.count_if(p >= 0.50).cast("double").alias("n_over_50"),
        F.avg(p).alias("mean_prob"), F.sum(p).alias("sum_prob"),
        top.startswith("S2-").cast("double").alias("top1_is_s2"), top.startswith("S3-").cast("double").alias("top1_is_s3"),
    )
    one = one.withColumns({"gap_1_2": F.col("max_prob") - F.col("second_prob"), "gap_1_3": F.col("max_prob") - F.col("third_prob")})
    return spine.select("s1_id").distinct().join(one, "s1_id", "left").select("s1_id", *[F.coalesce(c, F.lit(0.0)).alias(c) for c in ENTITY_FEATURES])


def decide(scored: DataFrame, gate: DataFrame, policy: Policy = Policy()) -> DataFrame:
    """(s1_id, candidate_id) accepted. ``gate`` is (s1_id, p_match).

    Nothing if the gate or the best candidate is too low; then the best, and others that are high enough and
    close enough to it, ``max_matches`` in all.
    """
    r = ranked(scored).join(gate, "s1_id").where(F.col("p_match") >= policy.tau_gate)
    top = F.max("probability").over(Window.partitionBy("s1_id"))
    r = r.withColumn("top", top).where(F.col("top") >= policy.t_first)
    near = (F.col("probability") >= policy.t_second) & (F.col("top") - F.col("probability") <= policy.delta_margin)
    # candidates come in order of probability, so those that qualify are a prefix of the list
    return r.where((F.col("rank") == 1) | near).where(F.col("rank") <= policy.max_matches).select("s1_id", "candidate_id")


def policy_scores(scored: DataFrame, gate: DataFrame, truth: DataFrame, spine: DataFrame, grid: list[Policy] | None = None) -> DataFrame:
    """(combo, f05) of every policy of the grid, in one pass over the scored pairs.

    Gate and first threshold only decide whether an entity has matches at all. So a pair is expanded to the
    other three parameters alone, an entity is summed under how many gates and first thresholds it passes,
    and policies add up those sums, of which there are as many as the grid has combinations.
    """
    grid = grid or policy_grid()
    rules = sorted({(p.t_second, p.delta_margin, p.max_matches) for p in grid})
    gates, firsts = sorted({p.tau_gate for p in grid}), sorted({p.t_first for p in grid})
    every = F.array(*[F.struct(F.lit(i).alias("rule"), F.lit(t).alias("t"), F.lit(d).alias("d"), F.lit(m).alias("m")) for i, (t, d, m) in enumerate(rules)])
    passed = lambda values, c: F.size(F.filter(F.array(*[F.lit(v) for v in values]), lambda v: F.col(c) >= v))
    r = ranked(scored).join(gate, "s1_id").withColumn("top", F.max("probability").over(Window.partitionBy("s1_id")))
    r = r.where((F.col("p_match") >= gates[0]) & (F.col("top") >= firsts[0])).withColumns({"gate": passed(gates, "p_match"), "first": passed(firsts, "top")})
    known = truth.select("s1_id", "candidate_id").distinct().withColumn("hit", F.lit(1))
    r = r.join(known, ["s1_id", "candidate_id"], "left")

    def accepts(p: Column) -> Column:
        near = (F.col("probability") >= p["t"]) & (F.col("top") - F.col("probability") <= p["d"])
        return ((F.col("rank") == 1) | near) & (F.col("rank") <= p["m"])

    each = r.select("s1_id", "gate", "first", "hit", F.explode(F.filter(every, accepts)["rule"]).alias("rule"))
    counts = each.groupBy("s1_id", "rule", "gate", "first").agg(F.count("*").alias("pred"), F.count("hit").alias("tp"))
    policies = [(i, rules.index((p.t_second, p.delta_margin, p.max_matches)), gates.index(p.tau_gate) + 1, firsts.index(p.t_first) + 1) for i, p in enumerate(grid)]
    policies = F.array(*[F.struct(*[F.lit(x).alias(n) for x, n in zip(p, ("combo", "rule", "gate", "first"), strict=True)]) for p in policies])
    known, total = metrics.truth_sizes(truth, spine)
    sums = counts.join(known, "s1_id").withColumn("gain", metrics.gain()).groupBy("rule", "gate", "first").agg(F.sum("gain").alias("gain"))
    mine = lambda p: (p["rule"] == F.col("rule")) & (p["gate"] <= F.col("gate")) & (p["first"] <= F.col("first"))
    gains = sums.select("gain", F.explode(F.filter(policies, mine)["combo"]).alias("combo")).groupBy("combo").agg(F.sum("gain").alias("gain"))
    return metrics.f05_from(gains, total, F.array(*[F.lit(i) for i in range(len(grid))]), "combo")


class DecisionLayer:
    def __init__(self, policy: Policy = Policy()):
        self.policy, self.gatekeeper, self.prior = policy, None, 0.0

    def fit(self, scored: DataFrame, truth: DataFrame, spine: DataFrame, tune: bool = True) -> DecisionLayer:
        """Gatekeeper on the entity features against having any match, then the best policy of the grid."""
        has = truth.select("s1_id").distinct().withColumn("label", F.lit(1.0))
        rows = entity_features(scored, spine).join(has, "s1_id", "left").withColumn("label", F.coalesce("label", F.lit(0.0))).persist()
        known = rows.agg(F.avg("label"), F.count("*")).first()
        self.prior = 1.0 - (known[0] or 0.0)
        if known[1] and 0.0 < known[0] < 1.0:
            stages = [VectorAssembler(inputCols=list(ENTITY_FEATURES), outputCol="_features"), GBTClassifier(featuresCol="_features", labelCol="label", maxIter=50, maxDepth=3, stepSize=0.05, seed=42)]
            self.gatekeeper = Pipeline(stages=stages).fit(rows)
        rows.unpersist()
        if tune:
            best = policy_scores(scored, self.gate(scored, spine), truth, spine).orderBy(F.round("f05", 12).desc(), "combo").first()
            self.policy = policy_grid()[best["combo"]] if best else self.policy
        return self

    def gate(self, scored: DataFrame, spine: DataFrame) -> DataFrame:
        """(s1_id, p_match): 0 without candidates; the best candidate's probability without a gatekeeper."""
        rows = entity_features(scored, spine)
        if self.gatekeeper is None:
            return rows.select("s1_id", F.col("max_prob").alias("p_match"))
        p = vector_to_array("probability")[1]
        return self.gatekeeper.transform(rows).select("s1_id", F.when(F.col("n_candidates") == 0, 0.0).otherwise(p).alias("p_match"))

    def predict(self, scored: DataFrame, spine: DataFrame) -> DataFrame:
        return decide(scored, self.gate(scored, spine), self.policy)

    def save(self, spark: SparkSession, path: str) -> None:
        if self.gatekeeper is not None:
            self.gatekeeper.write().overwrite().save(f"{path}/gate")
        io.write_json(spark, f"{path}/policy.json", {"policy": asdict(self.policy), "prior": self.prior, "gate": self.gatekeeper is not None})

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> DecisionLayer:
        about = io.read_json(spark, f"{path}/policy.json")
        if about is None:
            raise FileNotFoundError(f"{path}/policy.json")
        out = cls(Policy(**about["policy"]))
        out.prior = about["prior"]
        out.gatekeeper = PipelineModel.load(f"{path}/gate") if about["gate"] else None
        return out
