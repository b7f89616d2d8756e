"""Batch runs: train or load, block, score, decide, write, evaluate; each stage resumes from what it wrote."""

from __future__ import annotations

import time
import uuid
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import blocking, metrics, model, sampling
from ..sources import io


@dataclass(frozen=True)
class RunConfig:
    """``max_train_entities`` 0 is all of them."""

    train_dir: str
    test_dir: str
    output_dir: str
    run_id: str = field(default_factory=lambda: time.strftime("%Y%m%d-%H%M%S-") + uuid.uuid4().hex[:6])
    max_train_entities: int = 50_000
    distractors: int = 100_000
    resume: bool = True
    smoke: bool = False
    re_score: bool = False
    candidate_pairs_path: str | None = None
    model_path: str | None = None
    mirror_dir: str | None = None
    model: model.ModelConfig = field(default_factory=model.ModelConfig)


def table(spark: SparkSession, folder: str, name: str, prefixes: tuple[str, ...]) -> DataFrame:
    return io.read_records(spark, io.find_table(spark, folder, name, prefixes))


def labels(spark: SparkSession, folder: str, prefixes: tuple[str, ...]) -> tuple[DataFrame, DataFrame]:
    """(truth pairs, spine) of a folder's ground truth."""
    return io.read_pairs(spark, io.find_table(spark, folder, "ground_truth", prefixes))


def scorecard(name: str, s1: DataFrame, targets: DataFrame, pairs: DataFrame, scored: DataFrame, predicted: DataFrame, truth: DataFrame, threshold: float) -> DataFrame:
    """One row with blocking, classifier and final metrics of one split."""
    spine = s1.select(F.col("entity_id").alias("s1_id"))
    cells = s1.count() * targets.count()
    block = blocking.blocking_recall(pairs, truth, spine, cells)
    label = model.label_pairs(scored, truth)
    conf, auc = metrics.confusion(label, threshold).withColumnRenamed("recall", "pair_recall"), metrics.roc_auc(label)
    final = metrics.macro_f05(predicted, truth, spine)
    micro = metrics.micro_precision_recall(predicted, truth, spine)
    one = block.join(F.broadcast(conf)).join(F.broadcast(auc)).join(F.broadcast(final)).join(F.broadcast(micro.select(F.col("tp").alias("final_tp"), "n_pred")))  # one row each
    return one.select(
        F.lit(name).alias("fold_name"), F.col("n_entities").alias("n_s1_entities"), "n_singletons", F.col("n_matched").alias("n_matched_entities"),
        F.col("true_pairs").alias("total_true_pairs"), F.col("captured").alias("blocking_captured_pairs"), F.col("recall").alias("blocking_pair_recall"),
        F.col("candidates").alias("total_candidates"), F.lit(cells).cast("long").alias("cartesian_space"), F.col("reduction").alias("candidate_reduction_rate"),
        F.col("avg_candidates").alias("candidates_per_entity"), F.col("tp").alias("classifier_tp"), F.col("fp").alias("classifier_fp"), F.col("fn").alias("classifier_fn"),
        F.col("tn").alias("classifier_tn"), F.col("precision").alias("classifier_pair_precision"), F.col("pair_recall").alias("classifier_pair_recall"),
        F.col("f1").alias("classifier_f1"), F.col("roc_auc").alias("classifier_roc_auc"), F.col("macro_f05").alias("official_macro_f05"),
        "singleton_macro_f05", "matched_macro_f05", F.col("n_pred").alias("final_pred_pairs"), F.col("final_tp").alias("final_true_positives"),
    )


class Run:
    def __init__(self, spark: SparkSession, config: RunConfig):
        self.spark, self.config = spark, config
        self.root = f"{config.output_dir}/runs/{config.run_id}"
        if config.re_score:
            for stage in ("score", "decide"):
                self.clear(stage)

    # markers: a stage is done if its file says so, and its output is a committed table
    def done(self, stage: str) -> bool:
        return self.config.resume and io.read_json(self.spark, f"{self.root}/{stage}.done") is not None

    def mark(self, stage: str, **facts) -> None:
        io.write_json(self.spark, f"{self.root}/{stage}.done", {"stage": stage, "at": time.strftime("%Y-%m-%dT%H:%M:%S"), **facts})

    def clear(self, stage: str) -> None:
        io.delete(self.spark, f"{self.root}/{stage}.done")

    def stage(self, name: str, make) -> DataFrame:
        """A stage's table: read if it was made before, else made, written and marked."""
        path = f"{self.root}/{name}"
        if not self.done(name):
            make().write.mode("overwrite").parquet(path)
            self.mark(name)
        return self.spark.read.parquet(path)

    def train(self) -> model.PairModel:
        c, spark = self.config, self.spark
        path = c.model_path or f"{self.root}/model"
        if (c.model_path or self.done("train")) and io.exists(spark, f"{path}/model.json"):
            return model.PairModel.load(spark, path)
        s1, s2, s3 = (table(spark, c.train_dir, f"source{k}", ("train",)) for k in (1, 2, 3))
        truth, _ = labels(spark, c.train_dir, ("train",))
        keep = sampling.training_sample(s1, truth, size=30 if c.smoke else c.max_train_entities)
        s1 = s1.join(keep.withColumnRenamed("s1_id", "entity_id"), "entity_id", "left_semi")
        truth = truth.join(keep, "s1_id", "left_semi")
        needed = truth.select(F.col("candidate_id").alias("entity_id"))
        s2, s3 = (io.sampled_subset(s, needed, distractors=2_000 if c.smoke else c.distractors) for s in (s2, s3))
        fitted = model.PairModel(c.model).fit(s1, s2, s3, truth)
        fitted.save(spark, path)
        self.mark("train", threshold=fitted.threshold)
        return fitted

    def execute(self) -> DataFrame:
        """Runs all stages; returns the matches (s1_id, candidate_id)."""
        c, spark = self.config, self.spark
        fitted = self.train()
        s1, s2, s3 = (table(spark, c.test_dir, f"source{k}", ("test", "train")) for k in (1, 2, 3))
        try:
            truth, _ = labels(spark, c.test_dir, ("test", "train"))
        except FileNotFoundError:
            truth = None
        if c.smoke:
            known = spark.createDataFrame([], "s1_id string, candidate_id string") if truth is None else truth
            s1, some = sampling.smoke_subset(s1, s2.unionByName(s3), known)
            s2, s3 = (some.where(F.col("entity_id").startswith(f"{tag}-")) for tag in ("S2", "S3"))
        spine = s1.select(F.col("entity_id").alias("s1_id"))
        pairs = self.candidates(s1, s2, s3, spine)
        scored = self.stage("score", lambda: fitted.score(s1, s2, s3, pairs))
        matches = self.stage("decide", lambda: fitted.decide(scored, spine))
        io.write_candidates(pairs, spine, f"{self.root}/candidate_pairs")
        io.write_matches(matches, spine, f"{self.root}/matching_results")
        if truth is not None:
            truth = truth.join(spine, "s1_id", "left_semi")
            card = scorecard("test", s1, s2.unionByName(s3), pairs, scored, matches, truth, fitted.threshold)
            io.write_json(spark, f"{self.root}/scorecard.json", card.first().asDict())
        self.mirror()
        return matches

    def candidates(self, s1: DataFrame, s2: DataFrame, s3: DataFrame, spine: DataFrame) -> DataFrame:
        """Given pairs if they cover every entity, else the blocker's."""
        c = self.config
        if c.candidate_pairs_path and io.exists(self.spark, c.candidate_pairs_path):
            pairs, covered = io.read_pairs(self.spark, c.candidate_pairs_path)
            if spine.join(covered, "s1_id", "left_anti").isEmpty():
                return pairs.join(spine, "s1_id", "left_semi")
        return self.stage("block", lambda: blocking.generate_candidates(s1, s2, s3, c.model.blocker))

    def mirror(self) -> None:
        """The run under its id and as the latest, if a second place is named."""
        if self.config.mirror_dir:
            for name in (f"runs/{self.config.run_id}", "latest"):
                io.copy(self.spark, self.root, f"{self.config.mirror_dir}/{name}")


def evaluate(fitted: model.PairModel, name: str, s1: DataFrame, s2: DataFrame, s3: DataFrame, truth: DataFrame) -> DataFrame:
    """Scorecard of a fitted model on one split."""
    spine = s1.select(F.col("entity_id").alias("s1_id"))
    pairs = blocking.generate_candidates(s1, s2, s3, fitted.config.blocker).persist()
    scored = fitted.score(s1, s2, s3, pairs).persist()
    return scorecard(name, s1, s2.unionByName(s3), pairs, scored, fitted.decide(scored, spine), truth, fitted.threshold)


def retune(spark: SparkSession, model_path: str, folder: str, target: str) -> DataFrame:
    """Fits a new decision layer for a saved model on a labelled folder, saves it, and returns its scorecard."""
    from ..operators.decision import DecisionLayer

    fitted = model.PairModel.load(spark, model_path)
    s1, s2, s3 = (table(spark, folder, f"source{k}", ("train", "test")) for k in (1, 2, 3))
    truth, _ = labels(spark, folder, ("train", "test"))
    scored = fitted.score(s1, s2, s3).persist()
    fitted.decision = DecisionLayer().fit(scored, truth, s1.select(F.col("entity_id").alias("s1_id")))
    fitted.decision.save(spark, target)
    return evaluate(fitted, "retuned", s1, s2, s3, truth)


def holdout(spark: SparkSession, train_dir: str, val_dir: str, config: model.ModelConfig = model.ModelConfig(), model_path: str | None = None) -> DataFrame:
    """Audits the two folders for leakage, trains or loads, and scores the second; any overlap is an error."""
    parts, sets = [], []
    for folder in (train_dir, val_dir):
        prefixes = ("train", "test") if folder == train_dir else ("test", "train")
        parts.append([table(spark, folder, f"source{k}", prefixes) for k in (1, 2, 3)])
        sets.append(labels(spark, folder, prefixes))
    ids = [p[0].select(F.col("entity_id").alias("s1_id")) for p in parts]
    sampling.assert_no_leakage(sampling.leakage(ids[0], ids[1], sets[0][0], sets[1][0]))
    fitted = model.PairModel.load(spark, model_path) if model_path else model.PairModel(config).fit(*parts[0], sets[0][0])
    return evaluate(fitted, "holdout", *parts[1], sets[1][0])


def split_run(s1: DataFrame, s2: DataFrame, s3: DataFrame, truth: DataFrame, config: model.ModelConfig = model.ModelConfig(), *, val_fraction: float = 0.2, seed: int = 42) -> DataFrame:
    """Splits by entity on the fly, quarantines held-out matches, trains on the rest, scores the held-out part."""
    spine = s1.select(F.col("entity_id").alias("s1_id"))
    marked = sampling.entity_split(spine, truth, val_fraction=val_fraction, seed=seed).persist()
    return _fit_and_score("split", s1, s2, s3, truth, marked.where("not is_val"), marked.where("is_val"), config)


def cross_validation(s1: DataFrame, s2: DataFrame, s3: DataFrame, truth: DataFrame, config: model.ModelConfig = model.ModelConfig(), *, k: int = 5, seed: int = 42) -> DataFrame:
    spine = s1.select(F.col("entity_id").alias("s1_id"))
    return sampling.cross_validate(spine, k, lambda i, train, held: _fit_and_score(f"fold{i}", s1, s2, s3, truth, train, held, config), seed)


def _fit_and_score(name: str, s1: DataFrame, s2: DataFrame, s3: DataFrame, truth: DataFrame, train: DataFrame, held: DataFrame, config: model.ModelConfig) -> DataFrame:
    def of(ids: DataFrame) -> tuple[DataFrame, DataFrame]:
        return s1.join(ids.select(F.col("s1_id").alias("entity_id")), "entity_id", "left_semi"), truth.join(ids.select("s1_id"), "s1_id", "left_semi")

    (s1_train, t_train), (s1_held, t_held) = of(train), of(held)
    fitted = model.PairModel(config).fit(s1_train, *[sampling.quarantine(s, truth, held) for s in (s2, s3)], t_train)
    return evaluate(fitted, name, s1_held, s2, s3, t_held)


def normalize_file(spark: SparkSession, source: str, target: str) -> None:
    io.write_normalized(io.read_records(spark, source, last_wins=False), target)

