"""Command line: run, train, decide, block, validate, report, evaluate, normalize, shard, sample."""

from __future__ import annotations

import argparse
import sys

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from ..operators import blocking, model, sampling, validate
from ..sources import io
from . import pipeline


def _parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="knotwork", description="Record linkage on Spark.")
    sub = top.add_subparsers(dest="command", required=True)

    p = sub.add_parser("run", help="train or load, block, score, decide, write, evaluate")
    for name in ("--train-dir", "--test-dir", "--output-dir"):
        p.add_argument(name, required=True)
    p.add_argument("--run-id")
    p.add_argument("--max-train-records", type=int, default=50_000, help="entities to train on; 0 is all")
    p.add_argument("--mirror-dir")
    p.add_argument("--candidate-pairs-path")
    p.add_argument("--model-path")
    for name in ("--no-resume", "--smoke-test", "--re-score", "--split-source-models", "--no-decision-layer", "--compat"):
        p.add_argument(name, action="store_true")

    p = sub.add_parser("train", help="fit and save a model, print its most important features")
    p.add_argument("--train-dir", required=True)
    p.add_argument("--model-path", required=True)
    p.add_argument("--threshold", type=float, default=0.50)
    for name in ("--split-source-models", "--no-decision-layer", "--compat"):
        p.add_argument(name, action="store_true")

    p = sub.add_parser("decide", help="fit a saved model's decision layer anew")
    for name in ("--train-dir", "--model-path", "--output-layer"):
        p.add_argument(name, required=True)

    p = sub.add_parser("report", help="counts and validation of result files as text")
    p.add_argument("--matching", required=True)
    p.add_argument("--candidate")
    p.add_argument("--test-dir", required=True)
    p.add_argument("--output", nargs="+", required=True)

    p = sub.add_parser("block", help="candidate pairs of a folder's sources")
    p.add_argument("-d", "--data-dir", required=True)
    p.add_argument("-o", "--output", required=True)
    p.add_argument("-k", "--k-neighbors", type=int, default=30)
    p.add_argument("--min-sim", type=float, default=0.12)
    p.add_argument("--eval", action="store_true")

    p = sub.add_parser("validate", help="rules of result files; exit status 1 on any error")
    p.add_argument("--matching", required=True)
    p.add_argument("--candidate")
    p.add_argument("--test-dir", required=True)
    p.add_argument("--check-ids", action="store_true")

    p = sub.add_parser("evaluate", help="scorecards: holdout, split or cv")
    p.add_argument("--mode", choices=("holdout", "split", "cv"), default="holdout")
    p.add_argument("--train-dir", required=True)
    p.add_argument("--val-dir")
    p.add_argument("--val-fraction", type=float, default=0.2)
    p.add_argument("--n-splits", type=int, default=5)
    p.add_argument("--seed", type=int, default=42)
    p.add_argument("--model-path")
    p.add_argument("--output-json")

    p = sub.add_parser("normalize", help="normalized copy of a record file")
    p.add_argument("-i", "--input", required=True)
    p.add_argument("-o", "--output", required=True)

    p = sub.add_parser("shard", help="shards of a folder's tables")
    p.add_argument("--dataset-dir", required=True)
    p.add_argument("--output-dir", required=True)
    p.add_argument("--lines-per-shard", type=int, default=500_000)
    p.add_argument("--no-gz", action="store_true")

    p = sub.add_parser("sample", help="disjoint stratified test and training sets")
    p.add_argument("--data-dir", required=True)
    p.add_argument("--output-dir", required=True)
    p.add_argument("--n-test", type=int, default=20)
    p.add_argument("--n-train", type=int, default=80)
    p.add_argument("--seed", type=int, default=42)
    p.add_argument("--no-distractors", action="store_true")
    p.add_argument("--distractor-ratio", type=float, default=0.608)
    return top


def _sources(spark: SparkSession, folder: str) -> list:
    return [pipeline.table(spark, folder, f"source{k}", ("train", "test")) for k in (1, 2, 3)]


def _block(spark: SparkSession, a: argparse.Namespace) -> int:
    s1, s2, s3 = _sources(spark, a.data_dir)
    pairs = blocking.generate_candidates(s1, s2, s3, blocking.BlockerConfig(k_neighbors=a.k_neighbors, min_similarity=a.min_sim)).persist()
    spine = s1.select(F.col("entity_id").alias("s1_id"))
    io.write_candidates(pairs, spine, a.output)
    if a.eval:
        truth, known = pipeline.labels(spark, a.data_dir, ("train", "test"))
        blocking.blocking_recall(pairs, truth, known, s1.count() * (s2.count() + s3.count())).show(truncate=False)
    return 0


def _evaluate(spark: SparkSession, a: argparse.Namespace) -> int:
    if a.mode == "holdout":
        card = pipeline.holdout(spark, a.train_dir, a.val_dir, model_path=a.model_path)
    else:
        truth, _ = pipeline.labels(spark, a.train_dir, ("train",))
        parts = (*_sources(spark, a.train_dir), truth)
        card = pipeline.split_run(*parts, val_fraction=a.val_fraction, seed=a.seed) if a.mode == "split" else pipeline.cross_validation(*parts, k=a.n_splits, seed=a.seed)
    card = card.persist()
    card.show(truncate=False, vertical=True)
    if a.mode == "cv":
        from ..operators.metrics import mean_and_std

        mean_and_std(card, ["official_macro_f05", "classifier_f1", "blocking_pair_recall"]).show(truncate=False)
    if a.output_json:
        io.write_json(spark, a.output_json, [r.asDict() for r in card.collect()])
    return 0


def _sample(spark: SparkSession, a: argparse.Namespace) -> int:
    s1, s2, s3 = _sources(spark, a.data_dir)
    truth, _ = pipeline.labels(spark, a.data_dir, ("train",))
    strata = sampling.entity_strata(s1, truth).select(F.col("s1_id").alias("entity_id"), F.col("country").alias("_c"), "category")
    parts = sampling.disjoint_samples(strata, ["_c", "category"], "entity_id", [a.n_test, a.n_train], a.seed)
    used = truth.select(F.col("candidate_id").alias("entity_id")).distinct()
    for name, ids in zip(("test", "train"), parts, strict=True):
        out = f"{a.output_dir}/{name}"
        mine = truth.join(ids.select(F.col("entity_id").alias("s1_id")), "s1_id", "left_semi")
        io.write_tsv(s1.join(ids.select("entity_id"), "entity_id", "left_semi"), f"{out}/{name}_source1.tsv", order="entity_id", single=True)
        for k, s, rate in ((2, s2, 0.03356), (3, s3, 0.03328)):
            got = s.join(mine.select(F.col("candidate_id").alias("entity_id")), "entity_id", "left_semi")
            if not a.no_distractors:
                # the two sets draw from different halves of the unmatched records
                half = s.where(F.pmod(F.xxhash64("entity_id"), F.lit(2)) == int(name == "train"))
                got = got.unionByName(sampling.calibrated_distractors(half, used, size=round(got.count() * a.distractor_ratio), empty_rate=rate, seed=a.seed))
            io.write_tsv(got, f"{out}/{name}_source{k}.tsv", order="entity_id", single=True)
        io.write_matches(mine, ids.select(F.col("entity_id").alias("s1_id")), f"{out}/{name}_ground_truth.tsv", single=True)
    return 0


def _train(spark: SparkSession, a: argparse.Namespace) -> int:
    truth, _ = pipeline.labels(spark, a.train_dir, ("train",))
    config = model.ModelConfig(threshold=a.threshold, split_source_models=a.split_source_models, use_decision_layer=not a.no_decision_layer, compat=a.compat)
    fitted = model.PairModel(config).fit(*_sources(spark, a.train_dir), truth)
    fitted.save(spark, a.model_path)
    for name, share in fitted.importances():
        print(f"{name}\t{share:.4f}")
    return 0


def _decide(spark: SparkSession, a: argparse.Namespace) -> int:
    pipeline.retune(spark, a.model_path, a.train_dir, a.output_layer).show(truncate=False, vertical=True)
    return 0


def _report(spark: SparkSession, a: argparse.Namespace) -> int:
    print(validate.audit_report(spark, a.matching, a.candidate, a.test_dir, a.output), end="")
    return 0


def main(argv: list[str] | None = None) -> int:
    a = _parser().parse_args(argv)
    spark = SparkSession.builder.appName("knotwork").getOrCreate()
    if a.command == "run":
        settings = model.ModelConfig(split_source_models=a.split_source_models, use_decision_layer=not a.no_decision_layer, compat=a.compat)
        extra = {"run_id": a.run_id} if a.run_id else {}
        config = pipeline.RunConfig(
            a.train_dir, a.test_dir, a.output_dir, max_train_entities=a.max_train_records, resume=not a.no_resume, smoke=a.smoke_test, re_score=a.re_score,
            candidate_pairs_path=a.candidate_pairs_path, model_path=a.model_path, mirror_dir=a.mirror_dir, model=settings, **extra,
        )
        pipeline.Run(spark, config).execute()
        return 0
    if a.command == "validate":
        errors, warnings = validate.validate(spark, a.matching, a.candidate, a.test_dir, check_ids=a.check_ids)
        for kind, lines in (("error", errors), ("warning", warnings)):
            for line in lines:
                print(f"{kind}: {line}", file=sys.stderr)
        return int(bool(errors))
    if a.command == "normalize":
        pipeline.normalize_file(spark, a.input, a.output)
        return 0
    if a.command == "shard":
        io.write_folder_shards(spark, a.dataset_dir, a.output_dir, rows=a.lines_per_shard, gz=not a.no_gz)
        return 0
    commands = {"train": _train, "decide": _decide, "report": _report, "block": _block, "evaluate": _evaluate, "sample": _sample}
    return commands[a.command](spark, a)


if __name__ == "__main__":
    sys.exit(main())
