"""Blocking, ranking, decision, metrics, sampling and validation on small hand-worked data."""

import collections
import math

import pytest
from pyspark.sql import functions as F

from knotwork.operators import blocking, decision, features, metrics, model, sampling, tfidf, validate

RECORD = "entity_id string, business_name string, business_address string, country string"


@pytest.fixture(scope="module")
def records(spark):
    s1 = [("S1-1", "Blue Stone LLC", "12 Oak St, Raleigh, NC 27601", "US"), ("S1-2", "Red Kite", "", "US"), ("S1-3", "Lone Wolf", "1 Far Rd, Troy, NY", "US")]
    s2 = [("S2-1", "Blue Stone", "12 Oak Street, Raleigh, North Carolina", "US"), ("S2-2", "Kite Red Inc", "5 Elm", "US"), ("S2-3", "Blue Stone", "9 Bay", "India")]
    s3 = [("S3-1", "Blue Stones", "12 Oak Str Raleigh NC", "US")]
    return tuple(spark.createDataFrame(x, RECORD) for x in (s1, s2, s3))


def pairs_of(df):
    return {(r[0], r[1]) for r in df.select("s1_id", "candidate_id").collect()}


def test_block_keys(records):
    got = [r["key"] for r in blocking.record_keys(records[0].where("entity_id = 'S1-1'")).orderBy("key_order").collect()]
    assert got == ["st_nm3:US:nc:blu", "st_nm4:US:nc:blue", "zip_nm:US:27601:blu", "num_street:US:12:rale", "nm_sort4:US:blue", "st_soundex:US:nc:B400"]
    wide = blocking.BlockerConfig(nationwide_soundex=True)
    assert "soundex:US:R300" in {r["key"] for r in blocking.record_keys(records[0], wide).collect()}


def test_candidates(records):
    s1, s2, s3 = records
    rules = blocking.BlockerConfig(use_tfidf=False)
    assert pairs_of(blocking.generate_candidates(s1, s2, s3, rules)) == {("S1-1", "S2-1"), ("S1-1", "S3-1"), ("S1-2", "S2-2")}
    assert pairs_of(blocking.generate_candidates(s1, s2, s3)) >= {("S1-1", "S2-1"), ("S1-2", "S2-2")}
    none = blocking.BlockerConfig(max_key_targets=0, use_tfidf=False)
    assert pairs_of(blocking.generate_candidates(s1, s2, s3, none)) == set()
    capped = blocking.BlockerConfig(max_candidates=1, use_tfidf=False)
    pairs = blocking.generate_candidates(s1, s2, s3, capped)
    assert pairs_of(pairs) == {("S1-1", "S2-1"), ("S1-2", "S2-2")}
    lists = {r["s1_id"]: r["candidates"] for r in blocking.candidate_lists(pairs, s1).collect()}
    assert lists == {"S1-1": ["S2-1"], "S1-2": ["S2-2"], "S1-3": []}


def test_padded_ngrams(spark):
    got = spark.range(1).select(tfidf.padded_ngrams(F.lit("abc d  d")).alias("g")).first()["g"]
    want = []
    for w in "abc d d".split():
        w = f" {w} "
        for n in (3, 4):
            want += [w[i : i + n] for i in range(len(w) - n + 1)] or ([w] if n == 3 else [])
    assert sorted(got) == sorted(want)


def test_pair_cosine_is_a_dot_product(spark):
    docs = spark.createDataFrame([("a", "", "blue stone"), ("b", "", "blue stones"), ("c", "", "zzz")], "entity_id string, part string, text string")
    w = tfidf.fit_weights(docs)
    pairs = spark.createDataFrame([("a", "a"), ("a", "b"), ("a", "c")], "s1_id string, candidate_id string")
    got = {r["candidate_id"]: r["x"] for r in tfidf.pair_cosine(pairs, w, w, "x").collect()}
    assert got["a"] == pytest.approx(1) and 0.5 < got["b"] < 1 and got["c"] == 0


def test_features(spark, records):
    from knotwork.functions.text import prepare_records

    s1, s2, s3 = records
    left, right = prepare_records(s1), prepare_records(s2.unionByName(s3))
    pairs = spark.createDataFrame([("S1-1", "S2-1"), ("S1-2", "S2-2"), ("S1-2", "S3-1")], "s1_id string, candidate_id string")
    out = features.pair_features(pairs, left, right)
    assert out.columns == ["s1_id", "candidate_id", *features.FEATURES] and len(features.FEATURES) == 35
    r = {(x["s1_id"], x["candidate_id"]): x for x in out.collect()}
    a, b, c = r["S1-1", "S2-1"], r["S1-2", "S2-2"], r["S1-2", "S3-1"]
    assert (a["nm_exact"], a["nm_jw"], a["nm_legal_suffix_match"], a["ad_state_match"], a["ad_zip_match"], a["ad_street_num_match"]) == (1, 1, -1, 1, -1, 1)
    assert (b["nm_exact"], b["nm_sort_exact"], b["nm_sort_ratio"], b["nm_set_ratio"], b["nm_len_diff"], b["ad_is_null"]) == (0, 1, 1, 1, 0, 0)
    assert (c["ad_jw"], c["ad_tfidf_cosine"], c["is_s3"], c["is_us"], c["nm_first_word_match"]) == (0, 0, 1, 1, 0)
    assert c["nm_ratio"] == pytest.approx(2 * 4 / 19)
    cos = features.tfidf_cosines(pairs, left, right)
    t = {(x["s1_id"], x["candidate_id"]): x for x in features.pair_features(pairs, left, right, cosines=cos).collect()}
    assert t["S1-1", "S2-1"]["nm_tfidf_cosine"] == pytest.approx(1) and t["S1-2", "S3-1"]["ad_tfidf_cosine"] == 0


SCORED = [("1", "S2-a", 0.9), ("1", "S3-b", 0.85), ("1", "S2-c", 0.5), ("2", "S2-d", 0.4), ("3", "S3-e", 0.6)]


@pytest.fixture(scope="module")
def scored(spark):
    return spark.createDataFrame(SCORED, "s1_id string, candidate_id string, probability double")


@pytest.fixture(scope="module")
def truth(spark):
    return spark.createDataFrame([("1", "S2-a"), ("1", "S3-b"), ("3", "S2-x")], "s1_id string, candidate_id string")


@pytest.fixture(scope="module")
def spine(spark):
    return spark.createDataFrame([("1",), ("2",), ("3",), ("4",)], "s1_id string")


def test_decision(scored, truth, spine):
    e = {r["s1_id"]: r for r in decision.entity_features(scored, spine).collect()}
    assert (e["1"]["max_prob"], e["1"]["third_prob"], e["1"]["n_over_50"], e["1"]["top1_is_s2"]) == (0.9, 0.5, 3, 1) and e["1"]["gap_1_2"] == pytest.approx(0.05)
    assert e["4"]["sum_prob"] == 0 and e["4"]["n_candidates"] == 0
    gate = scored.groupBy("s1_id").agg(F.max("probability").alias("p_match"))
    assert pairs_of(decision.decide(scored, gate)) == {("1", "S2-a"), ("1", "S3-b"), ("3", "S3-e")}
    assert pairs_of(decision.decide(scored, gate, decision.Policy(max_matches=1, tau_gate=0.7))) == {("1", "S2-a")}
    assert len(decision.policy_grid()) == 324
    layer = decision.DecisionLayer().fit(scored, truth, spine)
    assert layer.prior == 0.5
    best = decision.policy_scores(scored, layer.gate(scored, spine), truth, spine).agg(F.max("f05")).first()[0]
    got = metrics.macro_f05(layer.predict(scored, spine), truth, spine).first()["macro_f05"]
    assert got == pytest.approx(best)


def test_metrics(spark, scored, truth, spine):
    predicted = scored.where("probability >= 0.5")
    e = {r["s1_id"]: r["f05"] for r in metrics.entity_f05(predicted, truth, spine).collect()}
    p, r = 2 / 3, 1.0
    assert e == {"1": pytest.approx(1.25 * p * r / (0.25 * p + r)), "2": 1.0, "3": 0.0, "4": 1.0}
    m = metrics.macro_f05(predicted, truth, spine).first()
    assert m["macro_f05"] == pytest.approx(sum(e.values()) / 4) and m["singleton_macro_f05"] == 1 and m["n_matched"] == 2
    assert metrics.macro_f05(predicted, truth, spine.where("false")).first()["macro_f05"] == 0
    micro = metrics.micro_precision_recall(predicted, truth, spine).first()
    assert (micro["precision"], micro["recall"]) == (0.5, pytest.approx(2 / 3))
    labelled = model.label_pairs(scored, truth)
    c = metrics.confusion(labelled, 0.5).first()
    assert (c["tp"], c["fp"], c["fn"], c["tn"], c["recall"]) == (2, 2, 0, 1, 1.0)
    assert metrics.roc_auc(labelled).first()[0] == 1.0
    flat = labelled.withColumn("probability", F.lit(0.5))
    assert metrics.roc_auc(flat).first()[0] == 0.5 and metrics.roc_auc(labelled.where("label = 1")).first()[0] == 1.0
    sweep = {r["threshold"]: r["f05"] for r in model.threshold_sweep(scored, truth, spine).collect()}
    assert len(sweep) == 27 and sweep[0.5] == pytest.approx(m["macro_f05"])
    assert metrics.roc_auc(scored.withColumn("label", F.lit(1)).where("false")).first()[0] == 1.0
    f1, f05 = (spark.range(1).select(metrics.beta_scores(F.lit(0.5), F.lit(1.0), b)).first()[0] for b in (1.0, 0.5))
    assert f1 > f05


def test_sampling(spark, records, truth):
    counts = spark.createDataFrame([("a", 5), ("b", 3), ("c", 2)], "g string, n long")
    q = {r["g"]: r["quota"] for r in sampling.largest_remainder(counts, 7, ["g"]).collect()}
    assert q == {"a": 4, "b": 2, "c": 1}
    df = spark.range(200).select(F.col("id").cast("string").alias("entity_id"), (F.col("id") % 3).cast("string").alias("g"))
    one, two = sampling.disjoint_samples(df, ["g"], "entity_id", [20, 30])
    assert one.count() == 20 and two.count() == 30 and one.join(two, "entity_id").count() == 0
    assert sampling.reservoir(df, ["g"], "entity_id", 4).count() == 12
    split = sampling.entity_split(df.select(F.col("entity_id").alias("s1_id")), truth).collect()
    by = collections.Counter((r["stratum"], r["is_val"]) for r in split)
    assert by["matched", True] == 1 and by["singleton", True] == round(198 * 0.2)
    held = spark.createDataFrame([("1",)], "s1_id string")
    left = sampling.quarantine(records[1].unionByName(spark.createDataFrame([("S2-a", "", "", "")], RECORD)), truth, held)
    assert "S2-a" not in {r["entity_id"] for r in left.collect()} and left.count() == 3
    audit = sampling.leakage(held, held, truth, truth)
    with pytest.raises(ValueError):
        sampling.assert_no_leakage(audit)
    folds = sampling.assign_folds(df.withColumnRenamed("entity_id", "s1_id"), 5).groupBy("fold").count().collect()
    assert len(folds) == 5


def test_validation(spark):
    lists = spark.createDataFrame([("S1-1", ["S2-1", "S2-1"]), ("S1-2", ["S1-9", "X-1"]), ("S1-2", []), ("S1-9", ["S3-7"])], "s1_id string, ids array<string>")
    required = spark.createDataFrame([("S1-1",), ("S1-2",), ("S1-3",)], "s1_id string")
    targets = spark.createDataFrame([("S2-1",)], "entity_id string")
    got = {r["rule"]: (r["n"], r["examples"]) for r in validate.rule_counts(lists, required, targets).collect()}
    assert got == {
        "repeated_id": (1, ["S1-1"]), "self_match": (1, ["S1-2"]), "wrong_prefix": (1, ["S1-2"]), "is_empty": (1, ["S1-2"]),
        "duplicate_s1": (1, ["S1-2"]), "missing_s1": (1, ["S1-3"]), "extra_s1": (1, ["S1-9"]), "unknown_id": (1, ["S3-7"]),
    }
    out = validate.not_in_candidates(lists.where("s1_id = 'S1-9'"), lists.where("s1_id = 'S1-1'")).first()
    assert out["outside"] == ["S3-7"]
    assert validate.check_header("source1_entity_id,matched_entity_ids", "matching").startswith("header is separated")
    assert validate.check_header(" Source1_entity_id\tmatched_entity_ids", "matching") is None and validate.check_header(None, "matching")


def test_pre_rank(spark, records):
    from knotwork.functions.text import prepare_records

    s1, s2, s3 = records
    pairs = s1.select(F.col("entity_id").alias("s1_id")).join(s2.select(F.col("entity_id").alias("candidate_id")))
    kept = model.pre_rank(pairs, prepare_records(s1), prepare_records(s2), keep=1)
    assert pairs_of(kept) >= {("S1-1", "S2-1")} and kept.count() == 3
    assert math.isclose(model.threshold_grid()[-1], 0.85) and len(model.threshold_grid()) == 27


def test_trees_are_fitted_on_few_partitions(spark, monkeypatch):
    """Every job ran over each shuffle partition, however few rows it had."""
    rows = spark.range(300).selectExpr("id % 7 / 7.0 as x", "cast(id % 7 > 3 as double) as label").repartition(9).persist()
    seen, fit = [], model.Pipeline.fit
    monkeypatch.setattr(model.Pipeline, "fit", lambda self, df: seen.append(df.rdd.getNumPartitions()) or fit(self, df))
    fitted = model.fit_trees(rows, ["x"], trees=2, step=0.5, depth=2)
    assert {r["label"] == (r["probability"] > 0.5) for r in model.probability(fitted, rows).collect()} == {True}
    monkeypatch.setattr(model, "ROWS_A_PART", 100)
    model.fit_trees(rows, ["x"], trees=1, step=0.5, depth=2)
    assert seen == [1, 3]
