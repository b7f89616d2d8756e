"""Registered queries against their SQL, as the driver compares them."""

import duckdb
import pytest

import __spark_entry__
from knotwork.plans import queries as core

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def con(tiny):
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"create view {t} as select * from '{tiny}/{t}.parquet'")
    return c


def plain(rows):
    return sorted(tuple(round(v, 6) + 0.0 if isinstance(v, float) else v for v in r) for r in rows)


@pytest.mark.parametrize("name", sorted(core.ORACLE_SQL))
def test_query_equals_sql(spark, tiny, con, name):
    got = core.QUERIES[name](spark, tiny)
    columns = sorted(got.columns)
    want = con.execute(core.ORACLE_SQL[name]).fetchdf()
    assert sorted(want.columns) == columns
    rows = [tuple(r[c] for c in columns) for r in got.collect()]
    assert plain(rows) == plain(want[columns].itertuples(index=False, name=None))


def test_entry(spark):
    df = __spark_entry__.entry(spark)
    assert df.columns == ["s1_id", "candidate_id"] and df.count() > 0


def test_keys_agree():
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())


@pytest.mark.parametrize("name", ["pair_features", "gbt_pair_scores"])
def test_pair_queries_prepare_whole_addresses(spark, tiny, monkeypatch, name):
    seen, prepare = [], core.X.prepare_records
    monkeypatch.setattr(core.X, "prepare_records", lambda e: seen.append(e) or prepare(e))
    monkeypatch.setattr(core.model, "fit_trees", lambda *a, **k: None)
    monkeypatch.setattr(core.model, "probability", lambda fitted, rows: rows.withColumn("probability", core.F.lit(0.0)))
    core.QUERIES[name](spark, tiny)
    got = {r["entity_id"]: r["business_address"] for e in seen for r in e.collect()}
    docs = spark.read.parquet(f"{tiny}/documents.parquet").collect()
    assert got == {f"S{1 + r['doc_id'] % 3}-{r['doc_id']}": r["text"].partition("\n")[2] for r in docs}


@pytest.mark.parametrize("name", ["pair_features", "gbt_pair_scores"])
def test_pair_queries_use_the_operators_values(spark, tiny, monkeypatch, name):
    configs, candidates = [], core.blocking.rule_candidates
    monkeypatch.setattr(core.blocking, "rule_candidates", lambda s1, targets, config: configs.append(config) or candidates(s1, targets, config))
    fits = []
    monkeypatch.setattr(core.model, "fit_trees", lambda *a, **k: fits.append((k["trees"], k["step"], k["depth"])))
    monkeypatch.setattr(core.model, "probability", lambda fitted, rows: rows.withColumn("probability", core.F.lit(0.0)))
    core.QUERIES[name](spark, tiny)
    assert [c.max_key_targets for c in configs] == [250]
    assert fits == ([(150, 0.05, 5)] if name == "gbt_pair_scores" else [])


@pytest.fixture(scope="module")
def copied(tmp_path_factory):
    """60 parts of one brand and size with two texts, and one nation of 40 suppliers and 50 customers."""
    d = tmp_path_factory.mktemp("copied")
    c = duckdb.connect()
    c.execute("create table part as select i as p_partkey, ['red bolt', 'hot rod'][1 + i % 2] as p_name, 'B' as p_brand, 'LARGE' as p_type, 1 as p_size from range(60) r(i)")
    for t, k, n in (("supplier", "s", 40), ("customer", "c", 50)):
        key = {"s": "supp", "c": "cust"}[k]
        c.execute(f"create table {t} as select i as {k}_{key}key, 'N#' || i as {k}_name, 3 as {k}_nationkey, (i % 7 - 1)::double as {k}_acctbal from range({n}) r(i)")
    for t in ("part", "supplier", "customer"):
        c.execute(f"copy {t} to '{d}/{t}.parquet' (format parquet)")
    return c, str(d)


@pytest.mark.parametrize("name", ["char_ngram_similarity", "jaro_winkler_pairs", "token_ratios"])
def test_measures_are_taken_once_for_equal_texts(spark, copied, monkeypatch, name):
    """They were taken for each of 1,770 pairs."""
    c, d = copied
    monkeypatch.setattr(core, "PAIRS_A_TASK", 100)
    assert core.part_pairs(spark, d, m=core.F.uuid()).agg(core.F.countDistinct("m"), core.F.count("*")).first()[:] == (4, 1770)
    got = core.QUERIES[name](spark, d)
    assert plain(got.collect()) == plain(c.execute(core.ORACLE_SQL[name]).fetchdf()[got.columns].itertuples(index=False, name=None))


@pytest.mark.parametrize("name", ["char_ngram_similarity", "jaro_winkler_pairs", "token_ratios"])
def test_measures_are_taken_once_for_texts_of_many_groups(spark, tmp_path, monkeypatch, name):
    """They were taken again in each of 20 brands."""
    c = duckdb.connect()
    c.execute("create table part as select i as p_partkey, ['red bolt', 'hot rod', 'old gear'][1 + i % 3] as p_name, 'B' || i // 6 as p_brand, 'LARGE' as p_type, 1 as p_size from range(120) r(i)")
    c.execute(f"copy part to '{tmp_path}/part.parquet' (format parquet)")
    taken = core.part_pairs(spark, str(tmp_path), m=core.F.uuid())
    assert taken.agg(core.F.countDistinct("m") <= 9, core.F.count("*")).first()[:] == (True, 20 * 15)
    got = core.QUERIES[name](spark, str(tmp_path))
    want = plain(c.execute(core.ORACLE_SQL[name]).fetchdf()[got.columns].itertuples(index=False, name=None))
    assert plain(got.collect()) == want
    monkeypatch.setattr(core, "TEXT_PAIRS_HELD", 8)
    assert plain(core.QUERIES[name](spark, str(tmp_path)).collect()) == want


def test_pairs_of_one_key_are_made_in_many_tasks(spark, copied, monkeypatch):
    """One task made all 2,000."""
    c, d = copied
    monkeypatch.setattr(core, "PAIRS_A_TASK", 100)
    got = core.QUERIES["tri_state_match"](spark, d)
    tasks = [r["count"] for r in got.groupBy(core.F.spark_partition_id()).count().collect()]
    assert sum(tasks) == 2000 and max(tasks) <= 1000
    assert plain(got.collect()) == plain(c.execute(core.ORACLE_SQL["tri_state_match"]).fetchdf()[got.columns].itertuples(index=False, name=None))


def test_neighbours_of_equal_texts_are_searched_once(spark, tmp_path, monkeypatch):
    """N-grams of 4 texts in 2 nations, not of 280 rows; more copies than neighbours are asked for, so ties are cut by id."""
    c = duckdb.connect()
    c.execute("create table supplier as select i as s_suppkey, 'Shop ' || ['alpha', 'beta'][1 + i % 2] as s_name, i % 3 % 2 as s_nationkey from range(60) r(i)")
    c.execute("create table customer as select i as c_custkey, 'Shop ' || ['alpha', 'alphas', 'beta', 'gamma'][1 + i % 4] as c_name, i % 5 % 2 as c_nationkey from range(220) r(i)")
    for t in ("supplier", "customer"):
        c.execute(f"copy {t} to '{tmp_path}/{t}.parquet' (format parquet)")
    searched, counts = [], core.tfidf.term_counts
    monkeypatch.setattr(core.tfidf, "term_counts", lambda docs, *a: searched.append(docs) or counts(docs, *a))
    got = core.QUERIES["tfidf_knn"](spark, str(tmp_path))
    assert got.count() == 60 * 30 and [d.count() for d in searched] == [8]
    assert plain(got.collect()) == plain(c.execute(core.ORACLE_SQL["tfidf_knn"]).fetchdf()[got.columns].itertuples(index=False, name=None))


@pytest.mark.parametrize("name", ["pair_features", "gbt_pair_scores"])
def test_records_go_to_keys_not_to_pairs(spark, tmp_path, monkeypatch, name):
    """The left record went with each of its pairs; keys with many pairs are dealt out."""
    c = duckdb.connect()
    c.execute("""create table documents as select i as doc_id, 'acme ' || ['bolt', 'rod', 'gear'][1 + i // 3 % 3] || chr(10) || i || ' old mill road, building ' || (i * 7 % 11) as text, 'en' as lang from range(60) r(i)""")
    c.execute(f"copy documents to '{tmp_path}/documents.parquet' (format parquet)")
    monkeypatch.setattr(core.features, "PAIRS_A_GROUP", 300)
    monkeypatch.setattr(core.model, "fit_trees", lambda *a, **k: None)
    monkeypatch.setattr(core.model, "probability", lambda fitted, rows: rows.withColumn("probability", core.F.lit(0.0)))
    frame = type(spark.range(0))
    asked, dealt, measure, deal = [], [], core.features.pair_features, frame.repartition
    monkeypatch.setattr(core.features, "pair_features", lambda pairs, left, right: asked.append((pairs, left, right)) or measure(pairs, left, right))
    monkeypatch.setattr(frame, "repartition", lambda df, *a: dealt.append(df) or deal(df, *a))
    core.QUERIES[name](spark, str(tmp_path))
    pairs, left, right = asked[0]
    assert pairs.count() == 20 * 40 and len(dealt) == 2 and sum(df.count() for df in dealt) < 300
    got = measure(pairs, left, right)
    assert plain(got.collect()) == plain(measure(pairs.drop("key"), left, right).select(got.columns).collect())


def test_neighbours_of_different_texts_are_compared_in_tiles(spark, tmp_path, monkeypatch):
    """N-grams that all names have were joined: 60 x 150 rows a nation for each of them."""
    c = duckdb.connect()
    for t, k, n in (("supplier", "supp", 120), ("customer", "cust", 300)):
        c.execute(f"create table {t} as select i as {k[0]}_{k}key, printf('{t}#%09d', i * 37) || case when i % 9 = 0 then ' aa aa' else '' end as {k[0]}_name, i % 2 as {k[0]}_nationkey from range({n}) r(i)")
        c.execute(f"copy {t} to '{tmp_path}/{t}.parquet' (format parquet)")
    want = plain(c.execute(core.ORACLE_SQL["tfidf_knn"]).fetchdf().itertuples(index=False, name=None))
    monkeypatch.setattr(core.tfidf, "CELLS", 500)
    for texts in (20_000, 50):
        monkeypatch.setattr(core.tfidf, "TEXTS_A_TILE", texts)
        got = core.QUERIES["tfidf_knn"](spark, str(tmp_path))
        assert plain(got.collect()) == want
        plan = got._jdf.queryExecution().optimizedPlan().toString()
        assert not [x for x in plan.splitlines() if "Join" in x and "gram" in x]
