"""Trained and linked operators: held-out accuracy, brute force, oracle SQL, odd rows, empty tables."""

import collections
import math
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from knotwork.llm import chat_tools, embedding_dedup, ngram_quality, queries, toxicity
from tests.llm.test_text_ops import rows_of


def test_toxicity_held_out(spark, small, odd):
    large = small.replace("sf0.01", "sf0.1")
    docs, labels = spark.read.parquet(f"{large}/documents.parquet"), spark.read.parquet(f"{large}/labels.parquet")
    net = toxicity.fit(docs, labels)
    held = docs.join(labels, "doc_id").where(toxicity.fold(F.col("doc_id")) == 1)
    got = toxicity.classify(held, net).join(labels, "doc_id").toPandas()
    assert got.score.between(0, 1).all() and (got.predicted == (got.score >= 0.7)).all()
    rank, bad = got.score.rank(), got.toxic == 1
    assert (rank[bad].sum() - bad.sum() * (bad.sum() + 1) / 2) / (bad.sum() * (~bad).sum()) > 0.93
    assert (got.toxic[got.predicted == 1] == 1).mean() > 0.9
    scored = toxicity.classify(odd, net)
    assert scored.count() == odd.count() and scored.where("score is null or score < 0 or score > 1").count() == 0


def test_toxicity_learns_words_and_stems():
    rng = np.random.default_rng(0)
    words = [f"w{a}{b}" for a in "abcdefgh" for b in "klmnopqr"]

    def text(bad):
        t = list(rng.choice(words, 60))
        if bad:
            t[int(rng.integers(60))] = "badstem" + str(rng.integers(10**6))
        return " ".join(t)

    rows = [(text(i % 4 == 0), "en", int(i % 4 == 0), 1.0) for i in range(1200)]
    scorer = toxicity.Scorer(toxicity.train(rows))
    bad, good = [scorer.score(text(True)) for _ in range(50)], [scorer.score(text(False)) for _ in range(50)]
    assert min(bad) > max(good) and np.mean(np.array(bad) >= 0.7) > 0.9 and max(good) < 0.7
    long = " ".join(rng.choice(words, 50_000)) + " badstemx"
    assert scorer.score(long) > max(good)


def brute_score(net, text):
    """The same network as plain sums: word by word, filter by filter."""
    words = re.findall(r"\w+", (text or "").lower()) or [""]
    rows = [np.concatenate([net.embed[net.words.get(zlib.crc32(w.encode()) % net.s.buckets, 0)], toxicity.evidence_of(w, net.evidence)]) for w in words]
    zero = np.zeros_like(rows[0])
    feats = []
    for conv, bias in zip(net.conv, net.bias, strict=True):
        for f in range(conv.shape[2]):
            tops = [bias[f] + sum(float(conv[o][:, f] @ (rows[i + o] if i + o < len(rows) else zero)) for o in range(len(conv))) for i in range(len(rows))]
            feats.append(max(0.0, max(tops)))
    a, b = net.scale
    return 1 / (1 + math.exp(-(a * (float(np.dot(feats, net.out)) + net.out_bias) + b)))


def test_toxicity_against_brute_force(spark, small, odd):
    docs, labels = spark.read.parquet(f"{small}/documents.parquet"), spark.read.parquet(f"{small}/labels.parquet")
    net = toxicity.fit(docs, labels)
    some = [r["text"] for r in docs.where("length(text) < 4000").orderBy("doc_id").limit(60).collect()]
    odd_texts = [r["text"] for r in odd.collect() if len(r["text"] or "") < 9_000]
    scorer = toxicity.Scorer(net)
    for text in [*some, *odd_texts, "", None, "ÀÉ straße", "x" * 500]:
        assert scorer.score(text) == pytest.approx(brute_score(net, text), abs=1e-5)
    got = toxicity.digest(docs, labels).toPandas().set_index("doc_id")
    for r in docs.where("length(text) < 4000").orderBy("doc_id").limit(25).collect():
        row = got.loc[r["doc_id"]]
        assert row.score == pytest.approx(brute_score(net, r["text"]), abs=1e-5) and row.predicted == int(row.score >= 0.7)
        assert row.held_out == (zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1)
    assert len(got) == docs.count()


def test_toxicity_learns_the_same_from_repeated_ids(spark):
    bad, good = "vile badword rant " * 5, "calm words of the day " * 5
    rows = [(i, bad if i % 2 else good, "en") for i in range(200)] + [(i, "other text", "en") for i in range(0, 200, 7)]
    labels = spark.createDataFrame([(i, 1, i % 2) for i in range(200)], "doc_id long, quality int, toxic int")
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    one, two = (toxicity.fit(d, labels) for d in (docs, docs.repartition(7).orderBy(F.rand(3))))
    assert np.array_equal(one.embed, two.embed) and np.array_equal(one.out, two.out) and one.evidence == two.evidence


def test_toxicity_without_labels(spark, odd, empty):
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert toxicity.digest(odd, none).where("predicted = 1").count() == 0
    assert toxicity.digest(empty, none).count() == 0


class Brute:
    """Interpolated modified Kneser-Ney over tuples of bytes."""

    def __init__(self, texts):
        self.levels = []
        counts = collections.Counter(g for t in texts for g in self.grams(t))
        for order in range(ngram_quality.ORDER, 0, -1):
            n = [0, *(sum(c == k for c in counts.values()) for k in (1, 2, 3, 4))]
            if min(n[1:]) == 0:
                d = [0.5, 0.75, 1.0]
            else:
                y = n[1] / (n[1] + 2 * n[2])
                d = [min(max(k - (k + 1) * y * n[k + 1] / n[k], 0.05), k - 0.05) for k in (1, 2, 3)]
            total, left = collections.Counter(), collections.Counter()
            for g, c in counts.items():
                total[g[:-1]] += c
                left[g[:-1]] += d[min(c, 3) - 1]
            self.levels.append((counts, d, total, left))
            counts = collections.Counter(g[1:] for g in counts)

    @staticmethod
    def grams(text):
        s = bytes(ngram_quality.ORDER - 1) + (text or "").encode()
        return [tuple(s[i : i + ngram_quality.ORDER]) for i in range(len(s) - ngram_quality.ORDER + 1)]

    def probability(self, g, level=0):
        if level == len(self.levels):
            return 1 / 256
        counts, d, total, left = self.levels[level]
        low = self.probability(g[1:], level + 1)
        if not total[g[:-1]]:
            return low
        c = counts[g]
        return ((c - d[min(c, 3) - 1]) if c else 0) / total[g[:-1]] + left[g[:-1]] / total[g[:-1]] * low

    def entropy(self, text):
        g = self.grams(text)
        return -sum(math.log(self.probability(x)) for x in g) / len(g) if g else None


def test_kneser_ney(spark, tiny):
    docs = spark.read.parquet(f"{tiny}/documents.parquet")
    rows = docs.orderBy("doc_id").collect()
    brute = Brute([r["text"] for r in rows if r["doc_id"] < 60])
    assert sum(brute.probability((*b"f th", c)) for c in range(256)) == pytest.approx(1)
    ids = docs.where("doc_id < 60").select("doc_id")
    odd = [(900, None, ""), (901, "xx", None), (902, None, "日本語 ééé\0"), (None, None, "the of"), (903, "en", "the house of cards " * 120_000), (904, "en", "the of"), (904, "en", "the of")]
    docs = docs.select("doc_id", "lang", "text").unionByName(spark.createDataFrame(odd, "doc_id long, lang string, text string"))
    want = {r["doc_id"]: brute.entropy(r["text"]) for r in rows} | {i: brute.entropy(t) for i, _, t in odd if i != 903}
    long = brute.grams(odd[4][2])
    seen = collections.Counter(long)
    want[903] = -sum(n * math.log(brute.probability(g)) for g, n in seen.items()) / len(long)
    for bits, sizes in ((1 << 24, {}), (64, {"block_bytes": 20_000, "most_common": 500}), (1 << 24, {"most_common": 0})):
        model = ngram_quality.Model(ngram_quality.tally(ngram_quality.texts_of(docs, ids, bits)), shards=7)
        got = ngram_quality.score(docs, model, **sizes).collect()
        assert len(got) == len(rows) + len(odd)
        for r in got:
            h = want[r["doc_id"]]
            assert r["cross_entropy"] is None if h is None else r["cross_entropy"] == pytest.approx(h, abs=1e-5)


def test_model_grows_with_the_text(spark, tiny, small):
    counts = [ngram_quality.tally(spark.read.parquet(f"{d}/documents.parquet")).count() for d in (tiny, small)]
    assert counts[1] > 1.2 * counts[0]


def test_quality_keeps_clean_documents(spark, small, odd, empty):
    docs, labels = spark.read.parquet(f"{small}/documents.parquet"), spark.read.parquet(f"{small}/labels.parquet")
    got = ngram_quality.digest(docs, labels).join(labels, "doc_id").toPandas()
    assert got[got.quality == 1].kept.mean() > 0.97 and got[got.quality == 0].kept.mean() < 0.3
    assert ngram_quality.digest(odd, labels.unionByName(labels)).count() == odd.count()
    assert ngram_quality.digest(odd, labels.where("false")).where("kept").count() == odd.where("text <> ''").count()
    assert ngram_quality.digest(empty, labels).count() == 0


def brute_links(rows, least=0.9):
    good = [(i, np.array(e, float)) for i, e in rows if i is not None and e and all(x is not None and math.isfinite(x) for x in e) and any(e)]
    width = max(len(e) for _, e in good)
    x = np.array([np.pad(e, (0, width - len(e))) for _, e in good])
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    near = x @ x.T >= least - 1e-12
    root = list(range(len(good)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, j in zip(*np.nonzero(near), strict=True):
        root[find(int(i))] = find(int(j))
    least_id = {}
    for k, (i, _) in enumerate(good):
        least_id[find(k)] = min(i, least_id.get(find(k), i))
    out = [(i, int(near[k].sum()) - 1, least_id[find(k)], i == least_id[find(k)]) for k, (i, _) in enumerate(good)]
    bad = [(i, 0, i, i is not None) for i, e in rows if not (i is not None and e and all(x is not None and math.isfinite(x) for x in e) and any(e))]
    return sorted(out + bad, key=str)


def test_embedding_dedup(spark):
    rng = np.random.default_rng(2)
    centres = rng.normal(size=(40, 16))
    rows = [(i, (centres[i % 40] + rng.normal(size=16) * rng.choice([0.05, 0.25, 0.4])).astype(np.float32).tolist()) for i in range(600)]
    rows += [(600 + i, rows[7][1]) for i in range(30)] + [(700, [2 * v for v in rows[7][1]]), (7, rows[7][1])]
    rows += [(800, None), (801, []), (802, [0.0] * 16), (803, [float("nan")] * 16), (804, [float("inf")] + [1.0] * 15), (805, [None] + [1.0] * 15), (806, [1.0, 2.0]), (None, rows[7][1])]
    df = spark.createDataFrame([(i, e, 1, "x") for i, e in rows], "vec_id long, embedding array<float>, label int, n_links string")
    assert rows_of(embedding_dedup.digest(df)) == brute_links(rows)
    for tile in (1, 3):
        assert rows_of(embedding_dedup.link(df, dims=3, block_bytes=32 * 8 * 16, sample=50, tile=tile)) == brute_links(rows)
    assert embedding_dedup.digest(df.where("false")).count() == 0


def test_chat_tools_oracle(spark, small):
    import duckdb

    got = queries.QUERIES["op6_chat_tools"](spark, small)
    con = duckdb.connect()
    con.execute(f"create view conversations as select * from '{small}/conversations.parquet'")
    want = con.execute(chat_tools.SQL).fetchall()
    assert rows_of(got.select("conv_id", "call_id", "turn", "name", "level", "position", "linked", "valid", "problem", "json_sha256")) == sorted(want, key=str)


def test_chat_tools(spark):
    ok = '{"prompt": "a\\u00e9", "chars": 2}'
    calls = [
        (1, "a", 5, "reply", ok, None), (1, "b", 1, "reply", '{"chars": 1, "prompt": "x", "user": "u"}', ["a"]), (1, "c", 2, "reply", "not json", ["b", "a", "nowhere"]),
        (1, "d", 3, "reply", '{"chars": "1", "prompt": "x"}', []), (1, "e", 4, "reply", '{"prompt": "x"}', ["e"]), (1, "f", 4, "reply", '{"chars": 1, "prompt": "x", "more": 1}', ["g"]),
        (1, "g", 4, "other", ok, ["f"]), (1, "h", 6, "reply", "[1]", ["f"]), (2, "i", None, None, None, None), (1, None, 1, "reply", ok, None), (1, "a", 5, "reply", ok, None),
    ]
    results = [("a", 1, 6, "done"), ("a", 1, 7, "again"), ("z", 1, 7, 'lost "q"'), (None, 1, 1, "x"), ("b", None, None, None)]
    c = spark.createDataFrame([(*r, "clash") for r in calls], "conv_id long, call_id string, turn int, name string, arguments string, after array<string>, level string")
    r = spark.createDataFrame(results, "call_id string, conv_id long, turn int, content string")
    got = {x["call_id"]: x for x in chat_tools.link(c, r).collect()}
    assert sorted(got) == ["a", "b", "c", "d", "e", "f", "g", "h", "i", "z"]
    assert [got[k]["level"] for k in "abcdefghi"] == [0, 1, 2, 0, None, None, None, None, 0]
    assert [got[k]["position"] for k in "abcd"] == [2, 3, 4, 1] and got["e"]["position"] is None
    assert [got[k]["problem"] for k in "abcdefghi"] == [None, None, "not an object", "type of chars", "missing chars", "unknown field", "unknown tool", "not an object", "not an object"]
    assert got["a"]["json"] == '{"arguments":{"chars":2,"prompt":"aé"},"id":"a","name":"reply","result":"done"}'
    assert got["c"]["json"] == '{"arguments":null,"id":"c","name":"reply","result":null}'
    assert got["a"]["linked"] and got["b"]["linked"] and not got["c"]["linked"]
    assert got["z"]["problem"] == "no call" and got["z"]["json"] == '{"result":"lost \\"q\\""}'
    assert chat_tools.link(c.where("false"), r.where("false")).count() == 0
