"""The corpus pipeline against a version of every stage in plain Python."""

import collections
import hashlib
import math
import statistics

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from knotwork.llm import mixing, ngram_quality, simhash
from tests.llm.test_models import Brute
from tests.llm.test_text_ops import SPACE, brute_mix, brute_simhash, fold, rows_of


def quality(rows, good, held, *, quantile=0.995, margin=0.05, prior=40, least=50):
    model = Brute([r["text"] for r in rows if r["doc_id"] in good - held])
    h = {r["doc_id"]: model.entropy(r["text"]) for r in rows}
    n = {r["doc_id"]: len((r["text"] or "").encode()) for r in rows}
    trusted = [r for r in rows if r["doc_id"] in good & held and n[r["doc_id"]]]
    by = collections.defaultdict(list)
    for r in trusted:
        by[r["lang"]].append(h[r["doc_id"]])
    overall = statistics.fmean(x for v in by.values() for x in v)

    def drawn(r):
        mean = statistics.fmean(by[r["lang"]]) if len(by[r["lang"]]) >= least else overall
        return (h[r["doc_id"]] * n[r["doc_id"]] + mean * prior) / (n[r["doc_id"]] + prior)

    def at(values):
        return sorted(values)[max(0, math.ceil(quantile * len(values)) - 1)]

    limits = {lang: at([drawn(r) for r in trusted if r["lang"] == lang]) for lang in by if len(by[lang]) >= least}
    everywhere = at([drawn(r) for r in trusted])
    return [r for r in rows if r["text"] and drawn(r) <= limits.get(r["lang"], everywhere) + margin]


def lines(rows):
    held = collections.Counter()
    for r in rows:
        held.update({fold(x).strip(SPACE) for x in r["text"].split("\n")})
    out = []
    for r in rows:
        keep = [x for x in r["text"].split("\n") if not ((k := fold(x).strip(SPACE)) and held[k] >= 10)]
        out.append(r | {"text": "\n".join(keep), "n_chars": len("\n".join(keep))})
    return out


def near(rows):
    first = {i: c for i, _, c in brute_simhash([(r["doc_id"], r["text"]) for r in rows])}
    return [r for r in rows if first[r["doc_id"]] == r["doc_id"]]


def mixture(rows):
    taken = brute_mix([(r["doc_id"], r["text"], r["source"]) for r in rows])
    return [r for r, (_, size, _, _, n) in zip(rows, taken, strict=True) for _ in range(math.floor(n / size + 0.5) if size else 1)]


def test_pipeline(spark, tiny):
    tiktoken = pytest.importorskip("tiktoken")
    P = pytest.importorskip("public_tokenizers")
    import base64

    docs = spark.read.parquet(f"{tiny}/documents.parquet")
    rows = [r.asDict() for r in docs.orderBy("doc_id").collect()]
    good = {r["doc_id"] for r in spark.read.parquet(f"{tiny}/labels.parquet").where("quality = 1").collect()}
    held = {r[0] for r in docs.where("pmod(xxhash64('held out', cast(doc_id as string)), 5) = 0").collect()}
    for stage in (lambda x: quality(x, good, held), lines, near, mixture):
        rows = stage(rows)
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(P.path("byte_bpe_multi_50k.tiktoken"), "rb"))}
    enc = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})
    want = []
    for r in rows:
        ids = enc.encode_ordinary(r["text"])
        raw = b"".join(i.to_bytes(4, "little") for i in ids)
        want.append((r["doc_id"], r["lang"], r["source"], r["n_chars"], len(ids), hashlib.sha256(raw).hexdigest(), hashlib.sha256(r["text"].encode()).hexdigest()))
    got = corpus_pipeline.run(spark, tiny)
    assert rows_of(got.select("doc_id", "lang", "source", "n_chars", "n_tokens", "ids_sha256", "decoded_sha256")) == sorted(want, key=str)


def test_stages_keep_the_columns(spark, tiny, odd, empty):
    docs = spark.read.parquet(f"{tiny}/documents.parquet")
    for frame in (odd.select(*docs.columns), empty):
        for name, stage in corpus_pipeline.STAGES[:-1]:
            out = stage(spark, frame, tiny)
            assert out.columns == docs.columns, name
            assert out.count() <= 2 * frame.count()
    assert mixing.materialise(odd).where(F.col("text") == "").count() == 1
    assert ngram_quality.keep_good(odd, spark.read.parquet(f"{tiny}/labels.parquet")).columns == odd.columns


def test_rows_not_ids_are_kept(spark, tiny):
    docs, labels = spark.read.parquet(f"{tiny}/documents.parquet"), spark.read.parquet(f"{tiny}/labels.parquet")
    verdicts = ngram_quality.classify(docs, labels).join(labels, "doc_id", "left_anti").join(docs.select("doc_id", "text"), "doc_id").orderBy("doc_id").collect()
    good, bad = (next(r for r in verdicts if r["kept"] == k and r["text"]) for k in (True, False))
    more = spark.createDataFrame([(None, good["text"], good["lang"], "s", 1), (good["doc_id"], bad["text"], bad["lang"], "s", 1)], docs.schema)
    got = {(r["doc_id"], r["text"]) for r in ngram_quality.keep_good(docs.unionByName(more), labels).collect()}
    assert (None, good["text"]) in got and (good["doc_id"], good["text"]) in got and (good["doc_id"], bad["text"]) not in got

    texts = [" ".join(f"{a}{i}" for i in range(40)) for a in "abc"]
    rows = [(None, texts[0]), (None, texts[0]), (1, texts[1]), (1, texts[2]), (1, texts[2]), (2, texts[2])]
    got = simhash.keep_one(spark.createDataFrame(rows, "doc_id long, text string"))
    assert rows_of(got) == sorted([(None, texts[0]), (1, texts[1]), (1, texts[2])], key=str)
