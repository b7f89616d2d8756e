"""Operators on documents against brute force, odd rows included."""

import collections
import hashlib
import math
import re

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from knotwork.llm import bpe, line_dedup, mixing, quality_rules, simhash, substring_dedup

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SPACE = " \t\n\x0b\x0c\r"


def fold(s):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in s)


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def sha(x):
    return hashlib.sha256(x if isinstance(x, bytes) else x.encode()).hexdigest()


def held_by(rows):
    """Documents by line key; rows of one doc_id are one document, without doc_id those of one text are."""
    held = collections.defaultdict(set)
    for r in rows:
        for line in (r[1] or "").split("\n"):
            held[fold(line).strip(SPACE)].add((r[0], r[1] if r[0] is None else None))
    return held


def test_line_dedup(odd, odd_rows):
    held = held_by(odd_rows)
    want = []
    for r in odd_rows:
        lines = (r[1] or "").split("\n")
        keep = [x for x in lines if not ((k := fold(x).strip(SPACE)) and len(held[k]) >= 10)]
        want.append((r[0], len(lines), len(lines) - len(keep), sha("\n".join(keep))))
    assert rows_of(line_dedup.digest(odd)) == sorted(want, key=str)
    # the same with every key heavy
    assert rows_of(line_dedup.dedup_lines(odd, heavy_share=1).select("doc_id", "n_lines", "n_dropped", line_dedup.sha256_hex(F.col("text")))) == sorted(want, key=str)


def test_line_dedup_counts_documents(spark):
    import duckdb

    rows = [(1, "twice told\nown one")] * 10 + [(i, "Common \nx") for i in range(2, 11)] + [(None, "common\nx"), (None, "common\nx"), (11, " x")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = rows_of(line_dedup.digest(df))
    assert {r[:3] for r in got if r[0] == 1} == {(1, 2, 0)} and len(got) == len(rows)
    assert {r[1:3] for r in got if r[0] != 1} == {(2, 2), (1, 1)}
    con = duckdb.connect()
    con.register("documents", df.toArrow())
    assert sorted(con.execute(line_dedup.SQL).fetchall(), key=str) == got


def test_quality_rules(odd, odd_rows):
    got = {tuple(r)[:7] for r in quality_rules.digest(odd).collect()}
    for r in odd_rows:
        text = r[1] or ""
        w = WORD.findall(text)
        grams = collections.defaultdict(list)
        for i in range(len(w) - 7):
            grams[tuple(w[i : i + 8])].append(i)
        cover = {i + k for at in grams.values() if len(at) > 1 for i in at for k in range(8)}
        lines = [x for x in text.split("\n") if WORD.search(x)]
        want = (r[0], len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(cover), len(w) < 20 or 100 * len(cover) > 30 * len(w))
        assert want in got


def test_bpe_as_tiktoken(odd, odd_rows):
    tiktoken = pytest.importorskip("tiktoken")
    P = pytest.importorskip("public_tokenizers")
    import base64

    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(P.path("byte_bpe_multi_50k.tiktoken"), "rb"))}
    enc = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})
    want = []
    for r in odd_rows:
        ids = enc.encode_ordinary(r[1] or "")
        want.append((r[0], len(ids), sha(b"".join(i.to_bytes(4, "little") for i in ids)), sha(r[1] or "")))
    assert rows_of(bpe.digest(odd)) == sorted(want, key=str)
    own = bpe.Encoder(ranks, P.PATTERN)
    words = ["straßenbahnhaltestelle", "ÀÉÎ", "aaaaaaaaaaaaaaaaaaaa", "日本語テキスト", "🙂🙂👍🏽", "  x", "x\x1c\x1d\x85y", "don't we'll", "\t\t \n\n a", "x" * 63, "y" * 64, "zq" * 40, "a​ b"]
    words += ["ab" * 500 + "é" * 301]
    for got, w in zip(own.encode_batch(words), words, strict=True):
        assert got == b"".join(i.to_bytes(4, "little") for i in enc.encode_ordinary(w)), w


def brute_repeats(rows, window=50):
    starts = {}
    for r in rows:
        w = WORD.findall(r[1] or "")
        for i in range(len(w) - window + 1) if r[0] is not None else ():
            k = tuple(w[i : i + window])
            starts[k] = min(r[0], starts.get(k, r[0]))
    out = []
    for r in rows:
        w = WORD.findall(r[1] or "")
        gone = set()
        for i in range(len(w) - window + 1) if r[0] is not None else ():
            if starts[tuple(w[i : i + window])] < r[0]:
                gone |= set(range(i, i + window))
        out.append((r[0], len(w), len(gone), sha(" ".join(x for i, x in enumerate(w) if i not in gone))))
    return sorted(out, key=str)


def test_substring_dedup(odd, odd_rows):
    assert rows_of(substring_dedup.digest(odd)) == brute_repeats(odd_rows)


def test_substring_dedup_on_documents(spark, tiny):
    docs = spark.read.parquet(f"{tiny}/documents.parquet")
    assert rows_of(substring_dedup.digest(docs)) == brute_repeats([(r["doc_id"], r["text"]) for r in docs.collect()])


def test_removals_come_from_the_automaton():
    import pyarrow as pa

    words = [f"w{i}" for i in range(120)]
    table = pa.table({"doc_id": [5, 6], "text": [" ".join(words)] * 2})
    (_, b), = substring_dedup._batches(table, 50, 16)
    hashes, kinds = b.phrases().view("int64").tolist(), pa.schema([("p", pa.int64()), ("owner", pa.int64()), ("words", pa.string()), ("h", pa.int64()), ("g", pa.int64())])
    sent = [{"p": hashes[k], "owner": 5, "words": " ".join(words[k : k + 16])} for k in range(105)]

    def removed(marks):
        return substring_dedup.stream_shard(table, pa.Table.from_pylist(marks, kinds), 50, 16).column("n_removed").to_pylist()

    assert removed(sent) == [0, 120]
    assert removed([]) == [0, 0]
    assert removed([m | {"words": m["words"] + "!"} for m in sent]) == [0, 0]  # the hashes alone locate nothing
    at = np.arange(10, 41)  # the windows of 80 words of the first document
    looked_up = [{"owner": 5, "h": int(x), "g": int(y)} for x, y in zip(b.one.of(at, at + 50).view("int64"), b.two.of(at, at + 50).view("int64"), strict=True)]
    assert removed([m | {"owner": None} for m in sent] + looked_up) == [0, 80]  # windows of sure phrases aren't looked up
    assert removed(looked_up) == [0, 0]


def test_phrases_are_found_at_words():
    trie = substring_dedup.Phrases([b"a b", b"b a", "é a".encode()])
    start, which = trie.find("x a b a é a a b".encode().split())
    assert list(zip(start.tolist(), which.tolist(), strict=True)) == [(1, 0), (2, 1), (4, 2), (6, 0)]
    assert not len(substring_dedup.Phrases([]).find([b"a"])[0])


def brute_simhash(rows):
    fps = []
    for r in rows:
        w = WORD.findall(fold(r[1] or ""))
        grams = [" ".join(w[i : i + 4]) for i in range(len(w) - 3)] or ([" ".join(w)] if w else [])
        h = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
        fps.append(sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h)))
    distinct = sorted(set(fps))
    root = {f: f for f in distinct}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, a in enumerate(distinct):
        for b in distinct[:i]:
            if (a ^ b).bit_count() <= 4:
                root[find(a)] = find(b)
    least = {}
    for r, f in zip(rows, fps, strict=True):
        if r[0] is not None:
            least[find(f)] = min(r[0], least.get(find(f), r[0]))
    return sorted(((r[0], f"{f:016x}", least.get(find(f))) for r, f in zip(rows, fps, strict=True)), key=str)


def test_simhash(odd, odd_rows):
    assert rows_of(simhash.digest(odd)) == brute_simhash(odd_rows)


def test_simhash_on_documents(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet").where("doc_id < 400")
    assert rows_of(simhash.digest(docs)) == brute_simhash([(r["doc_id"], r["text"]) for r in docs.collect()])


def test_vantage_points_lose_no_pair(spark):
    rng = np.random.default_rng(5)
    base = rng.integers(0, 1 << 63, 300, dtype=np.int64).astype(np.uint64)
    near = base[rng.integers(0, 300, 900)]
    for _ in range(3):
        near = near ^ (np.uint64(1) << rng.integers(0, 64, 900).astype(np.uint64))
    fps = np.unique(np.concatenate([base, near]))
    df = spark.createDataFrame([(int(x),) for x in fps.view(np.int64)], "fp long")
    got = {r["fp"]: r["root"] for r in simhash.link(df, block=128, sample=200).collect()}
    root = list(range(len(fps)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, j in zip(*np.nonzero(np.bitwise_count(fps[:, None] ^ fps[None, :]) <= 4), strict=True):
        root[find(int(i))] = find(int(j))
    groups = collections.defaultdict(set)
    for i, f in enumerate(fps.view(np.int64).tolist()):
        groups[find(i)].add(f)
    want = {f: min(g) for g in groups.values() for f in g}
    assert got == want


def test_search_is_a_tree_that_loses_nothing():
    rng = np.random.default_rng(6)
    a = rng.integers(0, 1 << 63, 700, dtype=np.int64).astype(np.uint64)
    b = np.concatenate([a[:300] ^ np.uint64(0b1011), a[:50], rng.integers(0, 1 << 63, 400, dtype=np.int64).astype(np.uint64), np.repeat(a[:1], 40)])
    want = set(zip(*(x.tolist() for x in np.nonzero(np.bitwise_count(a[:, None] ^ b[None, :]) <= 4)), strict=True))
    for small in (1, 64, 5_000):
        got = [p for x, y in simhash.search(a, b, 4, small) for p in zip(x.tolist(), y.tolist(), strict=True)]
        assert len(got) == len(set(got)) and set(got) == want


def test_keep_one(odd, odd_rows):
    kept = [r["doc_id"] for r in simhash.keep_one(odd).collect()]
    want = {r[2] for r in brute_simhash(odd_rows)}
    assert sorted(kept) == sorted(want) and set(simhash.keep_one(odd).columns) == set(odd.columns)


def brute_mix(rows):
    """taken by row of (doc_id, text, source); equal rows are queued together."""
    times = collections.Counter(rows)
    sizes = collections.Counter()
    for _, text, source in rows:
        sizes[source] += len(WORD.findall(text or ""))
    target, taken = brute_targets(sizes), {}
    for s in target:
        queue = sorted((r for r in times if r[2] == s), key=lambda r: (hashlib.md5(f"mix-{'' if r[0] is None else r[0]}".encode()).hexdigest(), str(r[0])))
        at = 0
        for r in queue:
            size = len(WORD.findall(r[1] or "")) * times[r]
            taken[r] = sum(max(0, min(size, math.floor(target[s]) - at - copy * sizes[s])) for copy in (0, 1)) // times[r]
            at += size
    return [(r[0], len(WORD.findall(r[1] or "")), sizes[r[2]], pytest.approx(target[r[2]]), taken[r]) for r in rows]


def test_mixing(odd, odd_rows, spark, small):
    out = mixing.digest(odd)
    assert rows_of(out) == rows_of(mixing.digest(odd.repartition(5)))
    assert rows_of(out) == rows_of(mixing.mix(odd, few_sources=0).select("doc_id", "size", "source_size", "target", "taken"))
    order = [0, 1, 2, 4]
    want = sorted((str(tuple(r[k] for k in order)), r[3]) for r in brute_mix([(r[0], r[1], r[3]) for r in odd_rows]))
    got = sorted((str(tuple(r[k] for k in order)), r[3]) for r in out.collect())
    assert [g[0] for g in got] == [w[0] for w in want] and [g[1] for g in got] == [w[1] for w in want]
    docs = spark.read.parquet(f"{small}/documents.parquet")
    got = docs.select("doc_id", "source").join(mixing.digest(docs), "doc_id").groupBy("source").agg(F.sum("taken").alias("t"), F.first("target").alias("target")).collect()
    for r in got:
        assert abs(r["t"] - r["target"]) <= 1, r


def test_mix_in_order(odd, odd_rows):
    mixed = mixing.mix(odd)
    words = {r["text"]: r["taken"] for r in mixed.collect() if r["taken"]}
    rows = mixing.materialise(odd).collect()
    assert rows[0].asDict().keys() == set(odd.columns)
    for text, n in collections.Counter(r["text"] for r in rows if r["text"] in words).items():
        same = sum(r[1] == text for r in odd_rows)
        assert n <= 2 * same
    finish = {(r["doc_id"], r["text"]): r["finish"] for r in mixed.collect()}
    got = [finish[r["doc_id"], r["text"]] for r in rows]
    some = [f for f in got if f is not None]
    assert some == sorted(some) and all(0 < f <= 1 for f in some) and got[: len(some)] == some


def brute_targets(sizes):
    names = sorted((s for s in sizes if s is not None)) + [None] * (None in sizes)
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(names)}
    budget, target, free = 1.5 * sum(sizes.values()), {}, set(names)
    while free:
        level = budget / sum(weight[s] for s in free)
        full = {s for s in free if level * weight[s] > 2 * sizes[s]}
        if not full:
            return target | {s: level * weight[s] for s in free}
        for s in full:
            target[s] = 2.0 * sizes[s]
            budget -= target[s]
        free -= full
    return target


def test_empty_tables(empty):
    for digest in (line_dedup.digest, quality_rules.digest, substring_dedup.digest, simhash.digest, mixing.digest):
        assert digest(empty).count() == 0
    pytest.importorskip("public_tokenizers")
    assert bpe.digest(empty).count() == 0


def test_line_dedup_does_not_sort_texts(spark):
    """Texts were sorted to meet the positions to drop, and lay in the executors' memory."""
    docs = spark.createDataFrame([(i, f"Same line\nown {i}") for i in range(12)], "doc_id long, text string")
    out = line_dedup.dedup_lines(docs)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "ShuffledHashJoin" in plan and "SortMergeJoin [_row0" not in plan
    assert {r["text"] for r in out.collect()} == {f"own {i}" for i in range(12)}
