"""SimHash near-dedup with vantage-point trees.

Fingerprints are partitioned by their Hamming distances to a few vantage points, ring by ring; two fingerprints
within r bits lie in rings at most r apart, at every vantage point. That bound prunes pairs of shards; shards
at a boundary are both queried, so that no pair is lost. In a pair of shards one is searched as a tree whose
branches have vantage points of their own.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .blockjoin import Links, compare, near_pairs, pack, unpack
from .common import components, cut, row_keys

SEED = 42


def fingerprint(text: str | None, shingle: int = 4) -> int:
    """64-bit SimHash of one text; 0 without words. ``bytes.split`` parts at the six ASCII spaces."""
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    body = b" ".join(words)
    ends, at = [], -1
    for w in words:
        at += len(w) + 1
        ends.append(at)
    last = ends[shingle - 1 :] or ends[-1:]
    starts = [0, *(e + 1 for e in ends[: len(last) - 1])]
    h = np.fromiter((xxhash.xxh64_intdigest(body[a:b], SEED) for a, b in zip(starts, last, strict=True)), np.uint64, len(last))
    total = np.zeros(64, np.int64)
    for k in range(0, len(h), 1 << 16):
        total += np.unpackbits(h[k : k + (1 << 16)].astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(2 * total > len(h), bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, shingle: int = 4, keys: tuple[str, ...] = ()) -> DataFrame:
    """(doc_id, fp) for each row; narrow. ``keys`` are long columns to carry along."""

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            fps = np.fromiter((fingerprint(t.as_py(), shingle) for t in part.column("text")), np.uint64, len(part))
            cols = [*(part.column(c) for c in ("doc_id", *keys)), pa.array(fps.view(np.int64))]
            yield pa.RecordBatch.from_arrays(cols, names=["doc_id", *keys, "fp"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    carried = "".join(f"{c} long, " for c in keys)
    return docs.select("doc_id", *keys, "text").mapInArrow(run, f"doc_id {kind}, {carried}fp long")


def vantage_points(fps: DataFrame, count: int, sample: int) -> list[int]:
    """Points chosen on at most ``sample`` fingerprints, those of least hash: each of the widest spread of
    distances that the ones before leave. Any choice is exact; a good one prunes more."""
    got = [r[0] for r in fps.select("fp").orderBy(F.xxhash64(F.col("fp")), "fp").limit(sample).collect()]
    if not got:
        return [0] * count
    pool = np.array(got, np.int64).view(np.uint64)
    tried = np.concatenate([pool[:64], ~pool[:8]])
    d = np.bitwise_count(tried[:, None] ^ pool[None, :]).astype(float)
    d -= d.mean(1, keepdims=True)
    chosen: list[int] = []
    for _ in range(count):
        k = int(d.var(1).argmax())
        chosen.append(int(tried[k].view(np.int64)))
        axis = d[k] / max(np.linalg.norm(d[k]), 1e-9)
        d -= (d @ axis)[:, None] * axis
    return chosen


def _widest(fps: np.ndarray) -> np.uint64:
    """Of a few, the fingerprint from which distances to all vary most."""
    tried = fps[:: max(1, len(fps) // 8)]
    return tried[np.bitwise_count(tried[:, None] ^ fps[None, :: max(1, len(fps) // 512)]).var(1).argmax()]


def search(a: np.ndarray, b: np.ndarray, bits: int, small: int = 1 << 17, depth: int = 0) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Index pairs within ``bits``: ``b`` is a vantage-point tree, ``a`` its queries.

    Each branch has a vantage point of its own and a child for each ring around it. By the triangle
    inequality a child can only hold partners of queries at most ``bits`` rings away.
    """
    if len(a) * len(b) <= small or depth == 8:  # leaves are compared pair by pair
        step = max(1, (1 << 21) // max(1, len(b)))
        for k in range(0, len(a), step):
            x, y = np.nonzero(np.bitwise_count(a[k : k + step, None] ^ b[None, :]) <= bits)
            if len(x):
                yield x + k, y
        return
    v = _widest(b)
    ra, rb = (np.bitwise_count(x ^ v).astype(np.int16) for x in (a, b))
    oa, ob = np.argsort(ra, kind="stable"), np.argsort(rb, kind="stable")
    ra, rb = ra[oa], rb[ob]
    for ring in np.unique(rb):
        j = ob[np.searchsorted(rb, ring, "left") : np.searchsorted(rb, ring, "right")]
        i = oa[np.searchsorted(ra, ring - bits, "left") : np.searchsorted(ra, ring + bits, "right")]
        if len(i):
            for x, y in search(a[i], b[j], bits, small, depth + 1):
                yield i[x], j[y]


def link(fps: DataFrame, *, bits: int = 4, points: int = 3, sample: int = 4_096, block: int = 8_192) -> DataFrame:
    """(fp, root) for each distinct fingerprint: the smallest fingerprint reachable over links of at most ``bits``.

    ``points`` vantage points are shared by all shards; a shard has ``block`` fingerprints.
    """
    distinct = cut(fps.select("fp").where("fp is not null").distinct(), short=True)
    vps = vantage_points(distinct, points, sample)
    rings = [F.bit_count(F.col("fp").bitwiseXOR(F.lit(v))).cast("double") for v in vps]
    rows = distinct.select(F.col("fp").alias("node"), F.lit(1).cast("long").alias("weight"), F.array(*rings).alias("at"), F.lit(b"").alias("body"))
    blocks = pack(rows, ["at", "node"], points, 0, block)

    def near(gaps):
        return F.greatest(*gaps, F.lit(0.0)) <= bits

    pairs = near_pairs(blocks, points, near)

    def run(r: dict) -> pa.RecordBatch:
        a, *_ = unpack(r["data_i"], r["n_i"], points, 0)
        b, *_ = unpack(r["data_j"], r["n_j"], points, 0)
        same, links = r["i"] == r["j"], Links(len(a) if r["i"] == r["j"] else len(a) + len(b))
        for x, y in search(a.view(np.uint64), b.view(np.uint64), bits):
            links.add(x, y) if same else links.add(x, y + len(a))
        leaf, root = links.stars()
        node = a if same else np.concatenate([a, b])
        return pa.RecordBatch.from_arrays([pa.array(node[leaf]), pa.array(node[root])], names=["u", "v"])

    edges = compare(blocks, pairs, run, "u long, v long")
    found = components(edges)
    joined = distinct.join(found, distinct["fp"] == found["node"], "left")
    return joined.select("fp", F.coalesce("component", "fp").alias("root"))


def near_duplicates(docs: DataFrame, *, bits: int = 4, shingle: int = 4) -> DataFrame:
    """Per row of ``docs``: ``doc_id``, ``fp`` and ``component_id``, the smallest doc_id reachable.

    Texts with equal fingerprints are one class, compared once; classes link at ``bits`` or fewer differing
    bits. Texts without words have fingerprint zero and link like any other. A null doc_id never names a
    component. Repeated rows have the same class. Extra columns are not looked at. Copies of a class are
    joined with its row by a join that adaptive execution splits where a class is hot.
    """
    fps = cut(fingerprints(docs, shingle))
    classes = fps.groupBy("fp").agg(F.min("doc_id").alias("rep"))
    roots = link(fps, bits=bits)
    named = cut(classes.join(roots, "fp"), short=True)
    # written down, so that the join with it is one that adaptive execution splits where a component is hot
    least = cut(named.groupBy("root").agg(F.min("rep").alias("component_id")), short=True)
    named = named.join(least, "root").select("fp", "component_id")
    return fps.join(named, "fp").select("doc_id", "fp", "component_id")


def digest(docs: DataFrame) -> DataFrame:
    """The contract's columns."""
    out = near_duplicates(docs)
    return out.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def keep_one(docs: DataFrame) -> DataFrame:
    """All columns of one row of each group of near-duplicates: that of the smallest doc_id.

    Groups are of rows, not of ids: unrelated texts of one doc_id are each kept, and a group whose ids are
    all null keeps one row.
    """
    keys = ("_row0", "_row1")
    keyed = docs.withColumns(row_keys("doc_id", "text"))
    fps = cut(fingerprints(keyed, keys=keys))
    first = F.min(F.struct(F.isnull("doc_id").alias("unnamed"), "doc_id", *keys))
    classes = fps.groupBy("fp").agg(first.alias("m")).join(link(fps), "fp")
    keep = classes.groupBy("root").agg(F.min("m").alias("m")).select(*[f"m.{c}" for c in keys])
    rows = keyed.join(keep, list(keys), "left_semi")
    # rows of equal id and text are one key
    once = Window.partitionBy(*keys).orderBy(F.xxhash64(*docs.columns))
    return rows.withColumn("_first", F.row_number().over(once)).where("_first = 1").select(*docs.columns)
