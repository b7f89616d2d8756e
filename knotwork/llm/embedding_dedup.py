"""Embedding near-dedup by an epsilon grid order join.

Unit vectors are projected on their leading principal dimensions, to which the length of what is left over is
added as one more; they are sorted by the cells of a grid as wide as
the largest distance of a link, and joined interval by interval; intervals whose boxes are provably
farther apart are skipped. What is left is compared exactly in double precision.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .blockjoin import Links, compare, near_pairs, pack, unpack
from .common import components, cut


def principal(classes: DataFrame, dims: int, width: int, sample: int) -> np.ndarray:
    """Leading principal axes of at most ``sample`` unit vectors, those of least hash. Any orthonormal axes
    keep the join exact; these spread the vectors most."""
    got = [r[0] for r in classes.select("embedding").orderBy(F.xxhash64("embedding")).limit(sample).collect()]
    x = np.zeros((max(len(got), 1), width))
    for row, v in zip(x, got, strict=False):
        row[: len(v)] = v
    x /= np.maximum(np.abs(x).max(1, keepdims=True), 1e-300)
    x /= np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-300)
    _, axes = np.linalg.eigh(np.cov(x.T).reshape(width, width) if len(x) > 1 else np.eye(width))
    return axes[:, ::-1][:, :dims]


def link(vectors: DataFrame, *, least: float = 0.9, dims: int = 8, sample: int = 4_096, block_bytes: int = 1 << 22, tile: int | None = None) -> DataFrame:
    """One row per row of ``vectors`` (vec_id, embedding): ``vec_id``, ``n_links``, ``component_id``, ``kept``.

    Linked are vectors of cosine ``least`` or more. A vector that is null, zero, empty or holds null or
    non-finite numbers links with nothing and is its own component, as is a row whose vec_id is null (kept
    false). Shorter vectors are compared as if they ended in zeros. Equal vectors are one class, compared
    once and counted by weight, so repeated rows are links of each other. Labels and other columns are not
    looked at.
    """
    rows = vectors.select("vec_id", F.col("embedding").cast("array<double>").alias("embedding"))
    bad = F.exists("embedding", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    good = F.col("vec_id").isNotNull() & F.col("embedding").isNotNull() & ~F.coalesce(bad, F.lit(True)) & F.exists("embedding", lambda x: x != 0.0)
    rows = rows.withColumn("good", F.coalesce(good, F.lit(False)))
    classes = rows.where("good").groupBy("embedding").agg(F.min("vec_id").alias("rep"), F.count("*").alias("weight"))
    classes = cut(classes.withColumn("node", F.monotonically_increasing_id()))
    width = classes.agg(F.max(F.size("embedding"))).first()[0] or 1
    dims = min(dims, width)
    block = max(32, block_bytes // (8 * width))  # an interval travels once for each partner: fewer and larger ones travel less
    axes = principal(classes, dims, width, sample)
    eps = math.sqrt(max(0.0, 2 - 2 * least)) + 1e-9

    def place(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            x = np.zeros((len(part), width))
            for row, v in zip(x, part.column("embedding").to_pylist(), strict=True):
                row[: len(v)] = v
            unit = x / np.abs(x).max(1, keepdims=True)
            unit /= np.linalg.norm(unit, axis=1, keepdims=True)
            at = unit @ axes
            rest = np.linalg.norm(unit - at @ axes.T, axis=1, keepdims=True)  # differs by no more than the vectors do
            at = np.concatenate([at, rest], 1)
            cols = [part.column("node"), part.column("weight"), pa.array(np.floor(at / eps).astype(np.int32).tolist(), pa.list_(pa.int32())), pa.array(at.tolist(), pa.list_(pa.float64())), pa.array([r.tobytes() for r in unit.astype("<f8")], pa.binary())]
            yield pa.RecordBatch.from_arrays(cols, names=["node", "weight", "cell", "at", "body"])

    placed = classes.select("node", "weight", "embedding").mapInArrow(place, "node long, weight long, cell array<int>, at array<double>, body binary")
    blocks = pack(placed, ["cell", "at", "node"], dims + 1, 8 * width, block)

    def near(gaps):
        return sum((g * g for g in gaps), F.lit(0.0)) <= eps * eps

    pairs = near_pairs(blocks, dims + 1, near)
    found = cut(compare(blocks, pairs, lambda r: _compare(r, dims + 1, width, least), "u long, v long, n long", tile=tile))
    links = found.where("v is null").groupBy(F.col("u").alias("node")).agg(F.sum("n").alias("linked"))
    comp = components(found.where("v is not null").select("u", "v"))
    named = classes.join(comp, "node", "left").withColumn("root", F.coalesce("component", "node"))
    # written down, so that the join with it is one that adaptive execution splits where a component is hot
    least_id = cut(named.groupBy("root").agg(F.min("rep").alias("component_id")), short=True)
    named = named.join(least_id, "root").join(links, "node", "left")
    named = named.select("embedding", "component_id", (F.col("weight") - 1 + F.coalesce("linked", F.lit(0))).alias("n_links"))
    out = rows.where("good").join(named, "embedding").select("vec_id", "n_links", "component_id")
    alone = rows.where("not good").select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return out.unionByName(alone).withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)))


def _compare(r: dict, dims: int, width: int, least: float) -> pa.RecordBatch:
    """Links of two intervals: spanning stars (u, v) and, with v null, the weight n linked to u."""
    na, wa, _, ba = unpack(r["data_i"], r["n_i"], dims, 8 * width)
    nb, wb, _, bb = unpack(r["data_j"], r["n_j"], dims, 8 * width)
    same = r["i"] == r["j"]
    xa, xb = ba.reshape(-1).view("<f8").reshape(-1, width), bb.reshape(-1).view("<f8").reshape(-1, width)
    fa, fb = xa.astype(np.float32), xb.astype(np.float32)
    links, ca, cb = Links(len(na) if same else len(na) + len(nb)), np.zeros(len(na)), np.zeros(len(nb))
    slack = 1e-5 * max(1, width / 64)  # of a single-precision product; what it can't tell is done again in double
    for k in range(0, len(xa), 512):
        s = fa[k : k + 512] @ fb.T
        x, y = np.nonzero(s >= least - slack)
        close = s[x, y] < least + slack
        ok = ~close
        ok[close] = np.einsum("ij,ij->i", xa[x[close] + k], xb[y[close]]) >= least
        x, y = x[ok] + k, y[ok]
        if same:
            x, y = x[x < y], y[x < y]
        if len(x):
            ca += np.bincount(x, wb[y], len(ca))
            cb += np.bincount(y, wa[x], len(cb))
            links.add(x, y if same else y + len(na))
    leaf, root = links.stars()
    node = na if same else np.concatenate([na, nb])
    counts = ca + cb if same else np.concatenate([ca, cb])
    has = np.flatnonzero(counts)
    u = np.concatenate([node[leaf], node[has]])
    v = pa.array(np.concatenate([node[root], np.zeros(len(has), np.int64)]), mask=np.arange(len(u)) >= len(leaf))
    n = np.concatenate([np.zeros(len(leaf)), counts[has]]).astype(np.int64)
    return pa.RecordBatch.from_arrays([pa.array(u), v, pa.array(n)], names=["u", "v", "n"])


def digest(vectors: DataFrame) -> DataFrame:
    """The contract's columns."""
    return link(vectors.select("vec_id", "embedding"))


SQL = """
with recursive v as (
  select vec_id, embedding::double[] as e from embeddings
  where embedding is not null and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0 and len(list_filter(embedding, lambda x: x <> 0)) > 0),
p as (select a.vec_id as a, b.vec_id as b from v a join v b on a.vec_id <> b.vec_id and list_cosine_similarity(a.e, b.e) >= 0.9),
r(node, c) as (select vec_id, vec_id from v union select p.b, r.c from r join p on p.a = r.node),
n as (select a, count(*) as n_links from p group by a)
select m.vec_id, coalesce(n_links, 0) as n_links, coalesce(c, m.vec_id) as component_id, coalesce(c, m.vec_id) = m.vec_id as kept
from embeddings m left join n on n.a = m.vec_id left join (select node, min(c) as c from r group by node) x on x.node = m.vec_id
"""
