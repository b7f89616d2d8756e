"""TF-IDF over padded character n-grams: weights as joins on n-grams, neighbours in tiles of a part's texts."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def padded_ngrams(text: Column, low: int = 3, high: int = 4) -> Column:
    """N-grams inside words padded by a space on both sides; a padded word shorter than n is its own, once.

    Repeats are kept: they are term frequencies.
    """
    words = F.filter(F.split(F.regexp_replace(text, r"\s+", " "), " "), lambda w: w != "")

    def slices(w: Column, n: int) -> Column:
        return F.transform(F.sequence(F.lit(1), F.length(w) - (n - 1)), lambda i: F.substr(w, i, F.lit(n)))

    def of_word(w: Column) -> Column:
        w = F.concat(F.lit(" "), w, F.lit(" "))
        parts = []
        for n in range(low, high + 1):
            grams = slices(w, n)
            # a word too short for the shortest n-gram comes once
            short = F.array(w) if n == low else F.array().cast("array<string>")
            parts.append(F.when(F.length(w) >= n, grams).otherwise(short))
        return F.concat(*parts)

    return F.flatten(F.transform(words, of_word))


def term_counts(docs: DataFrame, low: int = 3, high: int = 4, counted: bool = True) -> DataFrame:
    """(entity_id, part, gram, tf) of ``docs`` (entity_id, part, text); not ``counted``, ``docs`` with each gram once, which is narrow."""
    if not counted:
        return docs.select("*", F.explode(F.array_distinct(padded_ngrams(F.col("text"), low, high))).alias("gram"))
    return docs.select("entity_id", "part", F.explode(padded_ngrams(F.col("text"), low, high)).alias("gram")).groupBy("entity_id", "part", "gram").agg(F.count("*").alias("tf"))


def document_counts(counts: DataFrame, copies: DataFrame | None = None) -> DataFrame:
    """(part, gram, df) of term counts or weights; with ``copies`` (entity_id, copies) a row stands for so many."""
    if copies is None:
        return counts.groupBy("part", "gram").agg(F.count("*").alias("df"))
    return counts.join(copies, "entity_id").groupBy("part", "gram").agg(F.sum("copies").alias("df"))


def idf_table(counts: DataFrame, sizes: DataFrame, copies: DataFrame | None = None) -> DataFrame:
    """(part, gram, idf): ln((1 + N) / (1 + df)) + 1. ``sizes`` has part, n."""
    df = document_counts(counts, copies)
    return df.join(sizes, "part").select("part", "gram", (F.log((1.0 + F.col("n")) / (1.0 + F.col("df"))) + 1.0).alias("idf"))


def weights(counts: DataFrame, idf: DataFrame) -> DataFrame:
    """(entity_id, part, gram, w): sublinear term frequency times idf, rows of unit length; unknown grams drop out."""
    raw = counts.join(idf, ["part", "gram"]).withColumn("x", (1.0 + F.log("tf")) * F.col("idf"))
    norm = raw.groupBy("entity_id").agg(F.sqrt(F.sum(F.col("x") * F.col("x"))).alias("norm"))
    return raw.join(norm, "entity_id").select("entity_id", "part", "gram", (F.col("x") / F.col("norm")).alias("w"))


def fit_weights(docs: DataFrame, low: int = 3, high: int = 4) -> DataFrame:
    counts = term_counts(docs, low, high)
    return weights(counts, idf_table(counts, docs.where("text <> ''").groupBy("part").agg(F.count("*").alias("n"))))


#: Texts and n-grams of a side of a tile at most (but for a longer text), and cells that are summed at once.
TEXTS_A_TILE, GRAMS_A_TILE, CELLS = 20_000, 4_000_000, 2_000_000


def _vectors(texts: pa.Table, codes: np.ndarray, idf: np.ndarray, used: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, place in ``codes``, weight) of each different n-gram of ``texts`` that is used; rows have unit length with all of them."""
    lists = texts["codes"].combine_chunks()
    of = np.repeat(np.arange(len(lists)), np.diff(lists.offsets.to_numpy()))
    at = np.searchsorted(codes, lists.flatten().to_numpy())
    cells, tf = np.unique(of * len(codes) + at, return_counts=True)
    of, at = np.divmod(cells, len(codes))
    x = (1.0 + np.log(tf)) * idf[at]
    w = x / np.sqrt(np.bincount(of, weights=x * x, minlength=len(lists)))[of]
    return of[used[at]], at[used[at]], w[used[at]]


def _tile(k: int, least: float) -> Callable[[pa.Table], pa.Table]:
    """The ``k`` most similar right texts of each left one of a tile, equal similarities by ``head``.

    N-grams in over a quarter of the right texts are summed as a dense product, the others by their lists of right texts.
    """

    def run(table: pa.Table) -> pa.Table:
        kind = table["kind"].to_numpy()
        grams = table.filter(kind == 0)
        codes, idf, used = (grams[c].to_numpy() for c in ("code", "idf", "used"))
        order = np.argsort(codes)
        codes, idf, used = codes[order], idf[order], used[order]
        left, right = table.filter(kind == 1), table.filter(kind == 2).sort_by("head")
        n = right.num_rows
        found = []
        if left.num_rows and n:
            row, col, w = _vectors(left, codes, idf, used)
            r_row, r_col, r_w = _vectors(right, codes, idf, used)
            by_col = np.argsort(r_col, kind="stable")
            r_row, r_w = r_row[by_col], r_w[by_col]
            starts = np.searchsorted(r_col[by_col], np.arange(len(codes) + 1))
            many = np.flatnonzero(np.diff(starts) > n / 4)
            dense = np.zeros((len(many), n))
            for i, c in enumerate(many):
                dense[i, r_row[starts[c] : starts[c + 1]]] = r_w[starts[c] : starts[c + 1]]
            place = np.full(len(codes), -1)
            place[many] = np.arange(len(many))
            step = max(1, CELLS // n)
            for low in range(0, left.num_rows, step):
                some = min(step, left.num_rows - low)
                a, b = np.searchsorted(row, [low, low + some])
                i, c, x = row[a:b] - low, col[a:b], w[a:b]
                common = place[c] >= 0
                mine = np.zeros((some, len(many)))
                mine[i[common], place[c[common]]] = x[common]
                i, c, x = i[~common], c[~common], x[~common]
                size = starts[c + 1] - starts[c]
                # places of the lists' entries, list after list
                entry = np.repeat(starts[c] - np.cumsum(size) + size, size) + np.arange(size.sum())
                sums = mine @ dense
                sums += np.bincount(np.repeat(i * n, size) + r_row[entry], weights=np.repeat(x, size) * r_w[entry], minlength=some * n).reshape(some, n)
                lowest = np.partition(sums, n - k, axis=1)[:, n - k] if n > k else np.zeros(some)
                # what can be rounded up to the last place or to the least similarity
                i, j = np.nonzero((sums > 0) & (sums >= np.maximum(lowest, least)[:, None] - 1.1e-6))
                value = np.floor(sums[i, j] * 1e6 + 0.5) / 1e6
                i, j, value = i[value >= least], j[value >= least], value[value >= least]
                best = np.lexsort((j, -value, i))
                i, j, value = i[best], j[best], value[best]
                best = np.arange(len(i)) - np.searchsorted(i, i) < k
                found.append((i[best] + low, j[best], value[best]))
        i, j, value = (np.concatenate(x) for x in zip(*found, strict=True)) if found else (np.array([], dtype=int), np.array([], dtype=int), np.array([]))
        return pa.table({"_left": left["id"].take(pa.array(i)), "_right": right["id"].take(pa.array(j)), "similarity": value})

    return run


def nearest(left: DataFrame, right: DataFrame, *, k: int = 30, least: float = 0.12, ngram_range: tuple[int, int] = (3, 4), max_df: int | None = None) -> DataFrame:
    """(s1_id, candidate_id, similarity): for each left row its ``k`` nearest right rows of the same part.

    Both sides are (entity_id, part, text), an id once on a side; idf is over all rows of both. Equal texts of a part are one class,
    searched once for all rows that have it. Classes are compared in tiles of a part, all left with all right ones: a class travels
    once for each block of the other side, and no more than its ``k`` nearest of a tile come back. ``max_df``
    leaves grams in more rows than that out altogether, for tables where they would still dominate.
    Similarities are rounded to 6 places before ranking, ties by id.
    """
    low, high = ngram_range
    both = left.withColumn("side", F.lit(1)).unionByName(right.withColumn("side", F.lit(2)))
    name = F.concat_ws(":", F.col("side").cast("string"), F.col("entity_id").cast("string"))
    sides = [F.max(F.col("side") == n).alias(f"_in_{n}") for n in (1, 2)]
    head = F.min(F.when(F.col("side") == 2, F.col("entity_id"))).alias("head")
    classes = both.groupBy("part", "text").agg(F.min(name).alias("entity_id"), F.count("*").alias("copies"), *sides, head)
    code = F.xxhash64("gram").alias("code")
    # a class has a gram once
    df = term_counts(classes, low, high, False).groupBy("part", code).agg(F.sum("copies").alias("df"))
    sizes = classes.where("text <> ''").groupBy("part").agg(F.sum("copies").alias("n"))
    used = F.lit(True) if max_df is None else F.col("df") <= max_df
    idf = df.join(sizes, "part").select("part", "code", (F.log((1.0 + F.col("n")) / (1.0 + F.col("df"))) + 1.0).alias("idf"), used.alias("used"))
    # split before n-grams are hashed, so that they are made once a class
    coded = classes.select("part", F.col("entity_id").alias("id"), "head", "_in_1", "_in_2", F.transform(padded_ngrams(F.col("text"), low, high), lambda g: F.xxhash64(g)).alias("codes")).where(F.size("codes") > 0)
    blocks = [F.ceil(F.greatest(F.sum(side.cast("int")) / TEXTS_A_TILE, F.sum(F.when(side, F.size("codes"))) / GRAMS_A_TILE)).cast("int") for side in (F.col("_in_1"), F.col("_in_2"))]
    blocks = coded.groupBy("part").agg(blocks[0].alias("_n1"), blocks[1].alias("_n2")).where("_n1 > 0 and _n2 > 0")

    def dealt(rows: DataFrame, kind: int, one: Column | None, two: Column | None) -> DataFrame:
        """``rows`` in the tiles of their part, at ``one`` and ``two`` or at all places."""
        every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
        tiles = rows.join(blocks, "part").withColumn("_1", every("_n1") if one is None else one).withColumn("_2", every("_n2") if two is None else two)
        have = {"id": "string", "head": dict(right.dtypes)["entity_id"], "codes": "array<bigint>", "code": "bigint", "idf": "double", "used": "boolean"}
        return tiles.select("part", "_1", "_2", F.lit(kind).alias("kind"), *[(F.col(c) if c in rows.columns else F.lit(None)).cast(t).alias(c) for c, t in have.items()])

    block = lambda n: F.pmod(F.xxhash64("id"), F.col(n)).cast("int")
    tiles = dealt(idf, 0, None, None).unionByName(dealt(coded.where("_in_1"), 1, block("_n1"), None)).unionByName(dealt(coded.where("_in_2"), 2, None, block("_n2")))
    sims = tiles.groupBy("part", "_1", "_2").applyInArrow(_tile(k, least), "_left string, _right string, similarity double")

    def first(df: DataFrame, by: str, *order: Column | str) -> DataFrame:
        return df.withColumn("_rank", F.row_number().over(Window.partitionBy(by).orderBy(*order))).where(F.col("_rank") <= k).drop("_rank")

    def members(side: DataFrame, id_name: str, class_name: str) -> DataFrame:
        return side.select(F.col("entity_id").alias(id_name), "part", "text").join(classes.select("part", "text", F.col("entity_id").alias(class_name)), ["part", "text"]).select(id_name, class_name)

    targets = first(members(right, "candidate_id", "_right"), "_right", "candidate_id")
    # each class has a row, its first one, so that only a left class's first k classes can have one of its k nearest rows
    heads = sims.join(targets.groupBy("_right").agg(F.min("candidate_id").alias("_head")), "_right")
    near = first(heads, "_left", F.col("similarity").desc(), "_head").drop("_head").join(targets, "_right")
    found = first(near, "_left", F.col("similarity").desc(), "candidate_id")
    return found.join(members(left, "s1_id", "_left"), "_left").select("s1_id", "candidate_id", "similarity")


def pair_cosine(pairs: DataFrame, weights_left: DataFrame, weights_right: DataFrame, name: str) -> DataFrame:
    """``pairs`` (s1_id, candidate_id, ...) with the dot product of both rows' weights; 0 without a common gram."""
    a = pairs.select("s1_id", "candidate_id").join(weights_left.select(F.col("entity_id").alias("s1_id"), "gram", F.col("w").alias("wa")), "s1_id")
    b = weights_right.select(F.col("entity_id").alias("candidate_id"), "gram", F.col("w").alias("wb"))
    dots = a.join(b, ["candidate_id", "gram"]).groupBy("s1_id", "candidate_id").agg(F.sum(F.col("wa") * F.col("wb")).alias(name))
    return pairs.join(dots, ["s1_id", "candidate_id"], "left").withColumn(name, F.coalesce(name, F.lit(0.0)))
