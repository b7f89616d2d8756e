"""Line dedup, in DataFrame functions only.

Explode normalised lines, hash them, count the documents of each hash, drop lines over the threshold and
put the rest together again by position.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import ascii_lower, cut, sha256_hex, strip_ascii


def line_keys(text: Column) -> Column:
    """Array of line keys. Case is folded before the split: it touches neither newlines nor white space."""
    lines = F.split(ascii_lower(F.coalesce(text, F.lit(""))), "\n")
    return F.transform(lines, strip_ascii)


def line_hashes(text: Column, min_chars: int) -> Column:
    """Array of 128-bit hashes of line keys, null where the key has fewer than min_chars code points."""

    def one(k: Column) -> Column:
        pair = F.struct(F.xxhash64(k).alias("h"), F.xxhash64(F.lit("line"), k).alias("g"))
        return F.when(F.char_length(k) >= min_chars, pair)

    return F.transform(line_keys(text), one)


def dedup_lines(docs: DataFrame, *, min_docs: int = 10, min_chars: int = 1, heavy_share: int = 10_000) -> DataFrame:
    """Drop every line whose key at least ``min_docs`` documents hold.

    Returns all columns of ``docs`` with ``text`` replaced, and ``n_lines``, ``n_dropped`` (columns of the
    same names in the input are replaced). Rows of one doc_id are one document, however often they repeat;
    rows without doc_id are one document for each distinct text. Each row comes back. Null or
    empty text is one empty line and comes back as the empty string. Keys below ``min_chars`` code points
    are never counted. Ties do not arise: a count is over the threshold or not.

    Only 128-bit hashes are shuffled for counting, distinct (hash, document) rows first, which spread a
    common line over all tasks, then sums by hash. To find the lines to drop,
    hashes in more than 1/``heavy_share`` of all rows - of which there can be ``heavy_share`` at most -
    are matched by broadcast; any other hash is at most that share of its join's rows. A document's
    dropped positions, never its text, are what is grouped again.
    """
    docs = docs.drop("n_lines", "n_dropped")
    ids = [F.xxhash64(F.lit(salt), F.col("doc_id").cast("string"), F.col("text")).alias(f"_row{salt}") for salt in (0, 1)]
    row = ["_row0", "_row1"]
    hashes = docs.select(*ids, "doc_id", line_hashes(F.col("text"), min_chars).alias("hs"))
    unnamed = F.when(F.isnull("doc_id"), F.col("_row0")).alias("_unnamed")
    once = hashes.select("doc_id", unnamed, F.explode(F.array_distinct(F.filter("hs", lambda h: h.isNotNull()))).alias("k"))
    once = once.select("k.h", "k.g", "doc_id", "_unnamed").distinct()
    counts = cut(once.groupBy("h", "g").agg(F.count("*").alias("n")).where(F.col("n") >= min_docs))
    total = counts.agg(F.sum("n")).first()[0] or 0
    floor = max(min_docs, total // heavy_share)  # fewer than heavy_share keys can lie above it
    heavy, light = counts.where(F.col("n") > floor), counts.where(F.col("n") <= floor)
    lines = hashes.select(*row, F.posexplode("hs").alias("pos", "k")).where("k is not null").select(*row, "pos", "k.h", "k.g")
    marked = lines.join(F.broadcast(heavy.select("h", "g", F.lit(True).alias("_heavy"))), ["h", "g"], "left")
    # what is decided goes through the join under its row's key, so that a common hash does not meet in one task
    key = {f"_k{n}": F.when(F.col("_heavy"), F.col(r)).otherwise(F.col(h)) for n, (r, h) in enumerate(zip(row, ("h", "g"), strict=True))}
    marked = marked.withColumns(key).drop("h", "g")
    light = light.select(F.col("h").alias("_k0"), F.col("g").alias("_k1"), F.lit(True).alias("_light"))
    hit = marked.join(light, ["_k0", "_k1"], "left").where("_heavy or _light")
    drops = hit.groupBy(*row).agg(F.collect_set("pos").alias("_drop"))
    # the split is below the join, so that the lambda further up indexes a column
    split = docs.select("*", *ids, F.split(F.coalesce("text", F.lit("")), "\n").alias("_lines")).drop("text")
    # texts pass by the positions, which are few, and are not sorted: a task holds one text at a time
    out = split.join(drops.hint("shuffle_hash"), row, "left").withColumn("_drop", F.coalesce("_drop", F.array().cast("array<int>")))
    left = F.array_except(F.sequence(F.lit(0), F.size("_lines") - 1), "_drop")
    kept = F.transform(left, lambda i: F.get("_lines", i))
    out = out.withColumns(
        {"text": F.array_join(kept, "\n"), "n_lines": F.size("_lines").cast("long"), "n_dropped": F.size("_drop").cast("long")}
    )
    return out.select(*docs.columns, "n_lines", "n_dropped")


def digest(docs: DataFrame) -> DataFrame:
    """The contract's columns."""
    out = dedup_lines(docs.select("doc_id", "text"))
    return out.select("doc_id", "n_lines", "n_dropped", sha256_hex(F.col("text")).alias("kept_sha256"))


SQL = r"""
with d as (select row_number() over () as row, doc_id, coalesce(text, '') as text, coalesce('i' || doc_id, 't' || md5(text), '') as who from documents),
l as (
  select row, doc_id, who, unnest(string_split(text, chr(10))) as line, unnest(range(len(string_split(text, chr(10))))) as pos
  from d),
k as (select row, doc_id, who, line, pos,
             trim(translate(line, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                  ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) as key from l),
f as (select key from k where length(key) >= 1 group by key having count(distinct who) >= 10),
j as (select k.*, f.key is not null as dropped from k left join f on k.key = f.key)
select doc_id, count(*) as n_lines, count(*) filter (where dropped) as n_dropped,
       sha256(coalesce(string_agg(line, chr(10) order by pos) filter (where not dropped), '')) as kept_sha256
from j group by row, doc_id
"""
