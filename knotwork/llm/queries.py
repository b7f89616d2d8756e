"""Queries of the training-data operators: each applies its operator, with production parameters, to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import bpe, chat_tools, embedding_dedup, line_dedup, mixing, ngram_quality, quality_rules, simhash, substring_dedup, toxicity
from .common import read_table


def _over(table: str, digest: Callable[[DataFrame], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    return lambda spark, sf_dir: digest(read_table(spark, sf_dir, table))


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.digest(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))


def op3_ngram_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_quality.digest(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_toxicity": op1_toxicity,
    "op2_line_dedup": _over("documents", line_dedup.digest),
    "op3_ngram_quality": op3_ngram_quality,
    "op4_byte_bpe": _over("documents", bpe.digest),
    "op5_substring_dedup": _over("documents", substring_dedup.digest),
    "op6_chat_tools": _over("conversations", chat_tools.digest),
    "op7_embedding_dedup": _over("embeddings", embedding_dedup.digest),
    "op8_source_mixing": _over("documents", mixing.digest),
    "op9_quality_rules": _over("documents", quality_rules.digest),
    "op10_simhash": _over("documents", simhash.digest),
}

MIXING_SQL = r"""
with d as (select doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) as size, md5('mix-' || doc_id) as key from documents),
s as (select source, sum(size)::bigint as source_size, row_number() over (order by source nulls last) - 1 as rank from d group by source),
w as (select *, case rank % 3 when 0 then 5 when 1 then 2 else 1 end as w, 2 * source_size as lim from s),
l as (select *, (1.5::double * sum(source_size) over () - coalesce(sum(lim) over up, 0)) / (sum(w) over () - coalesce(sum(w) over up, 0)) as level
      from w window up as (order by lim / w, rank rows between unbounded preceding and 1 preceding)),
c as (select arg_min(level, (lim / w, rank)) as level from l where level * w <= lim),
t as (select source, rank, source_size, least(lim::double, coalesce(c.level * w, lim)) as target from l left join c on true),
e as (select d.*, rank, source_size, target, sum(size) over (partition by rank order by key, doc_id rows unbounded preceding)::bigint - size as start
      from d join t on d.source is not distinct from t.source)
select doc_id, size::bigint as size, source_size, target,
       (greatest(0, least(size, floor(target)::bigint - start)) + greatest(0, least(size, floor(target)::bigint - start - source_size)))::bigint as taken
from e
"""

ORACLE_SQL: dict[str, str] = {
    "op2_line_dedup": line_dedup.SQL,
    "op5_substring_dedup": substring_dedup.SQL,
    "op6_chat_tools": chat_tools.SQL,
    "op7_embedding_dedup": embedding_dedup.SQL,
    "op8_source_mixing": MIXING_SQL,
    "op9_quality_rules": quality_rules.SQL,
}
