"""Corpus pipeline: quality classifier, line dedup, SimHash near-dedup, source mixing, byte-level BPE.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written as Parquet and read again
as the next stage's documents. All but the last return the columns of ``documents``. Every stage judges rows,
not ids, so null and repeated ids lose no other row's text; an empty table gives an empty table.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from knotwork.llm import bpe, line_dedup, mixing, ngram_quality, simhash
from knotwork.llm.common import ensure_checkpoint_dir, read_table


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose perplexity under the model of trusted text is in their language's range.

    Null and empty texts go, having no perplexity; a null language is held to the threshold over all languages,
    as are languages with little trusted text. A row with null doc_id is judged by its text. Without labels
    everything but empty texts stays.
    """
    return ngram_quality.keep_good(docs, read_table(spark, sf_dir, "labels"))


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the lines that ten or more of them hold; ``n_chars`` follows the text.

    Rows of one doc_id count as one document. No row goes; a text that loses all lines, or was null, is empty.
    """
    return line_dedup.dedup_lines(docs).select(*docs.columns).withColumn("n_chars", F.char_length("text").cast("long"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates, that of the smallest id (named before null).

    Texts without words are one group. Repeated rows leave one.
    """
    return simhash.keep_one(docs)


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them, not at all, once or twice, in order of their virtual finish times.

    A document without words stays once. A null source is a source.
    """
    return mixing.materialise(docs)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of each copy of each document of the mix, their count and hashes; null or empty text has none."""
    import public_tokenizers

    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    return bpe.encode(docs, ranks_path=path, pattern=public_tokenizers.PATTERN, keep_ids=True)


STAGES = [("quality", quality), ("line_dedup", lines), ("near_dedup", near_duplicates), ("mixing", mixture), ("bpe", tokens)]

#: SQL has no n-gram model over joins of this depth and no merges by rank; tests hold the rows against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows. Each stage's folder goes when the next one's is written; the last one stays to be read."""
    ensure_checkpoint_dir(spark)
    folder = f"{spark.sparkContext.getCheckpointDir()}/pipeline-{uuid.uuid4().hex}"
    docs, done = read_table(spark, sf_dir, "documents"), None
    for name, stage in STAGES:
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
        if done is not None:
            path = spark._jvm.org.apache.hadoop.fs.Path(done)
            path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
        done = f"{folder}/{name}"
    return docs
