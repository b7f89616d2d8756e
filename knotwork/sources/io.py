"""Sources and sinks: tab-separated records and labels, shards, manifests, JSON markers.

Data is read and written by Spark; only paths are resolved here, through Hadoop's file systems, so that any
store Spark reads will do.
"""

from __future__ import annotations

import json
import posixpath

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as TY

RECORD = TY.StructType([TY.StructField(n, TY.StringType()) for n in ("entity_id", "business_name", "business_address", "country")])
LABEL = TY.StructType([TY.StructField(n, TY.StringType()) for n in ("source1_entity_id", "matched_entity_ids")])
ALIASES = {"name": "business_name", "address": "business_address"}


# --- paths ---------------------------------------------------------------------------------------


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def exists(spark: SparkSession, path: str) -> bool:
    fs, p = _fs(spark, path)
    return fs.exists(p)


def is_dir(spark: SparkSession, path: str) -> bool:
    fs, p = _fs(spark, path)
    return fs.exists(p) and fs.getFileStatus(p).isDirectory()


def list_dir(spark: SparkSession, path: str) -> list[tuple[str, int, int]]:
    """(path, bytes, modified) of a directory's entries, by name."""
    fs, p = _fs(spark, path)
    return sorted((str(s.getPath()), s.getLen(), s.getModificationTime()) for s in fs.listStatus(p)) if fs.exists(p) else []


def delete(spark: SparkSession, path: str) -> None:
    fs, p = _fs(spark, path)
    fs.delete(p, True)


def copy(spark: SparkSession, source: str, target: str) -> None:
    """Copy a file or a directory, over what is there."""
    (fs_a, a), (fs_b, b) = _fs(spark, source), _fs(spark, target)
    fs_b.delete(b, True)
    spark.sparkContext._jvm.org.apache.hadoop.fs.FileUtil.copy(fs_a, a, fs_b, b, False, spark.sparkContext._jsc.hadoopConfiguration())


def shard_files(spark: SparkSession, path: str) -> list[str]:
    """Files of a shard directory: those named ``part`` if there are any, else all; our own sinks end in .csv."""
    files = [p for p, _, _ in list_dir(spark, path) if p.endswith((".tsv", ".tsv.gz", ".csv", ".csv.gz"))]
    parts = [p for p in files if "part" in posixpath.basename(p)]
    found = parts or files
    if not found:
        raise FileNotFoundError(f"no .tsv or .tsv.gz file in {path}")
    return found


def resolve(spark: SparkSession, path: str) -> list[str]:
    """A table's files: the path, its .gz, or the directory named by its stem."""
    stem = path.removesuffix(".gz").removesuffix(".tsv")
    for candidate in (path, path + ".gz", stem):
        if exists(spark, candidate):
            return shard_files(spark, candidate) if is_dir(spark, candidate) else [candidate]
    raise FileNotFoundError(path)


def find_table(spark: SparkSession, folder: str, name: str, prefixes: tuple[str, ...] = ("train",)) -> str:
    """First of <folder>/<prefix>_<name>.tsv, .tsv.gz, its directory, and the same under data/shards/<prefix>."""
    for prefix in prefixes:
        for base in (folder, f"{folder}/data/shards/{prefix}"):
            for suffix in (".tsv", ".tsv.gz", ""):
                path = f"{base}/{prefix}_{name}{suffix}"
                if exists(spark, path):
                    return path
    raise FileNotFoundError(f"{folder}: no table {name} with prefix {' or '.join(prefixes)}")


def first_existing(spark: SparkSession, folders: list[str]) -> str | None:
    return next((f for f in folders if exists(spark, f)), None)


def newest(spark: SparkSession, folder: str, part: str) -> str | None:
    """Newest non-empty file whose name holds ``part``."""
    found = [(t, p) for p, size, t in list_dir(spark, folder) if part in posixpath.basename(p) and size > 0]
    return max(found)[1] if found else None


# --- sources -------------------------------------------------------------------------------------


def _csv(spark: SparkSession, path: str, schema: TY.StructType, quoted: bool = True) -> DataFrame:
    reader = spark.read.option("sep", "\t").option("header", True).option("enforceSchema", True).option("mode", "PERMISSIVE")
    reader = reader.option("quote", '"').option("escape", '"') if quoted else reader.option("quote", "")
    return reader.schema(schema).csv(resolve(spark, path))


def _strip(c: Column) -> Column:
    """Without white space of any alphabet, line ends and separators at both ends."""
    return F.regexp_replace(c, r"(?U)^[\s\x1c-\x1f]+|[\s\x1c-\x1f]+$", "")


def read_records(spark: SparkSession, path: str, *, limit: int | None = None, last_wins: bool = True) -> DataFrame:
    """Entity records: cells stripped, missing ones empty, the last row of a repeated id.

    The order of rows is that of their files and their places in them. ``limit`` keeps that many ids, the
    first ones by id.
    """
    df = _csv(spark, path, RECORD)
    if last_wins:
        df = df.withColumns({"_file": F.input_file_name(), "_at": F.monotonically_increasing_id()})
    df = df.select(*[_strip(F.coalesce(c, F.lit(""))).alias(c) for c in RECORD.names], *(["_file", "_at"] if last_wins else []))
    df = df.where("entity_id <> ''")
    if last_wins:
        rest = [F.struct("_file", "_at", *RECORD.names[1:])]
        df = df.groupBy("entity_id").agg(F.max(rest[0]).alias("r")).select("entity_id", *[f"r.{c}" for c in RECORD.names[1:]])
    return df if limit is None else df.orderBy("entity_id").limit(limit)


def read_records_by_name(spark: SparkSession, path: str) -> DataFrame:
    """Records of a file whose header may name the columns otherwise (name, address) or order them otherwise."""
    df = spark.read.option("sep", "\t").option("header", True).option("quote", "").csv(resolve(spark, path))
    renamed = {ALIASES.get(c.strip().lower(), c.strip().lower()): c for c in df.columns}
    return df.select(*[_strip(F.coalesce(F.col(f"`{renamed[c]}`") if c in renamed else F.lit(""), F.lit(""))).alias(c) for c in RECORD.names])


def read_labels(spark: SparkSession, path: str, *, limit: int | None = None) -> DataFrame:
    """(s1_id, match_ids): ids split at commas, trimmed, blanks dropped, repeated rows united, sorted."""
    df = _csv(spark, path, LABEL)
    return unite_labels(df.select(F.trim("source1_entity_id").alias("s1_id"), F.col("matched_entity_ids").alias("ids")), limit)


def unite_labels(df: DataFrame, limit: int | None = None) -> DataFrame:
    """``df`` has s1_id and ids, a comma-joined list."""
    ids = F.filter(F.transform(F.split(F.coalesce("ids", F.lit("")), ","), lambda x: F.trim(x)), lambda x: x != "")
    long = df.where("s1_id <> ''").select("s1_id", F.explode_outer(ids).alias("match_id"))
    out = long.groupBy("s1_id").agg(F.array_sort(F.collect_set("match_id")).alias("match_ids"))
    return out if limit is None else out.orderBy("s1_id").limit(limit)


def read_ids(spark: SparkSession, path: str) -> DataFrame:
    """Distinct non-blank values of the first column."""
    lines = spark.read.option("sep", "\t").option("header", True).option("quote", "").csv(resolve(spark, path))
    first = F.trim(F.col(f"`{lines.columns[0]}`"))
    return lines.select(first.alias("entity_id")).where("entity_id <> ''").distinct()


def match_targets(spark: SparkSession, folder: str, prefixes: tuple[str, ...] = ("test", "train")) -> DataFrame | None:
    """Distinct ids of sources 2 and 3; None if neither is there."""
    found = []
    for name in ("source2", "source3"):
        try:
            found.append(read_ids(spark, find_table(spark, folder, name, prefixes)))
        except FileNotFoundError:
            continue
    if not found:
        return None
    return found[0] if len(found) == 1 else found[0].union(found[1]).distinct()


def sampled_subset(records: DataFrame, needed: DataFrame, *, distractors: int, rate: float = 0.25, salt: str = "subset") -> DataFrame:
    """All needed rows and at most ``distractors`` others, each others' row with probability ``rate``.

    Chance is a hash of the id, so reruns agree.
    """
    wanted = records.join(needed.select("entity_id").distinct(), "entity_id", "left_semi")
    chance = F.pmod(F.xxhash64(F.lit(salt), F.col("entity_id")), F.lit(1_000_000)) / 1_000_000
    others = records.join(needed.select("entity_id").distinct(), "entity_id", "left_anti").where(chance < rate)
    return wanted.unionByName(others.orderBy(F.xxhash64(F.lit(salt), F.col("entity_id")), "entity_id").limit(distractors))


# --- sinks ---------------------------------------------------------------------------------------


def id_list(df: DataFrame, spine: DataFrame, s1: str, target: str, name: str) -> DataFrame:
    """One row per row of ``spine`` (s1): its ids sorted and comma-joined, "" without any."""
    lists = df.groupBy(s1).agg(F.array_join(F.array_sort(F.collect_set(target)), ",").alias(name))
    return spine.select(s1).distinct().join(lists, s1, "left").select(s1, F.coalesce(name, F.lit("")).alias(name))


def write_tsv(df: DataFrame, path: str, *, order: Column | str | None = None, gz: bool = False, rows_per_file: int = 0, single: bool = False) -> None:
    """Tab-separated with header; one global order if asked for, one file only if asked for."""
    if order is not None:
        df = df.orderBy(order)
    if single:
        df = df.coalesce(1)
    writer = df.write.mode("overwrite").option("sep", "\t").option("header", True).option("emptyValue", "")
    if rows_per_file:
        writer = writer.option("maxRecordsPerFile", rows_per_file)
    if gz:
        writer = writer.option("compression", "gzip")
    writer.csv(path)


def write_candidates(pairs: DataFrame, spine: DataFrame, path: str, **options) -> None:
    """``pairs`` has s1_id, candidate_id; every id of the spine gets a row."""
    out = id_list(pairs, spine, "s1_id", "candidate_id", "candidate_entity_ids").withColumnRenamed("s1_id", "source1_entity_id")
    write_tsv(out, path, order="source1_entity_id", **options)


def write_matches(pairs: DataFrame, spine: DataFrame, path: str, **options) -> None:
    out = id_list(pairs, spine, "s1_id", "candidate_id", "matched_entity_ids").withColumnRenamed("s1_id", "source1_entity_id")
    write_tsv(out, path, order="source1_entity_id", **options)


def read_pairs(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """(pairs, spine) of a candidate or match file."""
    df = read_labels(spark, path)
    return df.select("s1_id", F.explode("match_ids").alias("candidate_id")), df.select("s1_id")


def write_normalized(records: DataFrame, path: str, **options) -> None:
    """The seven-column normalized file."""
    from ..functions.text import normalize_records

    n = normalize_records(records)
    numbers = F.array_join("address_numbers", " ").alias("addr_numbers")
    write_tsv(n.select("entity_id", "country", F.col("name").alias("name_clean"), "name_sorted", F.col("address").alias("addr_clean"), F.col("address_sorted").alias("addr_sorted"), numbers), path, **options)


def write_shards(spark: SparkSession, source: str, target: str, *, rows: int = 500_000, gz: bool = True) -> DataFrame:
    """Shards of at most ``rows`` rows with a header each; returns the manifest."""
    df = spark.read.option("sep", "\t").option("header", True).option("quote", "").csv(resolve(spark, source))
    write_tsv(df, target, gz=gz, rows_per_file=rows)
    return manifest(spark, target)


def write_folder_shards(spark: SparkSession, source: str, target: str, **options) -> dict[str, DataFrame]:
    """Shards of every .tsv file of a folder, each in a directory named by its stem."""
    out = {}
    for path, _, _ in list_dir(spark, source):
        if path.endswith((".tsv", ".tsv.gz")):
            stem = posixpath.basename(path).removesuffix(".gz").removesuffix(".tsv")
            out[stem] = write_shards(spark, path, f"{target}/{stem}", **options)
    return out


def manifest(spark: SparkSession, path: str) -> DataFrame:
    """Per shard: file, rows, bytes, sha256."""
    data = spark.read.option("sep", "\t").option("header", True).option("quote", "").csv(path)
    name = F.element_at(F.split(F.input_file_name(), "/"), -1).alias("file")
    rows = data.select(name).groupBy("file").agg(F.count("*").alias("rows"))
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.csv*").load(path)
    sums = files.select(F.element_at(F.split("path", "/"), -1).alias("file"), F.col("length").alias("bytes"), F.sha2("content", 256).alias("sha256"))
    return sums.join(rows, "file", "left").select("file", F.coalesce("rows", F.lit(0)).alias("rows"), "bytes", "sha256").orderBy("file")


def file_sha256(spark: SparkSession, path: str) -> str | None:
    """Read as a stream, so that no file is too large; None if it is missing."""
    if not exists(spark, path):
        return None
    (fs, p), java = _fs(spark, path), spark._jvm.java
    digest = java.security.MessageDigest.getInstance("SHA-256")
    stream = java.security.DigestInputStream(fs.open(p), digest)
    spark._jvm.org.apache.hadoop.io.IOUtils.copyBytes(stream, java.io.OutputStream.nullOutputStream(), 1 << 20, True)
    return bytes(digest.digest()).hex()


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """A small text, under a temporary name first: readers see the old file or the new one."""
    fs, p = _fs(spark, path)
    _, temp = _fs(spark, f"{path}.tmp")
    out = fs.create(temp, True)
    out.write(bytearray(text.encode()))
    out.close()
    hadoop = spark._jvm.org.apache.hadoop.fs
    options = spark.sparkContext._gateway.new_array(hadoop.Options.Rename, 1)
    options[0] = hadoop.Options.Rename.OVERWRITE
    hadoop.FileContext.getFileContext(fs.getUri(), fs.getConf()).rename(fs.makeQualified(temp), fs.makeQualified(p), options)


def write_json(spark: SparkSession, path: str, data) -> None:
    write_text(spark, path, json.dumps(data, indent=2, ensure_ascii=False))


def read_json(spark: SparkSession, path: str):
    """None if the file is missing or no JSON."""
    if not exists(spark, path):
        return None
    try:
        return json.loads("\n".join(r[0] for r in spark.read.text(path).collect()))
    except ValueError:
        return None


def line_numbers(df: DataFrame, column: str = "line") -> DataFrame:
    """Rows of a text read with their line number by file order, from 1, without gathering them in one task."""
    at = df.withColumn("_at", F.monotonically_increasing_id()).withColumn("_part", F.shiftright("_at", 33))
    starts = at.groupBy("_part").agg(F.count("*").alias("_n"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = starts.withColumn("_start", F.coalesce(F.sum("_n").over(before), F.lit(0))).select("_part", "_start")
    joined = at.join(F.broadcast(starts), "_part")
    return joined.withColumn(column, F.col("_start") + F.col("_at").bitwiseAND(F.lit((1 << 33) - 1)) + 1).drop("_at", "_part", "_start")
