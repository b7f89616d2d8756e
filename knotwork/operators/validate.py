"""Validation of result files: constraint predicates over lists of ids."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..sources import io
from . import metrics

HEADERS = {"matching": ("source1_entity_id", "matched_entity_ids"), "candidate": ("source1_entity_id", "candidate_entity_ids")}
EXAMPLES = 5


def counted(broken: DataFrame) -> DataFrame:
    """(rule, n, examples) of ``broken`` (rule, x): how often each rule is broken and its first few distinct x.

    No task gathers more than the examples of a rule, however many rows break it.
    """
    order = Window.partitionBy("rule").orderBy("x")
    first = broken.distinct().withColumn("_rank", F.row_number().over(order)).where(F.col("_rank") <= EXAMPLES)
    first = first.groupBy("rule").agg(F.array_sort(F.collect_list("x")).alias("examples"))
    return broken.groupBy("rule").agg(F.count("*").alias("n")).join(first, "rule")


def split_lists(lines: DataFrame) -> DataFrame:
    """(line, s1_id, ids, has_tab) of raw lines (line, value). Ids are not trimmed; an empty cell is no id."""
    cell = F.regexp_extract("value", r"^[^\t]*\t(.*)$", 1)
    ids = F.when(F.trim(cell) == "", F.array().cast("array<string>")).otherwise(F.split(F.trim(cell), ","))
    tab = F.contains(F.col("value"), F.lit("\t"))
    return lines.select("line", F.trim(F.substring_index("value", "\t", 1)).alias("s1_id"), ids.alias("ids"), tab.alias("has_tab"))


def row_rules(lists: DataFrame) -> DataFrame:
    """Rows of ``lists`` (s1_id, ids) with one flag for each rule a row can break by itself."""
    ids = F.col("ids")
    return lists.withColumns(
        {
            "repeated_id": F.size(ids) != F.size(F.array_distinct(ids)),
            "self_match": F.exists(ids, lambda x: x.startswith("S1-")),
            "wrong_prefix": F.exists(ids, lambda x: ~x.startswith("S1-") & ~x.startswith("S2-") & ~x.startswith("S3-")),
            "is_empty": F.size(ids) == 0,
        }
    )


def rule_counts(lists: DataFrame, required: DataFrame, targets: DataFrame | None = None) -> DataFrame:
    """(rule, n, examples) for the rules over (s1_id, ids); ``required`` (s1_id), ``targets`` (entity_id)."""
    flagged = row_rules(lists)
    rules = F.array(*[F.when(F.col(f), F.lit(f)) for f in ("repeated_id", "self_match", "wrong_prefix", "is_empty")])
    out = flagged.select(F.explode(F.array_compact(rules)).alias("rule"), F.col("s1_id").alias("x"))

    def rule(df: DataFrame, name: str, column: str) -> DataFrame:
        return df.select(F.lit(name).alias("rule"), F.col(column).alias("x"))

    ids = lists.select("s1_id")
    out = out.unionByName(rule(ids.groupBy("s1_id").count().where("count > 1"), "duplicate_s1", "s1_id"))
    out = out.unionByName(rule(required.select("s1_id").distinct().join(ids, "s1_id", "left_anti"), "missing_s1", "s1_id"))
    out = out.unionByName(rule(ids.distinct().join(required.select("s1_id"), "s1_id", "left_anti"), "extra_s1", "s1_id"))
    if targets is not None:
        named = lists.select(F.explode("ids").alias("entity_id")).where("entity_id like 'S2-%' or entity_id like 'S3-%'")
        out = out.unionByName(rule(named.join(targets, "entity_id", "left_anti").distinct(), "unknown_id", "entity_id"))
    return counted(out)


def not_in_candidates(matches: DataFrame, candidates: DataFrame) -> DataFrame:
    """(s1_id, outside): matched ids that are no candidates. Both are (s1_id, ids)."""
    c = candidates.select("s1_id", F.col("ids").alias("_c"))
    outside = F.array_except("ids", F.coalesce("_c", F.array().cast("array<string>")))
    return matches.join(c, "s1_id", "left").select("s1_id", F.array_sort(outside).alias("outside")).where(F.size("outside") > 0)


def check_header(line: str | None, kind: str) -> str | None:
    """What is wrong with a file's first line."""
    if line is None or not line.strip():
        return "file is empty"
    if "\t" not in line and "," in line:
        return "header is separated by commas, not tabs"
    got = tuple(x.strip().lower() for x in line.rstrip("\r\n").split("\t"))
    return None if got == HEADERS[kind] else f"header is {got}, expected {HEADERS[kind]}"


def validate_file(spark: SparkSession, path: str, kind: str, required: DataFrame, targets: DataFrame | None = None) -> tuple[list[str], DataFrame | None]:
    """(errors, lists) of one result file."""
    if not io.exists(spark, path):
        return [f"{path} is missing"], None
    lines = io.line_numbers(spark.read.text(path))
    head = lines.where("line = 1").select("value").first()
    wrong = check_header(head[0] if head else None, kind)
    if wrong:
        return [f"{path}: {wrong}"], None
    rows = split_lists(lines.where("line > 1 and trim(value) <> ''"))
    bad = rows.where("not has_tab")
    if n := bad.count():
        first = ", ".join(str(r["line"]) for r in bad.orderBy("line").limit(EXAMPLES).collect())
        errors = [f"{path}: {n} line{'s' * (n > 1)} without a tab, first {first}"]
    else:
        errors = []
    lists = rows.where("has_tab").select("s1_id", "ids")
    for r in rule_counts(lists, required, targets).where("rule <> 'is_empty'").orderBy("rule").collect():
        errors.append(f"{path}: {r['rule']}: {r['n']}, such as {', '.join(r['examples'])}")
    return errors, lists


def validate(spark: SparkSession, matching: str, candidate: str | None, folder: str, *, check_ids: bool = False) -> tuple[list[str], list[str]]:
    """(errors, warnings) of a matching file and, if given, its candidate file, against the sources in ``folder``."""
    warnings: list[str] = []
    prefixes = ("test", "train")
    required = io.read_ids(spark, io.find_table(spark, folder, "source1", prefixes)).withColumnRenamed("entity_id", "s1_id")
    targets = io.match_targets(spark, folder, prefixes) if check_ids else None
    if check_ids and targets is None:
        warnings.append("no source 2 or 3: ids are not checked")
    errors, matches = validate_file(spark, matching, "matching", required, targets)
    if candidate is not None:
        more, candidates = validate_file(spark, candidate, "candidate", required, targets)
        errors += more
        if matches is not None and candidates is not None:
            n = not_in_candidates(matches, candidates).count()
            if n:
                warnings.append(f"{n} entities have matches outside their candidates")
    return errors, warnings


def audit_report(spark: SparkSession, matching: str, candidate: str | None, folder: str, targets: list[str], *, check_ids: bool = False) -> str:
    """Counts of both files and what validation says, as text, written to every path of ``targets``."""
    lines = []
    for kind, path in (("matching", matching), ("candidate", candidate)):
        if path is None or not io.exists(spark, path):
            lines.append(f"{kind}: no file")
            continue
        rows = split_lists(io.line_numbers(spark.read.text(path)).where("line > 1 and trim(value) <> ''"))
        counts = metrics.file_integrity(rows.select("s1_id", "ids")).first().asDict()
        lines += [f"{kind}: {path}", *(f"  {k}: {v}" for k, v in counts.items())]
    errors, warnings = validate(spark, matching, candidate, folder, check_ids=check_ids)
    lines += [f"error: {e}" for e in errors] + [f"warning: {w}" for w in warnings]
    lines.append("valid" if not errors else "not valid")
    text = "\n".join(lines) + "\n"
    for path in targets:
        io.write_text(spark, path, text)
    return text
