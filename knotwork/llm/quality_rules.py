"""Quality rules, in DataFrame functions only.

A table of thresholds is compiled into one projection of length, symbol, stop-word and line ratios.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import GAP, words_of

#: Frequent function words of the four languages in the tables.
STOP_WORDS = (
    "the of and to in a is that it for on was with as by be this are or an at from "
    "de la le les et des en un une du est que pour dans qui sur par au "
    "der die das und ist ein eine zu den von mit nicht auf für im sich dem "
    "el los las que y por con una del se no su para es al"
).split()
SYMBOLS = "#*$%&|<>"


@dataclass(frozen=True)
class Rule:
    """``measure`` must lie in [low, high] (either may be open) where the text has ``least_words`` or more."""

    name: str
    measure: str
    low: float | None = None
    high: float | None = None
    least_words: int = 0


#: The production table. Measures are those of :func:`measures`.
RULES = (
    Rule("length", "n_words", low=20),
    Rule("long_words", "mean_word_chars", high=25.0),
    Rule("short_words", "mean_word_chars", low=2.0),
    Rule("symbols", "symbols_per_word", high=0.30),
    Rule("upper", "upper_share", high=0.50, least_words=20),
    Rule("stop_words", "stop_share", low=0.01, least_words=80),
    Rule("dup_lines", "dup_line_share", high=0.50),
    Rule("repeats", "repeat_share", high=0.30),
)


def _size_of_union(starts: Column, n: int) -> Column:
    """Length of the union of [p, p + n) over an ascending array of distinct starts."""
    steps = F.zip_with(starts, F.slice(starts, 2, F.greatest(F.size(starts), F.lit(1))), lambda a, b: F.least(F.lit(n), F.coalesce(b - a, F.lit(n))))
    return F.aggregate(steps, F.lit(0), lambda acc, x: acc + x)


def measure(docs: DataFrame, *, window: int = 8) -> DataFrame:
    """Adds the base counts and the ratios the rules speak of, one array per projection.

    A window's 64-bit hash stands for its words within one text.
    """
    body = F.coalesce("text", F.lit(""))
    starts = F.when(F.size("_w") >= window, F.sequence(F.lit(0), F.size("_w") - window)).otherwise(F.array().cast("array<int>"))
    out = docs.withColumns({"_w": words_of(F.col("text")), "_l": F.filter(F.split(body, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))})
    out = out.withColumns(
        {
            "n_words": F.size("_w").cast("long"),
            "word_chars": F.char_length(F.array_join("_w", "")).cast("long"),
            "n_symbols": F.regexp_count(body, F.lit("[" + SYMBOLS + "]")).cast("long"),
            "n_upper": F.regexp_count(body, F.lit("[A-Z]")).cast("long"),
            "n_stop": F.size(F.filter("_w", lambda w: F.lower(w).isin(STOP_WORDS))).cast("long"),
            "n_lines": F.size("_l").cast("long"),
            "n_dup_lines": (F.size("_l") - F.size(F.array_distinct("_l"))).cast("long"),
            "_h": F.transform(starts, lambda i: F.xxhash64(F.slice("_w", i + 1, window))),
        }
    )
    # only a text with two equal windows pays for sorting them
    paired = F.sort_array(F.transform("_h", lambda h, i: F.struct(h.alias("h"), i.alias("p"))))
    out = out.withColumn("_s", F.when(F.size(F.array_distinct("_h")) < F.size("_h"), paired))

    def if_twice(x: Column, i: Column) -> Column:
        beside = (F.get("_s", i - 1)["h"] == x["h"], F.get("_s", i + 1)["h"] == x["h"])
        return F.when(F.coalesce(beside[0], F.lit(False)) | F.coalesce(beside[1], F.lit(False)), x["p"])

    out = out.withColumn("_p", F.sort_array(F.filter(F.transform("_s", if_twice), lambda p: p.isNotNull())))
    out = out.withColumn("n_repeat_words", F.coalesce(_size_of_union(F.col("_p"), window), F.lit(0)).cast("long"))
    per_word = F.greatest(F.col("n_words"), F.lit(1)).cast("double")
    return out.withColumns(
        {
            "mean_word_chars": F.col("word_chars") / per_word,
            "symbols_per_word": F.col("n_symbols") / per_word,
            "upper_share": F.col("n_upper") / F.greatest("word_chars", F.lit(1)),
            "stop_share": F.col("n_stop") / per_word,
            "dup_line_share": F.col("n_dup_lines") / F.greatest("n_lines", F.lit(1)),
            "repeat_share": F.col("n_repeat_words") / per_word,
        }
    ).drop("_w", "_l", "_h", "_s", "_p")


def verdict(rules: tuple[Rule, ...] = RULES) -> Column:
    """The table of thresholds as one boolean expression."""
    ok = F.lit(True)
    for r in rules:
        one = F.lit(True)
        if r.low is not None:
            one = one & (F.col(r.measure) >= r.low)
        if r.high is not None:
            one = one & (F.col(r.measure) <= r.high)
        ok = ok & ((F.col("n_words") < r.least_words) | one)
    return ok


MEASURES = ("n_words", "word_chars", "n_symbols", "n_upper", "n_stop", "n_lines", "n_dup_lines", "n_repeat_words", "mean_word_chars", "symbols_per_word", "upper_share", "stop_share", "dup_line_share", "repeat_share")


def apply_rules(docs: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """All columns of ``docs`` (those named like a result are replaced), the measures, ``base_failed``, ``kept``.

    Null or empty text has no words, fails the base rule and is not kept; it is never dropped. Repeated
    rows are judged alike. Narrow: no row leaves its partition.
    """
    out = measure(docs.drop(*MEASURES, "base_failed", "kept"))
    failed = (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))
    return out.withColumn("base_failed", failed).withColumn("kept", ~F.col("base_failed") & verdict(rules))


def digest(docs: DataFrame) -> DataFrame:
    """The contract's columns."""
    cols = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")
    return apply_rules(docs.select("doc_id", "text")).select("doc_id", *cols)


SQL = f"""
with d as (
  select doc_id, coalesce(text, '') as t,
         list_filter(regexp_split_to_array(coalesce(text, ''), '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') as w,
         list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')) as l
  from documents),
v as (select doc_id, p, array_to_string(list_slice(w, p + 1, p + 8), ' ') as win
      from (select doc_id, w, unnest(range(len(w) - 7)) as p from d where len(w) >= 8)),
m as (select doc_id, p from (select *, count(*) over (partition by doc_id, win) as n from v) where n >= 2),
r as (select doc_id, sum(n) as n_repeat_words from (
        select doc_id, least(8, coalesce(lead(p) over (partition by doc_id order by p) - p, 8)) as n from m) group by doc_id),
c as (
  select d.doc_id, len(w) as n_words, length(array_to_string(w, '')) as word_chars,
         length(regexp_replace(t, '[^{SYMBOLS}]', '', 'g')) as n_symbols,
         length(regexp_replace(t, '[^A-Z]', '', 'g')) as n_upper,
         len(list_filter(w, lambda x: list_contains([{", ".join(f"'{x}'" for x in sorted(set(STOP_WORDS)))}], lower(x)))) as n_stop,
         len(l) as n_lines, len(l) - len(list_distinct(l)) as n_dup_lines,
         cast(coalesce(n_repeat_words, 0) as bigint) as n_repeat_words
  from d left join r on d.doc_id = r.doc_id),
b as (select *, n_words < 20 or 100 * n_repeat_words > 30 * n_words as base_failed from c)
select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       not base_failed
       and word_chars / greatest(n_words, 1) between 2.0 and 25.0
       and n_symbols / greatest(n_words, 1) <= 0.30
       and n_upper / greatest(word_chars, 1) <= 0.50
       and (n_words < 80 or n_stop / greatest(n_words, 1) >= 0.01)
       and n_dup_lines / greatest(n_lines, 1) <= 0.50
       and n_repeat_words / greatest(n_words, 1) <= 0.30 as kept
from b
"""
