"""Text normalization as Column functions: built-in expressions only, so rows never leave the JVM.

Null and empty text are one thing, ``""``, everywhere.
"""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import tables as T

STRINGS = "array<string>"
_LEGAL = r"\b(?:" + "|".join(t.replace(" ", r"\s+") for t in T.LEGAL_TERMS) + r")\b"


def text_of(c: Column | str) -> Column:
    return F.coalesce(F.col(c) if isinstance(c, str) else c, F.lit("")).cast("string")


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of ``value``, which is evaluated once however often the body names it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def chain(c: Column, rules: tuple[tuple[str, str], ...]) -> Column:
    for pattern, put in rules:
        c = F.regexp_replace(c, pattern, put)
    return c


def _at(start: int, offsets) -> str:
    return "".join(chr(start + o) for o in offsets)


def transliterate_indic(c: Column) -> Column:
    """Latin letters for the nine Brahmic blocks; other characters pass.

    Per block: a consonant that no vowel sign or virama follows gets its inherent ``a``, a sign that no
    consonant precedes goes, a virama after a consonant goes. Then all blocks are one and each letter is
    replaced. Text without those scripts skips all of it.
    """
    s = c
    for start in T.BRAHMIC_STARTS:
        cons, signs, virama = _at(start, T.INDIC_CONSONANTS), _at(start, T.INDIC_MATRAS), chr(start + T.VIRAMA)
        s = F.regexp_replace(s, f"(?<![{cons}])[{signs}]", "")
        s = F.regexp_replace(s, f"([{cons}])(?![{signs}{virama}])", "$1a")
        s = F.regexp_replace(s, f"(?<=[{cons}]){virama}", "")
    letters = T.INDIC_VOWELS | T.INDIC_CONSONANTS | T.INDIC_MATRAS | dict.fromkeys(T.INDIC_NASALS, "n")
    first, rest = T.BRAHMIC_STARTS[0], T.BRAHMIC_STARTS[1:]
    s = F.translate(s, "".join(_at(b, sorted(letters)) for b in rest), _at(first, sorted(letters)) * len(rest))
    for offset, latin in sorted(letters.items()):
        s = F.replace(s, F.lit(chr(first + offset)), F.lit(latin))
    return F.when(c.rlike("[ऀ-ൿ]"), s).otherwise(c)


def fold_accents(c: Column) -> Column:
    """Compatibility decomposition with everything but ASCII left out."""
    many = _map(T.FOLD_MANY)
    one_byte = lambda x: F.octet_length(x) == 1
    wide = F.array_join(F.transform(F.split(c, ""), lambda x: F.when(one_byte(x), x).otherwise(F.coalesce(F.element_at(many, x), x))), "")
    # no letter from U+00C0 to U+00FF becomes several; only other characters are looked up one by one
    narrow = F.when(c.rlike("[^\\x00-\\x7F\\u00C0-\\u00FF]"), wide).otherwise(c)
    return F.regexp_replace(F.translate(narrow, "".join(T.FOLD_ONE), "".join(T.FOLD_ONE.values())), r"[^\x00-\x7F]+", "")


def clean_text(c: Column | str) -> Column:
    """The base cleaner: transliterate, fold, lower-case, repair, strip addresses of the web, noise and punctuation."""

    def to_ascii(t: Column) -> Column:
        return F.when(F.octet_length(t) == F.char_length(t), t).otherwise(let(transliterate_indic(t), fold_accents))

    return F.trim(chain(F.lower(let(text_of(c), to_ascii)), T.CLEANING))


def collapse(c: Column) -> Column:
    return F.trim(F.regexp_replace(c, " +", " "))


def normalize_name(c: Column | str) -> Column:
    """Cleaned name without legal terms; two passes catch what the first one brings together."""
    s = clean_text(c)
    for _ in range(2):
        s = collapse(F.regexp_replace(s, _LEGAL, " "))
    return s


def tokens(c: Column) -> Column:
    """Tokens of clean text; none for the empty string."""
    return F.filter(F.split(c, " "), lambda t: t != "")


def sort_tokens(c: Column) -> Column:
    """Tokens in order, repeats kept."""
    return F.array_join(F.array_sort(tokens(c)), " ")


def normalize_name_tokens(c: Column | str) -> Column:
    return sort_tokens(normalize_name(c))


def _map(d: dict[str, str]) -> Column:
    """A literal map; folded to a constant by the optimizer."""
    return F.from_json(F.lit(json.dumps(d)), "map<string,string>")


def look_up(d: dict[str, str], t: Column) -> Column:
    """``d[t]``, null if there is none. A literal map is searched entry by entry, so a hash set comes before it."""
    return F.when(t.isin(*d), F.element_at(_map(d), t))


def _two(d) -> dict[str, str]:
    """Two-word keys; a value of two words is held together by an underscore, which clean text never has."""
    return {k: (d[k] if isinstance(d, dict) else k).replace(" ", "_") for k in d if k.count(" ") == 1}


def normalize_address(address: Column | str, country: Column | str | None = None) -> Column:
    """Address with states as codes and abbreviations in full.

    Two-word names of states win over their words - no two of them overlap, so a token is part of one
    exactly if it or its neighbour starts one. Then zeros, abbreviations and one-word states token by
    token. Codes of states named in native script come first. Only neighbouring repeats collapse.
    """
    raw = text_of(address)
    land = F.upper(F.trim(text_of(F.lit("") if country is None else country)))
    in_us, in_india, in_france = (land.isin(x, "") for x in ("US", "INDIA", "FRANCE"))
    us, india, france = (_two(d) for d in (T.US_STATES, T.INDIA_STATES, T.FRANCE_REGIONS))
    us1, india1 = ({k: v for k, v in d.items() if " " not in k} for d in (T.US_STATES, T.INDIA_STATES))
    seconds = sorted({k.split(" ")[1] for d in (us, india, france) for k in d})

    def state(t: Column, of_us: dict, of_india: dict, of_france: dict | None = None) -> Column:
        found = [F.when(in_us, look_up(of_us, t)), F.when(in_india, look_up(of_india, t))]
        return F.coalesce(*found, *([] if of_france is None else [F.when(in_france, look_up(of_france, t))]))

    def one(t: Column) -> Column:
        plain = F.when(t.rlike("^[0-9]+$"), F.regexp_replace(t, "^0+(?=[0-9])", "")).otherwise(t)
        full = let(plain, lambda x: F.coalesce(look_up(T.ADDRESS_EXPANSIONS, x), x))
        return let(full, lambda x: F.coalesce(state(x, us1, india1), x))

    def of_pairs(ps: Column) -> Column:
        starts = F.concat(F.array(F.lit(False)), F.transform(ps, lambda p: p["two"].isNotNull()))
        out = F.zip_with(ps, F.slice(starts, 1, F.size(ps)), lambda p, after: F.when(p["two"].isNotNull(), p["two"]).when(~after, one(p["t"])))
        native = F.array(*[F.when(F.contains(raw, F.lit(k)), F.lit(v)) for k, v in T.INDIA_SCRIPTS.items()])
        joined = F.array_join(let(F.array_compact(F.concat(native, out)), dedup_neighbours), " ")
        return F.when(F.size(ps) == 0, "").otherwise(F.replace(joined, F.lit("_"), F.lit(" ")))

    def of_tokens(ts: Column) -> Column:
        following = F.slice(ts, 2, F.greatest(F.size(ts), F.lit(1)))
        two = lambda t, n: F.when(n.isin(*seconds), let(F.concat_ws(" ", t, n), lambda x: state(x, us, india, france)))
        return let(F.zip_with(ts, following, lambda t, n: F.struct(t.alias("t"), two(t, n).alias("two"))), of_pairs)

    return let(tokens(clean_text(raw)), of_tokens)


def dedup_neighbours(c: Column) -> Column:
    """An array without elements equal to the one before."""
    behind = F.concat(F.array(F.lit(None).cast("string")), c)
    same = F.zip_with(c, F.slice(behind, 1, F.greatest(F.size(c), F.lit(1))), lambda t, p: F.when(p.isNull() | (t != p), t))
    return F.filter(same, lambda t: t.isNotNull())


def distinct_sorted_tokens(c: Column) -> Column:
    return F.array_join(F.array_sort(F.array_distinct(tokens(c))), " ")


def normalize_address_tokens(address: Column | str, country: Column | str | None = None) -> Column:
    return distinct_sorted_tokens(normalize_address(address, country))


_ZEROS = "".join(chr(z) for z in range(0x110000) if not 0xD800 <= z <= 0xDFFF and chr(z).isdecimal() and int(chr(z)) == 0)


def extract_numbers(c: Column | str) -> Column:
    """Whole numbers in raw text, in any script's digits, as ASCII digits without leading zeros."""
    digits = "".join(chr(ord(z) + k) for z in _ZEROS for k in range(10) if ord(z) > 0x7F)
    ascii_digits = "0123456789" * (len(digits) // 10)
    found = F.regexp_extract_all(text_of(c), F.lit(r"(?U)\b\d+\b"), F.lit(0))

    def plain(x: Column) -> Column:
        x = F.when(x.rlike("^[0-9]+$"), x).otherwise(F.translate(x, digits, ascii_digits))
        return F.regexp_replace(x, "^0+(?=[0-9])", "")

    return F.transform(found, plain)


def extract_legal_suffix(c: Column | str) -> Column:
    """Last legal term of the cleaned name, canonical if it has a canonical form."""
    found = F.regexp_extract_all(clean_text(c), F.lit("(" + _LEGAL + ")"), F.lit(1))
    return let(F.try_element_at(found, F.lit(-1)), lambda last: F.coalesce(F.element_at(_map(T.LEGAL_CANONICAL), last), last, F.lit("")))


def extract_unit(c: Column | str) -> Column:
    return F.regexp_extract(F.lower(text_of(c)), T.UNIT_PATTERN, 1)


def extract_street(clean_address: Column) -> Column:
    """First three words of a clean address that are neither its number, a unit, a digit nor one letter."""
    s = F.regexp_replace(clean_address, T.LEADING_NUMBER_PATTERN, "")
    s = F.regexp_replace(s, T.UNIT_PHRASE_PATTERN, "")
    words = F.filter(F.split(s, " "), lambda w: (F.length(w) > 1) & ~w.rlike("^[0-9]+$"))
    return F.array_join(F.slice(words, 1, 3), " ")


def soundex(word: Column) -> Column:
    """Letter and three digits; unlike the usual code, a vowel, h, w or y parts two equal digits. "" if not all letters."""
    w = F.upper(word)
    letters, codes = "", ""
    for group, digit in T.SOUNDEX_GROUPS.items():
        letters, codes = letters + group, codes + digit * len(group)
    coded = F.translate(F.regexp_replace(w, "[AEIOUHWY]", "0"), letters, codes)
    coded = F.regexp_replace(F.regexp_replace(coded, "([0-9])\\1+", "$1"), "^.", "")
    coded = F.replace(coded, F.lit("0"), F.lit(""))
    return F.when(word.rlike("^[A-Za-z]+$"), F.rpad(F.concat(F.substring(w, 1, 1), coded), 4, "0")).otherwise("")


def first_word(c: Column) -> Column:
    return F.coalesce(F.try_element_at(tokens(c), F.lit(1)), F.lit(""))


def state_token(clean_address: Column) -> Column:
    two = F.filter(tokens(clean_address), lambda t: t.rlike("^[a-z]{2}$"))
    return F.coalesce(F.try_element_at(two, F.lit(1)), F.lit(""))


def postal_token(numbers: Column) -> Column:
    return F.coalesce(F.try_element_at(F.filter(numbers, lambda n: F.length(n).isin(5, 6)), F.lit(1)), F.lit(""))


def char_ngrams(c: Column, n: int = 3) -> Column:
    """Set of character n-grams; a shorter text is its own, the empty one has none.

    A look-ahead at each place takes one pass; a substring by position would count from the start each time.
    """
    grams = F.array_distinct(F.regexp_extract_all(c, F.lit(f"(?s)(?=(.{{{n}}}))"), F.lit(1)))
    return F.when(c == "", F.array().cast(STRINGS)).when(F.length(c) < n, F.array(c)).otherwise(grams)


def jaccard(a: Column, b: Column) -> Column:
    share = let(F.size(F.array_intersect(a, b)), lambda both: both / (F.size(a) + F.size(b) - both))
    return F.when((F.size(a) > 0) & (F.size(b) > 0), share).otherwise(0.0)


def gram_cosine(a: Column, b: Column) -> Column:
    """Cosine of two n-gram sets."""
    return F.when((F.size(a) > 0) & (F.size(b) > 0), F.size(F.array_intersect(a, b)) / F.sqrt(F.size(a).cast("double") * F.size(b))).otherwise(0.0)


def text_cosine(a: Column, b: Column) -> Column:
    """``gram_cosine`` of two texts, whose n-grams are made once."""
    return let(F.struct(char_ngrams(a).alias("a"), char_ngrams(b).alias("b")), lambda s: gram_cosine(s["a"], s["b"]))


def normalize_records(df: DataFrame) -> DataFrame:
    """Entity records (entity_id, business_name, business_address, country) with nine normalized fields. Narrow."""
    out = df.select(
        F.trim(text_of("entity_id")).alias("entity_id"), F.trim(text_of("country")).alias("country"),
        text_of("business_name").alias("raw_name"), text_of("business_address").alias("raw_address"),
        normalize_name("business_name").alias("name"),
        normalize_address("business_address", "country").alias("address"),
        extract_numbers("business_address").alias("address_numbers"),
    )
    out = out.withColumns({"name_sorted": sort_tokens(F.col("name")), "address_sorted": distinct_sorted_tokens(F.col("address"))})
    return out.select("entity_id", "country", "raw_name", "raw_address", "name", "name_sorted", "address", "address_sorted", "address_numbers")


def prepare_records(df: DataFrame) -> DataFrame:
    """The record every later stage works on: normalized fields, keys' ingredients and n-gram sets. Narrow."""
    from .phonetic import double_metaphone

    out = df.select(
        F.col("entity_id"), text_of("country").alias("country"), text_of("business_name").alias("raw_name"), text_of("business_address").alias("raw_address"),
        normalize_name("business_name").alias("name_clean"), normalize_address("business_address", "country").alias("addr_clean"),
        extract_numbers("business_address").alias("numbers"), extract_legal_suffix("business_name").alias("legal_suffix"), extract_unit("business_address").alias("unit"),
    )
    out = out.withColumns(
        {
            "name_sorted": sort_tokens(F.col("name_clean")),
            "addr_sorted": distinct_sorted_tokens(F.col("addr_clean")),
            "name_ngrams": char_ngrams(F.col("name_clean")),
            "addr_ngrams": char_ngrams(F.col("addr_clean")),
            "first_word": first_word(F.col("name_clean")),
            "street_name": extract_street(F.col("addr_clean")),
            "state": state_token(F.col("addr_clean")),
            "postal": postal_token(F.col("numbers")),
        }
    )
    first_street = first_word(F.col("street_name"))
    return out.withColumns(
        {
            "nm_soundex": soundex(F.col("first_word")),
            "street_soundex": soundex(first_street),
            "nm_metaphone": double_metaphone(F.col("first_word")),
            "street_metaphone": double_metaphone(first_street),
            "full_text": full_text(),
        }
    )


def full_text() -> Column:
    """All clean text of a record."""
    return F.concat_ws(" ", "name_clean", "name_sorted", "addr_clean")
