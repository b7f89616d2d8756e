import random

import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def odd_rows():
    """Nulls in every column, empty and very long texts, ties, repeated rows, near and exact copies."""
    rng = random.Random(3)
    vocabulary = ["".join(rng.choice("abcdefghij") for _ in range(rng.randint(1, 7))) for _ in range(400)]

    def prose(n):
        words = [rng.choice(vocabulary) for _ in range(n)]
        return "".join(w + (".\n" if rng.random() < 0.06 else " ") for w in words)

    base, shared = prose(400), prose(130)
    rows = [(i, prose(rng.randint(1, 300)), "en", f"s{i % 4}", 1) for i in range(60)]
    rows += [(100 + i, base, "en", "s0", 1) for i in range(12)]
    rows += [(130 + i, base.replace(vocabulary[i], "changed"), "de", "s1", 1) for i in range(12)]
    rows += [(160 + i, prose(60) + shared + prose(80), "fr", "s2", 1) for i in range(8)]
    rows += [(180, "", "en", "s0", 0), (181, None, None, None, None), (182, " \t\n\x0b\x0c\r ", "en", None, 1), (183, prose(30_000), "en", "s3", 1)]
    rows += [(184, "one", "en", "s0", 1), (185, "ÀÉ straße İ K \x1c x", "fr", "s1", 1), (186, "A" * 3_000 + " " + "b!" * 900, "en", "s2", 1)]
    rows += [(None, base, "en", "s0", 1), (100, base, "en", "s0", 1), (100, base, "en", "s0", 1)]
    return rows


@pytest.fixture(scope="session")
def odd(spark, odd_rows):
    """The rows with extra columns whose names clash with results and helpers."""
    from pyspark.sql import functions as F

    df = spark.createDataFrame(odd_rows, SCHEMA).repartition(3)
    extra = ["n_words", "size", "taken", "n_lines", "n_dropped", "kept", "score", "n_tokens", "block", "component_id", "fp", "h", "target"]
    return df.withColumns({c: F.lit("clash") for c in extra})


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)
