"""Normalizers, phonetic codes and similarities against hand-worked cases and their properties."""

import unicodedata

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from knotwork.functions import phonetic, similarity, tables
from knotwork.functions import text as X


def one(spark, make, *values):
    df = spark.createDataFrame([values], ", ".join(f"c{i} string" for i in range(len(values))))
    return df.select(make(*[F.col(f"c{i}") for i in range(len(values))]).alias("x")).first()["x"]


def many(spark, make, values):
    rows = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, c0 string")
    return [r["x"] for r in rows.select("i", make(F.col("c0")).alias("x")).orderBy("i").collect()]


NAMES = {
    "Zephyr Kiln Works Pvt. Ltd.": "zephyr kiln works",
    "M/S Ortega & Daughters": "ortega daughters",
    "Quill Holdings Holding Co": "quill",
    "Limited Edition Prints": "limited edition prints",
    "Naïve Œuf Straße SAS": "naive uf strae",
    "visit www.tern-harbour.net today": "visit tern harbour today",
    "गोवा लकड़ी": "govaa lakarii",
    "LLC": "",
}
ADDRESSES = [
    ("007 E Larch Blvd Apt 0012", "US", "7 east larch boulevard unit 12"),
    ("near near Mill Rd, New Jersey", "US", "near mill road nj"),
    ("New Jersey Virgin Islands Guam", "US", "nj vi gu"),
    ("New Jersey", "India", "new jersey"),
    ("Georgia", "US", "ga"),
    ("Georgia / Goa", "India", "georgia ga"),
    ("Goa", "", "ga"),
    ("Plot 04, ગુજરાત", "India", "gj plot 4 gujaraata"),
    ("12 R de la Paix, Grand Est", "France", "12 rue de la paix grand est"),
    ("west West West Virginia", "US", "west wv"),
    ("000 <NULL>", "US", "0"),
    ("n/a", "US", "north a"),
    ("", "US", ""),
]


def test_names(spark):
    assert many(spark, X.normalize_name, list(NAMES)) == list(NAMES.values())
    assert many(spark, X.normalize_name_tokens, list(NAMES)) == [" ".join(sorted(v.split())) for v in NAMES.values()]


@pytest.mark.parametrize("address, country, expected", ADDRESSES)
def test_addresses(spark, address, country, expected):
    assert one(spark, lambda c: X.normalize_address(c, F.lit(country)), address) == expected
    assert one(spark, lambda c: X.normalize_address_tokens(c, F.lit(country)), address) == " ".join(sorted(set(expected.split())))


def test_clean_text(spark):
    cases = {
        None: "", "": "", "  \t ": "", "Dóllar Œuvre ﬁne ½ ß": "dollar uvre fine 12", "## Acme >> <NULL> none": "acme",
        "https://www.acme.com/x?y": "acme x y", "Acme | www.acme-tools.co.in": "acme acme tools", "mail me@site.zz now": "mail now",
        "Foo d/b/a Bar aka Baz c/o Q": "foo bar baz q", "Denver, CO": "denver", "praaivet limited": "private limited",
    }
    assert many(spark, X.clean_text, list(cases)) == list(cases.values())


def test_indic(spark):
    cases = {"महाराष्ट्र": "mahaaraashtra", "ગુજરાત": "gujaraata", "हिन्दी": "hindii", "abc": "abc", "क़": "ka़", "ि": ""}
    assert many(spark, X.transliterate_indic, list(cases)) == list(cases.values())


def test_folding_is_compatibility_decomposition(spark):
    texts = ["".join(map(chr, range(k, k + 64))) for k in (*range(0x80, 0x3000, 64), *range(0xFB00, 0xFF00, 64), 0x1D400)]
    want = [unicodedata.normalize("NFKD", t).encode("ascii", "ignore").decode() for t in texts]
    assert many(spark, X.fold_accents, texts) == want


def test_names(spark):
    cases = {"Acme Co Ltd Pvt Ltd": "acme", "Zeta Private Limited": "zeta", "Ajax Limited": "ajax limited", "b a b Inc": "b a b"}
    assert many(spark, X.normalize_name, list(cases)) == list(cases.values())
    assert one(spark, X.normalize_name_tokens, "b a b") == "a b b"
    assert many(spark, X.extract_legal_suffix, ["Foo Pvt Ltd", "Foo Company", "Foo", "Foo Holdings", None]) == ["pvt_ltd", "co", "", "holdings", ""]


def test_addresses(spark):
    def at(country):
        return lambda c: X.normalize_address(c, F.lit(country))

    assert one(spark, at("US"), "0012 N Main St Apt 5, New York") == "12 north main street unit 5 ny"
    assert one(spark, at("us"), "FL 3 Court, Florida") == "floor 3 court fl"
    assert one(spark, at("India"), "Colorado Road, Tamil Nadu") == "colorado road tn"
    assert one(spark, at(""), "Nouvelle-Aquitaine Nouvelle-Aquitaine Texas Kerala") == "nouvelle aquitaine tx kl"
    assert one(spark, at("India"), "महाराष्ट्र Pune") == "mh mahaaraashtra pune"
    assert one(spark, at("US"), "New York New York unit unit 0") == "ny unit 0"
    assert one(spark, at("US"), None) == ""
    assert one(spark, lambda c: X.normalize_address_tokens(c, F.lit("US")), "b a b") == "a b"


def test_extractors(spark):
    assert one(spark, X.extract_numbers, "007 Main 12b, १२ and 000") == ["7", "12", "0"]
    assert many(spark, X.extract_unit, ["Suite 4-B", "floor 3", "x # 9", "apt12", None]) == ["4-b", "oor", "", "12", ""]
    assert one(spark, X.extract_street, "12b main street suite 4 north a 9 end") == "main street north"
    assert one(spark, X.state_token, "main de street ny") == "de"
    assert one(spark, lambda c: X.postal_token(X.extract_numbers(c)), "12, 00705, 27601") == "27601"
    assert one(spark, X.char_ngrams, "abcab") == ["abc", "bca", "cab"]
    assert many(spark, X.char_ngrams, ["ab", ""]) == [["ab"], []]


def test_soundex(spark):
    cases = {"ashcraft": "A226", "robert": "R163", "pfister": "P236", "tymczak": "T522", "a": "A000", "x1": "", "": ""}
    assert many(spark, X.soundex, list(cases)) == list(cases.values())


@pytest.mark.parametrize("word, codes", [("smith", ("SM0", "XMT")), ("schmidt", ("XMT", "SMT")), ("knight", ("NT", "")), ("thomas", ("TMS", "")), ("philip", ("FLP", "")), ("xavier", ("SF", "SFR")), ("", ("", "")), ("church", ("XRX", "XRK")), ("jose", ("HS", "")), ("wright", ("RT", ""))])
def test_double_metaphone(word, codes):
    assert phonetic.double_metaphone_codes(word) == codes


words = st.text(alphabet="abc ", max_size=12)


@given(words, words)
@settings(max_examples=200, deadline=None)
def test_similarities(a, b):
    for f in (similarity.jaro_winkler, similarity.ratio, similarity.token_sort_ratio, similarity.token_set_ratio):
        assert 0 <= f(a, b) <= 1 + 1e-9
    assert similarity.ratio(a, b) == pytest.approx(similarity.ratio(b, a))
    table = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i, x in enumerate(a):
        for j, y in enumerate(b):
            table[i + 1][j + 1] = table[i][j] + 1 if x == y else max(table[i][j + 1], table[i + 1][j])
    assert similarity.lcs(a, b) == table[-1][-1]


def test_jaro_winkler_as_published():
    assert similarity.jaro_winkler("martha", "marhta") == pytest.approx(0.961111, abs=1e-6)
    assert similarity.jaro_winkler("dixon", "dicksonx") == pytest.approx(0.813333, abs=1e-6)
    assert similarity.token_set_ratio("a b c", "c b a x") == 1.0 and similarity.token_set_ratio("", "a") == 0.0


def test_prepared_record(spark):
    df = spark.createDataFrame([("S1-1", "Blue Stone LLC", "12 Oak St Suite 4, Raleigh, NC 27601", "US"), ("S2-1", None, None, None)], "entity_id string, business_name string, business_address string, country string")
    r, empty = X.prepare_records(df).orderBy("entity_id").collect()
    assert (r["name_clean"], r["legal_suffix"], r["unit"], r["state"], r["postal"], r["street_name"]) == ("blue stone", "llc", "4", "nc", "27601", "oak street raleigh")
    assert r["nm_metaphone"]["primary"] == "PL" and r["full_text"] == "blue stone blue stone 12 oak street suite 4 raleigh nc 27601"
    assert empty["name_ngrams"] == [] and empty["state"] == "" and empty["numbers"] == []


def test_tables_are_whole():
    assert (len(tables.US_STATES), len(tables.INDIA_STATES), len(tables.LEGAL_TERMS), len(tables.BLOCKING_STOPWORDS)) == (54, 41, 43, 28)


def test_a_right_text_is_read_once_for_all_left_texts(monkeypatch):
    """It was read once for each."""
    import random

    S = similarity

    rnd = random.Random(5)
    word = lambda n, letters="abé ": "".join(rnd.choice(letters) for _ in range(n))

    def plain_lcs(a, b):
        row = [0] * (len(b) + 1)
        for x in a:
            last = 0
            for j, y in enumerate(b, 1):
                last, row[j] = row[j], last + 1 if x == y else max(row[j], row[j - 1])
        return row[-1]

    b = word(70)
    texts = ["", "b", b, b[3:40], *[word(rnd.randrange(1, 90)) for _ in range(40)], "\U0001f600\0" + b[:9]]
    assert S.lcs_many(texts, b) == [plain_lcs(a, b) for a in texts] == [S.lcs(a, b) for a in texts]
    assert S.lcs_many(["a\0b", ""], "\0b") == [2, 0]
    passes, many = [], S.lcs_many
    monkeypatch.setattr(S, "lcs_many", lambda some, right: passes.append(right) or many(some, right))
    assert S.ratios([(a, b) for a in texts]) == [2 * plain_lcs(a, b) / (len(a) + len(b)) for a in texts]
    assert passes == [b]


def test_measures_of_many_pairs_equal_those_of_one(monkeypatch):
    """Letters are numbered once a text and tokens split once a text, not for each pair; letters out of reach are taken one by one."""
    import random

    from knotwork.functions import similarity as S

    r = random.Random(5)
    texts = ["".join(r.choices(letters, [r.random() + 0.01 for _ in letters], k=r.randint(1, 90))) for letters in ("ab", "abcd ", "aé日𝒳 ") for _ in range(12)] + ["a" * 20 + "z", "z" + "a" * 20]
    pairs = [(a, b) for a in texts for b in texts]
    monkeypatch.setattr(S, "_LONG", 0)
    numbered, letters = [], S._Letters
    monkeypatch.setattr(S, "_Letters", lambda t, alphabet: numbered.append(t) or letters(t, alphabet))
    assert S.jaro_winklers(pairs) == [S.jaro_winkler(*p) for p in pairs]
    assert sorted(numbered) == sorted(set(texts))
    assert S.token_set_ratios(pairs) == [S.token_set_ratio(*p) for p in pairs]
    assert S.lcs("xaaay", "bababab") == S.lcs("bababab", "xaaay") == 3
