"""Registered queries of the linkage operators, over whole tables, and the SQL that states the same."""

from __future__ import annotations

import dataclasses
import functools
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import similarity as S
from ..functions import tables as T
from ..functions import text as X
from ..functions.phonetic import double_metaphone
from ..operators import blocking, decision, features, metrics, model, sampling, tfidf, validate
from ..sources import io
from . import sql as Q

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE_SQL: dict[str, str] = {}


def query(sql: str | None = None) -> Callable[[Query], Query]:
    def add(f: Query) -> Query:
        QUERIES[f.__name__] = f
        if sql is not None:
            ORACLE_SQL[f.__name__] = sql
        return f

    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def entities(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as entity records: the first line is the name, all others are the address; a third each is source 1, 2, 3."""
    d = table(spark, sf_dir, "documents")
    country = F.when(F.col("lang") == "en", "US").when(F.col("lang") == "fr", "France").otherwise("")
    rest = F.when(F.contains("text", F.lit("\n")), F.substr("text", F.instr("text", "\n") + 1)).otherwise("")
    source = F.concat(F.lit("S"), (1 + F.col("doc_id") % 3).cast("string"), F.lit("-"), F.col("doc_id").cast("string"))
    return d.select(source.alias("entity_id"), F.substring_index("text", "\n", 1).alias("business_name"), rest.alias("business_address"), country.alias("country"))


def sources(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    e = entities(spark, sf_dir)
    return tuple(e.where(F.col("entity_id").startswith(f"S{k}-")) for k in (1, 2, 3))


# --- text ----------------------------------------------------------------------------------------

_CLEAN = f"c as (select doc_id, {Q.clean('text')} as c from documents)"
_LAND = "case lang when 'en' then 'US' when 'fr' then 'France' else '' end"


@query(f"with {_CLEAN} select doc_id, c as clean from c")
def norm_base_text(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", X.clean_text("text").alias("clean"))


@query(f"with {_CLEAN}, n as (select doc_id, {Q.name_of_clean('c')} as name from c) select doc_id, name, {Q.sort_tokens('name')} as name_sorted from n")
def norm_name_tokens(spark, sf_dir):
    d = table(spark, sf_dir, "documents").select("doc_id", X.normalize_name("text").alias("name"))
    return d.withColumn("name_sorted", X.sort_tokens(F.col("name")))


@query(f"""with src as (select doc_id as id, {Q.clean('text')} as c, {_LAND} as land from documents), {Q.address_ctes('src')}
select id as doc_id, address, array_to_string(list_sort(list_distinct({Q.tokens('address')})), ' ') as address_sorted from adr""")
def norm_address_tokens(spark, sf_dir):
    land = F.when(F.col("lang") == "en", "US").when(F.col("lang") == "fr", "France").otherwise("")
    d = table(spark, sf_dir, "documents").select("doc_id", X.normalize_address("text", land).alias("address"))
    return d.withColumn("address_sorted", X.distinct_sorted_tokens(F.col("address")))


@query(f"select page_id, array_to_string({Q.numbers('html')}, ',') as numbers from pages")
def extract_numbers(spark, sf_dir):
    return table(spark, sf_dir, "pages").select("page_id", F.array_join(X.extract_numbers("html"), ",").alias("numbers"))


# name of a state in its script, its code, and its letters in Latin, worked out by hand
_SCRIPTS = [
    ("महाराष्ट्र", "mh", "mahaaraashtra"), ("ગુજરાત", "gj", "gujaraata"), ("दिल्ली", "dl", "dillii"), ("ಕರ್ನಾಟಕ", "ka", "karnaataka"), ("தமிழ்நாடு", "tn", "tamilnaatu"),
    ("पश्चिम बंगाल", "wb", "pashchima bangaala"), ("उत्तर प्रदेश", "up", "uttara pradesha"), ("राजस्थान", "rj", "raajasthaana"), ("पंजाब", "pb", "panjaaba"),
]


@query(f"""with s(k, code, latin) as (values {", ".join(f"({i}, '{c}', '{x}')" for i, (_, c, x) in enumerate(_SCRIPTS))})
select n_nationkey, latin || ' ' || trim(regexp_replace(lower(n_name), '[^a-z0-9]+', ' ', 'g')) as name,
       code || ' ' || trim(regexp_replace(lower(n_name), '[^a-z0-9]+', ' ', 'g')) || ' ' || latin as address
from nation join s on k = n_nationkey % {len(_SCRIPTS)}""")
def native_scripts(spark, sf_dir):
    script = F.element_at(F.array(*[F.lit(s) for s, _, _ in _SCRIPTS]), (F.col("n_nationkey") % len(_SCRIPTS) + 1).cast("int"))
    n = table(spark, sf_dir, "nation").select("n_nationkey", F.concat_ws(" ", script, "n_name").alias("name"), F.concat_ws(", ", "n_name", script).alias("address"))
    return n.select("n_nationkey", X.normalize_name("name").alias("name"), X.normalize_address("address", F.lit("India")).alias("address"))


# RE2 knows no boundary beside letters other than ASCII
_UNIT = T.UNIT_PATTERN.replace(r"\b(?:", r"(?:(?:^|[^\p{L}\p{N}_])(?:").replace("|#)", r")|[\p{L}\p{N}_]#)")


@query(f"select doc_id, regexp_extract(lower(text), {Q._q(_UNIT)}, 1) as unit from documents")
def extract_unit(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", X.extract_unit("text").alias("unit"))


@query(f"""with {_CLEAN},
s as (select doc_id, regexp_replace(regexp_replace(c, {Q._q(T.LEADING_NUMBER_PATTERN)}, ''), {Q._q(T.UNIT_PHRASE_PATTERN)}, '', 'g') as s from c)
select doc_id, array_to_string(list_filter(string_split(s, ' '), lambda w: len(w) > 1 and not regexp_matches(w, '^[0-9]+$'))[1:3], ' ') as street from s""")
def street_name(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", X.extract_street(X.clean_text("text")).alias("street"))


@query(f"""with {_CLEAN}, m as (select doc_id, regexp_extract_all(c, {Q._q(Q.LEGAL)})[-1] as m from c)
select doc_id, coalesce({Q._map(T.LEGAL_CANONICAL)}[m], m, '') as suffix from m""")
def legal_suffix(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", X.extract_legal_suffix("text").alias("suffix"))


@query(f"select page_id, {Q.clean('url')} as root from pages")
def url_domain_root(spark, sf_dir):
    return table(spark, sf_dir, "pages").select("page_id", X.clean_text("url").alias("root"))


@query(f"with {_CLEAN}, w as (select distinct unnest({Q.tokens('c')}) as word from c) select word, {Q.soundex('word')} as code from w")
def soundex_codes(spark, sf_dir):
    words = table(spark, sf_dir, "documents").select(F.explode(X.tokens(X.clean_text("text"))).alias("word")).distinct()
    return words.select("word", X.soundex(F.col("word")).alias("code"))


@query(f"with {Q.prepared()} select entity_id, state, postal from rec")
def state_and_postal(spark, sf_dir):
    e = entities(spark, sf_dir)
    return e.select("entity_id", X.state_token(X.normalize_address("business_address", "country")).alias("state"), X.postal_token(X.extract_numbers("business_address")).alias("postal"))


@query(f"""with {Q.prepared()} select entity_id, country, name, {Q.sort_tokens('name')} as name_sorted, address,
array_to_string(list_sort(list_distinct({Q.tokens('address')})), ' ') as address_sorted, array_to_string(numbers, ' ') as numbers from rec""")
def normalize_records(spark, sf_dir):
    n = X.normalize_records(entities(spark, sf_dir))
    return n.select("entity_id", "country", "name", "name_sorted", "address", "address_sorted", F.array_join("address_numbers", " ").alias("numbers"))


@query()
def metaphone_codes(spark, sf_dir):
    words = table(spark, sf_dir, "documents").select(F.explode(X.tokens(X.clean_text("text"))).alias("word")).distinct()
    return words.select("word", double_metaphone(F.col("word")).alias("m")).select("word", "m.primary", "m.secondary")


# codes of the tables' English words, worked out by hand from the published algorithm
_SOUNDS = """africa AFRK, america AMRK, anvil ANFL, asia AS AX, automobile ATMPL, blue PL, bolt PLT, building PLTNK, click KLK, cold KLT, east AST, economy AKNM, error ARR,
europe ARP, furniture FRNTR, gear JR KR, gizmo JSM KSM, high H, hot HT, household HSHLT, large LRJ LRK, low L LF, machinery MXNR MKNR, medium MTM, middle MTL, new N NF, not NT,
old ALT, plate PLT, promo PRM, purchase PRXS PRKS, red RT, ring RNK, rod RT, signup SNP SKNP, small SML XML, specified SPSFT, standard STNTRT, urgent ARJNT ARKNT, view F FF, widget AJT FJT"""
_SOUND_ROWS = ", ".join(f"('{w}', '{codes[0]}', '{codes[1] if codes[1:] else ''}')" for w, *codes in (x.split() for x in _SOUNDS.split(",")))
_PHRASES = {"part": ("p_name", "p_type"), "region": ("r_name",), "customer": ("c_mktsegment",), "orders": ("o_orderpriority",), "events": ("event_type",)}


@query(f"""with t as ({" union ".join(f"select lower({c}) as x from {t}" for t, cs in _PHRASES.items() for c in cs)}),
w as (select distinct unnest(regexp_extract_all(x, '[a-z]+')) as word from t), k(word, p, s) as (values {_SOUND_ROWS})
select w.word, p as primary, s as secondary from w left join k using (word)""".replace(" as primary", ' as "primary"'))
def metaphone_words(spark, sf_dir):
    texts = [table(spark, sf_dir, t).select(F.lower(c).alias("x")).distinct() for t, cs in _PHRASES.items() for c in cs]
    words = functools.reduce(DataFrame.unionByName, texts).select(F.explode(F.regexp_extract_all("x", F.lit("[a-z]+"), F.lit(0))).alias("word")).distinct()
    return words.select("word", double_metaphone(F.col("word")).alias("m")).select("word", "m.primary", "m.secondary")


# --- pair measures -------------------------------------------------------------------------------

_PARTS = """p as (select p_partkey, p_brand, p_size, p_name || ' ' || p_type as t from part),
pp as (select a.p_partkey as a_key, b.p_partkey as b_key, a.t as a, b.t as b from p a join p b on a.p_brand = b.p_brand and a.p_size = b.p_size and a.p_partkey < b.p_partkey)"""


#: Pairs that a task makes; a key with more goes to several tasks.
PAIRS_A_TASK = 4_000_000

#: Pairs of texts whose measures are sent to all executors: some 10 MB for each measure.
TEXT_PAIRS_HELD = 1_000_000


def dealt_join(left: DataFrame, right: DataFrame, on: list[str], sizes: DataFrame, spread: str) -> DataFrame:
    """Inner join on ``on``, in tasks of about ``PAIRS_A_TASK`` pairs however common a key is.

    ``sizes`` (``on``, pairs) says how many pairs a key makes. The left rows of a key with more are dealt out over
    parts by a hash of column ``spread``; its right rows go to each part.
    """
    tasks = max(1, -(-(sizes.agg(F.sum("pairs")).first()[0] or 0) // PAIRS_A_TASK))
    parts = sizes.where(F.col("pairs") > PAIRS_A_TASK).select(*on, F.ceil(F.col("pairs") / PAIRS_A_TASK).alias("_parts"))
    n, key = F.coalesce("_parts", F.lit(1).cast("long")), [*on, "_part"]
    left = left.join(parts, on, "left").withColumn("_part", F.pmod(F.xxhash64(spread), n)).drop("_parts")
    right = right.join(parts, on, "left").withColumn("_part", F.explode(F.sequence(F.lit(0).cast("long"), n - 1))).drop("_parts")
    return left.repartition(tasks, *key).join(right.repartition(tasks, *key), key).drop("_part")


def part_pairs(spark: SparkSession, sf_dir: str, **measures: Column) -> DataFrame:
    """All pairs of parts of one brand and size, with ``measures`` of their texts ``a`` and ``b``.

    Measures are taken once for two texts: if few texts are found again and again, of all pairs of them, which then are looked
    up for each pair of parts; or else of the different texts of a brand and size.
    """
    p = table(spark, sf_dir, "part").select("p_brand", "p_size", "p_partkey", F.concat_ws(" ", "p_name", "p_type").alias("t"))
    group = ["p_brand", "p_size"]
    counts = p.groupBy(*group, "t").agg(F.count("*").alias("n"))
    texts, cores = counts.select(*group, "t"), spark.sparkContext.defaultParallelism
    known = counts.groupBy("t").agg(F.count("*").alias("groups"))
    a = p.select(*group, F.col("p_partkey").alias("a_key"), F.col("t").alias("a"))
    b = p.select(*group, F.col("p_partkey").alias("b_key"), F.col("t").alias("b"))
    n = known.count()
    if n * n <= TEXT_PAIRS_HELD and n * n <= (texts.groupBy(group).count().agg(F.sum(F.col("count") * F.col("count"))).first()[0] or 0):
        # n is small, so that they may be counted in one task
        ids = known.select("t", F.row_number().over(Window.orderBy("t")).alias("k"))
        both = ids.select(F.col("t").alias("a"), F.col("k").alias("a_id")).repartition(cores, "a_id").crossJoin(F.broadcast(ids.select(F.col("t").alias("b"), F.col("k").alias("b_id"))))
        measured = both.select("a_id", "b_id", *[m.alias(name) for name, m in measures.items()])
        lists = measured.groupBy("a_id").agg(F.array_sort(F.collect_list(F.struct("b_id", *measures))).alias("_of"))
        lists = lists.select("a_id", *[F.col("_of")[name].alias(name) for name in measures])
        a, b = (x.join(F.broadcast(ids.select(F.col("t").alias(side), F.col("k").alias(f"{side}_id"))), side).drop(side) for x, side in ((a, "a"), (b, "b")))
        sizes = p.groupBy(*group).agg((F.count("*") * F.count("*")).alias("pairs"))
        pairs = dealt_join(a, b, group, sizes, "a_key").where("a_key < b_key").join(F.broadcast(lists), "a_id")
        return pairs.select("a_key", "b_key", *[F.element_at(name, F.col("b_id")).alias(name) for name in measures])
    # spread, as a few rows of text can make many pairs
    both = texts.withColumnRenamed("t", "a").join(texts.withColumnRenamed("t", "b"), group).repartition(cores)
    measured = both.select(*group, "a", "b", *[m.alias(name) for name, m in measures.items()])
    a = a.join(measured, [*group, "a"]).drop("a")
    sizes = counts.join(counts.groupBy(group).agg(F.sum("n").alias("all")), group).select(*group, F.col("t").alias("b"), (F.col("n") * F.col("all")).alias("pairs"))
    return dealt_join(a, b, [*group, "b"], sizes, "a_key").where("a_key < b_key").select("a_key", "b_key", *measures)


_A, _B = Q.ngrams("a"), Q.ngrams("b")
_BOTH = f"len(list_intersect({_A}, {_B}))"


@query(f"""with {_PARTS} select a_key, b_key, round({_BOTH} / (len({_A}) + len({_B}) - {_BOTH}), 6) as jaccard,
round({_BOTH} / sqrt(cast(len({_A}) as double) * len({_B})), 6) as cosine from pp""")
def char_ngram_similarity(spark, sf_dir):
    a, b = X.char_ngrams(F.col("a")), X.char_ngrams(F.col("b"))
    return part_pairs(spark, sf_dir, jaccard=F.round(X.jaccard(a, b), 6), cosine=F.round(X.gram_cosine(a, b), 6))


@query(f"with {_PARTS} select a_key, b_key, round(jaro_winkler_similarity(a, b), 6) as similarity from pp")
def jaro_winkler_pairs(spark, sf_dir):
    return part_pairs(spark, sf_dir, similarity=F.round(S.jaro_winkler_similarity(F.col("a"), F.col("b")), 6))


_WORDS = "list_filter(string_split({}, ' '), lambda w: w <> '')"
_ROW = "list_concat([0], list_transform(range(1, len(t) + 1), lambda j: greatest(row[j + 1], case when substr(s, i, 1) = substr(t, j, 1) then row[j] + 1 else 0 end)))"


@query(f"""with recursive {_PARTS},
k as (select *, list_sort(list_distinct({_WORDS.format('a')})) as x, list_sort(list_distinct({_WORDS.format('b')})) as y from pp),
e as (select *, array_to_string(list_filter(x, lambda w: list_contains(y, w)), ' ') as c, array_to_string(list_filter(x, lambda w: not list_contains(y, w)), ' ') as ox,
      array_to_string(list_filter(y, lambda w: not list_contains(x, w)), ' ') as oy from k),
f as (select a_key, b_key, a, b, array_to_string(list_sort({_WORDS.format('a')}), ' ') as sa, array_to_string(list_sort({_WORDS.format('b')}), ' ') as sb, c, ox, oy, trim(c || ' ' || ox) as one, trim(c || ' ' || oy) as two from e),
jobs as (select a as s, b as t from f union select sa, sb from f union select one, two from f),
dp(s, t, i, row) as (select s, t, 1, list_transform(range(len(t) + 1), lambda j: 0) from jobs
  union all select s, t, i + 1, list_transform(range(1, len(t) + 2), lambda j: list_max(cand[1:j])) from (select s, t, i, {_ROW} as cand from dp where i <= len(s))),
r as (select s, t, 2.0::double * list_max(row) / (len(s) + len(t)) as r from dp where i = len(s) + 1)
select a_key, b_key, round(p.r, 6) as ratio, round(q.r, 6) as sort_ratio,
       round(case when c <> '' and (ox = '' or oy = '') then 1.0 else greatest(u.r, case when c <> '' then 2.0::double * len(c) / (len(c) + least(len(one), len(two))) else 0 end) end, 6) as set_ratio
from f join r p on p.s = a and p.t = b join r q on q.s = sa and q.t = sb join r u on u.s = one and u.t = two""")
def token_ratios(spark, sf_dir):
    a, b = F.col("a"), F.col("b")
    ratios = {"ratio": S.indel_ratio(a, b), "sort_ratio": S.token_sort_similarity(a, b), "set_ratio": S.token_set_similarity(a, b)}
    return part_pairs(spark, sf_dir, **{n: F.round(c, 6) for n, c in ratios.items()})


@query("""select s_suppkey, c_custkey, case when a = '' or b = '' then -1.0 when a = b then 1.0 else 0.0 end as match from (
select s_suppkey, c_custkey, case when s_acctbal < 0 then '' else right(s_name, 1) end as a, case when c_acctbal < 0 then '' else right(c_name, 1) end as b
from supplier join customer on s_nationkey = c_nationkey)""")
def tri_state_match(spark, sf_dir):
    end = lambda x: F.when(F.col(f"{x}_acctbal") < 0, "").otherwise(F.right(F.col(f"{x}_name"), F.lit(1)))
    s = table(spark, sf_dir, "supplier").select(F.col("s_nationkey").alias("nation"), "s_suppkey", end("s").alias("a"))
    c = table(spark, sf_dir, "customer").select(F.col("c_nationkey").alias("nation"), "c_custkey", end("c").alias("b"))
    sizes = s.groupBy("nation").agg(F.count("*").alias("n")).join(c.groupBy("nation").agg(F.count("*").alias("m")), "nation").select("nation", (F.col("n") * F.col("m")).alias("pairs"))
    # customers are the many
    pairs = dealt_join(c, s, ["nation"], sizes, "c_custkey")
    return pairs.select("s_suppkey", "c_custkey", features.tri_state(F.col("a"), F.col("b")).alias("match"))


# --- blocking ------------------------------------------------------------------------------------

STOP, CAP = 40, 50
_CONFIG = blocking.BlockerConfig(max_key_targets=STOP, max_candidates=CAP, use_tfidf=False)
# the SQL of the candidate queries has STOP; queries without SQL have the operator's own limit
_PAIRS = blocking.BlockerConfig(max_candidates=CAP, use_tfidf=False, with_key=True)


@query(f"with {Q.keys()} select entity_id, key_order, key from key_rows")
def block_keys(spark, sf_dir):
    return blocking.record_keys(entities(spark, sf_dir))


def _index(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, s2, s3 = sources(spark, sf_dir)
    return blocking.record_keys(s2.unionByName(s3)).select("key", F.col("entity_id").alias("target_id"))


@query(f"with {Q.capped(STOP, CAP)} select key, target_id from idx join ok using (key)")
def block_stopkeys(spark, sf_dir):
    return blocking.prune_stop_keys(_index(spark, sf_dir), STOP)


@query(f"with {Q.capped(STOP, CAP)} select s1_id, candidate_id from pairs")
def block_pairs_capped(spark, sf_dir):
    s1, s2, s3 = sources(spark, sf_dir)
    return blocking.rule_candidates(s1, s2.unionByName(s3), _CONFIG)


@query(f"""with {Q.capped(STOP, CAP)} select e.entity_id as s1_id, coalesce(string_agg(candidate_id, ',' order by candidate_id), '') as candidate_entity_ids
from ent e left join pairs p on p.s1_id = e.entity_id where e.entity_id like 'S1-%' group by 1""")
def candidate_export(spark, sf_dir):
    s1, s2, s3 = sources(spark, sf_dir)
    pairs = blocking.generate_candidates(s1, s2, s3, _CONFIG)
    return io.id_list(pairs, s1.select(F.col("entity_id").alias("s1_id")), "s1_id", "candidate_id", "candidate_entity_ids")


def same_name(spark: SparkSession, sf_dir: str) -> DataFrame:
    """True pairs: records of source 1 and another source with the same first line, which is their key."""
    s1, s2, s3 = sources(spark, sf_dir)
    t = s2.unionByName(s3).select(F.col("entity_id").alias("candidate_id"), "business_name")
    return s1.select(F.col("entity_id").alias("s1_id"), "business_name").join(t, "business_name").select("s1_id", "candidate_id", F.sha2("business_name", 256).alias("key"))


_TRUTH = """truth as (select a.entity_id as s1_id, b.entity_id as candidate_id from ent a join ent b on a.business_name = b.business_name
where a.entity_id like 'S1-%' and b.entity_id not like 'S1-%')"""


@query(f"""with {Q.capped(STOP, CAP)}, {_TRUTH},
h as (select count(*) as true_pairs, count(p.s1_id) as captured from truth t left join pairs p on p.s1_id = t.s1_id and p.candidate_id = t.candidate_id),
n as (select e.entity_id, count(p.s1_id) as n from ent e left join pairs p on p.s1_id = e.entity_id where e.entity_id like 'S1-%' group by 1),
s as (select sum(n)::bigint as candidates, avg(n) as avg_candidates, median(n) as median_candidates, min(n) as min_candidates, max(n) as max_candidates from n),
k as (select count(*) filter (where entity_id like 'S1-%') * count(*) filter (where entity_id not like 'S1-%') as cells from ent)
select true_pairs, captured, round(case when true_pairs = 0 then 1.0 else captured / true_pairs end, 6) as recall, candidates, round(avg_candidates, 6) as avg_candidates,
median_candidates, min_candidates, max_candidates, round(1 - candidates / cells, 6) as reduction from h, s, k""")
def block_recall(spark, sf_dir):
    s1, s2, s3 = sources(spark, sf_dir)
    targets = s2.unionByName(s3)
    pairs = blocking.rule_candidates(s1, targets, _CONFIG)
    out = blocking.blocking_recall(pairs, same_name(spark, sf_dir), s1.select(F.col("entity_id").alias("s1_id")), s1.count() * targets.count())
    return out.withColumns({c: F.round(c, 6) for c in ("recall", "avg_candidates", "reduction")})


def _grams_sql(text: str) -> str:
    word = "' ' || w || ' '"
    grams = ", ".join(f"case when len({word}) >= {n} then list_transform(range(1, len({word}) - {n - 2}), lambda i: substr({word}, i, {n})) else {f'[{word}]' if n == 3 else '[]'} end" for n in (3, 4))
    return f"flatten(list_transform(list_filter(regexp_split_to_array({text}, '\\s+'), lambda w: w <> ''), lambda w: list_concat({grams})))"


def _weights_sql(docs: str) -> str:
    """CTEs up to ``w`` (id, part, gram, w) of CTE ``docs`` (id, part, text)."""
    return f"""tc as (select id, part, gram, count(*) as tf from (select id, part, unnest({_grams_sql('text')}) as gram from {docs}) group by all),
nd as (select part, count(*) as n from {docs} where text <> '' group by part),
idf as (select part, gram, ln((1.0 + any_value(n)) / (1.0 + count(*))) + 1.0 as idf from tc join nd using (part) group by part, gram),
xx as (select id, part, gram, (1.0 + ln(tf)) * idf as x from tc join idf using (part, gram)),
w as (select id, part, gram, x / sqrt(sum(x * x) over (partition by id)) as w from xx)"""


@query(f"with d as (select p_partkey as id, p_brand as part, p_name || ' ' || p_type as text from part), {_weights_sql('d')} select id as entity_id, part, gram, round(w, 6) as w from w")
def tfidf_weights(spark, sf_dir):
    d = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("entity_id"), F.col("p_brand").alias("part"), F.concat_ws(" ", "p_name", "p_type").alias("text"))
    return tfidf.fit_weights(d).withColumn("w", F.round("w", 6))


@query(f"""with d as (select 's' || s_suppkey as id, s_nationkey as part, s_name as text from supplier union all select 'c' || c_custkey, c_nationkey, c_name from customer),
{_weights_sql('d')},
sims as (select a.id as s1_id, b.id as candidate_id, round(sum(a.w * b.w), 6) as similarity from w a join w b on a.part = b.part and a.gram = b.gram
         where a.id like 's%' and b.id like 'c%' group by 1, 2 having round(sum(a.w * b.w), 6) >= 0.12)
select s1_id, candidate_id, similarity from sims qualify row_number() over (partition by s1_id order by similarity desc, candidate_id) <= 30""")
def tfidf_knn(spark, sf_dir):
    left = table(spark, sf_dir, "supplier").select(F.concat(F.lit("s"), F.col("s_suppkey").cast("string")).alias("entity_id"), F.col("s_nationkey").alias("part"), F.col("s_name").alias("text"))
    right = table(spark, sf_dir, "customer").select(F.concat(F.lit("c"), F.col("c_custkey").cast("string")).alias("entity_id"), F.col("c_nationkey").alias("part"), F.col("c_name").alias("text"))
    return tfidf.nearest(left, right)


@query()
def pair_features(spark, sf_dir):
    s1, s2, s3 = sources(spark, sf_dir)
    pairs = blocking.rule_candidates(s1, s2.unionByName(s3), _PAIRS)
    left, right = X.prepare_records(s1), X.prepare_records(s2.unionByName(s3))
    return features.pair_features(pairs, left, right)


def _flags_sql() -> str:
    """SELECT list of the features that need no string metric, over a left (a) and a right (b) record."""
    tri = lambda x: f"case when coalesce(a.{x}, '') = '' or coalesce(b.{x}, '') = '' then -1.0 when a.{x} = b.{x} then 1.0 else 0.0 end"
    equal = lambda x: f"case when a.{x} <> '' and a.{x} = b.{x} then 1.0 else 0.0 end"
    both = "i_{}".format
    jaccard = lambda g: f"case when len(a.{g}) > 0 and len(b.{g}) > 0 then {both(g)} / (len(a.{g}) + len(b.{g}) - {both(g)}) else 0 end"
    cosine = lambda g: f"case when len(a.{g}) > 0 and len(b.{g}) > 0 then {both(g)} / sqrt(len(a.{g})::double * len(b.{g})) else 0 end"
    same_nm, same_ad = ("(a.%s = b.%s and a.%s <> '')" % ((x,) * 3) for x in ("name", "address"))
    columns = {
        "nm_exact": equal("name"), "nm_sort_exact": equal("name_sorted"), "nm_char_jaccard": f"case when {same_nm} then 1.0 else {jaccard('ng')} end", "nm_tfidf_cosine": cosine("ng"),
        "nm_legal_suffix_match": tri("legal"), "nm_len_diff": "abs(len(a.name) - len(b.name))",
        "nm_len_ratio": f"case when {same_nm} then 1.0 else least(len(a.name), len(b.name)) / greatest(len(a.name), len(b.name), 1) end", "nm_first_word_match": equal("word"),
        "ad_char_jaccard": f"case when {same_ad} then 1.0 else {jaccard('ag')} end", "ad_tfidf_cosine": f"case when a.address <> '' and b.address <> '' then {cosine('ag')} else 0 end",
        "ad_unit_match": tri("unit"), "ad_street_num_match": tri("numbers[1]"), "ad_state_match": tri("state"), "ad_zip_match": tri("postal"), "ad_is_null": "case when b.address = '' then 1.0 else 0.0 end",
        "nm_soundex_match": equal("sound"), "street_soundex_match": equal("street_sound"), "full_tfidf_cosine": cosine("fg"),
        "is_s2": "(b.entity_id like 'S2-%')::int", "is_s3": "(b.entity_id like 'S3-%')::int",
        "is_us": "(upper(a.country) = 'US')::int", "is_india": "(upper(a.country) = 'INDIA')::int", "is_france": "(upper(a.country) = 'FRANCE')::int",
    }
    return ", ".join(f"round(({x})::double, 6) as {name}" for name, x in columns.items())


#: The features that built-in expressions give; the others are string metrics and Double Metaphone.
PLAIN = tuple(f for f in features.FEATURES if f not in ("nm_jw", "nm_sort_ratio", "nm_set_ratio", "nm_ratio", "ad_jw", "ad_sort_ratio", "ad_set_ratio", "ad_ratio", "ad_street_similarity", "nm_metaphone_match", "street_metaphone_match", "comb_set_ratio"))


@query(f"""with {Q.capped(STOP, CAP)},
f0 as (select rec.*, ent.business_address, {Q.sort_tokens('name')} as name_sorted, regexp_extract_all(cl.cn, {Q._q(Q.LEGAL)})[-1] as term, regexp_extract(lower(ent.business_address), {Q._q(_UNIT)}, 1) as unit,
       string_split(name, ' ')[1] as word, regexp_replace(regexp_replace(address, {Q._q(T.LEADING_NUMBER_PATTERN)}, ''), {Q._q(T.UNIT_PHRASE_PATTERN)}, '', 'g') as rest
       from rec join ent using (entity_id) join cl using (entity_id)),
f1 as (select *, coalesce({Q._map(T.LEGAL_CANONICAL)}[term], term, '') as legal, coalesce(list_filter(string_split(rest, ' '), lambda w: len(w) > 1 and not regexp_matches(w, '^[0-9]+$'))[1], '') as street,
       name || ' ' || name_sorted || ' ' || address as full_text from f0),
f2 as (select *, {', '.join(f"case when {x} = '' then [] else string_split({x}, '') end as {x}_chars" for x in ('name', 'address', 'full_text'))} from f1),
f as materialized (select *, {Q.soundex('word')} as sound, {Q.soundex('street')} as street_sound, {Q.long_ngrams('name_chars')} as ng, {Q.long_ngrams('address_chars')} as ag, {Q.long_ngrams('full_text_chars')} as fg from f2),
i as (select s1_id, candidate_id, {', '.join(f'len(list_intersect(a.{g}, b.{g})) as i_{g}' for g in ('ng', 'ag', 'fg'))} from pairs join f a on a.entity_id = s1_id join f b on b.entity_id = candidate_id)
select s1_id, candidate_id, {_flags_sql()} from i join f a on a.entity_id = s1_id join f b on b.entity_id = candidate_id""")
def pair_flags(spark, sf_dir):
    """The 23 features that stay in the JVM; the Python ones are pruned from the plan."""
    s1, s2, s3 = sources(spark, sf_dir)
    pairs = blocking.rule_candidates(s1, s2.unionByName(s3), dataclasses.replace(_CONFIG, with_key=True))
    out = features.pair_features(pairs, X.prepare_records(s1), X.prepare_records(s2.unionByName(s3)))
    return out.select("s1_id", "candidate_id", *[F.round(c, 6).alias(c) for c in PLAIN])


@query()
def gbt_pair_scores(spark, sf_dir):
    """Trees on cheap features of candidate pairs, against equal names."""
    s1, s2, s3 = sources(spark, sf_dir)
    pairs = blocking.rule_candidates(s1, s2.unionByName(s3), _PAIRS)
    rows = features.pair_features(model.training_pairs(pairs, same_name(spark, sf_dir)), X.prepare_records(s1), X.prepare_records(s2.unionByName(s3))).persist()
    inputs = [f for f in features.FEATURES if f not in ("nm_exact", "nm_sort_exact")]
    c = model.ModelConfig()
    fitted = model.fit_trees(rows, inputs, trees=c.trees, step=c.step, depth=c.depth, min_child=c.min_child, seed=c.seed)
    return model.probability(fitted, rows).select("s1_id", "candidate_id", "label", F.round("probability", 6).alias("probability"))


# --- ranking and decision: a user's events are its candidates, their values its scores ------------

_SCORED = """sc as (select user_id::varchar as s1_id, 'S' || (2 + event_id % 2) || '-' || event_id as candidate_id, value / 500.0 as probability,
event_type = 'purchase' as label from events), truth as (select s1_id, candidate_id from sc where label), spine as (select distinct s1_id from sc)"""
_RANKED = "rk as (select *, row_number() over (partition by s1_id order by probability desc, candidate_id) as rank from sc)"


def scored(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(scored with label, truth, spine)."""
    e = table(spark, sf_dir, "events")
    cid = F.concat(F.lit("S"), (2 + F.col("event_id") % 2).cast("string"), F.lit("-"), F.col("event_id").cast("string"))
    s = e.select(F.col("user_id").cast("string").alias("s1_id"), cid.alias("candidate_id"), (F.col("value") / 500.0).alias("probability"), (F.col("event_type") == "purchase").cast("int").alias("label"))
    return s, s.where("label = 1").select("s1_id", "candidate_id"), s.select("s1_id").distinct()


@query(f"with {_SCORED}, {_RANKED} select s1_id, candidate_id, probability from rk where rank <= 16")
def top16_rank(spark, sf_dir):
    return model.top_ranked(scored(spark, sf_dir)[0], 16, "probability").select("s1_id", "candidate_id", "probability")


@query(f"""with {_SCORED}, {_RANKED}, f as (select s1_id, max(probability) as max_prob, coalesce(max(probability) filter (where rank = 2), 0) as second_prob,
coalesce(max(probability) filter (where rank = 3), 0) as third_prob, count(*)::double as n_candidates, (count(*) filter (where probability >= 0.3))::double as n_over_30,
(count(*) filter (where probability >= 0.5))::double as n_over_50, round(avg(probability), 6) as mean_prob, round(sum(probability), 6) as sum_prob,
max(candidate_id) filter (where rank = 1) as top from rk group by s1_id)
select s1_id, max_prob, second_prob, third_prob, max_prob - second_prob as gap_1_2, max_prob - third_prob as gap_1_3, n_candidates, n_over_30, n_over_50, mean_prob, sum_prob,
case when top like 'S2-%' then 1.0::double else 0.0::double end as top1_is_s2, case when top like 'S3-%' then 1.0::double else 0.0::double end as top1_is_s3 from f""")
def entity_score_features(spark, sf_dir):
    s, _, spine = scored(spark, sf_dir)
    return decision.entity_features(s, spine).withColumns({c: F.round(c, 6) for c in ("mean_prob", "sum_prob")})


def _accept_sql(p: decision.Policy | None) -> str:
    v = {k: (getattr(p, k) if p else f"g.{k}") for k in ("tau_gate", "t_first", "t_second", "delta_margin", "max_matches")}
    return f"top >= {v['tau_gate']} and top >= {v['t_first']} and (rank = 1 or (probability >= {v['t_second']} and top - probability <= {v['delta_margin']})) and rank <= {v['max_matches']}"


_TOP = "tp as (select *, max(probability) over (partition by s1_id) as top from rk)"
EASY = decision.Policy(tau_gate=0.25, t_first=0.30, t_second=0.20, delta_margin=0.18, max_matches=6)


def _gate(s: DataFrame) -> DataFrame:
    return s.groupBy("s1_id").agg(F.max("probability").alias("p_match"))


@query(f"with {_SCORED}, {_RANKED}, {_TOP} select s1_id, candidate_id from tp where {_accept_sql(EASY)}")
def policy_decide(spark, sf_dir):
    s, _, _ = scored(spark, sf_dir)
    return decision.decide(s, _gate(s), EASY)


_F05 = "case when n_pred = 0 and n_true = 0 then 1.0 when n_pred = 0 or n_true = 0 or tp = 0 then 0.0 else 1.25 * (tp / n_pred) * (tp / n_true) / (0.25 * (tp / n_pred) + tp / n_true) end"
_GRID_ROWS = ", ".join(f"({i}, {p.tau_gate}, {p.t_first}, {p.t_second}, {p.delta_margin}, {p.max_matches})" for i, p in enumerate(decision.policy_grid()))


@query(f"""with {_SCORED}, {_RANKED}, {_TOP}, g(combo, tau_gate, t_first, t_second, delta_margin, max_matches) as (values {_GRID_ROWS}),
acc as (select combo, s1_id, count(*) as n_pred, count(*) filter (where label) as tp from tp join g on {_accept_sql(None)} group by 1, 2),
tr as (select s1_id, count(*) as n_true from truth group by 1),
e as (select g.combo, s.s1_id, coalesce(n_pred, 0) as n_pred, coalesce(tp, 0) as tp, coalesce(n_true, 0) as n_true from g cross join spine s
left join acc on acc.combo = g.combo and acc.s1_id = s.s1_id left join tr on tr.s1_id = s.s1_id)
select combo, round(avg({_F05}), 6) as f05 from e group by combo""")
def policy_grid(spark, sf_dir):
    s, truth, spine = scored(spark, sf_dir)
    return decision.policy_scores(s, _gate(s), truth, spine).withColumn("f05", F.round("f05", 6))


_SWEEP = ", ".join(f"({t})" for t in model.threshold_grid())


@query(f"""with {_SCORED}, g(threshold) as (values {_SWEEP}),
acc as (select threshold, s1_id, count(*) as n_pred, count(*) filter (where label) as tp from sc join g on probability >= threshold group by 1, 2),
tr as (select s1_id, count(*) as n_true from truth group by 1),
e as (select g.threshold, s.s1_id, coalesce(n_pred, 0) as n_pred, coalesce(tp, 0) as tp, coalesce(n_true, 0) as n_true from g cross join spine s
left join acc on acc.threshold = g.threshold and acc.s1_id = s.s1_id left join tr on tr.s1_id = s.s1_id)
select threshold::double as threshold, round(avg({_F05}), 6) as f05 from e group by threshold""")
def threshold_sweep(spark, sf_dir):
    s, truth, spine = scored(spark, sf_dir)
    return model.threshold_sweep(s.drop("label"), truth, spine).withColumn("f05", F.round("f05", 6))


@query(f"with {_SCORED} select s1_id, candidate_id from sc where probability >= case when candidate_id like 'S2-%' then 0.2 else 0.1 end")
def flat_threshold(spark, sf_dir):
    return model.flat_matches(scored(spark, sf_dir)[0], {"S2": 0.2, "S3": 0.1})


# --- metrics -------------------------------------------------------------------------------------

_COUNTS = """pr as (select s1_id, candidate_id from sc where probability >= 0.1),
ct as (select s1_id, count(*) filter (where probability >= 0.1) as n_pred, count(*) filter (where label) as n_true, count(*) filter (where label and probability >= 0.1) as tp from sc group by 1)"""


def _predicted(s: DataFrame) -> DataFrame:
    return s.where("probability >= 0.1")


@query(f"with {_SCORED}, {_COUNTS} select s1_id, n_pred, n_true, tp, round({_F05}, 6) as f05 from ct")
def entity_f05(spark, sf_dir):
    s, truth, spine = scored(spark, sf_dir)
    return metrics.entity_f05(_predicted(s), truth, spine).withColumn("f05", F.round("f05", 6))


@query(f"""with {_SCORED}, {_COUNTS}, e as (select n_true, {_F05} as f05 from ct)
select round(avg(f05), 6) as macro_f05, round(coalesce(avg(f05) filter (where n_true = 0), 1), 6) as singleton_macro_f05, round(coalesce(avg(f05) filter (where n_true > 0), 1), 6) as matched_macro_f05,
count(*) as n_entities, count(*) filter (where n_true = 0) as n_singletons, count(*) filter (where n_true > 0) as n_matched from e""")
def macro_f05(spark, sf_dir):
    s, truth, spine = scored(spark, sf_dir)
    return metrics.macro_f05(_predicted(s), truth, spine).withColumns({c: F.round(c, 6) for c in ("macro_f05", "singleton_macro_f05", "matched_macro_f05")})


@query(f"with {_SCORED}, {_COUNTS} select sum(tp)::bigint as tp, sum(n_pred)::bigint as n_pred, sum(n_true)::bigint as n_true, round(sum(tp) / sum(n_pred), 6) as precision, round(sum(tp) / sum(n_true), 6) as recall from ct")
def micro_pr(spark, sf_dir):
    s, truth, spine = scored(spark, sf_dir)
    return metrics.micro_precision_recall(_predicted(s), truth, spine).withColumns({c: F.round(c, 6) for c in ("precision", "recall")})


@query(f"""with {_SCORED}, c as (select count(*) filter (where probability >= 0.1 and label) as tp, count(*) filter (where probability >= 0.1 and not label) as fp,
count(*) filter (where probability < 0.1 and label) as fn, count(*) filter (where probability < 0.1 and not label) as tn from sc)
select tp, fp, fn, tn, round(tp / (tp + fp), 6) as precision, round(tp / (tp + fn), 6) as recall, round(2 * tp / (2 * tp + fp + fn), 6) as f1 from c""")
def confusion_counts(spark, sf_dir):
    return metrics.confusion(scored(spark, sf_dir)[0], 0.1).withColumns({c: F.round(c, 6) for c in ("precision", "recall", "f1")})


@query(f"""with {_SCORED}, r as (select label, rank() over (order by probability) + (count(*) over (partition by probability) - 1) / 2.0 as r from sc)
select round((sum(r) filter (where label) - count(*) filter (where label) * (count(*) filter (where label) + 1) / 2.0)
/ (count(*) filter (where label) * count(*) filter (where not label)), 6) as roc_auc from r""")
def roc_auc(spark, sf_dir):
    return metrics.roc_auc(scored(spark, sf_dir)[0]).withColumn("roc_auc", F.round("roc_auc", 6))


@query(f"""with {_SCORED}, {_COUNTS}, f as (select ('0x' || substr(md5(s1_id || '-42'), 1, 8))::bigint % 5 as fold, {_F05} as f05 from ct), m as (select fold, avg(f05) as f05 from f group by fold)
select round(avg(f05), 6) as mean_f05, round(stddev_pop(f05), 6) as std_f05 from m""")
def cv_summary(spark, sf_dir):
    s, truth, spine = scored(spark, sf_dir)
    e = metrics.entity_f05(_predicted(s), truth, spine)
    folds = sampling.assign_folds(e, 5).groupBy("fold").agg(F.avg("f05").alias("f05"))
    return metrics.mean_and_std(folds, ["f05"]).withColumns({c: F.round(c, 6) for c in ("mean_f05", "std_f05")})


@query(f"""with {Q.ENTITIES}, {_TRUTH}, t as (select s1_id, count(*) filter (where candidate_id like 'S2-%') as n2, count(*) filter (where candidate_id like 'S3-%') as n3 from truth group by 1),
e as (select country, coalesce(n2, 0) as n2, coalesce(n3, 0) as n3 from ent left join t on s1_id = entity_id where entity_id like 'S1-%'),
l as (select count(*) as n_s1, round(avg((country = 'US')::int), 6) as us_share, round(avg((country = 'India')::int), 6) as india_share, round(avg((n2 > 0 and n3 > 0)::int), 6) as both_share,
round(avg((n2 > 0 and n3 = 0)::int), 6) as s2_only_share, round(avg((n2 = 0 and n3 > 0)::int), 6) as s3_only_share, round(avg((n2 = 0 and n3 = 0)::int), 6) as singleton_share,
round(avg(n2), 6) as avg_s2, round(avg(n3), 6) as avg_s3 from e)
select l.*, (select round(avg((business_address = '')::int), 6) from ent where entity_id like 'S2-%') as s2_empty_share, (select round(avg((business_address = '')::int), 6) from ent where entity_id like 'S3-%') as s3_empty_share from l""")
def split_statistics(spark, sf_dir):
    s1, s2, s3 = sources(spark, sf_dir)
    out = metrics.split_statistics(s1, s2.unionByName(s3), same_name(spark, sf_dir))
    return out.withColumns({c: F.round(c, 6) for c in out.columns if c != "n_s1"})


# --- splits and samples --------------------------------------------------------------------------


@query("""with c as (select c_mktsegment as segment, c_nationkey as nation, count(*) as n from customer group by all), x as (select *, n * 500 / sum(n) over () as e from c),
f as (select *, floor(e)::bigint as fl, 500 - sum(floor(e)) over () as left_over from x)
select segment, nation, n, (fl + case when row_number() over (order by round(e - fl, 9) desc, segment, nation) <= left_over then 1 else 0 end)::bigint as quota from f""")
def stratified_quota(spark, sf_dir):
    c = table(spark, sf_dir, "customer").groupBy(F.col("c_mktsegment").alias("segment"), F.col("c_nationkey").alias("nation")).agg(F.count("*").alias("n"))
    return sampling.largest_remainder(c, 500, ["segment", "nation"])


@query("select c_custkey, c_mktsegment from customer qualify row_number() over (partition by c_mktsegment order by md5(c_custkey || '-42'), c_custkey) <= 60")
def reservoir_rank(spark, sf_dir):
    return sampling.reservoir(table(spark, sf_dir, "customer"), ["c_mktsegment"], "c_custkey", 60).select("c_custkey", "c_mktsegment")


_TWO = """with q as (select *, row_number() over (partition by c_mktsegment order by md5(c_custkey || '-42'), c_custkey) as r, count(*) over (partition by c_mktsegment) as n from customer),
c as (select c_mktsegment, count(*) as n from customer group by 1),
x as (select *, n * 100 / sum(n) over () as e1, n * 400 / sum(n) over () as e2 from c),
f as (select c_mktsegment, floor(e1)::bigint + case when row_number() over (order by round(e1 - floor(e1), 9) desc, c_mktsegment) <= 100 - sum(floor(e1)) over () then 1 else 0 end as q1,
floor(e2)::bigint + case when row_number() over (order by round(e2 - floor(e2), 9) desc, c_mktsegment) <= 400 - sum(floor(e2)) over () then 1 else 0 end as q2 from x)
select c_custkey, case when r <= q1 then 'test' else 'train' end as part from q join f using (c_mktsegment) where r <= q1 + q2"""


@query(_TWO)
def disjoint_samples(spark, sf_dir):
    test, train = sampling.disjoint_samples(table(spark, sf_dir, "customer"), ["c_mktsegment"], "c_custkey", [100, 400])
    return test.select("c_custkey", F.lit("test").alias("part")).unionByName(train.select("c_custkey", F.lit("train").alias("part")))


def _pool(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers as a pool: two countries by nation, no address with a negative balance."""
    c = table(spark, sf_dir, "customer")
    return c.select(F.col("c_custkey").alias("entity_id"), F.when(F.col("c_nationkey") < 15, "US").otherwise("India").alias("country"), F.when(F.col("c_acctbal") < 0, "").otherwise(F.col("c_name")).alias("business_address"))


@query("""with p as (select c_custkey as entity_id, case when c_nationkey < 15 then 'US' else 'India' end as country, c_acctbal < 0 as empty from customer
where c_custkey not in (select o_custkey from orders where o_orderpriority = '1-URGENT'))
select entity_id, country from p qualify row_number() over (partition by country, empty order by md5(entity_id || '-42'), entity_id)
<= case when country = 'US' then case when empty then 4 else 116 end else case when empty then 3 else 77 end end""")
def null_calibrated_sample(spark, sf_dir):
    used = table(spark, sf_dir, "orders").where("o_orderpriority = '1-URGENT'").select(F.col("o_custkey").alias("entity_id")).distinct()
    return sampling.calibrated_distractors(_pool(spark, sf_dir), used, size=200, empty_rate=0.03356).select("entity_id", "country")


@query("""select c_custkey as entity_id, case when c_nationkey < 15 then 'US' else 'India' end as country, c_acctbal < 0 as is_empty from customer
qualify row_number() over (partition by country, is_empty order by md5(c_custkey || '-42'), c_custkey) <= 60""")
def pool_scan(spark, sf_dir):
    return sampling.pool_scan(_pool(spark, sf_dir), 60).select("entity_id", "country", "is_empty")


_ORDERS = "t as (select o_custkey as s1_id, o_orderkey as candidate_id from orders where o_orderstatus = 'F'), sp as (select c_custkey as s1_id from customer)"


def _orders(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """(truth, spine): finished orders are a customer's matches."""
    o = table(spark, sf_dir, "orders").where("o_orderstatus = 'F'").select(F.col("o_custkey").alias("s1_id"), F.col("o_orderkey").alias("candidate_id"))
    return o, table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("s1_id"))


_SPLIT = f"""{_ORDERS}, e as (select s1_id, case when s1_id in (select s1_id from t) then 'matched' else 'singleton' end as stratum from sp),
v as (select s1_id, stratum, row_number() over (partition by stratum order by md5(s1_id || '-42'), s1_id) <= greatest(1, round(count(*) over (partition by stratum) * 0.2)) as is_val from e)"""


@query(f"with {_SPLIT} select s1_id, stratum, is_val from v")
def entity_split(spark, sf_dir):
    truth, spine = _orders(spark, sf_dir)
    return sampling.entity_split(spine, truth)


@query(f"with {_SPLIT} select o_orderkey as entity_id from orders where o_orderkey not in (select candidate_id from t join v using (s1_id) where is_val)")
def quarantine_anti(spark, sf_dir):
    truth, spine = _orders(spark, sf_dir)
    held = sampling.entity_split(spine, truth).where("is_val")
    return sampling.quarantine(table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("entity_id")), truth, held)


@query(f"""with {_SPLIT}, c as (select is_val, 'S' || (2 + candidate_id % 2) || '-' || (candidate_id % 999) as id from t join v using (s1_id)),
o as (select id from c where is_val intersect select id from c where not is_val)
select (select count(*) from (select s1_id from v where is_val intersect select s1_id from v where not is_val)) as s1_overlap,
       (select count(*) from o where id like 'S2-%') as s2_overlap, (select count(*) from o where id like 'S3-%') as s3_overlap""")
def leakage_audit(spark, sf_dir):
    """The entity split with 999 targets of each source, which orders of both parts share."""
    truth, spine = _orders(spark, sf_dir)
    marked = sampling.entity_split(spine, truth)
    key = F.col("candidate_id")
    truth = truth.withColumn("candidate_id", F.concat(F.lit("S"), (2 + key % 2).cast("string"), F.lit("-"), (key % 999).cast("string")))
    parts = [marked.where(c).select("s1_id") for c in ("not is_val", "is_val")]
    return sampling.leakage(*parts, *[truth.join(p, "s1_id", "left_semi") for p in parts])


@query("select c_custkey as s1_id, (('0x' || substr(md5(c_custkey || '-42'), 1, 8))::bigint % 5)::int as fold from customer")
def kfold_assign(spark, sf_dir):
    return sampling.assign_folds(_orders(spark, sf_dir)[1], 5)


@query(f"""with {Q.ENTITIES}, {_TRUTH}, t as (select s1_id, count(*) filter (where candidate_id like 'S2-%') as n_s2, count(*) filter (where candidate_id like 'S3-%') as n_s3 from truth group by 1),
e as (select entity_id, case when country = '' then 'US' else country end as country, coalesce(n_s2, 0) as n_s2, coalesce(n_s3, 0) as n_s3 from ent left join t on s1_id = entity_id where entity_id like 'S1-%')
select country, case when n_s2 > 0 and n_s3 > 0 then 'both' when n_s2 > 0 then 's2_only' when n_s3 > 0 then 's3_only' else 'singleton' end as category, n_s2, n_s3, count(*) as n from e group by all""")
def match_strata(spark, sf_dir):
    s1, _, _ = sources(spark, sf_dir)
    return sampling.entity_strata(s1, same_name(spark, sf_dir)).groupBy("country", "category", "n_s2", "n_s3").agg(F.count("*").alias("n"))


@query(f"""with {Q.ENTITIES}, {_TRUTH}, e as (select entity_id, entity_id in (select s1_id from truth) as m from ent where entity_id like 'S1-%')
select entity_id as s1_id from e qualify row_number() over (partition by m order by md5(entity_id || '-42'), entity_id) <= case when m then 80 else 20 end""")
def training_sample(spark, sf_dir):
    return sampling.training_sample(sources(spark, sf_dir)[0], same_name(spark, sf_dir), size=100)


# --- lists, labels and validation: an order's lines are its ids -----------------------------------

_LISTS = """li as (select 'S1-' || l_orderkey as s1_id, list(case when l_returnflag = 'R' then 'S2-' when l_linenumber = 7 then 'S1-' when l_tax = 0.08 then 'X-' else 'S3-' end || l_partkey % 50) as ids from lineitem group by 1)"""


def _lists(spark: SparkSession, sf_dir: str) -> DataFrame:
    prefix = F.when(F.col("l_returnflag") == "R", "S2-").when(F.col("l_linenumber") == 7, "S1-").when(F.col("l_tax") == 0.08, "X-").otherwise("S3-")
    one = table(spark, sf_dir, "lineitem").select(F.concat(F.lit("S1-"), F.col("l_orderkey").cast("string")).alias("s1_id"), F.concat(prefix, (F.col("l_partkey") % 50).cast("string")).alias("id"))
    return one.groupBy("s1_id").agg(F.collect_list("id").alias("ids"))


_EX = "list_sort(list(distinct {}))[1:5]"


@query(f"""with {_LISTS.replace('li as', 'l0 as', 1)}, li as (select * from l0 union all select 'S1-' || o_orderkey, [] from orders where o_orderpriority = '1-URGENT'),
rq as (select 'S1-' || o_orderkey as s1_id from orders where o_orderstatus <> 'P' union all select 'S1-C' || c_custkey from customer where c_acctbal < 0), tg as (select 'S2-' || s_suppkey as entity_id from supplier union select 'S3-' || s_suppkey from supplier),
r as (select 'repeated_id' as rule, s1_id as x from li where len(ids) <> len(list_distinct(ids)) union all
select 'self_match', s1_id from li where len(list_filter(ids, lambda y: y like 'S1-%')) > 0 union all select 'wrong_prefix', s1_id from li where len(list_filter(ids, lambda y: y like 'X-%')) > 0 union all
select 'is_empty', s1_id from li where len(ids) = 0 union all select 'duplicate_s1', s1_id from li group by s1_id having count(*) > 1 union all
select 'missing_s1', s1_id from rq where s1_id not in (select s1_id from li) union all select distinct 'extra_s1', s1_id from li where s1_id not in (select s1_id from rq) union all
select 'unknown_id', u from (select distinct unnest(ids) as u from li) where (u like 'S2-%' or u like 'S3-%') and u not in (select entity_id from tg))
select rule, count(*) as n, array_to_string({_EX.format('x')}, ',') as examples from r group by rule""")
def submission_rules(spark, sf_dir):
    """Lists of orders, those of urgent ones twice and once empty; customers in debt are required and have none."""
    orders, debt = table(spark, sf_dir, "orders"), table(spark, sf_dir, "customer").where("c_acctbal < 0")
    named = F.concat(F.lit("S1-"), F.col("o_orderkey").cast("string")).alias("s1_id")
    required = orders.where("o_orderstatus <> 'P'").select(named).unionByName(debt.select(F.concat(F.lit("S1-C"), F.col("c_custkey").cast("string")).alias("s1_id")))
    lists = _lists(spark, sf_dir).unionByName(orders.where("o_orderpriority = '1-URGENT'").select(named, F.array().cast("array<string>").alias("ids")))
    ids = table(spark, sf_dir, "supplier").select(F.explode(F.array(*[F.concat(F.lit(p), F.col("s_suppkey").cast("string")) for p in ("S2-", "S3-")])).alias("entity_id"))
    return validate.rule_counts(lists, required, ids).withColumn("examples", F.array_join("examples", ","))


@query(f"""with {_LISTS}, ca as (select s1_id, list_filter(ids, lambda y: y not like 'S3-%') as c from li)
select s1_id, array_to_string(o, ',') as outside from (select s1_id, list_sort(list_distinct(list_filter(ids, lambda y: not list_contains(c, y)))) as o from li join ca using (s1_id)) where len(o) > 0""")
def match_subset_check(spark, sf_dir):
    lists = _lists(spark, sf_dir)
    inside = lists.select("s1_id", F.filter("ids", lambda x: ~x.startswith("S3-")).alias("ids"))
    return validate.not_in_candidates(lists, inside).withColumn("outside", F.array_join("outside", ","))


@query("""select 'S1-' || o_orderkey as s1_id, coalesce(string_agg(distinct 'S2-' || l_partkey, ',' order by 'S2-' || l_partkey), '') as matched_entity_ids
from orders left join lineitem on l_orderkey = o_orderkey group by 1""")
def match_list_export(spark, sf_dir):
    pairs = table(spark, sf_dir, "lineitem").select(F.concat(F.lit("S1-"), F.col("l_orderkey").cast("string")).alias("s1_id"), F.concat(F.lit("S2-"), F.col("l_partkey").cast("string")).alias("candidate_id"))
    spine = table(spark, sf_dir, "orders").select(F.concat(F.lit("S1-"), F.col("o_orderkey").cast("string")).alias("s1_id"))
    return io.id_list(pairs, spine, "s1_id", "candidate_id", "matched_entity_ids")


@query("""select 'S1-' || l_orderkey as s1_id, array_to_string(list_sort(list(distinct x)), ',') as match_ids from (select l_orderkey, unnest(['S2-' || l_partkey, 'S3-' || l_suppkey]) as x from lineitem) group by 1""")
def label_union(spark, sf_dir):
    cell = F.concat(F.lit(" S2-"), F.col("l_partkey").cast("string"), F.lit(", ,S3-"), F.col("l_suppkey").cast("string"), F.lit(" "))
    rows = table(spark, sf_dir, "lineitem").select(F.concat(F.lit("S1-"), F.col("l_orderkey").cast("string")).alias("s1_id"), cell.alias("ids"))
    return io.unite_labels(rows).withColumn("match_ids", F.array_join("match_ids", ","))


@query(f"with {_LISTS} select count(*) as n_rows, count(*) filter (where len(ids) > 0) as n_non_empty, count(*) filter (where len(ids) = 0) as n_empty, sum(len(ids))::bigint as n_ids, count(*) - count(distinct s1_id) as n_duplicates from li")
def file_integrity(spark, sf_dir):
    return metrics.file_integrity(_lists(spark, sf_dir))
