"""Chat formatting, in DataFrame functions only: tool-call linking.

Calls and results are hash-joined by identifier and put in topological order of what calls depend on;
arguments are validated against schemas, and each linked call is serialised as canonical JSON.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import cut, sha256_hex

#: Tool -> field -> (type, required). No other field is allowed.
SCHEMAS: dict[str, dict[str, tuple[str, bool]]] = {
    "configure": {"chars": ("integer", True), "prompt": ("string", True)},
    "reply": {"chars": ("integer", True), "prompt": ("string", True), "user": ("string", False)},
}
#: Variant type names, as schema_of_variant spells them, of each schema type.
_KINDS = {"integer": "BIGINT", "number": "(BIGINT|DECIMAL.*|DOUBLE|FLOAT)", "string": "STRING", "boolean": "BOOLEAN", "array": "ARRAY.*", "object": "OBJECT.*"}
CALL = ["conv_id", "call_id", "turn", "name", "arguments", "after"]


def problem(name: Column, arguments: Column, schemas: dict[str, dict[str, tuple[str, bool]]]) -> Column:
    """First thing wrong with a call's arguments (JSON text), null if they are valid; one expression for all tools."""
    value = F.try_parse_json(arguments)
    out = F.when(value.isNull() | ~F.coalesce(F.schema_of_variant(value).startswith("OBJECT"), F.lit(False)), F.lit("not an object"))
    for tool, fields in sorted(schemas.items()):
        extra = F.array_except(F.json_object_keys(arguments), F.array(*[F.lit(f) for f in sorted(fields)]))
        wrong = F.when(F.size(extra) > 0, F.lit("unknown field"))
        for field, (kind, required) in sorted(fields.items()):
            found = F.schema_of_variant(F.try_variant_get(value, f"$.{field}", "variant"))
            missing = found.isNull() | (found == "VOID")
            if required:
                wrong = wrong.when(missing, F.lit(f"missing {field}"))
            wrong = wrong.when(~missing & ~found.rlike(f"^{_KINDS[kind]}$"), F.lit(f"type of {field}"))
        out = out.when(name == tool, wrong)
    return out.when(name.isNull() | ~name.isin(sorted(schemas)), F.lit("unknown tool"))


def levels(calls: DataFrame) -> DataFrame:
    """(call_id, level): 0 for calls that depend on no known call, else one above the highest they depend on.

    Calls on a cycle, or behind one, have no row. One round for each level of the deepest chain.
    """
    ids = calls.select("call_id")
    wants = calls.select("call_id", F.explode("after").alias("dep")).distinct()
    wants = cut(wants.join(ids.select(F.col("call_id").alias("dep")), "dep", "left_semi"))
    degree = cut(wants.groupBy("call_id").agg(F.count("*").alias("open")))
    fresh = cut(ids.join(degree, "call_id", "left_anti").select("call_id", F.lit(0).alias("level")))
    done = fresh
    while not degree.isEmpty() and not fresh.isEmpty():
        met = wants.join(fresh.select(F.col("call_id").alias("dep")), "dep").groupBy("call_id").agg(F.count("*").alias("met"))
        left = cut(degree.join(met, "call_id", "left").select("call_id", (F.col("open") - F.coalesce("met", F.lit(0))).alias("open")))
        level = done.agg(F.max("level")).first()[0] + 1
        fresh = cut(left.where("open = 0").select("call_id", F.lit(level).alias("level")))
        degree = left.where("open > 0")
        done = cut(done.unionByName(fresh))
    return done


def link(calls: DataFrame, results: DataFrame, schemas: dict[str, dict[str, tuple[str, bool]]] = SCHEMAS) -> DataFrame:
    """One row per call, and one per result without a call.

    ``calls``: conv_id, call_id, turn, name, arguments (JSON text), after (ids it depends on; null: none).
    ``results``: call_id, conv_id, turn, content. Columns: conv_id, call_id, turn, name, level, position (in
    its conversation by level, turn, id, from 1), linked, valid, problem, json. A call on a cycle has no
    level or position. Rows without call_id are left out: nothing can be linked to them. Of repeated call
    or result ids the least row counts, so repeated rows change nothing. A result without a call has null
    name, level, position and valid, and its content as json. Empty tables give an empty table. Extra
    columns are not looked at. Positions come from counts of blocks of turns, so that no task holds a
    long conversation.
    """
    ranked = F.struct("turn", "conv_id", "name", "arguments", F.array_sort(F.array_distinct(F.coalesce("after", F.array().cast("array<string>")))).alias("after"))
    calls = calls.where("call_id is not null").groupBy("call_id").agg(F.min(ranked).alias("c")).select("call_id", "c.*")
    calls = cut(calls)
    results = results.where("call_id is not null").groupBy("call_id").agg(F.min(F.struct("turn", "conv_id", "content")).alias("r"))
    placed = calls.join(levels(calls), "call_id", "left").withColumn("_part", F.floor(F.col("turn") / 1024))
    part = ["conv_id", "level", "_part"]
    counts = placed.where("level is not null").groupBy(*part).agg(F.count("*").alias("_n"))
    before = Window.partitionBy("conv_id").orderBy("level", "_part").rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.withColumn("_before", F.coalesce(F.sum("_n").over(before), F.lit(0)))
    counts = counts.select(*[F.col(c).alias(f"_{c}") for c in part], "_before")
    same = [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in part]
    placed = placed.join(counts, same[0] & same[1] & same[2], "left")
    within = Window.partitionBy(*part).orderBy("turn", "call_id")
    position = F.when(F.col("level").isNotNull(), F.col("_before") + F.row_number().over(within))
    joined = placed.withColumn("position", position).join(results.hint("shuffle_hash"), "call_id", "left")
    wrong = problem(F.col("name"), F.col("arguments"), schemas)
    whole = F.struct(F.try_parse_json("arguments").alias("arguments"), F.col("call_id").alias("id"), F.col("name"), F.col("r.content").alias("result"))
    linked = joined.select("conv_id", "call_id", F.col("turn").cast("long").alias("turn"), "name", F.col("level").cast("long").alias("level"), F.col("position").cast("long").alias("position"), F.col("r").isNotNull().alias("linked"), wrong.isNull().alias("valid"), wrong.alias("problem"), F.to_json(whole, {"ignoreNullFields": "false"}).alias("json"))
    orphans = results.join(calls, "call_id", "left_anti")
    none = F.lit(None)
    orphans = orphans.select(F.col("r.conv_id").alias("conv_id"), "call_id", F.col("r.turn").cast("long").alias("turn"), none.cast("string").alias("name"), none.cast("long").alias("level"), none.cast("long").alias("position"), F.lit(False).alias("linked"), none.cast("boolean").alias("valid"), F.lit("no call").alias("problem"), F.to_json(F.struct(F.col("r.content").alias("result")), {"ignoreNullFields": "false"}).alias("json"))
    return linked.unionByName(orphans)


def calls_of(turns: DataFrame) -> DataFrame:
    """Turns as calls: a system turn configures, a user turn asks for a reply, or for a search that no tool does.

    Turn t waits for turn t // 2 and for the first, so that levels go up to the logarithm of a conversation's
    length. By the length of the text, five turns in 13 have arguments that a schema must refuse.
    """
    text = F.coalesce("text", F.lit(""))
    n, kind = F.char_length(text), F.char_length(text) % 13
    name = F.when(F.col("role") == "system", "configure").when(n % 19 == 5, "search").when(F.col("role") == "user", "reply")
    prompt, chars = text.alias("prompt"), n.alias("chars")
    arguments = F.when(kind == 1, F.to_json(F.struct(prompt, n.cast("string").alias("chars")))).when(kind == 2, F.to_json(F.struct(chars)))
    arguments = arguments.when(kind == 3, F.to_json(F.struct(prompt, chars, F.lit("x").alias("note")))).when(kind == 4, F.lit("not JSON")).when(kind == 5, F.lit("[1]"))
    arguments = arguments.otherwise(F.to_json(F.struct(prompt, chars)))
    after = F.when(F.col("turn") > 0, F.array(_id("conv_id", F.expr("turn div 2")), _id("conv_id", F.lit(0))))
    return turns.where("role in ('system', 'user')").select("conv_id", _id("conv_id", F.col("turn")).alias("call_id"), "turn", name.alias("name"), arguments.alias("arguments"), after.alias("after"))


def results_of(turns: DataFrame) -> DataFrame:
    """Assistant turns as results of the call one turn before."""
    text = F.coalesce("text", F.lit(""))
    return turns.where("role = 'assistant'").select("conv_id", _id("conv_id", F.col("turn") - 1).alias("call_id"), "turn", text.alias("content"))


def _id(conv: str, turn: Column) -> Column:
    return F.concat(F.lit("call_"), F.col(conv).cast("string"), F.lit("_"), turn.cast("string"))


def digest(turns: DataFrame) -> DataFrame:
    turns = turns.select("conv_id", "turn", "role", "text")
    out = link(calls_of(turns), results_of(turns))
    return out.select("conv_id", "call_id", "turn", "name", "level", "position", "linked", "valid", "problem", sha256_hex(F.col("json")).alias("json_sha256"))


SQL = """
with recursive t as (select *, coalesce(text, '') as prompt, length(coalesce(text, '')) as n from conversations where conv_id is not null and turn is not null),
c as (
  select conv_id, turn, 'call_' || conv_id || '_' || turn as call_id, case when role = 'system' then 'configure' when n % 19 = 5 then 'search' else 'reply' end as name, prompt, n, n % 13 as kind
  from t where role in ('system', 'user') qualify row_number() over (partition by conv_id, turn order by name, prompt) = 1),
r as (select 'call_' || conv_id || '_' || (turn - 1) as call_id, conv_id, turn, min(prompt) as content from t where role = 'assistant' group by conv_id, turn),
d as (select distinct a.call_id, b.call_id as dep from c a join c b on a.conv_id = b.conv_id and a.turn > 0 and (b.turn = 0 or b.turn = a.turn // 2)),
p(call_id, depth) as (select call_id, 0 from c union select d.call_id, depth + 1 from p join d on d.dep = p.call_id),
l as (select call_id, max(depth) as level from p group by call_id),
j as (select c.*, level, case when kind in (4, 5) then 'not an object' when name = 'search' then 'unknown tool' when kind = 3 then 'unknown field' when kind = 1 then 'type of chars'
             when kind = 2 then 'missing prompt' end as problem,
             case kind when 4 then 'null' when 5 then '[1]' else '{"chars":' || case when kind = 1 then '"' || n || '"' else '' || n end || case when kind = 3 then ',"note":"x"' else '' end
             || case when kind = 2 then '' else ',"prompt":' || to_json(prompt) end || '}' end as arguments
      from c join l using (call_id))
select j.conv_id, j.call_id, j.turn, name, cast(level as bigint) as level,
       row_number() over (partition by j.conv_id order by level, j.turn, j.call_id) as position,
       r.call_id is not null as linked, problem is null as valid, problem,
       sha256('{"arguments":' || arguments || ',"id":"' || j.call_id || '","name":"' || name || '","result":' || coalesce(to_json(content), 'null') || '}') as json_sha256
from j left join r on j.call_id = r.call_id
union all
select conv_id, call_id, turn, null, null, null, false, null, 'no call', sha256('{"result":' || to_json(content) || '}')
from r where call_id not in (select call_id from c)
"""
