"""Chat formatting with tool calls linked to their results, with DataFrame functions only.

Calls and results are hash-joined by identifier, ordered so that a call comes after the calls whose results it uses,
checked against the tools' schemas, and written as canonical JSON (keys sorted, no white space).

A call's anchor is the latest place, in the text, of itself and all that it uses, directly or through others. Calls are
in the order of their anchors, and within one anchor in the order of use; so a conversation in which every call uses
only earlier ones stays as it is, and only the calls that break this, and what hangs on them, take part in rounds.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pyrocell.llm.common import kept

TYPES = {"string": "^STRING", "integer": "^BIGINT", "number": "^(BIGINT|DOUBLE|FLOAT|DECIMAL)", "boolean": "^BOOLEAN", "array": "^ARRAY", "object": "^OBJECT"}
TURNS_BY_RANGE = 1024


@dataclass(frozen=True)
class Tool:
    """Properties by name with their types (keys of TYPES), and those that must be there."""

    properties: dict[str, str] = field(default_factory=dict)
    required: tuple[str, ...] = ()


def parsed(messages: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Calls and results written in the text of ``messages`` (conv_id, turn, role, text).

    An assistant's ``<tool_call>{"id", "name", "arguments", "after"}</tool_call>``; a tool's
    ``<tool_result id="...">...</tool_result>``. ``after`` lists the ids of calls whose results the call uses.
    Messages whose role or text is null have neither; a call whose text is no JSON stays, with nulls; repeated rows give
    repeated calls; an empty table gives empty tables; other columns aren't read.
    """
    found = messages.where("role = 'assistant'").select("conv_id", "turn", F.posexplode(F.regexp_extract_all("text", F.lit(r"(?s)<tool_call>(.*?)</tool_call>"), 1)).alias("place", "raw"))
    v = F.try_parse_json("raw")
    get = lambda path, kind: F.try_variant_get(v, path, kind)
    calls = found.select("conv_id", "turn", "place", get("$.id", "string").alias("call_id"), get("$.name", "string").alias("name"), F.to_json(get("$.arguments", "variant")).alias("arguments"), get("$.after", "array<string>").alias("after"))
    answers = messages.where("role = 'tool'").select("conv_id", "turn", F.posexplode(F.regexp_extract_all("text", F.lit(r'(?s)(<tool_result id="[^"]*">.*?)</tool_result>'), 1)).alias("place", "raw"))
    results = answers.select("conv_id", "turn", "place", F.regexp_extract("raw", r'id="([^"]*)"', 1).alias("call_id"), F.regexp_extract("raw", r'(?s)">(.*)$', 1).alias("content"))
    return calls, results


def problem(name: Column, arguments: Column, tools: dict[str, Tool]) -> Column:
    """What is wrong with a call's arguments, or null."""
    v = F.try_parse_json(arguments)
    out = F.when(v.isNull(), "no JSON")
    for tool, schema in sorted(tools.items()):
        tests = F.when(~F.coalesce(F.schema_of_variant(v), F.lit("")).rlike("^OBJECT"), "no object")
        for key in schema.required:
            tests = tests.when(F.try_variant_get(v, f"$['{key}']", "variant").isNull() | (F.schema_of_variant(F.try_variant_get(v, f"$['{key}']", "variant")) == "VOID"), f"missing {key}")
        for key, kind in sorted(schema.properties.items()):
            part = F.try_variant_get(v, f"$['{key}']", "variant")
            tests = tests.when(part.isNotNull() & ~F.schema_of_variant(part).rlike(TYPES[kind]), f"{key} is no {kind}")
        out = out.when((name == tool) & tests.isNotNull(), tests).when(name == tool, F.lit(None))
    return out.otherwise("unknown tool")


def firsts(results: DataFrame) -> DataFrame:
    """(conv_id, call_id, first, n_results): the first result of each id, with its ``__row``, and how many there are."""
    return results.where("call_id IS NOT NULL AND conv_id IS NOT NULL").groupBy("conv_id", "call_id").agg(F.min(F.struct("turn", "place", "content", "__row")).alias("first"), F.count("*").alias("n_results"))


def links(calls: DataFrame, results: DataFrame) -> DataFrame:
    """Each call with ``copies`` (calls of its id), ``result_turn`` and ``content`` of the first result of its id.

    Results and counts are reduced to one row by id before the hash join with the calls. An id that a thousandth of all
    calls or more share is salted on both sides (there are at most a thousand), and calls without an id aren't joined.
    """
    keys = ["conv_id", "call_id"]
    named = calls.where("conv_id IS NOT NULL AND call_id IS NOT NULL")
    of = named.groupBy(*keys).agg(F.count("*").alias("copies")).join(firsts(results).hint("shuffle_hash"), keys, "left")
    least = max(1000, calls.count() // 1000)
    salts = F.greatest(F.lit(1), F.ceil(F.col("copies") / least).cast("int"))
    many = F.broadcast(named.groupBy(*keys).agg(F.count("*").alias("copies")).where(F.col("copies") > least).select(*keys, salts.alias("__salts")))
    left = named.join(many, keys, "left").withColumn("__salt", F.pmod("__row", F.coalesce("__salts", F.lit(1))).cast("int"))
    right = of.withColumn("__salt", F.explode(F.sequence(F.lit(0), salts - 1)))
    out = left.join(right.hint("shuffle_hash"), [*keys, "__salt"], "left").select(*calls.columns, "copies", F.coalesce("n_results", F.lit(0)).alias("n_results"), F.col("first.turn").alias("result_turn"), F.col("first.content").alias("content"))
    bare = calls.where("conv_id IS NULL OR call_id IS NULL").withColumns({"copies": F.lit(1).cast("long"), "n_results": F.lit(0).cast("long"), "result_turn": F.lit(None).cast(out.schema["result_turn"].dataType), "content": F.lit(None).cast("string")})
    return out.unionByName(bare)


#: Rounds after which what they added is folded into one table.
FOLD = 8


def anchors(calls: DataFrame) -> DataFrame:
    """(conv_id, call_id, anchor, depth) of the calls whose place in the text isn't their place in the order.

    ``anchor`` is a struct (turn, place); ``depth`` the longest way from the anchor's call through calls of this anchor;
    -1 marks calls in a circle, and those that a circle of their anchor holds up. Rounds are as many as the longest
    chain of such calls, each writes what it adds.
    """
    place, key = F.struct("turn", "place"), ["conv_id", "call_id"]
    named = calls.where("call_id IS NOT NULL AND conv_id IS NOT NULL")
    nodes = named.groupBy(*key).agg(F.min(place).alias("at"))
    uses = named.select(*key, F.explode("after").alias("used")).distinct()
    edges = uses.join(nodes.hint("shuffle_hash"), key).join(nodes.select("conv_id", F.col("call_id").alias("used"), F.col("at").alias("used_at")).hint("shuffle_hash"), ["conv_id", "used"])
    edges = kept(edges.select(*key, "used", "at", "used_at"))
    new = kept(edges.where("used_at >= at").groupBy(*key).agg(F.max("used_at").alias("anchor"), F.first("at").alias("at")))
    if new.isEmpty():
        return new.select(*key, "anchor", F.lit(0).alias("depth"))
    odd = edges.join(new.select("conv_id").distinct(), "conv_id", "left_semi")
    parts = [new]
    known = lambda: reduce(DataFrame.unionByName, parts).groupBy(*key).agg(F.max("anchor").alias("anchor"))
    while not new.isEmpty():
        moved = odd.join(new.select("conv_id", F.col("call_id").alias("used"), "anchor"), ["conv_id", "used"]).where("anchor > at").groupBy(*key).agg(F.max("anchor").alias("anchor"), F.first("at").alias("at"))
        new = kept(moved.join(known().withColumnRenamed("anchor", "before"), key, "left").where("before IS NULL OR anchor > before").select(*key, "anchor", "at"))
        parts.append(new)
        if len(parts) > FOLD:
            parts = [kept(reduce(DataFrame.unionByName, parts).groupBy(*key).agg(F.max("anchor").alias("anchor"), F.first("at").alias("at")))]
    of = kept(known())
    used = of.select("conv_id", F.col("call_id").alias("used"), F.col("anchor").alias("used_anchor"))
    full = odd.join(of, key, "left").join(used, ["conv_id", "used"], "left").where("anchor IS NOT NULL OR used_anchor IS NOT NULL")
    anchor, used_anchor = F.coalesce("anchor", "at"), F.coalesce("used_anchor", "used_at")
    tight = kept(full.select(*key, "used", anchor.alias("anchor"), used_anchor.alias("used_anchor")).where("anchor = used_anchor"))
    todo = kept(tight.select(*key, "anchor").union(tight.select("conv_id", "used", "used_anchor")).distinct())
    done, depth = [], 0
    while True:
        waits = tight.join(todo.select("conv_id", F.col("call_id").alias("used")), ["conv_id", "used"]).select(*key).distinct()
        free = kept(todo.join(waits, key, "left_anti").withColumn("depth", F.lit(depth)))
        if free.isEmpty():
            done.append(todo.withColumn("depth", F.lit(-1)))
            return reduce(DataFrame.unionByName, done)
        done.append(free)
        if len(done) > FOLD:
            done = [kept(reduce(DataFrame.unionByName, done))]
        todo = kept(todo.join(free.select(*key), key, "left_anti"))
        depth += 1


def positions(calls: DataFrame) -> DataFrame:
    """Each call with ``position`` (from 0) in its conversation and its ``depth`` (see ``anchors``).

    Calls are counted by anchor, and by ranges of turns and places within one; ranks within such small groups and sums
    of the counts before them, by anchor and by range of anchors, make positions. So neither a conversation nor an
    anchor of any size is one window of rows.
    """
    of = anchors(calls).select("conv_id", "call_id", F.col("anchor").alias("__anchor"), F.col("depth").alias("__depth"))
    ordered = calls.join(of.hint("shuffle_hash"), ["conv_id", "call_id"], "left")
    ordered = ordered.withColumns({"depth": F.coalesce("__depth", F.lit(0)), "__t": F.coalesce("__anchor.turn", "turn"), "__p": F.coalesce("__anchor.place", "place")}).drop("__anchor", "__depth")
    cut = lambda c: F.floor(F.col(c) / TURNS_BY_RANGE)
    ordered = ordered.withColumns({"__r": cut("__t"), "__stuck": F.col("depth") < 0, "__tr": cut("turn"), "__pr": cut("place")})
    whole = ["conv_id", "__r", "__t", "__p", "__stuck", "depth", "__tr", "__pr"]
    counts = ordered.groupBy(*whole).agg(F.count("*").alias("n"))
    before = lambda by, then: F.coalesce(F.sum("n").over(Window.partitionBy(*by).orderBy(*then).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    ranges = counts.groupBy("conv_id", "__r").agg(F.sum("n").alias("n"))
    ranges = ranges.select("conv_id", "__r", before(["conv_id"], ["__r"]).alias("__before"))
    groups = counts.select(*whole, before(["conv_id", "__r"], whole[2:]).alias("__inside"))
    groups = groups.alias("g").join(ranges.alias("b"), reduce(and_, [F.col(f"g.{c}").eqNullSafe(F.col(f"b.{c}")) for c in ("conv_id", "__r")])).select(*[F.col(f"g.{c}").alias(f"{c}_g") for c in whole], (F.col("__before") + F.col("__inside")).alias("__start"))
    ranked = ordered.withColumn("__rank", F.row_number().over(Window.partitionBy(*whole).orderBy("turn", "place", "call_id")))
    out = ranked.join(groups.hint("shuffle_hash"), reduce(and_, [F.col(c).eqNullSafe(F.col(f"{c}_g")) for c in whole]))
    return out.select(*calls.columns, "depth", (F.col("__start") + F.col("__rank") - 1).cast("long").alias("position"))


def formatted(messages: DataFrame, calls: DataFrame, results: DataFrame, tools: dict[str, Tool]) -> DataFrame:
    """One row for each plain message, call and result not in a call: conv_id, turn, place, kind, position, status, json.

    ``calls``: conv_id, turn, place, call_id, name, arguments (JSON text), after (ids); ``results``: conv_id, turn,
    place, call_id, content. ``status`` of a call: ``ok``, ``no result``, ``repeated id``, ``circle`` or what is wrong
    with its arguments, the worst first; a result that no call claims is an ``orphan``, one after the first of a
    claimed id a ``repeated result``. Positions count a conversation's calls. Null ids never match; null texts and contents are JSON nulls left out; repeated rows stay
    row by row; empty tables give an empty result; other columns aren't read.
    """
    calls, results = (kept(x.withColumn("__row", F.monotonically_increasing_id())) for x in (calls, results))
    linked = positions(links(calls, results))
    bad = problem(F.col("name"), F.col("arguments"), tools)
    status = F.when(bad.isNotNull(), bad).when(F.col("depth") < 0, "circle").when(F.col("copies") > 1, "repeated id").when(F.col("n_results") == 0, "no result").otherwise("ok")
    text = F.to_json(F.struct(F.try_parse_json("arguments").alias("arguments"), F.col("call_id").alias("id"), "name", F.col("content").alias("result"), F.lit("call").alias("role")))
    out = linked.select("conv_id", "turn", "place", F.lit("call").alias("kind"), "position", status.alias("status"), text.alias("json"))
    none = F.lit(None).cast("long")
    claimed = calls.select("conv_id", "call_id").distinct().join(firsts(results), ["conv_id", "call_id"]).select("conv_id", "call_id", F.col("first.__row").alias("taken"))
    others = results.join(claimed, ["conv_id", "call_id"], "left").where("taken IS NULL OR taken <> __row")
    why = F.when(F.col("taken").isNull(), "orphan").otherwise("repeated result")
    out = out.union(others.select("conv_id", "turn", "place", F.lit("result"), none, why, F.to_json(F.struct(F.col("content"), F.col("call_id").alias("id"), F.lit("result").alias("role")))))
    return out.union(messages.select("conv_id", "turn", F.lit(0), F.lit("message"), none, F.lit("ok"), F.to_json(F.struct(F.col("text").alias("content"), "role"))))


#: The registered query takes every user's turn as a call of this tool and the turn after it as its result.
REPLY = {"reply": Tool({"prompt": "string", "turn": "integer"}, ("prompt", "turn"))}


def exchanges(messages: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Messages of other roles; users' turns as calls; assistants' turns as results of the turn before.

    A call uses the call before it (two turns back), with these exceptions, by conversation and turn, so that every part
    of the method has work: where conv_id % 5 is 1, every fourth call (turn div 2 % 4 = 0) uses the call after it, which
    then uses none (out of the text's order), and where it is 2, the call after it still uses the one before (a circle). Where
    (conv_id + turn) % 10 is 4 the argument ``turn`` is text, where it is 7 ``prompt`` is left out (both against the
    schema).
    """
    name = lambda turn: F.concat(F.col("conv_id").cast("string"), F.lit("-"), turn.cast("string"))
    turn, odd, wrong = F.col("turn"), F.pmod("conv_id", F.lit(5)), F.pmod(F.col("conv_id") + F.col("turn"), F.lit(10))
    fourth = F.floor(turn / 2) % 4
    after = F.when(odd.isin(1, 2) & (fourth == 0), F.array(name(turn + 2))).when((odd == 1) & (fourth == 1), F.array().cast("array<string>")).otherwise(F.array(name(turn - 2)))
    plain = F.to_json(F.struct(turn, F.col("text").alias("prompt")))
    arguments = F.when(wrong == 4, F.to_json(F.struct(turn.cast("string").alias("turn"), F.col("text").alias("prompt")))).when(wrong == 7, F.to_json(F.struct(turn))).otherwise(plain)
    calls = messages.where("role = 'user'").select("conv_id", "turn", F.lit(0).alias("place"), name(turn).alias("call_id"), F.lit("reply").alias("name"), arguments.alias("arguments"), after.alias("after"))
    results = messages.where("role = 'assistant'").select("conv_id", "turn", F.lit(0).alias("place"), name(turn - 1).alias("call_id"), F.col("text").alias("content"))
    return messages.where("coalesce(role, '') NOT IN ('user', 'assistant')"), calls, results


ORACLE = """
WITH m AS (SELECT conv_id, turn, role, text FROM conversations),
r AS (SELECT conv_id, turn - 1 AS asked, text FROM m WHERE role = 'assistant'),
k AS (SELECT conv_id, turn, text, conv_id % 5 AS odd, (conv_id + turn) % 10 AS wrong, turn // 2 % 4 AS fourth FROM m WHERE role = 'user'),
l AS (SELECT a.*, (a.odd IN (1, 2) AND a.fourth = 0 AND b.turn IS NOT NULL) AS late, (a.odd = 2 AND a.fourth = 0 AND b.turn IS NOT NULL) OR (a.odd = 2 AND a.fourth = 1 AND p.turn IS NOT NULL) AS circle
  FROM k a LEFT JOIN k b ON b.conv_id = a.conv_id AND b.turn = a.turn + 2 LEFT JOIN k p ON p.conv_id = a.conv_id AND p.turn = a.turn - 2),
c AS (
  SELECT m.conv_id, m.turn, 'call' AS kind,
         row_number() OVER (PARTITION BY m.conv_id ORDER BY CASE WHEN late THEN m.turn + 2 ELSE m.turn END, circle, late AND NOT circle, m.turn) - 1 AS position,
         CASE WHEN wrong = 4 THEN 'turn is no integer' WHEN wrong = 7 THEN 'missing prompt' WHEN circle THEN 'circle' WHEN r.asked IS NULL THEN 'no result' ELSE 'ok' END AS status,
         '{"arguments":' || CASE wrong WHEN 4 THEN json_object('prompt', m.text, 'turn', CAST(m.turn AS VARCHAR)) WHEN 7 THEN json_object('turn', m.turn) ELSE json_object('prompt', m.text, 'turn', m.turn) END
           || ',"id":"' || m.conv_id || '-' || m.turn || '","name":"reply"' || CASE WHEN r.asked IS NULL THEN '' ELSE ',"result":' || to_json(r.text) END || ',"role":"call"}' AS json
  FROM l m LEFT JOIN r ON r.conv_id = m.conv_id AND r.asked = m.turn
)
SELECT conv_id, turn, 0 AS place, kind, position, status, json FROM c
UNION ALL
SELECT conv_id, turn, 0, 'result', NULL, 'orphan', '{"content":' || to_json(text) || ',"id":"' || conv_id || '-' || (turn - 1) || '","role":"result"}'
FROM m WHERE role = 'assistant' AND NOT EXISTS (SELECT 1 FROM c WHERE c.conv_id = m.conv_id AND c.turn = m.turn - 1)
UNION ALL
SELECT conv_id, turn, 0, 'message', NULL, 'ok', '{"content":' || to_json(text) || ',"role":"' || role || '"}' FROM m WHERE role NOT IN ('user', 'assistant')
"""
