"""Link tool calls to their results, order and check them, and write them as canonical JSON.

DataFrame operations only. Calls are ``(conv_id, turn, call_id, name, arguments, after)``, results
``(conv_id, turn, call_id, content)``: arguments are JSON text, ``after`` lists the calls whose results
a call needs. JSON is held as variant values, whose objects have sorted keys.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from pulsegrid.session import cut

KEY = ["conv_id", "call_id"]
BUCKET = 1000  #: turns of a conversation, and levels of calls, that are ranked by one task
HASH = "shuffle_hash"  #: joins by identifier build a hash table per partition of the side named
CALL_SHAPE = "tool_calls array<struct<id: string, name: string, arguments: string, after: array<string>>>"
RESULT_SHAPE = "tool_call_id string, content string"


def schemas_table(spark: SparkSession, tools: Iterable[tuple[str, str, str, bool]]) -> DataFrame:
    """``(name, parameter, type, required)``, types as in JSON schema."""
    return spark.createDataFrame(list(tools), "name string, parameter string, type string, required boolean")


def _read(role: str, shape: str) -> Column:
    """The turn's text read as a message of ``role``; null for other turns."""
    fits = (F.col("role") == role) & F.col("text").startswith("{")
    return F.when(fits, F.from_json("text", shape))


def _has_calls() -> Column:
    """Whether a turn is an assistant's message that holds a call with an identifier."""
    calls = _read("assistant", CALL_SHAPE)["tool_calls"]
    return F.coalesce(F.exists(calls, lambda call: call["id"].isNotNull()), F.lit(False))


def tool_messages(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Calls and results written in ``turns (conv_id, turn, role, text)`` as JSON messages.

    Assistant turns like ``{"tool_calls": [{"id": ..., "name": ..., "arguments": {...}}]}``, tool turns
    like ``{"tool_call_id": ..., "content": ...}``. Other turns, and text that is no such JSON, give none.
    """
    said = lambda role, shape: turns.select("conv_id", "turn", _read(role, shape).alias("said"))
    calls = said("assistant", CALL_SHAPE).select("conv_id", "turn", F.explode("said.tool_calls").alias("call"))
    results = said("tool", RESULT_SHAPE).filter("said.tool_call_id IS NOT NULL")
    return (
        calls.select("conv_id", "turn", F.col("call.id").alias("call_id"), "call.name", "call.arguments",
                     F.coalesce("call.after", F.expr("CAST(array() AS array<string>)")).alias("after")),
        results.select("conv_id", "turn", F.col("said.tool_call_id").alias("call_id"), "said.content"),
    )


def turn_pairs(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Plain turns as calls: a user's turn asks the tool ``reply``, the assistant's next turn answers.

    A request needs the answer to the request two turns before, if there is one. Every turn of the
    two counts, whatever its text, but for an assistant's messages that hold calls.
    """
    name = lambda turn: F.concat_ws(":", F.col("conv_id").cast("string"), turn.cast("string"))
    turn, text = F.col("turn"), F.col("text")
    plain = turns.filter("turn IS NOT NULL")
    asked = plain.filter("role = 'user'")
    before = asked.select("conv_id", (turn + 2).alias("turn"), name(turn).alias("earlier")).distinct()
    calls = asked.join(before.hint(HASH), ["conv_id", "turn"], "left").select(
        "conv_id", "turn", name(turn).alias("call_id"), F.lit("reply").alias("name"),
        F.to_json(F.struct(text.alias("request"))).alias("arguments"),
        F.filter(F.array("earlier"), lambda x: x.isNotNull()).alias("after"),
    )
    answers = plain.filter((F.col("role") == "assistant") & ~_has_calls()).select(
        "conv_id", "turn", name(turn - 1).alias("call_id"), text.alias("content")
    )
    return calls, answers


def _kind(value: Column) -> Column:
    """The JSON type of a variant."""
    found = F.schema_of_variant(value)
    return (
        F.when(found == "BIGINT", "integer")
        .when(found == "STRING", "string")
        .when(found == "BOOLEAN", "boolean")
        .when(found == "VOID", "null")
        .when(found.startswith("ARRAY"), "array")
        .when(found.startswith("OBJECT"), "object")
        .otherwise("number")
    )


def _faults(tools: DataFrame) -> tuple[DataFrame, Column]:
    """Tools with their parameters on one row, and what is wrong with ``given`` for them."""
    known = tools.groupBy(F.col("name").alias("tool")).agg(
        F.map_from_entries(F.array_sort(F.collect_set(F.struct("parameter", "type")))).alias("types"),
        F.array_sort(F.collect_set(F.when(F.col("required"), F.col("parameter")))).alias("needed"),
    )
    given, types = F.col("given"), F.col("types")
    names = F.map_keys(given)
    missing = F.transform(F.array_except("needed", names), lambda p: F.concat(F.lit("missing "), p))
    unknown = F.transform(F.array_except(names, F.map_keys(types)), lambda p: F.concat(F.lit("unknown "), p))
    wrong = F.filter(
        F.map_entries(given),
        lambda e: F.map_contains_key(types, e["key"])
        & (_kind(e["value"]) != types[e["key"]])
        & ~((types[e["key"]] == "number") & (_kind(e["value"]) == "integer")),
    )
    typed = F.transform(wrong, lambda e: F.concat(F.lit("type of "), e["key"]))
    none = F.expr("CAST(array() AS array<string>)")
    return known, F.when(types.isNull(), F.array(F.lit("unknown tool"))).when(
        given.isNull(), F.array(F.lit("arguments are no object"))
    ).otherwise(F.coalesce(F.array_sort(F.concat(missing, unknown, typed)), none))


def _roots(single: DataFrame) -> DataFrame:
    """``(conv_id, call_id, root, steps)``: the first call up a chain that is not in ``single``.

    ``single (conv_id, call_id, need)`` has calls with one need. All go up twice as far each round, so
    rounds are as many as the logarithm of the longest chain. Calls on a cycle, or below one, are
    those left when a round brings no call to its root; they are dropped.
    """
    current = cut(single.select(*KEY, F.col("need").alias("root"), F.lit(1).alias("steps")))
    left = None
    while True:
        above = current.select(
            "conv_id", F.col("call_id").alias("root"), F.col("root").alias("higher"),
            F.col("steps").alias("more"),
        )
        moved = current.join(above.hint(HASH), ["conv_id", "root"], "left").select(
            *KEY,
            F.coalesce("higher", "root").alias("root"),
            (F.col("steps") + F.coalesce("more", F.lit(0))).alias("steps"),
            F.col("higher").isNull().alias("there"),
        )
        moved = cut(moved)
        waiting = moved.filter("NOT there").count()
        if waiting in (0, left):
            return moved.filter("there").drop("there")
        current, left = moved.drop("there"), waiting


def levels(calls: DataFrame) -> DataFrame:
    """``(conv_id, call_id, level)``: how many calls must come before, one after another.

    Level 0 needs no call that exists. Chains of calls with one need each are followed by doubling;
    the rest goes level by level, in as many rounds as calls with several needs follow each other.
    Rounds are written to the shared folder. Calls on a cycle, or that need one, are left out.
    """
    ids = calls.select(*KEY)
    needs = cut(
        calls.select(*KEY, F.explode(F.array_distinct("after")).alias("need")).join(
            ids.select("conv_id", F.col("call_id").alias("need")).hint(HASH), ["conv_id", "need"], "left_semi"
        )
    )
    degrees = needs.groupBy(*KEY).agg(F.count("*").alias("degree"))
    chains = cut(_roots(needs.join(degrees.filter("degree = 1").hint(HASH), KEY, "left_semi")))
    known = ids.join(needs.hint(HASH), KEY, "left_anti").withColumn("level", F.lit(0))
    up = chains.select("conv_id", F.col("call_id").alias("need"), "root", "steps")
    open_needs = cut(
        needs.join(degrees.filter("degree > 1").hint(HASH), KEY, "left_semi")
        .join(up.hint(HASH), ["conv_id", "need"], "left")
        .select(*KEY, F.coalesce("root", "need").alias("root"), F.coalesce("steps", F.lit(0)).alias("steps"),
                F.lit(None).cast("int").alias("level"))
    )
    ready, roots = known, [known]
    while not open_needs.isEmpty():
        new = ready.select("conv_id", F.col("call_id").alias("root"), F.col("level").alias("found"))
        open_needs = cut(
            open_needs.join(new.hint(HASH), ["conv_id", "root"], "left").select(
                *KEY, "root", "steps", F.coalesce("level", "found").alias("level")
            )
        )
        met = open_needs.groupBy(*KEY).agg(
            F.count("*").alias("all"), F.count("level").alias("met"),
            (F.max(F.col("level") + F.col("steps")) + 1).alias("level"),
        )
        ready = cut(met.filter("all = met").select(*KEY, "level"))
        if ready.isEmpty():
            break
        roots.append(ready)
        open_needs = cut(open_needs.join(ready.hint(HASH), KEY, "left_anti"))
    top = roots[0]
    for rows in roots[1:]:
        top = top.unionByName(rows)
    starts = top.select("conv_id", F.col("call_id").alias("root"), F.col("level").alias("start"))
    below = chains.join(starts.hint(HASH), ["conv_id", "root"]).select(
        *KEY, (F.col("start") + F.col("steps")).alias("level")
    )
    return top.unionByName(below)


def _starts(sizes: DataFrame) -> DataFrame:
    """``(conv_id, level, bucket, start)``: calls of a conversation before those of each row of ``sizes``.

    Levels are summed by BUCKET first, and blocks of levels by as many blocks again: a chain of a billion
    calls gives no task more than a thousand blocks of blocks.
    """
    before = lambda *by: Window.partitionBy("conv_id", *by[:-1]).orderBy(*by[-1]).rowsBetween(
        Window.unboundedPreceding, -1
    )
    blocks = sizes.withColumn("block", F.floor(F.col("level") / BUCKET)).withColumn(
        "part", F.floor(F.col("level") / BUCKET**2)
    )
    total = F.sum("size").alias("size")
    parts = blocks.groupBy("conv_id", "part").agg(total)
    whole = parts.withColumn("parts_before", F.sum("size").over(before(["part"]))).drop("size")
    inner = blocks.groupBy("conv_id", "part", "block").agg(total)
    inside = inner.withColumn("blocks_before", F.sum("size").over(before("part", ["block"]))).drop("size")
    within = blocks.withColumn("rows_before", F.sum("size").over(before("block", ["level", "bucket"])))
    none = lambda name: F.coalesce(name, F.lit(0))
    return (
        within.join(inside.hint(HASH), ["conv_id", "part", "block"])
        .join(whole.hint(HASH), ["conv_id", "part"])
        .select(
            "conv_id", "level", "bucket",
            (none("parts_before") + none("blocks_before") + none("rows_before")).alias("start"),
        )
    )


def link(calls: DataFrame, results: DataFrame, tools: DataFrame) -> DataFrame:
    """A row per call: conv_id, call_id, turn, level, position, status, faults, n_results, message.

    Calls and results are joined by conversation and identifier. Of several calls with one
    identifier that of the earliest turn counts (on a tie, the smallest name and arguments), of
    several results the earliest (then the smallest); n_results tells how many there were. Rows with
    a null conversation or identifier are left out, as nothing can refer to them; repeated rows
    count once. ``position`` numbers a conversation's calls from 1 so that each stands after those
    it needs, by level, turn and identifier; it is null, as the level, on a cycle.

    Joins by identifier are hash joins of both sides' shuffled partitions. Arguments beyond the size that a
    variant can hold (some 128 MB) count as no JSON.

    status, the first that fits: ``cycle``, ``invalid`` (arguments against ``tools``, see faults),
    ``no result``, ``unmet`` (needs a call that is not there) or ``ok``. ``message`` is JSON without
    blanks and with sorted keys; arguments that are no JSON are null, null fields are left out.
    """
    named = F.col("conv_id").isNotNull() & F.col("call_id").isNotNull()
    first = F.min_by(F.struct("turn", "name", "arguments", "after"), F.struct("turn", "name", "arguments"))
    one = cut(calls.filter(named).groupBy(*KEY).agg(first.alias("call")).select(*KEY, "call.*"))
    answered = (
        results.filter(named)
        .distinct()
        .groupBy(*KEY)
        .agg(
            F.min_by(F.struct(F.col("content").alias("result")), F.struct("turn", "content")).alias("answer"),
            F.count("*").alias("n_results"),
        )
    )
    needs = one.select(*KEY, F.explode("after").alias("need"))
    unmet = (
        needs.join(one.select("conv_id", F.col("call_id").alias("need")).hint(HASH), ["conv_id", "need"], "left_anti")
        .select(*KEY)
        .distinct()
        .withColumn("unmet", F.lit(True))
    )
    known, faults = _faults(tools)
    parsed = F.try_parse_json(F.col("arguments"))
    is_object = F.schema_of_variant(parsed).startswith("OBJECT")
    given = F.when(is_object, parsed).try_cast("map<string, variant>")
    checked = (
        one.join(known, one["name"] == known["tool"], "left")
        .withColumn("given", given)
        .withColumn("faults", faults)
        .withColumn("parsed", parsed)
        .drop("types", "needed", "tool", "given")
    )
    linked = (
        checked.join(levels(one).hint(HASH), KEY, "left")
        .join(answered.hint(HASH), KEY, "left")
        .join(unmet.hint(HASH), KEY, "left")
    )
    status = (
        F.when(F.col("level").isNull(), "cycle")
        .when(F.size("faults") > 0, "invalid")
        .when(F.col("n_results").isNull(), "no result")
        .when(F.col("unmet"), "unmet")
        .otherwise("ok")
    )
    message = F.to_json(
        F.struct(
            F.col("after"), F.col("parsed").alias("arguments"), F.col("call_id").alias("id"), F.col("name"),
            F.col("answer.result").alias("result"),
        )
    )
    rows = linked.withColumn("status", status).withColumn("message", message)
    bucket = F.floor(F.coalesce("turn", F.lit(0)) / BUCKET)
    rows = cut(
        rows.withColumn("bucket", bucket).select(
            *KEY, "turn", "level", "bucket", "status", "faults",
            F.coalesce("n_results", F.lit(0)).cast("long").alias("n_results"), "message",
        )
    )
    within = Window.partitionBy("conv_id", "level", "bucket").orderBy("turn", "call_id")
    place = ["conv_id", "level", "bucket"]
    sizes = rows.filter("level IS NOT NULL").groupBy(*place).agg(F.count("*").alias("size"))
    return (
        rows.withColumn("rank", F.row_number().over(within))
        .join(_starts(sizes).hint(HASH), place, "left")
        .select(*KEY, "turn", "level", (F.col("start") + F.col("rank")).alias("position"), "status",
                F.concat_ws(",", "faults").alias("faults"), "n_results", "message")
    )
