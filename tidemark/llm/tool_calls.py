"""Chat formatting: tool calls linked to their results, checked and put out as canonical JSON.

Calls and results meet in a hash join on (conversation, identifier). Calls are ordered
topologically by the identifiers they depend on: a call's level is one more than the highest
level among its dependencies; calls on a cycle, or behind one, have no level. Arguments are
checked against the schema of the called tool: required names, known names, and JSON types.
All steps are DataFrame operations. A conversation is never gathered into one row or task: each
message is a row, ordered within its conversation by (level, position).

Nulls: a call with a null identifier links with nothing and keeps its row; null arguments count
as an empty object, a null name as unknown. Several results with one identifier: the earliest
(position, then content) is linked and ``n_results`` says how many there were. Repeated calls
keep a row each. Results without a call are rows of their own with status ``orphan_result``.
Extra columns are ignored; empty tables give empty results.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm import common

#: How the schema of a variant begins for a JSON value of each type (fixed patterns).
JSON_TYPES = {"string": "STRING", "number": "BIGINT|DECIMAL|DOUBLE", "boolean": "BOOLEAN", "object": "OBJECT", "array": "ARRAY"}


def _chains(single: DataFrame, tmp: common.Scratch) -> DataFrame:
    """Ends of chains of nodes that need one other each: node, end, steps; ``end`` is null on or behind a cycle.

    Pointers double their reach in each round, so a chain costs rounds by the logarithm of its length.
    """
    reach = tmp.stored(single.select("node", F.col("needs").alias("end"), F.lit(1).cast("long").alias("steps"), F.lit(True).alias("moved")), "call-chains")
    most = max(1, reach.count()).bit_length() + 1
    for _ in range(most):
        on = reach.select(F.col("node").alias("end"), F.col("end").alias("further"), F.col("steps").alias("more"))
        longer = tmp.stored(reach.drop("moved").join(on.hint("shuffle_hash"), "end", "left").select("node", F.coalesce("further", "end").alias("end"), (F.col("steps") + F.coalesce("more", F.lit(0))).alias("steps"), F.col("further").isNotNull().alias("moved")), "call-chains")
        tmp.drop(reach)
        reach = longer
        if reach.where("moved").isEmpty():
            break
    return reach.select("node", F.when(~F.col("moved"), F.col("end")).alias("end"), "steps")


def levels(edges: DataFrame) -> DataFrame:
    """Topological levels above 0: node, level, as a written table; nodes on or behind a cycle get null.

    ``edges``: node, needs. Chains of nodes with one need each are cut short first, whatever their
    length; then rounds give a level to the nodes with several needs all of whose needs have one,
    so rounds go by the number of such nodes on a path.
    """
    with common.Scratch() as tmp:
        edges = edges.where(F.col("node").isNotNull() & F.col("needs").isNotNull())
        ends_of = tmp.stored(edges.groupBy("node").agg(F.min("needs").alias("needs"), F.max("needs").alias("other")), "call-ends")
        several = ends_of.where("needs <> other").select("node")
        chains = _chains(ends_of.where("needs = other").select("node", "needs"), tmp)
        if several.isEmpty():
            return common.stored(chains.select("node", F.when(F.col("end").isNotNull(), F.col("steps")).alias("level")), "call-level")
        short = chains.select(F.col("node").alias("needs"), F.col("end"), F.col("steps"), F.lit(True).alias("_c"))
        waits = edges.join(several, "node", "left_semi").distinct().join(short, "needs", "left")
        waits = waits.select("node", F.when(F.col("_c").isNull(), F.col("needs")).otherwise(F.col("end")).alias("end"), (F.coalesce("steps", F.lit(0)) + 1).alias("steps"))
        waits = tmp.stored(waits.join(several.select(F.col("node").alias("end"), F.lit(True).alias("_wait")), "end", "left"), "call-waits")
        known, found = None, several.where("false").withColumn("level", F.lit(0).cast("long"))
        while True:
            base = F.when(F.col("end").isNotNull(), F.when(F.col("_wait").isNull(), F.lit(0)).otherwise(F.col("level")))
            ready = waits.join(found.select(F.col("node").alias("end"), "level"), "end", "left").groupBy("node").agg(F.max(base + F.col("steps")).alias("level"), F.bool_and(base.isNotNull()).alias("all")).where("all").drop("all")
            found = tmp.stored(ready, "call-levels")
            if (n := found.count()) == known:
                break
            known = n
        of_several = several.join(found, "node", "left")
        ends = of_several.select(F.col("node").alias("end"), "level", F.lit(True).alias("_s"))
        of_chains = chains.join(ends, "end", "left").select("node", F.when(F.col("end").isNotNull(), F.when(F.col("_s").isNull(), F.lit(0)).otherwise(F.col("level")) + F.col("steps")).alias("level"))
        return common.stored(of_several.select("node", "level").unionByName(of_chains), "call-level")


def argument_errors(arguments: Column, schema: dict[str, tuple[str, bool]]) -> Column:
    """Names of the arguments that break a schema of ``name: (JSON type, required)``, sorted.

    ``arguments``: JSON text of an object; anything else breaks at ``$``, names given twice and
    texts beyond the size of a variant included. A value must have the JSON type itself: neither
    null nor a number in quotes is a number.
    """
    text = F.coalesce(arguments, F.lit("{}"))
    given, parsed = F.from_json(text, "map<string,string>"), F.try_parse_json(text)
    keys = F.map_keys(given)
    wrong = [F.array_except(keys, F.array(*map(F.lit, sorted(schema)))) if schema else keys]
    for name, (kind, required) in sorted(schema.items()):
        found = F.schema_of_variant(F.try_variant_get(parsed, f"$['{name}']", "variant"))
        bad = ~F.coalesce(found.rlike(rf"\A({JSON_TYPES[kind]})"), F.lit(False))
        bad = F.when(F.array_contains(keys, name), bad).otherwise(F.lit(required))
        wrong.append(F.when(bad, F.array(F.lit(name))).otherwise(F.array().cast("array<string>")))
    return F.when(given.isNull() | parsed.isNull(), F.array(F.lit("$"))).otherwise(F.array_sort(F.array_distinct(F.concat(*wrong))))


def _number(token: Column) -> Column:
    """A JSON number in its one form: digits without needless zeros, an exponent only beyond 40 places."""
    part = lambda k: F.regexp_extract(F.lower(token), r"\A-?([0-9]+)(?:\.([0-9]+))?(?:e([+-]?[0-9]+))?\z", k)
    led = F.ltrim(F.concat(part(1), part(2)), F.lit("0"))
    digits = F.rtrim(led, F.lit("0"))
    power = F.coalesce(part(3).try_cast("int"), F.lit(0)) - F.length(part(2)) + F.length(led) - F.length(digits)
    size = F.length(digits)
    plain = (
        F.when((power >= 0) & (size + power <= 40), F.concat(digits, F.repeat(F.lit("0"), power)))
        .when((power < 0) & (size > -power), F.concat(F.substring(digits, F.lit(1), size + power), F.lit("."), F.substring(digits, size + power + 1, -power)))
        .when((power < 0) & (power >= -40), F.concat(F.lit("0."), F.repeat(F.lit("0"), -power - size), digits))
        .otherwise(F.concat(digits, F.lit("e"), power.cast("string")))
    )
    return F.when(digits == "", "0").otherwise(F.concat(F.when(token.startswith("-"), "-").otherwise(""), plain))


#: Stand for an escaped backslash and an escaped quotation mark; JSON text holds no such character raw.
_HIDDEN = (("\\\\", "\x01"), ('\\"', "\x02"))


def one_number_form(text: Column) -> Column:
    """JSON text whose numbers all have the form of ``_number``; strings are left alone.

    With the escapes hidden, quotation marks part strings from all else, so every second piece is
    outside of strings, and its numbers are runs of their characters.
    """
    hidden = text
    for shown, mark in _HIDDEN:
        hidden = F.replace(hidden, F.lit(shown), F.lit(mark))
    tokens = lambda piece: F.regexp_extract_all(piece, F.lit("[-0-9][0-9.eE+-]*|[^-0-9]+"), F.lit(0))
    numbers = lambda piece: F.array_join(F.transform(tokens(piece), lambda t: F.when(t.rlike("^[-0-9]"), _number(t)).otherwise(t)), "")
    pieces = F.transform(F.split(hidden, '"'), lambda piece, k: F.when((k % 2 == 0) & piece.rlike("[0-9]"), numbers(piece)).otherwise(piece))
    out = F.array_join(pieces, '"')
    for shown, mark in _HIDDEN:
        out = F.replace(out, F.lit(mark), F.lit(shown))
    return F.when(text.rlike("[0-9][.eE]|-0"), out).otherwise(text)


def canonical(text: Column) -> Column:
    """An object's JSON with sorted names at all depths, no spaces, and values of their own types.

    Equal numbers have equal texts (``1``, ``1.0`` and ``0.1e1`` all give ``1``). Where names come twice or the text is beyond the size of a variant, the first level is sorted
    and its values are put out as strings; null for a text that isn't an object.
    """
    given, parsed = F.from_json(text, "map<string,string>"), F.try_parse_json(text)
    alone = lambda e: F.regexp_extract(F.to_json(F.create_map(e["key"], e["value"])), r"(?s)\A.(.*).\z", 1)
    plain = F.concat(F.lit("{"), F.array_join(F.transform(F.array_sort(F.map_entries(given)), alone), ","), F.lit("}"))
    return F.when(given.isNotNull(), F.coalesce(one_number_form(F.to_json(parsed)), plain))


def link(calls: DataFrame, results: DataFrame, schemas: dict[str, dict[str, tuple[str, bool]]]) -> DataFrame:
    """Link, order, check and serialise.

    ``calls``: conv_id, call_id, position, name, arguments (JSON text), needs (array of call_id).
    ``results``: conv_id, call_id, position, content. Gives conv_id, call_id, position, level,
    status (linked, no_result, early_result, orphan_result, invalid_arguments, unknown_tool,
    cyclic), n_results, errors, message (canonical JSON: sorted names, no spaces), as a written table.
    """
    call = calls.select("conv_id", "call_id", "position", "name", "arguments", "needs")
    node = F.struct("conv_id", "call_id")
    known = call.select("conv_id", F.col("call_id").alias("needed")).distinct()
    wants = call.where(F.col("call_id").isNotNull()).select("conv_id", "call_id", F.explode("needs").alias("needed")).join(known.hint("shuffle_hash"), ["conv_id", "needed"], "left_semi")
    ordered = levels(wants.select(node.alias("node"), F.struct("conv_id", F.col("needed").alias("call_id")).alias("needs")))
    found = ordered.select(F.col("node.conv_id").alias("conv_id"), F.col("node.call_id").alias("call_id"), F.coalesce("level", F.lit(-1)).alias("_level"))
    # one row for each identifier on the built sides, so that no hash table holds a group
    first = results.groupBy("conv_id", "call_id").agg(F.min(F.struct("position", "content")).alias("_r"), F.count("*").alias("_n"))
    joined = call.withColumn("_call", F.lit(True)).join(first.hint("shuffle_hash"), ["conv_id", "call_id"], "full_outer").join(found.hint("shuffle_hash"), ["conv_id", "call_id"], "left")
    is_call = F.col("_call").isNotNull()
    errors, unknown = F.array().cast("array<string>"), F.lit(True)
    for name, schema in sorted(schemas.items()):
        errors = F.when(F.col("name") == name, argument_errors(F.col("arguments"), schema)).otherwise(errors)
        unknown = unknown & ~F.coalesce(F.col("name") == name, F.lit(False))
    level = F.when(is_call, F.when(F.col("_level") >= 0, F.col("_level")).when(F.col("_level").isNull(), 0))
    status = (
        F.when(~is_call, "orphan_result")
        .when(unknown, "unknown_tool")
        .when(F.size("errors") > 0, "invalid_arguments")
        .when(F.coalesce(F.col("_level"), F.lit(0)) < 0, "cyclic")
        .when(F.col("_r").isNull(), "no_result")
        .when(F.col("_r.position") < F.col("position"), "early_result")
        .otherwise("linked")
    )
    out = joined.withColumn("errors", F.when(is_call, errors).otherwise(F.array().cast("array<string>")))
    out = out.withColumns({"level": level, "status": status, "n_results": F.coalesce("_n", F.lit(0)), "_args": canonical(F.when(is_call, F.coalesce("arguments", F.lit("{}"))))})
    rest = F.to_json(F.struct(F.col("call_id").alias("id"), "name", F.col("_r.content").alias("result")))
    after = F.when(rest == "{}", "}").otherwise(F.concat(F.lit(","), F.substr(rest, F.lit(2))))
    message = F.when(F.col("_args").isNull(), rest).otherwise(F.concat(F.lit('{"arguments":'), F.col("_args"), after))
    linked = out.select("conv_id", "call_id", F.coalesce("position", "_r.position").alias("position"), F.col("level").cast("int").alias("level"), "status", F.col("n_results").cast("long").alias("n_results"), "errors", message.alias("message"))
    done = common.stored(linked, "linked")
    common.forget(ordered)
    return done
