"""JSON encode / decode of topic values."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.schemas import EVENT_TIME_FORMAT

# Topic payloads carry times as SQL text with milliseconds, UTC.
JSON_OPTIONS = {"timestampFormat": EVENT_TIME_FORMAT, "timestampNTZFormat": EVENT_TIME_FORMAT}


def json_value(*cols) -> Column:
    """Columns -> UTF-8 JSON bytes (a topic ``value``)."""
    return F.to_json(F.struct(*cols), JSON_OPTIONS).cast("binary")


def parse_json_value(col, schema: T.StructType) -> Column:
    """Topic ``value`` -> struct by a declared schema.  Missing fields
    become null; a malformed record stops the job (FAILFAST, the declared-
    topic default, D5)."""
    c = F.col(col) if isinstance(col, str) else col
    options = dict(JSON_OPTIONS)
    options["mode"] = "FAILFAST"
    return F.from_json(c.cast("string"), schema, options)


def _field(value: Column, path: str, kind: T.DataType) -> Column:
    if isinstance(kind, T.StructType):
        return F.struct(*[_field(value, f"{path}['{f.name}']", f.dataType).alias(f.name) for f in kind.fields])
    return F.try_variant_get(value, path, kind.simpleString())


def parse_json_or_skip(df: DataFrame, col: str, schema: T.StructType, keep=()) -> DataFrame:
    """P14 with D5 ``skip``: records that are not a JSON object (or are null)
    are dropped, and no others: a field that is missing or of another type
    than declared is null, and the rest of its record stays.

    A record whose declared fields are all there and of their types, nearly
    every one, is parsed once, by the declared schema.  Parsing it as the one
    element of an array makes sure that nothing follows the object.  Only the
    others (a field that is null, missing or of another type) are parsed
    again, as a variant, which tells them from text that is no JSON.  The
    one-element arrays under generators keep later projections and filters
    from repeating a parse.  ``keep`` columns of ``df`` are carried.
    """
    text = F.col(col).cast("string")
    # An object begins and ends with braces; other text isn't parsed at all.
    bare = F.btrim(text, F.lit(" \t\r\n"))
    object_text = F.filter(F.array(text), lambda t: bare.startswith("{") & bare.endswith("}"))
    candidates = df.select(*keep, F.explode(object_text).alias("_t"))
    options = {"allowSingleQuotes": "false", "allowNonNumericNumbers": "false"}
    array_text = F.concat(F.lit("["), F.col("_t"), F.lit("]"))
    alone = F.from_json(array_text, T.ArrayType(schema), options)
    read = candidates.select(*keep, "_t", F.explode(F.array(F.struct(alone.alias("a")))).alias("_r")).select(
        *keep, "_t", (F.size("_r.a") == 1).alias("_one"), F.try_element_at("_r.a", F.lit(1)).alias("_o")
    )
    whole = F.coalesce(F.col("_one") & _all_there(F.col("_o"), schema), F.lit(False))
    again = F.when(~F.col("_whole"), F.try_parse_json(array_text))
    ok = F.filter(F.array(again), lambda v: F.col("_whole") | (v.isNotNull() & F.try_variant_get(v, "$[1]", "variant").isNull()))
    return read.select(*keep, "_t", "_o", whole.alias("_whole")).select(*keep, "_o", "_whole", F.explode(ok).alias("_v")).select(
        *keep,
        *[
            F.when(F.col("_whole"), F.col("_o").getField(f.name)).otherwise(_field(F.col("_v"), f"$[0]['{f.name}']", f.dataType)).alias(f.name)
            for f in schema.fields
        ],
    )


def _all_there(value: Column, schema: T.StructType) -> Column:
    """No declared field, nested ones too, is null."""
    there = value.isNotNull()
    for f in schema.fields:
        own = value.getField(f.name)
        there = there & (_all_there(own, f.dataType) if isinstance(f.dataType, T.StructType) else own.isNotNull())
    return there
