"""JSON envelopes {"schema": .., "payload": ..}, read by the schema that they carry themselves.

A schema has a ``type`` (boolean, int8 to int64, float, double, string, bytes, array, map, struct), and may
be ``optional``, have a ``default`` and a ``name``. Names that end in Decimal, Date or Timestamp say what a number or
bytes stand for: an unscaled number of a stated ``scale`` in base64, days, and milliseconds since 1970.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import convert

#: Types of the envelope and of Spark (fixed values).
PLAIN = {
    "boolean": T.BooleanType(), "int8": T.ByteType(), "int16": T.ShortType(), "int32": T.IntegerType(), "int64": T.LongType(),
    "float": T.FloatType(), "double": T.DoubleType(), "string": T.StringType(), "bytes": T.BinaryType(),
}
NAMES = {v.simpleString(): k for k, v in PLAIN.items()}


class BadEnvelope(ValueError):
    """A schema document that can't be understood, or rows that don't share one."""


def _logical(schema: dict) -> str:
    return (schema.get("name") or "").rpartition(".")[2]


def spark_type(schema: dict) -> T.DataType:
    """The type that a schema document stands for."""
    kind, name = schema.get("type"), _logical(schema)
    if kind == "bytes" and name == "Decimal":
        return T.DecimalType(38, int(schema["parameters"]["scale"]))
    if (kind, name) in (("int32", "Date"), ("int64", "Timestamp")):
        return T.DateType() if name == "Date" else T.TimestampType()
    if kind in PLAIN:
        return PLAIN[kind]
    if kind == "array":
        return T.ArrayType(spark_type(schema["items"]))
    if kind == "map":
        return T.MapType(spark_type(schema["keys"]), spark_type(schema["values"]))
    if kind == "struct":
        return T.StructType([T.StructField(f["field"], spark_type(f)) for f in schema["fields"]])
    raise BadEnvelope(f"no such type: {kind}")


def _read_type(schema: dict) -> T.DataType:
    """How the payload is read as JSON."""
    kind, name = schema["type"], _logical(schema)
    if kind == "bytes":
        return T.StringType()
    if kind == "array":
        return T.ArrayType(_read_type(schema["items"]))
    if kind == "map":  # keys that are no strings come as pairs
        return T.MapType(T.StringType(), _read_type(schema["values"])) if schema["keys"]["type"] == "string" else T.ArrayType(T.ArrayType(T.StringType()))
    if kind == "struct":
        return T.StructType([T.StructField(f["field"], _read_type(f)) for f in schema["fields"]])
    return T.IntegerType() if name == "Date" else T.LongType() if name == "Timestamp" else PLAIN[kind]


def _value(column: Column, schema: dict, path: str) -> Column:
    """The value of a column that was read as ``_read_type`` says; a null gets its default, or fails where it may not be."""
    kind, name = schema["type"], _logical(schema)
    out = column
    if kind == "bytes":
        out = convert.decimal_from_base64(column, int(schema["parameters"]["scale"])) if name == "Decimal" else F.unbase64(column)
    elif name == "Date":
        out = F.date_add(F.lit("1970-01-01").cast("date"), column)
    elif name == "Timestamp":
        out = F.timestamp_millis(column)
    elif kind == "array":
        out = F.transform(column, lambda x: _value(x, schema["items"], f"{path}[]"))
    elif kind == "map" and schema["keys"]["type"] == "string":
        out = F.transform_values(column, lambda _, v: _value(v, schema["values"], f"{path}{{}}"))
    elif kind == "map":
        pair = lambda p: F.struct(p[0].cast(spark_type(schema["keys"])).alias("key"), p[1].cast(spark_type(schema["values"])).alias("value"))
        out = F.map_from_entries(F.transform(column, pair))
    elif kind == "struct":
        out = F.when(column.isNotNull(), F.struct(*[_value(column.getField(f["field"]), f, f"{path}.{f['field']}").alias(f["field"]) for f in schema["fields"]]))
    if schema.get("default") is not None:
        default = F.from_json(F.lit(json.dumps({"d": schema["default"]})), T.StructType([T.StructField("d", _read_type(schema))]))["d"]
        return F.coalesce(out, _value(default, schema | {"default": None, "optional": True}, path))
    if schema.get("optional"):
        return out
    return F.coalesce(out, F.raise_error(F.concat(F.lit(f"null for the required field {path}"))).cast(spark_type(schema)))


def schema_of(df: DataFrame, column: str) -> dict | None:
    """The schema document that the envelopes in a column share; None if there is none."""
    found = df.select(F.get_json_object(F.col(column).cast("string"), "$.schema").alias("s")).filter(F.col("s").isNotNull()).distinct().limit(2).collect()
    if len(found) > 1:
        raise BadEnvelope(f"the envelopes of {column} have different schemas")
    return json.loads(found[0].s) if found else None


def payload(column: Column, schema: dict) -> Column:
    """The payload of envelopes with this schema, as its type; a null payload is null where the schema lets it be."""
    spark_type(schema)  # says early what isn't understood
    text = F.get_json_object(column.cast("string"), "$.payload")
    wrapped = F.concat(F.lit('{"d":'), F.when(F.lit(schema["type"] == "string" or _read_type(schema) == T.StringType()) & text.isNotNull(), F.to_json(F.array(text)).substr(F.lit(2), F.length(F.to_json(F.array(text))) - 2)).otherwise(text), F.lit("}"))
    read = F.from_json(F.coalesce(wrapped, F.lit("{}")), T.StructType([T.StructField("d", _read_type(schema))]))["d"]
    return F.when(column.isNotNull(), F.transform(F.array(read), lambda r: _value(r, schema, "payload"))[0])


def from_envelopes(df: DataFrame, column: str, schema: dict | None = None) -> DataFrame:
    """``df`` with the payloads in place of the envelopes; their schema is read from the rows if it isn't given."""
    schema = schema or schema_of(df, column)
    return df if schema is None else df.withColumn(column, payload(F.col(column), schema))


def schema_for(kind: T.DataType, nullable: bool = True, names: str = "") -> dict:
    """The schema document for a type; ``names`` comes before Decimal, Date and Timestamp."""
    extra = {"optional": nullable}
    if isinstance(kind, T.DecimalType):
        return extra | {"type": "bytes", "name": f"{names}Decimal", "parameters": {"scale": str(kind.scale)}}
    if isinstance(kind, T.DateType):
        return extra | {"type": "int32", "name": f"{names}Date"}
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
        return extra | {"type": "int64", "name": f"{names}Timestamp"}
    if isinstance(kind, T.ArrayType):
        return extra | {"type": "array", "items": schema_for(kind.elementType, kind.containsNull, names)}
    if isinstance(kind, T.MapType):
        if not isinstance(kind.keyType, T.StringType):
            raise BadEnvelope("only maps from strings can be written")
        return extra | {"type": "map", "keys": schema_for(kind.keyType, False, names), "values": schema_for(kind.valueType, kind.valueContainsNull, names)}
    if isinstance(kind, T.StructType):
        return extra | {"type": "struct", "fields": [{"field": f.name} | schema_for(f.dataType, f.nullable, names) for f in kind]}
    return extra | {"type": NAMES[kind.simpleString()]}


def _written(column: Column, kind: T.DataType) -> Column:
    if isinstance(kind, T.DecimalType):
        return convert.decimal_to_base64(column, kind.scale)
    if isinstance(kind, T.BinaryType):
        return F.base64(column)
    if isinstance(kind, T.DateType):
        return F.datediff(column, F.lit("1970-01-01").cast("date"))
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
        return F.unix_millis(column.cast("timestamp"))
    if isinstance(kind, T.ArrayType):
        return F.transform(column, lambda x: _written(x, kind.elementType))
    if isinstance(kind, T.MapType):
        return F.transform_values(column, lambda _, v: _written(v, kind.valueType))
    if isinstance(kind, T.StructType):
        return F.when(column.isNotNull(), F.struct(*[_written(column.getField(f.name), f.dataType).alias(f.name) for f in kind]))
    return column


def to_envelopes(df: DataFrame, column: str, names: str = "") -> DataFrame:
    """``df`` with envelopes of the column's values, each with the schema of the column's type."""
    field = df.schema[column]
    document = json.dumps(schema_for(field.dataType, field.nullable, names))
    body = F.to_json(F.struct(_written(F.col(column), field.dataType).alias("payload")), {"ignoreNullFields": "false"})
    return df.withColumn(column, F.concat(F.lit('{"schema":' + document + ","), F.substring(body, 2, 2**31 - 1)))
