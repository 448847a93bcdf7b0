"""Decoding and encoding of keys, values and headers by column expressions."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F


def from_json(column: Column, schema: str, envelope: bool = False) -> Column:
    """JSON bytes or text as a struct; with ``envelope`` the text is {"schema": .., "payload": ..}."""
    text = column.cast("string")
    return F.from_json(F.get_json_object(text, "$.payload") if envelope else text, schema)


def to_json(column: Column, schema_json: str | None = None) -> Column:
    """A struct as JSON text, wrapped in an envelope if its schema text is given; null stays null."""
    body = F.to_json(column, {"ignoreNullFields": "false"})
    return body if schema_json is None else F.when(column.isNotNull(), F.concat(F.lit(f'{{"schema":{schema_json},"payload":'), body, F.lit("}")))


def _let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use`` of a value that is worked out once, and stands once in the expression."""
    return F.transform(F.array(value), use)[0]


def decimal_from_base64(text: Column, scale: int) -> Column:
    """A decimal from base64 of its unscaled two's complement of any length; null if 38 digits can't hold it."""

    def unscaled(padded: Column, negative: Column) -> Column:
        words = [F.conv(F.substring(padded, 1 + 8 * k, 8), 16, 10).cast("decimal(38,0)") for k in range(4)]
        value = F.when(negative, words[0] - F.lit(1 << 32)).otherwise(words[0])
        for w in words[1:]:
            value = F.try_add(F.try_multiply(value.cast("decimal(38,0)"), F.lit(1 << 32).cast("decimal(10,0)")), w)
        return value.cast("decimal(38,0)")

    def placed(bare: Column, negative: Column) -> Column:
        digits = F.lpad(bare, F.greatest(F.length(bare), F.lit(scale + 1)), F.lit("0"))
        point = F.length(digits) - scale
        signed = F.concat(F.when(negative, "-").otherwise(""), F.substring(digits, F.lit(1), point), F.lit("."), F.substring(digits, point + 1, F.lit(scale)))
        return signed.try_cast(f"decimal(38,{scale})")

    def of(data: Column) -> Column:
        padded, negative = _padded_hex(data, 32)
        return _let(padded, lambda p: _let(F.abs(unscaled(p, negative)).cast("string"), lambda bare: placed(bare, negative)))

    return _let(F.unbase64(text), of)


def decimal_to_base64(value: Column, scale: int) -> Column:
    """As ``decimal_from_base64`` reads it, in 8 bytes; a larger unscaled value is an error."""
    return F.base64(long_to_bytes((value * F.lit(10**scale)).cast("long")))


def long_from_bytes(data: Column) -> Column:
    """A signed big-endian number of any length; empty, null or what a long can't hold gives null."""
    padded, _ = _padded_hex(data, 16)
    digits = F.when(F.octet_length(data) == 8, F.hex(data)).otherwise(padded)
    return F.conv(digits, 16, -10).cast("long")  # to a negative base: signed


def _padded_hex(data: Column, digits: int) -> tuple[Column, Column]:
    """A big-endian two's complement number in so many hex digits, null if it needs more; and whether it's negative."""
    h = F.hex(data)
    negative = F.substring(h, 1, 1) >= "8"
    bare = F.when(negative, F.regexp_replace(h, "^F+", "")).otherwise(F.regexp_replace(h, "^0+", ""))
    fits = (F.length(bare) < digits) | ((F.length(bare) == digits) & ((F.substring(bare, 1, 1) >= "8") == negative))
    padded = F.when(negative, F.lpad(bare, digits, "F")).otherwise(F.lpad(bare, digits, "0"))
    return F.when((F.length(h) > 0) & fits, padded), negative


#: Flags of a serialised list, and the length that stands for a null entry (fixed values).
CONSTANT_SIZE, VARIABLE_SIZE, NULL_ENTRY = "00", "01", "FFFFFFFF"


def _flagged(data: Column, flag: str, of: str, values: Column, kind: str) -> Column:
    """``values`` of a list whose first byte says that it is one ``of`` this kind; other bytes are an error, null stays null."""
    first = F.hex(F.substring(data, 1, 1))
    wrong = F.raise_error(F.concat(F.lit(f"no list of {of}: it starts with "), first)).cast(kind)
    return F.when(data.isNotNull() & (first != flag), wrong).when(data.isNotNull(), values)


def _number(data: Column, at: Column) -> Column:
    """The four bytes from position ``at``."""
    return F.conv(F.hex(F.substring(data, at, F.lit(4))), 16, 10).cast("long").cast("int")


def _int_hex(value: Column) -> Column:
    return F.lpad(F.hex(value.cast("long")), 8, "0")


def longs_to_bytes(values: Column) -> Column:
    """A list of longs: flag, count and places of nulls, size, then 8 bytes for each that isn't null."""

    def written(all_: Column, places: Column) -> Column:
        body = F.transform(F.filter(all_, lambda v: v.isNotNull()), lambda v: F.lpad(F.hex(v), 16, "0"))
        return F.unhex(F.concat(F.lit(CONSTANT_SIZE), _int_hex(F.size(places)), F.array_join(F.transform(places, _int_hex), ""), _int_hex(F.size(all_)), F.array_join(body, "")))

    places = lambda v: F.filter(F.transform(v, lambda x, i: F.when(x.isNull(), i)), lambda i: i.isNotNull())
    return _let(values, lambda v: F.when(v.isNotNull(), _let(places(v), lambda p: written(v, p))))


def longs_from_bytes(data: Column) -> Column:
    """What ``longs_to_bytes`` wrote, nulls in their places; other bytes are an error."""
    upto = lambda n: F.when(n > 0, F.sequence(F.lit(0), n - 1)).otherwise(F.array().cast("array<int>"))

    def values(d: Column, all_: Column, places: Column) -> Column:
        value = lambda k: long_from_bytes(F.substring(d, 10 + 4 * F.size(places) + 8 * k, F.lit(8)))
        entry = lambda i, v: F.struct(i.alias("i"), v.alias("v"))
        known = F.transform(F.array_except(all_, places), lambda i, k: entry(i, value(k)))
        nulls = F.transform(F.array_intersect(all_, places), lambda i: entry(i, F.lit(None).cast("long")))
        merged = F.transform(F.sort_array(F.concat(known, nulls)), lambda e: e["v"])
        return F.when(F.size(places) == 0, F.transform(all_, value)).otherwise(merged)

    def read(d: Column) -> Column:
        nulls = _let(_number(d, F.lit(2)), lambda m: F.transform(upto(m), lambda k: _number(d, 6 + 4 * k)))
        sized = lambda p: _let(_number(d, 6 + 4 * F.size(p)), upto)
        return _let(nulls, lambda p: _let(sized(p), lambda i: values(d, i, p)))

    return _let(data, lambda d: _flagged(d, CONSTANT_SIZE, "longs", read(d), "array<bigint>"))


def texts_to_bytes(values: Column) -> Column:
    """A list of texts: flag, size, then length and UTF-8 bytes of each, a null by its length alone."""
    entry = lambda v: F.when(v.isNull(), NULL_ENTRY).otherwise(F.concat(_int_hex(F.octet_length(v)), F.hex(v.cast("binary"))))
    written = lambda v: F.unhex(F.concat(F.lit(VARIABLE_SIZE), _int_hex(F.size(v)), F.array_join(F.transform(v, entry), "")))
    return _let(values, lambda v: F.when(v.isNotNull(), written(v)))


def texts_from_bytes(data: Column) -> Column:
    """What ``texts_to_bytes`` wrote; other bytes are an error."""
    none = F.array().cast("array<string>")

    def read(d: Column) -> Column:
        def take(so_far: Column, _: Column) -> Column:
            at = so_far["at"]
            text = lambda n: F.substring(d, at + 4, n).cast("string")
            after = lambda n: F.struct((at + 4 + F.coalesce(n, F.lit(0))).alias("at"), F.concat(so_far["out"], F.array(text(n))).alias("out"))
            length = lambda h: F.when(h != NULL_ENTRY, F.conv(F.nullif(h, F.lit(NULL_ENTRY)), 16, 10).cast("int"))
            return _let(F.hex(F.substring(d, at, F.lit(4))), lambda h: _let(length(h), after))

        steps = _let(_number(d, F.lit(2)), lambda n: F.when(n > 0, F.sequence(F.lit(1), n)).otherwise(F.array().cast("array<int>")))
        return F.aggregate(steps, F.struct(F.lit(6).alias("at"), none.alias("out")), take)["out"]

    return _let(data, lambda d: _flagged(d, VARIABLE_SIZE, "texts", read(d), "array<string>"))


def long_to_bytes(value: Column, size: int = 8) -> Column:
    """A number as ``size`` big-endian bytes."""
    return F.unhex(F.substring(F.lpad(F.hex(value.cast("long")), 16, "0"), 17 - 2 * size, 2 * size))


def boolean_from_bytes(data: Column) -> Column:
    return F.hex(data) == "01"


def boolean_to_bytes(value: Column) -> Column:
    return F.when(value, F.unhex(F.lit("01"))).when(~value, F.unhex(F.lit("00")))


def uuid_from_bytes(data: Column) -> Column:
    h = F.lower(F.hex(data))
    return F.concat_ws("-", *[F.substring(h, a, n) for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))])


def string_value(column: Column) -> Column:
    return column.cast("string")


def header_type(text: Column) -> Column:
    """The type a header's text stands for: boolean, integer, decimal, timestamp, date, json or string."""
    return (
        F.when(text.isNull(), "null")
        .when(F.lower(text).isin("true", "false"), "boolean")
        .when(text.rlike(r"^[+-]?\d{1,18}$"), "integer")
        .when(text.rlike(r"^[+-]?(\d+\.\d*|\.\d+|\d+)([eE][+-]?\d+)?$"), "decimal")
        .when(text.rlike(r"^\d{4}-\d{2}-\d{2}$"), "date")
        .when(text.rlike(r"^\d{4}-\d{2}-\d{2}T\d{2}:\d{2}:\d{2}"), "timestamp")
        .when(text.rlike(r"^\s*[\[{]"), "json")
        .otherwise("string")
    )


def header_value(text: Column) -> Column:
    """A header's text as a value of the type it stands for: a struct of ``type`` and one field for each type, of which one is set.

    A json text is kept as text that is known to be json; what doesn't fit its type after all is a string.
    """
    kind, low = header_type(text), F.lower(text)
    fields = {
        "boolean": F.when(kind == "boolean", low == "true"),
        "integer": F.when(kind == "integer", text.try_cast("long")),
        "decimal": F.when(kind == "decimal", text.try_cast("double")),
        "date": F.when(kind == "date", text.try_cast("date")),
        "timestamp": F.when(kind == "timestamp", text.try_cast("timestamp")),
        "json": F.when((kind == "json") & F.try_parse_json(text).isNotNull(), text),
    }
    known = F.coalesce(*[F.when(c.isNotNull(), F.lit(n)) for n, c in fields.items()], F.when(text.isNotNull(), "string"), F.lit("null"))
    return F.struct(known.alias("type"), *[c.alias(n) for n, c in fields.items()], F.when(known == "string", text).alias("string"))


def key_bytes(key: Column, kind: str) -> Column:
    """A key as the bytes that a store orders it by: ``string`` in UTF-8, ``int`` and ``long`` big-endian, so negative ones come last."""
    if kind == "string":
        return key.cast("binary")
    return long_to_bytes(key, {"int": 4, "long": 8}[kind])


def windowed_key(key: Column, window: Column) -> Column:
    """Key and window start in ms as JSON text, for sinks."""
    ms = lambda c: F.unix_millis(c.cast("timestamp"))
    return F.to_json(F.struct(key.alias("key"), ms(window["start"]).alias("start"), ms(window["end"]).alias("end")))
