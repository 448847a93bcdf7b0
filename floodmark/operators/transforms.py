"""Record transforms over whole DataFrames, each a function from DataFrame to DataFrame.

``on`` names the struct column a transform works in (``value`` or ``key``). Field paths may be nested:
``a.b``, with backticks around names that hold dots; ``nested=False`` takes a path as one root name.
"""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

Transform = Callable[[DataFrame], DataFrame]


def field_path(path: str, nested: bool = True) -> list[str]:
    """The names of a path: dots separate, backticks quote."""
    return [a or b for a, b in re.findall(r"`([^`]+)`|([^.`]+)", path)] if nested else [path]


def quoted(path: str, nested: bool = True) -> str:
    return ".".join(f"`{p}`" for p in field_path(path, nested))


def get(on: str, path: str, nested: bool = True) -> Column:
    out = F.col(on)
    for p in field_path(path, nested):
        out = out.getField(p)
    return out


def _type_at(df: DataFrame, on: str, path: str, nested: bool = True) -> T.DataType:
    kind = df.schema[on].dataType
    for p in field_path(path, nested):
        kind = kind[p].dataType
    return kind


def _set(df: DataFrame, on: str, path: str, value: Column, nested: bool = True) -> DataFrame:
    return df.withColumn(on, F.when(F.col(on).isNotNull(), F.col(on).withField(quoted(path, nested), value)))


def cast(spec: dict[str, str] | str, on: str = "value", bad: str = "fail") -> Transform:
    """Fields to types, or the whole value to one type. What can't be cast fails its record, which ``errors`` can route, or becomes ``null``."""
    if bad not in ("fail", "null"):
        raise ValueError(f"no such way with bad values: {bad}")

    def to(value: Column, kind: str) -> Column:
        done = value.try_cast(kind)
        if bad == "null":
            return done
        return F.when(value.isNotNull() & done.isNull(), F.raise_error(F.concat(F.lit("can't cast to " + kind + ": "), value.cast("string"))).cast(kind)).otherwise(done)

    def run(df: DataFrame) -> DataFrame:
        if isinstance(spec, str):
            return df.withColumn(on, to(F.col(on), spec))
        for path, kind in spec.items():
            df = _set(df, on, path, to(get(on, path), kind))
        return df

    return run


def extract_field(path: str, on: str = "value", nested: bool = True, replace_null_with_default: bool = True) -> Transform:
    """The field in place of the struct; a null struct stays null. A null field gets its default (metadata ``default``), if it has one."""

    def run(df: DataFrame) -> DataFrame:
        *outer, last = field_path(path, nested)
        parent = df.schema[on].dataType
        for p in outer:
            parent = parent[p].dataType
        field, got = parent[last], get(on, path, nested)
        if replace_null_with_default and "default" in field.metadata:
            got = F.when(F.col(on).isNotNull(), F.coalesce(got, F.lit(field.metadata["default"]).cast(field.dataType)))
        return df.withColumn(on, got)

    return run


def hoist_field(name: str, on: str = "value") -> Transform:
    return lambda df: df.withColumn(on, F.struct(F.col(on).alias(name)))


def flatten(delimiter: str = ".", on: str = "value") -> Transform:
    """Nested structs as one level, names joined by the delimiter; arrays and maps stay."""

    def leaves(kind: T.StructType, at: Column, name: str) -> list[Column]:
        out = []
        for f in kind:
            full = f"{name}{delimiter}{f.name}" if name else f.name
            out += leaves(f.dataType, at.getField(f.name), full) if isinstance(f.dataType, T.StructType) else [at.getField(f.name).alias(full)]
        return out

    return lambda df: df.withColumn(on, F.when(F.col(on).isNotNull(), F.struct(*leaves(df.schema[on].dataType, F.col(on), ""))))


def insert_field(name: str, source: str | None = None, static=None, on: str = "value") -> Transform:
    """A field from the record (``topic``, ``partition``, ``offset``, ``timestamp``) or a static value."""
    return lambda df: _set(df, on, name, F.lit(static) if source is None else F.col(source), nested=False)


#: What a masked field becomes, by type.
MASKS = {"string": "", "boolean": False, "tinyint": 0, "smallint": 0, "int": 0, "bigint": 0, "float": 0.0, "double": 0.0}


def mask_field(paths: list[str], replacement: str | None = None, on: str = "value") -> Transform:
    """The type's empty value (0, false, '', the epoch, an empty array or map), or a replacement for text and numbers."""

    def run(df: DataFrame) -> DataFrame:
        for path in paths:
            kind = _type_at(df, on, path)
            name = kind.simpleString()
            if replacement is not None:
                empty = F.lit(replacement).cast(kind)
            elif name in MASKS or name.startswith("decimal"):
                empty = F.lit(MASKS.get(name, 0)).cast(kind)
            elif isinstance(kind, (T.DateType, T.TimestampType, T.TimestampNTZType)):
                empty = F.lit("1970-01-01 00:00:00").cast(kind)
            elif isinstance(kind, T.ArrayType):
                empty = F.array().cast(kind)
            elif isinstance(kind, T.MapType):
                empty = F.create_map().cast(kind)
            else:
                raise ValueError(f"{path} of type {name} can't be masked")
            df = _set(df, on, path, F.when(get(on, path).isNotNull(), empty))
        return df

    return run


def replace_field(include: list[str] | None = None, exclude: list[str] | None = None, renames: dict[str, str] | None = None, on: str = "value") -> Transform:
    """Keep, drop and rename root fields; a field both included and excluded is dropped."""
    renames = renames or {}

    def run(df: DataFrame) -> DataFrame:
        names = [n for n in df.schema[on].dataType.names if n not in (exclude or ()) and (not include or n in include)]
        return df.withColumn(on, F.when(F.col(on).isNotNull(), F.struct(*[F.col(on).getField(n).alias(renames.get(n, n)) for n in names])))

    return run


def value_to_key(fields: list[str]) -> Transform:
    return lambda df: df.withColumn("key", F.struct(*[F.col("value").getField(f).alias(f) for f in fields]))


def set_schema_metadata(name: str | None = None, version: int | None = None, on: str = "value") -> Transform:
    def run(df: DataFrame) -> DataFrame:
        meta = dict(df.schema[on].metadata) | ({"name": name} if name is not None else {}) | ({"version": version} if version is not None else {})
        return df.withMetadata(on, meta)

    return run


def convert_timestamp(target: str, path: str | None = None, pattern: str = "yyyy-MM-dd HH:mm:ss", precision: str = "milliseconds", on: str = "value") -> Transform:
    """Between ``string``, ``unix``, ``Date``, ``Time`` (ms of the day) and ``Timestamp``; unix numbers are of ``precision``."""
    per = {"seconds": 1_000_000, "milliseconds": 1000, "microseconds": 1}[precision]

    def run(df: DataFrame) -> DataFrame:
        kind = df.schema[on].dataType if path is None else _type_at(df, on, path)
        at = F.col(on) if path is None else get(on, path)
        if isinstance(kind, T.StringType):
            instant = F.to_timestamp(at, pattern)
        elif isinstance(kind, T.IntegralType):
            instant = F.timestamp_micros(at * per)
        else:
            instant = at.cast("timestamp")
        micros = F.unix_micros(instant)
        out = {
            "string": F.date_format(instant, pattern), "unix": F.floor(micros / per).cast("long"), "Date": F.to_date(instant),
            "Time": F.pmod(F.floor(micros / 1000), F.lit(86_400_000)).cast("long"), "Timestamp": instant,
        }[target]
        return df.withColumn(on, out) if path is None else _set(df, on, path, out)

    return run


# --- headers: array<struct<key, value>>

def drop_headers(names: list[str]) -> Transform:
    return lambda df: df.withColumn("headers", F.filter("headers", lambda h: ~h["key"].isin(names)))


def insert_header(name: str, literal: str) -> Transform:
    return lambda df: df.withColumn("headers", F.concat("headers", _header(name, F.lit(literal))))


def _header(name: str, value: Column) -> Column:
    return F.array(F.struct(F.lit(name).alias("key"), value.cast("string").cast("binary").alias("value")))


def header_from(fields: list[str], headers: list[str], operation: str = "copy", on: str = "value") -> Transform:
    """Fields into headers of the given names; ``move`` takes them out of the struct."""
    if operation not in ("copy", "move"):
        raise ValueError(operation)

    def run(df: DataFrame) -> DataFrame:
        for f, h in zip(fields, headers, strict=True):
            df = df.withColumn("headers", F.concat("headers", _header(h, F.col(on).getField(f))))
        return df.withColumn(on, F.col(on).dropFields(*[f"`{f}`" for f in fields])) if operation == "move" else df

    return run


# --- topics

def regex_router(regex: str, replacement: str) -> Transform:
    """A new topic where the whole name matches; ``$1`` stands for a group."""
    whole = f"^(?:{regex})$"
    return lambda df: df.withColumn("topic", F.when(F.col("topic").rlike(whole), F.regexp_replace("topic", whole, replacement)).otherwise(F.col("topic")))


def timestamp_router(topic_format: str = "${topic}-${timestamp}", timestamp_format: str = "yyyyMMdd") -> Transform:
    parts = [F.col("topic") if p == "${topic}" else F.date_format("timestamp", timestamp_format) if p == "${timestamp}" else F.lit(p) for p in re.split(r"(\$\{topic\}|\$\{timestamp\})", topic_format) if p]
    return lambda df: df.withColumn("topic", F.concat(*parts))


# --- predicates and chains

def has_header_key(name: str) -> Column:
    return F.exists("headers", lambda h: h["key"] == name)


def is_tombstone() -> Column:
    return F.col("value").isNull()


def topic_name_matches(pattern: str) -> Column:
    return F.col("topic").rlike(f"^(?:{pattern})$")


def drop_where(predicate: Column, negate: bool = False) -> Transform:
    """The filter transform: records the predicate holds for are dropped."""
    hit = F.coalesce(predicate, F.lit(False))

    def run(df: DataFrame) -> DataFrame:
        return df.filter(hit if negate else ~hit)

    run.drops = True
    return run


def only_where(predicate: Column, transform: Transform, negate: bool = False) -> Transform:
    """The transform for records the predicate holds for; others pass as they are. It must keep the schema.

    A transform that drops records sees only those, and the others are added to what it leaves.
    """

    def run(df: DataFrame) -> DataFrame:
        hit = F.coalesce(predicate, F.lit(False))
        if getattr(transform, "drops", False):
            hit = ~hit if negate else hit
            return transform(df.filter(hit)).unionByName(df.filter(~hit))
        marked = df.withColumn("_hit", ~hit if negate else hit)
        held = marked.withColumn("_was", F.struct(*df.columns))
        done = transform(held)
        same = [F.when(F.col("_hit"), F.col(c)).otherwise(F.col(f"_was.{c}")).alias(c) for c in df.columns]
        return done.select(*same)

    run.drops = getattr(transform, "drops", False)
    return run


def chain(*transforms: Transform) -> Transform:
    def run(df: DataFrame) -> DataFrame:
        for t in transforms:
            df = df.transform(t)
        return df

    run.drops = any(getattr(t, "drops", False) for t in transforms)
    return run


def named() -> dict[str, Callable]:
    """Transforms and predicates by name: those of this module and what ``register`` added."""
    ours = (cast, extract_field, hoist_field, flatten, insert_field, mask_field, replace_field, value_to_key, set_schema_metadata, convert_timestamp, drop_headers, insert_header, header_from, regex_router, timestamp_router, drop_where, has_header_key, is_tombstone, topic_name_matches)
    return {f.__name__: f for f in ours} | _REGISTERED


_REGISTERED: dict[str, Callable] = {}


def register(name: str):
    """Adds a transform or predicate of one's own: a function of its settings that gives a transform, or a Column."""

    def add(f: Callable) -> Callable:
        _REGISTERED[name] = f
        return f

    return add


def configured(steps: list[dict]) -> Transform:
    """A chain from settings: each step has a ``type``, its arguments, and maybe ``predicate`` (a step) and ``negate``."""

    def build(step: dict):
        args = {k: v for k, v in step.items() if k not in ("type", "predicate", "negate")}
        if step["type"] not in named():
            raise ValueError(f"no transform {step['type']!r}")
        if step["type"] == "drop_where":
            return drop_where(build(step["predicate"]), step.get("negate", False))
        made = named()[step["type"]](**args)
        return only_where(build(step["predicate"]), made, step.get("negate", False)) if "predicate" in step else made

    return chain(*[build(s) for s in steps])


# --- schema projection

#: Numbers widen from left to right.
WIDENING = ("tinyint", "smallint", "int", "bigint", "float", "double")


def project(source: T.StructType, target: T.StructType, on: str = "value") -> Transform:
    """Records of one schema as another: numbers may widen, a field that is missing needs a default or to be optional.

    A target field's default is its metadata ``default``. An optional source field needs a default for a
    required target. Structs, arrays and maps are projected inside. Misfits raise ValueError at once.
    """
    _check(source, target, on)
    return lambda df: df.withColumn(on, F.when(F.col(on).isNotNull(), _project(F.col(on), source, target)))


def _check(s: T.DataType, t: T.DataType, where: str) -> None:
    if isinstance(s, T.StructType) and isinstance(t, T.StructType):
        have = {f.name: f for f in s}
        for f in t:
            default = "default" in f.metadata
            if f.name not in have:
                if not f.nullable and not default:
                    raise ValueError(f"{where}.{f.name} is required and missing")
                continue
            if have[f.name].nullable and not f.nullable and not default:
                raise ValueError(f"{where}.{f.name} is optional and has no default")
            _check(have[f.name].dataType, f.dataType, f"{where}.{f.name}")
    elif isinstance(s, T.ArrayType) and isinstance(t, T.ArrayType):
        _check(s.elementType, t.elementType, f"{where}[]")
    elif isinstance(s, T.MapType) and isinstance(t, T.MapType):
        _check(s.keyType, t.keyType, f"{where}.key")
        _check(s.valueType, t.valueType, f"{where}.value")
    else:
        a, b = s.simpleString(), t.simpleString()
        if a != b and not (a in WIDENING and b in WIDENING and WIDENING.index(a) <= WIDENING.index(b)):
            raise ValueError(f"{where}: {a} can't become {b}")


def _project(at: Column, s: T.DataType, t: T.DataType) -> Column:
    if isinstance(s, T.StructType):
        have = {f.name: f for f in s}
        out = []
        for f in t:
            c = _project(at.getField(f.name), have[f.name].dataType, f.dataType) if f.name in have else F.lit(None).cast(f.dataType)
            if "default" in f.metadata:
                c = F.coalesce(c, F.lit(f.metadata["default"]).cast(f.dataType))
            out.append(c.alias(f.name))
        return F.struct(*out)
    if isinstance(s, T.ArrayType):
        return F.transform(at, lambda x: _project(x, s.elementType, t.elementType))
    if isinstance(s, T.MapType):
        return F.transform_values(at, lambda _, v: _project(v, s.valueType, t.valueType))
    return at.cast(t)
