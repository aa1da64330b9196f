"""Reading rows written with an older schema: the rules of schema resolution for nested records.

A field of the wanted schema may carry ``default`` and ``aliases`` in its metadata. Fields meet by name, else by
the first alias that the written record has. A wanted field that was not written takes its default, else null if
it may be null. Numbers widen, text and bytes stand for each other, and everything is decided at any
depth of records, lists and maps. Fields that were written and are not wanted are left out.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# What a written type may be read as, besides itself.
WIDER = {
    "int": {"bigint", "float", "double"},
    "bigint": {"float", "double"},
    "float": {"double"},
    "string": {"binary"},
    "binary": {"string"},
}


def problems(written: T.DataType, wanted: T.DataType, at: str = "") -> list[str]:
    """Why rows of the written type can't be read as the wanted one; empty when they can."""
    name = at or "record"
    if isinstance(written, T.StructType) and isinstance(wanted, T.StructType):
        found = []
        for field in wanted.fields:
            place, source = f"{at}.{field.name}".lstrip("."), _source(written, field)
            if source is None:
                if "default" not in field.metadata and not field.nullable:
                    found.append(f"{place}: not written and without a default")
                elif field.metadata.get("default", 0) is None and not field.nullable:
                    found.append(f"{place}: null is its default and not allowed")
            else:
                if source.nullable and not field.nullable:
                    found.append(f"{place}: may be null in what was written")
                found += problems(source.dataType, field.dataType, place)
        return found
    if isinstance(written, T.ArrayType) and isinstance(wanted, T.ArrayType):
        inner = [f"{name}[]: may be null in what was written"] if written.containsNull and not wanted.containsNull else []
        return inner + problems(written.elementType, wanted.elementType, f"{at}[]")
    if isinstance(written, T.MapType) and isinstance(wanted, T.MapType):
        inner = [f"{name}{{}}: may be null in what was written"] if written.valueContainsNull and not wanted.valueContainsNull else []
        return (inner + problems(written.keyType, wanted.keyType, f"{at}{{key}}")
                + problems(written.valueType, wanted.valueType, f"{at}{{}}"))
    old, new = written.simpleString(), wanted.simpleString()
    return [] if old == new or new in WIDER.get(old, ()) else [f"{name}: {old} can't be read as {new}"]


def read_as(df: DataFrame, wanted: T.StructType) -> DataFrame:
    """The rows in the wanted schema; an error that names every problem before anything is read."""
    if found := problems(df.schema, wanted):
        raise ValueError("incompatible schemas: " + "; ".join(found))
    return df.select(*[_field(df.schema, field, F.col) for field in wanted.fields])


def _source(written: T.StructType, field: T.StructField) -> T.StructField | None:
    for name in (field.name, *field.metadata.get("aliases", ())):
        if name in written.names:
            return written[name]
    return None


def _field(written: T.StructType, field: T.StructField, get) -> Column:
    source = _source(written, field)
    if source is None:
        return _default(field.metadata.get("default"), field.dataType).alias(field.name)
    return _value(get(_quoted(source.name) if get is F.col else source.name), source.dataType, field.dataType).alias(field.name)


def _quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def _value(value: Column, written: T.DataType, wanted: T.DataType) -> Column:
    if isinstance(wanted, T.StructType):
        built = F.struct(*[_field(written, field, value.getField) for field in wanted.fields])
        return F.when(value.isNotNull(), built)
    if isinstance(wanted, T.ArrayType):
        return F.transform(value, lambda x: _value(x, written.elementType, wanted.elementType))
    if isinstance(wanted, T.MapType):
        values = F.transform_values(value, lambda _, v: _value(v, written.valueType, wanted.valueType))
        return F.transform_keys(values, lambda k, _: _value(k, written.keyType, wanted.keyType))
    return value if written == wanted else value.cast(wanted)


def _default(value, kind: T.DataType) -> Column:
    """A default as JSON-like data: records as dictionaries, lists as lists."""
    if value is None:
        return F.lit(None).cast(kind)
    if isinstance(kind, T.StructType):
        return F.struct(*[_default(value.get(f.name, f.metadata.get("default")), f.dataType).alias(f.name) for f in kind.fields])
    if isinstance(kind, T.ArrayType):
        return F.array(*[_default(v, kind.elementType) for v in value]).cast(kind)
    if isinstance(kind, T.MapType):
        pairs = [c for k, v in value.items() for c in (_default(k, kind.keyType), _default(v, kind.valueType))]
        return F.create_map(*pairs).cast(kind)
    return F.lit(value).cast(kind)
