"""Mapping between typed rows and stored items.

An item is one JSON document: booleans are the texts ``true`` and ``false``, instants are
ISO text, and null fields are left out while nulls inside free-form maps stay. Free-form
values (VARIANT) have no declared types and are stored as they are. With ``free_booleans``
every boolean in them, at any depth, becomes a text, and on the way back every text ``true``
or ``false`` a boolean, those that were texts before among them.
"""

from __future__ import annotations

from collections.abc import Callable
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, functions as F, types as T

from opsframe.functions.predicates import col
from opsframe.functions.times import format_iso, parse_iso
from opsframe.schema import MAX_ITEM_BYTES

_INSTANTS = (T.TimestampType, T.TimestampNTZType)


def _stored(value: Column, kind: T.DataType, free: bool = False) -> Column:
    if isinstance(kind, T.BooleanType):
        return value.cast("string")
    if isinstance(kind, _INSTANTS):
        return format_iso(value)
    if isinstance(kind, T.ArrayType):
        return F.transform(value, lambda x: _stored(x, kind.elementType, free))
    if isinstance(kind, T.MapType):
        return F.transform_values(value, lambda k, v: _stored(v, kind.valueType, free))
    if isinstance(kind, T.StructType):
        fields = [_stored(value[f.name], f.dataType, free).alias(f.name) for f in kind.fields]
        return F.when(value.isNotNull(), F.struct(*fields))
    if free and isinstance(kind, T.VariantType):
        return _free(value, bools_to_texts)
    return value


def _free(value: Column, change: Callable[[Column], Column]) -> Column:
    """A free-form value with its JSON changed, in a list of one, as it may be a bare text."""
    json = change(F.to_json(F.array(value)))
    return F.when(value.isNotNull(), F.variant_get(F.parse_json(json), "$[0]", "variant"))


def _text_kind(kind: T.DataType) -> T.DataType:
    """The type a stored value is read with before it is converted."""
    if isinstance(kind, (T.BooleanType, *_INSTANTS)):
        return T.StringType()
    if isinstance(kind, T.ArrayType):
        return T.ArrayType(_text_kind(kind.elementType))
    if isinstance(kind, T.MapType):
        return T.MapType(kind.keyType, _text_kind(kind.valueType))
    if isinstance(kind, T.StructType):
        return T.StructType([T.StructField(f.name, _text_kind(f.dataType)) for f in kind.fields])
    return kind


def text_to_bool(text: Column) -> Column:
    return F.when(F.lower(text).isin("true", "false"), F.lower(text) == "true")


def _loaded(value: Column, kind: T.DataType, free: bool = False) -> Column:
    if isinstance(kind, T.BooleanType):
        return text_to_bool(value)
    if isinstance(kind, _INSTANTS):
        return parse_iso(value).cast(kind)
    if isinstance(kind, T.ArrayType):
        return F.transform(value, lambda x: _loaded(x, kind.elementType, free))
    if isinstance(kind, T.MapType):
        return F.transform_values(value, lambda k, v: _loaded(v, kind.valueType, free))
    if isinstance(kind, T.StructType):
        fields = [_loaded(value[f.name], f.dataType, free).alias(f.name) for f in kind.fields]
        return F.when(value.isNotNull(), F.struct(*fields))
    if free and isinstance(kind, T.VariantType):
        return _free(value, texts_to_bools)
    return value


def to_item(df: DataFrame, keep: tuple[str, ...] = (), name: str = "item", free_booleans: bool = False) -> DataFrame:
    """The rows as items, with the ``keep`` columns beside them."""
    fields = [_stored(col(f.name), f.dataType, free_booleans).alias(f.name) for f in df.schema.fields]
    return df.select(*[col(k) for k in keep], F.to_json(F.struct(*fields)).alias(name))


class Loaded(NamedTuple):
    """Typed rows, and the items that could not be read, with the names of their bad fields
    in ``errors`` (``item`` where the whole is not a JSON object)."""

    accepted: DataFrame
    rejected: DataFrame


def from_item(df: DataFrame, kind: T.StructType, name: str = "item", free_booleans: bool = False) -> Loaded:
    """Typed rows from items. Only fields declared boolean or instant are converted, and with
    ``free_booleans`` the texts ``true`` and ``false`` inside free-form ones.

    A field that an item leaves out or gives as null is null; a value that is not of the
    declared type, at any depth, rejects its item.
    """
    stored = _text_kind(kind)
    corrupt = T.StructType([*stored.fields, T.StructField("_corrupt", T.StringType())])
    item = col(name)
    parsed = F.from_json(item, corrupt, {"columnNameOfCorruptRecord": "_corrupt"})
    given = F.from_json(item, T.MapType(T.StringType(), T.StringType()))
    read = df.withColumns({"_parsed": parsed, "_given": given})
    values = {f.name: _loaded(F.col("_parsed")[f.name], f.dataType, free_booleans) for f in kind.fields}
    broken = [F.when(F.col("_given")[f.name].isNotNull() & (values[f.name].isNull() | _holes(
        F.col("_parsed")[f.name], values[f.name], f.dataType)), F.lit(f.name)) for f in kind.fields]
    named = F.array_compact(F.array(*broken))
    whole = F.col("_given").isNull() | (F.col("_parsed")["_corrupt"].isNotNull() & (F.size(named) == 0))
    errors = F.when(whole, F.array(F.lit("item"))).otherwise(named)
    # The row of a generator is made once, so that errors and values are not worked out twice.
    row = F.struct(item.alias("_item"), errors.alias("errors"), F.struct(
        *[v.alias(n) for n, v in values.items()]).alias("_row"))
    told = read.select(F.inline(F.array(row)))
    return Loaded(told.where(F.size("errors") == 0).select("_row.*"),
                  told.where(F.size("errors") > 0).select(F.col("_item").alias(name), "errors"))


def _holes(stored: Column, loaded: Column, kind: T.DataType) -> Column:
    """Whether a converted value inside a list, map or struct was lost."""
    if isinstance(kind, T.ArrayType):
        pairs = F.arrays_zip(stored.alias("a"), loaded.alias("b"))
        return F.coalesce(F.exists(pairs, lambda p: _hole(p["a"], p["b"], kind.elementType)), F.lit(False))
    if isinstance(kind, T.MapType):
        pairs = F.arrays_zip(F.map_values(stored).alias("a"), F.map_values(loaded).alias("b"))
        return F.coalesce(F.exists(pairs, lambda p: _hole(p["a"], p["b"], kind.valueType)), F.lit(False))
    if isinstance(kind, T.StructType):
        found = F.lit(False)
        for f in kind.fields:
            found = found | _hole(stored[f.name], loaded[f.name], f.dataType)
        return F.coalesce(found, F.lit(False))
    return F.lit(False)


def _hole(stored: Column, loaded: Column, kind: T.DataType) -> Column:
    return (stored.isNotNull() & loaded.isNull()) | _holes(stored, loaded, kind)


def texts_to_bools(json: Column) -> Column:
    """Every text value ``true``/``false``, any case and any depth, as a boolean.

    Works on compact JSON: a value's opening quote follows ``:``, ``[`` or ``,`` and its
    closing quote is followed by ``,``, ``]`` or ``}``; quotes inside texts are escaped.
    """
    for word in ("true", "false"):
        json = F.regexp_replace(json, f'(?<=[:\\[,])"(?i:{word})"(?=[,\\]}}])', word)
    return json


# A text of a JSON document, or what stands between two of them.
_PIECE = r'"[^"\\]*+(?:\\.[^"\\]*+)*+"|[^"]++'


def bools_to_texts(json: Column) -> Column:
    """Every boolean value, at any depth, as its text; keys and texts are left alone."""
    pieces = F.regexp_extract_all(json, F.lit(_PIECE), F.lit(0))
    return F.array_join(F.transform(pieces, lambda p: F.when(F.startswith(p, F.lit('"')), p).otherwise(
        F.regexp_replace(p, "(true|false)", '"$1"'))), "")


def compact(json: Column) -> Column:
    return F.to_json(F.parse_json(json))


def item_bytes(df: DataFrame) -> Column:
    """UTF-8 bytes of the row as compact JSON."""
    return F.octet_length(F.to_json(F.struct(*[col(c) for c in df.columns])))


def oversized(df: DataFrame, limit: int = MAX_ITEM_BYTES) -> DataFrame:
    return df.withColumn("item_bytes", item_bytes(df)).where(F.col("item_bytes") > limit)


def json_field(json: Column, path: str, kind: str = "string") -> Column:
    """A value inside free-form JSON text; null when absent or of another type."""
    return F.try_variant_get(F.try_parse_json(json), path, kind)


def physical_name(base: Column, environment: Column, prefix: Column) -> Column:
    """Prefix, environment unless production, and base, joined by underscores."""
    return F.concat_ws(
        "_", F.when(prefix != "", prefix), F.when(environment != "prod", environment), base)
