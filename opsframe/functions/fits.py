"""Values that fit a column of another type without loss, at any depth.

A value fits where its conversion is there and says the same: a fraction does not fit a whole
number, nor a number more digits than the column has, nor an instant with a time of day a
date. Lists, maps and structs fit where everything inside them does; structs go by field
name. What does not fit is told by its path: ``limits{}.max is not bigint``, where ``[]``
stands for a list's elements, ``{}`` for a map's values and ``{key}`` for its keys.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F, types as T

from opsframe.functions.predicates import col

_DATES = (T.DateType, T.TimestampType, T.TimestampNTZType)


def _none(kind) -> Column:
    return F.lit(None).cast(kind)


def _family(kind: T.DataType) -> str:
    if isinstance(kind, (T.NumericType, T.BooleanType)):
        return "number"
    if isinstance(kind, _DATES):
        return "instant"
    return type(kind).__name__


def _nested(kind: T.DataType) -> bool:
    return isinstance(kind, (T.ArrayType, T.MapType, T.StructType))


def same_kind(given: T.DataType, wanted: T.DataType) -> bool:
    """Whether every value of the one type is a value of the other as it is."""
    if isinstance(given, T.ArrayType) and isinstance(wanted, T.ArrayType):
        return same_kind(given.elementType, wanted.elementType)
    if isinstance(given, T.MapType) and isinstance(wanted, T.MapType):
        return same_kind(given.keyType, wanted.keyType) and same_kind(given.valueType, wanted.valueType)
    if isinstance(given, T.StructType) and isinstance(wanted, T.StructType):
        return given.names == wanted.names and all(
            same_kind(a.dataType, b.dataType) for a, b in zip(given, wanted, strict=True))
    return given == wanted


def _text_as(value: Column, wanted: T.DataType) -> Column:
    """Text as a value; null where it is none or would lose something."""
    read = value.try_cast(wanted)
    if isinstance(wanted, T.DecimalType):
        whole = wanted.precision - wanted.scale
        exact = value.try_cast(T.DecimalType(38, 38 - whole))
        return F.when(F.coalesce(exact == read, F.lit(False)), read)
    if isinstance(wanted, T.DateType):
        return F.when(F.coalesce(value.try_cast("timestamp_ntz") == read.cast("timestamp_ntz"), F.lit(False)), read)
    return read


def _atom(value: Column, given: T.DataType, wanted: T.DataType) -> Column:
    if isinstance(given, T.StringType):
        return F.try_parse_json(value) if isinstance(wanted, T.VariantType) else _text_as(value, wanted)
    if isinstance(wanted, T.StringType) and not isinstance(given, T.VariantType):
        text = value.try_cast(wanted)
        return F.when(F.is_valid_utf8(text), text) if isinstance(given, T.BinaryType) else text
    if isinstance(wanted, T.VariantType):
        return value.cast(wanted)
    if isinstance(given, T.VariantType):
        read = F.try_variant_get(value, "$", wanted.simpleString())
        return F.when(F.to_json(read.cast("variant")) == F.to_json(value), read)
    if _family(given) != _family(wanted):
        return _none(wanted)
    read = value.try_cast(wanted)
    return F.when(F.coalesce(read.try_cast(given) == value, F.lit(False)), read)


def fitted(value: Column, given: T.DataType, wanted: T.DataType) -> Column:
    """The value as one of the wanted type; what does not fit is null at its place."""
    if same_kind(given, wanted):
        return value
    if isinstance(given, T.NullType):
        return _none(wanted)
    if isinstance(wanted, T.VariantType) and _nested(given):
        return F.to_variant_object(value)
    if isinstance(given, T.ArrayType) and isinstance(wanted, T.ArrayType):
        return F.transform(value, lambda x: fitted(x, given.elementType, wanted.elementType))
    if isinstance(given, T.MapType) and isinstance(wanted, T.MapType):
        # Keys that do not fit, or that fit the same one, would make no map.
        read = F.map_from_arrays(
            F.transform(F.map_keys(value), lambda k: fitted(k, given.keyType, wanted.keyType)),
            F.transform(F.map_values(value), lambda v: fitted(v, given.valueType, wanted.valueType)))
        return F.when(_keys_misfit(value, given, wanted, "").isNull(), read)
    if isinstance(given, T.StructType) and isinstance(wanted, T.StructType):
        own = {f.name: f.dataType for f in given.fields}
        return F.when(value.isNotNull(), F.struct(*[
            (fitted(value[f.name], own[f.name], f.dataType) if f.name in own else _none(f.dataType)).alias(f.name)
            for f in wanted.fields]))
    if _nested(given) or _nested(wanted):
        return _none(wanted)
    return _atom(value, given, wanted)


def _first(reasons: Column) -> Column:
    return F.get(F.filter(reasons, lambda r: r.isNotNull()), F.lit(0))


def _keys_misfit(value: Column, given: T.MapType, wanted: T.MapType, path: str) -> Column:
    read = F.transform(F.map_keys(value), lambda k: fitted(k, given.keyType, wanted.keyType))
    unfit = _first(F.transform(F.map_keys(value), lambda k: misfit_at(k, given.keyType, wanted.keyType, f"{path}{{key}}")))
    return F.coalesce(unfit, F.when(F.size(F.array_distinct(read)) < F.size(read), F.lit(f"{path}{{key}} repeats")))


def misfit_at(value: Column, given: T.DataType, wanted: T.DataType, path: str) -> Column:
    """Why the value does not fit the wanted type, by the first place that does not; else null."""
    if same_kind(given, wanted) or isinstance(given, T.NullType):
        return _none("string")
    if isinstance(wanted, T.VariantType) and _nested(given):
        return _none("string")
    if isinstance(given, T.ArrayType) and isinstance(wanted, T.ArrayType):
        return _first(F.transform(value, lambda x: misfit_at(x, given.elementType, wanted.elementType, f"{path}[]")))
    if isinstance(given, T.MapType) and isinstance(wanted, T.MapType):
        held = _first(F.transform(F.map_values(value), lambda v: misfit_at(v, given.valueType, wanted.valueType, f"{path}{{}}")))
        return F.coalesce(_keys_misfit(value, given, wanted, path), held)
    if isinstance(given, T.StructType) and isinstance(wanted, T.StructType):
        kinds = {f.name: f.dataType for f in wanted.fields}
        found = [
            misfit_at(value[f.name], f.dataType, kinds[f.name], f"{path}.{f.name}") if f.name in kinds
            else F.when(value[f.name].isNotNull(), F.lit(f"{path}.{f.name} is no field")) for f in given.fields]
        return F.coalesce(*found, _none("string"))
    unfit = F.lit(f"{path} is not {wanted.simpleString()}")
    if _nested(given) or _nested(wanted):
        return F.when(value.isNotNull(), unfit)
    return F.when(value.isNotNull() & _atom(value, given, wanted).isNull(), unfit)


def _texts(kind: T.DataType) -> T.DataType:
    """The type with every value inside as text, as JSON is read before it is fitted."""
    if isinstance(kind, T.ArrayType):
        return T.ArrayType(_texts(kind.elementType))
    if isinstance(kind, T.MapType):
        return T.MapType(T.StringType(), _texts(kind.valueType))
    if isinstance(kind, T.StructType):
        return T.StructType([T.StructField(f.name, _texts(f.dataType)) for f in kind.fields])
    return kind if isinstance(kind, T.VariantType) else T.StringType()


def _parsed(text: Column, kind: T.DataType) -> tuple[Column, Column]:
    """Nested JSON with its values as text, and whether the text was such JSON."""
    wrapped = T.StructType([T.StructField("v", _texts(kind)), T.StructField("_corrupt", T.StringType())])
    whole = F.concat(F.lit('{"v":'), text, F.lit("}"))
    read = F.from_json(whole, wrapped, {"columnNameOfCorruptRecord": "_corrupt"})
    alone = F.coalesce(F.size(F.json_object_keys(whole)) == 1, F.lit(False))
    return read["v"], read["_corrupt"].isNull() & alone


def text_fitted(text: Column, wanted: T.DataType) -> Column:
    """Text, JSON for a nested type, as a value; null where something does not fit."""
    if not _nested(wanted):
        return _atom(text, T.StringType(), wanted)
    value, sound = _parsed(text, wanted)
    fits = sound & misfit_at(value, _texts(wanted), wanted, "").isNull()
    return F.when(fits, fitted(value, _texts(wanted), wanted))


def text_misfit(text: Column, wanted: T.DataType, path: str) -> Column:
    """Why the text is no value of the type; null where it is one, or null itself."""
    unfit = F.lit(f"{path} is not {wanted.simpleString()}")
    if not _nested(wanted):
        return F.when(text.isNotNull() & _atom(text, T.StringType(), wanted).isNull(), unfit)
    value, sound = _parsed(text, wanted)
    empty = value.isNull() & (F.trim(text) != "null")
    return F.when(text.isNotNull(), F.when(~sound | empty, unfit).otherwise(
        misfit_at(value, _texts(wanted), wanted, path)))


def row_misfit(rows: DataFrame, like: DataFrame, columns=None) -> Column:
    """Why a row does not fit the columns of ``like`` that it has; null where it fits."""
    kinds = {f.name: f.dataType for f in like.schema.fields}
    found = [misfit_at(col(n), rows.schema[n].dataType, kinds[n], n)
             for n in (rows.columns if columns is None else columns) if n in kinds and n in rows.columns]
    return F.coalesce(*found, _none("string"))


def as_column(rows: DataFrame, like: DataFrame, name: str) -> Column:
    """A column of the rows with the type it has in ``like``; null where it does not fit."""
    return fitted(col(name), rows.schema[name].dataType, like.schema[name].dataType)
