"""Checks a table's settings declare: schema, value rules, quality checks, keys, retention."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F, types as T

from opsframe.functions.predicates import col, literal, literal_for
from opsframe.functions.rules import Rule
from opsframe.functions.times import micros


def declared_fields(definition: Mapping) -> list[dict]:
    """Both declared shapes: a ``fields`` list, or a map of column to type and nullable."""
    if "fields" in definition:
        found = [dict(f) for f in definition["fields"]]
    else:
        found = [
            {"name": name, **(spec if isinstance(spec, Mapping) else {"type": spec})}
            for name, spec in definition.items()
        ]
    for field in found:
        if field["type"] == "decimal" and "precision" in field:
            field["type"] = f"decimal({field['precision']},{field.get('scale', 0)})"
    return found


def _kind(name: str) -> T.DataType:
    return T.StructType.fromDDL(f"c {name}").fields[0].dataType


def declared_schema(definition: Mapping) -> T.StructType:
    return T.StructType([
        T.StructField(f["name"], _kind(f["type"]), f.get("nullable", True))
        for f in declared_fields(definition)
    ])


def schema_check(df: DataFrame, definition: Mapping) -> DataFrame:
    """One row per declared column: declared and actual type, nulls found, and ``ok``.

    The nulls of all columns are counted in one aggregate that reads only the columns
    declared as not nullable.
    """
    actual = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    wanted = declared_fields(definition)
    rows, counts = [], []
    for i, field in enumerate(wanted):
        name = field["name"]
        strict = name in actual and not field.get("nullable", True)
        counts.append((F.count_if(col(name).isNull()) if strict else F.max(F.lit(0).cast("bigint")))
                      .alias(f"_{i}"))
        kind = _kind(field["type"]).simpleString()
        same = actual.get(name) == kind
        nulls = F.coalesce(F.col(f"_{i}"), F.lit(0).cast("bigint"))
        rows.append(F.struct(
            F.lit(name).alias("column_name"), F.lit(kind).alias("declared_type"),
            F.lit(actual.get(name)).cast("string").alias("actual_type"), nulls.alias("nulls"),
            (F.lit(same) & (nulls == 0)).alias("ok"),
        ))
    return df.agg(*counts).select(F.inline(F.array(*rows)))


_RULE_SUFFIXES = ("_format", "_length", "_range")


def declared_rules(rules: Mapping, columns: Sequence[str]) -> list[Rule]:
    """``<column>_format`` is a pattern; ``_length`` and ``_range`` carry min and max."""
    found = []
    for name, spec in rules.items():
        column = next((name[: -len(s)] for s in _RULE_SUFFIXES
                       if name.endswith(s) and name[: -len(s)] in columns),
                      name if name in columns else None)
        if column is None:
            raise ValueError(f"rule '{name}' names no column; columns: {list(columns)}")
        found.append(Rule(name, _value_rule(col(column), name, spec)))
    return found


def _value_rule(value: Column, name: str, spec) -> Column:
    if isinstance(spec, str):
        return value.rlike(spec)
    measured = value if name.endswith("_range") else F.length(value)
    ok = F.lit(True)
    if spec.get("min") is not None:
        ok = ok & (measured >= spec["min"])
    if spec.get("max") is not None:
        ok = ok & (measured <= spec["max"])
    return ok


def rule_counts(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """Rows breaking each rule, all rules in one aggregate."""
    counts = [F.count_if(~F.coalesce(r.ok, F.lit(True))).alias(f"_{i}") for i, r in enumerate(rules)]
    rows = [F.struct(F.lit(r.name).alias("rule"), F.col(f"_{i}").alias("broken"))
            for i, r in enumerate(rules)]
    return df.agg(*counts).select(F.inline(F.array(*rows)))


_MEASURES = {
    "row_count": lambda c: F.count("*"),
    "null_count": lambda c: F.count_if(col(c).isNull()),
    "negative_count": lambda c: F.count_if(col(c) < 0),
    "min": lambda c: F.min(col(c)),
    "max": lambda c: F.max(col(c)),
    "mean": lambda c: F.avg(col(c)),
    "distinct_count": lambda c: F.count_distinct(col(c)),
    "approx_distinct_count": lambda c: F.approx_count_distinct(col(c), 0.01),
}


def dq_results(df: DataFrame, checks: Sequence[Mapping]) -> DataFrame:
    """One row per check: measured value, expected bounds, ``passed`` and a message.

    A check names a ``measure`` (or gives a Column as one), a ``column`` and ``min`` and/or
    ``max``. All checks are one aggregate over one scan. Bounds are compared in the measure's
    own type, so whole numbers and decimals keep their digits and texts compare as texts;
    ``actual_value`` is the measure as a double, null where it is not a number.
    ``distinct_count`` is exact and shuffles every value; ``approx_distinct_count`` does not.
    """
    measured, rows = [], []
    for i, spec in enumerate(checks):
        measure = spec["measure"]
        if not isinstance(measure, Column):
            if measure not in _MEASURES:
                raise ValueError(f"unknown measure '{measure}'; choices: {list(_MEASURES)}")
            measure = _MEASURES[measure](spec.get("column"))
        measured.append(measure.alias(f"_{i}"))
        value, low, high = F.col(f"_{i}"), spec.get("min"), spec.get("max")
        passed = F.lit(True)
        if low is not None:
            passed = passed & (value >= literal(low))
        if high is not None:
            passed = passed & (value <= literal(high))
        passed = F.coalesce(passed, F.lit(False))
        expected = f"{'' if low is None else low}..{'' if high is None else high}"
        rows.append(F.struct(
            F.lit(spec["name"]).alias("check_name"), passed.alias("passed"),
            F.lit(expected).alias("expected_value"), value.try_cast("double").alias("actual_value"),
            F.when(~passed, F.lit(f"{spec['name']} outside {expected}")).alias("error_message"),
        ))
    return df.agg(*measured).select(F.inline(F.array(*rows)))


def dq_passed(results: DataFrame) -> DataFrame:
    return results.agg(F.coalesce(F.bool_and("passed"), F.lit(True)).alias("data_quality_passed"))


def pk_duplicates(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys held by more than one row, with how many."""
    return df.groupBy(*[col(k) for k in keys]).agg(F.count("*").alias("n")).where(F.col("n") > 1)


def retention_plan(tables: DataFrame, as_of) -> DataFrame:
    """``drop`` past the retention age, ``archive`` past the archive age, else ``keep``.

    Age is that of the last data; tables without data are kept. Zero means not set.
    """
    clock = literal_for(tables, "last_updated_data", as_of)
    age = micros(clock) - micros(F.col("last_updated_data"))
    day = 86_400_000_000

    def older(days: str) -> Column:
        return F.coalesce((F.col(days) > 0) & (age > F.col(days) * day), F.lit(False))

    return tables.withColumn(
        "action",
        F.when(older("retention_days"), "drop").when(older("archive_after_days"), "archive")
        .otherwise("keep"))
