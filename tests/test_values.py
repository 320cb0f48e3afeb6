"""Times, items and rules."""

import json
from datetime import datetime, timezone
from decimal import Decimal

import pytest
from pyspark.sql import functions as F, types as T

from opsframe.functions import items, rules, times
from opsframe.operators import quality, settings


def one(spark, expression, **values):
    """The value of a column expression over one row of literals."""
    row = spark.range(1).select(*[
        (v if not isinstance(v, (str, int, float, bool, type(None), datetime, Decimal)) else F.lit(v)).alias(k)
        for k, v in (values or {"x": 1}).items()])
    return row.select(expression.alias("out")).first().out


def ntz(text):
    return F.expr(f"TIMESTAMP_NTZ '{text}'")


# -- times ------------------------------------------------------------------------------

@pytest.mark.parametrize("wall,zone,utc", [
    ("2024-01-01 10:00:00", "America/New_York", "2024-01-01 15:00:00"),
    ("2024-01-01 10:00:00", "UTC", "2024-01-01 10:00:00"),
    ("2024-03-10 02:30:00", "America/New_York", "2024-03-10 07:30:00"),  # a gap hour
    ("2024-11-03 01:30:00", "America/New_York", "2024-11-03 05:30:00"),  # an overlap hour
])
def test_naive_to_utc(spark, wall, zone, utc):
    assert one(spark, times.naive_to_utc(ntz(wall), zone)) == datetime.fromisoformat(utc)


def test_display_zone(spark):
    assert one(spark, times.to_zone(ntz("2024-01-01 15:00:00"), "America/New_York")) == datetime(2024, 1, 1, 10)
    assert one(spark, times.to_zone(ntz("2024-01-01 15:00:00"), None)) == datetime(2024, 1, 1, 15)
    with pytest.raises(ValueError, match="unknown time zone"):
        times.check_zone("Mars/Olympus")


@pytest.mark.parametrize("text,utc", [
    ("2024-01-15T12:00:00Z", "2024-01-15 12:00:00"),
    ("2024-01-15T12:00:00+00:00", "2024-01-15 12:00:00"),
    ("2024-01-15T12:00:00-05:00", "2024-01-15 17:00:00"),
    ("2024-01-15T12:00:00.123456", "2024-01-15 12:00:00.123456"),
    ("not a time", None), ("", None), (None, None),
])
def test_parse_iso(spark, text, utc):
    found = one(spark, times.parse_iso(F.lit(text).cast("string")).cast("timestamp_ntz"))
    assert found == (utc and datetime.fromisoformat(utc))


@pytest.mark.parametrize("wall,text", [
    ("2024-01-15 12:00:00", "2024-01-15T12:00:00+00:00"),
    ("2024-01-15 12:00:00.5", "2024-01-15T12:00:00.500000+00:00"),
])
def test_format_iso(spark, wall, text):
    assert one(spark, times.format_iso(ntz(wall))) == text
    assert datetime.fromisoformat(text).tzinfo is not None


def test_seconds_are_exact(spark):
    seconds = times.seconds_between(ntz("2024-01-15 10:00:00"), ntz("2024-01-15 12:30:00.000001"))
    assert one(spark, seconds) == Decimal("9000.000001")


def test_stage_times_are_shown_in_the_zone(spark):
    df = spark.sql("""SELECT 'r' AS run_id, TIMESTAMP_NTZ '2024-01-01 15:00:00' AS start_time,
        array(named_struct('stage_name', 's', 'start_time', TIMESTAMP_NTZ '2024-01-01 16:00:00',
                           'end_time', CAST(NULL AS TIMESTAMP_NTZ))) AS stages""")
    row = times.in_zone(df, "America/New_York").first()
    assert row.start_time == datetime(2024, 1, 1, 10) and row.time_zone == "America/New_York"
    assert row.stages[0].start_time == datetime(2024, 1, 1, 11) and row.stages[0].end_time is None


# -- items ------------------------------------------------------------------------------

KIND = ("id string, flag boolean, at timestamp, price decimal(38,18), n bigint, note string, "
        "tags map<string,string>, parts array<struct<name: string, ok: boolean, at: timestamp>>")


def test_item_round_trip(spark):
    at = datetime(2024, 1, 15, 12, 0, 0, 5)
    data = [
        ("a", True, at, Decimal("15.123456789"), 2**63 - 1, '{"x": "<é>"} 中文 🎉\n', {"k": None, "b": "true"},
         [("s", False, at), ("t", None, None)]),
        ("b", None, None, None, None, None, {}, []),
        ("c", False, None, Decimal("0.000000001"), -1, "x" * 10000, None, None),
    ]
    df = spark.createDataFrame(data, KIND)
    stored = items.to_item(df)
    first = json.loads(stored.collect()[0].item)
    assert first["flag"] == "true" and first["at"] == "2024-01-15T12:00:00.000005+00:00"
    assert first["tags"] == {"k": None, "b": "true"}  # a null inside a map stays
    assert json.loads(stored.collect()[1].item) == {"id": "b", "tags": {}, "parts": []}
    assert items.from_item(stored, df.schema).accepted.collect() == df.collect()


def test_free_form_fields_round_trip(spark):
    df = spark.sql("""SELECT 'p' AS pipeline_id, true AS is_active,
        parse_json('{"a":{"on":"true","n":null,"l":[1,2.5,"x"]},"e":{}}') AS config,
        CAST(NULL AS VARIANT) AS spark_config""")
    stored = items.to_item(df)
    item = json.loads(stored.first().item)
    assert item["config"] == {"a": {"on": "true", "n": None, "l": [1, 2.5, "x"]}, "e": {}}
    assert "spark_config" not in item
    back = items.from_item(stored, df.schema).accepted
    assert back.select(F.to_json("config")).first() == df.select(F.to_json("config")).first()
    assert back.select(F.variant_get("config", "$.a.on", "boolean").alias("on")).first().on is True


def test_only_declared_booleans_convert(spark):
    stored = spark.createDataFrame([('{"id":"true","flag":"TRUE"}',)], "item string")
    row = items.from_item(stored, T.StructType.fromDDL("id string, flag boolean")).accepted.first()
    assert (row.id, row.flag) == ("true", True)


def test_greedy_texts_to_bools(spark):
    nested = {
        "a": "true", "l": [{"e": "FALSE"}, "true", "x"], "deep": {"b": {"c": {"d": "False"}}},
        "s": "not_a_boolean", "t": "2024-01-01T10:00:00Z", "q": 'say "true", then', "true": "k",
    }
    text = json.dumps(nested, separators=(",", ":"))
    found = json.loads(one(spark, items.texts_to_bools(F.lit(text))))
    assert found == {**nested, "a": True, "l": [{"e": False}, True, "x"], "deep": {"b": {"c": {"d": False}}}}


@pytest.mark.parametrize("value", ["15.75", "15.123456789", "0.000000001", "999999999.999", "123.0", "0", "-15.75"])
def test_decimals_survive(spark, value):
    df = spark.createDataFrame([(Decimal(value),)], "d decimal(38,18)")
    assert items.from_item(items.to_item(df), df.schema).accepted.first().d == Decimal(value)


def test_json_field(spark):
    text = F.lit('{"a":{"on":"true","n":3,"z":null}}')
    assert one(spark, items.json_field(text, "$.a.on", "boolean")) is True
    assert one(spark, items.json_field(text, "$.a.n", "bigint")) == 3
    assert one(spark, items.json_field(text, "$.a.none", "bigint")) is None
    assert one(spark, items.json_field(F.lit("{broken"), "$.a", "bigint")) is None


def test_oversized_counts_utf8(spark):
    df = spark.createDataFrame([("a", "é" * 10), ("b", "e" * 10)], "id string, t string")
    assert [r.id for r in items.oversized(df, 30).collect()] == ["a"]


# -- rules ------------------------------------------------------------------------------

@pytest.mark.parametrize("value,ok", [
    ("a-B_9", True), ("a\n", False), ("a b", False), ("", False), ("x" * 128, True), ("x" * 129, False), ("é", False)])
def test_id_rule(spark, value, ok):
    assert one(spark, rules.id_ok(F.lit(value))) is ok


@pytest.mark.parametrize("value,ok", [("1.0.0", True), ("1.0", False), ("1.0.0\n", False), ("1.0.0-rc", False), ("10.20.30", True)])
def test_semver_rule(spark, value, ok):
    assert one(spark, rules.semver_ok(F.lit(value))) is ok


@pytest.mark.parametrize("value,ok", [
    ("0 2 * * *", True), ("0 0 2 * * ?", True), (" 0  2 *\t* * ", True), ("0 2 * *", False), ("", True), ("  ", False)])
def test_cron_rule(spark, value, ok):
    assert one(spark, rules.cron_ok(F.lit(value))) is ok


@pytest.mark.parametrize("cores,memory,ok", [(4, 2.0, True), (4, 1.9, False), (0, 0.1, True), (4, 0.0, True), (None, 1.0, True)])
def test_resources_rule(spark, cores, memory, ok):
    assert one(spark, rules.resources_ok(F.lit(cores).cast("bigint"), F.lit(memory))) is ok


@pytest.mark.parametrize("failed,processed,ok", [(5, 0, True), (5, 4, False), (4, 5, True), (5, 5, True), (0, 0, True)])
def test_counts_rule(spark, failed, processed, ok):
    assert one(spark, rules.counts_ok(F.lit(processed), F.lit(failed))) is ok


@pytest.mark.parametrize("retention,archive,ok", [(30, 10, True), (30, 30, False), (0, 30, True), (30, 0, True)])
def test_lifecycle_rule(spark, retention, archive, ok):
    assert one(spark, rules.lifecycle_ok(F.lit(retention), F.lit(archive))) is ok


def test_timing_rule(spark):
    early, late, none = ntz("2024-01-01 00:00:00"), ntz("2024-01-02 00:00:00"), F.lit(None).cast("timestamp_ntz")
    assert one(spark, rules.timing_ok(early, late)) is True
    assert one(spark, rules.timing_ok(early, early)) is False
    assert one(spark, rules.timing_ok(none, late)) is False
    assert one(spark, rules.timing_ok(early, none)) is True


@pytest.mark.parametrize("value,ok", [("s3://b/x", True), ("/data", True), ("ftp://x", False), (" ", False), ("wasbs://c", True)])
def test_location_rule(spark, value, ok):
    assert one(spark, rules.location_ok(F.lit(value))) is ok


def test_split_reports_every_broken_rule(spark):
    df = spark.createDataFrame(
        [("p1", "one", "s3", "warehouse", "dev", "1.0.0"), ("p 2", "", "s4", None, "qa", "1")],
        "pipeline_id string, pipeline_name string, source_type string, destination_type string, "
        "environment string, version string")
    good, bad = rules.split(df, rules.bind(df, rules.PIPELINE_RULES))
    assert [r.pipeline_id for r in good.collect()] == ["p1"]
    assert set(bad.first().errors) == {
        "destination_type_required", "pipeline_id_id", "pipeline_name_length", "environment_domain",
        "source_type_domain", "version_semver"}


def test_a_missing_required_column_breaks_its_rule(spark):
    df = spark.createDataFrame([("t1",)], "table_id string")
    broken = rules.split(df, rules.bind(df, rules.TABLE_RULES)).rejected.first().errors
    assert "location_required" in broken and "pipeline_id_required" in broken


def test_end_time_is_mended(spark):
    now, none = ntz("2024-01-31 00:00:00"), F.lit(None).cast("timestamp_ntz")
    assert one(spark, rules.default_end_time(F.lit("failed"), none, now)) == datetime(2024, 1, 31)
    assert one(spark, rules.default_end_time(F.lit("skipped"), none, now)) is None


# -- declared checks --------------------------------------------------------------------

def test_schema_check_reads_both_shapes(spark):
    df = spark.createDataFrame([("a", 1), (None, 2)], "id string, n int")
    as_map = {"id": {"type": "string", "nullable": False}, "n": {"type": "int"}, "gone": {"type": "string"}}
    as_list = {"fields": [{"name": k, **v} for k, v in as_map.items()]}
    expected = [("gone", "string", None, 0, False), ("id", "string", "string", 1, False), ("n", "int", "int", 0, True)]
    for shape in (as_map, as_list):
        assert sorted(tuple(r) for r in quality.schema_check(df, shape).collect()) == expected
    decimal = quality.declared_schema({"fields": [{"name": "a", "type": "decimal", "precision": 10, "scale": 2}]})
    assert decimal["a"].dataType == T.DecimalType(10, 2)


def test_declared_value_rules(spark):
    df = spark.createDataFrame([("a@b.io", "12345"), ("nope", "1"), (None, None)], "email string, customer_id string")
    declared = quality.declared_rules({
        "email_format": r"^[a-zA-Z0-9._%+-]+@[a-zA-Z0-9.-]+\.[a-zA-Z]{2,}$",
        "customer_id_length": {"min": 5, "max": 50}}, df.columns)
    assert sorted(tuple(r) for r in quality.rule_counts(df, declared).collect()) == [
        ("customer_id_length", 1), ("email_format", 1)]
    with pytest.raises(ValueError, match="names no column"):
        quality.declared_rules({"phone_format": "x"}, df.columns)


def test_dq_results_and_verdict(spark):
    df = spark.createDataFrame([(1.0,), (5.0,)], "v double")
    checks = [{"name": "rows", "measure": "row_count", "min": 2}, {"name": "top", "measure": "max", "column": "v", "max": 4}]
    found = quality.dq_results(df, checks)
    assert [(r.check_name, r.passed, r.actual_value) for r in found.collect()] == [("rows", True, 2.0), ("top", False, 5.0)]
    assert quality.dq_passed(found).first().data_quality_passed is False
    empty = quality.dq_results(df.where("false"), [{"name": "top", "measure": "max", "column": "v", "max": 4}])
    assert empty.first().passed is False  # nothing measured is not a pass


def test_retention_plan(spark):
    at = lambda d: datetime(2024, 1, d)
    df = spark.createDataFrame(
        [("old", at(1), 20, 10), ("mid", at(15), 20, 10), ("new", at(30), 20, 10), ("none", None, 20, 10), ("unset", at(1), 0, None)],
        "table_id string, last_updated_data timestamp, retention_days int, archive_after_days int")
    plan = {r.table_id: r.action for r in quality.retention_plan(df, datetime(2024, 1, 31)).collect()}
    assert plan == {"old": "drop", "mid": "archive", "new": "keep", "none": "keep", "unset": "keep"}


def test_effective_conf(spark):
    df = spark.sql("""SELECT 'p' AS pipeline_id, 'Daily' AS pipeline_name,
        map('spark.executor.cores', '2', 'spark.x', '1') AS spark_config,
        4L AS cpu_cores, CAST(1.5 AS DECIMAL(38,18)) AS memory_gb""")
    conf = settings.effective_conf(df).first().conf
    assert conf["spark.executor.cores"] == "4" and conf["spark.executor.memory"] == "1536m"
    assert conf["spark.x"] == "1" and conf["spark.app.name"] == "Pipeline-Daily"
    bare = settings.effective_conf(df.withColumns({
        "spark_config": F.lit(None).cast("map<string,string>"), "cpu_cores": F.lit(0).cast("bigint"),
        "memory_gb": F.lit(None).cast("decimal(38,18)")})).first().conf
    assert "spark.executor.cores" not in bare and "spark.executor.memory" not in bare


def test_naive_times_become_utc_and_instants_stay(spark):
    df = spark.sql("""SELECT TIMESTAMP_NTZ '2024-01-01 10:00:00' AS naive,
        TIMESTAMP '2024-01-01 10:00:00' AS instant,
        array(named_struct('stage_name', 's', 'start_time', TIMESTAMP_NTZ '2024-01-01 10:00:00')) AS stages""")
    row = times.to_utc(df, "America/New_York").first()
    assert row.naive == row.stages[0].start_time == datetime(2024, 1, 1, 15)
    assert row.instant == datetime(2024, 1, 1, 10)
    only = times.to_utc(df, "America/New_York", columns=[]).first()
    assert only.naive == datetime(2024, 1, 1, 10)


def test_items_that_cannot_be_read_are_rejected_with_their_fields(spark):
    kind = T.StructType.fromDDL("id string, ok boolean, at timestamp, n bigint, parts array<struct<name: string, done: boolean, k: bigint>>")
    texts = ['{"id":"a","ok":"true","at":"2024-01-15T12:00:00Z","n":3,"parts":[{"name":"x","done":"false","k":1}]}', '{"id":"b"}',
             '{"id":"c","n":null,"parts":[]}', 'not json', '{"id":"d","ok":"yes"}', '{"id":"e","at":"bad","ok":"no"}', '{"id":"f","n":"x"}',
             '{"id":"g","parts":[{"done":"maybe"}]}', '{"id":"h","parts":[{"k":"oops"}]}', None]
    loaded = items.from_item(spark.createDataFrame([(t,) for t in texts], "item string"), kind)
    assert {r.id for r in loaded.accepted.collect()} == {"a", "b", "c"}
    found = {r.item: set(r.errors) for r in loaded.rejected.collect()}
    assert found[texts[3]] == {"item"} and found[texts[4]] == {"ok"} and found[texts[5]] == {"ok", "at"}
    assert found[texts[6]] & {"n", "item"} and found[texts[7]] == {"parts"} and found[texts[8]] & {"parts", "item"} and found[None] == {"item"}


@pytest.mark.parametrize("text, ok", [
    ("12:30", False), ("T10:00:00", False), ("2024", False), ("2024-1-5", False), ("", False), (" 2024-01-15", False),
    ("2024-01-15", True), ("2024-01-15T10:00", True), ("2024-01-15 10:00:00.123456+02:00", True), ("2024-13-01", False), ("2024-01-15\n", False)])
def test_only_iso_text_is_a_time(spark, text, ok):
    row = spark.createDataFrame([(text,)], "t string").select(times.parse_iso(F.col("t")).alias("t")).first()
    assert (row.t is not None) == ok


def test_checks_compare_in_the_measure_s_own_type(spark):
    df = spark.createDataFrame([(2**53 + 1, "b"), (1, "a"), (1, "a")], "n bigint, t string")
    found = {r.check_name: r for r in quality.dq_results(df, [
        {"name": "top", "measure": "max", "column": "n", "max": 2**53},
        {"name": "first", "measure": "min", "column": "t", "min": "a", "max": "a"},
        {"name": "kinds", "measure": "distinct_count", "column": "n", "min": 2, "max": 2},
        {"name": "about", "measure": "approx_distinct_count", "column": "n", "max": 9}]).collect()}
    assert [found[n].passed for n in ("top", "first", "kinds", "about")] == [False, True, True, True]
    assert found["first"].actual_value is None


def test_texts_that_are_no_values_break_a_type_rule(spark):
    rows = spark.createDataFrame([("1", "x"), (None, "2.5")], "n string, m string")
    checked = rules.check(rows, rules.type_rules(rows, {"n": "bigint", "m": "decimal(5,2)", "absent": "int"}))
    assert sorted(r.errors for r in checked.collect()) == [[], ["m_type"]]


FREE = [
    ('true', '"true"', 'true'), ('"FALSE"', '"FALSE"', 'false'), ('null', 'null', 'null'), ('"a true"', '"a true"', '"a true"'),
    ('{"true":false,"b":"x:true,[false]"}', '{"b":"x:true,[false]","true":"false"}', '{"b":"x:true,[false]","true":false}'),
    (r'["\"true\"",":\"true\",","\\",true,"\\\"",[false,{"d":{"e":[true,null,1.5,"True"]}}]]',
     r'["\"true\"",":\"true\",","\\","true","\\\"",["false",{"d":{"e":["true",null,1.5,"True"]}}]]',
     r'["\"true\"",":\"true\",","\\",true,"\\\"",[false,{"d":{"e":[true,null,1.5,true]}}]]'),
    ('[]', '[]', '[]'), ('{}', '{}', '{}'),
]


def test_free_form_booleans_at_any_depth(spark):
    """Booleans become texts on the way in; texts become booleans on the way back."""
    rows = spark.createDataFrame([(k, v[0]) for k, v in enumerate(FREE)] + [(99, None)], "k int, j string")
    free = rows.select("k", F.parse_json("j").alias("v"), F.array(F.parse_json("j")).alias("vs"),
                       F.struct(F.parse_json("j").alias("w"), F.lit("true").alias("text")).alias("s"))
    stored = items.to_item(free, keep=("k",), free_booleans=True)
    told = {r.k: r.item for r in stored.collect()}
    for k, (_, item, _) in enumerate(FREE):
        assert told[k] == f'{{"k":{k},"v":{item},"vs":[{item}],"s":{{"w":{item},"text":"true"}}}}'
    assert told[99] == '{"k":99,"vs":[null],"s":{"text":"true"}}'
    back = items.from_item(stored, free.schema, free_booleans=True)
    assert back.rejected.count() == 0
    as_is = items.to_item(free, keep=("k",)).where("k = 0").first().item
    assert as_is == '{"k":0,"v":true,"vs":[true],"s":{"w":true,"text":"true"}}'
    for r in back.accepted.select("k", F.to_json("v").alias("v"), F.to_json("vs").alias("vs"), F.to_json("s.w").alias("w"), "s.text").collect():
        if r.k < 99:
            want = FREE[r.k][2]
            assert (r.v, r.vs, r.w, r.text) == (want, f"[{want}]", want, "true")


def test_long_free_form_texts(spark):
    """Pieces are matched without recursion, so long texts of escapes do not overflow."""
    text = '\\"' * 200_000 + "true"
    row = spark.sql("SELECT 1 AS k").withColumn("j", F.lit(f'["{text}",true]'))
    assert row.select(items.bools_to_texts(F.col("j"))).first()[0] == f'["{text}","true"]'
