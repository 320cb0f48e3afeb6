"""Commands applied to a small state: exact states and outcomes."""

from collections import Counter
from datetime import datetime
from decimal import Decimal
from functools import reduce

import pytest
from pyspark.sql import functions as F

from opsframe.functions.fits import as_column, misfit_at, row_misfit
from opsframe.operators import lifecycle, write

T0, NOW = datetime(2024, 1, 1), datetime(2024, 2, 1)
K = ["pipeline_id"]
DDL = ("pipeline_id string, name string, is_active boolean, cores bigint, tags map<string,string>, "
       "updated_by string, created_at timestamp, updated_at timestamp")


@pytest.fixture(scope="module")
def state(spark):
    return spark.createDataFrame(
        [("p1", "one", True, 1, {"a": "b"}, None, T0, T0), ("p2", "two", False, 2, None, None, T0, T0)], DDL)


def by_key(df):
    return {r.pipeline_id: r for r in df.collect()}


def outcomes(change):
    return sorted(((r.pipeline_id, r.outcome, r.reason, r.commands) for r in change.outcomes.collect()), key=repr)


def test_insert_twice_conflicts_and_changes_nothing(spark, state):
    c = spark.createDataFrame([("p1", "again", 1), ("p3", "three", 2), ("p3", "late", 3), (None, "x", 4)],
                              "pipeline_id string, name string, seq int")
    change = write.insert_if_absent(state, c, K, NOW, ["seq"])
    rows = by_key(change.state)
    assert rows["p1"].name == "one" and rows["p3"].name == "three"
    assert rows["p3"].created_at == rows["p3"].updated_at == NOW
    assert change.state.columns == state.columns
    assert outcomes(change) == [
        ("p1", "conflict", "key exists", 1), ("p3", "applied", None, 1),
        ("p3", "conflict", "inserted by an earlier command", 1), (None, "invalid", "key missing", 1)]
    with pytest.raises(write.WriteError):
        write.strict(change)


def test_partial_update_folds_field_by_field(spark, state):
    c = spark.createDataFrame([
        ("p1", {"name": "first", "cores": "7"}, 1),
        ("p1", {"name": None}, 2),              # writes null on purpose
        ("p2", {"is_active": "true", "tags": '{"x":"y"}'}, 1),
        ("zz", {"name": "nobody"}, 1),
        ("p2", {}, 2), ("p2", {"cores": "many"}, 3), ("p2", {"colour": "red"}, 4), ("p2", {"pipeline_id": "p9"}, 5),
    ], "pipeline_id string, fields map<string,string>, seq int")
    change = write.partial_update(state, c, K, NOW, ["seq"])
    rows = by_key(change.state)
    assert (rows["p1"].name, rows["p1"].cores, rows["p1"].is_active, rows["p1"].tags) == (None, 7, True, {"a": "b"})
    assert (rows["p2"].name, rows["p2"].is_active, rows["p2"].tags, rows["p2"].cores) == ("two", True, {"x": "y"}, 2)
    assert rows["p1"].updated_at == NOW and rows["p1"].created_at == T0
    assert outcomes(change) == [
        ("p1", "applied", None, 2), ("p2", "applied", None, 1),
        ("p2", "invalid", "cannot set colour", 1), ("p2", "invalid", "cannot set pipeline_id", 1),
        ("p2", "invalid", "cores is not bigint", 1), ("p2", "invalid", "no fields", 1),
        ("zz", "not_found", None, 1)]


def test_update_of_a_missing_key_changes_nothing(spark, state, rows):
    c = spark.createDataFrame([("zz", {"name": "x"}, 1)], "pipeline_id string, fields map<string,string>, seq int")
    change = write.partial_update(state, c, K, NOW, ["seq"])
    assert rows(change.state) == rows(state)


def test_conditional_update_is_an_optimistic_lock(spark, state):
    c = spark.createDataFrame([("p1", 1, 5, 1), ("p1", 1, 6, 2), ("p2", 9, 5, 1), ("zz", 1, 1, 1)],
                              "pipeline_id string, expected bigint, cores bigint, seq int")
    change = write.conditional_update(state, c, K, NOW, ["seq"], F.col("s.cores") == F.col("c.expected"),
                                      {"cores": F.col("c.cores")})
    rows = by_key(change.state)
    assert rows["p1"].cores == 5 and rows["p1"].updated_at == NOW
    assert rows["p2"].cores == 2 and rows["p2"].updated_at == T0
    assert outcomes(change) == [
        ("p1", "applied", None, 1), ("p1", "conflict", "an earlier command for this key was applied", 1),
        ("p2", "conflict", "condition not met", 1), ("zz", "not_found", None, 1)]


def test_status_and_statistics_change_only_what_is_given(spark, state):
    c = spark.createDataFrame([("p1", False, None, 1), ("p2", True, "ann", 1), ("p2", None, None, 2)],
                              "pipeline_id string, is_active boolean, updated_by string, seq int")
    change = write.set_status(state, c, K, NOW, ["seq"])
    rows = by_key(change.state)
    assert (rows["p1"].is_active, rows["p1"].updated_by) == (False, None)
    assert (rows["p2"].is_active, rows["p2"].updated_by) == (True, "ann")
    assert ("p2", "invalid", "nothing given", 1) in outcomes(change)

    tables = spark.createDataFrame([("t1", 1, 10, None), ("t2", 2, 20, T0)],
                                   "table_id string, record_count bigint, size_bytes bigint, last_updated_data timestamp")
    told = spark.createDataFrame([("t1", 100, None, None, 1), ("t1", None, 5, NOW, 2)],
                                 "table_id string, record_count bigint, size_bytes bigint, last_updated_data timestamp, seq int")
    done = {r.table_id: tuple(r)[1:] for r in write.update_stats(tables, told, ["table_id"], NOW, ["seq"]).state.collect()}
    assert done == {"t1": (100, 5, NOW), "t2": (2, 20, T0)}


def test_delete(spark, state):
    c = spark.createDataFrame([("p1",), ("p1",), ("zz",)], "pipeline_id string")
    gone = write.delete_keys(state, c, K)
    assert set(by_key(gone.state)) == {"p2"} and set(by_key(gone.removed)) == {"p1"}
    assert outcomes(gone) == [
        ("p1", "applied", None, 1), ("p1", "not_found", None, 1), ("zz", "not_found", None, 1)]


def test_conditional_delete(spark, state):
    c = spark.createDataFrame([("p1",), ("p2",), ("p2",), ("zz",)], "pipeline_id string")
    gone = write.delete_keys(state, c, K, condition=~F.col("is_active"))
    assert set(by_key(gone.state)) == {"p1"} and set(by_key(gone.removed)) == {"p2"}
    assert outcomes(gone) == [
        ("p1", "conflict", "condition not met", 1), ("p2", "applied", None, 1),
        ("p2", "not_found", None, 1), ("zz", "not_found", None, 1)]


def test_conditional_put(spark, state):
    c = spark.createDataFrame([("p1", "uno", 1, 1), ("p2", "dos", 1, 1), ("p9", "new", 1, 1), ("p1", "late", 1, 2)],
                              "pipeline_id string, name string, cores bigint, seq int")
    locked = write.conditional_put(state, c, K, NOW, ["seq"], F.col("s.cores") == F.col("c.cores"))
    rows = by_key(locked.state)
    assert (rows["p1"].name, rows["p1"].created_at, rows["p1"].updated_at) == ("uno", T0, NOW)
    assert rows["p2"].name == "two" and "p9" not in rows
    assert outcomes(locked) == [
        ("p1", "applied", None, 1), ("p1", "conflict", "an earlier command for this key was applied", 1),
        ("p2", "conflict", "condition not met", 1), ("p9", "conflict", "condition not met", 1)]
    fresh = write.conditional_put(state, c, K, NOW, ["seq"], F.col("s.pipeline_id").isNull())
    assert by_key(fresh.state)["p9"].created_at == NOW and by_key(fresh.state)["p1"].name == "one"


def test_upsert_keeps_created_at_and_takes_the_last(spark, state):
    c = spark.createDataFrame([("p1", "uno", 2), ("p1", "old", 1), ("p9", "nine", 1)],
                              "pipeline_id string, name string, seq int")
    change = write.upsert(state, c, K, NOW, ["seq"])
    rows = by_key(change.state)
    assert (rows["p1"].name, rows["p1"].created_at, rows["p1"].updated_at) == ("uno", T0, NOW)
    assert rows["p1"].cores is None  # the whole row is replaced
    assert (rows["p9"].created_at, rows["p2"].name) == (NOW, "two")
    assert len(rows) == 3


def test_size_gate_rejects_the_whole_batch(spark, state, rows):
    c = spark.createDataFrame([("a", "x", 1), ("big", "x" * 450_000, 2), ("b", "y", 3)],
                              "pipeline_id string, name string, seq int")
    assert len(by_key(write.upsert_many(state, c, K, NOW, ["seq"]).state)) == 5  # no gate unless asked for
    change = write.upsert_many(state, c, K, NOW, ["seq"], max_bytes=400 * 1024)
    assert rows(change.state) == rows(state)
    assert outcomes(change) == [
        ("a", "conflict", "batch rejected", 1), ("b", "conflict", "batch rejected", 1),
        ("big", "invalid", "item too large", 1)]
    assert len(by_key(write.upsert_many(state, c.where("pipeline_id <> 'big'"), K, NOW, ["seq"]).state)) == 4


def test_empty_batches(spark, state, rows):
    none = spark.createDataFrame([], "pipeline_id string, name string, fields map<string,string>, seq int")
    for change in (write.upsert_many(state, none, K, NOW, ["seq"]),
                   write.insert_if_absent(state, none, K, NOW, ["seq"]),
                   write.partial_update(state, none, K, NOW, ["seq"]),
                   write.activate_pipelines(state, none, K, NOW)):
        assert rows(change.state) == rows(state) and change.outcomes.count() == 0


def test_activate_all_or_none(spark, state, rows):
    both = spark.createDataFrame([("p1",), ("p2",)], "pipeline_id string")
    on = write.activate_pipelines(state, both, K, NOW, by="ann")
    assert all(r.is_active and r.updated_at == NOW and r.updated_by == "ann" for r in on.state.collect())
    off = write.activate_pipelines(on.state, both, K, NOW, active=False)
    assert not any(r.is_active for r in off.state.collect())
    bad = write.activate_pipelines(state, both.union(spark.createDataFrame([("zz",)], "pipeline_id string")), K, NOW)
    assert rows(bad.state) == rows(state)
    assert outcomes(bad) == [
        ("p1", "conflict", "batch rejected", 1), ("p2", "conflict", "batch rejected", 1), ("zz", "not_found", None, 1)]


def test_tables_must_belong_to_the_pipeline(spark, rows):
    tables = spark.createDataFrame([("t1", "a", False), ("t2", "b", False)], "table_id string, pipeline_id string, is_active boolean")
    ids = tables.select("table_id")
    assert rows(write.activate_tables(tables, ids, ["table_id"], NOW, "a").state) == rows(tables)
    done = write.activate_tables(tables, ids.where("table_id = 't1'"), ["table_id"], NOW, "a").state
    assert rows(done) == [("t1", "a", True), ("t2", "b", False)]
    with pytest.raises(ValueError):
        write.activate_tables(tables, ids.where("false"), ["table_id"], NOW, "a")


def test_archive_and_purge(spark, rows):
    pipelines = spark.createDataFrame(
        [("p1", "dev", False, T0), ("p2", "dev", True, T0), ("p3", "prod", False, T0), ("p4", "dev", False, NOW)],
        "pipeline_id string, environment string, is_active boolean, updated_at timestamp")
    marked = lifecycle.archive_pipelines(pipelines, "dev", datetime(2024, 2, 5), 30, "ann")
    assert rows(marked.where("archived"), "pipeline_id", "archived_by") == [("p1", "ann")]
    tables = spark.createDataFrame([("t1", T0), ("t2", None), ("t3", datetime(2024, 1, 2))],
                                   "table_id string, last_updated_data timestamp")
    kept = lifecycle.archive_tables(tables, NOW, 30)
    assert rows(kept.where("archived"), "table_id") == [("t1",)]  # strictly older; never without data
    runs = spark.createDataFrame([("r1", T0), ("r2", datetime(2024, 1, 2))], "run_id string, start_time timestamp")
    assert rows(lifecycle.purge_runs(runs, NOW, 30), "run_id") == [("r2",)]
    assert rows(lifecycle.purged_runs(runs, NOW, 30), "run_id") == [("r1",)]


def test_the_command_that_holds_is_not_hidden_by_an_earlier_one(spark, state):
    """The row is at 1: who expects 9 fails, who expects 1 comes second and is applied."""
    c = spark.createDataFrame([("p1", 9, 50, 1), ("p1", 1, 60, 2), ("p1", 1, 70, 3), ("p1", 9, 80, 4), (None, 1, 1, 1)],
                              "pipeline_id string, expected bigint, cores bigint, seq int")
    change = write.conditional_update(state, c, K, NOW, ["seq"], F.col("s.cores") == F.col("c.expected"), {"cores": F.col("c.cores")})
    assert by_key(change.state)["p1"].cores == 60
    assert sorted(outcomes(change), key=repr) == sorted([
        ("p1", "applied", None, 1), ("p1", "conflict", "condition not met", 1),
        ("p1", "conflict", "an earlier command for this key was applied", 2), (None, "invalid", "key missing", 1)], key=repr)
    put = write.conditional_put(state, c.drop("expected"), K, NOW, ["seq"], F.col("c.cores") > 65)
    assert by_key(put.state)["p1"].cores == 70
    assert ("p1", "conflict", "condition not met", 2) in outcomes(put)


def test_a_value_that_does_not_fit_is_an_outcome(spark, state):
    c = spark.createDataFrame([("p1", "x", 1), ("p2", "7", 1), ("p8", "y", 1), ("p9", "8", 1)], "pipeline_id string, cores string, seq int")
    unfit = "cores is not bigint"
    change = write.upsert(state, c, K, NOW, ["seq"])
    rows = by_key(change.state)
    assert (rows["p1"].cores, rows["p2"].cores, rows["p9"].cores) == (1, 7, 8) and "p8" not in rows
    assert outcomes(change) == [("p1", "invalid", unfit, 1), ("p2", "applied", None, 1), ("p8", "invalid", unfit, 1), ("p9", "applied", None, 1)]
    fresh = write.insert_if_absent(state, c, K, NOW, ["seq"])
    assert outcomes(fresh) == [("p1", "invalid", unfit, 1), ("p2", "conflict", "key exists", 1), ("p8", "invalid", unfit, 1), ("p9", "applied", None, 1)]
    told = write.update_given(state, c, K, NOW, ["seq"], ["cores"])
    assert (by_key(told.state)["p1"].cores, by_key(told.state)["p2"].cores) == (1, 7)
    put = write.conditional_put(state, c, K, NOW, ["seq"], F.lit(True))
    assert ("p1", "invalid", unfit, 1) in outcomes(put) and by_key(put.state)["p2"].cores == 7


def test_nested_values_that_do_not_fit_are_refused(spark):
    s = spark.createDataFrame([("p1", [("x", 1)])], "pipeline_id string, parts array<struct<name: string, n: bigint>>")
    c = spark.createDataFrame([("p1", {"parts": '[{"name":"y","n":"oops"}]'}, 1), ("p1", {"parts": "[{"}, 2), ("p1", {"parts": '[{"name":"z"}]'}, 3)],
                              "pipeline_id string, fields map<string,string>, seq int")
    change = write.partial_update(s, c.where("seq < 3"), K, NOW, ["seq"])
    assert [tuple(p) for p in change.state.first().parts] == [("x", 1)]
    assert outcomes(change) == [
        ("p1", "invalid", "parts is not array<struct<name:string,n:bigint>>", 1), ("p1", "invalid", "parts[].n is not bigint", 1)]
    assert [tuple(p) for p in write.partial_update(s, c, K, NOW, ["seq"]).state.first().parts] == [("z", None)]


# -- values, keys and orders that do not fit ----------------------------------------------

FIT_DDL = ("id bigint, n bigint, price decimal(10,0), day date, sizes array<int>, limits map<int,bigint>, "
           "box struct<a:int,b:array<double>>, updated_at timestamp")


@pytest.fixture(scope="module")
def fit_state(spark):
    return spark.createDataFrame([(1, 10, Decimal(5), None, [1], {1: 1}, (1, [0.5]), T0), (2, 20, Decimal(6), None, None, None, None, T0)], FIT_DDL)


MISFITS = [
    ("'x' AS n", "n is not bigint"), ("'1.9' AS n", "n is not bigint"), ("1.9D AS n", "n is not bigint"),
    ("CAST(1.60 AS DECIMAL(10,2)) AS price", "price is not decimal(10,0)"), ("'1.60' AS price", "price is not decimal(10,0)"),
    ("TIMESTAMP_NTZ '2024-01-01 10:00:00' AS day", "day is not date"), ("array('x', '3') AS sizes", "sizes[] is not int"),
    ("array(1.5D, 2D) AS sizes", "sizes[] is not int"), ("7 AS sizes", "sizes is not array<int>"),
    ("map('k', 1) AS limits", "limits{key} is not int"), ("map('1', 1, '01', 2) AS limits", "limits{key} repeats"),
    ("map(1, '2.5') AS limits", "limits{} is not bigint"), ("named_struct('a', 'x') AS box", "box.a is not int"),
    ("named_struct('b', array('y')) AS box", "box.b[] is not double"), ("named_struct('c', 1) AS box", "box.c is no field"),
]
FITS = [
    ("'7' AS n", "n", 7), ("7.0D AS n", "n", 7), ("CAST(NULL AS STRING) AS n", "n", None), ("2.00BD AS price", "price", 2),
    ("array('4', NULL) AS sizes", "sizes", [4, None]), ("map('3', '9') AS limits", "limits", {3: 9}),
    ("named_struct('b', array(1), 'a', '2') AS box", "box", (2, [1.0])),
]


def test_misfits_are_told_by_their_path(spark, fit_state):
    for k in range(0, len(MISFITS), 8):
        some = [(spark.range(1).selectExpr(value), value.rsplit(" ", 1)[1], reason) for value, reason in MISFITS[k:k + 8]]
        found = [c.select(misfit_at(F.col(n), c.schema[n].dataType, fit_state.schema[n].dataType, n).alias("why")) for c, n, _ in some]
        assert [r.why for r in reduce(lambda a, b: a.unionAll(b), found).collect()] == [reason for _, _, reason in some]


@pytest.mark.parametrize("value, reason", [MISFITS[2], MISFITS[6], MISFITS[12]])
def test_misfits_leave_the_state(spark, fit_state, value, reason):
    """Whole rows, assigned values and keys that exist: the state stays and the outcome tells."""
    name = value.rsplit(" ", 1)[1]
    c = spark.range(1, 2).selectExpr("id", value, "1 AS seq")
    before = sorted(fit_state.collect(), key=repr)
    for change in (
        write.upsert(fit_state, c, ["id"], NOW, ["seq"]), write.upsert_many(fit_state, c, ["id"], NOW, ["seq"], max_bytes=1 << 20),
        write.conditional_put(fit_state, c, ["id"], NOW, ["seq"], F.lit(True)),
        write.conditional_update(fit_state, c, ["id"], NOW, ["seq"], F.lit(True), {name: F.col(f"c.{name}")}),
        write.update_given(fit_state, c, ["id"], NOW, ["seq"], [name]), write.insert_if_absent(fit_state, c, ["id"], NOW, ["seq"]),
    ):
        assert [(r.id, r.outcome, r.reason, r.commands) for r in change.outcomes.collect()] == [(1, "invalid", reason, 1)]
        assert sorted(change.state.collect(), key=repr) == before


def test_values_that_fit_are_taken(spark, fit_state):
    for value, name, read in FITS[:2]:
        c = spark.range(1, 2).selectExpr("id", value, "1 AS seq")
        put = write.upsert(fit_state, c, ["id"], NOW, ["seq"])
        assert [r.outcome for r in put.outcomes.collect()] == ["applied"]
        assert put.state.where("id = 1").first()[name] == read
    for value, name, read in FITS:
        c = spark.range(1).selectExpr(value)
        assert c.select(as_column(c, fit_state, name).alias("v"), row_misfit(c, fit_state).alias("why")).collect() == [(read, None)]


TEXTS = [
    ("n", "1.9", "n is not bigint"), ("price", "1.60", "price is not decimal(10,0)"), ("day", "2024-01-01 10:00:00", "day is not date"),
    ("sizes", '["x", 3]', "sizes[] is not int"), ("sizes", "[1", "sizes is not array<int>"), ("sizes", "5", "sizes is not array<int>"),
    ("sizes", '[1],"w":[2]', "sizes is not array<int>"), ("limits", '{"k": 1}', "limits{key} is not int"), ("box", '{"b": [true]}', "box.b[] is not double"),
]


def test_texts_that_do_not_fit_are_told_by_their_path(spark, fit_state):
    data = [(1, {name: text}, k) for k, (name, text, _) in enumerate(TEXTS)]
    c = spark.createDataFrame([*data, (2, {"sizes": "[2, null]", "box": '{"a": 3}'}, 1)], "id bigint, fields map<string,string>, seq int")
    change = write.partial_update(fit_state, c, ["id"], NOW, ["seq"])
    expected = Counter((1, "invalid", reason) for _, _, reason in TEXTS) + Counter([(2, "applied", None)])
    assert {(r.id, r.outcome, r.reason): r.commands for r in change.outcomes.collect()} == expected
    rows = {r.id: r for r in change.state.collect()}
    assert rows[1] == fit_state.where("id = 1").first() and (rows[2].sizes, rows[2].box) == ([2, None], (3, None))


def test_keys_that_do_not_fit_do_not_stop_the_batch(spark, fit_state):
    c = spark.createDataFrame([("1", 7, 1), ("x", 8, 1), (None, 9, 1), ("2.5", 9, 1), ("3", 4, 1)], "id string, n bigint, seq int")
    unfit, missing = (None, "invalid", "id is not bigint", 2), (None, "invalid", "key missing", 1)
    fields = c.withColumn("fields", F.create_map(F.lit("n"), F.col("n").cast("string")))
    kept = {
        "upsert": write.upsert(fit_state, c, ["id"], NOW, ["seq"]), "many": write.upsert_many(fit_state, c, ["id"], NOW, ["seq"], 1 << 20),
        "insert": write.insert_if_absent(fit_state, c, ["id"], NOW, ["seq"]),
        "put": write.conditional_put(fit_state, c, ["id"], NOW, ["seq"], F.lit(True)),
        "update": write.conditional_update(fit_state, c, ["id"], NOW, ["seq"], F.lit(True), {"n": F.col("c.n")}),
        "given": write.update_given(fit_state, c, ["id"], NOW, ["seq"], ["n"]), "delete": write.delete_keys(fit_state, c, ["id"]),
        "partial": write.partial_update(fit_state, fields, ["id"], NOW, ["seq"]),
    }
    for name, change in kept.items():
        told = {(r.id, r.outcome, r.reason, r.commands) for r in change.outcomes.collect()}
        assert {unfit, missing} <= told and {o[0] for o in told} == {None, 1, 3}, name
    assert {r.id: r.n for r in kept["upsert"].state.collect()} == {1: 7, 2: 20, 3: 4}
    assert {r.id for r in kept["delete"].state.collect()} == {2}
    marked = fit_state.withColumn("is_active", F.lit(False))
    together = write.activate_pipelines(marked, c.where("id IN ('1', 'x')"), ["id"], NOW)
    assert together.state.where("is_active").count() == 0
    assert {(r.id, r.outcome, r.reason) for r in together.outcomes.collect()} == {
        (1, "conflict", "batch rejected"), (None, "invalid", "id is not bigint")}
