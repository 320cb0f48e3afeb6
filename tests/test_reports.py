from datetime import date, datetime

import pytest

from opsframe.operators import report

AS_OF = datetime(2024, 1, 31)


@pytest.fixture(scope="module")
def runs(spark):
    return spark.createDataFrame(
        [("r1", "a", "success", datetime(2024, 1, 30, 23, 30), 10.0),
         ("r2", "a", "failed", datetime(2024, 1, 30, 1), None),
         ("r3", "a", None, datetime(2024, 1, 29), 20.0),
         ("r4", "a", "success", datetime(2023, 1, 1), 99.0),
         ("r5", "b", "success", datetime(2024, 1, 1), 4.0)],
        "run_id string, pipeline_id string, status string, start_time timestamp, duration_seconds double")


def test_counts(spark):
    """Twenty pipelines, the first ten dev, active when the number divides by three."""
    twenty = spark.createDataFrame(
        [("dev" if i < 10 else "staging", i % 3 == 0) for i in range(20)],
        "environment string, is_active boolean")
    counted = {r.environment: r.n for r in report.count_by(twenty, "environment").collect()}
    assert counted == {"dev": 10, "staging": 10}
    assert report.count_where(twenty, twenty.is_active).first().n == 7


def test_run_report(runs):
    row = report.run_report(runs.where("pipeline_id = 'a'"), AS_OF, 30, by=()).first()
    assert row.total_runs == 3
    assert row.success_rate == pytest.approx(100 / 3)
    assert row.avg_duration_seconds == pytest.approx(10.0)  # the run without one counts as zero
    assert row.status_counts == {"success": 1, "failed": 1, "unknown": 1}
    assert row.runs_by_day == {"2024-01-29": 1, "2024-01-30": 2}


def test_empty_window_gives_zeros(runs):
    row = report.run_report(runs, datetime(2030, 1, 1), 30, by=()).first()
    assert (row.total_runs, row.success_rate, row.avg_duration_seconds) == (0, 0.0, 0.0)
    assert row.status_counts == {} and row.runs_by_day == {}
    stats = report.run_stats(runs, datetime(2030, 1, 1), by=()).first()
    assert (stats.total_runs, stats.success_rate, stats.avg_duration_seconds) == (0, 0.0, 0.0)


def test_days_follow_the_display_zone(runs):
    found = report.runs_by_day(runs.where("run_id = 'r1'"), AS_OF, 30, zone="Asia/Tokyo").first()
    assert found.day == date(2024, 1, 31)


def test_report_and_stats_agree(runs, rows):
    columns = ["pipeline_id", "total_runs", "success_rate", "avg_duration_seconds"]
    assert rows(report.run_report(runs, AS_OF), *columns) == rows(report.run_stats(runs, AS_OF), *columns)


def test_table_report(spark):
    tables = spark.createDataFrame(
        [("t1", "source", 5, 100), ("t2", "source", None, 50), ("t3", None, 7, None)],
        "table_id string, table_type string, record_count bigint, size_bytes bigint")
    row = report.table_report(tables).first()
    assert (row.total_tables, row.total_records, row.total_size_bytes) == (3, 12, 150)
    assert row.by_type == {"source": 2, "unknown": 1}
    empty = report.table_stats(tables.where("false")).first()
    assert tuple(empty) == (0, 0, 0)


def test_overview_keeps_idle_pipelines(spark, runs):
    pipelines = spark.createDataFrame([("a",), ("idle",)], "pipeline_id string")
    tables = spark.createDataFrame([("a", True), ("a", False)], "pipeline_id string, is_active boolean")
    found = {r.pipeline_id: r for r in report.overview(pipelines, tables, runs, AS_OF).collect()}
    assert (found["a"].tables, found["a"].active_tables, found["a"].total_runs) == (2, 1, 3)
    assert (found["idle"].tables, found["idle"].total_runs, found["idle"].success_rate) == (0, 0, 0.0)


def test_lineage(spark, rows):
    runs = spark.createDataFrame(
        [("r1", "a", ["t1", "t1"], ["t2"]), ("r2", "a", None, ["t2"])],
        "run_id string, pipeline_id string, input_tables array<string>, output_tables array<string>")
    assert rows(report.lineage_edges(runs)) == [
        ("r1", "a", "input", "t1"), ("r1", "a", "output", "t2"), ("r2", "a", "output", "t2")]
    tables = spark.createDataFrame([("t1",), ("t2",), ("t3",)], "table_id string")
    assert rows(report.lineage_usage(runs, tables)) == [("t1", 1, 0), ("t2", 0, 2), ("t3", 0, 0)]
