"""Domain tables: columns, keys, indexes and the fixed column lists built on them."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame

# ---------------------------------------------------------------------------
# Enumerations and allowed labels.
TABLE_TYPES = ("source", "destination", "lookup", "intermediate")
DATA_FORMATS = ("parquet", "json", "csv", "avro", "delta")
RUN_STATUSES = ("pending", "running", "success", "failed", "cancelled", "skipped")
TERMINAL_STATUSES = ("success", "failed", "cancelled")
LOG_LEVELS = ("debug", "info", "warning", "error", "critical")
ENVIRONMENTS = ("dev", "staging", "prod", "test")
DEPLOY_ENVIRONMENTS = ("dev", "staging", "prod")
ENDPOINT_TYPES = ("s3", "database", "api", "warehouse", "kafka", "file", "stream")
TRIGGER_TYPES = ("manual", "schedule", "event", "dependency", "api", "retry")
CACHE_LEVELS = (
    "MEMORY_ONLY", "MEMORY_AND_DISK", "MEMORY_ONLY_SER", "MEMORY_AND_DISK_SER", "DISK_ONLY",
)
LOCATION_SCHEMES = ("s3://", "hdfs://", "file://", "gs://", "wasbs://", "/")
MAX_ITEM_BYTES = 400 * 1024
DEFAULT_PAGE = 100
# ---------------------------------------------------------------------------


@dataclass(frozen=True)
class Index:
    """A named (partition column, sort column) pair.

    Not a second copy of the data: reading through it is a filter, an order and a
    projection. It is sparse, so rows with a null in either column are outside it.
    """

    name: str
    partition: str
    sort: str | None = None
    projection: tuple[str, ...] | None = None


@dataclass(frozen=True)
class TableMeta:
    name: str
    keys: tuple[str, ...]
    fields: dict[str, str]
    indexes: tuple[Index, ...] = ()
    list_columns: tuple[str, ...] = ()
    view_columns: tuple[str, ...] = ()
    summary_columns: tuple[str, ...] = ()

    def __post_init__(self):
        if not self.keys:
            raise ValueError(f"{self.name}: at least one key column is needed")

    @property
    def ddl(self) -> str:
        return ", ".join(f"`{name}` {kind}" for name, kind in self.fields.items())

    @property
    def index_names(self) -> list[str]:
        return [i.name for i in self.indexes]

    def index(self, name: str) -> Index:
        for candidate in self.indexes:
            if candidate.name == name:
                return candidate
        raise ValueError(f"index '{name}' not found on {self.name}; choices: {self.index_names}")

    def indexes_on(self, partition: str) -> list[Index]:
        return [i for i in self.indexes if i.partition == partition]

    def key(self, **values) -> dict:
        """The full key taken from ``values``; a missing part is an error."""
        missing = [k for k in self.keys if k not in values]
        if missing:
            raise ValueError(f"{self.name}: missing key part(s) {missing}")
        return {k: values[k] for k in self.keys}

    def require_keys(self, df: DataFrame) -> DataFrame:
        missing = [k for k in self.keys if k not in df.columns]
        if missing:
            raise ValueError(f"{self.name}: missing key column(s) {missing}")
        return df


# ---------------------------------------------------------------------------
# Columns, keys, indexes and column lists of the three domains.
STAGE = (
    "STRUCT<stage_name: STRING, status: STRING, start_time: TIMESTAMP, end_time: TIMESTAMP, "
    "duration_seconds: DECIMAL(38,18), records_processed: BIGINT, error_message: STRING>"
)
DQ_RESULT = (
    "STRUCT<check_name: STRING, passed: BOOLEAN, expected_value: VARIANT, "
    "actual_value: VARIANT, error_message: STRING>"
)

PIPELINES = TableMeta(
    name="pipeline_config",
    keys=("pipeline_id",),
    fields={
        "pipeline_id": "STRING", "pipeline_name": "STRING", "description": "STRING",
        "config": "VARIANT", "source_type": "STRING", "source_config": "VARIANT",
        "destination_type": "STRING", "destination_config": "VARIANT",
        "schedule_expression": "STRING", "is_active": "BOOLEAN", "environment": "STRING",
        "version": "STRING", "spark_config": "VARIANT", "cpu_cores": "BIGINT",
        "memory_gb": "DECIMAL(38,18)", "tags": "MAP<STRING,STRING>",
        "created_at": "TIMESTAMP", "updated_at": "TIMESTAMP",
        "created_by": "STRING", "updated_by": "STRING",
    },
    indexes=(
        Index("ActivePipelinesIndex", "is_active", "updated_at"),
        Index("EnvironmentIndex", "environment", "created_at"),
    ),
    list_columns=(
        "pipeline_id", "pipeline_name", "source_type", "destination_type",
        "is_active", "environment", "created_at", "updated_at",
    ),
    view_columns=(
        "pipeline_id", "pipeline_name", "description", "source_type", "destination_type",
        "is_active", "schedule_expression", "environment", "version", "tags",
        "created_at", "updated_at", "created_by", "updated_by",
    ),
    summary_columns=("pipeline_id", "pipeline_name", "is_active", "environment", "updated_at"),
)

TABLES = TableMeta(
    name="table_config",
    keys=("table_id",),
    fields={
        "table_id": "STRING", "pipeline_id": "STRING", "table_name": "STRING",
        "table_type": "STRING", "data_format": "STRING", "schema_definition": "VARIANT",
        "partition_columns": "ARRAY<STRING>", "primary_key_columns": "ARRAY<STRING>",
        "location": "STRING", "connection_config": "VARIANT", "read_options": "VARIANT",
        "write_options": "VARIANT", "validation_rules": "VARIANT",
        "data_quality_checks": "VARIANT", "caching_enabled": "BOOLEAN", "cache_level": "STRING",
        "retention_days": "BIGINT", "archive_after_days": "BIGINT", "environment": "STRING",
        "is_active": "BOOLEAN", "description": "STRING", "tags": "MAP<STRING,STRING>",
        "last_updated_data": "TIMESTAMP", "record_count": "BIGINT", "size_bytes": "BIGINT",
        "created_at": "TIMESTAMP", "updated_at": "TIMESTAMP",
        "created_by": "STRING", "updated_by": "STRING",
    },
    indexes=(
        Index("PipelineTablesIndex", "pipeline_id", "table_type"),
        Index("TableTypeIndex", "table_type", "pipeline_id"),
    ),
    list_columns=(
        "table_id", "pipeline_id", "table_name", "table_type", "data_format",
        "location", "is_active", "created_at", "updated_at",
    ),
    view_columns=(
        "table_id", "pipeline_id", "table_name", "table_type", "data_format", "location",
        "environment", "is_active", "description", "tags", "last_updated_data",
        "record_count", "size_bytes", "created_at", "updated_at", "created_by", "updated_by",
    ),
    summary_columns=(
        "table_id", "table_name", "table_type", "data_format", "is_active", "record_count",
    ),
)

RUNS = TableMeta(
    name="pipeline_run_logs",
    keys=("run_id", "pipeline_id"),
    fields={
        "run_id": "STRING", "pipeline_id": "STRING", "status": "STRING",
        "trigger_type": "STRING", "start_time": "TIMESTAMP", "end_time": "TIMESTAMP",
        "duration_seconds": "DECIMAL(38,18)", "stages": f"ARRAY<{STAGE}>",
        "current_stage": "STRING", "total_records_processed": "BIGINT",
        "total_records_failed": "BIGINT", "input_data_size_bytes": "BIGINT",
        "output_data_size_bytes": "BIGINT", "spark_application_id": "STRING",
        "cpu_hours": "DECIMAL(38,18)", "memory_usage_gb": "DECIMAL(38,18)",
        "data_quality_results": f"ARRAY<{DQ_RESULT}>", "data_quality_passed": "BOOLEAN",
        "error_message": "STRING", "error_stack_trace": "STRING", "retry_count": "BIGINT",
        "pipeline_version": "STRING", "config_snapshot": "VARIANT", "environment": "STRING",
        "spark_version": "STRING", "python_version": "STRING", "input_tables": "ARRAY<STRING>",
        "output_tables": "ARRAY<STRING>", "log_level": "STRING", "log_messages": "VARIANT",
        "monitoring_urls": "MAP<STRING,STRING>", "tags": "MAP<STRING,STRING>",
        "created_by": "STRING", "created_at": "TIMESTAMP", "updated_at": "TIMESTAMP",
    },
    indexes=(
        Index("PipelineRunsIndex", "pipeline_id", "start_time"),
        Index("StatusRunsIndex", "status", "start_time"),
    ),
    list_columns=(
        "run_id", "pipeline_id", "status", "trigger_type", "start_time", "end_time",
        "duration_seconds", "created_by", "created_at", "updated_at",
    ),
    view_columns=(
        "run_id", "pipeline_id", "status", "trigger_type", "start_time", "end_time",
        "duration_seconds", "total_records_processed", "total_records_failed",
        "error_message", "retry_count", "environment", "pipeline_version",
        "data_quality_passed", "created_by", "tags", "created_at", "updated_at",
    ),
    summary_columns=(
        "run_id", "pipeline_id", "status", "start_time", "duration_seconds", "error_message",
    ),
)

# ---------------------------------------------------------------------------

DOMAINS = {meta.name: meta for meta in (PIPELINES, TABLES, RUNS)}


def physical_name(base: str, environment: str = "dev", prefix: str = "") -> str:
    """``prefix_environment_base``; production carries no environment part."""
    check_environment(environment)
    return "_".join(p for p in (prefix, "" if environment == "prod" else environment, base) if p)


def check_environment(environment: str) -> str:
    if environment not in DEPLOY_ENVIRONMENTS:
        raise ValueError(f"environment must be one of {list(DEPLOY_ENVIRONMENTS)}")
    return environment
