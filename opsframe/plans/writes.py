"""Registered writes: commands from order lines, parts, orders and events."""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import functions as F

from opsframe.operators import lifecycle, runs as life, write
from opsframe.plans.domains import (
    AS_OF, AS_OF_SQL, PIPELINES_SQL, RUNS_SQL, TABLES_SQL, pipelines, runs, table, tables,
)
from opsframe.plans.registering import Registry
from opsframe.session import prepare
from opsframe.sources import layout
from opsframe.sources.storage import new_path

REGISTRY = Registry()
_query = REGISTRY.query

# Order of the commands that order lines stand for.
_ORDER = ["l_shipdate", "l_orderkey", "l_linenumber", "l_suppkey", "l_extendedprice"]
_DESC = ", ".join(f"{c} DESC" for c in _ORDER)
_ASC = ", ".join(_ORDER)
_P = ["pipeline_id"]


def _lines(spark, sf_dir, *columns):
    return table(spark, sf_dir, "lineitem").selectExpr(*columns, *_ORDER)


def _sorted_outcomes(change):
    return change.outcomes.withColumn("reason", F.coalesce("reason", F.lit("")))


# -- last write per key -----------------------------------------------------------------

@_query("""SELECT l_orderkey, l_linenumber, l_shipdate, l_partkey, l_suppkey, l_quantity
FROM lineitem QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber
  ORDER BY l_shipdate DESC, l_partkey DESC, l_suppkey DESC) = 1""")
def dedup_latest(spark, sf_dir):
    return write.latest(
        table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"],
        ["l_shipdate", "l_partkey", "l_suppkey"],
    ).select("l_orderkey", "l_linenumber", "l_shipdate", "l_partkey", "l_suppkey", "l_quantity")


# -- inserts ----------------------------------------------------------------------------

def _insert(spark, sf_dir):
    c = _lines(spark, sf_dir, "l_partkey AS pipeline_id",
               "concat('order ', l_orderkey) AS pipeline_name",
               "l_returnflag AS environment", "l_linestatus = 'F' AS is_active")
    return write.insert_if_absent(pipelines(spark, sf_dir), c, _P, AS_OF, _ORDER)


@_query(f"""WITH {PIPELINES_SQL}
SELECT pipeline_id, pipeline_name, environment, is_active, created_at, updated_at FROM pipelines
UNION ALL
SELECT l_partkey, concat('order ', l_orderkey), l_returnflag, l_linestatus = 'F', {AS_OF_SQL}, {AS_OF_SQL}
FROM lineitem WHERE l_partkey NOT IN (SELECT pipeline_id FROM pipelines)
QUALIFY row_number() OVER (PARTITION BY l_partkey ORDER BY {_ASC}) = 1""")
def insert_if_absent(spark, sf_dir):
    return _insert(spark, sf_dir).state


@_query(f"""WITH {PIPELINES_SQL}, n AS (
  SELECT l_partkey AS pipeline_id, count(*) AS n,
         l_partkey IN (SELECT pipeline_id FROM pipelines) AS known FROM lineitem GROUP BY 1)
SELECT pipeline_id, 'applied' AS outcome, '' AS reason, 1::BIGINT AS commands FROM n WHERE NOT known
UNION ALL SELECT pipeline_id, 'conflict', 'key exists', n FROM n WHERE known
UNION ALL SELECT pipeline_id, 'conflict', 'inserted by an earlier command', n - 1
FROM n WHERE NOT known AND n > 1""")
def insert_outcomes(spark, sf_dir):
    return _sorted_outcomes(_insert(spark, sf_dir))


# -- updates ----------------------------------------------------------------------------

def _partial(spark, sf_dir):
    fields = """CASE l_returnflag
        WHEN 'A' THEN map('environment', l_linestatus)
        WHEN 'N' THEN map('is_active', IF(l_linestatus = 'F', 'true', 'maybe'))
        ELSE map('pipeline_name', CAST(NULL AS STRING), 'environment', 'R') END AS fields"""
    c = _lines(spark, sf_dir, "l_partkey AS pipeline_id", fields)
    return write.partial_update(pipelines(spark, sf_dir), c, _P, AS_OF, _ORDER)


_LAST = "QUALIFY row_number() OVER (PARTITION BY l_partkey ORDER BY {order}) = 1"


@_query(f"""WITH {PIPELINES_SQL},
sound AS (SELECT * FROM lineitem WHERE NOT (l_returnflag = 'N' AND l_linestatus <> 'F')),
env AS (SELECT l_partkey AS k, CASE l_returnflag WHEN 'A' THEN l_linestatus ELSE 'R' END AS v
  FROM sound WHERE l_returnflag IN ('A', 'R') {_LAST.format(order=_DESC)}),
act AS (SELECT DISTINCT l_partkey AS k FROM sound WHERE l_returnflag = 'N'),
nam AS (SELECT DISTINCT l_partkey AS k FROM sound WHERE l_returnflag = 'R'),
hit AS (SELECT DISTINCT l_partkey AS k FROM sound)
SELECT pipeline_id, CASE WHEN nam.k IS NULL THEN pipeline_name END AS pipeline_name,
  coalesce(env.v, environment) AS environment, act.k IS NOT NULL OR is_active AS is_active,
  created_at, CASE WHEN hit.k IS NULL THEN updated_at ELSE {AS_OF_SQL} END AS updated_at
FROM pipelines LEFT JOIN env ON env.k = pipeline_id LEFT JOIN act ON act.k = pipeline_id
LEFT JOIN nam ON nam.k = pipeline_id LEFT JOIN hit ON hit.k = pipeline_id""")
def partial_update(spark, sf_dir):
    return _partial(spark, sf_dir).state


@_query(f"""WITH {PIPELINES_SQL}, c AS (
  SELECT l_partkey AS pipeline_id, l_returnflag = 'N' AND l_linestatus <> 'F' AS bad FROM lineitem)
SELECT pipeline_id,
  CASE WHEN bad THEN 'invalid' WHEN pipeline_id IN (SELECT pipeline_id FROM pipelines)
       THEN 'applied' ELSE 'not_found' END AS outcome,
  CASE WHEN bad THEN 'is_active is not boolean' ELSE '' END AS reason, count(*) AS commands
FROM c GROUP BY ALL""")
def partial_update_outcomes(spark, sf_dir):
    return _sorted_outcomes(_partial(spark, sf_dir))


def _conditional(spark, sf_dir):
    c = _lines(spark, sf_dir, "l_partkey AS pipeline_id", "l_returnflag AS environment",
               "l_shipdate + make_dt_interval(1800) AS seen")
    return write.conditional_update(
        pipelines(spark, sf_dir), c, _P, AS_OF, _ORDER,
        condition=F.col("s.updated_at") < F.col("c.seen"),
        assign={"environment": F.col("c.environment")})


_TRIED_SQL = f"""tried AS (
  SELECT l_partkey AS k, l_returnflag, updated_at < l_shipdate + INTERVAL 1800 DAY AS met,
         row_number() OVER (PARTITION BY l_partkey ORDER BY {_ASC}) AS nth
  FROM lineitem LEFT JOIN pipelines ON pipeline_id = l_partkey),
firsts AS (SELECT k, arg_min(l_returnflag, nth) AS l_returnflag, min(nth) AS nth FROM tried WHERE met GROUP BY 1)"""


@_query(f"""WITH {PIPELINES_SQL}, {_TRIED_SQL}
SELECT pipeline_id, pipeline_name, is_active, created_at,
  CASE WHEN k IS NOT NULL THEN l_returnflag ELSE environment END AS environment,
  CASE WHEN k IS NOT NULL THEN {AS_OF_SQL} ELSE updated_at END AS updated_at
FROM pipelines LEFT JOIN firsts ON k = pipeline_id""")
def conditional_update(spark, sf_dir):
    return _conditional(spark, sf_dir).state


@_query(f"""WITH {PIPELINES_SQL}, {_TRIED_SQL},
t AS (SELECT tried.k AS pipeline_id, CASE WHEN met IS NULL THEN 'not_found' WHEN tried.nth = f.nth THEN 'applied'
             ELSE 'conflict' END AS outcome,
        CASE WHEN met IS NULL OR tried.nth = f.nth THEN '' WHEN tried.nth > f.nth
             THEN 'an earlier command for this key was applied' ELSE 'condition not met' END AS reason
  FROM tried LEFT JOIN firsts f ON f.k = tried.k)
SELECT pipeline_id, outcome, reason, count(*) AS commands FROM t GROUP BY ALL""")
def conditional_outcomes(spark, sf_dir):
    return _sorted_outcomes(_conditional(spark, sf_dir))


@_query(f"""WITH {PIPELINES_SQL}, last AS (
  SELECT l_partkey AS k, l_linestatus = 'F' AS v FROM lineitem {_LAST.format(order=_DESC)})
SELECT pipeline_id, pipeline_name, environment, coalesce(v, is_active) AS is_active, created_at,
  CASE WHEN k IS NULL THEN updated_at ELSE {AS_OF_SQL} END AS updated_at
FROM pipelines LEFT JOIN last ON k = pipeline_id""")
def set_status(spark, sf_dir):
    c = _lines(spark, sf_dir, "l_partkey AS pipeline_id", "l_linestatus = 'F' AS is_active")
    return write.set_status(pipelines(spark, sf_dir), c, _P, AS_OF, _ORDER).state


_STATS = ("CASE WHEN l_returnflag = 'A' THEN CAST(l_quantity AS BIGINT) END",
          "CASE WHEN l_returnflag = 'R' THEN CAST(round(l_extendedprice * 100) AS BIGINT) END")


def _stats(spark, sf_dir, key):
    c = _lines(spark, sf_dir, f"{key} AS table_id", f"{_STATS[0]} AS record_count",
               f"{_STATS[1]} AS size_bytes")
    return write.update_stats(tables(spark, sf_dir), c, ["table_id"], AS_OF, _ORDER)


@_query(f"""WITH {TABLES_SQL},
rec AS (SELECT l_partkey AS k, {_STATS[0]} AS v FROM lineitem WHERE l_returnflag = 'A' {_LAST.format(order=_DESC)}),
siz AS (SELECT l_partkey AS k, {_STATS[1]} AS v FROM lineitem WHERE l_returnflag = 'R' {_LAST.format(order=_DESC)})
SELECT tables.* REPLACE (coalesce(rec.v, record_count) AS record_count,
                         coalesce(siz.v, size_bytes) AS size_bytes)
FROM tables LEFT JOIN rec ON rec.k = table_id LEFT JOIN siz ON siz.k = table_id""")
def update_stats(spark, sf_dir):
    return _stats(spark, sf_dir, "l_partkey").state


@_query("""SELECT l_orderkey AS table_id,
  CASE WHEN l_returnflag = 'N' THEN 'invalid' WHEN l_orderkey IN (SELECT p_partkey FROM part)
       THEN 'applied' ELSE 'not_found' END AS outcome,
  CASE WHEN l_returnflag = 'N' THEN 'nothing given' ELSE '' END AS reason, count(*) AS commands
FROM lineitem GROUP BY ALL""")
def bulk_stats(spark, sf_dir):
    return _sorted_outcomes(_stats(spark, sf_dir, "l_orderkey"))


# -- deletes and upserts ----------------------------------------------------------------

def _delete(spark, sf_dir):
    c = table(spark, sf_dir, "events").selectExpr("user_id * 11 AS pipeline_id")
    return write.delete_keys(pipelines(spark, sf_dir), c, _P)


@_query(f"""WITH {PIPELINES_SQL} SELECT * FROM pipelines
WHERE pipeline_id NOT IN (SELECT user_id * 11 FROM events)""")
def delete_keys(spark, sf_dir):
    return _delete(spark, sf_dir).state


@_query(f"""WITH {PIPELINES_SQL}, n AS (
  SELECT user_id * 11 AS pipeline_id, count(*) AS n FROM events GROUP BY 1),
t AS (SELECT n.*, pipeline_id IN (SELECT pipeline_id FROM pipelines) AS known FROM n)
SELECT pipeline_id, 'applied' AS outcome, '' AS reason, 1::BIGINT AS commands FROM t WHERE known
UNION ALL SELECT pipeline_id, 'not_found', '', n - CASE WHEN known THEN 1 ELSE 0 END
FROM t WHERE n > 1 OR NOT known""")
def delete_outcomes(spark, sf_dir):
    return _sorted_outcomes(_delete(spark, sf_dir))


def _conditional_delete(spark, sf_dir):
    c = table(spark, sf_dir, "lineitem").selectExpr("l_orderkey AS pipeline_id")
    return write.delete_keys(pipelines(spark, sf_dir), c, _P, condition=~F.col("is_active"))


@_query(f"""WITH {PIPELINES_SQL} SELECT * FROM pipelines
WHERE is_active OR pipeline_id NOT IN (SELECT l_orderkey FROM lineitem)""")
def conditional_delete(spark, sf_dir):
    return _conditional_delete(spark, sf_dir).state


@_query(f"""WITH {PIPELINES_SQL}, n AS (SELECT l_orderkey AS pipeline_id, count(*) AS n FROM lineitem GROUP BY 1),
t AS (SELECT n.*, p.is_active FROM n LEFT JOIN pipelines p USING (pipeline_id))
SELECT pipeline_id, 'applied' AS outcome, '' AS reason, 1::BIGINT AS commands FROM t WHERE NOT is_active
UNION ALL SELECT pipeline_id, 'conflict', 'condition not met', n FROM t WHERE is_active
UNION ALL SELECT pipeline_id, 'not_found', '', n - 1 FROM t WHERE NOT is_active AND n > 1
UNION ALL SELECT pipeline_id, 'not_found', '', n FROM t WHERE is_active IS NULL""")
def conditional_delete_outcomes(spark, sf_dir):
    return _sorted_outcomes(_conditional_delete(spark, sf_dir))


_PUT_SQL = f"""put AS (SELECT l.*, coalesce(p.is_active, l.l_linestatus = 'F') AS met,
    row_number() OVER (PARTITION BY l_partkey ORDER BY {_ASC}) AS nth
  FROM lineitem l LEFT JOIN pipelines p ON l.l_partkey = p.pipeline_id)"""


@_query(f"""WITH {PIPELINES_SQL}, {_PUT_SQL}, firsts AS (SELECT * FROM put WHERE met
  QUALIFY row_number() OVER (PARTITION BY l_partkey ORDER BY nth) = 1),
t AS (SELECT p.*, f.* FROM pipelines p FULL JOIN firsts f ON f.l_partkey = p.pipeline_id)
SELECT coalesce(pipeline_id, l_partkey) AS pipeline_id,
  CASE WHEN met AND l_partkey IS NOT NULL THEN concat('order ', l_orderkey) ELSE pipeline_name END AS pipeline_name,
  CASE WHEN met AND l_partkey IS NOT NULL THEN l_returnflag ELSE environment END AS environment,
  CASE WHEN met AND l_partkey IS NOT NULL THEN l_linestatus = 'F' ELSE is_active END AS is_active,
  coalesce(created_at, {AS_OF_SQL}) AS created_at,
  CASE WHEN met AND l_partkey IS NOT NULL THEN {AS_OF_SQL} ELSE updated_at END AS updated_at
FROM t WHERE pipeline_id IS NOT NULL OR met""")
def conditional_put(spark, sf_dir):
    return _put(spark, sf_dir).state


@_query(f"""WITH {PIPELINES_SQL}, {_PUT_SQL},
firsts AS (SELECT l_partkey AS k, min(nth) AS first FROM put WHERE met GROUP BY 1)
SELECT l_partkey AS pipeline_id, CASE WHEN nth = first THEN 'applied' ELSE 'conflict' END AS outcome,
  CASE WHEN nth = first THEN '' WHEN nth > first THEN 'an earlier command for this key was applied'
       ELSE 'condition not met' END AS reason, count(*) AS commands
FROM put LEFT JOIN firsts ON k = l_partkey GROUP BY ALL""")
def conditional_put_outcomes(spark, sf_dir):
    return _sorted_outcomes(_put(spark, sf_dir))


def _put(spark, sf_dir):
    c = _lines(spark, sf_dir, "l_partkey AS pipeline_id",
               "concat('order ', l_orderkey) AS pipeline_name",
               "l_returnflag AS environment", "l_linestatus = 'F' AS is_active")
    return write.conditional_put(
        pipelines(spark, sf_dir), c, _P, AS_OF, _ORDER,
        condition=F.coalesce(F.col("s.is_active"), F.col("c.is_active")))


@_query(f"""WITH {PIPELINES_SQL}
SELECT coalesce(p_partkey, pipeline_id) AS pipeline_id,
  CASE WHEN p_partkey IS NULL THEN pipeline_name ELSE p_name END AS pipeline_name,
  CASE WHEN p_partkey IS NULL THEN environment ELSE p_brand END AS environment,
  CASE WHEN p_partkey IS NULL THEN is_active ELSE p_size > 25 END AS is_active,
  coalesce(created_at, {AS_OF_SQL}) AS created_at,
  CASE WHEN p_partkey IS NULL THEN updated_at ELSE {AS_OF_SQL} END AS updated_at
FROM pipelines FULL JOIN part ON p_partkey = pipeline_id""")
def upsert(spark, sf_dir):
    c = table(spark, sf_dir, "part").selectExpr(
        "p_partkey AS pipeline_id", "p_name AS pipeline_name", "p_brand AS environment",
        "p_size > 25 AS is_active")
    return write.upsert(pipelines(spark, sf_dir), c, _P, AS_OF, ["pipeline_name"]).state


@_query(f"""WITH {PIPELINES_SQL}, last AS (SELECT * FROM lineitem {_LAST.format(order=_DESC)})
SELECT coalesce(l_partkey, pipeline_id) AS pipeline_id,
  CASE WHEN l_partkey IS NULL THEN pipeline_name ELSE concat('order ', l_orderkey) END AS pipeline_name,
  CASE WHEN l_partkey IS NULL THEN environment ELSE l_returnflag END AS environment,
  CASE WHEN l_partkey IS NULL THEN is_active ELSE l_linestatus = 'F' END AS is_active,
  coalesce(created_at, {AS_OF_SQL}) AS created_at,
  CASE WHEN l_partkey IS NULL THEN updated_at ELSE {AS_OF_SQL} END AS updated_at
FROM pipelines FULL JOIN last ON l_partkey = pipeline_id""")
def upsert_many(spark, sf_dir):
    return _upserted(spark, sf_dir).state


# Order lines whose extended price is over 50,000 name their account by a text.
def _misfits(spark, sf_dir):
    return _lines(spark, sf_dir, "l_partkey AS pipeline_id", "l_returnflag AS environment",
                  "IF(l_extendedprice > 50000, 'many', IF(l_linestatus = 'F', 'true', 'false')) AS is_active")


@_query(f"""SELECT l_partkey AS pipeline_id,
  CASE WHEN l_extendedprice > 50000 THEN 'invalid' ELSE 'applied' END AS outcome,
  CASE WHEN l_extendedprice > 50000 THEN 'is_active is not boolean' ELSE '' END AS reason,
  count(*) AS commands FROM lineitem GROUP BY ALL""")
def upsert_invalid(spark, sf_dir):
    return _sorted_outcomes(write.upsert_many(
        pipelines(spark, sf_dir), _misfits(spark, sf_dir), _P, AS_OF, _ORDER, max_bytes=1 << 20))


@_query(f"""WITH {PIPELINES_SQL}, n AS (
  SELECT l_partkey AS pipeline_id, l_partkey IN (SELECT pipeline_id FROM pipelines) AS known,
    l_extendedprice > 50000 AS bad, count(*) AS n FROM lineitem GROUP BY ALL)
SELECT pipeline_id, 'applied' AS outcome, '' AS reason, 1::BIGINT AS commands FROM n WHERE NOT known AND NOT bad
UNION ALL SELECT pipeline_id, 'conflict', 'key exists', n FROM n WHERE known AND NOT bad
UNION ALL SELECT pipeline_id, 'conflict', 'inserted by an earlier command', n - 1
FROM n WHERE NOT known AND NOT bad AND n > 1
UNION ALL SELECT pipeline_id, 'invalid', 'is_active is not boolean', n FROM n WHERE bad""")
def insert_invalid(spark, sf_dir):
    return _sorted_outcomes(write.insert_if_absent(
        pipelines(spark, sf_dir), _misfits(spark, sf_dir), _P, AS_OF, _ORDER))


# Parts as rows with nested and narrow columns; order lines name them by a text, and give
# values that fit, that lose a fraction, or that are none.

def _boxes(spark, sf_dir):
    return table(spark, sf_dir, "part").selectExpr(
        "p_partkey AS part_id", "CAST(floor(p_retailprice) AS DECIMAL(10,0)) AS price", "array(p_size) AS sizes",
        "map('size', CAST(p_size AS BIGINT)) AS limits", "named_struct('size', p_size, 'tags', array(p_brand)) AS box")


_PART_KEY = "IF(l_linestatus = 'F', CAST(l_partkey AS STRING), concat('part ', l_partkey))"


def _box_commands(spark, sf_dir):
    return _lines(
        spark, sf_dir, f"{_PART_KEY} AS part_id", "CAST(l_quantity AS DECIMAL(12,2)) / 2 AS price",
        "array('7', IF(l_returnflag = 'R', 'many', '8')) AS sizes",
        "map('size', IF(l_linenumber = 1, 1.5D, 2D)) AS limits",
        "named_struct('tags', array(l_returnflag), 'size', CAST(l_linenumber AS STRING)) AS box")


# In the order of the state's columns as the commands have them.
_BOX_REASON = """CASE WHEN l_linestatus <> 'F' THEN 'part_id is not bigint'
  WHEN CAST(l_quantity AS BIGINT) % 2 = 1 THEN 'price is not decimal(10,0)'
  WHEN l_returnflag = 'R' THEN 'sizes[] is not int' WHEN l_linenumber = 1 THEN 'limits{} is not bigint' END"""
_BOX_SQL = f"""c AS (SELECT *, CASE WHEN l_linestatus = 'F' THEN l_partkey END AS part_id, {_BOX_REASON} AS why FROM lineitem)"""


@_query(f"""WITH {_BOX_SQL} SELECT part_id, CASE WHEN why IS NULL THEN 'applied' ELSE 'invalid' END AS outcome,
  coalesce(why, '') AS reason, count(*) AS commands FROM c GROUP BY ALL""")
def upsert_nested_invalid(spark, sf_dir):
    """Whole rows with nested values, fractions and keys of another type."""
    return _sorted_outcomes(write.upsert(_boxes(spark, sf_dir), _box_commands(spark, sf_dir), ["part_id"], AS_OF, _ORDER))


@_query(f"""WITH {_BOX_SQL}, last AS (SELECT * FROM c WHERE why IS NULL {_LAST.format(order=_DESC)})
SELECT p_partkey AS part_id, CASE WHEN l_partkey IS NULL THEN CAST(floor(p_retailprice) AS BIGINT) ELSE CAST(l_quantity AS BIGINT) // 2 END AS price,
  CASE WHEN l_partkey IS NULL THEN p_size ELSE 7 END AS size, CASE WHEN l_partkey IS NULL THEN p_size ELSE 2 END AS most,
  CASE WHEN l_partkey IS NULL THEN p_size ELSE CAST(l_linenumber AS INTEGER) END AS box_size,
  CASE WHEN l_partkey IS NULL THEN p_brand ELSE l_returnflag END AS tag
FROM part LEFT JOIN last ON l_partkey = p_partkey
UNION ALL SELECT part_id, CAST(l_quantity AS BIGINT) // 2, 7, 2, CAST(l_linenumber AS INTEGER), l_returnflag
FROM last WHERE part_id NOT IN (SELECT p_partkey FROM part)""")
def upsert_nested(spark, sf_dir):
    """The state after these commands: what fits is read as the columns' own types."""
    state = write.upsert(_boxes(spark, sf_dir), _box_commands(spark, sf_dir), ["part_id"], AS_OF, _ORDER).state
    return state.select("part_id", F.col("price").cast("bigint").alias("price"), F.col("sizes")[0].alias("size"),
                        F.col("limits")["size"].cast("int").alias("most"), F.col("box")["size"].alias("box_size"),
                        F.col("box")["tags"][0].alias("tag"))


_KNOWN_PART = "part_id IN (SELECT p_partkey FROM part)"


@_query(f"""WITH {_BOX_SQL}, k AS (SELECT *, {_KNOWN_PART} AS known,
    CASE WHEN part_id IS NULL THEN 'part_id is not bigint' WHEN {_KNOWN_PART} AND l_returnflag = 'R' THEN 'sizes[] is not int' END AS bad FROM c),
n AS (SELECT part_id, bad, known, count(*) AS n FROM k GROUP BY ALL)
SELECT part_id, 'invalid' AS outcome, bad AS reason, n AS commands FROM n WHERE bad IS NOT NULL
UNION ALL SELECT part_id, 'not_found', '', n FROM n WHERE bad IS NULL AND NOT known
UNION ALL SELECT part_id, 'applied', '', 1 FROM n WHERE bad IS NULL AND known
UNION ALL SELECT part_id, 'conflict', 'an earlier command for this key was applied', n - 1 FROM n WHERE bad IS NULL AND known AND n > 1""")
def conditional_invalid(spark, sf_dir):
    """Assigned values that do not fit, before any condition is asked."""
    return _sorted_outcomes(write.conditional_update(
        _boxes(spark, sf_dir), _box_commands(spark, sf_dir), ["part_id"], AS_OF, _ORDER, F.lit(True),
        {"sizes": F.col("c.sizes")}))


@_query(f"""WITH {_BOX_SQL}, n AS (SELECT part_id, why, count(*) AS n FROM c GROUP BY ALL)
SELECT part_id, 'invalid' AS outcome, why AS reason, n AS commands FROM n WHERE why IS NOT NULL
UNION ALL SELECT part_id, 'applied', '', 1 FROM n WHERE why IS NULL
UNION ALL SELECT part_id, 'conflict', 'an earlier command for this key was applied', n - 1 FROM n WHERE why IS NULL AND n > 1""")
def put_invalid(spark, sf_dir):
    return _sorted_outcomes(write.conditional_put(
        _boxes(spark, sf_dir), _box_commands(spark, sf_dir), ["part_id"], AS_OF, _ORDER, F.lit(True)))


@_query(f"""WITH {_BOX_SQL}, n AS (SELECT part_id, {_KNOWN_PART} AS known, count(*) AS n FROM c GROUP BY ALL)
SELECT part_id, 'invalid' AS outcome, 'part_id is not bigint' AS reason, n AS commands FROM n WHERE part_id IS NULL
UNION ALL SELECT part_id, 'applied', '', 1 FROM n WHERE known
UNION ALL SELECT part_id, 'not_found', '', n - CASE WHEN known THEN 1 ELSE 0 END FROM n
WHERE part_id IS NOT NULL AND (n > 1 OR NOT known)""")
def delete_invalid(spark, sf_dir):
    """Keys given as texts, of which some are no numbers."""
    return _sorted_outcomes(write.delete_keys(_boxes(spark, sf_dir), _box_commands(spark, sf_dir), ["part_id"]))


@_query(f"""WITH {_BOX_SQL} SELECT part_id, CASE WHEN part_id IS NULL OR l_returnflag = 'R' OR CAST(l_quantity AS BIGINT) % 2 = 1 THEN 'invalid'
    WHEN {_KNOWN_PART} THEN 'applied' ELSE 'not_found' END AS outcome,
  CASE WHEN part_id IS NULL THEN 'part_id is not bigint' WHEN CAST(l_quantity AS BIGINT) % 2 = 1 THEN 'price is not decimal(10,0)'
    WHEN l_returnflag = 'R' THEN 'box.size is not int' ELSE '' END AS reason, count(*) AS commands
FROM c GROUP BY ALL""")
def partial_invalid(spark, sf_dir):
    """Texts of nested values and fractions."""
    c = _lines(spark, sf_dir, f"{_PART_KEY} AS part_id", """map(
        'price', CAST(CAST(l_quantity AS DECIMAL(12,2)) / 2 AS STRING),
        'box', concat('{"size": ', IF(l_returnflag = 'R', '1.5', '3'), ', "tags": ["new"]}')) AS fields""")
    return _sorted_outcomes(write.partial_update(_boxes(spark, sf_dir), c, ["part_id"], AS_OF, _ORDER))


@_query("""WITH c AS (SELECT CASE WHEN l_linestatus = 'F' THEN l_orderkey END AS run_id,
    CASE WHEN l_linestatus <> 'F' THEN 'run_id is not bigint' WHEN l_returnflag = 'R' THEN 'l_linenumber is not int'
      WHEN CAST(l_quantity AS BIGINT) % 2 = 1 THEN 'records_processed is not bigint' END AS why FROM lineitem)
SELECT run_id, CASE WHEN why IS NOT NULL THEN 'invalid' WHEN run_id IN (SELECT o_orderkey FROM orders) THEN 'applied'
    ELSE 'not_found' END AS outcome, coalesce(why, '') AS reason, count(*) AS commands FROM c GROUP BY ALL""")
def stage_invalid(spark, sf_dir):
    """Stages with run ids, places and values of another type, some of which do not fit."""
    c = table(spark, sf_dir, "lineitem").selectExpr(
        "IF(l_linestatus = 'F', CAST(l_orderkey AS STRING), 'none') AS run_id", "l_shipdate", "l_orderkey", "l_suppkey", "l_extendedprice",
        "IF(l_returnflag = 'R', 'last', CAST(l_linenumber AS STRING)) AS l_linenumber",
        "named_struct('stage_name', 'load', 'records_processed', CAST(l_quantity AS DOUBLE) / 2) AS stage")
    return _sorted_outcomes(life.stage_append(
        _run_ids(spark, sf_dir), _staged(spark, sf_dir), c, AS_OF, _ORDER, _R))


def _upserted(spark, sf_dir):
    c = _lines(spark, sf_dir, "l_partkey AS pipeline_id",
               "concat('order ', l_orderkey) AS pipeline_name",
               "l_returnflag AS environment", "l_linestatus = 'F' AS is_active")
    return write.upsert_many(pipelines(spark, sf_dir), c, _P, AS_OF, _ORDER)


# The same state in folders by bucket: commands for parts of one brand, then deletes.
@_query(f"""WITH {TABLES_SQL}, last AS (SELECT * FROM lineitem WHERE l_partkey % 10 = 3 {_LAST.format(order=_DESC)})
SELECT tables.* REPLACE (coalesce(CAST(l_quantity AS BIGINT), record_count) AS record_count)
FROM tables LEFT JOIN last ON l_partkey = table_id
WHERE table_id NOT IN (SELECT l_partkey FROM lineitem WHERE l_partkey % 10 = 7)""")
def upsert_buckets(spark, sf_dir):
    path = new_path(prepare(spark), "tables")
    state = layout.BucketedState.create(tables(spark, sf_dir), path, ["table_id"], 16)
    told = _lines(spark, sf_dir, "CAST(l_partkey AS STRING) AS table_id", "l_partkey", "CAST(l_quantity AS BIGINT) AS record_count")
    state.apply(told.where("l_partkey % 10 = 3"), lambda s, c: write.update_stats(s, c, ["table_id"], AS_OF, _ORDER))
    again = layout.BucketedState(spark, path)
    again.apply(told.where("l_partkey % 10 = 7"), lambda s, c: write.delete_keys(s, c, ["table_id"]))
    return again.rows()


# -- all or nothing ---------------------------------------------------------------------

@_query(f"""WITH {PIPELINES_SQL}, ids AS (SELECT DISTINCT user_id AS k FROM events)
SELECT pipeline_id, pipeline_name, environment, created_at, k IS NOT NULL OR is_active AS is_active,
  CASE WHEN k IS NULL THEN updated_at ELSE {AS_OF_SQL} END AS updated_at
FROM pipelines LEFT JOIN ids ON k = pipeline_id""")
def activate_all(spark, sf_dir):
    ids = table(spark, sf_dir, "events").selectExpr("user_id AS pipeline_id")
    return write.activate_pipelines(pipelines(spark, sf_dir), ids, _P, AS_OF).state


def _rejected(spark, sf_dir):
    ids = table(spark, sf_dir, "lineitem").selectExpr("l_partkey AS pipeline_id")
    return write.activate_pipelines(pipelines(spark, sf_dir), ids, _P, AS_OF)


@_query(f"WITH {PIPELINES_SQL} SELECT * FROM pipelines")
def activate_reject(spark, sf_dir):
    return _rejected(spark, sf_dir).state


@_query(f"""WITH {PIPELINES_SQL}, ids AS (SELECT DISTINCT l_partkey AS k FROM lineitem)
SELECT k AS pipeline_id, CASE WHEN pipeline_id IS NULL THEN 'not_found' ELSE 'conflict' END AS outcome,
  CASE WHEN pipeline_id IS NULL THEN '' ELSE 'batch rejected' END AS reason, 1::BIGINT AS commands
FROM ids LEFT JOIN pipelines ON k = pipeline_id""")
def activate_reject_outcomes(spark, sf_dir):
    return _sorted_outcomes(_rejected(spark, sf_dir))


@_query(f"""WITH {TABLES_SQL} SELECT tables.* REPLACE (
  CASE WHEN pipeline_id = 'Brand#7' THEN false ELSE is_active END AS is_active) FROM tables""")
def deactivate_tables(spark, sf_dir):
    state = tables(spark, sf_dir)
    ids = table(spark, sf_dir, "part").where(F.col("p_brand") == "Brand#7").selectExpr(
        "p_partkey AS table_id")
    return write.activate_tables(state, ids, ["table_id"], AS_OF, "Brand#7", active=False).state


# -- run life cycle ---------------------------------------------------------------------

_RUN_COLUMNS = ["run_id", "pipeline_id", "status", "start_time", "end_time", "duration_seconds",
                "error_message", "updated_at"]


def _status_commands(spark, sf_dir):
    """Two commands per event: the run is taken up, then ends as its event type says."""
    return table(spark, sf_dir, "events").selectExpr(
        "event_id AS run_id", "user_id AS pipeline_id",
        "CAST(get_json_object(props, '$.k') AS BIGINT) AS k", "event_type", "ts",
        "explode(array(1, 2)) AS seq",
    ).selectExpr(
        "run_id", "pipeline_id", "seq",
        """CASE WHEN seq = 1 THEN 'running' WHEN event_type = 'signup' THEN 'success'
             WHEN event_type = 'click' THEN 'failed' WHEN event_type = 'view' THEN 'paused'
             WHEN event_type = 'error' THEN 'skipped' ELSE 'cancelled' END AS status""",
        "CASE WHEN seq = 1 THEN 'taken up' WHEN event_type = 'click' THEN 'broke' ELSE '' END AS error_message",
        "CASE WHEN seq = 2 AND k >= 50 THEN ts + make_dt_interval(0, 0, k) END AS end_time")


def _status(spark, sf_dir):
    return life.run_status_update(
        runs(spark, sf_dir), _status_commands(spark, sf_dir), AS_OF, ["seq"])


@_query(f"""WITH {RUNS_SQL}, c AS (SELECT event_id, event_type, k,
    CASE WHEN k >= 50 THEN ts + to_minutes(k) END AS given
  FROM (SELECT *, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events)),
t AS (SELECT r.*, event_type, given,
    CASE WHEN event_type IN ('signup', 'click', 'purchase') THEN coalesce(given, {AS_OF_SQL}) END AS closed
  FROM runs r JOIN c ON event_id = run_id)
SELECT run_id, pipeline_id, start_time, {AS_OF_SQL} AS updated_at,
  CASE event_type WHEN 'signup' THEN 'success' WHEN 'click' THEN 'failed' WHEN 'view' THEN 'running'
       WHEN 'error' THEN 'skipped' ELSE 'cancelled' END AS status,
  CASE WHEN event_type = 'view' THEN end_time ELSE coalesce(closed, given, end_time) END AS end_time,
  CASE WHEN closed IS NOT NULL THEN CAST(epoch_us(closed) - epoch_us(start_time) AS DOUBLE) / 1000000
       ELSE duration_seconds END AS duration_seconds,
  CASE WHEN event_type = 'click' THEN 'broke' ELSE 'taken up' END AS error_message
FROM t""")
def run_status_update(spark, sf_dir):
    return _status(spark, sf_dir).state.select(*_RUN_COLUMNS)


@_query("""SELECT event_id AS run_id, user_id AS pipeline_id, outcome, reason, n AS commands FROM (
  SELECT event_id, user_id, 'applied' AS outcome, '' AS reason,
         CASE WHEN event_type = 'view' THEN 1::BIGINT ELSE 2::BIGINT END AS n FROM events
  UNION ALL SELECT event_id, user_id, 'invalid', 'unknown status', 1 FROM events
  WHERE event_type = 'view')""")
def run_status_outcomes(spark, sf_dir):
    return _sorted_outcomes(_status(spark, sf_dir))


@_query(f"""WITH {RUNS_SQL}
SELECT run_id, pipeline_id, status, start_time, created_at FROM runs
UNION ALL SELECT o_orderkey, o_custkey, 'running',
  CASE WHEN o_orderstatus = 'F' THEN o_orderdate ELSE {AS_OF_SQL} END, {AS_OF_SQL}
FROM orders WHERE o_orderkey NOT IN (SELECT run_id FROM runs)""")
def start_runs(spark, sf_dir):
    c = table(spark, sf_dir, "orders").selectExpr(
        "o_orderkey AS run_id", "o_custkey AS pipeline_id",
        "CASE WHEN o_orderstatus = 'F' THEN o_orderdate END AS start_time")
    return life.start_runs(runs(spark, sf_dir), c, AS_OF, ["pipeline_id"], keys=["run_id"]).state.select(
        "run_id", "pipeline_id", "status", "start_time", "created_at")


@_query(f"""WITH {RUNS_SQL} SELECT run_id, pipeline_id, start_time,
  CASE status WHEN 'running' THEN 'success' WHEN 'skipped' THEN 'failed' ELSE status END AS status,
  CASE WHEN status IN ('running', 'skipped') THEN {AS_OF_SQL} ELSE end_time END AS end_time,
  CASE WHEN status IN ('running', 'skipped')
       THEN CAST(epoch_us({AS_OF_SQL}) - epoch_us(start_time) AS DOUBLE) / 1000000
       ELSE duration_seconds END AS duration_seconds,
  CASE WHEN status = 'skipped' THEN 'stopped' ELSE error_message END AS error_message,
  CASE WHEN status IN ('running', 'skipped') THEN {AS_OF_SQL} ELSE updated_at END AS updated_at
FROM runs""")
def finish_runs(spark, sf_dir):
    state = runs(spark, sf_dir)
    c = table(spark, sf_dir, "events").selectExpr(
        "event_id AS run_id", "user_id AS pipeline_id",
        """CASE event_type WHEN 'click' THEN 'success' WHEN 'view' THEN 'failed'
             ELSE 'pending' END AS status""",
        "CASE WHEN event_type = 'view' THEN 'stopped' END AS error_message")
    return life.finish_runs(state, c, AS_OF, ["run_id"]).state.select(*_RUN_COLUMNS)


@_query(f"""WITH {RUNS_SQL}, t AS (SELECT *, status = 'running' AND pipeline_id IN (
    SELECT c_custkey FROM customer WHERE c_acctbal >= 0) AS go FROM runs)
SELECT run_id, pipeline_id, start_time, CASE WHEN go THEN 'cancelled' ELSE status END AS status,
  CASE WHEN go THEN {AS_OF_SQL} ELSE end_time END AS end_time,
  CASE WHEN go THEN CAST(epoch_us({AS_OF_SQL}) - epoch_us(start_time) AS DOUBLE) / 1000000
       ELSE duration_seconds END AS duration_seconds,
  CASE WHEN go THEN 'Cancelled by ops' ELSE error_message END AS error_message,
  CASE WHEN go THEN {AS_OF_SQL} ELSE updated_at END AS updated_at
FROM t""")
def cancel_running(spark, sf_dir):
    owners = table(spark, sf_dir, "customer").where("c_acctbal >= 0").selectExpr("c_custkey AS pipeline_id")
    return life.cancel_running(runs(spark, sf_dir), AS_OF, owners, by="ops").state.select(*_RUN_COLUMNS)


# Orders as runs with two stages and two metrics; order lines add to both.
_R = ["run_id"]


def _run_ids(spark, sf_dir):
    return table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("run_id"))


def _staged(spark, sf_dir):
    return table(spark, sf_dir, "orders").selectExpr(
        "o_orderkey AS run_id", "o_orderstatus", "explode(array(0, 1)) AS n",
    ).selectExpr(
        "run_id", "IF(n = 0, 'line-1', 'check') AS stage_name", "IF(n = 0, 'pending', o_orderstatus) AS status",
        "0L AS records_processed", "CAST(NULL AS TIMESTAMP_NTZ) AS l_shipdate", "run_id AS l_orderkey",
        "n AS l_linenumber", "CAST(NULL AS BIGINT) AS l_suppkey", "CAST(NULL AS DOUBLE) AS l_extendedprice")


def _measured(spark, sf_dir):
    return table(spark, sf_dir, "orders").selectExpr(
        "o_orderkey AS run_id", "inline(array(named_struct('name', 'line-1', 'value', 0L), "
        "named_struct('name', 'checks', 'value', o_custkey)))")


def _stage_commands(spark, sf_dir):
    return _lines(
        spark, sf_dir, "l_orderkey AS run_id",
        """named_struct('stage_name', concat('line-', l_linenumber), 'status', l_linestatus,
             'records_processed', CAST(l_quantity AS BIGINT)) AS stage""",
        "map(concat('line-', l_linenumber), CAST(l_quantity AS BIGINT)) AS metrics")


def _numbered(stages):
    placed = life.positions(stages, _R, _ORDER).withColumn("pos", F.col("pos").cast("int"))
    return placed.select("run_id", "pos", "stage_name", "status", "records_processed")


_STATE_STAGES = """old AS (
  SELECT o_orderkey AS run_id, 0 AS pos, 'line-1' AS stage_name, 'pending' AS status,
         0::BIGINT AS records_processed FROM orders
  UNION ALL SELECT o_orderkey, 1, 'check', o_orderstatus, 0 FROM orders)"""


@_query(f"""WITH {_STATE_STAGES},
last AS (SELECT l_orderkey AS run_id, concat('line-', l_linenumber) AS stage_name,
    l_linestatus AS status, CAST(l_quantity AS BIGINT) AS records_processed
  FROM lineitem QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY {_DESC}) = 1),
f AS (SELECT l_orderkey AS run_id, concat('line-', l_linenumber) AS stage_name, {_ASC}
  FROM lineitem QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY {_ASC}) = 1),
added AS (SELECT run_id, CAST(1 + row_number() OVER (PARTITION BY run_id ORDER BY {_ASC}) AS INTEGER) AS pos,
    stage_name, last.status, last.records_processed
  FROM last JOIN f USING (run_id, stage_name)
  WHERE stage_name <> 'line-1' AND run_id IN (SELECT run_id FROM old))
SELECT run_id, pos, stage_name, coalesce(last.status, old.status) AS status,
  coalesce(last.records_processed, old.records_processed) AS records_processed
FROM old LEFT JOIN last USING (run_id, stage_name)
UNION ALL SELECT * FROM added""")
def stage_upsert(spark, sf_dir):
    change = life.stage_upsert(_run_ids(spark, sf_dir), _staged(spark, sf_dir),
                               _stage_commands(spark, sf_dir), AS_OF, _ORDER, _R)
    return _numbered(change.entries)


@_query(f"""WITH {_STATE_STAGES}
SELECT * FROM old
UNION ALL SELECT l_orderkey, CAST(1 + row_number() OVER (PARTITION BY l_orderkey ORDER BY {_ASC}) AS INTEGER),
  concat('line-', l_linenumber), l_linestatus, CAST(l_quantity AS BIGINT)
FROM lineitem WHERE l_orderkey IN (SELECT run_id FROM old)""")
def stage_append(spark, sf_dir):
    change = life.stage_append(_run_ids(spark, sf_dir), _staged(spark, sf_dir),
                               _stage_commands(spark, sf_dir), AS_OF, _ORDER, _R)
    return _numbered(change.entries)


@_query(f"""WITH last AS (SELECT l_orderkey AS run_id, concat('line-', l_linenumber) AS name,
    CAST(l_quantity AS BIGINT) AS value
  FROM lineitem QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY {_DESC}) = 1),
old AS (SELECT o_orderkey AS run_id, 'line-1' AS name, 0::BIGINT AS value FROM orders
  UNION ALL SELECT o_orderkey, 'checks', o_custkey FROM orders)
SELECT coalesce(old.run_id, last.run_id) AS run_id, coalesce(old.name, last.name) AS name,
  coalesce(last.value, old.value) AS value
FROM old FULL JOIN last USING (run_id, name)
WHERE coalesce(old.run_id, last.run_id) IN (SELECT o_orderkey FROM orders)""")
def metrics_merge(spark, sf_dir):
    c = _stage_commands(spark, sf_dir).drop("stage")
    return life.metrics_merge(_run_ids(spark, sf_dir), _measured(spark, sf_dir), c, AS_OF, _ORDER, _R).entries


# -- event fold -------------------------------------------------------------------------

# A user's events of one day are the log of one run.
def events_as_log(events, *more):
    return events.selectExpr(
        *more,
        "concat(user_id, '-', date_format(ts, 'yyyyMMdd')) AS run_id", "user_id AS pipeline_id",
        "event_id AS seq", "ts",
        """CASE event_type WHEN 'signup' THEN 'pending' WHEN 'click' THEN 'running'
             WHEN 'purchase' THEN 'success' WHEN 'error' THEN 'failed' END AS status""",
        "CASE WHEN event_type = 'error' THEN props ELSE '' END AS error_message",
        "CASE WHEN event_type = 'purchase' THEN ts + make_dt_interval(0, 0, 0, floor(value)) END AS end_time",
        "CASE WHEN event_type = 'view' THEN CAST(get_json_object(props, '$.k') AS BIGINT) END AS records")


FOLD_SQL = """WITH log AS (
  SELECT concat(user_id, '-', strftime(ts, '%Y%m%d')) AS run_id, user_id AS pipeline_id, event_id AS seq, ts,
    CASE event_type WHEN 'signup' THEN 'pending' WHEN 'click' THEN 'running'
         WHEN 'purchase' THEN 'success' WHEN 'error' THEN 'failed' END AS status,
    CASE WHEN event_type = 'error' THEN props END AS message,
    CASE event_type WHEN 'purchase' THEN ts + to_seconds(CAST(floor(value) AS BIGINT))
         WHEN 'error' THEN ts END AS closed,
    CASE WHEN event_type = 'view' THEN CAST(json_extract_string(props, '$.k') AS BIGINT) END AS records
  FROM events),
t AS (SELECT run_id, pipeline_id, arg_min(ts, seq) AS start_time, arg_max(ts, seq) AS updated_at,
    arg_max(status, seq) AS status, arg_max(message, seq) AS error_message,
    arg_max(closed, seq) AS end_time, CAST(sum(records) AS BIGINT) AS total_records_processed,
    count(*) AS events FROM log GROUP BY 1, 2)
SELECT run_id, pipeline_id, coalesce(status, 'pending') AS status, start_time, end_time,
  CAST(epoch_us(end_time) - epoch_us(start_time) AS DOUBLE) / 1000000 AS duration_seconds,
  error_message, total_records_processed, start_time AS created_at, updated_at, events FROM t"""


@_query(FOLD_SQL)
def fold_events(spark, sf_dir):
    folded = life.fold_events(events_as_log(table(spark, sf_dir, "events")), ["seq"])
    return folded.withColumn("duration_seconds", F.col("duration_seconds").cast("double"))


def _halves(spark, sf_dir):
    log = events_as_log(table(spark, sf_dir, "events"))
    noon = F.expr("TIMESTAMP_NTZ '2024-01-15 12:00:00'")
    return log.where(F.col("ts") < noon), log.where(F.col("ts") >= noon)


@_query(FOLD_SQL)
def merge_folds(spark, sf_dir):
    keys = list(life.KEYS)
    first, second = (life.partial_fold(half, keys, ["seq"]) for half in _halves(spark, sf_dir))
    folded = life.finish_fold(life.merge_folds(second.unionByName(first), keys), keys)
    return folded.withColumn("duration_seconds", F.col("duration_seconds").cast("double"))


@_query(f"SELECT * EXCLUDE (events) FROM ({FOLD_SQL})")
def apply_folds(spark, sf_dir):
    first, second = _halves(spark, sf_dir)
    state = life.fold_events(first, ["seq"]).drop("events")
    laid = life.apply_folds(state, life.partial_fold(second, life.KEYS, ["seq"]))
    return laid.withColumn("duration_seconds", F.col("duration_seconds").cast("double"))


# -- life-cycle jobs --------------------------------------------------------------------

_LATE = datetime(2001, 10, 1)


@_query(f"""WITH {PIPELINES_SQL}, t AS (SELECT *, environment = 'BUILDING' AND NOT is_active
  AND updated_at < TIMESTAMP '2001-10-01' - INTERVAL 90 DAY AS old FROM pipelines)
SELECT * EXCLUDE (old), old AS archived, CASE WHEN old THEN 'ops' END AS archived_by FROM t""")
def archive_pipelines(spark, sf_dir):
    return lifecycle.archive_pipelines(pipelines(spark, sf_dir), "BUILDING", _LATE, 90, "ops")


@_query(f"""WITH {TABLES_SQL}, t AS (SELECT *, coalesce(last_updated_data
  < {AS_OF_SQL} - INTERVAL 30 DAY, false) AS old FROM tables)
SELECT * EXCLUDE (old), old AS archived, CASE WHEN old THEN 'ops' END AS archived_by FROM t""")
def archive_tables(spark, sf_dir):
    return lifecycle.archive_tables(tables(spark, sf_dir), AS_OF, 30, by="ops")


@_query(f"""WITH {RUNS_SQL} SELECT run_id, pipeline_id, status, start_time FROM runs
WHERE start_time >= {AS_OF_SQL} - INTERVAL 10 DAY""")
def purge_runs(spark, sf_dir):
    kept = lifecycle.purge_runs(runs(spark, sf_dir), AS_OF, 10)
    return kept.select("run_id", "pipeline_id", "status", "start_time")


@_query(f"""WITH {RUNS_SQL} SELECT run_id, pipeline_id, status, start_time FROM runs
WHERE start_time >= {AS_OF_SQL} - INTERVAL 156 HOUR""")
def purge_days(spark, sf_dir):
    """A log by day from which whole days are dropped, and the half of one."""
    path = new_path(prepare(spark), "runs")
    layout.write_run_log(runs(spark, sf_dir).select("run_id", "pipeline_id", "status", "start_time"), path)
    layout.purge_days(spark, path, AS_OF - timedelta(hours=156))
    return layout.read_run_log(spark, path)


@_query("""SELECT event_id AS run_id, 'load' AS stage_name,
  timezone('UTC', timezone('America/Sao_Paulo', ts)) AS start_time,
  timezone('UTC', timezone('America/Sao_Paulo', ts + to_seconds(CAST(floor(value) AS BIGINT)))) AS end_time,
  timezone('UTC', timezone('America/Sao_Paulo', ts)) AS created_at FROM events""")
def normalize_utc(spark, sf_dir):
    from opsframe.functions.times import to_utc

    rows = table(spark, sf_dir, "events").selectExpr(
        "event_id AS run_id", "ts AS created_at",
        """array(named_struct('stage_name', 'load', 'start_time', ts,
             'end_time', ts + make_dt_interval(0, 0, 0, floor(value)))) AS stages""")
    return to_utc(rows, "America/Sao_Paulo").select("run_id", "created_at", F.inline("stages"))
