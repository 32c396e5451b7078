"""The registered queries: one or more per operation, each over a whole driver table.

Queries share only their input (the log files or keyed records made from a table); every
query runs its own scan, decode and operators. Each has the SQL that computes the same
answer straight from the table.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tracklake.functions import paths
from tracklake.operators import context, entities, entries, quality, wide
from tracklake.plans.ingest import Ingest
from tracklake.testkit import views

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(oracle: str | None):
    def register(run: Query) -> Query:
        QUERIES[run.__name__] = run
        if oracle is not None:
            ORACLES[run.__name__] = oracle.strip()
        return run

    return register


def fresh(made: Ingest) -> Ingest:
    return Ingest(made.files, keyed_rows=made.keyed_rows)


def only(made: Ingest, wanted: Column) -> Ingest:
    """Filter entries before anything is decoded."""
    return Ingest(None, keyed_rows=made.keyed.filter(wanted))


# Common table expressions of the SQL answers -----------------------------------------

EVENTS = """
ev AS (
  SELECT event_id, event_type, value, props, 'part-' || (event_id // 4096) AS recording, user_id % 16 AS robot,
         epoch_us(ts) - epoch_us(TIMESTAMP '2024-01-01') AS ts, (event_id * 7919) % 4099 AS pos
  FROM events)
"""
FRAMES = f"""
placed AS (SELECT *, robot * 5 + list_position({list(views.TYPES)}, event_type) AS entry_id FROM ev),
frames AS (
  SELECT recording, pos, entry_id, ts, value FROM placed
  UNION ALL SELECT DISTINCT recording, entry_id - 1000000, 0, 7, NULL FROM placed),
numbered AS (SELECT recording, row_number() OVER (PARTITION BY recording ORDER BY pos) - 1 AS seq, entry_id, ts, value FROM frames)
"""
LINES = """
ln AS (
  SELECT *, 'line-' || (l_orderkey % 64) AS recording, 1000 + l_orderkey * 8 + l_linenumber AS seq,
         CAST(l_linenumber AS BIGINT) * 1000000000000000 + l_suppkey * 100000000
           + CAST(round(l_extendedprice * 100) AS BIGINT) AS ts,
         'order/' || l_orderkey AS key
  FROM lineitem)
"""
# the last write per key and time
LWW = """
lww AS (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY recording, key, ts ORDER BY pos DESC) AS rn
                 FROM (SELECT *, 'robot/' || robot || '/' || event_type AS key FROM ev)) WHERE rn = 1)
"""


# Source: S1-S7 ------------------------------------------------------------------------

@query(f"""
WITH {EVENTS}
SELECT 'start' AS kind, count(DISTINCT (recording, robot, event_type)) AS n FROM ev
UNION ALL SELECT 'raw', count(*) FROM ev
""")
def records_by_kind(spark, sf_dir):
    return fresh(views.value_logs(spark, sf_dir)).records.groupBy("kind").agg(F.count(F.lit(1)).alias("n"))


@query(f"""
WITH {EVENTS}
SELECT DISTINCT recording, recording || '.wpilog' AS path, 256 AS version, 'header of ' || recording AS extra_header,
       'WpiLog' AS store_source, 'WpiLog' AS name FROM ev
""")
def recording_header(spark, sf_dir):
    made = fresh(views.value_logs(spark, sf_dir)).recordings
    return made.select("recording", "path", "version", "extra_header", "store_source", "name")


@query(f"""
WITH {EVENTS}
SELECT recording, robot * 5 + list_position(['click','error','purchase','signup','view'], event_type) AS entry_id,
       ts, 8 AS n_bytes, row_number() OVER (PARTITION BY recording ORDER BY pos) AS nth FROM ev
""")
def raw_records(spark, sf_dir):
    made = fresh(views.value_logs(spark, sf_dir))
    starts = made.records.filter("kind = 'start'").groupBy("recording").agg(F.count(F.lit(1)).alias("starts"))
    raw = made.records.filter("kind = 'raw'").join(starts, "recording")
    return raw.select(
        "recording", "entry_id", "ts", F.octet_length("data").alias("n_bytes"), (F.col("seq") - F.col("starts") + 1).alias("nth")
    )


# Context: C1-C3, P1, P2, P7 -----------------------------------------------------------

@query(f"""
WITH {EVENTS}
SELECT recording, ts, 'robot/' || robot || '/' || CASE WHEN pos * 2 > 4001 THEN 'late' ELSE 'early' END AS key,
       'double' AS base_type, false AS is_array FROM ev WHERE event_type <> 'error'
""")
def keyed_context(spark, sf_dir):
    return fresh(views.restarted_logs(spark, sf_dir)).keyed.select("recording", "ts", "key", "base_type", "is_array")


@query(f"""
WITH {EVENTS} SELECT recording, 1000 + robot AS entry_id, ts FROM ev WHERE event_type = 'error'
""")
def orphans(spark, sf_dir):
    made = fresh(views.restarted_logs(spark, sf_dir))
    return context.orphans(made.with_context).select("recording", "entry_id", "ts")


@query(f"""
WITH {EVENTS},
robots AS (SELECT recording, robot, row_number() OVER (PARTITION BY recording ORDER BY robot) - 1 AS nth,
                  count(*) OVER (PARTITION BY recording) AS n FROM (SELECT DISTINCT recording, robot FROM ev)),
-- places: starts, data up to 4001 (even), second starts, later data, metadata, finish
low AS (SELECT recording, count(*) FILTER (WHERE pos * 2 <= 4000) AS before_restart, count(*) AS n_data FROM ev
        GROUP BY recording)
SELECT r.recording, r.robot + 1 AS entry_id, r.nth AS start_seq, r.n + l.before_restart + r.nth AS end_seq,
       CAST(NULL AS BIGINT) AS finish_seq, 'robot/' || r.robot || '/early' AS key, 'double' AS entry_type, '{{}}' AS metadata
FROM robots r JOIN low l USING (recording)
UNION ALL
SELECT r.recording, r.robot + 1, r.n + l.before_restart + r.nth, NULL, r.n * 3 + l.n_data + r.nth,
       'robot/' || r.robot || '/late', 'double', 'robot ' || r.robot
FROM robots r JOIN low l USING (recording)
""")
def entry_defs(spark, sf_dir):
    return fresh(views.restarted_logs(spark, sf_dir)).entry_defs


# Paths: P1-P6 -------------------------------------------------------------------------

@query("""
WITH p AS (SELECT page_id, regexp_replace('NT:/' || url, '^(NT:)?/*', '') AS norm FROM pages),
c AS (SELECT *, array_to_string(list_filter(string_split(norm, '/'), lambda x: x <> ''), '/') AS cleaned FROM p)
SELECT page_id, norm, cleaned, regexp_extract(cleaned, '^(.*)/[^/]*$', 1) AS parent,
       string_split(cleaned, '/')[-1] AS last, cleaned || '/length' AS child FROM c
""")
def path_parts(spark, sf_dir):
    norm = paths.normalise_name(F.concat(F.lit("NT:/"), F.col("url")))
    cleaned = F.col("cleaned")
    named = views.table(spark, sf_dir, "pages").select("page_id", norm.alias("norm"))
    return named.withColumn("cleaned", paths.clean_path(F.col("norm"))).select(
        "page_id", "norm", "cleaned",
        paths.parent_path(cleaned).alias("parent"),
        paths.last_part(cleaned).alias("last"),
        paths.join_path(cleaned, F.lit("length")).alias("child"),
    )


@query(f"WITH {EVENTS} SELECT event_id, ts * 1000 AS nanos FROM ev")
def robotime_ns(spark, sf_dir):
    return views.events(spark, sf_dir).select("event_id", paths.robotime_nanos(F.col("t")).alias("nanos"))


# Decode: D1-D8, A4 --------------------------------------------------------------------

def _typed(name: str, leaf: str, value: str, sql: str):
    @query(f"""
    WITH {EVENTS},
    w AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY recording, robot, ts ORDER BY pos DESC) AS rn FROM ev)
          WHERE rn = 1)
    SELECT recording, 'robot/' || robot || '/{leaf}' AS key, ts, {sql} AS value FROM w
    """)
    def run(spark, sf_dir):
        made = only(fresh(views.typed_logs(spark, sf_dir)), F.endswith("key", F.lit("/" + leaf)))
        return made.entries.select("recording", "key", "ts", F.expr(value).alias("value"))

    QUERIES[name], ORACLES[name] = QUERIES.pop("run"), ORACLES.pop("run")


_typed("dec_int64", "id", "v_long", "event_id")
_typed("dec_bool", "high", "v_bool", "value > 50")
_typed("dec_string", "type", "v_string", "event_type")
_typed("dec_raw", "props", "hex(v_binary)", "hex(encode(props))")
_typed("dec_float", "single", "cast(v_float as double)", "CAST(CAST(value AS FLOAT) AS DOUBLE)")
_typed("dec_double", "value", "v_double", "value")


@query("""
SELECT 'vec-' || (vec_id // 256) AS recording, 'vec/' || vec_id || '/' || (i - 1) AS key, vec_id AS ts,
       CAST(CAST(embedding[i] AS FLOAT) AS DOUBLE) AS value, CAST(NULL AS BIGINT) AS n
FROM embeddings, unnest(generate_series(1, len(embedding))) AS u(i)
UNION ALL
SELECT 'vec-' || (vec_id // 256), 'vec/' || vec_id || '/length', vec_id, NULL, len(embedding) FROM embeddings
""")
def dec_float_array(spark, sf_dir):
    rows = fresh(views.vector_logs(spark, sf_dir)).entries
    return rows.select("recording", "key", "ts", F.col("v_float").cast("double").alias("value"), F.col("v_long").alias("n"))


@query(f"""
WITH {LINES}, w AS (
  SELECT recording, key, ts, 'int8' AS t, CAST((l_linenumber - 4) * 40 AS VARCHAR) AS value FROM ln
  UNION ALL SELECT recording, key, ts, 'int16', CAST((l_linenumber - 4) * 9000 AS VARCHAR) FROM ln
  UNION ALL SELECT recording, key, ts, 'int32', CAST(CAST(l_linenumber - 4 AS BIGINT) * 600000000 AS VARCHAR) FROM ln
  UNION ALL SELECT recording, key, ts, 'int64', CAST(CAST(l_linenumber - 4 AS BIGINT) * 2500000000000000000 AS VARCHAR) FROM ln
  UNION ALL SELECT recording, key, ts, 'uint8', CAST(l_linenumber * 36 AS VARCHAR) FROM ln
  UNION ALL SELECT recording, key, ts, 'uint16', CAST(l_linenumber * 9000 AS VARCHAR) FROM ln
  UNION ALL SELECT recording, key, ts, 'uint32', CAST(CAST(l_linenumber AS BIGINT) * 600000000 AS VARCHAR) FROM ln
  UNION ALL SELECT recording, key, ts, 'uint64', CAST(CAST(l_linenumber AS HUGEINT) * 2500000000000000000 AS VARCHAR) FROM ln)
SELECT recording, key || '/' || t || '_' AS key, ts, t AS vtype, value FROM w
""")
def dec_ints(spark, sf_dir):
    rows = fresh(views.int_structs(spark, sf_dir)).entries
    text = F.coalesce(F.col("v_long").cast("string"), F.col("v_dec").cast("string"))
    return rows.select("recording", "key", "ts", "vtype", text.alias("value"))


# Schemas and structs: T1-T9, A3, A5 ---------------------------------------------------

@query("""
WITH p AS (SELECT *, 'parts-' || (p_partkey // 128) AS recording, 'struct:P' || p_partkey AS struct_name FROM part)
SELECT recording, struct_name, p_partkey + 10 AS schema_seq, 0 AS pos, 'head' AS field, 'Head' AS type,
       p_partkey % 3 + 1 AS count, CAST(NULL AS BIGINT) AS brand FROM p
UNION ALL SELECT recording, struct_name, p_partkey + 10, 1, 'kind', 'int8', NULL, CAST(substring(p_brand, 7) AS BIGINT) FROM p
UNION ALL SELECT recording, struct_name, p_partkey + 10, 2, 'name', 'char', length(p_name), NULL FROM p
UNION ALL SELECT recording, struct_name, p_partkey + 10, 3, 'size', 'uint16', NULL, NULL FROM p
UNION ALL SELECT recording, v.* FROM (SELECT DISTINCT recording FROM p), (VALUES
  ('struct:Head', 1, 0, 'price', 'double', NULL, NULL), ('struct:Head', 1, 1, 'size', 'Size', NULL, NULL),
  ('struct:Size', 2, 0, 'w', 'int32', NULL, NULL), ('struct:Size', 2, 1, 'h', 'float', 2, NULL)) AS v
""")
def schema_fields(spark, sf_dir):
    rows = fresh(views.part_schemas(spark, sf_dir)).schema_fields
    return rows.select(
        "recording", "struct_name", "schema_seq", "pos", "field", "type", F.col("count").cast("bigint").alias("count"),
        F.try_element_at("enum", F.lit("brand")).alias("brand"),
    )


@query("""
WITH p AS (SELECT *, 'parts-' || (p_partkey // 128) AS recording, 'struct:P' || p_partkey AS struct_name,
                  p_partkey % 3 + 1 AS n, length(p_name) AS len FROM part),
h AS (SELECT p.*, i FROM p, unnest(generate_series(0, n - 1)) AS u(i)),
leaves AS (
  SELECT recording, struct_name, n, len, p_partkey, 'head/' || i || '/price' AS leaf_path, 'double' AS prim, i * 20 AS start_at, NULL AS count FROM h
  UNION ALL SELECT recording, struct_name, n, len, p_partkey, 'head/' || i || '/size/w', 'int32', i * 20 + 8, NULL FROM h
  UNION ALL SELECT recording, struct_name, n, len, p_partkey, 'head/' || i || '/size/h', 'float', i * 20 + 12, 2 FROM h
  UNION ALL SELECT recording, struct_name, n, len, p_partkey, 'kind', 'int8', n * 20, NULL FROM p
  UNION ALL SELECT recording, struct_name, n, len, p_partkey, 'name', 'char', n * 20 + 1, len FROM p
  UNION ALL SELECT recording, struct_name, n, len, p_partkey, 'size', 'uint16', n * 20 + 1 + len, NULL FROM p)
SELECT recording, struct_name, p_partkey + 10 AS schema_seq, leaf_path, prim, start_at AS "offset", CAST(count AS BIGINT) AS count,
       n * 20 + 3 + len AS struct_size FROM leaves
UNION ALL SELECT recording, v.* FROM (SELECT DISTINCT recording FROM p), (VALUES
  ('struct:Head', 2, 'price', 'double', 0, NULL, 20), ('struct:Head', 2, 'size/w', 'int32', 8, NULL, 20),
  ('struct:Head', 2, 'size/h', 'float', 12, 2, 20), ('struct:Size', 2, 'w', 'int32', 0, NULL, 12),
  ('struct:Size', 2, 'h', 'float', 4, 2, 12)) AS v
""")
def struct_layout(spark, sf_dir):
    rows = fresh(views.part_schemas(spark, sf_dir)).struct_layout
    wide = ["offset", "count", "struct_size"]
    return rows.select(
        "recording", "struct_name", "schema_seq", "leaf_path", "prim", *[F.col(c).cast("bigint").alias(c) for c in wide]
    )


@query(f"""
WITH p AS (SELECT p_partkey AS k, 'chain-' || (p_partkey // {views.CHAIN * 16}) AS recording, {views.CHAIN - 1} - p_partkey % {views.CHAIN} AS below FROM part),
whole AS (SELECT * FROM p WHERE k + below IN (SELECT k FROM p)),
leaves AS (
  SELECT *, repeat('next/', i::INT) || 'a' AS leaf_path, 'int8' AS prim, i AS "offset" FROM whole, unnest(generate_series(0, below)) AS u(i)
  UNION ALL SELECT *, below, repeat('next/', below::INT) || 'x', 'double', below + 1 FROM whole)
SELECT recording, 'struct:C' || k AS struct_name, leaf_path, prim, "offset"::BIGINT AS "offset", below + 9 AS struct_size FROM leaves
""")
def deep_structs(spark, sf_dir):
    """Structs nested twenty deep."""
    rows = fresh(views.chained_schemas(spark, sf_dir)).struct_layout
    return rows.select("recording", "struct_name", "leaf_path", "prim", *[F.col(c).cast("bigint").alias(c) for c in ("offset", "struct_size")])


@query("""
SELECT 'huge-' || (p_partkey // 128) AS recording, 'struct:C' || p_partkey AS struct_name,
       CASE WHEN p_partkey % 7 = 0 THEN 'layout too large' END AS problem,
       CASE WHEN p_partkey % 7 <> 0 THEN 4 + 8 * p_size END::BIGINT AS struct_size FROM part
""")
def huge_schema(spark, sf_dir):
    """A layout that no value can hold is flagged alone; the others are as usual."""
    rows = fresh(views.huge_schemas(spark, sf_dir)).layouts
    return rows.select("recording", "struct_name", "problem", F.when(F.col("problem").isNull(), F.col("struct_size")).alias("struct_size"))


@query(f"""
WITH p AS (SELECT 'vast-' || (p_partkey // 128) AS recording, 'struct:C' || p_partkey AS struct_name, {views.VAST}::BIGINT AS n FROM part),
leaves(path, base, strides) AS (VALUES ('h', 0, ''), ('m/q', 2, '141'), ('m/i/a', 3, '141,28'), ('m/i/b', 7, '141,28'), ('t', 2, ''))
SELECT recording, struct_name, NULL AS problem, 3 + 141 * n AS struct_size, path, (base + CASE WHEN path = 't' THEN 141 * n ELSE 0 END)::BIGINT AS "offset", strides
FROM p, leaves WHERE 3 + 141 * n < 2147483648
UNION ALL SELECT recording, struct_name, 'layout too large', NULL, NULL, NULL, NULL FROM p WHERE 3 + 141 * n >= 2147483648
""")
def vast_layouts(spark, sf_dir):
    """Layouts of millions of nested elements, none of which is made."""
    rows = fresh(views.vast_schemas(spark, sf_dir)).layouts.filter("struct_name LIKE 'struct:C%'")
    leaf = rows.select(
        "recording", "struct_name", "problem", F.when(F.col("problem").isNull(), F.col("struct_size")).alias("struct_size"),
        F.explode_outer(F.filter("leaves", lambda x: x["prim"] != "length")).alias("leaf"),
    )
    strides = F.transform("leaf.dims", lambda d: d["stride"].cast("string"))
    return leaf.select("recording", "struct_name", "problem", "struct_size", F.array_join("leaf.pieces", "/").alias("path"), "leaf.offset", F.array_join(strides, ",").alias("strides"))


def _leaf(path: str, value: str) -> str:
    return f"SELECT recording, key || '/{path}' AS key, ts, CAST({value} AS VARCHAR) AS value FROM ln"


@query(f"""
WITH {LINES}
{" UNION ALL ".join([
    _leaf("part", "l_partkey"), _leaf("supp", "l_suppkey"), _leaf("line", "l_linenumber"),
    _leaf("money/price", "CAST(round(l_extendedprice * 100) AS BIGINT)"),
    _leaf("money/tax", "CAST(round(l_tax * 100) AS BIGINT)"),
    _leaf("flag", "l_returnflag"), _leaf("status", "l_linestatus"), _leaf("pair/length", "2"),
    _leaf("pair/0", "CAST(l_quantity AS BIGINT)"), _leaf("pair/1", "l_linenumber - 4"),
    _leaf("taxed", "l_tax > 0.04"),
])}
""")
def struct_leaves(spark, sf_dir):
    rows = fresh(views.line_structs(spark, sf_dir)).entries
    cents = lambda c: F.round(F.col(c).cast("double") * 100).cast("bigint").cast("string")
    text = F.coalesce(
        F.col("v_long").cast("string"), F.col("v_string"), F.col("v_bool").cast("string"), cents("v_double"), cents("v_float")
    )
    return rows.select("recording", "key", "ts", text.alias("value"))


@query(f"""
WITH {LINES}
SELECT recording, key, ts, l_partkey AS part, l_extendedprice AS price, l_returnflag AS flag, l_linestatus AS status,
       CAST(l_quantity AS BIGINT) || ',' || (l_linenumber - 4) AS pair, l_tax > 0.04 AS taxed FROM ln
""")
def struct_wide(spark, sf_dir):
    made = fresh(views.line_structs(spark, sf_dir))
    rows = wide.wide_structs(made.with_layout, made.layouts, "struct:Line")
    return rows.select(
        "recording", "key", "ts", "value.part", F.col("value.`money/price`").alias("price"), "value.flag", "value.status",
        F.array_join(F.col("value.pair").cast("array<string>"), ",").alias("pair"), "value.taxed",
    )


@query(f"""
WITH {LINES}, el AS (SELECT ln.*, i FROM ln, unnest(generate_series(0, l_linenumber - 2)) AS u(i))
SELECT recording, key || '/length' AS key, ts, CAST(l_linenumber - 1 AS BIGINT) AS value FROM ln
UNION ALL SELECT recording, key || '/' || i || '/part', ts, l_partkey FROM el
UNION ALL SELECT recording, key || '/' || i || '/no', ts, i FROM el
""")
def struct_array(spark, sf_dir):
    return fresh(views.array_structs(spark, sf_dir)).entries.select(
        "recording", "key", "ts", F.col("v_long").alias("value")
    )


@query(f"""
WITH {LINES}
SELECT recording, key || '/inner/part' AS key, ts, l_partkey AS value, greatest(seq, 50000) AS eff FROM ln
WHERE (l_orderkey % 64) % 4 <> 3
""")
def deferred_structs(spark, sf_dir):
    return fresh(views.late_structs(spark, sf_dir)).entries.select(
        "recording", "key", "ts", F.col("v_long").alias("value"), "ord.eff"
    )


@query(f"""
WITH {LINES} SELECT 'Inner' AS missing_struct, recording, key, ts, 4 AS n_bytes FROM ln WHERE (l_orderkey % 64) % 4 = 3
""")
def unresolved(spark, sf_dir):
    rows = fresh(views.late_structs(spark, sf_dir)).unresolved
    return rows.select("missing_struct", "recording", "key", "ts", F.octet_length("data").alias("n_bytes"))


# The entry log: A1, A2, C4-C6 ---------------------------------------------------------

LAST_WRITES = """
SELECT 'part/' || l_partkey AS key, epoch_us(l_shipdate) AS ts,
       arg_max(l_quantity, (l_orderkey, l_linenumber, l_suppkey, l_extendedprice)) AS value FROM lineitem GROUP BY 1, 2
"""


@query(LAST_WRITES)
def last_write_wins(spark, sf_dir):
    return entries.entries(views.line_cells(spark, sf_dir)).select("key", "ts", F.col("v_double").alias("value"))


@query(f"""
WITH {EVENTS},
writes AS (
  SELECT recording, pos, ts - ts % 3600000000 AS ts, value, 'robot/' || robot || '/' || CASE
    WHEN event_type = 'click' AND pos >= 2000 THEN 'later' WHEN event_type IN ('error', 'signup') THEN '0' ELSE event_type END AS key FROM ev
  UNION ALL SELECT recording, pos, ts - ts % 3600000000, 1.0, 'robot/' || robot || '/length' FROM ev WHERE event_type = 'error')
SELECT recording, key, ts, arg_max(value, pos) AS value FROM writes GROUP BY recording, key, ts
""")
def contested_writes(spark, sf_dir):
    rows = fresh(views.shared_logs(spark, sf_dir)).entries
    return rows.select("recording", "key", "ts", F.coalesce("v_double", F.col("v_long").cast("double")).alias("value"))


@query(f"SELECT key, count(*) AS n, max(ts) AS last_ts, sum(value) AS total FROM ({LAST_WRITES}) GROUP BY key")
def change_set(spark, sf_dir):
    changes = entries.change_set(entries.entries(views.line_cells(spark, sf_dir)))
    return changes.groupBy("key").agg(
        F.count(F.lit(1)).alias("n"), F.max("ts").alias("last_ts"), F.sum("v_double").alias("total")
    )


LATEST = f"""
WITH {EVENTS}, {LWW}
SELECT recording, key, max(ts) AS ts, arg_max(value, ts) AS value FROM lww GROUP BY recording, key
"""


@query(LATEST)
def latest_per_key(spark, sf_dir):
    rows = entries.latest_per_key(fresh(views.value_logs(spark, sf_dir)).entries)
    return rows.select("recording", "key", "ts", F.col("v_double").alias("value"))


@query(f"WITH {EVENTS}, {LWW} SELECT recording, ts, value FROM lww WHERE key = 'robot/3/view'")
def key_series(spark, sf_dir):
    made = only(fresh(views.value_logs(spark, sf_dir)), F.col("key") == "robot/3/view")
    return entries.key_series(made.entries, "robot/3/view").select("recording", "ts", F.col("v_double").alias("value"))


@query(f"""
WITH {EVENTS}, {LWW}, c AS (SELECT event_id, recording, robot, ts FROM ev WHERE event_type = 'click'),
v AS (SELECT recording, robot, ts, value FROM lww WHERE event_type = 'view')
SELECT c.event_id, c.recording, c.ts, v.ts AS match_ts, v.value AS match_value
FROM c ASOF LEFT JOIN v ON c.recording = v.recording AND c.robot = v.robot AND c.ts >= v.ts
""")
def asof_values(spark, sf_dir):
    probes = views.events(spark, sf_dir).filter("event_type = 'click'").select(
        "recording", F.expr("concat('robot/', robot, '/view')").alias("key"), F.col("t").alias("ts"), "event_id"
    )
    found = entries.asof_values(probes, fresh(views.value_logs(spark, sf_dir)).entries)
    return found.select(
        "event_id", "recording", "ts", F.col("match.ts").alias("match_ts"), F.col("match.v_double").alias("match_value")
    )


# Entities: N1-N6, A6 ------------------------------------------------------------------

ENTITIES = f"""
{EVENTS},
robots AS (SELECT DISTINCT recording, robot, 'robot/' || robot AS entity FROM ev WHERE robot % 2 = 0),
last_values AS (
  SELECT recording, robot, event_type, ts, arg_max(value, pos) AS value FROM ev GROUP BY ALL),
written AS (  -- direct children of an entity, by time
  SELECT recording, robot, ts, event_type FROM last_values WHERE event_type IN ('purchase', 'signup')
  UNION ALL SELECT recording, robot, 0, '.type' FROM robots
  UNION ALL SELECT recording, robot, 0, '.components' FROM robots WHERE robot % 4 = 0),
direct AS (SELECT recording, robot, entity, ts, count(*) AS n_triggers FROM written JOIN robots USING (recording, robot)
           GROUP BY ALL),
listed AS (
  SELECT recording, robot, entity, 'Scalar' AS component FROM robots
  UNION ALL SELECT recording, robot, entity, 'Point3d' FROM robots WHERE robot % 4 = 2
  UNION ALL SELECT recording, robot, entity, 'Wheel' FROM robots WHERE robot = 14),
s AS (SELECT * FROM last_values WHERE event_type = 'purchase'),
x AS (SELECT * FROM last_values WHERE event_type = 'click'),
y AS (SELECT * FROM last_values WHERE event_type = 'view'),
z AS (SELECT * FROM last_values WHERE event_type = 'error')
"""


def _component_sql(changes: str) -> str:
    return f"""
filled AS (
  SELECT d.*, s.value AS s, x.value AS x, y.value AS y, z.value AS z
  FROM {changes} d
  ASOF LEFT JOIN s ON d.recording = s.recording AND d.robot = s.robot AND d.ts >= s.ts
  ASOF LEFT JOIN x ON d.recording = x.recording AND d.robot = x.robot AND d.ts >= x.ts
  ASOF LEFT JOIN y ON d.recording = y.recording AND d.robot = y.robot AND d.ts >= y.ts
  ASOF LEFT JOIN z ON d.recording = z.recording AND d.robot = z.robot AND d.ts >= z.ts),
made AS (
  SELECT f.recording, f.entity, f.ts, l.component, f.n_triggers, f.s, f.x, f.y, f.z,
         CASE l.component WHEN 'Scalar' THEN CASE WHEN s IS NULL THEN 'no value' END
              WHEN 'Point3d' THEN CASE WHEN x IS NULL THEN 'no value for x' WHEN y IS NULL THEN 'no value for y'
                                       WHEN z IS NULL THEN 'no value for z' END
              ELSE 'unknown component' END AS reason
  FROM filled f JOIN listed l USING (recording, robot))
"""


@query(f"WITH {ENTITIES} SELECT recording, entity FROM robots")
def entities_found(spark, sf_dir):
    return entities.entities_found(fresh(views.entity_logs(spark, sf_dir)).entries)


@query(f"WITH {ENTITIES} SELECT recording, entity, component FROM listed")
def component_list(spark, sf_dir):
    return entities.component_list(fresh(views.entity_logs(spark, sf_dir)).entries)


@query(f"""
WITH {ENTITIES}, {_component_sql("direct")}
SELECT recording, entity, ts, s AS scalar, n_triggers FROM made WHERE component = 'Scalar' AND reason IS NULL
""")
def scalar_rows(spark, sf_dir):
    rows = fresh(views.entity_logs(spark, sf_dir)).entity_rows.filter("component = 'Scalar'")
    return rows.select("recording", "entity", "ts", "scalar", "n_triggers")


def _axes() -> list:
    return [F.col("point3d")[i].cast("double").alias(a) for i, a in enumerate("xyz")]


AXES_SQL = ", ".join(f"CAST(CAST({a} AS FLOAT) AS DOUBLE) AS {a}" for a in "xyz")


@query(f"""
WITH {ENTITIES}, {_component_sql("direct")}
SELECT recording, entity, ts, {AXES_SQL}, n_triggers FROM made WHERE component = 'Point3d' AND reason IS NULL
""")
def point3d_rows(spark, sf_dir):
    rows = fresh(views.entity_logs(spark, sf_dir)).entity_rows.filter("component = 'Point3d'")
    return rows.select("recording", "entity", "ts", *_axes(), "n_triggers")


@query(f"""
WITH {ENTITIES},
below AS (  -- any key below an entity
  SELECT recording, robot, ts, event_type FROM last_values
  UNION ALL SELECT recording, robot, 0, '.type' FROM robots
  UNION ALL SELECT recording, robot, 0, '.components' FROM robots WHERE robot % 4 = 0
  UNION ALL SELECT recording, robot, 0, '.components/' || i FROM robots, (VALUES (0), (1), (2)) AS v(i)
            WHERE robot % 4 = 2 AND (i < 2 OR robot = 14)),
subtree AS (SELECT recording, robot, entity, ts, count(*) AS n_triggers FROM below JOIN robots USING (recording, robot)
            GROUP BY ALL), {_component_sql("subtree")}
SELECT recording, entity, ts, {AXES_SQL}, n_triggers FROM made WHERE component = 'Point3d' AND reason IS NULL
""")
def point3d_subtree(spark, sf_dir):
    made = fresh(views.entity_logs(spark, sf_dir))
    made.trigger = "subtree"
    rows = made.entity_rows.filter("component = 'Point3d'")
    return rows.select("recording", "entity", "ts", *_axes(), "n_triggers")


@query(f"""
WITH {ENTITIES}, {_component_sql("direct")}
SELECT recording, entity || '/' || component AS key, ts, reason FROM made WHERE reason IS NOT NULL
""")
def component_errors(spark, sf_dir):
    made = fresh(views.entity_logs(spark, sf_dir))
    return entities.component_problems(made.component_rows).select("recording", "key", "ts", "reason")


ENTITY_ROWS = f"""
WITH {ENTITIES}, {_component_sql("direct")},
rows_ AS (SELECT recording, entity, ts, component, CASE component WHEN 'Scalar' THEN s END AS scalar,
                 CASE component WHEN 'Point3d' THEN CAST(CAST(x AS FLOAT) AS DOUBLE) END AS x,
                 CASE component WHEN 'Point3d' THEN CAST(CAST(y AS FLOAT) AS DOUBLE) END AS y,
                 CASE component WHEN 'Point3d' THEN CAST(CAST(z AS FLOAT) AS DOUBLE) END AS z, n_triggers
          FROM made WHERE reason IS NULL)
"""


@query(f"{ENTITY_ROWS} SELECT * FROM rows_")
def entity_rows(spark, sf_dir):
    rows = fresh(views.entity_logs(spark, sf_dir)).entity_rows
    return rows.select("recording", "entity", "ts", "component", "scalar", *_axes(), "n_triggers")


@query(f"""
{ENTITY_ROWS}
SELECT recording, entity, ts // 1000000 AS chunk, count(*) AS n_rows, string_agg(ts || ':' || component, ',' ORDER BY ts, component) AS rows
FROM rows_ GROUP BY recording, entity, ts // 1000000
""")
def entity_chunks(spark, sf_dir):
    chunks = entities.entity_chunks(fresh(views.entity_logs(spark, sf_dir)).entity_rows, span=1_000_000)
    text = F.transform("rows", lambda r: F.concat_ws(":", r["ts"].cast("string"), r["component"]))
    return chunks.select("recording", "entity", "chunk", "n_rows", F.array_join(text, ",").alias("rows"))


# Quarantine and streaming: Q1, S8, S9, W1 ---------------------------------------------

@query("""
SELECT entry_type, stage, reason, count(*) AS n FROM (
  SELECT CASE event_id % 8 WHEN 0 THEN 'json' WHEN 1 THEN 'int64' WHEN 2 THEN 'string[]' WHEN 3 THEN 'color'
                           WHEN 4 THEN 'double[]' END AS entry_type,
         CASE WHEN event_id % 8 = 7 THEN 'context' ELSE 'value' END AS stage,
         CASE event_id % 8 WHEN 0 THEN 'json values are not decoded' WHEN 1 THEN 'too few bytes for a int64'
              WHEN 2 THEN 'string has no array form' WHEN 3 THEN 'no such type'
              WHEN 4 THEN 'trailing partial element' ELSE 'no context' END AS reason
  FROM events WHERE event_id % 8 NOT IN (5, 6)) GROUP BY ALL
""")
def quarantine_summary(spark, sf_dir):
    return quality.summary(fresh(views.messy_logs(spark, sf_dir)).quarantine)


@query(LATEST)
def stream_equals_batch(spark, sf_dir):
    from tracklake.session import staging_path
    from tracklake.streaming.live import ingest_stream
    from tracklake.testkit.files import write_files

    source, out, check = (staging_path(spark, f"stream-{n}") for n in ("source", "out", "checkpoint"))
    write_files(views.value_files(spark, sf_dir), source)
    ingest_stream(spark, source, out, check).awaitTermination()
    named = F.regexp_replace("recording", "-[0-9a-f]{16}$", "").alias("recording")
    rows = entries.latest_per_key(spark.read.parquet(f"{out}/entries"))
    return rows.select(named, "key", "ts", F.col("v_double").alias("value"))


@query(f"""
WITH {EVENTS},
{FRAMES}
SELECT * FROM numbered WHERE entry_id > 0
""")
def range_framing(spark, sf_dir):
    """Every record of files cut into ranges of 8 KiB, framed in parallel from guessed and then proven entry points."""
    from tracklake.functions.binary import bits_of_hex, le_hex, real
    from tracklake.session import staging_path
    from tracklake.sources.logfiles import list_files
    from tracklake.sources.ranges import large_logs, scan_ranges
    from tracklake.testkit.files import write_files

    source = staging_path(spark, "ranges-source")
    write_files(views.value_files(spark, sf_dir), source)
    name = F.regexp_extract("path", r"([^/]*)\.wpilog$", 1)
    files = list_files(spark, source).withColumn("recording", name)
    frames = scan_ranges(large_logs(files, range_bytes=8192))
    value = real(bits_of_hex(le_hex(F.col("data"))), F.lit(True)).alias("value")
    return frames.filter("entry_id > 0 and issue is null").select("recording", "seq", "entry_id", "ts", value)


@query(f"""
WITH {EVENTS}, {FRAMES}
SELECT recording, seq, entry_id, ts, value FROM numbered WHERE entry_id > 0 AND ts >= 259200000000 AND ts < 1728000000000
""")
def source_pushdown(spark, sf_dir):
    """The data source with filters on kind and time, which it applies before rows reach Spark."""
    from tracklake.functions.binary import bits_of_hex, le_hex, real
    from tracklake.session import staging_path
    from tracklake.sources.datasource import read_records
    from tracklake.testkit.files import write_files

    source = staging_path(spark, "datasource")
    write_files(views.value_files(spark, sf_dir), source)
    rows = read_records(spark, source).filter((F.col("kind") == "raw") & (F.col("ts") >= 3 * 86_400_000_000) & (F.col("ts") < 20 * 86_400_000_000))
    name = F.regexp_replace("recording", "-[0-9a-f]{16}$", "").alias("recording")
    return rows.select(name, "seq", "entry_id", "ts", real(bits_of_hex(le_hex(F.col("data"))), F.lit(True)).alias("value"))


@query(f"""
WITH {EVENTS}
SELECT recording, 'data' AS what, count(*) AS n FROM ev GROUP BY recording
UNION ALL SELECT DISTINCT 'old-' || recording, 'unsupported version', 1 FROM ev
UNION ALL SELECT DISTINCT 'short-' || recording, 'truncated header', 1 FROM ev
""")
def ingest_folder(spark, sf_dir):
    """A folder of log files among foreign, empty, old and cut ones."""
    from tracklake.plans.ingest import ingest_path
    from tracklake.session import staging_path
    from tracklake.testkit.files import write_files

    folder = staging_path(spark, "mixed files")
    files = views.value_files(spark, sf_dir).select("path", "content")
    after = lambda n: F.expr(f"substring(content, {n})")
    version, foreign = F.lit(b"WPILOG\x00\x02"), F.lit(b"RIFF")
    for name, content in (
        ("", F.col("content")), ("old-", F.concat(version, after(9))), ("foreign-", F.concat(foreign, after(5))),
        ("empty-", F.lit(b"")), ("short-", F.expr("substring(content, 1, 10)")),
    ):
        write_files(files.select(F.concat(F.lit(name), "path").alias("path"), content.alias("content")), folder)
    made = ingest_path(spark, folder)
    named = F.regexp_replace("recording", "-[0-9a-f]{16}$", "").alias("recording")
    data = made.records.filter("kind = 'raw'").groupBy(named).agg(F.lit("data").alias("what"), F.count(F.lit(1)).alias("n"))
    problems = made.quarantine.filter("stage = 'header'").groupBy(named, F.col("reason").alias("what")).agg(F.count(F.lit(1)).alias("n"))
    return data.unionByName(problems)


@query(f"""
WITH {EVENTS}
SELECT recording, count(*) AS n FROM ev WHERE user_id_even GROUP BY recording
""".replace("user_id_even", "robot % 2 = 0 AND (event_id // 4096) % 3 <> 1"))
def rerun_replaces(spark, sf_dir):
    """A table written twice: a recording that has no row the second time keeps none."""
    from tracklake.session import staging_path
    from tracklake.sources.tables import write_table

    path, rows = staging_path(spark, "rerun"), views.events(spark, sf_dir)
    write_table(rows, path, rows)
    fixed = rows.filter("robot % 2 = 0 AND event_id div 4096 % 3 <> 1")
    write_table(fixed, path, rows)
    return spark.read.schema(rows.schema).parquet(path).groupBy("recording").agg(F.count(F.lit(1)).alias("n"))
