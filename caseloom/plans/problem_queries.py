"""Queries of the general problems 1 and 3 to 6 over the driver's tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from caseloom.operators import dedupe, incremental, late, rejects, trailing
from caseloom.session import work_path
from caseloom.sources.tables import table


def p1_found(spark: SparkSession, d: str) -> DataFrame:
    messages = rejects.check_messages(table(spark, d, "ecr_messages"))
    quarantined = rejects.check_messages(table(spark, d, "ecr_rejects"))
    return rejects.reason_rows(messages, "row_id", "ecr_messages").unionByName(
        rejects.reason_rows(quarantined, "reject_id", "ecr_rejects")
    )


def p1_loaded(spark: SparkSession, d: str) -> DataFrame:
    loaded = lambda name, key: rejects.load_messages(table(spark, d, name))[0].select(
        F.lit(name).alias("source_table"), F.col(key).alias("row_key"), F.date_format("message_ts", "yyyy-MM-dd HH:mm:ss").alias("message_ts"), "facility_id",
        "patient_key", "condition_code", "result_code", F.col("report_date").cast("string").alias("report_date"),
    )
    return loaded("ecr_messages", "row_id").unionByName(loaded("ecr_rejects", "reject_id"))


def p3_found(spark: SparkSession, d: str) -> DataFrame:
    return dedupe.removed_rows(table(spark, d, "ecr_messages"))


def _counters(spark: SparkSession, d: str) -> late.CounterStore:
    return late.merged_batches(table(spark, d, "ecr_cases"), table(spark, d, "ecr_messages"))


def p4_found(spark: SparkSession, d: str) -> DataFrame:
    return late.late_cases(_counters(spark, d).slots())


def p4_daily_counts(spark: SparkSession, d: str) -> DataFrame:
    return _counters(spark, d).counts().select(
        F.col("period").cast("string").alias("report_date"), "on_time", "corrections", "corrected_count", "too_late", "sources"
    )


def p5_found(spark: SparkSession, d: str) -> DataFrame:
    return trailing.wrong_figures(table(spark, d, "fct_case_daily"))


def p5_trailing(spark: SparkSession, d: str) -> DataFrame:
    return trailing.trailing_figures(table(spark, d, "fct_case_daily")).select(
        "facility_id", "condition_code", F.col("report_date").cast("string").alias("report_date"), "case_count",
        F.col("total").alias("cases_trailing_7d"), F.round("prior_mean", 6).alias("baseline_mean_28d"),
    )


def p6_found(spark: SparkSession, d: str) -> DataFrame:
    """One whole load: planned, taken by the plan, sunk and committed; its rows are those of the sink."""
    load, sink = incremental.IncrementalLoad(spark), work_path(spark, "sink")
    messages = table(spark, d, "ecr_messages").select("row_id", "source_file", "_ingest_ts")
    load.run(messages, table(spark, d, "ingest_log"), table(spark, d, "ingest_runs"), sink)
    return load.sunk(sink).select("row_id")


QUERIES = {f.__name__: f for f in (p1_found, p1_loaded, p3_found, p4_found, p4_daily_counts, p5_found, p5_trailing, p6_found)}

# ---------------------------------------------------------------------------------------------------
# The same in DuckDB's SQL, written from the statements in TESTDATA.md rather than from the operators.

_CHECKED = r"""
raw AS (
  SELECT 'ecr_messages' AS source_table, row_id AS row_key, payload_hl7 AS p, ingest_date FROM ecr_messages
  UNION ALL SELECT 'ecr_rejects', reject_id, payload_hl7, ingest_date FROM ecr_rejects),
lines AS (SELECT *, string_split(replace(replace(p, chr(13) || chr(10), chr(13)), chr(10), chr(13)), chr(13)) AS l FROM raw),
segs AS (SELECT *,
  string_split(list_filter(l, lambda s: starts_with(s, 'MSH|'))[1], '|') AS msh,
  string_split(list_filter(l, lambda s: starts_with(s, 'PID|'))[1], '|') AS pid,
  string_split(list_filter(l, lambda s: starts_with(s, 'OBR|'))[1], '|') AS obr,
  string_split(list_filter(l, lambda s: starts_with(s, 'OBX|'))[1], '|') AS obx,
  string_split(list_filter(l, lambda s: starts_with(s, 'NTE|'))[1], '|') AS nte FROM lines),
txt AS (SELECT *,
  msh[7] AS ts, string_split(pid[4], '^')[1] AS pk, pid[8] AS bd, pid[9] AS sx, obr[8] AS sd,
  string_split(obx[4], '^')[1] AS cc, string_split(obx[6], '^')[1] AS rc, obx[15] AS rd FROM segs),
vals AS (SELECT source_table, row_key, p, ingest_date, msh, pid, obr, obx, nte,
  CASE WHEN regexp_full_match(ts, '[0-9]{14}') THEN try_strptime(ts, '%Y%m%d%H%M%S') END AS ts,
  CASE WHEN trim(pk, chr(32) || chr(9)) NOT IN ('', '""') THEN pk END AS pk,
  CASE WHEN trim(cc, chr(32) || chr(9)) NOT IN ('', '""') THEN cc END AS cc,
  CASE WHEN trim(sx, chr(32) || chr(9)) NOT IN ('', '""') THEN sx END AS sx,
  CASE WHEN trim(rc, chr(32) || chr(9)) NOT IN ('', '""') THEN rc END AS rc,
  CASE WHEN trim(bd, chr(32) || chr(9)) NOT IN ('', '""') THEN bd END AS bdt,
  CASE WHEN trim(sd, chr(32) || chr(9)) NOT IN ('', '""') THEN sd END AS sdt,
  CASE WHEN regexp_full_match(bd, '[0-9]{8}') THEN try_strptime(bd, '%Y%m%d') END AS bd,
  CASE WHEN regexp_full_match(sd, '[0-9]{8}') THEN try_strptime(sd, '%Y%m%d') END AS sd,
  CASE WHEN regexp_full_match(rd, '[0-9]{8}') THEN try_strptime(rd, '%Y%m%d') END AS rd FROM txt),
flags AS (SELECT *, coalesce(starts_with(p, 'MSH|^~\&|'), false) AS headed FROM vals)
"""

_REASONS = r"""
  ('wrong_field_count', coalesce(len(msh) <> 12, false) OR coalesce(len(pid) <> 12, false) OR coalesce(len(obr) <> 8, false)
     OR coalesce(len(obx) <> 15, false) OR coalesce(len(nte) <> 4, false)),
  ('broken_escape', contains(regexp_replace(substr(p, 10), '\\[FSTRE]\\', '', 'g'), '\')),
  ('unparseable_message_ts', ts IS NULL), ('missing_patient_key', pk IS NULL), ('missing_condition_code', cc IS NULL),
  ('missing_report_date', rd IS NULL), ('report_date_in_future', rd > CAST(ingest_date AS DATE)), ('negative_age', bd > rd),
  ('invalid_value', sx NOT IN ('M', 'F', 'O', 'U')), ('invalid_value', rc NOT IN ('POS', 'NEG', 'IND')),
  ('invalid_value', bdt IS NOT NULL AND bd IS NULL), ('invalid_value', sdt IS NOT NULL AND sd IS NULL)
"""

_DELIVERIES = r"""
d AS (SELECT row_id, ingest_date,
  nullif(regexp_replace(regexp_replace(lower(message_id), '^\s*sha256:', ''), '[^0-9a-f]', '', 'g'), '') AS id,
  CASE WHEN NOT regexp_full_match(payload_hl7, '\s*') THEN sha256(payload_hl7) END AS ph,
  CASE WHEN regexp_full_match(trim(received_at), '[0-9]{13}') THEN epoch_ms(CAST(trim(received_at) AS BIGINT))
       WHEN regexp_matches(trim(received_at), 'T.*([+-][0-9]{2}:[0-9]{2})$') THEN
         CAST(left(trim(received_at), length(trim(received_at)) - 6) AS TIMESTAMP)
           - CAST(concat(substr(right(trim(received_at), 6), 1, 1), '1') AS INTEGER)
             * (to_hours(CAST(substr(right(trim(received_at), 6), 2, 2) AS INTEGER)) + to_minutes(CAST(right(received_at, 2) AS INTEGER)))
       ELSE TRY_CAST(replace(replace(trim(received_at), 'Z', ''), 'T', ' ') AS TIMESTAMP) END AS moment
  FROM ecr_messages),
links AS (SELECT ph, min(id) AS link FROM d WHERE ph IS NOT NULL GROUP BY ph HAVING count(id) > 0),
keyed AS (SELECT d.*, coalesce(d.id, links.link, d.ph, 'row ' || d.row_id) AS k FROM d LEFT JOIN links ON d.id IS NULL AND d.ph = links.ph)
"""

_SLOTS = f"""
{_DELIVERIES},
arr AS (SELECT k, coalesce(CAST(min(moment) AS DATE), CAST(min(ingest_date) AS DATE)) AS arrived FROM keyed GROUP BY k),
slots AS (SELECT DISTINCT c.message_control_id, c.facility_id, CAST(c.report_date AS DATE) AS report_date,
  CAST(arr.arrived AS DATE) - CAST(c.report_date AS DATE) AS late
  FROM ecr_cases c LEFT JOIN arr ON arr.k = c.message_id WHERE c.report_date IS NOT NULL)
"""

_FIGURES = """
facts AS (SELECT facility_id, condition_code, CAST(report_date AS DATE) AS report_date, coalesce(max(case_count), 0) AS n
  FROM fct_case_daily GROUP BY ALL),
days AS (SELECT CAST(unnest(generate_series(DATE '2025-11-03', DATE '2026-06-30', INTERVAL 1 DAY)) AS DATE) AS report_date),
grid AS (SELECT * FROM (SELECT DISTINCT facility_id, condition_code FROM fct_case_daily), days),
daily AS (SELECT g.facility_id, g.condition_code, g.report_date, coalesce(f.n, 0) AS n FROM grid g LEFT JOIN facts f
  ON f.facility_id = g.facility_id AND f.condition_code = g.condition_code AND f.report_date = g.report_date),
figures AS (SELECT facility_id, condition_code, report_date, CAST(n AS BIGINT) AS case_count,
  CAST(sum(n) OVER (w ROWS BETWEEN 6 PRECEDING AND CURRENT ROW) AS BIGINT) AS total,
  avg(n) OVER (w ROWS BETWEEN 28 PRECEDING AND 1 PRECEDING) AS prior_mean
  FROM daily WINDOW w AS (PARTITION BY facility_id, condition_code ORDER BY report_date))
"""

SQL = {
    "p1_found": f"""WITH {_CHECKED}
SELECT DISTINCT source_table, row_key, r.reason FROM (
  SELECT source_table, row_key, 'no_header' AS reason FROM flags WHERE NOT headed
  UNION ALL SELECT source_table, row_key, reason FROM flags, LATERAL (VALUES {_REASONS}) AS v(reason, holds) WHERE headed AND holds) r""",
    "p1_loaded": f"""WITH {_CHECKED}
SELECT source_table, row_key, strftime(ts, '%Y-%m-%d %H:%M:%S') AS message_ts,
  nullif(nullif(msh[4], ''), '""') AS facility_id, pk AS patient_key, cc AS condition_code, rc AS result_code,
  CAST(CAST(rd AS DATE) AS VARCHAR) AS report_date
FROM flags WHERE headed
  AND NOT EXISTS (SELECT 1 FROM (VALUES {_REASONS}) AS v(reason, holds) WHERE holds)""",
    "p3_found": f"""WITH {_DELIVERIES}
SELECT row_id FROM (SELECT row_id, row_number() OVER (PARTITION BY k ORDER BY moment ASC NULLS LAST, row_id) AS rn FROM keyed) WHERE rn > 1""",
    "p4_found": f"""WITH {_SLOTS}
SELECT message_control_id, CASE WHEN late > 10 THEN 'too_late' ELSE 'corrects' END AS outcome FROM slots WHERE late >= 1""",
    "p4_daily_counts": f"""WITH {_SLOTS}
SELECT CAST(report_date AS VARCHAR) AS report_date, count(*) FILTER (WHERE coalesce(late, 0) < 1) AS on_time,
  count(*) FILTER (WHERE late BETWEEN 1 AND 10) AS corrections, count(*) FILTER (WHERE coalesce(late, 0) <= 10) AS corrected_count,
  count(*) FILTER (WHERE late > 10) AS too_late, count(DISTINCT facility_id) AS sources FROM slots GROUP BY 1""",
    "p5_found": f"""WITH {_FIGURES}
SELECT DISTINCT case_daily_sk, m.measure FROM fct_case_daily r
JOIN figures f ON f.facility_id = r.facility_id AND f.condition_code = r.condition_code AND f.report_date = CAST(r.report_date AS DATE),
LATERAL (VALUES ('cases_trailing_7d', r.cases_trailing_7d, CAST(f.total AS DOUBLE)), ('baseline_mean_28d', r.baseline_mean_28d, f.prior_mean)) AS m(measure, a, b)
WHERE (a IS NULL) <> (b IS NULL) OR abs(a - b) > 0.000001""",
    "p5_trailing": f"""WITH {_FIGURES}
SELECT facility_id, condition_code, CAST(report_date AS VARCHAR) AS report_date, case_count, total AS cases_trailing_7d,
  round(prior_mean, 6) AS baseline_mean_28d FROM figures""",
    "p6_found": """WITH good AS (SELECT DISTINCT _batch_id FROM ingest_runs
  WHERE lower(trim(run_status)) IN ('ok', 'okay', 'done', 'success', 'successful', 'succeeded', 'complete', 'completed', 'finished', 'passed')),
l AS (SELECT regexp_replace(regexp_replace(replace(replace(source_file, '%3D', '='), '%2F', '/'), '^file:', ''), '/+', '/', 'g') AS f, _ingest_ts FROM ingest_log JOIN good USING (_batch_id)),
m AS (SELECT row_id, regexp_replace(regexp_replace(replace(replace(source_file, '%3D', '='), '%2F', '/'), '^file:', ''), '/+', '/', 'g') AS f, _ingest_ts FROM ecr_messages)
SELECT row_id FROM m WHERE NOT EXISTS (SELECT 1 FROM l WHERE l.f = m.f AND l._ingest_ts >= m._ingest_ts)""",
}
