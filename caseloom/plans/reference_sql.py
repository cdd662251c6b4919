"""DuckDB SQL of the surveillance pipeline's queries, written from the semantics, for comparison."""

from __future__ import annotations

from caseloom.operators.evals import GATES
from caseloom.operators.extract import LEXICON, VOCABULARY
from caseloom.operators.retrieval import STOP_WORDS
from caseloom.plans.corpus import CONDITION_GROUPS, CORPUS, DOCUMENT_QUESTIONS, EXPOSURES, NOTE_TERMS, ONSET_PHRASES, QUESTIONS, TRAVEL_PHRASES, WINDOWS


def _q(v) -> str:
    return "NULL" if v is None else str(v).lower() if isinstance(v, bool) else str(v) if isinstance(v, (int, float)) else "'" + v.replace("'", "''") + "'"


def _values(rows) -> str:
    return ", ".join("(" + ", ".join(map(_q, r)) + ")" for r in rows)


def _list(values) -> str:
    return "[" + ", ".join(map(_q, values)) + "]"


# --- messages: empty fields stay empty, as in the feed's own rules ------------------------------------

_PARSED = r"""
lines AS (SELECT *, string_split(replace(replace(payload_hl7, chr(13) || chr(10), chr(13)), chr(10), chr(13)), chr(13)) AS l FROM ecr_messages),
segs AS (SELECT *,
  string_split(list_filter(l, lambda s: starts_with(s, 'MSH|'))[1], '|') AS msh, string_split(list_filter(l, lambda s: starts_with(s, 'PID|'))[1], '|') AS pid,
  string_split(list_filter(l, lambda s: starts_with(s, 'OBR|'))[1], '|') AS obr, string_split(list_filter(l, lambda s: starts_with(s, 'OBX|'))[1], '|') AS obx,
  string_split(list_filter(l, lambda s: starts_with(s, 'NTE|'))[1], '|') AS nte FROM lines),
parsed AS (SELECT * EXCLUDE (l, msh, pid, obr, obx, nte, facility_id),
  msh[3] AS sending_application, facility_id,
  CASE WHEN regexp_full_match(msh[7], '[0-9]{14}') THEN try_strptime(msh[7], '%Y%m%d%H%M%S') END AS message_ts,
  msh[9] AS message_type, msh[10] AS message_control_id, msh[12] AS hl7_version, string_split(pid[4], '^')[1] AS patient_key,
  CASE WHEN regexp_full_match(pid[8], '[0-9]{8}') THEN CAST(try_strptime(pid[8], '%Y%m%d') AS DATE) END AS birth_date, pid[9] AS sex,
  string_split(pid[12], '^')[3] AS county, string_split(pid[12], '^')[4] AS state, string_split(pid[12], '^')[5] AS postal_code,
  CASE WHEN regexp_full_match(obr[8], '[0-9]{8}') THEN CAST(try_strptime(obr[8], '%Y%m%d') AS DATE) END AS specimen_collection_date,
  string_split(obx[4], '^')[1] AS condition_code, string_split(obx[4], '^')[2] AS condition_display, string_split(obx[4], '^')[3] AS condition_system,
  string_split(obx[6], '^')[1] AS result_code, string_split(obx[6], '^')[2] AS result_display, obx[9] AS abnormal_flag,
  CASE WHEN regexp_full_match(obx[15], '[0-9]{8}') THEN CAST(try_strptime(obx[15], '%Y%m%d') AS DATE) END AS report_date, nte[4] AS clinical_note
  FROM (SELECT *, msh[4] AS facility_id FROM segs)),
judged AS (SELECT *, list_filter([
  CASE WHEN condition_code IS NULL THEN 'missing_condition_code' END, CASE WHEN report_date IS NULL THEN 'missing_report_date' END,
  CASE WHEN message_ts IS NULL THEN 'unparseable_message_ts' END, CASE WHEN patient_key IS NULL THEN 'missing_patient_key' END,
  CASE WHEN report_date > TRY_CAST(ingest_date AS DATE) THEN 'report_date_in_future' END, CASE WHEN birth_date > report_date THEN 'negative_age' END],
  lambda x: x IS NOT NULL) AS f FROM parsed)
"""

#: The recorded hash in one spelling, else computed.
_SHA = "CASE WHEN regexp_full_match(_payload_sha256, '[0-9a-fA-F]{64}') THEN lower(_payload_sha256) ELSE sha256(payload_hl7) END"

_BAND = "CASE WHEN {0} < 5 THEN '0-4' WHEN {0} < 18 THEN '5-17' WHEN {0} < 50 THEN '18-49' WHEN {0} < 65 THEN '50-64' {1} ELSE '65+' END"

# --- gold -------------------------------------------------------------------------------------------

_GROUP = "CASE " + " ".join(f"WHEN max(condition_name) IN ({', '.join(map(_q, m))}) THEN {_q(g)}" for g, m in CONDITION_GROUPS.items()) + " ELSE 'other' END"

_STG = """
stg AS (SELECT message_control_id AS case_id, facility_id, condition_code, condition_display AS condition_name, condition_system,
  CAST(report_date AS DATE) AS report_date, CAST(specimen_collection_date AS DATE) AS specimen_collection_date, patient_key, age_years, county, state,
  retransmission_count, TRY_CAST(ingest_date AS DATE) AS ingest_date FROM ecr_cases WHERE is_positive)
"""

_DIMS = f"""{_STG},
fac AS (SELECT md5(coalesce(facility_id, '_null_')) AS facility_sk, facility_id, max(county) AS county, max(state) AS state, min(report_date) AS first_reported_on,
  max(report_date) AS last_reported_on, count(*) AS lifetime_case_count, count(DISTINCT condition_code) AS distinct_conditions_reported,
  count(DISTINCT report_date) AS reporting_days, date_diff('day', max(report_date), DATE '2026-06-30') AS days_since_last_report,
  CASE WHEN date_diff('day', max(report_date), DATE '2026-06-30') > 14 THEN 'stale' ELSE 'active' END AS reporting_status FROM stg GROUP BY facility_id),
con AS (SELECT md5(coalesce(condition_code, '_null_')) AS condition_sk, condition_code, max(condition_name) AS condition_name, max(condition_system) AS code_system,
  count(*) AS lifetime_case_count, {_GROUP} AS condition_group FROM stg GROUP BY condition_code)
"""

_FACT = f"""{_DIMS},
days AS (SELECT CAST(unnest(generate_series(DATE '2025-11-03', DATE '2026-06-30', INTERVAL 1 DAY)) AS DATE) AS report_date),
counts AS (SELECT report_date, facility_id, condition_code, count(*) AS case_count, count(DISTINCT patient_key) AS distinct_patients, avg(age_years) AS mean_age_years,
  CAST(sum(retransmission_count) AS BIGINT) AS retransmissions FROM stg GROUP BY ALL),
filled AS (SELECT d.report_date, f.facility_id, f.county, c.condition_code, c.condition_name, c.condition_group, coalesce(n.case_count, 0) AS case_count,
  coalesce(n.distinct_patients, 0) AS distinct_patients, n.mean_age_years, coalesce(n.retransmissions, 0) AS retransmissions
  FROM days d CROSS JOIN fac f CROSS JOIN con c LEFT JOIN counts n ON n.report_date = d.report_date AND n.facility_id = f.facility_id AND n.condition_code = c.condition_code),
windowed AS (SELECT *, CAST(sum(case_count) OVER w7 AS BIGINT) AS cases_trailing_7d, avg(case_count) OVER w28 AS baseline_mean_28d,
  stddev_samp(case_count) OVER w28 AS baseline_sd_28d, count(*) OVER w28 AS baseline_days FROM filled
  WINDOW w7 AS (PARTITION BY facility_id, condition_code ORDER BY report_date ROWS BETWEEN 6 PRECEDING AND CURRENT ROW),
    w28 AS (PARTITION BY facility_id, condition_code ORDER BY report_date ROWS BETWEEN 28 PRECEDING AND 1 PRECEDING)),
fact AS (SELECT md5(CAST(report_date AS VARCHAR) || '||' || coalesce(facility_id, '_null_') || '||' || coalesce(condition_code, '_null_')) AS case_daily_sk, *,
  CASE WHEN baseline_days >= 21 AND baseline_sd_28d > 0 THEN (case_count - baseline_mean_28d) / baseline_sd_28d END AS baseline_z,
  extract(dow FROM report_date) IN (0, 6) AS is_weekend, CAST(extract(week FROM report_date) AS INTEGER) AS epi_week FROM windowed)
"""

_LABELS = f"""
win AS (SELECT facility_id, condition_name, CAST(a AS DATE) AS a, CAST(b AS DATE) AS b, multiplier FROM (VALUES {_values(WINDOWS)}) v(facility_id, condition_name, a, b, multiplier)),
labels AS (SELECT DISTINCT facility_id, condition_name, CAST(unnest(generate_series(a, b, INTERVAL 1 DAY)) AS DATE) AS report_date FROM win)
"""

_FEATURES = f"""{_FACT}, {_LABELS},
feat AS (SELECT f.* EXCLUDE (is_weekend), lag(case_count, 1) OVER s AS lag_1_cases, lag(case_count, 7) OVER s AS lag_7_cases,
  case_count - lag(case_count, 1) OVER s AS delta_1_cases,
  CASE WHEN count(case_count) OVER p >= 7 THEN avg(case_count) OVER p END AS prior_mean_cases,
  case_count / (coalesce(baseline_mean_28d, 0) + 0.5) AS ratio_to_baseline, CAST(isodow(f.report_date) - 1 AS INTEGER) AS day_of_week,
  CAST(isodow(f.report_date) >= 6 AS INTEGER) AS is_weekend, CAST(condition_group = 'enteric' AS INTEGER) AS is_enteric,
  CAST(condition_group = 'respiratory' AS INTEGER) AS is_respiratory, CAST(l.report_date IS NOT NULL AS INTEGER) AS is_outbreak_day
  FROM fact f LEFT JOIN labels l ON l.report_date = f.report_date AND l.facility_id = f.facility_id AND l.condition_name = f.condition_name
  WINDOW s AS (PARTITION BY f.facility_id, condition_code ORDER BY f.report_date),
    p AS (PARTITION BY f.facility_id, condition_code ORDER BY f.report_date ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING))
"""

_SCORED = f"""{_FEATURES},
scored AS (SELECT report_date, facility_id, condition_code, condition_name, county, case_count, baseline_mean_28d, baseline_z,
  least((case_count * 3 + cases_trailing_7d) / 200.0::DOUBLE, 1.0::DOUBLE) AS score, is_outbreak_day AS label FROM feat)
"""


def _confusion(alert: str) -> str:
    return f"""SELECT count(*) FILTER (WHERE a AND label = 1) AS tp, count(*) FILTER (WHERE a AND label = 0) AS fp, count(*) FILTER (WHERE NOT a AND label = 1) AS fn,
  count(DISTINCT report_date) AS days FROM (SELECT *, {alert} AS a FROM scored)"""


_RATIOS = """round(coalesce(tp::DOUBLE / nullif(tp + fp, 0), 0.0), 6) AS "precision", round(coalesce(tp::DOUBLE / nullif(tp + fn, 0), 0.0), 6) AS recall,
  round(coalesce(2.0::DOUBLE * tp / nullif(2 * tp + fp + fn, 0), 0.0), 6) AS f1, round((tp + fp)::DOUBLE / greatest(days / 7.0::DOUBLE, 1), 6) AS alerts_per_week"""

# --- texts ------------------------------------------------------------------------------------------


def _tokens(text: str) -> str:
    return f"""list_transform(list_filter(regexp_extract_all(lower({text}), '[a-z0-9]+'), lambda t: NOT list_contains({_list(STOP_WORDS)}, t)),
  lambda t: CASE WHEN length(t) > 3 AND ends_with(t, 's') AND NOT ends_with(t, 'ss') THEN substr(t, 1, length(t) - 1) ELSE t END)"""


def _bm25(corpus: str, questions) -> str:
    return f"""
corpus AS ({corpus}),
toks AS (SELECT id, text, list_concat(list_concat(list_concat(t, t), t), x) AS toks FROM
  (SELECT id, text, coalesce({_tokens('title')}, []) AS t, coalesce({_tokens('text')}, []) AS x FROM corpus)),
size AS (SELECT count(*) AS n, avg(len(toks)) AS avg_len FROM toks),
q AS (SELECT query_id, question FROM (VALUES {_values(questions)}) v(query_id, question)),
qt AS (SELECT query_id, term, count(*) AS qtf FROM (SELECT query_id, unnest({_tokens('question')}) AS term FROM q) GROUP BY ALL),
post AS (SELECT id, len, term, count(*) AS tf FROM (SELECT id, len(toks) AS len, unnest(toks) AS term FROM toks) GROUP BY ALL),
freq AS (SELECT term, count(*) AS df FROM post GROUP BY term),
scores AS (SELECT query_id, id, sum(qtf * ln(1 + (n - df + 0.5) / (df + 0.5)) * tf * 2.5 / (tf + 1.5 * (0.25 + 0.75 * len / avg_len))) AS score
  FROM post JOIN freq USING (term) JOIN qt USING (term), size GROUP BY ALL),
ranked AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY round(score, 9) DESC, id) AS rank FROM scores WHERE score > 0)
"""


_DOCUMENTS = "SELECT doc_id AS id, source AS title, text FROM documents"
_GUIDANCE = f"SELECT * FROM (VALUES {_values(CORPUS)}) v(id, title, text)"

_ANSWERS = f"""{_bm25(_GUIDANCE, [q[:2] for q in QUESTIONS])},
answers AS (SELECT q.query_id, coalesce(r.score, 0) >= 5 AS grounded,
  CASE WHEN coalesce(r.score, 0) >= 5 THEN trim(split_part(t.text, '. ', 1)) || '. [' || r.id || ']' ELSE 'INSUFFICIENT_CONTEXT' END AS answer,
  CASE WHEN coalesce(r.score, 0) >= 5 THEN r.id ELSE '' END AS citations
  FROM q LEFT JOIN ranked r ON r.query_id = q.query_id AND r.rank = 1 LEFT JOIN toks t ON t.id = r.id)
"""


def _present(term: str, note: str) -> str:
    longer = [t for t in LEXICON[: LEXICON.index(term)] if term in t]
    return " AND ".join([f"contains({note}, {_q(term)})", *[f"NOT contains({note}, {_q(t)})" for t in longer]])


def _found(note: str) -> str:
    return "list_sort(list_filter([" + ", ".join(f"CASE WHEN {_present(t, note)} THEN {_q(t)} END" for t in LEXICON) + "], lambda x: x IS NOT NULL))"


def _entry(t: str) -> str:
    words = sorted(((w, c) for c, ws in VOCABULARY.items() for w in ws), key=lambda x: (-len(x[0]), x[0]))
    return "CASE " + " ".join(f"WHEN contains({t}, {_q(w)}) THEN {_q(c)}" for w, c in words) + " END"


def _mapped(terms: str) -> str:
    return f"list_sort(list_distinct(list_filter(list_transform({terms}, lambda t: {_entry('t')}), lambda c: c IS NOT NULL)))"


def _onset(note: str) -> str:
    return rf"nullif(regexp_extract({note}, 'onset reported as (\d{{4}}-\d{{2}}-\d{{2}})', 1), '')"


def _exposure(note: str) -> str:
    return rf"trim(nullif(regexp_extract({note}, 'exposure history: ([^.]+)\.', 1), ''))"


def _travel(note: str) -> str:
    return f"contains({note}, 'reports recent travel')"


_GOLDEN = f"""
g AS (SELECT DISTINCT message_control_id, CAST(report_date AS DATE) AS r, CAST(right(message_control_id, 5) AS INTEGER) AS k FROM ecr_cases
  WHERE report_date IS NOT NULL AND message_control_id IS NOT NULL),
h AS (SELECT *, {_list(NOTE_TERMS)}[k % {len(NOTE_TERMS)} + 1] AS s1, {_list(NOTE_TERMS)}[(k + 4) % {len(NOTE_TERMS)} + 1] AS s2, {_list(EXPOSURES)}[k % {len(EXPOSURES)} + 1] AS want_exposure,
  CAST(r - CAST(k % 8 + 2 AS INTEGER) AS VARCHAR) AS want_onset, k % 6 = 0 AS want_travel FROM g),
n AS (SELECT *, lower('Adult presenting with ' || s1 || ' and ' || s2 || '. ' || {_list(ONSET_PHRASES)}[k % {len(ONSET_PHRASES)} + 1] || want_onset || '. Exposure history: ' || want_exposure
  || CASE WHEN want_travel THEN {_list(TRAVEL_PHRASES)}[k % {len(TRAVEL_PHRASES)} + 1] ELSE '. No travel.' END) AS note FROM h),
e AS (SELECT *, {_mapped('[s1, s2]')} AS want, {_mapped(_found('note'))} AS got, {_onset('note')} AS got_onset,
  coalesce({_exposure('note')}, '') = lower(want_exposure) AS exposure_ok, {_travel('note')} = want_travel AS travel_ok FROM n),
j AS (SELECT *, coalesce(got_onset, '') = want_onset AS onset_ok, list_filter(want, lambda x: NOT list_contains(got, x)) AS missing,
  list_filter(got, lambda x: NOT list_contains(want, x)) AS spurious,
  TRY_CAST(got_onset AS DATE) IS NOT NULL AND NOT contains(note, CAST(TRY_CAST(got_onset AS DATE) AS VARCHAR)) AS failed FROM e)
"""

_EVAL = f"""{_GOLDEN},
m AS (SELECT count(*) AS n_cases, count(*) FILTER (WHERE failed) AS failures, sum(len(list_intersect(got, want))) FILTER (WHERE NOT failed) AS tp,
  sum(len(spurious)) FILTER (WHERE NOT failed) AS fp, sum(len(missing)) FILTER (WHERE NOT failed) AS fn,
  avg(CAST(onset_ok AS INTEGER)) FILTER (WHERE NOT failed) AS onset, avg(CAST(exposure_ok AS INTEGER)) FILTER (WHERE NOT failed) AS exposure,
  avg(CAST(travel_ok AS INTEGER)) FILTER (WHERE NOT failed) AS travel FROM j),
metrics AS (SELECT n_cases, failures::DOUBLE / n_cases AS schema_failure_rate, round(tp::DOUBLE / (tp + fp), 4) AS symptom_precision, round(tp::DOUBLE / (tp + fn), 4) AS symptom_recall,
  round(2 * tp::DOUBLE / (2 * tp + fp + fn), 4) AS symptom_f1, round(onset, 4) AS onset_exact, round(exposure, 4) AS exposure_exact, round(travel, 4) AS travel_accuracy FROM m)
"""

_FOUND = f"""{_ANSWERS}, asked AS (SELECT * FROM (VALUES {_values(QUESTIONS)}) v(query_id, question, expect_doc, answerable)),
found AS (SELECT count(*) AS n_cases, round(avg(CAST(citations = expect_doc AS INTEGER)) FILTER (WHERE answerable), 4) AS citation_accuracy,
  round(avg(CAST(answer = 'INSUFFICIENT_CONTEXT' AS INTEGER)) FILTER (WHERE NOT answerable), 4) AS refusal_accuracy FROM asked JOIN answers USING (query_id))
"""

_GATES = ", ".join(f"({_q(n)}, {n}, {b}::DOUBLE, {n} {'<' if kind == 'least' else '>'} {b})" for n, (kind, b) in GATES.items())

_MART_KEYS = [
    ("ecr_cases", "ecr_cases", ("message_control_id", "report_date")), ("dim_facility", "fac", ("facility_sk", "facility_id")), ("dim_condition", "con", ("condition_sk", "condition_code")),
    ("fct_case_daily", "fact", ("case_daily_sk", "report_date", "facility_id", "condition_code", "case_count")), ("agg_condition_daily_state", "agg", ("report_date",)),
]
_MART_UNIQUE = [("dim_facility", "fac", ("facility_sk", "facility_id")), ("dim_condition", "con", ("condition_sk", "condition_code")), ("fct_case_daily", "fact", ("case_daily_sk",))]

SQL = {
    "hl7_parse": f"""WITH {_PARSED} SELECT row_id, strftime(message_ts, '%Y-%m-%d %H:%M:%S') AS message_ts, sending_application, facility_id, message_type, message_control_id, hl7_version,
  patient_key, CAST(birth_date AS VARCHAR) AS birth_date, sex, county, state, postal_code, CAST(specimen_collection_date AS VARCHAR) AS specimen_collection_date, condition_code,
  condition_display, condition_system, result_code, result_display, abnormal_flag, CAST(report_date AS VARCHAR) AS report_date, clinical_note FROM parsed""",
    "dq_rules": f"WITH {_PARSED} SELECT row_id, array_to_string(f, ',') AS dq_failures FROM judged WHERE len(f) > 0",
    "dq_split": f"WITH {_PARSED} SELECT count(*) FILTER (WHERE len(f) = 0) AS clean, count(*) FILTER (WHERE len(f) > 0) AS rejected FROM judged",
    "dq_histogram": f"WITH {_PARSED} SELECT rule, count(*) AS failures FROM (SELECT unnest(f) AS rule FROM judged) GROUP BY rule",
    "balance_sheet": f"""WITH {_PARSED}, b AS (SELECT count(*) AS bronze, count(*) FILTER (WHERE len(f) > 0) AS rejected,
  count(DISTINCT coalesce({_SHA}, '')) FILTER (WHERE len(f) = 0) AS silver FROM judged) SELECT *, bronze - rejected - silver AS deduplicated FROM b""",
    "dedupe_first": f"""SELECT sha AS _payload_sha256, row_id, n AS retransmission_count FROM (SELECT *, row_number() OVER (PARTITION BY sha
  ORDER BY received_at NULLS FIRST, _ingest_ts NULLS FIRST, message_id NULLS FIRST, row_id) AS rn, count(*) OVER (PARTITION BY sha) - 1 AS n
  FROM (SELECT *, {_SHA} AS sha FROM ecr_messages) WHERE sha IS NOT NULL) WHERE rn = 1""",
    "silver_cases": f"""WITH {_PARSED}, d AS (SELECT *, sha256(payload_hl7) AS sha, row_number() OVER (PARTITION BY sha256(payload_hl7) ORDER BY received_at NULLS FIRST, _ingest_ts NULLS FIRST, message_id NULLS FIRST) AS rn,
  count(*) OVER (PARTITION BY sha256(payload_hl7)) - 1 AS n, datesub('year', birth_date, report_date) AS age FROM judged WHERE len(f) = 0)
SELECT sha AS _payload_sha256, facility_id, age AS age_years, {_BAND.format('age', '')} AS age_band, result_code = 'POS' AS is_positive, strftime(report_date, '%Y-%m') AS report_month,
  n AS retransmission_count, CAST(report_date AS VARCHAR) AS report_date FROM d WHERE rn = 1""",
    "payload_hash": "SELECT row_id, sha256(payload_hl7) AS sha FROM ecr_messages",
    "surrogate_keys": "SELECT DISTINCT message_control_id, md5(coalesce(CAST(CAST(report_date AS DATE) AS VARCHAR), '_null_') || '||' || coalesce(facility_id, '_null_') || '||' || coalesce(condition_code, '_null_')) AS sk FROM ecr_cases",
    "anti_ingest": "SELECT source_file, count(*) AS messages FROM ecr_messages m WHERE NOT EXISTS (SELECT 1 FROM ingest_log l WHERE l.source_file = m.source_file) GROUP BY source_file",
    "ingested_files": "SELECT DISTINCT source_file FROM ingest_log",
    "age_bands": f"""SELECT DISTINCT message_control_id, a AS age_years, {_BAND.format('a', '')} AS age_band, {_BAND.format('a', "WHEN a IS NULL THEN 'unknown'")} AS age_band_known
  FROM (SELECT message_control_id, CASE WHEN b <= r THEN datesub('year', b, r) ELSE -(datesub('year', r, b) + CAST(r + to_years(CAST(datesub('year', r, b) AS INTEGER)) < b AS INTEGER)) END AS a
    FROM (SELECT message_control_id, CAST(birth_date AS DATE) AS b, CAST(report_date AS DATE) AS r FROM ecr_cases))""",
    "staging_positive": f"""WITH {_STG} SELECT case_id, facility_id, condition_code, condition_name, age_years, county, retransmission_count, CAST(report_date AS VARCHAR) AS report_date,
  CAST(specimen_collection_date AS VARCHAR) AS specimen_collection_date, CAST(ingest_date AS VARCHAR) AS ingest_date FROM stg""",
    "spine": "SELECT CAST(CAST(unnest(generate_series(DATE '2025-11-03', DATE '2026-06-30', INTERVAL 1 DAY)) AS DATE) AS VARCHAR) AS date_day",
    "dim_facility": f"WITH {_DIMS} SELECT * REPLACE (CAST(first_reported_on AS VARCHAR) AS first_reported_on, CAST(last_reported_on AS VARCHAR) AS last_reported_on) FROM fac",
    "dim_condition": f"WITH {_DIMS} SELECT * FROM con",
    "fact_daily": f"""WITH {_FACT} SELECT * REPLACE (CAST(report_date AS VARCHAR) AS report_date, round(mean_age_years, 6) AS mean_age_years, round(baseline_mean_28d, 6) AS baseline_mean_28d,
  round(baseline_sd_28d, 6) AS baseline_sd_28d, round(baseline_z, 6) AS baseline_z) FROM fact""",
    "daily_rollup": f"""WITH {_FACT} SELECT CAST(report_date AS VARCHAR) AS report_date, condition_code, condition_name, condition_group, CAST(sum(case_count) AS BIGINT) AS case_count,
  CAST(sum(distinct_patients) AS BIGINT) AS distinct_patients, count(DISTINCT facility_id) AS reporting_facilities, count(DISTINCT CASE WHEN case_count > 0 THEN facility_id END) AS facilities_with_cases,
  CAST(sum(cases_trailing_7d) AS BIGINT) AS cases_trailing_7d, round(max(baseline_z), 6) AS max_facility_z FROM fact GROUP BY 1, 2, 3, 4""",
    "not_null_check": " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, count(*) FILTER (WHERE {c} IS NULL) AS violations FROM ecr_cases" for c in ("message_control_id", "facility_id", "condition_code", "report_date", "message_ts", "patient_key")
    ),
    "unique_check": "SELECT case_daily_sk AS value, count(*) AS times FROM fct_case_daily WHERE case_daily_sk IS NOT NULL GROUP BY 1 HAVING count(*) > 1",
    "accepted_check": "SELECT sex AS value, count(*) AS times FROM ecr_cases WHERE sex NOT IN ('M', 'F', 'O', 'U') GROUP BY 1",
    "fk_check": """SELECT message_control_id AS value, count(*) AS times FROM extraction_results e WHERE message_control_id IS NOT NULL
  AND NOT EXISTS (SELECT 1 FROM ecr_cases c WHERE c.message_control_id = e.message_control_id) GROUP BY 1""",
    "range_check": "SELECT message_control_id, age_years FROM ecr_cases WHERE age_years < 0 OR age_years > 120",
    "reconcile_check": f"""WITH {_FACT} SELECT * FROM (SELECT CAST(coalesce(sum(case_count), 0) AS BIGINT) AS gold_cases FROM fact),
  (SELECT count(*) AS silver_cases FROM stg WHERE report_date BETWEEN DATE '2025-11-03' AND DATE '2026-06-30') WHERE gold_cases <> silver_cases""",
    "mart_checks": f"""WITH {_FACT}, agg AS (SELECT DISTINCT report_date, condition_code FROM fact), n AS (SELECT
  (SELECT count(*) FROM (SELECT sum(case_count) AS g FROM fact), (SELECT count(*) AS c FROM stg WHERE report_date BETWEEN DATE '2025-11-03' AND DATE '2026-06-30') WHERE coalesce(g, 0) <> c) AS off)
{" UNION ALL ".join(f"SELECT 'not_null {label}.{c}' AS check, count(*) FILTER (WHERE {c} IS NULL) AS violations FROM {t}" for label, t, cs in _MART_KEYS for c in cs)}
UNION ALL {" UNION ALL ".join(f"SELECT 'unique {label}.{c}', count(*) FROM (SELECT {c} FROM {t} WHERE {c} IS NOT NULL GROUP BY 1 HAVING count(*) > 1)" for label, t, cs in _MART_UNIQUE for c in cs)}
UNION ALL SELECT 'accepted dim_facility.reporting_status', count(DISTINCT reporting_status) FROM fac WHERE reporting_status NOT IN ('active', 'stale')
UNION ALL SELECT 'accepted dim_condition.condition_group', count(DISTINCT condition_group) FROM con WHERE condition_group NOT IN ('enteric', 'respiratory', 'other')
UNION ALL SELECT 'relationship fct_case_daily.facility_id', count(DISTINCT facility_id) FROM fact WHERE facility_id NOT IN (SELECT facility_id FROM fac WHERE facility_id IS NOT NULL)
UNION ALL SELECT 'relationship fct_case_daily.condition_code', count(DISTINCT condition_code) FROM fact WHERE condition_code NOT IN (SELECT condition_code FROM con WHERE condition_code IS NOT NULL)
UNION ALL SELECT 'range fct_case_daily.case_count', count(*) FROM fact WHERE case_count < 0
UNION ALL SELECT 'gold reconciles silver', off FROM n UNION ALL SELECT 'no future report dates', count(*) FROM stg WHERE report_date > ingest_date""",
    "future_check": f"WITH {_PARSED} SELECT row_id, CAST(report_date AS VARCHAR) AS report_date, ingest_date FROM parsed WHERE report_date > TRY_CAST(ingest_date AS DATE)",
    "label_days": f"WITH {_LABELS} SELECT facility_id, condition_name, 1 AS is_outbreak_day, CAST(report_date AS VARCHAR) AS report_date FROM labels",
    "range_lookup": f"""WITH {_FACT}, {_LABELS}, r AS (SELECT f.report_date, f.facility_id, f.condition_name, w.multiplier, row_number() OVER (PARTITION BY f.report_date, f.facility_id, f.condition_code ORDER BY w.a) AS rn
  FROM fact f JOIN win w ON w.facility_id = f.facility_id AND w.condition_name = f.condition_name AND f.report_date BETWEEN w.a AND w.b)
SELECT facility_id, condition_name, multiplier::DOUBLE AS multiplier, CAST(report_date AS VARCHAR) AS report_date FROM r WHERE rn = 1""",
    "outbreak_features": f"""WITH {_FEATURES} SELECT facility_id, condition_code, case_count, lag_1_cases, lag_7_cases, delta_1_cases, day_of_week, is_weekend, is_enteric, is_respiratory, is_outbreak_day,
  CAST(report_date AS VARCHAR) AS report_date, round(prior_mean_cases, 6) AS prior_mean_cases, round(ratio_to_baseline, 6) AS ratio_to_baseline, round(baseline_z, 6) AS baseline_z FROM feat""",
    "temporal_split": f"""WITH {_SCORED}, p AS (SELECT *, CASE WHEN report_date <= (SELECT max(report_date) FROM scored) - 75 THEN 'train' ELSE 'test' END AS part FROM scored)
SELECT part, count(*) AS n, count(DISTINCT report_date) AS days, CAST(min(report_date) AS VARCHAR) AS first, CAST(max(report_date) AS VARCHAR) AS last, CAST(sum(label) AS BIGINT) AS positives FROM p GROUP BY part""",
    "alert_threshold": f"""WITH {_SCORED}, b AS (SELECT count(score) AS n, 8.0 * greatest(count(DISTINCT report_date) / 7.0, 1) AS x FROM scored),
k AS (SELECT CAST(least(greatest(round_even(x, 0), 1), n - 1) AS BIGINT) AS budget FROM b)
SELECT budget, (SELECT min(score) FROM (SELECT score, row_number() OVER (ORDER BY score DESC) AS rn FROM scored), k WHERE rn <= k.budget) AS threshold FROM k""",
    "rule_alerts": f"""WITH {_SCORED} SELECT z, tp, fp, fn, {_RATIOS} FROM (SELECT 2.0::DOUBLE AS z, * FROM ({_confusion('coalesce(baseline_z >= 2, false)')})
  UNION ALL SELECT 3.0::DOUBLE, * FROM ({_confusion('coalesce(baseline_z >= 3, false)')}))""",
    "confusion": f"WITH {_SCORED} SELECT tp, fp, fn, tp + fp AS alerts, {_RATIOS} FROM ({_confusion('score >= 0.2')})",
    "ranking_metrics": f"""WITH {_SCORED}, g AS (SELECT score, CAST(sum(label) AS BIGINT) AS pos, count(*) AS n FROM scored GROUP BY score),
c AS (SELECT *, sum(pos) OVER (ORDER BY score DESC) AS cp, sum(n) OVER (ORDER BY score DESC) AS cn, sum(pos) OVER () AS p, sum(n) OVER () AS t FROM g)
SELECT round(CAST(sum(pos::DOUBLE / p * cp / cn) AS DOUBLE), 6) AS average_precision, round(CAST(sum((n - pos)::DOUBLE * (cp - pos / 2.0)) / max(p::DOUBLE * (t - p)) AS DOUBLE), 6) AS roc_auc FROM c""",
    "brier": f"WITH {_SCORED} SELECT round(avg((score - label) * (score - label)), 6) AS brier FROM scored",
    "recent_signals": f"""WITH {_SCORED} SELECT facility_id, condition_code, condition_name, case_count, score AS signal_score, CAST(score >= 0.15 AS INTEGER) AS is_signal, 0.15::DOUBLE AS threshold, '1' AS model_version,
  round(baseline_z, 6) AS baseline_z, CAST(report_date AS VARCHAR) AS report_date FROM scored WHERE report_date > (SELECT max(report_date) FROM scored) - 14""",
    "tokens": f"SELECT doc_id AS id, array_to_string({_tokens('text')}, ' ') AS tokens FROM documents",
    "doc_freq": f"WITH {_bm25(_DOCUMENTS, DOCUMENT_QUESTIONS)} SELECT term, df AS doc_freq FROM freq",
    "bm25_topk": f"WITH {_bm25(_DOCUMENTS, DOCUMENT_QUESTIONS)} SELECT query_id, id, rank, round(score, 6) AS score FROM ranked WHERE rank <= 10",
    "index_topk": f"WITH {_bm25(_DOCUMENTS, DOCUMENT_QUESTIONS)} SELECT query_id, id, rank, round(score, 6) AS score FROM ranked WHERE rank <= 10",
    "rule_replies": f"""SELECT message_control_id, array_to_string({_found('n')}, ',') AS symptoms, {_onset('n')} AS onset_date,
  nullif({_exposure('n')}, '') AS exposure_setting, {_travel('n')} AS recent_travel, 'high' AS confidence
  FROM (SELECT DISTINCT message_control_id, clinical_note, lower(clinical_note) AS n FROM ecr_cases WHERE clinical_note IS NOT NULL)""",
    "facts": f"""WITH n AS (SELECT message_control_id, coalesce(max(clinical_note), '') AS note, lower(coalesce(max(clinical_note), '')) AS n FROM ecr_cases GROUP BY 1),
  f AS (SELECT *, {_onset('n')} AS onset, {_found('n')} AS symptoms FROM n),
  g AS (SELECT *, onset IS NOT NULL AND (TRY_CAST(onset AS DATE) IS NULL OR NOT contains(note, CAST(TRY_CAST(onset AS DATE) AS VARCHAR))) AS bad FROM f)
SELECT message_control_id, CASE WHEN bad THEN '' ELSE array_to_string({_mapped('symptoms')}, ',') END AS symptoms_mapped,
  CASE WHEN NOT bad THEN CAST(TRY_CAST(onset AS DATE) AS VARCHAR) END AS onset_date, CASE WHEN NOT bad THEN nullif({_exposure('n')}, '') END AS exposure_setting,
  NOT bad AND {_travel('n')} AS recent_travel, bad AS extraction_failed, 1 AS attempts FROM g""",
    "refusal_floor": f"""WITH {_bm25(_DOCUMENTS, DOCUMENT_QUESTIONS)} SELECT q.query_id, round(max(score), 6) AS best, coalesce(max(score) < 5, true) AS refused
  FROM q LEFT JOIN ranked ON ranked.query_id = q.query_id GROUP BY 1""",
    "grounded_answers": f"WITH {_ANSWERS} SELECT query_id, answer, grounded, citations FROM answers",
    "retrieval_eval": f"WITH {_FOUND} SELECT * FROM found",
    "stub_extract": f"""SELECT message_control_id, array_to_string({_found('n')}, ',') AS symptoms, {_onset('n')} AS onset_date,
  {_exposure('n')} AS exposure_setting, {_travel('n')} AS recent_travel
  FROM (SELECT DISTINCT message_control_id, clinical_note, lower(clinical_note) AS n FROM ecr_cases WHERE clinical_note IS NOT NULL)""",
    "vocab_map": f"""WITH t AS (SELECT extraction_id, list_filter(list_transform(list_filter(coalesce(symptoms, []), lambda t: t IS NOT NULL), lambda t: lower(trim(t))), lambda t: t <> '') AS ts FROM extraction_results)
SELECT extraction_id, array_to_string({_mapped('ts')}, ',') AS symptoms_mapped, array_to_string(list_filter(ts, lambda t: ({_entry('t')}) IS NULL), ',') AS unmapped_terms FROM t""",
    "date_grounding": """WITH n AS (SELECT message_control_id, max(clinical_note) AS note FROM ecr_cases GROUP BY 1)
SELECT extraction_id, onset_date IS NULL OR coalesce(contains(note, CAST(CAST(onset_date AS DATE) AS VARCHAR)), false) AS grounded FROM extraction_results LEFT JOIN n USING (message_control_id)""",
    "extraction_eval": f"WITH {_EVAL} SELECT * FROM metrics",
    "worst_cases": f"""WITH {_GOLDEN} SELECT message_control_id, array_to_string(list_sort(missing), ',') AS missing, array_to_string(list_sort(spurious), ',') AS spurious, onset_ok, exposure_ok
  FROM j WHERE NOT failed AND (len(missing) > 0 OR len(spurious) > 0 OR NOT onset_ok OR NOT exposure_ok) ORDER BY message_control_id LIMIT 5""",
    "gates": f"""WITH {_EVAL}, {_FOUND} SELECT gate, value::DOUBLE AS value, bound::DOUBLE AS bound, breached FROM metrics, found, LATERAL (VALUES {_GATES}) v(gate, value, bound, breached)""",
    "land_bronze": """SELECT ingest_date, count(*) AS messages, count(DISTINCT sha256(payload_hl7)) AS payloads, 1 AS batches, count(message_id) AS named, 0 AS second_run
  FROM ecr_messages GROUP BY 1""",
    "silver_lake": f"""WITH {_PARSED}, d AS (SELECT {_SHA} AS sha, report_date, row_number() OVER (PARTITION BY {_SHA} ORDER BY received_at NULLS FIRST, _ingest_ts NULLS FIRST, message_id NULLS FIRST) AS rn
  FROM judged WHERE len(f) = 0)
SELECT 'silver' AS layer, strftime(report_date, '%Y-%m') AS part, count(*) AS n FROM d WHERE rn = 1 GROUP BY ALL
UNION ALL SELECT 'quarantine', ingest_date, count(*) FROM judged WHERE len(f) > 0 GROUP BY ALL""",
    "small_files": "SELECT how, condition_code, condition_name, lifetime_case_count FROM dim_condition, (VALUES ('document'), ('lines'), ('single')) v(how)",
    "stream_ingest": "SELECT ingest_date, count(*) AS messages FROM ecr_messages GROUP BY 1",
    "stream_daily": "SELECT CAST(CAST(ts AS DATE) AS VARCHAR) AS day, event_type, count(*) AS n FROM events GROUP BY ALL",
    "stream_dedupe": "SELECT count(DISTINCT _payload_sha256) AS messages, count(DISTINCT _payload_sha256) AS payloads FROM ecr_messages",
}
