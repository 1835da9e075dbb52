"""Queries and oracles: scans, observations, patients, observation statistics."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks import fixtures as fx
from checks import sql
from clinflat.functions.fhirpath import first_coding, reference_key
from clinflat.operators import observation as ob
from clinflat.operators import profile, states, stats, vocab
from clinflat.operators.window import Window
from clinflat.session import table_path
from clinflat.sources import bundles, resources, sinks
from clinflat.streaming import arrival

YEAR = 2026
METRICS = ["click", "view", "error", "a"]
WINDOW = Window("2024-01-05", "2024-01-20T12:00:00Z")
MONTHS = Window("1997-02", "1998-06-15")


def scan_resources(spark, d):
    junk = fx.table(spark, d, "pages").select(F.col("url").alias("value"))
    untyped = fx.table(spark, d, "supplier").select(
        F.to_json(F.struct(F.col("s_name").alias("id"))).alias("value")
    )
    typed = fx.resources(spark, d).select(F.col("json").alias("value"))
    lines = typed.unionByName(junk).unionByName(untyped)
    return resources.from_json_lines(lines).select("resource_type", "id")


def scan_bundle(spark, d):
    observed = fx.observations(spark, d)
    doc = F.concat(
        F.lit('{"resourceType":"Bundle","type":"searchset","entry":[{"resource":'), F.col("json"),
        F.lit('},{"search":{"mode":"outcome"}},{"resource":{"resourceType":"Patient","id":"of-'),
        F.col("id"), F.lit('"}}]}'),
    )
    return bundles.bundle_resources(observed.select(doc.alias("value"))).select(
        "resource_type", "id"
    )


def window_filter_obs(spark, d):
    rows = resources.scan(fx.observations(spark, d), "Observation", WINDOW)
    return rows.select("resource_type", "id")


def window_filter_qr(spark, d):
    rows = resources.scan(fx.responses(spark, d), "QuestionnaireResponse", MONTHS)
    return rows.select("resource_type", "id")


def patient_id_map(spark, d):
    return ob.patient_id_map(fx.patients(spark, d))


def reference_keys(spark, d):
    refs = fx.observations(spark, d).select(
        "id", F.get_json_object("json", "$.subject.reference").alias("reference")
    )
    return refs.select("id", "reference", reference_key(F.col("reference")).alias("patient_uuid"))


def obs_root(spark, d):
    return ob.root_rows(fx.observations(spark, d))


def obs_components(spark, d):
    return ob.component_rows(fx.observations(spark, d))


def first_codings(spark, d):
    coding = F.col("r.code.coding")
    return ob.parse(fx.observations(spark, d)).select(
        F.col("resource_id").alias("id"),
        first_coding(coding, "code").alias("code"),
        first_coding(coding, "display").alias("display"),
    )


def obs_value_root(spark, d):
    return ob.parse(fx.observations(spark, d)).select(
        F.col("resource_id").alias("id"), ob.root_value(F.col("r")).alias("value")
    )


def obs_value_component(spark, d):
    parts = ob.parse(fx.observations(spark, d)).select(F.explode("r.component").alias("c"))
    return parts.select(
        first_coding(F.col("c.code.coding"), "code").alias("code"),
        ob.component_value(F.col("c")).alias("value"),
    )


def value_with_unit(spark, d):
    return ob.measurements(fx.observations(spark, d)).select(
        F.col("resource_id").alias("id"), "code", "value"
    )


def obs_long(spark, d):
    return ob.long_observations(fx.observations(spark, d), fx.patients(spark, d))


def obs_long_salted(spark, d):
    """The same table with the join used when the patient map is too large to broadcast."""
    return ob.long_observations(fx.observations(spark, d), fx.patients(spark, d), limit=0)


def sink_csv_roundtrip(spark, d):
    path = table_path(spark, "csv")
    rows = obs_long(spark, d)
    sinks.write_table(rows, path, "csv")
    return spark.read.schema(rows.schema).option("header", True).option("escape", '"').csv(path)


def sink_parquet_roundtrip(spark, d):
    path = table_path(spark, "parquet")
    rows = obs_long(spark, d)
    sinks.write_table(rows, path, "parquet")
    return spark.read.schema(rows.schema).parquet(path)


def profile_pivot(spark, d):
    return profile.patient_profiles(obs_long(spark, d), METRICS)


def profile_sparse(spark, d):
    """All codes of every patient, the map's entries as text."""
    entries = F.map_entries("metrics")
    texts = F.transform(entries, lambda e: F.concat(e["key"], F.lit("="), e["value"]))
    rows = profile.sparse_profiles(obs_long(spark, d))
    return rows.select("pid", F.array_join(texts, "; ").alias("metrics"))


def profile_sparse_columns(spark, d):
    return profile.metric_columns(profile.sparse_profiles(obs_long(spark, d)), METRICS)


def age_stats(spark, d):
    return stats.age_stats(fx.patients(spark, d), YEAR)


def temporal_coverage(spark, d):
    return stats.temporal_coverage(fx.observations(spark, d), "Observation")


def dataset_stats(spark, d):
    observed, patients = fx.observations(spark, d), fx.patients(spark, d)
    coverage = stats.temporal_coverage(observed, "Observation")
    return stats.dataset_stats(ob.long_observations(observed, patients), patients, coverage, YEAR)


def dataset_stats_cohort(spark, d):
    """Ages and dates of the patients with observations only."""
    observed, patients = fx.observations(spark, d), fx.patients(spark, d)
    coverage = stats.temporal_coverage(observed, "Observation")
    rows = ob.long_observations(observed, patients)
    return stats.dataset_stats(rows, patients, coverage, YEAR, cohort_only=True)


def vocab_observation(spark, d):
    return vocab.code_vocabulary(obs_long(spark, d), "observation_codes")


def coding_systems(spark, d):
    parts = (fx.observations, fx.responses, fx.questionnaires, fx.patients)
    return stats.coding_systems(*[p(spark, d) for p in parts])


def _monthly_states(spark, d):
    """The state of all observations and patients, kept by month and merged."""
    path = table_path(spark, "states")
    observed, patients = fx.observations(spark, d), fx.patients(spark, d)
    month = F.coalesce(F.substring("date", 1, 7), F.lit("undated"))
    rows = states.row_states(ob.long_observations(observed, patients), month)
    kept = states.resource_states(observed.unionByName(patients), month)
    states.write_states(rows.unionByName(kept), path)
    return states.merged(states.read_states(spark, path))


def stats_from_states(spark, d):
    return states.statistics(_monthly_states(spark, d), "Observation", YEAR)


def vocab_from_states(spark, d):
    return states.vocabulary(_monthly_states(spark, d), "observation_codes")


def systems_from_states(spark, d):
    """Systems of two jobs that share the patients, each with a state of its own."""
    path = table_path(spark, "states")
    jobs = {
        "observation": (fx.observations, fx.patients),
        "survey": (fx.responses, fx.questionnaires, fx.patients),
    }
    for job, parts in jobs.items():
        for p in parts:
            part = F.lit(f"{job}-{p.__name__}")
            states.write_states(states.resource_states(p(spark, d), part), path)
    return states.systems(states.merged(states.read_states(spark, path)))


def arrival_steps(spark, d):
    """All resources as files of lines, taken into the lake by a stream in several batches."""
    source, lake, checkpoint = (table_path(spark, x) for x in ("lines", "lake", "checkpoint"))
    fx.resources(spark, d).select("json").write.option("compression", "gzip").text(source)
    stream = arrival.arriving(spark, source, files_a_batch=16)
    arrival.write_arrivals(stream, lake, checkpoint).awaitTermination()
    return arrival.read_arrivals(spark, lake).select("resource_type", "id", "date")


def resource_counts(spark, d):
    return stats.resource_counts(fx.resources(spark, d))


QUERIES = {
    "scan_resources": scan_resources,
    "scan_bundle": scan_bundle,
    "window_filter_obs": window_filter_obs,
    "window_filter_qr": window_filter_qr,
    "patient_id_map": patient_id_map,
    "reference_key": reference_keys,
    "obs_root": obs_root,
    "obs_components": obs_components,
    "first_coding": first_codings,
    "obs_value_root": obs_value_root,
    "obs_value_component": obs_value_component,
    "value_with_unit": value_with_unit,
    "obs_long": obs_long,
    "obs_long_salted": obs_long_salted,
    "sink_csv_roundtrip": sink_csv_roundtrip,
    "sink_parquet_roundtrip": sink_parquet_roundtrip,
    "profile_pivot": profile_pivot,
    "profile_sparse": profile_sparse,
    "profile_sparse_columns": profile_sparse_columns,
    "age_stats": age_stats,
    "temporal_coverage": temporal_coverage,
    "dataset_stats": dataset_stats,
    "dataset_stats_cohort": dataset_stats_cohort,
    "vocab_observation": vocab_observation,
    "coding_systems": coding_systems,
    "stats_from_states": stats_from_states,
    "vocab_from_states": vocab_from_states,
    "systems_from_states": systems_from_states,
    "arrival_steps": arrival_steps,
    "resource_counts": resource_counts,
}

_IDS = """ids AS (
  SELECT 'Patient' AS resource_type, patient_uuid AS id FROM pat
  UNION ALL SELECT 'Observation', 'o' || event_id FROM events
  UNION ALL SELECT 'QuestionnaireResponse', rid FROM ord
  UNION ALL SELECT 'QuestionnaireResponse', rid FROM lin
  UNION ALL SELECT 'Questionnaire', 'q' || p_partkey FROM part
  UNION ALL SELECT 'Questionnaire', 'u' || s_suppkey FROM supplier)"""

_OBS_SELECT = sql.with_(*sql.OBSERVED) + "SELECT pid, code, display, value, date FROM obs_long"

_PERIOD = """CASE length(date) WHEN 7 THEN (date || '-01')::TIMESTAMP
    WHEN 10 THEN date::TIMESTAMP ELSE strptime(date, '%Y-%m-%dT%H:%M:%SZ') END AS lo,
  CASE length(date) WHEN 7 THEN (date || '-01')::TIMESTAMP + INTERVAL 1 MONTH
    WHEN 10 THEN date::TIMESTAMP + INTERVAL 1 DAY
    ELSE strptime(date, '%Y-%m-%dT%H:%M:%SZ') + INTERVAL 1 SECOND END AS hi"""

_REF = f"""CASE WHEN event_id % 103 = 0 THEN NULL WHEN event_id % 101 = 0 THEN 'Group/g'
  WHEN event_id % 3 = 0 THEN '{sql.BASE}fhir/Patient/p' || user_id
  WHEN event_id % 3 = 1 THEN 'Patient/p' || user_id || '/_history/2'
  ELSE 'Patient/p' || user_id END"""

_EARLIEST = ", ".join(
    f"""(arg_min(value, coalesce(date, 'undated') || chr(1) || value) FILTER (code = '{m}')) AS "{m}\""""
    for m in METRICS
)

_AGES = f"coalesce(min({YEAR} - birth_year), 0)::INT AS min_age, coalesce(max({YEAR} - birth_year), 0)::INT AS max_age"

ORACLES = {
    "scan_resources": sql.with_(sql.PAT, sql.ORD, _IDS) + "SELECT * FROM ids",
    "scan_bundle": """SELECT 'Observation' AS resource_type, 'o' || event_id AS id FROM events
        UNION ALL SELECT 'Patient', 'of-o' || event_id FROM events""",
    "window_filter_obs": sql.with_(sql.OBS, f"p AS (SELECT e, {_PERIOD} FROM obs)")
    + """SELECT 'Observation' AS resource_type, 'o' || e AS id FROM p
        WHERE hi > TIMESTAMP '2024-01-05' AND lo < TIMESTAMP '2024-01-20 12:00:01'""",
    "window_filter_qr": sql.with_(
        sql.ORD,
        f"p AS (SELECT rid, {_PERIOD} FROM (SELECT rid, date FROM ord UNION ALL SELECT rid, date FROM lin))",
    )
    + """SELECT 'QuestionnaireResponse' AS resource_type, rid AS id FROM p
        WHERE hi > TIMESTAMP '1997-02-01' AND lo < TIMESTAMP '1998-06-16'""",
    "patient_id_map": sql.with_(sql.PAT) + "SELECT patient_uuid, pid FROM pat",
    "reference_key": f"""SELECT 'o' || event_id AS id, {_REF} AS reference,
        CASE WHEN event_id % 103 = 0 OR event_id % 101 = 0 THEN NULL ELSE 'p' || user_id END
        AS patient_uuid FROM events""",
    "obs_root": sql.with_(sql.OBS)
    + "SELECT patient_uuid, date, code, display, v_qty, v_int, v_str, v_code, unit FROM obs",
    "obs_components": sql.with_(sql.OBS) + "SELECT * FROM comp",
    "first_coding": sql.with_(sql.OBS) + "SELECT 'o' || e AS id, code, display FROM obs",
    "obs_value_root": sql.with_(sql.OBS)
    + "SELECT 'o' || e AS id, coalesce(v_qty, v_int, v_str, v_code) AS value FROM obs",
    "obs_value_component": sql.with_(sql.OBS)
    + "SELECT code, coalesce(c_qty, c_int, c_str, c_bool, c_dt, c_code) AS value FROM comp",
    "value_with_unit": sql.with_(sql.OBS)
    + """SELECT 'o' || e AS id, code,
          coalesce(v_qty, v_int, v_str, v_code) || coalesce(' ' || unit, '') AS value
        FROM obs WHERE kind NOT IN (5, 7)
        UNION ALL
        SELECT 'o' || e, part, CASE ck WHEN 0 THEN vt || ' mmol' WHEN 1 THEN k
          WHEN 2 THEN 'text ' || et WHEN 3 THEN CASE WHEN v > 50 THEN 'true' ELSE 'false' END
          WHEN 4 THEN stamp ELSE 'grade ' || et END FROM part_kinds""",
    "obs_long": _OBS_SELECT,
    "obs_long_salted": _OBS_SELECT,
    "sink_csv_roundtrip": _OBS_SELECT,
    "sink_parquet_roundtrip": _OBS_SELECT,
    "profile_pivot": sql.with_(*sql.OBSERVED) + f"SELECT pid, {_EARLIEST} FROM obs_long GROUP BY pid",
    "profile_sparse": sql.with_(*sql.OBSERVED)
    + """SELECT pid, coalesce(string_agg(code || '=' || value, '; ' ORDER BY code), '') AS metrics FROM (
          SELECT pid, code, arg_min(value, coalesce(date, 'undated') || chr(1) || value) AS value
          FROM obs_long WHERE value IS NOT NULL GROUP BY pid, code) GROUP BY pid""",
    "profile_sparse_columns": sql.with_(*sql.OBSERVED)
    + f"SELECT pid, {_EARLIEST} FROM obs_long GROUP BY pid",
    "age_stats": sql.with_(sql.PAT) + f"SELECT {_AGES} FROM pat",
    "temporal_coverage": sql.with_(sql.OBS)
    + "SELECT min(left(date, 10)) AS start_date, max(left(date, 10)) AS end_date FROM obs",
    "dataset_stats": sql.with_(*sql.OBSERVED)
    + f"""SELECT (SELECT count(*) FROM obs_long) AS record_count,
          (SELECT count(DISTINCT pid) + max((pid IS NULL)::INT) FROM obs_long) AS unique_patients,
          min_age, max_age, start_date, end_date
        FROM (SELECT {_AGES} FROM pat),
             (SELECT min(left(date, 10)) AS start_date, max(left(date, 10)) AS end_date FROM obs)""",
    "dataset_stats_cohort": sql.with_(*sql.OBSERVED)
    + f"""SELECT record_count, unique_patients, min_age, max_age, start_date, end_date
        FROM (SELECT count(*) AS record_count, count(DISTINCT pid) + max((pid IS NULL)::INT) AS unique_patients,
                min(left(date, 10)) AS start_date, max(left(date, 10)) AS end_date FROM obs_long),
             (SELECT {_AGES} FROM pat WHERE pid IN (SELECT pid FROM obs_long))""",
    "vocab_observation": sql.with_(*sql.OBSERVED, sql.VOCAB_OBS) + "SELECT * FROM vocab_obs",
    "coding_systems": sql.with_(sql.PAT, sql.OBS)
    + f"""SELECT DISTINCT '{sql.BASE}' || s AS system FROM (
          SELECT 'event' AS s FROM events
          UNION ALL SELECT 'alt' FROM events WHERE event_id % 7 = 0
          UNION ALL SELECT unnest(['flag', 'flag2']) FROM obs WHERE kind = 4
          UNION ALL SELECT 'part' FROM part_kinds
          UNION ALL SELECT 'grade' FROM part_kinds WHERE ck = 5
          UNION ALL SELECT unnest(['status', 'priority']) FROM orders
          UNION ALL SELECT 'size' FROM lineitem
          UNION ALL SELECT 'option' FROM part
          UNION ALL SELECT 'id/' || c_nationkey FROM pat WHERE c_custkey % 5 <> 0)""",
    "resource_counts": sql.with_(sql.PAT, sql.ORD, _IDS)
    + "SELECT resource_type, count(*) AS n FROM ids GROUP BY resource_type",
}

ORACLES |= {
    "stats_from_states": ORACLES["dataset_stats"],
    "vocab_from_states": ORACLES["vocab_observation"],
    "systems_from_states": ORACLES["coding_systems"],
    "arrival_steps": sql.with_(sql.PAT, sql.OBS, sql.ORD, _IDS)
    + """SELECT resource_type, id, NULL AS date FROM ids
          WHERE resource_type IN ('Patient', 'Questionnaire')
        UNION ALL SELECT 'Observation', 'o' || e, date FROM obs
        UNION ALL SELECT 'QuestionnaireResponse', rid, date FROM ord
        UNION ALL SELECT 'QuestionnaireResponse', rid, date FROM lin""",
}
