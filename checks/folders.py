"""Queries and oracles: transaction entries and folder bundling."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks import fixtures as fx
from checks import sql
from clinflat.operators import bundle
from clinflat.session import table_path
from clinflat.sources.bundles import read_entries
from clinflat.sources.sinks import write_entries


def bundle_entries(spark, d):
    """All resources as entries, some of them without an id."""
    rows = fx.resources(spark, d).withColumn(
        "id", F.when(~F.endswith("id", F.lit("7")), F.col("id"))
    )
    return bundle.transaction_entries(rows).select("rank", "resource_type", "id", "method", "url")


def _patient_files(spark, d):
    """A folder per customer with a marker file, a Patient file, or neither."""
    k = F.col("c_custkey")
    file = F.when(k % 3 == 0, F.lit("patient.json")).otherwise(F.lit("Person.JSON"))
    broken = F.lit("{not json")
    json = F.concat(F.lit('{"resourceType":"Patient","id":"p'), k, F.lit('"}'))
    rows = fx.table(spark, d, "customer").where(k % 3 != 2)
    return rows.select(
        F.concat(F.lit("c"), k).alias("dir"), file.alias("file"),
        F.when(k % 6 == 0, broken).otherwise(json).alias("json"),
    )


def _observation_files(spark, d):
    """A file per event in its user's folder: copies, missing ids, broken and other files,
    every fourth one spread over several lines."""
    e = F.col("event_id")
    rid = (
        F.when(e % 5 == 0, F.concat(F.lit("dup"), e % 50))
        .when(e % 6 == 0, F.lit(None).cast("string"))
        .otherwise(F.concat(F.lit("o"), e))
    )
    ext = F.when(e % 7 == 0, F.lit(".txt")).otherwise(F.lit(".json"))
    json = F.concat(
        F.lit('{"resourceType":"Observation"'),
        F.coalesce(F.concat(F.lit(',"id":"'), rid, F.lit('"')), F.lit("")),
        F.lit(',"status":"'), "event_type", F.lit('"}'),
    )
    json = F.when(e % 4 == 0, F.replace(json, F.lit(',"'), F.lit(',\n  "'))).otherwise(json)
    return fx.table(spark, d, "events").select(
        F.concat(F.lit("c"), F.col("user_id")).alias("dir"),
        F.concat(F.lit("obs"), e, ext).alias("file"),
        F.when(e % 10 == 1, F.lit('{"id":"no type"}')).otherwise(json).alias("json"),
    )


def _definition_files(spark, d):
    p = F.col("p_partkey")
    json = F.concat(F.lit('{"resourceType":"Questionnaire","id":"q'), p % 1000, F.lit('"}'))
    return fx.table(spark, d, "part").select(
        F.lit("Questionnaire").alias("dir"), F.concat(F.lit("q"), p, F.lit(".json")).alias("file"),
        json.alias("json"),
    )


def files(spark, d):
    rows = (
        _patient_files(spark, d)
        .unionByName(_observation_files(spark, d))
        .unionByName(_definition_files(spark, d))
    )
    return rows.withColumn("path", F.concat(F.lit("/data/"), "dir", F.lit("/"), "file"))


def patient_dirs(spark, d):
    return bundle.patient_dirs(files(spark, d))


def dir_resources(spark, d):
    return bundle.dir_resources(files(spark, d)).select("dir", "file", "resource_type", "id")


def bundle_dedup(spark, d):
    unique = bundle.deduplicate(bundle.dir_resources(files(spark, d)))
    return unique.select("resource_type", "id", "dir", "file", "json")


def folder_entries(spark, d):
    return bundle.folder_entries(files(spark, d))


def entries_roundtrip(spark, d):
    """Entries written to files and read again as resources."""
    path = table_path(spark, "entries-roundtrip")
    write_entries(bundle.folder_entries(files(spark, d)), path)
    return read_entries(spark, f"{path}/entries")


QUERIES = {
    "entries_roundtrip": entries_roundtrip,
    "bundle_entries": bundle_entries,
    "patient_dirs": patient_dirs,
    "dir_resources": dir_resources,
    "bundle_dedup": bundle_dedup,
    "folder_entries": folder_entries,
}

_FILES = """files AS (
  SELECT 'c' || c_custkey AS dir,
         CASE WHEN c_custkey % 3 = 0 THEN 'patient.json' ELSE 'Person.JSON' END AS file,
         CASE WHEN c_custkey % 6 <> 0 THEN 'Patient' END AS resource_type,
         CASE WHEN c_custkey % 6 <> 0 THEN 'p' || c_custkey END AS id,
         '{"resourceType":"Patient","id":"p' || c_custkey || '"}' AS json
  FROM customer WHERE c_custkey % 3 <> 2
  UNION ALL
  SELECT dir, file, CASE WHEN event_id % 7 <> 0 AND event_id % 10 <> 1 THEN 'Observation' END, rid,
         CASE WHEN event_id % 4 = 0 THEN replace(body, ',"', ',' || chr(10) || '  "') ELSE body END
  FROM (SELECT *, 'c' || user_id AS dir,
          'obs' || event_id || CASE WHEN event_id % 7 = 0 THEN '.txt' ELSE '.json' END AS file,
          CASE WHEN event_id % 5 = 0 THEN 'dup' || event_id % 50
               WHEN event_id % 6 = 0 THEN NULL ELSE 'o' || event_id END AS rid,
          '{"resourceType":"Observation"' || coalesce(',"id":"' || rid || '"', '')
          || ',"status":"' || event_type || '"}' AS body FROM events)
  UNION ALL
  SELECT 'Questionnaire', 'q' || p_partkey || '.json', 'Questionnaire', 'q' || p_partkey % 1000,
         '{"resourceType":"Questionnaire","id":"q' || p_partkey % 1000 || '"}' FROM part),
pdirs AS (SELECT DISTINCT dir FROM files
  WHERE dir <> 'Questionnaire' AND (file = 'patient.json' OR resource_type = 'Patient')),
held AS (SELECT * FROM files WHERE resource_type IS NOT NULL
  AND (dir = 'Questionnaire' OR dir IN (SELECT dir FROM pdirs))),
uniq AS (SELECT * FROM held QUALIFY row_number() OVER (
  PARTITION BY resource_type, id IS NULL, coalesce(id, replace(json, chr(10) || '  ', ''))
  ORDER BY dir <> 'Questionnaire', dir, file) = 1)"""

_RANK = """CASE resource_type WHEN 'Patient' THEN 0 WHEN 'Observation' THEN 1
  WHEN 'QuestionnaireResponse' THEN 2 ELSE 3 END"""
_REQUEST = """CASE WHEN id IS NULL THEN 'POST' ELSE 'PUT' END AS method,
  resource_type || coalesce('/' || id, '') AS url"""

ORACLES = {
    "bundle_entries": sql.with_(sql.PAT, sql.ORD)
    + f"""SELECT {_RANK} AS rank, resource_type, id, {_REQUEST} FROM (
          SELECT resource_type, CASE WHEN id NOT LIKE '%7' THEN id END AS id FROM (
            SELECT 'Patient' AS resource_type, patient_uuid AS id FROM pat
            UNION ALL SELECT 'Observation', 'o' || event_id FROM events
            UNION ALL SELECT 'QuestionnaireResponse', rid FROM ord
            UNION ALL SELECT 'QuestionnaireResponse', rid FROM lin
            UNION ALL SELECT 'Questionnaire', 'q' || p_partkey FROM part
            UNION ALL SELECT 'Questionnaire', 'u' || s_suppkey FROM supplier))""",
    "entries_roundtrip": sql.with_(_FILES)
    + "SELECT resource_type, id, replace(json, chr(10) || '  ', '') AS json FROM uniq",
    "patient_dirs": sql.with_(_FILES) + "SELECT dir FROM pdirs",
    "dir_resources": sql.with_(_FILES) + "SELECT dir, file, resource_type, id FROM held",
    "bundle_dedup": sql.with_(_FILES) + "SELECT resource_type, id, dir, file, json FROM uniq",
    "folder_entries": sql.with_(_FILES)
    + f"""SELECT rank, resource_type, id, method, url, '{{"resource":'
          || replace(json, chr(10), ' ') || ',"request":{{"method":"' || method || '","url":"' || url || '"}}}}' AS entry
        FROM (SELECT {_RANK} AS rank, resource_type, id, json, {_REQUEST} FROM uniq)""",
}
