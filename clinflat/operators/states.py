"""Statistics as mergeable states, so that a new part of the data is read alone.

A state is a table ``part, kind, key, n, lo, hi`` with one row for each key of a kind:

* ``patient``: rows of the long table of each patient (null is one of them);
* ``code``: rows of each code, ``lo`` its alphabetically first display;
* ``type``: resources of each type, ``day``: first and last day of each type;
* ``year``: patients by year of birth, ``system``: mentions of each coding system.

Numbers add up, ``lo`` and ``hi`` take the smallest and largest: the merge of the states of
all parts is the state of all data, so the statistics of everything never open the parts
again. Keys are the patients, codes and systems themselves, which keeps distinct counts
exact; a state is as large as its distinct keys, not as the data.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from clinflat import schemas
from clinflat.functions.fhirpath import unnest
from clinflat.sources.resources import with_promoted

STATE = "part string, kind string, key string, n long, lo string, hi string"


def _entry(kind: str, key: Column, value: Column | None = None) -> Column:
    none = F.lit(None).cast("string")
    return F.struct(
        F.lit(kind).alias("kind"), key.cast("string").alias("key"),
        (none if value is None else value).alias("value"),
    )


def _counted(entries: DataFrame) -> DataFrame:
    """State of entries ``part, e``: counted by value first, so only few values are compared."""
    values = entries.select("part", "e.kind", "e.key", "e.value")
    counted = values.groupBy("part", "kind", "key", "value").agg(F.count(F.lit(1)).alias("n"))
    return counted.groupBy("part", "kind", "key").agg(
        F.sum("n").alias("n"), F.min("value").alias("lo"), F.max("value").alias("hi")
    )


def row_states(rows: DataFrame, part: Column) -> DataFrame:
    """Patients and codes of a long table, by ``part``, in one pass."""
    named = F.col("code").isNotNull() & F.col("display").isNotNull()
    entries = F.array(
        _entry("patient", F.col("pid")),
        F.when(named, _entry("code", F.col("code"), F.col("display"))),
    )
    return _counted(unnest(rows, entries, "e", part.alias("part")))


def resource_states(resources: DataFrame, part: Column) -> DataFrame:
    """Types, days, birth years and systems of resources, by ``part``, in one pass.

    ``part`` may use the promoted columns. Only the JSON of patients is opened, if
    the resources come from a lake.
    """
    rows = resources if "systems" in resources.columns else with_promoted(resources)
    is_patient = F.col("resource_type") == schemas.PATIENT_TYPE
    birth_date = F.from_json(F.when(is_patient, F.col("json")), "struct<birthDate:string>")["birthDate"]
    year = F.substring(birth_date, 1, 4).try_cast("int")
    day = F.substring("date", 1, 10)
    kind = F.col("resource_type")
    named = F.filter(F.coalesce("systems", F.array().cast("array<string>")), lambda s: s != "")
    entries = F.concat(
        F.array(
            _entry("type", kind),
            F.when(day.isNotNull(), _entry("day", kind, day)),
            F.when(year.isNotNull(), _entry("year", year)),
        ),
        F.transform(named, lambda s: _entry("system", s)),
    )
    return _counted(unnest(rows, entries, "e", part.alias("part")))


def write_states(states: DataFrame, path: str) -> None:
    """Replace the parts that ``states`` has under ``path``; all other parts stay."""
    placed = states.select("part", "kind", "key", "n", "lo", "hi")
    placed = placed.sortWithinPartitions("part", "kind")  # kinds are read on their own
    writer = placed.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    writer.partitionBy("part").parquet(path)


def read_states(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(STATE).parquet(path)


def merged(states: DataFrame) -> DataFrame:
    """The state of all parts together, ``kind, key, n, lo, hi``.

    Patients, by far the most keys, have no texts to compare, so their numbers stay in a
    hash aggregation.
    """
    patients = states.where(F.col("kind") == "patient").groupBy("kind", "key").agg(F.sum("n").alias("n"))
    rest = states.where(F.col("kind") != "patient").groupBy("kind", "key").agg(
        F.sum("n").alias("n"), F.min("lo").alias("lo"), F.max("hi").alias("hi")
    )
    return rest.unionByName(patients, allowMissingColumns=True)


def statistics(state: DataFrame, resource_type: str, reference_year: int) -> DataFrame:
    """The row of ``stats.dataset_stats`` from a merged state, coverage of ``resource_type``."""
    kind, n = F.col("kind"), F.col("n")
    age = F.lit(reference_year) - F.when(kind == "year", F.col("key").cast("int"))
    dated = (kind == "day") & (F.col("key") == resource_type)
    return state.agg(
        F.coalesce(F.sum(F.when(kind == "patient", n)), F.lit(0)).alias("record_count"),
        F.count(F.when(kind == "patient", 1)).alias("unique_patients"),
        F.coalesce(F.min(age), F.lit(0)).alias("min_age"),
        F.coalesce(F.max(age), F.lit(0)).alias("max_age"),
        F.min(F.when(dated, F.col("lo"))).alias("start_date"),
        F.max(F.when(dated, F.col("hi"))).alias("end_date"),
    )


def vocabulary(state: DataFrame, vocab_id: str) -> DataFrame:
    """``vocab.code_vocabulary`` from a merged state."""
    return state.where(F.col("kind") == "code").select(
        F.lit(vocab_id).alias("vocab_id"), F.col("key").alias("code"), F.col("lo").alias("display")
    )


def systems(state: DataFrame) -> DataFrame:
    """``stats.coding_systems`` from a merged state: the union over parts and jobs."""
    return state.where(F.col("kind") == "system").select(F.col("key").alias("system"))


def type_counts(state: DataFrame) -> DataFrame:
    """``stats.resource_counts`` from a merged state."""
    return state.where(F.col("kind") == "type").select(F.col("key").alias("resource_type"), "n")
