"""The jobs end to end: scan, flatten, describe, write.

A job writes its long table once and reads it back for statistics, vocabularies
and the sink, so resources are parsed once per job however many results follow.
"""

from __future__ import annotations

from dataclasses import dataclass, replace
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clinflat import schemas
from clinflat.namespaces import OBSERVATION_CODES, QUESTION_CODES
from clinflat.operators import (
    bundle,
    full,
    observation,
    record_triples,
    schema_triples,
    stats,
    survey,
    triples,
    vocab,
)
from clinflat.operators import dictionary as dictionaries
from clinflat.operators.window import Window
from clinflat.session import stage
from clinflat.sources import resources as scans
from clinflat.sources.metadata import for_job
from clinflat.sources.sinks import write_entries, write_ntriples, write_table

# The output folder of each job.
FOLDERS = {
    "observation": "observation_profiles",
    "survey": "survey_profiles",
    "full": "patient_data",
    "bundle": "bundle_extraction",
}


@dataclass(frozen=True)
class Inputs:
    """Resources of the four types, the dated ones already inside the window."""

    patients: DataFrame
    observations: DataFrame
    responses: DataFrame
    questionnaires: DataFrame

    @staticmethod
    def of(resources: DataFrame, window: Window = Window()) -> Inputs:
        return Inputs(*[scans.scan(resources, t, window) for t in schemas.RESOURCE_TYPES])

    def all(self) -> list[DataFrame]:
        return [self.patients, self.observations, self.responses, self.questionnaires]


@dataclass(frozen=True)
class Extraction:
    """What one job yields before anything is written."""

    job: str
    rows: DataFrame
    vocabularies: DataFrame
    stats: DataFrame
    systems: DataFrame


def _observation(inputs: Inputs, year: int) -> Extraction:
    rows = stage(
        observation.long_observations(inputs.observations, inputs.patients), "observation"
    )
    coverage = stats.temporal_coverage(inputs.observations, schemas.OBSERVATION_TYPE)
    return Extraction(
        "observation",
        rows,
        vocab.code_vocabulary(rows, OBSERVATION_CODES),
        stats.dataset_stats(rows, inputs.patients, coverage, year),
        stats.coding_systems(inputs.observations, inputs.patients),
    )


def _survey_rows(inputs: Inputs) -> tuple[DataFrame, DataFrame]:
    rows, definitions = survey.extract(inputs.responses, inputs.questionnaires, inputs.patients)
    return stage(rows, "survey"), definitions


def _survey(inputs: Inputs, year: int) -> Extraction:
    rows, definitions = _survey_rows(inputs)
    coverage = stats.temporal_coverage(inputs.responses, schemas.RESPONSE_TYPE)
    return Extraction(
        "survey",
        rows,
        vocab.merge_vocabularies(
            vocab.option_vocabularies(definitions), vocab.code_vocabulary(rows, QUESTION_CODES)
        ),
        stats.dataset_stats(rows, inputs.patients, coverage, year),
        stats.coding_systems(inputs.responses, inputs.questionnaires, inputs.patients),
    )


def _full(inputs: Inputs, year: int) -> Extraction:
    observed = stage(
        observation.long_observations(inputs.observations, inputs.patients), "observation"
    )
    surveyed, definitions = _survey_rows(inputs)
    rows = full.long_full(observed, surveyed)
    return Extraction(
        "full",
        rows,
        vocab.merge_vocabularies(
            vocab.option_vocabularies(definitions),
            vocab.code_vocabulary(observed, OBSERVATION_CODES),
            vocab.code_vocabulary(surveyed, QUESTION_CODES),
        ),
        stats.dataset_stats(rows, inputs.patients, stats.row_coverage(rows), year),
        stats.coding_systems(*inputs.all()),
    )


_EXTRACT = {"observation": _observation, "survey": _survey, "full": _full}


def extract(job: str, inputs: Inputs, reference_year: int) -> Extraction:
    """Run one job; its small results are kept as tables, so later steps reread them."""
    result = _EXTRACT[job](inputs, reference_year)
    return replace(
        result,
        vocabularies=stage(result.vocabularies, "vocabularies"),
        stats=stage(result.stats, "stats"),
        systems=stage(result.systems, "systems"),
    )


def with_statistics(
    records: DataFrame, per_job: DataFrame, run: str, mode: str
) -> DataFrame:
    """Records with addresses, final statistics per job and dates over all jobs."""
    overall = stats.merge_stats(per_job).select(
        F.lit(run).alias("run"), F.col("start_date").alias("all_start"),
        F.col("end_date").alias("all_end"),
    )
    d = F.col("dataset")
    configured = records.select(
        "job",
        d["numRecords"].cast("bigint").alias("cfg_record_count"),
        d["numUniqueIndividual"].cast("bigint").alias("cfg_unique_patients"),
        d["minAge"].alias("cfg_min_age"),
        d["maxAge"].alias("cfg_max_age"),
        d["temporalCoverage"]["start"].alias("cfg_start_date"),
        d["temporalCoverage"]["end"].alias("cfg_end_date"),
    )
    final = stats.override_stats(configured, per_job, "job", mode)
    computed = F.lit(mode.lower() != "excel")
    coverage = F.col("catalog.temporalCoverage")
    addressed = record_triples.with_addresses(records, F.lit(run)).withColumn("run", F.lit(run))
    return (
        addressed.join(final, "job")
        .join(overall, "run")
        .withColumn("catalog_start", F.coalesce(F.when(computed, F.col("all_start")), coverage["start"]))
        .withColumn("catalog_end", F.coalesce(F.when(computed, F.col("all_end")), coverage["end"]))
    )


def schema_graph(extraction: Extraction, addresses: DataFrame) -> DataFrame:
    """Column and concept triples of a job's table."""
    spark = extraction.rows.sparkSession
    columns = schema_triples.schema_rows(spark, extraction.rows).withColumn(
        "job", F.lit(extraction.job)
    )
    linked = columns.join(vocab.column_links(extraction.vocabularies), "name", "left")
    placed = linked.join(
        addresses.select(
            "job", F.col("csvw_uri").alias("subject"), F.col("distribution_uri").alias("parent")
        ),
        "job",
    )
    return triples.as_graph(
        schema_triples.csvw_triples(placed), triples.concept_schemes(extraction.vocabularies)
    )


def run_jobs(
    spark: SparkSession,
    resources: DataFrame,
    records: DataFrame,
    output: str,
    jobs: list[str],
    reference_year: int,
    run: str,
    window: Window = Window(),
    fmt: str = "csv",
    single_file: bool = False,
    mode: str = "json",
) -> None:
    """Extract all jobs, then write their tables and metadata.

    ``records`` has one metadata record per job. All jobs are extracted before
    anything is described, since the catalog carries dates over all of them.
    """
    unknown = [j for j in jobs if j != "bundle" and j not in _EXTRACT]
    if unknown:
        raise ValueError(f"unknown jobs: {', '.join(unknown)}")
    for job in jobs:
        if job != "bundle":
            for_job(records, job)  # stops on a job without a record
    inputs = Inputs.of(resources, window)
    if "bundle" in jobs:
        entries = bundle.transaction_entries(
            reduce(lambda a, b: a.unionByName(b), inputs.all())
        )
        write_entries(entries, f"{output}/{FOLDERS['bundle']}")
    extractions = [extract(j, inputs, reference_year) for j in jobs if j != "bundle"]
    if not extractions:
        return
    per_job = reduce(
        lambda a, b: a.unionByName(b),
        [e.stats.withColumn("job", F.lit(e.job)) for e in extractions],
    )
    described = stage(with_statistics(records, per_job, run, mode), "records")
    for e in extractions:
        folder = f"{output}/{FOLDERS[e.job]}"
        record = described.where(F.col("job") == e.job)
        write_table(e.rows, f"{folder}/data", fmt, single_file)
        systems = None
        if mode.lower() != "excel":
            systems = e.systems.withColumn("job", F.lit(e.job)).join(
                record.select("job", "dataset_uri"), "job"
            ).select("dataset_uri", "system")
        graphs = {
            "Catalog": record_triples.catalog_triples(record),
            "Dataset": record_triples.dataset_triples(record, systems),
            "Distribution": record_triples.distribution_triples(record),
            "CSVW": schema_graph(e, record),
        }
        for name, graph in graphs.items():
            write_ntriples(graph, f"{folder}/rdf/{name}")


def run_metadata(records: DataFrame, output: str, run: str) -> None:
    """Write the four graphs of each record without any resources.

    Statistics are the configured ones; the schema graph describes the record's own data
    dictionary and value sets. Stops if a required dictionary cell is blank.
    """
    none = {"record_count": "long", "unique_patients": "long", "min_age": "int", "max_age": "int"}
    dates = {"start_date": "string", "end_date": "string"}
    nulls = [F.lit(None).cast(t).alias(c) for c, t in (none | dates).items()]
    described = stage(
        with_statistics(records, records.select("job", *nulls), run, "excel"), "records"
    )
    places = described.select(
        "job", F.col("csvw_uri").alias("subject"), F.col("distribution_uri").alias("parent")
    )
    graphs = {
        "Catalog": record_triples.catalog_triples(described),
        "Dataset": record_triples.dataset_triples(described, None),
        "Distribution": record_triples.distribution_triples(described),
        "CSVW": dictionary_graph(
            dictionaries.dictionary_from_records(records).join(places, "job"),
            dictionaries.value_sets_from_records(records),
        ),
    }
    for name, graph in graphs.items():
        write_ntriples(graph, f"{output}/{name}")


def dictionary_graph(dictionary: DataFrame, value_sets: DataFrame) -> DataFrame:
    """Schema, facets and value sets of dictionary rows with ``subject`` and ``parent``.

    Blank required cells stop the job, with the first ten messages.
    """
    clean = dictionaries.clean_dictionary(dictionary, "subject", "parent")
    wrong = clean.where(F.col("error").isNotNull()).select("Variable", "error").limit(10).collect()
    if wrong:
        raise ValueError("; ".join(f"{r['Variable']}: {r['error']}" for r in wrong))
    placed = clean.drop("error").na.fill("", subset=list(schemas.DICTIONARY_COLUMNS))
    return triples.as_graph(
        schema_triples.dictionary_triples(placed),
        schema_triples.facet_triples(placed),
        schema_triples.value_set_triples(dictionaries.clean_value_sets(value_sets)),
    )


def run_dictionary(
    dictionary: DataFrame, value_sets: DataFrame, output: str, subject: str, parent: str = ""
) -> None:
    """Describe a data dictionary without any resources: schema, facets, value sets."""
    placed = dictionary.withColumn("subject", F.lit(subject)).withColumn("parent", F.lit(parent))
    ordered = value_sets if "row_idx" in value_sets.columns else value_sets.withColumn("row_idx", F.lit(0))
    write_ntriples(dictionary_graph(placed, ordered), output)
