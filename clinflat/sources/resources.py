"""Resource scans and the date window."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from clinflat import schemas
from clinflat.functions.fhirpath import numbers_kept, parse_once, questionnaire_key, unnest
from clinflat.functions.iso import period_end, period_start
from clinflat.operators.window import Window

# Fixed value: how a coding system appears in the text of a resource.
SYSTEM_PATTERN = r'"system"\s*:\s*"((?:[^"\\]++|\\.)+)"'


def from_json_lines(lines: DataFrame, column: str = "value") -> DataFrame:
    """``resource_type, id, json`` of every line that is a resource.

    Text that is not JSON, or JSON without a resource type, is left out.
    """
    head = "struct<resourceType:string,id:string>"
    return (
        parse_once(lines, head, "h", column, json=column)
        .where(F.col("h.resourceType").isNotNull())
        .select(
            F.col("h.resourceType").alias("resource_type"),
            F.col("h.id").alias("id"),
            F.col(column).alias("json"),
        )
    )


def system_names(json: Column) -> Column:
    """Every system named in the text of a resource, as an array, escapes undone."""
    found = F.regexp_extract_all(json, F.lit(SYSTEM_PATTERN), 1)

    def plain(name: Column) -> Column:
        quoted = F.concat(F.lit('["'), name, F.lit('"]'))
        unescaped = F.get(F.from_json(quoted, "array<string>"), F.lit(0))
        return F.when(F.contains(name, F.lit("\\")), F.coalesce(unescaped, name)).otherwise(name)

    return F.transform(found, plain)


def read_ndjson(spark: SparkSession, path: str) -> DataFrame:
    return from_json_lines(spark.read.text(path))


def of_type(resources: DataFrame, resource_type: str) -> DataFrame:
    return resources.where(F.col("resource_type") == resource_type)


def with_promoted(resources: DataFrame) -> DataFrame:
    """Add the few fields that filters and statistics need beside the JSON.

    ``date`` is the text of the dated field (null for types that are never
    filtered), ``date_lo``/``date_hi`` the half-open period it covers in
    microseconds since 1970 (parquet has no statistics on Spark's default timestamps),
    ``questionnaire_id`` the definition a response with items refers to, and
    ``systems`` every system named in the resource. All come from one parse.
    ``numbers_kept``: values need no care to keep their digits when they are parsed.
    """
    head = (
        "struct<effectiveDateTime:string,authored:string,questionnaire:string,"
        "item:array<struct<linkId:string>>>"
    )
    date = F.lit(None).cast("string")
    for resource_type, field in schemas.DATE_FIELD.items():
        date = F.when(F.col("resource_type") == resource_type, F.col(f"h.{field}")).otherwise(date)
    is_response = F.col("resource_type") == schemas.RESPONSE_TYPE
    columns = ("resource_type", "id", "json")
    dated = parse_once(resources, head, "h", *columns).select(
        *columns,
        F.struct(
            date.alias("date"),
            F.when(is_response & (F.size("h.item") > 0), questionnaire_key(F.col("h.questionnaire")))
            .alias("questionnaire_id"),
        ).alias("f"),
    )
    return unnest(dated, F.array("f"), "f", *columns).select(
        *columns,
        F.col("f.date").alias("date"),
        F.unix_micros(period_start(F.col("f.date"))).alias("date_lo"),
        F.unix_micros(period_end(F.col("f.date"))).alias("date_hi"),
        F.col("f.questionnaire_id").alias("questionnaire_id"),
        F.array_distinct(system_names(F.col("json"))).alias("systems"),
        numbers_kept(F.col("json")).alias("numbers_kept"),
    )


def write_lake(resources: DataFrame, path: str) -> None:
    """Store resources as parquet by type, with the promoted fields as columns.

    Rows are ordered by type and date, undated ones spread by a hash, so that each file
    covers a short time. Scans then read one type only, files and row groups outside the
    date window are skipped without opening the JSON, and dates, systems and references
    are read as plain columns instead of from the JSON again.
    """
    order = ("resource_type", "date_lo", F.xxhash64("id"))
    # several ranges for each task of a shuffle, so that rare types are spread as well
    parts = 8 * int(resources.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = with_promoted(resources).repartitionByRange(parts, *order)
    placed = ranged.sortWithinPartitions(*order)
    writer = placed.write.mode("overwrite").option("compression", "zstd")
    writer.partitionBy("resource_type").parquet(path)


def read_lake(spark: SparkSession, path: str) -> DataFrame:
    schema = (
        "id string, json string, date string, date_lo long, date_hi long, "
        "questionnaire_id string, systems array<string>, numbers_kept boolean, "
        "resource_type string"
    )
    return spark.read.schema(schema).parquet(path)


def scan(resources: DataFrame, resource_type: str, window: Window = Window()) -> DataFrame:
    """Resources of one type whose date overlaps the window.

    A date of any precision is a period; ``from`` needs the period to end after it
    starts, ``to`` needs the period to start before ``to`` ends. Resources without
    a date fall out as soon as a bound is set. Patients and definitions carry no
    such date and are never filtered.
    """
    rows = of_type(resources, resource_type)
    unbounded = window.date_from is None and window.date_to is None
    if unbounded or resource_type not in schemas.DATE_FIELD:
        return rows
    if "date_lo" not in rows.columns:
        # a filter below the parsing of dates would repeat it for each condition
        period = F.array(F.struct("date_lo", "date_hi"))
        rows = unnest(with_promoted(rows), period, "period", *resources.columns)
        rows = rows.select(*resources.columns, "period.*")
    if window.date_from is not None:
        rows = rows.where(F.col("date_hi") > F.unix_micros(period_start(F.lit(window.date_from))))
    if window.date_to is not None:
        rows = rows.where(F.col("date_lo") < F.unix_micros(period_end(F.lit(window.date_to))))
    return rows.select(*resources.columns)
