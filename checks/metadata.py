"""Queries and oracles: metadata records from documents, workbooks and forms."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks import fixtures as fx
from checks import sql
from clinflat.namespaces import SKOS
from clinflat.operators import authority, stats
from clinflat.operators import dictionary as dic
from clinflat.schemas import DICTIONARY_COLUMNS
from clinflat.sources import metadata as md

JOBS = ("survey", "observation")


def documents(spark, d):
    """One metadata document per supplier, with two jobs each."""
    k = F.col("s_suppkey")
    name = F.col("s_name")

    def text(prefix: str):
        return F.concat(F.lit(prefix), k)

    def some(n: int, value):
        return F.when(k % n != 0, value)

    def contact(prefix: str):
        return F.struct(
            some(3, text(f"http://page/{prefix}/")).alias("page"),
            F.when(k % 3 == 0, F.concat(F.lit(f"{prefix} desk"), k, F.lit("@x.org"))).alias("email"),
        )

    def period(start: str, end: str):
        return F.struct(F.lit(start).alias("start"), F.lit(end).alias("end"))

    def publisher():
        return some(
            5,
            F.struct(
                name.alias("name"), F.lit("http://type/a b").alias("type"),
                contact("pub").alias("contactPoint"), F.lit("no warranty").alias("note"),
                (k % 2 == 0).alias("trusted"),
            ),
        )

    def creator():
        return some(4, F.struct(F.concat(F.lit("by "), name).alias("name"),
                                F.lit("c@x.org").alias("email")))

    catalog = F.struct(
        (k % 4 == 0).alias("existing"),
        F.when(k % 8 == 0, F.concat(F.lit(" http://catalog/"), k, F.lit(" "))).alias("uri"),
        F.concat(F.lit("Catalog "), name).alias("title"),
        F.lit("All \"of\" it").alias("description"),
        F.lit("http://law/ 1").alias("applicableLegislation"),
        creator().alias("creator"),
        F.array(F.lit("http://geo/a"), text("http://geo/")).alias("geographicalCoverage"),
        period("2010-01-01", "2026").alias("temporalCoverage"),
        F.lit("http://licence").alias("licence"),
        F.lit("http://home").alias("homepage"),
        F.array(F.lit("http://lang/ENG")).alias("language"),
        publisher().alias("publisher"),
        F.when(k % 2 == 0, F.lit("2026-01-01")).otherwise(F.lit("soon")).alias("releaseDate"),
        some(3, F.lit("read only")).alias("rights"),
    )

    def distribution(job: str):
        return F.struct(
            F.concat(F.lit(job + " "), name).alias("title"),
            text(f"http://data/{job} ").alias("accessURL"),
            F.lit("http://format/CSV").alias("format"),
            (k * 100).cast("int").alias("byteSize"),
            some(4, F.struct(F.lit("http://md5").alias("algorithm"),
                             F.concat(F.lit("ab:c"), k).alias("value"))).alias("checksum"),
            F.lit("http://media").alias("mediaType"),
            F.lit("2025-01-0x").alias("releaseDate"),
            some(3, F.lit("as is")).alias("rights"),
            F.lit(12.5).alias("spatialResolution"),
            F.when(k % 2 == 0, F.lit("P1Y")).otherwise(F.lit("1Y")).alias("temporalResolution"),
        )

    def dataset(job: str):
        return F.struct(
            F.concat(F.lit(job + " of "), name).alias("title"),
            F.concat(F.lit("http://id/ "), k, F.lit(f" /{job}")).alias("identifier"),
            F.lit("1.0").alias("version"),
            contact("ds").alias("contactPoint"),
            F.struct(F.lit("HDAB").alias("name"), contact("hdab").alias("contactPoint")).alias("hdab"),
            publisher().alias("publisher"),
            creator().alias("creator"),
            F.array(F.lit("health"), name).alias("keyword"),
            F.lit("http://cat/REG_A_B").alias("healthCategory"),
            F.array(F.struct(F.lit("http://s").alias("scheme"), text("n").alias("notation"),
                             F.lit("label").alias("label"))).alias("codeValues"),
            F.array(F.lit("urn:configured"), text("urn:own ")).alias("codingSystems"),
            (k * 10).cast("int").alias("numRecords"),
            some(2, F.lit(7)).alias("numUniqueIndividual"),
            F.lit(18).alias("minAge"),
            some(2, F.lit(80)).alias("maxAge"),
            period("2020-01-01", "2030-01-01").alias("retentionPeriod"),
            period("2011-01-01", "2012-01-01").alias("temporalCoverage"),
            F.array(text("id-")).alias("otherIdentifier"),
            F.array(F.struct(name.alias("name"), F.lit("sponsor").alias("role"))).alias(
                "qualifiedAttribution"
            ),
            some(2, distribution("sample")).alias("sample"),
            F.lit("research").alias("purpose"),
        )

    jobs = F.create_map(
        *[x for j in JOBS for x in (
            F.lit(j), F.struct(dataset(j).alias("dataset"), distribution(j).alias("distribution"))
        )]
    )
    body = F.to_json(F.struct(catalog.alias("catalog"), jobs.alias("jobs")))
    return fx.table(spark, d, "supplier").select(k, body.alias("value"))


def records(spark, d):
    return md.parse_documents(documents(spark, d), "value", "s_suppkey")


def metadata_jobs(spark, d):
    return records(spark, d).select(
        "s_suppkey", "job",
        F.col("catalog.title").alias("catalog_title"),
        F.col("catalog.existing").alias("existing"),
        F.col("catalog.publisher.contactPoint.page").alias("page"),
        F.element_at("catalog.geographicalCoverage", -1).alias("area"),
        F.col("dataset.title").alias("title"),
        F.col("dataset.numRecords").alias("records"),
        F.col("dataset.codeValues")[0]["notation"].alias("notation"),
        F.col("distribution.checksum.value").alias("checksum"),
        F.col("distribution.spatialResolution").alias("resolution"),
    )


# --- workbooks ------------------------------------------------------------------------

# Value of a cell, as SQL that reads the same in Spark and DuckDB.
_CELL = """CASE
  WHEN (sheet = 'Catalog' AND row_idx IN (1, 21)) OR (sheet LIKE 'Dataset%' AND row_idx = 19)
    THEN CASE k % 4 WHEN 0 THEN 'true' WHEN 1 THEN ' false ' WHEN 2 THEN '' ELSE 'maybe' END
  WHEN sheet LIKE 'Dataset%' AND row_idx IN (45, 48, 49, 50)
    THEN CASE WHEN k % 3 = 0 THEN 'unknown' ELSE CAST(k AS VARCHAR(20)) || '.7' END
  WHEN (sheet LIKE 'D%' AND row_idx = 59) OR (sheet LIKE 'Distribution%' AND row_idx = 15) THEN '0.5'
  WHEN sheet LIKE 'Distribution%' AND row_idx = 5 THEN '1000'
  WHEN (row_idx + k) % 4 = 3 THEN ' '
  ELSE ' ' || sheet || ':' || CAST(row_idx AS VARCHAR(20)) || ', ,' || CAST(k AS VARCHAR(20)) || ' '
END"""
# Which sheets a workbook has.
_PRESENT = {
    "Catalog": "k % 13 <> 12",
    "Dataset": "k % 10 <> 7",
    "Dataset-SURVEY": "k % 3 = 0",
    "Distribution": "TRUE",
    "Distribution-OBSERVATION": "k % 4 = 1",
    "Value Sets-SURVEY": "k % 2 = 0",
}


def cells(spark, d):
    """Cells of a workbook per supplier: values in column 6, captions in column 5."""
    sheets = F.array(
        *[F.when(F.expr(cond), F.lit(name)) for name, cond in _PRESENT.items()]
    )
    books = fx.table(spark, d, "supplier").select(F.col("s_suppkey").alias("k"))
    rows = books.select("k", F.explode(sheets).alias("sheet")).where(F.col("sheet").isNotNull())
    placed = rows.select(
        "k", "sheet", F.explode(F.sequence(F.lit(0), F.lit(65))).alias("row_idx")
    ).select("k", "sheet", "row_idx", F.explode(F.array(F.lit(5), F.lit(6))).alias("col_idx"))
    value = F.when(F.col("col_idx") == 6, F.expr(_CELL)).otherwise(F.lit("caption"))
    return placed.select(
        F.concat(F.lit("w"), "k").alias("workbook"), "sheet", "row_idx", "col_idx",
        value.alias("value"),
    )


def _jobs(spark, d):
    names = F.array(*[F.lit(j) for j in (*JOBS, "")])
    return fx.table(spark, d, "supplier").select(
        F.concat(F.lit("w"), "s_suppkey").alias("workbook"), F.explode(names).alias("job")
    )


def sheet_fallback(spark, d):
    return md.resolve_sheets(cells(spark, d), _jobs(spark, d))


def _job_cells(spark, d):
    source = cells(spark, d)
    return md.job_cells(source, md.resolve_sheets(source, _jobs(spark, d)))


def metadata_sheet_pivot(spark, d):
    return md.sheet_fields(_job_cells(spark, d), md.DATASET_SHEET, md.DATASET_ROWS)


def metadata_violations(spark, d):
    return md.metadata_violations(_job_cells(spark, d))


def workbook_records(spark, d):
    return md.workbook_records(_job_cells(spark, d)).select(
        "workbook", "job",
        F.col("catalog.existing").alias("existing"),
        F.col("catalog.title").alias("catalog_title"),
        F.concat_ws("|", "catalog.geographicalCoverage").alias("areas"),
        F.col("dataset.title").alias("title"),
        F.concat_ws("|", "dataset.keyword").alias("keywords"),
        F.concat_ws("|", "dataset.personalData").alias("personal"),
        F.col("dataset.numRecords").alias("records"),
        F.size("dataset.codeValues").alias("codes"),
        F.col("distribution.byteSize").alias("bytes"),
        F.col("distribution.spatialResolution").alias("resolution"),
    )


# --- forms ----------------------------------------------------------------------------


def form_records(spark, d):
    k = F.col("c_custkey")
    body = F.concat(
        F.lit("title=Set+"), k, F.lit("&keyword=a%2C+"), "c_mktsegment",
        F.lit("&catalogTitle=Cat&existingCatalog="), F.when(k % 2 == 0, F.lit("on")).otherwise(F.lit("")),
        F.lit("&contactPage=http%3A%2F%2Fp%2F"), k,
        F.when(k % 3 == 0, F.lit("&datasetQualityAnnotation=checked")).otherwise(F.lit("")),
        F.when(k % 5 == 0, F.lit("&sampleAccessUrl=http://s&sampleTitle=S")).otherwise(F.lit("")),
        F.lit("&distributionFormat=csv&publisherName="), F.when(k % 7 == 0, F.lit("+")).otherwise(F.lit("P")),
    )
    forms = fx.table(spark, d, "customer").select(k.alias("form_id"), body.alias("body"))
    return md.form_records(forms).select(
        "form_id", "error",
        F.col("catalog.existing").alias("existing"),
        F.col("dataset.title").alias("title"),
        F.concat_ws("|", "dataset.keyword").alias("keywords"),
        F.col("dataset.contactPoint.page").alias("page"),
        F.col("dataset.sample.title").alias("sample"),
        F.col("dataset.publisher.name").alias("publisher"),
        F.col("distribution.format").alias("format"),
    )


# --- authority lists and statistics ---------------------------------------------------


def authority_triples(spark, d):
    """Nations as concepts in a scheme per region, with labels in two languages."""
    uri = F.concat(F.lit("http://authority/nation/"), "n_nationkey")
    scheme = F.concat(F.lit("http://authority/region/"), "n_regionkey")

    def row(term: str, o, lang):
        return F.struct(
            F.lit(SKOS + term).alias("p"), o.alias("o"), F.lit(lang).cast("string").alias("lang")
        )

    rows = F.array(
        row("inScheme", scheme, None),
        row("prefLabel", F.col("n_name"), "en"),
        row("prefLabel", F.lower("n_name"), "de"),
        row("prefLabel", F.col("n_name"), "en"),
    )
    nations = fx.table(spark, d, "nation")
    return nations.select(uri.alias("s"), F.explode(rows).alias("t")).select("s", "t.*")


def authority_labels(spark, d):
    return authority.authority_labels(authority_triples(spark, d))


def stats_merge(spark, d):
    """Statistics of one job per supplier, merged."""
    return stats.merge_stats(_line_stats(spark, d))


def _line_stats(spark, d):
    """Numbers that look like job statistics, from the order lines of each supplier."""
    day = F.date_format("l_shipdate", "yyyy-MM-dd")
    lines = fx.table(spark, d, "lineitem")
    return lines.groupBy(F.col("l_suppkey").alias("s_suppkey")).agg(
        F.count(F.lit(1)).alias("record_count"),
        F.max(F.col("l_linenumber")).cast("bigint").alias("unique_patients"),
        (F.min("l_orderkey") % 40).cast("int").alias("min_age"),
        (F.max("l_orderkey") % 90).cast("int").alias("max_age"),
        F.min(day).alias("start_date"),
        F.max(day).alias("end_date"),
    )


def _override(spark, d, mode):
    source = records(spark, d).where(F.col("job") == "survey")
    ds = F.col("dataset")
    configured = source.select(
        "s_suppkey",
        ds["numRecords"].cast("bigint").alias("cfg_record_count"),
        ds["numUniqueIndividual"].cast("bigint").alias("cfg_unique_patients"),
        ds["minAge"].alias("cfg_min_age"),
        ds["maxAge"].alias("cfg_max_age"),
        ds["temporalCoverage"]["start"].alias("cfg_start_date"),
        ds["temporalCoverage"]["end"].alias("cfg_end_date"),
    )
    computed = _line_stats(spark, d).where(F.col("s_suppkey") % 5 != 1)
    return stats.override_stats(configured, computed, "s_suppkey", mode).withColumn("mode", F.lit(mode))


def stats_override(spark, d):
    return _override(spark, d, "json").unionByName(_override(spark, d, "excel"))


def _grid(spark, d, base: str, rows: int, columns: int):
    """Job cells of a sheet of every supplier's workbook, still without values."""
    return (
        fx.table(spark, d, "supplier")
        .select("s_suppkey", "s_name", F.explode(F.sequence(F.lit(0), F.lit(rows - 1))).alias("r"))
        .select("*", F.explode(F.sequence(F.lit(0), F.lit(columns - 1))).alias("c"))
        .withColumns({"base": F.lit(base), "workbook": F.concat(F.lit("w"), "s_suppkey")})
    )


def _placed(grid, value):
    return grid.select(
        "workbook", F.lit("survey").alias("job"), "base", F.col("r").alias("row_idx"),
        F.col("c").alias("col_idx"), F.expr(value).alias("value"),
    )


# One text for both sides: functions that Spark and DuckDB share.
_FIELD = """CASE WHEN r = 0 THEN 'header'
  WHEN c = 0 THEN CASE WHEN (s_suppkey + r) % 5 = 4 THEN ' ' ELSE concat(' v', r, ' ') END
  WHEN c = 1 THEN CASE WHEN (s_suppkey + r) % 7 = 3 THEN '' ELSE concat('Name ', r, ' of ', s_name) END
  WHEN c = 3 THEN 'string'
  WHEN (s_suppkey + c) % 3 = 0 THEN NULL ELSE concat('c', c, ' r', r, ' ') END"""
_CODE = """CASE WHEN c = 0 THEN CASE WHEN r = 6 THEN '' ELSE concat('v', r % 3) END
  WHEN c = 1 THEN concat(' ', r % 2) ELSE concat('d', r, ' of ', s_name) END"""


def dictionary_from_cells(spark, d):
    source = _placed(_grid(spark, d, "Data Dictionary", 7, 20), _FIELD)
    return dic.clean_dictionary(dic.dictionary_from_cells(source), "workbook", "job")


def value_sets_from_cells(spark, d):
    source = _placed(_grid(spark, d, "Value Sets", 9, 3), _CODE)
    return dic.clean_value_sets(dic.value_sets_from_cells(source), "workbook", "job")


def _described(spark, d):
    """Records whose documents carry a dictionary of two fields and a value set."""
    k = F.col("s_suppkey")
    field = lambda n: F.struct(
        F.concat(F.lit(f"v{n}"), k).alias("name"),
        F.when(k % 4 != n, F.concat(F.lit(f"Title {n} of "), "s_name")).alias("title"),
        F.lit("integer").alias("datatype"), F.lit(" kg ").alias("unit"),
        k.cast("string").alias("maxValue"),
    )
    codes = F.create_map(F.lit("1"), F.lit("One"), F.lit(" 2"), F.concat(F.lit("Two "), "s_name"))
    job = F.struct(
        F.array(field(1), field(2)).alias("dataDictionary"),
        F.create_map(F.concat(F.lit("v1"), k), codes).alias("dataDictionaryValueSets"),
    )
    body = F.to_json(F.struct(F.create_map(F.lit("survey"), job).alias("jobs")))
    documents_ = fx.table(spark, d, "supplier").select(k, body.alias("value"))
    return md.parse_documents(documents_, "value", "s_suppkey")


def dictionary_from_json(spark, d):
    rows = dic.dictionary_from_records(_described(spark, d), "s_suppkey")
    return dic.clean_dictionary(rows, "s_suppkey", "job")


def value_sets_from_json(spark, d):
    rows = dic.value_sets_from_records(_described(spark, d), "s_suppkey")
    return dic.clean_value_sets(rows, "s_suppkey", "job")


QUERIES = {
    "dictionary_from_cells": dictionary_from_cells,
    "value_sets_from_cells": value_sets_from_cells,
    "dictionary_from_json": dictionary_from_json,
    "value_sets_from_json": value_sets_from_json,
    "metadata_jobs": metadata_jobs,
    "sheet_fallback": sheet_fallback,
    "metadata_sheet_pivot": metadata_sheet_pivot,
    "metadata_violations": metadata_violations,
    "workbook_records": workbook_records,
    "form_records": form_records,
    "authority_labels": authority_labels,
    "stats_merge": stats_merge,
    "stats_override": stats_override,
}

_BOOKS = f"""books AS (SELECT s_suppkey AS k, 'w' || s_suppkey AS workbook FROM supplier),
sheets AS ({' UNION ALL '.join(f"SELECT k, workbook, '{n}' AS sheet FROM books WHERE {c}" for n, c in _PRESENT.items())}),
wanted AS (SELECT k, workbook, job, base,
    CASE WHEN base <> 'Catalog' AND job <> '' THEN base || '-' || upper(job) END AS own
  FROM books, (SELECT unnest(['survey', 'observation', '']) AS job),
       (SELECT unnest(['Catalog', 'Dataset', 'Distribution', 'Data Dictionary', 'Value Sets']) AS base)),
resolved AS (SELECT w.*, coalesce(o.sheet, b.sheet) AS sheet FROM wanted w
  LEFT JOIN sheets o ON o.workbook = w.workbook AND o.sheet = w.own
  LEFT JOIN sheets b ON b.workbook = w.workbook AND b.sheet = w.base)"""


def _pivoted(base: str, rows: dict[int, str]) -> str:
    blank = "nullif(trim(v, ' '), '')"
    fields = ", ".join(f"max({blank}) FILTER (row_idx = {i}) AS {n}" for i, n in rows.items())
    return (
        f"SELECT workbook, job, {fields} FROM (SELECT *, {_CELL} AS v FROM "
        f"(SELECT * FROM resolved WHERE base = '{base}' AND sheet IS NOT NULL), "
        f"(SELECT unnest(range(0, 66))::INT AS row_idx)) GROUP BY workbook, job"
    )


_SHEETS = (
    _BOOKS,
    f"cat AS ({_pivoted('Catalog', md.CATALOG_ROWS)})",
    f"dset AS ({_pivoted('Dataset', md.DATASET_ROWS)})",
    f"dist AS ({_pivoted('Distribution', md.DISTRIBUTION_ROWS)})",
)


def _flag_error(column: str, raw: str, field: str) -> str:
    return f"CASE WHEN {column} NOT IN ('true', 'false') THEN 'Incorrect value for boolean: ' || {raw} || ' ({field})' END"


_NAME_MISSING = (
    "Publisher.name should be provided if any other publisher fields are given! If you "
    "don''t want to provide a publisher, leave all related fields empty."
)
_PUB_GONE = "publisherPage IS NULL AND publisherEmail IS NULL"

_LINES = """lines AS (
  SELECT l_suppkey AS s_suppkey, count(*) AS record_count,
         max(l_linenumber)::BIGINT AS unique_patients, (min(l_orderkey) % 40)::INT AS min_age,
         (max(l_orderkey) % 90)::INT AS max_age,
         min(strftime(l_shipdate, '%Y-%m-%d')) AS start_date,
         max(strftime(l_shipdate, '%Y-%m-%d')) AS end_date
  FROM lineitem GROUP BY l_suppkey)"""

_CONFIGURED = {
    "record_count": "s_suppkey * 10",
    "unique_patients": "CASE WHEN s_suppkey % 2 <> 0 THEN 7 ELSE 0 END",
    "min_age": "18",
    "max_age": "CASE WHEN s_suppkey % 2 <> 0 THEN 80 ELSE 0 END",
}
_NUM_TYPE = {"record_count": "BIGINT", "unique_patients": "BIGINT", "min_age": "INT", "max_age": "INT"}


def _final(computed: bool) -> str:
    def number(n: str) -> str:
        pick = f"CASE WHEN l.{n} > 0 THEN l.{n} ELSE {_CONFIGURED[n]} END" if computed else _CONFIGURED[n]
        return f"({pick})::{_NUM_TYPE[n]} AS {n}"

    dates = (
        "coalesce(l.start_date, '2011-01-01') AS start_date, coalesce(l.end_date, '2012-01-01') AS end_date"
        if computed
        else "'2011-01-01' AS start_date, '2012-01-01' AS end_date"
    )
    return f"{', '.join(number(n) for n in _CONFIGURED)}, {dates}"


def _override_sql(mode: str) -> str:
    return (
        f"SELECT s_suppkey, {_final(mode != 'excel')}, '{mode}' AS mode FROM supplier "
        "LEFT JOIN (SELECT * FROM lines WHERE s_suppkey % 5 <> 1) l USING (s_suppkey)"
    )


_GRID = """grid AS (SELECT s_suppkey, s_name, r, c
  FROM supplier, range(9) a(r), range(20) b(c))"""
_CELLS_DICT = ", ".join(
    f"nullif({sql.trim(f'max(CASE WHEN c = {i} THEN v END)')}, '') AS " + '"' + name + '"'
    for i, name in enumerate(DICTIONARY_COLUMNS)
)
_JSON_CELLS = {
    "Variable": "'v' || n || s_suppkey",
    "Name": "CASE WHEN s_suppkey % 4 <> n THEN 'Title ' || n || ' of ' || s_name END",
    "Datatype": "'integer'", "Unit": "'kg'", "Max Value": "s_suppkey::VARCHAR",
}
_JSON_DICT = ", ".join(
    f"{_JSON_CELLS.get(name, 'NULL::VARCHAR')} AS " + '"' + name + '"' for name in DICTIONARY_COLUMNS
)
_BLANK = """CASE WHEN "Name" IS NULL THEN 'The ''Name'' field cannot be empty.' END AS error"""

ORACLES = {
    "dictionary_from_cells": sql.with_(_GRID)
    + f"""SELECT *, {_BLANK} FROM (
          SELECT 'w' || s_suppkey AS workbook, 'survey' AS job, {_CELLS_DICT}
          FROM (SELECT *, {_FIELD} AS v FROM grid WHERE r BETWEEN 1 AND 6) GROUP BY s_suppkey, r)
        WHERE "Variable" IS NOT NULL""",
    "value_sets_from_cells": sql.with_(_GRID)
    + f"""SELECT 'w' || s_suppkey AS workbook, 'survey' AS job, "Variable", "Code",
            arg_max("Display", r) AS "Display" FROM (
          SELECT s_suppkey, r, {sql.trim("max(CASE WHEN c = 0 THEN v END)")} AS "Variable",
            {sql.trim("max(CASE WHEN c = 1 THEN v END)")} AS "Code",
            {sql.trim("max(CASE WHEN c = 2 THEN v END)")} AS "Display"
          FROM (SELECT *, {_CODE} AS v FROM grid WHERE r > 0 AND c < 3) GROUP BY s_suppkey, r)
        WHERE "Variable" <> '' GROUP BY ALL""",
    "dictionary_from_json": f"""SELECT *, {_BLANK} FROM (
        SELECT s_suppkey, 'survey' AS job, {_JSON_DICT} FROM supplier, range(1, 3) a(n))""",
    "value_sets_from_json": """SELECT s_suppkey, 'survey' AS job, 'v1' || s_suppkey AS "Variable",
        n::VARCHAR AS "Code", CASE WHEN n = 1 THEN 'One' ELSE 'Two ' || s_name END AS "Display"
        FROM supplier, range(1, 3) a(n)""",
    "metadata_jobs": """SELECT s_suppkey, job, 'Catalog ' || s_name AS catalog_title,
          s_suppkey % 4 = 0 AS existing,
          CASE WHEN s_suppkey % 5 <> 0 AND s_suppkey % 3 <> 0 THEN 'http://page/pub/' || s_suppkey END AS page,
          'http://geo/' || s_suppkey AS area, job || ' of ' || s_name AS title,
          (s_suppkey * 10)::INT AS records, 'n' || s_suppkey AS notation,
          CASE WHEN s_suppkey % 4 <> 0 THEN 'ab:c' || s_suppkey END AS checksum, 12.5::DOUBLE AS resolution
        FROM supplier, (SELECT unnest(['survey', 'observation']) AS job)""",
    "sheet_fallback": sql.with_(_BOOKS)
    + """SELECT workbook, job, base, sheet, CASE WHEN sheet IS NULL THEN
          'Required sheet ''' || coalesce(own || ' or ', '') || base || ''' not found in Excel workbook.'
          END AS error FROM resolved
        WHERE sheet IS NOT NULL OR base IN ('Catalog', 'Dataset', 'Distribution')""",
    "metadata_sheet_pivot": sql.with_(*_SHEETS) + "SELECT * FROM dset",
    "metadata_violations": sql.with_(
        *_SHEETS,
        f"""found AS (
  SELECT workbook, job, unnest([
    {_flag_error('existing', 'existing', 'Catalog.existing')},
    CASE WHEN existing = 'true' AND uri IS NULL THEN 'Catalog.uri is REQUIRED when existing is true.' END,
    CASE WHEN publisherName IS NOT NULL AND {_PUB_GONE}
      THEN 'At least one of the Publisher.email or Publisher.page fields are required!' END,
    CASE WHEN publisherName IS NULL AND NOT ({_PUB_GONE}) THEN '{_NAME_MISSING}' END,
    {_flag_error('publisherTrusted', 'publisherTrusted', 'Catalog.publisher.trusted')}]) AS message FROM cat
  UNION ALL SELECT workbook, job, unnest([
    CASE WHEN contactPage IS NULL AND contactEmail IS NULL
      THEN 'Dataset Contact Point requires at least one of page or email.' END,
    CASE WHEN hdabPage IS NULL AND hdabEmail IS NULL
      THEN 'Dataset HDAB requires at least one of contact point page or email.' END,
    CASE WHEN {_PUB_GONE} THEN 'Dataset Publisher requires at least one of contact page or email.' END,
    CASE WHEN publisherName IS NULL AND NOT ({_PUB_GONE}) THEN '(Dataset) {_NAME_MISSING}' END,
    {_flag_error('publisherTrusted', 'publisherTrusted', 'Dataset.Publisher.trusted')}]) FROM dset)""",
    )
    + "SELECT * FROM found WHERE message IS NOT NULL",
    "workbook_records": sql.with_(*_SHEETS)
    + """SELECT workbook, job,
          CASE cat.existing WHEN 'true' THEN true WHEN 'false' THEN false END AS existing,
          cat.title AS catalog_title,
          coalesce(array_to_string(string_split(cat.geographicalCoverage, ','), '|'), '') AS areas,
          dset.title AS title, coalesce(replace(dset.keyword, ', ,', '|'), '') AS keywords,
          coalesce('https://w3c.github.io/dpv/2.0/pd#' || replace(dset.personalData, ', ,',
            '|https://w3c.github.io/dpv/2.0/pd#'), '') AS personal,
          trunc(try_cast(dset.numRecords AS DOUBLE))::INT AS records,
          CASE WHEN codeSchemes IS NOT NULL AND codeNotations IS NOT NULL AND codeLabels IS NOT NULL
            THEN 3 END AS codes,
          trunc(byteSize::DOUBLE)::INT AS bytes, dist.spatialResolution::DOUBLE AS resolution
        FROM cat JOIN dset USING (workbook, job) JOIN dist USING (workbook, job)""",
    "form_records": """SELECT c_custkey AS form_id,
          CASE WHEN c_custkey % 3 <> 0 THEN 'Quality Annotation is required' END AS error,
          c_custkey % 2 = 0 AS existing, 'Set ' || c_custkey AS title,
          'a|' || c_mktsegment AS keywords, 'http://p/' || c_custkey AS page,
          CASE WHEN c_custkey % 5 = 0 THEN 'S' END AS sample,
          CASE WHEN c_custkey % 7 <> 0 THEN 'P' END AS publisher, 'csv' AS format FROM customer""",
    "authority_labels": """SELECT 'http://authority/region/' || n_regionkey AS scheme,
          'http://authority/nation/' || n_nationkey AS uri, n_name AS label FROM nation""",
    "stats_merge": sql.with_(_LINES)
    + """SELECT sum(record_count)::BIGINT AS record_count, max(unique_patients) AS unique_patients,
          coalesce(min(min_age) FILTER (min_age > 0), 0)::INT AS min_age, max(max_age) AS max_age,
          min(start_date) AS start_date, max(end_date) AS end_date FROM lines""",
    "stats_override": sql.with_(_LINES) + _override_sql("json") + " UNION ALL " + _override_sql("excel"),
}
