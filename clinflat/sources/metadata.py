"""Metadata records from JSON documents, workbook cells and form submissions.

All three give the same nested columns ``catalog, dataset, distribution``.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from clinflat.functions import text as tx
from clinflat.functions.fhirpath import parse_once, unnest

CONTACT = "struct<name:string,page:string,email:string>"
AGENT = "struct<name:string,email:string,type:string>"
PERIOD = "struct<start:string,end:string>"
PUBLISHER = (
    f"struct<name:string,type:string,contactPoint:{CONTACT},note:string,trusted:boolean,url:string>"
)
HDAB = f"struct<name:string,type:string,contactPoint:{CONTACT},note:string,trusted:boolean>"
CATALOG = (
    "struct<existing:boolean,uri:string,title:string,description:string,"
    f"applicableLegislation:string,creator:{AGENT},geographicalCoverage:array<string>,"
    f"temporalCoverage:{PERIOD},licence:string,themes:string,homepage:string,"
    f"language:array<string>,modificationDate:string,publisher:{PUBLISHER},"
    "releaseDate:string,rights:string>"
)
DISTRIBUTION = (
    "struct<title:string,applicableLegislation:string,accessURL:string,description:string,"
    "format:string,license:string,availability:string,byteSize:int,"
    "checksum:struct<algorithm:string,value:string>,mediaType:string,packagingFormat:string,"
    "releaseDate:string,rights:string,spatialResolution:double,status:string,"
    "temporalResolution:string,accessService:string>"
)
DATASET = (
    "struct<title:string,description:string,identifier:string,version:string,"
    "populationCoverage:string,theme:string,provenance:string,"
    f"contactPoint:{CONTACT},hdab:{HDAB},publisher:{PUBLISHER},"
    "keyword:array<string>,spatial:array<string>,healthCategory:string,datasetType:string,"
    "applicableLegislation:string,accessRights:string,healthTheme:string,conformsTo:string,"
    f"creator:{AGENT},documentation:string,frequency:string,sample:{DISTRIBUTION},"
    f"analytics:{DISTRIBUTION},alternative:array<string>,"
    "codeValues:array<struct<scheme:string,notation:string,label:string>>,"
    f"codingSystems:array<string>,numRecords:int,retentionPeriod:{PERIOD},maxAge:int,minAge:int,"
    "numUniqueIndividual:int,personalData:array<string>,landingPage:string,language:string,"
    "modificationDate:string,releaseDate:string,otherIdentifier:array<string>,"
    "qualifiedAttribution:array<struct<name:string,role:string>>,spatialResolution:double,"
    f"temporalCoverage:{PERIOD},temporalResolution:string,versionNotes:string,"
    "wasGeneratedBy:array<string>,purpose:string,qualityAnnotation:string>"
)
FIELD = (
    "struct<name:string,title:string,datatype:string,description:string,propertyUrl:string,"
    "unit:string,study:string,group:string,subpopulation:string,sampleSize:string,"
    "dataOwner:string,identifier:string,selection:string,parentGroup:string,"
    "responsible:string,note:string,minValue:string,maxValue:string,required:string,"
    "conditionalOn:string>"
)
DOCUMENT = (
    f"struct<catalog:{CATALOG},jobs:map<string,struct<dataset:{DATASET},"
    f"distribution:{DISTRIBUTION},dataDictionary:array<{FIELD}>,"
    "dataDictionaryValueSets:map<string,map<string,string>>>>>"
)

# The sheets of a workbook and the column that holds their values.
CATALOG_SHEET, DATASET_SHEET, DISTRIBUTION_SHEET = "Catalog", "Dataset", "Distribution"
JOB_SHEETS = (DATASET_SHEET, DISTRIBUTION_SHEET, "Data Dictionary", "Value Sets")
REQUIRED_SHEETS = (CATALOG_SHEET, DATASET_SHEET, DISTRIBUTION_SHEET)
VALUE_COLUMN = 6

# Which row of a sheet holds which field.
CATALOG_ROWS = {
    1: "existing", 2: "uri", 3: "title", 4: "description", 5: "applicableLegislation",
    6: "creatorName", 7: "creatorType", 8: "geographicalCoverage", 9: "temporalStart",
    10: "temporalEnd", 11: "licence", 12: "themes", 13: "homepage", 14: "language",
    15: "modificationDate", 16: "publisherName", 17: "publisherPage", 18: "publisherEmail",
    19: "publisherType", 20: "publisherNote", 21: "publisherTrusted", 22: "releaseDate",
    23: "rights",
}
DATASET_ROWS = {
    1: "title", 2: "description", 3: "identifier", 4: "version", 5: "populationCoverage",
    6: "theme", 7: "provenance", 8: "contactPage", 9: "contactEmail", 10: "hdabName",
    11: "hdabType", 12: "hdabPage", 13: "hdabEmail", 14: "publisherName", 15: "publisherPage",
    16: "publisherEmail", 17: "publisherType", 18: "publisherNote", 19: "publisherTrusted",
    20: "keyword", 21: "spatial", 22: "healthCategory", 23: "datasetType",
    24: "applicableLegislation", 25: "accessRights", 26: "healthTheme", 27: "conformsTo",
    28: "creatorName", 29: "creatorType", 30: "documentation", 31: "frequency",
    40: "alternative", 41: "codeSchemes", 42: "codeNotations", 43: "codeLabels",
    44: "codingSystems", 45: "numRecords", 46: "retentionStart", 47: "retentionEnd",
    48: "maxAge", 49: "minAge", 50: "numUniqueIndividual", 51: "personalData",
    52: "landingPage", 53: "language", 54: "modificationDate", 55: "releaseDate",
    56: "otherIdentifier", 57: "attributionNames", 58: "attributionRoles",
    59: "spatialResolution", 60: "temporalStart", 61: "temporalEnd",
    62: "temporalResolution", 63: "versionNotes", 64: "wasGeneratedBy", 65: "purpose",
}
DISTRIBUTION_ROWS = {
    1: "title", 2: "applicableLegislation", 3: "accessURL", 4: "availability", 5: "byteSize",
    6: "checksumAlgorithm", 7: "checksumValue", 8: "description", 9: "format", 10: "license",
    11: "mediaType", 12: "packagingFormat", 13: "releaseDate", 14: "rights",
    15: "spatialResolution", 16: "status", 17: "temporalResolution", 18: "accessService",
}

# Messages about metadata that breaks a rule.
SHEET_MISSING = ("Required sheet '", "' not found in Excel workbook.")
URI_MISSING = "Catalog.uri is REQUIRED when existing is true."
PUBLISHER_UNREACHABLE = (
    "At least one of the Publisher.email or Publisher.page fields are required!"
)
PUBLISHER_UNNAMED = (
    "Publisher.name should be provided if any other publisher fields are given! If you "
    "don't want to provide a publisher, leave all related fields empty."
)
CONTACT_MISSING = "Dataset Contact Point requires at least one of page or email."
HDAB_MISSING = "Dataset HDAB requires at least one of contact point page or email."
DATASET_PUBLISHER_MISSING = "Dataset Publisher requires at least one of contact page or email."
QUALITY_MISSING = "Quality Annotation is required"


# --- JSON documents -------------------------------------------------------------------


def parse_documents(documents: DataFrame, column: str, *keep: str) -> DataFrame:
    """One row per job of each metadata document, the catalog repeated."""
    parsed = parse_once(documents, DOCUMENT, "d", *keep, json=column)
    jobs = unnest(
        parsed.withColumn("catalog", F.col("d.catalog")), F.map_entries("d.jobs"), "j",
        "catalog", *keep,
    )
    return jobs.select(*keep, F.col("j.key").alias("job"), "catalog", "j.value.*")


def read_documents(spark: SparkSession, path: str) -> DataFrame:
    return parse_documents(spark.read.text(path, wholetext=True), "value")


def for_job(records: DataFrame, job: str) -> DataFrame:
    """The record of one job; an unknown job is an error that lists the known ones."""
    found = records.where(F.col("job") == job)
    if found.isEmpty():
        known = records.select("job").distinct().orderBy("job").collect()
        names = ", ".join(r["job"] for r in known)
        raise ValueError(f"No metadata found for job '{job}'. Available jobs: {names}")
    return found


# --- workbook cells -------------------------------------------------------------------


def _by_key(side: DataFrame) -> DataFrame:
    """The side of a join that tasks hold by key. Cells are often unfolded from few bytes, so
    the planner takes them for small and would send them whole through the driver."""
    return side.hint("shuffle_hash")


def resolve_sheets(cells: DataFrame, jobs: DataFrame) -> DataFrame:
    """Which sheet each job of a workbook uses: ``workbook, job, base, sheet, error``.

    ``<Base>-<JOB>`` if there is one, else ``<Base>``; the catalog is always shared.
    Required sheets that are missing get an error, other missing ones no row.
    """
    present = cells.select("workbook", "sheet").distinct()
    bases = F.array(*[F.lit(b) for b in (CATALOG_SHEET, *JOB_SHEETS)])
    wanted = jobs.select("workbook", "job", F.explode(bases).alias("base")).withColumn(
        "specific",
        F.when(
            (F.col("base") != CATALOG_SHEET) & (F.col("job") != ""),
            F.concat("base", F.lit("-"), F.upper("job")),
        ),
    )
    own = present.select("workbook", F.col("sheet").alias("specific"), F.lit(True).alias("own"))
    base = present.select("workbook", F.col("sheet").alias("base"), F.lit(True).alias("shared"))
    required = F.col("base").isin(*REQUIRED_SHEETS)
    names = F.coalesce(F.concat("specific", F.lit(" or "), "base"), F.col("base"))
    before, after = SHEET_MISSING
    message = F.concat(F.lit(before), names, F.lit(after))
    return (
        wanted.join(_by_key(own), ["workbook", "specific"], "left")
        .join(_by_key(base), ["workbook", "base"], "left")
        .withColumn("sheet", F.when(F.col("own"), F.col("specific")).when(F.col("shared"), F.col("base")))
        .withColumn("error", F.when(required & F.col("sheet").isNull(), message))
        .where(F.col("sheet").isNotNull() | F.col("error").isNotNull())
        .select("workbook", "job", "base", "sheet", "error")
    )


def job_cells(cells: DataFrame, resolved: DataFrame) -> DataFrame:
    """Cells as each job sees them: ``workbook, job, base, row_idx, col_idx, value``."""
    found = resolved.where(F.col("sheet").isNotNull()).drop("error")
    return cells.join(_by_key(found), ["workbook", "sheet"]).select(
        "workbook", "job", "base", "row_idx", "col_idx", "value"
    )


def sheet_fields(cells: DataFrame, base: str, rows: dict[int, str]) -> DataFrame:
    """A one-value-per-row sheet as one row per workbook and job; blank is null.

    A sheet that is there but has no value at all gives a row of nulls.
    """
    values = (
        cells.where(F.col("base") == base)
        .withColumn("row_idx", F.when(F.col("col_idx") == VALUE_COLUMN, F.col("row_idx")))
        .groupBy("workbook", "job")
        .pivot("row_idx", list(rows))
        .agg(F.first("value", ignorenulls=True))
    )
    return values.select(
        "workbook", "job", *[tx.blank_to_null(F.col(str(i))).alias(n) for i, n in rows.items()]
    )


def _filled(schema: str, **fields: Column) -> Column:
    """A struct of the full schema from the given fields, the others null."""
    given = F.struct(*[c.alias(name) for name, c in fields.items()])
    return F.from_json(F.to_json(given), schema)


def _same(*names: str) -> dict[str, Column]:
    return {n: F.col(n) for n in names}


def _period(start: str, end: str) -> Column:
    given = F.col(start).isNotNull() | F.col(end).isNotNull()
    return F.when(given, F.struct(F.col(start).alias("start"), F.col(end).alias("end")))


def _creator() -> Column:
    agent = F.struct(F.col("creatorName").alias("name"), F.col("creatorType").alias("type"))
    return F.when(F.col("creatorName").isNotNull(), agent)


def _contact(page: str, email: str) -> Column:
    return F.struct(F.col(page).alias("page"), F.col(email).alias("email"))


def _publisher() -> Column:
    return F.when(
        F.col("publisherName").isNotNull(),
        F.struct(
            F.col("publisherName").alias("name"),
            F.col("publisherType").alias("type"),
            _contact("publisherPage", "publisherEmail").alias("contactPoint"),
            F.col("publisherNote").alias("note"),
            tx.strict_boolean(F.col("publisherTrusted")).alias("trusted"),
        ),
    )


def catalog_from_fields() -> Column:
    return _filled(
        CATALOG,
        existing=tx.strict_boolean(F.col("existing")),
        creator=_creator(),
        geographicalCoverage=tx.raw_comma_list(F.col("geographicalCoverage")),
        temporalCoverage=_period("temporalStart", "temporalEnd"),
        language=tx.raw_comma_list(F.col("language")),
        publisher=_publisher(),
        **_same(
            "uri", "title", "description", "applicableLegislation", "licence", "themes",
            "homepage", "modificationDate", "releaseDate", "rights",
        ),
    )


def dataset_from_fields() -> Column:
    c = F.col
    lists = {
        n: tx.comma_list(c(n))
        for n in ("keyword", "spatial", "alternative", "codingSystems", "otherIdentifier",
                  "wasGeneratedBy")
    }
    numbers = {
        n: tx.int_from_text(c(n)) for n in ("numRecords", "maxAge", "minAge", "numUniqueIndividual")
    }
    return _filled(
        DATASET,
        contactPoint=_contact("contactPage", "contactEmail"),
        hdab=F.struct(
            c("hdabName").alias("name"), c("hdabType").alias("type"),
            _contact("hdabPage", "hdabEmail").alias("contactPoint"),
        ),
        publisher=_publisher(),
        creator=_creator(),
        codeValues=tx.code_value_zip(c("codeSchemes"), c("codeNotations"), c("codeLabels")),
        retentionPeriod=_period("retentionStart", "retentionEnd"),
        temporalCoverage=_period("temporalStart", "temporalEnd"),
        personalData=tx.prefix_terms(tx.comma_list(c("personalData"))),
        qualifiedAttribution=tx.attribution_zip(c("attributionNames"), c("attributionRoles")),
        spatialResolution=c("spatialResolution").try_cast("double"),
        qualityAnnotation=F.lit(""),
        **lists,
        **numbers,
        **_same(
            "title", "description", "identifier", "version", "populationCoverage", "theme",
            "provenance", "healthCategory", "datasetType", "applicableLegislation",
            "accessRights", "healthTheme", "conformsTo", "documentation", "frequency",
            "landingPage", "language", "modificationDate", "releaseDate",
            "temporalResolution", "versionNotes", "purpose",
        ),
    )


def distribution_from_fields() -> Column:
    c = F.col
    both = c("checksumAlgorithm").isNotNull() & c("checksumValue").isNotNull()
    checksum = F.struct(c("checksumAlgorithm").alias("algorithm"), c("checksumValue").alias("value"))
    return _filled(
        DISTRIBUTION,
        byteSize=tx.int_from_text(c("byteSize")),
        checksum=F.when(both, checksum),
        spatialResolution=c("spatialResolution").try_cast("double"),
        **_same(
            "title", "applicableLegislation", "accessURL", "availability", "description",
            "format", "license", "mediaType", "packagingFormat", "releaseDate", "rights",
            "status", "temporalResolution", "accessService",
        ),
    )


def workbook_records(cells: DataFrame) -> DataFrame:
    """``workbook, job, catalog, dataset, distribution`` from job cells."""
    keys = ["workbook", "job"]
    parts = [
        sheet_fields(cells, base, rows).select(*keys, build().alias(name))
        for base, rows, build, name in (
            (CATALOG_SHEET, CATALOG_ROWS, catalog_from_fields, "catalog"),
            (DATASET_SHEET, DATASET_ROWS, dataset_from_fields, "dataset"),
            (DISTRIBUTION_SHEET, DISTRIBUTION_ROWS, distribution_from_fields, "distribution"),
        )
    ]
    return reduce(lambda a, b: a.join(b.hint("merge"), keys), parts)


def _messages(fields: DataFrame, *checks: Column) -> DataFrame:
    return unnest(
        fields, F.filter(F.array(*checks), lambda m: m.isNotNull()), "message", "workbook", "job"
    )


def metadata_violations(cells: DataFrame) -> DataFrame:
    """``workbook, job, message``: every rule a workbook breaks, not only the first."""

    def missing(*names: str) -> Column:
        return reduce(lambda a, b: a & b, [F.col(n).isNull() for n in names])

    def present(*names: str) -> Column:
        return reduce(lambda a, b: a | b, [F.col(n).isNotNull() for n in names])

    unreachable = missing("publisherPage", "publisherEmail")
    unnamed = missing("publisherName") & present("publisherPage", "publisherEmail")
    in_catalog = _messages(
        sheet_fields(cells, CATALOG_SHEET, CATALOG_ROWS),
        tx.strict_boolean_error(F.col("existing"), "Catalog.existing"),
        F.when((F.col("existing") == "true") & missing("uri"), F.lit(URI_MISSING)),
        F.when(present("publisherName") & unreachable, F.lit(PUBLISHER_UNREACHABLE)),
        F.when(unnamed, F.lit(PUBLISHER_UNNAMED)),
        tx.strict_boolean_error(F.col("publisherTrusted"), "Catalog.publisher.trusted"),
    )
    in_dataset = _messages(
        sheet_fields(cells, DATASET_SHEET, DATASET_ROWS),
        F.when(missing("contactPage", "contactEmail"), F.lit(CONTACT_MISSING)),
        F.when(missing("hdabPage", "hdabEmail"), F.lit(HDAB_MISSING)),
        F.when(unreachable, F.lit(DATASET_PUBLISHER_MISSING)),
        F.when(unnamed, F.lit("(Dataset) " + PUBLISHER_UNNAMED)),
        tx.strict_boolean_error(F.col("publisherTrusted"), "Dataset.Publisher.trusted"),
    )
    return in_catalog.unionByName(in_dataset)


# --- form submissions -----------------------------------------------------------------


def form_records(forms: DataFrame) -> DataFrame:
    """``form_id, catalog, dataset, distribution, error`` from ``form_id, body``."""
    parsed = unnest(forms, F.array(tx.form_fields(F.col("body"))), "f", "form_id")

    def value(key: str) -> Column:
        return tx.form_value(F.col("f"), key)

    def flag(key: str) -> Column:
        return tx.form_flag(F.col("f"), key)

    def contact(page: str, email: str) -> Column:
        return F.struct(value(page).alias("page"), value(email).alias("email"))

    def single(key: str) -> Column:
        return F.when(value(key).isNotNull(), F.array(value(key)))

    catalog = _filled(
        CATALOG,
        existing=flag("existingCatalog"), uri=value("catalogUri"), title=value("catalogTitle"),
        description=value("catalogDescription"),
        applicableLegislation=value("catalogApplicableLegislation"),
        geographicalCoverage=single("catalogSpatial"),
    )
    publisher = F.when(
        value("publisherName").isNotNull(),
        F.struct(
            value("publisherName").alias("name"), value("publisherType").alias("type"),
            contact("publisherPage", "publisherEmail").alias("contactPoint"),
            flag("publisherTrusted").alias("trusted"),
        ),
    )
    sample = F.when(
        value("sampleAccessUrl").isNotNull(),
        F.struct(
            value("sampleTitle").alias("title"), value("sampleAccessUrl").alias("accessURL"),
            value("sampleFormat").alias("format"),
            value("sampleLegislation").alias("applicableLegislation"),
        ),
    )
    dataset = _filled(
        DATASET,
        title=value("title"), description=value("description"), identifier=value("identifier"),
        version=value("datasetVersion"), populationCoverage=value("populationCoverage"),
        theme=value("theme"), provenance=value("provenance"),
        contactPoint=contact("contactPage", "contactEmail"),
        hdab=F.struct(
            value("hdabName").alias("name"), value("hdabType").alias("type"),
            contact("hdabContactPage", "hdabContactEmail").alias("contactPoint"),
            value("hdabNote").alias("note"), flag("hdabTrusted").alias("trusted"),
        ),
        publisher=publisher, keyword=tx.comma_list(value("keyword")),
        spatial=single("datasetSpatial"), healthCategory=value("healthCategory"),
        datasetType=value("type"), applicableLegislation=value("applicableLegislation"),
        accessRights=value("accessRights"), healthTheme=value("healthTheme"),
        qualityAnnotation=value("datasetQualityAnnotation"),
        frequency=value("datasetFrequency"), sample=sample,
    )
    distribution = _filled(
        DISTRIBUTION,
        accessURL=value("distributionAccessUrl"),
        applicableLegislation=value("distributionApplicableLegislation"),
        format=value("distributionFormat"), license=value("distributionLicense"),
        description=value("distributionDescription"),
    )
    return parsed.select(
        "form_id", catalog.alias("catalog"), dataset.alias("dataset"),
        distribution.alias("distribution"),
        F.when(
            value("datasetQualityAnnotation").isNull(), F.lit(QUALITY_MISSING)
        ).alias("error"),
    )
