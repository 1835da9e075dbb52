"""Data dictionaries and value sets from REDCap rows and variable sheets."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clinflat.functions.fhirpath import unnest
from clinflat.functions.text import blank_to_null, strip_html, trim_cell, trim_whitespace
from clinflat.namespaces import VOCABULARY_BASE
from clinflat.schemas import DICTIONARY_COLUMNS, VALUE_SET_COLUMNS

# What is left out, how codes are written.
DICTIONARY_SHEET, VALUE_SET_SHEET = "Data Dictionary", "Value Sets"
SKIPPED_FORMS = ("etusivu", "suostumus")
SKIPPED_TYPES = ("descriptive",)
SKIPPED_NAMES = ("record_id", "kukuid")
CODE_NOTICE = "(-?\\d+)\\s*=\\s*(.+?)(?:\\r?\\n|$)"
REQUIRED_COLUMNS = ("Variable", "Name", "Datatype")


def _or_empty(c: Column) -> Column:
    return F.coalesce(c, F.lit(""))


def _first_text(*cols: Column) -> Column:
    return F.coalesce(*[F.nullif(c, F.lit("")) for c in cols], F.lit(""))


def redcap_included() -> Column:
    name = F.col("Variable / Field Name")
    return (
        ~F.col("Form Name").isin(*SKIPPED_FORMS)
        & ~F.col("Field Type").isin(*SKIPPED_TYPES)
        & (name != "")
        & ~name.isin(*SKIPPED_NAMES)
    )


def redcap_type(field_type: Column, validation: Column) -> Column:
    v = F.lower(validation)
    text = (
        F.when(v.contains("integer"), F.lit("integer"))
        .when(v.contains("number"), F.lit("double"))
        .when(v.contains("date"), F.lit("date"))
        .otherwise(F.lit("string"))
    )
    return (
        F.when(field_type == "text", text)
        .when(field_type == "calc", F.lit("double"))
        .when(field_type == "slider", F.lit("integer"))
        .otherwise(F.lit("string"))
    )


def choices(text: Column) -> Column:
    """``code, display | code, display`` as an array of structs, null below two."""

    def choice(part: Column) -> Column:
        comma = F.locate(",", part)
        return F.struct(
            trim_whitespace(F.substring(part, F.lit(1), comma - 1)).alias("code"),
            trim_whitespace(F.substring(part, comma + 1, F.length(part))).alias("display"),
        )

    parts = F.transform(F.split(_or_empty(text), "\\|"), trim_whitespace)
    found = F.filter(F.transform(parts, choice), lambda c: (c["code"] != "") & (c["display"] != ""))
    return _at_least_two(found)


def notice_codes(text: Column) -> Column:
    """``code = display`` lines as an array of structs, null below two."""
    text = _or_empty(text)
    codes = F.regexp_extract_all(text, F.lit(CODE_NOTICE), 1)
    displays = F.regexp_extract_all(text, F.lit(CODE_NOTICE), 2)
    found = F.zip_with(
        codes,
        displays,
        lambda c, d: F.struct(
            trim_whitespace(c).alias("code"), trim_whitespace(d).alias("display")
        ),
    )
    return _at_least_two(found)


def _at_least_two(found: Column) -> Column:
    """The list, or null below two entries; the list is worked out once."""
    return F.get(F.transform(F.array(found), lambda f: F.when(F.size(f) >= 2, f)), F.lit(0))


def kora_included() -> Column:
    return (F.col("variable") != "") & (F.lower("hidden") != "yes")


def kora_type(raw: Column) -> Column:
    t = F.lower(trim_whitespace(raw))
    return (
        F.when(t.startswith("date"), F.lit("date"))
        .when(t.startswith("smallint") | (t == "integer"), F.lit("integer"))
        .when(t.startswith("decima") | t.startswith("float"), F.lit("double"))
        .otherwise(F.lit("string"))
    )


def _property_url(variable: Column, codes: Column) -> Column:
    url = F.concat(F.lit(f"{VOCABULARY_BASE}/"), variable)
    return F.when(F.size(codes) > 0, url).otherwise(F.lit(""))


def _dictionary(rows: DataFrame, cells: dict[str, Column]) -> DataFrame:
    return rows.select(*[cells.get(c, F.lit("")).alias(c) for c in DICTIONARY_COLUMNS])


def redcap_dictionary(rows: DataFrame, study: str) -> DataFrame:
    """The 20-column dictionary of a REDCap export.

    The label, without markup, else the field name, is both name
    and description. A section header is the group of its own row only, and makes
    the form the parent group.
    """
    variable = F.col("Variable / Field Name")
    section = strip_html(F.col("Section Header"))
    label = strip_html(F.col("Field Label"))
    name = _first_text(label, variable)
    codes = choices(F.col("Choices, Calculations, OR Slider Labels"))
    return _dictionary(
        rows.where(redcap_included()),
        {
            "Variable": variable,
            "Name": name,
            "Description": name,
            "Datatype": redcap_type(
                F.col("Field Type"), F.col("Text Validation Type OR Show Slider Number")
            ),
            "Property URL (ontology)": _property_url(variable, codes),
            "Study": F.lit(study),
            "Group": _first_text(section, F.col("Form Name")),
            "Identifier": F.col("Identifier?"),
            "Parent Group": F.when(section != "", F.col("Form Name")).otherwise(F.lit("")),
            "Note": strip_html(F.col("Field Note")),
            "Min Value": F.col("Text Validation Min"),
            "Max Value": F.col("Text Validation Max"),
            "Required": F.col("Required Field?"),
            "Conditional On": F.col("`Branching Logic (Show field only if...)`"),
        },
    )


def _value_sets(rows: DataFrame, variable: Column, codes: Column) -> DataFrame:
    named = rows.select(variable.alias("Variable"), codes.alias("codes"))
    return unnest(named, F.col("codes"), "c", "Variable").select(
        "Variable", F.col("c.code").alias("Code"), F.col("c.display").alias("Display")
    )


def redcap_value_sets(rows: DataFrame) -> DataFrame:
    return _value_sets(
        rows.where(redcap_included()),
        F.col("Variable / Field Name"),
        choices(F.col("Choices, Calculations, OR Slider Labels")),
    )


def kora_dictionary(rows: DataFrame) -> DataFrame:
    """The 20-column dictionary of a variable sheet."""
    variable = F.col("variable")
    name = _first_text(F.col("content"), variable)
    codes = notice_codes(F.col("code_notice"))
    return _dictionary(
        rows.where(kora_included()),
        {
            "Variable": variable,
            "Name": name,
            "Description": name,
            "Datatype": kora_type(F.col("raw_type")),
            "Property URL (ontology)": _property_url(variable, codes),
            "Study": F.col("study"),
            "Group": F.col("group"),
            "Subpopulation": F.col("subpopulation"),
            "Sample Size": F.col("sample_size"),
            "Data Owner": F.col("data_owner"),
            "Selection": F.col("selection"),
            "Parent Group": F.col("parent_table"),
            "Responsible": F.col("responsible"),
        },
    )


def kora_value_sets(rows: DataFrame) -> DataFrame:
    return _value_sets(
        rows.where(kora_included()), F.col("variable"), notice_codes(F.col("code_notice"))
    )


def _counts(rows: DataFrame, counted: Column, included: Column, codes: Column) -> DataFrame:
    """Counters of a dictionary run; ``counted`` rows are included or skipped."""
    n = F.coalesce(F.when(included, F.size(codes)), F.lit(0))
    return rows.where(counted).agg(
        F.count_if(included).alias("included"),
        F.count_if(~included).alias("skipped"),
        F.count_if(n > 0).alias("coded"),
        F.coalesce(F.sum(n), F.lit(0)).alias("value_set_rows"),
    )


def redcap_counts(rows: DataFrame) -> DataFrame:
    codes = choices(F.col("Choices, Calculations, OR Slider Labels"))
    return _counts(rows, F.lit(True), redcap_included(), codes)


def kora_counts(rows: DataFrame) -> DataFrame:
    """Hidden variables count as skipped, rows without a variable not at all."""
    codes = notice_codes(F.col("code_notice"))
    return _counts(rows, F.col("variable") != "", kora_included(), codes)


def _sheet_rows(cells: DataFrame, sheet: str, columns: tuple[str, ...]) -> DataFrame:
    """``workbook, job, row_idx`` and the columns of a sheet from job cells, without the header."""
    values = (
        cells.where((F.col("base") == sheet) & (F.col("row_idx") > 0))
        .groupBy("workbook", "job", "row_idx")
        .pivot("col_idx", list(range(len(columns))))
        .agg(F.first("value", ignorenulls=True))
    )
    named = [F.col(str(i)).alias(c) for i, c in enumerate(columns)]
    return values.select("workbook", "job", "row_idx", *named)


def dictionary_from_cells(cells: DataFrame) -> DataFrame:
    """Dictionary rows of each job's ``Data Dictionary`` sheet, for ``clean_dictionary``."""
    return _sheet_rows(cells, DICTIONARY_SHEET, DICTIONARY_COLUMNS)


def value_sets_from_cells(cells: DataFrame) -> DataFrame:
    """Value-set rows of each job's ``Value Sets`` sheet, for ``clean_value_sets``."""
    return _sheet_rows(cells, VALUE_SET_SHEET, VALUE_SET_COLUMNS)


def dictionary_from_records(records: DataFrame, *keys: str) -> DataFrame:
    """Dictionary rows of metadata records: ``keys``, ``job``, ``row_idx`` and the columns."""
    fields = records.select(*keys, "job", F.posexplode("dataDictionary").alias("row_idx", "f"))
    rest = fields.schema["f"].dataType.names[4:]
    named = zip(DICTIONARY_COLUMNS, ("name", "title", "description", "datatype", *rest))
    return fields.select(*keys, "job", "row_idx", *[F.col("f")[n].alias(c) for c, n in named])


def value_sets_from_records(records: DataFrame, *keys: str) -> DataFrame:
    """Value-set rows of metadata records; a code stands once, so the row does not matter."""
    sets = F.explode("dataDictionaryValueSets").alias("Variable", "codes")
    rows = records.select(*keys, "job", sets)
    return rows.select(
        *keys, "job", F.lit(0).alias("row_idx"), "Variable", F.explode("codes").alias("Code", "Display")
    )


def clean_dictionary(rows: DataFrame, *keys: str) -> DataFrame:
    """``keys`` and dictionary rows with a variable, cells trimmed, blank cells null.

    ``error`` names the first required cell that is blank; the last row counts
    like any other.
    """
    error = F.lit(None).cast("string")
    for column in reversed(REQUIRED_COLUMNS):
        message = f"The '{column}' field cannot be empty."
        error = F.when(F.col(column).isNull(), F.lit(message)).otherwise(error)
    return (
        rows.select(*keys, *[blank_to_null(F.col(c)).alias(c) for c in DICTIONARY_COLUMNS])
        .where(F.col("Variable").isNotNull())
        .withColumn("error", error)
    )


def clean_value_sets(rows: DataFrame, *keys: str) -> DataFrame:
    """One display per ``keys``, variable and code, the last by ``row_idx``."""
    trimmed = rows.select(
        *keys, "row_idx", *[trim_cell(F.col(c)).alias(c) for c in VALUE_SET_COLUMNS]
    )
    return (
        trimmed.where((F.col("Variable") != "") & (F.col("Code") != ""))
        .groupBy(*keys, "Variable", "Code")
        .agg(F.max_by("Display", "row_idx").alias("Display"))
    )
