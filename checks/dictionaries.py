"""Queries and oracles: data dictionaries and value sets."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks import fixtures as fx
from checks import sql
from clinflat.operators import dictionary as dic
from clinflat.schemas import DICTIONARY_COLUMNS, REDCAP_COLUMNS
from clinflat.session import table_path
from clinflat.sources import dictionary as src

STUDY = "NFBC1966"

# Cells of a REDCap row per part, as SQL that reads the same in Spark and DuckDB.
_P = "CAST(p_partkey AS VARCHAR(20))"
_LABEL = (
    "CASE WHEN p_partkey % 7 = 0 THEN '' "
    "WHEN p_partkey % 11 = 0 THEN repeat(p_name || ', ', 40) "
    "WHEN p_partkey % 5 = 0 THEN 'said \"' || p_name || '\"' || chr(10) || 'twice' "
    "ELSE '<p>' || p_name || ' &amp;lt; ' || p_brand || '&nbsp;</p>' END"
)
_REDCAP = {
    "Variable / Field Name": f"CASE WHEN p_partkey % 50 = 0 THEN '' WHEN p_partkey % 53 = 0 THEN 'record_id' ELSE 'var_' || {_P} END",
    "Form Name": "CASE WHEN p_partkey % 17 = 0 THEN 'etusivu' WHEN p_partkey % 19 = 0 THEN 'suostumus' ELSE lower(p_type) END",
    "Section Header": "CASE WHEN p_partkey % 6 = 0 THEN '<b>' || p_brand || '</b>' ELSE '' END",
    "Field Type": "CASE p_partkey % 9 WHEN 0 THEN 'radio' WHEN 1 THEN 'checkbox' WHEN 2 THEN 'dropdown' WHEN 3 THEN 'yesno' WHEN 4 THEN 'text' WHEN 5 THEN 'notes' WHEN 6 THEN 'calc' WHEN 7 THEN 'slider' ELSE 'descriptive' END",
    "Field Label": _LABEL,
    "Choices, Calculations, OR Slider Labels": "CASE WHEN p_partkey % 9 = 0 THEN '1, Yes | 2 ,No, maybe | x | , none | 4,' WHEN p_partkey % 9 = 1 THEN ' 0,' || p_name || '|1,' || p_brand || '|-9, ' || p_type WHEN p_partkey % 9 = 2 THEN '1, Only' ELSE '' END",
    "Field Note": "CASE WHEN p_partkey % 5 = 0 THEN '<i>note</i> ' || p_name ELSE '' END",
    "Text Validation Type OR Show Slider Number": "CASE p_partkey % 4 WHEN 0 THEN 'integer' WHEN 1 THEN 'number_2dp' WHEN 2 THEN 'DATE_dmy' ELSE '' END",
    "Text Validation Min": "CASE p_partkey % 8 WHEN 0 THEN CAST(p_size AS VARCHAR(20)) WHEN 1 THEN '0.5' WHEN 2 THEN 'today' ELSE '' END",
    "Text Validation Max": "CASE p_partkey % 8 WHEN 0 THEN CAST(p_size + 10 AS VARCHAR(20)) ELSE '' END",
    "Identifier?": "CASE WHEN p_partkey % 13 = 0 THEN 'y' ELSE '' END",
    "Branching Logic (Show field only if...)": "CASE WHEN p_partkey % 10 = 0 THEN '[' || p_brand || '] = ''1''' ELSE '' END",
    "Required Field?": "CASE WHEN p_partkey % 3 = 0 THEN 'y' ELSE '' END",
}

# Cells of a variable sheet per supplier, by position; other positions are missing.
_S = "CAST(s_suppkey AS VARCHAR(20))"
_SHEET = {
    1: f"CASE WHEN s_suppkey % 15 = 0 THEN ' ' ELSE ' v' || {_S} || chr(10) END",
    2: "CASE WHEN s_suppkey % 2 = 0 THEN 'included' END",
    3: "'T' || CAST(s_nationkey AS VARCHAR(20))",
    4: "'Study ' || CAST(s_nationkey % 3 AS VARCHAR(20))",
    5: "'Gruppe'",
    6: "'group #' || CAST(s_nationkey % 5 AS VARCHAR(20))",
    7: "'Inhalt ' || s_name",
    8: "CASE WHEN s_suppkey % 4 = 0 THEN '' ELSE 'Content ' || s_name END",
    9: "'1 = ja'",
    10: "CASE s_suppkey % 3 WHEN 0 THEN '1 = yes' || chr(10) || '2=no ' || chr(13) || chr(10) || '-9  =  missing' WHEN 1 THEN '1 = only' ELSE 'free text' END",
    11: "CASE WHEN s_suppkey % 6 = 0 THEN 'Owner ' || s_name END",
    12: "CASE WHEN s_suppkey % 7 = 0 THEN 'Dr. ' || s_name END",
    13: "CASE WHEN s_suppkey % 5 = 0 THEN 'all' END",
    14: f"CASE s_suppkey % 3 WHEN 0 THEN {_S} WHEN 1 THEN 'about ' || {_S} END",
    15: "CASE s_suppkey % 8 WHEN 0 THEN 'DATE' WHEN 1 THEN 'smallint(2)' WHEN 2 THEN 'integer' WHEN 3 THEN 'integer4' WHEN 4 THEN 'Decimal(3)' WHEN 5 THEN 'float' WHEN 6 THEN 'decima' ELSE 'varchar(10)' END",
    23: "CASE WHEN s_suppkey % 11 = 0 THEN 'YES' WHEN s_suppkey % 11 = 1 THEN 'no' END",
}


def redcap_rows(spark, d):
    rows = fx.table(spark, d, "part")
    return rows.select("p_partkey", *[F.expr(e).alias(n) for n, e in _REDCAP.items()])


def sheet_cells(spark, d):
    cells = [F.expr(_SHEET.get(i, "CAST(NULL AS STRING)")) for i in range(24)]
    rows = fx.table(spark, d, "supplier")
    return rows.select(F.col("s_suppkey").alias("row_idx"), F.array(*cells).alias("cells"))


def kora_rows(spark, d, lang="en"):
    return src.sheet_rows(sheet_cells(spark, d), lang)


def redcap_dictionary(spark, d):
    return dic.redcap_dictionary(redcap_rows(spark, d), STUDY)


def kora_dictionary(spark, d):
    return dic.kora_dictionary(kora_rows(spark, d))


def dict_csv_scan(spark, d):
    """Write the rows as quoted CSV files and scan them back."""
    path = table_path(spark, "redcap")
    rows = redcap_rows(spark, d).drop("p_partkey")
    rows.write.option("header", True).option("quoteAll", True).option("escape", '"').csv(path)
    return src.read_dictionary_csv(spark, path)


def dict_sheet_scan(spark, d):
    english = kora_rows(spark, d).withColumn("lang", F.lit("en"))
    return english.unionByName(kora_rows(spark, d, "de").withColumn("lang", F.lit("de")))


def redcap_filter(spark, d):
    return redcap_rows(spark, d).where(dic.redcap_included()).select("p_partkey")


def redcap_types(spark, d):
    kind = dic.redcap_type(F.col("Field Type"), F.col("Text Validation Type OR Show Slider Number"))
    return redcap_rows(spark, d).select("p_partkey", kind.alias("datatype"))


def redcap_value_sets(spark, d):
    return dic.redcap_value_sets(redcap_rows(spark, d))


def kora_filter(spark, d):
    return kora_rows(spark, d).where(dic.kora_included()).select("row_idx", "variable")


def kora_types(spark, d):
    return kora_rows(spark, d).select("row_idx", dic.kora_type(F.col("raw_type")).alias("datatype"))


def kora_value_sets(spark, d):
    return dic.kora_value_sets(kora_rows(spark, d))


def dict_counts(spark, d):
    redcap = dic.redcap_counts(redcap_rows(spark, d)).withColumn("source", F.lit("redcap"))
    kora = dic.kora_counts(kora_rows(spark, d)).withColumn("source", F.lit("sheet"))
    return redcap.unionByName(kora)


def messy_dictionary(spark, d):
    """Dictionary rows with padded and blank cells, as a workbook would give them."""
    rows = redcap_dictionary(spark, d).unionByName(kora_dictionary(spark, d))
    padded = [
        F.when(F.col(c) != "", F.concat(F.lit(" \t"), F.col(c), F.lit("\n"))).otherwise(F.col(c))
        if c != "Datatype"
        else F.when(F.col("Group") == "economy", F.lit(" ")).otherwise(F.col(c))
        for c in (f"`{n}`" if "(" in n else n for n in DICTIONARY_COLUMNS)
    ]
    return rows.select(*[p.alias(n) for p, n in zip(padded, DICTIONARY_COLUMNS)])


def dictionary_clean(spark, d):
    return dic.clean_dictionary(messy_dictionary(spark, d))


def value_set_rows(spark, d):
    return fx.table(spark, d, "events").select(
        F.col("event_id").alias("row_idx"),
        F.concat(F.lit(" "), "event_type", F.lit("\n")).alias("Variable"),
        F.when(F.col("user_id") % 20 == 0, F.lit(" ")).otherwise(
            (F.col("user_id") % 20).cast("string")
        ).alias("Code"),
        F.concat(F.lit("d"), F.col("event_id"), F.lit(" ")).alias("Display"),
    )


def value_sets_clean(spark, d):
    return dic.clean_value_sets(value_set_rows(spark, d))


QUERIES = {
    "dict_csv_scan": dict_csv_scan,
    "dict_sheet_scan": dict_sheet_scan,
    "redcap_filter": redcap_filter,
    "redcap_dictionary": redcap_dictionary,
    "redcap_types": redcap_types,
    "redcap_value_sets": redcap_value_sets,
    "kora_filter": kora_filter,
    "kora_dictionary": kora_dictionary,
    "kora_types": kora_types,
    "kora_value_sets": kora_value_sets,
    "dict_counts": dict_counts,
    "dictionary_clean": dictionary_clean,
    "value_sets_clean": value_sets_clean,
}


def _q(name: str) -> str:
    return f'"{name}"'


_COLS = ", ".join(f"{e} AS {_q(n)}" for n, e in _REDCAP.items())
REDCAP = f"""red AS (SELECT p_partkey, {_COLS} FROM part),
red_in AS (SELECT * FROM red WHERE "Form Name" NOT IN ('etusivu', 'suostumus')
  AND "Field Type" <> 'descriptive' AND "Variable / Field Name" NOT IN ('', 'record_id', 'kukuid'))"""


def _clean(name: str) -> str:
    text = f"regexp_replace({_q(name)}, '<[^>]+>', '', 'g')"
    for a, b in (("&nbsp;", " "), ("&amp;", "&"), ("&lt;", "<"), ("&gt;", ">")):
        text = f"replace({text}, '{a}', '{b}')"
    return sql.trim(text)


_REDCAP_TYPE = """CASE WHEN "Field Type" = 'text' THEN CASE p_partkey % 4 WHEN 0 THEN 'integer'
    WHEN 1 THEN 'double' WHEN 2 THEN 'date' ELSE 'string' END
  WHEN "Field Type" = 'calc' THEN 'double' WHEN "Field Type" = 'slider' THEN 'integer'
  ELSE 'string' END"""
_NAME = f"coalesce(nullif({_clean('Field Label')}, ''), \"Variable / Field Name\")"
# Of the choice lists, kind 0 has two valid entries, kind 1 three, kind 2 one.
_CODES = """red_codes AS (
  SELECT "Variable / Field Name" AS var, unnest(['1', '2']) AS code,
         unnest(['Yes', 'No, maybe']) AS display FROM red_in WHERE p_partkey % 9 = 0
  UNION ALL SELECT "Variable / Field Name", unnest(['0', '1', '-9']),
         unnest([p.p_name, p.p_brand, p.p_type])
  FROM red_in JOIN part p USING (p_partkey) WHERE p_partkey % 9 = 1)"""
_URL = "'http://example.org/vocab/'"


def _dictionary_sql(cells: dict[str, str], source: str) -> str:
    chosen = ", ".join(f"{cells.get(c, quote_empty)} AS {_q(c)}" for c in DICTIONARY_COLUMNS)
    return f"SELECT {chosen} FROM {source}"


quote_empty = "''"

REDCAP_DICT = "red_dict AS (" + _dictionary_sql(
    {
        "Variable": '"Variable / Field Name"',
        "Name": _NAME,
        "Description": _NAME,
        "Datatype": _REDCAP_TYPE,
        "Property URL (ontology)": f"CASE WHEN p_partkey % 9 IN (0, 1) THEN {_URL} || \"Variable / Field Name\" ELSE '' END",
        "Study": f"'{STUDY}'",
        "Group": f"coalesce(nullif({_clean('Section Header')}, ''), \"Form Name\")",
        "Identifier": '"Identifier?"',
        "Parent Group": "CASE WHEN \"Section Header\" <> '' THEN \"Form Name\" ELSE '' END",
        "Note": _clean("Field Note"),
        "Min Value": '"Text Validation Min"',
        "Max Value": '"Text Validation Max"',
        "Required": '"Required Field?"',
        "Conditional On": '"Branching Logic (Show field only if...)"',
    },
    "red_in",
) + ")"

_POS = {**src.SHEET_POSITIONS}


def _sheet_select(lang: str) -> str:
    positions = {**src.SHEET_POSITIONS, **src.SHEET_LANGUAGE_POSITIONS[lang]}
    cells = ", ".join(
        f"coalesce({sql.trim(_SHEET[i])}, '') AS \"{n}\"" for n, i in positions.items()
    )
    return f"SELECT s_suppkey AS row_idx, {cells} FROM supplier WHERE s_suppkey > 0"


SHEET = f"""sheet AS ({_sheet_select('en')}),
sheet_in AS (SELECT * FROM sheet WHERE variable <> '' AND lower(hidden) <> 'yes'),
sheet_codes AS (SELECT variable AS var, unnest(['1', '2', '-9']) AS code,
  unnest(['yes', 'no', 'missing']) AS display FROM sheet_in WHERE row_idx % 3 = 0)"""
_SHEET_TYPE = """CASE row_idx % 8 WHEN 0 THEN 'date' WHEN 1 THEN 'integer' WHEN 2 THEN 'integer'
  WHEN 3 THEN 'string' WHEN 4 THEN 'double' WHEN 5 THEN 'double' WHEN 6 THEN 'double'
  ELSE 'string' END"""
SHEET_DICT = "sheet_dict AS (" + _dictionary_sql(
    {
        "Variable": "variable",
        "Name": "coalesce(nullif(content, ''), variable)",
        "Description": "coalesce(nullif(content, ''), variable)",
        "Datatype": _SHEET_TYPE,
        "Property URL (ontology)": f"CASE WHEN row_idx % 3 = 0 THEN {_URL} || variable ELSE '' END",
        "Study": "study",
        "Group": '"group"',
        "Subpopulation": "subpopulation",
        "Sample Size": "sample_size",
        "Data Owner": "data_owner",
        "Selection": "selection",
        "Parent Group": "parent_table",
        "Responsible": "responsible",
    },
    "sheet_in",
) + ")"
DICTIONARIES = (REDCAP, REDCAP_DICT, SHEET, SHEET_DICT)
BOTH_DICT = "both_dict AS (SELECT * FROM red_dict UNION ALL SELECT * FROM sheet_dict)"
CODES = (REDCAP, _CODES, SHEET)

_CSV_COLS = ", ".join(f"{sql.trim(_q(c))} AS {_q(c)}" for c in REDCAP_COLUMNS)
_VALUE_SET = """SELECT trim("Variable", chr(10) || ' ') AS "Variable" """
_NULLED = ", ".join(
    f"""nullif({sql.trim(_q(c))}, '') AS {_q(c)}"""
    if c != "Datatype"
    else """CASE WHEN "Group" = 'economy' THEN NULL ELSE "Datatype" END AS "Datatype\""""
    for c in DICTIONARY_COLUMNS
)

ORACLES = {
    "dict_csv_scan": sql.with_(REDCAP) + f"SELECT {_CSV_COLS} FROM red",
    "dict_sheet_scan": f"SELECT *, 'en' AS lang FROM ({_sheet_select('en')}) "
    f"UNION ALL SELECT *, 'de' FROM ({_sheet_select('de')})",
    "redcap_filter": sql.with_(REDCAP) + "SELECT p_partkey FROM red_in",
    "redcap_dictionary": sql.with_(REDCAP, REDCAP_DICT) + "SELECT * FROM red_dict",
    "redcap_types": sql.with_(REDCAP) + f"SELECT p_partkey, {_REDCAP_TYPE} AS datatype FROM red",
    "redcap_value_sets": sql.with_(REDCAP, _CODES)
    + 'SELECT var AS "Variable", code AS "Code", display AS "Display" FROM red_codes',
    "kora_filter": sql.with_(SHEET) + "SELECT row_idx, variable FROM sheet_in",
    "kora_dictionary": sql.with_(SHEET, SHEET_DICT) + "SELECT * FROM sheet_dict",
    "kora_types": sql.with_(SHEET) + f"SELECT row_idx, {_SHEET_TYPE} AS datatype FROM sheet",
    "kora_value_sets": sql.with_(SHEET)
    + 'SELECT var AS "Variable", code AS "Code", display AS "Display" FROM sheet_codes',
    "dict_counts": sql.with_(*CODES)
    + """SELECT 'redcap' AS source, (SELECT count(*) FROM red_in) AS included,
          (SELECT count(*) FROM red) - (SELECT count(*) FROM red_in) AS skipped,
          (SELECT count(DISTINCT var) FROM red_codes) AS coded,
          (SELECT count(*) FROM red_codes) AS value_set_rows
        UNION ALL SELECT 'sheet', (SELECT count(*) FROM sheet_in),
          (SELECT count(*) FROM sheet WHERE variable <> '') - (SELECT count(*) FROM sheet_in),
          (SELECT count(DISTINCT var) FROM sheet_codes), (SELECT count(*) FROM sheet_codes)""",
    "dictionary_clean": sql.with_(*DICTIONARIES, BOTH_DICT)
    + f"""SELECT {_NULLED}, CASE WHEN "Group" = 'economy'
          THEN 'The ''Datatype'' field cannot be empty.' END AS error FROM both_dict""",
    "value_sets_clean": """SELECT event_type AS "Variable", (user_id % 20)::VARCHAR AS "Code",
          'd' || max(event_id) AS "Display"
        FROM events WHERE user_id % 20 <> 0 GROUP BY event_type, user_id % 20""",
}
