"""Queries and oracles: scalar functions over whole test tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks import fixtures as fx
from checks import sql
from clinflat.functions import literals as lit
from clinflat.functions import text as tx


def _over(table: str, key: str, spark_input: str, function):
    """A query that applies one function to a SQL expression of a table."""

    def query(spark, d):
        source = fx.table(spark, d, table).select(key, F.expr(spark_input).alias("input"))
        return source.select(key, function(F.col("input")).alias("result"))

    return query


def _literal(table: str, key: str, spark_input: str, function):
    def query(spark, d):
        source = fx.table(spark, d, table).select(key, F.expr(spark_input).alias("input"))
        return source.select(key, function(F.col("input")).alias("r")).select(key, "r.*")

    return query


# Inputs as SQL that reads the same in Spark and DuckDB.
_HTML = "html || ' &amp;lt;b&amp;gt; &nbsp;'"
_NAME = "' ' || text || '-' || source || '(%)'"
_URI = "'  ' || url || ' a  b' || chr(9) || '<x>\"{y}|^`z ' || html"
_SLUG = "' ' || p_name || ' #' || p_brand || '  {' || p_type || '}'"
_DATE = (
    "CASE o_orderkey % 5 WHEN 0 THEN left(CAST(o_orderdate AS VARCHAR(30)), 10) "
    "WHEN 1 THEN left(CAST(o_orderdate AS VARCHAR(30)), 7) "
    "WHEN 2 THEN CAST(o_orderdate AS VARCHAR(30)) WHEN 3 THEN ' 2024-01-01' END"
)
_DURATION = "CASE o_orderkey % 3 WHEN 0 THEN 'P' || CAST(o_orderkey AS VARCHAR(20)) || 'D' " \
    "WHEN 1 THEN 'one day' ELSE 'PT' END"
_HEX = "CASE WHEN event_id % 9 = 0 THEN 'xyz' ELSE event_type || '-' || CAST(event_id AS VARCHAR(20)) || 'AbG' END"
_NUMBER = (
    "CASE l_orderkey % 6 WHEN 0 THEN CAST(l_quantity AS VARCHAR(20)) "
    "WHEN 1 THEN ' ' || CAST(l_partkey AS VARCHAR(20)) || ' ' WHEN 2 THEN l_returnflag "
    "WHEN 3 THEN '-' || CAST(l_suppkey + 1 AS VARCHAR(20)) WHEN 4 THEN '' "
    "ELSE CAST(l_extendedprice AS VARCHAR(20)) END"
)
_FLAG = (
    "CASE c_custkey % 8 WHEN 0 THEN 'Yes' WHEN 1 THEN ' y ' WHEN 2 THEN 'TRUE' WHEN 3 THEN '1' "
    "WHEN 4 THEN 'no' WHEN 5 THEN '' WHEN 6 THEN c_mktsegment END"
)
_BOOLEAN = (
    "CASE c_custkey % 6 WHEN 0 THEN 'true' WHEN 1 THEN ' false ' WHEN 2 THEN '' "
    "WHEN 3 THEN 'True' WHEN 4 THEN c_mktsegment END"
)
_TYPE = (
    "CASE p_partkey % 7 WHEN 0 THEN 'IntegerType' WHEN 1 THEN 'LongType' WHEN 2 THEN 'DoubleType' "
    "WHEN 3 THEN 'BinaryType' WHEN 4 THEN 'DecimalType' WHEN 5 THEN 'FloatType' ELSE p_type END"
)
_BLANK = "CASE conv_id % 4 WHEN 0 THEN chr(9) || ' ' || chr(10) WHEN 1 THEN '' ELSE ' ' || text || chr(10) END"
_LIST = "replace(text, ' ', ', ') || ',,' || source"
_CELL = "chr(10) || chr(9) || ' ' || text || ' ' || chr(13) || chr(10)"


def strict_boolean(spark, d):
    source = fx.table(spark, d, "customer").select("c_custkey", F.expr(_BOOLEAN).alias("t"))
    return source.select(
        "c_custkey",
        tx.strict_boolean(F.col("t")).alias("result"),
        tx.strict_boolean_error(F.col("t"), "Catalog.existing").alias("error"),
    )


def code_value_zip(spark, d):
    """Three lists per supplier; every fifth supplier has one list too short."""
    k = F.col("s_suppkey")
    source = fx.table(spark, d, "supplier").select(
        k,
        F.concat(F.lit("urn:a, urn:b,"), F.when(k % 5 == 0, F.lit("")).otherwise(F.lit(",x"))).alias("s"),
        F.concat(F.lit("n1,,n"), k, F.lit(",n4")).alias("n"),
        F.concat("s_name", F.lit(",b,"), F.when(k % 3 == 0, F.lit("")).otherwise(F.lit("c")), F.lit(",d")).alias("l"),
    )
    zipped = source.select(k, tx.code_value_zip(F.col("s"), F.col("n"), F.col("l")).alias("z"))
    return zipped.select(k, F.explode("z").alias("c")).select("s_suppkey", "c.*")


def attribution_zip(spark, d):
    k = F.col("s_suppkey")
    source = fx.table(spark, d, "supplier").select(
        k,
        F.concat("s_name", F.lit(",,other")).alias("n"),
        F.when(k % 4 == 0, F.lit("a,b")).otherwise(F.lit(" sponsor ,x, ")).alias("r"),
    )
    zipped = source.select(k, tx.attribution_zip(F.col("n"), F.col("r")).alias("z"))
    return zipped.select(k, F.explode("z").alias("c")).select("s_suppkey", "c.*")


def prefix_terms(spark, d):
    source = fx.table(spark, d, "part").select("p_partkey", F.split("p_name", " ").alias("t"))
    return source.select("p_partkey", F.explode(tx.prefix_terms(F.col("t"))).alias("term"))


def comma_lists(spark, d):
    source = fx.table(spark, d, "documents").select("doc_id", F.expr(_LIST).alias("t"))
    return source.select(
        "doc_id",
        F.concat_ws("|", tx.comma_list(F.col("t"))).alias("trimmed"),
        F.concat_ws("|", tx.raw_comma_list(F.col("t"))).alias("raw"),
    )


def form_decode(spark, d):
    """A submission per customer with encoded, blank, repeated and missing fields."""
    k = F.col("c_custkey")
    body = F.concat(
        F.lit("title="), F.replace("c_name", F.lit("#"), F.lit("%23")), F.lit("+%26+co&keyword=a%2C+b&version="),
        F.when(k % 2 == 0, F.lit("")).otherwise(F.lit("1=2")),
        F.lit("&uri=first&uri="), k, F.when(k % 3 == 0, F.lit("&existing=on")).otherwise(
            F.when(k % 3 == 1, F.lit("&existing=no")).otherwise(F.lit("&page=+"))
        ),
    )
    fields = fx.table(spark, d, "customer").select("c_custkey", tx.form_fields(body).alias("f"))
    f = F.col("f")
    return fields.select(
        "c_custkey",
        *[tx.form_value(f, n).alias(n) for n in ("title", "keyword", "version", "uri", "page")],
        tx.form_flag(f, "existing").alias("existing"),
    )


QUERIES = {
    "strip_html": _over("pages", "page_id", _HTML, tx.strip_html),
    "sanitize_name": _over("documents", "doc_id", _NAME, tx.sanitize_name),
    "safe_uri": _over("pages", "page_id", _URI, tx.safe_uri),
    "concept_slug": _over("part", "p_partkey", _SLUG, tx.concept_slug),
    "identifier_uri": _over("documents", "doc_id", "text", tx.identifier_uri),
    "date_guard": _over("orders", "o_orderkey", _DATE, tx.date_guard),
    "duration_guard": _over("orders", "o_orderkey", _DURATION, tx.duration_guard),
    "hex_clean": _over("events", "event_id", _HEX, tx.hex_clean),
    "boundary_literal": _literal("lineitem", "l_orderkey", _NUMBER, lit.boundary_literal),
    "sample_size_literal": _literal("lineitem", "l_orderkey", _NUMBER, lit.sample_size_literal),
    "truthy_flag": _over("customer", "c_custkey", _FLAG, tx.truthy_flag),
    "strict_boolean": strict_boolean,
    "csvw_datatype": _over("part", "p_partkey", _TYPE, lit.csvw_datatype),
    "uri_label": _over("pages", "page_id", "url || '/a_b_c//'", tx.uri_label),
    "comma_list": comma_lists,
    "code_value_zip": code_value_zip,
    "attribution_zip": attribution_zip,
    "prefix_terms": prefix_terms,
    "int_from_text": _over("lineitem", "l_orderkey", _NUMBER, tx.int_from_text),
    "form_decode": form_decode,
    "blank_to_null": _over("conversations", "conv_id", _BLANK, tx.blank_to_null),
    "trim_whitespace": _over("conversations", "conv_id", _CELL, tx.trim_whitespace),
}


def _sql(table: str, key: str, spark_input: str, result: str) -> str:
    return (
        f"SELECT {key}, {result} AS result FROM (SELECT *, {spark_input} AS input FROM {table})"
    )


def _literal_sql(table: str, key: str, spark_input: str, o: str, datatype: str, lang: str) -> str:
    return (
        f"SELECT {key}, {o} AS o, {datatype} AS datatype, {lang} AS lang "
        f"FROM (SELECT *, input AS raw, trim(input) AS t FROM "
        f"(SELECT *, {spark_input} AS input FROM {table}))"
    )


_XSD = "http://www.w3.org/2001/XMLSchema#"
_WHOLE = "regexp_full_match(t, '[+-]?[0-9]+')"
_REAL = "try_cast(t AS DOUBLE) IS NOT NULL"
_GONE = "regexp_replace({}, '[<>\"{{}}|\\\\^`{}]', '', 'g')"

ORACLES = {
    "strip_html": _sql(
        "pages", "page_id", _HTML,
        sql.trim(
            "replace(replace(replace(replace(regexp_replace(input, '<[^>]+>', '', 'g'), "
            "'&nbsp;', ' '), '&amp;', '&'), '&lt;', '<'), '&gt;', '>')"
        ),
    ),
    "sanitize_name": _sql(
        "documents", "doc_id", _NAME,
        "trim(regexp_replace(lower(input), '[^a-z0-9]+', '_', 'g'), '_')",
    ),
    "safe_uri": _sql(
        "pages", "page_id", _URI,
        _GONE.format(f"regexp_replace({sql.trim('input')}, '\\s+', '%20', 'g')", ""),
    ),
    "concept_slug": _sql(
        "part", "p_partkey", _SLUG,
        _GONE.format("regexp_replace(trim(input), '\\s+', '_', 'g')", "#"),
    ),
    "identifier_uri": _sql("documents", "doc_id", "text", "regexp_replace(input, '\\s+', '', 'g')"),
    "date_guard": _sql(
        "orders", "o_orderkey", _DATE,
        "CASE WHEN regexp_full_match(input, '[0-9]{4}-[0-9]{2}-[0-9]{2}') THEN input END",
    ),
    "duration_guard": _sql(
        "orders", "o_orderkey", _DURATION, "CASE WHEN input LIKE 'P%' THEN input END"
    ),
    "hex_clean": f"""SELECT event_id, nullif(left(h, length(h) - length(h) % 2), '') AS result
        FROM (SELECT event_id, regexp_replace({_HEX}, '[^0-9a-fA-F]', '', 'g') AS h FROM events)""",
    "boundary_literal": _literal_sql(
        "lineitem", "l_orderkey", _NUMBER,
        f"CASE WHEN {_WHOLE} THEN t::BIGINT::VARCHAR WHEN {_REAL} THEN t::DOUBLE::VARCHAR ELSE t END",
        f"CASE WHEN {_WHOLE} THEN '{_XSD}integer' WHEN {_REAL} THEN '{_XSD}double' END",
        f"CASE WHEN {_WHOLE} OR {_REAL} THEN NULL ELSE 'en' END",
    ),
    "sample_size_literal": _literal_sql(
        "lineitem", "l_orderkey", _NUMBER,
        f"CASE WHEN {_WHOLE} THEN t::BIGINT::VARCHAR ELSE raw END",
        f"CASE WHEN {_WHOLE} THEN '{_XSD}nonNegativeInteger' END",
        f"CASE WHEN {_WHOLE} THEN NULL ELSE 'en' END",
    ),
    "truthy_flag": _sql(
        "customer", "c_custkey", _FLAG, "lower(trim(input)) IN ('yes', 'y', 'true', '1')"
    ),
    "strict_boolean": f"""SELECT c_custkey,
          CASE trim(t) WHEN 'true' THEN true WHEN 'false' THEN false END AS result,
          CASE WHEN trim(t) NOT IN ('', 'true', 'false')
               THEN 'Incorrect value for boolean: ' || t || ' (Catalog.existing)' END AS error
        FROM (SELECT c_custkey, {_BOOLEAN} AS t FROM customer)""",
    "csvw_datatype": _sql(
        "part", "p_partkey", _TYPE,
        "CASE WHEN lower(input) LIKE '%int%' OR lower(input) LIKE '%long%' THEN 'integer' "
        "WHEN lower(input) LIKE '%double%' OR lower(input) LIKE '%float%' THEN 'double' "
        "WHEN lower(input) LIKE '%binary%' THEN 'binary' ELSE 'string' END",
    ),
    "uri_label": _sql("pages", "page_id", "url", "'a b c'"),
    "comma_list": f"""SELECT doc_id,
          array_to_string([trim(p, {sql.quote(sql.SPACE)}) FOR p IN l
            IF trim(p, {sql.quote(sql.SPACE)}) <> ''], '|') AS trimmed,
          array_to_string(string_split(rtrim(t, ','), ','), '|') AS raw
        FROM (SELECT doc_id, {_LIST} AS t, string_split({_LIST}, ',') AS l FROM documents)""",
    "code_value_zip": """WITH z AS (
          SELECT s_suppkey, unnest(['urn:a', 'urn:b', NULL, 'x']) AS scheme,
                 unnest(['n1', '', 'n' || s_suppkey, 'n4']) AS notation,
                 unnest([s_name, 'b', CASE WHEN s_suppkey % 3 = 0 THEN '' ELSE 'c' END, 'd']) AS label
          FROM supplier WHERE s_suppkey % 5 <> 0)
        SELECT * FROM z WHERE notation <> '' AND label <> ''""",
    "attribution_zip": """SELECT s_suppkey, unnest([s_name, 'other']) AS name, unnest([
          'https://standards.iso.org/iso/19115/resources/Codelists/gml/CI_RoleCode.xml#sponsor',
          NULL]) AS role FROM supplier WHERE s_suppkey % 4 <> 0""",
    "prefix_terms": """SELECT p_partkey, 'https://w3c.github.io/dpv/2.0/pd#'
          || unnest(string_split(p_name, ' ')) AS term FROM part""",
    "int_from_text": _sql(
        "lineitem", "l_orderkey", _NUMBER, "trunc(try_cast(trim(input) AS DOUBLE))::INT"
    ),
    "form_decode": """SELECT c_custkey, c_name || ' & co' AS title, 'a, b' AS keyword,
          CASE WHEN c_custkey % 2 = 1 THEN '1' END AS version, c_custkey::VARCHAR AS uri,
          NULL::VARCHAR AS page,
          CASE c_custkey % 3 WHEN 0 THEN true WHEN 1 THEN false END AS existing FROM customer""",
    "blank_to_null": _sql(
        "conversations", "conv_id", _BLANK,
        "nullif(trim(input, ' ' || chr(9) || chr(10) || chr(13)), '')",
    ),
    "trim_whitespace": _sql("conversations", "conv_id", _CELL, sql.trim("input")),
}
