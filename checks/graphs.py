"""Queries and oracles: metadata triples."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks import dictionaries as dc
from checks import fixtures as fx
from checks import metadata as md
from checks import sql
from checks.observations import obs_long
from checks.surveys import vocab_merged
from clinflat import namespaces as ns
from clinflat.operators import graph_delta as gd
from clinflat.operators import record_triples as rt
from clinflat.operators import schema_triples as st
from clinflat.operators.triples import concept_schemes
from clinflat.sources.sinks import ntriples

# --- queries --------------------------------------------------------------------------


def csvw_triples(spark, d):
    """Each brand is a table, each of its part names a column, some with a vocabulary."""
    parts = fx.table(spark, d, "part")
    columns = parts.select(
        F.concat(F.lit("urn:table:"), F.regexp_replace("p_brand", "#", "-")).alias("subject"),
        F.when(F.endswith("p_brand", F.lit("1")), F.lit("")).otherwise(F.lit("urn:dist:1")).alias("parent"),
        F.col("p_name").alias("name"),
        F.when(F.startswith("p_name", F.lit("s")), F.lit("LongType")).otherwise(
            F.lit("StringType")
        ).alias("type"),
        F.when(F.startswith("p_name", F.lit("red")), F.lit("observation_codes")).alias("vocab_id"),
    ).distinct()
    return st.csvw_triples(columns)


def skos_triples(spark, d):
    return concept_schemes(vocab_merged(spark, d))


def _dictionary(spark, d):
    rows = dc.redcap_dictionary(spark, d).withColumn("subject", F.lit("urn:dict:redcap"))
    sheet = dc.kora_dictionary(spark, d).withColumn("subject", F.lit("urn:dict:sheet"))
    return rows.unionByName(sheet).withColumn("parent", F.lit("urn:dist:1"))


def dictionary_triples(spark, d):
    return st.dictionary_triples(_dictionary(spark, d))


def facet_triples(spark, d):
    return st.facet_triples(_dictionary(spark, d))


def valueset_triples(spark, d):
    return st.value_set_triples(dc.redcap_value_sets(spark, d))


def _releases(spark, d):
    """The value sets as first published, and as published now: one code has gone, one is
    new, and the displays of another are written differently."""
    now = dc.redcap_value_sets(spark, d)
    first = now.where(F.col("Code") != "2").withColumn(
        "Display", F.when(F.col("Code") == "1", F.lower("Display")).otherwise(F.col("Display"))
    )
    return st.value_set_triples(first), st.value_set_triples(now.where(F.col("Code") != "4"))


def graph_delta(spark, d):
    return gd.graph_delta(*_releases(spark, d))


def graph_republished(spark, d):
    """The changes applied to the first release give the present one."""
    old, new = _releases(spark, d)
    return gd.apply_delta(old, gd.graph_delta(old, new))


def _addressed(spark, d):
    return rt.with_addresses(
        md.records(spark, d), F.concat(F.lit("run"), F.col("s_suppkey").cast("string"))
    )


def link_triples(spark, d):
    return rt.link_triples(_addressed(spark, d))


def catalog_triples(spark, d):
    rows = (
        _addressed(spark, d)
        .withColumn("catalog_start", F.col("catalog.temporalCoverage.start"))
        .withColumn("catalog_end", F.col("catalog.temporalCoverage.end"))
    )
    return rt.catalog_triples(rows)


def distribution_triples(spark, d):
    return rt.distribution_triples(_addressed(spark, d))


def dataset_triples(spark, d):
    """Survey records with the statistics and systems of the supplier's order lines."""
    records = _addressed(spark, d).where(F.col("job") == "survey")
    final = md._override(spark, d, "json").drop("mode")
    rows = records.join(final, "s_suppkey")
    used = fx.table(spark, d, "lineitem").where(F.col("l_suppkey") % 3 == 0).select(
        F.col("l_suppkey").alias("s_suppkey"), F.concat(F.lit("urn:flag "), "l_returnflag").alias("system")
    ).distinct()
    systems = used.join(records.select("s_suppkey", "dataset_uri"), "s_suppkey").select(
        "dataset_uri", "system"
    )
    return rt.dataset_triples(rows, systems)


def triples_ntriples(spark, d):
    return ntriples(facet_triples(spark, d).unionByName(dictionary_triples(spark, d)))


def obs_skos_triples(spark, d):
    from clinflat.operators.vocab import code_vocabulary

    return concept_schemes(code_vocabulary(obs_long(spark, d), "observation_codes"))


QUERIES = {
    "csvw_triples": csvw_triples,
    "skos_triples": skos_triples,
    "skos_triples_observation": obs_skos_triples,
    "dictionary_triples": dictionary_triples,
    "facet_triples": facet_triples,
    "valueset_triples": valueset_triples,
    "graph_delta": graph_delta,
    "graph_republished": graph_republished,
    "link_triples": link_triples,
    "catalog_triples": catalog_triples,
    "distribution_triples": distribution_triples,
    "dataset_triples": dataset_triples,
    "triples_ntriples": triples_ntriples,
}

# --- oracles --------------------------------------------------------------------------


def _digest(*key: str) -> str:
    return "sha256(" + " || chr(31) || ".join(f"coalesce({k}, '')" for k in key) + ")"


def _urn(*key: str) -> str:
    h = _digest(*key)
    parts = " || '-' || ".join(f"substr({h}, {a}, {n})" for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12)))
    return f"('urn:uuid:' || {parts})"


def _bnode(*key: str) -> str:
    return f"('_:b' || substr({_digest(*key)}, 1, 32))"


def _t(source, s, p, o, kind="uri", datatype=None, lang=None) -> str:
    dt = "NULL" if datatype is None else datatype if "CASE" in datatype else f"'{ns.XSD}{datatype}'"
    lg = "NULL" if lang is None else lang if "CASE" in lang else f"'{lang}'"
    return (
        f"SELECT ({s})::VARCHAR AS s, '{p}' AS p, ({o})::VARCHAR AS o, '{kind}' AS o_kind, "
        f"({dt})::VARCHAR AS datatype, ({lg})::VARCHAR AS lang FROM {source}"
    )


def _u(source, s, p, o, cls=None) -> list[str]:
    """A link and, with a class, the type of its target."""
    return [_t(source, s, p, o)] + ([] if cls is None else [_t(source, o, ns.RDF_TYPE, f"'{cls}'")])


def _type(source, s, cls) -> str:
    return _t(source, s, ns.RDF_TYPE, f"'{cls}'")


def _plain(source, s, p, o) -> str:
    return _t(source, s, p, o, "literal", "string")


def _en(source, s, p, o) -> str:
    return _t(source, s, p, o, "literal", None, "en")


def _graph(*triples: str) -> str:
    return (
        "SELECT DISTINCT * FROM (\n" + "\nUNION ALL\n".join(triples)
        + "\n) WHERE o IS NOT NULL AND s IS NOT NULL"
    )


def _group(src, s, parent, title, description, table, table_title) -> list[str]:
    return [
        _type(src, s, ns.CSVW + "TableGroup"),
        _en(src, s, ns.DCT + "title", f"'{title}'"),
        _en(src, s, ns.DCT + "description", f"'{description}'"),
        _t(src, s, ns.DCT + "isPartOf", parent),
        _t(src, s, ns.CSVW + "table", table),
        _type(src, table, ns.CSVW + "Table"),
        _en(src, table, ns.DCT + "title", f"'{table_title}'"),
    ]


def _scheme(src, vocab, code, display) -> list[str]:
    scheme = f"'{ns.VOCABULARY_BASE}/' || {vocab}"
    concept = f"{scheme} || '/' || {code}"
    return [
        _type(src, scheme, ns.SKOS + "ConceptScheme"),
        _plain(src, scheme, ns.DCT + "title", f"'Vocabulary for ' || {vocab}"),
        _type(src, concept, ns.SKOS + "Concept"),
        _t(src, concept, ns.SKOS + "inScheme", scheme),
        _plain(src, concept, ns.SKOS + "notation", code),
        _en(src, concept, ns.SKOS + "prefLabel", display),
        _t(src, scheme, ns.SKOS + "hasTopConcept", concept),
    ]


_C_TABLE, _C_COL = _urn("subject", "'table'"), _urn("subject", "'column'", "name")
_CSVW = """cols AS (SELECT DISTINCT 'urn:table:' || replace(p_brand, '#', '-') AS subject,
  CASE WHEN p_brand LIKE '%1' THEN NULL ELSE 'urn:dist:1' END AS parent, p_name AS name,
  CASE WHEN p_name LIKE 's%' THEN 'integer' ELSE 'string' END AS dtype,
  CASE WHEN p_name LIKE 'red%' THEN 'observation_codes' END AS vocab_id FROM part)"""

_D_COLUMNS = [f'"{c}"' for c in dc.DICTIONARY_COLUMNS]
_DICT = f"""dict AS (
  SELECT *, {_urn("subject", "'variable'", *_D_COLUMNS)} AS node, {_urn("subject", "'table'")} AS tbl
  FROM (SELECT *, 'urn:dict:redcap' AS subject FROM red_dict
        UNION ALL SELECT *, 'urn:dict:sheet' FROM sheet_dict)),
owned AS (SELECT *, {_bnode("node", "'owner'")} AS b FROM dict WHERE "Data Owner" <> ''),
answerable AS (SELECT *, {_bnode("node", "'attribution'")} AS b, {_bnode("node", "'responsible'")} AS a
  FROM dict WHERE "Responsible" <> '')"""
_DICTIONARY = (*dc.DICTIONARIES, _DICT)


def _given(column: str) -> str:
    return f"nullif(\"{column}\", '')"


def _number(column: str, p: str, whole_type: str, real: bool) -> str:
    c = f'"{column}"'
    whole = f"regexp_full_match({c}, '[+-]?[0-9]+')"
    other = f"WHEN try_cast({c} AS DOUBLE) IS NOT NULL THEN" if real else "WHEN FALSE THEN"
    return _t(
        "dict", "node", p,
        f"CASE WHEN {c} = '' THEN NULL WHEN {whole} THEN {c}::BIGINT::VARCHAR {other} try_cast({c} AS DOUBLE)::VARCHAR ELSE {c} END",
        "literal",
        f"CASE WHEN {whole} THEN '{ns.XSD}{whole_type}' {other} '{ns.XSD}double' END",
        f"CASE WHEN {whole} THEN NULL {other} NULL ELSE 'en' END",
    )


def _truthy(column: str, p: str) -> str:
    return _t(
        "dict", "node", p,
        f"CASE WHEN \"{column}\" <> '' THEN CASE WHEN lower(\"{column}\") IN ('yes', 'y', 'true', '1') THEN 'true' ELSE 'false' END END",
        "literal", "boolean",
    )


_DICT_TRIPLES = [
    *_group(
        "dict", "subject", "'urn:dist:1'", "Data Dictionary Schema",
        "CSVW schema describing the variables defined in the data dictionary.", "tbl",
        "Variable Definitions",
    ),
    _t("dict", "tbl", ns.CSVW + "column", "node"),
    _type("dict", "node", ns.CSVW + "Column"),
    _plain("dict", "node", ns.CSVW + "name", '"Variable"'),
    _en("dict", "node", ns.CSVW + "titles", '"Name"'),
    _plain("dict", "node", ns.CSVW + "datatype", '"Datatype"'),
    _en("dict", "node", ns.DCT + "description", _given("Description")),
    _t("dict", "node", ns.CSVW + "propertyUrl", _given("Property URL (ontology)")),
    _plain("dict", "node", ns.QUDT + "unit", _given("Unit")),
    _plain("dict", "node", ns.HEALTH + "populationCoverage", _given("Subpopulation")),
    _number("Sample Size", ns.COHORT + "sampleSize", "nonNegativeInteger", real=False),
    _t("owned", "node", ns.DCT + "rightsHolder", "b", "bnode"),
    _type("owned", "b", ns.FOAF + "Agent"),
    _plain("owned", "b", ns.FOAF + "name", '"Data Owner"'),
    _truthy("Identifier", ns.COHORT + "isIdentifier"),
    _t("answerable", "node", ns.PROV + "qualifiedAttribution", "b", "bnode"),
    _type("answerable", "b", ns.PROV + "Attribution"),
    _t("answerable", "b", ns.DCAT + "hadRole", f"'{ns.RESPONSIBLE_ROLE}'"),
    _t("answerable", "b", ns.PROV + "agent", "a", "bnode"),
    _type("answerable", "a", ns.FOAF + "Agent"),
    _plain("answerable", "a", ns.FOAF + "name", '"Responsible"'),
    _en("dict", "node", ns.SKOS + "scopeNote", _given("Note")),
    _number("Min Value", ns.CSVW + "minimum", "integer", real=True),
    _number("Max Value", ns.CSVW + "maximum", "integer", real=True),
    _truthy("Required", ns.CSVW + "required"),
    _en("dict", "node", ns.COHORT + "conditionalOn", _given("Conditional On")),
]


def _facet(column: str, path: str, title: str, predicate: str) -> list[str]:
    scheme = f"'{ns.VOCABULARY_BASE}/{path}'"
    value = _given(column)
    slug = f"regexp_replace(regexp_replace({sql.trim(value)}, '\\s+', '_', 'g'), '[<>\"{{}}|\\\\^`#]', '', 'g')"
    concept = f"{scheme} || '/' || {slug}"
    some = f"(SELECT * FROM dict WHERE \"{column}\" <> '')"
    return [
        _type("dict", scheme, ns.SKOS + "ConceptScheme"),
        _en("dict", scheme, ns.DCT + "title", f"'{title}'"),
        _type(some, concept, ns.SKOS + "Concept"),
        _t(some, concept, ns.SKOS + "inScheme", scheme),
        _en(some, concept, ns.SKOS + "prefLabel", value),
        _t(some, scheme, ns.SKOS + "hasTopConcept", concept),
        _t(some, "node", predicate, concept),
    ]


_FACETS = [t for f in st.FACETS for t in _facet(*f)]

# Metadata records, restated per supplier and job.
_K = "s_suppkey"
_RECS = f"""recs AS (
  SELECT s_suppkey, s_name, job, s_suppkey AS k, 'run' || s_suppkey AS run,
         s_suppkey::VARCHAR AS ks FROM supplier, (SELECT unnest(['survey', 'observation']) AS job)),
adr AS (
  SELECT *, CASE WHEN k % 8 = 0 THEN 'http://catalog/' || k ELSE {_urn("run", "'catalog'")} END AS cat,
         {_urn("run", "job", "'dataset'")} AS ds, {_urn("run", "job", "'distribution'")} AS di,
         {_urn("run", "job", "'csvw'")} AS cs
  FROM recs),
fresh AS (SELECT * FROM adr WHERE k % 4 <> 0),
surv AS (SELECT * FROM adr WHERE job = 'survey')"""


def _where(source: str, cond: str) -> str:
    return f"(SELECT * FROM {source} WHERE {cond})"


def _contact_sql(src, s, node, prefix) -> list[str]:
    return [
        _t(src, s, ns.DCAT + "contactPoint", node, "bnode"),
        _type(src, node, ns.VCARD + "Kind"),
        _t(
            src, node, ns.VCARD + "hasEmail",
            f"CASE WHEN k % 3 = 0 THEN 'mailto:{prefix}%20desk' || k || '@x.org' END",
        ),
        _t(src, node, ns.VCARD + "hasURL", f"CASE WHEN k % 3 <> 0 THEN 'http://page/{prefix}/' || k END"),
    ]


def _publisher_sql(src, s, node, note: bool) -> list[str]:
    src = _where(src, "k % 5 <> 0")
    out = [
        _t(src, s, ns.DCT + "publisher", node, "bnode"),
        _type(src, node, ns.FOAF + "Agent"),
        _plain(src, node, ns.FOAF + "name", "s_name"),
        _t(
            src, node, ns.HEALTH + "trustedDataHolder",
            "CASE WHEN k % 2 = 0 THEN 'true' ELSE 'false' END", "literal", "boolean",
        ),
        _t(src, node, ns.DCT + "type", "'http://type/a%20b'"),
        *_contact_sql(src, node, f"{node} || 'c'", "pub"),
    ]
    return out + ([_plain(src, node, ns.DCT + "description", "'no warranty'")] if note else [])


def _creator_sql(src, s, node, email: bool) -> list[str]:
    src = _where(src, "k % 4 <> 0")
    out = [
        _t(src, s, ns.DCT + "creator", node, "bnode"),
        _type(src, node, ns.FOAF + "Agent"),
        _plain(src, node, ns.FOAF + "name", "'by ' || s_name"),
    ]
    return out + ([_t(src, node, ns.VCARD + "hasEmail", "'mailto:c@x.org'")] if email else [])


def _period_sql(src, s, p, node, start, end) -> list[str]:
    return [
        _t(src, s, p, node, "bnode"),
        _type(src, node, ns.DCT + "PeriodOfTime"),
        _t(src, node, ns.DCAT + "startDate", start, "literal", "date"),
        _t(src, node, ns.DCAT + "endDate", end, "literal", "date"),
    ]


def _distribution_sql(src, s, job) -> list[str]:
    check, some = _bnode(s, "'checksum'"), _where(src, "k % 4 <> 0")
    rights, free = _bnode(s, "'rights'"), _where(src, "k % 3 <> 0")
    digits = "regexp_replace('ab:c' || k, '[^0-9a-fA-F]', '', 'g')"
    return [
        _t(src, s, ns.DCAT + "accessURL", f"'http://data/' || {job} || '%20' || k"),
        *_u(src, s, ns.DCT + "format", "'http://format/CSV'", ns.MEDIA_TYPE_EXTENT),
        _plain(src, s, ns.DCT + "title", f"{job} || ' ' || s_name"),
        _t(src, s, ns.DCAT + "byteSize", "k * 100", "literal", "nonNegativeInteger"),
        _t(some, s, ns.SPDX + "checksum", check, "bnode"),
        _type(some, check, ns.SPDX + "Checksum"),
        *_u(some, check, ns.SPDX + "algorithm", "'http://md5'", ns.SPDX + "ChecksumAlgorithm"),
        _t(
            some, check, ns.SPDX + "checksumValue",
            f"left({digits}, length({digits}) - length({digits}) % 2)", "literal", "hexBinary",
        ),
        *_u(src, s, ns.DCAT + "mediaType", "'http://media'", ns.MEDIA_TYPE),
        _t(free, s, ns.DCT + "rights", rights, "bnode"),
        _type(free, rights, ns.DCT + "RightsStatement"),
        _plain(free, rights, ns.DCT + "description", "'as is'"),
        _t(src, s, ns.DCAT + "spatialResolutionInMeters", "'12.5'", "literal", "decimal"),
        _t(
            src, s, ns.DCAT + "temporalResolution", "CASE WHEN k % 2 = 0 THEN 'P1Y' END",
            "literal", "duration",
        ),
    ]


_CATALOG = [
    _type("adr", "cat", ns.DCAT + "Catalog"),
    _plain("fresh", "cat", ns.DCT + "title", "'Catalog ' || s_name"),
    _plain("fresh", "cat", ns.DCT + "description", "'All \"of\" it'"),
    *_u("fresh", "cat", ns.DCATAP + "applicableLegislation", "'http://law/%201'", ns.LEGAL_RESOURCE),
    *_period_sql(
        "fresh", "cat", ns.DCT + "temporal", _bnode("cat", "'temporal'"), "'2010-01-01'", "NULL"
    ),
    _t(
        "fresh", "cat", ns.DCT + "issued", "CASE WHEN k % 2 = 0 THEN '2026-01-01' END", "literal",
        "date",
    ),
    *_u("fresh", "cat", ns.DCT + "license", "'http://licence'", ns.DCT + "LicenseDocument"),
    *_u("fresh", "cat", ns.FOAF + "homepage", "'http://home'", ns.FOAF + "Document"),
    *_u("fresh", "cat", ns.DCT + "spatial", "'http://geo/a'", ns.DCT + "Location"),
    *_u("fresh", "cat", ns.DCT + "spatial", "'http://geo/' || k", ns.DCT + "Location"),
    *_u("fresh", "cat", ns.DCT + "language", "'http://lang/ENG'", ns.DCT + "LinguisticSystem"),
    _t(_where("fresh", "k % 3 <> 0"), "cat", ns.DCT + "rights", _bnode("cat", "'rights'"), "bnode"),
    _type(_where("fresh", "k % 3 <> 0"), _bnode("cat", "'rights'"), ns.DCT + "RightsStatement"),
    _plain(_where("fresh", "k % 3 <> 0"), _bnode("cat", "'rights'"), ns.DCT + "description", "'read only'"),
    *_creator_sql("fresh", "cat", _bnode("cat", "'creator'"), email=False),
    *_publisher_sql("fresh", "cat", _bnode("cat", "'publisher'"), note=False),
]

_HDAB, _CODE = _bnode("ds", "'hdab'"), _bnode("ds", "'code'", "'http://s'", "'n' || ks", "'label'")
_OTHER = _bnode("ds", "'identifier'", "'id-' || ks")
_ATTR = _bnode("ds", "'attribution'", "s_name", "'sponsor'")
_DATASET = [
    _type("surv", "ds", ns.DCAT + "Dataset"),
    _t("surv", "ds", ns.DCT + "isPartOf", "cat"),
    _plain("surv", "ds", ns.DCT + "title", "'survey of ' || s_name"),
    _plain("surv", "ds", ns.DCAT + "version", "'1.0'"),
    _t("surv", "ds", ns.DCT + "identifier", "'http://id/' || k || '/survey'", "literal", "anyURI"),
    *_period_sql(
        "fin", "ds", ns.DCT + "temporal", _bnode("ds", "'temporal'"), "start_date", "end_date"
    ),
    *_contact_sql("surv", "ds", _bnode("ds", "'contact'"), "ds"),
    *_u("surv", "ds", ns.HEALTH + "healthCategory", "'http://cat/REG_A_B'", ns.SKOS + "Concept"),
    _en("surv", "'http://cat/REG_A_B'", ns.SKOS + "prefLabel", "'REG A B'"),
    *[
        _t("fin", "ds", ns.HEALTH + p, c, "literal", "nonNegativeInteger")
        for p, c in (
            ("numberOfRecords", "record_count"), ("numberOfUniqueIndividuals", "unique_patients"),
            ("minTypicalAge", "min_age"), ("maxTypicalAge", "max_age"),
        )
    ],
    *_publisher_sql("surv", "ds", _bnode("ds", "'publisher'"), note=True),
    _t("surv", "ds", ns.HEALTH + "hdab", _HDAB, "bnode"),
    _type("surv", _HDAB, ns.FOAF + "Agent"),
    _plain("surv", _HDAB, ns.FOAF + "name", "'HDAB'"),
    *_contact_sql("surv", _HDAB, f"{_HDAB} || 'c'", "hdab"),
    *_period_sql(
        "surv", "ds", ns.HEALTH + "retentionPeriod", _bnode("ds", "'retention'"), "'2020-01-01'",
        "'2030-01-01'",
    ),
    _plain("surv", "ds", ns.DPV + "hasPurpose", "'research'"),
    *_creator_sql("surv", "ds", _bnode("ds", "'creator'"), email=True),
    _t(_where("surv", "k % 2 <> 0"), "ds", ns.ADMS + "sample", _bnode("ds", "'sample'"), "bnode"),
    _type(_where("surv", "k % 2 <> 0"), _bnode("ds", "'sample'"), ns.DCAT + "Distribution"),
    *_distribution_sql(_where("surv", "k % 2 <> 0"), _bnode("ds", "'sample'"), "'sample'"),
    _plain("surv", "ds", ns.DCAT + "keyword", "'health'"),
    _plain("surv", "ds", ns.DCAT + "keyword", "s_name"),
    _t("surv", "ds", ns.HEALTH + "hasCodeValues", _CODE, "bnode"),
    _type("surv", _CODE, ns.SKOS + "Concept"),
    _plain("surv", _CODE, ns.SKOS + "notation", "'n' || k"),
    _en("surv", _CODE, ns.SKOS + "prefLabel", "'label'"),
    _t("surv", _CODE, ns.SKOS + "inScheme", "'http://s'"),
    _t("surv", "ds", ns.ADMS + "identifier", _OTHER, "bnode"),
    _type("surv", _OTHER, ns.ADMS + "Identifier"),
    _plain("surv", _OTHER, ns.SKOS + "notation", "'id-' || k"),
    _t("surv", "ds", ns.PROV + "qualifiedAttribution", _ATTR, "bnode"),
    _type("surv", _ATTR, ns.PROV + "Attribution"),
    _t("surv", _ATTR, ns.PROV + "agent", f"{_ATTR} || 'a'", "bnode"),
    _type("surv", f"{_ATTR} || 'a'", ns.FOAF + "Agent"),
    _plain("surv", f"{_ATTR} || 'a'", ns.FOAF + "name", "s_name"),
    _t("surv", _ATTR, ns.DCAT + "hadRole", "'sponsor'"),
    _t("sys", "ds", ns.HEALTH + "hasCodingSystem", "system"),
    _t("plain", "ds", ns.HEALTH + "hasCodingSystem", "'urn:configured'"),
    _t("plain", "ds", ns.HEALTH + "hasCodingSystem", "'urn:own%20' || k"),
]
_FINAL = f"""nums AS (SELECT s_suppkey, {md._final(True)} FROM supplier
  LEFT JOIN (SELECT * FROM lines WHERE s_suppkey % 5 <> 1) l USING (s_suppkey)),
fin AS (SELECT * FROM surv JOIN nums USING (s_suppkey)),
sys AS (SELECT DISTINCT ds, 'urn:flag%20' || l_returnflag AS system
  FROM lineitem JOIN surv ON l_suppkey = s_suppkey WHERE l_suppkey % 3 = 0),
plain AS (SELECT * FROM surv WHERE ds NOT IN (SELECT ds FROM sys))"""

_ESCAPED = "o"
for _a, _b in (("\\", "\\\\"), ('"', '\\"')):
    _ESCAPED = f"replace({_ESCAPED}, '{_a}', '{_b}')"
for _c, _b in ((10, "\\n"), (13, "\\r"), (9, "\\t")):
    _ESCAPED = f"replace({_ESCAPED}, chr({_c}), '{_b}')"


def _node(c: str) -> str:
    return f"CASE WHEN {c} LIKE '\\_:%' ESCAPE '\\' THEN {c} ELSE '<' || {c} || '>' END"


_LINE = f"""SELECT {_node('s')} || ' <' || p || '> ' || CASE WHEN o_kind <> 'literal' THEN {_node('o')}
  ELSE '"' || {_ESCAPED} || '"' || coalesce('@' || lang, '^^<' || datatype || '>', '') END || ' .' AS value"""

_RELEASES = """first AS (SELECT var, code, CASE WHEN code = '1' THEN lower(display) ELSE display END AS display
  FROM red_codes WHERE code <> '2'),
now AS (SELECT var, code, display FROM red_codes WHERE code <> '4')"""
_FIRST, _NOW = (_graph(*_scheme(r, "var", "code", "display")) for r in ("first", "now"))

ORACLES = {
    "csvw_triples": sql.with_(_CSVW)
    + _graph(
        *_group(
            "cols", "subject", "parent", "Cohort Data Schema",
            "CSVW schema describing the flattened cohort dataset.", _C_TABLE, "Tabular Data",
        ),
        _t("cols", _C_TABLE, ns.CSVW + "url", f"'{ns.DATASET_FILE}'"),
        _t("cols", _C_TABLE, ns.CSVW + "column", _C_COL),
        _type("cols", _C_COL, ns.CSVW + "Column"),
        _plain("cols", _C_COL, ns.CSVW + "name", "replace(name, ' ', '_')"),
        _en("cols", _C_COL, ns.CSVW + "titles", "name"),
        _en("cols", _C_COL, ns.DCT + "description", "'Data values for ' || name"),
        _t("cols", _C_COL, ns.CSVW + "propertyUrl", f"'{ns.VOCABULARY_BASE}/' || vocab_id"),
        _plain("cols", _C_COL, ns.CSVW + "datatype", "dtype"),
    ),
    "skos_triples": sql.with_(
        *sql.EVERYTHING, sql.VOCAB_OBS, sql.VOCAB_Q, sql.VOCAB_OPT, sql.VOCAB_ALL
    )
    + _graph(*_scheme("vocab_all", "vocab_id", "code", "display")),
    "skos_triples_observation": sql.with_(*sql.OBSERVED, sql.VOCAB_OBS)
    + _graph(*_scheme("vocab_obs", "vocab_id", "code", "display")),
    "dictionary_triples": sql.with_(*_DICTIONARY) + _graph(*_DICT_TRIPLES),
    "facet_triples": sql.with_(*_DICTIONARY) + _graph(*_FACETS),
    "valueset_triples": sql.with_(*dc.CODES) + _graph(*_scheme("red_codes", "var", "code", "display")),
    "graph_delta": sql.with_(*dc.CODES, _RELEASES)
    + f"""SELECT 'drop' AS op, * FROM (({_FIRST}) EXCEPT ({_NOW}))
        UNION ALL SELECT 'add' AS op, * FROM (({_NOW}) EXCEPT ({_FIRST}))""",
    "graph_republished": sql.with_(*dc.CODES, _RELEASES) + _NOW,
    "link_triples": sql.with_(_RECS)
    + _graph(
        _t("adr", "ds", ns.DCT + "isPartOf", "cat"),
        _t("adr", "di", ns.DCT + "isPartOf", "ds"),
        _t("adr", "cs", ns.DCT + "isPartOf", "di"),
    ),
    "catalog_triples": sql.with_(_RECS) + _graph(*_CATALOG),
    "distribution_triples": sql.with_(_RECS)
    + _graph(
        _type("adr", "di", ns.DCAT + "Distribution"),
        _t("adr", "di", ns.DCT + "isPartOf", "ds"),
        *_distribution_sql("adr", "di", "job"),
    ),
    "dataset_triples": sql.with_(_RECS, md._LINES, _FINAL) + _graph(*_DATASET),
    "triples_ntriples": sql.with_(*_DICTIONARY)
    + f"{_LINE} FROM (SELECT * FROM ({_graph(*_FACETS)}) UNION ALL SELECT * FROM ({_graph(*_DICT_TRIPLES)}))",
}
