"""Triples of metadata records: catalogs, datasets, distributions and their links.

Input frames carry ``catalog, dataset, distribution`` structs and the addresses
from ``with_addresses``; dataset rows also carry the final statistics.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clinflat.functions.text import (
    date_guard,
    duration_guard,
    hex_clean,
    identifier_uri,
    safe_uri,
    trim_cell,
    uri_label,
)
from clinflat.namespaces import (
    ADMS,
    DCAT,
    DCATAP,
    DCT,
    DPV,
    FOAF,
    HEALTH,
    LEGAL_RESOURCE,
    MEDIA_TYPE,
    MEDIA_TYPE_EXTENT,
    PROV,
    SKOS,
    SPDX,
    VCARD,
)
from clinflat.operators.triples import (
    as_graph,
    blank,
    blank_node,
    each,
    emit,
    link,
    minted_urn,
    only_if,
    resource,
    text,
    type_of,
    typed,
)


def with_addresses(records: DataFrame, run: Column) -> DataFrame:
    """Add the addresses of a record's catalog, dataset, distribution and schema.

    One catalog is shared by all jobs of a run; an existing catalog keeps its own
    address. The others depend on run and job.
    """
    own = F.when(
        F.coalesce(F.col("catalog.existing"), F.lit(False)),
        F.nullif(trim_cell(F.col("catalog.uri")), F.lit("")),
    )
    return (
        records.withColumn("catalog_uri", F.coalesce(own, minted_urn(run, F.lit("catalog"))))
        .withColumn("dataset_uri", minted_urn(run, F.col("job"), F.lit("dataset")))
        .withColumn("distribution_uri", minted_urn(run, F.col("job"), F.lit("distribution")))
        .withColumn("csvw_uri", minted_urn(run, F.col("job"), F.lit("csvw")))
    )


def link_triples(records: DataFrame) -> DataFrame:
    """Schema part of distribution, distribution part of dataset, dataset of catalog."""
    part_of = DCT + "isPartOf"
    return as_graph(
        emit(
            records,
            [
                link(F.col("dataset_uri"), part_of, F.col("catalog_uri")),
                link(F.col("distribution_uri"), part_of, F.col("dataset_uri")),
                link(F.col("csvw_uri"), part_of, F.col("distribution_uri")),
            ],
        )
    )


def _period(s: Column, p: str, node: Column, start: Column, end: Column) -> list[Column]:
    return only_if(
        F.coalesce(start, end),
        blank(s, p, node),
        type_of(node, DCT + "PeriodOfTime"),
        typed(node, DCAT + "startDate", date_guard(start), "date"),
        typed(node, DCAT + "endDate", date_guard(end), "date"),
    )


def _rights(s: Column, node: Column, rights: Column) -> list[Column]:
    return only_if(
        rights,
        blank(s, DCT + "rights", node),
        type_of(node, DCT + "RightsStatement"),
        text(node, DCT + "description", rights),
    )


def _contact(s: Column, node: Column, contact: Column) -> list[Column]:
    mail = F.concat(F.lit("mailto:"), contact["email"])
    return [
        blank(s, DCAT + "contactPoint", node),
        type_of(node, VCARD + "Kind"),
        link(node, VCARD + "hasEmail", safe_uri(mail)),
        link(node, VCARD + "hasURL", safe_uri(contact["page"])),
    ]


def _creator(s: Column, node: Column, creator: Column, with_email: bool) -> list[Column]:
    mail = F.concat(F.lit("mailto:"), creator["email"])
    return only_if(
        creator["name"],
        blank(s, DCT + "creator", node),
        type_of(node, FOAF + "Agent"),
        text(node, FOAF + "name", creator["name"]),
        link(node, DCT + "type", safe_uri(creator["type"])),
        *([link(node, VCARD + "hasEmail", safe_uri(mail))] if with_email else []),
    )


def _publisher(s: Column, node: Column, publisher: Column, with_note: bool) -> list[Column]:
    contact = F.concat(node, F.lit("c"))
    return only_if(
        publisher["name"],
        blank(s, DCT + "publisher", node),
        type_of(node, FOAF + "Agent"),
        text(node, FOAF + "name", publisher["name"]),
        typed(node, HEALTH + "trustedDataHolder", publisher["trusted"], "boolean"),
        link(node, DCT + "type", safe_uri(publisher["type"])),
        *([text(node, DCT + "description", publisher["note"])] if with_note else []),
        *_contact(node, contact, publisher["contactPoint"]),
    )


def catalog_triples(records: DataFrame) -> DataFrame:
    """Catalog graph; an existing catalog gives its type only.

    ``catalog_start``/``catalog_end`` are the final dates over all jobs.
    """
    s, c = F.col("catalog_uri"), F.col("catalog")
    existing = emit(records, [type_of(s, DCAT + "Catalog")])
    fresh = records.where(~F.coalesce(c["existing"], F.lit(False)))
    described = emit(
        fresh,
        [
            text(s, DCT + "title", c["title"]),
            text(s, DCT + "description", c["description"]),
            *resource(s, DCATAP + "applicableLegislation", c["applicableLegislation"], LEGAL_RESOURCE),
            *_period(
                s, DCT + "temporal", blank_node(s, F.lit("temporal")),
                F.col("catalog_start"), F.col("catalog_end"),
            ),
            *resource(s, DCAT + "theme", c["themes"]),
            typed(s, DCT + "issued", date_guard(c["releaseDate"]), "date"),
            typed(s, DCT + "modified", date_guard(c["modificationDate"]), "date"),
            *resource(s, DCT + "license", c["licence"], DCT + "LicenseDocument"),
            *resource(s, FOAF + "homepage", c["homepage"], FOAF + "Document"),
            *_rights(s, blank_node(s, F.lit("rights")), c["rights"]),
            *_creator(s, blank_node(s, F.lit("creator")), c["creator"], with_email=False),
            *_publisher(s, blank_node(s, F.lit("publisher")), c["publisher"], with_note=False),
        ],
        [
            each(
                c["geographicalCoverage"],
                lambda v: resource(s, DCT + "spatial", v, DCT + "Location"),
            ),
            each(
                c["language"], lambda v: resource(s, DCT + "language", v, DCT + "LinguisticSystem")
            ),
        ],
    )
    return as_graph(existing, described)


def _distribution(s: Column, d: Column) -> list[Column]:
    """The 17 fields of a distribution."""
    checksum = blank_node(s, F.lit("checksum"))
    algorithm = safe_uri(d["checksum"]["algorithm"])
    return [
        *resource(s, DCAT + "accessURL", d["accessURL"]),
        *resource(s, DCATAP + "applicableLegislation", d["applicableLegislation"], LEGAL_RESOURCE),
        *resource(s, DCT + "format", d["format"], MEDIA_TYPE_EXTENT),
        text(s, DCT + "title", d["title"]),
        text(s, DCT + "description", d["description"]),
        *resource(s, DCT + "license", d["license"], DCT + "LicenseDocument"),
        *resource(s, DCATAP + "availability", d["availability"]),
        typed(s, DCAT + "byteSize", d["byteSize"], "nonNegativeInteger"),
        *only_if(
            d["checksum"]["algorithm"],
            blank(s, SPDX + "checksum", checksum),
            type_of(checksum, SPDX + "Checksum"),
            link(checksum, SPDX + "algorithm", algorithm),
            type_of(algorithm, SPDX + "ChecksumAlgorithm"),
            typed(checksum, SPDX + "checksumValue", hex_clean(d["checksum"]["value"]), "hexBinary"),
        ),
        *resource(s, DCAT + "mediaType", d["mediaType"], MEDIA_TYPE),
        *resource(s, DCAT + "packageFormat", d["packagingFormat"], MEDIA_TYPE),
        typed(s, DCT + "issued", date_guard(d["releaseDate"]), "date"),
        *_rights(s, blank_node(s, F.lit("rights")), d["rights"]),
        typed(s, DCAT + "spatialResolutionInMeters", d["spatialResolution"], "decimal"),
        *resource(s, ADMS + "status", d["status"]),
        typed(s, DCAT + "temporalResolution", duration_guard(d["temporalResolution"]), "duration"),
        *resource(s, DCAT + "accessService", d["accessService"]),
    ]


def distribution_triples(records: DataFrame) -> DataFrame:
    s = F.col("distribution_uri")
    return as_graph(
        emit(
            records,
            [
                type_of(s, DCAT + "Distribution"),
                link(s, DCT + "isPartOf", F.col("dataset_uri")),
                *_distribution(s, F.col("distribution")),
            ],
        )
    )


def _nested_distribution(s: Column, p: str, node: Column, d: Column) -> list[Column]:
    return only_if(
        d, blank(s, p, node), type_of(node, DCAT + "Distribution"), *_distribution(node, d)
    )


def _labelled_concept(s: Column, p: str, uri: Column) -> list[Column]:
    return [
        *resource(s, p, uri, SKOS + "Concept"),
        text(safe_uri(uri), SKOS + "prefLabel", uri_label(uri), "en"),
    ]


def dataset_triples(records: DataFrame, systems: DataFrame | None = None) -> DataFrame:
    """Dataset graph with final statistics.

    ``records`` carries ``record_count, unique_patients, min_age, max_age,
    start_date, end_date``. ``systems`` has the computed coding systems as rows
    ``dataset_uri, system``; a dataset without any takes the configured list.
    """
    s, d = F.col("dataset_uri"), F.col("dataset")

    def node(*key: Column | str) -> Column:
        return blank_node(s, *[F.lit(k) if isinstance(k, str) else k for k in key])

    hdab = node("hdab")

    def code_value(v: Column) -> list[Column]:
        n = node("code", F.coalesce(v["scheme"], F.lit("")), v["notation"], v["label"])
        return [
            blank(s, HEALTH + "hasCodeValues", n),
            type_of(n, SKOS + "Concept"),
            text(n, SKOS + "notation", v["notation"]),
            text(n, SKOS + "prefLabel", v["label"], "en"),
            link(n, SKOS + "inScheme", safe_uri(v["scheme"])),
        ]

    def other_identifier(v: Column) -> list[Column]:
        n = node("identifier", v)
        return [
            blank(s, ADMS + "identifier", n),
            type_of(n, ADMS + "Identifier"),
            typed(n, SKOS + "notation", v, "string"),
        ]

    def attribution(v: Column) -> list[Column]:
        n = node("attribution", v["name"], F.coalesce(v["role"], F.lit("")))
        agent = F.concat(n, F.lit("a"))
        return [
            blank(s, PROV + "qualifiedAttribution", n),
            type_of(n, PROV + "Attribution"),
            blank(n, PROV + "agent", agent),
            type_of(agent, FOAF + "Agent"),
            text(agent, FOAF + "name", v["name"]),
            link(n, DCAT + "hadRole", safe_uri(v["role"])),
        ]

    described = emit(
        records,
        [
            type_of(s, DCAT + "Dataset"),
            link(s, DCT + "isPartOf", F.col("catalog_uri")),
            *resource(s, DCT + "type", d["datasetType"]),
            *resource(s, DCAT + "theme", d["theme"]),
            text(s, DCT + "title", d["title"]),
            text(s, DCT + "description", d["description"]),
            text(s, DCT + "provenance", d["provenance"]),
            text(s, DCAT + "version", d["version"]),
            *resource(s, DCATAP + "applicableLegislation", d["applicableLegislation"], LEGAL_RESOURCE),
            *resource(s, DCT + "accessRights", d["accessRights"], DCT + "RightsStatement"),
            *resource(s, DCT + "accrualPeriodicity", d["frequency"], DCT + "Frequency"),
            typed(s, DCT + "identifier", identifier_uri(d["identifier"]), "anyURI"),
            *_period(
                s, DCT + "temporal", node("temporal"), F.col("start_date"), F.col("end_date")
            ),
            *_contact(s, node("contact"), d["contactPoint"]),
            *_labelled_concept(s, HEALTH + "healthCategory", d["healthCategory"]),
            *_labelled_concept(s, HEALTH + "healthTheme", d["healthTheme"]),
            typed(s, HEALTH + "populationCoverage", d["populationCoverage"], "string"),
            typed(s, HEALTH + "numberOfRecords", F.col("record_count"), "nonNegativeInteger"),
            typed(
                s, HEALTH + "numberOfUniqueIndividuals", F.col("unique_patients"),
                "nonNegativeInteger",
            ),
            typed(s, HEALTH + "minTypicalAge", F.col("min_age"), "nonNegativeInteger"),
            typed(s, HEALTH + "maxTypicalAge", F.col("max_age"), "nonNegativeInteger"),
            *_publisher(s, node("publisher"), d["publisher"], with_note=True),
            blank(s, HEALTH + "hdab", hdab),
            type_of(hdab, FOAF + "Agent"),
            text(hdab, FOAF + "name", d["hdab"]["name"]),
            typed(hdab, HEALTH + "trustedDataHolder", d["hdab"]["trusted"], "boolean"),
            link(hdab, DCT + "type", safe_uri(d["hdab"]["type"])),
            *_contact(hdab, F.concat(hdab, F.lit("c")), d["hdab"]["contactPoint"]),
            *resource(s, DCT + "conformsTo", d["conformsTo"], DCT + "Standard"),
            *resource(s, FOAF + "page", d["documentation"], FOAF + "Document"),
            *only_if(
                d["retentionPeriod"],
                blank(s, HEALTH + "retentionPeriod", node("retention")),
                type_of(node("retention"), DCT + "PeriodOfTime"),
                typed(
                    node("retention"), DCAT + "startDate",
                    date_guard(d["retentionPeriod"]["start"]), "date",
                ),
                typed(
                    node("retention"), DCAT + "endDate",
                    date_guard(d["retentionPeriod"]["end"]), "date",
                ),
            ),
            *resource(s, DCAT + "landingPage", d["landingPage"], FOAF + "Document"),
            *resource(s, DCT + "language", d["language"], DCT + "LinguisticSystem"),
            typed(s, DCT + "modified", date_guard(d["modificationDate"]), "date"),
            typed(s, DCT + "issued", date_guard(d["releaseDate"]), "date"),
            typed(s, DCAT + "spatialResolutionInMeters", d["spatialResolution"], "decimal"),
            typed(
                s, DCAT + "temporalResolution", duration_guard(d["temporalResolution"]), "duration"
            ),
            text(s, ADMS + "versionNotes", d["versionNotes"]),
            text(s, DPV + "hasPurpose", d["purpose"]),
            *_creator(s, node("creator"), d["creator"], with_email=True),
            *_nested_distribution(s, ADMS + "sample", node("sample"), d["sample"]),
            *_nested_distribution(s, DCT + "relation", node("analytics"), d["analytics"]),
        ],
        [
            each(d["keyword"], lambda v: [text(s, DCAT + "keyword", v)]),
            each(d["spatial"], lambda v: resource(s, DCT + "spatial", v, DCT + "Location")),
            each(d["alternative"], lambda v: [text(s, DCT + "alternative", v)]),
            each(d["codeValues"], code_value),
            each(d["personalData"], lambda v: resource(s, DPV + "hasPersonalData", v)),
            each(d["otherIdentifier"], other_identifier),
            each(d["qualifiedAttribution"], attribution),
            each(
                d["wasGeneratedBy"],
                lambda v: resource(s, PROV + "wasGeneratedBy", v, PROV + "Activity"),
            ),
        ],
    )
    configured = records
    parts = [described]
    predicate = HEALTH + "hasCodingSystem"
    if systems is not None:
        configured = records.join(systems.select("dataset_uri").distinct(), "dataset_uri", "left_anti")
        parts.append(emit(systems, resource(s, predicate, F.col("system"))))
    parts.append(
        emit(
            configured,
            [F.when(F.lit(False), link(s, predicate, s))],
            [each(d["codingSystems"], lambda v: resource(s, predicate, v))],
        )
    )
    return as_graph(*parts)
