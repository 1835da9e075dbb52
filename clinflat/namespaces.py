"""Vocabulary terms of the metadata triples."""

# Namespaces.
RDF = "http://www.w3.org/1999/02/22-rdf-syntax-ns#"
XSD = "http://www.w3.org/2001/XMLSchema#"
DCAT = "http://www.w3.org/ns/dcat#"
DCT = "http://purl.org/dc/terms/"
FOAF = "http://xmlns.com/foaf/0.1/"
SKOS = "http://www.w3.org/2004/02/skos/core#"
VCARD = "http://www.w3.org/2006/vcard/ns#"
ADMS = "http://www.w3.org/ns/adms#"
CSVW = "http://www.w3.org/ns/csvw#"
DCATAP = "http://data.europa.eu/r5r/"
DPV = "https://w3id.org/dpv#"
HEALTH = "http://healthdataportal.eu/ns/health#"
PROV = "http://www.w3.org/ns/prov#"
ELI = "http://data.europa.eu/eli/ontology#"
SPDX = "http://spdx.org/rdf/terms#"
QUDT = "http://qudt.org/schema/qudt/"
COHORT = "http://example.org/cohort#"

# Single terms and base addresses.
RDF_TYPE = RDF + "type"
MEDIA_TYPE_EXTENT = DCT + "MediaTypeOrExtent"
MEDIA_TYPE = DCT + "MediaType"
LEGAL_RESOURCE = ELI + "LegalResource"
VOCABULARY_BASE = "http://example.org/vocab"
RESPONSIBLE_ROLE = "http://example.org/cohort/role/responsible"
DATASET_FILE = "file:///dataset.csv"

# Vocabulary ids of the long tables.
OBSERVATION_CODES = "observation_codes"
QUESTION_CODES = "question_codes"
