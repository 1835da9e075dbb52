"""Text cleaning as Column expressions (no UDFs, all JVM-side)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Whitespace as the dictionary tools see it (Unicode spaces, byte
# order mark) and as the workbook reader sees it (everything up to U+0020).
UNICODE_SPACE = (
    "\t\n\x0b\f\r \u00a0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006"
    "\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000\ufeff"
)
CONTROL_SPACE = "".join(chr(i) for i in range(0x21))

# Truthy flags, characters illegal in URIs, term prefixes.
TRUTHY = ("yes", "y", "true", "1")
URI_ILLEGAL = '[<>"{}|\\\\^`]'
SLUG_ILLEGAL = '[<>"{}|\\\\^`#]'
PERSONAL_DATA_PREFIX = "https://w3c.github.io/dpv/2.0/pd#"
ROLE_PREFIX = "https://standards.iso.org/iso/19115/resources/Codelists/gml/CI_RoleCode.xml#"


def trim_whitespace(c: Column) -> Column:
    """Strip every kind of leading and trailing whitespace, not only spaces."""
    return F.btrim(c, F.lit(UNICODE_SPACE))


def trim_cell(c: Column) -> Column:
    """Strip leading and trailing characters up to U+0020 (workbook cells)."""
    return F.btrim(c, F.lit(CONTROL_SPACE))


def blank_to_null(c: Column) -> Column:
    return F.nullif(trim_cell(c), F.lit(""))


def strip_html(c: Column) -> Column:
    """Remove tags, then resolve four entities in this order, then trim.

    The order matters: ``&amp;`` is resolved before ``&lt;``, so ``&amp;lt;``
    ends up as ``<``.
    """
    text = F.regexp_replace(F.coalesce(c, F.lit("")), "<[^>]+>", "")
    for entity, char in (("&nbsp;", " "), ("&amp;", "&"), ("&lt;", "<"), ("&gt;", ">")):
        text = F.replace(text, F.lit(entity), F.lit(char))
    return trim_whitespace(text)


def sanitize_name(c: Column) -> Column:
    """Column name: lower case, runs of other characters to one underscore."""
    return F.btrim(F.regexp_replace(F.lower(c), "[^a-z0-9]+", "_"), F.lit("_"))


def safe_uri(c: Column) -> Column:
    """URI text: whitespace runs to ``%20``, illegal characters removed."""
    return F.regexp_replace(F.regexp_replace(trim_cell(c), "\\s+", "%20"), URI_ILLEGAL, "")


def concept_slug(c: Column) -> Column:
    return F.regexp_replace(F.regexp_replace(trim_cell(c), "\\s+", "_"), SLUG_ILLEGAL, "")


def identifier_uri(c: Column) -> Column:
    return F.regexp_replace(c, "\\s+", "")


def uri_label(c: Column) -> Column:
    """Last path segment with underscores as spaces.

    Empty segments at the end do not count: ``a/b/`` is labelled ``b``.
    """
    segments = F.split(F.regexp_replace(c, "/+\\z", ""), "/")
    return F.replace(F.element_at(segments, -1), F.lit("_"), F.lit(" "))


def date_guard(c: Column) -> Column:
    """The text if it is exactly ``YYYY-MM-DD``, otherwise null."""
    return F.when(F.regexp_like(c, F.lit("^\\d{4}-\\d{2}-\\d{2}\\z")), c)


def duration_guard(c: Column) -> Column:
    return F.when(F.startswith(c, F.lit("P")), c)


def hex_clean(c: Column) -> Column:
    """Hex digits only, cut to an even length; null when nothing is left."""
    digits = F.regexp_replace(c, "[^0-9a-fA-F]", "")
    even = F.substring(digits, F.lit(1), F.length(digits) - F.length(digits) % 2)
    return F.nullif(even, F.lit(""))


def truthy_flag(c: Column) -> Column:
    return F.lower(trim_cell(c)).isin(*TRUTHY)


def strict_boolean(c: Column) -> Column:
    """``true``/``false`` to boolean, blank to null; see ``strict_boolean_error``."""
    t = trim_cell(c)
    return F.when(t == "true", F.lit(True)).when(t == "false", F.lit(False))


def strict_boolean_error(c: Column, field: str) -> Column:
    """Message when the text is neither blank nor ``true``/``false``, else null."""
    t = trim_cell(c)
    bad = (t != "") & ~t.isin("true", "false")
    return F.when(
        bad, F.concat(F.lit("Incorrect value for boolean: "), c, F.lit(f" ({field})"))
    )


def comma_list(c: Column) -> Column:
    """Split at commas, trim the parts, drop the empty ones; null stays null."""
    return F.filter(F.transform(F.split(c, ","), trim_cell), lambda p: p != "")


def raw_comma_list(c: Column) -> Column:
    """Split at commas without trimming; only empty parts at the end are dropped."""
    return F.split(F.regexp_replace(c, ",+\\z", ""), ",")


def prefix_terms(terms: Column, prefix: str = PERSONAL_DATA_PREFIX) -> Column:
    return F.transform(terms, lambda t: F.concat(F.lit(prefix), t))


def code_value_zip(schemes: Column, notations: Column, labels: Column) -> Column:
    """Three parallel comma lists as ``array<struct<scheme,notation,label>>``.

    Lists of unequal length give null; entries need a notation and a label.
    """
    s, n, lab = (F.split(F.coalesce(c, F.lit("")), ",") for c in (schemes, notations, labels))
    zipped = F.transform(
        F.arrays_zip(s.alias("scheme"), n.alias("notation"), lab.alias("label")),
        lambda z: F.struct(
            blank_to_null(z["scheme"]).alias("scheme"),
            z["notation"].alias("notation"),
            z["label"].alias("label"),
        ),
    )
    kept = F.filter(zipped, lambda z: (z["notation"] != "") & (z["label"] != ""))
    return F.when((F.size(s) == F.size(n)) & (F.size(n) == F.size(lab)), kept)


def attribution_zip(names: Column, roles: Column) -> Column:
    """Two parallel comma lists as ``array<struct<name,role>>`` with prefixed roles."""
    n, r = (F.split(F.coalesce(c, F.lit("")), ",") for c in (names, roles))
    zipped = F.zip_with(
        n,
        r,
        lambda name, role: F.struct(
            name.alias("name"), F.concat(F.lit(ROLE_PREFIX), blank_to_null(role)).alias("role")
        ),
    )
    return F.when(F.size(n) == F.size(r), F.filter(zipped, lambda z: z["name"] != ""))


def int_from_text(c: Column) -> Column:
    """Number text truncated to int; out-of-range values stop at the int limits."""
    d = trim_cell(c).try_cast("double")
    bounded = F.least(F.greatest(d, F.lit(-2147483648.0)), F.lit(2147483647.0))
    return F.when(F.isnan(d), F.lit(0)).when(d.isNotNull(), bounded.cast("int"))


def form_fields(body: Column) -> Column:
    """``k=v&k=v`` as ``array<struct<key,value>>``, URL-decoded.

    A second ``=`` ends the value, a missing value is the empty string.
    """

    def field(pair: Column) -> Column:
        parts = F.split(pair, "=")
        return F.struct(
            F.try_url_decode(F.get(parts, F.lit(0))).alias("key"),
            F.try_url_decode(F.coalesce(F.get(parts, F.lit(1)), F.lit(""))).alias("value"),
        )

    return F.transform(F.split(body, "&"), field)


def form_value(fields: Column, key: str) -> Column:
    """Last value given for a key; blank counts as absent."""
    value = F.try_element_at(F.filter(fields, lambda f: f["key"] == key), F.lit(-1))["value"]
    return F.when(trim_cell(value) != "", value)


def form_flag(fields: Column, key: str) -> Column:
    """True for ``on``, false for anything else, null when the key is absent."""
    return F.try_element_at(F.filter(fields, lambda f: f["key"] == key), F.lit(-1))["value"] == "on"
