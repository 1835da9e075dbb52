"""Path helpers over parsed resources."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed value: how a reference names a patient (relative, absolute or versioned).
PATIENT_REFERENCE = "(?:^|/)Patient/([A-Za-z0-9.-]{1,64})(?:/_history/.*)?$"

# The number of a value as text, digit for digit: parsing would round it. An escaped quote
# inside a text can't end a key, so texts are left alone.
NUMBERS_AS_TEXT = (
    r"""regexp_replace(json, '("value(?:Integer|Decimal)?"[ \\t\\r\\n]*:[ \\t\\r\\n]*)(-?[0-9][-+.0-9eE]*)', """
    r"""'$1"$2"')"""
)

# A value's number that parsing may write differently: all but plain integers and
# fractions of at most 15 digits without an exponent or closing zeros.
CHANGED_NUMBER = (
    r'"value(?:Integer|Decimal)?"\s*:\s*(?=[-0-9])(?!(?:0|-?[1-9][0-9]{0,17}'
    r"|-?[1-9][0-9]{0,6}\.(?:0|[0-9]{0,7}[1-9])|-?0\.0{0,2}[1-9](?:[0-9]{0,9}[1-9])?)[\s,}])"
)


def numbers_kept(json: Column) -> Column:
    """Whether parsing the text keeps every value's number digit for digit."""
    return ~F.rlike(json, F.lit(CHANGED_NUMBER))


def exact_json(df: DataFrame) -> str:
    """SQL for the JSON text to parse values from, so that their numbers keep all digits.

    The lake knows for each resource whether that takes any change (``numbers_kept``);
    elsewhere the text is asked first, which costs less than rewriting it.
    """
    if "numbers_kept" not in df.columns:
        changed = CHANGED_NUMBER.replace("\\", "\\\\")
        return f"IF(rlike(json, '{changed}'), {NUMBERS_AS_TEXT}, json)"
    return f"IF(coalesce(numbers_kept, false), json, {NUMBERS_AS_TEXT})"


def reference_key(ref: Column) -> Column:
    """Patient id of a reference; null when the target is not a patient."""
    return F.nullif(F.regexp_extract(ref, PATIENT_REFERENCE, 1), F.lit(""))


def first_coding(coding: Column, field: str) -> Column:
    """First non-null value of one field over all codings.

    Code and display are looked up separately, so they may come from two codings.
    """
    values = F.filter(F.transform(coding, lambda c: c[field]), lambda v: v.isNotNull())
    return F.get(values, F.lit(0))


def questionnaire_key(ref: Column) -> Column:
    """Last path segment; a ``|version`` suffix stays and then matches no id."""
    return F.element_at(F.split(ref, "/"), -1)


def with_unit(value: Column, unit: Column) -> Column:
    return F.when(unit.isNotNull(), F.concat(value, F.lit(" "), unit)).otherwise(value)


def unnest(df: DataFrame, array: Column, name: str, *keep: str | Column) -> DataFrame:
    """One row per non-null array element, as column ``name`` beside ``keep``.

    The plain ``explode`` makes the optimizer infer a filter on the array and push
    it below, where the whole expression that builds the array is evaluated a
    second time. Here the array is built once and nulls are dropped after it.
    """
    return df.select(*keep, F.explode_outer(array).alias(name)).where(F.col(name).isNotNull())


def parse_once(
    df: DataFrame, schema: str, name: str, *keep: str, json: str | Column = "json"
) -> DataFrame:
    """Parse a JSON column into ``name``, dropping rows where it is null.

    Filters on parsed fields stay above the parsing instead of repeating it.
    """
    return unnest(df, F.array(F.from_json(json, schema)), name, *keep)


def nested_items(
    items: str,
    fields: dict[str, str],
    through_answers: bool,
    typed_levels: int,
    text_schema: str,
    types: dict[str, str] | None = None,
) -> str:
    """SQL expression for the items of every nesting level, as one array of structs.

    ``items`` names an array of item structs with ``typed_levels`` typed levels
    below it, all from one parse of the resource. ``fields`` says what to keep of
    an item ``i`` (name to SQL expression, text unless ``types`` says otherwise).
    Items below the typed levels are JSON texts; those are parsed level by level
    with ``text_schema``, and only where a resource nests that deep. Each level is
    bound to a variable, so none is computed twice; the whole is one narrow
    expression without a shuffle. There is no limit of depth: a text has at most one
    level more than the key ``item`` stands in it, and that many steps are taken.
    """
    types = types or {}
    row_type = ",".join(f"{name}:{types.get(name, 'string')}" for name in fields)
    row = "named_struct(" + ", ".join(f"'{name}', {expr}" for name, expr in fields.items()) + ")"
    children = "coalesce(i.item, array())"
    if through_answers:
        # The two usual shapes first; only an item with several places for children
        # needs them put together.
        children = """coalesce(
            if(i.answer is null, i.item,
               if(i.item is null and size(i.answer) = 1, i.answer[0].item,
                  flatten(filter(concat(array(i.item), i.answer.item), c -> c is not null)))),
            array())"""
    levels = """1 + aggregate(texts, 0, (n, j) ->
        n + cast((length(j) - length(replace(j, '"item"', ''))) / 6 as int))"""
    deeper = f"""aggregate(
        sequence(1, {levels}),
        named_struct('rows', cast(array() as array<struct<{row_type}>>), 'texts', texts),
        (acc, depth) -> if(size(acc.texts) = 0, acc, transform(
            array(transform(acc.texts, j -> from_json(j, '{text_schema}'))),
            level -> named_struct(
                'rows', concat(acc.rows, transform(level, i -> {row})),
                'texts', flatten(transform(level, i -> {children}))))[0]),
        acc -> acc.rows)"""

    def level(depth: int, this: str) -> str:
        last = depth == typed_levels
        under = "texts" if last else f"level{depth + 1}"
        rows = f"transform({this}, i -> {row})"
        rest = deeper if last else level(depth + 1, under)
        return f"""transform(
            array(flatten(transform({this}, i -> {children}))),
            {under} -> if(size({under}) = 0, {rows}, concat({rows}, {rest})))[0]"""

    return f"transform(array({items}), level0 -> {level(0, 'level0')})[0]"
