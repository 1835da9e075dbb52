"""Questionnaire responses to long rows ``pid, code, display, answer, date``."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clinflat import schemas
from clinflat.functions.fhirpath import (
    exact_json,
    nested_items,
    parse_once,
    questionnaire_key,
    reference_key,
    unnest,
)
from clinflat.operators.joins import left_lookup
from clinflat.operators.observation import patient_id_map, resolve_patient
from clinflat.session import BROADCAST_BYTES, stage
from clinflat.sources.resources import of_type

SURVEY_COLUMNS = ("pid", "code", "display", "answer", "date")


_RESPONSE_FIELDS = {
    "question_id": "i.linkId",
    "text_resp": "i.text",
    "val_code": "get(i.answer, 0).valueCoding.code",
    "val_disp_resp": "get(i.answer, 0).valueCoding.display",
    "val_string": "get(i.answer, 0).valueString",
    "val_integer": "get(i.answer, 0).valueInteger",
    "val_decimal": "get(i.answer, 0).valueDecimal",
    "val_boolean": "get(i.answer, 0).valueBoolean",
    "val_date": "get(i.answer, 0).valueDate",
    "val_datetime": "get(i.answer, 0).valueDateTime",
    "val_time": "get(i.answer, 0).valueTime",
    "val_uri": "get(i.answer, 0).valueUri",
    "val_qty": "get(i.answer, 0).valueQuantity.value",
    "val_qty_unit": "get(i.answer, 0).valueQuantity.unit",
}

_DEFINITION_FIELDS = {
    "question_id": "i.linkId",
    "text_def": "i.text",
    "value_set_url": "i.answerValueSet",
    "opt_codes": "i.answerOption.valueCoding.code",
    "opt_disps": "i.answerOption.valueCoding.display",
}
_DEFINITION_TYPES = {"opt_codes": "array<string>", "opt_disps": "array<string>"}


# Levels below the top one that are parsed together with the resource. The schema
# doubles with each, so deeper nesting is left to the slower text form.
TYPED_LEVELS = 3


def response_items(responses: DataFrame) -> DataFrame:
    """One row per item at any depth, with the first answer's fields.

    Items are followed through ``item`` and through ``answer.item``; the fields of
    the response are repeated on each row.
    """
    items = nested_items(
        "r.item", _RESPONSE_FIELDS, True, TYPED_LEVELS, schemas.response_item(0)
    )
    schema = schemas.questionnaire_response(TYPED_LEVELS)
    # Parsing and flattening are one expression: the parsed tree is never written
    # out as a row, only the flat items are.
    flat = F.expr(
        f"""transform(array(from_json({exact_json(responses)}, '{schema}')), r -> named_struct(
            'reference', r.subject.reference, 'date', r.authored,
            'questionnaire_ref', r.questionnaire, 'items', {items}))"""
    )
    head = ("resource_id", "patient_uuid", "date", "questionnaire_ref")
    rows = unnest(of_type(responses, schemas.RESPONSE_TYPE), flat, "r", "id").select(
        F.col("id").alias("resource_id"),
        reference_key(F.col("r.reference")).alias("patient_uuid"),
        F.col("r.date").alias("date"),
        F.col("r.questionnaire_ref").alias("questionnaire_ref"),
        F.col("r.items").alias("items"),
    )
    return unnest(rows, F.col("items"), "i", *head).select(*head, "i.*")


def questionnaire_refs(responses: DataFrame) -> DataFrame:
    """Distinct questionnaire keys of the responses that have items."""
    rows = of_type(responses, schemas.RESPONSE_TYPE)
    if "questionnaire_id" in rows.columns:
        keys = rows.select(F.col("questionnaire_id").alias("q_id"))
    else:
        head = "struct<questionnaire:string,item:array<struct<linkId:string>>>"
        keys = (
            parse_once(rows, head, "h")
            .where(F.size("h.item") > 0)
            .select(questionnaire_key(F.col("h.questionnaire")).alias("q_id"))
        )
    return keys.where(F.col("q_id").isNotNull()).distinct()


def used_questionnaires(questionnaires: DataFrame, refs: DataFrame) -> DataFrame:
    """Definitions that at least one response refers to."""
    definitions = of_type(questionnaires, schemas.QUESTIONNAIRE_TYPE)
    return definitions.join(refs, definitions["id"] == refs["q_id"], "left_semi")


def definition_items(questionnaires: DataFrame) -> DataFrame:
    """One row per defined item at any depth with its answer options."""
    items = nested_items(
        "r.item", _DEFINITION_FIELDS, False, TYPED_LEVELS, schemas.questionnaire_item(0),
        _DEFINITION_TYPES,
    )
    schema = schemas.questionnaire(TYPED_LEVELS)
    flat = F.expr(f"transform(array(from_json(json, '{schema}')), r -> {items})")
    resources = of_type(questionnaires, schemas.QUESTIONNAIRE_TYPE)
    rows = unnest(resources, flat, "items", F.col("id").alias("questionnaire_id"))
    return unnest(rows, F.col("items"), "i", "questionnaire_id").select("questionnaire_id", "i.*")


def option_rows(items: DataFrame) -> DataFrame:
    """One row per answer option; items without options keep one row of nulls.

    A display list shorter than the code list gives null displays.
    """
    return items.select(
        "questionnaire_id", "question_id", "text_def", "value_set_url", "opt_disps",
        F.posexplode_outer("opt_codes").alias("pos", "opt_code"),
    ).select(
        "questionnaire_id", "question_id", "text_def", "value_set_url", "pos", "opt_code",
        F.get("opt_disps", F.col("pos")).alias("opt_display"),
    )


def flat_definitions(questionnaires: DataFrame) -> DataFrame:
    """Distinct item and option rows, each with its questionnaire."""
    columns = ("question_id", "text_def", "value_set_url", "opt_code", "opt_display")
    return (
        option_rows(definition_items(questionnaires)).select("questionnaire_id", *columns).distinct()
    )


def used_definitions(responses: DataFrame, questionnaires: DataFrame) -> DataFrame:
    """Distinct item and option rows of the questionnaires some response refers to."""
    return flat_definitions(used_questionnaires(questionnaires, questionnaire_refs(responses)))


def option_displays(definitions: DataFrame) -> DataFrame:
    """One display per questionnaire, question and code: the first in the alphabet."""
    return (
        definitions.where(F.col("opt_code").isNotNull())
        .groupBy("questionnaire_id", "question_id", F.col("opt_code").alias("val_code"))
        .agg(F.min("opt_display").alias("opt_display"))
    )


def question_texts(definitions: DataFrame) -> DataFrame:
    """One text per questionnaire and question: the first in the alphabet."""
    return (
        definitions.where(F.col("text_def").isNotNull())
        .groupBy("questionnaire_id", "question_id")
        .agg(F.min("text_def").alias("text_def"))
    )


def given_answer() -> Column:
    """What the response itself says: coded display, primitive, quantity, raw code."""
    quantity = F.coalesce(
        F.concat("val_qty", F.lit(" "), "val_qty_unit"), F.col("val_qty")
    )
    return F.coalesce(
        "val_disp_resp",
        "val_string", "val_integer", "val_decimal", "val_boolean",
        "val_date", "val_datetime", "val_time", "val_uri",
        quantity, "val_code",
    )


def answer_text() -> Column:
    """Coded display (definition, then response), primitive, quantity, raw code."""
    return F.coalesce(F.col("opt_display"), given_answer())


def _of_questionnaire(items: DataFrame) -> DataFrame:
    return items.withColumn("questionnaire_id", questionnaire_key(F.col("questionnaire_ref")))


def join_options(
    items: DataFrame, definitions: DataFrame, limit: int = BROADCAST_BYTES
) -> DataFrame:
    """Add the option display that the response's own questionnaire gives for the code.

    Few items have a code; the others need no lookup.
    """
    on = ["questionnaire_id", "question_id", "val_code"]
    displays = option_displays(definitions)
    return left_lookup(_of_questionnaire(items), displays, on, limit, few_keyed=True)


def join_texts(
    items: DataFrame, definitions: DataFrame, limit: int = BROADCAST_BYTES
) -> DataFrame:
    """Add the question text from the response's own questionnaire. Link ids repeat from
    one questionnaire to the next, so an item is never matched with another's."""
    joined = _join_questions(items, question_texts(definitions), limit)
    return joined.withColumn("text_def", F.col("of.text_def")).drop("of")


def _by_questionnaire(questions: DataFrame) -> DataFrame:
    """One row per questionnaire: ``questions``, a map from the question to its other columns."""
    others = [c for c in questions.columns if c not in ("questionnaire_id", "question_id")]
    entry = F.struct("question_id", F.struct(*others).alias("of"))
    return (
        questions.where(F.col("question_id").isNotNull())
        .groupBy("questionnaire_id")
        .agg(F.map_from_entries(F.collect_list(entry)).alias("questions"))
    )


def _join_questions(items: DataFrame, questions: DataFrame, limit: int) -> DataFrame:
    """Add ``of``: what ``questions`` has of the item's question in its own questionnaire.

    The join is by questionnaire, whose row is no larger than its resource: the items of a
    response stay side by side, which takes half the bytes when they are written.
    """
    lookup = _by_questionnaire(questions)
    joined = left_lookup(_of_questionnaire(items), lookup, ["questionnaire_id"], limit)
    return joined.withColumn("of", F.element_at("questions", F.col("question_id"))).drop("questions")


def join_definitions(
    items: DataFrame, definitions: DataFrame, limit: int = BROADCAST_BYTES
) -> DataFrame:
    """Add ``opt_display`` of ``join_options`` and ``text_def`` of ``join_texts``, in one join."""
    on = ["questionnaire_id", "question_id"]
    option = F.struct("val_code", "opt_display")
    options = (
        option_displays(definitions)
        .where(F.col("opt_display").isNotNull())
        .groupBy(*on)
        .agg(F.map_from_entries(F.collect_list(option)).alias("options"))
    )
    questions = question_texts(definitions).join(options, on, "full")
    return (
        _join_questions(items, questions, limit)
        .withColumn("opt_display", F.element_at("of.options", F.col("val_code")))
        .withColumn("text_def", F.col("of.text_def"))
        .drop("of")
    )


def resolve_answers(
    items: DataFrame,
    definitions: DataFrame,
    id_map: DataFrame,
    limit: int = BROADCAST_BYTES,
) -> DataFrame:
    """Items with codes resolved to ``pid, code, display, answer, date``.

    One row per answered item that has a link id and a text; the response's own text and
    display count where its reference names no definition at hand. An item with a code has
    an answer, so the answers are put together, and items without one left out, before the join.
    """
    given = F.array(given_answer())
    answered = unnest(
        items.where(F.col("question_id").isNotNull()), given, "given",
        "patient_uuid", "date", "questionnaire_ref", "question_id", "text_resp", "val_code",
    )
    resolved = (
        join_definitions(answered, definitions, limit)
        .withColumn("answer", F.coalesce("opt_display", "given"))
        .withColumn("display", F.coalesce("text_def", "text_resp"))
        .where(F.col("display").isNotNull())
        .select("patient_uuid", F.col("question_id").alias("code"), "display", "answer", "date")
    )
    return resolve_patient(resolved, id_map, limit).select(*SURVEY_COLUMNS)


def extract(
    responses: DataFrame,
    questionnaires: DataFrame,
    patients: DataFrame,
    limit: int = BROADCAST_BYTES,
) -> tuple[DataFrame, DataFrame]:
    """The long survey table and the definitions it was resolved with.

    The definitions in use are written once: they are joined twice and give the
    option vocabularies, and finding them takes a pass over the responses that
    should not be repeated.
    """
    definitions = stage(used_definitions(responses, questionnaires), "definitions")
    rows = resolve_answers(
        response_items(responses), definitions, patient_id_map(patients), limit
    )
    return rows, definitions


def long_surveys(
    responses: DataFrame,
    questionnaires: DataFrame,
    patients: DataFrame,
    limit: int = BROADCAST_BYTES,
) -> DataFrame:
    """The long survey table."""
    return extract(responses, questionnaires, patients, limit)[0]
