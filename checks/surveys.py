"""Queries and oracles: questionnaire responses, definitions, unified table, vocabularies."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks import fixtures as fx
from checks import sql
from checks.observations import YEAR, obs_long
from clinflat.functions.fhirpath import questionnaire_key
from clinflat.operators import full, stats, survey, vocab
from clinflat.session import stage


def _items(spark, d):
    return survey.response_items(fx.responses(spark, d)).withColumnRenamed("resource_id", "rid")


def _definitions(spark, d):
    """Written once: they are measured and joined, and finding them takes a pass over the responses."""
    return stage(survey.used_definitions(fx.responses(spark, d), fx.questionnaires(spark, d)), "definitions")


def qr_items(spark, d):
    return _items(spark, d).select("rid", "patient_uuid", "date", "question_id", "text_resp")


def qr_first_answer(spark, d):
    return _items(spark, d).drop("patient_uuid", "date", "questionnaire_ref", "text_resp")


def q_items(spark, d):
    return survey.definition_items(fx.questionnaires(spark, d)).select(
        F.col("questionnaire_id").alias("id"), "question_id", "text_def", "value_set_url"
    )


def q_option_rows(spark, d):
    rows = survey.option_rows(survey.definition_items(fx.questionnaires(spark, d)))
    return rows.select(
        F.col("questionnaire_id").alias("id"), "question_id", "pos", "opt_code", "opt_display"
    )


def q_definitions(spark, d):
    return _definitions(spark, d)


def questionnaire_keys(spark, d):
    refs = fx.responses(spark, d).select(F.get_json_object("json", "$.questionnaire").alias("ref"))
    return refs.select("ref", questionnaire_key(F.col("ref")).alias("q_id"))


def used_questionnaires(spark, d):
    refs = survey.questionnaire_refs(fx.responses(spark, d))
    return survey.used_questionnaires(fx.questionnaires(spark, d), refs).select("id")


def qr_option_join(spark, d):
    asked = survey.response_items(fx.responses(spark, d))
    return survey.join_options(asked, _definitions(spark, d)).select(
        F.col("resource_id").alias("rid"), "question_id", "val_code", "opt_display"
    )


def qr_text_join(spark, d):
    asked = survey.response_items(fx.responses(spark, d))
    return survey.join_texts(asked, _definitions(spark, d)).select(
        F.col("resource_id").alias("rid"), "question_id", "text_def", "text_resp"
    )


def qr_answer(spark, d):
    asked = survey.response_items(fx.responses(spark, d))
    joined = survey.join_options(asked, _definitions(spark, d))
    return joined.select(
        F.col("resource_id").alias("rid"), "question_id", survey.answer_text().alias("answer")
    )


def survey_long(spark, d):
    return survey.long_surveys(
        fx.responses(spark, d), fx.questionnaires(spark, d), fx.patients(spark, d)
    )


def survey_long_salted(spark, d):
    """The same table with the joins used when neither lookup may be broadcast."""
    return survey.resolve_answers(
        survey.response_items(fx.responses(spark, d)), _definitions(spark, d),
        survey.patient_id_map(fx.patients(spark, d)), 0,
    )


def full_long(spark, d):
    return full.long_full(obs_long(spark, d), survey_long(spark, d))


def temporal_coverage_full(spark, d):
    return stats.row_coverage(full_long(spark, d))


def survey_stats(spark, d):
    coverage = stats.temporal_coverage(fx.responses(spark, d), "QuestionnaireResponse")
    return stats.dataset_stats(survey_long(spark, d), fx.patients(spark, d), coverage, YEAR)


def vocab_question(spark, d):
    return vocab.code_vocabulary(survey_long(spark, d), "question_codes")


def vocab_options(spark, d):
    return vocab.option_vocabularies(_definitions(spark, d))


def vocab_merged(spark, d):
    rows, definitions = survey.extract(
        fx.responses(spark, d), fx.questionnaires(spark, d), fx.patients(spark, d)
    )
    return vocab.merge_vocabularies(
        vocab.option_vocabularies(definitions),
        vocab.code_vocabulary(obs_long(spark, d), "observation_codes"),
        vocab.code_vocabulary(rows, "question_codes"),
    )


def column_links(spark, d):
    return vocab.column_links(vocab_merged(spark, d))


QUERIES = {
    "qr_items": qr_items,
    "qr_first_answer": qr_first_answer,
    "q_items": q_items,
    "q_option_rows": q_option_rows,
    "q_definitions": q_definitions,
    "questionnaire_key": questionnaire_keys,
    "used_questionnaires": used_questionnaires,
    "qr_option_join": qr_option_join,
    "qr_text_join": qr_text_join,
    "qr_answer": qr_answer,
    "survey_long": survey_long,
    "survey_long_salted": survey_long_salted,
    "full_long": full_long,
    "temporal_coverage_full": temporal_coverage_full,
    "survey_stats": survey_stats,
    "vocab_question": vocab_question,
    "vocab_options": vocab_options,
    "vocab_merged": vocab_merged,
    "column_vocab_links": column_links,
}

_ITEMS = sql.with_(sql.ORD, sql.ITEMS)
_DEFS = sql.with_(sql.ORD, sql.QUESTIONS)
_BOTH = sql.with_(sql.ORD, sql.ITEMS, sql.QUESTIONS)
_SURVEY = sql.with_(*sql.SURVEYED)
_VOCABS = sql.with_(
    *sql.EVERYTHING, sql.VOCAB_OBS, sql.VOCAB_Q, sql.VOCAB_OPT, sql.VOCAB_ALL
)
_LONG = "SELECT pid, code, display, answer, date FROM survey_long"

ORACLES = {
    "qr_items": _ITEMS + "SELECT rid, patient_uuid, date, question_id, text_resp FROM items",
    "qr_first_answer": _ITEMS
    + "SELECT * EXCLUDE (patient_uuid, date, ref, text_resp) FROM items",
    "q_items": _DEFS + "SELECT id, question_id, text_def, value_set_url FROM all_q",
    "q_option_rows": _DEFS + "SELECT id, question_id, pos, opt_code, opt_display FROM q_options",
    "q_definitions": _DEFS + "SELECT * FROM defs",
    "questionnaire_key": sql.with_(sql.ORD)
    + """SELECT ref, split_part(ref, '/', -1) AS q_id
        FROM (SELECT ref FROM ord UNION ALL SELECT ref FROM lin)""",
    "used_questionnaires": _DEFS
    + "SELECT DISTINCT id FROM all_q WHERE id IN (SELECT id FROM used_q)",
    "qr_option_join": _BOTH
    + f"""SELECT rid, i.question_id, i.val_code, opt_display FROM items i {sql.JOIN_OPTIONS}""",
    "qr_text_join": _BOTH
    + f"""SELECT rid, i.question_id, text_def, text_resp FROM items i {sql.JOIN_TEXTS}""",
    "qr_answer": _BOTH
    + f"""SELECT rid, i.question_id, {sql.ANSWER} AS answer FROM items i {sql.JOIN_OPTIONS}""",
    "survey_long": _SURVEY + _LONG,
    "survey_long_salted": _SURVEY + _LONG,
    "full_long": sql.with_(*sql.EVERYTHING) + "SELECT * FROM full_long",
    "temporal_coverage_full": sql.with_(*sql.EVERYTHING)
    + "SELECT min(left(date, 10)) AS start_date, max(left(date, 10)) AS end_date FROM full_long",
    "survey_stats": _SURVEY
    + f"""SELECT (SELECT count(*) FROM survey_long) AS record_count,
          (SELECT count(DISTINCT pid) FROM survey_long) AS unique_patients,
          (SELECT min({YEAR} - birth_year)::INT FROM pat) AS min_age,
          (SELECT max({YEAR} - birth_year)::INT FROM pat) AS max_age,
          (SELECT min(left(date, 10)) FROM (SELECT date FROM ord UNION ALL SELECT date FROM lin))
            AS start_date,
          (SELECT max(left(date, 10)) FROM (SELECT date FROM ord UNION ALL SELECT date FROM lin))
            AS end_date""",
    "vocab_question": sql.with_(*sql.SURVEYED, sql.VOCAB_Q) + "SELECT * FROM vocab_q",
    "vocab_options": sql.with_(sql.ORD, sql.QUESTIONS, sql.VOCAB_OPT) + "SELECT * FROM vocab_opt",
    "vocab_merged": _VOCABS + "SELECT * FROM vocab_all",
    "column_vocab_links": _VOCABS
    + """SELECT unnest(['code', 'display']) AS name,
          CASE WHEN bool_or(vocab_id = 'observation_codes') THEN 'observation_codes'
               ELSE 'question_codes' END AS vocab_id FROM vocab_all""",
}
