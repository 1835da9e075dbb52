"""Answers are looked up with few joins, and no query finds the definitions in use twice."""

import pytest

import __spark_entry__ as contract
from test_shapes import SF, plan

# Left joins of each query: by questionnaire, and by patient where the patient counts.
LEFT_JOINS = {
    "column_vocab_links": 1,
    "survey_stats": 2,
    "qr_answer": 1,
    "qr_text_join": 1,
    "vocab_merged": 1,
    "survey_long": 2,
    "full_long": 3,
    "temporal_coverage_full": 3,
    "vocab_question": 1,
    "skos_triples": 1,
    "qr_option_join": 1,
}


@pytest.mark.parametrize("name", LEFT_JOINS)
def test_few_lookups(spark, name):
    text = plan(contract.queries()[name](spark, SF))
    assert text.count("LeftOuter") == LEFT_JOINS[name] and "LeftSemi" not in text
