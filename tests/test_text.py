"""Normalisation and n-grams against hand-derived vectors."""

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tessera.functions import text
from tessera.functions.ngrams import char_ngrams

NAMES = {
    "MS Consultancy Corp": "ms consultancy corporation",
    "3520 Main Road Realty Inc": "3520 main road realty incorporated",
    "DAVIS FAMILY OFFICE": "davis family office",
    "Acme LLC": "acme limited liability company",
    "Café ﬁn_1": "cafe fin_1",
    "राम": "",
    "": "",
    None: "",
    "a\x1cb\x0bc d": "a b c d",
}
ADDRESSES = {
    "88 OLIVE CIR, LEBANON, TN": "88 olive circle lebanon tn",
    "Shymala Appts 1St Floor Flat No. 4 Opp Ratna Hospital": "shymala appts 1st number 4 ratna hospital",
    "KH NO. -570/13, NEW DELHI": "kh number 570 13 new delhi",
    "2 Fl, Joe's": "2 joe south",
    "राम": "",
    None: "",
}


def column(spark, values, expression):
    rows = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, x string")
    return [r["y"] for r in rows.select("i", expression.alias("y")).orderBy("i").collect()]


def test_names_and_addresses(spark):
    assert column(spark, NAMES, text.normalize_name("x")) == list(NAMES.values())
    assert column(spark, ADDRESSES, text.normalize_address("x")) == list(ADDRESSES.values())


def test_a_text_is_normalised_once_in_a_batch(spark):
    assert text.normal_form("A-b\x1cInc_ Inc\x0bÉ", text.NAME_WORDS) == "a b inc_ incorporated e"
    assert text.normal_form("Fl. the St", text.ADDRESS_WORDS, frozenset(text.ADDRESS_DROPPED)) == "street"
    plan = spark.createDataFrame([("x",)], "x string").select(text.normalize_address("x"))._jdf.queryExecution().executedPlan().toString()
    assert "ArrowEvalPython" in plan and "regexp_replace" not in plan and "transform" not in plan


def test_tables_have_no_replacement_that_is_a_key():
    for table in (text.NAME_WORDS, text.ADDRESS_WORDS):
        assert all(w not in table or table[w] == w for v in table.values() for w in v.split())
    assert (len(text.NAME_WORDS), len(text.ADDRESS_WORDS), len(text.ADDRESS_DROPPED)) == (31, 36, 29)


def test_tokens_numbers_and_keys(spark):
    assert column(spark, ["a bc d ef", ""], text.long_tokens(F.col("x"))) == [["bc", "ef"], []]
    assert column(spark, ["12 main 5b 77 12", "x"], text.number_set(F.col("x"))) == [["12", "77"], []]
    assert column(spark, ["b a b", ""], text.token_set(F.col("x"))) == [["b", "a"], []]
    assert column(spark, ["US", " Us", None], text.country_key(F.col("x"))) == ["us", " us", ""]


def test_char_ngrams(spark):
    expected = [" a", "a ", " a ", " b", "bc", "c ", " bc", "bc "]
    found = column(spark, ["a bc", "", "a"], char_ngrams(F.col("x")))
    assert sorted(found[0]) == sorted(expected) and found[1] == [] and sorted(found[2]) == [" a", " a ", "a "]


def test_normalising_twice_keeps_columns_that_are_there(spark):
    rows = spark.createDataFrame([("S1-1", "Acme Inc", "1 St")], "entity_id string, business_name string, business_address string")
    once = text.with_normalized(rows)
    assert once.first()["norm_name"] == "acme incorporated"
    marked = once.withColumn("norm_name", F.lit("kept"))
    assert text.with_normalized(marked).first()["norm_name"] == "kept"
    assert text.with_normalized(marked, again=True).first()["norm_name"] == "acme incorporated"


@settings(max_examples=200, deadline=None)
@given(st.text())
def test_ascii_form_is_ascii_and_stable(value):
    once = text.ascii_form(value)
    assert once.isascii() and text.ascii_form(once) == once


@pytest.mark.parametrize("value", [None, "", "plain"])
def test_ascii_form_leaves_plain_text(value):
    assert text.ascii_form(value) == value
