"""Word, amount and padding rules."""

import math

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tillwatch.functions.text import WHITESPACE, amount_text, amount_value, strip_dots, words, zero_pad


def evaluate(spark, values, function):
    rows = spark.createDataFrame(list(enumerate(values)), "i int, v string").select("i", function(F.col("v")).alias("r"))
    return [row.r for row in sorted(rows.collect())]


@pytest.mark.parametrize(
    ("message", "expected"),
    [
        ("one two three", ["one", "two", "three"]),
        (" one two ", ["one", "two"]),
        ("one  two", ["one", "two"]),
        ("one\ttwo\nthree\n", ["one", "two", "three"]),
        ("one\x1ctwo\x85three\xa0four five　", ["one", "two", "three", "four", "five"]),
        ("zero​width stays", ["zero​width", "stays"]),
        ("tab at end\t", ["tab", "at", "end"]),
        ("line at end\n", ["line", "at", "end"]),
        ("café olé", ["café", "olé"]),
        ("del\x7fstays", ["del\x7fstays"]),
        (None, None),
    ],
)
def test_words(spark, message, expected):
    assert evaluate(spark, [message], words) == [expected]


def test_whitespace_is_what_python_calls_space():
    assert set(WHITESPACE) == {chr(code) for code in range(0x110000) if chr(code).isspace()}


def test_every_character_separates_or_not_as_it_should(spark):
    characters = [chr(code) for code in range(0x20000) if not 0xD800 <= code < 0xE000]
    split = evaluate(spark, [f"a{char}b" for char in characters], words)
    assert [parts == ["a", "b"] for parts in split] == [char.isspace() for char in characters]
    ends = evaluate(spark, [f"{char}a{char}" for char in characters], words)
    assert [parts == ["a"] for parts in ends] == [char.isspace() or char == "" for char in characters]


word = st.text(st.characters(exclude_characters=WHITESPACE, exclude_categories=["Cs"]), min_size=1, max_size=6)
gap = st.text(st.sampled_from(WHITESPACE), min_size=1, max_size=3)


@settings(max_examples=8, deadline=None)
@given(st.lists(st.tuples(st.lists(st.tuples(gap, word), min_size=1, max_size=8), gap), min_size=40, max_size=80))
def test_words_come_back_from_any_spacing(spark, drawn):
    messages = ["".join(space + text for space, text in parts) + end for parts, end in drawn]
    assert evaluate(spark, messages, words) == [[text for _, text in parts] for parts, _ in drawn]


@pytest.mark.parametrize(
    ("text", "expected"),
    [
        ("$824.23.", 824.23),
        ("$$5..", 5.0),
        ("12", 12.0),
        ("$-3.5", -3.5),
        ("+.5", 0.5),
        ("1e3", 1000.0),
        ("1_000.25", 1000.25),
        ("$1e400", math.inf),
        ("inf", math.inf),
        ("-Infinity", -math.inf),
        ("1.0d", None),
        ("1.0f", None),
        ("0x10", None),
        ("1,000.00", None),
        ("1__0", None),
        ("_1", None),
        ("$x.", None),
        ("$", None),
        ("", None),
        ("5$", None),
        (None, None),
    ],
)
def test_amounts(spark, text, expected):
    assert evaluate(spark, [text], lambda column: amount_value(amount_text(column))) == [expected]


@pytest.mark.parametrize("text", ["nan", "$NaN.", "+nan", "-nan"])
def test_amount_that_is_not_a_number_by_name(spark, text):
    (value,) = evaluate(spark, [text], lambda column: amount_value(amount_text(column)))
    assert math.isnan(value)


def test_strip_dots_takes_all_trailing_dots_only(spark):
    assert evaluate(spark, ["a.b...", "...", "a", "", None], strip_dots) == ["a.b", "", "a", "", None]


def test_zero_pad_never_cuts(spark):
    numbers = evaluate(spark, ["7", "123456", "1234567"], lambda column: zero_pad(column.cast("bigint"), 6))
    assert numbers == ["000007", "123456", "1234567"]
