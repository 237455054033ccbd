import datetime as dt

import pytest
from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F, types as T

from ledgerloom.functions import business, mapping, parsing, text


def values(spark, column, inputs, schema="x string"):
    rows = [(v,) if not isinstance(v, tuple) else v for v in inputs]
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], f"i int, {schema}")
    return [r[0] for r in df.orderBy("i").select(column).collect()]


def x():
    return F.col("x")


@pytest.mark.parametrize(
    "given_text, number",
    [
        ("12", 12.0), (" 12.50\t", 12.5), ("+.5e-3", 0.0005), ("1.", 1.0), ("-7", -7.0), ("1E5", 100000.0),
        ("12d", None), ("5f", None), ("0x1F", None), ("0x1p3", None), ("1,000", None), ("", None), (".", None),
        ("n/a", None), (None, None), ("nan", None), ("1_000", None), ("--5", None), ("5e", None),
        ("1e400", None), ("9" * 310, None), ("1e308", 1e308), ("9" * 250, float("9" * 250)),
        ("inf", float("inf")), ("-Infinity", float("-inf")), ("٣", None),
    ],
)
def test_number_from_text(spark, given_text, number):
    assert values(spark, parsing.to_number(x()), [given_text]) == [number]


def test_boolean_from_text(spark):
    given_texts = ["True", "FALSE", "1", "0", "FALSE ", "yes", "t", "", None, "nan"]
    assert values(spark, parsing.to_boolean(x()), given_texts) == [
        True, False, True, False, False, None, None, None, None, None,
    ]


def test_timestamps_without_format(spark):
    got = values(
        spark,
        parsing.to_timestamp(x()),
        ["2023-01-15", " 2023-01-15 10:30:00 ", "2023-01-15T10:30:00.5", "2023", "10:30:00", "10:3", "bad", "", None, "2023-13-01"],
    )
    assert got == [
        dt.datetime(2023, 1, 15), dt.datetime(2023, 1, 15, 10, 30), dt.datetime(2023, 1, 15, 10, 30, 0, 500000),
        dt.datetime(2023, 1, 1), None, None, None, None, None, None,
    ]


@pytest.mark.parametrize(
    "pattern, given_text, stamp",
    [
        ("%Y-%m-%d", "2021-01-10", dt.datetime(2021, 1, 10)),
        ("%Y-%m-%d", "2021-1-3", dt.datetime(2021, 1, 3)),
        ("%d/%m/%Y %H:%M:%S", "10/01/2021 05:06:07", dt.datetime(2021, 1, 10, 5, 6, 7)),
        ("%Y-%m-%dT%H:%M:%S.%f", "2021-01-10T05:06:07.123456", dt.datetime(2021, 1, 10, 5, 6, 7, 123456)),
        ("%d %b %Y", "10 Jan 2021", dt.datetime(2021, 1, 10)),
        ("%I:%M %p on %Y-%m-%d", "05:06 PM on 2021-01-10", dt.datetime(2021, 1, 10, 17, 6)),
        ("%Y%m%d%H%M%S", "20210110050607", dt.datetime(2021, 1, 10, 5, 6, 7)),
        ("%Y-%m-%d", "10.01.2021", None),
    ],
)
def test_timestamps_with_format(spark, pattern, given_text, stamp):
    assert values(spark, parsing.to_timestamp(x(), pattern), [given_text]) == [stamp]


def test_several_formats_are_tried_in_turn(spark):
    got = values(spark, parsing.to_timestamp(x(), ["%Y-%m-%d", "%d.%m.%Y"]), ["2021-01-10", "11.01.2021", "x"])
    assert got == [dt.datetime(2021, 1, 10), dt.datetime(2021, 1, 11), None]


def test_unknown_directive_is_refused():
    with pytest.raises(ValueError):
        parsing.java_pattern("%Y %Q")


def test_date_and_time_join_and_bad_parts_are_null(spark):
    c = parsing.combine_timestamp(F.col("d"), F.col("t"))
    got = values(
        spark, c, [("2023-01-15", "10:30:00"), ("2023-01-15", None), (None, "10:30:00"), ("x", "10:30:00")],
        "d string, t string",
    )
    assert got == [dt.datetime(2023, 1, 15, 10, 30), None, None, None]


def test_conversions_between_types(spark):
    df = spark.createDataFrame(
        [("12", 10.5, 1, True), ("10.5", float("nan"), 0, False), ("x", None, None, None)],
        "s string, d double, n long, b boolean",
    )

    def convert(name, dtype):
        c = parsing.convert(F.col(name), df.schema[name].dataType, parsing.spark_type(dtype))
        return [r[0] for r in df.select(c).collect()]

    assert convert("s", "int64") == [12, None, None]
    assert convert("s", "float64") == [12.0, 10.5, None]
    assert convert("d", "int64") == [10, None, None]
    assert convert("d", "str") == ["10.5", None, None]
    assert convert("n", "bool") == [True, False, None]
    assert convert("b", "int") == [1, 0, None]


def test_whole_numbers_are_nanoseconds(spark):
    c = parsing.convert(x(), T.LongType(), T.TimestampType())
    assert values(spark, c, [1_700_000_000_123_456_789], "x long") == [
        dt.datetime(2023, 11, 14, 22, 13, 20, 123456)
    ]


@pytest.mark.parametrize("name, kind", [("int64", T.LongType()), ("Int64", T.LongType()), (bool, T.BooleanType()),
                                        (float, T.DoubleType()), ("category", T.StringType()),
                                        ("datetime64[ns]", T.TimestampType()), ("decimal(18,2)", T.DecimalType(18, 2))])
def test_type_names(name, kind):
    assert parsing.spark_type(name) == kind


def test_white_space_is_what_python_strips():
    assert set(parsing.WHITESPACE) == {chr(i) for i in range(0x110000) if chr(i).isspace()}


TEXTS = st.text(
    alphabet=st.characters(codec="utf-8", exclude_categories=["Cs", "Cn"], max_codepoint=0x2FFF,
                           exclude_characters="\x00İ"),
    max_size=20,
)


@settings(max_examples=10, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(texts=st.lists(TEXTS, min_size=1, max_size=40))
def test_strip_equals_python(spark, texts):
    assert values(spark, text.strip(x()), texts) == [t.strip() for t in texts]


def test_title_case_equals_python(spark):
    texts = [
        "mc-donald", "3rd", "élan o'neil ça-va", "ALL CAPS\tTAB", "a1b2", "ß straße", "under_score", "  two  blanks",
        "", "x", "中a x", "ʰa ⅷx", "l’été", "a\nb", "ﬁn", "o'NEIL's", None,
    ]
    assert values(spark, text.title_case(x()), texts) == [t.title() if t is not None else None for t in texts]
    marked = "ab" + text.WORD_START + "cd-ef"
    assert values(spark, text.title_case(x()), [marked]) == [marked.title()]


def test_documents_in_title_case_equal_python(spark):
    rows = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select(
        "text", text.title_case(F.col("text")).alias("title")
    ).collect()
    assert all(r.title == r.text.title() for r in rows)


def test_clean_text_order_and_null(spark):
    c = text.clean_text(x(), case="upper", remove_chars=" -")
    assert values(spark, c, ["  a b-c ", None, "ß"]) == ["ABC", None, "SS"]
    assert values(spark, text.to_case(x(), "shouting"), ["aB"]) == ["aB"]


def test_contains_takes_text_literally(spark):
    assert values(spark, text.contains_ignoring_case(x(), "A.B"), ["xa.by", "xaxby", None]) == [True, False, None]


def test_map_keeps_or_defaults(spark):
    table = {"a": "Alpha", "b": None}
    assert values(spark, mapping.map_value(x(), table), ["a", "b", "c", None]) == ["Alpha", "b", "c", None]
    assert values(spark, mapping.map_value(x(), table, "z"), ["a", "b", "c", None]) == ["Alpha", "z", "z", "z"]
    assert values(spark, mapping.map_value(x(), {}), ["a", None]) == ["a", None]


def test_category_is_stripped_mapped_then_cased(spark):
    c = mapping.standard_category(x(), {"food": "Food_Drink"})
    assert values(spark, c, [" food\n", "Food", "other", None]) == ["FOOD_DRINK", "FOOD", "OTHER", None]


def test_status_names(spark):
    assert values(spark, mapping.normal_status(x()), [" COMPLETED ", "Pending", "FAILED", None]) == [
        "Processed", "AwaitingSettlement", "failed", None,
    ]


RULES = {"food": ["Market", "cafe"], "Fuel": ["gas"], "none": [], "food2": ["cafe"]}


def expected_tag(description, rules, default):
    tag = default
    for name, words in rules.items():
        if any(w.lower() in (description or "\0").lower() for w in words):
            tag = name.upper()
    return tag


@pytest.mark.parametrize("limit", [64, 0])
def test_last_matching_rule_wins(spark, monkeypatch, limit):
    monkeypatch.setattr(mapping, "CONDITION_CHAIN_LIMIT", limit)
    texts = ["Green MARKET", "gas at the market", "Cafe gas", "nothing", None, ""]
    got = values(spark, mapping.keyword_tag(x(), RULES, "Other"), texts)
    assert got == [expected_tag(t, RULES, "Other") for t in texts]
    assert got[2] == "FOOD2" and got[3] == "Other"


def test_no_rules_give_the_default(spark):
    assert values(spark, mapping.keyword_tag(x(), {}, "Other"), ["a"]) == ["Other"]


def test_amounts_by_rate(spark):
    schema = "a double, c string"
    rows = [(100.0, "USD"), (20.0, "eur"), (10.0, "GBP"), (5.0, None), (None, "EUR")]
    rates = {"eur": 9.9, "EUR": 1.1, "usd": 5.0}
    amount = business.normal_amount(F.col("a"), F.col("c"), rates)
    assert values(spark, amount, rows, schema) == [100.0, 20.0 * 1.1, 10.0, 5.0, None]
    assert values(spark, business.normal_amount(F.col("a"), F.col("c"), None), rows, schema) == [r[0] for r in rows]
    assert values(spark, business.is_international(F.col("c")), rows, schema) == [False, True, True, True, True]
    assert values(spark, business.rate_missing(F.col("c"), rates), rows, schema) == [False, False, True, True, False]


def test_bands_and_thresholds(spark):
    amounts = [-0.01, 0.0, 49.99, 50.0, 199.0, 200.0, 999.99, 1000.0, 1e12, None, float("nan")]
    assert values(spark, business.amount_band(x()), amounts, "x double") == [
        None, "Small", "Small", "Medium", "Medium", "Large", "Large", "Very Large", "Very Large", None, None,
    ]
    assert values(spark, business.is_high_value(x(), 1000.0), amounts, "x double") == [
        False, False, False, False, False, False, False, False, True, False, False,
    ]


def test_date_parts(spark):
    parts = business.date_parts(F.col("x").cast("timestamp"))
    got = values(spark, F.struct(*parts.values()), ["2024-02-29 23:59:59", None])
    assert tuple(got[0]) == (2024, 2, 29, "Thursday")
    assert tuple(got[1]) == (None, None, None, None)


def test_numbers_are_spelled_like_python(spark):
    numbers = [
        0.0, -0.0, 1.0, 25.5, -3.25, 9999999.0, 1e7, 12345678.9, -98765432.125, 1e15, 9007199254740993.0, 1e16, 1.5e17,
        0.001, 0.00012, 1e-4, 1.5e-5, 1e-10, 2.5e-300, 1e300, 123456789012.34, 0.1, float("inf"), float("-inf"),
    ]
    c = parsing.to_text(x(), T.DoubleType())
    assert values(spark, c, numbers, "x double") == [repr(n) for n in numbers]
    assert values(spark, c, [None, float("nan")], "x double") == [None, None]
    assert values(spark, parsing.to_text(x(), T.BooleanType()), [True, None], "x boolean") == ["True", None]


def test_many_keywords_give_what_conditions_give(spark, monkeypatch):
    import random

    draw = random.Random(6)
    word = lambda: "".join(draw.choice("abC \u00e9") for _ in range(draw.randint(0 if draw.random() < 0.02 else 1, 7)))
    for _ in range(12):
        rules = {f"tag{n}": [word() for _ in range(draw.randint(1, 4))] for n in range(draw.randint(1, 25))}
        texts = [None, "", *("".join(draw.choice("abcC \u00c9") for _ in range(draw.randint(1, 30))) for _ in range(80))]
        want = values(spark, mapping.keyword_tag(x(), rules, "Other"), texts)
        with monkeypatch.context() as m:
            m.setattr(mapping, "CONDITION_CHAIN_LIMIT", 0)
            m.setattr(mapping, "KEYWORD_INDEX_LIMIT", 0)
            assert values(spark, mapping.keyword_tag(x(), rules, "Other"), texts) == want
