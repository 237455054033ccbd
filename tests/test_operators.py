import datetime as dt
import math
import statistics as py_statistics
from collections import Counter

import pytest
from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from ledgerloom.operators import convert, dedup, joins, missing, quality, shape, statistics, values

NAN = float("nan")


@pytest.fixture(scope="module")
def stalls(spark):
    """Market stalls: gaps in every kind of column, odd booleans, blanks, a row that comes twice but for one case."""
    rows = [
        (41, "\tNorth Pier", 7, 12.5, "kiosk", "0", "late"),
        (42, "Old Mill ", None, NAN, "KIOSK ", "TRUE", None),
        (None, "Harbour", 19, 30.0, "stall", "maybe", "wet floor"),
        (44, "Quay", 7, 12.5, " Stall", "false", "late"),
        (45, " Depot ", 3, 99.5, "depot", "1", ""),
        (46, "Quay", 7, 12.5, "stall", None, None),
        (44, "Quay", 7, 12.5, " Stall", "FALSE", "late"),
    ]
    return spark.createDataFrame(
        rows, "Code long, Title string, Stock long, Price double, Kind string, Open string, Remark string"
    ).cache()


def column(df, name, by=None):
    return [r[0] for r in (df.orderBy(by) if by else df).select(name).collect()]


# --- shaping


def test_select_and_rename_skips_absent(stalls):
    out = shape.select_and_rename(stalls, {"Title": "Where", "Nowhere": "Gone", "Code": "Key"})
    assert out.columns == ["Where", "Key"]


def test_names_are_cleaned(spark):
    df = spark.createDataFrame([(1, 2, 3, 4, 5)], [" First Name ", "a-b.c", "Total ($)", "__x__y", "firstName"])
    assert shape.clean_column_names(df).columns == ["first_name", "a_b_c", "total", "x_y", "firstname"]
    assert shape.clean_column_names(df, "upper").columns[0] == "FIRST_NAME"
    assert shape.clean_column_names(df, "other").columns[4] == "firstName"


def test_colliding_names_get_a_number(spark):
    df = spark.createDataFrame([(1, 2, 3)], ["a b", "a-b", "A.B"])
    assert shape.clean_column_names(df).columns == ["a_b", "a_b_2", "a_b_3"]


@pytest.mark.parametrize("bad", ["x", ["x"], [{"target_name": "a", "dtype": "str"}], {"a": 1}])
def test_bad_definitions_are_refused(bad):
    with pytest.raises(ValueError):
        shape.check_target_schema(bad)


def definition(target, source, dtype, **more):
    return {"target_name": target, "source_column": source, "dtype": dtype, **more}


def test_conform_selects_casts_orders(spark):
    df = spark.createDataFrame(
        [("A1", "2023-01-01", "10.5", "true", None), ("B2", "bad", "x", "FALSE", "data")],
        ["SourceID", "EventDate", "Value", "IsActive", "OptionalField"],
    )
    found = shape.conform(
        df,
        [
            definition("Active", "IsActive", bool),
            definition("Value", "Value", "float64"),
            definition("At", "EventDate", "datetime64[ns]"),
            definition("Notes", "OptionalField", "str"),
            definition("Lost", "Nowhere", "int", required=True),
            definition("Maybe", "Elsewhere", "str"),
        ],
    )
    assert found.df.columns == ["Active", "Value", "At", "Notes", "Lost", "Maybe"]
    assert [f.dataType.simpleString() for f in found.df.schema] == [
        "boolean", "double", "timestamp", "string", "bigint", "string",
    ]
    assert [tuple(r) for r in found.df.collect()] == [
        (True, 10.5, dt.datetime(2023, 1, 1), None, None, None),
        (False, None, None, "data", None, None),
    ]
    assert (found.missing_required, found.missing_optional) == (["Lost"], ["Maybe"])


def test_conform_error_modes(spark):
    df = spark.createDataFrame([("10.5", "3"), ("20", "4")], ["Value", "Whole"])
    target = [definition("V", "Value", "int64"), definition("W", "Whole", "int64")]
    assert column(shape.conform(df, target).df, "V") == [None, 20]
    kept = shape.conform(df, target, on_error="keep").df
    assert [f.dataType.simpleString() for f in kept.schema] == ["string", "bigint"]
    with pytest.raises(PySparkException):
        shape.conform(df, target, on_error="raise").df.collect()


def test_conform_of_no_rows(spark):
    empty = spark.createDataFrame([], "SourceID string")
    out = shape.conform(empty, [definition("Identifier", "SourceID", "str")]).df
    assert out.columns == ["Identifier"] and out.isEmpty()


def test_source_columns_with_dots(spark):
    df = spark.createDataFrame([(1,)], ["a.b"])
    assert column(shape.conform(df, [definition("x", "a.b", "int")]).df, "x") == [1]


# --- conversion


def test_convert_types(stalls):
    out = convert.convert_types(stalls, {"Code": "str", "Price": "float32", "Open": "bool", "Nowhere": "int"})
    assert [out.schema[c].dataType.simpleString() for c in ("Code", "Price", "Open")] == [
        "string", "float", "boolean",
    ]
    assert column(out, "Open") == [False, True, None, False, True, None, False]


def test_keep_is_all_or_nothing(stalls):
    out = convert.convert_types(stalls, {"Open": "bool", "Stock": "float64"}, on_error="keep")
    assert out.schema["Open"].dataType.simpleString() == "string"
    assert out.schema["Stock"].dataType.simpleString() == "double"


def test_raise_fails_the_job(stalls):
    with pytest.raises(PySparkException):
        convert.convert_types(stalls, {"Open": "bool"}, on_error="raise").collect()
    with pytest.raises(ValueError):
        convert.convert_types(stalls, {"Open": "bool"}, on_error="ignore")


def test_parse_datetime_modes(spark):
    df = spark.createDataFrame([("2021-01-10",), ("soon",)], ["d"])
    assert column(convert.parse_datetime(df, "d", "%Y-%m-%d", "coerce"), "d") == [dt.datetime(2021, 1, 10), None]
    assert column(convert.parse_datetime(df, "d", "%Y-%m-%d", "ignore"), "d") == ["2021-01-10", "soon"]
    with pytest.raises(PySparkException):
        convert.parse_datetime(df, "d", "%Y-%m-%d").collect()
    good = df.where("d <> 'soon'")
    assert column(convert.parse_datetime(good, "d", None, "ignore"), "d") == [dt.datetime(2021, 1, 10)]
    assert convert.parse_datetime(df, "nowhere") is df


def test_create_timestamp_turns_sources_into_text(spark):
    df = spark.createDataFrame([(dt.date(2023, 1, 15), "10:30:00")], "d date, t string")
    out = convert.create_timestamp(df, "d", "t", "at")
    assert tuple(out.first()) == ("2023-01-15", "10:30:00", dt.datetime(2023, 1, 15, 10, 30))
    assert convert.create_timestamp(df, "d", None, "at").first().at == dt.datetime(2023, 1, 15)
    assert convert.create_timestamp(df, "nowhere") is df
    stamped = df.withColumn("d", F.col("d").cast("timestamp"))
    assert convert.create_timestamp(stamped, "d", "t", "at").first().at == dt.datetime(2023, 1, 15, 10, 30)


# --- missing values


def test_drop_rows_and_columns(stalls):
    assert missing.handle_missing(stalls, "drop_row", subset_for_drop=["Code", "Price"]).count() == 5
    assert missing.handle_missing(stalls).count() == 4
    kept = missing.handle_missing(stalls, "drop_column", columns=["Code", "Title", "Price"])
    assert kept.columns == ["Title", "Stock", "Kind", "Open", "Remark"]


def test_fill_constants(stalls):
    out = missing.handle_missing(stalls, "fill", columns=["Stock", "Remark", "Nowhere"], fill_value=-1)
    assert column(out, "Stock")[1] == -1 and column(out, "Remark")[1] == "-1"
    assert missing.handle_missing(stalls, "fill", columns=["Stock"]) is stalls
    texts = missing.handle_missing(stalls, "fill", fill_value="UNKNOWN")
    assert column(texts, "Remark")[1] == "UNKNOWN" and column(texts, "Stock")[1] is None
    with pytest.raises(ValueError):
        missing.handle_missing(stalls, "fill", columns=["Stock"], fill_value="UNKNOWN")


def test_fill_statistics(stalls):
    out = missing.handle_missing(stalls, "mean", columns=["Stock", "Title"])
    assert column(out, "Stock")[1] == pytest.approx((7 + 19 + 7 + 3 + 7 + 7) / 6)
    out = missing.handle_missing(stalls, "median", columns=["Price"])
    assert column(out, "Price")[1] == 12.5
    out = missing.handle_missing(stalls, "mode", columns=["Code", "Open", "Price"])
    assert column(out, "Code")[2] == 44 and column(out, "Price")[1] == 12.5
    assert column(out, "Open")[5] == "0"


def test_columns_of_nulls_stay(spark):
    df = spark.createDataFrame([(None, NAN)], "a long, b double")
    for strategy in ("mean", "median", "mode"):
        row = missing.handle_missing(df, strategy).first()
        assert row.a is None


def test_strategies_per_column(stalls):
    out = missing.apply_strategies(
        stalls,
        {"Remark": ("fill_constant", "none"), "Price": "fill_median", "Stock": "fill_mean", "Code": "fill_mode"},
        "drop_row",
    )
    assert out.count() == 6  # Open falls under the default
    assert out.where("Remark = 'none'").count() == 1
    with pytest.raises(ValueError):
        missing.apply_strategies(stalls, {"Stock": "guess"})


FLOATS = st.lists(
    st.one_of(st.none(), st.floats(allow_nan=True, allow_infinity=False, width=32), st.sampled_from([1.0, 2.0])),
    max_size=60,
)


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(numbers=FLOATS, limit=st.sampled_from([1, 2, 5, 1000]))
def test_medians_are_exact_however_narrow_the_limit(spark, numbers, limit):
    df = spark.createDataFrame([(x,) for x in numbers], "x double").repartition(3)
    present = [x for x in numbers if x is not None and not math.isnan(x)]
    expected = py_statistics.median(present) if present else None
    assert statistics.medians(df, ["x"], limit)["x"] == expected


def test_median_with_a_hot_value(spark):
    hot = spark.range(3000).select(F.when(F.col("id") % 3 == 0, 500.0).otherwise(F.col("id").cast("double")).alias("x"))
    numbers = [500.0 if i % 3 == 0 else float(i) for i in range(3000)]
    assert statistics.medians(hot, ["x"], 10) == {"x": py_statistics.median(numbers)}
    both = hot.select("x", (-F.col("x")).alias("y"))
    assert statistics.medians(both, ["x", "y"], 7)["y"] == -py_statistics.median(numbers)


def test_a_wrong_sketch_costs_a_pass_not_the_result(spark, monkeypatch):
    df = spark.range(1001).select(F.col("id").cast("double").alias("x"))
    monkeypatch.setattr(statistics, "_bracket", lambda x, share: F.percentile_approx(x, [0.8, 0.9], 100))
    assert statistics.medians(df, ["x"], 50) == {"x": 500.0}
    monkeypatch.setattr(statistics, "_bracket", lambda x, share: F.percentile_approx(x, [0.1, 0.2], 100))
    assert statistics.medians(df, ["x"], 50) == {"x": 500.0}


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(rows=st.lists(st.tuples(st.one_of(st.none(), st.integers(-2, 2)), st.one_of(st.none(), st.sampled_from("abc"))), max_size=30))
def test_modes_take_the_smallest_of_ties(spark, rows):
    df = spark.createDataFrame(rows, "n long, s string")
    found = statistics.modes(df, ["n", "s"])
    for i, name in enumerate(["n", "s"]):
        counts = Counter(r[i] for r in rows if r[i] is not None)
        expected = min((v for v in counts if counts[v] == max(counts.values())), default=None)
        assert found[name] == expected
    assert statistics.modes(df, ["s"])["s"] == found["s"]


# --- duplicates


def test_first_last_none(spark):
    rows = [(1, "b", 10), (1, "a", 20), (2, "c", 30), (None, "d", 40), (None, "e", 50)]
    df = spark.createDataFrame(rows, "k long, v string, at long").repartition(3)

    def keep(which, order=("at",)):
        return sorted(column(dedup.drop_duplicates(df, ["k"], which, list(order)), "v"))

    assert keep("first") == ["b", "c", "d"]
    assert keep("last") == ["a", "c", "e"]
    assert keep(False) == ["c"]
    assert keep("first", ()) == ["a", "c", "d"]
    with pytest.raises(ValueError):
        keep("some")


def test_nan_and_null_keys_are_equal(spark):
    df = spark.createDataFrame([(NAN, 1), (None, 2), (0.0, 3), (-0.0, 4)], "k double, v long")
    assert sorted(column(dedup.drop_duplicates(df, ["k"], "first", ["v"]), "v")) == [1, 3]
    assert dedup.drop_duplicates(df, ["k"], False).count() == 0


def test_whole_rows(stalls):
    assert dedup.drop_duplicates(stalls.drop("Open")).count() == 6
    assert dedup.drop_duplicates(stalls.drop("Open"), keep=False).count() == 5
    assert dedup.drop_duplicates(stalls, ["Title", "Stock", "Price"]).count() == 5


def test_whole_rows_with_nan_and_null(spark):
    df = spark.createDataFrame([(1, NAN), (1, None), (2, 1.0)], "a long, b double")
    assert dedup.drop_duplicates(df).count() == 2
    assert dedup.drop_duplicates(df, keep=False).count() == 1


@pytest.mark.parametrize("extra", [0, 100])
def test_mapping_between_types(spark, extra):
    df = spark.createDataFrame([(1, 1.0, "k1", True), (2, 2.5, "k2", False), (None, None, None, None)], "n long, d double, t string, b boolean")
    more = {f"more{n}": n for n in range(extra)}
    numbers = {10_000 + n: "x" for n in range(extra)}
    assert column(values.map_values(df, "n", {1: "one"} | numbers), "n") == ["one", "2", None]
    assert column(values.map_values(df, "d", {1: "one"} | numbers), "d") == ["one", "2.5", None]
    assert column(values.map_values(df, "d", {1: 7, 2.5: 8.5} | dict.fromkeys(numbers, 1)), "d") == [7.0, 8.5, None]
    assert column(values.map_values(df, "n", {1: 7, 2.5: 8} | dict.fromkeys(numbers, 1)), "n") == [7, 2, None]
    assert column(values.map_values(df, "t", {"k1": 10} | more), "t") == ["10", "k2", None]
    assert column(values.map_values(df, "t", {"k1": 10, "k2": 20} | more, default_value=0), "t") == [10, 20, 0]
    assert column(values.map_values(df, "t", {"k1": 10, "k2": "b", 1: "never"} | more), "t") == ["10", "b", None]
    assert column(values.map_values(df, "b", {True: "yes", False: "no"} | numbers), "b") == ["yes", "no", None]
    assert column(values.map_values(df, "n", {1: True} | dict.fromkeys(numbers, False)), "n") == ["True", "2", None]
    table = spark.createDataFrame([(1, "one"), (9, "nine")], "k long, v string")
    assert column(values.map_values(df, "n", table), "n") == ["one", "2", None]


def test_wide_tables(spark):
    names = [f"c{n}" for n in range(100)]
    rows = [tuple(float(r * r % 7 + n) for n in range(100)) for r in range(25)]
    df = spark.createDataFrame(rows, names)
    middle = statistics.medians(df, names, limit=60)
    mode = statistics.modes(df, names)
    for n, name in enumerate(names):
        own = [r[n] for r in rows]
        assert middle[name] == py_statistics.median(own)
        top = Counter(own).most_common()
        assert mode[name] == min(v for v, k in top if k == top[0][1])


def test_modes_of_many_columns_and_types_in_one_scan(spark, monkeypatch):
    monkeypatch.setattr(statistics, "written_table", lambda *_: pytest.fail("more columns, further scans"))
    day = dt.date(2024, 1, 1)
    rows = [(n % 3 or None, [NAN, 2.5, 2.5, -1.0][n % 4], "ba"[n % 2], day, True, None) for n in range(12)]
    df = spark.createDataFrame(rows, "n long, x double, s string, d date, b boolean, e string").repartition(3)
    many = [f"n{i}" for i in range(90)]
    df = df.withColumns({name: F.col("n") * i for i, name in enumerate(many)})
    found = statistics.modes(df, [*many, "n", "x", "s", "d", "b", "e", "n"])
    assert found == {**{name: i for i, name in enumerate(many)}, "n": 1, "x": 2.5, "s": "a", "d": day, "b": True, "e": None}
    assert statistics.modes(df.limit(0), ["n", "s"]) == {"n": None, "s": None}
    assert statistics.modes(df, []) == {}


def test_nested_lookups_are_measured(spark):
    wide = spark.range(50).select(F.col("id").alias("k"), F.sequence(F.lit(1), F.lit(30_000)).alias("v"))
    assert not joins.fits_broadcast(wide, size=4 << 20)
    assert joins.fits_broadcast(spark.range(50).select("id", F.array(F.lit(1)).alias("v")), size=4 << 20)


def test_all_columns_as_keys(spark):
    df = spark.createDataFrame([(1, 2), (1, 2), (3, 4)], "a long, b long")
    assert dedup.drop_duplicates(df, ["a", "b"], "last").count() == 2


# --- lookups, tags, currencies


@pytest.mark.parametrize("limit", [500_000, 0])
def test_map_by_frame_or_dictionary(spark, monkeypatch, limit):
    monkeypatch.setattr(joins.lookup_join, "__defaults__", ("left", limit))
    df = spark.createDataFrame([(1, "a"), (2, "b"), (3, None), (4, "zz")], "i long, c string")
    pairs = spark.createDataFrame([("a", "Alpha"), ("b", None), (None, "null")], "k string, v string")
    kept = values.map_values(df, "c", pairs)
    assert kept.columns == ["i", "c"]
    assert column(kept, "c", "i") == ["Alpha", "b", None, "zz"]
    assert column(values.map_values(df, "c", pairs, "?"), "c", "i") == ["Alpha", "?", "?", "?"]
    many = {f"k{i}": f"v{i}" for i in range(200)} | {"a": "Alpha"}
    assert column(values.map_values(df, "c", many), "c", "i") == ["Alpha", "b", None, "zz"]


def test_repeated_mapping_keys_are_refused(spark):
    df = spark.createDataFrame([("a",)], ["c"])
    with pytest.raises(ValueError):
        values.map_values(df, "c", spark.createDataFrame([("a", "x"), ("a", "y")], ["k", "v"]))


def test_currency_by_dictionary_and_by_frame(spark):
    df = spark.createDataFrame(
        [(1, "100.50", "USD"), (2, "20", "eur"), (3, "bad", "EUR"), (4, "7", None), (5, "3", "GBP")],
        "i long, amount string, ccy string",
    )
    rates = {"EUR": 1.1}
    by_dict = values.normalize_currency(df, "amount", "ccy", "USD", rates, "usd", "foreign", "no_rate")
    frame = spark.createDataFrame([("eur", 1.1), ("usd", 7.0)], "code string, rate double")
    by_frame = values.normalize_currency(df, "amount", "ccy", "USD", frame, "usd", "foreign", "no_rate")
    expected = [
        (1, 100.5, "USD", 100.5, False, False),
        (2, 20.0, "eur", 20.0 * 1.1, True, False),
        (3, None, "EUR", None, True, False),
        (4, 7.0, None, 7.0, True, True),
        (5, 3.0, "GBP", 3.0, True, True),
    ]
    for out in (by_dict, by_frame):
        assert [tuple(r) for r in out.orderBy("i").select("i", "amount", "ccy", "usd", "foreign", "no_rate").collect()] == expected
    assert values.normalize_currency(df, "nowhere", "ccy") is df


def test_many_rates_take_the_join(spark):
    df = spark.createDataFrame([(1.0, "c7")], "amount double, ccy string")
    rates = {f"C{i}": float(i) for i in range(100)}
    out = values.normalize_currency(df, "amount", "ccy", "USD", rates, "usd", None)
    assert out.columns == ["amount", "ccy", "usd"] and out.first().usd == 7.0


def test_text_columns(stalls):
    out = values.clean_text_column(stalls, "Kind", to_case="upper", remove_chars=" ")
    assert column(out, "Kind") == ["KIOSK", "KIOSK", "STALL", "STALL", "DEPOT", "STALL", "STALL"]
    assert column(values.clean_text_column(stalls, "Stock"), "Stock")[:3] == ["7", None, "19"]
    assert values.clean_text_column(stalls, "nowhere") is stalls
    assert column(values.strip_text_columns(stalls), "Title")[0] == "North Pier"
    assert column(values.normalize_text_fields(stalls, ["Title"]), "Title")[0] == "north pier"


# --- quality


EXPECTED = [
    {"name": "Code", "type": "int", "required": True},
    {"name": "Open", "type": "bool", "required": False},
    {"name": "Title", "type": "datetime", "datetime_format": "%Y", "required": False},
    {"name": "customer", "type": "string", "required": True},
]


def test_expected_columns(stalls):
    report = {(r.column_name, r.rule): r.violations for r in quality.check_expected(stalls, EXPECTED).collect()}
    assert report == {
        ("Code", "present"): 0, ("Open", "present"): 0, ("Title", "present"): 0, ("customer", "present"): 1,
        ("Code", "required"): 1, ("Code", "type"): 0, ("Open", "type"): 1, ("Title", "datetime_format"): 7,
    }
    with pytest.raises(quality.SchemaViolation):
        quality.require_expected(stalls, EXPECTED)
    assert quality.require_expected(stalls, EXPECTED[1:1]) is stalls


def test_expected_columns_from_a_schema(stalls):
    found = quality.expected_columns(stalls.schema.json())
    assert [d["name"] for d in found] == stalls.columns and not found[0]["required"]


def test_row_status_and_quarantine(stalls):
    tagged = quality.tag_rows(
        stalls,
        warnings={"no_remark": F.col("Remark").isNull()},
        errors={"no_code": F.col("Code").isNull(), "odd": F.col("Open") == "maybe"},
    )
    status = dict(tagged.select("Title", "PreliminaryValidationStatus").collect())
    assert status["Old Mill "] == "PASSED_WITH_WARNINGS" and status["Harbour"] == "FAILED" and status[" Depot "] == "PASSED"
    good, bad = quality.split_quarantine(tagged)
    assert (good.count(), bad.count()) == (6, 1)
    assert column(bad, "failed_rules") == [["no_code", "odd"]]


def test_lost_values(stalls):
    from ledgerloom.functions.parsing import to_boolean

    report = quality.lost_values(stalls, {"Open": (F.col("Open"), to_boolean(F.col("Open")))})
    assert [tuple(r) for r in report.collect()] == [("Open", 6, 1)]


def test_run_metrics(spark, stalls, fresh):
    metrics = quality.RunMetrics("r1", {"env": "test"})
    with metrics.stage("write", source="stalls") as stage:
        stage.counted(stalls).write.parquet(fresh())
    with pytest.raises(RuntimeError):
        with metrics.stage("break"):
            raise RuntimeError("no luck")

    @metrics.timed(records_of=len)
    def listed():
        return [1, 2, 3]

    assert listed() == [1, 2, 3]
    metrics.record("rows_dropped", 7)
    rows = {r.task: r for r in metrics.frame(spark).collect()}
    assert rows["write"].records == 7 and rows["write"].tags == {"env": "test", "source": "stalls"}
    assert rows["write"].records_per_second > 0
    assert (rows["break"].status, rows["break"].error) == ("failed", "no luck")
    assert rows["listed"].records == 3 and rows["rows_dropped"].tags["value"] == "7"


def test_names_with_dots_and_blanks(spark):
    df = spark.createDataFrame(
        [(1, 1.0, " a ", "USD"), (1, None, "b", "eur"), (2, 3.0, None, None)], ["the id", "an.amount", "a text", "c.y"]
    )
    assert dedup.drop_duplicates(df, ["the id"], "first", ["an.amount"]).count() == 2
    assert dedup.drop_duplicates(df, ["the id"], False).count() == 1
    assert missing.handle_missing(df, "drop_row", subset_for_drop=["an.amount", "a text"]).count() == 1
    assert missing.handle_missing(df, "drop_column", columns=["an.amount", "the id"]).columns == ["the id", "a text", "c.y"]
    for strategy in ("mean", "median", "mode"):
        assert missing.handle_missing(df, strategy, columns=["an.amount"]).where("`an.amount` is null").isEmpty()
    filled = missing.fill_constant(df, "?", ["a text"])
    assert values.map_values(filled, "a text", {"?": "none"}).columns == df.columns
    assert values.normalize_currency(df, "an.amount", "c.y", exchange_rates={"EUR": 2.0}).count() == 3
    assert convert.convert_types(df, {"an.amount": "str"}, on_error="keep").schema["an.amount"].dataType.simpleString() == "string"
    assert quality.check_expected(df, [{"name": "c.y", "type": "str", "required": True}]).where("violations > 0").count() == 1


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(
    rows=st.lists(
        st.tuples(st.one_of(st.none(), st.integers(0, 3)), st.one_of(st.none(), st.sampled_from([0.0, 1.5, NAN]))),
        min_size=1,
        max_size=40,
    )
)
def test_duplicates_like_pandas(spark, rows):
    import pandas as pd

    numbered = [(i, *r) for i, r in enumerate(rows)]
    df = spark.createDataFrame(numbered, "place long, a long, b double").repartition(3)
    pdf = pd.DataFrame(numbered, columns=["place", "a", "b"]).astype({"a": "Int64", "b": "float64"})
    for keep in ("first", "last", False):
        got = dedup.drop_duplicates(df, ["a", "b"], keep, ["place"])
        assert sorted(column(got, "place")) == sorted(pdf.drop_duplicates(["a", "b"], keep=keep)["place"])
