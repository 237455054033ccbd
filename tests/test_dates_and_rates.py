"""Date patterns against Python's, patterns nobody declared, dated rates, exact decimals."""

import datetime as dt
import random
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from ledgerloom.functions import parsing
from ledgerloom.operators import convert, dedup, values
from ledgerloom.sources import pages

CASES = {
    "%Y-%m-%d": ["2024-01-05", "2024-1-5", "2024-02-30", "x"],
    "%y/%m/%d": ["99/05/01", "69/01/01", "68/12/31", "00/02/29", "72/02/29"],
    "%d %b %Y": ["5 Jan 2024", "05 feb 2024", "5 Smarch 2024"],
    "%d %B %Y": ["5 January 2024", "31 May 1999"],
    "%A, %d %B %Y": ["Monday, 05 January 2024", "sunday, 5 May 2024", "Mon, 5 May 2024", "5 May 2024"],
    "%a %d.%m.%Y": ["Mon 05.01.2024", "Sunday 05.01.2024", "tue 6.1.2024"],
    "%Y-%m-%d %H:%M:%S.%f": ["2024-01-05 01:02:03.123456", "2024-01-05 01:02:03.5"],
    "%d/%m/%Y %I:%M %p": ["05/01/2024 12:30 AM", "05/01/2024 01:30 pm", "5/1/2024 13:30 PM"],
    "%Y%m%d": ["20240105"],
    "%Y%m%d%H%M%S": ["20240105010203"],
    "%Y %j": ["2024 060", "2023 365"],
    "%Y-%m-%dT%H:%M:%S%z": ["2024-01-05T01:02:03+0100", "2024-01-05T01:02:03+01:00", "2024-01-05T01:02:03Z", "2024-01-05T01:02:03-0530"],
    "%d.%m.%Y 100%%": ["05.01.2024 100%"],
}


@pytest.mark.parametrize("pattern", CASES)
def test_directives_read_as_python_does(spark, pattern):
    rows = spark.createDataFrame(list(enumerate(CASES[pattern])), "n int, t string")
    found = {r.n: r.at for r in rows.select("n", parsing.by_pattern(F.col("t"), pattern).cast("timestamp_ntz").alias("at")).collect()}
    for n, text in enumerate(CASES[pattern]):
        try:
            want = dt.datetime.strptime(text, pattern)
            want = want.astimezone(dt.timezone.utc).replace(tzinfo=None) if want.tzinfo else want
        except ValueError:
            want = None
        assert found[n] == want, (text, pattern)


def test_patterns_are_found_by_all_values(spark):
    rows = [
        ("13/02/2024", "02/03/2024", "2024-01-05 10:00", "junk", "05 Jan 2024", "7/4/21", None),
        ("01/02/2024", "04/05/2024", " 2024-01-06 23:59 ", None, "6 Feb 2024", "12/25/99", None),
        ("no date", "07/07/2024", None, "??", "7 May 2024", "1/2/03", None),
    ]
    df = spark.createDataFrame(rows, "a string, b string, c string, d string, e string, f string, g string")
    found = convert.infer_patterns(df, list("abcdefg"))
    assert {k: v.pattern for k, v in found.items()} == {
        "a": "%d/%m/%Y", "b": "%m/%d/%Y", "c": "%Y-%m-%d %H:%M", "d": None, "e": "%d %b %Y", "f": "%m/%d/%y", "g": None,
    }
    assert found["b"].ambiguous == ("%d/%m/%Y",) and found["a"].ambiguous == () and found["e"].ambiguous == ()
    assert (found["a"].present, found["a"].parsed) == (3, 2)
    assert convert.infer_patterns(df, ["b"], day_first=True)["b"].pattern == "%d/%m/%Y"
    parsed = convert.parse_inferred(df, ["a", "b", "d", "unknown"]).collect()
    assert [r.a and r.a.day for r in parsed] == [13, 1, None] and parsed[0].d == "junk"


def test_every_candidate_is_found_for_its_own_values(spark):
    at = dt.datetime(2024, 11, 28, 13, 45, 59, 123456, dt.timezone.utc)
    texts = {f"c{n}": at.strftime(p) for n, p in enumerate(parsing.CANDIDATES)}
    df = spark.createDataFrame([tuple(texts.values())], ", ".join(f"{n} string" for n in texts))
    for n, found in convert.infer_patterns(df, list(texts)).items():
        pattern = parsing.CANDIDATES[int(n[1:])]
        assert found.pattern and dt.datetime.strptime(texts[n], found.pattern) == dt.datetime.strptime(texts[n], pattern), (n, pattern, found)


def test_patterns_take_one_scan_and_shapes_further_down_another(spark):
    read = spark.sparkContext.accumulator(0)

    @F.udf("string")
    def text(n):
        read.add(1)
        return None if n % 10 == 9 else f"{n % 28 + 1}/{n % 12 + 1}/{2000 + n % 30}" if n < 19_000 else "2024-05-06"

    df = spark.range(0, 20_000, 1, 2).select(text("id").alias("a"))
    usual = convert.infer_patterns(df.where("id < 18000"), ["a"])["a"]
    assert (usual.pattern, usual.present, usual.parsed, usual.ambiguous) == ("%d/%m/%Y", 16_200, 16_200, ())
    # The shapes are not counted in a scan of their own.
    assert read.value < 30_000
    late = convert.infer_patterns(df, ["a"])["a"]
    assert (late.pattern, late.present, late.parsed) == ("%d/%m/%Y", 18_000, 17_100)
    mostly = convert.infer_patterns(df.where("id >= 18900").unionByName(df.where("id < 1200")), ["a"])["a"]
    assert mostly.pattern == "%d/%m/%Y" and (mostly.present, mostly.parsed) == (2070, 1170)


ODD_DATES = (
    *("01/02/2024", "1/2/2024", "13/02/2024", "02/13/2024", "001/0002/2024", "+1/2/2024", "0/2/2024", "31/4/2024", "29/02/2023"),
    *("1/2/24", "1/2/024", "1/2/+12024", "1/2/-0044", "2024-1-2", "+12024-01-02", "20240102", "2024013", "02.01.2024", "2-Jan-2024"),
    *("2 JAN 2024", "2 january 2024", "2 May 2024", "2 \u017fep 2024", "Sept 2, 2024", "May 2, 2024", "September 02, 2024", "tomorrow"),
    *("2024-01-02 25:00:00", "2024-01-02 3:4:5", "2024-01-02t03:04:05", "2024-01-02T03:04:05.1", "2024-01-02T03:04:05.123456"),
    *("2024-01-02T03:04:05Z", "2024-01-02T03:04:05+01:00", "2024-01-02T03:04:05-0100", "1/2/2024 1:02 pm", "1/2/2024 13:02 PM", ""),
    *("01/02/2024\n", " 01/02/2024", "\u0661/2/2024", "1/2/2024 01:02:03.5"),
)


def test_plausible_texts_are_all_that_parse(spark):
    df = spark.createDataFrame([(t,) for t in ODD_DATES], "t string")
    tests = [parsing.plausible(F.col("t"), p) for p in parsing.CANDIDATES]
    rows = df.select(
        F.array(*[parsing.by_pattern(F.col("t"), p).cast("string") for p in parsing.CANDIDATES]).alias("tested"),
        F.array(*[parsing.by_pattern(F.col("t"), p, False).cast("string") for p in parsing.CANDIDATES]).alias("plain"),
        F.array(*tests).alias("plausible"),
        "t",
    ).collect()
    assert all(r.tested == r.plain for r in rows), [r.t for r in rows if r.tested != r.plain]
    assert sum(any(r.plain) for r in rows) > 20
    # What cannot be a date is not parsed at all, and a day is no month.
    by_text = {r.t: dict(zip(parsing.CANDIDATES, r.plausible)) for r in rows}
    assert not any(by_text["tomorrow"].values()) and not by_text["13/02/2024"]["%m/%d/%Y"] and by_text["13/02/2024"]["%d/%m/%Y"]
    assert parsing.plausible(F.col("t"), "%Z") is None and parsing.plausible(F.col("t"), "[%Y]") is None


@pytest.mark.parametrize("bucket", ["month", "day"])
def test_dated_rates_by_definition(spark, bucket, monkeypatch):
    chance = random.Random(4)
    day = lambda n: dt.datetime(2024, 1, 1) + dt.timedelta(hours=n)
    rates = {(c, n): round(chance.uniform(0.5, 2), 3) for c in ("EUR", "cad", "USD") for n in chance.sample(range(5000), 25)}
    # A third of the rows and more share a currency.
    codes = ["eur", "EUR", "Eur", "CAD", "USD", "GBP", None]
    rows = [(n, chance.choice(["1.5", "x", None, "200"]), chance.choice(codes), day(chance.randint(-200, 9000)) if n % 50 else None) for n in range(600)]
    df = spark.createDataFrame(rows, "id int, amount string, currency string, at timestamp_ntz")
    table = spark.createDataFrame([(c, day(n), r) for (c, n), r in rates.items()], "c string, d timestamp_ntz, r double")
    got = values.normalize_currency_dated(df, "amount", "currency", "at", table, "usd", "normal", "missing", bucket)
    assert got.columns == ["id", "amount", "currency", "at", "normal", "missing"]
    for r in got.collect():
        amount = {"1.5": 1.5, "200": 200.0}.get(rows[r.id][1])
        code, at = (rows[r.id][2] or "?").upper(), rows[r.id][3]
        held = [(n, x) for (c, n), x in rates.items() if c.upper() == code != "USD" and at is not None and day(n) <= at]
        rate = max(held)[1] if held else None
        assert r.normal == (None if amount is None else amount * (rate or 1)), r
        assert r.missing == (rate is None and code != "USD")
    with pytest.raises(ValueError):
        values.normalize_currency_dated(df, "amount", "currency", "at", table.unionByName(table), "usd")
    assert values.normalize_currency_dated(df.limit(0), "amount", "currency", "at", table, "usd").count() == 0


@pytest.mark.parametrize("entries", [10, 100])
def test_decimals_stay_exact(spark, entries):
    big = Decimal("1234567890123456789012345.67")
    df = spark.createDataFrame([(big,), (Decimal("3.00"),), (Decimal("-1.00"),)], "v decimal(38,2)")
    mapping = {n: Decimal(n) + Decimal("0.01") for n in range(entries)} | {big: Decimal("12345678901234567890.12"), 3.001: Decimal("9")}
    got = values.map_values(df, "v", mapping)
    assert [r.v for r in got.collect()] == [Decimal("12345678901234567890.12"), Decimal("3.01"), Decimal("-1.00")]
    assert got.schema["v"].dataType.simpleString() == "decimal(38,2)"
    with pytest.raises(ValueError):
        values.map_values(df, "v", mapping | {7: Decimal("0.123")})


def test_pages_without_an_attempt(spark):
    body = '[{{"id": {}}}]'.format
    landed = [("e", n, 200, body(n), a) for n, a in ((1, None), (2, 1), (3, None))] + [("e", 2, 200, body(9), None)]
    df = spark.createDataFrame(landed, "endpoint string, page_no long, status int, body string, attempt int")
    assert sorted(r.id for r in pages.fetch_all(df, "id long").select("id").collect()) == [1, 2, 3]


def test_naming_all_columns_is_naming_none(spark):
    df = spark.sql("SELECT * FROM VALUES (1, double('NaN')), (1, NULL), (2, 1.0), (2, 1.0) AS t(a, b)")
    assert dedup.drop_duplicates(df, ["a", "b"]).count() == dedup.drop_duplicates(df).count() == 2
