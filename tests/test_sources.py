import json

import pytest
from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F
from ledgerloom.sources import files, incremental, pages, tables


def put(spark, path, lines):
    """Write texts as files without help of the code under test."""
    spark.createDataFrame([(x,) for x in lines], "value string").coalesce(1).write.mode("append").text(path)
    return path


PEOPLE = "ID long, Name string, Value double"


# --- files


def test_csv_with_header(spark, fresh):
    path = put(spark, fresh(), ["ID,Name,Value", "70,copper,0.25", "71,zinc,18"])
    assert [tuple(r) for r in files.read_csv(spark, path, PEOPLE).collect()] == [(70, "copper", 0.25), (71, "zinc", 18.0)]
    assert files.read_csv(spark, path).columns == ["ID", "Name", "Value"]


def test_csv_of_a_header_only(spark, fresh):
    empty = files.read_csv(spark, put(spark, fresh(), ["ID,Name,Value"]), PEOPLE)
    assert empty.columns == ["ID", "Name", "Value"] and empty.isEmpty()


def test_quote_inside_a_value_is_legal(spark, fresh):
    path = put(spark, fresh(), ["ID,Name,Value", '9,6" pipe,41'])
    assert files.read_csv(spark, path, PEOPLE).first().Name == '6" pipe'


def test_line_ends_inside_quotes(spark, fresh):
    path = put(spark, fresh(), ["ID,Name,Value", '5,"two', 'lines",1', "6,one,2"])
    assert [tuple(r) for r in files.read_csv(spark, path, PEOPLE, multi_line=True).collect()] == [(5, "two\nlines", 1.0), (6, "one", 2.0)]
    split = files.read_csv_split(spark, path, PEOPLE, multi_line=True)
    assert (split.good.count(), split.quarantine.count()) == (2, 0)


def test_other_headers_fail(spark, fresh):
    path = put(spark, fresh(), ["Name,ID,Value", "5,6,1"])
    with pytest.raises(Exception, match="header"):
        files.read_csv(spark, path, "ID string, Name string, Value string").collect()


def test_a_bad_value_costs_its_row(spark, fresh):
    path = put(spark, fresh(), ['[{"ID": 1, "Name": "a"}, {"ID": "x", "Name": "b"}, {"ID": 3.0, "Value": "7"}]'])
    assert sorted(r.ID for r in files.read_json_documents(spark, path, PEOPLE).collect()) == [1, 3]
    bad = files.read_json_split(spark, path, PEOPLE).quarantine.collect()
    assert [json.loads(r.raw_text) for r in bad] == [{"ID": "x", "Name": "b"}]
    lines = put(spark, fresh(), ['{"ID": 1}', '{"ID": 2', '{"ID": "z"}'])
    assert [r.ID for r in files.read_json_lines(spark, lines, PEOPLE).collect()] == [1]
    assert files.read_json_split(spark, lines, PEOPLE, lines=True).quarantine.count() == 2
    assert files.read_json_lines(spark, lines, PEOPLE).count() == 1
    xml = put(spark, fresh(), ["<all><r><ID>1</ID></r><r><ID>one</ID><Name>n</Name></r></all>"])
    assert [r.ID for r in files.read_xml(spark, xml, "r", PEOPLE).collect()] == [1]
    assert [json.loads(r.raw_text) for r in files.read_xml_split(spark, xml, "r", PEOPLE).quarantine.collect()] == [{"ID": "one", "Name": "n"}]


def test_malformed_rows(spark, fresh):
    path = put(spark, fresh(), ["ID,Name,Value", "1,Al,1.5", "2,Bo,abc", "3,Cy,2.5,more", "x,Di,3.5", "4,Ed,4.5"])
    split = files.read_csv_split(spark, path, PEOPLE)
    assert sorted(r.ID for r in split.good.collect()) == [1, 4]
    assert sorted(r.raw_text for r in split.quarantine.collect()) == ["2,Bo,abc", "3,Cy,2.5,more", "x,Di,3.5"]
    # The split is the same whichever columns are read.
    assert (split.good.count(), split.quarantine.count()) == (2, 3)
    assert sorted(r.Name for r in split.good.select("Name").collect()) == ["Al", "Ed"]
    assert split.quarantine.first().source_file.endswith(".txt")
    dropped = files.read_csv(spark, path, PEOPLE, on_malformed="drop")
    assert sorted(r.ID for r in dropped.collect()) == [1, 4]
    with pytest.raises(Exception, match="MALFORMED"):
        files.read_csv(spark, path, PEOPLE).collect()


@pytest.mark.parametrize(
    "document, names",
    [
        ('[{"ID": 1, "Name": "C"}, {"ID": 2, "Name": "D"}]', ["C", "D"]),
        ('{"ID": 1,\n "Name": "C"}', ["C"]),
        ("[]", []),
        ("5", []),
        ('"text"', []),
        ('{"ID": 1', []),
    ],
)
def test_json_documents(spark, fresh, document, names):
    path = put(spark, fresh(), document.split("\n"))
    assert [r.Name for r in files.read_json_documents(spark, path, PEOPLE).collect()] == names


def test_files_by_extension_and_pattern(spark, fresh):
    root = fresh()
    df = spark.createDataFrame([(1, "a", 2.0)], PEOPLE)
    df.write.parquet(f"{root}/x/one.parquet")
    df.write.option("header", True).csv(f"{root}/y")
    df.write.json(f"{root}/z")
    assert files.read_path(spark, f"{root}/x/one.parquet").count() == 1
    assert files.read_directory(spark, root, "csv", "*.csv", PEOPLE).collect() == df.collect()
    assert files.read_directory(spark, root, "jsonl", "*.json", PEOPLE).collect() == df.collect()
    assert files.read_directory(spark, f"{root}/z", "json", schema=PEOPLE).count() == 1
    with pytest.raises(ValueError):
        files.read_path(spark, f"{root}/notes.txt")
    with pytest.raises(AnalysisException):
        files.read_path(spark, f"{root}/nowhere.csv", PEOPLE)
    with pytest.raises(ValueError):
        files.read_staged(spark, root, "avro")


def test_xml(spark, fresh):
    path = put(spark, fresh(), ["<all><r><ID>1</ID><Name>A</Name></r><r><ID>2</ID></r></all>"])
    assert [tuple(r) for r in files.read_xml(spark, path, "r", "ID long, Name string").collect()] == [(1, "A"), (2, None)]


# --- pages


def what_a_page_holds(status, body, results_key):
    """Its records and whether it is a lone object; no records where the page does not count."""
    try:
        data = json.loads(body) if status == 200 else None
    except ValueError:
        data = None
    found = data.get(results_key) if results_key and isinstance(data, dict) else data
    if not results_key and isinstance(data, dict):
        return [data], True
    return (found if isinstance(found, list) and not (results_key and not isinstance(data, dict)) else []), False


def records_of_a_read(landed, results_key, next_key, paged, max_pages):
    """All records up to the first page number, by comparison of all of them, that ends the read."""
    numbers = range(1, max(landed, default=0) + 2)
    holds = {n: what_a_page_holds(*landed.get(n, (404, "")), results_key) for n in numbers}
    before = [n - 1 for n in numbers if not holds[n][0]]
    lone = [n for n in numbers if holds[n][1]]
    single = [] if paged else [1]
    limit = [] if max_pages is None else [max_pages]
    no_next = []
    if next_key:
        bodies = {n: json.loads(landed[n][1]) for n in numbers if holds[n][0]}
        no_next = [n for n, data in bodies.items() if not (isinstance(data, dict) and data.get(next_key))]
    last = min(before + lone + single + limit + no_next)
    return [(n, r.get("id") if isinstance(r, dict) else None) for n in numbers if n <= last for r in holds[n][0]]


RECORD = st.fixed_dictionaries({"id": st.integers(0, 9)})
BODY = st.one_of(
    st.builds(
        lambda rs, n: json.dumps({"results": rs, "next": n}),
        st.lists(RECORD, min_size=1, max_size=3),
        st.sampled_from(["u", "u", "u", None, ""]),
    ),
    st.sampled_from(
        ['{"results": [', '{"results": []}', '{"results": {"id": 1}}', '{"id": 3}', "[]", "7", '{"results": null}', ""]
    ),
    st.builds(lambda rs: json.dumps(rs), st.lists(RECORD, min_size=1, max_size=2)),
    st.builds(lambda rs: json.dumps({"results": rs}), st.lists(RECORD, min_size=1, max_size=2)),
)
ENDPOINT = st.dictionaries(
    st.integers(1, 6), st.tuples(st.sampled_from([200, 200, 200, 200, 500]), BODY), max_size=6
)


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(
    endpoints=st.lists(ENDPOINT, min_size=4, max_size=12),
    options=st.sampled_from(
        [("results", None, True), ("results", "next", True), (None, None, True), ("results", None, False), (None, None, False)]
    ),
    max_pages=st.sampled_from([None, None, 0, 1, 2]),
)
def test_pages_like_a_client(spark, endpoints, options, max_pages):
    results_key, next_key, paged = options
    rows = [(f"e{i}", n, s, b) for i, e in enumerate(endpoints) for n, (s, b) in e.items()]
    landed = spark.createDataFrame(rows, "endpoint string, page_no long, status int, body string")
    got = pages.fetch_all(landed, "id long", results_key, next_key, paged, max_pages)
    found = sorted((r.endpoint, r.page_no, r.record_no, r.id) for r in got.collect())
    expected = []
    for i, e in enumerate(endpoints):
        place = {}
        for number, value in records_of_a_read(e, results_key, next_key, paged, max_pages):
            place[number] = place.get(number, -1) + 1
            expected.append((f"e{i}", number, place[number], value))
    assert found == sorted(expected)


def test_bodies_of_any_size(spark):
    many = json.dumps({"results": [{"id": n, "text": "x" * 1000} for n in range(40_000)], "next": None})
    wide = json.dumps([{"id": 1, "text": "y" * 21_000_000}])
    rows = [("many", 1, 200, many), ("wide", 1, 200, wide)]
    landed = spark.createDataFrame(rows, "endpoint string, page_no long, status int, body string")
    got = pages.fetch_all(landed.where("endpoint = 'many'"), "id long, text string", "results", "next")
    assert got.count() == 40_000 and got.agg(F.sum("id")).first()[0] == 40_000 * 39_999 // 2
    assert pages.fetch_all(landed.where("endpoint = 'wide'"), "id long, text string").select(F.length("text")).first()[0] == 21_000_000
    single = spark.createDataFrame([(200, wide[1:-1])], "status int, body string")
    assert pages.single_records(single, "id long, text string").select(F.length("text")).first()[0] == 21_000_000


def test_repeated_keys_and_loose_values(spark):
    body = '{"results": [{"id": 1, "id": "2", "at": "2024-05-06", "in": {"a": [1]}}, {"id": 3.0, "in": null}]}'
    landed = spark.createDataFrame([("e", 1, 200, body)], "endpoint string, page_no long, status int, body string")
    got = pages.fetch_all(landed, "id long, at date, in struct<a: array<int>>", "results").orderBy("record_no").collect()
    assert [(r.id, str(r.at)) for r in got] == [(2, "2024-05-06"), (3, "None")] and got[0]["in"].a == [1]


def test_attempts_of_a_page(spark):
    rows = [("e", 1, 500, "", 1), ("e", 1, 200, '[{"id": 1}]', 2), ("e", 2, 200, '[{"id": 9}]', 1), ("e", 2, 200, '[{"id": 2}]', 2)]
    landed = spark.createDataFrame(rows, "endpoint string, page_no long, status int, body string, attempt int")
    assert sorted(r.id for r in pages.fetch_all(landed, "id long").collect()) == [1, 2]
    unordered = landed.where("NOT (page_no = 2 AND attempt = 1)").drop("attempt")
    assert sorted(r.id for r in pages.fetch_all(unordered, "id long").collect()) == [1, 2]


def test_single_records(spark):
    landed = spark.createDataFrame(
        [("a", 200, '{"id": 1, "name": "x"}'), ("b", 404, '{"id": 2}'), ("c", 200, "{"), ("d", 200, "[1]"), ("e", 200, '{"id": "7"}')],
        "endpoint string, status int, body string",
    )
    assert [tuple(r) for r in pages.single_records(landed, "id long, name string").orderBy("endpoint").collect()] == [
        ("a", 1, "x"), ("e", 7, None),
    ]


# --- queries and tables


def test_query_with_bound_values(spark):
    df = spark.createDataFrame([(1, 10.0), (2, 20.0)], "id long, amount double")
    sql = "SELECT id FROM {t} WHERE amount > "
    assert tables.query(spark, sql + ":floor", {"floor": 15}, {"t": df}).collect() == [(2,)]
    assert tables.query(spark, sql + "?", (5,), {"t": df}).count() == 2
    assert tables.query(spark, sql + "?", [99], {"t": df}).columns == ["id"]
    with pytest.raises(AnalysisException):
        tables.query(spark, "SELECT nowhere FROM {t}", None, {"t": df})


def test_jdbc_options():
    assert tables.jdbc_options("u", table="t", fetch_size=5) == {"url": "u", "fetchsize": "5", "dbtable": "t"}
    split = tables.jdbc_options("u", query="select 1", partition=("id", 0, 99, 4))
    assert split["dbtable"] == "(select 1) q" and split["numPartitions"] == "4" and split["upperBound"] == "99"
    with pytest.raises(ValueError):
        tables.jdbc_options("u")


# --- incremental reads


def test_marks(spark, fresh):
    state = fresh("state")
    df = spark.createDataFrame([(1, 1.0), (2, 2.0), (3, 3.0)], "id long, v double")
    assert incremental.read_high_mark(spark, state, "a") is None
    assert incremental.since_mark(df, "id", None) is df
    batch = incremental.MarkedBatch(df.where("id < 3"), "id")
    batch.df.write.parquet(fresh())
    assert (batch.high_mark, batch.rows) == ("2", 2)
    batch.commit(spark, state, "a", "r1")
    assert incremental.read_high_mark(spark, state, "a") == "2"
    assert incremental.read_high_mark(spark, state, "b") is None
    rest = incremental.since_mark(df, "id", "2")
    assert [r.id for r in rest.collect()] == [3]
    nothing = incremental.MarkedBatch(df.where("id > 9"), "id")
    nothing.df.write.parquet(fresh())
    nothing.commit(spark, state, "a", "r2")
    assert incremental.read_high_mark(spark, state, "a") == "2"


def test_look_back(spark):
    df = spark.sql("SELECT timestamp_ntz '2024-01-01' + make_interval(0, 0, 0, id) AS at FROM range(31)")
    assert incremental.look_back(df, "at", "2024-01-31", 7).count() == 8
    assert incremental.look_back(df, "at", "2024-01-31", 0) is df
