import datetime

import pytest
from helpers import flight, lines, raw_line, table
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import Observation
from pyspark.sql import functions as F

from flightrank import jobs, sinks, sources
from flightrank.functions import departure_time, half_day, python_float
from flightrank.schema import FIELDS_FOR


def parsed(spark, *values, **options):
    return sources.parse_flights(lines(spark, *values), **options).collect()


def test_line_to_flight(spark):
    [row] = parsed(spark, raw_line())
    assert row.asDict() == {
        "flight_num": "17", "carrier": "AA", "origin": "ATL", "dest": "ORD",
        "flight_date": datetime.date(2008, 1, 5), "dep_time": "0905",
        "dep_delay": 1.0, "arr_delay": -2.0,
    }


def test_bytes_from_a_topic(spark):
    topic = spark.createDataFrame([(bytearray(raw_line().encode()),), (None,)], "value binary")
    [row] = sources.parse_flights(topic).collect()
    assert row.origin == "ATL"


@pytest.mark.parametrize(
    "text, value, legacy",
    [
        ("", None, None), ("5", 5.0, None), ("5.00", 5.0, 5.0), ("-12.00", -12.0, -12.0),
        ("-5", -5.0, -5.0), ("abc", None, None), ("nan", None, None), ("inf", None, None),
        ("-Infinity", None, None), ("1e999", None, None),
    ],
)
def test_delay_text(spark, text, value, legacy):
    [row] = parsed(spark, raw_line(arr=text))
    assert row.arr_delay == value
    [row] = parsed(spark, raw_line(arr=text), legacy_len=True)
    assert row.arr_delay == legacy


def test_header_and_short_lines_are_left_out_and_counted(spark):
    header = raw_line(year='"YEAR"')
    given_lines = lines(
        spark, header, raw_line(), raw_line(fields=34), raw_line(fields=40), raw_line(fields=44), ""
    )
    counts = Observation("lines")
    kept = sources.parse_flights(given_lines, line_counts=counts)
    assert len(kept.collect()) == 1
    assert counts.get == {"lines": 6, "short": 4, "headers": 1}
    rejected = sources.rejected_lines(given_lines)
    assert sorted(r.n_fields for r in rejected.collect()) == [1, 34, 40, 44]


def test_a_question_needs_only_the_fields_it_reads(spark):
    given_lines = lines(spark, raw_line(year='"YEAR"'), raw_line(fields=34), raw_line(fields=36), raw_line(fields=44))
    counts = Observation("lines")
    kept = sources.parse_flights(given_lines, line_counts=counts, min_fields=FIELDS_FOR["dep_delay"])
    assert [(r.origin, r.dest, r.dep_delay, r.arr_delay) for r in kept.collect()] == [("ATL", "ORD", 1.0, None)] * 2
    assert counts.get == {"lines": 4, "short": 1, "headers": 1}
    rejected = sources.rejected_lines(given_lines, FIELDS_FOR["dep_delay"])
    assert [r.n_fields for r in rejected.collect()] == [34]


def test_fields_behind_the_last_one_read_change_nothing(spark):
    [row] = parsed(spark, raw_line(arr="-2.00") + ",x,,y")
    assert row.arr_delay == -2.0


def test_lines_of_results_are_counted(spark):
    def counts(kind, *values):
        seen = Observation(kind)
        sources.counted_results(lines(spark, *values), kind, seen).collect()
        return seen.get

    assert counts("key", '"ATL"\t12.5', "DFW\tx", "alone", "") == {"lines": 4, "unreadable": 3}
    assert counts("pair", '"ATL DL"\t4.5', "ATL\t1.0", "A B\tbad") == {"lines": 3, "unreadable": 2}
    assert counts("best_flight", '"A B 2008-01-02 AM"\t"DL 1 0900 4.0"', "x") == {"lines": 2, "unreadable": 1}
    assert counts("frequency", "12 ORD", "x y") == {"lines": 2, "unreadable": 1}
    assert counts("message", '["STX", -2.8]', '["a", "b", 1]', '["ATL", "late"]') == {"lines": 3, "unreadable": 2}


def test_city_without_inner_comma_is_a_short_line(spark):
    assert parsed(spark, raw_line(cities=('"Atlanta"', '"Chicago, IL"'))) == []


def test_malformed_codes_stay_for_the_questions_to_judge(spark):
    [row] = parsed(spark, raw_line(origin='"ATLX"', carrier='"A"'))
    assert (row.origin, row.carrier) == ("ATLX", "A")


@pytest.mark.parametrize(
    "text, value",
    [('"955"', "0955"), ('"0005"', "0005"), ('"5"', "0005"), ('""', None), ("", None), ('"9:05"', None), ('"2400"', "2400"),
     ('"2460"', None), ('"1275"', None), ('"9999"', None), ('"2359"', "2359")],
)
def test_departure_time(spark, text, value):
    [row] = parsed(spark, raw_line(time=text))
    assert row.dep_time == value


def test_midnight_ends_its_day(spark):
    df = spark.createDataFrame([("2400",), ("0000",), ("1159",), ("1200",), ("2460",), (None,)], "t string")
    day = F.lit("2008-02-29").cast("date")
    rows = df.select(half_day("t"), departure_time(day, "t").cast("string")).collect()
    assert [tuple(r) for r in rows] == [
        ("PM", "2008-03-01 00:00:00"), ("AM", "2008-02-29 00:00:00"), ("AM", "2008-02-29 11:59:00"),
        ("PM", "2008-02-29 12:00:00"), (None, None), (None, None),
    ]


@pytest.mark.parametrize(
    "number, text",
    [
        (12446097.0, "12446097.0"), (12446097.5, "12446097.5"), (0.0001, "0.0001"), (-2.8, "-2.8"),
        (0.0, "0.0"), (-0.0, "0.0"), (28.142857142857142, "28.142857142857142"), (1e15, "1000000000000000.0"),
        (1.5e-7, "0.00000015"), (123456789012.25, "123456789012.25"), (-1e-4, "-0.0001"), (1e16, "10000000000000000.0"),
        (None, None), (float("nan"), "NaN"), (float("inf"), "Infinity"), (1e30, "1.0E30"),
    ],
)
def test_numbers_as_plain_text(spark, number, text):
    df = spark.createDataFrame([(number,)], "x double")
    assert df.select(python_float("x")).first()[0] == text


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.floats(-1e20, 1e20, allow_nan=False), min_size=1, max_size=200))
def test_numbers_read_back_as_they_were(spark, numbers):
    df = spark.createDataFrame([(x,) for x in numbers], "x double")
    for row in df.select("x", python_float("x").alias("t")).collect():
        assert float(row.t) == row.x
        assert "E" not in row.t or abs(row.x) < 1e-11


def test_bad_date_is_null(spark):
    [row] = parsed(spark, raw_line(date="2008-02-31"))
    assert row.flight_date is None


def test_header_mode_reads_by_name(spark, tmp_path):
    path = tmp_path / "flights.csv"
    path.write_text(
        "ARR_DELAY,ORIGIN,CITY,DEST,CARRIER,FL_NUM,FL_DATE,DEP_TIME,DEP_DELAY\n"
        '5,ATL,"Atlanta, GA",ORD,AA,17,2008-01-05,0905,\n'
    )
    [row] = sources.flights_by_name(spark, str(path)).collect()
    assert tuple(row) == flight(num="17", time="0905", dep=None, arr=5.0)
    [row] = sources.flights_by_name(spark, str(path), legacy_len=True).collect()
    assert row.arr_delay is None


BROKEN = (
    "FL_DATE,CARRIER,FL_NUM,ORIGIN,DEST,DEP_TIME,DEP_DELAY,ARR_DELAY,CITY\n"
    "2008-01-05,AA,1,ATL,ORD,0905,1.5,-2,x\n"
    "2008-01-05,AA,2,ATL,ORD,0905,,,x\n"
    "2008-02-30,AA,3,ATL,ORD,0905,1,2,x\n"
    "2008-01-05,AA,4,ATL,ORD,2575,abc,nan,x\n"
    "2008-01-05,AA,5,ATL,ORD,0905,1,2\n"
    "2008-01-05,AA,6,ATL,ORD,0905,1,2,x,y\n"
    "2008-01-05,AA,7,ATL,ORD,0905,5,2,x\n"
)


def test_rows_that_cannot_be_read_go_to_a_table_of_their_own(spark, tmp_path):
    path = tmp_path / "flights.csv"
    path.write_text(BROKEN)
    counts = Observation("checked")
    good = sources.flights_by_name(spark, str(path), line_counts=counts).collect()
    assert sorted((r.flight_num, r.dep_delay, r.arr_delay) for r in good) == [
        ("1", 1.5, -2.0), ("2", None, None), ("7", 5.0, 2.0)
    ]
    assert counts.get == {"lines": 7, "rejected": 4}
    bad = {r.record: r.problems for r in sources.rejected_by_name(spark, str(path)).collect()}
    lines = BROKEN.splitlines()
    assert bad == {
        lines[3]: ["flight_date: 2008-02-30"],
        lines[4]: ["dep_time: 2575", "dep_delay: abc", "arr_delay: nan"],
        lines[5]: ["number of fields"],
        lines[6]: ["number of fields"],
    }
    legacy = sources.flights_by_name(spark, str(path), legacy_len=True).collect()
    assert sorted((r.flight_num, r.dep_delay, r.arr_delay) for r in legacy) == [
        ("1", 1.5, -2.0), ("2", None, None), ("7", None, None)
    ]


def test_a_row_is_rejected_whichever_columns_are_asked_for(spark, tmp_path):
    path = tmp_path / "flights.csv"
    path.write_text(BROKEN)
    assert sources.flights_by_name(spark, str(path)).select("carrier").count() == 3
    assert sources.rejected_by_name(spark, str(path)).count() == 4


def test_a_csv_without_a_column_says_so(spark, tmp_path):
    path = tmp_path / "flights.csv"
    path.write_text("FL_DATE,CARRIER\n2008-01-05,AA\n")
    with pytest.raises(ValueError, match="ARR_DELAY, DEP_DELAY"):
        sources.flights_by_name(spark, str(path))


def test_a_job_counts_and_writes_the_rows_it_rejects(spark, tmp_path, capsys):
    path, out = tmp_path / "flights.csv", tmp_path / "rejects"
    path.write_text(BROKEN)
    counts = Observation("job")
    args = ["carriers", "--csv", str(path), "--rejects", str(out)]
    [row] = jobs.answer(spark, jobs.parser().parse_args(args), counts).collect()
    assert (row.carrier, row.mean_delay) == ("AA", 0.0) and counts.get == {"lines": 7, "rejected": 4}
    with pytest.raises(ValueError, match="rejects"):
        jobs.checked(jobs.parser().parse_args(["carriers", "--lines", "x", "--rejects", str(out)]))


flights = st.builds(
    flight,
    num=st.from_regex(r"[0-9]{1,4}", fullmatch=True),
    carrier=st.from_regex(r"[A-Z0-9]{2}", fullmatch=True),
    origin=st.from_regex(r"[A-Z]{3}", fullmatch=True),
    dest=st.from_regex(r"[A-Z]{3}", fullmatch=True),
    date=st.dates(datetime.date(1987, 1, 1), datetime.date(2030, 12, 31)).map(str) | st.none(),
    time=st.from_regex(r"([01][0-9]|2[0-3])[0-5][0-9]|2400", fullmatch=True) | st.none(),
    dep=st.floats(-2000, 2000) | st.none(),
    arr=st.floats(-2000, 2000) | st.none(),
)


@settings(max_examples=10, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(flights, min_size=1, max_size=30))
def test_rendered_lines_parse_back(spark, rows):
    rows = [tuple(0.0 if v == 0 else v for v in r) for r in rows]  # no minus zero
    back = sources.parse_flights(sources.render_lines(table(spark, *rows))).collect()
    assert sorted(map(repr, map(tuple, back))) == sorted(map(repr, rows))


def test_key_metric(spark):
    rows = sources.parse_key_metric(lines(spark, '"ATL"\t12.5', "ORD\t-3", "DFW\tx", "alone", ""))
    assert sorted(map(tuple, rows.collect())) == [("ATL", 12.5), ("ORD", -3.0)]


def test_pair_metric(spark):
    given_lines = lines(spark, '"ATL DL"\t4.5', "ATL\t1.0", "A B C\t1.0", "ORD AA\tbad")
    rows = sources.parse_pair_metric(given_lines, "origin", "carrier", "mean_delay")
    assert [r.asDict() for r in rows.collect()] == [
        {"origin": "ATL", "carrier": "DL", "mean_delay": 4.5}
    ]


def test_best_flight_lines(spark):
    good = '"ATL LAX 2008-01-02 AM"\t"DL 123 0900 -4.0"'
    rows = sources.parse_best_flights(lines(spark, good, '"ATL LAX AM"\t"DL 123 0900 -4.0"', "x"))
    assert [tuple(r) for r in rows.collect()] == [
        ("ATL", "LAX", "2008-01-02", "AM", "DL", 123.0, "0900", -4.0)
    ]


def test_frequencies(spark):
    rows = sources.parse_frequencies(lines(spark, "12446097 ORD", "7721141\tLAX", "", "x y"))
    assert [tuple(r) for r in rows.collect()] == [(12446097.0, "ORD"), (7721141.0, "LAX")]


def test_messages(spark):
    given_lines = lines(
        spark, '["STX", -2.8]', "('ATL', 67787)", '["a", "b", 1]', '["ATL", "late"]', '["ATL"]'
    )
    assert [tuple(r) for r in sources.parse_messages(given_lines).collect()] == [
        ("STX", -2.8), ("ATL", 67787.0)
    ]


def test_message_form(spark):
    df = spark.createDataFrame(
        [('A"B', 2.0, 3, None), ("ST\\X", -2.8, None, "x")], "a string, b double, c int, d string"
    )
    import json

    values = [json.loads(r.value) for r in sinks.messages(df).collect()]
    assert values == [['A"B', 2.0, 3, None], ["ST\\X", -2.8, None, "x"]]


def test_records_keep_only_rows_with_an_airport(spark, tmp_path):
    path = tmp_path / "r.csv"
    path.write_text("Airport,Carrier,Delay\nATL,DL,1.5\nATLX,DL,2.5\n,DL,1\n")
    rows = sources.read_records(spark, "average-airport-delay-for-each-airport", str(path))
    assert [r.asDict() for r in rows.collect()] == [
        {"airport": "ATL", "carrier": "DL", "average_departure_delay": 1.5}
    ]


def test_records_that_cannot_be_read_are_told_apart(spark, tmp_path):
    path = tmp_path / "r.csv"
    path.write_text("Airport,Carrier,Delay\nATL,DL,1.5\nATLX,DL,2.5\nATL,DL,x\nORD,DL,\nATL,DL\n")
    table, counts = "average-airport-delay-for-each-airport", Observation("records")
    rows = sources.read_records(spark, table, str(path), line_counts=counts).collect()
    assert sorted(map(tuple, rows)) == [("ATL", "DL", 1.5), ("ORD", "DL", None)]
    assert counts.get == {"lines": 5, "rejected": 3}
    bad = {r.record: r.problems for r in sources.rejected_records(spark, table, str(path)).collect()}
    assert bad == {
        "ATLX,DL,2.5": ["airport: no airport"],
        "ATL,DL,x": ["average_departure_delay: x"],
        "ATL,DL": ["number of fields"],
    }
    bare = tmp_path / "bare.csv"
    bare.write_text("ATL,DL,1.5\nATL,DL,y\n")
    assert sources.read_records(spark, table, str(bare), header=False).count() == 1
    assert sources.rejected_records(spark, table, str(bare), header=False).count() == 1


def test_messages_of_a_batch_that_ran_twice_are_read_once(spark):
    rows = [("ATL AA", 1.5), ("ATL BB", -2.0)]
    results = spark.createDataFrame(rows, "entity string, delay double")
    sent = [sinks.batch_messages(results, ["entity"], "delay", i) for i in (0, 0, 1)]
    messages = sent[0].unionByName(sent[1]).unionByName(sent[2].limit(1))
    assert {r.key for r in messages.collect()} == {"ATL AA", "ATL BB"}
    read = sources.parse_batch_messages(messages)
    assert sorted(map(tuple, read.collect())) == [(0, "ATL AA", 1.5), (0, "ATL BB", -2.0), (1, "ATL AA", 1.5)]
    plain = sources.parse_messages(messages).collect()
    assert len(plain) == 5 and {r.key for r in plain} == {"ATL AA", "ATL BB"}


def test_report_lines(spark, tmp_path):
    flights = table(spark, flight(num="17", arr=-2.5), flight(num="18", time=None, arr=3.0))
    sinks.write_report(flights, str(tmp_path / "report"))
    assert sorted(r.value for r in spark.read.text(str(tmp_path / "report")).collect()) == [
        "ATL -> ORD on 2008-01-05: Flight: AA 17 at 0900. Arrival Delay: -2.5",
        "ATL -> ORD on 2008-01-05: Flight: AA 18 at None. Arrival Delay: 3.0",
    ]


def test_csv_in_one_file(spark, tmp_path):
    df = spark.range(100).repartition(4)
    sinks.write_csv(df, str(tmp_path / "one"), one_file=True)
    assert len(list((tmp_path / "one").glob("part-*.csv"))) == 1
    assert spark.read.option("header", True).csv(str(tmp_path / "one")).count() == 100
