import math
import random
from fractions import Fraction

import pytest
from helpers import flight, lines, table
from pyspark.sql import Observation

from flightrank import jobs, sinks, sources
from flightrank.operators import ranking
from flightrank.operators.popularity import airport_counts
from flightrank.plans import questions


def test_popularity_counts_both_ends(spark):
    flights = table(
        spark, flight(), flight(origin="ORD", dest="DFW"), flight(dest="ATL"),
        flight(origin="ATLX"), flight(dest=None),
    )
    assert {r.airport: r.n for r in airport_counts(flights).collect()} == {
        "ATL": 3, "ORD": 2, "DFW": 1
    }
    assert [tuple(r) for r in questions.popular_airports(flights, 2).collect()] == [
        ("ATL", 3), ("ORD", 2)
    ]


def test_popularity_adds_up_to_two_per_flight(spark):
    rows = [flight(origin=f"A{i % 7:02}", dest=f"A{i % 11:02}") for i in range(200)]
    counts = questions.popular_airports(table(spark, *rows), k=None).collect()
    assert sum(r.n for r in counts) == 400
    assert [r.n for r in counts] == sorted((r.n for r in counts), reverse=True)


def test_carriers_both_directions_and_ties_by_code(spark):
    flights = table(
        spark, flight(carrier="BB", arr=1.0), flight(carrier="AA", arr=1.0),
        flight(carrier="CC", arr=-3.0), flight(carrier="CC", arr=2.0), flight(carrier="C", arr=-99.0),
    )
    best = questions.carriers(flights).collect()
    assert [tuple(r) for r in best] == [("CC", -0.5), ("AA", 1.0), ("BB", 1.0)]
    worst = questions.carriers(flights, ascending=False, k=2).collect()
    assert [r.carrier for r in worst] == ["AA", "BB"]


def test_a_group_without_a_delay_is_not_ranked(spark):
    flights = table(spark, flight(carrier="AA", arr=None), flight(carrier="BB", arr=None, dep=3.0),
                    flight(carrier="BB", arr=1.0))
    assert [tuple(r) for r in questions.carriers(flights).collect()] == [("BB", 1.0)]


def test_route_metric_is_an_argument(spark):
    flights = table(spark, flight(carrier="AA", dep=9.0, arr=1.0), flight(carrier="BB", dep=1.0, arr=9.0))
    arrival = questions.carriers_on_route(flights, "ATL", "ORD").collect()
    departure = questions.carriers_on_route(flights, "ATL", "ORD", metric="dep_delay").collect()
    assert [r.carrier for r in arrival] == ["AA", "BB"]
    assert [r.carrier for r in departure] == ["BB", "AA"]


def test_malformed_codes_are_not_ranked_on_a_route(spark):
    flights = table(spark, flight(carrier="A", arr=-99.0), flight(carrier="BB", arr=1.0), flight(origin="ATLX", arr=-5.0))
    assert [r.carrier for r in questions.carriers_on_route(flights, "ATL", "ORD").collect()] == ["BB"]
    assert {r.origin for r in questions.carriers_on_route(flights).collect()} == {"ATL"}


def test_published_answers_can_be_read_back(spark):
    rows = [flight(origin=f"A{i % 3:02}", dest=f"D{i % 5:02}", carrier=f"{i % 7:02}", dep=i / 7, arr=i / 3) for i in range(200)]
    flights = table(spark, *rows)
    asked = {
        "carriers": [], "carriers-from": ["--origin", "A01"], "destinations-from": ["--origin", "A01"],
        "carriers-on-route": ["--origin", "A01", "--dest", "D02"], "popular-airports": [], "route-delays": [],
    }
    for name, options in [*asked.items(), *((n, []) for n in ("carriers-from", "destinations-from", "carriers-on-route"))]:
        args = jobs.checked(jobs.parser().parse_args([name, "--lines", "x", *options]))
        found = jobs.JOBS[name].on_flights(flights, args)
        entity, metric = jobs.JOBS[name].entity(args), jobs.JOBS[name].result
        read = sources.parse_messages(sinks.answer_messages(found, entity, metric)).collect()
        expected = [(" ".join(r[c] for c in entity), float(r[metric])) for r in found.collect()]
        assert sorted(map(tuple, read)) == sorted(expected) and expected


def test_one_airport_equals_its_part_of_all(spark):
    rows = [
        flight(origin=f"A{i % 3:02}", dest=f"D{i % 13:02}", carrier=f"{i % 17:02}", dep=float(i % 29))
        for i in range(2000)
    ]
    flights = table(spark, *rows)
    for question, column in ((questions.carriers_from, "carrier"), (questions.destinations_from, "dest")):
        every = question(flights).collect()
        assert {r.origin for r in every} == {"A00", "A01", "A02"}
        assert max(r["rank"] for r in every) == 10
        one = [r[column] for r in question(flights, "A01").collect()]
        part = sorted((r for r in every if r.origin == "A01"), key=lambda r: r["rank"])
        assert [r[column] for r in part] == one


def test_top_k_per_key_of_a_key_with_a_third_of_all_rows(spark):
    df = spark.range(90_000).selectExpr("if(id % 3 = 0, 0, id) AS k", "cast(id AS double) AS v", "id")
    top = ranking.top_k_per_key(df, ["k"], "v", ["id"], k=3)
    assert [r.id for r in top.filter("k = 0").orderBy("rank").collect()] == [0, 3, 6]
    assert top.count() == 60_000 + 3


def test_rows_are_limited_before_the_shuffle(spark):
    df = spark.range(1000).selectExpr("id % 5 AS k", "id AS v")
    plan = ranking.top_k_per_key(df, ["k"], "v", ["v"])._jdf.queryExecution().executedPlan().toString()
    partial = plan.index("Partial")
    assert plan.index("Final") < plan.index("Exchange") < partial


def test_means_are_reduced_before_the_shuffle(spark):
    flights = table(spark, flight())
    plan = questions.carriers(flights)._jdf.queryExecution().executedPlan().toString()
    assert plan.index("TakeOrderedAndProject") < plan.index("Exchange") < plan.index("partial_sum")


def test_latest_per_key(spark):
    df = spark.createDataFrame(
        [("a", 1, 1, "x"), ("a", 2, 1, "y"), ("a", 2, 2, None), ("b", 1, 1, "z")],
        "k string, t int, id int, v string",
    )
    latest = ranking.latest_per_key(df, ["k"], ["t", "id"])
    assert latest.columns == df.columns
    assert sorted(map(tuple, latest.collect())) == [("a", 2, 2, None), ("b", 1, 1, "z")]


def test_results_of_earlier_jobs(spark):
    text = lines(spark, '"AA"\t2.5', '"BB"\t10.0', '"CC"\t-1.0')
    assert [r.key for r in questions.key_results(text).collect()] == ["BB", "AA", "CC"]
    assert [r.key for r in questions.key_results(text, 1, ascending=True).collect()] == ["CC"]
    text = lines(spark, '"ATL DL"\t4.5', '"ATL AA"\t1.5', '"ORD AA"\t0.5')
    rows = questions.pair_results(text, "origin", "carrier", "mean_delay", "ATL").collect()
    assert [r.carrier for r in rows] == ["AA", "DL"]
    text = lines(
        spark, '"A B 2008-01-02 AM"\t"DL 1 0900 4.0"', '"A B 2008-01-02 AM"\t"AA 2 0800 1.0"',
        '"A B 2008-01-02 PM"\t"AA 3 1800 0.0"',
    )
    rows = questions.best_flight_results(text, "A", "B", "2008-01-02", "AM").collect()
    assert [r.carrier for r in rows] == ["AA", "DL"]


def job(spark, *argv):
    return jobs.answer(spark, jobs.parser().parse_args(argv)).collect()


@pytest.fixture(scope="module")
def line_file(tmp_path_factory):
    from helpers import raw_line

    path = tmp_path_factory.mktemp("lines") / "flights.csv"
    path.write_text(
        "\n".join(
            [
                raw_line(year='"YEAR"'),
                raw_line(),
                raw_line(carrier='"BB"', arr="5", dep="-4.00"),
                raw_line(origin='"ORD"', dest='"LAX"', date="2008-01-07", time='"1300"', arr="1.00"),
            ]
        )
    )
    return str(path)


def test_jobs_from_lines(spark, line_file):
    assert [r.airport for r in job(spark, "popular-airports", "--lines", line_file)] == [
        "ORD", "ATL", "LAX"
    ]
    assert [r.carrier for r in job(spark, "carriers", "--lines", line_file)] == ["AA", "BB"]
    assert [r.carrier for r in job(spark, "carriers", "--lines", line_file, "--legacy-len")] == ["AA"]
    assert [r.carrier for r in job(spark, "carriers-from", "--origin", "ATL", "--lines", line_file)] == [
        "BB", "AA"
    ]
    trip = ["--origin", "ATL", "--stop", "ORD", "--dest", "LAX", "--date", "05/01/2008"]
    assert [(r.leg, r.arr_delay) for r in job(spark, "trip-legs", *trip, "--lines", line_file)] == [
        (1, -2.0), (1, 5.0), (2, 1.0)
    ]
    [best] = job(spark, "trips", "--lines", line_file)
    assert (best.origin, best.stop, best.dest, best.total_delay) == ("ATL", "ORD", "LAX", -1.0)


@pytest.mark.parametrize(
    "argv, wrong",
    [
        (["best-flight", "--lines", "x", "--origin", "ATL", "--dest", "ORD", "--date", "05/01/2008"], "half_day"),
        (["trip-legs", "--lines", "x", "--origin", "ATL"], "needs"),
        (["carriers", "--lines", "x", "--origin", "ATL"], "does not take: origin"),
        (["carriers-from", "--lines", "x", "--descending"], "does not take"),
        (["route-delays", "--results", "x"], "cannot be answered"),
        (["carriers", "--results", "x", "--metric", "arr_delay"], "does not take: metric"),
        (["carriers", "--brokers", "h:1", "--topic", "t"], "out_topic"),
        (["trips", "--brokers", "h:1", "--topic", "t", "--out-topic", "o", "--checkpoint", "c"], "store"),
        (["trips", "--lines", "x", "--date", "2008-01-05"], "does not match"),
        (["carriers", "--lines", "x", "--interval", "1 second"], "only for a stream"),
    ],
)
def test_arguments_that_are_missing_or_would_be_ignored(argv, wrong):
    with pytest.raises(ValueError, match=wrong):
        jobs.checked(jobs.parser().parse_args(argv))
    with pytest.raises(SystemExit):
        jobs.main(argv)


def test_jobs_take_the_arguments_of_a_trip(spark, line_file):
    given = ["trips", "--lines", line_file]
    assert len(job(spark, *given, "--origin", "ATL", "--stop", "ORD", "--date", "05/01/2008")) == 1
    assert job(spark, *given, "--origin", "DFW") == []
    assert job(spark, *given, "--date", "06/01/2008") == []


def test_jobs_report_their_lines(spark, line_file, tmp_path, capsys):
    counts = Observation("lines")
    jobs.answer(spark, jobs.parser().parse_args(["carriers", "--lines", line_file]), counts).collect()
    assert counts.get == {"lines": 4, "short": 0, "headers": 1}
    path = tmp_path / "r.tsv"
    path.write_text('"ATL DL"\t4.5\n"ATL AA"\tx\n')
    counts = Observation("results")
    jobs.answer(spark, jobs.parser().parse_args(["carriers-from", "--results", str(path)]), counts).collect()
    assert counts.get == {"lines": 2, "unreadable": 1}


def test_metric_and_k_act_on_every_job_that_takes_them(spark, line_file):
    by_arrival = job(spark, "carriers-from", "--origin", "ATL", "--lines", line_file, "--metric", "arr_delay")
    assert [r.carrier for r in by_arrival] == ["AA", "BB"]
    assert len(job(spark, "carriers-from", "--origin", "ATL", "--lines", line_file, "--k", "1")) == 1


def test_jobs_from_results(spark, tmp_path):
    path = tmp_path / "r.tsv"
    path.write_text('"ATL DL"\t4.5\n"ATL AA"\t1.5\n"ORD AA"\t0.5\n')
    rows = job(spark, "carriers-from", "--origin", "ATL", "--results", str(path))
    assert [r.carrier for r in rows] == ["AA", "DL"]
    rows = job(spark, "carriers-from", "--results", str(path), "--k", "1")
    assert [(r.origin, r.carrier) for r in rows] == [("ATL", "AA"), ("ORD", "AA")]


@pytest.mark.parametrize("ascending", [True, False])
def test_places_of_a_whole_ranking_with_ties_across_ranges(spark, ascending):
    """A third of the rows tie, so the tie goes on over several ranges."""
    values = [float(i % 40) for i in range(400)] + [7.0] * 300 + [None] * 5 + [math.nan] * 3
    rows = [(f"e{i:04}", v) for i, v in enumerate(values)]
    random.Random(1).shuffle(rows)
    df = spark.createDataFrame(rows, "entity string, m double").repartition(6)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "9")
    try:
        found = ranking.placed(df, "m", ["entity"], ascending).collect()
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
        spark.conf.set("spark.sql.shuffle.partitions", "4")

    def weight(value):  # NULLs first in a rising order, NaN above all numbers
        if value is None:
            return -2.0
        return 1e9 if math.isnan(value) else value

    order = sorted(rows, key=lambda r: (weight(r[1]) * (1 if ascending else -1), r[0]))
    weights = [weight(v) for _, v in order]
    assert sorted((r.place, r.entity, r.tied_place) for r in found) == [
        (i + 1, entity, weights.index(weight(v)) + 1) for i, (entity, v) in enumerate(order)
    ]


def test_places_of_no_rows(spark):
    df = spark.createDataFrame([], "entity string, m double")
    assert ranking.placed(df, "m", ["entity"]).collect() == []


def test_means_do_not_depend_on_how_rows_are_dealt(spark):
    """Hundredths and tenths of minutes, whose doubles add up differently in another order."""
    rng = random.Random(2)
    delays = [round(rng.uniform(-30, 400), 2) for _ in range(3000)]
    rows = [flight(num=str(i), carrier=f"C{i % 3}", arr=d) for i, d in enumerate(delays)]
    exact = {
        f"C{c}": float(sum(Fraction(str(d)) for d in delays[c::3])) / len(delays[c::3]) for c in range(3)
    }
    for partitions in (1, 7, 64):
        dealt = table(spark, *rows).repartition(partitions)
        assert {r.carrier: r.mean_delay for r in ranking.mean_delay(dealt, ["carrier"]).collect()} == exact


def test_means_of_numbers_without_an_exact_place(spark):
    rows = [("a", 1e300), ("a", 2.0), ("b", math.inf), ("b", 1.0), ("c", math.nan), ("d", -0.0), ("e", None)]
    rows += [("f", 0.1), ("f", 0.2), ("g", -1.5), ("g", -2.25)]
    df = spark.createDataFrame(rows, "k string, arr_delay double")
    found = {r.k: r.mean_delay for r in ranking.mean_delay(df, ["k"]).collect()}
    assert math.isnan(found.pop("c"))
    assert found == {"a": 5e299, "b": math.inf, "d": 0.0, "f": 0.15, "g": -1.875}
