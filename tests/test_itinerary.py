import datetime
import itertools
import random

from helpers import flight, table

from flightrank.functions import day_first_date, shift_date
from flightrank.operators import itinerary


def test_dates_roll_over_months_and_leap_days(spark):
    df = spark.createDataFrame(
        [("31/12/2007",), ("28/02/2008",), ("28/02/2007",), ("30/02/2008",), ("2008-01-02",)], "t string"
    )
    day = day_first_date("t")
    assert [tuple(r) for r in df.select(day, shift_date(day, 2)).collect()] == [
        (datetime.date(2007, 12, 31), datetime.date(2008, 1, 2)),
        (datetime.date(2008, 2, 28), datetime.date(2008, 3, 1)),
        (datetime.date(2007, 2, 28), datetime.date(2007, 3, 2)),
        (None, None),
        (None, None),
    ]


def test_noon_counts_as_afternoon(spark):
    flights = table(spark, flight(time="1159"), flight(time="1200"), flight(time="0000"), flight(time=None))
    halves = itinerary.candidates(flights).orderBy("dep_time").collect()
    assert [r.half_day for r in halves] == [None, "AM", "AM", "PM"]


def test_best_flight_per_half_day_with_ties(spark):
    flights = table(
        spark, flight(num="2", arr=1.0), flight(num="1", arr=1.0), flight(num="3", arr=4.0),
        flight(num="4", time="1500", arr=9.0), flight(num="5", time=None, arr=-9.0),
        flight(num="6", carrier="A", arr=-9.0), flight(num="7", origin="ATLX", arr=-9.0),
    )
    best = itinerary.best_flights(flights).collect()
    assert sorted((r.half_day, r.flight_num) for r in best) == [("AM", "1"), ("PM", "4")]


def exchanged_rows(df):
    """How many rows each exchange of an executed plan was given."""
    plan = df._jdf.queryExecution().executedPlan().finalPhysicalPlan()
    found, rest = [], [plan]
    while rest:
        node = rest.pop()
        if node.nodeName() == "Exchange":
            found.append(node.metrics().apply("shuffleRecordsWritten").value())
        children = node.children()
        rest += [children.apply(i) for i in range(children.length())]
        if hasattr(node, "plan") and node.nodeName().startswith("ShuffleQueryStage"):
            rest.append(node.plan())
    return found


def test_a_route_and_day_with_a_third_of_all_flights_sends_one_row_a_task(spark):
    busy = [flight(num=str(i), arr=float(i * 7 % 101), carrier="AB"[i % 2] * 2) for i in range(1000)]
    others = [flight(num=str(i), origin=f"X{i % 50:02}", date=f"2008-02-{1 + i % 28:02}") for i in range(2000)]
    rows = busy + others
    random.Random(3).shuffle(rows)
    flights = spark.createDataFrame(
        spark.sparkContext.parallelize(rows, 6), table(spark).schema
    )
    best = itinerary.best_flights(flights)
    found = best.collect()
    expected = {}
    for num, carrier, origin, dest, day, time, _, arr in rows:
        key = (origin, dest, day, "AM")
        expected[key] = min(expected.get(key, (arr, carrier, num, time)), (arr, carrier, num, time))
    assert sorted((r[:4], r[4:]) for r in map(tuple, found)) == sorted(expected.items())
    [sent] = exchanged_rows(best)
    assert sent <= 6 * len(expected) and sent - 6 <= 2000


def test_a_cancelled_flight_wins_only_on_request(spark):
    flights = table(spark, flight(num="1", arr=None), flight(num="2", arr=3.0))

    def best(**options):
        [row] = itinerary.best_flights(flights, **options).collect()
        return row.flight_num

    assert best() == "2"
    assert best(blank_as_zero=True) == "1"


def test_best_flight_on_date(spark):
    flights = table(
        spark, flight(num="1", arr=2.0), flight(num="2", arr=1.0), flight(num="3", time="1800"),
        flight(num="4", date="2008-01-06"), flight(num="5", dest="LAX"),
    )
    rows = itinerary.best_flight_on_date(flights, "ATL", "ORD", "2008-01-05", "AM").collect()
    assert [r.flight_num for r in rows] == ["2", "1"]


def test_leg_search_labels_and_gap(spark):
    flights = table(
        spark, flight(num="1", arr=5.0), flight(num="2", arr=1.0),
        flight(num="3", origin="ORD", dest="LAX", date="2008-01-07"),
        flight(num="4", origin="ORD", dest="LAX", date="2008-01-06"),
    )

    def legs(**options):
        rows = itinerary.leg_search(flights, "ATL", "ORD", "LAX", "2008-01-05", **options).collect()
        return [(r.leg, r.flight_num) for r in rows]

    assert legs() == [(1, "2"), (1, "1"), (2, "3")]
    assert legs(gap_days=1) == [(1, "2"), (1, "1"), (2, "4")]


def test_trips_equal_the_best_of_all_pairs(spark):
    rng = random.Random(7)
    codes = ["AAA", "BBB", "CCC", "DDD"]
    # A third of all flights end or start at one stop on two dates.
    rows = []
    for i in range(900):
        hot = i % 3 == 0
        origin, dest = rng.choice(codes), rng.choice(codes)
        day = rng.choice([1, 2, 3, 4, 5])
        if hot:
            origin, dest, day = (origin, "AAA", 1) if i % 2 else ("AAA", dest, 3)
        rows.append(
            flight(
                num=str(i), carrier=rng.choice(["X1", "X2"]), origin=origin, dest=dest,
                date=f"2008-01-{day:02}", time=rng.choice(["0600", "1159", "1200", "2200", None]),
                arr=rng.choice([None, *map(float, range(-5, 6))]),
            )
        )

    def usable(r, morning):
        return r[7] is not None and r[5] is not None and (r[5] < "1200") == morning

    best = {}
    gap = datetime.timedelta(days=2)
    for a, b in itertools.product(rows, rows):
        if usable(a, True) and usable(b, False) and a[3] == b[2] and a[4] + gap == b[4]:
            trip = (a[2], a[3], b[3], a[4])
            choice = ((a[7], a[1], a[0], a[5]), (b[7], b[1], b[0], b[5]))
            key = (a[7] + b[7], choice)
            best[trip] = min(best.get(trip, key), key)
    found = {
        (r.origin, r.stop, r.dest, r.flight_date): (
            r.total_delay,
            (
                (r.leg1_arr_delay, r.leg1_carrier, r.leg1_flight_num, r.leg1_dep_time),
                (r.leg2_arr_delay, r.leg2_carrier, r.leg2_flight_num, r.leg2_dep_time),
            ),
        )
        for r in itinerary.two_leg_best(table(spark, *rows)).collect()
    }
    assert found == best


def test_the_join_reads_reduced_legs_once(spark):
    plan = itinerary.two_leg_best(table(spark, flight()))._jdf.queryExecution().executedPlan().toString()
    assert "Aggregate" not in plan
    assert plan.count("FileScan parquet") == 2 and plan.count("PartitionFilters: [isnotnull(half_day") == 2
