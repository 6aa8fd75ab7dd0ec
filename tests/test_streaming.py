import datetime
import os
import random

import pytest
from helpers import flight, lines, raw_line, table

from flightrank import jobs, sinks, sources, streaming
from flightrank.operators import itinerary
from flightrank.plans import questions
from flightrank.schema import FLIGHT


@pytest.fixture
def feed(spark, tmp_path):
    """Give flights file by file; the stream takes them in that order, one per batch."""
    folder = tmp_path / "feed"
    folder.mkdir()

    def make(*batches):
        for i, rows in enumerate(batches):
            part = tmp_path / f"part{i}"
            table(spark, *rows).coalesce(1).write.parquet(str(part))
            [file] = part.glob("part-*.parquet")
            target = folder / f"{i:03}.parquet"
            file.rename(target)
            os.utime(target, (1_700_000_000 + i, 1_700_000_000 + i))
        return sources.file_stream(spark, str(folder), FLIGHT, max_files_per_trigger=1)

    return make


def some_flights(n, days, seed=1):
    rng = random.Random(seed)
    codes = ["AAA", "BBB", "CCC"]
    return [
        flight(
            num=str(i), carrier=rng.choice(["X1", "X2", "X3"]), origin=rng.choice(codes),
            dest=rng.choice(codes), date=f"2008-01-{rng.choice(days):02}",
            time=rng.choice(["0600", "1130", "1200", "2200"]), dep=float(rng.randint(-5, 9)),
            arr=float(rng.randint(-5, 9)),
        )
        for i in range(n)
    ]


def as_rows(df):
    return sorted(map(repr, map(tuple, df.collect())))


def test_running_rankings_equal_the_batch_over_all_files(spark, feed):
    batches = [some_flights(80, [1, 2], seed) for seed in range(3)]
    flights = feed(*batches)
    everything = table(spark, *sum(batches, []))
    popular = streaming.drain_latest(streaming.running_popularity(flights))
    assert as_rows(popular) == as_rows(questions.popular_airports(everything))
    carriers = streaming.drain_latest(streaming.running_carriers(flights))
    assert as_rows(carriers) == as_rows(questions.carriers(everything))


def test_each_micro_batch_is_ranked_on_its_own(spark, feed):
    batches = [some_flights(50, [1], seed) for seed in range(3)]
    ranked = streaming.drain_ranked(feed(*batches), questions.carriers_from)
    for i, rows in enumerate(batches):
        expected = questions.carriers_from(table(spark, *rows))
        assert as_rows(ranked.filter(ranked.batch_id == i).drop("batch_id")) == as_rows(expected)


def test_windows_close_with_the_watermark_and_late_rows_are_dropped(spark, feed):
    stream = feed(
        [flight(time="0900"), flight(time="0930"), flight(time="1010")],
        [flight(time="1300")],
        [flight(time="1301")],  # closes the windows up to 12:00
        [flight(time="0905"), flight(time="1305")],  # 09:05 comes too late
        [flight(time="2000")],
    )
    windows = streaming.drain_appended(streaming.windowed_popularity(stream, "1 hour", "1 hour"))
    found = sorted((r.window_start.strftime("%H%M"), r.airport, r.n) for r in windows.collect())
    assert found == [
        ("0900", "ATL", 2), ("0900", "ORD", 2),
        ("1000", "ATL", 1), ("1000", "ORD", 1),
        ("1300", "ATL", 3), ("1300", "ORD", 3),
    ]


def test_open_windows_are_in_the_result_and_late_rows_are_not(spark, feed):
    stream = feed(
        [flight(time="0900"), flight(time="0930")],
        [flight(time="1300")],
        [flight(time="1301")],
        [flight(time="0905"), flight(time="1305")],  # 09:05 comes too late
        [flight(time="2000"), flight(time=None)],
    )
    windows = streaming.drain_updated(
        streaming.windowed_popularity(stream, "1 hour", "1 hour"), ["window_start", "airport"]
    )
    found = sorted((r.window_start.strftime("%H%M"), r.n) for r in windows.filter("airport = 'ATL'").collect())
    assert found == [("0900", 2), ("1300", 3), ("2000", 1)]


def test_trips_of_all_days_whatever_batch_their_legs_come_in(spark, feed):
    batches = [some_flights(60, [2 * i + 1, 2 * i + 2], seed=i) for i in range(4)]
    everything = itinerary.two_leg_best(table(spark, *sum(batches, [])))
    assert as_rows(streaming.drain_trips(feed(*batches))) == as_rows(everything)
    assert everything.count() > 0


def test_a_job_publishes_trips_as_their_legs_come(spark, tmp_path):
    """Two legs in two files, one trip; a better second leg later changes it."""
    folder, store = tmp_path / "in", str(tmp_path / "store")
    args = jobs.parser().parse_args(
        ["trips", "--brokers", "none", "--topic", "t", "--out-topic", "o", "--checkpoint", str(tmp_path / "c"),
         "--store", store, "--origin", "ATL"]
    )
    published = []

    def publish(answer, entity, metric):
        def write(batch, batch_id):
            rows = sources.parse_messages(sinks.answer_messages(answer(batch), entity, metric)).collect()
            published.append([tuple(r) for r in rows])

        return write

    def run(*values):
        lines(spark, *values).coalesce(1).write.mode("append").text(str(folder))
        writer = jobs.stream(spark, args, sources.text_stream(spark, str(folder)), publish)
        writer.trigger(availableNow=True).start().awaitTermination()

    run(raw_line())
    run(raw_line(origin='"ORD"', dest='"LAX"', date="2008-01-07", time='"1300"', arr="1.00"))
    second = dict(origin='"ORD"', dest='"LAX"', date="2008-01-07", time='"1400"')
    run(raw_line(carrier='"BB"', arr="-2.00", **second), raw_line(origin='"SEA"', date="2008-01-07"))
    key = "ATL ORD LAX 2008-01-05"
    assert [p for p in published if p] == [[(key, -1.0)], [(key, -4.0)]]


def test_a_fit_is_about_all_flights_so_far(spark, tmp_path):
    folder = tmp_path / "in"
    args = jobs.parser().parse_args(
        ["popularity-fit", "--brokers", "none", "--topic", "t", "--out-topic", "o", "--checkpoint", str(tmp_path / "c")]
    )
    tails = []

    def publish(answer, entity, metric):
        return lambda batch, batch_id: tails.append(answer(batch).first().n_tail)

    for codes in (["AAA", "BBB", "BBB"], ["CCC", "CCC", "CCC", "CCC"]):
        rows = [raw_line(origin=f'"{c}"', dest='"ZZZ"') for c in codes]
        lines(spark, *rows).coalesce(1).write.mode("append").text(str(folder))
        writer = jobs.stream(spark, args, sources.text_stream(spark, str(folder)), publish)
        writer.trigger(availableNow=True).start().awaitTermination()
    assert len(tails) == 2 and tails[1] >= tails[0]


def test_line_counts_of_a_stream_are_in_its_progress(spark, tmp_path):
    folder = str(tmp_path / "in")
    lines(spark, raw_line(year="YEAR"), raw_line(), raw_line(fields=30)).coalesce(1).write.text(folder)
    stream = sources.parse_flights(sources.text_stream(spark, folder), line_counts="flight_lines")
    query = (
        stream.writeStream.format("noop").option("checkpointLocation", str(tmp_path / "c"))
        .trigger(availableNow=True).start()
    )
    query.awaitTermination()
    seen = [p["observedMetrics"]["flight_lines"] for p in query.recentProgress if p["observedMetrics"]]
    assert [r.asDict() for r in seen] == [{"lines": 3, "short": 1, "headers": 1}]


def test_trips_stream_equals_the_batch_on_closed_days(spark, feed):
    batches = [some_flights(60, [2 * i + 1, 2 * i + 2], seed=i) for i in range(4)]
    stream = feed(*batches)
    trips = streaming.drain_appended(streaming.two_leg_stream(stream))
    everything = itinerary.two_leg_best(table(spark, *sum(batches, [])))
    # The last day is still open: no flight a day later has been seen.
    closed = everything.filter("flight_date <= date'2008-01-05'")
    assert as_rows(trips) == as_rows(closed)
    assert trips.count() > 0


def test_upsert_keeps_the_latest_result_per_key(spark, feed):
    stream = feed(
        [flight(carrier="AA", arr=1.0), flight(carrier="BB", arr=5.0)],
        [flight(carrier="AA", arr=7.0)],
        [flight(carrier="CC", arr=1.0)],
    )
    kept = streaming.drain_upserted(stream, ["carrier"], questions.carriers)
    assert sorted((r.carrier, r.mean_delay, r.batch_id) for r in kept.collect()) == [
        ("AA", 7.0, 1), ("BB", 5.0, 0), ("CC", 1.0, 2)
    ]


def test_a_batch_that_runs_again_changes_nothing(spark, tmp_path):
    path = str(tmp_path / "store")
    write = streaming.upsert_results(path, ["carrier"], questions.carriers)
    write(table(spark, flight(carrier="AA", arr=1.0)), 0)
    for _ in range(2):
        write(table(spark, flight(carrier="AA", arr=2.0)), 1)
    rows = streaming.read_latest(spark, path).collect()
    assert [(r.carrier, r.mean_delay, r.batch_id) for r in rows] == [("AA", 2.0, 1)]


def test_a_store_of_another_run_is_refused(spark, tmp_path):
    path = str(tmp_path / "store")
    write = streaming.upsert_results(path, ["carrier"], questions.carriers)
    for i in range(3):
        write(table(spark, flight(arr=float(i))), i)
    with pytest.raises(ValueError, match="another run"):
        write(table(spark, flight(arr=9.0)), 0)
    assert [r.mean_delay for r in streaming.read_latest(spark, path).collect()] == [2.0]


def test_a_reset_after_one_batch_replaces_it(spark, tmp_path):
    path = str(tmp_path / "store")
    write = streaming.upsert_results(path, ["carrier"], questions.carriers)
    write(table(spark, flight(carrier="AA")), 0)
    write(table(spark, flight(carrier="BB")), 0)
    assert [r.carrier for r in streaming.read_latest(spark, path).collect()] == ["BB"]


def test_a_store_keeps_a_bounded_number_of_folders(spark, tmp_path):
    path = tmp_path / "store"
    write = streaming.upsert_results(str(path), ["carrier"], questions.carriers, buckets=4)
    for i in range(15):
        write(table(spark, flight(carrier=f"{i % 8:02}", arr=float(i))), i)
        if i == 12:  # runs again
            write(table(spark, flight(carrier=f"{i % 8:02}", arr=float(i))), i)
    rows = streaming.read_latest(spark, str(path)).collect()
    assert {r.carrier: r.mean_delay for r in rows} == {
        f"{c:02}": float(max(i for i in range(15) if i % 8 == c)) for c in range(8)
    }
    # Each of the four buckets in its newest folder and, until the next batch, the one before.
    assert len(list(path.glob("step=*/store_part=*"))) <= 5
    assert len(list(path.glob("step=*"))) <= 6


def day_of(i):
    return f"2008-{1 + i // 28:02}-{1 + i % 28:02}"


def size_of(folder):
    return sum(f.stat().st_size for f in folder.rglob("*.parquet"))


def test_a_batch_writes_its_own_parts_only(spark, tmp_path):
    """Thirty batches with a day each: what a batch writes does not grow with the store."""
    path = tmp_path / "store"
    write = streaming.upsert_results(str(path), streaming.LEG, by="flight_date")
    sizes = []
    for i in range(30):
        rows = [flight(num=str(n), origin=f"A{n:02}", date=day_of(i), arr=float(n)) for n in range(40)]
        write(itinerary.best_flights(table(spark, *rows)), i)
        sizes.append(size_of(path / f"step={i}"))
    assert max(sizes) <= 1.1 * min(sizes)
    assert streaming.read_latest(spark, str(path)).count() == 30 * 40
    late = itinerary.best_flights(table(spark, flight(origin="A07", date=day_of(3), arr=-5.0)))
    write(late, 30)
    assert size_of(path / "step=30") <= 1.1 * max(sizes)
    [row] = streaming.read_latest(spark, str(path), [day_of(3)]).filter("origin = 'A07'").collect()
    assert (row.arr_delay, row.batch_id) == (-5.0, 30)
    assert streaming.read_latest(spark, str(path)).count() == 30 * 40


def windows_of(df):
    return sorted((r.window_start.strftime("%d %H%M"), r.airport, r.n) for r in df.collect())


def late_feed(feed):
    return feed(
        [flight(time="0900"), flight(time="0930"), flight(time="1010")],
        [flight(time="1300"), flight(time=None)],
        [flight(time="1301"), flight(time="0955")],
        [flight(time="0905", num="late"), flight(time="1305")],
        [flight(date="2008-01-06", time="0000"), flight(time="1210")],
        [flight(time="1210", num="late"), flight(origin="ATLX", time="1210")],
    )


def test_windows_and_their_late_rows_hold_every_row(spark, feed, tmp_path):
    folder = str(tmp_path / "windows")
    write = streaming.count_windows(folder, "1 hour", "1 hour")
    streaming.run_to_end(late_feed(feed).writeStream.foreachBatch(write), str(tmp_path / "run"))
    late = streaming.read_late(spark, folder)
    assert {(r.flight_num, r.window_start.strftime("%H%M"), r.batch) for r in late.collect()} >= {
        ("late", "0900", 3), ("late", "1200", 5)
    }
    total = sum(r.n for r in streaming.read_windows(spark, folder).collect()) + late.count()
    assert total == 2 * 11


def test_windows_count_the_rows_that_come_in_time(spark, feed, tmp_path):
    folder = str(tmp_path / "windows")
    write = streaming.count_windows(folder, "1 hour", "1 hour")
    streaming.run_to_end(late_feed(feed).writeStream.foreachBatch(write), str(tmp_path / "run"))
    # Watermarks: none, 09:10, 12:00, 12:01, 12:05 and then 23:00 of the day.
    assert windows_of(streaming.read_windows(spark, folder).filter("airport = 'ATL'")) == [
        ("05 0900", "ATL", 2), ("05 1000", "ATL", 1), ("05 1200", "ATL", 1), ("05 1300", "ATL", 3),
        ("06 0000", "ATL", 1),
    ]


def test_a_batch_of_windows_that_runs_again_counts_once(spark, tmp_path):
    folder = str(tmp_path / "windows")
    write = streaming.count_windows(folder, "1 hour", "1 hour")
    write(table(spark, flight(time="0900"), flight(time="1400")), 0)
    for _ in range(2):
        write(table(spark, flight(time="0930"), flight(time="1410")), 1)
    assert windows_of(streaming.read_windows(spark, folder).filter("airport = 'ATL'")) == [
        ("05 0900", "ATL", 1), ("05 1400", "ATL", 2)
    ]
    assert streaming.read_late(spark, folder).count() == 2


def test_a_rate_gives_each_batch_a_fixed_number_of_files(spark, tmp_path):
    folder = tmp_path / "in"
    for i in range(7):
        lines(spark, raw_line(num=f'"{i}"')).coalesce(1).write.mode("append").text(str(folder))
    stream = sources.text_stream(spark, str(folder), max_files_per_trigger=3)
    ranked = streaming.drain_ranked(sources.parse_flights(stream), lambda f: f.groupBy().count())
    assert sorted((r.batch_id, r["count"]) for r in ranked.collect()) == [(0, 3), (1, 3), (2, 1)]


def test_messages_of_a_stream_that_fails_between_sending_and_its_commit(spark, tmp_path):
    """The batch is sent, then the query fails; its successor sends it again."""
    folder, log = str(tmp_path / "in"), str(tmp_path / "log")
    lines(spark, raw_line(), raw_line(carrier='"BB"', arr="4.00")).coalesce(1).write.text(folder)
    send = streaming.publish_messages(streaming.to_files(log), questions.carriers, ["carrier"], "mean_delay")
    failed = []

    def fails_once(batch, batch_id):
        send(batch, batch_id)
        if not failed:
            failed.append(batch_id)
            raise RuntimeError("lost")

    def run():
        flights = sources.parse_flights(sources.text_stream(spark, folder))
        streaming.run_to_end(flights.writeStream.foreachBatch(fails_once), str(tmp_path / "run"))

    with pytest.raises(Exception, match="lost"):
        run()
    run()
    sent = spark.read.parquet(log)
    assert sent.count() == 4
    read = sources.parse_batch_messages(sent).collect()
    assert sorted(map(tuple, read)) == [(0, "AA", -2.0), (0, "BB", 4.0)]


def test_a_half_written_batch_is_not_seen(spark, tmp_path):
    path = tmp_path / "store"
    write = streaming.upsert_results(str(path), ["carrier"], questions.carriers)
    for i in range(2):
        write(table(spark, flight(arr=float(i))), i)
    (path / "step=1" / "_SUCCESS").unlink()
    assert [r.mean_delay for r in streaming.read_latest(spark, str(path)).collect()] == [0.0]
    write(table(spark, flight(arr=7.0)), 1)
    assert [r.mean_delay for r in streaming.read_latest(spark, str(path)).collect()] == [7.0]


def test_parts_are_dates_or_whole_numbers_of_the_key(spark, tmp_path):
    with pytest.raises(ValueError, match="no key"):
        streaming.upsert_results(str(tmp_path), ["carrier"], by="flight_date")
    with pytest.raises(ValueError, match="neither"):
        streaming.upsert_results(str(tmp_path / "s"), ["carrier"], by="carrier")(table(spark, flight()), 0)


def test_results_without_a_day_are_kept_and_a_batch_without_rows_is_one(spark, tmp_path):
    path = str(tmp_path / "store")
    write = streaming.upsert_results(path, ["flight_date", "origin"], by="flight_date")
    write(table(spark), 0)
    assert streaming.read_latest(spark, path).collect() == []
    write(table(spark, flight(date=None, arr=1.0), flight()), 1)
    write(table(spark, flight(date=None, arr=2.0)), 2)
    rows = streaming.read_latest(spark, path).collect()
    assert sorted((str(r.flight_date), r.arr_delay, r.batch_id) for r in rows) == [
        ("2008-01-05", 0.0, 1), ("None", 2.0, 2)
    ]


@pytest.mark.parametrize("again", [False, True])
def test_trips_of_many_batches_read_a_constant_number_of_legs(spark, tmp_path, monkeypatch, again):
    """One day a batch: a batch reads that day and those two days before and after, no others."""
    from flightrank.streaming import run, store

    path, read, published = str(tmp_path / "store"), [], {}
    real = store._read

    def counted(spark, path, held):
        rows = real(spark, path, held)
        read[-1] += rows.count()
        return rows

    monkeypatch.setattr(store, "_read", counted)

    def publish(trips, batch_id):
        for r in trips.collect():
            published[r.origin, r.stop, r.dest, r.flight_date] = tuple(r)

    write = run.publish_trips(path, publish, keep_days=1)
    batches = [some_flights(30, [1], seed=i) for i in range(12 if again else 30)]
    batches = [[(*f[:4], datetime.date.fromisoformat(day_of(i)), *f[5:]) for f in rows] for i, rows in enumerate(batches)]
    for i, rows in enumerate(batches):
        read.append(0)
        legs = itinerary.best_flights(table(spark, *rows))
        write(legs, i)
        if again and i % 7 == 3:
            write(legs, i)
    if not again:
        assert max(read[10:]) <= 1.5 * (sum(read[5:10]) / 5)
    monkeypatch.undo()
    expected = itinerary.two_leg_best(table(spark, *sum(batches, []))).collect()
    assert sorted(map(repr, published.values())) == sorted(map(repr, map(tuple, expected))) and expected
    held = {r.flight_date for r in streaming.read_latest(spark, path).select("flight_date").collect()}
    assert len(held) <= 5


def test_an_empty_store_says_so(spark, tmp_path):
    with pytest.raises(ValueError, match="no results"):
        streaming.read_latest(spark, str(tmp_path / "none"))


def test_a_restarted_stream_goes_on_where_it_stopped(spark, tmp_path):
    folder, out, checkpoint = (str(tmp_path / n) for n in ("in", "out", "checkpoint"))

    def run():
        stream = sources.parse_flights(sources.text_stream(spark, folder))
        query = (
            stream.writeStream.foreachBatch(streaming.write_batches(out, questions.popular_airports))
            .option("checkpointLocation", checkpoint)
            .trigger(availableNow=True)
            .start()
        )
        query.awaitTermination()

    lines(spark, raw_line(year="YEAR"), raw_line()).coalesce(1).write.text(folder)
    run()
    lines(spark, raw_line(origin='"DFW"')).coalesce(1).write.mode("append").text(folder)
    run()
    rows = spark.read.parquet(out).collect()
    assert sorted((r.batch_id, r.airport, r.n) for r in rows) == [
        (0, "ATL", 1), (0, "ORD", 1), (1, "DFW", 1), (1, "ORD", 1)
    ]


def test_an_empty_stream_has_an_empty_result(spark, feed):
    result = streaming.drain_latest(streaming.running_popularity(feed([])))
    assert result.collect() == []
    ranked = streaming.drain_ranked(feed_nothing(spark, feed), questions.popular_airports)
    assert ranked.collect() == [] and ranked.columns == ["airport", "n", "batch_id"]
    kept = streaming.drain_upserted(feed_nothing(spark, feed), ["carrier"], questions.carriers)
    assert kept.collect() == [] and kept.columns == ["carrier", "mean_delay", "batch_id"]


def feed_nothing(spark, feed):
    return sources.file_stream(spark, f"{spark.conf.get('spark.checkpoint.dir')}/no[p]e", FLIGHT)


def test_kafka_without_its_connector_says_so(spark):
    with pytest.raises(Exception, match="(?i)kafka"):
        sources.kafka_lines(spark, "localhost:9092", "flights", 100)
