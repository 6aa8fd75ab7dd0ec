"""Every query by name, over the given tables. Each takes (spark, sf_dir)."""

from __future__ import annotations

import functools
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from flightrank import sinks, sources, streaming
from flightrank.functions import (
    clock_time,
    day_first_date,
    departure_time,
    half_day,
    python_float,
    shift_date,
)
from flightrank.operators import distribution, itinerary, ranking
from flightrank.plans import questions
from flightrank.plans.adapters import event_flights, event_stream, flights, table
from flightrank.schema import ALL_FIELDS, MIN_FIELDS
from flightrank.session import shared_folder

Query = Callable[[SparkSession, str], DataFrame]

# Arguments of the queries that ask about one airport, route or trip.
ORIGIN, DEST = "N09", "N11"
TRIP = ("N06", "N09", "N04", "1995-10-06")


def _dates_as_text(df: DataFrame) -> DataFrame:
    """Dates as ``yyyy-MM-dd`` and times as ``yyyy-MM-dd HH:mm:ss`` text, as in the result files."""
    pattern = {T.DateType(): "yyyy-MM-dd", T.TimestampType(): "yyyy-MM-dd HH:mm:ss"}
    return df.select(
        *[
            F.date_format(f.name, pattern[f.dataType]).alias(f.name) if f.dataType in pattern else f.name
            for f in df.schema.fields
        ]
    )


def _on_flights(question: Callable[[DataFrame], DataFrame]) -> Query:
    return lambda spark, sf_dir: _dates_as_text(question(flights(spark, sf_dir)))


def _on_stream(answer: Callable[[DataFrame], DataFrame]) -> Query:
    """Raw lines of the event flights as a stream, parsed and answered."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        lines = sources.render_lines(event_flights(event_stream(spark, sf_dir)))
        return _dates_as_text(answer(sources.parse_flights(lines)))

    return run


def _popularity_full_ranking(all_flights: DataFrame) -> DataFrame:
    return questions.popular_airports(all_flights, k=None).withColumn("n_text", python_float("n"))


def _carrier_arrival_parity(all_flights: DataFrame) -> DataFrame:
    lines = sources.render_lines(all_flights, whole_minutes=True)
    return questions.carriers(sources.parse_flights(lines, legacy_len=True))


def _parse_flight_csv(all_flights: DataFrame) -> DataFrame:
    return sources.parse_flights(sources.render_lines(all_flights))


def _parse_flight_rejects(all_flights: DataFrame) -> DataFrame:
    """Flight lines cut after 40 fields where the flight did not arrive, then sorted out."""
    lines = sources.render_lines(all_flights)
    blank_end = F.col("value").endswith(",")
    cut = F.when(blank_end, F.substring_index("value", ",", 40)).otherwise(F.col("value"))
    rejected = sources.rejected_lines(lines.select(cut.alias("value")), ALL_FIELDS)
    number = F.replace(F.get(F.split("value", ","), F.lit(10)), F.lit('"'), F.lit(""))
    return rejected.select(
        number.alias("flight_num"), F.col("n_fields").cast("bigint").alias("n_fields")
    )


def _popular_from_short_lines(all_flights: DataFrame) -> DataFrame:
    """Airports of lines cut after 34, 36 or 44 fields, or not at all, by the flight's number."""
    lines = sources.render_lines(all_flights)
    number = F.replace(F.get(F.split("value", ","), F.lit(10)), F.lit('"'), F.lit("")).cast("bigint")
    cut = F.col("value")
    for rest, fields in enumerate((34, 36, 44)):
        cut = F.when(number % 4 == rest, F.substring_index("value", ",", fields)).otherwise(cut)
    flights = sources.parse_flights(lines.select(cut.alias("value")), min_fields=MIN_FIELDS)
    return questions.popular_airports(flights, k=None)


def _route_carriers_with_malformed_codes(all_flights: DataFrame) -> DataFrame:
    """Best carriers of every route where some flights have a carrier or origin of a wrong length."""
    number = F.col("flight_num").cast("bigint")
    flights = all_flights.withColumns(
        {
            "carrier": F.when(number % 7 == 0, F.substring("carrier", 1, 1)).otherwise(F.col("carrier")),
            "origin": F.when(number % 11 == 0, F.concat("origin", F.lit("X"))).otherwise(F.col("origin")),
        }
    )
    return questions.carriers_on_route(flights)


def _odd_departure_times(all_flights: DataFrame) -> DataFrame:
    """Departure times, some of them 2400, 2460, 1275 or 9999, with half of the day and event time."""
    number = F.col("flight_num").cast("bigint")
    odd = F.get(F.array(*map(F.lit, ("2400", "2460", "1275", "9999", "5"))), (number % 10).cast("int"))
    given = all_flights.select("flight_num", "flight_date", F.coalesce(odd, "dep_time").alias("text"))
    timed = given.withColumn("dep_time", clock_time("text"))
    return timed.select(
        "flight_num",
        "text",
        "dep_time",
        half_day("dep_time").alias("half_day"),
        departure_time("flight_date", "dep_time").alias("departed"),
    )


def _mean_texts(all_flights: DataFrame) -> DataFrame:
    """Means that are no whole numbers, small and large, as text."""
    means = ranking.mean_delay(all_flights, ["origin", "carrier"], "arr_delay")
    scaled = F.floor(F.col("mean_delay") * 64) / 64
    return means.select(
        "origin",
        "carrier",
        python_float(scaled).alias("mean_text"),
        python_float(scaled / 1024).alias("small_text"),
        python_float(scaled * 16777216).alias("large_text"),
    )


def _all_result_messages(all_flights: DataFrame) -> DataFrame:
    """The messages of the rankings of carriers, destinations and routes, written and read back
    as a stream's are."""
    answers = {
        "carriers": (questions.carriers(all_flights), ["carrier"]),
        "carriers_from": (questions.carriers_from(all_flights, ORIGIN), ["carrier"]),
        "carriers_from_all": (questions.carriers_from(all_flights), ["origin", "carrier"]),
        "destinations_from": (questions.destinations_from(all_flights, ORIGIN), ["dest"]),
        "destinations_from_all": (questions.destinations_from(all_flights), ["origin", "dest"]),
        "carriers_on_route": (questions.carriers_on_route(all_flights, ORIGIN, DEST), ["carrier"]),
        "carriers_on_route_all": (questions.carriers_on_route(all_flights), ["origin", "dest", "carrier"]),
    }
    read = [
        sources.parse_messages(sinks.answer_messages(rows, entity, "mean_delay")).withColumn("question", F.lit(name))
        for name, (rows, entity) in answers.items()
    ]
    return functools.reduce(DataFrame.unionByName, read)


def _fractional_means(all_flights: DataFrame) -> DataFrame:
    """Means of delays with hundredths of a minute, over flights dealt out in two ways."""
    cents = F.col("flight_num").cast("bigint") % 100
    delays = all_flights.withColumn("arr_delay", (F.col("arr_delay") * 100 + cents) / 100)

    def means(dealt: DataFrame, name: str) -> DataFrame:
        return ranking.mean_delay(dealt, ["origin", "carrier"]).withColumnRenamed("mean_delay", name)

    one_way = means(delays.repartition(64, "flight_num"), "mean_by_number")
    return one_way.join(means(delays.repartition(5, "flight_date"), "mean_by_day"), ["origin", "carrier"])


def _latest_through_store(days: int) -> Query:
    """The latest value per user, upserted in batches of so many days."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        events = table(spark, sf_dir, "events").select("user_id", "ts", "event_id", "value")
        path = shared_folder(spark, "store")
        write = streaming.upsert_results(
            path, ["user_id"], lambda b: ranking.latest_per_key(b, ["user_id"], ["ts", "event_id"])
        )
        for i in range(-(-31 // days)):
            write(events.filter(F.floor((F.dayofmonth("ts") - 1) / days) == i), i)
        return streaming.read_latest(spark, path).select("user_id", "event_id", "value")

    return run


def _in_batches(
    plan: Callable[[DataFrame], DataFrame], keys: list[str], transform: Callable[[DataFrame], DataFrame] | None, mode: str
) -> Query:
    """A stream that stops and goes on again for every eight days of events, upserted by key."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        folder = shared_folder(spark, "feed")
        events = table(spark, sf_dir, "events")
        write = streaming.upsert_results(f"{folder}/store", keys, transform)
        for i in range(4):
            part = events.filter(F.floor((F.dayofmonth("ts") - 1) / 8) == i)
            part.write.mode("append").parquet(f"{folder}/events")
            flown = event_flights(sources.file_stream(spark, f"{folder}/events", events.schema))
            writer = plan(flown).writeStream.outputMode(mode).foreachBatch(write)
            writer = writer.option("checkpointLocation", f"{folder}/checkpoint")
            writer.trigger(availableNow=True).start().awaitTermination()
        # Batches without data, which only move the watermark, count as well.
        return _dates_as_text(streaming.read_latest(spark, f"{folder}/store").drop("batch_id"))

    return run


# The event table in files by days; a rate of so many files makes each part a micro-batch.
FEED_PARTS, FEED_DAYS, FEED_FILES = 5, 6, 4


def _feed(spark: SparkSession, sf_dir: str, order: Callable[[int], int] = lambda i: i) -> DataFrame:
    """Event flights from files that come part by part, a bounded number at a time."""
    folder = shared_folder(spark, "feed")
    events = table(spark, sf_dir, "events")
    for i in map(order, range(FEED_PARTS)):
        part = events.filter(F.floor((F.dayofmonth("ts") - 1) / FEED_DAYS) == i)
        part.repartition(FEED_FILES).write.mode("append").parquet(folder)
    return event_flights(sources.file_stream(spark, folder, events.schema, FEED_FILES))


def _rate_limited(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each micro-batch of a stream that takes so many files at a time, ranked on its own."""
    return streaming.drain_ranked(_feed(spark, sf_dir), questions.carriers_from)


def _trips_in_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Trips as they are published batch by batch, from a store of legs by day that drops old days."""
    folder = shared_folder(spark, "trips")
    keep = streaming.upsert_results(f"{folder}/trips", ["origin", "stop", "dest", "flight_date"], by="flight_date")
    legs = streaming.best_legs(_feed(spark, sf_dir)).writeStream.outputMode("update")
    writer = legs.foreachBatch(streaming.publish_trips(f"{folder}/legs", keep, 2, streaming.LATE_DAYS))
    streaming.run_to_end(writer, folder)
    return _dates_as_text(streaming.read_latest(spark, f"{folder}/trips").drop("batch_id"))


def _sent_twice(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The carriers of every micro-batch as messages that are all sent twice, read back."""
    path = shared_folder(spark, "messages")
    send = streaming.publish_messages(streaming.to_files(path), questions.carriers, ["carrier"], "mean_delay")

    def twice(batch: DataFrame, batch_id: int) -> None:
        send(batch, batch_id)
        send(batch, batch_id)

    streaming.run_to_end(_feed(spark, sf_dir).writeStream.foreachBatch(twice), shared_folder(spark, "stream"))
    return sources.parse_batch_messages(spark.read.parquet(path))


def _windows_and_late_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Windows of a stream whose parts come out of order: rows in time, and late ones."""
    folder = shared_folder(spark, "windows")
    swapped = _feed(spark, sf_dir, lambda i: min(i ^ 1, FEED_PARTS - 1))
    write = streaming.count_windows(folder, "1 day", "2 days")
    streaming.run_to_end(swapped.writeStream.foreachBatch(write), folder)
    keys = ["window_start", "airport"]
    late = streaming.read_late(spark, folder).groupBy(*keys).agg(F.count(F.lit(1)).alias("n_late"))
    both = streaming.read_windows(spark, folder).withColumnRenamed("n", "n_in_time").join(late, keys, "full")
    return _dates_as_text(both.fillna(0, ["n_in_time", "n_late"]))


def _broken_csv(spark: SparkSession, sf_dir: str) -> str:
    """CSV files of flights in which some fields are no number, date or time, and some lines have
    a field too many, by the flight's number. A file has the flights of a thousand orders."""
    number = F.col("flight_num").cast("bigint")
    shown = {
        "FL_DATE": F.when(number % 17 == 0, "2008-13-45").otherwise(F.date_format("flight_date", "yyyy-MM-dd")),
        "CARRIER": F.when(number % 23 == 0, F.concat("carrier", F.lit(",?"))).otherwise(F.col("carrier")),
        "FL_NUM": F.col("flight_num"),
        "ORIGIN": F.col("origin"),
        "DEST": F.col("dest"),
        "DEP_TIME": F.when(number % 19 == 0, "2575").otherwise(F.col("dep_time")),
        "DEP_DELAY": F.when(number % 13 == 0, "abc").otherwise(F.coalesce(F.col("dep_delay").cast("string"), F.lit(""))),
        "ARR_DELAY": F.coalesce(F.col("arr_delay").cast("string"), F.lit("")),
    }
    path = shared_folder(spark, "broken")
    line = F.concat_ws(",", *shown.values())
    whole = F.concat_ws("\n", F.lit(",".join(shown)), F.collect_list(line))
    files = flights(spark, sf_dir).groupBy(F.floor(number / 10_000).alias("file")).agg(whole.alias("value"))
    files.write.partitionBy("file").text(path)
    return f"{path}/*"


def _csv_usable(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _dates_as_text(sources.flights_by_name(spark, _broken_csv(spark, sf_dir)))


def _csv_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    rejected = sources.rejected_by_name(spark, _broken_csv(spark, sf_dir))
    return rejected.withColumn("problems", F.array_join("problems", "; "))


def _quoted_pair(first: str, second: str) -> Column:
    return F.concat(F.lit('"'), F.col(first), F.lit(" "), F.col(second), F.lit('"'))


def _tab_lines(df: DataFrame, key: Column, value: Column) -> DataFrame:
    return df.select(F.concat(key, F.lit("\t"), value).alias("value"))


def _through_text(lines: DataFrame, label: str) -> DataFrame:
    spark = lines.sparkSession
    return spark.read.text(sinks.as_text_files(spark, lines, label))


def _parse_key_metric_tsv(all_flights: DataFrame) -> DataFrame:
    counts = questions.popular_airports(all_flights, k=None)
    quoted = F.concat(F.lit('"'), F.col("airport"), F.lit('"'))
    lines = _through_text(_tab_lines(counts, quoted, python_float("n")), "key-metric")
    return questions.key_results(lines)


def _parse_composite_tsv(all_flights: DataFrame) -> DataFrame:
    means = ranking.mean_delay(all_flights, ["origin", "carrier"], "dep_delay")
    text = _tab_lines(means, _quoted_pair("origin", "carrier"), python_float("mean_delay"))
    lines = _through_text(text, "pair-metric")
    return questions.pair_results(lines, "origin", "carrier", "mean_delay")


def _parse_best_flight_tsv(all_flights: DataFrame) -> DataFrame:
    best = itinerary.best_flights(all_flights)
    key = F.concat_ws(" ", "origin", "dest", F.date_format("flight_date", "yyyy-MM-dd"), "half_day")
    flight = F.concat_ws(" ", "carrier", "flight_num", "dep_time", python_float("arr_delay"))

    def quoted(c: Column) -> Column:
        return F.concat(F.lit('"'), c, F.lit('"'))

    lines = _through_text(_tab_lines(best, quoted(key), quoted(flight)), "best-flight")
    return sources.parse_best_flights(lines)


def _records(name: str, result: Callable[[DataFrame], DataFrame]) -> Query:
    """Results written as CSV with a header and read back as the records of one table."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        path = shared_folder(spark, "records")
        sinks.write_csv(result(flights(spark, sf_dir)), path)
        return sources.read_records(spark, name, path)

    return run


def _airport_records(all_flights: DataFrame) -> DataFrame:
    return questions.destinations_from(all_flights).select("origin", "dest", "mean_delay")


def _carrier_records(all_flights: DataFrame) -> DataFrame:
    return questions.carriers_from(all_flights).select("origin", "carrier", "mean_delay")


def _best_flight_records(all_flights: DataFrame) -> DataFrame:
    return _dates_as_text(itinerary.best_flights(all_flights)).select(
        "origin", "dest", "flight_date", "half_day", "carrier", "flight_num", "dep_time", "arr_delay"
    )


def _delay_records(all_flights: DataFrame) -> DataFrame:
    means = ranking.mean_delay(all_flights, ["dest", "carrier"], "arr_delay")
    return means.select("dest", "carrier", "mean_delay")


def _result_message_roundtrip(all_flights: DataFrame) -> DataFrame:
    top = questions.carriers_from(all_flights)
    return sources.parse_messages(sinks.answer_messages(top, ["origin", "carrier"], "mean_delay"))


def _latest_result_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events").select("user_id", "ts", "event_id", "value")
    latest = ranking.latest_per_key(events, ["user_id"], ["ts", "event_id"])
    return latest.select("user_id", "event_id", "value")


def _date_shift(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = table(spark, sf_dir, "orders").select(
        "o_orderkey", F.date_format("o_orderdate", "dd/MM/yyyy").alias("travel_text")
    )
    day = day_first_date("travel_text")
    return _dates_as_text(
        text.select(
            "o_orderkey",
            "travel_text",
            day.alias("travel_date"),
            shift_date(day, 2).alias("second_leg_date"),
        )
    )


def _part_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").groupBy("l_partkey").agg(F.count(F.lit(1)).alias("n"))


def _popularity_ccdf(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = _part_counts(spark, sf_dir)
    lines = counts.select(F.concat_ws(" ", F.col("n"), F.col("l_partkey")).alias("value"))
    frequencies = sources.parse_frequencies(_through_text(lines, "frequencies"))
    return distribution.ccdf(frequencies, "n")


def _powerlaw_alpha(spark: SparkSession, sf_dir: str) -> DataFrame:
    fit = distribution.powerlaw_alpha(_part_counts(spark, sf_dir), "n")
    return fit.withColumn("alpha", F.round("alpha", 6))


def _powerlaw_fit(spark: SparkSession, sf_dir: str) -> DataFrame:
    fit = distribution.powerlaw_fit(_part_counts(spark, sf_dir), "n")
    return fit.withColumn("alpha", F.round("alpha", 6)).withColumn("d", F.round("d", 6))


def _powerlaw_fit_prices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Prices, nearly all of them different."""
    prices = table(spark, sf_dir, "lineitem").select((F.col("l_extendedprice") + 1).alias("n"))
    fit = distribution.powerlaw_fit(prices, "n")
    return fit.withColumn("alpha", F.round("alpha", 6)).withColumn("d", F.round("d", 6))


def _lognormal_fit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return distribution.lognormal_fit(_part_counts(spark, sf_dir), "n")


def _lognormal_fit_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order totals in thousands, which have a lognormal."""
    thousands = table(spark, sf_dir, "orders").select((F.floor(F.col("o_totalprice") / 1000) + 1).alias("n"))
    fit = distribution.lognormal_fit(thousands, "n")
    rounded = ("alpha", "d", "mu", "sigma", "ratio", "p_value")
    return fit.withColumns({c: F.round(c, 6) for c in rounded})


def _best_flight_on_route_date(all_flights: DataFrame) -> DataFrame:
    return itinerary.best_flight_on_date(all_flights, TRIP[0], TRIP[1], TRIP[3], "AM").select(
        "origin", "dest", "flight_date", "half_day", "carrier", "flight_num", "dep_time", "arr_delay"
    )


QUERIES: dict[str, Query] = {
    "airport_popularity": _on_flights(questions.popular_airports),
    "popularity_full_ranking": _on_flights(_popularity_full_ranking),
    "carrier_arrival_topk": _on_flights(questions.carriers),
    "carrier_arrival_bottomk": _on_flights(lambda f: questions.carriers(f, ascending=False)),
    "carrier_arrival_parity": _on_flights(_carrier_arrival_parity),
    "origin_carrier_topk": _on_flights(lambda f: questions.carriers_from(f, ORIGIN)),
    "origin_carrier_topk_all": _on_flights(questions.carriers_from),
    "origin_dest_topk": _on_flights(lambda f: questions.destinations_from(f, ORIGIN)),
    "origin_dest_topk_all": _on_flights(questions.destinations_from),
    "route_carrier_topk": _on_flights(lambda f: questions.carriers_on_route(f, ORIGIN, DEST)),
    "route_carrier_topk_all": _on_flights(questions.carriers_on_route),
    "route_carrier_topk_departure": _on_flights(
        lambda f: questions.carriers_on_route(f, metric="dep_delay")
    ),
    "route_carrier_malformed_codes": _on_flights(_route_carriers_with_malformed_codes),
    "popularity_short_lines": _on_flights(_popular_from_short_lines),
    "odd_departure_times": _on_flights(_odd_departure_times),
    "mean_texts": _on_flights(_mean_texts),
    "fractional_mean_delay": _on_flights(_fractional_means),
    "carrier_places": _on_flights(questions.all_carriers_on_routes),
    "airport_places": _on_flights(questions.all_airports),
    "one_trip": _on_flights(
        lambda f: itinerary.two_leg_best(f, 2, False, TRIP[0], TRIP[1], TRIP[2], TRIP[3])
    ),
    "result_messages_all": _on_flights(_all_result_messages),
    "latest_through_store": _latest_through_store(8),
    "latest_through_store_daily": _latest_through_store(1),
    "route_mean_delay": _on_flights(questions.route_delays),
    "best_flight_on_date": _on_flights(itinerary.best_flights),
    "best_flight_on_route_date": _on_flights(_best_flight_on_route_date),
    "leg_search": _on_flights(lambda f: itinerary.leg_search(f, *TRIP)),
    "leg_search_blank_as_zero": _on_flights(
        lambda f: itinerary.leg_search(f, *TRIP, blank_as_zero=True)
    ),
    "two_leg_best": _on_flights(itinerary.two_leg_best),
    "date_shift": _date_shift,
    "parse_flight_csv": _on_flights(_parse_flight_csv),
    "parse_flight_rejects": _on_flights(_parse_flight_rejects),
    "parse_key_metric_tsv": _on_flights(_parse_key_metric_tsv),
    "parse_composite_tsv": _on_flights(_parse_composite_tsv),
    "parse_best_flight_tsv": _on_flights(_parse_best_flight_tsv),
    "result_records": _records("top-airports-for-each-airport", _airport_records),
    "result_records_carriers": _records("top-carriers-for-each-airport", _carrier_records),
    "result_records_best_flight": _records("best-flight-on-a-given-date", _best_flight_records),
    "result_records_delays": _records("average-airport-delay-for-each-airport", _delay_records),
    "result_message_roundtrip": _on_flights(_result_message_roundtrip),
    "latest_result_upsert": _latest_result_upsert,
    "flight_report_lines": _on_flights(lambda f: sinks.report_lines(itinerary.best_flights(f))),
    "popularity_ccdf": _popularity_ccdf,
    "powerlaw_alpha": _powerlaw_alpha,
    "powerlaw_fit": _powerlaw_fit,
    "powerlaw_fit_prices": _powerlaw_fit_prices,
    "lognormal_fit": _lognormal_fit,
    "lognormal_fit_orders": _lognormal_fit_orders,
    "stream_popularity_running": _on_stream(
        lambda f: streaming.drain_latest(streaming.running_popularity(f))
    ),
    "stream_carrier_running": _on_stream(
        lambda f: streaming.drain_latest(streaming.running_carriers(f))
    ),
    "stream_popularity_tumbling": _on_stream(
        lambda f: streaming.drain_updated(
            streaming.windowed_popularity(f, "1 hour", "1 hour"), ["window_start", "airport"]
        )
    ),
    "stream_batch_rank": _on_stream(
        lambda f: streaming.drain_ranked(f, questions.popular_airports)
    ),
    "stream_origin_carrier": _on_stream(
        lambda f: streaming.drain_ranked(f, questions.carriers_from)
    ),
    "stream_origin_dest": _on_stream(
        lambda f: streaming.drain_ranked(f, questions.destinations_from)
    ),
    "stream_route_carrier": _on_stream(
        lambda f: streaming.drain_ranked(f, questions.carriers_on_route)
    ),
    "stream_two_leg": _on_stream(streaming.drain_trips),
    "stream_rate_limited": _rate_limited,
    "stream_trips_in_batches": _trips_in_batches,
    "stream_messages_sent_twice": _sent_twice,
    "stream_windows_and_late_rows": _windows_and_late_rows,
    "csv_usable_rows": _csv_usable,
    "csv_rejected_rows": _csv_rejects,
    "stream_latest_in_batches": _in_batches(lambda f: f, ["carrier"], questions.carriers, "append"),
    "stream_windows_in_batches": _in_batches(
        lambda f: streaming.windowed_popularity(f, "1 hour", "1 hour"), ["window_start", "airport"], None, "update"
    ),
    "stream_latest_results": _on_stream(
        lambda f: streaming.drain_upserted(f, ["carrier"], questions.carriers)
    ),
}
