"""Command line: one job per question, over lines, earlier results or a topic.

    python -m flightrank.jobs carriers-from --origin ATL --lines in/ --out out/
    python -m flightrank.jobs popular-airports --results counts.tsv --out out/
    python -m flightrank.jobs carriers --brokers host:9092 --topic flights \\
        --out-topic top-carriers --checkpoint /shared/checkpoint
"""

from __future__ import annotations

import argparse
import datetime
import sys
from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql.streaming import DataStreamWriter, StreamingQueryListener

from flightrank import sinks, sources, streaming
from flightrank.operators import distribution, itinerary
from flightrank.operators.popularity import airport_counts
from flightrank.plans import questions
from flightrank.schema import FIELDS_FOR
from flightrank.session import build_session, clear_shared

Answer = Callable[[DataFrame], DataFrame]
Args = argparse.Namespace
Publish = Callable[[Answer, Sequence[str], str], Callable[[DataFrame, int], None]]


@dataclass(frozen=True)
class Job:
    """What a job answers, which arguments it needs and takes, and how its rows are published."""

    on_flights: Callable[[DataFrame, Args], DataFrame]
    entity: Callable[[Args], Sequence[str]]
    result: str  # the published number
    needs: tuple[str, ...] = ()
    takes: tuple[str, ...] = ()
    metric: str = "dep_delay"  # decides how many fields a line must have
    on_results: Callable[[DataFrame, Args], DataFrame] | None = None
    results_kind: str = "key"
    interval: str = "60 seconds"  # between the micro-batches of a stream


def _iso(day_first: str) -> str:
    return datetime.datetime.strptime(day_first, "%d/%m/%Y").date().isoformat()


def _named(*columns: str) -> Callable[[Args], Sequence[str]]:
    return lambda args: columns


def _pairs(second: str) -> Callable[[DataFrame, Args], DataFrame]:
    return lambda r, a: questions.pair_results(r, "origin", second, "mean_delay", a.origin, a.k)


ONE_FLIGHT = ("origin", "dest", "date", "half_day")
JOBS: dict[str, Job] = {
    "popular-airports": Job(
        lambda f, a: questions.popular_airports(f, a.k),
        _named("airport"),
        "n",
        takes=("k",),
        on_results=lambda r, a: questions.key_results(r, a.k if a.k_given else None),
    ),
    "carriers": Job(
        lambda f, a: questions.carriers(f, a.metric, a.k, not a.descending),
        _named("carrier"),
        "mean_delay",
        takes=("k", "metric", "descending"),
        metric="arr_delay",
        on_results=lambda r, a: questions.key_results(r, a.k, ascending=not a.descending),
    ),
    "carriers-from": Job(
        lambda f, a: questions.carriers_from(f, a.origin, a.metric, a.k),
        lambda a: ("carrier",) if a.origin else ("origin", "carrier"),
        "mean_delay",
        takes=("k", "metric", "origin"),
        on_results=_pairs("carrier"),
        results_kind="pair",
    ),
    "destinations-from": Job(
        lambda f, a: questions.destinations_from(f, a.origin, a.metric, a.k),
        lambda a: ("dest",) if a.origin else ("origin", "dest"),
        "mean_delay",
        takes=("k", "metric", "origin"),
        on_results=_pairs("dest"),
        results_kind="pair",
    ),
    "carriers-on-route": Job(
        lambda f, a: questions.carriers_on_route(f, a.origin, a.dest, a.metric, a.k),
        lambda a: ("carrier",) if a.origin and a.dest else ("origin", "dest", "carrier"),
        "mean_delay",
        takes=("k", "metric", "origin", "dest"),
        metric="arr_delay",
        interval="1 second",
    ),
    "route-delays": Job(
        lambda f, a: questions.route_delays(f, a.metric),
        _named("origin", "dest"),
        "mean_delay",
        takes=("metric",),
        metric="arr_delay",
    ),
    "carrier-places": Job(
        lambda f, a: questions.all_carriers_on_routes(f, a.metric),
        _named("origin", "dest", "carrier"),
        "mean_delay",
        takes=("metric",),
        metric="arr_delay",
    ),
    "airport-places": Job(lambda f, a: questions.all_airports(f), _named("airport"), "n"),
    "best-flight": Job(
        lambda f, a: itinerary.best_flight_on_date(f, a.origin, a.dest, _iso(a.date), a.half_day),
        _named("origin", "dest", "flight_date", "half_day", "carrier", "flight_num", "dep_time"),
        "arr_delay",
        needs=ONE_FLIGHT,
        metric="arr_delay",
        on_results=lambda r, a: questions.best_flight_results(
            r, a.origin, a.dest, _iso(a.date), a.half_day
        ),
        results_kind="best_flight",
    ),
    "trip-legs": Job(
        lambda f, a: itinerary.leg_search(f, a.origin, a.stop, a.dest, _iso(a.date), a.gap_days),
        _named("leg", "origin", "dest", "flight_date", "carrier", "flight_num", "dep_time"),
        "arr_delay",
        needs=("origin", "stop", "dest", "date"),
        takes=("gap_days",),
        metric="arr_delay",
    ),
    "trips": Job(
        lambda f, a: itinerary.two_leg_best(
            f, a.gap_days, False, a.origin, a.stop, a.dest, a.date and _iso(a.date)
        ),
        _named("origin", "stop", "dest", "flight_date"),
        "total_delay",
        takes=("origin", "stop", "dest", "date", "gap_days", "store"),
        metric="arr_delay",
    ),
    "popularity-fit": Job(
        lambda f, a: distribution.lognormal_fit(airport_counts(f), "n"),
        _named("favoured"),
        "ratio",
        on_results=lambda r, a: distribution.lognormal_fit(sources.parse_frequencies(r), "n"),
        results_kind="frequency",
    ),
}
OPTIONS = ("origin", "stop", "dest", "date", "half_day", "gap_days", "metric", "k", "descending", "store")
DEFAULTS = {"gap_days": 2, "k": 10, "descending": False}


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="flightrank")
    p.add_argument("job", choices=list(JOBS))
    source = p.add_mutually_exclusive_group(required=True)
    source.add_argument("--lines", help="files of raw flight lines")
    source.add_argument("--csv", help="CSV files with a header")
    source.add_argument("--results", help="keyed text files of an earlier job")
    source.add_argument("--brokers", help="Kafka brokers; read --topic as a stream")
    p.add_argument("--topic")
    p.add_argument("--max-offsets", type=int, help="records per micro-batch")
    p.add_argument("--interval", help="time between micro-batches, such as '1 second'")
    p.add_argument("--out", help="folder for CSV results")
    p.add_argument("--rejects", help="folder for the rows of --csv that cannot be read, with the reasons")
    p.add_argument("--out-topic")
    p.add_argument("--checkpoint")
    p.add_argument("--store", help="folder in which a stream of trips keeps the best legs")
    p.add_argument("--origin")
    p.add_argument("--stop")
    p.add_argument("--dest")
    p.add_argument("--date", help="dd/MM/yyyy")
    p.add_argument("--half-day", choices=["AM", "PM"])
    p.add_argument("--gap-days", type=int)
    p.add_argument("--metric", choices=["arr_delay", "dep_delay"])
    p.add_argument("--k", type=int)
    p.add_argument("--descending", action="store_true", default=None, help="worst first")
    p.add_argument("--legacy-len", action="store_true", help="ignore delays of one character")
    return p


def checked(args: Args) -> Args:
    """The arguments with defaults; an argument that is missing or that the job would ignore
    is an error."""
    job = JOBS[args.job]
    given = {o for o in OPTIONS if getattr(args, o) is not None}
    if args.rejects and not args.csv:
        raise ValueError("only for --csv: rejects")
    allowed = {*job.needs, *job.takes}
    if args.results:
        if job.on_results is None:
            raise ValueError(f"{args.job} cannot be answered from --results")
        allowed -= {"metric"}
    required = list(job.needs)
    if args.brokers:
        required += ["topic", "out_topic", "checkpoint"]
        if args.job == "trips":
            required += ["store"]
    else:
        allowed -= {"store"}
        unused = [o for o in ("topic", "out_topic", "checkpoint", "interval", "max_offsets") if getattr(args, o)]
        if unused:
            raise ValueError(f"only for a stream: {', '.join(unused)}")
    if given - allowed:
        raise ValueError(f"{args.job} does not take: {', '.join(sorted(given - allowed))}")
    missing = [o for o in required if getattr(args, o) is None]
    if missing:
        raise ValueError(f"{args.job} needs: {', '.join(missing)}")
    if args.date is not None:
        _iso(args.date)
    values = {o: DEFAULTS.get(o) for o in OPTIONS if getattr(args, o) is None}
    return Args(**{**vars(args), **values, "metric": args.metric or job.metric, "k_given": args.k is not None})


def answer(spark: SparkSession, args: Args, counts: Observation | None = None) -> DataFrame:
    """The answer of a batch job; ``counts`` then holds how many lines there were and how many
    could not be read."""
    args = checked(args)
    job = JOBS[args.job]
    if args.results:
        lines = spark.read.text(args.results)
        if counts is not None:
            lines = sources.counted_results(lines, job.results_kind, counts)
        return job.on_results(lines, args)
    if args.csv:
        flights = sources.flights_by_name(spark, args.csv, legacy_len=args.legacy_len, line_counts=counts)
    else:
        needed = FIELDS_FOR[args.metric]
        flights = sources.parse_flights(spark.read.text(args.lines), args.legacy_len, counts, needed)
    return job.on_flights(flights, args)


def stream(spark: SparkSession, args: Args, lines: DataFrame, publish: Publish) -> DataStreamWriter:
    """The stream of a job over raw ``lines``, not started.

    ``publish`` makes a ``foreachBatch`` writer from a batch's answer, the
    columns that name a row, and the column of its number.
    """
    args = checked(args)
    job = JOBS[args.job]
    needed = FIELDS_FOR[args.metric]
    flights = sources.parse_flights(lines, args.legacy_len, "flight_lines", needed)

    def written(answer: Answer) -> Callable[[DataFrame, int], None]:
        return publish(answer, job.entity(args), job.result)

    if args.job == "trips":
        # Legs meet across micro-batches, so they are kept; trips are made from them.
        date = args.date and _iso(args.date)
        asked = itinerary.on_trip(flights, args.origin, args.stop, args.dest, date, args.gap_days)
        chosen = written(lambda t: itinerary.chosen_trips(t, args.origin, args.stop, args.dest, date))
        writer = streaming.best_legs(asked).writeStream.outputMode("update")
        writer = writer.foreachBatch(streaming.publish_trips(args.store, chosen, args.gap_days, streaming.LATE_DAYS))
    elif args.job == "popularity-fit":
        # A fit is about all flights so far, not about one micro-batch.
        fit = written(lambda counts: distribution.lognormal_fit(counts, "n"))
        writer = airport_counts(flights).writeStream.outputMode("complete").foreachBatch(fit)
    else:
        writer = flights.writeStream.foreachBatch(written(lambda f: job.on_flights(f, args)))
    return writer.option("checkpointLocation", args.checkpoint).trigger(
        processingTime=args.interval or job.interval
    )


class LineCounts(StreamingQueryListener):
    """Prints the line counts of every micro-batch."""

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        counts = event.progress.observedMetrics.get("flight_lines")
        if counts is not None:
            print(f"batch {event.progress.batchId}: {counts.asDict()}", file=sys.stderr)

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        pass


def run_stream(spark: SparkSession, args: Args) -> None:
    """Answer every micro-batch and publish the answer as messages."""
    lines = sources.kafka_lines(spark, args.brokers, args.topic, args.max_offsets)
    spark.streams.addListener(LineCounts())

    def publish(answer: Answer, entity: Sequence[str], metric: str) -> Callable[[DataFrame, int], None]:
        return streaming.publish_batches(args.brokers, args.out_topic, answer, entity, metric)

    stream(spark, args, lines, publish).start().awaitTermination()


def main(argv: Sequence[str] | None = None) -> None:
    args = parser().parse_args(argv)
    try:
        checked(args)
    except ValueError as wrong:
        parser().error(str(wrong))
    spark = build_session()
    if args.brokers:
        run_stream(spark, args)
        return
    counts = Observation("lines")
    sinks.write_csv(answer(spark, args, counts), args.out)
    print(counts.get, file=sys.stderr)
    if args.rejects:
        sources.rejected_by_name(spark, args.csv).write.json(args.rejects)
    clear_shared(spark)


if __name__ == "__main__":
    main()
