"""Literal flights for the unit tests."""

import datetime

from flightrank.schema import FLIGHT


def flight(
    num="1", carrier="AA", origin="ATL", dest="ORD", date="2008-01-05", time="0900",
    dep=0.0, arr=0.0,
):
    day = datetime.date.fromisoformat(date) if date else None
    return (num, carrier, origin, dest, day, time, dep, arr)


def table(spark, *rows):
    return spark.createDataFrame(list(rows), FLIGHT)


def raw_line(
    year="2008", date="2008-01-05", carrier='"AA"', num='"17"', origin='"ATL"', dest='"ORD"',
    time='"0905"', dep="1.00", arr="-2.00", cities=('"Atlanta, GA"', '"Chicago, IL"'), fields=None,
):
    """A line as in the published files: 43 columns, two of them with an inner comma."""
    columns = [""] * 43
    filled = {
        0: year, 5: date, 6: carrier, 10: num, 14: origin, 15: cities[0], 23: dest,
        24: cities[1], 30: time, 31: dep, 42: arr,
    }
    for position, value in filled.items():
        columns[position] = value
    line = ",".join(columns)
    return line if fields is None else ",".join(line.split(",")[:fields])


def lines(spark, *values):
    return spark.createDataFrame([(v,) for v in values], "value string")
