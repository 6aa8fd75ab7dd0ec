from flightrank.functions.fields import (
    clock_time,
    day_first_date,
    delay_minutes,
    departure_time,
    half_day,
    is_airport,
    is_carrier,
    is_clock_time,
    remove_quotes,
    shift_date,
)
from flightrank.functions.text import flight_report, json_array, python_float

__all__ = [
    "clock_time",
    "day_first_date",
    "delay_minutes",
    "departure_time",
    "flight_report",
    "half_day",
    "is_airport",
    "is_carrier",
    "is_clock_time",
    "json_array",
    "python_float",
    "remove_quotes",
    "shift_date",
]
