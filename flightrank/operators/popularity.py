"""How many flights go to or from each airport."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flightrank.functions import is_airport


def movements(flights: DataFrame) -> DataFrame:
    """Two rows per flight, one for each end; flights with a malformed code are left out."""
    return flights.filter(is_airport("origin") & is_airport("dest")).withColumn(
        "airport", F.explode(F.array("origin", "dest"))
    )


def airport_counts(flights: DataFrame) -> DataFrame:
    """Flights to and from each airport; one count per code leaves each map task."""
    return movements(flights).groupBy("airport").agg(F.count(F.lit(1)).alias("n"))
