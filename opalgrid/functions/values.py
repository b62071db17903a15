"""Column functions: text as typed values."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def typed(value: Column, kind: str) -> Column:
    """Text as str, int, float or bool (any text that is not empty is true), or datetime:<format> as seconds since 1970
    in London time; null where it does not parse."""
    if kind.startswith("datetime:"):
        return epoch(value, kind.split(":", 1)[1])
    return {"str": value, "int": value.try_cast("int"), "float": value.try_cast("double"), "bool": F.length(value) > 0}[kind]


def epoch(value: Column, pattern: str, zone: str = "Europe/London") -> Column:
    """Seconds since 1970 of a wall clock's time in a zone, whatever the session's zone is."""
    wall = F.try_to_timestamp(value, F.lit(pattern)).cast("timestamp_ntz")
    return F.timestamp_diff("SECOND", F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"), F.convert_timezone(F.lit(zone), F.lit("UTC"), wall))
