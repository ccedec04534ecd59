"""Number functions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def steady_round(value: Column, places: int) -> Column:
    """Half-up rounding that does not depend on the order in which doubles were summed.

    A distributed sum of doubles differs in its last bits from run to run, which
    flips plain ``round`` on exact halves.  Snapping to eight decimals first
    removes that noise.
    """
    return F.round(value.cast("decimal(38,8)"), places).cast("double")


def percent(part: Column, whole: Column, places: int = 2) -> Column:
    return steady_round(part.cast("double") * F.lit(100.0) / whole.cast("double"), places)
