"""Outcome rules: 1 = negative experience, 0 = positive, null = neutral or unknown."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values.
NEGATIVE_MAX = 2
POSITIVE_MIN = 4
RECOMMENDED = "Recommended"
NOT_RECOMMENDED = "Not Recommended"


def label_rating(stars: Column, offset: int = 0) -> Column:
    """Star rule. ``offset`` shifts raw labels first: use 1 to read 0-4 labels as 1-5 stars;
    the default 0 applies the thresholds to the raw label."""
    # Not-a-number would compare as larger than every star.
    value = F.nanvl(stars.cast("double"), F.lit(None)) + F.lit(offset)
    return (
        F.when(value <= NEGATIVE_MAX, F.lit(1)).when(value >= POSITIVE_MIN, F.lit(0)).cast("int")
    )


def label_recommend(verdict: Column) -> Column:
    return (
        F.when(verdict == NOT_RECOMMENDED, F.lit(1))
        .when(verdict == RECOMMENDED, F.lit(0))
        .cast("int")
    )
