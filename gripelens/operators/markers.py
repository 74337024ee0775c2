"""Counts of intensifiers and complaint terms per review."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gripelens.functions.text import term_count, tokens

# The example terms of the analysis plan.
INTENSIFIERS = ("very", "extremely", "worst")
COMPLAINT_TERMS = ("refund", "refunds", "broken", "crash")


def lexical_markers(
    df: DataFrame,
    text_col: str = "text",
    intensifiers: Sequence[str] = INTENSIFIERS,
    complaints: Sequence[str] = COMPLAINT_TERMS,
) -> DataFrame:
    """Add ``intensifier_count`` and ``complaint_count``; a narrow per-row expression."""
    return (
        df.withColumn("_tokens", tokens(F.col(text_col)))
        .withColumns(
            {
                "intensifier_count": term_count(F.col("_tokens"), intensifiers),
                "complaint_count": term_count(F.col("_tokens"), complaints),
            }
        )
        .drop("_tokens")
    )
