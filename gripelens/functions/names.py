"""Readable names for model features and datasets."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Prefixes the feature encoder puts before a column name.
TITLE_PREFIXES = ("num_scaler__", "remainder__", "verified_ohe__", "early_access_ohe__")
SENTENCE_PREFIXES = TITLE_PREFIXES + ("cat_ohe__",)
EARLY_ACCESS_RAW = "early_access_review_"
EARLY_ACCESS_TITLE = "Early Access Review"
EARLY_ACCESS_SENTENCE = "Early access review"
# Dataset key -> display name.
DISPLAY_NAMES = {
    "amazon_beauty": "Amazon (Beauty)",
    "amazon_clothing": "Amazon (Clothing)",
    "amazon_electronics": "Amazon (Electronics)",
    "amazon_health": "Amazon (Health)",
    "steam": "Steam",
    "yelp": "Yelp",
}


def _without(name: Column, prefixes) -> Column:
    return F.regexp_replace(name, "|".join(prefixes), "")


def _spaced(name: Column) -> Column:
    return F.btrim(F.translate(name, "_", " "))


def title_name(feature: Column) -> Column:
    """``num_scaler__capital_ratio`` -> ``Capital Ratio``."""
    bare = _without(feature, TITLE_PREFIXES)
    return F.when(bare.startswith(EARLY_ACCESS_RAW), F.lit(EARLY_ACCESS_TITLE)).otherwise(
        F.initcap(_spaced(bare))
    )


def sentence_name(feature: Column) -> Column:
    """``num_scaler__capital_ratio`` -> ``Capital ratio``; only the first letter changes."""
    spaced = _spaced(_without(feature, SENTENCE_PREFIXES))
    merged = F.regexp_replace(
        spaced, f"[eE]arly access review {EARLY_ACCESS_TITLE}", EARLY_ACCESS_SENTENCE
    )
    return F.overlay(merged, F.upper(F.left(merged, F.lit(1))), F.lit(1), F.lit(1))


def display_name(key: Column) -> Column:
    """Display name of a dataset key; an unknown key stays as it is."""
    named = F.create_map(*[F.lit(x) for pair in DISPLAY_NAMES.items() for x in pair])
    return F.coalesce(F.try_element_at(named, key), key)
