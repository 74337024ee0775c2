"""The whole run for one platform: features, snapshot, model, coefficients."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gripelens.operators.metrics import classification_report
from gripelens.operators.model import FittedModel, fit_classifier
from gripelens.operators.sentiment import Lexicon
from gripelens.plans.features import build_features
from gripelens.plans.presets import PlatformPreset
from gripelens.sources.tables import read_snapshot, write_coefs, write_snapshot


@dataclass(frozen=True)
class PlatformRun:
    features: DataFrame
    model: FittedModel
    coefs: DataFrame
    report: DataFrame


def fit_platform(features: DataFrame, preset: PlatformPreset, **options) -> FittedModel:
    return fit_classifier(features, preset.model_numeric, dict(preset.categorical), **options)


def fit_pooled(features: DataFrame, numeric, platform_col: str = "platform", **options) -> FittedModel:
    """One model over all platforms with the platform itself as an input."""
    return fit_classifier(features, numeric, {"platform_ohe__": platform_col}, **options)


def run_platform(
    reviews: DataFrame,
    preset: PlatformPreset,
    lexicon: Lexicon,
    as_of: dt.datetime,
    out_dir: str,
    metadata: DataFrame | None = None,
) -> PlatformRun:
    """Write ``features``, ``coefs`` and ``model`` below ``out_dir`` and return them."""
    spark = reviews.sparkSession
    features = build_features(reviews, preset, lexicon, as_of, metadata)
    write_snapshot(features, f"{out_dir}/features")
    snapshot = read_snapshot(spark, f"{out_dir}/features")
    model = fit_platform(snapshot, preset)
    coefs = model.coefficients()
    write_coefs(coefs.withColumn("platform", F.lit(preset.key)), f"{out_dir}/coefs")
    model.pipeline.write().save(f"{out_dir}/model")
    return PlatformRun(snapshot, model, coefs, classification_report(model.predictions()))
