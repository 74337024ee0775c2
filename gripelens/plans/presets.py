"""What differs between platforms: columns, outcome rule, age rule, model inputs."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field, replace

from pyspark.sql import Column
from pyspark.sql import functions as F

from gripelens.functions.dates import DEFAULT_FORMATS
from gripelens.functions.labels import label_rating, label_recommend
from gripelens.functions.text import TEXT_FEATURES


@dataclass(frozen=True)
class PlatformPreset:
    key: str
    text: str
    outcome: str
    outcome_rule: str  # 'stars' or 'recommend'
    extras: tuple[str, ...] = ()  # further columns the feature table keeps
    numeric: tuple[str, ...] = ()  # model inputs besides age and text features
    categorical: Mapping[str, str] = field(default_factory=dict)  # name prefix -> column
    age_from: str | None = None
    age_format: str | None = None  # 'epoch_ms' or 'date'
    date_formats: tuple[str, ...] = DEFAULT_FORMATS
    label_offset: int = 0

    @property
    def source_columns(self) -> list[str]:
        """Columns read from the raw table."""
        dated = [self.age_from] if self.age_from else []
        return [self.outcome, self.text, *self.extras, *dated]

    @property
    def model_numeric(self) -> list[str]:
        age = ["review_age_days"] if self.age_from else []
        return [*self.numeric, *age, *TEXT_FEATURES]

    @property
    def feature_columns(self) -> list[str]:
        """Columns of the finished feature table, after the review id."""
        age = ["review_age_days"] if self.age_from else []
        return [self.outcome, *self.extras, "negative_experience", *age, *TEXT_FEATURES]

    def label(self) -> Column:
        if self.outcome_rule == "stars":
            return label_rating(F.col(self.outcome), self.label_offset)
        return label_recommend(F.col(self.outcome))


def _amazon(key: str) -> PlatformPreset:
    return PlatformPreset(
        key=key,
        text="text",
        outcome="rating",
        outcome_rule="stars",
        extras=("helpful_vote", "verified_purchase"),
        numeric=("helpful_vote",),
        categorical={"verified_ohe__": "verified_purchase"},
        age_from="timestamp",
        age_format="epoch_ms",
    )


STEAM = PlatformPreset(
    key="steam",
    text="review",
    outcome="recommend",
    outcome_rule="recommend",
    extras=("playtime", "helpfulness", "early_access_review"),
    numeric=("playtime", "helpfulness"),
    categorical={"early_access_ohe__": "early_access_review"},
    age_from="post_date",
    age_format="date",
)
YELP = PlatformPreset(key="yelp", text="text", outcome="label", outcome_rule="stars")
PRESETS = {
    p.key: p
    for p in (
        _amazon("amazon_beauty"),
        _amazon("amazon_clothing"),
        _amazon("amazon_electronics"),
        _amazon("amazon_health"),
        STEAM,
        YELP,
    )
}


def star_corrected(preset: PlatformPreset) -> PlatformPreset:
    """Read 0-4 labels as 1-5 stars before the thresholds apply."""
    return replace(preset, label_offset=1)
