"""Alerts before averages fall: a cumulative-sum detector per platform, live and in batch.

For each platform and day, ``n`` reviews of which ``negative`` are negative move a sum

    S = max(0, S + 1000 * negative - limit * n)

where ``limit`` (in thousandths) is the share of negative reviews that is still tolerated: the
usual share plus half of the rise worth an alert. A lasting small rise adds up day after day while
ordinary days pull the sum back to 0, so S passes ``bound`` (thousandths of a review) well before
the share over a long window does. ``alert`` marks days above the bound, ``started`` the first of
a row of such days. After more than ``idle_days`` days without reviews the sum starts anew.

Sums are integers, so results do not depend on the order of additions. The live job counts days in
a window aggregation; a day reaches the detector once the watermark has closed it, in order,
and the detector keeps one small row per platform, which a timer removes when the platform has
been quiet for ``idle_days``. Files may come in any order within ``lateness``. The batch form
gives the same rows for closed days by running sums, with no limit on lateness.

Rows without platform, time or outcome are left out; repeated ids count once; empty input
gives no rows.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterator
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from gripelens.streaming.monitor import negative_share

CHANGES = "platform string, day timestamp, n bigint, negative bigint, score bigint, alert boolean, started boolean"


@dataclass(frozen=True)
class ChangeDetector:
    limit: int  # tolerated share of negative reviews, in thousandths
    bound: int  # sum from which a day alerts, in thousandths of a review
    idle_days: int = 30

    def _increment(self) -> Column:
        return F.col("negative") * 1000 - F.col("n") * self.limit

    def daily(self, reviews: DataFrame, lateness: str = "1 day") -> DataFrame:
        """(platform, day, n, negative) of a table or a stream of reviews."""
        known = reviews.where(F.col("platform").isNotNull() & F.col("event_ts").isNotNull())
        counted = negative_share(known, lateness=lateness)
        return counted.select("platform", F.col("window_start").alias("day"), "n", "negative")

    def batch(self, reviews: DataFrame) -> DataFrame:
        """All days of a table of reviews. Windows run over a platform's days."""
        days = self.daily(reviews).withColumn("_step", self._increment())
        order = W.partitionBy("platform").orderBy("day")
        upto = order.rowsBetween(W.unboundedPreceding, W.currentRow)
        gap = F.datediff("day", F.lag("day").over(order)) > self.idle_days
        parts = days.withColumn("_part", F.sum(F.when(gap, 1).otherwise(0)).over(upto))
        within = W.partitionBy("platform", "_part").orderBy("day")
        so_far = within.rowsBetween(W.unboundedPreceding, W.currentRow)
        summed = parts.withColumn("_sum", F.sum("_step").over(so_far))
        # S is the running sum less its lowest value so far (0 before the first day).
        score = F.col("_sum") - F.least(F.min("_sum").over(so_far), F.lit(0))
        alert = F.col("score") > self.bound
        scored = summed.withColumn("score", score).withColumn("alert", alert)
        before = F.coalesce(F.lag("alert").over(within), F.lit(False))
        return scored.withColumn("started", F.col("alert") & ~before).select(
            "platform", "day", "n", "negative", "score", "alert", "started"
        )

    def stream(self, reviews: DataFrame, lateness: str = "1 day") -> DataFrame:
        """The same days of a stream of reviews, each as soon as the watermark has closed it."""
        return (
            self.daily(reviews, lateness)
            .groupBy("platform")
            .transformWithStateInPandas(_detector(self.limit, self.bound, self.idle_days), CHANGES, "append", "eventTime")
        )


def _detector(limit: int, bound: int, idle_days: int) -> StatefulProcessor:
    """Spark starts a Python worker of its own to set a processor up; the class is made in here so that
    it travels whole and that worker need not find this package."""
    one_day = dt.timedelta(days=1)

    class Detector(StatefulProcessor):
        """Keeps (last day, score, alert) of a platform."""

        def init(self, handle: StatefulProcessorHandle) -> None:
            self.handle = handle
            self.state = handle.getValueState("sum", "day timestamp, score bigint, alert boolean")

        def _timer(self, day: dt.datetime) -> int:
            """Milliseconds at which a platform without later days counts as idle."""
            due = day + (idle_days + 1) * one_day
            return int(due.replace(tzinfo=dt.timezone.utc).timestamp() * 1000)

        def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
            days = pd.concat(list(rows)).sort_values("day")
            last, score, alert = self.state.get() if self.state.exists() else (None, 0, False)
            if last is not None:
                self.handle.deleteTimer(self._timer(last))
            made = []
            for r in days.itertuples(index=False):
                day = r.day.to_pydatetime().replace(tzinfo=None)
                if last is not None and (day - last) > idle_days * one_day:
                    score, alert = 0, False
                score = max(0, score + 1000 * int(r.negative) - limit * int(r.n))
                above = score > bound
                made.append((key[0], r.day, int(r.n), int(r.negative), score, above, above and not alert))
                last, alert = day, above
            self.state.update((last, score, alert))
            self.handle.registerTimer(self._timer(last))
            yield pd.DataFrame(made, columns=["platform", "day", "n", "negative", "score", "alert", "started"])

        def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
            self.state.clear()
            return iter([])

        def close(self) -> None:
            pass

    return Detector()
