"""Roll-ups that a weekly job adds to instead of reading all weeks again.

Per run, ``<root>/parts/<run>`` holds the weeks that run worked out. A manifest, published as one
small table, says which run speaks for which week; readers see the weeks of one manifest.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterable
from datetime import date, timedelta
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ebbtide.config import ChurnConfig
from ebbtide.functions.skew import delete_folder
from ebbtide.operators import activity as operators
from ebbtide.sources import publish

WEEK = timedelta(days=7)
TABLES = ("weekly", "daily")


def monday(day: date) -> date:
    return day - timedelta(days=day.weekday())


def runs_of(weeks: Iterable[date]) -> list[tuple[date, date]]:
    """First and last week of each unbroken run."""
    out: list[tuple[date, date]] = []
    for week in sorted(weeks):
        if out and week - out[-1][1] == WEEK:
            out[-1] = out[-1][0], week
        else:
            out.append((week, week))
    return out


def days_of(weeks: Iterable[date], day: str = "date_of_event") -> Column:
    """Rows of these weeks, as literal bounds that reach the scan and its partitions."""
    bounds = [F.col(day).between(F.lit(first), F.lit(last + timedelta(days=6)))
              for first, last in runs_of(weeks)]
    return reduce(Column.__or__, bounds, F.lit(False))


class WeeklyState:
    """Weekly and daily roll-ups of the activity, kept by week below ``root``.

    ``update`` reads the weeks that are missing or named as corrected, and nothing else. ``weekly``
    and ``daily`` equal ``activity_weekly_rollup`` and ``daily_activity`` over all of the activity.
    """

    def __init__(self, spark: SparkSession, root: str, cfg: ChurnConfig, *, keep: int = 3):
        self.spark, self.root, self.cfg, self.keep = spark, root.rstrip("/"), cfg, keep

    @property
    def wanted(self) -> list[date]:
        """Mondays of the weeks that the extract touches."""
        first, last = monday(self.cfg.extract_min_date), monday(self.cfg.max_date)
        return [first + i * WEEK for i in range((last - first).days // 7 + 1)]

    def _manifest(self, version: str) -> dict[date, str]:
        rows = self.spark.read.parquet(f"{version}/weeks").collect()
        return {row["week"]: row["run"] for row in rows}

    @property
    def done(self) -> dict[date, str]:
        """Week to the run that worked it out; one row a week."""
        known = publish.versions(self.spark, f"{self.root}/manifest")
        return self._manifest(publish.current(self.spark, f"{self.root}/manifest")) if known else {}

    def update(self, activity: DataFrame, corrected: Iterable[date] = ()) -> list[date]:
        """Works out missing and corrected weeks; returns them.

        ``corrected`` are any days of weeks whose rows have changed since. The new parts count
        once the manifest names them, so a run that fails leaves the state as it was.
        """
        done, wanted = self.done, self.wanted
        late = {monday(day) for day in corrected}
        weeks = [w for w in wanted if w not in done or w in late]
        if not weeks:
            return []
        run = uuid.uuid4().hex
        rows = activity.where(days_of(weeks))
        parts = {"weekly": operators.weekly_parts(self._scan(rows), self.cfg),
                 "daily": operators.daily_rollup(self._scan(rows), self.cfg).withColumn(
                     "week", operators.week_of(F.col("date_of_event")))}
        for name, df in parts.items():
            df.write.partitionBy("week").parquet(f"{self.root}/parts/{run}/{name}")
        now = {w: r for w, r in done.items() if w in wanted} | dict.fromkeys(weeks, run)
        listed = self.spark.createDataFrame(sorted(now.items()), "week date, run string")
        publish.publish(self.spark, f"{self.root}/manifest", {"weeks": listed.coalesce(1)},
                        keep=self.keep)
        self._clean()
        return weeks

    def _scan(self, rows: DataFrame) -> DataFrame:
        return rows.where(F.col("destination").isin(*self.cfg.destinations)
                          & F.col("user_id").isNotNull())

    def _clean(self) -> None:
        """Removes parts that no kept manifest names."""
        root = f"{self.root}/manifest"
        named = {run for _, version in publish.versions(self.spark, root)
                 for run in self._manifest(f"{root}/versions/{version}").values()}
        for run in publish.listed(self.spark, f"{self.root}/parts"):
            if run not in named:
                delete_folder(self.spark, f"{self.root}/parts/{run}")

    def _read(self, name: str, like: DataFrame) -> DataFrame:
        """The stored weeks of a table; each run's folder is read for the weeks it speaks for."""
        by_run: dict[str, list[date]] = {}
        for week, run in self.done.items():
            if week in self.wanted:
                by_run.setdefault(run, []).append(week)
        parts = [self.spark.read.schema(like.schema).parquet(
            f"{self.root}/parts/{run}/{name}").where(F.col("week").isin(weeks))
            for run, weeks in sorted(by_run.items())]
        return reduce(DataFrame.unionByName, parts) if parts else like.limit(0)

    def weekly(self, activity: DataFrame) -> DataFrame:
        """(user, product, week) over the extract; activity only lends its schema."""
        like = operators.weekly_parts(self._scan(activity), self.cfg)
        first = monday(self.cfg.extract_min_date)
        whole = (F.col("week") > F.lit(first)) if first < self.cfg.extract_min_date else F.lit(True)
        return operators.weekly_of_parts(
            self._read("weekly", like).where(whole | F.col("is_sunday")))

    def daily(self, activity: DataFrame) -> DataFrame:
        """The daily roll-up of the feature windows."""
        like = operators.daily_rollup(self._scan(activity), self.cfg).withColumn(
            "week", operators.week_of(F.col("date_of_event")))
        inside = F.col("date_of_event").between(
            F.lit(self.cfg.window_min_date), F.lit(self.cfg.window_max_date))
        return self._read("daily", like).where(inside).drop("week")
