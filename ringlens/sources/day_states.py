"""Where the states of days and windows are kept, so that tomorrow's features read tomorrow's calls and one old day.

A folder holds batches of described days and windows over them. Both count from
the moment their number in a log is claimed; a job that is killed leaves its
files unread and the state as it was. A day belongs to the latest batch that
describes it, and a window notes the batch of each of its days, so a day that
was described again is exchanged when a window next moves.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterable
from dataclasses import asdict, fields
from datetime import date, timedelta
from functools import reduce
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ringlens.config import FeatureConfig
from ringlens.functions.timing import DayWindow
from ringlens.operators.daily import DayState, WindowState, describe_days, move_window, open_window, window_aggregates
from ringlens.operators.features import derive_features, marked_calls
from ringlens.sources.versions import claim, entry, numbers, remove

EPOCH = date(1970, 1, 1)


def _numbers(window: DayWindow) -> list[int]:
    first = (window.start - EPOCH).days
    return list(range(first, first + window.days))


class DayStates:
    """Daily states under ``folder``, all of them made with one configuration.

    Provider prefixes are looked up when a day is described; after a change of
    the provider table the days have to be described again.
    """

    def __init__(
        self, spark: SparkSession, folder: str, config: FeatureConfig = FeatureConfig(), keep: int = 2
    ) -> None:
        self.spark, self.folder, self.config, self.keep = spark, folder.rstrip("/"), config, keep
        # Which reports are heavy decides between plans, not results.
        meaning = {name: value for name, value in asdict(config).items() if name != "heavy_rows"}
        self.meaning = json.dumps(meaning, sort_keys=True)

    def _log(self, name: str) -> list[dict[str, Any]]:
        log = f"{self.folder}/{name}/_log"
        found = [json.loads(entry(self.spark, log, number)) for number in numbers(self.spark, log)]
        if any(item["config"] != self.meaning for item in found):
            raise ValueError(f"{log} was made with another configuration")
        return found

    def _commit(self, name: str, item: dict[str, Any]) -> None:
        log = f"{self.folder}/{name}/_log"
        text = json.dumps({**item, "config": self.meaning})
        while True:
            known = numbers(self.spark, log)
            if claim(self.spark, log, known[-1] + 1 if known else 1, text):
                return

    def _write(self, path: str, state: DayState | WindowState) -> dict[str, str]:
        """Writes the tables of a state and gives their schemas, which a folder without rows does not tell."""
        schemas = {}
        for item in fields(state):
            part = getattr(state, item.name)
            writer = part.write
            if "day" in part.columns:
                writer = part.repartition("day", "report").write.partitionBy("day")
            writer.parquet(f"{path}/{item.name}")
            schemas[item.name] = part.schema.json()
        return schemas

    def _read(self, kind: type, item: dict[str, Any]) -> Any:
        parts = {
            name: self.spark.read.schema(StructType.fromJson(json.loads(schema))).parquet(f"{item['path']}/{name}")
            for name, schema in item["schemas"].items()
        }
        return kind(**parts)

    def batches(self) -> dict[int, str]:
        """Every described day with the batch that holds it."""
        return {day: item["path"] for item in self._log("days") for day in item["days"]}

    def describe(self, calls: DataFrame, providers: DataFrame, days: Iterable[int]) -> None:
        """Describes whole days, of which ``calls`` must hold all calls; days without calls count as described."""
        wanted = sorted(set(days))
        if not wanted:
            return
        kind = {field.name.lower(): field.dataType for field in calls.schema.fields}["time"]
        spans = [DayWindow(EPOCH + timedelta(days=last), last - first + 1) for first, last in _runs(wanted)]
        inside = F.lit(False)
        for span in spans:
            inside = inside | span.contains(F.col("time"), kind)
        state = describe_days(marked_calls(calls.where(inside), providers, self.config), self.config)
        path = f"{self.folder}/days/batch-{uuid.uuid4().hex}"
        self._commit("days", {"path": path, "days": wanted, "schemas": self._write(path, state)})

    def _days(self, held: Iterable[tuple[int, str]]) -> DayState:
        """States of (day, batch) pairs; batches are read by partition."""
        by_path: dict[str, list[int]] = {}
        for day, path in held:
            by_path.setdefault(path, []).append(day)
        items = {item["path"]: item for item in self._log("days")}
        parts = [self._read(DayState, items[path]).of_days(days) for path, days in sorted(by_path.items())]
        return reduce(DayState.union, parts)

    def move(self, window: DayWindow) -> WindowState:
        """The stored state of a window, made from the closest stored one of the same length.

        Reads the days by which the two differ; where these are more than the
        window has days, the window is built from all its days instead.
        """
        have = self.batches()
        missing = [day for day in _numbers(window) if day not in have]
        if missing:
            raise ValueError(f"{len(missing)} days of {window.label()} are not described, the first is {missing[0]}")
        wanted = {(day, have[day]) for day in _numbers(window)}

        def held(item: dict[str, Any]) -> set[tuple[int, str]]:
            return {(day, path) for day, path in item["held"]}

        stored = min(
            (item for item in self._log("windows") if len(item["held"]) == window.days),
            key=lambda item: len(held(item) ^ wanted),
            default=None,
        )
        if stored is None or len(held(stored) ^ wanted) > window.days:
            state = open_window(self._days(wanted))
        else:
            leaving, entering = held(stored) - wanted, wanted - held(stored)
            if not leaving and not entering:
                return self._read(WindowState, stored)
            # Only re-described or older days leave, and as many enter, as the lengths are equal.
            state = move_window(
                self._read(WindowState, stored), self._days(leaving), [day for day, _ in leaving], self._days(entering)
            )
        path = f"{self.folder}/windows/window-{uuid.uuid4().hex}"
        item = {"path": path, "held": sorted(wanted), "label": window.label(), "schemas": self._write(path, state)}
        self._commit("windows", item)
        self._remove_old_windows()
        return self._read(WindowState, item)

    def _remove_old_windows(self) -> None:
        """All but the last ``keep``, so that readers of the one before can finish; days stay."""
        log = f"{self.folder}/windows/_log"
        for number in numbers(self.spark, log)[: -self.keep]:
            old = json.loads(entry(self.spark, log, number))["path"]
            remove(self.spark, f"{log}/{number:012d}")
            remove(self.spark, old)

    def features(self, calls: DataFrame, providers: DataFrame, window: DayWindow) -> DataFrame:
        """``report_features`` of the window's calls; only days that are not described yet are read from ``calls``."""
        have = self.batches()
        self.describe(calls, providers, [day for day in _numbers(window) if day not in have])
        return derive_features(window_aggregates(self.move(window)))


def _runs(days: list[int]) -> list[tuple[int, int]]:
    """Sorted days as (first, last) of each unbroken run, which keeps the filter short."""
    runs: list[tuple[int, int]] = []
    for day in days:
        if runs and runs[-1][1] == day - 1:
            runs[-1] = (runs[-1][0], day)
        else:
            runs.append((day, day))
    return runs
