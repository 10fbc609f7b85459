"""When a job runs: pinned for reruns, otherwise the session clock."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date, datetime

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Clock:
    """Processing day and instant. Unset parts follow Spark's current date and timestamp."""

    day: date | None = None
    instant: datetime | None = None

    def today(self) -> Column:
        if self.day is not None:
            return F.lit(self.day)
        if self.instant is not None:
            return F.lit(self.instant.date())
        return F.current_date()

    def now(self) -> Column:
        pinned = self._pinned()
        return F.current_timestamp() if pinned is None else F.lit(pinned).cast("timestamp")

    def wall(self) -> Column:
        """The instant without a zone, for date and hour arithmetic."""
        pinned = self._pinned()
        return F.localtimestamp() if pinned is None else F.lit(pinned).cast("timestamp_ntz")

    def held(self, spark: SparkSession) -> Clock:
        """The clock, pinned to this moment unless it is pinned: the same for several jobs."""
        if self._pinned() is not None:
            return self
        return Clock(instant=spark.range(1).select(self.wall()).first()[0])

    def _pinned(self) -> str | None:
        # As text, so that the session's time zone reads it, not the driver's.
        if self.instant is not None:
            return self.instant.isoformat(sep=" ")
        return None if self.day is None else f"{self.day} 00:00:00"


NOW = Clock()
