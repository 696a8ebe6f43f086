"""Row counts around filters and deduplication, taken while the job runs."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F


class RowCounts:
    """Named row counts, filled by the first action on the tapped plan."""

    def __init__(self) -> None:
        self._taps: dict[str, Observation] = {}

    def tap(self, df: DataFrame, stage: str) -> DataFrame:
        self._taps[stage] = Observation(stage)
        return df.observe(self._taps[stage], F.count(F.lit(1)).alias("rows"))

    def counts(self) -> dict[str, int]:
        """Counts by stage; waits for the action that fills them."""
        return {stage: tap.get["rows"] for stage, tap in self._taps.items()}

    def removed(self) -> dict[str, int]:
        """Rows lost between each stage and the one before it."""
        rows = self.counts()
        stages = list(rows)
        return {b: rows[a] - rows[b] for a, b in zip(stages, stages[1:])}
