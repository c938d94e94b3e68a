"""What a run did, as one row."""

from __future__ import annotations

import time
from dataclasses import dataclass, field
from typing import Any

from pyspark.sql import DataFrame, SparkSession

_COLUMNS = (
    "job string, elapsed_seconds double, rows_read long, rows_written long, "
    "rows_dropped long, dq_checks_passed long, dq_checks_failed long, "
    "extra map<string,string>"
)


@dataclass
class RunMetrics:
    job: str
    rows_read: int = 0
    rows_written: int = 0
    dq_checks_passed: int = 0
    dq_checks_failed: int = 0
    extra: dict[str, Any] = field(default_factory=dict)
    started: float = field(default_factory=time.monotonic)
    elapsed_seconds: float = 0.0

    @property
    def rows_dropped(self) -> int:
        return self.rows_read - self.rows_written

    def finish(self) -> RunMetrics:
        self.elapsed_seconds = round(time.monotonic() - self.started, 3)
        return self

    def to_dict(self) -> dict[str, Any]:
        names = ("elapsed_seconds", "rows_read", "rows_written", "rows_dropped")
        checks = ("dq_checks_passed", "dq_checks_failed")
        return {name: getattr(self, name) for name in (*names, *checks)} | self.extra

    def to_frame(self, spark: SparkSession) -> DataFrame:
        counted = {k: v for k, v in self.to_dict().items() if k not in self.extra}
        extra = {k: str(v) for k, v in self.extra.items()}
        return spark.createDataFrame([(self.job, *counted.values(), extra)], _COLUMNS)
