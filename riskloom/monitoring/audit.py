"""Append-only audit table of job steps."""

from __future__ import annotations

import json
import logging
from collections.abc import Iterator
from contextlib import contextmanager
from dataclasses import dataclass
from datetime import datetime, timezone
from decimal import Decimal

from pyspark.sql import DataFrame, SparkSession

from riskloom.schema import AUDIT_LOG

# Known operations and statuses.
OPERATIONS = {
    "EXTRACT": "Data extraction from source",
    "VALIDATE": "Data quality checks",
    "TRANSFORM": "Feature engineering",
    "SCORE": "Model scoring",
    "PERSIST": "Results persistence",
    "ALERT": "Alert generation",
}
STATUSES = {"STARTED", "COMPLETED", "FAILED"}

_log = logging.getLogger(__name__)


def _now() -> datetime:
    return datetime.now(timezone.utc)


@dataclass
class AuditLog:
    spark: SparkSession
    path: str
    triggered_by: str = "batch"
    source_system: str = "riskloom"

    def append(self, batch_id: str, operation: str, status: str, **facts) -> None:
        """Add one entry. Unknown operations and statuses are written with a warning."""
        if operation not in OPERATIONS:
            _log.warning("unknown operation %s", operation)
        if status not in STATUSES:
            _log.warning("unknown status %s", status)
        seconds = facts.get("duration_seconds")
        metadata = facts.get("metadata")
        entry = {
            "timestamp": _now(),
            "batch_id": batch_id,
            "operation": operation,
            "status": status,
            "records_processed": facts.get("records_processed"),
            "records_flagged": facts.get("records_flagged"),
            "duration_seconds": None if seconds is None else Decimal(f"{seconds:.3f}"),
            "error_message": facts.get("error_message"),
            "metadata": json.dumps(metadata) if metadata else None,
            "triggered_by": self.triggered_by,
            "source_system": self.source_system,
        }
        row = self.spark.createDataFrame([entry], AUDIT_LOG)
        row.coalesce(1).write.mode("append").parquet(self.path)

    @contextmanager
    def step(self, batch_id: str, operation: str) -> Iterator[dict]:
        """Log start, then completion with the counts put into the yielded dict, or the failure."""
        started = _now()
        self.append(batch_id, operation, "STARTED")
        facts: dict = {}
        try:
            yield facts
        except Exception as error:
            took = (_now() - started).total_seconds()
            known = facts | {"duration_seconds": took, "error_message": str(error)}
            self.append(batch_id, operation, "FAILED", **known)
            raise
        took = (_now() - started).total_seconds()
        self.append(batch_id, operation, "COMPLETED", **(facts | {"duration_seconds": took}))

    def read(self) -> DataFrame:
        return self.spark.read.schema(AUDIT_LOG).parquet(self.path)
