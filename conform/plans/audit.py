"""The audit table: one row when a run opens, one for each result."""

from __future__ import annotations

import logging
import uuid
from dataclasses import dataclass, field
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import (
    BooleanType,
    DateType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampType,
)

from conform.sinks.casts import WrittenCast
from conform.sinks.tables import insert
from conform.sources import rows_frame

# The columns of the audit table.
AUDIT_SCHEMA = StructType(
    [
        StructField("fuente", StringType()),
        StructField("destino", StringType()),
        StructField("nombreProceso", StringType()),
        StructField("timestampEvento", TimestampType()),
        StructField("estado", StringType()),
        StructField("descripcion", StringType()),
        StructField("cantidadRegistrosOrigen", LongType()),
        StructField("cantidadRegistrosCargados", LongType()),
        StructField("cargaForzada", BooleanType()),
        StructField("idProceso", StringType()),
        StructField("fechaEvento", DateType()),
    ]
)

_log = logging.getLogger(__name__)


class RunFailed(RuntimeError):
    """A run ended with status KO."""


@dataclass
class AuditRun:
    """The state of one run and the audit rows it has made so far.

    Counts come from the writers, messages from `info`, `warn` and `error`.
    """

    spark: SparkSession
    origin: str
    destination: str
    description: str | None = None
    forced: bool = False
    process: str = "DataTransformation"
    rows_origin: int = 0
    rows_loaded: int = 0
    status: str = "OK"
    run_id: str = field(default_factory=lambda: str(uuid.uuid4()))
    messages: list[str] = field(default_factory=list)
    events: list[tuple] = field(default_factory=list)
    saved: int = 0

    def __post_init__(self) -> None:
        self._event("Init", self.description)

    def info(self, message: str, keep: bool = False) -> None:
        _log.info(message)
        if keep:
            self.messages.append(message)

    def warn(self, message: str, keep: bool = False) -> None:
        _log.warning(message)
        if keep:
            self._blemish(message)

    def error(self, message: str, keep: bool = False) -> None:
        _log.error(message)
        if keep:
            self._blemish(message)

    def casts(self, written: WrittenCast) -> None:
        """Take the counts of a write, and warn of every column that lost values."""
        self.rows_loaded = written.written
        for column, counts in written.counts.items():
            if counts.lost:
                self.warn(f"{column}: {counts.lost} values lost in the cast", keep=True)

    def append(self, status: str | None = None, description: str | None = None) -> None:
        """Add a row, by default with the run's status and kept messages."""
        kept = "".join(f"{message}, " for message in self.messages)
        self._event(
            self.status if status is None else status,
            kept if description is None else description,
        )

    def fail(self, message: str, table: str | None = None) -> RunFailed:
        """Close the run as KO, save its rows, and return the error to raise."""
        _log.error(message)
        self.status = "KO"
        self.rows_loaded = 0
        self.append("KO", message)
        if table is not None:
            self.save(table)
        return RunFailed(message)

    def rows(self) -> DataFrame:
        return self._frame(self.events)

    def save(self, table: str) -> bool:
        """Append the rows not saved yet to the audit table. Never fails the run."""
        try:
            if not self.spark.catalog.tableExists(table):
                self.warn(f"the audit table {table} does not exist", keep=True)
                return False
            if self.events[self.saved :]:
                insert(self._frame(self.events[self.saved :]), table)
                self.saved = len(self.events)
        except Exception as failure:  # a failed job is no PySparkException
            self.error(f"could not save the audit rows in {table}: {failure}")
            return False
        return True

    def _frame(self, events: list[tuple]) -> DataFrame:
        """Audit rows, each dated by its time in the session's zone."""
        rows = rows_frame(self.spark, events, AUDIT_SCHEMA)
        return rows.withColumn("fechaEvento", F.to_date("timestampEvento"))

    def _blemish(self, message: str) -> None:
        self.status = "WARN"
        self.messages.append(message)

    def _event(self, status: str, description: str | None) -> None:
        self.events.append(
            (
                self.origin,
                self.destination,
                self.process,
                datetime.now(timezone.utc),
                status,
                description,
                self.rows_origin,
                self.rows_loaded,
                self.forced,
                self.run_id,
                None,
            )
        )
