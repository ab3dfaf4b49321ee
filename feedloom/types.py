"""Small value types shared by the operators."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

# Audit columns of a loaded row, load types, and change types.
AUDIT_COLUMNS = [
    "elt_execution_date",
    "elt_source",
    "elt_load_type",
    "elt_delete_ind",
    "elt_dml_type",
    "elt_reception_date",
    "elt_process_id",
    "elt_firm",
    "elt_pipelinekey",
]
PARTITION_COLUMN = "elt_partition_date"
ROW_KEY = "elt_primary_key"
INTEGRATION_ID = "elt_integration_id"
CONTENT_HASH = "elt_columns_hash"
ACTION = "elt_stream_action"
DML_TYPES = ("U", "I", "D")
LOAD_TYPES = ("FULL", "INCREMENTAL")
NO_KEY = "N/A"
OPEN_END_DATE = "9999-12-31"


@dataclass(frozen=True)
class FieldSpec:
    """One field of a fixed-width record; ``start`` is 1-based."""

    name: str
    start: int
    length: int
    scale: int | None = None
    record: str = ""
    segment: str = ""
    condition: str = ""
    overlap: str = ""

    @property
    def end(self) -> int:
        return self.start + self.length - 1


@dataclass(frozen=True)
class ColumnSpec:
    """One column of a delimited record, by ordinal."""

    name: str
    is_key: bool = False
    type_name: str = "string"


@dataclass(frozen=True)
class FeedTable:
    name: str
    df: DataFrame
    keys: list[str] = field(default_factory=list)


@dataclass(frozen=True)
class RunContext:
    """What the audit columns of one load say."""

    execution_date: str
    source: str
    reception_date: str
    is_full_load: bool
    pipeline_key: str
    process_id: str
    firm: str
    partition_value: str
    dml_type: str | None = None

    @property
    def load_type(self) -> str:
        return "FULL" if self.is_full_load else "INCREMENTAL"

    @property
    def change_type(self) -> str:
        kind = (self.dml_type or ("I" if self.is_full_load else "U")).upper()
        if kind not in DML_TYPES:
            raise ValueError(f"elt_dml_type must be one of {DML_TYPES}, not {kind}")
        return kind


@dataclass(frozen=True)
class Feed:
    """How one feed is read: where its lines come from and which tables they become."""

    name: str
    scan: Callable[[SparkSession, str], DataFrame]
    transform: Callable[[DataFrame], dict[str, FeedTable]]

    def tables(self, spark: SparkSession, path: str) -> dict[str, FeedTable]:
        return self.transform(self.scan(spark, path))
