"""Oreflow: raw -> bronze -> silver -> gold tables on Spark DataFrames."""

from oreflow.operators.cleaning import (
    AddAuditColumns,
    AddIngestionColumns,
    BaseTransformer,
    CastColumns,
    ComputeDerivedColumns,
    DropDuplicates,
    DropNullKeys,
    EnforceSchema,
    FilterRows,
    KeepLatest,
    MaskPiiColumns,
    NormaliseStrings,
    RenameColumns,
    Transformer,
    TrimStrings,
    compose,
)
from oreflow.operators.quality import (
    AcceptedValuesCheck,
    BaseCheck,
    CheckResult,
    DataQualityChecker,
    DataQualityError,
    NotNullCheck,
    RangeCheck,
    ReferentialCheck,
    RegexCheck,
    RowCountCheck,
    Severity,
    UniquenessCheck,
)
from oreflow.sources.readers import create_reader
from oreflow.sources.schemas import get_schema
from oreflow.sources.snapshots import SnapshotTable
from oreflow.sources.writers import create_writer

__all__ = [
    "AcceptedValuesCheck",
    "AddAuditColumns",
    "AddIngestionColumns",
    "BaseCheck",
    "BaseTransformer",
    "CastColumns",
    "CheckResult",
    "ComputeDerivedColumns",
    "DataQualityChecker",
    "DataQualityError",
    "DropDuplicates",
    "DropNullKeys",
    "EnforceSchema",
    "FilterRows",
    "KeepLatest",
    "MaskPiiColumns",
    "NormaliseStrings",
    "NotNullCheck",
    "RangeCheck",
    "ReferentialCheck",
    "RegexCheck",
    "RenameColumns",
    "RowCountCheck",
    "Severity",
    "SnapshotTable",
    "Transformer",
    "TrimStrings",
    "UniquenessCheck",
    "compose",
    "create_reader",
    "create_writer",
    "get_schema",
]
