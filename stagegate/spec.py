"""Declarative description of one pipeline dataset and its layers.

A ``DatasetSpec`` holds everything the checks need besides the data: business
key, SCD type, per-stage NOT NULL columns, expected schemas, active-flag column,
batch column, business rules and an optional lookup for referential integrity.
It lives on the driver and is tiny; the data stay in DataFrames.
"""

from __future__ import annotations

import enum
import json
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


# Stage, mode and SCD-type names as used in configs and results.
class Stage(str, enum.Enum):
    SOURCE_TO_STAGING = "source_to_staging"
    STAGING_TO_TARGET = "staging_to_target"


class Mode(str, enum.Enum):
    SOURCE_TO_STAGING = "source_to_staging"
    STAGING_TO_TARGET = "staging_to_target"
    BOTH = "both"

    @property
    def stages(self) -> tuple[Stage, ...]:
        if self is Mode.SOURCE_TO_STAGING:
            return (Stage.SOURCE_TO_STAGING,)
        if self is Mode.STAGING_TO_TARGET:
            return (Stage.STAGING_TO_TARGET,)
        return (Stage.SOURCE_TO_STAGING, Stage.STAGING_TO_TARGET)

    @property
    def layers(self) -> tuple[str, ...]:
        """Layers a mode reads, in load order (staging once for ``both``)."""
        if self is Mode.SOURCE_TO_STAGING:
            return ("source", "staging")
        if self is Mode.STAGING_TO_TARGET:
            return ("staging", "target")
        return ("source", "staging", "target")


class ScdType(str, enum.Enum):
    TYPE1 = "type1"
    TYPE2 = "type2"


def parse_mode(value: str | Mode) -> Mode:
    try:
        return Mode(value)
    except ValueError:
        raise ValueError(f"unknown validation mode {value!r}; expected one of {[m.value for m in Mode]}") from None


def parse_scd_type(value: str | ScdType | None) -> ScdType:
    if value is None:
        return ScdType.TYPE1
    try:
        return ScdType(value)
    except ValueError:
        raise ValueError(f"unknown scd_type {value!r}; expected 'type1' or 'type2'") from None


# The four type names accepted by the original JSON schema files,
# mapped to Spark types.  Any other name is read as a Spark DDL type string.
LEGACY_TYPE_NAMES = {
    "StringType": T.StringType(),
    "IntegerType": T.IntegerType(),
    "FloatType": T.FloatType(),
    "BooleanType": T.BooleanType(),
}


_SIMPLE_DDL = {
    "string": T.StringType, "int": T.IntegerType, "integer": T.IntegerType, "bigint": T.LongType,
    "long": T.LongType, "smallint": T.ShortType, "short": T.ShortType, "tinyint": T.ByteType, "byte": T.ByteType,
    "double": T.DoubleType, "float": T.FloatType, "real": T.FloatType, "boolean": T.BooleanType,
    "date": T.DateType, "timestamp": T.TimestampType, "timestamp_ntz": T.TimestampNTZType, "binary": T.BinaryType,
}


def _parse_type(name: str) -> T.DataType:
    if name in LEGACY_TYPE_NAMES:
        return LEGACY_TYPE_NAMES[name]
    if name.strip().lower() in _SIMPLE_DDL:
        return _SIMPLE_DDL[name.strip().lower()]()
    cls = getattr(T, name, None) if name.endswith("Type") else None  # e.g. "LongType", "DateType"
    if isinstance(cls, type) and issubclass(cls, T.AtomicType):
        return cls()
    return T._parse_datatype_string(name)


def parse_expected_schema(fields: Sequence[Mapping] | T.StructType | str) -> T.StructType:
    """Expected schema from a JSON-style field list, a DDL string or a ``StructType``.

    Field entries are ``{"name", "type", "nullable"}``; ``nullable`` defaults to
    true.  ``type`` may be a legacy name (``IntegerType``), any ``<Atomic>Type``
    name, a DDL type (``decimal(10,2)``, ``array<string>``) or a JSON type object.
    """
    if isinstance(fields, T.StructType):
        return fields
    if isinstance(fields, str):
        text = fields.strip()
        if text.startswith("{"):
            return T.StructType.fromJson(json.loads(text))
        parsed = T._parse_datatype_string(text)  # Spark's DDL parser (needs an active session)
        if not isinstance(parsed, T.StructType):
            raise ValueError(f"schema DDL must describe a struct, got {parsed.simpleString()}")
        return parsed
    out = []
    for f in fields:
        typ = f["type"]
        dt = T._parse_datatype_json_value(typ) if isinstance(typ, dict) else _parse_type(str(typ))
        out.append(T.StructField(f["name"], dt, nullable=bool(f.get("nullable", True))))
    return T.StructType(out)


@dataclass(frozen=True)
class Rule:
    """A business rule: rows for which ``violation`` is true break it.

    ``violation`` is a Column or a SQL predicate string.  ``requires`` lists the
    columns it needs; when any is absent the rule is skipped (as the original
    'amount must not be negative' rule is skipped for tables without ``amount``).
    """

    name: str
    violation: str | Column
    requires: tuple[str, ...] = ()

    def predicate(self) -> Column:
        return F.expr(self.violation) if isinstance(self.violation, str) else self.violation

    def applies_to(self, df: DataFrame) -> bool:
        cols = set(df.columns)
        return all(c in cols for c in self.requires)


# The one rule shipped with the original framework.
NON_NEGATIVE_AMOUNT = Rule("non_negative_amount", "`amount` < 0", ("amount",))


@dataclass(frozen=True)
class Lookup:
    """Referential integrity: ``target_column`` values must appear in ``table.lookup_column``."""

    table: DataFrame | None
    lookup_column: str
    target_column: str
    name: str = "lookup"
    error: str = ""  # why the table could not be loaded


@dataclass(frozen=True)
class DatasetSpec:
    name: str
    key: tuple[str, ...]
    scd_type: ScdType = ScdType.TYPE1
    non_null: Mapping[Stage, tuple[str, ...]] = field(default_factory=dict)
    staging_schema: T.StructType | None = None
    target_schema: T.StructType | None = None
    active_flag: str | None = None
    active_values: tuple[str, ...] = ("Y", "TRUE", "1")
    inactive_values: tuple[str, ...] = ("N", "FALSE", "0")
    batch_column: str = "batch_date"
    rules: tuple[Rule, ...] = (NON_NEGATIVE_AMOUNT,)
    lookup: Lookup | None = None
    check_nullable: bool = True
    sample_size: int = 10
    # a key with more rows than max(hot_key_rows, rows / max_hot_keys) is routed through a
    # bounded broadcast instead of a key-partitioned shuffle (see operators/skew.py)
    hot_key_rows: int = 100_000
    max_hot_keys: int = 100_000
    # column of CSV layers with the text of rows that do not parse as declared (see sources/readers.py); not data
    unparsable_column: str | None = None

    def __post_init__(self):
        if isinstance(self.key, str):
            object.__setattr__(self, "key", (self.key,))
        if not self.key or any(not isinstance(k, str) or not k for k in self.key):
            raise ValueError("business key must be a non-empty list of column names")
        object.__setattr__(self, "key", tuple(self.key))
        object.__setattr__(self, "scd_type", parse_scd_type(self.scd_type))
        object.__setattr__(self, "non_null", normalise_non_null(self.non_null))
        object.__setattr__(self, "rules", tuple(self.rules))

    def non_null_for(self, stage: Stage) -> tuple[str, ...]:
        return self.non_null.get(stage, ())

    def expected_schema_for(self, stage: Stage) -> T.StructType | None:
        return self.staging_schema if stage is Stage.SOURCE_TO_STAGING else self.target_schema


def normalise_non_null(value) -> dict[Stage, tuple[str, ...]]:
    """A flat list applies to both stages; a dict is keyed by stage name."""
    if not value:
        return {}
    if isinstance(value, Mapping):
        return {Stage(k): tuple(v) for k, v in value.items()}
    cols = tuple(value)
    return {Stage.SOURCE_TO_STAGING: cols, Stage.STAGING_TO_TARGET: cols}
