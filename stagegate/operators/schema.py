"""Schema check: compare a layer's schema with the declared one, by field name.

Pure metadata (no job).  Issues come in declared-field order (missing, type,
nullable), then fields present but not declared, in the layer's order.  Column
order is ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

ISSUE_SCHEMA = T.StructType(
    [
        T.StructField("field_name", T.StringType(), False),
        T.StructField("issue", T.StringType(), False),
        T.StructField("actual", T.StringType(), True),
        T.StructField("expected", T.StringType(), True),
    ]
)


@dataclass(frozen=True)
class SchemaIssue:
    field_name: str
    issue: str  # missing | type | nullable | extra
    actual: str | None
    expected: str | None

    def message(self) -> str:
        if self.issue == "missing":
            return f"missing field '{self.field_name}' (expected {self.expected})"
        if self.issue == "extra":
            return f"unexpected field '{self.field_name}' ({self.actual})"
        return f"{self.issue} mismatch for '{self.field_name}': actual {self.actual}, expected {self.expected}"


def compare_schemas(actual: T.StructType, expected: T.StructType, check_nullable: bool = True) -> list[SchemaIssue]:
    have = {f.name: f for f in actual.fields}
    want = {f.name: f for f in expected.fields}
    issues: list[SchemaIssue] = []
    for name, exp in want.items():
        got = have.get(name)
        if got is None:
            issues.append(SchemaIssue(name, "missing", None, exp.dataType.simpleString()))
            continue
        if got.dataType != exp.dataType:
            issues.append(SchemaIssue(name, "type", got.dataType.simpleString(), exp.dataType.simpleString()))
        if check_nullable and got.nullable != exp.nullable:
            issues.append(SchemaIssue(name, "nullable", str(got.nullable).lower(), str(exp.nullable).lower()))
    for name, got in have.items():
        if name not in want:
            issues.append(SchemaIssue(name, "extra", got.dataType.simpleString(), None))
    return issues


def schema_issues(
    actual: T.StructType, expected: T.StructType, spark: SparkSession, check_nullable: bool = True
) -> DataFrame:
    """Issues as a DataFrame (``field_name``, ``issue``, ``actual``, ``expected``)."""
    rows = [(i.field_name, i.issue, i.actual, i.expected) for i in compare_schemas(actual, expected, check_nullable)]
    return spark.createDataFrame(rows, ISSUE_SCHEMA)
