"""Data contracts: declared columns, types and value rules.

A contract is a small YAML file. All its value rules are counted in one
aggregate over the table, or as metrics observed while the table is written;
neither needs a job per rule.
"""

from __future__ import annotations

import logging
from dataclasses import dataclass
from pathlib import Path
from typing import Any, NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

try:
    import yaml
except ImportError:  # reported when a contract is loaded
    yaml = None

log = logging.getLogger(__name__)

# The type names a contract may use.
SPARK_TYPES: dict[str, T.DataType] = {
    "integer": T.IntegerType(),
    "int": T.IntegerType(),
    "long": T.LongType(),
    "double": T.DoubleType(),
    "float": T.FloatType(),
    "string": T.StringType(),
    "boolean": T.BooleanType(),
    "bool": T.BooleanType(),
    "date": T.DateType(),
    "timestamp": T.TimestampType(),
    "array<int>": T.ArrayType(T.IntegerType()),
    "array<double>": T.ArrayType(T.DoubleType()),
}

CONTRACT_DIR = Path(__file__).resolve().parents[1] / "contracts"


class Violation(NamedTuple):
    """One broken rule. ``violations`` counts rows, or is 1 for a schema rule."""

    field: str
    rule: str
    expected: str
    violations: int
    message: str


# Parts of messages that users search for.
MISSING = "Missing required field"
TYPE = "has type"
NULLS = "NULL values"
NOT_NULL = "NOT NULL"
BELOW = "below minimum"
ABOVE = "above maximum"
FOREIGN = "not in allowed values"


class ContractViolation(Exception):
    """A table breaks its contract; carries what was broken."""

    def __init__(self, contract: str, broken: list[Violation]):
        self.broken = broken
        lines = "\n".join(f"  - {v.message}" for v in broken)
        super().__init__(f"{contract}: {len(broken)} contract violation(s)\n{lines}")


@dataclass(frozen=True)
class Field:
    name: str
    type: str
    nullable: bool = True
    min_value: Any = None
    max_value: Any = None
    allowed_values: tuple | None = None
    default_value: Any = None

    @property
    def spark_type(self) -> T.DataType:
        return SPARK_TYPES[self.type]


@dataclass(frozen=True)
class ValueRule:
    """A condition that is true on rows that break the rule."""

    field: str
    rule: str
    expected: str
    broken: Column
    wording: str

    def violation(self, contract: str, count: int) -> Violation:
        text = f"{contract}.{self.field}: {count} rows with {self.wording}"
        return Violation(self.field, self.rule, self.expected, count, text)


@dataclass(frozen=True)
class Contract:
    name: str
    fields: tuple[Field, ...]
    partition_by: tuple[str, ...] = ()
    derived: tuple[tuple[str, str], ...] = ()

    # ---- loading ------------------------------------------------------------

    @classmethod
    def load(cls, path: str | Path) -> Contract:
        """V1: read a contract file; a missing or incomplete one is an error."""
        path = Path(path)
        if not path.exists():
            raise FileNotFoundError(f"Contract file not found: {path}")
        if yaml is None:
            raise ImportError("reading contract files needs the 'yaml' package")
        return cls.from_dict(yaml.safe_load(path.read_text()), str(path))

    @classmethod
    def named(cls, name: str) -> Contract:
        """A contract shipped with this package, such as ``silver/orders``."""
        return cls.load(CONTRACT_DIR / f"{name}.yml")

    @classmethod
    def from_dict(cls, body: Any, origin: str = "contract") -> Contract:
        if not isinstance(body, dict) or "name" not in body:
            raise ValueError(f"{origin}: no 'name'")
        if not isinstance(body.get("fields"), list):
            raise ValueError(f"{origin}: 'fields' must be a list")
        fields = []
        for entry in body["fields"]:
            if not isinstance(entry, dict) or "name" not in entry or "type" not in entry:
                raise ValueError(f"{origin}: every field needs 'name' and 'type': {entry}")
            kind = str(entry["type"]).lower()
            if kind not in SPARK_TYPES:
                known = ", ".join(SPARK_TYPES)
                raise ValueError(f"{origin}: unknown type '{kind}'; known types: {known}")
            allowed = entry.get("allowed_values")
            fields.append(
                Field(
                    name=entry["name"],
                    type=kind,
                    nullable=entry.get("nullable", True),
                    min_value=entry.get("min_value"),
                    max_value=entry.get("max_value"),
                    allowed_values=None if allowed is None else tuple(allowed),
                    default_value=entry.get("default_value"),
                )
            )
        derived = tuple(
            (step["field"], step["rule"])
            for step in body.get("transformations") or ()
            if "field" in step and "rule" in step
        )
        return cls(body["name"], tuple(fields), tuple(body.get("partition_by") or ()), derived)

    # ---- schema -------------------------------------------------------------

    def schema(self) -> T.StructType:
        """V4: the Spark schema the contract declares."""
        return T.StructType([T.StructField(f.name, f.spark_type, f.nullable) for f in self.fields])

    def text_schema(self) -> T.StructType:
        """The declared columns, all as text: how raw files are read."""
        return T.StructType([T.StructField(f.name, T.StringType()) for f in self.fields])

    def schema_violations(self, df: DataFrame) -> list[Violation]:
        """Missing and wrongly typed columns. Looks at the schema only."""
        actual = {f.name.lower(): f.dataType for f in df.schema.fields}
        missing, mistyped = [], []
        for f in self.fields:
            found = actual.get(f.name.lower())
            if found is None:
                if f.nullable:
                    log.warning("[%s] Missing optional field: %s", self.name, f.name)
                else:
                    text = f"{self.name}: {MISSING}: {f.name}"
                    missing.append(Violation(f.name, "present", f.type, 1, text))
            elif not _same_type(found, f.spark_type):
                text = f"{self.name}.{f.name} {TYPE} {found.simpleString()}, expected {f.type}"
                mistyped.append(Violation(f.name, "type", f.type, 1, text))
        return missing + mistyped

    # ---- value rules --------------------------------------------------------

    def value_rules(self, df: DataFrame) -> list[ValueRule]:
        """Rules that apply to ``df``: columns present, with the declared type.

        Range and allowed-value rules let NULL pass; only the NOT NULL rule
        reports it. A mistyped column is reported once, by its type.
        """
        actual = {f.name.lower(): f for f in df.schema.fields}
        limits, nulls = [], []
        for f in self.fields:
            found = actual.get(f.name.lower())
            if found is None:
                continue
            c = F.col(f"`{found.name}`")
            if not f.nullable:
                wording = f"{NULLS} ({NOT_NULL})"
                nulls.append(ValueRule(f.name, "not_null", "NOT NULL", c.isNull(), wording))
            if not _same_type(found.dataType, f.spark_type):
                continue
            if f.min_value is not None:
                limits.append(
                    ValueRule(
                        f.name, "min_value", str(f.min_value), c < F.lit(f.min_value),
                        f"{BELOW} {f.min_value}",
                    )
                )
            if f.max_value is not None:
                limits.append(
                    ValueRule(
                        f.name, "max_value", str(f.max_value), c > F.lit(f.max_value),
                        f"{ABOVE} {f.max_value}",
                    )
                )
            if f.allowed_values is not None:
                allowed = list(f.allowed_values)
                limits.append(
                    ValueRule(
                        f.name, "allowed_values", ",".join(map(str, allowed)), ~c.isin(allowed),
                        f"{FOREIGN}, which are {', '.join(map(str, allowed))}",
                    )
                )
        return limits + nulls

    def rule_metrics(self, df: DataFrame) -> list[Column]:
        """One aggregate per value rule, named ``rule_0``, ``rule_1``, …"""
        return [
            F.count_if(rule.broken).alias(f"rule_{i}")
            for i, rule in enumerate(self.value_rules(df))
        ]

    def broken_rules(self, df: DataFrame, counts: dict[str, int]) -> list[Violation]:
        """Schema violations of ``df`` plus the value rules with a count above 0."""
        broken = self.schema_violations(df)
        for i, rule in enumerate(self.value_rules(df)):
            count = counts[f"rule_{i}"] or 0
            if count > 0:
                broken.append(rule.violation(self.name, count))
        return broken

    # ---- checks -------------------------------------------------------------

    def rule_counts(self, df: DataFrame) -> DataFrame:
        """V2, V3: every rule with the number of rows that break it, lazily."""
        entries = [
            _entry(v.field, v.rule, v.expected, F.lit(v.violations).cast("long"))
            for v in self.schema_violations(df)
        ]
        rules = self.value_rules(df)
        for i, r in enumerate(rules):
            entries.append(_entry(r.field, r.rule, r.expected, F.col(f"rule_{i}")))
        counted = df.agg(F.count(F.lit(1)).alias("_rows"), *self.rule_metrics(df))
        return counted.select(F.inline(F.array(*entries)))

    def violations(self, df: DataFrame) -> DataFrame:
        """Only the broken rules, as a DataFrame."""
        return self.rule_counts(df).filter(F.col("violations") > 0)

    def check(self, df: DataFrame) -> list[Violation]:
        """The broken rules, from one aggregate job whose result is one row."""
        metrics = self.rule_metrics(df)
        counts = df.agg(*metrics).first().asDict() if metrics else {}
        return self.broken_rules(df, counts)

    def validate(self, df: DataFrame) -> tuple[bool, list[str]]:
        """V2: ``(is_valid, messages)``."""
        broken = self.check(df)
        return not broken, [v.message for v in broken]

    def require(self, df: DataFrame) -> None:
        """V5: raise ``ContractViolation`` unless the table keeps its contract."""
        broken = self.check(df)
        if broken:
            raise ContractViolation(self.name, broken)

    def with_reason(self, df: DataFrame) -> DataFrame:
        """Add ``reason``, the first rule the row breaks, or NULL."""
        reason = F.lit(None).cast("string")
        for rule in reversed(self.value_rules(df)):
            reason = F.when(rule.broken, F.lit(f"{rule.field}:{rule.rule}")).otherwise(reason)
        return df.withColumn("reason", reason)

    # ---- declared transformations -------------------------------------------

    def apply_derived(self, df: DataFrame) -> DataFrame:
        """Evaluate the SQL rules written in the contract, in order."""
        for field, rule in self.derived:
            df = df.withColumn(field, F.expr(rule))
        return df

    def typed(self, df: DataFrame) -> DataFrame:
        """The declared fields that ``df`` has, in order, with their type.

        A field's rule is evaluated on the column as it came. A value that does not
        convert to the declared type becomes NULL.
        """
        present = {c.lower(): c for c in df.columns}
        rules = dict(self.derived)
        columns = []
        for f in self.fields:
            if f.name.lower() in present:
                given = F.expr(rules[f.name]) if f.name in rules else F.col(f"`{present[f.name.lower()]}`")
                columns.append(given.try_cast(f.spark_type).alias(f.name))
        return df.select(*columns)

    def with_added(self, df: DataFrame) -> DataFrame:
        """The declared fields that only a rule gives, added in order; then all fields as declared."""
        for field, rule in self.derived:
            if field not in df.columns:
                df = df.withColumn(field, F.expr(rule).cast(self.schema()[field].dataType))
        return df.select(*[f.name for f in self.fields if f.name in df.columns])

    def fill_defaults(self, df: DataFrame) -> DataFrame:
        """Replace NULL by the contract's ``default_value``."""
        present = {c.lower() for c in df.columns}
        values = {
            f.name: f.default_value
            for f in self.fields
            if f.default_value is not None and f.name.lower() in present
        }
        return df.fillna(values) if values else df


def _entry(field: str, rule: str, expected: str, violations: Column) -> Column:
    return F.struct(
        F.lit(field).alias("field"),
        F.lit(rule).alias("rule"),
        F.lit(expected).alias("expected"),
        violations.alias("violations"),
    )


def _same_type(found: T.DataType, declared: T.DataType) -> bool:
    return found.simpleString() == declared.simpleString()
