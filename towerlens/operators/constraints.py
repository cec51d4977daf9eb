"""Declared constraints checked as one aggregate per table, and a gate.

A ``TableConstraints`` lists primary key, NOT NULL columns, IN-list checks
and lower bounds. ``constraint_violations`` turns it into a long table
(table_name, constraint_name, violations) from a single pass over the data;
``enforce`` raises when any count is not zero. The pipeline gates staged
tables: silver and gold are published only after their gates.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F


class DataQualityError(AssertionError):
    """A hard data-quality rule failed."""


@dataclass(frozen=True)
class TableConstraints:
    table: str
    primary_key: tuple[str, ...] = ()
    not_null: tuple[str, ...] = ()
    allowed_values: dict[str, tuple] = field(default_factory=dict)
    min_values: dict[str, float] = field(default_factory=dict)


def _violation_columns(spec: TableConstraints) -> list[tuple[str, Column]]:
    out: list[tuple[str, Column]] = []
    if spec.primary_key:
        keys = [F.col(k) for k in spec.primary_key]
        # Rows minus distinct complete keys: counts duplicates and NULL keys.
        out.append((f"primary_key({','.join(spec.primary_key)})",
                    F.count(F.lit(1)) - F.count_distinct(*keys)))
    for c in spec.not_null:
        out.append((f"not_null({c})", F.count_if(F.col(c).isNull())))
    for c, allowed in spec.allowed_values.items():
        # SQL CHECK semantics: NULL passes.
        out.append((f"check({c} in ({','.join(allowed)}))",
                    F.count_if(~F.col(c).isin(*allowed))))
    for c, lo in spec.min_values.items():
        out.append((f"min({c})>={lo}", F.count_if(F.col(c) < F.lit(lo))))
    return out


def constraint_violations(df: DataFrame, spec: TableConstraints) -> DataFrame:
    """(table_name, constraint_name, violations) for every declared rule."""
    named = _violation_columns(spec)
    if not named:
        raise ValueError(f"no constraints declared for {spec.table}")
    wide = df.agg(*[expr.cast("bigint").alias(f"_v{i}") for i, (_, expr) in enumerate(named)])
    return wide.select(F.explode(F.array(*[
        F.struct(F.lit(spec.table).alias("table_name"), F.lit(name).alias("constraint_name"),
                 F.col(f"_v{i}").alias("violations"))
        for i, (name, _) in enumerate(named)])).alias("_x")).select("_x.*")


def load_check(df: DataFrame, spec: TableConstraints) -> tuple[int, list]:
    """Row count and violation rows of ``spec`` from ONE aggregate pass (the
    read-back count of a load doubles as the constraint scan)."""
    named = _violation_columns(spec)
    row = df.agg(F.count(F.lit(1)).alias("_rows"),
                 *[expr.cast("bigint").alias(f"_v{i}") for i, (_, expr) in enumerate(named)]).first()
    rows = [(spec.table, name, int(row[f"_v{i}"])) for i, (name, _) in enumerate(named)]
    return int(row["_rows"]), [Row(table_name=t, constraint_name=c, violations=v) for t, c, v in rows]


def enforce(violations: DataFrame | list) -> None:
    """Raise ``DataQualityError`` if any rule has violations.

    ``violations`` (a DataFrame or already collected rows) has one row per
    rule, so bringing it to the driver is bounded by the declared rules.
    """
    if isinstance(violations, DataFrame):
        violations = violations.where(F.col("violations") > 0).collect()
    bad = [r for r in violations if r["violations"] > 0]
    if bad:
        msg = "; ".join(f"{r['table_name']}.{r['constraint_name']}: {r['violations']}" for r in bad)
        raise DataQualityError(f"rules broken: {msg}")


def enforce_min(value_df: DataFrame, col: str, minimum: float, message: str) -> None:
    """Gate on a one-row report column (e.g. a match rate)."""
    v = value_df.select(col).first()[0]
    if v is None or v < minimum:
        raise DataQualityError(f"rule broken: {message} ({col}={v}, minimum {minimum})")
