"""Contract checks. All row rules compile into one aggregation."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlens.operators.small import settled
from ledgerlens.sources.contract import ACCEPTED, TRANSACTION_RULES, Rule
from ledgerlens.sources.files import write_parquet


class ValidationError(ValueError):
    """The table does not meet the contract."""


@dataclass(frozen=True)
class SchemaFindings:
    missing: list[str]
    unexpected: list[str]
    mismatched: list[str]

    @property
    def passed(self) -> bool:
        """Unexpected columns only warn."""
        return not self.missing and not self.mismatched


def check_schema(df: DataFrame, rules: list[Rule] = TRANSACTION_RULES) -> SchemaFindings:
    """Compare names and types with the contract. Reads the schema only."""
    types = {f.name: f.dataType for f in df.schema.fields}
    expected = {r.column for r in rules}
    return SchemaFindings(
        missing=[r.column for r in rules if r.column not in types],
        unexpected=[name for name in types if name not in expected],
        mismatched=[r.column for r in rules if r.column in types and not isinstance(types[r.column], ACCEPTED[r.kind])],
    )


def row_rules(df: DataFrame, rules: list[Rule] = TRANSACTION_RULES) -> list[tuple[str, str, Column]]:
    """``(column, rule, broken)`` for every constraint on a column the table has. A NULL breaks no range."""
    out = []
    for rule in rules:
        if rule.column not in df.columns:
            continue
        value = F.col(rule.column)
        if rule.minimum is not None:
            out.append((rule.column, "minimum", value < F.lit(rule.minimum)))
        if rule.maximum is not None:
            out.append((rule.column, "maximum", value > F.lit(rule.maximum)))
        if rule.allowed is not None:
            out.append((rule.column, "enum", value.isNull() | ~value.isin(*rule.allowed)))
    return out


def _counted(df: DataFrame, checks: list[tuple[str, str, Column]]) -> DataFrame:
    """``(column, rule, violations)`` for every check, from one pass."""
    counts = df.agg(
        F.count("*").alias("rows"), *[F.count_if(broken).alias(f"{c}|{rule}") for c, rule, broken in checks]
    )
    entries = [
        F.struct(F.lit(c).alias("column"), F.lit(rule).alias("rule"), F.col(f"{c}|{rule}").alias("violations"))
        for c, rule, _ in checks
    ]
    return counts.select(F.inline(F.array(*entries)))


def range_violations(df: DataFrame, rules: list[Rule] = TRANSACTION_RULES) -> DataFrame:
    """Rows strictly below the minimum or strictly above the maximum, for every range rule."""
    return _counted(df, [c for c in row_rules(df, rules) if c[1] != "enum"])


def enum_violations(df: DataFrame, rules: list[Rule] = TRANSACTION_RULES) -> DataFrame:
    """Each value outside its list with its row count: ``(column, value, rows)``."""
    checked = [r for r in rules if r.allowed is not None and r.column in df.columns]
    entries = [
        F.struct(
            F.lit(r.column).alias("column"),
            F.col(r.column).cast("string").alias("value"),
            (F.col(r.column).isNull() | ~F.col(r.column).isin(*r.allowed)).alias("broken"),
        )
        for r in checked
    ]
    flagged = df.select(F.inline(F.array(*entries))).where("broken")
    return flagged.groupBy("column", "value").agg(F.count("*").alias("rows"))


def validation_status(df: DataFrame, rules: list[Rule] = TRANSACTION_RULES) -> DataFrame:
    """``(check, column, rule, violations, passed)``: row count, nulls and every domain rule from one pass.

    Integrity passes if rows are left; nulls are reported, since the cleaned rows go on without them.
    """
    domain = row_rules(df, rules)
    counts = df.agg(
        F.count("*").alias("rows"),
        *[F.count_if(F.col(c).isNull()).alias(f"null|{c}") for c in df.columns],
        *[F.count_if(broken).alias(f"{c}|{rule}") for c, rule, broken in domain],
    )

    def entry(check: str, column: str, rule: str, violations: Column, passed: Column) -> Column:
        return F.struct(
            F.lit(check).alias("check"),
            F.lit(column).alias("column"),
            F.lit(rule).alias("rule"),
            violations.cast("bigint").alias("violations"),
            passed.alias("passed"),
        )

    empty = F.when(F.col("rows") == 0, 1).otherwise(0)
    entries = [entry("integrity", "*", "rows", empty, F.col("rows") > 0)]
    entries += [entry("integrity", c, "null", F.col(f"null|{c}"), F.lit(True)) for c in df.columns]
    entries += [entry("domain", c, r, F.col(f"{c}|{r}"), F.col(f"{c}|{r}") == 0) for c, r, _ in domain]
    return counts.select(F.inline(F.array(*entries)))


def verdict(status: DataFrame) -> DataFrame:
    """The overall verdict of a status table, per check and for all (``check = '*'``)."""
    outcome = [F.bool_and("passed").alias("passed"), F.count_if(~F.col("passed")).alias("failed_rules")]
    rolled = status.rollup("check").agg(*outcome, F.grouping("check").alias("_all"))
    name = F.when(F.col("_all") == 1, F.lit("*")).otherwise(F.col("check"))
    return rolled.select(name.alias("check"), "passed", "failed_rules")


def schema_findings(df: DataFrame, rules: list[Rule] = TRANSACTION_RULES) -> DataFrame:
    """``(column, finding)``: every missing, unexpected or mismatched column."""
    found = check_schema(df, rules)
    rows = [(c, kind) for kind in ("missing", "unexpected", "mismatched") for c in getattr(found, kind)]
    return df.sparkSession.createDataFrame(rows, "column string, finding string")


def full_status(df: DataFrame, drift_report: DataFrame, rules: list[Rule] = TRANSACTION_RULES) -> DataFrame:
    """The status table of all four checks: schema, integrity, domain and drift.

    Unexpected columns and drift are counted as violations but pass: they warn. ``drift_report`` is that of
    :func:`ledgerlens.operators.drift.check_drift`; its own status row is left out.
    """
    found = check_schema(df, rules)
    failed = [(c, kind) for kind in ("missing", "mismatched") for c in getattr(found, kind)]
    rows = [("schema", "*", "columns", len(failed), not failed)]
    rows += [("schema", c, kind, 1, False) for c, kind in failed]
    rows += [("schema", c, "unexpected", 1, True) for c in found.unexpected]
    schema = df.sparkSession.createDataFrame(rows, "check string, column string, rule string, violations long, passed boolean")
    drifted = drift_report.where("column <> '*'").select(
        F.lit("drift").alias("check"),
        "column",
        F.col("measure").alias("rule"),
        F.col("flagged").cast("bigint").alias("violations"),
        F.lit(True).alias("passed"),
    )
    return schema.unionByName(validation_status(df, rules)).unionByName(drifted)


def overall_verdict(status: DataFrame) -> DataFrame:
    """As :func:`verdict`, with the number of passed rules that still warn."""
    outcome = [
        F.bool_and("passed").alias("passed"),
        F.count_if(~F.col("passed")).alias("failed_rules"),
        F.count_if(F.col("passed") & (F.col("violations") > 0)).alias("warnings"),
    ]
    rolled = status.rollup("check").agg(*outcome, F.grouping("check").alias("_all"))
    name = F.when(F.col("_all") == 1, F.lit("*")).otherwise(F.col("check"))
    return rolled.select(name.alias("check"), "passed", "failed_rules", "warnings")


def with_violations(df: DataFrame, rules: list[Rule] = TRANSACTION_RULES) -> DataFrame:
    """Add ``violations``: the names of the rules each row breaks."""
    named = [F.when(broken, F.lit(f"{c}:{rule}")) for c, rule, broken in row_rules(df, rules)]
    return df.withColumn("violations", F.array_compact(F.array(*named)))


def quarantine(df: DataFrame, rules: list[Rule] = TRANSACTION_RULES) -> tuple[DataFrame, DataFrame]:
    """``(good rows, bad rows)``; the bad ones keep the list of rules they break."""
    marked = with_violations(df, rules)
    return marked.where(F.size("violations") == 0).drop("violations"), marked.where(F.size("violations") > 0)


def validate(df: DataFrame, out_path: str, rules: list[Rule] = TRANSACTION_RULES) -> DataFrame:
    """Drop duplicate and incomplete rows, check the contract, and write the table only if it passes.

    Returns the status table; raises with the failed rules otherwise.
    """
    schema = check_schema(df, rules)
    if not schema.passed:
        raise ValidationError(f"missing columns {schema.missing}, wrong types {schema.mismatched}")
    # The cleaned rows are written once; the check and the published table both read that copy.
    kept = settled(df.dropna("any").dropDuplicates())
    status = settled(validation_status(kept, rules))
    failed = status.where(~F.col("passed")).collect()
    if failed:
        raise ValidationError("; ".join(f"{r['column']} {r['rule']}: {r['violations']} rows" for r in failed))
    write_parquet(kept, out_path)
    return status

