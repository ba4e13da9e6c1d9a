"""Named queries: sources, cleaning and validation."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlens.functions.numeric import rounded
from ledgerlens.operators import cleaning, drift, sampling, validation
from ledgerlens.operators.rates import above_overall, rate_by
from ledgerlens.operators.small import settled
from ledgerlens.plans.metric_queries import DRIFT_SQL
from ledgerlens.plans.registry import FAULTY, MENDED, TX, profiles_sql, query
from ledgerlens.session import ensure_checkpoint_dir
from ledgerlens.sources import contract, files, state
from ledgerlens.sources.standin import blemished_transactions, transactions


def scratch(spark: SparkSession) -> str:
    """A fresh path in the shared folder."""
    return f"{ensure_checkpoint_dir(spark)}/runs/{uuid.uuid4().hex}"


def contract_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The transactions with their time as text, as the contract has it."""
    tx = transactions(spark, sf_dir)
    return tx.withColumn("timestamp", F.date_format("timestamp", "yyyy-MM-dd HH:mm:ss.SSSSSS"))


RATE_BY_TYPE = TX + """
select transaction_type, count(is_fraud) as total, cast(sum(is_fraud) as bigint) as fraud,
 round(sum(is_fraud)::double/count(is_fraud)*100, 6) as fraud_rate from tx group by all
"""


@query("scan_csv", RATE_BY_TYPE)
def scan_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = files.write_csv(contract_table(spark, sf_dir), scratch(spark))
    table = files.read_csv(spark, path, contract.declared_schema())
    return rate_by(files.require_columns(table, contract.SCORING_COLUMNS), "transaction_type")


@query("scan_json", RATE_BY_TYPE)
def scan_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = files.write_json(contract_table(spark, sf_dir), scratch(spark))
    table = files.read_json(spark, path, contract.declared_schema())
    return rate_by(files.require_columns(table, contract.SCORING_COLUMNS), "transaction_type")


@query(
    "scan_parquet_project",
    TX + "select is_fraud, count(*) as rows from tx group by all",
)
def scan_parquet_project(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One column of a written table."""
    path = files.write_parquet(transactions(spark, sf_dir), scratch(spark))
    return files.read_parquet(spark, path, ["is_fraud"]).groupBy("is_fraud").agg(F.count("*").alias("rows"))


@query(
    "profile_roundtrip",
    TX + profiles_sql("tx") + """
select sender_id, total_tx, unique_recv, unique_devices, round(avg_amount, 4) as avg_amount, primary_device from sp
""",
)
def profile_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Profiles fitted, written and loaded again."""
    loaded = state.fit_and_save_profiles(transactions(spark, sf_dir), scratch(spark))
    return loaded.sender.withColumn("avg_amount", rounded(F.col("avg_amount"), 4))


_COLUMNS = [
    "transaction_id", "timestamp", "sender_id", "receiver_id", "amount", "transaction_type", "sender_balance_before",
    "sender_balance_after", "receiver_balance_before", "receiver_balance_after", "device_id", "location_lat",
    "location_lon", "is_fraud", "currency", "channel", "fee",
]
_NUMERIC = {
    "amount", "sender_balance_before", "sender_balance_after", "receiver_balance_before", "receiver_balance_after",
    "location_lat", "location_lon", "is_fraud", "fee",
}


def _per_column(template: str, columns=_COLUMNS) -> str:
    return " union all ".join(template.format(c=c, q=f'"{c}"') for c in columns)


@query(
    "constant_columns",
    MENDED + _per_column(
        """select '{c}' as "column", case when min({q}) = max({q}) then 1 else 0 end as is_constant,
        case when count({q}) = 0 then 1 else 0 end as is_all_null from mended"""
    ),
)
def constant_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    table = cleaning.null_nonfinite(blemished_transactions(spark, sf_dir))
    return cleaning.column_constancy(table).select("column", "is_constant", "is_all_null")


@query(
    "zero_variance_columns",
    MENDED + """select "column" from (""" + _per_column(
        """select '{c}' as "column", var_samp({q}) as v from mended""", [c for c in _COLUMNS if c in _NUMERIC]
    ) + ") where v = 0",
)
def zero_variance_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    table = cleaning.null_nonfinite(blemished_transactions(spark, sf_dir))
    return cleaning.column_constancy(table).where("is_zero_variance = 1").select("column")


@query(
    "null_nonfinite",
    MENDED + """
select transaction_type, count(*) as rows, count(amount) as amounts, count(distinct amount) as distinct_amounts
from mended group by all
""",
)
def null_nonfinite(spark: SparkSession, sf_dir: str) -> DataFrame:
    table = cleaning.null_nonfinite(blemished_transactions(spark, sf_dir))
    per_value = table.groupBy("transaction_type", "amount").agg(F.count("*").alias("n"))
    return per_value.groupBy("transaction_type").agg(
        F.sum("n").alias("rows"),
        F.sum(F.when(F.col("amount").isNotNull(), F.col("n")).otherwise(0)).alias("amounts"),
        F.count("amount").alias("distinct_amounts"),
    )


@query(
    "coerce_numeric",
    TX + """
select transaction_type, count(try_cast(substr(device_id, 2) as double)) as device_numbers,
 count(try_cast(transaction_type as double)) as type_numbers,
 round(sum(try_cast(substr(device_id, 2) as double)), 2) as device_sum from tx group by all
""",
)
def coerce_numeric(spark: SparkSession, sf_dir: str) -> DataFrame:
    tx = transactions(spark, sf_dir, "transaction_type", "device_id")
    texts = tx.select("transaction_type", F.substring("device_id", 2, 20).alias("d"), F.col("transaction_type").alias("t"))
    return cleaning.coerce_numeric(texts, ["d", "t"]).groupBy("transaction_type").agg(
        F.count("d").alias("device_numbers"), F.count("t").alias("type_numbers"), F.round(F.sum("d"), 2).alias("device_sum")
    )


@query(
    "drop_null_rows",
    MENDED + """
select transaction_id, device_id, round(amount, 6) as amount from mended
where amount is not null and device_id is not null
""",
)
def drop_null_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole cleaning chain of the faulty table: the all-null column is set aside first."""
    table = blemished_transactions(spark, sf_dir).drop("channel")
    return cleaning.clean(table).select("transaction_id", "device_id", rounded(F.col("amount")).alias("amount"))


@query(
    "drop_duplicates",
    MENDED + """, kept as (select distinct * from mended)
select (select count(*) from mended) as rows_before, (select count(*) from kept) as rows_after,
 (select count(*) from mended) - (select count(*) from kept) as removed
""",
)
def drop_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    table = cleaning.null_nonfinite(blemished_transactions(spark, sf_dir))
    before = table.agg(F.count("*")).scalar()
    after = cleaning.drop_duplicates(table).agg(F.count("*").alias("rows_after")).withColumn("rows_before", before)
    return after.select("rows_before", "rows_after", (F.col("rows_before") - F.col("rows_after")).alias("removed"))


@query(
    "null_counts",
    MENDED + _per_column("""select '{c}' as "column", count(*) - count({q}) as nulls from mended"""),
)
def null_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cleaning.null_counts(cleaning.null_nonfinite(blemished_transactions(spark, sf_dir)))


@query(
    "duplicate_keys",
    FAULTY + """
select count(*) as row_count, count(distinct transaction_id) as distinct_keys,
 count(*) - count(distinct transaction_id) as duplicates from faulty
""",
)
def duplicate_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cleaning.duplicate_keys(blemished_transactions(spark, sf_dir), "transaction_id")


_RANGES = [
    (r.column, rule, bound, "<" if rule == "minimum" else ">")
    for r in contract.TRANSACTION_RULES
    for rule, bound in (("minimum", r.minimum), ("maximum", r.maximum))
    if bound is not None
]


@query(
    "range_violations",
    MENDED + " union all ".join(
        f"""select '{c}' as "column", '{rule}' as rule, count(*) filter (where "{c}" {op} {bound}) as violations
        from mended""" for c, rule, bound, op in _RANGES
    ),
)
def range_violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return validation.range_violations(cleaning.null_nonfinite(blemished_transactions(spark, sf_dir)))


_ENUMS = [(r.column, ", ".join(f"'{v}'" for v in r.allowed)) for r in contract.TRANSACTION_RULES if r.allowed]


@query(
    "enum_violations",
    FAULTY + " union all ".join(
        f"""select '{c}' as "column", cast("{c}" as varchar) as "value", count(*) as rows from faulty
        where "{c}" is null or cast("{c}" as varchar) not in ({allowed}) group by all""" for c, allowed in _ENUMS
    ),
)
def enum_violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return validation.enum_violations(blemished_transactions(spark, sf_dir))


_STATUS_SQL = MENDED + ", complete as (select distinct * from mended where amount is not null and device_id is not null)" + """
, status as (
select 'integrity' as "check", '*' as "column", 'rows' as rule,
 cast(case when count(*) = 0 then 1 else 0 end as bigint) as violations, count(*) > 0 as passed from complete
union all """ + _per_column(
    """select 'integrity' as "check", '{c}' as "column", 'null' as rule, count(*) - count({q}) as violations,
    true as passed from complete""", _COLUMNS[:14]
) + " union all " + " union all ".join(
    f"""select 'domain' as "check", '{c}' as "column", '{rule}' as rule,
    count(*) filter (where "{c}" {op} {bound}) as violations, count(*) filter (where "{c}" {op} {bound}) = 0 as passed
    from complete""" for c, rule, bound, op in _RANGES
) + " union all " + " union all ".join(
    f"""select 'domain' as "check", '{c}' as "column", 'enum' as rule,
    count(*) filter (where "{c}" is null or cast("{c}" as varchar) not in ({allowed})) as violations,
    count(*) filter (where "{c}" is null or cast("{c}" as varchar) not in ({allowed})) = 0 as passed
    from complete""" for c, allowed in _ENUMS
) + ")"


# The cleaned table, checked in all four ways. Times are timestamps there, where the contract has text.
FULL_STATUS_SQL = (
    DRIFT_SQL
    + ", complete as (select * from tx)"
    + _STATUS_SQL[_STATUS_SQL.index("\n, status as (") :]
    + """
, full_status as (select * from status
 union all select 'schema', '*', 'columns', 1, false
 union all select 'schema', 'timestamp', 'mismatched', 1, false
 union all select 'drift', "column", 'psi', cast(psi >= 0.2 as bigint), true from psi_num
 union all select 'drift', "column", 'psi', cast(psi >= 0.2 as bigint), true from psi_cat
 union all select 'drift', "column", 'rate_shift', cast(abs(cur-ref) > 0.05 as bigint), true from shift)
"""
)


@query("full_status", FULL_STATUS_SQL + "select * from full_status")
def full_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    tx = transactions(spark, sf_dir)
    baseline = settled(drift.build_baseline(drift.baseline_sample(tx)))
    return validation.full_status(tx, drift.check_drift(tx, baseline))


@query(
    "overall_verdict",
    FULL_STATUS_SQL + """
select coalesce("check", '*') as "check", bool_and(passed) as passed, count(*) filter (where not passed) as failed_rules,
 count(*) filter (where passed and violations > 0) as warnings from full_status group by rollup("check")
""",
)
def overall_verdict(spark: SparkSession, sf_dir: str) -> DataFrame:
    return validation.overall_verdict(full_status(spark, sf_dir))


@query("schema_findings", """
select * from (values ('timestamp', 'mismatched'), ('currency', 'unexpected'), ('channel', 'unexpected'),
 ('fee', 'unexpected'), ('location_lat', 'missing')) t("column", finding)
""")
def schema_findings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The faulty table, one column taken away."""
    return validation.schema_findings(blemished_transactions(spark, sf_dir).drop("location_lat"))


@query("guard_findings", """
select * from (values ('columns', 'missing columns: [''device_id'', ''amount'']'), ('rows', 'transactions has no rows'),
 ('table', 'passed')) t(guard, outcome)
""")
def guard_findings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the source guards say of a table without rows, one without two columns, and the whole table."""
    tx = transactions(spark, sf_dir)

    def outcome(guard) -> str:
        try:
            guard()
        except files.SourceError as error:
            return str(error)
        return "passed"

    rows = [
        ("rows", outcome(lambda: files.require_rows(tx.where("is_fraud = 7"), "transactions"))),
        ("columns", outcome(lambda: files.require_columns(tx.drop("amount", "device_id"), ["device_id", "sender_id", "amount"]))),
        ("table", outcome(lambda: files.require_columns(files.require_rows(tx), contract.SCORING_COLUMNS))),
    ]
    return spark.createDataFrame(rows, "guard string, outcome string")


def _complete(spark: SparkSession, sf_dir: str) -> DataFrame:
    table = cleaning.null_nonfinite(blemished_transactions(spark, sf_dir)).select(*_COLUMNS[:14])
    return cleaning.drop_null_rows(cleaning.drop_duplicates(table))


@query("validation_status", _STATUS_SQL + " select * from status")
def validation_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    return validation.validation_status(_complete(spark, sf_dir))


@query(
    "validation_verdict",
    _STATUS_SQL + """
select coalesce("check", '*') as "check", bool_and(passed) as passed,
 count(*) filter (where not passed) as failed_rules from status group by rollup("check")
""",
)
def validation_verdict(spark: SparkSession, sf_dir: str) -> DataFrame:
    return validation.verdict(validation.validation_status(_complete(spark, sf_dir)))


_BROKEN = " || ".join(
    f"""case when "{r.column}" {op} {bound} then ';{r.column}:{rule}' else '' end"""
    if rule != "enum"
    else f"""case when "{r.column}" is null or cast("{r.column}" as varchar) not in ({bound}) then ';{r.column}:enum' else '' end"""
    for r in contract.TRANSACTION_RULES
    for rule, bound, op in (
        ("minimum", r.minimum, "<"),
        ("maximum", r.maximum, ">"),
        ("enum", ", ".join(f"'{v}'" for v in r.allowed) if r.allowed else None, ""),
    )
    if bound is not None
)


@query(
    "quarantine",
    MENDED + f"""
select transaction_id, substr(broken, 2) as violations from (select transaction_id, {_BROKEN} as broken from mended)
where broken <> ''
""",
)
def quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, bad = validation.quarantine(cleaning.null_nonfinite(blemished_transactions(spark, sf_dir)))
    return bad.select("transaction_id", F.array_join("violations", ";").alias("violations"))


@query(
    "align_features",
    TX + """
select transaction_id, round(amount, 6) as amount, 0.0::double as amount_band, is_fraud, 0.0::double as is_high_risk_type
from tx
""",
)
def align_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    tx = transactions(spark, sf_dir).withColumn("amount", rounded(F.col("amount")))
    return cleaning.align_columns(tx, ["transaction_id", "amount", "amount_band", "is_fraud", "is_high_risk_type"])


_PROBES = {
    "sender_balance": "abs(sender_balance_before - amount - sender_balance_after) > 0.01",
    "receiver_balance": "abs(receiver_balance_after - receiver_balance_before - amount) > 0.01",
    "negative_sender_before": "sender_balance_before < 0",
    "negative_sender_after": "sender_balance_after < 0",
    "non_positive_amount": "amount <= 0",
    "self_transfer": "sender_id = receiver_id",
}


@query(
    "integrity_probes",
    TX + " union all ".join(
        f"""select '{n}' as probe, count(*) filter (where {cond}) as violations,
        round(avg(is_fraud) filter (where {cond}), 6) as fraud_rate from tx""" for n, cond in _PROBES.items()
    ),
)
def integrity_probes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cleaning.integrity_probes(transactions(spark, sf_dir))


@query(
    "hash_sample",
    TX + "select transaction_id, is_fraud from tx where substr(md5(concat(transaction_id, ':42')), 1, 8) < '33333333'",
)
def hash_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sampling.hash_sample(transactions(spark, sf_dir, "transaction_id", "is_fraud"), 0.2)


@query(
    "hash_sample_rows",
    TX + """
select transaction_id, is_fraud from tx
order by substr(md5(concat(transaction_id, ':42')), 1, 8), transaction_id limit 2000
""",
)
def hash_sample_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sampling.sample_rows(transactions(spark, sf_dir, "transaction_id", "is_fraud"), 2000)


@query(
    "high_risk_type_flag",
    TX + """, high as (select transaction_type from tx group by all having avg(is_fraud) > (select avg(is_fraud) from tx))
, flagged as (select *, case when transaction_type in (select transaction_type from high) then 1 else 0 end
  as is_high_risk_type from tx)
select is_high_risk_type, count(is_fraud) as total, cast(sum(is_fraud) as bigint) as fraud,
 round(sum(is_fraud)::double/count(is_fraud)*100, 6) as fraud_rate from flagged group by all
""",
)
def high_risk_type_flag(spark: SparkSession, sf_dir: str) -> DataFrame:
    tx = transactions(spark, sf_dir, "transaction_type", "is_fraud")
    return rate_by(above_overall(tx, "transaction_type", "is_high_risk_type"), "is_high_risk_type")
