"""Named queries: profiles, features, joins and scaling."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlens.functions import geo, labels, temporal
from ledgerlens.functions.numeric import rounded
from ledgerlens.operators import profiles, sampling, summaries
from ledgerlens.operators.features import FEATURES, NOT_SCALED, SCALED, features
from ledgerlens.operators.neighbours import nearest_neighbours
from ledgerlens.operators.ordered import quantile_bands
from ledgerlens.operators.scaling import apply_scaler, fit_scaler
from ledgerlens.operators.small import settled
from ledgerlens.plans.registry import SCORED, TX, features_sql, profiles_sql, query
from ledgerlens.sources.standin import scored_transactions, transactions

FIRST_DAY_END = "2024-01-02 00:00:00"
REFRESH_AS_OF = "2024-01-31 00:00:00"

_WHOLE = [
    "hour", "day_of_week", "month", *NOT_SCALED, "sender_total_tx", "sender_unique_recv", "sender_unique_devices",
    "device_unique_senders",
]


def shown(df: DataFrame, *keep: str) -> DataFrame:
    """Feature rows with their fractional columns rounded."""
    return df.select(*keep, *[F.col(c) if c in _WHOLE else rounded(F.col(c), 6).alias(c) for c in FEATURES])


_SHOWN_SQL = ", ".join(f'"{c}"' if c in _WHOLE else f'round("{c}", 6) + 0.0 as "{c}"' for c in FEATURES)


@query("sender_profile", TX + profiles_sql("tx") + """
select sender_id, total_tx, unique_recv, unique_devices, round(avg_amount, 4) as avg_amount, primary_device from sp
""")
def sender_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    tx = transactions(spark, sf_dir, "transaction_id", "sender_id", "receiver_id", "device_id", "amount")
    sender, _ = profiles.sender_and_device(tx)
    return sender.withColumn("avg_amount", rounded(F.col("avg_amount"), 4))


@query("device_profile", TX + "select device_id, count(distinct sender_id) as unique_senders from tx group by all")
def device_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    tx = transactions(spark, sf_dir, "transaction_id", "sender_id", "device_id", "amount")
    return profiles.device_profile(profiles.device_pairs(tx))


@query("primary_device", TX + """
, pairs as (select sender_id, device_id, count(*) as uses from tx group by all)
select sender_id, device_id as primary_device, uses from pairs
qualify row_number() over (partition by sender_id order by uses desc, device_id) = 1
""")
def primary_device(spark: SparkSession, sf_dir: str) -> DataFrame:
    tx = transactions(spark, sf_dir, "transaction_id", "sender_id", "device_id", "amount")
    return profiles.primary_device(profiles.device_pairs(tx))


@query("profile_fallbacks", TX + profiles_sql("tx") + """
select total_tx, unique_recv, unique_devices, round(avg_amount, 4) as avg_amount, is_device_switch, unique_senders from fb
""")
def profile_fallbacks(spark: SparkSession, sf_dir: str) -> DataFrame:
    tx = transactions(spark, sf_dir, "transaction_id", "sender_id", "receiver_id", "device_id", "amount")
    return profiles.fit_profiles(tx).fallbacks.withColumn("avg_amount", rounded(F.col("avg_amount"), 4))


@query("refresh_profiles", TX + f""", recent as (
 select * from tx where "timestamp" >= timestamp '{REFRESH_AS_OF}' - interval 90 days
  and "timestamp" < timestamp '{REFRESH_AS_OF}')""" + profiles_sql("recent") + """
select sender_id, total_tx, unique_recv, unique_devices, round(avg_amount, 4) as avg_amount, primary_device from sp
""")
def refresh_profiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    tx = transactions(spark, sf_dir)
    first_day = profiles.fit_profiles(tx.where(F.col("timestamp") < F.lit(FIRST_DAY_END).cast("timestamp_ntz")))
    fresh = profiles.refresh_profiles(first_day, tx, REFRESH_AS_OF)
    return fresh.sender.withColumn("avg_amount", rounded(F.col("avg_amount"), 4))


@query("features_unscaled", TX + features_sql() + f"select transaction_id, {_SHOWN_SQL} from feats")
def features_unscaled(spark: SparkSession, sf_dir: str) -> DataFrame:
    tx = transactions(spark, sf_dir)
    return shown(features(tx, profiles.fit_profiles(tx), ["transaction_id"]), "transaction_id")


@query("unseen_entity_fallback", TX + f""", first_day as (
 select * from tx where "timestamp" < timestamp '{FIRST_DAY_END}')""" + features_sql("tx", "first_day") + f"""
select transaction_id, {_SHOWN_SQL} from feats
""")
def unseen_entity_fallback(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every transaction against the profiles of the first day, which lack many senders and devices."""
    tx = transactions(spark, sf_dir)
    first_day = tx.where(F.col("timestamp") < F.lit(FIRST_DAY_END).cast("timestamp_ntz"))
    return shown(features(tx, profiles.fit_profiles(first_day), ["transaction_id"]), "transaction_id")


def feature_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Id, label and unscaled features of all transactions, written once."""
    tx = transactions(spark, sf_dir)
    return settled(features(tx, profiles.fit_profiles(tx), ["transaction_id", "is_fraud"]))


def scaled_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    table = feature_table(spark, sf_dir)
    return apply_scaler(table, fit_scaler(table, SCALED))


_SCALED_COLUMNS = ", ".join(
    f'("{c}" - avg("{c}") over ()) / (case when stddev_pop("{c}") over () = 0 then 1.0::double'
    f' else stddev_pop("{c}") over () end) as "{c}"'
    if c in SCALED
    else f'"{c}"'
    for c in FEATURES
)
SCALED_SQL = TX + features_sql() + f", scaled as (select transaction_id, is_fraud, {_SCALED_COLUMNS} from feats)"


@query("scaled_features", SCALED_SQL + "select transaction_id, " + ", ".join(
    f'round("{c}", 6) + 0.0 as "{c}"' if c in SCALED else f'"{c}"' for c in FEATURES
) + " from scaled")
def scaled_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    table = scaled_table(spark, sf_dir)
    return table.select(
        "transaction_id", *[rounded(F.col(c), 6).alias(c) if c in SCALED else F.col(c) for c in FEATURES]
    )


@query("knn_minority", SCALED_SQL + """
, points as (select transaction_id, [""" + ", ".join(f'"{c}"::double' for c in FEATURES) + """] as v
 from scaled where is_fraud = 1)
, pairs_of_points as (select a.transaction_id, b.transaction_id as neighbour, round(list_distance(a.v, b.v), 6) as distance
 from points a join points b on a.transaction_id <> b.transaction_id)
select transaction_id, cast(row_number() over (partition by transaction_id order by distance, neighbour) as integer)
  as "rank", neighbour, distance from pairs_of_points
qualify row_number() over (partition by transaction_id order by distance, neighbour) <= 5
""")
def knn_minority(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The five nearest positives of every positive in scaled feature space."""
    vector = F.array(*[F.col(c).cast("double") for c in FEATURES])
    positives = scaled_table(spark, sf_dir).where("is_fraud = 1").select("transaction_id", vector.alias("vec"))
    return nearest_neighbours(positives, "transaction_id", "vec", 5)


@query("calendar_parts", TX + """
select transaction_id, dayname("timestamp") as day_name, cast(weekofyear("timestamp") as integer) as iso_week,
 strftime("timestamp", '%Y-%m') as year_month, strftime("timestamp", '%Y-%m-%d') as "date" from tx
""")
def calendar_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    tx = transactions(spark, sf_dir, "transaction_id", "timestamp")
    parts = temporal.calendar_parts(F.col("timestamp"))
    return tx.select("transaction_id", *[v.cast("string").alias(n) if n == "date" else v.alias(n) for n, v in parts.items()])


@query("date_span", TX + """
select strftime(min("timestamp"), '%Y-%m-%d') as first_day, strftime(max("timestamp"), '%Y-%m-%d') as last_day,
 cast(floor((epoch_us(max("timestamp")) - epoch_us(min("timestamp")))/86400e6) as bigint) as span_days from tx
""")
def date_span(spark: SparkSession, sf_dir: str) -> DataFrame:
    return summaries.date_span(transactions(spark, sf_dir, "timestamp"))


@query("balance_remaining", TX + """
select transaction_id, round(sender_balance_after/(sender_balance_before+1)*100, 6) as balance_remaining_pct from tx
""")
def balance_remaining(spark: SparkSession, sf_dir: str) -> DataFrame:
    tx = transactions(spark, sf_dir, "transaction_id", "sender_balance_before", "sender_balance_after")
    return summaries.with_balance_remaining(tx).select(
        "transaction_id", rounded(F.col("balance_remaining_pct")).alias("balance_remaining_pct")
    )


_TYPE_SQL = TX + """, types as (select transaction_type, avg(sender_balance_before) as m, stddev_samp(sender_balance_before) as s
 from tx group by all)
"""


@query("high_value_target", _TYPE_SQL + """
select transaction_id, case when sender_balance_before > m + 1.5*s then 1 else 0 end as is_high_value_target,
 round(sender_balance_before/(m + 1e-9), 6) as bal_to_type_avg_ratio from tx join types using (transaction_type)
""")
def high_value_target(spark: SparkSession, sf_dir: str) -> DataFrame:
    tx = transactions(spark, sf_dir, "transaction_id", "transaction_type", "sender_balance_before")
    return summaries.with_type_balance(tx).select(
        "transaction_id", "is_high_value_target", rounded(F.col("bal_to_type_avg_ratio")).alias("bal_to_type_avg_ratio")
    )


@query("type_mean_ratio", _TYPE_SQL + """
select transaction_id, round(sender_balance_before/avg(sender_balance_before) over (partition by transaction_type), 6)
 as bal_to_type_mean from tx
""")
def type_mean_ratio(spark: SparkSession, sf_dir: str) -> DataFrame:
    tx = transactions(spark, sf_dir, "transaction_id", "transaction_type", "sender_balance_before")
    return summaries.with_type_balance(tx).select(
        "transaction_id", rounded(F.col("bal_to_type_mean")).alias("bal_to_type_mean")
    )


BANDS_SQL = TX + """, edges as (select list_sort(list_distinct(quantile_cont(amount,
  [0.0, 0.125, 0.25, 0.375, 0.5, 0.625, 0.75, 0.875, 1.0]))) as e from tx)
, banded as (select tx.*, cast(greatest(0, len(list_filter(e, lambda x: x < amount)) - 1) as integer) as amount_band, e
 from tx cross join edges)
"""


@query("amount_bands", BANDS_SQL + """
select transaction_id, amount_band, round(e[amount_band+1], 6) as band_low, round(e[amount_band+2], 6) as band_high from banded
""")
def amount_bands(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = quantile_bands(transactions(spark, sf_dir, "transaction_id", "amount"), "amount", 8)
    return placed.select(
        "transaction_id",
        F.col("band").alias("amount_band"),
        rounded(F.col("band_low")).alias("band_low"),
        rounded(F.col("band_high")).alias("band_high"),
    )


AGE_SQL = TX + """, aged as (select *, min("timestamp") over (partition by sender_id) as first_ts from tx)
, ages as (select *, case when "timestamp" = first_ts then 1 else 0 end as is_first_tx,
  cast(floor((epoch_us("timestamp") - epoch_us(first_ts))/86400e6) as bigint) as account_age_days from aged)
, buckets as (select *, case when account_age_days <= 0 then 'Day 0 (First)' when account_age_days <= 7 then '1-7 days'
  when account_age_days <= 30 then '8-30 days' when account_age_days <= 90 then '31-90 days'
  when account_age_days <= 180 then '91-180 days' else '180+ days' end as age_bucket from ages)
"""


@query("account_age", AGE_SQL + "select transaction_id, is_first_tx, account_age_days from ages")
def account_age(spark: SparkSession, sf_dir: str) -> DataFrame:
    tx = transactions(spark, sf_dir, "transaction_id", "sender_id", "timestamp")
    return summaries.with_account_age(tx).select("transaction_id", "is_first_tx", "account_age_days")


@query("age_buckets", AGE_SQL + "select transaction_id, age_bucket from buckets")
def age_buckets(spark: SparkSession, sf_dir: str) -> DataFrame:
    tx = transactions(spark, sf_dir, "transaction_id", "sender_id", "timestamp")
    return summaries.with_age_bucket(tx).select("transaction_id", "age_bucket")


GRID_SQL = TX + """, gridded as (select *, round_even(location_lat, 0) + 0.0 as grid_lat,
 round_even(location_lon, 0) + 0.0 as grid_lon from tx)
"""


@query("geo_grid", GRID_SQL + "select transaction_id, grid_lat, grid_lon from gridded")
def geo_grid(spark: SparkSession, sf_dir: str) -> DataFrame:
    tx = transactions(spark, sf_dir, "transaction_id", "location_lat", "location_lon")
    return tx.select("transaction_id", *[v.alias(n) for n, v in geo.grid_cell().items()])


@query("apply_threshold", SCORED + """
select transaction_id, score, case when score >= 0.33 then 1 else 0 end as predicted_fraud from scored
""")
def apply_threshold(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = scored_transactions(spark, sf_dir)
    return scored.select("transaction_id", "score", labels.predicted_fraud(F.col("score")).alias("predicted_fraud"))


@query("risk_tier", SCORED + """
select transaction_id, case when score >= 0.55 then 'fraud' when score >= 0.30 then 'suspicious' else 'legitimate' end
 as risk_tier from scored
""")
def risk_tier(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = scored_transactions(spark, sf_dir)
    return scored.select("transaction_id", labels.risk_tier(F.col("score")).alias("risk_tier"))


_IN_TEST = "substr(md5(concat(transaction_id, ':42')), 1, 8) < '33333333'"


@query("stratified_split", TX + f"""
select transaction_id, is_fraud, case when {_IN_TEST} then 'test' else 'train' end as part from tx
""")
def stratified_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    train, test = sampling.stratified_split(transactions(spark, sf_dir, "transaction_id", "is_fraud"))
    return train.withColumn("part", F.lit("train")).unionByName(test.withColumn("part", F.lit("test")))


@query("exact_stratified_split", TX + """
, sizes as (select is_fraud, count(*) as n, cast(round(count(*)*0.2) as bigint) as cut from tx group by all)
select is_fraud, 'test' as part, cut as rows from sizes union all select is_fraud, 'train', n - cut from sizes
""")
def exact_stratified_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    train, test = sampling.exact_stratified_split(transactions(spark, sf_dir, "transaction_id", "is_fraud"))
    both = train.withColumn("part", F.lit("train")).unionByName(test.withColumn("part", F.lit("test")))
    return both.groupBy("is_fraud", "part").agg(F.count("*").alias("rows"))


@query("cv_folds", TX + """
select transaction_id, is_fraud,
 cast(('0x' || substr(md5(concat(transaction_id, ':fold42')), 1, 8))::bigint % 3 as integer) as fold from tx
""")
def cv_folds(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sampling.with_fold(transactions(spark, sf_dir, "transaction_id", "is_fraud"), 3)


@query("class_weights", TX + """, counts as (select is_fraud, count(*) as rows from tx group by all)
select is_fraud, rows, round((sum(rows) over ())::double/(count(*) over ())/rows, 6) as weight from counts
""")
def class_weights(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sampling.class_weights(transactions(spark, sf_dir, "is_fraud"))


@query("smote_counts", TX + """
select label as is_fraud, count(*) filter (where is_synthetic = 0) as originals,
 max(greatest(n0, n1)) as total from
 (select is_fraud as label, 0 as is_synthetic from tx),
 (select count(*) filter (where is_fraud = 0) as n0, count(*) filter (where is_fraud = 1) as n1 from tx)
group by all
""")
def smote_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of each class after oversampling: both reach the larger class."""
    made = sampling.smote(scaled_table(spark, sf_dir), FEATURES)
    return made.groupBy("is_fraud").agg(
        F.count_if(F.col("is_synthetic") == 0).alias("originals"), F.count("*").alias("total")
    )


@query("smote_rows")
def smote_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The synthetic rows themselves."""
    return sampling.smote(scaled_table(spark, sf_dir), FEATURES).where("is_synthetic = 1")
