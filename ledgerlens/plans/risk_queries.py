"""Named queries: label rates, pivots, distributions and entity summaries."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlens.functions import geo, labels
from ledgerlens.functions.numeric import flag, rounded
from ledgerlens.operators import ordered, rates, summaries
from ledgerlens.operators.models import best_so_far as running_best
from ledgerlens.plans.feature_queries import AGE_SQL, BANDS_SQL, GRID_SQL
from ledgerlens.plans.registry import TX, query
from ledgerlens.sources.contract import NUMERIC_COLUMNS
from ledgerlens.sources.standin import transactions

RATE = """count(is_fraud) as total, cast(sum(is_fraud) as bigint) as fraud,
 round(sum(is_fraud)::double/count(is_fraud)*100, 6) as fraud_rate"""


def _rate_sql(key: str, name: str, source: str = "tx") -> str:
    return f'select {key} as "{name}", {RATE} from {source} group by all'


def _timed(spark: SparkSession, sf_dir: str, name: str, value: Column, *more: str) -> DataFrame:
    return transactions(spark, sf_dir, "timestamp", "is_fraud", *more).withColumn(name, value)


@query("fraud_rate_by_type", TX + f"""
select transaction_type, {RATE}, round(count(*)::double/(select count(*) from tx)*100, 6) as pct_of_volume
from tx group by all
""")
def fraud_rate_by_type(spark: SparkSession, sf_dir: str) -> DataFrame:
    tx = transactions(spark, sf_dir, "transaction_type", "is_fraud")
    return rates.with_volume_share(rates.rate_by(tx, "transaction_type")).orderBy(F.desc("fraud_rate"))


@query("type_overview", TX + f"""
select transaction_type, {RATE}, round(avg(amount), 4) as avg_amount, round(quantile_cont(amount, 0.5), 4) as median_amount,
 round(count(*)::double/(select count(*) from tx)*100, 6) as pct_of_volume from tx group by all
""")
def type_overview(spark: SparkSession, sf_dir: str) -> DataFrame:
    return summaries.type_overview(transactions(spark, sf_dir, "transaction_type", "amount", "is_fraud"))


HOURLY = _rate_sql('cast(hour("timestamp") as integer)', "hour")


@query("fraud_rate_by_hour", TX + HOURLY)
def fraud_rate_by_hour(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rates.rate_by(_timed(spark, sf_dir, "hour", F.hour("timestamp")), "hour")


def _daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _timed(spark, sf_dir, "date", F.date_format("timestamp", "yyyy-MM-dd"))


DAILY = _rate_sql("""strftime("timestamp", '%Y-%m-%d')""", "date")


@query("fraud_rate_by_date", TX + DAILY)
def fraud_rate_by_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rates.rate_by(_daily(spark, sf_dir), "date")


@query("fraud_rate_by_dow", TX + f"""
, days as (select * from (values (1,'Monday'),(2,'Tuesday'),(3,'Wednesday'),(4,'Thursday'),(5,'Friday'),(6,'Saturday'),
  (7,'Sunday')) v(day_number, day_name))
, r as (select dayname("timestamp") as day_name, {RATE} from tx group by all)
select cast(day_number as integer) as day_number, day_name, coalesce(total, 0) as total, coalesce(fraud, 0) as fraud,
 fraud_rate from days left join r using (day_name)
""")
def fraud_rate_by_dow(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rates.rate_by_day_name(_timed(spark, sf_dir, "day_name", F.date_format("timestamp", "EEEE")))


WEEKLY = _rate_sql('cast(weekofyear("timestamp") as integer)', "iso_week")


def _weekly(spark: SparkSession, sf_dir: str, digits: int | None = 6) -> DataFrame:
    return rates.rate_by(_timed(spark, sf_dir, "iso_week", F.weekofyear("timestamp")), "iso_week", digits=digits)


@query("fraud_rate_by_week", TX + WEEKLY)
def fraud_rate_by_week(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _weekly(spark, sf_dir)


@query("fraud_rate_by_bbox", TX + f"""
, boxed as (select *, case when location_lat < -5 or location_lat > 5 or location_lon < 34 or location_lon > 42
  then 1 else 0 end as is_outside_kenya from tx)
select is_outside_kenya, case is_outside_kenya when 1 then 'Outside Kenya' else 'Inside Kenya' end as region, {RATE}
from boxed group by all
""")
def fraud_rate_by_bbox(spark: SparkSession, sf_dir: str) -> DataFrame:
    tx = transactions(spark, sf_dir, "location_lat", "location_lon", "is_fraud")
    outside = flag(geo.outside_kenya(F.col("location_lat"), F.col("location_lon")))
    by_box = rates.rate_by(tx.withColumn("is_outside_kenya", outside), "is_outside_kenya")
    return by_box.withColumn("region", labels.region_label(F.col("is_outside_kenya")))


def _grid(spark: SparkSession, sf_dir: str) -> DataFrame:
    tx = transactions(spark, sf_dir, "location_lat", "location_lon", "is_fraud")
    return rates.rate_by(tx.withColumns(geo.grid_cell()), "grid_lat", "grid_lon")


@query("fraud_rate_by_grid", GRID_SQL + f"select grid_lat, grid_lon, {RATE} from gridded group by all")
def fraud_rate_by_grid(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _grid(spark, sf_dir)


@query("top_hotspots", GRID_SQL + f"""
select grid_lat, grid_lon, {RATE} from gridded group by all having count(*) >= 50
order by fraud_rate desc, grid_lat, grid_lon limit 5
""")
def top_hotspots(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rates.top_rates(_grid(spark, sf_dir), 5, min_total=50)


@query("fraud_rate_by_band", BANDS_SQL + f"""
select amount_band, format('{{:,}}', cast(trunc(e[amount_band+1]) as bigint)) || '-' ||
 format('{{:,}}', cast(trunc(e[amount_band+2]) as bigint)) as band_range, {RATE} from banded group by all
""")
def fraud_rate_by_band(spark: SparkSession, sf_dir: str) -> DataFrame:
    return summaries.amount_bands(transactions(spark, sf_dir, "amount", "is_fraud"))


@query("fraud_rate_by_age", AGE_SQL + _rate_sql("age_bucket", "age_bucket", "buckets"))
def fraud_rate_by_age(spark: SparkSession, sf_dir: str) -> DataFrame:
    tx = transactions(spark, sf_dir, "sender_id", "timestamp", "is_fraud")
    return rates.rate_by(summaries.with_age_bucket(tx), "age_bucket")


@query("first_transaction_rate", AGE_SQL + _rate_sql("is_first_tx", "is_first_tx", "ages"))
def first_transaction_rate(spark: SparkSession, sf_dir: str) -> DataFrame:
    tx = transactions(spark, sf_dir, "sender_id", "timestamp", "is_fraud")
    return rates.rate_by(summaries.with_account_age(tx), "is_first_tx")


DEVICE_SENDERS = TX + """, per_device as (select device_id, count(distinct sender_id) as device_unique_senders
 from tx group by all), shared as (select tx.*, device_unique_senders from tx join per_device using (device_id))
"""


def _device_sharing(spark: SparkSession, sf_dir: str) -> DataFrame:
    tx = transactions(spark, sf_dir, "transaction_id", "sender_id", "device_id", "amount", "is_fraud")
    return summaries.rate_by_sharing(summaries.device_activity(tx), "unique_senders", "device_unique_senders")


@query(
    "fraud_rate_by_device_sharing",
    DEVICE_SENDERS + _rate_sql("device_unique_senders", "device_unique_senders", "shared"),
)
def fraud_rate_by_device_sharing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _device_sharing(spark, sf_dir)


@query("device_sharing_top", DEVICE_SENDERS + f"""
select device_unique_senders, {RATE} from shared group by all order by device_unique_senders limit 10
""")
def device_sharing_top(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rates.lowest_keys(_device_sharing(spark, sf_dir), "device_unique_senders", 10)


_DESCRIBE = """count({c}) as "count", round(avg({c}), 4) as mean, round(stddev_samp({c}), 4) as std,
 round(min({c}), 4) as "min", round(quantile_cont({c}, 0.25), 4) as p25, round(quantile_cont({c}, 0.5), 4) as p50,
 round(quantile_cont({c}, 0.75), 4) as p75, round(max({c}), 4) as "max" """


@query("amount_stats_by_class", TX + """
select is_fraud, count(amount) as "count", round(avg(amount), 4) as mean, round(quantile_cont(amount, 0.5), 4) as median,
 round(stddev_samp(amount), 4) as std, round(min(amount), 4) as "min", round(max(amount), 4) as "max" from tx group by all
""")
def amount_stats_by_class(spark: SparkSession, sf_dir: str) -> DataFrame:
    return summaries.amount_stats_by(transactions(spark, sf_dir, "amount", "is_fraud"), "is_fraud")


@query("describe_numeric", TX + " union all ".join(
    f"""select '{c}' as "column", {_DESCRIBE.format(c=c)} from tx""" for c in NUMERIC_COLUMNS
))
def describe_numeric(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ordered.describe(transactions(spark, sf_dir, *NUMERIC_COLUMNS), NUMERIC_COLUMNS)


@query("describe_by_class", TX + """
, wide as (select *, sender_balance_after/(sender_balance_before+1)*100 as balance_remaining_pct from tx)
""" + " union all ".join(
    f"""select is_fraud, '{c}' as "column", {_DESCRIBE.format(c=c)} from wide group by all"""
    for c in ["balance_remaining_pct", "location_lat", "location_lon"]
))
def describe_by_class(spark: SparkSession, sf_dir: str) -> DataFrame:
    tx = transactions(
        spark, sf_dir, "sender_balance_before", "sender_balance_after", "location_lat", "location_lon", "is_fraud"
    )
    return ordered.describe(
        summaries.with_balance_remaining(tx), ["balance_remaining_pct", "location_lat", "location_lon"], ["is_fraud"]
    )


@query("describe_fraud_amount_by_type", TX + f"""
select transaction_type, 'amount' as "column", {_DESCRIBE.format(c="amount")} from tx where is_fraud = 1 group by all
""")
def describe_fraud_amount_by_type(spark: SparkSession, sf_dir: str) -> DataFrame:
    tx = transactions(spark, sf_dir, "transaction_type", "amount", "is_fraud").where("is_fraud = 1")
    return ordered.describe(tx, ["amount"], ["transaction_type"])


@query("skew_cv", TX + " union all ".join(
    f"""select '{c}' as "column", round(skewness({c}), 5) as skewness, round(stddev_samp({c})/avg({c}), 5) as cv from tx"""
    for c in NUMERIC_COLUMNS
))
def skew_cv(spark: SparkSession, sf_dir: str) -> DataFrame:
    return summaries.skew_and_cv(transactions(spark, sf_dir, *NUMERIC_COLUMNS), NUMERIC_COLUMNS)


@query("value_counts", TX + """
select transaction_type, count(*) as rows, round(count(*)::double/(select count(*) from tx)*100, 6) as pct from tx group by all
""")
def value_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rates.value_counts(transactions(spark, sf_dir, "transaction_type"), "transaction_type")


SENDER_DEVICES = TX + """, per_sender as (select sender_id, count(distinct device_id) as sender_unique_devices
 from tx group by all), used as (select tx.*, sender_unique_devices from tx join per_sender using (sender_id))
"""


@query("device_count_share_by_class", SENDER_DEVICES + """
, counts as (select is_fraud, sender_unique_devices, count(*) as rows from used group by all)
select is_fraud, case is_fraud when 1 then 'Fraud' else 'Legitimate' end as "class", sender_unique_devices, rows,
 round(rows::double/sum(rows) over (partition by is_fraud)*100, 6) as pct from counts
""")
def device_count_share_by_class(spark: SparkSession, sf_dir: str) -> DataFrame:
    tx = transactions(spark, sf_dir, "transaction_id", "sender_id", "device_id", "amount", "is_fraud")
    shares = rates.value_counts(summaries.with_sender_devices(tx), "sender_unique_devices", within="is_fraud")
    return shares.withColumn("class", labels.class_label(F.col("is_fraud")))


_HOURS = {h: f"h{h:02d}" for h in range(24)}


@query("pivot_dow_hour", TX + "select dayname(\"timestamp\") as day_name, " + ", ".join(
    f'round(avg(is_fraud) filter (where hour("timestamp") = {h})*100, 6) as {n}' for h, n in _HOURS.items()
) + " from tx group by all")
def pivot_dow_hour(spark: SparkSession, sf_dir: str) -> DataFrame:
    tx = transactions(spark, sf_dir, "timestamp", "is_fraud").select(
        F.date_format("timestamp", "EEEE").alias("day_name"), F.hour("timestamp").alias("hour"), "is_fraud"
    )
    return rates.pivot_table(tx, "day_name", "hour", _HOURS, rounded(F.avg("is_fraud") * 100))


_CLASSES = {0: "legitimate", 1: "fraud"}


@query("pivot_month_class", TX + """
select cast(month("timestamp") as integer) as "month", count(*) filter (where is_fraud = 0) as legitimate,
 count(*) filter (where is_fraud = 1) as fraud from tx group by all
""")
def pivot_month_class(spark: SparkSession, sf_dir: str) -> DataFrame:
    tx = _timed(spark, sf_dir, "month", F.month("timestamp"))
    return rates.pivot_table(tx, "month", "is_fraud", _CLASSES, F.count("is_fraud"), fill=0)


@query("pivot_type_median", TX + """
select transaction_type, round(quantile_cont(amount, 0.5) filter (where is_fraud = 0), 4) as legitimate,
 round(quantile_cont(amount, 0.5) filter (where is_fraud = 1), 4) as fraud from tx group by all
""")
def pivot_type_median(spark: SparkSession, sf_dir: str) -> DataFrame:
    tx = transactions(spark, sf_dir, "transaction_type", "amount", "is_fraud")
    medians = ordered.wide_quantiles(tx, "amount", {"median": 0.5}, ["transaction_type", "is_fraud"])
    return rates.pivot_table(medians, "transaction_type", "is_fraud", _CLASSES, rounded(F.max("median"), 4))


@query("pivot_type_mean", TX + """
select transaction_type, round(avg(sender_balance_before) filter (where is_fraud = 0), 4) as legitimate,
 round(avg(sender_balance_before) filter (where is_fraud = 1), 4) as fraud from tx group by all
""")
def pivot_type_mean(spark: SparkSession, sf_dir: str) -> DataFrame:
    tx = transactions(spark, sf_dir, "transaction_type", "sender_balance_before", "is_fraud")
    return rates.pivot_table(tx, "transaction_type", "is_fraud", _CLASSES, rounded(F.avg("sender_balance_before"), 4))


VELOCITY = TX + """, velocity as (select sender_id, cast("timestamp" as date) as d, is_fraud, count(*) as tx_count
 from tx group by all)
"""


@query("velocity_daily", VELOCITY + f"""
select is_fraud, {_DESCRIBE.format(c="tx_count::double")}, (select round(quantile_cont(tx_count, 0.99), 4) from velocity) as clip_p99
from velocity group by all
""")
def velocity_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    return summaries.velocity_stats(transactions(spark, sf_dir, "sender_id", "timestamp", "is_fraud"))


@query("entity_summary", TX + """
, s as (select sender_id, count(transaction_id) as n, sum(is_fraud) as f, count(distinct device_id) as p from tx group by all)
, d as (select device_id, count(transaction_id) as n, sum(is_fraud) as f, count(distinct sender_id) as p from tx group by all)
select 'sender' as entity, count(*) as entities, round(avg(n), 4) as mean_tx, max(n) as max_tx,
 count(*) filter (where p > 1) as with_several, count(*) filter (where f > 0) as with_fraud from s
union all
select 'device', count(*), round(avg(n), 4), max(n), count(*) filter (where p > 1), count(*) filter (where f > 0) from d
""")
def entity_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    tx = transactions(spark, sf_dir, "transaction_id", "sender_id", "receiver_id", "device_id", "amount", "is_fraud")
    return summaries.entity_summary(tx)


@query("receiver_diversity", TX + """
, s as (select sender_id, count(distinct receiver_id) as r, count(*) as n, cast(sum(is_fraud) as bigint) as f from tx group by all)
select case when f > 0 then 1 else 0 end as is_fraud_sender, case when r = 1 then 1 else 0 end as targets_single_receiver,
 count(*) as senders, round(avg(r), 4) as mean_receivers, max(r) as max_receivers, cast(sum(n) as bigint) as rows,
 round(sum(f)::double/sum(n)*100, 6) as fraud_rate from s group by 1, 2
""")
def receiver_diversity(spark: SparkSession, sf_dir: str) -> DataFrame:
    tx = transactions(spark, sf_dir, "transaction_id", "sender_id", "receiver_id", "device_id", "amount", "is_fraud")
    return summaries.receiver_diversity(tx)


RECEIVERS = TX + """, per_sender as (select sender_id, count(distinct receiver_id) as unique_receivers from tx group by all)
, spread as (select tx.*, unique_receivers from tx join per_sender using (sender_id))
"""


@query("receivers_by_class", RECEIVERS + f"""
select is_fraud, 'unique_receivers' as "column", {_DESCRIBE.format(c="unique_receivers::double")} from spread group by all
""")
def receivers_by_class(spark: SparkSession, sf_dir: str) -> DataFrame:
    tx = transactions(spark, sf_dir, "sender_id", "receiver_id", "is_fraud")
    return ordered.describe(summaries.with_unique_receivers(tx), ["unique_receivers"], ["is_fraud"])


@query("conditional_shares", SENDER_DEVICES + """
select is_fraud,
 round(avg(case when sender_balance_after/(sender_balance_before+1)*100 < 10 then 1.0::double else 0.0 end)*100, 6) as pct_drained,
 round(avg(case when location_lat < -5 or location_lat > 5 or location_lon < 34 or location_lon > 42
   then 1.0::double else 0.0 end)*100, 6) as pct_outside,
 round(avg(case when 2*6371.0::double*asin(sqrt(pow(sin(radians(location_lat - (-1.2921::double))/2),2)
    + cos(radians(-1.2921::double))*cos(radians(location_lat))
      *pow(sin(radians(location_lon - 36.8219::double)/2),2))) > 500 then 1.0::double else 0.0 end)*100, 6) as pct_far,
 round(avg(case when sender_unique_devices > 1 then 1.0::double else 0.0 end)*100, 6) as pct_multi_device
from used group by all
""")
def conditional_shares(spark: SparkSession, sf_dir: str) -> DataFrame:
    lat, lon = F.col("location_lat"), F.col("location_lon")
    rows = summaries.with_balance_remaining(summaries.with_sender_devices(transactions(spark, sf_dir)))
    return rates.conditional_shares(
        rows,
        {
            "pct_drained": F.col("balance_remaining_pct") < 10,
            "pct_outside": geo.outside_kenya(lat, lon),
            "pct_far": geo.distance_km(lat, lon) > 500,
            "pct_multi_device": F.col("sender_unique_devices") > 1,
        },
    )


@query("medians_by_class", SENDER_DEVICES + """
, wide as (select is_fraud, sender_balance_after/(sender_balance_before+1)*100 as balance_remaining_pct,
 2*6371.0::double*asin(sqrt(pow(sin(radians(location_lat - (-1.2921::double))/2),2)
    + cos(radians(-1.2921::double))*cos(radians(location_lat))
      *pow(sin(radians(location_lon - 36.8219::double)/2),2))) as dist_from_nairobi, sender_unique_devices from used)
""" + " union all ".join(
    f"""select is_fraud, '{c}' as "column", round(quantile_cont({c}, 0.5), 4) as median from wide group by all"""
    for c in ["balance_remaining_pct", "dist_from_nairobi", "sender_unique_devices"]
))
def medians_by_class(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = summaries.with_balance_remaining(summaries.with_sender_devices(transactions(spark, sf_dir))).withColumns(
        geo.geographic_features()
    )
    return summaries.medians_by(rows, ["balance_remaining_pct", "dist_from_nairobi", "sender_unique_devices"])


@query("peak_keys", TX + ", h as (" + HOURLY + """)
select (select "hour" from h order by fraud_rate desc, "hour" limit 1) as highest_rate,
 (select "hour" from h order by fraud_rate, "hour" limit 1) as lowest_rate,
 (select "hour" from h order by total desc, "hour" limit 1) as most_rows
""")
def peak_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rates.peaks(fraud_rate_by_hour(spark, sf_dir), "hour")


@query("night_rate_avg", TX + ", h as (" + HOURLY + """)
select round(avg(fraud_rate), 6) as mean_rate, count(*) as keys from h where "hour" in (23, 0, 1, 2, 3, 4, 5)
""")
def night_rate_avg(spark: SparkSession, sf_dir: str) -> DataFrame:
    mean = rates.mean_rate_over(fraud_rate_by_hour(spark, sf_dir), "hour", [23, 0, 1, 2, 3, 4, 5])
    return mean.withColumn("mean_rate", rounded(F.col("mean_rate")))


@query("class_balance", TX + """
select count(is_fraud) as total, cast(sum(is_fraud) as bigint) as fraud, round(avg(is_fraud), 6) as fraud_rate,
 round((1-avg(is_fraud))/avg(is_fraud), 4) as imbalance_ratio, round(1-avg(is_fraud), 6) as baseline_accuracy from tx
""")
def class_balance(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rates.class_balance(transactions(spark, sf_dir, "is_fraud"))


@query("dataset_overview", TX + """
select 'rows' as item, cast(count(*) as varchar) as "value" from tx
union all select 'first_time', strftime(min("timestamp"), '%Y-%m-%d %H:%M:%S') from tx
union all select 'last_time', strftime(max("timestamp"), '%Y-%m-%d %H:%M:%S') from tx
union all select 'fraud', cast(sum(is_fraud) as varchar) from tx
union all select 'senders', cast(count(distinct sender_id) as varchar) from tx
union all select 'receivers', cast(count(distinct receiver_id) as varchar) from tx
union all select 'devices', cast(count(distinct device_id) as varchar) from tx
union all select 'transaction_types', cast(count(distinct transaction_type) as varchar) from tx
""")
def dataset_overview(spark: SparkSession, sf_dir: str) -> DataFrame:
    return summaries.dataset_overview(transactions(spark, sf_dir))


@query("geo_spread", TX + """
select is_fraud, round(min(location_lat), 4) as lat_min, round(max(location_lat), 4) as lat_max,
 round(min(location_lon), 4) as lon_min, round(max(location_lon), 4) as lon_max,
 round(stddev_samp(location_lat), 6) as lat_std, round(stddev_samp(location_lon), 6) as lon_std,
 round(avg(case when location_lat < -5 or location_lat > 5 or location_lon < 34 or location_lon > 42 then 1 else 0 end)*100, 6)
  as pct_outside from tx group by all
""")
def geo_spread(spark: SparkSession, sf_dir: str) -> DataFrame:
    return summaries.geo_spread(transactions(spark, sf_dir, "location_lat", "location_lon", "is_fraud"))


@query("weekly_trend", TX + """, w as (select weekofyear("timestamp") as iso_week,
 sum(is_fraud)::double/count(is_fraud)*100 as fraud_rate from tx group by all)
select round(regr_slope(fraud_rate, iso_week), 6) as slope, round(regr_intercept(fraud_rate, iso_week), 6) as intercept from w
""")
def weekly_trend(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rates.linear_trend(_weekly(spark, sf_dir, digits=None), "iso_week")


@query("histogram", TX + """
, v as (select is_fraud, ln(1+amount) as x from tx)
, r as (select min(x) as lo, (max(x) - min(x))/50 as w from v)
, b as (select is_fraud, cast(least(49, floor((x - lo)/w)) as integer) as bin, lo, w from v cross join r)
select is_fraud, bin, round(lo + bin*w, 6) as bin_low, round(lo + bin*w + w, 6) as bin_high, count(*) as rows,
 round(count(*)/(sum(count(*)) over (partition by is_fraud)*w), 8) as density from b group by is_fraud, bin, lo, w
""")
def histogram(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The logarithm of the amount in 50 bins by class, with densities."""
    tx = transactions(spark, sf_dir, "amount", "is_fraud").withColumn("log_amount", F.log1p("amount"))
    return rates.histogram(tx, "log_amount", 50, by="is_fraud", density=True)


@query("histogram_clipped", VELOCITY + """
, clip as (select quantile_cont(tx_count, 0.99) as q from velocity)
, v as (select is_fraud, least(tx_count, q)::double as x from velocity cross join clip)
, r as (select min(x) as lo, (max(x) - min(x))/40 as w from v)
, b as (select is_fraud, cast(least(39, floor((x - lo)/w)) as integer) as bin, lo, w from v cross join r)
select is_fraud, bin, round(lo + bin*w, 6) as bin_low, round(lo + bin*w + w, 6) as bin_high, count(*) as rows
from b group by all
""")
def histogram_clipped(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sender-day counts clipped at their 99th percentile, in 40 bins by class."""
    counts = summaries.settled(
        summaries.velocity(transactions(spark, sf_dir, "sender_id", "timestamp", "is_fraud")).select("is_fraud", "tx_count")
    )
    clip = ordered.wide_quantiles(counts, "tx_count", {"p99": 0.99}).scalar()
    return rates.histogram(counts, "tx_count", 40, by="is_fraud", clip_high=clip)


@query("cumulative_by_date", TX + """
, daily as (select strftime("timestamp", '%Y-%m-%d') as "date", cast(sum(is_fraud) as bigint) as daily_fraud,
 count(is_fraud) as daily_total from tx group by all)
select *, cast(sum(daily_fraud) over (order by "date") as bigint) as cumulative_fraud,
 cast(sum(daily_total) over (order by "date") as bigint) as cumulative_total from daily
""")
def cumulative_by_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rates.cumulative_by(_daily(spark, sf_dir), "date")


@query("best_so_far", TX + ", d as (" + DAILY + """)
select "date", fraud_rate, max(fraud_rate) over (order by "date") as best_so_far from d
""")
def best_so_far(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Running maximum, here of the daily rates."""
    return running_best(fraud_rate_by_date(spark, sf_dir).select("date", "fraud_rate"), "date", "fraud_rate")


@query("box_stats_by_type", TX + """
, f as (select transaction_type, amount from tx where is_fraud = 1)
, q as (select transaction_type, quantile_cont(amount, 0.25) as q1, quantile_cont(amount, 0.5) as med,
  quantile_cont(amount, 0.75) as q3 from f group by all)
select transaction_type, round(q1, 4) as q1, round(med, 4) as median, round(q3, 4) as q3,
 round(min(amount) filter (where amount between q1 - 1.5*(q3-q1) and q3 + 1.5*(q3-q1)), 4) as whisker_low,
 round(max(amount) filter (where amount between q1 - 1.5*(q3-q1) and q3 + 1.5*(q3-q1)), 4) as whisker_high,
 count(*) filter (where not (amount between q1 - 1.5*(q3-q1) and q3 + 1.5*(q3-q1))) as outliers
from f join q using (transaction_type) group by transaction_type, q1, med, q3
""")
def box_stats_by_type(spark: SparkSession, sf_dir: str) -> DataFrame:
    frauds = transactions(spark, sf_dir, "transaction_type", "amount", "is_fraud").where("is_fraud = 1")
    return summaries.box_stats(frauds, "amount", "transaction_type")
