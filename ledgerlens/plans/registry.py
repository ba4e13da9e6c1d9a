"""The named queries and the SQL each must agree with."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query; without ``sql`` it is checked by tests only."""

    def add(fn: Query) -> Query:
        QUERIES[name] = fn
        if sql is not None:
            SQL[name] = sql
        return fn

    return add


# The stand-in transaction table.
TX = """
with tx as (
 select cast(e.event_id as varchar) as transaction_id, e.ts as "timestamp",
  concat('S', cast(e.user_id as varchar)) as sender_id,
  concat('R', cast((e.event_id*7919) % 97 as varchar)) as receiver_id,
  e.value*100 as amount,
  case e.event_type when 'view' then 'send_money' when 'click' then 'pay_bill' when 'purchase' then 'buy_goods'
                    when 'error' then 'withdraw' else 'deposit' end as transaction_type,
  c.c_acctbal + 1000 + (e.event_id % 50)*1000 as sender_balance_before,
  c.c_acctbal + 1000 + (e.event_id % 50)*1000 - e.value*100
    + case when e.event_id % 20 = 0 then 5 else 0 end as sender_balance_after,
  cast((e.event_id*31) % 5000 as double) as receiver_balance_before,
  cast((e.event_id*31) % 5000 as double) + e.value*100 as receiver_balance_after,
  concat('D', json_extract_string(e.props, '$.k')) as device_id,
  cast((e.event_id*13) % 1100 as double)/100 - 5.5 as location_lat,
  cast((e.event_id*17) % 900 as double)/100 + 33.5 as location_lon,
  case when e.value > 150 or (hour(e.ts) < 6 and e.event_id % 10 = 0) then 1 else 0 end as is_fraud
 from events e left join customer c on e.user_id = c.c_custkey)
"""

# The same table with faults.
FAULTY = TX + """, faulty_once as (
 select transaction_id, "timestamp", sender_id, receiver_id,
  case when n % 29 = 0 then -amount when n % 11 = 0 then 'nan'::double when n % 13 = 0 then 'inf'::double
       when n % 17 = 0 then '-inf'::double when n % 19 = 0 then null else amount end as amount,
  case when n % 23 = 0 then 'airtime' else transaction_type end as transaction_type,
  sender_balance_before, sender_balance_after, receiver_balance_before, receiver_balance_after,
  case when n % 43 = 0 then null else device_id end as device_id,
  case when n % 31 = 0 then 95.0::double else location_lat end as location_lat, location_lon,
  case when n % 37 = 0 then 2 else is_fraud end as is_fraud,
  'KES' as currency, cast(null as varchar) as channel, 1.5::double as fee
 from (select *, cast(transaction_id as bigint) as n from tx)),
faulty as (select * from faulty_once union all select * from faulty_once where cast(transaction_id as bigint) % 41 = 0)
"""

# Non-finite amounts as NULL.
MENDED = FAULTY + """, mended as (
 select * replace (case when isfinite(amount) then amount end as amount) from faulty)
"""


def profiles_sql(source: str) -> str:
    """CTEs ``sp``, ``dp`` and ``fb``: sender profile, device profile and fallbacks of a table."""
    return f""",
pairs as (select sender_id, device_id, count(*) as uses from {source} group by all),
prim as (select sender_id, first(device_id order by uses desc, device_id) as primary_device from pairs group by all),
sp as (select s.*, p.primary_device from
  (select sender_id, count(transaction_id) as total_tx, count(distinct receiver_id) as unique_recv,
          count(distinct device_id) as unique_devices, avg(amount) as avg_amount from {source} group by all) s
  left join prim p using (sender_id)),
dp as (select device_id, count(distinct sender_id) as unique_senders from {source} group by all),
fb as (select cast(trunc(quantile_cont(total_tx, 0.5)) as integer) as total_tx,
  cast(trunc(quantile_cont(unique_recv, 0.5)) as integer) as unique_recv,
  cast(trunc(quantile_cont(unique_devices, 0.5)) as integer) as unique_devices,
  quantile_cont(avg_amount, 0.5) as avg_amount, 0 as is_device_switch, 1 as unique_senders from sp)
"""


def features_sql(source: str = "tx", profile_source: str = "tx") -> str:
    """CTE ``feats``: id, label and the 21 features."""
    return profiles_sql(profile_source) + f""",
feats as (select t.transaction_id, t.is_fraud,
  cast(hour(t."timestamp") as integer) as "hour", cast(isodow(t."timestamp")-1 as integer) as day_of_week,
  cast(month(t."timestamp") as integer) as "month",
  case when hour(t."timestamp") between 0 and 5 then 1 else 0 end as is_night,
  case when isodow(t."timestamp")-1 >= 5 then 1 else 0 end as is_weekend,
  ln(1+t.amount) as log_amount, case when t.amount > 10000 then 1 else 0 end as is_high_value,
  t.amount/(coalesce(s.avg_amount, f.avg_amount)+1) as amount_vs_sender_avg,
  greatest(0.0::double, least(1.0::double, t.amount/(t.sender_balance_before+1))) as balance_drain_rate,
  t.sender_balance_before - t.sender_balance_after as sender_balance_change,
  t.receiver_balance_after - t.receiver_balance_before as receiver_balance_change,
  case when abs(t.sender_balance_before - t.sender_balance_after - t.amount) > 1 then 1 else 0 end
    as balance_discrepancy,
  t.amount/(t.sender_balance_before+1) as amount_to_balance_ratio,
  2*6371.0::double*asin(sqrt(pow(sin(radians(t.location_lat - (-1.2921::double))/2),2)
    + cos(radians(-1.2921::double))*cos(radians(t.location_lat))
      *pow(sin(radians(t.location_lon - 36.8219::double)/2),2))) as dist_from_nairobi,
  case when t.location_lat < -5 or t.location_lat > 5 or t.location_lon < 34 or t.location_lon > 42 then 1 else 0 end
    as is_outside_kenya,
  cast(coalesce(s.total_tx, f.total_tx) as bigint) as sender_total_tx,
  cast(coalesce(s.unique_recv, f.unique_recv) as bigint) as sender_unique_recv,
  cast(coalesce(s.unique_devices, f.unique_devices) as bigint) as sender_unique_devices,
  case when s.sender_id is null then 0 when t.device_id <> s.primary_device then 1 else 0 end as is_device_switch,
  cast(coalesce(d.unique_senders, 1) as bigint) as device_unique_senders,
  case t.transaction_type when 'send_money' then 0 when 'pay_bill' then 1 when 'buy_goods' then 2
    when 'withdraw' then 3 when 'deposit' then 4 else -1 end as transaction_type_enc
 from {source} t left join sp s on t.sender_id = s.sender_id left join dp d on t.device_id = d.device_id
 cross join fb f)
"""


SCORED = TX + """, scored as (
 select transaction_id, is_fraud, round(1/(1+exp(-(amount/10000 - 1.5))), 3) as score from tx)
"""
