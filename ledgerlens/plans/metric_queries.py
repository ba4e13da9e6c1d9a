"""Named queries: drift and classification metrics."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlens.functions.labels import predicted_fraud
from ledgerlens.functions.numeric import rounded
from ledgerlens.operators import drift, metrics
from ledgerlens.operators.small import settled
from ledgerlens.plans.registry import SCORED, TX, query
from ledgerlens.sources.state import export_gate as gate
from ledgerlens.sources.standin import scored_transactions, transactions

_DRIFT_COLUMNS = [*drift.DRIFT_NUMERIC, *drift.DRIFT_CATEGORICAL]
_BASE_ROWS = "substr(md5(concat(transaction_id, ':42')), 1, 8) < 'cccccccc'"


def _bins_sql(source: str, bounds: str, column: str) -> str:
    inner = " + ".join(f"(case when x >= lo + {i}*((hi-lo)/10) then 1 else 0 end)" for i in range(1, 10))
    return f"""select '{column}' as "column", {inner} as bin, count(*) as n from
     (select {column} as x from {source}) cross join (select lo, hi from {bounds} where "column" = '{column}') group by all"""


BASELINE_SQL = TX + f""", base as (select * from tx where {_BASE_ROWS})
, moments as (""" + " union all ".join(
    f"""select '{c}' as "column", avg({c}) as mean, stddev_samp({c}) as std, min({c}) as lo, max({c}) as hi from base"""
    for c in drift.DRIFT_NUMERIC
) + ")" + """
, ref_bins as (""" + " union all ".join(_bins_sql("base", "moments", c) for c in drift.DRIFT_NUMERIC) + """)
, ref_shares as (select transaction_type as "key", count(*)::double/(select count(*) from base) as share from base group by all)
"""


def _base(spark: SparkSession, sf_dir: str) -> DataFrame:
    tx = transactions(spark, sf_dir, "transaction_id", *_DRIFT_COLUMNS, "is_fraud")
    return drift.baseline_sample(tx)


@query("reference_stats", BASELINE_SQL + """
, stats as (
select "column", 'numeric' as kind, 'mean' as "key", mean as "value" from moments
union all select "column", 'numeric', 'std', std from moments
union all select "column", 'numeric', 'min', lo from moments
union all select "column", 'numeric', 'max', hi from moments
union all select "column", 'bin', cast(bin as varchar), n::double from ref_bins
union all select 'transaction_type', 'category', "key", share from ref_shares
union all select 'is_fraud', 'rate', 'mean', avg(is_fraud) from base)
select "column", kind, "key", round("value", 4) as "value" from stats
""")
def reference_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return drift.build_baseline(_base(spark, sf_dir)).withColumn("value", rounded(F.col("value"), 4))


# The whole table, against the baseline of the sample.
DRIFT_SQL = BASELINE_SQL + """, cur as (select * from tx)
, cur_bins as (""" + " union all ".join(_bins_sql("cur", "moments", c) for c in drift.DRIFT_NUMERIC) + """)
, grid as (select "column", b as bin from moments, range(10) t(b))
, bin_terms as (select g."column",
   coalesce(r.n::double/(select sum(n) from ref_bins z where z."column" = g."column"), 1e-4) as r,
   coalesce(c.n::double/(select sum(n) from cur_bins z where z."column" = g."column"), 1e-4) as c
  from grid g left join ref_bins r on g."column" = r."column" and g.bin = r.bin
  left join cur_bins c on g."column" = c."column" and g.bin = c.bin)
, psi_num as (select "column", round(sum((c-r)*ln(c/r)), 4) as psi from bin_terms group by all)
, steps as (select "key", floor(share*1000) as s from ref_shares where floor(share*1000) > 0)
, rs as (select "key", s::double/(select sum(s) from steps) as r from steps)
, cs as (select transaction_type as "key", count(*)::double/(select count(*) from cur) as c from cur group by all)
, psi_cat as (select 'transaction_type' as "column", round(sum((coalesce(c,1e-4)-coalesce(r,1e-4))
   *ln(coalesce(c,1e-4)/coalesce(r,1e-4))), 4) as psi from rs full outer join cs using ("key"))
, shift as (select 'is_fraud' as "column", (select avg(is_fraud) from base) as ref, (select avg(is_fraud) from cur) as cur)
"""


def _sides(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """The whole table, and the stored baseline."""
    current = transactions(spark, sf_dir, *_DRIFT_COLUMNS, "is_fraud")
    return current, settled(drift.build_baseline(_base(spark, sf_dir)))


@query("psi_numeric", DRIFT_SQL + "select * from psi_num")
def psi_numeric(spark: SparkSession, sf_dir: str) -> DataFrame:
    return drift.psi_numeric(*_sides(spark, sf_dir))


@query("psi_categorical", DRIFT_SQL + "select * from psi_cat")
def psi_categorical(spark: SparkSession, sf_dir: str) -> DataFrame:
    return drift.psi_categorical(*_sides(spark, sf_dir))


@query("label_shift", DRIFT_SQL + """
select "column", round(ref, 4) as reference_rate, round(cur, 4) as current_rate, round(abs(cur-ref), 4) as shift,
 abs(cur-ref) > 0.05 as flagged from shift
""")
def label_shift(spark: SparkSession, sf_dir: str) -> DataFrame:
    return drift.label_shift(*_sides(spark, sf_dir))


@query("drift_report", DRIFT_SQL + """
, lines as (select "column", 'psi' as measure, psi as "value", psi >= 0.2 as flagged from psi_num
 union all select "column", 'psi', psi, psi >= 0.2 from psi_cat
 union all select "column", 'rate_shift', round(abs(cur-ref), 4), abs(cur-ref) > 0.05 from shift)
select *, cast(null as varchar) as note from lines
union all select '*', 'status', cast(null as double), bool_or(flagged),
 case when bool_or(flagged) then 'DRIFT DETECTED' else 'STABLE' end from lines
""")
def drift_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return drift.check_drift(*_sides(spark, sf_dir))


_INNER = " + ".join(f"(case when x >= lo + {i}*((hi-lo)/10) then 1 else 0 end)" for i in range(1, 10))


@query("rolling_psi", TX + f"""
, r as (select min(amount) as lo, max(amount) as hi from tx)
, placed as (select cast(floor(datediff('day', date '1970-01-05', cast("timestamp" as date))/7) as integer) as w, {_INNER} as bin
  from (select "timestamp", amount as x from tx) cross join r)
, counts as (select w, bin, count(*) as n from placed group by all)
, shares as (select t.w, b as bin, coalesce(n::double/total, 1e-4) as s from
  (select w, sum(n) as total from counts group by all) t cross join range(10) g(b) left join counts c on c.w = t.w and c.bin = b)
select cast(date '1970-01-05' + c.w*7 as varchar) as window_start, round(sum((c.s-p.s)*ln(c.s/p.s)), 4) as psi
from shares c join shares p on p.w = c.w - 1 and p.bin = c.bin group by c.w
""")
def rolling_psi(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = drift.rolling_psi(transactions(spark, sf_dir, "timestamp", "amount"))
    return out.withColumn("window_start", F.col("window_start").cast("string"))


@query("batch_summary", SCORED + """
, p as (select *, case when score >= 0.33 then 1 else 0 end as f from scored)
select count(*) as total, cast(sum(f) as bigint) as flagged, cast(count(*) - sum(f) as bigint) as legitimate,
 round(sum(f)::double/count(*), 4) as fraud_rate, round(avg(score), 4) as avg_score from p
""")
def batch_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = scored_transactions(spark, sf_dir)
    return metrics.batch_summary(scored.withColumn("predicted_fraud", predicted_fraud(F.col("score"))))


CURVE = SCORED + """, st as (select score, count(*) filter (where is_fraud = 1) as p, count(*) filter (where is_fraud = 0) as n
 from scored group by all)
, curve as (select *, sum(p) over (order by score desc) as tp, sum(n) over (order by score desc) as fp,
  sum(p) over () as allp, sum(n) over () as alln, lead(p) over (order by score desc) as np, lead(n) over (order by score desc) as nn,
  row_number() over (order by score desc) as rn from st)
, roc as (select score as threshold, round(fp::double/alln, 6) as fpr, round(tp::double/allp, 6) as tpr from curve
   where rn = 1 or np is null or np <> p or nn <> n
   union all select 'inf'::double, 0.0::double, 0.0::double)
, pr as (select score as threshold, round(tp::double/(tp+fp), 6) as prec, round(tp::double/allp, 6) as recall from curve
   union all select cast(null as double), 1.0::double, 0.0::double)
"""


@query("roc_points", CURVE + "select * from roc")
def roc_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metrics.roc_points(scored_transactions(spark, sf_dir))


@query("pr_points", CURVE + "select * from pr")
def pr_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metrics.pr_points(scored_transactions(spark, sf_dir))


@query("curve_point_at", CURVE + """
, w as (select unnest([0.3::double, 0.33::double, 0.55::double]) as wanted)
select 'roc' as curve, wanted, threshold, fpr as x, tpr as y from (select *, row_number() over (partition by wanted
  order by abs(threshold - wanted), threshold desc) as k from roc cross join w) where k = 1
union all
select 'pr', wanted, threshold, prec, recall from (select *, row_number() over (partition by wanted
  order by abs(threshold - wanted), threshold) as k from pr cross join w where threshold is not null) where k = 1
""")
def curve_point_at(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = scored_transactions(spark, sf_dir)
    wanted = [0.3, 0.33, 0.55]
    roc = metrics.curve_point_at(metrics.roc_points(scored), wanted, "roc")
    pr = metrics.curve_point_at(metrics.pr_points(scored), wanted, "pr")
    names = ["curve", "wanted", "threshold", "x", "y"]
    return roc.select(F.lit("roc"), "*").toDF(*names).union(pr.select(F.lit("pr"), "*").toDF(*names))


@query("roc_auc", CURVE + "select round(sum(p*(alln - fp + n/2.0::double))/(max(allp)::double*max(alln)::double), 6) as roc_auc from curve")
def roc_auc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metrics.roc_auc(scored_transactions(spark, sf_dir))


@query("average_precision", CURVE + "select round(sum(p*(tp::double/(tp+fp)))/max(allp), 6) as average_precision from curve")
def average_precision(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metrics.average_precision(scored_transactions(spark, sf_dir))


_SWEEP = """
, c as (select t as threshold, count(*) filter (where score >= t and is_fraud = 1) as tp,
 count(*) filter (where score >= t and is_fraud = 0) as fp, count(*) filter (where score < t and is_fraud = 1) as fn,
 count(*) filter (where score < t and is_fraud = 0) as tn from scored cross join (select unnest({ts}) as t) group by all)
, m as (select *, coalesce(tp::double/nullif(tp+fp,0), 0.0::double) as pr, coalesce(tp::double/nullif(tp+fn,0), 0.0::double) as rc,
  coalesce(2.0::double*tp/nullif(2*tp+fp+fn,0), 0.0::double) as f1v,
  coalesce(tn::double/nullif(tn+fn,0), 0.0::double) as pr0, coalesce(tn::double/nullif(tn+fp,0), 0.0::double) as rc0,
  coalesce(2.0::double*tn/nullif(2*tn+fp+fn,0), 0.0::double) as f10, (tp+tn)::double/(tp+tn+fp+fn) as acc from c)
"""


def _sweep(*thresholds: float) -> str:
    return SCORED + _SWEEP.format(ts="[" + ", ".join(f"{t}::double" for t in thresholds) + "]")


_METRICS = """select threshold, tp, fp, fn, tn, round(acc, 6) as accuracy, round(pr, 6) as prec, round(rc, 6) as recall,
 round(f1v, 6) as f1 from m"""


@query("metrics_at_threshold", _sweep(0.33) + _METRICS)
def metrics_at_threshold(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metrics.metrics_at_threshold(scored_transactions(spark, sf_dir))


@query("threshold_sweep", _sweep(0.3, 0.33, 0.4, 0.5, 0.6, 0.7) + _METRICS)
def threshold_sweep(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metrics.threshold_sweep(scored_transactions(spark, sf_dir), [0.3, 0.33, 0.4, 0.5, 0.6, 0.7])


@query("confusion_matrix", _sweep(0.33) + """
select 0 as actual, 0 as predicted, tn as rows, round(tn::double/(tn+fp), 6) as share from m
union all select 0, 1, fp, round(fp::double/(tn+fp), 6) from m
union all select 1, 0, fn, round(fn::double/(fn+tp), 6) from m
union all select 1, 1, tp, round(tp::double/(fn+tp), 6) from m
""")
def confusion_matrix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metrics.confusion_matrix(scored_transactions(spark, sf_dir))


@query("classification_report", _sweep(0.33) + """
select 'Legitimate' as "class", round(pr0, 6) as prec, round(rc0, 6) as recall, round(f10, 6) as f1, tn+fp as support from m
union all select 'Fraud', round(pr, 6), round(rc, 6), round(f1v, 6), tp+fn from m
union all select 'accuracy', round(acc, 6), round(acc, 6), round(acc, 6), tp+fp+fn+tn from m
union all select 'macro avg', round((pr+pr0)/2, 6), round((rc+rc0)/2, 6), round((f1v+f10)/2, 6), tp+fp+fn+tn from m
union all select 'weighted avg', round((pr*(tp+fn)+pr0*(tn+fp))/(tp+fp+fn+tn), 6), round((rc*(tp+fn)+rc0*(tn+fp))/(tp+fp+fn+tn), 6),
 round((f1v*(tp+fn)+f10*(tn+fp))/(tp+fp+fn+tn), 6), tp+fp+fn+tn from m
""")
def classification_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metrics.classification_report(scored_transactions(spark, sf_dir))


@query("best_f1_threshold", CURVE + """
select score as threshold, round(2.0::double*tp/(tp+fp+allp), 6) as f1 from curve
order by 2.0::double*tp/(tp+fp+allp) desc, score limit 1
""")
def best_f1_threshold(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metrics.best_f1_threshold(scored_transactions(spark, sf_dir))


@query("evaluation_report", CURVE + _SWEEP.format(ts="[0.3::double, 0.33::double]") + """
select cast(null as double) as threshold, 'all' as "class", 'roc_auc' as metric,
 round(sum(p*(alln - fp + n/2.0::double))/(max(allp)::double*max(alln)::double), 4) as "value" from curve
union all select cast(null as double), 'all', 'average_precision', round(sum(p*(tp::double/(tp+fp)))/max(allp), 4) from curve
union all select threshold, 'Fraud', 'tp', tp::double from m
union all select threshold, 'Fraud', 'fp', fp::double from m
union all select threshold, 'Fraud', 'fn', fn::double from m
union all select threshold, 'Fraud', 'tn', tn::double from m
union all select threshold, 'Fraud', 'accuracy', round(acc, 4) from m
union all select threshold, 'Fraud', 'prec', round(pr, 4) from m
union all select threshold, 'Fraud', 'recall', round(rc, 4) from m
union all select threshold, 'Fraud', 'f1', round(f1v, 4) from m
""")
def evaluation_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metrics.evaluation_report(scored_transactions(spark, sf_dir), [0.3, 0.33])


@query("export_gate", CURVE + """
, a as (select round(sum(p*(alln - fp + n/2.0::double))/(max(allp)::double*max(alln)::double), 6) as roc_auc from curve)
select roc_auc, 0.95::double as minimum, roc_auc >= 0.95 as may_export from a
""")
def export_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gate(metrics.roc_auc(scored_transactions(spark, sf_dir)))
