"""Global order without a global sort: range buckets, running totals and exact quantiles.

A window without a partition key pulls every row into one task, and an exact percentile holds a whole group in one
aggregation buffer. Both are replaced by the same steps at every size: cut the value range, count what falls into each
part, work inside the parts in parallel, and add the totals of the parts before. The cut points decide only the balance
of the work; any cut points give the same answer.
"""

from __future__ import annotations

import math
from collections.abc import Callable
from functools import reduce

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ledgerlens.functions.numeric import rounded
from ledgerlens.operators.small import any_null, bounded, settled

# Rows that one task sorts; the number of buckets follows from the counted rows.
BUCKET_ROWS = 500_000
# A range of values that is cut again is cut into this many parts.
PARTS = 1024
# Parts of a factor of two in the first cut of all numbers.
OCTAVE_PARTS = 64


def cut_points(df: DataFrame, columns: list[str], buckets: int) -> list[list[float]]:
    """Bucketizer splits for each column, from one pass of mergeable quantile sketches.

    The sketch is right to half a bucket, so no bucket holds more than two buckets' rows of distinct values.
    """
    probabilities = [i / buckets for i in range(1, buckets)]
    sketched = df.stat.approxQuantile(columns, probabilities, 1 / (2 * buckets)) if probabilities else [[]] * len(columns)
    infinity = float("inf")
    return [[-infinity, *(sorted(set(found)) or [0.0]), infinity] for found in sketched]


def with_buckets(df: DataFrame, columns: list[str], outputs: list[str], buckets: int) -> DataFrame:
    """Add the range-bucket index of each column. NULLs get a bucket of their own."""
    splits = cut_points(df, columns, buckets)
    bucketizer = Bucketizer(inputCols=columns, outputCols=outputs, splitsArray=splits, handleInvalid="keep")
    return bucketizer.transform(df)


def bucket_count(rows: int) -> int:
    """Buckets that are worked on whole, for a counted number of rows."""
    return max(1, math.ceil(rows / BUCKET_ROWS))


def running_totals(
    df: DataFrame,
    order: str,
    sums: dict[str, str],
    by: list[str] | None = None,
    descending: bool = False,
    following: dict[str, str] | None = None,
    buckets: int | None = None,
) -> DataFrame:
    """Running sums in ``order``, per ``by`` group, over a table with one row per (group, order value).

    ``sums`` maps an input column to the name of its running total (the row itself included); ``following`` maps a
    column to the name of its value in the next row. The table is read several times, so it should be a written one.
    Buckets hold about ``BUCKET_ROWS`` rows; ``buckets`` names their number instead.
    """
    by, following = by or [], following or {}
    cut = with_buckets(df, [order], ["_bucket"], buckets or bucket_count(df.count()))
    direction = F.desc if descending else F.asc
    first_of = F.max_by if descending else F.min_by

    totals = cut.groupBy(*by, "_bucket").agg(
        *[F.sum(c).alias(f"_sum_{c}") for c in sums], *[first_of(c, order).alias(f"_first_{c}") for c in following]
    )
    buckets_in_order = W.partitionBy(*(by or [F.lit(0)])).orderBy(direction("_bucket"))
    before = buckets_in_order.rowsBetween(W.unboundedPreceding, -1)
    offsets = totals.select(
        *by,
        "_bucket",
        *[F.coalesce(F.sum(f"_sum_{c}").over(before), F.lit(0)).alias(f"_before_{c}") for c in sums],
        *[F.lead(f"_first_{c}").over(buckets_in_order).alias(f"_next_{c}") for c in following],
    )

    inside = W.partitionBy(*by, "_bucket").orderBy(direction(order))
    upto = inside.rowsBetween(W.unboundedPreceding, 0)
    local = cut.select(
        "*",
        *[F.sum(c).over(upto).alias(f"_inside_{c}") for c in sums],
        *[F.lead(c).over(inside).alias(f"_lead_{c}") for c in following],
    )
    return local.join(bounded(offsets), [*by, "_bucket"]).select(
        *df.columns,
        *[(F.col(f"_before_{c}") + F.col(f"_inside_{c}")).alias(out) for c, out in sums.items()],
        *[F.coalesce(f"_lead_{c}", f"_next_{c}").alias(out) for c, out in following.items()],
    )


def exact_quantiles(
    df: DataFrame,
    columns: list[str],
    probabilities: list[float],
    by: list[str] | None = None,
    buckets: int | None = None,
    approximate: bool = False,
    part_rows: int = BUCKET_ROWS,
) -> DataFrame:
    """Linearly interpolated quantiles as ``(*by, column, prob, value)``; rows with a NULL key are left out.

    The numbers are cut by their size into parts of about one per cent and counted (combined before the shuffle). Only
    the parts that hold a wanted rank are followed: one with more than ``part_rows`` rows and more than one value is cut
    again between its lowest and highest value, into ``buckets`` parts, and counted again. In the end the rows of the
    parts that are left are counted by value and ranked. A value that most rows share is one counted row throughout.
    ``approximate=True`` is the one-pass sketch.
    """
    by = by or []
    if approximate:
        numbers = df.where(~any_null(by)).select(*by, *[F.col(c).cast("double").alias(c) for c in columns])
        return _buffered(numbers, columns, probabilities, by, lambda c: F.percentile_approx(c, probabilities, 100_000))
    # Written as SQL: the plans are long, and each would else be put together by hundreds of calls to the JVM.
    spark, group = df.sparkSession, [*by, "column"]
    keys = ", ".join(f"`{c}`" for c in group)
    entries = ", ".join(f"struct('{c}' as `column`, cast(`{c}` as double) as value)" for c in columns)
    known = " and ".join(["value is not null", *[f"`{c}` is not null" for c in by]])
    long = df.selectExpr(*[f"`{c}`" for c in by], f"inline(array({entries}))").where(known)
    long = long.selectExpr("*", f"{_SIZE_PART} as part")
    counts = "count(*) as n, min(value) as low, max(value) as high"
    counted = settled(spark.sql(f"select {keys}, part, {counts} from {{long}} group by {keys}, part", long=long))
    wanted = ", ".join(f"{float(p)!r}D" for p in probabilities)
    held = settled(spark.sql(
        f"""
        with placed as (select *, sum(n) over (partition by {keys} order by part rows unbounded preceding) - n as first_rank,
          sum(n) over (partition by {keys}) as total from {{counted}}),
        ranks as (select *, prob * (total - 1) as position from placed lateral view explode(array({wanted})) as prob),
        whole as (select *, floor(position) as low_rank, ceil(position) as high_rank from ranks)
        select {keys}, part, n, low, high, first_rank, prob, position, low_rank, high_rank from whole
        where (low_rank >= first_rank and low_rank < first_rank + n) or (high_rank >= first_rank and high_rank < first_rank + n)
        """,
        counted=counted,
    ))
    held = _finer(long, held, group, buckets or PARTS, part_rows)
    return spark.sql(
        f"""
        with parts as (select distinct {keys}, part, low, high, first_rank from {{held}}),
        counts as (select {keys}, part, low, first_rank, value, count(*) as n from {{long}} join parts using ({keys}, part)
          where value between low and high group by {keys}, part, low, first_rank, value),
        ends as (select *, first_rank + sum(n) over (partition by {keys}, part, low order by value rows unbounded preceding) as stop
          from counts),
        wanted as (select distinct {keys}, part, low, prob, position, low_rank, high_rank from {{held}}),
        hit as (select *, stop - n <= low_rank and low_rank < stop as is_low from ends join wanted using ({keys}, part, low)
          where (stop - n <= low_rank and low_rank < stop) or (stop - n <= high_rank and high_rank < stop)),
        picked as (select {keys}, prob, position - low_rank as share, max(if(is_low, value, null)) as below, max(value) as above
          from hit group by {keys}, prob, position, low_rank)
        select {keys}, prob, if(share = 0, below, below + share * (above - below)) as value from picked
        """,
        held=held,
        long=long,
    )


def _finer(long: DataFrame, held: DataFrame, group: list[str], buckets: int, part_rows: int) -> DataFrame:
    """Cut the wide ones of the held parts until none has more than ``part_rows`` rows and more than one value."""
    wide = (F.col("n") > part_rows) & (F.col("low") < F.col("high"))
    ranks = held.select(*group, "prob", "position", "low_rank", "high_rank").distinct()
    while not held.where(wide).isEmpty():
        cut_again = held.where(wide).select(*group, "part", "low", "high", "first_rank").distinct()
        inside = _inside(long, cut_again, group)
        share = (F.col("value") - F.col("low")) / (F.col("high") - F.col("low"))
        cell = F.least(F.floor(share * buckets), F.lit(buckets - 1))
        cut = inside.groupBy(*group, "part", "low", "first_rank", cell.alias("cell")).agg(*_extent("cell_low", "cell_high"))
        cut = cut.select(*group, "part", "low", "first_rank", "cell", "n", "cell_low", "cell_high")
        finer = _holding(cut, ranks, group, ["part", "low", "cell"], ["part", "low"])
        finer = finer.withColumns({"low": F.col("cell_low"), "high": F.col("cell_high")})
        held = settled(held.where(~wide).unionByName(finer.select(*held.columns)))
    return held


# A whole number that never falls as the value grows: its sign and the size of its logarithm.
_TOP = 2200 * OCTAVE_PARTS
_SIZE = f"if(abs(value) = double('infinity'), {_TOP}L, floor(log2(abs(value)) * {OCTAVE_PARTS}) + {1100 * OCTAVE_PARTS})"
_SIZE_PART = f"cast(case when isnan(value) then {_TOP + 1} when value = 0 then 0 when value > 0 then {_SIZE} else -{_SIZE} end as int)"


def _extent(low: str = "low", high: str = "high") -> list[Column]:
    return [F.count("*").alias("n"), F.min("value").alias(low), F.max("value").alias(high)]


def _holding(
    parts: DataFrame, ranks: DataFrame, group: list[str], order: list[str], inside: list[str] | None = None
) -> DataFrame:
    """The parts that hold a wanted rank, once for each such rank, with ``first_rank`` moved to their own first row.

    ``parts`` are counted rows (n, first_rank of what was cut); ``inside`` names what was cut, apart from the group.
    """
    before = W.partitionBy(*group, *(inside or [])).orderBy(*order).rowsBetween(W.unboundedPreceding, 0)
    placed = parts.withColumn("first_rank", F.col("first_rank") + F.sum("n").over(before) - F.col("n"))
    end = F.col("first_rank") + F.col("n")
    hit = ((F.col("low_rank") >= F.col("first_rank")) & (F.col("low_rank") < end)) | (
        (F.col("high_rank") >= F.col("first_rank")) & (F.col("high_rank") < end)
    )
    return placed.join(ranks, group).where(hit)


def _inside(long: DataFrame, held: DataFrame, group: list[str]) -> DataFrame:
    """The rows of held parts."""
    return long.join(held, [*group, "part"]).where(F.col("value").between(F.col("low"), F.col("high")))


def _buffered(
    numbers: DataFrame, columns: list[str], probabilities: list[float], by: list[str], quantiles: Callable[[str], Column]
) -> DataFrame:
    """One aggregation that keeps a buffer for each group and column."""
    arrays = numbers.groupBy(*by).agg(*[quantiles(c).alias(c) for c in columns])
    entries = [
        F.struct(F.lit(c).alias("column"), F.lit(float(p)).alias("prob"), F.col(c)[i].alias("value"))
        for c in columns
        for i, p in enumerate(probabilities)
    ]
    return arrays.select(*by, F.inline(F.array(*entries))).where(F.col("value").isNotNull())


def wide_quantiles(
    df: DataFrame, column: str, names: dict[str, float], by: list[str] | None = None, **options
) -> DataFrame:
    """Quantiles of one column, one named column per probability: ``(*by, *names)``."""
    by = by or []
    long = exact_quantiles(df, [column], list(names.values()), by, **options)
    return long.groupBy(*by).agg(
        *[F.max(F.when(F.col("prob") == F.lit(float(p)), F.col("value"))).alias(n) for n, p in names.items()]
    )


def describe(df: DataFrame, columns: list[str], by: list[str] | None = None, digits: int = 4) -> DataFrame:
    """Count, mean, sample deviation, minimum, quartiles and maximum: ``(*by, column, ...)``, one row a column."""
    by = by or []
    entries = [F.struct(F.lit(c).alias("column"), F.col(c).cast("double").alias("value")) for c in columns]
    long = df.where(~any_null(by)).select(*by, F.inline(F.array(*entries)))
    moments = long.groupBy(*by, "column").agg(
        F.count("value").alias("count"),
        F.avg("value").alias("mean"),
        F.stddev_samp("value").alias("std"),
        F.min("value").alias("min"),
        F.max("value").alias("max"),
    )
    names = {"p25": 0.25, "p50": 0.5, "p75": 0.75}
    quartiles = (
        exact_quantiles(df, columns, list(names.values()), by)
        .groupBy(*by, "column")
        .agg(*[F.max(F.when(F.col("prob") == p, F.col("value"))).alias(n) for n, p in names.items()])
    )
    order = ["mean", "std", "min", *names, "max"]
    return moments.join(quartiles, [*by, "column"], "left").select(
        *by, "column", "count", *[rounded(F.col(c), digits).alias(c) for c in order]
    )


def band_edges(df: DataFrame, column: str, bands: int) -> DataFrame:
    """One row with ``edges``, the ascending limits of equal-frequency bands; equal ones are merged."""
    found = exact_quantiles(df, [column], [i / bands for i in range(bands + 1)])
    return found.agg(F.array_sort(F.array_distinct(F.collect_list("value"))).alias("edges"))


def band_of(column: str, edges: Column) -> Column:
    """The band of a value, from 0. Values beyond the outer edges belong to the outer bands."""
    above = F.size(F.filter(edges, lambda edge: edge < F.col(column)))
    inside = F.least(F.greatest(F.lit(0), above - 1), F.greatest(F.lit(0), F.size(edges) - 2))
    return F.when(F.col(column).isNotNull(), inside)


def quantile_bands(df: DataFrame, column: str, bands: int) -> DataFrame:
    """Equal-frequency bands: adds ``band`` (from 0), ``band_low`` and ``band_high``.

    Bands are closed on the right, the lowest also on the left, and equal edges are merged, so there can be fewer
    than ``bands``.
    """
    placed = df.withColumn("_edges", band_edges(df, column, bands).scalar())
    placed = placed.withColumn("band", band_of(column, F.col("_edges")))
    return placed.select(
        *df.columns, "band", F.get("_edges", F.col("band")).alias("band_low"), F.get("_edges", F.col("band") + 1).alias("band_high")
    )


def union_all(parts: list[DataFrame]) -> DataFrame:
    return reduce(lambda left, right: left.unionByName(right), parts)


def numbered(
    df: DataFrame, key: str, by: list[str] | None = None, seed: int = 42, buckets: int | None = None
) -> DataFrame:
    """Number the rows 1..n in ``row_number``, per ``by`` group, by a hash of their unique ``key``.

    The hash spreads the rows evenly, so each bucket is numbered in parallel and shifted by the counts before it.
    """
    by = by or []
    spread = df.withColumn("_bucket", F.pmod(F.xxhash64(key, F.lit(seed)), F.lit(buckets or bucket_count(df.count()))))
    before = W.partitionBy(*(by or [F.lit(0)])).orderBy("_bucket").rowsBetween(W.unboundedPreceding, -1)
    offsets = (
        spread.groupBy(*by, "_bucket")
        .agg(F.count("*").alias("_n"))
        .select(*by, "_bucket", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    )
    inside = spread.withColumn("_inside", F.row_number().over(W.partitionBy(*by, "_bucket").orderBy(key)))
    return inside.join(bounded(offsets), [*by, "_bucket"]).select(
        *df.columns, (F.col("_before") + F.col("_inside")).alias("row_number")
    )
