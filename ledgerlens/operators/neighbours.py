"""Exact nearest neighbours within one table, without comparing all pairs.

1. Rows with the same vector are copies. Only the ``k + 1`` lowest ids of each vector can ever be a neighbour (the
   rest are farther or tie with a higher id), so a vector that half the rows share becomes one point.
2. A hash sample of the points gives a balanced tree of median cuts, level by level, as tables of one row a node; each
   point falls into one leaf. Leaves hold a bounded number of distinct points.
3. Inside its leaf each point finds its nearest, and with them the radius no true neighbour can exceed.
4. A point walks down the tree past the nodes' boxes and visits only the leaves that reach into that radius:
   the box of the vectors must, and for each of a few pivots so must the range of the distances to the pivot (by the
   triangle inequality a neighbour's distance to a pivot differs by no more than the radius). Visitors of a leaf are
   split into chunks, so a leaf everyone visits is many tasks.

The answer does not depend on the tree or the pivots: bad ones cost visits, not neighbours. Cuts and boxes are written
tables that grow with the points. Boxes are counted: up to ``SENT_BOXES`` they are sent to all tasks, which walk down for a
batch of points at once; beyond that the walk is a join a level. As soon as there are several leaves, work is dealt by leaves
and counted visits, since a shuffle of few bytes would else be left to a task or two.
"""

from __future__ import annotations

import math
import sys
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ledgerlens.operators.small import settled

# The task functions below travel with the job, so executors need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

LEAF_POINTS = 2048
SAMPLE_PER_LEAF = 16
VISIT_CHUNK = 4096
DIGITS = 6
SLACK = 1e-5
# Boxes that are sent to all tasks (of 21 dimensions: 20 MB), and (point, node) pairs that are tested at once.
SENT_BOXES = 50_000
PAIRS = 1 << 15
# Visits that one task answers.
TASK_VISITS = 40_000


def nearest_neighbours(
    df: DataFrame, key: str, vector: str, k: int, leaf_points: int = LEAF_POINTS, chunk: int = VISIT_CHUNK
) -> DataFrame:
    """``(key, rank, neighbour, distance)``: the ``k`` nearest other rows of each row, ties by lower id.

    Distances are Euclidean, rounded to six decimals before they are compared. ``key`` is a unique string. A row has
    fewer than ``k`` neighbours only if the table is smaller than that.
    """
    lists = neighbour_lists(df, key, vector, k, leaf_points, chunk)
    return lists.select(key, F.posexplode("near").alias("_pos", "_entry")).select(
        key,
        (F.col("_pos") + 1).alias("rank"),
        F.col("_entry.id").alias("neighbour"),
        F.col("_entry.distance").alias("distance"),
    )


def neighbour_lists(
    df: DataFrame, key: str, vector: str, k: int, leaf_points: int = LEAF_POINTS, chunk: int = VISIT_CHUNK
) -> DataFrame:
    """``(key, near)``: the neighbours of each row as one list of (distance, id), nearest first."""
    rows = df.select(F.col(key).cast("string").alias("_id"), F.col(vector).alias("vec"))
    lowest = W.partitionBy("vec").orderBy("_id")
    points = settled(
        rows.select("*", F.row_number().over(lowest).alias("rn"))
        .where(F.col("rn") <= k + 1)
        .groupBy("vec")
        .agg(F.array_sort(F.collect_list("_id")).alias("ids"))
        .select(F.get("ids", F.lit(0)).alias("pid"), "vec", "ids")
    )
    found = _nearest_points(points, k + 1, leaf_points, chunk)
    # Near lists are matched to points first, so copies of a hot vector meet one join, not two.
    listed = rows.join(points.join(found, "pid").select("vec", "near"), "vec")
    others = F.slice(F.filter("near", lambda entry: entry["id"] != F.col("_id")), 1, k)
    return listed.select(F.col("_id").alias(key), others.alias("near"))


def _nearest_points(points: DataFrame, k: int, leaf_points: int, chunk: int) -> DataFrame:
    """``(pid, near)``: the ``k`` lowest (distance, id) entries around each point, its own copies included."""
    count = points.count()
    depth = max(0, math.ceil(math.log2(max(1, count) / leaf_points)))
    near_type = "array<struct<distance:double,id:string>>"
    inside_schema = f"leaf int, pid string, vec array<double>, radius double, near {near_type}"
    placed = _placed(points, count, depth)

    def inside(pdf: pd.DataFrame) -> pd.DataFrame:
        near, radius = _scan(np.stack(pdf["vec"]), None, np.stack(pdf["vec"]), list(pdf["ids"]), k)
        return pd.DataFrame(
            {"leaf": pdf["leaf"], "pid": pdf["pid"], "vec": pdf["vec"], "radius": radius, "near": near}
        )

    placed = settled(placed)
    dealt = placed.repartition(2**depth, "leaf") if depth else placed
    local = settled(dealt.groupBy("leaf").applyInPandas(inside, inside_schema))
    asked = settled(_visits(local, placed, depth))
    chunks = asked.groupBy("leaf").agg(F.ceil(F.count("*") / chunk).cast("int").alias("chunks"))
    visitors = asked.join(chunks, "leaf").withColumn(
        "part", F.pmod(F.xxhash64("pid"), F.col("chunks")).cast("int")
    ).select("leaf", "part", "pid", "vec", "radius")
    hosts = placed.join(chunks, "leaf").select(
        "leaf", "vec", "ids", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)).alias("part")
    )

    def meet(guests: pd.DataFrame, owners: pd.DataFrame) -> pd.DataFrame:
        if len(guests) == 0 or len(owners) == 0:
            return pd.DataFrame({"pid": [], "near": []})
        near, _ = _scan(
            np.stack(guests["vec"]), guests["radius"].to_numpy(), np.stack(owners["vec"]), list(owners["ids"]), k
        )
        met = np.array([bool(entries) for entries in near])
        found = pd.Series([entries for entries in near if entries], dtype=object)
        return pd.DataFrame({"pid": guests["pid"].to_numpy()[met], "near": found})

    if depth:
        tasks = max(1, math.ceil(asked.count() / TASK_VISITS))
        visitors, hosts = (side.repartition(tasks, "leaf", "part") for side in (visitors, hosts))
    abroad = (
        visitors.groupBy("leaf", "part")
        .cogroup(hosts.groupBy("leaf", "part"))
        .applyInPandas(meet, f"pid string, near {near_type}")
    )
    everything = local.select("pid", "near").unionByName(abroad)
    return everything.groupBy("pid").agg(
        F.slice(F.array_sort(F.flatten(F.collect_list("near"))), 1, k).alias("near")
    )


def _placed(points: DataFrame, count: int, depth: int) -> DataFrame:
    """Add the leaf of each point. Each level of the tree is a table (node, dim, cut) from the sampled points."""
    share = min(1.0, SAMPLE_PER_LEAF * 2**depth / max(1, count))
    below = F.pmod(F.xxhash64("pid"), F.lit(2**31)) < F.lit(int(share * 2**31))
    sample = settled(points.where(below).select("vec", F.lit(0).cast("long").alias("node")))
    placed = points.withColumn("node", F.lit(0).cast("long"))
    for _ in range(depth):
        cuts = settled(_median_cuts(sample))
        sample = settled(_descended(sample, cuts))
        placed = _descended(placed, cuts)
    return placed.withColumn("leaf", (F.col("node") - (2**depth - 1)).cast("int")).drop("node")


def _median_cuts(sample: DataFrame) -> DataFrame:
    """(node, dim, cut): the median of the widest dimension, of those that the median cuts best."""
    long = sample.selectExpr("node", "posexplode(vec) as (dim, x)").groupBy("node", "dim")
    spread = long.agg(
        F.expr("percentile_approx(x, array(0.5D, 0.75D), 200)").alias("q"), F.max("x").alias("top"), F.stddev_pop("x").alias("spread")
    )
    even = "case when q[1] > q[0] then 2 when top > q[0] then 1 else 0 end"
    best = spread.groupBy("node").agg(F.expr(f"max_by(struct(dim, q[0] as cut), struct({even}, spread, dim))").alias("best"))
    return best.select("node", "best.dim", "best.cut")


def _descended(rows: DataFrame, cuts: DataFrame) -> DataFrame:
    """Rows moved to a child of their node; where no sampled point was, to the left one."""
    right = F.coalesce(F.expr("vec[dim] > cut"), F.lit(False)).cast("int")
    moved = rows.join(cuts, "node", "left").withColumn("node", 2 * F.col("node") + 1 + right)
    return moved.select(*[c for c in rows.columns if c != "node"], "node")


def _gap(low: str, high: str, at: str) -> str:
    """How far each coordinate lies outside a box, as SQL."""
    under = f"zip_with({low}, {at}, (l, x) -> greatest(l - x, 0D))"
    return f"zip_with({under}, zip_with({at}, {high}, (x, h) -> greatest(x - h, 0D)), (a, b) -> a + b)"


def _distances(pivots: str) -> str:
    """The distances of ``vec`` to each pivot, as SQL."""
    square = "aggregate(zip_with(vec, p, (x, y) -> (x - y) * (x - y)), 0D, (s, x) -> s + x)"
    return f"transform({pivots}, p -> sqrt({square}))"


def _visits(local: DataFrame, placed: DataFrame, depth: int) -> DataFrame:
    """(pid, vec, radius, leaf): the leaves other than its own that a point has to look into."""
    # Pivots: one point each from the ends of the longest and shortest vectors, and of two ids; any points would do.
    norm = "aggregate(vec, 0D, (s, x) -> s + x * x)"
    ends = [f"max_by(vec, {norm})", f"min_by(vec, {norm})", "max_by(vec, xxhash64(pid))", "min_by(vec, xxhash64(pid))"]
    chosen = settled(placed.selectExpr(f"array({', '.join(ends)}) as pivots"))
    known = placed.withColumn("_p", chosen.select("pivots").scalar()).selectExpr("leaf", "vec", f"{_distances('_p')} as far")
    steps = ", ".join(f"{2 ** (depth - up) - 1} + shiftright(leaf, {up})" for up in range(depth + 1))
    # A leaf's extent counts for all nodes above it; both kinds of coordinates go through one aggregation.
    extent = known.selectExpr("leaf", "posexplode(concat(vec, far)) as (dim, x)").groupBy("leaf", "dim")
    extent = extent.agg(F.min("x").alias("low"), F.max("x").alias("high"))
    nodes = extent.selectExpr(f"explode(array({steps})) as node", "dim", "low", "high").groupBy("node", "dim")
    sides = nodes.agg(F.min("low").alias("low"), F.max("high").alias("high")).groupBy("node")
    boxes = sides.agg(F.array_sort(F.collect_list(F.struct("dim", "low", "high"))).alias("b"))
    boxes = settled(boxes.selectExpr("node", "b.low as low", "b.high as high"))
    if boxes.count() <= SENT_BOXES:
        return _walked(local, boxes, chosen, depth)
    at = local.withColumn("_p", chosen.select("pivots").scalar()).selectExpr(
        "pid", "vec", "radius", "leaf as own", f"concat(vec, {_distances('_p')}) as at", "size(vec) as width", "0 as node"
    )
    for level in range(depth + 1):
        gaps = at.join(boxes, "node").selectExpr(*at.columns, f"{_gap('low', 'high', 'at')} as gap")
        vectors = "sqrt(aggregate(slice(gap, 1, width), 0D, (s, x) -> s + x * x))"
        near = gaps.where(f"{vectors} <= radius + {SLACK}D and array_max(slice(gap, width + 1, 4)) <= radius + {SLACK}D")
        at = near.select(*at.columns)
        if level < depth:
            rest = [c for c in at.columns if c != "node"]
            at = at.selectExpr(*rest, "explode(array(2 * node + 1, 2 * node + 2)) as node")
    visited = at.selectExpr("pid", "vec", "radius", "own", f"cast(node - {2**depth - 1} as int) as leaf")
    return visited.where("leaf <> own").drop("own")


def _walked(local: DataFrame, boxes: DataFrame, chosen: DataFrame, depth: int) -> DataFrame:
    """(pid, vec, radius, leaf) as in :func:`_visits`, by tasks that hold all boxes."""
    pivots = np.array([list(p) for p in chosen.first()["pivots"]])
    low = np.full((2 ** (depth + 1) - 1, pivots.shape[1] + len(pivots)), np.nan)  # a node without points is never near
    high = low.copy()
    for row in boxes.collect():
        low[row["node"]], high[row["node"]] = row["low"], row["high"]
    sent = local.sparkSession.sparkContext.broadcast((pivots, low, high))

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pivots, low, high = sent.value
        width = pivots.shape[1]
        for batch in batches:
            vectors = np.asarray(batch.column(1).flatten(), dtype=float).reshape(batch.num_rows, -1)
            own, reach = np.asarray(batch.column(3)), np.asarray(batch.column(2)) + SLACK
            far = np.sqrt(((vectors[:, None] - pivots) ** 2).sum(axis=2))
            at = np.hstack([vectors, far])
            point, node = np.arange(len(at)), np.zeros(len(at), dtype=np.int64)
            for level in range(depth + 1):
                near = []
                for start in range(0, len(point), PAIRS):
                    p, n = point[start : start + PAIRS], node[start : start + PAIRS]
                    gap = np.maximum(np.maximum(low[n] - at[p], at[p] - high[n]), 0.0)
                    apart = np.sqrt((gap[:, :width] ** 2).sum(axis=1))
                    near.append((apart <= reach[p]) & (gap[:, width:].max(axis=1) <= reach[p]))
                kept = np.concatenate(near) if near else np.zeros(0, bool)
                point, node = point[kept], node[kept]
                if level < depth:
                    point, node = np.repeat(point, 2), np.column_stack([2 * node + 1, 2 * node + 2]).ravel()
            leaf = (node - (2**depth - 1)).astype(np.int32)
            point, leaf = point[leaf != own[point]], leaf[leaf != own[point]]
            for start in range(0, len(point), PAIRS):
                some = batch.select([0, 1, 2]).take(pa.array(point[start : start + PAIRS]))
                yield pa.RecordBatch.from_arrays([*some.columns, pa.array(leaf[start : start + PAIRS])], ["pid", "vec", "radius", "leaf"])

    return local.select("pid", "vec", "radius", "leaf").mapInArrow(walk, "pid string, vec array<double>, radius double, leaf int")


def _scan(queries: np.ndarray, radius: np.ndarray | None, owners: np.ndarray, ids: list, k: int) -> tuple[list, list]:
    """Lowest ``k`` (distance, id) entries of each query among the owners, and the distance of the last.

    Works in blocks of queries of some megabytes. A matrix product gives distances good enough to rule most owners out;
    the exact ones are taken of the few that may count. A radius already says which may.
    """
    sizes = np.array([len(entry) for entry in ids])
    starts = np.concatenate([[0], np.cumsum(sizes)[:-1]])
    flat = np.array([name for entry in ids for name in entry], dtype=object)
    id_rank = np.empty(len(flat), dtype=np.int64)
    id_rank[np.argsort(flat.astype(str), kind="stable")] = np.arange(len(flat))

    centre = owners.mean(axis=0)
    owned, asked = owners - centre, queries - centre
    owned_sq, asked_sq = (owned**2).sum(axis=1), (asked**2).sum(axis=1)
    fuzz = 1e-9 * (1.0 + owned_sq.max() + asked_sq.max())
    step = max(1, 500_000 // len(owners))
    twice = np.ascontiguousarray(-2.0 * owned.T)
    near: list = []
    last: list = []
    for start in range(0, len(queries), step):
        block = slice(start, start + step)
        # Squared distances less the square of the query, which is the same for all owners.
        rough = asked[block] @ twice
        rough += owned_sq
        if radius is not None:
            bound = radius[block]
        elif len(owners) > k:
            bound = np.sqrt(np.maximum(0.0, np.partition(rough, k - 1, axis=1)[:, k - 1] + asked_sq[block]))
        else:
            bound = np.full(len(rough), np.inf)
        row, owner = np.nonzero(rough <= ((bound + SLACK) ** 2 + fuzz - asked_sq[block])[:, None])
        distance = np.round(np.sqrt(((queries[block][row] - owners[owner]) ** 2).sum(axis=1)), DIGITS)

        count = sizes[owner]
        row, distance = np.repeat(row, count), np.repeat(distance, count)
        entry = np.repeat(starts[owner], count) + np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
        order = np.lexsort((id_rank[entry], distance, row))
        row, distance, entry = row[order], distance[order], entry[order]
        first = np.searchsorted(row, np.arange(len(rough)))
        end = np.minimum(np.searchsorted(row, np.arange(len(rough)), side="right"), first + k)
        for low, high in zip(first, end):
            near.append([{"distance": float(distance[j]), "id": flat[entry[j]]} for j in range(low, high)])
            last.append(float(distance[high - 1]) if high - low == k else float("inf"))
    return near, last
