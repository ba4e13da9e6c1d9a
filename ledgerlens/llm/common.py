"""Small helpers shared by the text operators."""

from __future__ import annotations

import string
import zipfile
from pathlib import Path

from pyspark import SparkFiles
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

LONG_MAX = 2**63 - 1


def ascii_lower(column: Column | str) -> Column:
    """Lower-case A-Z and nothing else."""
    return F.translate(column, string.ascii_uppercase, string.ascii_lowercase)


def fresh(df: DataFrame, *names: str) -> list[str]:
    """Column names that do not clash with those of ``df``."""
    taken = {c.lower() for c in df.columns}
    out = []
    for name in names:
        while name.lower() in taken:
            name = f"_{name}"
        taken.add(name.lower())
        out.append(name)
    return out


def whole_text(column: str = "text") -> Column:
    """A text column with null as the empty text."""
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


def text_key(column: str = "text") -> list[Column]:
    """Two 64-bit hashes that stand for a text when its row is looked up again."""
    text = whole_text(column)
    return [F.xxhash64(text).alias("t1"), F.xxhash64(F.lit(7), text).alias("t2")]


def bounded_batches(spark: SparkSession) -> None:
    """Hand rows to Python in batches of 8 MB where the session has the default of 64 MB.

    Texts and shingle sets are wide rows, and every core of an executor holds a batch on both sides of the pipe.
    """
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    if spark.conf.get(name) in ("64MB", "64m", "67108864", "67108864b"):
        spark.conf.set(name, "8m")


def ship_package(spark: SparkSession) -> None:
    """Send this package to the executors, once a context, so that they need no copy of their own."""
    sc = spark.sparkContext
    if getattr(sc, "_ledgerlens_shipped", False):
        return
    root = Path(__file__).resolve().parents[1]
    folder = Path(SparkFiles.getRootDirectory()) / "package"
    folder.mkdir(parents=True, exist_ok=True)
    target = folder / f"{root.name}.zip"
    with zipfile.ZipFile(target, "w", zipfile.ZIP_DEFLATED) as packed:
        for path in sorted(root.rglob("*.py")):
            packed.write(path, path.relative_to(root.parent))
    sc.addPyFile(str(target))
    sc._ledgerlens_shipped = True
