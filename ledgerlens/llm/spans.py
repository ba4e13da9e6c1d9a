"""Taking byte spans out of texts."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

SPANS = T.ArrayType(T.StructType([T.StructField("begin", T.LongType()), T.StructField("end", T.LongType())]))
ARROW_SPANS = pa.list_(pa.struct([("begin", pa.int64()), ("end", pa.int64())]))


def merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Spans in order, with those that overlap or touch made one."""
    out: list[tuple[int, int]] = []
    for begin, end in sorted(spans):
        if out and begin <= out[-1][1]:
            out[-1] = (out[-1][0], max(end, out[-1][1]))
        else:
            out.append((begin, end))
    return out


def remaining(raw: bytes, spans: list[tuple[int, int]]) -> bytes:
    parts, at = [], 0
    for begin, end in spans:
        parts.append(raw[at:begin])
        at = end
    return b"".join([*parts, raw[at:]])


def cut_texts(rows: DataFrame, with_text: bool = False) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 and, if asked for, the bytes ``kept_text``.

    ``rows`` has doc_id, text and ``cut``, a list of (begin, end) byte spans in any order, or null; columns after
    those follow at the end.
    """
    rest = rows.columns[3:]
    out = [rows.schema["doc_id"], *[T.StructField(n, T.LongType()) for n in ("n_bytes", "n_removed", "n_spans")]]
    out += [T.StructField("kept_sha256", T.StringType())] + [T.StructField("kept_text", T.BinaryType())] * with_text
    schema = T.StructType([*out, *[rows.schema[c] for c in rest]])

    def taken(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, removed, counts, digests, texts = [], [], [], [], []
            for text, cut in zip(batch.column(1), batch.column(2), strict=True):
                raw = text.as_py().encode("utf-8")
                spans = merged([(s["begin"], s["end"]) for s in cut.as_py() or []])
                left = remaining(raw, spans) if spans else raw
                sizes.append(len(raw))
                removed.append(len(raw) - len(left))
                counts.append(len(spans))
                digests.append(hashlib.sha256(left).hexdigest())
                texts.append(left if with_text else b"")
            columns = [batch.column(0), *[pa.array(x, pa.int64()) for x in (sizes, removed, counts)]]
            columns += [pa.array(digests, pa.string())] + [pa.array(texts, pa.binary())] * with_text
            columns += [batch.column(3 + i) for i in range(len(rest))]
            yield pa.RecordBatch.from_arrays(columns, schema.names)

    return rows.select("doc_id", "text", F.col("cut").cast(SPANS).alias("cut"), *rest).mapInArrow(taken, schema)
