"""Language identification by a convolutional network over bytes, written and trained in numpy.

A text is cut into windows of fixed length, the last one padded with zeros. Bytes are embedded, filters of several
widths slide over the window, the largest response of each filter is kept, and a softmax layer turns those into
language probabilities. A document gets the mean of its windows' probabilities, weighted by their bytes.

The network is fitted on the driver from a bounded sample (about ``fit_rows`` different labelled texts of each language,
chosen by a hash of the text, one window each); prediction covers every byte of every document in batches of windows.

Defined results: a text that is null or has no letter is ``und`` with score 0; so is everything if there is nothing
to learn from; with one language in the labels all other texts get it. Labels that are null are not learnt from.
Rows pass one by one, so repeated rows and null ids are kept; an empty table gives an empty table.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlens.llm.common import fresh, whole_text
from ledgerlens.operators.small import bounded

WINDOW = 256
EMBEDDING = 8
WIDTHS = (2, 3, 4)
FILTERS = 12
FIT_ROWS = 1500
EPOCHS = 6
BATCH = 64
CHUNK = 256
UNKNOWN = "und"
MIN_SCORE = 0.5


@dataclass
class ByteCnn:
    """Weights of a fitted network."""

    languages: list[str]
    embedding: np.ndarray
    filters: list[np.ndarray]
    biases: list[np.ndarray]
    dense: np.ndarray
    dense_bias: np.ndarray

    def _pooled(self, windows: np.ndarray) -> tuple[np.ndarray, list[np.ndarray], list[np.ndarray]]:
        embedded = self.embedding[windows]
        n, length, size = embedded.shape
        kept, places, views = [], [], []
        for weight, bias in zip(self.filters, self.biases, strict=True):
            width = weight.shape[0] // size
            s0, s1, s2 = embedded.strides
            view = np.lib.stride_tricks.as_strided(embedded, (n, length - width + 1, width * size), (s0, s1, s2))
            response = view.reshape(-1, width * size) @ weight
            response = response.reshape(n, length - width + 1, -1)
            at = response.argmax(axis=1)
            kept.append(np.take_along_axis(response, at[:, None, :], axis=1)[:, 0] + bias)
            places.append(at)
            views.append(view)
        return np.concatenate(kept, axis=1), places, views

    def probabilities(self, windows: np.ndarray) -> np.ndarray:
        """Language probabilities of each window (rows of WINDOW byte values)."""
        out = []
        for begin in range(0, len(windows), CHUNK):
            pooled, _, _ = self._pooled(windows[begin : begin + CHUNK])
            out.append(_softmax(np.maximum(pooled, 0) @ self.dense + self.dense_bias))
        return np.concatenate(out) if out else np.zeros((0, len(self.languages)), np.float32)

    def step(self, windows: np.ndarray, wanted: np.ndarray) -> list[np.ndarray]:
        """Gradients of the mean cross-entropy, in the order of ``parameters``."""
        pooled, places, views = self._pooled(windows)
        active = np.maximum(pooled, 0)
        n = len(windows)
        slope = _softmax(active @ self.dense + self.dense_bias)
        slope[np.arange(n), wanted] -= 1
        slope /= n
        grads = [active.T @ slope, slope.sum(axis=0)]
        back = (slope @ self.dense.T) * (pooled > 0)
        embedding = np.zeros_like(self.embedding)
        size = embedding.shape[1]
        at = 0
        rows = np.arange(n)[:, None]
        for weight, bias, place, view in zip(self.filters, self.biases, places, views, strict=True):
            own = back[:, at : at + len(bias)]
            at += len(bias)
            seen = view[rows, place]  # the stretch each filter responded to most
            grads.append(np.einsum("nfk,nf->kf", seen, own))
            grads.append(own.sum(axis=0))
            for offset in range(weight.shape[0] // size):
                part = own[:, :, None] * weight[offset * size : (offset + 1) * size].T[None]
                np.add.at(embedding, windows[rows, place + offset], part)
        return [*grads, embedding]

    def parameters(self) -> list[np.ndarray]:
        pairs = [p for pair in zip(self.filters, self.biases, strict=True) for p in pair]
        return [self.dense, self.dense_bias, *pairs, self.embedding]


def _softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def to_windows(raw: bytes, length: int = WINDOW) -> np.ndarray:
    """The bytes of a text as rows of fixed length, the last one padded with zeros."""
    n = max(1, -(-len(raw) // length))
    return np.frombuffer(raw.ljust(n * length, b"\0"), dtype=np.uint8).reshape(n, length)


def train(windows: np.ndarray, labels: list[str], epochs: int = EPOCHS, seed: int = 11) -> ByteCnn:
    """Fit by Adam on shuffled batches; the same input gives the same network."""
    rng = np.random.default_rng(seed)
    languages = sorted(set(labels))
    wanted = np.array([languages.index(x) for x in labels])

    def normal(*shape: int, fan: int) -> np.ndarray:
        return (rng.standard_normal(shape) / np.sqrt(fan)).astype(np.float32)

    net = ByteCnn(
        languages,
        normal(256, EMBEDDING, fan=4),
        [normal(w * EMBEDDING, FILTERS, fan=w * EMBEDDING) for w in WIDTHS],
        [np.zeros(FILTERS, np.float32) for _ in WIDTHS],
        normal(FILTERS * len(WIDTHS), len(languages), fan=FILTERS * len(WIDTHS)),
        np.zeros(len(languages), np.float32),
    )
    moments = [(np.zeros_like(p), np.zeros_like(p)) for p in net.parameters()]
    t = 0
    for _ in range(epochs):
        order = rng.permutation(len(windows))
        for begin in range(0, len(order), BATCH):
            part = order[begin : begin + BATCH]
            t += 1
            for p, g, (m, v) in zip(net.parameters(), net.step(windows[part], wanted[part]), moments, strict=True):
                m += 0.1 * (g - m)
                v += 0.001 * (g * g - v)
                p -= 0.004 * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.999**t)) + 1e-8)
    return net


def fit(labelled: DataFrame, fit_rows: int = FIT_ROWS, epochs: int = EPOCHS) -> ByteCnn | None:
    """Fit on about ``fit_rows`` different texts of each language, however many there are; None if there are none.

    ``labelled`` has text and lang. The sample, bounded by ``fit_rows`` times the languages, is a threshold on a hash of
    the text, so no group is sorted; the share counts different texts, so a language of few texts with many copies gives
    all of them.
    """
    usable = labelled.where(F.col("lang").isNotNull() & whole_text().rlike(r"\p{L}")).select("text", "lang")
    # Copies are combined before the shuffle.
    different = usable.select("lang", F.xxhash64(F.lit(3), "text").alias("text_hash")).distinct()
    shares = different.groupBy("lang").agg(F.least(F.lit(1.0), F.lit(float(fit_rows)) / F.count("*")).alias("share"))
    shares = bounded(shares)
    languages = shares.count()
    if not languages:
        return None
    position = F.pmod(F.xxhash64(F.lit(3), "text"), F.lit(1_000_003)) / 1_000_003.0
    # One window of each document, from a place that its hash chooses; four bytes a character at most.
    starts = F.pmod(F.xxhash64(F.lit(5), "text"), F.greatest(F.lit(1), F.length("text") - WINDOW)).cast("int")
    chosen = usable.join(shares, "lang").where(position < F.col("share")).select("lang", F.substr("text", starts + 1, F.lit(WINDOW)).alias("part"))
    chosen = chosen.distinct()  # copies teach once
    rows = sorted(tuple(r) for r in chosen.limit(2 * fit_rows * languages).collect())
    if not rows:
        return None
    return train(np.concatenate([to_windows(p.encode("utf-8")[:WINDOW]) for _, p in rows]), [lang for lang, _ in rows], epochs)


def held_out(doc_id: str = "doc_id") -> Column:
    """Documents that are never learnt from: crc32 of the id as text leaves 2 when divided by 4."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 4 == 2, F.lit(False))


def predict(docs: DataFrame, net: ByteCnn | None, names: tuple[str, str] = ("lang_pred", "score")) -> DataFrame:
    """``docs`` with the language and its probability in two more columns."""
    lang, score = names
    if net is None:
        return docs.withColumns({lang: F.lit(UNKNOWN), score: F.lit(0.0)})
    shared = docs.sparkSession.sparkContext.broadcast(net)  # some ten thousand weights
    letters = fresh(docs, "has_letters")[0]
    schema = T.StructType([*docs.schema, T.StructField(lang, T.StringType()), T.StructField(score, T.DoubleType())])
    text_at = docs.columns.index("text")

    def label(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        network = shared.value
        for batch in batches:
            lettered = batch.column(len(schema) - 2).to_pylist()
            langs, scores = [UNKNOWN] * len(lettered), [0.0] * len(lettered)
            waiting, owners, sizes, held = [], [], [], 0

            def flush() -> None:
                if not waiting:
                    return
                found = network.probabilities(np.concatenate(waiting))
                starts = np.concatenate([[0], np.cumsum([len(w) for w in waiting])[:-1]]).astype(np.int64)
                weights = np.concatenate(sizes)
                means = np.add.reduceat(found * weights[:, None], starts) / np.add.reduceat(weights, starts)[:, None]
                best = means.argmax(axis=1)
                for row, k, mean in zip(owners, best, means, strict=True):
                    langs[row], scores[row] = network.languages[k], min(1.0, float(mean[k]))

            for row, text in enumerate(batch.column(text_at)):
                if not lettered[row]:
                    continue
                raw = text.as_py().encode("utf-8")
                windows = to_windows(raw)
                weight = np.full(len(windows), WINDOW, dtype=np.float64)
                weight[-1] = len(raw) - (len(windows) - 1) * WINDOW
                waiting.append(windows)
                owners.append(row)
                sizes.append(weight)
                held += len(windows)
                if held >= 4 * CHUNK:
                    flush()
                    waiting, owners, sizes, held = [], [], [], 0
            flush()
            columns = [batch.column(i) for i in range(len(schema) - 2)]
            yield pa.RecordBatch.from_arrays(
                [*columns, pa.array(langs, pa.string()), pa.array(scores, pa.float64())], schema.names
            )

    return docs.withColumn(letters, whole_text().rlike(r"\p{L}")).mapInArrow(label, schema)


def keep_identified(docs: DataFrame, min_score: float = MIN_SCORE, **options) -> DataFrame:
    """``docs`` without the rows whose language is ``und`` or scored below ``min_score``; columns unchanged.

    By default a language has to be as likely as all others together.
    """
    lang, score = fresh(docs, "lang_pred", "score")
    labelled = predict(docs, fit(docs.where(~held_out()), **options), (lang, score))
    return labelled.where((F.col(lang) != UNKNOWN) & (F.col(score) >= min_score)).select(*docs.columns)
