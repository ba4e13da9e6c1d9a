"""Exact token counts of every prefix of a text, for a byte-level byte-pair vocabulary.

A text is cut into pieces by the vocabulary's pattern; a walk over a piece (``segment.Segmenter``) gives the token
count of each of its prefixes, and pieces are looked up in a bounded memory of pieces seen. A text's table holds one
signed byte for each character: by how much the count of the prefix grows there. From it the count at any cut and the
longest prefix within any budget follow without encoding again.

The table is exact at every character, also where a cut changes the pieces: a cut inside white space leaves one piece
of white space, a cut inside a contraction leaves a quote and a letter, and a cut inside a special string leaves plain
text.

Defined results: a null text is the empty text with no token; rows pass through one by one, so repeated rows and null
ids are kept as they are; an empty table gives an empty table; only the columns asked for are read.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator
from functools import lru_cache
from itertools import accumulate

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from ledgerlens.llm.common import whole_text
from ledgerlens.llm.segment import Segmenter

PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
SPACES = re.compile(r"\s\s")
PIECES_HELD = 120_000
TOKEN_LIMIT = 512


def byte_names() -> dict[str, int]:
    """The printable character that stands for each byte in a byte-level vocabulary."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


class PrefixCounter:
    """Prefix counts for one vocabulary file, given as its JSON text."""

    def __init__(self, definition: str):
        spec = json.loads(definition)
        names = byte_names()
        raw = {name: bytes(map(names.__getitem__, name)).decode("latin-1") for name in spec["model"]["vocab"]}
        ranks = {}
        for place, pair in enumerate(spec["model"]["merges"]):
            left, right = pair.split(" ") if isinstance(pair, str) else pair
            ranks[raw[left], raw[right]] = place
        vocabulary = {raw[name]: number for name, number in spec["model"]["vocab"].items()}
        self.segmenter = Segmenter(vocabulary, lambda a, b: ranks.get((a, b)))
        self.special = [t["content"] for t in spec.get("added_tokens", [])]
        self.special_pattern = regex.compile("|".join(map(regex.escape, self.special))) if self.special else None
        self.pattern = regex.compile(PATTERN)
        self.held: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}

    def _walk(self, piece: str) -> list[int]:
        """Token counts after each character of a piece taken by itself."""
        counts = self.segmenter.walk(piece.encode("utf-8", "surrogatepass").decode("latin-1"))[1]
        if piece.isascii():
            return counts[1:]
        ends = accumulate(len(c.encode("utf-8", "surrogatepass")) for c in piece)
        return [counts[e] for e in ends]

    def steps(self, piece: str) -> bytes:
        """Growth of the count at each character of a piece."""
        known = self.held.get(piece) or self.older.get(piece)
        if known is None:
            counts = self._walk(piece)
            if piece in ("'re", "'ve", "'ll"):  # cut after the letter: the quote and the letter are two pieces
                counts[1] = counts[0] + self._walk(piece[1])[0]
            known = bytes([(b - a) & 255 for a, b in zip([0, *counts], counts, strict=False)])  # signed bytes
        if len(self.held) >= PIECES_HELD:  # two generations: common pieces stay
            self.held, self.older = {}, self.held
        self.held[piece] = known
        return known

    def _plain(self, text: str) -> np.ndarray:
        """Growth at each character of a text without special strings."""
        pieces = self.pattern.findall(text)
        held, steps = self.held, self.steps  # a generation that is put aside meanwhile still answers
        grown = np.frombuffer(b"".join([held.get(p) or steps(p) for p in pieces]), dtype=np.int8).copy()
        self._mend_spaces(text, pieces, grown)
        return grown

    def _mend_spaces(self, text: str, pieces: list[str], grown: np.ndarray) -> None:
        """A cut after a run of white space leaves the whole run as one piece, though its last character goes on alone."""
        at = 0
        before = ""
        for piece in pieces if SPACES.search(text) else ():
            if before.isspace() and piece[0].isspace():
                run = self._walk(before + piece[0])
                change = run[-1] - run[-2]
                off = change - int(grown[at])
                grown[at] += off
                if len(piece) > 1:
                    grown[at + 1] -= off
                elif at + 1 < len(grown):
                    grown[at + 1] -= off
            at += len(piece)
            before = piece

    def text_steps(self, text: str) -> np.ndarray:
        """Growth of the token count at each character of a text."""
        if self.special_pattern is None or not self.special_pattern.search(text):
            return self._plain(text)
        parts, at = [], 0
        for found in self.special_pattern.finditer(text):
            plain = text[at : found.start()]
            parts.append(self._plain(plain))
            tail = "".join(self.pattern.findall(plain)[-2:])
            base = int(self._plain(tail).sum())
            inside = [int(self._plain(tail + found[0][:k]).sum()) - base for k in range(1, len(found[0]))]
            parts.append(np.diff([0, *inside, 1]).astype(np.int8))
            at = found.end()
        parts.append(self._plain(text[at:]))
        return np.concatenate(parts)


@lru_cache(maxsize=2)
def counter_for(definition: str) -> PrefixCounter:
    """One counter for each worker process and vocabulary."""
    return PrefixCounter(definition)


def count_at(steps: bytes, characters: int) -> int:
    """Tokens of the prefix of that many characters."""
    return int(np.frombuffer(steps, dtype=np.int8)[:characters].sum(dtype=np.int64))


def longest_within(steps: bytes, budget: int) -> int:
    """Characters of the longest prefix that has at most ``budget`` tokens."""
    upto = np.cumsum(np.frombuffer(steps, dtype=np.int8), dtype=np.int64)
    return int(np.flatnonzero(upto <= budget)[-1]) + 1 if len(upto) and (upto <= budget).any() else 0


def prefix_tables(docs: DataFrame, definition_path: str, budget: int = TOKEN_LIMIT, with_steps: bool = True) -> DataFrame:
    """doc_id, n_bytes, n_tokens, fit_chars (longest prefix within ``budget``) and, if asked for, the table ``steps``."""
    with open(definition_path, encoding="utf-8") as file:
        shared = docs.sparkSession.sparkContext.broadcast(file.read())  # one vocabulary file, a few MB
    out = [("doc_id", docs.schema["doc_id"].dataType), ("n_bytes", T.LongType()), ("n_tokens", T.LongType()), ("fit_chars", T.LongType())]
    out += [("steps", T.BinaryType())] * with_steps
    schema = T.StructType([T.StructField(n, t) for n, t in out])

    def answer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = counter_for(shared.value)
        for batch in batches:
            n_bytes, tokens, fit, tables = [], [], [], []
            for text in batch.column(1):
                raw = text.as_py()
                steps = counter.text_steps(raw)
                total = int(steps.sum(dtype=np.int64))
                n_bytes.append(len(raw) if raw.isascii() else len(raw.encode("utf-8", "surrogatepass")))
                tokens.append(total)
                fit.append(len(raw) if total <= budget else longest_within(steps, budget))
                if with_steps:
                    tables.append(steps.tobytes())
            columns = [batch.column(0), pa.array(n_bytes, pa.int64()), pa.array(tokens, pa.int64()), pa.array(fit, pa.int64())]
            yield pa.RecordBatch.from_arrays(
                columns + [pa.array(tables, pa.binary())] * with_steps, [n for n, _ in out]
            )

    return docs.select("doc_id", whole_text().alias("text")).mapInArrow(answer, schema)
