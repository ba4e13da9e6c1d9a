"""SentencePiece encoding and decoding with weighted finite-state machines.

Three machines are compiled from a model file: the normaliser (dummy prefix, space to the visible space), the pieces
(an automaton over all pieces at once), and the byte fallback for characters outside the alphabet. A fourth one, for
byte-pair models, lets a piece follow another only where the merges would leave that boundary standing; any other pair
has infinite weight. Composing them with a text gives a lattice whose states are prefixes with their last piece, and
the encoding is the path of least weight in the tropical semiring (weights add along a path, the least path counts).
For a byte-pair model one path of finite weight reaches each prefix, so the first finite arc into a prefix is the
minimum and the rest need no look. A text is cut where no piece can cross (before visible spaces, and between words and
marks that share no piece), and the shortest paths of recent cuts are remembered.

Defined results: a null text is the empty text, which has no piece and decodes to itself; ``round_trip`` tells whether
decoding gives the text again (a text that holds the visible space itself comes back with a plain one); rows pass one
by one, so repeated rows and null ids are kept; an empty table gives an empty table.
"""

from __future__ import annotations

import re
import struct
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from ledgerlens.llm.common import whole_text
from ledgerlens.llm.segment import Segmenter

SPACE = "▁"
PATHS_HELD = 300_000
# Fixed values of the model format: kinds of pieces, and the byte-pair model type.
NORMAL, USER_DEFINED, BYTE = 1, 4, 6
BYTE_PAIR = 2


def _fields(data: bytes) -> Iterator[tuple[int, object]]:
    """The fields of a protocol-buffer message: numbers, and bytes for anything longer."""
    at = 0

    def number() -> int:
        nonlocal at
        out = shift = 0
        while True:
            byte = data[at]
            at += 1
            out |= (byte & 127) << shift
            shift += 7
            if byte < 128:
                return out

    while at < len(data):
        tag = number()
        kind = tag & 7
        if kind == 0:
            yield tag >> 3, number()
        else:
            size = number() if kind == 2 else 8 if kind == 1 else 4
            yield tag >> 3, data[at : at + size]
            at += size


def _joined_with_letters(pieces: Iterable[str]) -> set[str]:
    """The letters of all pieces and every character that pieces join with them, directly or through others."""
    joined: dict[str, set[str]] = {}
    for piece in pieces:
        inside = piece.lstrip(SPACE)
        for c in inside:
            joined.setdefault(c, set()).update(inside)
    found, ahead = set(), [c for c in joined if c.isalpha()]
    while ahead:
        c = ahead.pop()
        if c not in found:
            found.add(c)
            ahead.extend(joined[c])
    return found


class PieceMachine:
    """The machines of one model file, given as its bytes."""

    def __init__(self, model: bytes):
        self.names: list[str] = []
        scores, kinds, spec, trainer = [], [], {}, {}
        for field, value in _fields(model):
            if field == 1:
                piece = dict(_fields(value))
                self.names.append(piece[1].decode("utf-8"))
                scores.append(struct.unpack("<f", piece.get(2, bytes(4)))[0])
                kinds.append(piece.get(3, NORMAL))
            elif field == 2:
                trainer = dict(_fields(value))
            elif field == 3:
                spec = dict(_fields(value))
        if trainer.get(3, 1) != BYTE_PAIR or spec.get(2) or spec.get(4, 1):
            raise ValueError("only byte-pair models that keep characters and spaces as they are can be compiled")
        self.prefix = SPACE if spec.get(3, 1) else ""
        self.bytes = {int(n[3:5], 16): i for i, (n, k) in enumerate(zip(self.names, kinds, strict=True)) if k == BYTE}
        pieces = {n: i for i, (n, k) in enumerate(zip(self.names, kinds, strict=True)) if k in (NORMAL, USER_DEFINED)}
        if any(SPACE in n.lstrip(SPACE) or "\n" in n for n in pieces):
            raise ValueError("a piece crosses a space or a line end")
        weights = {n: -scores[i] for n, i in pieces.items()}
        self.segmenter = Segmenter(pieces, lambda a, b: weights.get(a + b))
        alphabet = "".join(re.escape(n) for n in pieces if len(n) == 1)
        words = "".join(map(re.escape, sorted(_joined_with_letters(pieces))))
        runs = [f"[{words}]", f"[^{words}{SPACE}\n]"] if words else [f"[^{SPACE}\n]"]
        self.cuts = re.compile("|".join(["\n", *[f"{SPACE}*{kind}+" for kind in runs], f"{SPACE}+"]))
        self.runs = re.compile(f"[{alphabet}]+|.", re.DOTALL)
        self.outside = re.compile(f"[^{alphabet}]")
        self.held: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}
        self.raw = [bytes([int(n[3:5], 16)]) if k == BYTE else n.encode("utf-8") if k in (NORMAL, USER_DEFINED) else b""
                    for n, k in zip(self.names, kinds, strict=True)]

    def normalise(self, text: str) -> str:
        return self.prefix + text.replace(" ", SPACE) if text else ""

    def _path(self, cut: str) -> bytes:
        known = self.older.get(cut)
        if known is None:
            if self.outside.search(cut) is None:
                ids = self.segmenter.tokens(cut)
            else:
                ids = []
                for run in self.runs.findall(cut):
                    if self.outside.match(run):
                        ids.extend(self.bytes[b] for b in run.encode("utf-8"))
                    else:
                        ids.extend(self.segmenter.tokens(run))
            known = np.array(ids, dtype=np.int32).tobytes()
        if len(self.held) >= PATHS_HELD:  # two generations: common cuts stay
            self.held, self.older = {}, self.held
        self.held[cut] = known
        return known

    def encode(self, text: str) -> np.ndarray:
        held, path = self.held, self._path
        cuts = self.cuts.findall(self.normalise(text))
        return np.frombuffer(b"".join([held.get(c) or path(c) for c in cuts]), dtype=np.int32)

    def decode(self, ids: np.ndarray) -> str:
        raw = self.raw
        text = b"".join([raw[i] for i in ids.tolist()]).decode("utf-8", "replace").replace(SPACE, " ")
        return text[len(self.prefix) :] if text.startswith(" ") else text


@lru_cache(maxsize=2)
def machine_for(model: bytes) -> PieceMachine:
    """One machine for each worker process and model."""
    return PieceMachine(model)


def _model_bytes(path: str) -> bytes:
    with open(path, "rb") as file:
        return file.read()


def encode_texts(docs: DataFrame, model_path: str) -> DataFrame:
    """doc_id, n_pieces, piece_ids and round_trip for each row."""
    shared = docs.sparkSession.sparkContext.broadcast(_model_bytes(model_path))  # one model file, under a few MB
    schema = T.StructType(
        [
            T.StructField("doc_id", docs.schema["doc_id"].dataType),
            T.StructField("n_pieces", T.LongType()),
            T.StructField("piece_ids", T.ArrayType(T.IntegerType())),
            T.StructField("round_trip", T.BooleanType()),
        ]
    )

    def encoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machine = machine_for(shared.value)
        for batch in batches:
            paths, same = [], []
            for text in batch.column(1):
                raw = text.as_py()
                ids = machine.encode(raw)
                paths.append(ids)
                same.append(machine.decode(ids) == raw)
            sizes = np.array([len(p) for p in paths], dtype=np.int32)
            offsets = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)
            values = pa.array(np.concatenate(paths) if paths else np.zeros(0, np.int32), pa.int32())
            lists = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), values)
            columns = [batch.column(0), pa.array(sizes.astype(np.int64)), lists, pa.array(same, pa.bool_())]
            yield pa.RecordBatch.from_arrays(columns, schema.names)

    return docs.select("doc_id", whole_text().alias("text")).mapInArrow(encoded, schema)


def decode_ids(encoded: DataFrame, model_path: str) -> DataFrame:
    """doc_id and text from ``piece_ids``; a null list is an empty one."""
    shared = encoded.sparkSession.sparkContext.broadcast(_model_bytes(model_path))
    schema = T.StructType([encoded.schema["doc_id"], T.StructField("text", T.StringType())])

    def decoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machine = machine_for(shared.value)
        for batch in batches:
            texts = [machine.decode(np.array(ids.as_py() or [], dtype=np.int32)) for ids in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], schema.names)

    return encoded.select("doc_id", "piece_ids").mapInArrow(decoded, schema)
