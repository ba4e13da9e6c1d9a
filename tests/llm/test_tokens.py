"""Token counts and pieces against the public libraries."""

import random

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

from ledgerlens.llm import pieces, token_counts
from tests.llm.helpers import documents, same_rows, texts

BPE = public_tokenizers.path("byte_bpe_50k.json")
MODEL = public_tokenizers.path("piece_bpe_32k.model")
PARTS = [*"ab \n\t'1!?é漢😀ß_-▁", "the", "  ", "'re", "'s", "'ll", " x", "Ing", "ation", " ", "　", "\x00"]
PARTS += ["<|endoftext|>", "<|end", "of", "<s>", "<0x0A>", "์", "́"]


def _random_texts(n: int, seed: int) -> list[str]:
    rng = random.Random(seed)
    return ["".join(rng.choice(PARTS) for _ in range(rng.randint(0, 14))) for _ in range(n)]


@pytest.fixture(scope="module")
def counter():
    with open(BPE, encoding="utf-8") as file:
        return token_counts.PrefixCounter(file.read())


@pytest.fixture(scope="module")
def library():
    tokenizer = Tokenizer.from_file(BPE)
    return lambda text: len(tokenizer.encode(text, add_special_tokens=False).ids)


def test_every_prefix_counts_as_the_library_counts(counter, library):
    for text in _random_texts(300, 4):
        steps = counter.text_steps(text).tobytes()
        counts = [token_counts.count_at(steps, i) for i in range(len(text) + 1)]
        assert counts == [library(text[:i]) for i in range(len(text) + 1)]


def test_budgets_are_answered_from_the_table(counter, library):
    for text in _random_texts(100, 5):
        steps = counter.text_steps(text).tobytes()
        fits = [i for i in range(len(text) + 1) if library(text[:i]) <= 4]
        assert token_counts.longest_within(steps, 4) == max(fits)


def test_pieces_forgotten_and_kept_give_the_same_counts(library, monkeypatch):
    monkeypatch.setattr(token_counts, "PIECES_HELD", 3)
    with open(BPE, encoding="utf-8") as file:
        small = token_counts.PrefixCounter(file.read())
    for text in _random_texts(100, 6):
        assert int(small.text_steps(text).sum()) == library(text)


def test_token_table(spark, library):
    found = token_counts.prefix_tables(documents(spark), BPE)
    rows = found.select("doc_id", "n_bytes", "n_tokens").collect()
    assert same_rows(rows, [(i, len((t or "").encode()), library(t or "")) for i, t in texts()])
    assert token_counts.prefix_tables(documents(spark, []), BPE).count() == 0
    steps = {r.n_bytes: r for r in found.collect() if r.doc_id == 13}
    assert all(token_counts.count_at(r.steps, len(r.steps)) == r.n_tokens for r in steps.values())


def test_pieces_equal_the_library():
    machine = pieces.PieceMachine(pieces._model_bytes(MODEL))
    model = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    for text in [*_random_texts(3000, 7), *[t or "" for _, t in texts()]]:
        ids = machine.encode(text)
        assert ids.tolist() == model.encode(text)
        assert machine.decode(ids) == model.decode(ids.tolist())


def test_words_are_remembered_without_the_marks_around_them():
    machine = pieces.PieceMachine(pieces._model_bytes(MODEL))
    model = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    joined = pieces._joined_with_letters(machine.segmenter.names.values())
    for name in machine.segmenter.names.values():  # no piece crosses such a cut
        assert len({c in joined for c in name.lstrip(pieces.SPACE)}) <= 1
    marks = ["", ",", ".", "!!", "%%%", '",', "),", "...", "1", "漢", "😀"]
    text = " ".join(f"{a}theath{b}" for a in ("", "(") for b in marks) + "\n-- theath's (  x"
    assert machine.encode(text).tolist() == model.encode(text)
    assert {c for c in machine.held if "theath" in c} == {"▁theath", "theath"}


def test_piece_table_and_decoding(spark):
    model = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    encoded = pieces.encode_texts(documents(spark), MODEL)
    expected = [(i, len(model.encode(t or "")), model.encode(t or ""), True) for i, t in texts()]
    assert same_rows(encoded.collect(), expected)
    assert same_rows(pieces.decode_ids(encoded, MODEL).collect(), [(i, t or "") for i, t in texts()])
    assert pieces.encode_texts(documents(spark, []), MODEL).count() == 0


def test_a_text_with_the_visible_space_does_not_come_back(spark):
    row = pieces.encode_texts(documents(spark, [(1, "a▁b")]), MODEL).first()
    assert not row.round_trip
    assert np.array(row.piece_ids).size
