"""Small awkward tables, and plain versions of the rules."""

import random
import re

from pyspark.sql import DataFrame, SparkSession

SCHEMA = (
    "doc_id long, text string, lang string, source string, n_chars long, key long, bucket string, raw string, t1 string,"
    " label int, c string, spans string, items string, cut string, n_words int, has_letters int, lang_pred int, score int"
)
WORDS = "amber brook cedar delta ember fjord grove heath inlet jetty knoll ledge marsh notch ocean".split()


def sentence(n: int, seed: int) -> str:
    rng = random.Random(seed)
    return " ".join(rng.choice(WORDS) + rng.choice(["", "s", "ing", "ed", str(rng.randint(0, 99))]) for _ in range(n))


def texts() -> list[tuple[int | None, str | None]]:
    base = sentence(120, 1)
    words = base.split(" ")
    near = " ".join(words[:60] + ["changed"] + words[61:])
    return [
        (1, base),
        (2, base.upper()),
        (3, base),
        (4, near),
        (5, None),
        (6, ""),
        (7, " \n\t "),
        (8, "one two three"),
        (9, "ONE two three"),
        (None, base),
        (None, "nobody's own text, with no id to name it"),
        (10, "repeated row"),
        (10, "repeated row"),
        (11, "É é ß 漢字 😀 naïve"),
        (12, "é é ß 漢字 😀 naïve"),
        (13, sentence(20_000, 2)),
        (14, sentence(90, 3) + " " + base + " " + sentence(90, 4)),
        (15, "!!! ... ???"),
        (16, sentence(200, 5)),
        (17, "a " * 3000),
        (18, None),
    ]


def documents(spark: SparkSession, rows=None) -> DataFrame:
    """The rows with the columns of documents and more, whose names clash with those that operators use inside."""
    rows = texts() if rows is None else rows
    full = [(i, t, "en", "s", len(t or ""), 1, "b", "r", "t", 1, "c", "s", "i", "u", 2, 3, 4, 5) for i, t in rows]
    return spark.createDataFrame(full, SCHEMA)


def lower(text: str) -> str:
    return re.sub("[A-Z]", lambda m: m[0].lower(), text)


def plain(row) -> tuple:
    return tuple(tuple(v) if isinstance(v, list) else v for v in row)


def same_rows(a, b) -> bool:
    return sorted(map(repr, map(plain, a))) == sorted(map(repr, map(plain, b)))
