"""Small document tables with the awkward rows every operator must bear."""

from __future__ import annotations

import random
import re

from pyspark.sql import functions as F

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
WORDS = re.compile(r"[^\x20\x09-\x0D]+")
# Names that operators use themselves, or might.
CLASHES = "size target weight shard slot id n hub place tie value _found found _u _g toxicity kept site line rid bucket component".split()


def words(text: str | None) -> list[str]:
    return WORDS.findall(text or "")


def vocabulary(n: int, seed: int = 5) -> list[str]:
    r = random.Random(seed)
    return ["".join(r.choice("abcdefghij") for _ in range(r.randint(2, 7))) for _ in range(n)]


def sentence(r: random.Random, vocab: list[str], n: int) -> str:
    return " ".join(r.choice(vocab) for _ in range(n))


def table(spark, rows, clashes: bool = True):
    """``rows`` of (doc_id, text[, source]) as documents, with extra columns of clashing names."""
    full = [(r[0], r[1], None, r[2] if len(r) > 2 else "s", None if r[1] is None else len(r[1])) for r in rows]
    df = spark.createDataFrame(full, SCHEMA)
    return df.withColumns({c: F.lit("x") for c in CLASHES}) if clashes else df


def awkward(first_id: int = 900):
    """Null, empty, blank, tiny, repeated and non-ASCII texts, a null id and a long text."""
    long_text = " ".join(f"w{i % 977}x{i % 31}" for i in range(20_000))
    return [
        (first_id, None), (first_id + 1, ""), (first_id + 2, " \n\t "), (first_id + 3, "one"), (first_id + 4, "é\xa0ß two\x85three"),
        (first_id + 5, "same text here"), (first_id + 6, "same text here"), (first_id + 6, "same text here"), (first_id + 7, long_text), (None, "no id at all"),
    ]
