"""Tables and brute-force results that the tests of the training-data operators share."""

from __future__ import annotations

import random
import re

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
WORD = re.compile(rb"[^\x20\x09-\x0D]+")


def words_of(text: str | None) -> list[bytes]:
    return WORD.findall((text or "").encode())


def rows_of(*texts: str | None, first: int = 0) -> list[tuple]:
    return [(first + i, t, "en", f"src{i % 3}", len(t) if t is not None else None) for i, t in enumerate(texts)]


def odd_texts(seed: int = 1) -> list[str | None]:
    """Null, empty, blank and short texts, copies, near copies, shared passages, runs of one sign or word, other scripts, a long one."""
    rng = random.Random(seed)
    vocabulary = ["".join(rng.choice("abcdeéñ") for _ in range(rng.randrange(1, 8))) for _ in range(400)]

    def prose(n: int) -> str:
        return "".join(rng.choice(vocabulary) + rng.choice([" ", " ", " ", "\n", "  ", "\t"]) for _ in range(n))

    shared, base = prose(90), prose(300)
    near = base.split(" ")
    near[len(near) // 2] = "changed"
    return [
        None, "", " \n\t ", "one", "two words", prose(40), base, base, base, " ".join(near), prose(60) + shared + prose(60),
        prose(20) + shared, shared + prose(70), shared, "a" * 700, "b" * 450, "na " * 300, "日本語のテキスト " * 40, "ab" * 500,
        prose(4000), prose(30) + "\x0b\x0c\r x　y " + prose(30), "!!! ??? ###", "ONE TWO\nONE TWO\nONE TWO\nONE TWO\n" * 20]


def documents(spark, rows: list[tuple], parts: int = 3):
    return spark.createDataFrame(rows, SCHEMA).repartition(parts)


def with_clashes(frame):
    """More columns, of names that the operators use themselves."""
    from pyspark.sql import functions as F

    names = ("id", "gram", "context", "spot", "size", "key", "range", "words", "label", "first", "table", "node", "target", "carried", "score", "n", "html_", "sha")
    return frame.select("*", *(F.lit(1).alias(n) for n in names))
