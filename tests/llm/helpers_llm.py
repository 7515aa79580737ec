"""Small document tables with the awkward cases every operator must stand."""

from __future__ import annotations

import random
import re

WORDS = [a + b + c for a in ("ba", "ko", "mi", "tur", "els") for b in ("an", "ol", "es", "") for c in ("d", "ne", "rik", "")]
LONG = " ".join(WORDS[(i * i + i // 7) % len(WORDS)] + str(i % 97) for i in range(30_000))


def prose(seed: int, n: int) -> str:
    random.seed(seed)
    return " ".join(random.choice(WORDS) + random.choice(["", "", "", ",", "."]) for _ in range(n))


def awkward() -> list[tuple]:
    """(doc_id, text): null id, null, empty and blank texts, exact copies, repeated rows, a long text."""
    base = prose(1, 120)
    return [(1, base), (2, base), (3, None), (4, ""), (5, " \n\t "), (6, "one"), (7, LONG), (8, prose(2, 60)),
            (8, prose(2, 60)), (None, prose(3, 60)), (9, "a  b c \x1cq é日本 don't <|endoftext|>  \n\n x "),
            (10, base + " and one more thing"), (11, prose(4, 40) + " " + base)]


def words(text) -> list[str]:
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def documents(spark, rows: list[tuple], clash: str = "n_words string, h string, text2 string, _id int, _place int"):
    """A documents table with columns whose names clash with those that operators use inside."""
    names = [c.split()[0] for c in clash.split(", ")]
    schema = f"doc_id long, text string, {clash}"
    return spark.createDataFrame([(*r, *[None] * len(names)) for r in rows], schema)
