"""Documents with every defined case, and helpers."""

from __future__ import annotations

import random

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint, block bigint, key string, sig string, label string"

#: Words of a small language, for texts that look like prose.
WORDS = ("the of and to in stone river mountain survey measure height cloud photon raster tile island coast lake water depth signal noise ground canopy "
         "track beam orbit season winter summer north south east west map grid cell value mean median error slope ridge valley").split()  # fmt: skip


def prose(seed: int, n: int) -> str:
    r = random.Random(seed)
    return " ".join(r.choice(WORDS) for _ in range(n))


def edited(text: str, seed: int, share: float) -> str:
    r = random.Random(seed)
    return " ".join(f"x{r.randrange(10**6)}" if r.random() < share else w for w in text.split())


def cases() -> list[tuple]:
    base = prose(1, 300)
    texts = [
        (1, base), (2, base), (3, edited(base, 2, 0.01)), (4, edited(base, 3, 0.3)), (5, None), (6, ""), (7, " \n\t "), (8, "one two"), (9, "ONE  two"),
        (10, prose(4, 5)), (11, prose(5, 6000)), (None, base), (None, None), (12, "token = abcdefgh1234 é ü 漢字 <|endoftext|> İstanbul \x1c ½"), (12, "token = abcdefgh1234 é ü 漢字 <|endoftext|> İstanbul \x1c ½"),
        (13, "short"), (14, edited(prose(5, 6000), 9, 0.005)), (15, "a" * 70000), (16, "\x02\x03 marks \x02"),
    ]
    return [(i, t, [None, "en", "de"][k % 3], "s", len(t or ""), 1, "k", "s", "l") for k, (i, t) in enumerate(texts)]


def documents(spark, rows=None):
    return spark.createDataFrame(cases() if rows is None else rows, SCHEMA)
