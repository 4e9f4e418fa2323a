"""Small documents with every awkward case, for the tests of the llm operators."""

from __future__ import annotations

import random

SCHEMA = (
    "doc_id long, text string, lang string, source string, n_chars long, _digest string, _node string, _rows int,"
    " _rejected string, size string, shard int, slot string, length string, offset string, copies int, rank string, h string,"
    " bucket int, salt int, part string, guest string, at string, node string, uid string, `_n` string"
)
EXTRA = ("x",) * 2 + (1,) + ("x", "x", 1, "x", "x", "x", 1, "x", "x", 1, 1) + ("x",) * 6


def rows() -> list[tuple[int | None, str | None]]:
    """Nulls, empty and white texts, copies, near copies, repeated rows, repeated and null ids, a very long text."""
    rng = random.Random(5)
    vocabulary = ["alpha", "beta", "Gamma", "délta", "été", "naïve", "kappa.", "mu,", "nu", "ξένος", "漢字", "pi", "rho", "🙂"]

    def text(n):
        return " ".join(rng.choice(vocabulary) + str(rng.randint(0, 40)) for _ in range(n))

    base = text(120)
    words = base.split(" ")
    out = [(i, text(rng.randint(1, 60))) for i in range(1, 41)]
    out += [(100 + i, base) for i in range(12)]  # copies
    for i in range(8):  # near copies: one word changed
        changed = words.copy()
        changed[7 * i + 3] = f"other{i}"
        out.append((120 + i, " ".join(changed)))
    out += [(130, base.replace(" ", "\n")), (131, base.upper()), (132, "  " + base + "\t\r\n"), (99, base)]
    out += [(140, None), (141, ""), (142, " \n\t"), (143, "one"), (144, "one two"), (145, "ONE two"), (146, "a\x00b \x0b c\x85d\xa0e")]
    out += [(150, text(30))] * 3  # the same row again and again
    out += [(151, "left text here"), (151, "right text there"), (151, None)]  # one id, different texts
    out += [(None, "no id"), (None, "no id"), (None, None), (-5, "below zero")]
    out += [(160, " ".join(text(10) for _ in range(1500)))]  # very long
    out += [(161, "word " * 3000)]
    rng.shuffle(out)
    return out


def frame(spark, data=None, parts: int = 3):
    data = rows() if data is None else data
    full = [(i, t, "en", "s", len(t or ""), *EXTRA) for i, t in data]
    return spark.createDataFrame(full, SCHEMA).repartition(parts)


def empty(spark):
    return spark.createDataFrame([], SCHEMA)
