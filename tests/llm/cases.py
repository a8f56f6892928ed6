"""Small document tables with the awkward cases, and plain models of the contracts."""

from __future__ import annotations

import random
import re

SF = "/root/testdata/sf0.001"
SPACE_WORD = re.compile("[^\x20\x09-\x0D]+")


def lower(s: str) -> str:
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in s)


def words(s) -> list[str]:
    return SPACE_WORD.findall(lower(s or ""))


def awkward_rows() -> list[tuple]:
    """(doc_id, text, lang, source, n_chars): nulls, blanks, ties, copies, near
    copies, a very long text, repeated rows."""
    rng = random.Random(7)
    vocab = ["the", "of", "Licence", "naïve", "Straße", "año", "and", "x", "##", "日本語"] + [
        "".join(rng.choice("abcdefgh") for _ in range(rng.randint(2, 9))) for _ in range(300)]
    text = lambda n: " ".join(rng.choice(vocab) for _ in range(n))
    base = text(120)
    near = base.split()
    near[5] = "changed"
    rows = [
        (1, base, "en", "a", 1), (2, base, "en", "a", 1), (3, " ".join(near), "en", "b", 1),
        (4, None, None, None, None), (5, "", "en", "b", 0), (6, " \n\t ", "en", "b", 4),
        (7, "one", "en", "c", 3), (8, "one two", "en", "c", 7), (9, "ONE two", "en", "c", 7),
        (10, text(60) + "\n" + base[100:400] + "\n" + text(30), "de", "a", 1),
        (11, text(6000), "de", "d", 1), (12, "a" * 5000, "xx", "d", 5000),
        (13, "Released under the MIT License. mit  license", "en", "e", 1),
        (14, "▁ ▁▁ mark ￿ \x00 end ", "en", "e", 1),
        (14, "▁ ▁▁ mark ￿ \x00 end ", "en", "e", 1),
        (15, "same line here\nsame line here\n\n" * 6, "en", "e", 1),
        (None, text(40), "en", "a", 1),
    ]
    return rows + [(100 + i, text(rng.randint(1, 80)), "en", rng.choice("abcde"), 1) for i in range(40)]


SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
CLASHING = ("words", "key", "block", "label", "size", "spans", "cls", "count", "features", "x", "i")


def frame(spark, rows=None, clashing: bool = True):
    from pyspark.sql import functions as F

    df = spark.createDataFrame(awkward_rows() if rows is None else rows, SCHEMA)
    return df.withColumns({c: F.lit("clash") for c in CLASHING}) if clashing else df
