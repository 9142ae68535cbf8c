"""Small awkward tables and brute-force helpers."""

from __future__ import annotations

import random
import re

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
SPACED = re.compile(r"[^\x20\x09-\x0D]+")
ALNUM = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")

#: Columns beside the five of documents, with names that operators use inside.
EXTRA = ("size", "shard", "slot", "cls", "label", "score", "n", "h", "word", "part", "rank", "target", "copies", "rejected",
         "kept_id", "kept_mark", "mix_mark", "mix_id", "mix_copy", "contaminated_row", "shard_row", "mark", "dropped", "lo")
DOCUMENTS = ("doc_id long, text string, lang string, source string, n_chars long, "
             + ", ".join(f"{c} string" for c in EXTRA))


def words(text, rx=SPACED):
    return rx.findall((text or "").translate(LOWER))


def document_rows(rows):
    """(doc_id, text, lang, source) rows, padded with the extra columns."""
    return [(i, t, lang, src, None if t is None else len(t), *["x"] * len(EXTRA)) for i, t, lang, src in rows]


def documents(spark, rows):
    return spark.createDataFrame(document_rows(rows), DOCUMENTS)


def prose(seed: int, n: int, vocabulary: int = 400) -> str:
    r = random.Random(seed)
    return " ".join(f"w{r.randrange(vocabulary)}" for _ in range(n))


def awkward_rows():
    """Nulls in every column, empty and long texts, ties, repeated rows, odd characters."""
    long_text = prose(1, 30_000, 5000)
    return [
        (1, "One two three four five six.", "en", "b"), (2, None, "en", "a"), (3, "", None, None), (4, "   \n\t ", "de", "b"),
        (5, long_text, "en", "b"), (6, "Ünïcödé wörds — 日本語 テキスト\x00 \x1c x", "de", None), (7, "only", None, "c"),
        (8, "One two three four five six.", "en", "b"), (8, "One two three four five six.", "en", "b"),
        (8, "another text of the same id", "fr", "z"), (None, "a row without an id but with words", "en", "a"),
        (None, None, None, None), (9, "<|endoftext|> </s> [INST] \\ <| ~ %", "en", "é"), (10, "1 2 3 4", "en", "a"),
        (11, prose(2, 60), "fr", "a"), (12, prose(2, 60) + " tail", "fr", "a"), (-7, prose(3, 50), "es", "b"),
    ]


def rows_of(df, *cols):
    return [tuple(r) for r in (df.select(*cols) if cols else df).collect()]


def key(r):
    return tuple((x is not None, str(x)) for x in r)
