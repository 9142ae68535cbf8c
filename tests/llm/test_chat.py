from __future__ import annotations

import hashlib
import random

from pyspark.sql import functions as F

from tests.llm.fixtures import key, rows_of
from waferline.llm import chat

HARD = ["", None, "</s>", "<\\/s>", "<\\\\/s>", "[INST] a [/INST]", "<|+|>", "<|user|>", "<", "|", "<\\", "s>", "<<s>>", "[[INST]]", "<s",
        "a<|", "\\", "%7C", "x\ny", "<|im_end|>", "[s>", "é</s>日本", "$1", "\\1"]


def conversations(spark, rows):
    return spark.createDataFrame([(*r, "x", 1) for r in rows], "conv_id long, turn long, role string, text string, t string, formatted int")


def brute(rows):
    out = {}
    for c in {r[0] for r in rows}:
        turns = sorted(((r[2] or "", r[3] or "", r[1]) for r in rows if r[0] == c),
                       key=lambda t: (t[2] is not None, t[2] or 0, t[0].encode(), t[1].encode()))
        loss = "".join(t for r, t, _ in turns if r == "assistant")
        sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
        out[c] = (len(turns), sha("".join(f"{r}\n{t}\n" for r, t, _ in turns)), len(loss), sha(loss))
    return out


def test_digest_against_brute_force(spark):
    r = random.Random(3)
    rows = [(c, t, r.choice(["user", "assistant", "system", "a|b<c>%", None, ""]), r.choice(HARD))
            for c in range(40) for t in range(r.randrange(1, 12))]
    rows += [(50, 1, "user", "tie b"), (50, 1, "user", "tie a"), (50, 1, "assistant", "x"), (50, None, "assistant", "first"),
             (51, 0, "user", "twice"), (51, 0, "user", "twice"), (None, 0, "user", "no id"), (52, 0, "assistant", "y " * 100_000)]
    got = chat.digest(chat.format_chats(conversations(spark, rows)))
    want = brute(rows)
    assert {x[0]: x[1:5] for x in rows_of(got)} == want


def test_control_strings_occur_only_as_marks(spark):
    rows = [(i, 0, "user", t) for i, t in enumerate(HARD)]
    for x in chat.format_chats(conversations(spark, rows)).collect():
        text = x["formatted"]
        assert text.count("</s>") == 1 and text.endswith("</s>") and text.startswith("<s><|user|>")
        body = text[len("<s><|user|>"):-len("</s>")]
        assert not any(s in body for s in ("<s>", "</s>", "[INST]", "[/INST]", "<|")) and x["loss_spans"] == []


def test_escape_round_trip(spark):
    texts = [t for t in HARD if t is not None]
    r = random.Random(5)
    texts += ["".join(r.choice("<[/\\sINT]>|x") for _ in range(r.randrange(30))) for _ in range(500)]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    assert df.select("t", chat.unescape(chat.escape(F.col("t"))).alias("u")).filter("t <> u").count() == 0
    assert df.select(chat.escape(F.col("t")).alias("e")).distinct().count() == len(set(texts))


def test_merging_and_spans(spark):
    rows = [(1, 0, "user", "q"), (1, 1, "assistant", "a"), (1, 2, "assistant", "b"), (1, 3, "user", "r")]
    x = chat.format_chats(conversations(spark, rows)).first()
    assert x["formatted"] == "<s><|user|>q</s><|assistant|>a<|+|>b</s><|user|>r</s>"
    assert [x["formatted"][s["start"]:s["end"]] for s in x["loss_spans"]] == ["a", "b"]


def test_hostile_and_empty(spark):
    got = rows_of(chat.digest(chat.format_chats(chat.with_hostile(conversations(spark, [])))))
    want = brute([(-1, 0, "user", chat.HOSTILE), (-1, 1, "assistant", chat.HOSTILE)])
    assert [r[:5] for r in got] == [(-1, *want[-1])]
    assert rows_of(chat.format_chats(conversations(spark, []))) == []
    assert sorted(rows_of(chat.format_chats(conversations(spark, [(None, None, None, None)])), "conv_id", "formatted"), key=key) == [(None, "<s><||></s>")]
