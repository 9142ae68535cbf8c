"""The registered queries on the smallest tables, against SQL or brute force."""

from __future__ import annotations

import math
import os
import zlib
from collections import Counter

import duckdb
import pytest

import __spark_entry__ as entry
import corpus_pipeline as cp
from tests.llm.fixtures import documents, rows_of, words
from tests.llm.test_near_dedup import brute as brute_groups
from tests.llm.test_search_scan import brute_hits
from waferline.llm import language_id, queries

DIR = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(DIR), reason="needs the test tables")


def plain(rows):
    return sorted((tuple(round(x, 6) if isinstance(x, float) else x for x in r) for r in rows), key=str)


@pytest.mark.parametrize("name", sorted(queries.oracle_sql()))
def test_against_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "conversations", "embeddings", "benchmark"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{DIR}/{t}.parquet'")
    df = entry.queries()[name](spark, DIR)
    cols = sorted(df.columns)
    want = con.sql(f"SELECT {', '.join(cols)} FROM ({entry.oracle_sql()[name]})").fetchall()
    assert plain(rows_of(df, *cols)) == plain(want)


def test_all_are_registered():
    names = [n for n in entry.queries() if n.startswith("op") or n == "pipeline"]
    assert sorted({n.split("_")[0] for n in names}) == sorted([f"op{k}" for k in range(1, 14)] + ["pipeline"])


def test_pipeline_against_brute_force(spark):
    """Stages 2 to 5 in plain Python, after the learned first stage."""
    docs = spark.read.parquet(f"{DIR}/documents.parquet")
    rows = [tuple(r) for r in docs.select("doc_id", "text", "lang", "source").collect()]
    model = language_id.fit(language_id.training_rows(docs))
    rows = [r for r in rows if not model.predict(r[1])[2]]
    assert len(rows) >= docs.count() - 2
    rows = [r for r, g in zip(rows, brute_groups(rows)) if g[3]]
    items = [tuple(r) for r in spark.read.parquet(f"{DIR}/benchmark.parquet").select("item_id", "text").collect()]
    rows = [r for r, h in zip(rows, brute_hits(rows, items)) if not h[5]]
    step = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    from tests.llm.test_mix_shard import targets
    sizes = Counter()
    for r in rows:
        sizes[r[3]] += len(words(r[1]))
    want, line, t = Counter(), Counter(), targets(sizes)
    import hashlib
    for r in sorted(rows, key=lambda r: int(hashlib.md5(f"mix|{r[0]}".encode()).hexdigest()[:12], 16)):
        s, n = r[3], len(words(r[1]))
        take, a = min(math.floor(t[s] + 0.5), 2 * sizes[s]), line[s]
        line[s] += n
        if n:
            got = sum(max(0, min(a + n + e * sizes[s], take) - a - e * sizes[s]) for e in (0, 1))
            want[r[0]] += math.ceil(got / n)
    out = rows_of(cp.run(spark, DIR), "doc_id", "size", "text_crc32", "shard", "slot")
    assert Counter(r[0] for r in out) == +want and step.count() == len(rows)
    text = {r[0]: r[1] for r in rows}
    assert all(r[1] == len(text[r[0]].encode()) + 1 and r[2] == zlib.crc32(text[r[0]].encode()) for r in out)
    per = Counter(r[3] for r in out)
    assert max(per.values()) - min(per.values()) <= 1 and len({r[3:] for r in out}) == len(out)


def test_pipeline_stages_on_an_empty_table(spark):
    docs = documents(spark, []).select("doc_id", "text", "lang", "source", "n_chars")
    for _, stage in cp.STAGES[:-1]:
        out = stage(spark, docs, DIR)
        assert out.columns == docs.columns and out.count() == 0
    assert cp.STAGES[-1][1](spark, docs, DIR).count() == 0
