"""Prefix counts against the sentencepiece library."""

import random
import time

import pytest
import sentencepiece
from conftest import SF001

from zonefare.llm import prefix_tokens
from zonefare.llm.prefix_tokens import PrefixCounter, default_model


@pytest.fixture(scope="module")
def sp():
    return sentencepiece.SentencePieceProcessor(model_file=default_model())


def test_query_against_the_library(spark, sp):
    from zonefare.llm.queries import QUERIES
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SF001}/documents.parquet").collect()}
    rows = QUERIES["op5_prefix_token_counts"](spark, SF001).collect()
    assert len(rows) == len(texts)
    for r in rows:
        assert (r.n_bytes, r.n_tokens) == (len(texts[r.doc_id].encode()), len(sp.encode(texts[r.doc_id])))
        assert r.over_limit == (r.n_tokens > 4096)


def test_every_prefix(spark, sp):
    c = PrefixCounter(default_model())
    rnd = random.Random(1)
    alphabet = "aaeeinorst  \n\t.,12▁é日本ü<>s/\x01\U0001f600THEing"
    texts = ["".join(rnd.choice(alphabet) for _ in range(rnd.randint(0, 60))) for _ in range(150)]
    texts += [" " * 37 + "x" + " " * 21, "<s>a</s><unk><0x0A>", "▁▁a", "international internationalisation 1000000", "\x00\x01", "ﬁ　x"]
    texts += [r.text[:300] for r in spark.read.parquet(f"{SF001}/documents.parquet").limit(60).collect()]
    for t in texts:
        assert c.counts(t) == [len(sp.encode(t[:i])) for i in range(len(t) + 1)], t
        for budget in (0, 1, 5, 17, 1000):
            want = max(i for i in range(len(t) + 1) if len(sp.encode(t[:i])) <= budget)
            assert c.fitting(t, budget) == want


def test_odd_rows_truncation_and_long_words(spark, sp):
    rows = [(1, None, 5), (2, "", 5), (3, "word " * 9000, 5), (4, "ab" * 60_000, 5), (5, "x y", 5), (5, "x y", 5), (None, "日" * 3000, 5)]
    df = spark.createDataFrame(rows, "doc_id long, text string, n_tokens int").repartition(2)
    t = time.time()
    out = prefix_tokens.count_tokens(df).collect()
    assert time.time() - t < 60
    want = sorted((str(d), len((x or "").encode()), len(sp.encode(x or ""))) for d, x, _ in rows)
    assert sorted((str(r.doc_id), r.n_bytes, r.n_tokens) for r in out) == want
    cut = prefix_tokens.truncate(df, 100).collect()
    assert cut[0].asDict().keys() == {"doc_id", "text", "n_tokens"} and all(r.n_tokens == 5 for r in cut)
    assert all(len(sp.encode(r.text or "")) <= 100 for r in cut) and sum(r.text is None for r in cut) == 1
    table = prefix_tokens.prefix_counts(df.where("doc_id = 5")).collect()
    assert [r.counts for r in table] == [[0, 1, 2, 2]] * 2 or [r.counts[-1] for r in table] == [len(sp.encode("x y"))] * 2
    assert prefix_tokens.count_tokens(df.limit(0)).count() == 0
