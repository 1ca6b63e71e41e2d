"""Toxicity chain and site quality: held-out accuracy, chain and shrinkage properties, odd rows."""

import random

import numpy as np
from conftest import SF01
from pyspark.sql import functions as F

from zonefare.llm import site_quality, toxicity_chain
from zonefare.llm.common import unit_hash


def test_toxicity_on_held_out_labels(spark):
    docs, labels = spark.read.parquet(f"{SF01}/documents.parquet"), spark.read.parquet(f"{SF01}/labels.parquet")
    test = unit_hash("split", F.col("doc_id")) < 0.3
    out = toxicity_chain.classify(docs, labels.where(~test)).join(labels.where(test).select("doc_id", F.col("toxic").alias("y")), "doc_id").collect()
    hit = [r.toxic for r in out if r.y == 1]
    assert len(hit) > 8 and np.mean(hit) >= 0.7 and not any(r.toxic for r in out if r.y == 0)


def test_chain_feeds_out_of_fold_scores():
    rnd = np.random.default_rng(1)
    n = 300
    first = rnd.random(n) < 0.4
    lists = [np.array([7 if f else 8, 20 + i % 5], np.int32) for i, f in enumerate(first)]
    labels = np.column_stack([first, first])
    a, b = toxicity_chain.train_chain(np.arange(n), labels, np.ones(n), lists)
    assert len(a.w) == 1 + len(a.places) and len(b.w) == 2 + len(b.places) and b.w[1] > 0
    assert set(a.places) == {7, 8}


def test_toxicity_odd_rows(spark):
    rows = [(i, f"word{i % 7} some text " + ("idiot" if i % 4 == 0 else "friend"), 0.5) for i in range(120)]
    rows += [(500, None, 0.5), (501, "", 0.5), (None, "idiot", 0.5), (502, "!!! ...", 0.5), (502, "!!! ...", 0.5), (503, "x " * 50_000, 0.5)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, p_toxic double").repartition(3)
    labels = spark.createDataFrame([(i, int(i % 4 == 0)) for i in range(120)] + [(None, 1), (7, None), (9999, 1)], "doc_id long, toxic int")
    out = {r.doc_id: r for r in toxicity_chain.classify(docs, labels).collect()}
    assert all(out[i].toxic == (i % 4 == 0) for i in range(120)) and out[None].toxic and not out[500].toxic and not out[501].toxic
    assert toxicity_chain.classify(docs, labels).count() == len(rows)
    none = toxicity_chain.classify(docs, labels.limit(0)).collect()
    assert not any(r.toxic for r in none) and len(none) == len(rows)
    assert toxicity_chain.classify(docs.limit(0), labels).count() == 0


def test_site_quality_on_held_out_labels(spark):
    docs = spark.read.parquet(f"{SF01}/documents.parquet")
    labels = spark.read.parquet(f"{SF01}/labels.parquet").select("doc_id", F.col("quality").cast("int").alias("quality"))
    test = unit_hash("split", F.col("doc_id")) < 0.3
    out = site_quality.judge(docs, labels.where(~test), F.col("source"), F.col("lang")).join(
        labels.where(test).withColumnRenamed("quality", "y"), "doc_id").collect()
    assert np.mean([r.kept for r in out if r.y == 1]) >= 0.98 and np.mean([r.kept for r in out if r.y == 0]) <= 0.15


def test_sparse_sites_shrink_and_rich_ones_speak(spark):
    rnd = random.Random(2)
    rows = [(f"good{h}", "a", 0.9 if rnd.random() < 0.95 else 0.1) for h in range(10) for _ in range(200)]
    rows += [(f"bad{h}", "a", 0.1 if rnd.random() < 0.9 else 0.9) for h in range(5) for _ in range(200)]
    rows += [("new", "a", 0.1), ("good0", "rare", 0.1), (None, None, 0.5), (None, None, 0.5)]
    ev = spark.createDataFrame(rows, "host string, path string, p_text double")
    out = site_quality.posterior(ev, site_quality.site_tables(ev)).collect()
    assert len(out) == len(rows)
    rate = lambda h, p: np.mean([r.path_rate for r in out if r.host == h and r.path == p])
    overall = np.mean([p for _, _, p in rows])
    assert rate("good1", "a") > 0.8 and rate("bad1", "a") < 0.25
    assert abs(rate("new", "a") - overall) < 0.02  # alone on its site: the global rate
    assert rate("good0", "rare") > overall + 0.1  # a rare path leans on its host
    assert all((r.p_good > r.p_text) == (r.path_rate > overall) for r in out if r.host == "good1")


def test_site_quality_odd_rows(spark):
    docs = spark.createDataFrame([(1, None, "h", None), (2, "", None, "p"), (3, "plain words in a row here", "h", "p"), (3, "plain words in a row here", "h", "p"),
                                  (None, "w *** " * 2000, "h", "p")], "doc_id long, text string, host string, kept string")
    labels = spark.createDataFrame([], "doc_id long, quality int")
    out = site_quality.judge(docs, labels, F.col("host"), F.col("kept")).collect()
    assert len(out) == 5 and not any(r.kept for r in out if r.doc_id in (1, 2))
    assert site_quality.judge(docs.limit(0), labels, F.col("host"), F.col("kept")).count() == 0
    urls = spark.createDataFrame([("https://www.A.example.com:80/en/7?x=1",), ("http://m.b.org",), (None,)], "u string")
    got = [(r.h, r.p) for r in urls.select(site_quality.url_host(F.col("u")).alias("h"), site_quality.url_path(F.col("u")).alias("p")).collect()]
    assert got == [("a.example.com", "en"), ("m.b.org", ""), (None, None)]
