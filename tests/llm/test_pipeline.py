"""The corpus pipeline, stage by stage against plain twins, odd tables, and the tables it leaves."""

import collections
import os
import re
import zlib

import corpus_pipeline as P
from conftest import SF001
from test_near_and_quality import brute_classes

from zonefare.llm import common, mixing, packing, pii, quality_mcd

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, shard int, class_id string, mix_copy string, kept string"


def odd_table(spark):
    body = "the quick brown fox jumps over a lazy dog near the old river bank while nobody looks "
    rows = [(i, body + f"and counts {i * 7919} small grey stones in the evening light", "en", f"src{i % 4}") for i in range(40)]
    rows += [(100, None, "en", "src0"), (101, "", None, None), (None, body + "without any number at all here", None, None)]
    rows += [(102, body + "twice the very same row here", "en", "src1")] * 3 + [(103, "write to a.b@example.org " + body, "fr", None)]
    rows += [(104, " ".join(f"long{i}" for i in range(60_000)), "en", "src2")]
    return spark.createDataFrame([(i, t, lang, s, len(t or ""), 9, "own", "own", "own") for i, t, lang, s in rows], SCHEMA).repartition(3)


def rows_of(df):
    return collections.Counter((r.doc_id, r.text) for r in df.collect())


def test_stages_against_plain_twins(spark):
    stages = dict(P.STAGES)
    docs = odd_table(spark)
    cols = docs.columns

    kept = common.materialize(stages["quality"](spark, docs, SF001), "t")
    for r in kept.collect():  # the base rules, by plain Python
        w = re.findall(r"[^\x20\x09-\x0D]+", r.text or "")
        runs = collections.defaultdict(list)
        for i in range(len(w) - 4):
            runs[tuple(w[i:i + 5])].append(i)
        covered = {i + k for at in runs.values() if len(at) > 1 for i in at for k in range(5)}
        assert len(w) >= 10 and 100 * len(covered) <= 20 * len(w)
    verdict = {(r.doc_id, r.kept) for r in quality_mcd.quality_verdicts(docs).select("doc_id", "kept").collect()}
    assert {(r.doc_id, True) for r in kept.collect()} <= verdict and kept.columns == cols

    unique = common.materialize(stages["near_duplicates"](spark, kept, SF001), "t")
    by_row = list(enumerate(r.text for r in sorted(kept.collect(), key=lambda r: (r.doc_id is not None, r.doc_id))))
    assert unique.columns == cols and unique.count() == len(set(brute_classes(by_row).values()))
    assert not rows_of(unique) - rows_of(kept)

    clean = common.materialize(stages["personal_data"](spark, unique, SF001), "t")
    assert clean.columns == cols and clean.count() == unique.count()
    assert all(r.n_chars == len(r.text) and not re.search(r"[A-Za-z0-9]@[A-Za-z0-9-]+\.[A-Za-z]", r.text) for r in clean.collect())
    same = {r.doc_id for r in pii.find_personal_data(unique.select("doc_id", "text")).where("spans = ''").select("doc_id").collect()}
    before = {r.doc_id: r.text for r in unique.collect()}
    assert all(r.text == before[r.doc_id] for r in clean.collect() if r.doc_id in same)

    mixed = common.materialize(stages["mixing"](spark, clean, SF001), "t")
    want = mixing.poisson_replicate(clean, mixing.TARGET_WEIGHTS).groupBy("doc_id").count().collect()
    assert mixed.columns == cols and collections.Counter(r.doc_id for r in mixed.collect()) == {r.doc_id: r["count"] for r in want}

    pieces = stages["packing"](spark, mixed, SF001).collect()
    encode, _ = packing.load_encoder(packing.default_tokenizer())
    texts = rows_of(mixed)
    tokens = {k: [*encode(k[1] or ""), packing.END_ID] for k in texts}
    assert sum(r.length for r in pieces) == sum(len(tokens[k]) * n for k, n in texts.items())
    whole = collections.Counter((k[0], zlib.crc32(b"".join(t.to_bytes(4, "little") for t in tokens[k]))) for k, n in texts.items()
                                for _ in range(n) if len(tokens[k]) <= 1024)
    found = collections.Counter((r.doc_id, r.ids_crc32) for r in pieces if r.length == r.doc_tokens)
    assert not found - whole  # pieces that are whole documents hold their ids
    for _, at in collections.Counter((r.sequence_id, r.offset) for r in pieces).items():
        assert at == 1


def test_empty_table_and_freed_tables(spark):
    left = len(common.stored_tables(spark))
    assert P.run(spark, SF001).count() > 0
    per_run = len(common.stored_tables(spark)) - left
    assert per_run < 12  # the last stage's own tables, its input and what that one reads
    docs = spark.read.parquet(f"{SF001}/documents.parquet").limit(0)
    for _, stage in P.STAGES:
        docs = common.materialize(stage(spark, docs, SF001), "t")
    assert docs.count() == 0


def test_freeing_keeps_what_is_read(spark):
    a, path = common.stored_table(spark.range(5), "t")
    b, other = common.stored_table(spark.range(3), "t")
    common.free_tables(spark, [path, other], a.join(spark.range(9), "id"))
    assert a.count() == 5 and path in common.stored_tables(spark) and other not in common.stored_tables(spark)
    assert not os.path.exists(other.replace("file:", ""))
