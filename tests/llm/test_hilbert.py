"""Hilbert-curve sharding: the curve itself, the laws, cases, pruning."""

import itertools
import zlib

import pytest
from pyspark.sql import functions as F

from zonefare.llm import hilbert

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, shard string, size string"


def table(spark, rows):
    return spark.createDataFrame([(i, t, lang, s, 0, "own", "own") for i, t, lang, s in rows], SCHEMA)


@pytest.mark.parametrize("n,bits", [(2, 3), (4, 2)])
def test_curve_visits_every_cell_by_single_steps(spark, n, bits):
    df = spark.range((1 << bits) ** n).select(
        *[F.expr(f"int(shiftright(id, {i * bits}) & {(1 << bits) - 1})").alias(f"c{i}") for i in range(n)])
    rows = hilbert.hilbert_index([f"c{i}" for i in range(n)], bits)(df).orderBy("__curve").collect()
    assert [r["__curve"] for r in rows] == list(range((1 << bits) ** n))
    assert all(sum(abs(a[f"c{i}"] - b[f"c{i}"]) for i in range(n)) == 1 for a, b in itertools.pairwise(rows))


def checked(rows, out, shards=8):
    """Every row once, sizes and checksums right, slots gapless; rows and bytes of the shards."""
    want = sorted((i if i is not None else -1, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for i, t, *_ in rows)
    assert sorted((r.doc_id if r.doc_id is not None else -1, r["size"], r.text_crc32) for r in out) == want
    counts, sizes = [0] * shards, [0] * shards
    for s, group in itertools.groupby(sorted(out, key=lambda r: (r.shard, r.slot)), key=lambda r: r.shard):
        group = list(group)
        assert [r.slot for r in group] == list(range(len(group)))
        counts[s], sizes[s] = len(group), sum(r["size"] for r in group)
    assert all(r.grown_shard is None for r in out)
    return counts, sizes


def rows_of(n):
    # a third of the rows share every dimension but the id; ties, repeated rows, nulls, empty and long texts
    rows = [(i, "hot words " * 5, "en", "src0") for i in range(n // 3)]
    rows += [(n + i, "w" * (i * 37 % 900), "dfe"[i % 3], f"src{i % 11}") for i in range(n // 2)]
    rows += [(5 * n, None, None, None), (5 * n, "", "en", None), (None, "no id", "en", "src1"), (6 * n, "long " * 3000, "en", "src2")]
    return rows + [(7 * n, "the same row", "en", "src3")] * 7


def test_laws(spark, tmp_root):
    rows = rows_of(600)
    out = hilbert.shard_documents(table(spark, rows).repartition(7))
    counts, sizes = checked(rows, out.collect())
    biggest, share = 15001, sum(sizes) / 8
    assert all(abs(s - share) <= biggest for s in sizes)
    hilbert.write_shards(out, f"{tmp_root}/shards")
    assert spark.read.parquet(f"{tmp_root}/shards").groupBy("shard").count().count() == 8
    other = hilbert.shard_documents(table(spark, rows).coalesce(1), law="rows").collect()
    counts, _ = checked(rows, other)
    assert max(counts) - min(counts) <= 1
    # the order along the curve does not depend on the partitions of the input
    along = lambda rs: [(r.doc_id, r.text_crc32) for r in sorted(rs, key=lambda r: (r.shard, r.slot))]
    assert along(out.collect()) == along(other)
    with pytest.raises(ValueError):
        hilbert.shard_documents(table(spark, rows), law="key")


def test_few_and_no_rows(spark):
    few = [(1, "a", None, None), (2, None, "en", "s")]
    checked(few, hilbert.shard_documents(table(spark, few)).collect())
    assert hilbert.shard_documents(table(spark, [])).collect() == []


def test_shards_are_pruned_on_every_dimension(spark):
    rows = [(i, "x" * (1 + 7 * (i * 31 % 50)), f"l{i % 4}", f"s{i * 13 % 16:02d}") for i in range(4096)]
    docs = table(spark, rows).withColumn("row", F.col("doc_id"))
    out = hilbert.shard_documents(docs, shards=32).join(docs.select("doc_id", "lang", "source"), "doc_id")
    # without a curve, a source (16 values, spread evenly over ids) is in all 32 files
    assert hilbert.pruning(out, "source").agg(F.avg("files")).first()[0] < 20
    assert hilbert.pruning(out, "lang").agg(F.avg("files")).first()[0] < 20
