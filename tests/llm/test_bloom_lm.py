"""Bloom-filter language model: exact base score, probe levels, held-out gain, odd rows."""

import collections
import math
import re
import zlib

import numpy as np
import pytest
from conftest import SF001

from zonefare.llm import bloom_lm


def tokens(text):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x20\x09-\x0D]+", low) + ["<end>"]


def brute(docs):
    held = {i: zlib.crc32(str(d if d is not None else "").encode()) % 7 == 2 for i, (d, _) in enumerate(docs)}
    c = collections.Counter(t for i, (_, x) in enumerate(docs) if not held[i] for t in tokens(x))
    n, v = sum(c.values()), len(c)
    return [(d, held[i], len(tokens(x)), sum(c[t] > 0 for t in tokens(x)), n,
             sum(math.log10((c[t] + 1) / (n + v + 1)) for t in tokens(x))) for i, (d, x) in enumerate(docs)]


def compare(rows, docs):
    key = lambda r: (r[0] is None, r[0] or 0, r[2])
    got = sorted(((r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, r.base_score) for r in rows), key=key)
    want = sorted(brute(docs), key=key)
    assert [g[:5] for g in got] == [w[:5] for w in want]
    assert np.allclose([g[5] for g in got], [w[5] for w in want], rtol=1e-9)
    assert all(r.score < 0 and math.isfinite(r.score) for r in rows)


@pytest.mark.parametrize("head", [1 << 18, 50])
def test_query_base_score(spark, head):
    df = spark.read.parquet(f"{SF001}/documents.parquet")
    docs = [(r.doc_id, r.text) for r in df.collect()]
    rows = bloom_lm.score_documents(df, head=head).collect()
    compare(rows, docs)
    held = [r for r in rows if r.held_out]
    assert sum(r.score for r in held) > sum(r.base_score for r in held)


def test_odd_rows(spark):
    docs = [(1, None), (2, ""), (3, " \t\n "), (None, "A a É é"), (4, "b " * 60_000), (5, "x" * 100_000), (5, "x y"), (5, "x y"), (6, "\x0bq\x0c q\r\nQ")]
    df = spark.createDataFrame([(d, t, 1, "z") for d, t in docs], "doc_id long, text string, n long, score string").repartition(3)
    compare(bloom_lm.score_documents(df).collect(), docs)
    assert bloom_lm.score_documents(df.limit(0)).count() == 0


def test_probes_recover_levels():
    rng = np.random.default_rng(2)
    keys = np.unique(rng.integers(0, 1 << 63, 20_000).astype(np.uint64))
    level = 1 + rng.integers(0, 6, len(keys))
    buckets, region = 7, 1 << 18
    bits = np.zeros(buckets * region, bool)
    for j in range(1, 7):
        k = keys[level >= j]
        for p in bloom_lm.bit_positions(k, j, region):
            bits[bloom_lm.bucket_of(k, buckets) * region + p.astype(np.int64)] = True
    flt = bloom_lm.Filter(np.packbits(bits, bitorder="little").tobytes(), buckets, region)
    got = flt.levels(keys)
    assert (got >= level).all() and (got == level).mean() > 0.98  # a Bloom filter only ever overstates
    assert (flt.levels(rng.integers(0, 1 << 63, 20_000).astype(np.uint64)) > 0).mean() < 0.02


def test_false_hits_do_not_grow_with_the_ngrams():
    rng = np.random.default_rng(3)
    for size in (1_000, 2_000_000):
        keys = np.unique(rng.integers(0, 1 << 63, size).astype(np.uint64))
        n = rng.choice([0, 1, 2, 9], len(keys), p=[0.1, 0.7, 0.1, 0.1])  # 0: n-grams of held-out documents only
        flt = bloom_lm.fill_region(keys, n)
        assert flt.region >= (n > 0).sum() * bloom_lm.BITS_PER_PAIR
        got = flt.levels(keys)
        assert (got >= np.where(n > 0, 1 + np.log2(np.maximum(n, 1)).astype(int), 0)).all()
        assert (got[n == 0] > 0).mean() < 0.05
    assert not hasattr(bloom_lm, "MAX_BITS")


@pytest.mark.parametrize("order", [2, 3])
def test_scores_and_weights_from_all_training_documents(spark, order, monkeypatch):
    """EM and scores, token by token over every document, with levels from exact counts (more bits: no false hits)."""
    monkeypatch.setattr(bloom_lm, "BITS_PER_PAIR", 4096)
    rng = np.random.default_rng(5)
    docs = [(i, " ".join(f"w{int(x)}" for x in rng.zipf(1.4, 12) % 60)) for i in range(900)]
    held = [zlib.crc32(str(d).encode()) % 7 == 2 for d, _ in docs]
    grams = [[[tuple((["<s>"] * k + tokens(x))[j:j + k + 1]) for j in range(len(tokens(x)))] for k in range(order)] for _, x in docs]
    count = collections.Counter(g for h, d in zip(held, grams) if not h for row in d for g in row)
    level = lambda g: count[g].bit_length()
    middle = lambda q: (2.0 ** (q - 1) + 2.0 ** q - 1) / 2 if q else 0.0
    n = sum(len(d[0]) for h, d in zip(held, grams) if not h)
    v = len({g for g in count if len(g) == 1})

    def probability(d, j, w, less, stats=None):
        p = (max(middle(level(d[0][j])) - less, 0) + 1) / (n + v + 1)
        for k in range(1, order):
            q = level(d[k - 1][j - 1]) if j else 0
            below = max(middle(q) - less, 0)
            q = q if below > 0 else 0
            share = w[k][q] * (min(max(middle(level(d[k][j])) - less, 0), below) / below if below else 0.0)
            whole = share + (1 - w[k][q]) * p
            if stats is not None:
                stats[k, q, 0] += share / whole
                stats[k, q, 1] += 1
            p = whole
        return p

    w = [[0.0] + [0.2] * 40 for _ in range(order)]
    for _ in range(bloom_lm.TUNING_ROUNDS):
        stats = collections.Counter()
        for h, d in zip(held, grams):
            for j in range(len(d[0]) if not h else 0):
                probability(d, j, w, 1.0, stats)
        w = [[0.0] + [(stats[k, q, 0] + 0.02) / (stats[k, q, 1] + 1.0) for q in range(1, 41)] for k in range(order)]
    want = {doc: sum(math.log10(probability(d, j, w, 0.0)) for j in range(len(d[0]))) for (doc, _), d in zip(docs, grams)}
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    got = {r.doc_id: r.score for r in bloom_lm.score_documents(df, order=order).collect()}
    assert got.keys() == want.keys() and np.allclose([got[i] for i in want], list(want.values()), rtol=1e-6)


def test_broadcast_filter_alone_gives_the_levels(spark, monkeypatch):
    """The stored regions, probed group by group, give the levels of the exact counts; the number of passes changes nothing."""
    monkeypatch.setattr(bloom_lm, "BITS_PER_PAIR", 4096)
    rng = np.random.default_rng(8)
    docs = [(i, " ".join(f"w{int(x)}" for x in rng.zipf(1.3, 40) % 300)) for i in range(300)] + [(None, None), (900, "")]
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(4)
    seen = []
    groups = bloom_lm.region_groups
    monkeypatch.setattr(bloom_lm, "region_groups", lambda sizes, limit: seen.append(groups(sizes, limit)) or seen[-1])
    one = {r.doc_id: r.score for r in bloom_lm.score_documents(df).collect()}
    many = {r.doc_id: r.score for r in bloom_lm.score_documents(df, group_bytes=200_000).collect()}
    assert len(seen[0]) == 1 and len(seen[1]) > 3
    assert one.keys() == many.keys() and np.allclose([one[i] for i in one], [many[i] for i in one], rtol=1e-12)


def test_region_groups_and_packed_keys():
    assert bloom_lm.region_groups([(i, 800) for i in range(5)], 250) == [(0, 1), (2, 3), (4, 4)]
    assert bloom_lm.region_groups([(3, 8_000_000)], 1) == [(3, 3)] and bloom_lm.region_groups([], 1) == [(0, -1)]
    keys = np.random.default_rng(1).integers(0, 1 << 63, 999).astype(np.uint64) * np.uint64(2) & np.uint64(bloom_lm.KEY_MASK)
    assert (bloom_lm.unpacked(bloom_lm.packed(keys)) == keys).all()


def test_counting_fits_a_small_executor():
    """Adding up counts takes a bounded number of bytes an n-gram (before: about 80, and 8 million n-grams at once)."""
    import tracemalloc

    rng = np.random.default_rng(11)
    draw = rng.integers(0, 1 << 63, 400_000).astype(np.uint64) & np.uint64(bloom_lm.KEY_MASK)
    parts = [np.unique(draw[rng.integers(0, len(draw), 300_000)], return_counts=True) for _ in range(5)]
    want = collections.Counter()
    for k, n in parts:
        want.update(dict(zip(k.tolist(), n.tolist())))
    size = sum(len(k) for k, _ in parts)
    tracemalloc.start()
    keys, n = bloom_lm.added_up(parts)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert dict(zip(keys.tolist(), n.tolist())) == want and (np.diff(keys) > 0).all() and not parts
    assert peak < 40 * size and 40 * 2 * bloom_lm.COUNTED < 200e6
    for buckets in (1, 7, 48, 1000):
        got = bloom_lm.bucket_spans(keys, buckets)
        assert [b for b, s, e in got for _ in range(s, e)] == bloom_lm.bucket_of(keys, buckets).tolist()
    assert bloom_lm.bucket_spans(keys[:0], 7) == [] and all(len(x) == 0 for x in bloom_lm.added_up([(keys[:0], n[:0])]))


def test_counts_sent_in_several_parts(monkeypatch):
    import pyarrow as pa

    monkeypatch.setattr(bloom_lm, "COUNTED", 50)
    rng = np.random.default_rng(12)
    rows, want = [], collections.Counter()
    for _ in range(9):
        h = rng.integers(0, 1 << 63, 40).astype(np.uint64) & np.uint64(bloom_lm.KEY_MASK)
        codes, doc = rng.integers(0, 40, 100), np.repeat([0, 1], [60, 40])
        rows.append((bloom_lm.packed(h), codes.astype("<u2").tobytes(), [60, 40], [False, True]))
        for g in bloom_lm.ngram_hashes(h[codes], doc, 2):
            want.update(g[:60].tolist())
    batch = pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), (pa.binary(), pa.binary(), pa.list_(pa.int64()), pa.list_(pa.bool_())))],
                                       names=["hashes", "codes", "n_tokens", "held"])
    got, sent = collections.Counter(), 0
    for b in bloom_lm._count_task(2, 5)([batch]):
        keys = bloom_lm.unpacked(b.column(1)[0].as_py())
        assert set(bloom_lm.bucket_of(keys, 5).tolist()) == {b.column(0)[0].as_py()}
        got.update(dict(zip(keys.tolist(), np.frombuffer(b.column(2)[0].as_py(), "<u4").tolist())))
        sent += 1
    assert got == want and sent > 5


def test_probing_asks_a_bucket_once_for_all_chunks_held(monkeypatch):
    """A task's look-ups follow the buckets, not buckets times chunks, and what it holds is bounded by tokens (before: by 12 chunks, each asked alone)."""
    import pyarrow as pa

    rng = np.random.default_rng(13)
    words = rng.integers(0, 1 << 63, 60).astype(np.uint64) & np.uint64(bloom_lm.KEY_MASK)
    rows, counts = [], collections.Counter()
    for c in range(30):
        codes, doc = rng.integers(0, 60, 100), np.repeat([0, 1], [60, 40])
        rows.append((f"c{c}", [2 * c, 2 * c + 1], [False, True], [60, 40], [0, 0], [0.0, 0.0], [["x"], []], [[1], []],
                     bloom_lm.packed(words), codes.astype("<u2").tobytes()))
        for g in bloom_lm.ngram_hashes(words[codes], doc, 2):
            counts.update(g[:60].tolist())
    types = (pa.string(), pa.list_(pa.int64()), pa.list_(pa.bool_()), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.list_(pa.float64()),
             pa.list_(pa.list_(pa.string())), pa.list_(pa.list_(pa.int64())), pa.binary(), pa.binary())
    names = ["chunk", "ids", "held", "n_tokens", "known_head", "base_head", "rare", "times", "hashes", "codes"]
    batches = [pa.RecordBatch.from_arrays([pa.array([x], t) for x, t in zip(row, types)], names=names) for row in rows]
    keys = np.array(sorted(counts), np.uint64)
    n = np.array([counts[k] for k in keys.tolist()])
    regions = [(b, f.region, f.bytes.tobytes()) for b, s, e in bloom_lm.bucket_spans(keys, 5) for f in [bloom_lm.fill_region(keys[s:e], n[s:e])]]

    class Shared:
        def __init__(self, held):
            self.held = held

        @property
        def value(self):
            return self.held

    groups = [((0, 1), Shared(regions[:2])), ((2, 4), Shared(regions[2:]))]
    calls, levels = [], bloom_lm.Filter.levels
    monkeypatch.setattr(bloom_lm.Filter, "levels", lambda self, keys: calls.append(len(keys)) or levels(self, keys))
    once = [b.to_pylist() for b in bloom_lm._probe_task(groups, 2, 5)(batches)]
    assert len(calls) == 5 and len(once) == 30 and sum(map(len, once)) == 60
    monkeypatch.setattr(bloom_lm, "HELD_TOKENS", 600)
    calls.clear()
    assert [b.to_pylist() for b in bloom_lm._probe_task(groups, 2, 5)(batches)] == once and len(calls) == 25 and max(calls) <= 1200
    for row, got in zip(rows, once):
        h, doc = bloom_lm.read_stream(row[8], row[9], row[3])
        level = np.stack([bloom_lm.Filter(regions[0][2], 1, regions[0][1]).levels(g) for g in bloom_lm.ngram_hashes(h, doc, 2)])
        first = np.stack([bloom_lm.bucket_of(g, 5) == 0 for g in bloom_lm.ngram_hashes(h, doc, 2)])
        combos = [c for r in got for c in np.repeat(r["combos"], r["combo_times"]).tolist()]
        words_in_first = collections.Counter((level[0][first[0]]).tolist())
        assert len(combos) == 100 and not words_in_first - collections.Counter(c >> 12 for c in combos)
