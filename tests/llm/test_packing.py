"""Mixture-controlled packing against the tokenizers library and a plain simulation."""

import random
import zlib
from collections import defaultdict

import numpy as np
import pytest
from conftest import SF001
from pyspark.sql import Row

from zonefare.llm import packing
from zonefare.llm.packing import Schedule, load_encoder, pack, sequences


@pytest.mark.parametrize("seed", range(12))
def test_schedule_is_a_gapless_permutation(seed):
    rnd = random.Random(seed)
    totals = [rnd.choice([0, 1, rnd.randint(1, 400)]) for _ in range(rnd.randint(1, 6))]
    weights = [rnd.choice([0, 1, rnd.randint(1, 90)]) for _ in totals]
    s = Schedule(totals, weights, rnd.choice([1, 7, 16, 64]))
    seen, source = set(), {}
    for q, t in enumerate(totals):
        x = 0
        while x < t:  # documents of random length
            n = min(t - x, rnd.randint(1, 50))
            for start, pos, room in s.place(q, x, n):
                for i in range(room):
                    assert pos + i not in seen
                    seen.add(pos + i)
                    source[pos + i] = (q, start + i)
            x += n
    assert seen == set(range(sum(totals)))
    for q in range(len(totals)):  # a queue keeps its order
        mine = [source[p][1] for p in sorted(source) if source[p][0] == q]
        assert mine == sorted(mine)


def test_windows_follow_the_weights_with_carried_deficits():
    weights = [50, 30, 20, 1]
    s = Schedule([5000, 3000, 2000, 100], weights, 64)
    served = defaultdict(lambda: [0] * 4)
    for q, t in enumerate([5000, 3000, 2000, 100]):
        for _, pos, n in s.place(q, 0, t):
            served[pos // 64][q] += n
    run = [0] * 4
    for w in range(90):
        run = [a + b for a, b in zip(run, served[w])]
        assert sum(served[w]) == 64
        for q in range(4):
            assert abs(run[q] - (w + 1) * 64 * weights[q] / 101) < 1


def test_short_end_is_cut_into_powers_of_two():
    out = list(sequences(1024 + 700, 0, 1724, 1024))
    assert [n for _, _, n in out] == [1024, 512, 128, 32, 16, 8, 4]
    assert [s for s, _, _ in out] == list(range(7)) and all(o == 0 for _, o, _ in out)


def brute_ids():
    from tokenizers import Tokenizer
    tok = Tokenizer.from_file(packing.default_tokenizer())
    return lambda t: tok.encode(t or "", add_special_tokens=False).ids + [0]


def verify(rows, docs, size=1024):
    ids = brute_ids()
    want = defaultdict(list)
    for d, t in docs:
        want[d].append(ids(t))
    by_doc, by_seq = defaultdict(list), defaultdict(list)
    for r in rows:
        by_doc[r.doc_id].append(r)
        by_seq[r.sequence_id].append(r)
    assert set(by_doc) == set(want)
    for d, pieces in by_doc.items():
        if len(want[d]) > 1:
            continue
        x, at = want[d][0], 0
        for p in sorted(pieces, key=lambda p: p.start):
            assert p.start == at and p.doc_tokens == len(x)
            assert p.ids_crc32 == zlib.crc32(np.asarray(x[p.start:p.start + p.length], "<u4").tobytes())
            at += p.length
        assert at == len(x)
    assert sum(r.length for r in rows) == sum(len(x) for xs in want.values() for x in xs)
    assert sorted(by_seq) == list(range(len(by_seq)))
    for s, pieces in by_seq.items():
        at = 0
        for p in sorted(pieces, key=lambda p: p.offset):
            assert p.offset == at
            at += p.length
        assert at == size or (at < size and at & (at - 1) == 0)


def test_query_against_brute_force(spark):
    from zonefare.llm.queries import QUERIES
    rows = QUERIES["op10_mixture_packing"](spark, SF001).collect()
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF001}/documents.parquet").collect()]
    verify(rows, docs)


def test_odd_rows(spark):
    text = "word <|endoftext|> x\n\n  y   z é你 " * 5
    data = [Row(doc_id=1, source="src0", text=None, start=5, offset=1), Row(doc_id=2, source=None, text="", start=5, offset=1),
            Row(doc_id=3, source="new", text=text, start=5, offset=1), Row(doc_id=3, source="new", text=text, start=5, offset=1),
            Row(doc_id=4, source="src1", text="a b " * 30000, start=5, offset=1), Row(doc_id=5, source="src0", text="   \n ", start=5, offset=1)]
    df = spark.createDataFrame(data, "doc_id long, source string, text string, start long, offset long").repartition(3)
    rows = pack(df, window_sequences=2).collect()
    verify(rows, [(r.doc_id, r.text) for r in data])
    with_ids = pack(df, {"src0": 0.5, "src1": 0.0}, window_sequences=1, with_ids=True).collect()
    assert all(zlib.crc32(np.asarray(r.ids, "<u4").tobytes()) == r.ids_crc32 for r in with_ids)
    verify(with_ids, [(r.doc_id, r.text) for r in data])
    assert pack(df.limit(0)).count() == 0


def test_fast_encoder_equals_the_library(spark):
    encode, size = load_encoder(packing.default_tokenizer())
    ids = brute_ids()
    assert size == 50257
    for r in spark.read.parquet(f"{SF001}/documents.parquet").collect():
        assert [*encode(r.text), 0] == ids(r.text)
    rnd = random.Random(3)
    for _ in range(300):
        t = "".join(rnd.choice(" \n\t abzAZ09'.,!sdtlveméß你\U0001f600‍") for _ in range(rnd.randint(0, 40)))
        assert [*encode(t), 0] == ids(t)


def test_library_path_for_other_files():
    import public_tokenizers
    from tokenizers import Tokenizer
    p = public_tokenizers.path("word_bpe_49k.json")
    encode, _ = load_encoder(p)
    assert encode("Hello big World") == Tokenizer.from_file(p).encode("Hello big World", add_special_tokens=False).ids


@pytest.mark.parametrize("gap", [" " * 2_000_000, "\n" * 300_000, "\t \r" * 50_000, "\u2003" * 60_000])
def test_long_white_space(gap):
    from tokenizers import Tokenizer
    encode, _ = load_encoder(packing.default_tokenizer())
    library = Tokenizer.from_file(packing.default_tokenizer())
    for text in (gap,) if len(gap) > 400_000 else (gap, f"a{gap}b <|endoftext|> c", f"{gap}x"):
        assert encode(text) == library.encode(text, add_special_tokens=False).ids
