"""Language-model scores from a log-frequency Bloom filter.

N-gram counts are quantised to levels 1 + floor(log2 count).  The filter holds,
for an n-gram of level q, the pairs (n-gram, 1) ... (n-gram, q); probing levels
1, 2, ... until the first miss recovers the level, hence the count up to
quantisation.  Probabilities interpolate the orders (Jelinek-Mercer), with a
weight per level of the context, fitted by EM with one occurrence left out on all
training documents.

The filter is a stored table of regions: an n-gram's hash names a bucket, all its bits
lie in the bucket's region, and a region has `BITS_PER_PAIR` bits for every pair that is
put into it.  So the rate of false hits does not depend on the corpus; the number of
buckets follows it.  Regions are filled from counts alone: tasks add up the n-grams of
their training documents, and a bucket's partial counts meet once.

Scoring sees the filter and nothing else.  Texts are cut into chunks and kept as token
streams (word hashes of the chunk, and a code per token), so they are split into words
once.  Regions are broadcast in groups of at most `GROUP_BYTES`.  A task takes up one
group after the other for the chunks it holds and probes their n-grams of the group's
buckets, so it never has more than one group in memory, reads its streams once, and
shuffles neither texts nor scored n-grams.  The filter takes 2 bytes an (n-gram, level)
pair: a larger corpus means more groups of the same size.

A token's probability depends on its levels alone.  Documents keep how often each
combination of levels occurs in them; the sums over the training documents (one
row for each combination) are all that EM needs, and a score is a sum over a
document's combinations.

The add-one base score needs exact counts.  Frequent tokens (at most `HEAD`,
chosen by a histogram of counts) are broadcast; the rest of a document's tokens
is joined to the count table, and the sums meet again by row.

Cases: a null text is empty and has the end token alone; a null id counts as the
empty text for the split; repeated rows are scored alike and each is counted in
training; without training tokens all counts are 0; an empty table gives an empty
result; extra input columns are not read.
"""

from __future__ import annotations

import math
from urllib.parse import unquote

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from zonefare.llm.common import delete_path, materialize, rows_per_batch, stored_table, unsliced
from zonefare.llm.probminhash import mix

ORDER = 2
#: Bits of a region for each (n-gram, level) it holds.
BITS_PER_PAIR = 16
PROBES = 2
#: Frequent tokens that are broadcast with their counts: at most so many, and of at most so many bytes each.
HEAD = 1 << 18
HEAD_TOKEN_BYTES = 64
#: Bytes of the filter in one broadcast, of which a task holds one at a time.
GROUP_BYTES = 8 << 20
#: Tokens of the chunks that a scoring task holds while the groups pass by: about 22 bytes for each.
HELD_TOKENS = 2_200_000
#: Distinct n-grams that a task adds up before it sends them on; adding up takes about 28 bytes for each of at most twice as many.
COUNTED = 1_500_000
TUNING_ROUNDS = 8
BUCKET_TOKENS = 4_000_000
#: Documents that Spark hands to a task at a time.
TEXT_ROWS = 2_000
#: A chunk is a row of token streams: rows of several megabytes would take as much again in the buffers on their way to and from Python.
CHUNK_TOKENS = 250_000
MAX_LEVEL = 40
END = "\n"  # not a word: words hold no white space
GAP_RE2 = r"[ \t\n\x0b\x0c\r]+"


def held_out():
    return F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")) % 7 == 2


# ---- tasks ----------------------------------------------------------------------------------------------

def token_chunks(batches, text: str = "text", lower: bool = True):
    """(rows, dictionary of tokens, token codes, document of each code), END after each document's words."""
    import numpy as np
    import pyarrow as pa
    import pyarrow.compute as pc

    for batch in batches:
        size = np.asarray(pc.fill_null(pc.binary_length(batch.column(batch.schema.get_field_index(text))), 0), np.int64) // 5 + 1
        upto = np.cumsum(size)
        start = 0
        while start < len(batch):
            stop = max(start + 1, int(np.searchsorted(upto, (upto[start - 1] if start else 0) + CHUNK_TOKENS, side="right")))
            part = batch.slice(start, stop - start)
            start = stop
            texts = pc.fill_null(unsliced(part.column(part.schema.get_field_index(text))).cast(pa.large_string()), "")
            texts = pc.ascii_trim(pc.ascii_lower(texts) if lower else texts, " \t\n\x0b\x0c\r")
            lists = pc.split_pattern_regex(texts, GAP_RE2)
            n = np.diff(lists.offsets.to_numpy())
            some = np.asarray(pc.binary_length(texts)) > 0
            words = lists.flatten()
            if not some.all():
                words = words.filter(pa.array(np.repeat(some, n)))
                n = np.where(some, n, 0)
            words = words.dictionary_encode()
            vocab = pa.concat_arrays([words.dictionary, pa.array([END], words.dictionary.type)])
            codes = np.full(len(words) + len(part), len(vocab) - 1, np.int64)
            last = np.cumsum(n + 1) - 1
            at = np.ones(len(codes), bool)
            at[last] = False
            codes[at] = words.indices.to_numpy()
            yield part, vocab, codes, np.repeat(np.arange(len(part)), n + 1)
    pa.default_memory_pool().release_unused()  # the worker lives on and would keep it


def word_hashes(vocab):
    import pandas as pd
    return pd.util.hash_array(vocab.to_numpy(zero_copy_only=False).astype(object), categorize=False)


def ngram_hashes(h, doc, order: int):
    """Hash of the n-gram that ends at each token, for every order; a document starts after a start symbol."""
    import numpy as np
    out, acc = [], None
    with np.errstate(over="ignore"):
        for k in range(order):
            prev = np.full(len(h), np.uint64(0x51A7), np.uint64)
            if k < len(h):
                prev[k:] = h[:len(h) - k]
                same = np.zeros(len(h), bool)
                same[k:] = doc[k:] == doc[:len(h) - k]
                prev[~same] = np.uint64(0x51A7)
            acc = mix(prev + np.uint64(1)) if k == 0 else mix(acc * np.uint64(0x9E3779B97F4A7C15) + prev + np.uint64(k + 1))
            out.append(acc & KEY_MASK)
    return out


#: Keys keep 48 bits of a hash: with 10^9 n-grams two of them share a key once in 3 x 10^5, far under the false hits.
KEY_MASK = 0xFFFFFFFFFFFF0000


def packed(keys) -> bytes:
    """The upper six bytes of every key."""
    import numpy as np
    return np.ascontiguousarray(keys.astype("<u8").view(np.uint8).reshape(-1, 8)[:, 2:]).tobytes()


def unpacked(data):
    import numpy as np
    out = np.zeros((len(data) // 6, 8), np.uint8)
    out[:, 2:] = np.frombuffer(data, np.uint8).reshape(-1, 6)
    return out.reshape(-1).view("<u8").astype(np.uint64)


def _unigram_task():
    def run(batches):
        import numpy as np
        import pyarrow as pa
        for _, vocab, codes, _ in token_chunks(batches):
            n = np.bincount(codes, minlength=len(vocab))
            yield pa.RecordBatch.from_arrays([vocab.cast(pa.string()), pa.array(n)], names=["token", "n"])
    return run


def numbered_chunks(batches):
    """Chunks of a task with their names: task number and position."""
    from pyspark import TaskContext
    pid = TaskContext.get().partitionId()
    for i, chunk in enumerate(token_chunks(batches)):
        yield f"{pid}-{i}", chunk


def stream_schema(id_type: str) -> str:
    """A chunk: its documents (id, split, tokens, exact parts of the base score) and its token stream."""
    return (f"chunk string, ids array<{id_type}>, held array<boolean>, n_tokens array<long>, known_head array<long>, base_head array<double>, "
            "rare array<array<string>>, times array<array<long>>, hashes binary, codes binary")


def _stream_task(head_data, n, v):
    """Texts -> chunks of token streams, with the base score of the frequent tokens."""
    def run(batches):
        import numpy as np
        import pyarrow as pa
        import pyarrow.compute as pc

        tokens, counts = head_data.value
        vars(head_data).pop("_value", None)  # the worker would keep it after its tasks
        for chunk, (part, vocab, codes, doc) in numbered_chunks(batches):
            m = len(part)
            spot = np.asarray(pc.fill_null(pc.index_in(vocab.cast(pa.large_string()), value_set=tokens), -1))
            c = np.where(spot >= 0, counts[spot] if len(counts) else 0, 0)
            common = (spot >= 0)[codes]
            base = np.where(common, np.log10((c[codes] + 1.0) / (n + v + 1.0)), 0.0)
            pair = np.unique(doc[~common] * len(vocab) + codes[~common], return_counts=True)
            ends = pa.array(np.searchsorted(pair[0] // len(vocab), np.arange(m + 1)).astype(np.int32))
            rare = pa.ListArray.from_arrays(ends, vocab.take(pa.array(pair[0] % len(vocab))).cast(pa.string()))
            times = pa.ListArray.from_arrays(ends, pa.array(pair[1].astype(np.int64)))
            # frequent words first: small codes pack well
            order = np.argsort(-np.bincount(codes, minlength=len(vocab)), kind="stable")
            place = np.empty(len(vocab), np.int64)
            place[order] = np.arange(len(vocab))
            all_ = pa.array([0, m], pa.int32())
            one = lambda x: pa.ListArray.from_arrays(all_, x)
            yield pa.RecordBatch.from_arrays([
                pa.array([chunk]), one(unsliced(part.column(part.schema.get_field_index("doc_id")))),
                one(unsliced(part.column(part.schema.get_field_index("held_out")))),
                one(pa.array(np.bincount(doc, minlength=m).astype(np.int64))),
                one(pa.array(np.bincount(doc, common, m).astype(np.int64))), one(pa.array(np.bincount(doc, base, m))),
                one(rare), one(times), pa.array([packed(word_hashes(vocab)[order] & np.uint64(KEY_MASK))], pa.binary()),
                pa.array([place[codes].astype("<u4" if len(vocab) > 1 << 16 else "<u2").tobytes()], pa.binary())],
                names=["chunk", "ids", "held", "n_tokens", "known_head", "base_head", "rare", "times", "hashes", "codes"])
    return run


def read_stream(hashes: bytes, codes: bytes, n_tokens):
    """(word hash of every token, its document) of a chunk."""
    import numpy as np
    h = unpacked(hashes)
    code = np.frombuffer(codes, "<u4" if len(h) > 1 << 16 else "<u2")
    return h[code], np.repeat(np.arange(len(n_tokens)), n_tokens)


def added_up(parts: list):
    """Sorted keys and their summed counts from parts (keys, counts), which are let go on the way."""
    import numpy as np
    keys = np.concatenate([k for k, _ in parts])
    n = np.concatenate([np.asarray(c, np.uint32) for _, c in parts])
    parts.clear()
    order = np.argsort(keys)
    keys, n = keys[order], n[order]
    del order
    first = np.flatnonzero(np.append(True, keys[1:] != keys[:-1])[:len(keys)])
    return keys[first], np.add.reduceat(n, first, dtype=np.int64) if len(first) else n


def bucket_spans(keys, buckets: int):
    """(bucket, start, end) of the buckets that sorted keys lie in."""
    import numpy as np
    edges = np.array([-(-(b << 32) // buckets) << 32 for b in range(1, buckets)], np.uint64)  # least key of each bucket
    cut = np.concatenate([[0], np.searchsorted(keys, edges), [len(keys)]])
    return [(b, int(cut[b]), int(cut[b + 1])) for b in np.flatnonzero(np.diff(cut)).tolist()]


def _count_task(order: int, buckets: int):
    """Counts of the n-grams of a task's training documents, one row for each bucket at a time."""
    def run(batches):
        import numpy as np
        import pyarrow as pa

        held, n_held = [], 0

        def send(keys, n):
            for bucket, a, b in bucket_spans(keys, buckets):
                yield pa.RecordBatch.from_arrays([pa.array([bucket], pa.int32()), pa.array([packed(keys[a:b])], pa.binary()),
                                                  pa.array([n[a:b].astype("<u4").tobytes()], pa.binary())], names=["bucket", "keys", "n"])

        for batch in batches:
            columns = [batch.column(batch.schema.get_field_index(c)) for c in ("hashes", "codes", "n_tokens", "held")]
            for hashes, codes, n_tokens, out in zip(*columns):
                h, doc = read_stream(hashes.as_py(), codes.as_py(), np.asarray(n_tokens.as_py()))
                train = ~np.asarray(out.as_py(), bool)[doc]
                grams = np.concatenate([g[train] for g in ngram_hashes(h, doc, order)])
                keys, n = np.unique(grams, return_counts=True)
                held.append((keys, n.astype(np.uint32)))
                n_held += len(keys)
                del h, doc, train, grams, keys, n
                if n_held > 2 * COUNTED:
                    held.append(added_up(held))
                    n_held = len(held[0][0])
                    if n_held > COUNTED:
                        yield from send(*held.pop())
                        n_held = 0
        if n_held:
            yield from send(*added_up(held))
    return run


def _region_task():
    """The region of a bucket from its partial counts."""
    def run(table):
        import numpy as np
        import pyarrow as pa
        flt = fill_region(*added_up([(unpacked(k.as_py()), np.frombuffer(x.as_py(), "<u4")) for k, x in zip(table.column("keys"), table.column("n"))]))
        return pa.table({"bucket": table.column("bucket")[:1], "size": pa.array([flt.region], pa.int64()),
                         "bits": pa.array([flt.bytes.tobytes()], pa.binary())})
    return run


def _probe_task(groups, order: int, buckets: int):
    """Chunks of token streams -> rows of their documents with the combinations of levels.

    A task holds chunks of `HELD_TOKENS` tokens, loads one group of regions after the other,
    probes the n-grams of its buckets, those of all chunks at once, and lets the group go.
    """
    def run(batches):
        import numpy as np
        import pyarrow as pa

        def keys_of(row):
            field = lambda c: row.column(row.schema.get_field_index(c))
            n_tokens = field("n_tokens").flatten().to_numpy(zero_copy_only=False)
            h, doc = read_stream(field("hashes")[0].as_py(), field("codes")[0].as_py(), n_tokens)
            keys, where = np.unique(np.concatenate(ngram_hashes(h, doc, order)), return_inverse=True)
            spans = {bucket: (a, b) for bucket, a, b in bucket_spans(keys, buckets)}
            row = row.select([c for c in row.schema.names if c not in ("hashes", "codes")]).take(pa.array([0]))  # lets the stream go
            return row, keys, where.astype(np.int32), spans, np.zeros(len(keys), np.uint8)

        def finish(held):
            for (first, last), shared in groups:
                if not any(first <= x <= last for chunk in held for x in chunk[3]):
                    continue
                for bucket, size, bits in shared.value:
                    asked = [(keys, known, *spans[bucket]) for _, keys, _, spans, known in held if bucket in spans]
                    if not asked:
                        continue
                    level, at = Filter(bits, 1, size).levels(np.concatenate([keys[a:b] for keys, _, a, b in asked])), 0
                    for _, known, a, b in asked:
                        known[a:b] = level[at:at + b - a]
                        at += b - a
                bits = None
                vars(shared).pop("_value", None)  # the worker would keep every group it has seen
            while held:
                row, _, where, _, known = held.pop(0)
                field = lambda c: row.column(row.schema.get_field_index(c))  # noqa: E731, B023
                n_tokens = field("n_tokens").flatten().to_numpy(zero_copy_only=False)
                m, level = len(n_tokens), known[where].reshape(order, -1)
                doc = np.repeat(np.arange(m), n_tokens)
                kinds, kind = np.unique(level_tuples(level, doc), return_inverse=True)
                combo = np.unique(doc * len(kinds) + kind, return_counts=True)
                ends = pa.array(np.searchsorted(combo[0] // len(kinds), np.arange(m + 1)).astype(np.int32))
                yield pa.RecordBatch.from_arrays([
                    *(field(c).flatten() for c in ("ids", "held")), pa.array([field("chunk")[0].as_py()] * m, pa.string()), pa.array(np.arange(m)),
                    *(field(c).flatten() for c in ("n_tokens", "known_head", "base_head")),
                    pa.ListArray.from_arrays(ends, pa.array(kinds[combo[0] % len(kinds)])), pa.ListArray.from_arrays(ends, pa.array(combo[1].astype(np.int32))),
                    *(field(c).flatten() for c in ("rare", "times"))],
                    names=["doc_id", "held_out", "chunk", "row", "n_tokens", "known_head", "base_head", "combos", "combo_times", "rare", "times"])

        held = []
        for batch in batches:
            for i in range(len(batch)):
                held.append(keys_of(batch.slice(i, 1)))
                if sum(len(where) for _, _, where, _, _ in held) >= order * HELD_TOKENS:
                    yield from finish(held)
                    held = []
        if held:
            yield from finish(held)
    return run


def bucket_of(keys, buckets: int):
    """Monotone in the hash, so sorted hashes are sorted by bucket."""
    import numpy as np
    return ((keys >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32)).astype(np.int64)


def bit_positions(keys, level: int, region: int):
    import numpy as np
    with np.errstate(over="ignore"):
        x = mix(keys * np.uint64(0xD6E8FEB86659FD93) + np.uint64(level))
    return [((x >> np.uint64(32 * i)) & np.uint64(0xFFFFFFFF)) * np.uint64(region) >> np.uint64(32) for i in range(PROBES)]


def fill_region(keys, n) -> Filter:
    """The filter of one bucket: its size follows the levels of its n-grams that occur in training documents."""
    import numpy as np
    some = n > 0
    keys, level = keys[some], 1 + np.log2(n[some]).astype(int)
    region = max(64, math.ceil(int(level.sum()) * BITS_PER_PAIR / 8) * 8)
    bits = np.zeros(region, bool)
    for j in range(1, int(level.max(initial=0)) + 1):
        for p in bit_positions(keys[level >= j], j, region):
            bits[p.astype(np.int64)] = True
    return Filter(np.packbits(bits, bitorder="little").tobytes(), 1, region)


class Filter:
    """Levels of n-grams by membership probes."""

    def __init__(self, data: bytes, buckets: int, region: int):
        import numpy as np
        self.bytes, self.buckets, self.region = np.frombuffer(data, np.uint8), buckets, region

    def levels(self, keys):
        import numpy as np
        level = np.zeros(len(keys), np.int64)
        alive = np.arange(len(keys))
        for j in range(1, MAX_LEVEL):
            k = keys[alive]
            base = bucket_of(k, self.buckets) * self.region
            hit = np.ones(len(k), bool)
            for p in bit_positions(k, j, self.region):
                at = base + p.astype(np.int64)
                hit &= (self.bytes[at >> 3] >> (at & 7).astype(np.uint8)) & 1 == 1
            alive = alive[hit]
            if not len(alive):
                break
            level[alive] = j
        return level


def expected_count(level):
    """Middle of the counts that share a level; 0 for level 0."""
    import numpy as np
    return np.where(level > 0, (2.0 ** (level - 1) + 2.0 ** level - 1) / 2, 0.0)


def level_tuples(levels, doc):
    """One number for each token: the level of its word, then for each higher order the levels of the n-gram and of
    its context (the n-gram of the order below that ended one token earlier; 0 at a document's start), 6 bits each."""
    import numpy as np
    first = np.concatenate([[True], doc[1:] != doc[:-1]])
    out = levels[0].astype(np.int64)
    for k in range(1, len(levels)):
        ctx = np.concatenate([[0], levels[k - 1][:-1]]).astype(np.int64)
        ctx[first] = 0
        out = (out << 12) + (levels[k].astype(np.int64) << 6) + ctx
    return out


def order_terms(combos, order: int, n: float, v: float, left_out: bool):
    """Unigram probability of every combination of levels, and (ratio, context level) of each higher order."""
    import numpy as np
    less = 1.0 if left_out else 0.0
    uni = (np.maximum(expected_count(combos >> 12 * (order - 1)) - less, 0) + 1) / (n + v + 1)
    terms = []
    for k in range(1, order):
        pair = combos >> 12 * (order - 1 - k)
        level, ctx = pair >> 6 & 63, pair & 63
        ctx_n = np.maximum(expected_count(ctx) - less, 0)
        joint = np.minimum(np.maximum(expected_count(level) - less, 0), ctx_n)
        terms.append((np.divide(joint, ctx_n, out=np.zeros(len(joint)), where=ctx_n > 0), np.where(ctx_n > 0, ctx, 0)))
    return uni, terms


def fit_weights(combos, times, order: int, n: float, v: float):
    """Interpolation weights by EM from the number of training tokens with each combination of levels."""
    import numpy as np
    uni, terms = order_terms(combos, order, n, v, True)
    weights = np.full((order, MAX_LEVEL + 1), 0.2)
    weights[:, 0] = 0.0
    for _ in range(TUNING_ROUNDS):
        got, seen = np.zeros_like(weights), np.zeros_like(weights)
        p = uni
        for k, (ratio, ctx) in enumerate(terms, 1):
            w = weights[k][ctx]
            share = w * ratio
            whole = share + (1 - w) * p
            got[k] = np.bincount(ctx, times * share / whole, MAX_LEVEL + 1)
            seen[k] = np.bincount(ctx, times, MAX_LEVEL + 1)
            p = whole
        weights = (got + 0.02) / (seen + 1.0)
        weights[:, 0] = 0.0
    return weights


def log_probabilities(combos, weights, order: int, n: float, v: float):
    import numpy as np
    p, terms = order_terms(combos, order, n, v, False)
    for k, (ratio, ctx) in enumerate(terms, 1):
        w = weights[k][ctx]
        p = w * ratio + (1 - w) * p
    return np.log10(p)


def _score_task(combos, log_p):
    def run(batches):
        import numpy as np
        import pyarrow as pa
        for batch in batches:
            lists, times = (batch.column(batch.schema.get_field_index(c)) for c in ("combos", "combo_times"))
            doc = np.repeat(np.arange(len(batch)), lists.value_lengths().to_numpy(zero_copy_only=False))
            each = log_p[np.searchsorted(combos, lists.flatten().to_numpy(zero_copy_only=False))] * times.flatten().to_numpy(zero_copy_only=False)
            kept = [c for c in batch.schema.names if c not in ("combos", "combo_times")]
            yield pa.RecordBatch.from_arrays([*(batch.column(batch.schema.get_field_index(c)) for c in kept), pa.array(np.bincount(doc, each, len(batch)))],
                                             names=[*kept, "score"])
    return run


# ---- the operator ---------------------------------------------------------------------------------------

def _head(unigrams: DataFrame, limit: int):
    """(Arrow array of tokens, their counts): all tokens from a count upwards, `limit` at most: the least count is read off a histogram by powers of two."""
    import numpy as np
    import pyarrow as pa

    octave = F.floor(F.log2("n")).cast("int")
    short = unigrams.where(F.octet_length("token") <= HEAD_TOKEN_BYTES)
    hist = {r["o"]: r["c"] for r in short.groupBy(octave.alias("o")).agg(F.count(F.lit(1)).alias("c")).collect()}
    total, least = 0, None
    for o in sorted(hist, reverse=True):  # at most 64 rows
        total += hist[o]
        if total > limit:
            break
        least = o
    if least is None:
        return pa.array([], pa.large_string()), np.zeros(0, np.int64)
    rows = short.where(F.col("n") >= (1 << least)).select("token", "n").toArrow()
    return rows.column("token").combine_chunks().cast(pa.large_string()), rows.column("n").to_numpy()


def region_groups(sizes: list[tuple[int, int]], group_bytes: int) -> list[tuple[int, int]]:
    """Ranges of buckets whose regions (sizes in bits) take at most `group_bytes` together, or one bucket; at least one range."""
    groups, held = [], 0
    for bucket, bits in sorted(sizes):
        if groups and held + bits / 8 <= group_bytes:
            groups[-1] = (groups[-1][0], bucket)
            held += bits / 8
        else:
            groups.append((bucket, bucket))
            held = bits / 8
    return groups or [(0, -1)]


def score_documents(docs: DataFrame, order: int = ORDER, head: int = HEAD, group_bytes: int = GROUP_BYTES) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score of every document."""
    import numpy as np

    spark = docs.sparkSession
    docs = docs.select(F.col("doc_id"), F.col("text").cast("string").alias("text"), held_out().alias("held_out"))
    train = docs.where("NOT held_out").select("doc_id", "text")
    with rows_per_batch(spark, TEXT_ROWS):
        unigrams = materialize(train.mapInArrow(_unigram_task(), "token string, n long").groupBy("token").agg(F.sum("n").alias("n")), "lm-unigrams")
    size = unigrams.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"), F.count(F.lit(1)).alias("v")).first()
    n, v = int(size["n"]), int(size["v"])
    head_data = spark.sparkContext.broadcast(_head(unigrams, head))

    id_type = docs.schema["doc_id"].dataType.simpleString()
    with rows_per_batch(spark, TEXT_ROWS):
        streams, path = stored_table(docs.mapInArrow(_stream_task(head_data, n, v), stream_schema(id_type)), "lm-streams", compression="zstd")
    head_data.destroy()

    buckets = max(int(spark.conf.get("spark.sql.shuffle.partitions")), math.ceil(n * order / BUCKET_TOKENS))
    grams = streams.select("hashes", "codes", "n_tokens", "held").mapInArrow(_count_task(order, buckets), "bucket int, keys binary, n binary")
    with rows_per_batch(spark, 1):
        regions = materialize(grams.groupBy("bucket").applyInArrow(_region_task(), "bucket int, size long, bits binary"), "lm-filter")
    groups = []
    where = {r["bucket"]: (r["size"], unquote(r["file"])) for r in regions.select("bucket", "size", F.input_file_name().alias("file")).collect()}
    for first, last in region_groups([(bucket, size) for bucket, (size, _) in where.items()], group_bytes):
        files = sorted({where[bucket][1] for bucket in range(first, last + 1) if bucket in where})  # no other files are opened for the group
        part = spark.read.schema(regions.schema).parquet(*files).where(F.col("bucket").between(first, last)).collect() if files else []
        groups.append(((first, last), spark.sparkContext.broadcast([(r["bucket"], r["size"], bytes(r["bits"])) for r in part])))
        del part
    with rows_per_batch(spark, 1):
        scored = materialize(streams.mapInArrow(
            _probe_task(groups, order, buckets), f"doc_id {id_type}, held_out boolean, chunk string, row long, n_tokens long, known_head long, "
            "base_head double, combos array<long>, combo_times array<int>, rare array<string>, times array<long>"), "lm-scored")
    delete_path(spark, path)
    for _, shared in groups:
        shared.destroy()

    # a row for each combination of levels: their number is bounded by the levels, not by the corpus
    occurs = scored.select("held_out", F.explode(F.arrays_zip("combos", "combo_times")).alias("x")).groupBy(F.col("x.combos").alias("combo")).agg(
        F.sum(F.when(~F.col("held_out"), F.col("x.combo_times")).otherwise(0)).alias("train")).toPandas().sort_values("combo")
    combos, times = occurs["combo"].to_numpy(np.int64), occurs["train"].to_numpy(float)
    weights = fit_weights(combos, times, order, n, v)
    log_p = log_probabilities(combos, weights, order, n, v)

    result = scored.drop("rare", "times").mapInArrow(
        _score_task(combos, log_p), f"doc_id {id_type}, held_out boolean, chunk string, row long, n_tokens long, known_head long, base_head double, score double")
    rare = scored.select("chunk", "row", F.explode(F.arrays_zip("rare", "times")).alias("x")).select("chunk", "row", F.col("x.rare").alias("token"), F.col("x.times").alias("times"))
    known = rare.join(unigrams, "token", "left").groupBy("chunk", "row").agg(
        F.sum(F.col("times") * F.log10((F.coalesce("n", F.lit(0)) + F.lit(1.0)) / F.lit(n + v + 1.0))).alias("base_rare"),
        F.sum(F.when(F.col("n") > 0, F.col("times")).otherwise(0)).alias("known_rare"))
    return result.join(known, ["chunk", "row"], "left").select(
        "doc_id", "held_out", "n_tokens", (F.col("known_head") + F.coalesce("known_rare", F.lit(0))).alias("n_known"),
        F.lit(n).cast("long").alias("train_tokens"), (F.col("base_head") + F.coalesce("base_rare", F.lit(0.0))).alias("base_score"), "score")
