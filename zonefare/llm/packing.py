"""Mixture-controlled packing by deficit round-robin over source queues.

Documents of a component (a source with a weight of its own, or the rest) wait
in one queue.  A window is `window_sequences` sequences; in every window each
queue is served its quantum, weight share * window tokens.  What rounding leaves
unserved is the queue's deficit and is carried to its next window, so over any
run of windows a queue is within one token of its target.  When a queue cannot
give its quantum, one window takes what it has and the other queues fill up in
proportion; later windows share among the queues left.  Documents are cut where
a slot or a sequence ends, so every window is full; the last short sequence is
laid out as sequences of power-of-two lengths, which need no padding.

Serving quanta with carried deficits is cumulative rounding, so the schedule has
a closed form: at most two entries per queue, computed from the queues' totals.
A task places a document from its position in its queue alone.  That position is
(tokens of its queue in earlier partitions) + (tokens earlier in its own one), so
windows and deficits run across partitions without any task seeing a queue.

Texts are encoded once; ids go to a table in the shared folder with partition
number and running position, and are read back for placement.  Only the offset
table (partition x queue) is joined, unhinted, and only totals per queue (one per
weight) reach the driver.

Cases: null text is empty and has the end id alone; null or unnamed sources wait
in the rest queue; a queue with weight 0 is served after the weighted ones;
repeated rows are packed as often as they come; an empty table gives an empty
result; input columns other than id, source and text are not read.
"""

from __future__ import annotations

import bisect
import json
import re
import zlib
from collections.abc import Callable, Iterator

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from zonefare.llm.common import materialize
from zonefare.llm.mixing import REST, TARGET_WEIGHTS

SEQUENCE = 1024
WINDOW_SEQUENCES = 64
END_ID = 0
#: Weights are rounded to this many parts.
PARTS = 1_000_000

# Fixed value: the pre-tokenisation pattern of byte-level BPE tokenizers.
BYTE_LEVEL_PATTERN = (r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+""")

#: A text with a run of this many white-space characters goes to the tokenizers library, which has no limit on them.
LONG_GAP = 20_000


def default_tokenizer() -> str:
    import public_tokenizers
    return public_tokenizers.path("byte_bpe_50k.json")


def byte_characters() -> dict[str, int]:
    """Character of a byte-level vocabulary -> byte: printable bytes stand for themselves, the others follow from 256."""
    plain = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
    others = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(others)}


def load_encoder(path: str) -> tuple[Callable[[str], list[int]], int]:
    """(text -> ids without added special tokens, size of the vocabulary) of a tokenizers file.

    A byte-level BPE whose merges come in the order of their ids is the same
    function of merge ranks, which tiktoken computes several times faster; any
    other file is encoded by the tokenizers library.
    """
    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    model, pre = spec["model"], spec.get("pre_tokenizer") or {}
    special = {t["content"]: t["id"] for t in spec.get("added_tokens", [])}
    simple = (model.get("type") == "BPE" and pre.get("type") == "ByteLevel" and not pre.get("add_prefix_space")
              and pre.get("use_regex", True) and not spec.get("normalizer") and not model.get("ignore_merges")
              and not any(t.get(k) for t in spec.get("added_tokens", []) for k in ("single_word", "lstrip", "rstrip", "normalized")))
    if simple:
        vocab, to_byte = model["vocab"], byte_characters()
        pairs = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        ids = [vocab[a + b] for a, b in pairs]
        simple = ids == sorted(ids) and len(ids) + 256 == len([t for t in vocab if t not in special])
    if simple:
        import tiktoken
        ranks = {bytes(to_byte[c] for c in t): i for t, i in vocab.items() if t not in special}
        enc = tiktoken.Encoding("bytes", pat_str=BYTE_LEVEL_PATTERN, mergeable_ranks=ranks, special_tokens=special)
        gap, library = re.compile(rf"\s{{{LONG_GAP}}}"), []

        def encode(text: str) -> list[int]:
            if len(text) >= LONG_GAP and gap.search(text):  # beyond the backtracking of the faster one
                if not library:
                    from tokenizers import Tokenizer
                    library.append(Tokenizer.from_file(path))
                return library[0].encode(text, add_special_tokens=False).ids
            return enc.encode(text, allowed_special="all")

        return encode, max([*vocab.values(), *special.values()]) + 1
    from tokenizers import Tokenizer
    tok = Tokenizer.from_file(path)
    return (lambda text: tok.encode(text, add_special_tokens=False).ids), tok.get_vocab_size()


# ---- the schedule ---------------------------------------------------------------------------------------

class Schedule:
    """Position in a queue -> position in the packed stream, in closed form.

    `totals`: tokens per queue; `weights`: integer weight per queue.
    """

    def __init__(self, totals: list[int], weights: list[int], window: int):
        self.window, self.total = window, sum(totals)
        self.runs: list[list[tuple]] = [[] for _ in totals]  # (first position in the queue, first window, serve)
        taken, at = [0] * len(totals), 0
        while (rest := self.total - sum(taken)) > 0:
            left = [t - k for t, k in zip(totals, taken)]
            active = [i for i, r in enumerate(left) if r and weights[i]] or [i for i, r in enumerate(left) if r]
            share = [weights[i] if any(weights[j] for j in active) else 1 for i in active]
            bounds = [0]
            for s in share:
                bounds.append(bounds[-1] + s)
            n = self._windows(left, active, bounds, rest // window)
            if n:
                for k, i in enumerate(active):
                    self.runs[i].append((taken[i], at, (bounds[k], bounds[k + 1], bounds[-1], None)))
                    taken[i] += self._served(n, bounds[k], bounds[k + 1], bounds[-1])
                at += n
                continue
            give = self._last_window(left, weights, min(window, rest))
            offset = 0
            for i, g in enumerate(give):
                if g:
                    self.runs[i].append((taken[i], at, (0, 0, 0, (offset, g))))
                    taken[i] += g
                    offset += g
            at += 1
        self.starts = [[r[0] for r in runs] for runs in self.runs]

    def _served(self, n: int, low: int, high: int, total: int) -> int:
        """Tokens a queue has been served after n windows: cumulative rounding, deficit under one token."""
        return n * self.window * high // total - n * self.window * low // total

    def _windows(self, left, active, bounds, most: int) -> int:
        """Full windows until a queue cannot give its quantum."""
        lo, hi = 0, most
        while lo < hi:
            mid = (lo + hi + 1) // 2
            ok = all(self._served(mid, bounds[k], bounds[k + 1], bounds[-1]) <= left[i] for k, i in enumerate(active))
            lo, hi = (mid, hi) if ok else (lo, mid - 1)
        return lo

    @staticmethod
    def _last_window(left: list[int], weights: list[int], need: int) -> list[int]:
        """One window when a queue runs out: it gives what it has, the others fill up in proportion."""
        give = [0] * len(left)
        while need:
            able = [i for i in range(len(left)) if left[i] > give[i]]
            able = [i for i in able if weights[i]] or able
            share = [weights[i] or 1 for i in able]
            run = served = filled = 0
            for i, x in zip(able, share):
                run += x
                quantum = need * run // sum(share) - served
                served += quantum
                more = min(quantum, left[i] - give[i])
                give[i] += more
                filled += more
            need -= filled
        return give

    def place(self, queue: int, start: int, length: int) -> Iterator[tuple[int, int, int]]:
        """Slots (first token of the range, its stream position, tokens) of a range of a queue."""
        end = start + length
        while start < end:
            k = bisect.bisect_right(self.starts[queue], start) - 1
            first, at, (low, high, total, once) = self.runs[queue][k]
            x = start - first
            if once:
                offset, size = once
                pos, room = at * self.window + offset + x, size - x
            else:
                j = x * total // (self.window * (high - low))
                while self._served(j, low, high, total) > x:
                    j -= 1
                while self._served(j + 1, low, high, total) <= x:
                    j += 1
                slot = (j + 1) * self.window * low // total - j * self.window * low // total
                pos = (at + j) * self.window + slot + x - self._served(j, low, high, total)
                room = self._served(j + 1, low, high, total) - x
            n = min(room, end - start)
            yield start, pos, n
            start += n


def sequences(total: int, pos: int, length: int, size: int) -> Iterator[tuple[int, int, int]]:
    """(sequence, offset, tokens) of a stretch of the stream; the short end is cut into powers of two."""
    full = total // size
    while length:
        if pos < full * size:
            seq, off = divmod(pos, size)
            room = size - off
        else:
            seq, off, rest = full, pos - full * size, total - full * size
            while True:
                room = 1 << (rest.bit_length() - 1)
                if off < room:
                    break
                seq, off, rest = seq + 1, off - room, rest - room
            room -= off
        n = min(room, length)
        yield seq, off, n
        pos, length = pos + n, length - n


# ---- tasks ----------------------------------------------------------------------------------------------

def _encode_task(path: str, names: list[str]):
    def run(batches):
        import numpy as np
        import pyarrow as pa
        from pyspark import TaskContext

        encode, size = load_encoder(path)
        kind = "<u2" if size <= 1 << 16 else "<u4"
        pid, served = TaskContext.get().partitionId(), [0] * (len(names) + 1)
        index = {n: i for i, n in enumerate(names)}
        schema = pa.schema([("doc_id", pa.int64()), ("pid", pa.int32()), ("queue", pa.int32()), ("start", pa.int64()),
                            ("n", pa.int64()), ("ids", pa.binary())])
        rows, held = [], 0
        for batch in batches:
            for doc, source, text in zip(batch[0], batch[1], batch[2]):
                q = index.get(source.as_py(), len(names))
                ids = np.asarray([*encode(text.as_py() or ""), END_ID], kind)
                rows.append((doc.as_py(), pid, q, served[q], len(ids), ids.tobytes()))
                served[q] += len(ids)
                held += len(rows[-1][5])
                if held > 4 << 20:
                    yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)
                    rows, held = [], 0
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)
    return run


def _place_task(schedule: Schedule, size: int, kind: str, with_ids: bool):
    def run(batches):
        import numpy as np
        import pyarrow as pa

        schema = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64()),
                            ("doc_tokens", pa.int64()), ("sequence_id", pa.int64()), ("offset", pa.int64()),
                            ("window_id", pa.int64()), ("queue", pa.int32())]
                           + ([("ids", pa.list_(pa.int32()))] if with_ids else []))
        for batch in batches:
            rows = []
            cols = [batch.column(batch.schema.get_field_index(c)).to_pylist() for c in ("doc_id", "queue", "base", "start", "n")]
            for doc, q, base, begin, n, raw in zip(*cols, batch.column(batch.schema.get_field_index("ids"))):
                ids = np.frombuffer(raw.as_buffer(), kind).astype("<u4")
                for at, pos, room in schedule.place(q, base + begin, n):
                    for seq, off, m in sequences(schedule.total, pos, room, size):
                        a = at - base - begin
                        piece = ids[a:a + m]
                        rows.append((doc, a, m, zlib.crc32(piece), n, seq, off, pos // schedule.window, q)
                                    + ((piece.tolist(),) if with_ids else ()))
                        at, pos = at + m, pos + m
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)
    return run


def pack(docs: DataFrame, weights: dict[str, float] | None = None, tokenizer_path: str | None = None,
         sequence: int = SEQUENCE, window_sequences: int = WINDOW_SEQUENCES, with_ids: bool = False,
         id_col: str = "doc_id", source: str = "source", text: str = "text") -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset, window_id, source
    (the queue's name), and the piece's token ids if asked for."""
    weights = weights or TARGET_WEIGHTS
    path = tokenizer_path or default_tokenizer()
    names = [s for s in weights if s != REST]
    parts = [round(PARTS * weights[n]) for n in names] + [round(PARTS * weights.get(REST, 0))]
    rows = docs.select(F.col(id_col).cast("bigint"), F.col(source).cast("string"), F.col(text).cast("string"))
    tokens = materialize(rows.mapInArrow(
        _encode_task(path, names), "doc_id long, pid int, queue int, start long, n long, ids binary"), "pack-ids")
    by_part = tokens.groupBy("pid", "queue").agg(F.sum("n").alias("n"))
    earlier = Window.partitionBy("queue").orderBy("pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = materialize(by_part.select("pid", "queue", "n", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("base")),
                          "pack-offsets")
    totals = [0] * len(parts)  # one number per weight
    for r in offsets.groupBy("queue").agg(F.sum("n").alias("n")).collect():
        totals[r["queue"]] = r["n"]
    kind = "<u2" if load_encoder(path)[1] <= 1 << 16 else "<u4"
    schedule = Schedule(totals, parts, sequence * window_sequences)
    out = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, window_id long, queue int"
    placed = tokens.join(offsets.drop("n"), ["pid", "queue"]).select("doc_id", "queue", "base", "start", "n", "ids").mapInArrow(
        _place_task(schedule, sequence, kind, with_ids), out + (", ids array<int>" if with_ids else ""))
    label = F.element_at(F.array(*[F.lit(n) for n in [*names, REST]]), F.col("queue") + 1)
    return placed.withColumn("source", label).drop("queue")
