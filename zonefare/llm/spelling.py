"""Spelling variants grouped by reduced-alphabet neighbourhoods.

Letters are hashed to a few symbols, so a word shrinks to a string over a small
alphabet, and the one-edit neighbourhood of that string is small: every position
deleted, every position replaced by another symbol, and the string itself.
Neighbourhoods are joined with the reduced vocabulary, and pairs that meet are
verified on the original words.

* A pair is looked for from one side only: a deletion from the longer word (so the
  shorter one needs no insertions), a replacement by a greater symbol from the word
  with the smaller one.  Together with the reduced word itself (two letters of one
  symbol) this covers the full neighbourhood of both sides.
* Reduced words alone would collect many words under one key.  One edit leaves the
  first or the second half of a word alone, so a key holds the reduced string, which
  half is meant and that half of the original: words that only look alike after the
  reduction do not meet, and no group is compared pair by pair.

Keys are 64-bit polynomial hashes, computed for all positions at once from prefix
sums; a collision costs a verification, never a result.  Rows of the join are two
longs, whatever the length of the words.

Counting takes whole texts; a task adds up its documents and sends on at most
`FLUSH_WORDS` words (`FLUSH_CHARS` characters) at a time, so memory is bounded and a
frequent word costs a few rows per task.  Nothing is broadcast by hint.

Cases: a null text has no words, a null id reads as empty in the checksum; words of
any length work (positions are taken in stretches); a tie for the form goes to the
smaller word in code-point order; repeated rows count as often as they occur; an empty
table gives an empty result; other input columns play no part.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from zonefare.llm.common import delete_path, materialize, stored_table

SYMBOLS = 5
MIN_LENGTH = 6
MIN_COUNT = 5
#: A form occurs at least this many times as often as its variant.
FORM_RATIO = 5
#: Of the checksums of (document, run) one in this many deletes a letter of the run.
DELETE_EVERY = 199

FLUSH_WORDS = 400_000
FLUSH_CHARS = 16_000_000
#: Entries of a block of (words x positions x symbols) held at once.
STRETCH = 4_000_000

_BASE, _HALF_BASE = 0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F  # odd: invertible modulo 2^64


def _count_task(min_length: int, delete_every: int):
    def run(batches):
        import re
        import zlib
        from collections import Counter

        import pyarrow as pa

        # shorter runs cannot give a word; a match begins where its run begins
        runs = re.compile(f"[a-zÀ-ÿ]{{{min_length},}}")
        total, chars = {}, 0

        def flush():
            out = pa.RecordBatch.from_arrays([pa.array(list(total), pa.string()), pa.array(list(total.values()), pa.int64())],
                                             names=["word", "n"])
            total.clear()
            return out

        for batch in batches:
            for i, text in zip(batch.column(0), batch.column(1)):
                text = text.as_py()
                if not text:
                    continue
                text = text.encode().lower().decode()  # bytes: A-Z only
                start = zlib.crc32(f"{'' if i.as_py() is None else i.as_py()}:".encode())
                found = runs.findall(text) if len(text) < 1_000_000 else (m.group() for m in runs.finditer(text))
                for word, n in Counter(found).items():
                    h = zlib.crc32(word.encode(), start)
                    if h % delete_every == 0:
                        at = h % len(word)
                        word = word[:at] + word[at + 1:]
                        if len(word) < min_length:
                            continue
                    seen = total.get(word)
                    if seen is None:
                        chars += len(word)
                        total[word] = n
                    else:
                        total[word] = seen + n
                if len(total) >= FLUSH_WORDS or chars >= FLUSH_CHARS:
                    yield flush()
                    chars = 0
        yield flush()
    return run


def count_words(docs: DataFrame, id_col: str = "doc_id", text: str = "text", min_length: int = MIN_LENGTH,
                min_count: int = MIN_COUNT, delete_every: int = DELETE_EVERY) -> DataFrame:
    """word, n: the vocabulary."""
    part = docs.select(F.col(id_col).cast("string"), F.col(text).cast("string")).mapInArrow(
        _count_task(min_length, delete_every), "word string, n long")
    return part.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= min_count)


# ---- keys, inside tasks ---------------------------------------------------------------------------------

class Keys:
    """Keys of words of one length: `entries` (the reduced word) and `neighbours` (its one-edit neighbourhood)."""

    def __init__(self, words: list[str], symbols: int):
        import numpy as np
        self.np, self.symbols, self.length = np, symbols, len(words[0])
        code = np.frombuffer("".join(words).encode("utf-32-le"), np.uint32).reshape(len(words), self.length)
        self.sym = (code % symbols + 1).astype(np.uint64)
        self.pow = self._powers(_BASE, self.length + 1)
        self.prefix = self._sums(self.sym * self.pow[:self.length])
        half_pow = self._powers(_HALF_BASE, self.length + 1)
        self.half_prefix = self._sums(code.astype(np.uint64) * half_pow[:self.length])
        self.half_back = self._powers(pow(_HALF_BASE, -1, 1 << 64), self.length + 1)

    def _powers(self, base: int, n: int):
        np = self.np
        out = np.full(n, base % (1 << 64), np.uint64)
        out[0] = 1
        return np.multiply.accumulate(out)

    def _sums(self, terms):
        np = self.np
        return np.concatenate([np.zeros((len(terms), 1), np.uint64), np.cumsum(terms, axis=1, dtype=np.uint64)], axis=1)

    def half(self, shared: int, first: bool):
        """Hash of the half of the originals that stays when a word of `shared` letters is the shorter of a pair."""
        n = shared // 2
        if first:
            return self.half_prefix[:, n]
        start = self.length - (shared - n)
        return (self.half_prefix[:, -1] - self.half_prefix[:, start]) * self.half_back[start]

    def mixed(self, reduced, half, shared: int, first: bool):
        np = self.np
        salt = np.uint64((shared * 0xD6E8FEB86659FD93 + (0xA5A5A5A5A5A5A5A5 if first else 0)) % (1 << 64))
        x = reduced * np.uint64(0xFF51AFD7ED558CCD) + half * np.uint64(0xC4CEB9FE1A85EC53) + salt
        x ^= x >> np.uint64(29)
        return (x * np.uint64(0xBF58476D1CE4E5B9)).view(np.int64)

    def entries(self):
        """(rows, keys) of the reduced words, once by each half."""
        rows = self.np.arange(len(self.sym))
        for first in (True, False):
            yield rows, self.mixed(self.prefix[:, -1], self.half(self.length, first), self.length, first)

    def neighbours(self):
        np = self.np
        yield from self.entries()
        whole, back = self.prefix[:, -1], np.uint64(pow(_BASE, -1, 1 << 64))
        width = max(1, STRETCH // max(1, len(self.sym) * self.symbols))
        for start in range(0, self.length, width):
            at = np.arange(start, min(self.length, start + width))
            sym = self.sym[:, at]
            for shared, deleted in ((self.length, False), (self.length - 1, True)):
                if deleted:
                    reduced = self.prefix[:, at] + (whole[:, None] - self.prefix[:, at + 1]) * back
                    # deleting any letter of a run of one symbol gives the same string
                    want = sym != self.sym[:, np.maximum(at - 1, 0)]
                    want |= (at == 0) | (at == shared // 2)
                    wanted = [(reduced, want)]
                else:
                    wanted = [(whole[:, None] + (np.uint64(c) - sym) * self.pow[at], sym < c)
                              for c in range(2, self.symbols + 1)]
                for first in (True, False):
                    side = (at >= shared // 2) == first
                    if not side.any():
                        continue
                    half = self.half(shared, first)
                    for reduced, want in wanted:
                        rows, cols = np.nonzero(want & side)
                        yield rows, self.mixed(reduced[rows, cols], half[rows], shared, first)


def _keys_task(kind: str, symbols: int):
    def run(batches):
        import numpy as np
        import pyarrow as pa
        from collections import defaultdict

        for batch in batches:
            groups = defaultdict(list)
            words = batch.column(1).to_pylist()
            ids = batch.column(0).to_numpy()
            for i, w in enumerate(words):
                groups[len(w)].append(i)
            for length, members in groups.items():
                step = max(1, STRETCH // (length * symbols))
                for start in range(0, len(members), step):
                    part = members[start:start + step]
                    keys, own = Keys([words[i] for i in part], symbols), ids[np.array(part)]
                    for rows, key in getattr(keys, kind)():
                        if len(rows):
                            yield pa.RecordBatch.from_arrays([pa.array(key), pa.array(own[rows])], names=["key", "id"])
    return run


# ---- the operator ---------------------------------------------------------------------------------------

def near_pairs(vocabulary: DataFrame, symbols: int = SYMBOLS) -> DataFrame:
    """a, b (ids): pairs of words that differ by exactly one inserted, deleted or replaced code point, once each.

    `vocabulary`: id, word, n; a stored table, as the ids must not change.
    """
    def keys(kind: str) -> DataFrame:
        return vocabulary.select("id", "word").mapInArrow(_keys_task(kind, symbols), "key long, id long")

    met = (keys("neighbours").join(keys("entries").withColumnRenamed("id", "other"), "key").where("id <> other")
           .select(F.least("id", "other").alias("a"), F.greatest("id", "other").alias("b")).distinct())
    word = lambda side: vocabulary.select(F.col("id").alias(side), F.col("word").alias(f"word_{side}"), F.col("n").alias(f"n_{side}"))
    return met.join(word("a"), "a").join(word("b"), "b").where(F.levenshtein("word_a", "word_b", 1) == 1)


def group_variants(docs: DataFrame, symbols: int = SYMBOLS, ratio: int = FORM_RATIO, **counting) -> DataFrame:
    """word, form, root, n, n_near, form_n of every word of the vocabulary."""
    spark = docs.sparkSession
    vocabulary = materialize(count_words(docs, **counting).withColumn("id", F.monotonically_increasing_id()), "spelling-words")
    pairs, path = stored_table(near_pairs(vocabulary, symbols), "spelling-pairs")
    both = pairs.select(F.col("a").alias("id"), F.struct((-F.col("n_b")).alias("less"), F.col("word_b").alias("word")).alias("near")).union(
        pairs.select("b", F.struct((-F.col("n_a")).alias("less"), F.col("word_a").alias("word"))))
    best = both.groupBy("id").agg(F.count(F.lit(1)).alias("n_near"), F.min("near").alias("near"))
    has_form = -F.col("near.less") >= ratio * F.col("n")
    formed, formed_path = stored_table(
        vocabulary.join(best, "id", "left")
        .select("word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"),
                F.when(has_form, F.col("near.word")).alias("form"), F.when(has_form, -F.col("near.less")).alias("form_n")),
        "spelling-forms")
    delete_path(spark, path)
    # a form occurs `ratio` times as often, so chains are short; jumps of 1, 2, 4, ... steps reach their end
    top = formed.agg(F.max("n")).first()[0] or 1
    links = formed.where("form IS NOT NULL").select("word", F.col("form").alias("root"))
    steps, paths = 1, [formed_path]
    while steps < math.log(max(top, ratio), ratio):
        ahead = links.select(F.col("word").alias("root"), F.col("root").alias("further"))
        links, jump = stored_table(links.join(ahead, "root", "left").select("word", F.coalesce("further", "root").alias("root")),
                                   "spelling-roots")
        steps, paths = steps * 2, [*paths, jump]
        if len(paths) > 2:
            delete_path(spark, paths.pop(1))
    return formed.join(links, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


_LOWER = ("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")

#: Neighbours by shared deletions: one letter less in common at the same place, or one word is the other less a letter.
ORACLE_SQL = f"""
WITH RECURSIVE crc(t) AS (
  SELECT list(c ORDER BY b)
  FROM (SELECT b, list_reduce(list_prepend(b, range(8)),
                              lambda a, i: CASE WHEN a & 1 = 1 THEN xor(a >> 1, 3988292384) ELSE a >> 1 END) AS c
        FROM (SELECT CAST(range AS BIGINT) AS b FROM range(256)))),
runs AS (
  SELECT doc_id, unnest(regexp_extract_all(translate(text, '{_LOWER[0]}', '{_LOWER[1]}'), '[a-zÀ-ÿ]+')) AS run
  FROM documents),
counted AS (SELECT doc_id, run, count(*) AS n FROM runs WHERE length(run) >= {MIN_LENGTH} GROUP BY doc_id, run),
hashed AS (
  SELECT run, n,
         xor(list_reduce(list_prepend(4294967295, list_transform(
               regexp_extract_all(hex(encode(coalesce(CAST(doc_id AS VARCHAR), '') || ':' || run)), '..'), lambda h: CAST('0x' || h AS BIGINT))),
             lambda a, x: xor(a >> 8, t[(xor(a, x) & 255) + 1])), 4294967295) AS h
  FROM counted, crc),
edited AS (
  SELECT n, CASE WHEN h % {DELETE_EVERY} = 0
                 THEN substr(run, 1, CAST(h % length(run) AS INTEGER)) || substr(run, CAST(h % length(run) AS INTEGER) + 2)
                 ELSE run END AS word
  FROM hashed),
words AS (SELECT word, CAST(sum(n) AS BIGINT) AS n FROM edited WHERE length(word) >= {MIN_LENGTH} GROUP BY word HAVING sum(n) >= {MIN_COUNT}),
cut AS (SELECT word, n, length(word) AS len, place, substr(word, 1, place) || substr(word, place + 2) AS rest
        FROM words, LATERAL (SELECT unnest(range(length(word))) AS place)),
near AS (
  SELECT DISTINCT a.word, b.word AS other, b.n AS other_n
  FROM cut a JOIN cut b ON a.rest = b.rest AND a.place = b.place AND a.len = b.len AND a.word <> b.word
  UNION SELECT DISTINCT a.word, b.word, b.n FROM cut a JOIN words b ON a.rest = b.word
  UNION SELECT DISTINCT b.word, a.word, a.n FROM cut a JOIN words b ON a.rest = b.word),
best AS (
  SELECT word, count(*) OVER (PARTITION BY word) AS n_near, other, other_n,
         row_number() OVER (PARTITION BY word ORDER BY other_n DESC, other) AS place
  FROM near),
formed AS (
  SELECT w.word, w.n, CAST(coalesce(b.n_near, 0) AS BIGINT) AS n_near,
         CASE WHEN b.other_n >= {FORM_RATIO} * w.n THEN b.other END AS form,
         CASE WHEN b.other_n >= {FORM_RATIO} * w.n THEN b.other_n END AS form_n
  FROM words w LEFT JOIN best b ON b.word = w.word AND b.place = 1),
walk AS (
  SELECT word, word AS here, form AS next FROM formed
  UNION ALL SELECT k.word, k.next, f.form FROM walk k JOIN formed f ON f.word = k.next WHERE k.next IS NOT NULL)
SELECT f.word, f.form, k.here AS root, f.n, f.n_near, f.form_n
FROM formed f JOIN walk k ON k.word = f.word AND k.next IS NULL
"""
