"""Exact token counts at every prefix of a text, by dynamic programming.

For a BPE model, a token sequence is the encoding of its text if every two
neighbours are the encoding of theirs.  So the encoding of a prefix is that of a
shorter prefix plus one token: at each position the last token is the one vocabulary
entry that ends there and agrees with the last token of the prefix before it, and
count[i] = count[i - len(token)] + 1.  One pass gives the count at every prefix,
which answers how long a text is, how many tokens a cut would have, and where a
budget ends, without encoding anything again.

No vocabulary entry has a blank after another character, so a text falls apart
into segments (a word with the blanks before it) that are encoded independently;
the programme runs once per distinct segment of a task and texts add up
segments.  A character outside the vocabulary is its bytes and ends all merges.

Cases: a null or empty text has no tokens; repeated rows are counted alike; a
text of one endless word costs linear time; an empty table gives an empty result;
output columns replace input columns of the same name.
"""

from __future__ import annotations

from collections.abc import Sequence
from itertools import accumulate

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

LIMIT = 4096
BLANK = "▁"
#: Segments kept per task; longer ones than CACHED_LENGTH are not kept.
CACHE = 300_000
CACHED_LENGTH = 64
#: Scores down to here are shared by several tokens (runs of blanks) and do not order merges.
TIED = -1e8
FRESH = (1 << 20) - 1


def default_model() -> str:
    import public_tokenizers
    return public_tokenizers.path("piece_bpe_32k.model")


class PrefixCounter:
    """Token counts of prefixes under a sentencepiece BPE model with byte fallback."""

    def __init__(self, model_path: str):
        import ahocorasick
        import sentencepiece
        sp = sentencepiece.SentencePieceProcessor(model_file=model_path)
        self.score = {sp.id_to_piece(i): sp.get_score(i) for i in range(sp.get_piece_size())
                      if not (sp.is_byte(i) or sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i))}
        self.pieces = list(self.score)
        self.matches = ahocorasick.Automaton()
        for i, piece in enumerate(self.pieces):
            self.matches.add_word(piece, (i, len(piece)))
        self.matches.make_automaton()
        self.agree: dict[int, bool] = {}
        self.edges: dict[tuple[str, int], list[tuple[str, float]] | None] = {}
        self.known: dict[str, Sequence[int]] = {}
        self.total: dict[str, int] = {}
        # the shape this programme relies on
        if any(BLANK in p.lstrip(BLANK) for p in self.score):
            raise ValueError("a piece holds a blank after another character")
        if sp.encode("a  a", out_type=str)[0] != BLANK + "a" or len(sp.encode("\x01")) != 2:
            raise ValueError("not a BPE model with a leading blank, kept blanks and byte fallback")

    def merged(self, text: str) -> list[str]:
        """Encoding of a short string by its definition: the best-scored neighbours merge first, leftmost on a tie."""
        parts = list(text)
        while True:
            best, at = None, -1
            for i in range(len(parts) - 1):
                s = self.score.get(parts[i] + parts[i + 1])
                if s is not None and (best is None or s > best):
                    best, at = s, i
            if at < 0:
                return parts
            parts[at:at + 2] = [parts[at] + parts[at + 1]]

    def split(self, token: str) -> tuple[str, str] | None:
        """The two parts whose merge completes a token; None for a character or a token that merging does not reach."""
        parts = list(token)
        while len(parts) > 2:
            best, at = None, -1
            for i in range(len(parts) - 1):
                s = self.score.get(parts[i] + parts[i + 1])
                if s is not None and (best is None or s > best):
                    best, at = s, i
            if at < 0:
                return None
            parts[at:at + 2] = [parts[at] + parts[at + 1]]
        return (parts[0], parts[1]) if len(parts) == 2 else None

    def _edge(self, token: str, side: int) -> list[tuple[str, float]] | None:
        """What stands at a side of a token while it is merged, from its character on, with the score of each merge.

        None unless every merge on the way has a lower score than its parts had, so that scores tell the order.
        """
        key = (token, side)
        if key not in self.edges:
            out, t = [(token, self.score[token])], token
            while out is not None and len(t) > 1:
                halves = self.split(t)
                if halves is None or any(self.score.get(h, TIED) <= self.score[t] for h in halves if len(h) > 1) or self.score[t] <= TIED:
                    out = None
                else:
                    t = halves[side]
                    out.append((t, self.score[t] if t in self.score else 0.0))
            self.edges[key] = out[::-1] if out else None
        return self.edges[key]

    def _agrees(self, key: int) -> bool:
        """Whether two tokens are the encoding of their text (of a token after FRESH: whether it is its own)."""
        if len(self.agree) >= CACHE:
            self.agree.clear()
        left, right = key >> 20, key & 0xFFFFF
        known = self.agree[key] = self._stay_apart("" if left == FRESH else self.pieces[left], self.pieces[right])
        return known

    def _outside(self, segment: str, counts: list[int], done: int, until: int) -> int:
        """Characters outside the vocabulary: as many tokens as bytes."""
        for i in range(done, until):
            if segment[i] in self.score:
                raise ValueError(f"no token ends at {i + 1} of {segment[:50]!r}")
            counts[i + 1] = counts[i] + len(segment[i].encode("utf-8", "surrogatepass"))
        return until

    def _stay_apart(self, left: str, right: str) -> bool:
        if not left:
            return self.merged(right) == [right]
        a, b = self._edge(left, 1), self._edge(right, 0)
        if a is None or b is None:
            return self.merged(left + right) == [left, right]
        # merges happen in the order of their scores; the two sides must be complete before a merge across is due
        i = j = 0
        while True:
            across = self.score.get(a[i][0] + b[j][0])
            grow_a = a[i + 1][1] if i + 1 < len(a) else None
            grow_b = b[j + 1][1] if j + 1 < len(b) else None
            if grow_a is None and grow_b is None:
                return across is None
            if grow_b is None or (grow_a is not None and grow_a >= grow_b):
                if across is not None and across > grow_a:
                    return False
                i += 1
            else:
                if across is not None and across >= grow_b:
                    return False
                j += 1

    def prefix_counts(self, segment: str) -> Sequence[int]:
        """counts[i]: tokens of the first i characters of a segment."""
        got = self.known.get(segment)
        if got is not None:
            return got
        n = len(segment)
        counts, last = [0] * (n + 1), [FRESH] * (n + 1)  # last token of each prefix; FRESH where the next one starts anew
        agree, done = self.agree, 0
        for end, (token, length) in self.matches.iter(segment):  # by end, the longest first
            if end < done:
                continue
            if done < end:
                done = self._outside(segment, counts, done, end)
            start = end + 1 - length
            key = last[start] << 20 | token
            ok = agree.get(key)
            if ok is None:
                ok = self._agrees(key)
            if ok:
                done = end + 1
                counts[done], last[done] = counts[start] + 1, token
        if done < n:
            self._outside(segment, counts, done, n)
        packed: Sequence[int] = bytes(counts) if counts[-1] < 256 and max(counts) < 256 else counts
        if len(segment) <= CACHED_LENGTH and len(self.known) < CACHE:  # frequent segments come early
            self.known[segment] = packed
            self.total[segment] = packed[-1]
        return packed

    @staticmethod
    def segments(text: str) -> list[str]:
        """The text with its leading blank, cut before the blanks of each word."""
        if not text:
            return []
        out, run = [], ""
        for word in text.replace(BLANK, " ").split(" "):
            run += BLANK
            if word:
                out.append(run + word)
                run = ""
        if run:
            out.append(run)
        return out

    def segment_totals(self, text: str) -> tuple[list[str], list[int]]:
        parts = self.segments(text)
        total, counts = self.total, self.prefix_counts
        return parts, [total[p] if p in total else counts(p)[-1] for p in parts]

    def count(self, text: str) -> int:
        return sum(self.segment_totals(text)[1])

    def counts(self, text: str) -> list[int]:
        """counts[i]: tokens of the first i code points of the text, from i = 0."""
        out, before = [0], 0
        for part in self.segments(text):
            inner = self.prefix_counts(part)
            out.extend(before + c for c in inner[1:])
            before += inner[-1]
        return out[:1] + out[2:]  # the blank added in front is no code point of the text

    def fitting(self, text: str, budget: int, totals: tuple[list[str], list[int]] | None = None) -> int:
        """Code points of the longest prefix of at most `budget` tokens."""
        parts, n = totals or self.segment_totals(text)
        ends = list(accumulate(n))
        if not ends or ends[-1] <= budget:
            return len(text)
        k = next(i for i, e in enumerate(ends) if e > budget)
        before = ends[k - 1] if k else 0
        inner = self.prefix_counts(parts[k])
        i = max(j for j in range(len(inner)) if before + inner[j] <= budget)
        return max(0, sum(map(len, parts[:k])) + i - 1)


def _count_task(path: str, limit: int, at: int):
    def run(batches):
        import pyarrow as pa
        counter = PrefixCounter(path)
        for batch in batches:
            n, fit = [], []
            for text in batch.column(at):
                text = text.as_py() or ""
                totals = counter.segment_totals(text)
                n.append(sum(totals[1]))
                fit.append(len(text) if n[-1] <= limit else counter.fitting(text, limit, totals))
            cols = [c for i, c in enumerate(batch.columns) if i != at]
            names = [c for i, c in enumerate(batch.schema.names) if i != at]
            yield pa.RecordBatch.from_arrays([*cols, pa.array(n, pa.int64()), pa.array(fit, pa.int64())], names=[*names, "n_tokens", "fitting_chars"])
    return run


def count_tokens(docs: DataFrame, keep: Sequence[str] = ("doc_id",), limit: int = LIMIT, model_path: str | None = None,
                 text: str = "text") -> DataFrame:
    """`keep` columns, n_bytes, n_tokens, over_limit, fitting_chars (code points of the longest prefix within the limit)."""
    keep = [c for c in keep if c not in ("n_bytes", "n_tokens", "over_limit", "fitting_chars")]
    rows = docs.select(*keep, F.coalesce(F.octet_length(F.col(text).cast("string")), F.lit(0)).cast("long").alias("n_bytes"),
                       F.col(text).cast("string").alias("__text"))
    schema = T.StructType([*rows.drop("__text").schema.fields, T.StructField("n_tokens", T.LongType()), T.StructField("fitting_chars", T.LongType())])
    out = rows.mapInArrow(_count_task(model_path or default_model(), limit, len(rows.columns) - 1), schema)
    return out.select(*keep, "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"), "fitting_chars")


def prefix_counts(docs: DataFrame, id_col: str = "doc_id", model_path: str | None = None, text: str = "text") -> DataFrame:
    """The id and counts: the exact token count of every prefix, by code points, from the empty one."""
    path = model_path or default_model()

    def run(batches):
        import pyarrow as pa
        counter = PrefixCounter(path)
        for batch in batches:
            for i in range(len(batch)):
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(i, 1), pa.array([counter.counts(batch.column(1)[i].as_py() or "")], pa.list_(pa.int32()))],
                                                 names=["id", "counts"])

    rows = docs.select(F.col(id_col).alias("id"), F.col(text).cast("string").alias("text"))
    schema = T.StructType([rows.schema["id"], T.StructField("counts", T.ArrayType(T.IntegerType()))])
    return rows.mapInArrow(run, schema).withColumnRenamed("id", id_col)


def truncate(docs: DataFrame, budget: int = LIMIT, model_path: str | None = None, text: str = "text") -> DataFrame:
    """The input rows with every text cut to its longest prefix of at most `budget` tokens."""
    clash = {c: f"__own{i}" for i, c in enumerate(docs.columns)}
    own = docs.withColumnsRenamed(clash).withColumn("__cut", F.col(clash[text]))
    cut = count_tokens(own, list(clash.values()), budget, model_path, "__cut")
    short = F.when(F.col("over_limit"), F.substring(F.col(clash[text]), F.lit(1), F.col("fitting_chars").cast("int"))).otherwise(F.col(clash[text]))
    return cut.withColumn(clash[text], short).select(*[F.col(v).alias(k) for k, v in clash.items()])
