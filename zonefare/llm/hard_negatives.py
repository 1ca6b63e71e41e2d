"""Hard negatives by threshold joins over an inverted index with norm bounds.

For every anchor the best rows of its own label are its positives.  Wanted per anchor
and positive are the best rows of other labels whose score lies in a window under the
positive's score: similar enough to be hard, not so similar that the label is in doubt.

Scores are integer inner products of quantised vectors.  A threshold join finds all
rows that reach an anchor's threshold t:

* dimensions are ordered by their share of the block's norm; a row is indexed from the
  first dimension on at which the norm of the dimensions before it allows t at all
  (|q| |x before| < t means that they alone cannot), the others are omitted;
* the index is read from the heaviest dimensions down, a slab of `SLAB` at a time, and
  partial scores are accumulated; a pair whose partial score plus the product of the
  norms still unread is under t is dropped, and columns that no anchor needs any more
  leave the block;
* what is left gets the omitted dimensions added and is compared with t exactly.

Thresholds start high (`LEVELS`, in percent of the positive's score) and are lowered,
level by level, for the windows that are not yet full; the last level is the window's
own lower end, so every window is full or complete in the end.

Blocks: rows are dealt to the nearest of a few pivots (one per `BLOCK_ROWS` rows,
`MAX_PIVOTS` at most, chosen far apart from a bounded sample), larger blocks in parts
by hash, so equal vectors and frequent labels are spread; anchors of neighbouring
pivots form a chunk.  A block meets a chunk only if its centre and radius still allow
one of the chunk's thresholds; rows and anchors are copied to those meetings and to no
others.  Positives are searched the same way among the blocks of a label, first in one
part, whose results are the threshold for the other parts.  A task holds one chunk and
one part.  Broadcast: the pivots (`MAX_PIVOTS` vectors) only.

Cases: rows with a null id, label, vector or any null or non-finite component take no
part; rows alike in id, label and vector count once, rows that share an id only are
rows of their own but never meet; vectors of different lengths never meet; ties go to
the smaller id; products beyond 2^53 are computed in unbounded integers, scores beyond
64 bits saturate; an anchor without positives, or a window without rows, gives no row;
an empty table gives an empty result; other columns play no part.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from zonefare.llm.common import delete_path, materialize, stored_table, unit_hash

POSITIVES = 5
NEGATIVES = 10
LOW, HIGH = 30, 90  # the window, in percent of the positive's score
LEVELS = (80, 65, 50, LOW)

BLOCK_ROWS = 16_384
CHUNK_ROWS = 2_048
MAX_PIVOTS = 512
PIVOT_SAMPLE = 4_096
SLAB = 8
#: Anchors whose partial scores are held at once.
ANCHORS_AT_ONCE = 128


def taking_part(table: DataFrame, vector: str = "embedding") -> DataFrame:
    """row, vec_id, label, v, d: the distinct rows that take part; labels as given."""
    fine = F.forall("v", lambda x: F.coalesce(~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))), F.lit(False)))
    rows = (table.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("long").alias("label"),
                         F.col(vector).cast("array<double>").alias("v"))
            .where("vec_id IS NOT NULL AND label IS NOT NULL AND v IS NOT NULL").where(fine).distinct())
    return materialize(rows.withColumn("d", F.size("v")).withColumn("row", F.monotonically_increasing_id()), "negatives-rows")


# ---- threshold join, inside tasks -----------------------------------------------------------------------

def quantised(vectors, d: int):
    """floor(256 x), an n x d matrix of whole floats, and of those rows that floats may not carry exactly."""
    import numpy as np
    x = np.array([np.asarray(v, float) for v in vectors], float).reshape(len(vectors), d)
    with np.errstate(over="ignore"):
        q = np.floor(256.0 * x)
    limit = math.sqrt(2.0 ** 53 / max(1, d))
    huge = np.abs(q).max(axis=1, initial=0) >= limit
    exact = {int(i): [math.floor(256 * int(c)) if abs(c) > 2.0 ** 60 else math.floor(256.0 * c) for c in x[i].tolist()]
             for i in np.flatnonzero(huge)}
    q[huge] = 0
    return q, exact


def reached(q, x, t):
    """Scores (anchors x rows) that reach the anchors' thresholds t; -inf where they do not."""
    import numpy as np
    n, d = x.shape
    out = np.full((len(q), n), -np.inf)
    if not n or not len(q) or not d:
        out[t <= 0] = 0.0 if not d else -np.inf
        return out
    order = np.argsort((x ** 2).sum(axis=0), kind="stable")  # the heaviest dimensions last, read first
    x, q = x[:, order], q[:, order]
    edges = list(range(0, d, SLAB)) + [d]
    squares = lambda m: np.sqrt(np.concatenate([np.zeros((len(m), 1)), np.cumsum(m ** 2, axis=1)], axis=1)[:, edges])
    norm_x, norm_q = squares(x), squares(q)  # norms of the dimensions before every slab
    whole = norm_q[:, -1]
    with np.errstate(divide="ignore", invalid="ignore"):
        need = np.where(t <= 0, -np.inf, np.where(whole > 0, t / whole, np.inf)).min()
    # slabs before `first` are not in the index: their norm cannot reach the least threshold
    slack = 1.0 + 1e-9
    first = (norm_x * slack < need).sum(axis=1)
    first = np.where(first > 0, first - 1, 0)  # norm before slab `first` is still too small
    never = norm_x[:, -1] * slack < need
    cols = np.flatnonzero(~never)
    cols = cols[np.argsort(first[cols], kind="stable")]
    partial = np.zeros((len(q), len(cols)))
    alive = np.ones_like(partial, bool)
    for s in range(len(edges) - 2, -1, -1):
        lo, hi = edges[s], edges[s + 1]
        listed = int(np.searchsorted(first[cols], s, side="right"))  # rows whose index holds this slab
        if listed:
            partial[:, :listed] += q[:, lo:hi] @ x[cols[:listed], lo:hi].T
        rest = norm_q[:, s][:, None] * norm_x[cols, s][None, :]
        unread = np.where(first[cols][None, :] > s, norm_q[:, -1][:, None] * norm_x[cols, np.minimum(first[cols], len(edges) - 1)][None, :], rest)
        alive &= partial + unread * slack + 1e-6 >= t[:, None]
        keep = alive.any(axis=0)
        if keep.sum() < 0.7 * len(cols):
            cols, partial, alive = cols[keep], partial[:, keep], alive[:, keep]
            if not len(cols):
                return out
    for f in np.unique(first[cols]):
        mine = np.flatnonzero(first[cols] == f)
        if f:  # the omitted dimensions
            partial[:, mine] += q[:, :edges[f]] @ x[cols[mine], :edges[f]].T
    partial[~alive | (partial < t[:, None])] = -np.inf
    out[:, cols] = partial
    return out


def scores(q, q_exact, x, x_exact, t):
    """`reached` with the rows and anchors that need unbounded integers; scores beyond 64 bits saturate."""
    import numpy as np
    out = reached(q, x, t)
    if q_exact or x_exact:
        out = out.astype(object)
        as_int = lambda m, exact, i: exact.get(i) or [int(c) for c in m[i]]
        pairs = [(i, j) for i in q_exact for j in range(len(x))] + [(i, j) for j in x_exact for i in range(len(q)) if i not in q_exact]
        for i, j in pairs:
            s = sum(a * b for a, b in zip(as_int(q, q_exact, i), as_int(x, x_exact, j)))
            s = max(-(1 << 63), min((1 << 63) - 1, s))
            out[i, j] = s if s >= t[i] else -math.inf
    return out


def _in_parts(left, right):
    """Anchors a few at a time: (numbers, their matrix, their huge rows, the rows' matrix, its huge rows)."""
    d = int(left["d"].iloc[0])
    x, x_exact = quantised(right["v"].to_list(), d)
    for start in range(0, len(left), ANCHORS_AT_ONCE):
        part = range(start, min(len(left), start + ANCHORS_AT_ONCE))
        q, q_exact = quantised(left["v"].iloc[part.start:part.stop].to_list(), d)
        yield part, q, q_exact, x, x_exact


def _positives_task(k: int):
    def run(key, left, right):
        import numpy as np
        import pandas as pd
        out = {"row": [], "vec_id": [], "score": [], "other": []}
        if len(left) and len(right):
            ids, rows = right["vec_id"].to_numpy(), right["row"].to_numpy()
            own, anchors, floor = left["vec_id"].to_numpy(), left["row"].to_numpy(), left["floor"].to_numpy(float)
            for part, q, q_exact, x, x_exact in _in_parts(left, right):
                s = scores(q, q_exact, x, x_exact, floor[part.start:part.stop])
                for i, n in enumerate(part):
                    hit = np.flatnonzero((s[i] > -np.inf) & (ids != own[n]))
                    value = s[i][hit]
                    if len(hit) > 4 * k and value.dtype != object:  # ties of the kth stay in
                        hit = hit[value >= np.partition(value, len(value) - k)[len(value) - k]]
                        value = s[i][hit]
                    best = sorted(zip(value.tolist(), ids[hit].tolist(), rows[hit].tolist()), key=lambda r: (-r[0], r[1]))
                    # rows that repeat an id may tie: all rows that tie with the kth go on
                    stop = next((m for m in range(k, len(best)) if best[m][:2] != best[k - 1][:2]), len(best))
                    for score, other, row in best[:stop]:
                        out["row"].append(anchors[n])
                        out["vec_id"].append(other)
                        out["score"].append(int(score))
                        out["other"].append(row)
        return pd.DataFrame(out).astype("int64")
    return run


def _negatives_task(k: int, level: int, high: int):
    def run(key, left, right):
        import numpy as np
        import pandas as pd
        out = {"row": [], "place": [], "vec_id": [], "score": []}
        if len(left) and len(right):
            ids, labels = right["vec_id"].to_numpy(), right["label"].to_numpy()
            own, label, anchors = left["vec_id"].to_numpy(), left["label"].to_numpy(), left["row"].to_numpy()
            t = left["t"].to_numpy(float)
            for part, q, q_exact, x, x_exact in _in_parts(left, right):
                s = scores(q, q_exact, x, x_exact, t[part.start:part.stop])
                for i, n in enumerate(part):
                    hit = np.flatnonzero((s[i] > -np.inf) & (ids != own[n]) & (labels != label[n]))
                    if not len(hit):
                        continue
                    order = hit[np.lexsort((ids[hit], -s[i][hit]))] if s.dtype != object else np.array(
                        sorted(hit.tolist(), key=lambda j: (-s[i][j], ids[j])))
                    value = [int(v) for v in s[i][order]] if s.dtype == object else s[i][order].astype(np.int64)
                    for place, score in zip(left["places"].iloc[n], left["scores"].iloc[n]):
                        place, score = int(place), int(score)
                        inside = [j for j, v in enumerate(value) if level * score <= 100 * v <= high * score] if s.dtype == object \
                            else _inside(value, level * score, high * score, k)
                        for j in inside[:k]:
                            out["row"].append(anchors[n])
                            out["place"].append(place)
                            out["vec_id"].append(ids[order[j]])
                            out["score"].append(int(value[j]))
        return pd.DataFrame(out).astype("int64")
    return run


def _inside(value, low: int, high: int, k: int):
    """Numbers of the first k of the falling values with low <= 100 value <= high, in whole numbers."""
    import numpy as np
    start = int(np.searchsorted(-value, -(high // 100), side="left"))
    stop = int(np.searchsorted(-value, -(-(-low // 100)), side="right"))
    return list(range(start, min(stop, start + k)))


def _place_task(pivots):
    def run(batches):
        import numpy as np
        import pyarrow as pa
        c = pivots.value
        for batch in batches:
            block, far = np.full(len(batch), -1, np.int32), np.zeros(len(batch))
            d = batch.column(1).to_numpy(zero_copy_only=False)
            mine = np.flatnonzero(d == c.shape[1])
            if len(mine) and c.shape[1]:
                v = batch.column(2).take(pa.array(mine)).flatten().to_numpy(zero_copy_only=False).reshape(len(mine), -1)
                x, _ = quantised(list(v), c.shape[1])
                near = np.maximum((x ** 2).sum(axis=1)[:, None] - 2 * x @ c.T + (c ** 2).sum(axis=1)[None, :], 0).argmin(axis=1)
                block[mine], far[mine] = near, np.sqrt(((x - c[near]) ** 2).sum(axis=1))
                far[mine[np.abs(v).max(axis=1) > 2.0 ** 17]] = np.inf  # out of the reach of plain floats
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(block), pa.array(far)], names=["row", "block", "far"])
    return run


def _visits_task(pivots, radii):
    def run(batches):
        import numpy as np
        import pyarrow as pa
        c, radius = pivots.value, radii.value
        for batch in batches:
            d = batch.column(0).to_numpy(zero_copy_only=False)
            chunk = batch.column(1).to_numpy(zero_copy_only=False)
            t = batch.column(2).to_numpy(zero_copy_only=False).astype(float)
            mine = np.flatnonzero(d == c.shape[1])
            found = {(int(d[i]), int(chunk[i]), -1) for i in np.flatnonzero(d != c.shape[1])}
            if len(mine):
                v = batch.column(3).take(pa.array(mine)).flatten().to_numpy(zero_copy_only=False).reshape(len(mine), c.shape[1])
                q, exact = quantised(list(v), c.shape[1])
                upper = q @ c.T + np.sqrt((q ** 2).sum(axis=1))[:, None] * np.where(radius >= 0, radius, 0)[None, :]
                upper[list(exact)] = np.inf
                go = (upper + 1e-6 * (1 + np.abs(upper)) >= t[mine][:, None]) & (radius >= 0)[None, :]
                a, b = np.nonzero(go)
                found |= set(zip(d[mine[a]].tolist(), chunk[mine[a]].tolist(), b.tolist()))
            found = sorted(found)
            yield pa.RecordBatch.from_arrays([pa.array([f[i] for f in found], ty) for i, ty in enumerate((pa.int32(), pa.int64(), pa.int32()))],
                                             names=["d", "chunk", "block"])
    return run


# ---- the operator ---------------------------------------------------------------------------------------

def _pivots(rows: DataFrame, d: int, n: int, wanted: int):
    """Far-apart quantised vectors of a bounded sample, each followed by its nearest one not yet named."""
    import numpy as np
    mine = rows.where(F.col("d") == d)
    sample = mine.where(unit_hash("negatives", F.col("row")) < min(1.0, PIVOT_SAMPLE / max(1, n))).orderBy("row").select("v").limit(2 * PIVOT_SAMPLE).collect()
    sample = sample or mine.select("v").limit(1).collect()
    x, _ = quantised([r["v"] for r in sample], d)
    chosen, far = [0], ((x - x[0]) ** 2).sum(axis=1)
    while len(chosen) < wanted and far.max() > 0:
        chosen.append(int(far.argmax()))
        far = np.minimum(far, ((x - x[chosen[-1]]) ** 2).sum(axis=1))
    x, order = x[chosen], [0]
    while len(order) < len(x):
        gap = ((x - x[order[-1]]) ** 2).sum(axis=1)
        gap[order] = np.inf
        order.append(int(gap.argmin()))
    return x[order]


def _renewed(df: DataFrame) -> DataFrame:
    """The same columns under new identities, for joins and cogroups of tables with one origin."""
    return df.select(*[F.col(c).alias(c) for c in df.columns])


def _spread(n: Column) -> Column:
    return F.pmod(F.xxhash64("row", F.lit(13)), F.greatest(n, F.lit(1))).cast("int")


def positives(rows: DataFrame, is_anchor: Column, k: int = POSITIVES) -> DataFrame:
    """row, place, vec_id, score: the k best other rows of every anchor's label."""
    anchors = rows.where(is_anchor)
    sizes = rows.groupBy("d", "label").agg(F.count(F.lit(1)).alias("n"), F.count_if(is_anchor).alias("a")).where("a > 0")
    parts, chunks = F.ceil(F.col("n") / BLOCK_ROWS), F.ceil(F.col("a") / CHUNK_ROWS)
    # every part of a label meets every chunk of the label's anchors
    refs = (rows.join(sizes, ["d", "label"])
            .select("row", "vec_id", "v", "d", "label", _spread(parts).alias("part"),
                    F.explode(F.sequence(F.lit(0), (chunks - 1).cast("int"))).alias("chunk")))
    asking = anchors.join(sizes, ["d", "label"]).select("row", "vec_id", "v", "d", "label", _spread(chunks).alias("chunk"), parts.cast("int").alias("parts"))
    out, by = "row long, vec_id long, score long, other long", ["d", "label", "chunk", "part"]

    def search(left: DataFrame, right: DataFrame) -> DataFrame:
        return left.groupBy(*by).cogroup(_renewed(right).groupBy(*by)).applyInPandas(_positives_task(k), out)

    place = Window.partitionBy("row").orderBy(F.desc("score"), "vec_id", "v")
    best = lambda found: (found.join(rows.select(F.col("row").alias("other"), "v"), "other")
                          .withColumn("place", F.row_number().over(place)).where(F.col("place") <= k).drop("v"))
    near = materialize(best(search(asking.withColumn("part", F.lit(0)).withColumn("floor", F.lit(float("-inf"))),
                                   refs.where("part = 0"))), "negatives-near")
    floor = near.where(F.col("place") == k).select("row", F.col("score").cast("double").alias("floor"))
    rest = (asking.where("parts > 1").join(floor, "row", "left").withColumn("floor", F.coalesce("floor", F.lit(float("-inf"))))
            .withColumn("part", F.explode(F.sequence(F.lit(1), F.col("parts") - 1))))
    found = near.select("row", "vec_id", "score", "other").union(search(rest, refs.where("part > 0")))
    return best(found).select("row", "place", "vec_id", "score")


def mine(table: DataFrame, is_anchor: Column, relabel: Column | None = None, vector: str = "embedding",
         n_positives: int = POSITIVES, n_negatives: int = NEGATIVES, high: int = HIGH, levels: tuple = LEVELS) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    `is_anchor` and `relabel` are expressions over vec_id and label; the last of the
    `levels` is the lower end of the window.
    """
    import numpy as np

    spark = table.sparkSession
    schema = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"
    given = table.withColumn("label", relabel) if relabel is not None else table
    rows = taking_part(given, vector)
    usual = rows.groupBy("d").agg(F.count(F.lit(1)).alias("n"), F.count_if(is_anchor).alias("a")).orderBy(F.desc("n"), "d").first()
    if usual is None:
        return spark.createDataFrame([], schema)
    windows = materialize(positives(rows, is_anchor, n_positives).where("score >= 0"), "negatives-windows")

    centres = _pivots(rows, usual["d"], usual["n"], min(MAX_PIVOTS, math.ceil(usual["n"] / BLOCK_ROWS)))
    pivots = spark.sparkContext.broadcast(centres)
    placed = rows.select("row", "d", "v").mapInArrow(_place_task(pivots), "row long, block int, far double")
    placed = materialize(rows.join(_renewed(placed), "row"), "negatives-placed")
    radii, parts = np.full(len(centres), -1.0), {}
    for r in placed.groupBy("block").agg(F.count(F.lit(1)).alias("n"), F.max("far").alias("far")).collect():  # a row per pivot
        parts[r["block"]] = math.ceil(r["n"] / BLOCK_ROWS)
        if r["block"] >= 0:
            radii[r["block"]] = r["far"]
    n_parts = F.coalesce(F.create_map(*[F.lit(x) for kv in parts.items() for x in kv])[F.col("block")], F.lit(1))
    refs = placed.select("vec_id", "label", "v", "d", "block", _spread(n_parts).alias("part"))
    radius = spark.sparkContext.broadcast(radii)
    n_chunks = math.ceil(max(1, usual["a"]) / CHUNK_ROWS)
    # anchors of neighbouring pivots share a chunk; crowded ones are split by hash
    crowd = {r["chunk"]: math.ceil(r["n"] / (2 * CHUNK_ROWS)) for r in placed.where(is_anchor).groupBy(
        F.expr(f"int(floor(greatest(block, 0) * {min(n_chunks, len(centres))} / {len(centres)}))").alias("chunk"))
        .agg(F.count(F.lit(1)).alias("n")).collect()}  # as many rows as pivots at most
    home = F.expr(f"int(floor(greatest(block, 0) * {min(n_chunks, len(centres))} / {len(centres)}))")
    split = F.coalesce(F.create_map(*[F.lit(x) for kv in (crowd or {0: 1}).items() for x in kv])[home], F.lit(1))
    anchors = placed.where(is_anchor).withColumn("chunk", home.cast("long") * F.lit(1 << 20) + _spread(split))

    open_, done = windows, []
    for n, level in enumerate(levels):
        per_anchor = open_.groupBy("row").agg(  # at most n_positives windows
            F.sort_array(F.collect_list(F.struct("place", "score"))).alias("w"))
        asking = anchors.join(per_anchor, "row").select(
            "row", "vec_id", "label", "v", "d", "chunk", F.col("w.place").alias("places"), F.col("w.score").alias("scores"),
            (F.array_min("w.score").cast("double") * level / 100 - 1).alias("t"))
        visits = asking.select("d", "chunk", "t", "v").mapInArrow(_visits_task(pivots, radius), "d int, chunk long, block int").distinct()
        visits = (visits.withColumn("part", F.explode(F.sequence(F.lit(0), n_parts - 1))))
        visits, visits_path = stored_table(visits, "negatives-visits")
        by = ["d", "chunk", "block", "part"]
        found = (asking.join(visits, ["d", "chunk"]).groupBy(*by).cogroup(_renewed(refs.join(visits, ["d", "block", "part"])).groupBy(*by))
                 .applyInPandas(_negatives_task(n_negatives, level, high), "row long, place long, vec_id long, score long"))
        best = Window.partitionBy("row", "place").orderBy(F.desc("score"), "vec_id")
        found = (found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= n_negatives))
        found = materialize(found, "negatives-found")
        delete_path(spark, visits_path)
        if n == len(levels) - 1:
            done.append(found)
            break
        full = found.where(F.col("rank") == n_negatives).select("row", "place")
        done.append(found.join(full, ["row", "place"], "left_semi"))
        open_ = materialize(open_.join(full, ["row", "place"], "left_anti"), "negatives-open")
        if open_.isEmpty():
            break
    all_ = done[0]
    for more in done[1:]:
        all_ = all_.union(more)
    negative = all_.select("row", "place", "rank", F.col("vec_id").alias("negative_id"), F.col("score").alias("negative_score"))
    positive = windows.select("row", "place", F.col("vec_id").alias("positive_id"), F.col("score").alias("positive_score"))
    names = rows.where(is_anchor).select("row", F.col("vec_id").alias("anchor_id"))
    return negative.join(positive, ["row", "place"]).join(names, "row").select(
        "anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")


#: The registered query: every hundredth id is an anchor, labels of every seventh are off by one.
ANCHOR_EVERY, NOISE_EVERY, LABELS = 100, 7, 10


def query(table: DataFrame) -> DataFrame:
    noisy = F.when(F.col("vec_id") % NOISE_EVERY == 0, (F.col("label") + 1) % LABELS).otherwise(F.col("label"))
    return mine(table.select("vec_id", "label", "embedding"), F.col("vec_id") % ANCHOR_EVERY == 0, noisy)


ORACLE_SQL = f"""
WITH v AS (
  SELECT DISTINCT vec_id, CASE WHEN vec_id % {NOISE_EVERY} = 0 THEN (label + 1) % {LABELS} ELSE label END AS label,
         list_transform(embedding, lambda x: CAST(floor(256.0 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (
  SELECT a.vec_id AS anchor_id, c.vec_id AS vec_id, a.label = c.label AS same,
         CAST(list_sum(list_transform(list_zip(a.v, c.v), lambda p: p[1] * p[2])) AS BIGINT) AS score
  FROM v a JOIN v c ON a.vec_id <> c.vec_id AND len(a.v) = len(c.v) WHERE a.vec_id % {ANCHOR_EVERY} = 0),
positive AS (
  SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM scored WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= {POSITIVES})
SELECT p.anchor_id, p.positive_id, CAST(row_number() OVER (PARTITION BY p.anchor_id, p.positive_id ORDER BY s.score DESC, s.vec_id) AS INTEGER) AS rank,
       s.vec_id AS negative_id, p.positive_score, s.score AS negative_score
FROM positive p JOIN scored s ON s.anchor_id = p.anchor_id AND NOT s.same
WHERE {LOW} * p.positive_score <= 100 * s.score AND 100 * s.score <= {HIGH} * p.positive_score
QUALIFY rank <= {NEGATIVES}
"""
