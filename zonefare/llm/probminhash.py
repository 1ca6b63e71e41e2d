"""Near-duplicates by ProbMinHash over weighted word shingles, banding and verification.

A text is lower-cased, its words joined by single blanks; its shingles are the
runs of five words (all words if there are fewer), weighted by how often they
occur.  ProbMinHash: every shingle sends points of a Poisson process of rate
weight to random registers; a register keeps the shingle that arrives first, and
a shingle stops once its next point is later than every register's first one
(early termination, which cannot change the result).  Two texts agree in a
register with the probability Jaccard similarity of their weighted shingles.
A second signature with all weights 1, in the same buckets, agrees with their
plain Jaccard similarity; it is the first one where no shingle is repeated.

Equal texts become one node first.  The registers are cut into bands; nodes that
share a band are candidates.  Every pair that is linked passed the exact test:
probability Jaccard or plain Jaccard of the shingle sets at least 0.8.

Pairs are not enumerated within a bucket.  First every node is compared to its
buckets' hubs (the node with most bucket neighbours, which is the original in a
group of edited copies) and the links are joined to components.  A bucket whose
nodes are then all in one component is done: a further link inside could not
change a class.  What is left are nodes that no hub took.  Most of them cannot be
linked to any node: a shingle found in no other remaining node is lost to every
pair, so their count bounds both similarities from above.  The others are compared
to the nodes of other components, in blocks that send a text once per block and
return links only.  No bucket is capped and no pair that could be linked is skipped.

Everything keyed by band, node or component is map-side combined or a plain join
that Spark can split; nothing is collected.

Cases: a null text is empty; texts without words are copies of each other; a
class is named by its least document id (nulls last); repeated rows are in one
class and one of them is the representative; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from zonefare.llm.common import GAP, materialize, text_or_empty, unsliced

SHINGLE = 5
THRESHOLD = 0.8
BANDS = 26
ROWS = 5
#: Words handled at once in a task (a longer text is handled alone).
CHUNK_WORDS = 500_000
#: A block of the comparison of remaining nodes, in nodes.
STRAYS, MEMBERS = 256, 512


# ---- numpy, inside tasks --------------------------------------------------------------------------------

def mix(x):
    """Finaliser of splitmix64 on uint64 arrays."""
    import numpy as np
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingles(texts):
    """(document index, shingle hash, count), sorted, of a list of normalised texts (a string array of Arrow)."""
    import numpy as np
    import pandas as pd
    import pyarrow.compute as pc

    texts = unsliced(texts)
    lists = pc.split_pattern(texts, " ")
    if hasattr(lists, "combine_chunks"):
        lists = lists.combine_chunks()
    ends = lists.offsets.to_numpy().astype(np.int64)
    ends = ends - ends[0]
    words = lists.flatten().dictionary_encode()
    table = pd.util.hash_array(words.dictionary.to_numpy(zero_copy_only=False).astype(object), categorize=False)
    w = table[words.indices.to_numpy()] if len(words) else np.empty(0, np.uint64)
    sizes = np.diff(ends)
    sizes[np.asarray(pc.equal(pc.binary_length(texts), 0))] = 0  # an empty text splits into one empty word
    doc = np.repeat(np.arange(len(sizes)), np.diff(ends))
    left = (ends[1:])[doc] - np.arange(len(w))  # words from here to the end of the text
    with np.errstate(over="ignore"):
        acc = np.zeros(len(w), np.uint64)
        for k in range(SHINGLE):
            part = np.zeros(len(w), np.uint64)
            part[:len(w) - k] = mix(w[k:] + np.uint64(k + 1))
            part[left <= k] = 0  # past the end: only for texts shorter than a shingle
            acc = acc * np.uint64(0x9E3779B97F4A7C15) + part
        acc = mix(acc)
    first = np.arange(len(w)) == ends[:-1][doc]
    use = (sizes[doc] > 0) & ((left >= SHINGLE) | first)
    doc, acc = doc[use], acc[use]
    order = np.lexsort((acc, doc))
    doc, acc = doc[order], acc[order]
    new = np.ones(len(doc), bool)
    new[1:] = (doc[1:] != doc[:-1]) | (acc[1:] != acc[:-1])
    at = np.flatnonzero(new)
    return doc[at], acc[at], np.diff(np.append(at, len(doc)))


def signatures(doc, element, weight, n_docs: int, registers: int):
    """ProbMinHash signature (n_docs x registers) of the element that arrives first in each register."""
    import numpy as np

    first = np.full(n_docs * registers, np.inf)
    sig = np.zeros(n_docs * registers, np.uint64)
    e, d, w, t = element, doc, weight.astype(float), np.zeros(len(element))
    j = 0
    with np.errstate(over="ignore"):
        while len(e):
            j += 1
            x = mix(e + np.uint64(j) * np.uint64(0xD1B54A32D192ED03))
            t = t - np.log(((x >> np.uint64(11)).astype(float) + 0.5) / float(1 << 53)) / w
            k = ((mix(x + np.uint64(1)) >> np.uint64(32)) * np.uint64(registers) >> np.uint64(32)).astype(np.int64)
            at = d * registers + k
            early = t < first[at]
            spot, time = at[early], t[early]
            np.minimum.at(first, spot, time)
            won = time == first[spot]
            sig[spot[won]] = e[early][won]
            live = np.unique(d)
            last = np.full(n_docs, -1.0)
            last[live] = first.reshape(n_docs, registers)[live].max(axis=1)
            go = t < last[d]
            e, d, w, t = e[go], d[go], w[go], t[go]
    return sig.reshape(n_docs, registers)


def band_keys(sig, bands: int, rows: int):
    """One 64-bit key per band."""
    import numpy as np

    parts = sig.reshape(len(sig), bands, rows)
    acc = np.broadcast_to(np.arange(1, bands + 1, dtype=np.uint64), (len(sig), bands)).copy()
    with np.errstate(over="ignore"):
        for k in range(rows):
            acc = mix(acc * np.uint64(0x9E3779B97F4A7C15) + parts[:, :, k])
    return acc.astype(np.int64)


def similarity(a, b) -> tuple[float, float]:
    """(probability Jaccard, plain Jaccard) of two (sorted hashes, counts)."""
    import numpy as np

    (ha, ca), (hb, cb) = a, b
    if not len(ha) or not len(hb):
        return (1.0, 1.0) if len(ha) == len(hb) else (0.0, 0.0)
    common, ia, ib = np.intersect1d(ha, hb, assume_unique=True, return_indices=True)
    if not len(common):
        return 0.0, 0.0
    plain = len(common) / (len(ha) + len(hb) - len(common))
    x = np.concatenate([ca[ia], np.delete(ca, ia), np.zeros(len(hb) - len(common))]).astype(float)
    y = np.concatenate([cb[ib], np.zeros(len(ha) - len(common)), np.delete(cb, ib)]).astype(float)
    # sum over j of max(x_j / x_i, y_j / y_i) = S(r_i) / x_i with S(r) = sum of max(x_j, r y_j), r_i = x_i / y_i
    ratio = np.divide(x, y, out=np.full(len(x), np.inf), where=y > 0)
    order = np.argsort(ratio, kind="stable")
    below_y = np.concatenate([[0.0], np.cumsum(y[order])])
    above_x = x.sum() - np.concatenate([[0.0], np.cumsum(x[order])])
    r = ratio[:len(common)]
    cut = np.searchsorted(ratio[order], r, side="left")
    return float((x[:len(common)] / (r * below_y[cut] + above_x[cut])).sum()), plain


def _sketch_task(columns: list[str], bands: int, rows: int):
    def run(batches):
        import numpy as np
        import pyarrow as pa
        import pyarrow.compute as pc
        from pyspark import TaskContext

        pid, seen = TaskContext.get().partitionId(), 0
        for batch in batches:
            batch = pa.Table.from_batches([batch]).combine_chunks().to_batches()[0] if len(batch) else batch
            words = np.cumsum(np.asarray(pc.count_substring(batch.column(batch.num_columns - 1), " ")) + 1) if len(batch) else []
            start = 0
            while start < len(batch):
                base = words[start - 1] if start else 0
                stop = max(start + 1, int(np.searchsorted(words, base + CHUNK_WORDS, side="right")))
                part = batch.slice(start, stop - start)
                norm = part.column(part.num_columns - 1)
                norm = norm.cast(pa.large_string()) if not pa.types.is_large_string(norm.type) else norm
                doc, element, weight = shingles(norm)
                n = np.bincount(doc, minlength=len(part))
                total = np.bincount(doc, weight, minlength=len(part)).astype(np.int64)
                keys = band_keys(signatures(doc, element, weight, len(part), bands * rows), bands, rows)
                # again with weight 1: plain Jaccard; the same bands where no shingle is repeated
                again = np.flatnonzero(total > n)
                use = (total > n)[doc]
                plain = band_keys(signatures(np.searchsorted(again, doc[use]), element[use], np.ones(use.sum()), len(again), bands * rows), bands, rows)
                size = (n > 0) * bands
                size[again] += (plain != keys[again]).sum(axis=1)
                ends = np.concatenate([[0], np.cumsum(size)])
                both = np.concatenate([keys, np.zeros_like(keys)], axis=1)
                both[again, bands:] = plain
                kept = np.zeros(both.shape, bool)
                kept[n > 0, :bands] = True
                kept[again, bands:] = plain != keys[again]
                lists = pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), pa.array(both[kept]))
                ids = pa.array((np.int64(pid) << 33) + seen + np.arange(len(part)))
                yield pa.RecordBatch.from_arrays([*part.columns[:-1], ids, pa.array(n.astype(np.int64)), pa.array(total), lists],
                                                 names=[*columns, "__rid", "__n", "__total", "__bands"])
                seen, start = seen + len(part), stop
    return run


def _shingle_task():
    def run(batches):
        import pyarrow as pa

        for batch in batches:
            for start in range(0, len(batch), 256):
                part = batch.slice(start, 256)
                doc, element, weight = shingles(part.column(1).cast(pa.large_string()))
                yield pa.RecordBatch.from_arrays([pa.array(element.view("int64")), part.column(0).take(pa.array(doc)), pa.array(weight.astype("int32"))],
                                                 names=["h", "node", "w"])
    return run


def _block_task(threshold: float):
    def run(key, strays, members):
        import numpy as np
        import pandas as pd
        import pyarrow as pa

        none = pd.DataFrame({"a": pd.Series([], dtype=object), "b": pd.Series([], dtype=object)})
        if not len(strays) or not len(members):
            return none
        n = len(members)
        doc, element, weight = shingles(pa.array([*members["norm"], *strays["norm"]], pa.large_string()))
        known, local = np.unique(element, return_inverse=True)
        start = np.searchsorted(doc, np.arange(n + len(strays) + 1))
        mine, at = local[:start[n]], start[:n]
        total = np.bincount(doc, weight, n + len(strays))
        has, held = np.zeros(len(known)), np.zeros(len(known))
        top: dict = {}  # components joined so far within this block

        def find(c):
            while top.get(c, c) != c:
                c = top[c]
            return c

        a, b = [], []
        for i, (node, c) in enumerate(zip(strays["node"], strays["c"])):
            lo, hi = start[n + i], start[n + i + 1]
            has[local[lo:hi]], held[local[lo:hi]] = 1.0, weight[lo:hi]
            count = np.add.reduceat(has[mine], at)
            plain = count / np.maximum(hi - lo + np.diff(start[:n + 1]) - count, 1)
            # the probability Jaccard is at most the weight share of the common shingles, in either text
            share = np.minimum(np.add.reduceat(has[mine] * weight[:start[n]], at) / total[:n], np.add.reduceat(held[mine], at) / total[n + i])
            has[local[lo:hi]], held[local[lo:hi]] = 0.0, 0.0
            for m in np.flatnonzero((plain >= threshold - 1e-12) | (share >= threshold - 1e-9)):
                x, y = find(c), find(members["c"].iat[m])
                if x == y:
                    continue
                if plain[m] < threshold - 1e-12:
                    p, q = start[m], start[m + 1]
                    if similarity((element[p:q], weight[p:q]), (element[lo:hi], weight[lo:hi]))[0] < threshold - 1e-12:
                        continue
                a.append(node)
                b.append(members["node"].iat[m])
                top[max(x, y)] = min(x, y)
        return pd.DataFrame({"a": pd.Series(a, dtype=object), "b": pd.Series(b, dtype=object)}) if a else none
    return run


def _verify_task(threshold: float):
    def run(batches):
        import pyarrow as pa

        last, known = None, None
        for batch in batches:
            a, b, ta, tb = (batch.column(i) for i in range(4))
            good = []
            for i in range(len(batch)):
                key = a[i].as_py()
                if key != last:
                    last, known = key, shingles(ta.slice(i, 1).cast(pa.large_string()))[1:]
                other = shingles(tb.slice(i, 1).cast(pa.large_string()))[1:]
                if max(similarity(known, other)) >= threshold - 1e-12:
                    good.append(i)
            take = pa.array(good, pa.int64())
            yield pa.RecordBatch.from_arrays([a.take(take), b.take(take)], names=["a", "b"])
    return run


# ---- the graph ------------------------------------------------------------------------------------------

def _star_round(edges: DataFrame) -> DataFrame:
    """A large-star and a small-star step: edges (a, b) move towards the least node of their component."""
    both = edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    large = both.where("b > a").join(least, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
    least = large.groupBy("a").agg(F.min("b").alias("m"))
    small = large.join(least, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return small.union(least.select("a", F.col("m").alias("b"))).select(
        F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, component) of the nodes that have an edge; a component is named by its least node."""
    edges = materialize(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b").distinct(), "edges")
    state = None
    while True:
        new = edges.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")), F.lit(0))).first()
        if tuple(new) == state:
            break
        state = tuple(new)
        edges = materialize(_star_round(edges), "edges")
    tops = edges.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    return edges.select(F.col("a").alias("node"), F.col("b").alias("component")).union(tops)


def normalised(text: Column) -> Column:
    return F.trim(F.regexp_replace(F.lower(text), GAP, " "))


def classes(docs: DataFrame, id_col: str = "doc_id", text: str = "text", threshold: float = THRESHOLD,
            bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """The input rows plus class_id (least id of the class), copy_class_id (of equal texts) and representative.

    The input is written once to the shared folder with its node and bands.
    """
    cols = [c for c in docs.columns if c not in ("class_id", "copy_class_id", "representative", "__key", "__rid", "__n", "__total", "__bands")]
    norm = normalised(text_or_empty(text))
    staged = docs.select(*cols, norm.alias("__norm")).select(*cols, F.unhex(F.md5("__norm")).alias("__key"), "__norm")
    schema = T.StructType([*staged.drop("__norm").schema.fields, *[T.StructField(c, T.LongType()) for c in ("__rid", "__n", "__total")],
                           T.StructField("__bands", T.ArrayType(T.LongType()))])
    rows_ = materialize(staged.mapInArrow(_sketch_task([*cols, "__key"], bands, rows), schema), "near-rows")

    named = F.struct(F.col(id_col).isNull().alias("n"), F.col(id_col).alias("id"), F.col("__rid").alias("rid"))
    nodes = materialize(rows_.groupBy("__key").agg(F.min(named).alias("rep"), F.first("__n").alias("n"), F.first("__total").alias("total"),
                                                   F.first("__bands").alias("bands")), "near-nodes")
    buckets = nodes.select(F.col("__key").alias("node"), F.explode("bands").alias("bucket"))
    shared = buckets.groupBy("bucket").agg(F.count(F.lit(1)).alias("members")).where("members > 1")
    spokes = materialize(buckets.join(shared, "bucket"), "near-buckets")  # bucket, node, members: shared buckets only
    degree = spokes.groupBy("node").agg(F.sum(F.col("members") - 1).alias("degree"))
    hubs = spokes.join(degree, "node").groupBy("bucket").agg(F.max(F.struct("degree", "node"))["node"].alias("hub"))
    spokes = materialize(spokes.drop("members").join(hubs, "bucket"), "near-spokes")

    pairs = spokes.where("node <> hub").select(F.least("hub", "node").alias("a"), F.greatest("hub", "node").alias("b")).distinct()
    links = materialize(_verified(rows_, nodes, pairs, text, threshold), "near-links")
    comp = materialize(components(links), "near-components")

    # nodes that a hub of theirs did not take, against the other components of the bucket
    of = lambda c, out: comp.select(F.col("node").alias(c), F.col("component").alias(out))
    placed = (spokes.join(of("node", "c"), "node", "left").join(of("hub", "hub_c"), "hub", "left")
              .select("bucket", "node", "hub", F.coalesce("c", "node").alias("c"), F.coalesce("hub_c", "hub").alias("hub_c")))
    strays = materialize(placed.where("c <> hub_c"), "near-strays")
    left = materialize(placed.join(strays.select("bucket").distinct(), "bucket", "left_semi"), "near-left")
    bounds = _bounds(rows_, nodes, left.select("node").distinct(), text, threshold)
    more = materialize(_linked_in_blocks(rows_, nodes, left.join(bounds, "node"), text, threshold), "near-links")
    if not more.isEmpty():
        comp = materialize(components(comp.select(F.col("node").alias("a"), F.col("component").alias("b")).union(more)), "near-components")

    classed = nodes.join(comp, nodes["__key"] == comp["node"], "left").select(
        "__key", "rep", F.coalesce("component", "__key").alias("component"))
    heads = classed.groupBy("component").agg(F.min("rep").alias("head"))
    named_nodes = classed.join(heads, "component").select(
        F.col("__key"), F.col("head.id").alias("class_id"), F.col("rep.id").alias("copy_class_id"), F.col("head.rid").alias("__head"))
    return (rows_.drop("__bands").join(named_nodes, "__key").withColumn("representative", F.col("__rid") == F.col("__head"))
            .select(*cols, "class_id", "copy_class_id", "representative"))


def _bounds(rows: DataFrame, nodes: DataFrame, wanted: DataFrame, text: str, threshold: float) -> DataFrame:
    """node, bound (n, shared, mass): distinct shingles, those that another wanted node may share, and the share of
    the weight on these; nodes that cannot be linked to any wanted node are left out."""
    reps = materialize(nodes.join(wanted.withColumnRenamed("node", "__key"), "__key", "left_semi").select("__key", F.col("rep.rid").alias("__rid"), "n", "total"),
                       "near-wanted")
    texts = rows.join(reps.select("__rid"), "__rid", "left_semi").select("__rid", normalised(text_or_empty(text)).alias("norm"))
    once = (texts.mapInArrow(_shingle_task(), "h long, node long, w int").groupBy("h")
            .agg(F.count(F.lit(1)).alias("times"), F.min("node").alias("__rid"), F.min("w").alias("w")).where("times = 1"))
    lost = once.groupBy("__rid").agg(F.count(F.lit(1)).alias("lost"), F.sum("w").alias("lost_w"))
    own = reps.join(lost, "__rid", "left").na.fill(0, ["lost", "lost_w"]).select(
        F.col("__key").alias("node"), F.struct("n", (F.col("n") - F.col("lost")).alias("shared"),
                                               ((F.col("total") - F.col("lost_w")) / F.col("total")).alias("mass"),
                                               (F.col("n") == F.col("total")).alias("plain")).alias("bound"))
    low = threshold - 1e-9
    return materialize(own.where(f"bound.shared >= {low} * bound.n OR (NOT bound.plain AND bound.mass >= {low})"), "near-bounds")


def _linked_in_blocks(rows: DataFrame, nodes: DataFrame, left: DataFrame, text: str, threshold: float) -> DataFrame:
    """Links (a, b) between nodes of different components that share a bucket.

    Nodes meet by the component of their buckets' hub.  In a group every node outside the hub's component is compared
    to all others, in blocks of `STRAYS` x `MEMBERS` nodes: texts are sent once per block, only links come out.
    """
    member = left.select(F.col("hub_c").alias("group"), "node", "c").distinct()
    member = materialize(member.withColumn("stray", F.col("c") != F.col("group")), "near-members")
    chunks = member.groupBy("group").agg(F.ceil(F.sum(F.col("stray").cast("int")) / STRAYS).cast("int").alias("ns"),
                                         F.ceil(F.count(F.lit(1)) / MEMBERS).cast("int").alias("nm")).where("ns > 0")
    reps = nodes.join(member.select(F.col("node").alias("__key")).distinct(), "__key", "left_semi").select(F.col("rep.rid").alias("__rid"))
    texts = materialize(rows.join(reps, "__rid", "left_semi").select(F.col("__key").alias("node"), normalised(text_or_empty(text)).alias("norm")), "near-texts")
    placed = materialize(member.join(chunks, "group").join(texts, "node"), "near-placed")
    of = lambda n: F.pmod(F.xxhash64("node"), F.col(n)).cast("int")
    each = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    strays = placed.where("stray").select("group", "node", "c", "norm", of("ns").alias("i"), each("nm").alias("j"))
    members = placed.select("group", "node", "c", "norm", of("nm").alias("j"), each("ns").alias("i"))
    return strays.groupBy("group", "i", "j").cogroup(members.groupBy("group", "i", "j")).applyInPandas(_block_task(threshold), "a binary, b binary")


def _verified(rows: DataFrame, nodes: DataFrame, pairs: DataFrame, text: str, threshold: float) -> DataFrame:
    """The pairs (a, b) of nodes whose texts pass the exact test."""
    pairs = materialize(pairs, "near-pairs")
    wanted = pairs.select(F.col("a").alias("__key")).union(pairs.select(F.col("b").alias("__key"))).distinct()
    reps = nodes.join(wanted, "__key", "left_semi").select(F.col("rep.rid").alias("__rid"))
    texts = materialize(rows.join(reps, "__rid", "left_semi").select(
        F.col("__key").alias("key"), normalised(text_or_empty(text)).alias("norm")), "near-texts")
    left = pairs.join(texts.select(F.col("key").alias("b"), F.col("norm").alias("text_b")), "b")
    both = left.join(texts.select(F.col("key").alias("a"), F.col("norm").alias("text_a")), "a")
    return both.select("a", "b", "text_a", "text_b").mapInArrow(_verify_task(threshold), "a binary, b binary")


def deduplicated(docs: DataFrame, id_col: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """One row of each class (its representative), with the columns of the input."""
    clash = {c: f"__own{i}" for i, c in enumerate(docs.columns)}
    out = classes(docs.withColumnsRenamed(clash), clash[id_col], clash[text], **options).where("representative")
    return out.select(*[F.col(v).alias(k) for k, v in clash.items()])
