"""Toxicity by a classifier chain over hashed words.

Categories are predicted in order; each linear model sees the words and the
log-odds that the models before it gave.  In training those log-odds are out of
fold: a document's value comes from models that have not seen it, so a later
model learns how far the earlier ones can be trusted.  `lexical` is a labelled
toxic document with a word of the seed list, `veiled` one without, `toxic` the label.

A token gives two features, itself without outer punctuation and its first five
characters, hashed into 2^20 places; a document holds each distinct token once.  A
model picks the features whose log-odds ratio differs clearly from zero and fits a
logistic regression on them, so long texts do not add noise.

Training takes at most `SAMPLE` labelled documents (expected number; half of each
label, chosen by a hash of the id, weighted back), whole texts, one task.  The
models, 2^20 numbers per category, are broadcast; scoring is one pass without shuffle.

Cases: a null text is empty and gets the prior; labels that are null or without a
document are not used; without toxic labels the models give the prior of zero;
repeated documents are scored alike; an empty table gives an empty result; input
columns other than id and text are not read.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from zonefare.llm.bloom_lm import token_chunks
from zonefare.llm.common import materialize, unit_hash

CATEGORIES = ("lexical", "veiled", "toxic")
# Seed words of the lexical category.
SEEDS = ("idiot", "moron", "stupid", "loser", "clown", "trash", "scum", "worthless", "pathetic", "disgusting")
PLACES = 1 << 20
PREFIX = 5
SAMPLE = 8000
FOLDS = 3
SELECTED = 4096
Z_LEAST = 3.0
STEPS = 200
RIDGE = 2e-3
THRESHOLD = 0.5
OUTER = "!\"#$%&'()*+,-./:;<=>?@[]^_`{|}~"


# ---- tasks ----------------------------------------------------------------------------------------------

def features(vocab):
    """Two feature numbers per token of a dictionary; -1 where a token is punctuation only."""
    import numpy as np
    import pandas as pd
    import pyarrow.compute as pc
    bare = pc.ascii_trim(vocab, OUTER)
    whole = pd.util.hash_array(bare.to_numpy(zero_copy_only=False).astype(object), categorize=False)
    start = pd.util.hash_array(pc.utf8_slice_codeunits(bare, 0, PREFIX).to_numpy(zero_copy_only=False).astype(object), categorize=False)
    with np.errstate(over="ignore"):
        out = np.stack([whole % np.uint64(PLACES), (start * np.uint64(0x9E3779B97F4A7C15) + np.uint64(1)) % np.uint64(PLACES)]).astype(np.int64)
    out[:, np.asarray(pc.utf8_length(bare)) == 0] = -1
    return out


def distinct_tokens(codes, doc, size: int):
    """(document, token) pairs without repeats, by document."""
    import numpy as np
    pair = np.unique(doc * size + codes)
    return pair // size, pair % size


def _feature_task():
    def run(batches):
        import numpy as np
        import pyarrow as pa
        import pyarrow.compute as pc
        for part, vocab, codes, doc in token_chunks(batches):
            f = features(vocab)
            seed = np.asarray(pc.is_in(pc.ascii_trim(vocab, OUTER), value_set=pa.array(SEEDS, vocab.type)))
            d, c = distinct_tokens(codes, doc, len(vocab))
            ok = f[0][c] >= 0
            d, c = d[ok], c[ok]
            ends = pa.array((2 * np.searchsorted(d, np.arange(len(part) + 1))).astype(np.int32))
            lists = pa.ListArray.from_arrays(ends, pa.array(f[:, c].T.ravel().astype(np.int32)))
            lexical = np.bincount(d, seed[c], len(part)) > 0
            yield pa.RecordBatch.from_arrays([part.column(part.schema.get_field_index(x)) for x in ("doc_id", "toxic", "weight")]
                                             + [pa.array(lexical), lists], names=["doc_id", "toxic", "weight", "lexical", "features"])
    return run


class Linear:
    """Logistic regression on selected hashed features and dense columns."""

    def __init__(self, rows, cols, n, dense, y, weight):
        import numpy as np
        yes, no = weight[y == 1].sum(), weight[y == 0].sum()
        self.places, self.w = np.empty(0, np.int64), np.zeros(1 + dense.shape[1])
        prior = np.log((yes + 0.5) / (no + 0.5)) if len(y) else -9.0
        self.w[0] = np.clip(prior, -9, 9)
        if not (y == 1).any() or not (y == 0).any():
            self.w[0] = 9.0 if len(y) and (y == 1).all() else -9.0
            return
        t = np.bincount(cols, (y == 1)[rows], PLACES)
        c = np.bincount(cols, (y == 0)[rows], PLACES)
        nt, nc = (y == 1).sum(), (y == 0).sum()
        ratio = np.log((t + 0.5) / (nt + 1.0)) - np.log((c + 0.5) / (nc + 1.0))
        z = ratio / np.sqrt(1 / (t + 0.5) + 1 / (c + 0.5))
        z[(t + c) < 2] = 0
        best = np.argsort(-np.abs(z), kind="stable")[:SELECTED]
        self.places = np.sort(best[np.abs(z[best]) >= Z_LEAST])
        index = np.full(PLACES, -1)
        index[self.places] = np.arange(len(self.places))
        keep = index[cols] >= 0
        r, k = rows[keep], index[cols[keep]]
        share = weight / weight.sum()
        w = np.zeros(1 + dense.shape[1] + len(self.places))
        w[0] = self.w[0]
        square = np.full(len(w), 1e-8)
        for _ in range(STEPS):
            s = w[0] + dense @ w[1:1 + dense.shape[1]] + np.bincount(r, w[1 + dense.shape[1]:][k], n)
            g = share * (1 / (1 + np.exp(-np.clip(s, -30, 30))) - y)
            grad = np.concatenate([[g.sum()], dense.T @ g, np.bincount(k, g[r], len(self.places))]) + RIDGE * w / max(1, len(w)) * (np.arange(len(w)) > 0)
            square += grad * grad
            w -= 0.5 * grad / np.sqrt(square)
        self.w = w

    def scores(self, rows, cols, n, dense):
        import numpy as np
        table = np.zeros(PLACES)
        d = dense.shape[1]
        table[self.places] = self.w[1 + d:]
        return np.clip(self.w[0] + dense @ self.w[1:1 + d] + np.bincount(rows, table[cols], n), -15, 15)


def train_chain(ids, labels, weight, lists):
    """Models per category; `labels`: documents x categories, `lists`: feature numbers per document."""
    import numpy as np
    n = len(ids)
    size = np.array([len(x) for x in lists], np.int64)
    cols = np.concatenate([*lists, np.empty(0, np.int32)]).astype(np.int64)
    rows = np.repeat(np.arange(n), size)
    fold = np.arange(n) % FOLDS  # the rows come sorted by a hash of the id
    dense, models = np.zeros((n, 0)), []
    for j in range(labels.shape[1]):
        y = labels[:, j].astype(float)
        models.append(Linear(rows, cols, n, dense, y, weight))
        out = np.zeros(n)
        for f in range(FOLDS):
            new = np.cumsum(fold != f) - 1  # row number among the rows of the other folds
            train, rest = fold[rows] != f, fold != f
            m = Linear(new[rows[train]], cols[train], int(rest.sum()), dense[rest], y[rest], weight[rest])
            mine = ~train
            out[fold == f] = m.scores((np.cumsum(fold == f) - 1)[rows[mine]], cols[mine], int((fold == f).sum()), dense[fold == f])
        dense = np.column_stack([dense, out])
    return models


def _train_task(pdf):
    import numpy as np
    import pandas as pd
    pdf = pdf.sort_values(["order", "doc_id"], kind="stable").reset_index(drop=True)
    toxic, lexical = pdf["toxic"].to_numpy() == 1, pdf["lexical"].to_numpy(bool)
    labels = np.column_stack([toxic & lexical, toxic & ~lexical, toxic])
    models = train_chain(pdf["doc_id"].to_numpy(), labels, pdf["weight"].to_numpy(float), pdf["features"].to_list())
    return pd.DataFrame({"category": range(len(models)), "places": [m.places.tolist() for m in models], "w": [m.w.tolist() for m in models]})


def _score_task(models):
    def run(batches):
        import numpy as np
        import pyarrow as pa
        tables = []
        for j, (places, w) in enumerate(models.value):
            t = np.zeros(PLACES + 1)  # the last place takes tokens without features
            t[places] = w[1 + j:]
            tables.append((w[:1 + j], t))
        for part, vocab, codes, doc in token_chunks(batches):
            f = features(vocab)
            d, c = distinct_tokens(codes, doc, len(vocab))
            logits = []
            for head, t in tables:
                per_token = t[f[0]] + t[f[1]]
                s = head[0] + np.bincount(d, per_token[c], len(part)) + sum(x * w for x, w in zip(logits, head[1:]))
                logits.append(np.clip(s, -15, 15))
            p = [pa.array(1 / (1 + np.exp(-s))) for s in logits]
            yield pa.RecordBatch.from_arrays([part.column(part.schema.get_field_index("doc_id")), *p], names=["doc_id", *[f"p_{x}" for x in CATEGORIES]])
    return run


# ---- the operator ---------------------------------------------------------------------------------------

def training_rows(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """A bounded sample of labelled documents, with the inverse of its share as weight."""
    flags = labels.where("toxic IS NOT NULL AND doc_id IS NOT NULL").groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    n = {r["toxic"]: r["n"] for r in flags.groupBy("toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
    share = {k: min(1.0, sample / 2 / n[k]) if n.get(k) else 1.0 for k in (0, 1)}
    of = F.when(F.col("toxic") == 1, share[1]).otherwise(share[0])
    chosen = flags.where("toxic IN (0, 1)").withColumn("weight", 1 / of).where(unit_hash("toxicity", F.col("doc_id")) < of)
    chosen = materialize(chosen, "toxic-sample")
    return docs.join(chosen, "doc_id").dropDuplicates(["doc_id"])


def classify(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, a probability per category, and toxic, for every document."""
    spark = docs.sparkSession
    docs = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    id_type = docs.schema["doc_id"].dataType.simpleString()
    rows = training_rows(docs, labels.select("doc_id", F.col("toxic").cast("int")), sample)
    hashed = rows.select("doc_id", "toxic", "weight", "text").mapInArrow(
        _feature_task(), f"doc_id {id_type}, toxic int, weight double, lexical boolean, features array<int>")
    models = (hashed.withColumn("order", unit_hash("fold", F.col("doc_id"))).groupBy(F.lit(0).alias("all"))
              .applyInPandas(_train_task, "category int, places array<long>, w array<double>").collect())
    import numpy as np
    by = {r["category"]: (np.array(r["places"], np.int64), np.array(r["w"])) for r in models}
    none = [(np.empty(0, np.int64), np.array([-9.0] + [0.0] * j)) for j in range(len(CATEGORIES))]
    chain = spark.sparkContext.broadcast([by.get(j, none[j]) for j in range(len(CATEGORIES))])
    out = docs.mapInArrow(_score_task(chain), f"doc_id {id_type}, " + ", ".join(f"p_{c} double" for c in CATEGORIES))
    return out.withColumn("toxic", F.col("p_toxic") >= threshold)
