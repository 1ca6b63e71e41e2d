"""Document quality by hierarchical empirical Bayes over hosts and paths.

A classifier gives every document its own evidence: a probability of good quality
from the shape of the text, hence a log Bayes factor against the classifier's base
rate.  Sites give the prior: a path's rate of good documents is drawn around its
host's, a host's around the global one.  How tightly is estimated from the data
(method of moments on grouped sums), so a host or path with few documents is
shrunk towards the level above, one with many speaks for itself.  A document's own
share is taken out of its site's sums before they become its prior.

The site levels are grouped aggregates (map-side combined) over (host, path,
probability); their tables, one row per site, are written and joined without a
hint.  The classifier (ten weights) is trained on at most `SAMPLE` labelled
documents, whole texts.

Cases: null host or path is a site of its own; a null or empty text has no words
and is not kept; without labels of both kinds the evidence is neutral; repeated
rows count as often as they come and get the same result; an empty table gives an
empty result; input columns named like an output column are replaced.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from zonefare.llm.bloom_lm import token_chunks
from zonefare.llm.common import materialize, unit_hash

SAMPLE = 8000
SHAPES = 9
#: Bounds of a site level's strength, in documents.
STRENGTH = (2.0, 200.0)
#: Evidence of one document is at most this many natural logs.
EVIDENCE = 12.0
MIN_WORDS = 1


def _shape_rows(batches):
    """(part, shape matrix, words): shares that do not depend on the vocabulary of a language."""
    import numpy as np
    import pyarrow.compute as pc
    for part, vocab, codes, doc in token_chunks(batches, lower=False):
        m = len(part)
        words = np.bincount(doc, minlength=m) - 1.0  # without the end token
        real = codes < len(vocab) - 1
        c, d = codes[real], doc[real]
        n = np.maximum(words, 1)
        length = np.asarray(pc.utf8_length(vocab), float)
        flag = lambda p: np.asarray(pc.match_substring_regex(vocab, p), float)
        symbol, shout, upper = flag(r"[#*$%&|<>{}\\^~=]"), flag(r"[!?]{2,}"), flag(r"^\p{Lu}{2,}\P{L}*$")
        bare, digits = flag(r"^\P{L}+$"), flag(r"[0-9]{3,}")
        mean = lambda x: np.bincount(d, x[c], m) / n
        same = np.zeros(len(c))
        same[1:] = (c[1:] == c[:-1]) & (d[1:] == d[:-1])
        kinds = np.bincount(np.unique(d * len(vocab) + c) // len(vocab), minlength=m)
        x = np.column_stack([
            np.log(mean(length) + 1), np.sqrt(mean(symbol)), np.sqrt(mean(shout)), np.sqrt(mean(upper)), np.sqrt(mean(bare)), np.sqrt(mean(digits)),
            np.sqrt(np.bincount(d, same, m) / n), np.log(kinds + 10.0) / np.log(n + 10.0), np.minimum(words, 20) / 20])
        yield part, x, words


def _sample_task(batches):
    import pyarrow as pa
    for part, x, _ in _shape_rows(batches):
        yield pa.RecordBatch.from_arrays([part.column(part.schema.get_field_index(c)) for c in ("quality", "weight")] + [pa.array(x.tolist(), pa.list_(pa.float64()))],
                                         names=["quality", "weight", "x"])


def fit_logistic(x, y, weight, steps: int = 50, ridge: float = 1e-2):
    """Newton steps of ridge logistic regression on standardised columns: centre, scale, weights, intercept."""
    import numpy as np
    mu, sd = np.average(x, axis=0, weights=weight), x.std(axis=0) + 0.02
    z = np.column_stack([np.ones(len(x)), (x - mu) / sd])
    w, share = np.zeros(z.shape[1]), weight / weight.sum()
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
        g = z.T @ (share * (p - y)) + ridge * w * (np.arange(len(w)) > 0)
        h = (z * (share * np.maximum(p * (1 - p), 1e-4))[:, None]).T @ z + ridge * np.eye(len(w))
        w = w - np.linalg.solve(h, g)
    return mu, sd, w


def _fit_task(pdf):
    import numpy as np
    import pandas as pd
    y = (pdf["quality"].to_numpy() == 1).astype(float)
    weight = pdf["weight"].to_numpy(float)
    if y.min() == y.max():
        return pd.DataFrame({"mu": [[0.0] * SHAPES], "sd": [[1.0] * SHAPES], "w": [[0.0] * (SHAPES + 1)]})
    mu, sd, w = fit_logistic(np.stack(pdf["x"].to_list()), y, weight)
    return pd.DataFrame({"mu": [mu.tolist()], "sd": [sd.tolist()], "w": [w.tolist()]})


def _evidence_task(model, fields):
    def run(batches):
        import numpy as np
        import pyarrow as pa
        mu, sd, w = (np.array(x) for x in model)
        for part, x, words in _shape_rows(batches):
            s = np.clip(w[0] + ((x - mu) / sd) @ w[1:], -30, 30)
            yield pa.RecordBatch.from_arrays([part.column(part.schema.get_field_index(c)) for c in fields] + [pa.array(words.astype(np.int64)), pa.array(1 / (1 + np.exp(-s)))],
                                             names=[*fields, "n_words", "p_text"])
    return run


def train_classifier(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> tuple[list, list, list]:
    flags = labels.where("quality IN (0, 1) AND doc_id IS NOT NULL").groupBy("doc_id").agg(F.min("quality").alias("quality"))
    n = {r["quality"]: r["n"] for r in flags.groupBy("quality").agg(F.count(F.lit(1)).alias("n")).collect()}
    share = {k: min(1.0, sample / 2 / n[k]) if n.get(k) else 1.0 for k in (0, 1)}
    of = F.when(F.col("quality") == 1, share[1]).otherwise(share[0])
    chosen = materialize(flags.withColumn("weight", 1 / of).where(unit_hash("quality", F.col("doc_id")) < of), "quality-sample")
    rows = docs.select("doc_id", "text").join(chosen, "doc_id").dropDuplicates(["doc_id"]).select("quality", "weight", "text")
    shaped = rows.mapInArrow(_sample_task, "quality int, weight double, x array<double>")
    got = shaped.groupBy(F.lit(0).alias("all")).applyInPandas(_fit_task, "mu array<double>, sd array<double>, w array<double>").collect()
    return tuple(map(list, got[0])) if got else ([0.0] * SHAPES, [1.0] * SHAPES, [0.0] * (SHAPES + 1))


# ---- the hierarchy (DataFrame operations only) ----------------------------------------------------------

def strength(sites: DataFrame, mean: Column) -> Column:
    """Documents' worth of the level above, as an aggregate over sites (n, s): moments of the site rates.

    Beta with mean m and strength k has variance m (1 - m) / (k + 1); the observed spread of site rates, less what
    sampling alone gives, estimates it.  Sites of one document say nothing about the spread.
    """
    rate = F.col("s") / F.col("n")
    spread = F.sum(F.when(F.col("n") > 1, F.col("n") * (rate - mean) * (rate - mean))) / F.sum(F.when(F.col("n") > 1, F.col("n")))
    noise = F.sum(F.when(F.col("n") > 1, mean * (1 - mean))) / F.sum(F.when(F.col("n") > 1, F.col("n")))
    k = F.try_divide(F.max(mean * (1 - mean)), F.greatest(spread - noise, F.lit(1e-6))) - 1
    return F.greatest(F.lit(STRENGTH[0]), F.least(F.lit(STRENGTH[1]), F.coalesce(k, F.lit(STRENGTH[1]))))


def site_tables(evidence: DataFrame) -> DataFrame:
    """A row per (host, path): sums, sums of its host, and the three levels' parameters."""
    paths = materialize(evidence.groupBy("host", "path").agg(F.count(F.lit(1)).alias("n"), F.sum("p_text").alias("s")), "site-paths")
    hosts = materialize(paths.groupBy("host").agg(F.sum("n").alias("n"), F.sum("s").alias("s")), "site-hosts")
    joined = paths.join(hosts.select("host", F.col("n").alias("host_n"), F.col("s").alias("host_s")), paths["host"].eqNullSafe(hosts["host"])).drop(hosts["host"])
    # three numbers: the global rate and the strength of either level
    rate = hosts.agg((F.sum("s") / F.sum("n")).alias("r")).first()["r"]
    rate = 0.5 if rate is None else float(rate)
    hk = float(hosts.agg(strength(hosts, F.lit(rate)).alias("k")).first()["k"])
    pk = float(joined.withColumn("m", F.col("host_s") / F.col("host_n")).agg(strength(joined, F.col("m")).alias("k")).first()["k"])
    return materialize(joined.select("host", "path", "n", "s", "host_n", "host_s", F.lit(rate).alias("global_rate"), F.lit(hk).alias("host_k"),
                                     F.lit(pk).alias("path_k")), "site-levels")


def _logit(p: Column) -> Column:
    q = F.greatest(F.lit(1e-9), F.least(F.lit(1 - 1e-9), p))
    return F.log(q / (1 - q))


def posterior(evidence: DataFrame, sites: DataFrame) -> DataFrame:
    """evidence's columns, host_rate, path_rate (without the document itself), p_good."""
    s = sites.select(F.col("host").alias("__h"), F.col("path").alias("__p"), *[F.col(c).alias(f"__{c}") for c in sites.columns if c not in ("host", "path")])
    joined = evidence.join(s, F.col("host").eqNullSafe(F.col("__h")) & F.col("path").eqNullSafe(F.col("__p")))
    host = (F.col("__host_s") - F.col("p_text") + F.col("__host_k") * F.col("__global_rate")) / (F.col("__host_n") - 1 + F.col("__host_k"))
    path = (F.col("__s") - F.col("p_text") + F.col("__path_k") * F.col("host_rate")) / (F.col("__n") - 1 + F.col("__path_k"))
    weigh = F.greatest(F.lit(-EVIDENCE), F.least(F.lit(EVIDENCE), _logit(F.col("p_text")) - _logit(F.col("__global_rate"))))
    out = joined.withColumn("host_rate", host).withColumn("path_rate", path).withColumn("__l", weigh + _logit(F.col("path_rate")))
    return out.withColumn("p_good", 1 / (1 + F.exp(-F.col("__l")))).select(*evidence.columns, "host_rate", "path_rate", "p_good")


def judge(docs: DataFrame, labels: DataFrame, host: Column, path: Column, keep: Sequence[str] = ("doc_id",), sample: int = SAMPLE) -> DataFrame:
    """`keep` columns, host, path, n_words, p_text, host_rate, path_rate, p_good, kept."""
    model = train_classifier(docs, labels, sample)
    own = ("host", "path", "n_words", "p_text", "host_rate", "path_rate", "p_good", "kept")
    keep = [c for c in keep if c not in own]
    rows = docs.select(*keep, host.cast("string").alias("host"), path.cast("string").alias("path"), F.col("text").cast("string").alias("text"))
    fields = [c for c in rows.columns if c != "text"]
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields if f.name != "text")
    evidence = materialize(rows.mapInArrow(_evidence_task(model, fields), f"{schema}, n_words long, p_text double"), "site-evidence")
    out = posterior(evidence, site_tables(evidence))
    return out.withColumn("kept", (F.col("n_words") >= MIN_WORDS) & (F.col("p_good") >= 0.5))


def url_host(url: Column) -> Column:
    """Host of a URL, lower case, without www."""
    return F.regexp_replace(F.lower(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/@]*@)?([^/:?#]*)", 1)), r"^www\.", "")


def url_path(url: Column) -> Column:
    """First segment of a URL's path, empty if there is none."""
    return F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*/([^/?#]*)", 1)
