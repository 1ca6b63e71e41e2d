"""Mixing sources to target weights by Poisson replication.

Every document of source s gets a number of copies drawn from Poisson(rate_s),
rate_s = weight_s * epochs * total size / size_s, by inverting the distribution
at a uniform value hashed from seed and document id.  Copies are exploded and
dealt out over all partitions by a second hash, so any stretch of the output
follows the mixture.  Nothing is stateful: the same document, seed and rate
give the same copies on any cluster, and a lost task recomputes the same rows.

Cases: a null or unnamed source belongs to the rest (`REST`); a null text has
size 1 (size is code points + 1, so no source has size 0); null ids hash as
empty; rows that repeat an id get the same number of copies each; weight 0
drops a source; an empty table gives an empty result.  The added columns
`mix_rate`, `mix_copies`, `mix_copy`, `mix_key` replace input columns of the
same name.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from zonefare.llm.common import md5_int, text_or_empty, unit_hash

#: The component that takes every source without a weight of its own.
REST = "*"

#: Mixture of the registered query: the large source at a fifth, the other
#: named ones alike, one share for all others together.
TARGET_WEIGHTS = {"src0": 0.20, **{f"src{i}": 0.04 for i in range(1, 20)}, REST: 0.04}


def component(source: Column, weights: dict[str, float]) -> Column:
    named = [s for s in weights if s != REST]
    return F.when(source.isin(named), source).otherwise(F.lit(REST)) if named else F.lit(REST)


def source_rates(docs: DataFrame, weights: dict[str, float], epochs: float = 1.0,
                 source: str = "source", text: str = "text") -> DataFrame:
    """component, rate, thresholds: at most one row per weight.

    thresholds[k] = P(copies <= k); the table ends where the tail is below one
    step of the 52-bit hash.
    """
    spark = docs.sparkSession
    target = spark.createDataFrame([(k, float(v)) for k, v in weights.items()], "component string, weight double")
    size = docs.groupBy(component(F.col(source), weights).alias("component")).agg(
        F.sum(F.length(text_or_empty(text)) + 1).alias("size"))
    present = size.join(F.broadcast(target), "component").where("weight > 0")
    everything = Window.partitionBy(F.lit(0))  # one row per weight at most
    rates = present.select(
        "component", (F.col("weight") / F.sum("weight").over(everything) * F.lit(float(epochs))
                      * F.sum("size").over(everything) / F.col("size")).alias("rate"))
    start = F.struct(-F.col("rate"), F.exp(-F.col("rate")), F.array(F.exp(-F.col("rate")))).cast(
        "struct<lp:double,c:double,a:array<double>>")

    def step(acc: Column, k: Column) -> Column:
        lp = acc["lp"] + F.log("rate") - F.log(k.cast("double"))
        c = acc["c"] + F.exp(lp)
        return F.struct(lp, c, F.concat(acc["a"], F.array(c))).cast("struct<lp:double,c:double,a:array<double>>")

    last = F.ceil(F.col("rate") + 12 * F.sqrt("rate") + 30).cast("int")
    return rates.withColumn("thresholds", F.aggregate(F.sequence(F.lit(1), last), start, step, lambda acc: acc["a"]))


def poisson_replicate(docs: DataFrame, weights: dict[str, float], epochs: float = 1.0, seed: int = 17,
                      id_col: str = "doc_id", source: str = "source", text: str = "text") -> DataFrame:
    """All input columns once per copy, plus mix_rate, mix_copies, mix_copy, mix_key, dealt out globally.

    Broadcast: the rates, one row per given weight.  Shuffles: one map-side
    combined sum per source, and the global shuffle itself.
    """
    rates = source_rates(docs, weights, epochs, source, text)
    rates = F.broadcast(rates.select("component", F.struct("rate", "thresholds").alias("__mix")))
    u = unit_hash(str(seed), F.col(id_col))
    copies = F.size(F.filter(F.col("__mix.thresholds"), lambda t: t <= F.col("__u")))
    keyed = (docs.withColumn("__component", component(F.col(source), weights)).withColumn("__u", u)
             .join(rates.withColumnRenamed("component", "__component"), "__component")
             .withColumn("mix_rate", F.col("__mix.rate")).withColumn("mix_copies", copies)
             .drop("__component", "__u", "__mix"))
    out = (keyed.where("mix_copies > 0")
           .withColumn("mix_copy", F.explode(F.sequence(F.lit(0), F.col("mix_copies") - 1)))
           .withColumn("mix_key", md5_int(15, str(seed), "order", F.col(id_col), F.col("mix_copy"))))
    return out.repartition("mix_key").sortWithinPartitions("mix_key")
