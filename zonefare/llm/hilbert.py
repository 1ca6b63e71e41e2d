"""Sharding along a Hilbert curve, for file pruning over several metadata dimensions at once.

Every dimension is quantised to 2^bits cells of equal depth: the exact count of rows
below a value (in the dimension's own order) tells its cell, so a common value takes
as much of the axis as it has rows.  The cells' index on a Hilbert curve orders the
rows; runs of the curve are cut into shards.  Neighbours on the curve differ by one
step in one dimension, so a shard covers a small box and min / max statistics of its
file exclude it from most look-ups on any of the dimensions.

Cuts: `bytes` puts a row into the shard that holds the middle of its bytes, so a
shard differs from total / shards by less than the largest row; `rows` puts row r of
n into shard r * shards div n, so counts are at most one apart.  `slot` counts the
rows of a shard along the curve.

All of it is DataFrame code.  Rows are ranked by a blocked scan
(operators/scan.py): range partitions by (curve index, ties), one sum per partition,
so a cell that holds most rows is spread over many tasks.  Broadcast or collected:
at most 2^bits boundary values of a dimension (strings cut to `VALUE_CHARS`), one
row per block, one per shard.

Cases: null dimension values lie below all others; a null text has size 1 and the
checksum of the empty text; ties along the curve go by id, checksum and size, rows
alike in all of them are interchangeable; an empty table gives an empty result; fewer
rows than shards leave shards empty; a row larger than a shard's share leaves the next
shards short or empty; input columns of other names stay, those named like a result
column are replaced.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from zonefare.llm.common import delete_path, materialize, stored_table, text_or_empty
from zonefare.operators.scan import AT, BLOCK, in_blocks, running_sums

SHARDS = 8
BITS = 5
#: Characters of a string dimension that count for its order.
VALUE_CHARS = 256
LAWS = ("bytes", "rows")


def hilbert_index(cells: list[str], bits: int) -> Callable[[DataFrame], DataFrame]:
    """A transform that adds `__curve`, the index of the cell columns on a Hilbert curve of 2^(bits * dimensions) cells.

    Per bit from the top: a set bit of a dimension flips the lower bits of the first
    dimension, a clear one swaps them with its own; then a Gray code over all bits.
    One projection per step keeps every expression small.
    """
    x = [f"__x{i}" for i in range(len(cells))]

    def transform(df: DataFrame) -> DataFrame:
        df = df.withColumns({c: F.col(s).cast("int") for c, s in zip(x, cells)})
        for bit in range(bits - 1, 0, -1):
            low = (1 << bit) - 1
            for c in x:
                df = df.withColumn("__set", F.col(c).bitwiseAND(F.lit(1 << bit)) != 0)
                if c == x[0]:
                    df = df.withColumn(c, F.when(F.col("__set"), F.col(c).bitwiseXOR(F.lit(low))).otherwise(F.col(c)))
                    continue
                df = df.withColumn("__swap", F.when(F.col("__set"), F.lit(0)).otherwise(
                    F.col(x[0]).bitwiseXOR(F.col(c)).bitwiseAND(F.lit(low))))
                df = df.withColumns({
                    x[0]: F.col(x[0]).bitwiseXOR(F.when(F.col("__set"), F.lit(low)).otherwise(F.col("__swap"))),
                    c: F.col(c).bitwiseXOR(F.col("__swap"))})
        for a, b in zip(x, x[1:]):
            df = df.withColumn(b, F.col(b).bitwiseXOR(F.col(a)))
        flip = F.lit(0)
        for bit in range(bits - 1, 0, -1):
            flip = flip.bitwiseXOR(F.when(F.col(x[-1]).bitwiseAND(F.lit(1 << bit)) != 0, F.lit((1 << bit) - 1)).otherwise(F.lit(0)))
        df = df.withColumn("__flip", flip)
        curve = F.lit(0).cast("long")
        for bit in range(bits - 1, -1, -1):
            for c in x:
                one = F.shiftright(F.col(c).bitwiseXOR(F.col("__flip")), bit).bitwiseAND(F.lit(1)).cast("long")
                curve = F.shiftleft(curve, 1).bitwiseOR(one)
        return df.withColumn("__curve", curve).drop(*x, "__set", "__swap", "__flip")
    return transform


def ordered_text(dimension: Column, kind: str) -> Column:
    """A string that sorts like the dimension: strings as they are, integers as 16 hexadecimal digits."""
    if kind == "string":
        return F.substring(dimension, 1, VALUE_CHARS)
    return F.lpad(F.hex(dimension.cast("long").bitwiseXOR(F.lit(-(1 << 63)))), 16, "0")


def cell_bounds(rows: DataFrame, values: list[str], bits: int) -> dict[str, list[tuple[int, str]]]:
    """(cell, least value) of every cell but the first of each column, in order: at most 2^bits - 1 values a column."""
    each = F.explode(F.array(*[F.struct(F.lit(v).alias("dim"), F.col(v).alias("value")) for v in values]))
    counted = rows.select(each.alias("e")).select("e.*").groupBy("dim", "value").agg(F.count(F.lit(1)).alias("__n"))
    stored, path = stored_table(in_blocks(counted, ["dim", "value"]), "hilbert-values")  # nulls lie below all values
    total = rows.count()
    cell = F.expr(f"__below * {1 << bits} div {max(1, total)}")
    found = (running_sums(stored, {"__below": "__n"}, ["dim"]).where("value IS NOT NULL")
             .groupBy("dim", cell.alias("cell")).agg(F.min("value").alias("least")).where("cell > 0").collect())
    delete_path(rows.sparkSession, path)
    return {v: sorted((r["cell"], r["least"]) for r in found if r["dim"] == v) for v in values}


def cell_of(value: Column, bounds: list) -> Column:
    """The cell of a value: that of the greatest bound it reaches, 0 below all of them."""
    reached = F
    for cell, least in reversed(bounds):
        reached = reached.when(value >= F.lit(least), F.lit(cell))
    return reached.otherwise(F.lit(0)).cast("int")


def size_class(size: Column) -> Column:
    """Logarithmic class of a positive integer, four to a doubling, in integer arithmetic."""
    bits = F.length(F.bin(size))
    top = F.call_function("shiftright", F.shiftleft(size, 2), bits - 1)  # the leading bit and the two after it
    return (4 * (bits - 1) + top.bitwiseAND(F.lit(3).cast("long"))).cast("int")


def curve_shards(rows: DataFrame, dimensions: list[str], size: str, ties: list[str], shards: int = SHARDS,
                 law: str = "bytes", bits: int = BITS) -> DataFrame:
    """All columns of `rows` (a stored table) plus law, shard and slot; dimensions are string or integer columns.

    Shuffles: the distinct values of each dimension, one range partitioning of the
    rows and one by block number; `rows` should hold slim columns only.
    """
    if law not in LAWS:
        raise ValueError(f"law must be one of {LAWS}")
    if bits < 1 or bits * len(dimensions) > 62:
        raise ValueError("bits times dimensions must be 1 to 62")
    values = {f"__value{i}": ordered_text(F.col(d), rows.schema[d].dataType.simpleString()) for i, d in enumerate(dimensions)}
    rows = rows.withColumns(values)
    bounds = cell_bounds(rows, list(values), bits)
    # a dimension of one cell says nothing and stays out of the curve
    cells = {f"__cell{i}": cell_of(F.col(v), bounds[v]) for i, v in enumerate(values) if bounds[v]}
    placed = rows.withColumns(cells) if cells else rows.withColumn("__curve", F.lit(0).cast("long"))
    placed = (hilbert_index(list(cells), bits)(placed) if cells else placed).drop(*cells, *values)
    placed = placed.withColumn("__one", F.lit(1).cast("long"))
    stored = materialize(in_blocks(placed, ["__curve", *ties]), "hilbert-order")
    ranked = running_sums(stored, {"__rank": "__one", "__before": size}).drop(BLOCK, AT, "__one")
    n, total = rows.agg(F.count(F.lit(1)), F.coalesce(F.sum(size), F.lit(0))).first()
    if law == "rows":
        shard = F.expr(f"__rank * {shards} div {max(1, n)}")
    else:  # the middle of the row's bytes, doubled to stay in whole numbers
        shard = F.expr(f"int((2 * __before + {size}) * cast({shards} as decimal(20,0)) div {max(1, 2 * total)})")
    cut = materialize(ranked.withColumn("shard", shard.cast("int")), "hilbert-cut")
    first = cut.groupBy("shard").agg(F.min("__rank").alias("__first"))  # one row per shard
    return (cut.join(F.broadcast(first), "shard").withColumn("slot", F.col("__rank") - F.col("__first"))
            .withColumn("law", F.lit(law)).drop("__rank", "__before", "__first", "__curve"))


def shard_documents(docs: DataFrame, shards: int = SHARDS, law: str = "bytes", bits: int = BITS) -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot, grown_shard (null: runs are cut anew for another shard count).

    Dimensions: source, language, size class, and id range (1024 equal ranges of the ids).
    """
    text = text_or_empty()
    span = docs.agg(F.min("doc_id").cast("decimal(20,0)").alias("lo"), F.max("doc_id").cast("decimal(20,0)").alias("hi")).first()
    lo, hi = (span["lo"], span["hi"]) if span["lo"] is not None else (0, 0)
    slim = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), (F.octet_length(text) + 1).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        F.col("source").cast("string").alias("__source"), F.col("lang").cast("string").alias("__lang"),
        F.expr(f"int((cast(doc_id as decimal(20,0)) - {lo}) * 1024 div ({hi} - {lo} + 1))").alias("__range"))
    slim = materialize(slim.withColumn("__class", size_class(F.col("size"))), "hilbert-slim")
    out = curve_shards(slim, ["__source", "__lang", "__class", "__range"], "size", ["doc_id", "text_crc32", "size"],
                       shards, law, bits)
    return out.select("doc_id", "size", "text_crc32", "law", "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


def pruning(sharded: DataFrame, dimension: str, shard: str = "shard") -> DataFrame:
    """Share of (value, shard) pairs that min / max statistics of the shards keep: value, files, one row per value."""
    bounds = sharded.groupBy(shard).agg(F.min(dimension).alias("lo"), F.max(dimension).alias("hi"))  # one row per shard
    values = sharded.select(F.col(dimension).alias("value")).where("value IS NOT NULL").distinct()
    return (values.join(F.broadcast(bounds), (F.col("value") >= F.col("lo")) & (F.col("value") <= F.col("hi")), "left")
            .groupBy("value").agg(F.count("lo").alias("files")))


def write_shards(sharded: DataFrame, path: str, shard: str = "shard", slot: str = "slot") -> None:
    """One folder per shard, rows of a file in curve order, for readers that prune by file statistics."""
    (sharded.repartitionByRange(shard, slot).sortWithinPartitions(shard, slot)
     .write.mode("overwrite").partitionBy(shard).parquet(path))


def oracle_sql(shards: int = SHARDS, bits: int = BITS) -> str:
    """DuckDB SQL of `shard_documents` by bytes: ranks by window, the checksum by table look-ups, the curve step by step."""
    n, steps, at = 4, [], "cells"

    def step(**new) -> None:
        nonlocal at
        cols = ", ".join(f"{new.get(f'x{i}', f'x{i}')} AS x{i}" for i in range(n))
        steps.append(f"s{len(steps)} AS (SELECT doc_id, size, text_crc32, {cols} FROM {at})")
        at = f"s{len(steps) - 1}"

    for bit in range(bits - 1, 0, -1):
        m, low = 1 << bit, (1 << bit) - 1
        step(x0=f"CASE WHEN x0 & {m} <> 0 THEN xor(x0, {low}) ELSE x0 END")
        for i in range(1, n):
            step(**{"x0": f"CASE WHEN x{i} & {m} <> 0 THEN xor(x0, {low}) ELSE (x0 & {m - 1 ^ 0x7FFFFFFF}) | (x{i} & {low}) END",
                    f"x{i}": f"CASE WHEN x{i} & {m} <> 0 THEN x{i} ELSE (x{i} & {m - 1 ^ 0x7FFFFFFF}) | (x0 & {low}) END"})
    for i in range(1, n):
        step(**{f"x{i}": f"xor(x{i}, x{i - 1})"})
    flip = "0"
    for bit in range(bits - 1, 0, -1):
        flip = f"xor({flip}, CASE WHEN x{n - 1} & {1 << bit} <> 0 THEN {(1 << bit) - 1} ELSE 0 END)"
    step(**{f"x{i}": f"xor(x{i}, {flip})" for i in range(n)})
    curve = " + ".join(f"((x{i} >> {b}) & 1) * {1 << (b * n + n - 1 - i)}" for b in range(bits) for i in range(n))
    rank = "(rank() OVER (ORDER BY {v} NULLS FIRST) - 1) * " + f"{1 << bits} // count(*) OVER ()"
    values = ("substr(source, 1, 256)", "substr(lang, 1, 256)",
              "4 * (length(bin(size)) - 1) + (((size << 2) >> (length(bin(size)) - 1)) & 3)",
              "(CAST(doc_id AS HUGEINT) - lo) * 1024 // (hi - lo + 1)")
    cells = ", ".join(f"CAST({rank.format(v=v)} AS INTEGER) AS x{i}" for i, v in enumerate(values))
    return f"""
WITH crc(t) AS (
  SELECT list(c ORDER BY b)
  FROM (SELECT b, list_reduce(list_prepend(b, range(8)),
                              lambda a, i: CASE WHEN a & 1 = 1 THEN xor(a >> 1, 3988292384) ELSE a >> 1 END) AS c
        FROM (SELECT CAST(range AS BIGINT) AS b FROM range(256)))),
sized AS (
  SELECT doc_id, source, lang, CAST(strlen(coalesce(text, '')) + 1 AS BIGINT) AS size,
         CAST(xor(list_reduce(list_prepend(4294967295, list_transform(
                    regexp_extract_all(hex(encode(coalesce(text, ''))), '..'), lambda h: CAST('0x' || h AS BIGINT))),
                  lambda a, x: xor(a >> 8, t[(xor(a, x) & 255) + 1])), 4294967295) AS BIGINT) AS text_crc32
  FROM documents, crc),
span AS (SELECT CAST(min(doc_id) AS HUGEINT) AS lo, CAST(max(doc_id) AS HUGEINT) AS hi FROM documents),
cells AS (SELECT doc_id, size, text_crc32, {cells} FROM sized, span),
{", ".join(steps)},
curve AS (SELECT doc_id, size, text_crc32, {curve} AS h FROM {at}),
ordered AS (
  SELECT *, sum(size) OVER () AS total,
         sum(size) OVER (ORDER BY h, doc_id NULLS FIRST, text_crc32, size ROWS UNBOUNDED PRECEDING) - size AS before,
         row_number() OVER (ORDER BY h, doc_id NULLS FIRST, text_crc32, size) AS place
  FROM curve),
cut AS (SELECT *, CAST((2 * before + size) * {shards} // (2 * total) AS INTEGER) AS shard FROM ordered)
SELECT doc_id, size, text_crc32, 'bytes' AS law, shard,
       CAST(row_number() OVER (PARTITION BY shard ORDER BY place) - 1 AS BIGINT) AS slot, CAST(NULL AS INTEGER) AS grown_shard
FROM cut
"""
