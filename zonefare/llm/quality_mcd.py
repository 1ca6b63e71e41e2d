"""Quality rules by robust multivariate outliers (minimum covariance determinant).

Base rules first (too few words, too much repetition).  The documents that pass
become vectors of transformed statistics.  Per language and source, `C_STEPS` concentration
steps find the covariance of the `COVERED` share of vectors with the least
determinant (a little over half, so nearly half of a group may be junk of one kind
without a say in its estimate; two starts: medians with MADs, and plain moments; the better one
stays), one reweighting step follows, and a document is rejected if its squared
Mahalanobis distance exceeds the chi-square cutoff.

Only DataFrame / SQL operations.  The statistics are integers (thousandths), so
all sums are exact and the result does not depend on partitioning.  A
concentration step is one map-side combined aggregate: moments per (group,
distance bin); the covered subset is whole bins, so no sort, quantile sketch or
collected group is needed, and a group with a third of all rows costs the same
as any other.  The estimates (one row per group and start) are written to the
shared folder and joined back; Spark broadcasts them if they are small.

A (language, source) with under `MIN_GROUP` vectors takes its language's
estimate, or that of all documents if the language has too few as well.
`FLOORS` are the least standard deviations, added to every covariance, so that a
statistic which is constant in a group (no symbols at all) tolerates harmless
values.

Cases: a null or empty text has no words and is base_failed; null language or
source are groups of their own; repeated rows are judged alike; an empty table
gives an empty result; columns of the input that are not asked for are dropped,
names that clash with the statistics are replaced by the statistics.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from zonefare.llm.common import GAP, materialize, text_or_empty

MIN_WORDS = 10
MAX_REPEAT_PERCENT = 20
COVERED = 0.55
MIN_GROUP = 50
C_STEPS = 8
REWEIGHT_TAIL = 0.025
CUTOFF_TAIL = 1e-7
BINS_PER_OCTAVE = 8

#: Statistic (SQL over the base columns, in thousandths after rounding) and its floor.
STATISTICS = (
    ("ln((word_chars + 100) / (n_words + 20.0))", 0.15),                 # mean word length
    ("ln(1 + 20 * n_symbols / (n_words + 20.0))", 0.25),                 # symbols
    ("ln(1 + 20 * n_upper / (word_chars + 100.0))", 0.25),               # upper case
    ("ln(1 + 10 * n_repeat_words / (n_words + 20.0))", 0.40),            # repeated windows
    ("ln(1 + 5 * n_dup_lines / (n_lines + 2.0))", 0.40),                 # repeated lines
    ("ln(n_distinct_words + 20.0) / ln(n_words + 20.0)", 0.06),          # vocabulary against length
)
P = len(STATISTICS)
SCALE = 1000
GROUP = ("level", "g_lang", "g_source")
PAIRS = [(i, j) for i in range(1, P + 1) for j in range(1, i + 1)]

BASE = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def chi2_cdf(x: float, k: int) -> float:
    """Regularised lower incomplete gamma function P(k/2, x/2), by its series."""
    if x <= 0:
        return 0.0
    a, h = k / 2, x / 2
    term = total = 1 / a
    n = a
    while term > total * 1e-17:
        n += 1
        term *= h / n
        total += term
    return total * math.exp(-h + a * math.log(h) - math.lgamma(a))


def chi2_quantile(q: float, k: int) -> float:
    lo, hi = 0.0, 1e4
    for _ in range(200):
        mid = (lo + hi) / 2
        lo, hi = (mid, hi) if chi2_cdf(mid, k) < q else (lo, mid)
    return hi


def consistency(share: float) -> float:
    """Factor that makes the covariance of the innermost share of normal data consistent."""
    return share / chi2_cdf(chi2_quantile(share, P), P + 2)


# ---- statistics of a text -------------------------------------------------------------------------------

def _removed(text: Column, pattern: str) -> Column:
    return (F.length(text) - F.length(F.regexp_replace(text, pattern, ""))).cast("bigint")


def _in_repeated_windows(h: Column) -> Column:
    """Words covered by windows (hashes by position) that occur twice or more."""
    ordered = F.sort_array(F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("i"))))

    def starts(s: Column) -> Column:
        twin = lambda x, at: F.coalesce(F.get(s, at)["h"] == x["h"], F.lit(False))
        return F.sort_array(F.transform(F.filter(s, lambda x, j: twin(x, j - 1) | twin(x, j + 1)), lambda x: x["i"]))

    def covered(p: Column) -> Column:
        steps = F.transform(p, lambda x, j: F.least(F.lit(5), F.coalesce(F.get(p, j + 1) - x, F.lit(5))))
        return F.aggregate(steps, F.lit(0).cast("bigint"), lambda acc, x: acc + x)

    # arrays of one element: each inner function sees its argument computed once
    return F.transform(F.transform(F.array(ordered), starts), covered)[0]


def text_statistics(docs: DataFrame, keep: Sequence[str], text: str = "text") -> DataFrame:
    """`keep` columns plus the base columns and the further counts, one row per input row."""
    t = F.col("__text")
    trimmed = F.btrim(t, F.lit(" \t\n\x0b\x0c\r"))
    words = F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, GAP))
    lines = F.filter(F.split(t, "\n"), lambda x: F.btrim(x, F.lit(" \t\n\x0b\x0c\r")) != "")
    w = F.col("__words")
    windows = F.when(F.size(w) < 5, F.array().cast("array<bigint>")).otherwise(F.transform(
        F.slice(w, F.lit(1), F.greatest(F.size(w) - 4, F.lit(0))),
        lambda x, i: F.xxhash64(x, F.get(w, i + 1), F.get(w, i + 2), F.get(w, i + 3), F.get(w, i + 4))))
    h = F.col("__windows")
    keep = [c for c in keep if c not in (*BASE, "n_lines", "n_upper", "n_distinct_words", "base_failed")]
    kept = [F.col(c) for c in keep]
    staged = docs.select(*kept, text_or_empty(text).alias("__text")).select(
        *kept, t, words.alias("__words"), lines.alias("__lines"))
    counted = staged.select(
        *kept, F.size(w).cast("bigint").alias("n_words"),
        F.length(F.concat_ws("", w)).cast("bigint").alias("word_chars"),
        _removed(t, r"[#*$%&|<>]+").alias("n_symbols"),
        (F.size("__lines") - F.size(F.array_distinct("__lines"))).cast("bigint").alias("n_dup_lines"),
        F.size("__lines").cast("bigint").alias("n_lines"), _removed(t, r"\p{Lu}+").alias("n_upper"),
        F.size(F.array_distinct(w)).cast("bigint").alias("n_distinct_words"), windows.alias("__windows"))
    repeats = F.when(F.size(h) == F.size(F.array_distinct(h)), F.lit(0).cast("bigint")).otherwise(_in_repeated_windows(h))
    counted = counted.withColumn("n_repeat_words", repeats).drop("__windows")
    return counted.withColumn("base_failed", F.expr(BASE_FAILED))


BASE_FAILED = f"(n_words < {MIN_WORDS} OR 100 * n_repeat_words > {MAX_REPEAT_PERCENT} * n_words)"


# ---- SQL that Spark and any other engine runs alike -----------------------------------------------------

def vectors_sql(table: str, extra: str) -> str:
    z = ", ".join(f"CAST(floor({SCALE} * ({x}) + 0.5) AS BIGINT) AS z{i}" for i, (x, _) in enumerate(STATISTICS, 1))
    return f"SELECT {extra}, {z} FROM {table}"


def members_sql(vectors: str) -> str:
    """A row per vector and level: its language and source, its language, all."""
    z = ", ".join(f"z{i}" for i in range(1, P + 1))
    ok = f"FROM {vectors} WHERE NOT base_failed"
    lang, source = "coalesce(concat('=', lang), '')", "coalesce(concat('=', source), '')"
    return (f"SELECT 0 AS level, {lang} AS g_lang, {source} AS g_source, {z} {ok} "
            f"UNION ALL SELECT 1, {lang}, '', {z} {ok} UNION ALL SELECT 2, '', '', {z} {ok}")


def histogram_sql(members: str) -> str:
    """Counts by dimension and value in hundredths: the source of medians and MADs."""
    dims = " UNION ALL ".join(f"SELECT level, g_lang, g_source, {i} AS dim, CAST(floor(z{i} / 10.0) AS BIGINT) AS v FROM {members}"
                              for i in range(1, P + 1))
    return f"SELECT level, g_lang, g_source, dim, v, count(*) AS n FROM ({dims}) d GROUP BY level, g_lang, g_source, dim, v"


def _weighted_median(table: str, value: str, name: str) -> str:
    keys = "level, g_lang, g_source, dim"
    return (f"SELECT {keys}, min({value}) AS {name} FROM (SELECT {keys}, {value}, "
            f"sum(n) OVER (PARTITION BY {keys} ORDER BY {value}) AS upto, sum(n) OVER (PARTITION BY {keys}) AS total "
            f"FROM {table}) t WHERE 2 * upto >= total GROUP BY {keys}")


def robust_start_sql(hist: str) -> str:
    """Start 0: medians and MADs, as moments of a diagonal covariance."""
    keys = "level, g_lang, g_source"
    med = _weighted_median(hist, "v", "med")
    off = f"(SELECT h.level, h.g_lang, h.g_source, h.dim, abs(h.v - m.med) AS a, h.n FROM {hist} h JOIN ({med}) m ON h.level = m.level AND h.g_lang = m.g_lang AND h.g_source = m.g_source AND h.dim = m.dim) o"
    both = f"SELECT m.level, m.g_lang, m.g_source, m.dim, 10 * m.med + 5.0 AS mu, 14.826 * d.mad AS sd FROM ({med}) m JOIN ({_weighted_median(off, 'a', 'mad')}) d ON m.level = d.level AND m.g_lang = d.g_lang AND m.g_source = d.g_source AND m.dim = d.dim"
    mus = ", ".join(f"CAST(max(CASE WHEN dim = {i} THEN mu END) AS DOUBLE) AS mu{i}" for i in range(1, P + 1))
    cov = ", ".join(f"CAST(max(CASE WHEN dim = {i} THEN sd * sd END) AS DOUBLE) AS c{i}_{j}" if i == j else f"CAST(0 AS DOUBLE) AS c{i}_{j}" for i, j in PAIRS)
    return f"SELECT 0 AS start, {keys}, {mus}, {cov} FROM ({both}) b GROUP BY {keys}"


def _moments(prefix: str = "") -> str:
    return ", ".join([f"sum({prefix}z{i}) AS s{i}" for i in range(1, P + 1)] + [f"sum({prefix}z{i} * {prefix}z{j}) AS q{i}_{j}" for i, j in PAIRS])


def _sums(table: str, keys: str, where: str = "") -> str:
    cols = ", ".join(["CAST(sum(n) AS BIGINT) AS n"] + [f"CAST(sum(s{i}) AS BIGINT) AS s{i}" for i in range(1, P + 1)] + [f"CAST(sum(q{i}_{j}) AS BIGINT) AS q{i}_{j}" for i, j in PAIRS])
    return f"SELECT {keys}, {cols} FROM {table} {where} GROUP BY {keys}"


def covariance_sql(sums: str, keys: str, factor: str) -> str:
    mus = ", ".join(f"CAST(s{i} AS DOUBLE) / n AS mu{i}" for i in range(1, P + 1))
    cov = ", ".join(f"({factor}) * (CAST(q{i}_{j} AS DOUBLE) / n - (CAST(s{i} AS DOUBLE) / n) * (CAST(s{j} AS DOUBLE) / n)) AS c{i}_{j}" for i, j in PAIRS)
    return f"SELECT {keys}, n, {mus}, {cov} FROM ({sums}) s WHERE n > 0"


def plain_start_sql(members: str) -> str:
    """Start 1: the moments of all vectors of the group."""
    keys = "level, g_lang, g_source"
    sums = f"SELECT {keys}, count(*) AS n, {_moments()} FROM {members} GROUP BY {keys}"
    cov = covariance_sql(sums, keys, "1.0")
    cols = ", ".join([f"mu{i}" for i in range(1, P + 1)] + [f"c{i}_{j}" for i, j in PAIRS])
    return f"SELECT 1 AS start, {keys}, {cols} FROM ({cov}) p"


def factor_sql(estimates: str, keys: str) -> str:
    """Cholesky factor of the covariance plus floors, and the log determinant."""
    floor = {i: (SCALE * f) ** 2 for i, (_, f) in enumerate(STATISTICS, 1)}
    out = []
    for i in range(1, P + 1):
        for j in range(1, i + 1):
            rest = "".join(f" - l{i}_{k} * l{j}_{k}" for k in range(1, j))
            out.append(f"sqrt(c{i}_{i} + {floor[i]!r}{rest}) AS l{i}_{i}" if i == j else f"(c{i}_{j}{rest}) / l{j}_{j} AS l{i}_{j}")
    det = " + ".join(f"ln(l{i}_{i})" for i in range(1, P + 1))
    mus = ", ".join(f"mu{i}" for i in range(1, P + 1))
    return f"SELECT {keys}, {mus}, {', '.join(out)}, {det} AS logdet FROM {estimates}"


def distance_sql(rows: str, factors: str, on: str, cols: str) -> str:
    """Squared distance d2 of every row to its group's estimate, by forward substitution."""
    ys = []
    for i in range(1, P + 1):
        rest = "".join(f" - l{i}_{k} * y{k}" for k in range(1, i))
        ys.append(f"(z{i} - mu{i}{rest}) / l{i}_{i} AS y{i}")
    d2 = " + ".join(f"y{i} * y{i}" for i in range(1, P + 1))
    return f"SELECT {cols}, {', '.join(ys)}, {d2} AS d2 FROM {rows} r JOIN {factors} f ON {on}"


_ON = "r.level = f.level AND r.g_lang = f.g_lang AND r.g_source = f.g_source"
_Z = ", ".join(f"r.z{i}" for i in range(1, P + 1))
_BIN = f"CAST(floor({BINS_PER_OCTAVE} * log2(d2 + 1e-6)) AS INTEGER)"
KEYS = "start, level, g_lang, g_source"


def binned_sql(members: str, factors: str) -> str:
    d = distance_sql(members, factors, _ON, f"f.start, r.level, r.g_lang, r.g_source, {_Z}")
    return f"SELECT {KEYS}, {_BIN} AS bin, count(*) AS n, {_moments()} FROM ({d}) d GROUP BY {KEYS}, {_BIN}"


def concentrate_sql(binned: str) -> str:
    """Covariance of the innermost whole bins that hold the covered share."""
    over = f"PARTITION BY {KEYS}"
    mark = f"SELECT *, sum(n) OVER ({over} ORDER BY bin) - n AS before, sum(n) OVER ({over}) AS total FROM {binned}"
    sums = _sums(f"({mark}) m", KEYS, f"WHERE before < {COVERED} * total")
    return covariance_sql(sums, KEYS, repr(consistency(COVERED)))


def best_sql(factors: str) -> str:
    """Of the starts the one with the least determinant; the first on a tie."""
    return (f"SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY level, g_lang, g_source ORDER BY logdet, start) AS rank "
            f"FROM {factors}) b WHERE rank = 1")


def reweight_sql(members: str, factors: str) -> str:
    """Covariance of the vectors within the reweighting cutoff; total counts the group."""
    d = distance_sql(members, factors, _ON, f"r.level, r.g_lang, r.g_source, {_Z}")
    keys = "level, g_lang, g_source"
    cut = repr(chi2_quantile(1 - REWEIGHT_TAIL, P))
    inside = lambda x: f"sum(CASE WHEN d2 <= {cut} THEN {x} ELSE 0 END)"
    cols = [f"{inside(f'z{i}')} AS s{i}" for i in range(1, P + 1)] + [f"{inside(f'z{i} * z{j}')} AS q{i}_{j}" for i, j in PAIRS]
    sums = f"SELECT {keys}, count(*) AS total, {inside('1')} AS n, {', '.join(cols)} FROM ({d}) d GROUP BY {keys}"
    cov = covariance_sql(sums, f"{keys}, total", repr(consistency(1 - REWEIGHT_TAIL)))
    return factor_sql(f"({cov}) c", f"{keys}, total")


def chosen_sql(final: str) -> str:
    """A row per language and source: its own estimate, or the next wider one that has enough vectors."""
    names = [f"mu{i}" for i in range(1, P + 1)] + [f"l{i}_{j}" for i, j in PAIRS]
    pick = ", ".join(f"CASE WHEN a.total >= {MIN_GROUP} THEN a.{x} WHEN b.total >= {MIN_GROUP} THEN b.{x} ELSE g.{x} END AS {x}"
                     for x in names)
    return (f"SELECT a.g_lang, a.g_source, {pick} FROM (SELECT * FROM {final} WHERE level = 0) a "
            f"JOIN (SELECT * FROM {final} WHERE level = 1) b ON b.g_lang = a.g_lang "
            f"JOIN (SELECT * FROM {final} WHERE level = 2) g ON g.level = a.level + 2")


def verdict_sql(vectors: str, chosen: str, cols: str) -> str:
    """kept: passed the base rules and lies within the cutoff (a group without an estimate has no such row)."""
    ys = []
    for i in range(1, P + 1):
        rest = "".join(f" - l{i}_{k} * y{k}" for k in range(1, i))
        ys.append(f"(z{i} - mu{i}{rest}) / l{i}_{i} AS y{i}")
    d2 = " + ".join(f"y{i} * y{i}" for i in range(1, P + 1))
    cut = repr(chi2_quantile(1 - CUTOFF_TAIL, P))
    rows = (f"SELECT *, {', '.join(ys)}, {d2} AS distance2 FROM {vectors} r LEFT JOIN {chosen} f "
            f"ON f.g_lang = coalesce(concat('=', r.lang), '') AND f.g_source = coalesce(concat('=', r.source), '')")
    return f"SELECT {cols}, coalesce(NOT base_failed AND distance2 <= {cut}, false) AS kept FROM ({rows}) v"


# ---- the operator ---------------------------------------------------------------------------------------

def fit(vectors: DataFrame) -> DataFrame:
    """Estimates by language and source (g_lang, g_source, mu*, l*), from a table of vectors.

    Every step is one aggregate over the vectors; its result, one row per group
    and start, goes to the shared folder, so plans stay short and a lost
    executor costs the current step only.
    """
    spark = vectors.sparkSession
    members = spark.sql(members_sql("{v}"), v=vectors)
    hist = materialize(spark.sql(histogram_sql("{m}"), m=members), "mcd-histogram")
    cols = ", ".join([KEYS] + [f"mu{i}" for i in range(1, P + 1)] + [f"c{i}_{j}" for i, j in PAIRS])
    start = spark.sql(f"SELECT {cols} FROM ({robust_start_sql('{h}')}) a UNION ALL SELECT {cols} FROM ({plain_start_sql('{m}')}) b",
                      h=hist, m=members)
    factors = materialize(spark.sql(factor_sql("{e}", KEYS), e=start), "mcd-start")
    for _ in range(C_STEPS):
        binned = spark.sql(binned_sql("{m}", "{f}"), m=members, f=factors)
        estimates = spark.sql(concentrate_sql("{b}"), b=binned)
        factors = materialize(spark.sql(factor_sql("{e}", KEYS), e=estimates), "mcd-step")
    best = materialize(spark.sql(best_sql("{f}"), f=factors), "mcd-best")
    final = materialize(spark.sql(reweight_sql("{m}", "{f}"), m=members, f=best), "mcd-final")
    return materialize(spark.sql(chosen_sql("{f}"), f=final), "mcd-chosen")


def quality_verdicts(docs: DataFrame, keep: Sequence[str] = ("doc_id",), text: str = "text") -> DataFrame:
    """`keep` columns of every document, its base columns, base_failed, distance2 and kept.

    The documents are read once: their statistics are written to the shared
    folder (with the `keep` columns), the estimates come from there.
    """
    spark = docs.sparkSession
    own = {"lang": "__lang", "source": "__source"}
    docs = docs.select(*[F.col(c).alias(f"__keep_{c}") for c in keep], F.col("lang").cast("string").alias("__lang"),
                       F.col("source").cast("string").alias("__source"), F.col(text).alias("__text_in"))
    stats = text_statistics(docs, [f"__keep_{c}" for c in keep] + list(own.values()), "__text_in")
    stats = materialize(stats.withColumnsRenamed({v: k for k, v in own.items()}), "mcd-statistics")
    kept = [f"__keep_{c}" for c in keep]
    vectors = spark.sql(vectors_sql("{s}", ", ".join(["lang", "source", "base_failed", *BASE, *kept])), s=stats)
    chosen = fit(vectors.drop(*kept))
    cols = ", ".join([*kept, *BASE, "base_failed", "distance2"])
    out = spark.sql(verdict_sql("{v}", "{c}", cols), v=vectors, c=chosen)
    return out.withColumnsRenamed({f"__keep_{c}": c for c in keep if c not in (*BASE, "base_failed", "distance2", "kept")}).drop(
        *[f"__keep_{c}" for c in keep if c in (*BASE, "base_failed", "distance2", "kept")])


def reject_outliers(docs: DataFrame, text: str = "text") -> DataFrame:
    """The documents that are kept, with their own columns."""
    clash = {c: f"__own{i}" for i, c in enumerate(docs.columns)}
    renamed = docs.withColumnsRenamed(clash).withColumns({x: F.col(clash[x]) for x in {"lang", "source", text}})
    judged = quality_verdicts(renamed, keep=tuple(clash.values()), text=text)
    return judged.where("kept").select(*[F.col(v).alias(k) for k, v in clash.items()])


# ---- the SQL twin of the registered query ---------------------------------------------------------------

def _statistics_sql() -> str:
    gap = "[\\x20\\x09-\\x0D]+"
    return f"""
docs AS MATERIALIZED (SELECT row_number() OVER () AS rid, doc_id, lang, source, coalesce(text, '') AS text FROM documents),
words AS MATERIALIZED (
  SELECT rid, i, w FROM (
    SELECT rid, unnest(ws) AS w, unnest(generate_series(1, len(ws))) AS i FROM (
      SELECT rid, string_split_regex(regexp_replace(text, '^{gap}|{gap}$', '', 'g'), '{gap}') AS ws FROM docs) a) b
  WHERE w <> ''),
runs AS (
  SELECT rid, i, count(*) OVER (PARTITION BY rid, w, w1, w2, w3, w4) AS times FROM (
    SELECT rid, i, w, lead(w, 1) OVER x AS w1, lead(w, 2) OVER x AS w2, lead(w, 3) OVER x AS w3, lead(w, 4) OVER x AS w4
    FROM words WINDOW x AS (PARTITION BY rid ORDER BY i)) a WHERE w4 IS NOT NULL),
repeats AS (
  SELECT rid, sum(least(5, coalesce(next - i, 5))) AS n_repeat_words FROM (
    SELECT rid, i, lead(i) OVER (PARTITION BY rid ORDER BY i) AS next FROM runs WHERE times > 1) a GROUP BY rid),
word_counts AS (
  SELECT rid, count(*) AS n_words, sum(length(w)) AS word_chars, count(DISTINCT w) AS n_distinct_words FROM words GROUP BY rid),
line_counts AS (
  SELECT rid, count(*) AS n_lines, count(*) - count(DISTINCT line) AS n_dup_lines FROM (
    SELECT rid, unnest(string_split(text, chr(10))) AS line FROM docs) a
  WHERE regexp_matches(line, '[^\\x20\\x09-\\x0D]') GROUP BY rid),
statistics AS MATERIALIZED (
  SELECT *, {BASE_FAILED} AS base_failed FROM (
    SELECT d.doc_id, d.lang, d.source, CAST(coalesce(n_words, 0) AS BIGINT) AS n_words,
           CAST(coalesce(word_chars, 0) AS BIGINT) AS word_chars,
           CAST(length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
           CAST(coalesce(n_dup_lines, 0) AS BIGINT) AS n_dup_lines, CAST(coalesce(n_lines, 0) AS BIGINT) AS n_lines,
           CAST(length(text) - length(regexp_replace(text, '\\p{{Lu}}', '', 'g')) AS BIGINT) AS n_upper,
           CAST(coalesce(n_distinct_words, 0) AS BIGINT) AS n_distinct_words,
           CAST(coalesce(n_repeat_words, 0) AS BIGINT) AS n_repeat_words
    FROM docs d LEFT JOIN word_counts USING (rid) LEFT JOIN line_counts USING (rid) LEFT JOIN repeats USING (rid)) s)"""


def oracle_ctes() -> list[str]:
    """The whole operator as common table expressions for a plain SQL engine."""
    m = lambda name, sql: f"{name} AS MATERIALIZED ({sql})"
    cols = ", ".join([KEYS] + [f"mu{i}" for i in range(1, P + 1)] + [f"c{i}_{j}" for i, j in PAIRS])
    out = [_statistics_sql(),
           m("vectors", vectors_sql("statistics", "doc_id, lang, source, base_failed, " + ", ".join(BASE))),
           m("members", members_sql("vectors")), m("hist", histogram_sql("members")),
           m("f0", factor_sql(f"(SELECT {cols} FROM ({robust_start_sql('hist')}) a UNION ALL SELECT {cols} FROM ({plain_start_sql('members')}) b) e", KEYS))]
    for k in range(C_STEPS):
        out += [m(f"b{k}", binned_sql("members", f"f{k}")),
                m(f"f{k + 1}", factor_sql(f"({concentrate_sql(f'b{k}')}) e", KEYS))]
    out += [m("best", best_sql(f"f{C_STEPS}")), m("final", reweight_sql("members", "best")), m("chosen", chosen_sql("final"))]
    return out


def oracle_sql() -> str:
    cols = ", ".join(["doc_id", *BASE, "base_failed"])
    return f"WITH {', '.join(oracle_ctes())} {verdict_sql('vectors', 'chosen', cols)}"
