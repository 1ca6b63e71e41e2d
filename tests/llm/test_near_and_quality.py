"""Near-duplicates, robust quality, mixing: brute force on small tables, odd rows."""

import collections
import itertools
import math
import random
import re

import numpy as np
import pyarrow as pa

from zonefare.llm import mixing, probminhash, quality_mcd


def words(text):
    return re.sub(r"[\x20\x09-\x0D]+", " ", (text or "").lower()).strip(" ").split()


def bag(text):
    w = words(text)
    return collections.Counter(tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))) if w else collections.Counter()


def jaccards(a, b):
    if not a or not b:
        return (1.0, 1.0) if a == b else (0.0, 0.0)
    keys = set(a) | set(b)
    plain = len(set(a) & set(b)) / len(keys)
    prob = sum(1 / sum(max(a[j] / a[i], b[j] / b[i]) for j in keys) for i in set(a) & set(b))
    return prob, plain


def brute_classes(rows):
    parent = {i: i for i, _ in rows}

    def top(x):
        while parent[x] != x:
            x = parent[x]
        return x

    bags = [(i, bag(t)) for i, t in rows]
    for (i, a), (j, b) in itertools.combinations(bags, 2):
        if (not a and not b) or (a and b and set(a) & set(b) and max(jaccards(a, b)) >= 0.8 - 1e-12):
            x, y = sorted((top(i), top(j)))
            parent[y] = x
    return {i: top(i) for i in parent}


def copies(seed=2, groups=12):
    """Texts with edited copies at all distances, chains, and a group around one original."""
    rnd = random.Random(seed)
    new = lambda: "".join(rnd.choice("abcdefgh") for _ in range(rnd.randint(2, 6)))
    rows = []
    for g in range(groups):
        base = [new() for _ in range(rnd.choice([3, 12, 60, 150]))]
        rows.append(" ".join(base))
        cur = base
        for _ in range(rnd.randint(0, 14)):
            cur = list(cur if g % 3 == 0 else base)
            for _ in range(rnd.randint(0, 6)):
                cur[rnd.randrange(len(cur))] = new()
            rows.append(rnd.choice([" ", "\n"]).join(cur) if rnd.random() < 0.8 else " ".join(base).upper())
        if g % 4 == 1:
            rows.append(" ".join(base + base[:40]))
    rnd.shuffle(rows)
    return list(enumerate(rows))


def test_classes_against_brute_force(spark):
    rows = copies() + [(900, None), (901, ""), (902, " \n"), (903, "tiny"), (904, "Tiny"), (905, "la " * 3000), (906, "la " * 2000)]
    df = spark.createDataFrame([(i, t, 1, "x") for i, t in rows], "doc_id long, text string, class_id int, representative string").repartition(5)
    out = probminhash.classes(df).collect()
    assert {r.doc_id: r.class_id for r in out} == brute_classes(rows)
    kept = probminhash.deduplicated(df).collect()
    assert {r.doc_id for r in kept} == set(brute_classes(rows).values()) and len(kept) == len({r.doc_id for r in kept})
    assert kept[0].asDict().keys() == {"doc_id", "text", "class_id", "representative"} and kept[0].representative == "x"


def test_repeated_rows_null_ids_and_empty_table(spark):
    text = "one two three four five six seven eight"
    df = spark.createDataFrame([(1, text), (1, text), (None, text), (None, "other words here and there again"), (2, text + " ")], "doc_id long, text string")
    out = probminhash.classes(df).collect()
    assert sorted((r.doc_id is None, r.class_id is None) for r in out) == [(False, False)] * 3 + [(True, False), (True, True)]
    assert sum(r.representative for r in out) == 2
    assert probminhash.deduplicated(df).count() == 2 and probminhash.classes(df.limit(0)).count() == 0


def test_signature_estimates_probability_jaccard():
    rnd = random.Random(7)
    a = " ".join(str(rnd.randint(0, 60)) for _ in range(300)).split()
    b = a[:200] + [str(rnd.randint(0, 60)) for _ in range(100)]
    texts = pa.array([" ".join(a), " ".join(b)], pa.large_string())
    d, e, w = probminhash.shingles(texts)
    # one word as shingle: weights well above one
    sig = probminhash.signatures(d, e, w, 2, 20_000)
    want = jaccards(bag(" ".join(a)), bag(" ".join(b)))[0]
    assert abs((sig[0] == sig[1]).mean() - want) < 0.02
    weights = np.array([1, 5, 2, 9, 4, 1]), np.array([3, 1, 2, 9, 8, 2])
    x, y = (dict(enumerate(v)) for v in weights)
    sig = probminhash.signatures(np.repeat([0, 1], 6), probminhash.mix(np.tile(np.arange(6), 2).astype(np.uint64)), np.concatenate(weights), 2, 40_000)
    assert abs((sig[0] == sig[1]).mean() - jaccards(x, y)[0]) < 0.02
    h = np.arange(6).astype(np.uint64)
    assert math.isclose(probminhash.similarity((h, weights[0]), (h, weights[1]))[0], jaccards(x, y)[0])


def junk(kind, rnd):
    w = ["".join(rnd.choice("etaoinshr") for _ in range(rnd.randint(2, 8))) for _ in range(rnd.randint(30, 90))]
    return {"clean": lambda: " ".join(w).capitalize() + ".", "symbols": lambda: " ".join(x + "***" for x in w),
            "shout": lambda: " ".join(x.upper() + "!!" for x in w), "table": lambda: " | ".join(w)}[kind]()


def test_outliers_go_and_clean_documents_stay(spark):
    rnd = random.Random(9)
    kinds = ["clean"] * 300 + ["symbols"] * 25 + ["shout"] * 25 + ["table"] * 25
    rows = [(i, junk(k, rnd), rnd.choice(["en", "fr"]), rnd.choice(["a", "b", None]), k) for i, k in enumerate(kinds)]
    rows += [(900, None, "en", "a", "base"), (901, "", None, None, "base"), (902, "few words only", "en", "a", "base"), (903, "same again and again now " * 2000, "en", "a", "base"),
             (1, rows[1][1], "xx", "rare", "clean")]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, kept string").repartition(4)
    kept = quality_mcd.reject_outliers(df).collect()
    assert kept[0].asDict().keys() == {"doc_id", "text", "lang", "source", "kept"}
    assert collections.Counter(r.kept for r in kept) == {"clean": 301}
    assert quality_mcd.reject_outliers(df.limit(0)).count() == 0


def test_groups_with_much_junk_lose_all_of_it(spark):
    """10, 25, 30 and 40 percent of symbol junk in one language and source; distances against numpy's covariance of the rest."""
    rnd, rows = random.Random(4), []
    for g, share in enumerate((0.10, 0.25, 0.30, 0.40)):
        rows += [(1000 * g + i, junk("symbols" if i < 400 * share else "clean", rnd), "en", f"s{g}", i < 400 * share) for i in range(400)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, junk boolean").repartition(3)
    out = quality_mcd.quality_verdicts(df, keep=("doc_id", "source", "junk")).collect()
    assert {(r.source, r.junk) for r in out if r.kept} == {(f"s{g}", False) for g in range(4)}
    assert sum(r.kept for r in out) >= 0.98 * sum(not r.junk for r in out)
    # junk is far away in every group, the clean rows are near
    for g in range(4):
        far = [r.distance2 for r in out if r.source == f"s{g}" and r.junk]
        near = sorted(r.distance2 for r in out if r.source == f"s{g}" and not r.junk)
        assert min(far) > 2 * near[int(0.98 * len(near))]


def test_base_counts(spark):
    rows = {1: "a b c d e a b c d e x", 2: "#1 <b> $ %\n \nline\nline\r\nline", 3: "\x0b\x0c", 4: "é " * 50, 5: "w1 w2 w3 w4 w5 w6 w7 w8 w9 w0 w1 w2 w3 w4 w5 w6"}
    df = spark.createDataFrame([(i, t, "l", "s") for i, t in rows.items()], "doc_id long, text string, lang string, source string")
    for r in quality_mcd.quality_verdicts(df).collect():
        t = rows[r.doc_id]
        w = re.findall(r"[^\x20\x09-\x0D]+", t)
        lines = [x for x in t.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
        runs = [tuple(w[i:i + 5]) for i in range(len(w) - 4)]
        covered = {i + k for i, x in enumerate(runs) if runs.count(x) > 1 for k in range(5)}
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == (
            len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t)), len(lines) - len(set(lines)), len(covered))


def test_chi_square_constants():
    assert math.isclose(quality_mcd.chi2_cdf(3.0, 2), 1 - math.exp(-1.5), rel_tol=1e-12)
    assert math.isclose(quality_mcd.chi2_quantile(0.95, 1), 3.841458820694124, rel_tol=1e-9)
    assert 0.5 < quality_mcd.consistency(0.975) < 1.2 < quality_mcd.consistency(0.5)


def test_mixture_follows_the_weights(spark):
    rows = [(i, "a" if i % 3 else "b", "x" * 99) for i in range(6000)]
    weights = {"a": 0.25, "b": 0.75}
    df = spark.createDataFrame(rows, "doc_id long, source string, text string")
    out = mixing.poisson_replicate(df, weights, epochs=1.0).collect()
    share = sum(r.source == "a" for r in out) / len(out)
    assert abs(share - 0.25) < 0.02 and abs(len(out) - 6000) < 250
    n = collections.Counter(r.doc_id for r in out if r.source == "b")
    copies_b = np.array([n.get(i, 0) for i, s, _ in rows if s == "b"])
    rate = 0.75 * 6000 / 2000
    for k in range(6):  # Poisson shares
        assert abs((copies_b == k).mean() - math.exp(-rate) * rate**k / math.factorial(k)) < 0.04
    # shuffled: the ids of neighbours are as far apart as those of any two rows (a third of the range on average)
    ids = [r.doc_id for r in out]
    assert abs(np.abs(np.diff(ids)).mean() - 2000) < 150


def test_mixing_odd_rows(spark):
    df = spark.createDataFrame([(1, None, None, 7), (None, "a", "t", 7), (2, "a", "", 7), (2, "a", "", 7), (3, "zero", "t", 7)], "doc_id long, source string, text string, mix_copy int")
    out = mixing.poisson_replicate(df, {"a": 1.0, "zero": 0.0, mixing.REST: 1.0}, epochs=400.0).collect()
    assert {r.source for r in out} == {"a", None}
    n = collections.Counter((r.doc_id, r.source) for r in out)
    assert n[(2, "a")] % 2 == 0 and n[(1, None)] > 300
    assert mixing.poisson_replicate(df.limit(0), {"a": 1.0}).count() == 0
    assert mixing.poisson_replicate(df, {"nowhere": 1.0}).count() == 0


def test_repeated_lines_are_linked_by_plain_jaccard(spark):
    """A body with a line once, 20 and 40 times: plain Jaccard above 0.8, probability Jaccard down to 0.36."""
    rnd, rows = random.Random(11), []
    for g in range(12):
        body, line = ([f"g{g}{rnd.choice('abcdefgh')}{rnd.randint(0, 9999)}" for _ in range(n)] for n in (200, 10))
        rows += [(100 * g + k, " ".join(body + line * k)) for k in (1, 20, 40)]
    a, b, c = (bag(t) for _, t in rows[:3])
    assert jaccards(a, b)[1] > 0.9 and jaccards(a, b)[0] < 0.6 and jaccards(a, c)[0] < 0.45
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    assert {r.doc_id: r.class_id for r in probminhash.classes(df).collect()} == brute_classes(rows) == {i: i // 100 * 100 + 1 for i, _ in rows}
