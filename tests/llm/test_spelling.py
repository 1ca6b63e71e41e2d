"""Spelling variants against brute force over all pairs of words."""

import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np

from zonefare.llm import spelling


def one_edit(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(b) - len(a) > 1 or a == b:
        return False
    i = next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), len(a))
    return a[i + 1:] == b[i + 1:] if len(a) == len(b) else a[i:] == b[i + 1:]


def vocabulary(rows):
    seen = Counter()
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    for i, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(lower)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            if h % 199 == 0:
                at = h % len(run)
                run = run[:at] + run[at + 1:]
            if len(run) >= 6:
                seen[run] += 1
    return {w: n for w, n in seen.items() if n >= 5}


def brute(rows):
    n = vocabulary(rows)
    near = {w: [v for v in n if one_edit(w, v)] for w in n}
    form = {}
    for w in n:
        best = min(near[w], key=lambda v: (-n[v], v), default=None)
        if best is not None and n[best] >= 5 * n[w]:
            form[w] = best
    out = []
    for w in n:
        root = w
        while root in form:
            root = form[root]
        out.append((w, form.get(w), root, n[w], len(near[w]), n.get(form.get(w))))
    return sorted(out, key=repr)


def found(spark, rows, **options):
    df = spark.createDataFrame([(i, t, 7, "w", "f") for i, t in rows], "doc_id long, text string, n long, word string, form string")
    return sorted((tuple(r) for r in spelling.group_variants(df.repartition(5), **options).collect()), key=repr)


def corpus(rnd, n=60):
    letters = "abemnrstuÀéÿ"
    base = ["".join(rnd.choice(letters) for _ in range(rnd.randrange(6, 11))) for _ in range(40)]
    words = list(base)
    for w in base:  # variants of variants, so that roots are further away than forms
        for _ in range(4):
            i = rnd.randrange(len(w))
            w = rnd.choice([w[:i] + w[i + 1:], w[:i] + rnd.choice(letters) + w[i + 1:], w[:i] + rnd.choice(letters) + w[i:]])
            words.append(w)
    weight = [500 if k < 4 else rnd.choice([1, 6, 40]) for k in range(len(words))]
    text = lambda: rnd.choice([" ", "-", "1", "\n"]).join(rnd.choices(words, weight, k=400))
    return [(i, text().title() if i % 5 == 0 else text()) for i in range(n)]


def test_variants_forms_and_roots(spark):
    rows = corpus(random.Random(5))
    want = brute(rows)
    assert any(r[1] is not None and r[2] != r[1] for r in want) and sum(r[4] for r in want) > 100
    assert found(spark, rows) == want
    assert found(spark, rows, symbols=2) == want  # crowded reduced words


def test_odd_texts(spark):
    long = "".join(random.Random(2).choice("abc") for _ in range(30_000))
    rows = [(i, f"{long} {long[:-1]} commons commoms commoms") for i in range(6)]  # very long words, one edit apart
    rows += [(None, "commons " * 9), (None, "commons " * 9), (7, None), (8, ""), (9, "abcde " * 50), (10, "x" * 5 + "1" + "y" * 6)]
    rows += [(11, "commons Commons COMMONS ÉCLAIRS éclairs")] * 6
    assert found(spark, rows) == brute(rows)
    assert found(spark, []) == []


def test_keys_meet_for_every_single_edit():
    rnd = random.Random(1)
    for _ in range(300):
        a = "".join(rnd.choice("abcdefghÀÿ") for _ in range(rnd.randrange(6, 14)))
        i = rnd.randrange(len(a))
        b = rnd.choice([a[:i] + a[i + 1:], a[:i] + rnd.choice("abcdefghé") + a[i + 1:], a[:i] + rnd.choice("abé") + a[i:]])
        if a == b:
            continue
        keys = {w: spelling.Keys([w], 5) for w in (a, b)}
        all_of = lambda gen: set(np.concatenate([k for _, k in gen]).tolist())
        entries = {w: all_of(k.entries()) for w, k in keys.items()}
        around = {w: all_of(k.neighbours()) for w, k in keys.items()}
        assert around[a] & entries[b] or around[b] & entries[a], (a, b)


def test_keys_do_not_depend_on_the_stretch(monkeypatch):
    words = ["abracadabra", "ÿabcdefghij"]
    def keys():
        got = defaultdict(set)
        for rows, key in spelling.Keys(words, 5).neighbours():
            for r, k in zip(rows.tolist(), key.tolist()):
                got[r].add(k)
        return got
    want = keys()
    monkeypatch.setattr(spelling, "STRETCH", 30)
    assert keys() == want and len(want[0]) > 20
