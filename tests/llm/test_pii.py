"""Personal data: base spans against plain regular expressions, odd rows, very long texts."""

import hashlib
import random
import re

from conftest import SF001

from zonefare.llm import pii

BASE = {
    "email": re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"),
    "ip": re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"),
    "card": re.compile(r"[0-9]([\x20-]?[0-9])+"),
    "phone": re.compile(r"\+[0-9][\x20().0-9-]+[0-9]"),
}


def luhn(d):
    t = 0
    for i, c in enumerate(reversed(d)):
        x = int(c) * (1 + i % 2)
        t += x - 9 * (x > 9)
    return t % 10 == 0


def brute(text):
    out = []
    for k, p in BASE.items():
        for m in p.finditer(text or ""):
            d = re.sub("[^0-9]", "", m.group())
            ok = {"email": True, "ip": all(int(x) <= 255 for x in m.group().split(".")) if k == "ip" else True,
                  "card": 12 <= len(d) <= 19 and luhn(d), "phone": 9 <= len(d) <= 15}[k]
            if ok:
                out.append((m.start(), list(BASE).index(k), f"{k}:{m.start()}:{m.end()}"))
    return [s for _, _, s in sorted(out)]


def check(rows, texts):
    assert len(rows) == len(texts)
    for r in rows:
        want = brute(texts[r.doc_id])
        got = [r.n_email, r.n_ip, r.n_card, r.n_phone]
        assert got == [sum(s.startswith(k + ":") for s in want) for k in BASE], (r, texts[r.doc_id][:200])
        assert r.base_sha256 == hashlib.sha256(",".join(want).encode()).hexdigest(), (r.doc_id, want, r.spans)
        spans = r.spans.split(",") if r.spans else []
        assert set(want) <= set(spans) and len(spans) == len(want) + r.n_added


def test_query_against_plain_patterns(spark):
    from zonefare.llm.queries import QUERIES
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SF001}/documents.parquet").collect()}
    check(QUERIES["op3_weak_supervision_pii"](spark, SF001).collect(), texts)


def random_texts():
    rnd = random.Random(5)
    parts = ["a@b.co", "x.y+z@q-r.s.t", "@", ".", "_", "1.2.3.4", "256.1.1.1", "010.000.0.255", "4111111111111111", "4111 1111 1111 1111",
             "+1 (743) 555-3824", "+49 30 1234567", "+", "-", " ", " ", "é", "你", "12", "7", "\n", "(", ")", "token = \"ab12cd34ef56ab12cd34\""]
    return {1000 + i: "".join(rnd.choice(parts) for _ in range(rnd.randint(0, 40))) for i in range(500)}


def test_random_odd_and_long_texts(spark):
    odd = [(1, None, "a", 3), (2, "", "a", 3), (3, "a@b.cc " * 3000, "b", 3), (4, "a" * 50_000 + "@x.yz", "b", 3),
           (5, "1" * 50_000, "b", 3), (6, "1." * 20_000, None, 3), (7, "a." * 50_000, None, 3), (8, "+1" + "(" * 100_000, "c", 1),
           (9, "4111 1111 1111 1111, " * 1000, "c", 1), (10, "x@" + "a." * 50_000 + "b", "c", 1), (None, "z", None, None)]
    rows = odd + [(i, t, "x", 0) for i, t in random_texts().items()]
    df = spark.createDataFrame(rows, "doc_id long, text string, spans string, n_email int")
    out = pii.find_personal_data(df, keep=("doc_id", "spans", "n_email")).collect()
    check(out, {i: t for i, t, _, _ in rows})


def test_numbers_inside_failed_runs_and_secrets_are_added(spark):
    extra = {20: ("call me 4465758382889437 4465758382889437 now", "card:8:24,card:25:41"),
             21: ('the token = "be64439e3e49cf46b2d7c90f3602a3d0b907ff12" here', "secret:13:53"),
             22: ("plain text with no data at all", ""), 23: ("write to jane.doe [at] example [dot] com today", "email:9:40")}
    rows = [(i, t) for i, (t, _) in extra.items()] + [(i, f"a word 4465758382889437 +1 (743) 555-{i} or 9.8.7.6") for i in range(1000, 1100)]
    out = {r.doc_id: r.spans for r in pii.find_personal_data(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert {i: out[i] for i in extra} == {i: s for i, (_, s) in extra.items()}


def test_redaction_repeated_rows_and_clashing_names(spark):
    rows = [(7, "mail q@w.ee now", "a", None), (7, "mail q@w.ee now", "a", None), (8, None, "b", 1), (9, "4111 1111 1111 1111, " * 1000, "c", 1)]
    df = spark.createDataFrame(rows, "doc_id long, text string, spans string, n_email int")
    red = pii.redact(df).collect()
    assert red[0].asDict().keys() == {"doc_id", "text", "spans", "n_email"}
    assert sorted((r.doc_id, r.text) for r in red if r.text) == [(7, "mail <EMAIL> now")] * 2 + [(9, "<CARD>, " * 1000)]
    assert [r.text for r in red if r.doc_id == 8] == [None]
    assert pii.find_personal_data(df.limit(0)).count() == 0
