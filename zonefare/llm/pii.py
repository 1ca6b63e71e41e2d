"""Personal data by weak supervision: labelers vote, EM weighs them, a classifier decides.

Candidates of a text are the base spans (email, ip, card, phone by their
patterns and checks, always kept) and further ones: card and phone numbers
inside a longer run of digits that failed as a whole, addresses written with
"at" and "dot", and secrets after a name like token or password.  Five labelers
vote +1, -1 or abstain on every candidate: a strict pattern, a gazetteer
(domains, issuer ranges, country codes, reserved networks), words before it,
its boundaries, and the variety of its characters.  EM over the counts of vote
patterns estimates per kind how often a labeler is right (Dawid-Skene with
abstention) and the probability of each pattern; a logistic regression trained on
these probabilities, from votes, kind and length, is the span classifier.  A
further candidate becomes a span if it gives it at least `ACCEPT`.

Only DataFrame / SQL operations.  A document is handled within its row (no
shuffle of texts or spans).  Matches are placed without regular-expression
backtracking: the patterns are possessive and anchored to starts of runs, so a
very long token costs linear time.  What leaves the rows is the count of each
(kind, votes, length class), at most 5 * 3^5 * 3 rows.

Cases: null text is empty; positions are code points, end exclusive; repeated
rows are handled alike; an empty table gives an empty result and the labelers
their prior weights; input columns named like an output column are replaced.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from zonefare.llm.common import materialize, text_or_empty

KINDS = ("email", "ip", "card", "phone", "secret")
LABELERS = 5
EM_ROUNDS = 20
ACCEPT = 0.5
CONTEXT = 40

# Base patterns.  Each starts where a run starts (or where the previous match ended) and its repetitions are
# possessive; as no repetition can give back what the next part needs, the matches are those of the plain pattern.
EMAIL = (r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
IP = r"(?:(?<![0-9])|\G)[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"
CARD = r"[0-9](?:[\x20-]?[0-9])++"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
# Further candidates.
GROUP = r"(?<![0-9])[0-9]{13,19}(?![0-9])"
PHONE_HEAD = r"^\+[0-9]{1,3}[\x20.-]?\(?[0-9]{2,4}\)?[\x20.-]?[0-9]{3}[\x20.-]?[0-9]{4}(?![0-9])"
AT_DOT = r"(?i)(?<![A-Za-z0-9._-])[A-Za-z0-9._-]{1,64}\x20?(?:\[at\]|\(at\)|\{at\}|\x20at\x20)\x20?[A-Za-z0-9-]{1,63}(?:\x20?(?:\[dot\]|\(dot\)|\{dot\}|\x20dot\x20)\x20?[A-Za-z0-9-]{1,63}){1,5}"
SECRET = r"(?i)(?:token|api_?key|secret|passwd|password)[\"']?\x20{0,3}[:=]\x20{0,3}[\"']?[A-Za-z0-9+/_-]{16,}+"
SECRET_VALUE = r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{16,}+$"

# Fixed values of the labelers.
DOMAINS = ("com", "org", "net", "edu", "gov", "int", "info", "io", "co", "de", "fr", "es", "uk", "it", "eu", "us")
COUNTRY_CODES = r"^\+(1|7|20|27|3[0-469]|4[013-9]|5[1-8]|6[0-6]|8[1246]|9[0-58])"
ISSUERS = r"^(4|5[1-5]|2[2-7]|3[47]|35|6011|62|64|65)"
CUES = {
    "email": r"(?i)(e-?mail|contact|write|courriel|correo|kontakt)",
    "ip": r"(?i)(\bip\b|host|server|address|adresse|login)",
    "card": r"(?i)(card|visa|master|credit|carte|tarjeta|karte|payment)",
    "phone": r"(?i)(call|phone|tel|fax|mobile|whatsapp|anruf|llam)",
    "secret": r"(?i)(token|key|secret|passw)",
}
COUNTER_CUES = r"(?i)(version|order|invoice|isbn|issn|serial|figure|section|page|chapter|build)\W*$"


def _bind(value: Column, body: Callable[[Column], Column]) -> Column:
    """body(value) with the value computed once."""
    return F.transform(F.array(value), body)[0]


def _running(lengths: Column) -> Column:
    """Sums of the elements before each position (one more than there are elements), in linear blocks."""
    zero = F.lit(0).cast("bigint")

    def plain(a: Column, start: Column) -> Column:
        return F.aggregate(a, F.array(start), lambda acc, x: F.concat(acc, F.array(F.element_at(acc, -1) + x)))

    block = 512
    blocks = F.transform(F.sequence(F.lit(0), F.floor(F.size(lengths) / block).cast("int")),
                         lambda c: F.slice(lengths, c * block + 1, block))

    def joined(bs: Column) -> Column:
        sums = F.transform(bs, lambda b: F.aggregate(b, zero, lambda acc, x: acc + x))
        return _bind(plain(sums, zero), lambda starts: F.flatten(F.transform(bs, lambda b, i: plain(b, F.get(starts, i)))))

    return F.when(F.size(lengths) <= block, plain(lengths, zero)).otherwise(_bind(blocks, joined))


MATCH = "array<struct<m:string,s:bigint,before:string,after:string>>"


def found(t: Column, pattern: str) -> Column:
    """Matches with their start, up to CONTEXT code points before (back to the match before) and the one after."""
    def place(z: Column) -> Column:
        gap = z["p"]
        lengths = F.transform(z["m"], lambda m, i: (F.length(F.get(gap, i)) + F.length(m)).cast("bigint"))
        # beyond one block the running sums have a start per block besides; a position is found by block and offset
        return _bind(_running(lengths), lambda r: F.transform(z["m"], lambda m, i: F.struct(
            m.alias("m"), (F.get(r, _at(z["m"], i)) + F.length(F.get(gap, i))).cast("bigint").alias("s"),
            F.right(F.get(gap, i), F.lit(CONTEXT)).alias("before"), F.left(F.get(gap, i + 1), F.lit(1)).alias("after"))))

    both = F.struct(F.split(t, pattern, -1).alias("p"), F.regexp_extract_all(t, F.lit(pattern), F.lit(0)).alias("m"))
    return F.when(t.rlike(pattern), _bind(both, place)).otherwise(F.array()).cast(MATCH)


def _at(matches: Column, i: Column) -> Column:
    """Index of the running sum before element i: every block of 512 holds one entry more than elements."""
    return F.when(F.size(matches) <= 512, i).otherwise(i + F.floor(i / 512).cast("int"))


def _digits(m: Column) -> Column:
    return F.regexp_replace(m, "[^0-9]", "")


def luhn(digits: Column) -> Column:
    """Luhn check of 12 to 19 digits."""
    last = F.length(digits)

    def worth(i: Column) -> Column:
        d = F.substring(digits, last - i, F.lit(1))
        return F.when(i % 2 == 1, F.translate(d, "0123456789", "0246813579")).otherwise(d).cast("int")

    total = F.aggregate(F.transform(F.sequence(F.lit(0), last - 1), worth), F.lit(0), lambda acc, x: acc + x)
    return F.when(last.between(12, 19), total % 10 == 0).otherwise(F.lit(False))


_PART = r"0*+(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]{1,2})"


def _valid(kind: str, m: Column) -> Column:
    if kind == "ip":
        # possessive zeros would eat a part that is zero only; those are allowed through the first alternative
        part = rf"(?:0++(?![0-9])|{_PART})"
        return m.rlike(rf"^{part}\.{part}\.{part}\.{part}$")
    if kind == "card":
        return luhn(_digits(m))
    if kind == "phone":
        return F.length(_digits(m)).between(9, 15)
    return F.lit(True)


SPAN = "array<struct<s:bigint,k:int,e:bigint,base:boolean,len:int,votes:array<int>>>"


def _vote(plus: Column, minus: Column) -> Column:
    return F.when(plus, 1).when(minus, -1).otherwise(0)


def _labelled(kind: str, matches: Column, base: bool) -> Column:
    """Spans with the five votes."""
    k, no = KINDS.index(kind), F.lit(False)

    def votes(x: Column) -> Column:
        m, d = x["m"], _digits(x["m"])
        octet = F.split(m, r"\.")[0].cast("decimal(38,0)")
        strict = {
            "email": m.rlike(r"^[A-Za-z0-9][A-Za-z0-9._%+-]*@(?:[A-Za-z0-9-]+\.)++[A-Za-z]{2,}$|(?i)\bdot\b"),
            "ip": m.rlike(r"^(?:0|[1-9][0-9]{0,2})(?:\.(?:0|[1-9][0-9]{0,2})){3}$"),
            "card": F.length(d).between(13, 19) & m.rlike(r"^[0-9]++$|^[0-9]{4}[\x20-][0-9]{4}"),
            "phone": m.rlike(r"^\+[1-9]"), "secret": m.rlike("[0-9]") & m.rlike("[A-Za-z]"),
        }[kind]
        listed = {
            "email": (F.lower(F.regexp_extract(m, r"(?<![A-Za-z])[A-Za-z]++$", 0)).isin(*DOMAINS), no),
            "ip": (octet.between(1, 223) & ~octet.isin(10, 127), octet.isin(0, 127) | (octet > 223)),
            "card": (d.rlike(ISSUERS), ~d.rlike(ISSUERS)), "phone": (m.rlike(COUNTRY_CODES), m.rlike(r"^\+0")),
            "secret": (m.rlike(r"^[0-9a-f]{32,}$|^[A-Za-z0-9+/_-]{24,}$"), no),
        }[kind]
        cue = (x["before"].rlike(CUES[kind]), x["before"].rlike(COUNTER_CUES))
        edge = F.concat(F.right(x["before"], F.lit(1)), x["after"])
        variety = F.size(F.array_distinct(F.split(m, "")))
        return F.array(_vote(strict, ~strict), _vote(*listed), _vote(*cue),
                       _vote(~edge.rlike(r"[\p{L}\p{N}]"), edge.rlike(r"[\p{L}\p{N}]")),
                       _vote(variety >= 6, variety <= 3))

    return F.transform(matches, lambda x: F.struct(
        x["s"].alias("s"), F.lit(k).alias("k"), (x["s"] + F.length(x["m"])).alias("e"), F.lit(base).alias("base"),
        F.least(F.floor(F.length(x["m"]) / 16), F.lit(2)).cast("int").alias("len"), votes(x).alias("votes"))).cast(SPAN)


def _inside(failed: Column, pattern: str, check: Callable[[Column], Column]) -> Column:
    """Candidates inside matches that failed as a whole."""
    def shifted(x: Column) -> Column:
        return F.transform(F.filter(found(x["m"], pattern), lambda y: check(y["m"])), lambda y: F.struct(
            y["m"], x["s"] + y["s"], F.concat(F.when(y["s"] == 0, x["before"]).otherwise(F.lit("")), y["before"]),
            F.when(y["after"] == "", x["after"]).otherwise(y["after"])).cast(MATCH[6:-1]))
    return F.flatten(F.transform(failed, shifted)).cast(MATCH)


def candidate_spans(docs: DataFrame, keep: Sequence[str], text: str = "text") -> DataFrame:
    """`keep` columns and __spans: base spans and further candidates with votes, by start, kind, end."""
    t, kept = F.col("__t"), [F.col(c) for c in keep]
    base = docs.select(*kept, text_or_empty(text).alias("__t"))
    at, digit = F.contains(t, F.lit("@")), t.rlike("[0-9]")
    none = F.array().cast(MATCH)
    raw = base.select(
        *kept, F.when(at, found(t, EMAIL)).otherwise(none).alias("email"), F.when(digit, found(t, IP)).otherwise(none).alias("ip"),
        F.when(digit, found(t, CARD)).otherwise(none).alias("card"), F.when(digit, found(t, PHONE)).otherwise(none).alias("phone"),
        F.when(t.rlike(r"(?i)(?:\[at\]|\(at\)|\{at\}|\x20at\x20)"), found(t, AT_DOT)).otherwise(none).alias("at_dot"),
        F.when(t.rlike("(?i)(token|key|secret|passw)"), found(t, SECRET)).otherwise(none).alias("named"))
    value = F.transform("named", lambda x: _bind(F.regexp_extract(x["m"], SECRET_VALUE, 0), lambda v: F.struct(
        v, x["s"] + F.length(x["m"]) - F.length(v),
        F.concat(x["before"], F.left(x["m"], F.length(x["m"]) - F.length(v))), x["after"]).cast(MATCH[6:-1]))).cast(MATCH)
    passed = lambda kind, good: F.filter(kind, lambda x: _valid(kind, x["m"]) if good else ~_valid(kind, x["m"]))
    parts = [_labelled(k, passed(k, True), True) for k in KINDS[:4]]
    parts += [
        _labelled("card", _inside(passed("card", False), GROUP, lambda m: luhn(m)), False),
        _labelled("phone", _inside(passed("phone", False), PHONE_HEAD,
                                   lambda m: F.length(_digits(m)).between(9, 15)), False),
        _labelled("email", F.col("at_dot"), False), _labelled("secret", value, False)]
    return raw.select(*kept, F.sort_array(F.concat(*parts)).alias("__spans"))


# ---- label model and classifier -------------------------------------------------------------------------

#: Prior rates of a vote: +1 and -1 on true and on false candidates, and their weight in observations.
PRIOR_RATES = (0.60, 0.10, 0.20, 0.45)
PRIOR_WEIGHT = 20.0
STATE = "struct<prior:double,rates:array<struct<p1:double,m1:double,p0:double,m0:double>>>"


def vote_patterns(spans: DataFrame) -> DataFrame:
    """k, votes, len, n: counts over all candidates."""
    return spans.select(F.explode("__spans").alias("x")).groupBy(
        F.col("x.k").alias("k"), F.col("x.votes").alias("votes"), F.col("x.len").alias("len")).agg(F.count(F.lit(1)).alias("n"))


def _posterior(state: Column, votes: Column) -> Column:
    def term(acc: Column, i: Column) -> Column:
        return _bind(F.get(state["rates"], i), lambda r: acc + F.when(F.get(votes, i) == 1, F.log(r["p1"] / r["p0"])).when(
            F.get(votes, i) == -1, F.log(r["m1"] / r["m0"])).otherwise(F.log((1 - r["p1"] - r["m1"]) / (1 - r["p0"] - r["m0"]))))
    logit = F.aggregate(F.sequence(F.lit(0), F.lit(LABELERS - 1)), F.log(state["prior"] / (1 - state["prior"])), term)
    return 1 / (1 + F.exp(-logit))


def label_model(patterns: DataFrame) -> DataFrame:
    """k, votes, len, n, p: EM per kind over its (at most 3^5 * 3) patterns, within one row."""
    p1, m1, p0, m0 = PRIOR_RATES
    rate = F.struct(F.lit(p1), F.lit(m1), F.lit(p0), F.lit(m0))
    start = F.struct(F.lit(0.5), F.array(*[rate] * LABELERS)).cast(STATE)

    def total(rows: Column, of: str, where: Callable[[Column], Column] | None = None) -> Column:
        return F.aggregate(rows, F.lit(0.0), lambda acc, x: acc + (F.when(where(x), x[of]).otherwise(0.0) if where else x[of]))

    def improved(state: Column) -> Column:
        soft = F.transform("rows", lambda x: _bind(_posterior(state, x["votes"]), lambda q: F.struct(
            x["votes"].alias("votes"), (x["n"] * q).alias("yes"), (x["n"] * (1 - q)).alias("no"))))

        def estimated(rows: Column) -> Column:
            yes, no = total(rows, "yes"), total(rows, "no")
            share = lambda of, i, vote, prior, whole: (
                total(rows, of, lambda x: F.get(x["votes"], i) == vote) + PRIOR_WEIGHT * prior) / (whole + PRIOR_WEIGHT)
            rates = F.transform(F.sequence(F.lit(0), F.lit(LABELERS - 1)), lambda i: F.struct(
                share("yes", i, 1, p1, yes), share("yes", i, -1, m1, yes), share("no", i, 1, p0, no), share("no", i, -1, m0, no)))
            return F.struct((yes + PRIOR_WEIGHT / 2) / (yes + no + PRIOR_WEIGHT), rates).cast(STATE)

        return _bind(soft, estimated)

    per_kind = patterns.groupBy("k").agg(F.collect_list(F.struct("votes", "len", F.col("n").cast("double").alias("n"))).alias("rows"))
    solved = per_kind.select("k", "rows", F.aggregate(
        F.sequence(F.lit(1), F.lit(EM_ROUNDS)), start, lambda state, _: improved(state)).alias("state"))
    return solved.select("k", "state", F.explode("rows").alias("x")).select(
        "k", F.col("x.votes").alias("votes"), F.col("x.len").alias("len"), F.col("x.n").alias("n"),
        _posterior(F.col("state"), F.col("x.votes")).alias("p"))


def _features(k: Column, votes: Column, length: Column) -> list[Column]:
    one = lambda c: c.cast("double")
    return ([one(F.get(votes, F.lit(i)) == v) for i in range(LABELERS) for v in (1, -1)]
            + [one(k == i) for i in range(len(KINDS))] + [one(length == i) for i in (1, 2)])


def train_classifier(labelled: DataFrame) -> list[float]:
    """Intercept and weights of the span classifier, from the label model's probabilities (a bounded table)."""
    from pyspark.ml.classification import LogisticRegression
    from pyspark.ml.feature import VectorAssembler

    n = len(_features(F.lit(0), F.array(), F.lit(0)))
    rows = labelled.select(*[f.alias(f"f{i}") for i, f in enumerate(_features(F.col("k"), F.col("votes"), F.col("len")))],
                           F.explode(F.array(F.struct(F.lit(1.0).alias("label"), (F.col("n") * F.col("p")).alias("w")),
                                             F.struct(F.lit(0.0).alias("label"), (F.col("n") * (1 - F.col("p"))).alias("w")))).alias("y")
                           ).select(*[f"f{i}" for i in range(n)], "y.label", "y.w")
    # one observation of each outcome for the majority of votes, so that both labels occur in any table
    anchors = [tuple([float(v == s) for _ in range(LABELERS) for v in (1, -1)] + [0.0] * (len(KINDS) + 2) + [label, 1.0])
               for s, label in ((1, 1.0), (-1, 0.0))]
    names = [f"f{i}" for i in range(n)] + ["label", "w"]
    rows = rows.unionByName(labelled.sparkSession.createDataFrame(anchors, ", ".join(f"{c} double" for c in names)))
    frame = VectorAssembler(inputCols=names[:n], outputCol="features").transform(rows).coalesce(1)
    model = LogisticRegression(maxIter=30, regParam=1e-3, weightCol="w", standardization=False).fit(frame)
    return [float(model.intercept), *map(float, model.coefficients)]


def judged_spans(docs: DataFrame, keep: Sequence[str], text: str = "text") -> DataFrame:
    """`keep` columns and __spans, of which further candidates have passed the classifier."""
    spans = materialize(candidate_spans(docs, keep, text), "pii-candidates")
    weights = train_classifier(materialize(label_model(vote_patterns(spans)), "pii-labels"))

    def accepted(x: Column) -> Column:
        logit = sum((w * f for w, f in zip(weights[1:], _features(x["k"], x["votes"], x["len"]))), F.lit(weights[0]))
        return x["base"] | (1 / (1 + F.exp(-logit)) >= ACCEPT)

    return spans.withColumn("__spans", F.filter("__spans", accepted))


def _written(spans: Column) -> Column:
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", F.get(names, x["k"]), x["s"].cast("string"), x["e"].cast("string"))), ",")


def find_personal_data(docs: DataFrame, keep: Sequence[str] = ("doc_id",), text: str = "text") -> DataFrame:
    """`keep` columns, counts of base spans by kind, base_sha256, spans, n_added."""
    keep = [c for c in keep if c not in ("base_sha256", "spans", "n_added", *[f"n_{k}" for k in KINDS])]
    out = judged_spans(docs, keep, text)
    base = F.filter("__spans", lambda x: x["base"])
    of_kind = lambda i: F.filter("__spans", lambda x: x["base"] & (x["k"] == i))
    counts = [F.size(of_kind(i)).cast("bigint").alias(f"n_{k}") for i, k in enumerate(KINDS[:4])]
    return out.select(*keep, *counts, F.sha2(_written(base), 256).alias("base_sha256"), _written(F.col("__spans")).alias("spans"),
                      F.size(F.filter("__spans", lambda x: ~x["base"])).cast("bigint").alias("n_added"))


def redacted(text: Column, spans: Column) -> Column:
    """The text with every span replaced by its kind in angle brackets; overlapping spans become one."""
    names = F.array(*[F.lit(f"<{k.upper()}>") for k in KINDS])
    start = F.struct(F.array().cast("array<string>"), F.lit(0).cast("bigint")).cast("struct<out:array<string>,at:bigint>")

    def step(acc: Column, x: Column) -> Column:
        before = F.substring(text, (acc["at"] + 1).cast("int"), (x["s"] - acc["at"]).cast("int"))
        return F.struct(F.when(x["s"] >= acc["at"], F.concat(acc["out"], F.array(before, F.get(names, x["k"])))).otherwise(acc["out"]),
                        F.greatest(acc["at"], x["e"])).cast("struct<out:array<string>,at:bigint>")

    done = F.aggregate(spans, start, step, lambda acc: F.concat(
        F.array_join(acc["out"], ""), F.substring(text, (acc["at"] + 1).cast("int"), F.length(text))))
    return F.when(F.size(spans) == 0, text).otherwise(done)


def redact(docs: DataFrame, text: str = "text") -> DataFrame:
    """The input rows and columns with personal data in the text replaced; null texts stay null."""
    clash = {c: f"__own{i}" for i, c in enumerate(docs.columns)}
    own = clash[text]
    out = judged_spans(docs.withColumnsRenamed(clash), list(clash.values()), own)
    return out.withColumn(own, redacted(F.col(own).cast("string"), F.col("__spans"))).select(
        *[F.col(v).alias(k) for k, v in clash.items()])
