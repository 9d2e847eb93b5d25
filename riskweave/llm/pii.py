"""Personal data: fixed patterns, and a weakly supervised classifier for other forms.

Base spans are the valid matches of one pattern per kind (email, ip, card, phone)
and always stay. Candidates are the base matches, valid or not, and looser forms
(written-out addresses, national phone numbers, 8-group addresses, 15-digit
cards). Four labelers vote +1, -1 or 0 on each: the pattern with its validity
test, a gazetteer of domains, ranges, issuers and area codes, cue words before
the span, and the characters around it. Expectation-maximisation over the counts
of vote patterns estimates each labeler's reliability per kind and the posterior
of each pattern; a logistic classifier is fitted to the posteriors and decides
which of the loose candidates are added. It sees the votes, kind and length, and
hashed features that no labeler reads: the span's shape (runs of digits and letters),
its first and last characters and the words around it.

Everything that touches documents is a row-local JVM expression. What comes to
the driver is the table of vote patterns with their counts over all documents, whose
size is bounded by the number of patterns (kinds x 3^4 votes x 3 lengths), and the
distinct feature rows that the classifier is fitted on: about ``TRAIN_SPANS``, taken
by their hash, so that copies count once and reruns agree.

Defined cases: null text is empty; equal rows are treated alike; spans count code
points, end exclusive; no candidates leave the classifier without additions.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskweave.llm import spans as S
from riskweave.llm.common import attach, let, stage

KINDS = ("email", "ip", "card", "phone")
LABELERS = ("form", "gazetteer", "context", "bounds")
THRESHOLD = 0.9
ROUNDS = 25
CONTEXT = 40
#: Hash buckets of the classifier's features, and the distinct candidates it is fitted on.
BUCKETS = 1 << 12
TRAIN_SPANS = 20_000

# Private-use characters stand in for a dot between two label characters and for a
# single separator between two digits, one for one, so that every pattern below
# repeats character classes only.
DOT, GAP = "", ""
LOCAL = rf"[A-Za-z0-9._%+{DOT}-]"
EMAIL = rf"(?:(?<!{LOCAL})|\G){LOCAL}++@[A-Za-z0-9-]++{DOT}[A-Za-z0-9{DOT}-]++"
IP = r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"
OCTET = r"0*+(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])?"
IP_VALID = rf"^{OCTET}\.{OCTET}\.{OCTET}\.{OCTET}$"
CARD = rf"[0-9][0-9{GAP}]{{15,}}+"
PHONE = r"\+[0-9][ ().0-9-]+[0-9]"

LOOSE = {
    "email": (r"[\[({<](?:at|AT)[\])}>]",
              r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]{1,64}+ ?[\[({<](?:at|AT)[\])}>] ?[A-Za-z0-9-]{1,63}+"
              r"(?: ?(?:\.|[\[({<](?:dot|DOT)[\])}>]) ?[A-Za-z0-9-]{1,63}+){1,8}"),
    "ip": (r"[0-9A-Fa-f]:[0-9A-Fa-f]{1,4}:",
           r"(?<![0-9A-Za-z:])(?:[0-9A-Fa-f]{1,4}:){7}[0-9A-Fa-f]{1,4}(?![0-9A-Za-z:])"),
    "card": (r"3[47][0-9]{2}", r"(?<![0-9A-Za-z-])3[47][0-9]{2}[ -]?[0-9]{6}[ -]?[0-9]{5}(?![0-9A-Za-z-])"),
    "phone": (r"[0-9]{3}[ .-][0-9]{4}",
              r"(?<![0-9A-Za-z+.-])\(?[0-9]{3}\)?[ .-][0-9]{3}[ .-][0-9]{4}(?![0-9A-Za-z-])"),
}
# Values that speak for and against a kind.
GAZETTEER = {
    "email": (r"(?i)(?:\.|dot[\])}>] ?)(?:com|org|net|edu|gov|info|io|eu|de|fr|es|uk|it|nl|ch|at|us|ca)$", r"(?i)\.(?:png|jpg|gif|js|css|py|txt)$"),
    "ip": (r"^(?:[1-9]|[1-9][0-9]|1[0-9][0-9]|2[01][0-9]|22[0-3])\.|^(?:2[0-9a-fA-F]{3}|f[cdeCDE][0-9a-fA-F]{2}):", r"^0|^(?:22[4-9]|2[345][0-9])\."),
    "card": (r"^(?:4|5[1-5]|2[2-7]|3[47]|35|6011|65)", r"^(?:0|1|9)"),
    "phone": (r"^\+(?:1|7|2[07]|3[0-469]|4[013-9]|5[1-8]|6[0-6]|8[1246]|9[0-58])|^\(?[2-9][0-9]{2}\)?[ .-][2-9]", r"^\+0|^\(?[01]"),
}
CUES = {
    "email": (r"mail|contact|write|reach|schreib|correo|courriel", r"example|regex|syntax"),
    "ip": (r"\bip\b|host|server|address|adresse|dirección|client|login", r"version|release|section|kapitel|chapter"),
    "card": (r"card|visa|master|amex|credit|pay|karte|carte|tarjeta", r"isbn|serial|order|tracking|invoice"),
    "phone": (r"phone|call|tel\b|tel[.:]|mobile|cell|fax|contact|ruf|llam|appel", r"isbn|serial|order|version|page"),
}


def luhn(digits: Column) -> Column:
    n = F.length(digits)

    def part(total, i):
        d = F.substr(digits, i, F.lit(1)).cast("int")
        return total + F.when((n - i) % 2 == 1, 2 * d - F.when(d > 4, 9).otherwise(0)).otherwise(d)

    return F.aggregate(F.sequence(F.lit(1), n), F.lit(0), part) % 10 == 0


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]+", "")


def _valid(kind: str, value: Column) -> Column:
    if kind == "ip":
        return F.rlike(value, F.lit(IP_VALID))
    if kind == "card":
        return let(_digits(value), lambda d: F.length(d).between(16, 19) & luhn(d))
    if kind == "phone":
        return F.length(_digits(value)).between(8, 15)
    return F.lit(True)


def base_matches(text: Column) -> dict[str, Column]:
    """All matches of the base patterns, valid or not."""
    clean = F.regexp_replace(text, f"[{DOT}{GAP}]", "")
    dots = F.regexp_replace(clean, r"(?<=[A-Za-z0-9-])\.(?=[A-Za-z0-9-])", DOT)
    gaps = F.regexp_replace(clean, r"(?<=[0-9])[ -](?=[0-9])", GAP)
    return {
        "email": F.when(F.contains(text, F.lit("@")), let(dots, lambda t: S.find(t, EMAIL))).otherwise(S.none()),
        "ip": F.when(F.rlike(text, F.lit(r"[0-9]\.[0-9]")), S.find(text, IP)).otherwise(S.none()),
        "card": F.when(F.rlike(text, F.lit(r"[0-9](?:[ -]?[0-9]){15}")), let(gaps, lambda t: S.find(t, CARD))).otherwise(S.none()),
        "phone": F.when(F.contains(text, F.lit("+")), S.find(text, PHONE)).otherwise(S.none()),
    }


def loose_matches(text: Column) -> dict[str, Column]:
    found = {kind: F.when(F.rlike(text, F.lit(sign)), S.find(text, pattern)).otherwise(S.none())
             for kind, (sign, pattern) in LOOSE.items()}
    found["card"] = F.filter(found["card"], lambda s: luhn(_digits(s["value"])))
    return found


def _vote(yes: Column, no: Column) -> Column:
    return F.when(yes, F.lit(1)).when(no, F.lit(-1)).otherwise(F.lit(0))


def _hashed(kind: str, value: Column, before: Column, after: Column) -> Column:
    """Buckets of the features that labelers do not read."""
    shape = F.regexp_replace(F.regexp_replace(value, r"[0-9]++", "9"), r"\p{L}++", "a")
    size = F.length(value)
    word = F.lit(r"\p{L}{2,}+")
    near = [F.transform(F.slice(F.reverse(F.regexp_extract_all(before, word, F.lit(0))), 1, 3), lambda w: F.concat(F.lit("before "), w)),
            F.transform(F.slice(F.regexp_extract_all(after, word, F.lit(0)), 1, 2), lambda w: F.concat(F.lit("after "), w))]
    own = F.array(F.concat(F.lit("shape "), shape), F.concat(F.lit("first "), F.substr(value, F.lit(1), F.lit(2))),
                  F.concat(F.lit("last "), F.substr(value, F.greatest(F.lit(1), size - 2), F.lit(3))))
    return F.array_distinct(F.transform(F.concat(own, *near), lambda f: F.pmod(F.xxhash64(F.lit(kind), f), F.lit(BUCKETS)).cast("int")))


def _candidate(kind: str, text: Column, s: Column, form: Column) -> Column:
    """A candidate with its votes."""
    value = F.translate(s["value"], DOT + GAP, ". ")
    before = F.lower(F.substr(text, F.greatest(F.lit(1), s["start"] - CONTEXT + 1), F.least(s["start"], F.lit(CONTEXT))))
    sides = F.concat(F.when(s["start"] > 0, F.substr(text, s["start"], F.lit(1))).otherwise(F.lit(" ")),
                     F.substr(text, s["end"] + 1, F.lit(1)))
    after = F.lower(F.substr(text, s["end"] + 1, F.lit(CONTEXT)))
    size = s["end"] - s["start"]
    return F.struct(
        s["start"].alias("start"), s["end"].alias("end"), F.lit(kind).alias("kind"), form.alias("form"),
        _vote(F.rlike(value, F.lit(GAZETTEER[kind][0])), F.rlike(value, F.lit(GAZETTEER[kind][1]))).alias("gazetteer"),
        _vote(F.rlike(before, F.lit(CUES[kind][0])), F.rlike(before, F.lit(CUES[kind][1]))).alias("context"),
        F.when(F.rlike(sides, F.lit(r"[\p{L}\p{N}]")), F.lit(-1)).otherwise(F.lit(1)).alias("bounds"),
        F.when(size < 12, 0).when(size < 24, 1).otherwise(2).alias("length"),
        _hashed(kind, value, before, after).alias("hashed"),
    )


def _annotated(docs: DataFrame, text_col: str, carry: list[str]) -> DataFrame:
    text = F.col("__text")
    found = docs.withColumn("__text", F.coalesce(F.col(text_col).cast("string"), F.lit("")))
    found = found.select(*[F.col(f"`{c}`") for c in carry], "__text",
                         *[c.alias(f"__m_{k}") for k, c in base_matches(text).items()],
                         *[c.alias(f"__l_{k}") for k, c in loose_matches(text).items()])

    def valid(kind):
        return F.filter(f"__m_{kind}", lambda s: _valid(kind, s["value"]))

    def votes(kind):
        return F.concat(
            F.transform(f"__m_{kind}", lambda s: _candidate(kind, text, s, F.when(_valid(kind, s["value"]), 1).otherwise(-1))),
            F.transform(S.outside(F.col(f"__l_{kind}"), every), lambda s: _candidate(kind, text, s, F.lit(0))))

    def bare(kind):
        return F.transform(f"__{kind}", lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end")))

    found = found.select("*", *[valid(k).alias(f"__{k}") for k in KINDS])
    every = F.concat(*[F.col(f"__{k}") for k in KINDS])
    return found.select(*[F.col(f"`{c}`") for c in carry], *[bare(k).alias(f"__{k}") for k in KINDS],
                        F.concat(*[votes(k) for k in KINDS]).alias("__votes"))


def reliabilities(patterns: list[tuple]) -> list[float]:
    """EM for one kind over (count, votes): the posterior of each pattern.

    The two-class latent model has one distribution over {+1, -1, 0} for each
    labeler and class, started (and smoothed) at "mostly right".
    """
    right = {"form": 0.95, "gazetteer": 0.8, "context": 0.8, "bounds": 0.6}
    prior = {(j, y, v): (0.5 if v == 0 else 0.5 * (right[name] if (v > 0) == bool(y) else 1 - right[name]))
             for j, name in enumerate(LABELERS) for y in (0, 1) for v in (-1, 0, 1)}
    theta, share, post = dict(prior), 0.5, []
    for _ in range(ROUNDS):
        post = []
        for _, votes in patterns:
            p = [1 - share, share]
            for y in (0, 1):
                for j, v in enumerate(votes):
                    p[y] *= theta[j, y, v]
            post.append(p[1] / (p[0] + p[1]))
        mass = [sum(n * ((1 - q), q)[y] for (n, _), q in zip(patterns, post)) for y in (0, 1)]
        share = (mass[1] + 1) / (mass[0] + mass[1] + 2)
        smooth = 20.0
        theta = {k: smooth * prior[k] for k in prior}
        for (n, votes), q in zip(patterns, post):
            for j, v in enumerate(votes):
                theta[j, 0, v] += n * (1 - q)
                theta[j, 1, v] += n * q
        theta = {(j, y, v): t / (mass[y] + smooth) for (j, y, v), t in theta.items()}
    return post


def _features(kind: str, votes: tuple, length: int) -> list[str]:
    return ["bias", f"kind={kind}", f"length={length}"] + [f"{n}={v}" for n, v in zip(LABELERS, votes) if v]


def posteriors(counts: list[tuple]) -> dict[tuple, float]:
    """EM's posterior of each (kind, votes) among (kind, votes, count) rows, each pair once."""
    out = {}
    for kind in KINDS:
        own = [(n, votes) for k, votes, n in counts if k == kind]
        out.update({(kind, votes): q for (_, votes), q in zip(own, reliabilities(own) if own else [])})
    return out


def fit_classifier(rows: list[tuple], post: dict[tuple, float], steps: int = 300, rate: float = 4.0,
                   shrink: float = 1e-3) -> tuple[dict[str, float], list[float]]:
    """Logistic weights (by name, by bucket) fitted to the posteriors of (kind, votes, length, buckets) rows."""
    names = [_features(kind, votes, length) for kind, votes, length, _ in rows]
    place = {f: BUCKETS + i for i, f in enumerate(sorted({f for own in names for f in own}))}
    at = [[place[f] for f in own] + list(r[3]) for own, r in zip(names, rows)]
    size = np.array([len(x) for x in at], dtype=np.int64)
    row, col = np.repeat(np.arange(len(at)), size), np.array([i for x in at for i in x], dtype=np.int64)
    value = 1.0 / np.sqrt(size)[row]  # rows of equal length, so that one step size suits all
    want, weights = np.array([post[r[0], r[1]] for r in rows]), np.zeros(BUCKETS + len(place))
    for _ in range(steps if rows else 0):
        z = np.bincount(row, value * weights[col], minlength=len(at))
        error = want - 1 / (1 + np.exp(-z))
        weights += rate * (np.bincount(col, value * error[row], minlength=len(weights)) / len(at) - shrink * weights)
    return {f: float(weights[i]) for f, i in place.items()}, [float(w) for w in weights[:BUCKETS]]


def _score(v: Column, named: dict[str, float], buckets: list[float]) -> Column:
    """The classifier's probability of a candidate."""
    table = F.split(F.lit(",".join(map(repr, buckets))), ",").cast("array<double>")
    z, size = F.lit(named.get("bias", 0.0)), F.lit(3) + F.size(v["hashed"])
    for f, w in sorted(named.items()):
        if f != "bias":
            name, value = f.split("=")
            z = z + F.when(v[name] == (value if name == "kind" else int(value)), w).otherwise(0.0)
    for n in LABELERS:
        size = size + F.abs(v[n])
    z = F.aggregate(v["hashed"], z, lambda total, b: total + F.get(table, b))
    return 1 / (1 + F.exp(-z / F.sqrt(size)))


def find_personal_data(docs: DataFrame, threshold: float = THRESHOLD, text_col: str = "text",
                       carry: list[str] | None = None) -> DataFrame:
    """The columns of ``carry`` (all by default) with ``n_<kind>`` (base spans), ``base_sha256``,
    ``spans`` (all, as kind:start:end) and ``found`` (array of kind, start, end, sorted by start)."""
    carry = docs.columns if carry is None else carry
    rows = stage(_annotated(docs, text_col, carry), "pii-votes")
    seen = rows.select(F.explode("__votes").alias("v")).select("v.kind", *[f"v.{n}" for n in LABELERS], "v.length", "v.hashed")
    counts = seen.groupBy("kind", *LABELERS).count().collect()  # one row per vote pattern
    counts = sorted((r["kind"], tuple(r[n] for n in LABELERS), r["count"]) for r in counts)
    total = sum(n for *_, n in counts)
    if total:
        share = int(min(1.0, TRAIN_SPANS / total) * (1 << 30))
        fit_on = seen.filter(F.pmod(F.xxhash64(*seen.columns), F.lit(1 << 30)) < share).distinct().collect()  # about TRAIN_SPANS at most
        fit_on = sorted((r["kind"], tuple(r[n] for n in LABELERS), r["length"], tuple(r["hashed"])) for r in fit_on)
        named, buckets = fit_classifier(fit_on, posteriors(counts))
        added = F.filter("__votes", lambda v: (v["form"] == 0) & (_score(v, named, buckets) >= threshold))
    else:
        added = F.filter("__votes", lambda v: F.lit(False))
    rows = rows.withColumn("__added", added)

    def own(kind):
        return F.transform(F.filter("__added", lambda v: v["kind"] == kind),
                           lambda v: F.struct(v["start"].alias("start"), v["end"].alias("end")))

    every = {k: F.sort_array(F.concat(F.col(f"__{k}"), own(k))) for k in KINDS}

    def labelled(kind, spans):
        return F.transform(spans, lambda x: F.struct(x["start"].alias("start"), x["end"].alias("end"), F.lit(kind).alias("kind")))

    found = F.sort_array(F.concat(*[labelled(k, s) for k, s in every.items()]))
    return attach(rows, {
        **{f"n_{k}": F.size(f"__{k}").cast("long") for k in KINDS},
        "base_sha256": F.sha2(S.listing({k: F.col(f"__{k}") for k in KINDS}), 256),
        "spans": S.listing(every),
        "found": found,
    })


def disjoint(found: Column) -> Column:
    """Overlapping spans merged into one, which keeps the first one's kind."""
    def merge(done, s):
        last = F.get(done, F.size(done) - 1)
        joined = F.struct(last["start"].alias("start"), F.greatest(last["end"], s["end"]).alias("end"), last["kind"].alias("kind"))
        return F.when((F.size(done) > 0) & (s["start"] < last["end"]), F.concat(
            F.slice(done, F.lit(1), F.size(done) - 1), F.array(joined))).otherwise(F.concat(done, F.array(s)))

    return F.aggregate(found, F.array().cast("array<struct<start:int,end:int,kind:string>>"), merge)


def redact_documents(docs: DataFrame, text_col: str = "text", length_col: str = "n_chars") -> DataFrame:
    """The documents with every span replaced by its kind in angle brackets, and the length column
    (where there is one) counted anew. Null text stays null."""
    found = _found(docs, text_col)
    tagged = F.transform(disjoint(F.col("__found")), lambda s: F.struct(
        s["start"].alias("start"), s["end"].alias("end"), F.concat(F.lit("<"), F.upper(s["kind"]), F.lit(">")).alias("tag")))
    out = found.withColumn("__new", S.redact(F.col(text_col), tagged))
    values = {text_col: F.col("__new")}
    if length_col in docs.columns:
        values[length_col] = F.when(F.col(text_col).isNull(), F.col(length_col)).otherwise(F.length("__new")).cast(
            docs.schema[length_col].dataType)
    return out.select(*[values.get(c, F.col(f"`{c}`")).alias(c) for c in docs.columns])


def _found(docs: DataFrame, text_col: str) -> DataFrame:
    out = find_personal_data(docs.select(*[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(docs.columns)]),
                             text_col=f"c{docs.columns.index(text_col)}")
    return out.select(*[F.col(f"c{i}").alias(c) for i, c in enumerate(docs.columns)], F.col("found").alias("__found"))
