"""Personal data by weak supervision.

One pass over the texts finds base spans (fixed patterns) and further
candidate spans, and lets five labelers vote on each: shape (a stricter
pattern or checksum), gazetteer (names, calling codes, domains, issuers),
cue words before the span, contrary cue words, and the characters that touch
it.  Equal vote patterns are counted by Spark over all texts; expectation-
maximisation on that bounded table (kinds x 3^5 votes x 12 shapes) estimates
each labeler's reliability and the probability that a pattern is personal
data.  Those probabilities train a logistic span classifier, which is then
applied to every candidate as a column expression.

Defined results: a null text counts as empty; empty texts have no spans; rows
are independent, so repeated rows and ids give repeated results; other
columns pass through untouched unless their names clash with an output
column, in which case the output column replaces them.  An empty table gives
an empty result.  Base spans are always kept; the classifier only adds.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import WorkTables

BASE_KINDS = ["email", "ip", "card", "phone"]
KINDS = BASE_KINDS + ["email_obfuscated", "phone_national", "national_id", "iban", "name"]
RANK = {k: i for i, k in enumerate(KINDS)}
LABELERS = ["shape", "gazetteer", "cue", "contrary", "edges"]

WEIGHT = 10.0  # of the opinion about labelers and shares before any vote
THRESHOLD = 0.7  # a span without any vote stays out

CANDIDATES = ("array<struct<kind:string,start:int,end:int,base:boolean,votes:string,"
              "form:string>>")

LOCAL_PART = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
DOTTED = re.compile(r"[0-9]+(?:\.[0-9]+)*")
CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")

OBFUSCATED = re.compile(r"([A-Za-z0-9._%+-]{1,64}) ?[\[({]at[\])}] ?([A-Za-z0-9-]+(?:(?: ?[\[({]dot[\])}] ?|\.)[A-Za-z0-9-]+)+)")
NATIONAL = re.compile(r"(?:\([0-9]{2,5}\) ?[0-9]{3,4}|[0-9]{3}[ .-][0-9]{3})[ .-][0-9]{4}")
NATIONAL_ID = re.compile(r"[0-9]{3}-[0-9]{2}-[0-9]{4}")
IBAN = re.compile(r"[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?")
NAME = re.compile(r"[A-Z][a-z]+ [A-Z][a-z]+")

# Gazetteers: fixed values.
GIVEN_NAMES = frozenset((
    "Ada Adam Alan Alice Ana Andrea Andrew Anna Anne Anthony Barbara Ben Carlos Carol Carmen "
    "Charles Charlotte Christine Claire Claudia Daniel David Deborah Diana Diego Elena Elizabeth "
    "Emily Emma Eric Erik Eva Felix Francisco Frank Franz George Hannah Hans Helen Henry Ines "
    "Isabel Jacques James Jane Javier Jean Jennifer Jessica John Jonas Jorge Jose Joseph Juan "
    "Julia Karen Karl Katharina Kevin Klaus Laura Linda Lisa Louis Lucia Luis Lukas Marco Maria "
    "Marie Mark Martin Mary Michael Michel Miguel Monika Nancy Nicolas Olivia Patricia Paul Pedro "
    "Peter Philippe Pierre Rachel Richard Robert Sandra Sarah Sofia Sophie Stefan Stephen Susan "
    "Thomas Ursula Victor William Wolfgang").split())
CALLING_CODES = frozenset((
    "1 7 20 27 30 31 32 33 34 36 39 40 41 43 44 45 46 47 48 49 51 52 54 55 56 57 60 61 62 63 64 "
    "65 66 81 82 84 86 90 91 92 94 98 212 213 234 254 351 352 353 358 380 420 421 852 966 971 "
    "972").split())
DOMAIN_ENDS = frozenset((
    "com org net edu gov io co info biz de fr es it uk us eu ch at nl be se no dk fi pl pt br ar "
    "mx cl ca au nz in jp cn kr ru za ie test example").split())

# Cue words: fixed values, searched in the 32 characters before a span.
CUES = {
    "email": ("mail", "contact", "write", "reach", "kontakt", "correo", "courriel"),
    "ip": ("ip", "address", "host", "server", "from", "login", "client"),
    "card": ("card", "visa", "credit", "payment", "karte", "tarjeta", "carte"),
    "phone": ("call", "phone", "tel", "mobile", "fax", "dial", "telefon"),
    "name": ("name", "mr", "mrs", "ms", "dr", "by", "dear", "herr", "frau", "madame"),
    "id": ("ssn", "social", "passport", "national", "ausweis", "dni"),
    "iban": ("iban", "account", "bank", "konto", "cuenta", "compte"),
}
CUE_OF = {"email_obfuscated": "email", "phone_national": "phone", "national_id": "id"}
CONTRARY = ("version", "isbn", "order", "invoice", "release", "chapter", "section", "model",
            "part", "figure", "page")
WORD = re.compile(r"[^\W\d_]+")
PRIVATE = ("10.", "127.", "0.", "192.168.", "169.254.", "255.")


def luhn(digits: str) -> bool:
    total = 0
    for i, ch in enumerate(reversed(digits)):
        n = ord(ch) - 48
        if i % 2:
            n = n * 2 - 9 * (n > 4)
        total += n
    return total % 10 == 0


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """Fixed patterns, leftmost and non-overlapping per kind, in linear time.

    An address is found from its ``@``: its local part is the run of allowed
    characters before it, back to the previous match.  Dotted digit runs are
    cut into groups of four parts, which is what matching from the left gives.
    """
    found = []
    if "@" in text:
        last = 0
        for m in DOMAIN.finditer(text):
            start = at = m.start()
            while start > last and text[start - 1] in LOCAL_PART:
                start -= 1
            if start < at:
                last = m.end()
                found.append(("email", start, last))
    if "." in text:
        for m in DOTTED.finditer(text):
            if m.group().count(".") >= 3:
                at, parts = m.start(), m.group().split(".")
                for i in range(0, len(parts) - 3, 4):
                    four = parts[i:i + 4]
                    end = at + sum(map(len, four)) + 3
                    if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255
                           for p in four):
                        found.append(("ip", at, end))
                    at = end + 1
    for m in CARD.finditer(text):
        if m.end() - m.start() >= 12:
            digits = m.group().replace(" ", "").replace("-", "")
            if 12 <= len(digits) <= 19 and luhn(digits):
                found.append(("card", m.start(), m.end()))
    if "+" in text:
        for m in PHONE.finditer(text):
            if 9 <= sum(map(str.isdigit, m.group())) <= 15:
                found.append(("phone", m.start(), m.end()))
    return found


def more_spans(text: str, base: list[tuple[str, int, int]]) -> list[tuple[str, int, int]]:
    """Candidates that only the classifier can admit; none overlaps a base span."""
    found = []
    if "at" in text and ("(at" in text or "[at" in text or "{at" in text):
        found += [("email_obfuscated", *m.span()) for m in OBFUSCATED.finditer(text)]
    found += [("phone_national", *m.span()) for m in NATIONAL.finditer(text)]
    if "-" in text:
        found += [("national_id", *m.span()) for m in NATIONAL_ID.finditer(text)]
    found += [("iban", *m.span()) for m in IBAN.finditer(text)]
    found += [("name", *m.span()) for m in NAME.finditer(text)]
    out, taken = [], sorted((s, e) for _, s, e in base)
    i = 0
    for kind, s, e in sorted(found, key=lambda x: (x[1], RANK[x[0]])):
        while i < len(taken) and taken[i][1] <= s and i + 1 < len(taken):
            i += 1
        near = taken[max(0, i - 1):i + 2]
        if not any(s < b and a < e for a, b in near):
            out.append((kind, s, e))
    return out


def shape_vote(kind: str, span: str) -> int:
    digits = re.sub("[^0-9]", "", span)
    if kind == "email":
        local, _, domain = span.rpartition("@")
        return 1 if local[0] not in ".-" and domain.rpartition(".")[2].isalpha() else -1
    if kind == "ip":
        return 1 if all(p == "0" or p[0] != "0" for p in span.split(".")) else -1
    if kind == "card":
        return 1 if len(digits) in (14, 15, 16) and len(set(digits)) > 2 else -1
    if kind == "phone":
        return 1 if span.count("(") == span.count(")") else -1
    if kind == "iban":
        packed = span.replace(" ", "")
        value = "".join(str(int(c, 36)) for c in packed[4:] + packed[:4])
        return 1 if int(value) % 97 == 1 else -1
    if kind == "national_id":
        return -1 if digits[:3] in ("000", "666") or digits[3:5] == "00" else 0
    if kind == "name":
        return 0
    return 1 if kind == "email_obfuscated" else 0


def gazetteer_vote(kind: str, span: str) -> int:
    if kind in ("email", "email_obfuscated"):
        return 1 if re.split(r"[^A-Za-z0-9-]+", span.rstrip("])}"))[-1].lower() in DOMAIN_ENDS else -1
    if kind == "phone":
        digits = re.sub("[^0-9]", "", span)
        return 1 if any(digits[:n] in CALLING_CODES for n in (1, 2, 3)) else -1
    if kind == "ip":
        return -1 if span.startswith(PRIVATE) else 1
    if kind == "card":
        return 1 if span[0] in "3456" else -1
    if kind == "name":
        return 1 if span.split(" ")[0] in GIVEN_NAMES else -1
    return 0


def votes(text: str, kind: str, s: int, e: int) -> tuple[str, str]:
    """Five votes as characters +, 0, -, and the span's form (length and digit share)."""
    span = text[s:e]
    before = {w.lower() for w in WORD.findall(text[max(0, s - 32):s])}
    cues = CUES[CUE_OF.get(kind, kind)]
    edge = (s and text[s - 1].isalnum()) or (e < len(text) and text[e].isalnum())
    cast = (shape_vote(kind, span), gazetteer_vote(kind, span),
            1 if any(c in before or c + "s" in before for c in cues) else 0,
            -1 if any(c in before for c in CONTRARY) else 0, -1 if edge else 0)
    share = sum(map(str.isdigit, span)) / (e - s)
    return "".join("-0+"[v + 1] for v in cast), f"{min(3, (e - s) // 8)}{int(share * 2.99)}"


def candidates_of(text: str | None) -> list[dict]:
    text = text or ""
    base = base_spans(text)
    spans = [(*x, True) for x in base] + [(*x, False) for x in more_spans(text, base)]
    out = []
    for kind, s, e, fixed in sorted(spans, key=lambda x: (x[1], RANK[x[0]])):
        cast, form = votes(text, kind, s, e)
        out.append({"kind": kind, "start": s, "end": e, "base": fixed, "votes": cast,
                    "form": form})
    return out


def find_candidates(docs: DataFrame, keep: list[str], text: str = "text") -> DataFrame:
    """``keep`` columns and ``candidates``; one streaming pass over the texts."""
    kept = docs.select(*keep, F.col(text).cast("string").alias("_text"))
    schema = docs.select(*keep, F.lit(None).cast(CANDIDATES).alias("candidates")).schema
    kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32()),
                               ("base", pa.bool_()), ("votes", pa.string()),
                               ("form", pa.string())]))

    def scan(batches):
        for b in batches:
            found = [candidates_of(t.as_py()) for t in b.column(len(keep))]
            yield pa.RecordBatch.from_arrays(
                [*[b.column(i) for i in range(len(keep))], pa.array(found, kind)],
                names=[*keep, "candidates"])

    return kept.mapInArrow(scan, schema)


def estimate(patterns: list[tuple[str, str, int]], rounds: int = 60) -> tuple[dict, dict]:
    """Expectation-maximisation over counted (kind, votes) patterns.

    Each labeler has one reliability for all kinds, so a kind whose candidates
    only ever draw contrary votes is judged by what such votes mean elsewhere;
    each kind has its own share of personal data.  Returns the probability of
    each pattern and each labeler's reliability.  Labelers are better than
    chance to begin with; that opinion weighs as much as ``WEIGHT`` votes.
    """
    if not patterns:
        return {}, {}
    kinds = sorted({k for k, _, _ in patterns})
    kind = np.array([kinds.index(k) for k, _, _ in patterns])
    n = np.array([x for _, _, x in patterns], float)
    cast = np.array([["-0+".index(c) - 1 for c in v] for _, v, _ in patterns])
    voted, favour = cast != 0, cast > 0
    opinion = np.array([.2, .8])  # how often a labeler that votes is in favour, of class no and of class yes
    given = np.repeat(opinion[:, None], cast.shape[1], 1)
    prior = np.full(len(kinds), .5)
    # a kind's count of patterns must not drown the others': each kind weighs by its square root
    weight = n * (1 / np.sqrt(np.bincount(kind, n)))[kind]
    for _ in range(rounds):
        # silence says nothing; a vote counts by how much likelier it is in one class
        lean = np.where(voted, np.where(favour, np.log(given[1] / given[0]), np.log((1 - given[1]) / (1 - given[0]))), 0)
        yes = 1 / (1 + np.exp(-np.clip(np.log(prior / (1 - prior))[kind] + lean.sum(1), -50, 50)))
        prior = np.clip((np.bincount(kind, n * yes) + WEIGHT / 2) / (np.bincount(kind, n) + WEIGHT), .05, .95)
        for c, w in ((0, weight * (1 - yes)), (1, weight * yes)):
            given[c] = (((voted & favour) * w[:, None]).sum(0) + opinion[c] * WEIGHT) / ((voted * w[:, None]).sum(0) + WEIGHT)
    prob = {(k, v): float(p) for (k, v, _), p in zip(patterns, yes, strict=True)}
    return prob, {name: float(given[1, i] / (given[1, i] + given[0, i])) for i, name in enumerate(LABELERS)}


def feature_names(kind: str, cast: str, form: str) -> list[str]:
    return ["bias", f"kind={kind}", f"length={form[0]}", f"digits={form[1]}",
            *[f"{name}{c}" for name, c in zip(LABELERS, cast, strict=True) if c != "0"]]


def train(rows: list[tuple[str, str, str, int]], prob: dict, steps: int = 400) -> dict[str, float]:
    """Logistic regression on pattern counts with the estimated probabilities as labels."""
    names = sorted({f for k, v, s, _ in rows for f in feature_names(k, v, s)} | {"bias"})
    at = {f: i for i, f in enumerate(names)}
    x = np.zeros((len(rows), len(names)))
    for i, (k, v, s, _) in enumerate(rows):
        x[i, [at[f] for f in feature_names(k, v, s)]] = 1
    y = np.array([prob[k, v] for k, v, _, _ in rows])
    n = np.array([c for *_, c in rows], float)
    n = np.sqrt(n) / max(1.0, np.sqrt(n).sum())  # frequent patterns count more, but do not drown rare ones
    w = np.zeros(len(names))
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        h = (x * (n * np.maximum(p * (1 - p), 1e-4))[:, None]).T @ x + 1e-3 * np.eye(len(names))
        step = np.linalg.solve(h, x.T @ (n * (p - y)) + 1e-3 * w)
        w -= step
        if np.abs(step).max() < 1e-8:
            break
    return dict(zip(names, map(float, w), strict=True))


def probability(c: Column, weights: dict[str, float]) -> Column:
    """The classifier as a column expression over one candidate struct."""
    table = F.create_map(*[F.lit(x) for k, v in sorted(weights.items()) for x in (k, v)])

    def weight(name: Column) -> Column:
        return F.coalesce(F.try_element_at(table, name), F.lit(0.0))

    z = (weight(F.lit("bias")) + weight(F.concat(F.lit("kind="), c["kind"]))
         + weight(F.concat(F.lit("length="), F.substring(c["form"], 1, 1)))
         + weight(F.concat(F.lit("digits="), F.substring(c["form"], 2, 1))))
    for i, name in enumerate(LABELERS):
        z = z + weight(F.concat(F.lit(name), F.substring(c["votes"], i + 1, 1)))
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-z))


def joined(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda c: F.concat_ws(":", c["kind"], c["start"], c["end"])), ",")


def find_pii(docs: DataFrame, keep: list[str], text: str = "text",
             threshold: float = THRESHOLD) -> DataFrame:
    """``keep`` columns, ``base`` and ``found`` (all spans, by start then kind)."""
    tables = WorkTables(docs.sparkSession, "pii")
    kept = tables.keep(find_candidates(docs, keep, text), "candidates")
    counted = (kept.select(F.explode("candidates").alias("c"))
               .groupBy("c.kind", "c.votes", "c.form").agg(F.count(F.lit(1)).alias("n")))
    rows = [tuple(r) for r in counted.collect()]  # at most kinds x 3^5 x 12 patterns
    by_votes: dict[tuple[str, str], int] = {}
    for k, v, _, n in rows:
        by_votes[k, v] = by_votes.get((k, v), 0) + n
    prob, _ = estimate(sorted((k, v, n) for (k, v), n in by_votes.items()))
    weights = train(sorted(rows), prob) if rows else {"bias": 0.0}
    return kept.select(
        *keep, F.filter("candidates", lambda c: c["base"]).alias("base"),
        F.filter("candidates", lambda c: c["base"] | (probability(c, weights) >= threshold))
        .alias("found"))


def pii_report(docs: DataFrame) -> DataFrame:
    """The digest columns of the registered query."""
    spans = find_pii(docs, ["doc_id"])

    def count(kind: str) -> Column:
        return F.size(F.filter("base", lambda c: c["kind"] == kind)).cast("long").alias(f"n_{kind}")

    return spans.select(
        "doc_id", *map(count, BASE_KINDS), F.sha2(joined(F.col("base")), 256).alias("base_sha256"),
        joined(F.col("found")).alias("spans"),
        (F.size("found") - F.size("base")).cast("long").alias("n_added"))
