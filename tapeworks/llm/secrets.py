"""Secret scan: fixed patterns plus sliding-window entropy, in DataFrame functions only.

Base spans come from three fixed patterns.  Beyond them every long run of
key-like characters that mixes letters and digits is a candidate.  A window
of ``WINDOW`` characters slides over the candidate; the counts of its
characters, and from them the sum of c*log2(c), are updated for the one
character that enters and the one that leaves, so each step costs the
alphabet, wherever in the run it is: a run of a megabyte takes as long a
character as a short one, and the scan ends at the first window that reaches
the limit.  The highest entropy of any window is held
against the threshold of the candidate's character class: hexadecimal, digits
with letters of one case, digits with letters of both cases, or words and
numbers (slugs, paths, camel case), which come near to keys in entropy.  Allow-listed candidates (UUIDs, integrity digests, paths
of words, addresses after "://") are suppressed; a placeholder word suppresses
only windows that reach within ``WINDOW`` characters of it.

Positions need no UDF: the texts between matches (``split``) and the matches
(``regexp_extract_all``) alternate, so running sums of their lengths are the
match positions, in code points.

Defined results: a null text counts as empty; empty texts have no spans; rows
are independent, so repeated rows give repeated results and an empty table an
empty one; only the asked columns pass through.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BASE_KINDS = ["assign", "access", "hex"]
KINDS = BASE_KINDS + ["entropy_hex", "entropy_mixed"]

ASSIGN = (r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?"""
          r"([A-Za-z0-9+/_.=-]+)")
#: Shorter runs of these two can't count, and a longer run starts at the same place either way.
ACCESS = "AKIA[A-Z0-9]{16,}"
HEX = "[0-9a-f]{24,}"
CANDIDATE = "[A-Za-z0-9+/_=-]{20,}"
MIN_VALUE = 6

WINDOW = 20
ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-"
PIECE = 512
#: Bits by kind; runs of words and numbers are held to the mixed one.
THRESHOLDS = {"entropy_hex": 3.05, "entropy_mixed": 4.05}
#: Bits that 99 % of random windows reach: base32 (digits with one case), base62 (with both cases).
ONE_CASE, BOTH_CASES = 3.34, 3.64
#: Words and numbers are what remains between these.
WORD_ENDS, WORD = r"[+/_=-]+|(?<=[a-z0-9])(?=[A-Z])", r"^(?:[A-Z]?[a-z]+[0-9]{0,4}|[A-Z]*|[0-9]+)$"

# Allow-list: fixed values, sought in a candidate without regard to case.
#: Placeholder words, which excuse what is near them.
ALLOWED_WORDS = "example|sample|dummy|changeme|placeholder|your[_-]|xxxx|0123456789|1234567890|abcdefgh"
NEAR = f"[^ ]{{0,{WINDOW}}} [^ ]{{0,{WINDOW}}}"
#: Forms that excuse a whole run.
ALLOWED_FORMS = "^[0-9a-f]{8}(-[0-9a-f]{4}){3}-[0-9a-f]{12}$|^sha(1|256|384|512)-"

SPAN = "array<struct<start:int,rank:int,end:int,kind:string,value:string>>"


def spans_of(text: Column, pattern: str, kind: str) -> Column:
    """All matches of ``pattern`` with their positions."""
    rank = KINDS.index(kind) if kind in KINDS else len(KINDS)
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))

    def placed(matches: Column) -> Column:
        pairs = F.zip_with(matches, F.slice(F.split(text, pattern, -1), 1, F.size(matches)),
                           lambda m, gap: F.struct(m.alias("m"), F.length(gap).alias("gap")))

        def step(acc: Column, x: Column) -> Column:
            start = acc["at"] + x["gap"]
            end = start + F.length(x["m"])
            return F.struct(end.alias("at"), F.array_append(acc["out"], F.struct(
                start.alias("start"), F.lit(rank).alias("rank"), end.alias("end"),
                F.lit(kind).alias("kind"), x["m"].alias("value"))).alias("out"))

        return F.aggregate(
            pairs, F.struct(F.lit(0).alias("at"), F.array().cast(SPAN).alias("out")), step,
            lambda acc: acc["out"])

    # one element holding the matches: the scan runs once, the split only where something matched
    return F.flatten(F.transform(
        F.array(found), lambda m: F.when(F.size(m) > 0, placed(m)).otherwise(F.array().cast(SPAN))))


def window_entropy(value: Column, width: int = WINDOW) -> Column:
    """Highest Shannon entropy (bits) of any ``width`` characters in a row, by incremental counts."""
    weight = F.array(*[F.lit(0.0)] + [F.lit(float(c)) * F.log2(F.lit(float(c))) for c in range(1, width + 1)])

    def of(c: Column) -> Column:
        return F.get(weight, c)

    def step(acc: Column, x: Column) -> Column:
        enter, leave = x["enter"], x["leave"]
        gone = F.when(leave >= 0, F.get(acc["n"], leave))
        less = F.coalesce(of(gone) - of(gone - 1), F.lit(0.0))
        held = F.get(acc["n"], enter) - F.when(enter == leave, 1).otherwise(0)
        total = acc["total"] - less + of(held + 1) - of(held)
        counts = F.transform(acc["n"], lambda c, k: c + F.when(k == enter, 1).otherwise(0)
                             - F.when(k == leave, 1).otherwise(0))
        return F.struct(counts.alias("n"), total.alias("total"), (acc["seen"] + 1).alias("seen"),
                        F.when(acc["seen"] + 1 >= width, F.least(acc["low"], total)).otherwise(acc["low"]).alias("low"))

    def moves(codes: Column) -> Column:
        """What enters and what leaves at each step."""
        late = F.slice(F.concat(F.array_repeat(F.lit(-1), width), codes), F.lit(1), F.size(codes))
        return F.zip_with(codes, late, lambda e, x: F.struct(e.alias("enter"), x.alias("leave")))

    # the text is cut into characters once; finding one by its place would walk from the start each time
    codes = F.transform(F.split(value, ""), lambda c: F.instr(F.lit(ALPHABET), c) - 1)
    first = F.struct(F.array_repeat(F.lit(0), len(ALPHABET)).alias("n"), F.lit(0.0).alias("total"), F.lit(0).alias("seen"),
                     F.lit(float("inf")).alias("low"))
    return F.aggregate(F.transform(F.array(codes), moves)[0], first, step,
                       lambda acc: F.log2(F.lit(float(width))) - acc["low"] / width)


def reaches(value: Column, limit: Column) -> Column:
    """True if a window of the value has the entropy; pieces overlap by a window, and the first hit ends the scan."""
    pieces = F.regexp_extract_all(value, F.lit(f"(?=(.{{1,{PIECE + WINDOW - 1}}})).{{1,{PIECE}}}"), F.lit(1))
    return F.exists(pieces, lambda p: (F.length(p) >= WINDOW) & (window_entropy(p) >= limit))


def allowed(value: Column, before: Column) -> Column:
    """Runs that are no secret as a whole; ``before`` is the character in front of the run."""
    path = (value.startswith("/") | value.contains("//")) & worded(value) & value.rlike("[A-Za-z0-9]/+[A-Za-z0-9]")
    return F.lower(value).rlike(ALLOWED_FORMS) | path | (value.startswith("//") & (before == ":"))


def hot_parts(value: Column, limit: Column) -> Column:
    """(hot, free): whether a window reaches the limit anywhere, and away from placeholder words."""
    marked = F.regexp_replace(value, f"(?i){ALLOWED_WORDS}", " ")
    placeholder = value.rlike(f"(?i){ALLOWED_WORDS}")

    def judged(least: Column) -> Column:
        free = F.exists(F.split(marked, NEAR, -1), lambda part: reaches(part, least))
        return F.transform(F.array(free), lambda f: F.struct(
            (f | (placeholder & reaches(value, least))).alias("hot"), f.alias("free")))[0]

    return F.transform(F.array(limit), judged)[0]  # the limit is worked out once


def worded(value: Column) -> Column:
    """Only words and numbers, as in slugs, paths and camel case."""
    return F.forall(F.split(value, WORD_ENDS, -1), lambda w: w.rlike(WORD))


def limit_of(value: Column) -> Column:
    """The entropy that the candidate's character class asks for."""
    return (F.when(value.rlike("^[0-9A-Fa-f]+$"), THRESHOLDS["entropy_hex"])
            .when(worded(value), THRESHOLDS["entropy_mixed"])
            .when(value.rlike("[a-z]") & value.rlike("[A-Z]"), BOTH_CASES).otherwise(ONE_CASE))


def find_secrets(docs: DataFrame, keep: list[str], text: str = "text") -> DataFrame:
    """``keep`` columns, the text (null: empty) as ``_text``, ``base``, ``found`` (all
    spans in order of start, then kind) and ``suppressed`` (allow-listed candidates)."""
    t = F.coalesce(F.col(text).cast("string"), F.lit(""))
    raw = docs.select(*keep, t.alias("_text"))
    scanned = raw.select(
        "*", spans_of(F.col("_text"), ASSIGN, "assign").alias("_assign"),
        spans_of(F.col("_text"), ACCESS, "access").alias("_access"),
        spans_of(F.col("_text"), HEX, "hex").alias("_hex"),
        F.filter(spans_of(F.col("_text"), CANDIDATE, "entropy_mixed"),
                 lambda s: s["value"].rlike("[0-9]") & s["value"].rlike("[A-Za-z]")).alias("_runs"))
    real = F.filter("_assign", lambda s: F.length(F.regexp_extract(s["value"], ASSIGN, 2)) >= MIN_VALUE)
    based = scanned.select(*keep, "_text", "_runs", F.array_sort(
        F.concat(real, "_access", "_hex")).alias("base"))
    fresh = based.select(*keep, "_text", "base", F.filter("_runs", lambda s: ~F.exists(
        "base", lambda b: (b["start"] < s["end"]) & (s["start"] < b["end"]))).alias("_runs"))

    def judged(s: Column) -> Column:
        is_hex = s["value"].rlike("^[0-9A-Fa-f]+$")
        kind = F.when(is_hex, "entropy_hex").otherwise("entropy_mixed")
        return F.struct(
            s["start"].alias("start"), F.when(is_hex, KINDS.index("entropy_hex"))
            .otherwise(KINDS.index("entropy_mixed")).alias("rank"), s["end"].alias("end"),
            kind.alias("kind"), s["value"].alias("value"),
            hot_parts(s["value"], limit_of(s["value"])).alias("hot"),
            allowed(s["value"], F.substring(F.col("_text"), s["start"], F.lit(1))).alias("ok"))

    tried = fresh.select(*keep, "_text", "base", F.filter(
        F.transform("_runs", judged), lambda s: s["hot"]["hot"]).alias("_hot"))
    extra = F.transform(F.filter("_hot", lambda s: s["hot"]["free"] & ~s["ok"]), lambda s: F.struct(
        *[s[f].alias(f) for f in ("start", "rank", "end", "kind", "value")]))
    return tried.select(
        *keep, "_text", "base", F.array_sort(F.concat("base", extra)).alias("found"),
        F.size(F.filter("_hot", lambda s: s["ok"] | ~s["hot"]["free"])).cast("long").alias("suppressed"))


def redacted(text: Column, spans: Column, mark: str = "[SECRET]") -> Column:
    """The text with every span, or run of overlapping spans, replaced by ``mark``."""
    def step(acc: Column, s: Column) -> Column:
        fresh = s["start"] >= acc["at"]
        piece = F.concat(F.substring(text, acc["at"] + 1, s["start"] - acc["at"]), F.lit(mark))
        return F.struct(F.greatest(acc["at"], s["end"]).alias("at"),
                        F.when(fresh, F.array_append(acc["out"], piece)).otherwise(acc["out"]).alias("out"))

    return F.aggregate(
        spans, F.struct(F.lit(0).alias("at"), F.array().cast("array<string>").alias("out")), step,
        lambda acc: F.concat(F.array_join(acc["out"], ""),
                             F.substring(text, acc["at"] + 1, F.length(text))))


def joined(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def secret_report(docs: DataFrame) -> DataFrame:
    """The digest columns of the registered query."""
    def count(kind: str) -> Column:
        return F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    return find_secrets(docs, ["doc_id"]).select(
        "doc_id", *map(count, BASE_KINDS), F.sha2(joined(F.col("base")), 256).alias("base_sha256"),
        joined(F.col("found")).alias("spans"), F.col("suppressed").alias("n_suppressed"))


def _sql_spans(name: str, pattern: str) -> str:
    quoted = pattern.replace("'", "''")
    return f"""{name} AS (
  SELECT rid, m, start, start + length(m) AS "end" FROM (
    SELECT rid, ms[i] AS m,
           list_sum(list_transform(gaps[1:i], lambda x: length(x)))
           + coalesce(list_sum(list_transform(ms[1:i-1], lambda x: length(x))), 0) AS start
    FROM (SELECT rid, ms, string_split_regex(t, '{quoted}') AS gaps, unnest(range(1, len(ms) + 1)) AS i
          FROM (SELECT rid, t, regexp_extract_all(t, '{quoted}') AS ms FROM d) WHERE len(ms) > 0)))"""


def _reaches(value: str) -> str:
    return (f"coalesce(list_max(list_transform(range(1, length({value}) - {WINDOW} + 2), "
            f"lambda i: list_aggregate(string_split(substring({value}, i, {WINDOW}), ''), 'entropy'))) >= lim, false)")


ORACLE = rf"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS t FROM documents),
{_sql_spans('a', ASSIGN)},
{_sql_spans('k', ACCESS)},
{_sql_spans('h', HEX)},
{_sql_spans('c', CANDIDATE)},
base AS (
  SELECT rid, 'assign' AS kind, 0 AS rank, start, "end" FROM a
  WHERE length(regexp_extract(m, '{ASSIGN.replace("'", "''")}', 2)) >= {MIN_VALUE}
  UNION ALL SELECT rid, 'access', 1, start, "end" FROM k
  UNION ALL SELECT rid, 'hex', 2, start, "end" FROM h),
fresh AS (
  SELECT * FROM c WHERE regexp_matches(m, '[0-9]') AND regexp_matches(m, '[A-Za-z]')
  AND NOT EXISTS (SELECT 1 FROM base b WHERE b.rid = c.rid AND b.start < c."end" AND c.start < b."end")),
parts AS (
  SELECT *, regexp_full_match(m, '[0-9A-Fa-f]+') AS hx,
         len(list_filter(string_split_regex(regexp_replace(m, '([a-z0-9])([A-Z])', '\1 \2', 'g'), '[+/_=-]+| '),
                         lambda w: NOT regexp_matches(w, '{WORD}'))) = 0 AS words,
         string_split_regex(regexp_replace(m, '(?i){ALLOWED_WORDS}', ' ', 'g'), '{NEAR}') AS free_parts,
         regexp_matches(m, '(?i){ALLOWED_WORDS}') AS placeholder
  FROM fresh),
limits AS (
  SELECT *, CASE WHEN hx THEN {THRESHOLDS['entropy_hex']} WHEN words THEN {THRESHOLDS['entropy_mixed']}
                 WHEN regexp_matches(m, '[a-z]') AND regexp_matches(m, '[A-Z]') THEN {BOTH_CASES} ELSE {ONE_CASE} END AS lim,
         regexp_matches(lower(m), '{ALLOWED_FORMS}')
           OR ((starts_with(m, '/') OR contains(m, '//')) AND words AND regexp_matches(m, '[A-Za-z0-9]/+[A-Za-z0-9]'))
           OR (starts_with(m, '//') AND substring(t, CAST(start AS BIGINT), 1) = ':') AS ok
  FROM parts JOIN (SELECT rid, t FROM d) USING (rid)),
scored AS (
  SELECT *, len(list_filter(free_parts, lambda p: {_reaches('p')})) > 0 AS free, placeholder AND {_reaches('m')} AS near
  FROM limits),
hot AS (
  SELECT rid, CASE WHEN hx THEN 'entropy_hex' ELSE 'entropy_mixed' END AS kind, CASE WHEN hx THEN 3 ELSE 4 END AS rank,
         start, "end", ok OR NOT free AS ok
  FROM scored WHERE free OR near),
b AS (SELECT rid, count(*) FILTER (kind = 'assign') AS n_assign, count(*) FILTER (kind = 'access') AS n_access,
             count(*) FILTER (kind = 'hex') AS n_hex,
             string_agg(kind || ':' || start || ':' || "end", ',' ORDER BY start, rank) AS s FROM base GROUP BY rid),
al AS (SELECT rid, string_agg(kind || ':' || start || ':' || "end", ',' ORDER BY start, rank) AS s
       FROM (SELECT rid, kind, rank, start, "end" FROM base
             UNION ALL SELECT rid, kind, rank, start, "end" FROM hot WHERE NOT ok) GROUP BY rid),
su AS (SELECT rid, count(*) AS n FROM hot WHERE ok GROUP BY rid)
SELECT d.doc_id, coalesce(b.n_assign, 0) AS n_assign, coalesce(b.n_access, 0) AS n_access,
       coalesce(b.n_hex, 0) AS n_hex, sha256(coalesce(b.s, '')) AS base_sha256,
       coalesce(al.s, '') AS spans, coalesce(su.n, 0) AS n_suppressed
FROM d LEFT JOIN b USING (rid) LEFT JOIN al USING (rid) LEFT JOIN su USING (rid)
"""
