import hashlib
import re

from pyspark.sql import functions as F

from tapeworks.llm import pii

EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def brute(text):
    out = []
    for rank, (kind, rx) in enumerate([("email", EMAIL), ("ip", IP), ("card", CARD), ("phone", PHONE)]):
        for m in rx.finditer(text):
            digits = re.sub("[^0-9]", "", m.group())
            ok = {"email": True, "ip": all(int(p) <= 255 for p in m.group().split(".")) if kind == "ip" else True,
                  "card": 12 <= len(digits) <= 19 and pii.luhn(digits),
                  "phone": 9 <= len(digits) <= 15}[kind]
            if ok:
                out.append((m.start(), rank, kind, m.end()))
    return [(k, s, e) for s, _, k, e in sorted(out)]


TEXTS = [
    None, "", "plain words only", "mail a.b@c.de and x@y z@w.x.y@q.r", "@a.b a@b @@x.y",
    "10.0.0.1 1.2.3.4.5.6.7.8 300.1.1.1 001.2.3.4 1.2.3", "9" * 4000 + "." + "1.2.3",
    "card 4111 1111 1111 1111 or 4111-1111-1111-1112", "call +49 (30) 1234-5678. or +1", "+1 2+33 44 55 66 77",
    "é😀 bob@x.org ü 8.8.8.8", "x" * 50000 + "@" + "b.c", "Contact: Maria Keller, maria [at] mail [dot] com, IBAN DE89370400440532013000",
    "version 1.2.3.4 IBAN DE89370400440532013001", "tel (030) 1234 5678 ssn 123-45-6789",
]


def test_base_spans_match_plain_patterns(spark):
    df = spark.createDataFrame([(i, t, "x") for i, t in enumerate(TEXTS)] + [(None, "a@b.c", "y"), (3, TEXTS[3], "x")],
                               "doc_id long, text string, candidates string").repartition(3)
    rows = pii.pii_report(df).collect()
    assert len(rows) == len(TEXTS) + 2
    for r in rows:
        text = "a@b.c" if r.doc_id is None else TEXTS[r.doc_id] or ""
        want = brute(text)
        joined = ",".join(f"{k}:{s}:{e}" for k, s, e in want)
        assert r.base_sha256 == hashlib.sha256(joined.encode()).hexdigest(), text[:60]
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(k == x for k, _, _ in want) for x in pii.BASE_KINDS]
        assert set(filter(None, joined.split(","))) <= set(r.spans.split(","))


def test_empty_table(spark):
    assert pii.pii_report(spark.createDataFrame([], "doc_id long, text string")).collect() == []


def test_reliabilities_and_unsupported_kinds():
    counts = [("email", "++000", 200), ("email", "-+00-", 10), ("name", "0++00", 90), ("name", "0-000", 9000),
              ("name", "0-00-", 200), ("iban", "-000-", 10), ("phone_national", "00000", 2), ("phone_national", "00+00", 3)]
    prob, reliable = pii.estimate(counts)
    assert prob["name", "0++00"] > 0.8 > 0.1 > prob["name", "0-000"] and prob["iban", "-000-"] < 0.3
    assert reliable["gazetteer"] > 0.7 and reliable["cue"] > 0.7
    w = pii.train([(k, v, "00", n) for k, v, n in counts], prob)
    assert w["gazetteer+"] > w["gazetteer-"] and w["cue+"] > 0


def test_texts_without_personal_data_stay_clean(spark):
    """Capitalised word pairs are no names, whatever their number; names with support are found."""
    rows = [(i, f"At Once The Apache License says so in part {i}. Under General Public terms.") for i in range(300)]
    rows += [(1000 + i, f"Please write to mr Thomas Keller or mail user{i}@example.com, tel +49 30 1234567{i % 10}") for i in range(60)]
    got = {r.doc_id: r for r in pii.pii_report(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert all(got[i].spans == "" for i in range(300))
    assert all("name:19:32" in got[i].spans for i in got if i >= 1000)


def test_added_spans_do_not_overlap_base(spark):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(TEXTS)], "doc_id long, text string")
    for r in pii.find_pii(df, ["doc_id"]).select("base", F.col("found")).collect():
        base = [(c["start"], c["end"]) for c in r.base]
        for c in r.found:
            assert c["base"] or not any(c["start"] < e and s < c["end"] for s, e in base)
