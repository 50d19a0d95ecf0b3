import hashlib
import re

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tapeworks.llm import fim

SCHEMA = "doc_id long, text string, n int, form int, output string"
UNIT = re.compile(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+")


def brute(i, text):
    text = text or ""
    u = UNIT.findall(text)
    h = hashlib.sha256(f"42:{'' if i is None else i}".encode()).hexdigest()
    h = [int(h[k:k + 8], 16) for k in (0, 8, 16, 24)]
    a, b = sorted((h[0] % (len(u) + 1), h[1] % (len(u) + 1)))
    p, m, s = "".join(u[:a]), "".join(u[a:b]), "".join(u[b:])
    if not text or any(x in text for x in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 50:
        return len(u), "plain", None, None, text
    if h[3] % 100 < 80:
        return len(u), "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}"
    return len(u), "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}"


def check(spark, rows, parts=3):
    df = spark.createDataFrame([(*r, 1, 2, "x") for r in rows], SCHEMA).repartition(parts)
    made = fim.fill_in_middle(df, ["doc_id"])
    got = made.select("*", fim.restored(made.output, made.form).alias("back")).collect()
    key = lambda r: tuple(str(x) for x in r)
    assert sorted((tuple(r[:-1]) for r in got), key=key) == sorted(((i, *brute(i, t)) for i, t in rows), key=key)
    assert sorted(r.back for r in got) == sorted(t or "" for _, t in rows)
    digest = lambda t: hashlib.sha256(t.encode()).hexdigest()
    report = fim.fim_report(df).collect()
    assert sorted((r.output_sha256, r.restored_sha256) for r in report) == sorted(
        (digest(brute(i, t)[4]), digest(t or "")) for i, t in rows)
    return got


ODD = [None, "", " ", "\n\t ", "word", " word ", "a b", "a  b\x0bc\x0c\rd", "é", "日本 語　x y", "\x1c\x1d\x85 z", "<P> a b",
       "x<S", "x <M> y", "<", "a <", "\U0001f600" * 9 + " \U0001f600", "12345678", "1234567 ", " 234567 9", "a" * 64 + " " * 64]


def test_odd_texts(spark):
    got = check(spark, [(i, t) for i in range(40) for t in ODD] + [(None, t) for t in ODD])
    assert {r.form for r in got} == {"plain", "spm", "psm"}


def test_long_texts_ties_and_repeats(spark):
    rng = np.random.default_rng(4)
    words = ["wörd", "a", "日本", "x" * 30, "\t", "  ", "\n\n"]
    rows = [(i % 7, " ".join(rng.choice(words, size=n))) for i, n in enumerate([1, 5, 60, 3000, 200_000] * 4)]
    check(spark, rows + rows[:6] + [(99, "y" * 1_000_001), (100, " " * 1_000_001)])


def test_empty_table(spark):
    assert fim.fim_report(spark.createDataFrame([], SCHEMA)).collect() == []


@settings(max_examples=200, deadline=None)
@given(st.lists(st.text(alphabet=st.sampled_from("ab \t\n\x0b\x0c\r\x08\x0e\x1f!éß日　\U0001f600<SP>\u0085 "), max_size=40), min_size=1, max_size=8))
def test_units_of_any_text(texts):
    raw = [t.encode() for t in texts]
    stop = np.cumsum([len(r) for r in raw])
    start = np.r_[0, stop[:-1]]
    for h in ([0, 1], [2, 5], [3, 3]):
        draw = np.tile(h, (len(raw), 1))
        n, a, b, prefix, middle = fim.cuts(np.frombuffer(b"".join(raw), np.uint8), start.copy(), stop, draw)
        for i, t in enumerate(texts):
            u = UNIT.findall(t)
            x, y = sorted(k % (len(u) + 1) for k in h)
            p, m = "".join(u[:x]), "".join(u[x:y])
            assert (n[i], a[i] - start[i], b[i] - start[i]) == (len(u), len(p.encode()), len((p + m).encode()))
            assert (prefix[i], middle[i]) == (len(p), len(m))


@pytest.mark.parametrize("rate,spm,forms", [(0, 50, {"plain"}), (100, 100, {"spm"}), (100, 0, {"psm"})])
def test_rates(spark, rate, spm, forms):
    df = spark.createDataFrame([(i, "some words here", 0, 0, "") for i in range(30)], SCHEMA)
    got = fim.fill_in_middle(df, ["doc_id"], rate=rate, spm=spm)
    assert {r.form for r in got.collect()} == forms
