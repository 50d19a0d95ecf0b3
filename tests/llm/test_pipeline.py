import re
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

import __spark_entry__
import corpus_pipeline
from tapeworks.llm import packing, secrets, toxicity
from tests.llm.test_mixing import brute_targets
from tests.llm.test_packing import check as check_packing
from tests.llm.test_secrets import brute as brute_secrets
from tests.llm.test_simhash import brute_components, brute_print

SF_DIR = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    """What each stage returned, by its name; the input is at ''."""
    root = tmp_path_factory.mktemp("pipeline")
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    out = {"": docs.collect()}
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, docs, SF_DIR).write.parquet(f"{root}/{name}")
        docs = spark.read.parquet(f"{root}/{name}")
        out[name] = docs.collect()
        if name != corpus_pipeline.STAGES[-1][0]:
            assert docs.columns == corpus_pipeline.COLUMNS
    return out


def test_registered(spark):
    assert __spark_entry__.queries()["pipeline"] is corpus_pipeline.run
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "simhash_near_dedup", "secret_scans", "mixing", "best_fit_packing"]


def test_toxicity_drops_what_it_rejects_and_nothing_else(spark, stages):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    labels = spark.read.parquet(f"{SF_DIR}/labels.parquet")
    bad = {r.doc_id for r in toxicity.toxicity_report(docs, labels).where("predicted = 1").collect()}
    assert bad and {r.doc_id for r in stages["toxicity"]} == {r.doc_id for r in stages[""]} - bad
    given = {r.doc_id: r for r in stages[""]}
    assert all(given[r.doc_id] == r for r in stages["toxicity"])


def test_one_document_of_each_group_stays(stages):
    rows = stages["toxicity"]
    groups = brute_components([r.doc_id for r in rows], [brute_print(r.text) for r in rows])
    assert sorted(r.doc_id for r in stages["simhash_near_dedup"]) == sorted(set(groups))


def test_secrets_are_gone_and_clean_documents_unchanged(stages):
    before = {r.doc_id: r for r in stages["simhash_near_dedup"]}
    after = {r.doc_id: r for r in stages["secret_scans"]}
    assert before.keys() == after.keys()
    hit = 0
    for i, r in after.items():
        for _, start, end in (s.split(":") for s in filter(None, brute_secrets(before[i].text).split(","))):
            hit += 1
            assert before[i].text[int(start):int(end)] not in r.text
        if "[SECRET]" not in r.text:
            assert r == before[i]
        else:
            assert r.n_chars == len(r.text)
    assert hit


def test_mix_repeats_documents_towards_targets(stages):
    rows = stages["secret_scans"]
    size = {r.doc_id: len(re.findall(r"[^\x20\x09-\x0D]+", r.text)) for r in rows}
    by, taken = defaultdict(int), defaultdict(int)
    for r in rows:
        by[r.source] += size[r.doc_id]
    for r in stages["mixing"]:
        taken[r.source] += size[r.doc_id]
    given = {r.doc_id: r for r in rows}
    times = Counter(r.doc_id for r in stages["mixing"])
    assert max(times.values()) <= 3 and all(given[r.doc_id] == r for r in stages["mixing"])
    for s, t in brute_targets(dict(by)).items():
        assert abs(taken[s] - t) <= max(size.values())


def test_packing_holds_every_mixed_document(stages):
    check_packing([(r.doc_id, r.text) for r in stages["mixing"]], stages["best_fit_packing"], packing.CAPACITY)


def test_odd_documents(spark, tmp_path):
    rows = [(None, None, None, None, None), (1, "", "en", "a", 0), (1, "", "en", "a", 0), (2, "token=abcdef123 é", "en", None, 17),
            (3, "w " * 50000, "en", "a", 100000), (None, "x y z", "en", "b", 5)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").withColumns(
        {c: F.lit(1) for c in ("_h", "_k0", "_times", "_text", "size", "found", "score", "root", "copies")})
    kept = corpus_pipeline.drop_near_copies(spark, docs, SF_DIR).collect()
    assert len(kept) == 4 and sum(r.doc_id == 1 for r in kept) == 1
    marked = {r.doc_id: r for r in corpus_pipeline.redact_secrets(spark, docs.where("doc_id in (2, 3)"), SF_DIR).collect()}
    assert marked[2].text == "[SECRET] é" and marked[2].n_chars == 10 and marked[3].n_chars == 100000
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs.limit(0), SF_DIR).count() == 0
    assert corpus_pipeline.mix_sources(spark, docs, SF_DIR).where(F.col("doc_id") == 3).count() <= 3
    assert secrets.KINDS[:3] == secrets.BASE_KINDS
