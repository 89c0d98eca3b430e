"""The pipeline: each stage's decisions hold, and the run is its stages one after another."""

from __future__ import annotations

import __spark_entry__ as driver
import corpus_pipeline
from rostrum.llm import ordinal_quality, simhash_pivot, string_kernel
from rostrum.sources.sinks import stored

SF = "/root/testdata/sf0.001"


def test_registered():
    names = [n for n in driver.queries() if n.startswith("op")]
    assert sorted(int(n[2:].split("_")[0]) for n in names) == list(range(1, 14)) and driver.queries()["pipeline"] is corpus_pipeline.run
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality classifier", "toxicity", "exact dedup", "near dedup", "best-fit packing"]


def test_stages_and_run(session):
    docs = session.read.parquet(f"{SF}/documents.parquet")
    labels = session.read.parquet(f"{SF}/labels.parquet")
    texts = {r.doc_id: r.text for r in docs.collect()}
    (_, quality), (_, toxicity), (_, exact), (_, near), (_, packing) = corpus_pipeline.STAGES

    good = stored(quality(session, docs, SF), "stage")
    rated = ordinal_quality.rate_documents(docs, ordinal_quality.graded(labels)).filter("selected")
    assert good.columns == docs.columns and {r.doc_id for r in good.collect()} == {r.doc_id for r in rated.collect()}

    clean = stored(toxicity(session, good, SF), "stage")
    scored = string_kernel.score_documents(good, labels).filter("predicted = 0")
    assert clean.columns == docs.columns and {r.doc_id for r in clean.collect()} == {r.doc_id for r in scored.collect()}

    single = stored(exact(session, clean, SF), "stage")
    last = {texts[r.doc_id]: r.doc_id for r in sorted(clean.collect(), key=lambda r: r.doc_id)}
    assert single.columns == docs.columns and sorted(r.doc_id for r in single.collect()) == sorted(last.values())

    unlike = stored(near(session, single, SF), "stage")
    ids = sorted(r.doc_id for r in single.collect())
    prints = {i: simhash_pivot.fingerprint_of(texts[i].encode()) & (1 << 64) - 1 for i in ids}
    root = {i: i for i in ids}
    for i in ids:
        for j in ids:
            if j < i and (prints[i] ^ prints[j]).bit_count() <= 2:
                a, b = root[i], root[j]
                root = {k: min(a, b) if r in (a, b) else r for k, r in root.items()}
    assert unlike.columns == docs.columns and sorted(r.doc_id for r in unlike.collect()) == sorted(set(root.values()))

    packed = packing(session, unlike, SF)
    assert {r.doc_id for r in packed.collect()} == set(root.values())
    found = corpus_pipeline.run(session, SF)
    assert sorted(map(tuple, found.collect())) == sorted(map(tuple, packed.collect()))


def test_stages_take_empty_tables(session):
    docs = session.read.parquet(f"{SF}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(session, docs, SF).count() == 0
