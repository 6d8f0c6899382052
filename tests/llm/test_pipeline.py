"""The pipeline's stages, each against brute force on its own input."""

from __future__ import annotations

import hashlib

import corpus_pipeline
from test_tables import brute_components, brute_hits

from fitlens.llm.registry import table
from fitlens.session import stored

SF = "/root/testdata/sf0.001"


def test_stages(spark):
    docs = table(spark, SF, "documents")
    columns = docs.columns
    inputs = []
    for _, stage in corpus_pipeline.STAGES:
        inputs.append(docs)
        docs = stored(stage(spark, docs, SF))
    rows = [{r.doc_id: r for r in df.collect()} for df in inputs]
    assert all(df.columns == columns for df in inputs)
    # Quality: few labelled documents here, so nearly all good ones stay and most bad ones go.
    labels = {r.doc_id: r.quality for r in table(spark, SF, "labels").collect()}
    good, bad = ([i for i, q in labels.items() if q == k] for k in (1, 0))
    assert sum(i in rows[1] for i in good) >= 0.95 * len(good) and sum(i not in rows[1] for i in bad) >= 0.75 * len(bad)
    # Near duplicates: the smallest id of each component.
    components = brute_components([(i, r.text) for i, r in rows[1].items()], 5)
    assert set(rows[2]) == {i for i, (_, c) in components.items() if i == c}
    # Benchmark: those without a hit.
    items = [(str(r.item_id), r.text) for r in table(spark, SF, "benchmark").collect()]
    hits = brute_hits([(i, r.text) for i, r in rows[2].items()], items)
    assert set(rows[3]) == {i for i, _, n, _ in hits if n == 0}
    # Secrets: all documents stay; tokens: all texts come back.
    assert set(rows[4]) == set(rows[3])
    out = docs.collect()
    assert {r.doc_id: r.decoded_sha256 for r in out} == {i: hashlib.sha256(r.text.encode()).hexdigest() for i, r in rows[4].items()}
    assert all(len(r.ids) == r.n_tokens for r in out)


def test_pipeline_of_odd_rows_and_empty_tables(spark, frame, tmp_path):
    text = "the quick brown fox jumps over the lazy dog and runs into the wood where it sleeps until the morning comes"
    leak = "what is the name of the river that runs through the old town and under the bridge"
    rows = [
        (1, text, "en", "web", len(text), 0.5, "a"), (1, text, "en", "web", len(text), 0.5, "a"), (2, text + " again", None, None, None, None, None),
        (3, None, None, None, None, None, None), (4, "", "en", "", 0, None, None), (None, text, None, "x", 1, None, "b"),
        (5, f"Someone asked: {leak}?", "en", "web", 90, None, None), (6, f"and so he wrote password=e3b3ed3cc8548923d6 on it, {text[::-1]}", "en", "web", 100, None, None),
        (7, "word " * 60_000, "en", "web", 300_000, None, None),
    ]
    schema = "doc_id long, text string, lang string, source string, n_chars long, score double, label string"
    tables = {
        "labels": frame([(1, 1, 0), (2, 1, 0), (5, 1, 0), (None, 1, 0), (6, None, 0), (9, 0, 0)], "doc_id long, quality int, toxic int"),
        "benchmark": frame([(1, leak), (2, None), (3, "")], "item_id long, text string"),
    }
    for name, docs in (("some", frame(rows, schema)), ("none", frame([], schema))):
        for table_name, df in {**tables, "documents": docs}.items():
            df.write.parquet(str(tmp_path / name / f"{table_name}.parquet"))
    out = corpus_pipeline.run(spark, str(tmp_path / "some")).collect()
    # One of the two copies and the near copy stays; the leak goes; the secret is a mark.
    assert sorted(r.doc_id or 0 for r in out) == [0, 1, 3, 4, 6, 7]
    clean = rows[7][1].replace("e3b3ed3cc8548923d6", "[SECRET]")
    assert {r.decoded_sha256 for r in out if r.doc_id == 6} == {hashlib.sha256(clean.encode()).hexdigest()}
    assert corpus_pipeline.run(spark, str(tmp_path / "none")).count() == 0
