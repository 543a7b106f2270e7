import re

from test_signature_tree import brute_force
from test_pages_and_links import best_windows

import corpus_pipeline
from millrace.llm import mixing
from millrace.llm.tools import stored
from millrace.sources.tables import Tables


def test_stages_against_brute_force(spark, folder):
    docs = Tables(spark, folder).documents
    columns = docs.columns
    stages = dict(corpus_pipeline.STAGES)
    assert list(stages) == ["language_id", "near_duplicates", "decontamination", "mixing", "token_store"]

    def step(name, table):
        return stored(stages[name](spark, table, folder), name)

    text = {r["doc_id"]: r["text"] for r in docs.collect()}
    spoken = step("language_id", docs)
    assert spoken.columns == columns
    assert {r["doc_id"] for r in spoken.collect()} == {i for i, t in text.items() if re.search(r"[^\W\d_]", t or "")}

    single = step("near_duplicates", spoken)
    groups = brute_force([(r["doc_id"], r["text"]) for r in spoken.collect()])
    assert sorted(r["doc_id"] for r in single.collect()) == sorted({root for _, root in groups.values()})

    clean = step("decontamination", single)
    items = [tuple(r) for r in Tables(spark, folder).benchmark.select("item_id", "text").collect()]
    bad = {doc for doc, _ in best_windows([(r["doc_id"], r["text"]) for r in single.collect()], items)}
    assert {r["doc_id"] for r in clean.collect()} == {r["doc_id"] for r in single.collect()} - bad

    mix = step("mixing", clean)
    assert mix.columns == columns
    copies = {r["doc_id"]: r["copies"] for r in mixing.mixed(clean).collect()}
    taken = {r["doc_id"]: r["count"] for r in mix.groupBy("doc_id").count().collect()}
    assert taken == {i: n for i, n in copies.items() if n}

    tokens = step("token_store", mix).collect()
    assert sorted(r["doc_id"] for r in tokens) == sorted(r["doc_id"] for r in mix.collect())
    assert sorted(map(tuple, corpus_pipeline.run(spark, folder).collect())) == sorted(map(tuple, tokens))


def test_odd_rows_and_empty_table(spark, odd_docs, folder):
    plain = odd_docs.select("doc_id", "text", "lang", "source", "n_chars")
    for table in (plain, plain.limit(0)):
        for name, stage in corpus_pipeline.STAGES:
            table = stored(stage(spark, table, folder), name)
        assert table.columns == ["doc_id", "start", "n_tokens", "ids_crc32"]
