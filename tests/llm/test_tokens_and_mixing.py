import random
import re
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from millrace.llm import mixing, token_store
from millrace.session import scratch_path


@pytest.fixture(scope="module")
def library():
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    return lambda text: tokenizer.encode(text, add_special_tokens=False).ids


def test_encoder_equals_the_library(library):
    rng = random.Random(4)
    parts = ["a", "word", "Word's", "12", "34567", "...", "é", "中文", "🙂", " ", "  ", "\n", "\n\n", "\t", "\r\n", " ", "<|endoftext|>", "x" * 90]
    encoder = token_store.Encoder(public_tokenizers.path("byte_bpe_50k.json"), room=50)
    for batch in range(60):
        texts = ["".join(rng.choice(parts) for _ in range(rng.randrange(12))) for _ in range(40)]
        if batch % 3:
            texts += [" ".join(rng.choice(parts).strip() or "x" for _ in range(30)) for _ in range(10)]
        texts[3] = None
        values, sizes = encoder.encode(pa.array(texts), 0)
        assert values.tolist() == [i for text in texts for i in [*library(text or ""), 0]]
        assert sizes.tolist() == [len(library(text or "")) + 1 for text in texts]
    sliced = pa.array(["a b", "c\nd e", "f  g", "<|endoftext|> h"]).slice(1, 3)
    assert encoder.encode(sliced, 7)[0].tolist() == [i for text in sliced.to_pylist() for i in [*library(text), 7]]
    assert library("a <|endoftext|> b") == [64, 220, 50256, 275]


def check_store(spark, docs, library):
    folder = scratch_path(spark, "tokens")
    token_store.write_tokens(docs, folder)
    stored = token_store.read_tokens(spark, folder)
    found = sorted(stored.collect(), key=lambda r: r["start"])
    assert [r["doc_id"] for r in found] == sorted((r["doc_id"] for r in found), key=lambda i: (i is not None, i))
    start = 0
    for row in found:
        assert row["start"] == start and row["n_tokens"] == len(row["ids"])
        start += row["n_tokens"]
    texts = sorted((r["doc_id"] if r["doc_id"] is not None else -1, [*library(r["text"] or ""), 0]) for r in docs.select("doc_id", "text").collect())
    assert sorted((r["doc_id"] if r["doc_id"] is not None else -1, r["ids"]) for r in found) == texts
    for row in token_store.digests(stored).collect():
        ids = next(r["ids"] for r in found if r["start"] == row["start"])
        assert row["ids_crc32"] == zlib.crc32(np.array(ids, "<u4").tobytes())
    return folder


def test_store_round_trip(spark, folder, library):
    check_store(spark, spark.read.parquet(f"{folder}/documents.parquet"), library)


def test_store_odd_rows_and_empty_table(spark, odd_docs, library):
    check_store(spark, odd_docs, library)
    check_store(spark, odd_docs.limit(0), library)


def test_filter_on_id_reaches_the_scan(spark, folder, plan):
    path = scratch_path(spark, "tokens")
    token_store.write_tokens(spark.read.parquet(f"{folder}/documents.parquet"), path)
    one = token_store.read_tokens(spark, path).filter("doc_id = 17").select("doc_id", "n_tokens")
    assert "EqualTo(doc_id,17)" in plan(one)
    assert one.count() == 1


def expected_targets(words, share, most, weights):
    """Targets by dealing again until nothing is above its limit."""
    order = sorted(words, key=lambda s: (s is None, s or ""))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    capped = {}
    while True:
        free = [s for s in order if s not in capped]
        left = share * sum(words.values()) - sum(capped.values())
        shares = {s: left * weight[s] / sum(weight[f] for f in free) for s in free}
        above = [s for s in free if shares[s] > most * words[s]]
        if not above:
            return capped | shares
        capped |= {s: most * words[s] for s in above}


def check_mix(docs):
    rows = docs.select("doc_id", "text", "source").collect()
    sizes = [(r["source"], len(re.findall(r"[^\x20\x09-\x0D]+", r["text"] or ""))) for r in rows]
    words = {}
    for source, size in sizes:
        words[source] = words.get(source, 0) + size
    goal = expected_targets(words, mixing.SHARE, mixing.MOST, mixing.WEIGHTS)
    found = mixing.mixed(docs).collect()
    assert sorted((r["source"] or "", r["size"]) for r in found) == sorted((s or "", n) for s, n in sizes)
    taken = {}
    for r in found:
        assert r["target"] == pytest.approx(goal[r["source"]]) and r["source_size"] == words[r["source"]]
        assert 0 <= r["copies"] <= mixing.MOST
        taken[r["source"]] = taken.get(r["source"], 0) + r["size"] * r["copies"]
    return goal, taken, sorted(tuple(r) for r in found if r["doc_id"] is not None and r["source"] is not None)


def test_mix_meets_its_targets_and_reruns_agree(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    goal, taken, rows = check_mix(docs)
    for source, words in goal.items():
        assert taken[source] == pytest.approx(words, rel=0.05)
    assert check_mix(docs.repartition(3))[2] == rows


def test_mix_odd_rows_and_empty_table(spark, odd_docs):
    check_mix(odd_docs)
    assert mixing.mixed(odd_docs.limit(0)).collect() == []
    taken = mixing.repeated(odd_docs)
    assert taken.columns == odd_docs.columns
    assert mixing.repeated(odd_docs.limit(0)).count() == 0


def test_rates_are_exponentially_tilted(spark, docs_of):
    rng = random.Random(1)
    docs = docs_of([(i, "w " * rng.randrange(1, 200), None, "ab"[i % 2]) for i in range(400)])
    rows = mixing.mixed(docs, weights=(3.0, 1.0), share=1.0).collect()
    for source in "ab":
        inner = [(r["size"], np.log(r["rate"])) for r in rows if r["source"] == source and r["rate"] < mixing.MOST]
        slopes = {round((y - z) / (x - w), 6) for (x, y), (w, z) in zip(inner, inner[1:]) if x != w}
        assert max(slopes) - min(slopes) < 1e-4
