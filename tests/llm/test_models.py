import math
import re
import zlib
from collections import Counter
from itertools import product

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from millrace.llm import context_tree, language_id, quality
from millrace.llm.tools import fold, stored


@pytest.fixture(scope="module")
def documents(spark):
    # The smallest tables hold too few labelled rows to judge a classifier by.
    return spark.read.parquet("/root/testdata/sf0.01/documents.parquet")


def test_forward_sums_all_segmentations():
    pieces = language_id.Pieces(public_tokenizers.path("piece_bpe_32k.model"))
    rng = np.random.default_rng(5)
    probability = rng.random((2, pieces.size))
    probability /= probability.sum(axis=1, keepdims=True)
    weights = language_id._scaled(pieces, probability)

    def total(text, k):
        """Over every way to cut the text."""
        result = 0.0
        for cuts in product([False, True], repeat=len(text) - 1):
            parts, start = [], 0
            for i, cut in enumerate(cuts, 1):
                if cut:
                    parts.append(text[start:i])
                    start = i
            parts.append(text[start:])
            value = 1.0
            for part in parts:
                piece = pieces.of.get(part, -1)
                if piece < 0:
                    piece = pieces.unknown if len(part) == 1 else None
                value *= probability[k, piece] if piece is not None else 0.0
            result += value
        return result

    runs = ["a", "the", "haus", "中x", "mention"]
    found = language_id.log_likelihoods(pieces, runs, weights)
    for i, run in enumerate(runs):
        for k in range(2):
            assert found[i, k] == pytest.approx(math.log(total("▁" + run, k)), rel=1e-9)


def test_expected_counts_cover_each_character():
    pieces = language_id.Pieces(public_tokenizers.path("piece_bpe_32k.model"))
    weights = language_id._scaled(pieces, np.full((1, pieces.size), 1 / pieces.size))
    runs, times = ["the", "mention", "ñandú"], np.array([3.0, 1.0, 2.0])
    counts = language_id.expected_counts(pieces, runs, times, np.zeros(3, int), weights)[0]
    length = np.ones(pieces.size)
    for piece, i in pieces.of.items():
        if i >= 0:
            length[i] = len(piece)
    assert (counts * length).sum() == pytest.approx(sum((len(r) + 1) * n for r, n in zip(runs, times)))


def test_long_runs_are_summed_whole():
    pieces = language_id.Pieces(public_tokenizers.path("piece_bpe_32k.model"))
    rng = np.random.default_rng(6)
    probability = rng.random((2, pieces.size))
    probability /= probability.sum(axis=1, keepdims=True)
    weights = language_id._scaled(pieces, probability)
    letters = list("etaoinshrdlu中é")
    runs = ["".join(rng.choice(letters, n)) for n in (500, 61, 60, 1, 3000)] + ["the"]
    found = language_id.log_likelihoods(pieces, runs, weights)
    counts = language_id.expected_counts(pieces, runs, np.ones(6), np.zeros(6, int), weights)
    expected, used = np.zeros((6, 2)), np.zeros(pieces.size)
    for i, run in enumerate(runs):
        text = "▁" + run

        def parts(end):
            for start in range(max(0, end - pieces.longest), end):
                piece = pieces.of.get(text[start:end], -1)
                if piece >= 0 or end - start == 1:
                    yield start, piece if piece >= 0 else pieces.unknown

        for k in range(2):
            logs = [0.0]
            for end in range(1, len(text) + 1):
                terms = [logs[start] + math.log(probability[k, piece]) for start, piece in parts(end)]
                logs.append(max(terms) + math.log(sum(math.exp(t - max(terms)) for t in terms)))
            expected[i, k] = logs[-1]
            if k == 0:
                ahead = logs
        behind = [-math.inf] * len(text) + [0.0]
        for end in range(len(text), 0, -1):
            for start, piece in parts(end):
                term = behind[end] + math.log(probability[0, piece])
                high = max(term, behind[start])
                behind[start] = high + math.log(math.exp(term - high) + math.exp(behind[start] - high))
        for end in range(1, len(text) + 1):
            for start, piece in parts(end):
                used[piece] += math.exp(ahead[start] + behind[end] - ahead[-1]) * probability[0, piece]
    assert found == pytest.approx(expected, rel=1e-9)
    assert counts[0] == pytest.approx(used, rel=1e-6, abs=1e-9)


def test_languages_of_held_out_documents(documents):
    held_out = fold("doc_id", 5, 0)
    model = language_id.fit(documents.filter(~held_out))
    found = language_id.predict(documents.filter(held_out), model)
    rows = found.join(documents.select("doc_id", "lang"), "doc_id").collect()
    assert len(rows) > 100
    assert sum(r["lang_pred"] == r["lang"] for r in rows) / len(rows) > 0.98
    assert all(0 <= r["score"] <= 1 for r in rows)


def test_languages_of_odd_rows(spark, odd_docs, odd_rows):
    model = language_id.fit(odd_docs)
    assert model.languages == ["en", "fr"]
    found = language_id.predict(odd_docs, model).collect()
    assert len(found) == len(odd_rows)
    und = {r["doc_id"] for r in found if r["lang_pred"] == "und"}
    assert und == {1, 2, 3, 9}
    kept = language_id.identified(odd_docs, model)
    assert kept.columns == odd_docs.columns and kept.count() == len(odd_rows) - 4
    named = {(r["doc_id"], r["lang_pred"]) for r in found} - {(i, "und") for i in und}
    assert {(r["doc_id"], r["lang"]) for r in kept.collect()} == named
    nothing = language_id.fit(odd_docs.limit(0))
    assert language_id.identified(odd_docs, nothing).count() == len(odd_rows) - 4
    assert {(r["lang_pred"], r["score"]) for r in language_id.predict(odd_docs, nothing).collect()} == {("und", 0.0)}
    assert language_id.predict(odd_docs.limit(0), model).collect() == []


def test_too_many_languages_are_refused(spark, monkeypatch):
    monkeypatch.setattr(language_id, "MOST_LANGUAGES", 3)
    docs = spark.range(8).selectExpr("id AS doc_id", "'a word' AS text", "concat('l', id) AS lang")
    with pytest.raises(ValueError):
        language_id.fit(docs)


def test_quality_of_held_out_documents(spark, documents):
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    held_out = fold("doc_id", 3, 1)
    found = quality.scores(documents, labels.filter(~held_out)).filter(held_out)
    rows = found.join(labels, "doc_id").collect()
    assert len(rows) > 50
    assert sum((r["score"] >= 0.5) == (r["quality"] == 1) for r in rows) / len(rows) > 0.93
    assert found.count() == documents.filter(held_out).count()


def test_contexts_are_added_on_both_sides():
    places, signs = quality._index_vectors()
    documents = [np.array([1, 2, 3], np.int32), np.array([4], np.int32), np.array([1, 5], np.int32)]
    found = np.zeros((quality.BUCKETS, quality.WIDTH))
    quality.add_contexts(found, documents, places, signs)
    index = np.zeros_like(found)
    for bucket in range(6):
        index[bucket, places[bucket]] = signs[bucket]
    expected = {1: index[2] + index[3] + index[5], 2: index[1] + index[3], 3: index[1] + index[2], 4: 0 * index[4], 5: index[1]}
    for bucket, vector in expected.items():
        assert found[bucket].tolist() == vector.tolist()


def test_quality_of_odd_rows(spark, odd_docs, odd_rows):
    labels = spark.createDataFrame([(1, 1, 0), (5, 0, 0), (6, 1, 0), (6, 0, 0), (7, None, 0), (99, 1, 0), (None, 1, 1)], "doc_id long, quality int, toxic int")
    found = quality.scores(odd_docs, labels).collect()
    assert len(found) == len(odd_rows) and all(0 <= r["score"] <= 1 for r in found)
    unlabelled = quality.scores(odd_docs, labels.limit(0)).collect()
    assert {r["score"] for r in unlabelled} == {0.5}
    assert quality.scores(odd_docs.limit(0), labels).collect() == []


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def check_base(docs, found):
    texts = [(r["doc_id"], words(r["text"])) for r in docs.select("doc_id", "text").collect()]
    train = [w for doc, w in texts if zlib.crc32(str(doc).encode()) % 10 or doc is None]
    counts = Counter(word for w in train for word in w)
    counts[None] = len(train)
    total, distinct = sum(counts.values()), len(+counts)
    expected = sorted(
        (doc if doc is not None else -1, len(w) + 1, sum(counts[x] > 0 for x in [*w, None]),
         round(sum(math.log10((counts[x] + 0.1) / (total + 0.1 * (distinct + 1))) for x in [*w, None]), 4))
        for doc, w in texts
    )
    rows = sorted((r["doc_id"] if r["doc_id"] is not None else -1, r["n_tokens"], r["n_known"], round(r["base_score"], 4)) for r in found)
    assert [r[:3] for r in rows] == [e[:3] for e in expected]
    assert [r[3] for r in rows] == pytest.approx([e[3] for e in expected], rel=1e-6)
    assert {r["train_tokens"] for r in found} <= {total}


def test_tree_beats_the_unigram_on_held_out_documents(documents):
    held_out = fold("doc_id", 10, 0)
    found = context_tree.score_documents(documents, held_out).withColumn("held_out", held_out).collect()
    check_base(documents, found)
    out = [r for r in found if r["held_out"]]
    assert sum(r["score"] for r in out) > sum(r["base_score"] for r in out)


def test_code_lengths_of_odd_rows(spark, odd_docs):
    found = context_tree.score_documents(odd_docs, fold("doc_id", 10, 0), most_words=3).collect()
    check_base(odd_docs, found)
    assert all(r["score"] < 0 and math.isfinite(r["score"]) for r in found)
    assert context_tree.score_documents(odd_docs.limit(0), fold("doc_id", 10, 0)).collect() == []


def test_classes_come_from_all_training_texts(spark):
    """More texts than any sample of old, dealt in two ways: the classes and sizes of one pass after the other over all of them."""
    rng = np.random.default_rng(9)
    kinds = ["abcdefgh", "ijklmnop", "01234567", "éèêëàâ", "{}[]();"]
    texts = [" ".join("".join(rng.choice(list(kinds[i % 5]), 5)) for _ in range(rng.integers(1, 120))) for i in range(4_000)]
    texts += ["", None, "z" * 70_000, *["qu xy " * 100] * 3]
    table = spark.createDataFrame([(text,) for text in texts], "text string")
    counts = np.stack([context_tree.pair_counts(text.encode() if text else None) for text in texts]).astype(float)
    classes = context_tree.find_classes(counts)
    member = (counts @ classes.T).argmax(axis=1)
    for parts in (3, 7):
        found, sizes = context_tree._classes(table.repartition(parts))
        assert (found == classes).all()
        assert sizes.tolist() == np.bincount(member, minlength=6).tolist() and sizes.sum() == len(texts)


def test_bytes_behind_a_context_share_at_most_one(spark):
    """All bytes that a word can have, and the space behind it; the white space left out has the little that is missing."""
    table = spark.createDataFrame([(i, t) for i, t in enumerate(["the cat the dog a cat", "a then thin the", "xyz the"])], "doc_id long, text string")
    seen = context_tree.count_words(table, F.lit(False), context_tree.find_classes(np.zeros((0, 512))))
    stems, possible = (b"th", b"the", b"thex"), [b for b in range(256) if b not in (32, 9, 10, 11, 12, 13)]
    probes = [stem + bytes([b]) for stem in stems for b in possible] + list(stems)
    rows = spark.createDataFrame([(bytearray(word), *[0] * 6) for word in probes], seen.schema)
    table = seen.union(rows).groupBy("word").agg(*(F.sum(f"n_{k}").alias(f"n_{k}") for k in range(6)))
    model = context_tree.fit(table, [3, 0, 0, 0, 0, 0])
    for stem in stems:
        total = 0.0
        for word in [stem, *(stem + bytes([b]) for b in possible)]:
            leaves = context_tree.Leaves(context_tree.Positions.of([word], model.depth), model.kept, model.depth)
            total += 10 ** model.of(leaves.with_mark(0x20)[len(stem) : len(stem) + 1])[0]  # the words are short: all contexts are marked
        assert 0.8 < total <= 1 + 1e-9


def test_every_context_of_the_words_is_in_the_tree(spark):
    """As many contexts as the words have, whatever their number, and the sum over a word's grams is its score."""
    rng = np.random.default_rng(4)
    texts = [" ".join("".join(map(chr, rng.integers(97, 123, rng.integers(1, 12)))) for _ in range(3000)) for _ in range(20)]
    table = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    seen = context_tree.count_words(table, F.lit(False), context_tree.find_classes(np.zeros((0, 512)))).withColumn("id", F.monotonically_increasing_id())
    seen = stored(seen, "seen-words")
    model = context_tree.fit(seen, [20, 0, 0, 0, 0, 0])
    contexts = {(" " + word + " ")[max(0, i - 5) : i + 1] for text in texts for word in text.split() for i in range(len(word) + 1)}
    assert len(contexts) > 150_000
    name = F.col("name")
    assert model.scores.select(F.shiftright(name, 8)).distinct().count() == len(contexts)
    for row in model.words(seen).orderBy("word").limit(2).collect():
        leaves = context_tree.Leaves(context_tree.Positions.of([bytes(row["word"])]))
        grams = [*leaves.without_mark(), *leaves.with_mark(0x09)]
        assert model.of(np.array(grams)).sum() == pytest.approx(row["log_1"])


def test_quality_with_text_keys(spark):
    docs = spark.range(30).selectExpr("concat('d', id) AS doc_id", "if(id % 2 = 0, 'fine words here', 'spam spam spam') AS text")
    labels = docs.selectExpr("doc_id", "if(text like 'fine%', 1, 0) AS quality")
    found = {r["doc_id"]: r["score"] for r in quality.scores(docs, labels).collect()}
    assert len(found) == 30 and min(found[f"d{i}"] for i in range(0, 30, 2)) > max(found[f"d{i}"] for i in range(1, 30, 2))
