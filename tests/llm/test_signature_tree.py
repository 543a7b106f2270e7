import random
import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest

from millrace.llm import signature_tree
from millrace.llm.shingles import shingle_sets


def word_sets(rows):
    found = {}
    for doc, text in rows:
        lowered = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        words = re.findall(r"[^\x20\x09-\x0D]+", lowered)
        found[doc] = {tuple(words[k : k + 5]) for k in range(len(words) - 4)} if len(words) >= 5 else ({tuple(words)} if words else set())
    return found


def brute_force(rows, percent=75):
    """Sizes and smallest reachable id, from counts of shared shingles."""
    sets, holders, shared = word_sets(rows), defaultdict(list), Counter()
    for doc, one in sets.items():
        for gram in one:
            holders[gram].append(doc)
    for docs in holders.values():
        shared.update((a, b) for a in docs for b in docs if a < b)
    root = {doc: doc for doc in sets}

    def top(doc):
        while root[doc] != doc:
            doc = root[doc]
        return doc

    for (a, b), both in shared.items():
        if 100 * both >= percent * (len(sets[a]) + len(sets[b]) - both):
            a, b = top(a), top(b)
            root[max(a, b)] = min(a, b)
    return {doc: (len(one), top(doc)) for doc, one in sets.items()}


def corpus(seed, copies):
    """Chains of edited copies around the threshold, a passage and a line in many, exact copies."""
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(400)]
    text = lambda n: [rng.choice(vocabulary) for _ in range(n)]
    passage, line = text(60), text(12)
    rows, base = [], text(80)
    for _ in range(copies):
        edited = list(base)
        for _ in range(rng.randrange(0, 5)):
            edited[rng.randrange(len(edited))] = rng.choice(vocabulary)
        rows.append(edited)
        if rng.random() < 0.3:
            base = edited
    rows += [line + passage + text(rng.randrange(5, 200)) for _ in range(40)]
    rows += [line + text(rng.randrange(0, 30)) for _ in range(40)] + [list(line)] * 5 + [text(k) for k in range(8)]
    rng.shuffle(rows)
    return [(i * 3, " ".join(words)) for i, words in enumerate(rows)]


@pytest.mark.parametrize("seed", [1, 2])
def test_same_groups_as_brute_force(spark, docs_of, seed):
    rows = corpus(seed, 150)
    found = signature_tree.near_duplicate_groups(docs_of(rows)).collect()
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in found} == brute_force(rows)


def test_same_groups_on_the_given_documents(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text")
    found = signature_tree.near_duplicate_groups(docs).collect()
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in found} == brute_force([tuple(r) for r in docs.collect()])


def test_long_lists_are_cut_without_losing_links(spark, docs_of, monkeypatch):
    monkeypatch.setattr(signature_tree, "BLOCK", 16)
    rows = corpus(5, 120)
    found = signature_tree.near_duplicate_groups(docs_of(rows)).collect()
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in found} == brute_force(rows)


def test_tree_leaves_every_pair_that_links():
    rng = np.random.default_rng(3)
    base = rng.integers(0, 2**62, 300, dtype=np.uint64)
    sets = [np.unique(np.concatenate((rng.choice(base, 280, replace=False), rng.integers(0, 2**62, k, dtype=np.uint64)))) for k in rng.integers(0, 120, 200)]
    bits = [signature_tree.bitmap(one, signature_tree.BITS) for one in sets]
    a, b = signature_tree.tree_pairs(np.array([len(s) for s in sets]), np.array(bits), np.arange(len(sets)))
    left = {tuple(sorted(pair)) for pair in zip(a.tolist(), b.tolist())}
    for i in range(len(sets)):
        for j in range(i):
            shared = len(np.intersect1d(sets[i], sets[j]))
            if 100 * shared >= 75 * (len(sets[i]) + len(sets[j]) - shared):
                assert (j, i) in left


def test_shingles_count_like_words():
    texts = ["A b  C d e f a b c d e", "", None, "one", "ONE", "a b", "x" * 9000 + " y", " lead and trail \n", "é É a b c d", "a\x1fb c d e f"]
    sets = shingle_sets(pa.array(texts))
    assert [len(s) for s in sets] == [len(s) for s in word_sets(enumerate(texts)).values()]
    assert sets[3].tolist() == sets[4].tolist() != sets[5].tolist()


def test_odd_rows(spark, odd_docs, odd_rows):
    found = signature_tree.near_duplicate_groups(odd_docs).collect()
    assert len(found) == len(odd_rows)
    by_id = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in found}
    expected = brute_force([(doc, text) for doc, text, *_ in odd_rows if doc is not None])
    assert {doc: value for doc, value in by_id.items() if doc is not None} == expected
    assert by_id[None] == (3, None)


def test_one_of_each_group(spark, odd_docs):
    kept = signature_tree.one_of_each_group(odd_docs)
    assert kept.columns == odd_docs.columns
    ids = sorted(r["doc_id"] for r in kept.filter("doc_id is not null").collect())
    assert ids == [1, 2, 3, 4, 5, 7, 8, 9, 10, 11]
    assert kept.filter("doc_id is null").count() == 1


def test_empty_table(spark, odd_docs):
    none = odd_docs.limit(0)
    assert signature_tree.near_duplicate_groups(none).collect() == []
    assert signature_tree.one_of_each_group(none).collect() == []
