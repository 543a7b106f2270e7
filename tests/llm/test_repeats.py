"""Repeated strings by run-length indexes against a table of all windows."""

import hashlib
import random
from collections import Counter

import numpy as np
import pytest

from millrace.llm import run_length_index as rli
from millrace.llm.queries import op11_run_length_index
from millrace.sources.tables import Tables


def brute(rows, length=rli.LENGTH):
    texts = [(key, (text or "").encode()) for key, text in rows]
    windows = Counter(data[i : i + length] for _, data in texts for i in range(len(data) - length + 1))
    out = []
    for key, data in texts:
        gone = np.zeros(len(data) + 1, bool)
        for i in range(len(data) - length + 1):
            if windows[data[i : i + length]] > 1:
                gone[i : i + length] = True
        kept = bytes(np.frombuffer(data, np.uint8)[~gone[:-1]])
        runs = int((np.diff(gone.astype(int), prepend=0) == 1).sum())
        out.append((key, len(data), int(gone.sum()), runs, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def found(df):
    return sorted((tuple(row) for row in df.collect()), key=str)


def passages(seed, n, alphabet="abcdefgh é"):
    rng = random.Random(seed)
    shared = ["".join(rng.choices(alphabet, k=rng.choice([150, 199, 200, 201, 260, 700]))) for _ in range(6)]
    rows = []
    for i in range(n):
        parts = [rng.choice(shared) if rng.random() < 0.5 else "".join(rng.choices(alphabet, k=rng.randrange(300))) for _ in range(rng.randrange(5))]
        rows.append((i, "".join(parts)))
    return rows


def test_suffix_array_and_runs():
    rng = random.Random(2)
    for _ in range(60):
        pieces = [bytes(rng.choices(b"ab", k=rng.randrange(1, 40))) for _ in range(rng.randrange(1, 12))]
        text = np.frombuffer(b"\xff".join(pieces) + b"\xff", np.uint8) + np.uint8(1)
        ends = np.flatnonzero(text == 0)

        def suffix(i):
            end = ends[np.searchsorted(ends, i)]
            return bytes(text[i:end]), end  # an earlier end is smaller

        expected = sorted(range(len(text)), key=suffix)
        assert rli.suffix_array(text, rli._packed(text)).tolist() == expected
        index = rli.RunLengthIndex(text)
        assert index.lengths.sum() == len(text) and np.repeat(index.symbols, index.lengths).tolist() == text[np.array(expected) - 1].tolist()

        def common(i, j):
            a, b = suffix(i)[0], suffix(j)[0]
            return next((k for k in range(min(len(a), len(b))) if a[k] != b[k]), min(len(a), len(b)))

        statistics = [max((common(i, j) for j in range(len(text)) if j != i), default=0) for i in range(len(text))]
        inside = text > 0  # an end matches nothing, what is streamed there is not used
        assert (index.matching_statistics()[inside] == np.array(statistics)[inside]).all()


def test_anchors_cover_every_window_once(monkeypatch):
    data = np.random.default_rng(1).integers(97, 100, 5000).astype(np.uint8)
    whole = rli.anchors(data)
    assert whole[1].sum() == 5000 - 199 and (np.diff(whole[0]) == whole[1][:-1]).all() and (whole[2] >= 0).all() and (whole[2] <= 168).all()
    monkeypatch.setattr(rli, "_SLICE", 700)
    cut = rli.anchors(data)
    assert (np.repeat(whole[3], whole[1]) == np.repeat(cut[3], cut[1])).all()
    assert rli.anchors(data[:199])[0].tolist() == []


@pytest.mark.parametrize("options", [{}, {"hot": 2, "bucket_bytes": 3000}, {"hot": 0, "blocks": (16, 4, 1)}])
def test_random_passages(docs_of, options):
    rows = passages(1, 60)
    assert found(rli.without_repeats(docs_of(rows), **options)) == brute(rows)


def test_a_common_passage_in_other_surroundings(docs_of):
    rng = random.Random(3)
    passage = "".join(rng.choices("abcdefgh", k=330))
    rows = [(i, "".join(rng.choices("abcdefgh", k=150)) + passage + "".join(rng.choices("abcdefgh", k=150))) for i in range(40)]
    assert found(rli.without_repeats(docs_of(rows), hot=5)) == brute(rows)


def test_odd_rows(odd_docs, odd_rows, docs_of):
    more = [(20, "ab" * 500), (21, "x" * 250), (22, "b" * 199), (23, "b" * 199), (24, "c" * 200), (25, "d" * 200 + "e" * 200), (26, "d" * 200 + "f" * 3), (27, "é" * 100), (27, "é" * 100)]
    assert found(rli.without_repeats(odd_docs)) == brute([row[:2] for row in odd_rows])
    assert found(rli.without_repeats(docs_of(more))) == brute(more)
    assert rli.without_repeats(odd_docs.limit(0)).collect() == []


def test_given_documents(spark, folder):
    rows = [tuple(row) for row in Tables(spark, folder).documents.select("doc_id", "text").collect()]
    assert found(op11_run_length_index(spark, folder)) == brute(rows)
