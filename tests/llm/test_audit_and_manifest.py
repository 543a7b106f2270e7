"""The divergence audit and the Merkle manifest against their SQL, and their parts against brute force."""

import hashlib
import random
import zlib

import duckdb
import numpy as np
import pytest
from oracle import compare
from pyspark.sql import functions as F

from millrace.llm import divergence, merkle, sql
from millrace.llm.tools import fold



def lower():
    return F.translate("text", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")



@pytest.fixture
def same_as_sql(tmp_path):
    def check(df, docs, text):
        path = str(tmp_path / "documents.parquet")
        docs.write.mode("overwrite").parquet(path)
        connection = duckdb.connect()
        connection.execute(f"CREATE VIEW documents AS SELECT * FROM '{path}/*.parquet'")
        count, difference = compare(df, connection, text)
        assert difference is None
        return count

    return check


def random_docs(docs_of, n, seed):
    rng = random.Random(seed)
    words = ["Ab", "cd", "ef", "ÉT", "it's", "x1y", "中文", "gh", "ij", "kl"]
    rows = []
    for i in range(n):
        text = " ".join(rng.choices(words[: rng.randrange(2, 11)], k=rng.randrange(0, 12)))
        rows.append((rng.choice([i, i * 70_001, -i * 10**12, i % 7, None]), text, rng.choice(["en", "fr", None, ""]), rng.choice(["a", "a", "b", "é", None, ""])))
    return docs_of(rows)


def test_perfect_hash_is_minimal_and_tells_strangers():
    keys = [f"en\x00t{i}".encode() for i in range(3000)]
    table = divergence.PerfectHash(keys)
    asked = np.array([*keys, *(f"fr\x00t{i}".encode() for i in range(3000))], dtype=object)
    slots = table.slots(asked, divergence._hashed(asked.tolist()))
    assert sorted(slots[:3000].tolist()) == list(range(3000)) and (slots[3000:] == -1).all()
    assert [table.keys[s] for s in slots[:3000]] == keys
    again = divergence.PerfectHash(divergence.PerfectHash.parse(table.dump()))
    assert (again.slots(asked, divergence._hashed(asked.tolist()))[:3000] >= 0).all()


def test_perfect_hash_with_equal_hashes(monkeypatch):
    monkeypatch.setattr(divergence, "_hashed", lambda keys: np.array([len(k) for k in keys], dtype=np.uint64))
    keys = [b"aa", b"bb", b"c"]
    asked = np.array([*keys, b"dd", b"e"], dtype=object)
    assert sorted(divergence.PerfectHash(keys).slots(asked, divergence._hashed(asked))[:3].tolist()) == [0, 1, 2]
    assert divergence.PerfectHash(keys).slots(asked, divergence._hashed(asked))[3:].tolist() == [-1, -1]


@pytest.mark.parametrize("shard_keys, round_bytes", [(divergence.SHARD_KEYS, divergence.ROUND_BYTES), (3, 400)])
def test_audit_of_random_documents(docs_of, same_as_sql, monkeypatch, shard_keys, round_bytes):
    if shard_keys == 3:
        monkeypatch.setattr(divergence, "_LARGEST_BLOCK", 2)
    docs = random_docs(docs_of, 200, 3)
    assert same_as_sql(divergence.audit(docs, shard_keys=shard_keys, round_bytes=round_bytes), docs, sql.DIVERGENCE) > 0


def test_audit_of_odd_rows(odd_docs, same_as_sql):
    same_as_sql(divergence.audit(odd_docs), odd_docs, sql.DIVERGENCE)
    same_as_sql(divergence.audit(odd_docs.limit(0)), odd_docs.limit(0), sql.DIVERGENCE)


def test_audit_keeps_what_one_round_cannot_hold(docs_of, monkeypatch, same_as_sql):
    monkeypatch.setattr(divergence, "_HELD_TERMS", 3)
    monkeypatch.setattr(divergence, "_HELD_SLOTS", 2)
    docs = random_docs(docs_of, 60, 9)
    same_as_sql(divergence.audit(docs), docs, sql.DIVERGENCE)


def test_shares_of_large_counts_are_exact():
    counts = [0, 10**15, 9 * 10**15]
    assert divergence.shares(np.array(counts), 3 * 10**16, 7).tolist() == [1 + 10**9 * (n + 1) // (3 * 10**16 + 7) for n in counts]
    assert divergence.shares(np.array([5]), 9 * 10**9, 7).tolist() == [1 + 10**9 * 6 // (9 * 10**9 + 7)]


def test_rank_counts_smaller_numbers():
    rng = np.random.default_rng(1)
    for n in (1, 50, 4095, 4096, 30_000):
        lows = np.sort(rng.choice(1 << 16, n, replace=False))
        times = rng.integers(1, 4, n)
        bits, again = merkle.pack(lows, times)
        found = merkle.unpack(bits, again)
        assert (found[0] == lows).all() and (found[1] == times).all()
        assert (merkle.Rank(bits, again)(lows) == np.cumsum(times) - times).all()


def test_manifest_of_random_documents(docs_of, same_as_sql):
    docs = random_docs(docs_of, 700, 5)
    assert same_as_sql(merkle.manifest(docs, fold("doc_id", 5, 0), lower()), docs, sql.MERKLE) == 700


def test_manifest_of_odd_rows(odd_docs, same_as_sql):
    same_as_sql(merkle.manifest(odd_docs, fold("doc_id", 5, 0), lower()), odd_docs, sql.MERKLE)
    assert merkle.manifest(odd_docs.limit(0)).collect() == []


def test_manifest_by_hand(docs_of):
    """One source of 18 documents and a lone one, folded in plain Python."""
    docs = docs_of([(i, f"Text {i}", "en", "a") for i in range(18)] + [(99, None, None, None)])

    def digest(*parts):
        return hashlib.sha256("".join(parts).encode()).hexdigest()

    def part(value):
        return "-" if value is None else f"{len(str(value).encode())}:{value}"

    leaves = [digest(*map(part, (i, "a", "en", len(f"Text {i}"), f"Text {i}"))) for i in range(18)]
    left, right = digest(*leaves[:16]), digest(*leaves[16:])
    lone = digest(*map(part, (99, None, None, 0, None)))
    subroot = digest(left, right)
    root = digest(lone, subroot)
    found = {row["doc_id"]: row for row in merkle.manifest(docs, fold("doc_id", 5, 0), lower()).collect()}
    assert {row["root"] for row in found.values()} == {root}
    assert found[99]["subroot"] == found[99]["leaf"] == lone and found[99]["proof_sha256"] == digest(subroot)
    assert found[3]["proof_sha256"] == digest(*leaves[:3], *leaves[4:16], right, lone)
    assert found[17]["proof_sha256"] == digest(leaves[16], left, lone)
    for i in range(18):
        assert found[i]["verified"] == (zlib.crc32(str(i).encode()) % 5 != 0)
    assert {row["folded_root"] for row in merkle.manifest(docs).collect()} == {root}
