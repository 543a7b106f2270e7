"""Bytes that a long string covers which also starts elsewhere, by run-length Burrows-Wheeler indexes.

Every window of ``LENGTH`` bytes has an anchor, the 32 bytes of least hash inside it. Equal windows
have equal anchors at equal places, so windows are routed by the hash of their anchor: windows
whose anchor occurs once go no further, the others travel as fragments, the stretch of text
that all neighbouring windows with one anchor cover. A bucket of fragments becomes a
Burrows-Wheeler transform, compressed to its runs, with the text positions at the two ends of
each run and the matches there. Matching statistics are streamed from these samples: from one
byte to the next a match loses a byte until the next sample. A window is repeated where its
match, with what stands before or after it among the sorted suffixes, is as long as itself.

Equal texts and equal fragments are indexed once, with their number. An anchor that very many
different fragments share is divided by what they have in common on either side of it (windows
in blocks by their place around the anchor, routed by the bytes that all windows of the block
share; at last single windows, of which equal ones are one), so no bucket grows with the number
of copies.
"""

from __future__ import annotations

import hashlib
import uuid

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm.shingles import mix
from millrace.llm.tools import portions, raw_bytes, stored
from millrace.session import scratch_path

LENGTH = 200
_ANCHOR = 32
#: Window starts handled at once; a long text is cut into overlapping slices.
_SLICE = 1 << 20
_BITS = 21
BUCKET_BYTES = 1 << 20
#: An anchor with more different fragments than this is divided; blocks of so many windows, level by level.
HOT, BLOCKS = 2_000, (16, 1)

_U = np.uint64
_RANDOM = np.random.default_rng(0xB377)
_BYTE = _RANDOM.integers(0, 2**64, 256, dtype=_U)
_BASE = int(_RANDOM.integers(0, 2**62)) * 2 + 1

_SPANS = "array<struct<start:long,n:long>>"


# --- anchors --------------------------------------------------------------------------------


def _anchors_of_slice(data: np.ndarray, length: int) -> tuple[np.ndarray, ...]:
    hashed, step = _BYTE[data], 1
    while step < _ANCHOR:
        hashed = hashed[:-step] * _U(pow(_BASE, step, 2**64)) + hashed[step:]
        step *= 2
    hashed = mix(hashed)
    # The least hash, the first of equal ones: the place stands in the low bits.
    ranked = (hashed >> _U(_BITS) << _U(_BITS)) | np.arange(len(hashed), dtype=_U)
    width = length - _ANCHOR + 1
    blocks = np.full(-(-len(ranked) // width) * width, ~_U(0))
    blocks[: len(ranked)] = ranked
    blocks = blocks.reshape(-1, width)
    ahead = np.minimum.accumulate(blocks, axis=1).ravel()
    back = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    n = len(ranked) - width + 1
    at = (np.minimum(back[:n], ahead[width - 1 : width - 1 + n]) & _U((1 << _BITS) - 1)).astype(np.int64)
    start = np.concatenate(([0], np.flatnonzero(at[1:] != at[:-1]) + 1))
    return start, np.diff(np.append(start, n)), at[start] - start, hashed[at[start]]


def anchors(data: np.ndarray, length: int = LENGTH) -> tuple[np.ndarray, ...]:
    """Stretches of windows with one anchor: first window, number of windows, place of the anchor in the first, hash."""
    n = len(data) - length + 1
    parts = []
    for at in range(0, max(n, 0), _SLICE):
        start, *rest = _anchors_of_slice(data[at : min(at + _SLICE, n) + length - 1], length)
        parts.append((start + at, *rest))
    if not parts:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, _U)
    return tuple(np.concatenate(column) for column in zip(*parts))


# --- the index of one bucket ----------------------------------------------------------------


def _packed(text: np.ndarray) -> np.ndarray:
    """Eight symbols from each position on as one number, zeros behind the end."""
    word = np.zeros(len(text) + 8, _U)
    word[: len(text)] = text
    for bits, step in ((8, 1), (16, 2), (32, 4)):
        shifted = np.zeros_like(word)
        shifted[:-step] = word[step:]
        word = (word << _U(bits)) | shifted
    return word


def _first_zero(word: np.ndarray) -> np.ndarray:
    """The place of the first zero byte from the top, 8 if there is none."""
    found = np.full(len(word), 8, np.int64)
    for place in range(7, -1, -1):
        found[(word >> _U(56 - 8 * place)) & _U(255) == 0] = place
    return found


def suffix_array(text: np.ndarray, word: np.ndarray) -> np.ndarray:
    """Suffixes of symbols that end in 0; every 0 is an end of its own, an earlier one is smaller.

    By prefix doubling from eight symbols on; only suffixes that are still tied are sorted again.
    """
    n = len(text)
    zero = _first_zero(word[:n])
    cut = np.minimum(56 - 8 * zero, 56).clip(0).astype(_U)
    key = np.where(zero < 8, word[:n] >> cut << cut, word[:n])
    sa = np.argsort(key, kind="stable")
    ordered = key[sa]
    first = np.ones(n, bool)
    first[1:] = (ordered[1:] != ordered[:-1]) | (zero[sa[1:]] < 8)
    rank = np.empty(n, np.int64)
    rank[sa] = np.maximum.accumulate(np.where(first, np.arange(n), 0))
    step = 8
    while True:
        last = np.append(first[1:], True)
        tied = np.flatnonzero(~(first & last))
        if not len(tied):
            return sa
        at = sa[tied]
        pair = (rank[at] << 32) | rank[at + step]
        order = np.argsort(pair)
        at, pair = at[order], pair[order]
        sa[tied] = at
        parted = np.ones(len(tied), bool)
        parted[1:] = pair[1:] != pair[:-1]
        first[tied] = parted
        rank[at] = np.maximum.accumulate(np.where(parted, tied, 0))
        step *= 2


class RunLengthIndex:
    """A Burrows-Wheeler transform as runs: symbol, length, text position at both ends, match with the run before."""

    def __init__(self, text: np.ndarray):
        """``text``: symbols 1 to 255 in pieces that each end in 0."""
        self.size = len(text)
        word = _packed(text)
        sa = suffix_array(text, word)
        bwt = text[sa - 1]
        head = np.ones(self.size, bool)
        # What stands at the start of a piece has nothing before it: a run of its own.
        head[1:] = (bwt[1:] != bwt[:-1]) | (bwt[1:] == 0)
        rows = np.flatnonzero(head)
        self.symbols, self.lengths = bwt[rows], np.diff(np.append(rows, self.size))
        self.first, self.last = sa[rows], sa[np.append(rows[1:], self.size) - 1]
        self.match = np.zeros(len(rows), np.int64)
        self.match[1:] = self._common(word, self.last[:-1], self.first[1:])

    @staticmethod
    def _common(word: np.ndarray, one: np.ndarray, other: np.ndarray) -> np.ndarray:
        """How many symbols two positions share before they differ or their piece ends."""
        found, rest = np.zeros(len(one), np.int64), np.arange(len(one))
        while len(rest):
            a, b = word[one[rest] + found[rest]], word[other[rest] + found[rest]]
            same = np.minimum(_first_zero(a), 8)
            differ = a ^ b
            for place in range(7, -1, -1):
                same[((differ >> _U(56 - 8 * place)) & _U(255) != 0) & (same >= place)] = place
            found[rest] += same
            rest = rest[same == 8]
        return found

    def matching_statistics(self) -> np.ndarray:
        """For each text position, the longest match with any other position."""
        place = np.arange(self.size)
        best = np.zeros(self.size, np.int64)
        for at, match in ((self.first, self.match), (self.last, np.append(self.match[1:], 0))):
            reach, sampled = np.zeros(self.size, np.int64), np.zeros(self.size, np.int64)
            reach[at], sampled[at] = match + at, at
            np.maximum(best, reach[np.maximum.accumulate(sampled)] - place, out=best)
        return best


def repeated_windows(pieces: list[bytes], numbers: list[int], length: int = LENGTH) -> tuple[np.ndarray, ...]:
    """Runs of windows that occur elsewhere: piece, first window, number of windows.

    Pieces differ from each other; ``numbers`` says how often each occurs in the corpus.
    """
    sizes = np.array([len(piece) for piece in pieces], np.int64)
    ends = np.cumsum(sizes + 1)
    starts = ends - sizes - 1
    # UTF-8 has no byte 255, so every byte has a symbol above 0.
    text = np.frombuffer(b"\xff".join(pieces) + b"\xff", np.uint8) + np.uint8(1)
    repeated = RunLengthIndex(text).matching_statistics() >= length
    for piece in np.flatnonzero((np.array(numbers) > 1) & (sizes >= length)).tolist():
        repeated[starts[piece] : ends[piece] - length] = True
    edge = np.diff(np.concatenate(([False], repeated, [False])).astype(np.int8))
    first, after = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    piece = np.searchsorted(starts, first, side="right") - 1
    return piece, first - starts[piece], after - first


# --- stages ---------------------------------------------------------------------------------


def _flat(batch: pa.RecordBatch, names: list[str], rows: np.ndarray, columns: list) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(rows)), *columns], names=names)


def _texts(docs: DataFrame, text: str, length: int, name: str) -> DataFrame:
    """A bucketed table ``id, blob, copies`` of the different texts of at least ``length`` bytes.

    Buckets by the digest of the text, as many as the session's shuffle partitions: later joins
    on it move no text.
    """

    def pack(batches):
        squeeze = zstandard.ZstdCompressor(level=1)
        for batch in batches:
            for part in portions(batch, 0):
                long = [data for data in raw_bytes(part.column(0)) if data is not None and len(data) >= length]
                ids, blobs = [hashlib.md5(data).digest() for data in long], [squeeze.compress(data) for data in long]
                yield pa.RecordBatch.from_arrays([pa.array(ids, pa.binary()), pa.array(blobs, pa.binary())], names=["id", "blob"])

    spark = docs.sparkSession
    rows = docs.select(F.col(text).cast("string").alias("text")).mapInArrow(pack, "id binary, blob binary")
    found = rows.groupBy("id").agg(F.first("blob").alias("blob"), F.count("*").alias("copies"))
    writer = found.write.bucketBy(int(spark.conf.get("spark.sql.shuffle.partitions")), "id")
    writer.option("path", scratch_path(spark, "repeats-texts")).saveAsTable(name)
    return spark.table(name)


def _all_anchors(texts: DataFrame, length: int) -> DataFrame:
    """``id, place, key`` of every stretch; ``place`` holds first window, number of windows and place of the anchor."""

    def find(batches):
        expand = zstandard.ZstdDecompressor()
        for batch in batches:
            for row, blob in enumerate(batch.column(1).to_pylist()):
                start, n, at, key = anchors(np.frombuffer(expand.decompress(blob), np.uint8), length)
                yield _flat(batch, ["id", "place", "key"], np.full(len(start), row), [pa.array(start << 32 | n << 16 | at), pa.array(key.view(np.int64))])

    return texts.select("id", "blob").mapInArrow(_gathered(find), "id binary, place long, key long")


def _gathered(find):
    """Join small record batches into larger ones."""

    def gather(batches):
        held, rows = [], 0
        for batch in find(batches):
            held.append(batch)
            rows += batch.num_rows
            if rows >= 20_000:
                yield from pa.Table.from_batches(held).combine_chunks().to_batches()
                held, rows = [], 0
        if held:
            yield from pa.Table.from_batches(held).combine_chunks().to_batches()

    return gather


def _fragments(texts: DataFrame, hits: DataFrame, length: int) -> DataFrame:
    """``id, start, n, at, key, frag, piece`` of the stretches in ``hits``; a task gives the bytes of a fragment it knows no more."""

    def cut(batches):
        expand, seen = zstandard.ZstdDecompressor(), set()
        for batch in batches:
            lists = batch.column(2)
            bounds, places, keys = lists.offsets.to_numpy(), lists.values.field("place").to_numpy(), lists.values.field("key")
            for row, blob in enumerate(batch.column(1).to_pylist()):
                data, own = expand.decompress(blob), slice(bounds[row], bounds[row + 1])
                start, n, at = places[own] >> 32, places[own] >> 16 & 0xFFFF, places[own] & 0xFFFF
                ids, pieces = [], []
                for a, b in zip(start.tolist(), (start + n + length - 1).tolist()):
                    piece = data[a:b]
                    ids.append(hashlib.md5(piece).digest())
                    pieces.append(None if ids[-1] in seen else piece)
                    seen.add(ids[-1])
                if len(seen) > 100_000:
                    seen.clear()
                yield _flat(
                    batch, ["id", "start", "n", "at", "key", "frag", "piece"], np.full(len(start), row),
                    [pa.array(start), pa.array(n), pa.array(at), keys.slice(own.start, len(start)), pa.array(ids, pa.binary()), pa.array(pieces, pa.binary())],
                )

    # A list is no longer than its text.
    lists = hits.groupBy("id").agg(F.collect_list(F.struct("place", "key")).alias("hits"))
    rows = texts.select("id", "blob").join(lists, "id").select("id", "blob", "hits")
    return rows.mapInArrow(_gathered(cut), "id binary, start long, n long, at long, key long, frag binary, piece binary")


def _indexed(fragments: DataFrame, length: int, bucket_bytes: int) -> DataFrame:
    """``frag, spans`` of the fragments that hold repeated windows, bucket by bucket."""

    def index(table: pa.Table) -> pa.Table:
        piece, first, n = repeated_windows(table.column("piece").to_pylist(), table.column("number").to_pylist(), length)
        owners, at = np.unique(piece, return_index=True)
        spans = pa.StructArray.from_arrays([pa.array(first), pa.array(n)], ["start", "n"])
        lists = pa.ListArray.from_arrays(pa.array(np.append(at, len(piece)).astype(np.int32)), spans)
        return pa.table({"frag": table.column("frag").take(pa.array(owners)), "spans": lists})

    total = fragments.agg(F.sum(F.octet_length("piece"))).first()[0] or 0
    bucket = F.pmod(F.hash("key"), F.lit(max(1, -(-total // bucket_bytes))))
    return fragments.select("frag", "piece", "number", bucket.alias("bucket")).groupBy("bucket").applyInArrow(index, f"frag binary, spans {_SPANS}")


def _divided(fragments: DataFrame, block: int, length: int) -> tuple[DataFrame, DataFrame]:
    """Fragments cut into blocks of windows by their place around the anchor, and which fragment each is from.

    All windows of a block share ``length + 1 - block`` bytes; they become its key. Keys that
    occur once are left out.
    """
    blocks = F.sequence(F.floor((F.col("at") - F.col("n") + 1) / block), F.floor(F.col("at") / block))
    rows = fragments.select("frag", "key", "n", "at", "piece", "number", F.explode(blocks).alias("block"))
    ahead = F.col("at") - F.col("block") * block
    first, last = F.greatest(F.lit(0), ahead - block + 1), F.least(F.col("n") - 1, ahead)
    core = F.substring("piece", (ahead + 1).cast("int"), F.lit(length + 1 - block))
    rows = rows.select("frag", F.xxhash64("key", "block", core).alias("key"), first.alias("shift"), (last - first + 1).alias("n"), (F.col("at") - first).alias("at"), "number", "piece")
    known = rows.groupBy("key").agg(F.sum("number").alias("times")).filter("times > 1").select(F.col("key").alias("of"))
    # Stored, so that the join is of two plain shuffles and Spark can divide a key that many rows share.
    rows = rows.join(stored(known, "repeats-known"), F.col("key") == F.col("of"))
    part = F.substring("piece", (F.col("shift") + 1).cast("int"), (F.col("n") + length - 1).cast("int"))
    rows = rows.select(F.col("frag").alias("whole"), "shift", "key", "n", "at", "number", part.alias("piece"))
    rows = stored(rows.withColumn("frag", F.unhex(F.md5("piece"))), "repeats-divided")
    parts = rows.groupBy("frag").agg(*(F.first(name).alias(name) for name in ("key", "n", "at", "piece")), F.sum("number").alias("number"))
    return stored(parts, "repeats-parts"), rows.select("frag", "whole", "shift")


def _repeated(fragments: DataFrame, length: int, bucket_bytes: int, hot: int, blocks: tuple[int, ...]) -> DataFrame:
    """``frag, spans`` of repeated windows of different fragments ``frag, key, n, at, piece, number``."""
    crowded = fragments.groupBy("key").count().filter(F.col("count") > hot).select(F.col("key").alias("of"))
    crowded = stored(crowded, "repeats-crowded")
    if not blocks or not crowded.take(1):
        return stored(_indexed(fragments, length, bucket_bytes), "repeats-spans")
    same = F.col("key") == F.col("of")
    alone = stored(_indexed(fragments.join(crowded, same, "left_anti"), length, bucket_bytes), "repeats-spans")
    parts, origin = _divided(fragments.join(crowded, same, "left_semi"), blocks[0], length)
    found = _repeated(parts, length, bucket_bytes, hot, blocks[1:]).withColumnRenamed("frag", "part")
    moved = F.transform("spans", lambda s: F.struct((s["start"] + F.col("shift")).alias("start"), s["n"].alias("n")))
    whole = origin.join(found, F.col("frag") == F.col("part")).select(F.col("whole").alias("frag"), moved.alias("spans"))
    whole = whole.groupBy("frag").agg(F.flatten(F.collect_list("spans")).alias("spans"))
    return alone.unionAll(stored(whole, "repeats-spans"))


def _results(texts: DataFrame, spans: DataFrame, length: int) -> DataFrame:
    """``id, n_bytes, n_removed, n_spans, kept_sha256`` of every different text."""

    def remove(batches):
        expand = zstandard.ZstdDecompressor()
        for batch in batches:
            out, lists = [], batch.column(3)
            bounds, starts, counts = lists.offsets.to_numpy(), lists.values.field("start").to_numpy(), lists.values.field("n").to_numpy()
            for row, (blob, copies) in enumerate(zip(batch.column(1).to_pylist(), batch.column(2).to_pylist())):
                data, own = expand.decompress(blob), slice(bounds[row], bounds[row + 1])
                runs = [(0, len(data))] if copies > 1 else union(starts[own], starts[own] + counts[own] + length - 1)
                kept, at = hashlib.sha256(), 0
                for a, b in runs:
                    kept.update(data[at:a])
                    at = b
                kept.update(data[at:])
                out.append((len(data), sum(b - a for a, b in runs), len(runs), kept.hexdigest()))
            columns = zip(*out) if out else ([], [], [], [])
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.string())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *(pa.array(list(column), kind) for column, kind in zip(columns, kinds))],
                names=["id", "n_bytes", "n_removed", "n_spans", "kept_sha256"],
            )

    # A list is no longer than its text.
    lists = spans.groupBy("id").agg(F.collect_list(F.struct("start", "n")).alias("spans"))
    rows = texts.join(lists, "id", "left").select("id", "blob", "copies", F.coalesce("spans", F.array().cast(_SPANS)).alias("spans"))
    return rows.mapInArrow(remove, "id binary, n_bytes long, n_removed long, n_spans long, kept_sha256 string")


def union(starts: np.ndarray, ends: np.ndarray) -> list[tuple[int, int]]:
    """Disjoint ranges, none touching another, that cover the same bytes."""
    if not len(starts):
        return []
    order = np.argsort(starts, kind="stable")
    starts, reach = starts[order], np.maximum.accumulate(ends[order])
    new = np.flatnonzero(np.append(True, starts[1:] > reach[:-1]))
    return list(zip(starts[new].tolist(), reach[np.append(new[1:], len(starts)) - 1].tolist()))


def without_repeats(
    docs: DataFrame, key: str = "doc_id", text: str = "text", length: int = LENGTH, bucket_bytes: int = BUCKET_BYTES,
    hot: int = HOT, blocks: tuple[int, ...] = BLOCKS,
) -> DataFrame:
    """``key, n_bytes, n_removed, n_spans, kept_sha256`` of every row: what stays when repeated strings go.

    A byte goes where a string of ``length`` bytes that also starts anywhere else covers it;
    the other place may be in any row, also this one, and may overlap. Null and empty texts hold
    no bytes; a text below ``length`` stays whole. Rows with equal texts repeat each other and
    lose all, whatever their keys are; null and repeated keys give a row each. An empty table
    gives an empty result. Texts of any length are read whole, in slices. Columns beside key and
    text are not read.
    """
    spark: SparkSession = docs.sparkSession
    name = f"repeats_{uuid.uuid4().hex}"
    texts = _texts(docs, text, length, name)
    places = stored(_all_anchors(texts, length), "repeats-anchors")
    shared = stored(places.groupBy("key").count().filter("count > 1").select(F.col("key").alias("of")), "repeats-keys")
    hits = places.join(shared, F.col("key") == F.col("of")).select("id", "place", "key")
    pieces = stored(_fragments(texts, hits, length), "repeats-fragments")
    different = pieces.groupBy("frag").agg(
        F.first("piece", ignorenulls=True).alias("piece"), *(F.first(c).alias(c) for c in ("key", "n", "at")), F.count("*").alias("number")
    )
    found = _repeated(stored(different, "repeats-different"), length, bucket_bytes, hot, blocks).withColumnRenamed("frag", "of")
    spans = pieces.select("id", "start", "frag").join(found, F.col("frag") == F.col("of")).select("id", "start", F.explode("spans").alias("span"))
    spans = spans.select("id", (F.col("start") + F.col("span.start")).alias("start"), F.col("span.n").alias("n"))
    results = stored(_results(texts, spans, length), "repeats-results")
    spark.sql(f"DROP TABLE {name}")

    whole = F.coalesce(F.col(text).cast("string"), F.lit(""))
    rows = docs.select(
        F.col(key), F.octet_length(whole).cast("long").alias("own_bytes"), F.unhex(F.md5(whole.cast("binary"))).alias("of"),
        F.when(F.octet_length(whole) < length, F.sha2(whole, 256)).alias("own_sha256"),
    )
    rows = rows.toDF("key", "own_bytes", "of", "own_sha256").join(results, F.col("of") == F.col("id"), "left")
    return rows.select(
        F.col("key").alias(key), F.col("own_bytes").alias("n_bytes"), F.coalesce("n_removed", F.lit(0)).alias("n_removed"),
        F.coalesce("n_spans", F.lit(0)).alias("n_spans"), F.coalesce("kept_sha256", "own_sha256").alias("kept_sha256"),
    )
