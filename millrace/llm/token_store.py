"""Token ids in ORC: run-length encoded integers, row indexes, Bloom filters on the document id.

Documents are dealt to write tasks by ranges of their id, so each file holds one range in
ascending order, and stripes can be read in parallel or skipped by their statistics. A file
knows where its documents start within itself; a small second table, one row per write task,
says how many ids come before it.
"""

from __future__ import annotations

import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from millrace.llm.shingles import mix
from millrace.llm.tools import held, in_small_batches, portions

END_ID = 0
_U = np.uint64
_RANDOM = np.random.default_rng(0x70CE)
_BASES, _BYTES = _RANDOM.integers(0, 2**63, 2, dtype=_U) * _U(2) + _U(1), _RANDOM.integers(0, 2**64, (2, 256), dtype=_U)
_STORED = "doc_id long, shard int, at long, n_tokens long, ids array<int>"


class Known:
    """Ids of pieces that were encoded before, in a few arrays: about 30 bytes a piece, found by 128 bits of hash."""

    def __init__(self, room: int, kind: type):
        self.room = room
        self.clear(kind)

    def clear(self, kind: type) -> None:
        self.first, self.second = np.zeros(0, _U), np.zeros(0, _U)
        self.start, self.size, self.ids = np.zeros(0, np.int64), np.zeros(0, np.int32), np.zeros(0, kind)

    def find(self, first: np.ndarray, second: np.ndarray) -> np.ndarray:
        """The place of each piece, -1 for those not known."""
        at = np.searchsorted(self.first, first)
        at[at == len(self.first)] = 0
        if not len(self.first):
            return np.full(len(first), -1)
        return np.where((self.first[at] == first) & (self.second[at] == second), at, -1)

    def add(self, first: np.ndarray, second: np.ndarray, size: np.ndarray, ids: np.ndarray) -> None:
        """Pieces, how many ids each has, and these ids one after the other."""
        if len(self.first) + len(first) > self.room:
            self.clear(self.ids.dtype.type)
        start = len(self.ids) + np.cumsum(size, dtype=np.int64) - size
        order = np.argsort(first, kind="stable")
        at = np.searchsorted(self.first, first[order])
        for name, values in (("first", first), ("second", second), ("start", start), ("size", size.astype(np.int32))):
            setattr(self, name, np.insert(getattr(self, name), at, values[order]))
        self.ids = np.concatenate((self.ids, ids.astype(self.ids.dtype)))


class Encoder:
    """Ids of whole texts, as the library gives them.

    The vocabulary's pre-tokenizer never joins what lies before a single space or newline with
    what follows, so pieces between them are encoded by themselves: every different piece of a
    batch once, and once in the life of a worker while there is room. A text that holds a piece which cannot
    stand alone (next to runs of white space, or with a special token) goes through the library whole.
    """

    #: What stands before a piece: a space, the start of the text, the start of a later line.
    BEFORE = (" ", "", "\n")
    #: Pieces up to so many bytes are remembered.
    SHORT = 64
    #: So many new pieces go to the library at once.
    TOGETHER = 2000

    def __init__(self, path: str, room: int = 3_000_000):
        self.tokenizer = Tokenizer.from_file(path)
        self.special = [token.content for token in self.tokenizer.get_added_tokens_decoder().values()]
        self.known = Known(room, np.uint16 if self.tokenizer.get_vocab_size() <= 1 << 16 else np.uint32)

    def whole(self, text: str) -> np.ndarray:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, dtype="<u4")

    def _together(self, pieces: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of pieces that each follow a space, told apart by the places of their characters, and how many each has."""
        ids, sizes = [np.zeros(0, "<u4")], [np.zeros(0, np.int64)]
        for first in range(0, len(pieces), self.TOGETHER):
            part = pieces[first : first + self.TOGETHER]
            encoding = self.tokenizer.encode(" " + " ".join(part), add_special_tokens=False)
            starts = np.cumsum([0] + [len(piece) + 1 for piece in part])
            of = np.searchsorted(starts, np.array([at for at, _ in encoding.offsets]), side="right") - 1
            ids.append(np.array(encoding.ids, dtype="<u4"))
            sizes.append(np.bincount(of, minlength=len(part)))
        return np.concatenate(ids), np.concatenate(sizes)

    def _alone(self, piece: str) -> bool:
        return bool(piece) and not (piece[0].isspace() or piece[-1].isspace() or any(token in piece for token in self.special))

    @staticmethod
    def _hashes(pieces: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Two hashes of each piece, and its bytes. Only those of short pieces are used."""
        offsets = np.frombuffer(pieces.buffers()[1], np.int32)[pieces.offset : pieces.offset + len(pieces) + 1].astype(np.int64)
        sizes, longest = np.diff(offsets), Encoder.SHORT
        data = np.frombuffer(pieces.buffers()[2], np.uint8) if pieces.buffers()[2] else np.zeros(0, np.uint8)
        one, two = sizes.astype(_U), sizes.astype(_U)
        rows = np.flatnonzero(sizes <= longest)
        for place in range(longest):
            rows = rows[sizes[rows] > place]
            if not len(rows):
                break
            byte = data[offsets[rows] + place]
            one[rows] = one[rows] * _BASES[0] + _BYTES[0][byte]
            two[rows] = two[rows] * _BASES[1] + _BYTES[1][byte]
        return one, two, sizes

    def encode(self, texts: pa.Array, end_id: int) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts one after the other, each with the end id, and how many each has. Null is empty."""
        if not len(texts):
            return np.zeros(0, "<u4"), np.zeros(0, np.int64)
        texts = pc.fill_null(texts, "")
        lines = pc.split_pattern(texts, "\n")
        pieces = pc.split_pattern(lines.flatten(), " ")
        line_at = pieces.offsets.to_numpy().astype(np.int64)
        text_at = line_at[lines.offsets.to_numpy()]
        line_at, text_at = line_at - text_at[0], text_at - text_at[0]
        coded = pieces.flatten().dictionary_encode()
        # A batch of less than 2**31 bytes has less than 2**31 / 3 different pieces.
        code = coded.indices.to_numpy() * np.int32(3)
        kind = np.zeros(len(code), np.int8)
        kind[line_at[:-1]] = 2
        kind[text_at[:-1]] = 1
        code += kind
        del lines, pieces, kind
        present = np.zeros(3 * len(coded.dictionary), bool)
        present[code] = True
        different = np.flatnonzero(present)

        of, before = different // 3, different % 3
        one, two, sizes = self._hashes(coded.dictionary)
        one, two = mix(one[of] + before.astype(_U)), mix(two[of] + before.astype(_U))
        place = np.where(sizes[of] <= self.SHORT, self.known.find(one, two), -1)
        extra: dict[int, np.ndarray] = {}
        new = np.flatnonzero(place < 0)
        if len(new):
            named = coded.dictionary.take(pa.array(of[new])).to_pylist()
            alone = [i for i, piece in enumerate(named) if self._alone(piece)]
            spaced = [i for i in alone if before[new[i]] == 0 and sizes[of[new[i]]] <= self.SHORT]
            ids, counts = self._together([named[i] for i in spaced])
            single = {i: self.whole(self.BEFORE[before[new[i]]] + named[i]) for i in sorted({*alone} - {*spaced})}
            short = [i for i in single if sizes[of[new[i]]] <= self.SHORT]
            rows = new[np.array(spaced + short, np.int64)]
            ids = np.concatenate([ids, *(single[i] for i in short)])
            self.known.add(one[rows], two[rows], np.append(counts, [len(single[i]) for i in short]).astype(np.int64), ids)
            # Adding moves places, and may have made room by forgetting.
            place = np.where(sizes[of] <= self.SHORT, self.known.find(one, two), -1)
            extra = {int(new[i]): found for i, found in single.items() if place[new[i]] < 0}
            if (place[np.setdiff1d(np.arange(len(different)), new)] < 0).any():
                return self.encode(texts, end_id)  # now into an empty memory
        size = np.where(place >= 0, self.known.size[place] if len(self.known.size) else 0, 0).astype(np.int64)
        start = np.where(place >= 0, self.known.start[place] if len(self.known.start) else 0, 0)
        table, at = [self.known.ids.astype("<u4") if extra else self.known.ids], len(self.known.ids)
        for row, found in extra.items():
            size[row], start[row] = len(found), at
            table.append(found)
            at += len(found)
        table = np.concatenate(table) if extra else table[0]

        which = (np.cumsum(present, dtype=np.int32) - np.int32(1))[code]
        n = size[which]
        ends = np.cumsum(n)
        at = np.repeat(start[which] - ends + n, n)
        at += np.arange(ends[-1])
        values = table[at].astype("<u4")
        del which, at
        joined = np.append(0, np.cumsum(n == 0))
        bounds = np.append(0, ends)[text_at]
        out, counts, end = [], np.diff(bounds) + 1, np.array([end_id], "<u4")
        for row in range(len(texts)):
            if joined[text_at[row + 1]] == joined[text_at[row]]:
                out.append(values[bounds[row] : bounds[row + 1]])
            else:
                out.append(self.whole(texts[row].as_py()))
                counts[row] = len(out[-1]) + 1
            out.append(end)
        return np.concatenate(out), counts


def encoder_of(path: str) -> Encoder:
    """One encoder per worker process, so that what it remembers serves the next task too."""
    return held(("encoder", path), lambda: Encoder(path))


def encoded(docs: DataFrame, tokenizer_path: str, end_id: int = END_ID, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Ids of each document with the end id, in ascending order of ``key``, dealt by ranges of it.

    Null and empty texts hold the end id alone; documents with equal or null keys all stay,
    nulls first, equal keys in order of their text. Other columns are not kept.
    """
    def encode(batches):
        encoder, shard, at = encoder_of(tokenizer_path), TaskContext.get().partitionId(), 0
        for batch in batches:
            # A few megabytes of text at a time; a longer text stands alone.
            for part in portions(batch, 1):
                values, sizes = encoder.encode(part.column(1), end_id)
                offsets = np.concatenate(([0], np.cumsum(sizes)))
                lists = pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), pa.array(values.view("<i4")))
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(np.full(len(sizes), shard, np.int32)), pa.array(at + offsets[:-1]), pa.array(sizes), lists],
                    names=["doc_id", "shard", "at", "n_tokens", "ids"],
                )
                at += int(offsets[-1])

    rows = docs.select(F.col(key).cast("long").alias("doc_id"), F.col(text).alias("text"))
    # The hash keeps many rows of one key divisible.
    ranged = rows.repartitionByRange("doc_id", F.xxhash64("text")).sortWithinPartitions("doc_id", F.xxhash64("text"), "text")
    return in_small_batches(ranged).mapInArrow(encode, _STORED)


def write_tokens(docs: DataFrame, folder: str, tokenizer_path: str | None = None, end_id: int = END_ID) -> None:
    """Write ``folder/tokens`` (ORC) and ``folder/shards`` (where each file begins)."""
    path = tokenizer_path or public_tokenizers.path("byte_bpe_50k.json")
    writer = encoded(docs, path, end_id).write
    for name, value in {
        "compression": "zstd",
        "orc.bloom.filter.columns": "doc_id",
        "orc.bloom.filter.fpp": "0.01",
        "orc.row.index.stride": "1000",
        "orc.stripe.size": str(16 << 20),
    }.items():
        writer = writer.option(name, value)
    writer.orc(f"{folder}/tokens")
    spark = docs.sparkSession
    sizes = spark.read.schema(_STORED).orc(f"{folder}/tokens").groupBy("shard").agg(F.sum("n_tokens").alias("n"))
    # One row per write task.
    before = F.coalesce(F.sum("n").over(Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    sizes.select("shard", before.alias("base")).coalesce(1).write.orc(f"{folder}/shards")


def read_tokens(spark: SparkSession, folder: str) -> DataFrame:
    """``doc_id, start, n_tokens, ids`` of every stored document; filters on ``doc_id`` skip stripes."""
    tokens = spark.read.schema(_STORED).orc(f"{folder}/tokens")
    shards = spark.read.schema("shard int, base long").orc(f"{folder}/shards")
    # Broadcast: one row per file.
    return tokens.join(F.broadcast(shards), "shard").select(
        "doc_id", (F.col("base") + F.col("at")).alias("start"), "n_tokens", "ids"
    )


def digests(tokens: DataFrame) -> DataFrame:
    """``doc_id, start, n_tokens`` and the crc32 of the ids as little-endian 32-bit integers."""

    def digest(batches):
        for batch in batches:
            lists = batch.column(3)
            offsets = lists.offsets.to_numpy()
            data = memoryview(np.ascontiguousarray(lists.values.to_numpy(zero_copy_only=False), dtype="<i4")).cast("B")
            sums = [zlib.crc32(data[4 * a : 4 * b]) for a, b in zip(offsets[:-1], offsets[1:])]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:3], pa.array(sums, pa.int64())], names=["doc_id", "start", "n_tokens", "ids_crc32"]
            )

    rows = in_small_batches(tokens.select("doc_id", "start", "n_tokens", "ids"))
    return rows.mapInArrow(digest, "doc_id long, start long, n_tokens long, ids_crc32 long")
