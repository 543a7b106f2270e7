"""Merkle manifest of a table of documents, leaf coordinates by bitmap rank.

The place of a leaf among the leaves of its source is a rank query, not a sort. Documents of a
source whose ids share all but the last 16 bits form a chunk; each map task compresses the ids
it met of a chunk (sorted 16-bit numbers, or a bitmap where that is smaller), and the partial
bitmaps of a chunk are merged. A directory of counts, one level for every 16 bits of the id,
says how many documents lie before a chunk; popcounts of the words of its bitmap say how many
lie before an id within it. With the coordinates known, nodes are keyed by
(source, run) and fill arrays of 16 slots: one grouping per level, each a sixteenth of the last.

Ways from the leaves to the root are built from the top down, one join per level, and every
document folds its own leaf along its way.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.llm.tools import stored

FANOUT = 16
_LOW = 1 << 16
#: Where documents without an id are: before every chunk of a real id.
_NO_CHUNK = -(1 << 48)
_CHUNK = "source_key string, chunk long, bits binary, again binary, n long"
_STEP = "array<struct<left:string,right:string>>"


def field(value: Column) -> Column:
    """``-`` for null, else the UTF-8 byte count, ``:`` and the value as text."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf(text: Column) -> Column:
    fields = ("doc_id", "source", "lang", "n_chars")
    return F.sha2(F.concat(*(field(F.col(name)) for name in fields), field(text)), 256)


# --- bitmaps of ids -------------------------------------------------------------------------


def pack(lows: np.ndarray, times: np.ndarray) -> tuple[bytes, bytes]:
    """Sorted distinct 16-bit numbers as a bitmap or as themselves, whichever is smaller, and those that occur again."""
    if 2 * len(lows) < _LOW // 8:
        bits = lows.astype("<u2").tobytes()
    else:
        flags = np.zeros(_LOW, np.uint8)
        flags[lows] = 1
        bits = np.packbits(flags, bitorder="little").tobytes()
    more = np.flatnonzero(times > 1)
    return bits, np.stack([lows[more].astype(np.int64), times[more] - 1]).astype("<i8").tobytes()


def words_of(bits: bytes) -> np.ndarray:
    """The bitmap of a chunk as 1,024 words of 64 bits."""
    if len(bits) == _LOW // 8:
        return np.frombuffer(bits, "<u8")
    flags = np.zeros(_LOW, np.uint8)
    flags[np.frombuffer(bits, "<u2")] = 1
    return np.packbits(flags, bitorder="little").view("<u8")


def unpack(bits: bytes, again: bytes) -> tuple[np.ndarray, np.ndarray]:
    """The numbers of a chunk and how often each occurs."""
    if len(bits) == _LOW // 8:
        lows = np.flatnonzero(np.unpackbits(np.frombuffer(bits, np.uint8), bitorder="little"))
    else:
        lows = np.frombuffer(bits, "<u2").astype(np.int64)
    times = np.ones(len(lows), np.int64)
    low, more = np.frombuffer(again, "<i8").reshape(2, -1)
    times[np.searchsorted(lows, low)] += more
    return lows, times


class Rank:
    """How many documents of a chunk have a smaller number: a popcount directory over its words."""

    def __init__(self, bits: bytes, again: bytes):
        self.words = words_of(bits)
        self.before = np.concatenate(([0], np.cumsum(np.bitwise_count(self.words).astype(np.int64))))
        self.low, more = np.frombuffer(again, "<i8").reshape(2, -1)
        self.more = np.concatenate(([0], np.cumsum(more)))

    def __call__(self, lows: np.ndarray) -> np.ndarray:
        word, bit = lows >> 6, (lows & 63).astype(np.uint64)
        inside = self.words[word] & ((np.uint64(1) << bit) - np.uint64(1))
        return self.before[word] + np.bitwise_count(inside) + self.more[np.searchsorted(self.low, lows)]


def _partial(batches):
    for batch in batches:
        rows = batch.to_pandas()
        for (key, chunk), part in rows.groupby(["source_key", "chunk"], sort=False):
            lows, at = np.unique(part["low"].to_numpy(), return_inverse=True)
            times = np.bincount(at, weights=part["times"].to_numpy()).astype(np.int64)
            bits, again = pack(lows, times)
            yield pa.RecordBatch.from_pylist(
                [{"source_key": key, "chunk": chunk, "bits": bits, "again": again, "n": int(times.sum())}], schema=_SCHEMA
            )


_SCHEMA = pa.schema([("source_key", pa.string()), ("chunk", pa.int64()), ("bits", pa.binary()), ("again", pa.binary()), ("n", pa.int64())])


def _merged(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
    """The partial bitmaps of one chunk as one. At most 65,536 numbers each."""
    total = np.zeros(_LOW, np.int64)
    for bits, again in zip(rows["bits"], rows["again"]):
        lows, times = unpack(bits, again)
        total[lows] += times
    lows = np.flatnonzero(total)
    bits, again = pack(lows, total[lows])
    return pd.DataFrame([(*key, bits, again, int(total.sum()))], columns=["source_key", "chunk", "bits", "again", "n"])


def _directory(chunks: DataFrame) -> DataFrame:
    """Add ``base``: documents of the source in earlier chunks.

    The sums form a tree with a level for each 16 bits of the chunk's number, so a window holds
    at most 65,536 rows (98,304 at the top, with the place of missing ids), whatever the ids are.
    """
    sums, found, base = chunks.select("source_key", "chunk", "n"), chunks, F.lit(0)
    for level in (0, 16, 32):
        name, within = f"before{level}", [F.shiftright("chunk", 16)] if level < 32 else []
        order = Window.partitionBy("source_key", *within).orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
        before = sums.select(F.col("source_key").alias("of"), F.col("chunk").alias("c"), F.coalesce(F.sum("n").over(order), F.lit(0)).alias(name))
        found = found.join(before, (F.col("source_key") == F.col("of")) & (F.shiftright("chunk", level) == F.col("c"))).drop("of", "c")
        base = base + F.col(name)
        sums = sums.groupBy("source_key", F.shiftright("chunk", 16).alias("chunk")).agg(F.sum("n").alias("n"))
    return found.select("source_key", "chunk", "bits", "again", base.alias("base"))


def _ranked(key: tuple, leaves: pd.DataFrame, chunk: pd.DataFrame) -> pd.DataFrame:
    """The rank of every leaf of one chunk; leaves that share an id follow each other by digest."""
    lows = leaves["low"].to_numpy()
    place = Rank(chunk["bits"].iloc[0], chunk["again"].iloc[0])(lows) + chunk["base"].iloc[0]
    shared = leaves.duplicated("low", keep=False).to_numpy()
    if shared.any():
        ties = leaves.loc[shared, ["low", "leaf", "times"]].sort_values(["low", "leaf"])
        before = ties.groupby("low")["times"].cumsum() - ties["times"]
        place[shared] += before.reindex(leaves.index[shared]).to_numpy()
    return leaves.assign(place=place)[["source_key", "doc_id", "place", "times", "leaf", "tampered"]]


def coordinates(rows: DataFrame) -> DataFrame:
    """``source_key, doc_id, place, leaf, tampered`` of every row of ``source_key, doc_id, leaf, tampered``.

    ``place`` counts from 0 in each source. Equal rows are counted before the shuffle and take
    places of their own again at the end.
    """
    leaves = rows.groupBy("source_key", "doc_id", "leaf", "tampered").agg(F.count("*").alias("times"))
    leaves = leaves.withColumns({
        "chunk": F.coalesce(F.shiftright("doc_id", 16), F.lit(_NO_CHUNK)),
        "low": F.coalesce(F.col("doc_id").bitwiseAND(_LOW - 1), F.lit(0)),
    })
    leaves = stored(leaves, "manifest-leaves")
    chunks = leaves.select("source_key", "chunk", "low", "times").mapInArrow(_partial, _CHUNK).groupBy("source_key", "chunk").applyInPandas(_merged, _CHUNK)
    directory = _directory(stored(chunks, "manifest-bitmaps"))
    by = ("source_key", "chunk")
    placed = leaves.groupBy(*by).cogroup(directory.groupBy(*by)).applyInPandas(
        _ranked, "source_key string, doc_id long, place long, times long, leaf string, tampered string"
    )
    copy = F.explode(F.sequence(F.lit(0).cast("long"), F.col("times") - 1))
    return placed.select("source_key", "doc_id", "place", "leaf", "tampered", copy.alias("copy")).select(
        "source_key", "doc_id", (F.col("place") + F.col("copy")).alias("place"), "leaf", "tampered"
    )


# --- levels of a tree -----------------------------------------------------------------------


def reduced(nodes: DataFrame, payload: tuple[str, ...] = ()) -> list[DataFrame]:
    """The runs of every level over ``tree, place, n, digest``: ``tree, place, n, digest, slots``.

    ``n`` is the number of nodes of the tree on a row's level; levels end when every tree is down
    to one. Columns named in ``payload`` ride along in the slots of the first level.
    """
    levels: list[DataFrame] = []
    while nodes.filter("n > 1").limit(1).count():
        slot = F.struct(F.col("place").bitwiseAND(FANOUT - 1).cast("int").alias("slot"), "digest", *payload)
        runs = nodes.filter("n > 1").groupBy("tree", "n", F.shiftright("place", 4).alias("run")).agg(F.sort_array(F.collect_list(slot)).alias("slots"))
        digest = F.sha2(F.array_join(F.transform("slots", lambda s: s["digest"]), ""), 256)
        above = F.shiftright(F.col("n") + FANOUT - 1, 4)
        nodes = stored(runs.select("tree", F.col("run").alias("place"), above.alias("n"), digest.alias("digest"), "slots"), "manifest-level")
        levels.append(nodes)
        payload = ()
    return levels


def roots(nodes: DataFrame, levels: list[DataFrame]) -> DataFrame:
    """``tree, digest``: what remains of each tree, a lone leaf itself."""
    found = nodes.filter("n = 1").select("tree", "digest")
    for level in levels:
        found = found.unionAll(level.filter("n = 1").select("tree", "digest"))
    return found


def ways(levels: list[DataFrame], top: DataFrame, payload: tuple[str, ...] = ()) -> DataFrame:
    """``tree, place, digest, way`` of the nodes of the first level: the siblings, left and right, on each level up.

    ``top`` (``tree, way``) has the way on from each tree's root.
    """
    from_roots = top.select(F.col("tree").alias("of"), F.col("way").alias("rest"))
    down = None
    for level in reversed(levels):
        last = level is levels[0]
        whole = level.filter("n = 1").join(from_roots, F.col("tree") == F.col("of")).select("tree", "place", "slots", "rest")
        if down is not None:
            up = down.select(F.col("tree").alias("of"), F.col("place").alias("at"), F.col("way").alias("rest"))
            inner = level.filter("n > 1").join(up, (F.col("tree") == F.col("of")) & (F.col("place") == F.col("at")))
            whole = whole.unionAll(inner.select("tree", "place", "slots", "rest"))

        def side(smaller: bool) -> Column:
            others = F.filter("slots", lambda s: s["slot"] < F.col("own.slot") if smaller else s["slot"] > F.col("own.slot"))
            return F.array_join(F.transform(others, lambda s: s["digest"]), "")

        nodes = whole.select("tree", "place", "slots", "rest", F.explode("slots").alias("own"))
        step = F.array(F.struct(side(True).alias("left"), side(False).alias("right")))
        nodes = nodes.select(
            "tree", (F.col("place") * FANOUT + F.col("own.slot")).alias("place"), F.col("own.digest").alias("digest"),
            F.concat(step, "rest").alias("way"), *(F.col("own")[name].alias(name) for name in (payload if last else ())),
        )
        # The nodes of the first level are as many as the documents; they are used once and not written.
        down = nodes if last else stored(nodes, "manifest-ways")
    return down


def numbered(keys: DataFrame, column: str) -> DataFrame:
    """``column, place``: distinct non-null keys numbered in ascending order, by ranges, without a sort into one task."""

    def number(batches):
        part, at = TaskContext.get().partitionId(), 0
        for batch in batches:
            n = batch.num_rows
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(np.full(n, part, np.int32)), pa.array(np.arange(at, at + n))], names=[column, "part", "at"])
            at += n

    ranged = keys.select(column).distinct().repartitionByRange(column).sortWithinPartitions(column)
    local = stored(ranged.mapInArrow(number, f"{column} string, part int, at long"), "manifest-order")
    sizes = local.groupBy("part").agg(F.count("*").alias("n"))
    # One row per task that numbered.
    order = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    base = sizes.select(F.col("part").alias("of"), F.coalesce(F.sum("n").over(order), F.lit(0)).alias("base"))
    return local.join(base, F.col("part") == F.col("of")).select(column, (F.col("base") + F.col("at")).alias("place"))


def manifest(docs: DataFrame, tampered: Column | None = None, tampered_text: Column | None = None) -> DataFrame:
    """``doc_id, leaf, subroot, root, proof_sha256, folded_root, verified`` of every row of ``docs``.

    ``tampered`` says which rows are changed before they are verified, and ``tampered_text``
    what their text becomes; without them nothing is. Nulls are the field ``-``; a null source is
    a source of its own, before all others; rows without an id come first in their source. Rows
    that share source and id follow each other by digest, repeated rows stand side by side. Texts
    of any length are hashed whole. Columns beside ``doc_id, source, lang, n_chars, text`` are not
    read. An empty table gives an empty result.
    """
    source_key = F.coalesce(F.concat(F.lit("1"), "source"), F.lit("0"))
    changed = F.when(tampered, leaf(tampered_text)) if tampered is not None else F.lit(None).cast("string")
    rows = docs.select(source_key.alias("source_key"), F.col("doc_id").cast("long").alias("doc_id"), leaf(F.col("text")).alias("leaf"), changed.alias("tampered"))
    placed = stored(coordinates(rows), "manifest-places")
    sizes = placed.groupBy("source_key").agg(F.count("*").alias("n")).withColumnRenamed("source_key", "of")
    nodes = placed.join(sizes, F.col("source_key") == F.col("of")).select(
        F.col("source_key").alias("tree"), "place", "n", F.col("leaf").alias("digest"), "doc_id", "tampered"
    )
    nodes = stored(nodes, "manifest-nodes")
    payload = ("doc_id", "tampered")
    levels = reduced(nodes, payload)
    subroots = stored(roots(nodes, levels), "manifest-subroots")

    order = numbered(subroots, "tree").withColumnRenamed("tree", "of")
    n_sources = subroots.count()
    leaves = subroots.join(order, F.col("tree") == F.col("of")).select(
        F.lit("").alias("tree"), "place", F.lit(n_sources).cast("long").alias("n"), "digest", F.col("of").alias("source_key")
    )
    leaves = stored(leaves, "manifest-sources")
    above = reduced(leaves, ("source_key",))
    root = roots(leaves, above).first()
    none = F.array().cast(_STEP)
    if above:
        start = leaves.sparkSession.range(1).select(F.lit("").alias("tree"), none.alias("way"))
        top = ways(above, start, ("source_key",))
    else:
        top = leaves.withColumn("way", none)
    top = stored(top.select(F.col("source_key").alias("tree"), F.col("digest").alias("subroot"), "way"), "manifest-top")

    lone = nodes.filter("n = 1").join(top.withColumnRenamed("tree", "of"), F.col("tree") == F.col("of")).select("tree", "digest", "way", *payload)
    found = lone.unionAll(ways(levels, top, payload).select("tree", "digest", "way", *payload)) if levels else lone
    found = found.join(top.select(F.col("tree").alias("of"), "subroot"), F.col("tree") == F.col("of"))
    proof = F.sha2(F.array_join(F.transform("way", lambda s: F.concat(s["left"], s["right"])), ""), 256)
    folded = F.aggregate("way", F.coalesce("tampered", "digest"), lambda acc, s: F.sha2(F.concat(s["left"], acc, s["right"]), 256))
    found = found.select(
        "doc_id", F.col("digest").alias("leaf"), "subroot", F.lit(root["digest"] if root else None).cast("string").alias("root"),
        proof.alias("proof_sha256"), folded.alias("folded_root"),
    )
    return found.withColumn("verified", F.col("folded_root") == F.col("root"))
