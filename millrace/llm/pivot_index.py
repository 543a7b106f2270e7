"""Near-duplicate vectors by a pivot-permutation index.

A vector is described by its nearest pivots, in order. Inverted lists under pairs of pivots
bring together vectors that share at least two of them; a pair met in several lists belongs to
the list of its two smallest shared pivots, where its cosine is computed. Copies of a vector
are one entry with a count.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm.graph import components
from millrace.llm.tools import stored
from millrace.operators.joins import join_broadcasting

NEAREST = 6
#: Entries of an inverted list that one block compares with those of another.
BLOCK = 1024
#: The pivots are about the square root of the entries in number, between these bounds.
LEAST_PIVOTS, MOST_PIVOTS = 64, 1024


def _valid() -> Column:
    finite = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce(finite & F.exists("embedding", lambda x: x != 0), F.lit(False))


def _matrix(lists: pa.Array, width: int) -> np.ndarray:
    """Rows of a list column as unit vectors in double precision."""
    rows = lists.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, width)
    rows = rows / np.abs(rows).max(axis=1, keepdims=True)  # no overflow or underflow in the squares
    return rows / np.linalg.norm(rows, axis=1, keepdims=True)


def describe(entries: DataFrame, pivots: np.ndarray, nearest: int = NEAREST) -> DataFrame:
    """Add ``pivots``, the numbers of the nearest pivots in order, to ``rep, copies, embedding``."""

    def order(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            closeness = _matrix(batch.column(2), pivots.shape[1]) @ pivots.T
            found = np.argsort(-closeness, axis=1, kind="stable")[:, :nearest].astype(np.int32)
            offsets = np.arange(0, found.size + 1, found.shape[1], dtype=np.int32)
            lists = pa.ListArray.from_arrays(pa.array(offsets), pa.array(found.reshape(-1)))
            yield pa.RecordBatch.from_arrays([*batch.columns, lists], names=["rep", "copies", "embedding", "pivots"])

    kind = entries.schema["embedding"].dataType.simpleString()
    return entries.select("rep", "copies", "embedding").mapInArrow(
        order, f"rep long, copies long, embedding {kind}, pivots array<int>"
    )


def _labels(linked: np.ndarray) -> np.ndarray:
    """Smallest position reachable from each position of a symmetric matrix."""
    label = np.arange(len(linked))
    while True:
        lower = np.minimum(label, np.where(linked, label[None, :], len(linked)).min(axis=1, initial=len(linked)))
        if (lower == label).all():
            return label
        label = lower


def compare_block(key: tuple[int, int], same: bool, side, rep, copies, unit, pivots, threshold: float):
    """Links within one block of an inverted list: numbers of partners, and edges that keep what is connected.

    ``same`` says that the block is compared with itself; else rows of side 0 with rows of side 1.
    """
    first, second = key
    cosine = unit @ unit.T
    linked = cosine >= threshold
    np.fill_diagonal(linked, False)
    if not same:
        linked &= side[:, None] != side[None, :]
    if not linked.any():
        return None
    # The list owns a pair if of all pivots below its second one the two share only the first.
    below, number = np.unique(np.where(pivots < second, pivots, -1), return_inverse=True)
    has = np.zeros((len(rep), len(below)), np.float32)
    has[np.arange(len(rep))[:, None], number.reshape(pivots.shape)] = 1
    has[:, below < 0] = 0
    owned = linked & (has @ has.T == 1)
    partners = owned @ copies
    label = _labels(linked)
    return partners, label


def links(described: DataFrame, width: int, threshold: float, block: int = BLOCK) -> DataFrame:
    """``rep, partners, other``: how many vectors each entry links with, in parts, and an entry connected to it."""
    pairs = F.flatten(
        F.transform("pivots", lambda p: F.transform(F.filter("pivots", lambda q: q > p), lambda q: p.cast("long") * (1 << 31) + q))
    )
    rows = described.withColumn("key", F.explode(pairs))
    long_lists = rows.groupBy("key").count().filter(F.col("count") > block)
    long_lists = stored(long_lists.select(F.col("key").alias("long_key"), F.ceil(F.col("count") / block).alias("parts")), "pivot-long-lists")
    rows = join_broadcasting(rows, long_lists, F.col("key") == F.col("long_key"), "left")
    rows = rows.withColumn("parts", F.coalesce("parts", F.lit(1))).withColumn("part", F.pmod(F.xxhash64("rep"), "parts"))
    rows = rows.withColumn("with", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    rows = rows.select(
        "key", F.least("part", "with").alias("low"), F.greatest("part", "with").alias("high"),
        (F.col("part") > F.col("with")).alias("side"), "rep", "copies", "embedding", "pivots",
    )
    placed = rows.repartition("key", "low", "high").sortWithinPartitions("key", "low", "high", "rep")

    def compare(batches):
        held: pa.Table | None = None

        def blocks(table: pa.Table, last: bool):
            """Whole blocks of a sorted table; the last one may go on in the next batch."""
            keys = np.stack([table.column(i).to_numpy().astype(np.int64) for i in range(3)], axis=1)
            ends = [*(np.flatnonzero((keys[1:] != keys[:-1]).any(axis=1)) + 1).tolist(), len(keys)]
            stop = len(ends) if last else len(ends) - 1
            starts = [0, *ends]
            out = ([], [], [])
            for start, end in zip(starts[:stop], ends[:stop]):
                if end - start < 2:
                    continue
                part = table.slice(start, end - start).combine_chunks()
                key, low, high = (int(v) for v in keys[start])
                rep = part.column(4).to_numpy()
                found = compare_block(
                    (key >> 31, key & 0x7FFFFFFF), low == high, part.column(3).to_numpy(zero_copy_only=False),
                    rep, part.column(5).to_numpy(), _matrix(part.column(6).combine_chunks(), width),
                    part.column(7).combine_chunks().flatten().to_numpy().reshape(len(part), -1), threshold,
                )
                if found is not None:
                    partners, label = found
                    use = (partners > 0) | (label != np.arange(len(label)))
                    out[0].append(rep[use])
                    out[1].append(partners[use])
                    out[2].append(rep[label[use]])
            rest = None if last else table.slice(starts[stop])
            return rest, [np.concatenate(o) if o else np.zeros(0, np.int64) for o in out]

        for batch in batches:
            if not batch.num_rows:
                continue
            table = pa.Table.from_batches([batch])
            held = pa.concat_tables([held, table]).combine_chunks() if held is not None else table
            held, out = blocks(held, last=False)
            yield pa.RecordBatch.from_arrays([pa.array(o.astype(np.int64)) for o in out], names=["rep", "partners", "other"])
        if held is not None and held.num_rows:
            _, out = blocks(held, last=True)
            yield pa.RecordBatch.from_arrays([pa.array(o.astype(np.int64)) for o in out], names=["rep", "partners", "other"])

    return placed.mapInArrow(compare, "rep long, partners long, other long")


def near_duplicates(vectors: DataFrame, threshold: float = 0.9, pivots: int | None = None, nearest: int = NEAREST) -> DataFrame:
    """``vec_id, n_links, component_id, kept`` of every row of ``vectors (vec_id, embedding)``.

    Two vectors link if their cosine in double precision reaches ``threshold`` and they share two
    of their nearest pivots. Vectors that are null, empty, zero or hold null or non-finite values
    link with nothing; neither do vectors of different lengths. Repeated rows are vectors of
    their own. Pivots are distinct vectors chosen by hash, a bounded sample of the table.
    """
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), "embedding")
    valid = rows.filter(_valid() & F.col("vec_id").isNotNull())
    classes = valid.groupBy("embedding").agg(F.min("vec_id").alias("rep"), F.count("*").alias("copies"))
    classes = stored(classes, "pivot-classes")
    found = None
    for row in classes.groupBy(F.size("embedding").alias("width")).count().collect():  # one row per length
        width, entries = row["width"], classes.filter(F.size("embedding") == row["width"])
        number = pivots or int(min(max(row["count"] ** 0.5, LEAST_PIVOTS), MOST_PIVOTS))
        chosen = entries.orderBy(F.xxhash64("embedding"), "rep").limit(number).select("embedding").toArrow()
        matrix = _matrix(chosen.column(0).combine_chunks(), width)
        part = links(describe(entries, matrix, min(nearest, len(matrix))), width, threshold)
        if len(matrix) < 2:
            continue
        found = part if found is None else found.union(part)
    if found is None:
        found = vectors.sparkSession.createDataFrame([], "rep long, partners long, other long")
    found = stored(found, "pivot-links")
    joined = components(found.select(F.col("rep").alias("a"), F.col("other").alias("b")))
    counts = found.groupBy("rep").agg(F.sum("partners").alias("partners"))
    info = classes.join(counts, "rep", "left").join(joined, F.col("rep") == F.col("node"), "left")
    info = stored(
        info.select(
            F.col("embedding").alias("of"),
            (F.coalesce("partners", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
            F.coalesce("component", "rep").alias("component_id"),
        ),
        "pivot-info",
    )
    ok = _valid() & F.col("vec_id").isNotNull()
    key = F.when(ok, F.col("embedding"))
    result = rows.withColumn("key", key).join(info, F.col("key") == F.col("of"), "left").select(
        "vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), F.coalesce("component_id", "vec_id").alias("component_id")
    )
    return result.withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))
