"""Near-duplicate documents: a Jaccard join of word shingles by signature trees.

Exact copies of a shingle set are one entry. The root of the search routes an entry to every
shingle of its prefix: the first ``n - ceil(0.75 n) + 1`` of its ``n`` shingles in one order of
all shingles, frequent ones last. Two sets that link share a prefix shingle, whatever the
order. Under each shingle hangs a signature tree: its nodes hold the OR of their entries'
bitmaps, the range of their sizes and whether all of them are already connected. Trees are
traversed against each other from the top; a pair of nodes goes no further if sizes or the
largest possible overlap rule a link out, or if nothing is left to connect. What remains is
verified on the whole sets.

Before that, the first entry of each list is verified against the others, so that a group of
near copies enters the trees as connected already, and costs its size rather than its square.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from millrace.llm.graph import components
from millrace.llm.shingles import mix, shingle_sets
from millrace.llm.tools import forgetting, frequent, in_small_batches, portions, stored, unit, whole_row
from millrace.operators.joins import join_broadcasting

PERCENT = 75
#: Bits of a signature in the trees; of longer texts more bits are compared after the trees.
BITS, MOST_BITS = 2048, 1 << 18
FANOUT = 16
#: Entries of one list that are compared in one task.
BLOCK = 2048
#: Share of the documents that frequent shingles are looked for in, how often they must occur
#: there, and how many are put last at most. These only order the shingles.
HOT_SHARE, HOT_LEAST, HOT_MOST = 1 / 8, 4, 250_000

_U = np.uint64
_HIGH, _LOW = _U(0x9E3779B97F4A7C15), _U(0xD1B54A32D192ED03)


def least_overlap(n, m, percent: int = PERCENT):
    """Fewest shared shingles of sets of ``n`` and ``m`` that link: 100 |a & b| >= percent |a | b|."""
    return -(-percent * (n + m) // (100 + percent))


def prefix_length(n: int, percent: int = PERCENT) -> int:
    return n - -(-percent * n // 100) + 1 if n else 0


def _set_hash(tokens: np.ndarray) -> tuple[int, int]:
    both = [mix(tokens ^ salt).sum(dtype=_U).astype(np.int64) for salt in (_HIGH, _LOW)]
    return int(both[0]), int(both[1])


def set_sizes(docs: DataFrame, key: str = "doc_id") -> DataFrame:
    """``doc_id, n, high, low``: size and 128-bit hash of each document's shingle set."""

    def describe(batches):
        for batch in batches:
            for part in portions(batch, 1, 1 << 20):
                sets = shingle_sets(part.column(1))
                hashes = [_set_hash(tokens) for tokens in sets]
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column(0), pa.array([len(s) for s in sets], pa.int64()),
                        pa.array([h for h, _ in hashes], pa.int64()), pa.array([low for _, low in hashes], pa.int64()),
                    ],
                    names=["doc_id", "n", "high", "low"],
                )

    rows = docs.select(F.col(key).cast("long").alias("doc_id"), "text")
    return rows.mapInArrow(forgetting(describe), "doc_id long, n long, high long, low long")


def routes(docs: DataFrame, last: np.ndarray, percent: int = PERCENT) -> DataFrame:
    """``token, high, low``: each set under the shingles of its prefix, those in ``last`` put last."""

    def route(batches):
        seen: set[tuple[int, int]] = set()
        for batch in batches:
            for part in portions(batch, 0, 1 << 20):
                token, high, low, often = [], [], [], []
                for tokens in shingle_sets(part.column(0)):
                    if not len(tokens):
                        continue
                    name = _set_hash(tokens)
                    if name in seen:  # an exact copy adds nothing
                        continue
                    if len(seen) >= 200_000:
                        seen.clear()
                    seen.add(name)
                    take = prefix_length(len(tokens), percent)
                    if len(last):
                        at = np.minimum(np.searchsorted(last, tokens), len(last) - 1)
                        hot = last[at] == tokens
                        if hot.any():
                            tokens = np.concatenate((tokens[~hot], tokens[hot]))
                    token.append(tokens[:take])
                    high.append(name[0])
                    low.append(name[1])
                    often.append(take)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.concatenate(token).view(np.int64) if token else np.zeros(0, np.int64)),
                        pa.array(np.repeat(np.array(high, np.int64), often)), pa.array(np.repeat(np.array(low, np.int64), often)),
                    ],
                    names=["token", "high", "low"],
                )

    return docs.select("text").filter("text is not null").mapInArrow(forgetting(route), "token long, high long, low long")


def _frequent(docs: DataFrame, key: str, percent: int) -> np.ndarray:
    part = docs.filter(unit(key) < HOT_SHARE)
    counts = routes(part, np.zeros(0, _U), percent).groupBy("token").count().filter(F.col("count") >= HOT_LEAST)
    found = frequent(stored(counts, "tree-frequent"), "count", HOT_MOST).select("token").toArrow()  # HOT_MOST numbers at most
    return np.sort(found.column(0).to_numpy().view(_U))


def _of_wanted(docs: DataFrame, wanted: DataFrame, key: str) -> DataFrame:
    rows = docs.select(F.col(key).cast("long").alias("id"), "text")
    return join_broadcasting(rows, wanted, F.col("id") == F.col("rep"), "left_semi")


def bitmap(tokens: np.ndarray, size: int) -> np.ndarray:
    """``size`` bits, a power of two; folding the halves of a bitmap together gives that of half the size."""
    flags = np.zeros(size, bool)
    flags[(mix(tokens) & _U(size - 1)).astype(np.int64)] = True
    return np.packbits(flags).view(_U)


def signatures(docs: DataFrame, wanted: DataFrame, key: str = "doc_id") -> DataFrame:
    """``rep, n, bits, wide`` of the documents in ``wanted (rep)``: size and bitmaps of the set, at four bits a shingle the wide one."""

    def describe(batches):
        for batch in batches:
            for part in portions(batch, 1, 1 << 20):
                sets = shingle_sets(part.column(1))
                wide = [bitmap(s, min(max(BITS, 1 << (4 * len(s)).bit_length()), MOST_BITS)) for s in sets]
                bits = [np.bitwise_or.reduce(one.reshape(-1, BITS // 64)).tobytes() for one in wide]
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column(0), pa.array([len(s) for s in sets], pa.int64()),
                        pa.array(bits, pa.binary()), pa.array([one.tobytes() for one in wide], pa.binary()),
                    ],
                    names=["rep", "n", "bits", "wide"],
                )

    return _of_wanted(docs, wanted, key).mapInArrow(forgetting(describe), "rep long, n long, bits binary, wide binary")


def whole_sets(docs: DataFrame, wanted: DataFrame, key: str = "doc_id") -> DataFrame:
    """``rep, tokens`` of the documents in ``wanted (rep)``: the whole set."""

    def describe(batches):
        for batch in batches:
            for part in portions(batch, 1, 1 << 20):
                sets = [s.astype("<u8").tobytes() for s in shingle_sets(part.column(1))]
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(sets, pa.binary())], names=["rep", "tokens"])

    return _of_wanted(docs, wanted, key).mapInArrow(forgetting(describe), "rep long, tokens binary")


def _bitmaps(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), _U).reshape(-1, BITS // 64)


def may_link(n, m, bits_n, bits_m, percent: int = PERCENT) -> np.ndarray:
    """Whether sizes and bitmaps leave a link possible: a shingle whose bit the other lacks is not shared."""
    need = least_overlap(n, m, percent)
    only_n = np.bitwise_count(bits_n & ~bits_m).sum(axis=1, dtype=np.int64)
    only_m = np.bitwise_count(bits_m & ~bits_n).sum(axis=1, dtype=np.int64)
    return (np.minimum(n, m) >= need) & (n - only_n >= need) & (m - only_m >= need)


class Level:
    """The nodes of one level: OR of bitmaps, sizes from and to, least bits that a partner shares, component or -1."""

    def __init__(self, bits, low, high, need, component):
        self.bits, self.low, self.high, self.need, self.component = bits, low, high, need, component

    def above(self) -> Level:
        starts = np.arange(0, len(self.low), FANOUT)
        first, least = np.minimum.reduceat(self.component, starts), np.maximum.reduceat(self.component, starts)
        return Level(
            np.bitwise_or.reduceat(self.bits, starts, axis=0), np.minimum.reduceat(self.low, starts),
            np.maximum.reduceat(self.high, starts), np.minimum.reduceat(self.need, starts),
            np.where(first == least, first, -1),
        )

    def open_pairs(self, a: np.ndarray, b: np.ndarray, percent: int) -> np.ndarray:
        shared = np.bitwise_count(self.bits[a] & self.bits[b]).sum(axis=1, dtype=np.int64)
        return (
            ((self.component[a] != self.component[b]) | (self.component[a] < 0))
            & (100 * np.minimum(self.high[a], self.high[b]) >= percent * np.maximum(self.low[a], self.low[b]))
            & (shared >= np.maximum(self.need[a], self.need[b]))
        )


def tree_pairs(n: np.ndarray, bits: np.ndarray, component: np.ndarray, percent: int = PERCENT) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of positions that a traversal of the tree against itself leaves, not connected yet."""
    order = np.lexsort((n, component))
    n, bits = n[order], bits[order]
    component = np.unique(component[order], return_inverse=True)[1]
    slack = n - -(-percent * n // 100)
    levels = [Level(bits, n, n, np.bitwise_count(bits).sum(axis=1, dtype=np.int64) - slack, component)]
    while len(levels[-1].low) > FANOUT:
        levels.append(levels[-1].above())
    top = len(levels[-1].low)
    found_a, found_b = [], []
    a, b = np.triu_indices(top)
    todo = [(len(levels) - 1, a, b)]
    while todo:
        depth, a, b = todo.pop()
        if len(a) > 65_536:  # a bounded number of pairs at a time
            half = len(a) // 2
            todo += [(depth, a[:half], b[:half]), (depth, a[half:], b[half:])]
            continue
        if depth == 0:
            use = (a != b) & (component[a] != component[b])
            a, b = a[use], b[use]
            use = may_link(n[a], n[b], bits[a], bits[b], percent)
            found_a.append(order[a[use]])
            found_b.append(order[b[use]])
            continue
        use = levels[depth].open_pairs(a, b, percent)
        a, b = a[use], b[use]
        below = len(levels[depth - 1].low)
        child_a = (a[:, None, None] * FANOUT + np.arange(FANOUT)[None, :, None]).repeat(FANOUT, axis=2).reshape(-1)
        child_b = (b[:, None, None] * FANOUT + np.arange(FANOUT)[None, None, :]).repeat(FANOUT, axis=1).reshape(-1)
        use = (child_a <= child_b) & (child_b < below) & (child_a < below)
        if len(a):
            todo.append((depth - 1, child_a[use], child_b[use]))
    return (np.concatenate(found_a), np.concatenate(found_b)) if found_a else (np.zeros(0, np.int64),) * 2


def tree_candidates(lists: DataFrame, signed: DataFrame, percent: int = PERCENT) -> DataFrame:
    """``a, b`` left by the trees over ``token, rep, n, component`` and the bitmaps; long lists are cut into blocks."""
    sizes = lists.groupBy("token").count().filter(F.col("count") > BLOCK)
    long_lists = stored(sizes.select(F.col("token").alias("long_token"), F.ceil(F.col("count") / BLOCK).alias("parts")), "tree-long-lists")
    rows = join_broadcasting(lists, long_lists, F.col("token") == F.col("long_token"), "left")
    rows = rows.withColumn("parts", F.coalesce("parts", F.lit(1))).withColumn("part", F.pmod(F.xxhash64("rep"), "parts"))
    rows = rows.withColumn("with", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    rows = rows.join(signed.select(F.col("rep").alias("of"), "bits"), F.col("rep") == F.col("of"))
    rows = rows.select("token", F.least("part", "with").alias("low"), F.greatest("part", "with").alias("high"), "rep", "n", "bits", "component")
    placed = rows.repartition("token", "low", "high").sortWithinPartitions("token", "low", "high", "rep")

    def traverse(batches):
        held, seen = None, set()

        def runs(table: pa.Table, end: bool):
            keys = np.stack([table.column(i).to_numpy().astype(np.int64) for i in range(3)], axis=1)
            cuts = [0, *(np.flatnonzero((keys[1:] != keys[:-1]).any(axis=1)) + 1).tolist(), len(keys)]
            stop = len(cuts) - 1 if end else len(cuts) - 2
            rep, n, component = (table.column(i).to_numpy().astype(np.int64) for i in (3, 4, 6))
            bits = _bitmaps(table.column(5))
            out_a, out_b = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
            for start, to in zip(cuts[:stop], cuts[1 : stop + 1]):
                name = rep[start:to].tobytes()
                if to - start < 2 or name in seen:  # the same entries under another shingle
                    continue
                if len(name) <= 256 and len(seen) < 200_000:
                    seen.add(name)
                a, b = tree_pairs(n[start:to], bits[start:to], component[start:to], percent)
                out_a.append(rep[start:to][a])
                out_b.append(rep[start:to][b])
            rest = None if end else table.slice(cuts[stop])
            return rest, np.concatenate(out_a), np.concatenate(out_b)

        for batch in batches:
            if batch.num_rows:
                table = pa.Table.from_batches([batch])
                held = table if held is None else pa.concat_tables([held, table])
                held, a, b = runs(held, False)
                yield pa.RecordBatch.from_arrays([pa.array(np.minimum(a, b)), pa.array(np.maximum(a, b))], names=["a", "b"])
        if held is not None:
            _, a, b = runs(held, True)
            yield pa.RecordBatch.from_arrays([pa.array(np.minimum(a, b)), pa.array(np.maximum(a, b))], names=["a", "b"])

    return placed.mapInArrow(forgetting(traverse), "a long, b long").distinct()


def left_by_bitmaps(pairs: DataFrame, signed: DataFrame, percent: int = PERCENT) -> DataFrame:
    """Those of ``a, b`` that sizes and wide bitmaps do not rule out."""
    ends = [signed.select(F.col("rep").alias(f"{s}_rep"), F.col("n").alias(f"{s}_n"), F.col("wide").alias(f"{s}_wide")) for s in "ab"]
    rows = pairs.join(ends[0], F.col("a") == F.col("a_rep")).join(ends[1], F.col("b") == F.col("b_rep"))
    rows = rows.filter(F.least("a_n", "b_n") * 100 >= F.greatest("a_n", "b_n") * percent)

    def by_bits(batches):
        for batch in batches:
            use = []
            for n, x, m, y in zip(*(batch.column(i).to_pylist() for i in range(2, 6))):
                x, y = np.frombuffer(x, _U), np.frombuffer(y, _U)
                words = min(len(x), len(y))
                x, y = (np.bitwise_or.reduce(one.reshape(-1, words)) for one in (x, y))
                use.append(bool(may_link(np.array([n]), np.array([m]), x[None], y[None], percent)[0]))
            use = pa.array(use, pa.bool_())
            yield pa.RecordBatch.from_arrays([batch.column(0).filter(use), batch.column(1).filter(use)], names=["a", "b"])

    return rows.select("a", "b", "a_n", "a_wide", "b_n", "b_wide").mapInArrow(forgetting(by_bits), "a long, b long")


def verified(pairs: DataFrame, docs: DataFrame, percent: int = PERCENT, key: str = "doc_id") -> DataFrame:
    """Those of ``a, b`` whose whole sets link."""
    wanted = pairs.select(F.explode(F.array("a", "b")).alias("rep")).distinct()
    sets = stored(whole_sets(docs, stored(wanted, "tree-wanted"), key), "tree-sets")
    ends = [sets.select(F.col("rep").alias(f"{s}_rep"), F.col("tokens").alias(f"{s}_tokens")) for s in "ab"]
    rows = pairs.join(ends[0], F.col("a") == F.col("a_rep")).join(ends[1], F.col("b") == F.col("b_rep"))

    def by_sets(batches):
        for batch in batches:
            for part in (batch.slice(i, 256) for i in range(0, batch.num_rows, 256)):
                use = []
                for x, y in zip(part.column(2).to_pylist(), part.column(3).to_pylist()):
                    x, y = np.frombuffer(x, _U), np.frombuffer(y, _U)
                    shared = len(np.intersect1d(x, y, assume_unique=True))
                    use.append(100 * shared >= percent * (len(x) + len(y) - shared))
                use = pa.array(use, pa.bool_())
                yield pa.RecordBatch.from_arrays([part.column(0).filter(use), part.column(1).filter(use)], names=["a", "b"])

    return rows.select("a", "b", "a_tokens", "b_tokens").mapInArrow(forgetting(by_sets), "a long, b long")


def near_duplicate_groups(docs: DataFrame, percent: int = PERCENT, key: str = "doc_id") -> DataFrame:
    """``doc_id, n_shingles, component_id`` of every row of ``docs (doc_id, text)``.

    The component is the smallest id reachable over links of at least ``percent`` per cent
    Jaccard similarity, the document itself included. Null texts and texts without words link
    with nothing. Rows that share an id are one document, linked by any of its texts; a null id
    links with nothing. Extra columns are ignored.
    """
    docs = in_small_batches(docs.select(key, "text"))  # and with it all that is made of it here
    sizes = stored(set_sizes(docs, key), "tree-sizes")
    whole = sizes.filter("n > 0 and doc_id is not null")
    classes = stored(whole.groupBy("high", "low").agg(F.min("doc_id").alias("rep"), F.first("n").alias("n")), "tree-classes")

    known = docs.filter(F.col(key).isNotNull())
    placed = routes(known, _frequent(known, key, percent), percent)
    beside, every = Window.partitionBy("token").orderBy("high", "low"), Window.partitionBy("token")
    again = (F.lag("high").over(beside) == F.col("high")) & (F.lag("low").over(beside) == F.col("low"))
    once = placed.withColumn("again", F.coalesce(again, F.lit(False))).filter("not again")
    counted = once.select(
        "token", "high", "low", F.count("*").over(every).alias("members"),
        F.bit_xor("high").over(every).alias("all_high"), F.bit_xor("low").over(every).alias("all_low"),
    ).filter("members > 1")
    # Lists of the same members, as near copies have under most of their shingles, are one list.
    lists = counted.groupBy("members", "all_high", "all_low", "high", "low").agg(F.min("token").alias("token"))
    lists = stored(lists.join(classes, ["high", "low"]).select("token", "rep", "n").distinct(), "tree-lists")
    signed = stored(signatures(docs, stored(lists.select("rep").distinct(), "tree-listed"), key), "tree-signatures")

    head = F.min("rep").over(every)
    heads = lists.select(head.alias("a"), F.col("rep").alias("b")).filter("a != b").distinct()
    heads = stored(left_by_bitmaps(heads, signed, percent), "tree-heads")
    links = stored(verified(heads, docs, percent, key), "tree-head-links")
    joined = stored(components(links), "tree-head-components")

    rows = lists.join(joined, F.col("rep") == F.col("node"), "left").select("token", "rep", "n", F.coalesce("component", "rep").alias("component"))
    open_lists = rows.withColumn("closed", F.min("component").over(every) == F.max("component").over(every)).filter("not closed")
    open_lists = stored(open_lists.drop("closed"), "tree-open-lists")
    pairs = left_by_bitmaps(tree_candidates(open_lists, signed, percent), signed, percent)
    more = verified(stored(pairs, "tree-candidates"), docs, percent, key)
    links = stored(links.union(more), "tree-links")

    found = stored(components(links), "tree-components")
    members = classes.join(found, F.col("rep") == F.col("node"), "left").select(
        F.col("high").alias("of_high"), F.col("low").alias("of_low"), F.coalesce("component", "rep").alias("class_component")
    )
    members = stored(members, "tree-members")
    linked = (F.col("high") == F.col("of_high")) & (F.col("low") == F.col("of_low")) & (F.col("n") > 0) & F.col("doc_id").isNotNull()
    return sizes.join(members, linked, "left").select(
        "doc_id", F.col("n").alias("n_shingles"), F.coalesce("class_component", "doc_id").alias("component_id")
    )


def one_of_each_group(docs: DataFrame, percent: int = PERCENT, key: str = "doc_id") -> DataFrame:
    """The rows of ``docs`` without those of a group but its smallest id; of rows that share an id one stays.

    Rows without an id and documents without words stay.
    """
    groups = stored(near_duplicate_groups(docs, percent, key), "tree-groups")
    gone = stored(groups.filter("doc_id != component_id").select(F.col("doc_id").alias("gone_id")).distinct(), "tree-gone")
    rows = docs.select(whole_row(docs).alias("row"), F.col(key).cast("long").alias("id"))
    kept = join_broadcasting(rows, gone, F.col("id") == F.col("gone_id"), "left_anti")
    often = groups.filter("doc_id is not null").groupBy("doc_id").count().filter("count > 1").select(F.col("doc_id").alias("often_id"))
    often = stored(often, "tree-often")
    if often.isEmpty():
        return kept.select("row.*")
    same = F.col("id") == F.col("often_id")
    many = join_broadcasting(kept, often, same, "left_semi").groupBy("id").agg(F.min_by("row", F.xxhash64("row")).alias("row"))
    return join_broadcasting(kept, often, same, "left_anti").select("row.*").unionByName(many.select("row.*"))
