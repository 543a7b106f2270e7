"""How sources of one language differ in their words, by a recount over minimal perfect hashes.

The first pass finds the terms of each language that enough of its documents hold, exactly.
They are dealt into shards of a language by hash; each shard becomes a minimal perfect hash that
stores its keys, so a term that is not kept is told from one that is. The second pass reads the
texts again with the shards broadcast and adds up dense arrays, one slot per term, for each
(language, source). Sources are compared shard by shard on these arrays. Shards that exceed what one broadcast may hold go in rounds, each
over all texts, so the broadcast stays bounded whatever the vocabulary is.
"""

from __future__ import annotations

import re
from collections import Counter, defaultdict

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from millrace.llm.shingles import mix
from millrace.llm.tools import portions, raw_bytes, stored

LEAST_DOCS = 3
TOP = 200
SCALE = 1_000_000_000
SHARD_KEYS = 32_768
ROUND_BYTES = 48 << 20
_TERM = re.compile(rb"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")
_BETWEEN = r"[\x00-\x40\x5B-\x60\x7B-\x7F]+"
_U = np.uint64
#: What a task holds before it hands on counts: distinct terms, and slots.
_HELD_TERMS, _HELD_SLOTS = 200_000, 8 << 20
_LARGEST_BLOCK = 1 << 16
_COUNTS = "lang string, source string, shard int, salt int, slots array<int>, counts array<long>"


def terms(text: bytes) -> list[bytes]:
    """Runs of other characters than ASCII non-letters, A-Z lower-cased. A term never holds a zero byte."""
    return _TERM.findall(text.lower())  # of bytes: ASCII only


def _hashed(keys: list[bytes]) -> np.ndarray:
    return np.array([xxhash.xxh3_64_intdigest(key) for key in keys], dtype=_U)


def _places(hashed: np.ndarray, level: int, size: int) -> np.ndarray:
    return (mix(hashed + _U(level * 0x9E3779B97F4A7C15 % 2**64)) % _U(size)).astype(np.int64)


class PerfectHash:
    """Slots 0 to n-1 for n keys: levels of bitmaps, a key lies on the first where its bit is its own.

    The slot of a key is the rank of its bit over all levels; the keys themselves are kept in
    order of their slots. Keys whose hashes collide never part: they get slots at the end, found
    by search.
    """

    LEVELS = 40

    def __init__(self, keys: list[bytes]):
        hashed, rest, levels, placed = _hashed(keys), np.arange(len(keys)), [], []
        for level in range(self.LEVELS):
            if not len(rest):
                break
            size = max(64, 2 * len(rest))
            at = _places(hashed[rest], level, size)
            own = np.bincount(at, minlength=size)[at] == 1
            flags = np.zeros(size, bool)
            flags[at[own]] = True
            levels.append(flags)
            kept = rest[own]
            placed.append(kept[np.argsort(at[own])])
            rest = rest[~own]
        self.levels = levels
        self.ranks = [np.cumsum(flags) - 1 for flags in levels]
        self.first = np.concatenate(([0], np.cumsum([len(part) for part in placed]))).astype(np.int64)
        order = np.concatenate([*placed, rest]).astype(np.int64) if keys else rest
        self.keys = np.array([keys[i] for i in order.tolist()], dtype=object)
        self.extra = {keys[i]: int(self.first[-1]) + k for k, i in enumerate(rest.tolist())}

    def __len__(self) -> int:
        return len(self.keys)

    def slots(self, keys: np.ndarray, hashed: np.ndarray) -> np.ndarray:
        """The slot of each key, -1 for a key that is not stored."""
        found = np.full(len(keys), -1, np.int64)
        rest = np.arange(len(keys))
        for level, (flags, ranks) in enumerate(zip(self.levels, self.ranks)):
            at = _places(hashed[rest], level, len(flags))
            hit = flags[at]
            found[rest[hit]] = self.first[level] + ranks[at[hit]]
            rest = rest[~hit]
        for i in rest.tolist():
            found[i] = self.extra.get(keys[i], -1)
        some = np.flatnonzero(found >= 0)
        same = self.keys[found[some]] == keys[some]
        found[some[~same]] = -1
        return found

    def dump(self) -> bytes:
        """The keys in order of their slots; everything else follows from them."""
        return b"".join(len(key).to_bytes(4, "little") + key for key in self.keys.tolist())

    @staticmethod
    def parse(blob: bytes) -> list[bytes]:
        keys, at = [], 0
        while at < len(blob):
            size = int.from_bytes(blob[at : at + 4], "little")
            keys.append(blob[at + 4 : at + 4 + size])
            at += 4 + size
        return keys


def _document_terms(batches):
    """``lang, term, docs``: in how many documents of the batch each term is, added up before the shuffle."""
    counts: dict[bytes, Counter] = defaultdict(Counter)

    def flush():
        for lang, counter in counts.items():
            found = list(counter)
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang.decode()] * len(found), pa.string()), pa.array(found, pa.binary()).cast(pa.string()), pa.array(list(counter.values()), pa.int64())],
                names=["lang", "term", "docs"],
            )
        counts.clear()

    for batch in batches:
        for part in portions(batch, 1):
            for lang, text in zip(raw_bytes(part.column(0)), raw_bytes(part.column(1))):
                counts[lang].update(set(terms(text)))
            if sum(map(len, counts.values())) > _HELD_TERMS:
                yield from flush()
    yield from flush()


def _read(docs: DataFrame) -> DataFrame:
    return docs.select(*(F.coalesce(F.col(name).cast("string"), F.lit("")).alias(name) for name in ("lang", "text", "source")))


def kept_terms(docs: DataFrame, least: int = LEAST_DOCS) -> DataFrame:
    """``lang, term`` of the terms that at least ``least`` rows of the language hold."""
    found = _read(docs).select("lang", "text").mapInArrow(_document_terms, "lang string, term string, docs long")
    return found.groupBy("lang", "term").agg(F.sum("docs").alias("docs")).filter(F.col("docs") >= least).select("lang", "term")


def shards(vocabulary: DataFrame, shard_keys: int = SHARD_KEYS) -> DataFrame:
    """``lang, shards, shard, blob, size, keys``: a perfect hash per shard of about ``shard_keys`` terms of one language."""
    sizes = vocabulary.groupBy(F.col("lang").alias("of")).agg(F.ceil(F.count("*") / shard_keys).cast("int").alias("shards"))

    def dealt(batches):
        for batch in batches:
            of = np.array(batch.column(2).to_pylist(), dtype=_U)
            at = (_hashed(raw_bytes(batch.column(1))) % of).astype(np.int32) if len(of) else np.zeros(0, np.int32)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), batch.column(2), pa.array(at)], names=["lang", "term", "shards", "shard"])

    def build(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        blob = PerfectHash(sorted(term.encode() for term in rows["term"])).dump()
        return pd.DataFrame([(*key, blob, len(blob), len(rows))], columns=["lang", "shards", "shard", "blob", "size", "keys"])

    rows = vocabulary.join(sizes, F.col("lang") == F.col("of")).select("lang", "term", "shards")
    rows = rows.mapInArrow(dealt, "lang string, term string, shards int, shard int")
    built = rows.groupBy("lang", "shards", "shard").applyInPandas(build, "lang string, shards int, shard int, blob binary, size long, keys int")
    return stored(built, "divergence-shards")


def slots(hashes: DataFrame) -> DataFrame:
    """``lang, shard, slot, term`` of every stored key."""

    def listed(batches):
        for batch in batches:
            for row, (shard, blob) in enumerate(zip(batch.column(1).to_pylist(), batch.column(2).to_pylist())):
                found = PerfectHash.parse(blob)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).take(pa.array(np.full(len(found), row))), pa.array(np.full(len(found), shard, np.int32)),
                        pa.array(np.arange(len(found), dtype=np.int32)), pa.array(found, pa.binary()).cast(pa.string()),
                    ],
                    names=["lang", "shard", "slot", "term"],
                )

    return hashes.select("lang", "shard", "blob").mapInArrow(listed, "lang string, shard int, slot int, term string")


def recounted(docs: DataFrame, hashes: DataFrame, round_bytes: int = ROUND_BYTES) -> DataFrame:
    """``lang, source, shard, slots, counts``: occurrences of the kept terms in each (language, source), none of zero."""
    spark = docs.sparkSession
    # Shards are far smaller than half a round, so none of the rounds, dealt by hash, comes near the whole.
    rounds = max(1, -(-(hashes.agg(F.sum("size")).first()[0] or 0) * 2 // round_bytes))
    found = None
    for number in range(rounds):
        of_round = hashes.filter(F.pmod(F.xxhash64("lang", "shard"), F.lit(rounds)) == number)
        rows = of_round.select("lang", "shards", "shard", "blob").collect()  # round_bytes at most
        sent = spark.sparkContext.broadcast([(row["lang"], row["shards"], row["shard"], bytes(row["blob"])) for row in rows])
        part = stored(_read(docs).mapInArrow(_counting(sent), _COUNTS), "divergence-counts")
        found = part if found is None else found.unionAll(part)
    # Twice, so that no task adds up the arrays of all tasks for a group.
    kinds = "lang string, source string, shard int, {}slots array<int>, counts array<long>"
    for salt in (("salt",), ()):
        by = ("lang", "source", "shard", *salt)
        found = found.select(*by, "slots", "counts").groupBy(*by).applyInArrow(_added_up, kinds.format("salt int, " if salt else ""))
    return found


def _added_up(table: pa.Table) -> pa.Table:
    """The sum of the slot arrays of one group and shard."""
    table = table.combine_chunks()
    lists = [column.chunk(0) for column in (table.column("slots"), table.column("counts"))]
    slot, counts = (column.flatten().to_numpy() for column in lists)
    dense = np.zeros(int(slot.max()) + 1 if len(slot) else 0, np.int64)
    np.add.at(dense, slot, counts)
    kept = np.flatnonzero(dense)
    sums = {"slots": pa.array([kept.astype(np.int32)], pa.list_(pa.int32())), "counts": pa.array([dense[kept]], pa.list_(pa.int64()))}
    return pa.table({name: sums.get(name, table.column(name).slice(0, 1)) for name in table.column_names})


def _counting(sent):
    def count(batches):
        tables, dealt = {}, {}
        for lang, n_shards, shard, blob in sent.value:
            tables[lang, shard] = PerfectHash(PerfectHash.parse(blob))
            dealt[lang] = n_shards
        salt = TaskContext.get().partitionId() % 32
        dense: dict[tuple, np.ndarray] = {}
        held = 0

        def add(lang: str, sources: pa.Array, texts: pa.Array):
            """The terms of texts of one language: each different one is looked up once."""
            nonlocal held
            lists = pc.split_pattern_regex(pc.ascii_lower(texts), _BETWEEN)
            owner = np.repeat(np.arange(len(texts)), np.diff(lists.offsets.to_numpy()))
            coded = lists.flatten().dictionary_encode()
            found, at = np.array(raw_bytes(coded.dictionary), dtype=object), coded.indices.to_numpy()
            hashed = _hashed(found.tolist())
            shard = (hashed % _U(dealt[lang])).astype(np.int64)
            named = sources.dictionary_encode()
            order = np.argsort(named.indices.to_numpy()[owner], kind="stable")
            at, bounds = at[order], np.cumsum(np.bincount(named.indices.to_numpy()[owner], minlength=len(named.dictionary)))
            for of in np.unique(shard).tolist():
                if (lang, of) not in tables:
                    continue
                own = np.flatnonzero(shard == of)
                place = np.full(len(found), -1, np.int64)
                place[own] = tables[lang, of].slots(found[own], hashed[own])
                placed = place[at]
                for k, source in enumerate(named.dictionary.to_pylist()):
                    slot = placed[bounds[k - 1] if k else 0 : bounds[k]]
                    slot = slot[slot >= 0]
                    if len(slot):
                        if (lang, source, of) not in dense:
                            dense[lang, source, of] = np.zeros(len(tables[lang, of]), np.int64)
                            held += len(tables[lang, of])
                        np.add.at(dense[lang, source, of], slot, 1)

        def flush():
            nonlocal held
            for (lang, source, shard), counts in dense.items():
                slot = np.flatnonzero(counts)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([lang]), pa.array([source]), pa.array([shard], pa.int32()), pa.array([salt], pa.int32()),
                        pa.array([slot.astype(np.int32)], pa.list_(pa.int32())), pa.array([counts[slot]], pa.list_(pa.int64())),
                    ],
                    names=["lang", "source", "shard", "salt", "slots", "counts"],
                )
            dense.clear()
            held = 0

        for batch in batches:
            for part in portions(batch, 1):
                langs = part.column(0).dictionary_encode()
                for k, lang in enumerate(langs.dictionary.to_pylist()):
                    if lang in dealt:
                        own = part.take(pa.array(np.flatnonzero(langs.indices.to_numpy() == k)))
                        add(lang, own.column(2), own.column(1))
                if held > _HELD_SLOTS:
                    yield from flush()
        yield from flush()

    return count


def shares(counts: np.ndarray, total: int, kept: int) -> np.ndarray:
    """``1 + floor(SCALE * (count + 1) / (total + kept))``, exactly."""
    wide = counts.astype(object) if total >= 2**63 // SCALE - 1 else counts
    return (1 + SCALE * (wide + 1) // (total + kept)).astype(np.int64)


def _compared(key: tuple, cells: pa.Table, groups: pa.Table, top: int) -> pa.Table:
    """For one block of slots of a language: sums of the pair values, and the terms that mark each source most."""
    lang, shard, _, part = (value.as_py() for value in key)
    groups = groups.combine_chunks().sort_by("source")
    names, parts = groups.column("source").to_pylist(), groups.column("parts")[0].as_py()
    totals, kept, lang_total = groups.column("total").to_pylist(), groups.column("v")[0].as_py(), groups.column("lang_total")[0].as_py()
    where = {name: i for i, name in enumerate(names)}
    rows = [where[name] for name in cells.column("source").to_pylist()]
    lists = [[np.asarray(value.values) for value in cells.column(name)] for name in ("slots", "counts")]
    slot = np.unique(np.concatenate([np.zeros(0, np.int32), *lists[0]]))
    n = np.zeros((len(names), len(slot)), np.int64)
    for row, at, counts in zip(rows, *lists):
        n[row, np.searchsorted(slot, at)] = counts
    p = np.stack([shares(n[i], totals[i], kept) for i in range(len(names))]) if kept else n
    out = {"source": [], "item": [], "slot": [], "value": []}
    for i in range(part, len(names), parts):
        gap = p[i] - p
        others = [j for j in range(len(names)) if j != i]
        out["source"] += [names[i]] * len(others)
        out["item"] += [names[j] for j in others]
        out["slot"] += [None] * len(others)
        out["value"] += ((gap * gap // p).sum(axis=1)[others] if len(slot) else np.zeros(len(others), np.int64)).tolist()
    if part == 0 and len(slot):
        q = shares(n.sum(axis=0), lang_total, kept)
        for i, name in enumerate(names):
            own = np.flatnonzero((n[i] > 0) & (p[i] > q))
            value = (p[i] - q)[own] ** 2 // q[own]
            if len(own) > top:  # all that are as high as the last of the first ones: ties are settled by name later
                best = value >= np.partition(value, -top)[-top]
                own, value = own[best], value[best]
            out["source"] += [name] * len(own)
            out["item"] += [None] * len(own)
            out["slot"] += slot[own].tolist()
            out["value"] += value.tolist()
    size = len(out["source"])
    return pa.table({
        "lang": pa.array([lang] * size, pa.string()), "shard": pa.array([shard] * size, pa.int32()), "source": pa.array(out["source"], pa.string()),
        "item": pa.array(out["item"], pa.string()), "slot": pa.array(out["slot"], pa.int32()), "value": pa.array(out["value"], pa.int64()),
    })


def audit(docs: DataFrame, least: int = LEAST_DOCS, top: int = TOP, shard_keys: int = SHARD_KEYS, round_bytes: int = ROUND_BYTES) -> DataFrame:
    """``lang, source, part, item, value, rank``: how far sources are from each other, and which terms mark each.

    Part ``pair`` has every other source of the language; part ``term`` the first ``top`` kept
    terms that the source uses more than its language does. Null text, lang and source
    are empty strings; every row is a document, repeated or not; ids are not read. A source without
    terms has pairs and no terms; a language without kept terms has pairs of value 0. Equal values
    rank by item. An empty table gives an empty result. Columns beside text, lang and source are
    not read.
    """
    vocabulary = stored(kept_terms(docs, least), "divergence-terms")
    hashes = shards(vocabulary, shard_keys)
    counts = stored(recounted(docs, hashes, round_bytes), "divergence-recount")

    # One row per language, and per (language, source).
    sizes = hashes.groupBy(F.col("lang").alias("of")).agg(F.sum("keys").alias("v"))
    own = F.aggregate("counts", F.lit(0).cast("long"), lambda total, count: total + count)
    sums = counts.groupBy(F.col("lang").alias("l"), F.col("source").alias("s")).agg(F.sum(own).alias("total"))
    groups = _read(docs).select("lang", "source").distinct()
    groups = groups.join(sizes, F.col("lang") == F.col("of"), "left").join(sums, (F.col("lang") == F.col("l")) & (F.col("source") == F.col("s")), "left")
    groups = stored(groups.select("lang", "source", F.coalesce("v", F.lit(0)).alias("v"), F.coalesce("total", F.lit(0)).alias("total")), "divergence-groups")
    langs = groups.groupBy(F.col("lang").alias("of")).agg(F.sum("total").alias("lang_total"), F.count("*").alias("n_sources"))
    # A block has a few million counts, a part of it a million pairs.
    width = F.greatest(F.lit(1), F.least(F.lit(_LARGEST_BLOCK), F.floor(F.lit(4 << 20) / F.col("n_sources")))).cast("int").alias("width")
    parts = F.greatest(F.lit(1), F.ceil(F.col("n_sources") * F.col("n_sources") / (1 << 20))).cast("int").alias("parts")
    langs = stored(langs.select("of", "lang_total", width, parts), "divergence-languages")
    every_part = F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part")

    cells = counts.join(langs.select("of", "width", "parts"), F.col("lang") == F.col("of"))
    pairs = F.arrays_zip("slots", "counts")
    blocks = F.array_distinct(F.transform("slots", lambda slot: F.floor(slot / F.col("width")).cast("int")))
    cells = cells.select("lang", "source", "shard", "slots", "counts", pairs.alias("pairs"), "width", "parts", (F.size(blocks) == 1).alias("whole"), F.explode(blocks).alias("block"))
    inside = F.filter("pairs", lambda pair: F.floor(pair["slots"] / F.col("width")) == F.col("block"))
    cells = cells.select(
        "lang", "shard", "block", every_part, "source", F.when(F.col("whole"), F.col("slots")).otherwise(inside["slots"]).alias("slots"),
        F.when(F.col("whole"), F.col("counts")).otherwise(inside["counts"]).alias("counts"),
    )
    of_shards = hashes.select(F.col("lang").alias("l"), "shard", "keys")
    against = groups.join(langs, F.col("lang") == F.col("of")).join(of_shards, F.col("lang") == F.col("l"), "left")
    last = F.greatest(F.lit(0), F.floor((F.coalesce("keys", F.lit(1)) - 1) / F.col("width")).cast("int"))
    against = against.select("lang", F.coalesce("shard", F.lit(0)).alias("shard"), "source", "v", "total", "lang_total", "parts", every_part, last.alias("last"))
    against = against.select("*", F.explode(F.sequence(F.lit(0), F.col("last"))).alias("block")).drop("last")
    by = ("lang", "shard", "block", "part")

    def compare(key: tuple, left: pa.Table, right: pa.Table) -> pa.Table:
        return _compared(key, left, right, top)

    found = cells.groupBy(*by).cogroup(against.groupBy(*by)).applyInArrow(
        compare, "lang string, shard int, source string, item string, slot int, value long"
    )
    found = stored(found, "divergence-values")

    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    pairs = found.filter("slot is null").groupBy("lang", "source", "item").agg(F.sum("value").alias("value"))
    pairs = pairs.select("lang", "source", F.lit("pair").alias("part"), "item", "value", F.row_number().over(order).alias("rank"))
    names = slots(hashes).toDF("l", "h", "at", "term")
    marked = found.filter("slot is not null").drop("item").join(
        names, (F.col("lang") == F.col("l")) & (F.col("shard") == F.col("h")) & (F.col("slot") == F.col("at"))
    ).withColumnRenamed("term", "item")
    ranked = marked.select("lang", "source", F.lit("term").alias("part"), "item", "value", F.row_number().over(order).alias("rank"))
    return pairs.unionAll(ranked.filter(F.col("rank") <= top))
