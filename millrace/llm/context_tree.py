"""Code lengths of texts by context-tree weighting over bytes.

A text is its words, ASCII letters in lower case, each followed by a space, and an end byte. A
byte's context is what precedes it in its word, back to the boundary before the word. The
boundary is one of six marks, the class of the text: a text's probability is the mixture of its
probabilities under each class. Classes are found without labels, on all training texts, by their
pairs of bytes: every pass over them is a Spark job that sums up by class. Bytes are coded as eight binary decisions; every decision has a tree of contexts whose nodes hold
Krichevsky-Trofimov estimates, mixed over all depths by their weights (half for the node
itself, half for its children). Counts come from all training texts. As all that a word's
probability depends on is the word, counting and scoring are done once per distinct word, and
documents are scored by their words.

Every context stays, however rare, so the tree grows with the input. It is a stored table of
grams, built in buckets of whole contexts of three bytes, and words are joined to it; the driver
sees the nodes of contexts of two bytes at most. A context without counts predicts as its parent does.
"""

from __future__ import annotations

import math
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm.tools import frequent, portions, raw_bytes, stored

DEPTH = 6
#: Bytes of the contexts that stay together in a bucket, and grams of a bucket, about.
_TOP, _BUCKET = 3, 20_000
#: Words that every task holds with their scores; other words are scored by a join.
FREQUENT = 150_000
_SPACE, _END = 0x20, 0x0A
#: The marks before words: no byte that a word can have.
_MARKS = (0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D)
#: Buckets of pairs of bytes, and which one each pair is in.
_PAIRS = 512
_BUCKET_OF = (np.arange(1 << 16, dtype=np.int64) * 0x9E3779B1 >> 7) % _PAIRS
#: Logarithms of classes are multiples of this, so that sums over up to 2**28 pairs are exact in any order.
_GRAIN = 2.0**-20
#: Texts whose pairs are looked at together, and pairs that a text has at least where a class starts.
_TOGETHER, _LONG = 1000, 500
#: Bytes of words that a task spreads out at once.
_PORTION = 1 << 19
_LOG10_2 = math.log10(2.0)


def words_of(text: bytes | None) -> list[bytes]:
    """Words between ASCII white space, A-Z in lower case."""
    return text.lower().split() if text else []


def pair_counts(text: bytes | None) -> np.ndarray:
    """How often each bucket of pairs of bytes occurs in a text."""
    data = np.frombuffer(b" " + (text or b"") + b" ", np.uint8)
    return np.bincount(_BUCKET_OF[(data[:-1].astype(np.int32) << 8) | data[1:]], minlength=_PAIRS)


def _packed(counts: np.ndarray) -> bytes:
    """Counts of a text in as few bytes each as the largest needs."""
    return counts.astype(np.min_scalar_type(int(counts.max())).newbyteorder("<")).tobytes()


def _unpacked(batches):
    """Some rows of counts at a time, from batches of ``pairs``."""
    for column in (batch.column(0).slice(i, _TOGETHER) for batch in batches for i in range(0, batch.num_rows, _TOGETHER)):
        sizes = pc.binary_length(column)
        for width in (1, 2, 4, 8):
            rows = column.filter(pc.equal(sizes, width * _PAIRS)).to_pylist()
            if rows:
                yield np.frombuffer(b"".join(rows), f"<u{width}").reshape(-1, _PAIRS).astype(float)


def _farthest(counts: np.ndarray, chosen: list[np.ndarray]) -> tuple[float, bytes]:
    """How far the text farthest from those ``chosen`` is, and its counts; without any, the longest text.

    Short texts come last. Of equally far ones the bytes of the counts decide.
    """
    value = total = counts.sum(axis=1)
    if chosen:
        shares = np.sqrt(counts / total[:, None])
        far = [((shares - np.sqrt(one / one.sum())) ** 2).sum(axis=1) for one in chosen]
        value = np.where(total >= _LONG, np.min(far, axis=0), -1.0)
    most = value.max()
    return float(most), min(row.astype("<i8").tobytes() for row in counts[value == most])


def _sums(counts: np.ndarray, logs: np.ndarray) -> np.ndarray:
    """Counts summed over the texts of each class, and in the last column how many texts it has."""
    member = (counts @ logs.T).argmax(axis=1)
    sums = [np.append(counts[member == k].sum(axis=0), (member == k).sum()) for k in range(len(logs))]
    return np.stack(sums).astype(np.int64)


def _farthest_of(texts: DataFrame, chosen: list[np.ndarray]) -> tuple[float, bytes] | None:
    """``_farthest`` of a table of ``pairs``; None of an empty one."""

    def search(batches):
        found = [_farthest(counts, chosen) for counts in _unpacked(batches)]
        value, pairs = zip(*found) if found else ((), ())
        yield pa.RecordBatch.from_arrays([pa.array(value, pa.float64()), pa.array(pairs, pa.binary())], names=["value", "pairs"])

    row = texts.mapInArrow(search, "value double, pairs binary").orderBy(F.desc("value"), "pairs").first()
    return (row["value"], bytes(row["pairs"])) if row else None


def _sums_of(texts: DataFrame, logs: np.ndarray) -> np.ndarray:
    """``_sums`` of a table of ``pairs``."""

    def add(batches):
        total = sum((_sums(counts, logs) for counts in _unpacked(batches)), np.zeros((len(logs), _PAIRS + 1), np.int64))
        k, pair = np.nonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(k.astype(np.int32)), pa.array(pair.astype(np.int32)), pa.array(total[k, pair])], names=["k", "pair", "n"])

    found = texts.mapInArrow(add, "k int, pair int, n long").groupBy("k", "pair").agg(F.sum("n").alias("n")).collect()  # classes times buckets at most
    sums = np.zeros((len(logs), _PAIRS + 1), np.int64)
    for row in found:
        sums[row["k"], row["pair"]] = row["n"]
    return sums


def find_classes(texts: np.ndarray | DataFrame, rounds: int = 15) -> np.ndarray:
    """Log-probabilities of the buckets in each class: a hard-assignment mixture of multinomials.

    Found on the counts of all ``texts``, rows of an array or of a table of ``pairs``; rounds end when nothing changes.
    """
    whole = isinstance(texts, DataFrame)
    farthest, sums = (_farthest_of, _sums_of) if whole else (_farthest, _sums)
    chosen: list[np.ndarray] = []
    for _ in _MARKS:  # texts far from those chosen before, among texts of some length
        found = farthest(texts, chosen) if whole or len(texts) else None
        if found is None:
            return np.full((len(_MARKS), _PAIRS), -math.log(_PAIRS))
        chosen.append(np.frombuffer(found[1], "<i8").astype(float))
    logs = _class_logs(np.stack(chosen))
    for _ in range(rounds):
        before, logs = logs, _class_logs(sums(texts, logs)[:, :-1])
        if (logs == before).all():
            break
    return logs


def _class_logs(sums: np.ndarray) -> np.ndarray:
    logs = np.log((sums + 0.5) / (sums + 0.5).sum(axis=1, keepdims=True))
    return np.round(logs / _GRAIN) * _GRAIN


@dataclass
class Positions:
    """Every coded byte of some words, with its context.

    ``length`` counts the bytes of the context. Its nearest byte is the lowest of ``context``; in
    the ``marked`` ones the farthest is the mark before the word, held as a space.
    """

    byte: np.ndarray
    length: np.ndarray
    context: np.ndarray
    marked: np.ndarray
    word: np.ndarray

    @classmethod
    def of(cls, words: list[bytes], depth: int = DEPTH) -> Positions:
        flat = np.frombuffer(b" " + b" ".join(words) + b" ", np.uint8).astype(np.int64) if words else np.full(1, _SPACE, np.int64)
        sizes = np.array([len(word) + 1 for word in words], dtype=np.int64)
        word = np.repeat(np.arange(len(words)), sizes)
        place = np.arange(len(word)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        length = np.minimum(place + 1, depth)
        context = np.zeros(len(word), np.int64)
        for k in range(depth):
            context[k:] |= np.where(length[k:] > k, flat[: len(word) - k], 0) << (8 * k) if k < len(word) else 0
        return cls(flat[1:], length, context, place < depth, word)

    def under(self, mark: int, rows: np.ndarray) -> np.ndarray:
        """Contexts of marked rows with the mark of a class."""
        return self.context[rows] ^ ((_SPACE ^ mark) << (8 * (self.length[rows] - 1)))


def _mask(depth: int) -> int:
    return (1 << (8 * depth)) - 1


class Leaves:
    """The grams of some positions. All contexts stay, so each ends at its whole length; ``kept`` is None."""

    def __init__(self, at: Positions, kept: None = None, depth: int = DEPTH):
        self.at = at
        self.plain, self.marked = np.flatnonzero(~at.marked), np.flatnonzero(at.marked)

    def without_mark(self) -> np.ndarray:
        """Grams of the rows ``plain``."""
        return grams(self.at.length[self.plain], self.at.context[self.plain], self.at.byte[self.plain])

    def with_mark(self, mark: int) -> np.ndarray:
        """Grams of the rows ``marked`` in one class."""
        rows = self.marked
        return grams(self.at.length[rows], self.at.under(mark, rows), self.at.byte[rows])


def grams(length: np.ndarray, context: np.ndarray, byte: np.ndarray) -> np.ndarray:
    """Length and bytes of a leaf, and the byte coded there, as one number."""
    return (((length << 48) | context) << 8) | byte


def _log_gamma(x: np.ndarray) -> np.ndarray:
    """Logarithm of the gamma function, by Stirling's series moved up by seven."""
    shift = np.ones_like(x)
    for k in range(7):
        shift = shift * (x + k)
    y = x + 7
    series = 1 / (12 * y) - 1 / (360 * y**3) + 1 / (1260 * y**5)
    return (y - 0.5) * np.log(y) - y + 0.5 * math.log(2 * math.pi) + series - np.log(shift)


def log_kt(zeros: np.ndarray, ones: np.ndarray) -> np.ndarray:
    """Logarithm of the Krichevsky-Trofimov probability of so many zeros and ones."""
    result = _log_gamma(zeros + 0.5) + _log_gamma(ones + 0.5) - _log_gamma(zeros + ones + 1.0) - math.log(math.pi)
    return np.where((zeros == 0) & (ones == 0), 0.0, result)


@dataclass
class Nodes:
    """The binary nodes of one depth: context and decision, counts, what the subtree gives its counts."""

    key: np.ndarray
    zeros: np.ndarray
    ones: np.ndarray
    weighted: np.ndarray
    stop: np.ndarray

    @property
    def chance(self) -> np.ndarray:
        return (self.ones + 0.5) / (self.zeros + self.ones + 1.0)

    @property
    def seen(self) -> np.ndarray:
        return self.zeros + self.ones > 0

    @classmethod
    def of(cls, key, zeros, ones, leaf, below: float | np.ndarray) -> Nodes:
        """Nodes whose children together give their counts ``below``; ``leaf`` where they have none."""
        own = log_kt(zeros, ones)
        weighted = np.where(leaf, own, np.logaddexp(own, below) - math.log(2))
        stop = np.where(leaf, 1.0, np.exp(np.minimum(own - math.log(2) - weighted, 0.0)))
        return cls(key, zeros, ones, weighted, stop)


def parents(children: Nodes, depth: int, more: Nodes | None = None) -> Nodes:
    """The nodes of ``depth`` above ``children``; ``more`` are leaves of that depth."""
    key = (((children.key >> 8) & _mask(depth)) << 8) | (children.key & 255)
    unique, at = np.unique(key, return_inverse=True)
    sums = [np.bincount(at, weights=values, minlength=len(unique)) for values in (children.zeros, children.ones, children.weighted)]
    nodes = Nodes.of(unique, sums[0], sums[1], np.zeros(len(unique), bool), sums[2])
    if more is None or not len(more.key):
        return nodes
    both = [np.concatenate(pair) for pair in zip(vars(nodes).values(), vars(more).values())]
    order = np.argsort(both[0])
    return Nodes(*(values[order] for values in both))


class Tree:
    """The nodes from ``top`` down of the contexts in a table of leaves, bytes and counts."""

    def __init__(self, length, context, byte, count, top: int, depth: int = DEPTH):
        self.length, self.top, self.depth = length, top, depth
        step = np.arange(8)
        decision = (1 << step) | (byte[:, None] >> (8 - step))
        self.bit = (byte[:, None] >> (7 - step)) & 1
        self.levels: dict[int, tuple[Nodes, np.ndarray, np.ndarray]] = {}
        below: Nodes | None = None
        for d in range(depth, top - 1, -1):
            rows = np.flatnonzero(length >= d)
            key = (((context[rows] & _mask(d)) << 8)[:, None] | decision[rows]).reshape(-1)
            unique, at = np.unique(key, return_inverse=True)
            times, bit = np.repeat(count[rows], 8), self.bit[rows].reshape(-1)
            ones = np.bincount(at, weights=times * bit, minlength=len(unique))
            zeros = np.bincount(at, weights=times * (1 - bit), minlength=len(unique))
            leaf = np.zeros(len(unique), bool)
            leaf[at] = np.repeat(length[rows] == d, 8)
            under = np.zeros(len(unique))
            if below is not None and len(below.key):
                up = (((below.key >> 8) & _mask(d)) << 8) | (below.key & 255)
                under = np.bincount(np.searchsorted(unique, up), weights=below.weighted, minlength=len(unique))
            below = Nodes.of(unique, zeros, ones, leaf, under)
            self.levels[d] = (below, rows, at.reshape(-1, 8))

    def log10(self, above: dict[int, Nodes], context: np.ndarray, byte: np.ndarray) -> np.ndarray:
        """Logarithm of the probability of each leaf's byte, with the nodes ``above`` the top."""
        chance = np.full(self.bit.shape, 0.5)
        seen = np.zeros(self.bit.shape, bool)

        def mix(rows, nodes, at):
            own, stop = nodes.chance[at], nodes.stop[at]
            mixed = np.where(seen[rows], stop * own + (1 - stop) * chance[rows], own)
            chance[rows] = mixed
            seen[rows] = nodes.seen[at]

        for d in range(self.depth, self.top - 1, -1):
            nodes, rows, at = self.levels[d]
            mix(rows, nodes, at)
        step = np.arange(8)
        for d in range(self.top - 1, -1, -1):
            rows = np.flatnonzero(self.length >= d)
            key = ((context[rows] & _mask(d)) << 8)[:, None] | (1 << step) | (byte[rows][:, None] >> (8 - step))
            mix(rows, above[d], np.searchsorted(above[d].key, key))
        return np.log10(np.where(self.bit == 1, chance, 1 - chance)).sum(axis=1)


def _counts(one: str = "n_{}") -> list[str]:
    return [one.format(k) for k in range(len(_MARKS))]


def count_words(docs: DataFrame, held_out: Column, classes: np.ndarray) -> DataFrame:
    """``word, n_0 ..`` of all documents: how often in texts of each class not held out; 0 for words of the others alone."""

    def count(batches):
        counts: list[Counter] = [Counter() for _ in _MARKS]

        def emit():
            rows = [(word, k, n) for k, one in enumerate(counts) for word, n in one.items()]
            for one in counts:
                one.clear()
            word, k, n = zip(*rows) if rows else ((), (), ())
            return pa.RecordBatch.from_arrays([pa.array(word, pa.binary()), pa.array(k, pa.int32()), pa.array(n, pa.int64())], names=["word", "k", "n"])

        for batch in batches:
            for part in portions(batch, 0):
                for text, out in zip(raw_bytes(part.column(0)), part.column(1).to_pylist()):
                    if out:
                        for word in set(words_of(text)):
                            counts[0].setdefault(word, 0)
                    else:
                        counts[int((classes @ pair_counts(text)).argmax())].update(words_of(text))
                if sum(map(len, counts)) > 400_000:
                    yield emit()
        yield emit()

    rows = docs.select("text", held_out.alias("held_out")).filter("text is not null").mapInArrow(count, "word binary, k int, n long")
    sums = [F.sum(F.when(F.col("k") == k, F.col("n")).otherwise(0)).alias(name) for k, name in enumerate(_counts())]
    return rows.groupBy("word").agg(*sums)


def _classes(docs: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """The classes of the training texts ``docs``, and how many of them are in each."""

    def count(batches):
        for batch in batches:
            for part in portions(batch, 0):
                rows = [_packed(pair_counts(text)) for text in raw_bytes(part.column(0))]
                yield pa.RecordBatch.from_arrays([pa.array(rows, pa.binary())], names=["pairs"])

    texts = stored(docs.select("text").mapInArrow(count, "pairs binary"), "tree-pairs")
    classes = find_classes(texts)
    return classes, _sums_of(texts, classes)[:, -1]


def _by_class(batch: pa.RecordBatch) -> np.ndarray:
    return np.stack([batch.column(1 + k).to_numpy() for k in range(len(_MARKS))])


@dataclass
class Model:
    """``scores``: ``name, marked, log_0 ..`` of every gram.

    A marked gram is named with the space and has a score in each class; the score of others is ``log_0``.
    """

    scores: DataFrame
    depth: int
    kept: None = None  # all contexts stay

    def of(self, gram: np.ndarray) -> np.ndarray:
        """Scores of a few grams."""
        places = []
        for name in map(int, gram):
            shift = 8 * (name >> 56)
            mark = (name >> shift) & 255
            places.append((name ^ ((mark ^ _SPACE) << shift), _MARKS.index(mark)) if mark in _MARKS else (name, 0))
        rows = self.scores.filter(F.col("name").isin(sorted({name for name, _ in places}))).collect()
        found = {row["name"]: row for row in rows}
        return np.array([found[name][f"log_{k}"] for name, k in places])

    def words(self, words: DataFrame) -> DataFrame:
        """``word, n, log_0 ..``: base-10 logarithm of each word's probability, with the space behind it, by class.

        From stored ``word, n_0 .., id``. The marked positions of a word depend on its first bytes
        alone and are summed once for all words that begin alike.
        """
        depth, logs = self.depth, _counts("log_{}")

        def occurrences(marked: bool):
            def run(batches):
                for batch in batches:
                    for part in portions(batch, 0, _PORTION):
                        at = Positions.of(part.column(0).to_pylist(), depth)
                        leaves = Leaves(at, None, depth)
                        rows, names = (leaves.marked, leaves.with_mark(_SPACE)) if marked else (leaves.plain, leaves.without_mark())
                        key = part.column(part.num_columns - 1).take(pa.array(at.word[rows]))
                        yield pa.RecordBatch.from_arrays([key, pa.array(names)], names=["key", "gram"])

            return run

        beginning = F.substring("word", 1, depth)
        starts = words.select(beginning.alias("start")).distinct().mapInArrow(occurrences(True), "key binary, gram long")
        starts = starts.join(self.scores.filter("marked"), F.col("gram") == F.col("name")).groupBy(F.col("key").alias("start"))
        starts = stored(starts.agg(*(F.sum(name).alias(name) for name in logs)), "tree-starts")
        tails = words.select("word", "id").mapInArrow(occurrences(False), "key long, gram long")
        tails = tails.join(self.scores.filter("not marked").select("name", "log_0"), F.col("gram") == F.col("name"))
        tails = tails.groupBy(F.col("key").alias("of")).agg(F.sum("log_0").alias("tail"))
        n = sum(map(F.col, _counts()), F.lit(0))
        found = words.select("id", "word", n.alias("n"), beginning.alias("begins")).join(tails, F.col("id") == F.col("of"), "left")
        found = found.join(starts, F.col("begins") == F.col("start"))
        return found.select("word", "n", *((F.col(name) + F.coalesce("tail", F.lit(0.0))).alias(name) for name in logs))

    def ends(self) -> np.ndarray:
        return self.of(np.array([_end_gram(mark) for mark in _MARKS]))


def _end_gram(mark: int) -> int:
    return (((1 << 48) | mark) << 8) | _END


def fit(words: DataFrame, ends: list[int], depth: int = DEPTH) -> Model:
    """The model from ``word, n_0 ..`` (all words that will be scored) and the training texts of each class."""
    spark, marks = words.sparkSession, np.array(_MARKS)

    def tally(batches):
        for batch in batches:
            for part in portions(batch, 0, _PORTION):
                n = _by_class(part)
                at = Positions.of(part.column(0).to_pylist(), depth)
                leaves = Leaves(at, None, depth)
                unique, place = np.unique(np.concatenate([leaves.without_mark(), leaves.with_mark(_SPACE)]), return_inverse=True)
                whole = n.sum(axis=0)
                sums = []
                for k, one in enumerate(n):
                    plain = whole[at.word[leaves.plain]] if k == 0 else np.zeros(len(leaves.plain))
                    sums.append(np.bincount(place, weights=np.concatenate([plain, one[at.word[leaves.marked]]]), minlength=len(unique)))
                yield pa.RecordBatch.from_arrays([pa.array(unique), *(pa.array(x.astype(np.int64)) for x in sums)], names=["name", *_counts()])

    schema = "name long, " + ", ".join(f"{name} long" for name in _counts())
    end = spark.createDataFrame([(_end_gram(_SPACE), *map(int, ends))], schema)
    table = words.mapInArrow(tally, schema).union(end).groupBy("name").agg(*(F.sum(name).alias(name) for name in _counts()))
    table = stored(table, "tree-grams")
    buckets = table.count() // _BUCKET + 1
    # Contexts that end in the same bytes share a bucket; the few shorter ones go by length.
    length = F.shiftright("name", 56).cast("int")
    near = F.shiftright("name", 8).bitwiseAND(F.lit(_mask(_TOP)))
    table = table.withColumn("bucket", F.when(length < _TOP, -length).otherwise(F.pmod(F.xxhash64(near), F.lit(buckets)).cast("int")))

    def tree(rows: pd.DataFrame):
        """The tree of a bucket; its contexts and bytes; rows without a mark, and marked ones, which come once in each class."""
        name, n = rows["name"].to_numpy(np.int64), rows[_counts()].to_numpy(float)
        length, context, byte = name >> 56, (name >> 8) & _mask(6), name & 255
        far = 8 * (length - 1)
        marked = (context >> far) & 255 == _SPACE
        plain, each = np.flatnonzero(~marked), np.flatnonzero(marked)
        under = context[each][:, None] ^ ((_SPACE ^ marks)[None, :] << far[each][:, None])
        times = len(marks)
        length = np.concatenate([length[plain], np.repeat(length[each], times)])
        context = np.concatenate([context[plain], under.reshape(-1)])
        byte = np.concatenate([byte[plain], np.repeat(byte[each], times)])
        count = np.concatenate([n[plain, 0], n[each].reshape(-1)])
        return Tree(length, context, byte, count, int(min(length.min(), _TOP)), depth), context, byte, plain, each

    def heads(rows: pd.DataFrame) -> pd.DataFrame:
        built = tree(rows)[0]
        nodes = built.levels[built.top][0]
        return pd.DataFrame({"depth": built.top, "key": nodes.key, "zeros": nodes.zeros, "ones": nodes.ones, "weighted": nodes.weighted})

    found = table.groupBy("bucket").applyInPandas(heads, "depth int, key long, zeros double, ones double, weighted double")
    # Nodes of three bytes are summed below their parents of two; nodes of fewer are leaves.
    deep, up = F.col("depth") == _TOP, F.shiftleft(F.shiftright("key", 8).bitwiseAND(F.lit(_mask(2))), 8).bitwiseOR(F.col("key").bitwiseAND(F.lit(255)))
    found = found.select("depth", F.when(deep, up).otherwise(F.col("key")).alias("key"), "zeros", "ones", "weighted")
    found = found.groupBy("depth", "key").agg(*(F.sum(name).alias(name) for name in ("zeros", "ones", "weighted")))
    found = found.orderBy("depth", "key").toArrow()  # contexts of two bytes at most
    columns = [found.column(i).to_numpy() for i in range(5)]
    level = {d: [values[columns[0] == d] for values in columns[1:]] for d in (1, 2, _TOP)}
    leaves = {d: Nodes(*level[d], np.ones(len(level[d][0]))) for d in (1, 2)}
    key, zeros, ones, below = level[_TOP]
    inner = Nodes.of(key, zeros, ones, np.zeros(len(key), bool), below)
    both = [np.concatenate(pair) for pair in zip(vars(inner).values(), vars(leaves[2]).values())]
    order = np.argsort(both[0])
    above = {2: Nodes(*(values[order] for values in both))}
    above[1] = parents(above[2], 1, leaves[1])
    above[0] = parents(above[1], 0)
    shared = spark.sparkContext.broadcast(above)

    def score(rows: pd.DataFrame) -> pd.DataFrame:
        built, context, byte, plain, each = tree(rows)
        found = built.log10(shared.value, context, byte)
        logs = np.zeros((len(rows), len(marks)))
        logs[plain, 0] = found[: len(plain)]
        logs[each] = found[len(plain) :].reshape(-1, len(marks))
        marked = np.zeros(len(rows), bool)
        marked[each] = True
        return pd.DataFrame({"name": rows["name"].to_numpy(), "marked": marked, **dict(zip(_counts("log_{}"), logs.T))})

    schema = "name long, marked boolean, " + ", ".join(f"{name} double" for name in _counts("log_{}"))
    return Model(stored(table.groupBy("bucket").applyInPandas(score, schema), "tree-scores"), depth)


def score_documents(docs: DataFrame, held_out: Column, key: str = "doc_id", most_words: int = FREQUENT) -> DataFrame:
    """Every row of ``docs`` with code lengths: ``doc_id, n_tokens, n_known, train_tokens, base_score, score, bits_per_byte``.

    Learned from the rows not ``held_out``. Tokens are a text's words and one end. The base is
    the unigram of tokens with 0.1 added to each count. Null texts are empty: an end alone.
    Repeated rows count and are scored one by one. Without training rows the tree has no counts
    and every decision has probability one half.
    """
    spark = docs.sparkSession
    classes, sizes = _classes(docs.filter(~held_out))
    ends, shares = int(sizes.sum()), (sizes + 0.5) / (sizes + 0.5).sum()
    words = count_words(docs, held_out, classes).withColumn("id", F.monotonically_increasing_id())
    words = stored(words, "tree-words")
    total = sum(map(F.col, _counts()), F.lit(0))
    row = words.agg(F.coalesce(F.sum(total), F.lit(0)).alias("tokens"), F.count(F.when(total > 0, 1)).alias("distinct")).first()
    tokens, distinct = row["tokens"] + ends, row["distinct"] + (ends > 0)
    model = fit(words, sizes.tolist())  # an end follows each text
    whole = tokens + 0.1 * (distinct + 1)

    words = stored(model.words(words), "tree-scored-words")
    often = frequent(words, "n", most_words).toArrow()  # ``most_words`` rows at most
    columns = [often.column(i).to_numpy().astype(float) for i in range(1, 2 + len(_MARKS))]
    shared = spark.sparkContext.broadcast((b" ".join(often.column(0).to_pylist()), columns[0], np.stack(columns[1:], axis=1)))
    del often, columns

    def base(n):
        return np.log10((n + 0.1) / whole)

    def score(batches):
        joined, count, logs = shared.value
        place = {word: i for i, word in enumerate(joined.split(b" "))} if len(count) else {}
        bases, find = base(count), place.get
        number, task = 0, TaskContext.get().partitionId()
        kinds = (pa.int64(), pa.int64(), pa.int64(), pa.float64(), pa.list_(pa.float64()), pa.list_(pa.binary()), pa.list_(pa.int64()))
        for batch in batches:
            for part in portions(batch, 1):
                out: list[list] = [[] for _ in kinds]
                for text in raw_bytes(part.column(1)):
                    found = words_of(text)
                    at = [find(word) for word in found]
                    rare = Counter(word for word, i in zip(found, at) if i is None)
                    at = np.array([i for i in at if i is not None], dtype=np.int64)
                    values = (len(found), len(text or b""), int((count[at] > 0).sum()), float(bases[at].sum()), logs[at].sum(axis=0).tolist())
                    for column, value in zip(out, (*values, list(rare), list(rare.values()))):
                        column.append(value)
                rows = pa.array((task << 40) + number + np.arange(part.num_rows))
                number += part.num_rows
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), rows, *(pa.array(values, kind) for values, kind in zip(out, kinds))],
                    names=["doc_id", "row", "words", "bytes", "known", "base", "logs", "rare", "times"],
                )

    kind = docs.schema[key].dataType.simpleString()
    partly = docs.select(F.col(key).alias("doc_id"), "text").mapInArrow(
        score,
        f"doc_id {kind}, row long, words long, bytes long, known long, base double, logs array<double>, rare array<binary>, times array<long>",
    )
    partly = stored(partly, "tree-documents")
    rare = partly.select("row", F.explode(F.arrays_zip("rare", "times")).alias("pair")).select("row", "pair.*")
    more = rare.join(words, F.col("rare") == F.col("word")).groupBy(F.col("row").alias("of")).agg(
        F.sum(F.when(F.col("n") > 0, F.col("times")).otherwise(0)).alias("more_known"),
        F.sum(F.col("times") * F.log10((F.col("n") + 0.1) / F.lit(whole))).alias("more_base"),
        *(F.sum(F.col("times") * F.col(name)).alias(name) for name in _counts("log_{}")),
    )
    result = partly.drop("rare", "times").join(more, F.col("row") == F.col("of"), "left")
    none = F.lit(0.0)
    by_class = [
        F.get("logs", F.lit(k)) + F.coalesce(name, none) + F.lit(float(end) + math.log10(share))
        for k, (name, end, share) in enumerate(zip(_counts("log_{}"), model.ends(), shares))
    ]
    result = result.withColumn("by_class", F.array(*by_class)).withColumn("best", F.array_max("by_class"))
    # The sum over classes, relative to the largest.
    apart = F.aggregate("by_class", none, lambda total, one: total + F.pow(F.lit(10.0), one - F.col("best")))
    score = F.col("best") + F.log10(apart)
    return result.select(
        "doc_id",
        (F.col("words") + 1).alias("n_tokens"),
        (F.col("known") + F.coalesce("more_known", F.lit(0)) + F.lit(int(ends > 0))).cast("long").alias("n_known"),
        F.lit(int(tokens)).cast("long").alias("train_tokens"),
        (F.col("base") + F.coalesce("more_base", none) + F.lit(float(base(float(ends))))).alias("base_score"),
        score.alias("score"),
        (-score / F.lit(_LOG10_2) / (F.col("bytes") + 1)).alias("bits_per_byte"),
    )
