"""Quality scores: random-indexing word vectors, pooled per document, and a two-layer network.

Every word bucket has a sparse random index vector. Its word vector is the sum of the index
vectors of the words around it, over all documents. A document is the mean of its words'
vectors. A small network in numpy, fitted on a bounded sample of labelled documents, gives a
probability, whose temperature is set on labelled documents kept out of the fit.
"""

from __future__ import annotations

import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.tools import Recent, held, portions, stored, unit

#: Word buckets and length of the vectors: word vectors take 2 MB whatever the corpus.
BUCKETS, WIDTH, NONZERO, REACH = 1 << 14, 32, 2, 2
SHARDS = 128
#: Labelled documents that the network is fitted on, about.
SAMPLE = 20_000
HIDDEN = 24
_TOKEN = regex.compile(r"\p{L}+|\p{N}+|[^\s\p{L}\p{N}]+")


def _index_vectors() -> tuple[np.ndarray, np.ndarray]:
    """Places and signs of the nonzero values of each bucket's index vector."""
    random = np.random.default_rng(20)
    places = np.argsort(random.random((BUCKETS, WIDTH)), axis=1)[:, :NONZERO]
    return places, random.choice([-1.0, 1.0], (BUCKETS, NONZERO))


class Tokens:
    """Buckets of a text's words: letters in lower case, capitals marked, numbers by length, runs of signs."""

    def __init__(self, room: int = 700_000):
        self.memo = Recent(room)

    def _learn(self, chunk: str) -> bytes:
        ids = self.memo.recall(chunk)
        if ids is not None:
            return ids
        names = []
        for token in _TOKEN.findall(chunk):
            if token[0].isalpha():
                names.append(token.lower())
                if len(token) > 1 and token.isupper():
                    names.append("<capitals>")
            elif token[0].isnumeric():
                names.append(f"<number {len(token)}>")
            else:
                names.append(token)
        ids = np.array([zlib.crc32(name.encode()) % BUCKETS for name in names], dtype=np.int32).tobytes()
        if len(chunk) <= 64:
            self.memo.keep(chunk, ids)
        return ids

    def __call__(self, text: str | None) -> np.ndarray:
        young, learn = self.memo.young, self._learn
        ids = b"".join([young.get(chunk) or learn(chunk) for chunk in (text or "").split()])
        return np.frombuffer(ids, dtype=np.int32)


def shared_tokens() -> Tokens:
    """One per worker process, so that what it remembers serves the next task too."""
    return held("quality tokens", Tokens)


def add_contexts(vectors: np.ndarray, documents: list[np.ndarray], places: np.ndarray, signs: np.ndarray) -> None:
    """Add to each word the index vectors of the words at most ``REACH`` before or after it in its document."""
    ids = np.concatenate(documents).astype(np.int64) if documents else np.zeros(0, np.int64)
    document = np.repeat(np.arange(len(documents)), [len(one) for one in documents])
    flat = vectors.reshape(-1)
    for step in range(1, REACH + 1):
        same = document[:-step] == document[step:]
        left, right = ids[:-step][same], ids[step:][same]
        for word, other in ((left, right), (right, left)):
            for k in range(NONZERO):
                flat += np.bincount(word * WIDTH + places[other, k], weights=signs[other, k], minlength=flat.size)


def word_vectors(docs: DataFrame) -> np.ndarray:
    """Unit word vectors of all buckets, learned from every text of ``docs``.

    A task adds up a matrix of fixed size and sends it in shards, which are added by shard.
    """
    places, signs = _index_vectors()

    def contexts(batches):
        tokens, vectors = shared_tokens(), np.zeros((BUCKETS, WIDTH))
        for batch in batches:
            for part in portions(batch, 0, 8 << 20):
                add_contexts(vectors, [tokens(text) for text in part.column(0).to_pylist()], places, signs)
        shards = vectors.astype("<f8").reshape(SHARDS, -1)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.arange(SHARDS, dtype=np.int32)), pa.array([s.tobytes() for s in shards], pa.binary())], names=["shard", "part"]
        )

    def total(batches):
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for shard, part in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                # Sums of whole numbers: exact in any order.
                sums[shard] = sums.get(shard, 0) + np.frombuffer(part, "<f8")
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(sums), pa.int32()), pa.array([s.tobytes() for s in sums.values()], pa.binary())], names=["shard", "part"]
        )

    schema = "shard int, part binary"
    parts = docs.select("text").filter("text is not null").mapInArrow(contexts, schema)
    sums = parts.repartition(SHARDS, "shard").mapInArrow(total, schema)
    vectors = np.zeros((SHARDS, BUCKETS * WIDTH // SHARDS))
    for row in sums.collect():  # BUCKETS x WIDTH values at most
        vectors[row["shard"]] = np.frombuffer(bytes(row["part"]), "<f8")
    vectors = vectors.reshape(BUCKETS, WIDTH)
    length = np.linalg.norm(vectors, axis=1, keepdims=True)
    return (vectors / np.maximum(length, 1e-9)).astype(np.float32)


def pooled(docs: DataFrame, vectors: np.ndarray, key: str = "doc_id") -> DataFrame:
    """``key, features``: the mean word vector of each whole text; zeros without words."""

    def pool(batches):
        tokens = shared_tokens()
        for batch in batches:
            for part in portions(batch, 1):
                rows = np.zeros((part.num_rows, WIDTH), np.float32)
                for i, text in enumerate(part.column(1).to_pylist()):
                    ids = tokens(text)
                    if len(ids):
                        rows[i] = vectors[ids].mean(axis=0, dtype=np.float64)
                lists = pa.FixedSizeListArray.from_arrays(pa.array(rows.reshape(-1)), WIDTH).cast(pa.list_(pa.float32()))
                yield pa.RecordBatch.from_arrays([part.column(0), lists], names=[key, "features"])

    rows = docs.select(F.col(key), F.col("text"))
    return rows.mapInArrow(pool, f"`{key}` {rows.schema[0].dataType.simpleString()}, features array<float>")


@dataclass
class Network:
    mean: np.ndarray
    spread: np.ndarray
    first: np.ndarray
    second: np.ndarray
    temperature: float = 1.0

    def logits(self, features: np.ndarray) -> np.ndarray:
        ones = np.ones((len(features), 1))
        hidden = np.tanh(np.hstack(((features - self.mean) / self.spread, ones)) @ self.first)
        return (np.hstack((hidden, ones)) @ self.second)[:, 0]

    def __call__(self, features: np.ndarray) -> np.ndarray:
        return 1.0 / (1.0 + np.exp(-np.clip(self.logits(features) / self.temperature, -30, 30)))


def fit_network(features: np.ndarray, label: np.ndarray, kept_out: np.ndarray, epochs: int = 600) -> Network:
    """Fit by full-batch Adam on the rows not kept out; choose the temperature on those kept out."""
    random = np.random.default_rng(7)
    inputs, goal = features[~kept_out], label[~kept_out].astype(float)
    net = Network(
        inputs.mean(axis=0) if len(inputs) else np.zeros(features.shape[1]),
        inputs.std(axis=0) + 1e-6 if len(inputs) else np.ones(features.shape[1]),
        random.normal(0, 0.3, (features.shape[1] + 1, HIDDEN)),
        np.zeros((HIDDEN + 1, 1)),
    )
    if not len(inputs):
        return net
    ones = np.ones((len(inputs), 1))
    x = np.hstack(((inputs - net.mean) / net.spread, ones))
    moments = [[np.zeros_like(w), np.zeros_like(w)] for w in (net.first, net.second)]
    for t in range(1, epochs + 1):
        hidden = np.hstack((np.tanh(x @ net.first), ones))
        chance = 1.0 / (1.0 + np.exp(-np.clip(hidden @ net.second, -30, 30)))
        error = (chance - goal[:, None]) / len(inputs)
        back = (error @ net.second[:-1].T) * (1 - hidden[:, :-1] ** 2)
        slopes = (x.T @ back + 2e-3 * net.first, hidden.T @ error + 2e-3 * net.second)
        for w, slope, (m, v) in zip((net.first, net.second), slopes, moments):
            m += 0.1 * (slope - m)
            v += 0.001 * (slope**2 - v)
            w -= 0.02 * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.999**t)) + 1e-8)
    if kept_out.any():
        logits, truth = net.logits(features[kept_out]), label[kept_out]
        grid = np.exp(np.linspace(np.log(0.3), np.log(5.0), 60))
        loss = [np.logaddexp(0, np.where(truth == 1, -1, 1) * logits / t).mean() for t in grid]
        net.temperature = float(grid[int(np.argmin(loss))])
    return net


def scores(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, key: str = "doc_id") -> DataFrame:
    """``key, score`` of every row of ``docs``, learned from ``key, quality`` rows of ``labels``.

    Null and empty texts are scored as a document without words. Labels that are null or belong
    to no document are not used; a document labelled twice counts twice. Without labels every
    score is 0.5. About ``sample`` labelled documents, chosen by a hash of the key, fit the
    network; the word vectors are learned from all texts.
    """
    features = stored(pooled(docs, word_vectors(docs), key), "quality-features")
    known = labels.filter("quality is not null").select(F.col(key).alias("labelled"), F.col("quality").cast("int").alias("quality"))
    rows = features.join(known, F.col(key) == F.col("labelled")).select("labelled", "features", "quality")
    rows = stored(rows, "quality-labelled")
    count = rows.count()
    rate = min(1.0, sample / max(count, 1))
    chosen = rows.filter(unit("labelled") < rate).orderBy("labelled", "quality").collect()
    inputs = np.array([row["features"] for row in chosen], dtype=float).reshape(-1, WIDTH)
    label = np.array([row["quality"] for row in chosen], dtype=int)
    kept_out = np.array([zlib.crc32(f"calibrate{row['labelled']}".encode()) % 5 == 0 for row in chosen], dtype=bool)
    net = fit_network(inputs, label, kept_out)

    def score(batches):
        for batch in batches:
            x = batch.column(1).flatten().to_numpy(zero_copy_only=False).reshape(-1, WIDTH).astype(float)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(net(x))], names=[key, "score"])

    return features.mapInArrow(score, f"`{key}` {features.schema[0].dataType.simpleString()}, score double")
