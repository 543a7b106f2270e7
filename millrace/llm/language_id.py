"""Language identification by unigram pieces with all segmentations summed.

Each language has a probability for every piece of a fixed public vocabulary. The probability
of a run of letters, however long, is the sum over all its segmentations into pieces, by a
forward pass that is scaled as it goes; a text is the product over its runs. The piece
probabilities come from expectation maximisation over a bounded sample of labelled documents,
by forward and backward passes over whole runs; prediction reads whole texts.
"""

from __future__ import annotations

import math
import uuid
from collections import Counter
from dataclasses import dataclass, field

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
import regex
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.tools import held, in_small_batches, portions, stored, unit

UNKNOWN = "und"
#: Documents of each language that piece probabilities are learned from, about.
SAMPLE = 2000
ROUNDS = 3
#: Probabilities are kept times this to the power of the characters; taken out in the end.
_SCALE = 16.0
_LETTERS = regex.compile(r"\p{L}+")
#: Characters, padding included, that are worked on at once, and after how many sums are scaled.
_CELLS, _RESCALE = 1 << 16, 8
#: Languages that a model may have: their piece probabilities are held by the driver and every task.
MOST_LANGUAGES = 1000
_U = np.uint64
_BASE, _SPREAD = _U(0x9E3779B97F4A7C15), _U(0xD6E8FEB86659FD93)
_SLOTS = 20


class Pieces:
    """The vocabulary as a table of prefixes: the id of a piece, -1 for a mere prefix."""

    def __init__(self, path: str):
        model = sentencepiece.SentencePieceProcessor(model_file=path)
        self.of: dict[str, int] = {}
        for i in range(model.get_piece_size()):
            if model.is_control(i) or model.is_unknown(i) or model.is_byte(i) or model.is_unused(i):
                continue
            piece = model.id_to_piece(i)
            for end in range(1, len(piece)):
                self.of.setdefault(piece[:end], -1)
            self.of[piece] = i
        self.unknown = model.get_piece_size()
        self.size = self.unknown + 1
        whole = {piece: i for piece, i in self.of.items() if i >= 0}
        self.longest = max(map(len, whole))
        # A table of hashes with the ids beside them; a place that is taken leaves the next one.
        self.hashes, self.ids, self.probes = np.zeros(1 << _SLOTS, _U), np.full(1 << _SLOTS, -1, np.int32), 1
        for piece, i in whole.items():
            value = 0
            for character in piece:
                value = (value * int(_BASE) + ord(character)) % 2**64
            at = value * int(_SPREAD) % 2**64 >> (64 - _SLOTS)
            for probe in range(1 << _SLOTS):
                slot = (at + probe) % (1 << _SLOTS)
                if self.ids[slot] < 0:
                    self.hashes[slot], self.ids[slot] = value, i
                    self.probes = max(self.probes, probe + 1)
                    break

    def find(self, hashed: np.ndarray) -> np.ndarray:
        """The id of the piece with each hash, -1 where there is none."""
        at, found = (hashed * _SPREAD >> _U(64 - _SLOTS)).astype(np.int64), np.full(hashed.shape, -1, np.int32)
        for probe in range(self.probes):
            slot = (at + probe) & ((1 << _SLOTS) - 1)
            same = self.hashes[slot] == hashed
            found[same] = self.ids[slot[same]]
        return found


class _Grid:
    """Some runs, longest first, side by side: which piece, if any, spans each ``n`` characters from each start."""

    def __init__(self, pieces: Pieces, runs: list[str]):
        texts = ["▁" + run for run in runs]
        self.lengths = np.array([len(text) for text in texts], np.int64)
        width = int(self.lengths[0])
        codes = np.zeros((len(texts), width), _U)
        codes[np.arange(width) < self.lengths[:, None]] = np.frombuffer("".join(texts).encode("utf-32-le"), "<u4")
        self.width, self.pieces = width, []
        hashed = np.zeros_like(codes)
        for n in range(1, min(pieces.longest, width) + 1):
            hashed = hashed[:, : width - n + 1] * _BASE + codes[:, n - 1 :]
            found = pieces.find(hashed)
            found[np.arange(width - n + 1) + n > self.lengths[:, None]] = -1
            self.pieces.append(found)
        single = self.pieces[0]
        single[(single < 0) & (np.arange(width) < self.lengths[:, None])] = pieces.unknown
        #: How many runs have more than so many characters.
        self.longer = np.searchsorted(-self.lengths, -np.arange(width + 1), side="left")

    def sums(self, weight, columns: int, backward: bool = False) -> np.ndarray:
        """Logarithms of the sums over segmentations, ``[characters, run, column]``: of each prefix, or of what follows it.

        ``weight(ids, rows)`` gives the weights of pieces in some runs.
        """
        n_runs, width = len(self.lengths), self.width
        logs = np.full((width + 1, n_runs, columns), -np.inf)
        values: list[np.ndarray | None] = [None] * (width + 1)
        scale = np.zeros((n_runs, columns))
        starts = np.ones((n_runs, columns))
        order = range(width - 1, -1, -1) if backward else range(1, width + 1)
        if backward:
            logs[self.lengths, np.arange(n_runs)] = 0.0
            values[width] = np.where((self.lengths == width)[:, None], starts, 0.0)
        else:
            logs[0], values[0] = 0.0, starts
        for step, at in enumerate(order, 1):
            rows = int(self.longer[at if backward else at - 1])
            new = np.zeros((n_runs, columns))
            for n in range(1, min(len(self.pieces), (width - at) if backward else at) + 1):
                first = at if backward else at - n
                ids = self.pieces[n - 1][:rows, first]
                hit = np.flatnonzero(ids >= 0)
                if len(hit):
                    new[hit] += values[at + n if backward else first][hit] * weight(ids[hit], hit)
            logs[at, :rows] = np.log(new[:rows]) + scale[:rows]
            if backward:  # runs that end here begin
                new[rows : int(self.longer[at - 1]) if at else rows] = 1.0
            values[at] = new
            gone = at + len(self.pieces) if backward else at - len(self.pieces)
            if 0 <= gone <= width:
                values[gone] = None
            if step % _RESCALE == 0:
                most = np.where(new > 0, new, 1.0)
                most[rows:] = 1.0
                scale += np.log(most)
                for held_back in values:
                    if held_back is not None:
                        held_back /= most
        return logs


def _grids(pieces: Pieces, runs: list[str]):
    """Grids over all runs, with the places of their rows in ``runs``."""
    order = sorted(range(len(runs)), key=lambda i: -len(runs[i]))
    start = 0
    while start < len(order):
        width = len(runs[order[start]]) + 1
        end = start + max(1, _CELLS // width)
        yield np.array(order[start:end]), _Grid(pieces, [runs[i] for i in order[start:end]])
        start = end


def log_likelihoods(pieces: Pieces, runs: list[str], weights: np.ndarray) -> np.ndarray:
    """Natural logarithm of each run's probability, one column per language.

    ``weights`` holds the probabilities times ``_SCALE`` to the power of a piece's characters.
    """
    out = np.zeros((len(runs), weights.shape[1]))
    for rows, grid in _grids(pieces, runs):
        logs = grid.sums(lambda ids, _: weights[ids], weights.shape[1])
        out[rows] = logs[grid.lengths, np.arange(len(rows))] - grid.lengths[:, None] * math.log(_SCALE)
    return out


def expected_counts(pieces: Pieces, runs: list[str], times: np.ndarray, language: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """How often each piece is used under all segmentations, by language; a run belongs to one language."""
    counts = np.zeros((weights.shape[1], pieces.size))
    for rows, grid in _grids(pieces, runs):
        of, often = language[rows], times[rows]

        def weight(ids, at, of=of):
            return weights[ids, of[at]][:, None]

        ahead = grid.sums(weight, 1)[:, :, 0].T
        behind = grid.sums(weight, 1, backward=True)[:, :, 0].T
        total = ahead[np.arange(len(rows)), grid.lengths]
        for n, found in enumerate(grid.pieces, 1):
            run, start = np.nonzero(found >= 0)
            piece = found[run, start]
            share = np.exp(ahead[run, start] + behind[run, start + n] - total[run]) * weights[piece, of[run]]
            np.add.at(counts, (of[run], piece), share * often[run])
    return counts


@dataclass
class Model:
    languages: list[str]
    prior: np.ndarray
    weights: np.ndarray
    path: str
    name: str = field(default_factory=lambda: uuid.uuid4().hex)


def _scaled(pieces: Pieces, probability: np.ndarray) -> np.ndarray:
    length = np.ones(pieces.size)
    for piece, i in pieces.of.items():
        if i >= 0:
            length[i] = len(piece)
    return (probability * _SCALE**length).T.copy()


def fit(train: DataFrame, path: str | None = None, sample: int = SAMPLE, rounds: int = ROUNDS, key: str = "doc_id") -> Model:
    """Learn from ``text`` and non-null ``lang``; about ``sample`` documents of each language at most.

    Documents of a larger language are kept by a hash of their key. The piece probabilities,
    languages times vocabulary, are held by the driver and sent to the tasks, so more than
    ``MOST_LANGUAGES`` are refused. Without labelled rows there are no languages.
    """
    path = path or public_tokenizers.path("piece_bpe_32k.model")
    pieces = Pieces(path)
    train = train.filter("lang is not null and text is not null")
    sizes = {row["lang"]: row["count"] for row in train.groupBy("lang").count().limit(MOST_LANGUAGES + 1).collect()}
    if len(sizes) > MOST_LANGUAGES:
        raise ValueError(f"more than {MOST_LANGUAGES} different languages: clean the labels first")
    languages = sorted(sizes)
    if not languages:
        return Model([], np.zeros(0), np.zeros((pieces.size, 0)), path)
    place = {name: i for i, name in enumerate(languages)}
    entries = [F.lit(x) for name in languages for x in (name, sample / sizes[name])]
    chosen = train.filter(unit(key, "text") < F.element_at(F.create_map(*entries), F.col("lang"))).select("lang", "text")

    def count(batches):
        for batch in batches:
            for part in portions(batch, 1):
                counts: dict[str, Counter] = {}
                for lang, text in zip(part.column(0).to_pylist(), pc.utf8_lower(part.column(1)).to_pylist()):
                    counts.setdefault(lang, Counter()).update(_LETTERS.findall(text))
                rows = [(place[lang], run, n) for lang, runs in counts.items() for run, n in runs.items()]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([r[0] for r in rows], pa.int32()), pa.array([r[1] for r in rows], pa.string()), pa.array([r[2] for r in rows], pa.int64())],
                    names=["lang", "run", "n"],
                )

    runs = chosen.mapInArrow(count, "lang int, run string, n long").groupBy("lang", "run").agg(F.sum("n").alias("n"))
    runs = stored(runs, "language-runs")
    probability = np.full((len(languages), pieces.size), 1.0 / pieces.size)
    for _ in range(rounds):
        weights = _scaled(pieces, probability)

        def expect(batches, weights=weights):
            table, counts = _pieces_of(path), 0
            for batch in batches:
                counts = counts + expected_counts(
                    table, batch.column(1).to_pylist(), batch.column(2).to_numpy(), batch.column(0).to_numpy().astype(np.int64), weights
                )
            if isinstance(counts, np.ndarray):
                lang, piece = np.nonzero(counts)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(lang.astype(np.int32)), pa.array(piece.astype(np.int32)), pa.array(counts[lang, piece])],
                    names=["lang", "piece", "n"],
                )

        sums = runs.mapInArrow(expect, "lang int, piece int, n double").groupBy("lang", "piece").agg(F.sum("n").alias("n"))
        found = sums.toPandas()  # languages times vocabulary at most
        counts = np.full((len(languages), pieces.size), 0.02)
        counts[found["lang"].to_numpy(), found["piece"].to_numpy()] += found["n"].to_numpy()
        probability = counts / counts.sum(axis=1, keepdims=True)
    share = np.array([sizes[name] for name in languages], dtype=float)
    return Model(languages, np.log(share / share.sum()), _scaled(pieces, probability), path)


class _Scorer:
    """Sums of log-likelihoods per text, and numbers of letters; remembers a bounded number of runs."""

    def __init__(self, model: Model, room: int = 200_000):
        self.pieces, self.model, self.room = Pieces(model.path), model, room
        self.place: dict[str, int] = {}
        self.rows = np.zeros((1 << 14, len(model.languages) + 1))

    def _places(self, runs: list[str]) -> np.ndarray:
        """Where the sums of each of some different runs are; new ones are scored at once."""
        new = [run for run in runs if run not in self.place]
        if len(self.place) + len(new) > self.room:
            self.place, new = {}, runs
        base = len(self.place)
        if base + len(new) > len(self.rows):
            self.rows = np.concatenate((self.rows[:base], np.zeros((max(base, 2 * len(new)), self.rows.shape[1]))))
        if new:
            self.rows[base : base + len(new), :-1] = log_likelihoods(self.pieces, new, self.model.weights)
            self.rows[base : base + len(new), -1] = [len(run) for run in new]
            self.place.update(zip(new, range(base, base + len(new))))
        return np.array([self.place[run] for run in runs], np.int64)

    def __call__(self, texts: pa.Array) -> np.ndarray:
        words = pc.utf8_split_whitespace(pc.utf8_lower(pc.fill_null(texts, "")))
        coded = words.flatten().dictionary_encode()
        # The letters of every different word, the sums of every different run of them.
        runs = [_LETTERS.findall(word) for word in coded.dictionary.to_pylist()]
        different = list(dict.fromkeys(run for each in runs for run in each))
        place = dict(zip(different, self._places(different).tolist()))
        of_words = np.zeros((len(runs), self.rows.shape[1]))
        owner = np.repeat(np.arange(len(runs)), [len(each) for each in runs])
        np.add.at(of_words, owner, self.rows[[place[run] for each in runs for run in each]])
        bounds = words.offsets.to_numpy() - words.offsets[0].as_py()
        code, out = coded.indices.to_numpy(), np.zeros((len(texts), self.rows.shape[1]))
        for k in range(out.shape[1] if len(texts) else 0):  # a column at a time, for the memory of all words
            out[:, k] = np.add.reduceat(np.append(of_words[code, k], 0.0), bounds[:-1])
        out[np.diff(bounds) == 0] = 0
        return out


def _scorer_of(model: Model) -> _Scorer:
    """One scorer per worker process, so that what it remembers serves the next task too."""
    return held(("language scorer", model.name), lambda: _Scorer(model))


def _pieces_of(path: str) -> Pieces:
    return held(("pieces", path), lambda: Pieces(path))


def predict(docs: DataFrame, model: Model, key: str = "doc_id") -> DataFrame:
    """``key, lang_pred, score`` of every row: the likeliest language and its probability.

    A text that is null or has no letter gets ``und`` and score 0, as does every text if no
    language was learned. Equal texts get equal results; of equal likelihoods the language
    first by code point wins.
    """

    def score(batches):
        scorer = _scorer_of(model)
        for batch in batches:
            for part in portions(batch, 1):
                sums = scorer(part.column(1))
                names, scores = [], []
                for row in sums:
                    if row[-1] == 0 or not model.languages:
                        names.append(UNKNOWN)
                        scores.append(0.0)
                        continue
                    logs = row[:-1] + model.prior
                    best = int(logs.argmax())
                    names.append(model.languages[best])
                    scores.append(float(1.0 / np.exp(logs - logs[best]).sum()))
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(names, pa.string()), pa.array(scores, pa.float64())], names=[key, "lang_pred", "score"]
                )

    rows = docs.select(F.col(key), F.col("text"))
    return rows.mapInArrow(score, f"`{key}` {rows.schema[0].dataType.simpleString()}, lang_pred string, score double")


def identified(docs: DataFrame, model: Model) -> DataFrame:
    """The rows of ``docs`` whose text has a language, with the predicted one in ``lang``.

    Texts that are null or without a letter go. Without any learned language the other rows stay
    as they are. All other columns are kept.
    """
    if not model.languages:
        return docs.filter(F.col("text").rlike(r"\p{L}"))
    text, lang = docs.columns.index("text"), docs.columns.index("lang")

    def keep(batches):
        scorer = _scorer_of(model)
        for batch in batches:
            for part in portions(batch, text):
                sums = scorer(part.column(text))
                best = np.argmax(sums[:, :-1] + model.prior, axis=1) if part.num_rows else np.zeros(0, np.int64)
                found = pa.array(model.languages).take(pa.array(best)).cast(part.schema.field(lang).type)
                yield part.set_column(lang, part.schema.field(lang), found).filter(pa.array(sums[:, -1] > 0))

    return in_small_batches(docs).mapInArrow(keep, docs.schema)
