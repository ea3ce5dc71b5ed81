"""Quality scores from random-indexing word vectors, pooled per document, and a small network.

1. Word vectors. Every word has a sparse random index vector, made from the word's 64-bit
   hash, so no two words share one, however many there are. A word's context sums the index
   vectors of the words around its own places. Spark counts all words; those that make up at least
   one in ``COMMON`` of all tokens, of which there can be no more than ``COMMON``, get the
   context of all their places in the corpus. A rarer word has the context of the place at
   which it stands; for a word met once that is all it has. Sums are whole numbers, so
   their order and retried tasks change nothing.
2. A document is the mean and the spread of its tokens' vectors, how alike neighbours are, the
   share of distinct tokens, and the log of their number.
3. A two-layer network is fitted by numpy on a bounded sample of labelled documents, at
   most ``max_labelled``, and its temperature on a fifth of that sample kept out of it.

Vectors and network have a size bound whatever the corpus; they alone are broadcast.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf

from gradewise.functions import column
from gradewise.llm.text import batches, fresh, show_code, utf8
from gradewise.sources.scratch import materialize

# Runs of letters and digits, runs of marks; case counts.
TOKEN = re.compile(rb"[0-9A-Za-z\x80-\xff]+|[^\s0-9A-Za-z\x80-\xff]+")
#: Words of at least one in so many tokens have the context of all their places.
COMMON = 1 << 16
DIMS = 32
NONZERO = 4
WINDOW = 2
#: Tokens whose vectors are gathered at once.
GATHERED = 100_000
#: Distinct words that a task counts before it sends them on.
COUNTED = 1_000_000
FEATURES = 2 * DIMS + 3


def words_of(text: bytes) -> np.ndarray:
    """64-bit hashes of the text's tokens, in order."""
    import xxhash

    tokens = TOKEN.findall(text)
    return np.fromiter(map(xxhash.xxh3_64_intdigest, tokens), np.uint64, len(tokens))


def index_places(words: np.ndarray, j: int) -> np.ndarray:
    """The dimension of each word's ``j``-th non-zero entry: five bits of its hash."""
    return (words >> np.uint64(5 * j) & np.uint64(DIMS - 1)).astype(np.int64)


def index_signs(words: np.ndarray, j: int) -> np.ndarray:
    return (words >> np.uint64(40 + j) & np.uint64(1)).astype(np.float32) * 2 - 1


def index_vectors(words: np.ndarray) -> np.ndarray:
    """Each word's index vector; entries that fall on one dimension add up."""
    vectors, row = np.zeros((len(words), DIMS), np.float32), np.arange(len(words))
    for j in range(NONZERO):
        vectors[row, index_places(words, j)] += index_signs(words, j)
    return vectors


def contexts_at(words: np.ndarray) -> np.ndarray:
    """For each place of a text the sum of the index vectors of the words around it."""
    own = index_vectors(words)
    sums = np.zeros_like(own)
    for step in range(1, WINDOW + 1):
        sums[step:] += own[:-step]
        sums[:-step] += own[step:]
    return sums


@dataclass
class WordVectors:
    """Sorted hashes of the common words, their unit vectors, and the mean context of all tokens."""

    words: np.ndarray
    vectors: np.ndarray
    mean: np.ndarray

    def places(self, words: np.ndarray) -> np.ndarray:
        """Each word's place in the table; its length for rarer words."""
        if not len(self.words):
            return np.zeros(len(words), np.int64)
        at = np.minimum(np.searchsorted(self.words, words), len(self.words) - 1)
        return np.where(self.words[at] == words, at, len(self.words))

    def of(self, words: np.ndarray) -> np.ndarray:
        """The vector at every place of a text."""
        at = self.places(words)
        rare = np.flatnonzero(at == len(self.words))
        found = np.zeros((len(words), DIMS), np.float32)
        known = at < len(self.words)
        found[known] = self.vectors[at[known]]
        if len(rare):
            found[rare] = unit(contexts_at(words)[rare] - self.mean)
        return found


def unit(vectors: np.ndarray) -> np.ndarray:
    return (vectors / np.maximum(np.linalg.norm(vectors, axis=1, keepdims=True), 1e-9)).astype(np.float32)


def _counts(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Words of the task's documents and how often each occurs; a word may come more than once."""
    held, n = np.zeros(0, np.uint64), np.zeros(0, np.int64)

    def rows() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(held.view(np.int64)), pa.array(n)], ["word", "n"])

    for part in parts:
        texts = utf8(part.column(0))
        for group in batches(texts):
            more, times = np.unique(np.concatenate([words_of(texts[i]) for i in group]), return_counts=True)
            held, place = np.unique(np.concatenate([held, more]), return_inverse=True)
            n = np.bincount(place, weights=np.concatenate([n, times]), minlength=len(held)).astype(np.int64)
            if len(held) > COUNTED:
                yield rows()
                held, n = held[:0], n[:0]
    yield rows()


def _contexts(table: WordVectors):
    def contexts(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The task's documents as one row per common word and one for all others: tokens, and sums of their contexts."""
        size = len(table.words) + 1
        sums, counts = np.zeros(size * DIMS), np.zeros(size, np.int64)
        for part in parts:
            texts = utf8(part.column(0))
            for group in batches(texts):
                own = [words_of(texts[i]) for i in group]
                words = np.concatenate(own)
                doc = np.repeat(np.arange(len(own)), [len(x) for x in own])
                at = table.places(words)
                counts += np.bincount(at, minlength=size)
                for step in range(1, WINDOW + 1):
                    same = np.flatnonzero(doc[:-step] == doc[step:])
                    for here, there in ((same, same + step), (same + step, same)):
                        for j in range(NONZERO):
                            flat = at[here] * DIMS + index_places(words[there], j)
                            sums += np.bincount(flat, weights=index_signs(words[there], j), minlength=len(sums))
        met = np.flatnonzero(counts)
        values = sums.reshape(size, DIMS)[met].astype(np.int64)
        columns = [pa.array(met.astype(np.int32)), pa.array(counts[met])]
        columns += [pa.array(np.ascontiguousarray(values[:, d])) for d in range(DIMS)]
        yield pa.RecordBatch.from_arrays(columns, ["place", "n", *_dims()])

    return contexts


def _dims() -> list[str]:
    return [f"v{d}" for d in range(DIMS)]


def common_words(docs: DataFrame, text: str = "text", common: int = COMMON) -> np.ndarray:
    """Sorted hashes of the words that make up at least one in ``common`` of all tokens of ``docs``."""
    show_code(docs)
    counts = docs.select(column(text).alias("text")).mapInArrow(_counts, "word long, n long")
    counts = materialize(counts.groupBy("word").agg(F.sum("n").alias("n")), "word-counts")
    total = counts.agg(F.sum("n")).first()[0] or 0
    often = counts.filter(F.col("n") * common >= total).select("word").toArrow()  # at most ``common`` rows
    return np.sort(often["word"].to_numpy().astype(np.int64).view(np.uint64))


def word_vectors(docs: DataFrame, text: str = "text", common: int = COMMON) -> WordVectors:
    """Unit vectors of the common words' mean contexts around the corpus's mean."""
    words = common_words(docs, text, common)
    empty = WordVectors(words, np.zeros((len(words), DIMS), np.float32), np.zeros(DIMS))
    schema = "place int, n long, " + ", ".join(f"{d} long" for d in _dims())
    rows = (
        docs.select(column(text).alias("text"))
        .mapInArrow(_contexts(empty), schema)
        .groupBy("place")
        .agg(F.sum("n").alias("n"), *[F.sum(d).alias(d) for d in _dims()])
        .toArrow()  # at most ``common`` rows and one
    )
    if not rows.num_rows:
        return empty
    place, n = rows["place"].to_numpy(), rows["n"].to_numpy().astype(np.float64)[:, None]
    sums = np.stack([rows[d].to_numpy() for d in _dims()], axis=1).astype(np.float64)
    mean = sums.sum(0) / n.sum()
    vectors = np.zeros((len(words) + 1, DIMS), np.float32)
    vectors[place] = unit(sums / n - mean)
    return WordVectors(words, vectors[:-1], mean)


def pooled(text: bytes, table: WordVectors) -> np.ndarray:
    """Mean and spread of the text's token vectors, mean product of neighbours, share of distinct tokens, log count.

    Zeros for a text without tokens.
    """
    words = words_of(text)
    total, squares, alike = np.zeros(DIMS), np.zeros(DIMS), 0.0
    for at in range(0, len(words), GATHERED):
        # With the words around the piece, and the vector after it.
        low, high = max(0, at - WINDOW), at + GATHERED + 1 + WINDOW
        own = table.of(words[low:high])[at - low : at - low + GATHERED + 1]
        alike += np.einsum("ij,ij->", own[:-1], own[1:], dtype=np.float64)
        own = own[:GATHERED]
        total += own.sum(0, dtype=np.float64)
        squares += np.einsum("ij,ij->j", own, own, dtype=np.float64)
    n = max(len(words), 1)
    mean = total / n
    spread = np.sqrt(np.maximum(squares / n - mean**2, 0))
    return np.concatenate([mean, spread, [alike / n, len(np.unique(words)) / n, np.log1p(len(words))]])


@dataclass
class QualityModel:
    """Word vectors, standardised inputs, two layers and a temperature; or a constant score."""

    vectors: WordVectors
    centre: np.ndarray
    scale: np.ndarray
    layers: tuple[np.ndarray, ...] | None
    temperature: float = 1.0
    constant: float = 0.5

    def logits(self, features: np.ndarray) -> np.ndarray:
        w1, b1, w2, b2 = self.layers
        return np.tanh((features - self.centre) / self.scale @ w1 + b1) @ w2 + b2

    def scores(self, features: np.ndarray) -> np.ndarray:
        if self.layers is None:
            return np.full(len(features), self.constant)
        return sigmoid(self.logits(features) / self.temperature)


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


def fit_network(x: np.ndarray, y: np.ndarray, hidden: int = 32, epochs: int = 60, seed: int = 7) -> tuple:
    """Weights of a tanh layer and a logistic one, by Adam on shuffled batches."""
    rng = np.random.default_rng(seed)
    layers = [
        rng.normal(0, 1 / np.sqrt(x.shape[1]), (x.shape[1], hidden)),
        np.zeros(hidden),
        rng.normal(0, 1 / np.sqrt(hidden), hidden),
        np.zeros(()),
    ]
    first, second, step = [np.zeros_like(w) for w in layers], [np.zeros_like(w) for w in layers], 0
    for _ in range(epochs):
        order = rng.permutation(len(x))
        for at in range(0, len(x), 256):
            rows = order[at : at + 256]
            inner = np.tanh(x[rows] @ layers[0] + layers[1])
            error = (sigmoid(inner @ layers[2] + layers[3]) - y[rows]) / len(rows)
            back = np.outer(error, layers[2]) * (1 - inner**2)
            slopes = [x[rows].T @ back + 1e-4 * layers[0], back.sum(0), inner.T @ error, error.sum()]
            step += 1
            for i, slope in enumerate(slopes):
                first[i] = 0.9 * first[i] + 0.1 * slope
                second[i] = 0.999 * second[i] + 0.001 * slope**2
                ahead = first[i] / (1 - 0.9**step)
                layers[i] = layers[i] - 0.003 * ahead / (np.sqrt(second[i] / (1 - 0.999**step)) + 1e-8)
    return tuple(layers)


def best_temperature(logits: np.ndarray, y: np.ndarray) -> float:
    """The temperature, below or above 1, of least log loss on rows the network has not seen.

    Each class counts one row of the other, so that rows it parts without a fault still have one.
    """
    ones = (y == 1).sum()
    wanted = np.where(y == 1, (ones + 1) / (ones + 2), 1 / (len(y) - ones + 2))
    tried = np.exp(np.linspace(-3, 3, 121))
    losses = [np.mean(np.logaddexp(0, logits / t) - wanted * logits / t) for t in tried]
    return float(tried[int(np.argmin(losses))])


def held_out(key: Column) -> Column:
    """Rows that are never learned from; a null key counts as the empty text."""
    return F.crc32(F.coalesce(key.cast("string"), F.lit(""))) % 4 == 2


def labelled_sample(labels: DataFrame, key: str, label: str, max_labelled: int) -> DataFrame:
    """``id, y`` of at most ``max_labelled`` labelled rows, those with the smallest key hashes.

    A key labelled more than once has its lowest label; other labels than 0 and 1 are no label.
    """
    known = (
        labels.select(column(key).alias("id"), column(label).cast("int").alias("y"))
        .filter(F.col("y").isin(0, 1) & ~held_out(F.col("id")))
        .groupBy("id")
        .agg(F.min("y").alias("y"))
        .withColumn("place", F.pmod(F.xxhash64(F.lit("sample"), "id"), F.lit(1 << 30)))
    )
    # Thinned by hash before the sort, so that it sees a bounded number of rows.
    share = min(1.0, 2 * max_labelled / max(known.count(), 1))
    thinned = known.filter(F.col("place") < int(share * (1 << 30)))
    return thinned.orderBy("place", "id").limit(max_labelled).select("id", "y")


def fit_quality(
    docs: DataFrame,
    labels: DataFrame,
    text: str = "text",
    key: str = "doc_id",
    label: str = "quality",
    max_labelled: int = 16_000,
) -> QualityModel:
    """Word vectors from all of ``docs`` and a network from the labelled, not held-out rows.

    At most ``max_labelled`` labelled documents are learned from. Of rows that repeat a
    key one is used. Without labelled documents of both classes the score is constant:
    the smoothed share of ones.
    """
    vectors = word_vectors(docs, text)
    held = docs.sparkSession.sparkContext.broadcast(vectors)

    def features(texts: pa.Array) -> pa.Array:
        return pa.array([pooled(t, held.value) for t in utf8(texts)], pa.list_(pa.float64()))

    sample = labelled_sample(labels, key, label, max_labelled)
    rows = (
        docs.select(column(key).alias("id"), column(text).alias("text"))
        .join(F.broadcast(sample), "id")  # at most max_labelled rows
        .select("id", "y", arrow_udf(features, "array<double>")("text").alias("x"))
        .groupBy("id", "y")
        .agg(F.min("x").alias("x"))
        .collect()
    )
    rows.sort(key=lambda r: (str(type(r.id)), r.id))
    y = np.array([r.y for r in rows], np.float64)
    if len(set(y)) < 2:
        none = np.zeros(FEATURES)
        return QualityModel(vectors, none, none + 1, None, constant=(y.sum() + 1) / (len(y) + 2))
    x = np.array([r.x for r in rows])
    calibrate = np.array([crc32(b"calibrate" + str(r.id).encode()) % 5 == 0 for r in rows])
    if len(set(y[calibrate])) < 2 or len(set(y[~calibrate])) < 2:
        calibrate[:] = False
    centre, scale = x[~calibrate].mean(0), x[~calibrate].std(0) + 1e-6
    model = QualityModel(vectors, centre, scale, fit_network((x[~calibrate] - centre) / scale, y[~calibrate]))
    if calibrate.any():
        model.temperature = best_temperature(model.logits(x[calibrate]), y[calibrate])
    return model


def quality_score(docs: DataFrame, model: QualityModel, text: str = "text") -> Column:
    """Calibrated probability of label 1 of the whole text; null is scored as the empty text."""
    held = docs.sparkSession.sparkContext.broadcast(model)

    def scored(texts: pa.Array) -> pa.Array:
        raw = utf8(texts)
        if not raw:
            return pa.array([], pa.float64())
        return pa.array(held.value.scores(np.array([pooled(t, held.value.vectors) for t in raw])))

    return arrow_udf(scored, "double").asNondeterministic()(column(text))


def score_documents(
    docs: DataFrame, labels: DataFrame, text: str = "text", key: str = "doc_id", into: str = "score", **options
) -> DataFrame:
    """``docs`` with ``into``, the quality score. Labels, source, language and key are no inputs.

    Rows that repeat a text score alike. An empty table stays empty. A column of ``docs``
    called ``into`` is replaced; other columns play no part.
    """
    model = fit_quality(docs, labels, text, key, **options)
    return docs.withColumn(into, quality_score(docs, model, text))


def drop_low_quality(
    docs: DataFrame, labels: DataFrame, threshold: float = 0.5, text: str = "text", **options
) -> DataFrame:
    """The rows of ``docs`` that score at least ``threshold``, with their own columns."""
    into = fresh(docs, "score")
    scored = score_documents(docs, labels, text, into=into, **options)
    return scored.filter(column(into) >= threshold).select(*[column(c) for c in docs.columns])
