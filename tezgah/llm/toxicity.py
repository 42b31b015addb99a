"""Toxicity by bags of subword embeddings under a linear softmax, trained in numpy.

A word is the mean of the vectors of its character n-grams, a document the mean
of its different words, and two classes are told apart by a softmax over that. Vectors
and softmax are trained together. Misspelt and unseen words get their vectors
from the n-grams that they share with words seen in training.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import blake2b

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tezgah.sources.shared import stored

#: Labelled rows that the model is fitted on at most, toxic and not; those of the least hash are taken.
TOXIC_ROWS, OTHER_ROWS = 2_000, 6_000
BUCKETS = 1 << 17
DIM = 8
LENGTHS = (3, 4, 5)
EPOCHS = 20
BATCH = 64
RATE = 0.05
DECAY = 1e-5
#: Added to the root in an Adam step, so that what few texts have moves little.
SOFTENING = 1e-3
#: The mean of a text's words is multiplied by this, so that few words in a long text can turn the verdict.
GAIN = 60.0
#: Words without a vector that every text has besides its own, so that a short text's mean stays small.
SILENT_WORDS = 20
SEED = 7
#: Texts scored at a time.
TEXTS = 1_000
THRESHOLD = 0.7

_LETTERS = bytes(b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 128 else 32 for b in range(256))


def words_of(text: bytes | None) -> list[bytes]:
    return (text or b"").translate(_LETTERS).split()


def grams_of(words: list[bytes], buckets: int = BUCKETS) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of the character n-grams of all words, with their word's number in order; ``<`` and ``>`` bound a word."""
    points = np.frombuffer("".join(f"<{w.decode('utf-8', 'replace')}>" for w in words).encode("utf-32-le"), np.uint32)
    word = np.cumsum(points == ord("<")) - 1
    found, owners = [], []
    with np.errstate(over="ignore"):
        for n in LENGTHS:
            if len(points) < n:
                continue
            count = len(points) - n + 1
            hashed = np.full(count, n, np.uint64)
            for k in range(n):
                hashed = (hashed ^ points[k : k + count]) * np.uint64(0x9E3779B97F4A7C15)
                hashed ^= hashed >> np.uint64(29)
            whole = word[:count] == word[n - 1 :]
            found.append((hashed[whole] % np.uint64(buckets)).astype(np.int32))
            owners.append(word[:count][whole])
    if not found:
        return np.empty(0, np.int32), np.empty(0, np.int64)
    grams, owner = np.concatenate(found), np.concatenate(owners)
    order = np.argsort(owner, kind="stable")
    return grams[order], owner[order]


def features(text: bytes | None) -> tuple[np.ndarray, np.ndarray]:
    """The buckets of a text and their weights in the mean of its words."""
    words = words_of(text)
    if not words:
        return np.empty(0, np.int32), np.empty(0, np.float32)
    different = sorted(set(words))
    grams, owner = grams_of(different)
    per_word = np.bincount(owner, minlength=len(different))
    weight = (1 / np.maximum(per_word, 1))[owner] / (len(different) + SILENT_WORDS)
    buckets, at = np.unique(grams, return_inverse=True)
    return buckets, np.bincount(at, weight).astype(np.float32)


class Model:
    """The trained vectors, folded to what each bucket adds to the log odds."""

    def __init__(self, odds: np.ndarray, bias: float) -> None:
        self.odds, self.bias = odds, bias

    def scores(self, texts: list[bytes | None]) -> np.ndarray:
        parts = [self._scores(texts[at : at + TEXTS]) for at in range(0, len(texts), TEXTS)]
        return np.concatenate(parts) if parts else np.empty(0)

    def _scores(self, texts: list[bytes | None]) -> np.ndarray:
        cut = [set(words_of(t)) for t in texts]
        different = {w: k for k, w in enumerate(set().union(*cut))}
        grams, owner = grams_of(list(different), len(self.odds))
        per_word = np.bincount(owner, minlength=len(different))
        of_word = np.bincount(owner, self.odds[grams], minlength=len(different)) / np.maximum(per_word, 1)
        number = different.__getitem__
        means = [float(of_word[np.sort(np.fromiter(map(number, w), np.int64, len(w)))].sum()) / (len(w) + SILENT_WORDS) for w in cut]
        return 1 / (1 + np.exp(-np.clip(GAIN * np.array(means, np.float64) + self.bias, -700, 700)))


def fit(rows: list[tuple[np.ndarray, np.ndarray, int]], buckets: int = BUCKETS, epochs: int = EPOCHS, seed: int = SEED) -> Model:
    """Trains vectors and softmax on ``(buckets, weights, label)`` of each text by Adam steps over small batches."""
    rng = np.random.default_rng(seed)
    vectors = np.zeros((buckets, DIM), np.float32)  # an n-gram never trained says nothing
    softmax = rng.normal(0, 0.1, (DIM, 2)).astype(np.float32)
    bias = np.zeros(2, np.float32)
    state = {k: [np.zeros_like(p), np.zeros_like(p)] for k, p in (("v", vectors), ("s", softmax), ("b", bias))}
    labels = np.array([r[2] for r in rows])
    step = 0

    def adam(param: np.ndarray, grad: np.ndarray, key: str, at=slice(None), softening: float = 1e-6) -> None:
        m, v = state[key]
        m[at] = 0.9 * m[at] + 0.1 * grad
        v[at] = 0.99 * v[at] + 0.01 * grad * grad
        param[at] -= RATE * (m[at] / (1 - 0.9**step)) / (np.sqrt(v[at] / (1 - 0.99**step)) + softening)

    for _ in range(epochs if len(set(labels.tolist())) == 2 else 0):
        order = rng.permutation(len(rows))
        for at in range(0, len(order), BATCH):
            part = order[at : at + BATCH]
            step += 1
            sizes = [len(rows[i][0]) for i in part]
            ids = np.concatenate([rows[i][0] for i in part])
            doc = np.repeat(np.arange(len(part)), sizes)
            weight = np.concatenate([rows[i][1] for i in part])
            used, local = np.unique(ids, return_inverse=True)
            mixed = np.zeros((len(part), len(used)), np.float32)
            mixed[doc, local] = weight * GAIN
            mean = mixed @ vectors[used]
            logits = mean @ softmax + bias
            p = np.exp(logits - logits.max(axis=1, keepdims=True))
            p /= p.sum(axis=1, keepdims=True)
            p[np.arange(len(part)), labels[part]] -= 1
            p /= len(part)
            down = mixed.T @ (p @ softmax.T) + DECAY * vectors[used]
            adam(softmax, mean.T @ p, "s")
            adam(bias, p.sum(axis=0), "b")
            adam(vectors, down, "v", used, SOFTENING)
    return Model((vectors @ (softmax[:, 1] - softmax[:, 0])).astype(np.float64), float(bias[1] - bias[0]))


def _sampled(texts: DataFrame) -> list[tuple[np.ndarray, np.ndarray, int]]:
    """Features of the labelled rows that the model is fitted on, worked out where the texts are and fetched part by part."""

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            both = [features(t) for t in batch.column("text").to_pylist()]
            columns = [pa.array([b.astype("<i4").tobytes() for b, _ in both], pa.binary()), pa.array([w.astype("<f4").tobytes() for _, w in both], pa.binary()), batch.column("toxic")]
            yield pa.RecordBatch.from_arrays(columns, ["buckets", "weights", "toxic"])

    rows = texts.select(F.col("text").cast("binary").alias("text"), F.col("toxic").cast("int")).mapInArrow(of, "buckets binary, weights binary, toxic int")
    return [(np.frombuffer(r.buckets, "<i4"), np.frombuffer(r.weights, "<f4"), r.toxic) for r in stored(rows, "features").toLocalIterator()]


def _in_order(row: tuple[np.ndarray, np.ndarray, int]) -> tuple[int, bytes]:
    """A place that depends on a row alone, so that any order of arrival trains the same model."""
    return row[2], blake2b(row[0].tobytes() + row[1].tobytes(), digest_size=16).digest()


def train(docs: DataFrame, labels: DataFrame, toxic_rows: int = TOXIC_ROWS, other_rows: int = OTHER_ROWS) -> Model:
    """A model from the labelled rows that may be learned from.

    ``labels`` has ``doc_id`` and ``toxic``; other labels than 0 and 1 teach
    nothing. Where documents or labels repeat an id, one row of it is taken at
    most for each pair of text and label. One class alone, or no rows, give a
    model that scores every text 0.5.
    """
    usable = labels.where(F.col("toxic").isin(0, 1)).select("doc_id", F.col("toxic").cast("int").alias("toxic")).distinct()
    ids = [usable.where(F.col("toxic") == k).orderBy(F.xxhash64("doc_id"), "doc_id").limit(n) for k, n in ((0, other_rows), (1, toxic_rows))]
    taken = F.broadcast(ids[0].union(ids[1]))  # as many rows as the two bounds at most
    rows = _sampled(docs.select("doc_id", "text").join(taken, "doc_id"))
    return fit(sorted(rows, key=_in_order))


def scored(docs: DataFrame, model: Model) -> DataFrame:
    """``(doc_id, score)`` of every row; texts without words get the score of the bias alone."""
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            scores = sent.value.scores(batch.column("text").to_pylist())
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(scores, pa.float64())], ["doc_id", "score"])

    return docs.select("doc_id", F.col("text").cast("binary").alias("text")).mapInArrow(of, "doc_id long, score double")
