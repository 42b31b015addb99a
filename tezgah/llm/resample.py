"""Resampling towards a target distribution, with ranks by parallel sorting by regular sampling.

Hashed n-grams of the documents and of a target are counted in a fixed number of
buckets. A bucket's gain is the logarithm of how much more often the target has it;
a document's weight is the mean gain of its features, looked up in an array. With
a keyed Gumbel number added, the highest scores are a draw without replacement in
proportion to the weights.

Ranks need all scores in order. Every task sorts its own rows and keeps them as a
run; rows at regular steps of the runs give splitters; each run deals its rows out
between the splitters; a segment is merged where it arrives; and counts of the
segments before it turn a row's place there into its rank.
"""

from __future__ import annotations

import hashlib
import math
import zlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tezgah.functions.literals import literal_rows
from tezgah.llm.common import _WORD, few_texts_a_batch, keyed, partitions
from tezgah.sources.shared import stored

BUCKETS = 10_000
#: Words a document needs to be drawn, percent drawn, and the key of the draw.
WORDS, SHARE, SEED = 20, 25, 7
#: Regular samples for each segment; a segment is then at most 1 + 2 / OVER times its share of the rows, whatever the scores.
OVER = 32
#: Bytes of text cut into words at a time; a longer text is cut between words.
GROUP = 2_000_000
#: Longest word, in bytes, whose effect on a checksum is looked up; the pairs of longer ones are hashed one by one.
TABLED = 48

_LOCAL = 33  # monotonically_increasing_id: partition above, row number below
_ORDER = ["down", "keyless", "id", "n_features", "n_words", "place"]


def _zeros_appended() -> np.ndarray:
    """``[n, k, b]``: what byte ``k`` of a checksum, valued ``b``, becomes after ``n`` more zero bytes, n up to TABLED + 1."""
    step = np.array([zlib.crc32(bytes([b]), 0xFFFFFFFF) ^ 0xFFFFFFFF for b in range(256)], np.uint32)
    out = np.empty((TABLED + 2, 4, 256), np.uint32)
    out[0] = np.arange(256, dtype=np.uint32) << np.arange(0, 32, 8, dtype=np.uint32)[:, None]
    for n in range(1, TABLED + 2):
        out[n] = (out[n - 1] >> 8) ^ step[out[n - 1] & 255]
    return out


class Features:
    """Buckets of the runs of one and two words of texts, whole arrays at a time.

    A checksum of two strings joined is that of the first, carried over as many
    zero bytes as the second has, with that of the second; so each different word
    is hashed once a group and pairs are two lookups.
    """

    def __init__(self) -> None:
        self.shift = _zeros_appended()

    def groups(self, texts: Iterable[bytes | None]) -> Iterator[tuple[np.ndarray, np.ndarray, list[bytes]]]:
        """``(text, fresh, words)``: the number of each word's text, and whether it is new (not the last word before a cut, which only opens a pair)."""
        owner, fresh, words, size = [], [], [], 0
        for k, text in enumerate(texts):
            raw = (text or b"").translate(_WORD)
            at, last = 0, []
            while at < len(raw):
                end = len(raw)
                if end - at > GROUP:
                    end = raw.rfind(b" ", at, at + GROUP) + 1 or raw.find(b" ", at) + 1 or end
                new = raw[at:end].split()
                words += last + new
                owner += [k] * (len(last) + len(new))
                fresh += [False] * len(last) + [True] * len(new)
                size, at, last = size + end - at, end, []
                if size >= GROUP and words:
                    yield np.array(owner, np.int64), np.array(fresh, bool), words
                    owner, fresh, last, words, size = [], [], words[-1:] if owner and owner[-1] == k else [], [], 0
        if words:
            yield np.array(owner, np.int64), np.array(fresh, bool), words

    def buckets(self, texts: Iterable[bytes | None], buckets: int) -> Iterator[tuple[np.ndarray, np.ndarray, int]]:
        """``(text, bucket, words)`` of every feature, in groups; ``words`` of them are single words, in front."""
        for owner, fresh, words in self.groups(texts):
            coded = pa.array(words, pa.binary()).dictionary_encode()
            code, different = coded.indices.to_numpy(), coded.dictionary.to_numpy(zero_copy_only=False).tolist()
            alone = np.array([zlib.crc32(w) for w in different], np.uint32)
            second = np.array([zlib.crc32(b" " + w) for w in different], np.uint32)
            length = np.array([len(w) + 1 for w in different])
            first, then = code[:-1], code[1:]
            inside = owner[:-1] == owner[1:]
            first, then, of = first[inside], then[inside], owner[1:][inside]
            n = length[then]
            short = np.minimum(n, TABLED + 1)
            crc = alone[first]
            pair = second[then]
            for k in range(4):
                pair = pair ^ self.shift[short, k, (crc >> np.uint32(8 * k)) & np.uint32(255)]
            for i in np.flatnonzero(n > TABLED + 1):
                pair[i] = zlib.crc32(b" " + different[then[i]], int(crc[i]))
            singles = alone[code[fresh]]
            yield np.r_[owner[fresh], of], np.r_[singles, pair].astype(np.int64) % buckets, len(singles)


@dataclass(frozen=True)
class Gains:
    """A bucket's gain in thousandths: how much more often the target has it than the documents."""

    gain: np.ndarray

    @classmethod
    def of(cls, source: np.ndarray, target: np.ndarray) -> Gains:
        n, s, t = len(source), int(source.sum()), int(target.sum())
        return cls(np.array([math.floor(1000 * math.log((float(b) + 1) * (float(s) + n) / ((float(a) + 1) * (float(t) + n)))) for a, b in zip(source.tolist(), target.tolist(), strict=True)], np.int64))


def counted(docs: DataFrame, buckets: int = BUCKETS) -> np.ndarray:
    """Features of all texts per bucket. Tasks add up first; ``buckets`` rows reach the driver."""
    few_texts_a_batch(docs)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        features, total = Features(), np.zeros(buckets, np.int64)
        for batch in batches:
            for _, bucket, _ in features.buckets(batch.column("text").to_pylist(), buckets):
                total += np.bincount(bucket, minlength=buckets)
        held = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(held), pa.array(total[held])], ["bucket", "n"])

    raw = docs.select(F.col("text").cast("binary").alias("text"))
    out = np.zeros(buckets, np.int64)
    for r in raw.mapInArrow(count, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n")).collect():
        out[r.bucket] = r.n
    return out


def gumbel(doc_id: int | None, seed: int) -> int:
    """A number from the row's id alone, in thousandths; a NULL id counts as an empty string."""
    h = int(hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
    return math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))


def scored(docs: DataFrame, gains: Gains, seed: int = SEED) -> DataFrame:
    """``(place, doc_id, n_words, n_features, weight, score)`` of rows with ``place, doc_id, text``."""
    few_texts_a_batch(docs)
    gain = gains.gain

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        features = Features()
        for batch in batches:
            rows = batch.num_rows
            words, n, total = (np.zeros(rows, np.int64) for _ in range(3))
            for of, bucket, single in features.buckets(batch.column("text").to_pylist(), len(gain)):
                words += np.bincount(of[:single], minlength=rows)
                n += np.bincount(of, minlength=rows)
                np.add.at(total, of, gain[bucket])
            weight = np.where(n > 0, total // np.maximum(n, 1), 0)
            ids = batch.column("doc_id").to_pylist()
            score = weight + np.array([gumbel(i, seed) for i in ids], np.int64)
            yield pa.RecordBatch.from_arrays([batch.column("place"), pa.array(ids, pa.int64()), *map(pa.array, (words, n, weight, score))], names)

    names = ["place", "doc_id", "n_words", "n_features", "weight", "score"]
    return docs.select("place", "doc_id", F.col("text").cast("binary").alias("text")).mapInArrow(score, ", ".join(f"{c} long" for c in names))


def _comparable(columns: list[np.ndarray]) -> np.ndarray:
    """Rows of BIGINTs as byte strings that sort as the rows do."""
    raised = np.stack([np.ascontiguousarray(c, np.int64).view(np.uint64) ^ np.uint64(1 << 63) for c in columns], 1)
    return np.ascontiguousarray(raised.astype(">u8")).view(f"S{8 * len(columns)}").ravel()


def ranked(rows: DataFrame, segments: int | None = None) -> DataFrame:
    """``rows`` (as from ``scored``) with ``rank``: 1, 2, 3 ... by falling score.

    Ties go to the smaller ``doc_id`` (NULL last), then fewer features and words;
    rows equal in all of that are told apart by their place, so no value of a third
    of all rows can fill a segment of its own. ``segments`` are as many as the
    session's shuffle partitions. Rows and columns stay as they are.
    """
    spark = rows.sparkSession
    p = segments or partitions(spark)
    keys = rows.withColumns({"down": -F.col("score"), "keyless": F.col("doc_id").isNull().cast("long"), "id": F.coalesce("doc_id", F.lit(0))})
    run = keys.sortWithinPartitions(*_ORDER).withColumn("at", F.monotonically_increasing_id())
    runs = stored(run, "runs")
    n = runs.count()
    step = max(1, n // (p * OVER))
    number = F.col("at").bitwiseAND(F.lit((1 << _LOCAL) - 1))
    phase = F.pmod(F.shiftright("at", _LOCAL) * 0x9E3779B1, F.lit(step))  # a run shorter than a step counts by its share
    samples = runs.where((number + phase) % step == 0).select(*_ORDER).collect()  # about OVER a segment and at most one more a run
    splitters = _comparable(list(np.array(sorted(samples), np.int64).reshape(-1, len(_ORDER)).T))
    splitters = splitters[[k * len(splitters) // p for k in range(1, p)]] if len(splitters) else splitters

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = np.searchsorted(splitters, _comparable([batch.column(c).to_numpy() for c in _ORDER]), "right")
            yield batch.append_column("segment", pa.array(found, pa.int32()))

    dealt = runs.drop("at").mapInArrow(deal, f"{runs.drop('at').schema.simpleString()[7:-1].replace(':', ' ').replace(',', ', ')}, segment int")
    merged = dealt.repartitionById(p, "segment").sortWithinPartitions("segment", *_ORDER).withColumn("at", F.monotonically_increasing_id())
    merged = stored(merged, "segments")
    counts = merged.groupBy("segment").agg(F.count("*").alias("n"), F.min("at").alias("first")).orderBy("segment").collect()  # one row a segment
    before, offsets = 0, []
    for c in counts:
        offsets.append((c.segment, before + 1 - c.first))
        before += c.n
    offsets = literal_rows(spark, offsets or [(0, 0)], "segment int, offset bigint")
    return merged.join(F.broadcast(offsets), "segment").select(*rows.columns, (F.col("at") + F.col("offset")).alias("rank"))


def resampled(docs: DataFrame, target: DataFrame, share: int = SHARE, words: int = WORDS, seed: int = SEED, buckets: int = BUCKETS) -> DataFrame:
    """``(place, doc_id, n_words, n_features, weight, score, rank)`` of every row of ``place, doc_id, text``.

    ``rank`` is NULL for documents of fewer than ``words`` words and for those not
    among the ``floor(share * N / 100)`` highest of the N others. NULL and empty
    texts have no features and weight 0. Rows that repeat a ``doc_id`` are drawn
    each. An empty target, or no documents, leaves counts of zero.
    """
    gains = Gains.of(counted(docs, buckets), counted(target, buckets))
    rows = stored(scored(docs, gains, seed), "scores")
    able = rows.where(F.col("n_words") >= words)
    drawn = able.count() * share // 100
    out = ranked(able).withColumn("rank", F.when(F.col("rank") <= drawn, F.col("rank")))
    return out.unionByName(rows.where(F.col("n_words") < words).withColumn("rank", F.lit(None).cast("long")))


def draw(docs: DataFrame, target: DataFrame, share: int = SHARE, words: int = WORDS, seed: int = SEED) -> DataFrame:
    """The documents drawn, with all their columns."""
    base = keyed(docs, "numbered")
    rows = resampled(base.select("place", "row.doc_id", "row.text"), target, share, words, seed)
    return base.join(rows.where("rank is not null").select("place"), "place", "left_semi").select("row.*")


def report(docs: DataFrame, target: DataFrame) -> DataFrame:
    """``(doc_id, n_features, weight, score, rank)`` of every document."""
    rows = resampled(docs.select(F.monotonically_increasing_id().alias("place"), "doc_id", "text"), target)
    return rows.select("doc_id", "n_features", "weight", "score", "rank")
