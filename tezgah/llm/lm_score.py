"""Cross-entropy difference: how much more a document looks like a target corpus than like all text.

Two bigram models, one of the target documents and one of all documents, are
counted over the whole corpus with one vocabulary, the same retained bigrams
and the same smoothing. A token's loss under the target model less its loss
under the background model, averaged over a document, is its score; lower is
nearer to the target.

The vocabulary is every word that the target holds ``MIN_COUNT`` times, and a
bigram is retained if either side holds it as often, so the models grow with the
corpus. What is sent to the executors does not: the most frequent words and
bigrams, up to ``SENT_WORDS`` and ``SENT_BIGRAMS``, are looked up there, and all
others are joined by a shuffle. The bounds change no result.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from tezgah.functions.literals import literal_rows
from tezgah.llm.common import words_of
from tezgah.operators.ranking import global_row_number
from tezgah.sources.shared import stored

MIN_COUNT = 2
DISCOUNT = 0.75
#: Words and bigrams sent to all executors, some 80 and 24 bytes each in every worker; others are joined by a shuffle.
SENT_WORDS, SENT_BIGRAMS = 2_000_000, 1_000_000
#: Words sent that a worker keeps in a dictionary, some 150 bytes each; others are found by their checksums.
FAST = 100_000
#: Bits of a map of all retained bigrams (4 bytes for each 32), so that most others are not joined; a prime.
MAP = 268_435_399
#: Checksums of the vocabulary's other words that are sent, 4 bytes each, so that only words that may be in it are joined.
SENT_CHECKSUMS = 4_000_000
#: Different words a task counts before it passes its counts on.
HELD = 300_000
#: Texts that a worker holds as numbers at a time.
TEXTS = 1_000
#: Target ids are sent to all executors up to this many; more are joined by a shuffle.
SENT_IDS = 1_000_000
_SIDES = ("target", "background")


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for start in range(0, batch.num_rows, TEXTS):
            yield batch.slice(start, TEXTS)


def _word_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held: tuple[Counter, Counter] = Counter(), Counter()

    def passed() -> pa.RecordBatch:
        words = list(held[1])
        columns = [pa.array(words, pa.binary()), pa.array([held[0][w] for w in words], pa.int64()), pa.array(list(held[1].values()), pa.int64())]
        for h in held:
            h.clear()
        return pa.RecordBatch.from_arrays(columns, ["word", "target", "background"])

    for batch in batches:
        for text, wanted in zip(batch.column("text").to_pylist(), batch.column("wanted").to_pylist(), strict=True):
            words = words_of(text)
            held[1].update(words)
            if wanted:
                held[0].update(words)
            if len(held[1]) > HELD:
                yield passed()
    if held[1]:
        yield passed()


class _Numbers(dict):
    """Numbers of words; any other word gets one below 0, in order of ``others``, until it is taken out."""

    def __missing__(self, word: bytes) -> int:
        self.others.append(word)
        self[word] = n = -len(self.others)
        return n


class Vocabulary:
    """Word numbers from 1, by falling frequency; 0 is every other word, ``begin`` the start of a document.

    It holds the first words of its ``size``: ``FAST`` in a dictionary, the rest end to end
    in order of their checksums. ``checksums`` are those of the words it doesn't hold, sorted, if they are sent.
    """

    def __init__(self, words: list[bytes], size: int, checksums: np.ndarray | None = None) -> None:
        self.held, self.size, self.checksums = len(words), size, checksums
        self.begin = size + 1
        self.span = size + 2
        self.fast, slow = words[:FAST], words[FAST:]
        crc = np.array([zlib.crc32(w) for w in slow], np.uint32)
        self.ids = np.argsort(crc, kind="stable")
        self.crc, slow = crc[self.ids], [slow[k] for k in self.ids]
        self.ends, self.text = np.cumsum([len(w) for w in slow]).astype(np.int64), b"".join(slow)
        self.ids += len(self.fast) + 1

    def __getstate__(self) -> dict:
        return {k: v for k, v in self.__dict__.items() if k != "numbers"}

    def local(self, number: Column) -> Column:
        """Whether a number's figures are sent."""
        return (number <= self.held) | (number == self.begin)

    def _found(self, words: list[bytes]) -> np.ndarray:
        """Numbers of words that are not in the dictionary: 0 outside the vocabulary, -1, -2, ... if that is not known here."""
        crc = np.fromiter(map(zlib.crc32, words), np.uint32, len(words))
        if self.held == self.size:
            found = np.zeros(len(words), np.int64)
        else:
            found = -1 - np.arange(len(words))
            if self.checksums is not None:
                found[~np.isin(crc, self.checksums)] = 0
        low, high = np.searchsorted(self.crc, crc), np.searchsorted(self.crc, crc, "right")
        for k in np.flatnonzero(low < high).tolist():
            for at in range(low[k], high[k]):
                if self.text[self.ends[at - 1] if at else 0 : self.ends[at]] == words[k]:
                    found[k] = self.ids[at]
        return found

    def tokens(self, texts: list[bytes | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray, list[bytes]]:
        """Each token's word before, each token's word, how many tokens each text has, and the words that -1, -2, ... stand for."""
        if "numbers" not in self.__dict__:
            self.numbers = _Numbers(zip(self.fast, range(1, len(self.fast) + 1), strict=True))
        numbers, others = self.numbers, []
        numbers.others = others
        of = numbers.__getitem__
        parts = [np.fromiter(map(of, words_of(t)), np.int64) for t in texts]
        for word in others:
            del numbers[word]
        sizes = np.array([len(p) for p in parts], np.int64)
        now = np.concatenate(parts) if parts else np.empty(0, np.int64)
        if others:
            missed = now < 0
            now[missed] = self._found(others)[-now[missed] - 1]
        before = np.r_[np.int64(self.begin), now[:-1]] if len(now) else now
        starts = (np.cumsum(sizes) - sizes)[sizes > 0]
        before[starts] = self.begin
        return before, now, sizes, others


def _named(before: np.ndarray, now: np.ndarray, others: list[bytes]) -> list[pa.Array]:
    """Numbers and words of bigrams with a word below 0; the other word is a text that no word equals."""
    pairs = list(zip(before.tolist(), now.tolist(), strict=True))
    first = [others[-b - 1] if b < 0 else b" " + others[-n - 1] for b, n in pairs]
    second = [others[-n - 1] if n < 0 else b" " + others[-b - 1] for b, n in pairs]
    return [pa.array(before), pa.array(now), pa.array(first, pa.binary()), pa.array(second, pa.binary())]


_NAMED = ["before", "now", "before_word", "now_word"]
_NAMED_DDL = "before long, now long, before_word binary, now_word binary"


def _resolved(named: DataFrame, words: DataFrame) -> DataFrame:
    """Numbers for the words of ``_named`` rows, 0 for those outside the vocabulary; other columns of ``words`` come along.

    ``words`` has ``word``, ``id`` and more; each comes back with ``before_`` and ``now_`` before its name.
    """
    for side in ("before", "now"):
        named = named.join(words.select([F.col(c).alias(f"{side}_{c}") for c in words.columns]), f"{side}_word", "left")
        named = named.withColumn(side, F.coalesce(f"{side}_id", F.greatest(side, F.lit(0))))
    return named


def _map(keys: DataFrame) -> np.ndarray:
    """A bit for each key modulo ``MAP``, of as many bytes however many keys there are."""
    place = F.col("key") % MAP + 1  # bits and parts count from 1
    parts = keys.groupBy(F.bitmap_bucket_number(place).alias("part")).agg(F.bitmap_construct_agg(F.bitmap_bit_position(place)).alias("bits")).toArrow()
    bits = np.zeros((MAP // 32_768 + 1, 4_096), np.uint8)
    for part, raw in zip(parts.column("part").to_pylist(), parts.column("bits").to_pylist(), strict=True):
        bits[part - 1] = np.frombuffer(raw, np.uint8)
    return bits.ravel()


def _in_map(bits: np.ndarray, key: np.ndarray) -> np.ndarray:
    place = key % MAP
    return (bits[place >> 3] >> (place & 7).astype(np.uint8) & 1).astype(bool)


def _least(frame: DataFrame, column: str, most: int) -> int:
    """The least value of a count that ``most`` rows or fewer reach."""
    rows = 0
    for value, n in frame.groupBy(column).count().orderBy(F.desc(column)).collect():  # different counts: their sum bounds them to its root
        rows += n
        if rows > most:
            return value + 1
    return 0


@dataclass
class Models:
    """What is sent of both models, and the rest as tables.

    The loss of a token is ``left`` of the word before and ``share`` of its word, less
    what its bigram gains; ``keys`` and ``gains`` are those of the bigrams sent,
    ``bits`` the map and ``retained`` the table of all, and ``unsent`` that of the words not sent.
    """

    vocabulary: Vocabulary
    left: np.ndarray
    share: np.ndarray
    keys: np.ndarray
    gains: np.ndarray
    bits: np.ndarray
    retained: DataFrame
    unsent: DataFrame

    def __getstate__(self) -> dict:
        return self.__dict__ | {"retained": None, "unsent": None}

    def place(self, number: np.ndarray) -> np.ndarray:
        """Where the figures of a word lie: ``begin`` comes behind the words sent."""
        return np.minimum(number, self.left.shape[1] - 1)


def _marked(docs: DataFrame, target_ids: DataFrame) -> DataFrame:
    ids = target_ids.select(F.col(target_ids.columns[0]).alias("doc_id")).where("doc_id is not null").distinct()
    wanted = ids.withColumn("wanted", F.lit(True))
    sent = F.broadcast(wanted) if ids.count() <= SENT_IDS else wanted
    return docs.select("doc_id", F.col("text").cast("binary").alias("text")).join(sent, "doc_id", "left").select("text", "wanted")


def _summed(frame: DataFrame, key: str) -> DataFrame:
    return frame.groupBy(key).agg(*[F.sum(s).alias(s) for s in _SIDES])


def _words(marked: DataFrame) -> tuple[DataFrame, dict[str, int]]:
    """``(word, target, background, id)`` of the vocabulary, and the tokens of each side."""
    seen = Observation()
    counts = _summed(marked.mapInArrow(_word_counts, "word binary, target long, background long"), "word")
    enough = counts.observe(seen, *[F.sum(s).alias(s) for s in _SIDES]).where(F.col("target") >= MIN_COUNT)
    words = stored(enough.withColumn("less", -F.col("background")), "words")
    totals = {s: seen.get[s] or 0 for s in _SIDES}
    if words.isEmpty():
        return words.drop("less").withColumn("id", F.lit(0).cast("long")), totals
    return stored(global_row_number(words, ["less", "word"], "id").drop("less"), "vocabulary"), totals


def train(docs: DataFrame, target_ids: DataFrame, sent_words: int = SENT_WORDS, sent_bigrams: int = SENT_BIGRAMS, sent_checksums: int = SENT_CHECKSUMS) -> Models:
    """Both models, counted over every document and over those that ``target_ids`` names.

    Without target documents the vocabulary is empty and both models give every
    token the same loss. The bounds are on what is sent and not on what is counted.
    """
    spark = docs.sparkSession
    marked = _marked(docs, target_ids)
    words, totals = _words(marked)
    size = words.count()
    first = words.where(F.col("id") <= sent_words).select("word", "id").toArrow().sort_by("id")
    unsent = words.where(F.col("id") > sent_words).select("word", "id")
    checksums = None
    if first.num_rows < size <= first.num_rows + sent_checksums:
        checksums = np.sort(unsent.select(F.crc32("word").alias("crc")).toArrow().column("crc").to_numpy().astype(np.uint32))
    vocabulary = Vocabulary(first.column("word").to_pylist(), size, checksums)
    span = vocabulary.span
    sent = spark.sparkContext.broadcast(vocabulary)

    def pairs(batches: Iterator[pa.RecordBatch], named: bool = False) -> Iterator[pa.RecordBatch]:
        for batch in _pieces(batches):
            before, now, sizes, others = sent.value.tokens(batch.column("text").to_pylist())
            wanted = np.repeat(np.array([bool(x) for x in batch.column("wanted").to_pylist()], bool), sizes)
            open_ = (before < 0) | (now < 0)
            if named:
                columns = _named(before[open_], now[open_], others)
                yield pa.RecordBatch.from_arrays([*columns, pa.array(wanted[open_].astype(np.int64)), pa.array(np.ones(open_.sum(), np.int64))], [*_NAMED, *_SIDES])
                continue
            # a side is the last bit, so that one sort counts both
            keys, n = np.unique((before * span + now)[~open_] * 2 + wanted[~open_], return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(keys >> 1), pa.array(np.where(keys & 1, n, 0)), pa.array(n)], ["key", *_SIDES])

    counted = marked.mapInArrow(pairs, "key long, target long, background long")
    if first.num_rows < size:
        named = _resolved(marked.mapInArrow(lambda batches: pairs(batches, named=True), f"{_NAMED_DDL}, target long, background long"), unsent)
        counted = counted.unionByName(named.select((F.col("before") * span + F.col("now")).alias("key"), *_SIDES))
    bigrams = stored(_summed(counted, "key"), "bigrams")
    enough = F.greatest(*_SIDES) >= MIN_COUNT
    known = {s: F.greatest(F.col(s) - DISCOUNT, F.lit(0.0)) for s in _SIDES}
    contexts = bigrams.groupBy(F.expr(f"key div {span}").alias("id")).agg(
        *[F.sum(s).alias(f"total_{s}") for s in _SIDES], *[F.sum(F.when(enough, known[s])).alias(f"kept_{s}") for s in _SIDES]
    )
    held = words.agg(*[F.coalesce(F.sum(s), F.lit(0)).alias(s) for s in _SIDES]).first()
    outside = literal_rows(spark, [(0, *[totals[s] - held[s] for s in _SIDES]), (vocabulary.begin, 0, 0)], "id long, target long, background long")
    figures = words.select("id", *_SIDES).unionByName(outside).join(contexts, "id", "left")
    total = {s: F.coalesce(f"total_{s}", F.lit(0)) for s in _SIDES}
    figures = stored(
        figures.select(
            "id",
            *[F.greatest(total[s], F.lit(1)).cast("double").alias(f"total_{s}") for s in _SIDES],
            *[(-F.log(F.when(total[s] > 0, 1 - F.coalesce(f"kept_{s}", F.lit(0.0)) / total[s]).otherwise(1.0))).alias(f"left_{s}") for s in _SIDES],
            *[(-F.log((F.col(s) + 1) / F.lit(float(totals[s] + size + 1)))).alias(f"share_{s}") for s in _SIDES],
        ),
        "figures",
    )
    local = figures.where(vocabulary.local(F.col("id"))).toArrow().sort_by("id")
    arrays = {c: local.column(c).to_numpy() for c in local.column_names}
    lookup = spark.sparkContext.broadcast(arrays)

    def looked_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last = len(lookup.value["id"]) - 1
        for batch in batches:
            key = batch.column("key").to_numpy()
            at = {"total": np.minimum(key // span, last), "left": np.minimum(key // span, last), "share": key % span}
            yield pa.RecordBatch.from_arrays([*batch.columns, *[pa.array(lookup.value[f"{c}_{s}"][at[c]]) for c in at for s in _SIDES]], [*batch.schema.names, *[f"{c}_{s}" for c in at for s in _SIDES]])

    kept = bigrams.where(enough)
    before, now = F.expr(f"key div {span}"), F.col("key") % span
    near = vocabulary.local(before) & vocabulary.local(now)
    ddl = ", ".join(f"{c}_{s} double" for c in ("total", "left", "share") for s in _SIDES)
    found = [kept.where(near).mapInArrow(looked_up, f"key long, target long, background long, {ddl}")]
    if first.num_rows < size:
        far = kept.where(~near).withColumns({"before": before, "now": now})
        far = far.join(figures.select(F.col("id").alias("before"), *[f"{c}_{s}" for c in ("total", "left") for s in _SIDES]), "before")
        far = far.join(figures.select(F.col("id").alias("now"), *[f"share_{s}" for s in _SIDES]), "now")
        found.append(far.select(found[0].columns))
    gain = {s: F.log1p(known[s] / F.col(f"total_{s}") * F.exp(F.col(f"left_{s}") + F.col(f"share_{s}"))).alias(f"gain_{s}") for s in _SIDES}
    gains = stored(reduce(DataFrame.unionByName, found).select("key", "background", *gain.values()), "gains")
    top = gains.where((F.col("background") >= _least(gains, "background", sent_bigrams)) & near).toArrow().sort_by("key")
    stack = lambda table, name: np.stack([table.column(f"{name}_{s}").to_numpy() for s in _SIDES])
    return Models(
        vocabulary, stack(local, "left"), stack(local, "share"), top.column("key").to_numpy(), stack(top, "gain"),
        _map(gains), gains.drop("background"), unsent.join(figures, "id") if first.num_rows < size else unsent,
    )


def scored(docs: DataFrame, models: Models) -> DataFrame:
    """``(doc_id, n_tokens, target_loss, background_loss, score)`` of every row.

    NULL, empty and wordless texts have no tokens and NULL losses and score.
    Repeated rows and ids are scored row by row; other columns are ignored.
    """
    sent = docs.sparkSession.sparkContext.broadcast(models)
    span, whole = models.vocabulary.span, models.vocabulary.held == models.vocabulary.size
    texts = docs.select("doc_id", F.col("text").cast("binary").alias("text"), F.monotonically_increasing_id().alias("place"))
    if not whole:
        texts = stored(texts, "texts")  # read twice, and places must be the same

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """A row of each text, whose key no bigram has, with the losses of its tokens, and one of each other bigram that may gain."""
        m = sent.value
        for batch in _pieces(batches):
            before, now, sizes, _ = m.vocabulary.tokens(batch.column("text").to_pylist())
            row = np.repeat(np.arange(len(sizes)), sizes)
            closed = (before >= 0) & (now >= 0)
            before, now, row = before[closed], now[closed], row[closed]
            key = before * span + now
            at = np.minimum(np.searchsorted(m.keys, key), max(len(m.keys) - 1, 0))
            known = m.keys[at] == key if len(m.keys) else np.zeros(len(key), bool)
            losses = []
            for k in (0, 1):
                loss = m.left[k][m.place(before)] + m.share[k][now]
                loss[known] -= m.gains[k][at[known]]
                losses.append(np.bincount(row, loss, minlength=len(sizes)).astype(np.float64))
            place = batch.column("place").to_numpy()
            columns = [pa.array(-1 - place), pa.array(place), batch.column("doc_id"), pa.array(sizes), *map(pa.array, losses)]
            yield pa.RecordBatch.from_arrays(columns, ["key", "place", "doc_id", "n", *_SIDES])
            rest = np.flatnonzero(~known)
            rest = rest[_in_map(m.bits, key[rest])]
            key, place = key[rest], place[row[rest]]
            none = [pa.nulls(len(key), t) for t in (pa.int64(), pa.int64(), pa.float64(), pa.float64())]
            yield pa.RecordBatch.from_arrays([pa.array(key), pa.array(place), *none], ["key", "place", "doc_id", "n", *_SIDES])

    def named(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = sent.value
        for batch in _pieces(batches):
            before, now, sizes, others = m.vocabulary.tokens(batch.column("text").to_pylist())
            open_ = (before < 0) | (now < 0)
            place = np.repeat(batch.column("place").to_numpy(), sizes)[open_]
            before, now = before[open_], now[open_]
            # of a word with no figures here those of the words outside the vocabulary, in case it is one of them
            parts = [a[k][m.place(np.maximum(x, 0))] for a, x in ((m.left, before), (m.share, now)) for k in (0, 1)]
            yield pa.RecordBatch.from_arrays([*_named(before, now, others), pa.array(place), *map(pa.array, parts)], [*_NAMED, "place", *[f"{c}_{s}" for c in ("left", "share") for s in _SIDES]])

    rows = texts.mapInArrow(of, "key long, place long, doc_id long, n long, target double, background double")
    if not whole:
        ddl = ", ".join(f"{c}_{s} double" for c in ("left", "share") for s in _SIDES)
        open_ = _resolved(texts.mapInArrow(named, f"{_NAMED_DDL}, place long, {ddl}"), models.unsent)
        loss = [(F.coalesce(f"before_left_{s}", f"left_{s}") + F.coalesce(f"now_share_{s}", f"share_{s}")).alias(s) for s in _SIDES]
        none = F.lit(None).cast("long")
        rows = rows.unionByName(open_.select((F.col("before") * span + F.col("now")).alias("key"), "place", none.alias("doc_id"), none.alias("n"), *loss))
    joined = rows.join(models.retained, "key", "left").where("target is not null or gain_target is not null")
    mine = {s: F.coalesce(s, F.lit(0.0)) - F.coalesce(f"gain_{s}", F.lit(0.0)) for s in _SIDES}
    totals = joined.groupBy("place").agg(F.max("doc_id").alias("doc_id"), F.sum("n").alias("n_tokens"), *[F.sum(mine[s]).alias(s) for s in _SIDES])
    mean = {s: F.when(F.col("n_tokens") > 0, F.col(s) / F.col("n_tokens")) for s in _SIDES}
    return totals.select("doc_id", "n_tokens", *[mean[s].alias(f"{s}_loss") for s in _SIDES], (mean["target"] - mean["background"]).alias("score"))
