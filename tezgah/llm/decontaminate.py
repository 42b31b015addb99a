"""Benchmark decontamination with suffix arrays over the training text.

Each batch of documents is a shard. Its suffix array holds the suffixes that
can start a match: those followed by enough words of the benchmark without a
break, in the order of their first ``window`` words. Every test suffix is
looked up in it by binary search; the suffixes found are extended to the
longest verbatim matches, which are reported with their places.

The benchmark is taken in blocks of bounded size; each block is sent to the
shards and passes over them once, and adds its matches to the documents' rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tezgah.llm.common import as_row, few_texts_a_batch, words_of

WINDOW = 10
#: Bytes of benchmark text sent to the executors at a time.
BLOCK_BYTES = 8 << 20
MATCH = "array<struct<item_id:long,item_pos:int,doc_pos:int,length:int>>"


class TestBlock:
    """Benchmark items as word numbers, and the search keys of all their suffixes."""

    def __init__(self, items: list[tuple[int | None, bytes | None]], window: int) -> None:
        self.window, self.number, ids, spans = window, {}, [], []
        self.names = [name for name, _ in items]
        at = 0
        for item, (_, text) in enumerate(items):
            words = words_of(text)
            ids += [self.number.setdefault(w, len(self.number) + 1) for w in words] + [0]
            spans.append((item, at, len(words)))
            at += len(words) + 1
        self.ids = np.array(ids + [0] * window, np.uint32)
        suffixes = [(item, start + p, min(window, n), p) for item, start, n in spans if n for p in range(max(1, n - window + 1))]
        self.item, self.at, self.width, self.pos = (np.array(x, np.int64) for x in zip(*suffixes, strict=True)) if suffixes else (np.empty(0, np.int64),) * 4
        short = self.width < window
        self.shortest = int(self.width.min()) if suffixes else window
        self.short_first = np.unique(self.ids[self.at[short]])
        # Keys have the width of a window: a shorter item's key is filled up with zeros, its upper bound with the greatest number.
        columns = np.arange(window)
        inside = columns < self.width[:, None]
        taken = self.ids[np.minimum(self.at[:, None] + columns, len(self.ids) - 1)]
        self.low = _keys(np.where(inside, taken, 0))
        self.high = _keys(np.where(inside, taken, 0xFFFFFFFF))


def _keys(numbers: np.ndarray) -> np.ndarray:
    """Rows of word numbers as byte strings that sort like them."""
    rows = np.ascontiguousarray(numbers.astype(">u4"))
    return rows.view(f"S{4 * rows.shape[1]}").ravel() if len(rows) else np.empty(0, f"S{4 * numbers.shape[1]}")


def shard_matches(texts: list[bytes | None], tests: TestBlock) -> tuple[list[int], list[list[tuple[int, int, int, int]]]]:
    """Word counts, and maximal matches (item, place in item, place in document, words) of each text."""
    number, window = tests.number.get, tests.window
    parts, sizes = [], []
    for text in texts:
        words = words_of(text)
        sizes.append(len(words))
        parts.append(np.fromiter((number(w, 0) for w in words), np.uint32, len(words)))
        parts.append(np.zeros(1, np.uint32))
    ids = np.concatenate([np.zeros(1, np.uint32), *parts, np.zeros(window, np.uint32)])
    firsts = np.concatenate([[1], 1 + np.cumsum(np.array(sizes, np.int64) + 1)])
    matches: list[list[tuple[int, int, int, int]]] = [[] for _ in texts]
    stops = np.flatnonzero(ids == 0)
    known = np.flatnonzero(ids)
    ahead = stops[np.searchsorted(stops, known)] - known
    fit = ahead >= window
    if len(tests.short_first):
        fit |= (ahead >= tests.shortest) & np.isin(ids[known], tests.short_first)
    known = known[fit]
    if not len(known) or not len(tests.at):
        return sizes, matches
    keys = _keys(ids[known[:, None] + np.arange(window)])
    order = np.argsort(keys, kind="stable")
    keys, suffixes = keys[order], known[order]
    low, high = np.searchsorted(keys, tests.low, "left"), np.searchsorted(keys, tests.high, "right")
    counts = np.maximum(high - low, 0)
    query = np.repeat(np.arange(len(counts)), counts)
    place = np.repeat(low, counts) + np.arange(len(query)) - np.repeat(np.cumsum(counts) - counts, counts)
    d, q = suffixes[place], tests.at[query]
    # A match that the word before also has is part of a longer one.
    starts = ~((tests.pos[query] > 0) & (ids[d - 1] == tests.ids[q - 1]))
    d, q, query = d[starts], q[starts], query[starts]
    length = tests.width[query].copy()
    alive = np.arange(len(d))
    while len(alive):
        a, b = ids[d[alive] + length[alive]], tests.ids[q[alive] + length[alive]]
        alive = alive[(a == b) & (b != 0)]
        length[alive] += 1
    doc = np.searchsorted(firsts, d, "right") - 1
    for k, i, p, at, n in zip(doc.tolist(), tests.item[query].tolist(), tests.pos[query].tolist(), (d - firsts[doc]).tolist(), length.tolist(), strict=True):
        matches[k].append((tests.names[i], p, at, n))
    return sizes, matches


def _blocks(benchmark: DataFrame, window: int, block_bytes: int) -> Iterator[TestBlock]:
    """The items in blocks of about ``block_bytes``; one block at a time is on the driver."""
    items = benchmark.select("item_id", F.col("text").cast("binary").alias("text"))
    total = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n = -(-total // block_bytes) or 1
    for k in range(n):
        part = items if n == 1 else items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(n)) == k)
        yield TestBlock([(r.item_id, r.text) for r in part.collect()], window)


def annotated(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, block_bytes: int = BLOCK_BYTES, keep: list[str] | None = None) -> DataFrame:
    """``(row, n_words, matches)``: each document's columns (or those of ``keep``) as a struct, its words, and its verbatim matches.

    A match is a run of words that a document shares with an item, of at least
    ``window`` words or of the whole of a shorter item, that neither side can
    extend. NULL and empty texts have no words and no matches, an item without
    words matches nothing. Rows of the benchmark without ``item_id`` match like
    others, with a NULL for the item. Repeated rows and repeated ids are matched
    row by row; no rows give no rows.
    """
    few_texts_a_batch(docs)
    spark = docs.sparkSession
    frame = docs.select(as_row(keep or docs.columns), F.col("text").cast("binary").alias("text"), F.lit(None).cast("int").alias("n_words"), F.array().cast(MATCH).alias("matches"))
    schema = T.StructType(frame.schema.fields)
    for block in _blocks(benchmark, window, block_bytes):
        sent = spark.sparkContext.broadcast(block)

        def search(batches: Iterator[pa.RecordBatch], sent=sent) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                sizes, found = shard_matches(batch.column("text").to_pylist(), sent.value)
                kind = batch.schema.field("matches").type
                names = [f.name for f in kind.value_type]
                if any(found):
                    had = batch.column("matches").to_pylist()
                    both = pa.array([h + [dict(zip(names, m, strict=True)) for m in f] for h, f in zip(had, found, strict=True)], kind)
                else:
                    both = batch.column("matches")
                columns = [batch.column("row"), batch.column("text"), pa.array(sizes, pa.int32()), both]
                yield pa.RecordBatch.from_arrays(columns, ["row", "text", "n_words", "matches"])

        frame = frame.mapInArrow(search, schema)
    return frame.select("row", "n_words", "matches")


def covered(matches: Column) -> Column:
    """How many of a document's words lie in any match."""
    spans = F.sort_array(F.transform(matches, lambda m: F.struct(m.doc_pos.alias("a"), (m.doc_pos + m["length"]).alias("b"))))
    start = F.struct(F.lit(0).cast("long").alias("n"), F.lit(0).alias("end"))
    step = lambda acc, s: F.struct((acc.n + F.greatest(F.lit(0), s.b - F.greatest(s.a, acc.end))).cast("long").alias("n"), F.greatest(acc.end, s.b).alias("end"))
    return F.aggregate(spans, start, step, lambda acc: acc.n)


def report(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """One row per document: words, words hit, the items that occur in it, and its longest match.

    Items without ``item_id`` hit words and contaminate, but are not among the
    items listed and counted, as they have no id to list. A document without
    words has zeros and no longest match.
    """
    found = annotated(docs, benchmark, window, keep=["doc_id"])
    items = F.array_sort(F.array_distinct(F.array_compact(F.transform("matches", lambda m: m.item_id.cast("string")))))
    longest = F.reverse(F.sort_array(F.transform("matches", lambda m: F.struct(m["length"], m.item_id, m.item_pos, m.doc_pos))))
    return (
        found.select(F.col("row.doc_id").alias("doc_id"), F.col("n_words").cast("long").alias("n_words"), covered(F.col("matches")).alias("n_hit"), items.alias("items"), F.get(longest, F.lit(0)).alias("longest"))
        .select(
            "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
            F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"),
            F.col("longest.length").alias("longest_match"), F.col("longest.item_id").alias("longest_item"),
            F.col("longest.item_pos").alias("longest_item_pos"), F.col("longest.doc_pos").alias("longest_doc_pos"),
        )
    )


def clean(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """The documents without any match, in their own columns; those without text stay, and no rows give no rows."""
    return annotated(docs, benchmark, window).where(F.size("matches") == 0).select("row.*")


