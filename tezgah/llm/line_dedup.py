"""Repeated runs of lines, found by winnowing over line hashes.

A window is the shortest run of lines from a line on, or up to a line, that
holds ``MIN_WORDS`` words. Of each window the line of least hash is selected as
its fingerprint, so two equal runs of that many words share a fingerprint
wherever they stand. Windows whose fingerprint has one position only are
dropped. The others are joined with the first position of the same window;
what follows there is repeated, and windows that chain together reach both
ways to the ends of the repeated run. Later runs are deleted, the first stays.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tezgah.llm.common import few_texts_a_batch, keyed, rank
from tezgah.sources.shared import stored

MIN_WORDS = 50
_FOUND = T.StructType().add("text", "string").add("n_lines", "long").add("n_deleted", "long").add("words_left", "boolean")
#: Texts cut into windows at a time.
TEXTS = 500
WINDOWS = "rank struct<last: boolean, id: long, digest: long, place: long>, start int, stop int, anchor long, fresh int, content binary"


def line_runs(text: bytes | None, min_words: int = MIN_WORDS) -> list[tuple[int, int, int, int, bytes]]:
    """The windows of a text: first line, last line, fingerprint, whether its position is new, hash of the content.

    Lines are compared by their words, A-Z lower-cased; lines without words are passed over.
    """
    lines = [(k, w) for k, line in enumerate((text or b"").split(b"\n")) if (w := line.lower().split())]
    if not lines:
        return []
    ends = np.cumsum([0] + [len(w) for _, w in lines])
    digests = [xxhash.xxh3_128_digest(b" ".join(w)) for _, w in lines]
    short = [int.from_bytes(d[:8], "little", signed=True) for d in digests]
    n = len(lines)
    spans = {(i, int(j)) for i, j in enumerate(np.searchsorted(ends, ends[:-1] + min_words) - 1) if j < n}
    spans |= {(int(i), j) for j, i in enumerate(np.searchsorted(ends, ends[1:] - min_words, "right") - 1) if i >= 0}
    selected, out = set(), []
    for i, j in sorted(spans):
        at = min(range(i, j + 1), key=lambda k: (short[k], -k))
        out.append((lines[i][0], lines[j][0], short[at], int(at not in selected), xxhash.xxh3_128_digest(b"".join(digests[i : j + 1]))))
        selected.add(at)
    return out


def _windows(rows: DataFrame, min_words: int) -> DataFrame:
    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["rank", "start", "stop", "anchor", "fresh", "content"]
        kinds = [pa.int32(), pa.int32(), pa.int64(), pa.int32(), pa.binary()]
        for batch in (whole.slice(at, TEXTS) for whole in batches for at in range(0, whole.num_rows, TEXTS)):
            runs = [(k, *run) for k, text in enumerate(batch.column("text").to_pylist()) for run in line_runs(text, min_words)]
            if runs:
                at, *columns = zip(*runs, strict=True)
                yield pa.RecordBatch.from_arrays([batch.column("rank").take(pa.array(at)), *(pa.array(x, t) for x, t in zip(columns, kinds, strict=True))], names)

    return rows.select(rank(F.col("row.doc_id"), F.col("row.text"), F.col("place")).alias("rank"), F.col("row.text").cast("binary").alias("text")).mapInArrow(of, WINDOWS)


def repeated_runs(rows: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """``(place, runs)``: spans ``start, stop`` of lines that repeat an earlier run, of each of the keyed rows with any.

    Earlier is of lesser rank (by ``doc_id`` first), or further up in the same
    row. Spans may overlap; together they cover the repeated runs.
    """
    windows = stored(_windows(rows, min_words), "windows")
    shared = windows.groupBy("anchor").agg(F.sum("fresh").alias("n")).where("n > 1").select("anchor")
    met = windows.join(shared, "anchor").select("rank", "start", "stop", "content")
    place = F.struct("rank", "start")
    first = met.groupBy("content").agg(F.min(place).alias("first"))
    later = met.join(first, "content").where(place > F.col("first"))
    return later.groupBy("rank.place").agg(F.collect_set(F.struct("start", "stop")).alias("runs"))


@F.pandas_udf(_FOUND)
def _without(text: pd.Series, runs: pd.Series) -> pd.DataFrame:
    rows = []
    for t, spans in zip(text, runs, strict=True):
        lines = (t or "").split("\n")
        if spans is None or not len(spans):
            rows.append((t, len(lines), 0, True))
            continue
        edge = np.zeros(len(lines) + 1, np.int64)
        for s in spans:
            edge[s["start"]] += 1
            edge[s["stop"] + 1] -= 1
        inside = np.cumsum(edge[:-1]) > 0
        full = [bool(x.strip(" \t\n\x0b\x0c\r")) for x in lines]
        kept = [x for x, gone, f in zip(lines, inside, full, strict=True) if not (gone and f)]
        n = len(lines) - len(kept)
        rows.append(("\n".join(kept), len(lines), n, any(f and not gone for f, gone in zip(full, inside, strict=True))))
    return pd.DataFrame(rows, columns=["text", "n_lines", "n_deleted", "words_left"])


_without = _without.asNondeterministic()  # so that a filter on its result does not run it a second time


def deduplicated(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """``(row, found)``: each document's columns as a struct, and its ``text`` without repeated runs,
    ``n_lines``, ``n_deleted`` and ``words_left``.

    A line with words is deleted if it lies in a run of lines of ``min_words``
    words or more that stands earlier too. ``words_left`` is false where every
    line with words was deleted. NULL, empty and shorter texts have no runs and
    stay as they are. Each row is a document of its own, also if it repeats a
    ``doc_id`` or has none; rows without come last. Other columns are carried;
    no rows give no rows.
    """
    few_texts_a_batch(docs)
    rows = keyed(docs, "rows")
    joined = rows.join(repeated_runs(rows, min_words), "place", "left")
    return joined.select("row", _without(F.col("row.text"), F.col("runs")).alias("found"))


def report(docs: DataFrame) -> DataFrame:
    """``(doc_id, n_lines, n_deleted, text)`` of every document."""
    out = deduplicated(docs.select("doc_id", "text"))
    return out.select("row.doc_id", "found.n_lines", "found.n_deleted", "found.text")


def clean(docs: DataFrame) -> DataFrame:
    """The documents with repeated runs deleted, in their own columns; one that has no words left by that goes."""
    out = deduplicated(docs).where("found.words_left")
    new = {"text": F.col("found.text"), "n_chars": F.length("found.text").cast("long")}
    own = {c: F.col(f"row.`{c}`") for c in docs.columns}
    return out.select(*[(F.when(F.col("found.n_deleted") > 0, new[c]).otherwise(own[c]) if c in new else own[c]).alias(c) for c in docs.columns])
