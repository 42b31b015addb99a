"""Near duplicates by SimHash with an inverted index over byte positions.

A 64-bit fingerprint is eight (position, byte) postings. Two fingerprints that
differ in at most four bits share at least four of the eight postings, so the
index is kept by every choice of four positions: a key is the choice and its
four bytes, and each such pair meets under some key. Where fingerprints meet,
their shared postings are tallied, those under the guaranteed minimum dropped,
and the rest verified bit by bit.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tezgah.llm.common import few_texts_a_batch, keyed, partitions, rank
from tezgah.llm.components import connected_components
from tezgah.sources.shared import stored

POSITIONS = 8
SHINGLE = 4
MAX_BITS = 4
SEED = 42
#: Fingerprints of one key that meet in one place; larger groups are dealt into cells of two such blocks.
BLOCK = 2048
#: Shingles hashed at a time.
CHUNK = 1 << 16


def fingerprint_of(text: bytes | None, shingle: int = SHINGLE) -> int:
    """The fingerprint of one text as a signed 64-bit number; zero without words."""
    words = (text or b"").lower().split()  # of bytes: A-Z only, and the six ASCII blanks
    if not words:
        return 0
    if len(words) < shingle:
        words, shingle = [b" ".join(words)], 1
    n, ones, digest = len(words) - shingle + 1, np.zeros(64, np.int64), xxhash.xxh64_intdigest
    for at in range(0, n, CHUNK):
        part = words[at : at + CHUNK + shingle - 1]
        grams = zip(*(part[k:] for k in range(shingle)), strict=False)
        hashes = np.fromiter((digest(b" ".join(g), SEED) for g in grams), np.dtype("<u8"))
        ones += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > n, bitorder="little").view("<i8")[0])


def fingerprints(text: Column, shingle: int = SHINGLE) -> Column:
    """The fingerprint of a text column as BIGINT."""

    @F.pandas_udf("long")
    def of(texts: pd.Series) -> pd.Series:
        return pd.Series([fingerprint_of(t, shingle) for t in texts], dtype="int64")

    return of(text.cast("binary"))


def _linked(a: np.ndarray, b: np.ndarray, bits: int) -> np.ndarray:
    """Whether fingerprints share enough byte positions, and then are near enough."""
    differing = a ^ b
    shared = (np.ascontiguousarray(differing).view(np.uint8).reshape(*differing.shape, POSITIONS) == 0).sum(axis=-1)
    found = shared >= POSITIONS - bits
    found[found] = np.bitwise_count(differing[found]) <= bits
    return found


def _forest(group: np.ndarray, bits: int) -> list[tuple[int, int]]:
    """Links that connect what is connected within a group, one fewer than its nodes at most."""
    links, rest = [], group
    while len(rest) > 1:
        reached, rest = [rest[0]], rest[1:]
        while reached and len(rest):
            node = reached.pop()
            near = _linked(np.full(len(rest), node), rest, bits)
            links += [(node, x) for x in rest[near]]
            reached += list(rest[near])
            rest = rest[~near]
    return links


def _links(batches: Iterator[pa.RecordBatch], bits: int) -> Iterator[pa.RecordBatch]:
    """Links within runs of equal keys of a partition sorted by key; a run is of bounded length."""

    def found(keys: np.ndarray, fps: np.ndarray) -> pa.RecordBatch:
        starts = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]])
        sizes = np.diff(np.r_[starts, len(keys)])
        two = starts[sizes == 2]
        two = two[_linked(fps[two], fps[two + 1], bits)]
        a, b = [fps[two]], [fps[two + 1]]
        for at, n in zip(starts[sizes > 2], sizes[sizes > 2], strict=True):
            links = np.array(_forest(np.unique(fps[at : at + n]), bits), np.uint64).reshape(-1, 2)
            a.append(links[:, 0])
            b.append(links[:, 1])
        both = [np.concatenate(x).view(np.int64) for x in (a, b)]
        return pa.RecordBatch.from_arrays([pa.array(x) for x in both], ["a", "b"])

    keys, fps = np.empty(0, np.int64), np.empty(0, np.uint64)
    for batch in batches:
        keys = np.r_[keys, batch.column("key").to_numpy()]
        fps = np.r_[fps, batch.column("fp").to_numpy().view(np.uint64)]
        if len(keys):
            cut = int(np.searchsorted(keys, keys[-1]))
            if cut:
                yield found(keys[:cut], fps[:cut])
            keys, fps = keys[cut:], fps[cut:]
    if len(keys):
        yield found(keys, fps)


def near_links(prints: DataFrame, bits: int = MAX_BITS, block: int = BLOCK) -> DataFrame:
    """Links ``(a, b)`` between the distinct fingerprints ``fp`` at most ``bits`` bits apart.

    Not every near pair is listed: within a group of many near fingerprints only
    links that connect them are, so the count grows with the group and not with
    its square. What is connected through near pairs is connected through links.
    """
    chosen = list(combinations(range(POSITIONS), POSITIONS - bits))
    masks = [sum(0xFF << 8 * p for p in at) for at in chosen]
    signed = [m - (1 << 64) if m >> 63 else m for m in masks]
    keys = F.array(*[F.xxhash64(F.lit(k), F.col("fp").bitwiseAND(F.lit(m))) for k, m in enumerate(signed)])
    index = prints.select("fp", F.explode(keys).alias("key"))
    sizes = index.groupBy("key").agg(F.count("*").alias("n")).where("n > 1")
    met = index.join(sizes.hint("shuffle_hash"), "key").withColumn("blocks", F.ceil(F.col("n") / block).cast("int"))
    own = F.when(F.col("blocks") > 1, F.pmod(F.xxhash64("fp"), F.col("blocks"))).otherwise(F.lit(0)).cast("int")
    cells = (
        met.withColumn("own", own)
        .withColumn("other", F.explode(F.expr("sequence(0, blocks - 1)")))
        .select(F.xxhash64("key", F.least("own", "other"), F.greatest("own", "other")).alias("key"), "fp")
    )
    sorted_cells = cells.repartition(partitions(prints.sparkSession), "key").sortWithinPartitions("key", "fp")
    return sorted_cells.mapInArrow(lambda batches: _links(batches, bits), "a long, b long").distinct()


def _rooted(prints: DataFrame, order: Column, bits: int) -> DataFrame:
    """``(fp, least, root)`` of every fingerprint: the least ``order`` of its rows, and the root of its component."""
    nodes = stored(prints.groupBy("fp").agg(F.min(order).alias("least")), "nodes")
    tied = connected_components(near_links(nodes.select("fp"), bits)).withColumnRenamed("node", "fp")
    return nodes.join(tied, "fp", "left").select("fp", "least", F.coalesce("component", "fp").alias("root"))


def near_duplicates(docs: DataFrame, bits: int = MAX_BITS, shingle: int = SHINGLE) -> DataFrame:
    """``(doc_id, fp, component_id)`` for every row of ``docs (doc_id, text)``.

    Documents are linked when their fingerprints differ in at most ``bits``
    bits; the component is the least ``doc_id`` reachable. NULL, empty and blank
    texts have fingerprint zero and are linked to each other and to any
    fingerprint near zero. A text shorter than a shingle is one shingle. Rows
    repeating a ``doc_id`` each give a row. A NULL ``doc_id`` names no
    component; a component of such rows only is NULL. Other columns are ignored;
    no rows give no rows.
    """
    few_texts_a_batch(docs)
    prints = stored(docs.select("doc_id", fingerprints(F.col("text"), shingle).alias("fp")), "fingerprints")
    roots = _rooted(prints, F.col("doc_id"), bits)
    named = roots.groupBy("root").agg(F.min("least").alias("component_id"))
    return prints.join(roots.join(named, "root").select("fp", "component_id"), "fp").select("doc_id", "fp", "component_id")


def first_of_each(docs: DataFrame, bits: int = MAX_BITS, shingle: int = SHINGLE) -> DataFrame:
    """The documents without near duplicates: of each component exactly one row stays, the one of least ``doc_id``.

    Each row is a document of its own, also if it repeats a ``doc_id``; rows
    without one come last.
    """
    few_texts_a_batch(docs)
    rows = keyed(docs, "rows")
    prints = stored(rows.select(rank(F.col("row.doc_id"), F.col("row.text"), F.col("place")).alias("rank"), fingerprints(F.col("row.text"), shingle).alias("fp")), "fingerprints")
    stay = _rooted(prints, F.col("rank"), bits).groupBy("root").agg(F.min("least").alias("least")).select("least.place")
    return rows.join(stay, "place", "left_semi").select(*[F.col(f"row.`{c}`") for c in docs.columns])
