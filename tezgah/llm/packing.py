"""Packing of documents into as few sequences as possible by bin completion.

Documents are packed by their lengths alone, and there are no more different
lengths than a sequence has tokens. So the plan is made from the count of
pieces of each length, which is small at any size of the corpus: a plan is a
list of fillings, each with how often it is used. Spark counts lengths, numbers
the pieces of a length, and gives each piece its place from the plan.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tezgah.llm.common import few_texts_a_batch
from tezgah.llm.tokens import SPACED, encoder
from tezgah.sources.shared import stored

CAPACITY = 2048
END = 0
#: Fillings looked at for one largest piece, and nodes of the search after the first plan. They bound the search for a better plan only: every piece is packed.
WIDTH = 48
NODES = 1_000

Filling = tuple[tuple[int, int], ...]


def _fits_into(items: tuple[int, ...], room: tuple[int, ...]) -> bool:
    """Whether the items can be dealt into the rooms."""
    if not items:
        return True
    for k in range(len(room)):
        if room[k] >= items[0] and (k == 0 or room[k] != room[k - 1]):
            rest = tuple(sorted((*room[:k], room[k] - items[0], *room[k + 1 :]), reverse=True))
            if _fits_into(items[1:], rest):
                return True
    return False


def completions(sizes: list[int], left: np.ndarray, room: int, waste: int, width: int = WIDTH) -> list[Filling]:
    """Undominated fillings of ``room`` that waste no more than ``waste``, best fit first.

    ``sizes`` are the lengths left, falling, and ``left[s]`` how many. A length is
    taken with its multiplicity in one step, most first, so a filling of thousands
    of equal short pieces is one step. A filling is dominated if another piece fits
    in what it leaves, or if its pieces could be dealt into another's. No more than
    ``width`` full ones are kept.
    """
    falling = [-s for s in sizes]
    many = [int(left[s]) for s in sizes]
    behind = [*np.cumsum([s * n for s, n in zip(sizes[::-1], many[::-1], strict=True)])[::-1].tolist(), 0]
    found: list[Filling] = []
    full = tried = 0
    stack: list[tuple[int, int, Filling, int | None]] = [(0, room, (), None)]
    while stack and tried <= 80 * width and full < width:
        k, rest, taken, times = stack.pop()
        if times is None:  # the next length that fits, as often as it does
            tried += 1
            k = max(k, bisect_left(falling, -rest))
            if k == len(sizes):
                held = dict(taken)
                if rest <= waste and not any(s <= rest and n > held.get(s, 0) for s, n in zip(sizes[bisect_left(falling, -rest) :], many[bisect_left(falling, -rest) :], strict=True)):
                    found.append(taken)
                    full += rest == 0
                continue
            times = min(many[k], rest // sizes[k])
        if rest - behind[k] > waste:  # all that is left behind doesn't fill it
            continue
        if times:
            stack.append((k, rest, taken, times - 1))
            stack.append((k + 1, rest - times * sizes[k], (*taken, (sizes[k], times)), None))
        else:
            stack.append((k + 1, rest, taken, None))
    used = {f: sum(s * n for s, n in f) for f in set(found)}
    count = {f: sum(n for _, n in f) for f in used}
    ranked = sorted(used, key=lambda f: (-used[f], count[f], tuple((-s, -n) for s, n in f)))[:width]
    kept: list[Filling] = []
    short: list[tuple[int, ...]] = []
    for f in ranked:
        if count[f] <= 6:
            pieces = tuple(s for s, n in f for _ in range(n))
            if any(_fits_into(pieces, g) for g in short):
                continue
            short.append(pieces)
        kept.append(f)
    return kept


def plan(counts: dict[int, int], capacity: int = CAPACITY, nodes: int = NODES, width: int = WIDTH) -> list[tuple[Filling, int]]:
    """Fillings ``((length, times), ...)`` and how often each is used; together they hold every piece once.

    The search takes the longest piece left, tries its undominated completions
    from the best fit on, and uses one as often as the counts allow. The first
    way down is best fit and becomes the incumbent; a branch ends when the
    sequences so far and those that the rest needs at least are no fewer than
    the incumbent's. It ends at a proven least number or ``nodes`` nodes after the first plan.
    """
    left = np.zeros(capacity + 1, np.int64)
    for s, n in counts.items():
        left[s] = n
    total = int((left * np.arange(capacity + 1)).sum())
    least = max(-(-total // capacity), int(left[capacity // 2 + 1 :].sum()))
    best, best_bins = None, None
    chosen: list[tuple[Filling, int]] = []
    used, rest, seen = 0, total, 0
    stack: list[list[Filling]] = []

    def undo() -> None:
        nonlocal used, rest
        filling, m = chosen.pop()
        for s, times in filling:
            left[s] += times * m
            rest += s * times * m
        used -= m

    def options() -> list[Filling]:
        sizes = [int(s) for s in np.flatnonzero(left)[::-1]]
        first = sizes[0]
        left[first] -= 1
        if not left[first]:
            sizes = sizes[1:]
        waste = capacity if best_bins is None else (best_bins - 1) * capacity - used * capacity - rest
        fillings = completions(sizes, left, capacity - first, min(waste, capacity - first), width)
        left[first] += 1
        return [((first, 1 + f[0][1]), *f[1:]) if f and f[0][0] == first else ((first, 1), *f) for f in fillings][::-1]

    while True:
        if rest == 0 and (best_bins is None or used < best_bins):
            best, best_bins = list(chosen), used
        if best_bins is not None and (best_bins <= least or seen >= nodes):
            return best
        if rest and (best_bins is None or used + -(-rest // capacity) < best_bins):
            seen += best_bins is not None
            stack.append(options())
        elif chosen:
            undo()
        while stack and not stack[-1]:
            stack.pop()
            if chosen:
                undo()
        if not stack:
            return best or []
        filling = stack[-1].pop()
        m = int(min(left[s] // times for s, times in filling))
        for s, times in filling:
            left[s] -= times * m
            rest -= s * times * m
        used += m
        chosen.append((filling, m))


def pieces_of(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY) -> DataFrame:
    """``(doc_id, piece, start, length, ids_crc32)`` of every document's token ids and the end id."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(tokenizer, SPACED).encode
        for batch in batches:
            rows = []
            for key, raw in zip(batch.column("doc_id").to_pylist(), encode(batch.column("text").to_pylist()), strict=True):
                raw += END.to_bytes(4, "little")
                n = len(raw) // 4
                first = n % capacity or min(n, capacity)
                bounds = [0, *range(first, n + 1, capacity)]
                rows += [(key, k, a, b - a, zlib.crc32(raw[4 * a : 4 * b])) for k, (a, b) in enumerate(zip(bounds, bounds[1:], strict=False))]
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*rows, strict=True), kinds, strict=True)], names)

    names = ["doc_id", "piece", "start", "length", "ids_crc32"]
    kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()]
    return docs.select("doc_id", "text").mapInArrow(cut, "doc_id long, piece int, start long, length long, ids_crc32 long")


def _places(made: list[tuple[Filling, int]]) -> dict[str, np.ndarray]:
    """For each length and run of piece numbers: the filling's first sequence, its pieces of that length, and their place in it."""
    rows, taken, sequence = [], {}, 0
    for filling, m in made:
        at = 0
        for s, times in filling:
            rows.append((s << 48 | taken.get(s, 0), sequence, times, at, taken.get(s, 0)))
            taken[s] = taken.get(s, 0) + m * times
            at += s * times
        sequence += m
    rows.sort()
    names = ["key", "sequence", "times", "at", "first"]
    return {n: np.array(c, np.int64) for n, c in zip(names, zip(*rows, strict=True), strict=True)} if rows else {n: np.empty(0, np.int64) for n in names}


def packed(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY) -> DataFrame:
    """``(doc_id, piece, start, length, ids_crc32, sequence_id, offset)``, one row per piece.

    A document is its token ids and the end id; one longer than ``capacity`` is
    cut into pieces of that length, the first of which may be shorter. NULL and
    empty texts are the end id alone. Rows that repeat a document are packed
    each; rows without ``doc_id`` are packed too. Ties of length are numbered by
    document and piece. Other columns are ignored; no rows give no rows.
    """
    few_texts_a_batch(docs)
    block = F.spark_partition_id().alias("block")
    pieces = stored(pieces_of(docs, tokenizer, capacity).select("*", block), "pieces")
    counts = stored(pieces.groupBy("length", "block").agg(F.count("*").alias("n")), "lengths")
    per_length = {int(r["length"]): int(r.n) for r in counts.groupBy("length").agg(F.sum("n").alias("n")).collect()}  # no more rows than capacity
    whole = per_length.pop(capacity, 0)
    made = plan(per_length, capacity) + ([(((capacity, 1),), whole)] if whole else [])
    places = _places(made)

    @F.pandas_udf("sequence_id long, offset long")
    def place(length: pd.Series, rank: pd.Series) -> pd.DataFrame:
        length, rank = length.to_numpy(), rank.to_numpy()
        k = np.searchsorted(places["key"], length << 48 | rank, "right") - 1
        nth = rank - places["first"][k]
        times = places["times"][k]
        return pd.DataFrame({"sequence_id": places["sequence"][k] + nth // times, "offset": places["at"][k] + nth % times * length})

    before = Window.partitionBy("length").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("length", "block", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))
    order = Window.partitionBy("length", "block").orderBy("doc_id", "piece", "ids_crc32")
    ranked = pieces.withColumn("nth", F.row_number().over(order)).join(offsets, ["length", "block"])
    placed = ranked.withColumn("at", place("length", F.col("before") + F.col("nth") - 1))
    return placed.select("doc_id", "piece", "start", "length", "ids_crc32", "at.sequence_id", "at.offset")
