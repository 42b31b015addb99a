"""Least-cost repair of the turns of conversations with block tables (Four Russians).

A good conversation's roles are ``(system? (user assistant)+)?``. Rows are kept,
given another role or deleted, and empty rows inserted, at least cost. The cost of
finishing from each of the four states of that pattern is a vector; with its least
entry taken out, only a few different vectors can occur. So the step over every
block of ``LENGTH`` symbols from every such vector is worked out once, and a
conversation is read from its end block by block by lookup. Its edits are traced
from the front: a block's inner vectors are worked out backward from the one behind
it, and of equally cheap edits the one whose letter sorts first is taken, which
gives the least of all cheapest audits.

Rows are sorted by ranges and cut into segments of ``SEGMENT`` rows at most, so a
conversation of any length is many tasks' work: a segment gives, for every vector
behind it, the vector and the cost in front of it and the state each state leads to;
those are chained per conversation, and all segments are then traced at once.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tezgah.llm.common import few_texts_a_batch
from tezgah.sources.shared import stored

KEEP, REROLE, DELETE, INSERT, CUT_OFF = 0, 2, 3, 2, 1
LENGTH = 4
#: Rows of a segment; the least power of two that keeps the chained maps of a conversation, whose audit is one value, under 100 MB.
SEGMENT = 4096

#: Symbols: role system, user, assistant or another, whole or cut off; and a row that has to go.
ROLES, GONE, SYMBOLS = "sua", 8, 9
START, SYSTEM, USER, ASSISTANT = range(4)
NAMES = {USER: "user", ASSISTANT: "assistant"}
#: Where an inserted row leads, and where a kept one does (by state, then role); the pattern may end in START and ASSISTANT.
_NEXT = {START: USER, SYSTEM: USER, USER: ASSISTANT, ASSISTANT: USER}
_KEPT = {(START, 0): SYSTEM, (START, 1): USER, (SYSTEM, 1): USER, (USER, 2): ASSISTANT, (ASSISTANT, 1): USER}
_FAR = 1 << 30


def _inserted(costs: list[int]) -> tuple[int, ...]:
    """Costs of finishing when rows may be inserted first."""
    costs = list(costs)
    for _ in range(4):
        for q, to in _NEXT.items():
            costs[q] = min(costs[q], costs[to] + INSERT)
    return tuple(costs)


END = _inserted([0, _FAR, _FAR, 0])


def _before(symbol: int, after: tuple[int, ...]) -> tuple[int, ...]:
    """Costs of finishing from in front of a row, given those from behind it."""
    out = []
    for q in range(4):
        ways = [after[q] + DELETE]
        if symbol != GONE:
            role, cut_off = divmod(symbol, 2)
            extra = CUT_OFF * cut_off
            if (q, role) in _KEPT:
                ways.append(after[_KEPT[q, role]] + KEEP + extra)
            ways.append(after[_NEXT[q]] + REROLE + extra)
        out.append(min(ways))
    return _inserted(out)


class Tables:
    """Normalised vectors, numbered from that at the end, and the steps between them."""

    def __init__(self) -> None:
        self.vectors, self.number = [END], {END: 0}
        steps: list[list[tuple[int, int]]] = []
        for vector in self.vectors:  # grows as new vectors are met
            row = []
            for symbol in range(SYMBOLS):
                costs = _before(symbol, vector)
                least = min(costs)
                shape = tuple(c - least for c in costs)
                if shape not in self.number:
                    self.number[shape] = len(self.vectors)
                    self.vectors.append(shape)
                row.append((self.number[shape], least))
            steps.append(row)
        #: ``[symbol, vector behind]``: vector in front, and cost.
        self.step, self.cost = (np.array([[steps[v][s][k] for v in range(len(steps))] for s in range(SYMBOLS)], np.int64) for k in (0, 1))
        block, price = self.step, self.cost
        for _ in range(LENGTH - 1):  # a block's first symbol is its highest digit
            price = np.concatenate([price + self.cost[s][block] for s in range(SYMBOLS)])
            block = np.concatenate([self.step[s][block] for s in range(SYMBOLS)])
        self.block, self.price = block, price
        self._inner: dict[tuple[int, int], list[int]] = {}
        self._edit: dict[tuple[int, int, int], tuple[str, int]] = {}

    def blocks(self, symbols: list[int]) -> tuple[list[int], list[int]]:
        """The symbols before the first whole block, and the numbers of the blocks after them."""
        lone = len(symbols) % LENGTH
        whole = np.array(symbols[lone:], np.int64).reshape(-1, LENGTH)
        return symbols[:lone], (whole @ SYMBOLS ** np.arange(LENGTH - 1, -1, -1)).tolist()

    def read(self, symbols: list[int], behind: int) -> tuple[list[int], int]:
        """Vectors behind each lone symbol and behind each block, and in front of all; the cost taken out."""
        lone, blocks = self.blocks(symbols)
        trail, cost = [behind], 0
        for b in reversed(blocks):
            cost += int(self.price[b, behind])
            behind = int(self.block[b, behind])
            trail.append(behind)
        for s in reversed(lone):
            cost += int(self.cost[s, behind])
            behind = int(self.step[s, behind])
            trail.append(behind)
        return trail[::-1], cost

    def inner(self, block: int, behind: int) -> list[int]:
        """Vectors behind each symbol of a block, worked out backward."""
        if (block, behind) not in self._inner:
            out = [behind]
            for k in range(LENGTH - 1):
                out.append(int(self.step[block // SYMBOLS**k % SYMBOLS, out[-1]]))
            self._inner[block, behind] = out[::-1]
        return self._inner[block, behind]

    def edit(self, symbol: int, behind: int, state: int) -> tuple[str, int]:
        """The cheapest edits up to and with a row, least in letters, and the state after it."""
        key = symbol, behind, state
        if key not in self._edit:
            after = self.vectors[behind]
            costs = _before(symbol, after)
            role, cut_off = (4, 0) if symbol == GONE else divmod(symbol, 2)
            if costs[state] == after[state] + DELETE:
                self._edit[key] = "D", state
            elif costs[state] == costs[_NEXT[state]] + INSERT:
                letters, end = self.edit(symbol, behind, _NEXT[state])
                self._edit[key] = "I" + letters, end
            elif (state, role) in _KEPT and costs[state] == after[_KEPT[state, role]] + KEEP + CUT_OFF * cut_off:
                self._edit[key] = "K", _KEPT[state, role]
            else:
                self._edit[key] = "R", _NEXT[state]
        return self._edit[key]

    def trace(self, symbols: list[int], behind: int, state: int) -> tuple[list[str], int]:
        """Edits of every row from ``state`` on, and the state after the last."""
        trail, _ = self.read(symbols, behind)
        lone, blocks = self.blocks(symbols)
        vectors = trail[1 : len(lone) + 1]
        for b, v in zip(blocks, trail[len(lone) + 1 :], strict=True):
            vectors += self.inner(b, v)
        edits = []
        for s, v in zip(symbols, vectors, strict=True):
            letters, state = self.edit(s, v, state)
            edits.append(letters)
        return edits, state

    def maps(self, symbols: list[int]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """For every vector behind the symbols: the vector and the cost in front, and the state each state leads to."""
        n = len(self.vectors)
        at, cost = np.arange(n), np.zeros(n, np.int64)
        lone, blocks = self.blocks(symbols)
        vectors = [at]
        for table, price, codes in ((self.block, self.price, blocks), (self.step, self.cost, lone)):
            for c in reversed(codes):
                cost = cost + price[c][at]
                at = table[c][at]
                vectors.append(at)
        behind = vectors[-2::-1]  # of each lone symbol, then of each block
        state = np.repeat(np.arange(4)[None], n, 0)
        for k, c in enumerate([*lone, *blocks]):
            ends = self._ends(c, k >= len(lone))
            state = ends[behind[k][:, None], state]
        return at, cost, state

    @cache  # noqa: B019 - the tables live as long as the worker
    def _ends(self, code: int, block: bool) -> np.ndarray:
        """``[vector behind, state]``: the state after a block or symbol."""
        out = np.empty((len(self.vectors), 4), np.int64)
        for v in range(len(self.vectors)):
            inner = self.inner(code, v) if block else [v]
            for q in range(4):
                state = q
                for k, w in enumerate(inner):
                    symbol = code // SYMBOLS ** (LENGTH - 1 - k) % SYMBOLS if block else code
                    state = self.edit(symbol, w, state)[1]
                out[v, q] = state
        return out

    def closing(self, state: int) -> list[int]:
        """States of the rows inserted behind the last."""
        out = []
        while state not in (START, ASSISTANT):
            state = _NEXT[state]
            out.append(state)
        return out


@cache
def tables() -> Tables:
    return Tables()


#: What counts as blank, and as the end of a sentence.
_BLANK, _STOPS = " \t\n\x0b\x0c\r", ".!?"
_CODES = "ABCDEFGHIJKLMNOP"  # four roles times whole, cut off, blank, repeated
_KEYS = ["none", "conv"]


def damaged(conversations: DataFrame) -> DataFrame:
    """The rows with the faults that the crc32 of ``conv_id:turn`` calls for; NULLs count as one space there, and as role and text."""

    def name(c: str) -> Column:
        return F.coalesce(F.col(c).cast("string"), F.lit(" "))

    kind = F.crc32(F.concat(name("conv_id"), F.lit(":"), name("turn")).cast("binary")) % 20
    rows = conversations.select("conv_id", "turn", name("role").alias("role"), name("text").alias("text"), kind.alias("kind")).where("kind <> 0")
    text = F.when(F.col("kind") == 1, "").when(F.col("kind") == 2, F.translate("text", _STOPS, "")).otherwise(F.col("text"))
    copies = F.sequence(F.lit(1), F.when(F.col("kind") == 3, 2).otherwise(1))
    return rows.select("conv_id", "turn", F.when(F.col("kind") == 4, "user").otherwise(F.col("role")).alias("role"), text.alias("text"), F.explode(copies).alias("copy")).drop("copy")


def _sorted(rows: DataFrame) -> DataFrame:
    """Rows in order with their ``place`` and ``chunk``, stored. A conversation is spread over ranges like any other rows."""
    frame = rows.select(
        F.col("conv_id").isNull().alias("none"), F.coalesce(F.col("conv_id").cast("long"), F.lit(0)).alias("conv"), F.col("turn").cast("long").alias("turn"),
        F.coalesce("role", F.lit(" ")).alias("role"), F.coalesce("text", F.lit(" ")).alias("text"),
    )
    ties = {"opens": F.substring("role", 1, 16), "starts": F.substring("text", 1, 32), "digest": F.xxhash64("role", "text"), "copy": F.monotonically_increasing_id()}
    order = [*_KEYS, "turn", *ties]
    placed = frame.withColumns(ties).repartitionByRange(*order).sortWithinPartitions(*order).drop(*ties)
    return stored(placed.withColumn("place", F.monotonically_increasing_id()).withColumn("chunk", F.expr(f"place div {SEGMENT}")), "turns")


def _faults(rows: DataFrame) -> DataFrame:
    """``(none, conv, chunk, place, code)``: each row's role and first fault as a letter."""
    bare = F.rtrim(F.col("text"), F.lit(_BLANK))
    initial, role = F.substring("role", 1, 1), F.lit(len(ROLES))
    for k, letter in enumerate(ROLES):
        role = F.when(initial == letter, k).otherwise(role)
    seen = F.sha2(F.concat(F.length("role").cast("string"), F.lit(":"), "role", "text"), 256)
    read = rows.select(*_KEYS, "chunk", "place", role.alias("role"), (bare == "").alias("blank"), (~F.right(bare, F.lit(1)).isin(*_STOPS)).alias("cut_off"), seen.alias("seen"))
    first = read.groupBy(*_KEYS, "seen").agg(F.min("place").alias("place")).select("place", F.lit(True).alias("first"))
    fault = F.when(F.col("blank"), 2).when(F.col("first").isNull(), 3).when(F.col("cut_off"), 1).otherwise(0)
    code = F.substring(F.lit(_CODES), F.col("role") * 4 + fault + 1, F.lit(1))
    return read.join(first, "place", "left").select(*_KEYS, "chunk", "place", code.alias("code"))


def _segments(rows: DataFrame) -> DataFrame:
    """``(none, conv, chunk, first, codes, pieces)``: a segment's rows as a string of codes, and the segments of its conversation."""
    marked = _faults(rows).groupBy(*_KEYS, "chunk").agg(F.array_sort(F.collect_list(F.struct("place", "code"))).alias("rows"))
    whole = marked.select(*_KEYS, "chunk", F.col("rows")[0]["place"].alias("first"), F.array_join(F.transform("rows", lambda r: r["code"]), "").alias("codes"))
    return stored(whole.withColumn("pieces", F.count("*").over(Window.partitionBy(*_KEYS))), "segments")


def _symbols(codes: str) -> list[int]:
    of = [_CODES.index(c) for c in codes]
    return [GONE if k % 4 > 1 else k // 4 * 2 + k % 4 for k in of]


def _chained(segments: DataFrame) -> DataFrame:
    """``(none, conv, chunk, behind, state, last, previous)`` of the segments of conversations that are cut.

    A conversation's maps, a few hundred bytes for ``SEGMENT`` rows, are chained from its
    end to its start for the vectors, and back for the states.
    """

    def reduce(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            maps = [tables().maps(_symbols(c)) for c in batch.column("codes").to_pylist()]
            packed = [np.concatenate([at, state.ravel()]).astype(np.int16).tobytes() for at, _, state in maps]
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in (*_KEYS, "chunk", "ends")], pa.array(packed, pa.binary())], [*_KEYS, "chunk", "ends", "map"])

    def chain(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values("chunk", ignore_index=True)
        n = len(tables().vectors)
        maps = [np.frombuffer(m, np.int16) for m in group.pop("map")]
        behind = [0]
        for m in maps[:0:-1]:
            behind.append(int(m[behind[-1]]))
        behind = behind[::-1]
        states = [START]
        for m, v in zip(maps[:-1], behind, strict=False):
            states.append(int(m[n:].reshape(n, 4)[v, states[-1]]))
        last = [False] * (len(group) - 1) + [True]
        return group.assign(behind=behind, state=states, last=last, previous=[None, *group["ends"][:-1]])[[*_KEYS, "chunk", "behind", "state", "last", "previous"]]

    cut = segments.where("pieces > 1").select(*_KEYS, "chunk", "codes", F.right("codes", F.lit(1)).alias("ends"))
    mapped = cut.mapInArrow(reduce, "none boolean, conv long, chunk long, ends string, map binary")
    return mapped.groupBy(*_KEYS).applyInPandas(chain, "none boolean, conv long, chunk long, behind int, state int, last boolean, previous string")


def _traced(segments: DataFrame) -> DataFrame:
    """Segments with their audit, cost, faults and, per row, the roles of the rows inserted before it, its own and of those after it; stored."""
    joined = segments.join(_chained(segments), [*_KEYS, "chunk"], "left").select(
        *_KEYS, "chunk", "first", "codes", F.coalesce("behind", F.lit(0)).alias("behind"), F.coalesce("state", F.lit(START)).alias("state"), F.coalesce("last", F.lit(True)).alias("last"), "previous"
    )
    good = {"su", "ua", "au"}
    role_of = {c: "sua?"[k // 4] for k, c in enumerate(_CODES)}

    def trace(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        t = tables()
        for batch in batches:
            out = []
            for none, conv, chunk, first, codes, behind, state, last, previous in zip(*[batch.column(c).to_pylist() for c in batch.schema.names], strict=True):
                symbols = _symbols(codes)
                edits, end = t.trace(symbols, behind, state)
                rows, cost = [], 0
                for letters, symbol in zip(edits, symbols, strict=True):
                    before = []
                    for _ in letters[:-1]:
                        state = _NEXT[state]
                        before.append(NAMES[state])
                    role = None
                    if letters[-1] == "R":
                        state = _NEXT[state]
                        role = NAMES[state]
                    elif letters[-1] == "K":
                        state, role = _KEPT[state, symbol // 2], ""
                    rows.append({"before": before, "role": role, "after": []})
                    cost += INSERT * len(before) + {"K": KEEP, "R": REROLE, "D": DELETE}[letters[-1]] + (CUT_OFF * (symbol % 2) if letters[-1] != "D" else 0)
                closing = [NAMES[q] for q in t.closing(end)] if last else []
                rows[-1]["after"] = closing
                said = [role_of[c] for c in (previous or "") + codes]
                faults = [codes.count(_CODES[k]) + codes.count(_CODES[k + 4]) + codes.count(_CODES[k + 8]) + codes.count(_CODES[k + 12]) for k in (2, 3, 1)]
                illegal = sum(a + b not in good for a, b in zip(said, said[1:], strict=False))
                out.append((none, conv, chunk, first, "".join(edits) + "I" * len(closing), cost + INSERT * len(closing), *faults, illegal, rows))
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out, strict=True), kinds, strict=True)], names) if out else pa.RecordBatch.from_arrays([pa.array([], k) for k in kinds], names)

    names = [*_KEYS, "chunk", "first", "audit", "cost", "blank", "duplicate", "truncated", "illegal", "rows"]
    edit = pa.struct([("before", pa.list_(pa.string())), ("role", pa.string()), ("after", pa.list_(pa.string()))])
    kinds = [pa.bool_(), pa.int64(), pa.int64(), pa.int64(), pa.string(), *[pa.int64()] * 5, pa.list_(edit)]
    kind = "none boolean, conv long, chunk long, first long, audit string, cost long, blank long, duplicate long, truncated long, illegal long, rows array<struct<before:array<string>,role:string,after:array<string>>>"
    return stored(joined.mapInArrow(trace, kind), "traced")


def _said(rows: DataFrame, traced: DataFrame) -> DataFrame:
    """``(none, conv, place, said)``: what stands in a row's place after repair, as ``(role, text)``."""

    def empty(roles: Column) -> Column:
        return F.transform(roles, lambda r: F.struct(r.alias("role"), F.lit("").alias("text")))

    edits = traced.select("first", F.posexplode("rows").alias("nth", "edit")).select((F.col("first") + F.col("nth")).alias("place"), "edit")
    own = F.struct(F.when(F.col("edit.role") == "", F.col("role")).otherwise(F.col("edit.role")).alias("role"), F.col("text").alias("text"))
    kept = F.when(F.col("edit.role").isNull(), F.array().cast("array<struct<role:string,text:string>>")).otherwise(F.array(own))
    said = F.concat(empty(F.col("edit.before")), kept, empty(F.col("edit.after")))
    return rows.join(edits.hint("merge"), "place").select(*_KEYS, "place", said.alias("said")).where(F.size("said") > 0)


def _digests(said: DataFrame) -> DataFrame:
    """``(none, conv, sha)`` of the repaired rows, read in order; a worker holds a batch of rows at a time, however long the conversation."""
    few_texts_a_batch(said)
    lines = F.array_join(F.transform("said", lambda m: F.concat(m["role"], F.lit(":"), m["text"])), "\n")
    ordered = said.select(*_KEYS, "place", lines.alias("lines")).repartition(*_KEYS).sortWithinPartitions(*_KEYS, "place")

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, sha = None, None
        for batch in batches:
            done = []
            for none, conv, raw in zip(*[batch.column(c).to_pylist() for c in (*_KEYS, "lines")], strict=True):
                if (none, conv) == key:
                    sha.update(b"\n")
                else:
                    if sha:
                        done.append((*key, sha.hexdigest()))
                    key, sha = (none, conv), hashlib.sha256()
                sha.update(raw)
            if done:
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*done, strict=True)], [*_KEYS, "sha"])
        if sha:
            yield pa.RecordBatch.from_arrays([pa.array([c]) for c in (*key, sha.hexdigest())], [*_KEYS, "sha"])

    return ordered.select(*_KEYS, F.col("lines").cast("binary").alias("lines")).mapInArrow(digest, "none boolean, conv long, sha string")


def _conv(df: DataFrame) -> DataFrame:
    return df.withColumn("conv_id", F.when(~F.col("none"), F.col("conv")))


def repaired(rows: DataFrame) -> DataFrame:
    """``(conv_id, place, nth, role, text)``: the rows after repair, in order of ``place`` and ``nth``.

    Takes ``conv_id, turn, role, text``; other columns are left behind. Rows are read
    by ``turn`` (NULL first), ties by role, the start of the text and a digest of both.
    NULL roles and texts count as one space; a NULL ``conv_id`` is a conversation. No
    rows give no rows.
    """
    turns = _sorted(rows)
    said = _said(turns, _traced(_segments(turns)))
    return _conv(said.select(*_KEYS, "place", F.posexplode("said").alias("nth", "row"))).select("conv_id", "place", "nth", "row.role", "row.text")


def report(rows: DataFrame, conversations: DataFrame) -> DataFrame:
    """One row for each ``conv_id`` of ``conversations``: faults of its ``rows``, cost and audit of their repair, and a digest of its result.

    Conversations without rows have zeros, an empty audit and the digest of an empty
    string. A conversation's digest is read by one worker in order, a batch at a
    time, as SHA-256 can't be split; all else is spread over segments.
    """
    turns = _sorted(rows)
    traced = _traced(_segments(turns))
    gaps = turns.groupBy(*_KEYS).agg((F.max("turn") - F.min("turn") + 1 - F.count_distinct("turn")).alias("gaps"))
    sums = traced.groupBy(*_KEYS).agg(
        *[F.sum(c).alias(c) for c in ("blank", "duplicate", "truncated", "illegal", "cost")],
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("chunk", "audit"))), lambda s: s["audit"]), "").alias("audit"),
    )
    every = conversations.select(F.col("conv_id").isNull().alias("none"), F.coalesce(F.col("conv_id").cast("long"), F.lit(0)).alias("conv")).distinct()
    out = every.join(gaps, _KEYS, "left").join(sums, _KEYS, "left").join(_digests(_said(turns, traced)), _KEYS, "left")
    counts = [F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    return _conv(out).select("conv_id", *counts, F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("sha", F.lit(hashlib.sha256().hexdigest())).alias("repaired_sha256"))
