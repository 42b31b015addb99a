"""Shards along a Hilbert curve, so that filters on several columns open few files.

Each dimension is quantised by equal shares of all rows: its cell is the number of
quantiles below the value. A row's cells give its index on the curve, rows are
sorted by that index, and the order is cut into runs, one per shard. Neighbours on
the curve agree in all dimensions, so a shard's least and greatest values are close
together in each of them. All of it is DataFrame functions.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tezgah.functions.literals import literal_rows
from tezgah.llm.common import as_row, let
from tezgah.sources.shared import stored

SHARDS = 24
#: A dimension has 2**BITS cells, so it needs 2**BITS - 1 quantiles, whatever the number of rows.
BITS = 5
#: Dimensions of the query: columns of the documents, and the size that is worked out here.
DIMENSIONS = ("lang", "source", "size")
LAWS = ("rows", "bytes")

_LOCAL = 33  # monotonically_increasing_id: partition above, row number below


def hilbert(cells: Sequence[Column], bits: int = BITS) -> Column:
    """Index (BIGINT) of a cell on the Hilbert curve through the cube of ``2**bits`` cells an edge.

    From the highest bit down, the curve turns each sub-cube by an entry corner and
    a direction; both follow from the Gray code of the corner visited before.
    """
    n = len(cells)
    top = (1 << n) - 1

    def table(of) -> Column:
        return F.array(*[F.lit(of(w)) for w in range(1 << n)])

    def gray(w: int) -> int:
        return w ^ (w >> 1)

    def ones(w: int) -> int:
        return (w ^ (w + 1)).bit_length() - 1  # trailing one bits

    number = [gray(w) for w in range(1 << n)]
    rank = table(number.index)
    entry = table(lambda w: gray(2 * ((w - 1) // 2)) if w else 0)
    turn = table(lambda w: (0 if not w else ones(w - 1) if w % 2 == 0 else ones(w)) % n)

    def at(values: Column, k: Column) -> Column:
        return F.get(values, k.cast("int"))

    def shifted(value: Column, by: Column, left: bool) -> Column:
        """``value`` turned round within n bits."""
        ways = [F.lit(0)] * n
        for k in range(n):
            a, b = (F.shiftleft(value, k), F.shiftright(value, n - k)) if left else (F.shiftright(value, k), F.shiftleft(value, n - k))
            ways[k] = a.bitwiseOR(b).bitwiseAND(F.lit(top))
        return F.get(F.array(*ways), by.cast("int"))

    def level(state: Column, bit: Column) -> Column:
        corner = F.lit(0)
        for k, cell in enumerate(cells):
            corner = corner.bitwiseOR(F.shiftleft(F.getbit(cell.cast("long"), bit.cast("int")).cast("int"), k))

        def step(turned: Column) -> Column:
            w = at(rank, turned)
            return let(w, lambda w: F.struct(
                F.shiftleft(state["index"], n).bitwiseOR(w.cast("long")).alias("index"),
                state["entry"].bitwiseXOR(shifted(at(entry, w), (state["turn"] + 1) % n, True)).alias("entry"),
                ((state["turn"] + at(turn, w) + 1) % n).alias("turn"),
            ))

        return let(shifted(corner.bitwiseXOR(state["entry"]), (state["turn"] + 1) % n, False), step)

    start = F.struct(F.lit(0).cast("long").alias("index"), F.lit(0).alias("entry"), F.lit(0).alias("turn"))
    return F.aggregate(F.sequence(F.lit(bits - 1), F.lit(0)), start, level, lambda s: s["index"])


def _ordered(df: DataFrame, order: Sequence[str], name: str) -> DataFrame:
    """The frame dealt by ranges of ``order`` and sorted, stored, with ``part`` and ``slot`` (its number there)."""
    placed = df.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("at", F.monotonically_increasing_id())
    number = F.col("at").bitwiseAND(F.lit((1 << _LOCAL) - 1))
    return stored(placed.select("*", F.shiftright("at", _LOCAL).alias("part"), number.alias("slot")).drop("at"), name)


def _before(placed: DataFrame, amount: str) -> tuple[DataFrame, int, int]:
    """``(part, rows, amounts)`` of all parts before a part; rows and amounts in all. One row per part passes the driver."""
    sums = placed.groupBy("part").agg(F.count("*").alias("n"), F.sum(amount).alias("a")).orderBy("part").collect()
    rows, n, a = [], 0, 0
    for s in sums:
        rows.append((s.part, n, a))
        n, a = n + s.n, a + s.a
    return literal_rows(placed.sparkSession, rows or [(0, 0, 0)], "part bigint, rows_before bigint, amount_before bigint"), n, a


def quantiles(base: DataFrame, column: str, cells: int) -> list:
    """The values at the shares 1/cells, 2/cells ... of the rows in which ``column`` isn't NULL: ``cells - 1`` at most.

    Rows are counted per value first, so a value of a third of all rows is one row here.
    """
    values = base.where(F.col(column).isNotNull()).groupBy(F.col(column).alias("value")).agg(F.count("*").alias("n"))
    placed = _ordered(values, ["value"], "values")
    before, _, total = _before(placed, "n")
    within = Window.partitionBy("part").orderBy("slot").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    upto = F.sum("n").over(within) + F.col("amount_before")
    reached = placed.join(F.broadcast(before), "part").select("value", "n", upto.alias("upto"))
    first, last = F.col("upto") - F.col("n"), F.col("upto")
    # the k-th quantile is the value whose rows hold the row numbered k * total / cells
    k_from = F.expr(f"({cells} * upto - {cells} * n + {total} - 1) div {max(total, 1)}")
    k_to = F.expr(f"({cells} * upto - 1) div {max(total, 1)}")
    held = reached.where(last > first).select("value", F.greatest(k_from, F.lit(1)).alias("a"), F.least(k_to, F.lit(cells - 1)).alias("b"))
    return [r.value for r in held.where("a <= b").select("value", F.explode(F.sequence("a", "b")).alias("k")).orderBy("k").collect()]


def _cell(value: Column, cuts: list) -> Column:
    """The number of quantiles below the value; NULL is in cell 0."""
    below = [F.when(value > F.lit(c), 1).otherwise(0) for c in cuts]
    return F.coalesce(sum(below[1:], below[0]) if below else F.lit(0), F.lit(0))


def measured(docs: DataFrame, keep: Sequence[str] | None = None) -> DataFrame:
    """``(row, lang..., size, text_crc32)``: the columns kept as a struct, and what sharding looks at."""
    text = F.coalesce(F.col("text"), F.lit(""))
    return docs.select(
        as_row(list(keep if keep is not None else docs.columns)),
        F.col("doc_id").alias("doc_id"),
        *[F.col(d).alias(f"d_{d}") for d in DIMENSIONS if d != "size"],
        (F.octet_length(text) + 8).cast("long").alias("d_size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
    )


def sharded(docs: DataFrame, shards: int = SHARDS, law: str = "rows", bits: int = BITS, keep: Sequence[str] | None = None) -> DataFrame:
    """``(row, size, text_crc32, cell, shard, slot)``, one row per document, in shards 0 to ``shards - 1``.

    ``law="rows"``: numbers of documents differ by one at most. ``law="bytes"``: a
    shard ends where the bytes before the middle of a document pass its share, so
    sizes differ by no more than the largest document's. ``slot`` numbers a shard's
    documents from 0 in the curve's order; rows of one cell follow by language,
    source, size, checksum and ``doc_id`` (NULL first). NULL and empty texts have
    size 8 and checksum 0; NULL metadata is cell 0 of its dimension. Rows that are
    equal in all of this are told apart by their place in the input, so a hot value
    or a repeated row is spread over many tasks. ``keep`` names the columns that
    ``row`` holds (all by default). No rows give no rows.
    """
    if law not in LAWS:
        raise ValueError(f"law is one of {LAWS}")
    base = stored(measured(docs, keep), "measured")
    dims = [f"d_{d}" for d in DIMENSIONS]
    cuts = {d: quantiles(base, d, 1 << bits) for d in dims}
    cells = base.withColumns({f"c_{d}": _cell(F.col(d), cuts[d]) for d in dims})
    curve = cells.withColumn("cell", hilbert([F.col(f"c_{d}") for d in dims], bits)).drop(*[f"c_{d}" for d in dims])
    order = ["cell", *dims, "text_crc32", "doc_id", "place"]
    placed = _ordered(curve.withColumn("place", F.monotonically_increasing_id()), order, "curve")
    before, n, total = _before(placed, "d_size")
    placed = placed.join(F.broadcast(before), "part").withColumn("index", F.col("rows_before") + F.col("slot"))
    if law == "rows":
        placed = placed.withColumn("shard", F.expr(f"index * {shards} div {max(n, 1)}"))
        start = F.expr(f"(shard * {n} + {shards - 1}) div {shards}")
        placed = placed.withColumn("slot", F.col("index") - start)
    else:
        within = Window.partitionBy("part").orderBy("slot").rowsBetween(Window.unboundedPreceding, Window.currentRow)
        placed = placed.withColumn("upto", F.sum("d_size").over(within) + F.col("amount_before"))
        placed = stored(placed.withColumn("shard", F.expr(f"(2 * upto - d_size) * {shards} div {max(2 * total, 1)}")), "cut")
        first = [(r.shard, r.first) for r in placed.groupBy("shard").agg(F.min("index").alias("first")).collect()]  # one row per shard
        starts = literal_rows(docs.sparkSession, first or [(0, 0)], "shard bigint, first bigint")
        placed = placed.join(F.broadcast(starts), "shard").withColumn("slot", F.col("index") - F.col("first"))
    return placed.select("row", F.col("d_size").alias("size"), "text_crc32", "cell", F.col("shard").cast("int").alias("shard"), F.col("slot").cast("long").alias("slot"))


def write_shards(docs: DataFrame, path: str, shards: int = SHARDS, law: str = "bytes", bits: int = BITS) -> None:
    """Writes the documents with all their columns to ``path/shard=N``, each file a run of the curve.

    Readers that filter on a dimension skip files and row groups by their least and
    greatest values. Tasks write the runs they hold already, so a shard of any size
    is many tasks' work. The folders' name gets underscores in front if the
    documents have a column ``shard``.
    """
    out, name = sharded(docs, shards, law, bits), "shard"
    while name in docs.columns:
        name = f"_{name}"
    rows = out.sortWithinPartitions("shard", "slot").select("row.*", F.col("shard").alias(name))
    rows.write.partitionBy(name).parquet(path)


def report(docs: DataFrame, shards: int = SHARDS, law: str = "rows") -> DataFrame:
    """``(doc_id, size, text_crc32, law, shard, slot, grown_shard)``; texts are measured and left behind."""
    out = sharded(docs, shards, law, keep=["doc_id"])
    return out.select("row.doc_id", "size", "text_crc32", F.lit(law).alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))
