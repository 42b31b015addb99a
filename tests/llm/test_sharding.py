"""Sharding along a Hilbert curve, against its definition and a plain loop."""

import itertools
import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tezgah.llm import sharding

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, shard long, slot string, row string, place int"


def made(spark, n=240):
    rows = [(k if k % 5 else None, "x" * (k * 37 % 91) if k % 7 else None, [None, "de", "en", "en", "en"][k % 5], f"s{k * k % 11}" if k % 3 else "hot", 1, 3, "q", "r", 9) for k in range(n)]
    rows += [(7, "same é", "en", "hot", 1, 3, "q", "r", 9)] * 60  # a hot group of equal rows
    return rows, spark.createDataFrame(rows, SCHEMA).repartition(5)


@pytest.mark.parametrize("dims,bits", [(2, 3), (3, 2), (3, 3), (4, 1)])
def test_the_curve_visits_each_cell_once_and_steps_to_a_neighbour(spark, dims, bits):
    side = range(1 << bits)
    grid = spark.createDataFrame(list(itertools.product(side, repeat=dims)), ", ".join(f"c{k} int" for k in range(dims)))
    rows = grid.select("*", sharding.hilbert([F.col(f"c{k}") for k in range(dims)], bits).alias("h")).orderBy("h").collect()
    assert [r.h for r in rows] == list(range((1 << bits) ** dims))
    for a, b in itertools.pairwise(rows):
        assert sum(abs(x - y) for x, y in zip(a[:dims], b[:dims], strict=True)) == 1


def test_quantiles_are_those_of_the_sorted_rows(spark):
    rows, docs = made(spark)
    base = sharding.measured(docs).cache()
    for column, of in (("d_source", lambda r: r[3]), ("d_size", lambda r: len((r[1] or "").encode()) + 8), ("d_lang", lambda r: r[2])):
        values = sorted(of(r) for r in rows if of(r) is not None)
        expected = [values[k * len(values) // 8] for k in range(1, 8)]
        assert sharding.quantiles(base, column, 8) == expected


@pytest.mark.parametrize("law", sharding.LAWS)
def test_shards_hold_each_row_once_and_nearly_equal_amounts(spark, law):
    rows, docs = made(spark)
    out = sharding.sharded(docs, 6, law).collect()
    assert Counter(tuple(r.row) for r in out) == Counter(rows)
    for r in out:
        raw = (r.row.text or "").encode()
        assert (r.size, r.text_crc32) == (len(raw) + 8, zlib.crc32(raw))
    assert {r.shard for r in out} == set(range(6))
    for s in range(6):
        assert sorted(r.slot for r in out if r.shard == s) == list(range(sum(r.shard == s for r in out)))
    cells = [r.cell for r in sorted(out, key=lambda r: (r.shard, r.slot))]
    assert cells == sorted(cells)
    amount = Counter()
    for r in out:
        amount[r.shard] += 1 if law == "rows" else r.size
    if law == "rows":
        assert max(amount.values()) - min(amount.values()) <= 1
    else:
        assert max(abs(a - sum(amount.values()) / 6) for a in amount.values()) <= max(r.size for r in out)


def test_the_report_has_the_contract_s_columns(spark):
    rows, docs = made(spark, 30)
    out = sharding.report(docs)
    assert dict(out.dtypes) == {"doc_id": "bigint", "size": "bigint", "text_crc32": "bigint", "law": "string", "shard": "int", "slot": "bigint", "grown_shard": "int"}
    assert out.count() == len(rows) and out.where("law <> 'rows' or grown_shard is not null").isEmpty()


def test_nothing_and_a_single_row(spark):
    assert sharding.report(spark.createDataFrame([], SCHEMA)).collect() == []
    one = spark.createDataFrame([(None,) * 9], SCHEMA)
    for law in sharding.LAWS:
        (row,) = sharding.sharded(one, law=law).collect()
        assert (row.size, row.text_crc32, row.slot) == (8, 0, 0) and 0 <= row.shard < 24


def test_files_are_pruned_in_every_dimension(spark, tmp_path):
    rows = [(k, "y" * (k * 7919 % 1000), f"l{k % 8}", f"s{k * 31 % 64:02d}", 1) for k in range(8000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    path = str(tmp_path / "shards")
    sharding.write_shards(docs, path, 24)
    back = spark.read.parquet(path)
    assert Counter(tuple(r)[:5] for r in back.collect()) == Counter(rows)
    size = F.octet_length("text")
    ranges = back.groupBy("shard").agg(*[f(c).alias(n + k) for c, k in (("lang", "l"), ("source", "s"), (size, "z")) for f, n in ((F.min, "min_"), (F.max, "max_"))]).collect()
    met = {k: sum(r[f"min_{k}"] <= v <= r[f"max_{k}"] for r in ranges) for k, v in (("l", "l3"), ("s", "s20"), ("z", 500))}
    assert all(n <= 14 for n in met.values()), met
    _, clashing = made(spark, 20)
    sharding.write_shards(clashing, path + "2", 3)
    assert sorted(spark.read.parquet(path + "2").columns) == sorted([*clashing.columns, "_shard"])


def test_no_python_worker_and_no_cross_join(spark):
    _, docs = made(spark, 30)
    plan = sharding.report(docs)._jdf.queryExecution().executedPlan().toString()
    assert not any(w in plan for w in ("Python", "Arrow", "CartesianProduct", "BroadcastNestedLoopJoin"))
