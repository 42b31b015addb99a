"""What a large input is spared: whole lines shuffled for a few numbers, tables written for one reader, large tasks."""

from datetime import date

import pytest
from pyspark.sql import functions as F

from tests.frames import ONE_PRODUCT, ONE_STORE, customers, products, staged, stores
from tezgah import queries
from tezgah.operators import dedupe, lookups, quality
from tezgah.plans import sales
from tezgah.plans.batches import BatchLog
from tezgah.plans.inventory import INVENTORY, stock_states, valued
from tezgah.plans.jobs import Jobs
from tezgah.plans.kpi import daily_store_kpi, pos_daily_kpi
from tezgah.plans.rejects import RejectStore
from tezgah.plans.sales import SALES, resolve_versions
from tezgah.sources import demo_model, shared
from tezgah.sources.demo_model import DemoModel
from tezgah.sources.warehouse import Warehouse

FOLDER = "/root/testdata/sf0.001"
THRESHOLD = "spark.sql.autoBroadcastJoinThreshold"


@pytest.fixture
def nothing_small(spark):
    """Tables as Spark sees them when they are large: none is broadcast by its size."""
    before = spark.conf.get(THRESHOLD)
    spark.conf.set(THRESHOLD, "0")
    yield
    spark.conf.set(THRESHOLD, before)


def plan(frame):
    return frame._jdf.queryExecution().executedPlan().toString()


def test_few_versions_are_sent_and_many_joined_by_a_shuffle(spark, nothing_small, monkeypatch):
    lines = [{"transaction_id": i, "store_id": i % 3, "product_id": i % 2} for i in range(12)]
    sides = stores(spark, ONE_STORE), products(spark, ONE_PRODUCT)
    found = {}
    for most, joins in ((1, 0), (0, 2)):
        monkeypatch.setattr(lookups, "SENT_KEYS", most)
        rows = resolve_versions(staged(spark, lines), *sides)
        assert plan(rows).count("SortMergeJoin") == joins
        found[most] = sorted(map(str, rows.collect()))
    assert found[0] == found[1] and len(found[0]) == 12


def test_a_wide_side_is_sent_for_fewer_rows(spark, nothing_small, monkeypatch):
    side = spark.range(4).selectExpr("id AS a", "id AS b", "id AS c", "id AS d")
    facts = spark.range(4).toDF("k")
    for most, joins in ((16, 0), (15, 1)):
        monkeypatch.setattr(lookups, "SENT_VALUES", most)
        joined = facts.join(lookups.sent_if_few(side, side), F.col("k") == F.col("a"))
        assert plan(joined).count("SortMergeJoin") == joins and joined.count() == 4
    narrow = side.select("a")
    assert "SortMergeJoin" not in plan(facts.join(lookups.sent_if_few(narrow, side), F.col("k") == F.col("a")))


def test_lines_joined_by_product_are_not_dealt_by_product_again(spark, nothing_small, monkeypatch):
    model = DemoModel(spark, FOLDER)
    monkeypatch.setattr(lookups, "few", lambda df, rows=None: "store_sk" in df.columns)
    text = plan(resolve_versions(model.stg_sales, model.store, model.product))
    assert text.count("SortMergeJoin") == 3 and text.count("Exchange hashpartitioning") == 5


@pytest.mark.parametrize("kpi", [lambda s, c: daily_store_kpi(s, c), lambda s, c: pos_daily_kpi(s)])
def test_daily_kpis_are_dealt_once_a_side(spark, nothing_small, kpi):
    lines = staged(spark, [{"transaction_id": i} for i in range(3)]).withColumns(
        {"store_sk": F.lit(11).cast("bigint"), "customer_sk": F.col("customer_id")}
        | {c: F.col("unit_cost").cast("decimal(14,2)") for c in ("gross_sales_amount", "net_sales_amount", "cogs_amount", "gross_margin_amount")}
    )
    text = plan(kpi(lines.repartition(2), customers(spark, [5])))
    assert not [x for x in text.split("Exchange hashpartitioning(")[1:] if "transaction_id" in x.split(")")[0]]


def test_the_stock_is_dealt_by_product_for_its_fold_and_its_prices(spark, nothing_small, monkeypatch):
    monkeypatch.setattr(lookups, "few", lambda df, rows=None: "store_sk" in df.columns)
    lines = staged(spark, [{}]).withColumns({"store_sk": F.lit(11).cast("bigint"), "product_sk": F.lit(21).cast("bigint")})
    sides = stores(spark, ONE_STORE), products(spark, ONE_PRODUCT)
    rows = valued(stock_states(lines, *sides, [date(2024, 1, 31)]), *sides)
    assert rows.count() == 1 and not [x for x in plan(rows).split("Exchange hashpartitioning(")[1:] if x.startswith("store_id")]


@pytest.mark.parametrize("sent", [100, 0])
def test_stored_lines_meet_the_fact_by_hashes_and_only_copies_are_shuffled(spark, nothing_small, monkeypatch, sent):
    monkeypatch.setattr(dedupe, "SENT_HASHES", sent)
    rows = [(1, "a", 5), (1, "a", 4), (2, "a", 1), (3, None, 2), (3, None, 1), (4, "b", 7), (None, "b", 3)]
    lines = shared.stored(spark.createDataFrame(rows, "k int, j string, o int"), "lines")
    there = spark.createDataFrame([(2, "a"), (3, None), (9, "z"), (9, "z"), (None, "b")], "k bigint, j string")
    got = dedupe.insert_skip_conflicts(there, lines, ["k", "j"], ["o"], in_storage=True)
    want = dedupe.insert_skip_conflicts(there, lines, ["k", "j"], ["o"])
    assert plan(got).count("SortMergeJoin") == 1  # of the copies, or if they are many of all lines
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))
    assert got.schema == want.schema and got.count() == 4


def test_drops_are_written_once_and_the_middle_one_twice(spark, monkeypatch):
    model, seen = DemoModel(spark, FOLDER), []
    monkeypatch.setattr(queries, "stored", lambda *_: 1 / 0)
    monkeypatch.setattr(queries, "stream_sales", lambda spark, landing, *_: seen.append(spark.read.parquet(landing).count()))
    queries._streamed(model)
    moment = F.col("transaction_datetime")
    counts = [model.stg_sales.filter((moment > F.lit(a)) & (moment <= F.lit(b))).count()
              for a, b in ((date(1990, 1, 1), date(1997, 6, 30)), (date(1997, 6, 30), date(1999, 12, 31)), (date(1999, 12, 31), date(2002, 1, 1)))]
    assert seen == [counts[0], counts[0] + 2 * counts[1], counts[0] + 2 * counts[1] + counts[2]] and all(counts)


def test_the_full_run_loads_lines_as_they_are_joined(spark, monkeypatch):
    loads = []
    monkeypatch.setattr(queries, "stored", lambda *_: 1 / 0)
    monkeypatch.setattr(queries.Jobs, "incremental_sales", lambda self, staged, *_: loads.append(staged))
    monkeypatch.setattr(queries.Jobs, "scd2", lambda *_, **__: None)
    monkeypatch.setattr(queries.Jobs, "scd1", lambda *_, **__: None)
    queries.etl_full_run(model := DemoModel(spark, FOLDER))
    assert loads == [model.stg_sales] * 3


def test_a_query_frees_the_shuffles_of_its_writes_and_leaves_the_session_as_it_was(spark, monkeypatch):
    before, seen = spark.conf.get(shared.FREED), []

    def some_rows(m):
        seen.append(m.spark.conf.get(shared.FREED))
        return m.spark.range(1).toDF("n")

    queries._registered(some_rows)
    assert queries.QUERIES.pop("some_rows")(spark, FOLDER).count() == 1
    assert seen == ["true"] and spark.conf.get(shared.FREED) == before


def test_lines_are_dealt_by_month_before_their_measures_are_added(spark, monkeypatch):
    load = DemoModel(spark, FOLDER).load()
    frame = type(load.lines)
    dealt, real = [], frame.hint
    monkeypatch.setattr(frame, "hint", lambda self, name, *by: dealt.append(self.columns) or real(self, name, *by))
    narrow, wide = Warehouse(spark), Warehouse(spark)
    found = narrow.append(SALES, load.lines, finish=load.finish)
    assert wide.append(SALES, load.rows) == found and found["rows"] > 0
    assert "gross_sales_amount" not in dealt[0] and "gross_sales_amount" in dealt[1]
    rows = [sorted(map(str, wh.read(SALES).drop("etl_loaded_at").collect())) for wh in (narrow, wide)]
    assert rows[0] == rows[1]


def test_stock_states_are_written_once_and_a_month_is_not_dealt(spark, monkeypatch):
    jobs = Jobs(Warehouse(spark))
    sides = {"dim.store": stores(spark, ONE_STORE), "dim.product": products(spark, ONE_PRODUCT)}
    for name, frame in sides.items():
        jobs.wh.replace(name, frame)
    lines = staged(spark, [{"transaction_id": i} for i in range(4)]).withColumns(
        {"store_sk": F.lit(11).cast("bigint"), "product_sk": F.lit(21).cast("bigint")}
    )
    jobs.wh.append(SALES, lines)
    monkeypatch.setattr("tezgah.plans.jobs.stored", lambda *_: 1 / 0)
    monkeypatch.setattr(type(lines), "hint", lambda *_: 1 / 0)
    jobs.refresh_inventory([date(2024, 1, 31)])
    row = jobs.wh.read(INVENTORY).first()
    assert (row["date_id"], row["store_sk"], row["product_sk"], row["stock_qty"]) == (20240131, 11, 21, -4)
    assert jobs.stock.before(date(2024, 2, 1)).state.count() == 1


def test_the_stored_fact_meets_its_copies_by_hashes(spark, monkeypatch):
    written = []
    monkeypatch.setattr(demo_model, "stored", lambda df, name: written.append(name) or df)
    monkeypatch.setattr(sales, "stored", lambda df, name: written.append(name) or df)
    assert DemoModel(spark, FOLDER).stored_sales.count() and written == ["resolved", "sales"]


def test_waiting_rejects_do_not_meet_in_the_task_of_their_batch(spark, nothing_small):
    log = BatchLog(spark, shared.scratch_path(spark, "rejected"))
    store = RejectStore(log)
    with log.batch("incremental_sales", "fact.sales_transaction", "INCREMENTAL", "POS") as batch:
        batch.count(rejected=store.write(staged(spark, [{}, {"line_number": 2}]).withColumn("reject_reason", F.lit("no_store")), batch.id))
    waiting = store.waiting()
    assert waiting.count() == 2 and "SortMergeJoin" not in plan(waiting)


def test_checked_sales_and_results_are_not_written_for_one_reader(spark, monkeypatch):
    written = []
    monkeypatch.setattr(queries, "stored", lambda df, name: written.append(name) or df)
    frames = queries._checked(DemoModel(spark, FOLDER))
    assert len(frames) == 20 and not written


def test_keys_of_facts_are_counted_one_fact_after_the_other(spark, monkeypatch):
    counted = []
    monkeypatch.setattr(quality, "cut", lambda df: counted.append(df) or shared.cut(df))
    facts = {
        SALES: "1L AS sales_tx_sk, id AS transaction_id, 1 AS line_number, 20240101 AS date_id, 'POS' AS source_system",
        INVENTORY: "id AS inv_sk, 20240101 AS date_id, 1L AS store_sk, 1L AS product_sk",
    }
    frames = {name: spark.range(3).selectExpr(*columns.split(", ")) for name, columns in facts.items()}
    frames["dict.d_currency"] = spark.sql("SELECT 'TRY' AS currency_code")
    found = quality.duplicate_keys(frames, apart=set(facts))
    assert len(counted) == 2
    got = {(r["table_name"], r["rule"]): r["violations"] for r in found.collect()}
    assert got[SALES, "sales_tx_sk,date_id"] == got[INVENTORY, "date_id,store_sk,product_sk"] == 2 and sum(got.values()) == 4
    assert len(got) == 5 and got == {(r["table_name"], r["rule"]): r["violations"] for r in quality.duplicate_keys(frames).collect()}


def test_more_rows_get_more_and_not_larger_tasks(spark):
    number, size = "spark.sql.shuffle.partitions", "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    before = {key: spark.conf.get(key, None) for key in (number, size)}
    try:
        spark.conf.set(number, "8")
        spark.conf.unset(size)
        for rows, partitions in ((0, 8), (8 * shared.ROWS_A_PARTITION, 8), (8 * shared.ROWS_A_PARTITION + 1, 9), (10**12, shared.MOST_PARTITIONS)):
            shared.sized_tasks(spark, rows)
            assert int(spark.conf.get(number)) == partitions and spark.conf.get(size) == str(shared.TASK_BYTES)
        spark.conf.set(size, "4KB")
        shared.sized_tasks(spark, 1)
        assert spark.conf.get(size) == "4KB"
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)
