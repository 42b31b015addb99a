"""Slowly changing dimensions: overwrite (type 1) and versioned (type 2)."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from datetime import date, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tezgah.functions.expressions import attribute_hash
from tezgah.operators.ranking import global_row_number
from tezgah.sources.shared import cut


@dataclass(frozen=True)
class Parent:
    """The dimension a versioned row hangs under: looked up by business id."""

    frame: DataFrame
    id: str
    sk: str


@dataclass(frozen=True)
class ScdSpec:
    """What a versioned dimension tracks."""

    table: str
    key: str
    sk: str
    tracked: tuple[str, ...]


@dataclass(frozen=True)
class ScdChange:
    """Outcome of ``scd2_apply``.

    ``rows`` is the whole dimension afterwards; ``inserted`` and ``expired``
    are its new and closed rows; ``rejected`` the staged rows whose parent is
    unknown (their old version, if any, is closed all the same).
    """

    rows: DataFrame
    inserted: DataFrame
    expired: DataFrame
    rejected: DataFrame


# The attributes whose change opens a new version, in hash order.
STORE = ScdSpec(
    "dim.store", "store_id", "store_sk",
    ("store_code", "store_name", "format_code", "store_sqm", "selling_sqm",
     "region_id", "cluster", "headcount", "is_franchise"),
)
PRODUCT = ScdSpec(
    "dim.product", "product_id", "product_sk",
    ("product_name", "brand", "supplier_code", "list_price", "cost_price",
     "status_code", "category_id"),
)
# Customer and employee are declared as versioned; which attributes count is ours.
CUSTOMER = ScdSpec(
    "dim.customer", "customer_id", "customer_sk",
    ("customer_segment", "age_band", "gender", "city", "loyalty_enrolled",
     "loyalty_tier", "clv_segment"),
)
EMPLOYEE = ScdSpec(
    "dim.employee", "employee_id", "employee_sk",
    ("employee_code", "full_name", "job_title", "department", "employment_type",
     "store_id", "manager_employee_id"),
)


def classify(target: DataFrame, staged: DataFrame, spec: ScdSpec, hash_null: str = "skip") -> DataFrame:
    """The staged rows with ``scd_hash``, ``scd_version`` (the next) and ``scd_action``.

    The action is ``new`` (key never seen), ``changed`` (a current version has
    another hash) or ``same``. A current version without a hash compares as
    unknown and stays ``same``; ``hash_null='changed'`` versions it instead.
    The target is reduced to one row per key before it meets the staged rows.
    """
    stored = F.when(F.col("is_current"), F.col("scd_hash"))
    state = target.groupBy(F.col(spec.key).alias("_key")).agg(
        F.max("scd_version").alias("_version"),
        F.min(stored).alias("_low"),
        F.max(stored).alias("_high"),
        F.coalesce(F.bool_or(F.col("is_current") & F.col("scd_hash").isNull()), F.lit(False)).alias("_blank"),
    )
    hashed = staged.withColumn("scd_hash", attribute_hash(spec.tracked))
    differs = (F.col("_low") != F.col("scd_hash")) | (F.col("_high") != F.col("scd_hash"))
    if hash_null == "changed":
        differs = F.col("_blank") | differs
    action = F.when(F.col("_key").isNull(), "new").when(differs, "changed").otherwise("same")
    return (
        hashed.join(state, F.col(spec.key) == F.col("_key"), "left")
        .withColumns(
            {
                "scd_action": action,
                "scd_version": (F.coalesce("_version", F.lit(0)) + 1).cast("int"),
            }
        )
        .drop("_key", "_version", "_low", "_high", "_blank")
    )


def require_unique(staged: DataFrame, key: str) -> None:
    """Raises if a staged business key occurs twice; there is no right order then."""
    doubled = staged.groupBy(key).count().filter("count > 1").select(key).take(3)
    if doubled:
        raise ValueError(f"staged rows repeat {key}: {[row[0] for row in doubled]}")


def scd2_apply(
    target: DataFrame,
    staged: DataFrame,
    spec: ScdSpec,
    effective: date,
    parent: Parent | None = None,
    hash_null: str = "skip",
    now: Column | None = None,
) -> ScdChange:
    """Versions a dimension from a full or partial set of staged rows.

    Changed keys: their current versions end the day before ``effective``.
    Changed and new keys: one version starting at ``effective``, under the
    parent found by its business id. Keys not staged stay as they are.
    """
    require_unique(staged, spec.key)
    now = F.localtimestamp() if now is None else now
    # Only what changes goes on; it is read several times below, the staged rows once.
    acting = cut(classify(target, staged, spec, hash_null).filter("scd_action <> 'same'"))

    opened = acting
    if parent is not None:
        found = parent.frame.select(
            F.col(parent.id).alias("_parent"), F.col(parent.sk).alias(parent.sk)
        )
        opened = acting.drop(parent.sk).join(
            found, F.col(parent.id) == F.col("_parent"), "left"
        )
        rejected = opened.filter(F.col("_parent").isNull()).select(*staged.columns)
        opened = opened.filter(F.col("_parent").isNotNull()).drop("_parent")
    else:
        rejected = acting.limit(0).select(*staged.columns)

    last_sk = target.select(F.coalesce(F.max(spec.sk), F.lit(0))).scalar()
    opened = global_row_number(opened.drop(spec.sk), [spec.key], spec.sk, start=1)
    opened = opened.withColumns(
        {
            spec.sk: F.col(spec.sk) + F.greatest(last_sk, F.lit(0)),
            "scd_start_date": F.lit(effective),
            "scd_end_date": F.lit(None).cast("date"),
            "is_current": F.lit(True),
            "created_at": now,
            "updated_at": now,
        }
    )
    types = {f.name: f.dataType for f in target.schema}
    inserted = opened.select(
        *[
            (F.col(c) if c in opened.columns else F.lit(None)).cast(types[c]).alias(c)
            for c in target.columns
        ]
    )

    changed = acting.filter("scd_action = 'changed'").select(F.col(spec.key).alias("_changed"))
    marked = target.join(changed, F.col(spec.key) == F.col("_changed"), "left")
    closing = F.col("_changed").isNotNull() & F.col("is_current")
    closed = {
        "scd_end_date": F.lit(effective - timedelta(days=1)),
        "is_current": F.lit(False),
        "updated_at": now,
    }
    kept = marked.withColumns(
        {c: F.when(closing, v).otherwise(F.col(c)) for c, v in closed.items() if c in types}
        | {"_closed": closing}
    )
    expired = kept.filter("_closed").select(*target.columns)
    rows = kept.select(*target.columns).unionByName(inserted)
    return ScdChange(rows, inserted, expired, rejected)


def scd1_upsert(
    target: DataFrame,
    staged: DataFrame,
    key: str,
    sk: str,
    defaults: dict[str, Column] | None = None,
    now: Column | None = None,
) -> DataFrame:
    """Overwrites by business key: staged rows replace, new ones get fresh keys.

    Columns the staged rows lack keep their stored value; for new rows they
    take ``defaults``, else NULL.
    """
    require_unique(staged, key)
    now = F.localtimestamp() if now is None else now
    defaults = {"created_at": now, **(defaults or {})}
    extra = [c for c in target.columns if c not in staged.columns and c != sk]
    stored = target.select(
        F.col(key).alias("_key"), sk, *[F.col(c).alias(f"_old_{c}") for c in extra]
    )
    joined = staged.drop(sk).join(stored, F.col(key) == F.col("_key"), "left").withColumns(
        {
            c: F.when(F.col("_key").isNotNull(), F.col(f"_old_{c}")).otherwise(
                defaults.get(c, F.lit(None))
            )
            for c in extra
        }
    )
    if "updated_at" in target.columns:
        joined = joined.withColumn("updated_at", now)
    last_sk = target.select(F.coalesce(F.max(sk), F.lit(0))).scalar()
    fresh = global_row_number(joined.filter("_key is null").drop(sk), [key], sk, start=1)
    fresh = fresh.withColumn(sk, F.col(sk) + F.greatest(last_sk, F.lit(0)))
    types = {f.name: f.dataType for f in target.schema}

    def shaped(df: DataFrame) -> DataFrame:
        return df.select(*[F.col(c).cast(types[c]).alias(c) for c in target.columns])

    untouched = target.join(staged.select(key), key, "left_anti").select(*target.columns)
    return (
        untouched.unionByName(shaped(joined.filter("_key is not null")))
        .unionByName(shaped(fresh))
    )
