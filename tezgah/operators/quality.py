"""Constraints as jobs: each counts violations per table and rule.

Nothing enforces keys, references or domains when Parquet is written, so
these jobs check them afterwards. They read the rules from the table
catalogue and return ``(table_name, rule, violations)``, one row per rule,
zero where it holds.
"""

from __future__ import annotations

from collections.abc import Collection, Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tezgah.functions.literals import literal_rows
from tezgah.operators.lookups import OPEN_END
from tezgah.schemas import TABLES
from tezgah.sources.shared import cut

Frames = Mapping[str, DataFrame]


def _union(parts: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


def _one_pass(df: DataFrame, table: str, breaches: Mapping[str, Column]) -> DataFrame:
    """One scan per table: all its rules are conditional sums, then unpivoted."""
    sums = df.agg(*[F.count_if(breach).alias(rule) for rule, breach in breaches.items()])
    return sums.unpivot([], list(breaches), "rule", "violations").select(
        F.lit(table).alias("table_name"), "rule", "violations"
    )


def _value(columns: Sequence[str]) -> Column:
    """The columns as one string; different values, NULLs among them, give different strings."""
    parts = []
    for c in columns:
        text = F.col(c).cast("string")
        parts.append(F.coalesce(F.concat(F.length(text).cast("string"), F.lit(":"), text), F.lit("-")))
    return F.concat(*parts)


def _counted(df: DataFrame, rules: Mapping[str, Column]) -> DataFrame:
    """``(rule, value, n)``: one scan stacks the values of all rules, one aggregate folds them; NULLs go."""
    stacked = df.select(F.inline(F.array(*[F.struct(F.lit(rule).alias("rule"), value.alias("value")) for rule, value in rules.items()])))
    return stacked.filter(F.col("value").isNotNull()).groupBy("rule", "value").agg(F.count("*").alias("n"))


def _every(found: DataFrame, rules: Sequence[tuple[str, str]]) -> DataFrame:
    """``found`` with zero for the rules it has no row of."""
    names = literal_rows(found.sparkSession, list(rules), "table_name string, rule string")
    filled = names.join(found, ["table_name", "rule"], "left")
    return filled.select("table_name", "rule", F.coalesce("violations", F.lit(0)).cast("bigint").alias("violations"))


def duplicate_keys(frames: Frames, apart: Collection[str] = ()) -> DataFrame:
    """Rows beyond the first per primary or unique key; one scan and one fold per table.

    Tables of ``apart`` are counted at once, one after the other: in one query the shuffles of all would lie on disk together.
    """
    parts, rules = [], []
    for name, df in frames.items():
        keys = {",".join(key): key for key in (TABLES[name].primary_key, *TABLES[name].unique)}
        repeated = _counted(df, {rule: _value(key) for rule, key in keys.items()}).filter("n > 1")
        found = repeated.groupBy(F.lit(name).alias("table_name"), "rule").agg(F.sum(F.col("n") - 1).alias("violations"))
        parts.append(cut(found) if name in apart else found)
        rules += [(name, rule) for rule in keys]
    return _every(_union(parts), rules)


def orphans(frames: Frames) -> DataFrame:
    """Rows whose reference has no parent; NULL references pass, an absent parent table raises.

    One scan of a table emits all its references, folded to one row per value before
    they meet the parents: a value held by a third of the rows is one row there. All
    references meet all parents' keys in one join.
    """
    used, rules, wanted = [], [], set()
    for name, df in frames.items():
        references = {f"{column}->{parent}": (column, parent, key) for column, parent, key in TABLES[name].references}
        absent = [parent for _, parent, _ in references.values() if parent not in frames]
        if absent:
            raise ValueError(f"{name} refers to tables that are not given: {', '.join(absent)}")
        if references:
            found = _counted(df, {rule: F.col(column).cast("string") for rule, (column, _, _) in references.items()})
            parent = F.substring_index("rule", "->", -1).alias("parent")
            used.append(found.select(F.lit(name).alias("table_name"), "rule", parent, "value", "n"))
            rules += [(name, rule) for rule in references]
            wanted |= {(parent, key) for _, parent, key in references.values()}
    if not used:
        return _every(literal_rows(next(iter(frames.values())).sparkSession, [], "table_name string, rule string, violations bigint"), [])
    known = _union([frames[parent].select(F.lit(parent).alias("parent"), F.col(key).cast("string").alias("value")) for parent, key in sorted(wanted)])
    lost = _union(used).join(known, ["parent", "value"], "left_anti")
    return _every(lost.groupBy("table_name", "rule").agg(F.sum("n").alias("violations")), rules)


def not_null(frames: Frames) -> DataFrame:
    """NULLs in required columns."""
    return _union(
        [
            _one_pass(df, name, {c: F.col(c).isNull() for c in TABLES[name].not_null})
            for name, df in frames.items()
        ]
    )


def domain(frames: Frames) -> DataFrame:
    """Values outside the listed ones; NULLs pass."""
    return _union(
        [
            _one_pass(df, name, {c: ~F.col(c).isin(*v) for c, v in TABLES[name].domains.items()})
            for name, df in frames.items()
            if TABLES[name].domains
        ]
    )


def width(frames: Frames) -> DataFrame:
    """Strings longer than declared."""
    return _union(
        [
            _one_pass(df, name, {c: F.length(c) > n for c, n in TABLES[name].widths.items()})
            for name, df in frames.items()
            if TABLES[name].widths
        ]
    )


def scd2(frames: Frames) -> DataFrame:
    """Versioned dimensions: one current row per key, versions 1..n, no overlap.

    A version meets its successor by an equality join on (key, version + 1),
    so the versions of one key need not sit in one task. Copies of a version
    fold to its widest span before that and cannot multiply.
    """
    parts = []
    for name, df in frames.items():
        key = TABLES[name].business_key
        if key is None:
            continue
        per_key = df.groupBy(key).agg(
            F.count_if("is_current").alias("_current"),
            F.min("scd_version").alias("_low"),
            F.max("scd_version").alias("_high"),
            F.count("*").alias("_n"),
            F.count_distinct("scd_version").alias("_distinct"),
        )
        gaps = (F.col("_low") != 1) | (F.col("_high") != F.col("_n")) | (F.col("_n") != F.col("_distinct"))
        parts.append(
            _one_pass(per_key, name, {"one_current": F.col("_current") != 1, "version_gaps": gaps})
        )
        spans = df.groupBy(key, F.col("scd_version").alias("_version")).agg(
            F.max(F.coalesce("scd_end_date", F.lit(OPEN_END))).alias("_end"),
            F.min("scd_start_date").alias("_start"),
        )
        earlier = spans.select(key, (F.col("_version") + 1).alias("_version"), "_end")
        pairs = earlier.join(spans.select(key, "_version", "_start"), [key, "_version"])
        parts.append(_one_pass(pairs, name, {"overlap": F.col("_end") >= F.col("_start")}))
    return _union(parts)
