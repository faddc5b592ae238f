"""Append-only ledgers: latest rows, change classes, first sights, roll-ups, invariants.

Ledgers are immutable event tables; everything that would be an update is a derived view.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sparkloom.tables import unused


def latest(df: DataFrame, keys: list[str], order: str = "id") -> DataFrame:
    """The row with the largest order value for each key, by one aggregation with map-side combine."""
    packed = df.groupBy(*keys).agg(F.max_by(F.struct(*df.columns), F.col(order)).alias("_row"))
    return packed.select("_row.*")


#: Ids of a range that one task orders for a key; a key with more is spread over several.
RANGE_IDS = 1 << 20


def change_class(df: DataFrame, keys: list[str], sha: str, order: str = "id", status: str = "status") -> DataFrame:
    """Adds classification: NEW, UNCHANGED or CHANGED against the key's previous successful row; null for failures.

    order is a whole number. Rows are ordered within ranges of it; the last success before a range is
    found among the ranges' last ones and joined by key and range, so that a key with very many rows
    is neither one task's nor meets all its ranges. Null keys are keys like others; a row without
    order stands before all others.
    """
    here, own, last, key = unused(df, "range", "own", "last", "key")
    good, same = F.col(status) == "success", F.struct(*[F.col(k).alias(f"k{i}") for i, k in enumerate(keys)])
    rows = df.withColumns({key: same, here: F.coalesce(F.floor(F.col(order) / RANGE_IDS), F.lit(-1))})
    ends = rows.groupBy(key, here).agg(F.max_by(F.when(good, F.col(sha)), F.when(good, F.coalesce(F.col(order), F.lit(-1)))).alias(last))
    handed = ends.withColumn(last, F.last(last, ignorenulls=True).over(Window.partitionBy(key).orderBy(here).rowsBetween(Window.unboundedPreceding, -1)))
    before_here = F.last(F.when(good, F.col(sha)), ignorenulls=True).over(Window.partitionBy(key, here).orderBy(order).rowsBetween(Window.unboundedPreceding, -1))
    rows = rows.withColumn(own, before_here).join(handed.where(F.col(last).isNotNull()), [key, here], "left")
    before = F.coalesce(own, last)
    kind = F.when(before.isNull(), "NEW").when(before == F.col(sha), "UNCHANGED").otherwise("CHANGED")
    return rows.withColumn("classification", F.when(good, kind)).select(*df.columns, "classification")


def new_or_known(df: DataFrame, keys: list[str], run: str) -> DataFrame:
    """``keys, run, classification``: new in the first run that has the key, known later."""
    once = df.select(*keys, run).distinct()
    first = F.min(run).over(Window.partitionBy(*keys))
    return once.withColumn("classification", F.when(F.col(run) == first, "new").otherwise("known"))


def candidates(df: DataFrame, keys: list[str], run: str, at: str) -> DataFrame:
    """First and last sight in the order of runs (not of times), and in how many runs."""
    return df.groupBy(*keys).agg(F.min_by(at, run).alias("first_seen_at"), F.max_by(at, run).alias("last_seen_at"), F.countDistinct(run).alias("seen_count"))


def origins(df: DataFrame, keys: list[str], origin: str) -> DataFrame:
    """The sorted set of entrypoints of each key; sets are small, as entrypoints are configured."""
    return df.groupBy(*keys).agg(F.array_sort(F.collect_set(origin)).alias("origins"))


def run_summary(classified: DataFrame, run: list[str]) -> DataFrame:
    new = F.col("classification") == "new"
    return classified.groupBy(*run).agg(F.count("*").alias("candidate_count"), F.count_if(new).alias("new_count"), F.count_if(~new).alias("known_count"))


def stage_counts(classified: DataFrame, by: list[str]) -> DataFrame:
    count = lambda c, name: F.count_if(c).alias(name)
    kinds = [count(F.col("classification") == k, f"n_{k.lower()}") for k in ("NEW", "UNCHANGED", "CHANGED")]
    out = classified.groupBy(*by).agg(*kinds, count(F.col("status") == "error", "n_error"))
    return out.withColumn("ok", F.col("n_error") == 0)


def source_status(sources: DataFrame, key: str, ledgers: dict[str, DataFrame], value: str = "status", order: str = "id") -> DataFrame:
    """Sources with the latest value of each ledger, whatever its status; NEVER_RUN where there is none."""
    out = sources
    for name, ledger in ledgers.items():
        last = ledger.groupBy(key).agg(F.max_by(value, order).alias(name))
        out = out.join(last, key, "left").withColumn(name, F.coalesce(name, F.lit("NEVER_RUN")))
    return out


def violations(df: DataFrame, entity: Column, rules: list[tuple[str, Column]]) -> DataFrame:
    """``entity_id, rule_no, message`` for each rule that a row breaks; an unknown outcome breaks it."""
    broken = [F.when(~F.coalesce(ok, F.lit(False)), F.struct(F.lit(n).alias("rule_no"), F.lit(text).alias("message"))) for n, (text, ok) in enumerate(rules, 1)]
    rows = df.select(entity.alias("entity_id"), F.explode(F.array_compact(F.array(*broken))).alias("v"))
    return rows.select("entity_id", "v.rule_no", "v.message")


def success_rules(sha: str = "sha256") -> list[tuple[str, Column]]:
    """Success has a hash and no error; an error has a text and no hash."""
    ok, has, bad = F.col("status") == "success", F.col(sha).isNotNull(), F.col("error").isNotNull()
    return [("status is success or error", F.col("status").isin("success", "error")), ("success needs a hash and no error", ~ok | (has & ~bad)), ("an error needs a text and no hash", ok | (bad & ~has))]
