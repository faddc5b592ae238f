"""Roll-ups of ledgers as mergeable states: a batch of runs is added at the cost of its own rows.

A state has a row for each key: the first and the last sight, in the order of runs, and the number of runs.
Two states of different runs merge to the state of all their runs, so a batch is written as a state of
its own, and what is known of a key is merged from all states that have it. States of one level are merged
to one of the next as soon as there are FAN of them: a row is written again once a level, and a
reader sees a few states however many batches there were.

Rows lie in buckets of their keys' hashes. To classify a batch, only the buckets of its keys are read.
"""

from __future__ import annotations

import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkloom.tables import discard

#: States of a level that are merged to one of the next; buckets of keys.
FAN, BUCKETS = 8, 64
_LOG = "seq long, name string, level int, batch string, replaces array<string>"


class Rollup:
    """Sights of keys by runs, in one folder. One writer at a time adds to it.

    keys name the columns of a key (nulls are values like others), run its order, at what is kept of the
    first and the last run.
    """

    def __init__(self, spark: SparkSession, path: str, keys: list[str], run: str = "run_id", at: str = "at"):
        self.spark, self.path, self.keys, self.run, self.at = spark, path.rstrip("/"), keys, run, at

    def _log(self) -> list:
        try:
            return self.spark.read.schema(_LOG).parquet(f"{self.path}/log").collect()  # a row for each batch and merge
        except AnalysisException as e:
            if e.getCondition() != "PATH_NOT_FOUND":
                raise
            return []

    def _live(self, log: list) -> list:
        gone = {x for r in log for x in r["replaces"]}
        return sorted((r for r in log if r["name"] not in gone), key=lambda r: r["seq"])

    def _write(self, state: DataFrame, log: list, level: int, batch: str | None, replaces: list[str]) -> None:
        """A state, then the log row that makes it count."""
        name = f"state-{uuid.uuid4().hex}"
        state.repartition("bucket").write.partitionBy("bucket").parquet(f"{self.path}/{name}")
        seq = max((r["seq"] for r in log), default=0) + 1
        row = self.spark.createDataFrame([(seq, name, level, batch, replaces)], _LOG)
        row.coalesce(1).write.mode("append").parquet(f"{self.path}/log")

    def _bucket(self) -> Column:
        return F.pmod(F.xxhash64(*[F.col(k) for k in self.keys]), F.lit(BUCKETS)).cast("int").alias("bucket")

    def partial(self, sights: DataFrame) -> DataFrame:
        """The state of some runs, from all their sights (``keys, run, at``): of one run and key the smallest at counts."""
        once = sights.groupBy(*self.keys, self.run).agg(F.min(self.at).alias(self.at))
        sight = F.struct(F.col(self.run).alias("run"), F.col(self.at).alias("at"))
        return once.groupBy(*self.keys).agg(F.min(sight).alias("first"), F.max(sight).alias("last"), F.count("*").alias("runs")).select("*", self._bucket())

    def _merged(self, states: list[DataFrame]) -> DataFrame:
        rows = states[0]
        for x in states[1:]:
            rows = rows.unionByName(x)
        return rows.groupBy(*self.keys, "bucket").agg(F.min("first").alias("first"), F.max("last").alias("last"), F.sum("runs").alias("runs"))

    def _states(self, log: list, buckets: list[int] | None = None) -> list[DataFrame]:
        found = [self.spark.read.parquet(f"{self.path}/{r['name']}") for r in self._live(log)]
        return [x if buckets is None else x.where(F.col("bucket").isin(buckets)) for x in found]

    def add(self, sights: DataFrame, batch: str) -> DataFrame:
        """Adds runs that no earlier batch has; returns ``keys, run, classification``: new in the first run that has the key.

        A batch whose name was added before changes nothing, so that a repeated job is harmless. The classes
        come from the batch and the states in the buckets of its keys.
        """
        log = self._log()
        if any(r["batch"] == batch for r in log):
            return self.classified(sights)
        self._write(self.partial(sights), log, 0, batch, [])
        self._compact()
        return self.classified(sights)

    def _compact(self) -> None:
        while True:
            log = self._log()
            by_level: dict[int, list] = {}
            for r in self._live(log):
                by_level.setdefault(r["level"], []).append(r)
            full = next((k for k, rows in sorted(by_level.items()) if len(rows) >= FAN), None)
            if full is None:
                return
            old = [r["name"] for r in by_level[full]]
            self._write(self._merged([self.spark.read.parquet(f"{self.path}/{n}") for n in old]), log, full + 1, None, old)
            discard(self.spark, *[f"{self.path}/{n}" for n in old])

    def touched(self, sights: DataFrame) -> list[int]:
        """The buckets of the sights' keys: BUCKETS numbers at most."""
        return sorted(r["bucket"] for r in sights.select(self._bucket()).distinct().collect())

    def classified(self, sights: DataFrame) -> DataFrame:
        """``keys, run, classification`` of sights that are in the states: new in the first run of all that has the key, known later."""
        once = sights.select(*self.keys, self.run).distinct()
        states = self._states(self._log(), self.touched(sights))
        if not states:
            return once.withColumn("classification", F.lit("new"))
        known = self._merged(states).select(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(self.keys)], F.col("first.run").alias("_first"))
        same = F.lit(True)
        for i, k in enumerate(self.keys):
            same = same & F.col(k).eqNullSafe(F.col(f"_k{i}"))
        kind = F.when(F.coalesce(F.col("_first") < F.col(self.run), F.lit(False)), "known").otherwise("new")
        return once.join(known, same, "left").select(*self.keys, self.run, kind.alias("classification"))

    def candidates(self) -> DataFrame:
        """``keys, first_seen_at, last_seen_at, seen_count`` of all runs, by a merge of a few states."""
        states = self._states(self._log())
        if not states:
            raise ValueError(f"no batch was added at {self.path}")
        return self._merged(states).select(*self.keys, F.col("first.at").alias("first_seen_at"), F.col("last.at").alias("last_seen_at"), F.col("runs").alias("seen_count"))
