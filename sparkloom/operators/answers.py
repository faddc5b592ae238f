"""A provider's answers, kept one by one as they come, so that a job that dies repeats no finished call.

Answers stand in a folder that executors share, a file each, named by the hash of the request: they are
written beside their place and renamed into it. A later run reads the folder first and asks only for
what isn't there. compact() turns the files into a Parquet table by hash prefix, which is read the same way.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Iterator
from concurrent.futures import ThreadPoolExecutor

import pandas as pd
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkloom.tables import discard, unused

#: Calls that one task has under way at a time.
IN_FLIGHT = 8
ANSWER = "request_sha256 string, response string, error string"


def kept_answers(spark: SparkSession, path: str) -> DataFrame:
    """``request_sha256, response, error``: one answer a request, from the compacted table and the single files; a response goes before a failure."""
    try:
        single = spark.read.schema(ANSWER).option("recursiveFileLookup", "true").option("pathGlobFilter", "*.json").json(f"{path}/single")
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        single = spark.createDataFrame([], ANSWER)
    try:
        table = spark.read.parquet(f"{path}/table").select("request_sha256", "response", "error")
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        table = spark.createDataFrame([], ANSWER)
    both = single.unionByName(table).where("request_sha256 is not null")
    return both.groupBy("request_sha256").agg(F.max(F.struct("response", "error")).alias("a")).select("request_sha256", "a.response", "a.error")


def _asked(path: str, provider: Callable[[str], str | None], in_flight: int, again: bool) -> Callable[[Iterator[pd.DataFrame]], Iterator[pd.DataFrame]]:
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from pyarrow import fs

        files, root = fs.FileSystem.from_uri(path if "://" in path else f"file://{path}")

        def one(sha: str, text: str) -> None:
            place = f"{root}/single/{sha[:2]}/{sha}.json"
            if files.get_file_info(place).type == fs.FileType.File:  # a lost task's answer
                with files.open_input_stream(place) as kept:
                    if not again or json.loads(kept.read())["error"] is None:
                        return
            try:
                answer = {"request_sha256": sha, "response": provider(text), "error": None}
            except Exception as e:  # noqa: BLE001
                answer = {"request_sha256": sha, "response": None, "error": f"provider execution failed ({type(e).__name__})"}
            files.create_dir(f"{root}/single/{sha[:2]}", recursive=True)
            beside = f"{root}/single/{sha[:2]}/{sha}.{uuid.uuid4().hex}.tmp"
            with files.open_output_stream(beside) as out:
                out.write(json.dumps(answer).encode())
            files.move(beside, place)

        with ThreadPoolExecutor(in_flight) as pool:
            for frame in frames:
                done = list(pool.map(one, frame["request_sha256"], frame["text"]))
                yield pd.DataFrame({"n": [len(done)]})

    return run


def run_kept(requests: DataFrame, provider: Callable[[str], str | None], path: str, request: str = "request", in_flight: int = IN_FLIGHT, retry_errors: bool = False) -> DataFrame:
    """Adds response and error to requests as run_provider() does, but asks for each distinct request once, whatever dies.

    path is a folder that driver and executors share. Equal requests share one call. Rows with an
    error, or without a request, never reach the provider. An answer is kept the moment it comes: after
    a lost executor or a stopped job only calls that were under way are made again, at most in_flight
    for each of its tasks. Kept failures are answers too, unless retry_errors. Returned rows read the folder.
    """
    if in_flight < 1:
        raise ValueError("in_flight must be 1 or more")
    spark, path = requests.sparkSession, path.rstrip("/")
    sha = unused(requests, "request_sha256")[0]
    rows = requests.withColumn(sha, F.when(F.col("error").isNull(), F.sha2(request, 256)))
    have = kept_answers(spark, path)
    open_ = rows.where(F.col(sha).isNotNull()).groupBy(F.col(sha).alias("request_sha256")).agg(F.first(request).alias("text"))
    open_ = open_.join(have.where("error is null") if retry_errors else have, "request_sha256", "left_anti")
    open_ = open_.repartition(spark.sparkContext.defaultParallelism, "request_sha256")  # calls are slow, whatever their bytes
    open_.mapInPandas(_asked(path, provider, in_flight, retry_errors), "n long").agg(F.sum("n")).collect()
    answer, failed = unused(rows, "answer", "failed")
    made = kept_answers(spark, path).select(F.col("request_sha256").alias(sha), F.col("response").alias(answer), F.col("error").alias(failed))
    out = rows.join(made, sha, "left")
    kept = [c for c in requests.columns if c not in ("error", "response")]
    return out.select(*kept, F.coalesce("error", failed).alias("error"), F.col(answer).alias("response"))


def compact(spark: SparkSession, path: str) -> None:
    """Adds the single answers to the table, then removes their files; no run may be under way.

    A stop between the two leaves answers in both places, where they are read once.
    """
    path = path.rstrip("/")
    try:
        single = spark.read.schema(ANSWER).option("recursiveFileLookup", "true").option("pathGlobFilter", "*.json").json(f"{path}/single")
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return
    rows = single.where("request_sha256 is not null").withColumn("head", F.substring("request_sha256", 1, 2))
    rows.repartition("head").write.mode("append").partitionBy("head").parquet(f"{path}/table")
    discard(spark, f"{path}/single")
