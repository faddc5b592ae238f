"""Files in and out: headlines as JSON lines, splits as CSV, reports and documents as JSON, feeds, registries, models."""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator
from datetime import UTC, datetime
from xml.etree import ElementTree

import pandas as pd
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkloom.functions.documents import parsed

HEADLINE = "title string, label string, source string, published string, link string, fetched_at string"
FEEDS = "language string, country string, feeds array<struct<label:string,url:string>>"
SOURCE = "struct<id:string,organization:string,organization_types:array<string>,source_type:string,official:boolean,enabled:boolean,domains:array<string>,entrypoints:array<string>,allowed_url_prefixes:array<string>,topics:array<string>>"
#: Bytes of a JSON document that is read whole.
DOCUMENT_BYTES = 2 << 20


def read_jsonl(spark: SparkSession, path: str, schema: str = HEADLINE) -> DataFrame:
    """JSON lines; empty lines are skipped, a line that isn't JSON fails the read."""
    return spark.read.schema(schema).option("mode", "FAILFAST").json(path)


def write_jsonl(df: DataFrame, path: str) -> None:
    """One object a line, nulls kept."""
    df.write.option("ignoreNullFields", "false").json(path)


def read_csv(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """CSV with a header; quoted fields may hold line ends and doubled quotes."""
    return spark.read.schema(schema).csv(path, header=True, multiLine=True, escape='"', mode="FAILFAST")


def write_csv(df: DataFrame, path: str) -> None:
    df.write.csv(path, header=True, escape='"')


def write_report(report: DataFrame, path: str) -> None:
    """A report of few rows as one file of JSON lines."""
    report.coalesce(1).write.option("ignoreNullFields", "false").json(path)


def read_document(spark: SparkSession, path: str, shape: str, limit: int = DOCUMENT_BYTES) -> DataFrame:
    """``path, text, document, error`` of whole JSON files: error tells why document is null.

    Files beyond limit are refused by their size, before they are read as text.
    """
    files = spark.read.format("binaryFile").load(path).select("path", "length", F.when(F.col("length") <= limit, F.col("content")).alias("content"))
    text = F.try_validate_utf8(F.col("content").cast("string"))
    rows = files.select("path", "length", text.alias("text")).withColumn("document", parsed(F.col("text"), shape))
    error = F.when(F.col("length") > limit, "input JSON exceeds the size limit").when(F.col("text").isNull(), "not UTF-8").when(F.try_parse_json("text").isNull(), "not valid JSON").when(F.col("document").isNull(), "not a JSON object")
    return rows.select("path", "text", "document", error.alias("error"))


def read_feeds(spark: SparkSession, path: str) -> DataFrame:
    """``label, url`` of each configured feed."""
    return spark.read.schema(FEEDS).json(path, multiLine=True).select(F.explode("feeds").alias("f")).select("f.label", "f.url")


def feed_items(body: bytes) -> list[tuple[str, str, str, str]]:
    """(title, source, published, link) of each RSS item, as they stand; raises ValueError if it isn't XML."""
    try:
        root = ElementTree.fromstring(body)
    except ElementTree.ParseError as e:
        raise ValueError("the feed is not XML") from e
    text = lambda item, tag: (item.findtext(tag) or "").strip()
    return [(text(i, "title"), text(i, "source") or "unknown", text(i, "pubDate"), text(i, "link")) for i in root.iter("item")]


def collect_feeds(feeds: DataFrame, get: Callable[[str], bytes], fetched_at: str | None = None) -> DataFrame:
    """Headlines of all feeds (``label, url``): titles stripped, empty ones dropped, one fetched_at for the run.

    get returns a feed's bytes or raises, which fails the run. Feeds are fetched by many tasks.
    """
    at = fetched_at or datetime.now(UTC).isoformat(timespec="seconds")
    names = [x.split()[0] for x in HEADLINE.split(", ")]

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for label, url in zip(frame["label"], frame["url"], strict=True):
                rows = [(title, label, source, published, link, at) for title, source, published, link in feed_items(get(url)) if title]
                yield pd.DataFrame(rows, columns=names).astype(object)

    return feeds.select("label", "url").repartition("url").mapInPandas(run, HEADLINE)


def read_registry(spark: SparkSession, path: str) -> tuple[DataFrame, str]:
    """The sources of a registry, a row each, and the text; raises RegistryError with all that is wrong."""
    from sparkloom.operators.registry import RegistryError, registry_errors, sources_of

    try:
        rows = read_document(spark, path, "struct<sources:array<struct<id:string>>>").select("text", "error").collect()
    except AnalysisException as e:
        raise RegistryError(f"could not load registry {path}") from e
    if len(rows) != 1 or rows[0]["error"]:
        raise RegistryError(f"could not load registry {path}: {rows[0]['error'] if rows else 'no file'}")
    text = rows[0]["text"]
    errors = [r["message"] for r in registry_errors(spark, text).orderBy("place", "rule_no").collect()]
    if errors:
        raise RegistryError("invalid source registry:\n- " + "\n- ".join(errors))
    return sources_of(spark, text), text


def save_models(models: dict[str, object], path: str) -> None:
    """Models by name in one folder: TextModel, and DataFrames (a majority class is one row)."""
    for name, model in models.items():
        if isinstance(model, DataFrame):
            model.coalesce(1).write.parquet(f"{path}/{name}/rows")
        else:
            model.save(f"{path}/{name}/text")


def load_models(spark: SparkSession, path: str, names: list[str]) -> dict[str, object]:
    """What save_models() wrote."""
    from sparkloom.operators.dataset import TextModel

    out: dict[str, object] = {}
    for name in names:
        try:
            out[name] = spark.read.parquet(f"{path}/{name}/rows")
        except AnalysisException:
            out[name] = TextModel.load(spark, f"{path}/{name}/text")
    return out


def as_json(value) -> str:
    """A report or document for a person: indented, letters as they are."""
    return json.dumps(value, ensure_ascii=False, indent=2)
