"""Local state as tables in one folder: ledgers, discovered candidates, and content-addressed objects.

Everything is append-only. Objects are rows of a path made of their bytes' hash and the bytes; what is
there is never written again, and every read is verified against the ledger that names it.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkloom.functions.documents import ARTIFACT_HEAD, first_broken, parsed
from sparkloom.functions.provenance import HEX64, is_safe_path, object_path
from sparkloom.tables import unused

#: The version of each table's schema, recorded when a state is made.
VERSIONS = {"discovery": 1, "ingestion": 1, "normalization": 1}
ARTIFACT_VERSION = 1
#: Places that are named one by one in a read of stored bodies; beyond, all are read.
NAMED = 1000
TABLES = {
    "meta": "key string, value int",
    "runs": "run_id long, source_id string, event string, at string, error string",
    "sightings": "run_id long, source_id string, entrypoint string, url string, at string",
    "ingestion": "id long, source_id string, requested_url string, final_url string, fetched_at string, status string, classification string, content_type string, bytes_read long, sha256 string, object_path string, error string",
    "normalization": "id long, source_id string, requested_url string, ingestion_observation_id long, raw_sha256 string, extractor_name string, extractor_version string, normalized_at string, status string, classification string, normalized_sha256 string, artifact_path string, title string, block_count long, char_count long, error string",
    "objects": "path string, body binary",
    "artifacts": "path string, body binary",
}


class StateError(RuntimeError):
    """The state is missing, of another version, or would be contradicted."""


class State:
    """The tables of one folder. A table that has no rows yet is empty."""

    def __init__(self, spark: SparkSession, path: str, must_exist: bool = False):
        self.spark, self.path = spark, path.rstrip("/")
        found = {r["key"]: r["value"] for r in self.read("meta").collect()}
        if not found and must_exist:
            raise StateError(f"no local state at {path}")
        if found and found != VERSIONS:
            raise StateError(f"the state at {path} has versions {found}, not {VERSIONS}")
        if not found:
            self.append("meta", spark.createDataFrame(list(VERSIONS.items()), TABLES["meta"]))

    def read(self, name: str) -> DataFrame:
        try:
            return self.spark.read.schema(TABLES[name]).parquet(f"{self.path}/{name}")
        except AnalysisException as e:
            if e.getCondition() != "PATH_NOT_FOUND":
                raise
            return self.spark.createDataFrame([], TABLES[name])

    def append(self, name: str, rows: DataFrame) -> None:
        columns = [x.split()[0] for x in TABLES[name].split(", ")]
        rows.select(*columns).write.mode("append").parquet(f"{self.path}/{name}")

    def next_id(self, name: str, column: str = "id") -> int:
        """One more than the largest id; one writer appends at a time."""
        return (self.read(name).agg(F.max(column)).first()[0] or 0) + 1

    def require(self, *names: str) -> None:
        """Raises StateError if a table has no rows yet."""
        for name in names:
            if self.read(name).isEmpty():
                raise StateError(f"the state has no {name} rows; run that stage before")


def addressed(bodies: DataFrame, body: str = "body", root: str = "objects", suffix: str = "") -> DataFrame:
    """``path, body`` of exact bytes, each once."""
    return bodies.where(F.col(body).isNotNull()).select(object_path(F.sha2(F.col(body), 256), root, suffix).alias("path"), F.col(body).cast("binary").alias("body")).dropDuplicates(["path"])


def store_conflicts(existing: DataFrame, new: DataFrame) -> DataFrame:
    """``path``: places that hold other bytes than those to be stored, or whose name isn't their bytes' hash."""
    wrong = new.where(F.coalesce(F.regexp_extract("path", "([0-9a-f]{64})(\\.json)?$", 1) != F.sha2("body", 256), F.lit(True))).select("path")
    other = new.alias("n").join(existing.alias("e"), "path").where(F.col("n.body") != F.col("e.body")).select("path")
    return wrong.unionAll(other).distinct()


def held_paths(existing: DataFrame, new: DataFrame) -> DataFrame:
    """``path``: places of new objects that hold something already, from the paths alone."""
    return existing.select("path").join(new.select("path"), "path", "left_semi").distinct()


def store_exact(state: State, name: str, new: DataFrame) -> None:
    """Add objects that aren't there; raises StateError, and stores nothing, if a place holds other bytes.

    Stored bodies are read only of places that new objects name. Objects are stored in the order of
    paths, so that of the others no row group is read where few places are named.
    """
    existing = state.read(name)
    there = [r["path"] for r in held_paths(existing, new).limit(NAMED + 1).collect()]
    held = existing.limit(0)
    if there:
        held = existing.where(F.col("path").isin(there)) if len(there) <= NAMED else existing
    bad = store_conflicts(held, new).orderBy("path").limit(1).collect()
    if bad:
        raise StateError(f"other bytes are at {bad[0]['path']}")
    fresh = new.join(existing.select("path"), "path", "left_anti")
    state.append(name, fresh.repartitionByRange("path").sortWithinPartitions("path"))


def _verified(rows: DataFrame, objects: DataFrame, path: str, sha: str, more: list[tuple[str, Column]], made: dict[str, Column] | None = None) -> DataFrame:
    """made: columns of the joined rows that more names, each made once a row however many rules name it."""
    held = objects.select(F.col("path").alias("held_path"), F.col("body"))
    joined = rows.join(held, F.col(path) == F.col("held_path"), "left").withColumns(made or {})
    rules = [
        ("path escapes the state folder", is_safe_path(F.col(path))),
        ("recorded hash is not a SHA-256", F.col(sha).rlike(HEX64)),
        ("object is missing", F.col("held_path").isNotNull()),
        ("SHA-256 mismatch", F.sha2("body", 256) == F.col(sha)),
        *more,
    ]
    return joined.withColumn("error", first_broken(rules)).drop("held_path")


def verified_objects(ingestions: DataFrame, objects: DataFrame) -> DataFrame:
    """Successful ingestions with their body, and error: null if the bytes are exactly those recorded.

    Rows of an object that isn't there, or not as recorded, stay, with the reason; they have no
    replacement. Null fields break the rule that needs them.
    """
    rows = ingestions.where("status = 'success'").drop("error")
    return _verified(rows, objects, "object_path", "sha256", [("byte count mismatch", F.octet_length("body") == F.col("bytes_read"))])


def verified_artifacts(normalizations: DataFrame, artifacts: DataFrame) -> DataFrame:
    """Successful normalizations with blocks, and error: null if the artifact is whole and is the one recorded."""
    rows = normalizations.where("status = 'success'").drop("error")
    (name,) = unused(rows, "head")
    head = F.col(name)
    rules = [
        ("artifact is not a JSON object", head.isNotNull()),
        ("unsupported artifact schema version", head["schema_version"] == ARTIFACT_VERSION),
        ("extractor does not match the ledger", (head["extractor"]["name"] == F.col("extractor_name")) & (head["extractor"]["version"] == F.col("extractor_version"))),
        ("artifact has no citation blocks", F.size(head["blocks"]) > 0),
        ("block count mismatch", F.size(head["blocks"]) == F.col("block_count")),
    ]
    out = _verified(rows, artifacts, "artifact_path", "normalized_sha256", rules, {name: parsed(F.try_validate_utf8(F.col("body").cast("string")), ARTIFACT_HEAD)})
    return out.withColumn("blocks", F.when(F.col("error").isNull(), head["blocks"])).drop("body", name)
