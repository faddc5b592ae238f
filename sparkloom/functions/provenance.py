"""Identifiers, content addresses and canonical JSON as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from sparkloom.functions.arrays import let

HEX64 = "^[0-9a-f]{64}$"


def sha256(c: Column) -> Column:
    return F.sha2(c, 256)


def canonical_json(**fields: Column) -> Column:
    """One JSON object with sorted keys, nulls kept and no spaces. Nested structs must be sorted too."""
    return F.to_json(F.struct(*[fields[k].alias(k) for k in sorted(fields)]), {"ignoreNullFields": "false"})


def derived_id(prefix: str, document: Column) -> Column:
    """ev-, eb-, cc- and er- ids: the first 20 digits of a document's hash."""
    return F.concat(F.lit(f"{prefix}-"), F.substring(sha256(document), 1, 20))


def block_ref(ordinal: Column, text: Column) -> Column:
    """Where a block stands and what it says."""
    return F.concat(F.lit("b"), F.format_string("%04d", ordinal), F.lit("-"), F.substring(sha256(text), 1, 12))


def object_path(sha: Column, root: str = "objects", suffix: str = "") -> Column:
    """Where exact bytes are kept; null unless sha is 64 lower-case hex digits."""
    path = F.concat(F.lit(f"{root}/sha256/"), F.substring(sha, 1, 2), F.lit("/"), sha, F.lit(suffix))
    return F.when(sha.rlike(HEX64), path)


def is_safe_path(path: Column) -> Column:
    """Relative, and none of its steps leads above the folder it starts in."""
    steps = F.filter(F.split(path, "/"), lambda s: (s != "") & (s != "."))
    depth = F.aggregate(steps, F.struct(F.lit(0).alias("at"), F.lit(0).alias("least")), lambda acc, s: let(acc["at"] + F.when(s == "..", -1).otherwise(1), lambda n: F.struct(n.alias("at"), F.least(acc["least"], n).alias("least"))), lambda acc: acc["least"])
    return ~path.startswith("/") & (path != "") & (depth >= 0)
