"""Schema-evolving append under a versioned contract kept beside the table.

The contract, an Avro-style field list, lies in ``<table>_contract/version=N``.  An
append may bring new columns: they become nullable fields of the next version.
Nothing else may change, so that files of all versions can be read under any
version: a reader of an old contract doesn't see the new fields, a reader of a new
one gets NULL for them in old files.  Narrower numbers are cast to the contract's
type; a missing required field, a field of another type, or a value that the
cast would lose fails the append before anything is written.
"""

from __future__ import annotations

import json
from collections.abc import Sequence
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from ledgerline.operators.contract import LOGICAL, LOSSY_WIDENINGS, PRIMITIVES, SchemaCompatibilityError, align_schema, is_widening, normalize_type
from ledgerline.runtime import file_system, path_exists
from ledgerline.sinks.writers import write_partitioned

Field = dict[str, Any]
_TO_AVRO = {spark: avro for avro, spark in PRIMITIVES.items()} | {spark: {"type": "int" if spark == "date" else "long", "logicalType": avro}
                                                                 for avro, spark in LOGICAL.items() if "millis" not in avro}


def contract_path(path: str) -> str:
    return path.rstrip("/") + "_contract"


def avro_type(kind: T.DataType) -> Any:
    """Avro form of a column's type, nullable."""
    if isinstance(kind, T.DecimalType):
        return ["null", {"type": "bytes", "logicalType": "decimal", "precision": kind.precision, "scale": kind.scale}]
    if kind.simpleString() not in _TO_AVRO:
        raise SchemaCompatibilityError(f"no contract type for {kind.simpleString()}")
    return ["null", _TO_AVRO[kind.simpleString()]]


def spark_schema(fields: Sequence[Field]) -> T.StructType:
    return T.StructType([T.StructField(f["name"], T._parse_datatype_string(normalize_type(f["type"]))) for f in fields])


def versions(spark: SparkSession, path: str) -> list[int]:
    if not path_exists(spark, contract_path(path)):
        return []
    fs, root = file_system(spark, contract_path(path))
    names = [s.getPath().getName() for s in fs.listStatus(root)]
    return sorted(int(n.removeprefix("version=")) for n in names
                  if n.startswith("version=") and path_exists(spark, f"{contract_path(path)}/{n}/_SUCCESS"))


def read_contract(spark: SparkSession, path: str, version: int | None = None) -> list[Field]:
    """The fields of a version; of the latest by default; none before the first append."""
    known = versions(spark, path)
    if not known:
        return []
    return [json.loads(r["value"]) for r in spark.read.text(f"{contract_path(path)}/version={version or known[-1]}").collect()]  # a line a field, one file


def _write_contract(spark: SparkSession, path: str, version: int, fields: Sequence[Field]) -> None:
    lines = spark.createDataFrame([(json.dumps(f),) for f in fields], "value string")
    lines.coalesce(1).write.mode("overwrite").text(f"{contract_path(path)}/version={version}")


def check_change(old: Sequence[Field], new: Sequence[Field]) -> list[str]:
    """What keeps ``new`` from following ``old``; empty if any reader of one can read the files of the other."""
    was, now = ({f["name"]: f for f in fields} for fields in (old, new))
    found = [f"{name} is gone" for name in was if name not in now]
    found += [f"{name} changes from {normalize_type(was[name]['type'])} to {normalize_type(now[name]['type'])}"
              for name in was if name in now and normalize_type(was[name]["type"]) != normalize_type(now[name]["type"])]
    return found + [f"{name} is new and not nullable" for name, f in now.items() if name not in was and not isinstance(f["type"], list)]


def _misfits(df: DataFrame, fields: Sequence[Field], required: Sequence[str]) -> list[str]:
    have = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    out = [f"{name} is missing" for name in required if name not in have]
    for f in fields:
        want, got = normalize_type(f["type"]), have.get(f["name"])
        # a narrower number may be cast up, if no value is lost
        if got is not None and got != want and (not is_widening(got, want) or (got, want) in LOSSY_WIDENINGS):
            out.append(f"{f['name']} is {got}, not {want}")
    return out


def append(spark: SparkSession, df: DataFrame, path: str, fields: Sequence[Field], required: Sequence[str] = (), by: Sequence[str] = ()) -> int:
    """Append ``df``; ``fields`` is the contract of the first version.  Returns the version written under.

    The next version is stored before the rows: a crash between the two leaves
    a field without rows, which every reader can read.
    """
    known = versions(spark, path)
    current = read_contract(spark, path) or list(fields)
    names = {f["name"] for f in current}
    wanted = [*current, *({"name": f.name, "type": avro_type(f.dataType)} for f in df.schema.fields if f.name not in names)]
    found = check_change(current, wanted) + _misfits(df, wanted, required)
    if found:
        raise SchemaCompatibilityError("; ".join(found))
    version = known[-1] if known else 0
    if not known or len(wanted) > len(current):
        version += 1
        _write_contract(spark, path, version, wanted)
    write_partitioned(align_schema(df, spark_schema(wanted)), path, by)
    return version


def read(spark: SparkSession, path: str, version: int | None = None) -> DataFrame:
    """The table under a version of its contract, whatever versions its files were written under."""
    return spark.read.schema(spark_schema(read_contract(spark, path, version))).parquet(path)
