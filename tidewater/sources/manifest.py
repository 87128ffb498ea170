"""Manifests: small files that say which folder holds a table now, and which steps of a
job are done (A4, A5, L3).

A table is replaced by writing its new rows to a folder of their own and then switching
one file, atomically: a reader sees the old table or the new one, and a load that fails
leaves the old one. Row counts are observed while the rows are written, so that nobody
scans a table to learn its size.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Mapping
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

CURRENT = "_current.json"
#: Earlier states of a table that stay for readers that have opened them.
KEPT_STATES = 1


def _fs(spark: SparkSession, path: str):
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop.getFileSystem(spark._jsc.hadoopConfiguration()), hadoop


def path_exists(spark: SparkSession, path: str) -> bool:
    fs, hadoop = _fs(spark, path)
    return fs.exists(hadoop)


def read_json(spark: SparkSession, path: str) -> dict | None:
    """A small JSON file, or None where there is none."""
    fs, hadoop = _fs(spark, path)
    if not fs.exists(hadoop):
        return None
    stream = fs.open(hadoop)
    try:
        return json.loads(spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
    finally:
        stream.close()


def replace_json(spark: SparkSession, path: str, value: dict) -> None:
    """Write a small JSON file under another name and move it over ``path`` in one step."""
    draft = f"{path}.{uuid.uuid4().hex[:8]}"
    fs, hadoop = _fs(spark, draft)
    stream = fs.create(hadoop)
    try:
        stream.write(bytearray(json.dumps(value, sort_keys=True).encode()))
    finally:
        stream.close()
    fs_package = spark._jvm.org.apache.hadoop.fs
    rename = getattr(fs_package, "Options$Rename")
    options = spark.sparkContext._gateway.new_array(rename, 1)
    options[0] = rename.OVERWRITE
    files = fs_package.FileContext.getFileContext(hadoop.toUri() if hadoop.toUri().getScheme() else fs.getUri(), spark._jsc.hadoopConfiguration())
    files.rename(fs.makeQualified(hadoop), fs.makeQualified(fs_package.Path(path)), options)


def replace_table(df: DataFrame, out: str, counts: Mapping[str, Column] | None = None) -> dict:
    """Replace the table at ``out`` by ``df`` without a gap; returns its manifest: the folder of
    its rows, their number ``rows``, and how many meet each of ``counts``' conditions."""
    spark = df.sparkSession
    before = read_json(spark, f"{out}/{CURRENT}")
    folder = f"data-{uuid.uuid4().hex[:12]}"
    seen = Observation(f"rows-{uuid.uuid4().hex[:8]}")
    observed = df.observe(seen, F.count(F.lit(1)).alias("rows"), *[F.count(F.when(c, 1)).alias(k) for k, c in (counts or {}).items()])
    observed.write.parquet(f"{out}/{folder}")
    earlier = ([before["folder"], *before["earlier"]] if before else [])
    state = {"folder": folder, "schema": df.schema.json(), "earlier": earlier[:KEPT_STATES], **seen.get}
    replace_json(spark, f"{out}/{CURRENT}", state)
    for old in earlier[KEPT_STATES:]:
        fs, path = _fs(spark, f"{out}/{old}")
        fs.delete(path, True)
    return state


def current_table(spark: SparkSession, out: str) -> DataFrame:
    """The table that the manifest at ``out`` names."""
    from pyspark.sql.types import StructType

    state = read_json(spark, f"{out}/{CURRENT}")
    if state is None:
        raise FileNotFoundError(f"no table at {out}")
    return spark.read.schema(StructType.fromJson(json.loads(state["schema"]))).parquet(f"{out}/{state['folder']}")


@dataclass
class Steps:
    """Steps of a job, each with a manifest of its input stamp and outputs: a step that was
    finished with the same stamp is skipped, by this run or another application."""

    spark: SparkSession
    folder: str
    stamp: str
    ran: list[str] = field(default_factory=list)

    def path_of(self, name: str) -> str:
        return f"{self.folder}/{name}.json"

    def done(self, name: str) -> dict | None:
        """The manifest of a finished step."""
        found = read_json(self.spark, self.path_of(name))
        if found is None or found["stamp"] != self.stamp or not all(path_exists(self.spark, p) for p in found["paths"].values()):
            return None
        return found

    def run(self, name: str, build: Callable[[], dict[str, str]], **note: str) -> dict[str, str]:
        """The paths that ``build`` has written, now or before. Its manifest comes last."""
        found = self.done(name)
        if found is None:
            found = {"stamp": self.stamp, "paths": build(), "note": {}}
            replace_json(self.spark, self.path_of(name), found)
            self.ran.append(name)
        return found["paths"]
