"""Tables whose live folders are named by a manifest: rewrites that are seen whole or not at all.

A version of the table is one small file, ``_manifest/<number>.json``, which maps each partition value to
the folder that holds it.  A writer stages new folders beside the old ones, then makes the next version by a
rename that fails if the file exists.  Until then readers see the version before; a writer that dies leaves
folders that nothing names.  Of two writers that start from one version, the second fails.  The manifest
also notes which micro-batch made it, so that a stream that is started again skips what it has applied.
Rows never pass through the driver; it holds one entry per partition.
"""
from __future__ import annotations

import json
import uuid
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql.types import StructType

PART = "_part"
NULL_PART = "__HIVE_DEFAULT_PARTITION__"


class ManifestTable:
    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")
        self._jvm = spark._jvm
        self._path = self._jvm.org.apache.hadoop.fs.Path
        self._conf = spark._jsc.hadoopConfiguration()
        self._fs = self._path(self.root).getFileSystem(self._conf)

    # ------------------------------------------------------------ versions

    def versions(self) -> list[int]:
        folder = self._path(f"{self.root}/_manifest")
        if not self._fs.exists(folder):
            return []
        names = [s.getPath().getName() for s in self._fs.listStatus(folder)]
        return sorted(int(n[:-5]) for n in names if n.endswith(".json") and n[:-5].isdigit())

    def manifest(self, version: int | None = None) -> dict | None:
        """The latest version (or the one given); None before the first commit."""
        found = self.versions()
        if not found:
            return None
        stream = self._fs.open(self._path(self._file(found[-1] if version is None else version)))
        try:
            return json.loads(self._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
        finally:
            stream.close()

    def _file(self, version: int) -> str:
        return f"{self.root}/_manifest/{version:012d}.json"

    def commit(self, base: dict | None, parts: dict[str, str], schema: StructType, batch: dict | None = None) -> dict:
        """Make the version that follows ``base``; raises if another writer has made it meanwhile."""
        entry = {"version": base["version"] + 1 if base else 1, "schema": schema.jsonValue(), "parts": parts,
                 "batch": batch or (base or {}).get("batch")}
        temporary = self._path(f"{self.root}/_manifest/.{uuid.uuid4().hex}")
        out = self._fs.create(temporary, False)
        out.write(bytearray(json.dumps(entry).encode()))
        out.close()
        kind = getattr(self._jvm.org.apache.hadoop.fs, "Options$Rename")
        options = self.spark._sc._gateway.new_array(kind, 1)
        options[0] = kind.NONE
        context = self._jvm.org.apache.hadoop.fs.FileContext.getFileContext(self._path(self.root).toUri(), self._conf)
        try:
            context.rename(temporary, self._path(self._file(entry["version"])), options)
        except Exception as e:
            self._fs.delete(temporary, False)
            if "FileAlreadyExists" in str(e):
                raise RuntimeError(f"{self.root}: another writer made version {entry['version']}") from e
            raise
        return entry

    def applied(self, source: str, number: int, base: dict | None = None) -> bool:
        """Whether micro-batch ``number`` of the stream with checkpoint ``source`` is in the table already."""
        last = (base if base is not None else self.manifest() or {}).get("batch")
        if last and last["source"] != source:
            raise ValueError(f"{self.root} was written by the stream of checkpoint {last['source']}, not {source}")
        return bool(last) and number <= last["number"]

    # ------------------------------------------------------------ rows

    def read(self, values: Iterable[str] | None = None, base: dict | None = None) -> DataFrame | None:
        """The rows of the latest version (or of ``base``), of all partitions or of some; None before the first commit."""
        base = base or self.manifest()
        if base is None:
            return None
        wanted = None if values is None else set(values)
        folders = [f"{self.root}/{f}" for v, f in sorted(base["parts"].items()) if wanted is None or v in wanted]
        schema = StructType.fromJson(base["schema"])
        return self.spark.read.schema(schema).parquet(*folders) if folders else self.spark.createDataFrame([], schema)

    def stage(self, df: DataFrame, part: Column) -> dict[str, str]:
        """Write df by partition value into a fresh folder; value → folder, seen by nobody yet."""
        name = f"data/{uuid.uuid4().hex}"
        df.withColumn(PART, part.cast("string")).write.partitionBy(PART).parquet(f"{self.root}/{name}")
        unescape = self._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.unescapePathName
        found = {}
        for s in self._fs.listStatus(self._path(f"{self.root}/{name}")):
            folder = s.getPath().getName()
            if folder.startswith(f"{PART}="):
                found[unescape(folder[len(PART) + 1:])] = f"{name}/{folder}"
        return found

    def replace(self, df: DataFrame, part: Column, touched: Iterable[str], base: dict | None, batch: dict | None = None) -> dict:
        """Partitions ``touched`` of version ``base`` give way to the rows of df; the others stay.

        df may read the table: nothing is overwritten.  New columns widen the schema."""
        gone = set(touched)
        parts = {v: f for v, f in (base or {"parts": {}})["parts"].items() if v not in gone}
        new = self.stage(df, part)
        clash = sorted(parts.keys() & new.keys())
        if clash:
            raise ValueError(f"rows of partitions that were not given as touched: {clash[:5]}")
        schema = df.schema
        if base:
            old = StructType.fromJson(base["schema"])
            schema = StructType([*old.fields, *[f for f in schema.fields if f.name not in old.names]])
        schema = StructType.fromJson(json.loads(schema.json()))
        for field in schema.fields:
            field.nullable = True
        return self.commit(base, parts | new, schema, batch)

    def vacuum(self, keep: int = 2) -> int:
        """Delete all but the last ``keep`` versions and the folders that none of these names.

        Not while a writer is at work: what it has staged is named by no version yet."""
        versions = self.versions()
        live = {f.split("/_part=")[0] for v in versions[-keep:] for f in self.manifest(v)["parts"].values()}
        held = {f for v in versions[-keep:] for f in self.manifest(v)["parts"].values()}
        gone = 0
        for v in versions[:-keep]:
            self._fs.delete(self._path(self._file(v)), False)
        root = self._path(f"{self.root}/data")
        for s in self._fs.listStatus(root) if self._fs.exists(root) else []:
            name = f"data/{s.getPath().getName()}"
            if name not in live:
                gone += self._fs.delete(s.getPath(), True)
                continue
            for inner in self._fs.listStatus(s.getPath()):
                own = inner.getPath().getName()
                if own.startswith(f"{PART}=") and f"{name}/{own}" not in held:
                    gone += self._fs.delete(inner.getPath(), True)
        return gone
