"""Versioned Parquet tables and the load manifest (SRC-5..SRC-8, SRC-14..SRC-22).

A table (or one source's part of it) is a folder per version. A publish first writes all
new folders and then appends one small Parquet file to the commit table, which Spark makes
visible in one step: readers see all tables of a publish or none, and nothing is ever
overwritten in place while another job reads it. A failed or retried publish leaves only an
unreferenced folder behind.
"""

from __future__ import annotations

import time
import uuid
from collections.abc import Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from datetime import datetime, timezone

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fieldgap.operators.dedup import latest_per_key
from fieldgap.operators.incremental import keyed_replace

WRITERS = 4
BUILD_SCHEMA = "fingerprint string, tested boolean, built_at timestamp"
COMMIT_SCHEMA = "seq bigint, table_name string, part string, path string, committed_at timestamp"
MANIFEST_SCHEMA = (
    "batch_id string, source string, url string, etag string, last_modified string, "
    "sha256 string, rows_loaded bigint, columns_seen int, columns_expected int, "
    "status string, loaded_at timestamp"
)


def utc_now() -> datetime:
    """Knows its zone, so that the driver's own zone does not shift it."""
    return datetime.now(timezone.utc)


class Warehouse:
    """Tables named '<layer>.<table>' below one shared root folder."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")

    # -- commits -----------------------------------------------------------------
    def _read_or_none(self, path: str, schema: str | None = None) -> DataFrame | None:
        try:
            reader = self.spark.read if schema is None else self.spark.read.schema(schema)
            return reader.parquet(path)
        except AnalysisException as err:
            if err.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
                return None
            raise

    def _current(self) -> list:
        """Newest committed path per table and part; as many rows as there are parts."""
        commits = self._read_or_none(f"{self.root}/meta/commits", COMMIT_SCHEMA)
        if commits is None:
            return []
        # Two publishers may have taken the same number; every reader settles on the same path.
        newest = commits.groupBy("table_name", "part").agg(
            F.max_by("path", F.struct("seq", "committed_at", "path")).alias("path"), F.max("seq").alias("seq")
        )
        return newest.collect()

    def exists(self, table: str) -> bool:
        return any(row.table_name == table and row.path for row in self._current())

    def tables(self) -> list[str]:
        return sorted({row.table_name for row in self._current() if row.path})

    def read(self, table: str) -> DataFrame:
        """The current version; the parts of a multi-source table are one scan."""
        paths = sorted(r.path for r in self._current() if r.table_name == table and r.path)
        if not paths:
            raise KeyError(f"no such table: {table}")
        return self.spark.read.option("mergeSchema", len(paths) > 1).parquet(*paths)

    def read_or_none(self, table: str) -> DataFrame | None:
        try:
            return self.read(table)
        except KeyError:
            return None

    def write_versions(
        self, tables: dict[str, DataFrame], part: str = "", outcomes: dict[str, tuple[str, float, str]] | None = None
    ) -> dict[str, str]:
        """Write all frames as new versions that nobody reads yet; returns their paths.

        `outcomes` takes (status, seconds, message) of each table, of a failed one too.
        """
        seq = max((row.seq for row in self._current()), default=0) + 1
        version = f"v{seq:08d}-{uuid.uuid4().hex[:8]}"
        paths = {}
        for table in tables:
            layer, name = table.split(".", 1)
            folder = f"source={part}/" if part else ""
            paths[table] = f"{self.root}/{layer}/{name}/{folder}{version}"

        def write(table: str) -> None:
            begun, status, message = time.monotonic(), "success", ""
            try:
                tables[table].write.mode("errorifexists").parquet(paths[table])
            except Exception as err:
                status, message = "error", str(err)
                raise
            finally:
                if outcomes is not None:
                    outcomes[table] = (status, round(time.monotonic() - begun, 3), message)

        # Independent jobs share the cluster; a commit waits for all of them.
        with ThreadPoolExecutor(max_workers=WRITERS) as pool:
            list(pool.map(write, tables))
        return paths

    def commit(self, paths: Mapping[str, str], part: str | Mapping[str, str] = "") -> None:
        """Make written versions current together; `part` may name the part table by table."""
        parts = {table: part if isinstance(part, str) else part.get(table, "") for table in paths}
        seq = max((row.seq for row in self._current()), default=0) + 1
        now = utc_now()
        rows = [(seq, table, parts[table], path, now) for table, path in paths.items()]
        commit = self.spark.createDataFrame(rows, COMMIT_SCHEMA).coalesce(1)
        commit.write.mode("append").parquet(f"{self.root}/meta/commits")

    def publish(self, tables: dict[str, DataFrame], part: str = "") -> dict[str, DataFrame]:
        """Write all frames as new versions and make them current together.

        Returns readers of exactly the versions that were written.
        """
        paths = self.write_versions(tables, part)
        self.commit(paths, part)
        return {table: self.spark.read.parquet(path) for table, path in paths.items()}

    def versions(self, layer: str) -> list[tuple[str, str, str]]:
        """(table, part, path) of every current version of a layer."""
        return sorted((r.table_name, r.part, r.path) for r in self._current() if r.table_name.startswith(f"{layer}.") and r.path)

    # -- builds --------------------------------------------------------------------
    def record_build(self, fingerprint: str, tested: bool) -> None:
        """Remember what the current models were built from and whether they passed the data tests."""
        row = self.spark.createDataFrame([(fingerprint, tested, utc_now())], BUILD_SCHEMA)
        self.append("meta.builds", row.coalesce(1))

    def is_built(self, fingerprint: str, tested: bool) -> bool:
        """Whether the last build is of this fingerprint, and passed its tests if that is asked for."""
        builds = self._read_or_none(f"{self.root}/meta/builds", BUILD_SCHEMA)
        if builds is None:
            return False
        last = builds.agg(F.max_by(F.struct("fingerprint", "tested"), "built_at").alias("b")).select("b.*").first()
        return last.fingerprint == fingerprint and (bool(last.tested) or not tested)

    def replace(self, table: str, df: DataFrame) -> DataFrame:
        """Full replacement of one table."""
        return self.publish({table: df})[table]

    def replace_source(self, table: str, source: str, df: DataFrame) -> DataFrame:
        """Replace one source's rows; an empty delivery empties that source."""
        return self.publish({table: df}, part=source)[table]

    def insert_by_name(self, table: str, df: DataFrame) -> DataFrame:
        """Add rows as a further part, matched to the table's columns by name.

        Columns the rows lack are NULL; a column that the table lacks is an error.
        """
        target = self.read(table).schema
        unknown = [c for c in df.columns if c not in target.names]
        if unknown:
            raise ValueError(f"{table} has no column {', '.join(unknown)}")
        aligned = [(F.col(f"`{f.name}`") if f.name in df.columns else F.lit(None)).cast(f.dataType).alias(f.name) for f in target]
        return self.publish({table: df.select(*aligned)}, part=uuid.uuid4().hex[:12])[table]

    def materialize(self, table: str, df: DataFrame, mode: str, keys: Sequence[str] = ()) -> DataFrame:
        """Keep a model as a view, as a table that is replaced, or as one that keyed rows are put into."""
        if mode == "view":
            df.createOrReplaceTempView(table.split(".", 1)[1])
            return df
        if mode == "incremental":
            if not keys:
                raise ValueError("incremental tables need keys")
            old = self.read_or_none(table)
            return self.replace(table, df if old is None else keyed_replace(old, df, keys))
        if mode == "table":
            return self.replace(table, df)
        raise ValueError(f"unknown mode: {mode}")

    # -- append-only tables --------------------------------------------------------
    def append(self, table: str, df: DataFrame) -> None:
        layer, name = table.split(".", 1)
        df.write.mode("append").parquet(f"{self.root}/{layer}/{name}")

    def log(self, table: str, schema: str | None = None) -> DataFrame | None:
        """An append-only table; with a schema, rows written before a column was added have NULL there."""
        layer, name = table.split(".", 1)
        return self._read_or_none(f"{self.root}/{layer}/{name}", schema)

    # -- load manifest -------------------------------------------------------------
    def record_loads(self, rows: Sequence[tuple]) -> None:
        self.append("meta.ingest_manifest", self.spark.createDataFrame(list(rows), MANIFEST_SCHEMA).coalesce(1))

    def latest_loads(self) -> DataFrame | None:
        """Newest 'loaded' manifest row per source."""
        manifest = self._read_or_none(f"{self.root}/meta/ingest_manifest", MANIFEST_SCHEMA)
        if manifest is None:
            return None
        return latest_manifest_rows(manifest)

    # -- views ---------------------------------------------------------------------
    def register_views(self, tables: Sequence[str] | None = None) -> None:
        """Expose current versions to SQL as views named after the table."""
        for table in tables or self.tables():
            self.read(table).createOrReplaceTempView(table.split(".", 1)[1])


def latest_manifest_rows(manifest: DataFrame) -> DataFrame:
    """Newest 'loaded' row per source (SRC-7)."""
    order = [F.desc("loaded_at"), F.desc("batch_id")]
    return latest_per_key(manifest.filter("status = 'loaded'"), ["source"], order)


def sources_to_reload(latest: DataFrame, bronze: DataFrame) -> DataFrame:
    """Sources the manifest calls loaded but whose rows are gone (SRC-8)."""
    return latest.join(bronze.select(F.col("_source").alias("source")).distinct(), "source", "left_anti")
