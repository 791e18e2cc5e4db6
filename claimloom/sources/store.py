"""Warehouse tables as Parquet folders, published together by one manifest per run.

A run writes only new folders. Facts grow by appending a folder, so a load never rewrites the
rows already stored; dimensions and the audit log are replaced. Readers follow the newest
manifest, which is written last: a run that dies half way changes nothing anybody can see.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession

from claimloom import schemas
from claimloom.session import CODEC, files_under

_MANIFEST = "version bigint, table_name string, folder string"


class TableStore:
    """Published tables under ``root``, which must be a folder all executors share."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")

    def manifest(self) -> tuple[int, dict[str, list[str]]]:
        """Newest version and its folders per table; version 0 is the empty warehouse.

        Manifests are named by their version; only the newest finished one is read.
        """
        finished = [path.split("/")[-2] for path in files_under(self.spark, f"{self.root}/manifests/*/_SUCCESS")]
        if not finished:
            return 0, {}
        newest = max(finished)
        folders: dict[str, list[str]] = {}
        for row in self.spark.read.schema(_MANIFEST).json(f"{self.root}/manifests/{newest}").sort("folder").collect():
            folders.setdefault(row.table_name, []).append(row.folder)
        return int(newest), folders

    def read(self, table: str) -> DataFrame:
        return self._open(table, self.manifest()[1])

    def read_all(self) -> dict[str, DataFrame]:
        """Every warehouse and audit table of one version."""
        _, folders = self.manifest()
        return {name: self._open(name, folders) for name in (*schemas.WAREHOUSE, *schemas.AUDIT)}

    def _open(self, table: str, folders: dict[str, list[str]]) -> DataFrame:
        if not folders.get(table):
            return schemas.empty(self.spark, table)
        paths = [f"{self.root}/{folder}" for folder in folders[table]]
        return self.spark.read.schema(schemas.struct(table)).parquet(*paths)

    def begin(self, reset: bool = False) -> Run:
        """Start a run on the published state, or on the empty warehouse."""
        version, folders = self.manifest()
        return Run(self, version + 1, {} if reset else {k: list(v) for k, v in folders.items()})


@dataclass
class Run:
    store: TableStore
    version: int
    folders: dict[str, list[str]]
    name: str = field(default_factory=lambda: f"run-{uuid4().hex[:12]}")
    written: dict[str, int] = field(default_factory=dict)

    @property
    def folder(self) -> str:
        return f"{self.store.root}/runs/{self.name}"

    def read(self, table: str) -> DataFrame:
        """The table as this run sees it: published folders plus its own."""
        return self.store._open(table, self.folders)

    def replace(self, table: str, df: DataFrame) -> DataFrame:
        self.folders[table] = [self._write(table, df)]
        return self.read(table)

    def append(self, table: str, df: DataFrame) -> DataFrame:
        self.folders.setdefault(table, []).append(self._write(table, df))
        return self.read(table)

    def _write(self, table: str, df: DataFrame) -> str:
        self.written[table] = self.written.get(table, 0) + 1
        relative = f"runs/{self.name}/{table}-{self.written[table]}"
        schemas.conform(df, table).write.parquet(f"{self.store.root}/{relative}", compression=CODEC)
        return relative

    def publish(self) -> int:
        """Make every table of this run visible at once."""
        rows = [(self.version, table, folder) for table, all_ in self.folders.items() for folder in all_]
        entries = self.store.spark.createDataFrame(rows, _MANIFEST).coalesce(1)
        entries.write.json(f"{self.store.root}/manifests/{self.version:012d}")
        return self.version
