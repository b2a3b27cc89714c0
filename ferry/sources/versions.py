"""Tables of Parquet files with atomic versions.

A table is a folder with data folders and a list of its versions:

    data-<id>/part-*.parquet       the files of one write; never changed
    _versions/00000007.json        the data folders (and of touched ones the files still in use) of version 7

A change writes its files first and then becomes visible by one rename, which fails
if another writer has made that version: readers see the old rows or the new
ones, a job that dies leaves the old ones, and of two writers who started from
one version the second is refused. Appends do not conflict and are tried again on
the newer version. An append may carry a batch id; a batch that a version
already holds is not added twice, so a broken load can simply be run again.

Updates and deletes first look up which files have rows that qualify (a scan of
the columns in the condition) and write only those anew; the others stay as
they are. Nothing about the rows passes through the driver: it sees names of folders and of touched files.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from py4j.protocol import Py4JJavaError

from ferry.sources.delimited import _hadoop_fs, _read_small, file_names, write_once

FOLDER = "_versions"
TRIES = 20


class Conflict(RuntimeError):
    """Another writer has changed the table since it was read."""


class VersionedTable:
    """One table; ``expect`` of the changing calls names the version the caller has read (default: the newest)."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    # -- reading -------------------------------------------------------------

    def version(self) -> int:
        """The newest version, 0 before the first."""
        names = [n for n in file_names(self.spark, f"{self.path}/{FOLDER}") if n.endswith(".json") and n[0].isdigit()]
        return int(names[-1][:-5]) if names else 0

    def entry(self, version: int | None = None) -> dict:
        version = self.version() if version is None else version
        if version == 0:
            return {"version": 0, "parts": [], "schema": None, "rows": 0}
        return _read_small(self.spark, f"{self.path}/{FOLDER}/{version:08d}.json")

    def read(self, version: int | None = None) -> DataFrame:
        """The rows of a version (default: the newest); later changes do not alter what is read."""
        return self._frame(self.entry(version))

    def history(self) -> DataFrame:
        """``(version, operation, rows, files_written, batch)``, oldest first."""
        kind = "version long, operation string, rows long, files_written long, batch string"
        if not self.version():
            return self.spark.createDataFrame([], kind)
        return self.spark.read.schema(kind).json(f"{self.path}/{FOLDER}/[0-9]*.json").orderBy("version")

    def _frame(self, entry: dict) -> DataFrame:
        if entry["schema"] is None:
            raise FileNotFoundError(f"{self.path} has no version yet")
        schema = T.StructType.fromJson(entry["schema"])
        paths = [f"{self.path}/{p['folder']}" + (f"/{name}" if name else "")
                 for p in entry["parts"] for name in (p["files"] if p["files"] is not None else [""])]
        if not paths:
            return self.spark.createDataFrame([], schema)
        try:
            return self.spark.read.schema(schema).parquet(*paths)
        except AnalysisException as missing:
            raise FileNotFoundError(f"{self.path}: files of version {entry['version']} have been removed") from missing

    # -- changes -------------------------------------------------------------

    def replace(self, df: DataFrame, expect: int | None = None) -> int:
        """CREATE OR REPLACE: ``df`` becomes the whole table."""
        base = self.entry(expect)
        part, rows, n = self._write(df)
        return self._commit(base, {"parts": [part], "schema": df.schema.jsonValue(), "rows": rows, "operation": "replace",
                                   "files_written": n}, [part["folder"]])

    def append(self, df: DataFrame, batch: str | None = None) -> int:
        """Add rows (columns by name); a ``batch`` that the table already holds is not added again."""
        base = self.entry()
        if batch is not None and self.holds(batch):
            return base["version"]
        if base["schema"] is not None:
            schema = T.StructType.fromJson(base["schema"])
            have = {c.lower(): c for c in df.columns}
            if unknown := sorted(set(have) - {f.name.lower() for f in schema.fields}):
                raise ValueError(f"the table has no column {', '.join(unknown)}")
            df = df.select(*[(df[f"`{have[f.name.lower()]}`"] if f.name.lower() in have else F.lit(None))
                             .cast(f.dataType).alias(f.name) for f in schema.fields])
        part, rows, n = self._write(df)
        for _ in range(TRIES):
            try:
                return self._commit(base, {"parts": base["parts"] + [part], "schema": base["schema"] or df.schema.jsonValue(),
                                           "rows": base["rows"] + rows, "operation": "append", "files_written": n,
                                           "batch": batch}, [])
            except Conflict:
                base = self.entry()  # an append stands beside any other change
                if batch is not None and self.holds(batch):
                    break
        self._drop(part["folder"])
        if batch is not None and self.holds(batch):
            return self.version()
        raise Conflict(f"{self.path}: no version could be made in {TRIES} tries")

    def holds(self, batch: str) -> bool:
        """Has this batch been appended?"""
        return not self.history().where(F.col("batch") == batch).isEmpty()

    def update(self, where: Column | None, expect: int | None = None, **assignments: Column | object) -> int:
        """UPDATE ... SET ... WHERE: only files with qualifying rows are written anew."""
        from ferry.operators.relational import update_set
        return self._rewrite("update", where, lambda rows: update_set(rows, where, **assignments), expect)

    def delete(self, where: Column, expect: int | None = None) -> int:
        """DELETE WHERE: only files with qualifying rows are written anew."""
        from ferry.operators.relational import delete_where
        return self._rewrite("delete", where, lambda rows: delete_where(rows, where), expect)

    def merge_insert(self, source: DataFrame, keys: Sequence[str], expect: int | None = None) -> int:
        """MERGE, insert only: source rows whose key the table lacks; stored files are not written anew."""
        from ferry.functions.text import quoted
        from ferry.operators.skew import skew_join
        base = self.entry(expect)
        stored = self._frame(base)
        new = skew_join(source, stored.select(*[F.col(quoted(k)) for k in keys]), list(keys), "left_anti")
        part, rows, n = self._write(new.select(*[F.col(quoted(c)) for c in stored.columns]))
        return self._commit(base, {"parts": base["parts"] + [part], "schema": base["schema"], "rows": base["rows"] + rows,
                                   "operation": "merge", "files_written": n}, [part["folder"]])

    def _rewrite(self, operation: str, where: Column | None, change, expect: int | None) -> int:
        base = self.entry(expect)
        stored = self._frame(base)
        hits = stored if where is None else stored.where(F.coalesce(where, F.lit(False)))
        touched = {tuple(r[0].split("/")[-2:]) for r in hits.select(F.col("_metadata.file_path")).distinct().collect()}
        if not touched:
            return base["version"]
        parts = []
        for p in base["parts"]:
            files = p["files"]
            if any(folder == p["folder"] for folder, _ in touched):
                names = files if files is not None else [n for n in file_names(self.spark, f"{self.path}/{p['folder']}")
                                                         if not n.startswith(("_", "."))]
                files = [n for n in names if (p["folder"], n) not in touched]
            if files != []:
                parts.append({"folder": p["folder"], "files": files})
        old = self.spark.read.schema(stored.schema).parquet(*[f"{self.path}/{folder}/{name}" for folder, name in sorted(touched)])
        part, rows, n = self._write(change(old).coalesce(len(touched)))  # a file for each that was read, or fewer
        gone = old.count() - rows  # from the files' footers
        return self._commit(base, {"parts": parts + ([part] if rows else []), "schema": base["schema"], "rows": base["rows"] - gone,
                                   "operation": operation, "files_written": n}, [part["folder"]])

    # -- files ---------------------------------------------------------------

    def _write(self, df: DataFrame) -> tuple[dict, int, int]:
        """Write a data folder; its entry, rows and number of files."""
        folder = f"data-{uuid.uuid4().hex}"
        seen = Observation(f"ferry_version_{uuid.uuid4().hex}")
        try:
            df.observe(seen, F.count(F.lit(1)).alias("rows")).write.parquet(f"{self.path}/{folder}")
        except BaseException:
            self._drop(folder)
            raise
        n = sum(x.startswith("part-") for x in file_names(self.spark, f"{self.path}/{folder}"))
        try:
            rows = int(seen.get.get("rows", 0) or 0)
        except Py4JJavaError:  # a plan that is known to be empty is not observed
            rows = self.spark.read.schema(df.schema).parquet(f"{self.path}/{folder}").count()
        return {"folder": folder, "files": None}, rows, n

    def _commit(self, base: dict, entry: dict, made: list[str]) -> int:
        """Publish the version after ``base`` by a rename that never overwrites; ``made`` goes if it is refused."""
        version = base["version"] + 1
        target = f"{self.path}/{FOLDER}/{version:08d}.json"
        if not write_once(self.spark, target, {**entry, "version": version}):
            for folder in made:
                self._drop(folder)
            raise Conflict(f"{self.path}: version {version} has been made by another writer")
        return version

    def _drop(self, folder: str) -> None:
        p, fs = _hadoop_fs(self.spark, f"{self.path}/{folder}")
        fs.delete(p, True)

    def vacuum(self, keep: int = 1, older_than_s: float = 24 * 3600) -> list[str]:
        """Remove data that none of the newest ``keep`` versions uses; younger files stay, as a writer may be about to publish them."""
        import time
        newest = self.version()
        used: dict[str, set | None] = {}
        for v in range(max(1, newest - keep + 1), newest + 1):
            for p in self.entry(v)["parts"]:
                if p["files"] is None or used.get(p["folder"], ()) is None:
                    used[p["folder"]] = None
                else:
                    used.setdefault(p["folder"], set()).update(p["files"])
        root, fs = _hadoop_fs(self.spark, self.path)
        limit, gone = (time.time() - older_than_s) * 1000, []
        for folder in fs.listStatus(root):
            name = folder.getPath().getName()
            if not name.startswith("data-") or used.get(name, ()) is None:
                continue
            for f in fs.listStatus(folder.getPath()):
                if f.getPath().getName() not in used.get(name, ()) and f.getModificationTime() <= limit:
                    fs.delete(f.getPath(), False)
                    gone.append(f"{name}/{f.getPath().getName()}")
            if name not in used and not fs.listStatus(folder.getPath()):
                fs.delete(folder.getPath(), True)
        return sorted(gone)
