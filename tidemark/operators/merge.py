"""Idempotent writes by key: on DataFrames, and to a versioned table."""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tidemark.operators.reconcile import latest
from tidemark.shared import file_system


def upsert(target: DataFrame, rows: DataFrame, keys: tuple[str, ...]) -> DataFrame:
    """``target`` with ``rows`` in place of rows of equal key; where all columns are key, what is there stays."""
    if set(target.columns) == set(keys):
        return target.unionByName(rows.join(target, list(keys), "left_anti").select(*target.columns))
    return target.join(rows, list(keys), "left_anti").unionByName(rows.select(*target.columns))


def delete(target: DataFrame, gone: DataFrame, keys: tuple[str, ...]) -> DataFrame:
    """``target`` without the keys of ``gone``; a missing key is no error."""
    return target.join(gone.select(*keys), list(keys), "left_anti")


class VersionedTable:
    """A table of stamped rows in files: a log of runs, merged by size.

    A write folds its operations to one per key and appends them as a run of its own,
    however large the table is; reading folds all runs.  Once the newest ``fanout`` runs
    are of like size they are merged into one, so a row is rewritten as often as the
    logarithm of the table's size says, and there are few runs to read.  A manifest that
    names the runs is renamed into place last: readers see whole versions, and a write
    that is repeated after a failure changes nothing, since operations at or before a
    row's own stamp lose.  The table has one writer; another one at the same time is found
    out by its manifest, and raises.

    Deleted rows stay as tombstones until ``purge``, lest an older snapshot row bring them
    back.  Runs that the last ``keep`` versions don't name are deleted after a merge.
    """

    def __init__(self, spark: SparkSession, path: str, keys: tuple[str, ...], payload: dict[str, str], key_types: dict[str, str], fanout: int = 8, keep: int = 10) -> None:
        self.spark, self.path, self.keys, self.payload = spark, path.rstrip("/"), tuple(keys), list(payload)
        columns = key_types | payload | {"op": "string", "pos": "long", "seq": "int"}
        self.schema = ", ".join(f"`{c}` {t}" for c, t in columns.items())
        self.columns, self.fanout, self.keep = list(columns), fanout, keep

    # --- versions ------------------------------------------------------------------------------

    def _versions(self) -> list[str]:
        fs, path = file_system(self.spark, self.path)
        current = path(f"{self.path}/_manifests")
        return sorted(s.getPath().getName() for s in fs.listStatus(current)) if fs.exists(current) else []

    def _load(self, name: str) -> dict:
        fs, path = file_system(self.spark, self.path)
        stream = fs.open(path(f"{self.path}/_manifests/{name}"))
        try:
            return json.loads(bytes(self.spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toByteArray(stream)).decode())
        finally:
            stream.close()

    def manifest(self) -> dict:
        """Version, position of the last commit applied, and the runs, oldest first."""
        found = self._versions()
        return self._load(found[-1]) if found else {"version": 0, "pos": None, "runs": []}

    def _commit(self, manifest: dict) -> None:
        """Write the next version; one of that number must not exist, and afterwards it must be ours."""
        fs, path = file_system(self.spark, self.path)
        manifest |= {"version": manifest["version"] + 1, "writer": uuid.uuid4().hex}
        name = f"{manifest['version']:012d}.json"
        draft = path(f"{self.path}/_drafts/{manifest['writer']}")
        out = fs.create(draft, True)
        out.write(bytearray(json.dumps(manifest).encode()))
        out.hsync()
        out.close()
        fs.mkdirs(path(f"{self.path}/_manifests"))
        jvm, gateway = self.spark.sparkContext._jvm, self.spark.sparkContext._gateway
        uri, conf = fs.makeQualified(draft).toUri(), self.spark.sparkContext._jsc.hadoopConfiguration()
        context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(uri, conf)
        no_overwrite = gateway.new_array(getattr(jvm.org.apache.hadoop.fs, "Options$Rename"), 0)
        try:
            context.rename(fs.makeQualified(draft), fs.makeQualified(path(f"{self.path}/_manifests/{name}")), no_overwrite)
        except Exception as e:
            raise RuntimeError(f"{self.path}: version {manifest['version']} is there already, from another writer") from e
        if self._load(name)["writer"] != manifest["writer"]:
            raise RuntimeError(f"{self.path}: another writer has replaced version {manifest['version']}")

    # --- rows ----------------------------------------------------------------------------------

    def _read(self, runs: list[dict]) -> DataFrame:
        if not runs:
            return self.spark.createDataFrame([], self.schema)
        return self.spark.read.schema(self.schema).parquet(*[f"{self.path}/{r['folder']}" for r in runs])

    def _fold(self, ops: DataFrame) -> DataFrame:
        return latest(ops, self.keys, self.payload).select(*self.columns)

    def _write(self, rows: DataFrame) -> dict:
        """A new run of these rows."""
        seen, folder = Observation(), f"run-{uuid.uuid4().hex}"
        rows.observe(seen, F.count(F.lit(1)).alias("n")).write.parquet(f"{self.path}/{folder}")
        return {"folder": folder, "rows": seen.get.get("n", 0)}

    def rows(self) -> DataFrame:
        """Current rows with their stamps, tombstones included."""
        runs = self.manifest()["runs"]
        return self._read(runs) if len(runs) < 2 else self._fold(self._read(runs))

    def read(self) -> DataFrame:
        """The current state."""
        return self.rows().where("op <> 'd'").select(*self.keys, *self.payload)

    # --- writes --------------------------------------------------------------------------------

    def apply(self, ops: DataFrame, pos: int | None = None) -> None:
        """Fold operations (keys, payload, op, pos, seq) into the table; ``pos`` is the commit they end with.  None there, none written."""
        manifest = self.manifest()
        run = self._write(self._fold(ops))
        ahead = pos is not None and (manifest["pos"] is None or pos > manifest["pos"])
        if run["rows"]:
            manifest["runs"].append(run)
        else:
            self._delete([run["folder"]])
            if not ahead:
                return
        if ahead:
            manifest["pos"] = pos
        merged = self._merge_alike(manifest)
        self._commit(manifest)
        if merged:
            self.vacuum()

    def _merge_alike(self, manifest: dict) -> bool:
        """Merge the newest runs as long as ``fanout`` of them are not much larger than the newest."""
        runs, merged = manifest["runs"], False
        while True:
            tail = 0
            while tail < len(runs) and runs[-1 - tail]["rows"] <= self.fanout * runs[-1]["rows"]:
                tail += 1
            if tail < self.fanout:
                return merged
            runs[-tail:] = [self._write(self._fold(self._read(runs[-tail:])))]
            merged = True

    def purge(self) -> None:
        """Merge all runs and drop tombstones; for when the backfill of the table is done."""
        manifest = self.manifest()
        if not manifest["runs"]:
            return
        run = self._write(self._fold(self._read(manifest["runs"])).where("op <> 'd'"))
        manifest["runs"] = [run] if run["rows"] else []
        self._commit(manifest)
        self.vacuum()

    def vacuum(self) -> None:
        """Delete versions before the last ``keep``, and the runs that only those name."""
        fs, path = file_system(self.spark, self.path)
        versions = self._versions()
        live = {r["folder"] for v in versions[-self.keep :] for r in self._load(v)["runs"]}
        for v in versions[: -self.keep]:
            fs.delete(path(f"{self.path}/_manifests/{v}"), False)
        self._delete([n for n in (s.getPath().getName() for s in fs.listStatus(path(self.path))) if n.startswith("run-") and n not in live])

    def _delete(self, folders: list[str]) -> None:
        fs, path = file_system(self.spark, self.path)
        for folder in folders:
            fs.delete(path(f"{self.path}/{folder}"), True)
