"""Warehouse storage on plain Parquet: staged run directories published by a manifest, and lineage cuts.

Layout of a versioned table (history is never rewritten)::

    <wh>/<table>/open/run=<run_id>/attempt=<a>/      the complete set of open versions after that run
    <wh>/<table>/closed/run=<run_id>/attempt=<a>/    versions closed by that run (append-only)
    <wh>/_manifest/<run_id>.<n>.json                 table -> live open dir + closed dirs; renamed into place last

Insert-only tables (junk dimensions, facts) use ``<wh>/<table>/run=<run_id>/attempt=<a>/`` parts. Every attempt at a run
writes directories of its own, so a run that fails, or is run again, never touches what a published manifest names:
until the new manifest is renamed into place, readers see the old one. A manifest is only created, never replaced; a
publisher that finds another's in its place looks at it and goes on top of it, or gives up if both changed a table
(``Conflict``). That rests on the file system's rename, which is atomic on HDFS and alike, not on plain object stores. Runs are published in order of their ids; a
full load replaces all tables, an incremental one carries on from the last run before it.
"""

from __future__ import annotations

import hashlib
import json
import uuid
from collections.abc import Callable, Iterator, Mapping
from contextlib import contextmanager

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession

from starloom.session import checkpoint_dir
from starloom.sources.buckets import carried, read_buckets
from starloom.sources.evolution import read_evolved, write_part


def materialize(df: DataFrame) -> DataFrame:
    """Cut the lineage of ``df``: write it as Parquet under the session's shared checkpoint folder
    (``spark.checkpoint.dir``) and read it back. Survives executor loss (unlike caching or a local checkpoint)
    and is columnar and compressed (unlike an RDD checkpoint)."""
    return _materialize(df)[0]


def _materialize(df: DataFrame) -> tuple[DataFrame, str]:
    spark = df.sparkSession
    path = f"{_intermediates(spark)}/{uuid.uuid4().hex}"
    df.write.mode("overwrite").option("compression", "zstd").parquet(path)
    return spark.read.parquet(path), path


@contextmanager
def passing(spark: SparkSession) -> Iterator[Callable[[DataFrame], DataFrame]]:
    """A ``materialize`` whose tables are deleted at the end of the block: for what only the writes within it read."""
    paths: list[str] = []

    def cut(df: DataFrame) -> DataFrame:
        out, path = _materialize(df)
        paths.append(path)
        return out

    try:
        yield cut
    finally:
        for path in paths:
            fs, p = _fs(spark, path)
            fs.delete(p, True)


def _intermediates(spark: SparkSession) -> str:
    return f"{checkpoint_dir(spark).rstrip('/')}/starloom-mat/{spark.sparkContext.applicationId}"


def clear_intermediates(spark: SparkSession) -> None:
    """Delete all tables that ``materialize`` wrote for this application; for when its results have been written."""
    fs, p = _fs(spark, _intermediates(spark))
    fs.delete(p, True)


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """Write a small text file through the Hadoop file system of ``path`` (works on HDFS / object stores)."""
    fs, p = _fs(spark, path)
    out = fs.create(p, True)
    try:
        out.write(bytearray(text.encode("utf-8")))
    finally:
        out.close()


def read_text(spark: SparkSession, path: str) -> str | None:
    fs, p = _fs(spark, path)
    if not fs.exists(p):
        return None
    jvm = spark.sparkContext._jvm
    stream = fs.open(p)
    try:
        return jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def list_names(spark: SparkSession, folder: str) -> list[str]:
    """The names, without ending, of a folder's JSON files."""
    fs, p = _fs(spark, folder)
    if not fs.exists(p):
        return []
    names = [st.getPath().getName() for st in fs.listStatus(p)]
    return sorted(n[:-5] for n in names if n.endswith(".json") and not n.startswith((".", "_")))


def list_manifests(spark: SparkSession, warehouse: str) -> list[str]:
    return list_names(spark, f"{warehouse}/_manifest")


def replace_text(spark: SparkSession, path: str, text: str, overwrite: bool = True) -> bool:
    """Write a small file in place of an earlier one, as a whole or not at all: a reader finds the old or the new text.
    Without ``overwrite`` only if there is none; the answer is whether it was written (the file system's rename decides, so
    of two writers one is told no)."""
    jvm, sc = spark.sparkContext._jvm, spark.sparkContext
    draft = f"{path.rsplit('/', 1)[0]}/.draft-{uuid.uuid4().hex}"
    write_text(spark, draft, text)
    conf = sc._jsc.hadoopConfiguration()
    place, of = jvm.org.apache.hadoop.fs.Path, jvm.org.apache.hadoop.fs.FileContext
    context = of.getFileContext(place(path).getFileSystem(conf).getUri(), conf)
    options = sc._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 1)
    options[0] = jvm.org.apache.hadoop.fs.Options.Rename.OVERWRITE if overwrite else jvm.org.apache.hadoop.fs.Options.Rename.NONE
    try:
        context.rename(place(draft), place(path), options)
    except Py4JJavaError as e:
        if overwrite or "FileAlreadyExists" not in e.java_exception.getClass().getName():
            raise
        place(draft).getFileSystem(conf).delete(place(draft), False)
        return False
    return True


class Conflict(RuntimeError):
    """Another publisher has changed what this run was built on."""


class Store:
    """A warehouse root with staged writes and manifest publication."""

    def __init__(self, spark: SparkSession, root: str, buckets: int | None = None):
        """``buckets``: keep open versions in so many id buckets (see ``sources.buckets``), so that a run rewrites the
        buckets it changes; without it a run rewrites all open versions of a table."""
        self.spark = spark
        self.buckets = buckets
        self.root = root.rstrip("/")
        self._attempts: dict[str, str] = {}
        self._seen: dict[str, set[str]] = {}  # what was published when an attempt began

    # ------------------------------------------------------------------------------------------------ runs
    def run_ids(self) -> list[str]:
        """The published runs, in order."""
        return sorted({n.rsplit(".", 1)[0] for n in list_manifests(self.spark, self.root)})

    def begin(self, run_id: str, replay: bool = False) -> None:
        """Start an attempt at a run. A run older than the last published one is refused, as what came after it was
        built without it, unless the caller is going to run that again as well (``replay``)."""
        ids = self.run_ids()
        if ids and run_id < ids[-1] and not replay:
            raise RuntimeError(f"run {run_id} is older than the published run {ids[-1]}")
        self._attempts[run_id] = uuid.uuid4().hex[:12]
        self._seen[run_id] = set(list_manifests(self.spark, self.root))

    def step(self, run_id: str, name: str, make: Callable[[], dict], resume: str | None) -> dict:
        """The manifest entries that ``make`` writes for one step of a run. With ``resume`` (what tells one run's inputs from
        others'), they are noted once the step is done, and an earlier attempt's note, made of the same inputs on the same
        state, is used instead of running the step again."""
        if resume is None:
            return make()
        before = [n for n in list_manifests(self.spark, self.root) if n.rsplit(".", 1)[0] < run_id]
        token = hashlib.md5(json.dumps([resume, before[-1:], self.buckets]).encode()).hexdigest()
        path = f"{self.root}/_journal/{run_id}/{token}/{name}.json"
        noted = read_text(self.spark, path)
        if noted:
            return json.loads(noted)
        entry = make()
        replace_text(self.spark, path, json.dumps(entry))
        return entry

    # ------------------------------------------------------------------------------------------------ writing
    def write(self, df: DataFrame, table: str, run_id: str, part: str | None = None,
              partition_by: list[str] | None = None) -> str:
        """Write one run's data of ``table`` (optionally a sub-part such as ``open``/``closed``)."""
        sub = f"{part}/" if part else ""
        if run_id not in self._attempts:
            self.begin(run_id)
        path = f"{self.root}/{table}/{sub}run={run_id}/attempt={self._attempts[run_id]}"
        w = df.write.mode("errorifexists").option("compression", "zstd")
        if partition_by:
            w = w.partitionBy(*partition_by)
        w.parquet(path)
        return path

    def publish(self, run_id: str, run_ts: str, tables: Mapping[str, Mapping[str, object]], replace: bool = False) -> str:
        """Write the manifest for ``run_id``: ``{table: {"open": dir, "closed": [dirs], "parts": [dirs]}}``
        (``"replace": True``: the directories replace the table's earlier ones instead of adding to them). Carries forward every table of the run before that this one did not touch, or, with ``replace`` (a full
        load), nothing."""
        while True:
            path = self._publish_once(run_id, run_ts, tables, replace)
            if path:
                break
        self._attempts.pop(run_id, None)
        fs, journal = _fs(self.spark, f"{self.root}/_journal/{run_id}")
        fs.delete(journal, True)
        return path

    def _check(self, run_id: str, tables: Mapping) -> list[str]:
        """The manifests published since the attempt began, by others; ``Conflict`` if this run can't go on top of them:
        they are of a later run, or changed a table that this one changes as well."""
        seen = self._seen.get(run_id)
        others = [] if seen is None else [n for n in list_manifests(self.spark, self.root) if n not in seen]
        for n in others:
            doc = json.loads(read_text(self.spark, f"{self.root}/_manifest/{n}.json"))
            both = sorted(set(doc.get("touched", doc["tables"])) & set(tables))
            if both or doc["run_id"] > run_id:
                raise Conflict(f"run {run_id}: {n} was published meanwhile" + (f" and changed {', '.join(both)}" if both else ""))
        return others

    def _publish_once(self, run_id: str, run_ts: str, tables: Mapping[str, Mapping[str, object]], replace: bool) -> str | None:
        """Publish on top of what is there now; None if another publisher came first (then it is to be looked at again)."""
        others = self._check(run_id, tables)
        prev = None if replace else self.manifest_before(run_id)
        own = [n for n in others if n.rsplit(".", 1)[0] == run_id]
        if own:  # the same run, other tables: carry them as well
            prev = json.loads(read_text(self.spark, f"{self.root}/_manifest/{own[-1]}.json"))
        merged: dict[str, dict] = {k: dict(v) for k, v in (prev or {}).get("tables", {}).items()}
        for t, entry in tables.items():
            cur = merged.setdefault(t, {})
            if "open" in entry:
                cur["open"] = entry["open"]
            if "buckets" in entry:
                cur.update(carried(cur, entry))
            if "filters" in entry:
                cur["filters"] = {**({} if entry.get("replace") else cur.get("filters", {})), **entry["filters"]}
            for key in ("schemas", "schema_of"):
                if key in entry:
                    cur[key] = {**({} if entry.get("replace") else cur.get(key, {})), **entry[key]}
            for key in ("closed", "parts"):
                if key in entry:
                    have = [] if entry.get("replace") else list(cur.get(key, []))
                    for d in entry[key]:
                        if d not in have:
                            have.append(d)
                    cur[key] = have
        doc = {"run_id": run_id, "run_ts": run_ts, "tables": merged, "touched": sorted(tables)}
        known = self._seen.get(run_id, set()) | set(others) if run_id in self._seen else set(list_manifests(self.spark, self.root))
        n = 1 + sum(x.rsplit(".", 1)[0] == run_id for x in known)
        path = f"{self.root}/_manifest/{run_id}.{n:06d}.json"
        return path if replace_text(self.spark, path, json.dumps(doc, indent=1, sort_keys=True), overwrite=False) else None

    def compact(self, tables: list[str] | None = None, describe: Callable[[str, str, str], dict] | None = None) -> None:
        """Rewrite the closed versions and parts of tables as one directory each and publish that as the last run's
        state; without it their lists grow by a directory per run. ``describe(path, table, run_id)`` gives the note of a
        merged part for tables that have such (``filters``); without it those tables' parts stay as they are."""
        run_id, m = self.run_ids()[-1], self.manifest()
        self.begin(run_id)
        entries = {}
        for t, e in m["tables"].items():
            entry = dict(e)
            for key in ("closed", "parts"):
                noted = key == "parts" and "filters" in e
                if (tables is None or t in tables) and len(e.get(key, [])) > 1 and not (noted and describe is None):
                    if key == "parts" and "schemas" in e:
                        entry.update(write_part(self, read_evolved(self.spark, e), t, run_id, e["schemas"], "parts-compact"))
                        continue
                    entry[key] = [self.write(self.spark.read.parquet(*e[key]), t, run_id, part=f"{key}-compact")]
                    if noted:
                        entry["filters"] = {p: describe(p, t, run_id) for p in entry[key]}
            entries[t] = entry
        self.publish(run_id, m["run_ts"], entries, replace=True)

    # ------------------------------------------------------------------------------------------------ reading
    def manifest(self, run_id: str | None = None) -> dict | None:
        """The last manifest, or that of a run."""
        names = [n for n in list_manifests(self.spark, self.root) if run_id is None or n.rsplit(".", 1)[0] == run_id]
        txt = read_text(self.spark, f"{self.root}/_manifest/{names[-1]}.json") if names else None
        return json.loads(txt) if txt else None

    def manifest_before(self, run_id: str) -> dict | None:
        """The manifest of the last run before ``run_id``."""
        ids = [i for i in self.run_ids() if i < run_id]
        return self.manifest(ids[-1]) if ids else None

    def read(self, table: str, which: str = "all", run_id: str | None = None) -> DataFrame | None:
        """Read a published table: ``open`` versions, ``closed`` history, insert-only ``parts``, or ``all``."""
        m = self.manifest(run_id)
        if not m or table not in m["tables"]:
            return None
        e = m["tables"][table]
        if "schemas" in e:
            return read_evolved(self.spark, e)
        paths: list[str] = []
        if which in ("open", "all") and e.get("buckets") is not None:
            if which == "open" or not e.get("closed"):
                return read_buckets(self.spark, e)
            paths += e["buckets"].values()
        if which in ("open", "all") and e.get("open"):
            paths.append(e["open"])
        if which in ("closed", "all"):
            paths += e.get("closed", [])
        if which in ("parts", "all"):
            paths += e.get("parts", [])
        if not paths:
            return None
        return self.spark.read.option("mergeSchema", "false").parquet(*paths)

    def exists(self) -> bool:
        return bool(list_manifests(self.spark, self.root))

