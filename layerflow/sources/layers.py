"""Versioned layer store: count-verified writes, guarded loads, multi-table
atomic publish, resumable increments (S8-S11, U8, D7).

Layout under ``root``::

    <layer>/<table>/v=<run_id>/part-*.parquet     immutable table versions
    <layer>/_manifests/<seq>-<id>.json            state of a layer, written before its commit
    _commits/<seq>.json                           one file per publish: the manifest of every layer

A publish writes the manifests of its layers, then the next commit under a
private name, and renames that to its number, refusing to replace a file. The
rename is the only commit point, of one layer or of several: readers take the
commit with the highest number, so either every table of a publish is visible
or none is, a run that dies in between leaves manifests that nothing names, and
no commit is seen half written. Previous versions stay readable until they are
cleaned up; :meth:`LayerStore.pinned` keeps reading one commit. A manifest
carries the whole state of its layer (tables, buckets, marks, counters): a
publish starts from the current one and changes only its own keys, again after a
lost race. A layer that no commit names yet is read from its newest plainly
numbered manifest. The root must be on a file system whose rename is atomic and
does not overwrite (HDFS, or local disk); all access goes through the session's
Hadoop file system classes.
"""

from __future__ import annotations

import json
import random
import re
import time
import uuid
from collections.abc import Callable, Iterable
from dataclasses import dataclass
from functools import reduce

from py4j.protocol import Py4JJavaError

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from layerflow.session import COMPRESSION, dropping_shuffles


class LoadGuardError(RuntimeError):
    pass


class CountMismatch(RuntimeError):
    pass


@dataclass
class WriteResult:
    table: str
    path: str
    rows_observed: int
    rows_stored: int


class _FS:
    """Tiny wrapper over the session's Hadoop FileSystem (metadata only)."""

    def __init__(self, spark: SparkSession, root: str):
        jvm = spark.sparkContext._jvm
        self._jvm = jvm
        self._Path = jvm.org.apache.hadoop.fs.Path
        conf = spark.sparkContext._jsc.hadoopConfiguration()
        self.fs = self._Path(root).getFileSystem(conf)
        self._context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(self.fs.getUri(), conf)
        rename = getattr(jvm.org.apache.hadoop.fs, "Options$Rename")
        self._never_replace = spark.sparkContext._gateway.new_array(rename, 1)
        self._never_replace[0] = rename.NONE

    def create_new(self, path: str, text: str) -> bool:
        """Create ``path`` whole, or return False if it is there already."""
        final = self._Path(path)
        private = self._Path(final.getParent(), f".{final.getName()}.{uuid.uuid4().hex}")
        out = self.fs.create(private, False)
        try:
            out.write(bytearray(text.encode("utf-8")))
        finally:
            out.close()
        try:
            self._context.rename(private, final, self._never_replace)
        except Py4JJavaError:
            self.fs.delete(private, False)
            if self.fs.exists(final):
                return False
            raise
        return True

    def age(self, path: str) -> float:
        """Seconds since the newest change in a folder."""
        p = self._Path(path)
        times = [s.getModificationTime() for s in [self.fs.getFileStatus(p), *self.fs.listStatus(p)]]
        return time.time() - max(times) / 1000

    def read(self, path: str) -> str:
        stream = self.fs.open(self._Path(path))
        try:
            return self._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def list_names(self, path: str) -> list[str]:
        p = self._Path(path)
        if not self.fs.exists(p):
            return []
        return [n for n in (s.getPath().getName() for s in self.fs.listStatus(p)) if not n.startswith(".")]

    def delete(self, path: str) -> None:
        self.fs.delete(self._Path(path), True)


class LayerStore:
    FOLD_AT, LEVELS = 8, 2   # increments: parts of a level that are folded, and levels below the oldest part

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")
        self.fs = _FS(spark, self.root)
        self._pin: dict | None = None

    # ---- paths -----------------------------------------------------------
    def _table_path(self, layer: str, table: str, version: str) -> str:
        return f"{self.root}/{layer}/{table}/v={version}"

    def _manifest_dir(self, layer: str) -> str:
        return f"{self.root}/{layer}/_manifests"

    # ---- S8: count-verified write ----------------------------------------
    def write_version(self, layer: str, table: str, df: DataFrame, version: str | None = None,
                      sort_within: list[str] | None = None,
                      range_by: list[str] | None = None,
                      partition_by: list[str] | None = None) -> WriteResult:
        """Write one immutable version and verify that the stored row count
        equals the rows that went through the write (one pass, Observation).

        ``range_by`` + ``sort_within`` give the lookup layout of C3: files hold
        key ranges and row groups are sorted, so min/max statistics skip."""
        version = version or uuid.uuid4().hex[:12]
        path = self._table_path(layer, table, version)
        out = df
        if range_by:
            out = out.repartitionByRange(*range_by)
        if sort_within:
            out = out.sortWithinPartitions(*sort_within)
        observed = _observed_write(out, path, "errorifexists", partition_by)
        return self._verified(layer, table, path, observed)

    def write_passes(self, layer: str, table: str, passes: Iterable[DataFrame], partition_by: list[str] | None = None) -> WriteResult:
        """:meth:`write_version` of rows that come in several passes: each is
        written and its shuffle files dropped before the next begins, so the disk
        that a write needs for a while does not grow with the rows."""
        path = self._table_path(layer, table, uuid.uuid4().hex[:12])
        observed = 0
        for df in passes:
            with dropping_shuffles(self.spark):
                observed += _observed_write(df, path, "append", partition_by, {"compression": COMPRESSION})
        return self._verified(layer, table, path, observed)

    def _verified(self, layer: str, table: str, path: str, observed: int) -> WriteResult:
        stored = self.spark.read.parquet(path).count()
        if stored != observed:
            self.fs.delete(path)
            raise CountMismatch(f"{layer}.{table}: wrote {observed} rows, stored {stored}")
        return WriteResult(table, path, observed, stored)

    # ---- S9: guarded staging load ----------------------------------------
    def guarded_load(self, layer: str, table: str, df: DataFrame, min_rows: int = 1,
                     version: str | None = None) -> WriteResult:
        """Refuse inputs below ``min_rows`` before writing anything; write a
        staging version, verify its count, then publish it alone."""
        # The guard reads only as many rows as the floor (no full count).
        if min_rows > 0 and df.limit(min_rows).count() < min_rows:
            raise LoadGuardError(f"{layer}.{table}: fewer than {min_rows} rows, load refused")
        res = self.write_version(layer, table, df, version)
        self.publish(layer, {table: res.path})
        return res

    # ---- S10: atomic publish of tables and layers -------------------------
    def head(self) -> dict:
        """The newest commit: its number, and the manifest of each layer."""
        names = self._commit_names()
        return json.loads(self.fs.read(f"{self.root}/_commits/{names[-1]}")) if names else {"seq": 0, "layers": {}}

    def _commit_names(self) -> list[str]:
        return sorted(n for n in self.fs.list_names(f"{self.root}/_commits") if n.endswith(".json"))

    def pinned(self) -> LayerStore:
        """A reader that stays at the commit that is newest now, over all layers."""
        reader = LayerStore(self.spark, self.root)
        reader._pin = self.head()
        return reader

    def current(self, layer: str, commit: dict | None = None) -> dict:
        """A layer's manifest in ``commit`` (default: the pinned one, else the newest)."""
        name = (commit or self._pin or self.head())["layers"].get(layer)
        if name is None:
            plain = sorted(n for n in self.fs.list_names(self._manifest_dir(layer)) if re.fullmatch(r"\d+\.json", n))
            name = plain[-1] if plain else None
        return json.loads(self.fs.read(f"{self._manifest_dir(layer)}/{name}")) if name else {"seq": 0, "tables": {}}

    def publish(self, layer: str, tables: dict[str, str], extra: Callable[[dict], dict] | None = None) -> dict:
        """Make ``tables`` (name -> version path) current together, keeping
        every other table and all other state of the layer as they are.
        ``extra`` gets the manifest that is replaced and returns the top-level
        keys to set; it runs again when another writer was faster."""
        return self.publish_together({layer: (tables, extra)})[layer]

    def publish_together(self, changes: dict[str, tuple[dict, Callable[[dict], dict] | None]]) -> dict[str, dict]:
        """Publish the (tables, extra) of several layers in one commit."""
        if self._pin:
            raise RuntimeError("a pinned reader does not publish")
        for attempt in range(50):
            head, new, names = self.head(), {}, {}
            for layer, (tables, extra) in changes.items():
                cur = self.current(layer, head)
                new[layer] = {**cur, **(extra(cur) if extra else {}), "seq": cur["seq"] + 1, "tables": {**cur["tables"], **tables}}
                names[layer] = f"{new[layer]['seq']:012d}-{uuid.uuid4().hex[:12]}.json"
                self.fs.create_new(f"{self._manifest_dir(layer)}/{names[layer]}", json.dumps(new[layer]))
            commit = {"seq": head["seq"] + 1, "layers": {**head["layers"], **names}}
            if self.fs.create_new(f"{self.root}/_commits/{commit['seq']:012d}.json", json.dumps(commit)):
                return new
            for layer, name in names.items():
                self.fs.delete(f"{self._manifest_dir(layer)}/{name}")
            time.sleep(random.random() * 0.02 * attempt)
        raise RuntimeError(f"could not publish {', '.join(changes)}: concurrent writers")

    def build_and_publish(self, layer: str, builders: dict, version: str | None = None,
                          extra: Callable[[dict], dict] | None = None, layouts: dict | None = None) -> dict:
        """Blue/green: build every table aside in order; stop at the first
        failure and leave the live layer untouched; on success switch all.
        ``layouts`` maps a table to its lookup columns (C3)."""
        return self.publish(layer, self.build_aside(layer, builders, version, layouts), extra)

    def build_aside(self, layer: str, builders: dict, version: str | None = None,
                    layouts: dict | None = None) -> dict[str, str]:
        """Write every table without switching it live: name -> path."""
        version = version or uuid.uuid4().hex[:12]
        written: dict[str, str] = {}
        for name, build in builders.items():
            df = build() if callable(build) else build
            # layout keys the table does not carry are skipped
            cols = [c for c in (layouts or {}).get(name, []) if c in df.columns] or None
            written[name] = self.write_version(layer, name, df, version, sort_within=cols, range_by=cols).path
        return written

    def vacuum(self, layer: str, keep: int = 1, min_age: float = 24 * 3600) -> list[str]:
        """Drop table versions that none of the newest ``keep`` manifests names
        anywhere (tables, buckets, increments) and that are older than
        ``min_age`` seconds, so that versions another run still writes stay."""
        live: set[str] = set()
        kept: list[str] = []
        for name in reversed(self._commit_names()):
            manifest = json.loads(self.fs.read(f"{self.root}/_commits/{name}"))["layers"].get(layer)
            if manifest and manifest not in kept:
                kept.append(manifest)
                live.update(_strings(json.loads(self.fs.read(f"{self._manifest_dir(layer)}/{manifest}"))))
            if len(kept) == keep:
                break
        if not kept:
            live.update(_strings(self.current(layer)))
        live_dirs = {re.split("/_*bucket=", p)[0] for p in live}
        dropped = []
        for table in self.fs.list_names(f"{self.root}/{layer}"):
            if table == "_manifests":
                continue
            for v in self.fs.list_names(f"{self.root}/{layer}/{table}"):
                path = f"{self.root}/{layer}/{table}/{v}"
                if path not in live_dirs and self.fs.age(path) >= min_age:
                    self.fs.delete(path)
                    dropped.append(path)
        return dropped

    # ---- U8: resumable incremental load ----------------------------------
    def high_water_mark(self, layer: str, name: str):
        """Last committed key of an unfinished incremental run (None: the
        previous run completed, so the next one is a full pass)."""
        return self.current(layer).get("hwm", {}).get(name)

    def commit_increment(self, layer: str, name: str, df: DataFrame, key: str, done: bool) -> dict:
        """Commit one increment of ``name``, keyed by ``key``; its highest
        stored key becomes the resume point, which goes when the pass is
        complete. The increments of a pass replace the rows of earlier passes
        that have their keys (null is a key, too), so a second full pass leaves
        every row once; rows of one pass never replace each other. After the
        commit, parts that are due are folded (:meth:`fold_increments`)."""
        res = self.write_version(layer, f"{name}__part", df)
        top = self.spark.read.parquet(res.path).agg(F.max(f"`{key}`")).first()[0]

        def with_part(cur: dict) -> dict:
            hwm = dict(cur.get("hwm", {}))
            before = increment_state(cur, name) or {"key": key, "open": False, "runs": 0, "pass": 0, "parts": []}
            if before["key"] != key:
                raise ValueError(f"{layer}.{name}: its increments are keyed by {before['key']}, not by {key}")
            number = before["pass"] + (not before["open"])
            part = {"path": res.path, "first": number, "pass": number, "run": before["runs"] + 1, "level": 0}
            state = {"key": key, "open": not done, "runs": part["run"], "pass": number, "parts": [*before["parts"], part]}
            if done:
                hwm.pop(name, None)
            elif top is not None:
                hwm[name] = top
            return {"hwm": hwm, "parts": {**cur.get("parts", {}), name: state}}

        self.publish(layer, {}, with_part)
        self.fold_increments(layer, name)
        return self.current(layer)

    def fold_increments(self, layer: str, name: str) -> None:
        """Fold ``FOLD_AT`` parts of one level into one part of the next, of
        each key the rows of its latest pass among them. The last of ``LEVELS``
        is folded into a single part, so at most ``LEVELS * FOLD_AT`` parts are
        ever read and the oldest rows are rewritten once in ``FOLD_AT ** LEVELS``
        increments. A fold is a commit of its own that changes no result; what
        it replaces is named no more, and ``vacuum`` drops it."""
        for level in range(self.LEVELS):
            state = increment_state(self.current(layer), name)
            due = [p for p in state["parts"] if p["level"] == level]
            if len(due) < self.FOLD_AT:
                continue
            if level == self.LEVELS - 1:
                due = [p for p in state["parts"] if p["level"] >= level]
            rows, marks = self._latest(due, state["key"])
            path = self.write_version(layer, f"{name}__part", rows).path
            folded = {"path": path, "first": due[0]["first"], "pass": due[-1]["pass"], "marks": marks, "level": level + 1}
            gone = [p["path"] for p in due]

            def with_fold(cur: dict) -> dict:
                now = increment_state(cur, name)
                at = [i for i, p in enumerate(now["parts"]) if p["path"] in gone]
                if len(at) != len(gone):  # another writer folded them meanwhile
                    return {}
                parts = [*now["parts"][:at[0]], folded, *now["parts"][at[-1] + 1:]]
                return {"parts": {**cur["parts"], name: {**now, "parts": parts}}}

            self.publish(layer, {}, with_fold)

    def _latest(self, parts: list[dict], key: str) -> tuple[DataFrame, list[str]]:
        """Of each key in ``parts`` (in order of commit) the rows of its latest
        pass, with the names of two further columns: their pass and run. No
        rows meet in a group: they are joined with the latest pass of their key,
        which Spark splits where a key is frequent. (An anti join would be pushed
        into every part, and the plan grow with the square of the parts.)"""
        frames = [self.spark.read.parquet(p["path"]) for p in parts]
        taken = {c.lower() for f in frames for c in f.columns}
        marks = [next(n for n in (f"__{c}{'_' * i}" for i in range(len(taken) + 1)) if n not in taken) for c in ("pass", "run")]

        def marked(f: DataFrame, p: dict) -> DataFrame:
            own = [F.col(f"`{c}`") for c in p["marks"]] if "marks" in p else [F.lit(p["pass"]), F.lit(p["run"])]
            data = [F.col(f"`{c}`") for c in f.columns if c not in p.get("marks", ())]
            return f.select(*data, *[c.cast("int").alias(n) for c, n in zip(own, marks, strict=True)])

        def union(frames: list[DataFrame]) -> DataFrame:
            return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)

        frames = [marked(f, p) for f, p in zip(frames, parts, strict=True)]
        rows = union(frames)
        # rows of the earliest pass replace none, and the oldest part is folded in itself
        later = [f for f, p in zip(frames[1:], parts[1:], strict=True) if p["pass"] > parts[0]["first"]]
        if not later:
            return rows, marks
        newest = union([f.select(F.col(f"`{key}`").alias("k"), F.col(marks[0]).alias("p")) for f in later]).groupBy("k").agg(F.max("p").alias("p"))
        held = rows.join(newest, rows[f"`{key}`"].eqNullSafe(newest["k"]), "left").where(newest["p"].isNull() | (rows[marks[0]] == newest["p"]))
        return held.select(*[rows[f"`{c}`"] for c in rows.columns]), marks

    def increments(self, layer: str, name: str, run_col: str | None = None) -> DataFrame:
        """The rows of all increments, of each key those of its latest pass;
        ``run_col``: the number of the run that committed them."""
        state = increment_state(self.current(layer), name)
        if not state:
            raise KeyError(f"{layer}.{name} has no increments")
        rows, (pass_col, stored_run) = self._latest(state["parts"], state["key"])
        return rows.drop(pass_col).withColumnRenamed(stored_run, run_col) if run_col else rows.drop(pass_col, stored_run)

    # ---- S11: layer reader -----------------------------------------------
    def table(self, layer: str, name: str) -> DataFrame:
        """The rows of a table as the current manifest has them; tables kept as
        deltas are merged on read."""
        cur = self.current(layer)
        if name in cur.get("groups", {}):
            from layerflow.sources.groups import grouped
            return grouped(self, layer, name).read()
        if name not in cur["tables"]:
            raise KeyError(f"{layer}.{name} is not published")
        rule = cur.get("merge", {}).get(name)
        if rule:
            return read_parts(self.spark, cur["buckets"][name], rule["keys"], rule["order"])
        paths = cur["tables"][name]
        return self.spark.read.parquet(*paths) if isinstance(paths, list) else self.spark.read.parquet(paths)


def _observed_write(df: DataFrame, path: str, mode: str, partition_by: list[str] | None = None, options: dict | None = None) -> int:
    """Write the rows and give the number that went through the write."""
    obs = Observation(f"w_{uuid.uuid4().hex[:12]}")
    # observed right above the write: a range partitioner's sampling job
    # runs below this point and cannot report a partial count
    w = df.observe(obs, F.count(F.lit(1)).alias("rows")).write.mode(mode).options(**options or {})
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)
    return int(obs.get["rows"])


def increment_state(manifest: dict, name: str) -> dict | None:
    """What a manifest holds on the increments of ``name``: key, whether a pass
    is open, runs and passes so far, and the parts in order of commit. Manifests
    of earlier releases list the parts by pass."""
    state = manifest.get("parts", {}).get(name)
    if state and "passes" in state:
        parts = [{"path": p["path"], "first": n, "pass": n, "run": p["run"], "level": 0} for n, ps in enumerate(state["passes"], 1) for p in ps]
        state = {"key": state["key"], "open": state["open"], "runs": state["runs"], "pass": len(state["passes"]), "parts": parts}
    return state


def parts_of(buckets: dict) -> dict[str, list[str]]:
    """Bucket -> its files, oldest first."""
    return {b: [p] if isinstance(p, str) else list(p) for b, p in buckets.items()}


def read_parts(spark: SparkSession, buckets: dict, keys: list[str], order: str, schema: str | None = None) -> DataFrame:
    """The latest row (by ``order``) of each key. Buckets of one file are read
    as they are, those with deltas are merged: two branches at most."""
    reader = spark.read.schema(schema) if schema else spark.read
    parts = parts_of(buckets)
    single = sorted(p for ps in parts.values() if len(ps) == 1 for p in ps)
    several = sorted(p for ps in parts.values() if len(ps) > 1 for p in ps)
    out = reader.parquet(*single) if single else None
    if several:
        rows = reader.parquet(*several)
        rest = [c for c in rows.columns if c not in keys]
        merged = rows.groupBy(*keys).agg(F.max_by(F.struct(*rest), order).alias("__row")).select(*keys, "__row.*").select(*rows.columns)
        out = merged if out is None else out.unionByName(merged)
    return out


def _strings(value) -> set[str]:
    """Every text inside a JSON value."""
    if isinstance(value, str):
        return {value}
    items = value.values() if isinstance(value, dict) else value if isinstance(value, list) else ()
    return set().union(*map(_strings, items))


def scan_after(df: DataFrame, key: str, hwm) -> DataFrame:
    """S4 + W3: rows after the high-water mark (pushed to the file scan)."""
    return df if hwm is None else df.where(F.col(key) > F.lit(hwm))
