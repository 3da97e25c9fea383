"""Tables that change by whole groups of rows (U6, U7, P4 applied, S10).

A grouped table holds the rows of each group (all children of one parent, or
the one row of a document) in hash buckets of the group column. A change
replaces whole groups: it writes one delta holding only the rows of the groups
it touches, each with the number of its run; a group left without rows has one
row that is not live. Files that no touched group hashes to are never read or
written again, they stay in the manifest by reference. Readers take of each
group the rows of its latest run. A bucket that has collected ``max_parts`` files
is folded into one by the change that reaches the bound, so the plan of a reader
and the number of files do not grow with the number of runs. Buckets hold about
``BUCKET_ROWS`` rows; a table that has outgrown its buckets four times over is
dealt to more of them once.

The manifest also keeps

* the table's schemas, one per change of its columns: a file names the schema
  it was written with, and readers bring the columns of older files to the
  current one (missing columns NULL, types widened), so a column that is added
  or widened rewrites nothing;
* the highest row id given out. A row is known by (group, ``row_hash``): one
  that is there already keeps its id, new ones are numbered after the highest.
  The number becomes visible with the rows it was given to, in one publish, so
  a run that fails or is repeated gives no id twice.
"""

from __future__ import annotations

import json
import math
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from layerflow.operators.keys import dense_ids
from layerflow.session import Aside
from layerflow.sources.layers import LayerStore

MIN_BUCKETS = 4
BUCKET_ROWS = 2_000_000
MAX_PARTS = 8
PASS_ROWS = 10_000_000   # rows that are shuffled at a time
RUN, LIVE, BUCKET, HIDDEN = "__run", "__live", "__bucket", "__"


def widened(column: Column, old: str, new: str) -> Column:
    """A value of an older file in the type the column has now."""
    if old == new:
        return column
    if new in ("date", "timestamp_ntz") and old != "string":
        return column.cast("string").try_cast(new)
    return column.try_cast(new)


def project(df: DataFrame, schema: StructType) -> DataFrame:
    """The rows with the columns of ``schema``."""
    have = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    return df.select(*[(widened(F.col(f"`{f.name}`"), have[f.name], f.dataType.simpleString()) if f.name in have
                        else F.lit(None).cast(f.dataType)).alias(f.name) for f in schema.fields])


@dataclass
class Change:
    """A change written aside: the table's new state, and its reader."""
    state: dict
    written: int                     # rows written
    paths: list[str] = field(default_factory=list)


class GroupedTable:
    def __init__(self, store: LayerStore, layer: str, name: str, group: str, buckets: int | None = None, max_parts: int = MAX_PARTS):
        self.store, self.layer, self.name, self.group = store, layer, name, group
        self.buckets, self.max_parts = buckets, max_parts

    # ---- state and readers -----------------------------------------------
    def state(self) -> dict:
        """The published state; an empty one for a new table."""
        own = self.store.current(self.layer).get("groups", {}).get(self.name)
        return own or {"group": self.group, "count": self.buckets or 0, "rows": 0, "run": 0, "top_id": 0, "schemas": [], "buckets": {}}

    def exists(self) -> bool:
        return bool(self.state()["schemas"])

    def schema(self, state: dict | None = None) -> StructType:
        return StructType.fromJson((state or self.state())["schemas"][-1])

    def read(self, state: dict | None = None, hidden: bool = False, only: set[str] | None = None) -> DataFrame:
        """The live rows (of the buckets ``only``). The plan has at most two
        branches per schema of the table, however many runs wrote it, and one that
        finds the later runs of a group. What the last file of a bucket holds is the
        latest of its groups, so only rows of earlier files are shuffled."""
        state = state or self.state()
        schema = self.schema(state)
        last: dict[int, list[str]] = {}
        earlier: dict[int, list[str]] = {}
        later: dict[int, list[str]] = {}
        for bucket, parts in state["buckets"].items():
            if only is None or bucket in only:
                for i, (path, no) in enumerate(parts):
                    (last if i == len(parts) - 1 else earlier).setdefault(no, []).append(path)
                    if i:
                        later.setdefault(no, []).append(path)
        out = self._files(state, schema, last)
        layered = self._files(state, schema, earlier)
        if layered is not None:
            group = state["group"]
            newest = self._files(state, schema, later).groupBy(group).agg(F.max(RUN).alias("__newest"))
            layered = layered.where(F.col(LIVE) & F.col(group).isNotNull()).join(newest, group, "left") \
                .where(F.col("__newest").isNull() | (F.col("__newest") == F.col(RUN))).select(*out.columns)
            out = out.unionByName(layered)
        if out is None:
            out = self.store.spark.createDataFrame([], schema)
        out = out.where(F.col(LIVE))
        return out.select(*[f"`{c}`" for c in schema.names if hidden or not c.startswith(HIDDEN)])

    def _files(self, state: dict, schema: StructType, files: dict[int, list[str]]) -> DataFrame | None:
        out = None
        for no, paths in sorted(files.items()):
            rows = project(self.store.spark.read.schema(StructType.fromJson(state["schemas"][no])).parquet(*sorted(paths)), schema)
            out = rows if out is None else out.unionByName(rows)
        return out

    # ---- changes ---------------------------------------------------------
    def bucket(self, count: int) -> Column:
        return F.pmod(F.xxhash64(F.col(self.group)), F.lit(count)).cast("int")

    def slices(self, state: dict, only: set[str], rows: int = 0) -> list[set[str]]:
        """The buckets ``only`` in sets of about PASS_ROWS rows, of the table or
        of ``rows`` that fall in them if they are more."""
        rows = max(rows, state["rows"] * len(only) // max(1, len(state["buckets"])))
        n = max(1, min(len(only), math.ceil(rows / PASS_ROWS)))
        return [set(sorted(only, key=int)[i::n]) for i in range(n)]

    def with_ids(self, rows: DataFrame, touched: DataFrame, order_by: list[str], aside: Aside, id_col: str = "id",
                 presorted: bool = False) -> DataFrame:
        """``rows`` of the touched groups with stable ids (U7): known by
        (group, row_hash) they keep theirs, new ones follow the highest. Stored
        ``aside``, without ``row_hash``. ``presorted``: the rows are in order, see
        :func:`dense_ids`."""
        state = self.state()
        if not state["schemas"]:
            return dense_ids(rows.drop("row_hash"), order_by, id_col, presorted=presorted, keep=aside.keep)
        hit = {str(r[0]) for r in touched.select(self.bucket(state["count"])).distinct().collect()}  # at most the bucket count
        known = aside.keep(*[self.read(state, only=some).select(self.group, "row_hash", id_col).join(touched, self.group, "left_semi")
                             for some in self.slices(state, hit)])
        met = aside.keep(rows.join(known, [self.group, "row_hash"], "left").drop("row_hash"))
        aside.drop(known)
        fresh = dense_ids(met.where(F.col(id_col).isNull()).drop(id_col), order_by, id_col, keep=aside.keep) \
            .withColumn(id_col, F.col(id_col) + F.lit(state["top_id"]))
        return met.where(F.col(id_col).isNotNull()).unionByName(fresh)

    def replace(self, rows: DataFrame, touched: DataFrame, id_col: str | None = None) -> Change:
        """Write aside: the touched groups (a column named like the group) have
        exactly ``rows`` from now on. Nothing touched writes nothing. The rows are
        read several times, so they should be stored or cheap to compute."""
        with Aside(self.store.spark, f"{self.name}-change") as aside:
            return self._replace(rows, touched, id_col, aside)

    def _replace(self, rows: DataFrame, touched: DataFrame, id_col: str | None, aside: Aside) -> Change:
        state = json.loads(json.dumps(self.state()))
        columns = [c for c in rows.columns if c not in (RUN, LIVE)]
        plain = rows.select(*[f"`{c}`" for c in columns])
        old = self.schema(state) if state["schemas"] else StructType([])
        current = StructType([f for f in old.fields if f.name not in (*columns, RUN, LIVE)] + plain.schema.fields)
        names = sorted(current.names, key=lambda n: (n != self.group, old.names.index(n) if n in old.names else len(old.names)))
        current = StructType([current[n] for n in names])
        for f in current.fields:
            f.nullable = True
        run = state["run"] + 1
        touched = aside.keep(touched.select(self.group).distinct())
        gone = aside.keep(touched.join(plain.select(self.group).distinct(), self.group, "left_anti"))
        delta = project(plain, current).withColumn(LIVE, F.lit(True)) \
            .unionByName(project(gone, current).withColumn(LIVE, F.lit(False))).withColumn(RUN, F.lit(run).cast("bigint"))
        full = StructType(current.fields + delta.select(LIVE, RUN).schema.fields)
        for f in full.fields:
            f.nullable = True
        own = full.jsonValue()
        if not state["schemas"] or state["schemas"][-1] != own:
            state["schemas"].append(own)
        number = len(state["schemas"]) - 1
        count = state["count"]
        added = delta.count()
        if not added:
            return Change(self.state(), 0)
        grown = buckets_for(state["rows"] + added)
        dealt_anew = not count or not self.buckets and grown >= 4 * count  # the table has outgrown its buckets
        if dealt_anew:
            count = state["count"] = self.buckets or grown
        delta = delta.withColumn(BUCKET, self.bucket(count))
        hit = {str(r[0]) for r in delta.select(BUCKET).distinct().collect()}  # at most the bucket count
        fold = set(state["buckets"]) if dealt_anew else {b for b in hit if len(state["buckets"].get(b, ())) + 1 > self.max_parts}
        moved = added
        if fold:  # these buckets start again with one file: what stays of them, and the delta
            moved += state["rows"] * len(fold) // max(1, len(state["buckets"]))
            kept = project(self.read(state, hidden=True, only=fold), full).join(touched, self.group, "left_anti").withColumn(BUCKET, self.bucket(count))
            delta = delta.unionByName(kept)
            if dealt_anew:
                hit, state["buckets"] = {str(r[0]) for r in delta.select(BUCKET).distinct().collect()}, {}
        n = max(1, min(len(hit), math.ceil(moved / PASS_ROWS)))
        passes = [delta.where(F.col(BUCKET) % n == i) for i in range(n)] if n > 1 else [delta]
        res = self.store.write_passes(self.layer, f"{self.name}__groups", [p.hint("rebalance", BUCKET) for p in passes], partition_by=[BUCKET])
        for b in sorted(hit):
            before = [] if b in fold else state["buckets"].get(b, [])
            state["buckets"][b] = [*before, [f"{res.path}/{BUCKET}={b}", number]]
        state["run"], state["rows"] = run, state["rows"] + added
        if id_col:
            top = self.store.spark.read.parquet(res.path).agg(F.max(id_col)).first()[0]
            state["top_id"] = max(state["top_id"], top or 0)
        return Change(state, res.rows_stored, [res.path])


def publish_changes(changes: dict[str, tuple[GroupedTable, Change]]) -> Callable[[dict], dict]:
    """The ``extra`` of a publish that makes the changes of several grouped
    tables of one layer current together; a table that another writer has
    changed meanwhile refuses."""
    def extra(now: dict) -> dict:
        groups = dict(now.get("groups", {}))
        for name, (_, change) in changes.items():
            run = groups.get(name, {}).get("run", 0)
            if change.written and run != change.state["run"] - 1:
                raise RuntimeError(f"{name}: another change was published meanwhile; change again")
            if change.state["schemas"]:
                groups[name] = change.state
        return {"groups": groups}

    return extra


def grouped(store: LayerStore, layer: str, name: str) -> GroupedTable:
    """The published grouped table of that name."""
    own = store.current(layer).get("groups", {}).get(name)
    if own is None:
        raise KeyError(f"{layer}.{name} is not published")
    return GroupedTable(store, layer, name, own["group"], own["count"])


def files_of(state: dict) -> set[str]:
    """The files of a state, for tests and reports of what a run wrote."""
    return {path for parts in state["buckets"].values() for path, _ in parts}


def parts_bound(state: dict) -> int:
    """The longest list of files that a bucket has."""
    return max((len(p) for p in state["buckets"].values()), default=0)


def buckets_for(rows: int) -> int:
    """A bucket count for a table of about ``rows`` rows, a power of two."""
    return max(MIN_BUCKETS, 1 << math.ceil(math.log2(max(1, rows / BUCKET_ROWS))))
