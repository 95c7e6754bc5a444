"""Tables that change together: one commit for review rows, cursors, high water and appended runs.

A commit writes its rows aside and then publishes one small file by a rename; readers see the last published file and what
it names, so a failure in between leaves the old state. Rows of a keyed table lie in leaves by the hash of their key. A commit
reads and rewrites only the leaves of its own keys, and a leaf that grows beyond ``leaf_rows`` is written as several, so a
commit's work is bounded by its keys, not by the history. Appended tables only get folders.
"""

from __future__ import annotations

import json
import math
import uuid
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

#: Commits that are kept for readers which began before the last one.
KEPT = 10


@dataclass
class Leaf:
    """Rows whose key's hash ends in ``suffix`` on its lowest ``depth`` bits, and the folder that holds them."""

    depth: int
    suffix: int
    folder: str
    rows: int


@dataclass
class Table:
    keys: list[str]
    schema: str
    leaves: list[Leaf] = field(default_factory=list)


@dataclass
class State:
    """What a commit publishes: keyed tables, folders of appended tables by id, and each writer's last batch."""

    version: int = 0
    tables: dict[str, Table] = field(default_factory=dict)
    appended: dict[str, dict[str, str]] = field(default_factory=dict)
    schemas: dict[str, str] = field(default_factory=dict)
    applied: dict[str, int] = field(default_factory=dict)

    def dumps(self) -> str:
        tables = {k: {"keys": t.keys, "schema": t.schema, "leaves": [[x.depth, x.suffix, x.folder, x.rows] for x in t.leaves]} for k, t in self.tables.items()}
        return json.dumps({"version": self.version, "tables": tables, "appended": self.appended, "schemas": self.schemas, "applied": self.applied})

    @staticmethod
    def loads(text: str) -> State:
        x = json.loads(text)
        tables = {k: Table(t["keys"], t["schema"], [Leaf(*v) for v in t["leaves"]]) for k, t in x["tables"].items()}
        return State(x["version"], tables, x["appended"], x["schemas"], x["applied"])


def key_hash(keys: list[str]) -> Column:
    return F.xxhash64(*[F.col(k) for k in keys])


class Store:
    """Tables under ``path``, a folder of any file system that Spark knows. One writer at a time; any number of readers."""

    def __init__(self, spark: SparkSession, path: str, *, leaf_rows: int = 1_000_000):
        self.spark, self.path, self.leaf_rows = spark, path, leaf_rows

    # files, by Hadoop's own file systems

    def _at(self, name: str):
        return self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}")

    def _files(self):
        return self._at("commits").getFileSystem(self.spark._jsc.hadoopConfiguration())

    def versions(self) -> list[int]:
        files, folder = self._files(), self._at("commits")
        names = [x.getPath().getName() for x in files.listStatus(folder)] if files.exists(folder) else []
        return sorted(int(n[:-5]) for n in names if n.endswith(".json"))

    def state(self, version: int | None = None) -> State:
        """The last published state, or that of a kept version."""
        there = self.versions()
        if version is None and not there:
            return State()
        rows = self.spark.read.text(f"{self.path}/commits/{(there[-1] if version is None else version):012d}.json", wholetext=True).collect()
        return State.loads(rows[0][0])

    def publish(self, state: State) -> None:
        """Make ``state`` the last one: written under another name, then renamed; an existing version is an error."""
        files, target, aside = self._files(), self._at(f"commits/{state.version:012d}.json"), self._at(f"commits/.{uuid.uuid4().hex}")
        out = files.create(aside, False)
        out.write(bytearray(state.dumps().encode()))
        out.close()
        if files.exists(target) or not files.rename(aside, target):
            files.delete(aside, False)
            raise RuntimeError(f"version {state.version} is there already: another writer was faster")
        for old in self.versions()[:-KEPT]:
            files.delete(self._at(f"commits/{old:012d}.json"), False)

    # reading

    def _leaves(self, table: Table, leaves: list[Leaf]) -> DataFrame:
        schema = StructType.fromDDL(table.schema)
        if not leaves:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(*[f"{self.path}/{x.folder}" for x in leaves])

    def read(self, name: str, state: State | None = None) -> DataFrame:
        """All rows of a table, keyed or appended (these with the ``commit_id`` they were appended under)."""
        state = state or self.state()
        if name in state.tables:
            return self._leaves(state.tables[name], state.tables[name].leaves)
        schema = StructType.fromDDL(state.schemas[name] + ", commit_id string")
        folders = [f"{self.path}/{name}/{folder}" for folder in state.appended[name].values()]
        return self.spark.read.schema(schema).parquet(*folders) if folders else self.spark.createDataFrame([], schema)

    def _touched(self, table: Table, keys: DataFrame) -> dict[int, int]:
        """Place of each leaf that has keys of ``keys``: how many. One row a leaf comes to the driver."""
        found = keys.withColumn("_leaf", self._leaf_of(table)).groupBy("_leaf").count().collect()
        return {r["_leaf"]: r["count"] for r in found}

    def _leaf_of(self, table: Table) -> Column:
        """Place of the row's leaf in the table's list: one comparison a depth that the leaves have, and a lookup of the suffix."""
        h = key_hash(table.keys)
        out = F.lit(None).cast("int")
        for depth in sorted({x.depth for x in table.leaves}):
            places = {x.suffix: k for k, x in enumerate(table.leaves) if x.depth == depth}
            names = F.map_from_arrays(F.lit(list(places)).cast("array<long>"), F.lit(list(places.values())).cast("array<int>"))
            out = F.coalesce(out, F.try_element_at(names, h.bitwiseAND((1 << depth) - 1)))
        return out

    def lookup(self, name: str, keys: DataFrame) -> DataFrame:
        """The table's rows for the given keys; only their leaves are read."""
        table = self.state().tables[name]
        leaves = [table.leaves[k] for k in self._touched(table, keys.select(*table.keys))]
        return self._leaves(table, leaves).join(keys.select(*table.keys).distinct(), table.keys, "left_semi")

    # writing

    def _upsert(self, name: str, table: Table, rows: DataFrame, write: str, newer: str | None = None) -> Table:
        """Rewrite the leaves that ``rows`` (one a key) fall into. ``first_seen_at`` of a known key stays as it was; with
        ``newer``, so does a row whose value of that column is greater than the new one's."""
        table = Table(table.keys, table.schema, table.leaves or [Leaf(0, 0, "", 0)])
        touched = self._touched(table, rows)
        if not touched:
            return table
        old = self._leaves(table, [table.leaves[k] for k in touched if table.leaves[k].rows])
        columns = StructType.fromDDL(table.schema).fieldNames()
        kept = [c for c in ("first_seen_at", newer) if c in columns]
        if kept:
            rows = rows.join(old.select(*table.keys, *[F.col(c).alias(f"_old_{c}") for c in kept]), table.keys, "left")
        if newer:
            rows = rows.filter(F.coalesce(F.col(f"_old_{newer}") <= F.col(newer), F.lit(True)))
        if "first_seen_at" in kept:
            rows = rows.withColumn("first_seen_at", F.coalesce("_old_first_seen_at", "first_seen_at"))
        rows = rows.select(*columns)
        merged = old.join(rows.select(*table.keys), table.keys, "left_anti").unionByName(rows)
        depths = {k: table.leaves[k].depth + max(0, math.ceil(math.log2((table.leaves[k].rows + n) / self.leaf_rows))) for k, n in touched.items()}
        deepest = F.element_at(F.map_from_arrays(F.lit(list(depths)).cast("array<int>"), F.lit(list(depths.values())).cast("array<int>")), self._leaf_of(table))
        leaf = F.concat_ws("-", deepest, key_hash(table.keys).bitwiseAND(F.expr("1L") * F.pow(F.lit(2.0), deepest).cast("long") - 1))
        merged.withColumn("leaf", leaf).repartition("leaf").write.partitionBy("leaf").parquet(f"{self.path}/{name}/{write}")
        counted = self.spark.read.parquet(f"{self.path}/{name}/{write}").groupBy("leaf").count().collect()
        counts = {r["leaf"]: r["count"] for r in counted}
        leaves = [x for k, x in enumerate(table.leaves) if k not in touched]
        for k, depth in depths.items():
            old_leaf = table.leaves[k]
            for high in range(1 << (depth - old_leaf.depth)):
                suffix = high << old_leaf.depth | old_leaf.suffix
                named = f"{depth}-{suffix}"
                leaves.append(Leaf(depth, suffix, f"{name}/{write}/leaf={named}" if named in counts else "", counts.get(named, 0)))
        return Table(table.keys, table.schema, leaves)

    def commit(self, writer: str, batch_id: int, *, upserts: dict[str, tuple] | None = None, appends: dict[str, DataFrame] | None = None) -> bool:
        """Publish a batch's upserts (name: rows with at most one a key, keys, and the column by which stored rows may be newer,
        if there is one) and appended rows together.

        False if the writer's batch of that number or a later one is there already: a repeated batch changes nothing.
        """
        state = self.state()
        if state.applied.get(writer, -1) >= batch_id:
            return False
        write = uuid.uuid4().hex
        for name, (rows, keys, *newer) in (upserts or {}).items():
            table = state.tables.get(name) or Table(keys, rows.schema.simpleString()[7:-1])
            if table.keys != keys:
                raise ValueError(f"{name} has the keys {table.keys}")
            state.tables[name] = self._upsert(name, table, rows, write, *newer)
        for name, rows in (appends or {}).items():
            self._append(state, name, f"{writer}-{batch_id}", rows, write)
        state.applied[writer] = batch_id
        state.version += 1
        self.publish(state)
        return True

    def _append(self, state: State, name: str, ident: str, rows: DataFrame, write: str) -> None:
        if ident in state.appended.setdefault(name, {}):
            raise ValueError(f"{name} has {ident} already")
        state.schemas.setdefault(name, rows.schema.simpleString()[7:-1])
        rows.withColumn("commit_id", F.lit(ident)).write.parquet(f"{self.path}/{name}/{write}")
        state.appended[name][ident] = write

    def append(self, name: str, ident: str, rows: DataFrame) -> None:
        """Publish rows under an id of their own, such as a run's; an id that is there already is an error."""
        state = self.state()
        self._append(state, name, ident, rows, uuid.uuid4().hex)
        state.version += 1
        self.publish(state)

    def vacuum(self) -> int:
        """Delete folders that no kept version names; returns their number. Not while a commit is being written."""
        files = self._files()
        states = [self.state(v) for v in self.versions()]
        used = {x.folder.rsplit("/", 1)[0] for s in states for t in s.tables.values() for x in t.leaves if x.folder}
        used |= {f"{name}/{folder}" for s in states for name, ids in s.appended.items() for folder in ids.values()}
        gone = 0
        for top in files.listStatus(self._at("")) if files.exists(self._at("")) else []:
            name = top.getPath().getName()
            for x in files.listStatus(top.getPath()) if top.isDirectory() and name != "commits" else []:
                if f"{name}/{x.getPath().getName()}" not in used:
                    files.delete(x.getPath(), True)
                    gone += 1
        return gone
