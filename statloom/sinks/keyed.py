"""Tables with a primary key: insert, upsert, update and delete, as frames and as stored tables.

The frame operators are plain joins on the key. The stored form keeps its rows in buckets, by a hash of the key. A change
adds a small part beside the rows of the buckets it touches; readers let the newest part win, and parts that have grown
against their bucket are merged into it. What belongs to the table is said by numbered commits, each one file that
appears whole or not at all, so writers can work at the same time and a reader sees one version from start to end.
"""

from __future__ import annotations

import json
import os
import uuid
from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce
from itertools import product
from operator import or_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from statloom.functions.columns import col
from statloom.operators.prepare import duplicate_keys, keep_latest


def no_null_keys(rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The rows, failing when they are read if a key is null: a null equals nothing, so it would never be replaced."""
    missing = reduce(or_, [col(k).isNull() for k in keys])
    text = F.lit(f"null in the key {', '.join(keys)}")
    kind = rows.schema[keys[0]].dataType
    return rows.withColumn(keys[0], F.when(missing, F.raise_error(text).cast(kind)).otherwise(col(keys[0])))


# -- on frames -------------------------------------------------------------------------------------------------

def one_per_key(changes: DataFrame, keys: Sequence[str], order: Sequence[str] = ()) -> DataFrame:
    """The last change of each key by ``order`` (ties by the other columns)."""
    return keep_latest(no_null_keys(changes, keys), keys, order)


def upsert(target: DataFrame, changes: DataFrame, keys: Sequence[str], order: Sequence[str] = ()) -> DataFrame:
    """Replace rows whose key is among the changes, add the rest of the changes."""
    return _upsert(target, one_per_key(changes, keys, order), keys)


def _upsert(target: DataFrame, last: DataFrame, keys: Sequence[str]) -> DataFrame:
    return delete(target, last, keys).unionByName(last)


def insert(target: DataFrame, rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Add rows; fails when a key exists already or comes twice."""
    rows = no_null_keys(rows, keys)
    if not duplicate_keys(rows, keys).isEmpty():
        raise ValueError(f"duplicate key among the new rows: {', '.join(keys)}")
    if not target.select(*[col(k) for k in keys]).join(rows, list(keys), "left_semi").isEmpty():
        raise ValueError(f"key exists already: {', '.join(keys)}")
    return target.unionByName(rows)


def update(target: DataFrame, changes: DataFrame, keys: Sequence[str], order: Sequence[str] = ()) -> DataFrame:
    """Replace rows whose key is among the changes; changes to unknown keys have no effect."""
    return _update(target, one_per_key(changes, keys, order), keys)


def _update(target: DataFrame, last: DataFrame, keys: Sequence[str]) -> DataFrame:
    known = last.join(target.select(*[col(k) for k in keys]), list(keys), "left_semi")
    return delete(target, last, keys).unionByName(known)


def delete(target: DataFrame, gone: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Remove rows whose key is listed."""
    return target.join(gone.select(*[col(k) for k in keys]), list(keys), "left_anti")


# -- on stored tables ------------------------------------------------------------------------------------------

BUCKET, PART, GONE = "__bucket", "__part", "__gone"  # hash of the key modulo the buckets; the write; whether it deletes
ROWS_PER_BUCKET = 1_000_000
RATIO, PARTS = 0.5, 8  # a bucket is merged when its changes exceed this share of its rows, or this number of parts
FULL = 16  # every so many commits the whole state is written down, so that readers need not go back further


class Conflict(RuntimeError):
    """Another change to the same bucket was committed first."""


@dataclass(frozen=True)
class Store:
    """A stored table: where it lies, its key, its columns."""

    spark: SparkSession
    root: str
    keys: tuple[str, ...]
    buckets: int
    ddl: str

    # What belongs to the table. A state maps a bucket to its parts, oldest first: [part, version, rows, is_base].

    def versions(self) -> list[int]:
        return sorted(int(n.split(".")[0]) for n in _listed(self.spark, f"{self.root}/log") if n.endswith(".json") and "-" not in n)

    def commit_of(self, version: int) -> dict:
        return json.loads(_text(self.spark, f"{self.root}/log/{version:012d}.json"))

    def state(self, version: int | None = None) -> tuple[int, dict[int, list]]:
        """The newest version, or the given one, and its state."""
        names = _listed(self.spark, f"{self.root}/log")
        known = sorted(int(n.split(".")[0]) for n in names if n.endswith(".json") and "-" not in n)
        if version is not None and version not in known:
            raise ValueError(f"no version {version} of the table at {self.root}")
        last = known[-1] if version is None else version
        full = max((int(n.split("-")[0]) for n in names if n.endswith("-full.json") and int(n.split("-")[0]) <= last), default=None)
        state: dict[int, list] = {}
        if full is not None:
            state = {int(b): parts for b, parts in json.loads(_text(self.spark, f"{self.root}/log/{full:012d}-full.json")).items()}
        for v in known:
            if v <= last and (full is None or v > full):
                _apply(state, v, self.commit_of(v))
        return last, state

    def commit(self, seen: int, change: dict, strict: bool) -> int:
        """Append a commit made from version ``seen`` and return its number.

        Whoever creates the file of a number first has it. A writer that comes second looks at what was committed: a
        strict change (one that rests on the rows it has read) is refused if a bucket of its own is among it, others
        take the next number and thus win over it. Merges leave the rows as they are, so they conflict among themselves only.
        """
        mine = {int(b) for b in change["rows"]}
        version = seen
        while True:
            version += 1
            if _create(self.spark, f"{self.root}/log/{version:012d}.json", json.dumps(change)):
                break
            other = self.commit_of(version)
            alike = (other["merged"] is None) == (change["merged"] is None)
            if strict and alike and mine & {int(b) for b in other["rows"]}:
                raise Conflict(f"version {version} of {self.root} changes the same buckets")
        if version % FULL == 0:
            _create(self.spark, f"{self.root}/log/{version:012d}-full.json", json.dumps(self.state(version)[1]))
        return version

    # Rows.

    @property
    def columns(self) -> dict[str, T.DataType]:
        return {f.name: f.dataType for f in T.StructType.fromDDL(self.ddl).fields}

    def write(self, rows: DataFrame, part: str, base: bool = False) -> dict[int, int]:
        """Write rows with ``GONE`` as a part, a folder per bucket sorted by key, and count them per bucket.

        Base rows are dealt to a task per bucket; of changes, Spark puts small buckets together.
        """
        placed = rows.withColumn(BUCKET, _bucket(self.keys, self.buckets))
        dealt = placed.repartition(self.buckets, BUCKET) if base else placed.repartition(BUCKET)
        (dealt.sortWithinPartitions(BUCKET, *[col(k) for k in self.keys])
         .write.partitionBy(BUCKET).parquet(f"{self.root}/data/{PART}={part}"))
        made = [n for n in _listed(self.spark, f"{self.root}/data/{PART}={part}") if n.startswith(f"{BUCKET}=")]
        written = self.read([(int(n.split("=")[1]), part) for n in made])
        return {r[BUCKET]: r["count"] for r in written.groupBy(BUCKET).count().collect()} if made else {}

    def read(self, places: Sequence[tuple[int, str]]) -> DataFrame:
        """The rows of (bucket, part) folders, with ``PART``, ``BUCKET`` and ``GONE``."""
        schema = f"{self.ddl}, `{GONE}` BOOLEAN, `{PART}` STRING, `{BUCKET}` INT"
        if not places:
            return self.spark.createDataFrame([], schema)
        paths = [f"{self.root}/data/{PART}={part}/{BUCKET}={bucket}" for bucket, part in places]
        return self.spark.read.schema(schema).option("basePath", f"{self.root}/data").parquet(*paths)

    def rows(self, state: Mapping[int, list], where: Column | None = None) -> DataFrame:
        """The merged rows of a state. Buckets without changes are only read; in the others, base rows whose key is among
        the changes are left out, and of the changes to a key the newest counts. ``where`` restricts keys at the scan."""
        def kept(df: DataFrame) -> DataFrame:
            return df if where is None else df.where(where)

        def base_of(changed: bool) -> DataFrame:
            return kept(self.read([(b, p[0]) for b, parts in state.items() for p in parts if p[3] and (len(parts) > 1) == changed]))

        names = list(self.columns)
        newer = {p[0]: p[1] for parts in state.values() for p in parts if not p[3]}
        clean = base_of(False).select(*[col(c) for c in names])
        if not newer:
            return clean
        order = F.map_from_arrays(F.array(*[F.lit(p) for p in newer]), F.array(*[F.lit(v) for v in newer.values()]))
        changes = kept(self.read([(b, p[0]) for b, parts in state.items() for p in parts if not p[3]]))
        changes = changes.withColumn("__version", F.element_at(order, col(PART))).drop(PART, BUCKET)
        last = keep_latest(changes, self.keys, ["__version"])
        old = base_of(True).join(last.select(*[col(k) for k in self.keys]), list(self.keys), "left_anti")
        return clean.unionByName(old.select(*[col(c) for c in names])).unionByName(last.where(~col(GONE)).select(*[col(c) for c in names]))


def _apply(state: dict[int, list], version: int, commit: dict) -> None:
    for name, rows in commit["rows"].items():
        bucket = int(name)
        if commit["merged"] is None:
            state.setdefault(bucket, []).append([commit["part"], version, rows, commit["base"]])
        else:  # parts up to the version that was read are replaced; later ones stay
            later = [p for p in state.get(bucket, []) if p[1] > commit["merged"]]
            state[bucket] = ([[commit["part"], commit["merged"], rows, True]] if rows else []) + later


def _files(spark: SparkSession, path: str):
    """The file system of a path, and the path as it wants it."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()), where


def _listed(spark: SparkSession, path: str) -> list[str]:
    files, where = _files(spark, path)
    return [f.getPath().getName() for f in files.listStatus(where)] if files.exists(where) else []


def _text(spark: SparkSession, path: str) -> str:
    files, where = _files(spark, path)
    stream = files.open(where)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def _create(spark: SparkSession, path: str, text: str) -> bool:
    """Write a file that appears whole, unless one of that name exists; tells whether it was written.

    It is written beside and then given its name, by a rename, which fails where the name is taken, on the file systems
    of clusters, and by a link on a local one, where a rename would replace.
    """
    files, where = _files(spark, path)
    _, beside = _files(spark, f"{os.path.dirname(path)}/_{uuid.uuid4().hex}")
    stream = files.create(beside, True)
    stream.write(bytearray(text.encode()))
    stream.close()
    try:
        if files.getScheme() != "file":
            return files.rename(beside, where)
        os.link(beside.toUri().getPath(), where.toUri().getPath())
        return True
    except FileExistsError:
        return False
    finally:
        files.delete(beside, False)


def drop_table(spark: SparkSession, table: str, purge: bool = False) -> bool:
    """Drop a table if it exists; tells whether it did. ``purge`` also removes the folder of a table stored at a path
    of its own, which a plain drop leaves."""
    if not spark.catalog.tableExists(table):
        return False
    described = {r["col_name"]: r["data_type"] for r in spark.sql(f"DESCRIBE TABLE EXTENDED {table}").collect()}
    view = described.get("Type") == "VIEW"
    folder = _properties(spark, table).get("keyed.root") if view else described.get("Location")
    if purge and folder and (view or described.get("Type") == "EXTERNAL"):
        files, where = _files(spark, folder)
        files.delete(where, True)
    spark.sql(f"DROP {'VIEW' if view else 'TABLE'} IF EXISTS {table}")
    return True


def _properties(spark: SparkSession, table: str) -> dict[str, str]:
    return {r["key"]: r["value"] for r in spark.sql(f"SHOW TBLPROPERTIES {table}").collect()}


def _bucket(keys: Sequence[str], buckets: int) -> Column:
    return F.pmod(F.xxhash64(*[col(k) for k in keys]), F.lit(buckets)).cast("int")


def create_keyed(df: DataFrame, table: str, keys: Sequence[str], path: str, buckets: int | None = None) -> None:
    """Store the rows of ``df`` below ``path`` as a table with a key, its rows in buckets by a hash of it.

    Fails when a key is null or comes twice, or when the table exists. By default a bucket is made for every
    ``ROWS_PER_BUCKET`` rows. The catalog gets a view of that name, which shows the columns and tells to use
    ``read_keyed`` when it is queried: plain SQL would not merge the changes.
    """
    spark, root = df.sparkSession, path.rstrip("/")
    df = no_null_keys(df, keys)
    if not duplicate_keys(df, keys).isEmpty():
        raise ValueError(f"duplicate key: {', '.join(keys)}")
    buckets = buckets or max(1, -(-df.count() // ROWS_PER_BUCKET))
    ddl = ", ".join(f"`{f.name.replace('`', '``')}` {f.dataType.simpleString()}" for f in df.schema.fields)
    properties = {"keyed.root": root, "keyed.keys": json.dumps(list(keys)), "keyed.buckets": str(buckets), "keyed.columns": ddl}
    listed = ", ".join("'{}' = '{}'".format(k, v.replace("'", "\\'")) for k, v in properties.items())
    columns = ", ".join(f"CAST(NULL AS {f.dataType.simpleString()}) AS `{f.name.replace('`', '``')}`" for f in df.schema.fields)
    spark.sql(f"CREATE VIEW {table} TBLPROPERTIES ({listed}) AS SELECT {columns} "
              f"WHERE raise_error('read this table with read_keyed') IS NOT NULL")
    try:
        store, part = open_keyed(spark, table), _new_part()
        rows = store.write(df.withColumn(GONE, F.lit(False)), part, base=True)
        store.commit(0, {"part": part, "rows": rows, "base": True, "merged": None}, strict=True)
    except Exception:
        spark.sql(f"DROP VIEW {table}")
        raise


def _new_part() -> str:
    return f"p{uuid.uuid4().hex}"


def open_keyed(spark: SparkSession, table: str) -> Store:
    found = _properties(spark, table)
    if "keyed.keys" not in found:
        raise ValueError(f"{table} has no key")
    return Store(spark, found["keyed.root"], tuple(json.loads(found["keyed.keys"])), int(found["keyed.buckets"]), found["keyed.columns"])


def key_of(spark: SparkSession, table: str) -> tuple[list[str], int]:
    """Key columns and bucket count of a stored table."""
    store = open_keyed(spark, table)
    return list(store.keys), store.buckets


def change_keyed(spark: SparkSession, table: str, changes: DataFrame, how: str = "upsert", order: Sequence[str] = (),
                 merge: bool = True) -> list[int]:
    """Apply changes to a stored table and return the buckets touched. ``how``: "upsert", "insert", "update" or "delete".

    The changes are computed once and written as a part, about as many rows as change; the table has them when the
    commit is there, so a failed write leaves it as it was. Upserts and deletes read nothing of the table and never
    conflict: what is committed later wins. Inserts and updates read the keys of the touched buckets and raise
    ``Conflict`` when another change to one of these was committed meanwhile. With ``merge``, buckets whose changes have
    outgrown ``RATIO`` of their rows or ``PARTS`` parts are then merged.
    """
    if how not in ("upsert", "insert", "update", "delete"):
        raise ValueError(f"how must be 'upsert', 'insert', 'update' or 'delete', not {how!r}")
    store = open_keyed(spark, table)
    kinds = store.columns
    changes = no_null_keys(changes, store.keys).withColumns({k: col(k).cast(kinds[k]) for k in store.keys})
    if how == "delete":
        rows = changes.select(*[col(k) for k in store.keys]).distinct()
        rows = rows.withColumns({c: F.lit(None).cast(t) for c, t in kinds.items() if c not in store.keys})
    elif how == "insert":
        rows = changes
    else:
        rows = keep_latest(changes, store.keys, order)
    seen, state = store.state()
    part = _new_part()
    try:
        counts = store.write(rows.select(*[col(c) for c in kinds], F.lit(how == "delete").alias(GONE)), part)
        if how in ("insert", "update"):
            written = store.read([(b, part) for b in counts])
            known = store.rows({b: state[b] for b in counts if b in state}).select(*[col(k) for k in store.keys])
            if how == "insert":
                if not duplicate_keys(written, store.keys).isEmpty():
                    raise ValueError(f"duplicate key among the new rows: {', '.join(store.keys)}")
                if not known.join(written, list(store.keys), "left_semi").isEmpty():
                    raise ValueError(f"key exists already: {', '.join(store.keys)}")
            else:
                first, part = part, _new_part()
                counts = store.write(written.join(known, list(store.keys), "left_semi").drop(PART, BUCKET), part)
                _remove(spark, f"{store.root}/data/{PART}={first}")
        if counts:
            store.commit(seen, {"part": part, "rows": counts, "base": False, "merged": None}, strict=how in ("insert", "update"))
        else:
            _remove(spark, f"{store.root}/data/{PART}={part}")
    except Exception:
        _remove(spark, f"{store.root}/data/{PART}={part}")
        raise
    if merge:
        merge_keyed(spark, table)
    return sorted(counts)


def due(state: Mapping[int, list], ratio: float = RATIO, parts: int = PARTS) -> list[int]:
    """The buckets whose changes have outgrown them."""
    found = []
    for bucket, listed in state.items():
        base = sum(p[2] for p in listed if p[3])
        newer = [p[2] for p in listed if not p[3]]
        if newer and (sum(newer) > ratio * base or len(newer) > parts):
            found.append(bucket)
    return sorted(found)


def merge_keyed(spark: SparkSession, table: str, ratio: float = RATIO, parts: int = PARTS) -> list[int]:
    """Merge the changes of the buckets that are due into their rows; ``ratio=0`` merges all that have changes.

    Changes committed meanwhile stay beside the merged rows. Where another merge was first, this one is given up.
    """
    store = open_keyed(spark, table)
    seen, state = store.state()
    touched = due(state, ratio, parts)
    if not touched:
        return []
    part = _new_part()
    rows = store.rows({b: state[b] for b in touched})
    counts = store.write(rows.withColumn(GONE, F.lit(False)), part, base=len(touched) == store.buckets)
    try:
        store.commit(seen, {"part": part, "rows": {b: counts.get(b, 0) for b in touched}, "base": True, "merged": seen}, strict=True)
    except Conflict:
        _remove(spark, f"{store.root}/data/{PART}={part}")
        return []
    return touched


def clean_keyed(spark: SparkSession, table: str, keep: int = 1) -> int:
    """Remove the parts that none of the newest ``keep`` versions names; readers of older versions fail then.

    Run it while nothing else changes the table: a part that is written but not yet committed would go too. Returns the
    number of parts removed.
    """
    store = open_keyed(spark, table)
    needed = {p[0] for v in store.versions()[-keep:] for parts in store.state(v)[1].values() for p in parts}
    gone = [n for n in _listed(spark, f"{store.root}/data") if n.startswith(f"{PART}=") and n.split("=", 1)[1] not in needed]
    for name in gone:
        _remove(spark, f"{store.root}/data/{name}")
    return len(gone)


def _remove(spark: SparkSession, path: str) -> None:
    files, where = _files(spark, path)
    files.delete(where, True)


def read_keyed(spark: SparkSession, table: str, where: Mapping[str, Sequence] | None = None, version: int | None = None) -> DataFrame:
    """The rows of the newest or the given version.

    ``where`` lists values for every key column and reads only the buckets that can hold such keys, with the values
    pushed to the scan, where the rows of a bucket are sorted by key. A frame stays at the version it was made from.
    """
    store = open_keyed(spark, table)
    _, state = store.state(version)
    if where is None:
        return store.rows(state)
    if set(where) != set(store.keys):
        raise ValueError(f"values for {', '.join(store.keys)} are needed, not for {', '.join(where)}")
    wanted = list(product(*[list(dict.fromkeys(where[k])) for k in store.keys]))
    if not wanted:
        return store.rows({})
    kinds = store.columns
    listed = spark.createDataFrame([tuple(w) for w in wanted], ", ".join(f"`{k}` {kinds[k].simpleString()}" for k in store.keys))
    buckets = {r[0] for r in listed.select(_bucket(store.keys, store.buckets)).distinct().collect()}
    condition = reduce(lambda a, b: a & b, [col(k).isin(list(where[k])) for k in store.keys])
    return store.rows({b: state[b] for b in buckets if b in state}, condition)


def find_keyed(spark: SparkSession, table: str, wanted: DataFrame, version: int | None = None) -> DataFrame:
    """The rows whose key is among those of ``wanted``: only the buckets that can hold one are read."""
    store = open_keyed(spark, table)
    _, state = store.state(version)
    kinds = store.columns
    wanted = wanted.select(*[col(k).cast(kinds[k]).alias(k) for k in store.keys]).distinct()
    buckets = {r[0] for r in wanted.select(_bucket(store.keys, store.buckets)).distinct().collect()}  # at most all of them
    return store.rows({b: state[b] for b in buckets if b in state}).join(wanted, list(store.keys), "left_semi")
