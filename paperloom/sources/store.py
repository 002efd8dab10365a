"""Tables as Parquet folders: upserts, deletes, state.  A write goes to new folders, then one small manifest appears beside the others.

A manifest ``v-000000000007.json`` names the folders of its version; the greatest number is the present one.  Manifests are renamed
into place and never replaced, so a reader always finds a whole version, a failed write leaves none, and of two writers that
began from one version the second fails.  Folders of old versions stay until ``vacuum``, so a reader that has begun keeps its version.

Rows lie in buckets by the hash of their key.  An upsert reads and rewrites only the buckets that its keys fall into.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from paperloom.session import bounded_rows

BUCKETS, MAX_BUCKETS = 16, 100_000


def last_rows(df: DataFrame, key: str, order: str | None = None) -> DataFrame:
    """One row per key: that of the greatest ``order``; of equal ones, or without an order, the greatest by all columns.

    Partial aggregation, so a key that holds a third of the rows is reduced before it is shuffled.
    """
    cols = df.columns
    first = [order] if order else []
    at = F.struct(*[F.col(c).alias(f"k{i}") for i, c in enumerate([*first, *(c for c in cols if c not in first and _sortable(df, c))])])
    return df.groupBy(F.col(key).alias("key_")).agg(F.max_by(F.struct(*cols), at).alias("r")).select("r.*")


def _sortable(df: DataFrame, c: str) -> bool:
    return not dict(df.dtypes)[c].startswith(("map", "variant"))


def upsert(stored: DataFrame, new: DataFrame, key: str = "source_id", order: str | None = None) -> DataFrame:
    """Rows of new replace stored rows of the same key; of several rows of one key in new the last by ``order`` counts (see ``last_rows``).

    Null keys: those of new are one row, stored ones stay.  Columns of new that are not stored are left out.
    """
    cols = stored.columns
    last = last_rows(new.select(*cols), key, order).select(*cols)
    return stored.join(new.select(key).distinct(), key, "left_anti").select(*cols).unionByName(last)


def anti_insert(stored: DataFrame, new: DataFrame, key: str = "source_id") -> DataFrame:
    """Stored rows, and those of new whose key is not stored."""
    return stored.unionByName(new.join(stored.select(key).distinct(), key, "left_anti").select(*stored.columns))


def with_ids(df: DataFrame, id_col: str, order: str, start: int = 0) -> DataFrame:
    """Consecutive ids in the order of a column: a range partitioning, the partitions' sizes, and a number within each."""
    from pyspark.sql import Window

    parts = df.repartitionByRange(F.col(order)).withColumn("p_", F.spark_partition_id())
    n = parts.groupBy("p_").agg(F.count("*").alias("n_"))
    off = n.withColumn("o_", F.coalesce(F.sum("n_").over(Window.orderBy("p_").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))).select("p_", "o_")
    x = parts.join(F.broadcast(off), "p_")
    return x.withColumn(id_col, F.col("o_") + F.row_number().over(Window.partitionBy("p_").orderBy(order)) + start).drop("p_", "o_")


class Folder:
    """Small text files under one folder of whatever file system the session knows."""

    def __init__(self, spark: SparkSession, root: str):
        self.root = root.rstrip("/")
        self._jvm = spark.sparkContext._jvm
        self._fs = self._path("").getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def _path(self, name: str):
        return self._jvm.org.apache.hadoop.fs.Path(f"{self.root}/{name}" if name else self.root)

    def names(self, folder: str = "") -> list[str]:
        p = self._path(folder)
        return sorted(f.getPath().getName() for f in self._fs.listStatus(p)) if self._fs.exists(p) else []

    def text(self, name: str) -> str:
        s = self._fs.open(self._path(name))
        try:
            return self._jvm.org.apache.commons.io.IOUtils.toString(s, "UTF-8")
        finally:
            s.close()

    def put_new(self, name: str, text: str) -> None:
        """Appears whole or not at all; fails where the name is taken."""
        q, p = self._path(name), self._path(f"{name}.{uuid.uuid4().hex}.tmp")
        self._fs.mkdirs(q.getParent())
        out = self._fs.create(p, False)
        out.write(bytearray(text.encode()))
        out.close()
        if self._fs.exists(q) or not self._fs.rename(p, q):
            self._fs.delete(p, False)
            raise FileExistsError(f"another writer was faster: {name}")

    def remove(self, name: str) -> None:
        self._fs.delete(self._path(name), True)


class Store:
    """Named tables under one folder.  buckets: into how many parts new tables are divided; big tables need as many as fit their upserts."""

    def __init__(self, spark: SparkSession, root: str, buckets: int = BUCKETS):
        self.spark, self.root, self.buckets = spark, root.rstrip("/"), buckets
        self._files = Folder(spark, root)

    def _versions(self, name: str) -> list[int]:
        return [int(n[2:-5]) for n in self._files.names(name) if n.startswith("v-") and n.endswith(".json")]

    def _current(self, name: str) -> dict | None:
        """The present manifest: version, buckets, key, parts (bucket -> folder)."""
        v = max(self._versions(name), default=None)
        return None if v is None else json.loads(self._files.text(f"{name}/v-{v:012d}.json")) | {"version": v}

    def exists(self, name: str) -> bool:
        return self._current(name) is not None

    def read(self, name: str) -> DataFrame:
        m = self._current(name)
        if m is None:
            raise FileNotFoundError(f"no table {name}")
        return self._rows(name, m)

    def _rows(self, name: str, m: dict, buckets: Sequence[int] | None = None) -> DataFrame:
        from pyspark.sql.types import StructType

        schema = StructType.fromJson(m["schema"])
        parts = [f for b, f in m["parts"].items() if buckets is None or int(b) in buckets]
        if not parts:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(*[f"{self.root}/{name}/{f}" for f in parts])

    def _commit(self, name: str, df: DataFrame, m: dict | None, key: str | None, touched: Sequence[int] | None = None) -> None:
        """Writes the rows as new folders of their buckets; buckets that are not touched keep theirs."""
        n = m["buckets"] if m else self.buckets
        folder = uuid.uuid4().hex
        bucket = F.pmod(F.xxhash64(key), F.lit(n)).cast("int") if key else F.lit(0)
        df.withColumn("bucket_", bucket).write.partitionBy("bucket_").parquet(f"{self.root}/{name}/{folder}")
        new = {d[8:]: f"{folder}/{d}" for d in self._files.names(f"{name}/{folder}") if d.startswith("bucket_=")}
        kept = {b: f for b, f in m["parts"].items() if int(b) not in touched} if m and touched is not None else {}
        version = m["version"] + 1 if m else 1
        self._files.put_new(f"{name}/v-{version:012d}.json", json.dumps({"buckets": n, "key": key, "schema": json.loads(df.schema.json()), "parts": kept | new}))

    def write(self, name: str, df: DataFrame, key: str | None = None) -> None:
        """Replaces the table."""
        m = self._current(name)
        self._commit(name, df, m, key if key or not m else m["key"])

    def _merge(self, name: str, new: DataFrame, key: str, merge) -> None:
        m = self._current(name)
        if m is None:
            self._commit(name, merge(new.limit(0), new), None, key)
        elif m["key"] != key:  # its buckets say nothing about this key
            self._commit(name, merge(self._rows(name, m), new), m, key)
        else:
            hit = new.select(F.pmod(F.xxhash64(key), F.lit(m["buckets"])).cast("int").alias("b")).distinct()
            touched = sorted(r["b"] for r in bounded_rows(hit, MAX_BUCKETS, "buckets"))
            self._commit(name, merge(self._rows(name, m, touched), new), m, key, touched)

    def upsert(self, name: str, new: DataFrame, key: str = "source_id", order: str | None = None) -> None:
        self._merge(name, new, key, lambda old, x: upsert(old, x, key, order))

    def append_new(self, name: str, new: DataFrame, key: str = "source_id", order: str | None = None) -> None:
        self._merge(name, new, key, lambda old, x: anti_insert(old, last_rows(x, key, order), key))

    def delete(self, name: str, where: Column) -> None:
        self.write(name, self.read(name).filter(~F.coalesce(where, F.lit(False))))

    def clear(self, name: str) -> None:
        if self.exists(name):
            self.write(name, self.read(name).limit(0))

    def vacuum(self, name: str, keep: int = 2) -> None:
        """Removes what only versions before the last ``keep`` use; readers of those must have ended, writers wait."""
        versions = sorted(self._versions(name))
        old, kept = versions[:-keep], versions[-keep:]
        used = {f.split("/")[0] for v in kept for f in json.loads(self._files.text(f"{name}/v-{v:012d}.json"))["parts"].values()}
        for v in old:
            self._files.remove(f"{name}/v-{v:012d}.json")
        for n in self._files.names(name):
            if not n.startswith("v-") and n not in used:
                self._files.remove(f"{name}/{n}")

    # --- state: a small table of keys and values -----------------------------------------------------------------------

    def get_state(self, key: str, default: str | None = None) -> str | None:
        if not self.exists("state"):
            return default
        r = self.read("state").filter(F.col("key") == key).select("value").first()
        return default if r is None else r["value"]

    def set_state(self, key: str, value: str) -> None:
        self.upsert("state", self.spark.createDataFrame([(key, value)], "key string, value string"), "key")

    def done(self, key: str) -> set[str]:
        return parse_done(self.get_state(key))

    def mark_done(self, key: str, units: set[str]) -> None:
        self.set_state(key, json.dumps(sorted(self.done(key) | units)))


def parse_done(raw: str | None) -> set[str]:
    """The units in a state value; broken JSON and other shapes are an empty set."""
    try:
        data = json.loads(raw or "")
    except ValueError:
        return set()
    return {str(x) for x in data} if isinstance(data, list) else set()


def pending(units: list[str], done: set[str], recheck: int = 2) -> list[str]:
    """Units not done, and always the last ones, which may still grow."""
    late = set(sorted(units)[-recheck:]) if recheck else set()
    return [u for u in units if u not in done or u in late]
