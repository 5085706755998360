"""A vector index on files, merged on read.

An index is a folder. Rows lie in hash buckets of their id; a base holds the rows of a bucket, and every
write adds a delta folder with only the rows that it brings and marks of the ids that leave. A version
is a small numbered file that names the bases and deltas that make it up; the newest number is
the index. A version is written after its data and appears by one rename, so a write that stops
anywhere leaves the version before it as it was, and a folder that no version names is rubbish.

Reading lays the deltas over the base: of each id the last delta's row counts. Base rows only pass an
anti-join with the ids of the deltas, which are few and broadcast by their size until compaction
writes the buckets that deltas touched anew. Which row of an id is newer is settled when it is
written, against the id and version columns of the buckets it falls into, so readers never compare versions.

One writer at a time. Ids are never null: rows without id are refused.
"""

from __future__ import annotations

import json
import uuid
from dataclasses import dataclass, field, replace

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tessera.operators.keep import keep_one
from tessera.session import settle

BUCKETS = 64
KEPT_VERSIONS = 2


@dataclass(frozen=True)
class Version:
    """What one version is made of: for each bucket its base folder, then the deltas, oldest first."""

    number: int
    key: str
    buckets: int
    schema: str
    bases: dict[str, list[int]] = field(default_factory=dict)
    deltas: list[str] = field(default_factory=list)

    def folders(self) -> set[str]:
        return {*self.bases, *self.deltas}


class IndexStore:
    """The index below ``root``; ``key`` names the id column of new indexes."""

    def __init__(self, spark: SparkSession, root: str, key: str = "id", buckets: int = BUCKETS):
        self.spark, self.root, self.key, self.buckets = spark, root.rstrip("/"), key, buckets
        self._path = spark._jvm.org.apache.hadoop.fs.Path
        self._fs = self._path(self.root).getFileSystem(spark._jsc.hadoopConfiguration())

    # versions

    def numbers(self) -> list[int]:
        """Numbers of all versions, oldest first."""
        folder = self._path(f"{self.root}/versions")
        if not self._fs.exists(folder):
            return []
        names = [f.getPath().getName() for f in self._fs.listStatus(folder)]
        return sorted(int(n[:-5]) for n in names if n.endswith(".json") and n[:-5].isdigit())

    def version(self, number: int | None = None) -> Version | None:
        """A version by its number, the newest without one; None before the first write."""
        held = self.numbers()
        if not held:
            return None
        number = held[-1] if number is None else number
        name = f"{self.root}/versions/{number:012d}.json"
        return Version(**json.loads(self.spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(self._fs.open(self._path(name)), "UTF-8")))

    def _publish(self, version: Version) -> Version:
        """Make ``version`` the newest: written aside, then renamed to its number."""
        target = self._path(f"{self.root}/versions/{version.number:012d}.json")
        aside = self._path(f"{self.root}/versions/.{uuid.uuid4().hex}")
        out = self._fs.create(aside, True)
        out.write(bytearray(json.dumps(version.__dict__).encode()))
        out.close()
        if self._fs.exists(target) or not self._fs.rename(aside, target):
            self._fs.delete(aside, False)
            raise RuntimeError(f"version {version.number} of {self.root} was written by someone else")
        return version

    # rows

    def bucket(self, key: str, buckets: int) -> Column:
        return F.pmod(F.xxhash64(F.col(key)), F.lit(buckets)).cast("int")

    def _write(self, rows: DataFrame, name: str) -> tuple[str, int]:
        """Rows with ``_bucket`` to a folder of its own, a large bucket by many tasks; also their number."""
        folder, seen = f"{self.root}/{name}-{uuid.uuid4().hex}", Observation()
        dealt = rows.hint("rebalance", "_bucket").observe(seen, F.count(F.lit(1)).alias("rows"))
        dealt.write.partitionBy("_bucket").parquet(folder)
        return folder, seen.get["rows"]

    def _folder(self, path: str, schema: str, buckets: list[int] | None = None) -> DataFrame:
        rows = self.spark.read.schema(f"{schema}, _bucket int").parquet(path)
        return rows if buckets is None else rows.filter(F.col("_bucket").isin(buckets))

    def _base(self, version: Version) -> DataFrame:
        parts = [self._folder(path, version.schema, held) for path, held in version.bases.items()]
        rows = parts[0] if parts else self.spark.createDataFrame([], f"{version.schema}, _bucket int")
        for part in parts[1:]:
            rows = rows.unionByName(part)
        return rows

    def _changes(self, version: Version) -> DataFrame | None:
        """The last row of every id in the deltas, with ``_gone`` for ids that left."""
        if not version.deltas:
            return None
        schema = f"{version.schema}, _gone boolean"
        rows = None
        for turn, path in enumerate(version.deltas):
            part = self._folder(path, schema).withColumn("_turn", F.lit(turn))
            rows = part if rows is None else rows.unionByName(part)
        if len(version.deltas) == 1:
            return rows.drop("_turn")
        last = rows.groupBy(version.key).agg(F.max("_turn").alias("_turn"))
        return rows.join(last, [version.key, "_turn"], "left_semi").drop("_turn")

    def _merged(self, version: Version) -> DataFrame:
        base, changes = self._base(version), self._changes(version)
        if changes is None:
            return base
        kept = base.join(changes.select(version.key), version.key, "left_anti")
        return kept.unionByName(changes.filter(~F.col("_gone")).drop("_gone"))

    def read(self, number: int | None = None) -> DataFrame | None:
        """All rows of a version, the newest without a number; None before the first write."""
        version = self.version(number)
        return None if version is None else self._merged(version).drop("_bucket")

    # writes

    def replace(self, rows: DataFrame) -> tuple[Version, int]:
        """A new base of ``rows`` (unique ids) in place of whatever is stored; also the rows written."""
        newest = self.version()
        number = 0 if newest is None else newest.number + 1
        schema = _ddl(rows)
        folder, n = self._write(self._known(rows).withColumn("_bucket", self.bucket(self.key, self.buckets)), "base")
        return self._publish(Version(number, self.key, self.buckets, schema, {folder: list(range(self.buckets))})), n

    def apply(self, rows: DataFrame | None, gone: DataFrame | None = None) -> tuple[Version, int]:
        """Add a delta: ``rows`` (unique ids) replace what is stored under their ids, ids of ``gone`` leave.

        Writes nothing but these rows. An id in both stays with its row.
        """
        newest = self.version()
        if newest is None:
            raise ValueError(f"no index below {self.root}")
        parts = []
        if rows is not None:
            names = self.spark.createDataFrame([], newest.schema).columns
            parts.append(self._known(rows).select(*names).withColumn("_gone", F.lit(False)))
        if gone is not None:
            ids = gone.select(newest.key).filter(F.col(newest.key).isNotNull()).distinct()
            if rows is not None:
                ids = ids.join(rows.select(newest.key), newest.key, "left_anti")
            empty = self.spark.createDataFrame([], newest.schema).schema
            parts.append(
                ids.select(
                    *[F.col(f.name) if f.name == newest.key else F.lit(None).cast(f.dataType).alias(f.name) for f in empty],
                    F.lit(True).alias("_gone"),
                )
            )
        delta = parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])
        folder, n = self._write(delta.withColumn("_bucket", self.bucket(newest.key, newest.buckets)), "delta")
        return self._publish(replace(newest, number=newest.number + 1, deltas=[*newest.deltas, folder])), n

    def upsert(self, incoming: DataFrame, version: str) -> tuple[Version, int]:
        """Lay ``incoming`` over the index, the highest ``version`` of an id staying and new rows winning ties.

        Rows that are older than what is stored are left out; for this only id and version of the
        stored rows are read.
        """
        newest_first = [F.col(version).desc_nulls_last()]
        fresh = keep_one(self._known(incoming), [self.key], newest_first)
        newest = self.version()
        if newest is None:
            return self.replace(fresh)
        fresh = settle(fresh, "incoming")
        stored = self._merged(newest).select(newest.key, F.col(version).alias("_stored"), F.lit(True).alias("_held"))
        ids = settle(stored.join(fresh.select(newest.key), newest.key, "left_semi"), "stored-versions")
        both = fresh.join(ids, newest.key, "left")
        older = F.col("_held") & F.col("_stored").isNotNull() & (F.col(version).isNull() | (F.col(version) < F.col("_stored")))
        return self.apply(both.filter(~F.coalesce(older, F.lit(False))).drop("_stored", "_held"))

    def compact(self) -> Version:
        """Write the buckets that deltas touched anew and drop the deltas; other buckets stay where they are."""
        newest = self.version()
        if newest is None or not newest.deltas:
            return newest
        changes = self._changes(newest)
        # no more numbers than buckets
        touched = sorted(r["_bucket"] for r in changes.select("_bucket").distinct().collect())
        rows = self._merged(newest).filter(F.col("_bucket").isin(touched))
        folder, _ = self._write(rows, "base")
        bases = {path: [b for b in held if b not in touched] for path, held in newest.bases.items()}
        bases = {path: held for path, held in bases.items() if held} | {folder: touched}
        return self._publish(replace(newest, number=newest.number + 1, bases=bases, deltas=[]))

    def clean(self, keep: int = KEPT_VERSIONS) -> int:
        """Delete versions before the newest ``keep`` and every data folder that no version left names; their number."""
        held = self.numbers()
        for number in held[:-keep]:
            self._fs.delete(self._path(f"{self.root}/versions/{number:012d}.json"), False)
        named = {path.rsplit("/", 1)[1] for n in held[-keep:] for path in self.version(n).folders()}
        rubbish = [f.getPath() for f in self._fs.listStatus(self._path(self.root)) if f.getPath().getName() not in named | {"versions"}]
        for path in rubbish:
            self._fs.delete(path, True)
        return len(rubbish)

    def _known(self, rows: DataFrame) -> DataFrame:
        named = F.when(F.col(self.key).isNull(), F.raise_error(F.lit(f"a row without {self.key}"))).otherwise(F.col(self.key))
        return rows.withColumn(self.key, named)


def _ddl(df: DataFrame) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields)
