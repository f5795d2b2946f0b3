"""Stored tables: rows in key buckets, versions named by manifests, Bloom filters per bucket.

``path/data/<folder>/bucket=<b>`` holds the rows that one write put into a bucket, ``path/filters/<folder>`` the filters of
their keys, and ``path/manifest/v=<n>`` lists the folders and buckets that make up version n. A version is there once its
manifest is, so a write that dies before leaves the version before it as it was; what it wrote is dropped with old versions.

* ``append`` adds a folder; nothing stored is read or written again, but for buckets of too many folders, which it merges.
* ``upsert`` rewrites the buckets that hold a changed row; a run that changes nothing writes no version.
* ``known`` finds which keys are stored: it asks the filters and reads only the buckets of folders whose filter answers.

What comes to the driver is the manifest: at most ``buckets`` times ``most_folders`` rows, both set by the table and not by
its data. Choose ``buckets`` so that one bucket's rows fit a task. One writer at a time: a second writer of the same version
fails instead of replacing it.
"""

from __future__ import annotations

import math
import uuid
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from gripelode.session import delete_folder, drop, stage

KEYS_PER_SLOT = 1_600  # keys of one bitmap of 32,768 bits; with 8 bits a key about one answer in 10,000 is wrong
BITS = 32_768
PROBES = 8
MANIFEST = "bucket int, folder string, rows long, slots int"
_STREAM = -1  # manifest rows of this bucket name a stream and its last batch


@dataclass(frozen=True)
class Segment:
    """The rows that one write put into one bucket."""

    bucket: int
    folder: str
    rows: int
    slots: int


@dataclass
class Lookup:
    """What the last ``known`` read: segments and rows of the exact check, and segments that there are."""

    segments: int = 0
    rows: int = 0
    of: int = 0


def _positions(h: Column) -> Column:
    """The bits of a key within its bitmap, from its 64-bit hash."""
    a, b = h.bitwiseAND(F.lit(0x7FFFFFFF)), F.shiftrightunsigned(h, 33).bitwiseOR(F.lit(1))
    return F.transform(F.sequence(F.lit(0), F.lit(PROBES - 1)), lambda i: F.pmod(a + i * b, F.lit(BITS)))


def _is_set(bits: Column, position: Column) -> Column:
    byte = F.conv(F.hex(F.substring(bits, F.floor(position / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    return F.getbit(byte, (position % 8).cast("int")) == 1


class Store:
    """``filtered`` tables answer ``known``; tables that are only upserted need no filters."""

    def __init__(self, spark: SparkSession, path: str, schema: str, key: list[str], buckets: int = 16, most_folders: int = 16, filtered: bool = True):
        self.spark, self.path, self.key, self.buckets, self.most_folders = spark, path.rstrip("/"), key, buckets, most_folders
        self.filtered = filtered
        self.schema = StructType.fromDDL(schema)
        self.columns = self.schema.names
        self.lookup = Lookup()

    # --- versions

    def _files(self):
        hadoop = self.spark._jvm.org.apache.hadoop.fs.Path(self.path)
        return hadoop.getFileSystem(self.spark._jsc.hadoopConfiguration())

    def _names(self, folder: str) -> list[str]:
        files, path = self._files(), self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{folder}")
        return [s.getPath().getName() for s in files.listStatus(path)] if files.exists(path) else []

    def versions(self) -> list[int]:
        files, jpath = self._files(), self.spark._jvm.org.apache.hadoop.fs.Path
        found = [int(n[2:]) for n in self._names("manifest") if n.startswith("v=")]
        return sorted(v for v in found if files.exists(jpath(f"{self.path}/manifest/v={v}/_SUCCESS")))

    def version(self) -> int:
        """The newest whole version; 0 before the first."""
        files, jpath = self._files(), self.spark._jvm.org.apache.hadoop.fs.Path
        named = sorted((int(n[2:]) for n in self._names("manifest") if n.startswith("v=")), reverse=True)
        return next((v for v in named if files.exists(jpath(f"{self.path}/manifest/v={v}/_SUCCESS"))), 0)

    def _manifest(self, version: int) -> tuple[list[Segment], dict[str, int]]:
        if not version:
            return [], {}
        rows = self.spark.read.schema(MANIFEST).json(f"{self.path}/manifest/v={version}").collect()
        segments = [Segment(*r) for r in rows if r["bucket"] != _STREAM]
        return segments, {r["folder"]: r["rows"] for r in rows if r["bucket"] == _STREAM}

    def segments(self, version: int | None = None) -> list[Segment]:
        return self._manifest(self.version() if version is None else version)[0]

    def _commit(self, version: int, segments: list[Segment], streams: dict[str, int]) -> int:
        rows = [(s.bucket, s.folder, s.rows, s.slots) for s in segments] + [(_STREAM, name, batch, 0) for name, batch in streams.items()]
        frame = self.spark.createDataFrame(rows, MANIFEST).coalesce(1)
        frame.write.mode("errorifexists").json(f"{self.path}/manifest/v={version}")
        return version

    def drop_old(self, keep: int = 1) -> list[str]:
        """Removes all but the newest ``keep`` versions and the folders that no kept version names."""
        versions = self.versions()
        kept = versions[-keep:]
        live = {s.folder for v in kept for s in self.segments(v)}
        gone = [f"manifest/v={v}" for v in versions if v not in kept]
        gone += [f"{kind}/{name}" for kind in ("data", "filters") for name in self._names(kind) if name not in live]
        for name in gone:
            delete_folder(self.spark, f"{self.path}/{name}")
        return gone

    # --- reading

    def _rows(self, segments: list[Segment]) -> DataFrame:
        if not segments:
            return self.spark.createDataFrame([], self.schema)
        return self.spark.read.schema(self.schema).parquet(*[f"{self.path}/data/{s.folder}/bucket={s.bucket}" for s in segments])

    def read(self, version: int | None = None) -> DataFrame:
        """The rows of a version; they stay the same whatever is written meanwhile."""
        return self._rows(self.segments(version))

    def _bucket(self) -> Column:
        return F.pmod(F.xxhash64(*self.key), F.lit(self.buckets)).cast("int")

    def _hash(self) -> Column:
        return F.xxhash64(F.lit(7), *self.key)

    def known(self, rows: DataFrame) -> DataFrame:
        """The distinct keys of ``rows`` that the newest version holds, staged; a null key is never known."""
        if not self.filtered:
            raise ValueError(f"{self.path} has no filters")
        segments = self.segments()
        self.lookup = Lookup(of=len(segments))
        none = self.spark.createDataFrame([], StructType([self.schema[k] for k in self.key]))
        if not segments:
            return none
        live = F.broadcast(self.spark.createDataFrame([(s.bucket, s.folder, s.slots) for s in segments], "bucket int, folder string, slots int"))
        asked = rows.select(*self.key).distinct().withColumns({"bucket": self._bucket(), "h": self._hash()})
        probes = asked.join(live, "bucket").withColumn("slot", F.pmod("h", "slots"))
        folders = sorted({s.folder for s in segments})
        filters = self.spark.read.schema("bucket int, slot long, bits binary, folder string").parquet(*[f"{self.path}/filters/{f}" for f in folders])
        answered = probes.join(filters, ["folder", "bucket", "slot"]).where(F.forall(_positions(F.col("h")), lambda p: _is_set(F.col("bits"), p)))
        maybe = stage(answered.select(*self.key, "folder", "bucket"), "maybe")
        found = {(r["folder"], r["bucket"]) for r in maybe.select("folder", "bucket").distinct().collect()}
        hit = [s for s in segments if (s.folder, s.bucket) in found]
        self.lookup = Lookup(len(hit), sum(s.rows for s in hit), len(segments))
        if not hit:
            drop(maybe)
            return none
        found_keys = stage(maybe.select(*self.key).distinct().join(self._rows(hit).select(*self.key), self.key, "left_semi"), "known")
        drop(maybe)
        return found_keys

    # --- writing

    def _named(self, rows: DataFrame) -> DataFrame:
        return rows.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in self.schema])

    def _write(self, rows: DataFrame) -> list[Segment]:
        folder = uuid.uuid4().hex
        path = f"{self.path}/data/{folder}"
        tasks = max(self.buckets, int(self.spark.conf.get("spark.sql.shuffle.partitions")))
        spread = F.pmod(self._hash(), F.lit(math.ceil(tasks / self.buckets)))
        dealt = self._named(rows).withColumn("bucket", self._bucket())
        dealt.repartition(tasks, "bucket", spread).sortWithinPartitions("bucket", *self.key).write.partitionBy("bucket").parquet(path)
        if not any(n.startswith("bucket=") for n in self._names(f"data/{folder}")):
            return []
        written = self.spark.read.schema(StructType([*self.schema.fields]).add("bucket", "integer")).parquet(path)
        counts = written.groupBy("bucket").count().collect()  # at most one row per bucket
        segments = [Segment(r["bucket"], folder, r["count"], math.ceil(r["count"] / KEYS_PER_SLOT)) for r in counts]
        if not self.filtered:
            return segments
        slots = F.broadcast(self.spark.createDataFrame([(s.bucket, s.slots) for s in segments], "bucket int, slots int"))
        bits = written.select("bucket", self._hash().alias("h")).join(slots, "bucket").select("bucket", F.pmod("h", "slots").alias("slot"), F.explode(_positions(F.col("h"))).alias("p"))
        filters = bits.groupBy("bucket", "slot").agg(F.bitmap_construct_agg("p").alias("bits")).withColumn("folder", F.lit(folder))
        filters.write.parquet(f"{self.path}/filters/{folder}")
        return segments

    def append(self, rows: DataFrame, stream: str | None = None, batch: int = 0) -> int:
        """Adds rows whose keys are not stored yet and gives the new version.

        With ``stream`` a batch that was committed before adds nothing, so a retried micro-batch is no harm.
        """
        version = self.version()
        segments, streams = self._manifest(version)
        if stream is not None and streams.get(stream, -1) >= batch:
            return version
        added = self._write(rows)
        if not added and stream is None:
            return version
        if stream is not None:
            streams[stream] = batch
        return self._commit(version + 1, self._merged(segments + added), streams)

    def _merged(self, segments: list[Segment]) -> list[Segment]:
        """Buckets of too many folders get one; all others stay as they are."""
        held: dict[int, list[Segment]] = {}
        for s in segments:
            held.setdefault(s.bucket, []).append(s)
        full = [s for found in held.values() if len(found) > self.most_folders for s in found]
        return [s for s in segments if s not in full] + self._write(self._rows(full)) if full else segments

    def insert_new(self, rows: DataFrame, stream: str | None = None, batch: int = 0) -> int:
        """Adds those rows, one per key, whose key is not stored."""
        known = self.known(rows)
        version = self.append(rows.join(known, self.key, "left_anti"), stream, batch)
        drop(known)
        return version

    def done(self, stream: str, batch: int) -> bool:
        """Whether a batch of a stream is committed."""
        return self._manifest(self.version())[1].get(stream, -1) >= batch

    def upsert(self, rows: DataFrame, stream: str | None = None, batch: int = 0) -> int:
        """New rows, one per key, replace stored ones of their key; only buckets with a change are written again.

        With ``stream`` the batch is committed in any case, and a batch that was committed before changes nothing.
        """
        version = self.version()
        segments, streams = self._manifest(version)
        if stream is not None:
            if streams.get(stream, -1) >= batch:
                return version
            streams[stream] = batch
        if not segments:
            written = self._write(rows)
            return self._commit(version + 1, written, streams) if written or stream is not None else version
        named = self._named(rows)
        incoming = stage(named.withColumn("bucket", self._bucket()), "incoming")
        touched = {r["bucket"] for r in incoming.select("bucket").distinct().collect()}
        stored = self._rows([s for s in segments if s.bucket in touched])
        same = [F.col(f"n.{k}").eqNullSafe(F.col(f"o.{k}")) for k in self.columns]
        on = same[0]
        for condition in same[1:]:
            on = on & condition
        changed = stage(incoming.alias("n").join(stored.alias("o"), on, "left_anti"), "changed")
        drop(incoming)
        buckets = {r["bucket"] for r in changed.select("bucket").distinct().collect()}
        if not buckets:
            drop(changed)
            return self._commit(version + 1, segments, streams) if stream is not None else version
        version = self._replace(version, segments, streams, changed.drop("bucket"), buckets)
        drop(changed)
        return version

    def replace(self, rows: DataFrame) -> int:
        """Like ``upsert``, of staged rows that are all known to differ from what is stored: nothing is compared."""
        version = self.version()
        segments, streams = self._manifest(version)
        rows = self._named(rows)
        buckets = {r["bucket"] for r in rows.select(self._bucket().alias("bucket")).distinct().collect()}
        return self._replace(version, segments, streams, rows, buckets) if buckets else version

    def _replace(self, version: int, segments: list[Segment], streams: dict[str, int], rows: DataFrame, buckets: set[int]) -> int:
        kept = self._rows([s for s in segments if s.bucket in buckets]).join(rows.select(*self.key), self.key, "left_anti")
        written = self._write(kept.unionByName(rows))
        return self._commit(version + 1, [s for s in segments if s.bucket not in buckets] + written, streams)
