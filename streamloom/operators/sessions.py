"""An incremental session table: sessions separated by inactivity, kept over arriving batches."""

from __future__ import annotations

import json
import uuid

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from streamloom.operators.intervals import BLOCK_MS
from streamloom.operators.scan import BLOCK, END, HEAD, KEY, START, block_of, joined, packed, unpacked
from streamloom.operators.shared import OWN, file_system, landed, removed, removed_at_exit, require_columns, shared_dir

_HOW = {"min": F.min, "max": F.max, "sum": F.sum}


class _Sessions:
    """The two steps of finding sessions: inside (key, time block), then over block edges."""

    def __init__(self, keys: list[str], start: str, end: str, gap: int, measures: dict[str, str], block_ms: int = BLOCK_MS):
        self.keys, self.start, self.end, self.gap, self.measures, self.block_ms = keys, start, end, gap, measures, block_ms
        self.columns = [*keys, start, end, *measures]
        self.named = {c: f"{OWN}m{n}" for n, c in enumerate(measures)}
        self.folds = [_HOW[how](self.named[c]).alias(self.named[c]) for c, how in measures.items()]

    def rows(self, df: DataFrame) -> DataFrame:
        """Events, or sessions found before, under the columns of the steps."""
        require_columns(df, self.columns, "sessions")
        return df.select(packed(self.keys), F.col(self.start).alias(START), F.col(self.end).alias(END), *[F.col(c).alias(m) for c, m in self.named.items()]).where(F.col(END) >= F.col(START))

    def local(self, rows: DataFrame) -> DataFrame:
        """(KEY, BLOCK, START, END, measures): rows folded to sessions inside (key, block)."""
        rows = rows.withColumn(BLOCK, block_of(F.col(START), self.block_ms))
        order = Window.partitionBy(KEY, BLOCK).orderBy(START, END)
        latest = F.max(END).over(order.rowsBetween(Window.unboundedPreceding, -1))
        rows = rows.withColumn(HEAD, F.when(latest.isNull() | (F.col(START) > latest + F.lit(self.gap)), F.col(START)))
        rows = rows.withColumn(HEAD, F.max(HEAD).over(order.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
        return rows.groupBy(KEY, BLOCK, HEAD).agg(F.max(END).alias(END), *self.folds).withColumnRenamed(HEAD, START)

    def whole(self, local: DataFrame) -> DataFrame:
        """Sessions of the whole keys under the caller's names; local is read twice."""
        out = joined(local, self.gap, self.folds)
        return out.select(*unpacked(self.keys), F.col(START).alias(self.start), F.col(END).alias(self.end), *[F.col(m).alias(c) for c, m in self.named.items()])


def sessions(df: DataFrame, keys: list[str], start: str, end: str, gap: int, measures: dict[str, str], block_ms: int = BLOCK_MS) -> DataFrame:
    """Sessions of each key: a new one begins where a row starts more than `gap` after all earlier ends.

    start, end: whole numbers; rows with a null bound or an end before the start
    are left out. measures: column to "min", "max" or "sum". Repeated rows count
    as often as they stand. Null keys form a group. Other columns are ignored;
    an empty table gives no session. Output: keys, start, end, measures.

    Rows are first folded to sessions inside (key, time block), and only those,
    written once, are joined over block edges.
    """
    steps = _Sessions(keys, start, end, gap, measures, block_ms)
    return steps.whole(landed(steps.local(steps.rows(df)), "sessions")[0])


class SessionTable:
    """Sessions kept as Parquet files in buckets of the keys; a manifest names the files of the current version.

    merge(batch) folds the batch to local sessions, reads the stored sessions of the
    buckets those fall into, joins all that lie within `gap` of each other (a late row
    may bridge two stored sessions), and writes these buckets anew. Files of other
    buckets are neither read nor written and stand in the next manifest under the same
    names. The manifest also keeps the table's parameters and types, so that `open`
    needs a path only, and the last batch of each stream, so that a batch delivered
    again changes nothing.

    A version counts once its manifest has been renamed into place, which fails if
    another writer was first; until then readers see the old one, and a merge that dies
    leaves it. The file system must rename without overwriting (HDFS and local disks
    do; on an object store use one writer). The last `keep` versions can be read; older
    files are deleted. Events must not stand in two batches: remove repeats before merging.
    """

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path
        m = self._manifest()
        self.buckets, self.keep = m["buckets"], m["keep"]
        self.steps = _Sessions(m["keys"], m["start"], m["end"], m["gap"], m["measures"])

    @classmethod
    def create(cls, spark: SparkSession, keys: list[str], start: str, end: str, gap: int, measures: dict[str, str], path: str | None = None, buckets: int = 16, keep: int = 2) -> SessionTable:
        """A new, empty table; without a path one that lasts as long as the application."""
        path = path or removed_at_exit(spark, shared_dir(spark, "session-table"))
        facts = {"keys": keys, "start": start, "end": end, "gap": gap, "measures": measures, "buckets": buckets, "keep": keep}
        _commit(spark, path, {"version": 0, "schema": None, "files": {}, "last": {}, **facts})
        return cls(spark, path)

    @classmethod
    def open(cls, spark: SparkSession, path: str) -> SessionTable:
        """The table at a path, as its last merge left it."""
        return cls(spark, path)

    def _versions(self) -> list[int]:
        p, fs = file_system(self.spark, f"{self.path}/manifest")
        if not fs.exists(p):
            raise FileNotFoundError(f"no session table at {self.path}")
        return sorted(int(s.getPath().getName()[1:]) for s in fs.listStatus(p))

    def _manifest(self, version: int | None = None) -> dict:
        p, fs = file_system(self.spark, f"{self.path}/manifest/v{self._versions()[-1] if version is None else version}")
        stream = fs.open(p)
        raw = self.spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        stream.close()
        return json.loads(raw)

    def _bucket(self, keys: list[Column]) -> Column:
        return F.pmod(F.xxhash64(*keys), F.lit(self.buckets)).cast("int")

    def _stored(self, manifest: dict, buckets: set[str] | None = None) -> DataFrame:
        schema = T.StructType.fromJson(manifest["schema"])
        paths = [f"{self.path}/{p}" for b, p in manifest["files"].items() if buckets is None or b in buckets]
        return self.spark.read.schema(schema).parquet(*paths) if paths else self.spark.createDataFrame([], schema)

    def read(self) -> DataFrame:
        """The sessions of the current version: keys, start, end, measures."""
        manifest = self._manifest()
        if manifest["schema"] is None:
            raise ValueError(f"nothing was merged into {self.path} yet")
        return self._stored(manifest)

    def batches(self, events: DataFrame, arrival: str, n: int, span: DataFrame | None = None) -> list[DataFrame]:
        """`events` landed in the shared folder in n parts by time of arrival (null: the last).

        span: a cheaper table with the same arrival times, for their first and last.
        """
        lo, hi = (events if span is None else span).agg(F.min(arrival), F.max(arrival)).first() if n > 1 else (None, None)
        if lo is None or lo == hi:
            part, n = F.lit(0), 1
        else:
            step = (hi - lo) / n
            part = F.lit(n - 1)
            for k in range(n - 2, -1, -1):
                part = F.when(F.col(arrival) < F.lit(lo + step * (k + 1)), k).otherwise(part)
        path = removed_at_exit(self.spark, shared_dir(self.spark, "landed"))
        events.withColumn(f"{OWN}part", part).write.partitionBy(f"{OWN}part").parquet(path)
        there = self.spark.read.schema(events.withColumn(f"{OWN}part", F.lit(0)).schema).parquet(path)
        return [there.where(F.col(f"{OWN}part") == k).drop(f"{OWN}part") for k in range(n)]

    def merge(self, batch: DataFrame, batch_id: int | None = None, stream: str = "") -> None:
        """Merges a batch. With batch_id, which must rise within a stream, one that was merged before is left out."""
        manifest = self._manifest()
        if batch_id is not None and batch_id <= manifest["last"].get(stream, -1):
            return
        steps, temporary = self.steps, []

        def land(df: DataFrame) -> DataFrame:
            out, path = landed(df, "merge")
            temporary.append(path)
            return out

        local = land(steps.local(steps.rows(batch)))
        keys = [F.col(f"{KEY}.k{n}") for n in range(len(steps.keys))]
        touched = {str(r[0]) for r in local.select(self._bucket(keys)).distinct().collect()}  # at most as many as there are buckets
        if touched & set(manifest["files"]):
            stored = steps.rows(self._stored(manifest, touched))
            local = land(steps.local(stored.unionByName(local.drop(BLOCK))))
        out = steps.whole(local)
        schema = T.StructType.fromJson(manifest["schema"]) if manifest["schema"] else out.schema
        out = out.select(*[F.col(f.name).cast(f.dataType) for f in schema])
        version = manifest["version"] + 1
        folder = f"data/v{version}-{uuid.uuid4().hex[:8]}"
        name = f"{OWN}bucket"
        out.withColumn(name, self._bucket([F.col(k) for k in steps.keys])).write.partitionBy(name).parquet(f"{self.path}/{folder}")
        fresh = {b: f"{folder}/{name}={b}" for b in touched}
        last = manifest["last"] | ({} if batch_id is None else {stream: batch_id})
        _commit(self.spark, self.path, {**manifest, "version": version, "schema": json.loads(schema.json()), "files": manifest["files"] | fresh, "last": last})
        for path in temporary:
            removed(self.spark, path)
        self._forget(version)

    def _forget(self, version: int) -> None:
        """Deletes manifests before the last `keep` and the files only they name."""
        old = [self._manifest(v) for v in self._versions() if v <= version - self.keep]
        kept = {f for v in self._versions() if v > version - self.keep for f in self._manifest(v)["files"].values()}
        for m in old:
            for f in set(m["files"].values()) - kept:
                removed(self.spark, f"{self.path}/{f}")
            removed(self.spark, f"{self.path}/manifest/v{m['version']}")


def _commit(spark: SparkSession, path: str, manifest: dict) -> None:
    hadoop = spark._jvm.org.apache.hadoop.fs
    tmp, fs = file_system(spark, f"{path}/commit/{uuid.uuid4().hex}")
    out = fs.create(tmp, False)
    out.write(bytearray(json.dumps(manifest).encode()))
    out.close()
    final, _ = file_system(spark, f"{path}/manifest/v{manifest['version']}")
    fs.mkdirs(final.getParent())
    options = spark._sc._gateway.new_array(getattr(hadoop, "Options$Rename"), 0)
    try:
        # Without the option to overwrite the rename fails where the version is there.
        hadoop.FileContext.getFileContext(tmp.toUri(), spark._jsc.hadoopConfiguration()).rename(tmp, final, options)
    except Exception as why:
        fs.delete(tmp, False)
        raise RuntimeError(f"version {manifest['version']} of {path} was committed by another writer") from why
