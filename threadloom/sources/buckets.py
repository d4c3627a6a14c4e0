"""Keyed tables in buckets, changed as a whole from one version to the next.

A version is one small file, the manifest, that names the folders that make up each bucket: at most one base with one row
per key, and the changes since. A batch writes its rows as changes of the buckets they fall into; buckets with many changes
are rewritten as a new base in the same step. Nothing that an earlier version names is ever overwritten, and the manifest
is renamed into place last, so a step that fails leaves the table as it was, a step that runs again under its number
replaces what it wrote before, and buckets without changes keep their files.

Beside each folder lies a Bloom filter of its keys, one 64-bit word per key and folder entry (Putze, Sanders and Singler
2007), so a lookup opens only buckets that may hold what it asks for; the answer itself is exact.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Callable
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import IntegerType, LongType, StringType, StructField, StructType

from threadloom.sizing import BROADCAST_ROWS, exists, list_names, remove

# Choose as many buckets as make one a few hundred MB; each is rewritten whole.
BUCKETS = 16
MOST_CHANGES = 8
# Words of a bucket's filter. Only those with a key are stored; up to six keys a word let some 3 % of absent keys through.
FILTER_WORDS = 1 << 16

BASE, CHANGES = "base", "changes"
_MANIFEST = StructType([StructField("bucket", IntegerType()), StructField("kind", StringType()), StructField("version", LongType())])
_FILTER = StructType([StructField("word", IntegerType()), StructField("bits", LongType())])
_PLACE = StructType([StructField("version", LongType()), StructField("bucket", IntegerType())])


@dataclass(frozen=True)
class Entry:
    """One folder of a bucket: its base or the changes of one version."""

    bucket: int
    kind: str
    version: int


@dataclass(frozen=True)
class BucketTable:
    """schema: stored columns. fold(rows, order): one row per key of rows whose copies come in `order`.
    merge(base, changes): both with one row per key; by default their fold, the base first."""

    path: str
    schema: StructType
    keys: tuple[str, ...]
    fold: Callable[[DataFrame, list[str]], DataFrame]
    merge: Callable[[DataFrame, DataFrame], DataFrame] | None = None
    bucket: Column | None = field(default=None, compare=False)
    buckets: int = BUCKETS
    most_changes: int = MOST_CHANGES
    filtered: bool = True
    filter_words: int = FILTER_WORDS

    def bucket_of(self) -> Column:
        return F.pmod(F.xxhash64(*self.keys), F.lit(self.buckets)).cast("int") if self.bucket is None else self.bucket

    def _folder(self, kind: str, version: int | None = None) -> str:
        return f"{self.path}/{kind}" + ("" if version is None else f"/version={version}")

    # Versions

    def latest(self, spark: SparkSession) -> int | None:
        """The greatest complete version."""
        names = list_names(spark, self._folder("manifest"))
        found = sorted((int(n.removeprefix("version=")) for n in names if n.startswith("version=")), reverse=True)
        return next((v for v in found if self.complete(spark, v)), None)

    def complete(self, spark: SparkSession, version: int) -> bool:
        return exists(spark, f"{self._folder('manifest', version)}/_SUCCESS")

    def entries(self, spark: SparkSession, version: int | None) -> list[Entry]:
        """All folders of a version; as many as there are buckets, times most_changes + 1 at most."""
        if version is None:
            return []
        rows = spark.read.schema(_MANIFEST).parquet(self._folder("manifest", version))
        return [Entry(*r) for r in rows.toLocalIterator()]

    def _swap(self, spark: SparkSession, version: int, entries: list[Entry]) -> None:
        rows = [(e.bucket, e.kind, e.version) for e in entries]
        spark.createDataFrame(rows, _MANIFEST).coalesce(1).write.mode("overwrite").parquet(self._folder("manifest", version))

    # Reading

    def _rows(self, spark: SparkSession, entries: list[Entry], schema: StructType, suffix: str = "") -> DataFrame:
        """Rows of the named folders only, with their version and bucket."""
        spec, parts = StructType([*schema.fields, *_PLACE.fields]), []
        for kind in (BASE, CHANGES):
            paths = [f"{self._folder(kind + suffix, e.version)}/bucket={e.bucket}" for e in entries if e.kind == kind]
            if paths:
                parts.append(spark.read.schema(spec).option("basePath", self._folder(kind + suffix)).parquet(*paths))
        if not parts:
            return spark.createDataFrame([], spec)
        return parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])

    def _together(self, spark: SparkSession, entries: list[Entry], names: list[str] | None = None) -> DataFrame:
        """One row per key of buckets of which all folders are given."""
        names = names or self.schema.names
        base, changes = ([e for e in entries if e.kind == kind] for kind in (BASE, CHANGES))
        old = self._rows(spark, base, self.schema).select(*names)
        if not changes:
            return old
        new = self._rows(spark, changes, self.schema).select(*names, "version")
        if self.merge is None:
            both = new.unionByName(old.withColumn("version", F.lit(-1).cast("long")))
            return self.fold(both, ["version"]).select(*names)
        return self.merge(old, self.fold(new, ["version"]).select(*names)) if base else self.fold(new, ["version"]).select(*names)

    def read(
        self, spark: SparkSession, version: int | None = None, buckets: set[int] | None = None, columns: list[str] | None = None
    ) -> DataFrame:
        """One row per key of a version (the latest one by default), of some buckets or all.

        A bucket that is one folder has one row per key already: its rows pass as they are. Tables whose fold takes the
        columns it is given can be asked for some `columns`; only these and the keys are read and folded.
        """
        names = [c for c in self.schema.names if columns is None or c in columns or c in self.keys]
        version = self.latest(spark) if version is None else version
        per_bucket: dict[int, list[Entry]] = defaultdict(list)
        for e in self.entries(spark, version):
            if buckets is None or e.bucket in buckets:
                per_bucket[e.bucket].append(e)
        lone = [e for found in per_bucket.values() if len(found) == 1 for e in found]
        rest = [e for found in per_bucket.values() if len(found) > 1 for e in found]
        plain = self._rows(spark, lone, self.schema).select(*names)
        both = plain.unionByName(self._together(spark, rest, names)) if rest else plain
        return both if columns is None else both.select(*columns)

    # Changing

    def _folded(self, rows: DataFrame, order: list[str], persisted: bool) -> DataFrame:
        """One row per key of rows. Of `persisted` rows only those whose key comes more than once are shuffled, if that is half of them or less.

        The fold of a single row is that row. The keys alone are counted first; the repeated ones travel with the tasks.
        """
        if not persisted:
            return self.fold(rows, order)
        counts = rows.groupBy(*self.keys).agg(F.count("*").alias("copies"))
        again = F.col("copies") > 1
        keys, copies, total = counts.agg(F.count_if(again), F.coalesce(F.sum(F.when(again, F.col("copies"))), F.lit(0)), F.coalesce(F.sum("copies"), F.lit(0))).first()
        if not keys:
            return rows
        if keys > BROADCAST_ROWS or 2 * copies > total:
            return self.fold(rows, order)
        repeated = F.broadcast(counts.where(again).select(*[F.col(k).alias(f"_{k}") for k in self.keys]))
        same = reduce(Column.__and__, [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in self.keys])
        folded = self.fold(rows.join(repeated, same, "left_semi"), order)
        return rows.join(repeated, same, "left_anti").select(*self.schema.names).unionByName(folded.select(*self.schema.names))

    def _write(self, rows: DataFrame, kind: str, version: int) -> set[int]:
        """Write rows by bucket, without their filters; the buckets written.

        Each task writes a file per bucket; rows, which come from a fold or are one per key, are not shuffled again.
        """
        spark, folder = rows.sparkSession, self._folder(kind, version)
        placed = rows.withColumn("bucket", self.bucket_of())
        placed.write.mode("overwrite").partitionBy("bucket").parquet(folder)
        return {int(n.removeprefix("bucket=")) for n in list_names(spark, folder) if n.startswith("bucket=")}

    def _write_filters(
        self, spark: SparkSession, kind: str, version: int, fresh: list[Entry], stored: list[Entry] = (), keys: DataFrame | None = None
    ) -> None:
        """Write the filters of the folders of kind and version that hold the keys of the folders in `fresh` and `stored`.

        Those in `stored` have filters, which are put together without reading their keys again. `keys`, if given,
        are those of `fresh`, whose files are not opened then.
        """
        if not self.filtered or not fresh:
            return
        if keys is None:
            keys = self._rows(spark, fresh, self.schema)
        else:
            keys = keys.withColumn("bucket", self.bucket_of()).where(F.col("bucket").isin([e.bucket for e in fresh]))
        words = keys.select("bucket", self._word().alias("word"), self._mask().alias("bits"))
        if stored:
            words = words.unionByName(self._rows(spark, stored, _FILTER, "_filter").select("bucket", "word", "bits"))
        words = words.groupBy("bucket", "word").agg(F.bit_or("bits").alias("bits"))
        words.hint("rebalance", "bucket").write.mode("overwrite").partitionBy("bucket").parquet(self._folder(kind + "_filter", version))

    def apply(
        self, rows: DataFrame, version: int, order: list[str], previous: int | None = None, drop: set[int] = frozenset(), persisted: bool = False
    ) -> set[int]:
        """Take rows, whose copies of a key come in `order`, into version `previous` and make it `version`.

        Buckets in `drop` are left out of the new version, together with what rows hold for them. Returns the buckets
        that were changed. `persisted` rows are read several times, so that few of them are shuffled.
        """
        spark = rows.sparkSession
        # Rows in no order are one per key: a table of bases only begins with them as its bases.
        kind = BASE if previous is None and not order and not self.most_changes else CHANGES
        touched = self._write(self._folded(rows, order, persisted).select(*self.schema.names), kind, version)
        kept = [e for e in self.entries(spark, previous) if e.bucket not in drop]
        changed = [Entry(b, kind, version) for b in sorted(touched - set(drop))]
        counts: dict[int, int] = defaultdict(int)
        for e in kept:
            counts[e.bucket] += e.kind == CHANGES
        # A bucket that had nothing has one row per key as it is.
        full = {e.bucket for e in changed if e.bucket in counts and counts[e.bucket] >= self.most_changes}
        keys = rows if persisted else None
        self._write_filters(spark, kind, version, [e for e in changed if e.bucket not in full], keys=keys)
        if full:
            merged, old = ([e for e in part if e.bucket in full] for part in (changed, kept))
            self._write(self._together(spark, [*old, *merged]), BASE, version)
            # A new base has the keys of the folders it is made of.
            self._write_filters(spark, BASE, version, merged, old, keys)
        entries = [e for e in [*kept, *changed] if e.bucket not in full] + [Entry(b, BASE, version) for b in sorted(full)]
        self._swap(spark, version, entries)
        return touched

    def replace(self, rows: DataFrame, version: int, previous: int | None, buckets: set[int]) -> None:
        """Put rows, with one row per key, in the place of all that `previous` has in `buckets`; rows of other buckets are an error."""
        spark = rows.sparkSession
        written = self._write(rows.select(*self.schema.names), BASE, version)
        if written - buckets:
            raise ValueError(f"rows of buckets {sorted(written - buckets)}, which are not to be replaced")
        bases = [Entry(b, BASE, version) for b in sorted(written)]
        self._write_filters(spark, BASE, version, bases)
        kept = [e for e in self.entries(spark, previous) if e.bucket not in buckets]
        self._swap(spark, version, kept + bases)

    def vacuum(self, spark: SparkSession, keep: int = 2) -> None:
        """Delete all folders that the last `keep` versions do not name, for when no reader is on an older one."""
        names = list_names(spark, self._folder("manifest"))
        versions = sorted(int(n.removeprefix("version=")) for n in names if n.startswith("version="))
        last = [v for v in versions if self.complete(spark, v)][-keep:]
        named = {(e.kind, e.version) for v in last for e in self.entries(spark, v)}
        for v in versions:
            if last and v < last[0]:
                for kind in (BASE, CHANGES):
                    if (kind, v) not in named:
                        remove(spark, self._folder(kind, v))
                        remove(spark, self._folder(kind + "_filter", v))
                remove(spark, self._folder("manifest", v))

    # Lookup

    def _hash(self) -> Column:
        return F.xxhash64(*self.keys, F.lit("filter"))

    def _word(self) -> Column:
        return F.pmod(F.shiftrightunsigned(self._hash(), 24), F.lit(self.filter_words)).cast("int")

    def _mask(self) -> Column:
        """Four bits of a word."""
        bits = [F.call_function("shiftleft", F.lit(1).cast("long"), F.shiftrightunsigned(self._hash(), 6 * i).bitwiseAND(63).cast("int")) for i in range(4)]
        mask = bits[0]
        for bit in bits[1:]:
            mask = mask.bitwiseOR(bit)
        return mask

    def may_hold(self, rows: DataFrame, version: int | None = None) -> DataFrame:
        """The rows, with key columns named as here, whose key may be stored: all that is, and few others; adds `bucket`."""
        spark = rows.sparkSession
        version = self.latest(spark) if version is None else version
        placed = rows.withColumn("bucket", self.bucket_of())
        asked = {r.bucket for r in placed.select("bucket").distinct().toLocalIterator()}
        entries = [e for e in self.entries(spark, version) if e.bucket in asked]
        words = self._rows(spark, entries, _FILTER, "_filter").groupBy("bucket", "word").agg(F.bit_or("bits").alias("bits"))
        masked = placed.withColumn("word", self._word()).withColumn("mask", self._mask())
        found = masked.join(words, ["bucket", "word"]).where(F.col("bits").bitwiseAND(F.col("mask")) == F.col("mask"))
        return found.select(*rows.columns, "bucket")

    def known(self, rows: DataFrame, version: int | None = None) -> DataFrame:
        """The rows whose key is stored. Opens only the buckets that may hold one of them, and of these only the keys.

        rows is read twice; persist it where that is dear.
        """
        spark = rows.sparkSession
        version = self.latest(spark) if version is None else version
        maybe = self.may_hold(rows, version)
        asked = {r.bucket for r in maybe.select("bucket").distinct().toLocalIterator()}
        entries = [e for e in self.entries(spark, version) if e.bucket in asked]
        stored = self._rows(spark, entries, self.schema).select(*self.keys)
        return maybe.drop("bucket").join(stored, list(self.keys), "left_semi").select(*rows.columns)
