"""Versioned feature store on plain parquet.

Layout below the base folder: ``<group>/_w=<id>/…`` data of one write, ``_registry/<group>.json`` what a group is,
``_versions/<group>/<number>.json`` what a version is: the writes it is made of, and facts about them.

* A version is committed by creating its file, which fails if the file is there. So of two writers one goes on to the
  next number and states its facts anew against what the other wrote; no version is lost, none is seen half written.
* Upserts merge on read: they write their own rows only, as a delta. On reading, the newest delta of a key hides its
  rows in earlier writes. The deltas' keys are grouped, the rest is joined against them; without deltas nothing is.
  ``compact`` folds deltas into one write, as an upsert does itself once there are many.

Any number of readers and writers. Commits are exclusive on local disks (hard links) and on file systems whose rename
refuses an existing target, as HDFS does.
"""

from __future__ import annotations

import json
import uuid
from dataclasses import dataclass
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.columns import all_of, as_list, present
from ..functions.scalars import fingerprint_columns
from ..functions.skew import HOT_ROWS, group_attach, hashable, spread
from .aggregate import version_diff
from .joins import FeatureView, training_set

REGISTRY = (
    "name string, entity_key string, timestamp_column string, description string, "
    "tags map<string,string>, created_at timestamp"
)
WRITE = "id string, version int, delta boolean, files bigint, bytes bigint, rows bigint, hash decimal(38,0)"
VERSIONS = (
    "feature_group string, version int, operation string, created_at timestamp, row_count bigint, "
    "column_count int, file_count bigint, size_bytes bigint, hash_sum decimal(38,0), "
    f"schema_json string, partition_columns array<string>, writes array<struct<{WRITE.replace(' ', ': ').replace(',:', ',')}>>, epoch_id bigint"
)
STAMP = "_feature_store_updated_at"
FOLD_AFTER = 16
ATTEMPTS = 100


@dataclass(frozen=True)
class VersionInfo:
    feature_group: str
    version: int
    row_count: int | None
    operation: str


class SmallFiles:
    """The store's own small files, through Hadoop's file systems, so on any storage that Spark reads."""

    def __init__(self, spark: SparkSession):
        self.jvm, self.conf = spark._jvm, spark._jsc.hadoopConfiguration()

    def _open(self, path: str):
        where = self.jvm.org.apache.hadoop.fs.Path(path)
        return where, where.getFileSystem(self.conf)

    def make_folder(self, path: str) -> None:
        where, fs = self._open(path)
        fs.mkdirs(where)

    def names(self, path: str) -> list[str]:
        where, fs = self._open(path)
        found = fs.listStatus(where) if fs.exists(where) else []
        return sorted(n for f in found if (n := f.getPath().getName())[0] not in "._")

    def read(self, path: str) -> dict | None:
        where, fs = self._open(path)
        if not fs.exists(where):
            return None
        stream = fs.open(where)
        try:
            return json.loads(self.jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
        finally:
            stream.close()

    def create(self, path: str, content: dict) -> bool:
        """Create a file with its whole content, or return False if it exists."""
        folder, _, name = path.rpartition("/")
        where, fs = self._open(path)
        hidden, _ = self._open(f"{folder}/.{name}-{uuid.uuid4().hex}")
        stream = fs.create(hidden, False)
        stream.write(json.dumps(content).encode())
        stream.close()
        if fs.getUri().getScheme() != "file":
            return fs.rename(hidden, where) or not fs.delete(hidden, False)
        local = [self.jvm.java.io.File(p.toUri().getPath()).toPath() for p in (where, hidden)]
        try:
            self.jvm.java.nio.file.Files.createLink(*local)  # a rename would replace the file
        except Exception as e:
            if "FileAlreadyExists" not in str(e):
                raise
            return False
        finally:
            fs.delete(hidden, False)
        return True


class FeatureStore:
    def __init__(self, spark: SparkSession, base: str):
        self.spark = spark
        self.base = base.rstrip("/")
        self.files = SmallFiles(spark)
        for name in ("_registry", "_versions"):
            self.files.make_folder(f"{self.base}/{name}")

    # --- registry ---------------------------------------------------------------------------

    def _table(self, name: str, schema: str) -> DataFrame:
        return self.spark.read.schema(schema).option("recursiveFileLookup", "true").json(f"{self.base}/{name}")

    def groups(self) -> DataFrame:
        return self._table("_registry", REGISTRY)

    def versions(self) -> DataFrame:
        return self._table("_versions", VERSIONS)

    def register(
        self, name: str, entity_key: str, timestamp_column: str, description: str = "", tags: dict | None = None
    ) -> None:
        row = {
            "name": name, "entity_key": entity_key, "timestamp_column": timestamp_column, "description": description,
            "tags": tags or {}, "created_at": _now()}
        if not self.files.create(f"{self.base}/_registry/{name}.json", row):
            raise ValueError(f"feature group {name!r} exists already")
        self.files.make_folder(f"{self.base}/_versions/{name}")

    def group(self, name: str) -> dict:
        row = self.files.read(f"{self.base}/_registry/{name}.json")
        if row is None:
            raise ValueError(f"feature group {name!r} is not registered")
        return row

    def list_groups(self) -> DataFrame:
        """Groups with their latest version and its rows."""
        newest = self.versions().groupBy(F.col("feature_group").alias("name")).agg(
            F.max("version").alias("latest_version"),
            F.max_by("row_count", "version").alias("total_rows"),
            F.max("created_at").alias("updated_at"),
        )
        return self.groups().join(newest, "name", "left").withColumns(
            {"latest_version": F.coalesce("latest_version", F.lit(0)),
             "total_rows": F.when(F.col("latest_version").isNull(), 0).otherwise(F.col("total_rows"))}
        )

    def history(self, name: str) -> DataFrame:
        return self.versions().filter(F.col("feature_group") == name).orderBy("version")

    def has_epoch(self, name: str, epoch_id: int) -> bool:
        return bool(
            self.versions().filter((F.col("feature_group") == name) & (F.col("epoch_id") == epoch_id)).take(1)
        )

    # --- reading ----------------------------------------------------------------------------

    def _version_row(self, name: str, version: int | None = None, as_of=None) -> dict:
        if as_of is not None:
            rows = self.versions().filter((F.col("feature_group") == name) & (F.col("created_at") <= F.lit(as_of).cast("timestamp")))
            if version is not None:
                rows = rows.filter(F.col("version") == version)
            version = rows.agg(F.max("version")).first()[0]
            row = None if version is None else self._read_version(name, version)
        else:
            row = self._latest(name) if version is None else self._read_version(name, version)
        if row is None:
            raise ValueError(f"no version of {name!r} for version={version}, as_of={as_of}")
        return row

    def _read_version(self, name: str, version: int) -> dict | None:
        return self.files.read(f"{self.base}/_versions/{name}/{version:09d}.json")

    def _latest(self, name: str) -> dict | None:
        """Row of the latest version, or None."""
        names = self.files.names(f"{self.base}/_versions/{name}")
        return self.files.read(f"{self.base}/_versions/{name}/{names[-1]}") if names else None

    def read(
        self, name: str, version: int | None = None, as_of=None, columns=None, filter_condition: str | None = None
    ) -> DataFrame:
        """A version (default: the latest), by number or by time, with column pruning and a filter.

        Unknown column names are skipped.
        """
        self.group(name)
        df = self._load(name, self._version_row(name, version, as_of))
        if filter_condition:
            df = df.filter(filter_condition)
        return df.select(*present(df, columns)) if columns else df

    def _written(self, name: str, row: dict) -> DataFrame:
        """All rows of a version's writes, hidden ones too, with the write they are from."""
        schema, root = T.StructType.fromJson(json.loads(row["schema_json"])), f"{self.base}/{name}"
        full = T.StructType(schema.fields + [T.StructField("_w", T.StringType())])
        paths = [f"{root}/_w={w['id']}" for w in row["writes"]]
        return self.spark.read.schema(full).option("basePath", root).parquet(*paths)

    def _load(self, name: str, row: dict) -> DataFrame:
        """The rows of a version that no later delta hides."""
        columns, writes = T.StructType.fromJson(json.loads(row["schema_json"])).names, row["writes"]
        rows, first = self._written(name, row), min(w["version"] for w in writes)
        deltas = [w["id"] for w in writes if w["delta"] and w["version"] > first]
        if not deltas:
            return rows.select(*columns)
        meta = self.group(name)
        keys = [meta["entity_key"], meta["timestamp_column"]]
        numbers = self.spark.createDataFrame([(w["id"], w["version"]) for w in writes], "_w string, __version int")
        rows = rows.join(F.broadcast(numbers), "_w")  # one row per write
        newest = rows.filter(F.col("_w").isin(deltas)).groupBy(*[F.col(k).alias(f"__n_{k}") for k in keys])
        newest = newest.agg(F.max("__version").alias("__newest"))
        hidden = [F.col(k) == F.col(f"__n_{k}") for k in keys] + [F.col("__newest") > F.col("__version")]
        return rows.join(newest, all_of(hidden), "left_anti").select(*columns)

    # --- writing ----------------------------------------------------------------------------

    def _write(self, df: DataFrame, name: str, partition_columns, delta: bool = False) -> dict:
        """Write a folder of its own; files, bytes, rows and content hash are taken from it as written, in one pass."""
        made = uuid.uuid4().hex
        root = f"{self.base}/{name}/_w={made}"
        writer = df.write.partitionBy(*partition_columns) if partition_columns else df.write
        writer.parquet(root)
        hashed, rows = fingerprint_columns(sorted(c for c in df.columns if c != STAMP))
        per_file = self.spark.read.schema(df.schema).parquet(root).groupBy("_metadata.file_path").agg(
            F.max("_metadata.file_size").alias("bytes"), rows.alias("rows"), hashed.alias("hash"))
        facts = per_file.agg(
            F.count(F.lit(1)), *[F.coalesce(F.sum(c), F.lit(0)).cast("decimal(38,0)") for c in ("bytes", "rows", "hash")]).first()
        return {"id": made, "delta": delta, **dict(zip(("files", "bytes", "rows", "hash"), map(int, facts), strict=True))}

    def _commit(
        self, name: str, before: dict | None, operation: str, made: dict, schema: T.StructType, parts, keep=(),
        replaced: tuple[int, int] | None = (0, 0), epoch_id=None,
    ) -> VersionInfo | None:
        """Create the next version's file, or return None if another writer was first.

        ``replaced`` are rows and content hash that ``made`` hides in the ``keep`` writes, None if not counted.
        """
        version = before["version"] + 1 if before else 1
        writes = [*keep, {**made, "version": version}]
        known = replaced is not None and (not keep or before["row_count"] is not None)
        old = (before["row_count"], before["hash_sum"]) if keep and known else (0, 0)
        row = {
            "feature_group": name, "version": version, "operation": operation, "created_at": _now(),
            "row_count": old[0] + made["rows"] - replaced[0] if known else None, "column_count": len(schema),
            "file_count": sum(w["files"] for w in writes), "size_bytes": sum(w["bytes"] for w in writes),
            "hash_sum": old[1] + made["hash"] - replaced[1] if known else None, "schema_json": schema.json(),
            "partition_columns": list(parts), "writes": writes, "epoch_id": epoch_id}
        if not self.files.create(f"{self.base}/_versions/{name}/{version:09d}.json", row):
            return None
        return VersionInfo(name, version, row["row_count"], operation)

    def _add(self, df: DataFrame, name: str, operation: str, partition_columns, keys=(), count=True, epoch_id=None) -> VersionInfo:
        """Write the rows once and commit them on top of whatever is the latest version by then."""
        before = self._latest(name)
        parts = before["partition_columns"] if before and operation != "overwrite" else as_list(partition_columns)
        if before and operation != "overwrite":
            df = appended(df, _schema(before))
        made = self._write(df, name, parts, delta=bool(keys))
        for _ in range(ATTEMPTS):
            schema, keep, replaced = df.schema, [], (0, 0)
            if before and operation != "overwrite":
                if before["partition_columns"] != parts:
                    raise ValueError(f"{name!r} is partitioned by {before['partition_columns']}, not by {parts}")
                schema, keep = combined(_schema(before), df.schema), before["writes"]
                if keys:
                    replaced = self._replaced(name, before, made["id"], df.schema, keys) if count else None
            info = self._commit(name, before, operation, made, schema, parts, keep, replaced, epoch_id)
            if info:
                return info
            before = self._latest(name)
        raise RuntimeError(f"no version of {name!r} could be committed in {ATTEMPTS} attempts")

    def _replaced(self, name: str, before: dict, made: str, schema: T.StructType, keys) -> tuple[int, int]:
        """Rows and content hash of the rows that a delta hides."""
        delta = self.spark.read.schema(schema).parquet(f"{self.base}/{name}/_w={made}").select(*keys)
        rows = self._load(name, before)
        hashed, number = fingerprint_columns(sorted(c for c in rows.columns if c != STAMP))
        found = rows.join(delta, list(keys), "left_semi").agg(number, hashed).first()
        return int(found[0]), int(found[1])

    def write(
        self, df: DataFrame, name: str, mode: str = "merge", partition_columns=None, epoch_id: int | None = None
    ) -> VersionInfo:
        """Write a new version: merge (upsert), overwrite or append. Adds the update time."""
        self.group(name)
        if mode == "merge":
            return self.upsert(df, name, partition_columns, epoch_id)
        if mode not in ("overwrite", "append"):
            raise ValueError(f"unknown mode {mode!r}")
        return self._add(df.withColumn(STAMP, F.current_timestamp()), name, mode, partition_columns, epoch_id=epoch_id)

    def upsert(
        self, source: DataFrame, name: str, partition_columns=None, epoch_id: int | None = None, order_by=None,
        count: bool = True, fold_after: int | None = FOLD_AFTER,
    ) -> VersionInfo:
        """Replace rows of equal entity key and event time, add the others; only the source is written.

        A source that repeats a key raises, or with ``order_by`` (columns, or none of them: ``[]``) its last row wins,
        equal ones by a hash of all values. ``count=False`` spares the look for replaced rows; rows and hash of the
        version are then unknown until it is compacted. With ``fold_after`` deltas the version is compacted.
        """
        meta = self.group(name)
        keys = [meta["entity_key"], meta["timestamp_column"]]
        if order_by is not None:
            source = last_rows(source, keys, order_by)
        elif source.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).filter("n > 1").take(1):
            raise ValueError(f"source holds several rows for one {keys}")
        info = self._add(source.withColumn(STAMP, F.current_timestamp()), name, "merge", partition_columns, keys, count, epoch_id)
        if fold_after and sum(w["delta"] for w in self._read_version(name, info.version)["writes"]) > fold_after:
            self.compact(name)
        return info

    def compact(self, name: str, num_files: int = 16) -> VersionInfo:
        """Rewrite the latest version into about ``num_files`` files, as a new version; deltas are folded."""
        for _ in range(ATTEMPTS):
            before = self._version_row(name)
            df, parts = self._load(name, before), before["partition_columns"]
            if parts:  # files per partition value in proportion to its bytes, one at least
                total = max(1, sum(w["bytes"] for w in before["writes"]))
                per_file = max(1, -(-total // num_files))
                size = F.max("_metadata.file_size").alias("bytes")
                sizes = self._written(name, before).groupBy(*parts, "_metadata.file_path").agg(size).groupBy(*parts).agg(
                    F.greatest(F.lit(1), F.round(F.sum("bytes") / per_file)).cast("int").alias("__files"))
                df = group_attach(df, sizes, parts)
                df = df.withColumn("__file", F.pmod(spread(hashable(df)), F.col("__files"))).repartition(*parts, "__file").drop("__files", "__file")
            else:
                df = df.repartition(num_files)
            info = self._commit(name, before, "compact", self._write(df, name, parts), df.schema, parts)
            if info:
                return info
        raise RuntimeError(f"{name!r} was written to during all of {ATTEMPTS} attempts to compact it")

    # --- use --------------------------------------------------------------------------------

    def compare(self, name: str, version_a: int, version_b: int) -> DataFrame:
        a, b = self.read(name, version_a), self.read(name, version_b)
        return version_diff(a.drop(STAMP), b.drop(STAMP))

    def view(self, name: str, columns=None, version: int | None = None, as_of=None) -> FeatureView:
        meta = self.group(name)
        df = self.read(name, version, as_of)
        chosen = present(df, columns) or [
            c for c in df.columns if c not in (meta["entity_key"], meta["timestamp_column"], STAMP)
        ]
        return FeatureView(name, df, meta["timestamp_column"], chosen, [STAMP])

    def point_in_time_join(
        self,
        entities: DataFrame,
        feature_groups,
        entity_key: str,
        event_timestamp_column: str,
        feature_columns: dict | None = None,
        hot_rows: int | None = HOT_ROWS,
    ) -> DataFrame:
        views = [self.view(g, (feature_columns or {}).get(g)) for g in as_list(feature_groups)]
        return training_set(entities, views, entity_key, event_timestamp_column, hot_rows)


def _now() -> str:
    return datetime.now(timezone.utc).isoformat()


def _schema(row: dict) -> T.StructType:
    return T.StructType.fromJson(json.loads(row["schema_json"]))


def combined(old: T.StructType, new: T.StructType) -> T.StructType:
    """The old columns, then those that are new; another type raises."""
    have = {f.name: f.dataType for f in new}
    other = [f"{f.name}: {have[f.name].simpleString()} for {f.dataType.simpleString()}" for f in old if have.get(f.name, f.dataType) != f.dataType]
    if other:
        raise ValueError(f"a write to an existing group cannot change types: {', '.join(other)}")
    return T.StructType([*old, *[f for f in new if f.name not in old.names]])


def appended(df: DataFrame, old: T.StructType) -> DataFrame:
    """The frame in the old column order; columns it lacks are NULL, new ones come last, another type raises."""
    columns = [F.col(f.name) if f.name in df.columns else F.lit(None).cast(f.dataType).alias(f.name) for f in combined(old, df.schema)]
    return df.select(*columns)


def last_rows(source: DataFrame, keys, order_by=()) -> DataFrame:
    """One row per key: the last in ``order_by`` order, of equal ones that with the largest hash of all values."""
    order = [*[F.col(o).desc() for o in as_list(order_by)], F.xxhash64(*hashable(source)).desc()]
    newest = Window.partitionBy(*as_list(keys)).orderBy(*order)
    return source.withColumn("__rn", F.row_number().over(newest)).filter("__rn = 1").drop("__rn")


def merge_rows(target: DataFrame, source: DataFrame, keys) -> DataFrame:
    """Target rows without a counterpart, plus the source; columns by name, missing ones NULL."""
    keys = as_list(keys)
    kept = target.join(source.select(*keys), keys, "left_anti")
    return kept.unionByName(source, allowMissingColumns=True)


def merge_latest(target: DataFrame, source: DataFrame, keys, order_by) -> DataFrame:
    """Upsert of a source that may repeat keys: its last row in ``order_by`` order wins."""
    return merge_rows(target, last_rows(source, keys, order_by), keys)
