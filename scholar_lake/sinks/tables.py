"""The lake's tables: Parquet in buckets of the owner id, exchanged bucket by bucket.

``<out>/tables/<table>/run=<id>/bucket=<b>/*.parquet`` holds a bucket as written by a run, and ``<out>/commits`` one row per
bucket written, with that id, which no other run shares. A run writes new folders only, reads none of them, and becomes visible with one small Parquet write
to ``commits`` that covers all tables, the watermark and the input files together: a run that dies half way leaves
the lake as it was. Buckets that no changed or deleted id falls into are not read or written.
"""

from __future__ import annotations

import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from scholar_lake.operators.cluster import with_cluster_key
from scholar_lake.operators.dedup import latest_wins
from scholar_lake.operators.merge import exchange_rows
from scholar_lake.schemas import CLUSTER_COLUMNS, LOOKUP_COLUMNS, TableSpec

DEFAULT_BUCKETS = 64
COMMIT_DDL = "commit bigint, kind string, name string, bucket int, value string"


def bucket_of(owner: Column, buckets: int) -> Column:
    return F.pmod(F.xxhash64(owner.cast("string")), F.lit(buckets)).cast("int")


class LakeTables:
    """Tables below one folder.

    ``buckets`` bounds the path lists and bucket lists that pass through the driver. The first commit writes the number down, and it holds
    from then on: another one is refused, as rows would be looked for in the wrong buckets.
    """

    def __init__(self, spark: SparkSession, out: str, buckets: int | None = None):
        self.spark, self.out, self.run = spark, out.rstrip("/"), uuid.uuid4().hex
        self._state: dict[str, dict[int, str]] | None = None
        stored = self.log().where(F.col("kind") == "buckets").agg(F.min("bucket")).first()[0]
        if stored and buckets and stored != buckets:
            raise ValueError(f"{self.out} has {stored} buckets, not {buckets}")
        self.buckets = stored or buckets or DEFAULT_BUCKETS

    # -- the commit log -------------------------------------------------------------------------------------------

    def log(self) -> DataFrame:
        try:
            return self.spark.read.schema(COMMIT_DDL).parquet(f"{self.out}/commits")
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            return self.spark.createDataFrame([], COMMIT_DDL)

    def next_commit(self) -> int:
        return (self.log().agg(F.max("commit")).first()[0] or 0) + 1

    def watermarks(self) -> dict[str, str]:
        """Newest partition date that finished runs have read, per target ("work tables", "work search", ...)."""
        rows = self.log().where(F.col("kind") == "watermark").groupBy("name").agg(F.max("value").alias("value")).collect()
        return {row["name"]: row["value"] for row in rows}

    def processed(self, targets: list[str]) -> DataFrame:
        """``file_path`` of the input files that finished runs have read for all of the targets."""
        read = self.log().where((F.col("kind") == "file") & F.col("name").isin(targets))
        return (read.groupBy(F.col("value").alias("file_path")).agg(F.size(F.collect_set("name")).alias("n"))
                .where(F.col("n") == len(targets)).select("file_path"))

    def done(self, label: str) -> bool:
        """Whether a run with this label (for instance a stream batch) has been committed."""
        return not self.log().where((F.col("kind") == "label") & (F.col("value") == label)).isEmpty()

    def commit(self, number: int, written: dict[str, dict[int, bool]], files: DataFrame | None = None,
               watermarks: dict[str, str] | None = None, label: str | None = None) -> None:
        """Publish what a run wrote.

        ``written`` says for each table and bucket whether any row is left in it; ``files`` (``target, file_path``) and
        ``watermarks`` what was read for which target.
        """
        rows = [(number, "bucket", table, bucket, self.run if full else "")
                for table, states in written.items() for bucket, full in states.items()]
        rows.append((number, "buckets", None, self.buckets, None))
        rows += [(number, "watermark", target, None, date) for target, date in (watermarks or {}).items()]
        rows += [(number, "label", None, None, label)] if label else []
        entries = self.spark.createDataFrame(rows, COMMIT_DDL)
        if files is not None:
            entries = entries.unionByName(files.select(
                F.lit(number).cast("bigint").alias("commit"), F.lit("file").alias("kind"), F.col("target").alias("name"),
                F.lit(None).cast("int").alias("bucket"), F.col("file_path").alias("value")))
        entries.coalesce(1).write.mode("append").parquet(f"{self.out}/commits")
        self._state, self.run = None, uuid.uuid4().hex

    # -- reading --------------------------------------------------------------------------------------------------

    def _newest(self) -> dict[str, dict[int, str]]:
        """For each table and bucket the run whose rows it holds; '' if it is empty.

        Read once and kept until the next commit: at most tables x buckets entries.
        """
        if self._state is None:
            rows = (self.log().where(F.col("kind") == "bucket").groupBy("name", "bucket")
                    .agg(F.max(F.struct("commit", "value")).alias("last")).collect())
            self._state = {}
            for row in rows:
                self._state.setdefault(row["name"], {})[row["bucket"]] = row["last"]["value"]
        return self._state

    def live_paths(self, table: str, buckets: list[int] | None = None) -> list[str]:
        """Folders that hold the current rows of a table, or of some of its buckets."""
        return [f"{self.out}/tables/{table}/run={run}/bucket={bucket}"
                for bucket, run in sorted(self._newest().get(table, {}).items())
                if run and (buckets is None or bucket in buckets)]

    def read(self, spec: TableSpec, buckets: list[int] | None = None) -> DataFrame:
        """Current rows of a table, or of some of its buckets."""
        paths = self.live_paths(spec.name, buckets)
        if not paths:
            return self.spark.createDataFrame([], spec.ddl)
        return self.spark.read.schema(spec.ddl).parquet(*paths)

    # -- writing --------------------------------------------------------------------------------------------------

    def touched(self, ids: DataFrame) -> list[int]:
        """Buckets that hold any of the ids: at most ``buckets`` numbers."""
        rows = ids.select(bucket_of(F.col("id"), self.buckets).alias("b")).distinct().collect()
        return sorted(row["b"] for row in rows)

    def replace(self, spec: TableSpec, new: DataFrame, gone: list[DataFrame], buckets: list[int]) -> dict[int, bool]:
        """Write buckets without the rows of the changed or deleted owners and with the new rows, with one exchange for both."""
        owner = F.col(spec.owner)
        rows = exchange_rows(self.read(spec, buckets), new, gone, spec.owner, bucket_of(owner, self.buckets), self._parts(), spec.is_link)
        return self._store(spec, rows.withColumnRenamed("_place", "bucket"), buckets)

    def compete(self, spec: TableSpec, rows: DataFrame, order: list[Column], buckets: list[int]) -> dict[int, bool]:
        """Write buckets with the first row of each key, in the given order, among the stored rows and the given ones, with one exchange for both."""
        part = F.pmod(F.xxhash64(F.lit(1), F.col(spec.owner)), F.lit(self._parts())).cast("int")
        every = self.read(spec, buckets).unionByName(rows).select("*", bucket_of(F.col(spec.owner), self.buckets).alias("bucket"), part.alias("_part"))
        best = latest_wins(every.repartition("bucket", "_part"), ["bucket", "_part", *spec.key], order)
        return self._store(spec, best.drop("_part"), buckets)

    def write(self, spec: TableSpec, rows: DataFrame, buckets: list[int]) -> dict[int, bool]:
        """Write the new content of some buckets into this run's folder; tells which of them hold rows.

        The rebalance hint gathers each bucket into files of the advisory size and splits a bucket that is far larger
        than the rest over several tasks.
        """
        placed = rows.withColumn("bucket", bucket_of(F.col(spec.owner), self.buckets))
        return self._store(spec, placed.hint("rebalance", F.col("bucket")), buckets)

    def _parts(self) -> int:
        """Tasks that share a bucket."""
        return -(-int(self.spark.conf.get("spark.sql.shuffle.partitions")) // self.buckets)

    def _store(self, spec: TableSpec, placed: DataFrame, buckets: list[int]) -> dict[int, bool]:
        """Rows are sorted by owner, or by several columns at once, so that row-group statistics serve lookups by them; bloom filters serve ids and
        DOIs of works and authors of authorships."""
        path = f"{self.out}/tables/{spec.name}/run={self.run}"
        if spec.name in CLUSTER_COLUMNS:
            keyed = with_cluster_key(placed, CLUSTER_COLUMNS[spec.name])
            placed = keyed.sortWithinPartitions("bucket", "_cluster", spec.owner).drop("_cluster")
        else:
            placed = placed.sortWithinPartitions("bucket", spec.owner)
        writer = placed.write.mode("overwrite").partitionBy("bucket")
        for column in LOOKUP_COLUMNS.get(spec.name, ()):
            writer = writer.option(f"parquet.bloom.filter.enabled#{column}", "true")
        writer.parquet(path)
        stored = self.spark.read.schema("bucket int").parquet(path).distinct().collect()
        full = {row["bucket"] for row in stored}
        return {bucket: bucket in full for bucket in buckets}

    def clear(self, specs: list[TableSpec]) -> None:
        """Empty the tables."""
        everything = {bucket: False for bucket in range(self.buckets)}
        self.commit(self.next_commit(), {spec.name: everything for spec in specs})

    def remove_superseded(self) -> list[str]:
        """Delete the folders of tables that no current bucket is read from, and all staged records; returns the deleted paths.

        Only for a time when no run is under way and no reader holds an older state.
        """
        hadoop = self.spark._jvm.org.apache.hadoop.fs.Path
        live = {path for table in self._newest() for path in self.live_paths(table)}
        files = hadoop(self.out).getFileSystem(self.spark._jsc.hadoopConfiguration())
        gone = []
        for status in files.globStatus(hadoop(f"{self.out}/tables/*/run=*/bucket=*")) or []:
            path = status.getPath()
            if not any(path.toUri().getPath().endswith(kept[len(self.out):]) for kept in live):
                gone.append(path)
        gone += [status.getPath() for status in files.globStatus(hadoop(f"{self.out}/staging/*")) or []]
        for path in gone:
            files.delete(path, True)
        return [path.toString() for path in gone]
