"""Parquet tables of the three layers.

A table folder holds ``version=N`` folders, and those hold a ``batch=<id>`` folder per write.  A batch counts once Spark's
``_SUCCESS`` marker is there, which appears when the write job commits: readers see a write as a whole or not at all, and a write
repeated under its id takes the place of the first.  A full refresh starts a new version with its batch 0; the highest
version that has one is current.

Some tables are partitioned by an expression over their key (``PARTITIONS``), so rows with one key share a partition, and a
merge reads only the partitions its batch has keys in.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tarmac.operators.keys import max_id
from tarmac.operators.merge import first_per_key, has_null, new_rows
from tarmac.schemas import MARKS, MARKS_SCHEMA, PARTITIONS, SCHEMAS
from tarmac.session import cut_lineage


class Table:
    def __init__(self, spark: SparkSession, root: str, name: str, schema: str | None = None, part: str | None = None):
        self.spark, self.root, self.name = spark, root, name
        self.path = f"{root.rstrip('/')}/{name.replace('.', '/')}"
        self.schema = schema or SCHEMAS[name]
        self.part = part or PARTITIONS.get(name)

    # ------------------------------------------------------------------------------ folders

    def _complete(self, version: int) -> list[str]:
        """Ids of the batches whose write has committed."""
        found = []
        for name in self._names(self._folder(version)):
            if name.startswith("batch=") and "_SUCCESS" in self._names(f"{self._folder(version)}/{name}"):
                found.append(name.removeprefix("batch="))
        return found

    def _names(self, folder: str) -> list[str]:
        path = self.spark._jvm.org.apache.hadoop.fs.Path(folder)
        fs = path.getFileSystem(self.spark._jsc.hadoopConfiguration())
        return [s.getPath().getName() for s in fs.listStatus(path)] if fs.exists(path) else []

    def _folder(self, version: int) -> str:
        return f"{self.path}/version={version}"

    def _versions(self) -> list[int]:
        """Versions that a refresh completed; the first one may also hold appended batches only."""
        numbers = sorted(int(n.removeprefix("version=")) for n in self._names(self.path) if n.startswith("version="))
        return [n for n in numbers if (batches := self._complete(n)) and (n == 1 or "0" in batches)]

    def exists(self) -> bool:
        return bool(self._versions())

    def batches(self) -> list[str]:
        """Ids of the batches of the current version."""
        versions = self._versions()
        return self._complete(versions[-1]) if versions else []

    # ------------------------------------------------------------------------------ reading

    def read(self, parts: list[str] | None = None, batches: list[str] | None = None, but: str | None = None) -> DataFrame:
        """Current content, or only some partitions or batches of it; an absent table reads as empty."""
        versions = self._versions()
        chosen = [b for b in (self._complete(versions[-1]) if versions else []) if b != but and (batches is None or b in batches)]
        if not chosen:
            return self.spark.createDataFrame([], self.schema)
        base = self._folder(versions[-1])
        schema = f"{self.schema}, part string" if self.part else self.schema
        scan = self.spark.read.schema(schema).option("basePath", base).parquet(*[f"{base}/batch={b}" for b in chosen])
        if parts is not None and self.part:
            scan = scan.where(F.col("part").isin(parts))
        return scan.select(*self._fields())

    def _fields(self) -> list[str]:
        return self.spark.createDataFrame([], self.schema).columns

    def parts_of(self, rows: DataFrame) -> list[str] | None:
        """Partitions that ``rows`` have keys in: at most as many as the table has."""
        if not self.part:
            return None
        return [r.part for r in rows.select(F.expr(self.part).cast("string").alias("part")).distinct().collect()]

    # ------------------------------------------------------------------------------ writing

    def _write(self, df: DataFrame, version: int, batch: str) -> None:
        fields = self.spark.createDataFrame([], self.schema).schema.fields
        shaped = df.select(*[df[f.name].cast(f.dataType).alias(f.name) for f in fields])
        if self.part:
            # few files per partition; a large partition is split among tasks
            shaped = shaped.withColumn("part", F.expr(self.part).cast("string")).hint("rebalance", "part")
        writer = shaped.write.mode("overwrite")
        (writer.partitionBy("part") if self.part else writer).parquet(f"{self._folder(version)}/batch={batch}")

    def replace(self, df: DataFrame) -> None:
        """Full refresh; ``df`` may read this table, since the old version stays untouched."""
        versions = self._versions()
        self._write(df, (versions[-1] if versions else 0) + 1, "0")

    def append(self, df: DataFrame, batch: str | int | None = None) -> None:
        """Add a batch.  Under the id of an earlier one it takes that one's place."""
        versions = self._versions() or [1]
        if batch is None:
            numbers = [int(b) for b in self._complete(versions[-1]) if b.isdigit()]
            batch = max(numbers, default=0) + 1
        self._write(df, versions[-1], str(batch))

    def new_rows(self, batch: DataFrame, keys: list[str], order: list[Column], replacing: str | None = None, **options) -> DataFrame:
        """Rows an insert-only merge adds, were the batch ``replacing`` not there."""
        if not self.part:
            return new_rows(batch, self.read(but=replacing), keys, order, **options)
        # written once: its partitions are looked up before it is merged
        first = cut_lineage(first_per_key(batch.where(~has_null(keys)), keys, order))
        present = self.read(self.parts_of(first), but=replacing)
        return first.join(present.select(*keys), keys, "left_anti").select(*batch.columns)

    def merge(self, batch: DataFrame, keys: list[str], order: list[Column], batch_id: str | int | None = None, **options) -> None:
        """Insert-only merge: only the new rows are written."""
        replacing = None if batch_id is None else str(batch_id)
        self.append(self.new_rows(batch, keys, order, replacing, **options), batch_id)

    def drop_old_versions(self, keep: int = 2) -> None:
        """Delete all but the newest ``keep`` versions."""
        jvm = self.spark._jvm
        for version in self._versions()[:-keep]:
            path = jvm.org.apache.hadoop.fs.Path(self._folder(version))
            path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)


def take_ids(table: Table, id_column: str, count: int) -> int:
    """The id after which ``count`` ids belong to the caller alone.

    A small table keeps the last id given out per table, so no ids are searched for but the first time.  A range whose
    batch is never written stays unused.
    """
    marks = Table(table.spark, table.root, MARKS, MARKS_SCHEMA)
    given = {r.source_table: r.upto for r in marks.read().collect()}  # one row per table
    after = given.get(table.name)
    if after is None:
        after = max_id(table.read(), id_column)
    marks.replace(table.spark.createDataFrame([*(given | {table.name: after + count}).items()], MARKS_SCHEMA))
    marks.drop_old_versions()
    return after


def write_relational(df: DataFrame, url: str, table: str, batch_rows: int = 10_000, **options) -> None:
    """Append to a relational database over JDBC, in batches; needs that database's driver."""
    df.write.mode("append").options(batchsize=str(batch_rows), **options).jdbc(url, table)
