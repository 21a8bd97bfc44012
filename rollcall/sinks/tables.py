"""Stored tables: append, upsert and scope delete.

``ScopedTable`` rewrites only the cities a change touches. ``Snapshots`` writes whole
versions, for tables that must change all at once.
"""

from __future__ import annotations

from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType
from pyspark.sql.utils import AnalysisException

from rollcall.operators.linkage import SCOPE
from rollcall.scratch import keep


def append_listings(listings: DataFrame, path: str, scope: tuple[str, ...] = SCOPE) -> None:
    """Appends by city. The rebalance puts a city's rows together and splits large cities into several files."""
    listings.hint("rebalance", *scope).write.mode("append").partitionBy(*scope).parquet(path)


def write_batch(rows: DataFrame, path: str, batch: str, scope: str = "city") -> None:
    """Writes a batch into its own folder below each city. Writing the same batch again replaces it."""
    labelled = rows.withColumn("batch", F.lit(batch))
    labelled.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(scope, "batch").parquet(path)


def stored_columns(spark: SparkSession, path: str, schema: str) -> DataFrame | None:
    """The named columns of a table, null while nothing is stored at ``path``."""
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return None


def read_scope(spark: SparkSession, path: str, city: str | None = None) -> DataFrame:
    """A table partitioned by city; with ``city`` only that partition's folder is read."""
    df = spark.read.parquet(path)
    return df if city is None else df.where(F.col("city") == city)


def upsert(current: DataFrame, changes: DataFrame, key: str = "id") -> DataFrame:
    """Inserts new keys and updates known ones. A null in ``changes`` keeps the stored value.

    A column that only one side has is kept, null where its side has no row.
    """
    fresh = changes.select(key, *[F.col(c).alias(f"new_{c}") for c in changes.columns if c != key])
    joined = current.join(fresh, key, "full")
    shared = [F.col(c) if c == key or c not in changes.columns else F.coalesce(F.col(f"new_{c}"), F.col(c)).alias(c) for c in current.columns]
    return joined.select(*shared, *[F.col(f"new_{c}").alias(c) for c in changes.columns if c not in current.columns])


def without_scopes(df: DataFrame, cities: list[str], scope: str = "city") -> DataFrame:
    """The table without the rows of the named cities."""
    return df.where(~F.col(scope).isin(*cities)) if cities else df


class ScopedTable:
    """A Parquet table with one folder per city under ``path``.

    With a ``schema`` the columns are read as it says, else as the files and folder names suggest.
    """

    def __init__(self, spark: SparkSession, path: str, scope: str = "city", schema: StructType | None = None):
        self.spark, self.path, self.scope, self.schema = spark, path.rstrip("/"), scope, schema

    def _files(self):
        folder = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(self.path)
        return folder.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()), folder

    def _folders(self) -> dict[str, object]:
        """Folder of each city that has rows."""
        files, root = self._files()
        if not files.exists(root):
            return {}
        mark = f"{self.scope}="
        names = [(unquote(s.getPath().getName()), s.getPath()) for s in files.listStatus(root) if s.isDirectory()]
        return {name[len(mark) :]: path for name, path in names if name.startswith(mark)}

    def scopes(self) -> list[str]:
        return sorted(self._folders())

    def read(self, cities: list[str] | None = None) -> DataFrame | None:
        """The table, or the named cities of it; null when nothing is stored yet."""
        if not self._folders():
            return None
        reader = self.spark.read.option("mergeSchema", True) if self.schema is None else self.spark.read.schema(self.schema)
        df = reader.parquet(self.path)
        return df if cities is None else df.where(F.col(self.scope).isin(*cities))

    def append(self, rows: DataFrame) -> None:
        append_listings(rows, self.path, (self.scope,))

    def replace(self, rows: DataFrame) -> None:
        """Replaces the cities that occur in ``rows`` and leaves all others as they are.

        ``rows`` is written to scratch first, so it may be computed from this table.
        """
        ready = keep(rows, "replace")
        ready.df.hint("rebalance", self.scope).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(self.scope).parquet(self.path)
        ready.drop()

    def upsert(self, changes: DataFrame, key: str = "id") -> None:
        """Upserts by key inside the touched cities; a row must not move to another city.

        The touched cities are joined to the stored ones, so Spark can leave the other folders unread; only touched
        ones are rewritten.
        """
        ready = keep(changes, "changes")
        current = self.read()
        if current is None:
            self.append(ready.df)
        else:
            touched = current.join(ready.df.select(self.scope).distinct(), self.scope, "left_semi")
            self.replace(upsert(touched, ready.df, key))
        ready.drop()

    def delete_scopes(self, cities: list[str]) -> None:
        """Removes the folders of the named cities."""
        files, _ = self._files()
        for city, folder in self._folders().items():
            if city in cities:
                files.delete(folder, True)
        self.spark.catalog.refreshByPath(self.path)


def drop_other_scopes(spark: SparkSession, path: str, written: list[str], wanted: list[str] | None, scope: str = "city") -> None:
    """Removes the folders of ``wanted`` cities (all when null) that a fresh write gave no rows."""
    table = ScopedTable(spark, path, scope)
    table.delete_scopes([c for c in table.scopes() if c not in written and (wanted is None or c in wanted)])


class Snapshots:
    """A table kept as numbered snapshot folders under ``root``."""

    def __init__(self, spark: SparkSession, root: str, scope: tuple[str, ...] = SCOPE):
        self.spark, self.root, self.scope = spark, root.rstrip("/"), scope

    def version(self) -> int:
        try:
            row = self.spark.read.parquet(f"{self.root}/versions").agg(F.max("version")).first()
            return row[0] if row[0] is not None else 0
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            return 0

    def read(self) -> DataFrame | None:
        number = self.version()
        return self.spark.read.parquet(f"{self.root}/v{number}") if number else None

    def write(self, df: DataFrame) -> DataFrame:
        number = self.version() + 1
        df.hint("rebalance", *self.scope).write.mode("overwrite").partitionBy(*self.scope).parquet(f"{self.root}/v{number}")
        self.spark.range(1).select(F.lit(number).alias("version")).write.mode("append").parquet(f"{self.root}/versions")
        return self.spark.read.parquet(f"{self.root}/v{number}")

    def upsert(self, changes: DataFrame, key: str = "id") -> DataFrame:
        current = self.read()
        return self.write(changes if current is None else upsert(current, changes, key))

    def delete_scopes(self, cities: list[str]) -> DataFrame | None:
        current = self.read()
        return None if current is None else self.write(without_scopes(current, cities))
