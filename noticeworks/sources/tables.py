"""Named tables: scan, overwrite, append, in-place replacement, schema enforcement."""

from __future__ import annotations

import uuid
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from noticeworks.session import newest_note, remove, scratch_dir, write_note

#: Replaced versions of a table that stay for their readers.
GRACE = 2


@dataclass(frozen=True)
class Tables:
    """Where tables live: folders below ``root``, or catalog tables ``<database>.<name>``."""

    spark: SparkSession
    root: str | None = None
    database: str | None = None
    fmt: str = "parquet"

    def _catalog_name(self, name: str) -> str:
        return f"{self.database}.{name}" if self.database else name

    def _folder(self, name: str) -> tuple[str, int]:
        """Where the rows of a table lie below the root, and the number of its pointer; 0 without one."""
        newest = newest_note(self.spark, f"{self.root}/.pointers/{name}")
        return (newest["body"], newest["v"]) if newest else (name, 0)

    def read(self, name: str) -> DataFrame:
        if self.root is None:
            return self.spark.read.table(self._catalog_name(name))
        return self.spark.read.format(self.fmt).load(f"{self.root}/{self._folder(name)[0]}")

    def _write(self, df: DataFrame, folder: str, mode: str) -> None:
        df.write.format(self.fmt).mode(mode).save(f"{self.root}/{folder}")

    def write(self, df: DataFrame, name: str, mode: str) -> None:
        if self.root is None:
            df.write.format(self.fmt).mode(mode).saveAsTable(self._catalog_name(name))
        else:
            self._write(df, self._folder(name)[0], mode)

    def overwrite(self, df: DataFrame, name: str) -> None:
        if self.root is not None and self._folder(name)[1]:
            self.replace(df, name)
        else:
            self.write(df, name, "overwrite")

    def append(self, df: DataFrame, name: str) -> None:
        self.write(df, name, "append")

    def replace(self, df: DataFrame, name: str) -> None:
        """Overwrite a table with rows derived from it.

        A folder is written anew as a version of its own; then one small pointer file makes it the table. Who has
        resolved the pointer before reads the old version on, which is dropped ``GRACE`` replacements later; what a
        writer leaves that dies between the steps is never read. One writer at a time. A catalog table, which cannot be
        overwritten while it is read, is staged in the shared scratch folder; that copy goes once the table is written.
        """
        if self.root is None:
            staged = scratch_dir(self.spark, f"staged-{name}")
            df.write.parquet(staged)
            self.overwrite(self.spark.read.schema(df.schema).parquet(staged), name)
            remove(self.spark, staged)
            return
        pointers = f"{self.root}/.pointers/{name}"
        _, now = self._folder(name)
        folder = f".versions/{name}/{now + 1}-{uuid.uuid4().hex}"
        self._write(df, folder, "error")
        write_note(self.spark, pointers, now + 1, folder)
        gone = now + 1 - GRACE
        if gone == 0:
            remove(self.spark, f"{self.root}/{name}")
        elif gone > 0:
            old = self.spark.read.schema("body string").json(f"{pointers}/v={gone}").first()
            remove(self.spark, f"{self.root}/{old['body']}")
            remove(self.spark, f"{pointers}/v={gone}")


def small_table(spark: SparkSession, **columns: list) -> DataFrame:
    """A table of driver constants; its exact size is known to the planner."""
    return spark.createDataFrame(pa.table(columns))


def enforce(df: DataFrame, schema: StructType) -> DataFrame:
    """Columns of ``schema`` in order; values that do not convert become NULL."""
    return df.select(
        *[F.col(f.name).try_cast(f.dataType).alias(f.name) for f in schema.fields]
    )
