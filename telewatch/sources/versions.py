"""Whole versions of a small table under one folder.

A version is written beside the others and becomes the table when its marker
file exists.  Readers take the newest marked version, so a writer that dies at
any point leaves the table as it was.  The version before the newest stays for
readers that have begun; older ones go.  One writer at a time is assumed.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from telewatch.session import hadoop_fs

MARK = "committed-"


def create_marker(spark: SparkSession, path: str) -> None:
    """An empty file; raises if it exists."""
    fs, p = hadoop_fs(spark, path)
    fs.create(p, False).close()


def names_under(spark: SparkSession, path: str) -> list[str]:
    fs, p = hadoop_fs(spark, path)
    return sorted(s.getPath().getName() for s in fs.listStatus(p)) if fs.exists(p) else []


def delete(spark: SparkSession, path: str) -> None:
    fs, p = hadoop_fs(spark, path)
    fs.delete(p, True)


class Versions:
    def __init__(self, spark: SparkSession, path: str, schema: str):
        self.spark, self.path, self.schema = spark, path.rstrip("/"), schema

    def committed(self) -> list[str]:
        """Names of the versions that readers may see, oldest first."""
        return [n[len(MARK):] for n in names_under(self.spark, self.path) if n.startswith(MARK)]

    def read(self) -> DataFrame | None:
        """The newest version; None before the first."""
        names = self.committed()
        return self.spark.read.schema(self.schema).parquet(f"{self.path}/{names[-1]}") if names else None

    def write(self, df: DataFrame) -> None:
        """``df`` becomes the table; it may read the table."""
        names = self.committed()
        number = int(names[-1].split("-")[0]) + 1 if names else 0
        name = f"{number:012d}-{uuid.uuid4().hex[:8]}"
        df.write.parquet(f"{self.path}/{name}")
        self.commit(name)
        for old in names[:-1]:
            delete(self.spark, f"{self.path}/{MARK}{old}")
            delete(self.spark, f"{self.path}/{old}")

    def commit(self, name: str) -> None:
        create_marker(self.spark, f"{self.path}/{MARK}{name}")
