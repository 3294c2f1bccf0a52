"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from telewatch.session import checkpoint_root, scratch_path
from telewatch.sources.tables import hadoop_fs

# ASCII white space [\x20\x09-\x0D] and the ASCII letters, in code point order.
WHITE_SPACE = " \t\n\x0b\x0c\r"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = UPPER.lower()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fresh(df: DataFrame, *names: str) -> list[str]:
    """Column names made from ``names`` that ``df`` does not have (Spark
    resolves names without case), so helper columns never clash."""
    taken = {c.lower() for c in df.columns}
    out = []
    for name in names:
        while name.lower() in taken:
            name = f"_{name}"
        taken.add(name.lower())
        out.append(name)
    return out


def col(name: str) -> Column:
    """The column of exactly this name, dots and back-ticks included."""
    return F.col("`" + name.replace("`", "``") + "`")


def ascii_lower(text: Column) -> Column:
    """Lower-case A-Z alone; the built-in ``lower`` serves texts that are all ASCII."""
    return F.when(F.octet_length(text) == F.length(text), F.lower(text)).otherwise(
        F.translate(text, UPPER, LOWER)
    )


def checkpoint(df: DataFrame) -> DataFrame:
    """Cut the lineage in the shared checkpoint folder, which outlives executors."""
    spark = df.sparkSession
    root = checkpoint_root(spark)
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(root)
    return df.checkpoint(eager=True)


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once as Parquet in the shared folder and read back: it is
    computed once however often it is used, and survives lost executors.  The
    folder goes when the application ends."""
    path = scratch_path(df.sparkSession, name)
    fs, folder = hadoop_fs(df.sparkSession, path)
    fs.deleteOnExit(folder)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
