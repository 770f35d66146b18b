"""What the operators share: tables, words, keys, staged intermediate results."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from recordloom.sinks.staging import scratch_path

# White space as the contracts define it, for Java, Python and RE2 expressions alike.
SPACE = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]+"


def read(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


def keep(df: DataFrame, options: dict[str, str] | None = None) -> DataFrame:
    """Write ``df`` as a table in the shared folder and return the table read back.

    It cuts lineage: a lost executor costs later steps a re-read of the table.  ``options`` go
    to the writer.
    """
    spark = df.sparkSession
    path = scratch_path(spark, "llm")
    df.write.options(**(options or {})).parquet(path)
    table = spark.read.schema(df.schema).parquet(path)
    table.kept_path = path
    return table


def word_count(text: Column) -> Column:
    """Words of the whole text, 0 for null.  Words become one character each, spaces go."""
    marks = F.regexp_replace(F.regexp_replace(text, WORD, "x"), SPACE, "")
    return F.coalesce(F.length(marks), F.lit(0)).cast("long")


def without(df: DataFrame, names: list[str]) -> DataFrame:
    """Without the columns that the operator is about to add under the same names."""
    taken = {n.lower() for n in names}
    return df.select(*[F.col(f"`{c}`") for c in df.columns if c.lower() not in taken])


class Apart:
    """A table whose columns stand under names of their own while an operator adds others."""

    def __init__(self, df: DataFrame):
        self.names = df.columns
        self.own = [f"own_{i}" for i in range(len(self.names))]
        self.table = df.toDF(*self.own)

    def __getitem__(self, name: str) -> str:
        return self.own[[n.lower() for n in self.names].index(name.lower())]

    def back(self, df: DataFrame) -> DataFrame:
        """The table's columns out of a result that still holds them, under their first names."""
        return df.select(*self.own).toDF(*self.names)


def discard(table: DataFrame) -> None:
    """Delete a table that ``keep`` wrote, once all that read it is written itself."""
    context = table.sparkSession.sparkContext
    path = context._jvm.org.apache.hadoop.fs.Path(table.kept_path)
    path.getFileSystem(context._jsc.hadoopConfiguration()).delete(path, True)
