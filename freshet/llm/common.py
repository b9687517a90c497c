"""Small helpers the operators share."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from freshet.session import fresh_path

# The white space of every word rule here, as a regular expression.
SPACE = r"[\x20\x09-\x0D]+"


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A given table."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a table below the shared folder of the cluster.

    Cuts the lineage: what follows reads files that outlive any executor.
    """
    spark = df.sparkSession
    path = fresh_path(spark, f"llm-{name}")
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` evaluated once.

    A lambda that mentions an outer expression evaluates it for every element;
    a variable of an enclosing lambda is bound to the finished value.
    """
    return F.get(F.transform(F.array(value), body), F.lit(0))


def words(text: Column) -> Column:
    """The words of a text: runs of anything but ASCII white space; null text has none."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), SPACE), "")


def in_share(id_column: Column, modulus: int, remainder: int) -> Column:
    """Whether crc32 of an id, as text, leaves this remainder; a null id counts as empty text."""
    return F.crc32(F.coalesce(id_column.cast("string"), F.lit("")).cast("binary")) % modulus == remainder
