"""Small helpers of the corpus operators: table access, size-based partition counts, lineage cuts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..session import ensure_checkpoint_dir

MB = 1 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def parts_for(df: DataFrame, mb: float, least: int | None = None) -> int:
    """Number of partitions that gives about ``mb`` megabytes of ``df``'s input files to each, by the optimizer's
    size estimate (no job runs); at least ``spark.sql.shuffle.partitions`` or ``least``."""
    floor = least or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    size = int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    if size >= 1 << 60:                                   # unknown (rows made on the driver)
        return floor
    return max(floor, -(-size // int(mb * MB)))


def ids_texts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Only the id (long) and the text (string) of a table, under fixed names, whatever else it holds."""
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))


def held_out(id_col: str | Column = "doc_id") -> Column:
    """crc32 of the id's decimal text, modulo 5, is 0 (false for a null id)."""
    c = F.col(id_col) if isinstance(id_col, str) else id_col
    return F.coalesce(F.crc32(c.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def cut(df: DataFrame) -> DataFrame:
    """Write ``df`` to the shared checkpoint folder and go on from the files, so that a lost executor costs no
    recomputation of what came before."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)
