"""Small helpers that several operators share."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: ASCII white space as the word patterns of the contracts see it.
BLANKS = " \t\n\x0b\f\r"
BLANK_CLASS = r"\x20\x09-\x0D"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def words_of(text: Column) -> Column:
    """Words ``[^\\x20\\x09-\\x0D]+`` of a text that is not null, as an array."""
    bare = F.btrim(text, F.lit(BLANKS))
    return F.when(bare == "", F.array().cast("array<string>")).otherwise(F.split(bare, f"[{BLANK_CLASS}]+"))


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: ``spark.checkpoint.dir``. Where it is unset a local session gets a
    temporary one; a cluster's executors would each write to their own disk, so there this raises."""
    here = spark.sparkContext.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if not here:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        import tempfile

        here = "file://" + tempfile.mkdtemp(prefix="spark-cuvee-")
        spark.sparkContext.setCheckpointDir(here)
    return here.rstrip("/")


def scratch(spark: SparkSession, what: str) -> str:
    """A new path below the shared folder."""
    return f"{shared_dir(spark)}/{what}-{uuid.uuid4().hex}"


def written(df: DataFrame, what: str) -> DataFrame:
    """``df`` as a Parquet table in the shared folder, read again: lineage ends here and survives lost executors."""
    spark = df.sparkSession
    path = scratch(spark, what)
    df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._scratch = path
    return out


def discard(*tables: DataFrame) -> None:
    """Deletes what ``written`` wrote for these tables; nothing that is still to run may read them."""
    for t in tables:
        context = t.sparkSession.sparkContext
        path = context._jvm.org.apache.hadoop.fs.Path(t._scratch)
        path.getFileSystem(context._jsc.hadoopConfiguration()).delete(path, True)
