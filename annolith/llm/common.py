"""Helpers shared by the training-data operators."""

from __future__ import annotations

import gc
import tempfile
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Words are runs of anything but ASCII white space; ``bytes.split()`` splits at exactly these bytes.
WORD_GAP = "[\\x20\\x09-\\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def scratch(spark: SparkSession, what: str) -> str:
    """A new folder below spark.checkpoint.dir, which the driver and all executors share.

    Only where the setting is absent and all runs on one machine (tests, a laptop) a temporary folder is set.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.conf.get("spark.master", "").startswith("local"):
            raise ValueError("spark.checkpoint.dir is not set: the driver and the executors need a folder that they share")
        base = f"file://{tempfile.mkdtemp(prefix='annolith-')}"
        spark.conf.set("spark.checkpoint.dir", base)
    return f"{base.rstrip('/')}/annolith/{what}-{uuid.uuid4().hex}"


def stored(df: DataFrame, what: str) -> DataFrame:
    """Writes df to the shared folder and reads it back.

    This cuts the lineage: later stages re-read the files and survive the loss of any executor.
    """
    spark = df.sparkSession
    path = scratch(spark, what)
    df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out.stored_at = path
    return out


def delete(spark: SparkSession, *paths: str) -> None:
    """Deletes folders of the shared file system."""
    for x in paths:
        path = spark._jvm.org.apache.hadoop.fs.Path(x)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def discard(*tables: DataFrame) -> None:
    """Deletes stored tables on which no stored result and no plan depends any more."""
    for df in tables:
        delete(df.sparkSession, df.stored_at)


def release(spark: SparkSession) -> None:
    """Lets Spark delete the shuffle files of finished steps, which it does once the driver's garbage is collected."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


#: Rows that a worker takes of a batch at once, so that what it makes of them stays small.
ROWS = 1024


def map_batches(df: DataFrame, schema: str, rows: Callable[[pa.RecordBatch], pa.RecordBatch], at_once: int = ROWS) -> DataFrame:
    """One Arrow batch out for each slice of a batch in; keeps no state from one to the next."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(0, batch.num_rows, at_once):
                yield rows(batch.slice(k, at_once))

    return df.mapInArrow(run, schema)


def lower_ascii(text):
    """Lower-cases A-Z and nothing else."""
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
