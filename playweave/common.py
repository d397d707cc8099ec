"""Session, table and shared-storage helpers used by every module."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

_MADE: list[str] = []
#: Java regex class of everything that shows as a blank (Unicode separators, controls, the BOM and the zero-width space).
BLANKS = r"[\s\p{Z}\u0085\u200B\uFEFF]"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the parquet tables of a data folder."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """Folder that all executors reach: spark.checkpoint.dir, or, in local mode only, a temporary folder of this process."""
    sc = spark.sparkContext
    own = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir")
    if own:
        return own.rstrip("/")
    held = sc._jsc.sc().getCheckpointDir()
    if held.isDefined():
        return held.get().rsplit("/", 1)[0]
    if not sc.master.startswith("local"):
        raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
    path = "file://" + tempfile.mkdtemp(prefix="playweave-")
    atexit.register(shutil.rmtree, path[7:], True)
    sc.setCheckpointDir(path)
    return path


def materialize(df: DataFrame, label: str) -> DataFrame:
    """Cut lineage: write df as a table in the shared folder and read it back (survives the loss of any executor)."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/playweave/{label}-{uuid.uuid4().hex}"
    _MADE.append(path)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def release(spark: SparkSession) -> int:
    """Delete the tables that this process has materialized so far, once nothing that reads them is needed any more; their number."""
    n = len(_MADE)
    while _MADE:
        p = spark._jvm.org.apache.hadoop.fs.Path(_MADE.pop())
        p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)
    return n


def is_blank(c: Column) -> Column:
    """True for null, empty and all-blank strings."""
    return F.coalesce(F.regexp_replace(c, BLANKS, "") == "", F.lit(True))


def letters_digits(c: Column) -> Column:
    """Lower-cased letters and digits of a string, in order; everything else is dropped."""
    return F.regexp_replace(F.lower(c), r"[^\p{L}\p{N}]", "")


def small_rows(df: DataFrame, most: int) -> list:
    """Collect a table that must have at most `most` rows; more is an error, never a silent cut."""
    rows = df.limit(most + 1).collect()
    if len(rows) > most:
        raise ValueError(f"expected a reference table of at most {most} rows")
    return rows


def path_exists(spark: SparkSession, path: str) -> bool:
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop.getFileSystem(spark._jsc.hadoopConfiguration()).exists(hadoop)
