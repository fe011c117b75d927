"""Session and table helpers shared by every operator."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def get_session(app: str = "cellgrid", master: str | None = None, **conf: str) -> SparkSession:
    """A UTC session with adaptive execution; cluster settings given outside are kept."""
    builder = SparkSession.builder.appName(app).config("spark.sql.session.timeZone", "UTC")
    if master:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    spark = builder.getOrCreate()
    shared_folder(spark)
    return spark


def shared_folder(spark: SparkSession) -> str:
    """The folder that driver and executors share, from spark.checkpoint.dir; checkpoints go there.

    Unset on one machine, it is a folder of the warehouse; unset on a cluster, it is an error, told before any work is
    done, as a folder of one machine would lose its share of the data with that machine."""
    at = spark.conf.get("spark.checkpoint.dir", None)
    if at:
        return at.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    own = f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_checkpoints"
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(own)
    return own


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One Parquet table of a data directory, by Spark's reader only."""
    if spark.sparkContext.master.startswith("local"):
        shared_folder(spark)  # a session made elsewhere may have no folder for checkpoints yet
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def nan_to_null(df: DataFrame) -> DataFrame:
    """NaN means "no data" in gridded sources; Spark orders and compares NaN as a value, so make it NULL once."""
    fixed = {
        f.name: F.when(~F.isnan(f.name), F.col(f.name))
        for f in df.schema.fields
        if isinstance(f.dataType, (T.DoubleType, T.FloatType))
    }
    return df.withColumns(fixed) if fixed else df


def require_columns(df: DataFrame, required: list[str], optional: list[str] = ()) -> list[str]:
    """Raise if a required column is absent; return the optional ones that are missing."""
    missing = [c for c in required if c not in df.columns]
    if missing:
        raise ValueError(f"missing required columns: {', '.join(missing)}")
    return [c for c in optional if c not in df.columns]
