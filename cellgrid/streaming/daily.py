"""Daily sums of an hourly stream: event time, a watermark for late rows, sums that a restart picks up again."""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from cellgrid.session import shared_folder


def daily_sums(rows: DataFrame, key: str, ts: str, value: str, late: str = "2 days") -> DataFrame:
    """var, day, n, total for a stream or a table: tumbling days, rows later than the watermark are left out."""
    timed = rows.select(F.col(key).alias("var"), F.col(ts).cast("timestamp").alias("_ts"), F.col(value).alias("value"))
    if rows.isStreaming:
        timed = timed.withWatermark("_ts", late)
    out = timed.groupBy("var", F.window("_ts", "1 day")).agg(F.count("value").alias("n"), F.sum("value").alias("total"))
    return out.select("var", F.to_date("window.start").alias("day"), "n", "total")


def _stream(spark: SparkSession, path: str) -> DataFrame:
    """All Parquet files under a path (a folder, or one file) as a stream."""
    schema = spark.read.parquet(path).schema
    folder, _, name = path.rpartition("/")
    return spark.readStream.schema(schema).option("pathGlobFilter", "*.parquet").parquet(f"{folder}/{name}*" if path.endswith(".parquet") else path)


def daily_stream(spark: SparkSession, path: str, key: str, ts: str, value: str, late: str = "2 days") -> DataFrame:
    """The same over all files under a path as a stream that ends when it has read them; read back from its sink.

    Update mode: a batch hands over the days it has changed, so that state goes once the watermark has passed a day. Each
    batch is a folder of its own, written over if the batch is run again; of a day's rows the latest batch's counts."""
    out = f"{shared_folder(spark)}/stream-{uuid.uuid4().hex}"

    def keep(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{out}/sums/batch={number}")

    run = daily_sums(_stream(spark, path), key, ts, value, late).writeStream.outputMode("update").foreachBatch(keep)
    run.option("checkpointLocation", f"{out}/state").trigger(availableNow=True).start().awaitTermination()
    rows = spark.read.parquet(f"{out}/sums")
    last = rows.groupBy("var", "day").agg(F.max_by(F.struct("n", "total"), "batch").alias("_m"))
    return last.select("var", "day", "_m.n", "_m.total")


def trailing_stream(spark: SparkSession, path: str, key: str, ts: str, value: str, rows: int = 8, least: int = 6) -> DataFrame:
    """key, ts and the mean of the last so many rows of a stream that is in order by key, null before there are as many or
    with fewer than least values: rows and not hours, so gaps in time do not matter. State is the last rows of each key."""
    out = f"{shared_folder(spark)}/stream-{uuid.uuid4().hex}"

    def run(name: tuple, parts: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        held = list(state.get[0]) if state.exists else []
        pdf = pd.concat(list(parts)).sort_values("ts")
        means = []
        for v in pdf["value"]:
            held = [*held, v][-rows:]
            good = [x for x in held if x == x and x is not None]
            means.append(sum(good) / len(good) if len(held) == rows and len(good) >= least else None)
        state.update((held,))
        yield pd.DataFrame({"var": name[0], "ts": pdf["ts"], "trailing": pd.array(means, dtype="Float64")})

    timed = _stream(spark, path).select(F.col(key).cast("string").alias("var"), F.col(ts).cast("timestamp").alias("ts"), F.col(value).cast("double").alias("value"))
    made = timed.groupBy("var").applyInPandasWithState(run, "var string, ts timestamp, trailing double", "held array<double>", "append", GroupStateTimeout.NoTimeout)
    sink = made.writeStream.outputMode("append").format("parquet").option("path", f"{out}/rows").option("checkpointLocation", f"{out}/state")
    sink.trigger(availableNow=True).start().awaitTermination()
    return spark.read.schema("var string, ts timestamp, trailing double").parquet(f"{out}/rows")


def refresh(current: DataFrame, target: str, period: str) -> None:
    """Overwrites only the periods that current holds: complete ones stay as they are."""
    current.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(period).parquet(target)
