"""Files to tables as streams: each file once, restartable."""

from __future__ import annotations

import json
import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def stream_checkpoint(base: str, user: str, stream: str) -> str:
    """Checkpoint folder of one user's stream, so runs of others cannot disturb it."""
    return f"{base}/{re.sub(r'[^a-zA-Z0-9]', '_', user)}/{stream}"


def _is_there(spark: SparkSession, path: str) -> bool:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p)


def stream_schema(spark: SparkSession, fmt: str, path: str, options: dict, checkpoint: str) -> StructType:
    """Schema inferred once by a batch read and kept beside the checkpoint."""
    kept = f"{checkpoint}_schema"
    if _is_there(spark, kept):
        return StructType.fromJson(json.loads(spark.read.text(kept).first()[0]))
    batch = dict(options)
    if fmt == "csv":
        batch["inferSchema"] = "true"
    schema = spark.read.format(fmt).options(**batch).load(path).schema
    spark.createDataFrame([(schema.json(),)], "value string").coalesce(1).write.text(kept)
    return schema


def stream_files(
    spark: SparkSession, fmt: str, path: str, checkpoint: str, target: str,
    schema: StructType | str | None = None, options: dict | None = None, glob: str | None = None,
) -> DataFrame:
    """Append all files not yet seen to ``target`` and stop.

    The checkpoint records which files were taken; a second run without new
    files adds nothing, and a run cut short resumes without repeating rows.
    """
    opts = dict(options or {})
    if fmt == "csv":
        opts.setdefault("header", "true")
    if glob:
        opts["pathGlobFilter"] = glob
    found = schema if schema is not None else stream_schema(spark, fmt, path, opts, checkpoint)
    rows = (spark.readStream.format(fmt).schema(found).options(**opts).load(path)
            .select("*", F.col("_metadata.file_name").alias("source_file")))
    query = (rows.writeStream.format("parquet").option("checkpointLocation", checkpoint)
             .trigger(availableNow=True).start(target))
    query.awaitTermination()
    return spark.read.parquet(target)
