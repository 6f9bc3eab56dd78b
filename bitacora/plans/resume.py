"""Finished stages of a job that may be killed, kept until the job is done."""

from __future__ import annotations

import hashlib
import json

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from bitacora.sources.reports import literal_path
from bitacora.storage import stage_at


class KeptStages:
    """Tables of stages in a folder of their own for one input and one set of options.

    The folder is named by a digest of the input's files, with their sizes and times, and of
    the options, so changed files or options start anew.  A stage counts once its manifest
    is written, after its table.
    """

    def __init__(self, spark: SparkSession, folder: str, input_path: str | list[str], options: dict):
        for name, value in options.items():
            if isinstance(value, DataFrame):
                raise ValueError(f"a job can't be resumed with a table for {name}: it can't be compared")
        self.spark = spark
        files = (
            spark.read.format("binaryFile").load(literal_path(spark, input_path))
            .select(F.concat_ws("|", "path", "length", F.unix_micros("modificationTime")).alias("file"))
        )
        # One line a file, in order; only the digest leaves the executors.
        listed = files.groupBy(F.pmod(F.xxhash64("file"), F.lit(1024)).alias("k")).agg(
            F.sha2(F.array_join(F.array_sort(F.collect_list("file")), "\n"), 256).alias("d")
        )
        digest = listed.agg(F.sha2(F.array_join(F.array_sort(F.collect_list(F.concat_ws(":", "k", "d"))), "\n"), 256)).first()[0]
        key = hashlib.sha256(f"{digest}\n{json.dumps(options, sort_keys=True, default=str)}".encode()).hexdigest()
        self.path = f"{folder.rstrip('/')}/{key}"

    def stage(self, name: str, df: DataFrame, **measures: Column) -> tuple[DataFrame, dict]:
        """``df`` written under a name, and its measures."""
        return stage_at(df, f"{self.path}/{name}", "overwrite", **measures)

    def finish(self, name: str, df: DataFrame, figures: dict) -> None:
        """Says that a stage is complete, and what there is to know of it."""
        text = json.dumps({"schema": df.schema.jsonValue(), "figures": figures})
        stream = self._system().create(self._place(f"{name}.json"), True)
        try:
            stream.write(bytearray(text.encode()))
        finally:
            stream.close()

    def find(self, name: str) -> tuple[DataFrame, dict] | None:
        """A finished stage: its table and figures."""
        if not self._system().exists(self._place(f"{name}.json")):
            return None
        text = self.spark.read.text(f"{self.path}/{name}.json", wholetext=True).first()[0]
        known = json.loads(text)
        schema = T.StructType.fromJson(known["schema"])
        return self.spark.read.schema(schema).parquet(f"{self.path}/{name}"), known["figures"]

    def remove(self) -> None:
        self._system().delete(self.spark._jvm.org.apache.hadoop.fs.Path(self.path), True)

    def _place(self, name: str):
        return self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}")

    def _system(self):
        return self._place("x").getFileSystem(self.spark._jsc.hadoopConfiguration())
