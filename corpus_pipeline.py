"""From raw documents to batches for training, stage by stage.

Every stage is written as Parquet to the shared folder and read again by the next, so a lost executor or
a failed stage costs that stage alone. The folder of a stage is deleted once the next one is written; that of
the last written stage stays, for the batches are read from it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tidemark.llm._tables import table
from tidemark.llm.stages import STAGES
from tidemark.session import scratch_path

#: Toxicity and quality are learned, so no SQL gives these rows; tests compare them with a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The batches of all documents that the stages keep."""
    docs, before = table(spark, sf_dir, "documents"), None
    for name, stage in STAGES[:-1]:
        path = scratch_path(spark, f"pipeline_{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
        if before:
            _delete(spark, before)
        before = path
    return STAGES[-1][1](spark, docs, sf_dir)


def _delete(spark: SparkSession, path: str) -> None:
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)
