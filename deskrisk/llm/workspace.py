"""Intermediate tables of one run on the shared folder, and shuffle files that end with their job."""

from __future__ import annotations

import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

from deskrisk.operators.scratch import released_shuffles, scratch_dir

_SHIPPED: set[str] = set()


class Workspace:
    """Tables of one run in the folder all executors share: ``spark.checkpoint.dir``, or the warehouse.

    A stored table cuts lineage: an executor lost later does not reach back past it.
    """

    def __init__(self, spark: SparkSession, name: str) -> None:
        self.spark = spark
        self.folder = f"{scratch_dir(spark)}/{name}-{uuid.uuid4().hex}"

    def path(self, table: str) -> str:
        return f"{self.folder}/{table}"

    def store(self, df: DataFrame, table: str) -> DataFrame:
        """Write ``df`` and return it as read back; the shuffle files of the write are removed."""
        with released_shuffles(self.spark):
            df.write.parquet(self.path(table))
        return self.spark.read.schema(df.schema).parquet(self.path(table))

    def drop(self, *tables: str) -> None:
        """Delete tables that nothing reads any more; without names, everything."""
        for path in [self.path(t) for t in tables] or [self.folder]:
            location = self.spark._jvm.org.apache.hadoop.fs.Path(path)
            configuration = self.spark._jsparkSession.sessionState().newHadoopConf()
            location.getFileSystem(configuration).delete(location, True)


def map_batches(df: DataFrame, function, schema: str, barrier: bool = False) -> DataFrame:
    """``mapInArrow`` with this package sent to the executors first."""
    ship(df.sparkSession)
    return df.mapInArrow(function, schema, barrier)


def ship(spark: SparkSession) -> None:
    """Send the package's modules to the Python workers, once for each application."""
    context = spark.sparkContext
    if context.applicationId in _SHIPPED:
        return
    import deskrisk

    root = Path(deskrisk.__file__).parent
    archive = Path(tempfile.mkdtemp(prefix="deskrisk-")) / "deskrisk_llm.zip"  # the driver's own copy to send
    with zipfile.ZipFile(archive, "w") as packed:
        for module in sorted(root.rglob("*.py")):
            packed.write(module, module.relative_to(root.parent))
    context.addPyFile(str(archive))
    _SHIPPED.add(context.applicationId)
