"""What the tasks of these operators need: the package, batches of few bytes, and memory given back."""

from __future__ import annotations

import ctypes
import gc
from collections.abc import Callable, Iterator

import pyarrow as pa
from py4j.protocol import Py4JError
from pyspark.sql import DataFrame, SparkSession

from featherline.workspace import ship_package, written

#: Most bytes of a batch that a task gets; rows hold whole texts, so rows are no measure.
BATCH_BYTES = 8 << 20


def prepare(spark: SparkSession) -> None:
    """Ship the package, and bound the bytes of a batch for this session."""
    ship_package(spark)
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))


def settle(spark: SparkSession) -> None:
    """Let the driver forget a finished stage.

    Spark drops the shuffles, broadcasts and plans of tables that nothing names any more when the driver's heap is
    collected, which a heap with room to grow may put off through many stages. Then freed memory of both processes goes back to the
    system, as in tasks; many short-lived threads otherwise keep theirs.
    """
    gc.collect()  # Python's names for them first
    spark._jvm.System.gc()
    give_back()
    _trim_java(spark)


def _trim_java(spark: SparkSession) -> None:
    """Return freed native memory of the driver's Java process, where its diagnostic commands can."""
    java, gateway = spark._jvm, spark.sparkContext._gateway
    try:
        invoke, = (m for m in java.java.lang.Class.forName("javax.management.MBeanServer").getMethods() if m.getName() == "invoke")
        arguments = gateway.new_array(java.Object, 4)
        arguments[0], arguments[1] = java.javax.management.ObjectName("com.sun.management:type=DiagnosticCommand"), "systemTrimNativeHeap"
        arguments[2], arguments[3] = gateway.new_array(java.Object, 1), gateway.new_array(java.String, 1)
        arguments[2][0], arguments[3][0] = gateway.new_array(java.String, 0), "[Ljava.lang.String;"
        invoke.invoke(java.java.lang.management.ManagementFactory.getPlatformMBeanServer(), arguments)
    except Py4JError:  # another Java
        pass


def staged(df: DataFrame, name: str) -> DataFrame:
    """A table written and read back, after which the driver forgets the jobs that made it."""
    table = written(df, name)
    settle(df.sparkSession)
    return table


def give_back() -> None:
    """Return freed memory to the system: workers live on, and what they keep is lost to others."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):  # another C library
        pass


def tidy(run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """A function for ``mapInArrow`` that gives memory back when a partition is done."""

    def tidied(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from run(batches)
        finally:
            give_back()

    return tidied
