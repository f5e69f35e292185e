"""Is a failed job the fault of what it read, or of the machines it ran on?

The answer comes from classes and error conditions along the chain of causes, never from message texts: these hold
paths, column names and values of the data.

* An error that is known to speak of an input (``BadFile``, a Spark error condition, a file that is gone or closed to us)
  is the file's.
* A failed task without any condition is not: Spark attaches the condition of what a task threw, so what is left are lost executors,
  crashed workers, disks that are full. A failed write alone (``TASK_WRITE_FAILED``) says nothing of the input either.
* Errors of the virtual machine, interrupts, cancelled jobs and a stopped session never are.
"""

from __future__ import annotations

from collections.abc import Iterator

from py4j.protocol import Py4JError, Py4JJavaError, Py4JNetworkError
from pyspark.errors import PySparkException
from pyspark.sql import SparkSession

# Names of classes and error conditions.
NEVER_THE_FILE = (
    "java.lang.VirtualMachineError",
    "java.lang.InterruptedException",
    "java.nio.channels.ClosedByInterruptException",
    "org.apache.spark.TaskKilledException",
    "org.apache.spark.shuffle.FetchFailedException",
    "org.apache.hadoop.fs.FSError",
    "org.apache.hadoop.util.DiskChecker$DiskErrorException",
    "org.apache.hadoop.hdfs.protocol.QuotaExceededException",
)
ALWAYS_THE_FILE = ("java.io.FileNotFoundException", "org.apache.hadoop.security.AccessControlException")
NOT_OF_INPUTS = ("SPARK_JOB_CANCELLED", "TASK_WRITE_FAILED", "UNABLE_TO_ACQUIRE_MEMORY", "INTERNAL_ERROR")


class BadFile(ValueError):
    """A file that cannot be loaded as it is."""


def blames_file(spark: SparkSession, error: Exception) -> bool:
    if isinstance(error, BadFile):
        return True
    if isinstance(error, Py4JNetworkError) or _stopped(spark):
        return False
    if isinstance(error, Py4JError) or isinstance(error, PySparkException):
        return _chain_blames_file(spark, list(_causes(error)))
    return True  # our own code met something that it did not expect of a file


def _stopped(spark: SparkSession) -> bool:
    context = spark.sparkContext
    try:
        return context._jsc is None or context._jsc.sc().isStopped()
    except (Py4JError, OSError):
        return True


def _causes(error: Exception) -> Iterator:
    """The Java throwables behind an error, from the outermost."""
    cause = error.java_exception if isinstance(error, Py4JJavaError) else getattr(error, "_origin", None)
    for _ in range(100):  # a chain may be a ring
        if cause is None:
            return
        yield cause
        cause = cause.getCause()


def _chain_blames_file(spark: SparkSession, causes: list) -> bool:
    def is_one(cause, names: tuple[str, ...]) -> bool:
        return any(_class(spark, name).isInstance(cause) for name in names)

    if any(is_one(cause, NEVER_THE_FILE) for cause in causes):
        return False
    if any(is_one(cause, ALWAYS_THE_FILE) for cause in causes):
        return True
    spoken = [c.getCondition() for c in causes if is_one(c, ("org.apache.spark.SparkThrowable",))]
    conditions = [c for c in spoken if c]
    if not causes:  # an error of a Python worker's own code, which Spark hands on without its Java side
        return True
    if any(c.split(".")[0] in NOT_OF_INPUTS[:1] for c in conditions):
        return False
    return any(c.split(".")[0] not in NOT_OF_INPUTS for c in conditions)


def _class(spark: SparkSession, name: str):
    loader = spark._jvm.java.lang.Thread.currentThread().getContextClassLoader()
    try:
        return spark._jvm.java.lang.Class.forName(name, False, loader)
    except Py4JJavaError:  # a class that this installation does not have is no error's
        return _Missing


class _Missing:
    @staticmethod
    def isInstance(_) -> bool:  # noqa: N802  the name of the Java method
        return False
