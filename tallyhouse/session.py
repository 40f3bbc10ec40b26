"""Session defaults and the shared scratch folder."""

import tempfile
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession


def local_session(cores: str = "*", shuffle_partitions: int = 8, app: str = "tallyhouse") -> SparkSession:
    """A single-machine session for tests, the bench and the command line.

    On a cluster the job gets its session from spark-submit instead; nothing in
    the library sets session options.
    """
    return (
        SparkSession.builder.master(f"local[{cores}]").appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        # Else Spark lists hundreds of folders by as many tasks, which on one machine
        # takes longer than to list them.
        .config("spark.sql.sources.parallelPartitionDiscovery.parallelism", "16")
        .getOrCreate()
    )


def scratch_folder(spark: SparkSession, purpose: str) -> str:
    """A fresh folder path that all executors share.

    It lies in the folder the session names in spark.checkpoint.dir. Without
    that setting a temporary folder serves on one machine; a cluster must set it.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        shared = tempfile.mkdtemp(prefix="tallyhouse-")
    return f"{shared.rstrip('/')}/tallyhouse-{purpose}-{uuid.uuid4().hex}"


def _in_store(spark: SparkSession, folder: str):
    """Hadoop's file system and path of a folder, in whatever store it lies."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    return path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), path


def folder_exists(spark: SparkSession, folder: str) -> bool:
    store, path = _in_store(spark, folder)
    return store.exists(path)


def folders_in(spark: SparkSession, folder: str) -> list[tuple[str, int]]:
    """Partition folders right below a folder, each with the time it was last changed in
    milliseconds; none if the folder is not there."""
    store, path = _in_store(spark, folder)
    if not store.exists(path):
        return []
    found = [(status.getPath(), status) for status in store.listStatus(path) if status.isDirectory()]
    return [(f"{folder}/{path.getName()}", status.getModificationTime()) for path, status in found if "=" in path.getName()]


def remove_folder(spark: SparkSession, folder: str) -> None:
    """Delete a folder; one that is not there is no error."""
    store, path = _in_store(spark, folder)
    store.delete(path, True)


@contextmanager
def scratch_folders(spark: SparkSession) -> Iterator[Callable[[str], str]]:
    """scratch_folder for a job that is done with its scratch tables when it ends."""
    made = []

    def scratch(purpose: str) -> str:
        made.append(scratch_folder(spark, purpose))
        return made[-1]

    try:
        yield scratch
    finally:
        for folder in made:
            remove_folder(spark, folder)
