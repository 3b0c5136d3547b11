"""Session settings and the shared folder for tables a job writes on its way."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

CHECKPOINT_KEY = "spark.checkpoint.dir"

# Adaptive execution sizes the reduce side and splits skewed join partitions at
# run time; a side is broadcast only when its measured size is under the threshold.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # The checklists of an event's days filter all sightings before their shuffle.
    "spark.sql.optimizer.runtime.bloomFilter.enabled": "true",
    "spark.sql.optimizer.runtime.bloomFilter.creationSideThreshold": "10g",
    "spark.sql.optimizer.runtime.bloomFilter.maxNumBits": str(1 << 30),
    "spark.sql.optimizer.runtime.bloomFilter.maxNumItems": str(100_000_000),
}


# Two or three narrow columns of a fact are shuffled, about a tenth of its bytes.
SHUFFLED_SHARE = 10
SHUFFLE_TARGET = 1 << 30
MERGED_TARGET = 128 << 20
DEFAULT_PARTITIONS = 200


def settings_for(input_bytes: int) -> dict[str, str]:
    """Shuffle settings for facts of this size.

    Adaptive execution merges small partitions but never adds any to an even
    shuffle, so the number it starts from has to suit the largest one: a partition
    for each GB that is shuffled, some ten thousand for 100 TB. More would cost the
    driver more in map statuses than smaller partitions gain.
    """
    partitions = max(DEFAULT_PARTITIONS, -(-input_bytes // (SHUFFLED_SHARE * SHUFFLE_TARGET)))
    return {
        "spark.sql.adaptive.coalescePartitions.initialPartitionNum": str(partitions),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(MERGED_TARGET),
        "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false",
    }


def build_session(master: str | None = None, app_name: str = "fieldtally",
                  **extra: str) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **extra}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession, label: str) -> str:
    """A new folder name below the cluster's shared checkpoint folder.

    Only a local master may fall back to a temporary folder of this machine.
    """
    root = spark.conf.get(CHECKPOINT_KEY, None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError(f"set {CHECKPOINT_KEY} to a folder that every executor can reach")
        root = tempfile.mkdtemp(prefix="fieldtally-")
    return f"{root.rstrip('/')}/fieldtally-{label}-{uuid.uuid4().hex}"


def _file_system(spark: SparkSession, path: str):
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()), place


def folder_exists(spark: SparkSession, path: str) -> bool:
    files, place = _file_system(spark, path)
    return files.exists(place)


def remove_folder(spark: SparkSession, path: str) -> None:
    """Removes a folder that a job of ours wrote, wherever Spark keeps it."""
    files, place = _file_system(spark, path)
    files.delete(place, True)
