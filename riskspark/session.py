"""Session settings the library relies on, and the shared folder for cut lineage."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

ROCKSDB_PROVIDER = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # Call sites of Columns are not recorded, which makes building long plans faster.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
    "spark.sql.streaming.stateStore.providerClass": ROCKSDB_PROVIDER,
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}


def path_for_workers() -> None:
    """Lets Python workers that the driver's JVM starts import this package, wherever the program was started.

    The stateful streams have such workers, and files added to the context do not reach them. Works before the JVM starts.
    """
    home = str(Path(__file__).resolve().parent.parent)
    paths = os.environ.get("PYTHONPATH", "").split(os.pathsep)
    if home not in paths:
        os.environ["PYTHONPATH"] = os.pathsep.join([home, *filter(None, paths)])


def build_session(app_name: str = "riskspark", master: str | None = None, **extra: str) -> SparkSession:
    """A session with the library's settings; `extra` uses `__` for the dots of a key."""
    path_for_workers()
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    for key, value in extra.items():
        builder = builder.config(key.replace("__", "."), value)
    session = builder.getOrCreate()
    ship_package(session)
    return session


def ship_package(spark: SparkSession) -> None:
    """Makes this package importable in Python workers, which the stateful streams need."""
    package = Path(__file__).resolve().parent
    archive = Path(tempfile.mkdtemp(prefix="spark-")) / "riskspark.zip"
    with zipfile.ZipFile(archive, "w") as bundle:
        for source in sorted(package.rglob("*.py")):
            bundle.write(source, source.relative_to(package.parent))
    spark.sparkContext.addPyFile(str(archive))


def shared_folder(spark: SparkSession) -> str:
    """A folder that driver and executors share, below the cluster's `spark.checkpoint.dir`.

    Only where the session names none and runs in local mode is a temporary folder used.
    """
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        shared = spark.conf.get("spark.checkpoint.dir", None)
        if shared is None:
            if not context.master.startswith("local"):
                raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
            shared = tempfile.mkdtemp(prefix="spark-", dir=os.environ.get("TMPDIR", "/tmp"))
        context.setCheckpointDir(shared)
    return context.getCheckpointDir()


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint of `df` in the shared folder."""
    shared_folder(df.sparkSession)
    return df.checkpoint(eager=True)


def stored(df: DataFrame) -> DataFrame:
    """`df` written as Parquet to the shared folder and read back: lineage is cut, sizes are known, columns compressed.

    The table lives as long as the checkpoint folder does.
    """
    folder = f"{shared_folder(df.sparkSession)}/stored-{uuid.uuid4().hex}"
    df.write.parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder)
