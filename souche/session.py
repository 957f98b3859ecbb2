"""Session defaults, table access and lineage cuts."""

from __future__ import annotations

import atexit
import os
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, Observation, SparkSession

DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
}


#: application -> folder, only where the session names none
_OWN: dict[str, str] = {}
_SHIPPED: set[str] = set()
_KEPT: set[str] = set()


def local_session(cores: int | str = "*", partitions: int = 8, **conf: str) -> SparkSession:
    """A local session for tests and benches; on a cluster use the session that is there."""
    builder = SparkSession.builder.master(f"local[{cores}]").appName("souche")
    settings = DEFAULTS | {
        "spark.sql.shuffle.partitions": str(partitions),
        "spark.driver.memory": "12g",
    }
    for key, value in (settings | conf).items():
        builder = builder.config(key, value)
    session = builder.getOrCreate()
    session.sparkContext.setLogLevel("ERROR")
    return session


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share: ``spark.checkpoint.dir``; our own only where it is unset and everything runs on one machine."""
    folder = spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not folder:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        app = spark.sparkContext.applicationId
        if app not in _OWN:
            _OWN[app] = f"file://{tempfile.mkdtemp(prefix='souche-')}"
            atexit.register(shutil.rmtree, _OWN[app][len("file://") :], True)
        folder = _OWN[app]
    return folder.rstrip("/")


def own_dir(spark: SparkSession) -> str:
    """This application's folder in the shared one, deleted when its driver ends."""
    context = spark.sparkContext
    folder = f"{shared_dir(spark)}/souche/{context.applicationId}"
    if folder not in _KEPT:
        _KEPT.add(folder)
        atexit.register(_remove, context._jvm, context._jsc.hadoopConfiguration(), folder)
    return folder


def _remove(jvm, conf, folder: str) -> None:
    try:
        path = jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(conf).delete(path, True)
    except Exception:  # the JVM may have gone first: then the folder stays for whoever keeps the shared one
        pass


def cut(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` as a table in the shared folder and read it back.

    The result has no lineage behind it and survives the loss of any executor. The table lasts as long as the
    application, unless ``drop_cut`` deletes it before: results may still read it.
    """
    spark = df.sparkSession
    path = f"{own_dir(spark)}/{label}-{uuid.uuid4().hex}"
    df.write.mode("overwrite").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def ship(spark: SparkSession) -> None:
    """Send this package to the executors, once per application: their Python may not find it by itself."""
    context = spark.sparkContext
    if context.applicationId not in _SHIPPED:
        _SHIPPED.add(context.applicationId)
        root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
        folder = tempfile.mkdtemp(prefix="souche-code-")
        atexit.register(shutil.rmtree, folder, True)
        context.addPyFile(shutil.make_archive(f"{folder}/souche-code", "zip", root, os.path.basename(os.path.dirname(os.path.abspath(__file__)))))


def cut_marked(df: DataFrame, label: str, *marks) -> tuple[DataFrame, tuple]:
    """As ``cut``, with aggregates of the rows taken while they are written: no pass of their own."""
    seen = Observation()
    done = cut(df.observe(seen, *(m.alias(f"m{i}") for i, m in enumerate(marks))), label)
    got = seen.get
    return done, tuple(got[f"m{i}"] for i in range(len(marks)))


def drop_cut(df: DataFrame) -> None:
    """Delete the files of a table written by ``cut`` that nothing needs any more."""
    spark = df.sparkSession
    jvm = spark.sparkContext._jvm
    for folder in {f.rpartition("/")[0] for f in df.inputFiles()}:
        if "/souche/" in folder:
            path = jvm.org.apache.hadoop.fs.Path(folder)
            path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)
