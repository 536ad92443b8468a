"""Paths on whatever file system the cluster uses."""

import tempfile
import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession

CHECKPOINT_SETTING = "spark.checkpoint.dir"


def _path(spark: SparkSession, path: str):
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()), hadoop_path


def exists(spark: SparkSession, path: str) -> bool:
    fs, hadoop_path = _path(spark, path)
    return fs.exists(hadoop_path)


def children(spark: SparkSession, path: str) -> list[str]:
    """Names directly below ``path``; empty where it does not exist."""
    fs, hadoop_path = _path(spark, path)
    if not fs.exists(hadoop_path):
        return []
    return sorted(status.getPath().getName() for status in fs.listStatus(hadoop_path))


def numbered_children(spark: SparkSession, path: str, prefix: str) -> list[int]:
    """The n of all ``<prefix><n>`` directly below ``path``, ascending."""
    names = children(spark, path)
    tails = [name[len(prefix):] for name in names if name.startswith(prefix)]
    return sorted(int(tail) for tail in tails if tail.isdigit())


def read_text(spark: SparkSession, path: str) -> str:
    """Content of a small file."""
    fs, hadoop_path = _path(spark, path)
    stream = fs.open(hadoop_path)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def create_once(spark: SparkSession, path: str, content: str) -> bool:
    """Create a small file whole, or return False where there is one already.

    The content goes to a file beside it, which then gets the name: by a rename that
    does not replace, or on a local disk by a link, as a rename replaces there.
    """
    fs, target = _path(spark, path)
    jvm = spark._jvm
    waiting = jvm.org.apache.hadoop.fs.Path(f"{path.rsplit('/', 1)[0]}/.{uuid.uuid4().hex}")
    stream = fs.create(waiting, True)
    stream.write(content.encode())
    stream.close()
    try:
        if fs.getUri().getScheme() == "file":
            names = [jvm.java.io.File(p.toUri().getPath()).toPath() for p in (target, waiting)]
            jvm.java.nio.file.Files.createLink(*names)
        else:
            context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(fs.getUri(), spark._jsc.hadoopConfiguration())
            never_replace = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 0)
            context.rename(waiting, target, never_replace)
    except Py4JJavaError as error:
        if fs.exists(target) and "AlreadyExists" in error.java_exception.getClass().getName():
            return False
        raise
    finally:
        fs.delete(waiting, False)
    return True


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder this library wrote."""
    fs, hadoop_path = _path(spark, path)
    fs.delete(hadoop_path, True)


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor sees, named by ``spark.checkpoint.dir``.

    A local session without the setting gets a fresh temporary folder. On a
    cluster a machine-local folder would be wrong, so the setting is required.
    """
    folder = spark.conf.get(CHECKPOINT_SETTING, None)
    if folder:
        return folder.rstrip("/")
    master = spark.sparkContext.master
    if master == "local" or master.startswith("local["):  # local-cluster[...] has executors
        return tempfile.mkdtemp(prefix="ratemill-")
    raise ValueError(f"set {CHECKPOINT_SETTING} to a folder shared by the cluster")


def fresh_folder(spark: SparkSession, name: str) -> str:
    """A path below the shared folder that nobody has used."""
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


def ensure_checkpoints(spark: SparkSession) -> None:
    """Let iterative jobs cut their lineage, unless the session already does."""
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(shared_folder(spark))
