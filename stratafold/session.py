"""Session defaults and the shared scratch folder."""

from __future__ import annotations

import re
import tempfile
import uuid
from functools import lru_cache

from pyspark.sql import SparkSession


def build_session(app: str, master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings the jobs rely on; ``conf`` overrides them."""
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.ui.enabled": "false",
        # the JVM interprets methods beyond 8000 bytes; Spark splits them instead
        "spark.sql.codegen.hugeMethodLimit": "8000",
    }
    settings.update(conf)
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def scratch_root(spark: SparkSession) -> str:
    """The folder for staged tables and stream checkpoints.

    A cluster names it in ``spark.checkpoint.dir``. A local run without that
    setting gets a folder of its own; any other master, local clusters included,
    must name one, since a machine's own disk is not shared between executors.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        master = spark.sparkContext.master
        if not re.match(r"local(\[|$)", master):
            raise ValueError(f"spark.checkpoint.dir must name a shared folder on {master}")
        root = _local_folder(spark.sparkContext.applicationId)
    return root.rstrip("/")


@lru_cache(maxsize=None)
def _local_folder(application: str) -> str:
    return tempfile.mkdtemp(prefix="stratafold-")


def scratch_path(spark: SparkSession, label: str) -> str:
    """A path under the scratch folder that no other run uses."""
    return f"{scratch_root(spark)}/{label}-{uuid.uuid4().hex}"


def _file_system(spark: SparkSession, path: str):
    jpath = spark._jvm.org.apache.hadoop.fs.Path(path)
    return jpath.getFileSystem(spark._jsc.hadoopConfiguration()), jpath


# In how many tasks Spark lists named paths: 10,000 unless set, so a task for each of so many files.
LISTING_TASKS = "spark.sql.sources.parallelPartitionDiscovery.parallelism"


def share_listing(spark: SparkSession) -> None:
    """From now on a few tasks a core share the listing of named files; a stream takes the setting along."""
    few = max(32, 4 * spark.sparkContext.defaultParallelism)
    if int(spark.conf.get(LISTING_TASKS)) > few:
        spark.conf.set(LISTING_TASKS, str(few))


def path_exists(spark: SparkSession, path: str) -> bool:
    fs, jpath = _file_system(spark, path)
    return fs.exists(jpath)


def glob_matches(spark: SparkSession, glob: str) -> bool:
    fs, jpath = _file_system(spark, glob)
    return bool(fs.globStatus(jpath))


def make_dirs(spark: SparkSession, path: str) -> None:
    fs, jpath = _file_system(spark, path)
    fs.mkdirs(jpath)


def list_names(spark: SparkSession, path: str) -> list[str]:
    """Names of what lies in a folder; none if there is no such folder."""
    fs, jpath = _file_system(spark, path)
    return sorted(status.getPath().getName() for status in fs.listStatus(jpath)) if fs.exists(jpath) else []


def read_text(spark: SparkSession, path: str) -> str:
    fs, jpath = _file_system(spark, path)
    stream = fs.open(jpath)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


# Stores that create an object only if there is none, whole when it is closed. A
# rename there copies, and replaces what it finds.
PUT_IF_ABSENT = ("s3a", "gs", "abfs", "abfss")
# Without this option, or with a connector that does not know it, s3a looks first and then writes.
S3A_CONDITIONAL = "fs.option.create.conditional.overwrite"


def write_new_text(spark: SparkSession, path: str, text: str) -> None:
    """Put a file in place whole, or fail if there is one already.

    Of any number of writers one succeeds: on object stores by a conditional create,
    on a local disk by a hard link to the finished draft, elsewhere (HDFS) by a
    rename that does not replace.
    """
    fs, jpath = _file_system(spark, path)
    scheme = fs.getUri().getScheme()
    data = bytearray(text.encode("utf-8"))
    if scheme in PUT_IF_ABSENT:
        _create_absent(fs, jpath, data, scheme)
        return
    folder, name = path.rsplit("/", 1)
    draft = spark._jvm.org.apache.hadoop.fs.Path(f"{folder}/_{name}.{uuid.uuid4().hex}")
    _write(fs.create(draft), data)
    try:
        if scheme == "file":
            on_disk = lambda p: spark._jvm.java.io.File(fs.makeQualified(p).toUri().getPath()).toPath()
            spark._jvm.java.nio.file.Files.createLink(on_disk(jpath), on_disk(draft))
        else:
            context = spark._jvm.org.apache.hadoop.fs.FileContext.getFileContext(fs.getUri(), spark._jsc.hadoopConfiguration())
            options = spark.sparkContext._gateway.new_array(spark._jvm.org.apache.hadoop.fs.Options.Rename, 0)
            context.rename(fs.makeQualified(draft), fs.makeQualified(jpath), options)
    finally:
        fs.delete(draft, False)


def _create_absent(fs, jpath, data: bytearray, scheme: str) -> None:
    builder = fs.createFile(jpath).overwrite(False)
    if scheme == "s3a":
        builder = builder.must(S3A_CONDITIONAL, True)
    _write(builder.build(), data)


def _write(stream, data: bytearray) -> None:
    """All of the data; a stream that fails is closed, which gives up what it holds."""
    try:
        stream.write(data)
    finally:
        stream.close()


def delete_path(spark: SparkSession, path: str) -> None:
    fs, jpath = _file_system(spark, path)
    fs.delete(jpath, True)
