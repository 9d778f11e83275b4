"""Spark session helpers.

Cluster jobs get their session (and ``spark.checkpoint.dir``) from the
platform and keep its settings; ``get_spark`` makes a session with local
defaults only where there is none, which is what tests and the bench need.
"""

from __future__ import annotations

import gc
import os
import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

_LOCAL_DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.ansi.enabled": "false",
}


def get_spark(master: str | None = None, shuffle_partitions: int | None = None, app: str = "medistar") -> SparkSession:
    """The running session as the platform configured it (only the SQL settings the
    library relies on are applied), under spark-submit a session with the submitted
    settings, otherwise a new local one with local defaults.  ``master`` and
    ``shuffle_partitions`` apply where given to a new session."""
    active = SparkSession.getActiveSession()
    if active is not None:
        ensure_checkpoint_dir(active)
        return configure(active)
    b = SparkSession.builder.appName(app)
    conf = {}
    if "PYSPARK_GATEWAY_PORT" not in os.environ:  # not started by spark-submit
        conf = {"spark.master": os.environ.get("MEDISTAR_MASTER", "local[8]"), "spark.sql.shuffle.partitions": "8",
                "spark.driver.memory": os.environ.get("MEDISTAR_DRIVER_MEM", "16g"), **_LOCAL_DEFAULTS}
    if master:
        conf["spark.master"] = master
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    for k, v in conf.items():
        b = b.config(k, v)
    spark = configure(b.getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def configure(spark: SparkSession) -> SparkSession:
    """Apply the SQL settings the library relies on to an existing session."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    spark.conf.set("spark.sql.ansi.enabled", "false")
    # the JVM does not compile methods above 8000 bytes: stages whose generated code is larger run without
    # whole-stage code, whose parts are small
    spark.conf.set("spark.sql.codegen.hugeMethodLimit", "8000")
    # a shuffled side whose partitions turn out small is hashed, so that the wide rows it meets are not sorted (and spilled)
    spark.conf.set("spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold", "64MB")
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder.

    On a cluster it is ``spark.checkpoint.dir`` from the session config and is
    never replaced.  Only when it is unset on a local master (tests) a scratch
    folder is made; on any other master that is an error.
    """
    d = spark.conf.get("spark.checkpoint.dir", None)
    if not d:
        d = spark.sparkContext.getCheckpointDir()
    if not d and not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("spark.checkpoint.dir is not set: it must name a folder that all executors share")
    if not d:
        d = tempfile.mkdtemp(prefix="medistar-ckpt-", dir=os.environ.get("MEDISTAR_SCRATCH", "/tmp"))
        spark.conf.set("spark.checkpoint.dir", d)
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(d)
    return d


def shared_path(spark: SparkSession, *parts: str) -> str:
    """A path under the shared checkpoint folder (for written intermediate tables)."""
    base = ensure_checkpoint_dir(spark)
    return "/".join([base.rstrip("/"), *parts])


def importable(spark: SparkSession) -> None:
    """Let Python workers import this package from where the driver has it, also if
    it is not installed and the driver was started in another folder."""
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    env = spark.sparkContext.environment
    if root not in env.get("PYTHONPATH", "").split(os.pathsep):
        env["PYTHONPATH"] = os.pathsep.join(x for x in (env.get("PYTHONPATH"), root) if x)


# input files (bytes) that one slice of a large table stands for: what is shuffled at once is bounded by it
SLICE_BYTES = 1 << 30


def slices_of(df: DataFrame) -> int:
    """In how many slices the rows of ``df`` are worked on, by the size of the files that it reads."""
    jvm, conf = df.sparkSession._jvm, df.sparkSession._jsc.hadoopConfiguration()
    size = 0
    for f in df.inputFiles():
        p = jvm.org.apache.hadoop.fs.Path(jvm.java.net.URI(f))
        size += p.getFileSystem(conf).getFileStatus(p).getLen()
    return max(1, -(-size // SLICE_BYTES))


def in_slice(i: int, n: int, *cols: Column) -> Column:
    """Whether a row is in slice ``i`` of ``n``: rows with equal ``cols`` are in the same one."""
    return F.pmod(F.xxhash64(*cols), F.lit(n)) == i


def release_shuffles(spark: SparkSession) -> None:
    """Let Spark delete the shuffle files of finished plans: it does so when their objects are collected,
    which a roomy driver heap puts off while the disks fill up."""
    gc.collect()
    spark._jvm.System.gc()


# ------------------------------------------------ small file-system helpers
# (Hadoop FileSystem API, so they work on HDFS / object stores as well as local disk)

def _fs(spark: SparkSession, path: str):
    jvm = spark._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark._jsc.hadoopConfiguration())


def fs_exists(spark: SparkSession, path: str) -> bool:
    p, fs = _fs(spark, path)
    return bool(fs.exists(p))


def fs_write_text(spark: SparkSession, path: str, text: str) -> None:
    p, fs = _fs(spark, path)
    out = fs.create(p, True)
    try:
        out.write(bytearray(text.encode("utf-8")))
    finally:
        out.close()


def fs_read_text(spark: SparkSession, path: str) -> str:
    p, fs = _fs(spark, path)
    stream = fs.open(p)
    try:
        reader = spark._jvm.java.io.BufferedReader(spark._jvm.java.io.InputStreamReader(stream, "UTF-8"))
        lines = []
        line = reader.readLine()
        while line is not None:
            lines.append(line)
            line = reader.readLine()
        return "\n".join(lines)
    finally:
        stream.close()


def fs_create_text(spark: SparkSession, path: str, text: str) -> bool:
    """Write a small file whole or not at all; False if the path is taken already."""
    p, fs = _fs(spark, path)
    part, _ = _fs(spark, f"{path.rsplit('/', 1)[0]}/.{uuid.uuid4().hex}")
    fs_write_text(spark, part.toString(), text)
    if not fs.exists(p) and fs.rename(part, p):
        return True
    fs.delete(part, False)
    return False


def fs_names(spark: SparkSession, path: str) -> list[str]:
    """Sorted names in a folder, none if it does not exist."""
    p, fs = _fs(spark, path)
    return sorted(st.getPath().getName() for st in fs.listStatus(p)) if fs.exists(p) else []


def fs_drop(spark: SparkSession, path: str) -> None:
    """Delete a folder of intermediate rows that this library wrote."""
    p, fs = _fs(spark, path)
    fs.delete(p, True)


def fs_fingerprint(spark: SparkSession, paths: list[str]) -> str:
    """Sizes and modification times of files / folders (recursive), as a string."""
    parts = []
    for path in paths:
        p, fs = _fs(spark, path)
        if not fs.exists(p):
            parts.append(f"{path}:missing")
            continue
        it = fs.listFiles(p, True)
        while it.hasNext():
            st = it.next()
            parts.append(f"{st.getPath().toString()}:{st.getLen()}:{st.getModificationTime()}")
    return "|".join(sorted(parts))
