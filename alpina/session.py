"""Session defaults and the shared scratch area.

Time is UTC everywhere; ANSI stays on (strict casts raise, ``try_*`` returns NULL).
Intermediate files go below the cluster's ``spark.checkpoint.dir`` — a shared folder —
never below a machine-local temp directory. A private directory is only created when
the session has none configured (local tests).
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # windows-1252 is only accepted through the legacy charset switch
    "spark.sql.legacy.javaCharsets": "true",
}


def build_session(master: str = "local[8]", app: str = "alpina", shuffle_partitions: int = 8,
                  extra: dict | None = None) -> SparkSession:
    b = SparkSession.builder.master(master).appName(app)
    conf = dict(DEFAULT_CONF)
    conf.update({
        "spark.sql.shuffle.partitions": str(shuffle_partitions),
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.driver.memory": "16g",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
    })
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    apply_runtime_conf(spark)
    return spark


def apply_runtime_conf(spark: SparkSession) -> None:
    """Pin the session-level settings the operators rely on (safe on an existing session)."""
    for k in ("spark.sql.session.timeZone", "spark.sql.ansi.enabled"):
        spark.conf.set(k, DEFAULT_CONF[k])
    try:
        spark.conf.set("spark.sql.legacy.javaCharsets", "true")
    except Exception:  # static on some deployments; then it must be set at launch
        pass


def checkpoint_root(spark: SparkSession) -> str:
    """The cluster's shared checkpoint folder; a private one only when none is configured."""
    sc = spark.sparkContext
    root = sc.getConf().get("spark.checkpoint.dir") or sc.getCheckpointDir()
    if not root:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that all nodes share")
        root = tempfile.mkdtemp(prefix="alpina-ckpt-")
        sc.setCheckpointDir(root)
        root = sc.getCheckpointDir()
    return root


_RUN_ID = uuid.uuid4().hex[:12]


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique folder below the shared checkpoint root for one operator run."""
    root = checkpoint_root(spark).rstrip("/")
    return f"{root}/alpina-scratch/{_RUN_ID}/{name}-{uuid.uuid4().hex[:8]}"


def hadoop_fs(spark: SparkSession, path: str):
    """(FileSystem, Path) for a path, through the JVM's Hadoop client (works for any scheme)."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return fs, p


def path_exists(spark: SparkSession, path: str) -> bool:
    fs, p = hadoop_fs(spark, path)
    return bool(fs.exists(p))


def delete_path(spark: SparkSession, path: str) -> bool:
    fs, p = hadoop_fs(spark, path)
    return bool(fs.delete(p, True))


def list_dir(spark: SparkSession, path: str) -> list[str]:
    """Names of the direct children of a folder (empty when missing)."""
    fs, p = hadoop_fs(spark, path)
    if not fs.exists(p):
        return []
    return [s.getPath().getName() for s in fs.listStatus(p)]


def write_text_file(spark: SparkSession, path: str, text: str, encoding: str = "utf-8") -> None:
    """Small control files (markers) via the Hadoop client, so they land on shared storage."""
    fs, p = hadoop_fs(spark, path)
    out = fs.create(p, True)
    try:
        out.write(bytearray(text.encode(encoding)))
    finally:
        out.close()


def read_text_file(spark: SparkSession, path: str, encoding: str = "utf-8") -> str:
    fs, p = hadoop_fs(spark, path)
    stream = fs.open(p)
    try:
        return bytes(stream.readAllBytes()).decode(encoding)
    finally:
        stream.close()


def local_path(path: str) -> str:
    return path[len("file:"):] if path.startswith("file:") else path


__all__ = [
    "build_session", "apply_runtime_conf", "checkpoint_root", "scratch_path", "hadoop_fs",
    "path_exists", "delete_path", "list_dir", "write_text_file",
    "read_text_file", "local_path",
]
