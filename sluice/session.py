"""Session helpers: a local session for tests/bench and the shared scratch folder."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession


def local_session(cores: int | str = "*", shuffle_partitions: int = 8) -> SparkSession:
    """A local session configured the way the tests and the bench expect."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("sluice")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", os.environ.get("SLUICE_DRIVER_MEMORY", "4g"))
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel(os.environ.get("SLUICE_LOG_LEVEL", "ERROR"))
    ensure_utc(spark)
    return spark


def ensure_utc(spark: SparkSession) -> None:
    """Timestamps are rendered and parsed in UTC (the original used the server zone)."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    On a cluster this must be set (a path every executor can reach). Only a
    local-mode session without it gets a folder of its own, as in tests.
    """
    sc = spark.sparkContext
    configured = sc.getConf().get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if configured:
        return configured
    if not sc.master.startswith("local"):
        raise RuntimeError("spark.checkpoint.dir must name a shared folder on a cluster")
    path = tempfile.mkdtemp(prefix="sluice-ckpt-")
    sc.setCheckpointDir(path)
    return sc.getCheckpointDir() or path


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique folder under the shared checkpoint root."""
    root = checkpoint_root(spark).rstrip("/")
    return f"{root}/sluice/{name}-{uuid.uuid4().hex[:12]}"


def _fs_exists(spark: SparkSession, path: str) -> bool:
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p)


_FINGERPRINT: list[str] = []


def code_fingerprint() -> str:
    """Hash of this package's source: derived data is re-landed when the code changes."""
    if not _FINGERPRINT:
        import hashlib
        from pathlib import Path

        h = hashlib.sha1()
        root = Path(__file__).resolve().parent
        for f in sorted(root.rglob("*.py")):
            h.update(str(f.relative_to(root)).encode())
            h.update(f.read_bytes())
        _FINGERPRINT.append(h.hexdigest()[:12])
    return _FINGERPRINT[0]


def landed_path(spark: SparkSession, kind: str, source, write) -> str:
    """Land a derived dataset once and reuse it while its source and this code are unchanged.

    ``source`` is the DataFrame it derives from; the key is the source's file
    list, total size and modification times plus the package's code fingerprint, so new data or
    new derivation rules land again. ``write(path)`` must write the dataset to
    ``path`` (the writer's ``_SUCCESS`` marker is the commit).
    """
    import hashlib

    files = sorted(source.inputFiles())
    # total bytes from the file index Spark already built (no extra file-system calls)
    size = str(source._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())
    # a source rewritten in place at the same size has another modification time
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    paths = [jvm.org.apache.hadoop.fs.Path(f) for f in files]
    times = [p.getFileSystem(conf).getFileStatus(p).getModificationTime() for p in paths]
    key = hashlib.sha1(("\n".join(files) + f"|{size}|{times}|{code_fingerprint()}").encode()).hexdigest()[:16]
    root = checkpoint_root(spark).rstrip("/")
    path = f"{root}/sluice/landed/{kind}-{key}"
    if not _fs_exists(spark, f"{path}/_SUCCESS"):
        write(path)
    return path
