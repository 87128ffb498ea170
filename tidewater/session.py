"""SparkSession construction and cluster-safe scratch locations.

Library code never creates its own session: every operator takes a
DataFrame (or a session) from the caller. ``local_session`` exists for
tests, the bench and the examples only.
"""

from __future__ import annotations

import hashlib
import tempfile
import uuid
from contextlib import contextmanager

from pyspark.sql import SparkSession

# Settings a job on a large cluster relies on. AQE coalesces the many
# shuffle partitions needed at 100 TB down to sensible task sizes on small
# inputs, and splits skewed join partitions at run time.
CLUSTER_DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
}

# Settings for the 100 TB target (1000 executors): many initial shuffle
# partitions that AQE coalesces to ~256 MB each, 256 MB scan splits, and a
# skew split for any shuffle partition 5× the median and above 512 MB.
LARGE_SCALE_CONF = {
    **CLUSTER_DEFAULTS,
    "spark.sql.shuffle.partitions": "40000",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256m",
    "spark.sql.adaptive.coalescePartitions.minPartitionSize": "64m",
    "spark.sql.files.maxPartitionBytes": "256m",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "5",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "512m",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "64m",
}


def apply_conf(spark: SparkSession, conf: dict[str, str] = LARGE_SCALE_CONF) -> SparkSession:
    """Apply runtime SQL settings to an existing session (e.g. ``LARGE_SCALE_CONF`` on a cluster)."""
    for key, value in conf.items():
        spark.conf.set(key, value)
    return spark


def local_session(cores: int = 8, shuffle_partitions: int = 8, app: str = "tidewater") -> SparkSession:
    """Local session for tests and the bench (never used by library code)."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", "16g")
    )
    for key, value in CLUSTER_DEFAULTS.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder the cluster names for checkpoints.

    On a cluster ``spark.checkpoint.dir`` points at shared storage; a local
    folder is chosen only when nothing is configured (tests).
    """
    configured = spark.sparkContext.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured
    return ensure_checkpoint_dir(spark)


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Set a checkpoint folder only where none is configured (as in tests)."""
    current = spark.sparkContext.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a shared folder on a cluster")
        configured = tempfile.mkdtemp(prefix="tidewater-ckpt-")
    spark.sparkContext.setCheckpointDir(configured)
    return spark.sparkContext.getCheckpointDir() or configured


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh sub-folder under the shared checkpoint root for written tables."""
    root = checkpoint_root(spark).rstrip("/")
    path = f"{root}/tidewater/{name}-{uuid.uuid4().hex[:12]}"
    _HANDED_OUT.setdefault(spark.sparkContext.applicationId, []).append(path)
    return path


_HANDED_OUT: dict[str, list[str]] = {}
_RELEASED = 0


def scratch_mark(spark: SparkSession) -> int:
    """A mark for :func:`release_scratch`: what is written from now on comes after it."""
    return len(_HANDED_OUT.get(spark.sparkContext.applicationId, []))


def release_scratch(spark: SparkSession, since: int = 0) -> int:
    """Delete the folders that this application's operators wrote under the shared
    checkpoint root (after a mark ``since``), and forget the tables kept in them; returns how
    many there were. Call it at the end of a job: frames that read those folders are of no
    use after it."""
    global _RELEASED
    app = spark.sparkContext.applicationId
    every = _HANDED_OUT.get(app, [])
    paths, _HANDED_OUT[app] = every[since:], every[:since]
    conf = spark._jsc.hadoopConfiguration()
    for p in paths:
        path = spark._jvm.org.apache.hadoop.fs.Path(p)
        path.getFileSystem(conf).delete(path, True)
    gone = set(paths)
    for k in [k for k, p in _WRITTEN.items() if k[0] == app and p in gone]:
        del _WRITTEN[k]
    _RELEASED += 1
    return len(paths)


#: Bytes of input files per shuffle partition, and of shuffled data per task, of the tables written here.
PARTITION_BYTES = 8 << 20
TASK_BYTES = 16 << 20
#: Bytes of input files per scan task of tables whose rows a task sums up before a shuffle.
SCAN_BYTES = 4 << 20


def input_bytes(df) -> int:
    """Bytes of the files a frame reads, by one listing per folder."""
    spark = df.sparkSession
    files, conf, total = set(df.inputFiles()), spark._jsc.hadoopConfiguration(), 0
    for folder in {f.rsplit("/", 1)[0] for f in files}:
        path = spark._jvm.org.apache.hadoop.fs.Path(spark._jvm.java.net.URI(folder))
        total += sum(s.getLen() for s in path.getFileSystem(conf).listStatus(path) if s.isFile())
    return total


def _bytes(text: str) -> int:
    number = text.lower().rstrip("bkmgt")
    return int(number) << {"k": 10, "m": 20, "g": 30, "t": 40}.get(text.lower().rstrip("b")[len(number):][:1], 0)


@contextmanager
def sized_shuffles(df):
    """Shuffles of the jobs in the block follow the input of ``df``: a partition for each
    ``PARTITION_BYTES`` of it (or the session's number, if larger), joined again up to
    ``TASK_BYTES`` only, so that a task's sorts stay as large as they are however the tables
    grow. The session's settings are put back afterwards."""
    conf = df.sparkSession.conf
    parts, task = "spark.sql.shuffle.partitions", "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    before = {parts: conf.get(parts), task: conf.get(task)}
    try:
        conf.set(parts, str(max(int(before[parts]), -(-input_bytes(df) // PARTITION_BYTES))))
        conf.set(task, str(min(_bytes(before[task]), TASK_BYTES)))
        yield
    finally:
        for key, value in before.items():
            conf.set(key, value)


@contextmanager
def split_scans(df, scan_bytes: int | None):
    """Scans of the jobs in the block are split at ``scan_bytes`` (None: as the session has
    it), so that a task's sums ahead of a shuffle stay as large as they are."""
    conf, scan = df.sparkSession.conf, "spark.sql.files.maxPartitionBytes"
    before = conf.get(scan)
    try:
        if scan_bytes:
            conf.set(scan, str(min(_bytes(before), scan_bytes)))
        yield
    finally:
        conf.set(scan, before)


@contextmanager
def partitioned_joins(spark: SparkSession):
    """Joins of the jobs in the block keep sides that are partitioned alike by some of their
    keys as they are, instead of shuffling them again by all keys."""
    conf, whole = spark.conf, "spark.sql.requireAllClusterKeysForCoPartition"
    before = conf.get(whole)
    try:
        conf.set(whole, "false")
        yield
    finally:
        conf.set(whole, before)


def materialize(df):
    """A derived table that feeds several jobs (feature table → model fits), written
    as Parquet to the shared folder: lineage is cut and later scans are pruned."""
    return written(df, "table")


def written(df, name: str, scan_bytes: int | None = None):
    """``df`` written to the shared checkpoint folder as Parquet and read back:
    lineage is cut, later scans read only their columns, and a lost executor
    costs a re-read."""
    path = scratch_path(df.sparkSession, name)
    with sized_shuffles(df), split_scans(df, scan_bytes):
        df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


_WRITTEN: dict[tuple[str, str, str], str] = {}


def folder_stamp(spark: SparkSession, folder: str) -> str:
    """Names, sizes and modification times of a folder's tables and their files, as one
    hash: equal as long as the input is the same, in any application."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    fs = path.getFileSystem(spark._jsc.hadoopConfiguration())
    seen = []
    for top in fs.listStatus(path):
        for status in fs.listStatus(top.getPath()) if top.isDirectory() else [top]:
            seen.append((status.getPath().toString(), status.getLen(), status.getModificationTime()))
    return hashlib.sha256(repr(sorted(seen)).encode()).hexdigest()[:16]


def input_stamp(spark: SparkSession, folder: str) -> str:
    """:func:`folder_stamp`, which changes too when scratch folders are released."""
    return f"{folder_stamp(spark, folder)}-{_RELEASED}"


def written_table(spark: SparkSession, key: str, build, folder: str | None = None) -> "DataFrame":  # noqa: F821
    """A derived table written once as Parquet under the shared checkpoint
    folder and read back (lineage cut, restartable, predicates still pushed
    into the scan). ``build`` is called only on the first use per application
    and, with ``folder``, per state of the input files in it."""
    k = (spark.sparkContext.applicationId, key, input_stamp(spark, folder) if folder else "")
    if k not in _WRITTEN:
        path = scratch_path(spark, key.replace("/", "_").replace(":", "_")[-60:])
        df = build()
        with sized_shuffles(df), split_scans(df, SCAN_BYTES):
            df.write.mode("overwrite").parquet(path)
        _WRITTEN[k] = path
    return spark.read.parquet(_WRITTEN[k])
