"""Session helpers: building a local session and finding the shared checkpoint folder.

Library code never invents a storage location. Lineage is cut with reliable
``checkpoint()`` into the folder the cluster names in ``spark.checkpoint.dir``;
only local entry points (tests, bench, the driver contract) set one, and only
when the session has none.
"""

from __future__ import annotations

import tempfile

from pyspark.sql import DataFrame, SparkSession

# Settings every session of ours runs with. UTC + ANSI keep results equal to the
# DuckDB oracle; AQE re-plans joins and coalesces / splits skewed partitions.
BASE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.parquet.filterPushdown": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def cluster_conf(input_bytes: int, partition_mb: int = 256) -> dict:
    """Starting settings for a large cluster reading ``input_bytes``.

    Shuffles start with one partition per ``partition_mb`` of input, and AQE coalesces
    small ones and splits skewed ones at run time. Shuffle metadata grows with map tasks
    × reduce partitions: for very large inputs raise ``partition_mb``, not a hidden cap;
    scans read ``partition_mb`` splits; skew-join splitting starts at 4 × the median.
    """
    parts = max(200, input_bytes // (partition_mb << 20))
    return {
        **BASE_CONF,
        "spark.sql.shuffle.partitions": str(parts),
        "spark.sql.files.maxPartitionBytes": f"{partition_mb}m",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": f"{partition_mb}m",
        # size post-shuffle partitions by bytes, not by the default parallelism
        "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "4",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": f"{partition_mb}m",
        "spark.sql.autoBroadcastJoinThreshold": "64m",
    }


def build_session(master: str = "local[*]", shuffle_partitions: int = 8,
                  app: str = "metricmart", extra: dict | None = None) -> SparkSession:
    """A session for local runs. On a cluster, pass the cluster's own session instead."""
    b = SparkSession.builder.master(master).appName(app)
    conf = dict(BASE_CONF)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.setdefault("spark.driver.memory", "8g")
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_local_checkpoint_dir(spark)
    ship_package(spark)
    return spark


_SHIPPED: set = set()


def ship_package(spark: SparkSession) -> None:
    """Make this package importable in the Python workers of every executor, as
    ``spark-submit --py-files`` would: a zip of the package is added with ``addPyFile``
    once per application (the pandas state function of the alert stream runs there)."""
    import os
    import zipfile

    sc = spark.sparkContext
    if sc.applicationId in _SHIPPED:
        return
    pkg = os.path.dirname(os.path.abspath(__file__))
    root = os.path.dirname(pkg)
    fd, path = tempfile.mkstemp(prefix="metricmart-", suffix=".zip")
    os.close(fd)
    with zipfile.ZipFile(path, "w") as z:
        for dirpath, _, files in os.walk(pkg):
            for f in files:
                if f.endswith(".py"):
                    full = os.path.join(dirpath, f)
                    z.write(full, os.path.relpath(full, root))
    sc.addPyFile(path)
    _SHIPPED.add(sc.applicationId)


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder of this session (``spark.checkpoint.dir``)."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        sc.setCheckpointDir(configured)
        return sc.getCheckpointDir()
    raise RuntimeError(
        "no checkpoint folder: set spark.checkpoint.dir to a shared (HDFS/S3/…) path")


def ensure_local_checkpoint_dir(spark: SparkSession) -> str:
    """Create a scratch checkpoint folder if none is set; only a ``local`` master may do that."""
    try:
        return checkpoint_dir(spark)
    except RuntimeError:
        master = spark.sparkContext.master
        if not (master == "local" or master.startswith("local[")):
            raise  # executors elsewhere could not read the driver's own folder
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="metricmart-ckpt-"))
        return spark.sparkContext.getCheckpointDir()


def freeze(df: DataFrame) -> DataFrame:
    """Materialise ``df`` with a reliable checkpoint so later reads see one fixed result.

    Reliable (not local) checkpoints live in the shared folder and survive the
    loss of the executors that computed them.
    """
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def no_rows(spark: SparkSession, schema) -> DataFrame:
    """An empty frame that the optimizer knows to be empty, so that joins with it fall away (one made from a list is
    an RDD of Python's, which is run)."""
    from pyspark.sql import functions as F

    return spark.range(1).filter("false").select(*[F.lit(None).cast(f.dataType).alias(f.name) for f in schema.fields])


def run_concurrently(tasks: list, max_workers: int = 8) -> list:
    """Run independent driver-side calls that each submit Spark jobs (writes, loads) from
    separate threads, so their jobs share the cluster's task slots; results in input order."""
    from concurrent.futures import ThreadPoolExecutor

    if len(tasks) <= 1:
        return [t() for t in tasks]
    with ThreadPoolExecutor(min(max_workers, len(tasks))) as pool:
        return list(pool.map(lambda t: t(), tasks))


def broadcast_if_small(df: DataFrame, most: int = 300_000) -> DataFrame:
    """Hint a stored or cached table of a few short columns for broadcast if it has at most ``most``
    rows; beyond that it is joined by a shuffle like any other."""
    from pyspark.sql import functions as F

    return F.broadcast(df) if df.limit(most + 1).count() <= most else df
