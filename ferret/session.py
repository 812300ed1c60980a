"""Session helpers: a local session for tests and the bench, and the shared
folder where jobs write tables that cut lineage."""

from __future__ import annotations

import hashlib
import os
import tempfile

from pyspark.sql import DataFrame, SparkSession


def get_spark(cpus: int | str | None = None, shuffle_partitions: int | None = None,
              app: str = "ferret") -> SparkSession:
    """Local session with AQE on and the UI off (tests and bench only; on a
    cluster the caller brings its own session)."""
    cpus = cpus or os.environ.get("BENCH_CPUS", "8")
    parts = shuffle_partitions or int(cpus) if str(cpus).isdigit() else 8
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", str(parts))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "16g")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    shared_dir(spark)
    return spark


_LOCAL_DIRS: dict[str, str] = {}


def shared_dir(spark: SparkSession) -> str:
    """The folder the cluster names in ``spark.checkpoint.dir``, read from the
    session. Where it is unset a local master (tests) gets a scratch folder,
    one per application; any other master is an error."""
    sc = spark.sparkContext
    d = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if not d:
        if sc.master != "local" and not sc.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        if sc.applicationId not in _LOCAL_DIRS:
            _LOCAL_DIRS[sc.applicationId] = tempfile.mkdtemp(prefix="ferret-ckpt-", dir="/tmp")
        d = _LOCAL_DIRS[sc.applicationId]
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(d)
    return d.rstrip("/")


def table_path(spark: SparkSession, name: str, *key_parts: object) -> str:
    """Deterministic location under the shared folder for a derived table."""
    h = hashlib.sha1("|".join(str(p) for p in key_parts).encode()).hexdigest()[:16]
    return f"{shared_dir(spark)}/ferret/{name}-{h}"


def path_exists(spark: SparkSession, path: str) -> bool:
    """Hadoop-FS aware existence check of a ``_SUCCESS`` marker."""
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    p = jvm.org.apache.hadoop.fs.Path(path + "/_SUCCESS")
    return p.getFileSystem(conf).exists(p)


def scratch(spark: SparkSession) -> str:
    """A new folder for a table of one job under the shared folder."""
    import uuid

    return f"{shared_dir(spark)}/ferret/tmp-{uuid.uuid4().hex}"


def materialize(df: DataFrame) -> tuple[DataFrame, int]:
    """Cut lineage: write ``df`` once as parquet under the shared checkpoint
    folder (survives executor loss, one job), read it back, return it with
    its row count."""
    path = scratch(df.sparkSession)
    df.write.mode("overwrite").parquet(path)
    out = df.sparkSession.read.parquet(path)
    return out, out.count()


def parallelism(spark: SparkSession) -> int:
    """Partition count for CPU-heavy stages after an explicit repartition
    (an explicit count keeps AQE from coalescing a small-by-bytes but
    expensive-per-row stage, e.g. tokenizing, into one task): the configured
    shuffle partitions, at least one per core."""
    return max(spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions", "200")))


def scan_parallelism(df: DataFrame, target_bytes: int = 64 << 20) -> int:
    """At least :func:`parallelism`, and a partition per ``target_bytes`` of the
    largest table ``df`` scans (file sizes), for an exchange of what is left of
    that table: the optimizer's estimate of a join multiplies its sides."""
    sizes = [0]
    try:
        leaves = df._jdf.queryExecution().optimizedPlan().collectLeaves()
        # a Scala BigInt, which comes as an int
        sizes += [int(str(leaves.apply(k).stats().sizeInBytes())) for k in range(leaves.size())]
    except Exception:  # pragma: no cover - stats unavailable
        pass
    # rows that come from the driver may say that their size is unknown: 2^63
    return max(parallelism(df.sparkSession), -(-max(x for x in sizes if x < 1 << 50) // target_bytes))


MAX_BROADCAST_ROWS = 1_000_000


def small(df: DataFrame, max_rows: int = MAX_BROADCAST_ROWS) -> DataFrame:
    """Broadcast hint only behind a proven bound: the row count is taken
    (one job on a request-side table) and compared with ``max_rows``;
    above it the join is left to the planner (shuffle join, AQE)."""
    from pyspark.sql import functions as F

    return F.broadcast(df) if df.count() <= max_rows else df
