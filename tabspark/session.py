"""Session helpers: building a local session for tests/bench and cutting lineage.

On a cluster the session comes from the platform; the library only reads
``spark.checkpoint.dir`` from it.  A private checkpoint folder is created only
when the setting is absent *and* the master is local (tests, laptops).
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession


def build_session(master: str | None = None, shuffle_partitions: int = 8,
                  app: str = "tabspark") -> SparkSession:
    master = master or f"local[{os.environ.get('BENCH_CPUS', '8')}]"
    return (
        SparkSession.builder.master(master)
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "16g")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        # checkpoint files of split/fold/OOF tables are removed once unreferenced
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
        .getOrCreate()
    )


def checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder, registering it with the context."""
    try:
        sc = spark.sparkContext
    except Exception:  # noqa: BLE001 -- Spark Connect: the server's setting applies
        return spark.conf.get("spark.checkpoint.dir", None)
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get(
        "spark.checkpoint.dir", None)
    if configured:
        sc.setCheckpointDir(configured)
        return configured
    if not sc.master.startswith("local"):
        raise RuntimeError("spark.checkpoint.dir must name a shared folder on a cluster")
    local = tempfile.mkdtemp(prefix="tabspark-ckpt-")
    sc.setCheckpointDir(local)
    return local


def materialize(df: DataFrame) -> DataFrame:
    """Reliable checkpoint: the result no longer depends on its lineage.

    Used wherever a later step must see *exactly* the rows an earlier action
    saw (range-partition bounds are sampled, so a recomputation could move
    rows between partitions) and to survive executor loss in driver loops.
    """
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def stage(df: DataFrame, label: str = "stage") -> DataFrame:
    """Write ``df`` as Parquet below the shared checkpoint folder and read it back.

    Cuts the lineage like a checkpoint, but later readers keep column pruning,
    filter push-down and file statistics.
    """
    spark = df.sparkSession
    path = f"{checkpoint_dir(spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out.stage_path = path
    return out


def scanned(df: DataFrame) -> bool:
    """Whether ``df`` is a table or file as it is read, row by row: nothing worth writing down before several passes."""
    try:
        nodes = [df._jdf.queryExecution().optimizedPlan()]
    except Exception:  # noqa: BLE001 -- Spark Connect shows no plan
        return False
    while nodes:
        node = nodes.pop()
        if node.nodeName() not in ("Project", "Filter", "Generate") and node.children().size():
            return False
        nodes += [node.children().apply(i) for i in range(node.children().size())]
    return True


def written(df: DataFrame, label: str) -> tuple[DataFrame, list[DataFrame]]:
    """``df`` for several passes: as it is where it is ``scanned``, else staged; with the stages to drop."""
    if scanned(df):
        return df, []
    out = stage(df, label)
    return out, [out]


def drop_stages(*staged: DataFrame) -> None:
    """Delete the files of staged tables that nothing will read any more."""
    for df in staged:
        spark = df.sparkSession
        path = spark._jvm.org.apache.hadoop.fs.Path(df.stage_path)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def cache(df: DataFrame) -> DataFrame:
    """Spill-safe cache for inputs reused by a driver loop (recomputable)."""
    return df.persist(StorageLevel.MEMORY_AND_DISK)


def broadcast_limit_rows(spark: SparkSession) -> int:
    """Row bound under which a computed side table is broadcast explicitly."""
    return int(spark.conf.get("tabspark.broadcast.maxRows", "200000"))
