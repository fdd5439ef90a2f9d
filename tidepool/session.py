"""Session construction, shared scratch locations and table loading."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def build_session(
    master: str | None = None,
    shuffle_partitions: int | None = None,
    app_name: str = "tidepool",
    extra: dict[str, str] | None = None,
) -> SparkSession:
    """Session with the settings every tidepool job relies on.

    * AQE on: runtime coalescing of small shuffle partitions, skew-join
      splitting and sort-merge -> broadcast conversion from *measured* sizes.
    * UTC session time zone so that timestamps compare like the SQL oracle.
    * ANSI mode stays at Spark's default (on in Spark 4); operators that read
      dirty text use ``try_*`` functions explicitly.
    * Streaming state lies in RocksDB, so that it isn't bounded by the heap.
    * The Spark UI stays off: no web server is opened.
    """
    b = SparkSession.builder.appName(app_name)
    if master:
        b = b.master(master)
    conf = {
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.sql.streaming.stateStore.providerClass":
            "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    }
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """The shared checkpoint folder the cluster names in ``spark.checkpoint.dir``.

    Read from the session.  Where it is unset, a session on one machine
    (``local[...]``) gets a folder of its own; on a cluster that is an error.
    """
    sc = spark.sparkContext
    d = sc.getCheckpointDir()
    if not d:
        conf = spark.conf.get("spark.checkpoint.dir", None)
        if conf:
            sc.setCheckpointDir(conf)
        elif not sc.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        else:  # unset in a local session: driver and executors are one machine
            sc.setCheckpointDir(tempfile.mkdtemp(prefix="tidepool-ckpt-"))
        d = sc.getCheckpointDir()
    return d.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique folder below the shared checkpoint root.

    Used for tables a query writes and reads back (CSV landings, external
    tables, copies).  Every call gets a new folder, so runs never collide.
    """
    return f"{checkpoint_root(spark)}/tidepool/{name}-{uuid.uuid4().hex[:12]}"


def landed(spark: SparkSession, df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` below the shared checkpoint root and read it back.

    Cuts the lineage with files every executor sees, so a lost executor never
    forces what came before to run again.
    """
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


def load_tables(spark: SparkSession, sf_dir: str, names=TABLES) -> dict[str, DataFrame]:
    """Register every driver table as a temp view and return them by name."""
    out = {}
    for n in names:
        df = read_table(spark, sf_dir, n)
        df.createOrReplaceTempView(n)
        out[n] = df
    return out
