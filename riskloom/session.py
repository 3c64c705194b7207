"""Session settings the operators rely on."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_CHECKPOINT_KEY = "spark.checkpoint.dir"
_PARTITION_KEY = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
#: Shuffled bytes a task gets where the session does not say: running sums compress some forty times,
#: so Spark's own 64 MB become gigabytes in the memory of one task.
PARTITION_BYTES = 4 << 20
_METHOD_KEY = "spark.sql.codegen.hugeMethodLimit"
#: Bytes of a generated method beyond which the JVM only interprets it; Spark's own limit is 65,535.
COMPILED_METHOD_BYTES = 8000


def configure(spark: SparkSession) -> SparkSession:
    """Set what results depend on: UTC wall-clock functions, AQE for skewed joins, small tasks, and
    generated code that the JVM compiles: wide feature rows make methods it would interpret."""
    wanted = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
    }
    for key, value in wanted.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    if spark.conf.get(_PARTITION_KEY).lower() in ("64mb", "64m", "67108864b", "67108864"):
        spark.conf.set(_PARTITION_KEY, f"{PARTITION_BYTES}b")
    if spark.conf.get(_METHOD_KEY) == "65535":
        spark.conf.set(_METHOD_KEY, str(COMPILED_METHOD_BYTES))
    return spark


def local_session(cores: str = "*", app: str = "riskloom", **extra: str) -> SparkSession:
    """A single-machine session for tests and the bench; clusters bring their own."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", "16")
        .config("spark.sql.adaptive.coalescePartitions.minPartitionSize", "128k")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
    )
    for key, value in extra.items():
        builder = builder.config(key.replace("__", "."), value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The shared folder for checkpoints, from the session.

    Only a local master may fall back to a temporary folder: on a cluster such a folder would be
    private to one machine, and its loss would lose the data.
    """
    configured = spark.conf.get(_CHECKPOINT_KEY, None) or spark.sparkContext.getConf().get(
        _CHECKPOINT_KEY
    )
    if configured:
        return configured
    current = spark.sparkContext.getCheckpointDir()
    if current:
        return current
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError(f"set {_CHECKPOINT_KEY} to a folder every executor can reach")
    return tempfile.mkdtemp(prefix="riskloom-checkpoint-")


def checkpointed(df: DataFrame) -> DataFrame:
    """Write ``df`` to the shared checkpoint folder and continue from the written copy.

    The copy is Parquet, so later readers take only the columns they name, in tasks of their own size.
    """
    path = f"{shared_dir(df.sparkSession)}/table-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
