"""Session defaults, shared folder and lineage cuts."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # The JVM does not compile methods beyond this size; wide projections fall back
    # to split expression code, which it does compile.
    "spark.sql.codegen.hugeMethodLimit": "8000",
    # Whole texts go to Python in batches; rows alone do not bound a batch of long texts.
    "spark.sql.execution.arrow.maxBytesPerBatch": str(8 << 20),
}


def apply_defaults(spark: SparkSession) -> SparkSession:
    """Sets the defaults on a session that was made elsewhere."""
    for key, value in DEFAULTS.items():
        spark.conf.set(key, value)
    return spark


def local_session(app: str = "legwork", cores: str = "*", **conf: str) -> SparkSession:
    """A local session for tests and the bench; a cluster brings its own."""
    builder = SparkSession.builder.master(f"local[{cores}]").appName(app)
    settings = {
        **DEFAULTS,
        "spark.sql.shuffle.partitions": "8",
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.driver.memory": "12g",
        "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
        **conf,
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors can reach, named by ``spark.checkpoint.dir``.

    Only a local-mode session may fall back to a temporary folder.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("spark.checkpoint.dir must name a folder shared by all executors")
    fallback = getattr(spark.sparkContext, "_legwork_shared_dir", None)
    if fallback is None:
        fallback = tempfile.mkdtemp(prefix="legwork-")
        spark.sparkContext._legwork_shared_dir = fallback
    return fallback


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder."""
    return f"{shared_dir(spark)}/legwork/{name}-{uuid.uuid4().hex}"


def cut_lineage(df: DataFrame) -> DataFrame:
    """Write ``df`` to the reliable checkpoint folder and continue from the files."""
    spark = df.sparkSession
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(shared_dir(spark))
    return df.checkpoint(eager=True)


def cut_to_table(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet below the shared folder and continue from the files.

    Later reads fetch only the columns they use, which a checkpoint cannot do.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.parquet(path)


#: Rows of a part that is worth a task, and rows after which a part is divided anyway.
LEAST_ROWS, MOST_ROWS = 2048, 1 << 18


def even_parts(df: DataFrame, rows: int) -> int:
    """Parts of ``rows`` rows that many jobs will read: two per core, more only for very many rows.

    Every pass over the rows sends its task results to the driver, so small parts are not wanted.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return max(1, min(-(-rows // LEAST_ROWS), max(2 * cores, -(-rows // MOST_ROWS))))
