"""Session, table and checkpoint helpers shared by every operator."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


#: Shuffle files are deleted when the query ends, not when the driver happens to collect garbage.
_TIDY = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def get_spark(app: str = "tallyloom", cores: str | int = "*", shuffle_partitions: int = 8) -> SparkSession:
    """A local session for tests and the bench; on a cluster the caller's session is used as it is."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", os.environ.get("TALLYLOOM_DRIVER_MEMORY", "12g"))
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One input table; columns are pruned by whatever reads it."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_folder(spark: SparkSession) -> str:
    """The folder named by spark.checkpoint.dir, which all executors share.

    Only a local session without that setting gets a folder of its own, because there driver
    and executors are one process.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder
    own = spark.sparkContext._jsc.sc().getCheckpointDir()
    if own.isDefined():
        return own.get()
    master = spark.sparkContext.master
    if not master.startswith("local") or master.startswith("local-cluster"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    return "file://" + tempfile.mkdtemp(prefix="tallyloom-checkpoint-")


def checkpointed(df: DataFrame) -> DataFrame:
    """Cut the lineage with a reliable checkpoint in the shared folder."""
    sc = df.sparkSession.sparkContext
    if not sc._jsc.sc().getCheckpointDir().isDefined():
        sc.setCheckpointDir(shared_folder(df.sparkSession))
    return df.checkpoint(eager=True)


def stored(df: DataFrame, by: list[str] | None = None) -> DataFrame:
    """df written once to the shared folder, for results of which several branches read parts; by: columns that divide its files.

    Unlike a checkpoint it is compressed and read by column, and the shuffle files that it was made from go at once. Its own
    files go with release, or when the session's JVM ends.
    """
    spark = df.sparkSession
    folder = f"{shared_folder(spark)}/stored-{uuid.uuid4()}"
    before = spark.conf.get(_TIDY, None)
    spark.conf.set(_TIDY, "true")
    try:
        df.write.partitionBy(*by or []).parquet(folder)
    finally:
        spark.conf.unset(_TIDY) if before is None else spark.conf.set(_TIDY, before)
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(path)
    return (spark.read.schema(df.schema) if by else spark.read).parquet(folder)  # divided files of no rows have no schema


def release(df: DataFrame) -> None:
    """Delete the files of a checkpoint or stored table that nothing will read again: what came from it is written itself."""
    spark = df.sparkSession
    plan = df._jdf.queryExecution().analyzed()
    kind = plan.getClass().getSimpleName()
    if kind == "LogicalRDD" and plan.rdd().getCheckpointFile().isDefined():
        path = spark._jvm.org.apache.hadoop.fs.Path(plan.rdd().getCheckpointFile().get())
    elif kind == "LogicalRelation" and plan.relation().location().rootPaths().head().getName().startswith("stored-"):
        path = plan.relation().location().rootPaths().head()
    else:
        return
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def bounded(df: DataFrame, max_rows: int, what: str) -> DataFrame:
    """The broadcast hint for a side whose size is checked here: more than max_rows rows get no hint.

    The check counts at most max_rows + 1 rows, so it stays cheap however large the side is.
    """
    n = df.limit(max_rows + 1).count()
    return F.broadcast(df) if n <= max_rows else df


def salted_lookup(rows: DataFrame, lookup: DataFrame, keys: list[str], salt_from: str, salts: int | None = None, how: str = "left") -> DataFrame:
    """Join rows to a table when one key may hold a third of the rows.

    Each lookup row is repeated once per salt and each row takes the salt of a hash of
    salt_from, so a hot key is spread over that many tasks whatever AQE decides. By default there
    are as many salts as cores, within 8 and 64.
    """
    if salts is None:
        salts = max(8, min(64, rows.sparkSession.sparkContext.defaultParallelism))
    spread = lookup.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    return (
        rows.withColumn("_salt", F.pmod(F.xxhash64(salt_from), F.lit(salts)).cast("int"))
        .join(spread, [*keys, "_salt"], how)
        .drop("_salt")
    )


def lookup_join(rows: DataFrame, lookup: DataFrame, keys: list[str], salt_from: str, max_rows: int, how: str = "inner") -> DataFrame:
    """rows joined to a lookup whose size is counted here: broadcast up to max_rows rows, salted beyond."""
    if lookup.limit(max_rows + 1).count() <= max_rows:
        return rows.join(F.broadcast(lookup), keys, how)
    return salted_lookup(rows, lookup, keys, salt_from, how=how)
