"""Session helpers. The caller owns the session; nothing here stops one."""

from __future__ import annotations

import pickle
import re
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark import Broadcast, cloudpickle
from pyspark.sql import DataFrame, SparkSession, functions as F


def local_session(cpus: int | str = "*", app: str = "lodestat") -> SparkSession:
    """Session for tests and bench.py; clusters bring their own."""
    return (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.driver.memory", "20g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )


def use_checkpoint_dir(spark: SparkSession) -> None:
    """Point checkpoints at the shared folder named in ``spark.checkpoint.dir``.

    Only a session whose tasks all run in this process gets a folder of its own without
    the setting; elsewhere a machine-local folder would be lost with its executor.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    sc = spark.sparkContext
    if sc.getCheckpointDir() is not None:
        return
    if configured:
        sc.setCheckpointDir(configured)
    elif re.fullmatch(r"local(\[[^\]]*\])?", sc.master):
        sc.setCheckpointDir(tempfile.mkdtemp(prefix="lodestat-"))
    else:
        raise ValueError("set spark.checkpoint.dir to a shared folder")


def settle(df: DataFrame) -> DataFrame:
    """Compute ``df`` once and keep it on reliable storage."""
    use_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def settle_table(df: DataFrame) -> DataFrame:
    """Write ``df`` once as parquet next to the checkpoints and read it back.

    For wide tables read many times: later scans prune columns and push filters,
    which a checkpointed DataFrame cannot. The shuffle files of the write go with it,
    since nothing reads them again.
    """
    spark = df.sparkSession
    use_checkpoint_dir(spark)
    path = f"{spark.sparkContext.getCheckpointDir()}/table-{uuid.uuid4().hex}"
    if _OPEN_SCOPES:
        _OPEN_SCOPES[-1].append(path)
    before = spark.conf.get(_CLEANUP, None)
    spark.conf.set(_CLEANUP, "true")
    try:
        df.write.parquet(path)
    finally:
        if before is None:
            spark.conf.unset(_CLEANUP)
        else:
            spark.conf.set(_CLEANUP, before)
    return spark.read.schema(df.schema).parquet(path)


_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
#: Tables of the scopes that are open, the innermost last.
_OPEN_SCOPES: list[list[str]] = []


@contextmanager
def scratch_tables(spark: SparkSession) -> Iterator[None]:
    """Tables that ``settle_table`` writes inside are removed at the end, so what is wanted of them must be stored by then.

    For runs on one thread: a scope owns what is written while it is the innermost one.
    """
    made: list[str] = []
    _OPEN_SCOPES.append(made)
    try:
        yield
    finally:
        # By place, since another open scope's list may be equal.
        del _OPEN_SCOPES[next(i for i, held in enumerate(_OPEN_SCOPES) if held is made)]
        jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
        for path in made:
            place = jvm.org.apache.hadoop.fs.Path(path)
            place.getFileSystem(conf).delete(place, True)


def settle_outside(df: DataFrame) -> DataFrame:
    """``settle_table`` for a result that outlives the innermost scope."""
    out = settle_table(df)
    if _OPEN_SCOPES:
        path = _OPEN_SCOPES[-1].pop()
        if len(_OPEN_SCOPES) > 1:
            _OPEN_SCOPES[-2].append(path)
    return out


def attach_row(df: DataFrame, row: DataFrame, name: str = "_p") -> DataFrame:
    """Add a one-row table as a struct column, through a scalar subquery.

    Fitted values reach every row this way without a join and without a collect;
    keeping them in one column means the subquery is planned only once.
    """
    return df.withColumn(name, row.select(F.struct("*")).scalar())


def share(spark: SparkSession, value) -> Broadcast:
    """Broadcast Python objects of this package; read them with ``received``."""
    return spark.sparkContext.broadcast(cloudpickle.dumps(value))


def received(shared: Broadcast):
    return pickle.loads(shared.value)
