"""Session construction and shared scratch tables."""

from __future__ import annotations

import os
import re
import tempfile
import uuid
import zipfile
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

_OWN_DIRS: dict[str, str] = {}
_SHIPPED: set[str] = set()
_SCOPE: ContextVar[list[DataFrame] | None] = ContextVar("lexispark_scope", default=None)


def local_session(cores: str = "*", shuffle_partitions: int = 8, memory: str = "12g") -> SparkSession:
    """A local session as the tests and the bench use it; a cluster brings its own."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("lexispark")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", memory)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.ui.retainedExecutions", "20")
        .config("spark.ui.retainedJobs", "50")
        .config("spark.ui.retainedStages", "50")
        .getOrCreate()
    )


def scratch_dir(spark: SparkSession) -> str:
    """The shared folder of the cluster (spark.checkpoint.dir).

    Where neither the session nor the context names one, a local master gets a folder of its own (tests); any other
    master is refused, as its executors share no local folder.
    """
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if named:
        return named
    if not (spark.sparkContext.master == "local" or spark.sparkContext.master.startswith("local[")):
        raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    app = spark.sparkContext.applicationId
    if app not in _OWN_DIRS:
        _OWN_DIRS[app] = "file://" + tempfile.mkdtemp(prefix="lexispark-")
    return _OWN_DIRS[app]


def ship(spark: SparkSession) -> None:
    """Give the executors this package, once per application: their workers may start where it can't be imported."""
    app = spark.sparkContext.applicationId
    if app in _SHIPPED:
        return
    _SHIPPED.add(app)
    root = Path(__file__).parent
    archive = Path(tempfile.mkdtemp(prefix="lexispark-")) / f"lexispark-{uuid.uuid4().hex}.zip"
    with zipfile.ZipFile(archive, "w", zipfile.ZIP_DEFLATED) as z:
        for f in sorted(root.rglob("*.py")):
            z.write(f, f.relative_to(root.parent))
    spark.sparkContext.addPyFile(str(archive))


def _hadoop_path(spark: SparkSession, path: str):
    found = spark._jvm.org.apache.hadoop.fs.Path(path)
    return found.getFileSystem(spark._jsc.hadoopConfiguration()), found


def scratch_table(df: DataFrame, name: str, keep: bool = False) -> DataFrame:
    """Cut the lineage of df: write it once below the shared folder and read it back.

    The files outlive any executor, so a later stage never recomputes what stands above. They are deleted when the
    innermost scratch_scope ends (with keep: when the one around it ends), by drop_scratch, or at the end of the application.
    """
    spark = df.sparkSession
    ship(spark)
    path = f"{scratch_dir(spark).rstrip('/')}/lexispark/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    fs, found = _hadoop_path(spark, path)
    fs.deleteOnExit(found)
    out = spark.read.schema(df.schema).parquet(path)
    out._lexispark_path = path
    out._lexispark_keep = keep
    scope = _SCOPE.get()
    if scope is not None:
        scope.append(out)
    return out


@contextmanager
def scratch_scope() -> Iterator[None]:
    """Drop the scratch tables that are made inside, but for kept ones, when the scope ends.

    Results of operators are read lazily: whoever opens a scope writes the result inside it.
    """
    outer, made = _SCOPE.get(), []
    token = _SCOPE.set(made)
    try:
        yield
    finally:
        _SCOPE.reset(token)
        for df in made:
            if df._lexispark_keep:
                df._lexispark_keep = False
                if outer is not None:
                    outer.append(df)
            else:
                drop_scratch(df)


def drop_scratch(df: DataFrame) -> None:
    """Delete the files of a scratch table that nothing will read again."""
    path = getattr(df, "_lexispark_path", None)
    if path:
        fs, found = _hadoop_path(df.sparkSession, path)
        fs.delete(found, True)
        fs.cancelDeleteOnExit(found)


#: Bytes of rows that bounded_batches lets a Python worker get at once.
BATCH_BYTES = 4 << 20
_BATCH_SETTING = "spark.sql.execution.arrow.maxBytesPerBatch"


def bounded_batches(spark: SparkSession, most: int = BATCH_BYTES) -> None:
    """From now on the session sends Python workers batches of about so many bytes; a lower setting stays, and a row is never cut.

    A batch stands in the executor's native memory and in the worker, for every running task. Spark reads the setting when a query is planned, which for a lazy result is
    when its user writes it: it can't be put back before. kept_batches puts it back where all results stand.
    """
    number, unit = re.fullmatch(r"(\d+)([bkmgt]?)b?", spark.conf.get(_BATCH_SETTING).lower()).groups()
    if int(number) << 10 * "bkmgt".index(unit or "b") > most:
        spark.conf.set(_BATCH_SETTING, f"{most}b")


@contextmanager
def kept_batches(spark: SparkSession) -> Iterator[None]:
    """What bounded_batches sets inside is put back at the end."""
    before = spark.conf.get(_BATCH_SETTING)
    try:
        yield
    finally:
        spark.conf.set(_BATCH_SETTING, before)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship(spark)
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))
