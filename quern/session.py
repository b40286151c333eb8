"""Sessions, table access and shared scratch tables."""

from __future__ import annotations

import atexit
import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_own_dir: list[str] = []
_scratch: dict[str, str] = {}


def get_session(app: str = "quern", master: str | None = None, **conf: str) -> SparkSession:
    """A session in UTC with adaptive execution; `master` only where the submitter set none."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {"spark.sql.session.timeZone": "UTC", "spark.sql.adaptive.enabled": "true", "spark.sql.adaptive.skewJoin.enabled": "true"}
    for key, value in {**settings, **{k.replace("__", "."): v for k, v in conf.items()}}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the driver's parquet tables."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder named by spark.checkpoint.dir. Where that is unset, a temporary one for a single local process (tests); a
    cluster must name a folder that all of it sees."""
    found = spark.conf.get("spark.checkpoint.dir", None)
    if found:
        return found.rstrip("/")
    if not re.match(r"local(\[|$)", spark.sparkContext.master):
        raise RuntimeError("spark.checkpoint.dir isn't set: a cluster needs a folder shared by driver and executors")
    if not _own_dir:
        _own_dir.append(tempfile.mkdtemp(prefix="quern-"))
    spark.sparkContext.setCheckpointDir(_own_dir[0])
    return _own_dir[0]


def _remove(spark: SparkSession, path: str) -> None:
    jvm = spark.sparkContext._jvm
    if jvm is None or spark.sparkContext._jsc is None:
        return
    p = jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


def written(df: DataFrame, label: str) -> DataFrame:
    """`df` written once as a Parquet table in the shared folder and read back: lineage ends there,
    and any executor can read it after another is lost. Removed by dropped() or when the interpreter ends."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/quern-{label}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    _scratch[path] = out._scratch_path = path
    return out


def dropped(*tables: DataFrame) -> None:
    """Removes tables of written() that nothing reads any more: all that came of them must be written itself."""
    for df in tables:
        if path := _scratch.pop(getattr(df, "_scratch_path", None), None):
            _remove(df.sparkSession, path)


@atexit.register
def _drop_all() -> None:
    spark = SparkSession.getActiveSession() if _scratch else None
    for path in list(_scratch):
        try:
            _remove(spark, path)
        except Exception:  # the session has ended before the interpreter
            break
