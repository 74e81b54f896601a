"""Session helpers: reading tables, and intermediate tables in the cluster's shared folder."""

from __future__ import annotations

import atexit
import copy
import shutil
import tempfile
import uuid
from pathlib import Path

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

_LOCAL_ROOT: str | None = None
_SHIPPED: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Sends this package to the Python workers, once per application."""
    sc = spark.sparkContext
    if sc.applicationId in _SHIPPED:
        return
    folder = tempfile.mkdtemp(prefix="parcelight-package-")
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    package = Path(__file__).resolve().parent
    sc.addPyFile(shutil.make_archive(f"{folder}/parcelight-package", "zip", package.parent, package.name))
    _SHIPPED.add(sc.applicationId)


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_root(spark: SparkSession) -> str:
    """The folder that all executors share: spark.checkpoint.dir of the session.

    Only where it is unset and the master is local is a temporary folder made;
    a cluster without the setting is refused, as a machine-local folder would
    lose data there.
    """
    global _LOCAL_ROOT
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    master = spark.conf.get("spark.master", "")
    if not master.startswith("local") or master.startswith("local-cluster"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    if _LOCAL_ROOT is None:
        _LOCAL_ROOT = tempfile.mkdtemp(prefix="parcelight-")
        atexit.register(shutil.rmtree, _LOCAL_ROOT, ignore_errors=True)
    return f"file://{_LOCAL_ROOT}"


def _filesystem(spark: SparkSession, path: str):
    jvm = spark._jvm
    hadoop_path = jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()), hadoop_path


def delete(spark: SparkSession, path: str) -> None:
    fs, p = _filesystem(spark, path)
    fs.delete(p, True)


def exists(spark: SparkSession, path: str) -> bool:
    fs, p = _filesystem(spark, path)
    return fs.exists(p)


def rename(spark: SparkSession, source: str, target: str) -> None:
    fs, p = _filesystem(spark, source)
    if not fs.rename(p, spark._jvm.org.apache.hadoop.fs.Path(target)):
        raise OSError(f"could not rename {source} to {target}")


def listing(spark: SparkSession, path: str) -> list[str]:
    """Names in a folder."""
    fs, p = _filesystem(spark, path)
    return [s.getPath().getName() for s in fs.listStatus(p)]


def folder_bytes(spark: SparkSession, path: str) -> int:
    fs, p = _filesystem(spark, path)
    return int(fs.getContentSummary(p).getLength())


def stored_bytes(df: DataFrame) -> int | None:
    """Bytes of all that a plan reads, before filters and joins; None where a source doesn't tell."""
    leaves = df._jdf.queryExecution().optimizedPlan().collectLeaves()
    sizes = [int(str(leaves.apply(i).stats().sizeInBytes())) for i in range(leaves.size())]
    unknown = int(df.sparkSession.conf.get("spark.sql.defaultSizeInBytes", str(2**63 - 1)).rstrip("b"))
    return None if any(s >= unknown for s in sizes) else sum(sizes)


class Workspace:
    """A folder of written tables under the shared folder.

    A written table cuts the lineage and survives the loss of executors.
    Tables that nothing reads any more are dropped by name; what is left goes
    when the driver ends, so results that read from them stay valid till then.
    """

    def __init__(self, spark: SparkSession, label: str):
        ship(spark)
        self.spark = spark
        self.root = f"{shared_root(spark)}/parcelight/{label}-{uuid.uuid4().hex}"
        atexit.register(self._close)

    def part(self, name: str) -> Workspace:
        """A subfolder, for an operator that is used more than once."""
        part = copy.copy(self)
        part.root = f"{self.root}/{name}"
        return part

    def path(self, name: str) -> str:
        return f"{self.root}/{name}"

    def write(self, df: DataFrame, name: str) -> DataFrame:
        df.write.mode("overwrite").parquet(self.path(name))
        return self.spark.read.schema(df.schema).parquet(self.path(name))

    def write_counting(self, df: DataFrame, name: str, condition: str) -> tuple[DataFrame, int]:
        """Writes a table and counts, on the way, the rows that meet a condition.

        A repeated task may count its rows again, so only 0 is an exact number.
        """
        seen = Observation()
        df.observe(seen, F.count_if(F.expr(condition)).alias("n")).write.mode("overwrite").parquet(self.path(name))
        return self.spark.read.schema(df.schema).parquet(self.path(name)), seen.get["n"]

    def drop(self, *names: str) -> None:
        for name in names:
            delete(self.spark, self.path(name))

    def _close(self) -> None:
        try:
            delete(self.spark, self.root)
        except Exception:  # the session is gone already
            pass
