"""The parquet tables of one data directory, and the folder which all executors share."""

from __future__ import annotations

import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession


def ship(spark: SparkSession) -> None:
    """Sends this package to the executors of the session, once, so that their Python workers can import it."""
    sc = spark.sparkContext
    if getattr(sc, "_vellumine_shipped", False):
        return
    root = Path(__file__).resolve().parents[1]
    path = Path(tempfile.mkdtemp(prefix="vellumine-")) / f"{root.name}.zip"  # of the driver alone; Spark serves it
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as z:
        for file in sorted(root.rglob("*.py")):
            z.write(file, file.relative_to(root.parent))
    sc.addPyFile(str(path))
    sc._vellumine_shipped = True


def table(spark: SparkSession, sf_dir: str, name: str, columns: list[str] | None = None) -> DataFrame:
    """The table *name* of *sf_dir*; only *columns* if given, so that the scan is pruned."""
    ship(spark)
    df = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    return df.select(*columns) if columns else df


def shared_dir(spark: SparkSession, local_default: str = "/tmp/vellumine-checkpoints") -> str:
    """The folder named by spark.checkpoint.dir, which every executor reaches.

    On a cluster it has to be set. Only where it is unset, as in tests on one machine, *local_default* is taken.
    """
    jsc = spark.sparkContext._jsc.sc()
    if jsc.getCheckpointDir().isDefined():
        return jsc.getCheckpointDir().get()
    path = spark.conf.get("spark.checkpoint.dir", None)
    if not path:
        if not (spark.sparkContext.master == "local" or spark.sparkContext.master.startswith("local[")):
            raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
        path = local_default
    spark.sparkContext.setCheckpointDir(path)
    return path


def settled(df: DataFrame, spark: SparkSession | None = None, columns: list[str] | None = None) -> DataFrame:
    """*df* written to the shared folder and read again: its lineage is cut, and an executor may be lost.

    The table is parquet, so later reads are pruned by column; it counts as disk until the folder is cleaned.
    """
    spark = spark or df.sparkSession
    df = df.select(*columns) if columns else df
    path = f"{shared_dir(spark).rstrip('/')}/vellumine-{uuid.uuid4().hex}"
    df.write.parquet(path)
    vars(spark.sparkContext).setdefault("_vellumine_settled", []).append(path)
    return spark.read.schema(df.schema).parquet(path)


def sweep(spark: SparkSession) -> int:
    """Deletes the tables that ``settled`` wrote in this session, once their results are no longer read; gives their number."""
    paths = getattr(spark.sparkContext, "_vellumine_settled", [])
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    for path in paths:
        where = jvm.org.apache.hadoop.fs.Path(path)
        where.getFileSystem(conf).delete(where, True)
    spark.sparkContext._vellumine_settled = []
    return len(paths)
