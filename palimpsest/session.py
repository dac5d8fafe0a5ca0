"""Session helpers: table access, lineage cuts, shipping the package to executors."""

from __future__ import annotations

import hashlib
import io
import os
import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

_SHIPPED = "palimpsest.shipped"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Read one of the input tables (file or folder of Parquet files)."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _temporary(spark: SparkSession, prefix: str) -> str:
    """A folder of this machine, which only a local session may use."""
    if not spark.sparkContext.master.startswith("local") or spark.sparkContext.master.startswith("local-cluster"):
        raise ValueError("name a folder that all executors share in spark.checkpoint.dir")
    return tempfile.mkdtemp(prefix=prefix)


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder; a temporary one only where none is named (tests)."""
    sc = spark.sparkContext
    named = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir")
    if sc._jsc.sc().getCheckpointDir().isEmpty():
        sc.setCheckpointDir(named or _temporary(spark, "palimpsest-ckpt-"))
    return named or sc._jsc.sc().getCheckpointDir().get()


def checkpoint(df: DataFrame) -> DataFrame:
    """Cut lineage through a reliable checkpoint in the shared folder."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def _place(spark: SparkSession, data: bytes) -> str:
    """Put the package where the executors can fetch it: the shared folder, or a temporary one where none is named."""
    name = f"palimpsest_src_{hashlib.sha1(data).hexdigest()[:12]}.zip"
    named = spark.conf.get("spark.checkpoint.dir", None)
    if not named:
        target = os.path.join(_temporary(spark, "palimpsest-src-"), name)
        Path(target).write_bytes(data)
        return target
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(f"{named.rstrip('/')}/{name}")
    out = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).create(path, True)
    try:
        out.write(data)
    finally:
        out.close()
    return path.toString()


def ship_package(spark: SparkSession) -> None:
    """Send this package's source to the executors once per session.

    Python workers then import it wherever they run, whether or not the
    repository is on their own path.
    """
    sc = spark.sparkContext
    if getattr(sc, "_palimpsest_shipped", False):
        return
    root = Path(__file__).resolve().parent
    data = io.BytesIO()
    with zipfile.ZipFile(data, "w", zipfile.ZIP_DEFLATED) as z:
        for p in sorted(root.rglob("*.py")):
            z.write(p, str(p.relative_to(root.parent)))
    sc.addPyFile(_place(spark, data.getvalue()))
    sc._palimpsest_shipped = True
