"""Session defaults and the shared scratch / checkpoint location.

Scale notes
-----------
* AQE is on: it coalesces small shuffle partitions, switches sort-merge joins
  to broadcast joins when a side is measured small at runtime (a checked size,
  not a guess), and splits skewed join partitions.
* Lineage is cut only with ``DataFrame.checkpoint()`` into the folder the
  cluster names in ``spark.checkpoint.dir``. We read that setting and set our
  own folder only when it is unset (local runs and tests).
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def get_session(master: str | None = None, partitions: int | None = None,
                app: str = "tessera", extra: dict | None = None) -> SparkSession:
    """Build (or reuse) a session with the defaults above.

    ``partitions`` sets ``spark.sql.shuffle.partitions``; on a cluster leave it
    to the cluster config and let AQE coalesce.
    """
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    for k, v in DEFAULTS.items():
        b = b.config(k, v)
    if partitions:
        b = b.config("spark.sql.shuffle.partitions", str(partitions))
    for k, v in (extra or {}).items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder; create a local one only if unset."""
    sc = spark.sparkContext
    d = sc.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if not d:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
        d = tempfile.mkdtemp(prefix="tessera-ckpt-")
        try:
            spark.conf.set("spark.checkpoint.dir", d)
        except Exception:  # noqa: BLE001 - some deployments reject runtime core confs
            pass
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(d)
    return d


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path under the shared checkpoint folder (never machine-local
    on a cluster, because that folder is the cluster's shared one)."""
    # the writers create the path; the base may be a URI (file:, hdfs:, s3a:, ...)
    base = ensure_checkpoint_dir(spark)
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex[:12]}"


_SHIPPED: set[int] = set()


def ship_package(spark: SparkSession) -> None:
    """Make ``tessera`` importable in Python workers (pandas UDFs,
    ``mapInPandas``), as ``--py-files`` would: the package is zipped once per
    driver process and added with ``SparkContext.addPyFile``, which serves it
    to every executor. The zip is a driver-side artifact; executors never
    read it from a local path."""
    import zipfile

    sc = spark.sparkContext
    key = id(sc._jsc)
    if key in _SHIPPED:
        return
    import tessera

    pkg = os.path.dirname(os.path.abspath(tessera.__file__))
    root = os.path.dirname(pkg)
    path = os.path.join(tempfile.mkdtemp(prefix="tessera-pkg-"), "tessera.zip")
    with zipfile.ZipFile(path, "w") as z:
        for dirpath, dirs, files in os.walk(pkg):
            dirs[:] = [d for d in dirs if d != "__pycache__"]
            for f in files:
                if f.endswith(".py"):
                    full = os.path.join(dirpath, f)
                    z.write(full, os.path.relpath(full, root))
    sc.addPyFile(path)
    _SHIPPED.add(key)


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint (survives executor loss; never localCheckpoint)."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)
