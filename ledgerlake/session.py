"""Session-level helpers: the shared scratch folder and required settings.

The library never creates a session or sets a master. Jobs that must cut
lineage or stage files write under the folder the cluster names in
``spark.checkpoint.dir``; only when that is unset in local mode (tests, a
laptop) is a private folder chosen and registered. On a cluster an unset
folder is an error.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

_LOCAL_ROOTS: dict[int, str] = {}


def ensure_utc(spark: SparkSession) -> None:
    """Event times are interpreted and partitioned in UTC."""
    if spark.conf.get("spark.sql.session.timeZone", "UTC") != "UTC":
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def require_utc(spark: SparkSession) -> None:
    """Jobs partition by UTC days; a session in another zone would write local days."""
    zone = spark.conf.get("spark.sql.session.timeZone")
    if zone not in ("UTC", "Etc/UTC", "Z", "+00:00", "GMT"):
        raise ValueError(f"the session time zone must be UTC (spark.sql.session.timeZone), not {zone}")


def scratch_root(spark: SparkSession) -> str:
    """The shared checkpoint folder of the cluster (or a private one if unset)."""
    root = spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    if not root:
        try:
            root = spark.conf.get("spark.checkpoint.dir")
        except Exception:  # noqa: BLE001 - unset static conf
            root = None
    if root:
        return root.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        # A machine-local folder is invisible to other executors and lost
        # with its machine: on a cluster the shared folder must be named.
        raise RuntimeError("set spark.checkpoint.dir to a folder on shared storage (e.g. HDFS, S3, ABFS)")
    key = id(spark.sparkContext)
    if key not in _LOCAL_ROOTS:
        _LOCAL_ROOTS[key] = tempfile.mkdtemp(prefix="ledgerlake-")
        spark.sparkContext.setCheckpointDir(_LOCAL_ROOTS[key] + "/rdd")
    return _LOCAL_ROOTS[key]


def new_run_dir(spark: SparkSession, name: str) -> str:
    """A fresh folder (path only; Spark writers create it) for one run."""
    return f"{scratch_root(spark)}/ledgerlake/{name}-{uuid.uuid4().hex[:12]}"


def write_scratch_table(df, name: str):
    """Compute ``df`` once into a Parquet table under the shared scratch
    folder and return a DataFrame reading it back.

    Used for small intermediate results that are both counted (to prove a
    broadcast bound) and joined: the second use reads the table instead of
    recomputing its input, and the table survives the loss of an executor
    (a cached copy would be recomputed).
    """
    path = new_run_dir(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)
