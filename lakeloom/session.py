"""Session settings and the shared folder for intermediate tables."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid

from pyspark.sql import SparkSession

_local_base: dict[str, str] = {}


def build_session(app: str = "lakeloom", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings the operators assume.

    Shuffle partitions are left to the cluster's default (AQE coalesces them);
    pass ``spark.sql.shuffle.partitions`` to change it.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        # split a hot join key even where that costs another shuffle later
        "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
        "spark.sql.streaming.stateStore.providerClass":
            "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
        **conf,
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def scratch_dir(spark: SparkSession, name: str) -> str:
    """A fresh folder for a written table, below the cluster's shared folder.

    The base is ``spark.checkpoint.dir``. Only a local-mode session without
    that setting (tests) falls back to a temporary folder; on a cluster a
    machine-local folder would be lost with its machine, so that is an error.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        context = spark.sparkContext
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        app = context.applicationId
        if app not in _local_base:
            _local_base[app] = tempfile.mkdtemp(prefix="lakeloom-")
            atexit.register(shutil.rmtree, _local_base[app], ignore_errors=True)  # made here, so removed here
        base = _local_base[app]
    return f"{base.rstrip('/')}/lakeloom/{name}-{uuid.uuid4().hex[:12]}"


def scratch_database(spark: SparkSession) -> str:
    """A fresh database whose managed tables lie in the shared folder."""
    name = f"lakeloom_{uuid.uuid4().hex[:12]}"
    spark.sql(f"CREATE DATABASE {name} LOCATION '{scratch_dir(spark, name)}'")
    return name


def view_name(prefix: str) -> str:
    """A temp-view name no other call uses."""
    return f"{prefix}_{uuid.uuid4().hex[:12]}"
