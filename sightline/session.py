"""Session settings and the scratch folder shared by the cluster."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

#: Settings every job of this package relies on. All of them are Spark's own.
RUNTIME_CONF = {
    # Event times are epoch seconds in UTC; formatting must not depend on the host.
    "spark.sql.session.timeZone": "UTC",
    # Size-checked broadcasts, skew splitting and partition coalescing at run time.
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    # Lookups by name ask a scan for up to so many keys, each of which its statistics are held against.
    "spark.sql.parquet.pushdown.inFilterThreshold": "1024",
}


def build(app: str = "sightline", master: str | None = None, **conf: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**RUNTIME_CONF, **conf}.items():
        builder = builder.config(key, value)
    return ship(builder.getOrCreate())


def prepare(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to a session someone else has built."""
    for key, value in RUNTIME_CONF.items():
        spark.conf.set(key, value)
    return ship(spark)


def ship(spark: SparkSession) -> SparkSession:
    """Give the Python workers this package, once per application.

    Functions travel to them by the name of their module, and what the driver can import they
    cannot. The driver hands the archive out itself; workers need no folder in common with it.
    """
    context, package = spark.sparkContext, os.path.dirname(os.path.abspath(__file__))
    if not getattr(context, "_sightline_shipped", False) and os.path.isdir(package):
        archive = os.path.join(tempfile.mkdtemp(prefix="sightline-"), "sightline.zip")
        with zipfile.ZipFile(archive, "w", zipfile.ZIP_DEFLATED) as made:
            for folder, _, files in os.walk(package):
                for name in files:
                    if name.endswith(".py"):
                        path = os.path.join(folder, name)
                        made.write(path, os.path.relpath(path, os.path.dirname(package)))
        context.addPyFile(archive)
        context._sightline_shipped = True
    return spark


def is_local(spark: SparkSession) -> bool:
    """Whether driver and executors are one process, so that its temporary folder is shared."""
    master = spark.sparkContext.master
    return master == "local" or master.startswith("local[")


def shared_root(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``, which all executors can reach.

    Only a local session without that setting, as in a test, gets a temporary folder, once. On a
    cluster executors would write to folders of their own, and reading back would miss files.
    """
    context = spark.sparkContext
    named = spark.conf.get("spark.checkpoint.dir", None)
    if context.getCheckpointDir() is None:
        if not named and not is_local(spark):
            raise RuntimeError("set spark.checkpoint.dir to a folder that driver and executors share")
        context.setCheckpointDir(named or tempfile.mkdtemp(prefix="sightline-"))
    return named or context.getCheckpointDir()


def scratch_path(spark: SparkSession, label: str) -> str:
    """A path below the shared folder that no other run uses."""
    path = f"{shared_root(spark).rstrip('/')}/sightline/{label}-{uuid.uuid4().hex}"
    if _noted:
        _noted[-1].append(path)
    return path


_noted: list[list[str]] = []


@contextmanager
def noting() -> Iterator[list[str]]:
    """The scratch paths handed out within the block, for whoever removes them afterwards."""
    _noted.append([])
    try:
        yield _noted[-1]
    finally:
        inner = _noted.pop()
        if _noted:
            _noted[-1].extend(inner)
