"""Session helpers."""

from __future__ import annotations

import os
import re
import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession


#: Bounds of the batches that Python workers get, unless the session sets its own: whole texts can be long.
BATCHES = {"spark.sql.execution.arrow.maxRecordsPerBatch": ("10000", "2000"), "spark.sql.execution.arrow.maxBytesPerBatch": (None, str(16 << 20))}


def ship(spark: SparkSession) -> SparkSession:
    """Make this package importable in Python workers, once per context, wherever the driver runs, and bound their batches."""
    sc = spark.sparkContext
    set_by_user = sc.getConf()
    for key, (usual, bound) in BATCHES.items():
        if not set_by_user.contains(key) and spark.conf.get(key, usual) in (usual, None, "-1", "268435456", "9223372036854775807"):
            spark.conf.set(key, bound)
    if getattr(sc, "_scriptorium_shipped", False):
        return spark
    root = Path(__file__).resolve().parent
    fd, path = tempfile.mkstemp(prefix="scriptorium-", suffix=".zip")
    with os.fdopen(fd, "wb") as raw, zipfile.ZipFile(raw, "w") as z:
        for p in sorted(root.rglob("*.py")):
            z.write(p, p.relative_to(root.parent))
    sc.addPyFile(path)
    sc._scriptorium_shipped = True
    return spark


def scratch(spark: SparkSession, label: str) -> str:
    """A new path in the folder that all executors share (spark.checkpoint.dir); a temporary one only for a local master."""
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not base:
        given = spark.sparkContext._jsc.sc().getCheckpointDir()
        base = given.get() if given.isDefined() else None
    if not base:
        if not re.fullmatch(r"local(\[[^\]]*\])?", spark.sparkContext.master):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        spark.sparkContext.setCheckpointDir("file://" + tempfile.mkdtemp(prefix="scriptorium-"))
        base = spark.sparkContext._jsc.sc().getCheckpointDir().get()
    return f"{base.rstrip('/')}/{label}-{uuid.uuid4().hex}"


def local_session(cpus: int | str = "*", partitions: int = 8) -> SparkSession:
    """A local session for tests and benchmarks."""
    return (
        SparkSession.builder.master(f"local[{cpus}]")
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )
