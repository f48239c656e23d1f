"""Session defaults and the shared scratch folder."""

from __future__ import annotations

import tempfile
import threading
import uuid
from collections import Counter
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.timestampType": "TIMESTAMP_NTZ",
}


def local_session(cores: int | str = "*", memory: str = "12g", app: str = "stocktide", **extra: str) -> SparkSession:
    """A local session for tests and benchmarks; a cluster brings its own."""
    builder = SparkSession.builder.master(f"local[{cores}]").appName(app)
    settings = {
        **DEFAULTS,
        "spark.driver.memory": memory,
        "spark.sql.shuffle.partitions": "8",
        "spark.ui.enabled": "false",
        **extra,
    }
    for name, value in settings.items():
        builder = builder.config(name, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


RELEASE = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_releasing, _lock = Counter(), threading.Lock()


@contextmanager
def releasing(spark: SparkSession) -> Iterator[None]:
    """Shuffle files of the jobs inside go as soon as each job is over, not when the driver happens to collect its garbage.

    For jobs whose result is stored or small: steps that follow each other then need disk for one step, not for all. Jobs
    of several threads may be inside at once; the last one out puts the session's own setting back.
    """
    session = spark._jsparkSession.sessionUUID()
    with _lock:
        if not _releasing[session]:
            _releasing[session, "before"] = spark.conf.get(RELEASE, None)
            spark.conf.set(RELEASE, "true")
        _releasing[session] += 1
    try:
        yield
    finally:
        with _lock:
            _releasing[session] -= 1
            if not _releasing[session]:
                before = _releasing.pop((session, "before"))
                del _releasing[session]
                spark.conf.unset(RELEASE) if before is None else spark.conf.set(RELEASE, before)


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh folder name in the shared folder the cluster names in ``spark.checkpoint.dir``.

    A machine-local folder is used only where that setting is absent, which is the case in local tests.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if shared is None:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder every executor can reach")
        shared = tempfile.mkdtemp(prefix="stocktide-")
    return f"{shared.rstrip('/')}/{label}-{uuid.uuid4().hex}"
