"""Session settings and the shared scratch folder."""

from __future__ import annotations

import os
import re
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

# Results depend on the first two; the rest keep large, skewed shuffles healthy.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
}

# Column expressions here are large; noting the call site of each part only costs time.
_BUILD_SETTINGS = {"spark.python.sql.dataFrameDebugging.enabled": "false"}

#: Codec of tables and of what is kept between two steps: most of it is hexadecimal text, which other codecs leave as long as it is.
KEPT_COMPRESSION = "zstd"

_local_base: dict[str, str] = {}


def build_session(
    app_name: str = "coinfold", master: str | None = None, conf: dict[str, str] | None = None
) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **_BUILD_SETTINGS, **(conf or {})}.items():
        builder = builder.config(key, value)
    return _with_package(builder.getOrCreate())


def apply_settings(spark: SparkSession) -> SparkSession:
    """Put the settings on a session somebody else built."""
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    return _with_package(spark)


def _with_package(spark: SparkSession) -> SparkSession:
    """Where Python workers run beside the driver they find this package wherever the driver was started.

    On a cluster the package is installed or sent along with the application.
    """
    here = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    paths = spark.sparkContext.environment
    if here not in paths.get("PYTHONPATH", "").split(os.pathsep):
        paths["PYTHONPATH"] = os.pathsep.join(filter(None, [here, paths.get("PYTHONPATH")]))
    return spark


_DROPS_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def dropping_shuffles(spark: SparkSession) -> Iterator[None]:
    """Within it, what a write has shuffled leaves the disk once the write has ended; otherwise it stays until
    the driver happens to collect garbage, and a job of many writes holds them all."""
    before = spark.conf.get(_DROPS_SHUFFLES, None)
    spark.conf.set(_DROPS_SHUFFLES, "true")
    try:
        yield
    finally:
        spark.conf.set(_DROPS_SHUFFLES, before) if before is not None else spark.conf.unset(_DROPS_SHUFFLES)


def shared_dir(spark: SparkSession, name: str) -> str:
    """A new folder below ``spark.checkpoint.dir``.

    A session in one process (tests, a trial) without that setting uses a temporary folder;
    any other session without it is an error, as its executors would not see the same files.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        context = spark.sparkContext
        if not re.fullmatch(r"local(\[[^,\]]*(,\s*\d+)?\])?", context.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors can reach")
        app = context.applicationId
        if app not in _local_base:
            _local_base[app] = tempfile.mkdtemp(prefix="coinfold-")
        base = _local_base[app]
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"
