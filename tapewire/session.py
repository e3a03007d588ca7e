"""Session settings that the operators expect. Any existing session works as well."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
}


def build_session(app: str = "tapewire", **settings: str) -> SparkSession:
    """A session with the shared settings; keyword names use ``__`` for dots."""
    builder = SparkSession.builder.appName(app)
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    for key, value in settings.items():
        name = key.replace("__", ".")
        builder = builder.master(value) if name == "master" else builder.config(name, value)
    return builder.getOrCreate()


def side_session(spark: SparkSession, settings: Mapping[str, str]) -> SparkSession:
    """A session on the same cluster with settings that leave the caller's own alone."""
    side = spark.newSession()
    for key, value in {**SETTINGS, **settings}.items():
        side.conf.set(key, value)
    return side


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder that the cluster names."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        raise ValueError("spark.checkpoint.dir is not set")
    return root.rstrip("/")
