"""Session helpers shared by the queries, the command line and the tests."""

from __future__ import annotations

from pathlib import Path

from pyspark.sql import SparkSession

PACKAGE_ROOT = str(Path(__file__).resolve().parent.parent)


def share_package(spark: SparkSession) -> SparkSession:
    """Let Python workers import this package from where the driver has it, where that folder exists for them."""
    env = spark.sparkContext.environment
    paths = [p for p in env.get("PYTHONPATH", "").split(":") if p]
    if PACKAGE_ROOT not in paths:
        env["PYTHONPATH"] = ":".join([PACKAGE_ROOT, *paths])
    return spark


def local_session(name: str = "dialoom", cores: str = "*", shuffle_partitions: int = 8, **conf: str) -> SparkSession:
    builder = SparkSession.builder.master(f"local[{cores}]").appName(name)
    settings = {
        "spark.sql.shuffle.partitions": str(shuffle_partitions),
        "spark.sql.session.timeZone": "UTC",
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
    } | conf
    for k, v in settings.items():
        builder = builder.config(k, v)
    return share_package(builder.getOrCreate())
