"""Session settings the plans rely on, and the shared scratch folder."""

from __future__ import annotations

import re
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

PLAN_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Sides up to this size are broadcast, by file statistics or as measured at run time.
    "spark.sql.autoBroadcastJoinThreshold": "64m",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "64m",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.sql.optimizer.runtime.bloomFilter.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # Recording the Python line of every column costs about a third of plan building.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


def build_session(
    app_name: str = "ledgerloom",
    master: str | None = None,
    shuffle_partitions: int | None = None,
    **settings: str,
) -> SparkSession:
    """A session with the plan settings applied.

    ``shuffle_partitions`` is the *initial* number; adaptive execution coalesces
    it, so on a cluster set it high (2-3 times the total cores) and leave it.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    merged = {**PLAN_SETTINGS, **settings}
    if shuffle_partitions:
        merged["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    for name, value in merged.items():
        builder = builder.config(name, value)
    return builder.getOrCreate()


@contextmanager
def set_for(spark: SparkSession, settings: dict[str, str]) -> Iterator[None]:
    """Session settings for the actions inside the block; afterwards they are as before."""
    before = {name: spark.conf.get(name, None) for name in settings}
    try:
        for name, value in settings.items():
            spark.conf.set(name, value)
        yield
    finally:
        for name, value in before.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)


def shared_folder(master: str, checkpoint_dir: str | None, warehouse_dir: str) -> str:
    """A folder that driver and executors share.

    The one that ``spark.checkpoint.dir`` names is taken at its word.  Without it the warehouse folder serves, but off the driver's
    machine only if its address names a store: executors write ``file:`` paths to disks of their own, so such a path is refused.
    """
    if checkpoint_dir:
        return checkpoint_dir
    one_machine = re.fullmatch(r"local(\[.*\])?", master)
    if not one_machine and (warehouse_dir.startswith("file:") or ":" not in warehouse_dir):
        raise ValueError(f"{warehouse_dir!r} is a folder of one machine's own under master {master!r}: set spark.checkpoint.dir to a shared one")
    return warehouse_dir


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh folder name below the place that driver and executors share (:func:`shared_folder`).

    What is written there is for the run alone.  It is left behind, as lost executors may read it until the job's last action;
    whoever owns the folder removes it, by age.
    """
    conf = spark.conf
    shared = shared_folder(
        conf.get("spark.master", "local"), conf.get("spark.checkpoint.dir", None), conf.get("spark.sql.warehouse.dir")
    )
    return f"{shared.rstrip('/')}/{label}-{uuid.uuid4().hex}"
