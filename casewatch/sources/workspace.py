"""Shared working folder: staged tables and streaming checkpoints live here.

A staged table cuts the lineage in front of a branch that is read more than once.
It survives the loss of an executor, unlike cached blocks that are only local.
"""

import tempfile
import uuid

CHECKPOINT_DIR = "spark.checkpoint.dir"


def work_dir(spark):
    """The cluster's shared folder; a temporary one only in local mode."""
    folder = spark.conf.get(CHECKPOINT_DIR, None)
    if folder:
        return folder.rstrip("/")
    context = spark.sparkContext
    existing = context.getCheckpointDir()
    if existing:
        return existing.rstrip("/")
    if not context.master.startswith("local"):
        raise RuntimeError(f"set {CHECKPOINT_DIR} to a folder that every executor can reach")
    context.setCheckpointDir(tempfile.mkdtemp(prefix="casewatch-"))
    return context.getCheckpointDir().rstrip("/")


def fresh_path(spark, name):
    return f"{work_dir(spark)}/{name}-{uuid.uuid4().hex}"


def staged(df, name):
    """Write df once to the shared folder and return a scan of the written table."""
    spark = df.sparkSession
    path = fresh_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
