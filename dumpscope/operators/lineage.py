"""Cutting lineage through the shared checkpoint folder."""

import tempfile

from pyspark.sql import DataFrame


def checkpointed(df: DataFrame) -> DataFrame:
    """The rows written to the checkpoint folder and read back, so that they are computed once.

    The folder is the one the session names in ``spark.checkpoint.dir``. Only a local session that
    names none, as in tests, gets a temporary one.
    """
    context = df.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        folder = df.sparkSession.conf.get("spark.checkpoint.dir", None)
        if folder is None:
            if not context.master.startswith("local"):
                raise ValueError("set spark.checkpoint.dir to a folder all executors share")
            folder = tempfile.mkdtemp(prefix="dumpscope-checkpoint-")
        context.setCheckpointDir(folder)
    return df.checkpoint()
