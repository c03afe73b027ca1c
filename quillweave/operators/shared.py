"""The folder that all executors share, and how rows are dealt to tasks."""

from __future__ import annotations

import itertools
import re
import tempfile
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

#: Bytes of input files for a task that sorts or groups what comes of them.
SHARE = 2 << 20
#: Inputs of fewer shares are not dealt.
LEAST = 8


def shared_folder(spark: SparkSession, name: str) -> str:
    """A new folder's name below spark.checkpoint.dir. Where the session names none, it is a temporary one if driver and executors are
    one process; on a cluster that is an error, as no machine-local folder would do."""
    root = spark.sparkContext.getConf().get("spark.checkpoint.dir", None) or spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        root = "file://" + tempfile.mkdtemp(prefix="quillweave-")
    return f"{root.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def kept(spark: SparkSession, name: str) -> Callable[[DataFrame], DataFrame]:
    """A function that works a table out once, into the shared folder, and gives it back to be read again."""
    root, numbers = shared_folder(spark, name), itertools.count()

    def keep(df: DataFrame) -> DataFrame:
        path = f"{root}/{next(numbers)}"
        df.write.parquet(path)
        return spark.read.schema(df.schema).parquet(path)

    return keep


def input_bytes(df: DataFrame) -> int:
    """Bytes of the files that a table is read from, 0 where there are none."""
    jvm, conf = df.sparkSession.sparkContext._jvm, df.sparkSession.sparkContext._jsc.hadoopConfiguration()
    paths = (jvm.org.apache.hadoop.fs.Path(f) for f in df.inputFiles())
    return sum(p.getFileSystem(conf).getFileStatus(p).getLen() for p in paths)


def dealt(df: DataFrame, *keys: str) -> DataFrame:
    """The rows dealt by keys into partitions whose number grows with the input files, and is never below the session's: joins and groups by
    those keys work on them as they lie. Left to itself the engine merges partitions to a size after compression, or to as many as there
    are cores, and one task sorts and groups millions of rows at once. Small inputs are left as they are."""
    n = -(-input_bytes(df) // SHARE)
    return df if n < LEAST else df.repartition(max(n, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))), *keys)
