"""Tables in the folder that driver and executors share, used to cut lineage between the steps of an operator."""

from __future__ import annotations

import atexit
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

SETTING = "spark.checkpoint.dir"


def shared_dir(spark: SparkSession) -> str:
    """The cluster's shared folder; a temporary one is made and set only where the session names none (local tests)."""
    base = spark.sparkContext.getConf().get(SETTING) or spark.conf.get(SETTING, None)
    if not base:
        master = spark.sparkContext.master
        if not master.startswith("local") or master.startswith("local-cluster"):
            raise ValueError(f"set {SETTING} to a folder that driver and executors share")
        base = "file://" + tempfile.mkdtemp(prefix="helixloom-")
        spark.conf.set(SETTING, base)
    return base.rstrip("/")


#: Settings of a lean write.
LEAN = {"spark.sql.execution.arrow.maxBytesPerBatch": str(8 << 20), "spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true"}


@contextmanager
def settings(spark: SparkSession, values: dict[str, str]) -> Iterator[None]:
    """Session settings that hold inside the block."""
    before = {k: spark.conf.get(k, None) for k in values}
    try:
        for k, v in values.items():
            spark.conf.set(k, v)
        yield
    finally:
        for k, v in before.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


_live: list[SharedTables] = []


class SharedTables:
    """Parquet tables under one fresh folder of the shared folder.

    A lost executor costs only the tasks that read the table again: the files outlive executors. ``drop`` removes
    tables that no later step reads; the rest goes by ``dropped_after``, or when the driver's Python ends.
    """

    def __init__(self, spark: SparkSession, name: str):
        self.spark = spark
        self.root = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
        self.count = 0
        _live.append(self)
        atexit.register(self.close)

    def write(self, df: DataFrame, name: str, lean: bool = False) -> DataFrame:
        """``lean``: for tables of few and long rows. Python gets small batches, and shuffle files go once the table is stored."""
        self.count += 1
        path = f"{self.root}/{self.count:03d}-{name}"
        with settings(self.spark, LEAN if lean else {}):
            df.write.parquet(path)
        table = self.spark.read.schema(df.schema).parquet(path)
        table._shared_path = path
        return table

    def drop(self, *tables: DataFrame) -> None:
        for table in tables:
            self._delete(table._shared_path)

    def _delete(self, path: str) -> None:
        jvm, jsc = self.spark.sparkContext._jvm, self.spark.sparkContext._jsc
        target = jvm.org.apache.hadoop.fs.Path(path)
        target.getFileSystem(jsc.hadoopConfiguration()).delete(target, True)

    def close(self) -> None:
        atexit.unregister(self.close)
        if self in _live:
            _live.remove(self)
        if self.spark.sparkContext._jsc is not None:
            self._delete(self.root)


@contextmanager
def dropped_after() -> Iterator[None]:
    """Removes the tables of all operators that are called inside. Their results are read from these tables, so they must have
    been stored before the block ends."""
    before = list(_live)
    yield
    for store in list(_live):
        if store not in before:
            store.close()
