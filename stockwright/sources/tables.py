"""Reading, writing and staging tables."""

from __future__ import annotations

import atexit
import contextlib
import shutil
import tempfile
import threading
import uuid
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession

# Columns of the stored base tables.
SCHEMAS = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "orders": (
        "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
        "o_orderdate timestamp_ntz, o_orderpriority string"
    ),
    "lineitem": (
        "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
        "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string, "
        "l_shipdate timestamp_ntz"
    ),
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
}

# Names what one run of the program stages, so that it can be dropped as a whole.
_RUN = f"stockwright-{uuid.uuid4().hex}"
_local_folder: str | None = None
# Folders staged inside ``recorded_stages``, by thread.
_scope = threading.local()


def read_table(spark: SparkSession, directory: str, name: str) -> DataFrame:
    return spark.read.schema(SCHEMAS[name]).parquet(f"{directory}/{name}.parquet")


def load_tables(spark: SparkSession, directory: str) -> dict[str, DataFrame]:
    return {name: read_table(spark, directory, name) for name in SCHEMAS}


def append_rows(rows: DataFrame, path: str) -> None:
    """Add rows to a stored table."""
    rows.write.mode("append").parquet(path)


def write_snapshot(rows: DataFrame, path: str) -> None:
    """Write a new version of a table; a version is never rewritten in place."""
    rows.write.mode("errorifexists").parquet(path)


def shared_folder(spark: SparkSession) -> str:
    """Folder every executor can reach, named by the cluster in ``spark.checkpoint.dir``.

    A process-private temporary folder stands in for it on a local master only.
    """
    global _local_folder
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("spark.checkpoint.dir must name a shared folder on a cluster")
    if _local_folder is None:
        _local_folder = tempfile.mkdtemp(prefix="stockwright-")
        atexit.register(shutil.rmtree, _local_folder, ignore_errors=True)
    return _local_folder


def new_folder(spark: SparkSession, purpose: str) -> str:
    return f"{shared_folder(spark)}/{_RUN}/{purpose}-{uuid.uuid4().hex}"


def drop_staged(spark: SparkSession) -> None:
    """Deletes what this run has staged; for the end of a job, when all results are written."""
    _delete(spark, f"{shared_folder(spark)}/{_RUN}")


def _delete(spark: SparkSession, path: str) -> None:
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)


@contextlib.contextmanager
def recorded_stages() -> Iterator[list[str]]:
    """The folders of what this thread stages inside, for a job that knows when their last reader is done."""
    outer, _scope.paths = getattr(_scope, "paths", None), []
    try:
        yield _scope.paths
    finally:
        if outer is not None:
            outer += _scope.paths
        _scope.paths = outer


@contextlib.contextmanager
def temporary_stages(spark: SparkSession) -> Iterator[None]:
    """What is staged inside is deleted at the end, also after an error."""
    with recorded_stages() as paths:
        try:
            yield
        finally:
            delete_stages(spark, paths)


def delete_stages(spark: SparkSession, paths: list[str]) -> None:
    for path in paths:
        _delete(spark, path)


def stage(rows: DataFrame, purpose: str = "stage") -> DataFrame:
    """Write rows to the shared folder and read them back.

    Cuts the lineage, survives the loss of executors, and fixes values such as partition numbers that
    a recomputation could change. Columnar, so later readers only fetch the columns they use.
    """
    spark = rows.sparkSession
    path = new_folder(spark, purpose)
    if getattr(_scope, "paths", None) is not None:
        _scope.paths.append(path)
    rows.write.parquet(path)
    return spark.read.schema(rows.schema).parquet(path)
