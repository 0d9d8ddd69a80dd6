"""Tables written between the steps of a flow.

A staged table cuts the lineage and survives the loss of executors. It lives under the shared folder that the
session names in ``spark.checkpoint.dir``. A local session without that setting, whose driver and executors are one
process, gets a temporary folder; on a cluster the setting is required. ``drop_staged`` ends the staged tables of an
application.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Sequence

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

_local_roots: dict[str, str] = {}


def staging_root(spark: SparkSession) -> str:
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root.rstrip("/")
    app = spark.sparkContext.applicationId
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    if app not in _local_roots:
        _local_roots[app] = tempfile.mkdtemp(prefix="callwise-")
    return _local_roots[app]


def fresh_path(spark: SparkSession, name: str) -> str:
    """A path nobody has used: below the root, the application id and a random suffix."""
    return f"{staging_root(spark)}/callwise/{spark.sparkContext.applicationId}/{name}-{uuid.uuid4().hex}"


PIN_ROWS = 100_000


def pin(df: DataFrame) -> DataFrame:
    """Fetch a table of statistics (one row per column, class or group) and hand it back as a local relation.

    What refers to it many times then costs one pass over the data. The row count is checked.
    """
    table = df.limit(PIN_ROWS + 1).toArrow()
    if table.num_rows > PIN_ROWS:
        raise ValueError(f"over {PIN_ROWS} rows: stage this table instead")
    return df.sparkSession.createDataFrame(table, df.schema)


def hold(df: DataFrame, name: str) -> DataFrame:
    """A table of statistics to be read many times: a local relation if it is small, a staged table otherwise."""
    table = df.limit(PIN_ROWS + 1).toArrow()
    return stage(df, name) if table.num_rows > PIN_ROWS else df.sparkSession.createDataFrame(table, df.schema)


def local_rows(spark: SparkSession, rows: Sequence[tuple], schema: StructType | str) -> DataFrame:
    """A few rows of parameters as a local relation, whose size the optimizer knows."""
    if isinstance(schema, str):
        schema = StructType.fromDDL(schema)
    kinds = to_arrow_schema(schema)
    columns = [pa.array([r[i] for r in rows], kinds.field(i).type) for i in range(len(schema.fields))]
    return spark.createDataFrame(pa.table(columns, names=schema.names), schema)


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as parquet and return the written table (columnar, so later reads prune and push down)."""
    spark = df.sparkSession
    path = fresh_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def drop_staged(spark: SparkSession) -> None:
    """Delete all staged tables of this application; frames that read them are of no use afterwards."""
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(f"{staging_root(spark)}/callwise/{spark.sparkContext.applicationId}")
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)
