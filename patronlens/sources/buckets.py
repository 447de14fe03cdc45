"""Tables stored by a hash of their key, so that joins on the key need no shuffle.

Spark keeps the number of buckets and the key of such a table in a catalog. Here the catalog entry lives only as long as
it takes to resolve the table: whoever keeps the path also keeps key and number, and any session can read the folder.

This is for tables with one row per key, such as customers: a bucket is read by one task, and a key with a large part of
the rows would make one of them large. Orders, of which one customer may have a third, are never stored like this.

Defined cases: rows without a key share a bucket and join with nothing; a table without rows is an empty table; tables of
different numbers of buckets are joined rightly, but Spark moves one of them.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


def default_buckets(spark: SparkSession) -> int:
    """As many buckets as the session has shuffle partitions, which are sized for its tables."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def _quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


@contextmanager
def _entry(spark: SparkSession) -> Iterator[str]:
    """A name for a catalog entry, which goes when the block is left; files at a path of their own stay."""
    name = f"patronlens_{uuid.uuid4().hex}"
    try:
        yield name
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {name}")


def write_bucketed(df: DataFrame, path: str, key: str, buckets: int) -> None:
    """Write ``df`` to a new folder, one file for each bucket that has rows.

    Rows that already lie by these buckets are not moved again.
    """
    with _entry(df.sparkSession) as name:
        dealt = df.repartition(buckets, _quoted(key))
        dealt.write.format("parquet").option("path", path).bucketBy(buckets, key).saveAsTable(name)


def read_bucketed(spark: SparkSession, path: str, key: str, buckets: int, schema: T.StructType | None = None) -> DataFrame:
    """The table in ``path``, known to lie by its key. Without ``schema``, that of the files is used."""
    schema = schema or spark.read.parquet(path).schema
    columns = ", ".join(f"{_quoted(f.name)} {f.dataType.simpleString()}" for f in schema.fields)
    place = path.replace("\\", "\\\\").replace("'", "\\'")
    with _entry(spark) as name:
        spark.sql(
            f"CREATE TABLE {name} ({columns}) USING parquet "
            f"CLUSTERED BY ({_quoted(key)}) INTO {buckets} BUCKETS LOCATION '{place}'"
        )
        # The columns are chosen here, while the entry exists, so that nothing looks for its name later.
        return spark.table(name).select(*[_quoted(f.name) for f in schema.fields])
