"""Table sources and the replace-table sink."""
from __future__ import annotations

import uuid
from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


#: Names a table's version in its folder; Spark's own readers pass over names with an underscore.
_POINTER = "_current"


def read(
    spark: SparkSession, path: str, fmt: str = "parquet", schema: T.StructType | str | None = None, **options
) -> DataFrame:
    """Load a table from any Spark data source; give a schema for text formats so that nothing is inferred.

    Of a table written by `replace` this is the version that was committed last.
    """
    reader = spark.read.format(fmt).options(**options)
    if schema is not None:
        reader = reader.schema(schema)
    version = committed(spark, path)
    return reader.load(f"{path.rstrip('/')}/{version}" if version else path)


def read_csv(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    """CSV with a header line and a fixed schema."""
    return read(spark, path, "csv", schema, header=True)


def _folder(spark: SparkSession, path: str):
    """(file system, path object) of an address, through Spark's own file systems."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    return folder.getFileSystem(spark._jsc.hadoopConfiguration()), folder


def committed(spark: SparkSession, path: str) -> str | None:
    """The version of a table that readers see; None where `replace` has written none."""
    fs, pointer = _folder(spark, f"{path.rstrip('/')}/{_POINTER}")
    if not fs.exists(pointer):
        return None
    stream = fs.open(pointer)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def _commit(spark: SparkSession, path: str, version: str) -> None:
    """Make a version the one that readers see, by one rename over the pointer file."""
    hadoop = spark._jvm.org.apache.hadoop.fs
    fs, draft = _folder(spark, f"{path}/{_POINTER}-{version}")
    stream = fs.create(draft, True)
    stream.write(bytearray(version.encode()))
    stream.close()
    rename = getattr(hadoop, "Options$Rename")
    options = spark.sparkContext._gateway.new_array(rename, 1)
    options[0] = rename.OVERWRITE
    context = hadoop.FileContext.getFileContext(draft.toUri(), spark._jsc.hadoopConfiguration())
    context.rename(draft, hadoop.Path(f"{path}/{_POINTER}"), options)


def replace(df: DataFrame, path: str, fmt: str = "parquet", **options) -> DataFrame:
    """Replace the table at `path`, all or nothing, and return it as read back.

    The rows go to a folder of their own; when all are written, one rename makes it the table. If the job fails or its
    driver is lost before that, readers see the old rows, and the next replacement removes what was left. So `df` may
    read the table it replaces. The version before stays for readers that have begun; older ones are removed.
    """
    spark, path = df.sparkSession, path.rstrip("/")
    before, version = committed(spark, path), f"_v-{uuid.uuid4().hex}"
    df.write.format(fmt).options(**options).save(f"{path}/{version}")
    _commit(spark, path, version)
    fs, folder = _folder(spark, path)
    for entry in fs.listStatus(folder):
        name = entry.getPath().getName()
        # without a version before, plain files are what readers may be reading
        if name not in (_POINTER, version, before) and (name.startswith("_v-") or before):
            fs.delete(entry.getPath(), True)
    return read(spark, path, fmt, df.schema, **options)


def put_request(spark: SparkSession, request: dict, schema: T.StructType | str, path: str) -> DataFrame:
    """Replace the one-row request table."""
    fields = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
    return replace(spark.createDataFrame([tuple(request[n] for n in fields.names)], fields), path)


def _bucket(columns: Sequence[Column], buckets: int) -> Column:
    return F.pmod(F.xxhash64(*columns), F.lit(buckets)).cast("int")


def store_for_lookups(df: DataFrame, path: str, keys: Sequence[str], buckets: int) -> DataFrame:
    """Store a table in `buckets` files by a hash of its keys, each sorted by them, for `lookup_stored`."""
    placed = df.withColumn("_bucket", _bucket([F.col(k) for k in keys], buckets)).repartition(buckets, "_bucket")
    placed.sortWithinPartitions("_bucket", *keys).write.partitionBy("_bucket").parquet(path)
    return df.sparkSession.read.schema(placed.schema).parquet(path)


def lookup_stored(kept: DataFrame, keys: Sequence[Mapping[str, object]], buckets: int) -> DataFrame:
    """The rows of several keys in one read of a table of `store_for_lookups`.

    The keys' buckets are constants of the plan, so only their files are listed, and of those the row groups whose range
    holds a key.
    """
    def value(name: str, v: object) -> Column:
        return F.lit(v).cast(kept.schema[name].dataType)

    wanted = [_bucket([value(n, v) for n, v in key.items()], buckets) for key in keys]
    exact = [reduce(Column.__and__, [F.col(n) == value(n, v) for n, v in key.items()]) for key in keys]
    return kept.filter(F.col("_bucket").isin(*wanted) & reduce(Column.__or__, exact)).drop("_bucket")
