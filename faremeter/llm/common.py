"""Small helpers shared by the operators of this folder."""
from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: The white space of all contracts here: space and U+0009 to U+000D.
WHITE = " \t\n\x0b\x0c\r"
#: A word: a run of anything else.
WORD = r"[^\x20\x09-\x0D]+"


def partitions(spark: SparkSession, least: int = 1) -> int:
    """How many pieces a shuffled table is cut into: the session's own setting."""
    return max(least, int(spark.conf.get("spark.sql.shuffle.partitions")))


def as_row(df: DataFrame) -> Column:
    """All columns of a table as one struct, so that helper columns beside it cannot clash with their names."""
    return F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("row")


def text_of(name: str = "text") -> Column:
    """A text column with null read as empty."""
    return F.coalesce(F.col(name), F.lit(""))


def utf8(column: pa.ChunkedArray | pa.Array) -> list[bytes]:
    """The values of an Arrow string or binary column as bytes; null gives empty bytes."""
    out: list[bytes] = []
    for chunk in column.chunks if isinstance(column, pa.ChunkedArray) else [column]:
        kind = pa.large_binary() if pa.types.is_large_string(chunk.type) else pa.binary()
        raw = chunk.cast(kind) if not (pa.types.is_binary(chunk.type) or pa.types.is_large_binary(chunk.type)) else chunk
        out += [v or b"" for v in raw.to_pylist()]
    return out


def held_out(doc_id: int | None, modulus: int, remainder: int) -> bool:
    """Whether crc32 of the id as text has this remainder; a null id is never held out."""
    return doc_id is not None and zlib.crc32(str(doc_id).encode()) % modulus == remainder


def held_out_column(doc_id: str, modulus: int, remainder: int) -> Column:
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % modulus == remainder, F.lit(False))


def settle(spark: SparkSession) -> None:
    """Let go of the shuffle files of finished jobs, which stay until the driver collects its garbage; an operator of
    many jobs calls this between them."""
    spark.sparkContext._jvm.System.gc()


def drop_stored(df: DataFrame) -> None:
    """Remove a stored table that nothing reads any more."""
    spark, files = df.sparkSession, df.inputFiles()
    if files:
        folder = spark._jvm.org.apache.hadoop.fs.Path(files[0]).getParent()
        folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def packed(values: np.ndarray) -> bytes:
    """An integer or float array as compressed bytes; ascending integers are stored as differences."""
    import zstandard

    return zstandard.ZstdCompressor(level=1).compress(np.ascontiguousarray(values).tobytes())


def unpacked(data: bytes, dtype: str) -> np.ndarray:
    import zstandard

    return np.frombuffer(zstandard.ZstdDecompressor().decompress(data), dtype=dtype)


def packed_ascending(values: np.ndarray) -> bytes:
    """Ascending unsigned 64-bit numbers, as compressed differences."""
    return packed(np.diff(values, prepend=values.dtype.type(0)))


def unpacked_ascending(data: bytes, dtype: str = "<u8") -> np.ndarray:
    return np.cumsum(unpacked(data, dtype), dtype=dtype)


def rows_to_batches(rows: Iterator[dict], schema: pa.Schema, size: int) -> Iterator[pa.RecordBatch]:
    """Gather dictionaries into Arrow batches of at most `size` rows."""
    held: list[dict] = []
    for row in rows:
        held.append(row)
        if len(held) >= size:
            yield pa.RecordBatch.from_pylist(held, schema)
            held = []
    if held:
        yield pa.RecordBatch.from_pylist(held, schema)
