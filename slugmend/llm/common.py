"""Small helpers shared by the operators of this subpackage."""

from __future__ import annotations

import os
import shutil
import tempfile
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

import slugmend
from slugmend.sources.tables import read_table

#: White space of the word contracts: space, tab, newline, vertical tab, form feed, return.
#: The same six characters that ``bytes.split()`` splits on.
WORD_SPACE = r"[\x20\x09-\x0D]+"

#: Rows taken from an Arrow batch at a time, so that a batch of very long texts stays small.
SLICE_ROWS = 256


_shipped: set[str] = set()


def ship_code(spark: SparkSession) -> None:
    """Send this package to the executors' Python workers, once per application."""
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    package = os.path.dirname(os.path.realpath(slugmend.__file__))
    folder = os.path.realpath(tempfile.mkdtemp(prefix="slugmend-code-"))
    archive = shutil.make_archive(os.path.join(folder, "slugmend-code"), "zip", os.path.dirname(package), "slugmend")
    context.addPyFile(archive)
    _shipped.add(context.applicationId)


def map_arrow(
    df: DataFrame, function: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema: str | StructType
) -> DataFrame:
    """``mapInArrow`` of a function of this package."""
    ship_code(df.sparkSession)
    return df.mapInArrow(function, schema)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return read_table(spark, sf_dir, name)


def slices(batches: Iterator[pa.RecordBatch], rows: int = SLICE_ROWS) -> Iterator[pa.RecordBatch]:
    """The batches in pieces of at most ``rows`` rows."""
    for batch in batches:
        for start in range(0, batch.num_rows, rows):
            yield batch.slice(start, rows)


def texts_of(batch: pa.RecordBatch, column: str = "text") -> list[str]:
    """A text column as Python strings, null as the empty string."""
    return [t or "" for t in batch.column(column).to_pylist()]


def words(text: str) -> list[bytes]:
    """Words ``[^\\x20\\x09-\\x0D]+`` of a text, as UTF-8."""
    return text.encode().split()


def temp_name(df: DataFrame, base: str) -> str:
    """``base``, with underscores appended until no column of ``df`` has that name (in any case)."""
    taken = {c.lower() for c in df.columns}
    while base.lower() in taken:
        base += "_"
    return base


def word_array(text):
    """Column: the words of a text as an array (null: empty)."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), WORD_SPACE), lambda w: w != "")
