"""The schema of a run log, kept beside it as a short list of versions.

Merging the schemas of a log's files opens the footer of every file on every read. The
list makes that needless: each append adds the columns that are new as one more version
(``_manifest/schemas/v-<n>.json`` under the log; readers pass over such folders), before
it writes rows. A log that has no list yet is read by its footers once, at its next append.
Rows written by other means than ``append_log`` must bring no new columns, or call
:func:`record_schema` themselves.
"""

from __future__ import annotations

import json
import uuid

from py4j.java_gateway import JavaObject
from py4j.protocol import Py4JJavaError
from pyspark.errors import AnalysisException
from pyspark.sql import SparkSession
from pyspark.sql.types import StructField, StructType

MANIFEST = "_manifest"


def file_system(spark: SparkSession, path: str) -> tuple[JavaObject, JavaObject]:
    """The Hadoop file system of a path, and the path."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()), where


def children(spark: SparkSession, path: str) -> list[str]:
    """Names in a folder, sorted; none where there is no folder."""
    fs, where = file_system(spark, path)
    return sorted(f.getPath().getName() for f in fs.listStatus(where)) if fs.exists(where) else []


def move_new(spark: SparkSession, source: str, target: str) -> bool:
    """Rename in one step; False (and nothing changed) if the target is there."""
    fs, to = file_system(spark, target)
    hadoop, conf = spark._jvm.org.apache.hadoop.fs, spark._jsc.hadoopConfiguration()
    fs.mkdirs(to.getParent())
    origin = hadoop.Path(source)
    none = spark.sparkContext._gateway.new_array(getattr(hadoop, "Options$Rename"), 0)
    try:
        hadoop.FileContext.getFileContext(to.toUri(), conf).rename(origin, to, none)
    except Py4JJavaError:
        if not fs.exists(to):
            raise
        return False
    return True


def _versions(path: str) -> str:
    return f"{path.rstrip('/')}/{MANIFEST}/schemas"


def _latest(spark: SparkSession, path: str) -> tuple[int, StructType | None]:
    names = [n for n in children(spark, _versions(path)) if n.startswith("v-")]
    if not names:
        return 0, None
    fs, where = file_system(spark, f"{_versions(path)}/{names[-1]}")
    stream = fs.open(where)
    try:
        text = spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()
    return int(names[-1][2:-5]), StructType.fromJson(json.loads(text))


def known_schema(spark: SparkSession, path: str) -> StructType | None:
    """The log's columns by its list; None if it has none."""
    return _latest(spark, path)[1]


def _footers(spark: SparkSession, path: str) -> StructType:
    """The merged schema of a log's files; empty where there are none."""
    try:
        return spark.read.option("mergeSchema", "true").parquet(path).schema
    except AnalysisException as e:
        if e.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            raise
        return StructType()


def record_schema(spark: SparkSession, path: str, schema: StructType) -> StructType:
    """Add the columns of ``schema`` to the log's list; returns all of them.

    A column that the log has with another type raises ``ValueError``: its rows could not
    be read with the others. Of writers that add a version at the same time one succeeds,
    and the others start again from what it wrote.
    """
    while True:
        number, known = _latest(spark, path)
        fields = {f.name: f.dataType for f in (known if known is not None else _footers(spark, path)).fields}
        if "execution_id" in fields:  # a partition folder's name, whatever it looks like
            fields["execution_id"] = schema["execution_id"].dataType
        for f in schema.fields:
            if fields.setdefault(f.name, f.dataType) != f.dataType:
                have = fields[f.name].simpleString()
                raise ValueError(f"log column {f.name} is {have}, not {f.dataType.simpleString()}")
        merged = StructType([StructField(n, t) for n, t in fields.items()])
        if known == merged:
            return merged
        fs, staged = file_system(spark, f"{_versions(path)}/_{uuid.uuid4().hex}")
        stream = fs.create(staged, False)
        stream.write(bytearray(merged.json().encode()))
        stream.close()
        if move_new(spark, staged.toString(), f"{_versions(path)}/v-{number + 1:08d}.json"):
            return merged
        fs.delete(staged, True)
