"""The corpus pipeline: quality rules, line dedup, SimHash near-dedup, mixing, byte-level BPE.

Each stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame, which is
written as Parquet and read again as the next one's ``docs``. All but the last
return the columns of ``documents``:

1. quality rules: rejected documents go, lines above the limits go from texts;
2. line dedup: repeated and near-equal lines go, and documents left without any;
3. SimHash near-dedup: one document of each group stays;
4. mixing: a row for every copy that the mix takes of a document;
5. byte-level BPE: a row with token ids for each of those.

The tables that a stage wrote on its way are needed until its result is written, which
is when the next stage begins; they are deleted then, so the disk holds one stage's.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession

from slugmend.llm import byte_bpe, line_dedup, mixing, quality, simhash
from slugmend.llm.common import table
from slugmend.llm.queries import BYTE_BPE
from slugmend.sources import cuts
from slugmend.sources.cuts import materialise

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]
_left: list[str] = []  # tables of the stages that went before


def tidy(stage: Stage) -> Stage:
    """The stage, deleting what earlier ones left on their way, and leaving its own tables to the next."""

    @wraps(stage)
    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        cuts.release(spark, only=_left)
        since = cuts.mark()
        out = stage(spark, docs, sf_dir)
        _left[:] = cuts.made(since)
        return out

    return run_stage


@tidy
def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality.filter_documents(docs)


@tidy
def lines_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return line_dedup.drop_lines(docs)


@tidy
def near_duplicates_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return simhash.one_per_component(docs)


@tidy
def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mix_rows(docs)


@tidy
def encoding_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return byte_bpe.encode_documents(docs, BYTE_BPE, with_ids=True)


STAGES = [
    ("quality_rules", quality_stage),
    ("line_dedup", lines_stage),
    ("simhash_near_dedup", near_duplicates_stage),
    ("mixing", mixing_stage),
    ("byte_bpe", encoding_stage),
]

#: SQL cannot express the stages' hashing and merging; tests hold them against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages one after the other over ``documents``, each written and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialise(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
