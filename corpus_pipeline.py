"""The corpus pipeline: documents through the text operators, stage by stage."""

from __future__ import annotations

import threading
from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession

from stockwright.llm.common import table
from stockwright.llm.decontaminate import decontamination_stage
from stockwright.llm.jaccard_join import near_duplicates_stage
from stockwright.llm.packing import packing_stage
from stockwright.llm.quality_rules import quality_stage
from stockwright.llm.secrets import secrets_stage
from stockwright.sources.tables import delete_stages, new_folder, recorded_stages

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

# What each stage has staged last, by thread and stage.
_staged = threading.local()


def _step(k: int, function: Stage) -> Stage:
    """The stage, which first deletes what the stage before has staged: its rows are written when this one begins.

    Nothing else is deleted: not what reports stage between stages, and not what the last stage's rows are read from.
    """

    @wraps(function)
    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        held = _staged.__dict__.setdefault("paths", {})
        delete_stages(spark, held.pop(k - 1, []))
        with recorded_stages() as paths:
            out = function(spark, docs, sf_dir)
        held[k] = paths
        return out

    return run_stage


_FUNCTIONS = [
    ("quality_rules", quality_stage),
    ("near_duplicates", near_duplicates_stage),
    ("decontamination", decontamination_stage),
    ("secrets", secrets_stage),
    ("packing", packing_stage),
]
STAGES = [(name, _step(k, function)) for k, (name, function) in enumerate(_FUNCTIONS)]

# No stage is plain SQL; tests/llm/test_pipeline.py compares the stages with plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each stage's rows are written and read again as the next one's input.

    Null texts count as empty, repeated rows as copies; without documents there are no rows. Results of several runs stay
    readable side by side.
    """
    docs = table(spark, sf_dir, "documents")
    for name, function in STAGES[:-1]:
        path = new_folder(spark, name)
        function(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)
