"""What this package registers: the operators' queries and the pipeline, with SQL where SQL can say the same."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

import corpus_pipeline
from carelake.llm import queries as operators
from carelake.llm import sql


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {**operators.queries(), "pipeline": corpus_pipeline.run}


def oracle_sql() -> dict[str, str]:
    pipeline = {"pipeline": corpus_pipeline.ORACLE_SQL} if corpus_pipeline.ORACLE_SQL else {}
    return {**sql.oracle_sql(), **pipeline}
