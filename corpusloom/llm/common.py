"""Small helpers the operators of this package share."""

from __future__ import annotations

import sys
import types
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# What separates words wherever this package counts or compares words.
WORD_PATTERN = r"[^\x20\x09-\x0D]+"


def worker_memo(name: str) -> dict:
    """A dict that lives in the Python worker process, so that its tasks share what they have computed.

    Asking for one drops the others: workers outlive an operator, and what those
    of a pipeline remember would add up.
    """
    module = sys.modules.setdefault("_corpusloom_worker_memo", types.ModuleType("_corpusloom_worker_memo"))
    memos = module.__dict__.setdefault("memo", {})
    for other in memos.keys() - {name}:
        del memos[other]
    return memos.setdefault(name, {})


def map_rows(df: DataFrame, make: Callable[[], Callable[[dict], dict]], schema: str, rows: int = 256) -> DataFrame:
    """``mapInArrow`` over slices of at most ``rows`` rows, which bounds what a task holds at once.

    ``make`` runs once per task and returns the function from a slice's columns
    (lists by name) to the result's columns.
    """
    arrow = _arrow_schema(df, schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        step = make()
        for batch in batches:
            for start in range(0, batch.num_rows, rows):
                part = batch.slice(start, rows)
                out = step({n: part.column(i).to_pylist() for i, n in enumerate(part.schema.names)})
                yield pa.RecordBatch.from_arrays([pa.array(out[f.name], f.type) for f in arrow], schema=arrow)

    return df.mapInArrow(run, schema)


def _arrow_schema(df: DataFrame, schema: str) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    return to_arrow_schema(StructType.fromDDL(schema))


def word_count(text: Column) -> Column:
    """Number of words; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD_PATTERN)), F.lit(0)).cast("long")
