"""Preprocess step: metadata lookup, left-join enrichment, cleaning, projection."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import AtomicType

from corpusloom.functions.text import is_blank, strip_text
from corpusloom.operators.sampling import with_row_id

# Above this many rows an ordered limit ranks by range partition instead of a top-k merge.
TOPK_ROWS = 100_000


def metadata_lookup(meta: DataFrame, key: str, fields: Sequence[str], order: Sequence[Column | str]) -> DataFrame:
    """One metadata row per key: the last one in ``order`` wins.

    ``max_by`` combines map-side, so a key that holds a third of all rows
    shuffles one row per partition. Fields are cast to string because an
    unmatched document gets ``""`` in each of them.
    """
    packed = F.struct(*[F.col(f).cast("string").alias(f) for f in fields])
    last = F.max_by(packed, F.struct(*order))
    return meta.groupBy(key).agg(last.alias("_m")).select(key, *[F.col("_m")[f].alias(f) for f in fields])


def drop_blank(df: DataFrame, key: str, text: str) -> DataFrame:
    """Drop null keys and null, empty or all-whitespace text.

    The key test is a conjunct of its own so that it reaches the Parquet filter.
    """
    return df.filter(F.col(key).isNotNull()).filter(~is_blank(F.col(text)))


def enrich(content: DataFrame, lookup: DataFrame, key: str, fields: Sequence[str]) -> DataFrame:
    """Left join, one row per content row.

    A key without metadata gives ``""`` in every field; a null inside a found
    row stays null, hence the match flag instead of ``coalesce``. No broadcast
    hint: Catalyst broadcasts the lookup only below its size threshold, and the
    sort-merge join beyond it splits a hot content key at run time.
    """
    flagged = lookup.select(key, *fields, F.lit(True).alias("_hit"))
    joined = content.join(flagged, key, "left")
    filled = {f: F.when(F.col("_hit").isNull(), F.lit("")).otherwise(F.col(f)) for f in fields}
    return joined.withColumns(filled).drop("_hit")


def project_preprocessed(
    df: DataFrame, key: str, text: str, fields: Sequence[str], extra: Sequence[str] = ("source_shard",)
) -> DataFrame:
    """text, key, metadata fields, then provenance columns that exist."""
    return df.select(
        strip_text(F.col(text)).alias("text"),
        F.col(key),
        *[F.col(f) for f in fields],
        *[F.col(c) for c in extra if c in df.columns],
    )


def limit_records(df: DataFrame, n: int | None, order: Sequence[str]) -> DataFrame:
    """The first ``n`` rows in ``order``; ``None`` means all.

    Rows that tie in ``order`` are told apart by their other columns, so the
    choice is the same however it is made: small limits merge per-partition
    tops, a large one, which would pull ``n`` rows into one task, numbers range
    partitions and filters.
    """
    if n is None:
        return df
    atomic = [f.name for f in df.schema.fields if isinstance(f.dataType, AtomicType) and f.name not in order]
    order = [*order, *atomic]
    if n <= TOPK_ROWS:
        return df.orderBy(*order).limit(n)
    return with_row_id(df, (), order, name="_record").filter(F.col("_record") < n).drop("_record")


def preprocess(
    content: DataFrame,
    meta: DataFrame,
    key: str,
    text: str,
    fields: Sequence[str],
    meta_order: Sequence[Column | str],
    record_limit: int | None = None,
    record_order: Sequence[str] | None = None,
) -> DataFrame:
    """The whole step as one plan: clean, limit, look up, join, project.

    Blank rows go before the join, so null keys never reach the shuffle. The
    limit counts surviving rows; the join keeps exactly one row for each.
    Metadata without a row is an error: nothing could be looked up in it.
    """
    if meta.isEmpty():
        raise ValueError("the metadata has no rows")
    clean = drop_blank(content, key, text)
    if record_limit is not None:
        clean = limit_records(clean, record_limit, record_order or [key])
    lookup = metadata_lookup(meta, key, fields, meta_order)
    return project_preprocessed(enrich(clean, lookup, key, fields), key, text, fields)
