"""Path and URL expressions of the shard layout."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Marker and name formats of the on-disk layout.
RESOLVE_MARKER = "/resolve/main/"
SHARD_NAME_FORMAT = "part-%05d-of-%05d.parquet"
PART_DASH = r"^part-.*\.parquet$"
PART_UNDERSCORE = r"^part_.*\.parquet$"
PART_UNDERSCORE_OF = r"^part_.*_of_.*\.parquet$"


def file_name(path: Column) -> Column:
    return F.substring_index(path, "/", -1)


def directory(path: Column) -> Column:
    return F.regexp_replace(path, "/[^/]*$", "")


def is_hidden(name: Column) -> Column:
    return F.startswith(name, F.lit("."))


def is_parquet(name: Column) -> Column:
    return F.endswith(name, F.lit(".parquet"))


def relative_to_marker(url: Column) -> Column:
    """The part after ``/resolve/main/``, else the last path piece."""
    at = F.locate(RESOLVE_MARKER, url)
    after = F.substr(url, at + F.lit(len(RESOLVE_MARKER)))
    return F.when(at > 0, after).otherwise(file_name(url))


def shard_url(base: Column | str, repo: Column, rel_path: Column) -> Column:
    """``<base>/<repo>/resolve/main/<path inside the repository>``."""
    base = F.lit(base) if isinstance(base, str) else base
    return F.concat(base, F.lit("/"), repo, F.lit(RESOLVE_MARKER), rel_path)


def canonical_name(index: Column, total: Column) -> Column:
    return F.format_string(SHARD_NAME_FORMAT, index, total)


def preprocessed_path(root: Column | str, key: Column, layout: str = "preprocessed") -> Column:
    root = F.lit(root) if isinstance(root, str) else root
    return F.concat_ws("/", root, key, F.lit(layout))


def _blank_to_null(value: Column | str | None) -> Column:
    value = F.lit(value).cast("string") if value is None or isinstance(value, str) else value
    return F.nullif(F.trim(value), F.lit(""))


def embedding_path(
    root: Column | str,
    key: Column,
    central_override: Column | str | None = None,
    central: Column | str | None = None,
    layout: str = "embedding",
) -> Column:
    """Output folder of the embed step.

    The override wins over the configured central root; blank means unset.
    Without a central root the vectors stay in the dataset's own folder.
    """
    root = F.lit(root) if isinstance(root, str) else root
    central_root = F.coalesce(_blank_to_null(central_override), _blank_to_null(central))
    return F.when(central_root.isNotNull(), F.concat_ws("/", central_root, key)).otherwise(
        F.concat_ws("/", root, key, F.lit(layout))
    )
