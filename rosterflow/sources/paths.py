"""File addresses as the readers take them."""

from __future__ import annotations

import re
from urllib.parse import unquote

from pyspark.sql import Column
from pyspark.sql import functions as F


def read_path(uri: str) -> str:
    """Path argument for a file address from ``_metadata.file_path``: percent signs
    resolved, pattern characters taken literally."""
    return re.sub(r"([\\\[\]{}*?])", r"\\\1", unquote(uri))


def plain_address(uri: str) -> str:
    """Local addresses come with one or three slashes; use three."""
    return re.sub("^file:/+", "file:///", uri)


def file_address() -> Column:
    """Address of the file a row was read from."""
    return F.regexp_replace(F.col("_metadata.file_path"), "^file:/+", "file:///")


def object_uri(bucket: Column, key: Column, store: str = "s3a://") -> Column:
    """Address of an object recorded as bucket and key."""
    return F.concat(F.lit(store), bucket, F.lit("/"), key)
