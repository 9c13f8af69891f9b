"""Path helpers. All of them are plain string operations inside code generation."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from ..model import NOISE_PATTERN
from .text import col, or_empty, strip


def basename(c: Column | str) -> Column:
    """Text after the last slash; the whole text if there is none."""
    return F.substring_index(col(c), "/", -1)


# the last name of a path, with the slashes before it unless the path starts with them
_LAST_NAME = r"(?:(?<=[^/])(/)/*)?[^/]+$"


def parent_dir(c: Column | str) -> Column:
    """Directory of a path, with a closing slash; ``""`` if the path has none.

    A path that ends in a slash is a directory already. Doubled slashes before the
    last name collapse, unless the directory consists of slashes only.
    """
    return F.regexp_replace(strip(or_empty(c)), _LAST_NAME, "$1")


def truncate_path(c: Column | str, depth: int) -> Column:
    """First ``depth`` components between slashes: ``/a/b/c/d`` at 2 is ``/a/b/``.

    Depth 0 gives ``/``. The root path itself gives ``//``, as the sources do.
    """
    c = or_empty(c)
    if depth <= 0:
        return F.when(c == "", "").otherwise("/")
    kept = F.substring_index(F.trim(c, F.lit("/")), "/", depth)
    return F.when(c == "", "").otherwise(F.concat(F.lit("/"), kept, F.lit("/")))


def is_noise(c: Column | str) -> Column:
    """True for temporary, staging, trash, checksum and commit-marker paths.

    One pattern, so that the path expression is evaluated once per row even where the
    optimizer moves the test below the projection that made the path.
    """
    c = or_empty(c)
    return c.rlike(NOISE_PATTERN) | (strip(c) == "_SUCCESS")
