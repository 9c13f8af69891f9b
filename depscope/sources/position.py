"""Place of a record in its source."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def position(*inner: Column | str) -> Column:
    """Orderable place: file, block within the file, row; ``inner`` for array elements.

    The row number alone does not follow file order once files are split over tasks.
    """
    return F.struct(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("row"),
        *inner)
