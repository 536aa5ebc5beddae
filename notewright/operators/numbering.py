"""Gap-free row numbers without a window over a whole group.

A plain ``row_number`` over a group puts the group into one task. Here a group is
cut into chunks of its order key: rows are numbered inside a chunk, chunk counts
are accumulated, and the two are added. Only the counts of a group meet in one task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from notewright.session import materialised

CHUNK_BITS = 17


def number_rows(
    frame: DataFrame,
    group: Sequence[str],
    order: str,
    name: str,
    chunk_bits: int = CHUNK_BITS,
    tie_break: Sequence[str] = (),
) -> DataFrame:
    """Add ``name``: 0-based position inside ``group`` by the non-negative integer ``order``.

    A chunk is a run of ``2**chunk_bits`` order values. Windows and the join of the
    offsets share one hash partitioning, so rows are shuffled once. Group columns
    must not be null.
    """
    group = list(group)
    chunked = frame.withColumn("__chunk", F.shiftright(F.col(order).cast("bigint"), chunk_bits))
    chunk_key = [*group, "__chunk"]
    offsets = (
        chunked.groupBy(*chunk_key)
        .agg(F.count(F.lit(1)).alias("__rows"))
        .select(*chunk_key, _before("__rows", group, ["__chunk"]).alias("__offset"))
    )
    inside = Window.partitionBy(*chunk_key).orderBy(order, *tie_break)
    return (
        chunked.withColumn("__row", F.row_number().over(inside) - 1)
        .join(offsets, chunk_key)
        .select(*frame.columns, (F.col("__offset") + F.col("__row")).alias(name))
    )


def _before(value: str, group: Sequence[str], order: Sequence[str]) -> Column:
    window = Window.partitionBy(*group).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    return F.coalesce(F.sum(value).over(window), F.lit(0)).cast("bigint")


def number_files(
    frame: DataFrame,
    file: str,
    order: str,
    kept: Column,
    chunk_bits: int = CHUNK_BITS,
) -> DataFrame:
    """Keep the rows where ``kept`` holds and add ``local_index`` and ``global_index``.

    ``local_index`` is the position among all rows of the file, kept or not;
    ``global_index`` runs over the kept rows of all files, in file order.
    """
    chunked = frame.withColumn("__kept", F.coalesce(kept, F.lit(False))).withColumn(
        "__chunk", F.shiftright(F.col(order).cast("bigint"), chunk_bits)
    )
    chunk_key = [file, "__chunk"]
    counts = materialised(
        chunked.groupBy(*chunk_key).agg(F.count(F.lit(1)).alias("__rows"), F.count_if("__kept").alias("__kept_rows"))
    )
    in_file = counts.select(
        *chunk_key,
        _before("__rows", [file], ["__chunk"]).alias("__offset"),
        _before("__kept_rows", [file], ["__chunk"]).alias("__kept_offset"),
    )
    per_file = counts.groupBy(file).agg(F.sum("__kept_rows").alias("__kept_rows"))
    bases = running_total(per_file, [file], "__kept_rows", "__base")
    offsets = in_file.join(bases.select(file, "__base"), file)
    inside = Window.partitionBy(*chunk_key).orderBy(order)
    kept_so_far = F.sum(F.col("__kept").cast("bigint")).over(inside.rowsBetween(Window.unboundedPreceding, 0))
    return (
        chunked.withColumn("__row", F.row_number().over(inside) - 1)
        .withColumn("__kept_row", kept_so_far - 1)
        .filter("__kept")
        .join(offsets, chunk_key)
        .select(
            *frame.columns,
            (F.col("__offset") + F.col("__row")).alias("local_index"),
            (F.col("__base") + F.col("__kept_offset") + F.col("__kept_row")).alias("global_index"),
        )
    )


def _sorted_slices(frame: DataFrame, order: Sequence[str | Column]) -> DataFrame:
    """Globally sorted and materialised, with the slice and place of every row.

    The checkpoint fixes the slices: range bounds come from sampling and could
    differ if the sort ran again.
    """
    place = F.monotonically_increasing_id().alias("__place")
    return materialised(frame.orderBy(*order).select("*", F.spark_partition_id().alias("__slice"), place))


def running_total(frame: DataFrame, order: Sequence[str | Column], value: str, name: str) -> DataFrame:
    """Add ``name``: sum of ``value`` over all rows before this one in a global order."""
    rows = _sorted_slices(frame, order)
    totals = rows.groupBy("__slice").agg(F.sum(value).alias("__total"))
    # One row per slice of the sort, so this window and broadcast hold a few hundred rows.
    bases = totals.select("__slice", _before("__total", [], ["__slice"]).alias("__slice_base"))
    inside = Window.partitionBy("__slice").orderBy("__place").rowsBetween(Window.unboundedPreceding, -1)
    so_far = F.coalesce(F.sum(value).over(inside), F.lit(0)).cast("bigint")
    return (
        rows.withColumn("__so_far", so_far)
        .join(F.broadcast(bases), "__slice")
        .select(*frame.columns, (F.col("__slice_base") + F.col("__so_far")).alias(name))
    )


def number_sorted(frame: DataFrame, order: Sequence[str | Column], name: str) -> DataFrame:
    """Add ``name``: 0-based position in a global order over any sortable columns."""
    rows = _sorted_slices(frame, order)
    firsts = rows.groupBy("__slice").agg(F.count(F.lit(1)).alias("__rows"), F.min("__place").alias("__first"))
    bases = firsts.select("__slice", "__first", _before("__rows", [], ["__slice"]).alias("__slice_base"))
    return rows.join(F.broadcast(bases), "__slice").select(
        *frame.columns,
        (F.col("__slice_base") + F.col("__place") - F.col("__first")).alias(name),
    )
