"""Row numbers that need no single task to see all rows, or all rows of one group."""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pagetrove.session import scratch_path, settled

# Above this many offset rows the offsets are joined by shuffle instead of broadcast.
BROADCAST_ROWS = 500_000


def _range_start(column, width):
    """Ranges of an integer column are named after their first value."""
    return F.col(column) - F.pmod(F.col(column), F.lit(width))


def _rows_before(counts, group, width, step, levels):
    """For every (group, __range) the number of rows in the group's earlier ranges.

    ``step`` ranges at a time are summed up under a wider range, whose own number of earlier rows is
    found in the same way. No window sees more than ``step`` rows below the top level.
    """
    if levels == 1:
        earlier = Window.partitionBy(group).orderBy("__range").rowsBetween(
            Window.unboundedPreceding, -1)
        return counts.select(
            group, "__range", F.coalesce(F.sum("__rows").over(earlier), F.lit(0)).alias("__before"))
    wide = width * step
    placed = counts.withColumn("__wide", _range_start("__range", wide))
    totals = placed.groupBy(group, F.col("__wide").alias("__range")).agg(
        F.sum("__rows").alias("__rows"))
    totals = settled(totals, "counts") if levels > 2 else totals
    above = _rows_before(totals, group, wide, step, levels - 1).withColumnsRenamed(
        {"__range": "__wide", "__before": "__above"})
    earlier = Window.partitionBy(group, "__wide").orderBy("__range").rowsBetween(
        Window.unboundedPreceding, -1)
    inside = placed.withColumn("__inside", F.coalesce(F.sum("__rows").over(earlier), F.lit(0)))
    return _same_group(inside, above, group, "__wide").select(
        group, "__range", (F.col("__inside") + F.col("__above")).alias("__before"))


def _same_group(left, right, group, key):
    """Join on group and key, where a null group is a group of its own."""
    right = right.withColumnsRenamed({group: "__its_group", key: "__its_key"})
    match = F.col(group).eqNullSafe(F.col("__its_group")) & (F.col(key) == F.col("__its_key"))
    return left.join(right, match).drop("__its_group", "__its_key")


def number_within(
    df: DataFrame,
    group: str,
    key: str,
    ties: Sequence[str] = (),
    out: str = "position",
    start: int = 0,
    width: int = 65_536,
) -> DataFrame:
    """Number the rows of each group from ``start``, in the order of an integer key and ``ties``.

    A group may hold most of the table, so it is numbered in key ranges of ``width``: a range's rows
    are numbered on their own, then shifted by the row count of the group's earlier ranges. If the
    key is unique in its group, no task has to sort more than ``width`` rows of a group, however the
    keys are spread. Rows with a null group are one more group; a null key is an error.
    """
    keyed = df.withColumn("__range", _range_start(key, width))
    counts = settled(keyed.groupBy(group, "__range").agg(F.count("*").alias("__rows")), "counts")
    ends = counts.agg(F.min("__range").alias("least"), F.max("__range").alias("most"),
                      F.sum(F.when(F.col("__range").isNull(), F.col("__rows"))).alias("nulls")).first()
    if ends["nulls"]:
        raise ValueError(f"{ends['nulls']} rows have no {key!r} to number them by")
    ranges = 1 if ends["least"] is None else (ends["most"] - ends["least"]) // width + 1
    levels = 1
    while ranges > width ** levels:
        levels += 1
    before = _rows_before(counts, group, width, width, levels)
    in_range = Window.partitionBy(group, "__range").orderBy(key, *ties)
    numbered = keyed.withColumn("__local", F.row_number().over(in_range))
    position = F.col("__local") + F.col("__before") + F.lit(start - 1)
    return (
        _same_group(numbered, before, group, "__range")
        .withColumn(out, position.cast("long"))
        .select(*df.columns, out)
    )


def range_sorted(df: DataFrame, *keys: str | Column) -> DataFrame:
    """Sort globally: key ranges over the partitions, rows sorted inside each."""
    return df.repartitionByRange(*keys).sortWithinPartitions(*keys)


def ids_as_written(df: DataFrame, id_col: str = "id", start: int = 1, path: str | None = None) -> DataFrame:
    """Dense ids in the present order of partitions and rows.

    The rows are written once; a row's id is its place in its file plus the row count of the files
    before. The files fix the order, so ids stay the same when a lost task is run again. Row counts
    come from the Parquet footers. Who gives the ``path`` to write to can delete it after use.
    """
    spark = df.sparkSession
    path = path or scratch_path(spark, "rows")
    df.write.option("maxRecordsPerFile", 0).parquet(path)
    written = spark.read.schema(df.schema).parquet(path)
    file = F.col("_metadata.file_name")
    files = written.groupBy(file.alias("__file")).agg(F.count("*").alias("__rows"))
    # One row per written file: a small window, whatever the table's size.
    part = F.regexp_extract("__file", r"part-(\d+)", 1).cast("long")
    earlier = Window.orderBy(part).rowsBetween(Window.unboundedPreceding, -1)
    offsets = files.select(
        "__file", F.coalesce(F.sum("__rows").over(earlier), F.lit(0)).alias("__offset")
    )
    if len(written.inputFiles()) <= BROADCAST_ROWS:
        offsets = F.broadcast(offsets)
    placed = written.select(
        *df.columns, file.alias("__file"), F.col("_metadata.row_index").alias("__row")
    )
    return placed.join(offsets, "__file").select(
        (F.col("__offset") + F.col("__row") + F.lit(start)).alias(id_col), *df.columns
    )


def dense_ids(df: DataFrame, *order: str, id_col: str = "id", start: int = 1) -> DataFrame:
    """Dense ids from ``start`` in the order of a unique key."""
    return ids_as_written(range_sorted(df, *order), id_col, start)
