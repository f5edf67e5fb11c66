"""Table writes: replace, append, ordered loads and per-file replacement."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rosterflow.functions.geo import point
from rosterflow.operators.joins import non_members, small_side
from rosterflow.session import materialise


def target(location: str, name: str) -> str:
    """Address of a table: joined to a folder by one slash, to a catalog prefix that ends in a dot as it is."""
    return location + name if not location or location.endswith(".") else f"{location.rstrip('/')}/{name}"


def write_table(
    df: DataFrame, table: str, *, append: bool = False, partition_by: Sequence[str] = (), options: Mapping[str, str] | None = None
) -> None:
    """Write a catalog table, a parquet folder when ``table`` is a path, or a database
    table when it is a JDBC address with the table's name after its last slash. Replacing
    drops every year the table held. ``options`` go to the database connection."""
    if table.startswith("jdbc:"):
        url, _, name = table.rpartition("/")
        write_jdbc(df, url, name, append=append, **(options or {}))
        return
    writer = df.write.mode("append" if append else "overwrite").partitionBy(*partition_by)
    if "/" in table:
        writer.parquet(table)
    else:
        writer.saveAsTable(table)


def write_jdbc(df: DataFrame, url: str, table: str, *, append: bool = False, batch_size: int = 10_000, **options) -> None:
    """Write to a database table over JDBC; every partition is one connection."""
    df.write.mode("append" if append else "overwrite").options(batchsize=batch_size, **options).jdbc(url, table)


def write_tables(
    tables: Mapping[str, DataFrame],
    order: Sequence[str],
    location: str = "",
    *,
    append: bool = False,
    options: Mapping[str, str] | None = None,
) -> list[str]:
    """Load tables in order and return the names written. An empty table is skipped,
    so what it held before stays. ``location`` is a folder, a catalog prefix or a JDBC address."""
    written = []
    for name in order:
        if name in tables and not tables[name].isEmpty():
            write_table(tables[name], target(location, name), append=append, options=options)
            written.append(name)
    return written


def with_point(df: DataFrame, lon: str, lat: str, out: str) -> DataFrame:
    """Add the point of a coordinate pair before the write, instead of a second pass."""
    return df.withColumn(out, point(F.col(lon), F.col(lat)))


def with_write_times(df: DataFrame, now: datetime | None = None) -> DataFrame:
    """Rows with the time of their load; rows that replace others are new ones."""
    at = F.lit(now or datetime.now(timezone.utc))
    return df.withColumns({"created_at": at, "updated_at": at})


def replace_files(
    df: DataFrame, path: str, file_ids: DataFrame, key: str = "source_file_id", *, scattered: bool = True
) -> DataFrame:
    """Replace all rows of the given files in a table partitioned by file.

    ``df`` is evaluated once, by the write; rows are counted in the partitions that it has
    written, by the time of the load. ``file_ids`` (one ``key`` column) names every file of the
    load, also those that now have no rows: their old rows are replaced by one row without
    write times, which ``stored_files`` leaves out. So all partitions of the load, and no
    others, are replaced, and a crash leaves old rows or new ones of a file. Loading the
    same files again gives the same table. Rows carry the load time in ``created_at`` and
    ``updated_at``; returns ``key, rows``.

    ``scattered`` rows are gathered by file first, where adaptive execution spreads
    a heavy file over tasks; turn it off when tasks already hold whole files.
    """
    spark, now = df.sparkSession, datetime.now(timezone.utc)
    rows = with_write_times(df, now)
    _replace_partitions(rows.hint("rebalance", F.col(key)) if scattered else rows, path, key)
    files = small_side(materialise(file_ids.select(F.col(key).cast(df.schema[key].dataType)).distinct(), "loaded-files"))
    written = spark.read.schema(rows.schema).parquet(path).filter(F.col("created_at") == F.lit(now)).join(files, key, "left_semi")
    counts = written.groupBy(key).agg(F.count(F.lit(1)).alias("n"))
    result = materialise(files.join(counts, key, "left").select(key, F.coalesce("n", F.lit(0)).alias("rows")), "file-counts")
    without = result.filter("rows = 0")
    if not without.isEmpty():
        nothing = [F.col(key) if f.name == key else F.lit(None).cast(f.dataType).alias(f.name) for f in rows.schema]
        _replace_partitions(without.select(*nothing), path, key)
    return result


def _replace_partitions(rows: DataFrame, path: str, key: str) -> None:
    rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(key).parquet(path)


def stored_files(spark: SparkSession, path: str) -> DataFrame:
    """Rows of a table that is replaced by file."""
    return spark.read.parquet(path).filter(F.col("updated_at").isNotNull())


def replaced_rows(old: DataFrame, new: DataFrame, file_ids: DataFrame, key: str) -> DataFrame:
    """What a table holds after the replacement, as a frame."""
    return non_members(old, file_ids, [key]).unionByName(new)
