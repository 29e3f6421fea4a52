"""Writers: overwrite, partitioned overwrite, registration, export."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession

SLOT_COLUMNS = ("hour_of_day", "day_of_week")


def overwrite(df: DataFrame, path: str) -> None:
    """Replace a flat table."""
    df.write.mode("overwrite").parquet(path)


def overwrite_partitioned(df: DataFrame, path: str, by: Sequence[str], dynamic: bool = False) -> None:
    """Replace a partitioned table, or with ``dynamic`` only the partitions in ``df``.

    The rebalance hint puts rows of one partition value together, so few files
    are written, and lets adaptive execution split a value that is too big for
    one task.
    """
    (
        df.hint("rebalance", *by)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic" if dynamic else "static")
        .partitionBy(*by)
        .parquet(path)
    )


def write_demand(df: DataFrame, path: str, dynamic: bool = False) -> None:
    """Demand windows, one folder per date."""
    overwrite_partitioned(df, path, ["window_start_date"], dynamic)


def write_slots(df: DataFrame, path: str) -> None:
    """A table keyed by hour and day of week, one folder per slot."""
    overwrite_partitioned(df, path, SLOT_COLUMNS)


def quoted_part(name: str) -> str:
    return f"`{name.replace('`', '``')}`"


def quoted(name: str) -> str:
    return ".".join(quoted_part(part) for part in name.split("."))


def _location(path: str) -> str:
    return path.replace("\\", "\\\\").replace("'", "\\'")


def described(spark: SparkSession, name: str) -> dict[str, str]:
    return {row[0]: row[1] for row in spark.sql(f"DESCRIBE TABLE EXTENDED {quoted(name)}").collect()}


def same_layout(spark: SparkSession, name: str, path: str) -> bool:
    """Whether the files at ``path`` have the columns of table ``name``, which lists its folders when it is read."""
    if described(spark, name).get("Partition Provider") == "Catalog":
        return False
    new = spark.read.parquet(path)
    by = [column.name for column in spark.catalog.listColumns(name) if column.isPartition]
    files = [f for f in new.inputFiles()[:1]]
    return spark.table(name).dtypes == new.dtypes and all(f"/{column}=" in f for column in by for f in files)


def refuse_unless_external(spark: SparkSession, name: str) -> None:
    kind = spark.catalog.getTable(name).tableType
    if kind != "EXTERNAL":
        raise ValueError(f"{name} is {kind}, not an external table; it is left as it is")


def move(spark: SparkSession, name: str, path: str) -> DataFrame:
    """Point an external table to another folder of the same layout."""
    spark.sql(f"ALTER TABLE {quoted(name)} SET LOCATION '{_location(path)}'")
    spark.catalog.refreshTable(name)
    return spark.table(name)


def create(spark: SparkSession, statement: str, path: str) -> None:
    """Run a CREATE TABLE statement for the files at ``path``; the table lists its folders when it is read."""
    listed = "spark.sql.hive.manageFilesourcePartitions"
    before = spark.conf.get(listed)
    spark.conf.set(listed, "false")
    try:
        spark.sql(f"{statement} LOCATION '{_location(path)}'")
    finally:
        spark.conf.set(listed, before)


def register(spark: SparkSession, name: str, path: str) -> DataFrame:
    """Make the Parquet table at ``path`` known by name, replacing an older registration of this kind.

    The data is external: an older registration is forgotten, its files stay.
    Where the columns are the same, one change of the table's location does it,
    so there is no moment without the table; folders of partitions are found
    there when the table is read. Other columns need a new table. A name that
    stands for anything else, such as a managed table or a view, is refused,
    since replacing that would delete data.
    """
    if spark.catalog.tableExists(name):
        refuse_unless_external(spark, name)
        if same_layout(spark, name, path):
            return move(spark, name, path)
        spark.sql(f"DROP TABLE {quoted(name)}")
    create(spark, f"CREATE TABLE {quoted(name)} USING parquet", path)
    return spark.table(name)


def export(tables: Mapping[str, DataFrame], base: str) -> dict[str, str]:
    """Write each table under ``base``; tables with slot columns are partitioned by them."""
    written = {}
    for name, df in tables.items():
        path = f"{base}/{name}"
        if set(SLOT_COLUMNS) <= set(df.columns):
            write_slots(df, path)
        else:
            overwrite(df, path)
        written[name] = path
    return written
