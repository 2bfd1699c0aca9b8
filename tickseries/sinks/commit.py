"""Several tables changed in one step that can be taken up again after a crash.

The new partitions of all tables are first written aside. One log entry then names them; only after it are the
partitions of the tables replaced, and a second entry closes the commit. A crash before the first entry leaves all tables
as they were; after a crash behind it, `recover` replaces the partitions again, which ends in the same tables. One writer at a time.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickseries.sinks.parquet import existing, replace_partitions
from tickseries.sources.csv import under

COMMITS = "_commits"
_STAGED = "_staged"
_LOG = "commit string, state string, at string, table string, columns array<string>, partition_by array<string>, sort_by array<string>"
PENDING, DONE = "pending", "done"


class Commit:
    def __init__(self, spark: SparkSession, root: str, name: str):
        self.spark, self.root, self.name = spark, root, name
        # A run that is repeated must not write into what an earlier one has logged.
        self.home = under(root, f"{_STAGED}/{uuid.uuid4().hex}")
        self.entries: list[tuple] = []

    def add(self, table: str, rows: DataFrame, partition_by: Sequence[str], sort_by: Sequence[str] = (), aside: Sequence[str] = ()) -> DataFrame:
        """Write the new partitions of a table aside and return them, read back. The columns `aside` are written but do not reach the table."""
        at = f"{self.home}/{table}"
        rows.write.parquet(at)
        columns = [c for c in rows.columns if c not in aside]
        self.entries.append((self.name, PENDING, at, table, columns, list(partition_by), list(sort_by)))
        return self.spark.read.schema(rows.schema).parquet(at)

    def apply(self) -> None:
        """Replace the partitions of all tables."""
        _log(self.spark, self.root, self.entries)
        _finish(self.spark, self.root, self.entries)


def _log(spark: SparkSession, root: str, entries: Sequence[tuple]) -> None:
    """One file, so that the entries of a commit are there together or not at all."""
    spark.createDataFrame(list(entries), _LOG).coalesce(1).write.mode("append").parquet(under(root, COMMITS))


def _finish(spark: SparkSession, root: str, entries: Sequence[tuple]) -> None:
    for _, _, at, table, columns, partition_by, sort_by in entries:
        rows = spark.read.parquet(at).select(*[F.col(f"`{c}`") for c in columns])
        replace_partitions(rows, under(root, table), partition_by, sort_by)
    _log(spark, root, [(name, DONE, *rest) for name, _, *rest in entries[:1]])
    for _, _, at, *_ in entries:  # the tables have it now
        spark.createDataFrame([], "done boolean").write.mode("overwrite").parquet(at)


def _logged(spark: SparkSession, root: str) -> DataFrame | None:
    return existing(spark, under(root, COMMITS), spark.createDataFrame([], _LOG).schema)


def recover(spark: SparkSession, root: str) -> list[str]:
    """Finish the commits that a crash has left open; returns their names. To be called before a table is read for a new commit."""
    log = _logged(spark, root)
    if log is None:
        return []
    # Commits are told apart by where they lie: a name may be used again after a crash.
    home = F.regexp_replace("at", "/[^/]*$", "")
    closed = log.where(F.col("state") == DONE).select(home.alias("_home"))
    left = log.withColumn("_home", home).join(closed, "_home", "left_anti").drop("_home").collect()  # a handful at most
    by_home: dict[str, list[tuple]] = {}
    for row in left:
        by_home.setdefault(row["at"].rpartition("/")[0], []).append(tuple(row))
    for entries in by_home.values():
        _finish(spark, root, entries)
    return sorted({entries[0][0] for entries in by_home.values()})


def is_done(spark: SparkSession, root: str, name: str) -> bool:
    """Whether a commit of this name has changed the tables."""
    log = _logged(spark, root)
    return log is not None and not log.where((F.col("commit") == name) & (F.col("state") == DONE)).isEmpty()
