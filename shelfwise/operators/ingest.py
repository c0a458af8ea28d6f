"""Config-driven batch ingest with an audit table.

One declarative spec per feed (prefix, column types, keys). A feed's files are
numbered by name and read in one scan per kind of header, united by column
name; the stored table counts as file 0. Keyed feeds apply the files one after
another (delete + append per file, in one pass over all rows); un-keyed feeds
take the rows of the last file (K12). The loop runs over the few feed specs on
the driver; all row work is Spark jobs.

The published version is written in one job, which also yields the counts of the
audit as metrics in flight.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from shelfwise.operators.schema import widen
from shelfwise.operators.upsert import conform, merge_numbered
from shelfwise.session import stage_table
from shelfwise.sources import files as FS
from shelfwise.sources import sinks as SK


@dataclass
class FeedSpec:
    name: str                       # target table name
    prefix: str                     # case-insensitive file name prefix
    types: dict = field(default_factory=dict)
    dates: tuple = ()
    keys: tuple = ()                # empty: un-keyed, the last file replaces the table
    rename: dict = field(default_factory=dict)
    steps: tuple = ()               # DataFrame -> DataFrame steps after typing (they see ``_file`` and ``_row``)
    widen: dict = field(default_factory=dict)   # stored columns to widen before new rows are appended (P9)
    header_row: int = 1             # above 1: a sheet's export whose header sits there (S9)
    expected_rows: tuple = ()       # (least, most) rows of a file after the steps; beyond them the audit warns


#: Most files of a feed whose rows are counted in flight.
OBSERVED = 200

AUDIT = ("feed string, file string, rows_removed bigint, rows_added bigint, final_row_count bigint, "
         "version string, backup_version string, conditions string, error string, warning string")


def numbered(df: DataFrame, names: list[str], file_col: str = "_file", number: str = "_n") -> DataFrame:
    """Replace the file name column by the file's place in the sorted names
    (a name that is not listed is an error)."""
    place = F.nullif(F.array_position(F.array(*map(F.lit, names)), F.col(file_col)), F.lit(0)).cast("int")
    place = F.coalesce(place, F.raise_error(F.concat(F.lit("rows of a file that is not listed: "), F.col(file_col))).cast("int"))
    return df.withColumn(number, place).drop(file_col)


def counted(marked: DataFrame, files: int, name: str) -> tuple[DataFrame, Callable[[], tuple[dict, dict]]]:
    """``marked`` with counts taken while it is written, and a call that gives
    them afterwards: rows each file (0: the stored table) added, and rows each
    removed. The counts are metrics of the stage that writes, whose tasks count
    once however often they are retried, so one job writes and counts.

    One metric holds a counter per file; from OBSERVED files on, the rows are
    written to the shared folder first and counted there."""
    if files > OBSERVED:
        marked = stage_table(marked)
        sums = [marked.groupBy(c).agg(F.count("*")).where(f"{c} IS NOT NULL") for c in ("_n", "_gone")]
        return marked, lambda: tuple({r[0]: r[1] for r in x.collect()} for x in sums)
    seen = Observation(f"ingest {name}")
    each = [F.count_if(F.col("_n") == n).alias(f"added{n}") for n in range(files + 1)]
    each += [F.count_if(F.col("_gone") == n).alias(f"gone{n}") for n in range(1, files + 1)]

    def counts():
        got = seen.get
        return ({n: got[f"added{n}"] for n in range(files + 1)}, {n: got[f"gone{n}"] for n in range(1, files + 1)})
    return marked.observe(seen, *each), counts


def range_warning(spec: FeedSpec, rows: int) -> str | None:
    """C14: what the audit says of a file with fewer or more rows than its feed should have."""
    if not spec.expected_rows or spec.expected_rows[0] <= rows <= spec.expected_rows[1]:
        return None
    return f"expected {spec.expected_rows[0]} to {spec.expected_rows[1]} rows, got {rows}"


def ingest_feed(spark: SparkSession, drop_dir: str, tables_dir: str, spec: FeedSpec,
                conditions: dict | None = None, match: str = "cross") -> list[tuple]:
    """One feed: publish its merged table, return one audit row per file."""
    target = f"{tables_dir}/{spec.name}"
    found = FS.list_files(spark, f"{drop_dir}/{FS.any_case_glob(spec.prefix, '.csv')}")
    if not found:
        return [(spec.name, None, 0, 0, None, None, None, None, "no files", None)]
    paths = [p for p, _ in found]
    if spec.header_row > 1:
        batch = FS.read_preamble_csv(spark, paths, spec.header_row, with_file=True)
    else:
        batch = FS.read_csv_by_name(spark, paths, "_file", "_row")
    batch = FS.apply_spec(batch.withColumnsRenamed(spec.rename), spec.types, spec.dates)
    step: Callable[[DataFrame], DataFrame]
    for step in spec.steps:
        batch = step(batch)
    batch = batch.drop("_row")
    names = sorted({n for _, n in found})
    batch = numbered(batch, names)
    backup = SK.current_version(spark, target)
    stored = SK.read_published(spark, target) if spec.keys else None
    if stored is not None:
        stored = widen(stored, spec.widen)
        batch = conform(batch, stored.schema)
    if spec.keys:
        marked = merge_numbered(stored, batch, list(spec.keys), "_n", match, conditions)
    else:
        marked = batch.withColumn("_gone", F.when(F.col("_n") < len(names), F.col("_n") + 1))
    marked, counts = counted(marked, len(names), spec.name)
    version = SK.publish(marked.where("_gone IS NULL").drop("_n", "_gone"), target)
    added, gone = counts()
    audit, rows = [], added.get(0, 0)
    used = None if conditions is None else str(conditions)
    for n, name in enumerate(names, 1):
        rows += added.get(n, 0) - gone.get(n, 0)
        audit.append((spec.name, name, gone.get(n, 0), added.get(n, 0), rows, version, backup, used, None,
                      range_warning(spec, added.get(n, 0))))
    return audit


def ingest(spark: SparkSession, drop_dir: str, tables_dir: str, specs: list[FeedSpec],
           conditions: dict | None = None, match: str = "cross") -> DataFrame:
    """C14: run every feed and return the audit table: per file the rows it
    removed and added and the table's row count after it, the published
    version, the version before it (the backup), the conditions, the error, and a
    warning where a file's rows lie outside the feed's ``expected_rows`` (it is
    published all the same)."""
    audit = []
    for spec in specs:
        try:
            audit += ingest_feed(spark, drop_dir, tables_dir, spec, conditions.get(spec.name) if conditions else None, match)
        except Exception as e:          # one failing feed is reported, the others still run
            audit.append((spec.name, None, 0, 0, None, None, None, None, str(e), None))
    return spark.createDataFrame(audit, AUDIT)
