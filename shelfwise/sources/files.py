"""Sources: typed feed scans, file discovery and
selection, preamble sheets, HTML price-list tables and header fields.

File selection works on DataFrames of file names (from a binaryFile listing
or ``_metadata.file_name``), so discovery runs on the cluster and nothing is
looped over on the driver.
"""

from __future__ import annotations

import csv
import re
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfwise.functions import scalars as S
from shelfwise.functions.dates import with_dates
from shelfwise.session import stage_table
from shelfwise.sources import grids as G

# Fixed values from the reference.
STORE_LIST_DATE_PATTERN = r"Team Territory Store List (\d{1,2})\.(\d{1,2})\.(\d{4})\.xlsx"
DESCRIPTION_PATTERN = r"Description\s*:\s*(.+)"
PRICE_LIST_COLUMNS = [
    "UPC", "UPC +", "UPC Inner Pack I25", "UPC Standard Pack I25", "Item", "Life Cycle", "Description",
    "Customer Item", "PPC / ICC", "UOM", "Net Price", "List Price", "End Date", "Std Pk (SPW)",
    "Inner Pk (IPW)", "Ctns per Tier", "Tiers per Pallet", "Length", "Height", "Depth", "Cube", "Weight",
    "Pack Validation", "Nafta", "COO"]


# ---------------------------------------------------------------- S1
def read_table(spark: SparkSession, path: str, columns: Sequence[str] | None = None) -> DataFrame:
    """Parquet scan; projection and filters applied later still reach the scan."""
    df = spark.read.parquet(path)
    return df.select(*columns) if columns else df


# ---------------------------------------------------------------- S2 / S3
def apply_spec(df: DataFrame, spec: Mapping[str, str], dates: Sequence[str] = (), day_first: bool | None = None,
               file_col: str = "_file") -> DataFrame:
    """Type text columns by *name*: declared columns are try_cast (bad cell ->
    null, the row survives), date columns parsed leniently, undeclared
    columns kept as text. Unless ``day_first`` is given, the order of day and
    month is found for each date column, of each file if ``file_col`` is there."""
    if day_first is None:
        df = with_dates(df, dates, file_col if file_col in df.columns else None)
        dates = ()
    out = []
    for c in df.columns:
        col = F.col(f"`{c}`")
        if c in dates:
            out.append(S.to_timestamp_safe(col, day_first).alias(c))
        elif c in spec:
            out.append(col.cast("string").try_cast(spec[c]).alias(c))
        else:
            out.append(col)
    return df.select(*out)


def _hadoop(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def file_name() -> Column:
    """Name of the file a row was read from (the metadata column escapes blanks and the like)."""
    return F.url_decode(F.replace(F.col("_metadata.file_name"), F.lit("+"), F.lit("%2B")))


def list_files(spark: SparkSession, path: str) -> list[tuple[str, str]]:
    """(path, name) of a file, of a folder's files or of a glob's matches, by
    name. A listing of names only, as every scan makes one on the driver."""
    fs, p = _hadoop(spark, path)
    out = []
    for st in fs.globStatus(p) or []:
        for f in (fs.listStatus(st.getPath()) if st.isDirectory() else [st]):
            name = f.getPath().getName()
            if not f.isDirectory() and not name.startswith(("_", ".")):
                out.append((f.getPath().toString(), name))
    return sorted(out, key=lambda x: (x[1], x[0]))


def csv_header(spark: SparkSession, path: str, sep: str = ",") -> tuple[str, ...]:
    """Column names in a CSV file's first line."""
    fs, p = _hadoop(spark, path)
    reader = spark._jvm.java.io.BufferedReader(spark._jvm.java.io.InputStreamReader(fs.open(p), "UTF-8"))
    try:
        line = reader.readLine()
    finally:
        reader.close()
    return tuple(next(csv.reader([(line or "").lstrip("\ufeff")], delimiter=sep), ()))


def read_csv_by_name(spark: SparkSession, paths: Sequence[str], file_col: str | None = None,
                     row_col: str | None = None) -> DataFrame:
    """CSV files as text columns, united by column *name*: files with the same
    header are one scan, files with another header another (an explicit Spark
    CSV schema is positional). A column that a file lacks is null there.
    ``row_col`` orders the rows of one file as they stand in it."""
    groups: dict[tuple[str, ...], list[str]] = {}
    for p in paths:
        groups.setdefault(csv_header(spark, p), []).append(p)
    out = None
    for header, files in sorted(groups.items()):
        schema = T.StructType([T.StructField(h, T.StringType()) for h in header])
        df = (spark.read.schema(schema).option("header", True).option("mode", "PERMISSIVE").csv(files))
        if row_col:     # rows of a split are numbered upwards, splits by where they begin
            df = df.withColumn(row_col, F.struct(F.col("_metadata.file_block_start").alias("at"),
                                                 F.monotonically_increasing_id().alias("no")))
        if file_col:
            df = df.withColumn(file_col, file_name())
        out = df if out is None else out.unionByName(df, allowMissingColumns=True)
    if out is None:
        raise FileNotFoundError("no CSV files")
    return out


def read_feed(spark: SparkSession, path: str | Sequence[str], spec: Mapping[str, str],
              dates: Sequence[str] = (), required: Sequence[str] = (), header: bool = True,
              with_file: bool = False) -> DataFrame:
    """CSV with a header read as text, united and typed by column name."""
    if header:
        paths = [f for p in ([path] if isinstance(path, str) else path) for f, _ in list_files(spark, p)]
        df = read_csv_by_name(spark, paths, "_file" if with_file else None)
    else:
        df = spark.read.option("mode", "PERMISSIVE").csv(path)
        if with_file:
            df = df.withColumn("_file", file_name())
    miss = [c for c in required if c not in df.columns]
    if miss:
        raise ValueError(f"missing columns: {miss}")
    return apply_spec(df, spec, dates)


def any_case_glob(prefix: str, suffix: str = "") -> str:
    """Glob for names that start with ``prefix`` in any case and end with ``suffix``."""
    def one(c: str) -> str:
        return f"[{c.lower()}{c.upper()}]" if c.isalpha() and c.lower() != c.upper() else ("\\" + c if c in "*?[]{}\\" else c)
    return "".join(map(one, prefix)) + "*" + suffix


# ---------------------------------------------------------------- S4 / S5
def discover(spark: SparkSession, directory: str, prefix: str = "", suffix: str = "",
             contains: str = "", exclude: str | None = None) -> DataFrame:
    """Case-insensitive prefix / substring + extension match over a folder
    listing (binaryFile reads metadata only when content is not selected).
    Returns (path, file_name) sorted by name."""
    files = (spark.read.format("binaryFile").load(directory)
             .select("path").withColumn("file_name", F.regexp_extract("path", r"([^/]+)$", 1)))
    return select_files(files, prefix, suffix, contains, exclude)


def select_files(files: DataFrame, prefix: str = "", suffix: str = "", contains: str = "",
                 exclude: str | None = None, name: str = "file_name") -> DataFrame:
    n = F.lower(F.col(name))
    cond = F.lit(True)
    if prefix:
        cond &= n.startswith(prefix.lower())
    if suffix:
        cond &= F.col(name).endswith(suffix)
    if contains:
        cond &= n.contains(contains.lower())
    if exclude:
        cond &= ~n.contains(exclude.lower())
    return files.filter(cond).orderBy(name)


def last_match(files: DataFrame, name: str = "file_name") -> DataFrame:
    """When several files match, the last one by name wins (one row)."""
    return files.agg(F.max_by(F.struct(*[F.col(c) for c in files.columns]), F.col(name)).alias("f")) \
        .select("f.*")


# ---------------------------------------------------------------- S6
def name_date(name: Column, pattern: str = STORE_LIST_DATE_PATTERN) -> Column:
    """Date (M.D.YYYY) found in a file name; null when the name has none or
    the date is impossible."""
    m = F.regexp_extract(name, pattern, 1)
    d = F.regexp_extract(name, pattern, 2)
    y = F.regexp_extract(name, pattern, 3)
    ok = F.length(m) > 0
    return F.when(ok, F.try_make_timestamp_ntz(y.cast("int"), m.cast("int"), d.cast("int"),
                                               F.lit(0), F.lit(0), F.lit(0)).cast("date"))


def latest_by_name_date(files: DataFrame, name: str = "file_name",
                        pattern: str = STORE_LIST_DATE_PATTERN) -> DataFrame:
    """The newest file by the date in its name (names without a date are
    rejected). One row: file_name, file_date."""
    x = files.select(F.col(name).alias("file_name"), name_date(F.col(name), pattern).alias("file_date"))
    x = x.filter(F.col("file_date").isNotNull())
    return x.agg(F.max_by("file_name", F.struct("file_date", "file_name")).alias("file_name"),
                 F.max("file_date").alias("file_date"))


# ---------------------------------------------------------------- S7
def order_by_name_digits(files: DataFrame, name: str = "file_name") -> DataFrame:
    """Order files by the number made of all digits in their name."""
    return files.withColumn("name_number", F.regexp_replace(F.col(name), r"\D", "").try_cast("bigint")) \
        .orderBy("name_number", name)


# ---------------------------------------------------------------- S8 / U4
def union_feed(frames: Sequence[DataFrame], labels: Sequence[str] | None = None,
               label_col: str = "source_file") -> DataFrame:
    """Union all by column name, missing columns null-filled."""
    out = None
    for i, f in enumerate(frames):
        if labels is not None:
            f = f.withColumn(label_col, F.lit(labels[i]))
        out = f if out is None else out.unionByName(f, allowMissingColumns=True)
    return out


# ---------------------------------------------------------------- S9
def split_line(line: Column, sep: str = ",") -> Column:
    """Fields of one CSV line: quoted fields may hold the separator, doubled
    quotes stand for one, a carriage return at the end goes."""
    q = re.escape(sep)
    field = rf'(?:^|{q})("(?:[^"]|"")*"[^{q}]*|[^{q}]*)'
    parts = F.regexp_extract_all(F.regexp_replace(line, "\r$", ""), F.lit(field), F.lit(1))
    return F.transform(parts, lambda x: F.when(
        x.startswith('"'), F.replace(F.regexp_replace(x, r'^"|"$', ""), F.lit('""'), F.lit('"'))).otherwise(x))


def preamble_rows(df: DataFrame, id_col: str, text_col: str, header_row: int,
                  sep: str = ",") -> DataFrame:
    """S9 on whole texts: split into lines, the line at `header_row` (1-based)
    is the header, later lines are data rows whose fields are cut to the
    header width. The header is taken from the same text before the lines
    are exploded, so no join or shuffle is needed, however long a text is."""
    lines = F.split(F.col(text_col), "\n")
    x = df.select(id_col, F.regexp_replace(F.try_element_at(lines, F.lit(header_row)), "\r$", "").alias("header"),
                  F.posexplode(lines).alias("pos", "line"))
    x = x.withColumn("row_no", F.col("pos") + 1).drop("pos")
    x = x.filter((F.col("row_no") > header_row) & F.col("header").isNotNull())
    width = F.size(split_line(F.col("header"), sep))
    fields = split_line(F.col("line"), sep)
    return x.withColumns({
        "fields": F.slice(fields, 1, width),
        "n_fields": F.least(F.size(fields), width),
    })


def numbered_lines(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    """(_file, row_no, line) of text files, numbered from 1 in each file, however
    large: files are read in splits; a first pass counts the lines of each split,
    the splits before give the offset. A place in a split is the distance from
    its first line's running number, which is the same in both passes since the
    same files make the same splits."""
    raw = (spark.read.option("lineSep", "\n").text(path if isinstance(path, str) else list(path))
           .select(F.regexp_replace("value", "\r$", "").alias("line"), F.col("_metadata.file_path").alias("_path"), file_name().alias("_file"),
                   F.col("_metadata.file_block_start").alias("_at"), F.monotonically_increasing_id().alias("_no")))
    splits = raw.groupBy("_path", "_at").agg(F.min("_no").alias("_first"), F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy("_path").orderBy("_at").rowsBetween(Window.unboundedPreceding, -1)
    splits = splits.withColumn("_before", F.coalesce(F.sum("_n").over(before), F.lit(0))).drop("_n")
    return raw.join(splits, ["_path", "_at"]).select("_path", "_file", (F.col("_before") + F.col("_no") - F.col("_first") + 1).alias("row_no"), "line")


def read_preamble_csv(spark: SparkSession, path: str | Sequence[str], header_row: int, sep: str = ",",
                      with_file: bool = False) -> DataFrame:
    """S9 for CSV exports of sheets whose header sits at row `header_row`. Every
    file keeps its own header: its cells become a map header -> cell, and the
    files are united by column name. Blank header cells get `_c<i>` names
    (K11). A blank line is a row of blanks, the empty text after a file's last
    line break is no line. Sheets are read line by line in splits, and a file's
    header is joined to its rows, so a sheet may be of any size."""
    lines = numbered_lines(spark, path)
    heads = lines.where(F.col("row_no") == header_row).select("_path", F.col("line").alias("header"))
    names = F.transform(split_line(F.col("header"), sep), lambda h, i: F.when(
        F.trim(h) == "", F.concat(F.lit("_c"), i.cast("string"))).otherwise(F.trim(h)))
    heads = stage_table(heads.withColumn("names", names).drop("header"))            # one row a file
    kinds = [r[0] for r in heads.select("names").distinct().collect()]              # one row a kind of sheet
    columns = list(dict.fromkeys(n for h in sorted(kinds) for n in h))
    if not columns:
        return spark.createDataFrame([], "dummy string").drop("dummy")
    rows = lines.where(F.col("row_no") > header_row).join(heads, "_path")
    fields = split_line(F.col("line"), sep)
    padded = F.transform(F.sequence(F.lit(1), F.size("names")), lambda i: F.coalesce(F.try_element_at(fields, i), F.lit("")))
    rows = rows.select("_file", "row_no", "names", padded.alias("cells"))
    cells = [F.try_element_at("cells", F.nullif(F.array_position("names", F.lit(n)), F.lit(0)).cast("int")).alias(n) for n in columns]
    if with_file:
        return rows.select(*cells, "_file", F.col("row_no").alias("_row"))
    return rows.orderBy("_file", "row_no").select(*cells)


# ---------------------------------------------------------------- S10 / S11
def html_tables(df: DataFrame, id_col: str, html_col: str, must_have: Sequence[str] = ("UPC", "Item"),
                keep: Sequence[str] = ()) -> DataFrame:
    """Rows of the first table per document whose header row holds all
    `must_have` names. Output: id, row_no, header (names of the columns) and
    cells, spanned cells in every place they cover (see :mod:`grids`). The
    table is chosen inside each row with array functions, so the operator is a
    pure map (no shuffle). Documents without such a table give no rows."""
    names = F.array(*[F.lit(m) for m in must_have])
    named = lambda g: F.transform(F.coalesce(F.get(g, F.lit(0)), F.array().cast("array<string>")), lambda h: F.trim(h))
    has_all = lambda g: F.size(F.array_except(names, named(g))) == 0
    # a table whose text lacks a name cannot be it; the others are laid out
    may = F.filter(G.tables(F.col(html_col)), lambda t: F.forall(names, lambda m: F.contains(G.text_of(t), m)))
    grids = F.filter(F.transform(may, lambda t: G.grid(G.cells(t))), has_all)

    def below(g, header):
        return F.transform(F.slice(g, F.lit(2), F.greatest(F.size(g) - 1, F.lit(0))), lambda c, i: F.struct(
            (i + 1).alias("row_no"), header.alias("header"), c.alias("cells")))
    # one expression, exploded as it is: tables and header are found once a document, not
    # again in a filter on them or for every row
    with_header = F.transform(F.slice(grids, 1, 1), lambda g: F.flatten(
        F.transform(F.array(G.header_names(named(g))), lambda header: below(g, header))))
    return df.select(id_col, *keep, F.inline(F.flatten(with_header)))


def html_rows(df: DataFrame, id_col: str, html_col: str, columns: Sequence[str],
              must_have: Sequence[str] = ("UPC", "Item"), strict: bool = False, keep: Sequence[str] = ()) -> DataFrame:
    """S10 + P2: named columns from the matched table (absent -> null,
    empty cell -> null). Documents without such a table: strict=True raises
    with their number (one count job); else see :func:`html_missing`, which
    reports them as rows."""
    t = html_tables(df, id_col, html_col, must_have, keep)
    if strict:
        missing = html_missing(df, id_col, html_col, must_have).agg(F.count("*"), F.min(id_col)).first()
        if missing[0]:
            raise RuntimeError(f"no table with {list(must_have)} in {missing[0]} documents, first {missing[1]}")
    out = [F.col(id_col), *[F.col(k) for k in keep], F.col("row_no")]
    for c in columns:
        pos = F.array_position("header", F.lit(c))
        v = F.when(pos > 0, F.try_element_at("cells", pos.cast("int")))
        out.append(F.nullif(v, F.lit("")).alias(c))
    return t.select(*out)


def html_missing(df: DataFrame, id_col: str, html_col: str, must_have: Sequence[str] = ("UPC", "Item")) -> DataFrame:
    """Ids of the documents without a table whose header holds all ``must_have``."""
    found = html_tables(df, id_col, html_col, must_have).select(F.col(id_col).alias("_found")).distinct()
    return df.select(id_col).join(found, F.col(id_col).eqNullSafe(F.col("_found")), "left_anti")


def html_row_maps(df: DataFrame, id_col: str, html_col: str,
                  must_have: Sequence[str] = ("UPC", "Item")) -> DataFrame:
    """S10 keeping every column of the table (K10: the reference keeps the
    columns it meant to exclude): one map header -> cell per row, so tables
    with different headers stay in one column without a driver-side schema."""
    t = html_tables(df, id_col, html_col, must_have)
    n = F.least(F.size("header"), F.size("cells"))
    return t.select(id_col, "row_no", F.map_from_arrays(
        F.slice("header", 1, n), F.transform(F.slice("cells", 1, n), lambda c: F.nullif(c, F.lit("")))
    ).alias("cells"))


def html_field(html: Column, pattern: str = DESCRIPTION_PATTERN, default: Column | None = None) -> Column:
    """A labelled header field from a document, tags stripped; the
    default (e.g. the file stem) when absent or blank."""
    v = F.trim(S.strip_tags(F.trim(F.regexp_extract(html, pattern, 1))))
    v = F.nullif(v, F.lit(""))
    return F.coalesce(v, default) if default is not None else v


# ---------------------------------------------------------------- S16
def last_file_rows(df: DataFrame, file_col: str = "_file") -> DataFrame:
    """For an un-keyed feed each delivered file replaces the one
    before, so only the rows of the last file by name count. The max name is
    a one-row aggregate broadcast back."""
    last = df.agg(F.max(file_col).alias("_last"))
    return df.join(F.broadcast(last), F.col(file_col) == F.col("_last"), "inner").drop("_last")
