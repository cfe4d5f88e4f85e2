"""Reading the company table and the page store."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window, functions as F, types as T

from callsheet import dims
from callsheet.functions.stages import stored
from callsheet.functions.text import blank_row


def string_schema(*columns: str) -> T.StructType:
    return T.StructType([T.StructField(c, T.StringType()) for c in columns])


def read_csv(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """CSV with a header; every column as declared, nothing inferred. A quoted cell may
    hold line breaks and doubled quotes, so a file is read by one task; ``scan_csv`` reads
    one file by many."""
    return (spark.read.schema(schema).option("header", True).option("multiLine", True)
            .option("escape", '"').csv(path))


def scan_csv(spark: SparkSession, path: str, schema: T.StructType, name: str = "input_row_id") -> DataFrame:
    """The rows of ``read_csv`` with their dense 0-based position, one large file read by many tasks.

    Files are read as lines in byte ranges. Whether a line opens a record depends on the
    number of quotes before it, odd or even: each range counts its own and the record starts
    for either case, the ranges' parities are added up in order, and only lines of records
    that go over several lines are brought together. A quote stands at the border of a cell
    or doubled inside one; blank lines between records are skipped; each file has a header."""
    lines = spark.read.option("lineSep", "\n").text(path).select(
        "value", F.col("_metadata.file_path").alias("_path"), F.col("_metadata.file_block_start").alias("_range"),
        F.monotonically_increasing_id().alias("_id"))
    held = stored(lines.withColumn("_quotes", F.pmod(F.length("value") - F.length(F.translate("value", '"', "")), F.lit(2))),
                  "csv-lines")
    of_range = Window.partitionBy("_path", "_range").orderBy("_id")
    until = of_range.rowsBetween(Window.unboundedPreceding, -1)
    marked = held.withColumn("_odd", F.coalesce(F.sum("_quotes").over(until), F.lit(0)) % 2).withColumn(
        "_full", ~F.col("value").isin("", "\r"))
    counts = marked.groupBy("_path", "_range").agg(
        (F.sum("_quotes") % 2).alias("odd"), F.count_if((F.col("_odd") == 0) & F.col("_full")).alias("even_starts"),
        F.count_if((F.col("_odd") == 1) & F.col("_full")).alias("odd_starts"))
    # One row per range of a file from here on, until the lines are met again.
    before = Window.partitionBy("_path").orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    entered = counts.withColumn("_open", F.coalesce(F.sum("odd").over(before), F.lit(0)) % 2).withColumn(
        "_starts", F.when(F.col("_open") == 0, F.col("even_starts")).otherwise(F.col("odd_starts")))
    ranges = stored(entered.select("_path", "_range", "_open", "_starts", F.coalesce(F.sum("_starts").over(before), F.lit(0)).alias("_first")), "csv-ranges")
    inside = (F.col("_odd") + F.col("_open")) % 2 == 1
    opened = marked.join(ranges.select("_path", "_range", "_open", "_first"), ["_path", "_range"]).withColumn(
        "_begins", ~inside & F.col("_full")).filter(inside | F.col("_begins"))
    numbered = opened.withColumn("_record", F.col("_first") + F.sum(F.col("_begins").cast("long")).over(
        of_range.rowsBetween(Window.unboundedPreceding, Window.currentRow)) - 1)
    alone = F.col("_begins") & (F.col("_quotes") == 0)
    pieces = F.transform(F.array_sort(F.collect_list(F.struct("_range", "_id", "value"))), lambda x: x["value"])
    several = numbered.filter(~alone).groupBy("_path", "_record").agg(F.array_join(pieces, "\n").alias("value"))
    records = numbered.filter(alone).select("_path", "_record", "value").unionByName(several).filter("_record > 0")
    files = ranges.groupBy("_path").agg((F.sum("_starts") - 1).alias("_n")).select("_path", (F.coalesce(F.sum("_n").over(
        Window.orderBy("_path").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)) - 1).alias("_shift"))
    columns = ", ".join(f"`{f.name.replace('`', '``')}` {f.dataType.simpleString()}" for f in schema.fields)
    row = F.from_csv(F.regexp_replace("value", "\r$", ""), columns, {"escape": '"'})
    return records.join(files, "_path").select((F.col("_record") + F.col("_shift")).alias(name), row.alias("_row")).select(name, "_row.*")


def read_json(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    return spark.read.schema(schema).json(path)


def read_parquet(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def kind(path: str) -> str:
    """Format of a table by the end of its path; Parquet unless it says otherwise."""
    end = path.rstrip("/").lower()
    return next((k for k in ("csv", "json") if end.endswith("." + k)), "parquet")


def header(spark: SparkSession, path: str) -> T.StructType:
    """Columns of a CSV file by its header, all text."""
    return string_schema(*spark.read.option("header", True).csv(path).columns)


def read_table(spark: SparkSession, path: str) -> DataFrame:
    """A table of any supported format; CSV columns are named by the header, all text."""
    if kind(path) == "csv":
        return read_csv(spark, path, header(spark, path))
    return spark.read.json(path) if kind(path) == "json" else read_parquet(spark, path)


def read_pages(spark: SparkSession, path: str) -> DataFrame:
    """Page store: one row per page with its HTML or text as a column."""
    return spark.read.parquet(path)


def apply_profile(df: DataFrame, profile: str = "default", profiles=None) -> DataFrame:
    """Rename the columns a profile knows; an unknown profile means ``default``."""
    profiles = profiles or dims.INPUT_PROFILES
    names = profiles.get(profile, profiles["default"])
    return df.withColumnsRenamed({k: v for k, v in names.items() if k in df.columns})


def with_defaults(df: DataFrame, run_id: str) -> DataFrame:
    """Add the working columns that the input lacks."""
    none = F.lit(None).cast("string")
    pending = F.lit("Pending")
    defaults = {
        "CompanyName": none, "GivenURL": none, "GivenPhoneNumber": none, "Description": none,
        "NormalizedGivenPhoneNumber": none, "ScrapingStatus": pending,
        "Overall_VerificationStatus": pending, "Original_Number_Status": pending,
        "TargetCountryCodes": F.array(*[F.lit(c) for c in dims.DEFAULT_TARGET_COUNTRIES]),
        "RunID": F.lit(run_id),
    }
    return df.withColumns({k: v for k, v in defaults.items() if k not in df.columns})


def parse_row_range(text: str | None) -> tuple[int, int | None]:
    """``N-M``, ``N-``, ``-M`` or ``N`` as (rows to skip, rows to take or None).
    Anything else, and ``0``, means all rows."""
    everything = (0, None)
    text = (text or "").strip()
    left, dash, right = (p.strip() for p in text.partition("-"))
    number = lambda s: int(s) if s.isdigit() else None
    if not dash:
        return (0, number(left)) if number(left) else everything
    first, last = number(left), number(right)
    if first:
        if right == "":
            return first - 1, None
        if last is None:
            return first - 1, None
        return (first - 1, last - first + 1) if last >= first else everything
    return (0, last) if left == "" and last else everything


def with_ordinal(df: DataFrame, name: str = "input_row_id") -> DataFrame:
    """Dense 0-based position: files by path, rows by their place in the file.

    ``df`` reads Parquet files, so that each row knows its file and place; text files do
    not, their rows need a stored id. Rows per file are counted, and the file's start is
    joined by its path; only that table (one row per file) is ordered as a whole."""
    local = df.select("*", F.col("_metadata.file_path").alias("_path"), F.col("_metadata.row_index").alias("_pos"))
    sizes = local.groupBy("_path").agg((F.max("_pos") + 1).alias("_n"))
    before = Window.orderBy("_path").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("_path", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    return (local.join(starts, "_path")
            .withColumn(name, F.col("_start") + F.col("_pos")).drop("_path", "_pos", "_start"))


def with_text_ordinal(df: DataFrame, name: str = "input_row_id") -> DataFrame:
    """Dense 0-based position of rows in text files: files by path, rows by place.

    Each file must be read by one task, as ``read_csv`` does. The rows are written with a
    rising number first, so that file starts and rows refer to the same reading."""
    local = stored(df.select("*", F.col("_metadata.file_path").alias("_path"),
                             F.monotonically_increasing_id().alias("_id")), "input-rows")
    sizes = local.groupBy("_path").agg(F.min("_id").alias("_first"), F.count(F.lit(1)).alias("_n"))
    before = Window.orderBy("_path").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("_path", (F.coalesce(F.sum("_n").over(before), F.lit(0)) - F.col("_first")).alias("_shift"))
    return local.join(starts, "_path").withColumn(name, F.col("_id") + F.col("_shift")).drop("_path", "_id", "_shift")


def row_range(df: DataFrame, text: str | None, ordinal: str = "input_row_id") -> DataFrame:
    """Rows of a range, by a stored 0-based ordinal: a plain pushed-down filter."""
    skip, take = parse_row_range(text)
    out = df.filter(F.col(ordinal) >= skip) if skip else df
    return out.filter(F.col(ordinal) < skip + take) if take is not None else out


def blank_run_starts(df: DataFrame, cells: list[str], k: int = 3,
                     ordinal: str = "input_row_id") -> DataFrame:
    """Every place ``start`` where ``k`` blank rows in a row begin.

    A run is found without ordering the table: every blank row votes for the ``k``
    places a run containing it may start at; a place with ``k`` votes is one."""
    blank = blank_row(*[F.col(c) for c in cells])
    votes = df.filter(blank).select(
        F.explode(F.sequence(F.col(ordinal) - (k - 1), F.col(ordinal))).alias("start"))
    return votes.groupBy("start").agg(F.count(F.lit(1)).alias("n")).filter(
        F.col("n") == k).select("start")


def stop_after_blanks(df: DataFrame, cells: list[str], k: int = 3,
                      ordinal: str = "input_row_id") -> DataFrame:
    """Non-blank rows before the first run of ``k`` blank rows (k<=0: all rows). The
    first run's place is a scalar that filters the table."""
    if k <= 0:
        return df
    blank = blank_row(*[F.col(c) for c in cells])
    stop = blank_run_starts(df, cells, k, ordinal).agg(F.min("start").alias("stop"))
    return df.filter(~blank & F.coalesce(F.col(ordinal) < stop.scalar(), F.lit(True)))


def load_input(df: DataFrame, cells: list[str], profile: str = "default", rows: str | None = None,
               stop_after_blank: int = 3, run_id: str = "run", ordinal: str = "input_row_id") -> DataFrame:
    """Range, blank stop, profile and defaults in one go. A fixed number of rows
    turns the blank stop off; counting of blanks starts after the skipped rows."""
    _, take = parse_row_range(rows)
    out = row_range(df, rows, ordinal)
    if take is None:
        out = stop_after_blanks(out, cells, stop_after_blank, ordinal)
    return with_defaults(apply_profile(out, profile), run_id)
