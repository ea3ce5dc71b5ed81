"""Delimited text in and out, the table profile and the preview."""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from gradewise.functions import column
from gradewise.sources.scratch import scratch_path
from gradewise.sources.spanning import spanning_records

# Columns an export leaves out unless the caller says otherwise.
TECHNICAL_COLUMNS = frozenset({"features", "unscaled_features"})

# Spark's text formats stop at milliseconds; these keep all that a timestamp holds.
FULL_TIMESTAMPS = {
    "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss[.SSSSSS][XXX]",
    "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss[.SSSSSS]",
}

# Options that change what a cell or a line is; files read with them are not checked.
QUOTING_OPTIONS = frozenset(
    {
        "quote",
        "escape",
        "chartoescapequoteescaping",
        "comment",
        "encoding",
        "charset",
        "ignoreleadingwhitespace",
        "linesep",
        "unescapedquotehandling",
    }
)

# Options that choose files; the check of their content gets them too.
FILE_OPTIONS = frozenset(
    {
        "pathglobfilter",
        "recursivefilelookup",
        "modifiedbefore",
        "modifiedafter",
        "ignoremissingfiles",
        "ignorecorruptfiles",
        "basepath",
        "timezone",
    }
)

# How a file is read: by lines, by records put together from lines, or in one task.
IN_SPLITS, PUT_TOGETHER, WHOLE = "in splits", "put together", "whole"

# Putting records together takes several times the work of one task that reads a file whole.
MIN_SPLITS = 16

# Wider types of inferred columns, narrow ones first.
NUMBERS = ("int", "bigint", "double")


def read_delimited(
    spark: SparkSession,
    path: str,
    schema: StructType | str | None = None,
    sep: str = "\t",
    multi_line: bool | None = None,
    infer: bool = True,
    min_splits: int = MIN_SPLITS,
    **options,
) -> DataFrame:
    """Headered delimited files as a DataFrame; types are inferred when no schema is given.

    Inference reads the files once more. With ``infer=False`` all columns are text.

    Quoted cells may span lines, and Spark reads such a file in one task. So with
    ``multi_line=None`` all files are first checked in parallel, each by its content: those
    whose lines are records are read in splits. Of the others the records are put together
    split by split and stored (``spanning_records``), so that one large file takes many
    tasks too. Read whole are files of fewer than ``min_splits`` splits, which one task reads
    sooner, and files that leave unclear where a cell ends, hold carriage returns or lie in
    folders that name partitions. The rows are always those of reading every file whole. Names come from the first file that is read in
    splits, then from the first one put together.
    """
    reader = spark.read.options(header=True, sep=sep, **options)
    unusual = len(sep) > 1 or any(
        o.lower() in QUOTING_OPTIONS and (o.lower(), v) != ("linesep", "\n") for o, v in options.items()
    )
    chosen = {o: v for o, v in options.items() if o.lower() in FILE_OPTIONS}
    if multi_line is None and not unusual:
        groups = files_by_reading(spark, path, sep, chosen, min_splits)
    else:
        groups = [(path, WHOLE if multi_line is None or multi_line else IN_SPLITS)]
    format_options = {o: v for o, v in options.items() if o.lower() not in FILE_OPTIONS}
    if any(isinstance(files, list) for files, _ in groups):
        # The files are chosen; where folders name partitions, their columns stay.
        reader = spark.read.options(header=True, sep=sep).options(**format_options)
        if any(_in_partition(f) for files, _ in groups for f in files) and "recursivefilelookup" not in {
            o.lower() for o in options
        }:
            reader = reader.option("basePath", options.get("basePath", path))

    def read(files, how: str, types) -> DataFrame:
        if how == PUT_TOGETHER:
            return _parsed(together[0], reader, files, sep, format_options, types)
        one = reader.option("multiLine", how == WHOLE)
        return (one.option("inferSchema", types == "inferred") if isinstance(types, str) else one.schema(types)).csv(files)

    together = [None]
    for files, how in list(groups):
        if how == PUT_TOGETHER:
            together[0], left = spanning_records(spark, files, sep)
            groups.remove((files, how))
            sure = sorted(set(files) - set(left))
            groups += [(sure, how)] * bool(sure) + [(sorted(left), WHOLE)] * bool(left)
    whole = [f for files, how in groups if how == WHOLE and isinstance(files, list) for f in files]
    if whole:
        groups = [g for g in groups if g[1] != WHOLE] + [(sorted(whole), WHOLE)]

    if schema is not None:
        types = schema if isinstance(schema, StructType) else StructType.fromDDL(schema)
    else:
        types = "inferred" if infer else "text"
    if len(groups) > 1 and types == "inferred":
        types = _common_types([read(files, how, types) for files, how in groups])
    parts = [read(files, how, types) for files, how in groups]
    return reduce(DataFrame.unionAll, [p.toDF(*parts[0].columns) for p in parts])


def _in_partition(file: str) -> bool:
    return any("=" in part for part in file.split("/")[-3:-1])


def files_by_reading(
    spark: SparkSession, path: str, sep: str, options: dict, min_splits: int = MIN_SPLITS
) -> list[tuple[list[str] | str, str]]:
    """Which files to read in splits, to put together or to read whole, by one parallel pass."""
    lines = spark.read.options(**options).text(path, lineSep="\n")
    checked = (
        lines.groupBy(F.col("_metadata.file_path").alias("file"))
        .agg(
            F.bool_or(unclean_line(F.col("value"), sep)).alias("unclean"),
            F.bool_or(F.col("value").contains("\r")).alias("returns"),
            F.count_distinct("_metadata.file_block_start").alias("n_splits"),
        )
        .collect()  # one row per file, as many as the listing has
    )
    if not any(r["unclean"] for r in checked):  # the reader lists them itself
        return [(path, IN_SPLITS)]
    files: dict[str, list[str]] = {IN_SPLITS: [], PUT_TOGETHER: [], WHOLE: []}
    for r in checked:
        file = unquote(r["file"])
        together = r["n_splits"] >= min_splits and not r["returns"] and not _in_partition(file)
        how = IN_SPLITS if not r["unclean"] else PUT_TOGETHER if together else WHOLE
        files[how].append(file)
    if len(files[WHOLE]) == len(checked):
        return [(path, WHOLE)]
    return [(sorted(found), how) for how, found in files.items() if found]


def _parsed(records: DataFrame, reader, files: list[str], sep: str, options: dict, types) -> DataFrame:
    """Records as columns, by the same parser and options as files. ``types``: a schema, "text" or "inferred"."""
    options = {**options, "sep": sep, "multiLine": "true"}
    if isinstance(types, str):
        names = reader.option("multiLine", True).csv(files[0]).columns  # of its header
        if types == "inferred":
            # Where no cell goes over lines Spark's inference reads splits; a letter in place of a
            # line end keeps such a cell what it is, a text.
            path = scratch_path(records.sparkSession, "records")
            records.select(F.replace("record", F.lit("\n"), F.lit("x"))).write.text(path, lineSep="\n")
            flat = {**options, "multiLine": "false", "lineSep": "\n", "header": "false", "inferSchema": "true"}
            kinds = [f.dataType.simpleString() for f in records.sparkSession.read.options(**flat).csv(path).schema]
            kinds += ["string"] * (len(names) - len(kinds))
        else:
            kinds = ["string"] * len(names)
        types = StructType.fromDDL(", ".join(f"`{n.replace('`', '``')}` {k}" for n, k in zip(names, kinds)))
    ddl = ", ".join(f"`{f.name.replace('`', '``')}` {f.dataType.simpleString()}" for f in types)
    return records.select(F.from_csv("record", ddl, options).alias("r")).select("r.*")


def _common_types(parts: list[DataFrame]) -> StructType:
    """One type per column for parts inferred apart; a column without values in a part takes the others' type."""
    fields = []
    for i, name in enumerate(parts[0].columns):
        types = [p.schema[i].dataType.simpleString() for p in parts]
        if len(set(types)) > 1:
            valued = [not p.select(p.columns[i]).filter(column(p.columns[i]).isNotNull()).isEmpty() for p in parts]
            types = [t for t, v in zip(types, valued) if v] or types[:1]
        if len(set(types)) == 1:
            kind = types[0]
        elif set(types) <= set(NUMBERS):
            kind = max(types, key=NUMBERS.index)
        else:
            kind = "string"
        fields.append(f"`{name.replace('`', '``')}` {kind}")
    return StructType.fromDDL(", ".join(fields))


def has_spanning_cells(spark: SparkSession, path: str, sep: str = "\t") -> bool:
    """May some record cross a line end? One parallel pass; unsure lines count as yes."""
    return any(how != IN_SPLITS for _, how in files_by_reading(spark, path, sep, {}))


def unclean_line(line: Column, sep: str = "\t") -> Column:
    """May reading this line by itself differ from reading it as part of its file?

    A line is clean when each cell that starts with a quote also ends with one in
    that line. Carriage returns and blank-but-not-empty lines, which the two
    reading modes treat differently, count as unclean.
    """
    edge = "\\x{%x}" % ord(sep)
    # Escaped characters give way to one that means nothing, so none moves to a cell's start.
    unescaped = F.regexp_replace(line, r'\\["\\]', "x")
    rest = F.regexp_replace(unescaped, rf'(?<![^{edge}])"[^"]*+"(?![^{edge}])', "")
    open_cell = line.contains('"') & rest.rlike(rf'(?<![^{edge}])\s*"')
    return open_cell | line.contains("\r") | line.rlike(r"^[\x00-\x20]+$")


def table_profile(df: DataFrame) -> DataFrame:
    """One row per column: name, type, position, with the table's row and column counts."""
    fields = F.array(
        *[
            F.struct(
                F.lit(i).alias("position"),
                F.lit(f.name).alias("column"),
                F.lit(f.dataType.simpleString()).alias("type"),
            )
            for i, f in enumerate(df.schema.fields)
        ]
    )
    counted = df.agg(F.count(F.lit(1)).alias("n_rows"))
    return counted.select(
        F.inline(fields), "n_rows", F.lit(len(df.columns)).alias("n_columns")
    )


def readable(df: DataFrame, exclude: Iterable[str] | None = None) -> DataFrame:
    """Without technical columns; an empty exclusion set means the default one."""
    exclude = set(exclude or ()) or TECHNICAL_COLUMNS
    return df.select(*[column(c) for c in df.columns if c not in exclude])


def export_readable(
    df: DataFrame, path: str, exclude: Iterable[str] | None = None, sep: str = ","
) -> None:
    """Write the readable columns as delimited text with a header, replacing ``path``."""
    writer = readable(df, exclude).write.mode("overwrite").options(**FULL_TIMESTAMPS)
    writer.csv(path, header=True, sep=sep)


def preview(
    df: DataFrame,
    limit: int = 1,
    transpose: bool = True,
    order_by: str | None = None,
    exclude: Iterable[str] | None = None,
) -> DataFrame:
    """The first ``limit`` rows, by default as one ``(row, position, field, value)`` per cell.

    With ``order_by`` this is a distributed top-n; without, any ``limit`` rows.
    """
    shown = readable(df, exclude)
    if order_by is not None:
        shown = shown.orderBy(column(order_by))
    shown = shown.limit(limit)
    if not transpose:
        return shown
    cells = F.array(
        *[
            F.struct(
                F.lit(i).alias("position"),
                F.lit(c).alias("field"),
                column(c).cast("string").alias("value"),
            )
            for i, c in enumerate(shown.columns)
        ]
    )
    # Numbers the limited rows only, so the single window task holds `limit` rows.
    order = column(order_by) if order_by is not None else F.monotonically_increasing_id()
    numbered = F.row_number().over(Window.orderBy(order))
    return shown.select(numbered.alias("row"), cells.alias("cells")).select("row", F.inline("cells"))
