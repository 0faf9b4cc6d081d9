"""Hourly raw zone: landing new CSV files, and reading one hour of a group.

Columns are taken by the names in each file's own header, so files may order them differently and
have more of them than are declared.  One scan of all new files tells their headers apart and finds the
files with a line break inside quotes; only those are read by the reader that can't split a file.

An hour is landed when its commit marker names every group.  The marker is written after all of them, and what a
landing has to know again later (files, columns, line breaks) is kept beside it.
"""

from __future__ import annotations

import datetime as dt
import re
from collections.abc import Iterable
from functools import reduce
from typing import NamedTuple
from urllib.parse import unquote

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from tillwright.schemas import RAW_GROUPS
from tillwright.sinks.files import delete

HOUR = dt.timedelta(hours=1)

# Partition columns of the raw zone and how each is written.
HOUR_PARTITIONS = {"year": "%Y", "month": "%m", "day": "%d", "hour": "%H"}

#: Folder of an hour that says which files of each group were landed; scans skip it.
LANDED = "_landed"
#: What it says of a file, and in ``COMMITTED`` of the hour.
MARKER = "path string, columns array<string>, multi_line boolean"
COMMITTED = "committed"
#: How landed copies are compressed.  A copy can't be split, but is one task's share of what arrived.
COMPRESSION = "lz4"
#: Characters that stand for separator and quote where lines are copied as they are; a file with one is parsed.
NO_SEPARATOR, NO_QUOTE = "\u0001", "\u0000"
AS_LINES = {"sep": NO_SEPARATOR, "quote": "", "escape": ""}  # an empty quote is that character
#: Characters of a line that the CSV reader takes for a blank one.
BLANK = "".join(map(chr, range(33)))


def hour_partition(as_of: dt.datetime) -> dict[str, str]:
    """Partition of the hour before ``as_of``, the one a run at ``as_of`` works on."""
    return {name: (as_of - HOUR).strftime(form) for name, form in HOUR_PARTITIONS.items()}


def hour_path(root: str, as_of: dt.datetime) -> str:
    return "/".join([root.rstrip("/"), *[f"{name}={value}" for name, value in hour_partition(as_of).items()]])


def _found(read) -> list | None:
    """What ``read`` finds, or None where there is no such path."""
    try:
        return read()
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return None


def _files(spark: SparkSession, pattern: str, **options: str) -> list[str]:
    listed = _found(lambda: spark.read.options(**options).text(pattern).inputFiles())
    return sorted(unquote(path) for path in listed or [])


class RawFile(NamedTuple):
    """A file with rows, the column names of its header, and whether a value may have a line break.

    ``verbatim`` says that its lines can be copied without being parsed, ``plain_header`` that its first
    line, and no other, is the header that a group declares.
    """

    path: str
    columns: tuple[str, ...]
    multi_line: bool
    verbatim: bool = False
    plain_header: bool = False


def _without_escapes(line: Column) -> Column:
    return F.regexp_replace(line, r'\\["\\]|""', "")


def _if_quoted(line: Column, found: Column) -> Column:
    """``found`` for lines with a quote, which few have.

    A conditional and no ``&``: what both sides of one share, as the line without escapes, is worked out for all lines.
    """
    return F.when(line.isNull(), None).when(line.contains('"'), found).otherwise(False)


def ends_inside_quotes(line: Column) -> Column:
    """Whether a line of CSV ends in a quoted value, which may go on in the next line.

    Escaped and doubled quotes are cut out first, then all values that are quoted to their end.  A quote
    that still begins a value is open.
    """
    left = F.regexp_replace(_without_escapes(line), r'(^|,)\s*"[^"]*"', "$1")
    return _if_quoted(line, left.rlike(r'(^|,)\s*"'))


def closes_quotes(line: Column) -> Column:
    """Whether the first quote of a line ends a value that began in a line before."""
    plain = _without_escapes(line)
    return _if_quoted(line, plain.rlike(r'^(?:[^"]*[^",\s]\s*)?"\s*(,|$)') | plain.rlike(r'^\s*"\s*(,|$)'))


def survey(spark: SparkSession, files: list[str], multi_line: bool | None = None) -> list[RawFile]:
    """Headers and line breaks of files in one scan of their lines, however many files there are.

    Per file only numbers are aggregated, within its tasks first: the hash of its first line that is not blank, how many lines
    end inside quotes, and how many close quotes of a line before.  Then one file of each different first line tells
    the names.  A file without a line is left out.

    Values have line breaks where quotes are closed as often as left open.  Quotes that are left open and never
    closed are stray ones, and end with their line.  A file with both raises, unless ``multi_line`` says how to read all files.
    """
    if not files:
        return []
    path, at = F.col("_metadata.file_path"), F.monotonically_increasing_id()
    lines = spark.read.text(files).select(
        path.alias("path"), (F.col("_metadata.file_block_start") == 0).alias("first_block"), at.alias("at"), "value"
    )
    value = F.col("value")
    begins = F.col("first_block") & (F.trim(value) != "")
    lines = lines.select(
        "path", F.when(begins, F.col("at")).alias("at"), F.when(begins, F.xxhash64(value)).alias("hash"),
        # The writer quotes what begins like a comment.
        (value.contains(NO_SEPARATOR) | value.contains(NO_QUOTE) | value.startswith("#")).alias("odd"),
        value.isin([",".join(schema.names) for schema in RAW_GROUPS.values()]).alias("declared"),
        ends_inside_quotes(value).alias("open"), closes_quotes(value).alias("close"),
    )
    facts = lines.groupBy("path").agg(
        F.min_by("hash", "at").alias("header"), F.min_by("open", "at").alias("header_open"),
        F.min_by("declared", "at").alias("header_declared"), F.count_if("declared").alias("declared"),
        F.count_if("open").alias("opened"), F.count_if("close").alias("closed"),
        F.count_if(F.col("open") & F.col("close")).alias("either"), F.count_if("odd").alias("odd"),
    )
    names: dict[tuple, tuple[str, ...]] = {}
    found = []
    for row in sorted(facts.where("header IS NOT NULL").collect(), key=lambda row: row["path"]):
        file, whole = unquote(row["path"]), multi_line
        if whole is None:
            whole = row["opened"] > 0 and row["closed"] > 0
            if whole and not _balanced(row["opened"], row["closed"], row["either"]):
                raise ValueError(f"{file} has values with line breaks and stray quotes; say whether to read it line by line")
        # A header that goes on in a second line is looked up for each file.
        over = whole and row["header_open"]
        key = (row["header"], file if over else None)
        if key not in names:
            read = spark.read.options(header=True, multiLine=over)
            names[key] = tuple(name.strip().removeprefix("\ufeff") for name in read.csv(file).columns)
        plain = row["header_declared"] and row["declared"] == 1
        found.append(RawFile(file, names[key], whole, not whole and not row["odd"], plain))
    return found


def _balanced(opened: int, closed: int, either: int) -> bool:
    """Whether quotes close as often as they open, where ``either`` lines, like ``",x``, can do one or the other."""
    closing, odd = divmod(opened - closed + either, 2)
    return not odd and 0 <= closing <= either


def _read(
    spark: SparkSession, files: Iterable[RawFile], types: StructType, parts: tuple[str, ...] = (), **options
) -> list[tuple[RawFile, DataFrame]]:
    """A frame for the files of each header and way to read, with one of the files.

    Columns that ``types`` does not declare are text.
    """
    alike: dict[tuple, list[RawFile]] = {}
    for file in files:
        alike.setdefault((file.columns, file.multi_line), []).append(file)
    declared = {field.name: field for field in types.fields}
    frames = []
    for (names, multi_line), group in alike.items():
        schema = StructType([declared.get(name, StructField(name, StringType())) for name in (*names, *parts)])
        reader = spark.read.schema(schema).options(header=True, multiLine=multi_line, **options)
        frames.append((group[0], reader.csv([file.path for file in group])))
    return frames


def _declared_only(file: RawFile, frame: DataFrame, names: list[str], parts: tuple[str, ...] = ()) -> DataFrame:
    missing = [name for name in names if name not in file.columns]
    if missing:
        raise ValueError(f"{file.path} has no column {', '.join(missing)}")
    return frame.select(*names, *parts)


def read_group(spark: SparkSession, folder: str, group: str, multi_line: bool | None = None) -> DataFrame:
    """The ``<group>*.csv`` files of a folder: the group's declared columns under their declared types.

    A file that lacks a declared column raises.  A folder without files of the group gives an empty frame;
    whether the folder should be there is for the caller to know (:func:`missing_groups`).
    Values may have line breaks; a file with one is read by a single task.  What a landing wrote is read
    as its marker says, other files are surveyed.
    """
    schema, folder = RAW_GROUPS[group], folder.rstrip("/")
    listed = _files(spark, f"{folder}/{group}*.csv")
    marked = landed_files(spark, folder, group) if listed else None
    files = _as_marked(listed, marked) if marked else survey(spark, listed, multi_line)
    frames = [_declared_only(file, frame, schema.names) for file, frame in _read(spark, files, schema)]
    return reduce(DataFrame.unionByName, frames) if frames else spark.createDataFrame([], schema)


def _as_marked(listed: list[str], marked: list[RawFile]) -> list[RawFile]:
    """Files of a landed group: all have the columns of the landing."""
    columns = _all_columns(marked)
    return [RawFile(path, columns, any(file.multi_line for file in marked)) for path in listed]


def _all_columns(files: list[RawFile]) -> tuple[str, ...]:
    """Columns of several files in the order in which they come up."""
    return tuple(dict.fromkeys(name for file in files for name in file.columns))


def landed_files(spark: SparkSession, hour: str, group: str) -> list[RawFile] | None:
    """Files of a group that an hour's landing took, or None where it did not run."""
    rows = _found(lambda: spark.read.schema(MARKER).json(f"{hour}/{LANDED}/{group}").collect())
    return None if rows is None else [RawFile(r["path"], tuple(r["columns"] or ()), bool(r["multi_line"])) for r in rows]


def missing_groups(spark: SparkSession, hour: str) -> list[str]:
    """Groups that an hour still lacks: its landing did not come to its commit marker with them.

    Of a folder that other tools filled, without any marker, the groups without files.
    """
    if (done := _committed(spark, hour)) is None:
        if any(landed_files(spark, hour, group) is not None for group in RAW_GROUPS):
            return list(RAW_GROUPS)
        return [group for group in RAW_GROUPS if not _files(spark, f"{hour}/{group}*.csv")]
    return [group for group in RAW_GROUPS if group not in done]


def _committed(spark: SparkSession, hour: str) -> list[str] | None:
    rows = _found(lambda: spark.read.schema("name string").json(f"{hour}/{LANDED}/{COMMITTED}").collect())
    return None if rows is None else [row["name"] for row in rows]


def land_hour(
    spark: SparkSession,
    landing: str,
    root: str,
    as_of: dt.datetime,
    groups: Iterable[str] = tuple(RAW_GROUPS),
    only_last_hour: bool = True,
    replace: bool = False,
    late: bool = False,
    multi_line: bool | None = None,
) -> dict[str, str | None]:
    """Copy CSV files that arrived in the hour before ``as_of`` to that hour's partition, then commit the hour.

    ``landing`` holds drop folders, those hold ``<group>*.csv``.  Arrival is the files'
    modification time, from one hour before ``as_of`` up to but not including it, with
    ``as_of`` in the session's time zone; ``late`` takes older files too that no hour has landed.  All columns of
    the files are carried, as the text they are, so a malformed value is still there to be rejected later.

    A rerun that finds the same files, or more, replaces a group's folder and so lands the
    same rows once.  One that finds none leaves it alone; one that finds only some of those landed
    before raises before anything is written, unless ``replace`` is given.  The commit marker is taken away
    before the first write and put back after the last, naming the groups that are landed.  ``multi_line`` is said
    at :func:`survey`.

    Tasks copy in parallel and each writes its own file, compressed.  Returns the folder written per group, or
    None where no file arrived.
    """
    groups, hour = list(groups), hour_path(root, as_of)
    arrived = {group: _arrived(spark, landing, root, group, as_of, only_last_hour, late) for group in groups}
    before = {group: landed_files(spark, hour, group) for group in groups}
    for group, files in arrived.items():
        gone = {file.path for file in before[group] or []} - set(files)
        if files and gone and not replace:
            raise ValueError(f"{hour} was landed with {sorted(gone)}, which did not arrive in the hour")
    every = [path for files in arrived.values() for path in files]
    known = {_plain(file.path): file for file in survey(spark, every, multi_line)}
    committed = set(_committed(spark, hour) or [])
    delete(spark, f"{hour}/{LANDED}/{COMMITTED}")
    targets: dict[str, str | None] = dict.fromkeys(groups)
    for group, files in arrived.items():
        if not files and before[group] is not None:
            continue
        # A file without a line is noted as well, it has no columns.
        facts = [known.get(_plain(path), RawFile(path, (), False))._replace(path=path) for path in files]
        with_rows = [file for file in facts if file.columns]
        if files:
            targets[group] = f"{hour}/{group}.csv"
        if _alike(with_rows):
            _copy_lines(spark, with_rows, targets[group])
        elif with_rows:
            frames = [frame for _, frame in _read(spark, with_rows, StructType([]))]
            # What was read line by line has no line break, and what was not is read back that way.
            rows = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)
            write_csv(rows, targets[group], multi_line=True, compression=COMPRESSION)
        marker = spark.createDataFrame([(f.path, list(f.columns), f.multi_line) for f in facts], MARKER)
        marker.coalesce(1).write.mode("overwrite").json(f"{hour}/{LANDED}/{group}")
    names = spark.createDataFrame([(name,) for name in sorted(committed.union(groups))], "name string")
    names.coalesce(1).write.mode("overwrite").json(f"{hour}/{LANDED}/{COMMITTED}")
    return targets


def _alike(files: list[RawFile]) -> bool:
    """Whether the lines of files can go below one header as they are: same plain columns, and nothing to parse for."""
    names = {file.columns for file in files}
    if len(names) != 1 or not all(file.verbatim for file in files):
        return False
    columns = [name.lower() for name in names.pop()]
    return len(set(columns)) == len(columns) and all(re.fullmatch(r"\w+", name) for name in columns)


def _copy_lines(spark: SparkSession, files: list[RawFile], target: str) -> None:
    """Write the lines of files as they are below one header, each line as one value.

    Headers and blank lines are dropped as any reading of CSV does.  Lines that are read as text take half the time of
    values of CSV, but tell a header only by its text, so no row may be like it.
    """
    header, paths = ",".join(files[0].columns), [file.path for file in files]
    if all(file.plain_header for file in files):
        value = F.col("value")
        lines = spark.read.text(paths).where((value != header) & (F.btrim(value, F.lit(BLANK)) != ""))
    else:
        lines = spark.read.schema("line string").options(header=True, **AS_LINES).csv(paths)
    write_csv(lines.toDF(header), target, multi_line=True, compression=COMPRESSION, **AS_LINES)


def land_group(
    spark: SparkSession, landing: str, root: str, group: str, as_of: dt.datetime, only_last_hour: bool = True,
    replace: bool = False,
) -> str | None:
    """:func:`land_hour` for one group alone; the hour is complete when all groups were landed."""
    return land_hour(spark, landing, root, as_of, [group], only_last_hour, replace)[group]


def _plain(path: str) -> str:
    """Local files are listed as ``file:///x`` and read as ``file:/x``."""
    return re.sub("^file:/+", "file:///", path)


def _arrived(
    spark: SparkSession, landing: str, root: str, group: str, as_of: dt.datetime, only_last_hour: bool, late: bool
) -> list[str]:
    pattern, window = f"{landing.rstrip('/')}/*/{group}*.csv", {}
    if only_last_hour:
        # Both bounds of the reader are exclusive, file times have milliseconds.
        first = as_of - HOUR - dt.timedelta(milliseconds=1)
        window = {
            "modifiedAfter": first.isoformat(timespec="milliseconds"),
            "modifiedBefore": as_of.isoformat(timespec="milliseconds"),
        }
    arrived = _files(spark, pattern, **window)
    if late:
        older = [row["path"] for row in unlanded_files(spark, landing, root, group, as_of - HOUR).collect()]
        arrived = sorted({*arrived, *map(_plain, older)})
    return arrived


def unlanded_files(spark: SparkSession, landing: str, root: str, group: str, before: dt.datetime) -> DataFrame:
    """``path`` and ``modificationTime`` of a group's files from before a time that no hour has landed.

    Such files came with an older time than that of their arrival, or their hour was never landed.
    """
    files = _found(lambda: spark.read.format("binaryFile").load(f"{landing.rstrip('/')}/*/{group}*.csv"))
    if files is None:
        return spark.createDataFrame([], "path string, modificationTime timestamp")
    older = files.where(F.col("modificationTime") < F.lit(before)).select("path", "modificationTime")
    hours = "/".join(f"{name}=*" for name in HOUR_PARTITIONS)
    landed = _found(lambda: spark.read.schema(MARKER).json(f"{root.rstrip('/')}/{hours}/{LANDED}/{group}"))
    if landed is None:
        return older
    plain = lambda path: F.regexp_replace(path, "^file:/+", "file:///")
    noted = landed.select(plain("path").alias("noted")).distinct()
    return older.join(noted, plain("path") == F.col("noted"), "left_anti")


def write_csv(rows: DataFrame, folder: str, multi_line: bool = False, compression: str = "none", **options: str) -> None:
    """CSV that reads back as the values it was written from, spaces around them included.

    A value with a line break would read back as two rows, so it raises, unless readers use ``multi_line`` too.
    """
    if not multi_line:
        rows = rows.select(
            *(_on_one_line(field.name) if isinstance(field.dataType, StringType) else F.col(f"`{field.name}`")
              for field in rows.schema.fields)
        )
    (
        rows.write.mode("overwrite")
        .options(header=True, ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False, compression=compression, **options)
        .csv(folder)
    )


def _on_one_line(name: str):
    value = F.col(f"`{name}`")
    broken = F.raise_error(F.lit(f"a value of {name} has a line break"))
    return F.when(value.rlike("[\r\n]"), broken).otherwise(value).alias(name)


def read_raw_zone(spark: SparkSession, root: str, group: str) -> DataFrame:
    """All landed hours of a group, with the hour's partition columns as text.

    The markers of all hours are read at once; files that no marker speaks of are surveyed.
    """
    schema, root = RAW_GROUPS[group], root.rstrip("/")
    types = StructType(schema.fields + [StructField(name, StringType()) for name in HOUR_PARTITIONS])
    hours, parts = "/".join(f"{name}=*" for name in HOUR_PARTITIONS), tuple(HOUR_PARTITIONS)
    by_hour: dict[str, list[str]] = {}
    for file in _files(spark, f"{root}/{hours}/{group}.csv"):
        by_hour.setdefault(_plain(file).rsplit("/", 2)[0], []).append(file)
    marked: dict[str, list[RawFile]] = {}
    markers = _found(lambda: spark.read.schema(MARKER).json(f"{root}/{hours}/{LANDED}/{group}"))
    for row in [] if markers is None else markers.select("*", "_metadata.file_path").collect():
        hour = _plain(unquote(row["file_path"])).rsplit("/", 3)[0]
        marked.setdefault(hour, []).append(RawFile(row["path"], tuple(row["columns"] or ()), bool(row["multi_line"])))
    files = [file for hour, paths in by_hour.items() if hour in marked for file in _as_marked(paths, marked[hour])]
    files += survey(spark, [path for hour, paths in by_hour.items() if hour not in marked for path in paths])
    frames = [
        _declared_only(file, frame, schema.names, parts)
        for file, frame in _read(spark, files, types, parts, basePath=root)
    ]
    return reduce(DataFrame.unionByName, frames) if frames else spark.createDataFrame([], types)
