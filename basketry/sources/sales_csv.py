"""The CSV feed: columns bound by header name, values that do not fit kept as JSON.

Spark binds CSV columns by position and takes no notice of the header line, so a file with reordered
columns would load silently wrong. Here the headers are read first, files are grouped by header, and
each group is read with a schema of its own. All values are read as text and cast one by one; text
that does not cast, columns the feed does not know and lines with too many or too few fields go to
the rescue column, and the row survives.
"""

from __future__ import annotations

import csv
import re
from collections import Counter
from collections.abc import Sequence
from functools import reduce
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from basketry import contracts as C
from basketry.session import beside

_BROKEN_LINE = "_broken_line"
# ``monotonically_increasing_id`` numbers the rows of a task in so many low bits.
_ROW_BITS = 33


def _one_file_per_task(spark: SparkSession) -> SparkSession:
    """A session with the settings of ``spark``, in which a scan packs no files together."""
    most = spark.conf.get("spark.sql.files.maxPartitionBytes")
    return beside(spark, {"spark.sql.files.openCostInBytes": most})


def _place(path: str) -> str:
    """A path without its scheme and authority, which its readers spell in different ways."""
    return re.sub(r"^[A-Za-z][A-Za-z0-9+.-]*:(//[^/]*)?", "", path)


def first_lines(spark: SparkSession, paths: Sequence[str]) -> dict[str, str]:
    """The first line of each file that has one, blank lines aside, compressed files included.

    One job over all paths, without Python: each task scans a split and keeps the first line of one that
    begins its file. A Python function that stops early would not end the scan: what it leaves is still
    converted and sent, at many times the cost of reading it. Lines are read as UTF-8.
    """
    lines = (
        _one_file_per_task(spark).read.text(list(paths))
        .filter((F.col("_metadata.file_block_start") == 0) & (F.trim("value") != ""))
        .select(F.col("value").alias("line"), F.col("_metadata.file_path").alias("file"),
                F.monotonically_increasing_id().alias("row"))
        .filter(F.col("row").bitwiseAND((1 << _ROW_BITS) - 1) == 0)
    )
    given = {_place(path): path for path in paths}
    found = {}
    for row in lines.collect():  # one line per file of a trigger
        place = _place(row.file)
        found[given.get(place) or given[unquote(place)]] = row.line
    return found


def header_of(line: str, **options: str) -> tuple[str, ...]:
    """Column names in a header line. As in Spark, a blank name is replaced by its place, and names
    that repeat, whatever their case, are told apart by it."""
    named = {key.lower(): value for key, value in options.items()}
    quote = named.get("quote", '"')
    titles = next(csv.reader(
        [line], delimiter=named.get("sep") or named.get("delimiter") or ",", quotechar=quote or None,
        quoting=csv.QUOTE_MINIMAL if quote else csv.QUOTE_NONE, escapechar=named.get("escape", "\\"), doublequote=True))
    times = Counter(title.lower() for title in titles)
    return tuple(
        f"_c{i}" if not title else f"{title}{i}" if times[title.lower()] > 1 else title
        for i, title in enumerate(titles)
    )


def by_header(
    spark: SparkSession, paths: Sequence[str], **options: str
) -> dict[tuple[str, ...], list[str]]:
    """Paths grouped by header. ``paths`` are the files of one trigger, so their number is capped
    by the trigger; what reaches the driver is one line per file."""
    groups: dict[tuple[str, ...], list[str]] = {}
    lines = first_lines(spark, paths) if paths else {}
    for path in paths:
        if path in lines:
            groups.setdefault(header_of(lines[path], **options), []).append(path)
    return groups


def _rescue(misfits: dict[str, Column]) -> Column:
    """The misfits that are not NULL as JSON, made only for rows that have one."""
    entries = F.struct(*[value.alias(name) for name, value in misfits.items()])
    kept = F.to_json(entries, {"ignoreNullFields": "true"})
    return F.when(F.coalesce(*misfits.values()).isNotNull(), kept)


def _bound(
    spark: SparkSession, header: tuple[str, ...], paths: list[str], options: dict[str, str]
) -> DataFrame:
    places = [f"f{i}" for i in range(len(header))]
    schema = T.StructType([T.StructField(n, T.StringType()) for n in [*places, _BROKEN_LINE]])
    lines = (
        spark.read.schema(schema)
        .options(header=True, columnNameOfCorruptRecord=_BROKEN_LINE, **options)
        .csv(paths)
    )
    place_of = dict(zip(reversed(header), reversed(places)))
    values, misfits = [], {}
    for title, kind, name in C.RAW_FIELDS:
        place = place_of.pop(title, None)
        if place is None:
            values.append(F.lit(None).cast(kind).alias(name))
            continue
        text = F.col(place)
        values.append(text.try_cast(kind).alias(name))
        if kind != "string":
            misfits[title] = F.when(text.try_cast(kind).isNull(), text)
    misfits |= {title: F.col(place) for title, place in place_of.items()}
    misfits[_BROKEN_LINE] = F.col(_BROKEN_LINE)
    return lines.select(
        *values,
        _rescue(misfits).alias(C.RESCUED),
        F.col("_metadata.file_path").alias(C.SOURCE_FILE),
        F.col("_metadata.file_modification_time").alias(C.FILE_MODIFIED),
    )


def feed_with_lineage_schema() -> T.StructType:
    return (
        C.feed_schema()
        .add(C.RESCUED, "string")
        .add(C.SOURCE_FILE, "string")
        .add(C.FILE_MODIFIED, "timestamp")
    )


def read_files(spark: SparkSession, paths: Sequence[str], **options: str) -> DataFrame:
    """The rows of ``paths`` with typed feed columns, rescue column and file lineage."""
    groups = by_header(spark, paths, **options)
    if not groups:
        return spark.createDataFrame([], feed_with_lineage_schema())
    frames = [_bound(spark, header, files, options) for header, files in groups.items()]
    return reduce(DataFrame.unionByName, frames)


_FOUND_FILE = "path string, modificationTime timestamp, length long, content binary"


def discovered(
    spark: SparkSession,
    landing: str,
    max_files: int = C.MAX_FILES_PER_TRIGGER,
    pattern: str | None = None,
) -> DataFrame:
    """A stream of the paths of the files under ``landing``, each delivered once.

    All files count, whatever their suffix, compressed ones too; ``pattern`` (a glob on the file
    name) restricts them. Only paths are selected, so file contents are not loaded. Files and folders
    whose name starts with an underscore or a dot, such as checkpoints, are skipped.
    """
    reader = spark.readStream.format("binaryFile").schema(_FOUND_FILE)
    if pattern is not None:
        reader = reader.option("pathGlobFilter", pattern)
    return (
        reader.option("recursiveFileLookup", "true")
        .option("maxFilesPerTrigger", max_files)
        .load(landing)
        .select("path")
    )
