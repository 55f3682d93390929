"""Log files as records: lines, and blocks that end with a separator line."""

from __future__ import annotations

import logging

from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from replylens.sources.blocks import BlockSource, read_ranges, task_bytes

log = logging.getLogger(__name__)

# The separator line of message blocks, and the older literal separator.
SEPARATOR_LINE = r"(?m)^[^\S\n]*<={5,}>[^\S\n]*\n"
LEGACY_SEPARATOR = "<=========>"
LEGACY_GLOB = "CIDC_*.txt"


def list_files(spark: SparkSession, paths: list, glob: str | None = None, recursive: bool = False) -> list:
    """[(path, size)] of the files behind `paths` (files, directories, patterns), sorted.

    Whatever is missing is skipped with a warning, and so are folders inside of a directory unless
    `recursive` takes in their files too.
    """
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    pattern = jvm.org.apache.hadoop.fs.GlobPattern(glob) if glob else None
    found = {}
    for path in paths:
        where = jvm.org.apache.hadoop.fs.Path(path)
        fs = where.getFileSystem(conf)
        hits = list(fs.globStatus(where) or [])
        if not hits:
            log.warning("skipping missing input %s", path)
        folders = [hit.getPath() for hit in hits if hit.isDirectory()]
        statuses = [hit for hit in hits if not hit.isDirectory()]
        while folders:
            for status in fs.listStatus(folders.pop()):
                hidden = status.getPath().getName().startswith(("_", "."))
                if status.isFile():
                    statuses.append(status)
                elif recursive and not hidden:
                    folders.append(status.getPath())
                elif not hidden:
                    log.warning("skipping folder %s", status.getPath().toString())
        for status in statuses:
            name = status.getPath().getName()
            if not name.startswith(("_", ".")) and (pattern is None or pattern.matches(name)):
                found[status.getPath().toString()] = status.getLen()
    return sorted(found.items())


def _load(spark: SparkSession, paths, glob: str | None, schema: str, form: str, **options) -> DataFrame | None:
    """`form` read from `paths`, listed by Spark; None if there is nothing to read.

    Only where Spark refuses, because a given path is missing, or finds folders that look like partitions,
    the files are listed here, with a warning for what is left out.
    """
    paths = [paths] if isinstance(paths, str) else list(paths)
    reader = spark.read.format(form).options(**options)
    if paths:
        try:
            found = (reader.option("pathGlobFilter", glob) if glob else reader).load(paths)
            if found.columns == schema.split():
                return found
        except PySparkException:
            pass
    files = [path for path, _ in list_files(spark, paths, glob)]
    return spark.read.format(form).options(**options).load(files) if files else None


def _text(spark: SparkSession, paths, glob: str | None, **options) -> DataFrame | None:
    return _load(spark, paths, glob, "value", "text", **options)


def _clean_lines(raw: DataFrame) -> DataFrame:
    value = F.col("value")
    shorter = F.left(value, F.length(value) - 1)
    return raw.select(
        F.col("_metadata.file_path").alias("source"),
        F.when(value.endswith("\r"), shorter).otherwise(value).alias("value"),
    )


def _empty(spark: SparkSession, schema: str) -> DataFrame:
    return spark.createDataFrame([], schema)


def read_lines(spark: SparkSession, paths, glob: str | None = None, unfinished: bool = True) -> DataFrame:
    """(source, value): one record per line of UTF-8 text. Large files are split.

    A last line without a line break counts, unless `unfinished` is False: then it is left for a later
    read, when its writer has finished it.
    """
    if not unfinished:
        return _ranges(spark, paths, glob, 128 << 20, False, "lines").select("source", "value")
    raw = _text(spark, paths, glob, lineSep="\n")
    return _empty(spark, "source string, value string") if raw is None else _clean_lines(raw)


def stream_lines(
    spark: SparkSession, path: str, glob: str | None = None, max_files: int | None = None
) -> DataFrame:
    """As `read_lines` for files that keep arriving in a directory (each landed complete)."""
    reader = spark.readStream.option("lineSep", "\n")
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return _clean_lines(reader.format("text").load(path))


def read_blocks(
    spark: SparkSession, paths, glob: str | None = None, split_bytes: int = 128 << 20, recursive: bool = False
) -> DataFrame:
    """(source, offset, value): message blocks, files of any size split into ranges of `split_bytes`.

    A block ends with a separator line; blank blocks and an unfinished last block are left
    out. `offset` is the block's place in its file; see `arrival`.
    """
    return _ranges(spark, paths, glob, split_bytes, recursive, "blocks")


def _ranges(spark, paths, glob, split_bytes, recursive, unit) -> DataFrame:
    """Files are listed and cut into ranges of `split_bytes` by Spark; a task reads many small ones (`task_bytes`)."""
    schema = "source string, offset bigint, value string"
    states = _states(spark, paths, glob, **({"recursiveFileLookup": "true"} if recursive else {}))
    size = states.agg(F.sum("length")).first()[0] if states is not None else None
    if not size:
        return _empty(spark, schema)
    starts = F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("length") - 1, F.lit(split_bytes).cast("bigint")))
    ranges = states.filter("length > 0").select("path", "length", starts.alias("start"))
    ranges = ranges.select("path", "start", F.least(F.col("start") + split_bytes, "length").alias("end"))

    def read(batches):
        for batch in batches:
            yield from read_ranges(zip(*(c.to_pylist() for c in batch.columns), strict=True), unit)

    most = task_bytes(size, split_bytes, spark.sparkContext.defaultParallelism)
    # Neighbouring ranges go together, so that a task opens few files.
    ranges = ranges.repartitionByRange(-(-size // most), "path", "start").sortWithinPartitions("path", "start")
    return ranges.mapInArrow(read, schema)


def stream_growing(
    spark: SparkSession, path: str, unit: str = "blocks", glob: str | None = None, split_bytes: int = 128 << 20
) -> DataFrame:
    """(source, offset, value): message blocks, or lines, of the files of a folder as they are written.

    Files may grow: what is appended is read once, and a block or line without an end waits until it has
    one. A file that became smaller is read again from its start; a rewrite of equal size is not noticed.
    """
    if unit not in ("blocks", "lines"):
        raise ValueError("unit must be blocks or lines")
    spark.dataSource.register(BlockSource)
    reader = spark.readStream.format(BlockSource.name()).option("unit", unit).option("splitBytes", split_bytes)
    reader = reader.option("tasks", spark.sparkContext.defaultParallelism)
    return (reader.option("glob", glob) if glob else reader).load(path)


def arrival() -> Column:
    """Arrival order of blocks: files by name, then the place in the file."""
    return F.struct("source", "offset")


def read_blocks_whole_files(spark: SparkSession, paths, glob: str | None = None) -> DataFrame:
    """(source, offset, value) with built-in operators only; `offset` counts a file's blocks.

    Each file is one row at first, so this is for files well below the memory of a task.
    """
    whole = _text(spark, paths, glob, wholetext="true")
    if whole is None:
        return _empty(spark, "source string, offset bigint, value string")
    text = F.regexp_replace("value", r"\r\n", "\n")
    # The piece after the last separator has no separator of its own and is dropped.
    pieces = F.split(text, SEPARATOR_LINE)
    pieces = F.slice(pieces, F.lit(1), F.size(pieces) - 1)
    return (
        whole.select(F.col("_metadata.file_path").alias("source"), F.posexplode(pieces).alias("offset", "value"))
        .filter(F.col("value").rlike(r"\S"))
        .select("source", F.col("offset").cast("bigint").alias("offset"), "value")
    )


def read_blocks_legacy(spark: SparkSession, paths, glob: str | None = None) -> DataFrame:
    """(source, value): text between literal `<=========>` marks; the last piece counts."""
    pieces = _text(spark, paths, glob, lineSep=LEGACY_SEPARATOR)
    if pieces is None:
        return _empty(spark, "source string, value string")
    return (
        pieces.select(F.col("_metadata.file_path").alias("source"), "value").filter(F.col("value").rlike(r"\S"))
    )


def file_states(spark: SparkSession, paths, glob: str | None = None) -> DataFrame:
    """(path, length, modified) of the input files; their content is not read."""
    states = _states(spark, paths, glob)
    if states is None:
        return _empty(spark, "path string, length bigint, modified timestamp")
    return states.select("path", "length", F.col("modificationTime").alias("modified"))


def _states(spark: SparkSession, paths, glob: str | None, **options) -> DataFrame | None:
    return _load(spark, paths, glob, "path modificationTime length content", "binaryFile", **options)


def changed_files(spark: SparkSession, paths, ledger: DataFrame, glob: str | None = None) -> DataFrame:
    """File states that the ledger does not hold: new, grown and rewritten files."""
    return file_states(spark, paths, glob).join(ledger, ["path", "length", "modified"], "left_anti")
