"""A splittable source of message blocks and finished lines, in batches and as a stream of growing files.

The text source splits files at single lines only, and a whole file per row does not work for
large files. Here a file is cut into byte ranges like any Hadoop input: a range owns the
blocks that follow the separator lines starting in it (the first range also owns the first
block) and reads past its end to finish the last one. So no block has to be shuffled.
"""

from __future__ import annotations

import itertools
import math
import re
from dataclasses import dataclass

from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition

SEPARATOR = re.compile(rb"^[^\S\n]*<={5,}>[^\S\n]*\n", re.MULTILINE)
CHUNK = 4 << 20
LINE = 1 << 20
# Read behind a range at first, to finish its last block.
BEYOND = 4096
BATCH = 2000
# Small ranges are read many to a task, of up to so many bytes.
TASK_BYTES = 32 << 20


@dataclass
class Ranges(InputPartition):
    parts: list  # (path, start, end)


def task_bytes(size: int, split_bytes: int, tasks: int) -> int:
    """What a task reads of `size` bytes: TASK_BYTES, or less if that gives fewer than `tasks` tasks; at least a range."""
    return max(split_bytes, min(TASK_BYTES, -(-size // max(1, tasks))))


def plan_ranges(files: list, split_bytes: int, tasks: int | None = None) -> list:
    """Byte ranges of about `split_bytes`; small files share a partition. A third item is where to begin.

    With `tasks`, a partition has as many ranges as `task_bytes` allows.
    """
    size = sum(size - sum(begin) for _, size, *begin in files)
    most = split_bytes if tasks is None else task_bytes(size, split_bytes, tasks)
    partitions, current, filled = [], [], 0
    for path, size, *begin in files:
        for start in range(*(begin or [0]), size, split_bytes):
            end = min(start + split_bytes, size)
            if current and filled + (end - start) > most:
                partitions.append(Ranges(current))
                current, filled = [], 0
            current.append((path, start, end))
            filled += end - start
    if current:
        partitions.append(Ranges(current))
    return partitions


def _uri(path: str) -> str:
    scheme, _, rest = path.partition(":")
    if scheme in ("s3a", "s3n"):
        return "s3:" + rest
    return "/" + rest.lstrip("/") if scheme == "file" else path


def open_file(path: str):
    from pyarrow import fs

    filesystem, inner = fs.FileSystem.from_uri(_uri(path))
    return filesystem.open_input_file(inner)


def _separators(stream, start: int, limit_at: float = math.inf, first_read: int = CHUNK):
    """(start, end, base, buffer) of the separator lines from the line break before `start` to `limit_at`.

    `buffer` holds the bytes from `base` on; start is None where lines are known up to base. Only the line that is being read is kept, and of a line longer than LINE, which is no separator,
    nothing; so memory does not depend on the length of blocks or lines. Reads begin with `first_read` bytes and
    double up to CHUNK, so that a small range does not read a chunk.
    """
    base = max(0, start - 1)
    buffer, at_line_start = b"", start == 0
    step = max(1, first_read)
    while True:
        step, size = 2 * step, min(step, CHUNK)
        stream.seek(base + len(buffer))
        more = stream.read(int(min(size, max(0, limit_at - base - len(buffer)))))
        buffer += more
        limit = buffer.rfind(b"\n") + 1
        if not limit and (len(buffer) > LINE or not at_line_start):
            base, buffer, at_line_start = base + len(buffer), b"", False
        elif limit:
            first = 0 if at_line_start else buffer.index(b"\n") + 1
            for hit in SEPARATOR.finditer(buffer, first, limit):
                yield base + hit.start(), base + hit.end(), base, buffer
            base, buffer, at_line_start = base + limit, buffer[limit:], True
        yield None, base, base, b""
        if not more:
            return


def _between(stream, start: int, end: int, base: int, buffer: bytes) -> bytes:
    """The bytes from `start` to `end`, out of `buffer` if they are there: no request per block."""
    if start >= base:
        return buffer[start - base : end - base]
    stream.seek(start)
    return stream.read(end - start)


def blocks_in_range(stream, start: int, end: int):
    """(offset, block bytes) of the blocks owned by [start, end): those that begin there."""
    block = 0 if start == 0 else None  # file offset of the open block
    for at, after, base, buffer in _separators(stream, start, first_read=end - start + BEYOND):
        if at is None:
            if block is None and after >= end:
                return
            continue
        if block is not None:
            yield block, _between(stream, block, at, base, buffer)
        block = after
        if at >= end:
            return


def _back_to(stream, at: int, find, most: float = math.inf) -> int:
    """Where the last thing that `find(bytes, is_file_start)` sees before `at` ends; 0 if there is none.

    The bytes before `at` are read in ever larger steps, `most` bytes at most (then the result is `at`).
    """
    step = min(at, 4096)
    while step:
        stream.seek(at - step)
        found = find(stream.read(step), step == at)
        if found is not None:
            return at - step + found
        if step == at:
            return 0
        if step >= most:
            return at
        step = min(at, 4 * step)
    return 0


def _last_break(data: bytes, whole: bool) -> int | None:
    return data.rfind(b"\n") + 1 or None


def _last_separator(data: bytes, whole: bool) -> int | None:
    # The first line may have begun earlier.
    first = 0 if whole else data.find(b"\n") + 1
    if not first and not whole:
        return None
    last = None
    for last in SEPARATOR.finditer(data, first):
        pass
    return last and last.end()


def blocks_ending_in(stream, start: int, end: int):
    """(offset, block bytes) of the blocks whose separator line ends behind `start` and not behind `end`."""
    line = _back_to(stream, start, _last_break, LINE)
    block = None
    for at, after, base, buffer in _separators(stream, line, end):
        if at is None:
            continue
        if block is None:
            # Looked for only now, so that an unfinished block is not read again at every poll.
            block = _back_to(stream, line, _last_separator)
        yield block, _between(stream, block, at, base, buffer)
        block = after


def lines_ending_in(stream, start: int, end: int):
    """(offset, line bytes) of the lines whose line break lies in [start, end)."""
    base = _back_to(stream, start, _last_break)
    buffer, known = b"", start - base
    while base + len(buffer) < end:
        stream.seek(base + len(buffer))
        more = stream.read(min(CHUNK, end - base - len(buffer)))
        if not more:
            return
        buffer += more
        at = 0
        while (stop := buffer.find(b"\n", max(at, known))) >= 0:
            yield base + at, buffer[at:stop]
            at = stop + 1
        base, buffer = base + at, buffer[at:]
        known = len(buffer)


def _rows(ranges, read):
    """Record batches (source, offset, value) of what `read(stream, start, end)` finds in the ranges."""
    import pyarrow as pa

    names = ["source", "offset", "value"]
    types = [pa.string(), pa.int64(), pa.string()]
    rows = []

    def batch():
        columns = zip(*rows, strict=True)
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names)

    for path, parts in itertools.groupby(ranges, lambda r: r[0]):
        with open_file(path) as stream:
            for _, start, end in parts:
                for offset, raw in read(stream, start, end):
                    rows.append((path, offset, raw.decode("utf-8", "replace")))
                    if len(rows) >= BATCH:
                        yield batch()
                        rows = []
    if rows:
        yield batch()


def _filled(blocks):
    """Blocks with single line breaks that are not blank."""
    for offset, raw in blocks:
        raw = raw.replace(b"\r\n", b"\n")
        if raw.strip():
            yield offset, raw


def _unbroken(lines):
    for offset, raw in lines:
        yield offset, raw.removesuffix(b"\r")


UNITS = {
    "blocks": lambda *where: _filled(blocks_ending_in(*where)),
    "lines": lambda *where: _unbroken(lines_ending_in(*where)),
}


def read_ranges(ranges, unit: str):
    """Record batches of the blocks that begin, or the lines that end, in ranges (path, start, end) of whole files."""
    return _rows(ranges, (lambda *where: _filled(blocks_in_range(*where))) if unit == "blocks" else UNITS[unit])


def files_in(path: str, glob: str | None) -> dict[str, int]:
    """{file: size} of a folder; hidden files and folders in it are left out."""
    from fnmatch import fnmatch

    from pyarrow import fs

    scheme = path.partition(":")[0] if ":" in path else None
    filesystem, inner = fs.FileSystem.from_uri(_uri(path))
    found = {}
    for info in filesystem.get_file_info(fs.FileSelector(inner, allow_not_found=True)):
        if info.is_file and not info.base_name.startswith(("_", ".")) and (not glob or fnmatch(info.base_name, glob)):
            found[f"{scheme}:{'//' if scheme != 'file' else ''}{info.path}" if scheme else info.path] = info.size
    return found


class GrowingFiles(DataSourceStreamReader):
    """Offsets are sizes by file; see the top of this module."""

    def __init__(self, options):
        self.path, self.glob = options["path"], options.get("glob")
        self.unit = options.get("unit", "blocks")
        self.split_bytes = int(options.get("splitBytes", 128 << 20))
        self.tasks = int(options.get("tasks", 1))

    def initialOffset(self):
        return {}

    def latestOffset(self):
        return files_in(self.path, self.glob)

    def partitions(self, start, end):
        grown = []
        for path, size in sorted(end.items()):
            known = start.get(path, 0)
            if size != known:
                grown.append((path, size, known if known < size else 0))
        return plan_ranges(grown, self.split_bytes, self.tasks) or [Ranges([])]

    def read(self, partition):
        return _rows(partition.parts, UNITS[self.unit])


class BlockSource(DataSource):
    @classmethod
    def name(cls):
        return "message_blocks"

    def schema(self):
        return "source string, offset bigint, value string"

    def streamReader(self, schema):
        return GrowingFiles(self.options)
