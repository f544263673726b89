"""Bytes of files by the task that reads them, and record boundaries inside plain CSV.

``open_file`` opens a path of any scheme that the worker can reach: ``file:``
paths as they are, others through Arrow's file systems. Files are read in
pieces, so a file of any size needs constant memory.

Splitting. A plain CSV file can hold newlines inside quotes, so a task that
starts in the middle does not know whether it stands inside a quoted field.
Each block of a file is read on its own for how it changes that: a run of an
odd number of quotes after a delimiter or line end toggles the state (it opens
a field, or closes one whose text ends in a delimiter), any other odd run
leaves the block outside of quotes (it closes a field, or is plain text in an
unquoted one), and an even run changes nothing. So a block's effect is "set to
outside" or nothing, followed by a number of toggles, and it notes its first
record start for either state at its own start. A running composition over the
blocks of a file (two window sums) then tells every block's state, hence the
true record starts, and any number of tasks read one file from there.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

READ_BYTES = 4 << 20
TASK_BYTES = 8 << 20  # of files in blocks smaller than that, one task reads so many bytes
TASK_BLOCKS = 512  # or so many blocks
BATCH_RECORDS = 10_000
_QUOTE, _LF, _CR = ord('"'), ord("\n"), ord("\r")
_BOM = b"\xef\xbb\xbf"
# Schemes of Hadoop whose Arrow name differs.
_ARROW_SCHEMES = {"s3a": "s3", "s3n": "s3", "gs": "gs", "hdfs": "hdfs", "s3": "s3", "abfss": "abfss"}


def is_local(path: str) -> bool:
    return path.startswith("file:") or "://" not in path


def arrow_place(path: str):
    """``(file system, path in it, prefix of its full names)`` of a path that is not local."""
    from pyarrow.fs import FileSystem

    scheme, rest = path.split("://", 1)
    authority, _, inside = rest.partition("/")
    fs, base = FileSystem.from_uri(f"{_ARROW_SCHEMES.get(scheme, scheme)}://{authority}/")
    base = base.rstrip("/")
    return fs, f"{base}/{inside}".rstrip("/"), f"{scheme}://{authority}", base


def open_file(path: str):
    if is_local(path):
        return open(path.removeprefix("file://").removeprefix("file:"), "rb")
    fs, inside, _, _ = arrow_place(path)
    return fs.open_input_file(inside)


def reachable(path: str) -> bool:
    """Whether workers can open paths of this kind themselves (tried on one file)."""
    if is_local(path):
        return True
    try:
        with open_file(path) as f:
            f.read(1)
        return True
    except Exception:  # noqa: BLE001 - any failure leaves the file to Spark's own readers
        return False


# ------------------------------------------------------------------ quote state
class QuoteState:
    """Where quoting stands after each odd run of quotes of a piece of bytes."""

    def __init__(self, data: np.ndarray, before: int, delimiter: int = ord(",")):
        """``before``: the byte before the piece, a line end at the start of a file."""
        quotes = np.flatnonzero(data == _QUOTE)
        first = quotes[np.diff(quotes, prepend=-2) > 1]
        last = quotes[np.diff(quotes, append=len(data) + 2) > 1] if len(quotes) else quotes
        if len(first) and first[0] == 0 and before == _QUOTE:  # belongs to the piece before
            first, last = first[1:], last[1:]
        odd = (last - first) % 2 == 0
        self.at = last[odd]
        ahead = np.where(first[odd] > 0, data[np.maximum(first[odd] - 1, 0)], before)
        toggles = (ahead == delimiter) | (ahead == _LF) | (ahead == _CR)
        self.count = np.cumsum(toggles)
        since = np.maximum.accumulate(np.where(~toggles, np.arange(1, len(toggles) + 1), 0))  # last reset, counted from 1
        self.reset = since > 0
        self.base = np.where(self.reset, self.count[np.maximum(since - 1, 0)], 0)

    def after(self, places: np.ndarray, start: int) -> np.ndarray:
        """Whether each place is inside quotes, if the piece starts in state ``start`` (0 or 1)."""
        i = np.searchsorted(self.at, places) - 1
        if not len(self.at):
            return np.full(len(places), bool(start))
        j = np.maximum(i, 0)
        inside = (self.count[j] - self.base[j] + np.where(self.reset[j], 0, start)) % 2 == 1
        return np.where(i < 0, bool(start), inside)

    def effect(self) -> tuple[bool, int]:
        """``(sets to outside first, toggles after that modulo 2)`` of the whole piece."""
        if not len(self.at):
            return False, 0
        return bool(self.reset[-1]), int(self.count[-1] - self.base[-1]) % 2


def header_end(head: bytes, whole: bool) -> tuple[int, str] | None:
    """Where the first record ends, and the line end in use; None if more bytes are needed."""
    data = np.frombuffer(head, np.uint8)
    ends = np.flatnonzero((data == _LF) | (data == _CR))
    ends = ends[~QuoteState(data, _LF).after(ends, 0)]
    if not len(ends):
        return (len(head), "\n") if whole else None
    at = int(ends[0])
    if head[at] == _LF:
        return at, "\n"
    if at + 1 == len(head) and not whole:
        return None
    return at, "\r\n" if head[at + 1:at + 2] == b"\n" else "\r"


# ------------------------------------------------------------------ blocks of files
_EFFECTS = pa.schema([("path", pa.string()), ("block", pa.int64()), ("reset", pa.bool_()), ("toggles", pa.int64()),
                      ("first_outside", pa.int64()), ("first_inside", pa.int64())])
_EFFECTS_DDL = "path string, block long, reset boolean, toggles long, first_outside long, first_inside long"


def block_effect(f, offset: int, size: int, line_end: int) -> tuple[bool, int, int | None, int | None]:
    """Effect of one block, and its first record start (in the file) for either state at its own start."""
    f.seek(max(offset - 1, 0))
    before = f.read(1)[0] if offset else _LF
    state, firsts, done, data = [0, 1], [None, None], 0, b""
    reset, toggles = False, 0
    while done < size:
        data = f.read(min(READ_BYTES, size - done))
        if not data:
            break
        done += len(data)
        if data[-1] == _QUOTE:  # the run of quotes goes on
            while (more := f.read(1)) == b'"':
                data += more
                done += 1
            if more:
                f.seek(-1, 1)
        marked = offset + done == len(data) and data.startswith(_BOM)
        if marked:
            data = b"\n\n\n" + data[3:]  # the same places, and a quote after the mark opens a field
        a = np.frombuffer(data, np.uint8)
        q = QuoteState(a, before)
        ends = np.flatnonzero(a == line_end)
        ends = ends[3:] if marked and line_end == _LF else ends
        ends = ends[ends + done - len(data) < size]
        for s in (0, 1):
            if firsts[s] is None and len(ends):
                outside = ends[~q.after(ends, state[s])]
                if len(outside):
                    firsts[s] = offset + done - len(data) + int(outside[0]) + 1
        r, t = q.effect()
        state = [t if r else (s + t) % 2 for s in state]
        reset, toggles = reset or r, t if r else (toggles + t) % 2
        before = data[-1]
    return reset, toggles, *firsts


def n_tasks(lengths: DataFrame, block_bytes: int, most: int = 50_000) -> int:
    """Tasks for files ``(length)`` read in blocks, of which small ones share a task. It is given to ``repartition``,
    for rows that name blocks are so small that Spark would otherwise put them all into one task."""
    n, size = lengths.agg(F.sum(F.greatest(F.lit(1), F.ceil(F.col("length") / block_bytes))), F.sum("length")).first()
    n, size = int(n or 0), int(size or 0)
    enough = max(lengths.sparkSession.sparkContext.defaultParallelism, -(-size // TASK_BYTES), -(-n // TASK_BLOCKS))
    return max(1, min(n, enough, most))


def record_ranges(files: DataFrame, block_bytes: int) -> DataFrame:
    """``(path, line_sep, begin, end)``: ranges of whole records of plain files ``(path, length, line_sep)``."""
    n_blocks = F.ceil(F.col("length") / block_bytes).cast("long")
    blocks = files.select("path", "length", "line_sep", F.explode(F.sequence(F.lit(0).cast("long"), n_blocks - 1)).alias("block"))

    def run(batches):
        for b in batches:
            out: dict[str, list] = {name: [] for name in _EFFECTS.names}
            for path, length, sep, block in zip(*(b.column(c).to_pylist() for c in ("path", "length", "line_sep", "block")), strict=True):
                offset = block * block_bytes
                with open_file(path) as f:
                    found = block_effect(f, offset, min(block_bytes, length - offset), _CR if sep == "\r" else _LF)
                for name, value in zip(_EFFECTS.names, (path, block, *found), strict=True):
                    out[name].append(value)
            yield pa.RecordBatch.from_pydict(out, schema=_EFFECTS)

    effects = blocks.repartition(n_tasks(files, block_bytes)).select("path", "length", "line_sep", "block").mapInArrow(run, _EFFECTS_DDL)
    before = Window.partitionBy("path").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    total = F.coalesce(F.sum("toggles").over(before), F.lit(0))
    effects = effects.withColumn("total", total)
    # Toggles counted up to the last block that set the state to outside; that block's own come after it did.
    since = F.coalesce(F.last(F.when(F.col("reset"), F.col("total")), ignorenulls=True).over(before), F.lit(0))
    effects = effects.withColumn("inside", (F.col("total") - since) % 2 == 1)
    begin = F.when(F.col("block") == 0, F.lit(0).cast("long")).otherwise(F.when(F.col("inside"), F.col("first_inside")).otherwise(F.col("first_outside")))
    starts = effects.select("path", "block", begin.alias("begin")).where("begin IS NOT NULL")
    order = Window.partitionBy("path").orderBy("begin")
    starts = starts.withColumn("next", F.lead("begin").over(order))
    return (starts.join(files.select("path", "length", "line_sep"), "path")
            .select("path", "line_sep", "begin", F.coalesce("next", "length").alias("end")).where("begin < end"))


# ------------------------------------------------------------------ records
def inflated(d, data: bytes, most: int) -> Iterator[bytes]:
    """What ``data`` inflates to, at most ``most`` bytes at a time, up to the end of the gzip member."""
    while True:
        out = d.decompress(data, most)
        if out:
            yield out
        data = d.unconsumed_tail
        if d.eof or (not data and len(out) < most):
            return


def _pieces(f, size: int | None, gzipped: bool) -> Iterator[bytes]:
    """Bytes of an open file from where it stands, inflated if ``gzipped``."""
    d = zlib.decompressobj(31) if gzipped else None
    left = size
    while left is None or left > 0:
        data = f.read(READ_BYTES if left is None else min(READ_BYTES, left))
        if not data:
            return
        left = None if left is None else left - len(data)
        if d is None:
            yield data
            continue
        while data:
            if d.eof:
                data = data.lstrip(b"\0")  # padding after a member
                if not data:
                    break
                d = zlib.decompressobj(31)
            yield from inflated(d, data, READ_BYTES)
            data = d.unused_data


def records(pieces: Iterator[bytes], line_sep: str) -> Iterator[list[str]]:
    """Lists of records, without their line ends and without empty ones; the first byte starts a record."""
    end, held = (_CR if line_sep == "\r" else _LF), b""

    def text(record: bytes) -> str:
        if line_sep == "\r\n":  # also inside quotes, as the reader does
            record = record.removesuffix(b"\r").replace(b"\r\n", b"\n")
        elif line_sep == "\r":
            record = record.replace(b"\r", b"\n")
        return record.decode("utf-8", "replace")

    for data in pieces:
        held += data
        a = np.frombuffer(held, np.uint8)
        ends = np.flatnonzero(a == end)
        ends = ends[~QuoteState(a, _LF).after(ends, 0)]
        if len(ends):
            cuts = [0, *(ends + 1).tolist()]
            yield [text(held[x:y - 1]) for x, y in zip(cuts[:-1], cuts[1:], strict=True)]
            held = held[cuts[-1]:]
    if held:
        yield [text(held)]


_RECORDS = pa.schema([("filename", pa.string()), ("value", pa.string()), ("tag", pa.int64())])


def read_records(ranges: DataFrame, tasks: int) -> DataFrame:
    """``(filename, value, tag)``: every record but the header of ``ranges (path, line_sep, begin, end, gzipped, tag)``."""
    columns = ("path", "line_sep", "begin", "end", "gzipped", "tag")

    def run(batches):
        out: dict[str, list] = {name: [] for name in _RECORDS.names}
        size = 0
        for b in batches:
            for path, sep, begin, end, gzipped, tag in zip(*(b.column(c).to_pylist() for c in columns), strict=True):
                with open_file(path) as f:
                    f.seek(begin)
                    header = begin == 0
                    pieces = _pieces(f, None if gzipped else end - begin, gzipped)
                    if header:
                        pieces = _without_mark(pieces)
                    for values in records(pieces, sep):
                        values = values[1:] if header else values
                        header = False
                        values = [v for v in values if v]
                        for at in range(0, len(values), BATCH_RECORDS):
                            part = values[at:at + BATCH_RECORDS]
                            if len(out["value"]) + len(part) > BATCH_RECORDS or size > READ_BYTES:  # records of short ranges go together
                                yield pa.RecordBatch.from_pydict(out, schema=_RECORDS)
                                out, size = {name: [] for name in _RECORDS.names}, 0
                            for name, value in (("filename", [path] * len(part)), ("value", part), ("tag", [tag] * len(part))):
                                out[name] += value
                            size += sum(map(len, part))
        yield pa.RecordBatch.from_pydict(out, schema=_RECORDS)

    return ranges.repartition(tasks).select(*columns).mapInArrow(run, "filename string, value string, tag long")


def _without_mark(pieces: Iterator[bytes]) -> Iterator[bytes]:
    first = next(pieces, b"")
    yield first.removeprefix(_BOM)
    yield from pieces


def whole_texts(files: DataFrame) -> DataFrame:
    """``(path, raw_content)``: the text of files ``(path, gzipped)``, one cell each."""
    schema = pa.schema([("path", pa.string()), ("raw_content", pa.string())])

    def run(batches):
        for b in batches:
            for path, gzipped in zip(b.column("path").to_pylist(), b.column("gzipped").to_pylist(), strict=True):
                with open_file(path) as f:
                    text = b"".join(_pieces(f, None, gzipped)).decode("utf-8", "replace")
                yield pa.RecordBatch.from_pydict({"path": [path], "raw_content": [text]}, schema=schema)

    return files.select("path", "gzipped").mapInArrow(run, "path string, raw_content string")


# ------------------------------------------------------------------ parts of files
_PARTS = pa.schema([("source_path", pa.string()), ("part", pa.int64()), ("content", pa.binary())])


def file_parts(files: DataFrame, part_bytes: int) -> DataFrame:
    """``(source_path, part, content)``: files ``(source_path, length)`` as numbered parts that a cell can hold."""
    n_parts = F.ceil(F.col("length") / part_bytes).cast("long")
    parts = files.where("length > 0").select("source_path", F.explode(F.sequence(F.lit(0).cast("long"), n_parts - 1)).alias("part"))

    def run(batches):
        for b in batches:
            for path, part in zip(b.column("source_path").to_pylist(), b.column("part").to_pylist(), strict=True):
                with open_file(path) as f:
                    f.seek(part * part_bytes)
                    yield pa.RecordBatch.from_pydict({"source_path": [path], "part": [part], "content": [f.read(part_bytes)]}, schema=_PARTS)

    return parts.repartition(n_tasks(files, part_bytes)).mapInArrow(run, "source_path string, part long, content binary")
