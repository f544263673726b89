"""Source files: listing, per-file probe and classification, tolerant CSV scan.

Flow (S1-S9, S16):

1. ``list_source_files``: the ``ebbflow_files`` source (``listing``) lists names that
   start with ``_`` or ``.`` and zero-byte files too. Roots that it cannot reach
   (globs, schemes unknown to Arrow) go to Spark's ``binaryFile`` listing (content
   column pruned), which leaves hidden names out. Paths are kept as they are, not
   percent-encoded (``paths``).
2. ``probe_files``: one task per batch of files opens each file (``blocks.open_file``;
   paths that workers cannot open come through Spark's ``binaryFile`` source), sniffs
   the gzip magic, reads the header record and (for gzip) streams the rest through
   zlib to prove the stream is complete. One output row per *file*; nothing about the
   rows goes through Python.
3. ``classify_files``: OK / EMPTY_FILE / UNREADABLE / CORRUPT_GZIP / NO_HEADER.
4. ``scan_csv``: OK files are grouped by (header, compression); one Spark CSV
   read per group with an all-string schema taken from that header, so columns
   map by *name* across drifting headers, then ``unionByName``. Rows with too
   few or too many fields are split off via ``_corrupt_record`` (PERMISSIVE).
   Files that this reader cannot split or open well are read as records by
   ``blocks`` and parsed by ``from_csv``, Spark's parser: plain files longer than
   ``split_bytes`` (many tasks for one file), hidden names, and gzip members
   followed by padding.
"""

from __future__ import annotations

import csv
import hashlib
import io
import re
import zlib
from collections import defaultdict
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ebbflow import config as C
from ebbflow.functions import columns as X
from ebbflow.functions.names import unique_clean_names
from ebbflow.session import scratch_path, ship_package
from ebbflow.sources import blocks, listing
from ebbflow.sources.paths import glob_escape, norm_path, plain, plain_path

# Reads plain text even when the file name ends in .gz. The bundled Hadoop
# client relocates the passthrough key, so both spellings are set. Scoped to
# the reads that carry these options only.
PASSTHROUGH_OPTIONS = {
    "io.compression.codecs": "org.apache.hadoop.io.compress.PassthroughCodec",
    "io.compress.passthrough.extension": ".gz",
    "org.apache.hadoop.shaded.io.compress.passthrough.extension": ".gz",
}

CSV_OPTIONS = {
    "header": "true",
    "quote": '"',
    "escape": '"',
    "multiLine": "true",
    "mode": "PERMISSIVE",
    "columnNameOfCorruptRecord": "_corrupt_record",
}

PROBE_SCHEMA = T.StructType([
    T.StructField("path", T.StringType()),
    T.StructField("is_gzip", T.BooleanType()),
    T.StructField("header", T.ArrayType(T.StringType())),
    T.StructField("intact", T.BooleanType()),
    T.StructField("file_hash", T.StringType()),
    T.StructField("probe_error", T.StringType()),
    T.StructField("line_sep", T.StringType()),
    T.StructField("padded", T.BooleanType()),
])

STATUS_OK = "OK"
MAX_CELL = 1 << 30  # bytes of a file that one cell takes
SPLIT_BYTES = 128 << 20  # a longer plain file is read by several tasks
MOST_HEADERS = 64  # distinct headers that get a plan each

# Names that the scan and the processing add; a source column of such a name gets a suffix.
RESERVED_COLUMNS = ("filename", "prefix", "date", "_time", "table_name", "_corrupt_record", "__malformed", "batch_id", "reason",
                    *(name for _, name in C.PUBLISHER_PARAM_KEYS))


def list_source_files(spark: SparkSession, root: str | list[str],
                      suffix: str = C.SOURCE_SUFFIX, name_glob: str | None = None) -> DataFrame:
    """``path, file_name, length, modification_time`` for every file under
    ``root`` whose name ends with ``suffix`` (S1), or matches ``name_glob``. Listing errors raise."""
    roots = [listing.qualified(spark, r) for r in ([root] if isinstance(root, str) else list(root))]
    pattern = name_glob or f"*{suffix}"
    if all(listing.can_list(r) for r in roots):
        rows = listing.list_files(spark, roots).where(F.col("path").endswith(suffix)).select(
            "path", file_name("path").alias("file_name"), "length", "modification_time")
        return rows.where(F.col("file_name").rlike(_glob_regex(pattern)))
    return _spark_listing(spark, roots, suffix, pattern)


def _glob_regex(pattern: str) -> str:
    """The file-name patterns that ``window_glob`` makes: text and ``*``."""
    return "^" + ".*".join(re.escape(x) for x in pattern.split("*")) + "$"


def _spark_listing(spark: SparkSession, roots: list[str], suffix: str, pattern: str) -> DataFrame:
    found = (spark.read.format("binaryFile")
             .option("pathGlobFilter", pattern)
             .option("recursiveFileLookup", "true")
             .load(roots))
    rows = found.select(norm_path(F.col("path")).alias("path"), "length",
                        F.col("modificationTime").alias("modification_time"))
    # Zero-byte files never become rows; the same index of files still has them.
    indexed = [plain(p) for p in found.inputFiles()]
    indexed = [(p,) for p in indexed if p.endswith(suffix)]
    if indexed:
        every = spark.createDataFrame(indexed, "path string")
        rows = every.join(rows, "path", "left").withColumn("length", F.coalesce("length", F.lit(0).cast("long")))
        empty = [r["path"] for r in rows.where("length = 0").select("path").collect()]
        if empty:  # only zero-byte files get a file-status call, for their modification time
            times = spark.createDataFrame([(p, _mtime_ms(spark, p)) for p in empty], "path string, ms bigint")
            rows = rows.join(times, "path", "left").select(
                "path", "length", F.coalesce("modification_time", F.timestamp_millis("ms")).alias("modification_time"))
    return rows.select("path", file_name("path").alias("file_name"), "length", "modification_time")


def file_name(path: str) -> Column:
    return F.element_at(F.split(path, "/"), -1)


def _mtime_ms(spark: SparkSession, path: str) -> int:
    """Modification time (epoch ms) of one file via the Hadoop filesystem (zero-byte files only)."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return int(fs.getFileStatus(p).getModificationTime())


# The last date and time in a file's name: <tenant>_YYYY-MM-DDTHH or ...THHMM.
_NAME_TIME = r"^.*_([0-9]{4}-[0-9]{2}-[0-9]{2})T([0-9]{2})([0-9]{2})?"


def parse_hour(hour: str | int) -> tuple[str, str | None]:
    """``9``, ``'09'`` -> that hour; ``'0930'`` -> that minute of it. Others raise."""
    text = str(hour).strip()
    if text.isdigit() and text.isascii() and len(text) in (1, 2) and int(text) < 24:
        return text.zfill(2), None
    if text.isdigit() and text.isascii() and len(text) == 4 and int(text[:2]) < 24 and int(text[2:]) < 60:
        return text[:2], text[2:]
    raise ValueError(f"hour must be H, HH or HHMM, not {hour!r}")


def source_window(listing: DataFrame, date: str | None = None, hour: str | int | None = None,
                  tenants: list[str] | None = None) -> DataFrame:
    """Select files by the date / hour / tenant in their name, before any read.

    Folders above the file do not count. An hour selects all files of that
    hour; with minutes (``HHMM``) only those of that minute.
    """
    out = listing
    if date is not None:
        out = out.where(F.regexp_extract("file_name", _NAME_TIME, 1) == F.lit(date))
    if hour is not None:
        hh, mm = parse_hour(hour)
        out = out.where(F.regexp_extract("file_name", _NAME_TIME, 2) == F.lit(hh))
        if mm is not None:
            out = out.where(F.regexp_extract("file_name", _NAME_TIME, 3) == F.lit(mm))
    if tenants is not None:
        out = out.where(X.tenant_from_path("file_name").isin(list(tenants)))
    return out


def window_glob(suffix: str, date: str | None, hour: str | int | None) -> str:
    """The part of a window that the listing itself can apply."""
    if date is None:
        return f"*{suffix}"
    return f"*_{date}T{''.join(x or '' for x in parse_hour(hour)) if hour is not None else ''}*{suffix}"


# ----------------------------------------------------------------- probe
HEADER_BYTES = 16 << 20  # a file whose first record is longer has no header


def _header_fields(line: bytes) -> list[str]:
    text = line.decode("utf-8", errors="replace").lstrip("\ufeff").rstrip("\r\n")
    if not text:
        return []
    return next(csv.reader(io.StringIO(text, newline=""), quotechar='"', doublequote=True))


def _probe_stream(f, verify_gzip: bool, hash_bytes: bool, chunk: int = 1 << 20):
    """(is_gzip, header, intact, sha256-or-None, line end, padded) for one
    file-like object, streamed in ``chunk``s.

    Reads only until the header record is complete unless the gzip stream has to
    be verified or the stored bytes hashed, in which case the whole file is
    streamed once (constant memory). Zero bytes after a gzip member are padding;
    anything else there that is no further member is not intact."""
    h = hashlib.sha256() if hash_bytes else None
    buf = f.read(chunk)
    if not buf:
        return False, [], True, (h.hexdigest() if h else None), None, False
    is_gzip = buf[:2] == b"\x1f\x8b"
    full = hash_bytes or (is_gzip and verify_gzip)
    d = zlib.decompressobj(31) if is_gzip else None
    head, end = b"", None
    intact, padded = True, False
    fresh, broken = False, False  # between two gzip members; the stream does not inflate

    def take(out: bytes) -> None:
        nonlocal head, end
        if end is None and len(head) <= HEADER_BYTES:
            head += out
            end = blocks.header_end(head, whole=False)

    while buf:
        if h is not None:
            h.update(buf)
        if d is None:
            take(buf)
        data = buf if d is not None and not broken else b""
        while data:
            if fresh:
                rest = data.lstrip(b"\0")
                padded = padded or len(rest) < len(data)
                if not rest:
                    break
                d, data, fresh = zlib.decompressobj(31), rest, False
            try:
                for out in blocks.inflated(d, data, chunk):
                    take(out)
            except zlib.error:
                broken = True
            data, fresh = d.unused_data, d.eof
        if end is not None and not full:
            break
        buf = f.read(chunk)
    if d is not None and full:
        intact = d.eof and not broken
    if end is None and not buf and len(head) <= HEADER_BYTES:
        end = blocks.header_end(head, whole=True)
    header, line_sep = (_header_fields(head[:end[0]]), end[1]) if end else ([], None)
    return is_gzip, header, intact, (h.hexdigest() if h else None), line_sep, padded


PROBE_COLUMNS = [f.name for f in PROBE_SCHEMA]


def _probe_rows(items):
    out = []
    for path, opener in items:
        try:
            g, hd, ok, digest, sep, padded = opener()
            err = None
        except Exception as e:  # noqa: BLE001 - any failure quarantines the file
            g, hd, ok, digest, err, sep, padded = None, None, False, None, f"{type(e).__name__}: {e}", None, None
        out.append((path, g, hd, ok, digest, err, sep, padded))
    return pd.DataFrame(out, columns=PROBE_COLUMNS)


def _probe_one(path: str, verify_gzip: bool, hash_bytes: bool):
    with blocks.open_file(path) as f:
        return _probe_stream(f, verify_gzip, hash_bytes)


def probe_files(listing: DataFrame, verify_gzip: bool = True, hash_bytes: bool = False) -> DataFrame:
    """Listing + ``is_gzip, header, intact, file_hash, probe_error, line_sep, padded`` (one row per file).

    Files are opened by the task, ``file:`` paths as they are and others through
    Arrow's file systems, and streamed. Files of a scheme that Arrow cannot open
    (tried on one file of it) are read by Spark's ``binaryFile`` source, so with
    the Hadoop credentials that the scan itself uses, one file per cell and up to
    the 2 GB that a cell holds; longer ones are unreadable.
    """
    spark = listing.sparkSession
    ship_package(spark)
    paths = listing.where(F.col("length") > 0).select("path", "length")
    scheme = F.regexp_extract("path", "^([A-Za-z][A-Za-z0-9+.-]*)://", 1)

    def run(batches):
        for pdf in batches:
            yield _probe_rows([(p, (lambda p=p: _probe_one(p, verify_gzip, hash_bytes)))
                               for p in pdf["path"]])

    def run_bytes(batches):
        for pdf in batches:
            yield _probe_rows(
                [(p, (lambda c=c: _probe_stream(io.BytesIO(c), verify_gzip, hash_bytes)))
                 for p, c in zip(pdf["path"], pdf["content"])])

    # One file of each scheme tells whether tasks can open it; local ones need no look.
    tried = paths.where(~F.col("path").startswith("file:")).groupBy(scheme.alias("scheme")).agg(F.min("path").alias("path")).collect()
    closed = [r["scheme"] for r in tried if not blocks.reachable(r["path"])]
    cells = scheme.isin(closed) if closed else F.lit(False)
    # Spread files over tasks; the listing is one small row per file.
    n = max(1, spark.sparkContext.defaultParallelism)
    probed = paths.where(~cells).select("path").repartition(n).mapInPandas(run, PROBE_SCHEMA)
    if closed:
        remote = paths.where(cells)
        fits = [glob_escape(r["path"]) for r in remote.where(F.col("length") <= MAX_CELL).collect()]  # file metadata, one row per file
        if fits:
            blobs = spark.read.format("binaryFile").load(fits).select(norm_path(F.col("path")).alias("path"), "content")
            probed = probed.unionByName(blobs.mapInPandas(run_bytes, PROBE_SCHEMA))
        too_long = remote.where(F.col("length") > MAX_CELL).select("path", F.lit(False).alias("intact"),
                                                                   F.lit("too long for a cell").alias("probe_error"))
        probed = probed.unionByName(too_long, allowMissingColumns=True)
    return listing.join(probed, "path", "left")


def classify_files(probed: DataFrame, required: list[str] | None = None) -> DataFrame:
    """Add ``status``: OK or the reason the file is quarantined."""
    status = (F.when(F.col("length") == 0, F.lit("EMPTY_FILE"))
              .when(F.col("probe_error").isNotNull(), F.concat(F.lit("UNREADABLE: "), F.col("probe_error")))
              .when(~F.col("intact"), F.lit("CORRUPT_GZIP"))
              .when(F.col("header").isNull() | (F.size("header") == 0), F.lit("NO_HEADER")))
    if required:
        clean = F.transform("header", lambda h: F.lower(F.trim(F.regexp_replace(h, r"[{}]", ""))))
        missing = F.array_except(F.array(*[F.lit(c) for c in required]), clean)
        status = status.when(F.size(missing) > 0,
                             F.concat(F.lit("MISSING_COLUMNS: "), F.array_join(missing, ",")))
    return probed.withColumn("status", status.otherwise(F.lit(STATUS_OK)))


# ------------------------------------------------------------------ scan
@dataclass
class ScanResult:
    rows: DataFrame        # good rows: normalised columns + filename + prefix
    bad_rows: DataFrame    # filename, _corrupt_record
    files: DataFrame       # listing + probe + status
    flagged: DataFrame | None = None  # every parsed row with ``__malformed``


def empty_events(spark: SparkSession) -> DataFrame:
    """Typed, zero-row raw frame for runs where no file is readable."""
    cols = list(C.REQUIRED_COLUMNS) + ["filename", "prefix"]
    return spark.createDataFrame([], ", ".join(f"`{c}` string" for c in cols))


def _read_group(spark: SparkSession, paths: list[str], header: list[str], is_gzip: bool,
                compression: str) -> DataFrame:
    names = unique_clean_names(header, RESERVED_COLUMNS)
    schema = T.StructType([T.StructField(n, T.StringType()) for n in names]
                          + [T.StructField("_corrupt_record", T.StringType())])
    reader = spark.read.options(**CSV_OPTIONS).schema(schema)
    if compression == "none" or (compression == "sniff" and not is_gzip):
        reader = reader.options(**PASSTHROUGH_OPTIONS)
    df = reader.csv([glob_escape(p) for p in paths])
    # The reader refuses plans that read only the corrupt-record column, so the
    # flag also touches the first data column (always true, never folded away).
    malformed = F.col("_corrupt_record").isNotNull() & (F.coalesce(F.length(F.col(f"`{names[0]}`")), F.lit(0)) >= 0)
    return df.select(*[F.col(f"`{n}`") for n in names], "_corrupt_record", malformed.alias("__malformed"),
                     plain_path(F.col("_metadata.file_path")).alias("filename"))


def _file_records(files: DataFrame, split_bytes: int) -> DataFrame:
    """``(filename, value, tag)`` of every record of ``files (path, length, line_sep, gzipped, tag)``."""
    tags = files.select("path", "tag")
    plain_files = files.where(~F.col("gzipped"))
    whole = files.where(F.col("gzipped")).select("path", "line_sep", F.lit(0).cast("long").alias("begin"), F.col("length").alias("end"), "gzipped")
    ranges = blocks.record_ranges(plain_files, split_bytes).withColumn("gzipped", F.lit(False)).unionByName(whole)
    return blocks.read_records(ranges.join(tags, "path"), blocks.n_tasks(files, split_bytes))


def _parsed(records: DataFrame, width: int) -> DataFrame:
    """``records`` with ``row``: a struct of ``c0, c1, ...`` and ``_corrupt_record``."""
    ddl = ", ".join(f"c{i} string" for i in range(width)) + ", _corrupt_record string"
    options = {k: v for k, v in CSV_OPTIONS.items() if k != "header"}
    return records.withColumn("row", F.from_csv("value", ddl, options))


def _read_split(spark: SparkSession, files: DataFrame, header: list[str], split_bytes: int) -> DataFrame:
    """The rows of files of one header, from their records."""
    names = unique_clean_names(header, RESERVED_COLUMNS)
    parsed = _parsed(_file_records(files, split_bytes), len(names))
    return parsed.select(*[F.col(f"row.c{i}").alias(n) for i, n in enumerate(names)], F.col("row._corrupt_record").alias("_corrupt_record"),
                         F.col("row._corrupt_record").isNotNull().alias("__malformed"), "filename")


def _read_by_name(spark: SparkSession, files: DataFrame, headers: dict[int, tuple], split_bytes: int) -> list[DataFrame]:
    """The same for files of many headers: one plan for each width of a header, columns picked by name.

    ``files`` carries its header's number as ``tag``.
    """
    clean = {n: unique_clean_names(list(h), RESERVED_COLUMNS) for n, h in headers.items()}
    union = list(dict.fromkeys(c for names in clean.values() for c in names))
    frames = []
    for width in sorted({len(h) for h in headers.values()}):
        own = [(n, clean[n]) for n, h in headers.items() if len(h) == width]
        table = spark.createDataFrame(own, "tag long, names array<string>")
        rows = _parsed(_file_records(files.join(table.select("tag"), "tag", "left_semi"), split_bytes), width).join(table, "tag")
        here = {c for _, names in own for c in names}
        by_name = F.map_from_arrays("names", F.array(*[F.col(f"row.c{i}") for i in range(width)]))
        rows = rows.select("filename", "row", by_name.alias("by_name"))
        frames.append(rows.select(*[F.col("by_name")[c].alias(c) for c in union if c in here], F.col("row._corrupt_record").alias("_corrupt_record"),
                                  F.col("row._corrupt_record").isNotNull().alias("__malformed"), "filename"))
    return frames


def scan_csv(spark: SparkSession, files: DataFrame, compression: str = "sniff", split_bytes: int = SPLIT_BYTES) -> ScanResult:
    """Read every OK file once, union by column name.

    ``compression``: ``sniff`` (gzip magic decides per file), ``none`` (every
    file is plain text whatever its name) or ``gzip``. Plain files longer than
    ``split_bytes`` are read by several tasks.
    """
    gzipped = F.lit(False) if compression == "none" else F.lit(True) if compression == "gzip" else F.coalesce("is_gzip", F.lit(False))
    hidden = F.col("file_name").rlike("^[_.]")
    # A reader that needs the file in whole takes those that tasks cannot open themselves.
    by_records = (hidden | (gzipped & F.coalesce("padded", F.lit(False))) | (~gzipped & (F.col("length") > split_bytes)))
    ok = files.where(F.col("status") == STATUS_OK).withColumns({"gzipped": gzipped, "by_records": by_records})
    # The readers need path lists. Paths are file metadata the driver already
    # listed (one row per file, never rows of data); they are fetched as plain
    # rows and grouped here, so no task has to build one list per group.
    # A header comes once per distinct one, a path with its header's number.
    groups: dict[tuple, list[str]] = defaultdict(list)
    number = F.xxhash64("header")
    headers = {r["number"]: tuple(r["header"])
               for r in ok.groupBy(number.alias("number")).agg(F.first("header").alias("header")).collect()}
    many = len(headers) > MOST_HEADERS  # then columns are picked by name, not by a plan for each header
    split = set()
    opened: dict[str, bool] = {}
    for r in ok.select(number.alias("number"), "gzipped", "by_records", "path").collect():
        scheme = r["path"].split(":", 1)[0]
        if (many or r["by_records"]) and opened.setdefault(scheme, blocks.reachable(r["path"])):
            split.add(r["number"])
        else:
            groups[headers[r["number"]], r["gzipped"]].append(r["path"])
    frames = [_read_group(spark, sorted(paths), list(header), is_gzip, compression)
              for (header, is_gzip), paths in sorted(groups.items(), key=lambda kv: min(kv[1]))]
    closed = [s for s, is_open in opened.items() if not is_open]
    records = (ok if many else ok.where(F.col("by_records"))).select("path", "length", "line_sep", "gzipped", number.alias("tag"))
    if closed:
        records = records.where(~F.split("path", ":")[0].isin(closed))
    if many:
        frames += _read_by_name(spark, records, {n: headers[n] for n in split}, split_bytes)
    else:
        frames += [_read_split(spark, records.where(F.col("tag") == n), list(headers[n]), split_bytes) for n in sorted(split)]
    if not frames:
        empty = empty_events(spark)
        return ScanResult(empty, spark.createDataFrame([], "filename string, _corrupt_record string"), files)
    allrows = frames[0]
    for f in frames[1:]:
        allrows = allrows.unionByName(f, allowMissingColumns=True)
    good = allrows.where(~F.col("__malformed")).drop("_corrupt_record", "__malformed")
    good = good.withColumn("prefix", X.tenant_from_path("filename"))
    bad = allrows.where(F.col("__malformed")).select("filename", "_corrupt_record")
    return ScanResult(good, bad, files, allrows)


def load_events(spark: SparkSession, root: str | list[str], compression: str = "sniff",
                verify_gzip: bool = True, date: str | None = None, hour: str | int | None = None,
                tenants: list[str] | None = None, hash_bytes: bool = False,
                required_columns: list[str] | None = None, split_bytes: int = SPLIT_BYTES) -> ScanResult:
    """List -> window -> probe -> classify -> scan. The per-file classification
    is small (one row per file) and is written to the shared scratch folder
    because both the scan planning and the quarantine use it. ``required_columns`` (cleaned names) sends files
    whose header lacks any of them to quarantine as ``MISSING_COLUMNS: ...``."""
    listed = list_source_files(spark, root, name_glob=window_glob(C.SOURCE_SUFFIX, date, hour))
    windowed = source_window(listed, date, hour, tenants)
    probed = classify_files(probe_files(windowed, verify_gzip, hash_bytes), required_columns)
    path = scratch_path(spark, "files")
    probed.write.parquet(path)
    return scan_csv(spark, spark.read.schema(probed.schema).parquet(path), compression, split_bytes)
