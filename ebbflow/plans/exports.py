"""Write the adapted raw events out as CSV source files, the way the upstream
exporter delivers them, so the file-source operators can be run on data that
Spark derives from the provided tables.

One file per (tenant, day) named ``<tenant>_<YYYY-MM-DD>T00.csv.gz``:

* even days use header layout A (``{adid},{created_at},...`` with braces),
  odd days layout B (other order, bare names, no ``device_type``, an extra
  ``{extra}`` column) -> union by name, missing columns -> NULL;
* files of the first two tenants are real gzip, the rest plain text despite
  the ``.gz`` suffix -> compression sniffing / passthrough;
* rows whose ``created_at`` ends in ``13`` lose their last field -> malformed;
* the ``city`` of some users holds a comma, quotes and a newline -> quoting.

More files are added next to them: zero bytes, a truncated gzip stream, header
only, some of these under names with blanks, ``#``, ``%`` and brackets (see
``BROKEN_FILES``), and copies cut after ``CUT_BYTES`` bytes of the exports that
the first gzip tenant sends on every seventh day (``<tenant>-cut_...``).
"""

from __future__ import annotations

import gzip
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ebbflow.plans import adapters as A
from ebbflow.session import scratch_path

LAYOUT_A = ["{adid}", "{created_at}", "{installed_at}", "{activity_kind}", "{publisher_parameters}",
            "{country}", "{city}", "{os_name}", "{device_type}", "{app_version_short}"]
LAYOUT_B = ["created_at", "adid", "activity_kind", "installed_at", "publisher_parameters",
            "app_version_short", "os_name", "country", "city", "{extra}"]
GZIP_TENANTS = A.ADAPTER_TENANTS[:2]
MALFORMED_SUFFIX = "13"

# name -> (bytes, expected status)
BROKEN_FILES = {
    f"{A.ADAPTER_TENANTS[0]}_2024-02-01T00.csv.gz": (b"", "EMPTY_FILE"),
    f"{A.ADAPTER_TENANTS[1]}_2024-02-01T00.csv.gz": (",".join(LAYOUT_A).encode() + b"\n", "OK"),
    f"{A.ADAPTER_TENANTS[2]}_2024-02-01T00.csv.gz": (
        gzip.compress((",".join(LAYOUT_A) + "\n" + "u1,1\n" * 2000).encode(), mtime=0)[:40],
        "CORRUPT_GZIP"),
    # Legal names that need care in paths and globs.
    **{f"{name}_2024-02-01T00.csv.gz": (",".join(LAYOUT_B).encode() + b"\n", "OK")
       for name in ("my app", "a#b", "a%41+b", "a[1]{x}")},
}
# Exports of the first gzip tenant on every seventh day also arrive cut short.
CUT_BYTES = 40


def _field(c: str) -> F.Column:
    """CSV-encode one value: NULL -> empty, else quoted with doubled quotes."""
    v = F.col(f"`{c}`")
    return F.when(v.isNull(), F.lit("")).otherwise(
        F.concat(F.lit('"'), F.replace(v, F.lit('"'), F.lit('""')), F.lit('"')))


def _lines(raw: DataFrame, layout: list[str]) -> F.Column:
    src = {c: c if c in raw.columns else None for c in layout}
    fields = []
    for c in layout:
        if c == "{extra}":
            fields.append(F.lit('"x"'))
        else:
            name = c if src[c] else "{" + c + "}"
            fields.append(_field(name))
    full = F.concat_ws(",", *fields)
    short = F.concat_ws(",", *fields[:-1])
    bad = F.col("`{created_at}`").endswith(MALFORMED_SUFFIX)
    return F.when(bad, short).otherwise(full)


def _hadoop_fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    p = jvm.org.apache.hadoop.fs.Path(path)
    return jvm, p.getFileSystem(conf)


def write_exports(spark: SparkSession, events: DataFrame, root: str | None = None) -> str:
    """Write the CSV source files under a fresh folder; returns the folder."""
    root = root or scratch_path(spark, "exports")
    raw = A.raw_events(events)
    base = F.element_at(F.split("filename", "/"), -1)
    day = F.coalesce(F.regexp_extract(base, r"_[0-9]{4}-[0-9]{2}-([0-9]{2})T", 1).try_cast("int"), F.lit(0))
    tenant = F.regexp_extract(base, r"^(.*)_[0-9]{4}-", 1)
    rows = raw.select(
        base.alias("file"),
        (day % 2 == 0).alias("layout_a"),
        tenant.isin(GZIP_TENANTS).alias("gz"),
        F.when(day % 2 == 0, _lines(raw, LAYOUT_A)).otherwise(_lines(raw, LAYOUT_B)).alias("line"),
        F.lit(1).alias("ord"),
    )
    heads = rows.select("file", "layout_a", "gz").distinct().select(
        "file", "layout_a", "gz",
        F.when(F.col("layout_a"), F.lit(",".join(LAYOUT_A))).otherwise(F.lit(",".join(LAYOUT_B))).alias("line"),
        F.lit(0).alias("ord"))
    allrows = rows.unionByName(heads)
    stage = root + "/_stage"
    for gz in (True, False):
        part = allrows.where(F.col("gz") == F.lit(gz)).select("file", "line", "ord")
        # One task per file so each file is written once, header first, then its lines in order.
        (part.repartition("file").sortWithinPartitions("file", "ord", "line")
         .select("file", "line").write.partitionBy("file")
         .option("compression", "gzip" if gz else "none")
         .mode("errorifexists").text(f"{stage}/{'gz' if gz else 'plain'}"))
    jvm, fs = _hadoop_fs(spark, root)
    Path = jvm.org.apache.hadoop.fs.Path
    out = f"{root}/data"
    fs.mkdirs(Path(out))
    for sub in ("gz", "plain"):
        for d in fs.listStatus(Path(f"{stage}/{sub}")):
            name = d.getPath().getName()
            if not d.isDirectory() or not name.startswith("file="):
                continue
            target = Path(out, unquote(name[len("file="):]))
            parts = [s.getPath() for s in fs.listStatus(d.getPath()) if s.getPath().getName().startswith("part-")]
            if len(parts) != 1:
                raise RuntimeError(f"expected one part file in {name}, found {len(parts)}")
            fs.rename(parts[0], target)
    cut = (spark.read.format("binaryFile").option("pathGlobFilter", f"{GZIP_TENANTS[0]}_*").load(out)
           .withColumn("file", F.element_at(F.split("path", "/"), -1))
           .where(F.regexp_extract("file", r"_[0-9]{4}-[0-9]{2}-([0-9]{2})T", 1).cast("int") % 7 == 3)
           .select("file", F.expr(f"substring(content, 1, {CUT_BYTES})").alias("head")))
    extra = {name: payload for name, (payload, _) in BROKEN_FILES.items()}
    extra |= {r["file"].replace("_", "-cut_", 1): bytes(r["head"]) for r in cut.collect()}
    for name, payload in extra.items():
        stream = fs.create(Path(out, name), True)
        if payload:
            stream.write(bytearray(payload))
        stream.close()
    return out


_EXPORTS: dict[tuple[str, str], str] = {}


def export_root(spark: SparkSession, sf_dir: str) -> str:
    """Exports for ``sf_dir``, written once per Spark application and reused by
    the round-trip queries (they only read them)."""
    from ebbflow.plans.catalog import _app_id
    key = (_app_id(spark), sf_dir)
    if key not in _EXPORTS:
        _EXPORTS[key] = write_exports(spark, A.table(spark, sf_dir, "events"))
    return _EXPORTS[key]
