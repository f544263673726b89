"""Content that was sent before, in another file.

Equal file names or hashes find a file that is sent again as it was. Exports
also come again in part: with rows added, or cut. Here a file's text is cut
into chunks at lines that their own digest picks, so the cuts of a passage are
the same wherever it stands in a file, and an insertion changes only the chunks
around it. Each chunk belongs to the first file that held it, and every other
file's chunks are counted by that file.

A chunk of very many files (a header) is one row after a map-side aggregate;
where rows meet it again, chunks that hold more than a thousandth of all rows,
of which there are fewer than a thousand, are broadcast, and the others joined.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

HOT_SHARE = 1000  # a chunk with more than one in so many of all chunk rows is hot


def ends_chunk(line: Column, average: int) -> Column:
    """Whether a chunk ends with this line: on average one in ``average`` does."""
    return F.conv(F.substring(F.md5(line), 1, 8), 16, 10).cast("long") % average == 0


def file_chunks(files: DataFrame, average_lines: int = 4) -> DataFrame:
    """``(file_name, load_timestamp, digest, n_chars)`` of every chunk; ``files (file_name, load_timestamp, raw_content)``."""
    lines = files.where("raw_content <> ''").select("file_name", "load_timestamp", F.xxhash64("raw_content").alias("load"),
                                                      F.posexplode(F.split("raw_content", "\n")).alias("at", "line"))
    # Lines of one file meet in one task, as they did in one cell.
    before = Window.partitionBy("file_name", "load_timestamp", "load").orderBy("at").rowsBetween(Window.unboundedPreceding, -1)
    ended = F.coalesce(F.sum(ends_chunk(F.col("line").cast("binary"), average_lines).cast("long")).over(before), F.lit(0))
    chunks = lines.withColumn("chunk", ended).groupBy("file_name", "load_timestamp", "load", "chunk").agg(
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("at", "line"))), lambda x: x["line"]), "\n").alias("text"))
    return chunks.where("text <> ''").select("file_name", "load_timestamp", F.md5("text").alias("digest"), F.char_length("text").cast("long").alias("n_chars"))


def overlapping_files(chunks: DataFrame) -> DataFrame:
    """``(file_name, earlier_file, shared_chunks, shared_chars, file_chunks)``: chunks that another file held first.

    The first file of a chunk is the one with the smallest load time, then name.
    """
    first = F.min(F.struct("load_timestamp", "file_name"))
    owners = chunks.groupBy("digest").agg(first.alias("first"), F.count(F.lit(1)).alias("n")).select(
        "digest", F.col("first.file_name").alias("earlier_file"), "n").where("n > 1")
    hot = F.col("n") * HOT_SHARE > F.lit(chunks.count())
    sizes = chunks.groupBy("file_name").agg(F.count(F.lit(1)).alias("file_chunks"))
    few = F.broadcast(owners.where(hot).drop("n"))  # fewer than HOT_SHARE rows
    rest = chunks.join(few.select("digest"), "digest", "left_anti").join(owners.where(~hot).drop("n"), "digest")
    found = chunks.join(few, "digest").unionByName(rest).where("file_name <> earlier_file")
    pairs = found.groupBy("file_name", "earlier_file").agg(F.count(F.lit(1)).alias("shared_chunks"), F.sum("n_chars").cast("long").alias("shared_chars"))
    return pairs.join(sizes, "file_name").select("file_name", "earlier_file", "shared_chunks", "shared_chars", "file_chunks")
