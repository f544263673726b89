"""One spelling for file paths.

Spark names files in two ways: ``binaryFile.path`` holds the path as it is,
``_metadata.file_path`` and ``inputFiles()`` hold it percent-encoded. Here a
path is always the plain one, with ``file:/x`` for ``file:///x``.
"""

from __future__ import annotations

import re
from urllib.parse import unquote

from pyspark.sql import Column
from pyspark.sql import functions as F


def norm_path(c: Column) -> Column:
    """A plain path in its one spelling."""
    return F.regexp_replace(c, r"^file:///", "file:/")


def plain_path(c: Column) -> Column:
    """An encoded path in its one spelling ('+' stands for itself in a path)."""
    return norm_path(F.url_decode(F.replace(c, F.lit("+"), F.lit("%2B"))))


def plain(path: str) -> str:
    return re.sub(r"^file:///", "file:/", unquote(path))


def glob_escape(path: str) -> str:
    """A path that readers take for this one file, whatever its name holds."""
    return re.sub(r"([\\{}\[\]*?])", r"\\\1", path)
