"""Files whose names Spark's readers pass over, under names that they read.

Readers take names that begin with ``_`` or ``.`` for their own bookkeeping. A read gives each such file a
visible name in a mount table of its own, which travels with the read's options to listing and tasks. Nothing
is renamed or copied, so other readers see the folder as it is, and a crash leaves nothing behind.
"""

from __future__ import annotations

import re
from collections.abc import Sequence
from urllib.parse import quote
from uuid import uuid4

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

from quayside.functions import names
from quayside.sources.hadoop import glob_safe, uri_of

# What the readers pass over (Spark's rule for names of files).
_HIDDEN = re.compile(r"_[^=]*$|\..*|.*\._COPYING_$", re.DOTALL)
#: Kept, as the compression of a file is known by it.
_SUFFIX = re.compile(r"(\.[a-z0-9]+)?$")


def is_hidden(name: str) -> bool:
    return _HIDDEN.match(name) is not None


class Visible:
    """Paths as a reader takes them, the options it needs for that, and the way back to the files."""

    def __init__(self, spark: SparkSession, paths: Sequence[str]):
        mount = f"m{uuid4().hex}"
        self.paths: list[str] = []
        self.options: dict[str, str] = {}
        self._back: dict[str, str] = {}
        for path in paths:
            name = path.rsplit("/", 1)[-1]
            if not is_hidden(name):
                self.paths.append(glob_safe(path))
                continue
            shown = f"/f{len(self._back)}{_SUFFIX.search(name)[0]}"
            self.options[f"fs.viewfs.mounttable.{mount}.link.{shown}"] = uri_of(spark, path)
            self._back[f"viewfs://{mount}{shown}"] = quote(path, safe="/:")
            self.paths.append(f"viewfs://{mount}{shown}")

    def uri(self) -> Column:
        """The scanned file's own path, URL-encoded as a scan reports it."""
        scanned = names.scanned_uri()
        if not self._back:
            return scanned
        pairs = [F.lit(text) for pair in self._back.items() for text in pair]
        return F.coalesce(F.element_at(F.create_map(*pairs), scanned), scanned)
