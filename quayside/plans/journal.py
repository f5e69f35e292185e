"""What a run has begun: a folder while it runs, and in it what it is about to publish.

Files that are loaded are named here before any table or view shows them. If the run dies after that, the next run of the
category finishes it under its own number: it registers, shows and archives the same files again, which
changes nothing that is done already. A run that dies before has shown nothing; its open steps end as errors and its files
are loaded again.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from dataclasses import asdict
from datetime import datetime

from pyspark.sql import SparkSession
from pyspark.sql import types as T

from quayside.plans.load import FileLoad
from quayside.sources import hadoop

_MOMENTS = ("started", "ended")


def _as_text(load: FileLoad) -> dict:
    held = asdict(load) | {"schema": load.schema and load.schema.jsonValue()}
    return held | {name: held[name] and held[name].isoformat() for name in _MOMENTS}


def _from_text(held: dict) -> FileLoad:
    moments = {name: held[name] and datetime.fromisoformat(held[name]) for name in _MOMENTS}
    return FileLoad(**(held | moments | {"schema": held["schema"] and T.StructType.fromJson(held["schema"])}))


class Journal:
    def __init__(self, spark: SparkSession, folder: str, run_id: str):
        self.spark, self.folder, self.run_id = spark, folder, run_id
        self._own = f"{folder}/{run_id}"

    def begin(self) -> None:
        hadoop.make_folder(self.spark, self._own)

    def will_publish(self, loads: list[FileLoad], driven_by: str) -> None:
        text = json.dumps({"driven_by": driven_by, "loads": [_as_text(f) for f in loads]})
        hadoop.write_new(self.spark, f"{self._own}/publish.json", text)

    def intent(self) -> tuple[str, list[FileLoad]] | None:
        """How the run was driven and what it was about to publish, if it came that far."""
        if "publish.json" not in hadoop.names_in(self.spark, self._own):
            return None
        try:
            held = json.loads(hadoop.read_text(self.spark, f"{self._own}/publish.json"))
        except ValueError:  # it died while it wrote this, so nothing is published
            return None
        return held["driven_by"], [_from_text(f) for f in held["loads"]]

    def end(self) -> None:
        hadoop.delete(self.spark, self._own)

    def unfinished(self) -> Iterator[Journal]:
        """The journals of other runs that never ended."""
        hadoop.make_folder(self.spark, self.folder)
        for run_id in sorted(hadoop.names_in(self.spark, self.folder)):
            if run_id != self.run_id:
                yield Journal(self.spark, self.folder, run_id)
