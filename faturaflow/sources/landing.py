"""A landing log: many small files that land at any time become few segments in order.

A sweep takes up to `most` files out of the landing folder, whatever their age, writes their lines as
one Parquet segment and then removes them from the folder. A file is never listed again, and the driver
holds the names of one sweep at a time, however many files have landed since the beginning.
Segments are written by sweeps only, so their times ascend, and a file stream over the log may forget
those older than `LOG_AGE`: nothing can land between them any more.

A sweep first writes which files it takes. One that was cut short is finished by the next
sweep: a segment that is there whole is kept, otherwise it is written again. A segment that
was read before it was written again repeats its lines, which the ids' registry leaves out.
"""

from __future__ import annotations

import json
from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from faturaflow.sources import files

#: Files of a sweep, and how long a stream remembers the segments that it has read.
MOST, LOG_AGE = 10_000, "7d"


class LandingLog:
    """Log of the folder `landing`, at `root`: `intent.json`, and `segments` with a folder per sweep."""

    def __init__(self, spark: SparkSession, landing: str, root: str, most: int = MOST):
        self.spark, self.landing, self.root, self.most = spark, landing.rstrip("/"), root.rstrip("/"), most

    @property
    def segments(self) -> str:
        return f"{self.root}/segments"

    def _landed(self) -> Iterator[str]:
        """Files that lie in the folder, listed as they are asked for."""
        folder, fs = files.hadoop_path(self.spark, self.landing)
        if not fs.exists(folder):
            return
        listed = fs.listStatusIterator(folder)
        while listed.hasNext():
            status = listed.next()
            name = status.getPath().getName()
            if status.isFile() and not name.startswith(("_", ".")):
                yield status.getPath().toString()

    def _intent(self) -> dict | None:
        path = f"{self.root}/intent.json"
        return json.loads(files.read_text(self.spark, path)) if files.exists(self.spark, path) else None

    def _finish(self, intent: dict) -> None:
        path = f"{self.segments}/sweep={intent['sweep']}"
        if not files.exists(self.spark, f"{path}/_SUCCESS"):
            lines = self.spark.read.text(intent["files"])
            # Small files are read many to a task; a segment has a file per task.
            lines.write.mode("overwrite").parquet(path)
        for name in intent["files"]:
            files.delete(self.spark, name)

    def sweep(self) -> int:
        """Takes one sweep's files; how many there were."""
        last = self._intent()
        if last is not None:
            self._finish(last)
        taken = [name for name, _ in zip(self._landed(), range(self.most))]
        if not taken:
            return 0
        intent = {"sweep": last["sweep"] + 1 if last else 0, "files": taken}
        files.write_text(self.spark, f"{self.root}/intent.json", json.dumps(intent))
        self._finish(intent)
        return len(taken)

    def drain(self) -> int:
        """Sweeps until the folder is empty; how many files there were."""
        total = 0
        while n := self.sweep():
            total += n
        return total

    def stream(self, parse: Column, max_file_age: str = LOG_AGE) -> DataFrame:
        """The lines of all segments as a stream of (value, ts): `parse` is applied to the column `value`."""
        _, fs = files.hadoop_path(self.spark, self.segments)
        fs.mkdirs(files.hadoop_path(self.spark, self.segments)[0])
        reader = self.spark.readStream.schema("value string, sweep long").option("maxFileAge", max_file_age)
        return reader.parquet(self.segments).select(parse.alias("value"), F.current_timestamp().alias("ts"))
