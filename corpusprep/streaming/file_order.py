"""A stream over the files of a folder in a seeded order, epoch after epoch.

The source is a Python streaming data source whose offset is one number: the place in
the files of all epochs, each epoch a permutation of the folder by hash. It hands out
file names, a few for each micro-batch; the files themselves are read by Spark's own
Parquet reader, so columns are pruned, large files are split over many tasks, and any store
that Spark reads will do. The order is that of ``order.file_order_shuffle``; a restart on the
same checkpoint goes on at the next file, in the middle of an epoch too.
"""

from __future__ import annotations

import hashlib
import json
import re
from typing import Callable, Iterator
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition
from pyspark.sql.types import StructType

from corpusprep.operators.order import RUN_ID

NAMES = "epoch int, place long, path string"
#: Files of one micro-batch, unless the caller says otherwise.
FILES_PER_TRIGGER = 64


def file_order(files: list[str], root: str, seed: int, epoch: int) -> list[str]:
    """The files of one epoch in order: by hash of the folder below ``root`` (or of the name), then by name."""
    below = re.compile(f"/{re.escape(root.rstrip('/').rsplit('/', 1)[-1])}/(.*)$")

    def place(path: str) -> tuple[str, str]:
        found = below.search(unquote(path))
        name = re.sub(RUN_ID, "", found.group(1) if found else "")
        folder = name.rpartition("/")[0]
        return hashlib.md5(f"{seed}:files:{epoch}:{folder or name}".encode(), usedforsecurity=False).hexdigest(), name

    return sorted(files, key=place)


class Names(InputPartition):
    def __init__(self, rows: list[tuple[int, int, str]]):
        self.rows = rows


class FileOrderReader(DataSourceStreamReader):
    def __init__(self, options: dict):
        self.files = json.loads(options["files"])
        self.root, self.seed = options["root"], int(options["seed"])
        self.step = int(options["files_per_trigger"])
        self.end = min(len(self.files) * int(options["epochs"]), int(options["until"]))
        self.at: int | None = None
        self.epochs: dict[int, list[str]] = {}

    def initialOffset(self) -> dict:
        return {"place": 0}

    def latestOffset(self) -> dict:
        at = self.at or 0
        self.at = max(at, min(at + self.step, self.end))
        return {"place": self.at}

    def partitions(self, start: dict, end: dict) -> list[Names]:
        if self.at is None:  # a restart plans the last batch of the log first
            self.at = end["place"]
        rows = []
        for place in range(start["place"], end["place"]):
            epoch, k = divmod(place, len(self.files))
            if epoch not in self.epochs:
                self.epochs = {epoch: file_order(self.files, self.root, self.seed, epoch)}
            rows.append((epoch, place, self.epochs[epoch][k]))
        return [Names(rows)]

    def read(self, partition: Names) -> Iterator[tuple]:
        yield from partition.rows


class FileOrderSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "file_order"

    def schema(self) -> str:
        return NAMES

    def streamReader(self, schema: StructType) -> FileOrderReader:
        return FileOrderReader(self.options)


def stream_names(
    spark: SparkSession, root: str, seed: int = 42, epochs: int = 1, files_per_trigger: int = FILES_PER_TRIGGER, until: int | None = None
) -> DataFrame:
    """(epoch, place, path) of the Parquet files below ``root``, ``files_per_trigger`` a micro-batch, up to place ``until``."""
    if files_per_trigger < 1 or epochs < 1:
        raise ValueError("files_per_trigger and epochs must be at least 1")
    spark.dataSource.register(FileOrderSource)
    files = sorted(spark.read.parquet(root).inputFiles())
    options = {"files": json.dumps(files), "root": root, "seed": str(seed), "epochs": str(epochs), "files_per_trigger": str(files_per_trigger)}
    options["until"] = str(2**62 if until is None else until)
    return spark.readStream.format("file_order").options(**options).load()


def read_named(spark: SparkSession, names: DataFrame, root: str, schema: StructType | str) -> DataFrame:
    """The rows of the files of one micro-batch with ``epoch``, ``place`` and ``row_in_file``."""
    rows = names.collect()  # at most files_per_trigger names
    reader = spark.read.schema(schema).option("basePath", root)
    columns = [F.col("_metadata.file_path").alias("_path"), F.col("_metadata.row_index").alias("row_in_file")]
    paths = sorted({r.path for r in rows})
    if not paths:
        return reader.parquet(root).select("*", *columns).limit(0).select("*", F.lit(0).alias("epoch"), F.lit(0).cast("long").alias("place")).drop("_path")
    data = reader.parquet(*paths).select("*", *columns)
    # Hadoop and the reader may spell the scheme of a local path with one or three slashes
    plain = lambda c: F.regexp_replace(F.url_decode(F.regexp_replace(c, r"\+", "%2B")), "^file:/+", "file:/")
    where = spark.createDataFrame([tuple(r) for r in rows], NAMES).select("epoch", "place", plain(F.col("path")).alias("_path"))
    return data.withColumn("_path", plain(F.col("_path"))).join(F.broadcast(where), "_path").drop("_path")


def in_file_order(rows: DataFrame) -> tuple[DataFrame, int]:
    """The rows of one micro-batch with ``idx``, their dense position by (place, row in file), and their number.

    A row's number in its file is known from the scan, so only the rows of each file are
    counted (from the footers; one number a file reaches the driver) and nothing is sorted.
    """
    counts = dict(rows.groupBy("place").count().collect())
    before, at = {}, 0
    for place in sorted(counts):
        before[place], at = at, at + counts[place]
    first = F.element_at(F.create_map(*[F.lit(x).cast("long") for kv in before.items() for x in kv]), F.col("place")) if before else F.lit(0).cast("long")
    return rows.withColumn("idx", first + F.col("row_in_file")), at


def run_in_order(
    spark: SparkSession,
    root: str,
    schema: StructType | str,
    checkpoint: str,
    write: Callable[[DataFrame, int], None],
    seed: int = 42,
    epochs: int = 1,
    files_per_trigger: int = FILES_PER_TRIGGER,
    until: int | None = None,
) -> None:
    """``write(rows, batch id)`` for every micro-batch of files, to the end of the epochs or up to place ``until``.

    A run on the checkpoint of an earlier one goes on where that one ended; a micro-batch
    that was begun and not committed is done again under the same id.
    """

    def body(names: DataFrame, batch_id: int) -> None:
        write(read_named(names.sparkSession, names, root, schema), batch_id)

    names = stream_names(spark, root, seed, epochs, files_per_trigger, until)
    query = names.writeStream.foreachBatch(body).option("checkpointLocation", checkpoint).start()
    try:
        query.processAllAvailable()
    finally:
        query.stop()


__all__ = ["FILES_PER_TRIGGER", "FileOrderSource", "file_order", "in_file_order", "read_named", "run_in_order", "stream_names"]
