"""Parquet sources: listing, declared/inferred scans, named sources and splits."""

from __future__ import annotations

from typing import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from corpusprep.operators.index import dense_index
from corpusprep.operators.schema import SAMPLE_SCHEMA, conform


def _hadoop_path(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark._jsc.hadoopConfiguration())


def qualified(spark: SparkSession, path: str) -> str:
    """``path`` as the file system names it."""
    p, fs = _hadoop_path(spark, path)
    return fs.makeQualified(p).toString().rstrip("/")


def has_files(spark: SparkSession, path: str) -> bool:
    """Whether ``path`` exists and holds anything, in whatever store Spark reads it from."""
    p, fs = _hadoop_path(spark, path)
    return fs.exists(p) and len(fs.listStatus(p)) > 0


def list_files(spark: SparkSession, directory: str) -> DataFrame:
    """One-level listing of the regular files of ``directory``: (position, path, bytes), by path.

    Runs as a distributed listing (``binaryFile`` with its content pruned
    away), so a folder of a million shards is not listed by one thread.
    Spark skips names beginning with ``_`` or ``.``; those are not data.
    """
    base = qualified(spark, directory)
    # recursive lookup so plain files beside partition-style folders are seen
    # (partition discovery would hide them), then one level only is kept
    listed = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(directory)
    parent = F.regexp_extract(F.col("path"), r"^(.*)/[^/]+$", 1)
    own = listed.filter(parent == base).select(F.col("path"), F.col("length").alias("bytes"))
    return dense_index(own, ["path"], name="position").select("position", "path", "bytes")


def read_declared(spark: SparkSession, paths, schema: StructType, columns: Sequence[str] | None = None) -> DataFrame:
    """Scan with a declared schema (no inference) and an optional column subset.

    The subset is a plain ``select``: Catalyst prunes it into the scan.
    """
    paths = [paths] if isinstance(paths, str) else list(paths)
    df = spark.read.schema(schema).parquet(*paths)
    return df.select(*columns) if columns else df


def read_samples(spark: SparkSession, paths, feature_shape: tuple[int, int] | None = None) -> DataFrame:
    """Sample files under the declared schema, whether their feature matrix is stored flat or in two dimensions."""
    found = read_inferred(spark, paths)
    return conform(found, SAMPLE_SCHEMA, feature_shape=feature_shape)


def read_inferred(spark: SparkSession, paths) -> DataFrame:
    paths = [paths] if isinstance(paths, str) else list(paths)
    return spark.read.parquet(*paths)


def read_named_splits(spark: SparkSession, files: Mapping[str, str], name: str = "split") -> DataFrame:
    """Explicit files bound to split names, as one frame with a split column."""
    out = None
    for split, path in files.items():
        df = spark.read.parquet(path).withColumn(name, F.lit(split))
        out = df if out is None else out.unionByName(df, allowMissingColumns=True)
    if out is None:
        raise ValueError("no split files given")
    return out


def read_split(spark: SparkSession, root: str, split: str, name: str = "split") -> DataFrame:
    """Rows of one split of a dataset: of the folder ``<root>/<split>``, else of one written ``partitionBy(split)``.

    A plain split folder is read alone; the filter on a partition column prunes whole directories.
    """
    plain = f"{root.rstrip('/')}/{split}"
    if has_files(spark, plain):
        return spark.read.parquet(plain).withColumn(name, F.lit(split))
    return spark.read.option("basePath", root).parquet(root).filter(F.col(name) == split)


def read_saved(spark: SparkSession, root: str, eval_root: str | None = None) -> tuple[DataFrame, DataFrame]:
    """A whole saved dataset for training and evaluation.

    The reference loads the same path for both; a distinct evaluation folder
    can be given, and a warning is printed when they are the same.
    """
    train = spark.read.parquet(root)
    if eval_root is None or eval_root == root:
        import warnings

        warnings.warn("evaluation reads the training folder", stacklevel=2)
        return train, train
    return train, spark.read.parquet(eval_root)


def tag_sources(df: DataFrame, column: str, names: Sequence[str], name: str = "source_id") -> DataFrame:
    """Keep the rows of the registered sources, tagged with their registry position.

    The registry is an ordered list of names, so weights given by name can
    never shift to another source.
    """
    pos = F.create_map(*[F.lit(x) for i, n in enumerate(names) for x in (n, i)])
    return df.filter(F.col(column).isin(list(names))).withColumn(name, F.element_at(pos, F.col(column)).cast("int"))


def read_sources(
    spark: SparkSession, sources: Mapping[str, str], schema: StructType | None = None, columns: Sequence[str] | None = None
) -> DataFrame:
    """Union of one folder per named source, in registry order, tagged by id and name."""
    out = None
    for i, (src, path) in enumerate(sources.items()):
        df = read_declared(spark, path, schema, columns) if schema is not None else spark.read.parquet(path)
        if columns and schema is None:
            df = df.select(*columns)
        df = df.withColumn("source_id", F.lit(i)).withColumn("source_name", F.lit(src))
        out = df if out is None else out.unionByName(df)
    if out is None:
        raise ValueError("at least one source is needed")
    return out


#: Last bytes of a file that are read first; a longer footer is read by a second call.
TAIL_BYTES = 64 << 10
#: Threads of the driver that read footers, and rows that the driver holds before it writes them to the shared folder.
FOOTER_THREADS = 16
FOOTER_ROWS = 1 << 18


def _footer(spark: SparkSession, path: str, length: int) -> list[int]:
    """Rows of each row group of a Parquet file, from its footer; nothing else of the file is read but ``TAIL_BYTES`` at most."""
    import pyarrow as pa
    import pyarrow.parquet as pq

    p, fs = _hadoop_path(spark, path)
    stream = fs.open(p)

    def end(size: int) -> bytes:
        stream.seek(length - size)
        return bytes(stream.readNBytes(size))

    try:
        tail = end(min(length, TAIL_BYTES))
        if tail[-4:] != b"PAR1" or length < 12:
            raise ValueError(f"{path} is not a Parquet file")
        size = int.from_bytes(tail[-8:-4], "little") + 8
        if size > length - 4:
            raise ValueError(f"{path} is cut off: its footer would be {size} of {length} bytes")
        if size > len(tail):
            tail = end(size)
    finally:
        stream.close()
    meta = pq.read_metadata(pa.BufferReader(b"PAR1" + tail[-size:]))
    return [meta.row_group(k).num_rows for k in range(meta.num_row_groups)]


def row_groups(spark: SparkSession, path: str) -> DataFrame:
    """(file, group, n_rows): the row groups of every Parquet file below ``path``, from the files' footers.

    Files are listed by Spark and their ends are read, whatever the size of the files, by threads of the
    driver through the store that Spark reads from, as Spark itself reads footers for a schema. The driver holds the footers of ``FOOTER_THREADS``
    files and ``FOOTER_ROWS`` row groups or so; more of them go to the shared folder.
    """
    from collections import deque
    from concurrent.futures import ThreadPoolExecutor

    import pyarrow as pa

    from corpusprep.session import scratch_path

    listed = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.parquet").load(path)
    columns: tuple[list, list, list] = ([], [], [])
    written = None

    def held() -> DataFrame:
        arrays = [pa.array(c, t) for c, t in zip(columns, (pa.string(), pa.int64(), pa.int64()))]
        return spark.createDataFrame(pa.table(arrays, names=["file", "group", "n_rows"]))

    with ThreadPoolExecutor(FOOTER_THREADS) as pool:
        waiting: deque = deque()

        def take() -> None:
            nonlocal written
            name, found = waiting.popleft()
            counts = found.result()
            for column, values in zip(columns, ([name] * len(counts), range(len(counts)), counts)):
                column.extend(values)
            if len(columns[0]) >= FOOTER_ROWS:
                written = written or scratch_path(spark, "row-groups")
                held().write.mode("append").parquet(written)
                for column in columns:
                    column.clear()

        for r in listed.select("path", "length").coalesce(64).toLocalIterator():
            waiting.append((r.path, pool.submit(_footer, spark, r.path, r.length)))
            if len(waiting) >= 2 * FOOTER_THREADS:
                take()
        while waiting:
            take()
    last = held()
    return last if written is None else spark.read.schema(last.schema).parquet(written).unionByName(last)
