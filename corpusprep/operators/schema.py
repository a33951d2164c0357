"""Schema operators: declared sample schema, conform, require, flatten, numeric view."""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The declared sample schema of the mixing job.  The 2-D
# feature matrix is stored flat; its shape is (80, 3000) or (128, 3000).
FEATURE_SHAPES = {"whisper-small": (80, 3000), "whisper-large": (128, 3000)}

SAMPLE_SCHEMA = T.StructType(
    [
        T.StructField("input_features", T.ArrayType(T.FloatType())),
        T.StructField("attention_mask", T.ArrayType(T.IntegerType())),
        T.StructField("labels", T.ArrayType(T.IntegerType())),
        T.StructField("labels_timestamps", T.ArrayType(T.IntegerType())),
        T.StructField("text", T.StringType()),
        T.StructField("text_timestamps", T.StringType()),
        T.StructField("previous_text", T.StringType()),
        T.StructField("duration", T.FloatType()),
        T.StructField("audio_path", T.StringType()),
        T.StructField("is_silence", T.BooleanType()),
        T.StructField("stage2_whisper_timestamps", T.BooleanType()),
        T.StructField("data_source", T.StringType()),
    ]
)
NUMERIC_COLUMNS = ["input_features", "attention_mask", "labels", "labels_timestamps"]
METADATA_COLUMNS = ["data_source", "audio_path", "duration", "is_silence"]


def feature_shape(extractor: str) -> tuple[int, int]:
    try:
        return FEATURE_SHAPES[extractor]
    except KeyError:
        raise ValueError(f"unknown feature extractor {extractor!r}; known: {sorted(FEATURE_SHAPES)}") from None


def require_columns(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Fail before any action if a named column is missing, listing what exists."""
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise ValueError(f"columns {missing} not found; available: {', '.join(df.columns)}")
    return df


def flat_features(features, shape: tuple[int, int] | None = None) -> Column:
    """A 2-D feature matrix row by row as one array; a matrix of another ``shape`` fails, a null one stays null."""
    c = F.col(features) if isinstance(features, str) else features
    if shape is None:
        return F.flatten(c)
    right = (F.size(c) == shape[0]) & F.forall(c, lambda row: F.size(row) == shape[1])
    wrong = F.concat(F.lit(f"feature matrix is not {shape[0]} x {shape[1]} but has rows: "), F.size(c).cast("string"))
    return F.when(c.isNull() | right, F.flatten(c)).otherwise(F.raise_error(wrong))


def conform(df: DataFrame, schema: T.StructType, fields: Sequence[str] | None = None, feature_shape: tuple[int, int] | None = None) -> DataFrame:
    """Select ``fields`` (default: all of ``schema``) cast to their declared types.

    A matrix where the schema declares a flat array is flattened, after a check of its
    rows against ``feature_shape`` if given.
    """
    names = list(fields) if fields else [f.name for f in schema.fields]
    require_columns(df, names)
    types = {f.name: f.dataType for f in schema.fields}

    def flat(n: str) -> Column:
        have, want = df.schema[n].dataType, types[n]
        nested = isinstance(have, T.ArrayType) and isinstance(have.elementType, T.ArrayType)
        if nested and isinstance(want, T.ArrayType) and not isinstance(want.elementType, T.ArrayType):
            return flat_features(n, feature_shape)
        return F.col(n)

    return df.select([flat(n).cast(types[n]).alias(n) for n in names])


def numeric_view(df: DataFrame, columns: Sequence[str] = NUMERIC_COLUMNS) -> DataFrame:
    """Numeric columns as numeric arrays, every other column passed through."""
    types = {f.name: f.dataType for f in SAMPLE_SCHEMA.fields}
    return df.select([F.col(c).cast(types[c]).alias(c) if c in columns and c in types else F.col(c) for c in df.columns])


def flatten(df: DataFrame, sep: str = ".") -> DataFrame:
    """Nested struct fields become top-level columns named ``a.b``; driven by the schema."""

    def walk(dtype: T.DataType, path: list[str]):
        if isinstance(dtype, T.StructType):
            for f in dtype.fields:
                yield from walk(f.dataType, path + [f.name])
        else:
            yield path

    cols = []
    for f in df.schema.fields:
        for path in walk(f.dataType, [f.name]):
            ref = F.col(path[0])
            for p in path[1:]:
                ref = ref.getField(p)
            cols.append(ref.alias(sep.join(path)))
    return df.select(cols)


def drop_metadata(df: DataFrame, columns: Sequence[str] = METADATA_COLUMNS) -> DataFrame:
    return df.drop(*columns)
