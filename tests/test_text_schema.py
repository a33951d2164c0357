import pytest
from pyspark.sql import functions as F

from corpusprep.functions import text as tx
from corpusprep.operators import schema as sc


def _one(spark, col):
    return spark.createDataFrame([("x",)], "t string").select(col.alias("r")).first().r


@pytest.mark.parametrize(
    "raw,want",
    [
        ("Hello, World!", "hello world "),
        ("a [noise] b <unk> c (laughs) d", "a b c d"),
        ("Tabs\tand\nlines", "tabs and lines"),
        ("€5 — ok?", " 5 ok "),
        ("Über-größe", "über größe"),
    ],
)
def test_normalise(spark, raw, want):
    assert _one(spark, tx.normalise(F.lit(raw))) == want


def test_small_text_functions(spark):
    assert _one(spark, tx.clean_target(F.lit("A\nB"))) == "a b"
    assert _one(spark, tx.clean_target(F.lit("A\nB"), lower=False)) == "A B"
    assert _one(spark, tx.strip(F.lit("\t x y \n"))) == "x y"
    assert _one(spark, tx.strip(F.lit("\u00a0\u3000x\u2003"))) == "x" and _one(spark, tx.strip(F.lit("\u00a0\u3000"))) == ""
    assert _one(spark, tx.words(F.lit("  a  b\tc "))) == ["a", "b", "c"]
    assert _one(spark, tx.rename_marker(F.lit(tx.NOSPEECH))) == tx.NOCAPTIONS
    assert _one(spark, tx.rename_marker(F.lit("x " + tx.NOSPEECH))) == "x " + tx.NOSPEECH
    assert _one(spark, tx.null_to_empty(F.lit(None).cast("string"))) == ""


def test_require_and_conform(spark):
    df = spark.createDataFrame([("t", 1.5)], "text string, duration double")
    with pytest.raises(ValueError, match="available: text, duration"):
        sc.require_columns(df, ["audio_path"])
    out = sc.conform(df, sc.SAMPLE_SCHEMA, ["text", "duration"])
    assert dict(out.dtypes) == {"text": "string", "duration": "float"}
    with pytest.raises(ValueError):
        sc.conform(df, sc.SAMPLE_SCHEMA)
    with pytest.raises(ValueError):
        sc.feature_shape("whisper-medium")
    assert sc.feature_shape("whisper-large") == (128, 3000)


def test_feature_matrix_is_flattened_with_a_shape_check(spark, tmp_path):
    from corpusprep.sources.files import read_samples

    fields = [f.name for f in sc.SAMPLE_SCHEMA.fields]
    row = spark.range(1).selectExpr("array(array(1.0D, 2.0D), array(3.0D, 4.0D)) input_features", *[f"cast(null as {f.dataType.simpleString()}) {f.name}" for f in sc.SAMPLE_SCHEMA.fields[1:]])
    row.write.parquet(str(tmp_path / "s"))
    out = read_samples(spark, str(tmp_path / "s"), (2, 2))
    assert out.columns == fields and out.first().input_features == [1.0, 2.0, 3.0, 4.0]
    with pytest.raises(Exception, match="feature matrix is not 2 x 3"):
        read_samples(spark, str(tmp_path / "s"), (2, 3)).collect()


def test_flatten(spark):
    df = spark.range(1).select(F.struct(F.lit(1).alias("a"), F.struct(F.lit("z").alias("c")).alias("b")).alias("s"), F.lit(2).alias("t"))
    out = sc.flatten(df)
    assert out.columns == ["s.a", "s.b.c", "t"]
    assert tuple(out.first()) == (1, "z", 2)
