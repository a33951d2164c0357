import random

import pytest
from pyspark.sql import types as T

DOCS = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("text", T.StringType()),
        T.StructField("lang", T.StringType()),
        T.StructField("source", T.StringType()),
        T.StructField("n_chars", T.LongType()),
        # extra columns whose names operators use inside
        T.StructField("rk", T.LongType()),
        T.StructField("key", T.StringType()),
        T.StructField("node", T.StringType()),
        T.StructField("id", T.StringType()),
    ]
)


def sentence(rng, n, vocabulary=4000):
    return " ".join(f"w{rng.randrange(vocabulary)}" for _ in range(n))


def odd_texts():
    """(doc_id, text): copies, near copies, shared passages, nulls, blanks, repeated rows, a very long text."""
    rng = random.Random(3)
    base = [sentence(rng, 120) for _ in range(12)]
    passage = sentence(rng, 60)
    near = base[0].split()
    near[50] = "changed"
    long = sentence(rng, 30_000)
    rows = list(enumerate(base))
    rows += [(100, base[3]), (101, base[3]), (102, " ".join(near)), (103, base[4] + "\n" + passage), (104, passage + "\n" + base[5])]
    rows += [(200, None), (201, ""), (202, " \n\t "), (203, "one"), (204, "one two"), (205, "one two"), (206, "a " * 80), (207, "x " * 34 + "y")]
    rows += [(300, long), (301, long[:4000]), (302, base[6] + "\n" + base[6]), (303, "\n".join([base[7][:200]] * 3))]
    rows += [(400, "twice here"), (400, "twice here"), (None, sentence(rng, 50)), (None, base[8])]
    rows += [(500, "Zeile eins\r\nZeile zwei\u00a0\u3000\nZeile eins"), (501, "emoji \U0001f600 " * 20), (502, "### $$$ %%% " * 40)]
    return rows


@pytest.fixture(scope="session")
def odd(spark):
    rows = [(i, t, None if n % 5 == 0 else "en", f"s{n % 3}", len(t or ""), n, "k", None, "x") for n, (i, t) in enumerate(odd_texts())]
    return spark.createDataFrame(rows, DOCS).repartition(3)


@pytest.fixture(scope="session")
def none(spark):
    return spark.createDataFrame([], DOCS)
