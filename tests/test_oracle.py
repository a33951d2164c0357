"""Spark queries against their DuckDB twins (one per operator family) and the entry smoke check."""

import pytest

import __spark_entry__ as E
from corpusprep.plans.catalog import load_all
from tests.conftest import SF_SMALL
from tests.oracle_harness import compare, duck

KEYS = [
    "mixed_then_split",
    "mix_first_exhausted",
    "three_way_split",
    "contiguous_shard",
    "buffered_shuffle",
    "normalise_eval",
    "conform_schema",
    "scan_split_dir",
    "attach_prompt",
    "decode_ids",
    "collate",
    "wer_filtered",
    "pair_counts",
    "udf_batch",
    "stream_take",
    "stream_scan",
    "stream_shuffle",
    "stream_collate",
    "file_order_shuffle",
    "list_files",
    "mix_all_exhausted",
    "edit_distance",
    "choose_target",
]


@pytest.fixture(scope="module")
def con():
    return duck(SF_SMALL)


def test_every_query_has_a_twin_or_is_listed():
    own = load_all()
    assert {k for k, (_, sql) in own.items() if sql is None} == set()


@pytest.mark.parametrize("key", KEYS)
def test_matches_oracle(spark, con, key):
    ok, msg = compare(spark, key, E.queries()[key], E.oracle_sql()[key], SF_SMALL, con)
    assert ok, msg


def test_entry_smoke(spark):
    df = E.entry(spark)
    rows = df.collect()
    assert df.columns == ["split", "source_id", "n_rows", "n_origins", "first_slot", "last_slot"]
    assert sum(r.n_rows for r in rows) > 0
