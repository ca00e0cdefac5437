"""The row fingerprint against fixed vectors and an independent digest."""

from __future__ import annotations

import hashlib

from conftest import raw_df, raw_row
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from innkeep.functions.fingerprint import is_hash_text, row_hash
from innkeep.schema import RAW_COLUMNS

# Values and the text that is digested.
VECTORS = [
    (["a", "b"], "a|b"),
    (["", None], "|"),
    (["Ünï", "日本"], "Ünï|日本"),
]


def fingerprint(spark, values: list[str | None]) -> str:
    names = [f"c{i}" for i in range(len(values))]
    df = spark.createDataFrame([tuple(values)], ", ".join(f"{n} string" for n in names))
    return df.select(row_hash(names)).first()[0]


def test_vectors(spark):
    for values, joined in VECTORS:
        assert fingerprint(spark, values) == hashlib.sha256(joined.encode()).hexdigest()


def test_null_and_blank_are_alike_but_keep_their_place(spark):
    assert fingerprint(spark, [None, "x"]) == fingerprint(spark, ["", "x"]) != fingerprint(spark, ["x", None])


def test_order_of_columns_counts(spark):
    assert fingerprint(spark, ["x", "y"]) != fingerprint(spark, ["y", "x"])


def test_separator_inside_a_value_is_not_escaped(spark):
    # the contract joins raw values, so these two rows share a fingerprint
    assert fingerprint(spark, ["x|y", "z"]) == fingerprint(spark, ["x", "y|z"])


@settings(max_examples=10, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.one_of(st.none(), st.text(st.characters(exclude_categories=["Cs"], exclude_characters="\x00"), max_size=8)), min_size=1, max_size=5))
def test_any_text(spark, values):
    joined = "|".join(v or "" for v in values)
    assert fingerprint(spark, values) == hashlib.sha256(joined.encode()).hexdigest()


def test_raw_rows_have_valid_distinct_fingerprints(spark):
    rows = [raw_row(adr=f"{i}.00") for i in range(20)] + [raw_row(adr="0.00")]
    got = raw_df(spark, rows).select(row_hash().alias("h")).agg(F.count_distinct("h"), F.bool_and(is_hash_text(F.col("h")))).first()
    assert tuple(got) == (20, True)


def test_only_lower_hex_of_full_length_is_a_fingerprint(spark):
    good = "0" * 63 + "f"
    df = spark.createDataFrame([(good,), (good[:-1],), (good.upper(),), (good + "0",), (None,)], "h string")
    assert [r[0] for r in df.select(is_hash_text(F.col("h"))).collect()] == [True, False, False, False, None]


def test_names_are_distinct():
    assert len(RAW_COLUMNS) == len({*RAW_COLUMNS}) == 32
