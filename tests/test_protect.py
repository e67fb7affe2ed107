import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from tidewater.functions import protect

KEY = "0123456789abcdef"


def test_known_answer_ecb(spark):
    df = spark.createDataFrame([("Bob",)], "name string")
    got = df.select(protect.encrypt("name", KEY).alias("c")).first()["c"]
    assert got == "4sZIplk8J6Fgg+ezVCqhmQ=="


def test_null_empty_unicode_big_and_int(spark):
    big = "x" * (1 << 20)
    rows = [(1, None), (2, ""), (3, "Ünïcødé ✓ 日本"), (4, big)]
    df = spark.createDataFrame(rows, "id int, s string")
    for mode in ("ECB", "GCM"):
        enc = protect.protect_columns(df, ["s", "id", "absent"], KEY, mode)
        assert enc.columns == ["id", "s"]
        dec = protect.unprotect_columns(enc, ["s", "id"], KEY, mode, types={"id": "int"})
        assert sorted(dec.collect()) == sorted(df.collect())
    assert enc.where(F.col("id").isNull()).count() == 0


@pytest.mark.parametrize("key", ["k" * 16, "k" * 24, "k" * 32])
def test_key_sizes(spark, key):
    df = spark.createDataFrame([("v",)], "s string")
    out = df.select(protect.decrypt(protect.encrypt("s", key), key).alias("s")).first()["s"]
    assert out == "v"


def test_bad_key_length_rejected():
    with pytest.raises(ValueError):
        protect.encrypt("s", "k" * 15)


def test_wrong_key_gives_null_or_error(spark):
    df = spark.createDataFrame([("secret",)], "s string")
    enc = df.select(protect.encrypt("s", KEY).alias("s"))
    other = "fedcba9876543210"
    assert enc.select(protect.decrypt("s", other).alias("p")).first()["p"] != "secret"
    with pytest.raises(Exception):
        enc.select(protect.decrypt("s", other, strict=True)).collect()


def test_ecb_is_deterministic_gcm_is_not(spark):
    df = spark.createDataFrame([("a",), ("a",)], "s string")
    ecb = {r[0] for r in df.select(protect.encrypt("s", KEY)).collect()}
    gcm = {r[0] for r in df.select(protect.encrypt("s", KEY, "GCM")).collect()}
    assert len(ecb) == 1 and len(gcm) == 2


def test_lowercasing_ciphertext_destroys_it(spark):
    """Standardising after encryption breaks decryption."""
    df = spark.createDataFrame([("User@Example.COM",)], "e string")
    enc = df.select(F.lower(protect.encrypt("e", KEY)).alias("e"))
    assert enc.select(protect.decrypt("e", KEY).alias("p")).first()["p"] is None


def test_protection_stays_in_jvm(spark):
    df = spark.createDataFrame([("a", 1)], "s string, i int")
    plan = protect.protect_columns(df, ["s"], KEY)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan


@settings(max_examples=25, deadline=None)
@given(st.lists(st.one_of(st.none(), st.text(max_size=40)), min_size=1, max_size=20))
def test_roundtrip_property(spark, values):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, s string")
    enc = protect.protect_columns(df, ["s"], KEY)
    dec = protect.unprotect_columns(enc, ["s"], KEY, strict=True)
    assert sorted(dec.collect()) == sorted(df.collect())
