"""Waterfall fixture (FIXTURES.md section 5) and accounting invariants."""

import pytest
from pyspark.sql import functions as F

from textprep.config import PrepConfig
from textprep.operators import lang
from textprep.plans import pipeline as PL

TEXTS = [
    "one two three",
    "ONE two  three",
    "hi",
    "HI",
    "to a@b.co now",
    "to z@y.org now",
    "x <|endoftext|> y",
    "a b c d e f g",
]


@pytest.fixture()
def fixture_df(spark):
    return spark.createDataFrame(list(enumerate(TEXTS)), "ord long, text string")


@pytest.fixture()
def en_profile(spark, fixture_df):
    return lang.train_profile(fixture_df.withColumn("lang", F.lit("en")))


def _counts(spark, df, profile, cfg):
    fate = PL.fates(df, profile, cfg)
    reasons = {r["reason"]: r["n"] for r in PL.drop_reasons(fate).collect()}
    kept = fate.where(F.col("reason").isNull()).count()
    return kept, reasons, fate


def test_one_batch(spark, fixture_df, en_profile):
    cfg = PrepConfig(min_tokens=3, max_tokens=6, batch_size=1000)
    kept, reasons, fate = _counts(spark, fixture_df, en_profile, cfg)
    assert kept == 2
    assert reasons == {"duplicate": 3, "length_filtered": 2, "tokenization_error": 1, "pii_replaced": 2}
    by_ord = {r["ord"]: r["reason"] for r in fate.collect()}
    assert by_ord[3] == "duplicate"  # its first copy (2) was dropped by length
    assert by_ord[5] == "duplicate"


def test_two_batches_same(spark, fixture_df, en_profile):
    cfg = PrepConfig(min_tokens=3, max_tokens=6, batch_size=4)
    kept, reasons, _ = _counts(spark, fixture_df, en_profile, cfg)
    assert kept == 2 and reasons["duplicate"] == 3


def test_batch_of_one(spark, fixture_df, en_profile):
    cfg = PrepConfig(min_tokens=3, max_tokens=6, batch_size=1)
    kept, reasons, _ = _counts(spark, fixture_df, en_profile, cfg)
    assert kept == 4
    assert "duplicate" not in reasons
    assert reasons["length_filtered"] == 3 and reasons["tokenization_error"] == 1


def test_global_scope(spark, fixture_df, en_profile):
    cfg = PrepConfig(min_tokens=3, max_tokens=6, dedup_scope="global")
    kept, reasons, _ = _counts(spark, fixture_df, en_profile, cfg)
    assert kept == 2 and reasons["duplicate"] == 3


def test_no_pii_changes_key(spark, fixture_df, en_profile):
    cfg = PrepConfig(min_tokens=3, max_tokens=6, do_pii=False)
    kept, reasons, _ = _counts(spark, fixture_df, en_profile, cfg)
    assert "pii_replaced" not in reasons
    assert reasons["duplicate"] == 2  # the two e-mail lines differ now
    assert kept == 3


def test_blank_and_malformed_and_empty(spark, en_profile):
    rows = [(0, "one two three", False), (1, "   ", False), (2, None, True), (3, None, False), (4, "one two three four", False)]
    df = spark.createDataFrame(rows, "ord long, text string, malformed boolean")
    cfg = PrepConfig(min_tokens=3, max_tokens=6)
    fate = {r["ord"]: r["reason"] for r in PL.fates(df, en_profile, cfg).collect()}
    assert fate == {0: None, 1: "light_empty", 2: "malformed", 3: "light_empty", 4: None}
    # without the light filter the blank rows reach the waterfall as "empty"
    fate2 = {r["ord"]: r["reason"] for r in PL.fates(df, en_profile, cfg.with_(light_filter=False)).collect()}
    assert fate2[1] == "empty" and fate2[3] == "empty"


def test_survivor_ordinal_batches(spark, en_profile):
    # blanks do not count towards the batch of 2: 0 and 3 share batch 0
    rows = [(0, "one two three"), (1, " "), (2, " "), (3, "ONE TWO THREE"), (4, "one two three")]
    df = spark.createDataFrame(rows, "ord long, text string")
    cfg = PrepConfig(min_tokens=3, max_tokens=6, batch_size=2)
    fate = {r["ord"]: r["reason"] for r in PL.fates(df, en_profile, cfg).collect()}
    assert fate == {0: None, 1: "light_empty", 2: "light_empty", 3: "duplicate", 4: None}


def test_accounting_identity_on_documents(spark):
    from textprep.sources import tables

    docs = tables.documents(spark, "/root/testdata/sf0.001")
    prof = lang.train_profile(docs)
    fate = PL.fates(docs, prof, PrepConfig(batch_size=50))
    acc = PL.accounting(fate).first()
    assert acc["total"] == docs.count() == 200
    assert acc["total"] == acc["malformed"] + acc["light_empty"] + acc["dropped_true"] + acc["kept"]
    assert acc["dropped_ref"] == acc["dropped_true"] + acc["pii_replaced"]
    # same fates under a different input partitioning
    f2 = PL.fates(docs.repartition(7), prof, PrepConfig(batch_size=50))
    a = sorted((r["ord"], r["reason"]) for r in fate.collect())
    b = sorted((r["ord"], r["reason"]) for r in f2.collect())
    assert a == b


def test_prepare_dual_one_to_one(spark, fixture_df, en_profile):
    cfg = PrepConfig(min_tokens=3, max_tokens=6)
    out, reasons = PL.prepare(fixture_df, en_profile, cfg, "dual")
    rows = out.collect()
    assert len(rows) == 2
    assert all(len(r["tokens"]) == 3 or len(r["tokens"]) == 5 for r in rows)
    merged = PL.merge_reasons(reasons, reasons)
    assert {r["reason"]: r["n"] for r in merged.collect()}["duplicate"] == 6


def test_config_validation():
    with pytest.raises(ValueError):
        PrepConfig(min_tokens=20, max_tokens=10)
    with pytest.raises(ValueError):
        PrepConfig(dedup_scope="corpus")
    with pytest.raises(ValueError):
        PrepConfig(shard_size=0)


def test_sample_chars_parity_option(spark, en_profile, fixture_df):
    # scoring only the first characters (the reference's 500) is available
    cfg = PrepConfig(min_tokens=3, max_tokens=6, lang_sample_chars=500)
    kept, reasons, _ = _counts(spark, fixture_df, en_profile, cfg)
    assert kept == 2 and reasons["duplicate"] == 3
