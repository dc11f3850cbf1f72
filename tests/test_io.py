"""JSON-lines scan edge lines (FIXTURES.md section 3) and the whole job on files."""

import json
import os

from pyspark.sql import functions as F

from textprep.config import PrepConfig
from textprep.operators import lang
from textprep.plans import pipeline as PL
from textprep.plans.run import read_json_object, run_jsonl
from textprep.session import materialize
from textprep.sources import jsonl, tables

EDGE = ['{"text":"a b"}', "", "   ", "{bad", '{"x":1}', '{"text":"  "}', '{"text":null}',
        '{"text":5}', "[1,2]", "7", '{"text":"é z"}']


def test_edge_lines(spark, scratch):
    with open(os.path.join(scratch, "a.jsonl"), "w") as f:
        f.write("\n".join(EDGE) + "\n")
    with open(os.path.join(scratch, "ignored.txt"), "w") as f:
        f.write('{"text":"not read"}\n')
    r = jsonl.read_records(spark, scratch).orderBy("ord").collect()
    assert [x["ord"] for x in r] == list(range(len(EDGE)))
    kinds = [("blank" if x["blank"] else "malformed" if x["malformed"] else x["text"]) for x in r]
    assert kinds == ["a b", "blank", "blank", "malformed", "", "  ", "malformed", "malformed",
                     "malformed", "malformed", "é z"]
    c = jsonl.line_counters(jsonl.read_records(spark, scratch)).first()
    assert (c["total"], c["empty"], c["json_errors"], c["valid"]) == (11, 2, 7, 2)


def test_order_across_files(spark, scratch):
    for name, lines in (("b.jsonl", ["b0", "b1"]), ("a.jsonl", ["a0", "a1", "a2"])):
        with open(os.path.join(scratch, name), "w") as f:
            f.write("\n".join(json.dumps({"text": t}) for t in lines) + "\n")
    got = [r["text"] for r in jsonl.read_records(spark, scratch).orderBy("ord").collect()]
    assert got == ["a0", "a1", "a2", "b0", "b1"]


def test_no_files(spark, scratch):
    import pytest

    with pytest.raises(FileNotFoundError):
        jsonl.read_lines(spark, scratch)


def test_token_shapes(spark, scratch):
    with open(os.path.join(scratch, "s.jsonl"), "w") as f:
        f.write('{"tokens":[1,2]}\n[3,4]\n{"x":1}\n{bad\n')
    r = jsonl.read_token_records(spark, scratch, "*.jsonl").orderBy("ord").collect()
    assert [x["shape"] for x in r] == ["object", "list", "other", "bad"]
    assert r[1]["tokens"] == [3, 4]


def test_whole_job_on_jsonl(spark, scratch):
    docs = tables.documents(spark, "/root/testdata/sf0.001")
    src = os.path.join(scratch, "raw")
    docs.orderBy("doc_id").select("text").write.json(src)
    for p in os.listdir(src):  # the reader takes *.jsonl
        if p.endswith(".json"):
            os.rename(os.path.join(src, p), os.path.join(src, p[:-5] + ".jsonl"))
    prof = lang.train_profile(docs)
    cfg = PrepConfig(batch_size=50, shard_size=20)
    out = os.path.join(scratch, "out")
    summary = run_jsonl(spark, src, out, prof, cfg)
    kept = summary["records_after_cleaning"]
    assert summary["accounting"]["total"] == 200
    assert kept > 0 and summary["shards"] == -(-kept // 20)
    texts = spark.read.json(os.path.join(out, "text"))
    assert texts.count() == kept
    # part files concatenated in name order give the input order
    import glob
    import json as _json

    lines = [_json.loads(ln)["text"] for f in sorted(glob.glob(os.path.join(out, "text", "part_*.jsonl")))
             for ln in open(f, encoding="utf-8") if ln.strip()]
    from textprep.plans import pipeline as _PL

    fate = _PL.fates(jsonl.read_records(spark, src).select("ord", "text", "malformed"), prof, cfg)
    expected = [r["text"] for r in _PL.kept_texts(jsonl.read_records(spark, src), fate, cfg).orderBy("ord").collect()]
    assert lines == expected
    comb = [_json.loads(ln)["tokens"] for f in sorted(glob.glob(os.path.join(out, "combined", "part_*.jsonl")))
            for ln in open(f, encoding="utf-8") if ln.strip()]
    assert len(comb) == kept
    from textprep.plans import reports as _R

    by_pos = [r["tokens"] for r in _R.read_output(spark, out).orderBy("pos").collect()]
    assert comb == by_pos  # combined = shard records in numeric shard order
    sh = jsonl.read_shards(spark, os.path.join(out, "shards"))
    sizes = sorted(r["count"] for r in sh.groupBy("shard_id").count().collect())
    assert sizes[-1] == 20 and sum(sizes) == kept
    comb = spark.read.json(os.path.join(out, "combined"))
    assert comb.count() == kept
    chk = jsonl.check_jsonl(spark, os.path.join(out, "combined")).first()
    assert chk["unparsable"] == 0
    assert read_json_object(spark, os.path.join(out, "drop_reasons.json")) == summary["drop_reasons"]
    assert jsonl.head(spark, os.path.join(out, "text")).count() == 3
    # same corpus through the parquet path gives the same fates
    from textprep.plans import pipeline as PL

    pf = PL.fates(docs, prof, cfg)
    assert pf.where(F.col("reason").isNull()).count() == kept


def test_reports_on_files(spark, scratch):
    from textprep.plans import reports as R
    from textprep.plans.run import run_jsonl

    docs = tables.documents(spark, "/root/testdata/sf0.001")
    src = os.path.join(scratch, "raw")
    docs.orderBy("doc_id").select("text").coalesce(1).write.json(src)
    for p in os.listdir(src):
        if p.endswith(".json"):
            os.rename(os.path.join(src, p), os.path.join(src, p[:-5] + ".jsonl"))
    prof = lang.train_profile(docs)
    cfg = PrepConfig(batch_size=50, shard_size=20, similarity_sample=40)
    inp = R.input_report_files(spark, src, prof, cfg)
    s = {r["metric"]: r["value"] for r in inp["summary"].collect()}
    assert s["lines"] == 200 and s["valid"] == 200 and s["json_errors"] == 0
    assert sum(r["n"] for r in inp["languages_top"].collect()) == 200
    out = os.path.join(scratch, "out")
    summary = run_jsonl(spark, src, out, prof, cfg)
    rep = R.output_report_files(spark, out, cfg)
    o = {r["metric"]: r["value"] for r in rep["summary"].collect()}
    assert o["records"] == summary["records_after_cleaning"]
    assert o["shards"] == summary["shards"]
    assert o["input_true"] == summary["accounting"]["kept"] + summary["accounting"]["dropped_true"]
    corpus = R.read_output(spark, out)
    texts = {r["text"] for r in corpus.collect()}
    written = {r["text"] for r in spark.read.json(os.path.join(out, "text")).collect()}
    assert texts == written  # decode(shards) is exactly the written text output
    assert rep["cosine_sample"].first()["sequences"] == 40


def test_order_with_many_splits(spark, scratch):
    # one file cut into many splits, plus a second file: ord = file order, then line order
    with open(os.path.join(scratch, "a.jsonl"), "w") as f:
        for i in range(3000):
            f.write(json.dumps({"text": f"a{i} " + "x" * (i % 50)}) + "\n")
    with open(os.path.join(scratch, "b.jsonl"), "w") as f:
        for i in range(500):
            f.write(json.dumps({"text": f"b{i}"}) + "\n")
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
    try:
        lines = jsonl.read_lines(spark, scratch)
        assert lines.rdd.getNumPartitions() > 10
        got = [r["text"].split(" ")[0] for r in jsonl.read_records(spark, scratch).orderBy("ord").collect()]
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    assert got == [f"a{i}" for i in range(3000)] + [f"b{i}" for i in range(500)]


def test_whole_job_with_nothing_kept(spark, scratch):
    from textprep.plans import reports as R
    from textprep.plans.run import run_pipeline

    docs = tables.documents(spark, "/root/testdata/sf0.001")
    prof = lang.train_profile(docs)
    recs = spark.createDataFrame([(0, "   "), (1, None), (2, "")], "ord long, text string")
    out = os.path.join(scratch, "out")
    summary = run_pipeline(spark, recs, out, prof, PrepConfig(shard_size=10))
    assert summary["records_after_cleaning"] == 0 and summary["shards"] == 0
    assert summary["accounting"]["light_empty"] == 3 and summary["drop_reasons"] == {}
    rep = R.output_report_files(spark, out, PrepConfig(shard_size=10))
    o = {r["metric"]: r["value"] for r in rep["summary"].collect()}
    assert o["records"] == 0
    assert rep["token_length_hist"].count() == 0
    assert rep["cosine_sample"].count() == 0  # under 10 sequences: no similarity section


def test_command_line(spark, scratch):
    from textprep.__main__ import main

    src = os.path.join(scratch, "raw")
    tables.documents(spark, "/root/testdata/sf0.001").orderBy("doc_id").select("text").coalesce(1).write.json(src)
    for p in os.listdir(src):
        if p.endswith(".json"):
            os.rename(os.path.join(src, p), os.path.join(src, p[:-5] + ".jsonl"))
    out = os.path.join(scratch, "out")
    summary = main([src, out, "--train", "/root/testdata/sf0.001/documents.parquet", "--shard-size", "20"], spark)
    assert summary["accounting"]["total"] == 200 and summary["records_after_cleaning"] > 0
    reps = sorted(os.listdir(os.path.join(out, "reports")))
    assert "input_summary" in reps and "output_summary" in reps and "output_drop_shares" in reps
    again = main([src, os.path.join(scratch, "out2"), "--profile", os.path.join(out, "profile"),
                  "--shard-size", "20", "--skip-reports"], spark)
    assert again["records_after_cleaning"] == summary["records_after_cleaning"]


def test_output_report_similarity_of_all_sequences(spark, scratch):
    from textprep.plans import reports as R
    from textprep.plans.run import run_pipeline

    docs = tables.documents(spark, "/root/testdata/sf0.001")
    out = os.path.join(scratch, "out")
    cfg = PrepConfig(shard_size=20, similarity_sample=10)
    kept = run_pipeline(spark, docs, out, lang.train_profile(docs), cfg)["records_after_cleaning"]
    rep = R.output_report_files(spark, out, cfg)
    assert rep["cosine_sample"].first()["sequences"] == 10 < kept
    assert rep["cosine_to_centroid"].first()["count"] == kept
    assert sum(r["n"] for r in rep["cosine_to_centroid_hist"].collect()) == kept


def test_observed_counts_equal_a_count_of_their_own(spark, scratch):
    rows = [(None, False), ("malformed", False), ("duplicate", True), ("duplicate", False), (None, True), ("light_empty", False)]
    fate = spark.createDataFrame([(i, r, p) for i, (r, p) in enumerate(rows * 50)], "ord long, reason string, pii_found boolean")
    for part in (fate.repartition(7), fate.limit(0)):
        out, seen = PL.observe_fates(part)
        out = materialize(out)
        got, reasons = PL.observed_accounting(seen)
        assert got == PL.accounting(part).first().asDict()
        assert reasons == {r["reason"]: r["n"] for r in PL.drop_reasons(out).collect()}
    shards = spark.createDataFrame([(i // 4, i, [i] * (i % 3)) for i in range(15)], "shard_id int, pos long, tokens array<int>")
    written = jsonl.write_shards(shards, os.path.join(scratch, "s"))
    assert written == {"records": 15, "tokens": sum(i % 3 for i in range(15))}
    assert jsonl.write_shards(shards.limit(0), os.path.join(scratch, "e")) == {"records": 0, "tokens": 0}
