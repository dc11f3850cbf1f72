"""Manifests: shards that were changed, lost or doubled after the write are named."""

import hashlib
import os
import shutil

import pytest

from textprep.sources import jsonl, manifest


def shards(spark, path):
    rows = [(i // 4, i, [i, i + 1]) for i in range(15)]
    jsonl.write_shards(spark.createDataFrame(rows, "shard_id int, pos long, tokens array<int>"), path)
    return rows


def test_manifest_of_shards(spark, scratch):
    path = os.path.join(scratch, "shards")
    rows = shards(spark, path)
    got = {r["file"]: (r["n"], r["checksum"]) for r in manifest.read(spark, path).collect()}
    want = {}
    for s in range(4):
        lines = [f'{{"tokens":[{a},{b}]}}' for k, _, (a, b) in rows if k == s]
        want[f"shard_{s:04d}.jsonl"] = (len(lines), str(sum(int(hashlib.md5(x.encode()).hexdigest()[:15], 16) for x in lines)))
    assert got == want
    assert manifest.problems(spark, path).count() == 0
    assert jsonl.read_shards(spark, path, verify=True).count() == 15


def test_problems_are_named(spark, scratch):
    path = os.path.join(scratch, "shards")
    shards(spark, path)

    def file(n):
        return os.path.join(path, f"shard_{n:04d}.jsonl")

    def lines(n):
        with open(file(n)) as f:
            return f.read().splitlines()

    def put(n, new):
        crc = os.path.join(path, f".shard_{n:04d}.jsonl.crc")
        if os.path.exists(crc):
            os.remove(crc)
        with open(file(n), "w") as f:
            f.write("".join(x + "\n" for x in new))

    put(0, lines(0)[::-1])                                  # another order: no problem
    put(1, [*lines(1)[:-1], '{"tokens":[9]}'])              # one line changed
    put(3, [])                                              # emptied
    shutil.copy(file(0), file(7))                           # doubled
    found = {(r["file"], r["problem"], r["n"], r["n_expected"]) for r in manifest.problems(spark, path).collect()}
    assert found == {("shard_0001.jsonl", "changed", 4, 4), ("shard_0003.jsonl", "lost", None, 3), ("shard_0007.jsonl", "extra", 4, None)}
    put(2, [lines(2)[0]] * 4)                               # one line in the place of others
    with pytest.raises(ValueError, match="4 files .*shard_0001.jsonl changed, shard_0002.jsonl changed"):
        jsonl.read_shards(spark, path, verify=True)


def test_texts_without_rows_and_folders_without_manifest(spark, scratch):
    path = os.path.join(scratch, "text")
    jsonl.write_text_jsonl(spark.createDataFrame([], "ord long, text string"), path)
    assert manifest.read(spark, path).count() == manifest.problems(spark, path).count() == 0
    jsonl.write_text_jsonl(spark.createDataFrame([(2, "b\r\nc"), (1, "a")], "ord long, text string"), path)
    assert manifest.read(spark, path).groupBy().sum("n").first()[0] == 2
    assert [r["text"] for r in jsonl.read_records(spark, path).orderBy("ord").collect()] == ["a", "b\r\nc"]
    with pytest.raises(FileNotFoundError):
        manifest.problems(spark, scratch)
