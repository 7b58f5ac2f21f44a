"""Operator 7: damaged archives, many files, file systems."""

import random

import pytest

from farebox.llm import warc


def payload(i):
    rnd = random.Random(i)
    return bytes(rnd.choices(range(256), k=3000))   # does not compress, so flipped bytes break it


def archive(folder, n=6, name="a.warc.gz"):
    members = [warc.member(warc.record(i, f"http://x/{i}", payload(i), None, False)) for i in range(n)]
    (folder / name).write_bytes(b"".join(members))
    starts = [sum(map(len, members[:i])) for i in range(n + 1)]
    return members, starts


def ids(spark, folder, split, **how):
    return sorted(r.page_id for r in warc.read_archives(spark, f"file:{folder}", split, **how).collect())


@pytest.mark.parametrize("split", [700, 1 << 20])
def test_damage_raises_or_is_listed(spark, tmp_path, split):
    members, starts = archive(tmp_path)
    file = tmp_path / "a.warc.gz"
    assert ids(spark, tmp_path, split) == list(range(6))
    assert warc.damages(spark, f"file:{tmp_path}", split).count() == 0
    raw = bytearray(file.read_bytes())
    at = starts[2] + len(members[2]) // 2
    raw[at:at + 40] = bytes(255 - b for b in raw[at:at + 40])
    file.write_bytes(bytes(raw))
    with pytest.raises(Exception, match="does not decode|bytes of no record"):
        ids(spark, tmp_path, split)
    assert ids(spark, tmp_path, split, on_damage="skip") == [0, 1, 3, 4, 5]
    lost = warc.damages(spark, f"file:{tmp_path}", split).collect()
    assert starts[2] in {r.offset for r in lost} and all(r.file.endswith("a.warc.gz") for r in lost)


@pytest.mark.parametrize("split", [700, 1 << 20])
def test_truncated_and_headless_members(spark, tmp_path, split):
    members, starts = archive(tmp_path)
    file = tmp_path / "a.warc.gz"
    whole = file.read_bytes()
    file.write_bytes(whole[:-50])
    with pytest.raises(Exception, match="does not decode"):
        ids(spark, tmp_path, split)
    assert ids(spark, tmp_path, split, on_damage="skip") == list(range(5))
    file.write_bytes(whole[:starts[3]] + b"\0" * 20 + whole[starts[3] + 20:])      # a member without its magic
    assert {r.offset for r in warc.damages(spark, f"file:{tmp_path}", split).collect()} == {starts[3]}
    file.write_bytes(b"noise" + whole)
    assert {r.offset for r in warc.damages(spark, f"file:{tmp_path}", split).collect()} == {0}
    assert ids(spark, tmp_path, split, on_damage="skip") == list(range(6))


def test_ranges_are_packed_into_tasks_and_folders_are_searched(spark, tmp_path):
    (tmp_path / "sub").mkdir()
    for i in range(300):
        archive(tmp_path / "sub" if i % 2 else tmp_path, 1, f"{i}.warc.gz")
    ranges = warc.byte_ranges(spark, f"file:{tmp_path}", 1000)
    assert ranges.select("uri").distinct().count() == 300 and ranges.where("end <= start OR end > size").count() == 0
    assert ranges.rdd.getNumPartitions() <= 4 * spark.sparkContext.defaultParallelism + 1
    mb = 1 << 20
    assert warc.task_count(100 * 10**12, 4000) == -(-100 * 10**12 // (256 * mb))
    assert warc.task_count(10_000 * 5000, 8) <= 10 and warc.task_count(0, 8) == 1
    assert warc.task_count(1 << 30, 8) == 32
    assert warc.read_archives(spark, f"file:{tmp_path}").count() == 300


def test_hadoop_schemes_name_arrow_file_systems():
    assert warc.arrow_uri("s3a://bucket/a/b") == "s3://bucket/a/b" and warc.arrow_uri("s3n://b/c") == "s3://b/c"
    assert warc.arrow_uri("hdfs://host:1/x") == "hdfs://host:1/x" and warc.arrow_uri("/plain") == "/plain"
    from pyarrow import fs

    assert fs.FileSystem.from_uri(warc.arrow_uri("s3a://bucket/key?region=us-east-1"))[1] == "bucket/key"
