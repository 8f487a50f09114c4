import os
import time

import pytest

import linkgraph as lg
from linkgraph.session import scratch_path, shared_dir
from linkgraph.sources.urls import read_settled

MARKER = "@@END@@"


def test_link_text_round_trip(spark, tmp_path):
    rows = [("http://a/", ["http://b/", "http://c/?x=[1]", "http://b/"]), ("http://b/", ["http://a/"])]
    links = spark.createDataFrame(rows + [("http://none/", [])], "source string, targets array<string>")
    path = str(tmp_path / "links")
    lg.write_links(links, path, format="text")
    assert sorted(r.value for r in spark.read.text(path).collect())[0] == "http://a/\t[http://b/, http://c/?x=[1], http://b/]"
    assert sorted(tuple(r) for r in lg.read_links(spark, path).collect()) == rows
    lg.write_links(links, path, mode="overwrite")
    assert spark.read.parquet(path).count() == 3


def test_link_lines_from_elsewhere(spark, tmp_path):
    file = tmp_path / "links.txt"
    file.write_text("A\t[B,C, D]\textra [x]\nno tab\nE\t[]\nF\t[ , ]\nG\tno list\n\t[H]\nI\t[J\n")
    got = sorted(tuple(r) for r in lg.read_links(spark, str(file)).collect())
    assert got == [("", ["H"]), ("A", ["B", "C", "D"])]


def test_documents_round_trip(spark, tmp_path):
    rows = [("http://a/", "line one\nline\ttwo\r\n\nend"), ("http://b/", ""), ("http://c/", "[x]\n")]
    path = str(tmp_path / "docs")
    lg.write_documents(spark.createDataFrame(rows, "url string, body string"), path, MARKER)
    assert sorted(tuple(r) for r in lg.read_documents(spark, path, MARKER).collect()) == rows


def test_large_document_file_is_split(spark, tmp_path):
    file = tmp_path / "docs.txt"
    file.write_text("".join(f"http://h/{i}\tbody {i}\nmore{MARKER}" for i in range(20_000)))
    spark.conf.set("spark.sql.files.maxPartitionBytes", 100_000)
    try:
        docs = lg.read_documents(spark, str(file), MARKER)
        assert docs.rdd.getNumPartitions() > 3
        assert docs.distinct().count() == 20_000
        assert docs.where("body not like 'body %\nmore'").isEmpty()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_rank_states(spark, tmp_path):
    file = tmp_path / "state.txt"
    file.write_text("A\tA 3 1.85 B,C,D\nD\tD null 0.43 null\nbroken\n")
    state = lg.read_rank_state(spark, str(file), format="text")
    rows = {("A", 3, 1.85), ("D", None, 0.43)}
    assert {tuple(r) for r in state.collect()} == rows
    one, two = str(tmp_path / "one"), str(tmp_path / "two")
    lg.write_rank_state(state, one)
    lg.write_rank_state(state, two)
    assert {tuple(r) for r in lg.read_rank_state(spark, one).collect()} == rows
    assert lg.read_rank_states(spark, one, two).count() == 4
    lg.write_ranks(state, str(tmp_path / "ranks"), format="csv")
    assert {r.value for r in spark.read.text(str(tmp_path / "ranks")).collect()} == {"A\t1.85", "D\t0.43"}
    with pytest.raises(Exception):
        lg.write_ranks(state, one)
    lg.write_ranks(state, one, mode="overwrite")
    assert spark.read.parquet(one).columns == ["node", "rank"]


def test_urls(spark, tmp_path):
    assert [r.url for r in lg.seeds(spark, "http://a/,http://b/").collect()] == ["http://a/", "http://b/"]
    file = tmp_path / "batch.txt"
    file.write_text("http://a/\r\n  http://b/ \nhttp://a/\n")
    assert sorted(r.url for r in lg.read_url_batch(spark, str(file)).collect()) == ["http://a/", "http://b/"]


def test_copy_selection(spark):
    local = spark.createDataFrame(
        [("a", False, 940_000), ("b", False, 940_001), ("c", False, 1), ("d", True, 1)],
        "key string, is_dir boolean, modified_ms bigint")
    dest = spark.createDataFrame([("c",)], "key string")
    assert [r.key for r in lg.files_to_copy(local, dest, 1_000_000).collect()] == ["a"]


def test_settled_files(spark, tmp_path):
    for name, age in (("old.txt", 3600), ("new.txt", 0)):
        (tmp_path / name).write_text(name)
        os.utime(tmp_path / name, (time.time() - age, time.time() - age))
    cut = time.strftime("%Y-%m-%dT%H:%M:%S", time.gmtime(time.time() - 60))
    assert [r.value for r in read_settled(spark, str(tmp_path), cut).collect()] == ["old.txt"]


def test_shared_dir(spark):
    named = spark.conf.get("spark.checkpoint.dir", None)
    assert shared_dir(spark) == (named or shared_dir(spark))
    first, second = scratch_path(spark, "x"), scratch_path(spark, "x")
    assert first != second and first.startswith(shared_dir(spark).rstrip("/"))


def test_archive_of_a_watched_folder(spark, tmp_path):
    folder, later = tmp_path / "in", int(time.time() * 1000) + 120_000
    (folder / "sub dir").mkdir(parents=True)
    for name, content in {"a.bin": b"\x00\xff", "empty": b"", "b c%20.txt": b"two\nlines", "_hidden": b"no",
                          "sub dir/x": b"deep"}.items():
        (folder / name).write_bytes(content)
    listed = {r.key: r.length for r in lg.list_files(spark, str(folder)).collect()}
    assert listed == {"a.bin": 2, "b c%20.txt": 9}
    assert {r.key for r in lg.list_files(spark, str(folder), recursive=True).collect()} == {*listed, "sub dir/x"}

    archive = lg.FileArchive(spark, str(tmp_path / "archive"), buckets=2)
    assert archive.read().collect() == []
    assert archive.copy_new(str(folder), later - 120_000, settle_ms=60_000).files.collect() == []  # still changing
    first = archive.copy_new(str(folder), later)
    assert first.version == 1 and {r.key for r in first.files.collect()} == set(listed)
    again = archive.copy_new(str(folder), later)
    assert again.version == 1 and again.files.collect() == []

    # a run that was cut off before its log leaves rows that are not read, and is done again
    (folder / "late").write_bytes(b"z")
    os.utime(folder / "late", (1, 1))
    left = tmp_path / "archive" / "content" / "version=2"
    left.mkdir()
    (left / "part-0.parquet").write_text("cut off")
    assert archive.log().count() == 2
    second = archive.copy_new(str(folder), later, recursive=True)
    assert {r.key for r in second.files.collect()} == {"late", "sub dir/x"}
    got = {r.key: (bytes(r.content), r.taken) for r in archive.read().collect()}
    assert got == {"a.bin": (b"\x00\xff", 1), "b c%20.txt": (b"two\nlines", 1),
                   "late": (b"z", 2), "sub dir/x": (b"deep", 2)}


def test_listing_opens_no_file(spark, tmp_path):
    (tmp_path / "x").write_bytes(b"1")
    plan = lg.list_files(spark, str(tmp_path))._jdf.queryExecution().executedPlan().toString()
    assert "content" not in plan.split("ReadSchema")[1]
