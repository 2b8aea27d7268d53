from __future__ import annotations

import hashlib

import zstandard

from lakeloom.llm import queries, warc


def test_round_trip(spark, tmp_path):
    texts = ["", "short", "é" * 2000, "x" * 999, "y" * 1000, "\x00P*M\x18\x00\x00\x00\x00" * 300]
    rows = [(i, f"http://h/{i}\r\nX: y" if i % 7 == 0 else None if i % 5 == 0 else f"http://h/{i}", texts[i % len(texts)] if i % 11 else None) for i in range(60)]
    rows += [(None, "http://n", "y" * 1000)]
    folder = str(tmp_path / "a")
    warc.write_archives(spark.createDataFrame(rows, "page_id long, url string, html string").repartition(3), folder)
    got = {r["page_id"]: r for r in warc.read_archives(spark, folder).collect()}
    assert len(got) == len(rows)
    for page_id, _, html in rows:
        payload, r = (html or "").encode(), got[page_id]
        same = [p for p, _, h in rows if h == html and p is not None]
        newest = max(same) if page_id is not None and len(payload) >= 1000 else page_id
        assert (r["payload_bytes"], r["payload_digest"]) == (len(payload), hashlib.sha1(payload).hexdigest())
        assert (r["record_type"], r["refers_to"]) == (("response", None) if newest == page_id else ("revisit", newest))
        assert r["payload"] == (payload if newest == page_id else None)


def test_files_stand_alone(spark, tmp_path):
    """Each file begins with its dictionary, and a plain decoder that is given it reads frame after frame."""
    rows = [(i, f"http://h/{i}", f"<html><body><p>page {i} {'common words of pages ' * 20}</p></body></html>") for i in range(300)]
    folder = tmp_path / "a"
    warc.write_archives(spark.createDataFrame(rows, "page_id long, url string, html string").repartition(2), str(folder))
    files = sorted(folder.glob("*.warc.zst"))
    assert files
    for f in files:
        data = f.read_bytes()
        assert data[:4] == warc.DICTIONARY_MAGIC
        size = int.from_bytes(data[4:8], "little")
        tool = zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(data[8 : 8 + size]))
        whole = tool.stream_reader(data[8 + size :], read_across_frames=True).read()
        assert whole.count(b"WARC/1.1\r\n") == sum(1 for _ in warc.frames(data))


def test_query_agrees_with_sql(spark, sf_dir):
    from agreement import assert_agrees, connection

    assert_agrees(queries.op5_warc(spark, sf_dir), connection(sf_dir), queries.ORACLE_SQL["op5_warc"])


def test_empty(spark, tmp_path):
    empty = spark.createDataFrame([], "page_id long, url string, html string")
    warc.write_archives(empty, str(tmp_path / "a"))
    assert warc.read_archives(spark, str(tmp_path / "a")).collect() == []


def test_files_are_bounded_and_stand_alone_when_a_task_writes_several(spark, tmp_path, monkeypatch):
    import random

    # what a task packs is decided in its own process, so the plain function is tried, and the file limit on a table
    monkeypatch.setattr(warc, "ARCHIVE_ROWS", 4)
    monkeypatch.setattr(warc, "ROW_BYTES", 100)
    rnd = random.Random(1)
    frames = [bytes([i]) * rnd.choice([10, 60, 150, 900]) for i in range(100)]
    rows = list(warc.packed(iter(frames), b"HEAD"))
    files = [rows[i : i + 4] for i in range(0, len(rows), 4)]
    assert all(b"".join(f).startswith(b"HEAD") for f in files)
    assert b"".join(b"".join(f).removeprefix(b"HEAD") for f in files) == b"".join(frames)
    assert all(sum(map(len, f)) <= 4 * 2 * 100 + 900 for f in files)


def test_large_records_and_small_ones(spark, tmp_path):
    import random

    rnd = random.Random(2)
    rows = [(i, f"http://h/{i}", "".join(map(chr, rnd.choices(range(0x4E00, 0x9FFF), k=400_000))) if i % 5 == 0 else f"page {i}") for i in range(25)]
    for named in (True, False):
        folder = str(tmp_path / f"a{named}")
        warc.write_archives(spark.createDataFrame(rows, "page_id long, url string, html string").coalesce(1), folder, named=named)
        got = {r["page_id"]: r["payload"] for r in warc.read_archives(spark, folder).collect()}
        assert got == {i: html.encode() for i, _, html in rows}


def test_pages_out_of_the_join_are_dealt_evenly(spark):
    """Null digests would all hash to one partition."""
    rows = [(i, f"http://h/{i}", "small") for i in range(2000)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    from pyspark.sql import functions as F

    assert df.select(F.concat_ws(":", F.lit("page"), "page_id", "url")).distinct().count() == 2000
    out = queries.archived(df).collect()
    assert len(out) == 2000 and {r["record_type"] for r in out} == {"response"}
