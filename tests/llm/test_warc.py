import gzip
import hashlib
import io
import random

import pytest
from pyspark.sql import functions as F

from wordloom.llm import queries, warc

SCHEMA = "page_id bigint, url string, html string"


def plain(rows):
    """What each page becomes, with payloads compared as they are."""
    largest = {}
    for page_id, _, html in rows:
        data = (html or "").encode()
        if page_id is not None and len(data) >= 1000:
            largest[data] = max(largest.get(data, page_id), page_id)
    out = []
    for page_id, url, html in rows:
        data = (html or "").encode()
        keeper = largest.get(data)
        refers = None if keeper is None or keeper == page_id else keeper
        told = None if url is None else " ".join(url.split())
        out.append((page_id, len(data), hashlib.sha1(data).hexdigest(), "revisit" if refers is not None else "response", refers, told))
    return sorted(out, key=repr)


def found(df):
    return sorted((tuple(row) for row in df.collect()), key=repr)


def html(seed, size):
    rng = random.Random(seed)
    return "".join(rng.choice("abcdefgh <>é\r\n") for _ in range(size))


def awkward_pages():
    same, long = html(1, 1500), html(2, 400_000)
    return [
        (1, "http://a/1", same), (5, "http://a/5", same), (3, None, same), (5, "http://a/5", same),
        (7, "http://a/7", "short"), (8, "http://a/8", "short"), (9, "", None), (10, None, ""),
        (None, "http://a/n", same), (None, "x y\r\nPage-Id: 99", html(3, 2000)), (None, "x", html(3, 2000)), (None, None, None),
        (12, "u", "x" * 999), (13, "u", "x" * 999), (14, "u", "é" * 500), (15, "u", "é" * 500),
        (16, "u", long), (17, "u", long + "!"), (18, "u", "WARC/1.1\r\nContent-Length: 4\r\n\r\nabcd\r\n\r\n" * 60),
    ]


def test_awkward_pages(spark, tmp_path):
    rows = awkward_pages()
    pages = spark.createDataFrame(rows, SCHEMA).repartition(3)
    for name in ("payload", "salt", "size", "copies", "refers_to", "archive"):
        pages = pages.withColumn(name, F.lit("clash"))
    pages = pages.withColumn("notes", F.create_map(F.lit("a"), F.lit(1)))
    assert found(warc.archived_pages(pages)) == plain(rows)


def test_payloads_come_back_whole_and_archives_are_cut(spark, tmp_path):
    rows = [(n, f"http://h/{n}", html(n, 3000)) for n in range(60)]
    folder = str(tmp_path / "cut")
    written = warc.write_archives(spark.createDataFrame(rows, SCHEMA).coalesce(1), folder, archive_bytes=20_000)
    assert written.count() > 3 and written.agg(F.sum("records")).first()[0] == 60
    assert sorted(r["archive"] for r in warc.archives_in(spark, folder).collect()) == sorted(r["archive"] for r in written.collect())
    back = warc.read_archives(written, folder).where(F.col("headers")["warc-type"] == "response").collect()
    assert {int(r["headers"]["page-id"]): bytes(r["payload"]).decode() for r in back} == {n: text for n, _, text in rows}
    # Any gzip reader sees the records one after the other.
    one = next((tmp_path / "cut").glob("*.warc.gz"))
    assert gzip.decompress(one.read_bytes()).count(b"WARC-Type: ") == written.where(F.col("archive") == one.name).first()["records"] + 1


def test_empty_table(spark):
    pages = spark.createDataFrame([], SCHEMA)
    assert warc.archived_pages(pages).collect() == []


def records(count=6, size=4000):
    """Records as (bytes, page id) with incompressible and text payloads."""
    out = []
    for number in range(count):
        payload = random.Random(number).randbytes(size) if number % 2 else html(number, size).encode()
        out.append(warc._page_record(number, f"http://h/{number}", payload, None))
    return out


def read(data, step=700):
    """(ids of records, gaps), and every byte is in one of them."""
    ids, gaps, at = [], [], 0
    for one in warc.salvage(warc.Source(io.BytesIO(data), len(data), step), step):
        start, end = (one.start, one.end) if isinstance(one, warc.Record) else one[:2]
        assert start == at and end > start
        at = end
        if isinstance(one, warc.Record):
            ids.append(int(one.headers["page-id"]))
        else:
            gaps.append((start, end))
    assert at == len(data)
    return ids, gaps


FORMS = {"members": warc.member, "plain": lambda data: data}


@pytest.mark.parametrize("form", FORMS)
@pytest.mark.parametrize("step", [64, 700, 1 << 20])
def test_undamaged_files_have_no_gap(form, step):
    data = b"".join(map(FORMS[form], records()))
    assert read(data, step) == (list(range(6)), [])
    assert read(b"") == ([], [])


@pytest.mark.parametrize("form", FORMS)
def test_a_changed_byte_costs_one_record(form):
    parts = [FORMS[form](one) for one in records()]
    starts = [sum(map(len, parts[:n])) for n in range(7)]
    for place in range(starts[2] + 5, starts[3] - 4, 97):
        data = bytearray(b"".join(parts))
        data[place] ^= 0x55
        ids, gaps = read(bytes(data))
        assert ids in ([0, 1, 3, 4, 5], [0, 1, 2, 3, 4, 5])
        assert gaps == ([] if 2 in ids else [(starts[2], starts[3])])


@pytest.mark.parametrize("form", FORMS)
def test_lost_added_and_overwritten_bytes(form):
    parts = [FORMS[form](one) for one in records()]
    starts = [sum(map(len, parts[:n])) for n in range(7)]
    whole = b"".join(parts)
    lost = whole[: starts[1] + 300] + whole[starts[1] + 1200 :]
    assert read(lost) == ([0, 2, 3, 4, 5], [(starts[1], starts[2] - 900)])
    added = whole[: starts[4]] + b"\0" * 5000 + whole[starts[4] :]
    # A plain record is only taken if another follows, so the one before the gap shares its fate.
    ids, gaps = read(added)
    assert ids == ([0, 1, 2, 3, 4, 5] if form == "members" else [0, 1, 2, 4, 5])
    assert len(gaps) == 1 and gaps[0][1] == starts[4] + 5000
    across = whole[: starts[2] - 50] + bytes(len(parts[2])) + whole[starts[3] - 50 :]
    assert read(across) == ([0, 3, 4, 5], [(starts[1], starts[3])])
    assert read(whole[: starts[5] + 40]) == ([0, 1, 2, 3, 4], [(starts[5], starts[5] + 40)])
    assert read(b"noise" + whole) == ([0, 1, 2, 3, 4, 5], [(0, 5)])
    noise = b"WARC/ and \x1f\x8b\x08 but no record" * 50
    assert read(noise) == ([], [(0, len(noise))])


def test_records_inside_a_payload_are_not_taken(form=None):
    inner = warc._page_record(99, None, b"inner", None)
    for wrap in FORMS.values():
        outer = warc._page_record(1, None, b"text\r\n\r\n" + wrap(inner) * 3, None)
        data = bytearray(wrap(outer) + wrap(records(3)[2]))
        assert read(bytes(data)) == ([1, 2], [])
        # A digest that fails leaves the framing known, so the search goes on behind the record.
        if wrap is FORMS["plain"]:
            data[data.find(b"text")] ^= 1
            assert read(bytes(data))[0] == [2]


def test_a_member_that_inflates_to_more_than_it_says_is_cut_short():
    data = warc.member(b"WARC/1.1\r\nContent-Length: 5\r\n\r\n" + bytes(50_000_000))
    ids, gaps = read(data + warc.member(records(1)[0]), 1 << 16)
    assert ids == [0] and gaps == [(0, len(data))]


@pytest.mark.parametrize("header", [b"", b"Content-Length: -1\r\n", b"Content-Length: 99999999999999999999\r\n", b"no colon\r\nContent-Length: 0\r\n"])
def test_headers_that_fail(header):
    bad = b"WARC/1.1\r\n" + header + b"\r\n\r\n\r\n"
    for wrap in FORMS.values():
        ids, gaps = read(wrap(bad) + wrap(records(1)[0]))
        assert ids == [0] and gaps == [(0, len(wrap(bad)))]


def test_gaps_are_logged(spark, tmp_path):
    folder = tmp_path / "damaged"
    folder.mkdir()
    parts = list(map(warc.member, records()))
    (folder / "a.warc.gz").write_bytes(parts[0] + parts[1][:100] + parts[2] + parts[3])
    (folder / "b.warc").write_bytes(b"".join(records()))
    (folder / "empty.warc.gz").write_bytes(b"")
    (folder / "notes.txt").write_bytes(b"WARC/")
    read_back = warc.read_archives(warc.archives_in(spark, str(folder)), str(folder))
    assert read_back.where(F.col("error").isNull()).count() == 3 + 6
    log = str(tmp_path / "log")
    warc.log_gaps(read_back, log)
    rows = spark.read.parquet(log).collect()
    assert [(r["archive"], r["start"], r["bytes"]) for r in rows] == [("a.warc.gz", len(parts[0]), 100)]
    assert rows[0]["reason"]
    pages = warc.page_rows(read_back).collect()
    assert len(pages) == 9 and all(r["payload_bytes"] >= 4000 for r in pages)


def test_foreign_records(spark, tmp_path):
    """Folded lines, hex and unknown digests, blocks that are no HTTP message."""
    block = b"just text"
    lines = [b"warc-type: resource", b"X-Long: one", b"  two", b"content-length: 9", b"WARC-Block-Digest: sha1:" + hashlib.sha1(block).hexdigest().encode(), b"WARC-Payload-Digest: md5:zz"]
    data = b"WARC/1.0\r\n" + b"\r\n".join(lines) + b"\r\n\r\n" + block + b"\r\n\r\n"
    (found_one,) = warc.salvage(warc.Source(io.BytesIO(data), len(data)))
    assert found_one.block == block and found_one.headers["x-long"] == "one two"
    bad = data.replace(b"just", b"must")
    assert [type(one) for one in warc.salvage(warc.Source(io.BytesIO(bad), len(bad)))] == [tuple]


def test_query_on_the_given_table(spark):
    directory = "/root/testdata/sf0.1"
    rows = [tuple(r) for r in spark.read.parquet(f"{directory}/pages.parquet").select("page_id", "url", "html").collect()]
    wanted = plain(rows)
    assert found(queries.op13_warc(spark, directory)) == wanted
