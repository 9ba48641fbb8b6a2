import gzip
import io
import zipfile

import pytest

from shelfline.llm.q_warc import ORACLES, op2_warc_zip
from shelfline.llm.warc_zip import (
    StoredZipWriter, archive_records, archive_round_trip, find_members, index_line, indexed_places, open_folder, parse_record, payload_digest, walk, warc_record,
)


def expected(pages, min_bytes=0):
    data = [(k, (h or "").encode()) for k, h in pages]
    out = []
    for k, p in data:
        same = [j for j, q in data if q == p and j is not None]
        refers = max(same) if same and len(p) >= min_bytes and max(same) != k else None
        out.append((k, len(p), payload_digest(p), "response" if refers is None else "revisit", refers))
    return sorted(out, key=repr)


def got(df):
    return sorted(((r["page_id"], r["payload_bytes"], r["payload_digest"], r["record_type"], r["refers_to"]) for r in df.collect()), key=repr)


def test_zip_forms():
    for own in (True, False):
        out = io.BytesIO()
        if own:
            z = StoredZipWriter(out)
            for name, data in (("a/x", b"hello"), ("ü", b""), ("b", b"PK\5\6" * 50)):
                z.begin(name)
                z.write(data[:2])
                z.write(data[2:])
                z.end()
            z.close()
            with zipfile.ZipFile(io.BytesIO(out.getvalue())) as check:
                assert check.testzip() is None and check.read("a/x") == b"hello"
        else:
            with zipfile.ZipFile(out, "w", zipfile.ZIP_STORED) as z:
                z.writestr("a/x", b"hello")
                z.writestr("ü", b"")
                z.writestr("b", b"PK\5\6" * 50)
                z.writestr("packed", b"x" * 100, zipfile.ZIP_DEFLATED)
                z.comment = b"a comment"
        raw = out.getvalue()
        found = find_members(lambda at, n, raw=raw: raw[at : at + n], len(raw))
        assert set(found) == {"a/x", "ü", "b"}  # a compressed member can't be read by range
        start, size, _ = found["a/x"]
        assert raw[start : start + size] == b"hello"
    for bad in (b"", b"PK\5\6", raw[:-30]):
        with pytest.raises(ValueError):
            find_members(lambda at, n, bad=bad: bad[at : at + n], len(bad))


def test_records():
    record = warc_record(7, "http://x/\r\nInjected: y", b"\r\n\r\nbody", payload_digest(b"\r\n\r\nbody"), None)
    row = parse_record(record)
    assert row["payload"] == b"\r\n\r\nbody" and row["page_id"] == 7 and "\n" not in row["url"]
    assert parse_record(warc_record(7, None, b"abc", payload_digest(b"abc"), 9))["refers_to"] == 9
    with pytest.raises(ValueError):
        parse_record(record.replace(b"body", b"bodi"))
    assert gzip.decompress(gzip.compress(record)) == record


PAGES = [(1, "a"), (2, "a"), (3, None), (4, ""), (5, "ü" * 5000), (None, "a"), (None, "alone"), (6, "alone!"), (6, "alone!"), (7, "x\r\n\r\ny\x00")]


@pytest.mark.parametrize("min_bytes", [0, 2, 10_000])
def test_round_trip(spark, min_bytes):
    df = spark.createDataFrame([(k, None if k == 5 else f"http://x/{k}", h, "clash", 1) for k, h in PAGES], "page_id bigint, url string, html string, refers_to string, digest int")
    assert got(archive_round_trip(df, min_bytes)) == expected(PAGES, min_bytes)
    full = {r["page_id"]: r["payload"] for r in archive_round_trip(df, min_bytes, with_payload=True).where("record_type = 'response'").collect()}
    assert bytes(full[5]) == ("ü" * 5000).encode()


def test_empty(spark):
    assert archive_round_trip(spark.createDataFrame([], "page_id bigint, url string, html string")).count() == 0


def test_query(spark, sf_dir):
    pages = [(r["page_id"], r["html"]) for r in spark.read.parquet(f"{sf_dir}/pages.parquet").collect()]
    assert got(op2_warc_zip(spark, sf_dir)) == expected(pages)


def archive(members):
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w", zipfile.ZIP_STORED) as z:
        for name, data in members.items():
            z.writestr(name, data)
    raw = out.getvalue()
    return list(archive_records(lambda at, n: raw[at : at + n], len(raw)))


def made(n):
    body = f"payload {n}".encode()
    return warc_record(n, f"http://x.y/{n}", body, payload_digest(body), None)


INFO = b"WARC/1.0\r\nWARC-Type: warcinfo\r\nContent-Length: 3\r\n\r\na:b\r\n\r\n"


def test_archives_of_others():
    packed = [gzip.compress(x) for x in (INFO, made(1), made(2), made(3))]
    plain = {"a/one.warc.gz": b"".join(packed), "two.warc": INFO + made(4) + made(5), "notes.txt": b"no records"}
    assert sorted(r["page_id"] for r in archive(plain)) == [1, 2, 3, 4, 5]
    at = [sum(map(len, packed[:i])) for i in range(5)]
    lines = [f'y,x)/{i} 2024 {{"offset": "{at[i]}", "length": "{len(packed[i])}", "filename": "one.warc.gz"}}' for i in (3, 1)]
    # what an index names is read by it alone, the rest is walked
    assert sorted(r["page_id"] for r in archive(plain | {"any/where.cdxj": "\n".join(lines)})) == [1, 3, 4, 5]
    foreign = made(7).replace(b"<urn:page:7>", b"<urn:uuid:0-0>").replace(b"WARC-Payload-Digest", b"X-Other")
    assert [(r["page_id"], r["payload"]) for r in archive({"w.warc": foreign})] == [(None, b"payload 7")]
    assert archive({}) == [] and archive({"w.warc": b""}) == []
    long = made(8).replace(b"payload 8", b"payload 8" * 99).replace(b"Content-Length: 9", b"Content-Length: 891")
    whole = INFO + made(1) + INFO
    assert list(walk(lambda at, n: whole[at : at + n], len(whole), 7)) == [INFO[:-4], made(1)[:-4], INFO[:-4]] and long


@pytest.mark.parametrize(
    "bad",
    [
        {"w.warc": made(1)[:-30]},
        {"w.warc": b"no record at all"},
        {"w.warc": made(1).replace(b"Content-Length: ", b"Content-Size: ")},
        {"w.warc.gz": gzip.compress(made(1))[:-12]},
        {"w.warc.gz": b"\x1f\x8b" + bytes(40)},
        {"w.warc": made(1), "i.cdxj": "k 2024 {"},
        {"w.warc": made(1), "i.cdxj": 'k 2024 {"offset": 1}'},
        {"w.warc": made(1), "i.cdxj": 'k 2024 {"offset": "0", "length": "99999"}'},
        {"w.warc": made(1), "v.warc": made(2), "i.cdxj": 'k 2024 {"offset": "0", "length": "9", "filename": "other.warc"}'},
        {"i.cdxj": 'k 2024 {"offset": "0", "length": "9"}'},
    ],
)
def test_damage_is_a_value_error(bad):
    with pytest.raises(ValueError):
        archive(bad)


def test_every_cut_and_flip_is_a_value_error_or_reads():
    out = io.BytesIO()
    z = StoredZipWriter(out)
    for name, data in (("a.warc", made(1) + made(2)), ("i.cdxj", b'k 2024 {"offset": "0", "length": "%d"}' % len(made(1)))):
        z.begin(name)
        z.write(data)
        z.end()
    z.close()
    raw = out.getvalue()
    for i in range(0, len(raw), 3):
        for bad in (raw[:i], raw[:i] + bytes([raw[i] ^ 0x55]) + raw[i + 1 :], raw[:i] + b"\xff" + raw[i + 1 :]):
            try:
                list(archive_records(lambda at, n, bad=bad: bad[max(at, 0) : max(at, 0) + n], len(bad)))
            except ValueError:
                pass


def test_index_lines():
    line = index_line("http://A.Example.com/P?q=1", "D", "revisit", 5, 9)
    assert line.startswith('com,example,a)/p?q=1 20240101000000 {"url"') and indexed_places(line.encode(), ["archive/data.warc.gz"]) == [("archive/data.warc.gz", 5, 9)]
    assert open_folder("file:///tmp")[1] == "/tmp"


def test_sql(spark, sf_dir):
    import duckdb

    con = duckdb.connect()
    con.execute(f"CREATE VIEW pages AS SELECT * FROM '{sf_dir}/pages.parquet'")
    want = con.execute(ORACLES["op2_warc_zip"])
    names = [c[0] for c in want.description]
    assert sorted(map(tuple, op2_warc_zip(spark, sf_dir).select(*names).collect()), key=repr) == sorted(want.fetchall(), key=repr)
