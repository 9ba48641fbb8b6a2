"""WARC records in ZIP-packaged archives: write, list and range-read.

An archive is a ZIP with stored members: ``archive/data.warc.gz`` (each record
a gzip member of its own) and ``indexes/index.cdxj`` (a CDXJ line for each
record, with its place). The reader never extracts: it reads the tail for the end
records (with their ZIP64 forms), then the central directory, then the index
members, then only the byte ranges of records. It takes stored members of any
name that end in ``.warc`` or ``.warc.gz``, and indexes that end in ``.cdxj``; data
that no index covers is walked record by record.

Defined results
    null payload        an empty payload
    null page id        always a response, or a revisit where rows with an id
                        share its payload; never referred to
    page ids            whole numbers, or text that holds them; others fail the job
    repeated rows       rows equal in id and payload have the same role
    empty table         no archive and no rows
    damaged archive     ValueError, which names what is wrong
    records of others   only response, revisit and resource records are returned;
                        page ids are null where a record id isn't one of ours
Only the columns named are read, so other columns may have any names.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import json
import re
import struct
import urllib.parse
import uuid
import zlib
from collections.abc import Callable, Iterator
from typing import BinaryIO

import pandas as pd
import pyarrow.fs as pafs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialize, scratch

DATA_MEMBER = "archive/data.warc.gz"
INDEX_MEMBER = "indexes/index.cdxj"
DATA_NAME, INDEX_NAME = re.compile(r"\.warc(\.gz)?$"), re.compile(r"\.cdxj$")
#: An archive is closed once it holds so many bytes.
ROLL_BYTES = 64 << 20
#: Neighbouring records are fetched together up to so many bytes.
FETCH_BYTES = 4 << 20
#: Tasks that read archives, at most; each reads one after the other.
MAX_READERS = 20_000
WARC_DATE = "2024-01-01T00:00:00Z"


def payload_digest(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


# ---------------------------------------------------------------- ZIP, writing


class StoredZipWriter:
    """Stored members on a stream that only goes forward; every size is in its
    ZIP64 form, so members and archives may pass 4 GiB."""

    def __init__(self, out: BinaryIO) -> None:
        self.out, self.at = out, 0
        self.members: list[tuple[bytes, int, int, int]] = []
        self.open: list | None = None

    def _put(self, data: bytes) -> None:
        self.out.write(data)
        self.at += len(data)

    def begin(self, name: str) -> None:
        raw = name.encode()
        self.open = [raw, self.at, 0, 0]
        extra = struct.pack("<HHQQ", 1, 16, 0, 0)
        self._put(struct.pack("<4s5H3I2H", b"PK\3\4", 45, 0x0808, 0, 0, 0x21, 0, 0xFFFFFFFF, 0xFFFFFFFF, len(raw), len(extra)) + raw + extra)

    def write(self, data: bytes) -> int:
        """Appends to the open member; returns where the data begins in it."""
        start = self.open[3]
        self.open[2] = zlib.crc32(data, self.open[2])
        self.open[3] += len(data)
        self._put(data)
        return start

    def end(self) -> None:
        raw, at, crc, size = self.open
        self._put(struct.pack("<4sIQQ", b"PK\7\10", crc, size, size))
        self.members.append((raw, at, crc, size))
        self.open = None

    def close(self) -> None:
        start = self.at
        for raw, at, crc, size in self.members:
            extra = struct.pack("<HHQQQ", 1, 24, size, size, at)
            self._put(
                struct.pack("<4s6H3I5H2I", b"PK\1\2", 45, 45, 0x0808, 0, 0, 0x21, crc, 0xFFFFFFFF, 0xFFFFFFFF, len(raw), len(extra), 0, 0, 0, 0, 0xFFFFFFFF)
                + raw + extra
            )
        size, end = self.at - start, self.at
        n = len(self.members)
        self._put(struct.pack("<4sQ2H2I4Q", b"PK\6\6", 44, 45, 45, 0, 0, n, n, size, start))
        self._put(struct.pack("<4sIQI", b"PK\6\7", 0, end, 1))
        self._put(struct.pack("<4s4H2IH", b"PK\5\6", 0, 0, 0xFFFF, 0xFFFF, 0xFFFFFFFF, 0xFFFFFFFF, 0))


# ---------------------------------------------------------------- ZIP, reading


def find_members(read_at: Callable[[int, int], bytes], size: int) -> dict[str, tuple[int, int, int]]:
    """name -> (where its data begins, length, crc32) of stored members, from the
    end record, its ZIP64 form and the central directory."""
    tail_at = max(0, size - 65_557)
    tail = read_at(tail_at, size - tail_at)
    last = max(0, len(tail) - 18)  # the record has 22 bytes
    end = tail.rfind(b"PK\5\6", 0, last)
    while end >= 0 and end + 22 + struct.unpack_from("<H", tail, end + 20)[0] != len(tail):
        end = tail.rfind(b"PK\5\6", 0, end)
    if end < 0:
        raise ValueError("no end of central directory")
    count, length, start = struct.unpack_from("<HII", tail, end + 10)
    if 0xFFFF == count or 0xFFFFFFFF in (length, start):
        locator = read_at(tail_at + end - 20, 20) if tail_at + end >= 20 else b""
        if locator[:4] != b"PK\6\7" or len(locator) < 20:
            raise ValueError("no ZIP64 locator")
        record = read_at(struct.unpack_from("<Q", locator, 8)[0], 56)
        if record[:4] != b"PK\6\6" or len(record) < 56:
            raise ValueError("no ZIP64 end of central directory")
        count, length, start = struct.unpack_from("<QQQ", record, 32)
    directory = read_at(start, length)
    found, at = {}, 0
    for _ in range(count):
        if directory[at : at + 4] != b"PK\1\2" or len(directory) < at + 46:
            raise ValueError("bad central directory entry")
        flags, method = struct.unpack_from("<2H", directory, at + 8)
        crc, packed, plain, n, m, k = struct.unpack_from("<3I3H", directory, at + 16)
        local = struct.unpack_from("<I", directory, at + 42)[0]
        name = directory[at + 46 : at + 46 + n].decode("utf-8" if flags & 0x800 else "cp437")
        extra = directory[at + 46 + n : at + 46 + n + m]
        if len(directory) < at + 46 + n + m + k:
            raise ValueError("bad central directory entry")
        at += 46 + n + m + k
        while len(extra) >= 4:
            kind, width = struct.unpack_from("<2H", extra)
            if kind == 1:  # ZIP64 sizes stand only for those fields that are all ones, in this order
                if sum(x == 0xFFFFFFFF for x in (plain, packed, local)) * 8 > min(width, len(extra) - 4):
                    raise ValueError("short ZIP64 extra field")
                wide = iter(struct.unpack_from(f"<{min(width, len(extra) - 4) // 8}Q", extra, 4))
                plain, packed, local = (next(wide) if x == 0xFFFFFFFF else x for x in (plain, packed, local))
            extra = extra[4 + width :]
        if method or flags & 1:
            continue  # compressed or encrypted members can't be read by range
        if packed != plain:
            raise ValueError(f"stored member {name} with two sizes")
        head = read_at(local, 30)
        if head[:4] != b"PK\3\4" or len(head) < 30:
            raise ValueError(f"no local header of {name}")
        n, m = struct.unpack_from("<2H", head, 26)
        found[name] = (local + 30 + n + m, plain, crc)
    return found


# ---------------------------------------------------------------- WARC records


def _uri(url: str | None) -> str:
    return urllib.parse.quote(url or "about:blank", safe=":/?#[]@!$&'()*+,;=%~-._")


def warc_record(page_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None) -> bytes:
    """A response with its payload, or a revisit with the HTTP head alone."""
    head = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    body = head if refers_to is not None else head + payload
    fields = [
        ("WARC-Type", "response" if refers_to is None else "revisit"),
        ("WARC-Record-ID", f"<urn:page:{'' if page_id is None else page_id}>"),
        ("WARC-Date", WARC_DATE),
        ("WARC-Target-URI", _uri(url)),
        ("WARC-Payload-Digest", f"sha1:{digest}"),
    ]
    if refers_to is not None:
        fields += [("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"), ("WARC-Refers-To", f"<urn:page:{refers_to}>")]
    fields += [("Content-Type", "application/http; msgtype=response"), ("Content-Length", str(len(body)))]
    return b"WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in fields).encode() + b"\r\n" + body + b"\r\n\r\n"


def _fields(head: bytes) -> dict[str, str]:
    lines = head.decode("utf-8", "replace").split("\r\n")
    return {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines[1:]) if k}


def _number(fields: dict[str, str], name: str) -> int:
    text = fields.get(name, "")
    if not text.isascii() or not text.isdigit():
        raise ValueError(f"no {name} in a header")
    return int(text)


def _page(text: str | None) -> int | None:
    found = re.fullmatch(r"<urn:page:(-?\d+)>", text or "")
    return int(found[1]) if found else None


def parse_record(data: bytes) -> dict | None:
    """A response, revisit or resource record's fields, None for other types; a
    payload must have the digest in its head, where there is one."""
    head, found, rest = data.partition(b"\r\n\r\n")
    if not found or not head.startswith(b"WARC/1."):
        raise ValueError("not a WARC record")
    warc = _fields(head)
    kind, length = warc.get("warc-type"), _number(warc, "content-length")
    if len(rest) < length:
        raise ValueError("a WARC record is cut short")
    if kind not in ("response", "revisit", "resource"):
        return None
    http_head, _, payload = (b"", b"", rest[:length]) if kind == "resource" else rest[:length].partition(b"\r\n\r\n")
    http = _fields(http_head)
    size = _number(http, "content-length") if "content-length" in http else len(payload) if kind != "revisit" else None
    own = payload_digest(payload) if kind != "revisit" else None
    digest = warc.get("warc-payload-digest", "").removeprefix("sha1:") or own
    if own is not None and (len(payload) != size or own != digest):
        raise ValueError(f"payload of {warc.get('warc-record-id')} doesn't have its digest")
    return {
        "page_id": _page(warc.get("warc-record-id")), "url": warc.get("warc-target-uri"), "payload_bytes": size, "payload_digest": digest,
        "record_type": kind, "refers_to": _page(warc.get("warc-refers-to")), "payload": payload if own is not None else None,
    }


# ---------------------------------------------------------------- CDXJ


def sort_key(url: str) -> str:
    """A URL's host from its last label to its first, then its path and query."""
    parts = urllib.parse.urlsplit(url.lower())
    return ",".join(reversed(parts.netloc.split("."))) + ")" + (parts.path or "/") + (f"?{parts.query}" if parts.query else "")


def index_line(url: str | None, digest: str, kind: str, at: int, length: int) -> str:
    own = _uri(url)
    when = re.sub(r"\D", "", WARC_DATE)
    fields = {"url": own, "mime": "warc/revisit" if kind == "revisit" else "text/html", "status": "200", "digest": f"sha1:{digest}", "length": str(length), "offset": str(at), "filename": DATA_MEMBER.rpartition("/")[2]}
    try:
        key = sort_key(own)
    except ValueError:  # not every text is a URL
        key = ")/" + own
    return f"{key} {when} {json.dumps(fields)}\n"


def indexed_places(index: bytes, names: list[str]) -> list[tuple[str, int, int]]:
    """(member, offset, length) of each line of a CDXJ index; ``names`` are the data members."""
    found = []
    by_file = {x.rpartition("/")[2]: x for x in names}
    for line in index.decode("utf-8", "replace").splitlines():
        if not line.strip() or line.startswith("!"):
            continue
        at = line.find("{")
        try:
            fields = json.loads(line[at:]) if at >= 0 else None
            file = fields.get("filename") if len(names) != 1 else fields.get("filename", names[0])
            place = (by_file.get(str(file).rpartition("/")[2], names[0] if len(names) == 1 else None), int(fields["offset"]), int(fields["length"]))
        except (ValueError, KeyError, AttributeError, TypeError):
            raise ValueError(f"bad index line: {line[:80]}") from None
        if place[0] is None or min(place[1:]) < 0:
            raise ValueError(f"index line without its data: {line[:80]}")
        found.append(place)
    return found


# ---------------------------------------------------------------- reading an archive


def _plain(data: bytes) -> bytes:
    """A record as it is, or out of its gzip member."""
    if data[:2] != b"\x1f\x8b":
        return data
    try:
        return gzip.decompress(data)
    except (OSError, EOFError, zlib.error) as e:
        raise ValueError(f"bad gzip member: {e}") from e


def walk(read_at: Callable[[int, int], bytes], size: int, chunk: int = 1 << 20) -> Iterator[bytes]:
    """Records of a data member one after the other, for data without an index."""
    at = 0
    while at < size:
        data = read_at(at, min(chunk, size - at))
        if data[:2] == b"\x1f\x8b":
            inflate, parts, taken = zlib.decompressobj(31), [], 0
            try:
                while not inflate.eof:
                    if not data:
                        raise ValueError("a gzip member is cut short")
                    parts.append(inflate.decompress(data))
                    taken += len(data) - len(inflate.unused_data)
                    data = b"" if inflate.eof else read_at(at + taken, min(chunk, size - at - taken))
            except zlib.error as e:
                raise ValueError(f"bad gzip member: {e}") from e
            at += taken
            if any(parts):
                yield b"".join(parts)
            continue
        blank = len(data) - len(data.lstrip(b"\r\n"))
        if blank:
            at += blank
            continue
        while b"\r\n\r\n" not in data:
            more = read_at(at + len(data), min(chunk, size - at - len(data)))
            if not more:
                raise ValueError("a WARC header is cut short")
            data += more
        head = data.partition(b"\r\n\r\n")[0]
        if not head.startswith(b"WARC/1."):
            raise ValueError("not a WARC record")
        whole = len(head) + 4 + _number(_fields(head), "content-length")
        if at + whole > size:
            raise ValueError("a WARC record is cut short")
        yield data[:whole] if len(data) >= whole else data + read_at(at + len(data), whole - len(data))
        at += whole


def archive_records(read_at: Callable[[int, int], bytes], size: int) -> Iterator[dict]:
    """Every record of an archive: by index and range reads, or by walking data that
    no index covers."""
    members = find_members(read_at, size)
    data = [x for x in members if DATA_NAME.search(x)]
    places: list[tuple[str, int, int]] = []
    for name in (x for x in members if INDEX_NAME.search(x)):
        start, length, crc = members[name]
        index = read_at(start, length)
        if zlib.crc32(index) != crc:
            raise ValueError(f"damaged index {name}")
        places += indexed_places(index, data)
    places = sorted(set(places))
    i = 0
    while i < len(places):
        name, first, n = places[i]
        base, limit, _ = members[name]
        end, j = first + n, i + 1
        while j < len(places) and places[j][0] == name and max(end, sum(places[j][1:])) - first <= FETCH_BYTES:
            end, j = max(end, sum(places[j][1:])), j + 1
        if end > limit:
            raise ValueError(f"an index points behind the end of {name}")
        block = read_at(base + first, end - first)
        for _, at, n in places[i:j]:
            row = parse_record(_plain(block[at - first : at - first + n]))
            if row is not None:
                yield row
        i = j
    for name in sorted(set(data) - {x[0] for x in places}):
        base, limit, _ = members[name]
        for record in walk(lambda at, n, base=base: read_at(base + at, n), limit):
            row = parse_record(record)
            if row is not None:
                yield row


# ---------------------------------------------------------------- operators


def assign_revisits(df: DataFrame, key: str = "page_id", payload: str = "html", min_bytes: int = 0, url: str = "url") -> DataFrame:
    """key, url, payload and ``refers_to``: the largest key among rows of an equal
    payload of at least ``min_bytes``, null for that row itself and for smaller
    payloads. Payloads move once, dealt by their digest; the other side has a row for
    each digest that recurs, from partial aggregates. A hot digest is one row there,
    so adaptive execution can split the payloads' side."""
    rows = df.select(F.col(key).alias("key"), F.col(url).alias("url"), F.encode(F.coalesce(F.col(payload), F.lit("")), "UTF-8").alias("payload"))
    rows = rows.withColumn("digest", F.sha1("payload"))
    large = F.length("payload") >= min_bytes
    groups = rows.where(large).groupBy("digest").agg(F.max("key").alias("__head"), F.count(F.lit(1)).alias("__n"))
    groups = groups.where((F.col("__n") > 1) & F.col("__head").isNotNull()).drop("__n")
    joined = rows.join(groups, "digest", "left")
    other = large & ~F.col("key").eqNullSafe(F.col("__head"))
    return joined.select("key", "url", "payload", F.when(other, F.col("__head")).alias("refers_to"))


def open_folder(uri: str) -> tuple[pafs.FileSystem, str]:
    """pyarrow's file system of a URI; Hadoop's names of S3 are taken as S3."""
    return pafs.FileSystem.from_uri(re.sub(r"^s3[an]://", "s3://", uri))


def write_archives(rows: DataFrame, folder: str, roll_bytes: int = ROLL_BYTES) -> DataFrame:
    """Writes rows (key, url, payload, refers_to) to ZIP archives in ``folder``, a
    URI that pyarrow can open, and returns the kept manifest: a row for each
    archive. A task that runs again writes new files; the manifest, which is in
    the shared folder, names only those of the attempt that counted."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        fs, base = open_folder(folder)
        fs.create_dir(base, recursive=True)
        out = archive = None
        lines: list[str] = []

        def finish() -> pd.DataFrame:
            archive.end()
            archive.begin(INDEX_MEMBER)
            archive.write("".join(sorted(lines)).encode())
            archive.end()
            archive.close()
            out.close()
            return pd.DataFrame({"path": [name], "records": [len(lines)], "bytes": [archive.at]})

        for frame in frames:
            for key, url, payload, refers_to in zip(frame["key"], frame["url"], frame["payload"], frame["refers_to"], strict=True):
                if archive is None:
                    name = f"part-{uuid.uuid4().hex}.zip"
                    out = fs.open_output_stream(f"{base}/{name}", compression=None)
                    archive, lines = StoredZipWriter(out), []
                    archive.begin(DATA_MEMBER)
                key = None if pd.isna(key) else int(key)
                refers_to = None if pd.isna(refers_to) else int(refers_to)
                data = bytes(payload)
                digest = payload_digest(data)
                packed = gzip.compress(warc_record(key, url, data, digest, refers_to), 6, mtime=0)
                at = archive.write(packed)
                lines.append(index_line(url, digest, "response" if refers_to is None else "revisit", at, len(packed)))
                if archive.at >= roll_bytes:
                    yield finish()
                    archive = None
        if archive is not None:
            yield finish()

    typed = rows.select(F.col("key").cast("bigint"), F.col("url").cast("string"), "payload", F.col("refers_to").cast("bigint"))
    return materialize(typed.mapInPandas(run, "path string, records bigint, bytes bigint"), "warc-manifest")


RECORD = "page_id bigint, url string, payload_bytes bigint, payload_digest string, record_type string, refers_to bigint"


def read_archives(manifest: DataFrame, folder: str, with_payload: bool = False) -> DataFrame:
    """Every record of the manifest's archives, by index and range reads."""
    names = [x.split()[0] for x in RECORD.split(", ")] + ["payload"] * with_payload

    def records(path: str, fs: pafs.FileSystem) -> Iterator[dict]:
        with fs.open_input_file(path) as f:
            try:
                yield from archive_records(lambda at, n: f.read_at(n, at), f.size())
            except ValueError as e:
                raise ValueError(f"{path}: {e}") from e

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        fs, base = open_folder(folder)
        for frame in frames:
            for path in frame["path"]:
                rows: list[dict] = []
                for row in records(f"{base}/{path}", fs):
                    rows.append(row)
                    if len(rows) == (100 if with_payload else 5000):
                        yield _frame(rows, names)
                        rows = []
                if rows:
                    yield _frame(rows, names)

    # an archive holds tens of MB and is a task's work, whatever file of the manifest names it, up to MAX_READERS tasks
    spread = manifest.repartition(max(1, min(MAX_READERS, manifest.count())), F.col("path"))
    return spread.mapInPandas(run, RECORD + ", payload binary" * with_payload)


def _frame(rows: list[dict], names: list[str]) -> pd.DataFrame:
    frame = pd.DataFrame(rows, columns=names)
    for c in ("page_id", "refers_to", "payload_bytes"):
        frame[c] = pd.array(frame[c], dtype="Int64")
    return frame


def archive_round_trip(df: DataFrame, min_bytes: int = 0, with_payload: bool = False) -> DataFrame:
    """Pages (page_id, url, html) to archives in the shared folder and back."""
    folder = scratch(df.sparkSession, "warc")
    manifest = write_archives(assign_revisits(df, min_bytes=min_bytes), folder)
    return read_archives(manifest, folder, with_payload)
