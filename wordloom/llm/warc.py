"""WARC archives: writing pages as records, and a reader that salvages damaged files.

Each archive is a run of records, every one a gzip member of its own. The reader
goes from record to record and checks each. Where a check fails it searches for
the next member or version line that starts a valid record, goes on from there,
and reports the bytes in between as a gap instead of a record.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib
from collections.abc import Iterable, Iterator, Mapping
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wordloom.llm.scratch import kept, shared_folder
from wordloom.llm.token_files import store, write_whole

#: Payloads of fewer bytes are always stored again.
LEAST_REVISIT_BYTES = 1000
#: Bytes of an archive after which the next one is begun; a record stays whole.
ARCHIVE_BYTES = 64 << 20
#: Bytes that are read from storage, or inflated, at once.
STEP_BYTES = 1 << 20
#: Largest header block that is looked for.
MOST_HEADER_BYTES = 1 << 20
#: Pieces that the copies of a payload are dealt to when they look for its response.
_SALTS = 16
#: Bytes of rows that leave a Python worker at once.
_BATCH_BYTES = 16 << 20

# Fixed values of the format.
VERSION = b"WARC/1.1"
_VERSION_START = b"WARC/"
_MEMBER_START = b"\x1f\x8b\x08"
_END = b"\r\n\r\n"
_REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_DATE = "1970-01-01T00:00:00Z"

_WRITTEN = "archive string, records bigint, bytes bigint"
_FOUND = (
    "archive string, start bigint, bytes bigint, error string, "
    "headers map<string,string>, http_headers map<string,string>, payload binary"
)


class Damaged(ValueError):
    """A record that fails a check; ``end`` is where it claims to end, if that is known."""

    def __init__(self, reason: str, end: int | None = None):
        super().__init__(reason)
        self.end = end


def _lines(fields: Mapping[str, object]) -> bytes:
    """Header lines of the fields that have a value; a line break in one becomes a blank."""
    told = ((name, " ".join(str(value).split())) for name, value in fields.items() if value is not None)
    return b"".join(f"{name}: {value}\r\n".encode() for name, value in told)


def _sha1(data: bytes) -> str:
    return "sha1:" + base64.b32encode(hashlib.sha1(data).digest()).decode()


def record(fields: Mapping[str, object], block: bytes) -> bytes:
    """One record, not compressed. Its length and block digest are added."""
    told = {**fields, "WARC-Block-Digest": _sha1(block), "Content-Length": len(block)}
    return VERSION + b"\r\n" + _lines(told) + b"\r\n" + block + _END


def member(data: bytes) -> bytes:
    """A gzip member that says nothing about when it was made."""
    squeezed = zlib.compressobj(6, zlib.DEFLATED, 31)
    return squeezed.compress(data) + squeezed.flush()


def _page_record(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None) -> bytes:
    http = {"Content-Type": "text/html; charset=utf-8", "Content-Length": len(payload)}
    block = b"HTTP/1.1 200 OK\r\n" + _lines(http) + b"\r\n"
    fields = {
        "WARC-Type": "response" if refers_to is None else "revisit",
        "WARC-Record-ID": f"<urn:uuid:{uuid.uuid4()}>",
        "WARC-Date": _DATE,
        "WARC-Target-URI": url,
        "WARC-Payload-Digest": _sha1(payload),
        "Content-Type": "application/http; msgtype=response",
        "Page-Id": page_id,
    }
    if refers_to is None:
        block += payload
    else:
        fields |= {"WARC-Profile": _REVISIT_PROFILE, "Refers-To-Page-Id": refers_to}
    return record(fields, block)


def _writer(folder: str, archive_bytes: int):
    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, path = store(folder)
        rows: list[tuple[str, int, int]] = []
        members: list[bytes] = []
        held = 0

        def close() -> None:
            nonlocal members, held
            name = f"{uuid.uuid4().hex}.warc.gz"
            about = {
                "WARC-Type": "warcinfo",
                "WARC-Record-ID": f"<urn:uuid:{uuid.uuid4()}>",
                "WARC-Date": _DATE,
                "WARC-Filename": name,
                "Content-Type": "application/warc-fields",
            }
            first = member(record(about, b"format: WARC File Format 1.1\r\n"))
            write_whole(files, f"{path}/{name}", b"".join([first, *members]))
            rows.append((name, len(members), held + len(first)))
            members, held = [], 0

        for batch in batches:
            for page_id, url, html, refers_to in zip(*(column for column in batch.columns)):
                payload = html.as_buffer().to_pybytes() if html.is_valid else b""
                members.append(member(_page_record(page_id.as_py(), url.as_py(), payload, refers_to.as_py())))
                held += len(members[-1])
                if held >= archive_bytes:
                    close()
        if members:
            close()
        if rows:
            kinds = (pa.string(), pa.int64(), pa.int64())
            columns = [pa.array(list(column), kind) for column, kind in zip(zip(*rows), kinds)]
            yield pa.RecordBatch.from_arrays(columns, ["archive", "records", "bytes"])

    return write


def referred(pages: DataFrame, page_id: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """(page_id, url, payload, refers_to): which record each page refers to, if any.

    Payloads are equal if two digests and the length are. Groups are summed up
    on the map side and only those with copies are joined, in pieces, so a
    payload that a third of all pages share has no single owner.
    """
    payload = F.coalesce(F.col(html), F.lit("")).cast("binary")
    rows = pages.select(F.col(page_id).cast("bigint").alias("page_id"), F.col(url).cast("string").alias("url"), payload.alias("payload"))
    same = [
        F.octet_length("payload").alias("size"),
        F.sha1("payload").alias("one_digest"),
        F.sha2("payload", 256).alias("other_digest"),
    ]
    copied = (
        rows.select("page_id", *same)
        .where(F.col("size") >= LEAST_REVISIT_BYTES)
        .groupBy("size", "one_digest", "other_digest")
        .agg(F.max("page_id").alias("response_id"), F.count("*").alias("copies"))
        .where((F.col("copies") > 1) & F.col("response_id").isNotNull())
    )
    pieces = F.explode(F.array(*[F.lit(one) for one in range(_SALTS)])).alias("salt")
    salt = F.pmod(F.xxhash64("page_id", "url"), F.lit(_SALTS)).cast("int").alias("salt")
    keys = ["size", "one_digest", "other_digest", "salt"]
    found = rows.select("*", *same, salt).join(kept(copied).select("*", pieces), keys, "left")
    refers = F.when(~F.col("response_id").eqNullSafe(F.col("page_id")), F.col("response_id"))
    return found.select("page_id", "url", "payload", refers.alias("refers_to"))


def write_archives(
    pages: DataFrame,
    folder: str,
    page_id: str = "page_id",
    url: str = "url",
    html: str = "html",
    archive_bytes: int = ARCHIVE_BYTES,
) -> DataFrame:
    """Write a record per page and return the archives: (archive, records, bytes).

    Archives are named at random and written whole before they get their name.
    A task that is run again writes new ones; only the archives in the result,
    which is kept, belong to it. An empty table writes none.
    """
    files, path = store(folder)
    files.create_dir(path, recursive=True)
    return kept(referred(pages, page_id, url, html).mapInArrow(_writer(folder, archive_bytes), _WRITTEN))


class Source:
    """Any bytes of a file, read in steps; the last ones read are kept."""

    def __init__(self, file, size: int, step: int = STEP_BYTES):
        self._file, self.size, self._step = file, size, step
        self._at, self._held = 0, b""

    def bytes(self, at: int, count: int) -> bytes:
        """Up to ``count`` bytes from ``at``, fewer at the end of the file."""
        count = max(0, min(count, self.size - at))
        inside = at - self._at
        if inside < 0 or inside + count > len(self._held):
            self._file.seek(at)
            self._at, self._held = at, self._file.read(max(count, self._step))
            inside = 0
        return self._held[inside : inside + count]

    def find(self, at: int) -> int | None:
        """The next place from ``at`` on where a member or version line might start."""
        while at < self.size:
            data = self.bytes(at, self._step)
            places = [p for p in (data.find(_MEMBER_START), data.find(_VERSION_START)) if p >= 0]
            if places:
                return at + min(places)
            at += max(1, len(data) - len(_VERSION_START) + 1)
        return None


def _fields(block: bytes) -> dict[str, str]:
    """Header fields by lower-case name; a line that begins with a blank goes on from the last."""
    fields: dict[str, str] = {}
    last = None
    for line in block.split(b"\r\n")[1:]:
        text = line.decode("utf-8", "replace")
        if last is not None and text[:1] in (" ", "\t"):
            fields[last] += " " + text.strip()
            continue
        name, colon, value = text.partition(":")
        if not colon:
            raise Damaged("a header line without a colon")
        last = name.strip().lower()
        fields[last] = value.strip()
    return fields


@dataclass
class Record:
    start: int
    end: int
    headers: dict[str, str]
    block: bytes


def _header(data: bytes) -> tuple[dict[str, str], int, int]:
    """Fields of the record that ``data`` begins with, where its block starts, and its length."""
    stop = data.find(_END)
    if not data.startswith(_VERSION_START):
        raise Damaged("no version line")
    if stop < 0:
        raise Damaged("the header does not end")
    headers = _fields(data[:stop])
    length = headers.get("content-length", "")
    if not (length.isascii() and length.isdigit() and len(length) < 19):
        raise Damaged("no length")
    return headers, stop + len(_END), int(length)


def _digest_of(data: bytes, told: str) -> bool:
    """Whether a digest holds. One made by another function than SHA-1 cannot be checked and passes."""
    kind, _, value = told.partition(":")
    if kind.lower() != "sha1":
        return True
    digest = hashlib.sha1(data)
    return value.lower() in (digest.hexdigest(), base64.b32encode(digest.digest()).decode().lower())


def payload_of(headers: Mapping[str, str], block: bytes) -> tuple[dict[str, str], bytes]:
    """HTTP header fields and payload of a record; a block that is no HTTP message is all payload."""
    if not headers.get("content-type", "").startswith("application/http"):
        return {}, block
    head, found, body = block.partition(_END)
    if not found:
        raise Damaged("the HTTP header does not end")
    return _fields(head), body


def _checked(found: Record) -> Record:
    """Check the digests of a record that is framed well."""
    told = found.headers.get("warc-block-digest")
    if told and not _digest_of(found.block, told):
        raise Damaged("the block digest differs", found.end)
    try:
        _, payload = payload_of(found.headers, found.block)
    except Damaged as damage:
        raise Damaged(str(damage), found.end) from None
    told = found.headers.get("warc-payload-digest")
    if told and found.headers.get("warc-type") != "revisit" and not _digest_of(payload, told):
        raise Damaged("the payload digest differs", found.end)
    return found


def _inflated(source: Source, start: int, step: int) -> tuple[bytes, int]:
    """The record in a gzip member and where the member ends.

    No more is inflated than the record says it holds.
    """
    inflate = zlib.decompressobj(31)
    out = bytearray()
    at, most = start, None
    while not inflate.eof:
        data = inflate.unconsumed_tail or source.bytes(at, step)
        if not inflate.unconsumed_tail:
            at += len(data)
        if not data:
            raise Damaged("the member is cut off")
        try:
            out += inflate.decompress(data, step)
        except zlib.error as error:
            raise Damaged(f"the member does not inflate: {error}") from None
        if out[: len(_VERSION_START)] != _VERSION_START[: len(out)]:
            raise Damaged("the member holds no record")
        if most is None and (out.find(_END) >= 0 or len(out) > MOST_HEADER_BYTES):
            _, first, length = _header(bytes(out))
            most = first + length + len(_END)
        if most is not None and len(out) > most:
            raise Damaged("the member is longer than its record")
    return bytes(out), at - len(inflate.unused_data)


def _member_at(source: Source, start: int, step: int) -> Record:
    data, end = _inflated(source, start, step)
    try:
        headers, first, length = _header(data)
    except Damaged as damage:
        raise Damaged(str(damage), end) from None
    if len(data) != first + length + len(_END) or not data.endswith(_END):
        raise Damaged("the record does not end where it says", end)
    return _checked(Record(start, end, headers, data[first : first + length]))


def _plain_at(source: Source, start: int, step: int) -> Record:
    """The record at a version line. Its end counts as known only if a record or the end of the file follows."""
    data = source.bytes(start, step)
    while data.find(_END) < 0 and len(data) < min(MOST_HEADER_BYTES, source.size - start):
        data = source.bytes(start, 2 * len(data))
    headers, first, length = _header(data)
    end = start + first + length + len(_END)
    if end > source.size:
        raise Damaged("the record is cut off")
    if source.bytes(end - len(_END), len(_END)) != _END:
        raise Damaged("the record does not end where it says")
    follows = source.bytes(end, len(_VERSION_START))
    if follows and not follows.startswith((_MEMBER_START, _VERSION_START)):
        raise Damaged("no record follows")
    return _checked(Record(start, end, headers, source.bytes(start + first, length)))


def record_at(source: Source, start: int, step: int = STEP_BYTES) -> Record:
    """The record that starts at a place, or ``Damaged`` if a check fails."""
    begin = source.bytes(start, len(_VERSION_START))
    if begin.startswith(_MEMBER_START):
        return _member_at(source, start, step)
    if begin == _VERSION_START:
        return _plain_at(source, start, step)
    raise Damaged("no record starts here")


def salvage(source: Source, step: int = STEP_BYTES) -> Iterator[Record | tuple[int, int, str]]:
    """Records of a file in order and, as (start, end, reason), the gaps between them.

    Together they cover every byte once. After a failed check the search goes on
    behind the damaged record where its end is known, so that text inside it is
    not taken for records; otherwise at the next byte.
    """
    at = 0
    gap: tuple[int, str] | None = None
    while at < source.size:
        try:
            found = record_at(source, at, step)
        except Damaged as damage:
            gap = gap or (at, str(damage))
            at = source.find(damage.end or at + 1)
            if at is None:
                break
            continue
        if gap is not None:
            yield gap[0], at, gap[1]
            gap = None
        yield found
        at = found.end
    if gap is not None:
        yield gap[0], source.size, gap[1]


def _rows(folder: str, name: str, step: int) -> Iterator[tuple]:
    files, path = store(folder)
    with files.open_input_file(f"{path}/{name}") as file:
        for found in salvage(Source(file, file.size(), step), step):
            if isinstance(found, Record):
                http, payload = payload_of(found.headers, found.block)
                told = (found.start, found.end - found.start, None, list(found.headers.items()), list(http.items()), payload)
            else:
                start, end, reason = found
                told = (start, end - start, reason, None, None, None)
            yield name, *told


def _batches(rows: Iterable[tuple]) -> Iterator[pa.RecordBatch]:
    texts = pa.map_(pa.string(), pa.string())
    kinds = (pa.string(), pa.int64(), pa.int64(), pa.string(), texts, texts, pa.binary())
    names = ["archive", "start", "bytes", "error", "headers", "http_headers", "payload"]
    held, size = [], 0
    for row in rows:
        held.append(row)
        size += len(row[-1] or b"")
        if size >= _BATCH_BYTES or len(held) >= 4096:
            yield pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(zip(*held), kinds)], names)
            held, size = [], 0
    if held:
        yield pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(zip(*held), kinds)], names)


def _reader(folder: str, step: int):
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = (name for batch in batches for name in batch.column(0).to_pylist())
        return _batches(row for name in names for row in _rows(folder, name, step))

    return read


def archives_in(spark: SparkSession, folder: str) -> DataFrame:
    """The names of all archives of a folder, ``.warc`` and ``.warc.gz``."""
    files, path = store(folder)
    from pyarrow import fs

    listed = files.get_file_info(fs.FileSelector(path))
    names = sorted(one.base_name for one in listed if one.is_file and one.base_name.endswith((".warc", ".warc.gz")))
    return spark.createDataFrame([(name,) for name in names], "archive string")


def read_archives(archives: DataFrame, folder: str, step: int = STEP_BYTES) -> DataFrame:
    """Every record and every gap of the archives named in ``archives``.

    Columns: (archive, start, bytes, error, headers, http_headers, payload).
    A gap has a reason in ``error`` and nothing else. An archive is read by one
    task, a record at a time, as only what comes before a place tells whether it
    is a record or text inside one; archives of a gigabyte or less, as is usual,
    spread well. Names of fields are in lower case.
    """
    spark = archives.sparkSession
    number = archives.count()
    tasks = max(1, min(number, max(spark.sparkContext.defaultParallelism, number // 4)))
    return archives.select("archive").repartition(tasks, "archive").mapInArrow(_reader(folder, step), _FOUND)


def gaps(found: DataFrame) -> DataFrame:
    """The log of quarantined bytes: (archive, start, bytes, reason)."""
    return found.where(F.col("error").isNotNull()).select("archive", "start", "bytes", F.col("error").alias("reason"))


def log_gaps(found: DataFrame, location: str) -> None:
    """Append the gaps of a reading to a Parquet table."""
    gaps(found).write.mode("append").parquet(location)


def _hex_digest(told: Column) -> Column:
    """A base32 digest as lower-case hex: eight digits of it are five bytes."""
    alphabet = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
    digits = F.translate(told, alphabet, "0123456789ABCDEFGHIJKLMNOPQRSTUV")
    parts = [F.lpad(F.lower(F.conv(F.substring(digits, at, 8), 32, 16)), 10, "0") for at in (1, 9, 17, 25)]
    return F.concat(*parts)


def page_rows(found: DataFrame) -> DataFrame:
    """The pages among the records read: (page_id, payload_bytes, payload_digest, record_type, refers_to, url)."""
    header = F.col("headers")
    return found.where(header["warc-type"].isin("response", "revisit")).select(
        header["page-id"].cast("bigint").alias("page_id"),
        F.col("http_headers")["content-length"].cast("bigint").alias("payload_bytes"),
        _hex_digest(F.substring(header["warc-payload-digest"], 6, 32)).alias("payload_digest"),
        header["warc-type"].alias("record_type"),
        header["refers-to-page-id"].cast("bigint").alias("refers_to"),
        header["warc-target-uri"].alias("url"),
    )


def archived_pages(
    pages: DataFrame, page_id: str = "page_id", url: str = "url", html: str = "html", folder: str | None = None
) -> DataFrame:
    """Write a record per page to the shared folder and read the archives back.

    A row per page: (page_id, payload_bytes, payload_digest, record_type,
    refers_to, url). A null text is an empty payload. Of rows that repeat both
    the payload and its largest id each is a response. A row without an id is a
    response where no copy has an id, and revisits the largest id otherwise. An
    empty table gives no rows; white space in a URL is brought to single blanks,
    and a null URL is null. Other columns are left out and never looked at.
    """
    spark = pages.sparkSession
    folder = folder or shared_folder(spark, "archives")
    written = write_archives(pages, folder, page_id, url, html)
    return page_rows(read_archives(written, folder))
