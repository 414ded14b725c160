"""Web archives: ARC files of old, converted to WARC, and read back.

An ARC file starts with a version block, whose first line declares the version and whose
last names the fields of the lines that head each record. These are the fields of the two
versions in use; the last of them declares the length of the record's content:

* version 1: URL, IP address, date, content type, length;
* version 2: URL, IP address, date, content type, result code, checksum, location, offset, file name, length.

The converter follows the lines and lengths and writes for each record a WARC record: the
version block becomes ``warcinfo``, an HTTP capture ``response`` or ``revisit``, anything else
``resource``. It makes up what an ARC file lacks: a record identifier (from the file's name and
the record's number, so the same at each attempt), the date in the newer form, and digests of
block and payload. A payload that another capture has is not stored again: the record is a
``revisit`` that refers to that capture.

Files are gzip, a member for each record, or plain. A task reads or writes one file at a time
as a stream and holds one record. Files have names of their tasks; only names that Spark
reports back are listed in the tables beside them, so a lost attempt leaves nothing that is read.
"""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
import zlib
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass
from itertools import islice

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skyledger.sources.paths import Staging

# Field names and forms of the two formats.
FIELDS = {
    1: "URL IP-address Archive-date Content-type Archive-length",
    2: "URL IP-address Archive-date Content-type Result-code Checksum Location Offset Filename Archive-length",
}
WARC = "WARC/1.0"
IDENTICAL = "http://netpreserve.org/warc/1.0/revisit/identical-payload-digest"
NO_ADDRESS = "0.0.0.0"

#: A task goes on in another file when its file has this many bytes of content.
FILE_BYTES = 256 << 20
#: gzip level of written records.
LEVEL = 4
CHUNK = 1 << 20
#: Longer lines are none.
LINE = 1 << 20


class Broken(ValueError):
    """A file does not keep to its format."""


def opened(folder: str):
    if "://" in folder or folder.startswith("file:"):
        system, path = fs.FileSystem.from_uri(folder)
    else:
        system, path = fs.LocalFileSystem(), folder
    return system, path.rstrip("/")


class Input:
    """A stream of the content of a file, which is plain or any number of gzip members."""

    def __init__(self, raw):
        self.raw, self.rest, self.at = raw, b"", 0
        self.pending = raw.read(2)
        self.unzip = zlib.decompressobj(31) if self.pending == b"\x1f\x8b" else None
        self.within = False  # a gzip member

    def _more(self) -> bool:
        """Adds to ``rest``; false at the end."""
        while True:
            data, self.pending = self.pending or self.raw.read(CHUNK), b""
            if self.unzip is None:
                return self._keep(data)
            if not data and not self.within:
                return False
            if self.unzip.eof:
                self.unzip = zlib.decompressobj(31)
            try:
                found = self.unzip.decompress(data, CHUNK)
            except zlib.error as e:
                raise Broken(f"not gzip: {e}") from e
            self.within = not self.unzip.eof
            self.pending = self.unzip.unconsumed_tail if self.within else self.unzip.unused_data
            if self._keep(found):
                return True
            if not data and self.within:
                raise Broken("a gzip member ends early")

    def _keep(self, data: bytes) -> bool:
        self.rest = self.rest[self.at :] + data
        self.at = 0
        return bool(data)

    def line(self) -> bytes:
        """Up to and with the next line feed; what is left if there is none."""
        start = 0
        while (end := self.rest.find(b"\n", self.at + start)) < 0:
            start = len(self.rest) - self.at
            if start > LINE:
                raise Broken(f"a line of more than {LINE} bytes")
            if not self._more():
                end = len(self.rest) - 1
                break
        out, self.at = self.rest[self.at : end + 1], end + 1
        return out

    def take(self, length: int) -> bytes:
        """The next ``length`` bytes."""
        parts, missing = [], length
        while missing:
            if self.at == len(self.rest) and not self._more():
                raise Broken(f"{missing} of {length} bytes are missing at the end")
            part = self.rest[self.at : self.at + missing]
            self.at += len(part)
            missing -= len(part)
            parts.append(part)
        return b"".join(parts)


@dataclass
class Capture:
    """One record of an ARC file."""

    url: str
    address: str
    date: str
    kind: str
    content: bytes

    @property
    def http(self) -> bool:
        return self.content.startswith(b"HTTP/")

    @property
    def head(self) -> bytes:
        """Status line and headers of an HTTP capture, with the empty line that ends them."""
        if not self.http:
            return b""
        end = re.search(rb"\r?\n\r?\n", self.content)
        return self.content[: end.end()] if end else self.content

    @property
    def payload(self) -> bytes:
        return self.content[len(self.head) :]


def http_field(head: bytes, name: str) -> str | None:
    """The first header of that name."""
    found = re.search(rb"(?im)^" + re.escape(name.encode()) + rb":[ \t]*([^\r\n]*)", head)
    return found.group(1).decode("latin-1").strip() if found else None


def _fields(line: bytes, names: list[str], stream: Input) -> Capture:
    """A record by its line and the length that the line declares."""
    # Old crawlers wrote blanks in URLs, so fields are counted from the end.
    values = line.decode("utf-8", "surrogateescape").rstrip("\r\n").rsplit(" ", len(names) - 1)
    if len(values) != len(names) or not values[-1].isdecimal():
        raise Broken(f"no record line: {line[:200]!r}")
    of = dict(zip(names, values, strict=True))
    return Capture(of["URL"], of["IP-address"], of["Archive-date"], of["Content-type"], stream.take(int(of["Archive-length"])))


def captures(raw) -> Iterator[Capture]:
    """The records of an ARC file; the first is the version block."""
    stream = Input(raw)
    line = stream.line()
    if not line:
        return
    if not line.startswith(b"filedesc://"):
        raise Broken(f"no version block: {line[:200]!r}")
    first = _fields(line, FIELDS[1].split(), stream)
    declared = first.content.split(b"\n")
    version = declared[0].split(b" ")[0]
    names = declared[1].decode("latin-1").split() if len(declared) > 1 else []
    if version not in (b"1", b"2") or names != FIELDS[int(version)].split():
        raise Broken(f"no known version: {first.content[:200]!r}")
    yield first
    while line := stream.line():
        if line.strip():  # records are followed by an empty line
            yield _fields(line, names, stream)


class Output:
    """A gzip member for each record."""

    def __init__(self, folder: str, suffix: str):
        system, path = opened(folder)
        system.create_dir(path, recursive=True)
        self.name = f"{uuid.uuid4().hex}{suffix}"
        self.raw = system.open_output_stream(f"{path}/{self.name}", compression=None)
        self.records = self.bytes = 0

    def add(self, *parts: bytes) -> None:
        zip_ = zlib.compressobj(LEVEL, zlib.DEFLATED, 31)
        for part in parts:
            self.raw.write(zip_.compress(part))
            self.bytes += len(part)
        self.raw.write(zip_.flush())
        self.records += 1

    def close(self) -> tuple:
        self.raw.close()
        return self.name, self.records, self.bytes


FILES = "name string, records long, bytes long"
INDEX = "name string, number long, http boolean, key long, url string, date string, payload_bytes long, digest string, broken string"

ARROW = {"string": pa.string(), "long": pa.int64(), "boolean": pa.bool_()}
#: Rows that a task hands over together.
ROWS = 10_000


def _batches(rows: Iterable[tuple], schema: str) -> Iterator[pa.RecordBatch]:
    """Rows of strings, longs and booleans, as they come."""
    fields = [f.split(" ") for f in schema.split(", ")]
    rows = iter(rows)
    while part := list(islice(rows, ROWS)):
        arrays = [pa.array(c, ARROW[kind]) for c, (_, kind) in zip(zip(*part, strict=True), fields, strict=True)]
        yield pa.RecordBatch.from_arrays(arrays, names=[name for name, _ in fields])


def _listing(written: DataFrame, folder: str) -> DataFrame:
    """Writes the files that count, as a table."""
    written.write.parquet(folder)
    return written.sparkSession.read.schema(FILES).parquet(folder)


def _spread(files: DataFrame) -> DataFrame:
    """A file to a task, as far as there are tasks."""
    tasks = max(1, int(files.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    return files.repartition(tasks, "name")


def _line(values: Iterable[str]) -> bytes:
    return (" ".join(values) + "\n").encode("utf-8", "surrogateescape")


def _spelled(url: str) -> str:
    """Without white space or control characters, which would end a field."""
    return "".join(c if c > " " and c != "\x7f" and not c.isspace() else "".join(f"%{b:02X}" for b in c.encode()) for c in url) or "-"


def archive(df: DataFrame, folder: str, key: str, url: str, body: str, version: int = 1, date: str = "20000101000000", media: str = "text/html") -> DataFrame:
    """Writes an ARC record for each row, an HTTP capture with the text ``body`` in UTF-8 (null: empty); returns the files.

    ``key``, a number, is kept in the capture's header ``X-Key`` (null: left out); of a URL white space
    is escaped, and a null one is ``-``. Equal rows are records of their own.
    """
    fields = FIELDS[version]

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, done = None, []
        for batch in batches:
            for k, u, text in zip(*(batch.column(i) for i in range(3)), strict=True):
                if out is not None and out.bytes > FILE_BYTES:
                    done.append(out.close())
                    out = None
                if out is None:
                    out = Output(f"{folder}/arc", ".arc.gz")
                    block = f"{version} 0 skyledger\n{fields}\n\n".encode()
                    out.add(_line([f"filedesc://{out.name}", NO_ADDRESS, date, "text/plain", str(len(block))]), block, b"\n")
                payload = b"" if (text := text.as_py()) is None else text.encode()
                named = f"X-Key: {k}\r\n" if k.is_valid else ""
                head = f"HTTP/1.1 200 OK\r\nContent-Type: {media}\r\nContent-Length: {len(payload)}\r\n{named}\r\n".encode()
                first = [_spelled(u.as_py() or ""), NO_ADDRESS, date, media]
                more = ["200", "-", "-", str(out.bytes), out.name] if version == 2 else []
                out.add(_line([*first, *more, str(len(head) + len(payload))]), head, payload, b"\n")
        if out is not None:
            done.append(out.close())
        yield from _batches(done, FILES)

    rows = df.select(F.col(key).cast("long"), F.col(url).cast("string"), F.col(body).cast("string"))
    return _listing(rows.mapInArrow(write, FILES), f"{folder}/arc_files")


def digest(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def record_id(name: str, number: int) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{name}#{number}')}>"


def iso_date(date: str) -> str:
    """14 digits as a date of the newer form; digits that are left out are the earliest."""
    if not re.fullmatch(r"\d{4,14}", date):
        raise Broken(f"no date: {date[:50]!r}")
    full = date + "00000101000000"[len(date) :]
    return f"{full[:4]}-{full[4:6]}-{full[6:8]}T{full[8:10]}:{full[10:12]}:{full[12:]}Z"


def _indexed(name: str, raw, key_header: str | None) -> Iterator[tuple]:
    number = 1
    try:
        for c in captures(raw):
            key = http_field(c.head, key_header) if key_header else None
            key = int(key) if key and re.fullmatch(r"-?\d{1,19}", key) and abs(int(key)) < 1 << 63 else None
            url = c.url.encode("utf-8", "replace").decode()
            yield name, number, c.http, key, url, iso_date(c.date), len(c.payload), digest(c.payload), None
            number += 1
    except Broken as e:
        yield name, number, False, None, None, None, None, None, str(e)


def index(files: DataFrame, folder: str, key_header: str | None = None) -> DataFrame:
    """A row for each record of the ARC files: what decides whether it is stored or refers to another.

    ``key`` is the number in the HTTP header ``key_header``, null without one. Where a file
    does not keep to its format the rest of it is one row with the reason in ``broken``.
    """

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, path = opened(f"{folder}/arc")
        for batch in batches:
            for name in batch.column("name").to_pylist():
                with system.open_input_stream(f"{path}/{name}", compression=None) as raw:
                    yield from _batches(_indexed(name, raw, key_header), INDEX)

    return _spread(files).select("name").mapInArrow(rows, INDEX)


def decide(found: DataFrame, least_bytes: int = 0) -> DataFrame:
    """Adds ``same``, the record that holds the same payload: of HTTP captures with equal payloads of at least
    ``least_bytes`` the one with the least key (none: last), then the earliest. Null for it and for all others.

    Payloads met by more than one in the shuffle partitions of all records are less than as
    many; these are broadcast, and the records of all others meet theirs by shuffle.
    """
    spark = found.sparkSession
    parts = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    order = F.struct(F.col("key").isNull().alias("no_key"), "key", "date", "name", "number", "url")
    shared = F.col("http") & (F.col("payload_bytes") >= least_bytes)
    by_payload = [F.col("digest").alias("same_digest"), F.col("payload_bytes").alias("same_bytes")]
    firsts = found.where(shared).groupBy(*by_payload).agg(F.min(order).alias("same"), F.count("*").alias("records")).where("records > 1")
    total = found.agg(F.count("*")).first()[0]
    hot = F.broadcast(firsts.where(F.col("records") * parts > total).drop("records"))
    others = firsts.where(F.col("records") * parts <= total).drop("records")
    equal = shared & (F.col("digest") == F.col("same_digest")) & (F.col("payload_bytes") == F.col("same_bytes"))
    of_hot = found.join(hot, equal)
    rest = found.join(hot, equal, "left_anti").join(others, equal, "left")
    joined = of_hot.unionByName(rest).drop("same_digest", "same_bytes")
    itself = (F.col("same.name") == F.col("name")) & (F.col("same.number") == F.col("number"))
    return joined.withColumn("same", F.when(itself, F.lit(None)).otherwise(F.col("same")))


def _warc_head(fields: dict[str, str | int | None]) -> bytes:
    lines = [WARC, *(f"{k}: {v}" for k, v in fields.items() if v is not None)]
    return ("\r\n".join(lines) + "\r\n\r\n").encode("utf-8", "surrogateescape")


def warc_record(c: Capture, name: str, number: int, same: dict | None) -> tuple[bytes, bytes, bytes]:
    """Head, block and end of the WARC record for the record of that number in an ARC file.

    ``same`` tells of the record that holds the payload already.
    """
    kind = "warcinfo" if number == 1 else "revisit" if same else "response" if c.http else "resource"
    block, head = c.content, c.head
    if kind == "warcinfo":
        block = f"software: skyledger\r\nformat: WARC File Format 1.0\r\nisPartOf: {name}\r\n".encode()
    elif kind == "revisit":
        block = head
    media = {"warcinfo": "application/warc-fields", "resource": c.kind}.get(kind, "application/http; msgtype=response")
    fields = {
        "WARC-Type": kind,
        "WARC-Record-ID": record_id(name, number),
        "WARC-Date": iso_date(c.date),
        "WARC-Filename": name if kind == "warcinfo" else None,
        "WARC-Target-URI": None if kind == "warcinfo" else c.url,
        "WARC-IP-Address": None if kind == "warcinfo" or c.address == NO_ADDRESS else c.address,
        "WARC-Warcinfo-ID": None if kind == "warcinfo" else record_id(name, 1),
        "WARC-Block-Digest": f"sha1:{digest(block)}",
        "WARC-Payload-Digest": f"sha1:{digest(c.payload)}" if c.http else None,
        # The payload's own length, which a revisit does not show.
        "X-Payload-Length": len(c.payload) if c.http else None,
    }
    if kind == "revisit":
        fields |= {
            "WARC-Profile": IDENTICAL,
            "WARC-Refers-To": record_id(same["name"], same["number"]),
            "WARC-Refers-To-Target-URI": same["url"],
            "WARC-Refers-To-Date": same["date"],
            "X-Refers-To-Key": same["key"],
        }
    fields |= {"Content-Type": media, "Content-Length": len(block)}
    return _warc_head(fields), block, b"\r\n\r\n"


def convert(decided: DataFrame, arc_folder: str, folder: str) -> DataFrame:
    """Writes a WARC file for each ARC file by its ``decided`` records; returns the files.

    Records from where a file is broken are left out; ``index`` says where and why.
    """

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, path = opened(f"{arc_folder}/arc")
        name = source = raw = out = None
        done = []
        for batch in batches:
            for row in batch.to_pylist():
                if row["name"] != name:
                    if out is not None:
                        raw.close()
                        done.append(out.close())
                    name = row["name"]
                    raw = system.open_input_stream(f"{path}/{name}", compression=None)
                    source, out = captures(raw), Output(f"{folder}/warc", ".warc.gz")
                out.add(*warc_record(next(source), name, row["number"], row["same"]))
        if out is not None:
            raw.close()
            done.append(out.close())
        yield from _batches(done, FILES)

    rows = _spread(decided.where("broken is null").select("name", "number", "same")).sortWithinPartitions("name", "number")
    return _listing(rows.mapInArrow(write, FILES), f"{folder}/warc_files")


def warc_records(raw) -> Iterator[tuple[dict[str, str], bytes]]:
    """Fields (by lower-case name) and block of each record of a WARC file."""
    stream = Input(raw)
    while line := stream.line():
        if not line.strip():
            continue
        if not line.startswith(b"WARC/"):
            raise Broken(f"no WARC record: {line[:200]!r}")
        fields = {}
        while (line := stream.line()).strip():
            name, colon, value = line.decode("utf-8", "surrogateescape").partition(":")
            if not colon:
                raise Broken(f"no field: {line[:200]!r}")
            fields[name.strip().lower()] = value.strip()
        if not fields.get("content-length", "").isdecimal():
            raise Broken("a record does not declare its length")
        yield fields, stream.take(int(fields["content-length"]))


def read(files: DataFrame, folder: str, schema: str, each: Callable[[dict[str, str], bytes], tuple | None]) -> DataFrame:
    """``each(fields, block)`` of every record of the WARC files, in ``schema`` (of strings, longs and
    booleans); records for which it is None are left out."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, path = opened(f"{folder}/warc")
        for batch in batches:
            for name in batch.column("name").to_pylist():
                with system.open_input_stream(f"{path}/{name}", compression=None) as raw:
                    found = (each(fields, block) for fields, block in warc_records(raw))
                    yield from _batches((row for row in found if row is not None), schema)

    return _spread(files).select("name").mapInArrow(rows, schema)


PAGES = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long"


def page(fields: dict[str, str], block: bytes) -> tuple | None:
    """A row of ``PAGES`` from the record of an archived page; a stored payload is held against its digest."""
    kind = fields["warc-type"]
    if kind not in ("response", "revisit"):
        return None
    c = Capture("", "", "", "", block)
    key, declared = http_field(c.head, "X-Key"), fields["warc-payload-digest"].removeprefix("sha1:")
    if kind == "response" and digest(c.payload) != declared:
        raise Broken(f"the payload of {fields['warc-record-id']} has another digest")
    size = len(c.payload) if kind == "response" else int(fields["x-payload-length"])
    refers_to = fields.get("x-refers-to-key")
    return int(key) if key else None, size, declared, kind, int(refers_to) if refers_to else None


def to_warc(arc_files: DataFrame, arc_folder: str, folder: str, least_bytes: int = 0, key_header: str | None = None) -> DataFrame:
    """Converts the listed ARC files of ``arc_folder`` to WARC files in ``folder``; returns these.

    Of HTTP captures with equal payloads of at least ``least_bytes`` the one with the least
    number in the header ``key_header`` (without one: the earliest) is the response that the others refer to.
    """
    found = Staging(arc_files.sparkSession)(index(arc_files, arc_folder, key_header), "index")
    return convert(decide(found, least_bytes), arc_folder, folder)


def archived(df: DataFrame, folder: str, key: str, url: str, body: str, least_bytes: int = 0) -> DataFrame:
    """Rows of ``PAGES``, read back from the WARC files that rows become by way of ARC files.

    A null body is an empty payload. Rows without a key have records too; they are responses
    only if no row with a key has their payload, and what refers to such a one has a null
    ``refers_to``. Rows that repeat a key are records of their own, one of them the response of
    their payload. Other columns are ignored, whatever their names; without rows the result is empty.
    """
    arc_files = archive(df, folder, key, url, body)
    return read(to_warc(arc_files, folder, folder, least_bytes, "X-Key"), folder, PAGES, page)
