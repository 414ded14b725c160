"""ARC files of both versions, their conversion, and pages through both formats and back."""

import gzip
import io
import uuid

import pytest

from compare import difference
from skyledger.llm import queries, warc
from skyledger.sources.paths import Staging

PAGES = "page_id long, url string, html string, name string, number int, digest string, same string"

V1, V2 = warc.FIELDS[1], warc.FIELDS[2]


def http(body, extra=""):
    return f"HTTP/1.1 200 OK\r\nContent-Type: text/html\r\n{extra}\r\n{body}".encode()


def block(version, fields):
    content = f"{version} 0 Crawler\n{fields}\n\n".encode()
    return f"filedesc://old.arc 10.0.0.1 19960923142103 text/plain {len(content)}\n".encode() + content + b"\n"


def v1(url, content, date="19960922181908", kind="text/html"):
    return f"{url} 10.1.2.3 {date} {kind} {len(content)}\n".encode() + content + b"\n"


def v2(url, content, date="20010203040506", kind="text/html"):
    return f"{url} 10.1.2.3 {date} {kind} 200 - - 0 old.arc {len(content)}\n".encode() + content + b"\n"


def members(parts):
    return b"".join(gzip.compress(p) for p in parts)


def test_lines_of_both_versions():
    for version, fields, record in ((1, V1, v1), (2, V2, v2)):
        parts = [block(version, fields), record("http://a.example/", http("one\n\nfiledesc://x\n")), record("dns:a.example", b"a 1 IN A 10.1.2.3\n", kind="text/dns")]
        for stored in (b"".join(parts), members(parts), gzip.compress(b"".join(parts))):
            found = list(warc.captures(io.BytesIO(stored)))
            assert [c.url for c in found] == ["filedesc://old.arc", "http://a.example/", "dns:a.example"]
            assert found[1].payload == b"one\n\nfiledesc://x\n" and found[1].http and not found[2].http
            assert (found[1].address, found[2].kind) == ("10.1.2.3", "text/dns")


def test_blanks_in_a_url():
    found = list(warc.captures(io.BytesIO(block(1, V1) + v1("http://a.example/a b c", http("x")))))
    assert found[1].url == "http://a.example/a b c"


@pytest.mark.parametrize(
    "stored, reason",
    [
        (b"http://a.example/ 1.1.1.1 19960922181908 text/html 0\n", "no version block"),
        (block(1, V1) + v1("http://a.example/", http("x"))[:-3], "bytes are missing"),
        (block(1, V1) + b"http://a.example/ text/html many\n", "no record line"),
        (block(3, V1), "no known version"),
        (block(2, V1), "no known version"),
        (members([block(1, V1), v1("http://a.example/", http("x"))])[:-12], "ends early"),
        (block(1, V1) + b"x" * 3_000_000, "a line of more"),
    ],
)
def test_broken_files(stored, reason):
    with pytest.raises(warc.Broken, match=reason):
        list(warc.captures(io.BytesIO(stored)))


def test_dates():
    assert warc.iso_date("19960922181908") == "1996-09-22T18:19:08Z"
    assert warc.iso_date("199609221819") == "1996-09-22T18:19:00Z" and warc.iso_date("1996") == "1996-01-01T00:00:00Z"
    with pytest.raises(warc.Broken):
        warc.iso_date("yesterday")


def test_reads_of_all_sizes(monkeypatch):
    parts = [block(1, V1), *[v1(f"http://a.example/{i}", http("x" * i)) for i in range(0, 60, 7)]]
    expected = [c.content for c in warc.captures(io.BytesIO(b"".join(parts)))]
    for size in (1, 2, 3, 17, 64):
        monkeypatch.setattr(warc, "CHUNK", size)
        monkeypatch.setattr(warc, "LINE", 1000)
        for stored in (b"".join(parts), members(parts)):
            assert [c.content for c in warc.captures(io.BytesIO(stored))] == expected


def converted(spark, tmp_path, stored, **options):
    """Fields and blocks of the WARC records, and the index, of ARC files given by name."""
    (tmp_path / "arc").mkdir()
    for name, content in stored.items():
        (tmp_path / "arc" / name).write_bytes(content)
    files = spark.createDataFrame([(n, 0, 0) for n in stored], warc.FILES)
    found = warc.to_warc(files, str(tmp_path), str(tmp_path), **options)
    records = []
    for name in [r["name"] for r in found.collect()]:
        records += warc.warc_records(io.BytesIO((tmp_path / "warc" / name).read_bytes()))
    return records, warc.index(files, str(tmp_path)).collect()


def test_conversion(spark, tmp_path):
    first = [block(1, V1), v1("http://a.example/1", http("the same body"), "19970101000000"), v1("dns:a.example", b"a IN A", kind="text/dns")]
    second = [block(2, V2), v2("http://a.example/2", http("the same body"), "19960101000000"), v2("http://a.example/3", http("")), v2("http://a.example/4", http(""))]
    broken = b"".join(first) + b"no record\n" + v1("http://a.example/5", http("lost"))
    records, found = converted(spark, tmp_path, {"a.arc": broken, "b.arc.gz": members(second), "c.arc": b""}, least_bytes=1)
    by_uri = {f.get("warc-target-uri", f["warc-type"]): (f, b) for f, b in records}
    assert len(records) == 7 and len({f["warc-record-id"] for f, _ in records}) == 7
    # The earliest capture holds the payload; empty ones are below the bound.
    assert {u: f["warc-type"] for u, (f, _) in by_uri.items()} == {
        "warcinfo": "warcinfo", "http://a.example/1": "revisit", "dns:a.example": "resource", "http://a.example/2": "response",
        "http://a.example/3": "response", "http://a.example/4": "response"}
    revisit, held = by_uri["http://a.example/1"], by_uri["http://a.example/2"]
    assert revisit[0]["warc-refers-to"] == held[0]["warc-record-id"] and revisit[0]["warc-refers-to-date"] == "1996-01-01T00:00:00Z"
    assert revisit[0]["warc-payload-digest"] == held[0]["warc-payload-digest"] == "sha1:" + warc.digest(b"the same body")
    assert revisit[1] == http("") and held[1] == http("the same body")
    assert by_uri["dns:a.example"][0]["content-type"] == "text/dns" and by_uri["dns:a.example"][1] == b"a IN A"
    for f, b in records:
        assert f["warc-block-digest"] == "sha1:" + warc.digest(b) and int(f["content-length"]) == len(b)
        assert uuid.UUID(f["warc-record-id"][10:-1]).version == 5
    assert [(r["name"], r["number"], r["broken"]) for r in found if r["broken"]] == [("a.arc", 4, "no record line: b'no record\\n'")]


def pages(spark, rows):
    return spark.createDataFrame([(*r, "x", 1, "y", "z") for r in rows], PAGES)


def archived(df, **options):
    return sorted(map(tuple, warc.archived(df, Staging(df.sparkSession).folder, "page_id", "url", "html", **options).collect()), key=str)


def test_query_equals_sql(spark, small):
    name = "op11_warc"
    found, rows, _ = difference(spark, small, queries.queries()[name], queries.oracle_sql()[name])
    assert found is None and rows == 50


def test_odd_pages(spark):
    big = "é" * 700_000
    rows = [
        (5, "http://a.example/", "same"), (3, None, "same"), (9, "a b\n\tc", "same"), (4, "", None), (2, "u", ""), (None, "u", "same"),
        (None, "u", "alone"), (None, "v", "alone"), (7, "u", big), (8, "u", big), (1, "u", "twice"), (1, "u", "twice"), (6, "u", "HTTP/1.1\r\n\r\n"),
    ]
    of = lambda text: (len(text.encode()), warc.digest(text.encode()))
    expected = [
        (5, *of("same"), "revisit", 3), (3, *of("same"), "response", None), (9, *of("same"), "revisit", 3), (None, *of("same"), "revisit", 3),
        (4, *of(""), "revisit", 2), (2, *of(""), "response", None), (None, *of("alone"), "response", None), (None, *of("alone"), "revisit", None),
        (7, *of(big), "response", None), (8, *of(big), "revisit", 7), (1, *of("twice"), "response", None), (1, *of("twice"), "revisit", 1),
        (6, *of("HTTP/1.1\r\n\r\n"), "response", None),
    ]
    assert archived(pages(spark, rows)) == sorted(expected, key=str)
    assert {r[3] for r in archived(pages(spark, rows), least_bytes=10_000_000)} == {"response"}


def test_no_pages(spark):
    assert archived(pages(spark, [])) == []


def test_a_hot_payload_and_many_files(spark, monkeypatch):
    rows = [(i, f"u{i}", "hot" if i % 3 else f"page {i // 2}") for i in range(400)]
    held = {}
    for i, _, text in rows:
        held.setdefault(text, i)
    found = archived(pages(spark, rows).repartition(20))
    assert {r[0]: r[4] for r in found} == {i: None if held[t] == i else held[t] for i, _, t in rows}


def test_a_long_file_goes_on_in_another(spark, monkeypatch, tmp_path):
    monkeypatch.setattr(warc, "FILE_BYTES", 500)
    df = pages(spark, [(i, "u", "x" * 200) for i in range(10)]).coalesce(1)
    files = warc.archive(df, str(tmp_path), "page_id", "url", "html", version=2)
    assert files.count() > 2
    found = warc.index(files, str(tmp_path), "X-Key").where("http").collect()
    assert sorted(r["key"] for r in found) == list(range(10)) and {r["payload_bytes"] for r in found} == {200}
