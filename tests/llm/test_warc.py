import base64
import hashlib
import io
import struct

import pytest
import zstandard

from cohortloom.llm import warc

PAGES = "page_id long, url string, html string, path string, key string"


def archive(records, dictionary=None, wrap=False):
    out = io.BytesIO()
    writer = warc.ArchiveWriter(out, None if wrap else dictionary)
    if wrap:
        content = zstandard.ZstdCompressor().compress(dictionary.as_bytes())
        out.write(struct.pack("<II", warc.DICTIONARY_FRAME, len(content)) + content)
        writer.compressor = zstandard.ZstdCompressor(dict_data=dictionary)
    for r in records:
        writer.add(r)
    return out.getvalue()


def record(i, block=b"x", **extra):
    headers = [("WARC-Type", "resource"), ("WARC-Record-ID", f"<urn:{i}>"), ("WARC-Date", warc.DATE)]
    return warc.serialise([*headers, *extra.items()], block)


def samples(n=400):
    return [f"record {i} some shared words of the page {i % 7} and its foot ".encode() * 30 for i in range(n)]


def parsed(data):
    return list(warc.read_records(io.BytesIO(data)))


@pytest.mark.parametrize("wrap", [False, True])
def test_dictionary_from_the_leading_frame(wrap):
    dictionary = warc.train(samples(), 4096)
    assert dictionary is not None
    data = archive([record(i, s) for i, s in enumerate(samples(20))], dictionary, wrap)
    assert struct.unpack("<I", data[:4])[0] == warc.DICTIONARY_FRAME
    assert [r.block for r in parsed(data)] == samples(20)


def test_frames_across_reads(monkeypatch):
    monkeypatch.setattr(warc, "READ_BYTES", 7)
    blocks = [b"", b"a" * 1000, b"\r\n\r\n", bytes(range(256)) * 9]
    assert [r.block for r in parsed(archive([record(i, b) for i, b in enumerate(blocks)]))] == blocks


def test_other_skippable_frames_and_empty_archive():
    one = archive([record(1)])
    assert len(parsed(struct.pack("<II", 0x184D2A50, 3) + b"abc" + one)) == 1
    assert len(parsed(one + struct.pack("<II", 0x184D2A5F, 0) + one)) == 2
    assert parsed(b"") == []


def damaged():
    good = record(1, b"hello")
    pack = lambda r: archive([r])
    yield "cut frame", pack(good)[:-3]
    yield "stray bytes", pack(good) + b"abc"
    yield "no frame", pack(good) + b"abcdefghij"
    yield "length", pack(good.replace(b"Content-Length: 5", b"Content-Length: 6"))
    yield "not a length", pack(good.replace(b"Content-Length: 5", b"Content-Length: -5"))
    yield "version", pack(good.replace(b"WARC/1.1", b"WARP/1.1"))
    yield "header", pack(good.replace(b"WARC-Type: resource", b"WARC-Type resource"))
    yield "no id", pack(good.replace(b"WARC-Record-ID", b"WARC-Other-ID"))
    yield "digest", pack(good.replace(b"hello", b"hellO"))
    yield "two records", pack(good + good)
    yield "end", pack(good[:-4])
    yield "dictionary", struct.pack("<II", warc.DICTIONARY_FRAME, 4) + b"abcd" + pack(good)
    yield "short dictionary", struct.pack("<II", warc.DICTIONARY_FRAME, 400) + b"abcd"
    body = bytearray(pack(record(1, bytes(range(200)))))
    body[40] ^= 0xFF
    yield "bits", bytes(body)


@pytest.mark.parametrize("name,data", list(damaged()), ids=[n for n, _ in damaged()])
def test_damage_is_noticed(name, data):
    with pytest.raises(warc.ArchiveError):
        parsed(data)


def digest(text):
    return base64.b32encode(hashlib.sha1((text or "").encode()).digest()).decode()


def test_round_trip(spark):
    rows = [
        (1, "http://a.org/ü x\r\nWARC-Type: evil", "<p>one</p>", "x", "y"),
        (2, None, None, None, None),
        (3, "", "", "x", "y"),
        (4, "http://a.org", "<p>one</p>", "x", "y"),
        (None, "http://b.org", "<p>one</p>", "x", "y"),
        (None, "http://b.org", "<p>alone</p>", "x", "y"),
        (5, "u", "é\r\n\r\n" + "long text " * 60_000, "x", "y"),
        (6, "u", "<p>twice</p>", "x", "y"),
        (6, "u", "<p>twice</p>", "x", "y"),
    ]
    pages = spark.createDataFrame(rows, PAGES).repartition(3)
    found = warc.read_archives(spark, warc.write_archives(pages)).toPandas()
    got = sorted(
        (str(r.page_key), r.record_type, str(r.refers_to_key), r.payload_digest, None if r.payload is None else bytes(r.payload))
        for r in found.itertuples()
    )
    want = []
    for i, _, html, _, _ in rows:
        group = [x for x, _, h, _, _ in rows if (h or "") == (html or "") and x is not None]
        top = max(group, default=None)
        revisit = top is not None and i != top
        payload = None if revisit else (html or "").encode()
        want.append((str(i), "revisit" if revisit else "response", str(top) if revisit else "None", digest(html), payload))
    assert sorted(map(str, got)) == sorted(map(str, want))
    referred = found.dropna(subset=["refers_to"])
    assert set(referred["refers_to"]) <= set(found["record_id"])


def test_least_size_of_revisits_and_several_archives(spark):
    pages = spark.createDataFrame([(i, "u", "same") for i in range(40)], "page_id long, url string, html string")
    listed = warc.write_archives(pages.coalesce(1), revisit_bytes=5, archive_bytes=1000)
    assert listed.count() > 3 and listed.groupBy().sum("records").first()[0] == 40
    found = warc.read_archives(spark, listed).toPandas()
    assert set(found["record_type"]) == {"response"} and sorted(map(int, found["page_key"])) == list(range(40))


def test_empty_table(spark):
    listed = warc.write_archives(spark.createDataFrame([], PAGES))
    assert listed.count() == 0 and warc.read_archives(spark, listed).count() == 0
