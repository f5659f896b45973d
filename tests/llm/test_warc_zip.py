import base64
import hashlib
import io
import random
import zipfile

import pytest

from helpers import clashing
from tallycheck.llm import warc_zip
from tallycheck.llm.warc_zip import DATA, INDEX, Package


def brute(rows):
    last = {}
    for i, _, html in rows:
        if i is not None:
            last[html or ""] = max(i, last.get(html or "", i))
    out = []
    for i, _, html in rows:
        data = (html or "").encode()
        top = last.get(html or "")
        out.append((str(i), len(data), base64.b32encode(hashlib.sha1(data).digest()).decode(),
                    "response" if i == top else "revisit", None if i == top else str(top)))
    return sorted(out, key=repr)


def test_pages_round_trip(spark):
    r = random.Random(3)
    rows = [(i, f"http://h/{i} é\r\nX: y", r.choice(["", "<p>é\r\n\r\nx</p>", f"<b>{i}</b>", "same\x00"])) for i in range(200)]
    rows += [(300, None, None), (301, "u", "long " * 100_000), (None, "u", "only null"), (None, "u", ""), rows[3], rows[3]]
    pages = clashing(spark.createDataFrame(rows, "page_id long, url string, html string"))
    manifest = warc_zip.write_archives(pages, archive_bytes=3000)
    assert manifest.count() > 4 and manifest.agg({"records": "sum"}).first()[0] == len(rows)
    got = warc_zip.read_archives(spark, manifest).collect()
    assert sorted((tuple(x)[:1] + tuple(x)[2:] for x in got), key=repr) == brute(rows)


def test_small_payloads_stay_responses(spark):
    pages = spark.createDataFrame([(1, "u", "ab"), (2, "u", "ab"), (3, "u", "abc"), (4, "u", "abc")], "page_id long, url string, html string")
    got = warc_zip.read_archives(spark, warc_zip.write_archives(pages, min_bytes=3))
    assert {r["page"]: r["refers_to"] for r in got.collect()} == {"1": None, "2": None, "3": "4", "4": None}


@pytest.mark.parametrize("wide", [False, True])
def test_directory_with_and_without_zip64(monkeypatch, wide):
    if wide:  # sizes, offsets and counts then need the ZIP64 forms
        monkeypatch.setattr(zipfile, "ZIP64_LIMIT", 10)
        monkeypatch.setattr(zipfile, "ZIP_FILECOUNT_LIMIT", 1)
    data, comment = io.BytesIO(), b"PK\x05\x06 not the end"
    with zipfile.ZipFile(data, "w", zipfile.ZIP_STORED, allowZip64=True) as z:
        for k, name in enumerate((DATA, INDEX, "é/other")):
            z.writestr(name, f"content {k} " * 9)
        z.comment = comment
    raw, reads = data.getvalue(), []

    def read(start, size):
        reads.append(size)
        return raw[start:start + size]

    pack = Package(read, len(raw))
    assert (b"PK\x06\x06" in raw) == wide
    for k, name in enumerate((DATA, INDEX, "é/other")):
        m = pack.member(name)
        assert read(m.start, m.size).decode() == f"content {k} " * 9
    with pytest.raises(ValueError):
        Package(lambda s, n: b"x" * n, 100)


def test_compressed_members_are_refused():
    data = io.BytesIO()
    with zipfile.ZipFile(data, "w", zipfile.ZIP_DEFLATED) as z:
        z.writestr(DATA, "x" * 100)
    raw = data.getvalue()
    with pytest.raises(ValueError, match="compressed"):
        Package(lambda s, n: raw[s:s + n], len(raw)).member(DATA)


def test_empty_table(spark):
    manifest = warc_zip.write_archives(spark.createDataFrame([], "page_id long, url string, html string"))
    assert warc_zip.read_archives(spark, manifest).count() == 0
