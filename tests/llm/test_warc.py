import gzip
import hashlib
import os

from abacist.llm import warc
from abacist.llm.common import new_dir

BIG = "<p>" + "ä text of more than a thousand bytes " * 40 + "</p>"


def pages(spark, rows):
    df = spark.createDataFrame([(*r, "x") for r in rows], "page_id long, url string, html string, offset string")
    return df.repartition(3)


def brute(rows):
    found = []
    for i, _, html in rows:
        data = (html or "").encode()
        same = [j for j, _, h in rows if (h or "") == (html or "") and j is not None]
        keep = max(same, default=None)
        revisit = len(data) >= 1000 and keep is not None and keep != i
        found.append((i, len(data), hashlib.sha1(data).hexdigest(), "revisit" if revisit else "response", keep if revisit else None))
    return sorted(found, key=str)


ROWS = [(i, f"https://h{i % 4}.example.org/p/{i}?q=ü&x={i}", f"<p>page {i}</p>") for i in range(40)]
ROWS += [(100 + i, f"http://copy.net/{i}", BIG) for i in range(30)] + [(129, "http://copy.net/29", BIG)]
ROWS += [(200, None, None), (201, "", ""), (202, "no scheme", ""), (203, "http://[bad", "x"), (None, "http://null.org/a b\n", BIG)]
ROWS += [(204, "http://same.org/", "y" * 999), (205, "http://same.org/", "y" * 999), (206, "http://l.org/", "z" * 400_000)]


def test_records_come_back(spark):
    archive = warc.write(pages(spark, ROWS), new_dir(spark, "warc-test"), lines=7)
    records = archive.records(archive.captures()).collect()
    found = sorted(((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in records), key=str)
    assert found == brute(ROWS)
    html = {(i, u): h for i, u, h in ROWS}
    for r in records:
        assert (r.page_id, r.url) in html
        if r.record_type == "response":
            assert bytes(r.payload).decode() == (html[r.page_id, r.url] or "")
        else:
            assert r.payload is None


def test_index_is_sorted_and_lookups_read_few_blocks(spark):
    archive = warc.write(pages(spark, ROWS), new_dir(spark, "warc-test"), lines=7)
    blocks = sorted(map(tuple, archive.directory.collect()))
    assert sum(b[-1] for b in blocks) == len(ROWS) and max(b[-1] for b in blocks) <= 7
    assert all(a[1] <= b[0] for a, b in zip(blocks, blocks[1:]))
    wanted = [ROWS[3][1], "http://same.org/", "http://absent.org/", ROWS[17][1]]
    hits = archive.captures(wanted)
    assert sorted(r.page_id for r in archive.records(hits).collect()) == [3, 17, 204, 205]


def test_archives_are_gzip_members_of_warc_records(spark):
    folder = new_dir(spark, "warc-test")
    warc.write(pages(spark, ROWS), folder)
    root = folder.removeprefix("file://")
    text = b"".join(gzip.open(os.path.join(root, f)).read() for f in os.listdir(root) if f.endswith(".warc.gz"))
    assert text.count(b"WARC/1.1\r\nWARC-Type: ") == len(ROWS)
    assert b"identical-payload-digest" in text


def test_capture_keys():
    assert warc.capture_key("https://A.b.org/x?y=1") == "org,b,a)/x?y=1"
    assert warc.capture_key(None) == ")" == warc.capture_key("")


def test_empty_table(spark):
    archive = warc.write(pages(spark, ROWS).where("false"), new_dir(spark, "warc-test"))
    assert archive.records(archive.captures()).collect() == []
    assert archive.captures(["http://a.org/"]).collect() == []
