import gzip
import hashlib
import io
import json
import os
import uuid

import pytest
from pyspark.sql import functions as F

from vitaspan.llm import warc
from vitaspan.llm.common import table

FOLDER = "/root/testdata/sf0.001"


def plan(df):
    # every scan lists its runtime filters, which are no Filter node
    return df._jdf.queryExecution().executedPlan().toString().replace("RuntimeFilters", "")


def brute(pages):
    """Record types and references of (page_id, html) rows."""
    out = []
    for i, html in pages:
        raw = (html or "").encode()
        copies = [j for j, other in pages if j is not None and (other or "") == (html or "")]
        keeper = max(copies) if copies and len(raw) >= 1000 and sum((o or "") == (html or "") for _, o in pages) > 1 else None
        again = keeper is not None and i != keeper
        out.append((i, len(raw), hashlib.sha1(raw).hexdigest(), "revisit" if again else "response", keeper if again else None))
    return sorted(out, key=str)


@pytest.fixture
def folder(tmp_path):
    return str(tmp_path / "archives")


@pytest.fixture(scope="module")
def pages():
    long, other = "<p>é " * 400, "x" * 1000
    rows = [(1, "http://a/1", long), (2, "http://a/2", long), (9, None, long), (3, "http://b/é", "short"), (4, "http://b", "short"), (5, "u", None),
            (6, "line\r\nWARC-Type: evil", other), (7, "u", other), (7, "v", other), (8, "u", "y" * 999), (10, "u", "y" * 999),
            (None, "u", long), (None, None, "z" * 5000), (None, "v", "z" * 5000), (11, "u", "\r\n\r\nWARC/1.1\r\n" * 300), (12, "u", ""),
            (13, "u", "long " * 400_000)]
    return rows


def as_table(spark, rows):
    return spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("payload", F.lit("clash")).withColumn("salt", F.lit(1))


@pytest.mark.parametrize("options", [{}, {"compression": "none"}, {"filebytes": "300"}, {"compression": "none", "filebytes": "3000"}])
def test_round_trip(spark, folder, pages, options):
    warc.write_archives(warc.page_records(as_table(spark, pages)), folder, **options)
    got = warc.read_archives(spark, folder, partitionbytes="4000").collect()
    assert sorted(((r["page_id"], r["payload_bytes"], r["payload_digest"], r["record_type"],
                    r["refers_to"] and int(r["refers_to"].rpartition(":")[2])) for r in got), key=str) == brute([(i, h) for i, _, h in pages])
    html = {(i, u and u.replace("\r\n", "%0D%0A")): (h or "").encode() for i, u, h in pages}
    for r in got:
        assert (r["payload"] is None) == (r["record_type"] == "revisit") and r["date"] == warc.DATE
        assert r["payload"] in (None, html[r["page_id"], r["url"]])
    files = [x for x in os.listdir(folder) if x.startswith("part-") and not x.endswith(".crc")]
    assert len(files) == len(open(f"{folder}/_manifest").readlines()) and ("filebytes" not in options or len(files) > 3)


def test_archives_are_plain_warc(spark, folder, pages):
    """A gzip reader that knows nothing of the extra field sees one record after the other."""
    warc.write_archives(warc.page_records(as_table(spark, pages)).coalesce(1), folder)
    name = json.loads(open(f"{folder}/_manifest").readline())["name"]
    raw, n = gzip.open(f"{folder}/{name}").read(), 0
    while raw:
        head, _, rest = raw.partition(b"\r\n\r\n")
        assert head.startswith(b"WARC/1.1\r\n")
        length = int(warc.parse_head(head)["content-length"])
        assert rest[length:length + 4] == b"\r\n\r\n"
        raw, n = rest[length + 4:], n + 1
    assert n == len(pages)


def test_filters_and_payloads_stay_in_the_source(spark, folder, pages, monkeypatch):
    warc.write_archives(warc.page_records(as_table(spark, pages)), folder)
    some = warc.read_archives(spark, folder, "page_id long, record_type string, payload_bytes long").where(
        "record_type = 'response' and page_id >= 3 and page_id in (3, 5, 6, 13)")
    assert sorted(r["page_id"] for r in some.collect()) == [3, 5, 13]
    assert "Filter" not in plan(some)
    kept = warc.read_archives(spark, folder).where("payload_bytes < 10 and record_type = 'response'")
    assert sorted(r["page_id"] for r in kept.collect()) == [3, 4, 5, 12] and "Filter" in plan(kept)
    # without the payload column the inflater never sees a block as a whole
    seen = []
    real = warc._Member.more
    monkeypatch.setattr(warc._Member, "more", lambda self, n: seen.append(r := real(self, n)) or r)
    schema = warc.read_archives(spark, folder, "page_id long, payload_bytes long, payload_digest string").schema
    reader = warc.WarcReader(folder, schema, {})
    heads = [r for p in reader.partitions() for r in reader.read(p)]
    assert len(heads) == len(pages) and sum(map(len, seen)) < len(pages) * 3 * 4096
    seen.clear()
    whole = warc.WarcReader(folder, warc.read_archives(spark, folder).schema, {})
    assert len([r for p in whole.partitions() for r in whole.read(p)]) == len(pages) and sum(map(len, seen)) > 2_000_000


def test_foreign_archives(spark, tmp_path):
    """Version 1.0, base 16 and unknown digests, other record types, gzip without the extra field, several records a member."""
    def record(kind, block, *more, content="text/plain"):
        head = [b"WARC/1.0", b"WARC-Type: " + kind, b"WARC-Record-ID: <urn:uuid:%d>" % len(block), b"Content-Type: " + content.encode(),
                b"Content-Length: %d" % len(block), *more]
        return b"\r\n".join([*head, b"", b""]) + block + b"\r\n\r\n"

    body = b"HTTP/1.0 200 OK\r\nServer: x\r\n\r\nhello\r\n\r\nworld"
    all_ = [record(b"warcinfo", b"software: y"), record(b"response", body, b"WARC-Payload-Digest: sha1:" + hashlib.sha1(b"hello\r\n\r\nworld").hexdigest().encode(),
                                                       content="application/http; msgtype=response"),
            record(b"resource", b"z" * 300_000, b"WARC-Payload-Digest: md5:00"), record(b"metadata", b"")]
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.warc").write_bytes(b"".join(all_))
    (tmp_path / "b.warc.gz").write_bytes(b"".join(gzip.compress(r) for r in all_))
    (tmp_path / "ignored.txt").write_text("no archive")
    got = warc.read_archives(spark, str(tmp_path)).collect()
    want = [("metadata", 0, None, b""), ("resource", 300_000, None, b"z" * 300_000), ("response", 14, hashlib.sha1(b"hello\r\n\r\nworld").hexdigest(), b"hello\r\n\r\nworld"),
            ("warcinfo", 11, None, b"software: y")]
    assert sorted(((r["record_type"], r["payload_bytes"], r["payload_digest"], bytes(r["payload"])) for r in got), key=str) == sorted(want * 2, key=str)
    heads = warc.read_archives(spark, f"file:{tmp_path}", "record_type string").where("record_type <> 'warcinfo'")
    assert sorted(r[0] for r in heads.collect()) == ["metadata"] * 2 + ["resource"] * 2 + ["response"] * 2


def test_cut_archive_is_an_error(tmp_path):
    whole = warc.gzip_member(*[b"".join(x) for x in ((warc.record_head({"record_type": "response", "payload_bytes": 9000, "payload_digest": "00" * 20})),)],
                             os.urandom(9000))
    with pytest.raises(EOFError):
        list(warc.records(io.BufferedReader(io.BytesIO(whole[:4000])), lambda r: True, True))


def test_members_of_lost_tasks_are_not_read(spark, folder, pages):
    warc.write_archives(warc.page_records(as_table(spark, pages)), folder)
    with open(f"{folder}/part-{uuid.uuid4().hex}.warc.gz", "wb") as f:
        f.write(b"half a rec")
    assert warc.read_archives(spark, folder, "page_id long").count() == len(pages)
    warc.write_archives(warc.page_records(as_table(spark, pages[:3])), folder)
    assert warc.read_archives(spark, folder, "page_id long").count() == len(pages) + 3
    warc.page_records(as_table(spark, pages[:2])).write.format("warc").mode("overwrite").save(folder)
    assert warc.read_archives(spark, folder, "page_id long").count() == 2


def test_empty_table(spark, folder, pages):
    warc.write_archives(warc.page_records(as_table(spark, pages).limit(0)), folder)
    assert warc.read_archives(spark, folder).collect() == []
    assert warc.archive_pages(as_table(spark, pages).limit(0)).collect() == []


def test_revisits_need_their_digest(spark, folder):
    with pytest.raises(Exception, match="a revisit needs"):
        warc.write_archives(spark.createDataFrame([("revisit", "x")], "record_type string, refers_to string"), folder)


def test_query(spark):
    from vitaspan.llm import queries

    rows = [tuple(r) for r in table(spark, FOLDER, "pages").select("page_id", "html").collect()]
    got = queries.op13_warc(spark, FOLDER).drop("url").collect()
    assert sorted((tuple(r) for r in got), key=str) == brute(rows)
