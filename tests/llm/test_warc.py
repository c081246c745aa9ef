"""Archives written and read again, beside plain Python; foreign and broken files; assembly."""

import base64
import gzip
import hashlib
import os

import pytest
from pyspark.sql import functions as F

from fillwatch.llm import queries, warc
from fillwatch.session import settled, shared_dir

SCHEMA = "page_id long, url string, html string, head string, number int, salt string, content binary"
PAGES = [
    (1, "http://a.org/x", "same"), (7, "http://a.org/y?q=ü b", "same"), (3, None, "same"),
    (4, "not a url\r\nWARC-Type: evil", "é\r\n\r\nWARC/1.1\r\n"), (5, "", None), (6, "http://b.org", ""),
    (None, "http://c.org", "same"), (8, "http://d.org", "long " * 200_000), (9, "http://e.org", "twice"),
    (9, "http://e.org", "twice"), (9, "http://e.org", "twice"),
]


def pages(spark, rows=PAGES):
    return spark.createDataFrame([(*r, "h", 1, "s", b"c") for r in rows], SCHEMA).repartition(3)


def digest(html):
    return base64.b32encode(hashlib.sha1((html or "").encode()).digest()).decode()


def wanted(rows, least=0):
    out, seen = [], set()
    for page, _, html in rows:
        size = len((html or "").encode())
        group = [p for p, _, h in rows if (h or "") == (html or "") and size >= least]
        top = max((p for p in group if p is not None), default=None)
        stays = size < least or (page == top and (html or "") not in seen)
        if stays and size >= least:
            seen.add(html or "")
        out.append((page, size, digest(html), "response" if stays else "revisit", None if stays else top))
    return sorted(map(str, out))


@pytest.fixture
def folder(spark):
    return shared_dir(spark, "archives")


def run(spark, tmp_path, rows):
    pages(spark, rows).write.parquet(f"{tmp_path}/pages.parquet")
    return sorted(str(tuple(r)) for r in queries.op12_warc_captures(spark, str(tmp_path)).collect())


def test_query_beside_python(spark, tmp_path):
    assert run(spark, tmp_path, PAGES) == wanted(PAGES)


def test_query_of_many_copies(spark, tmp_path):
    rows = [(i, f"http://h/{i}", "copy" if i % 3 else f"p{i}") for i in range(500)]
    assert run(spark, tmp_path, rows) == wanted(rows)


def test_query_of_no_pages(spark, tmp_path):
    assert run(spark, tmp_path, []) == []


def written(table, least=0):
    return warc.transactions(settled(warc.numbered(table), "pages"), least)


def types(spark, rows, least):
    found = written(pages(spark, rows), least)
    return sorted(h.split("\r\n")[1][11:] for h, in found.select("head").collect())


def test_small_payloads_are_all_responses(spark):
    rows = [(i, "u", "abc") for i in range(4)]
    assert types(spark, rows, 4).count("response") == 4
    assert types(spark, rows, 3).count("response") == 1


def test_files_are_plain_warc(spark, folder):
    """Read by hand: every member is one record, its lengths and digests hold."""
    files = warc.write(written(pages(spark)), folder, most_bytes=1500).collect()
    assert len(files) > 3 and sum(f.records for f in files) == 3 * len(PAGES)
    ids, bodies = [], []
    for f in files:
        assert os.path.getsize(f"{folder}/{f.file}") > 0
        data = gzip.open(f"{folder}/{f.file}").read()
        while data:
            head, _, rest = data.partition(b"\r\n\r\n")
            fields = dict(x.split(": ", 1) for x in head.decode().split("\r\n")[1:])
            size = int(fields["Content-Length"])
            block, data = rest[:size], rest[size:]
            assert head.startswith(b"WARC/1.1\r\n") and data[:4] == b"\r\n\r\n"
            data = data[4:]
            if fields["WARC-Type"] != "warcinfo":
                ids.append(fields["WARC-Record-ID"])
            if fields["WARC-Type"] == "response":
                body = block.partition(b"\r\n\r\n")[2]
                bodies.append(body.decode())
                assert fields["WARC-Payload-Digest"] == f"sha1:{digest(body.decode())}"
    assert len(set(ids)) == len(ids) == 3 * len(PAGES)
    assert sorted(bodies) == sorted({h or "" for _, _, h in PAGES})


def test_captures_are_nested(spark, folder):
    files = warc.archive(pages(spark), folder)
    got = warc.captures(warc.read(files, folder)).collect()
    assert len(got) == len(PAGES)
    for r in got:
        assert r.part == 0 and r.record.type in ("response", "revisit")
        assert [len(r.requests), len(r.metadata)] == [1, 1]
        assert r.requests[0].target_uri == r.metadata[0].target_uri == r.record.target_uri
    long = [r for r in got if r.record.payload_bytes == 1_000_000]
    assert [x.record.payload.decode() for x in long] == ["long " * 200_000]
    assert warc.read(files, folder, ["type", "place"]).columns == ["type", "place"]


FOREIGN = (
    b"WARC/1.0\r\nwarc-type: response\r\nWARC-Record-ID: <r1>\r\nContent-Type: application/http;\r\n"
    b" msgtype=response\r\nContent-Length: 45\r\n\r\nHTTP/1.1 404 Not Found\r\nServer: x\r\n y\r\n\r\nbody\r\n\r\n"
    b"WARC/1.0\r\nWARC-Type: resource\r\nWARC-Record-ID: <r2>\r\nContent-Length: 3\r\n\r\na\n\n\r\n\r\n"
)


@pytest.mark.parametrize("packed", [False, True])
def test_foreign_and_broken_files(spark, folder, packed):
    os.makedirs(folder)
    for name, data in (("good", FOREIGN), ("cut", FOREIGN[:-9]), ("other", b"hello"), ("none", b"")):
        with open(f"{folder}/{name}", "wb") as f:
            f.write(gzip.compress(data) if packed else data)
    files = spark.createDataFrame([("good",), ("cut",), ("other",), ("none",)], "file string")
    got = {}
    for r in warc.read(files, folder).orderBy("file", "place").collect():
        got.setdefault(r.file, []).append(r)
    assert set(got) == {"good", "cut", "other"}
    first, second = got["good"]
    assert (first.type, first.http_status, first.payload.decode(), first.record_id) == ("response", 404, "body", "<r1>")
    assert first.http_fields[0].value == "x y" and (second.payload.decode(), second.problem) == ("a\n\n", None)
    assert [r.problem is None for r in got["cut"]] == [True, False]
    assert [r.problem is None for r in got["other"]] == [False]


def rows(spark, *records):
    return spark.createDataFrame(
        [(t, i, c, "k") for t, i, c in records], "type string, record_id string, concurrent_to array<string>, part string"
    )


def shape(df):
    return sorted(
        (r.capture_id or "", r.part, r.record.type if r.record else None, [x.record_id for x in r.requests], [x.record_id for x in r.metadata])
        for r in df.collect()
    )


def test_assembly_by_either_direction_and_over_one_record(spark):
    records = rows(
        spark,
        ("response", "a", None), ("request", "qa", ["a"]), ("metadata", "ma", ["qa"]),
        ("response", "b", ["qb", "mb"]), ("request", "qb", None), ("metadata", "mb", []),
        ("revisit", "c", []), ("request", "lost", ["gone"]), ("warcinfo", "w", None),
        ("metadata", "both", ["a", "b"]), ("response", None, ["x"]), (None, None, None),
    )
    assert shape(warc.captures(records)) == [
        ("", 0, "response", [], []),
        ("a", 0, "response", ["qa"], ["both", "ma"]),
        ("b", 0, "response", ["qb"], ["both", "mb"]),
        ("c", 0, "revisit", [], []),
        ("lost", 0, None, ["lost"], []),
    ]
    assert warc.captures(records.filter(F.lit(False))).count() == 0


def test_a_capture_with_very_many_records_goes_on_in_further_rows(spark):
    records = rows(spark, ("response", "a", None), *[("metadata", f"m{i:03}", ["a"]) for i in range(300)])
    got = shape(warc.captures(records, attach=50))
    assert len(got) == 6 and {g[:3] for g in got} == {("a", p, "response") for p in range(6)}
    assert sorted(m for g in got for m in g[4]) == [f"m{i:03}" for i in range(300)]


def test_payloads_are_not_shuffled(spark, folder, monkeypatch):
    """Payloads go from the copy into the archives: no shuffle on the way has them."""
    plans = []
    real = warc.write

    def seen(records, *rest, **named):
        plans.append(records._jdf.queryExecution().executedPlan().toString())
        return real(records, *rest, **named)

    monkeypatch.setattr(warc, "write", seen)
    rows = [(i % 90, f"http://h/{i}", f"p{i % 60}" * (i % 5)) for i in range(400)]
    files = warc.archive(pages(spark, rows).repartition(7), folder)
    assert len(plans) == 1 and "payload#" not in plans[0]
    got = warc.captures(settled(warc.read(files, folder), "records")).collect()
    assert not [r for r in got if r.record.problem] and len(got) == 400
    found = sorted(r.record.payload.decode() for r in got if r.record.type == "response")
    assert found == sorted({h for _, _, h in rows})
    for r in got:
        if r.record.type == "response":
            assert r.record.payload_digest == f"sha1:{digest(r.record.payload.decode())}"
