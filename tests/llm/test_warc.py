import gzip
import random
import zlib
from collections import Counter

import pytest

from paddock.llm import warc

SCHEMA = "page_id long, url string, html string, path string, digest string, tag string"


def pages():
    r = random.Random(4)
    bodies = [None, "", "<p>é</p>", "<p>é</p>", "x" * 70_000, "same", "same", "same", "<html>\r\n\r\n</html>"]
    bodies += ["".join(chr(r.randint(32, 0x2FF)) for _ in range(r.randint(10, 4000))) for _ in range(60)]
    rows = [(i, f"http://h.net/{i}", b, "p", "d", "t") for i, b in enumerate(bodies)]
    return [*rows, (None, None, "same", *"pdt"), (5, "a\r\nb: c", "same", *"pdt"), (900, "u", bodies[20], *"pdt")]


def written(spark, tmp_path, data, parts=4, **kw):
    folder = f"file://{tmp_path}/a b"
    warc.write(spark.createDataFrame(data, SCHEMA).repartition(parts), folder, **kw)
    return folder


@pytest.mark.parametrize("split", [3_001, 1 << 24])
def test_round_trip(spark, tmp_path, split):
    data = pages()
    folder = written(spark, tmp_path, data)
    records = warc.materialize(warc.read(spark, folder, split_bytes=split), "records")
    done = warc.resolved(records).collect()
    first = {}
    for p in sorted((d[0] for d in data if d[0] is not None)):
        for d in data:
            if d[0] == p:
                first.setdefault(d[2] or "", p)
    want = Counter()
    for p, body in [(d[0], (d[2] or "").encode()) for d in data]:
        want[str(p if p is not None else ""), len(body), warc.base32_sha1(body)] += 1
    got = Counter((r["record_id"].split(":")[2], r["payload_bytes"], r["payload_digest"]) for r in done)
    assert got == want
    for r in done:
        if r["record_type"] == "response":
            assert warc.base32_sha1(r["payload"]) == r["stated_digest"]
        else:
            assert r["payload"] is None and r["refers_to"].split(":")[2] != ""
    responses = Counter((d.decode() if (d := r["payload"]) else "") for r in done if r["record_type"] == "response")
    assert responses == Counter(first.keys())


def test_small_payloads_are_all_responses(spark, tmp_path):
    folder = written(spark, tmp_path, pages(), min_bytes=100)
    kinds = Counter(r["record_type"] for r in warc.read(spark, folder).collect())
    assert kinds == {"response": len(pages()) - 1, "revisit": 1}


def test_false_magic_is_passed_over(spark, tmp_path):
    data = [(1, "u", "a", *"pdt"), (2, "u", "b", *"pdt")]
    folder = written(spark, tmp_path, data, parts=1)
    file = next((tmp_path / "a b").glob("*.warc.gz"))
    noise = b"\x1f\x8b\x08\x00junk" + gzip.compress(b"no archive") + b"\x1f\x8b"
    file.write_bytes(noise + file.read_bytes() + noise)
    for split in (61, 1 << 20):
        assert warc.read(spark, folder, split_bytes=split).count() == 2


def test_members_are_plain_gzip(spark, tmp_path):
    written(spark, tmp_path, pages(), parts=2)
    for file in (tmp_path / "a b").glob("*.warc.gz"):
        assert gzip.decompress(file.read_bytes()).count(b"WARC/1.1\r\n") > 0
    assert not [p for p in (tmp_path / "a b").iterdir() if p.name.endswith(".tmp")]
    with pytest.raises(zlib.error):
        zlib.decompress(b"\x1f\x8b\x08", 31)


def test_empty(spark, tmp_path):
    folder = written(spark, tmp_path, [])
    assert warc.resolved(warc.materialize(warc.read(spark, folder), "records")).count() == 0


def foreign(lines, block, ends=b"\r\n\r\n"):
    return gzip.compress(b"WARC/1.0\r\n" + b"\r\n".join(lines) + b"\r\n\r\n" + block + ends)


def test_archives_of_others(spark, tmp_path):
    """Fields without a blank, folded ones, other types, and records that are not whole."""
    http = b"HTTP/1.1 200 OK\r\nX: y\r\n\r\nbody"
    members = [
        foreign([b"WARC-Type:warcinfo", b"Content-Length:4", b"WARC-Record-ID:<urn:a>"], b"info"),
        foreign([b"WARC-Type:response", b"Content-Type:application/http;msgtype=response", b"content-length:%d" % len(http),
                 b"WARC-Record-ID :<urn:b>", b"WARC-Target-URI: http://h/a:b?c", b"\tgoes on"], http),
        foreign([b"WARC-Type: metadata", b"Content-Length: 3", b"no colon here"], b"x: "),
        foreign([b"Content-Length: 2", b"WARC-Record-ID: <urn:d>"], b"ab"),
        foreign([b"WARC-Type: resource", b"Content-Length: many"], b"left"),
        foreign([b"WARC-Type: resource", b"Content-Length: 900"], b"too little"),
    ]
    broken = foreign([b"WARC-Type: resource", b"Content-Length: 9000"], random.Random(1).randbytes(9000))
    corrupt = broken[:5000] + b"\xff" * 40 + broken[5040:-8] + b"\0" * 8
    folder = tmp_path / "w"
    folder.mkdir()
    (folder / "a.warc.gz").write_bytes(b"".join(members) + corrupt + members[0] + broken[:6000])
    for split in (97, 1 << 20):
        rows = warc.read(spark, f"file://{folder}", split_bytes=split).orderBy("offset").collect()
        assert [(r["record_type"], r["error"]) for r in rows] == [
            ("warcinfo", None), ("response", None), ("metadata", None), (None, "no type"), ("resource", "no length"),
            ("resource", "truncated"), ("resource", "corrupt"), ("warcinfo", None), ("resource", "truncated"),
        ]
        assert [bytes(r["payload"]) for r in rows[:3]] == [b"info", b"body", b"x: "]
        assert rows[1]["record_id"] == "urn:b" and rows[1]["target_uri"] == "http://h/a:b?c goes on"
        assert warc.base32_sha1(b"body") == rows[1]["payload_digest"]
    records = warc.materialize(warc.read(spark, f"file://{folder}"), "records")
    assert warc.resolved(records).count() == 9
