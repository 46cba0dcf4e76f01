import gzip
import os

import pytest
from pyspark.sql import functions as F

from hirebook.llm import warc as W
from hirebook.llm.catalog import QUERIES
from hirebook.session import scratch_path


def sample(n=6, zipped=True):
    plain = [W.build(f"urn:x-page:{i}", f"http://x/{i}", b"body WARC/1.1\r\n \x1f\x8b\x08 %d " % i * (i + 1), W.digest(b"body WARC/1.1\r\n \x1f\x8b\x08 %d " % i * (i + 1)))
             for i in range(n)]
    return plain, [W.member(r) for r in plain] if zipped else plain


def spans(raw):
    out = list(W.salvage(raw))
    at = 0
    for _, offset, length, _ in out:
        assert offset == at
        at += length
    assert at == len(raw)
    return out


def test_members_end_with_zero_and_are_gzip():
    plain, members = sample()
    assert all(m[-1] == 0 for m in members) and gzip.decompress(b"".join(members)) == b"".join(plain)
    large = W.build("urn:x-page:1", None, b"ab" * (1 << 23), W.digest(b"ab" * (1 << 23)))
    m = W.member(large)
    assert m[-1] == 0 and gzip.decompress(m) == large
    out = list(W.salvage(m + members[0]))
    assert [x[0] for x in out] == ["ok", "ok"] and out[0][3]["payload_bytes"] == 1 << 24


@pytest.mark.parametrize("zipped", [True, False])
def test_clean_archive(zipped):
    _, parts = sample(zipped=zipped)
    out = spans(b"".join(parts))
    assert [x[3]["record_id"] for x in out] == [f"urn:x-page:{i}" for i in range(6)] and {x[0] for x in out} == {"ok"}


@pytest.mark.parametrize("zipped", [True, False])
@pytest.mark.parametrize("hurt", ["flip", "cut", "junk", "zero"])
@pytest.mark.parametrize("at", [0, 2, 5])
def test_later_records_are_recovered(zipped, hurt, at):
    _, parts = sample(zipped=zipped)
    p = parts[at]
    if hurt == "flip":
        p = p[:-40] + bytes([p[-40] ^ 255]) + p[-39:]
    elif hurt == "cut":
        p = p[:len(p) // 2]
    elif hurt == "zero":
        p = bytes(len(p))
    else:
        p = b"junk" * 50 + p
    parts[at] = p
    out = spans(b"".join(parts))
    ids = [x[3]["record_id"] for x in out if x[0] == "ok"]
    assert ids == [f"urn:x-page:{i}" for i in range(6) if i != at or hurt == "junk"]
    lost = [x for x in out if x[0] == "gap"]
    assert len(lost) == 1 and lost[0][1] == sum(map(len, parts[:at])) and lost[0][3]
    assert lost[0][2] == (200 if hurt == "junk" else len(p))


@pytest.mark.parametrize("before", [0, 2])
@pytest.mark.parametrize("hurt", ["record", "first", "tail", "checksum", "data"])
def test_one_member_of_many_records(hurt, before):
    plain = [W.build(f"urn:x-page:{i}", "http://x", os.urandom(20000).hex().encode(), "") for i in range(12)]
    plain = [r.replace(b"WARC-Payload-Digest: sha1:\r\n", b"") for r in plain]
    _, others = sample(3)
    bad = {"record": 5, "first": 0}.get(hurt)
    if bad is not None:
        plain[bad] = plain[bad][:-100] + b"~" + plain[bad][-99:]
    one = W.member(b"".join(plain))
    if hurt == "tail":
        one = one[:len(one) * 3 // 4]
    elif hurt == "checksum":
        one = one[:-8] + bytes([one[-8] ^ 255]) + one[-7:]
    elif hurt == "data":
        one = one[:len(one) // 2] + bytes(64) + one[len(one) // 2 + 64:]
    raw = b"".join(others[:before]) + one + (others[2] if hurt != "tail" or before else b"")
    out = list(W.salvage(raw))
    at = sum(map(len, others[:before]))
    ids = [x[3]["record_id"][11:] for x in out if x[0] == "ok" and x[1] == at]
    if bad is not None:
        assert ids == [str(i) for i in range(12) if i != bad]
    elif hurt == "checksum":
        assert ids == [str(i) for i in range(12)]
    else:
        assert ids == [str(i) for i in range(len(ids))] and len(ids) >= (8 if hurt == "tail" else 5)
    lost = [x for x in out if x[0] == "gap"]
    assert len(lost) == 1 and lost[0][1] == at and lost[0][2] == len(one) and lost[0][3]
    assert [x[3]["record_id"][11:] for x in out if x[0] == "ok" and x[1] > at] == (["2"] if len(raw) > at + len(one) else [])


def test_a_damaged_member_gives_no_unchecked_record():
    r = W.build("urn:x-page:1", "http://x", b"text", "")
    bare = b"\r\n".join(x for x in r.split(b"\r\n") if b"-Digest:" not in x)
    one = W.member(bare * 2)
    assert [x[0] for x in W.salvage(one)] == ["ok", "ok"]
    assert [x[0] for x in W.salvage(one[:-8] + bytes([one[-8] ^ 255]) + one[-7:])] == ["gap"]
    assert [x[0] for x in W.salvage(one[:-1])] == ["ok", "ok", "gap"]  # only cut off


@pytest.mark.parametrize("old,new,reason", [
    (b"Content-Length: ", b"Content-Length: -", "Content-Length"), (b"WARC/1.1\r\nWARC-Type", b"WARX/1.1\r\nWARC-Type", "version line"),
    (b"WARC-Payload-Digest: sha1:", b"WARC-Payload-Digest: sha1:A", "payload digest"), (b"WARC-Block-Digest: sha1:", b"WARC-Block-Digest: sha1:A", "block digest"),
    (b"WARC-Date: " + W.DATE.encode(), b"no header", "header line")])
def test_checks(old, new, reason):
    r = W.build("urn:x-page:1", None, b"text", W.digest(b"text"))
    assert old in r and W.parse(r)[1] == len(r)
    with pytest.raises(W.Bad) as e:
        W.parse(r.replace(old, new, 1))
    assert reason in str(e.value)


def test_round_trip_through_spark(spark):
    rows = [(5, "http://a", "same", 1), (3, "http://b\r\nx", "same", 1), (9, None, None, 2), (2, "http://c", "", 3), (7, "http://d", "é😀\x00\r\n\r\nWARC/1.1\r\n", None),
            (3, "http://b", "same", 1), (None, "http://e", "same", 4), (None, None, "only null", 5), (11, "u", "x" * 300000, 0)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, type long")
    path = scratch_path(spark, "warc-test")
    W.write_pages(pages, path, per_file=2)
    read = W.read_archives(spark, path)
    assert W.gaps(read).count() == 0
    got = sorted((r.record_id, r.type, r.refers_to, r.payload_bytes, r.payload_digest) for r in W.records(read).collect())
    p = "urn:x-page:"
    want = []
    for i, first, text in [(5, 3, "same"), (3, 3, "same"), (3, 3, "same"), (None, 3, "same"), (9, 2, ""), (2, 2, ""), (7, 7, rows[4][2]), (None, None, "only null"), (11, 11, "x" * 300000)]:
        data = text.encode()
        want.append((p + str(i or "none"), "response" if i == first else "revisit", None if i == first else f"{p}{first}", len(data), W.digest(data)))
    assert got == sorted(want)
    assert {r.payload for r in W.records(read).collect() if r.payload} == {t.encode() for t in ("same", rows[4][2], "only null", "x" * 300000)}
    # hurt one archive
    files = sorted(f"{d}/{x}" for d, _, xs in os.walk(path.removeprefix("file:")) for x in xs if x.endswith(".txt"))
    raw = bytearray(open(files[0], "rb").read())
    raw[10:14] = b"\0\0\0\0"
    other = scratch_path(spark, "warc-hurt").removeprefix("file:")
    os.makedirs(other)
    open(f"{other}/a.warc.gz", "wb").write(bytes(raw))
    hurt = W.read_archives(spark, other)
    assert W.gaps(hurt).count() == 1


def test_long_headers_and_odd_ids():
    url = "http://a/" + "x" * 300000
    r = W.build("urn:x-page:<a>\r\n", url, b"text", W.digest(b"text"))
    found, n = W.parse(r + b"WARC")
    assert n == len(r) and found["target_uri"] == url and found["record_id"] == "urn:x-page:%3Ca%3E%0D%0A"


def test_archives_are_bounded(spark):
    rows = [(i, "http://a", "%d " % i * 40) for i in range(90)] + [(100 + i, "http://a", os.urandom(150000).hex()) for i in range(6)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").coalesce(1)
    for per_file, file_bytes in ((20, 1 << 25), (2000, 250000)):
        path = scratch_path(spark, "warc-test")
        W.write_pages(pages, path, per_file=per_file, file_bytes=file_bytes)
        read = W.read_archives(spark, path, with_payload=False)
        per = read.groupBy("file").agg(F.count("*").alias("n"), F.sum("length").alias("bytes"), F.max("length").alias("most")).collect()
        assert W.gaps(read).count() == 0 and sum(r.n for r in per) == len(rows)
        assert all(r.n <= per_file and r.bytes < file_bytes + r.most for r in per) and len(per) >= 4


def test_small_payloads_are_responses(spark):
    pages = spark.createDataFrame([(1, "u", "ab"), (2, "u", "ab"), (3, "u", "abcd"), (4, "u", "abcd")], "page_id long, url string, html string")
    path = scratch_path(spark, "warc-test")
    W.write_pages(pages, path, least=3)
    assert sorted((r.record_id[11:], r.type) for r in W.read_archives(spark, path, with_payload=False).collect()) == [
        ("1", "response"), ("2", "response"), ("3", "response"), ("4", "revisit")]


def test_empty_table(spark):
    path = scratch_path(spark, "warc-test")
    W.write_pages(spark.createDataFrame([], "page_id long, url string, html string"), path)
    assert W.read_archives(spark, path).collect() == []


def test_query_against_brute_force(spark):
    d = "/root/testdata/sf0.01"
    pages = spark.read.parquet(f"{d}/pages.parquet").collect()
    first = {}
    for r in sorted(pages, key=lambda r: r.page_id):
        first.setdefault(r.html or "", r.page_id)
    got = {r.page_id: r for r in QUERIES["op1_warc"](spark, d).collect()}
    assert len(got) == len(pages)
    for r in pages:
        data, g = (r.html or "").encode(), got[r.page_id]
        alone = first[r.html or ""] == r.page_id
        assert (g.payload_bytes, g.payload_digest, g.record_type, g.refers_to) == (
            len(data), W.digest(data), "response" if alone else "revisit", None if alone else first[r.html or ""])
