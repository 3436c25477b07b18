import io
import tempfile

import pytest

from quillspark.llm import warc


def frame(spark, rows):
    return spark.createDataFrame([(i, u, h, "clash") for i, u, h in rows], "page_id long, url string, html string, record_type string")


ROWS = [(1, "http://a/", "same"), (2, "http://b/", "same"), (3, None, "same"), (4, "http://c/\r\nX: y", "é" * 200_000), (5, "u", None), (6, "u", ""),
        (7, "u", "one\r\n\r\ntwo"), (3, None, "same"), (None, "u", "same"), (8, "u", "é" * 200_000)]


def test_round_trip(spark):
    got = warc.round_trip(frame(spark, ROWS)).collect()
    last = {}
    for i, _, h in ROWS:
        last[h or ""] = max(last.get(h or "", -1), -1 if i is None else i)
    want = []
    for i, _, h in ROWS:
        b, keeper = (h or "").encode(), last[h or ""]
        want.append((i, len(b), warc.digest_of(b), "response" if i == keeper else "revisit", None if i == keeper else keeper))
    key = lambda r: str(tuple(r))
    assert sorted(map(tuple, got), key=key) == sorted(want, key=key)


def test_small_payloads_are_not_shared(spark):
    path = tempfile.mkdtemp(prefix="qs-warc-") + "/a"
    warc.write_warc(frame(spark, ROWS), path, least_bytes=5)
    got = warc.read_warc(spark, path).collect()
    assert sorted(r.page_id for r in got if r.record_type == "revisit") == [4]
    assert {r.payload.decode() for r in got if r.page_id in (1, 2, 3)} == {"same"}
    assert {r.target_uri for r in got if r.page_id == 4} == {"http://c/%0D%0AX: y"}


def test_predicates_reach_the_reader(spark):
    path = tempfile.mkdtemp(prefix="qs-warc-") + "/a"
    warc.write_warc(frame(spark, ROWS), path)
    found = warc.read_warc(spark, path, payload=False).where("record_type = 'response' and page_id in (7, 1, 99)")
    assert [(r.page_id, r.payload, r.payload_length) for r in found.collect()] == [(7, None, 10)]
    reader = warc.WarcReader({"path": path})
    from pyspark.sql.datasource import EqualTo, GreaterThan
    left = list(reader.pushFilters([EqualTo(("record_type",), "response"), GreaterThan(("page_id",), 1)]))
    assert len(left) == 1 and isinstance(left[0], GreaterThan)


def test_unwanted_records_are_skipped_undecoded():
    big = warc.make_record(1, "u", b"x" * 5_000_000, None)
    file = io.BytesIO(big + warc.make_record(2, "u", b"y", None))
    got = [h["X-Page-Id"] for h, _ in warc.records(file, lambda h: h["X-Page-Id"] == "2", True)]
    assert got == ["2"]
    m = warc._Member(file, 0)
    m.headers()
    assert len(m.text) < 200_000 and m.next_place() == len(big)


def test_members_without_skip_lengths_and_broken_payloads():
    import gzip
    import zlib
    raw = [zlib.decompress(warc.make_record(k, "u", b"payload %d" % k, None), 31) for k in (1, 2)]
    got = [(h["X-Page-Id"], p) for h, p in warc.records(io.BytesIO(b"".join(map(gzip.compress, raw))), lambda h: True, True)]
    assert got == [("1", b"payload 1"), ("2", b"payload 2")]
    with pytest.raises(ValueError):
        list(warc.records(io.BytesIO(gzip.compress(raw[0].replace(b"payload 1", b"payload 9"))), lambda h: True, True))


def test_empty_table(spark):
    assert warc.round_trip(frame(spark, [])).collect() == []


def test_plain_archives_are_read_and_other_bytes_are_an_error(spark):
    import zlib
    raw = [zlib.decompress(warc.make_record(k, "u", b"payload %d " % k * 20_000, None), 31) for k in (1, 2, 3)]
    read = lambda data: [(h["X-Page-Id"], p) for h, p in warc.records(io.BytesIO(data), lambda h: True, True)]
    want = [(str(k), b"payload %d " % k * 20_000) for k in (1, 2, 3)]
    assert read(b"".join(raw)) == want and read(b"") == []
    packed = [warc.make_record(k, "u", b"payload %d " % k * 20_000, None) for k in (1, 2, 3)]
    assert read(packed[0] + raw[1] + packed[2]) == want
    for broken in (b"garbage", packed[0] + b"garbage" + packed[1], b"".join(raw)[5:], raw[0] + b"x"):
        with pytest.raises(ValueError):
            read(broken)
    path = tempfile.mkdtemp(prefix="qs-warc-")
    with open(path + "/a.warc", "wb") as f:
        f.write(b"".join(raw))
    assert sorted(r.page_id for r in warc.read_warc(spark, path).collect()) == [1, 2, 3]
    assert sorted(r.page_id for r in warc.read_warc(spark, "file://" + path, payload=False).where("page_id in (2, 3)").collect()) == [2, 3]


def test_missing_folder_is_an_error(spark):
    with pytest.raises(Exception, match="[Nn]o such|[Nn]ot found|does not exist|Cannot"):
        warc.read_warc(spark, tempfile.mkdtemp(prefix="qs-warc-") + "/none").collect()


def test_paths_get_their_scheme(spark):
    assert warc.qualified(spark, "/shared/x") == "file:///shared/x"
    assert warc.qualified(spark, "hdfs://n/x") == "hdfs://n/x" and warc.qualified(spark, "file:///a b/x") == "file:///a b/x"
