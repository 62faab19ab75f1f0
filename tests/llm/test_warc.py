import gzip
import hashlib

import pytest

from marquee.llm.warc import parse_records, read_archives, warc_report, write_archives
from marquee.session import scratch_path

PAGES = "page_id long, url string, html string"


def pages():
    same, trap = "p" * 1_000, "WARC/1.1\r\n\r\n\r\n\r\nContent-Length: 5\r\n\r\n" * 40
    out = [(i, f"http://x/{i}", same) for i in range(40)]
    out += [(100 + i, "http://y/a\r\nb", "é" * 499) for i in range(3)]            # 998 bytes: below the bound
    out += [(200 + i, None, "é" * 500) for i in range(3)]                          # 1000 bytes
    out += [(300, "u", None), (301, "u", ""), (302, "u", trap), (303, "u", trap), (304, "u", "\r\n\r\n")]
    out += [(400 + i, "u", f"{i}\n" * 60_000) for i in range(3)]
    return out


def brute(rows):
    best = {}
    for p, _, h in rows:
        b = (h or "").encode()
        if len(b) >= 1_000:
            best[b] = max(best.get(b, p), p)
    out = {}
    for p, _, h in rows:
        b = (h or "").encode()
        o = best.get(b, p)
        out[p] = (len(b), hashlib.sha1(b).hexdigest(), "response" if o == p else "revisit", None if o == p else o)
    return out


def answer(df):
    return {r.page_id: (r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in df.collect()}


def test_matches_brute_force(workers):
    frame = workers.createDataFrame(pages(), PAGES).repartition(4)
    assert answer(warc_report(frame)) == brute(pages())


def test_archives_round_trip(workers):
    frame = workers.createDataFrame(pages(), PAGES).repartition(2)
    path = write_archives(frame, scratch_path(workers, "warc-test"))
    files = workers.read.format("binaryFile").option("pathGlobFilter", "*.gz").load(path).collect()
    got = {}
    for f in files:
        assert gzip.decompress(bytes(f.content))
        for fields, body in parse_records(bytes(f.content)):
            got[fields["WARC-Record-ID"]] = body
    assert got == {f"<urn:page:{p}>": (h or "").encode() for p, _, h in pages()}
    assert read_archives(workers, path).count() == len(pages())


def test_archive_files_are_bounded_in_bytes(workers):
    rows = [(i, "u", "x" * 20_000 + str(i)) for i in range(150)] + [(200 + i, "u", "y" * (1 << 20)) for i in range(3)]
    path = write_archives(workers.createDataFrame(rows, PAGES).coalesce(1), scratch_path(workers, "warc-big"))
    files = workers.read.format("binaryFile").option("pathGlobFilter", "*.gz").load(path).collect()
    sizes = [[len(b) for _, b in parse_records(bytes(f.content))] for f in files]
    assert sorted(n for x in sizes for n in x) == sorted(len(h) for _, _, h in rows)
    assert all(len(x) <= 1 or sum(x) <= 64 << 20 for x in sizes)
    assert max(len(x) for x in sizes if sum(x) >= 64 * 20_000) <= 64
    assert all(len(x) == 1 for x in sizes if max(x, default=0) >= 1 << 20)


def test_ties_are_settled_by_url(workers):
    rows = [(7, u, "t" * 2_000) for u in ("http://a", "http://c", "http://b", None)] + [(3, "http://z", "t" * 2_000)]
    for parts in (1, 4):
        got = warc_report(workers.createDataFrame(rows, PAGES).repartition(parts)).collect()
        assert [(r.page_id, r.url) for r in got if r.record_type == "response"] == [(7, "http://c")]
        assert all(r.refers_to == 7 for r in got if r.record_type == "revisit") and len(got) == 5


def test_members_and_damage():
    record = b"WARC/1.1\r\nContent-Length: 3\r\n\r\nabc\r\n\r\n"
    two = gzip.compress(record) + gzip.compress(record)
    assert [b for _, b in parse_records(two)] == [b"abc", b"abc"]
    with pytest.raises(ValueError):
        list(parse_records(gzip.compress(record[:-6])))


def test_shapes(workers):
    assert warc_report(workers.createDataFrame([], PAGES)).count() == 0
    odd = [(None, None, None), (None, "u", "n" * 1_000), (5, "u", "n" * 1_000), (5, "u", "n" * 1_000)]
    got = warc_report(workers.createDataFrame(odd, PAGES + "")).collect()
    assert len(got) == 4
    named = sorted((r.record_type, r.refers_to) for r in got if r.payload_bytes == 1_000)
    assert named == [("response", None), ("revisit", 5), ("revisit", 5)]
    extra = workers.createDataFrame([(1, "u", "h", "x", 2)], PAGES + ", path string, offset long")
    assert warc_report(extra).count() == 1
