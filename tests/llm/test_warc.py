"""Archives written and read back, whole and damaged."""

import base64
import gzip
import hashlib
import io
import random
import tracemalloc

import pytest

from nestmeans.llm import warc
from nestmeans.llm.queries import QUERIES

DATA = "/root/testdata/sf0.01"


def digest(data):
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def test_query_round_trip(spark):
    pages = {r["page_id"]: (r["html"] or "").encode() for r in spark.read.parquet(f"{DATA}/pages.parquet").collect()}
    first = {}
    for key in sorted(pages):
        first.setdefault(pages[key], key)
    rows = QUERIES["op6_warc"](spark, DATA).collect()
    assert len(rows) == len(pages)
    for r in rows:
        data = pages[r["page_id"]]
        assert (r["payload_bytes"], r["payload_digest"]) == (len(data), digest(data))
        revisit = first[data] != r["page_id"]
        assert r["record_type"] == ("revisit" if revisit else "response")
        assert r["refers_to"] == (first[data] if revisit else None)


PAGES = [
    (5, "http://a/5", "same", "x"), (3, "http://a/3", "same", "x"), (9, None, None, "x"), (8, "http://a/8", "", "x"),
    (1, "http://a/1\nX: y", "WARC/1.1\r\n\r\né" * 50, None), (-4, "u", "neg", "z"), (None, "v", "same", "z"),
    (7, "r", "twice", ""), (7, "r", "twice", ""),
]


@pytest.mark.parametrize("packed", [True, False])
def test_small_table(spark, tmp_path, packed):
    pages = spark.createDataFrame(PAGES, "page_id bigint, url string, html string, payload string")
    archives = warc.write_archives(pages, str(tmp_path / "w"), archive_bytes=300, packed=packed)
    rows = warc.read_archives(archives).collect()
    assert {r["kind"] for r in rows} == {"record"} and len(rows) == len(PAGES)
    by_id = {r["record_id"].removeprefix(warc.PREFIX): r for r in rows}
    assert by_id["5"]["record_type"] == "revisit" and by_id["5"]["refers_to"] == warc.PREFIX + "3"
    assert by_id["9"]["refers_to"] == warc.PREFIX + "8" and by_id["9"]["payload_bytes"] == 0
    assert by_id["1"]["payload"] == PAGES[4][2].encode() and by_id["1"]["target_uri"] == "http://a/1 X: y"
    assert by_id["-4"]["payload"] == b"neg"
    assert by_id["7"]["record_type"] == "response"
    assert sum(k.startswith("none-") for k in by_id) == 1


def test_min_bytes(spark, tmp_path):
    pages = spark.createDataFrame([(1, "", "aa"), (2, "", "aa"), (3, "", "a"), (4, "", "a")], "page_id bigint, url string, html string")
    rows = warc.round_trip(spark, pages, min_bytes=2).collect()
    assert sorted(r["record_type"] for r in rows) == ["response"] * 3 + ["revisit"]


def test_empty_table(spark, tmp_path):
    pages = spark.createDataFrame([], "page_id bigint, url string, html string")
    assert warc.round_trip(spark, pages).count() == 0


def members(packed, n=6):
    records = [warc.record_bytes(str(i), f"http://h/{i}", (f"payload {i} " * 40).encode(), None) for i in range(n)]
    return [warc.gzip_member(r) if packed else r for r in records]


def ids(rows):
    return [r["record_id"].removeprefix(warc.PREFIX) for r in rows if r["kind"] == "record"]


@pytest.mark.parametrize("packed", [True, False])
@pytest.mark.parametrize("place", ["start", "middle", "end"])
def test_flipped_byte(packed, place):
    parts = members(packed)
    at = {"start": 1, "middle": len(parts[2]) // 2, "end": len(parts[2]) - 1}[place]
    hurt = bytearray(parts[2])
    hurt[at] ^= 0x5A
    data = b"".join([*parts[:2], bytes(hurt), *parts[3:]])
    rows = list(warc.salvage(io.BytesIO(data)))
    assert ids(rows) == ["0", "1", "3", "4", "5"]
    gaps = [(r["start"], r["end"]) for r in rows if r["kind"] == "gap"]
    begin = sum(map(len, parts[:2]))
    assert gaps == [(begin, begin + len(parts[2]))]


@pytest.mark.parametrize("packed", [True, False])
def test_cut_and_junk(packed):
    parts = members(packed)
    data = b"junk\x1f\x8b\x08junk" + parts[0] + parts[1][: len(parts[1]) // 2] + parts[2] + b"\0" * 3_000_000 + parts[3] + parts[4][:-9]
    rows = list(warc.salvage(io.BytesIO(data)))
    assert ids(rows) == ["0", "2", "3"]
    places = sorted((r["start"], r["end"]) for r in rows)
    assert places[0][0] == 0 and places[-1][1] == len(data)
    assert all(a[1] == b[0] for a, b in zip(places, places[1:]))
    assert sum(r["kind"] == "gap" for r in rows) == 4


def test_empty_file():
    assert [r["kind"] for r in warc.salvage(io.BytesIO(b""))] == ["gap"]


class Watched(warc._Window):
    most = 0

    def fill(self, upto):
        done = super().fill(upto)
        Watched.most = max(Watched.most, len(self.data))
        return done


@pytest.mark.parametrize("packed", [True, False])
def test_salvage_holds_little_of_a_large_archive(packed, monkeypatch):
    rng = random.Random(3)
    parts = [warc.record_bytes(str(i), f"http://h/{i}", rng.randbytes(100_000), None) for i in range(400)]
    parts = [warc.gzip_member(r) if packed else r for r in parts]
    parts[7] = parts[7][:50_000] + bytes([parts[7][50_000] ^ 0x5A]) + parts[7][50_001:]
    if not packed:  # a length that reaches far into the file
        parts[9] = parts[9].replace(b"Content-Length: 1", b"Content-Length: 222221", 1)
    monkeypatch.setattr(warc, "_Window", Watched)
    Watched.most = 0
    rows = list(warc.salvage(io.BytesIO(b"".join(parts))))
    lost = {"7"} if packed else {"7", "9"}
    assert ids(rows) == [str(i) for i in range(400) if str(i) not in lost]
    assert Watched.most < 4 << 20


@pytest.mark.parametrize("packed", [True, False])
def test_heads_of_any_length(packed):
    long = warc.record_bytes("1", "http://h/" + "x" * 3_000_000, b"long head", None)
    parts = [members(False)[0], long, members(False)[2]]
    rows = list(warc.salvage(io.BytesIO(b"".join(warc.gzip_member(p) if packed else p for p in parts))))
    assert ids(rows) == ["0", "1", "2"] and len(rows[1]["target_uri"]) == 3_000_009


def test_members_that_inflate_without_end():
    good = members(True)
    bombs = [gzip.compress(b"\0" * 30_000_000), gzip.compress(members(False)[1] + b"\0" * 30_000_000),
             gzip.compress(b"WARC/1.1\r\n" + b"a" * 30_000_000)]
    tracemalloc.start()
    rows = list(warc.salvage(io.BytesIO(b"".join([good[0], bombs[0], good[2], bombs[1], good[3], bombs[2]]))))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert ids(rows) == ["0", "2", "3"] and peak < 4 << 20
    assert sum(r["kind"] == "gap" for r in rows) == 3


def test_a_field_that_goes_on():
    record = members(False)[0].replace(b"\r\nContent-Length", b"\r\nX-Note: one\r\n two\r\nContent-Length", 1)
    assert ids(warc.salvage(io.BytesIO(record))) == ["0"]
