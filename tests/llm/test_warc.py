from __future__ import annotations

import random

import pytest

from streamlytics.llm.warc import _Bytes, member, read_archives, record, salvage, with_revisits, write_archives


class Source:
    def __init__(self, data):
        self.data = data

    def size(self):
        return len(self.data)

    def read_at(self, n, at):
        return self.data[at:at + n]


def made(i, n=400):
    import hashlib

    body = random.Random(i).randbytes(n)
    return record(i, f"http://a/{i}\n", body, hashlib.sha256(body).hexdigest(), "response", None)


def read(data, step=64, window=256):
    good, gaps = [], []
    for found, start, end, why in salvage(_Bytes(Source(data), step, window)):
        if found:
            good.append(int(found["head"]["warc-page-id"]))
        else:
            gaps.append((start, end, why))
    return good, gaps


@pytest.mark.parametrize("pack", [member, bytes])
def test_salvage(pack):
    parts = [pack(made(i)) for i in range(6)]
    assert read(b"".join(parts)) == (list(range(6)), [])
    assert read(b"") == ([], [])
    at = [sum(map(len, parts[:i])) for i in range(7)]
    for cut in (b"junk", b"WARC/1.1\r\n", b"\x1f\x8b\x08junk", b"WARC/1.1\r\nContent-Length: 99999999\r\n\r\n", b"\n" * 700):
        good, gaps = read(b"".join(parts[:2]) + cut + b"".join(parts[2:]))
        assert good == list(range(6))
        assert (gaps[0][0], gaps[-1][1]) == (at[2], at[2] + len(cut))
    for place in range(at[2], at[3], 41):
        data = bytearray(b"".join(parts))
        data[place] ^= 0xFF
        good, gaps = read(bytes(data))
        assert set(good) >= {0, 1, 3, 4, 5} and (2 in good or (gaps[0][0], gaps[-1][1]) == (at[2], at[3]))
    short = b"".join(parts)[:-30]
    good, gaps = read(short)
    assert good == [0, 1, 2, 3, 4] and gaps[-1][:2] == (at[5], len(short))


def test_member_of_many_records_with_damage_inside():
    good, gaps = read(member(made(0) + b"noise" + made(1)) + member(made(2)))
    assert good == [0, 1, 2] and len(gaps) == 1 and "member" in gaps[0][2]


def test_member_larger_than_what_is_held(monkeypatch):
    """A whole archive packed at once, with damage inside, in a memory far below its size."""
    import tracemalloc

    import streamlytics.llm.warc as warc

    monkeypatch.setattr(warc, "HELD", 1 << 16)
    parts = [made(i, 3000) for i in range(30)] + [b"noise" * 9, *(made(i, 400_000) for i in range(30, 70))]
    data = member(b"".join(parts)) + member(made(70))
    tracemalloc.start()
    good, gaps = read(data, 1 << 12, 1 << 16)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert good == list(range(71)) and len(gaps) == 1 and "member" in gaps[0][2]
    assert peak < 6 << 20 < sum(map(len, parts)) / 2
    cut = bytearray(data)
    cut[len(data) // 2] ^= 0xFF
    good, gaps = read(bytes(cut), 1 << 12, 1 << 16)
    assert good[:30] == list(range(30)) and good[-1] == 70 and gaps


@pytest.mark.parametrize("piece", [1, 7, 4096])
def test_records_in_pieces(piece):
    from streamlytics.llm.warc import salvage_records

    for parts, want in (
            ([made(0), made(1)], [0, 1]), ([made(0), b"WARC/1.1\r\nno colon", made(1)], [0, None, 1]), ([b"WARC/1.0\r\n" * 3], [None]),
            ([b"x" * 50_000, made(2), b"WARC/1.1\r\nContent-Length: 99999\r\n\r\n", made(3), b"WAR"], [None, 2, None, 3, None]), ([], [])):
        data = b"".join(parts)
        found = list(salvage_records(data[i:i + piece] for i in range(0, len(data), piece)))
        assert [int(f[0]["head"]["warc-page-id"]) if f[0] else None for f in found] == want
        assert [f[1] for f in found] == [0, *(f[2] for f in found)][:len(found)] and (not data or found[-1][2] == len(data))


def test_each_archive_is_a_task(spark, tmp_path):
    df = spark.range(400).selectExpr("id AS page_id", "'u' AS url", "repeat(id, 50) AS html").repartition(8)
    archives = write_archives(with_revisits(df), f"{tmp_path}/w")
    assert archives.count() == 8
    found = read_archives(archives)
    assert found.rdd.getNumPartitions() == 8
    assert sorted(r.n for r in found.groupBy("file").count().withColumnRenamed("count", "n").collect()) == sorted(
        r.n_records for r in archives.collect())


def test_round_trip(spark, tmp_path):
    same, small = "x" * 100, "y" * 99
    rows = [(5, "u5", same, 1), (3, "u3", same, 1), (9, None, same, 1), (7, "u\r\n7", small, 1), (8, "", small, 1),
            (1, "é", None, 1), (2, "b", "", 1), (None, "n", same, 1), (3, "again", same, 1), (4, "l", "é\x00" * 200_000, 1)]
    df = spark.createDataFrame(rows, "page_id bigint, url string, html string, digest int").repartition(3)
    got = read_archives(write_archives(with_revisits(df), f"{tmp_path}/w")).collect()
    assert all(r.gap is None for r in got)
    assert sorted(((r.page_id, r.record_type, r.refers_to, r.payload_bytes) for r in got), key=repr) == sorted([
        (5, "revisit", 3, 100), (3, "response", None, 100), (3, "response", None, 100), (9, "revisit", 3, 100),
        (None, "revisit", 3, 100), (7, "response", None, 99), (8, "response", None, 99), (1, "response", None, 0),
        (2, "response", None, 0), (4, "response", None, 600_000)], key=repr)
    assert {bytes(r.payload) for r in got if r.page_id == 4} == {("é\x00" * 200_000).encode()}
    assert {r.url for r in got} >= {"u%0D%0A7", "é", None}
    assert read_archives(write_archives(with_revisits(df.limit(0)))).collect() == []
