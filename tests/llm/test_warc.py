import base64
import gzip
import hashlib
import os
import time
import random

import pytest

from logtide.llm.warc import read_warc, record_bytes, salvage, write_warc

PAGES = "page_id long, url string, html string"


def rows(n=60):
    rng = random.Random(1)
    out = [(k, f"http://x/{k}", f"<p>{rng.choice(['same', 'other', ''])} {'ü' * (k % 3)}</p>") for k in range(n)]
    return out + [(n, None, None), (n + 1, "http://x/a\r\nb", ""), (n + 2, "http://x", "<p>" + "long " * 200_000)]


def digest(text):
    return base64.b32encode(hashlib.sha1((text or "").encode()).digest()).decode()


def brute(pages, least):
    first = {}
    for k, _, html in sorted(pages):
        if len((html or "").encode()) >= least:
            first.setdefault(html or "", k)
    out = {}
    for k, _, html in pages:
        lead = first.get(html or "", k)
        out[k] = (len((html or "").encode()), digest(html), "response" if lead == k else "revisit", None if lead == k else str(lead))
    return out


@pytest.mark.parametrize("least", [0, 12])
def test_round_trip(spark, tmp_path, least):
    pages = rows()
    df = spark.createDataFrame([(*r, "x") for r in pages], PAGES + ", digest string").repartition(4)
    path = str(tmp_path / "warc")
    write_warc(df, path, least_bytes=least, archive_bytes=500)
    records, gaps = read_warc(spark, path)
    got = {int(r.record_id): r for r in records.collect()}
    assert {k: (r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for k, r in got.items()} == brute(pages, least)
    assert gaps.count() == 0 and len(got) == len(pages)
    assert all(bytes(got[k].payload).decode() == (h or "") for k, _, h in pages if got[k].record_type == "response")
    assert got[61].url == "http://x/a%0D%0Ab"
    # any gzip reader sees plain WARC records
    for name in os.listdir(path):
        if name.startswith("part-"):
            with gzip.open(os.path.join(path, name)) as file:
                assert file.read().startswith(b"WARC/1.1\r\n")


def member(k, payload=b"payload", refers=None):
    return record_bytes(str(k), "u", payload, digest(payload.decode("latin-1")), refers)


def test_salvage_of_damaged_members():
    sound = [member(k, bytes([65 + k]) * 400) for k in range(5)]
    hurt = bytearray(sound[2])
    hurt[len(hurt) // 2] ^= 0xFF
    data = sound[0] + b"noise between" + sound[1] + bytes(hurt) + sound[3][: len(sound[3]) // 2] + sound[4] + b"\x1f\x8btail"
    found = list(salvage(data))
    assert [f[1]["x-page-id"] for f in found if f[1]] == ["0", "1", "4"]
    gaps = [(f[0], f[3]) for f in found if f[1] is None]
    whole = {i for f in found for i in range(f[0], f[0] + f[3])}
    kept = {i for k, at in ((0, 0), (1, len(sound[0]) + 13), (4, data.index(sound[4]))) for i in range(at, at + len(sound[k]))}
    assert whole == set(range(len(data))) - kept and len(gaps) == 3
    assert all(f[4] for f in found if f[1] is None)


def test_salvage_of_plain_records():
    plain = [gzip.decompress(member(k, bytes([97 + k]) * 50)) for k in range(4)]
    wrong_digest = plain[1].replace(b"bbbb", b"bbbx")
    wrong_length = plain[2].replace(b"Content-Length: ", b"Content-Length: 9")
    found = list(salvage(plain[0] + wrong_digest + wrong_length + plain[3]))
    assert [f[1]["x-page-id"] for f in found if f[1]] == ["0", "3"]
    assert sum(f[3] for f in found) == len(wrong_digest) + len(wrong_length)
    assert list(salvage(b"")) == [] and [f[3] for f in salvage(b"rubbish")] == [7]


@pytest.mark.parametrize("noise", [
    b"\x1f\x8b\x08" * 200_000, b"WARC/1.0\r\n" * 100_000, b"WARC/1.0\r\nContent-Length: 5\r\n\r\n" * 20_000, b"\x1f\x8b\x08\0\0\0\0\0\0\x03" * 60_000, bytes(2_000_000),
], ids=len)
def test_salvage_takes_time_in_proportion(noise):
    begin = time.process_time()
    found = list(salvage(member(1) + noise + member(2)))
    assert [f[1]["x-page-id"] for f in found if f[1]] == ["1", "2"] and sum(f[3] for f in found) == len(noise)
    assert time.process_time() - begin < 5


def test_strict_reading_stops_at_a_gap(spark, tmp_path):
    (tmp_path / "a.warc.gz").write_bytes(member(1) + b"noise" + member(2))
    with pytest.raises(Exception, match="5 damaged bytes"):
        read_warc(spark, str(tmp_path), strict=True)[0].collect()


def test_gaps_are_reported_by_archive(spark, tmp_path):
    good, bad = member(1), bytearray(member(2))
    bad[30] ^= 0xFF
    (tmp_path / "a.warc.gz").write_bytes(good + bytes(bad) + member(3))
    (tmp_path / "b.warc.gz").write_bytes(member(4))
    records, gaps = read_warc(spark, str(tmp_path))
    assert sorted(r.record_id for r in records.collect()) == ["1", "3", "4"]
    gap = gaps.collect()
    assert [(os.path.basename(g.archive), g.offset, g.gap_bytes) for g in gap] == [("a.warc.gz", len(good), len(bad))]


def test_odd_rows(spark, tmp_path):
    df = spark.createDataFrame([(None, "u", "same"), (None, "u", "same"), (3, "u", "same"), (3, "u", "same"), (4, "u", "same")], PAGES)
    write_warc(df, str(tmp_path / "w"))
    got = sorted((r.record_id, r.record_type, r.refers_to) for r in read_warc(spark, str(tmp_path / "w"))[0].collect())
    assert [g[1:] for g in got if not g[0].isdigit()] == [("response", None)] * 2
    assert [g for g in got if g[0].isdigit()] == [("3", "response", None)] * 2 + [("4", "revisit", "3")]
    write_warc(df.limit(0), str(tmp_path / "none"))
    assert read_warc(spark, str(tmp_path / "none"))[0].count() == 0
