from __future__ import annotations

import gzip
import hashlib
import io
import random

import pytest
from panelloom.llm import warc

PAGES = "page_id long, url string, html string, digest string, size string, first string"


def pages(spark, rows):
    return spark.createDataFrame([(*r, None, None, None) for r in rows], PAGES)


def expected(rows):
    groups = {}
    for i, _, h in rows:
        if i is not None and len((h or "").encode()) >= 1000:
            groups[h] = max(groups.get(h, i), i)
    n = {h: sum(1 for r in rows if r[2] == h) for h in groups}
    out = []
    for i, u, h in rows:
        data = (h or "").encode()
        revisit = h in groups and n[h] > 1 and i != groups[h]
        digest = hashlib.sha1(data).hexdigest()
        out.append((i, len(data), digest, "revisit" if revisit else "response", groups[h] if revisit else None, None if revisit else data))
    return sorted(out, key=repr)


def number(text):
    return int(text.removeprefix("urn:page:")) if text and text != "urn:page:" else None


def read(spark, manifest):
    rows = warc.read_archives(manifest).where("problem is null").collect()
    return sorted(
        (
            (number(r.record_id), r.payload_bytes, r.payload_digest, r.record_type, number(r.refers_to), None if r.payload is None else bytes(r.payload))
            for r in rows
        ),
        key=repr,
    )


def test_round_trip(spark, tmp_path):
    big, other = "é" * 600, "x" * 1000
    rows = [(1, "http://a/ b\r\nX: y", big), (2, "http://é/", big), (3, None, big), (4, "u", "x" * 999), (5, "u", "x" * 999), (-6, "u", other), (7, "u", None), (8, "u", ""), (9, "u", "WARC/1.1\r\n\r\n"), (None, "u", big), (None, "u", "z" * 2000), (None, "u", "z" * 2000), (3, None, big), (10, "u", "long " * 400_000)]
    manifest = warc.write_archives(warc.revisit_records(pages(spark, rows)), str(tmp_path / "out"), 100_000)
    assert read(spark, manifest) == expected(rows)
    uris = {r.record_id: r.target_uri for r in warc.read_archives(manifest).collect()}
    assert uris["urn:page:1"] == "http://a/%20b%0D%0AX:%20y" and uris["urn:page:3"] is None
    with gzip.open(manifest.first()["path"]) as file:
        assert file.read(10) == b"WARC/1.1\r\n"


def test_empty_table(spark, tmp_path):
    manifest = warc.write_archives(warc.revisit_records(pages(spark, [])), str(tmp_path / "none"))
    assert manifest.collect() == [] and warc.read_archives(manifest).collect() == []


def records(n):
    rnd = random.Random(n)
    out = []
    for k in range(n):
        payload = bytes(rnd.randrange(256) for _ in range(rnd.randrange(50, 400)))
        out.append(warc.record_bytes(f"urn:page:{k}", "response", "u", payload, len(payload), hashlib.sha1(payload).hexdigest(), None))
    return out


def salvaged(data):
    rows = list(warc.salvage(io.BytesIO(data), len(data)))
    at = 0
    for r in rows:  # records and gaps cover the file without holes
        assert r["start"] == at or r["start"] < r["stop"]
        at = r["stop"]
    assert at == len(data)
    return [r["record_id"] for r in rows if r["problem"] is None], [(r["start"], r["stop"]) for r in rows if r["problem"]]


def test_salvage_of_members():
    parts = [warc.member(r) for r in records(5)]
    starts = [sum(map(len, parts[:k])) for k in range(6)]
    whole = b"".join(parts)
    ids = [f"urn:page:{k}" for k in range(5)]
    assert salvaged(whole) == (ids, [])
    bad = bytearray(whole)
    bad[starts[2] + 60] ^= 0xFF  # a damaged member
    assert salvaged(bytes(bad)) == (ids[:2] + ids[3:], [(starts[2], starts[3])])
    cut = whole[: starts[1]] + whole[starts[1] + 30 :]  # bytes lost inside a member
    assert salvaged(cut) == (ids[:1] + ids[2:], [(starts[1], starts[2] - 30)])
    junk = whole[: starts[3]] + b"\x1f\x8b\x08junk" * 3 + whole[starts[3] :]
    assert salvaged(junk) == (ids, [(starts[3], starts[3] + 21)])
    assert salvaged(whole[:-5]) == (ids[:4], [(starts[4], len(whole) - 5)])
    assert salvaged(b"nothing here") == ([], [(0, 12)]) and salvaged(b"") == ([], [])


def test_salvage_of_plain_records():
    parts = records(4)
    starts = [sum(map(len, parts[:k])) for k in range(5)]
    whole = b"".join(parts)
    ids = [f"urn:page:{k}" for k in range(4)]
    assert salvaged(whole) == (ids, [])
    bad = bytearray(whole)
    bad[starts[2] - 10] ^= 0xFF  # the digest of the second record no longer fits
    assert salvaged(bytes(bad)) == (ids[:1] + ids[2:], [(starts[1], starts[2])])
    mixed = parts[0] + warc.member(parts[1]) + b"???" + parts[2]
    assert salvaged(mixed)[0] == ids[:3] and len(salvaged(mixed)[1]) == 1
    short = parts[0].replace(b"Content-Length: ", b"Content-Length: 9", 1) + parts[1]
    assert salvaged(short)[0] == ids[1:2]


def test_digests_of_other_writers():
    import base64

    whole = records(2)[0]
    part = whole.replace(b"WARC-Payload-Digest", b"X-Payload-Digest")
    block = part.split(b"\r\n\r\n", 1)[1][:-4]
    own = f"sha1:{hashlib.sha1(block).hexdigest()}".encode()
    sha1, sha256 = hashlib.sha1(block), hashlib.sha256(block)
    forms = [base64.b32encode(sha1.digest()).decode(), sha1.hexdigest().upper()]
    fields = [f"sha1:{f}" for f in forms] + [f"SHA-1:{forms[0].lower()}", "sha256:" + sha256.hexdigest(), "sha256:" + base64.b32encode(sha256.digest()).decode(),
              "md5:" + hashlib.md5(block).hexdigest(), "sha512:" + base64.b64encode(hashlib.sha512(block).digest()).decode(), "blake9:unknown"]
    assert own in part
    for field in fields:
        other = part.replace(b"WARC-Block-Digest: " + own, b"WARC-Block-Digest: " + field.encode())
        assert salvaged(other) == (["urn:page:0"], []) and salvaged(warc.member(other)) == (["urn:page:0"], [])
        bad = bytearray(other)
        bad[-10] ^= 0xFF
        if "blake9" not in field:
            assert salvaged(bytes(bad)) == ([], [(0, len(bad))])
    payload = whole.split(b"WARC-Payload-Digest: sha1:", 1)[1][:40]
    assert salvaged(whole.replace(payload, payload.upper())) == (["urn:page:0"], [])


def test_salvage_inside_a_member_of_several_records():
    parts, ids = records(5), [f"urn:page:{k}" for k in range(5)]
    whole = warc.member(b"".join(parts))
    assert salvaged(whole) == (ids, [])
    flaw = bytearray(parts[2])
    flaw[-10] ^= 0xFF  # the member's checksum fits, one record's digest does not
    packed = warc.member(b"".join([*parts[:2], bytes(flaw), *parts[3:]]))
    assert salvaged(packed) == (ids[:2] + ids[3:], [(0, len(packed))])
    long = parts[1].replace(b"Content-Length: ", b"Content-Length: 9", 1)
    packed = warc.member(b"".join([parts[0], long, *parts[2:]]))
    assert salvaged(packed) == (ids[:1] + ids[2:], [(0, len(packed))])
    tail = warc.member(records(6)[5])
    bad = bytearray(whole + tail)
    bad[len(whole) - 6] ^= 0xFF  # the checksum at the member's end
    assert salvaged(bytes(bad)) == ([*ids, "urn:page:5"], [(0, len(whole))])
    kept, gaps = salvaged(whole[: len(whole) // 2] + tail)
    assert 1 <= len(kept[:-1]) < 5 and kept == ids[: len(kept) - 1] + ["urn:page:5"] and gaps == [(0, len(whole) // 2)]


def test_large_member_is_read_in_parts():
    rnd = random.Random(1)
    parts = []
    for k in range(12):
        payload = rnd.randbytes(1 << 20)
        parts.append(warc.record_bytes(f"urn:page:{k}", "response", "u", payload, len(payload), hashlib.sha1(payload).hexdigest(), None))
    ids = [f"urn:page:{k}" for k in range(12)]
    flaw = bytearray(parts[7])
    flaw[5000] ^= 0xFF
    whole = warc.member(b"".join([*parts[:7], bytes(flaw), *parts[8:]]))
    assert salvaged(whole) == (ids[:7] + ids[8:], [(0, len(whole))])
    cut = whole[: len(whole) * 4 // 5]
    assert salvaged(cut) == (ids[:7] + ids[8:9], [(0, len(cut))])


def test_a_cut_archive_is_noticed(spark, tmp_path):
    rows = [(i, "u", f"page {i} " * 300) for i in range(80)]
    manifest = warc.write_archives(warc.revisit_records(pages(spark, rows)), str(tmp_path / "out"), 20_000)
    whole = warc.read_archives(manifest).where("problem is null")
    warc.require_whole(whole, manifest)
    path = manifest.orderBy("path").first()["path"].removeprefix("file:")
    with open(path, "r+b") as file:
        file.truncate(file.seek(0, 2) // 2)
    with pytest.raises(warc.Lost, match="records read from"):
        warc.require_whole(whole, manifest)


def test_a_payload_of_many_megabytes(spark, tmp_path):
    big = "".join(map(chr, range(97, 123))) * 800_000  # 20 MB
    manifest = warc.write_archives(warc.revisit_records(pages(spark, [(1, "u", big), (2, "u", big), (3, "u", "small")])), str(tmp_path / "out"))
    found = warc.read_archives(manifest)
    warc.require_whole(found.where("problem is null"), manifest)
    assert sorted((r.record_id, r.payload_bytes, r.n) for r in found.selectExpr("*", "octet_length(payload) n").collect()) == [
        ("urn:page:1", len(big), None), ("urn:page:2", len(big), len(big)), ("urn:page:3", 5, 5)
    ]
