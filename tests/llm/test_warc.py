"""Archives: round trip, revisits, byte ranges, false magics, damage."""

import base64
import gzip
import hashlib
import random
import zlib
from pathlib import Path

import pytest

from millrace.llm import warc
from tests.llm.conftest import by_id

PAGES = "page_id long, url string, html string, sha1 string, id long, kind string"


def sha(text):
    return base64.b32encode(hashlib.sha1((text or "").encode()).digest()).decode()


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(4)
    texts = ["<p>%s</p>" % "".join(chr(rng.randint(32, 900)) for _ in range(rng.randint(0, 3000))) for _ in range(60)]
    out = [(k, f"http://e.org/{k}", t) for k, t in enumerate(texts)]
    out += [(100 + k, "u", texts[0]) for k in range(40)]  # one payload on very many pages
    return out + [(200, None, None), (201, "a\r\nb", ""), (None, "no id", texts[1]), (None, "no id", "only here"), (7, "again", texts[7]), (300, "long", "é" * 300_000)]


@pytest.fixture
def pages(spark):
    return lambda rows: spark.createDataFrame([(*r, "x", 1, "y") for r in rows], PAGES).repartition(3)


def read(spark, path, **options):
    return {(r.record_id, r.payload_bytes, r.record_type, r.refers_to, r.sound) for r in warc.read(spark, path, **options).collect()}


def wanted(rows):
    largest = {}
    for k, _, t in rows:
        if k is not None:
            largest[sha(t)] = max(largest.get(sha(t), k), k)
    out = set()
    for k, _, t in rows:
        first = largest.get(sha(t))
        again = first is not None and k != first
        out.add(("" if k is None else str(k), len((t or "").encode()), "revisit" if again else "response", str(first) if again else None, True))
    return out


def test_round_trip(spark, pages, rows, tmp_path):
    path = str(tmp_path / "a")
    warc.write(pages(rows), path)
    assert read(spark, path) == wanted(rows)
    got = {(r.record_id, r.payload_digest, r.payload) for r in warc.read(spark, path).where("record_type = 'response'").collect()}
    assert {(i, d) for i, d, _ in got} == {(k, sha(t)) for k, t in (("" if k is None else str(k), t) for k, _, t in rows) if (k, len((t or "").encode()), "response", None, True) in wanted(rows)}
    assert all(sha(p.decode()) == d for _, d, p in got)
    # any gzip reader reads the files
    text = b"".join(gzip.decompress(f.read_bytes()) for f in Path(path).glob("part-*"))
    assert text.count(b"WARC/1.1\r\n") == len(rows)


@pytest.mark.parametrize("size", ["700", "4096"])
def test_byte_ranges_give_the_same(spark, pages, rows, tmp_path, size):
    path = str(tmp_path / "a")
    warc.write(pages(rows).coalesce(1), path)
    before = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    spark.conf.set("spark.sql.files.maxPartitionBytes", size)
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    try:
        short = [r for r in rows if r[0] != 300]
        warc.write(pages(short).coalesce(1), path + "b")
        assert read(spark, path + "b", with_payload=False) == wanted(short)
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def stored(record: bytes) -> bytes:
    """A member whose data are stored as they are, so that a magic in the payload stands in the file."""
    packer = zlib.compressobj(0, zlib.DEFLATED, 31)
    return packer.compress(record) + packer.flush()


@pytest.mark.parametrize("size", ["97", "311", "100000"])
def test_magics_inside_members_and_damage(spark, tmp_path, size):
    bodies = [bytes([65 + k]) * 40 + warc.MAGIC + b"x" * k * 9 + warc.MAGIC + gzip.compress(b"inner") + b"end" for k in range(20)]
    made = []
    for k, body in enumerate(bodies):
        digest = hashlib.sha1(body).hexdigest()
        raw = gzip.decompress(warc.member(str(k), "response", "u", body, digest, len(body), None))
        made.append(stored(raw))
    damaged = warc.member("bad", "response", "u", b"z" * 500, "00" * 20, 500, None)
    made[10:10] = [damaged[:30] + b"\xff\xff\xff" + damaged[33:]]
    (tmp_path / "in.warc").write_bytes(b"".join(made))
    before = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    spark.conf.set("spark.sql.files.maxPartitionBytes", size)
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    try:
        got = {r.record_id: (bytes(r.payload), r.sound) for r in warc.read(spark, str(tmp_path / "in.warc")).collect()}
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert {k: v for k, v in got.items() if v[1]} == {str(k): (b, True) for k, b in enumerate(bodies)}


def test_least_bytes_and_empty_table(spark, pages, tmp_path):
    rows = [(1, "u", "abc"), (2, "u", "abc"), (3, "u", ""), (4, "u", None)]
    warc.write(pages(rows), str(tmp_path / "a"), least_bytes=1)
    assert by_id(warc.read(spark, str(tmp_path / "a")), "record_id", "record_type", "refers_to") == [
        ("1", "revisit", "2"), ("2", "response", None), ("3", "response", None), ("4", "response", None)]
    warc.write(pages(rows).where("false"), str(tmp_path / "none"))
    assert warc.read(spark, str(tmp_path / "none")).count() == 0
