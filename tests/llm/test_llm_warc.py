import hashlib
import random
import uuid

from burnlens.llm import warc
from burnlens.llm.common import checkpoint_dir

PAGES = "page_id long, url string, html string, digest string, block string, origin string"


def rows_of(pages):
    first = {}
    for i, _, html in pages:
        if i is not None and len((html or "").encode()) >= 100:
            first[html] = min(i, first.get(html, i))
    out = []
    for i, _, html in pages:
        data = (html or "").encode()
        seen = first.get(html) if i is not None else None
        again = seen is not None and i > seen
        out.append((i, len(data), hashlib.sha256(data).hexdigest(), "revisit" if again else "response", seen if again else None))
    return sorted(out, key=str)


def test_round_trip_of_edge_cases(spark):
    rnd = random.Random(1)
    long = "".join(rnd.choice("aé東🙂\r\n <>") for _ in range(60_000))
    tricky = "WARC/1.1\r\nContent-Length: 3\r\n\r\nabc\r\n\r\n0\r\n\r\n" * 40
    texts = [None, "", "short", long, tricky, "x" * 99, "x" * 99, "y" * 100, "y" * 100, long, tricky]
    pages = [(k, f"http://h/{k}\r\nX: y" if k % 2 else None, t) for k, t in enumerate(texts)] + [(3, "again", long), (None, None, long), (None, "u", None)]
    frame = spark.createDataFrame([(*p, "d", "b", "o") for p in pages], PAGES).repartition(3)
    path = f"{checkpoint_dir(spark)}/warc-test-{uuid.uuid4().hex}"
    warc.write_archives(frame, path)
    found = warc.read_pages(warc.read_records(spark, path)).collect()
    assert sorted((tuple(r)[:5] for r in found), key=str) == rows_of(pages)
    stored = {hashlib.sha256((t or "").encode()).hexdigest(): (t or "").encode() for _, _, t in pages}
    assert all(bytes(r.payload) == stored[r.payload_digest] for r in found if r.record_type == "response")
    records = warc.read_records(spark, path)
    assert records.where("type = 'continuation'").count() > 10
    # Lost, doubled and short segments make a page unreadable, not the job.
    segments = records.where("origin IS NOT NULL")
    for broken in (records.where("segment IS NULL OR segment <> 2"), records.unionAll(segments.where("segment = 1"))):
        bad = warc.read_pages(broken).where("record_type = 'response' AND payload_bytes IS NULL").count()
        assert bad == segments.select("origin").distinct().count()


def test_query_on_the_whole_table(table):
    pages = [(r.page_id, r.url, r.html) for r in table("pages").collect()]
    assert sorted((tuple(r) for r in warc.query(table("pages")).collect()), key=str) == rows_of(pages)


def test_empty_table(spark):
    assert warc.query(spark.createDataFrame([], PAGES)).count() == 0


def test_stretches_keep_characters_whole():
    data = ("aé東🙂" * 100).encode()
    for size in (4, 5, 7, 64):
        parts = list(warc.stretches(data, size))
        assert b"".join(parts) == data and all(len(p) <= size for p in parts)
        assert all(p.decode() for p in parts)
    assert warc.dechunked(warc.chunked(data, 7)) == data
