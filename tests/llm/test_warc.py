import gzip
import hashlib
import random
from collections import Counter
from pathlib import Path

from shelfcast.llm import warc


def expected(data):
    order = sorted(range(len(data)), key=lambda i: (data[i][0] is None, data[i][0] or 0, data[i][1] or "", i))
    first, out = {}, []
    for i in order:
        payload = (data[i][2] or "").encode()
        digest = hashlib.sha256(payload).hexdigest()
        again = len(payload) >= 100 and digest in first
        out.append((data[i][0], len(payload), digest, "revisit" if again else "response", first[digest] if again else None))
        first.setdefault(digest, data[i][0])
    return sorted(out, key=str)


def pages(spark, data):
    return spark.createDataFrame([(*r, "x") for r in data], "page_id long, url string, html string, offset string")


def test_round_trip(spark):
    random.seed(4)
    bodies = ["", "short", "é" * 60, "a" * 99, "line\r\n\r\nWARC/1.1\r\nContent-Length: 3\r\n\r\n" * 9, "\r\n" * 80, "z" * 100]
    bodies += ["<p>" + "word " * random.randrange(20, 400) + "</p>\r\n" for _ in range(40)] + ["<h1>" + "long " * 100_000]
    data = [(i, f"https://www.h{i % 5}.example.com/p/{i % 17}?q=1", random.choice(bodies)) for i in range(300, 0, -1)]
    data += [(None, None, None), (None, "bad\r\nurl", bodies[2]), (7, "http://h1.example.com/", bodies[2]), (7, "http://h1.example.com/", bodies[2])]
    out = warc.archived_pages(pages(spark, data)).collect()
    got = [(r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in out]
    assert sorted(got, key=str) == expected(data)
    history = sorted(out, key=lambda r: (r.range, r.position))
    keys = [(r.url_key, r.captured, r.page_id is None, r.page_id or 0) for r in history]
    assert keys == sorted(keys)


def test_files_are_warc(spark, run_dir):
    data = [(i, f"http://a.example/{i}", f"<p>{'x' * 50 * i}</p>") for i in range(10)]
    warc.write_warc(pages(spark, data), f"{run_dir}/w", file_records=3)
    found = []
    for f in sorted(Path(run_dir, "w").glob("part-*")):
        raw = gzip.decompress(f.read_bytes())
        stream, n = warc.RecordStream(), 0
        for k in range(0, len(raw), 7):  # whatever way the bytes come
            for offset, header, block in stream.feed(raw[k : k + 7]):
                assert raw[offset:].startswith(b"WARC/1.1\r\n") and len(block) == int(header["Content-Length"])
                found.append(block.split(b"\r\n\r\n", 1)[1].decode())
                n += 1
        stream.close()
        assert n <= 3
    assert sorted(found) == sorted(r[2] for r in data)


def test_hot_urls_spread_over_ranges(spark):
    """A third of the rows have one URL, another third neither id nor url; ranges stay near their size."""
    data = [(i, "http://hot.example/", f"<p>{i}</p>") for i in range(1000)]
    data += [(None, None, f"<p>none {i}</p>") for i in range(1000)]
    data += [(i, f"http://h{i}.example/", f"<p>{i}</p>") for i in range(1000, 2000)]
    out = warc.archived_pages(pages(spark, data).repartition(40), range_entries=100).collect()
    assert Counter(r.payload_digest for r in out) == Counter(hashlib.sha256(h.encode()).hexdigest() for *_, h in data)
    assert max(Counter(r.range for r in out).values()) <= 300
    history = sorted(out, key=lambda r: (r.range, r.position))
    keys = [(r.url_key, r.captured, r.page_id is None, r.page_id or 0, r.file, r.offset) for r in history]
    assert keys == sorted(keys)


def test_empty(spark):
    assert warc.archived_pages(pages(spark, [])).count() == 0


def test_loser_tree():
    random.seed(8)
    for k in (1, 2, 3, 5, 8, 13):
        runs = [sorted((random.randrange(50), j, i) for i in range(random.randrange(0, 30))) for j in range(k)]
        assert list(warc.LoserTree(runs, lambda x: x)) == sorted(x for r in runs for x in r)
    assert list(warc.LoserTree([], lambda x: x)) == []


def test_url_keys():
    assert warc.url_key("http://www.Shop.example.com:80/a/b?c=1#d") == "com,example,shop)/a/b?c=1"
    assert warc.url_key("https://example.org:8443") == "org,example:8443)/"
    assert warc.url_key("no url") == "no url" and warc.url_key(None) == "" and warc.url_key("http://[bad") == "http://[bad"
