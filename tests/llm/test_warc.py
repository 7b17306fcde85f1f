import gzip
import glob
import hashlib
import random

from ordersentry.llm import warc

SCHEMA = "page_id long, url string, html string, digest string, block string"


def test_loser_tree_merges():
    rng = random.Random(6)
    for k in (0, 1, 2, 3, 7, 16):
        runs = [sorted([(f"k{rng.randrange(9)}", f"t{rng.randrange(9)}", rng.choice([None, rng.randrange(99)]), "", 0, "", None, "", f"f{r}", i, 0)
                       for i in range(rng.randrange(20))], key=warc._order) for r in range(k)]
        merged = list(warc.merge_runs(runs))
        assert merged == sorted((e for r in runs for e in r), key=warc._order)


def test_url_key():
    assert warc.url_key("http://www.Blog.Example.com:80/A?b=1#c") == "com,example,blog:80)/a?b=1"
    assert warc.url_key("") == ")/" and warc.url_key("http://[bad") == ")http://[bad"


def test_archives_read_back(spark, tmp_path):
    long = "<p>é\r\n\r\nWARC/1.1\r\n" * 20
    rows = [(4, "http://a.org/x y", long), (2, "http://a.org/\r\n", long), (9, None, long), (1, "u", "short"), (3, "u", "short"), (5, "http://b.org/", None),
            (6, "", "x" * 100), (6, "", "x" * 100), (None, "n", "y" * 200), (7, "n", "y" * 200), (8, "h", "z" * 300_000)]
    df = spark.createDataFrame([(*r, "d", "b") for r in rows], SCHEMA)
    path = warc.write_archives(df, str(tmp_path / "w"), records_per_file=3)
    index = warc.read_index(spark, path).collect()
    keys = [(r["url_key"], r["captured"]) for r in index]
    assert keys == sorted(keys) and len(index) == len(rows)
    got = sorted(((r["page_id"], r["payload_bytes"], r["payload_digest"], r["record_type"], r["refers_to"]) for r in index), key=str)
    expected = []
    for page, _, html in rows:
        payload = (html or "").encode()
        ids = [p for p, _, h in rows if h == html and p is not None]
        first = min(ids) if len(payload) >= 100 and len([1 for _, _, h in rows if h == html]) > 1 and ids else page
        expected.append((page, len(payload), hashlib.sha256(payload).hexdigest(), "response" if first == page else "revisit", None if first == page else first))
    assert got == sorted(expected, key=str)
    for r in index:                                            # the index points at records
        with gzip.open(r["file"].removeprefix("file:")) as f:
            record = f.read()[r["offset"]:r["offset"] + r["length"]]
        assert record.startswith(b"WARC/1.1\r\n") and record.endswith(b"\r\n\r\n") and f"<urn:page:{'null' if r['page_id'] is None else r['page_id']}>".encode() in record
    assert len(glob.glob(f"{path}/*.gz")) >= 4


def test_no_pages(spark, tmp_path):
    path = warc.write_archives(spark.createDataFrame([], SCHEMA), str(tmp_path / "w"))
    assert warc.read_index(spark, path).collect() == []


def test_any_page_id_is_written(spark, tmp_path):
    ids = [2 ** 62, -2 ** 62, 2 ** 63 - 1, -2 ** 63, 9_300_000_000_000, 5]
    df = spark.createDataFrame([(i, "http://a.org/", f"{i} " * 60, "d", "b") for i in ids], SCHEMA)
    index = warc.read_index(spark, warc.write_archives(df, str(tmp_path / "w"))).collect()
    assert sorted(r["page_id"] for r in index) == sorted(ids) and all(len(r["captured"]) == 20 for r in index)
    assert [r["captured"] for r in index] == sorted(r["captured"] for r in index)
    assert {r["captured"] for r in index if r["page_id"] == 5} == {"2024-01-01T00:00:05Z"}
