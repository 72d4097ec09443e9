"""URL filters and WARC archives."""

import base64
import gzip
import hashlib
import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from starhouse.llm import queries, url_filter, warc

PAGES = "page_id long, url string, html string"


def _judge(url, rules):
    if url is None or "://" not in url:
        return "", "", None, "allow"
    rest = url.split("://", 1)[1]
    end = min((rest.find(c) for c in "/?#" if c in rest), default=len(rest))
    host = "".join(c.lower() if "A" <= c <= "Z" else c for c in rest[:end])
    path = rest[end:].split("?")[0].split("#")[0]
    fits = [(len(h + p), h + p, v) for h, p, v in rules
            if host and (host == h or host.endswith("." + h)) and path.startswith(p)]
    best = max(fits, default=(0, None, "allow"))
    return host, path, best[1], best[2]


URLS = [None, "", "no scheme", "http://", "http:///net/", "http://net", "http://net/", "https://A.NET/x",
        "http://example.net/en/1?q=/de/#x", "http://www.example.net/en", "http://notexample.net/en/",
        "http://x.example.com/de/1", "http://example.com/en/", "a://b.org/fr/x://net/", "http://org/fr/",
        "http://a..net/", "http://.net/", "http://net./", "HTTP://ÉCOLE.ORG/fr/é", "http://x.net?/en/",
        "http://x.net#/", "http://x.net\n/", "http://" + "a." * 300 + "net/" + "p/" * 300, "http://" + "b." * 200_000 + "Example.com/de/" + "q" * 200_000, "http://x.net/"]


def test_url_rules(spark):
    rows = [(i, u, None) for i, u in enumerate([*URLS, *URLS[:8]])]
    pages = spark.createDataFrame(rows, PAGES).selectExpr(
        "*", "'x' AS host", "1 AS lengths", "'y' AS suffix", "'z' AS prefix", "0 AS digest")
    rules = spark.createDataFrame(queries.RULES, "host string, path string, action string")
    found = url_filter.judge_urls(pages, rules).collect()
    assert len(found) == len(rows)
    for r in found:
        assert (r["host"], r["path"], r["rule"], r["verdict"]) == _judge(r["url"], queries.RULES)
        assert (r["suffix"], r["prefix"], r["digest"]) == ("y", "z", 0)


def test_url_rules_of_any_kind(spark):
    rules = [("a.org", "/x", "block"), ("a.org", "/xy", "allow"), ("org", "", "block"),
             ("a.org", "/x", "allow"), (None, "/", "block"), ("", "/", "block"), ("B.org", None, "allow")]
    urls = ["http://a.org/xyz", "http://a.org/xa", "http://c.a.org/", "http://b.org", "http://z.com/"]
    pages = spark.createDataFrame([(i, u, "") for i, u in enumerate(urls)], PAGES)
    table = spark.createDataFrame(rules, "host string, path string, action string")
    found = {r["page_id"]: (r["rule"], r["verdict"])
             for r in url_filter.judge_urls(pages, table, prefix_bytes=1).collect()}
    assert found == {0: ("a.org/xy", "allow"), 1: ("a.org/x", "block"), 2: ("org", "block"),
                     3: ("b.org", "allow"), 4: (None, "allow")}
    none = url_filter.judge_urls(pages, table.limit(0), default="block").collect()
    assert {r["verdict"] for r in none} == {"block"}
    assert url_filter.judge_urls(pages.limit(0), table).count() == 0


def _archived(rows, min_bytes=0):
    smallest = {}
    for p, _, html in rows:
        if p is not None:
            smallest[html or ""] = min(smallest.get(html or "", p), p)
    out = []
    for p, _, html in rows:
        raw = (html or "").encode()
        owner = smallest.get(html or "")
        revisit = owner is not None and p != owner and len(raw) >= min_bytes
        digest = base64.b32encode(hashlib.sha1(raw).digest()).decode()
        out.append((p, len(raw), digest, "revisit" if revisit else "response",
                    owner if revisit else None))
    return sorted(out, key=str)


def _rows():
    r = random.Random(6)
    html = [None, "", "a", "WARC/1.1\r\n\r\n0\r\n\r\n", "é" * 9000, "x" * 40_000, "\r\n\r\n" * 3000,
            "中😀" * 5000, "y" * 300_000]
    rows = [(i, f"http://h/{i}", r.choice(html)) for i in range(60)]
    return rows + [(3, rows[3][1], rows[3][2]), (None, None, "a"), (None, "u\r\nv", "only here"),
                   (70, None, html[-1]), (2, "other", rows[2][2])]


@pytest.mark.parametrize("segment", [64, 5000, 1 << 20])
@pytest.mark.parametrize("least", [0, 10])
def test_archives_give_back_every_page(spark, segment, least):
    pages = spark.createDataFrame(_rows(), PAGES).selectExpr(
        "*", "'x' AS digest", "1 AS size", "2 AS owner").repartition(3)
    if segment == 64:  # thousands of segments: leave the longest out
        pages = pages.filter("html IS NULL OR length(html) < 20000")
    rows = [(r["page_id"], r["url"], r["html"]) for r in pages.collect()]
    found = warc.archive_and_read(pages, segment_bytes=segment, min_revisit_bytes=least,
                                  records_per_file=7)
    assert all(r["complete"] for r in found.collect())
    got = sorted(((r["page_id"], r["payload_bytes"], r["payload_digest"], r["record_type"],
                   r["refers_to"]) for r in found.collect()), key=str)
    assert got == _archived(rows, least)


def test_archives_of_nothing(spark):
    assert warc.archive_and_read(spark.createDataFrame([], PAGES)).count() == 0


def test_archive_files_are_plain_warc(spark, tmp_path):
    pages = spark.createDataFrame([(1, "http://a/", "b" * 50_000), (2, "http://c/", "d")], PAGES)
    warc.write_archives(pages, str(tmp_path / "w"))
    records = [r for f in (tmp_path / "w").glob("part-*")
               for r in warc.parse(gzip.decompress(f.read_bytes()))]
    kinds = sorted(f["WARC-Type"] for f, _ in records)
    assert kinds.count("response") == 2 and kinds.count("continuation") == 3
    last = [f for f, _ in records if "WARC-Segment-Total-Length" in f]
    assert len(last) == 1 and last[0]["WARC-Segment-Number"] == "4"


@settings(max_examples=100, deadline=None)
@given(st.text(st.characters(exclude_categories=["Cs"]), max_size=60), st.integers(1, 9))
def test_chunked_framing_round_trip(text, size):
    assert warc.dechunked(warc.chunked(text.encode(), size)) == text.encode()


def test_broken_segments_are_told():
    block = b"HTTP/1.1 200 OK\r\nTransfer-Encoding: chunked\r\n\r\n" + warc.chunked(b"abc")
    whole = [(2, len(block), block[30:]), (1, None, block[:30])]
    assert warc.reassemble(whole) == b"abc"
    assert warc.reassemble(whole[:1]) is None
    assert warc.reassemble([*whole, whole[1]]) is None
    assert warc.reassemble([(1, None, block[:30]), (2, 9, block[30:])]) is None
    broken = block.replace(b"3\r\nabc", b"9\r\nabc")
    assert warc.reassemble([(1, len(broken), broken)]) is None
