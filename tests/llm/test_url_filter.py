import xxhash

from salesprep.llm import url_filter
from salesprep.llm.queries import URL_RULES

FIELDS = "host string, path string, verdict string"


def plain(url, rules):
    """Host, path, rule and verdict, rule by rule."""
    rest = url.split("://", 1)[1] if url and "://" in url else ""
    cut = min([rest.index(c) for c in "/?#" if c in rest], default=len(rest))
    host = "".join(c.lower() if "A" <= c <= "Z" else c for c in rest[:cut])
    path = rest[cut:]
    path = path[: min([path.index(c) for c in "?#" if c in path], default=len(path))]
    fits = [(len(h + p), len(h), h + p, v) for h, p, v in rules if (host == h or host.endswith("." + h)) and path.startswith(p)]
    best = max(fits, default=None)
    return host, path, best[2] if best else None, best[3] if best else "allow"


URLS = [
    "https://a.example.org/es/x",
    "http://EXAMPLE.org/en/1?q=/fr/",
    "http://example.org/en/2",
    "http://b.com/de/",
    "http://notcom/de/",
    "http://b.com/fr",
    "http://b.com#/fr/",
    "http://org",
    "http://org/",
    "ftp://x.org?y",
    "no scheme/org/",
    "://",
    "",
    None,
    "http://ÄB.Com/de/ü\nz#f",
    "http://b.com/de/" + "x" * 200_000,
]


def judged(spark, urls, rules, segment_rows=1_000_000):
    pages = spark.createDataFrame([(i, u, "?", "?") for i, u in enumerate(urls)], "page_id long, url string, host string, verdict string")
    index = url_filter.build_index(spark.createDataFrame(rules, FIELDS), segment_rows)
    return {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in url_filter.judge(pages, index, keep=["page_id"]).collect()}


def test_equals_rule_by_rule(spark):
    want = {i: plain(u, URL_RULES) for i, u in enumerate(URLS)}
    assert judged(spark, URLS, list(URL_RULES)) == want
    assert judged(spark, URLS, list(URL_RULES), segment_rows=1) == want


def test_block_wins_and_null_rules_are_left_out(spark):
    rules = [("x.de", "/", "allow"), ("X.DE", "/", "block"), (None, "/", "block"), ("y.de", None, "block"), ("z.de", "/", None)]
    found = judged(spark, ["http://x.de/", "http://y.de/", "http://z.de/"], rules)
    assert [found[i][3] for i in range(3)] == ["block", "allow", "allow"]


def test_no_rules_and_no_pages(spark):
    assert judged(spark, ["http://x.de/"], [])[0] == ("x.de", "/", None, "allow")
    assert judged(spark, [], list(URL_RULES)) == {}


def test_equal_digests_are_told_apart(tmp_path):
    class Row:
        def __init__(self, digest, host, path, blocks):
            self.digest, self.host, self.path, self.blocks = digest, host, path, blocks

    digest = xxhash.xxh64_intdigest(b"b.de/", 42)
    digest -= (digest >> 63) << 64
    file = tmp_path / "segment"
    file.write_bytes(url_filter.pack([Row(digest, "a.de", "/", 1), Row(digest, "b.de", "/", 0)]))
    import numpy as np

    found = list(url_filter.Segment(str(file)).probe(np.array([digest]), [b"b.de/"], [4]))
    assert found == [(0, False)]
