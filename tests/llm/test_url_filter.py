import re
from collections import Counter

import brute
import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from logloom.llm import url_filter
from logloom.llm.queries import BLOCKED_HOSTS, QUERIES, URL_RULES
from logloom.llm.url_filter import ALLOW, BLOCK, as_entries, judge_urls


def lowered(text):
    return re.sub("[A-Z]", lambda m: m.group().lower(), text)


def cut(url):
    _, mark, rest = (url or "").partition("://")
    if not mark:
        return "", ""
    host = re.split("[/?#]", rest, maxsplit=1)[0]
    return lowered(host), re.split("[?#]", rest[len(host):], maxsplit=1)[0]


def plain(url, rules, blocked, default=ALLOW):
    host, path = cut(url)

    def fits(entry):
        h, slash, p = entry.partition("/")
        h, p = lowered(h), slash + p
        return h and (host == h or host.endswith("." + h)) and path.startswith(p)

    best = max(((len((e[:e.find("/")] + e[e.find("/"):]).encode()), len(e.partition("/")[0].encode()), v == ALLOW, e, v)
                for e, v in rules if fits(e)), default=None)
    if best:
        return host, path, lowered(best[3].partition("/")[0]) + best[3][best[3].find("/"):], best[4]
    return host, path, None, BLOCK if any(map(fits, blocked)) else default


def judged(spark, urls, rules, blocked, **more):
    table = spark.createDataFrame([(n, u, "h", "v") for n, u in enumerate(urls)], "page_id bigint, url string, host string, verdict string")
    listed = as_entries(spark, [(b, BLOCK) for b in blocked]) if blocked else None
    found = judge_urls(table.repartition(3), as_entries(spark, rules) if rules else as_entries(spark, [("/", ALLOW)]), listed, **more)
    assert found.columns == ["page_id", "url", "host", "path", "rule", "listed", "verdict"]
    rows = sorted(found.collect())
    assert [r["page_id"] for r in rows] == list(range(len(urls)))
    return [(r["host"], r["path"], r["rule"], r["verdict"]) for r in rows]


URLS = [
    None, "", "no mark", "://", ":///", "http://", "http://ORG/", "http://example.org", "http://example.org/", "http://example.org?x=/es/",
    "http://a.Example.ORG/es/x", "http://example.org/en/1", "http://example.org/en/12?q", "http://xexample.org/es/", "http://com/fr/",
    "http://x.com/de/#f", "http://x.com/de", "http://x.com/fr/a?b", "http://.com/de/", "http://a..com/de/", "http://example.org/ES/",
    "http://u:p@x.com:80/de/", "http://x.com:80/de/", "first://one.org/x://two.com/de/", "http://é.org/ü", "http://É.org/\nes/",
    "http://m.ads-track.example.com/en/1", "http://ads-track.example.com", "http://ads-track.example.com/fr/", "a\nb://x.org/\n",
    "http://" + "a." * 3000 + "org/" + "p/" * 5000, "http://x.com/de/", "http://x.com/de/",
]


def test_odd_urls(spark):
    assert judged(spark, URLS, URL_RULES, BLOCKED_HOSTS) == [plain(u, URL_RULES, BLOCKED_HOSTS) for u in URLS]


def test_pages(spark):
    pages = brute.read("pages")
    got = {r["page_id"]: tuple(r)[1:] for r in QUERIES["op12_url_filters"](spark, "/root/testdata/sf0.01").collect()}
    assert got == {i: plain(u, URL_RULES, BLOCKED_HOSTS) for i, u in zip(pages.page_id, pages.url)}
    assert len(Counter((v[2], v[3]) for v in got.values())) >= 5


def test_many_entries_in_pieces(spark):
    rng = np.random.default_rng(3)
    names = [f"h{n}.{t}" for n in range(40) for t in ("com", "org", "co.uk")] + ["uk", "h1.h2.org", "é.fr"]
    paths = ["/", "/a", "/a/", "/a/b", "/ü/"]
    pick = lambda: names[rng.integers(len(names))] + paths[rng.integers(len(paths))]
    rules = [(pick(), [ALLOW, BLOCK][rng.integers(2)]) for _ in range(150)]
    blocked = [pick() for _ in range(150)]
    urls = [f"http://{['', 'www.', 'x.y.'][rng.integers(3)]}{pick()}{['', 'a/b', '/b'][rng.integers(3)]}" for _ in range(800)]
    assert judged(spark, urls, rules, blocked, piece=20) == [plain(u, rules, blocked) for u in urls]
    assert judged(spark, urls, [], blocked, default=BLOCK) == [plain(u, [], blocked, BLOCK) for u in urls]


def test_no_entries_and_no_urls(spark):
    assert judged(spark, URLS[:9], [], []) == [plain(u, [], []) for u in URLS[:9]]
    none = spark.createDataFrame([], "page_id bigint, url string")
    assert judge_urls(none, as_entries(spark, URL_RULES)).count() == 0


def test_colliding_digests_are_told_apart(tmp_path, monkeypatch):
    """Three entries under one digest: each key finds its own string or nothing."""
    keys = [b"aone.org/", b"btwo.org/", b"cone.org/"]
    (tmp_path / "p.digests").write_bytes(np.array([5, 7, 7, 7, 9], "<u8").tobytes())
    records = [b"ax.org/", *keys, b"by.org/"]
    (tmp_path / "p.ends").write_bytes(np.cumsum([len(r) for r in records]).astype("<u8").tobytes())
    (tmp_path / "p.strings").write_bytes(b"".join(records))
    monkeypatch.setattr(url_filter.SparkFiles, "get", lambda name: str(tmp_path / name))
    reader = url_filter.Reader(url_filter.Piece("p", 5, 5))
    asked = [(7, b"one.org/"), (7, b"three.org/"), (7, b"two.org/"), (8, b"x.org/"), (10, b"x.org/"), (5, b"x.org/")]
    found = list(reader.find(np.array([d for d, _ in asked], np.uint64), lambda n: asked[n][1]))
    assert found == [(0, b"a", b"one.org/"), (0, b"c", b"one.org/"), (2, b"b", b"two.org/"), (5, b"a", b"x.org/")]


def test_digests_are_xxh64(spark):
    for text in ("org/", "example.org/en/1", "é" * 50):
        assert spark.range(1).select(F.xxhash64(F.lit(text).cast("binary"))).first()[0] % (1 << 64) == xxhash.xxh64_intdigest(text.encode(), 42)


@pytest.mark.parametrize("entry", ["/x", "a/b", "org"])
def test_entries(spark, entry):
    row = as_entries(spark, [(entry, BLOCK)]).first()
    assert (row["host"], row["path"]) == (entry.partition("/")[0], "/" + entry.partition("/")[2])
