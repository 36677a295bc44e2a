import base64
import gzip
import hashlib
import re
from collections import Counter

import duckdb
import pytest

from coinfold.llm.url_rules import (
    HOST_RULES,
    PATTERN_RULES,
    Index,
    expression,
    host_and_path,
    judge_sql,
    judge_urls,
    tokens,
)
from coinfold.llm.warc import (
    ArcRecord,
    arc_record,
    arc_start,
    archived,
    converted,
    http_block,
    read_arc,
    read_warc,
    warc_date,
)
from coinfold.session import shared_dir
from tests.compare import compare

URLS = [
    "http://net", "http://a.NET/x", "https://b.example.net/en/1", "https://example.net/EN/1", "http://example.net/en", "http://xexample.net/en/",
    "http://www.Example.com/de/1?q=/fr/#x", "http://example.com/d", "http://org/fr/", "https://x.org/fr/a#b", "http://net:80/", "http://u@net/",
    "no scheme", None, "", "://", "a://b", "http://h?x=://net/", "http://h#/", "x http://y.net/z", "http://adult-x.example.org/a",
    "http://adultx.org/", "http://www.adult-education.org/", "https://ads.site.org/", "https://xads.site.org/", "http://site.org/banner/top/ad?x",
    "http://site.org/banner/ad", "http://site.org/wp-login.php", "http://site.org/wp-login.php?x", "http://s.org/?a=1&SESSION_ID=4", "http://s.org/logout", "http://s.org/logouts",
    "http://s.org/apopunderb", "http://casino.x.org/robots.txt", "http://tracker.q.org/a/pixel", "http://tracker.q.org/apixel", "http://ä.net/ü ß\n/x", "http://h/" + "a/" * 30000,
]


def web(spark, rows):
    shape = "page_id long, url string, html string, host string, rule string, id string, digest string"
    return spark.createDataFrame([(*r, "h", "r", "i", "d") for r in rows], shape).repartition(3)


def test_urls_against_every_rule(spark):
    rows = [(k, u, "") for k, u in enumerate(URLS)] + [(0, URLS[0], ""), (None, URLS[2], "")]
    got = judge_urls(web(spark, rows)).collect()
    assert len(got) == len(rows)
    url_of = {k: u for k, u, _ in rows}
    for r in got:
        url = url_of[r.page_id]
        head = (url or "").split("://", 1)
        rest = head[1] if len(head) > 1 else ""
        host = re.split(r"[/?#]", rest)[0]
        path = re.split(r"[?#]", rest[len(host) :])[0]
        host = "".join(c.lower() if c.isascii() else c for c in host)
        fits = [(h + p, v) for v, h, p in HOST_RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
        rule, verdict = max(fits, key=lambda f: len(f[0])) if fits else (None, None)
        low = "".join(c.lower() if c.isascii() else c for c in url or "")
        says = {v for v, p in PATTERN_RULES if re.search(expression(p), low)}
        verdict = verdict or ("allow" if "allow" in says or not says else "block")
        assert (r.host, r.path, r.rule, r.verdict) == (host, path, rule, verdict), url
    assert Counter(r.verdict for r in got)["block"] > 12
    assert judge_urls(web(spark, rows).where("false")).collect() == []


def test_urls_against_sql(spark, tmp_path):
    web(spark, [(k, u, "") for k, u in enumerate(URLS)]).write.parquet(str(tmp_path / "pages"))
    con = duckdb.connect()
    con.execute(f"CREATE VIEW pages AS SELECT * FROM read_parquet('{tmp_path}/pages/*.parquet')")
    assert compare(judge_urls(spark.read.parquet(str(tmp_path / "pages"))), judge_sql(), con)[0] == ""


def test_only_candidates_run():
    ran = []

    class Watched:
        def __init__(self, name):
            self.name = name

        def search(self, url):
            ran.append(self.name)

    index = Index.of((), [("block", "/rare/common/"), ("block", "/common/"), ("block", "*part*")], {"rare": 1, "common": 90})
    index = Index({t: [(v, Watched(t)) for v, _ in r] for t, r in index.by_token.items()}, [("block", Watched("always"))], {})
    assert set(index.by_token) == {"rare", "common"}
    index.by_pattern("http://x/common/y")
    assert ran == ["common", "always"]
    assert tokens("||a.b^c*d|") == ["a", "b"] and tokens("ab") == [] and tokens("|ab.c|") == ["ab", "c"]
    assert host_and_path("x://A.b/C?d") == ("a.b", "/C")


PAYLOADS = ["x" * 1000, "x" * 999, "ü" * 500, "ü" * 499 + "x", "line\r\n\r\nWARC/1.0\r\n\r\n" * 80, "", None, "small", "y" * 200_000]


def test_pages_through_the_archives(spark):
    rows = [(k, f"http://h/{k} a\n b", PAYLOADS[k % len(PAYLOADS)]) for k in range(40)]
    rows += [(50, None, "x" * 1000), (50, None, "x" * 1000), (7, "", "small"), (None, "u", "x" * 1000), (51, "ü://ß", "ü" * 500)]
    got = archived(web(spark, rows)).collect()
    assert len(got) == len(rows)
    most = {}
    for i, _, html in rows:
        if i is not None and len((html or "").encode()) >= 1000:
            most[html] = max(most.get(html, i), i)
    want = Counter()
    firsts = set()
    for i, _, html in rows:
        data = (html or "").encode()
        again = i is not None and html in most and (i != most[html] or html in firsts)
        if i is not None and html in most and i == most[html]:
            firsts.add(html)
        want[(i, len(data), hashlib.sha1(data).hexdigest(), "revisit" if again else "response", most[html] if again else None)] += 1
    assert Counter(map(tuple, got)) == want
    assert archived(web(spark, rows).where("false")).collect() == []


@pytest.mark.parametrize("version", [1, 2])
@pytest.mark.parametrize("packed", [False, True])
def test_legacy_files(version, packed):
    records = [ArcRecord(f"http://h/{k}", "10.0.0.1", "19990102030405", "text/html", http_block(k, b"a\nb\r\n\r\n" * k), version) for k in range(4)]
    records.append(ArcRecord("http://h/with blank", "10.0.0.1", "199901020304", "text/html", b"HTTP/1.0 404 No\r\n\r\n", version))
    content = b"".join(x + b"\n" for x in [arc_start("f.arc", version), *(arc_record(r, "f.arc", 0) for r in records)])
    content = gzip.compress(content[:200]) + gzip.compress(content[200:]) if packed else content
    assert list(read_arc(content)) == records
    made = b"".join(converted(r, "part-00001", k, None) + b"\r\n\r\n" for k, r in enumerate(records))
    back = list(read_warc(gzip.compress(made) if packed else made))
    assert [b for _, b in back] == [r.block for r in records]
    for (fields, _), record in zip(back, records, strict=True):
        payload = record.block.split(b"\r\n\r\n", 1)[1]
        assert fields["warc-payload-digest"] == "sha1:" + base64.b32encode(hashlib.sha1(payload).digest()).decode()
        assert fields["warc-date"] == warc_date(record.date) and fields["warc-target-uri"] == record.url
    assert len({f["warc-record-id"] for f, _ in back}) == len(records)


def test_records_are_what_they_hold():
    page = b"<html>\n\nx</html>"
    cases = [
        ("http://h/1", "text/html", b"HTTP/1.0 200 OK\nContent-Type: text/html\n\n" + page, ("response", "application/http; msgtype=response"), page),
        ("http://h/2", "text/html", b"HTTP/1.0 200 OK\r\nA: b\n\r\n" + page, ("response", "application/http; msgtype=response"), page),
        ("http://h/3", "text/html", b"HTTP/1.1 204 No Content\r\nX: y", ("response", "application/http; msgtype=response"), b""),
        ("dns:h", "text/dns", b"19990102030405\nh. 10 IN A 10.0.0.1\n", ("response", "text/dns"), b"19990102030405\nh. 10 IN A 10.0.0.1\n"),
        ("ftp://h/f", "image/gif", b"GIF89a\r\n\r\n", ("resource", "image/gif"), b"GIF89a\r\n\r\n"),
        ("http://h/4", "no-type", page, ("resource", "application/octet-stream"), page),
    ]
    for url, kind, block, (type_, content), payload in cases:
        record = ArcRecord(url, "10.0.0.1", "19990102030405", kind, block, 1)
        ((fields, back),) = read_warc(converted(record, "part-00000", 0, None) + b"\r\n\r\n")
        sha1 = lambda data: "sha1:" + base64.b32encode(hashlib.sha1(data).digest()).decode()
        assert (fields["warc-type"], fields["content-type"]) == (type_, content) and back == block
        assert fields["warc-payload-digest"] == sha1(payload) and fields["warc-block-digest"] == sha1(block)


@pytest.mark.parametrize("damage", [b"junk", b"filedesc://x 0 1 t 9\n", b"filedesc://x 0 1 text/plain 4\n3 0\n\nx"])
def test_damage_is_told(damage):
    with pytest.raises(ValueError):
        list(read_arc(damage))


def test_shared_folder(spark):
    assert shared_dir(spark, "a") != shared_dir(spark, "a")
