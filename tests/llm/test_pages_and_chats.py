"""ARC and WARC, url rules and chats."""

import base64
import gzip
import hashlib

import pytest
from pyspark.sql import functions as F

from lakerecon.llm import arc, chat, url_filter


def arc_v1(records):
    block = b"1 0 Archive\nURL IP-address Archive-date Content-type Archive-length\n"
    out = b"filedesc://old.arc 1.2.3.4 19990102030405 text/plain %d\n" % len(block) + block + b"\n"
    return out + b"".join(b"%s 1.2.3.4 %s text/html %d\n%s\n" % (u, d, len(c), c) for u, d, c in records)


def arc_v2(records):
    block = b"2 0 Archive\nURL IP-address Archive-date Content-type Result-code Checksum Location Offset Filename Archive-length\n"
    out = b"filedesc://new.arc 1.2.3.4 19990102030405 text/plain 200 - - 0 new.arc %d\n" % len(block) + block + b"\n"
    return out + b"".join(b"%s 1.2.3.4 %s text/html 200 - - 0 new.arc %d\n%s\n" % (u, d, len(c), c) for u, d, c in records)


HTTP = b"HTTP/1.0 200 OK\r\nContent-Type: text/html\r\n\r\n"
#: The payload looks like a header line and a WARC record, to show that lengths are believed and not texts.
TRICKY = b"http://x 1.2.3.4 20000101000000 text/html 5\nhello\r\n\r\nWARC/1.1\r\n"
RECORDS = [(b"http://a/", b"20010203040506", HTTP + TRICKY), (b"http://b/", b"200102030405", HTTP), (b"dns:c", b"bad", b"10.0.0.1\n"), (b"http://d/", b"20020203040506", HTTP + TRICKY)]


def sha(data):
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


@pytest.mark.parametrize("make", [arc_v1, arc_v2])
@pytest.mark.parametrize("pack", [bytes, gzip.compress, lambda x: b"".join(gzip.compress(x[i : i + 100]) for i in range(0, len(x), 100))])
def test_arc_records(make, pack):
    found = list(arc.parse_arc("old.arc", pack(make(RECORDS))))
    assert [r["type"] for r in found] == ["warcinfo", "response", "response", "resource", "response"]
    assert [r["payload"] for r in found[1:]] == [TRICKY, b"", b"10.0.0.1\n", TRICKY]
    assert [r["date"] for r in found[1:]] == ["2001-02-03T04:05:06Z", "2001-02-03T04:05:00Z", "1970-01-01T00:00:00Z", "2002-02-03T04:05:06Z"]
    assert found[1]["payload_digest"] == sha(TRICKY) and len({r["record_id"] for r in found}) == 5


def test_broken_archives_keep_their_rest():
    whole = arc_v1(RECORDS)
    cut = list(arc.parse_arc("x.arc", whole[:-20]))
    assert cut[-1]["type"] == "error" and cut[-1]["payload"] and len(cut) == 5
    assert [r["type"] for r in arc.parse_arc("x.arc", b"nonsense")] == ["error"] and not list(arc.parse_arc("x.arc", b""))


def test_round_trip(spark, folder):
    archives = spark.createDataFrame(
        [("one.arc", arc_v1(RECORDS)), ("two.arc.gz", gzip.compress(arc_v2(RECORDS))), ("empty.arc", b""), (None, None)], "path string, content binary"
    )
    arc.convert(archives, F.col("date"), f"{folder}/warc")
    found = arc.read_warc(spark, f"{folder}/warc").collect()
    assert len(found) == 10 and len({r.record_id for r in found}) == 10
    kinds = sorted(r.type for r in found)
    assert kinds == ["resource"] * 2 + ["response"] * 2 + ["revisit"] * 4 + ["warcinfo"] * 2
    by_id = {r.record_id: r for r in found}
    for r in found:
        if r.type == "revisit":
            first = by_id[r.refers_to]
            assert first.type == "response" and first.payload_digest == r.payload_digest and first.payload_bytes == r.payload_bytes and r.payload is None
            assert r.head == HTTP
        elif r.type == "response":
            assert r.payload_digest == sha(r.payload) and r.head == HTTP
    assert {bytes(r.payload) for r in found if r.type == "response"} == {TRICKY, b""}
    (some,) = [r for r in found if r.type == "response" and r.payload]
    assert some.url == "http://d/" and some.date == "2002-02-03T04:05:06Z"


def test_packing_bounds_archives_and_makes_fields_safe(spark):
    rows = spark.createDataFrame([(f"http://a/{i} x\n", None, "text/html", bytes([i]) * 400) for i in range(50)], "url string, date string, content_type string, body binary")
    for version in (1, 2):
        packed = arc.pack(rows.coalesce(1), "p", version, size=2_000)
        assert 8 <= packed.count() <= 13
        found = arc.records(packed).filter("type <> 'warcinfo'").collect()
        assert len(found) == 50 and {r.url for r in found} == {f"http://a/{i}%20x%0A" for i in range(50)} and {bytes(r.payload) for r in found} == {bytes([i]) * 400 for i in range(50)}


RULES = [("com", "/", "allow"), ("example.com", "/en/", "block"), ("a.b.com", "", "block"), ("b.com", "/x", "block"), ("b.com", "/x", "allow"), ("c.com", "/pa/th", "block"), (None, "/", "block")]
URLS = [
    "https://www.EXAMPLE.com/en/x?q=1", "http://example.com/en", "http://badexample.com/en/", "http://a.b.com", "http://a.b.com?x", "http://z.b.com/xyz", "http://c.com/pa/thology",
    "http://c.com/pa/", "ftp://other.net/en/", "no url", "", None, "http://c.com//pa", "x://y://example.com/en/", "http://example.com./en/",
]


def plain_verdict(url):
    rest = url.split("://", 1)[1] if url and "://" in url else ""
    head = rest.split("#")[0].split("?")[0]
    host, _, path = head.partition("/")
    host, path = "".join(c.lower() if c < "\x80" else c for c in host), ("/" + path if "/" in head else "")
    fits = [(len(h) + len(p), len(h), v == "block", h + p, v) for h, p, v in RULES if h and (host == h or host.endswith("." + h)) and path.startswith(p)]
    best = max(fits, default=None)
    return host, path, best and best[3], best[4] if best else "allow"


def test_urls_against_every_rule(spark):
    pages = spark.createDataFrame([(i, u, "h") for i, u in enumerate(URLS + URLS[:3])] + [(None, URLS[0], "h")], "page_id long, url string, host string")
    rules = spark.createDataFrame(RULES, "host string, path string, verdict string")
    got = url_filter.judge(pages, rules).collect()
    assert sorted(map(repr, [tuple(r) for r in got])) == sorted(map(repr, [(p, *plain_verdict(u)) for p, u, _ in pages.collect()]))


def test_urls_without_rules_or_pages(spark):
    rules = spark.createDataFrame([], "host string, path string, verdict string")
    pages = spark.createDataFrame([(1, "http://a/b")], "page_id long, url string")
    assert [tuple(r) for r in url_filter.judge(pages, rules, default="block").collect()] == [(1, "a", "/b", None, "block")]
    assert url_filter.judge(pages.limit(0), rules).count() == 0


def test_long_urls_cost_no_more_than_the_deepest_rule(spark):
    rules = spark.createDataFrame([("x.org", "/a/b/c", "block"), ("y.x.org", "/", "allow")], "host string, path string, verdict string")
    deep, wide = "/a/b/" + "c/" * 100_000, "w." * 20_000 + "x.org"
    urls = [f"http://x.org{deep}", f"http://x.org/b{deep}", f"http://{wide}/a/b/c", f"http://{wide}/a/b", "http://x.org/a/b/cd", "http://v.y.x.org" + deep]
    assert url_filter.depth(rules) == (3, 3) and url_filter.depth(rules.limit(0)) == (1, 0)
    pages = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")
    got = {r.page_id: (r.rule, r.verdict) for r in url_filter.judge(pages, rules).collect()}
    block = ("x.org/a/b/c", "block")
    assert got == {0: block, 1: (None, "allow"), 2: block, 3: (None, "allow"), 4: block, 5: block}


def plain_rotation(rows, perspective):
    text, spans = "", []
    for turn, role, said in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] or "unknown", r[2] or "")):
        role = role or "unknown"
        kind = "assistant" if role == perspective else "system" if role == "system" else f"user name={role}"
        text += f"<|im_start|>{kind}\n"
        if role == perspective:
            spans.append((len(text), len(text) + len(said or "") + len("<|im_end|>")))
        text += (said or "") + "<|im_end|>\n"
    return text, spans


def test_every_participant_is_assistant_once(spark):
    rows = [(1, 0, "system", "be kind"), (1, 1, "ann", "hello é"), (1, 2, "bob", None), (1, 2, "cy", "tie"), (1, 3, None, "who"), (1, 1, "ann", "hello é"), (2, 0, "system", "alone"), (3, None, "bob", "x"), (None, 0, "ann", "y")]
    turns = spark.createDataFrame([(*r, 9) for r in rows], "conv_id long, turn long, role string, text string, block int")
    got = {(r.conv_id, r.perspective): r for r in chat.rotate(turns).collect()}
    assert set(got) == {(1, "ann"), (1, "bob"), (1, "cy"), (1, "unknown"), (3, "bob"), (None, "ann")}
    for (conv, who), r in got.items():
        text, spans = plain_rotation([x[1:] for x in rows if x[0] == conv], who)
        assert r.text == text and [tuple(s) for s in r.spans] == spans
        assert all(text[a:b].endswith("<|im_end|>") for a, b in spans) and [m.train for m in r.messages].count(True) == len(spans)
    assert chat.rotate(turns.limit(0)).count() == 0


def test_long_dialogues_come_out_whole_in_bounded_rows(spark):
    turns = spark.range(1000).selectExpr("1 AS conv_id", "id AS turn", "IF(id % 2 = 0, 'a', 'b c') AS role", "concat('m', id) AS text")
    turns = turns.union(spark.range(300).selectExpr("1", "5", "'a'", "'again'"))
    found = chat.rotate(turns, block=100, most=150).collect()
    for who in ("a", "b c"):
        mine = [r for r in found if r.perspective == who]
        assert sum(len(r.messages) for r in mine) == 1300 and max(len(r.messages) for r in mine) <= 150 and len(mine) == 12
        assert sum(m.train for r in mine for m in r.messages) == (800 if who == "a" else 500)
    assert "user name=b_c" in found[0].text or "user name=a" in found[0].text
