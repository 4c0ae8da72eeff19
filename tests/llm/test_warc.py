import gzip
import html as html_lib
import random
import time
import zlib
from html.parser import HTMLParser

import pytest

from isobar.llm import warc

PAGE = ("<!DOCTYPE html><html lang='fr'><head><title>A &amp; B</title><script>var x='</p>';</script></head><body>"
        "<!-- no --><h1>Un</h1><p>deux <b>trois</b>&nbsp;quatre</p><a href=\"/x?a>b\">lien</a><br/>fin &lt;ok&gt;</body></html>")


def test_plain_text():
    assert warc.plain_text(PAGE) == "Un\ndeux trois quatre\nlien\nfin <ok>"
    assert warc.plain_text("") == "" and warc.plain_text("1 < 2 > 0") == "1 < 2 > 0"


def test_records_are_linked_and_keep_the_source(spark):
    pages = spark.createDataFrame([(1, "http://h/a", PAGE, 5), (2, None, None, 6), (None, "u", "", 7),
                                   (1, "http://h/a", PAGE, 5)], "page_id long, url string, html string, block int")
    source = {r.record_id: r for r in warc.responses(pages).collect()}
    rows = warc.derivatives(pages).collect()
    assert len(rows) == 8 and len(source) == 3
    for r in rows:
        s = source[r.refers_to]
        assert (r.target_uri, r.refers_to_date, r.source_headers) == (s.target_uri, s.date, s.http_headers)
        assert (r.source_payload_digest, r.source_block_digest) == (s.payload_digest, s.block_digest)
        assert r.content_length == len(r.block.encode()) and r.block_digest == warc.digest(r.block.encode())
        twin = [x for x in rows if x.record_id == r.concurrent_to]
        assert twin and twin[0].warc_type != r.warc_type and twin[0].refers_to == r.refers_to
    meta = next(r for r in rows if r.warc_type == "metadata" and r.page_id == 1)
    assert "title: A & B\r\n" in meta.block and "language: fr\r\n" in meta.block and "outlinks: 1\r\n" in meta.block
    assert warc.derivatives(pages.filter("false")).count() == 0


def test_carried_columns_of_clashing_names(spark):
    from pyspark.sql import functions as F

    found = warc.responses(spark.createDataFrame([(1, "u", PAGE)], "page_id long, url string, html string"))
    rows = warc.derive(found.withColumns({"block": F.lit("mine"), "warc_type": F.lit(3), "rows": F.lit(1)})).collect()
    assert [(r.in_block, r.in_warc_type, r.rows, r.page_id) for r in rows] == [("mine", 3, 1, 1)] * 2


def test_files_round_trip(spark, workdir):
    """Responses written to an archive, read, derived and written again."""
    pages = spark.read.parquet("/root/testdata/sf0.001/pages.parquet")
    want = {r.record_id: r for r in warc.responses(pages).collect()}
    files = [b"", b""]
    for i, r in enumerate(want.values()):
        block = r.http_headers.encode() + b"\r\n\r\n" + bytes(r.payload)
        record = warc.encode([("WARC-Type", "response"), ("WARC-Record-ID", r.record_id), ("WARC-Date", r.date),
                              ("WARC-Target-URI", r.target_uri), ("Content-Length", str(len(block)))], block)
        files[i % 2] += gzip.compress(record) if i % 2 else record
    files[0] += warc.encode([("WARC-Type", "request"), ("Content-Length", "3")], b"GET") + b"WARC/1.1\r\ncut off"
    for name, data in zip(("a.warc", "b.warc.gz"), files):
        with open(f"{workdir}/{name}", "wb") as f:
            f.write(data)
    found = warc.read_warc(spark, workdir)
    assert {r.record_id: tuple(r) for r in found.collect()} == {
        k: tuple(r[1:]) for k, r in want.items()}
    derived = warc.derive(found)
    direct = warc.derivatives(pages)
    assert sorted(r.record_id for r in derived.collect()) == sorted(r.record_id for r in direct.collect())
    data = b"".join(bytes(r.member) for r in warc.members(derived).collect())
    again = list(warc.records(data))
    blocks = {r.record_id: bytes(r.block) for r in derived.collect()}
    assert {h["warc-record-id"]: b for h, b in again} == blocks
    assert all(h["warc-refers-to"] in want for h, _ in again)


def test_damaged_archives():
    good = warc.encode([("Content-Length", "2"), ("X", "a"), (" folded", "b")], b"ab")
    bad_length = b"WARC/1.1\r\nContent-Length: x\r\n\r\n"

    def read(data):
        return [x if isinstance(x, int) else x[1] for x in warc.records(data)]

    assert read(good + good) == [b"ab", b"ab"]
    assert read(good + good[:-5]) == [b"ab", len(good) - 5] and read(good[:-4]) == [b"ab"]
    assert read(b"") == [] and read(b"garbage") == [7]
    assert read(bad_length) == [len(bad_length)]
    assert read(good + b"junk" + good + bad_length + good) == [b"ab", 4, b"ab", len(bad_length), b"ab"]
    assert read(b"WARC/1.1\r\n" * 3 + good) == [10, 10, 10, b"ab"]
    packed = gzip.compress(good)
    assert read(packed + packed) == [b"ab", b"ab"]
    assert read(packed + packed[:10]) == [b"ab", 10]
    assert read(packed + b"junk" + packed) == [b"ab", 4, b"ab"]
    broken = bytearray(packed)
    broken[len(packed) // 2] ^= 255
    assert read(bytes(broken) + packed)[-1] == b"ab"
    assert warc.charset("Content-Type: text/html; charset=latin-1") == "latin-1"
    assert warc.charset("content-type: text/html; charset=nonsense") == "utf-8"


def test_damage_is_counted_and_reading_goes_on(spark, workdir):
    block = b"HTTP/1.1 200 OK\r\nContent-Type: text/html\r\n\r\n<p>hi</p>"
    one = warc.encode([("WARC-Type", "response"), ("WARC-Record-ID", "<r>"), ("Content-Length", str(len(block)))], block)
    with open(f"{workdir}/a.warc", "wb") as f:
        f.write(one + b"\0" * 7 + one * 3)
    assert warc.read_warc(spark, workdir).count() == 4
    assert [tuple(r)[1:] for r in warc.damage(spark, workdir).collect()] == [(4, 1, 7)]


def chunked(body, n=7):
    return b"".join(b"%x;x=1\r\n%s\r\n" % (len(body[i:i + n]), body[i:i + n]) for i in range(0, len(body), n)) + b"0\r\n\r\n"


def deflated(body):
    c = zlib.compressobj(wbits=-15)
    return c.compress(body) + c.flush()


BODY = "<p>gr\u00fc\u00dfe an alle</p>".encode()


@pytest.mark.parametrize("headers, payload, text", [
    ("Transfer-Encoding: chunked", chunked(BODY), "gr\u00fc\u00dfe an alle"),
    ("Content-Encoding: gzip", gzip.compress(BODY), "gr\u00fc\u00dfe an alle"),
    ("content-encoding: GZIP\r\ntransfer-encoding: chunked", chunked(gzip.compress(BODY)), "gr\u00fc\u00dfe an alle"),
    ("Content-Encoding: deflate", zlib.compress(BODY), "gr\u00fc\u00dfe an alle"),
    ("Content-Encoding: deflate", deflated(BODY), "gr\u00fc\u00dfe an alle"),
    ("Content-Encoding: deflate, gzip", gzip.compress(zlib.compress(BODY)), "gr\u00fc\u00dfe an alle"),
    ("Content-Encoding: gzip", BODY, "gr\u00fc\u00dfe an alle"),  # stored unpacked, header kept
    ("Transfer-Encoding: chunked", BODY, "gr\u00fc\u00dfe an alle"),
    ("Transfer-Encoding: chunked", chunked(b"<p>1234</p>", 20)[:-7], "1234"),  # broken off
    ("Content-Encoding: identity", BODY, "gr\u00fc\u00dfe an alle"),
    ("Content-Encoding: br", b"\x0b\x02\x80", ""),
])
def test_encoded_payloads(spark, headers, payload, text):
    head = "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n" + headers
    row = ("<r>", "http://h/", "d", head, payload, "sha1:B", warc.digest(payload))
    rows = {r.warc_type: r for r in warc.derive(spark.createDataFrame([row], warc.RESPONSE)).collect()}
    assert bytes(rows["conversion"].block).decode() == text
    assert rows["conversion"].source_payload_digest == warc.digest(payload)
    assert ("encoding-unread: br" in bytes(rows["metadata"].block).decode()) == ("br" in headers.split())


OPENERS = ["<!--", "<script ", "<a ", "<a href='", '<a "', "<p ", "</", "<", "<svg>", "<title ", "<title>", "<html ",
           "<html lang ", "<a href=", "<a '\" ", "&", "<head ", "</script ", "<a \"'>' "]


@pytest.mark.parametrize("opener", OPENERS)
def test_pages_of_unclosed_openers_take_linear_time(opener):
    for page in (opener * (10_000_000 // len(opener)), opener * (2_000_000 // len(opener)) + "'"):
        t0 = time.process_time()
        warc.plain_text(page), warc.title(page), warc.language(page), warc.links(page)
        assert time.process_time() - t0 < 40


class Shown(HTMLParser):
    """Text outside of hidden elements by the standard library's parser."""
    HIDDEN = {"script", "style", "noscript", "template", "svg", "head"}
    LINE = set("address article aside blockquote br dd div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 "
               "header hr li main nav ol p pre section table tbody td tfoot th thead title tr ul".split())

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.out, self.inside = [], 0

    def handle_starttag(self, tag, attrs):
        if tag in self.HIDDEN:
            self.out.append(" ")
            self.inside += 1
        elif tag in self.LINE and not self.inside:
            self.out.append("\n")

    def handle_endtag(self, tag):
        if tag in self.HIDDEN:
            self.inside -= 1
        elif tag in self.LINE and not self.inside:
            self.out.append("\n")

    def handle_startendtag(self, tag, attrs):
        if tag in self.LINE and not self.inside:
            self.out.append("\n")

    def handle_comment(self, data):
        self.out.append(" " if not self.inside else "")

    def handle_data(self, data):
        if not self.inside:
            self.out.append(data)


def shown(page):
    p = Shown()
    p.feed(page)
    p.close()
    lines = (" ".join(x.split()) for x in "".join(p.out).split("\n"))
    return "\n".join(x for x in lines if x)


def made_page(rng):
    """Well-formed nested markup with attributes, comments, scripts and character references."""
    def words():
        return " ".join(html_lib.escape(rng.choice(["one", "a<b", "x & y", "\u00e9t\u00e9", "2 > 1", "\u00a0", "fin"]))
                        for _ in range(rng.randint(0, 4)))

    def node(depth):
        kind = rng.randint(0, 7)
        if depth == 0 or kind == 0:
            return words()
        inner = "".join(node(depth - 1) for _ in range(rng.randint(0, 3)))
        if kind == 1:
            return "<!-- " + words() + " <p> -->"
        if kind == 2:
            return f"<{(t := rng.choice(['script', 'style']))} type='x>y'>var a = '<p>';</{t}>"
        if kind == 3:
            return rng.choice(["<br>", "<br/>", "<hr class=\"a>b\">", "<img alt='>'>"])
        tag = rng.choice(["p", "div", "span", "b", "LI", "a", "td", "h2"])
        attr = rng.choice(["", " class='a'", ' title="x > y"', " href=/x?y", " data-x='\"'"])
        return f"<{tag}{attr}>{inner}</{tag}>"

    return "".join(node(4) for _ in range(4))


def test_plain_text_against_the_standard_parser():
    rng = random.Random(4)
    for _ in range(400):
        page = made_page(rng)
        assert warc.plain_text(page) == shown(page), page


def test_plain_text_of_the_test_pages(spark):
    pages = [r.html for r in spark.read.parquet("/root/testdata/sf0.001/pages.parquet").collect() if r.html]
    same = sum(warc.plain_text(p) == shown(p) for p in pages)
    assert same >= 0.9 * len(pages)
