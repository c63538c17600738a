import gzip
import hashlib
import re

import duckdb
import numpy as np
import pytest

from tramspark.llm import html_text, oracles, queries, warc
from tramspark.session import shared_dir

SF = "/root/testdata/sf0.001"
PARA = "The council met on Tuesday to discuss the new tram line, and after a long debate it voted for the northern route. "
SCHEMA = "page_id long, url string, html string, uid int, value string, Salts int"


def pages(spark, rows):
    return spark.createDataFrame([(i, u, h, 3, "v", 1) for i, u, h in rows], SCHEMA)


FULL = f"""<!DOCTYPE html><html><head><title>T</title><style>p{{}}</style><script>var a = "<p>no</p>";</script></head><body>
<header class="top"><a href="/">Home</a> Site name</header><nav><ul><li><a href="/a">One</a></li></ul></nav>
<div class="cookie-notice">We use cookies on this site to make it work better for you and for everybody else too.</div>
<aside>Side text that is quite long and has many words in it, as long as a paragraph could well be.</aside>
<main><article><header><h1>Tram&nbsp;line &amp; council</h1></header><p>{PARA}</p><p>Short.</p>
<div class="ad">Buy this now, it is cheap, it is good, it is here, and it is yours for a small price today.</div>
<p>{PARA}<a href="/x">with a link</a>
 and   &lt;more&gt; text</p><form><label>Mail</label><input><button>Send</button></form>
<ul><li>First point</li><li>Second point</li></ul></article>
<section id="comments"><p>A reader says that this is a very good idea and that it should have been done before.</p></section></main>
<footer>&copy; 2026 All rights</footer></body></html>"""


def test_article_with_all_kinds_of_chrome():
    p = PARA.strip()
    assert html_text.main_text(FULL) == "\n".join(
        ["Tram line & council", p, "Short.", p + " with a link and <more> text", "First point", "Second point"])


def test_page_without_article_markup():
    body = "".join(f"<p>{PARA * k}</p>" for k in (1, 2, 1, 3))
    menu = "<div><ul>" + "".join(f'<li><a href="/{i}">Item {i}</a></li>' for i in range(12)) + "</ul></div>"
    got = html_text.main_text(f"<body>{menu}<div><h2>Head</h2>{body}</div><div>{menu}</div></body>")
    assert got == "\n".join(["Head", *[(PARA * k).strip() for k in (1, 2, 1, 3)]])


MENU = "<div><ul>" + "".join(f'<li><a href="/{i}">Item {i}</a></li>' for i in range(12)) + "</ul></div>"


@pytest.mark.parametrize("tag", ["blockquote", "section", "pre", "div"])
def test_text_around_a_long_block_stays(tag):
    got = html_text.main_text(f"<body>{MENU}<div><h1>Title</h1><p>{'a b c ' * 50}</p><{tag}>{'d e f ' * 233}</{tag}>"
                              f"<p>{'g h i ' * 50}</p></div>{MENU}</body>")
    assert got == "\n".join(["Title", ("a b c " * 50).strip(), ("d e f " * 233).strip(), ("g h i " * 50).strip()])


@pytest.mark.parametrize("sizes", [(500, 480, 510, 490, 505, 25), (25, 500, 480, 510, 490, 505)])
@pytest.mark.parametrize("page", ["<body>{}</body>", "<body>" + MENU + "<div>{}</div>" + MENU + "</body>"])
def test_short_first_and_last_paragraphs_stay(sizes, page):
    paragraphs = [("word " * n)[:n].strip() for n in sizes]
    assert html_text.main_text(page.format("".join(f"<p>{p}</p>" for p in paragraphs))) == "\n".join(paragraphs)


@pytest.mark.parametrize("page", ["<main>{}{}</main>", "<div>{}{}</div>"])
def test_two_articles(page):
    a, b = [PARA.strip()] * 13, [PARA.strip()] * 7
    got = html_text.main_text("<body>" + MENU + page.format(
        *["<article>" + "".join(f"<p>{p}</p>" for p in x) + "</article>" for x in (a, b)]) + MENU + "</body>")
    assert got == "\n".join(a + b)


@pytest.mark.parametrize("body", ["<h1>Title</h1><p>{0}</p><p>{0}</p>", "<article><h1>Title</h1><p>{0}</p><p>{0}</p></article>"])
def test_page_in_one_form(body):
    search = "<form><label>Search this site</label><input><button>Go</button></form>"
    got = html_text.main_text(f"<body>{search}<form runat=server><input>{MENU}<div>{body.format(PARA)}</div><button>Send</button></form></body>")
    assert got == "\n".join(["Title", PARA.strip(), PARA.strip()])


LINE = "thirty characters of real text"
CHINESE = "市议会周二开会讨论新的有轨电车线路经过长时间辩论后投票决定采用北部路线并于明年春天"


@pytest.mark.parametrize("lines", [[f"{LINE} {i}" for i in range(20)], [CHINESE + str(i) for i in range(6)]])
def test_short_lines_in_one_form_are_the_text(lines):
    body = "".join(f"<p>{x}</p>" for x in lines)
    assert html_text.main_text(f"<body><div class=top-bar>Site</div><form runat=server><input type=hidden><div>{body}</div>"
                               "<button>Send</button></form></body>").split("\n")[-len(lines):] == lines
    # a form of labels and controls goes, whatever the length of its lines
    signup = f"<form><p>{PARA}</p><label>Name</label><input><label>Mail</label><input><button>Send</button></form>"
    assert html_text.main_text(f"<body><div>{body}</div>{signup}</body>").split("\n") == lines


@pytest.mark.parametrize("wrap", [
    '<div class="layout has-sidebar"><article>{}</article></div>', '<article class="post comments-open">{}</article>',
    '<article class="post category-advertising">{}</article>', '<div class="menu-open">{}</div>', '<main><div id="no-footer">{}</div></main>',
    '<div class="page-with-ads"><div class="menu-open">{}</div></div>'])
def test_names_that_only_mention_chrome_hide_nothing(wrap):
    body = f"<h1>Title</h1><p>{PARA}</p><div class=sidebar>{PARA * 2}</div><p>{PARA}</p><div class='comment-list'><p>{PARA * 9}</p></div>"
    got = html_text.main_text("<body>" + wrap.format(body) + '<div class="copyright">All rights</div></body>')
    assert got == "\n".join(["Title", PARA.strip(), PARA.strip()])


def test_mentions_hide_small_boxes_beside_an_article():
    page = (f'<body><article><h1>T</h1><p>{PARA * 2}</p></article><div class="sidebar-latest"><p>{PARA * 4}</p></div>'
            f'<article class="comment"><p>{PARA}</p></article><div class="cookie-info"><p>{PARA}</p></div></body>')
    assert html_text.main_text(page) == "T\n" + (PARA * 2).strip()


def test_the_threshold_decides_on_link_lines_inside_the_article(monkeypatch):
    steps = "<div>" + " ".join(f'<a href="/{i}">Part {i}</a>' for i in range(9)) + "</div>"
    page = f"<body><article><h1>T</h1><p>{PARA * 3}</p><p>{PARA * 3}</p>{steps * 3}<p>{PARA * 2}</p><p>{PARA}</p></article></body>"
    want = "\n".join(["T", *[(PARA * k).strip() for k in (3, 3, 2, 1)]])
    assert html_text.main_text(page) == want
    monkeypatch.setattr(html_text, "threshold", lambda values: -1.0)
    assert html_text.main_text(page) != want


def test_header_of_an_article_in_deep_markup():
    deep = "<div>" * 60
    got = html_text.main_text(f"<body><header>Site</header><article>{deep}<header><h1>Title</h1></header><p>{PARA}</p></article></body>")
    assert got == "Title\n" + PARA.strip()


@pytest.mark.parametrize("html,want", [
    (None, ""), ("", ""), ("plain words only", "plain words only"), ("<p>a<p>b", "a\nb"), ("<article><p>x &am", "x &am"),
    ("<script>x</script>", ""), ("<article><p><b>one<br>two<p>three", "one two\nthree"), ("<<<>>>", "<<<>>>"),
    ("<article><p>&#233;&eacute;</p></article>", "éé")])
def test_odd_pages(html, want):
    assert html_text.main_text(html) == want


def test_smoothing_and_threshold():
    v = html_text.smooth(np.r_[np.zeros(10), np.ones(10) * 5, np.zeros(10)])
    assert abs(v.sum() - 50) < 1e-6 and v.argmax() in range(10, 20)
    assert 1 < html_text.threshold(np.array([0.0, 1, 9, 10])) < 9


def test_extract_tables(spark):
    long = "<article>" + f"<p>{PARA}</p>" * 20_000 + "</article>"
    rows = [(1, "u", FULL), (1, "u", FULL), (None, None, None), (3, "x", long), (4, "", "<div>" * 5000 + "deep")]
    got = html_text.extract(pages(spark, rows)).collect()
    assert len(got) == 5
    for r in got:
        assert r["n_chars"] == len(r["text"])
    assert [r["text"] for r in got][3] == "\n".join([PARA.strip()] * 20_000) and got[4]["text"] == "deep"
    assert html_text.extract(pages(spark, [])).count() == 0


def test_op3_gives_the_article_of_every_page(spark):
    """The given pages mark the article; a regular expression over that markup is the second opinion."""
    got = {r["page_id"]: r for r in queries.op3_html_text(spark, SF).collect()}
    rows = spark.read.parquet(f"{SF}/pages.parquet").collect()
    assert len(got) == len(rows)
    from html import unescape
    for r in rows:
        inner = re.search(r"<article>(.*?)(?:</article>|$)", r["html"], re.S)[1]
        blocks = [" ".join(unescape(re.sub(r"<[^>]*>", "", b)).split()) for b in re.split(r"</?(?:p|h1|article)>", inner.replace("<br>", " "))]
        assert got[r["page_id"]]["text"] == "\n".join(b for b in blocks if b), r["page_id"]


def want(rows):
    body = [(i, (h or "").encode()) for i, _, h in rows]
    tops, out, named = {}, [], set()
    for i, b in body:
        tops.setdefault(b, []).append(i)
    for i, b in body:
        top = max((x for x in tops[b] if x is not None), default=None)
        revisit = len(b) >= 1000 and not (i == top and (b not in named))
        if not revisit and len(b) >= 1000:
            named.add(b)
        out.append((str(i), len(b), hashlib.sha1(b).hexdigest(), "revisit" if revisit else "response", str(top if revisit else None)))
    return sorted(out)


def rows_of(df):
    return sorted((str(r["page_id"]), r["payload_bytes"], r["payload_digest"], r["record_type"], str(r["refers_to"])) for r in df.collect())


@pytest.mark.parametrize("compression", ["none", "gzip"])
def test_warc_round_trip(spark, compression):
    big = "ä€🎉 text\r\n\r\nWARC/1.1\r\n" * 4000
    rows = [(1, "http://a", "x" * 1000), (2, "http://b", "x" * 1000), (2, "http://b", "x" * 1000), (3, None, None), (4, "", ""),
            (5, "a b\r\nX: y", big), (6, "u", big), (7, "u", "y" * 999), (8, "u", "y" * 999), (None, "u", "x" * 1000), (9, "u", big + "!")]
    path = shared_dir(spark, "warc-test")
    warc.write_archives(pages(spark, rows), path, segment=5000, compression=compression)
    got = warc.read_archives(spark, path, payloads=True)
    assert rows_of(got) == want(rows)
    bodies = {(i, len((h or "").encode())): (h or "").encode() for i, _, h in rows}
    for r in got.filter("record_type = 'response'").collect():
        assert bytes(r["payload"]) == bodies[r["page_id"], r["payload_bytes"]]


def test_warc_empty(spark):
    path = shared_dir(spark, "warc-test")
    warc.write_archives(pages(spark, []), path)
    assert warc.read_archives(spark, path).count() == 0


def test_framing_comes_in_any_pieces():
    payload = ("ab€" * 3000).encode()
    block = warc.HTTP + warc.chunked(payload, 70)
    for step in (1, 2, 3, 7, 100, 4096, 10**6):
        m = warc.Message(keep=True)
        for s in range(0, len(block), step):
            m.feed(block[s:s + step])
        m.finish(None)
        assert b"".join(m.payload) == payload
    m = warc.Message()
    m.feed(block[:-3])
    with pytest.raises(ValueError):
        m.finish(None)


def test_parser_reads_by_length_and_member():
    records = [b"WARC/1.1\r\nWARC-Type: x\r\nContent-Length: 10\r\n\r\n\r\n\r\nWARC/1", b"WARC/1.1\r\nContent-Length: 0\r\n\r\n"]
    plain = b"".join(r + b"\r\n\r\n" for r in records)
    for data in (plain, gzip.compress(plain), b"".join(gzip.compress(r + b"\r\n\r\n") for r in records)):
        for step in (1, 5, 1000):
            assert [b for _, b in warc.parse(warc.inflate(data, step))] == [b"\r\n\r\nWARC/1", b""]
    with pytest.raises(ValueError):
        list(warc.parse(iter([plain[:-3]])))


@pytest.mark.parametrize("damage,message", [
    (lambda r: [x for x in r if b"Segment-Number: 2" not in x], "segment 2"),
    (lambda r: r[:-1], "last segment"),
    (lambda r: [re.sub(rb"Total-Length: \d+", b"Total-Length: 7", x) for x in r], "instead of 7")])
def test_damaged_segments_fail(spark, damage, message):
    recs = damage(list(warc.records(1, 1, "u", b"z" * 20_000, None, segment=4000)))
    rows = [r.decode() for r in recs]
    path = shared_dir(spark, "warc-test")
    spark.createDataFrame([(r,) for r in rows], "value string").write.option("lineSep", "\r\n\r\n").text(path)
    with pytest.raises(Exception, match=message):
        warc.read_archives(spark, path).collect()


def test_op8_sql(spark):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW pages AS SELECT * FROM read_parquet('{SF}/pages.parquet')")
    got = queries.op8_warc(spark, SF)
    expected = con.execute(f"SELECT {', '.join(got.columns)} FROM ({oracles.OP8})").fetchall()
    assert sorted(map(tuple, got.collect())) == sorted(expected)
