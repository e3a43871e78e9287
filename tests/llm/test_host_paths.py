from __future__ import annotations

import pytest

from cartwise.llm import host_paths as H

LONG = "A sentence of the article that is long enough to count as running text."
JUNK = "Subscribe to our letters now, it costs nothing and you can leave whenever you like to."


def page(body, head=""):
    return f"<!DOCTYPE html><html><head><title>t</title>{head}</head><body>{body}</body></html>"


@pytest.mark.parametrize(
    ("html", "text"),
    [
        (None, ""),
        ("", ""),
        ("plain text", "plain text"),
        ("a &lt;b&gt; &amp;amp; &#233;&nbsp; \n c", "a <b> &amp; é c"),
        ("<p>one<p>two <b>bold<br>line</b><div>three</div>four", "one\ntwo bold line\nthree\nfour"),
        ("<p>a<!-- <p>no --> b</p><script>if (a < b) '</p>'</script><style>p{}</style>", "a b"),
        ("<p>kept</p><!-- never closed <p>lost</p>", "kept"),
        ("<p>1 < 2 and 3<4 </p>", "1 < 2 and 3<4"),
        ('<a title="x > y">z</a>', "z"),
        ('<p>kept</p><a href="no end>q</a><p>too</p>', "kept\nq\ntoo"),
        ("<table><tr><td>1<td>2<tr><td>3</table>", "1\n2\n3"),
        ("<ul><li>a<li>b<ul><li>c</ul></ul>", "a\nb\nc"),
        ("</div></p><p>x</section>y", "xy"),
        ("<div hidden>a</div><div style='display: none'>b</div><div aria-hidden=true>c</div><p>d", "d"),
        ("<P>Upper</P><SCRIPT>x</SCRIPT>", "Upper"),
    ],
)
def test_blocks(html, text):
    assert H.extract(html, []) == text


def test_everything_but_the_article_goes():
    body = (
        "<header><h1>Site</h1></header><nav><ul><li><a href=/>Home</a></ul></nav>"
        f"<div class='cookie-notice'><p>{JUNK}</p></div>"
        f"<main><article><header><h1>Title</h1><p class=byline>by someone</p></header><p>{LONG}</p>"
        f"<div class='ad-slot'><p>{JUNK}</p></div><ul><li>first<li>second</ul><p>Last.</p>"
        "<ul><li><a href=1>More</a><li><a href=2>of</a><li><a href=3>this</a></ul>"
        f"<footer>tags</footer></article></main><section id=comments><p>{JUNK}</p><p>{JUNK}</p></section>"
        f"<aside><p>{JUNK}</p></aside><form><p>{JUNK}</p></form><div role=dialog><p>{JUNK}</p></div>"
        "<footer>&copy;</footer>"
    )
    assert H.extract(page(body, "<style>p{}</style>"), []) == f"Title\n{LONG}\nfirst\nsecond\nLast."


def test_paths_are_generalised():
    found = H.blocks(page(f"<div class='post-12 entry'><p>{LONG}</p></div><div id=part3><p>x</p></div>"))
    assert [b.path for b in found] == ["/div.entry.post-#", "/div.#part#"]


def test_names():
    skipped = ("sidebar-left", "main-sidebar", "adBox", "post-comments", "share", "site-footer")
    kept = ("has-sidebar", "no-ads", "post-content comments-open", "shadow", "download", "content-with-ad wrapper", "leading")
    assert all(H.left_out("div", {"class": c}) for c in skipped)
    assert not any(H.left_out("div", {"class": c}) for c in kept)
    assert not H.left_out("body", {"class": "sidebar"}) and not H.left_out("article", {"class": "widget"})


SCHEMA = "page_id long, url string, html string, text string, host string, winners int, salt int, votes string"


def test_host_decides_where_a_page_cannot(spark):
    """On a short page a longer text beside the article wins alone, but the host's other pages know better."""
    box = f"<div class=x><p>{JUNK} {JUNK}</p></div>"
    rows = [(i, f"http://A.example/{i}", page(f"<div class=t{i}><p>{LONG * 5}</p></div>{box}")) for i in range(8)]
    short = page(f"<div class=t99><p>{LONG}</p></div>{box}")
    rows += [(8, "https://a.example:80/s", short), (9, "http://b.example/", short), (10, None, short)]
    rows += [(11, "http://a.example/e", page("<div class=t3><p>Short.</p></div><div>Other</div>")), (11, "u", None)]
    found = H.main_text(spark.createDataFrame([(*r, *[None] * 5) for r in rows], SCHEMA).repartition(4))
    assert found.columns == ["page_id", "url", "text", "n_chars"]
    got = {(r["page_id"], r["url"]): r["text"] for r in found.collect()}
    assert len(got) == len(rows)
    assert all(got[r[0], r[1]] == LONG * 5 for r in rows[:8])
    assert got[8, "https://a.example:80/s"] == LONG
    assert got[9, "http://b.example/"] == got[10, None] == f"{JUNK} {JUNK}"
    assert got[11, "http://a.example/e"] == "Short." and got[11, "u"] == ""
    assert all(r["n_chars"] == len(r["text"]) for r in found.collect())


def test_join_beyond_the_broadcast_limit_gives_the_same(spark):
    rows = [(i, f"http://{'a' if i % 3 else i}.example/", page(f"<div class=t{i}><p>{LONG * (i + 1)}</p></div>")) for i in range(30)]
    pages = spark.createDataFrame([(*r, *[None] * 5) for r in rows], SCHEMA)
    before = sorted(map(tuple, H.main_text(pages).collect()))
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        assert sorted(map(tuple, H.main_text(pages).collect())) == before
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)


def test_empty_table(spark):
    assert H.main_text(spark.createDataFrame([], SCHEMA)).collect() == []


def test_votes_of_a_host_count_in_spark(spark):
    rows = [(i, "http://a.b/", page(f"<{t}><p>{LONG}</p></{t}>"), *[None] * 5) for i, t in enumerate(["main"] * 30 + ["article"] * 9 + ["section"])]
    pages = spark.createDataFrame(rows, SCHEMA).withColumn("host", H.host("url"))
    (found,) = H.host_winners(pages.select("page_id", "url", "html", "host")).collect()
    assert [(w["path"], w["votes"]) for w in found["winners"]] == [("/main", 30), ("/article", 9)]
