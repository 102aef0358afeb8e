"""Hand-written pages in markup that the operator never makes or learns from, with the text that a reader would call the article."""

from collections import Counter

import pytest

from rigspark.llm.webtext import fit, main_text

#: (page, main blocks). No page holds an article or main tag.
PAGES = {
    "blog": (
        """<html><head><title>Growing beans - A small garden</title><style>p{margin:0}</style></head><body class="home post-template">
<div id="masthead"><a href="/">A small garden</a><ul class="menu"><li><a href="/about">About</a><li><a href="/seeds">Seeds</a><li><a href="/contact">Contact</a></ul></div>
<div class="hentry"><h1 class="entry-title">Growing beans on a balcony</h1><div class="entry-meta">Posted in <a href="/c/veg">Vegetables</a></div>
<div class="entry-content"><p>Beans need very little room, and a pot of ten litres is enough for three plants if you water them every morning.</p>
<p>When the first leaves have opened, tie each stem to a thin stick so that the wind cannot break it during the night.</p>
<ul><li>Sow the beans two centimetres deep after the last frost.</li><li>Keep the soil moist but never wet for long.</li></ul>
<p>After about eight weeks the pods are as long as a finger, and that is the time to pick them.</p></div></div>
<div id="secondary" class="widget-area"><h3>Recent posts</h3><ul><li><a href="/1">Compost in a box</a><li><a href="/2">Slugs again</a></ul><h3>Archives</h3><ul><li><a href="/m">May</a></ul></div>
<div id="comments"><h3>2 responses</h3><div class="comment">Mine died after the rain, any ideas what I did wrong?</div><div class="comment">Great post, thanks!</div></div>
<div id="colophon">Powered by leaves. All rights reserved.</div></body></html>""",
        ["Growing beans on a balcony", "Beans need very little room, and a pot of ten litres is enough for three plants if you water them every morning.", "When the first leaves have opened, tie each stem to a thin stick so that the wind cannot break it during the night.", "Sow the beans two centimetres deep after the last frost.", "Keep the soil moist but never wet for long.", "After about eight weeks the pods are as long as a finger, and that is the time to pick them."],
    ),
    "tables": (
        """<html><body bgcolor=white><table width=100%><tr><td colspan=2><font size=5>Valley Herald</font></td></tr><tr><td width=150><a href=a>Local</a><br><a href=b>Sport</a><br><a href=c>Weather</a></td>
<td><h2>Bridge closed until the autumn</h2><p>The old bridge over the river will stay closed until October, the council said after a meeting that lasted most of the evening.</p>
<p>Engineers had found cracks in two of the pillars, which were built more than ninety years ago and have not been repaired since the flood.</p>
<p>Until the work is finished, buses will take the road along the mill and need about twelve minutes more for the whole way.</p></td></tr>
<tr><td colspan=2><center>Copyright Valley Herald | <a href=i>Imprint</a> | <a href=p>Privacy</a></center></td></tr></table></body></html>""",
        ["Bridge closed until the autumn", "The old bridge over the river will stay closed until October, the council said after a meeting that lasted most of the evening.", "Engineers had found cracks in two of the pillars, which were built more than ninety years ago and have not been repaired since the flood.", "Until the work is finished, buses will take the road along the mill and need about twelve minutes more for the whole way."],
    ),
    "manual": (
        """<!doctype html><body><div class="topbar"><form><input><button>Search</button></form><a href="/login">Sign in</a></div><div class="layout"><div class="toc"><a href="#1">Install</a><a href="#2">Configure</a><a href="#3">Upgrade</a></div>
<div class="doc"><h1>Configure the server</h1><p>The server reads its settings once, when it starts, from a file that lies beside the program.</p><pre>port = 8080</pre>
<p>A setting that is given twice takes the value of the later line, and a setting that is not known stops the server with an error.</p><h2>Where the log goes</h2><p>All messages are written to the standard output unless a folder for them is named in the settings.</p></div></div>
<div class="cookie-banner">We use cookies to make this site better. <button>Accept</button></div><div class="foot"><a href="/t">Terms</a> <a href="/s">Status</a></div></body>""",
        ["Configure the server", "The server reads its settings once, when it starts, from a file that lies beside the program.", "port = 8080", "A setting that is given twice takes the value of the later line, and a setting that is not known stops the server with an error.", "Where the log goes", "All messages are written to the standard output unless a folder for them is named in the settings."],
    ),
    "shop": (
        """<body><div role="navigation"><a href=1>Kitchen</a> <a href=2>Garden</a> <a href=3>Sale</a></div><section class="story"><h1>How we make our knives</h1>
<div class="par">Every blade begins as a bar of steel that is heated in the oven and beaten by two people, one on each side of the anvil.</div>
<div class="par">It is then cooled in oil for a minute, ground on a wet stone, and left alone for a week before it gets its handle.</div></section>
<div class="promo"><b>Today only: free delivery!</b> <a href=buy>Buy now</a></div><div class="related"><h4>You may also like</h4><a href=4>Boards</a><a href=5>Stones</a></div><div class="newsletter">Join our list <form><input></form></div></body>""",
        ["How we make our knives", "Every blade begins as a bar of steel that is heated in the oven and beaten by two people, one on each side of the anvil.", "It is then cooled in oil for a minute, ground on a wet stone, and left alone for a week before it gets its handle."],
    ),
}


def shares(got: str, want: list[str]) -> tuple[int, int, int]:
    a, b = Counter(got.split()), Counter(" ".join(want).split())
    return sum((a & b).values()), sum(a.values()), sum(b.values())


@pytest.mark.parametrize("trained", [True, False])
def test_words_of_foreign_pages(spark, trained):
    pages = spark.read.parquet("/root/testdata/sf0.001/pages.parquet")
    model = fit(pages if trained else pages.filter("false"))
    each = {name: shares(main_text(model, html), want) for name, (html, want) in PAGES.items()}
    both, got, want = (sum(s[i] for s in each.values()) for i in range(3))
    assert both > 0.9 * got and both > 0.9 * want, each
