"""Page containers, frame parts and hosts that the given tables do not have."""

import pytest
from pyspark.sql import functions as F

from duelspark.llm import pages, urllist

BODY = "<p>First words of it.</p><p>Second <big>H</big>ell<acronym>o</acronym> words.</p>"
TEXT = "First words of it. Second Hello words."


@pytest.mark.parametrize("page", [
    f'<div class="layout no-sidebar"><article>{BODY}</article></div>',
    f'<div id="page" class="has-header"><main>{BODY}</main></div>',
    f'<div class="page sidebar"><article>{BODY}</article></div>',
    f'<div class="content-with-sidebar"><nav>Menu</nav><article class="post">{BODY}</article></div>',
    f'<main>{BODY}<article class="related">Other</article></main>',
    f'<article>{BODY}<li class="comment"><article class="comment-body">Me too</article></li></article>',
    f'<article>{BODY}</article><article class="comment">Me too, and at length, far longer than the text itself is.</article>',
    f'<article>{BODY}<p class="advert">Buy</p><blockquote class="ad">Buy</blockquote><ul><li class="share">Share</ul></article>',
    f'<article>{BODY}<h4 class="related">More</h4><div style="display: none">x</div><span hidden></span></article>',
    f'<article><p class="ad">Buy{BODY}</article>',
    f'<aside><article>Teaser teaser teaser teaser teaser</article></aside><article>{BODY}</article>',
    f'<article>Teaser</article><article>{BODY}</article>',
    f'<body class="home sidebar"><div role="main">{BODY}</div></body>',
])
def test_container_is_found(page):
    assert pages.split_page(page)[0] == TEXT


def test_unclosed_parts():
    assert pages.split_page(f"<article><header><h1>Title</h1>{BODY}</article>")[0] == "Title " + TEXT
    assert pages.split_page(f"<article><header>Title</header>{BODY}")[0] == TEXT
    assert pages.split_page("<main><header>Only</header></main><p>Plain one</p><p>two") == \
        ("", [("frame", "Only"), ("plain", "Plain one"), ("plain", "two")])
    assert pages.split_page("<p>no container") == (None, [("plain", "no container")])
    assert pages.split_page("") == (None, [])


def test_hosts(spark):
    urls = {"https://user:pw@evil.com/": "evil.com", "https://evil.com./x": "evil.com", "HTTP://A.Evil.COM:80": "a.evil.com",
            "https://[2001:DB8::1]:443/": "[2001:db8::1]", "https://u@[::1]": "[::1]", "https://a@b@c.org?x@y": "c.org",
            "https://ok.org/@user": "ok.org", "ftp://x..": "x", "https://": None, "mailto:a@b.c": None, "//x.org": None,
            None: None}
    df = spark.createDataFrame([(u,) for u in urls], "url string")
    assert {r["url"]: r["h"] for r in df.select("url", urllist.host(F.col("url")).alias("h")).collect()} == urls
