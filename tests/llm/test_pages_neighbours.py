"""Page extraction and neighbour search against plain versions."""

import html
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from duelspark.llm import neighbours, pages
from llm_fixtures import run  # noqa: F401 - fixture


def test_main_text_is_the_article(run, spark):
    got = run("op7_main_text").set_index("page_id")
    for r in spark.read.parquet(f"{SF_SMALL}/pages.parquet").collect():
        body = re.search(r"<article>(.*?)</article>", r["html"], re.S)[1]
        body = re.sub(r"</?(?:b|i)>", "", body)
        want = re.sub(r"[ \t-\r]+", " ", html.unescape(re.sub(r"<[^>]*>", " ", body))).strip(" ")
        assert got.loc[r["page_id"], "text"] == want
        assert got.loc[r["page_id"], "n_chars"] == len(want) and got.loc[r["page_id"], "url"] == r["url"]


@pytest.mark.parametrize("page,main,runs", [
    ("<nav>Menu</nav><article><h1>T &amp; t</h1><p>a<b>b</b> c<br>d<aside>no</aside>"
     "<div class='comments'>x</div></article><footer>f</footer>", "T & t ab c d",
     [("frame", "Menu"), ("frame", "no"), ("frame", "x"), ("frame", "f")]),
    ("<p>one<p>two<script>var a='</p>'</script><!-- x --><style>p{}</style>", None, [("plain", "one"), ("plain", "two")]),
    ("<div id=cookie-notice>eat</div><div class=story>text &lt;b&gt;</div>", None,
     [("frame", "eat"), ("plain", "text <b>")]),
    ("<article><div class=\"ad\">buy</article>after", "", [("frame", "buy"), ("plain", "after")]),
    ("<main>m<form>q</form>n</main", "m n", [("frame", "q")]), ("", None, []), ("< 3 & 4 <5", None, None)])
def test_split_page(page, main, runs):
    got = pages.split_page(page)
    assert got[0] == main and (runs is None or got[1] == runs)


def plain_covered(runs, least):
    """{run: set of covered positions} from all pairs; ``runs``: {run text: pages}."""
    out = {r: set() for r in runs}
    for r, n in runs.items():
        t = r.split(" ")
        if len(t) < least:
            if n > 1:
                out[r] = set(range(len(t)))
            continue
        for i in range(len(t) - least + 1):
            gram = t[i:i + least]
            others = any(q != r and any(u[j:j + least] == gram for j in range(len(u) - least + 1))
                         for q in runs for u in [q.split(" ")])
            if n > 1 or others:
                out[r] |= set(range(i, i + least))
    return out


@pytest.mark.parametrize("per_group", [pages.PER_GROUP, 3])
def test_repeated_matches_plain(spark, per_group):
    rng = np.random.default_rng(2)
    texts = {" ".join(rng.choice(list("abc"), rng.integers(1, 30))): int(rng.integers(1, 3)) for _ in range(60)}
    rows = [("h", pages.run_id(t), t, n) for t, n in texts.items()] + [("other", pages.run_id("a b"), "a b", 1)]
    df = spark.createDataFrame(rows, "host string, run binary, text string, n_pages long")
    got = {bytes(r["run"]): r for r in pages.uncovered(df, pages.repeated(df, 4, per_group)).where("host = 'h'").collect()}
    for t, gone in plain_covered(texts, 4).items():
        r = got[pages.run_id(t)]
        assert r["covered"] == len(gone)
        assert r["rest"] == " ".join(x for i, x in enumerate(t.split(" ")) if i not in gone)


def test_one_very_frequent_substring(spark):
    texts = ["ha " * 30000 + "end", "so " + "ha " * 9 + "stop"]
    df = spark.createDataFrame([("h", pages.run_id(t), t, 1) for t in texts],
                               "host string, run binary, text string, n_pages long")
    got = {bytes(r["run"]): r["rest"] for r in pages.uncovered(df, pages.repeated(df, 8, 64)).collect()}
    assert [got[pages.run_id(t)] for t in texts] == ["end", "so stop"]


def test_boilerplate_without_article(spark):
    shared = "all rights reserved by the owners of this fine site forever"
    rows = [(i, f"http://h.org/{i}", f"<div>{shared}</div><div>story number {i} is told here</div>") for i in range(4)]
    rows += [(9, None, None), (10, "http://[bad", ""), (9, None, None), (None, "http://x.org", f"<p>{shared}</p>")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("text", F.lit("clash"))
    got = pages.main_text(df).toPandas()
    assert len(got) == 8
    texts = dict(zip(got["url"], got["text"]))
    assert texts["http://h.org/2"] == "story number 2 is told here" and texts["http://x.org"] == shared
    assert got[got["page_id"] == 9]["text"].tolist() == ["", ""]
    assert pages.main_text(df.where("false")).count() == 0


def test_empty_container_and_self_closing_elements(spark):
    rows = [(1, "http://h.org/1", "<main></main><div>the story stands beside its container</div>"),
            (2, "http://h.org/2", "<script src='a.js'/><article>kept <svg viewBox=\"0 0 1 1\"/>words</article>"),
            (3, "http://h.org/3", "<title/><p>one <iframe src=x /> two</p>"),
            (4, "http://h.org/4", "<main>inside</main><div>outside</div>")]
    got = pages.main_text(spark.createDataFrame(rows, "page_id long, url string, html string")).toPandas()
    assert dict(zip(got["page_id"], got["text"])) == {1: "the story stands beside its container", 2: "kept words",
                                                      3: "one two", 4: "inside"}


@pytest.mark.parametrize("per_group", [pages.PER_GROUP, 3])
def test_repeats_within_one_page_are_content(spark, per_group):
    rng = np.random.default_rng(5)
    runs = {" ".join(rng.choice(list("abc"), rng.integers(4, 20))): set(rng.integers(0, 4, rng.integers(1, 3)).tolist())
            for _ in range(25)}
    rows = [("h", pages.run_id(t), t, len(p), min(p), max(p)) for t, p in runs.items()]
    df = spark.createDataFrame(rows, "host string, run binary, text string, n_pages long, first_page long, last_page long")
    got = {bytes(r["run"]): r["rest"] for r in pages.uncovered(df, pages.repeated(df, 4, per_group)).collect()}
    where = {}
    for t, p in runs.items():
        w = t.split(" ")
        for i in range(len(w) - 3):
            where.setdefault(tuple(w[i:i + 4]), set()).update(p)
    for t in runs:
        w = t.split(" ")
        gone = {j for i in range(len(w) - 3) if len(where[tuple(w[i:i + 4])]) > 1 for j in range(i, i + 4)}
        assert got[pages.run_id(t)] == " ".join(x for i, x in enumerate(w) if i not in gone)


def test_refrain_and_copied_page_keep_their_text(spark):
    refrain = "and so the river went on down to the sea"
    song = f"<p>first verse {refrain}</p><p>second verse {refrain}</p>"
    rows = [(1, "http://s.org/1", song), (2, "http://c.org/a", song), (3, "http://c.org/b", song)]
    got = pages.main_text(spark.createDataFrame(rows, "page_id long, url string, html string")).toPandas()
    assert (got["text"] == f"first verse {refrain} second verse {refrain}").all() and (got["n_boilerplate"] == 0).all()


def plain_search(ids, x, wanted, k):
    for q in wanted:
        s = (x * x[ids == q][0]).sum(axis=1)
        order = [i for i in np.lexsort((ids, -s)) if ids[i] != q][:k]
        yield q, ids[order].tolist(), s[order]


def test_search_recall_and_scores(run, spark):
    e = spark.read.parquet(f"{SF_SMALL}/embeddings.parquet").toPandas()
    ids, x = e["vec_id"].to_numpy(), np.stack(e["embedding"].to_numpy()).astype(np.float64)
    got = run("op2_neighbours").sort_values(["query_id", "rank"])
    by = dict(list(got.groupby("query_id")))
    hits = total = 0
    for q, want, _ in plain_search(ids, x, ids[ids % 20 == 0], 20):
        g = by[q]
        assert list(g["rank"]) == list(range(1, 21)) and q not in set(g["vec_id"])
        hits, total = hits + len(set(g["vec_id"]) & set(want)), total + 20
        exact = [(x[ids == q][0] * x[ids == v][0]).sum() for v in g["vec_id"]]
        assert np.allclose(g["score"], exact, rtol=0, atol=1e-12)
        assert list(zip(-g["score"], g["vec_id"])) == sorted(zip(-g["score"], g["vec_id"]))
    assert hits / total >= 0.9


def test_exact_search_with_ties_and_odd_rows(spark):
    rng = np.random.default_rng(0)
    rows = [(i, [float(v) for v in rng.integers(-2, 3, 4)]) for i in range(300)]
    rows += [(1000 + i, [1.0, 1.0, 0.0, 2.0]) for i in range(60)] + [(5000, None), (5001, []), (5002, [0.0] * 4),
            (5003, [float("nan"), 1.0, 0.0, 0.0]), (5004, [1.0, None, 0.0, 0.0]), (5005, [1.0, 2.0]), (None, [1.0] * 4)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").withColumn("score", F.lit("clash"))
    p = neighbours.Params(block=50)
    got = neighbours.exact_search(df, F.col("vec_id") % 20 == 0, p).toPandas().sort_values(["query_id", "rank"])
    good = [(i, v) for i, v in rows if i is not None and i < 5000 and any(v)]
    ids, x = np.array([i for i, _ in good]), np.array([v for _, v in good])
    want = {q: v for q, v, _ in plain_search(ids, x, ids[ids % 20 == 0], 20)}
    assert {q: g["vec_id"].tolist() for q, g in got.groupby("query_id")} == want
    small = neighbours.Params(block=50, query_block=3)  # groups bounded on the query side too
    again = neighbours.exact_search(df, F.col("vec_id") % 20 == 0, small).toPandas().sort_values(["query_id", "rank"])
    assert again.values.tolist() == got.values.tolist()
    few = neighbours.search(df.where("vec_id < 5"), F.col("vec_id") >= 0, p).toPandas()
    assert few.groupby("query_id").size().max() == few["query_id"].nunique() - 1
    assert neighbours.search(df.where("false"), F.col("vec_id") >= 0).count() == 0


def test_parts_grow_with_the_table():
    sized = [neighbours.sized(neighbours.Params(), n) for n in (0, 1 << 20, 1 << 21, 1 << 40)]
    assert [(p.parts, p.sample) for p in sized] == [(16, 4000), (16, 4000), (32, 4000), (128, 8192)]
