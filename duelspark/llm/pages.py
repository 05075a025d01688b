"""Main text of web pages: page structure plus a suffix array of every host's token streams.

1. A page is cut at its tags into the text inside its main container (every main or role=main element,
   else the longest article; a class on a wrapper does not hide the container), without the parts
   in it that are menus, headers, footers, sidebars, notices, adverts, forms, comments or hidden by
   tag, role, style or a word of their class or id, and runs of text outside it: "frame" runs, which lie in such
   parts, and "plain" runs, one for each block.
2. The runs are the token streams of their host. Equal runs of a host are counted once, with the
   number of pages that show them. Every suffix of a run goes to the group of its first
   ``least`` tokens (so a host of any size is dealt over many groups, and all suffixes that share
   a substring of that length still meet; a very frequent substring is counted and dealt by run over
   several groups); a group sorts its suffixes and compares neighbours.
   A substring of ``least`` tokens or more that occurs on two distinct pages (not twice on one;
   pages with the same plain runs throughout are copies and count as one) is boilerplate, and
   the tokens that such substrings cover are taken out; a run shorter than that is boilerplate
   if the whole run repeats.
3. A page with a main container gives that container's text, whole: repeated passages inside an
   article are its content. Any other page, also one whose container is empty, gives the tokens of its plain runs that no repeated
   substring covers, in page order.

``n_boilerplate`` counts a page's covered tokens outside its main text. Character references are
decoded; white space becomes one space; blocks are joined by one space. Edge cases: null html is
empty; an empty page has empty text; a null url is a host of its own; repeated rows of one id
count as one page and all get its text; an empty table gives an empty result.
"""

from __future__ import annotations

import html as entities
import re
from urllib.parse import urlsplit

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialize, parts, pieces

LEAST = 8
PER_GROUP = 4096

TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)"
    r"""|<(?:script|style|noscript|template|iframe|svg|textarea|select|object|title)(?:\s(?:[^<>"']|"[^"]*"|'[^']*')*)?/>"""
    r"|<(script|style|noscript|template|iframe|svg|textarea|select|object|title)(?=[\s/>]).*?(?:</\1\s*>|\Z)"
    r"""|<(?P<end>/?)(?P<name>[a-zA-Z][\w:-]*)(?P<attrs>(?:[^<>"']|"[^"]*"|'[^']*')*)>"""
    r"|<[!?/][^>]*(?:>|\Z)|</?[a-zA-Z][^>]*(?:>|\Z)", re.I | re.S)
ATTR = re.compile(r"""([\w:-]+)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?""")
MARKS = set("""ad ads advert adverts advertisement advertising banner sponsor sponsored promo promoted promotion sidebar menu
navbar nav navigation breadcrumb breadcrumbs cookie cookies consent notice alert popup modal overlay comment comments replies
respond share sharing social related recommended newsletter subscribe signup login footer header masthead widget""".split())
UNMARKED = {"no", "has", "with", "without", "hide"}  # a class no-sidebar or has-header names the page's layout
ROLES = {"navigation", "banner", "contentinfo", "complementary", "search", "dialog", "alert", "form", "menu"}
FRAME = {"nav", "header", "footer", "aside", "form", "menu", "dialog", "button", "head", "fieldset"}
MAIN = {"article", "main"}
HOLDERS = FRAME | MAIN | {"div", "section", "ul", "ol", "dl", "table", "figure", "details", "body", "html", "p"}
OPTIONAL_END = {"p", "li", "dt", "dd", "tr", "td", "th"}
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
INLINE = {"a", "abbr", "acronym", "b", "bdi", "bdo", "big", "cite", "code", "data", "del", "dfn", "em", "font", "i", "ins", "kbd", "mark",
          "q", "s", "samp", "small", "span", "strike", "strong", "sub", "sup", "time", "tt", "u", "var", "wbr"}
SPACE = re.compile(r"[\x20\x09-\x0D]+")


def attributes(raw: str) -> dict[str, str]:
    return {k.lower(): (v or "").strip("\"'") for k, v in ATTR.findall(raw)} if raw.strip(" /") else {}


def marked(attrs: dict[str, str]) -> bool:
    """Whether a class or the id names a menu, header, footer, sidebar, notice, advert, comment or the like."""
    for name in f"{attrs.get('class', '')} {attrs.get('id', '')}".lower().split():
        pieces_ = set(re.split(r"[_-]+", name))
        if pieces_ & MARKS and not pieces_ & UNMARKED:
            return True
    return False


def hidden(attrs: dict[str, str]) -> bool:
    style = attrs.get("style", "").replace(" ", "").lower()
    return "hidden" in attrs or attrs.get("aria-hidden") == "true" or "display:none" in style or "visibility:hidden" in style


class Outline:
    """The page's texts, each with the frame parts and the container that it lies in."""

    def __init__(self):
        self.texts: list[tuple[str, bool, tuple[int, ...], int]] = []  # text, at a block's edge, frame parts, container
        self.open: list[tuple[str, int, bool]] = []  # name, its number as a frame part or -1, whether it is a container
        self.frames: list[tuple[int, bool]] = []     # per frame part: containers before it, whether a class alone makes it one
        self.containers: list[tuple[str, tuple[int, ...]]] = []  # main or article, the frame parts around it
        self.unclosed: set[int] = set()
        self.around: tuple[int, ...] = ()
        self.inside = -1

    def put(self, text: str, edge: bool = False):
        self.texts.append((text, edge, self.around, self.inside))

    def enter(self, name: str, attrs: dict[str, str]):
        role = attrs.get("role", "").lower()
        by_class = name not in {"main", "body", "html"} and marked(attrs)
        by_tag = name in FRAME or role in ROLES or hidden(attrs)
        frame, container = -1, False
        if by_tag or by_class:
            frame = len(self.frames)
            self.frames.append((len(self.containers), not by_tag))
            self.around += (frame,)
        elif (name in MAIN or role == "main") and self.inside < 0:
            container, self.inside = True, len(self.containers)
            self.containers.append(("article" if name == "article" and role != "main" else "main", self.around))
        self.open.append((name, frame, container))

    def leave(self, unclosed: bool = False):
        _, frame, container = self.open.pop()
        if frame >= 0:
            self.around = self.around[:-1]
            if unclosed and not self.frames[frame][1]:
                self.unclosed.add(frame)
        if container:
            self.inside = -1

    def shown(self, around: tuple[int, ...]) -> bool:
        """Not inside a frame part; an element that is one by its tag but was never closed frames nothing."""
        return all(f in self.unclosed for f in around)

    def chosen(self) -> set[int]:
        """Every main element, else the longest article; a part that only its class makes a frame does
        not hide the container inside it unless there is another one."""
        of_tag = [all(f in self.unclosed or self.frames[f][1] for f in around) for _, around in self.containers]
        mains = {i for i, (kind, _) in enumerate(self.containers) if kind == "main" and of_tag[i]}
        if mains:
            return mains
        articles = [i for i in range(len(self.containers)) if of_tag[i]]
        articles = [i for i in articles if self.shown(self.containers[i][1])] or articles
        size = {i: 0 for i in articles}
        for text, _, _, inside in self.texts:
            if inside in size:
                size[inside] += len(text)
        return {max(articles, key=lambda i: (size[i], -i))} if articles else set()


def outline(page: str) -> Outline:
    out, at = Outline(), 0
    for m in TOKEN.finditer(page):
        if m.start() > at:
            out.put(entities.unescape(page[at:m.start()]))
        at = m.end()
        name = (m["name"] or "").lower()
        if not name or name in INLINE:
            continue
        if name == "br":
            out.put(" ")
            continue
        out.put(" ", edge=True)
        if name in VOID:
            continue
        if m["end"]:
            if any(x[0] == name for x in out.open):
                while out.open[-1][0] != name:
                    out.leave(unclosed=True)
                out.leave()
        else:
            if out.open and (out.open[-1][0] == "p" or (out.open[-1][0] == name and name in OPTIONAL_END)):
                out.leave()  # an end tag that may be left out
            attrs = attributes(m["attrs"])
            if (name in HOLDERS and name != "p") or hidden(attrs) or marked(attrs) or attrs.get("role"):
                out.enter(name, attrs)
                if m["attrs"].endswith("/"):
                    out.leave()
        out.put(" ", edge=True)
    if at < len(page):
        out.put(entities.unescape(page[at:]))
    while out.open:
        out.leave(unclosed=True)
    return out


def split_page(page: str) -> tuple[str | None, list[tuple[str, str]]]:
    """The main container's text (None without such a container) and the runs outside it, each
    ("frame" or "plain", text)."""
    out = outline(page)
    chosen = out.chosen()
    main: list[str] = []
    runs, current, kind = [], [], "plain"

    def close_run():
        text = SPACE.sub(" ", "".join(current)).strip(" ")
        if text:
            runs.append((kind, text))
        current.clear()

    for text, edge, around, inside in out.texts:
        own = tuple(f for f in around if out.frames[f][0] > inside) if inside in chosen else around
        if inside in chosen and out.shown(own):
            close_run()
            main.append(text)
            continue
        now = "plain" if out.shown(around) else "frame"
        if now != kind:
            close_run()
            kind = now
        if edge and kind == "plain":
            close_run()  # a plain run is one block, so that boilerplate does not reach into its neighbour
        current.append(text)
    close_run()
    return SPACE.sub(" ", "".join(main)).strip(" ") if chosen else None, runs


def host_of(url: str | None) -> str:
    try:
        return (urlsplit(url).hostname or "") if url else ""
    except ValueError:
        return ""


def run_id(text: str) -> bytes:
    return xxhash.xxh3_128_digest(text)


def page_runs(pages: DataFrame) -> DataFrame:
    """(page, host, kind, at, run, text, copy) of every run outside the main container; beside a container
    with text, all of them are frame. ``copy``: the page, but the same for pages whose text is the same
    plain runs."""
    def cut(batches):
        for b in pieces(batches, 200):
            out = []
            for key, url, page in zip(b["_page"].to_pylist(), b["url"].to_pylist(), b["html"].to_pylist()):
                main, runs = split_page(page or "")
                plain = [] if main else [run_id(t) for k, t in runs if k == "plain"]
                copy = xxhash.xxh64_intdigest(b"".join(plain)) - (1 << 63) if plain else key
                out += [(key, host_of(url), "frame" if main else k, i, run_id(t), t, copy)
                        for i, (k, t) in enumerate(runs)]
            cols = list(zip(*out)) if out else [()] * 7
            yield pa.record_batch([pa.array(c, t) for c, t in zip(cols, (
                pa.int64(), pa.string(), pa.string(), pa.int32(), pa.binary(), pa.string(), pa.int64()))],
                names=["_page", "host", "kind", "at", "run", "text", "copy"])

    return pages.mapInArrow(cut, "_page long, host string, kind string, at int, run binary, text string, copy long")


def suffixes(tokens: list[str], least: int) -> list[tuple[int, str]]:
    """(position, its first 2 * least tokens); a short run is one suffix, closed by an end mark."""
    if len(tokens) < least:
        return [(0, " ".join(tokens) + " \x00")]
    return [(i, " ".join(tokens[i:i + 2 * least])) for i in range(len(tokens) - least + 1)]


def shared_length(a: str, b: str) -> int:
    n = 0
    for x, y in zip(a.split(" "), b.split(" ")):
        if x != y:
            break
        n += 1
    return n


def repeated(runs: DataFrame, least: int = LEAST, per_group: int = PER_GROUP) -> DataFrame:
    """(host, run, from, to): token spans of runs that occur on at least two pages of the host.
    ``runs``: (host, run, text, n_pages), one row per distinct run of a host, and first_page, last_page,
    its least and greatest page; without these, every run is on pages of its own."""
    if "first_page" not in runs.columns:
        runs = runs.withColumn("first_page", F.xxhash64("run")).withColumn("last_page", F.col("first_page"))

    def explode(batches):
        for b in pieces(batches, 500):
            out = []
            for host, run, text, n, lo, hi in zip(*(b[c].to_pylist() for c in (
                    "host", "run", "text", "n_pages", "first_page", "last_page"))):
                for pos, s in suffixes(text.split(" "), least):
                    gram = " ".join(s.split(" ")[:least])
                    out.append((host, xxhash.xxh64_intdigest(gram) >> 1, run, n, pos, s, lo, hi))
            cols = list(zip(*out)) if out else [()] * 8
            yield pa.record_batch([pa.array(c, t) for c, t in zip(cols, (
                pa.string(), pa.int64(), pa.binary(), pa.int64(), pa.int32(), pa.string(), pa.int64(), pa.int64()))],
                names=["host", "gram", "run", "n_pages", "pos", "suffix", "first_page", "last_page"])

    rows = materialize(runs.mapInArrow(explode, "host string, gram long, run binary, n_pages long, pos int, suffix string, "
                                             "first_page long, last_page long"),
                       "suffixes")
    groups = parts(rows.count(), per_group)
    # a first substring with more suffixes than a group should hold is dealt by run over several groups;
    # whether it occurs on two pages is known from its count, wherever the other page's suffix went
    run_hash = F.xxhash64("run")
    hot = materialize(rows.groupBy("host", "gram").agg(
        F.count("*").alias("_n"), (F.min("first_page") != F.max("last_page")).alias("_shared")).where(F.col("_n") > per_group)
        .select("host", "gram", "_shared", F.ceil(F.col("_n") / per_group).alias("_ways")), "hot-substrings")

    def compare(table: pa.Table) -> pa.Table:
        rows_ = sorted(zip(*(table[c].to_pylist() for c in ("host", "suffix", "run", "pos", "n_pages", "_shared",
                                                            "first_page", "last_page"))))
        near = []  # of every suffix of a run on one page, the nearest ones before and after it with another page
        for order in (range(len(rows_)), range(len(rows_) - 1, -1, -1)):
            found, last = [None] * len(rows_), None
            for i in order:
                if last is not None and rows_[last][0] == rows_[i][0]:
                    found[i] = found[last] if rows_[last][6:] == rows_[i][6:] else last
                last = i
            near.append(found)
        out = []
        for i, (host, s, run, pos, n, shared, _, _) in enumerate(rows_):
            short = s.endswith("\x00")
            best = len(s.split(" ")) if n > 1 else least if shared and not short else 0
            for j in (near[0][i], near[1][i]):
                if j is not None:
                    best = max(best, shared_length(s, rows_[j][1]))
            if best >= (len(s.split(" ")) if short else least):
                out.append((host, run, pos, pos + best - short))
        cols = list(zip(*out)) if out else [()] * 4
        return pa.table({k: pa.array(c, t) for k, c, t in zip(("host", "run", "from", "to"), cols, (
            pa.string(), pa.binary(), pa.int32(), pa.int32()))})

    way = F.pmod(run_hash, F.coalesce("_ways", F.lit(1)))
    dealt = rows.join(hot, ["host", "gram"], "left").withColumn("_shared", F.coalesce("_shared", F.lit(False))) \
        .withColumn("_group", F.pmod(F.xxhash64("host", "gram", way), F.lit(groups))).drop("_ways")
    return dealt.groupBy("_group").applyInArrow(compare, "host string, run binary, from int, to int")


def uncovered(distinct: DataFrame, spans: DataFrame) -> DataFrame:
    """(host, run, rest, covered): what is left of every distinct run, and its covered tokens."""
    lists = spans.groupBy("host", "run").agg(F.collect_list(F.struct("from", "to")).alias("spans"))

    def rest(batches):
        for b in pieces(batches, 500):
            texts, gone = [], []
            for text, got in zip(b["text"].to_pylist(), b["spans"].to_pylist()):
                tokens, end, kept = text.split(" "), 0, []
                for s in sorted(got or [], key=lambda x: x["from"]):
                    kept += tokens[end:s["from"]]
                    end = max(end, s["to"])
                kept += tokens[end:]
                texts.append(" ".join(kept))
                gone.append(len(tokens) - len(kept))
            yield pa.record_batch([b["host"], b["run"], pa.array(texts, pa.string()), pa.array(gone, pa.int64())],
                                  names=["host", "run", "rest", "covered"])

    return distinct.select("host", "run", "text").join(lists, ["host", "run"], "left") \
        .mapInArrow(rest, "host string, run binary, rest string, covered long")


def main_text(pages: DataFrame, least: int = LEAST, page_id: str = "page_id", url: str = "url",
              html: str = "html") -> DataFrame:
    """Per page: page_id, url, text, n_chars, n_boilerplate."""
    base = pages.select(F.col(page_id).alias("page_id"), F.col(url).alias("url"), F.col(html).alias("html")) \
        .withColumn("_page", F.xxhash64("page_id", "url", "html"))
    runs = materialize(page_runs(base).dropDuplicates(["_page", "at", "run"]), "page-runs")
    distinct = materialize(runs.groupBy("host", "run").agg(F.first("text").alias("text"),
                                                           F.countDistinct("copy").alias("n_pages"),
                                                           F.min("copy").alias("first_page"),
                                                           F.max("copy").alias("last_page")), "host-runs")
    left = uncovered(distinct, repeated(distinct, least))
    per_page = runs.select("_page", "host", "kind", "at", "run").join(left, ["host", "run"]).groupBy("_page").agg(
        F.sum("covered").alias("n_boilerplate"),
        F.array_sort(F.collect_list(F.when((F.col("kind") == "plain") & (F.col("rest") != ""), F.struct("at", "rest")))) \
        .alias("plain"))

    def extract(batches):
        for b in pieces(batches, 200):
            text = [split_page(x or "")[0] for x in b["html"].to_pylist()]
            yield pa.record_batch([b["page_id"], b["url"], b["_page"], pa.array(text, pa.string())],
                                  names=["page_id", "url", "_page", "main"])

    types = dict(base.dtypes)
    mains = base.mapInArrow(extract, f"page_id {types['page_id']}, url string, _page long, main string")
    plain = F.array_join(F.transform("plain", lambda x: x["rest"]), " ")
    return mains.join(per_page, "_page", "left") \
        .select("page_id", "url", F.coalesce(F.nullif("main", F.lit("")), plain, F.lit("")).alias("text"),
                F.coalesce("n_boilerplate", F.lit(0)).cast("long").alias("n_boilerplate")) \
        .select("page_id", "url", "text", F.char_length("text").cast("long").alias("n_chars"), "n_boilerplate")
