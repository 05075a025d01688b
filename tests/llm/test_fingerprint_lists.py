"""I-Match fingerprints and URL lists against plain versions."""

import datetime as dt
import hashlib
import re
import struct
from collections import Counter

import duckdb
import xxhash
from pyspark.sql import functions as F

from conftest import SF_SMALL
from duelspark.llm import imatch, urllist
from duelspark.llm.catalog import ORACLES
from llm_fixtures import docs, none, odd, run  # noqa: F401 - fixtures


def edited(text, nxt):
    cut = len(text) // 3
    return text[:len(text) - cut] + nxt[:cut]


def test_edits_and_fingerprints(run, docs):
    got = run("op3_imatch").set_index("doc_id")
    ids = sorted(docs.index, reverse=True)
    texts = docs["text"].fillna("").to_dict()
    by_text = {}
    for i, j in zip(ids, [*ids[1:], ids[0]]):
        r = got.loc[i]
        e = edited(texts[i], texts[j])
        assert r["n_chars"] == len(texts[i])
        assert r["edited_sha256"] == hashlib.sha256(e.encode()).hexdigest()
        for t, f in ((texts[i], r["fingerprint"]), (e, r["edited_fingerprint"])):
            assert by_text.setdefault(t, f) == f
        assert r["near_next"] == plain_likeness(r["fingerprint"], got.loc[j, "fingerprint"])
        assert r["near_edited"] == plain_likeness(r["fingerprint"], r["edited_fingerprint"])
    assert (got["near_edited"] > got["near_next"]).mean() > 0.95


def plain_likeness(a, b):
    a, b = ({e[:2]: e[2:] for e in x.split("-") if e} for x in (a, b))
    used = a.keys() | b.keys()
    return sum(a.get(k) == b.get(k) for k in used) / len(used) if used else 1.0


def term_hash(word):
    return struct.unpack("<q", struct.pack("<Q", xxhash.xxh64(word.encode(), seed=42).intdigest()))[0]


def plain_terms(text):
    return {term_hash(w) for w in re.split(r"[\x20\x09-\x0D]+", text.lower()) if w}


def plain_fingerprint(text, band):
    """Every subset of the lexicon by itself: sorted terms in it, hashed one after the other."""
    every = plain_terms(text)
    own = sorted(every & band) or sorted(every)
    entries = {}
    for h in own:
        for level in range(imatch.LEVELS):
            if h % 4 ** level == 0:
                place = (level, (h >> 59) % 32)
                seed = 42 if place not in entries else xxhash.xxh64(struct.pack("<Q", entries[place]), seed=42).intdigest()
                entries[place] = xxhash.xxh64(struct.pack("<q", h), seed=seed).intdigest()
    order = sorted(entries, key=lambda k: (k[0], (k[1] + 16) % 32))
    return "-".join(f"{level * 32 + cell:02x}{entries[level, cell] % 65536:04x}" for level, cell in order)


def plain_band(texts, p=imatch.Params()):
    df = Counter(h for t in texts for h in plain_terms(t))
    least = max(p.min_docs, p.min_share * len(texts))
    return {h for h, n in df.items() if least <= n <= p.max_share * len(texts)}


def test_fingerprints_plainly(run, docs):
    """All in-band terms of all texts and edited texts, recomputed without Spark."""
    got = run("op3_imatch").set_index("doc_id")
    texts = docs["text"].fillna("").to_dict()
    band, ids = plain_band(texts.values()), sorted(texts, reverse=True)
    for i, j in zip(ids, [*ids[1:], ids[0]]):
        assert got.loc[i, "fingerprint"] == plain_fingerprint(texts[i], band)
        assert got.loc[i, "edited_fingerprint"] == plain_fingerprint(edited(texts[i], texts[j]), band)


def test_every_term_counts(spark):
    """In a long text, any changed in-band term changes the fingerprint; a large lexicon, joined by
    shuffle, gives the same fingerprints as one held by the tasks."""
    words = [f"w{i}" for i in range(4000)]
    texts = [" ".join(words)] * 2 + [" ".join(words[:i] + words[i + 1:]) for i in range(0, 4000, 401)] + ["other", None, ""]
    d = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    results = [imatch.fingerprint_edits(d, imatch.Params(max_share=1.0, held_terms=held)).toPandas()
               .sort_values("doc_id").reset_index(drop=True) for held in (10 ** 6, 0)]
    assert results[0].equals(results[1])
    prints = results[0]["fingerprint"].tolist()
    assert prints[0] == prints[1] and len(set(prints[:12])) == 11 and prints[-2:] == ["", ""]


def test_native_plan(spark):
    plan = imatch.fingerprint_edits(spark.read.parquet(f"{SF_SMALL}/documents.parquet"))._jdf.queryExecution().toString()
    assert not any(x in plan for x in ("Python", "Arrow", "Pandas"))


def test_fingerprint_edges(odd, none):
    got = imatch.fingerprint_edits(odd).toPandas()
    assert len(got) == 8 and got["near_edited"].between(0, 1).all() and got["near_next"].between(0, 1).all()
    assert got[got["doc_id"].isin([3, 4])]["fingerprint"].nunique() == 1
    # order: 6, 5, 4, 3, 3, 2, 1, null, and 6 again after the null
    by = {i: h for i, h in zip(got["doc_id"], got["edited_sha256"]) if i == i}
    assert by[6] == hashlib.sha256(b"x").hexdigest()
    assert by[4] == hashlib.sha256(edited("same row", "same row").encode()).hexdigest()
    last = got[got["doc_id"].isna()]["edited_sha256"].iloc[0]
    assert last == hashlib.sha256(edited("no id here", "x").encode()).hexdigest()
    assert imatch.fingerprint_edits(none).count() == 0


def test_lexicon_band(spark):
    rows = [(i, f"common w{i // 2} only{i}") for i in range(40)]
    d = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r["term"] for r in imatch.lexicon(d, 40, imatch.Params()).collect()}
    want = {r[0] for r in spark.range(20).select(F.xxhash64(F.concat(F.lit("w"), "id"))).collect()}
    assert got == want


def test_list_matches_sql(run):
    con = duckdb.connect()
    for t in ("pages", "events"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF_SMALL}/{t}.parquet'")
    want = con.execute(ORACLES["op4_url_list"]).fetchdf().astype(str)
    got = run("op4_url_list").astype(str)
    key = lambda f: sorted(tuple(x.replace("None", "nan").replace("NaT", "nan").replace("<NA>", "nan") for x in r)
                           for r in f[sorted(f)].to_numpy().tolist())
    assert key(got) == key(want)


def test_list_intervals(spark):
    t = lambda h: dt.datetime(2024, 1, 1) + dt.timedelta(hours=h)
    entries = [("ex.org", t(1), "add"), ("ex.org", t(30), "remove"), ("a.ex.org", t(31), "add"), ("EX.org", t(50), "add"),
               ("ex.org", t(50), "remove"), ("x", t(0), None), (None, t(0), "add"), ("ex.org", t(60), "add")]
    pages = [(1, "http://a.ex.org/", t(0)), (2, "http://A.ex.org:80/x", t(1)), (3, "http://b.ex.org", t(29.5)),
             (4, "http://ex.org", t(30)), (5, "https://c.a.ex.org?q", t(40)), (6, "http://ex.org", t(50)),
             (7, None, t(2)), (8, "http://a.ex.org", None), (9, "http://a.ex.org", t(61)), (2, "http://A.ex.org:80/x", t(1)),
             (10, "http://notex.org", t(5)), (11, "http://localhost/", t(5))]
    c = spark.createDataFrame(pages, "page_id long, url string, fetched_at timestamp").withColumn("pattern", F.lit("clash"))
    e = spark.createDataFrame(entries, "pattern string, at timestamp, action string").withColumn("slot", F.lit("clash"))
    for slot in (60, 3600, 10 ** 6):
        got = urllist.judge(c, e, slot).collect()
        assert len(got) == 12
        assert {r["page_id"]: r["pattern"] for r in got} == {
            1: None, 2: "ex.org", 3: "ex.org", 4: None, 5: "a.ex.org", 6: None, 7: None, 8: None, 9: "a.ex.org", 10: None,
            11: None}
        assert all(r["blocked"] == (r["pattern"] is not None) for r in got)
    assert urllist.judge(c.where("false"), e).count() == 0 and urllist.judge(c, e.where("false")).where("blocked").count() == 0
