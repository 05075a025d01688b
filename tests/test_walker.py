"""The history features and ratings against a plain sequential walk.

The walk below is written independently for the test: it visits the contests
in time order and keeps per-player queues, exactly the pre-contest state the
features are defined by. Both Spark formulations (chunked with a tiny chunk so
that halos are exercised, and the single-window one) must agree with it.
"""

import datetime as dt
import math
from collections import defaultdict, deque

import pytest
from history_windows import single_window

from conftest import SF_SMALL
from duelspark.operators import clean, history, rating
from duelspark.settings import SERVE_FIELDS, Settings
from duelspark.sources.fixtures import FixtureTables

S = Settings.fixture()


def _walk(rows, ranks, s):
    elo = defaultdict(lambda: s.elo_initial)
    gform, sform = defaultdict(lambda: deque(maxlen=s.global_form_window)), defaultdict(
        lambda: deque(maxlen=s.surface_form_window))
    recent, serve = defaultdict(deque), defaultdict(lambda: deque(maxlen=s.serve_window))
    out = {}
    for r in rows:
        surf = r["surface"] if r["surface"] in s.surfaces else s.default_surface
        d = dt.datetime.strptime(str(r["tourney_date"]), "%Y%m%d")
        cutoff = int((d - dt.timedelta(days=s.fatigue_days)).strftime("%Y%m%d"))
        ids = {"w": r["winner_id"], "l": r["loser_id"]}
        state = {}
        for side, pid in ids.items():
            q = recent[pid]
            while q and q[0][0] < cutoff:
                q.popleft()
            g, sf = gform[pid], sform[(pid, surf)]
            hist = serve[pid]
            means = {}
            for f in SERVE_FIELDS:
                vals = [h[f] for h in hist if h[f] is not None]
                means[f"avg_{f}"] = sum(vals) / len(vals) if vals else None
            pr = [rk for (dd, rk) in ranks.get(pid, []) if dd <= r["tourney_date"]]
            state[side] = {"elo": elo[(pid, surf)], "global_form": sum(g) / len(g) if g else None,
                           "surface_form": sum(sf) / len(sf) if sf else None,
                           "fatigue": sum(s.heavy_weight if lv == s.heavy_level else 1.0 for _, lv in q),
                           "peak_rank": min(pr) if pr else None, **means}
            out[(r["contest_id"], side)] = state[side]
        rw, rl = state["w"]["elo"], state["l"]["elo"]
        e = 1.0 / (1.0 + 10 ** ((rl - rw) / 400.0))
        elo[(ids["w"], surf)] = rw + s.elo_k * (1.0 - e)
        elo[(ids["l"], surf)] = rl + s.elo_k * (0.0 - (1.0 - e))
        for side, won in (("w", 1.0), ("l", 0.0)):
            pid = ids[side]
            gform[pid].append(won)
            sform[(pid, surf)].append(won)
            recent[pid].append((r["tourney_date"], r["tourney_level"]))
            serve[pid].append({f: r[f"{side}_{f}"] for f in SERVE_FIELDS})
    return out


@pytest.fixture(scope="module")
def data(spark):
    fx = FixtureTables(spark, SF_SMALL)
    prep = clean.preprocess(fx.contests(), S)
    rows = sorted((r.asDict() for r in prep.collect()),
                  key=lambda r: (r["tourney_date"], r["match_num"], r["contest_id"]))
    ranks = defaultdict(list)
    for r in fx.rankings().collect():
        ranks[r["player_id"]].append((r["ranking_date"], r["rank"]))
    return prep, fx.rankings(), _walk(rows, ranks, S)


def _close(a, b):
    if a is None or b is None:
        return a is None and b is None
    return math.isclose(a, b, rel_tol=0, abs_tol=1e-9)


@pytest.mark.parametrize("plan,chunk", [(history.history_features, 25), (history.history_features, 4096),
                                        (single_window, 4096)])
def test_history_matches_walk(spark, data, plan, chunk):
    prep, rk, expected = data
    s = S.with_(history_chunk_rows=chunk)
    got = plan(prep, rk, s).collect()
    assert len(got) == len(expected)
    cols = ["global_form", "surface_form", "fatigue", "peak_rank", *[f"avg_{f}" for f in SERVE_FIELDS]]
    bad = [(r.contest_id, r.side, c) for r in got for c in cols
           if not _close(r[c], expected[(r.contest_id, r.side)][c])]
    assert not bad, bad[:5]


def test_elo_matches_walk(spark, data):
    prep, _, expected = data
    got = rating.elo_ratings(prep, S, checkpoint=False).collect()
    assert len(got) == len(expected) // 2
    for r in got:
        assert _close(r.w_elo, expected[(r.contest_id, "w")]["elo"])
        assert _close(r.l_elo, expected[(r.contest_id, "l")]["elo"])


def test_chunk_must_cover_frame(spark, data):
    prep, rk, _ = data
    with pytest.raises(ValueError):
        history.history_features(prep, rk, S.with_(history_chunk_rows=5))
