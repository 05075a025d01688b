"""Parameters of every operator, in one frozen dataclass.

Two presets: ``Settings.reference()`` carries the tennis values of the original
pipeline; ``Settings.fixture()`` carries the same parameters mapped onto the
driver's synthetic tables (see FIXTURES.md, part B).
"""

from __future__ import annotations

from dataclasses import dataclass, field, replace

# ---------------------------------------------------------------------------
# Fixed values that must equal the original pipeline's for equal results.
# ---------------------------------------------------------------------------
BAD_SCORE_TOKENS = ("RET", "W/O", "DEF", "ABN", "WO")
REFERENCE_SURFACES = ("Hard", "Clay", "Grass", "Carpet")
REFERENCE_KEEP_LEVELS = ("G", "M", "A", "C", "F")
REFERENCE_PREDICTED_LEVELS = ("G", "M", "A")
SERVE_FIELDS = (
    "ace_rate",
    "df_rate",
    "1st_serve_pct",
    "1st_serve_win_pct",
    "2nd_serve_win_pct",
    "bp_saved_pct",
)
# ratio -> (numerator, denominator), as differences of the serve counts
SERVE_RATIOS = {
    "1st_serve_pct": ("1stIn", "svpt", None),
    "1st_serve_win_pct": ("1stWon", "1stIn", None),
    "2nd_serve_win_pct": ("2ndWon", "svpt", "1stIn"),
    "bp_saved_pct": ("bpSaved", "bpFaced", None),
    "ace_rate": ("ace", "svpt", None),
    "df_rate": ("df", "svpt", None),
}
ROUND_ORDINAL = {"R128": 1, "R64": 2, "R32": 3, "R16": 4, "QF": 5, "SF": 6, "F": 7, "RR": 4, "BR": 5}
HAND_CODE = {("R", "R"): 0, ("R", "L"): 1, ("L", "R"): 2, ("L", "L"): 3}
# sklearn-style calibration edges are np.linspace(0, 1, 11) as doubles
CALIBRATION_EDGES = (0.1, 0.2, 0.30000000000000004, 0.4, 0.5, 0.6000000000000001,
                     0.7000000000000001, 0.8, 0.9)
# Columns a feature matrix hands to the models (the order is the model's order)
SERVE_DIFF_COLS = tuple(f"avg_{f}_diff" for f in SERVE_FIELDS)
NUMERIC_FEATURES = (
    "elo_diff", "global_form_diff", "surface_form_diff", "fatigue_diff",
    *SERVE_DIFF_COLS,
    "rank_diff", "rank_points_diff", "peak_rank_diff", "age_diff", "height_diff",
    "best_of", "round_ordinal", "handedness",
)
CLUSTER_FEATURES = ("player1_cluster_", "player2_cluster_")
# player1/player2 pairs, in the reference's column order
PAIRS = ("elo", "global_form", "surface_form", "fatigue", "rank", "rank_points", "age", "ht", "hand",
         "id", "name", "peak_rank", *[f"avg_{f}" for f in SERVE_FIELDS])
DIFFS = (("elo_diff", "elo"), ("global_form_diff", "global_form"), ("surface_form_diff", "surface_form"),
         ("fatigue_diff", "fatigue"), ("rank_diff", "rank"), ("rank_points_diff", "rank_points"),
         ("age_diff", "age"), ("height_diff", "ht"), ("peak_rank_diff", "peak_rank"),
         *[(f"avg_{f}_diff", f"avg_{f}") for f in SERVE_FIELDS])
# ---------------------------------------------------------------------------


@dataclass(frozen=True)
class Splits:
    train: tuple[int, int]
    val: tuple[int, int]
    test: tuple[int, int]


@dataclass(frozen=True)
class Settings:
    surfaces: tuple[str, ...] = REFERENCE_SURFACES
    default_surface: str = "Hard"
    keep_levels: tuple[str, ...] = REFERENCE_KEEP_LEVELS
    predicted_levels: tuple[str, ...] = REFERENCE_PREDICTED_LEVELS
    heavy_level: str = "G"
    heavy_weight: float = 1.5
    main_source: str = "main"
    bad_score_tokens: tuple[str, ...] = BAD_SCORE_TOKENS
    missing_rank: int = 999
    default_best_of: int = 3
    missing_cluster: int = -1
    seed: int = 42
    elo_initial: float = 1500.0
    elo_k: float = 32.0
    global_form_window: int = 20
    surface_form_window: int = 10
    serve_window: int = 20
    fatigue_days: int = 14
    clip_eps: float = 1e-6
    k_range: tuple[int, ...] = (2, 3, 4, 5, 6, 7, 8)
    kmeans_restarts: int = 10
    splits: Splits = field(default_factory=lambda: Splits(
        (20000101, 20201231), (20210101, 20221231), (20230101, 20251231)))
    # rows per chunk of a player's history; bounds the largest window group
    history_chunk_rows: int = 4096
    # rating pools: ratings are kept per player and per value of these columns
    # (more keys = more independent sequential walks = more parallelism)
    rating_pools: tuple[str, ...] = ("surface",)

    @staticmethod
    def reference() -> "Settings":
        return Settings()

    @staticmethod
    def fixture() -> "Settings":
        """Domains of the driver tables: surface = p_type, level = first digit of
        the order priority (1=G, 2=M, 3=A, 4 another kept level, 5 dropped)."""
        return Settings(
            surfaces=("ECONOMY", "LARGE", "MEDIUM", "PROMO"),
            default_surface="ECONOMY",
            keep_levels=("1", "2", "3", "4"),
            predicted_levels=("1", "2", "3"),
            heavy_level="1",
            splits=Splits((0, 19991231), (20000101, 20001231), (20010101, 99991231)),
        )

    def with_(self, **kw) -> "Settings":
        return replace(self, **kw)
