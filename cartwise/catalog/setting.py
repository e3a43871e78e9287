"""Windows and parameters of the registered queries on the retail tables."""

from __future__ import annotations

from datetime import datetime

from cartwise.windows import WindowSpec

CATE = 8
WINDOW = WindowSpec.of("2024-01-01", "2024-01-25")
SUB = WINDOW.back(days=7)
LABEL = WINDOW.ahead(days=5)
SPLIT_DAYS, SPLIT_LABEL_DAYS, SPLIT_STEP_DAYS = 65, 5, 5
# The curve is learned one split earlier, so its label window ends where the features end.
CURVE_WINDOW = WindowSpec.of("2024-01-01", "2024-01-20")
CURVE_LABEL = CURVE_WINDOW.ahead(days=5)
DEFAULT_REG, REG_CUTOFF = datetime(1995, 1, 1), datetime(1996, 1, 1)
COMMENT_END = datetime(2001, 6, 1)
# Events of one user lie hours apart here, so dwell time uses a six-hour gap besides the default.
MAX_GAP = 21600
TOP_RANKED = 500
BUCKETS = 8
SKETCH_ERROR = 0.07  # four standard errors
# Short settings of the queries that state losses by round, stopped rounds and the search (MODEL_ROUNDS is that of
# cv_best_rounds alone); trained and scored models have the tuned ones of the library.
MODEL_ROUNDS, MODEL_FOLDS = 5, 5
STOPPED_ROUNDS, STOP_TOLERANCE = 12, 0.02
SEARCH_GRIDS = (
    {"depth": (3, 4), "min_rows": (1, 3)},
    {"min_gain": (0.0, 0.2)},
    {"row_sample": (0.6, 0.8), "column_sample": (0.8,)},
    {"positive_weight": (1.0, 2.0)},
    {"rate": (0.1, 0.2), "rounds": (2, 3)},
)
TOPICS, TOPIC_ROUNDS = 3, 5
