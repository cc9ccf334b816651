"""Parameters of the registered check queries (see ``registry.py``).

The driver tables span 2024-01-01 .. 2024-01-30, so the date range is placed
inside that span; ages follow the surveyed jobs' parameters (20..50). Sizes and
windows are the jobs' own fixed values (``constants.py``). At this scale a
100-click threshold never fires (150 users x 30 days x 6 ads), so the guard
checks use 3, replayed in micro-batches of 6 days.
"""

from clickpulse import constants as C

TASK_ID = "task-check"
START_DATE = "2024-01-05"
END_DATE = "2024-01-25"
START_AGE = 20
END_AGE = 50
TARGET_PAGE_FLOW = C.TARGET_PAGE_FLOW
TOP_CATEGORIES = C.TOP_CATEGORIES
TOP_SESSIONS = C.TOP_SESSIONS
TOP_PRODUCTS = C.TOP_PRODUCTS
TOP_ADS = C.TOP_ADS
TREND_LENGTH_MINUTES = C.TREND_MINUTES
SLIDING_LENGTH_MINUTES = C.SLIDING_LENGTH_MINUTES
SLIDING_SLIDE_MINUTES = C.SLIDING_SLIDE_MINUTES
GUARD_THRESHOLD = 3
GUARD_DAYS_PER_BATCH = 6
# Slices of the *_hot check keys (far more than the data needs, so sessions span several).
JUMP_SLICES_CHECK = 64
