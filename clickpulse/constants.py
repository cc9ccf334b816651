"""Values that must equal the surveyed jobs' for identical results.

Fixed values (do not change; operators use them as defaults):
"""

# --- fixed values -----------------------------------------------------------------
# Q1 / Q2: top categories, then top sessions per category.
TOP_CATEGORIES = 10
TOP_SESSIONS = 10
# Q3: default target page flow.
TARGET_PAGE_FLOW = "1,2,3,4,5,6,7"
# Q4: top products per area; top cities shown in the share text; remainder label.
TOP_PRODUCTS = 3
TOP_SHARE_CITIES = 2
OTHER_LABEL = "其他"
# Q5: clicks on one ad in one day at which a user is blocked (blocked at >= this).
BLOCK_THRESHOLD = 100
# Q7: top ads per day and area.
TOP_ADS = 3
# Q8: trend length in minutes (the stated intent: the last hour), minute label format.
TREND_MINUTES = 60
MINUTE_LABEL_FORMAT = "HH:mm"
# Sliding window as coded: 3 minutes long, 1 minute slide.
SLIDING_LENGTH_MINUTES = 3
SLIDING_SLIDE_MINUTES = 1
# Formats and separators.
DAY_FORMAT = "yyyy-MM-dd"
ID_LIST_SEPARATOR = ","
AD_LINE_SEPARATOR = " "
JUMP_SEPARATOR = "-"
# "No click" sentinel in click_category_id / click_product_id.
NO_CLICK = -1
