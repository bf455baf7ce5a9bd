"""Values that must equal the reference's for the same results.

Fixed values, stated once and in natural order; the operator modules import
(and re-export) them under the names used in their signatures.
"""

# -- Fixed values ---------------------------------------------------------- #

# Content catalogue: twelve categories cat_00 .. cat_11 (built by rule).
CATS = [f"cat_{i:02d}" for i in range(12)]
# Engagement weight of a (key, category) cell: 3 * clicks + impressions.
CLICK_WEIGHT = 3

# Pseudonymous ids: first 16 hex digits of SHA-1 over the parts joined by "|".
PSEUDONYM_SEP = "|"
PSEUDONYM_HEX_DIGITS = 16

# Identity resolution.
MAX_BLOCK = 50                                   # devices per signal value, inclusive
DETERMINISTIC_TYPES = ("hashed_email", "maid")
PROBABILISTIC_TYPES = ("ip",)
MATCHER_FEATURES = ["cosine", "same_type"]
MATCHER_MAX_ITER = 50
PRECISION_TARGET = 0.90
FALLBACK_THRESHOLD = 0.5

# Train / test split share and model seed.
TRAIN_PERCENT = 70
SEED = 42

# Segmentation.
K_GRID = range(4, 11)
TOP_DIMS = 2
NAME_SEP = " + "
NAME_SUFFIX = " affinity"

# Propensity.
PROPENSITY_ATTRS = ["age", "income_z", "recency_days"]
LR_MAX_ITER = 100
GBT_MAX_ITER = 60
GBT_DEPTH = 5

# Click-through model.
NUM_HASH = 1 << 18
CTR_INPUT_COLS = ["content_cat", "campaign", "creative", "device_type", "position", "bid"]
CTR_CATEGORICAL = ["content_cat", "campaign", "creative", "device_type"]
CTR_MAX_ITER = 50
CTR_REG = 1e-4

# Lookalike.
ALS_RANK = 8
ALS_MAX_ITER = 12
ALS_ALPHA = 20.0
EXPAND_FRACTION = 0.20
CHAR_ITEMS = 2
MIN_CONVERTERS = 20

# Campaign credible interval.
CI = (0.025, 0.975)
