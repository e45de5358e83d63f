"""Parameters shared by the registered queries and their SQL."""

from lodeworks.operators.neighbors import lsh_family

# Share of the baskets that an itemset needs, at every level.
SUPPORT_SHARE = 0.06
TOP_RULES = 5
TOP_FRIENDS = 10
# Limits at which vertices of the test tables count as hubs.
LOW_BLOCK_ROWS, LOW_HUB_PAIRS = 24, 250
# The users of the short friend report: every 19th part from 15 on, below 200, the parts of the smallest scale.
REPORT_USERS = list(range(15, 200, 19))
# The rows used as search queries.
QUERY_IDS = [99, 199, 299, 399, 499, 599, 699, 799, 899, 999]
NEIGHBORS = 3

DIMS = 64
FAMILY = lsh_family(k=10, L=10, dims=DIMS, lo=-0.1, hi=0.1, seed=11)
SWEEP = {
    (k, L): lsh_family(k=k, L=L, dims=DIMS, lo=-0.1, hi=0.1, seed=100 * k + L)
    for k, L in [(10, L) for L in range(10, 21, 2)] + [(k, 10) for k in (6, 7, 8, 9, 11)]
}

# Directions of the leading part of the decomposition.
LEADING = 4

# Ten each: the first vectors, and from the first on always the one farthest from all before (at the second scale).
FIRST_CENTROIDS = {"random": list(range(10)), "far": [0, 188, 291, 152, 366, 49, 11, 132, 80, 14]}
KMEANS_ITERS = 20
# After so many iterations the drop of the cost is reported.
DROP_AFTER = 10

FACTORS = 20
TOP_RATING = 5.0
REG = 0.1
# From a rate that descends at every scale of the tables, each half of the one before.
LEARNING_RATES = (0.009, 0.0045, 0.00225)
EPOCHS = 40
# Added to ids to make them wider than int.
WIDE_IDS = 3_000_000_000
# Epochs of the run in blocks, which takes several jobs for each.
BLOCK_EPOCHS, MF_BLOCKS = 3, 2

TOP_SCORES = 5
# Similarity that counts as high.
SIMILAR = 0.5
# The recommendation report: every 9th customer from 10 on, and the items below a limit.
REPORT_CUSTOMERS = list(range(10, 100, 9))
REPORT_ITEMS = 100
# Sums of doubles differ in the last digits with their order.
DIGITS = 6
