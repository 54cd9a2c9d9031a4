"""Hand-worked inputs and published goldens used by the tests."""

import datetime as dt

SF001 = "/root/testdata/sf0.01"
SF0001 = "/root/testdata/sf0.001"

D = dt.date

# Q1 (mean per unit): units AAA x2, BBB x1, CCC x1.
Q1_UNITS = [("AAA", "u1"), ("AAA", "u2"), ("BBB", "u3"), ("CCC", "u4")]
Q1_DAILY = [
    ("AAA", D(2020, 12, 31), 10),  # outside the year
    ("AAA", D(2021, 1, 1), 10),
    ("AAA", D(2021, 1, 2), 21),
    ("AAA", D(2021, 2, 1), 7),
    ("BBB", D(2021, 1, 1), 5),
    ("DDD", D(2021, 1, 1), 9),     # no units: dropped by the inner join
]
Q1_EXPECTED = {("AAA", D(2021, 1, 1)): 7.75, ("AAA", D(2021, 2, 1)): 3.5, ("BBB", D(2021, 1, 1)): 5.0}

# Q2 (next-month top 5), band 20-29, March 2021, forecast for 2021-04-01.
Q2_ROWS = [
    ("A", D(2021, 3, 1), "20-29", 5), ("A", D(2021, 3, 1), "20-29", 5), ("A", D(2021, 3, 2), "20-29", 12),
    ("E", D(2021, 3, 1), "20-29", 1), ("E", D(2021, 3, 3), "20-29", 2),
    ("B", D(2021, 3, 1), "20-29", 4), ("B", D(2021, 3, 2), "20-29", 4),
    ("C", D(2021, 3, 1), "20-29", 100),
    ("F", D(2021, 3, 1), "20-29", 1), ("F", D(2021, 3, 3), "20-29", 0),
    ("D", D(2021, 3, 1), "20-29", 10), ("D", D(2021, 3, 3), "20-29", 6),
]
Q2_EXPECTED = [("A", 72, 1), ("E", 17, 2), ("B", 4, 3), ("C", 0, 4), ("F", -14, 5)]

# Q3a (share of population), cutoff 2021-06-01.
Q3_POPULATION = [("A", 100), ("B", 50), ("C", 40), ("D", 10)]
Q3_DAILY = [
    ("A", D(2021, 5, 29), 10), ("A", D(2021, 5, 30), 12), ("A", D(2021, 5, 31), 14),
    ("A", D(2021, 6, 1), 1000),  # on the cutoff: not history
    ("B", D(2021, 5, 31), 5),
    ("C", D(2021, 5, 30), 9), ("C", D(2021, 5, 31), 4),
    ("D", D(2021, 5, 29), 4), ("D", D(2021, 5, 31), 1),
    ("E", D(2021, 5, 30), 3), ("E", D(2021, 5, 31), 3),  # no population
]
Q3_EXPECTED = {
    "A": (36, 16, 52, 0.52),
    "B": (5, 0, 5, 0.1),
    "C": (13, -1, 12, 0.3),
    "D": (5, 0, 5, 0.5),
}

# The 20 published per-area shares the original clustering ran on
# (area, share), in published order.
PUBLISHED_SHARES = [
    ("FVG", 0.6328885099766174),
    ("PIE", 0.6071899110972782),
    ("VDA", 0.6148109286089027),
    ("TOS", 0.6003560745439414),
    ("VEN", 0.5960684214767252),
    ("CAL", 0.5803700003408374),
    ("CAM", 0.6048702066408099),
    ("SIC", 0.5498337490983037),
    ("MAR", 0.620298573470467),
    ("MOL", 0.6610689030743861),
    ("UMB", 0.6244726957860749),
    ("PAB", 0.6147812971342383),
    ("LIG", 0.6525889104884406),
    ("PAT", 0.5625641355129464),
    ("SAR", 0.5846248181576437),
    ("BAS", 0.6179692793186006),
    ("LAZ", 0.6076343222166986),
    ("LOM", 0.6253450389044157),
    ("EMR", 0.609860559404474),
    ("PUG", 0.6209724591544898),
]

# Published bisecting k-means training costs (default seed, maxIter 20)
# and cluster sizes, for k = 2, 3, 4, 5.
BISECTING_COST = {
    2: 0.0054868955545268605,
    3: 0.0028325213042255104,
    4: 0.0012770218767735875,
    5: 8.873167943311833e-4,
}
BISECTING_SIZES = {2: [6, 14], 3: [3, 6, 11], 4: [2, 3, 4, 11], 5: [2, 3, 4, 5, 6]}

# Exact 1-D optimum of the k-means cost on the shares, and the worst
# cost seen for k-means over several seeds.
KMEANS_OPTIMUM = {
    2: 0.005394964651850022,
    3: 0.002213041919344839,
    4: 0.0011787806097392334,
    5: 0.0005174257256494953,
}
KMEANS_WORST = {2: 0.007954420872908256, 3: 0.003236, 4: 0.001277, 5: 0.001196}

# Published cluster of each area (in PUBLISHED_SHARES order) and the
# published WSSSE, per (algorithm, k).
PUBLISHED_ASSIGNMENTS = {
    ("kmeans", 2): [1, 0, 0, 0, 0, 0, 0, 0, 0, 1, 0, 0, 1, 0, 0, 0, 0, 0, 0, 0],
    ("kmeans", 3): [0, 0, 0, 0, 0, 1, 0, 1, 0, 2, 0, 0, 2, 1, 1, 0, 0, 0, 0, 0],
    ("kmeans", 4): [0, 0, 0, 3, 3, 3, 0, 1, 0, 2, 0, 0, 2, 1, 3, 0, 0, 0, 0, 0],
    ("kmeans", 5): [2, 3, 3, 0, 0, 0, 3, 1, 3, 2, 3, 3, 2, 4, 0, 3, 3, 3, 3, 3],
    ("bisecting", 2): [1, 1, 1, 0, 0, 0, 1, 0, 1, 1, 1, 1, 1, 0, 0, 1, 1, 1, 1, 1],
    ("bisecting", 3): [2, 1, 1, 0, 0, 0, 1, 0, 1, 2, 1, 1, 2, 0, 0, 1, 1, 1, 1, 1],
    ("bisecting", 4): [3, 2, 2, 1, 1, 1, 2, 0, 2, 3, 2, 2, 3, 0, 1, 2, 2, 2, 2, 2],
    ("bisecting", 5): [4, 2, 2, 1, 1, 1, 2, 0, 3, 4, 3, 2, 4, 0, 1, 3, 2, 3, 2, 3],
}
PUBLISHED_WSSSE = {
    ("kmeans", 2): 0.007954420872908256,
    ("kmeans", 3): 0.002213041919344839,
    ("kmeans", 4): 0.0011787806097392334,
    ("kmeans", 5): 0.001195990507640404,
    ("bisecting", 2): 0.005486895554529109,
    ("bisecting", 3): 0.002832521304225552,
    ("bisecting", 4): 0.0012770218767734628,
    ("bisecting", 5): 8.873167943305849e-4,
}
