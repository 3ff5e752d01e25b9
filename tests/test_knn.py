"""The pivot-partitioned neighbour join, the kNN imputer and classifier, and ADASYN, against brute force."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from foldwise.operators import knn


def brute(queries, donors, k, itself=False):
    """{(space, id): [(donor, square)]} of (space, id, x) and (space, id, x, payload)."""
    out = {}
    for space, i, x in queries:
        rows = []
        for other, j, y, _ in donors:
            if other == space and (itself or i != j):
                square = 0.0
                for a, b in zip(x, y, strict=True):
                    square += (a - b) ** 2
                rows.append((square, j))
        out[space, i] = [(j, s) for s, j in sorted(rows)[:k]]
    return out


def got(df):
    out = {}
    for r in df.orderBy("space", "id", "rank").collect():
        out.setdefault((r["space"], r["id"]), []).append((r["donor"], r["square"]))
    return out


Q, D = "space string, id long, x array<double>", "space string, id long, x array<double>, payload double"


def test_nearest_equals_brute_force_over_many_cells(spark, monkeypatch):
    monkeypatch.setattr(knn, "CELL_ROWS", 40)  # many pivots
    monkeypatch.setattr(knn, "BLOCK_ROWS", 25)  # blocks in hot cells
    rng = np.random.default_rng(7)
    donors = [("a", i, [float(v) for v in rng.integers(0, 12, 3)], float(i)) for i in range(900)]  # ties and copies
    donors += [("b", i, [5.0], 0.5) for i in range(120)]  # one point holds a space
    donors += [("c", i, rng.normal(size=2).tolist(), 1.0) for i in range(3)]  # fewer than k
    queries = [("a", i, [float(v) for v in rng.integers(-3, 15, 3)]) for i in range(0, 1200, 7)]
    queries += [("b", i, [float(i)]) for i in range(10)] + [("c", 1, [0.0, 0.0]), ("none", 1, [0.0])]
    left, right = spark.createDataFrame(queries, Q), spark.createDataFrame(donors, D)
    want = {key: rows for key, rows in brute(queries, donors, 5).items() if rows}
    assert got(knn.nearest(left, right, 5)) == want
    assert got(knn.nearest(left, right, 5, itself=True)) == {k: r for k, r in brute(queries, donors, 5, True).items() if r}


def test_few_cells_are_visited_where_the_data_allow(spark, monkeypatch):
    monkeypatch.setattr(knn, "CELL_ROWS", 50)
    rng = np.random.default_rng(8)
    points = rng.uniform(0, 100, (4000, 2))
    donors = spark.createDataFrame([("s", i, p.tolist(), 0.0) for i, p in enumerate(points)], D)
    sound = knn._sound(donors)
    pivots = knn._pivots(sound, 42)
    celled = knn._celled(sound, pivots, D)
    stats = knn._statistics(celled, 6)
    queries = sound.select("space", "id", "x")
    more = knn._visits(knn._visits(queries, pivots, stats, 6, True).drop("cell"), pivots, stats, 6, False).count()
    assert len(pivots["s"]) == 80 and more < 4000 * 12  # of 79 other cells


def test_nearest_of_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    donors = spark.createDataFrame([("s", 1, [0.0], 1.0), ("s", 2, [nan], 1.0), ("s", 3, None, 1.0), ("s", 4, [inf], 1.0), ("s", None, [0.0], 1.0), (None, 5, [0.0], 1.0), ("s", 6, [None], 1.0)], D)
    queries = spark.createDataFrame([("s", 9, [1.0]), ("s", 10, [nan]), ("s", 11, None), (None, 12, [0.0])], Q)
    assert got(knn.nearest(queries, donors, 3)) == {("s", 9): [(1, 1.0)]}
    assert knn.nearest(queries, donors.limit(0), 3).count() == 0 and knn.nearest(queries.limit(0), donors, 3).count() == 0


def test_imputer_fills_from_observed_columns_only(spark):
    nan = float("nan")
    rows = [(1, 1.0, 10.0, None, "a"), (2, 1.0, None, 5.0, "b"), (3, 2.0, 12.0, 6.0, "c"), (4, nan, None, 7.0, "d"), (5, None, None, None, "e"), (6, 9.0, 90.0, None, "f")]
    df = spark.createDataFrame(rows, "id long, u double, v double, w double, tag string").withColumn("none", F.lit(None).cast("double"))
    out = {r["id"]: r for r in knn.impute_knn(df, "id", ["u", "v", "w", "none"], k=2).collect()}
    assert out[2]["v"] == 10.0  # row 1 is at distance 0
    assert out[5]["u"] == pytest.approx((1 + 1 + 2 + 9) / 4) and out[5]["tag"] == "e"  # shares no column: the mean
    far = {3: np.sqrt(4 * 1.0 / 1), 2: np.sqrt(4 * 4.0 / 1)}  # row 4 shares only w
    assert out[4]["u"] == pytest.approx((2.0 / far[3] + 1.0 / far[2]) / (1 / far[3] + 1 / far[2]))
    assert all(r["none"] is None for r in out.values()) and out[3]["u"] == 2.0
    batch = spark.createDataFrame([(2, None, 12.0, 6.0, "new")], "id long, u double, v double, w double, tag string")
    assert knn.impute_knn(batch, "id", ["u", "v", "w"], fitted=df, k=1).first()["u"] == 2.0  # an id of another table is no self
    assert knn.impute_knn(df.limit(0), "id", ["u", "v"], k=2).count() == 0


def test_classifier_votes_and_ties(spark):
    rows = spark.createDataFrame([(1, [0.0], "b"), (2, [1.0], "a"), (3, [2.0], "b"), (4, [10.0], "a"), (5, [10.0], None)], "id long, x array<double>, y string")
    out = {r["id"]: r["predicted"] for r in knn.knn_classify(rows, rows, "id", F.col("x"), "y", k=2).select("id", "predicted").distinct().collect()}
    assert out == {1: "a", 2: "b", 3: "a", 4: "a", 5: "a"}  # 1, 4, 5: one vote each, the smaller label
    sure = knn.knn_classify(rows, rows, "id", F.col("x"), "y", k=3, weight="distance").where("id = 5").collect()
    assert [(r["label"], r["votes"]) for r in sure if r["votes"] > 0] == [("a", 1.0)]  # only those at distance 0 count


@pytest.mark.parametrize("partitions", [1, 7])
def test_adasyn_counts_are_exact_whatever_the_partitions(spark, partitions):
    rng = np.random.default_rng(9)
    rows = [(i, rng.normal(0, 1, 2).tolist(), "big") for i in range(200)] + [(1000 + i, rng.normal(1.5, 1, 2).tolist(), "small") for i in range(31)]
    rows += [(2000, [50.0, 50.0], "one")] + [(3000 + i, [90.0 + i, 90.0], "apart") for i in range(8)]
    df = spark.createDataFrame(rows, "id long, x array<double>, y string").repartition(partitions)
    targets = {"small": 200, "one": 4, "apart": 20, "big": 10}
    hard = knn.adasyn_hardness(df, "id", F.col("x"), "y", targets)
    counts = {r["label"]: r["n"] for r in hard.groupBy("label").agg(F.sum("n_new").alias("n")).collect()}
    assert counts == {"small": 169, "one": 3, "apart": 12, "big": 0}
    made = knn.oversample_adasyn(df, "id", F.col("x"), "y", targets).collect()
    assert len(made) == 169 + 3 + 12
    point = {i: (x, y) for i, x, y in rows}
    for r in made:
        (a, label), (b, other) = point[r["id"]], point[r["toward"]]
        assert label == other == r["label"] and 0 <= r["step"] < 1
        assert r["x"] == pytest.approx([p + (q - p) * r["step"] for p, q in zip(a, b, strict=True)])
    digest = sorted((r["id"], r["copy"], r["toward"], round(r["step"], 9)) for r in made)
    seen = test_adasyn_counts_are_exact_whatever_the_partitions.__dict__.setdefault("seen", digest)
    assert digest == seen


def test_a_query_goes_to_groups_of_cells(spark, monkeypatch):
    """In many dimensions nearly every cell is in reach; a query is still sent once to a group, not to each cell."""
    monkeypatch.setattr(knn, "CELL_ROWS", 20)
    monkeypatch.setattr(knn, "BLOCK_ROWS", 250)
    rng = np.random.default_rng(5)
    donors = spark.createDataFrame([("s", i, p.tolist(), 0.0) for i, p in enumerate(rng.normal(size=(1000, 20)))], D)
    pivots = knn._pivots(donors, 42)
    stats = knn._statistics(knn._celled(donors, pivots, D), 4)
    queries = donors.select("space", "id", "x")
    more = knn._visits(knn._visits(queries, pivots, stats, 4, True), pivots, stats, 4, False).count()
    assert len(pivots["s"]) == 50 and more <= 1000 * 8  # of 49 other cells


@pytest.mark.parametrize(("dims", "scale"), [(2, 1.0), (20, 1.0), (20, 1e-9), (20, 1e20), (3, 1e200)])
def test_closest_in_strips_equals_brute_force(monkeypatch, dims, scale):
    monkeypatch.setattr(knn, "STRIPS", ((7, 13), (7, 13)))
    rng = np.random.default_rng(dims)
    points = rng.integers(0, 9, (300, dims)) * scale + 5 * scale  # copies and ties
    ids = np.arange(300)
    need = knn._needed(points, ids, 4)
    rows, found, square = knn._closest(points[:90], ids[:90], np.full(90, np.inf), points[need], ids[need], 4, False)
    with np.errstate(over="ignore"):
        away = knn._squares(points[:90], points)
    away[ids[:90], ids[:90]] = np.inf
    for q in range(90):
        best = [i for i in np.argsort(away[q], kind="stable")[:4] if np.isfinite(away[q, i])]
        mine = np.flatnonzero(rows == q)
        assert list(need[found[mine]]) == best and list(square[mine]) == list(away[q, best])


@pytest.mark.parametrize("weight", ["distance", "uniform"])
def test_imputer_searches_only_what_equal_donors_leave_open(spark, monkeypatch, weight):
    """Donors at distance 0 settle a value by a join; the others are searched, and all values are those of brute force."""
    rng = np.random.default_rng(11)
    cols, k = ["u", "v", "w"], 3
    rows = [(i, *[None if rng.random() < 0.3 else float(rng.integers(0, 4)) * (-1) ** (i % 2) for _ in cols]) for i in range(150)]  # 0.0 and -0.0, too
    rows += [(200 + i, 50.0 + i, None, None) for i in range(4)] + [(300, None, None, 99.5), (301, float("inf"), None, None), (7, 1.0, None, 2.0)]  # far off; an id twice
    want, open_ = {}, set()
    for t in range(3):
        near = {}
        for i, *x in rows:
            if x[t] is None:
                for j, *y in rows:
                    both = [c for c in range(3) if x[c] is not None and y[c] is not None]
                    if y[t] is not None and both and np.isfinite([*(x[c] for c in both), *(y[c] for c in both)]).all():
                        near.setdefault(i, []).append((sum((x[c] - y[c]) ** 2 for c in both) * 3 / len(both), j, y[t]))
        for i, found in near.items():
            top = sorted(found)[:k]
            zero = [v for s, _, v in top if s == 0]
            if len(zero) < (1 if weight == "distance" else k):
                open_.add(i)
            w = [1.0 if weight == "uniform" else float(s == 0) if zero else 1 / np.sqrt(s) for s, _, _ in top]
            want[i, t] = sum(a * v for a, (_, _, v) in zip(w, top, strict=True)) / sum(w)
    asked, plain_nearest = [], knn.nearest

    def watched(queries, *args, **kwargs):
        asked.extend(r["id"] for r in queries.select("id").distinct().collect())
        return plain_nearest(queries, *args, **kwargs)

    monkeypatch.setattr(knn, "nearest", watched)
    df = spark.createDataFrame(rows, "id long, u double, v double, w double")
    means = [np.mean([r[t + 1] for r in rows if r[t + 1] is not None]) for t in range(3)]
    out = knn.impute_knn(df, "id", cols, k=k, weight=weight).collect()
    assert len(out) == len(rows) and set(asked) == open_ and 300 in open_ and len(open_) < 110
    given = {(i, t): x[t] for i, *x in rows for t in range(3) if i != 7}
    for r in out:
        if r["id"] != 7:
            for t, c in enumerate(cols):
                value = given[r["id"], t]
                assert r[c] == pytest.approx(value if value is not None else want.get((r["id"], t), means[t])), (r, c)
