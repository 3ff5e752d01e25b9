"""Sparse one-hot rows and level counts: equal to the dense forms, and past their width."""

from collections import Counter, defaultdict

import pytest

from foldwise.operators import encode
from foldwise.operators.sparse import fit_sparse_levels, one_hot_sparse, sparse_counts

ROWS = [(1, "b", "x"), (2, "a", None), (3, None, "y"), (4, None, None), (5, "c", "x"), (5, "c", "x"), (None, "a", "y")]


@pytest.mark.parametrize("drop_first", [False, True])
def test_same_as_dense_columns(spark, drop_first):
    df = spark.createDataFrame(ROWS, "id long, c string, d string")
    st = fit_sparse_levels(df, ["c", "d"], drop_first)
    levels = encode.collect_levels(df, ["c", "d"])
    names = [f"{c}_{v}" for c in levels for v in (levels[c][1:] if drop_first else levels[c])]
    rows = one_hot_sparse(encode.one_hot(df, levels, drop_first), st).collect()
    assert len(rows) == len(ROWS) and st.size == len(names)
    for r in rows:
        assert r["one_hot"]["size"] == len(names) and r["one_hot"]["indices"] == [k for k, n in enumerate(names) if r[n] == 1]
    unseen = one_hot_sparse(spark.createDataFrame([(9, "new", "x")], df.schema), st).first()["one_hot"]
    assert len(unseen["indices"]) == (0 if drop_first else 1)
    assert fit_sparse_levels(df.limit(0), ["c", "d"], drop_first).size == 0


def test_twenty_thousand_levels_and_a_hot_entity(spark):
    n = 20_000
    child = spark.range(3 * n).selectExpr("if(id % 3 = 0, 7, id % 100) AS k", f"concat('v', id % {n}) AS v", "if(id % 2 = 0, 'p-q', 'p q') AS w")
    st = fit_sparse_levels(child, ["v", "w"], clean=True)
    assert st.size == n + 1  # 'p-q' and 'p q' are one cleaned level
    with pytest.raises(ValueError):
        encode.collect_levels(child, ["v"])
    place = {v: k for k, v in enumerate(sorted(f"v{i}" for i in range(n)))}
    want = defaultdict(Counter)
    for i in range(3 * n):
        want[7 if i % 3 == 0 else i % 100].update([place[f"v{i % n}"], n])
    rows = sparse_counts(child, "k", st).collect()
    assert {r["k"]: dict(zip(r["counts"]["indices"], r["counts"]["values"], strict=True)) for r in rows} == want
    assert all(r["counts"]["indices"] == sorted(r["counts"]["indices"]) for r in rows)


def test_entities_without_a_known_level_stay(spark):
    child = spark.createDataFrame(ROWS, "id long, c string, d string")
    st = fit_sparse_levels(child.where("id < 3"), ["c"], clean=True)
    got = {r["id"]: r["counts"]["indices"] for r in sparse_counts(child, "id", st).collect()}
    assert set(got) == {1, 2, 3, 4, 5, None} and got[5] == [] and got[2] == [0]
