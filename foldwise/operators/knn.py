"""Exact nearest neighbours by a pivot-partitioned join, and what rests on it: the kNN imputer (I8), the kNN
classifier (M6) and ADASYN oversampling (D10).

``nearest`` finds each query's k nearest donors by Euclidean distance, ties to the smaller donor id. Donors are
dealt to the cell of their nearest pivot; a cell's radius and its k smallest distances to the pivot are the only
statistics. Small cells are put together into groups of up to ``BLOCK_ROWS`` donors. A query first meets the donors
of its own cell's group. Its k-th distance there, or the k-th smallest of (distance to a pivot + a donor's distance to
that pivot), whichever is less, is a proven bound; the query then goes only to those other groups with a cell that can
hold something nearer, by the triangle inequality and by the plane between two pivots. So the answer is exact, and
how many groups a query visits depends on the data: in many dimensions, where distances hardly differ, it may be most
of them, and the pairs then grow with the square of the rows, at one matrix product's price each.

Groups of many donors or queries are cut into blocks by a hash of the id, and each two blocks meet in a task of their
own, which returns k rows a query at most: no pairs are emitted, nothing is capped, and a hot cell is many tasks. In a
task donors and queries lie in order of one coordinate, and only those strips of donors are looked at that the bounds
reach. The driver holds at most ``PIVOTS`` pivots and as many cell statistics for each space.

Rows only meet inside their ``space`` (a null pattern, a fold, a class). Rows whose vector is null or holds a null or
non-finite component take no part.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from foldwise.functions.hashing import uniform
from foldwise.operators.lookup import local_table
from foldwise.operators.ordering import with_global_rank
from foldwise.session import cut_lineage, stored

PIVOTS, CELL_ROWS, BLOCK_ROWS, PAIRS = 1000, 1024, 16384, 2_000_000  # up to 1000 a space Spark picks before the shuffle, too
NEAR_PAIRS = 65_536  # distances that stay in a core's cache
STRIPS = (256, 1024), (512, 4096)  # queries and donors looked at together, in few (8 at most) and in many dimensions


def vector(cols: list) -> Column:
    return F.array(*[(F.col(c) if isinstance(c, str) else c).cast("double") for c in cols])


def _sound(df: DataFrame) -> DataFrame:
    bad = F.exists("x", lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf")))
    return df.where(F.col("x").isNotNull() & ~F.coalesce(bad, F.lit(False)) & F.col("id").isNotNull() & F.col("space").isNotNull())


def _squares(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Squared distances of all rows of a to all of b, summed component after component."""
    out = np.zeros((len(a), len(b)))
    for i in range(a.shape[1]):
        step = np.subtract.outer(a[:, i], b[:, i])
        step *= step
        out += step
    return out


def _matrix(rows: pd.Series) -> np.ndarray:
    return np.stack(rows.to_numpy()).astype(np.float64)


def _pivots(donors: DataFrame, seed: int) -> dict[str, np.ndarray]:
    """Distinct donors drawn by a hash of their id: one for ``CELL_ROWS`` donors of a space, ``PIVOTS`` at most."""
    sizes = {r["space"]: r["n"] for r in donors.groupBy("space").agg(F.count(F.lit(1)).alias("n")).collect()}
    if not sizes:
        return {}
    most = min(PIVOTS, max(-(-n // CELL_ROWS) for n in sizes.values()))
    ranked = donors.select("space", "x", F.row_number().over(Window.partitionBy("space").orderBy(uniform("id", seed=seed), "id")).alias("_at")).where(F.col("_at") <= most)
    found: dict[str, list] = {}
    for r in ranked.collect():
        if r["_at"] <= -(-sizes[r["space"]] // CELL_ROWS):
            found.setdefault(r["space"], []).append(tuple(r["x"]))
    return {s: np.array(sorted(set(x)), dtype=np.float64) for s, x in found.items()}


def _celled(donors: DataFrame, pivots: dict, shape: str) -> DataFrame:
    """Adds ``cell`` and ``r``, the distance to its pivot."""

    def run(batches):
        for rows in batches:
            cell, r = np.zeros(len(rows), dtype=np.int64), np.zeros(len(rows))
            for space, at in rows.groupby("space").indices.items():
                x, step = _matrix(rows["x"].iloc[at]), max(1, NEAR_PAIRS // len(pivots[space]))
                for lo in range(0, len(at), step):
                    away, some = np.sqrt(_squares(x[lo : lo + step], pivots[space])), at[lo : lo + step]
                    cell[some] = away.argmin(axis=1)
                    r[some] = away[np.arange(len(some)), cell[some]]
            yield rows.assign(cell=cell, r=r)

    return donors.mapInPandas(run, f"{shape}, cell long, r double")


def _statistics(celled: DataFrame, k: int) -> dict:
    """{space: (radius of each cell, its k smallest distances, its rows)}: a few numbers for each pivot."""
    by = Window.partitionBy("space", "cell").orderBy("r")
    cells = celled.groupBy("space", "cell").agg(F.max("r").alias("radius"), F.count(F.lit(1)).alias("n")).collect()
    low = celled.select("space", "cell", "r", F.row_number().over(by).alias("_at")).where(F.col("_at") <= k).collect()
    out: dict[str, tuple[dict, dict, dict]] = {}
    for x in cells:
        own = out.setdefault(x["space"], ({}, {}, {}))
        own[0][x["cell"]], own[2][x["cell"]] = x["radius"], x["n"]
    for x in low:
        out[x["space"]][1].setdefault(x["cell"], []).append(x["r"])
    return out


def _groups(stats: dict) -> dict:
    """{space: {cell: (group, blocks of the group)}}: cells next to each other, ``BLOCK_ROWS`` rows or one cell a group."""
    out = {}
    for space, (_, _, rows) in stats.items():
        packs: list[list] = []
        for cell in sorted(rows):
            if not packs or packs[-1][1] + rows[cell] > BLOCK_ROWS:
                packs.append([[], 0])
            packs[-1][0].append(cell)
            packs[-1][1] += rows[cell]
        out[space] = {c: (g, -(-n // BLOCK_ROWS)) for g, (cells, n) in enumerate(packs) for c in cells}
    return out


class _Space:
    """What queries need of a space: pivots, radii and distances between the pivots that have donors."""

    def __init__(self, pivots: np.ndarray, stats: tuple, groups: dict, k: int):
        radius, low, _ = stats
        cells = sorted(radius)
        self.k, self.centres, self.radius = k, pivots[cells], np.array([radius[c] for c in cells])
        self.low = np.array([(sorted(low[c]) + [np.inf] * k)[:k] for c in cells])
        self.apart = np.sqrt(_squares(self.centres, self.centres))
        self.group = np.array([groups[c][0] for c in cells])  # does not fall from cell to cell
        self.first = np.flatnonzero(np.diff(self.group, prepend=-1))

    def reach(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Of each query: its own group, a bound of its k-th distance, and the least distance of a donor in each group."""
        away, every = np.sqrt(_squares(x, self.centres)), np.arange(len(x))
        own = away.argmin(axis=1)
        few = min(self.k, away.shape[1])  # no cell is empty, so that these have k donors, if there are so many cells
        near = np.argpartition(away, few - 1, axis=1)[:, :few]
        sums = (np.take_along_axis(away, near, axis=1)[:, :, None] + self.low[near]).reshape(len(x), -1)
        bound = np.partition(sums, self.k - 1, axis=1)[:, self.k - 1]
        apart, nearest = self.apart[own], away[every, own][:, None]
        with np.errstate(invalid="ignore", divide="ignore"):
            plane = np.where(apart > 1e-6 * away, (away - nearest) * (away + nearest) / (2 * apart), 0.0)
        least = np.maximum(away - self.radius[None, :], plane) - 1e-9 * away  # rounding never hides a donor
        return self.group[own], bound, np.minimum.reduceat(least, self.first, axis=1)


def _visits(queries: DataFrame, pivots: dict, stats: dict, k: int, first: bool) -> DataFrame:
    """One row for each group that a query goes to: its own, or the others within ``bound``."""
    groups = _groups(stats)

    def run(batches):
        spaces: dict[str, _Space] = {}
        for rows in batches:
            rows = rows.reset_index(drop=True)
            for space, at in rows.groupby("space").indices.items():
                if space not in stats:
                    continue
                if space not in spaces:
                    spaces[space] = _Space(pivots[space], stats[space], groups[space], k)
                step = max(1, PAIRS // len(pivots[space]))
                for lo in range(0, len(at), step):
                    part = rows.iloc[at[lo : lo + step]]
                    own, bound, least = spaces[space].reach(_matrix(part["x"]))
                    if first:
                        yield part[["space", "id", "x"]].assign(grp=own, bound=bound)
                        continue
                    bound = np.minimum(bound, part["bound"].to_numpy())
                    limit = bound * (1 + 1e-9) + 1e-300
                    q, g = np.nonzero((least <= limit[:, None]) & (np.arange(least.shape[1])[None, :] != own[:, None]))
                    yield part[["space", "id", "x"]].iloc[q].assign(grp=g, bound=bound[q])

    return queries.mapInPandas(run, "space string, id long, x array<double>, grp long, bound double")


def _needed(points: np.ndarray, donor: np.ndarray, k: int) -> np.ndarray:
    """Places of the donors but those that k + 1 others with the same vector and smaller ids stand before. ``donor`` is sorted."""
    _, same = np.unique(points, axis=0, return_inverse=True)
    same = same.ravel()
    order = np.lexsort((donor, same))
    new_vector = np.diff(same[order], prepend=-1) != 0
    new_id = new_vector | (np.diff(donor[order], prepend=donor[order[0]]) != 0)
    ids = np.cumsum(new_id)
    before = ids - np.maximum.accumulate(np.where(new_vector, ids, 0))
    return np.sort(order[before <= k])


def _closest(x: np.ndarray, own: np.ndarray, limit: np.ndarray, points: np.ndarray, donor: np.ndarray, k: int, itself: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The k nearest donors of each query among those within ``limit`` (a square): place of the query, place of the
    donor, square. A matrix product, with a margin for its rounding, says which pairs are worth an exact square."""
    dims, parts = points.shape[1], []
    many, wide = STRIPS[dims > 8]
    with np.errstate(over="ignore", invalid="ignore"):
        axis = int(np.ptp(points, axis=0).argmax())
        centre = points.mean(axis=0)
        at_q, at_p = np.argsort(x[:, axis], kind="stable"), np.argsort(points[:, axis], kind="stable")
        mid_q, mid_p = x - centre, (points - centre)[at_p]
        if dims > 8 and max(np.abs(mid_q).max(), np.abs(mid_p).max()) < 1e12:
            mid_q, mid_p = mid_q.astype(np.float32), mid_p.astype(np.float32)  # half the time, and a wider margin
        sq_q, sq_p = (mid_q * mid_q).sum(axis=1), (mid_p * mid_p).sum(axis=1)
    rounding = 4 * (dims + 16) * np.finfo(mid_q.dtype).eps
    sound = float(sq_q.max()) < 1e300 and float(sq_p.max()) < 1e300  # else no product can be trusted, and each pair counts
    line, points, donor = points[at_p, axis], points[at_p], donor[at_p]
    starts = np.arange(0, len(points), wide)
    low, high = line[starts], line[np.minimum(starts + wide, len(line)) - 1]
    for lo in range(0, len(x), many):
        rows = at_q[lo : lo + many]
        xq, ids, lim = x[rows], own[rows], limit[rows].copy()
        with np.errstate(over="ignore"):
            gap = np.maximum(np.maximum(low - xq[-1, axis], xq[0, axis] - high), 0.0) ** 2
        best = np.empty(0, dtype=np.int64), np.empty(0, dtype=np.int64), np.empty(0)
        for c in np.argsort(gap, kind="stable"):
            if gap[c] > lim.max() * (1 + 1e-9):
                break
            part = slice(starts[c], starts[c] + wide)
            if sound:
                about = mid_q[rows] @ mid_p[part].T
                about *= -2.0
                about += sq_p[part][None, :]
                about += sq_q[rows][:, None]
                margin = rounding * (np.sqrt(sq_q[rows].astype(np.float64)) + np.sqrt(float(sq_p[part].max()))) ** 2 + 1e-30
                if np.isinf(lim).any() and about.shape[1] >= k:
                    others = about if itself else np.where(ids[:, None] == donor[part][None, :], np.inf, about)
                    lim = np.minimum(lim, np.partition(others, k - 1, axis=1)[:, k - 1] + margin)
                edge = (lim + margin).astype(about.dtype) * about.dtype.type(1 + 1e-6)
                r, p = np.divmod(np.flatnonzero(about <= edge[:, None]), about.shape[1])
            else:
                r, p = (i.ravel() for i in np.indices((len(rows), len(points[part]))))
            p = p + starts[c]
            if not itself:
                other = ids[r] != donor[p]
                r, p = r[other], p[other]
            square = np.zeros(len(r))
            with np.errstate(over="ignore"):
                for i in range(dims):
                    step = xq[r, i] - points[p, i]
                    square += step * step
            kept = (square <= lim[r]) & np.isfinite(square)
            if not kept.any():
                continue
            r, p, square = (np.concatenate([a, b[kept]]) for a, b in zip(best, (r, p, square), strict=True))
            order = np.lexsort((donor[p], square, r))
            r, p, square = r[order], p[order], square[order]
            place = np.arange(len(r)) - np.searchsorted(r, r)
            top = place < k
            best = r[top], p[top], square[top]
            full = place == k - 1
            lim[r[full]] = np.minimum(lim[r[full]], square[full])
        parts.append((rows[best[0]], at_p[best[1]], best[2]))
    return tuple(np.concatenate(c) for c in zip(*parts, strict=True))


def _tiles(visits: DataFrame, donors: DataFrame, k: int, payload: str, itself: bool) -> DataFrame:
    """The k nearest donors, within its bound, of each query in each block that it visits."""
    asked = visits.groupBy("space", "grp").agg(F.ceil(F.count(F.lit(1)) / BLOCK_ROWS).cast("int").alias("asked"))
    both = donors.groupBy("space", "grp").agg(F.max("blocks").alias("blocks")).join(asked, ["space", "grp"])
    upto = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    dealt = lambda n, salt: F.pmod(F.xxhash64("id", F.lit(salt)), F.col(n)).cast("int")
    left = visits.join(both, ["space", "grp"]).withColumn("a", dealt("asked", 1)).withColumn("b", upto("blocks")).select("space", "grp", "a", "b", "id", "x", "bound")
    right = donors.drop("blocks").join(both, ["space", "grp"]).withColumn("b", dealt("blocks", 2)).withColumn("a", upto("asked"))
    right = right.select("space", "grp", "a", "b", F.col("id").alias("donor"), F.col("x").alias("dx"), "payload")
    names = ["space", "id", "donor", "square", "payload"]

    def run(asking: pd.DataFrame, base: pd.DataFrame) -> pd.DataFrame:
        if not len(asking) or not len(base):
            return pd.DataFrame({n: [] for n in names})
        base = base.sort_values("donor", kind="stable")
        points = _matrix(base["dx"])
        need = _needed(points, base["donor"].to_numpy(), k)
        points, base = points[need], base.iloc[need]
        with np.errstate(over="ignore"):
            limit = (asking["bound"].to_numpy() * (1 + 1e-9) + 1e-150) ** 2
        rows, found, square = _closest(_matrix(asking["x"]), asking["id"].to_numpy(), limit, points, base["donor"].to_numpy(), k, itself)
        own, asker = base.iloc[found], asking.iloc[rows]
        return pd.DataFrame({"space": asker["space"].to_numpy(), "id": asker["id"].to_numpy(), "donor": own["donor"].to_numpy(), "square": square, "payload": own["payload"].to_numpy()})

    key = ["space", "grp", "a", "b"]
    return left.groupBy(*key).cogroup(right.groupBy(*key)).applyInPandas(run, f"space string, id long, donor long, square double, payload {payload}")


def nearest(queries: DataFrame, donors: DataFrame, k: int, payload: str = "double", itself: bool = False, seed: int = 42) -> DataFrame:
    """``queries``: ``space`` (string), ``id`` (long), ``x`` (array<double>). ``donors``: the same and ``payload`` of the SQL
    type named. Returns ``space``, ``id``, ``donor``, ``square`` (squared distance), ``payload``, ``rank`` (from 1). A query
    finds a donor of its own id only with ``itself``. Fewer than k donors: all of them; none: no row."""
    shape = f"space string, id long, x array<double>, payload {payload}"
    donors = cut_lineage(_sound(donors.select("space", F.col("id").cast("long").alias("id"), "x", F.col("payload").cast(payload).alias("payload"))))
    queries = _sound(queries.select("space", F.col("id").cast("long").alias("id"), "x"))
    pivots = _pivots(donors, seed)
    order = Window.partitionBy("space", "id").orderBy("square", "donor")
    if not pivots:
        return donors.join(queries.select("id"), "id").select("space", "id", F.col("id").alias("donor"), F.lit(0.0).alias("square"), "payload", F.lit(1).alias("rank")).limit(0)
    celled = cut_lineage(_celled(donors, pivots, shape))
    stats = _statistics(celled, k + 1)  # one of them may be the query itself
    named = [(space, cell, g, n) for space, cells in _groups(stats).items() for cell, (g, n) in cells.items()]
    dealt = celled.join(F.broadcast(local_table(celled.sparkSession, named, "space string, cell long, grp long, blocks int")), ["space", "cell"]).select("space", "grp", "blocks", "id", "x", "payload")
    asking = cut_lineage(_visits(queries, pivots, stats, k + 1, True))
    best = lambda rows: rows.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    near = cut_lineage(best(_tiles(asking, dealt, k, payload, itself)))
    reached = near.where(F.col("rank") == k).select("space", "id", F.sqrt("square").alias("kth"))
    bounded = asking.drop("grp").join(reached, ["space", "id"], "left").withColumn("bound", F.least("bound", F.coalesce("kth", F.lit(float("inf"))))).drop("kth")
    more = _tiles(cut_lineage(_visits(bounded, pivots, stats, k + 1, False)), dealt, k, payload, itself)
    return best(near.drop("rank").unionByName(more))


def weights(found: DataFrame, square: str = "square") -> DataFrame:
    """Adds ``w`` = 1 / distance; where a query (``space``, ``id``) has neighbours at distance 0, they alone count, alike."""
    zero = F.max(F.when(F.col(square) == 0, 1).otherwise(0)).over(Window.partitionBy("space", "id"))
    return found.withColumn("_zero", zero).withColumn("w", F.when(F.col("_zero") == 1, (F.col(square) == 0).cast("double")).otherwise(1 / F.sqrt(square))).drop("_zero")


# ---- I8: kNN imputer -------------------------------------------------------------------------------

def _equal_rows(lack: DataFrame, have: DataFrame, cols: list[str], spaces: list[tuple], k: int, need: int) -> DataFrame:
    """One row for each id of ``lack``: ``_open``, the bits of its missing columns that fewer than ``need`` donors at distance 0
    settle, and ``_fill_`` of each other one: the mean of its ``k`` (or all, if fewer) such donors of the smallest ids.

    Donors at distance 0 are equal in all common columns, so that a join by those finds them. Of the donors of one vector only
    the ``k`` of the smallest ids can be wanted; they are picked before the shuffle, too."""
    places = sorted({s[1:] for s in spaces})  # column to fill, common columns, columns of the donor
    pick = lambda at: F.element_at(F.array(*[F.lit(p[at]) for p in places]), F.col("_place") + 1)
    keys = [f"_key{i}" for i in range(len(cols))]

    def side(rows: DataFrame, pairs: dict[int, set]) -> DataFrame:
        table = F.create_map(*[y for has, at in sorted(pairs.items()) for y in (F.lit(has), F.array(*[F.lit(p) for p in sorted(at)]))])
        out = rows.where(F.col("id").isNotNull() & F.col("has").isin(sorted(pairs))).withColumn("_place", F.explode(F.element_at(table, F.col("has"))))
        shared = [pick(1).bitwiseAND(F.lit(1 << i)) != 0 for i in range(len(cols))]
        out = out.withColumns({key: F.when(on, F.col(c)).otherwise(0.0) for key, on, c in zip(keys, shared, cols, strict=True)})
        return out.where(" AND ".join(f"abs({key}) < double('infinity')" for key in keys))

    asked, given = {}, {}
    for q, *place in spaces:
        at = places.index(tuple(place))
        asked.setdefault(q, set()).add(at)
        given.setdefault(place[2], set()).add(at)
    value = F.element_at(F.array(*[F.col(c) for c in cols]), pick(0) + 1)
    donors = side(have, given).select("_place", *keys, F.col("id").alias("donor"), value.alias("payload"))
    order = Window.partitionBy("_place", *keys).orderBy("donor", "payload")
    first = donors.withColumn("_at", F.row_number().over(order)).where(F.col("_at") <= k)
    lists = first.groupBy("_place", *keys).agg(F.collect_list(F.struct("donor", "payload")).alias("near"))  # k at most
    queries = side(lack, asked).select("id", "_place", pick(0).alias("_i"), *keys)
    met = queries.join(lists, ["_place", *keys], "left")
    near = met.groupBy("id").agg(*[F.max(F.col("_i") == i).alias(f"_ask{i}") for i in range(len(cols))],
                                 *[F.flatten(F.collect_list(F.when(F.col("_i") == i, F.col("near")))).alias(f"_near{i}") for i in range(len(cols))])  # a list for each space
    settled = [F.size(f"_near{i}") >= need for i in range(len(cols))]
    total = lambda i: F.aggregate(F.slice(F.array_sort(f"_near{i}"), 1, k), F.lit(0.0), lambda a, d: a + d["payload"])
    still = sum((F.when(F.col(f"_ask{i}") & ~settled[i], 1 << i).otherwise(0) for i in range(len(cols))), F.lit(0)).cast("long")
    return near.select("id", still.alias("_open"), *[F.when(settled[i], total(i) / F.least(F.size(f"_near{i}"), F.lit(k))).alias(f"_fill_{c}") for i, c in enumerate(cols)])


def impute_knn(df: DataFrame, id_col: str, cols: list[str], fitted: DataFrame | None = None, k: int = 5, weight: str = "distance") -> DataFrame:
    """Fills each missing number from the ``k`` rows of ``fitted`` (default: ``df``) that have it and are nearest.

    The distance is over the columns that both rows have, scaled by all columns over those; weights are 1 / distance
    ("distance") or alike ("uniform"). NaN counts as missing. Where no row shares a column with the one to be filled,
    the column's mean is taken; a column that ``fitted`` never has stays as it is. ``id_col`` must be unique and whole
    numbers. Each combination of present columns is a space of its own: there are at most 2^columns of them, and as a
    rule few; donors are copied once for each combination of missing columns that occurs.

    Nothing is nearer than a donor at distance 0, and with "distance" such donors alone count. So a join finds those first, and
    only what they leave open is searched for by ``nearest``.
    """
    names = [f"_col{i}" for i in range(len(cols))]
    clean = {c: F.when(~F.isnan(F.col(c).cast("double")), F.col(c).cast("double")) for c in cols}
    bits = lambda: sum((F.when(F.col(c).isNotNull(), 1 << i).otherwise(0) for i, c in enumerate(names)), F.lit(0)).cast("long")
    rows_of = lambda rows: stored(rows.select(F.col(id_col).cast("long").alias("id"), *[v.alias(n) for n, v in zip(names, clean.values(), strict=True)]).withColumn("has", bits()))
    have = rows_of(df if fitted is None else fitted)
    lack = have if fitted is None else rows_of(df)
    every = (1 << len(cols)) - 1
    seen = have.agg(F.collect_set("has").alias("has"), *[F.avg(n).alias(n) for n in names]).first()  # a few patterns
    means, given = {c: seen[n] for c, n in zip(cols, names, strict=True)}, seen["has"]
    asked = [q for q in (given if fitted is None else lack.agg(F.collect_set("has")).first()[0]) if q != every]
    spaces = [(q, i, q & g, g) for q in asked for i in range(len(cols)) if not q >> i & 1 for g in given if g >> i & 1 and q & g]
    if not spaces:
        return df.withColumns({c: F.coalesce(clean[c], F.lit(means[c])) for c in cols})

    def side(rows: DataFrame, pairs: dict[int, list], extra) -> DataFrame:
        table = F.create_map(*[y for has, named in pairs.items() for y in (F.lit(has), F.array(*[F.lit(n) for n in sorted(named)]))])
        out = rows.where(F.col("has").isin(list(pairs))).withColumn("space", F.explode(F.element_at(table, F.col("has"))))
        parts = F.split("space", ":")
        out = out.withColumn("_i", parts[1].cast("int")).withColumn("_common", parts[2].cast("long"))
        x = F.array_compact(F.array(*[F.when(F.col("_common").bitwiseAND(F.lit(1 << i)) != 0, F.col(c)) for i, c in enumerate(names)]))
        return out.select("space", "id", x.alias("x"), *extra)

    name = lambda s: f"{s[0]}:{s[1]}:{s[2]}"
    filled = stored(_equal_rows(lack, have, names, spaces, k, 1 if weight == "distance" else k))
    left = lack.join(filled.where(F.col("_open") != 0).select("id", "_open"), "id")
    wanted = {(r["has"], i) for r in left.select("has", "_open").distinct().collect() for i in range(len(cols)) if r["_open"] >> i & 1}
    fills = [F.col(f"_fill_{n}") for n in names]
    spaces = [s for s in spaces if s[:2] in wanted]
    if spaces:
        queries = side(left, {q: {name(s) for s in spaces if s[0] == q} for q in {s[0] for s in spaces}}, ["_i", "_open"])
        queries = queries.where(F.expr("shiftright(_open, _i) & 1") == 1).drop("_i", "_open")
        value = F.element_at(F.array(*[F.col(c) for c in names]), F.col("_i") + 1).alias("payload")
        donors = side(have, {g: {name(s) for s in spaces if s[3] == g} for g in {s[3] for s in spaces}}, [value])
        found = nearest(queries, donors, k, itself=True)  # a donor has what the query lacks: an equal id is another table's
        target, common = F.split("space", ":")[1].cast("int"), F.split("space", ":")[2].cast("long")
        found = found.select(target.cast("string").alias("space"), "id", "donor", "payload", (F.col("square") * len(cols) / F.bit_count(common)).alias("square"))
        found = found.withColumn("_at", F.row_number().over(Window.partitionBy("space", "id").orderBy("square", "donor"))).where(F.col("_at") <= k)
        found = weights(found) if weight == "distance" else found.withColumn("w", F.lit(1.0))
        rest = found.groupBy("id").agg(*[
            (F.sum(F.when(F.col("space") == str(i), F.col("w") * F.col("payload"))) / F.sum(F.when(F.col("space") == str(i), F.col("w")))).alias(f"_rest_{n}")
            for i, n in enumerate(names)
        ])
        filled = filled.join(rest, "id", "left")
        fills = [F.coalesce(f"_fill_{n}", f"_rest_{n}") for n in names]
    filled = filled.select(F.col("id").alias("_knn_id"), *[v.alias(f"_fill{i}") for i, v in enumerate(fills)])
    out = df.join(filled, F.col(id_col).cast("long") == F.col("_knn_id"), "left")
    return out.withColumns({c: F.coalesce(clean[c], F.col(f"_fill{i}"), F.lit(means[c])) for i, c in enumerate(cols)}).select(*df.columns)


# ---- M6: kNN classifier ----------------------------------------------------------------------------

def knn_classify(rows: DataFrame, train: DataFrame, id_col: str, x: Column, label: str, k: int = 5, weight: str = "uniform",
                 fold: str | None = None) -> DataFrame:
    """``id``, ``label``, ``votes`` (share of the vote) of each label that a row's ``k`` nearest training rows have, and
    ``predicted``: the label with most votes, ties to the smallest. With ``fold`` a row's candidates are the training rows of
    all other folds (out-of-fold prediction in one job); without, all but the row itself. Labels are strings here."""
    name, own = F.col(label).cast("string"), F.col(id_col).cast("long")
    if fold is None:
        queries = rows.select(F.lit("all").alias("space"), own.alias("id"), x.alias("x"))
        donors = train.select(F.lit("all").alias("space"), own.alias("id"), x.alias("x"), name.alias("payload"))
    else:
        folds = [r[0] for r in rows.select(F.col(fold).cast("string")).distinct().collect() if r[0] is not None]  # one of each fold
        queries = rows.select(F.col(fold).cast("string").alias("space"), own.alias("id"), x.alias("x"))
        others = F.array_remove(F.array(*[F.lit(f) for f in sorted(folds)]), F.col(fold).cast("string"))
        donors = train.select(F.explode(others).alias("space"), own.alias("id"), x.alias("x"), name.alias("payload"))
    found = nearest(queries, donors.where(F.col("payload").isNotNull()), k, "string")
    found = weights(found) if weight == "distance" else found.withColumn("w", F.lit(1.0))
    votes = found.groupBy("id", F.col("payload").alias("label")).agg(F.sum("w").alias("w"))
    each = Window.partitionBy("id")
    votes = votes.withColumn("votes", F.col("w") / F.sum("w").over(each))
    first = F.first("label").over(each.orderBy(F.desc("votes"), "label"))
    return votes.withColumn("predicted", first).select("id", "label", "votes", "predicted")


# ---- D10: ADASYN -----------------------------------------------------------------------------------

def adasyn_hardness(df: DataFrame, id_col: str, x: Column, label: str, targets: dict[str, int], k: int = 5) -> DataFrame:
    """Of each row of a class in ``targets`` (class as string -> rows wanted): ``n_other`` of its ``k`` nearest rows
    that have another label, its ``share`` of the class's hardness, and ``n_new``, its number of new rows.

    Shares times rows to be made are rounded down, and what is left goes one each to the largest remainders, ties to
    the smaller id, so that each class gets exactly its number. A class none of whose rows has a stranger near has
    equal shares. Classes that have enough rows already get none."""
    own, name = F.col(id_col).cast("long"), F.col(label).cast("string")
    rows = df.select(F.lit("all").alias("space"), own.alias("id"), x.alias("x"), name.alias("payload")).where(F.col("payload").isNotNull())
    queries = rows.where(F.col("payload").isin(sorted(targets)))
    found = nearest(queries, rows, k, "string").groupBy("id").agg(F.collect_list("payload").alias("near"))  # k at most
    hard = _sound(queries).join(found, "id", "left").select(
        "id", F.col("payload").alias("label"), F.size(F.filter(F.coalesce("near", F.array().cast("array<string>")), lambda p: p != F.col("payload"))).alias("n_other")
    )
    hard = cut_lineage(hard)
    totals = {r["label"]: (r["n"], r["s"]) for r in hard.groupBy("label").agg(F.count(F.lit(1)).alias("n"), F.sum("n_other").alias("s")).collect()}  # a class each
    pick = lambda values: F.element_at(F.create_map(*[F.lit(v) for kv in values.items() for v in kv]), F.col("label"))
    if not totals:
        return hard.select("id", "label", "n_other", F.lit(0.0).alias("share"), F.lit(0).cast("long").alias("n_new"))
    wanted = {c: max(0, targets[c] - n) for c, (n, _) in totals.items()}
    share = F.when(pick({c: s for c, (_, s) in totals.items()}) > 0, F.col("n_other") / pick({c: s for c, (_, s) in totals.items()})).otherwise(1.0 / pick({c: n for c, (n, _) in totals.items()}))
    shared = hard.withColumn("share", share).withColumn("_exact", F.col("share") * pick(wanted)).withColumn("_floor", F.floor(F.col("_exact") + 1e-9))
    shared = shared.withColumn("_rest", F.round(F.greatest(F.col("_exact") - F.col("_floor"), F.lit(0.0)), 9))
    ranked = cut_lineage(with_global_rank(shared, ["label", -F.col("_rest"), "id"], "_at"))
    left = {r["label"]: (r["start"], wanted[r["label"]] - r["given"]) for r in ranked.groupBy("label").agg(F.min("_at").alias("start"), F.sum("_floor").alias("given")).collect()}
    more = F.col("_at") - pick({c: s for c, (s, _) in left.items()}) < pick({c: m for c, (_, m) in left.items()})
    return ranked.select("id", "label", "n_other", "share", (F.col("_floor") + more.cast("long")).alias("n_new"))


def oversample_adasyn(df: DataFrame, id_col: str, x: Column, label: str, targets: dict[str, int], k: int = 5, seed: int = 42) -> DataFrame:
    """The new rows: ``id`` (of the row they start from), ``copy`` (from 0), ``label``, ``toward`` (the neighbour of the same
    class), ``step`` (from 0 to 1) and ``x``. Neighbour and step come from a hash of id, copy and seed, so that they do not
    hang on partitions. A row alone in its class is copied as it is."""
    hard = adasyn_hardness(df, id_col, x, label, targets, k).where(F.col("n_new") > 0).select("id", "label", "n_new")
    name = F.col(label).cast("string")
    rows = df.select(name.alias("space"), F.col(id_col).cast("long").alias("id"), x.alias("x"), F.col(id_col).cast("string").alias("payload"))
    own = rows.where(F.col("space").isin(sorted(targets)))
    found = nearest(own.join(hard.select("id"), "id"), own, k, "string").select("id", F.struct("rank", "donor").alias("n"))
    near = found.groupBy("id").agg(F.sort_array(F.collect_list("n")).alias("near"))  # k at most
    made = hard.join(near, "id", "left").withColumn("copy", F.explode(F.sequence(F.lit(0), F.col("n_new").cast("int") - 1)))
    place = F.floor(uniform("id", "copy", seed=seed) * F.size("near")).cast("int")
    made = made.withColumn("toward", F.when(F.col("near").isNull(), F.col("id")).otherwise(F.element_at("near", place + 1)["donor"])).withColumn("step", uniform("id", "copy", seed=seed + 1))
    start, end = own.select("id", F.col("x").alias("_a")), own.select(F.col("id").alias("toward"), F.col("x").alias("_b"))
    mixed = F.zip_with("_a", "_b", lambda a, b: a + (b - a) * F.col("step"))
    return made.join(start, "id").join(end, "toward").select("id", "copy", "label", "toward", "step", mixed.alias("x"))
