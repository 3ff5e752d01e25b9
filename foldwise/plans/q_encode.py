"""Encoders (E1-E10) bound to the entity table (orders x customer x nation)."""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import functions as F

from foldwise.functions.hashing import poisson_weight_sql, uniform_sql
from foldwise.operators import encode as E
from foldwise.plans.bindings import ENTITY_SQL, entity, round_doubles
from foldwise.plans.registry import query

# levels of the test tables, for the SQL side only (Spark fits them from the data)
PRIORITY_LEVELS = ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"]
SEGMENT_LEVELS = ["AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"]
SEED = 42


def _onehot_sql(col, levels):
    return ", ".join(
        f'CASE WHEN {col} = \'{lv}\' THEN 1 ELSE 0 END AS "{col}_{lv}"' for lv in levels[1:]
    )


@query(
    "one_hot",
    sql=f"SELECT ID, o_orderpriority, c_mktsegment, {_onehot_sql('o_orderpriority', PRIORITY_LEVELS)}, "
    f"{_onehot_sql('c_mktsegment', SEGMENT_LEVELS)} FROM {ENTITY_SQL}",
)
def q_one_hot(spark, d):
    e = entity(spark, d, ["ID", "o_orderpriority", "c_mktsegment"])
    levels = E.collect_levels(e, ["o_orderpriority", "c_mktsegment"])
    return E.one_hot(e, levels)


def _codes_sql(col):
    return (
        f"(SELECT {col} AS lvl_{col}, CAST(row_number() OVER (ORDER BY {col}) - 1 AS INTEGER) AS code_{col} "
        f"FROM (SELECT DISTINCT {col} FROM {ENTITY_SQL} WHERE {col} IS NOT NULL))"
    )


@query(
    "label_encode",
    sql=f"""SELECT e.ID, a.code_n_name AS n_name, b.code_c_mktsegment AS c_mktsegment FROM {ENTITY_SQL} e
  LEFT JOIN {_codes_sql('n_name')} a ON e.n_name = a.lvl_n_name
  LEFT JOIN {_codes_sql('c_mktsegment')} b ON e.c_mktsegment = b.lvl_c_mktsegment""",
)
def q_label_encode(spark, d):
    e = entity(spark, d, ["ID", "n_name", "c_mktsegment"])
    for c in ["n_name", "c_mktsegment"]:
        e = E.label_encode(e, c, E.fit_label_encoder(e, c))
    return e


@query(
    "label_decode",
    sql=f"""SELECT e.ID, e.o_orderpriority, a.code_o_orderpriority AS priority_code, a.lvl_o_orderpriority AS priority_decoded
  FROM {ENTITY_SQL} e LEFT JOIN {_codes_sql('o_orderpriority')} a ON e.o_orderpriority = a.lvl_o_orderpriority""",
)
def q_label_decode(spark, d):
    e = entity(spark, d, ["ID", "o_orderpriority"])
    enc = E.fit_label_encoder(e, "o_orderpriority")
    coded = E.label_encode(e, "o_orderpriority", enc, out="priority_code")
    return E.label_decode(coded, "priority_code", enc, "o_orderpriority", "priority_decoded")


@query(
    "frequency_encode",
    sql=f"""SELECT ID, n_name, priority_m,
  round(count(*) OVER (PARTITION BY n_name) / count(*) OVER (), 6) AS n_name_freq,
  CASE WHEN priority_m IS NULL THEN NULL ELSE round(count(*) OVER (PARTITION BY priority_m) / count(*) OVER (), 6) END AS priority_m_freq
  FROM {ENTITY_SQL}""",
)
def q_frequency(spark, d):
    e = entity(spark, d, ["ID", "n_name", "priority_m"])
    for c in ["n_name", "priority_m"]:
        e = E.frequency_encode(e, c, E.fit_frequency(e, c), f"{c}_freq")
    return round_doubles(e)


COMBINE_COLS = ["o_orderpriority", "c_mktsegment", "n_name", "priority_m"]


def _key_sql(a, b):
    return f"concat_ws('_', coalesce(CAST({a} AS VARCHAR), 'nan'), coalesce(CAST({b} AS VARCHAR), 'nan'))"


@query(
    "combine_frequency",
    sql="SELECT ID, "
    + ", ".join(
        f"round(count(*) OVER (PARTITION BY {_key_sql(a, b)}) / count(*) OVER (), 6) AS {a}_{b}"
        for a, b in combinations(COMBINE_COLS, 2)
    )
    + f" FROM {ENTITY_SQL}",
)
def q_combine(spark, d):
    e = entity(spark, d, ["ID", *COMBINE_COLS])
    pairs, enc = E.fit_combine_frequency(e, COMBINE_COLS)
    return round_doubles(E.combine_frequency(e, pairs, enc).drop(*COMBINE_COLS))


# ---- Bayesian target encoders -----------------------------------------------------------------

def _weight_sql(mode, n_samples, f):
    if mode == "expected":
        return "1"
    return poisson_weight_sql(uniform_sql("ID", seed=SEED), n_samples * f)


def _scale_sql(mode, n_samples, f):
    if mode == "expected":
        return f"(floor(n * CAST({f!r} AS DOUBLE)) / n)"
    return f"(1.0 / {n_samples})"


def beta_sql(features, moments, mode="expected", n_samples=50, f=0.8, train_where="TRUE", keep=("ID",), rounded=True):
    rd = (lambda x: f"round({x}, 6)") if rounded else (lambda x: x)
    w = _weight_sql(mode, n_samples, f)
    sc = _scale_sql(mode, n_samples, f)
    ctes = [
        f"e AS (SELECT * FROM {ENTITY_SQL})",
        f"tr AS (SELECT *, {w} AS w FROM e WHERE {train_where})",
        "s AS (SELECT avg(target) AS p, count(*) AS n FROM tr)",
    ]
    sel = [f"e.{k}" for k in keep]
    joins = []
    for name, keys in features.items():
        keys = [keys] if isinstance(keys, str) else keys
        kl = ", ".join(keys)
        nn = " AND ".join(f"{k} IS NOT NULL" for k in keys)
        ctes.append(
            f"l_{name} AS (SELECT {kl}, max(s.p) + max({sc}) * sum(w * target) AS a, "
            f"(1 - max(s.p)) + max({sc}) * sum(w * (1 - target)) AS b FROM tr, s WHERE {nn} GROUP BY {kl})"
        )
        on = " AND ".join(f"e.{k} = l_{name}.{k}" for k in keys)
        joins.append(f"LEFT JOIN l_{name} ON {on}")
        a = f"coalesce(l_{name}.a, (SELECT p FROM s))"
        b = f"coalesce(l_{name}.b, (SELECT 1 - p FROM s))"
        if "mean" in moments:
            sel.append(f"{rd(f'{a} / ({a} + {b})')} AS {name}__M")
        if "variance" in moments:
            sel.append(f"{rd(f'({a} * {b}) / (({a} + {b}) * ({a} + {b}) * ({a} + {b} + 1))')} AS {name}__V")
    return "WITH " + ",\n".join(ctes) + f"\nSELECT {', '.join(sel)} FROM e " + " ".join(joins)


BETA_FEATURES = {"n_name": "n_name", "c_mktsegment": "c_mktsegment", "o_orderpriority": "o_orderpriority"}


def _beta(spark, d, features, moments, mode="expected", n_samples=50, f=0.8, train_filter=None, keep=("ID",)):
    e = entity(spark, d)
    tr = e.where(train_filter) if train_filter is not None else e
    st = E.fit_beta(tr, "target", features, "ID", n_samples=n_samples, sample_size=f, seed=SEED, mode=mode)
    out = E.beta_transform(e, st, moments)
    cols = list(keep) + [f"{n}__M" for n in features if "mean" in moments] + [
        f"{n}__V" for n in features if "variance" in moments
    ]
    return round_doubles(out.select(*cols))


@query("beta_encode_mean", sql=beta_sql(BETA_FEATURES, ("mean",)))
def q_beta_mean(spark, d):
    return _beta(spark, d, BETA_FEATURES, ("mean",))


@query("beta_encode_var", sql=beta_sql(BETA_FEATURES, ("mean", "variance")))
def q_beta_var(spark, d):
    return _beta(spark, d, BETA_FEATURES, ("mean", "variance"))


@query("beta_encode_bootstrap", sql=beta_sql(BETA_FEATURES, ("mean",), mode="bootstrap", n_samples=50, f=0.8))
def q_beta_bootstrap(spark, d):
    return _beta(spark, d, BETA_FEATURES, ("mean",), mode="bootstrap", n_samples=50, f=0.8)


_TRAIN = "o_orderdate < TIMESTAMP '1997-01-01'"


@query(
    "target_encode_unseen",
    sql=beta_sql({"o_custkey": "o_custkey"}, ("mean",), train_where=_TRAIN, keep=("ID", "o_custkey")),
)
def q_target_unseen(spark, d):
    return _beta(spark, d, {"o_custkey": "o_custkey"}, ("mean",),
                 train_filter=F.col("o_orderdate") < F.lit("1997-01-01").cast("timestamp"), keep=("ID", "o_custkey"))


def dirichlet_sql(features, moments, mode="expected", n_samples=50, f=0.8, n_classes=5, target="o_orderpriority",
                  train_where="TRUE"):
    w = _weight_sql(mode, n_samples, f)
    sc = _scale_sql(mode, n_samples, f)
    ctes = [
        f"e0 AS (SELECT * FROM {ENTITY_SQL})",
        f"codes AS (SELECT {target} AS lvl, CAST(row_number() OVER (ORDER BY {target}) - 1 AS INTEGER) AS y "
        f"FROM (SELECT DISTINCT {target} FROM e0))",
        f"e AS (SELECT e0.*, codes.y, {w} AS w FROM e0 JOIN codes ON e0.{target} = codes.lvl)",
        f"et AS (SELECT * FROM e WHERE {train_where})",
        "s AS (SELECT count(*) AS n FROM et)",
        "pr AS (SELECT y, count(*) / max(s.n) AS prior FROM et, s GROUP BY y)",
    ]
    sel = ["e.ID"]
    joins = []
    ks = range(n_classes)
    for name, keys in features.items():
        keys = [keys] if isinstance(keys, str) else keys
        kl = ", ".join(keys)
        nn = " AND ".join(f"{k} IS NOT NULL" for k in keys)
        aggs = ", ".join(
            f"(SELECT prior FROM pr WHERE y = {k}) + max({sc}) * sum(CASE WHEN y = {k} THEN w ELSE 0 END) AS a{k}" for k in ks
        )
        ctes.append(f"l_{name} AS (SELECT {kl}, {aggs} FROM et, s WHERE {nn} GROUP BY {kl})")
        on = " AND ".join(f"e.{k} = l_{name}.{k}" for k in keys)
        joins.append(f"LEFT JOIN l_{name} ON {on}")
        al = {k: f"coalesce(l_{name}.a{k}, (SELECT prior FROM pr WHERE y = {k}))" for k in ks}
        a0 = "(" + " + ".join(al[k] for k in ks) + ")"
        for k in list(ks)[:-1]:
            if "mean" in moments:
                sel.append(f"round({al[k]} / {a0}, 6) AS {name}_M_{k}")
            if "var" in moments:
                sel.append(f"round({al[k]} * ({a0} - {al[k]}) / ({a0} * {a0} * ({a0} + 1)), 6) AS {name}_V_{k}")
    return "WITH " + ",\n".join(ctes) + f"\nSELECT {', '.join(sel)} FROM e " + " ".join(joins)


DIR_FEATURES = {"n_name": "n_name", "c_mktsegment": "c_mktsegment"}
PLACE = {"Place": ["n_name", "c_mktsegment"]}


def _dirichlet(spark, d, features, moments):
    e = entity(spark, d)
    enc = E.fit_label_encoder(e, "o_orderpriority")
    e = E.label_encode(e, "o_orderpriority", enc, out="y")
    st = E.fit_dirichlet(e, "y", features, "ID", n_samples=50, sample_size=0.8, seed=SEED, mode="expected")
    out = E.dirichlet_transform(e, st, moments)
    cols = ["ID"]
    for n in features:
        for k in st.classes[:-1]:
            if "mean" in moments:
                cols.append(f"{n}_M_{k}")
            if "var" in moments:
                cols.append(f"{n}_V_{k}")
    return round_doubles(out.select(*cols))


@query("dirichlet_encode_mean", sql=dirichlet_sql(DIR_FEATURES, ("mean",)))
def q_dir_mean(spark, d):
    return _dirichlet(spark, d, DIR_FEATURES, ("mean",))


@query("dirichlet_encode_var", sql=dirichlet_sql(DIR_FEATURES, ("mean", "var")))
def q_dir_var(spark, d):
    return _dirichlet(spark, d, DIR_FEATURES, ("mean", "var"))


@query("dirichlet_encode_composite", sql=dirichlet_sql(PLACE, ("mean",)))
def q_dir_composite(spark, d):
    return _dirichlet(spark, d, PLACE, ("mean",))


def _oof_beta_sql(features, f=0.8):
    from foldwise.plans.q_split import FOLDS_SQL

    ctes = [
        f"e AS (SELECT x.*, k.kfold FROM {ENTITY_SQL} x JOIN {FOLDS_SQL} k ON x.ID = k.ID)",
        "pf AS (SELECT kfold, count(*) AS n, sum(target) AS p FROM e GROUP BY kfold)",
        "tt AS (SELECT sum(n) AS n, sum(p) AS p FROM pf)",
        "pr AS (SELECT pf.kfold, (tt.p - pf.p) / (tt.n - pf.n) AS a0, "
        f"floor((tt.n - pf.n) * CAST({f!r} AS DOUBLE)) / (tt.n - pf.n) AS sc FROM pf, tt)",
    ]
    sel, joins = ["e.ID", "e.kfold"], []
    for name, col in features.items():
        ctes.append(
            f"c_{name} AS (SELECT {col}, kfold, count(*) AS n, sum(target) AS pos FROM e WHERE {col} IS NOT NULL GROUP BY {col}, kfold)"
        )
        ctes.append(
            f"l_{name} AS (SELECT c.{col}, c.kfold, pr.a0 + pr.sc * (sum(c.pos) OVER w - c.pos) AS a, "
            f"(1 - pr.a0) + pr.sc * ((sum(c.n) OVER w - c.n) - (sum(c.pos) OVER w - c.pos)) AS b "
            f"FROM c_{name} c JOIN pr ON c.kfold = pr.kfold WINDOW w AS (PARTITION BY c.{col}))"
        )
        joins.append(f"LEFT JOIN l_{name} ON e.{col} = l_{name}.{col} AND e.kfold = l_{name}.kfold")
        a = f"coalesce(l_{name}.a, (SELECT a0 FROM pr WHERE pr.kfold = e.kfold))"
        b = f"coalesce(l_{name}.b, (SELECT 1 - a0 FROM pr WHERE pr.kfold = e.kfold))"
        sel.append(f"round({a} / ({a} + {b}), 6) AS {name}__M")
    return "WITH " + ",\n".join(ctes) + f"\nSELECT {', '.join(sel)} FROM e " + " ".join(joins)


OOF_FEATURES = {"n_name": "n_name", "c_mktsegment": "c_mktsegment", "priority_m": "priority_m"}


@query("beta_encode_oof", sql=_oof_beta_sql(OOF_FEATURES))
def q_beta_oof(spark, d):
    from foldwise.plans.q_split import folds

    e = entity(spark, d).join(folds(spark, d).select("ID", "kfold"), "ID")
    st = E.fit_beta_by_fold(e, "target", OOF_FEATURES, "kfold", sample_size=0.8)
    out = E.beta_transform_by_fold(e, st)
    return round_doubles(out.select("ID", "kfold", *[f"{n}__M" for n in OOF_FEATURES]))


def _oof_dirichlet_sql(features, n_classes=5, f=0.8):
    from foldwise.plans.q_split import FOLDS_SQL

    ks = range(n_classes)
    ctes = [
        f"e AS (SELECT x.*, k.kfold, CAST(dense_rank() OVER (ORDER BY x.o_orderpriority) - 1 AS INTEGER) AS y "
        f"FROM {ENTITY_SQL} x JOIN {FOLDS_SQL} k ON x.ID = k.ID)",
        "pf AS (SELECT kfold, count(*) AS n FROM e GROUP BY kfold)",
        "tt AS (SELECT sum(n) AS n FROM pf)",
        "pc AS (SELECT kfold, y, count(*) AS n FROM e GROUP BY kfold, y)",
        "pr AS (SELECT pf.kfold, " + ", ".join(
            f"((SELECT count(*) FROM e WHERE y = {k}) - coalesce((SELECT n FROM pc WHERE pc.kfold = pf.kfold AND pc.y = {k}), 0)) "
            f"/ (tt.n - pf.n) AS p{k}" for k in ks)
        + f", floor((tt.n - pf.n) * CAST({f!r} AS DOUBLE)) / (tt.n - pf.n) AS sc FROM pf, tt)",
    ]
    sel, joins = ["e.ID", "e.kfold"], []
    for name, col in features.items():
        cnts = ", ".join(f"count(*) FILTER (WHERE y = {k}) AS c{k}" for k in ks)
        ctes.append(f"c_{name} AS (SELECT {col}, kfold, {cnts} FROM e WHERE {col} IS NOT NULL GROUP BY {col}, kfold)")
        al = ", ".join(f"pr.p{k} + pr.sc * (sum(c.c{k}) OVER w - c.c{k}) AS a{k}" for k in ks)
        ctes.append(f"l_{name} AS (SELECT c.{col}, c.kfold, {al} FROM c_{name} c JOIN pr ON c.kfold = pr.kfold "
                    f"WINDOW w AS (PARTITION BY c.{col}))")
        joins.append(f"LEFT JOIN l_{name} ON e.{col} = l_{name}.{col} AND e.kfold = l_{name}.kfold")
        a = {k: f"coalesce(l_{name}.a{k}, (SELECT p{k} FROM pr WHERE pr.kfold = e.kfold))" for k in ks}
        a0 = "(" + " + ".join(a[k] for k in ks) + ")"
        for k in list(ks)[:-1]:
            sel.append(f"round({a[k]} / {a0}, 6) AS {name}_M_{k}")
    return "WITH " + ",\n".join(ctes) + f"\nSELECT {', '.join(sel)} FROM e " + " ".join(joins)


@query("dirichlet_encode_oof", sql=_oof_dirichlet_sql({"n_name": "n_name", "c_mktsegment": "c_mktsegment"}))
def q_dirichlet_oof(spark, d):
    from foldwise.plans.q_split import folds

    e = entity(spark, d).join(folds(spark, d).select("ID", "kfold"), "ID")
    enc = E.fit_label_encoder(e, "o_orderpriority")
    e = E.label_encode(e, "o_orderpriority", enc, out="y")
    feats = {"n_name": "n_name", "c_mktsegment": "c_mktsegment"}
    st = E.fit_dirichlet_by_fold(e, "y", feats, "kfold", sample_size=0.8)
    out = E.dirichlet_transform_by_fold(e, st)
    return round_doubles(out.select("ID", "kfold", *[f"{n}_M_{k}" for n in feats for k in st.classes[:-1]]))
