"""Queries of the trees that route NULL: gains, scores, split counts and exact contributions."""

from __future__ import annotations

from itertools import combinations
from math import factorial, inf, log, nan

from pyspark.sql import functions as F

from creditloom.catalog import views as V
from creditloom.catalog.explanation import _TABLE, table
from creditloom.catalog.registry import query, settled
from creditloom.operators import boosting as B
from creditloom.operators import tree_shapley as T
from creditloom.operators.explain import background_rows
from creditloom.operators.metrics import evaluate
from creditloom.operators.models import cross_validate
from creditloom.operators.splitting import stratified_folds
from creditloom.session import scratch_path

# Features with missing values, and the points at which they are cut.
CUTS = {"NATION": [4.0, 9.0, 14.0, 19.0], "DEBT": [600_000.0, 800_000.0, 1_000_000.0], "N_CREDITS": [8.0, 12.0, 16.0], "DAYS": [-1300.0, -1200.0, -1100.0]}
FEATURES = list(CUTS)

_HOLED = """
SELECT SK_ID_CURR, TARGET, nullif(NATION, 3) AS NATION, CASE WHEN DEBT > 500000 THEN DEBT END AS DEBT, N_CREDITS, CASE WHEN N_CREDITS > 0 THEN DAYS END AS DAYS FROM t"""


def holed(spark, sf):
    """Clients with holes: a nation, small debts and the days of clients without credits are missing."""
    return table(spark, sf).select("SK_ID_CURR", "TARGET", F.nullif("NATION", F.lit(3.0)).alias("NATION"), F.when(F.col("DEBT") > 500000, F.col("DEBT")).alias("DEBT"),
                                   "N_CREDITS", F.when(F.col("N_CREDITS") > 0, F.col("DAYS")).alias("DAYS"))


_OPTIONS = " UNION ALL ".join(
    f"SELECT {j} AS j, '{f}' AS feature, CAST({'1e308' if c is None else c} AS DOUBLE) AS cut, {side} AS null_left" for j, f in enumerate(FEATURES)
    for c in [*CUTS[f], None] for side in ("true", "false"))
_LONG = " UNION ALL ".join(f"SELECT SK_ID_CURR, leaf, g, h, {j} AS j, {f} AS x FROM rated_rows" for j, f in enumerate(FEATURES))


def _gains(source: str) -> dict[str, str]:
    """Gain of every cut and way of NULL in each leaf of `source` (SK_ID_CURR, TARGET, features, leaf)."""
    return {
        "rated_rows": f"SELECT *, p - TARGET AS g, p * (1 - p) AS h FROM {source}, (SELECT avg(CAST(TARGET AS DOUBLE)) AS p FROM holed)",
        "long_rows": _LONG,
        "sides": """SELECT leaf, o.j, feature, cut, null_left, count(*) FILTER (WHERE l) AS n_left, count(*) FILTER (WHERE NOT l) AS n_right,
          coalesce(sum(g) FILTER (WHERE l), 0) AS gl, coalesce(sum(h) FILTER (WHERE l), 0) AS hl, coalesce(sum(g) FILTER (WHERE NOT l), 0) AS gr, coalesce(sum(h) FILTER (WHERE NOT l), 0) AS hr
          FROM (SELECT leaf, g, h, o.j AS j, feature, cut, null_left, coalesce(x <= cut, null_left) AS l FROM long_rows r JOIN options o ON r.j = o.j) o GROUP BY ALL""",
        "gains": "SELECT *, gl * gl / (hl + 1) + gr * gr / (hr + 1) - (gl + gr) * (gl + gr) / (hl + hr + 1) AS gain FROM sides WHERE n_left >= 20 AND n_right >= 20"}


def _stump(**params):
    return B.NullRoutingTrees(FEATURES, cuts=CUTS, trees=1, rate=1.0, min_hessian=0.0, **params)


@query("null_gain_table", V.using("scored bureau", """
SELECT feature, CASE WHEN cut < 1e300 THEN cut END AS cut, null_left, n_left, n_right, round(gain, 6) AS gain FROM gains""",
                                  t=_TABLE, holed=_HOLED, options=_OPTIONS, **_gains("(SELECT *, 0 AS leaf FROM holed)")))
def null_gain_table(spark, sf):
    """What every cut of every feature would gain at the root, for both ways of sending NULL, from one histogram aggregate."""
    tree = _stump()
    rows = holed(spark, sf)
    share = rows.agg(F.avg(F.col("TARGET").cast("double"))).first()[0]
    base = nan if share is None else log(share / (1 - share)) if 0 < share < 1 else inf * (share - 0.5)
    path = scratch_path(spark, "gain-bins")
    # A row without a target has no gradient, but counts.
    B.write_blocks(rows.select(F.lit(0).cast("bigint").alias("k"), F.coalesce(F.col("TARGET").cast("double"), F.lit(share).cast("double")).alias("y"), F.lit(1.0).alias("w"), *FEATURES), FEATURES, CUTS, path)
    blocks = B.Blocks.read(spark.read.parquet(path), FEATURES, CUTS, base)
    n_cuts = [len(CUTS[f]) for f in FEATURES]
    sums = tree._histograms(blocks, [(0, ())], len(FEATURES), max(n_cuts) + 2)[0]
    blocks.rdd.unpersist()
    gain, left = B.split_gains(sums, n_cuts, 1.0, 20, 0.0)
    whole = sums[2, 0].sum()
    out = [(f, CUTS[f][c] if c < n_cuts[j] else None, side == 0, round(left[2, j, c, side]), round(whole - left[2, j, c, side]), float(gain[j, c, side]))
           for j, f in enumerate(FEATURES) for c in range(n_cuts[j] + 1) for side in (0, 1) if gain[j, c, side] > float("-inf")]
    return settled(spark.createDataFrame(out, "feature string, cut double, null_left boolean, n_left bigint, n_right bigint, gain double"))


_BEST = "SELECT * FROM gains QUALIFY row_number() OVER (ORDER BY round(gain, 9) DESC, leaf, j, cut, NOT null_left) = 1"
_SIDE = "CASE o.feature " + " ".join(f"WHEN '{f}' THEN coalesce(r.{f} <= o.cut, o.null_left)" for f in FEATURES) + " END"


def _second(name: str) -> dict[str, str]:
    return {f"{k}_2": v.replace("rated_rows", "rated_rows_2").replace("long_rows", "long_rows_2").replace("FROM sides", "FROM sides_2") for k, v in _gains(name).items()}


@query("null_tree_scores", V.using("scored bureau", """
SELECT SK_ID_CURR, round(1 / (1 + exp(-(ln(p / (1 - p)) - sum(p - TARGET) OVER (PARTITION BY leaf) / (sum(p * (1 - p)) OVER (PARTITION BY leaf) + 1)))), 6) AS proba
FROM three, (SELECT avg(CAST(TARGET AS DOUBLE)) AS p FROM holed)""",
                                   t=_TABLE, holed=_HOLED, options=_OPTIONS, **_gains("(SELECT *, 0 AS leaf FROM holed)"), best=_BEST,
                                   two=f"SELECT r.*, CASE WHEN {_SIDE} THEN 1 ELSE 2 END AS leaf FROM holed r, best o", **_second("two"), best_2=_BEST.replace("gains", "gains_2"),
                                   three=f"SELECT r.* REPLACE (CASE WHEN r.leaf <> o.leaf THEN r.leaf WHEN {_SIDE} THEN 3 ELSE 4 END AS leaf) FROM two r, best_2 o"))
def null_tree_scores(spark, sf):
    """One tree of three leaves: the root is split, then the leaf that gains more; NULL goes the way that gains more."""
    rows = holed(spark, sf)
    model = _stump(max_leaves=3).fit(rows)
    return settled(rows.select("SK_ID_CURR", (1 / (1 + F.exp(-model.margin()))).alias("proba")))


def _boosted(spark, sf, **params):
    return B.NullRoutingTrees(FEATURES, **{"trees": 6, "max_leaves": 8, "rate": 0.3, **params}).fit(holed(spark, sf))


@query("tree_nodes", V.using("scored bureau", """
SELECT CAST(tree AS INTEGER) AS tree, true AS leaves_are_one_more, n AS leaf_rows, true AS children_add_up FROM (SELECT count(*) AS n FROM holed), range(6) r(tree)""", t=_TABLE, holed=_HOLED))
def tree_nodes(spark, sf):
    """What any saved model must satisfy: in each tree one leaf more than splits, all rows in the leaves, and both children of a split hold its rows."""
    path = scratch_path(spark, "tree-nodes")
    _boosted(spark, sf).write_to(spark, path)
    nodes = spark.read.parquet(path).where("tree >= 0")
    splits = nodes.where("feature is not null").select("tree", "n_rows", F.explode(F.array("left", "right")).alias("node"), F.col("node").alias("parent"))
    children = nodes.select("tree", "node", F.col("n_rows").alias("child_rows"))
    kept = splits.join(children, ["tree", "node"]).groupBy("tree", "parent").agg((F.sum("child_rows") == F.first("n_rows")).alias("same"))
    kept = kept.groupBy("tree").agg(F.every("same").alias("children_add_up"))
    facts = nodes.groupBy("tree").agg((F.count_if(F.col("feature").isNull()) == F.count("feature") + 1).alias("leaves_are_one_more"),
                                      F.sum(F.when(F.col("feature").isNull(), F.col("n_rows"))).alias("leaf_rows"))
    return facts.join(kept, "tree").select("tree", "leaves_are_one_more", "leaf_rows", "children_add_up")


@query("tree_split_counts")
def tree_split_counts(spark, sf):
    """How often each feature splits in a saved model, and what it gains, from its node table."""
    path = scratch_path(spark, "tree-nodes")
    _boosted(spark, sf).write_to(spark, path)
    return settled(B.split_counts(spark.read.parquet(path)))


@query("cv_null_trees")
def cv_null_trees(spark, sf):
    folds = stratified_folds(holed(spark, sf), "SK_ID_CURR", "TARGET", 3)
    cv = cross_validate(folds, FEATURES, "TARGET", "fold", 3, lambda f: B.routed_trees(f, trees=8, max_leaves=8))
    return evaluate(cv.scores, "TARGET", "PROBA", 0.2, ["fold"])


# A model as read from storage: two trees over three features, one of them twice on a path.
_N = B.Node
STORED = B.TreeModel(["NATION", "DEBT", "N_CREDITS"], -0.5, [
    _N(0, 0, "NATION", 9.0, False, 1, 2), _N(0, 1, "DEBT", 800_000.0, True, 3, 4), _N(0, 2, "N_CREDITS", 12.0, False, 5, 6), _N(0, 3, value=0.4), _N(0, 4, value=-0.3),
    _N(0, 5, value=0.1), _N(0, 6, value=0.9), _N(1, 0, "NATION", 19.0, True, 1, 2), _N(1, 1, "NATION", 4.0, False, 3, 4), _N(1, 2, value=0.7), _N(1, 3, value=-0.6), _N(1, 4, value=0.2)])


def _stored_score(owner: dict[str, str]) -> str:
    """The stored model in SQL; `owner` says from which row (x or b) each feature is taken."""
    n, d, c = (f"{owner[f]}.{f}" for f in STORED.features)
    return (f"(-0.5::DOUBLE + CASE WHEN coalesce({n} <= 9, false) THEN CASE WHEN coalesce({d} <= 800000, true) THEN 0.4::DOUBLE ELSE -0.3::DOUBLE END"
            f" ELSE CASE WHEN coalesce({c} <= 12, false) THEN 0.1::DOUBLE ELSE 0.9::DOUBLE END END"
            f" + CASE WHEN coalesce({n} <= 19, true) THEN CASE WHEN coalesce({n} <= 4, false) THEN -0.6::DOUBLE ELSE 0.2::DOUBLE END ELSE 0.7::DOUBLE END)")


def _coalitions() -> list[tuple[str, ...]]:
    return [s for k in range(4) for s in combinations(STORED.features, k)]


def _value(s: tuple[str, ...]) -> str:
    return "v_" + "".join(f[0].lower() + f[-1].lower() for f in s)


def _phi(f: str) -> str:
    terms = [f"{factorial(len(s)) * factorial(2 - len(s)) / 6!r}::DOUBLE * ({_value(tuple(g for g in STORED.features if g in (*s, f)))} - {_value(s)})" for s in _coalitions() if f not in s]
    return " + ".join(terms)


_VALUES = ", ".join(f"avg({_stored_score({f: 'x' if f in s else 'b' for f in STORED.features})}) AS {_value(s)}" for s in _coalitions())


def _reference(spark, sf):
    return background_rows(holed(spark, sf), STORED.features, 40)


@query("tree_contributions", V.using("scored bureau", f"""
SELECT SK_ID_CURR, round({_value(())}, 6) AS base_value, {', '.join(f'round({_phi(f)}, 6) AS {f}' for f in STORED.features)}, round({_value(tuple(STORED.features))}, 6) AS output FROM v""",
                                     t=_TABLE, holed=_HOLED,
                                     reference="SELECT * FROM holed WHERE coalesce(NATION, DEBT, N_CREDITS) IS NOT NULL ORDER BY md5(CAST(SK_ID_CURR AS VARCHAR) || '-42'), SK_ID_CURR LIMIT 40",
                                     v=f"SELECT x.SK_ID_CURR, {_VALUES} FROM holed x, reference b GROUP BY x.SK_ID_CURR"))
def tree_contributions(spark, sf):
    """Shapley values of the stored trees by paths; the SQL form enumerates all coalitions."""
    return settled(T.tree_contributions(holed(spark, sf), STORED, _reference(spark, sf)))


@query("tree_additivity", V.using("scored bureau", "SELECT space, count(*) AS n, count(*) AS n_exact FROM holed, (VALUES ('log odds'), ('probability')) s(space) GROUP BY space", t=_TABLE, holed=_HOLED))
def tree_additivity(spark, sf):
    """Of a fitted model: base value and contributions add up to the output for every client, in log odds and as probabilities."""
    model, rows = _boosted(spark, sf), holed(spark, sf)
    reference = background_rows(rows, FEATURES, 30)
    p = 1 / (1 + F.exp(-model.margin()))

    def exact(name, output, probability):
        found = T.tree_contributions(rows.withColumn("expected", output), model, reference, ["SK_ID_CURR", "expected"], probability)
        total = F.col("base_value")
        for f in FEATURES:
            total = total + F.col(f)
        return found.agg(F.lit(name).alias("space"), F.count("*").alias("n"), F.count_if((F.abs(total - F.col("output")) < 1e-9) & (F.abs(F.col("output") - F.col("expected")) < 1e-9)).alias("n_exact"))

    return exact("log odds", model.margin(), False).unionByName(exact("probability", p, True))
