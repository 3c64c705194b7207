"""Queries on the scorers."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import Window
from pyspark.sql import functions as F

from riskloom.functions.expressions import unit
from riskloom.models import ensemble, forest, reconstruction
from riskloom.models.rules import RuleScorer, rule_summary
from riskloom.operators.features import FeatureGroups, feature_names, with_features
from riskloom.operators.relational import top_per_row
from riskloom.plans.fixtures import Tables
from riskloom.plans.registry.core import plain, query, rnd
from riskloom.plans.registry.history import FINE, HISTORY_SQL, counts_sql
from riskloom.plans.registry.mapping import BASE_SQL, RISK_SQL, TEMPORAL_SQL
from riskloom.session import checkpointed

# --- rules ------------------------------------------------------------------------------------

_RULE_GROUPS = FeatureGroups(aggregations=False)
_RULE_FEATURES = (
    "SELECT transaction_id, is_fraud, "
    + ", ".join(["amount", *TEMPORAL_SQL, *RISK_SQL, *counts_sql("card_id")])
    + " FROM txn"
)
_RULES = {
    "high_amount": "least(greatest(ln(1 + amount / 5000) / ln(11), 0), 1) * CASE WHEN amount > 5000 THEN 1 ELSE 0.3 END",
    "velocity_1h": "least(greatest(ln(1 + card_txn_count_1h / 5.0) / ln(6), 0), 1) * CASE WHEN card_txn_count_1h >= 5 THEN 1 ELSE 0.5 END",
    "velocity_24h": "least(card_txn_count_24h / 20.0, 1) * CASE WHEN card_txn_count_24h >= 20 THEN 1 ELSE 0.3 END",
    "night_activity": "CASE WHEN is_night = 1 AND amount > 500 THEN 0.8 WHEN is_night = 1 THEN 0.3 ELSE 0 END",
    "country_mismatch": "CASE WHEN country_mismatch = 1 THEN 0.7 ELSE 0 END",
    "suspicious_email": "CASE WHEN suspicious_email = 1 THEN 0.8 ELSE 0 END",
    "high_risk_merchant": "CASE WHEN high_risk_category = 1 THEN 0.5 ELSE 0 END",
}
_WEIGHTED = " + ".join(
    f"{w} * {_RULES[r]}"
    for r, w in {
        "high_amount": 0.25,
        "velocity_1h": 0.20,
        "velocity_24h": 0.10,
        "night_activity": 0.10,
        "country_mismatch": 0.15,
        "suspicious_email": 0.10,
        "high_risk_merchant": 0.10,
    }.items()
)
_RULE_SCORE = f"least(greatest({_WEIGHTED}, 0), 1)"


def _from_rule_features(columns: str) -> str:
    return f"WITH f AS ({_RULE_FEATURES}) SELECT {columns} FROM f"


def _rule_features(t: Tables):
    return with_features(t.txn, _RULE_GROUPS, keep=("transaction_id", "is_fraud"))


def _single_rule(key: str, rule: str) -> None:
    @query(key, _from_rule_features(f"transaction_id, {rnd(f'CAST({_RULES[rule]} AS DOUBLE)', 'score')}"), ("txn",))
    def _(t: Tables):
        df = _rule_features(t)
        score = RuleScorer().rule_columns(df.columns)[rule]
        return plain(df.select("transaction_id", score.cast("double").alias("score")))


for _key, _rule in (
    ("k1_high_amount", "high_amount"),
    ("k2_velocity_1h", "velocity_1h"),
    ("k3_velocity_24h", "velocity_24h"),
    ("k4_night_activity", "night_activity"),
    ("k5_country_mismatch", "country_mismatch"),
    ("k6_suspicious_email", "suspicious_email"),
    ("k7_high_risk_merchant", "high_risk_merchant"),
):
    _single_rule(_key, _rule)


@query(
    "k8_rule_score",
    _from_rule_features(f"transaction_id, {rnd(f'CAST({_RULE_SCORE} AS DOUBLE)', 'rule_score')}"),
    ("txn",),
)
def _(t: Tables):
    return plain(RuleScorer().score(_rule_features(t)).select("transaction_id", "rule_score"))


@query(
    "k9_rule_reasons",
    _from_rule_features(
        """transaction_id, concat_ws('; ',
     CASE WHEN amount > 5000 THEN printf('Amount $%.2f exceeds threshold $5000.00', amount) END,
     CASE WHEN card_txn_count_1h >= 5 THEN concat(card_txn_count_1h, ' transactions in last hour (threshold: 5)') END,
     CASE WHEN card_txn_count_24h >= 20 THEN concat(card_txn_count_24h, ' transactions in last 24h (threshold: 20)') END,
     CASE WHEN is_night = 1 AND amount > 500 THEN 'Transaction during unusual hours (1am-5am)' END,
     CASE WHEN country_mismatch = 1 THEN 'Billing and shipping countries do not match' END,
     CASE WHEN suspicious_email = 1 THEN 'Suspicious or disposable email domain detected' END,
     CASE WHEN high_risk_category = 1 THEN 'Transaction at high-risk merchant category' END) AS reasons"""
    ),
    ("txn",),
)
def _(t: Tables):
    scored = RuleScorer().score(_rule_features(t))
    texts = F.transform("rule_reasons", lambda r: r["reason"])
    return scored.select("transaction_id", F.concat_ws("; ", texts).alias("reasons"))


@query(
    "k10_rule_catalogue",
    "WITH f AS (" + _RULE_FEATURES + ") " + " UNION ALL ".join(
        f"SELECT '{r}' AS rule, count(*) AS fired FROM f WHERE {c}"
        for r, c in {
            "high_amount": "amount > 5000",
            "velocity_1h": "card_txn_count_1h >= 5",
            "velocity_24h": "card_txn_count_24h >= 20",
            "night_activity": "is_night = 1 AND amount > 500",
            "country_mismatch": "country_mismatch = 1",
            "suspicious_email": "suspicious_email = 1",
            "high_risk_merchant": "high_risk_category = 1",
        }.items()
    ),
    ("txn",),
)
def _(t: Tables):
    """How often each catalogued rule fires."""
    scorer = RuleScorer()
    fired = scorer.score(_rule_features(t)).select(F.explode("rule_reasons.rule").alias("rule"))
    counts = fired.groupBy("rule").agg(F.count("*").alias("fired"))
    joined = scorer.catalogue(t.spark).join(counts, "rule", "left")
    return joined.select("rule", F.coalesce("fired", F.lit(0)).alias("fired"))


@query(
    "k11_rule_summary",
    f"""WITH f AS ({_RULE_FEATURES}), s AS (SELECT {_RULE_SCORE} AS score FROM f)
    SELECT count(*) AS n_samples, round(avg(score), 6) AS mean_score,
     count(*) FILTER (WHERE score > 0.5) AS flagged_count FROM s""",
    ("txn",),
)
def _(t: Tables):
    return plain(rule_summary(RuleScorer().score(_rule_features(t))))


# --- isolation forest -------------------------------------------------------------------------

_FLAT = FeatureGroups(velocity=False, aggregations=False)
_FLAT_SQL = "SELECT transaction_id, " + ", ".join(["amount", "ln(1 + amount) AS amount_log", *TEMPORAL_SQL[6:], *RISK_SQL]) + " FROM txn"
_FLAT_NAMES = ["amount", "amount_log", "is_business_hours", "day_of_month", "is_month_start", "is_month_end",
               "suspicious_email", "country_mismatch", "card_billing_mismatch", "high_risk_category",
               "is_online", "is_round_amount", "is_large_amount", "is_very_large_amount"]


def _flat(t: Tables):
    return with_features(t.txn, _FLAT).select("transaction_id", *_FLAT_NAMES)


#: Features of both engines are rounded alike before statistics are taken of them.
_ALL_COLUMNS = [*BASE_SQL, *TEMPORAL_SQL, *RISK_SQL, *HISTORY_SQL]
_ALL_SQL = "SELECT transaction_id, " + ", ".join(_ALL_COLUMNS) + " FROM txn"
_ALL_NAMES = [c.rsplit(" ", 1)[-1] for c in _ALL_COLUMNS]


def _all_features(t: Tables):
    """Written once: the statistics and the scores both read all columns."""
    return checkpointed(plain(with_features(t.txn), fine=FINE))


def _all_z_sql(floor: str) -> str:
    """All 53 z-scores side by side."""
    stats = ", ".join(f"avg({c}) AS m{i}, stddev_pop({c}) AS s{i}" for i, c in enumerate(_ALL_NAMES))
    scores = ", ".join(
        f"round(({c} - m{i}) / {floor.format(s=f's{i}')}, 4) + 0.0 AS {c}" for i, c in enumerate(_ALL_NAMES)
    )
    return f"WITH f AS ({_ALL_SQL}), g AS (SELECT {stats} FROM f) SELECT transaction_id, {scores} FROM f, g"


def _z_sql(floor: str) -> str:
    """Long form: one z-score per row and feature."""
    stats = ", ".join(f"avg({c}) AS m{i}, stddev_pop({c}) AS s{i}" for i, c in enumerate(_FLAT_NAMES))
    lines = " UNION ALL ".join(
        f"SELECT transaction_id, {i} AS p, '{c}' AS feature, ({c} - m{i}) / {floor.format(s=f's{i}')} AS z FROM f, g"
        for i, c in enumerate(_FLAT_NAMES)
    )
    return f"f AS ({_FLAT_SQL}), g AS (SELECT {stats} FROM f), z AS ({lines})"


def _wide_z(floor: str) -> str:
    picked = ", ".join(
        f"round(max(CASE WHEN p = {i} THEN z END), 5) + 0.0 AS {c}" for i, c in enumerate(_FLAT_NAMES)
    )
    return f"WITH {_z_sql(floor)} SELECT transaction_id, {picked} FROM z GROUP BY transaction_id"


@query("l1_standardised", _wide_z("(CASE WHEN {s} = 0 THEN 1 ELSE {s} END)"), ("txn",))
def _(t: Tables):
    df = _flat(t)
    scaler = forest.standardiser(df, _FLAT_NAMES)
    zs = [z.alias(n) for n, z in forest.standardised(scaler)]
    return plain(df.select("transaction_id", *zs), 5)


@query("l1_standardised_all", _all_z_sql("(CASE WHEN {s} = 0 THEN 1 ELSE {s} END)"), ("txn",))
def _(t: Tables):
    df = _all_features(t)
    scaler = forest.standardiser(df, _ALL_NAMES)
    return plain(df.select("transaction_id", *[z.alias(n) for n, z in forest.standardised(scaler)]), 4)


# Models are fitted on all 53 features of the table with their own parameters. SQL cannot grow trees
# or find a subspace, but it can state what any fitted model must satisfy; the queries return those
# facts, taken from the model's own output.

def _fitted(t: Tables):
    """(feature table, fitted scorer); every query fits its own, so none depends on those before it."""
    matrix = checkpointed(with_features(t.txn))
    return matrix, ensemble.EnsembleScorer().fit(matrix, feature_names(t.txn.columns))


def _top_five(rows, values: str, got: str):
    """Whether ``got`` holds the positions of a row's five largest values: each stands before the next,
    and the fifth before all others; of equal values the later position comes first."""
    entry = lambda v, i: F.struct(v.alias("v"), i.cast("int").alias("p"))
    at = lambda k: entry(F.get(values, F.get(got, k)), F.get(got, k))
    in_order = [at(F.lit(k)) > at(F.lit(k + 1)) for k in range(4)]
    rows = rows.withColumn("_in_order", in_order[0] & in_order[1] & in_order[2] & in_order[3])
    rows = rows.withColumn("_fifth", at(F.lit(4))).withColumn("_all", F.transform(values, entry))
    rest = F.forall("_all", lambda e: F.array_contains(got, e["p"]) | (e < F.col("_fifth")))
    right = (F.size(got) == 5) & F.col("_in_order") & rest
    return rows.select("transaction_id", _flagged("agrees", right))


def _flagged(name: str, condition) -> F.Column:
    return F.coalesce(condition, F.lit(False)).cast("bigint").alias(name)


_ALL_FEATURES = 53


@query(
    "l2_forest_nodes",
    """SELECT CAST(i AS BIGINT) AS tree, least(256, n) AS root_rows, least(256, n) AS leaf_rows,
     CAST(0 AS BIGINT) AS broken, true AS shallow FROM (SELECT count(*) AS n FROM txn) x, range(0, 200) r(i)""",
    ("txn",),
)
def _(t: Tables):
    """Per tree: sample at the root, rows over all leaves, links and sizes that do not add up, depth."""
    nodes = _fitted(t)[1].forest.node_table(t.spark)
    child = nodes.select("tree", F.col("node").alias("child"), F.col("size").alias("child_size"))
    inner = nodes.where("feature >= 0")
    links = inner.select("tree", "node", "size", F.explode(F.array("left", "right")).alias("child"))
    sums = links.join(child, ["tree", "child"], "left").groupBy("tree", "node", "size").agg(
        F.count("child_size").alias("found"), F.sum("child_size").alias("below")
    )
    broken = sums.groupBy("tree").agg(
        F.sum((~((F.col("found") == 2) & (F.col("below") == F.col("size")))).cast("bigint")).alias("broken")
    )
    per_tree = nodes.groupBy("tree").agg(
        F.max(F.when(F.col("depth") == 0, F.col("size"))).alias("root_rows"),
        F.sum(F.when(F.col("feature") < 0, F.col("size"))).alias("leaf_rows"),
        (F.max("depth") <= 8).alias("shallow"),
    )
    out = per_tree.join(broken, "tree", "left")
    return plain(out.select("tree", "root_rows", "leaf_rows", F.coalesce("broken", F.lit(0)).alias("broken"), "shallow"))


@query("l3_split_importances", "SELECT 1.0 AS share_sum, true AS splits_are_inner_nodes, true AS agrees_with_model")
def _(t: Tables):
    model = _fitted(t)[1].forest
    nodes = model.node_table(t.spark)
    shares = forest.split_shares(nodes)
    own = t.spark.createDataFrame(
        [(i, float(w)) for i, w in enumerate(model.importances) if w > 0], "feature int, own double"
    )
    inner = nodes.where("left <> right").count()
    return plain(
        shares.join(own, "feature", "full").agg(
            F.sum("importance").alias("share_sum"),
            (F.sum("splits") == inner).alias("splits_are_inner_nodes"),
            (F.max(F.abs(F.coalesce("importance", F.lit(9.0)) - F.coalesce("own", F.lit(-9.0)))) < 1e-9).alias("agrees_with_model"),
        )
    )


@query(
    "l4_forest_scores",
    "SELECT count(*) AS rows, 0.0 AS lowest, 1.0 AS highest, CAST(0 AS BIGINT) AS out_of_order FROM txn",
    ("txn",),
)
def _(t: Tables):
    """Scaled scores span 0 to 1 and keep the order of the raw scores."""
    matrix, scorer = _fitted(t)
    raw = checkpointed(scorer.forest.raw_score(matrix).select("transaction_id", "_forest_raw"))
    scored = scorer.forest.score(raw)
    both = scored.join(raw, "transaction_id")
    # rows of one range of raw scores must not meet scores of a lower range
    cells = both.groupBy(F.floor(F.col("_forest_raw") * 10_000).alias("cell")).agg(
        F.min("isolation_forest_score").alias("low"), F.max("isolation_forest_score").alias("high")
    )
    before = F.lag("high").over(Window.orderBy("cell"))
    wrong = cells.select((before > F.col("low")).cast("bigint").alias("w")).agg(F.coalesce(F.sum("w"), F.lit(0)).alias("out_of_order"))
    span = scored.agg(
        F.count("*").alias("rows"), F.min("isolation_forest_score").alias("lowest"),
        F.max("isolation_forest_score").alias("highest"),
    )
    return plain(span.select("*", wrong.scalar().alias("out_of_order")))


@query(
    "l5_forest_predict",
    "SELECT transaction_id, CAST(1 AS BIGINT) AS agrees FROM txn",
    ("txn",),
)
def _(t: Tables):
    matrix, scorer = _fitted(t)
    scored = scorer.forest.score(matrix)
    score = F.col("isolation_forest_score")
    expected = F.when(score >= 0.5, F.lit(1)).otherwise(F.lit(0))
    return scored.select("transaction_id", _flagged("agrees", forest.predicted("isolation_forest_score") == expected))


@query("l6_top_contributions", "SELECT transaction_id, CAST(1 AS BIGINT) AS agrees FROM txn", ("txn",))
def _(t: Tables):
    """The operator's top five against all values of the row, with the forest's own importances."""
    matrix, scorer = _fitted(t)
    model = scorer.forest
    z = dict(forest.standardised(model.scaler))
    values = F.array(*[F.abs(z[n]) * F.lit(float(w)) for n, w in zip(model.features, model.importances)])
    got = F.transform(model.contributions(5), lambda e: e["position"])
    return _top_five(matrix.select("transaction_id", got.alias("got"), values.alias("v")), "v", "got")


# --- reconstruction error ---------------------------------------------------------------------


@query("m1_normalised", _wide_z("({s} + 1e-8)"), ("txn",))
def _(t: Tables):
    df = _flat(t)
    scaler = forest.standardiser(df, _FLAT_NAMES, 1e-8)
    zs = [z.alias(n) for n, z in forest.standardised(scaler)]
    return plain(df.select("transaction_id", *zs), 5)


@query("m1_normalised_all", _all_z_sql("({s} + 1e-8)"), ("txn",))
def _(t: Tables):
    df = _all_features(t)
    scaler = forest.standardiser(df, _ALL_NAMES, 1e-8)
    return plain(df.select("transaction_id", *[z.alias(n) for n, z in forest.standardised(scaler)]), 4)


@query(
    "m2_subspace",
    """SELECT CAST(i AS BIGINT) AS a, CAST(j AS BIGINT) AS b, CASE WHEN i = j THEN 1.0 ELSE 0.0 END AS product
    FROM range(0, 16) x(i), range(0, 16) y(j) WHERE i <= j""",
)
def _(t: Tables):
    """Inner products of the sixteen learned directions: orthonormal."""
    w = _fitted(t)[1].reconstruction.loadings
    rows = [(f, k, float(v)) for f, row in enumerate(w) for k, v in enumerate(row)]
    one = t.spark.createDataFrame(rows, "feature int, a int, x double")
    two = one.select("feature", F.col("a").alias("b"), F.col("x").alias("y"))
    pairs = one.join(two, "feature").where("a <= b")
    return plain(pairs.groupBy("a", "b").agg((F.round(F.sum(F.col("x") * F.col("y")), 6) + 0.0).alias("product")))


@query("m3_error_threshold", "SELECT true AS reaches, true AS not_before")
def _(t: Tables):
    """98 of 100 training errors are at most the threshold, and with one rank less they are not."""
    matrix, scorer = _fitted(t)
    model = scorer.reconstruction
    trained = matrix.where(unit(F.lit("held-out"), "transaction_id") >= model.validation_split)
    errors = model.errors(trained)
    below = F.avg((F.col("reconstruction_error") < model.threshold * (1 - 1e-9)).cast("double"))
    upto = F.avg((F.col("reconstruction_error") <= model.threshold * (1 + 1e-9)).cast("double"))
    n = F.count("*")
    return errors.agg((upto + 1 / n >= 0.98).alias("reaches"), (below - 1 / n <= 0.98).alias("not_before"))


@query(
    "m4_reconstruction_scores",
    "SELECT transaction_id, 0.0 AS off, CAST(1 AS BIGINT) AS inside FROM txn",
    ("txn",),
)
def _(t: Tables):
    """The score against one taken from the returned residuals and the threshold."""
    matrix, scorer = _fitted(t)
    model = scorer.reconstruction
    scored = model.residuals(model.score(matrix))
    error = F.aggregate("residuals", F.lit(0.0), lambda a, x: a + x) / _ALL_FEATURES
    expected = F.least(error / F.lit(2 * model.threshold), F.lit(1.0))
    score = F.col("autoencoder_score")
    return plain(
        scored.select(
            "transaction_id", (F.round(F.abs(score - expected), 6) + 0.0).alias("off"),
            _flagged("inside", (score >= 0) & (score <= 1) & (F.size("residuals") == _ALL_FEATURES)),
        )
    )


@query(
    "m4_scaled_error",
    "SELECT transaction_id, round(least(greatest(rule_score / (2 * 0.37), 0), 1), 6) AS score FROM scores",
    ("scores",),
)
def _(t: Tables):
    return plain(t.scores.select("transaction_id", reconstruction.scaled_error("rule_score", 0.37).alias("score")))


@query("m5_reconstruction_predict", "SELECT transaction_id, CAST(1 AS BIGINT) AS agrees FROM txn", ("txn",))
def _(t: Tables):
    matrix, scorer = _fitted(t)
    scored = scorer.reconstruction.score(matrix)
    expected = F.when(F.col("autoencoder_score") >= 0.5, F.lit(1)).otherwise(F.lit(0))
    return scored.select("transaction_id", _flagged("agrees", reconstruction.predicted("autoencoder_score", 0) == expected))


@query("m6_top_residuals", "SELECT transaction_id, CAST(1 AS BIGINT) AS agrees FROM txn", ("txn",))
def _(t: Tables):
    """The operator's top five against all values of the row."""
    matrix, scorer = _fitted(t)
    model = scorer.reconstruction
    kept = model.residuals(matrix).select("transaction_id", "residuals")
    got = F.transform(reconstruction.top_residuals("residuals", model.features), lambda e: e["position"])
    return _top_five(kept.select("transaction_id", got.alias("got"), "residuals"), "residuals", "got")


@query(
    "m8_latent",
    "SELECT transaction_id, CAST(16 AS BIGINT) AS size, 0.0 AS off FROM txn",
    ("txn",),
)
def _(t: Tables):
    """Latent position times loadings leaves exactly the residual of the standardised features."""
    matrix, scorer = _fitted(t)
    model = scorer.reconstruction
    both = checkpointed(
        model.residuals(model.encode(matrix)).select("transaction_id", "latent", "residuals", *model.features)
    )
    loadings = F.array(*[F.array(*[F.lit(float(v)) for v in row]) for row in model.loadings])
    zs = F.array(*[z for _, z in forest.standardised(model.scaler)])
    dot = lambda row: F.aggregate(
        F.zip_with(row, "latent", lambda x, y: x * y), F.lit(0.0), lambda a, v: a + v
    )
    left = F.zip_with(zs, loadings, lambda z, row: (z - dot(row)) * (z - dot(row)))
    off = F.zip_with(left, "residuals", lambda x, r: F.abs(x - r) / (1 + r))
    return plain(
        both.select(
            "transaction_id", F.size("latent").alias("size"),
            (F.round(F.array_max(off), 6) + 0.0).alias("off"),
        )
    )


# --- ensemble ---------------------------------------------------------------------------------

def _three_scores(t: Tables):
    matrix, scorer = _fitted(t)
    return scorer.score(matrix)


@query("n2_redistributed_weights", "SELECT transaction_id, 0.0 AS off FROM txn", ("txn",))
def _(t: Tables):
    """Without the reconstruction model its weight goes to the others in proportion."""
    scored = _three_scores(t).drop("autoencoder_score")
    weights = ensemble.redistribute(ensemble.DEFAULT_WEIGHTS, "autoencoder")
    got = ensemble.combined(weights, scored.columns)
    want = F.expr("least(greatest(0.30D / 0.65D * rule_score + 0.35D / 0.65D * isolation_forest_score, 0D), 1D)")
    return plain(scored.select("transaction_id", (F.round(F.abs(got - want), 6) + 0.0).alias("off")))


_N3 = "0.30D * rule_score + 0.35D * isolation_forest_score + 0.35D * autoencoder_score"


@query(
    "n3_combined_and_flag",
    "SELECT transaction_id, 0.0 AS off, CAST(1 AS BIGINT) AS flag_agrees FROM txn",
    ("txn",),
)
def _(t: Tables):
    scored = _three_scores(t)
    want = F.expr(f"least(greatest({_N3}, 0D), 1D)")
    return plain(
        scored.select(
            "transaction_id", (F.round(F.abs(F.col("ensemble_score") - want), 6) + 0.0).alias("off"),
            _flagged("flag_agrees", F.col("is_flagged") == (F.col("ensemble_score") >= 0.5)),
        )
    )


@query(
    "n4_flag",
    "SELECT CAST(true AS BOOLEAN) AS flagged, CAST(0 AS BIGINT) AS wrong UNION ALL SELECT false, 0",
)
def _(t: Tables):
    """Flags of the scorer at a threshold that splits the batch, by side."""
    matrix, scorer = _fitted(t)
    middle = scorer.score(matrix).agg(F.percentile_approx("ensemble_score", 0.5)).first()[0]
    moved = replace(scorer, flag_threshold=float(middle))
    out = moved.score(matrix).groupBy(F.col("is_flagged").alias("flagged"))
    side = (F.col("ensemble_score") >= float(middle)) != F.col("is_flagged")
    return plain(out.agg(F.sum(side.cast("bigint")).alias("wrong")))


_N5 = f"""WITH {_z_sql("(CASE WHEN {s} = 0 THEN 1 ELSE {s} END)")},
 c AS (SELECT transaction_id, p, feature, round(abs(z) / {len(_FLAT_NAMES)}, 9) AS v FROM z),
 r AS (SELECT *, row_number() OVER (PARTITION BY transaction_id ORDER BY v DESC, p DESC) AS k FROM c),
 reasons AS (
  SELECT transaction_id, 0 AS p, 'high_amount' AS what, {_RULES['high_amount']} AS w FROM f WHERE amount > 5000
  UNION ALL SELECT transaction_id, 1, 'country_mismatch', 0.7 FROM f WHERE country_mismatch = 1
  UNION ALL SELECT transaction_id, 2, 'suspicious_email', 0.8 FROM f WHERE suspicious_email = 1
  UNION ALL SELECT transaction_id, 3, 'high_risk_merchant', 0.5 FROM f WHERE high_risk_category = 1
  UNION ALL SELECT transaction_id, 10 + k, feature, round(v, 4) FROM r WHERE k <= 3 AND v > 0.1
  UNION ALL SELECT transaction_id, 20 + k, 'residual ' || feature, 0 FROM r WHERE k <= 3 AND v > 0.1),
 ranked AS (SELECT *, row_number() OVER (PARTITION BY transaction_id ORDER BY w DESC, p) AS k FROM reasons)
SELECT f.transaction_id, coalesce(string_agg(what, ',' ORDER BY k), '') AS reasons
FROM f LEFT JOIN ranked ON f.transaction_id = ranked.transaction_id AND k <= 5 GROUP BY f.transaction_id"""


@query("n5_top_reasons", _N5, ("txn",))
def _(t: Tables):
    """Reason merging on given contributions (equal importances), reused as residuals."""
    df = RuleScorer().score(_flat(t))
    scaler = forest.standardiser(df, _FLAT_NAMES)
    n = len(_FLAT_NAMES)
    pairs = [(name, F.round(F.abs(z) / n, 9)) for name, z in forest.standardised(scaler)]
    df = df.withColumn("_top", top_per_row(pairs, 3))
    merged = F.concat(
        "rule_reasons",
        ensemble.forest_reasons(F.col("_top")),
        ensemble.reconstruction_reasons(F.col("_top")),
    )
    label = lambda r: F.coalesce(
        r["rule"],
        F.when(r["model"] == "autoencoder", F.concat(F.lit("residual "), r["feature"])),
        r["feature"],
    )
    return df.select(
        "transaction_id",
        F.concat_ws(",", F.transform(ensemble.strongest(merged), label)).alias("reasons"),
    )


def _given_result(t: Tables):
    scored = RuleScorer().score(_flat(t)).select(
        "transaction_id",
        F.col("rule_score").alias("ensemble_score"),
        (F.col("rule_score") >= 0.5).alias("is_flagged"),
        "rule_score",
        F.lit(0.25).alias("isolation_forest_score"),
        ensemble.strongest(F.col("rule_reasons")).alias("reasons"),
    )
    return ensemble.result_table(scored, ensemble.EnsembleScorer().model_versions)


@query(
    "n6_result_table",
    f"""WITH f AS ({_FLAT_SQL}) SELECT transaction_id,
    round({" + ".join(f"{w} * {_RULES[r]}" for r, w in (("high_amount", 0.25), ("country_mismatch", 0.15), ("suspicious_email", 0.1), ("high_risk_merchant", 0.1)))}, 6) AS ensemble_score,
    0.25 AS isolation_forest_score, CAST(NULL AS DOUBLE) AS autoencoder_score,
    CAST((CASE WHEN amount > 5000 THEN 1 ELSE 0 END) + country_mismatch + suspicious_email + high_risk_category AS BIGINT) AS n_reasons,
    '1.0.0' AS ensemble_version
    FROM f""",
    ("txn",),
)
def _(t: Tables):
    """The result table, its JSON columns read back with JSON functions."""
    out = _given_result(t)
    return plain(
        out.select(
            "transaction_id",
            "ensemble_score",
            "isolation_forest_score",
            "autoencoder_score",
            F.json_array_length("reason_codes").alias("n_reasons"),
            F.get_json_object("model_versions", "$.ensemble").alias("ensemble_version"),
        )
    )


@query(
    "n8_model_versions",
    """SELECT 'ensemble' AS model, '1.0.0' AS version, count(*) AS rows FROM txn
    UNION ALL SELECT 'rules', '1.0.0', count(*) FROM txn""",
    ("txn",),
)
def _(t: Tables):
    versions = F.from_json("model_versions", "map<string,string>")
    exploded = _given_result(t).select(F.explode(versions).alias("model", "version"))
    return exploded.groupBy("model", "version").agg(F.count("*").alias("rows"))


@query(
    "n9_ensemble",
    """SELECT transaction_id, 0.0 AS off, CAST(1 AS BIGINT) AS flag_agrees, CAST(1 AS BIGINT) AS reasons_fit,
     CAST(4 AS BIGINT) AS versions FROM txn""",
    ("txn",),
)
def _(t: Tables):
    """Result table of the fitted ensemble: score from its own parts, flag, reasons, versions."""
    matrix, scorer = _fitted(t)
    out = scorer.results(scorer.score(matrix))
    want = F.expr(f"least(greatest({_N3}, 0D), 1D)")
    reasons = F.json_array_length("reason_codes")
    return plain(
        out.select(
            "transaction_id", (F.round(F.abs(F.col("ensemble_score") - want), 6) + 0.0).alias("off"),
            _flagged("flag_agrees", F.col("is_flagged") == (F.col("ensemble_score") >= 0.5)),
            _flagged("reasons_fit", (reasons >= 0) & (reasons <= 5)),
            F.size(F.from_json("model_versions", "map<string,string>")).alias("versions"),
        )
    )
