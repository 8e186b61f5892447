"""Queries for folds, models, stacking, blending and checking."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loamfold.catalog.registry import Tables, query, rounded
from loamfold.catalog.scalar_queries import DUCK_BLOCK_KEY
from loamfold.functions.fixed import BLEND_WEIGHTS, TARGETS
from loamfold.functions.nulls import from_log
from loamfold.operators import folds, learning, predictions, trees
from loamfold.plans import submission, training
from loamfold.session import fresh_path

NAMES = [f"Target_{x}" for x in TARGETS]
FEATURES = ["Latitude", "Longitude", "electrical_conductivity", "C_organic", "C_total", "ph"]
#: Small forests, so that the queries below stay short; the plans take any settings.
TREES = {"maxIter": 4, "maxDepth": 2, "stepSize": 0.3}
STOPPED = {**TREES, "maxIter": 8}
#: Rows per target and fold that a search sees.
SEARCHED = 2000

# --- folds and the straight-line learner --------------------------------------------------

LONG = (
    f"placed AS (SELECT *, coalesce({DUCK_BLOCK_KEY}, 'r' || ((row_number() OVER (PARTITION BY {DUCK_BLOCK_KEY} IS NULL ORDER BY ID) - 1) // 100)) AS block "
    "FROM train_numeric), known AS ("
    + " UNION ALL ".join(
        f"SELECT ID, '{x}' AS target, {x} AS y, ln(1e0 + greatest({x}, 0e0)) AS y_log, C_total AS x, block FROM placed WHERE {x} IS NOT NULL"
        for x in TARGETS
    )
    + ")"
)

# The greedy step as a recursion over the ordered blocks of each target.
FOLDS = """sizes AS (SELECT target, block, count(*) AS n FROM known GROUP BY ALL),
    ordered AS (SELECT target, block, n, row_number() OVER (PARTITION BY target ORDER BY n DESC, block) AS k FROM sizes WHERE block NOT LIKE 'r%'),
    walk AS (
      SELECT target, block, k, [n, 0, 0, 0, 0] AS loads, 0 AS fold FROM ordered WHERE k = 1
      UNION ALL
      SELECT o.target, o.block, o.k,
        list_transform(w.loads, lambda v, i: CASE WHEN i = list_position(w.loads, list_min(w.loads)) THEN v + o.n ELSE v END),
        list_position(w.loads, list_min(w.loads)) - 1
      FROM walk w JOIN ordered o ON o.target = w.target AND o.k = w.k + 1),
    dealt AS (SELECT target, block, fold FROM walk
      UNION ALL SELECT target, block, CAST(substr(block, 2) AS BIGINT) % 5 FROM sizes WHERE block LIKE 'r%')"""

LINES = """folded AS (SELECT known.*, dealt.fold FROM known JOIN dealt USING (target, block)),
    numbers AS (SELECT unnest(range(5)) AS fold),
    lines AS (SELECT n.fold, f.target, regr_slope(y_log, x) AS slope, regr_intercept(y_log, x) AS intercept
      FROM numbers n JOIN folded f ON f.fold <> n.fold WHERE x IS NOT NULL GROUP BY ALL),
    oof AS (SELECT f.ID, f.target, f.fold, f.y, f.y_log, slope * x + intercept AS pred_log
      FROM folded f JOIN lines l ON f.target = l.target AND f.fold = l.fold)"""


def blocked_train(t: Tables):
    return folds.with_blocks(t.view("train_numeric"))


def labelled(t: Tables):
    """Labelled rows of all targets with their spatial folds."""
    long = folds.labelled_long(blocked_train(t), TARGETS, ["ID", "spatial_block", "C_total"])
    return learning.with_log_label(folds.with_target_folds(long))


def line_models(t: Tables):
    rows = labelled(t)
    return rows, learning.fit_lines(rows, "C_total")


def first_stage(t: Tables):
    """Out-of-fold predictions of the straight lines for every training row and target."""
    train = blocked_train(t)
    long = folds.labelled_long(train, TARGETS, ["ID", "spatial_block", "C_total"])
    fold_table = folds.target_folds(long)
    rows = learning.with_log_label(long.join(fold_table, ["target", "spatial_block"]))
    lines = learning.fit_lines(rows, "C_total")
    return learning.line_scatter(train, fold_table, lines, "C_total", TARGETS)


@query(
    "ml_group_folds",
    f"WITH {LONG}, {FOLDS} SELECT target, block AS spatial_block, n, CAST(fold AS INT) AS fold FROM dealt JOIN sizes USING (target, block)",
    "train_numeric",
    recursive=True,
)
def ml_group_folds(t: Tables):
    counted = labelled(t).groupBy("target", "spatial_block", "fold").agg(F.count("*").alias("n"))
    return counted.select("target", "spatial_block", "n", "fold")


@query(
    "ml_oof_line",
    f"WITH {LONG}, {FOLDS}, {LINES} SELECT ID, target, CAST(fold AS INT) AS fold, y, round(pred_log, 6) AS pred_log FROM oof",
    "train_numeric",
    recursive=True,
)
def ml_oof_line(t: Tables):
    rows, lines = line_models(t)
    return rounded(learning.line_oof(rows, lines, "C_total"), columns=["pred_log"])


@query(
    "ml_oof_scatter",
    f"WITH {LONG}, {FOLDS}, {LINES} SELECT t.ID, "
    + ", ".join(f"round(max(exp(pred_log) - 1e0) FILTER (WHERE target = '{x}'), 5) AS {x}" for x in TARGETS)
    + " FROM train_numeric t LEFT JOIN oof ON t.ID = oof.ID GROUP BY t.ID",
    "train_numeric",
    recursive=True,
)
def ml_oof_scatter(t: Tables):
    return rounded(first_stage(t), 5)


@query(
    "ml_test_average",
    f"WITH {LONG}, {FOLDS}, {LINES} SELECT ID, "
    + ", ".join(
        f"round(greatest(exp(avg(slope * C_total + intercept) FILTER (WHERE target = '{x}')) - 1e0, 0e0), 5) AS {x}"
        for x in TARGETS
    )
    + " FROM test_measured, lines WHERE C_total IS NOT NULL GROUP BY ID"
    + " UNION ALL SELECT ID, "
    + ", ".join("NULL" for _ in TARGETS)
    + " FROM test_measured WHERE C_total IS NULL",
    "train_numeric test_measured",
    recursive=True,
)
def ml_test_average(t: Tables):
    _, lines = line_models(t)
    return rounded(learning.line_test_average(t.view("test_measured"), lines, "C_total", TARGETS), 5)


@query(
    "ml_line_scores",
    f"""WITH {LONG}, {FOLDS}, {LINES} SELECT p.target, p.rmse, f.rmse_log FROM
        (SELECT target, round(sqrt(avg(power(y - greatest(exp(pred_log) - 1e0, 0e0), 2))), 5) AS rmse FROM oof WHERE pred_log IS NOT NULL GROUP BY target) p
        JOIN (SELECT target, round(avg(e), 6) AS rmse_log FROM (SELECT target, fold, sqrt(avg(power(y_log - pred_log, 2))) AS e
          FROM oof GROUP BY target, fold) GROUP BY target) f USING (target)""",
    "train_numeric",
    recursive=True,
)
def ml_line_scores(t: Tables):
    rows, lines = line_models(t)
    oof = learning.with_log_label(learning.line_oof(rows, lines, "C_total")).withColumn("pred", F.expm1("pred_log"))
    pooled = rounded(learning.rmse_pooled(oof), 5)
    return pooled.join(rounded(learning.rmse_fold_mean(oof)), "target")


# --- boosted trees ----------------------------------------------------------------------

EACH = f"{LONG}, {FOLDS}, folded AS (SELECT known.*, CAST(dealt.fold AS INT) AS fold FROM known JOIN dealt USING (target, block))"


def tree_training(t: Tables, **options) -> training.Training:
    """All targets with boosted trees on filled features; ``options`` are those of the learner."""
    test = t.view("test_measured").withColumn("ph", F.col("ph").try_cast("double"))
    learner = training.BoostedTrees(FEATURES, **{"common": TREES, **options})
    return training.Training.of(t.view("train_numeric"), test, learner)


def first_forest(t: Tables, **options) -> tuple[training.Training, DataFrame, trees.Forest]:
    plan = tree_training(t, **options)
    rows = plan.rows()
    return plan, rows, plan.learner.fit(rows, plan.learner.features(1, TARGETS))


CLUSTERINGS = (50, 30)


@query(
    "ml_kmeans_fit",
    """WITH places AS (SELECT coalesce(Latitude, 0e0) AS lat, coalesce(Longitude, 0e0) AS lon, count(*) AS n FROM train GROUP BY ALL)
       SELECT k, least(k, count(*)) AS used_centres, count(*) AS places, CAST(sum(n) AS BIGINT) AS weight, 0::BIGINT AS misplaced,
         0::BIGINT AS moved_centres, 0 AS cheaper_restarts FROM places, (VALUES (50), (30)) s(k) GROUP BY k""",
    "train",
)
def ml_kmeans_fit(t: Tables):
    """Centres have no SQL counterpart of their values; what holds at an optimum is checked for both numbers of centres."""
    train = t.view("train")
    runs = [learning.settle_centres(train, k).check().select(F.lit(k).alias("k"), "*") for k in CLUSTERINGS]
    return runs[0].unionByName(runs[1])


@query("ml_kmeans_centres")
def ml_kmeans_centres(t: Tables):
    return learning.fit_centres(t.view("train"), k=30, restarts=10)


@query("ml_oof_fit")
def ml_oof_fit(t: Tables):
    """Out-of-fold predictions of every labelled row of all targets."""
    _, rows, forest = first_forest(t, stop_early=False)
    return forest.oof(rows)


@query("ml_oof_fit_absolute")
def ml_oof_fit_absolute(t: Tables):
    """The same under the profile that fits absolute errors."""
    _, rows, forest = first_forest(t, stop_early=False, common={**TREES, **trees.ABSOLUTE})
    return forest.oof(rows)


@query(
    "ml_oof_fit_coverage",
    f"WITH {EACH} SELECT ID, target, fold, y, round(y_log, 6) AS y_log, 1 AS predictions FROM folded",
    "train_numeric",
    recursive=True,
)
def ml_oof_fit_coverage(t: Tables):
    """Every labelled row of every target is predicted exactly once, by the model of its own fold."""
    _, rows, forest = first_forest(t, stop_early=False, common={**TREES, "maxIter": 2})
    predicted = forest.oof(rows).groupBy("ID", "target", "fold", "y", "y_log").agg(F.count("pred_log").alias("predictions"))
    return rounded(predicted, columns=["y_log"])


@query("ml_validation_stop")
def ml_validation_stop(t: Tables):
    """Trees of each target and fold when the fold left out ends the growth."""
    return first_forest(t, common=STOPPED)[2].metrics()


@query("agg_best_iteration")
def agg_best_iteration(t: Tables):
    return first_forest(t, common=STOPPED)[2].metrics().groupBy("target").agg(F.max("best_iteration").alias("best_iteration"))


@query("ml_tree_test_average")
def ml_tree_test_average(t: Tables):
    plan, _, forest = first_forest(t, stop_early=False)
    return forest.test(plan.test).select("ID", *[from_log(F.col(x)).alias(x) for x in TARGETS])


@query("ml_stack_stage2")
def ml_stack_stage2(t: Tables):
    """Out-of-fold predictions of the second stage, for which the first one's of the other targets are features."""
    return tree_training(t).both()[1].oof


@query("ml_param_search")
def ml_param_search(t: Tables):
    """Eight seeded settings per target: all on the first fold, two on the others."""
    plan = tree_training(t)
    return trees.search(plan.rows(), plan.learner.features(1, TARGETS), trees.search_space(8, most_trees=4), trained=SEARCHED)


@query(
    "ml_tuned_fit",
    f"WITH {EACH} SELECT target, fold, true AS as_stored, count(*) AS n_predicted FROM folded GROUP BY ALL",
    "train_numeric",
    recursive=True,
)
def ml_tuned_fit(t: Tables):
    """Models fitted with the settings that a search stored: whether each has those of its target, and the rows it predicts."""
    plan = tree_training(t)
    rows, features = plan.rows(), plan.learner.features(1, TARGETS)
    path = fresh_path(t.spark, "settings")
    trees.write_settings(trees.search(rows, features, trees.search_space(2, most_trees=4), survivors=1, trained=SEARCHED), path)
    stored_settings = trees.read_settings(t.spark, path)
    forest = trees.fit_forest(rows, features, stored_settings, stop_early=False)
    own = [(f.target, f.fold, f.settings == stored_settings[f.target] and f.trees == stored_settings[f.target]["maxIter"]) for f in forest.fits]
    counted = forest.oof(rows).groupBy("target", "fold").agg(F.count("pred_log").alias("n_predicted"))
    return t.spark.createDataFrame(own, "target string, fold int, as_stored boolean").join(counted, ["target", "fold"])


@query(
    "sink_model",
    f"WITH {EACH} SELECT 'stage1' AS stage, target, fold, count(*) AS n, count(*) AS n_equal FROM folded GROUP BY ALL",
    "train_numeric",
    recursive=True,
)
def sink_model(t: Tables):
    """All models stored and loaded through their manifest: the rows for which the loaded one predicts what the one in memory does."""
    _, rows, forest = first_forest(t, stop_early=False, common={**TREES, "maxIter": 2})
    path = fresh_path(t.spark, "models")
    forest.save(path, "stage1")
    loaded = trees.load_forest(t.spark, path, "stage1").oof(rows).withColumnRenamed("pred_log", "_loaded")
    both = forest.oof(rows).join(loaded.select("ID", "target", "_loaded"), ["ID", "target"], "full")
    equal = F.count_if(F.col("pred_log").eqNullSafe(F.col("_loaded"))).alias("n_equal")
    return both.groupBy(F.lit("stage1").alias("stage"), "target", "fold").agg(F.count("*").alias("n"), equal)


# --- stage choice, blending, masking, checking ------------------------------------------

STAGES = """s1 AS (SELECT avg(e) AS m FROM (SELECT target, sqrt(avg(power(y - greatest(pred, 0e0), 2))) AS e FROM oof GROUP BY target)),
    s2 AS (SELECT avg(e) AS m FROM (SELECT target, sqrt(avg(power(y - greatest(pred * 11e-1, 0e0), 2))) AS e FROM oof GROUP BY target)),
    chosen AS (SELECT * FROM preds_a WHERE (SELECT m FROM s1) <= (SELECT m FROM s2)
      UNION ALL SELECT * FROM preds_b WHERE (SELECT m FROM s1) > (SELECT m FROM s2))"""


def stage_scores(t: Tables):
    oof = t.view("oof")
    return {
        "stage1": learning.rmse_pooled(oof),
        "stage2": learning.rmse_pooled(oof.withColumn("pred", F.col("pred") * 1.1)),
    }


def stage_predictions(t: Tables):
    return {"stage1": t.view("preds_a"), "stage2": t.view("preds_b")}


@query("ml_stage_select", f"WITH {STAGES} SELECT * FROM chosen", "oof preds_a preds_b")
def ml_stage_select(t: Tables):
    return submission.choose_stage(stage_scores(t), stage_predictions(t))


W1, W2 = BLEND_WEIGHTS


@query(
    "ml_blend",
    "SELECT ID, "
    + ", ".join(f"round((coalesce(a.{n}, 0) * 35e-2 + coalesce(b.{n}, 0) * 65e-2) / 1e0, 6) AS {n}" for n in NAMES)
    + " FROM preds_a a JOIN preds_b b USING (ID)",
    "preds_a preds_b",
)
def ml_blend(t: Tables):
    return rounded(predictions.blend([(t.view("preds_a"), W1), (t.view("preds_b"), W2)]))


TEMPLATE = ["ID", *reversed(NAMES), "Target_Extra"]
MASKED = ", ".join(
    f"CASE WHEN {{p}}.Target_{x} IS NOT NULL THEN greatest({{p}}.Target_{x} * coalesce(m.{x}, 0), 0e0) END AS Target_{x}"
    for x in TARGETS
)


@query(
    "ml_apply_mask",
    f"SELECT p.ID, {MASKED.format(p='p')}, 0e0 AS Target_Extra FROM preds_a p LEFT JOIN mask m ON p.ID = m.ID",
    "preds_a mask",
)
def ml_apply_mask(t: Tables):
    return predictions.submission(t.view("preds_a"), t.view("mask"), TEMPLATE)


def _sum_over(template: str) -> str:
    return " + ".join(f"count(*) FILTER (WHERE {template.replace('§', x)})" for x in TARGETS)


VALIDATE = f"""facts AS (SELECT count(*) AS n_rows, (SELECT count(*) FROM test) AS expected,
      {_sum_over('p.Target_§ IS NULL')} AS nulls, {_sum_over('p.Target_§ < 0')} AS negatives,
      {_sum_over('m.§ = 0 AND (p.Target_§ IS NULL OR p.Target_§ <> 0)')} AS masked,
      {' + '.join(f'CAST(count(*) FILTER (WHERE p.Target_{x} > 0) > 0 AS INT)' for x in TARGETS)} AS ranged
      FROM checked p LEFT JOIN mask m ON p.ID = m.ID)
    SELECT 'rows' AS "check", CASE WHEN n_rows <> expected THEN 'fail' ELSE 'ok' END AS status, n_rows AS n FROM facts
    UNION ALL SELECT 'columns', 'ok', 0
    UNION ALL SELECT 'nulls', CASE WHEN nulls > 0 THEN 'fail' ELSE 'ok' END, nulls FROM facts
    UNION ALL SELECT 'negatives', CASE WHEN negatives > 0 THEN 'fail' ELSE 'ok' END, negatives FROM facts
    UNION ALL SELECT 'mask', CASE WHEN masked > 0 THEN 'fail' ELSE 'ok' END, masked FROM facts
    UNION ALL SELECT 'ranges', 'ok', ranged FROM facts
    UNION ALL SELECT 'verdict', CASE WHEN n_rows <> expected OR nulls + negatives + masked > 0 THEN 'fail' ELSE 'ok' END,
      CAST(n_rows <> expected OR nulls + negatives + masked > 0 AS INT) FROM facts"""


@query("ml_validate_submission", f"WITH checked AS (SELECT * FROM preds_a), {VALIDATE}", "preds_a mask test")
def ml_validate_submission(t: Tables):
    sample = t.view("test").select("ID", *[F.lit(0.0).alias(n) for n in NAMES])
    return predictions.validate(t.view("preds_a"), t.view("mask"), sample)
