"""Registered queries of preparation, learners, evaluation, explanation and exports."""

from __future__ import annotations

import functools
from collections.abc import Callable
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession, functions as F

from ebbtide.ml import explain, learners, metrics, prepare, registry, shapley, what_if
from ebbtide.ml.scores import score_export as export_scores
from ebbtide.ml.stack import META, StackModel, _safe, probability
from ebbtide.operators import quality, sampling
from ebbtide.operators.profile import score_sample_profile
from ebbtide.plans import training
from ebbtide.plans.feature_queries import presented
from ebbtide.plans.feature_set import Blocks
from ebbtide.sources import publish, readers, schemas, sinks
from ebbtide.sources.sample_tables import CONFIG, SampleTables

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
FOLDS = 10
SAMPLE = 1000
PRODUCT = "audio"
RUN_AT = datetime(2001, 7, 30, 12, 0, 0)


class Lab:
    """Training table and stack of one folder, made once per session and shared by queries."""

    _made: dict[tuple, Lab] = {}

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.blocks = spark, Blocks(
            SampleTables(spark, folder), CONFIG, stage=True)
        self._features = self._prepared = self._stack = None
        self._attributions = None

    @classmethod
    def of(cls, spark: SparkSession, folder: str) -> Lab:
        key = (spark.sparkContext.applicationId, folder)
        if key not in cls._made:
            cls._made[key] = cls(spark, folder)
        return cls._made[key]

    @property
    def sources(self) -> SampleTables:
        return self.blocks.sources

    @property
    def features(self) -> DataFrame:
        if self._features is None:
            self._features = training.stable(self.blocks.feature_set(PRODUCT))
        return self._features

    @property
    def prepared(self) -> training.Prepared:
        if self._prepared is None:
            self._prepared = training.prepare_training(
                self.features, PRODUCT, folds=FOLDS, active_only=False)
        return self._prepared

    @property
    def public(self) -> DataFrame:
        return self.prepared.rows.where(F.col("role") == "public")

    def candidates(self, *parts: str) -> list[str]:
        return [c for c in self.prepared.preparation.eligible if any(p in c for p in parts)]

    @property
    def stack(self) -> StackModel:
        if self._stack is None:
            chosen = training.build_learners(
                self.prepared, "diverse", PRODUCT, folds=FOLDS)
            chosen.append(learners.Learner("Events", "logr", self.candidates("ew_")))
            self._stack = training.stack_fit(
                self.prepared.rows, training.LABEL, chosen, FOLDS, keys=training.KEYS)
        return self._stack

    @property
    def predictions(self) -> DataFrame:
        return training.score(
            self.features, self.stack, self.prepared.preparation, active_only=False)

    @property
    def attributions(self) -> tuple[DataFrame, DataFrame, dict[str, float]]:
        """Attributions of every learner on a sample of fresh rows, its inputs, base scores.

        The background is the whole table of public training rows.
        """
        if self._attributions is None:
            fresh = sampling.random_sample_n(
                self.features.where(F.col("fresh") == 1), SAMPLE, "user_id", "explain")
            chosen = training.stable(training.scoring_rows(
                fresh, self.prepared.preparation, active_only=False))
            self._attributions = training.explain_learners(self.stack, chosen, self.public)
        return self._attributions


def register(function: Callable[[Lab], DataFrame]) -> Callable[[Lab], DataFrame]:
    def run(spark: SparkSession, folder: str) -> DataFrame:
        return presented(function(Lab.of(spark, folder)))

    QUERIES[function.__name__] = run
    return function


# ---- evaluation -----------------------------------------------------------

@register
def roc_curve(lab: Lab) -> DataFrame:
    return metrics.roc_curve(lab.sources.scored, "label", "score")


@register
def roc_auc(lab: Lab) -> DataFrame:
    return metrics.roc_auc(lab.sources.scored, "label", "score", ["fold"])


@register
def log_loss(lab: Lab) -> DataFrame:
    return metrics.log_loss(lab.sources.scored, "label", "score", ["fold"])


@register
def youden_threshold(lab: Lab) -> DataFrame:
    return metrics.youden_threshold(lab.sources.scored, "label", "score", ["fold"])


@register
def mean_roc(lab: Lab) -> DataFrame:
    return metrics.mean_roc(lab.sources.scored, "label", "score", "fold")


@register
def confusion_metrics(lab: Lab) -> DataFrame:
    return metrics.confusion_metrics(lab.sources.scored, "label", "score", 0.5, ["fold"])


# ---- preparation ----------------------------------------------------------

@register
def feature_registry(lab: Lab) -> DataFrame:
    features = lab.blocks.feature_set("video")
    roles = registry.feature_registry(features.columns, "video")
    role = F.create_map(*[F.lit(x) for pair in roles.items() for x in pair])
    return quality.na_counts(features).withColumn("role", role[F.col("column_name")])


@register
def sqrt_transform(lab: Lab) -> DataFrame:
    columns = registry.sqrt_candidates(lab.blocks.affinity.columns)
    chosen = [c for c in columns if "genre_share_" in c]
    rows = prepare.sqrt_transform(lab.blocks.affinity, chosen)
    return rows.select("user_id", "destination", "fresh", *[f"sqrt_{c}" for c in chosen])


@register
def maxabs_scale(lab: Lab) -> DataFrame:
    columns = ["streaming_time", "page_views", "genre_st_drama", "genre_st_sport"]
    rows = lab.blocks.affinity.select("user_id", "destination", "fresh", *columns)
    maxes = prepare.maxabs_fit(rows.where(F.col("fresh") == 0), columns)
    return prepare.maxabs_scale(rows.where(F.col("fresh") == 1), maxes)


@register
def one_hot_align(lab: Lab) -> DataFrame:
    people = lab.blocks.demographics(lab.blocks.cohorts)
    encoder = prepare.OneHot.fit(
        people.where(F.col("fresh") == 0), ["gender_enriched", "barb_region", "age_range"])
    rows = encoder.transform(people.where(F.col("fresh") == 1))
    return rows.select("user_id", *encoder.outputs)


@register
def model_impute(lab: Lab) -> DataFrame:
    """Imputed training rows: one row per imputed column with its remaining gaps."""
    filled = lab.prepared.filled
    return quality.na_counts(filled, list(registry.IMPUTED)).withColumn(
        "rows", F.lit(filled.count()).cast("long"))


@register
def stack_config(lab: Lab) -> DataFrame:
    features = lab.blocks.feature_set("audio")
    config = registry.stack_config("diverse", "audio", features.columns)
    pairs = [F.struct(F.lit(name).alias("learner"), F.lit(f).alias("feature"))
             for name, entry in config.items() for f in entry["features"]]
    names = sorted({f for entry in config.values() for f in entry["features"]})
    known = quality.na_counts(features, names)
    listed = F.filter(F.array(*pairs), lambda p: p["feature"] == F.col("column_name"))
    return known.select(F.explode(listed).alias("_p"), "n_null").select("_p.*", "n_null")


# ---- learners -------------------------------------------------------------

def _one_learner(lab: Lab, algorithm: str, features: list[str]) -> DataFrame:
    """Scores of every training row under one learner with its full settings, as facts.

    Boosted trees stop early on the first fold; the others are fitted on all public rows.
    """
    rows = lab.prepared.rows
    learner = learners.Learner("one", algorithm, features).watch_gaps(lab.public)
    data = rows.select("user_id", "role", "fold", training.LABEL, learner.vector_column())
    public = data.where(F.col("role") == "public")
    early = algorithm == "gbt"
    model = learners.fit_learner(
        learner, public.where(F.col("fold") != 0) if early else public,
        public.where(F.col("fold") == 0) if early else None, training.LABEL, rows=public.count())
    scored = training.stable(learners.predict(model, data, "probability"))
    area = metrics.roc_auc(scored.where(F.col("role") == "public"), training.LABEL,
                           "probability").select((F.col("auc") >= 0.5).cast("int").alias("no_worse"))
    return scored.agg(
        F.count(F.lit(1)).alias("rows"),
        F.count_if(F.col("probability").between(0, 1)).alias("scored")).crossJoin(area)


@register
def weak_learner_logr(lab: Lab) -> DataFrame:
    return _one_learner(lab, "logr", lab.candidates("ew_", "genre_share_"))


@register
def weak_learner_gbt(lab: Lab) -> DataFrame:
    return _one_learner(lab, "gbt", lab.candidates("genre_share_", "sched_match"))


@register
def weak_learner_mlp(lab: Lab) -> DataFrame:
    return _one_learner(lab, "mlp", lab.candidates("ew_", "genre_share_"))


@register
def weak_learner_rf(lab: Lab) -> DataFrame:
    return _one_learner(lab, "rf", lab.candidates("ew_", "genre_share_"))


def _facts(lab: Lab, rows: list[tuple], schema: str) -> DataFrame:
    return lab.spark.createDataFrame(rows, schema)


@register
def feature_select_rfe(lab: Lab) -> DataFrame:
    candidates = lab.candidates("ew_")
    names = learners.feature_select_rfe(
        lab.public, training.LABEL, candidates, 3)
    return _facts(lab, [(len(names), int(set(names) <= set(candidates)))],
                  "n_kept long, all_known int")


@register
def feature_select_gain(lab: Lab) -> DataFrame:
    candidates = lab.candidates("ew_", "genre_share_")
    best = [r["feature"] for r in learners.feature_select_gain(
        lab.public, training.LABEL, candidates, 10, folds=FOLDS).collect()]
    return _facts(lab, [(len(best), int(set(best) <= set(candidates)))],
                  "n_kept long, all_known int")


# Columns of the table on which the right choice is known: three make the label, the others do not.
INFORMED = ("level", "turn", "early")
NOISE = {f"noise_{m}": f"CAST(row_id * 7919 % {m} AS DOUBLE) / {m}" for m in (101, 211, 307, 401)}


def _known_choice(lab: Lab) -> DataFrame:
    """One row per event: a label that follows from three columns, and four columns beside it."""
    rows = lab.sources.scored.selectExpr(
        "row_id", "fold", "score AS level", "CAST(row_id % 5 AS DOUBLE) / 4 AS turn",
        "CAST(row_id % 3 AS DOUBLE) / 2 AS early", *[f"{v} AS {n}" for n, v in NOISE.items()])
    return rows.withColumn("label", F.expr(
        "CAST(8 * (level - 0.5) - 1.5 * (turn - 0.5) + 1.2 * (early - 0.5)"
        " + 0.3 * (row_id % 7 - 3) > 0 AS INT)"))


@register
def feature_select_known(lab: Lab) -> DataFrame:
    """What both selections keep of a table on which three of seven columns matter."""
    rows = _known_choice(lab)
    columns = [*INFORMED, *NOISE]
    kept = learners.feature_select_rfe(rows, "label", columns, len(INFORMED))
    best = learners.feature_select_gain(
        rows, "label", columns, len(INFORMED), folds=5, params={"maxIter": 20}).collect()
    out = [("rfe", c, 0) for c in kept]
    out += [("gain", r["feature"], int(i == 0)) for i, r in enumerate(best)]
    return _facts(lab, out, "method string, feature string, first int")


@register
def logistic_equations(lab: Lab) -> DataFrame:
    """(fold, input): rows of the other folds, and whether their score equation holds.

    At the fitted weights the residuals of each input, on its scale, add up to the rows times the
    penalty times its weight.
    """
    folds, columns = 5, [*INFORMED, *NOISE]
    learner = learners.Learner("known", "logr", columns)
    rows = training.stable(_known_choice(lab).select(
        "row_id", "fold", "label", *columns, learner.vector_column()))
    n = rows.count()
    models = learners.fit_folds([learner], rows, "label", "fold", folds, rows=n,
                                keys=["row_id"])["known"]
    parts = []
    for i, model in enumerate(models):
        scaler, last = model.stages
        inputs = [*zip(columns, scaler.maxAbs.toArray(), last.coefficients.toArray()),
                  ("intercept", 1.0, 0.0)]
        scored = learners.predict(model, rows.where(F.col("fold") != i), "p").withColumn(
            "intercept", F.lit(1.0))
        sums = scored.agg(F.count(F.lit(1)).alias("rows"), *[
            (F.avg((F.col("p") - F.col("label")) * F.col(c) / F.lit(float(top)))
             + F.lit(float(weight) / n)).alias(c) for c, top, weight in inputs])
        parts.append(sums.select(F.lit(i).alias("fold"), "rows", F.explode(F.array(*[
            F.struct(F.lit(c).alias("input"), (F.abs(c) < 1e-7).cast("int").alias("holds"))
            for c, *_ in inputs])).alias("e")).select("fold", "rows", "e.*"))
    return functools.reduce(DataFrame.unionAll, parts)


@register
def impute_regression(lab: Lab) -> DataFrame:
    """Imputed rows: all, those filled, and those filled as the regression line has it."""
    rows = lab.sources.table("events").where(F.col("value").isNotNull()).select(
        F.col("event_id").alias("user_id"), F.col("value").alias("x"),
        F.when(F.col("event_id") % 7 > 0, F.col("value") / 40 + F.col("event_id") % 5)
        .alias("y"))
    filled = prepare.Imputer.fit(rows, {"y": "regression"}, ["x"]).transform(rows)
    slope, start = rows.agg(F.regr_slope("y", "x"), F.regr_intercept("y", "x")).first()
    gap = F.col("user_id") % 7 == 0
    right = F.abs(F.col("y") - F.lit(start or 0.0) - F.lit(slope or 0.0) * F.col("x")) < 1e-4
    return filled.agg(
        F.count(F.lit(1)).alias("rows"), F.count_if(gap & F.col("y").isNotNull()).alias("filled"),
        F.count_if(gap & right).alias("on_the_line"))


@register
def stack_fit_logistic(lab: Lab) -> DataFrame:
    """Per learner of the logistic stack: folds fitted, and whether it ranks held-out rows."""
    chosen = training.build_learners(lab.prepared, "logistic", PRODUCT, folds=FOLDS)
    model = training.stack_fit(lab.prepared.rows, training.LABEL, chosen, FOLDS,
                               keys=training.KEYS)
    rows = [(x.name, len(model.fold_models[x.name]), len(x.features) > 0,
             0 < model.thresholds[x.name] < 1) for x in model.learners]
    rows.append((META, 1, True, 0 < model.thresholds[META] < 1))
    return _facts(lab, rows, "learner string, models long, has_features boolean, cut boolean")


@register
def stack_fit(lab: Lab) -> DataFrame:
    """Facts of the fitted stack: thresholds of all learners, loss and area in their range."""
    model = lab.stack
    known = {"threshold": list(model.thresholds.values()),
             "auc": [v for v in model.scores["auc"].values() if v is not None]}
    rows = [(kind, len(v) if kind == "threshold" else 0, int(all(0 <= x <= 1 for x in v)))
            for kind, v in known.items()]
    losses = model.scores["log_loss"]
    rows.append(("log_loss", len(losses), int(all(0 <= x < 40 for x in losses.values()))))
    return _facts(lab, rows, "measure string, n long, in_range int")


@register
def stack_predict(lab: Lab) -> DataFrame:
    """Per learner of the stack: fresh rows, and those with a probability and the right class."""
    names = [*[x.name for x in lab.stack.learners], META]
    parts = [F.struct(
        F.lit(n).alias("learner"), F.col(probability(n)).alias("p"),
        (F.col(f"class_{_safe(n)}") == (
            F.col(probability(n)) >= lab.stack.thresholds[n]).cast("int")).alias("right"))
        for n in names]
    long = lab.predictions.select(F.explode(F.array(*parts)).alias("s")).select("s.*")
    return long.groupBy("learner").agg(
        F.count(F.lit(1)).alias("rows"),
        F.count_if(F.col("p").between(0, 1) & F.col("right")).alias("scored"))


@register
def importance_mean(lab: Lab) -> DataFrame:
    return learners.importance_mean(
        lab.sources.explained.select("learner", "fold", "feature", F.abs("value").alias("gain")))


# ---- explanation ----------------------------------------------------------

LINEAR = {"streaming_time": 0.001, "page_views": -0.02, "genre_share_drama": 1.5}


@register
def linear_contributions(lab: Lab) -> DataFrame:
    rows = lab.blocks.affinity.where(F.col("fresh") == 1).withColumn(
        "row_id", F.concat_ws("/", "user_id", "destination"))
    return explain.linear_contributions(rows, LINEAR, key="row_id")


@register
def shapley_sampled(lab: Lab) -> DataFrame:
    """Per learner: explained rows, and those whose values add up to score minus base score."""
    values, _, base = lab.attributions
    totals = values.groupBy("learner", "user_id").agg(F.sum("value").alias("total"))
    explained = lab.features.join(totals.select("user_id").distinct(), "user_id", "left_semi")
    fresh = training.scoring_rows(explained, lab.prepared.preparation, active_only=False)
    distances = []
    for learner in lab.stack.learners:
        scored = training.explained_score(
            learner, lab.stack.fold_models[learner.name],
            fresh.select("user_id", learner.vector_column()), "p")
        distances.append(scored.select(
            F.lit(learner.name).alias("learner"), "user_id",
            (F.col("p") - F.lit(base[learner.name])).alias("distance")))
    scores = functools.reduce(DataFrame.unionAll, distances)
    return totals.join(scores, ["learner", "user_id"]).groupBy("learner").agg(
        F.count(F.lit(1)).alias("rows"),
        F.count_if(F.abs(F.col("total") - F.col("distance")) < 1e-6).alias("add_up"))


# Two trees of two features each, so that SQL can follow them.
TREE_INPUTS = ("streaming_time", "page_views", "genre_share_drama")
TREES = (
    shapley.Tree({0: (0, 1000.0, 1, 2), 1: 0.5, 2: (1, 3.0, 3, 4), 3: -1.0, 4: 2.0}),
    shapley.Tree({0: (2, 0.2, 1, 2), 1: 1.0, 2: (0, 4000.0, 3, 4), 3: -3.0, 4: 0.25}, 0.5))


@register
def shapley_trees(lab: Lab) -> DataFrame:
    """Exact values of a fixed ensemble for every fresh row, against all training rows."""
    rows = lab.blocks.affinity.withColumn("row_id", F.concat_ws("/", "user_id", "destination"))
    known = rows.where(F.col("fresh") == 0).select(*TREE_INPUTS)
    leaves = shapley.leaves_of(TREES, TREE_INPUTS)
    counts = shapley.background_of(leaves, known, TREE_INPUTS)
    return shapley.tree_shapley(leaves, counts, rows.where(F.col("fresh") == 1), TREE_INPUTS,
                                key="row_id")


@register
def attribution_summary(lab: Lab) -> DataFrame:
    return explain.attribution_summary(lab.sources.explained)


@register
def attribution_export(lab: Lab) -> DataFrame:
    """Two exports, the second of some learners again."""
    rows = lab.sources.explained.drop("fold").withColumnRenamed("learner", "learner_name")
    path = sinks.scratch(lab.spark, "attributions")
    sinks.partitioned_export(rows, path)
    return sinks.partitioned_export(rows.where(F.col("learner_name") == "click"), path)


@register
def attribution_current(lab: Lab) -> DataFrame:
    """Attributions of the newest of two published runs, by learner and without users."""
    rows = lab.sources.explained.drop("fold", "user_id", "target_week_start_date")
    root = sinks.scratch(lab.spark, "published")
    for run in (rows.where(F.col("learner") == "click"), rows):
        publish.publish(lab.spark, root, {"attributions": run}, by={"attributions": ["learner"]})
    return publish.read_current(lab.spark, root, "attributions")


@register
def dependence_pairs(lab: Lab) -> DataFrame:
    return explain.dependence_pairs(lab.sources.explained, "level")


@register
def decision_paths(lab: Lab) -> DataFrame:
    rows = lab.sources.explained.where(F.col("learner") == "click")
    return explain.decision_paths(rows, key="user_id", start=0.25)


# ---- what-if --------------------------------------------------------------

AVERAGED = (["acc_age_days", "age"], ["acorn_group_description", "barb_region"])
CHANGES = (("acc_age_days", "delta", "100"), ("acc_age_days", "replace", "50"),
           ("age", "delta", "-2.5"), ("barb_region", "replace", "EUROPE"))


def _segment_facts(lab: Lab) -> DataFrame:
    people = lab.blocks.demographics(lab.blocks.cohorts).where(F.col("fresh") == 1)
    facts = score_sample_profile(people, lab.sources.profile, lab.sources.profile_extension)
    return people.drop("age", "gender", "nation").join(facts, "user_id")


def _fixed_score(users: DataFrame, keys) -> DataFrame:
    """A plain score in place of the stack, so that SQL can follow it."""
    europe = (F.col("barb_region") == "EUROPE").cast("int")
    return users.select(*keys, (F.col("acc_age_days") / 10000 + F.col("age") / 1000
                                + europe / 4).alias("p"))


@register
def average_users(lab: Lab) -> DataFrame:
    """Medians and modes of profile columns over the five segments."""
    return what_if.average_users(
        _segment_facts(lab), *AVERAGED, what_if.default_segments())


@register
def representative_users(lab: Lab) -> DataFrame:
    modifiers = lab.spark.createDataFrame(
        [(s, *c) for s in what_if.default_segments() for c in CHANGES],
        "user_id string, mod_column string, method string, modifier string")
    return what_if.representative_users(_segment_facts(lab), modifiers, *AVERAGED, _fixed_score)


@register
def what_if_export(lab: Lab) -> DataFrame:
    """Impacts of two runs, read back through the pointer of the published versions."""
    modifiers = lab.spark.createDataFrame(
        [(s, *c) for s in what_if.default_segments() for c in CHANGES],
        "user_id string, mod_column string, method string, modifier string")
    root, facts = sinks.scratch(lab.spark, "what-if"), training.stable(_segment_facts(lab))
    for changes in (modifiers.where("method = 'delta'"), modifiers):
        out = training.what_if_run(facts, changes, *AVERAGED, _fixed_score, root)
    return out


@register
def representative_scores(lab: Lab) -> DataFrame:
    return what_if.representative_scores(
        _segment_facts(lab), *AVERAGED, lambda users: _fixed_score(users, ["user_id"]))


# ---- exports --------------------------------------------------------------

@register
def score_export(lab: Lab) -> DataFrame:
    """Score records out of wide predictions, with the thresholds of their learners."""
    chosen = [learners.Learner(n, "logr", []) for n in ("Up", "Down")]
    stack = StackModel(chosen, 1, {}, {"Up": 0.5, "Down": 0.4, META: 0.6}, {}, None, [])
    return export_scores(lab.sources.predicted, stack, PRODUCT, RUN_AT)


@register
def score_append(lab: Lab) -> DataFrame:
    """Two runs of each product appended, the second one repeated."""
    scores = lab.sources.score_history
    middle = F.lit("2024-01-15").cast("date")
    path = sinks.scratch(lab.spark, "scores")
    first, second = (scores.where(F.col("target_week_start_date") < middle),
                     scores.where(F.col("target_week_start_date") >= middle))
    for batch in (first, second, second):
        for product in ("video", "audio"):
            out = sinks.score_append(batch, path, product)
    return out.drop("score_datetime")


@register
def historical_partition(lab: Lab) -> DataFrame:
    path = sinks.scratch(lab.spark, "history")
    scores = lab.sources.score_history.select("user_id", "learner_name", "predicted_probability")
    sinks.historical_partition(scores.where(F.col("learner_name") == "click"), path, "2024-01-01")
    return sinks.historical_partition(scores, path, "2024-01-08")


@register
def csv_feature_roundtrip(lab: Lab) -> DataFrame:
    return sinks.csv_feature_roundtrip(lab.blocks.targets, sinks.scratch(lab.spark, "csv"))


@register
def modifiers_csv(lab: Lab) -> DataFrame:
    """What-if modifiers written as CSV and read with their schema."""
    key = F.col("c_custkey")
    given = lab.sources.table("customer").select(
        F.concat(F.lit("user_"), key.cast("string")).alias("user_id"),
        F.concat(F.col("c_name"), F.lit(', "x"\n')).alias("mod_column"),
        F.when(key % 2 == 0, "delta").otherwise("replace").alias("method"),
        F.when(key % 5 > 0, F.col("c_nationkey").cast("string")).alias("modifier"))
    path = sinks.scratch(lab.spark, "modifiers")
    sinks.write_features(given, path, "csv")
    return readers.read_csv(lab.spark, path, schemas.MODIFIERS)


@register
def score_csv_load(lab: Lab) -> DataFrame:
    """Scores from CSV files appended to the history."""
    path = sinks.scratch(lab.spark, "score-files")
    sinks.write_features(lab.sources.score_history, path, "csv")
    loaded = readers.read_csv(lab.spark, path, schemas.SCORES)
    out = sinks.score_append(loaded, sinks.scratch(lab.spark, "loaded"), "video")
    return out.drop("score_datetime")


@register
def score_csv_rejects(lab: Lab) -> DataFrame:
    """Rows of a score file with values of the wrong type, one row for each such value."""
    path = sinks.scratch(lab.spark, "bad-files")
    key = F.col("user_id").cast("bigint")
    texts = [F.col(c).cast("string").alias(c) for c in schemas.SCORES.fieldNames()]
    given = lab.sources.score_history.select(*texts).withColumns({
        "predicted_probability": F.when(key % 17 == 0, "n/a").otherwise(
            F.col("predicted_probability")),
        "target_week_start_date": F.when(key % 19 == 0, "2024-13-45").otherwise(
            F.col("target_week_start_date")),
        "optimal_classification": F.when(key % 5 > 0, F.col("optimal_classification"))})
    sinks.write_features(given, path, "csv")
    loaded = readers.load_csv(lab.spark, path, schemas.SCORES,
                              sinks.scratch(lab.spark, "rejects"), most=0.5)
    kept = loaded.rows.groupBy("user_id").agg(F.count(F.lit(1)).alias("n")).select(
        "user_id", F.lit("kept").alias("column_name"), F.col("n").cast("string").alias("value"))
    faults = loaded.rejects.select("fields.user_id", F.explode("faults").alias("f")).select(
        "user_id", F.col("f.column").alias("column_name"), "f.value")
    return kept.unionByName(faults)
