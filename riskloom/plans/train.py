"""Train, benchmark and select classifiers per disease.

Per disease: panel → recipe → exact stratified 80/20 split → (optional
stratified cap) → leakage-free preprocessing fitted on the training rows →
four class-weighted classifiers → 3-fold stratified CV F1 (the preprocessor is
refitted inside every fold) → test metrics → winner by F1 (ties in training
order) → artifacts.

All diseases given are trained together: their rows form one training table
(``operators.fitting``), and one job serves every fit of a kind: a Newton step of
the logistic regressions, all trees of the boosted models or of the random
forests, of all diseases and folds (a tree level of them where a disease has more
rows than a task holds). All models are judged in one frame.
"""

from __future__ import annotations

import json
import os
import time
import uuid
from concurrent.futures import ThreadPoolExecutor
from dataclasses import asdict, dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.recipes import engineer_features
from ..operators import boosting, fitting, metrics, prep, split
from ..operators.clean import split_by_dtype, split_features_target
from ..operators.fitting import ALL, Frame, Layout, frame_of, group_parts, quick_session, x_column
from ..operators.forests import forest_fits, forest_levels
from ..operators.newton import Logistic, logistic_fits
from ..operators.trees import Forest
from ..session import ensure_checkpoint_dir, ship_code

# --- fixed values: the four compared classifiers, in training order.
MODEL_NAMES = ["XGBoost (Balanced)", "Random Forest (Balanced)", "Gradient Boosting", "Logistic Regression (Balanced)"]
XGBOOST, FOREST, GRADIENT, LOGISTIC = MODEL_NAMES
ID_COLS = ("patient_id",)
#: training rows per partition of the shared table: below this, a task is not worth its start
ROWS_PER_TRAIN_PARTITION = 5_000
#: no partition is larger, however few the cores
MOST_ROWS_PER_TRAIN_PARTITION = 250_000
CV_FOLDS = 3


@dataclass
class Fitted:
    """A disease's classifier: a ``Logistic`` over standardised features or a ``Forest`` over imputed ones."""
    disease: str
    name: str
    preprocessor: prep.PreprocessorModel
    model: object
    metrics: dict = field(default_factory=dict)

    def feature_names(self):
        return self.preprocessor.feature_names()

    @property
    def is_tree(self) -> bool:
        return isinstance(self.model, Forest)

    def features(self) -> list:
        """The model's inputs as columns of the engineered panel: imputed, and scaled for a logistic regression."""
        return [e for _, e in self.preprocessor.feature_exprs(scaled=not self.is_tree)]

    def with_probability(self, eng: DataFrame, out: str, x: str = "__x") -> DataFrame:
        """``eng`` with P(Outcome = 1): a closed form, or the trees walked inside the row; a narrow projection either way."""
        if not self.is_tree:
            return eng.withColumn(out, self.model.probability(self.features()))
        return eng.withColumn(x, F.array(*self.features())).withColumn(out, self.model.probability(x)).drop(x)

    def score(self, df: DataFrame, out: str = "probability_1", keep=ID_COLS) -> DataFrame:
        """X16 + M6: P(Outcome = 1) and the predicted class for every row of a panel-shaped frame."""
        eng = engineer_features(df, self.disease)
        scored = self.with_probability(eng, out).select(*[k for k in keep if k in eng.columns], out)
        return scored.withColumn("pred", (F.col(out) > F.lit(0.5)).cast("int"))


# ---------------------------------------------------------------- the training table
@dataclass
class _Disease:
    """One disease's rows (fold: null for test rows) and the preprocessors of its frames.

    ``rows`` has all training rows, ``rest`` test rows that lie in no training table, or ``None``."""
    name: str
    rows: DataFrame
    rest: DataFrame | None
    pre: dict
    frames: dict
    seconds: float

    def categories(self) -> dict:
        return self.pre[None].categories


def _prepared(panel: DataFrame, disease: str, max_train_rows, cv_folds: int) -> _Disease:
    t0 = time.time()
    df = engineer_features(panel, disease)
    split_features_target(df)  # P9: fails fast without an Outcome column
    # one ranking gives split, cap and folds; every model reuses it (lineage cut, survives executor loss)
    rows, rest = split.train_test_parts(df, "Outcome", list(ID_COLS), k=cv_folds, max_train_rows=max_train_rows)
    rows = rows.checkpoint(eager=True)
    train = rows.where(F.col("fold").isNotNull())
    numeric, categorical = split_by_dtype(train, exclude=[*ID_COLS, "Outcome", "fold"])
    pre = prep.fit_preprocessors(train, numeric, categorical, cv_folds)
    n = {(r["fold"], r["Outcome"]): r["n"] for r in train.groupBy("fold", "Outcome").agg(F.count(F.lit(1)).alias("n")).collect()}
    frames = {}
    for f in [None, *range(cv_folds)]:
        neg, pos = (sum(v for (fold, y), v in n.items() if y == label and fold != f) for label in (0, 1))
        frames[f] = frame_of(disease, ALL if f is None else f, pre[f], pre[None].categories, neg, pos)
    return _Disease(disease, rows, rest, pre, frames, time.time() - t0)


def _training_table(diseases: list, path: str) -> Layout:
    """Write all diseases' ``rows`` to ``path``: grp, salt, rid, y, fold (null: test) and x.

    ``salt`` is the row's partition: a disease with more rows than a partition should hold has several, the others one."""
    table, first = None, 0
    rows = [max(1, d.frames[None].n_neg + d.frames[None].n_pos) for d in diseases]
    wanted = fitting.TASKS_PER_CORE * diseases[0].rows.sparkSession.sparkContext.defaultParallelism
    per = min(MOST_ROWS_PER_TRAIN_PARTITION, max(ROWS_PER_TRAIN_PARTITION, -(-sum(rows) // wanted)))
    salts = [-(-n // per) for n in rows]
    for d, n in zip(diseases, salts):
        part = _rows_of(d, d.rows, first, n)
        table = part if table is None else table.unionByName(part)
        first += n
    layout = Layout(first, max(salts) == 1)
    table.repartitionById(layout.partitions, "salt").write.parquet(path)
    return layout


def _rows_of(d: _Disease, rows: DataFrame, first: int = 0, salts: int = 1) -> DataFrame:
    salt = F.lit(first) + F.pmod(F.xxhash64("patient_id"), F.lit(salts)).cast("int")
    return rows.select(F.lit(d.name).alias("grp"), salt.alias("salt"),
                       F.col("patient_id").cast("long").alias("rid"), F.col("Outcome").cast("double").alias("y"),
                       F.col("fold").cast("int").alias("fold"), x_column(d.pre[None].numeric, d.categories()).alias("x"))


# ---------------------------------------------------------------- fits
def _fit_all(table: DataFrame, layout: Layout, diseases: list, models) -> tuple:
    """({(disease, model, fold or None): fitted}, seconds of each model's fits of all diseases)."""
    frames = [f for d in diseases for f in d.frames.values()]
    keys = [(d.name, f) for d in diseases for f in d.frames]
    fits, seconds = {}, {}
    boosted = [m for m in (XGBOOST, GRADIENT) if m in models]
    t0 = time.time()
    edges = boosting.bin_edges(table, frames) if boosted or FOREST in models else None
    binning = (time.time() - t0) / max(1, len(boosted) + (FOREST in models))
    if boosted:
        t0 = time.time()
        settings = {XGBOOST: boosting.XGBOOST, GRADIENT: boosting.GRADIENT}
        for (disease, f), found in zip(keys, boosting.boosted_fits(table, frames, [settings[m] for m in boosted], layout, edges)):
            fits.update({(disease, m, f): forest for m, forest in zip(boosted, found)})
        # the models grow together: a share of the time by their trees
        trees = sum(settings[m].trees for m in boosted)
        seconds.update({m: (time.time() - t0) * settings[m].trees / trees + binning for m in boosted})
    if LOGISTIC in models:
        t0 = time.time()
        fits.update({(disease, LOGISTIC, f): m for (disease, f), m in zip(keys, logistic_fits(table, frames, layout=layout))})
        seconds[LOGISTIC] = time.time() - t0
    if FOREST in models:
        t0, size = time.time(), fitting.cells(frames)
        small = {g for g, n in size.items() if n <= fitting.MAX_CELLS}
        for grow, own in ((forest_fits, small), (lambda *a, **k: forest_levels(*a, layout=layout, **k), size.keys() - small)):
            at = [i for i, f in enumerate(frames) if f.group in own]
            found = grow(table, [frames[i] for i in at], edges=[edges[i] for i in at]) if at else []
            fits.update({(keys[i][0], FOREST, keys[i][1]): m for i, m in zip(at, found)})
        seconds[FOREST] = time.time() - t0 + binning
    return fits, seconds


_SCORED = "disease string, model_name string, part int, y int, pred int, score double"


def _scored(table: DataFrame, fits: dict, frames: dict) -> DataFrame:
    """Every test row under the models of the whole training frame (part -1) and every training row under those that left
    its fold out (part: the fold)."""
    ship_code(table.sparkSession)
    of_group: dict = {}
    for (disease, name, f), model in fits.items():
        of_group.setdefault(disease, []).append((name, frames[disease][f], model))

    def run(batches):
        for batch in batches:
            for group, _, y, _, fold, x in group_parts(batch):
                for name, frame, model in of_group.get(group, ()):
                    pick = frame.held_out(fold)
                    if not pick.any():
                        continue
                    p = probabilities(model, frame, x[pick])
                    n = len(p)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([group] * n), pa.array([name] * n), pa.array(np.full(n, frame.without, np.int32)), pa.array(y[pick].astype(np.int32)),
                         pa.array((p > 0.5).astype(np.int32)), pa.array(p)], names=["disease", "model_name", "part", "y", "pred", "score"])
    return table.mapInArrow(run, _SCORED)


def probabilities(model, frame: Frame, x: np.ndarray) -> np.ndarray:
    """P(1) of raw feature rows (for tasks)."""
    if isinstance(model, Logistic):
        return 1.0 / (1.0 + np.exp(-np.clip(model.margins((frame.filled(x) - frame.mean) / frame.scale), -700, 700)))
    return model.probabilities(frame.filled(x))


def train_many(panels: dict, models=tuple(MODEL_NAMES), max_train_rows: int | None = None, cv_folds: int = CV_FOLDS,
               out_dir: str | None = None, parallelism: int = 8) -> tuple:
    """X14, X15 for several diseases at once ({disease: panel}): (metrics DataFrame, {disease: winner}).

    ``parallelism``: driver threads that submit the preparation of panels."""
    spark = next(iter(panels.values())).sparkSession
    scratch = f"{ensure_checkpoint_dir(spark).rstrip('/')}/riskloom-forests-{uuid.uuid4().hex}"
    with ThreadPoolExecutor(max_workers=max(1, parallelism)) as pool:
        diseases = list(pool.map(lambda d: _prepared(panels[d], d, max_train_rows, cv_folds), panels))
    path = f"{scratch}/table"
    layout = _training_table(diseases, path)
    steps = quick_session(spark).read.parquet(path).where("fold IS NOT NULL").repartitionById(layout.partitions, "salt").persist()
    fits, seconds = _fit_all(steps, layout, diseases, models)
    steps.unpersist()
    t_eval = time.time()
    frames, scored = {d.name: d.frames for d in diseases}, None
    for d in diseases:  # a task gets the models of one disease only: forests of many rows are large
        own = {k: m for k, m in fits.items() if k[0] == d.name}
        parts = [spark.read.parquet(path).where(F.col("grp") == d.name)]
        if d.rest is not None:  # where they are read: neither ranked nor written
            parts.append(_rows_of(d, d.rest))
        for rows in parts:
            part = _scored(rows, own, frames)
            scored = part if scored is None else scored.unionByName(part)
    # a row per model and score, counted in the tasks that score
    counts = metrics.score_counts(scored, "y", "pred", "score", ["disease", "model_name", "part"]).checkpoint(eager=True)
    by_part = {(r["disease"], r["model_name"], r["part"]): r for r in
               metrics.classification_of_counts(counts, "pred", ["disease", "model_name", "part"]).collect()}
    ranked = {(r["disease"], r["model_name"]): r for r in
              metrics.ranking_of_counts(counts.where("part = -1"), ["disease", "model_name"]).collect()}
    # M7: a model's part of the shared work: preparation and evaluation split evenly, fits by disease
    share = (time.time() - t_eval) / max(1, len(models) * len(diseases))
    nothing = {"accuracy": 0.0, "precision": 0.0, "recall": 0.0, "f1": 0.0}
    rows, winners = [], {}
    for d in diseases:
        own = []
        for name in models:
            t, rk = by_part.get((d.name, name, ALL), nothing), ranked.get((d.name, name))
            ev = {**{k: t[k] for k in nothing}, "roc_auc": rk["roc_auc"] if rk else 0.5, "pr_auc": rk["avg_precision"] if rk else 0.5}
            cv = np.array([by_part.get((d.name, name, f), nothing)["f1"] for f in range(cv_folds)] or [0.0])
            spent = seconds[name] / len(diseases) + d.seconds / len(models) + share
            own.append((d.name, name, float(cv.mean()), float(cv.std()), ev["accuracy"], ev["precision"], ev["recall"], ev["f1"], ev["roc_auc"],
                        ev["pr_auc"], spent, MODEL_NAMES.index(name)))
        rows += own
        best = min(own, key=lambda r: (-r[7], r[11]))
        n_test = by_part[d.name, best[1], ALL]["n"] if (d.name, best[1], ALL) in by_part else 0
        counts = {"n_train": d.frames[None].n_neg + d.frames[None].n_pos, "n_test": int(n_test)}
        ev = dict(zip(("accuracy", "precision", "recall", "f1", "roc_auc", "pr_auc"), best[4:10]))
        winners[d.name] = Fitted(d.name, best[1], d.pre[None], fits[d.name, best[1], None], {**ev, **counts})
    res = spark.createDataFrame(rows, RESULT_SCHEMA)
    if out_dir:
        def save(d):
            background = split.fixed_sample(d.rows.where("fold IS NOT NULL").drop("fold"), BACKGROUND_ROWS, list(ID_COLS))
            save_artifacts(winners[d.name], res.where(F.col("disease") == d.name), out_dir, background)
        with ThreadPoolExecutor(max_workers=max(1, parallelism)) as pool:
            list(pool.map(save, diseases))
    return res, winners


def train_disease(panel: DataFrame, disease: str, models=tuple(MODEL_NAMES), max_train_rows: int | None = None,
                  cv_folds: int = CV_FOLDS, out_dir: str | None = None, parallelism: int = 8):
    """Returns (metrics DataFrame, winner ``Fitted``)."""
    res, winners = train_many({disease: panel}, models, max_train_rows, cv_folds, out_dir, parallelism)
    return res, winners[disease]


RESULT_SCHEMA = T.StructType([
    T.StructField("disease", T.StringType()), T.StructField("model_name", T.StringType()),
    T.StructField("cv_f1_mean", T.DoubleType()), T.StructField("cv_f1_std", T.DoubleType()),
    T.StructField("test_accuracy", T.DoubleType()), T.StructField("test_precision", T.DoubleType()),
    T.StructField("test_recall", T.DoubleType()), T.StructField("test_f1", T.DoubleType()),
    T.StructField("test_roc_auc", T.DoubleType()), T.StructField("test_pr_auc", T.DoubleType()),
    T.StructField("training_seconds", T.DoubleType()), T.StructField("training_order", T.IntegerType()),
])


def select_best(results: DataFrame) -> DataFrame:
    """Winner per disease by test F1, ties in training order (an aggregate, no window)."""
    best = results.groupBy("disease").agg(
        F.max(F.struct("test_f1", (-F.col("training_order")).alias("neg_order"), "model_name")).alias("b"))
    return results.join(best.select("disease", F.col("b.model_name").alias("model_name")), ["disease", "model_name"])


# ---------------------------------------------------------------- artifacts
#: attribution background: training rows in hash order
BACKGROUND_ROWS = 100
#: the disease whose artifacts also lie in the root folder
ROOT_DISEASE = "diabetes"
_POINTER = "current"


def _versioned(folder: str) -> str:
    return f"{folder}/versions/{uuid.uuid4().hex}"


def _publish(spark: SparkSession, folder: str, version: str) -> None:
    """Point readers of ``folder`` to a finished version: a new numbered one-row table, complete before it is seen."""
    from ..sources.files import list_names
    numbers = [int(n) for n in list_names(spark, f"{folder}/{_POINTER}") if n.isdigit()]
    spark.createDataFrame([(os.path.basename(version),)], "version string").coalesce(1).write.mode("errorifexists").text(
        f"{folder}/{_POINTER}/{max(numbers, default=0) + 1:08d}")


def current_version(spark: SparkSession, folder: str) -> str | None:
    """The folder of the newest finished version, or ``None``."""
    from ..sources.files import _exists, list_names
    for n in sorted((n for n in list_names(spark, f"{folder}/{_POINTER}") if n.isdigit()), reverse=True):
        if _exists(spark, f"{folder}/{_POINTER}/{n}/_SUCCESS"):
            return f"{folder}/versions/{spark.read.text(f'{folder}/{_POINTER}/{n}').first()['value']}"
    return None


def save_artifacts(fitted: Fitted, results: DataFrame | None, out_dir: str, background: DataFrame | None = None) -> str:
    """Model, preprocessor parameters, feature names, train/test row counts, the comparison table (when there is one)
    and the background rows for attribution, all in a new version folder. The pointer to it comes last: until then, and
    if a writer stops midway, readers keep the version before. Diabetes is published in the root folder too."""
    spark = SparkSession.active()
    folder = os.path.join(out_dir, fitted.disease)
    version = _versioned(folder)
    if results is not None:
        results.write.parquet(f"{version}/model_comparison_results")
    if background is not None:
        background.write.parquet(f"{version}/background")
    pre = fitted.preprocessor
    model = {"forest": fitted.model.to_json()} if fitted.is_tree else asdict(fitted.model)
    meta = {"disease_key": fitted.disease, "best_model_name": fitted.name, "model_class": type(fitted.model).__name__, "model": model,
            "numeric": pre.numeric, "categorical": pre.categorical, "medians": pre.medians, "means": pre.means,
            "scales": pre.scales, "modes": pre.modes, "categories": pre.categories,
            "feature_names": pre.feature_names(), **{f"test_{k}": v for k, v in fitted.metrics.items()}}
    spark.createDataFrame([(json.dumps(meta),)], "meta string").coalesce(1).write.text(f"{version}/metadata")
    _publish(spark, folder, version)
    if fitted.disease == ROOT_DISEASE:
        spark.createDataFrame([(f"{fitted.disease}/versions/{os.path.basename(version)}",)], "version string").coalesce(1).write.mode(
            "overwrite").text(os.path.join(out_dir, "root_model"))
    # one row per saved winner in a registry table, a partition per disease (so savers do not meet)
    reg_row = spark.createDataFrame(
        [(fitted.name, type(fitted.model).__name__, version, *[fitted.metrics.get(k) for k in ("accuracy", "f1", "roc_auc", "pr_auc")])],
        "best_model_name string, model_class string, path string, test_accuracy double, "
        "test_f1 double, test_roc_auc double, test_pr_auc double")
    reg_row.withColumn("saved_at", F.current_timestamp()).coalesce(1).write.mode("overwrite") \
        .parquet(os.path.join(out_dir, "model_registry", f"disease_key={fitted.disease}"))
    return version


def _artifact_folder(spark: SparkSession, out_dir: str, disease: str) -> str | None:
    """The current version of a disease's artifacts; diabetes falls back to the root model. ``None`` where there is none."""
    from ..sources.files import _exists
    found = current_version(spark, os.path.join(out_dir, disease))
    root = os.path.join(out_dir, "root_model")
    if found is None and disease == ROOT_DISEASE and _exists(spark, f"{root}/_SUCCESS"):
        found = os.path.join(out_dir, spark.read.text(root).first()["value"])
    return found


def load_artifacts(spark: SparkSession, out_dir: str, disease: str) -> Fitted | None:
    """The saved winner, or ``None`` when the disease has no artifacts (it is then skipped)."""
    d = _artifact_folder(spark, out_dir, disease)
    if d is None:
        return None
    meta = json.loads(spark.read.text(f"{d}/metadata").first()["value"])
    model = Forest.from_json(meta["model"]["forest"]) if meta["model_class"] == "Forest" else Logistic(**meta["model"])
    pre = prep.PreprocessorModel(meta["numeric"], meta["categorical"], meta["medians"], meta["means"],
                                 meta["scales"], meta["modes"], meta["categories"])
    return Fitted(disease, meta["best_model_name"], pre, model,
                  {k[5:]: v for k, v in meta.items() if k.startswith("test_")})


def load_background(spark: SparkSession, out_dir: str, disease: str) -> DataFrame | None:
    """The saved background rows of a disease (engineered training rows), or ``None``."""
    from ..sources.files import _exists
    d = _artifact_folder(spark, out_dir, disease)
    return spark.read.parquet(f"{d}/background") if d and _exists(spark, f"{d}/background/_SUCCESS") else None


def load_comparison(spark: SparkSession, out_dir: str, disease: str) -> DataFrame:
    """The saved comparison table of a disease's models."""
    return spark.read.parquet(f"{_artifact_folder(spark, out_dir, disease)}/model_comparison_results")


def save_summary(summary: DataFrame, path: str) -> None:
    """X15 sink: the benchmark summary table (one row per winner or per model)."""
    summary.write.mode("overwrite").parquet(path)


def load_summary(spark: SparkSession, path: str) -> DataFrame | None:
    """The benchmark summary, or ``None`` when it has not been written."""
    from ..sources.files import _exists
    return spark.read.parquet(path) if _exists(spark, path) else None


def train_all(spark: SparkSession, sf_dir: str, diseases=None, out_dir: str | None = None, **kw) -> DataFrame:
    """Train every disease, all together; one winner per disease, in training order."""
    from ..config import TRAINING_ORDER
    from ..sources.panels import load_panel
    diseases = list(diseases or TRAINING_ORDER)
    res, _ = train_many({d: load_panel(spark, sf_dir, d) for d in diseases}, out_dir=out_dir, **kw)
    place = F.element_at(F.create_map(*[F.lit(x) for i, d in enumerate(diseases) for x in (d, i)]), F.col("disease"))
    return select_best(res).orderBy(place).select(*RESULT_SCHEMA.names)


def benchmark_rollup(summary: DataFrame) -> DataFrame:
    """Number of models, mean ROC-AUC and mean accuracy of a benchmark summary."""
    return summary.agg(F.count(F.lit(1)).alias("n_models"), F.avg("test_roc_auc").alias("avg_roc_auc"),
                       F.avg("test_accuracy").alias("avg_accuracy"))


def metric_comparison(summary: DataFrame) -> DataFrame:
    """Accuracy, F1 and ROC-AUC per disease in long form."""
    return summary.selectExpr("disease", "stack(3, 'accuracy', test_accuracy, 'f1', test_f1, 'roc_auc', test_roc_auc)"
                              " AS (metric, value)")
