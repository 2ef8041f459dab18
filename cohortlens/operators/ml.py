"""Model fitting and evaluation.

Imputation by 0 and population-std scaling are fitted inside every training
fold.  Logistic models of all sets, penalties, repeats and folds are fitted
together (``logistic``); forests are MLlib jobs submitted from a small bounded
pool of driver threads, on all rows of their training part, a few trees at a
time where the rows are many.  Scores, AUCs and importances come back as
DataFrames."""

from __future__ import annotations

import math
import uuid
from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, replace
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import Bucketizer
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.linalg import DenseVector
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortlens.operators.evaluation import fold_aucs
from cohortlens.operators.bijection import ROUNDS, permutation_keys, permute
from cohortlens.operators.folds import Dealt, deal
from cohortlens.operators.permuted import permuted_aucs
from cohortlens.operators.prefix import hex_measure, prefix_sum
from cohortlens.operators.stats import roc_auc
from cohortlens.session import checkpoint_dir, cut_lineage, freed_shuffles, write_staged

MAX_DRIVER_THREADS = 8
#: Rows that one task numbers, about.
ROWS_NUMBERED = 100_000
#: Bins of a column in a forest.
BINS = 32
#: MLlib takes the bounds of the bins from all rows up to here, beyond from a sample of so many.
SAMPLED_ABOVE = 10_000
#: Trees times rows that the driver holds at once, about: a tree may have a node for nearly every row.
TREE_ROWS = 20_000_000


@dataclass(frozen=True)
class ModelSpec:
    """kind: 'logistic_l2' | 'logistic_l1' | 'random_forest'."""
    name: str
    kind: str
    C: float = 1.0
    num_trees: int = 500
    max_depth: int = 30
    seed: int = 42
    #: Only where it is asked for: rows that a forest is fitted on at most (drawn by a hash of the row); scores cover all rows.
    max_fit_rows: int | None = None

    @property
    def scaled(self) -> bool:
        return self.kind.startswith("logistic")


DEFAULT_MODELS = (ModelSpec("logistic_l2", "logistic_l2", C=1.0),
                  ModelSpec("logistic_l1", "logistic_l1", C=2.0),
                  ModelSpec("random_forest", "random_forest"))


def _filled(c: str):
    """A column as double; NULL and NaN read as 0."""
    return F.coalesce(F.nanvl(F.col(f"`{c}`").cast("double"), F.lit(0.0)), F.lit(0.0))


def column_stats(df: DataFrame, cols: Sequence[str]) -> dict:
    """One aggregate row: n and, per column (NULL and NaN read as 0), mean,
    population std, min and max."""
    aggs = [F.count(F.lit(1)).alias("__n")]
    for i, c in enumerate(cols):
        x = _filled(c)
        aggs += [F.avg(x).alias(f"m{i}"), F.stddev_pop(x).alias(f"s{i}"),
                 F.min(x).alias(f"lo{i}"), F.max(x).alias(f"hi{i}")]
    row = df.agg(*aggs).first()
    return {"n": row["__n"], "cols": {c: (row[f"m{i}"] or 0.0, row[f"s{i}"] or 0.0,
                                          row[f"lo{i}"], row[f"hi{i}"]) for i, c in enumerate(cols)}}


def standardize(df: DataFrame, cols: Sequence[str], fit_on: DataFrame | None = None,
                stats: dict | None = None) -> DataFrame:
    """NULL -> 0, then (x - mean) / population std; constant -> 0.

    Statistics are one aggregate row (bounded by the column count) taken
    from ``fit_on`` (the training fold) and applied as literals."""
    if stats is None:
        stats = column_stats(fit_on if fit_on is not None else df, cols)
    exprs = {}
    for c in cols:
        m, s = stats["cols"][c][0], stats["cols"][c][1]
        x = _filled(c)
        exprs[c] = (x - F.lit(m)) / F.lit(s) if s > 0 else F.lit(0.0)
    return df.withColumns(exprs)


def _vectorize(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    arr = F.array(*[_filled(c) for c in cols])
    return df.withColumn("features", array_to_vector(arr))


@dataclass(frozen=True)
class LinearModel:
    """Coefficients of the scaled columns and, for scoring, of the columns as they are."""
    coefficients: DenseVector
    intercept: float
    raw: tuple[float, ...]  # intercept first
    columns: tuple[str, ...]

    def margin(self):
        return reduce(lambda a, b: a + b, [_filled(c) * F.lit(w) for c, w in zip(self.columns, self.raw[1:], strict=True)],
                      F.lit(self.raw[0]))


def _fit_logistic(train: DataFrame, cols: list[str], spec: ModelSpec):
    from cohortlens.operators import logistic as lg
    rows = cut_lineage(lg.training_rows(train.withColumn("__row", F.lit(0)), cols, None, "__row"))
    one = lg.fit_all(rows, [_logistic_fit("", cols, cols, spec)], len(cols))[0]
    model = LinearModel(DenseVector(one.weights), one.intercept, tuple(map(float, one.raw)), tuple(cols))

    def score(d: DataFrame) -> DataFrame:
        return d.withColumn("score", 1 / (1 + F.exp(-model.margin())))

    return model, cols, score


def _logistic_fit(name: str, own: Sequence[str], cols: Sequence[str], spec: ModelSpec, *place):
    from cohortlens.operators import logistic as lg
    return lg.Fit(name, tuple(cols.index(c) for c in own), spec.name, "l1" if spec.kind == "logistic_l1" else "l2", spec.C, *place)


def fit(train: DataFrame, cols: Sequence[str], spec: ModelSpec):
    """Fit one model; returns (model, used columns, scoring function).

    For a forest one aggregate job gives the row count and the
    constant-column check; then the MLlib fit."""
    cols = list(cols)
    if spec.scaled:
        return _fit_logistic(train, cols, spec)
    stats = column_stats(train, cols)
    # Columns constant in the training fold carry no split; MLlib would
    # stop a node when only such columns are drawn, so they are dropped.
    use = [c for c in cols if stats["cols"][c][2] != stats["cols"][c][3]] or cols[:1]
    binned, most_bins = _binned(train, use, stats["n"])
    model, score = _fit_trees(binned(train), use, spec, stats["n"], most_bins)
    return model, use, lambda d: score(binned(d)).drop("features")


def _fit_trees(binned: DataFrame, use: Sequence[str], spec: ModelSpec, n: int, most_bins: int, turn: int = 0):
    """A forest on rows that have their ``features``; returns (model, scoring function).  Each ``turn`` draws other trees."""
    tr = binned.select("features", F.col("y").cast("double").alias("y"))
    if spec.max_fit_rows is not None and n > spec.max_fit_rows:
        share = int(spec.max_fit_rows / n * (1 << 20))
        tr = tr.filter(F.pmod(F.xxhash64(vector_to_array("features"), "y", F.lit(spec.seed)), F.lit(1 << 20)) < share)
    model = RandomForestClassifier(labelCol="y", featuresCol="features", numTrees=spec.num_trees, maxDepth=spec.max_depth, maxBins=most_bins,
                                   minInstancesPerNode=1, featureSubsetStrategy=str(max(1, int(math.sqrt(len(use))))),
                                   seed=spec.seed + turn).fit(tr)
    # The training summary holds the session, and a session that has observed a query cannot be sent to tasks; a copy has none.
    model = model.copy()
    return model, lambda d: (model.transform(d).withColumn("score", vector_to_array("probability")[1])
                             .drop("rawPrediction", "probability", "prediction"))


def bin_bounds(df: DataFrame, cols: Sequence[str], bins: int = BINS) -> list[list[float]]:
    """For each column the values at which its bins begin, from all rows: one bin for each of few values, else equal shares."""
    rows = df.select(*[_filled(c).alias(f"x{i}") for i, c in enumerate(cols)])

    def few(batches):
        seen = [np.zeros(0)] * len(cols)
        for batch in batches:
            for i in range(len(cols)):
                if len(seen[i]) <= bins:  # one too many says that there are many
                    seen[i] = np.union1d(seen[i], batch.column(i).to_numpy(zero_copy_only=False))[:bins + 1]
        yield pa.RecordBatch.from_arrays([pa.array(range(len(cols)), pa.int32()), pa.array([v.tolist() for v in seen], pa.list_(pa.float64()))],
                                         names=["i", "v"])
    found: list[list[float]] = [[] for _ in cols]
    for r in rows.mapInArrow(few, "i int, v array<double>").select("i", F.explode("v").alias("v")).groupBy("i").agg(
            F.slice(F.array_sort(F.collect_set("v")), 1, bins + 1).alias("v")).collect():
        found[r["i"]] = r["v"]
    many = [i for i, v in enumerate(found) if len(v) > bins]
    probs = [k / bins for k in range(1, bins)]
    shares = rows.agg(*[F.percentile_approx(f"x{i}", probs, 10_000).alias(f"x{i}") for i in many]).first() if many else {}
    return [sorted(set(shares[f"x{i}"])) if i in many else v[1:] for i, v in enumerate(found)]


def _binned(train: DataFrame, use: Sequence[str], n: int):
    """(function that adds ``features``, most bins): where MLlib would draw bounds from a sample, columns are cut into bins
    of all rows first.  So many bins are allowed that MLlib reads all rows; of a binned column it uses ``BINS`` at most."""
    if n <= SAMPLED_ABOVE:
        return lambda d: _vectorize(d, use), BINS
    names = [f"__b{i}" for i in range(len(use))]
    cut = Bucketizer(splitsArray=[[-math.inf, *b, math.inf] if b else [-math.inf, 0.0, math.inf] for b in bin_bounds(train, use)],
                     inputCols=[f"__x{i}" for i in range(len(use))], outputCols=names)

    def binned(d):
        raw = d.withColumns({f"__x{i}": _filled(c) for i, c in enumerate(use)})
        return cut.transform(raw).withColumn("features", array_to_vector(F.array(*names))).drop(*names, *cut.getInputCols())
    return binned, max(BINS, math.isqrt(n) + 1)


def deal_folds(df: DataFrame, sets: dict[str, list[str]], ks: Sequence[int], repeats: int, seed: int,
               id_col: str = "run_accession") -> list[Dealt]:
    """For each of ``ks`` the stratified folds of ``assign_folds``, beside the rows that logistic models of ``sets`` are fitted on."""
    cols = list(dict.fromkeys(c for own in sets.values() for c in own))
    rows = df.select(F.col(id_col).alias("__id"), "y", F.array(*[_filled(c) for c in cols]).cast("array<double>").alias("x"))
    return deal(rows, cols, list(ks), repeats, seed)


def fit_logistic_models(df: DataFrame, sets: dict[str, list[str]], models: Sequence[ModelSpec], folds: DataFrame | Dealt | None = None,
                        id_col: str = "run_accession"):
    """All logistic models of every set, penalty, repeat and fold (without ``folds``: one on all rows), fitted together.

    Returns (fits, column names, the rows they were fitted on)."""
    from cohortlens.operators import logistic as lg
    cols = list(dict.fromkeys(c for own in sets.values() for c in own))
    if isinstance(folds, Dealt):
        cols, places = list(folds.columns), list(folds.keys)
        rows = folds.training_rows()
    else:
        rows = cut_lineage(lg.training_rows(df, cols, folds, id_col, keep_id=True))
        places = [(lg.ALL, lg.ALL)] if folds is None else _fold_keys(folds)
    fits = [_logistic_fit(s, own, cols, m, *place) for s, own in sets.items() if own for m in models for place in places]
    repeats = [] if folds is None else sorted({r for r, _ in places})
    return lg.fit_all(rows, fits, len(cols), repeats), cols, rows


def optimality_sums(df: DataFrame, table: DataFrame, cols: Sequence[str]) -> DataFrame:
    """(feature_set, model, feature, w, n, free, g): for each model of a coefficient table and each of its features the
    coefficient, the rows, the sum of the gaps (chance less y) and that of the gaps times the scaled column.

    The gaps of a row are one array, so all sums are one pass over the rows."""
    # As many rows as there are models and features.
    models: dict[tuple[str, str], dict] = {}
    for r in table.collect():
        models.setdefault((r["feature_set"], r["model"]), {"free": r["raw_intercept"], "own": {}})["own"][r["feature"]] = (
            r["coefficient"], r["raw_coefficient"])
    stats = column_stats(df, cols)
    rows = df.select(F.col("y").cast("double").alias("y"), *[_filled(c).alias(f"x{i}") for i, c in enumerate(cols)])
    at = {c: i for i, c in enumerate(cols)}
    for m, spec in enumerate(models.values()):
        margin = reduce(lambda a, b: a + b, [F.col(f"x{at[c]}") * F.lit(raw) for c, (_, raw) in spec["own"].items()], F.lit(spec["free"]))
        rows = rows.withColumn(f"g{m}", 1 / (1 + F.exp(-margin)) - F.col("y"))
    sums, kept = [F.count(F.lit(1)).alias("n")], []
    for m, ((name, model), spec) in enumerate(models.items()):
        sums.append(F.sum(f"g{m}").alias(f"free{m}"))
        for c, (w, _) in spec["own"].items():
            mean, std = stats["cols"][c][:2]
            x = (F.col(f"x{at[c]}") - F.lit(mean)) / F.lit(std) if std > 0 else F.lit(0.0)
            sums.append(F.sum(F.col(f"g{m}") * x).alias(f"g{m}_{at[c]}"))
            kept.append(F.struct(F.lit(name).alias("feature_set"), F.lit(model).alias("model"), F.lit(c).alias("feature"),
                                 F.lit(w).alias("w"), F.col("n"), F.col(f"free{m}").alias("free"), F.col(f"g{m}_{at[c]}").alias("g")))
    found = rows.agg(*sums)
    return found.where("n > 0").select(F.inline(F.array(*kept))) if kept else found.sparkSession.createDataFrame(
        [], "feature_set string, model string, feature string, w double, n long, free double, g double")


def _fold_keys(folds: DataFrame) -> list[tuple[int, int]]:
    """(repeat, fold): as many as the parameters say."""
    return [(r["repeat"], r["fold"]) for r in folds.select("repeat", "fold").distinct().orderBy("repeat", "fold").collect()]


def cross_validate(df: DataFrame, sets: dict[str, list[str]], models: Sequence[ModelSpec],
                   folds: DataFrame | Dealt, id_col: str = "run_accession",
                   threads: int = MAX_DRIVER_THREADS) -> DataFrame:
    """Out-of-fold scores (feature_set, model, repeat, fold, id, y,
    score) for every set x model x fold; empty sets skipped.

    Logistic models are fitted together and scored in one pass; ``folds`` may
    hold their rows too (``deal_folds``).  Forests are fitted one by one; each
    writes its scores into one shared folder."""
    from cohortlens.operators import logistic as lg
    sets = {s: list(cols) for s, cols in sets.items() if cols}
    linear, forests = [m for m in models if m.scaled], [m for m in models if not m.scaled]
    parts = []
    if linear and sets:
        fits, cols, rows = fit_logistic_models(df, sets, linear, folds, id_col)
        repeats = sorted({f.repeat for f in fits})
        # Scores are a function of the written rows and the coefficients; they need not be written too.
        parts.append(lg.held_out_scores(rows, fits, id_col, len(cols), repeats))
    if forests and sets:
        parts.append(_forest_scores(df, sets, forests, folds, id_col, threads))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def cross_validated_aucs(df: DataFrame, sets: dict[str, list[str]], models: Sequence[ModelSpec], folds: DataFrame | Dealt,
                         id_col: str = "run_accession", threads: int = MAX_DRIVER_THREADS) -> DataFrame:
    """``cv_aucs`` of ``cross_validate``; the scores of logistic models are ranked from packs, not row by row."""
    from cohortlens.operators import logistic as lg
    sets = {s: list(cols) for s, cols in sets.items() if cols}
    linear, forests = [m for m in models if m.scaled], [m for m in models if not m.scaled]
    parts = []
    if linear and sets:
        fits, cols, rows = fit_logistic_models(df, sets, linear, folds, id_col)
        parts.append(cut_lineage(lg.held_out_aucs(rows, fits, len(cols), sorted({f.repeat for f in fits}))))
    if forests and sets:
        parts.append(cv_aucs(_forest_scores(df, sets, forests, folds, id_col, threads)))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def _forest_scores(df, sets, models, folds, id_col, threads) -> DataFrame:
    spark = df.sparkSession
    keys = _fold_keys(folds)
    # Laid out by repeat, so a fit reads its own repeat's files only.
    root = f"{checkpoint_dir(spark).rstrip('/')}/forest-{uuid.uuid4().hex}"
    (df.join(folds.select(id_col, "repeat", "fold"), id_col).withColumn("__row", F.monotonically_increasing_id())
     .write.partitionBy("repeat").parquet(f"{root}/rows"))
    data = spark.read.parquet(f"{root}/rows")
    schema = (f"feature_set string, model string, repeat int, fold int, `{id_col}` {df.schema[id_col].dataType.simpleString()}, y int, "
              "__row long, score double")
    held = max(1, threads)

    def run(job):
        s, cols, m, rep, f = job
        part = data.filter(F.col("repeat") == rep)
        test = part.filter(F.col("fold") == f).select(id_col, "y", "repeat", "fold", "__row", *cols)
        for turn, (trees, score) in enumerate(_forest_parts(part.filter(F.col("fold") != f), cols, m, held)):
            # A forest's score is the mean of its trees' shares, so that of its parts adds up.
            score(test).select(F.lit(s).alias("feature_set"), F.lit(m.name).alias("model"), F.col("repeat").cast("int").alias("repeat"),
                               F.col("fold").cast("int").alias("fold"), id_col, F.col("y").cast("int").alias("y"), "__row",
                               (F.col("score") * (trees / m.num_trees)).alias("score")).write.parquet(
                f"{root}/scores/{s}-{m.name}-{rep}-{f}-{turn}")

    jobs = [(s, cols, m, rep, f) for s, cols in sets.items() for m in models for rep, f in keys]
    with ThreadPoolExecutor(max_workers=held) as pool:
        list(pool.map(run, jobs))
    parts = spark.read.schema(schema).parquet(f"{root}/scores/*")
    names = ["feature_set", "model", "repeat", "fold", id_col, "y"]
    return parts.groupBy(*names, "__row").agg(F.sum("score").alias("score")).drop("__row")


def _forest_parts(train: DataFrame, cols: Sequence[str], spec: ModelSpec, held: int):
    """(trees, scoring function) of the parts of one forest, one after another; ``held`` forests are grown at a time.

    The driver holds the trees of a part, which is as many as ``TREE_ROWS`` lets."""
    n = train.count()
    at_once = max(1, min(spec.num_trees, TREE_ROWS // (held * max(n, 1))))
    if at_once >= spec.num_trees:
        yield spec.num_trees, fit(train, cols, spec)[2]
        return
    stats = column_stats(train, cols)
    use = [c for c in cols if stats["cols"][c][2] != stats["cols"][c][3]] or list(cols)[:1]
    binned, most_bins = _binned(train, use, n)
    for turn, start in enumerate(range(0, spec.num_trees, at_once)):
        trees = min(at_once, spec.num_trees - start)
        _, score = _fit_trees(binned(train), use, replace(spec, num_trees=trees), n, most_bins, turn)
        yield trees, lambda d, score=score: score(binned(d)).drop("features")


def cv_aucs(oof: DataFrame) -> DataFrame:
    """Fold AUCs (feature_set, model, repeat, fold, auc) from OOF scores."""
    return fold_aucs(oof, ["feature_set", "model"])


def coefficients(model, cols: Sequence[str], spark) -> DataFrame:
    """Coefficient, absolute value and direction per feature."""
    coef = [float(x) for x in model.coefficients.toArray()]
    rows = [(c, v) for c, v in zip(cols, coef)]
    df = spark.createDataFrame(rows, "feature string, coefficient double")
    return (df.withColumn("abs_coefficient", F.abs("coefficient"))
              .withColumn("direction", F.when(F.col("coefficient") > 0, "cancer-associated")
                          .otherwise("healthy-associated"))
              .orderBy(F.col("abs_coefficient").desc(), F.col("feature")))


def permutation_importance(df: DataFrame, cols: Sequence[str], score_fn=None, repeats: int = 50,
                           seed: int = 42, id_col: str = "run_accession", model: LinearModel | None = None,
                           digits: int | None = None) -> DataFrame:
    """Mean and population std over repeats of the AUC drop when one
    column is permuted.

    Rows are numbered by a digest of their id.  For each (feature, repeat) a
    keyed bijection of the numbers (``permute``) names the row whose value is
    taken, so rows x features x repeats need no sort.  With a linear ``model``
    a row's margin is its own margin plus the coefficient times the change of
    the one value, and values travel in packs (``permuted``); else ``score_fn``
    scores the changed rows.  ``digits`` rounds a model's margins before they
    are ranked."""
    cols = list(cols)
    base = df.select(id_col, F.col("y").cast("int").alias("y"), *[F.col(f"`{c}`") for c in cols])
    keyed = base.withColumns({"one": F.lit(1), "__h": F.md5(F.col(id_col).cast("string"))})
    pos = prefix_sum(keyed, ["__h", id_col], ["one"], measure=hex_measure("__h"), rows_per_bucket=ROWS_NUMBERED)
    # Read again in every round.
    with freed_shuffles(df.sparkSession):
        pos = write_staged(pos.withColumn("pos", F.col("one_cum").cast("bigint") - 1).drop("one", "one_cum", "__h"), "numbered-rows")
    n = pos.count()
    if model:
        rows = pos.select("pos", "y", model.margin().alias("margin"), *[_filled(c).alias(f"x{j}") for j, c in enumerate(cols)])
        aucs = permuted_aucs(rows, n, list(model.raw[1:]), repeats, seed, digits)  # a row for each feature and repeat
        perm_auc = aucs.where(F.col("j") < len(cols))
        base_auc = next((r["auc"] for r in aucs.where(F.col("j") == len(cols)).collect()), None)
    else:
        # As many rows as there are features and repeats.
        keys = F.broadcast(df.sparkSession.createDataFrame(
            [(j, r, *permutation_keys(seed, j, r)) for j in range(len(cols)) for r in range(repeats)],
            "j int, r int, " + ", ".join(f"k{i} long" for i in range(ROUNDS))))
        feats = F.array(*[F.struct(F.lit(i).alias("j"), F.col(f"`{c}`").cast("double").alias("v")) for i, c in enumerate(cols)])
        values = pos.select(F.col("pos").alias("d_pos"), F.inline(feats).alias("d_j", "pv"))
        targets = pos.select(id_col, "y", "pos", *[F.col(f"`{c}`") for c in cols], F.explode(F.sequence(
            F.lit(0), F.lit(len(cols) - 1))).alias("j"))
        moved = permute(targets.join(keys, "j"), n)
        joined = moved.join(values.hint("shuffle_hash"), (F.col("donor") == F.col("d_pos")) & (F.col("j") == F.col("d_j")))
        permuted = joined.withColumns({c: F.when(F.col("j") == i, F.col("pv")).otherwise(F.col(f"`{c}`"))
                                       for i, c in enumerate(cols)})
        perm_auc = roc_auc(score_fn(permuted), ["j", "r"], most=n)  # every (feature, repeat) has each row once
        base_auc = roc_auc(score_fn(df), most=n).first()["auc"]
    names = df.sparkSession.createDataFrame([(i, c) for i, c in enumerate(cols)], "j int, feature string")
    drop = perm_auc.select("j", (F.lit(base_auc) - F.col("auc")).alias("d"))
    return (drop.groupBy("j").agg(F.avg("d").alias("importance_mean"),
                                  F.stddev_pop("d").alias("importance_std"))
                .join(F.broadcast(names), "j").select("feature", "importance_mean", "importance_std")
                .orderBy(F.col("importance_mean").desc(), F.col("feature")))


def importance_heads(importance: DataFrame, coefficients: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The 20 features of the greatest mean importance and the 15 of the greatest absolute coefficient."""
    return (importance.orderBy(F.col("importance_mean").desc(), "feature").limit(20),
            coefficients.orderBy(F.col("abs_coefficient").desc(), "feature").limit(15))


def gram(df: DataFrame, cols: Sequence[str]) -> tuple[int, np.ndarray, np.ndarray, np.ndarray]:
    """Rows, means, population deviations and the correlation matrix (a constant column has zeros).

    Two aggregates of one row each: the columns' statistics, then the
    p (p + 1) / 2 sums of products about the means."""
    cols = list(cols)
    stats = column_stats(df, cols)
    mean, std = (np.array([stats["cols"][c][i] for c in cols]) for i in (0, 1))
    z = [(_filled(c) - F.lit(float(m))) / F.lit(float(s)) if s > 0 else F.lit(0.0) for c, m, s in zip(cols, mean, std)]
    upper = [(i, j) for i in range(len(cols)) for j in range(i, len(cols))]
    row = df.agg(*[F.avg(z[i] * z[j]).alias(f"g{k}") for k, (i, j) in enumerate(upper)]).first()
    out = np.zeros((len(cols), len(cols)))
    for k, (i, j) in enumerate(upper):
        out[i, j] = out[j, i] = row[f"g{k}"] or 0.0
    return stats["n"], mean, std, out


def jacobi(matrix: np.ndarray, sweeps: int = 60) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues (descending) and eigenvectors (columns) of a small symmetric matrix by rotations."""
    a, v = np.array(matrix, float), np.eye(len(matrix))
    for _ in range(sweeps):
        off = np.abs(np.triu(a, 1)).max(initial=0.0)
        if off <= 1e-15 * max(1.0, np.abs(np.diag(a)).max(initial=0.0)):
            break
        for p in range(len(a)):
            for q in range(p + 1, len(a)):
                if a[p, q]:
                    # The angle that makes this entry zero.
                    angle = 0.5 * math.atan2(2 * a[p, q], a[q, q] - a[p, p])
                    c, s = math.cos(angle), math.sin(angle)
                    turn = np.array([[c, s], [-s, c]])
                    a[:, [p, q]] = a[:, [p, q]] @ turn
                    a[[p, q]] = turn.T @ a[[p, q]]
                    v[:, [p, q]] = v[:, [p, q]] @ turn
    order = np.argsort(-np.diag(a), kind="stable")
    return np.diag(a)[order], v[:, order]


def pca2(df: DataFrame, cols: Sequence[str], id_col: str = "run_accession"):
    """M6: two principal components of standardised, 0-imputed features.

    The correlation matrix is one aggregate, its eigenvectors come from
    rotations of that bounded matrix.  Returns (scores DataFrame, explained
    variance ratios); the sign of each component is fixed so that its
    largest-magnitude loading (the first of equal ones) is positive."""
    cols = list(cols)
    if len(cols) < 2:
        return None, []
    _, mean, std, matrix = gram(df, cols)
    values, vectors = jacobi(matrix)
    total = float(values.sum())
    parts = []
    for k in range(2):
        load = vectors[:, k]
        first = int(np.argmax(np.abs(load) > np.abs(load).max() - 1e-9))
        load = -load if load[first] < 0 else load
        parts.append(reduce(lambda x, y: x + y, [(_filled(c) - F.lit(float(m))) / F.lit(float(s)) * F.lit(float(w))
                                                 for c, m, s, w in zip(cols, mean, std, load) if s > 0] or [F.lit(0.0)]))
    ids = [c for c in ("sample_id", id_col, "label") if c in df.columns]
    out = df.select(*ids, parts[0].alias("pc1"), parts[1].alias("pc2"))
    return out, [float(x) / total if total else 0.0 for x in values[:2]]
