"""Rolling up many runs: by model and setting, by class, and against each other. Nulls are left out of means, NaN carries through."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

METRICS = ("accuracy", "macro_f1", "weighted_kappa", "mae", "within1")
#: The settings that count as primary, and the pairs that are compared.
REAL, BOTH = "train_real_only", "train_real_plus_synthetic"
PAIRS = ((f"{REAL}__eval_real_only", f"{BOTH}__eval_real_only", "real_only"), (f"{REAL}__eval_real_plus_synthetic", f"{BOTH}__eval_real_plus_synthetic", "real_plus_synthetic"))
PRIMARY = (PAIRS[0][0], PAIRS[0][1])


def mean_std(runs: DataFrame, by: list[str], metrics: tuple[str, ...]) -> DataFrame:
    """<metric>_mean and the population <metric>_std per group, with n_seeds."""
    return runs.groupBy(*by).agg(F.count(F.lit(1)).alias("n_seeds"), *[f(m).alias(f"{m}_{n}") for m in metrics for n, f in (("mean", F.avg), ("std", F.stddev_pop))])


def by_setting(runs: DataFrame, primary: tuple[str, ...] = PRIMARY) -> DataFrame:
    """One row per model and setting: is_primary, n_seeds, mean and std of the five metrics."""
    return mean_std(runs, ["model", "setting"], METRICS).withColumn("is_primary", F.col("setting").isin(*primary).cast("int"))


def by_class(runs: DataFrame, rows: str = "per_class") -> DataFrame:
    """Mean and std per model, setting and label from the array of per-class structs of each run."""
    flat = runs.select("model", "setting", F.inline(rows))
    return mean_std(flat, ["model", "setting", "label"], ("precision", "recall", "f1", "support"))


def by_binary(runs: DataFrame) -> DataFrame:
    """Mean and std of the binary metrics per model and setting."""
    return mean_std(runs, ["model", "setting"], ("precision", "recall", "f1", "auroc", "auprc"))


def setting_deltas(rolled: DataFrame, pairs: tuple = PAIRS) -> DataFrame:
    """Per model and pair of settings, right minus left; only where both are there. The pairs are a constant table, joined by setting."""
    spark = rolled.sparkSession
    named = F.broadcast(spark.createDataFrame(list(pairs), "left_setting string, right_setting string, eval_domain string"))
    means = {"macro_f1": "macro_f1_mean", "weighted_kappa": "weighted_kappa_mean", "accuracy": "accuracy_mean", "mae": "mae_mean"}
    a = rolled.select("model", F.col("setting").alias("left_setting"), *[F.col(c).alias(f"l_{m}") for m, c in means.items()])
    b = rolled.select("model", F.col("setting").alias("right_setting"), *[F.col(c).alias(f"r_{m}") for m, c in means.items()])
    both = a.join(named, "left_setting").join(b, ["model", "right_setting"])
    return both.select("model", "eval_domain", *[(F.col(f"r_{m}") - F.col(f"l_{m}")).alias(f"delta_{m}") for m in means])


def best_settings(rolled: DataFrame, order: dict[str, int], metric: str = "macro_f1_mean") -> DataFrame:
    """The best primary setting of each model by ``metric``; ties go to the setting that ran first (``order``). NaN is never best."""
    pos = F.create_map(*[x for k, v in order.items() for x in (F.lit(k), F.lit(v))])
    rows = rolled.where((F.col("is_primary") == 1) & ~F.isnan(metric)).withColumn("__pos", F.try_element_at(pos, F.col("setting")))
    first = F.row_number().over(Window.partitionBy("model").orderBy(F.desc(metric), F.asc_nulls_last("__pos"), "setting"))
    return rows.withColumn("__first", first).where("__first = 1").drop("__first", "__pos")


def runs_of_best(runs: DataFrame, best: DataFrame) -> DataFrame:
    """The runs of each model's best setting."""
    return runs.join(best.select("model", "setting"), ["model", "setting"], "left_semi")


def mean_confusion(confusions: DataFrame) -> DataFrame:
    """(model, x, y, share): the mean over the runs of each cell of their normalised confusion matrices."""
    return confusions.groupBy("model", "x", "y").agg(F.avg("share").alias("share"))


def best_epochs(log: DataFrame, run: str = "run", epoch: str = "epoch", metric: str = "metric") -> DataFrame:
    """(run, epoch, metric): the first epoch that reaches the largest metric, as a strictly greater value is needed to replace a best; null and NaN never do."""
    rows = log.where(F.col(metric).isNotNull() & ~F.isnan(metric))
    best = rows.groupBy(run).agg(F.max(F.struct(F.col(metric), (-F.col(epoch)).alias("e"))).alias("m"))
    return best.select(run, (-F.col("m.e")).alias(epoch), F.col(f"m.{metric}").alias(metric))


def stopped_epochs(log: DataFrame, patience: int, run: str = "run", epoch: str = "epoch", metric: str = "metric") -> DataFrame:
    """(run, last_epoch): where early stopping ends a run: the first epoch that comes ``patience`` epochs after its best so far; null if none does."""
    before = Window.partitionBy(run).orderBy(epoch).rowsBetween(Window.unboundedPreceding, -1)
    value = F.coalesce(F.nanvl(metric, F.lit(float("-inf"))), F.lit(float("-inf")))
    rows = log.withColumn("__v", value).withColumn("__best", F.max("__v").over(before))
    rows = rows.withColumn("__improved", F.coalesce(F.col("__v") > F.col("__best"), F.lit(True)))
    last = F.max(F.when(F.col("__improved"), F.col(epoch))).over(Window.partitionBy(run).orderBy(epoch).rowsBetween(Window.unboundedPreceding, Window.currentRow))
    return rows.withColumn("__since", F.col(epoch) - last).groupBy(run).agg(F.min(F.when(F.col("__since") >= patience, F.col(epoch))).alias("last_epoch"))


def learning_rates(log: DataFrame, first: float = 1e-4, factor: float = 0.5, patience: int = 2, threshold: float = 1e-4, run: str = "run", epoch: str = "epoch", metric: str = "metric") -> DataFrame:
    """(run, lr, n_cuts): the learning rate at the end of a run that cuts it by ``factor`` once the metric hasn't grown for more than ``patience`` epochs.

    Grown means beyond the best so far by the ``threshold``, relatively; NaN never is, null epochs don't count, and the wait begins anew after a cut. The rule is sequential: the epochs of
    a run, some dozens by configuration, are folded in order.
    """
    order = F.array_sort(F.collect_list(F.struct(F.col(epoch).alias("e"), F.col(metric).cast("double").alias("m"))))
    runs = log.where(F.col(metric).isNotNull()).groupBy(run).agg(order.alias("log"))
    start = F.struct(F.lit(float("-inf")).alias("best"), F.lit(0).alias("bad"), F.lit(float(first)).alias("lr"), F.lit(0).alias("cuts"))

    def step(s: Column, x: Column) -> Column:
        grown = ~F.isnan(x["m"]) & (x["m"] > s["best"] * (1 + threshold))
        cut = ~grown & (s["bad"] + 1 > patience)
        return F.struct(
            F.when(grown, x["m"]).otherwise(s["best"]).alias("best"), F.when(grown | cut, 0).otherwise(s["bad"] + 1).alias("bad"),
            F.when(cut, s["lr"] * factor).otherwise(s["lr"]).alias("lr"), F.when(cut, s["cuts"] + 1).otherwise(s["cuts"]).alias("cuts"),
        )

    return runs.withColumn("end", F.aggregate("log", start, step)).select(run, "end.lr", F.col("end.cuts").alias("n_cuts"))


def run_grid(models: DataFrame, heads: DataFrame, seeds: DataFrame, settings: DataFrame) -> DataFrame:
    """All runs of a sweep: every model with every head, seed and setting. The sides are configuration, some rows each; the product is the feature."""
    return models.join(heads, F.lit(True)).join(seeds, F.lit(True)).join(settings, F.lit(True))
