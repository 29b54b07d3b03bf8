"""Ancestry inference: project genotypes onto reference PC loadings, then
classify samples with a random forest trained on the labelled panel.

Projection is one ``groupBy(s)`` with one ``sum`` per principal component
(no explode, map-side partial aggregation, JVM only).  The loadings table is
a reference panel's PCA sites (thousands to ~100k rows): the join with the
calls is an ordinary equi-join that AQE turns into a broadcast when the
filtered loadings are small.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lociframe.functions import genotype as G
from lociframe.functions.alleles import VARIANT_KEY


def keep_loading_sites(df: DataFrame, loadings: DataFrame, key=VARIANT_KEY) -> DataFrame:
    """Rows (sites or calls) whose variant is in the loadings table."""
    return df.join(loadings.select(*key), list(key), "left_semi")


def pc_project(calls: DataFrame, loadings: DataFrame, key=VARIANT_KEY, n_pcs: int | None = None,
               loadings_col: str = "loadings", af_col: str = "pca_af") -> DataFrame:
    """Per sample ``scores[k] = sum_v loading[v,k] * norm(v,s)`` with
    ``norm = (n_alt - 2 af) / sqrt(n_variants * 2 af (1 - af))``.

    Variants need defined loadings and ``0 < af < 1``; missing calls are
    skipped.  ``n_variants`` is the number of rows of the loadings table.
    """
    # both scalars from one pass over the (reference-sized) loadings table
    stats = loadings.agg(F.count(F.lit(1)).alias("n"), F.max(F.size(loadings_col)).alias("k")).first()
    n_variants = stats["n"]
    ld = loadings.where(F.col(loadings_col).isNotNull() & F.col(af_col).isNotNull()
                        & (F.col(af_col) > 0) & (F.col(af_col) < 1))
    if n_pcs is None:
        n_pcs = stats["k"] or 0
    af = F.col(af_col)
    norm = (G.n_alt_alleles(F.col("GT")) - af * 2) / F.sqrt(F.lit(float(n_variants)) * 2 * af * (1 - af))
    right = ld.select(*key, loadings_col, af_col)
    j = (calls.select(*key, "s", "GT")
         .join(right, list(key))
         .withColumn("_norm", norm)
         .where(F.col("_norm").isNotNull()))
    sums = [F.sum(F.col("_norm") * F.get(F.col(loadings_col), i)).alias(f"_pc{i}") for i in range(n_pcs)]
    return j.groupBy("s").agg(*sums).select("s", F.array(*[F.col(f"_pc{i}") for i in range(n_pcs)]).alias("scores"))


def attach_known_population(scores: DataFrame, labels: DataFrame, sample_col: str = "Sample",
                            label_col: str = "SuperPop") -> DataFrame:
    """``known_pop`` = lower-cased label of the sample (NULL if unlabelled)."""
    # one label per sample; a sample listed twice keeps its smallest label
    lab = (labels.select(F.col(sample_col).alias("s"), F.lower(F.col(label_col)).alias("known_pop"))
           .groupBy("s").agg(F.min("known_pop").alias("known_pop")))
    return scores.join(lab, "s", "left")


def assign_population(scores: DataFrame, known_col: str = "known_pop", num_pcs: int = 16,
                      min_prob: float = 0.75, seed: int = 42, num_trees: int = 100,
                      missing_label: str = "oth", return_model: bool = False):
    """Random-forest population assignment on the first ``num_pcs`` scores.

    Trained on rows with a known label; every row gets ``pop`` (the most
    probable class, or ``missing_label`` when its probability is below
    ``min_prob``) and one ``prob_<class>`` column per class; the input
    ``scores`` come out as ``pca_scores``.
    """
    from pyspark.ml import Pipeline
    from pyspark.ml.classification import RandomForestClassifier
    from pyspark.ml.feature import StringIndexer
    from pyspark.ml.functions import array_to_vector

    feats = scores.withColumn("features", array_to_vector(F.slice(F.col("scores"), 1, num_pcs).cast("array<double>")))
    train = feats.where(F.col(known_col).isNotNull())
    indexer = StringIndexer(inputCol=known_col, outputCol="_label", stringOrderType="alphabetAsc")
    rf = RandomForestClassifier(featuresCol="features", labelCol="_label", numTrees=num_trees, seed=seed,
                                probabilityCol="_prob", rawPredictionCol="_raw", predictionCol="_pred")
    model = Pipeline(stages=[indexer, rf]).fit(train)
    out = apply_population_model(feats, model, min_prob=min_prob, missing_label=missing_label)
    return (out, model) if return_model else out


def apply_population_model(feats: DataFrame, model, min_prob: float = 0.75, missing_label: str = "oth",
                           num_pcs: int | None = None) -> DataFrame:
    """Score rows with a fitted (or loaded) pipeline: indexer + classifier."""
    from pyspark.ml.functions import array_to_vector, vector_to_array

    if "features" not in feats.columns:
        feats = feats.withColumn("features", array_to_vector(
            F.slice(F.col("scores"), 1, num_pcs or 16).cast("array<double>")))
    labels = list(model.stages[0].labels)
    scored = model.stages[-1].transform(feats).withColumn("_p", vector_to_array("_prob"))
    best = F.array_max("_p")
    pop = F.when(best >= min_prob, F.element_at(F.array(*[F.lit(x) for x in labels]),
                                                F.array_position("_p", best).cast("int")))
    cols = [F.col("_p")[i].alias(f"prob_{lab}") for i, lab in enumerate(labels)]
    keep = [F.col(c).alias("pca_scores") if c == "scores" else F.col(c)
            for c in feats.columns if c != "features"]
    return scored.select(*keep, F.coalesce(pop, F.lit(missing_label)).alias("pop"), *cols)


def load_population_model(path: str):
    """A saved ``PipelineModel`` (indexer + classifier) replaces a pretrained
    external model file."""
    from pyspark.ml import PipelineModel
    return PipelineModel.load(path)
