"""k-mer composition: vectors, principal components and clusters."""

from __future__ import annotations

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import MultilayerPerceptronClassifier
from pyspark.ml.clustering import KMeans
from pyspark.ml.feature import PCA, Normalizer, StandardScaler, StringIndexer
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quorumkit.functions import sequence as S


def kmer_profiles(reads: DataFrame, k: int = 4, seq: str = "seq", name: str = "kmers") -> DataFrame:
    """Add the k-mer frequencies over ACGT as a vector in lexical order."""
    counts = reads.withColumn("__c", array_to_vector(S.kmer_counts(F.col(seq), k).cast("array<double>")))
    return Normalizer(p=1.0, inputCol="__c", outputCol=name).transform(counts).drop("__c")


def fit_composition(profiles: DataFrame, components: int = 5, clusters: int = 5, seed: int = 42) -> PipelineModel:
    """Centre, project on principal components, cluster."""
    stages = [StandardScaler(withMean=True, withStd=False, inputCol="kmers", outputCol="__z"), PCA(k=components, inputCol="__z", outputCol="kmer_pca"), KMeans(k=clusters, seed=seed, featuresCol="kmer_pca", predictionCol="tetrabin")]
    return Pipeline(stages=stages).fit(profiles)


def composition_features(model: PipelineModel | None, profiles: DataFrame, components: int = 5) -> DataFrame:
    """kmer_pca_1.. and tetrabin; without a model all are 0."""
    if model is None:
        return profiles.drop("kmers").withColumns({**{f"kmer_pca_{i + 1}": F.lit(0.0) for i in range(components)}, "tetrabin": F.lit(0)})
    out = model.transform(profiles).withColumn("__p", vector_to_array("kmer_pca"))
    return out.withColumns({f"kmer_pca_{i + 1}": F.col("__p")[i] for i in range(components)}).drop("__p", "__z", "kmers", "kmer_pca")


def fit_composition_classifier(profiles: DataFrame, label: str, k: int = 4, hidden: tuple[int, ...] = (64,), seed: int = 42, steps: int = 60) -> PipelineModel:
    """Classifier of k-mer profiles, trained by all executors."""
    classes = profiles.select(F.countDistinct(label)).first()[0]
    index = StringIndexer(inputCol=label, outputCol="__y", stringOrderType="alphabetAsc")
    net = MultilayerPerceptronClassifier(layers=[4**k, *hidden, max(2, classes)], featuresCol="kmers", labelCol="__y", seed=seed, maxIter=steps)
    return Pipeline(stages=[index, net]).fit(profiles)


def classify_composition(model: PipelineModel, profiles: DataFrame) -> DataFrame:
    """Most likely label of each profile and its probability."""
    names = F.array(*map(F.lit, model.stages[0].labels))
    out = model.stages[1].transform(profiles)
    return out.withColumns({"pred": F.get(names, F.col("prediction").cast("int")), "confidence": F.array_max(vector_to_array("probability"))}).drop("rawPrediction", "probability", "prediction")


