"""Models trained with Spark ML on the tables at hand."""

from __future__ import annotations

from pyspark.ml import Pipeline
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import LinearRegression
from pyspark.ml.tuning import ParamGridBuilder, TrainValidationSplit
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quire.functions import text as T


def ocr_features(routing: DataFrame) -> DataFrame:
    """One row for each document: the largest of repeated features, nulls as -1."""
    f = routing.groupBy("doc_id").agg(F.max("garbled_text_ratio").alias("garbled"), F.max("num_pages").alias("pages"), F.max(F.col("is_form").cast("int")).alias("form"), F.max(T.scanner_producer(F.col("producer")).cast("int")).alias("scanner"), F.max("ocr_prob").alias("prior"))
    return f.select("doc_id", *[F.coalesce(F.col(c).cast("double"), F.lit(-1.0)).alias(c) for c in ("garbled", "pages", "form", "scanner", "prior")])


def ocr_probabilities(routing: DataFrame, docs: DataFrame, depths: tuple[int, ...] = (3,), trees: int = 10) -> DataFrame:
    """(doc_id, probability, route): boosted trees tell which documents need OCR; a hash of the id splits train and test."""
    x = ocr_features(routing).join(docs.select("doc_id", (F.col("extractor") == "rolmOCR").cast("double").alias("label")), "doc_id")
    va = VectorAssembler(inputCols=["garbled", "pages", "form", "scanner", "prior"], outputCol="features")
    gbt = GBTClassifier(maxIter=trees, seed=42)
    search = TrainValidationSplit(estimator=Pipeline(stages=[va, gbt]), estimatorParamMaps=ParamGridBuilder().addGrid(gbt.maxDepth, list(depths)).build(), evaluator=BinaryClassificationEvaluator(), trainRatio=0.8, seed=42)
    model = search.fit(x.where("label IS NOT NULL"))
    p = vector_to_array("probability")[1]
    return model.transform(x).select("doc_id", p.alias("probability"), F.when(p >= 0.2, "ocr").otherwise("non_ocr").alias("route"))


def quality_features(docs: DataFrame) -> DataFrame:
    """Shape features of a text, computed in the JVM."""
    t, n = F.col("text"), F.greatest(F.length("text"), F.lit(1)).cast("double")
    share = lambda pattern: (F.length(F.regexp_replace(t, pattern, "")) / n)
    words = F.size(F.split(t, r"\s+"))
    return docs.where(F.length("text") > 0).select("doc_id", F.log1p(n).alias("size"), share(r"[^\p{L}]").alias("letters"), share(r"[^\p{Nd}]").alias("digits"), share(r"[^|]").alias("bars"), share(r"[^\p{Lu}]").alias("capitals"), share(r"[^\p{P}]").alias("signs"), (n / words).alias("word"))


def quality_scores(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(doc_id, score 0-5): a linear model of the teachers' mean rating over shape features."""
    f = quality_features(docs)
    cols = [c for c in f.columns if c != "doc_id"]
    y = labels.where(F.col("fw_edu_score").between(0, 5)).groupBy("doc_id").agg(F.avg("fw_edu_score").alias("label"))
    v = VectorAssembler(inputCols=cols, outputCol="features")
    model = LinearRegression(regParam=0.1).fit(v.transform(f.join(y, "doc_id")))
    return model.transform(v.transform(f)).select("doc_id", F.greatest(F.least(F.col("prediction"), F.lit(5.0)), F.lit(0.0)).alias("score"))


def language_model(docs: DataFrame, langs: tuple[str, ...], features: int = 1 << 14, per_language: int = 300):
    """A naive Bayes model over hashed character trigrams, fitted on about per_language labelled texts of each language."""
    from pyspark.ml.classification import NaiveBayes
    from pyspark.ml.feature import HashingTF, StringIndexer

    h = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30))
    n = dict(docs.where(F.col("lang").isin(*langs)).groupBy("lang").count().collect())
    rule = F.lit(False)
    for k, v in sorted(n.items()):
        rule = rule | ((F.col("lang") == k) & (h < int(min(1.0, per_language / v) * (1 << 30))))
    train = trigrams(docs.where(rule & (F.length("text") > 0)))
    index = StringIndexer(inputCol="lang", outputCol="label", stringOrderType="alphabetAsc")
    return Pipeline(stages=[index, HashingTF(inputCol="grams", outputCol="features", numFeatures=features), NaiveBayes(smoothing=0.5)]).fit(train)


def trigrams(docs: DataFrame) -> DataFrame:
    """Adds `grams`, the three-letter pieces of the text's words, made by one pattern in the JVM."""
    t = F.regexp_replace(F.lower("text"), r"[^\p{L}]+", " ")
    return docs.withColumn("grams", F.concat(*[F.regexp_extract_all(F.substring(t, i, 1 << 30), F.lit(r"(...)")) for i in (1, 2, 3)]))


def document_languages(docs: DataFrame, langs: tuple[str, ...]) -> DataFrame:
    """(doc_id, language, score) of texts, by language_model."""
    m = language_model(docs, langs)
    names = m.stages[0].labels
    # the labels of the fitted index, not of the rows, name the classes
    scored = m.stages[2].transform(m.stages[1].transform(trigrams(docs.where(F.length("text") > 0).select("doc_id", "text"))))
    p = vector_to_array("probability")
    return scored.select("doc_id", F.element_at(F.array(*[F.lit(x) for x in names]), F.col("prediction").cast("int") + 1).alias("language"), F.round(F.array_max(p), 6).alias("score"))


def multi_head(docs: DataFrame, labels: DataFrame, heads: tuple[str, ...]) -> DataFrame:
    """(doc_id, one score for each head): the features are made once, each head is a linear model over them."""
    f = quality_features(docs)
    v = VectorAssembler(inputCols=[c for c in f.columns if c != "doc_id"], outputCol="features").transform(f)
    out = v
    for h in heads:
        y = labels.where(F.col(h).isNotNull() & (F.col(h) >= 0)).groupBy("doc_id").agg(F.avg(h).alias("label"))
        m = LinearRegression(regParam=0.1, predictionCol=h).fit(v.join(y, "doc_id"))
        out = m.transform(out)
    return out.select("doc_id", *heads)
