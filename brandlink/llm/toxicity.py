"""Toxicity by a classifier chain.

The categories are predicted one after another by logistic regressions over
word presence; each later model also reads the probabilities of the categories
before it.  In training these are out-of-fold predictions, so a later model
sees what earlier models say about texts they were not fitted on.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml.classification import LogisticRegression, LogisticRegressionModel
from pyspark.ml.feature import CountVectorizerModel, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import staged
from .licenses import license_words

#: Categories in the chain's order: name and label expression.
CATEGORIES = (("low_quality", "1 - quality"), ("toxic", "toxic"))
MAX_ROWS = 20_000     # labelled rows that the models are fitted on, at most about
MIN_SHARE = 0.005     # share of the fitted documents that must hold a word
EVIDENCE = 24.0       # chi-squared of a word with a category (about 1 in a million by chance)
FOLDS = 3
THRESHOLD = 0.5


STEMS = (5, 6, 7, 8)  # lengths of the word beginnings that count besides whole words


def _with_words(df: DataFrame, text: str = "text") -> DataFrame:
    """Adds ``_tox_words``: distinct words of a text, and their beginnings
    (marked by a star).  The words are a column of their own, so that the
    functions over them do not take the text apart once each."""
    words = F.col("_tox_w")

    def stems(n: int) -> Column:
        longer = F.filter(words, lambda w: F.length(w) > n)
        return F.transform(longer, lambda w: F.concat(F.left(w, F.lit(n)), F.lit("*")))

    return (df.withColumn("_tox_w", F.array_distinct(license_words(F.col(text))))
            .withColumn("_tox_words", F.array_distinct(F.concat(words, *[stems(n) for n in STEMS]))).drop("_tox_w"))


def telling_words(d: DataFrame, labels: list[str], folds: int = 0) -> list[dict[str, list[str]]]:
    """The words whose presence goes with a label column, by chi-squared with
    continuity correction, and of whose documents at least half are in the
    category.  A language or a topic that leans towards a category is no word
    of it.

    One dictionary (label -> its words) for all rows, and one for the rows
    outside of each of ``folds`` folds (column ``_fold``).  Only words that pass
    reach the driver; the fitted rows bound their number."""
    views = [F.lit(True), *[F.col("_fold") != f for f in range(folds)]]
    counted = [F.sum(F.when(v, 1).otherwise(0)).cast("double").alias(f"n{i}") for i, v in enumerate(views)]
    counted += [F.sum(F.when(v, F.col(c)).otherwise(0.0)).alias(f"{c}{i}") for c in labels for i, v in enumerate(views)]
    whole = d.agg(*counted).first()
    w = d.select(F.explode("_tox_words").alias("word"), "_fold", *labels).groupBy("word").agg(*counted)
    passed = {}
    for i in range(len(views)):
        n, m = whole[f"n{i}"] or 0.0, F.col(f"n{i}")
        for c in labels:
            p, a = whole[f"{c}{i}"] or 0.0, F.col(f"{c}{i}")          # with the word: positive, all
            gap = F.greatest(F.abs(a * n - m * p) - n / 2, F.lit(0.0))
            chi = gap * gap * n / (m * (n - m) * F.lit(float(p * (n - p) or 1)))
            passed[f"{c}:{i}"] = (m >= max(2.0, MIN_SHARE * n)) & (m < n) & (a * 2 >= m) & F.lit(0 < p < n) & (
                F.when((m > 0) & (m < n), chi).otherwise(0.0) >= EVIDENCE)
    some = F.lit(False)
    for c in passed.values():
        some = some | c
    rows = w.where(some).select("word", *[c.alias(k) for k, c in passed.items()]).orderBy("word").collect()
    return [{c: [r["word"] for r in rows if r[f"{c}:{i}"]] for c in labels} for i in range(len(views))]


def _vectors(words: dict[str, list[str]]) -> CountVectorizerModel:
    """Presence of the words of any category."""
    every = sorted({w for ws in words.values() for w in ws}) or [""]
    cv = CountVectorizerModel.from_vocabulary(every, inputCol="_tox_words", outputCol="_tox_v")
    return cv.setBinary(True)


@dataclass
class Chain:
    """A fitted chain."""
    vocabulary: CountVectorizerModel
    models: list[tuple[str, LogisticRegressionModel]]

    def transform(self, docs: DataFrame, text: str = "text") -> DataFrame:
        """Adds ``_tox_p_<category>`` for every category; keeps rows and columns."""
        d = _with_words(docs, text)
        d = self.vocabulary.transform(d)
        for k, (name, model) in enumerate(self.models):
            d = _features(d, [c for c, _ in self.models[:k]])
            model.setFeaturesCol("_tox_x").setProbabilityCol("_tox_p").setRawPredictionCol("").setPredictionCol("")
            d = model.transform(d).withColumn(f"_tox_p_{name}", vector_to_array("_tox_p")[1]).drop("_tox_p", "_tox_x")
        return d.drop("_tox_words", "_tox_v")


def _features(df: DataFrame, before: list[str]) -> DataFrame:
    if not before:
        return df.withColumn("_tox_x", F.col("_tox_v"))
    return VectorAssembler(inputCols=["_tox_v", *(f"_tox_p_{c}" for c in before)], outputCol="_tox_x").transform(df)


def _fit(df: DataFrame, before: list[str], label: str) -> LogisticRegressionModel:
    lr = LogisticRegression(featuresCol="_tox_x", labelCol=label, maxIter=60, regParam=1e-4,
                            probabilityCol="_tox_p", rawPredictionCol="_tox_r", predictionCol="_tox_y",
                            standardization=False)
    return lr.fit(_features(df, before))


def fit_chain(labelled: DataFrame, categories=CATEGORIES, max_rows: int = MAX_ROWS,
              folds: int = FOLDS) -> Chain | None:
    """Fit on rows of ``doc_id, text`` and the label columns.

    Of more than ``max_rows`` labelled rows an id-hashed share of about that
    size is used, each text once (with its labels' largest values).  Rows with a
    null label are left out.  Words are chosen anew for the rows outside of each
    fold, so an out-of-fold probability has not seen its row's labels in any
    way.  Where no word tells of the last category there is no chain (None).
    """
    ys = [f"_y_{n}" for n, _ in categories]
    d = labelled.select("doc_id", "text", *[F.expr(e).cast("double").alias(y) for y, (_, e) in zip(ys, categories)])
    d = d.dropna(subset=ys)
    total = d.count()
    if total > max_rows:
        d = d.where(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30)) < int((1 << 30) * max_rows / total))
    # copies of a text say no more than one
    d = d.groupBy("text").agg(*[F.max(y).alias(y) for y in ys])
    d = d.withColumn("_fold", F.pmod(F.xxhash64(F.lit("fold"), "text"), F.lit(folds)))
    d = staged(_with_words(d).drop("text"))
    words = telling_words(d, ys, folds)
    if not words[0][ys[-1]]:
        return None
    cv = _vectors(words[0])
    models, known = [], d.select("_tox_words", "_fold", *ys)
    for k, (name, _) in enumerate(categories):
        before, label = [c for c, _ in categories[:k]], ys[k]
        models.append((name, _fit(cv.transform(known), before, label)))
        if k + 1 < len(categories):  # out-of-fold probabilities for the later models
            parts = []
            for f in range(folds):
                own = _vectors(words[f + 1]).transform(known)
                m = _fit(own.where(F.col("_fold") != f), before, label)
                held = m.transform(_features(own.where(F.col("_fold") == f), before))
                parts.append(held.withColumn(f"_tox_p_{name}", vector_to_array("_tox_p")[1])
                             .drop("_tox_p", "_tox_r", "_tox_y", "_tox_x", "_tox_v"))
            out = parts[0]
            for p in parts[1:]:
                out = out.unionByName(p)
            known = staged(out)
    return Chain(cv, models)


def judge_toxicity(docs: DataFrame, labels: DataFrame, categories=CATEGORIES,
                   threshold: float = THRESHOLD, prefix: str = "") -> DataFrame:
    """The documents with ``p_<category>`` columns and ``is_toxic`` (probability
    of the last category above ``threshold``), each name behind ``prefix``; rows
    and columns stay.  Choose a prefix where the documents may have such columns
    of their own, else these are replaced.

    The chain is fitted on the documents that ``labels`` knows; of several labels
    of one id the largest values count.  Null and empty texts hold no words and
    get the models' base rates.  Where the labels name no telling word, or there
    are none, the probabilities are null and nothing is toxic.  Repeated rows
    are judged alike; an empty table gives no rows.
    """
    known = labels.groupBy("doc_id").agg(F.max("quality").alias("quality"), F.max("toxic").alias("toxic"))
    chain = fit_chain(docs.select("doc_id", "text").join(known, "doc_id"), categories)
    if chain is None:
        return docs.withColumns({f"{prefix}p_{n}": F.lit(None).cast("double") for n, _ in categories}
                                | {f"{prefix}is_toxic": F.lit(False)})
    out = chain.transform(docs)
    out = out.withColumns({f"{prefix}p_{n}": F.col(f"_tox_p_{n}") for n, _ in categories})
    return (out.withColumn(f"{prefix}is_toxic", F.col(f"_tox_p_{categories[-1][0]}") > threshold)
            .drop(*[f"_tox_p_{n}" for n, _ in categories]))
