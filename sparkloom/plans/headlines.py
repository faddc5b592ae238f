"""Headline classification from records to a report: clean, dedupe, filter, split, fit, evaluate."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkloom.functions.text import dedupe_key, normalize_titles
from sparkloom.operators import dataset


def clean_records(records: DataFrame, order: str) -> DataFrame:
    """Records with titles in normal form; empty titles go, and of those alike the first by order stays, whatever its label."""
    titled = normalize_titles(records, "title").where("title <> ''")
    return dataset.keep_first(titled.withColumn("_key", dedupe_key(F.col("title"))), "_key", order).drop("_key")


def build_dataset(records: DataFrame, order: str, min_per_class: int = 15) -> DataFrame:
    """Clean records of the frequent classes, with split."""
    kept = dataset.frequent_classes(clean_records(records, order), "label", min_per_class)
    return dataset.stratified_split(kept, "label", F.col(order).cast("string"))


def train_models(train: DataFrame) -> dict[str, object]:
    """The majority class and the tf-idf classifier, both from train alone."""
    labels = [r["label"] for r in train.select("label").distinct().orderBy("label").collect()]
    place = F.array_position(F.array(*[F.lit(x) for x in labels]), F.col("label")).cast("double") - 1
    model = dataset.fit_logistic(dataset.balanced_weights(train.withColumn("_y", place), "label"), "_y", "title")
    model.labels = labels
    return {"majority": dataset.majority(train, "label"), "tfidf_logreg": model}


def predicted(model, rows: DataFrame) -> DataFrame:
    """rows with prediction, by a majority class or a TextModel."""
    if isinstance(model, DataFrame):
        return rows.join(F.broadcast(model), F.lit(True))
    out = model.transform(rows)
    name = F.element_at(F.array(*[F.lit(x) for x in model.labels]), F.col("prediction").cast("int") + 1)
    return out.select(*rows.columns, name.alias("prediction"))


def evaluate(models: dict[str, object], test: DataFrame) -> DataFrame:
    """``model, n, accuracy, macro_precision, macro_recall, macro_f1, per_class, confusion`` for each model, rounded to 4 digits."""
    out = None
    for name, model in sorted(models.items()):
        rows = predicted(model, test)
        four = [F.round(c, 4).alias(c) for c in ("precision", "recall", "f1")]
        per = dataset.class_scores(rows).where("support > 0").agg(F.array_sort(F.collect_list(F.struct("label", "support", *four))).alias("per_class"))
        cells = dataset.confusion(rows).agg(F.array_sort(F.collect_list(F.struct("truth", "predicted", "n"))).alias("confusion"))
        row = dataset.report(rows).join(F.broadcast(per), F.lit(True)).join(F.broadcast(cells), F.lit(True)).select(F.lit(name).alias("model"), "*")
        out = row if out is None else out.unionByName(row)
    return out
