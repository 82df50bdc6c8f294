"""Result sinks. Paths are of any store that Hadoop writes."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .operators.labels import active_labels, classified_only
from .operators.lines import class_of_one_hot

ONE_FILE_BYTES = 256 << 20


def write_documents(documents: DataFrame, path: str) -> None:
    """One JSON object a line for each result document, in parts."""
    documents.write.mode("overwrite").option("ignoreNullFields", "false").json(path)


def write_one_json(documents: DataFrame, path: str, indent: int = 4) -> None:
    """All documents as one JSON array in one file, as readers of single reports expect; raises above ONE_FILE_BYTES."""
    told = documents.select(F.to_json(F.struct(*documents.columns), {"ignoreNullFields": "false"}).alias("j"))
    size = told.agg(F.coalesce(F.sum(F.length("j")), F.lit(0))).first()[0]
    if size > ONE_FILE_BYTES:
        raise ValueError(f"{size} characters are too many for one file; use write_documents")
    rows = [json.loads(r.j) for r in told.orderBy("j").collect()]
    _put(documents.sparkSession, path, json.dumps(rows, indent=indent, ensure_ascii=False))


def _put(spark: SparkSession, path: str, text: str) -> None:
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    out = where.getFileSystem(spark._jsc.hadoopConfiguration()).create(where, True)
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()


def write_truth(labels: DataFrame, path: str) -> None:
    """Ground truth of files (filename, label): one page each, one-hot, no languages known."""
    page = F.struct(F.lit(1).alias("page"), F.create_map("label", F.lit(1)).alias("classification"), F.struct(F.lit(None).cast("string").alias("language"), F.lit(None).cast("boolean").alias("is_frontpage")).alias("metadata"))
    docs = labels.select("filename", F.struct(F.lit(1).alias("page_count"), F.expr("CAST(array() AS array<string>)").alias("languages")).alias("metadata"), F.array(page).alias("pages"))
    docs.write.mode("overwrite").option("ignoreNullFields", "false").json(path)


def write_confusion(counts: DataFrame, path: str) -> None:
    names = {"label": "Class", "tp": "True_Positives", "fn": "False_Negatives", "fp": "False_Positives"}
    counts.select(*[F.col(a).alias(b) for a, b in names.items()]).write.mode("overwrite").option("header", True).csv(path)


def write_comparison(rows: DataFrame, path: str) -> None:
    """Mismatched pages with all their labels, by file and page."""
    rows.orderBy("filename", "page").write.mode("overwrite").option("header", True).csv(path)


def write_misclassified(rows: DataFrame, path: str) -> None:
    """Rows of comparison(): filename, page and labels, once all together and once in a folder for each true class."""
    told = active_labels(rows)
    flat = told.withColumns({c: F.array_join(c, ",") for c in ("true_labels", "predicted_labels")})
    flat.write.mode("overwrite").option("header", True).csv(f"{path}/misclassifications")
    each = told.withColumn("true_class", F.explode("true_labels")).withColumns({c: F.array_join(c, ",") for c in ("true_labels", "predicted_labels")})
    each.write.mode("overwrite").partitionBy("true_class").option("header", True).csv(f"{path}/by_class")


def write_metrics(metrics: dict[str, float], run: str, spark: SparkSession, path: str) -> None:
    """Append run, name and value of metrics or parameters to the tracking table."""
    spark.createDataFrame([(run, k, float(v)) for k, v in sorted(metrics.items())], "run string, name string, value double").write.mode("append").parquet(path)


def write_class_pages(documents: DataFrame, path: str, caps: dict[str, int], seed: int = 42) -> None:
    """filename and page of each document's classes up to their caps, in a folder for each class."""
    from pyspark.sql import Window

    pages = classified_only(documents).select("filename", F.explode("pages").alias("p"))
    names = sorted(caps)
    label = class_of_one_hot({c: F.try_element_at(F.col("p.classification"), F.lit(c)) for c in names})
    cap = F.coalesce(F.try_element_at(F.create_map(*[F.lit(x) for pair in caps.items() for x in pair]), F.col("label")), F.lit(1))
    order = Window.partitionBy("filename", "label").orderBy(F.xxhash64("filename", "page", F.lit(seed)))
    chosen = pages.select("filename", F.col("p.page").alias("page"), label.alias("label")).withColumn("_n", F.row_number().over(order)).where(F.col("_n") <= cap).drop("_n")
    chosen.write.mode("overwrite").partitionBy("label").parquet(path)


def write_split(rows: DataFrame, path: str) -> None:
    """rows with split, in a folder for each side; what was there goes."""
    rows.write.mode("overwrite").partitionBy("split").parquet(path)
