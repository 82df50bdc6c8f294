"""Incremental jobs: requests arrive as files, results and states leave as tables; a finished result is collected once."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.evidence import with_language
from ..operators.labels import app_label, stable_label
from ..operators.pages import cascade
from ..sources import text_pages

ERROR = "Internal Server Error"


def validate(requests: DataFrame) -> DataFrame:
    """requests (file, text) with error: a name of at least five characters that ends in .pdf, and a text."""
    name = F.coalesce("file", F.lit(""))
    error = F.when((F.length(name) < 5) | ~F.endswith(F.lower(name), F.lit(".pdf")), "400").when(F.col("text").isNull(), "422")
    return requests.withColumn("error", error)


def answer(requests: DataFrame) -> DataFrame:
    """file, page, label in the application's names, for valid requests; each page in its own language."""
    good = validate(requests).where("error IS NULL").select(F.col("file").alias("doc_id"), "text")
    pages = cascade(with_language(text_pages(good, words=True)), profile="stable")
    return pages.select(F.col("doc_id").alias("file"), "page", app_label(stable_label(F.col("label"))).alias("label"))


def run_jobs(spark: SparkSession, inbox: str, results: str, states: str, checkpoint: str, work=answer) -> None:
    """Answer all requests that wait in the inbox (Parquet files of file, text), once each.

    Of requests for one file in a batch one is worked on, and none for a file that has a state and was not collected. states: file, task, ok, error. A request that fails is
    marked and does not hold up the others: a batch that fails as a whole is worked on again file by file. A batch that is run again after a failure
    overwrites its own folder, so results are exactly once by batch number.
    """

    def batch(df: DataFrame, number: int) -> None:
        new = df.dropDuplicates(["file"])
        if _exists(spark, states):
            # of earlier batches only: a batch run again is not stopped by its own states
            new = new.join(waiting(spark, states).where(F.col("batch") != number).select("file"), "file", "left_anti")
        told = validate(new).persist()  # few rows; read twice below
        try:
            try:
                work(told.select("file", "text")).write.mode("overwrite").parquet(f"{results}/batch={number}")
                failed = told.where("false").select("file")
            except Exception:  # noqa: BLE001  # whatever a request does must not end the stream
                failed = _one_by_one(told, number)
            state = told.join(failed.withColumn("_failed", F.lit(True)), "file", "left")
            error = F.coalesce("error", F.when(F.col("_failed"), ERROR))
            state.select("file", F.uuid().alias("task"), error.isNull().alias("ok"), error.alias("error")).write.mode("overwrite").parquet(f"{states}/batch={number}")
        finally:
            told.unpersist()

    def _one_by_one(told: DataFrame, number: int) -> DataFrame:
        bad, schema = [], None
        for k, row in enumerate(told.where("error IS NULL").select("file").toLocalIterator()):
            try:
                out = work(told.where(F.col("file") == row.file).select("file", "text"))
                out.write.mode("overwrite" if schema is None else "append").parquet(f"{results}/batch={number}")
                schema = out.schema
            except Exception:  # noqa: BLE001
                bad.append((row.file,))
        return spark.createDataFrame(bad, "file string")

    stream = spark.readStream.schema("file string, text string").parquet(inbox)
    stream.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()


def _exists(spark: SparkSession, path: str) -> bool:
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()).exists(where)


def waiting(spark: SparkSession, states: str) -> DataFrame:
    """States that nobody has collected."""
    every = spark.read.parquet(states)
    if _exists(spark, f"{states}_collected"):
        every = every.join(spark.read.parquet(f"{states}_collected").select("task").distinct(), "task", "left_anti")
    return every


def collect(spark: SparkSession, file: str, results: str, states: str, inbox: DataFrame | None = None) -> dict:
    """What there is of a file's request, as the service answers: an unknown file raises KeyError; a finished result is given once."""
    state = waiting(spark, states).where(F.col("file") == file).first() if _exists(spark, states) else None
    if state is None:
        if inbox is not None and not inbox.where(F.col("file") == file).isEmpty():
            return {"has_finished": False}
        raise KeyError(file)
    spark.createDataFrame([(state.task,)], "task string").write.mode("append").parquet(f"{states}_collected")
    if not state.ok:
        return {"has_finished": True, "data": None, "error": state.error}
    rows = spark.read.parquet(results).where((F.col("file") == file) & (F.col("batch") == state.batch)).orderBy("page").collect()
    return {"has_finished": True, "data": [{"page": r.page, "classification": {r.label: 1}} for r in rows]}
