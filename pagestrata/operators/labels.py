"""Labels, profiles and evaluation."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import text as X
from ..functions import vocabulary as V


def one_hot(label: str, classes: list[str] = V.CLASSES) -> list[Column]:
    return [(F.col(label) == c).cast("int").alias(c) for c in classes]


def stable_label(label: Column) -> Column:
    """Classes outside the stable profile become unknown."""
    return F.when(label.isin(V.STABLE), label).otherwise("unknown")


def stable_vector(classes: Column, mapping: dict[str, str] | None = None, labels: list[str] = V.STABLE) -> Column:
    """The stable classes of a map class -> count: classes of the mapping go where it says, others outside the profile to unknown; what meets is summed, what is missing is 0."""
    moved = {"geo_profile": "unknown", "diagram": "unknown", "table": "unknown"} if mapping is None else mapping
    to = F.create_map(*[F.lit(x) for pair in moved.items() for x in pair]) if moved else F.expr("CAST(map() AS map<string, string>)")

    def target(k):
        at = F.coalesce(F.try_element_at(to, k), k)
        return F.when(at.isin(labels), at).otherwise("unknown")

    entries = F.map_entries(classes)
    count = lambda c: F.aggregate(F.filter(entries, lambda e: target(e["key"]) == c), F.lit(0).cast("long"), lambda a, e: a + e["value"]).cast("int")
    return F.create_map(*[x for c in labels for x in (F.lit(c), count(c))])


def apply_profile(documents: DataFrame, profile: str) -> DataFrame:
    """documents with the classes of a profile: stable ones for `stable`; `dev` keeps all and names its version; any other leaves them."""
    if profile == "stable":
        pages = F.transform("pages", lambda p: p.withField("classification", stable_vector(p["classification"])))
        return documents.withColumn("pages", pages)
    if profile == "dev" and "profile_version" not in documents.columns:
        return documents.withColumn("profile_version", F.lit("page_classification:dev"))
    return documents


def documents(pages: DataFrame) -> DataFrame:
    """filename, metadata (page_count, languages), pages (page, classification, metadata) from filename, page, label, language, words, is_frontpage."""
    g = pages.groupBy("filename").agg(F.array_sort(F.collect_list(F.struct("page", F.struct("language", "is_frontpage", "label").alias("q")))).alias("l"))
    made = F.transform("l", lambda x: F.struct(x["page"].alias("page"), F.create_map(*[y for c in V.CLASSES for y in (F.lit(c), (x["q"]["label"] == c).cast("int"))]).alias("classification"), F.struct(x["q"]["language"].alias("language"), x["q"]["is_frontpage"].alias("is_frontpage")).alias("metadata")))
    told = document_languages(pages.select("filename", "page", F.col("language").alias("lang"), "words", "is_frontpage")).select("filename", F.filter(F.split("languages", ","), lambda x: x != "").alias("languages"))
    return g.join(told, "filename").select("filename", F.struct(F.size("l").alias("page_count"), "languages").alias("metadata"), made.alias("pages"))


def app_vector(classes: Column) -> Column:
    """A map class -> count under the application's names; other keys stay."""
    return F.transform_keys(classes, lambda k, _: app_label(k))


def app_label(label: Column) -> Column:
    names = F.create_map(*[F.lit(x) for pair in V.APP_LABELS.items() for x in pair])
    return F.coalesce(F.try_element_at(names, label), label)


def normalise_label(text: Column) -> Column:
    """Cleaned label as a class, aliases resolved, anything else unknown."""
    names = F.create_map(*[F.lit(x) for pair in ({c: c for c in V.CLASSES} | V.ALIASES).items() for x in pair])
    return F.coalesce(F.try_element_at(names, X.clean_label(text)), F.lit("unknown"))


def last_of_key(rows: DataFrame, order: str) -> DataFrame:
    """The last row of each filename and page."""
    w = Window.partitionBy("filename", "page").orderBy(F.desc(order))
    return rows.withColumn("_n", F.row_number().over(w)).where("_n = 1").drop("_n")


def matched(pred: DataFrame, truth: DataFrame) -> DataFrame:
    return pred.withColumnRenamed("label", "pred").join(truth.withColumnRenamed("label", "gt"), ["filename", "page"])


def confusion(pred: DataFrame, truth: DataFrame) -> DataFrame:
    """label, tp, fn, fp over common pages, a row for every class. Pairs are counted first, so only 64 rows meet the classes."""
    pairs = matched(pred, truth).groupBy("gt", "pred").agg(F.count(F.lit(1)).alias("n"))
    each = pairs.withColumn("label", F.explode(F.array(*map(F.lit, V.CLASSES))))
    is_gt, is_pred = F.col("gt") == F.col("label"), F.col("pred") == F.col("label")
    count = lambda c: F.sum(F.when(c, F.col("n")).otherwise(0)).cast("long")
    return each.groupBy("label").agg(count(is_gt & is_pred).alias("tp"), count(is_gt & ~is_pred).alias("fn"), count(~is_gt & is_pred).alias("fp"))


def scores(counts: DataFrame) -> DataFrame:
    p = F.coalesce(F.try_divide("tp", F.col("tp") + F.col("fp")), F.lit(0.0))
    r = F.coalesce(F.try_divide("tp", F.col("tp") + F.col("fn")), F.lit(0.0))
    f = F.coalesce(F.try_divide(2 * p * r, p + r), F.lit(0.0))
    return counts.select("label", F.round(p, 6).alias("precision"), F.round(r, 6).alias("recall"), F.round(f, 6).alias("f1"))


def macro(counts: DataFrame) -> DataFrame:
    return scores(counts).agg(*[F.round(F.avg(c), 5).alias(c) for c in ("precision", "recall", "f1")])


def micro(counts: DataFrame) -> DataFrame:
    s = counts.agg(F.sum("tp").alias("tp"), F.sum("fn").alias("fn"), F.sum("fp").alias("fp"))
    return s.select(*[F.round(F.coalesce(F.try_divide(F.col("tp"), d), F.lit(0.0)), 4).alias(n) for n, d in (("precision", F.col("tp") + F.col("fp")), ("recall", F.col("tp") + F.col("fn")), ("f1", F.col("tp") + (F.col("fp") + F.col("fn")) / 2))])


def mismatches(pred: DataFrame, truth: DataFrame) -> DataFrame:
    return matched(pred, truth).where("pred <> gt").select("filename", "page", "pred", "gt")


def document_languages(pages: DataFrame) -> DataFrame:
    """filename, languages from filename, page, lang, words: best by sum of ln(words) / page, then others with two long pages, first seen first.

    Pages flagged is_frontpage, where there is such a column, do not count.
    """
    counted = pages.where("lang IS NOT NULL AND NOT is_frontpage") if "is_frontpage" in pages.columns else pages.where("lang IS NOT NULL")
    by = counted.groupBy("filename", "lang").agg(F.round(F.sum(F.log("words") / F.col("page")), 6).alias("score"), F.min("page").alias("first"), F.count_if(F.col("words") > 50).alias("long"), F.min(F.when(F.col("words") > 50, F.col("page"))).alias("first_long"))
    best = by.groupBy("filename").agg(F.max_by("lang", F.struct("score", -F.col("first"))).alias("best"), F.array_sort(F.collect_list(F.when(F.col("long") >= 2, F.struct("first_long", "lang")))).alias("_more"))
    found = best.select("filename", F.concat(F.array("best"), F.transform(F.filter("_more", lambda x: x["lang"] != F.col("best")), lambda x: x["lang"])).alias("languages"))
    return pages.select("filename").distinct().join(found, "filename", "left").select("filename", F.coalesce(F.array_join("languages", ","), F.lit("")).alias("languages"))


def comparison(pred: DataFrame, truth: DataFrame) -> DataFrame:
    """Pages whose labels differ: filename, page, <label>_pred, <label>_gt and <label>_match of every class, all_labels_match, status."""
    both = matched(pred, truth).where("pred <> gt")
    sides = [(F.col(side) == c).cast("int").alias(f"{c}_{side}") for side in ("pred", "gt") for c in V.CLASSES]
    match = [((F.col("pred") == c) == (F.col("gt") == c)).cast("int").alias(f"{c}_match") for c in V.CLASSES]
    return both.select("filename", "page", *sides, *match, F.lit(0).alias("all_labels_match"), F.lit("mismatch").alias("status"))


def active_labels(rows: DataFrame) -> DataFrame:
    """filename, page, true_labels, predicted_labels: the labels set to 1 in rows of comparison()."""
    on = lambda side: F.filter(F.array(*[F.when(F.col(f"{c}_{side}") == 1, c) for c in V.CLASSES]), lambda x: x.isNotNull())
    return rows.select("filename", "page", on("gt").alias("true_labels"), on("pred").alias("predicted_labels"))


def report(pred: DataFrame, truth: DataFrame) -> DataFrame:
    """label, precision, recall, f1, support of every class."""
    counts = confusion(pred, truth)
    return scores(counts).join(counts.select("label", (F.col("tp") + F.col("fn")).alias("support")), "label")


def labelled(pages: DataFrame, truth: DataFrame, strict: bool = True) -> DataFrame:
    """pages with their label from truth (filename, page, label); a page without one raises if strict, else its label is null."""
    out = pages.join(truth.select("filename", "page", "label"), ["filename", "page"], "left")
    if not strict:
        return out
    return out.withColumn("label", F.coalesce("label", F.raise_error(F.concat_ws(" ", F.lit("no label for"), "filename", F.col("page").cast("string"))).cast(truth.schema["label"].dataType)))


def classified_only(documents: DataFrame) -> DataFrame:
    """Documents with at least one page that has a classification."""
    return documents.where(F.coalesce(F.exists("pages", lambda p: p["classification"].isNotNull() & (F.size(p["classification"]) > 0)), F.lit(False)))


def softmax(logits: Column) -> Column:
    powers = F.transform(logits, lambda v: F.exp(v - F.array_max(logits)))
    return F.transform(powers, lambda p: p / F.aggregate(powers, F.lit(0.0), lambda a, x: a + x))


def split_rows(rows: DataFrame, key: str, ratio: float) -> DataFrame:
    """rows with split: the first int(n x ratio) by a hash of the key are val, the others train.

    Hashes are counted in ranges; only rows of the range in which the cut falls are ranked.
    """
    h = (F.col(key) * 2654435761) % 1000003
    hashed = rows.withColumn("_h", h).withColumn("_range", F.floor(F.col("_h") / 1000).cast("int"))
    counts = hashed.groupBy("_range").agg(F.count(F.lit(1)).alias("_n"))  # at most 1,001 rows
    upto = counts.withColumn("_upto", F.sum("_n").over(Window.orderBy("_range"))).withColumn("_all", F.sum("_n").over(Window.partitionBy()))
    placed = upto.select("_range", (F.col("_upto") - F.col("_n")).alias("_before"), "_upto", F.floor(F.col("_all") * ratio).alias("_val"))
    joined = hashed.join(F.broadcast(placed), "_range")
    cut = joined.where("_before < _val AND _upto > _val")
    ranked = cut.withColumn("_rank", F.row_number().over(Window.partitionBy("_range").orderBy("_h", key)) + F.col("_before")).withColumn("split", F.when(F.col("_rank") <= F.col("_val"), "val").otherwise("train"))
    whole = joined.where("NOT (_before < _val AND _upto > _val)").withColumn("split", F.when(F.col("_upto") <= F.col("_val"), "val").otherwise("train"))
    return whole.select(*rows.columns, "split").union(ranked.select(*rows.columns, "split"))
