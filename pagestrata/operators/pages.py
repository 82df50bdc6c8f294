"""Page operators on one row a page: projections over line arrays, no shuffle but for line segments and the roll-up."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import geometry as G
from ..functions import text as X
from ..functions import vocabulary as V
from ..storage import stored
from .evidence import evidence


def total(lines: Column | str, f) -> Column:
    return F.aggregate(lines, F.lit(0.0), lambda a, x: a + f(x).cast("double"))


def mean_words(lines="lines") -> Column:
    return total(lines, lambda x: x["n_words"]) / F.size(lines)


def extent(pages: DataFrame) -> DataFrame:
    return pages.select("doc_id", "page", F.array_min(F.transform("lines", lambda x: x["x0"])).alias("x0"), F.array_min(F.transform("lines", lambda x: x["y0"])).alias("y0"), F.array_max(F.transform("lines", lambda x: x["x1"])).alias("x1"), F.array_max(F.transform("lines", lambda x: x["y1"])).alias("y1"))


def block_rows(pages: DataFrame) -> DataFrame:
    """doc_id, page, block, n_lines and the box of each block, from one Arrow pass over boxes."""
    boxes = pages.select("doc_id", "page", F.transform("lines", lambda x: F.struct(x["x0"], x["y0"], x["x1"], x["y1"])).alias("b"))
    schema = T.StructType([boxes.schema["doc_id"], boxes.schema["page"], *[T.StructField(n, T.IntegerType()) for n in ("block", "n_lines")], *[T.StructField(n, T.DoubleType()) for n in ("x0", "y0", "x1", "y1")]])

    def run(batches):
        for batch in batches:
            column = batch.column("b")
            at = column.offsets.to_numpy()
            flat = np.stack([f.to_numpy(zero_copy_only=False) for f in column.values.flatten()], axis=1) if len(column.values) else np.zeros((0, 4))
            flat, at = flat[at[0] : at[-1]], at - at[0]
            of, block = [], []
            for i in range(len(batch)):
                labels = G.block_labels(flat[at[i] : at[i + 1]])
                block.append(labels)
                of.append(np.full(len(labels), i))
            of, block = (np.concatenate(x) if x else np.zeros(0, np.int64) for x in (of, block))
            order = np.lexsort((block, of))
            of, block, flat = of[order], block[order], flat[order]
            first = np.flatnonzero(np.r_[True, (of[1:] != of[:-1]) | (block[1:] != block[:-1])][: len(of)])
            sides = [f.reduceat(flat[:, k], first) if len(first) else np.zeros(0) for k, f in enumerate((np.minimum, np.minimum, np.maximum, np.maximum))]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id").take(pa.array(of[first])), batch.column("page").take(pa.array(of[first])), pa.array(block[first], pa.int32()), pa.array(np.diff(np.r_[first, len(of)]), pa.int32()), *[pa.array(x, pa.float64()) for x in sides]], names=schema.names)

    return boxes.mapInArrow(run, schema)


def line_blocks(pages: DataFrame) -> DataFrame:
    """doc_id, page, lno, block, block_lines of each line."""
    boxes = pages.select("doc_id", "page", F.transform("lines", lambda x: F.struct(x["x0"], x["y0"], x["x1"], x["y1"])).alias("b"))
    schema = T.StructType([boxes.schema["doc_id"], boxes.schema["page"], *[T.StructField(n, T.IntegerType()) for n in ("lno", "block", "block_lines")]])

    def run(batches):
        for batch in batches:
            at, of, lno, block, size = 0, [], [], [], []
            for i, page in enumerate(batch.column("b").to_pylist()):
                labels = G.block_labels(np.array([tuple(b.values()) for b in page], float).reshape(-1, 4))
                of.append(np.full(len(labels), i))
                lno.append(np.arange(len(labels)))
                block.append(labels)
                size.append(np.bincount(labels, minlength=1)[labels] if len(labels) else labels)
            of, lno, block, size = (np.concatenate(x) if x else np.zeros(at, np.int64) for x in (of, lno, block, size))
            yield pa.RecordBatch.from_arrays([batch.column(c).take(pa.array(of)) for c in ("doc_id", "page")] + [pa.array(x, pa.int32()) for x in (lno, block, size)], names=schema.names)

    return boxes.mapInArrow(run, schema)


def material_clusters(pages: DataFrame) -> DataFrame:
    """doc_id, page, cluster, n_lines, n_words, and the box from the topmost line's corner to the lowest one's, of descriptions of material at one left edge."""
    found = F.filter("lines", lambda x: X.is_description(x["text"], F.col("lang"), V.MATERIAL, V.MATERIAL_NOT))
    marked = pages.select("doc_id", "page", found.alias("m")).where(F.size("m") > 0).withColumn("c", G.greedy_clusters(F.transform("m", lambda x: x["x0"])))
    each = marked.select("doc_id", "page", F.explode(F.arrays_zip("m", "c")).alias("z")).select("doc_id", "page", F.col("z.c").alias("cluster"), "z.m.*")
    top, low = F.struct("y0", "lno"), F.struct("y1", -F.col("lno"))
    return each.groupBy("doc_id", "page", "cluster").agg(F.count(F.lit(1)).cast("int").alias("n_lines"), F.sum("n_words").cast("int").alias("n_words"), F.min_by("x0", top).alias("x0"), F.min("y0").alias("y0"), F.max_by("x1", low).alias("x1"), F.max("y1").alias("y1"))


def description_noise(clusters: DataFrame, words: DataFrame) -> DataFrame:
    """clusters with noise (words inside the box by words of the description) and valid (noise below 1.5, fewer than three lines).

    Every word inside counts, those of the description too, as they do where words are read apart from lines.
    """
    c, w = clusters.alias("c"), words.alias("w")
    inside = [F.col("c.doc_id") == F.col("w.doc_id"), F.col("c.page") == F.col("w.page"), F.col("w.x0") >= F.col("c.x0"), F.col("w.x1") <= F.col("c.x1"), F.col("w.y0") >= F.col("c.y0"), F.col("w.y1") <= F.col("c.y1")]
    held = c.join(w, inside).groupBy("c.doc_id", "c.page", "c.cluster").agg(F.count(F.lit(1)).alias("_inside"))
    noise = F.coalesce("_inside", F.lit(0)) / F.col("n_words")
    return clusters.join(held, ["doc_id", "page", "cluster"], "left").withColumn("noise", noise).drop("_inside").withColumn("valid", (F.col("noise") < 1.5) & (F.col("n_lines") < 3))


def density(e=F.col) -> Column:
    """Area of lines of several words by area of blocks; the first word of a line carries its box, so that box is the union of the line's words."""
    return F.coalesce(F.try_divide(e("word_area"), e("block_area")), F.lit(0.0))


def features(found: DataFrame, stats: DataFrame) -> DataFrame:
    """The 17 features of each page for tree models, in fixed order; pages without lines give zeros.

    found: evidence of pages with their shape; stats: segment_stats by doc_id and page of all segments, short ones too.
    """
    wide = found.join(stats.select("doc_id", "page", "grid", "non_grid", "entropy"), ["doc_id", "page"], "left")
    values = {
        "words_per_line": F.col("words_per_line"), "text_density": F.coalesce(F.try_divide("summed_area", "extent_area"), F.lit(0.0)), "mean_left": F.col("mean_left"), "mean_right": F.col("mean_right"), "text_width": F.col("text_width"), "line_count": F.col("n_lines").cast("double"),
        "line_length_variance": F.col("line_length_variance"), "indent_std": F.col("indent_std"), "punctuation_per_line": F.col("punctuation_per_line"), "capital_ratio": F.col("capital_ratio"), "has_sidebar": (F.col("n_sidebars") > 0).cast("double"), "has_bore_keyword": F.col("bore_keyword").cast("double"),
        "description_count": F.col("n_descriptions").cast("double"), "map_keyword_lines": F.col("map_keyword_lines").cast("double"), "grid_length": F.col("grid"), "non_grid_length": F.col("non_grid"), "angle_entropy": F.col("entropy"),
    }
    return wide.select("doc_id", "page", *[F.coalesce(F.round(v, 6), F.lit(0.0)).alias(k) for k, v in values.items()])


def segment_stats(segs: DataFrame, keys: tuple[str, ...] = ("page",)) -> DataFrame:
    """Keys with n, grid, non_grid, entropy, score: one aggregation of segments by keys and angle bin, then one by keys."""
    s = segs.withColumn("length", G.segment_length(*[F.col(c) for c in ("sx", "sy", "ex", "ey")])).withColumn("angle", G.segment_angle(*[F.col(c) for c in ("sx", "sy", "ex", "ey")]))
    bins = s.groupBy(*keys, G.angle_bin(F.col("angle")).alias("bin")).agg(F.count(F.lit(1)).alias("n"), F.sum(F.when(G.is_grid(F.col("angle")), F.col("length")).otherwise(0.0)).alias("g"), F.sum(F.when(G.is_grid(F.col("angle")), 0.0).otherwise(F.col("length"))).alias("o"))
    sums = bins.groupBy(*keys).agg(F.sum("n").alias("n"), F.sum("g").alias("grid"), F.sum("o").alias("non_grid"), F.sum(F.col("n") * F.log("n")).alias("_e"))
    entropy = (F.log("n") - F.col("_e") / F.col("n")) / F.log2(F.lit(36.0))
    return sums.withColumn("entropy", entropy).withColumn("score", 0.5 * F.col("entropy") + 0.4 * F.least(F.col("non_grid") / (F.col("grid") + 1) / 10, F.lit(1.0))).drop("_e")


def long_segments(segs: DataFrame, pages: DataFrame) -> DataFrame:
    """Segments (doc_id, page, ...) longer than the page's mean font size times the root of two, where it has more than seven words; else all.

    pages: rows with lines, or their evidence.
    """
    if "lines" in pages.columns:
        words = total("lines", lambda x: x["n_words"])
        font = total("lines", lambda x: F.abs(x["y1"] - x["y0"])) / F.size("lines")
    else:
        words, font = F.col("n_words"), F.col("mean_font")
    least = pages.select("doc_id", "page", F.when(words > 7, font * 2.0**0.5).alias("_least"))
    length = G.segment_length(*[F.col(c) for c in ("sx", "sy", "ex", "ey")])
    return segs.join(least, ["doc_id", "page"]).where(F.col("_least").isNull() | (length > F.col("_least"))).drop("_least")


def is_text() -> Column:
    return (density() > 0.5) & (F.col("words_per_line") > 3)


def bore_ratio() -> Column:
    """Words of material descriptions by alphabetic words, raised where the page has a sidebar or a keyword."""
    return F.coalesce(F.try_divide("material_words", "alpha_words"), F.lit(0.0)) + F.when(F.col("n_sidebars") > 0, 0.1).otherwise(0.0) + F.when(F.col("bore_keyword"), 0.05).otherwise(0.0)


def is_boreprofile() -> Column:
    return (F.col("n_descriptions") > 0) & (bore_ratio() > 0.3)


def is_geo_profile() -> Column:
    score = F.coalesce("score", F.lit(0.0))
    return F.col("geo_keyword") | ((score > 0.15) & (score < 0.25) & (F.coalesce("n", F.lit(0)) > 500))


def map_score() -> Column:
    return F.coalesce("score", F.lit(0.0)) + F.when(F.col("map_keyword_lines") > 0, 0.05).otherwise(0.0) + F.when(F.col("map_like_ratio") > 0.75, 0.1).otherwise(0.0)


def is_title_page() -> Column:
    return F.col("is_candidate") & (F.col("centered") | F.col("aligned") | (F.col("large_font") & (F.col("clues") >= 2)))


def rules(profile: str = "dev") -> list[tuple[str, Column]]:
    """Classes and their rules, in the order in which they decide; a caller may replace or add some.

    Digital pages (column digital) are text only below an image share of 0.7, borehole profiles also by a caption below an image, or else only with
    drawings, and maps only with images or drawings.
    """
    drawn = F.col("n_drawings") > 0
    text = F.when(F.col("digital"), (F.col("image_coverage") < 0.7) & is_text()).otherwise(is_text())
    bore = F.when(F.col("digital"), ((F.size("image_boxes") > 0) & F.col("caption_keywords")) | (drawn & is_boreprofile())).otherwise(is_boreprofile())
    on_map = F.when(F.col("digital"), ((F.size("image_boxes") > 0) | drawn) & (map_score() > 0.4)).otherwise(map_score() > 0.4)
    geo = [("geo_profile", is_geo_profile())] if profile == "dev" else []
    return [("text", text), ("boreprofile", bore), *geo, ("map", on_map), ("title_page", is_title_page())]


def evidence_of(pages: DataFrame, shape: bool = False) -> DataFrame:
    """Evidence of pages with what else the rules read: digital, n_drawings and image_boxes where known, else all pages count as scanned."""
    base = pages
    for name, none in (("digital", F.lit(False)), ("n_drawings", F.lit(0)), ("image_boxes", F.expr("CAST(array() AS array<struct<x0: double, y0: double, x1: double, y1: double>>)"))):
        if name not in base.columns:
            base = base.withColumn(name, none)
    # image boxes go through the pass and stay as columns of their page
    return evidence(base.withColumn("_boxes", F.col("image_boxes")), shape=shape).withColumnRenamed("_boxes", "image_boxes")


def with_line_score(found: DataFrame, segs: DataFrame) -> DataFrame:
    """Evidence of pages with n and score of their long segments. Evidence is read twice, so it had better be stored."""
    return found.join(segment_stats(long_segments(segs, found), ("doc_id", "page")).select("doc_id", "page", "n", "score"), ["doc_id", "page"], "left")


def cascade(pages: DataFrame, segs: DataFrame | None = None, profile: str = "dev", order: list[tuple[str, Column]] | None = None, keep: tuple[str, ...] = ()) -> DataFrame:
    """doc_id, page, label: the class of the first rule that holds, else unknown; and the columns to keep.

    pages: text_pages with words and lang; digital, n_drawings and image_boxes where known; or their evidence_of, stored. segs: doc_id, page, sx, sy, ex, ey.
    """
    found = evidence_of(pages) if "lines" in pages.columns else pages
    if segs is not None:
        # pages are gone through once, whatever reads their evidence
        found = with_line_score(stored(found) if "lines" in pages.columns else found, segs)
    else:
        found = found.withColumns({"n": F.lit(None).cast("long"), "score": F.lit(None).cast("double")})
    label = F.lit("unknown")
    for name, rule in reversed(order or rules(profile)):
        label = F.when(rule, name).otherwise(label)
    return found.select("doc_id", "page", *keep, label.alias("label"))
