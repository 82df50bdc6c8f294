"""Lines from words, and operators on lines as rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import text as X

PAGE = ("doc_id", "page")
SAME_LINE = 2.0


def lines_from_words(words: DataFrame) -> DataFrame:
    """doc_id, page, line_no, n_words, text, x0, y0, x1, y1, font_size from words (block_no, line_no, word_no and boxes).

    Words of one block and line are a naive line, in the order in which naive lines appear. Its first word carries its whole box, so its top is the
    naive line's least top. Going through all words of a page, a line ends where the top moves by more than two points from one word to the next; a line's
    box is that of its words, where a first word counts with the box it carries.
    """
    naive = Window.partitionBy(*PAGE, "block_no", "line_no")
    order = Window.partitionBy(*PAGE).orderBy("_from", "word_no")
    first = F.row_number().over(naive.orderBy("word_no")) == 1
    side = lambda f, c: F.when(F.col("_first"), f(c).over(naive)).otherwise(F.col(c)).alias(f"_{c}")
    # one exchange by page serves all windows and the aggregation
    carried = words.repartition(*PAGE).withColumn("_first", first).withColumn("_from", F.min("word_no").over(naive)).select("*", side(F.min, "x0"), side(F.min, "y0"), side(F.max, "x1"), side(F.max, "y1"))
    moved = F.coalesce((F.abs(F.col("_y0") - F.lag("_y0").over(order)) > SAME_LINE).cast("int"), F.lit(0))
    marked = carried.withColumn("_move", moved).withColumn("_at", F.row_number().over(order))
    numbered = marked.withColumn("line_no", F.sum("_move").over(order.rowsBetween(Window.unboundedPreceding, 0)).cast("int"))
    text = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("_at", "text"))), lambda w: w["text"]), " ")
    made = numbered.groupBy(*PAGE, "line_no").agg(F.count(F.lit(1)).cast("int").alias("n_words"), text.alias("text"), F.min("_x0").alias("x0"), F.min("_y0").alias("y0"), F.max("_x1").alias("x1"), F.max("_y1").alias("y1"))
    return made.withColumn("font_size", F.abs(F.col("y1") - F.col("y0")))


def merged_lines(lines: DataFrame) -> DataFrame:
    """doc_id, page, merged, n_lines, x0, y0, x1, y1: lines by top and left, merged with the line before while the two overlap vertically."""
    order = Window.partitionBy(*PAGE).orderBy("y0", "x0", "lno")
    apart = F.coalesce(((F.lag("y1").over(order) < F.col("y0")) | (F.col("y1") < F.lag("y0").over(order))).cast("int"), F.lit(0))
    grouped = lines.withColumn("_apart", apart).withColumn("merged", F.sum("_apart").over(order.rowsBetween(Window.unboundedPreceding, 0)).cast("int"))
    return grouped.groupBy(*PAGE, "merged").agg(F.count(F.lit(1)).cast("int").alias("n_lines"), F.min("x0").alias("x0"), F.min("y0").alias("y0"), F.max("x1").alias("x1"), F.max("y1").alias("y1"))


def below_image(lines: DataFrame, images: DataFrame) -> DataFrame:
    """Lines that stand directly below an image of their page: not above the last quarter of it, and at most a fifth of its width beyond its sides."""
    i = images.select(*PAGE, *[F.col(c).alias(f"_{c}") for c in ("x0", "y0", "x1", "y1")])
    tall, wide = F.col("_y1") - F.col("_y0"), F.col("_x1") - F.col("_x0")
    near = (F.col("_y1") - F.col("y0") <= 0.25 * tall) & (F.col("x0") >= F.col("_x0") - 0.2 * wide) & (F.col("x1") <= F.col("_x1") + 0.2 * wide)
    keyed = [lines[c] == i[c] for c in PAGE]
    return lines.join(i, [*keyed, near], "left_semi")


def captions(lines: DataFrame, images: DataFrame) -> DataFrame:
    """Lines below an image whose text begins as a caption does."""
    return below_image(lines.where(X.any_of(F.col("text"), [X.CAPTION])), images)


def class_of_one_hot(classes: dict[str, Column] | list[str]) -> Column:
    """The first class set to 1; unknown if none is."""
    pairs = classes.items() if isinstance(classes, dict) else [(c, F.col(c)) for c in classes]
    return F.coalesce(*[F.when(v == 1, c) for c, v in pairs], F.lit("unknown"))


def trimmed_gaps(lines: DataFrame, ratio: float = 0.6) -> DataFrame:
    """doc_id, page, mean_gap: the mean of gaps between tops of successive lines, without the first or last gap if that leaves less than `ratio` of their sample deviation.

    Deviations without one value follow from count, sum and sum of squares, so one aggregation does.
    """
    gap = F.lead("y0").over(Window.partitionBy(*PAGE).orderBy("lno")) - F.col("y0")
    each = lines.select(*PAGE, "lno", gap.alias("g")).where("g IS NOT NULL")
    s = each.groupBy(*PAGE).agg(F.count("g").alias("n"), F.sum("g").alias("s"), F.sum(F.col("g") * F.col("g")).alias("q"), F.min_by("g", "lno").alias("a"), F.max_by("g", "lno").alias("z"))
    spread = lambda q, t, n: F.sqrt(F.greatest(q - t * t / n, F.lit(0.0)) / F.greatest(n - 1, F.lit(1)))
    n, t, q = F.col("n"), F.col("s"), F.col("q")
    few = F.greatest(n - 1, F.lit(1))
    without = lambda c: spread(q - F.col(c) * F.col(c), t - F.col(c), few)
    d = s.withColumns({"sd": spread(q, t, n), "sa": without("a"), "sz": without("z")})
    may = (n >= 3) & (F.col("sd") > 0)
    mean = F.when(may & (F.col("sa") < ratio * F.col("sd")) & (F.col("sa") <= F.col("sz")), (t - F.col("a")) / few).when(may & (F.col("sz") < ratio * F.col("sd")), (t - F.col("z")) / few).otherwise(t / n)
    return d.select(*PAGE, F.round(mean, 6).alias("mean_gap"))
