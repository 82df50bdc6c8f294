"""Sources of pages, segments, labels and files."""

from __future__ import annotations

import logging
import re
from collections.abc import Callable
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.text import count_words, counts_of, stop_index

log = logging.getLogger(__name__)

WORDS_PER_LINE, LINES_PER_PAGE, INDENT, PAGE_WIDTH, PAGE_HEIGHT = 12, 40, 20.0, 612.0, 792.0
_registry: dict[str, Callable[..., DataFrame]] = {}


def register_source(name: str, reader: Callable[..., DataFrame]) -> None:
    """Plug in a reader (PDF, OCR, segment detector) that gives one of the contract tables."""
    _registry[name] = reader


def read_source(name: str, spark: SparkSession, *args, **options) -> DataFrame:
    if name not in _registry:
        raise ValueError(f"no source of that name: {name}")
    return _registry[name](spark, *args, **options)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def pdf_files(spark: SparkSession, path: str) -> DataFrame:
    """path, length, content of PDF files below a folder, or of one file; upper and lower case suffixes. Any other path gives an error in the log and no rows."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    store = where.getFileSystem(spark._jsc.hadoopConfiguration())
    folder = store.exists(where) and store.getFileStatus(where).isDirectory()
    if not folder and not (store.exists(where) and path.lower().endswith(".pdf")):
        log.error("neither a folder nor a PDF file: %s", path)
        return spark.createDataFrame([], "path string, modificationTime timestamp, length long, content binary")
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true")
    return (files.option("pathGlobFilter", "*.[pP][dD][fF]") if folder else files).load(path)


def is_digital(boxlog: Column) -> Column:
    """Whether a page's log of boxes (type, x0, y0, x1, y1) holds a filled or stroked text box that is not empty."""
    return F.coalesce(F.exists(boxlog, lambda b: b["type"].isin("fill-text", "stroke-text") & (b["x1"] > b["x0"]) & (b["y1"] > b["y0"])), F.lit(False))


def rotate(box: Column, matrix: Column) -> Column:
    """A box under an affine map (a, b, c, d, e, f), as the box around its corners."""
    x = [matrix["a"] * box[p] + matrix["c"] * box[q] + matrix["e"] for p, q in (("x0", "y0"), ("x0", "y1"), ("x1", "y0"), ("x1", "y1"))]
    y = [matrix["b"] * box[p] + matrix["d"] * box[q] + matrix["f"] for p, q in (("x0", "y0"), ("x0", "y1"), ("x1", "y0"), ("x1", "y1"))]
    return F.struct(F.least(*x).alias("x0"), F.least(*y).alias("y0"), F.greatest(*x).alias("x1"), F.greatest(*y).alias("y1"))


def page_graphics(pages: DataFrame) -> DataFrame:
    """pages (digital, drawings, images array of (xref, rotation, places array of boxes), matrix) with n_drawings and one flat list of image boxes, of digital pages only.

    Boxes of images on rotated pages go through the page's matrix.
    """
    boxes = F.flatten(F.transform("images", lambda i: F.transform(i["places"], lambda b: F.when(i["rotation"] != 0, rotate(b, F.col("matrix"))).otherwise(F.struct(*[b[c].alias(c) for c in ("x0", "y0", "x1", "y1")])))))
    none = F.expr("CAST(array() AS array<struct<x0: double, y0: double, x1: double, y1: double>>)")
    return pages.withColumn("n_drawings", F.when(F.col("digital"), F.size("drawings")).otherwise(0)).withColumn("image_boxes", F.when(F.col("digital"), F.coalesce(boxes, none)).otherwise(none))


def content_box(box: Column, page: Column, dpi: float = 150.0) -> Column:
    """A pixel box at dpi in points; the page's box where none was found."""
    return F.when(box.isNotNull(), F.struct(*[(box[c] * 72 / dpi).alias(c) for c in ("x0", "y0", "x1", "y1")])).otherwise(page)


def object_listing(spark: SparkSession, prefix: str, n: int, seed: int = 42) -> DataFrame:
    """path, length of at most n PDF objects below a prefix of any store that Hadoop reads, by a seeded hash of the path."""
    found = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.[pP][dD][fF]").load(prefix).select("path", "length")
    return found.orderBy(F.xxhash64("path", F.lit(seed)), "path").limit(n)


def layout_samples(pages: DataFrame, labels: DataFrame | None = None, prepare: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
    """words, bboxes (0 to 1000 of the page's size), image, label of each page for layout models; a missing label stays null.

    pages: filename, page, words array of (text, x0, y0, x1, y1), image binary, width, height. prepare: a step on the samples.
    """
    side = lambda v, size: F.greatest(F.lit(0), (F.lit(1000) * v / F.col(size)).cast("int"))
    boxes = F.transform("words", lambda w: F.array(side(w["x0"], "width"), side(w["y0"], "height"), side(w["x1"], "width"), side(w["y1"], "height")))
    out = pages.select("filename", "page", F.transform("words", lambda w: w["text"]).alias("words"), boxes.alias("bboxes"), "image")
    out = out.join(labels.select("filename", "page", F.col("label")), ["filename", "page"], "left") if labels is not None else out.withColumn("label", F.lit(None).cast("int"))
    return prepare(out) if prepare else out


def labelled_keys(truth: DataFrame, classes: list[str]) -> DataFrame:
    """filename, page, label (number of the class) of the classes set to 1 in truth (filename, page, label, value); an unknown name raises."""
    names = F.array(*map(F.lit, classes))
    place = F.array_position(names, F.col("label"))
    number = F.when(place > 0, place - 1).otherwise(F.raise_error(F.concat(F.lit("no such class: "), F.col("label"))))
    return truth.where("value = 1").select("filename", "page", number.cast("int").alias("label"))


def classified_files(files: DataFrame, classes: list[str]) -> DataFrame:
    """filename, label from path: files in a folder named as a class; other folders are skipped."""
    parts = F.split("path", "/")
    return files.select(F.element_at(parts, -1).alias("filename"), F.element_at(parts, -2).alias("label")).where(F.col("label").isin(classes))


def ground_truth(spark: SparkSession, path: str) -> DataFrame:
    """filename, page, label, value from a JSON list of documents."""
    schema = "filename string, metadata struct<page_count: int, languages: array<string>>, pages array<struct<page: int, classification: map<string, int>, metadata: struct<language: string, is_frontpage: boolean>>>"
    docs = spark.read.option("multiLine", "true").schema(schema).json(path)
    pages = docs.select("filename", F.explode("pages").alias("p"))
    return pages.select("filename", F.col("p.page").alias("page"), F.explode("p.classification").alias("label", "value"))


def read_params(path: str) -> dict:
    """Parameters of a YAML file, on the driver."""
    import yaml

    return yaml.safe_load(Path(path).read_text())


_WORD = re.compile("[^ \t\n\x0b\f\r]+")
_DIGIT = re.compile("[0-9]")
_WORD_TYPE = pa.struct([("text", pa.string()), ("x0", pa.float64()), ("x1", pa.float64())])
LINES = "array<struct<lno: int, par: int, seg: int, n_words: int, text: string, x0: double, y0: double, x1: double, y1: double, others: double, words: array<struct<text: string, x0: double, x1: double>>>>"
SLICE_LINES = 4096


class _Lines:
    """Laid-out lines of successive pages, given out as one Arrow batch and forgotten."""

    def __init__(self, names: list[str], words: bool | str, stops: tuple | None):
        self.names, self.words, self.stops = names, words, stops
        self.clear()

    def clear(self) -> None:
        self.doc, self.page, self.lines_of = [], [], [0]
        self.lno, self.par, self.seg, self.told, self.size, self.y0, self.texts = [], [], [], [], [], [], []

    def word_lists(self, left: np.ndarray, n: np.ndarray, told: pa.Array) -> tuple[pa.Array, pa.Array]:
        """others and words of each line."""
        if not self.words:
            return pa.nulls(len(told), pa.float64()), pa.nulls(len(told), pa.list_(_WORD_TYPE))
        wide = np.fromiter(map(len, self.texts), np.int64, len(self.texts))
        off = np.cumsum(wide + 1) - wide - 1
        first = np.cumsum(n) - n
        x0 = left.repeat(n) + 6.0 * (off - np.repeat(off[first], n)) if len(wide) else np.zeros(0)
        others = 6.0 * (np.add.reduceat(wide, first) - wide[first]) if len(wide) else np.zeros(0)
        chosen, of = np.arange(len(wide)), n
        if self.words == "digits":
            with_digit = pc.match_substring_regex(told, "[0-9]").to_numpy(zero_copy_only=False).astype(bool)
            line_of = np.repeat(np.arange(len(n)), n)
            chosen = np.array([i for i in np.flatnonzero(with_digit[line_of]).tolist() if _DIGIT.search(self.texts[i])], np.int64)
            of = np.bincount(line_of[chosen], minlength=len(n))
        texts = self.texts if self.words != "digits" else [self.texts[i] for i in chosen.tolist()]
        boxes = pa.StructArray.from_arrays([pa.array(texts, pa.string()), pa.array(x0[chosen], pa.float64()), pa.array(x0[chosen] + 6.0 * wide[chosen], pa.float64())], fields=list(_WORD_TYPE))
        return pa.array(others, pa.float64()), pa.ListArray.from_arrays(pa.array(np.r_[0, np.cumsum(of)], pa.int32()), boxes)

    def batch(self, kept: list[pa.Array]) -> pa.RecordBatch:
        left, top, n, told = 50.0 + INDENT * (np.array(self.par, np.int64) % 3), np.array(self.y0), np.array(self.size, np.int64), pa.array(self.told, pa.string())
        right = left + 6.0 * np.fromiter(map(len, self.told), np.int64, len(self.told))
        columns = [pa.array(self.lno, pa.int32()), pa.array(self.par, pa.int32()), pa.array(self.seg, pa.int32()), pa.array(n, pa.int32()), told, *[pa.array(v, pa.float64()) for v in (left, top, right, top + 10.0)], *self.word_lists(left, n, told)]
        made = pa.StructArray.from_arrays(columns, names=["lno", "par", "seg", "n_words", "text", "x0", "y0", "x1", "y1", "others", "words"])
        doc, stops = pa.array(self.doc, pa.int64()), self.stops
        more = counts_of([count_words("\n".join(self.told[a:b]), *stops) for a, b in zip(self.lines_of[:-1], self.lines_of[1:], strict=True)], stops[1]) if stops else []
        out = pa.RecordBatch.from_arrays([*[c.take(doc) for c in kept], pa.array(self.page, pa.int32()), pa.ListArray.from_arrays(pa.array(self.lines_of, pa.int32()), made), *more], names=[*self.names, "page", "lines", *(["_met", "words"] if stops else [])])
        self.clear()
        return out


def _lay_out(names: list[str], words: bool | str, stops: tuple | None = None):
    def run(batches):
        for batch in batches:
            kept, made = [batch.column(c) for c in names], _Lines(names, words, stops)
            for start in range(0, len(batch), 64):
                for d, text in enumerate(batch.column("text").slice(start, 64).to_pylist(), start):
                    at, gap = 0, 0.0
                    cut = str.split if text and text.isascii() and not any(c in text for c in "\x1c\x1d\x1e\x1f") else _WORD.findall
                    for p, line in enumerate((text or "").split("\n")):
                        found = cut(line)
                        for s in range(0, len(found), WORDS_PER_LINE):
                            k = at % LINES_PER_PAGE
                            if not k:
                                if len(made.told) >= SLICE_LINES:  # what is made of a batch never stands in memory at once
                                    yield made.batch(kept)
                                gap = 0.0
                                made.doc.append(d)
                                made.page.append(at // LINES_PER_PAGE + 1)
                                made.lines_of.append(made.lines_of[-1])
                            elif not s and p:
                                gap += 30.0
                            made.lines_of[-1] += 1
                            part = found[s : s + WORDS_PER_LINE]
                            made.lno.append(k)
                            made.par.append(p)
                            made.seg.append(s // WORDS_PER_LINE)
                            made.told.append(" ".join(part))
                            made.size.append(len(part))
                            made.y0.append(60.0 + 14.0 * k + gap)
                            if words:
                                made.texts += part
                            at += 1
            yield made.batch(kept)

    return run


def text_pages(docs: DataFrame, words: bool | str = False, keep: tuple[str, ...] = (), stop_words: dict[str, list[str]] | None = None) -> DataFrame:
    """doc_id, page, lines (and the columns to keep): a fixed layout of plain texts, one row a page, in one Arrow pass without a shuffle.

    Paragraphs are the text's lines; twelve words a line, forty lines a page; six points a character; a paragraph gap of 30 points; paragraphs are
    indented by 0, 20, 40 points in turn. words: whether lines hold their words with boxes, else null; "digits": those with a digit only, which is what evidence
    reads of them beside others, the width of all words of a line but its first. stop_words: adds _met and words, what language
    scores are made of, in the same pass. Null and blank texts have no pages.
    """
    names = ["doc_id", *keep]
    schema = T.StructType([*[docs.schema[c] for c in names], T.StructField("page", T.IntegerType()), T.StructField("lines", T._parse_datatype_string(LINES)), *([T.StructField("_met", T.ArrayType(T.IntegerType())), T.StructField("words", T.IntegerType())] if stop_words else [])])
    return docs.select(*names, "text").mapInArrow(_lay_out(names, words, stop_index(stop_words) if stop_words else None), schema)


def page_words(pages: DataFrame) -> DataFrame:
    """doc_id, page, block_no, line_no, word_no (in reading order), text, x0, y0, x1, y1 of pages with words: what a word source gives.

    Words of a line jitter by up to a point; from the seventh on they are three points lower on every line whose segment number leaves 2 modulo 5.
    """
    each = pages.select("doc_id", "page", F.explode("lines").alias("l")).select("doc_id", "page", "l.par", "l.seg", "l.lno", "l.y0", F.posexplode("l.words").alias("k", "w"))
    low = F.col("y0") + 0.5 * (F.col("k") % 3) + F.when((F.col("seg") % 5 == 2) & (F.col("k") >= 6), 3.0).otherwise(0.0)
    return each.select("doc_id", "page", F.col("par").alias("block_no"), F.col("seg").alias("line_no"), (F.col("lno") * WORDS_PER_LINE + F.col("k")).alias("word_no"), F.col("w.text").alias("text"), F.col("w.x0").alias("x0"), low.alias("y0"), F.col("w.x1").alias("x1"), (low + 10).alias("y1"))


def page_lines(pages: DataFrame) -> DataFrame:
    """One row a line."""
    return pages.select("doc_id", "page", F.explode("lines").alias("l")).select("doc_id", "page", "l.*")


def segments(vectors: DataFrame) -> DataFrame:
    """page, vec_id, seg, sx, sy, ex, ey (whole numbers, cut off towards zero): four components of a vector a segment; the label is the page."""
    at = lambda i, k: F.get("embedding", i * 4 + k)
    point = lambda c: (F.signum(c) * F.floor(F.abs(c.cast("double") * 100))).cast("double")
    parts = F.transform(F.sequence(F.lit(0), (F.floor(F.size("embedding") / 4) - 1).cast("int")), lambda i: F.struct(i.alias("seg"), *[point(at(i, k)).alias(n) for k, n in enumerate(("sx", "sy", "ex", "ey"))]))
    return vectors.where("size(embedding) >= 4").select(F.col("label").alias("page"), "vec_id", F.explode(parts).alias("s")).select("page", "vec_id", "s.*")


def page_meta(pages: DataFrame) -> DataFrame:
    """pages with digital, n_drawings and image_boxes by rules on doc_id that stand in for what a PDF reader gives."""
    box = F.struct(F.lit(0.0).alias("x0"), F.lit(0.0).alias("y0"), F.lit(PAGE_WIDTH).alias("x1"), (150.0 * F.pmod("doc_id", F.lit(8))).alias("y1"))
    none = F.expr("CAST(array() AS array<struct<x0: double, y0: double, x1: double, y1: double>>)")
    return pages.withColumns({"digital": F.pmod("doc_id", F.lit(2)) == 0, "n_drawings": F.pmod("doc_id", F.lit(3)).cast("int"), "image_boxes": F.when(F.pmod("doc_id", F.lit(4)) == 0, F.array(box)).otherwise(none)})


def page_segments(vectors: DataFrame) -> DataFrame:
    """segments() by doc_id and page: those of label n belong to page 1 of document -n - 1."""
    return segments(vectors).select((-F.col("page") - 1).cast("long").alias("doc_id"), F.lit(1).alias("page"), "vec_id", "seg", "sx", "sy", "ex", "ey")


def evaluation_pair(docs: DataFrame, labels: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(predictions, truth): filename, page, label from text lengths and from label rows."""
    name = F.concat(F.lit("doc_"), F.col("doc_id").cast("string"))
    predicted = F.when(F.col("n_chars") >= 2000, "text").when(F.col("n_chars") >= 500, "map").when(F.col("n_chars") >= 100, "title_page").otherwise("unknown")
    true = F.when((F.col("quality") == 1) & (F.col("toxic") == 0), "text").when(F.col("quality") == 1, "map").when(F.col("toxic") == 1, "title_page").otherwise("unknown")
    return docs.select(name.alias("filename"), F.lit(1).alias("page"), predicted.alias("label")), labels.select(name.alias("filename"), F.lit(1).alias("page"), true.alias("label"))
