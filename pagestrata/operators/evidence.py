"""Evidence of each page for its class, gathered in one Arrow pass over whole pages; rules on it are column expressions.

A row of the pass is a page with its lines and words. What comes out is a flat row of numbers and flags, so that neither lines nor words travel on.
"""

from __future__ import annotations

import re
from bisect import bisect_right
from itertools import accumulate

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import geometry as G
from ..functions import text as X
from ..functions import vocabulary as V
from ..sources import PAGE_HEIGHT, PAGE_WIDTH

FIELDS = [
    ("n_lines", "int"), ("n_words", "int"), ("alpha_words", "int"), ("mean_font", "double"), ("words_per_line", "double"), ("word_area", "double"), ("block_area", "double"),
    ("n_descriptions", "int"), ("material_words", "int"), ("n_sidebars", "int"), ("bore_keyword", "boolean"), ("geo_keyword", "boolean"),
    ("map_keyword_lines", "int"), ("map_entry_ratio", "double"), ("map_like_ratio", "double"),
    ("title_gap", "double"), ("is_candidate", "boolean"), ("centered", "boolean"), ("aligned", "boolean"), ("large_font", "boolean"), ("clues", "int"),
    ("summed_area", "double"), ("extent_area", "double"), ("image_coverage", "double"), ("caption_keywords", "boolean"),
]
# what feature vectors have beside
SHAPE = [(name, "double") for name in ("mean_left", "mean_right", "text_width", "line_length_variance", "indent_std", "punctuation_per_line", "capital_ratio")]
_TYPES = {"int": (T.IntegerType(), pa.int32()), "double": (T.DoubleType(), pa.float64()), "boolean": (T.BooleanType(), pa.bool_())}
_SCALES = [re.compile(p) for p in X.SCALES]
_DEPTH = re.compile(X.DEPTH)


class Terms:
    """Keywords by language: any included and no excluded one inside a lower-cased text. whole: looked for in single words, where one of two words is never found."""

    def __init__(self, include: dict, exclude: dict | None = None, whole: bool = False):
        self.include = {k: [t for t in v if not whole or " " not in t] for k, v in include.items()}
        self.exclude = exclude or {}

    def lines(self, lang: str, page: str, starts: list[int]) -> set[int]:
        """Numbers of the lines hit. page: the lower-cased lines of a page, each followed by a line feed; starts: where they begin, and the page's length."""
        found = _lines_with(self.include[lang], page, starts)
        return found - _lines_with(self.exclude.get(lang, ()), page, starts) if found else found

    def any(self, lang: str, page: str, starts: list[int]) -> bool:
        return bool(self.lines(lang, page, starts)) if self.exclude else any(t in page for t in self.include[lang])


def _lines_with(terms: list[str], page: str, starts: list[int]) -> set[int]:
    """Numbers of the lines that hold any of the terms; no term holds a line feed, so each is looked for in the whole page first."""
    found = set()
    for t in terms:
        at = page.find(t)
        while at >= 0:
            line = bisect_right(starts, at) - 1
            found.add(line)
            at = page.find(t, starts[line + 1])
    return found


_MATERIAL, _MAP, _GEO = Terms(V.MATERIAL, V.MATERIAL_NOT), Terms(V.MAP, V.MAP_NOT), Terms(V.GEO)
_BORE, _TITLE = Terms(V.BOREPROFILE, whole=True), Terms(V.TITLE, whole=True)
_EDGE = lambda p: re.compile(p.replace(r"[^\p{L}\p{N}_]", r"\W").replace(r"[\p{L}\p{N}_]", r"\w"))
_DATES, _PHONES = [_EDGE(p) for p in X.DATES], [_EDGE(p) for p in X.PHONES]
_CAPTION_LINE = _EDGE(X.CAPTION)


def is_map_word(word: str) -> bool:
    """Capitalised, upper case, or a number."""
    return (word.isalpha() and word.istitle()) or word.isupper() or bool(re.fullmatch(X.NUMBER[1:-1], word))


def depth_entries(words: list[tuple[float, float, str]]) -> list[tuple[float, float, float]]:
    """(top, left, value) of the words (top, left, text) that are depth numbers, by top."""
    found = [(y, x, m[1]) for y, x, t in words if (m := _DEPTH.match(t.strip().replace(",", ".")))]
    return sorted(((y, x, float(v)) for y, x, v in found), key=lambda e: e[0])


def sidebars(entries: list[tuple[float, float, float]]) -> list[list[float]]:
    """Values of clusters of three or more entries at one left edge that rise strictly from top to bottom."""
    clusters: dict[int, list[float]] = {}
    for c, (_, _, value) in zip(G.greedy([x for _, x, _ in entries]), entries, strict=True):
        clusters.setdefault(c, []).append(value)
    return [v for v in clusters.values() if len(v) >= 3 and all(a < b for a, b in zip(v, v[1:], strict=False))]


def map_like_ratio(entries: list[tuple[float, list[str]]], n_keywords: int) -> float:
    """Share of map-like words in small clusters of entry lines (left edge, words); 0 with fewer than seven words and no keyword line."""
    groups: dict[int, list[str]] = {}
    sizes: dict[int, int] = {}
    for c, (_, words) in zip(G.greedy([x for x, _ in entries]), entries, strict=True):
        groups.setdefault(c, []).extend(words)
        sizes[c] = sizes.get(c, 0) + 1
    words = [w for c, ws in groups.items() if sizes[c] <= 3 for w in ws]
    if not words or (len(words) < 7 and not n_keywords):
        return 0.0
    return sum(map(is_map_word, words)) / len(words)


def merge_by_top(boxes: np.ndarray) -> list[list[int]]:
    """Lines in order of top and left, in groups of lines that overlap vertically with the one before."""
    groups: list[list[int]] = []
    for i in np.lexsort((np.arange(len(boxes)), boxes[:, 0], boxes[:, 1])).tolist():
        if groups and not (boxes[groups[-1][-1], 3] < boxes[i, 1] or boxes[i, 3] < boxes[groups[-1][-1], 1]):
            groups[-1].append(i)
        else:
            groups.append([i])
    return groups


def title_evidence(boxes: np.ndarray, n_words: np.ndarray, width: float) -> tuple[float | None, bool, bool, bool]:
    """(mean gap, candidate, centered, aligned): 3 to 35 lines whose merged lines stand more than 35 points apart, a far first or last one left out."""
    if not 3 <= len(boxes) <= 35:
        return None, False, False, False
    groups = merge_by_top(boxes)
    hulls = np.array([[*boxes[g, :2].min(axis=0), *boxes[g, 2:].max(axis=0)] for g in groups])
    gaps = G.drop_outlier(np.diff(hulls[:, 1]), [0, len(groups) - 2]) if len(groups) > 1 else np.zeros(0)
    gap = float(gaps.mean()) if len(gaps) else None
    if gap is not None and gap <= 35:
        return gap, False, False, False
    widened = boxes.copy()  # the first line of a group carries the group's box from here on
    for g, hull in zip(groups, hulls, strict=True):
        widened[g[0]] = hull
    return gap, True, *G.title_layout(widened, n_words, width, np.abs(boxes[:, 3] - boxes[:, 1]))


def title_gaps(boxes: np.ndarray, page: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """(mean gap, whether there is one) of title_evidence() for each of n pages at once; lines of one page stand together."""
    order = np.lexsort((boxes[:, 0], boxes[:, 1], page))
    b, of = boxes[order], page[order]
    head = np.r_[True, (of[1:] != of[:-1]) | (b[:-1, 3] < b[1:, 1]) | (b[1:, 3] < b[:-1, 1])][: len(of)]
    top, of = b[head, 1], of[head]
    inner = of[1:] == of[:-1]
    gap, of = np.diff(top)[inner], of[1:][inner]
    count = np.bincount(of, minlength=n)
    first = np.r_[True, of[1:] != of[:-1]][: len(of)]
    last = np.r_[of[1:] != of[:-1], True][: len(of)]
    all_of = np.ones(len(of), bool)

    def mean_and_deviation(kept: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        size = np.bincount(of[kept], minlength=n)
        mean = np.bincount(of[kept], gap[kept], minlength=n) / np.maximum(size, 1)
        return mean, np.sqrt(np.bincount(of[kept], (gap[kept] - mean[of[kept]]) ** 2, minlength=n) / np.maximum(size - 1, 1))

    (mean, whole), (mean_a, a), (mean_z, z) = mean_and_deviation(all_of), mean_and_deviation(~first), mean_and_deviation(~last)
    share_a, share_z = (np.divide(d, whole, out=np.ones(n), where=whole > 0) for d in (a, z))
    drop = (count >= 3) & (whole > 0) & (np.minimum(share_a, share_z) < 0.6)
    return np.where(drop, np.where(share_a <= share_z, mean_a, mean_z), mean), count > 0


def below(boxes: np.ndarray, image: dict) -> np.ndarray:
    tall, wide = image["y1"] - image["y0"], image["x1"] - image["x0"]
    return (image["y1"] - boxes[:, 1] <= 0.25 * tall) & (boxes[:, 0] >= image["x0"] - 0.2 * wide) & (boxes[:, 2] <= image["x1"] + 0.2 * wide)


def _words_evidence(lang: str, texts: list[str], low: list[str], x0: list[float], size: list[int], small: list[int], marks: tuple, numbers: list[tuple]) -> tuple:
    """What the words of a page tell, in the order of _WORD_FIELDS. small: short lines of small blocks; marks: lines that may hold a date, or a phone."""
    page = "".join(t + "\n" for t in low)
    starts = [0, *accumulate(len(t) + 1 for t in low)]
    material = sorted(_MATERIAL.lines(lang, page, starts))
    on_map = _MAP.lines(lang, page, starts)
    if "000" in page:
        on_map |= {i for i, t in enumerate(low) if "000" in t and any(p.search(w) for w in texts[i].split(" ") for p in _SCALES)}
    entry = [i for i in small if i not in on_map]
    enough = bool(entry) and len(entry) / len(texts) > 0.5
    heard = lambda lines, patterns: any(p.search(low[i]) for i in lines for p in patterns)
    phones = [i for i in marks[2] if i in marks[1] or "tel" in low[i]]
    clues = int(_TITLE.any(lang, page, starts)) + int(heard(marks[0], _DATES)) + int(heard(phones, _PHONES))
    return (
        sum(map(str.isalpha, " ".join(texts).split(" "))), len(set(G.greedy([x0[i] for i in material]))), sum(size[i] for i in material), len(sidebars(depth_entries(numbers))) if len(numbers) >= 3 else 0,
        _BORE.any(lang, page, starts), _GEO.any(lang, page, starts), len(on_map), len(entry) / len(texts) if texts else 0.0, map_like_ratio([(x0[i], texts[i].split(" ")) for i in entry], len(on_map)) if enough else 0.0, clues,
    )


_WORD_FIELDS = ["alpha_words", "n_descriptions", "material_words", "n_sidebars", "bore_keyword", "geo_keyword", "map_keyword_lines", "map_entry_ratio", "map_like_ratio", "clues"]


def _extreme(f, values: np.ndarray, at: np.ndarray) -> np.ndarray:
    """f (np.minimum, np.maximum) of the values of each page; 0 for a page without any."""
    out, some = np.zeros(len(at) - 1), np.diff(at) > 0
    if some.any():
        out[some] = f.reduceat(values, at[:-1][some])
    return out


def _flat(column: pa.ListArray) -> tuple[np.ndarray, pa.Array]:
    """Offsets from 0 and values of a list column; a null list is empty."""
    at = column.offsets.to_numpy().astype(np.int64)
    return at - at[0], column.values.slice(at[0], at[-1] - at[0])


def _in_pages(chosen: np.ndarray, at: np.ndarray) -> list[list[int]]:
    """Numbers of chosen lines, counted within each page; chosen ascends by page."""
    cut = np.searchsorted(chosen, at).tolist()
    return [(chosen[i:j] - k).tolist() for i, j, k in zip(cut[:-1], cut[1:], at[:-1].tolist(), strict=True)]


def _columns(batch: pa.RecordBatch, width: float, height: float, shape: bool = False) -> dict[str, list | np.ndarray]:
    """FIELDS of the pages of a batch, and SHAPE if wanted. What lines' boxes tell is worked out for all pages together, what words tell page by page."""
    at, lines = _flat(batch.column("lines"))
    n, empty = len(batch), not len(lines)
    told = lines.field("text") if not empty else pa.array([], pa.string())
    texts = told.to_pylist()
    low = [t.lower() for t in texts]
    boxes = np.stack([lines.field(c).to_numpy(zero_copy_only=False).astype(float) for c in ("x0", "y0", "x1", "y1")], axis=1) if not empty else np.zeros((0, 4))
    size = lines.field("n_words").to_numpy(zero_copy_only=False).astype(np.int64) if not empty else np.zeros(0, np.int64)
    of = np.repeat(np.arange(n), np.diff(at))
    left, sizes = boxes[:, 0].tolist(), size.tolist()
    tall = np.abs(boxes[:, 3] - boxes[:, 1])
    count, each = np.diff(at), lambda v, keep=slice(None): np.bincount(of[keep], v[keep], minlength=n)
    per_line = np.maximum(count, 1)
    # words: those with digits, and the area of each line's words but the first
    word_at, words = _flat(lines.field("words")) if not empty else (np.zeros(1, np.int64), pa.array([], pa.struct([("text", pa.string()), ("x0", pa.float64()), ("x1", pa.float64())])))
    line_of = np.repeat(np.arange(len(lines)), np.diff(word_at))
    known = lines.field("others") if not empty and lines.type.get_field_index("others") >= 0 else None
    if known is not None and not known.null_count:
        rest = known.to_numpy(zero_copy_only=False) * (boxes[:, 3] - boxes[:, 1])
    else:
        wide = (words.field("x1").to_numpy(zero_copy_only=False) - words.field("x0").to_numpy(zero_copy_only=False)) if len(words) else np.zeros(0)
        first = np.zeros(len(words), bool)
        first[word_at[:-1][np.diff(word_at) > 0]] = True
        rest = np.bincount(line_of, np.where(first, 0.0, wide * (boxes[line_of, 3] - boxes[line_of, 1])), minlength=len(lines)) if len(words) else np.zeros(len(lines))
    having = lambda column, pattern: np.flatnonzero(pc.match_substring_regex(column, pattern).to_numpy(zero_copy_only=False).astype(bool))
    digits = having(words.field("text"), "[0-9]") if len(words) else np.zeros(0, np.int64)
    numbers = list(zip(boxes[line_of[digits], 1].tolist(), words.field("x0").to_numpy(zero_copy_only=False)[digits].tolist(), words.field("text").take(pa.array(digits)).to_pylist(), strict=True)) if len(digits) else []
    number_at = np.searchsorted(line_of[digits], at).tolist()
    # lines without the digits that any date or phone has are not looked at again
    dates, phones, some = (_in_pages(having(told, p), at) for p in ("[0-9]{4}|[0-9][./-][0-9]", "[0-9]{3}", "[0-9]"))
    # blocks
    block = G.paged_blocks(boxes, of)
    n_blocks = int(block.max()) + 1 if len(block) else 0
    order = np.argsort(block, kind="stable")
    head = np.searchsorted(block[order], np.arange(n_blocks))
    hulls = np.stack([f.reduceat(boxes[order, k], head) for k, f in enumerate((np.minimum, np.minimum, np.maximum, np.maximum))], axis=1) if n_blocks else np.zeros((0, 4))
    in_block = np.bincount(block, minlength=1)[block] if len(block) else block
    small = order[((in_block <= 3) & (size < 4))[order]]  # by block, so by page
    small = small[np.argsort(of[small], kind="stable")]
    small_at = np.searchsorted(of[small], np.arange(n + 1)).tolist()
    start = at.tolist()
    langs = [x if x in V.MATERIAL else "de" for x in batch.column("lang").to_pylist()]
    images = [x or [] for x in batch.column("image_boxes").to_pylist()] if "image_boxes" in batch.schema.names else [[]] * n
    several = size > 1
    gap, has_gap = title_gaps(boxes, of, n)
    may_title = (count >= 3) & (count <= 35)
    greatest = _extreme(np.maximum, tall, at)
    out: dict[str, list] = {name: [] for name in [*_WORD_FIELDS, "title_gap", "is_candidate", "centered", "aligned", "large_font", "image_coverage", "caption_keywords"]}
    for p, (a, b) in enumerate(zip(start[:-1], start[1:], strict=True)):
        lang, mine = langs[p], [i - a for i in small[small_at[p] : small_at[p + 1]].tolist()]
        found = _words_evidence(lang, texts[a:b], low[a:b], left[a:b], sizes[a:b], mine, (dates[p], set(phones[p]), some[p]), numbers[number_at[p] : number_at[p + 1]])
        for name, value in zip(_WORD_FIELDS, found, strict=True):
            out[name].append(value)
        if may_title[p] and not (has_gap[p] and gap[p] <= 35):
            title = title_evidence(boxes[a:b], size[a:b], width)
        else:
            title = (float(gap[p]) if may_title[p] else None, False, False, False)
        for name, value in zip(("title_gap", "is_candidate", "centered", "aligned"), title, strict=True):
            out[name].append(value)
        out["large_font"].append(bool(greatest[p] > 20) and len(set(tall[a:b].tolist())) > 5)
        under = np.zeros(b - a, bool)
        for image in images[p]:
            under |= below(boxes[a:b], image)
        out["caption_keywords"].append(any(_CAPTION_LINE.search(texts[i]) and all(any(t in low[i] for t in g) for g in V.CAPTION[lang]) for i in (np.flatnonzero(under) + a).tolist()))
        out["image_coverage"].append(float(sum((i["x1"] - i["x0"]) * (i["y1"] - i["y0"]) for i in images[p]) / (width * height)))
    own = (boxes[:, 2] - boxes[:, 0]) * (boxes[:, 3] - boxes[:, 1])
    sides = [_extreme(f, boxes[:, k], at) for k, f in enumerate((np.minimum, np.minimum, np.maximum, np.maximum))]
    return out | (_shape(told, boxes, size, of, n) if shape else {}) | {
        "n_lines": count, "n_words": each(size).astype(np.int64), "mean_font": each(tall) / per_line, "words_per_line": each(size) / per_line,
        "word_area": G.paged_union_area(boxes[several], of[several], n), "block_area": G.paged_union_area(hulls, of[order][head] if n_blocks else np.zeros(0, np.int64), n),
        "summed_area": each(own + rest, several), "extent_area": (sides[2] - sides[0]) * (sides[3] - sides[1]),
    }


def _shape(texts: pa.Array, boxes: np.ndarray, size: np.ndarray, of: np.ndarray, n: int) -> dict[str, np.ndarray]:
    """SHAPE of n pages from the texts, boxes and sizes of their lines; a page's text is its lines with a space between."""
    count = lambda pattern: pc.count_substring_regex(texts, pattern).to_numpy(zero_copy_only=False)
    lines = np.maximum(np.bincount(of, minlength=n), 1)
    mean = lambda v: np.bincount(of, v, minlength=n) / lines
    var = lambda v: np.maximum(mean(v * v) - mean(v) ** 2, 0.0)
    solid = np.bincount(of, pc.utf8_length(texts).to_numpy(zero_copy_only=False) - count(r"[ \t\n\x0b\f\r]"), minlength=n)
    capitals = np.bincount(of, count(r"\p{Lu}"), minlength=n)
    return dict(zip((name for name, _ in SHAPE), (mean(boxes[:, 0]), mean(boxes[:, 2]), mean(boxes[:, 2] - boxes[:, 0]), var(size.astype(float)), np.sqrt(var(boxes[:, 0])), mean(count(X.PUNCTUATION)), np.divide(capitals, solid, out=np.zeros(n), where=solid > 0)), strict=True))


def evidence(pages: DataFrame, width: float = PAGE_WIDTH, height: float = PAGE_HEIGHT, shape: bool = False) -> DataFrame:
    """All FIELDS of pages (doc_id, page, lang, lines with words, image_boxes if there are any, more columns), and their columns but lines and image_boxes.

    Of the words those with digits are read, and all for the area beside a line's first word, unless the lines tell the width of the others.
    shape: SHAPE too.
    """
    kept = [c for c in pages.columns if c not in ("lines", "image_boxes")]
    fields = [*FIELDS, *(SHAPE if shape else [])]
    schema = pa.schema([(name, _TYPES[kind][1]) for name, kind in fields])

    def run(batches):
        for batch in batches:
            for start in range(0, len(batch), 256):
                part = batch.slice(start, 256)
                made = _columns(part, width, height, shape)
                columns = [pa.array(made[f.name], f.type) for f in schema]
                yield pa.RecordBatch.from_arrays([*[part.column(c) for c in kept], *columns], names=[*kept, *schema.names])

    out = T.StructType([*[pages.schema[c] for c in kept], *[T.StructField(name, _TYPES[kind][0]) for name, kind in fields]])
    return pages.mapInArrow(run, out)


def with_language(pages: DataFrame, metadata: bool = False) -> DataFrame:
    """pages with lang: the classification language of each page's text, which picks its keywords. Counts that text_pages has made are used.

    metadata: also language, the one for a page's metadata, and words, the number of long words.
    """
    if "_met" in pages.columns:
        scored = X.score_counts(pages, V.STOP_WORDS)
    else:
        told = pages.withColumn("_text", F.array_join(F.transform("lines", lambda x: x["text"]), "\n"))
        scored = X.with_scores(told, V.STOP_WORDS, "_text")
    out = scored.withColumn("lang", X.classification_language(F.col("_s"), F.col("words")))
    return out.withColumn("language", X.metadata_language(F.col("_s"), F.col("words"))).drop("_s") if metadata else out.drop("_s", "words")
