"""Text predicates as column expressions; every pattern means the same to other SQL engines."""

from __future__ import annotations

import functools
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

_B, _E, _W = r"(^|[^\p{L}\p{N}_])", r"($|[^\p{L}\p{N}_])", r"[\p{L}\p{N}_]"
# fixed values: patterns
CAPTION = rf"(?i)^((fig(ure)?|abb(ildung)?|tab(le)?)\.?\s*[:.]?\s*)?[0-9]{{1,2}}([.:][0-9]{{1,2}}){{0,3}}{_E}"
DATES = [rf"{_B}(jan|feb|mar|apr|may|jun|jul|aug|sep|oct|nov|dec){_W}*\s+[0-9]{{4}}{_E}", rf"{_B}[0-9]{{1,2}}[./-][0-9]{{1,2}}[./-][0-9]{{2,4}}{_E}", rf"{_B}(19[0-9]{{2}}|20[0-1][0-9]|202[0-5]){_E}"]
PHONES = [rf"{_B}(tel\.?|telefon)\s*[:\-]?\s*\+?[0-9][0-9\s/().-]{{7,}}([0-9]{_E}|[\s/().-]{_W})", rf"({_B}(0041|0)|{_W}\+41)\s?[0-9]{{2}}\s?[0-9]{{3}}\s?[0-9]{{2}}\s?[0-9]{{2}}{_E}"]
SCALES = [r"1\s*:\s*[125](25|5)?000+", r"1\s*:\s*[125]((0{1,2})?([',]000)+)"]
DEPTH = r"^-?\.?([0-9]+(\.[0-9]*)?)[müMN\\.]*$"
NONTRIVIAL = r"[\p{L}\p{Nl}\p{No}]{5,}"
NUMBER = r"^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?$"
PUNCTUATION = "[.,!?;:()\"']"


def any_of(text: Column, patterns: list[str]) -> Column:
    out = F.lit(False)
    for p in patterns:
        out = out | F.regexp_like(text, F.lit(p))
    return out


def terms_pattern(terms: list[str]) -> str:
    """One pattern that finds any of the terms; nothing, if there are none."""
    return "|".join(re.escape(t) for t in terms) if terms else r"(?!)"


def contains_any(text: Column, terms: list[str]) -> Column:
    """Whether any term is a substring, looked for in one scan of the text."""
    return F.regexp_like(text, F.lit(terms_pattern(terms))) if terms else F.lit(False)


def is_description(text: Column, lang: Column, include: dict, exclude: dict | None = None) -> Column:
    """Any included and no excluded substring of the lower-cased text, by language, German for any other."""
    low = F.lower(text)
    by = lambda terms: F.when(lang == "fr", terms_pattern(terms.get("fr", []))).when(lang == "it", terms_pattern(terms.get("it", []))).when(lang == "en", terms_pattern(terms.get("en", []))).otherwise(terms_pattern(terms.get("de", [])))
    found = F.regexp_like(low, by(include))
    return found & ~F.regexp_like(low, by(exclude)) if exclude else found


def first_match(text: Column, patterns: list[str]) -> Column:
    """What the first of the patterns that matches has found; null if none does."""
    return F.coalesce(*[F.nullif(F.regexp_extract(text, p, 0), F.lit("")) for p in patterns])


def clean_label(text: Column) -> Column:
    """Strip, lower-case, drop quotes, trailing dots, colons and spaces, then stars."""
    out = F.lower(F.trim(text))
    for pattern in ("[`\"']", r"[.:\s]+$", "[*]"):
        out = F.regexp_replace(out, pattern, "")
    return out


def clean_tokens(text: Column) -> Column:
    """Words of lines with more than four letters: longer than one character, no digit, at least one common letter."""
    lines = F.filter(F.split(text, "\n"), lambda x: F.regexp_count(x, F.lit(r"\p{L}")) > 4)
    words = F.split(F.array_join(lines, " "), r"\s+")
    return F.filter(words, lambda w: F.regexp_like(w, F.lit("^(?=.*[a-zA-Zéàèöäüç])[^0-9]{2,}$")))


def nontrivial_words(text: Column) -> Column:
    return F.regexp_count(text, F.lit(NONTRIVIAL))


def is_map_word(w: Column) -> Column:
    title = F.regexp_like(w, F.lit(r"^\p{Lu}\p{Ll}*$"))
    upper = F.regexp_like(w, F.lit(r"\p{Lu}")) & ~F.regexp_like(w, F.lit(r"[\p{Ll}\p{Lt}]"))
    return title | upper | F.regexp_like(w, F.lit(NUMBER))


_SPACES = re.compile("[^ \t\n\x0b\f\r]+")
_LONG = re.compile(r"[^\W\d_]{5,}")


def count_words(text: str | None, stops: dict[str, list[int]], n: int) -> tuple[list[int], int]:
    """How often function words of each of n languages stand on lines with more than four letters, and the number of words of five letters or more."""
    counts, long, good = [0] * n, 0, []
    for line in (text or "").split("\n"):
        runs = _LONG.findall(line)
        long += len(runs)
        if (runs and runs[0].isalpha()) or sum(map(str.isalpha, line)) > 4:
            good.append(line)
    low = " ".join(good).lower()
    for met in filter(None, map(stops.get, low.split(" ") if not any(c in low for c in "\t\x0b\f\r") else _SPACES.findall(low))):
        for k in met:
            counts[k] += 1
    return counts, long


def stop_index(stop_words: dict[str, list[str]]) -> tuple[dict[str, list[int]], int]:
    """Word -> numbers of the languages (in order of code) that have it, and the number of languages."""
    stops: dict[str, list[int]] = {}
    for k, lang in enumerate(sorted(stop_words)):
        for word in stop_words[lang]:
            stops.setdefault(word, []).append(k)
    return stops, len(stop_words)


def score_counts(df: DataFrame, stop_words: dict[str, list[str]]) -> DataFrame:
    """df with _s, up to five (lang, score), best first, in place of _met, the function words met of each language; a score is a language's share of all that were met."""
    langs = sorted(stop_words)
    total = F.aggregate("_met", F.lit(0), lambda a, x: a + x)
    scored = F.transform("_met", lambda n, i: F.struct((-F.round(n / F.col("_total"), 6)).alias("minus"), F.get(F.array(*map(F.lit, langs)), i).alias("lang")))
    best = F.transform(F.slice(F.array_sort(F.filter(scored, lambda x: x["minus"] < 0)), 1, 5), lambda x: F.struct(x["lang"].alias("lang"), (-x["minus"]).alias("score")))
    none = F.expr("CAST(array() AS array<struct<lang: string, score: double>>)")
    return df.withColumn("_total", total).withColumn("_s", F.when(F.col("_total") > 0, best).otherwise(none)).drop("_met", "_total")


def with_scores(df: DataFrame, stop_words: dict[str, list[str]], text: str = "text") -> DataFrame:
    """df without its text, with _s (language scores) and words (number of long words), counted in one pass over the text for all languages at once."""
    stops, n = stop_index(stop_words)
    names = [c for c in df.columns if c != text]

    def run(batches):
        for batch in batches:
            got = [count_words(x, stops, n) for start in range(0, len(batch), 64) for x in batch.column(text).slice(start, 64).to_pylist()]
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in names], *counts_of(got, n)], names=[*names, "_met", "words"])

    schema = T.StructType([*[df.schema[c] for c in names], T.StructField("_met", T.ArrayType(T.IntegerType())), T.StructField("words", T.IntegerType())])
    return score_counts(df.mapInArrow(run, schema), stop_words)


def counts_of(got: list[tuple[list[int], int]], n: int) -> list[pa.Array]:
    met = pa.ListArray.from_arrays(pa.array(np.arange(len(got) + 1) * n, pa.int32()), pa.array([v for c, _ in got for v in c], pa.int32()))
    return [met, pa.array([w for _, w in got], pa.int32())]


def classification_language(scores: Column, words: Column) -> Column:
    good = F.filter(scores, lambda x: (x["score"] >= 0.4) & x["lang"].isin("de", "fr", "it", "en"))
    return F.when(words < 4, "de").otherwise(F.coalesce(F.get(good, F.lit(0))["lang"], F.lit("de")))


def metadata_language(scores: Column, words: Column) -> Column:
    return F.when(words >= 4, F.get(F.filter(scores, lambda x: x["score"] >= 0.7), F.lit(0))["lang"])


def front_page(text: Column, templates: list) -> Column:
    """Whether at least 70 % of the groups of any template are found in the text.

    Of some groups of a template one must be found, as too few are left otherwise; the others are looked for only then.
    """
    has = lambda g: functools.reduce(lambda a, b: a | b, [F.contains(text, F.lit(t)) for t in g])
    out = F.lit(False)
    for groups in templates:
        wanted = -(-7 * len(groups) // 10)
        first = functools.reduce(lambda a, b: a | b, map(has, groups[: len(groups) - wanted + 1]))
        hits = sum((has(g).cast("int") for g in groups), F.lit(0))
        out = out | F.when(first, hits >= wanted).otherwise(first)
    return out
