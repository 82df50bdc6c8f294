"""All registered queries of page analytics and their SQL counterparts; the SQL runs over the same whole tables."""

from __future__ import annotations

import functools

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .functions import geometry as G
from .functions import text as X
from .functions import vocabulary as V
from .operators import evidence as E
from .operators import labels as L
from .operators import lines as W
from .operators import pages as P
from .shipping import ship
from .sources import content_box, evaluation_pair, is_digital, page_lines, page_meta, page_segments, page_words, rotate, segments, table, text_pages
from .sources.samples import SAMPLES, samples
from .storage import stored

QUERIES: dict = {}
ORACLES: dict = {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return add


def _docs(spark, sf_dir):
    ship(spark)
    return table(spark, sf_dir, "documents")


def _spread(df: DataFrame) -> DataFrame:
    """One small file would be one task; work on texts is worth a shuffle of them unless the scan has tasks enough."""
    spark = df.sparkSession
    wanted = spark.sparkContext.defaultParallelism
    size = int(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())
    return df.repartition(wanted) if size < wanted * (16 << 20) else df


def _corpus(spark, sf_dir) -> DataFrame:
    """doc_id, text, lang of all documents and the sample pages."""
    return _spread(_docs(spark, sf_dir).select("doc_id", "text", "lang")).union(samples(spark).coalesce(1))


def _pages(spark, sf_dir, words: bool = False, keep: tuple = (), stop_words: dict | None = None) -> DataFrame:
    return text_pages(_corpus(spark, sf_dir), words, keep, stop_words)


def _quoted(x: str) -> str:
    return "'" + x.replace("'", "''") + "'"


def _lines(spark, sf_dir) -> DataFrame:
    """doc_id, page, lno, text of all lines."""
    return page_lines(_pages(spark, sf_dir)).select("doc_id", "page", "lno", "text")


_CORPUS = "corpus AS (SELECT doc_id, text, lang FROM documents UNION ALL SELECT * FROM (VALUES " + ", ".join(f"({d}, {_quoted(t)}, {_quoted(x) if x else 'NULL'})" for d, t, x in SAMPLES) + ") v(doc_id, text, lang))"
_WORDS = _CORPUS + r""", toks AS (SELECT doc_id, par, unnest(ws) AS word, generate_subscripts(ws, 1) - 1 AS wi FROM (SELECT doc_id, par, regexp_extract_all(ptext, '\S+') AS ws
 FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS ptext, generate_subscripts(string_split(text, chr(10)), 1) - 1 AS par FROM corpus))),
seg AS (SELECT *, wi // 12 AS seg, sum(length(word) + 1) OVER (PARTITION BY doc_id, par, wi // 12 ORDER BY wi) - length(word) - 1 AS off FROM toks),
lin0 AS (SELECT doc_id, par, seg, string_agg(word, ' ' ORDER BY wi) AS text, count(*) AS n_words, row_number() OVER (PARTITION BY doc_id ORDER BY par, seg) - 1 AS gl FROM seg GROUP BY doc_id, par, seg),
lin1 AS (SELECT *, CAST(gl // 40 + 1 AS INTEGER) AS page, CAST(gl % 40 AS INTEGER) AS lno, 50 + 20 * (par % 3) AS left0 FROM lin0),
lin2 AS (SELECT *, 30.0 * (sum(CASE WHEN seg = 0 AND par > 0 AND lno > 0 THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id, page ORDER BY lno)) AS gap FROM lin1),
lin AS (SELECT doc_id, page, lno, par, seg, text, CAST(n_words AS INTEGER) AS n_words, left0::DOUBLE AS x0, (60 + 14 * lno + gap)::DOUBLE AS y0, (left0 + 6 * length(text))::DOUBLE AS x1, (70 + 14 * lno + gap)::DOUBLE AS y1 FROM lin2),
wd AS (SELECT l.doc_id, l.page, CAST(l.par AS INTEGER) AS block_no, CAST(l.seg AS INTEGER) AS line_no, CAST(l.lno * 12 + s.wi % 12 AS INTEGER) AS word_no, s.word AS text, (l.x0 + 6 * s.off)::DOUBLE AS x0,
 (l.y0 + 0.5 * (s.wi % 12 % 3) + CASE WHEN l.seg % 5 = 2 AND s.wi % 12 >= 6 THEN 3.0 ELSE 0.0 END)::DOUBLE AS y0, (l.x0 + 6 * (s.off + length(s.word)))::DOUBLE AS x1, l.lno FROM seg s JOIN lin l USING (doc_id, par, seg))"""
_TL = _WORDS + ", tl AS (SELECT doc_id, page, lno, text FROM lin)"
_BLK = _WORDS + """, b0 AS (SELECT *, CASE WHEN y0 - lag(y1) OVER (PARTITION BY doc_id, page ORDER BY lno) < 15 THEN 0 ELSE 1 END AS br FROM lin),
b1 AS (SELECT *, sum(br) OVER (PARTITION BY doc_id, page ORDER BY lno) - 1 AS block FROM b0)"""
# lines out of words: naive lines, the box that a first word carries, breaks where the top moves
_LW = _WORDS + """, w1 AS (SELECT *, y0 + 10 AS y1, row_number() OVER (PARTITION BY doc_id, page, block_no, line_no ORDER BY word_no) = 1 AS head, min(word_no) OVER (PARTITION BY doc_id, page, block_no, line_no) AS first_no,
 min(x0) OVER n AS nx0, min(y0) OVER n AS ny0, max(x1) OVER n AS nx1, max(y0 + 10) OVER n AS ny1 FROM wd WINDOW n AS (PARTITION BY doc_id, page, block_no, line_no)),
w2 AS (SELECT doc_id, page, text, first_no, word_no, CASE WHEN head THEN nx0 ELSE x0 END AS x0, CASE WHEN head THEN ny0 ELSE y0 END AS y0, CASE WHEN head THEN nx1 ELSE x1 END AS x1, CASE WHEN head THEN ny1 ELSE y1 END AS y1 FROM w1),
w3 AS (SELECT *, CASE WHEN abs(y0 - lag(y0) OVER o) > 2.0 THEN 1 ELSE 0 END AS moved FROM w2 WINDOW o AS (PARTITION BY doc_id, page ORDER BY first_no, word_no)),
w4 AS (SELECT *, sum(moved) OVER (PARTITION BY doc_id, page ORDER BY first_no, word_no) AS line FROM w3),
lw AS (SELECT doc_id, page, CAST(line AS INTEGER) AS line_no, CAST(count(*) AS INTEGER) AS n_words, string_agg(text, ' ' ORDER BY first_no, word_no) AS text, min(x0) AS x0, min(y0) AS y0, max(x1) AS x1, max(y1) AS y1 FROM w4 GROUP BY doc_id, page, line)"""


@query(f"WITH {_WORDS} SELECT doc_id, page, block_no, line_no, word_no, text, x0, y0, x1, y0 + 10 AS y1 FROM wd")
def words_layout(spark: SparkSession, sf_dir: str) -> DataFrame:
    return page_words(_pages(spark, sf_dir, words=True))


@query(f"WITH {_LW} SELECT *, y1 - y0 AS font_size FROM lw")
def lines_rebuild(spark, sf_dir):
    """Lines made of the words of words_layout."""
    return W.lines_from_words(words_layout(spark, sf_dir))


@query(f"WITH {_LW}, m0 AS (SELECT *, CASE WHEN lag(y1) OVER o < y0 OR y1 < lag(y0) OVER o THEN 1 ELSE 0 END AS apart FROM lw WINDOW o AS (PARTITION BY doc_id, page ORDER BY y0, x0, line_no)), m1 AS (SELECT *, sum(apart) OVER (PARTITION BY doc_id, page ORDER BY y0, x0, line_no) AS merged FROM m0) SELECT doc_id, page, CAST(merged AS INTEGER) AS merged, CAST(count(*) AS INTEGER) AS n_lines, min(x0) AS x0, min(y0) AS y0, max(x1) AS x1, max(y1) AS y1 FROM m1 GROUP BY doc_id, page, merged")
def merged_y_lines(spark, sf_dir):
    return W.merged_lines(lines_rebuild(spark, sf_dir).withColumnRenamed("line_no", "lno"))


@query(f"WITH {_WORDS} SELECT doc_id, page, min(x0) AS x0, min(y0) AS y0, max(x1) AS x1, max(y1) AS y1 FROM lin GROUP BY ALL")
def page_extent(spark, sf_dir):
    return P.extent(_pages(spark, sf_dir))


@query(f"""WITH RECURSIVE {_WORDS}, ed AS (SELECT a.doc_id, a.page, a.lno AS a, b.lno AS b FROM lin a JOIN lin b ON a.doc_id = b.doc_id AND a.page = b.page AND a.lno <> b.lno AND a.x0 < b.x1 AND b.x0 < a.x1 AND a.y0 - 15 < b.y1 AND b.y0 < a.y1 + 15 AND a.lno < b.lno),
eb AS (SELECT * FROM ed UNION ALL SELECT doc_id, page, b, a FROM ed),
re(doc_id, page, lno, reached) AS (SELECT doc_id, page, lno, lno FROM lin UNION SELECT re.doc_id, re.page, re.lno, eb.b FROM re JOIN eb ON eb.doc_id = re.doc_id AND eb.page = re.page AND eb.a = re.reached),
co AS (SELECT doc_id, page, lno, min(reached) AS root FROM re GROUP BY ALL),
cn AS (SELECT doc_id, page, lno, CAST(dense_rank() OVER (PARTITION BY doc_id, page ORDER BY root) - 1 AS INTEGER) AS block FROM co)
SELECT doc_id, page, block, CAST(count(*) AS INTEGER) AS n_lines, min(x0) AS x0, min(y0) AS y0, max(x1) AS x1, max(y1) AS y1 FROM lin JOIN cn USING (doc_id, page, lno) GROUP BY doc_id, page, block""")
def text_blocks(spark, sf_dir):
    return P.block_rows(_pages(spark, sf_dir))


@query(f"""WITH {_WORDS}, k AS (SELECT doc_id, page, list(x1 ORDER BY lno) AS ks FROM lin GROUP BY ALL),
f AS (SELECT doc_id, page, ks, list_reduce(ks, lambda a, x: CASE WHEN len(list_filter(a, lambda f: abs(f - x) <= 10)) > 0 THEN a ELSE list_append(a, x) END, CAST([] AS DOUBLE[])) AS fs FROM k)
SELECT doc_id, page, len(fs)::INTEGER AS n_clusters, array_to_string(list_transform(ks, lambda x: list_position(list_transform(fs, lambda f: abs(f - x) <= 10), true) - 1), ',') AS clusters FROM f""")
def greedy_clusters_x1(spark, sf_dir):
    """Lines of each page by right edge."""
    c = _pages(spark, sf_dir).select("doc_id", "page", G.greedy_clusters(F.transform("lines", lambda x: x["x1"])).alias("c"))
    return c.select("doc_id", "page", (F.array_max("c") + 1).cast("int").alias("n_clusters"), F.array_join(F.transform("c", lambda x: x.cast("string")), ",").alias("clusters"))


@query(r"SELECT doc_id, CAST(len(regexp_extract_all(text, '[\p{L}\p{Nl}\p{No}]{5,}')) AS INTEGER) AS n FROM documents")
def nontrivial_word_count(spark, sf_dir):
    return _docs(spark, sf_dir).select("doc_id", X.nontrivial_words(F.col("text")).alias("n"))


_CLEAN = r"""list_filter(regexp_split_to_array(array_to_string(list_filter(string_split(text, chr(10)), lambda x: len(regexp_extract_all(x, '\p{L}')) > 4), ' '), '\s+'), lambda w: length(w) > 1 AND NOT regexp_matches(w, '[0-9]') AND regexp_matches(w, '[a-zA-Zéàèöäüç]'))"""


@query(f"SELECT doc_id, CAST(len(t) AS INTEGER) AS n, array_to_string(t, ' ') AS tokens FROM (SELECT doc_id, {_CLEAN} AS t FROM documents)")
def clean_text_tokens(spark, sf_dir):
    t = X.clean_tokens(F.col("text"))
    return _spread(_docs(spark, sf_dir).select("doc_id", "text")).select("doc_id", F.size(t).alias("n"), F.array_join(t, " ").alias("tokens"))


def _line_query(name: str, condition: str, column) -> None:
    def run(spark, sf_dir):
        return _lines(spark, sf_dir).where(column(F.col("text"))).select("doc_id", "page", "lno", "text")

    run.__name__ = name
    query(f"WITH {_TL} SELECT doc_id, page, lno, text FROM tl WHERE {condition}")(run)


def _matches(patterns: list[str], text: str = "lower(text)") -> str:
    return "(" + " OR ".join(f"regexp_matches({text}, {_quoted(p)})" for p in patterns) + ")"


def _contains(terms: list[str], text: str = "lower(text)") -> str:
    return "(" + (" OR ".join(f"contains({text}, {_quoted(t)})" for t in terms) or "false") + ")"


def _any(columns):
    return functools.reduce(lambda a, b: a | b, columns)


def _all(columns):
    return functools.reduce(lambda a, b: a & b, columns)


_line_query("caption_lines", _matches([X.CAPTION], "text"), lambda t: X.any_of(t, [X.CAPTION]))
_line_query("date_hits", _matches(X.DATES), lambda t: X.any_of(F.lower(t), X.DATES))
_line_query("phone_hits", _matches(X.PHONES), lambda t: X.any_of(F.lower(t), X.PHONES))
_line_query("map_scale_hits", f"len(list_filter(string_split(text, ' '), lambda w: {_matches(X.SCALES, 'w')})) > 0", lambda t: F.exists(F.split(t, " "), lambda w: X.any_of(w, X.SCALES)))
_line_query("alpha_line_filter", r"len(regexp_extract_all(text, '\p{L}')) > 4", lambda t: F.regexp_count(t, F.lit(r"\p{L}")) > 4)
_line_query("caption_keywords", " OR ".join("(" + " AND ".join(_contains(g) for g in groups) + ")" for groups in V.CAPTION.values()), lambda t: _any([_all([X.contains_any(F.lower(t), g) for g in groups]) for groups in V.CAPTION.values()]))
def _rule(lang: str, include: dict, exclude: dict, text: str = "lower(text)") -> str:
    rule = lambda k: f"({_contains(include[k], text)} AND NOT {_contains(exclude.get(k, []), text)})"
    return f"CASE {lang} WHEN 'fr' THEN {rule('fr')} WHEN 'it' THEN {rule('it')} WHEN 'en' THEN {rule('en')} ELSE {rule('de')} END"


def _keyword_query(name: str, include: dict, exclude: dict) -> None:
    def run(spark, sf_dir):
        lines = page_lines_of(_pages(spark, sf_dir, keep=("lang",)), "lang")
        return lines.where(X.is_description(F.col("text"), F.col("lang"), include, exclude)).select("doc_id", "page", "lno", "text")

    run.__name__ = name
    query(f"WITH {_TL}, tk AS (SELECT tl.*, coalesce(c.lang, 'de') AS lang FROM tl JOIN corpus c USING (doc_id)) SELECT doc_id, page, lno, text FROM tk WHERE {_rule('lang', include, exclude)}")(run)


def page_lines_of(pages: DataFrame, *keep: str) -> DataFrame:
    return pages.select("doc_id", "page", *keep, F.explode("lines").alias("l")).select("doc_id", "page", *keep, "l.lno", "l.text")


for _name, _inc, _exc in (("keyword_lines_material", V.MATERIAL, V.MATERIAL_NOT), ("keyword_lines_map", V.MAP, V.MAP_NOT), ("boreprofile_keyword_lines", V.BOREPROFILE, {}), ("geo_keyword_lines", V.GEO, {}), ("title_keyword_lines", V.TITLE, {})):
    _keyword_query(_name, _inc, _exc)

_FRONT = " OR ".join("(10 * (" + " + ".join(f"CAST({_contains(g, 'text')} AS INT)" for g in t) + f") >= {7 * len(t)})" for t in V.FRONT_PAGES)


@query(f"WITH {_TL}, tp AS (SELECT doc_id, page, string_agg(text, chr(10) ORDER BY lno) AS text FROM tl GROUP BY ALL) SELECT doc_id, page, ({_FRONT}) AS is_frontpage FROM tp")
def front_page_flag(spark, sf_dir):
    text = F.array_join(F.transform("lines", lambda x: x["text"]), "\n")
    return _pages(spark, sf_dir).select("doc_id", "page", X.front_page(text, V.FRONT_PAGES).alias("is_frontpage"))


def _in(words: list[str]) -> str:
    return ", ".join(map(_quoted, words))


_LANG = f"""lc AS (SELECT *, list_transform({_CLEAN}, lambda w: lower(w)) AS ts, CAST(len(regexp_extract_all(text, '[\\p{{L}}\\p{{Nl}}\\p{{No}}]{{5,}}')) AS INTEGER) AS words FROM base),
ln AS ({" UNION ALL ".join(f"SELECT k, words, {_quoted(g)} AS lang, len(list_filter(ts, lambda t: t IN ({_in(v)}))) AS n FROM lc" for g, v in sorted(V.STOP_WORDS.items()))}),
ls AS (SELECT k, words, lang, round(n / sum(n) OVER (PARTITION BY k), 6) AS score FROM ln WHERE n > 0)"""


def _scored(df: DataFrame) -> DataFrame:
    """df without text, with _s and words."""
    ship(df.sparkSession)
    return X.with_scores(_spread(df), V.STOP_WORDS)


@query(f"WITH base AS (SELECT doc_id AS k, text FROM documents), {_LANG} SELECT k AS doc_id, lang, score FROM ls")
def language_predict(spark, sf_dir):
    return _scored(_docs(spark, sf_dir).select("doc_id", "text")).select("doc_id", F.explode("_s").alias("s")).select("doc_id", "s.*")


@query(f"""WITH base AS (SELECT doc_id AS k, text FROM documents), {_LANG}, r AS (SELECT k, arg_min(lang, (-score, lang)) FILTER (score >= 0.4 AND lang IN ('de', 'fr', 'it', 'en')) AS c, arg_min(lang, (-score, lang)) FILTER (score >= 0.7) AS m FROM ls GROUP BY k)
SELECT lc.k AS doc_id, CASE WHEN words < 4 THEN 'de' ELSE coalesce(c, 'de') END AS classification_language, CASE WHEN words >= 4 THEN m END AS metadata_language FROM lc LEFT JOIN r ON lc.k = r.k""")
def page_languages(spark, sf_dir):
    s = _scored(_docs(spark, sf_dir).select("doc_id", "text"))
    return s.select("doc_id", X.classification_language(F.col("_s"), F.col("words")).alias("classification_language"), X.metadata_language(F.col("_s"), F.col("words")).alias("metadata_language"))


@query(f"""WITH base AS (SELECT (conv_id, turn) AS k, conv_id, turn, text FROM conversations), {_LANG}, r AS (SELECT k, arg_min(lang, (-score, lang)) FILTER (score >= 0.7) AS m FROM ls GROUP BY k),
p AS (SELECT conv_id AS filename, turn + 1 AS page, words, CASE WHEN words >= 4 THEN m END AS lang FROM lc LEFT JOIN r ON lc.k = r.k),
b AS (SELECT filename, lang, round(sum(ln(words) / page), 6) AS score, min(page) AS first, count(*) FILTER (words > 50) AS long, min(page) FILTER (words > 50) AS fl FROM p WHERE lang IS NOT NULL GROUP BY ALL),
t AS (SELECT filename, arg_max(lang, (score, -first)) AS best FROM b GROUP BY 1),
o AS (SELECT b.filename, any_value(best) AS best, string_agg(b.lang, ',' ORDER BY fl, b.lang) FILTER (long >= 2 AND b.lang <> best) AS more FROM b JOIN t USING (filename) GROUP BY 1)
SELECT f.filename, coalesce(best || coalesce(',' || more, ''), '') AS languages FROM (SELECT DISTINCT conv_id AS filename FROM conversations) f LEFT JOIN o USING (filename)""")
def document_languages(spark, sf_dir):
    s = _scored(table(spark, sf_dir, "conversations").select("conv_id", "turn", "text"))
    return L.document_languages(s.select(F.col("conv_id").alias("filename"), (F.col("turn") + 1).alias("page"), "words", X.metadata_language(F.col("_s"), F.col("words")).alias("lang")))


_words_of = lambda terms: {k: [t for t in v if " " not in t] for k, v in terms.items()}  # noqa: E731  # in single words a keyword of two is never found
_GREEDY = "list_reduce(ks, lambda a, x: CASE WHEN len(list_filter(a, lambda f: abs(f - x) <= 10)) > 0 THEN a ELSE list_append(a, x) END, CAST([] AS DOUBLE[]))"
_MAPWORD = rf"(regexp_matches(word, '^\p{{Lu}}\p{{Ll}}*$') OR (regexp_matches(word, '\p{{Lu}}') AND NOT regexp_matches(word, '[\p{{Ll}}\p{{Lt}}]')) OR regexp_matches(word, '{X.NUMBER}'))"
_SCALE = f"len(list_filter(string_split(text, ' '), lambda w: {_matches(X.SCALES, 'w')})) > 0"
_SG = """sg AS (SELECT -CAST(label AS BIGINT) - 1 AS doc_id, 1 AS page, trunc(embedding[4 * i + 1]::DOUBLE * 100) AS sx, trunc(embedding[4 * i + 2]::DOUBLE * 100) AS sy, trunc(embedding[4 * i + 3]::DOUBLE * 100) AS ex, trunc(embedding[4 * i + 4]::DOUBLE * 100) AS ey FROM embeddings, range(16) t(i)),
sa AS (SELECT *, sqrt((ex - sx) ** 2 + (ey - sy) ** 2) AS length, degrees(atan2(ey - sy, ex - sx)) - 180 * floor(degrees(atan2(ey - sy, ex - sx)) / 180) AS angle FROM sg),
sb0 AS (SELECT *, CAST(least(floor(angle / 5), 35) AS INTEGER) AS bin, least(abs(angle), abs(angle - 90), abs(angle - 180)) < 2 AS grid FROM sa)"""
_STATS = lambda source, name: f"{name} AS (SELECT doc_id, page, sum(n) AS sn, sum(g) AS grid, sum(o) AS non_grid, -sum(n / t * ln(n / t)) / log2(36.0) AS entropy FROM (SELECT doc_id, page, bin, count(*) AS n, sum(CASE WHEN grid THEN length ELSE 0 END) AS g, sum(CASE WHEN grid THEN 0 ELSE length END) AS o, sum(count(*)) OVER (PARTITION BY doc_id, page) AS t FROM {source} GROUP BY doc_id, page, bin) GROUP BY doc_id, page)"
# all evidence of a page; fl: lines with their flags in the page's language, pe: pages
_EVID = f"""{_BLK}, base AS (SELECT (doc_id, page) AS k, string_agg(text, chr(10) ORDER BY lno) AS text FROM lin GROUP BY doc_id, page), {_LANG},
lr AS (SELECT k, arg_min(lang, (-score, lang)) FILTER (score >= 0.4 AND lang IN ('de', 'fr', 'it', 'en')) AS c FROM ls GROUP BY k),
lg AS (SELECT lc.k, CASE WHEN words < 4 THEN 'de' ELSE coalesce(c, 'de') END AS lang FROM lc LEFT JOIN lr ON lc.k = lr.k),
fl AS (SELECT b1.*, lang, {_rule('lang', V.MATERIAL, V.MATERIAL_NOT)} AS m, ({_rule('lang', V.MAP, V.MAP_NOT)} OR {_SCALE}) AS mk, {_rule('lang', _words_of(V.BOREPROFILE), {})} AS bk, {_rule('lang', V.GEO, {})} AS gk, {_rule('lang', _words_of(V.TITLE), {})} AS tk, {_matches(X.DATES)} AS dt, {_matches(X.PHONES)} AS ph,
 len(list_filter(string_split(text, ' '), lambda w: regexp_matches(w, '^\\p{{L}}+$'))) AS alpha, count(*) OVER (PARTITION BY b1.doc_id, b1.page, block) AS in_block FROM b1 JOIN lg ON lg.k = (b1.doc_id, b1.page)),
ba AS (SELECT doc_id, page, sum(a) AS ba FROM (SELECT doc_id, page, (max(x1) - min(x0)) * (max(y1) - min(y0)) AS a FROM b1 GROUP BY doc_id, page, block) GROUP BY ALL),
dw AS (SELECT doc_id, page, word_no, x0, TRY_CAST(regexp_extract(replace(text, ',', '.'), '{X.DEPTH}', 1) AS DOUBLE) AS value FROM wd WHERE regexp_matches(replace(text, ',', '.'), '{X.DEPTH}')),
dk AS (SELECT doc_id, page, list(x0 ORDER BY word_no) AS ks FROM dw GROUP BY ALL), df AS (SELECT doc_id, page, {_GREEDY} AS fs FROM dk),
dc AS (SELECT dw.doc_id, dw.page, word_no, x0, value, list_position(list_transform(fs, lambda f: abs(f - x0) <= 10), true) - 1 AS cluster FROM dw JOIN df ON df.doc_id = dw.doc_id AND df.page = dw.page),
dl AS (SELECT *, lag(value) OVER (PARTITION BY doc_id, page, cluster ORDER BY word_no) AS before FROM dc),
sb AS (SELECT doc_id, page, CAST(cluster AS INTEGER) AS cluster, CAST(count(*) AS INTEGER) AS n FROM dl GROUP BY ALL HAVING count(*) >= 3 AND bool_and(before IS NULL OR before < value)),
sn AS (SELECT doc_id, page, count(*) AS sidebars FROM sb GROUP BY ALL),
mt AS (SELECT doc_id, page, lno, n_words, text, x0 FROM fl WHERE m), mq AS (SELECT doc_id, page, list(x0 ORDER BY lno) AS ks FROM mt GROUP BY ALL), mf AS (SELECT doc_id, page, {_GREEDY} AS fs FROM mq),
en AS (SELECT doc_id, page, par, seg, block, lno, n_words, text, x0 FROM fl WHERE in_block <= 3 AND n_words < 4 AND NOT mk), ek AS (SELECT doc_id, page, list(x0 ORDER BY block, lno) AS ks FROM en GROUP BY ALL), ef AS (SELECT doc_id, page, {_GREEDY} AS fs FROM ek),
ec AS (SELECT en.*, list_position(list_transform(fs, lambda f: abs(f - x0) <= 10), true) AS cluster FROM en JOIN ef ON ef.doc_id = en.doc_id AND ef.page = en.page),
es AS (SELECT *, count(*) OVER (PARTITION BY doc_id, page, cluster) AS size FROM ec),
ew AS (SELECT es.doc_id, es.page, count(*) AS words, count(*) FILTER ({_MAPWORD}) AS hits FROM es JOIN seg USING (doc_id, par, seg) WHERE size <= 3 GROUP BY ALL),
ec2 AS (SELECT doc_id, page, count(*) AS entries FROM en GROUP BY ALL),
pe0 AS (SELECT doc_id, page, count(*) AS n_lines, sum(n_words) AS w, avg(n_words) AS wpl, sum(alpha) AS aw, coalesce(sum(n_words) FILTER (m), 0) AS mw, bool_or(bk) AS bk, bool_or(gk) AS gk, count(*) FILTER (mk) AS mk, CAST(bool_or(tk) AS INT) + CAST(bool_or(dt) AS INT) + CAST(bool_or(ph) AS INT) AS clues, avg(y1 - y0) AS font,
 sum(CASE WHEN n_words > 1 THEN (x1 - x0) * (y1 - y0) ELSE 0 END) AS wa, any_value(lang) AS lang FROM fl GROUP BY ALL),
pe AS (SELECT pe0.*, ba, coalesce(len(fs), 0) AS nm, coalesce(sidebars, 0) AS sidebars, coalesce(entries, 0) / n_lines AS entry_ratio, CASE WHEN coalesce(entries, 0) / n_lines > 0.5 AND words > 0 AND (words >= 7 OR mk > 0) THEN hits / words ELSE 0.0 END AS map_ratio,
 pe0.doc_id % 2 = 0 AS digital, ((pe0.doc_id % 3) + 3) % 3 AS drawings, pe0.doc_id % 4 = 0 AS image, CASE WHEN pe0.doc_id % 4 = 0 THEN 612 * 150.0 * (((pe0.doc_id % 8) + 8) % 8) / (612 * 792.0) ELSE 0 END AS coverage
 FROM pe0 JOIN ba USING (doc_id, page) LEFT JOIN mf USING (doc_id, page) LEFT JOIN sn USING (doc_id, page) LEFT JOIN ec2 USING (doc_id, page) LEFT JOIN ew USING (doc_id, page)),
{_SG}, sl AS (SELECT sb0.* FROM sb0 JOIN pe USING (doc_id, page) WHERE w <= 7 OR length > font * sqrt(2.0)), {_STATS('sl', 'st')},
sc AS (SELECT doc_id, page, sn, grid, non_grid, entropy, 0.5 * entropy + 0.4 * least(non_grid / (grid + 1) / 10, 1) AS score FROM st),
cw AS (SELECT DISTINCT doc_id, page FROM fl WHERE doc_id % 4 = 0 AND 150.0 * (((doc_id % 8) + 8) % 8) - y0 <= 0.25 * 150.0 * (((doc_id % 8) + 8) % 8) AND x0 >= -0.2 * 612 AND x1 <= 1.2 * 612 AND {_matches([X.CAPTION], 'text')}
 AND CASE lang {' '.join(f"WHEN {_quoted(k)} THEN " + " AND ".join(_contains(g) for g in V.CAPTION[k]) for k in ('fr', 'it', 'en'))} ELSE {' AND '.join(_contains(g) for g in V.CAPTION['de'])} END),
ev AS (SELECT pe.*, coalesce(sn, 0) AS sn, coalesce(score, 0) AS score, grid, non_grid, entropy, cw.doc_id IS NOT NULL AS caption,
 wa / ba > 0.5 AND wpl > 3 AS is_text, CASE WHEN aw > 0 THEN mw / aw ELSE 0 END + CASE WHEN sidebars > 0 THEN 0.1 ELSE 0 END + CASE WHEN bk THEN 0.05 ELSE 0 END AS bore_ratio,
 coalesce(score, 0) + CASE WHEN mk > 0 THEN 0.05 ELSE 0 END + CASE WHEN map_ratio > 0.75 THEN 0.1 ELSE 0 END AS map_score FROM pe LEFT JOIN sc USING (doc_id, page) LEFT JOIN cw USING (doc_id, page))"""
_CASCADE = f"""{_EVID}, cl AS (SELECT doc_id, page, lang, CASE WHEN is_text AND (NOT digital OR coverage < 0.7) THEN 'text' WHEN CASE WHEN digital THEN (image AND caption) OR (drawings > 0 AND nm > 0 AND bore_ratio > 0.3) ELSE nm > 0 AND bore_ratio > 0.3 END THEN 'boreprofile'
 WHEN gk OR (score > 0.15 AND score < 0.25 AND sn > 500) THEN 'geo_profile' WHEN map_score > 0.4 AND (NOT digital OR image OR drawings > 0) THEN 'map' ELSE 'unknown' END AS label FROM ev)"""


def _context(spark, sf_dir, metadata: bool = False) -> DataFrame:
    """Pages with words, language and what stands in for a PDF's graphics."""
    return page_meta(E.with_language(_pages(spark, sf_dir, words="digits", stop_words=V.STOP_WORDS), metadata))


def _found(spark, sf_dir) -> DataFrame:
    return E.evidence(_context(spark, sf_dir))


def _with_score(spark, sf_dir) -> DataFrame:
    return P.with_line_score(stored(_found(spark, sf_dir)), page_segments(table(spark, sf_dir, "embeddings")))


_six = lambda c, name=None: F.round(c, 6).alias(name or c)


@query(f"WITH {_EVID} SELECT doc_id, page, round(wpl, 6) AS words_per_line, round(wa / ba, 6) AS density, is_text FROM ev")
def word_density(spark, sf_dir):
    return _found(spark, sf_dir).select("doc_id", "page", _six("words_per_line"), _six(P.density(), "density"), P.is_text().alias("is_text"))


@query(f"WITH {_EVID} SELECT doc_id, page, CAST(nm AS INTEGER) AS n_descriptions, CAST(mw AS INTEGER) AS material_words, CAST(aw AS INTEGER) AS alpha_words, CAST(sidebars AS INTEGER) AS n_sidebars, bk AS bore_keyword, round(bore_ratio, 6) AS ratio, nm > 0 AND bore_ratio > 0.3 AS is_boreprofile FROM ev")
def boreprofile_flag(spark, sf_dir):
    return _found(spark, sf_dir).select("doc_id", "page", "n_descriptions", "material_words", "alpha_words", "n_sidebars", "bore_keyword", _six(P.bore_ratio(), "ratio"), P.is_boreprofile().alias("is_boreprofile"))


@query(f"WITH {_EVID} SELECT doc_id, page, gk AS geo_keyword, gk OR (score > 0.15 AND score < 0.25 AND sn > 500) AS is_geo_profile FROM ev")
def geo_profile_flag(spark, sf_dir):
    return _with_score(spark, sf_dir).select("doc_id", "page", "geo_keyword", P.is_geo_profile().alias("is_geo_profile"))


@query(f"WITH {_EVID} SELECT doc_id, page, CAST(mk AS INTEGER) AS map_keyword_lines, round(entry_ratio, 6) AS map_entry_ratio, round(map_ratio, 6) AS map_like_ratio FROM ev")
def map_like_ratio(spark, sf_dir):
    return _found(spark, sf_dir).select("doc_id", "page", "map_keyword_lines", _six("map_entry_ratio"), _six("map_like_ratio"))


@query(f"WITH {_EVID} SELECT doc_id, page, lno, text FROM en")
def map_entry_lines(spark, sf_dir):
    """Lines of fewer than four words in blocks of at most three lines, without map keywords or scales."""
    context = E.with_language(_pages(spark, sf_dir, stop_words=V.STOP_WORDS))
    blocks = P.line_blocks(context)
    lines = context.select("doc_id", "page", "lang", F.explode("lines").alias("l")).select("doc_id", "page", "lang", "l.lno", "l.text", "l.n_words")
    plain = ~X.is_description(F.col("text"), F.col("lang"), V.MAP, V.MAP_NOT) & ~F.exists(F.split("text", " "), lambda w: X.any_of(w, X.SCALES))
    return lines.where((F.col("n_words") < 4) & plain).join(blocks.where("block_lines <= 3"), ["doc_id", "page", "lno"], "left_semi").select("doc_id", "page", "lno", "text")


@query(f"WITH {_EVID} SELECT doc_id, page, round(score, 6) AS line_score, round(map_score, 6) AS map_score, map_score > 0.4 AS is_map FROM ev")
def map_flag(spark, sf_dir):
    return _with_score(spark, sf_dir).select("doc_id", "page", F.round(F.coalesce("score", F.lit(0.0)), 6).alias("line_score"), _six(P.map_score(), "map_score"), (P.map_score() > 0.4).alias("is_map"))


@query(f"WITH {_EVID} SELECT doc_id, page, word_no, x0, value FROM dw")
def depth_entries(spark, sf_dir):
    clean = F.replace("text", F.lit(","), F.lit("."))
    return words_layout(spark, sf_dir).where(F.regexp_like(clean, F.lit(X.DEPTH))).select("doc_id", "page", "word_no", "x0", F.regexp_extract(clean, X.DEPTH, 1).try_cast("double").alias("value"))


@query(f"WITH {_EVID} SELECT doc_id, page, cluster, n FROM sb")
def sidebars(spark, sf_dir):
    """Clusters of three or more depth numbers at one left edge that rise from top to bottom."""
    entry = F.struct("word_no", "x0", "value")
    page = depth_entries(spark, sf_dir).groupBy("doc_id", "page").agg(F.array_sort(F.collect_list(entry)).alias("e"))
    numbered = page.withColumn("c", G.greedy_clusters(F.transform("e", lambda e: e["x0"])))
    each = numbered.select("doc_id", "page", F.explode(F.array_distinct("c")).alias("cluster"), F.arrays_zip("e", "c").alias("z")).select("doc_id", "page", "cluster", F.transform(F.filter("z", lambda z: z["c"] == F.col("cluster")), lambda z: z["e"]["value"]).alias("v"))
    rising = F.forall(F.sequence(F.lit(1), F.size("v") - 1), lambda i: F.get("v", i) > F.get("v", i - 1))
    return each.where(F.size("v") >= 3).where(rising).select("doc_id", "page", "cluster", F.size("v").alias("n"))


@query(f"WITH {_EVID}, mc AS (SELECT mt.*, list_position(list_transform(fs, lambda f: abs(f - x0) <= 10), true) - 1 AS cluster FROM mt JOIN mf ON mf.doc_id = mt.doc_id AND mf.page = mt.page) SELECT doc_id, page, CAST(cluster AS INTEGER) AS cluster, CAST(count(*) AS INTEGER) AS n_lines, CAST(sum(n_words) AS INTEGER) AS n_words FROM mc GROUP BY ALL")
def material_clusters(spark, sf_dir):
    """Lines of material descriptions in clusters of one left edge."""
    return P.material_clusters(E.with_language(_pages(spark, sf_dir, stop_words=V.STOP_WORDS))).select("doc_id", "page", "cluster", "n_lines", "n_words")


@query(f"WITH {_EVID} SELECT doc_id, page, CAST(clues AS INTEGER) AS clues, clues >= 2 AS enough FROM ev")
def content_clues(spark, sf_dir):
    return _found(spark, sf_dir).select("doc_id", "page", "clues", (F.col("clues") >= 2).alias("enough"))


@query(f"WITH {_EVID} SELECT doc_id, page, round(coverage, 6) AS coverage, caption AND image AS caption_keywords FROM (SELECT *, 0 FROM ev) WHERE image")
def image_pages(spark, sf_dir):
    """Share of the page under images, and captions of borehole profiles below them."""
    return _found(spark, sf_dir).where(F.pmod("doc_id", F.lit(4)) == 0).select("doc_id", "page", _six("image_coverage", "coverage"), "caption_keywords")


@query(f"WITH {_WORDS} SELECT doc_id, page, lno, text FROM lin WHERE doc_id % 4 = 0 AND 150.0 * (((doc_id % 8) + 8) % 8) - y0 <= 0.25 * 150.0 * (((doc_id % 8) + 8) % 8) AND x0 >= -0.2 * 612 AND x1 <= 1.2 * 612 AND {_matches([X.CAPTION], 'text')}")
def image_captions(spark, sf_dir):
    pages = page_meta(_pages(spark, sf_dir))
    images = pages.select("doc_id", "page", F.explode("image_boxes").alias("b")).select("doc_id", "page", "b.*")
    return W.captions(page_lines(pages).drop("words"), images).select("doc_id", "page", "lno", "text")


@query(f"WITH {_CASCADE} SELECT doc_id, page, label FROM cl")
def page_class_cascade(spark, sf_dir, pages=None, keep=()):
    """All rules but that of title pages, whose layouts SQL cannot express; page_class_full has it. pages: stored evidence, where a query has it for more than classes."""
    rules = [r for r in P.rules("dev") if r[0] != "title_page"]
    return P.cascade(_context(spark, sf_dir) if pages is None else pages, page_segments(table(spark, sf_dir, "embeddings")), order=rules, keep=keep)


@query(f"WITH {_CASCADE} SELECT doc_id, page, {', '.join(f'CAST(label = {_quoted(c)} AS INTEGER) AS {c}' for c in V.CLASSES)} FROM cl")
def page_class_onehot(spark, sf_dir):
    return page_class_cascade(spark, sf_dir).select("doc_id", "page", *L.one_hot("label"))


@query(f"WITH {_CASCADE}, oh AS (SELECT doc_id, page, {', '.join(f'CAST(label = {_quoted(c)} AS INTEGER) AS "{c}"' for c in V.CLASSES)} FROM cl) SELECT doc_id, page, CASE {' '.join(f'WHEN "{c}" = 1 THEN {_quoted(c)}' for c in V.CLASSES)} ELSE 'unknown' END AS label FROM oh")
def class_of_onehot(spark, sf_dir):
    return page_class_onehot(spark, sf_dir).select("doc_id", "page", W.class_of_one_hot(V.CLASSES).alias("label"))


@query(f"""WITH {_CASCADE}, mr AS (SELECT k, arg_min(lang, (-score, lang)) FILTER (score >= 0.7) AS m FROM ls GROUP BY k), fp AS (SELECT k, ({_FRONT}) AS front FROM base),
p AS (SELECT cl.doc_id AS filename, cl.page, label, words, front, CASE WHEN words >= 4 THEN m END AS ml FROM cl JOIN lc ON lc.k = (cl.doc_id, cl.page) LEFT JOIN mr ON mr.k = lc.k JOIN fp ON fp.k = lc.k),
b AS (SELECT filename, ml AS lang, round(sum(ln(words) / page), 6) AS score, min(page) AS first, count(*) FILTER (words > 50) AS long, min(page) FILTER (words > 50) AS fl FROM p WHERE ml IS NOT NULL AND NOT front GROUP BY ALL),
t AS (SELECT filename, arg_max(lang, (score, -first)) AS best FROM b GROUP BY 1),
o AS (SELECT b.filename, any_value(best) || coalesce(',' || string_agg(b.lang, ',' ORDER BY fl, b.lang) FILTER (long >= 2 AND b.lang <> best), '') AS languages FROM b JOIN t USING (filename) GROUP BY 1)
SELECT filename AS doc_id, CAST(count(*) AS INTEGER) AS page_count, coalesce(any_value(languages), '') AS languages, string_agg(page || ':' || label || ':' || coalesce(ml, '-') || ':' || front, ',' ORDER BY page) AS pages FROM p LEFT JOIN o USING (filename) GROUP BY filename""")
def document_result(spark, sf_dir):
    """The result document of each file, its parts written as text so that SQL can be compared."""
    d = L.documents(_classified(spark, sf_dir))
    line = lambda p: F.concat_ws(":", p["page"].cast("string"), W.class_of_one_hot({c: p["classification"][c] for c in V.CLASSES}), F.coalesce(p["metadata"]["language"], F.lit("-")), p["metadata"]["is_frontpage"].cast("string"))
    return d.select(F.col("filename").alias("doc_id"), F.col("metadata.page_count").alias("page_count"), F.array_join("metadata.languages", ",").alias("languages"), F.array_join(F.transform("pages", line), ",").alias("pages"))


def _classified(spark, sf_dir) -> DataFrame:
    """filename, page, label, language (for the metadata), words, is_frontpage of every page, stored: several steps read them."""
    pages = _context(spark, sf_dir, metadata=True).withColumn("_text", F.array_join(F.transform("lines", lambda x: x["text"]), "\n"))
    pages = pages.withColumn("is_frontpage", X.front_page(F.col("_text"), V.FRONT_PAGES)).drop("_text")
    told = page_class_cascade(spark, sf_dir, stored(P.evidence_of(pages)), ("words", "is_frontpage", "language"))
    return stored(told.withColumnRenamed("doc_id", "filename"))


_STABLE = f"CASE WHEN label IN ({_in(V.STABLE)}) THEN label ELSE 'unknown' END"


@query(f"WITH {_CASCADE} SELECT doc_id, page, {', '.join(f'CAST({_STABLE} = {_quoted(c)} AS INTEGER) AS {c}' for c in V.STABLE)} FROM cl")
def stable_profile(spark, sf_dir):
    """The stable vector of each page."""
    made = page_class_onehot(spark, sf_dir).withColumn("v", L.stable_vector(F.create_map(*[x for c in V.CLASSES for x in (F.lit(c), F.col(c))])))
    return made.select("doc_id", "page", *[F.col("v")[c].alias(c) for c in V.STABLE])


@query(f"WITH {_CASCADE} SELECT doc_id, page, CASE label {' '.join(f'WHEN {_quoted(a)} THEN {_quoted(b)}' for a, b in V.APP_LABELS.items())} ELSE label END AS label FROM cl")
def app_labels(spark, sf_dir):
    return page_class_cascade(spark, sf_dir).select("doc_id", "page", L.app_label(F.col("label")).alias("label"))


RAW_LABELS = ['`"Title."`', "**MAPS**", "**Map.**", "Geo Profile:", "foo", " Text ", "boreholes", "'table'.", "TITLE_PAGE", "geological profile"]
_VALID = {c: c for c in V.CLASSES} | V.ALIASES


@query(f"""WITH r AS (SELECT * FROM (VALUES {', '.join(f'({_quoted(x)})' for x in RAW_LABELS)}) v(raw)), c AS (SELECT raw, regexp_replace(regexp_replace(regexp_replace(lower(trim(raw)), '[`"'']', '', 'g'), '[.:\\s]+$', '', 'g'), '[*]', '', 'g') AS x FROM r)
SELECT raw, CASE x {' '.join(f'WHEN {_quoted(a)} THEN {_quoted(b)}' for a, b in _VALID.items())} ELSE 'unknown' END AS label FROM c""")
def label_normalise(spark, sf_dir):
    return spark.createDataFrame([(x,) for x in RAW_LABELS], "raw string").select("raw", L.normalise_label(F.col("raw")).alias("label"))


_EVAL = """pr AS (SELECT 'doc_' || doc_id AS filename, 1 AS page, CASE WHEN n_chars >= 2000 THEN 'text' WHEN n_chars >= 500 THEN 'map' WHEN n_chars >= 100 THEN 'title_page' ELSE 'unknown' END AS pred FROM documents),
gt AS (SELECT 'doc_' || doc_id AS filename, 1 AS page, CASE WHEN quality = 1 AND toxic = 0 THEN 'text' WHEN quality = 1 THEN 'map' WHEN toxic = 1 THEN 'title_page' ELSE 'unknown' END AS gt FROM labels)"""
_CONF = f"{_EVAL}, m AS (SELECT * FROM pr JOIN gt USING (filename, page)), c AS (SELECT label, coalesce(count(*) FILTER (gt = label AND pred = label), 0) AS tp, count(*) FILTER (gt = label AND pred <> label) AS fn, count(*) FILTER (gt <> label AND pred = label) AS fp FROM (VALUES {', '.join(f'({_quoted(c)})' for c in V.CLASSES)}) v(label) CROSS JOIN m GROUP BY label), prf AS (SELECT label, CASE WHEN tp + fp = 0 THEN 0.0 ELSE tp / (tp + fp) END AS p, CASE WHEN tp + fn = 0 THEN 0.0 ELSE tp / (tp + fn) END AS r, tp, fn, fp FROM c), prf2 AS (SELECT *, CASE WHEN p + r = 0 THEN 0.0 ELSE 2 * p * r / (p + r) END AS f FROM prf)"


_SEG = """sg AS (SELECT label AS page, vec_id, CAST(i AS INTEGER) AS seg, trunc(embedding[4 * i + 1]::DOUBLE * 100) AS sx, trunc(embedding[4 * i + 2]::DOUBLE * 100) AS sy, trunc(embedding[4 * i + 3]::DOUBLE * 100) AS ex, trunc(embedding[4 * i + 4]::DOUBLE * 100) AS ey FROM embeddings, range(16) t(i)),
sa AS (SELECT *, sqrt((ex - sx) ** 2 + (ey - sy) ** 2) AS length, degrees(atan2(ey - sy, ex - sx)) - 180 * floor(degrees(atan2(ey - sy, ex - sx)) / 180) AS angle FROM sg),
sb AS (SELECT *, CAST(least(floor(angle / 5), 35) AS INTEGER) AS bin, least(abs(angle), abs(angle - 90), abs(angle - 180)) < 2 AS grid FROM sa),
st AS (SELECT page, sum(n) AS n, sum(g) AS grid, sum(o) AS non_grid, -sum(n / t * ln(n / t)) / log2(36.0) AS entropy FROM (SELECT page, bin, count(*) AS n, sum(CASE WHEN grid THEN length ELSE 0 END) AS g, sum(CASE WHEN grid THEN 0 ELSE length END) AS o, sum(count(*)) OVER (PARTITION BY page) AS t FROM sb GROUP BY page, bin) GROUP BY page)"""


def _pair(spark, sf_dir):
    return evaluation_pair(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query(f"WITH {_CONF} SELECT label, tp, fn, fp FROM c")
def eval_confusion(spark, sf_dir):
    return L.confusion(*_pair(spark, sf_dir))


@query(f"WITH {_CONF} SELECT label, round(p, 6)::DOUBLE AS precision, round(r, 6)::DOUBLE AS recall, round(f, 6)::DOUBLE AS f1 FROM prf2")
def eval_prf(spark, sf_dir):
    return L.scores(eval_confusion(spark, sf_dir))


@query(f"WITH {_CONF} SELECT round(avg(round(p, 6)), 5) AS precision, round(avg(round(r, 6)), 5) AS recall, round(avg(round(f, 6)), 5) AS f1 FROM prf2")
def eval_macro(spark, sf_dir):
    return L.macro(eval_confusion(spark, sf_dir))


@query(f"WITH {_CONF} SELECT round(sum(tp) / (sum(tp) + sum(fp)), 4) AS precision, round(sum(tp) / (sum(tp) + sum(fn)), 4) AS recall, round(sum(tp) / (sum(tp) + (sum(fp) + sum(fn)) / 2), 4) AS f1 FROM c")
def eval_micro(spark, sf_dir):
    return L.micro(eval_confusion(spark, sf_dir))


@query(f"WITH {_EVAL}, ga AS (SELECT * FROM gt UNION ALL SELECT 'item_' || item_id, 1, 'unknown' FROM benchmark) SELECT ga.filename, ga.page FROM ga ANTI JOIN pr USING (filename, page)")
def eval_missing(spark, sf_dir):
    """Pages of the truth, items of the benchmark among them, without a prediction."""
    pred, truth = _pair(spark, sf_dir)
    items = table(spark, sf_dir, "benchmark").select(F.concat(F.lit("item_"), F.col("item_id").cast("string")).alias("filename"), F.lit(1).alias("page"), F.lit("unknown").alias("label"))
    return truth.union(items).join(pred, ["filename", "page"], "left_anti").select("filename", "page")


@query(f"WITH {_EVAL} SELECT count(DISTINCT filename) AS files, count(*) AS pages FROM pr JOIN gt USING (filename, page)")
def eval_counts(spark, sf_dir):
    return L.matched(*_pair(spark, sf_dir)).agg(F.countDistinct("filename").alias("files"), F.count(F.lit(1)).alias("pages"))


@query(f"WITH {_EVAL} SELECT filename, page, {', '.join(f'CAST(pred = {_quoted(c)} AS INTEGER) AS {c}_pred, CAST(gt = {_quoted(c)} AS INTEGER) AS {c}_gt, CAST((pred = {_quoted(c)}) = (gt = {_quoted(c)}) AS INTEGER) AS {c}_match' for c in V.CLASSES)}, 0 AS all_labels_match, 'mismatch' AS status FROM pr JOIN gt USING (filename, page) WHERE pred <> gt")
def eval_comparison(spark, sf_dir):
    return L.comparison(*_pair(spark, sf_dir))


@query(f"WITH {_EVAL} SELECT filename, page, gt AS true_labels, pred AS predicted_labels FROM pr JOIN gt USING (filename, page) WHERE pred <> gt")
def eval_active_labels(spark, sf_dir):
    """The labels set in each row of the comparison."""
    rows = L.active_labels(eval_comparison(spark, sf_dir))
    return rows.select("filename", "page", F.array_join("true_labels", ",").alias("true_labels"), F.array_join("predicted_labels", ",").alias("predicted_labels"))


@query(f"WITH {_EVAL} SELECT pred AS label FROM pr UNION SELECT gt FROM gt")
def label_union(spark, sf_dir):
    pred, truth = _pair(spark, sf_dir)
    return pred.select("label").union(truth.select("label")).distinct()


@query("SELECT 'order_' || l_orderkey AS filename, CAST(l_linenumber % 3 AS INTEGER) AS page, arg_max(l_returnflag, l_linenumber) AS label FROM lineitem GROUP BY 1, 2")
def last_prediction(spark, sf_dir):
    """Of several predictions for one page the last one counts; lines of orders stand in for predictions."""
    rows = table(spark, sf_dir, "lineitem").select(F.concat(F.lit("order_"), F.col("l_orderkey").cast("string")).alias("filename"), (F.col("l_linenumber") % 3).cast("int").alias("page"), F.col("l_returnflag").alias("label"), "l_linenumber")
    return L.last_of_key(rows, "l_linenumber").select("filename", "page", "label")


@query(f"WITH {_CASCADE} SELECT doc_id, label, string_agg(CAST(page AS VARCHAR), ',' ORDER BY page) AS pages FROM cl GROUP BY doc_id, label")
def pages_by_class(spark, sf_dir):
    g = page_class_cascade(spark, sf_dir).groupBy("doc_id", "label").agg(F.array_sort(F.collect_list("page")).alias("p"))
    return g.select("doc_id", "label", F.array_join(F.transform("p", lambda x: x.cast("string")), ",").alias("pages"))


@query(f"WITH {_TL}, h AS (SELECT *, {', '.join(f'nullif(regexp_extract(lower(text), {_quoted(p)}), {_quoted(chr(32)[:0])}) AS m{i}' for i, p in enumerate(X.DATES))} FROM tl) SELECT doc_id, page, lno, trim(coalesce(m0, m1, m2)) AS found FROM h WHERE coalesce(m0, m1, m2) IS NOT NULL")
def first_date(spark, sf_dir):
    """What the first of the date patterns that matches finds on a line."""
    return _lines(spark, sf_dir).select("doc_id", "page", "lno", F.trim(X.first_match(F.lower("text"), X.DATES)).alias("found")).where("found IS NOT NULL")


@query(f"WITH {_WORDS} SELECT doc_id, page, word_no, CAST(greatest(0, trunc(1000 * x0 / 612)) AS INTEGER) AS bx0, CAST(greatest(0, trunc(1000 * y0 / 792)) AS INTEGER) AS by0, CAST(greatest(0, trunc(1000 * x1 / 612)) AS INTEGER) AS bx1, CAST(greatest(0, trunc(1000 * (y0 + 10) / 792)) AS INTEGER) AS by1 FROM wd")
def layout_boxes(spark, sf_dir):
    """Boxes of words in thousandths of the page, cut off, as layout models take them."""
    side = lambda c, size: F.greatest(F.lit(0), (F.lit(1000) * F.col(c) / size).cast("int"))
    return words_layout(spark, sf_dir).select("doc_id", "page", "word_no", *[side(c, size).alias(f"b{c}") for c, size in (("x0", 612), ("y0", 792), ("x1", 612), ("y1", 792))])


@query("WITH e AS (SELECT vec_id, embedding[1:8] AS z FROM embeddings WHERE len(embedding) >= 8), x AS (SELECT vec_id, list_transform(z, lambda v: exp(v::DOUBLE - list_max(z)::DOUBLE)) AS p FROM e) SELECT vec_id, CAST(list_position(p, list_max(p)) - 1 AS INTEGER) AS class, round(list_max(p) / list_sum(p), 6) AS share FROM x")
def logit_class(spark, sf_dir):
    """Class of greatest logit, and its share after softmax; the first eight components of a vector stand in for logits."""
    z = F.transform(F.slice("embedding", 1, 8), lambda v: v.cast("double"))
    best = L.softmax(F.col("z"))
    return table(spark, sf_dir, "embeddings").where(F.size("embedding") >= 8).select("vec_id", z.alias("z")).select("vec_id", (F.array_position("z", F.array_max("z")) - 1).cast("int").alias("class"), F.round(F.array_max(best), 6).alias("share"))


@query(f"WITH {_SEG} SELECT page, vec_id, seg, least(612 - sy, 612 - ey) + 0.0::DOUBLE AS x0, least(sx, ex) + 0.0::DOUBLE AS y0, greatest(612 - sy, 612 - ey) + 0.0::DOUBLE AS x1, greatest(sx, ex) + 0.0::DOUBLE AS y1 FROM sg")
def rotated_boxes(spark, sf_dir):
    """Boxes of segments on pages turned by a quarter."""
    turn = F.struct(F.lit(0.0).alias("a"), F.lit(1.0).alias("b"), F.lit(-1.0).alias("c"), F.lit(0.0).alias("d"), F.lit(612.0).alias("e"), F.lit(0.0).alias("f"))
    box = F.struct(F.least("sx", "ex").alias("x0"), F.least("sy", "ey").alias("y0"), F.greatest("sx", "ex").alias("x1"), F.greatest("sy", "ey").alias("y1"))
    return segments(table(spark, sf_dir, "embeddings")).select("page", "vec_id", "seg", rotate(box, turn).alias("b")).select("page", "vec_id", "seg", "b.*")


@query(f"WITH {_SEG}, b AS (SELECT page, vec_id, max(seg) AS m, min(least(sx, ex)) AS x0, min(least(sy, ey)) AS y0, max(greatest(sx, ex)) AS x1, max(greatest(sy, ey)) AS y1 FROM sg GROUP BY ALL) SELECT page, vec_id, CASE WHEN vec_id % 5 = 0 THEN 0 ELSE x0 * 72 / 150 END::DOUBLE AS x0, CASE WHEN vec_id % 5 = 0 THEN 0 ELSE y0 * 72 / 150 END::DOUBLE AS y0, CASE WHEN vec_id % 5 = 0 THEN 612 ELSE x1 * 72 / 150 END::DOUBLE AS x1, CASE WHEN vec_id % 5 = 0 THEN 792 ELSE y1 * 72 / 150 END::DOUBLE AS y1 FROM b")
def content_boxes(spark, sf_dir):
    """Boxes around all segments of a vector, in pixels at 150 dpi, as points; none was found where vec_id is divisible by five."""
    b = segments(table(spark, sf_dir, "embeddings")).groupBy("page", "vec_id").agg(F.min(F.least("sx", "ex")).alias("x0"), F.min(F.least("sy", "ey")).alias("y0"), F.max(F.greatest("sx", "ex")).alias("x1"), F.max(F.greatest("sy", "ey")).alias("y1"))
    found = F.when(F.col("vec_id") % 5 != 0, F.struct("x0", "y0", "x1", "y1"))
    sheet = F.struct(F.lit(0.0).alias("x0"), F.lit(0.0).alias("y0"), F.lit(612.0).alias("x1"), F.lit(792.0).alias("y1"))
    return b.select("page", "vec_id", content_box(found, sheet).alias("c")).select("page", "vec_id", "c.*")


@query("SELECT o_orderkey AS page, bool_or((l_linenumber % 3 < 2) AND l_quantity > 25) AS digital FROM orders JOIN lineitem ON l_orderkey = o_orderkey GROUP BY 1")
def digital_pages(spark, sf_dir):
    """Pages with a text box that is not empty; lines of orders stand in for a page's log of boxes."""
    kind = F.when(F.col("l_linenumber") % 3 == 0, "fill-text").when(F.col("l_linenumber") % 3 == 1, "stroke-text").otherwise("fill-path")
    box = F.struct(kind.alias("type"), F.lit(0.0).alias("x0"), F.lit(0.0).alias("y0"), F.greatest(F.col("l_quantity") - 25, F.lit(0.0)).alias("x1"), F.lit(10.0).alias("y1"))
    log = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("page"), box.alias("box")).groupBy("page").agg(F.collect_list("box").alias("boxlog"))
    return log.select("page", is_digital(F.col("boxlog")).alias("digital"))


@query(f"""WITH {_WORDS}, g AS (SELECT doc_id, page, lno, y0, lead(y0) OVER (PARTITION BY doc_id, page ORDER BY lno) - y0 AS gap FROM lin), k AS (SELECT * FROM g WHERE gap IS NOT NULL),
s AS (SELECT doc_id, page, count(*) AS n, sum(gap) AS s, sum(gap * gap) AS q, arg_min(gap, lno) AS a, arg_max(gap, lno) AS z FROM k GROUP BY ALL),
d AS (SELECT *, sqrt(greatest(q - s * s / n, 0) / (n - 1)) AS sd, sqrt(greatest((q - a * a) - (s - a) * (s - a) / (n - 1), 0) / (n - 2)) AS sa, sqrt(greatest((q - z * z) - (s - z) * (s - z) / (n - 1), 0) / (n - 2)) AS sz FROM s WHERE n >= 3)
SELECT s.doc_id, s.page, round(CASE WHEN sd > 0 AND sa / sd < 0.6 AND sa <= sz THEN (s.s - s.a) / (s.n - 1) WHEN sd > 0 AND sz / sd < 0.6 THEN (s.s - s.z) / (s.n - 1) ELSE s.s / s.n END, 6) AS mean_gap FROM s LEFT JOIN d USING (doc_id, page)""")
def outlier_trim(spark, sf_dir):
    """Mean gap of a page's lines without the first or last one, where leaving it out brings the deviation below 0.6 of itself."""
    return W.trimmed_gaps(page_lines(_pages(spark, sf_dir)).drop("words"))


@query(f"WITH {_EVAL} SELECT pr.filename, pr.page FROM pr ANTI JOIN gt USING (filename, page)")
def eval_extra(spark, sf_dir):
    pred, truth = _pair(spark, sf_dir)
    return pred.join(truth, ["filename", "page"], "left_anti").select("filename", "page")


@query(f"WITH {_EVAL} SELECT filename, page, pred, gt FROM pr JOIN gt USING (filename, page) WHERE pred <> gt")
def eval_mismatch(spark, sf_dir):
    return L.mismatches(*_pair(spark, sf_dir))


@query(f"WITH {_EVAL} SELECT gt, pred, count(*) AS n FROM pr JOIN gt USING (filename, page) GROUP BY ALL")
def confusion_matrix(spark, sf_dir):
    return L.matched(*_pair(spark, sf_dir)).groupBy("gt", "pred").agg(F.count(F.lit(1)).alias("n"))


@query(f"WITH {_SEG} SELECT page, vec_id, seg, round(length, 6) AS length, round(angle, 6) AS angle FROM sa")
def segment_length_angle(spark, sf_dir):
    s = segments(table(spark, sf_dir, "embeddings"))
    c = [F.col(x) for x in ("sx", "sy", "ex", "ey")]
    return s.select("page", "vec_id", "seg", F.round(G.segment_length(*c), 6).alias("length"), F.round(G.segment_angle(*c), 6).alias("angle"))


@query(f"WITH {_SEG} SELECT page, bin, count(*) AS n FROM sb GROUP BY ALL")
def angle_histogram(spark, sf_dir):
    s = segments(table(spark, sf_dir, "embeddings"))
    return s.groupBy("page", G.angle_bin(G.segment_angle(*[F.col(x) for x in ("sx", "sy", "ex", "ey")])).alias("bin")).agg(F.count(F.lit(1)).alias("n"))


@query(f"WITH {_SEG}, sc AS (SELECT *, 0.5 * entropy + 0.4 * least(non_grid / (grid + 1) / 10, 1) AS score FROM st) SELECT page, CAST(n AS BIGINT) AS n, round(grid, 6) AS grid, round(non_grid, 6) AS non_grid, round(entropy, 6) AS entropy, round(score, 6) AS score, score > 0.15 AND score < 0.25 AND n > 500 AS is_geo, score > 0.4 AS is_map FROM sc")
def line_score(spark, sf_dir):
    s = P.segment_stats(segments(table(spark, sf_dir, "embeddings")))
    r = lambda c: F.round(c, 6).alias(c)
    return s.select("page", "n", r("grid"), r("non_grid"), r("entropy"), r("score"), ((F.col("score") > 0.15) & (F.col("score") < 0.25) & (F.col("n") > 500)).alias("is_geo"), (F.col("score") > 0.4).alias("is_map"))


@query(f"WITH {_WORDS} SELECT doc_id, page, lno, next - y0 AS gap FROM (SELECT doc_id, page, lno, y0, lead(y0) OVER (PARTITION BY doc_id, page ORDER BY lno) AS next FROM lin) WHERE next IS NOT NULL")
def vertical_gaps(spark, sf_dir):
    p = _pages(spark, sf_dir).where(F.size("lines") > 1)
    return p.select("doc_id", "page", F.explode(F.transform(F.sequence(F.lit(0), F.size("lines") - 2), lambda i: F.struct(i.alias("lno"), (F.get("lines", i + 1)["y0"] - F.get("lines", i)["y0"]).alias("gap")))).alias("g")).select("doc_id", "page", "g.*")


@query(f"WITH {_WORDS} SELECT doc_id, page, CAST(count(DISTINCT y1 - y0) AS INTEGER) AS n_sizes, max(y1 - y0) AS largest FROM lin GROUP BY ALL")
def font_layout(spark, sf_dir):
    size = F.transform("lines", lambda x: F.abs(x["y1"] - x["y0"]))
    return _pages(spark, sf_dir).select("doc_id", "page", F.size(F.array_distinct(size)).alias("n_sizes"), F.array_max(size).alias("largest"))


@query(rf"""WITH {_WORDS} SELECT l.doc_id, l.page, CAST(count(*) AS INTEGER) AS n_words, CAST(count(*) FILTER (regexp_matches(s.word, '^\p{{Lu}}\p{{Ll}}*$') OR (regexp_matches(s.word, '\p{{Lu}}') AND NOT regexp_matches(s.word, '[\p{{Ll}}\p{{Lt}}]')) OR regexp_matches(s.word, '{X.NUMBER}')) AS INTEGER) AS n_map_words FROM seg s JOIN lin l USING (doc_id, par, seg) GROUP BY ALL""")
def map_like_words(spark, sf_dir):
    words = F.flatten(F.transform("lines", lambda x: F.split(x["text"], " ")))
    return _pages(spark, sf_dir).select("doc_id", "page", F.size(words).alias("n_words"), F.size(F.filter(words, X.is_map_word)).alias("n_map_words"))


@query()
def page_class_full(spark, sf_dir):
    """All rules with title layouts; tested against a plain model."""
    return P.cascade(_context(spark, sf_dir), page_segments(table(spark, sf_dir, "embeddings")))


@query()
def title_layout(spark, sf_dir):
    """Title pages and the layouts that make them; tested against a plain model."""
    return _found(spark, sf_dir).select("doc_id", "page", _six("title_gap"), "is_candidate", "centered", "aligned", P.is_title_page().alias("is_title_page"))


@query(f"""WITH {_EVID}, {_STATS('sb0', 'sf')}, os AS (SELECT doc_id, par, seg, sum(60 * length(word)) FILTER (wi % 12 > 0) AS others FROM seg GROUP BY ALL),
pf AS (SELECT doc_id, page, sum(CASE WHEN n_words > 1 THEN (x1 - x0) * (y1 - y0) + coalesce(others, 0) ELSE 0 END) AS summed, (max(x1) - min(x0)) * (max(y1) - min(y0)) AS extent, avg(x0) AS l, avg(x1) AS r, avg(x1 - x0) AS t, var_pop(n_words) AS v, stddev_pop(x0) AS i,
 sum(len(regexp_extract_all(text, {_quoted(X.PUNCTUATION)}))) / count(*) AS pu, sum(len(regexp_extract_all(text, '\\p{{Lu}}'))) AS up, sum(length(regexp_replace(text, '\\s', '', 'g'))) AS so FROM fl JOIN os USING (doc_id, par, seg) GROUP BY ALL)
SELECT doc_id, page, {', '.join(f'coalesce(round({e}, 6), 0)::DOUBLE AS {n}' for n, e in (('words_per_line', 'wpl'), ('text_density', 'CASE WHEN pf.extent > 0 THEN summed / pf.extent ELSE 0 END'), ('mean_left', 'l'), ('mean_right', 'r'), ('text_width', 't'), ('line_count', 'n_lines'), ('line_length_variance', 'v'), ('indent_std', 'i'), ('punctuation_per_line', 'pu'), ('capital_ratio', 'CASE WHEN so > 0 THEN up / so ELSE 0 END'), ('has_sidebar', 'CAST(sidebars > 0 AS INT)'), ('has_bore_keyword', 'CAST(bk AS INT)'), ('description_count', 'nm'), ('map_keyword_lines', 'mk'), ('grid_length', 'sf.grid'), ('non_grid_length', 'sf.non_grid'), ('angle_entropy', 'sf.entropy')))} FROM ev JOIN pf USING (doc_id, page) LEFT JOIN sf USING (doc_id, page)""")
def page_features(spark, sf_dir, found=None):
    """found: stored evidence of pages with their shape, where a query has it for more than features."""
    stats = P.segment_stats(page_segments(table(spark, sf_dir, "embeddings")), ("doc_id", "page"))
    return P.features(E.evidence(_context(spark, sf_dir), shape=True) if found is None else found, stats)


@query(f"""WITH {_CASCADE} SELECT doc_id, page, label FROM (SELECT *, row_number() OVER (PARTITION BY doc_id, label ORDER BY (page * 2654435761) % 1000003, page) AS n FROM cl) WHERE n <= CASE label {' '.join(f'WHEN {_quoted(c)} THEN {n}' for c, n in V.SAMPLE_CAPS.items())} ELSE 1 END""")
def class_samples(spark, sf_dir):
    """Pages of each document and class up to the class's cap, by a hash of the page."""
    w = Window.partitionBy("doc_id", "label").orderBy((F.col("page").cast("long") * 2654435761) % 1000003, "page")
    cap = F.coalesce(F.try_element_at(F.create_map(*[F.lit(x) for pair in V.SAMPLE_CAPS.items() for x in pair]), F.col("label")), F.lit(1))
    return page_class_cascade(spark, sf_dir).withColumn("n", F.row_number().over(w)).where(F.col("n") <= cap).select("doc_id", "page", "label")


@query("SELECT doc_id, CASE WHEN row_number() OVER (ORDER BY (doc_id * 2654435761) % 1000003, doc_id) <= floor(count(*) OVER () * 0.2) THEN 'val' ELSE 'train' END AS split FROM documents")
def train_val_split(spark, sf_dir):
    """The first int(n x 0.2) of all documents, in order of a hash of their id, are for validation."""
    return L.split_rows(table(spark, sf_dir, "documents").select("doc_id"), "doc_id", 0.2)


@query("""WITH c AS (SELECT (p_partkey * 7) % 256 AS r, (p_size * 5) % 256 AS g, CAST(floor(p_retailprice) AS BIGINT) % 256 AS b FROM part), v AS (SELECT *, greatest(r, g, b) AS mx, least(r, g, b) AS mn FROM c),
h AS (SELECT CASE WHEN mx = mn THEN 0.0 WHEN mx = r THEN ((g - b) * 60.0 / (mx - mn) + 360) WHEN mx = g THEN (b - r) * 60.0 / (mx - mn) + 120 ELSE (r - g) * 60.0 / (mx - mn) + 240 END AS hue, CASE WHEN mx = 0 THEN 0.0 ELSE (mx - mn) * 1.0 / mx END AS sat, mx / 255.0 AS val FROM v),
b AS (SELECT CAST(least(floor((hue - 360 * floor(hue / 360)) / 18), 19) AS INTEGER) AS h, CAST(least(floor(sat * 3), 2) AS INTEGER) AS s, CAST(least(floor(val * 3), 2) AS INTEGER) AS v FROM h)
SELECT h, s, v, count(*) AS n FROM b GROUP BY ALL HAVING count(*) * 300 >= (SELECT count(*) FROM b) AND s >= 1 AND v >= 1""")
def hsv_bins(spark, sf_dir):
    """Common colours, given by numbers of parts, in bins of hue, saturation and value; bins of greys and of under a 300th of all are left out."""
    r, g, b = F.col("r").cast("double"), F.col("g").cast("double"), F.col("b").cast("double")
    c = table(spark, sf_dir, "part").select((F.col("p_partkey") * 7 % 256).alias("r"), (F.col("p_size") * 5 % 256).alias("g"), (F.floor("p_retailprice") % 256).alias("b"))
    mx, mn = F.greatest(r, g, b), F.least(r, g, b)
    hue = F.when(mx == mn, 0.0).when(mx == r, (g - b) * 60 / (mx - mn) + 360).when(mx == g, (b - r) * 60 / (mx - mn) + 120).otherwise((r - g) * 60 / (mx - mn) + 240)
    bins = c.select(F.least(F.floor(F.pmod(hue, F.lit(360.0)) / 18), F.lit(19)).cast("int").alias("h"), F.least(F.floor(F.coalesce(F.try_divide(mx - mn, mx), F.lit(0.0)) * 3), F.lit(2)).cast("int").alias("s"), F.least(F.floor(mx / 255 * 3), F.lit(2)).cast("int").alias("v"))
    counts = bins.groupBy("h", "s", "v").agg(F.count(F.lit(1)).alias("n"))
    whole = F.sum("n").over(Window.partitionBy())  # over at most 180 bins
    return counts.withColumn("_t", whole).where("n * 300 >= _t AND s >= 1 AND v >= 1").drop("_t")


@query(f"WITH {_CASCADE}, n AS (SELECT label, count(*) AS n FROM cl GROUP BY label) SELECT label, n FROM n")
def class_counts(spark, sf_dir):
    return page_class_cascade(spark, sf_dir).groupBy("label").agg(F.count(F.lit(1)).alias("n"))


@query()
def stream_page_class(spark, sf_dir):
    """All documents as requests through the streaming job; what it answers equals the batch."""
    import uuid

    from .streaming import run_jobs

    home = f"{spark.conf.get('spark.checkpoint.dir', None) or spark.conf.get('spark.sql.warehouse.dir').rstrip('/') + '/_intermediate'}/jobs/{uuid.uuid4().hex}"
    docs = _docs(spark, sf_dir).select(F.concat(F.lit("doc_"), F.col("doc_id").cast("string"), F.lit(".pdf")).alias("file"), "text")
    _spread(docs).write.parquet(f"{home}/inbox")
    run_jobs(spark, f"{home}/inbox", f"{home}/results", f"{home}/states", f"{home}/check")
    return spark.read.parquet(f"{home}/results").select("file", "page", "label")


def _trained(spark, sf_dir):
    """A small forest that learns the classes of the rules from the 17 features, and the features."""
    from .plans import models as M

    pages = stored(P.evidence_of(_context(spark, sf_dir), shape=True))  # pages are gone through once, for features and classes
    found = stored(page_features(spark, sf_dir, pages))
    wanted = stored(M.with_targets(found, page_class_cascade(spark, sf_dir, pages), V.CLASSES))  # training reads it again and again
    return M, found, M.train(wanted, M.random_forest(trees=20, depth=8))


@query()
def tree_model_predictions(spark, sf_dir):
    M, found, model = _trained(spark, sf_dir)
    names = F.array(*map(F.lit, V.CLASSES))
    return model.transform(found).select("doc_id", "page", F.get(names, F.col("prediction").cast("int")).alias("label"))


@query()
def feature_importance(spark, sf_dir):
    M, found, model = _trained(spark, sf_dir)
    rows = [(n, name, value) for n, (name, value) in enumerate(M.importance(model, M.feature_names(found)), 1)]
    return spark.createDataFrame(rows, "rank int, feature string, importance double")
