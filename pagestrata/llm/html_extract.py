"""HTML extraction by deducing the template of each host from equivalence classes of tokens.

Tokens of a page are its element starts and ends, told apart by their path (tags with class and id), and whole texts at their path outside
the article. For each host the vector of a token's counts over the distinct page contents is summarised by an additive fingerprint, so
one aggregation with partial sums groups the tokens of equal vectors. A group is a class if it is large (two tokens at least) and frequent (at
least `support` contents and half of the host's). A class is valid if its tokens follow each other in one order, repeated whole, on every
page, and if it crosses no larger class. Valid classes are nested: the parent of a class is the innermost one that holds all of its
repetitions between the same two neighbouring tokens, on every page. The gaps between neighbouring tokens are the slots of the template.

Every page is read against its host's template: texts that are template tokens go, all other texts lie in a slot (class and gap, or the
page itself where the host has no valid class, as hosts of one content). A slot is main text if the elements around it are: inside `article`
elements if the page has some, else inside `main` or role=main, else anywhere; and, in all three cases, not inside menus, headers of
the page, footers, asides, forms, scripts, styles, hidden elements or elements of such a role, nor inside a container (div, section, ul, ol)
whose whole class or id is one of LEFT_OUT_NAMES. No single word of a class or id decides anything. Texts inside an article are never
template tokens, so what several articles share stays.

Blocks are block-level elements; white space inside one (line-break elements count as white space) becomes one space.

Defined results: null or empty html is empty text; pages of null url form a host of their own; repeated rows are extracted one by one, and
are one content as evidence; an empty table gives no rows; input columns named text or n_chars are replaced, all others except html are kept
(names with two leading underscores are the operator's own).
"""

from __future__ import annotations

import html
import json
import re
from hashlib import blake2b

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import U64, lean, materialize, mix, partitions, prepare, table, without

_TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?\]\]>|<[!?][^>]*>|<(/?)([a-zA-Z][\w:-]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)>", re.S)
_ATTR = re.compile(r"([\w:-]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
_HIDDEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.I)
RAW = {"script", "style", "noscript", "template", "textarea", "title", "iframe", "svg", "xmp", "noembed"}
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
BLOCK = set("address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html li main menu nav ol p pre section summary table tbody td tfoot th thead tr ul".split())
LEFT_OUT = set("nav aside footer form menu dialog button select option input label fieldset head object embed canvas audio video".split())
LEFT_OUT_ROLES = set("navigation banner contentinfo complementary search form dialog alert alertdialog menu menubar note status".split())
CONTAINERS = {"div", "section", "ul", "ol"}
# whole values of class or id that stand for one kind of boilerplate only
LEFT_OUT_NAMES = set("ad ads advert adverts advertisement comments comment-list commentlist comments-area disqus_thread cookie-notice cookie-banner cookie-consent sidebar navbar navigation breadcrumbs pagination newsletter-signup share-buttons related-posts site-header site-footer site-nav".split())
P_CLOSERS = BLOCK - {"html", "body", "tr", "td", "th", "tbody", "thead", "tfoot", "caption"}
OPEN, CLOSE, TEXT = 0, 1, 2
_CLOSED = 0x5DEECE66D1234567
_MASK = (1 << 63) - 1
SMALL_BYTES = 16 << 20
HOT_PAGES = 20_000


class Node:
    __slots__ = ("tag", "out", "article", "path")

    def __init__(self, tag: str, out: bool, article: int, path: int):
        self.tag, self.out, self.article, self.path = tag, out, article, path


class Reader:
    """Pages as events (kind, node, block, text); paths are numbers, remembered from page to page."""

    def __init__(self):
        self.paths: dict = {}

    def path(self, above: int, name: str) -> int:
        key = (above, name)
        got = self.paths.get(key)
        if got is None:
            if len(self.paths) > 200_000:
                self.paths.clear()
            got = self.paths[key] = int.from_bytes(blake2b(f"{above} {name}".encode(), digest_size=8).digest(), "little") & _MASK
        return got

    def read(self, page: str) -> tuple[list, bool, bool]:
        """Events of a page, whether it has articles, and whether it has a main element."""
        events: list = []
        stack = [Node("", False, 0, 1)]
        block, at, end, articles, mains = 0, 0, len(page), False, False

        def close(k: int) -> None:
            for node in reversed(stack[k:]):
                events.append((CLOSE, node, block, None))
            del stack[k:]

        while at < end:
            m = _TOKEN.search(page, at)
            stop = m.start() if m else end
            if stop > at:
                events.append((TEXT, stack[-1], block, page[at:stop]))
            if not m:
                break
            at = m.end()
            tag = (m[2] or "").lower()
            if not tag:
                continue
            if m[1]:
                for k in range(len(stack) - 1, 0, -1):
                    if stack[k].tag == tag:
                        close(k)
                        break
                else:
                    if tag not in BLOCK:
                        continue
                if tag in BLOCK:
                    block += 1
                continue
            if tag == "br":
                events.append((TEXT, stack[-1], block, " "))
                continue
            if tag in BLOCK:
                block += 1
                if tag in P_CLOSERS:
                    for k in range(len(stack) - 1, 0, -1):
                        if stack[k].tag == "p":
                            close(k)
                            break
                        if stack[k].tag in BLOCK:
                            break
                if tag in ("li", "dt", "dd", "tr", "td", "th", "option"):
                    for k in range(len(stack) - 1, 0, -1):
                        if stack[k].tag == tag:
                            close(k)
                            break
                        if stack[k].tag in ("ul", "ol", "dl", "table", "tr") and tag != "tr":
                            break
            top = stack[-1]
            got = {a[0].lower(): a[1] or a[2] or a[3] for a in _ATTR.findall(m[3])} if m[3].strip() else {}
            names = (got.get("class", "").strip(), got.get("id", "").strip())
            role = got.get("role", "").lower()
            article = top.article
            out = top.out or tag in LEFT_OUT or role in LEFT_OUT_ROLES or "hidden" in got or got.get("aria-hidden", "").lower() == "true" or ("style" in got and bool(_HIDDEN.search(got["style"])))
            out = out or (tag in CONTAINERS and any(n.lower() in LEFT_OUT_NAMES for n in names)) or (tag == "header" and article != 1)
            if not out:
                if tag == "article" or role == "article":
                    article, articles = 1, True
                elif not article and (tag == "main" or role == "main"):
                    article, mains = 2, True
            node = Node(tag, out, article, self.path(top.path, f"{tag}.{names[0]}#{names[1]}"))
            events.append((OPEN, node, block, None))
            if tag in VOID:
                continue
            if tag in RAW:
                shut = re.compile(rf"</{tag}\b[^>]*>", re.I).search(page, at)
                at = shut.end() if shut else end
                continue
            if m[3].endswith("/"):
                events.append((CLOSE, node, block, None))
                continue
            stack.append(node)
        close(1)
        return events, articles, mains

    def token(self, event: tuple) -> int:
        """Number of the event's token, 0 if it has none."""
        kind, node, _, text = event
        if kind == OPEN:
            return node.path
        if kind == CLOSE:
            return node.path ^ _CLOSED
        if node.article == 1:
            return 0
        told = " ".join(text.split())
        return self.path(-node.path, told) if told else 0

    def tokens(self, page: str) -> np.ndarray:
        found = map(self.token, self.read(page)[0])
        return np.array([t for t in found if t], np.int64)


_PAGE = "__host string, content binary, tokens binary"
_PAGE_ARROW = pa.schema([("__host", pa.string()), ("content", pa.binary()), ("tokens", pa.binary())])
_STATS = "__host string, token long, v1 long, v2 long, pages long"
_STATS_ARROW = pa.schema([("__host", pa.string()), ("token", pa.int64()), ("v1", pa.int64()), ("v2", pa.int64()), ("pages", pa.int64())])
_FACT = "__host string, class int, fact string, n long"
_FACT_ARROW = pa.schema([("__host", pa.string()), ("class", pa.int32()), ("fact", pa.string()), ("n", pa.int64())])


@lean
def _tokens(batches):
    """mapInArrow: digest and token sequence of each page."""
    reader = Reader()
    for batch in batches:
        rows = []
        for host, page in zip(batch.column("__host").to_pylist(), batch.column("html").to_pylist(), strict=True):
            page = page or ""
            rows.append((host, blake2b(page.encode("utf-8", "surrogatepass"), digest_size=16).digest(), reader.tokens(page).tobytes()))
        yield table(_PAGE_ARROW, [list(x) for x in zip(*rows, strict=True)] if rows else [[]] * 3)


@lean
def _vectors(batches):
    """mapInArrow over distinct contents: partial sums of the occurrence vectors by host and token; token 0 counts the contents."""
    for batch in batches:
        hosts, of, token, x = [], [], [], []
        number: dict = {}
        for host, content, seq in zip(*[batch.column(c).to_pylist() for c in ("__host", "content", "tokens")], strict=True):
            if host not in number:
                number[host] = len(hosts)
                hosts.append(host)
            u, n = np.unique(np.frombuffer(seq, np.int64), return_counts=True)
            u, n = np.r_[0, u], np.r_[1, n]
            with np.errstate(over="ignore"):
                x.append(mix(U64(int.from_bytes(content[:8], "little")) ^ mix(n.astype(np.uint64) * U64(0x9E3779B97F4A7C15))))
            token.append(u)
            of.append(np.full(len(u), number[host], np.int64))
        if not hosts:
            continue
        of, token, x = np.concatenate(of), np.concatenate(token), np.concatenate(x)
        order = np.lexsort((token, of))
        of, token, x = of[order], token[order], x[order]
        first = np.flatnonzero(np.r_[True, (of[1:] != of[:-1]) | (token[1:] != token[:-1])])
        v1, v2 = (np.add.reduceat(v.astype(np.int64), first) for v in (x & U64(0xFFFFFFFF), x >> U64(32)))
        yield table(_STATS_ARROW, [pa.array(hosts).take(pa.array(of[first])), token[first], v1, v2, np.diff(np.r_[first, len(of)])])


def _instances(seq: np.ndarray, tokens: set[int], where: dict[int, list[int]]) -> tuple[np.ndarray, list[int] | None]:
    """Positions of a class on a page, a row a repetition, and its order; no order if the tokens do not follow each other in one."""
    at = np.sort(np.concatenate([where[t] for t in tokens])) if all(t in where for t in tokens) else np.zeros(0, np.int64)
    m = len(tokens)
    if not len(at) or len(at) % m:
        return at.reshape(-1, 1), None
    rows = at.reshape(-1, m)
    named = seq[rows]
    if (named != named[0]).any() or len(set(named[0].tolist())) != m:
        return rows, None
    return rows, named[0].tolist()


def page_facts(seq: np.ndarray, classes: list[list[int]]) -> list[tuple[int, str]]:
    """What a page says of its classes: order, classes that hold all of its repetitions in one gap, classes it crosses."""
    known = {t for c in classes for t in c}
    where: dict[int, list] = {}
    for i in np.flatnonzero(np.isin(seq, np.fromiter(known, np.int64, len(known)))).tolist():
        where.setdefault(int(seq[i]), []).append(i)
    found, out = {}, []
    for c, tokens in enumerate(classes):
        if not any(t in where for t in tokens):
            continue
        rows, order = _instances(seq, set(tokens), where)
        out.append((c, "bad" if order is None else "order " + json.dumps(order)))
        if order is not None:
            found[c] = rows
    for c, rows in found.items():
        for p, above in found.items():
            if p == c:
                continue
            line = above.reshape(-1)
            low, high = np.searchsorted(line, rows[:, 0]), np.searchsorted(line, rows[:, -1])
            if (low == high).all():
                gap = set(((low - 1) % above.shape[1]).tolist())
                inside = (low > 0).all() and (low < len(line)).all() and (low % above.shape[1] != 0).all()
                if inside and len(gap) == 1:
                    out.append((c, f"in {p} {gap.pop()}"))
            else:
                back = np.searchsorted(rows.reshape(-1), above[:, 0]), np.searchsorted(rows.reshape(-1), above[:, -1])
                if (back[0] != back[1]).any():
                    out.append((c, f"cross {p}"))
    return out


def assemble(sizes: list[int], facts: list[tuple[int, str, int]]) -> list[dict]:
    """The template of a host: valid classes with their order, parent class (or none) and gap, parents first."""
    seen, order, inside, crossed = {}, {}, {}, []
    for c, fact, n in facts:
        kind, *rest = fact.split(" ", 1)
        if kind in ("bad", "order"):
            seen[c] = seen.get(c, 0) + n
            order.setdefault(c, []).append(None if kind == "bad" else rest[0])
        elif kind == "in":
            p, gap = map(int, rest[0].split())
            inside.setdefault(c, []).append((p, gap, n))
        else:
            crossed.append((c, int(rest[0])))
    valid = {c for c, told in order.items() if len(told) == 1 and told[0] is not None}
    for c, p in sorted(crossed, key=lambda x: -max(sizes[x[0]], sizes[x[1]])):
        if c in valid and p in valid:
            valid.discard(min((c, p), key=lambda k: (sizes[k], -k)))
    above = {c: {p: gap for p, gap, n in inside.get(c, []) if n == seen[c] and p in valid} for c in valid}
    out, number = [], {}
    for c in sorted(valid, key=lambda k: (len(above[k]), k)):
        parent = max((p for p in above[c] if p in number), key=lambda p: (len(above[p]), p), default=None)
        number[c] = len(out)
        out.append({"order": json.loads(order[c][0]), "parent": None if parent is None else number[parent], "gap": None if parent is None else above[c][parent]})
    return out


def _facts(load):
    """mapInArrow over distinct contents with the classes of their hosts: facts, summed over a batch."""

    def run(batches):
        classes_of = load()
        for batch in batches:
            sums: dict = {}
            own = batch.column("__classes").to_pylist() if "__classes" in batch.schema.names else None
            for i, (host, seq) in enumerate(zip(batch.column("__host").to_pylist(), batch.column("tokens").to_pylist(), strict=True)):
                classes = classes_of.get(host) if own is None else own[i]
                if classes:
                    for c, fact in page_facts(np.frombuffer(seq, np.int64), classes):
                        sums[host, c, fact] = sums.get((host, c, fact), 0) + 1
            if sums:
                yield table(_FACT_ARROW, [*[list(x) for x in zip(*sums, strict=True)], list(sums.values())])

    return lean(run)


def _assemble(batches):
    schema = pa.schema([("__host", pa.string()), ("__template", pa.string())])
    for batch in batches:
        hosts, classes, facts = (batch.column(c).to_pylist() for c in ("__host", "__classes", "facts"))
        made = [json.dumps(assemble([len(c) for c in k], [(f["class"], f["fact"], f["n"]) for f in sorted(x, key=lambda f: (f["class"], f["fact"]))])) for k, x in zip(classes, facts, strict=True)]
        yield table(schema, [hosts, made])


def _attach(rows: DataFrame, small: DataFrame, column: str) -> tuple[DataFrame, object]:
    """rows with `column` of small by __host, and a loader of a table host -> value for workers.

    Up to SMALL_BYTES the table is broadcast to the workers and rows stay where they are. Beyond it rows are joined, hosts of many rows dealt over salts.
    """
    size = small.agg(F.coalesce(F.sum(F.length(F.to_json(F.struct(column)))), F.lit(0))).first()[0]
    if size <= SMALL_BYTES:
        shared = rows.sparkSession.sparkContext.broadcast({r[0]: r[1] for r in small.select("__host", column).collect()})
        return rows, lambda: shared.value
    hot = rows.groupBy("__host").agg(F.ceil(F.count(F.lit(1)) / HOT_PAGES).cast("int").alias("__n")).where("__n > 1")  # at most rows / HOT_PAGES
    spread = small.join(hot, "__host", "left").withColumn("__salt", F.explode(F.sequence(F.lit(0), F.coalesce("__n", F.lit(1)) - 1))).select("__host", "__salt", column)
    salted = rows.join(F.broadcast(hot), "__host", "left").withColumn("__salt", F.coalesce(F.pmod(F.xxhash64(*[c for c in ("html", "content") if c in rows.columns]), F.col("__n")), F.lit(0)).cast("int")).drop("__n")
    return salted.join(spread.hint("shuffle_hash"), ["__host", "__salt"], "left").drop("__salt"), dict


def host_templates(pages: DataFrame, support: int = 2) -> DataFrame:
    """__host, __template (JSON of assemble()) of hosts with classes, from pages (__host, html)."""
    seen = pages.mapInArrow(_tokens, _PAGE).repartition(partitions(pages.sparkSession), "__host", "content")  # small, but costly to read: keep it in parts
    contents = materialize(seen.dropDuplicates(["__host", "content"])).repartition(partitions(pages.sparkSession), "content")
    stats = contents.mapInArrow(_vectors, _STATS).groupBy("__host", "token").agg(*[F.sum(c).alias(c) for c in ("v1", "v2", "pages")]).where(F.col("pages") >= support)
    # what one content alone has left with the filter above; of the rest, tokens of half the host's contents are a few for each page
    many = contents.groupBy("__host").agg(F.count(F.lit(1)).alias("all"))
    frequent = stats.where("token <> 0").join(many, "__host").where(F.col("pages") * 2 >= F.col("all"))
    classes = frequent.groupBy("__host", "v1", "v2", "pages").agg(F.array_sort(F.collect_list("token")).alias("tokens")).where(F.size("tokens") >= 2)
    by_host = materialize(classes.groupBy("__host").agg(F.array_sort(F.collect_list("tokens")).alias("__classes")))
    joined, load = _attach(contents.select("__host", "content", "tokens"), by_host, "__classes")
    facts = joined.mapInArrow(_facts(load), _FACT).groupBy("__host", "class", "fact").agg(F.sum("n").alias("n"))
    told = facts.groupBy("__host").agg(F.collect_list(F.struct("class", "fact", "n")).alias("facts"))
    return by_host.join(told, "__host").mapInArrow(_assemble, "__host string, __template string")


def slots(events: list, reader: Reader, template: list[dict]) -> list[tuple | None]:
    """The slot of each event: (class, gap) of the innermost open repetition, (-1, 0) outside all; None for template tokens."""
    place = {t: (c, i, len(x["order"]) - 1) for c, x in enumerate(template) for i, t in enumerate(x["order"])}
    stack, out = [(-1, 0)], []
    for event in events:
        hit = place.get(reader.token(event)) if place else None
        if hit is None:
            out.append(stack[-1])
            continue
        out.append(None)
        c, i, last = hit
        if i:
            for k in range(len(stack) - 1, 0, -1):
                if stack[k][0] == c:
                    del stack[k:]
                    break
        if i < last:
            stack.append((c, i))
    return out


def main_text(page: str, template: list[dict], reader: Reader | None = None) -> str:
    """The main text of a page: its main slots, in page order."""
    reader = reader or Reader()
    events, articles, mains = reader.read(page)
    least = 1 if articles else 2 if mains else 0
    blocks: dict[int, list[str]] = {}
    for (kind, node, block, text), slot in zip(events, slots(events, reader, template), strict=True):
        if kind == TEXT and slot is not None and not node.out and (not least or node.article == 1 or node.article == least):
            blocks.setdefault(block, []).append(text)
    done = (" ".join(html.unescape("".join(x)).split()) for x in blocks.values())
    return "\n".join(x for x in done if x)


def _extract(names: list[str], load):
    def run(batches):
        reader, memo, template_of = Reader(), {}, load()
        for batch in batches:
            texts = []
            own = batch.column("__template").to_pylist() if "__template" in batch.schema.names else None
            for i, (host, page) in enumerate(zip(batch.column("__host").to_pylist(), batch.column("html").to_pylist(), strict=True)):
                if host not in memo:
                    if len(memo) > 1000:
                        memo.clear()
                    memo[host] = json.loads((template_of.get(host) if own is None else own[i]) or "[]")
                texts.append(main_text(page or "", memo[host], reader))
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in names], pa.array(texts, pa.string())], names=[*names, "text"])

    return lean(run)


def extract_main_text(pages: DataFrame, support: int = 2) -> DataFrame:
    """pages (page_id, url, html, any more columns; html left out) with text and n_chars."""
    prepare(pages.sparkSession)
    base = without(pages, "text", "n_chars").withColumn("html", F.col("html").cast("string")).withColumn("__host", F.coalesce(F.regexp_extract("url", "^[a-zA-Z]+://([^/?#]*)", 1), F.lit("")))
    templates = materialize(host_templates(base.select("__host", "html"), support))
    joined, load = _attach(base, templates, "__template")
    names = [c for c in base.columns if c not in ("html", "__host")]
    out = joined.mapInArrow(_extract(names, load), T.StructType([*[base.schema[c] for c in names], T.StructField("text", T.StringType())]))
    return out.withColumn("n_chars", F.length("text").cast("long"))
