import hashlib
import html
import re
import zlib
from collections import defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from pagestrata.llm import media, ngram_join, packing
from pagestrata.llm.chat import digests, format_paths, read_back, threads
from pagestrata.llm.common import connected_components
from pagestrata.llm.html_extract import extract_main_text
from pagestrata.llm.langid import identify_languages
from pagestrata.llm.mixing import mix_sources, source_targets
from pagestrata.llm.ngram_join import drop_near_copies, ngram_classes
from pagestrata.llm.quality import quality_scores
from pagestrata.llm.queries import tokenizer_path
from pagestrata.llm.substring_dedup import levels, substring_dedup
from pagestrata.llm.topk_search import exact_top_k

WORD = re.compile("[^\x20\x09-\x0d]+")
LONG = " ".join(f"w{i % 977}x{i * 7 % 613}" for i in range(20_000))
TEXTS = [None, "", " \n", "one", "a b c d e f g h i j k l m n o p", "x a b c d e f g h i j k l m n o p y", "a b c d e f g h i j k l m n o p", LONG, "z " + LONG, "Ä é 日本語 <|im_end|> \\ <", "q " * 40]


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, t, None if i % 5 == 4 else f"s{i % 3}", None if i % 4 == 3 else "en", i, "kept", i) for i, t in enumerate(TEXTS)]
    rows += [rows[4], (None, "null id", "s0", "en", 1, "kept", 1)]
    return spark.createDataFrame(rows, "doc_id long, text string, source string, lang string, n_words long, score string, size int").repartition(3)


def empty(docs):
    return docs.where("false")


def expected_dedup(rows, length=13):
    first = {}
    for d, t in sorted((r for r in rows if r[0] is not None), key=lambda r: r[0]):
        w = WORD.findall(t or "")
        for i in range(len(w) - length + 1):
            first.setdefault(tuple(w[i : i + length]), d)
    out = {}
    for d, t in rows:
        w = WORD.findall(t or "")
        gone = {j for i in range(len(w) - length + 1) if d is not None and first[tuple(w[i : i + length])] < d for j in range(i, i + length)}
        out[d] = (len(w), len(gone), " ".join(x for j, x in enumerate(w) if j not in gone))
    return out


@pytest.mark.parametrize("length", [5, 13, 30])
def test_substring_dedup(docs, length):
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    want = expected_dedup(rows, length)
    got = substring_dedup(docs, length, digest=True).collect()
    assert len(got) == len(rows)
    assert {r.doc_id: (r.n_words, r.n_removed, r.kept_sha256) for r in got} == {d: (a, b, hashlib.sha256(t.encode()).hexdigest()) for d, (a, b, t) in want.items()}
    text = {r.doc_id: r.text for r in substring_dedup(docs, length).collect()}
    assert text[0] is None and text[1] == "" and " ".join(WORD.findall(text[8])) == want[8][2]
    assert substring_dedup(empty(docs), length).count() == 0


def test_levels_at_most_double():
    for n in (1, 7, 13, 50, 200):
        steps = levels(n)
        assert steps[-1] == n and all(b <= 2 * a for a, b in zip(steps, steps[1:], strict=False))


def alike():
    """Two different words of 1,024 characters that collide under every polynomial hash modulo 2^64 with an odd base."""
    x, y = "a", "b"
    for _ in range(10):
        x, y = x + y, y + x
    return x, y


def test_words_of_one_polynomial_hash_stay_apart(spark):
    x, y = alike()
    docs = spark.createDataFrame([(1, " ".join([x] * 13)), (2, " ".join([y] * 13)), (3, f"{x} {y} {x}"), (4, f"{y} {x} {x}")], "doc_id long, text string")
    assert [r.n_removed for r in substring_dedup(docs, 13, digest=True).collect()] == [0] * 4
    assert {r.doc_id: r.component_id for r in ngram_classes(docs, 3, 90).collect()} == {i: i for i in (1, 2, 3, 4)}


def test_user_columns_stay(docs):
    own = docs.selectExpr("doc_id", "text", "'k' AS key", "'p' AS places", "'s' AS kept_sha256", "1 AS n_removed")
    got = substring_dedup(own, 13)
    assert got.columns == ["doc_id", "text", "key", "places", "kept_sha256", "n_words", "n_removed"] and {tuple(r) for r in got.select("key", "places", "kept_sha256").collect()} == {("k", "p", "s")}


@pytest.mark.parametrize("hot", [1 << 16, 3])
def test_large_buckets_are_dealt_over_blocks(spark, monkeypatch, hot):
    """Groups of near copies that share their rare shingles, and unlike texts that share one shingle, in buckets of at most three entries a block."""
    monkeypatch.setattr(ngram_join, "HOT_ENTRIES", hot)
    monkeypatch.setattr(ngram_join, "CHUNK_PAIRS", 5)
    rng = np.random.default_rng(11)
    base = [f"v{i}" for i in range(60)]
    texts = []
    for i in range(30):
        t = list(base)
        for j in rng.integers(0, 60, rng.integers(0, 4)):
            t[j] = f"x{rng.integers(0, 90)}"
        texts.append(" ".join(t))
    texts += [f"same first words {' '.join(f'u{i}_{j}' for j in range(3))}" for i in range(12)]
    rows = list(enumerate(texts))
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in ngram_classes(spark.createDataFrame(rows, "doc_id long, text string").repartition(3), 3, 80).collect()}
    assert got == expected_classes(rows, 3, 80)


def test_eight_documents_all_linked_have_seven_links_each(spark):
    base = [f"v{i}" for i in range(200)]
    rows = [(i, " ".join([*base[:i], f"n{i}", *base[i + 1 :]])) for i in range(8)]
    assert [r.n_links for r in ngram_classes(spark.createDataFrame(rows, "doc_id long, text string"), 3, 80).collect()] == [7] * 8


def expected_classes(rows, k, percent):
    sets = {}
    for d, t in rows:
        w = WORD.findall((t or "").lower())
        sets[d] = {tuple(w[i : i + k]) for i in range(max(1, len(w) - k + 1))} if w else set()
    up = {d: d for d in sets}

    def root(d):
        while up[d] != d:
            d = up[d]
        return d

    for a in sets:
        for b in sets:
            both = len(sets[a] & sets[b])
            if a < b and both and 100 * both >= percent * (len(sets[a]) + len(sets[b]) - both):
                x, y = sorted((root(a), root(b)))
                up[y] = x
    return {d: (len(s), root(d)) for d, s in sets.items()}


def test_ngram_classes(spark, docs):
    rng = np.random.default_rng(1)
    words = [f"v{i}" for i in range(60)]
    texts = []
    for g in range(6):
        base = [words[i] for i in rng.integers(0, 60, 90)]
        for _ in range(12):
            t = list(base)
            for j in rng.integers(0, 90, rng.integers(0, 4)):
                t[j] = words[rng.integers(0, 60)]
            texts.append(" ".join(t))
    rows = [(i, t) for i, t in enumerate([*TEXTS, *texts])]
    assert [r.component_id for r in ngram_classes(spark.createDataFrame([(None, "a b c d"), (None, "a b c d")], "doc_id long, text string"), 3, 90).collect()] == [None, None]
    made = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    for k, percent in ((3, 90), (5, 80)):
        got = {r.doc_id: (r.n_shingles, r.component_id) for r in ngram_classes(made, k, percent).collect()}
        assert got == expected_classes(rows, k, percent)
    assert ngram_classes(empty(docs), 3, 90).count() == 0
    assert drop_near_copies(docs).where("doc_id = 6").count() == 0


@pytest.mark.parametrize("block", [1024, 7])
def test_ngram_links_are_all_counted(spark, monkeypatch, block):
    monkeypatch.setattr(ngram_join, "BLOCK_CLASSES", block)
    rng = np.random.default_rng(8)
    texts = [None, "", "one"]
    for size, group in ((100, 40), (150, 3), (60, 9)):
        base = [f"v{i}" for i in rng.integers(0, 500, size)]
        for _ in range(group):
            t = list(base)
            for j in rng.integers(0, size, rng.integers(0, 4)):
                t[j] = f"v{rng.integers(0, 500)}"
            texts.append(" ".join(t[rng.integers(0, 9) :]))
    rows = [*enumerate([*texts, texts[5], texts[6]]), (7, texts[8]), (7, texts[7])]
    words = {t: WORD.findall(t or "") for _, t in rows}
    sets = {t: frozenset(tuple(w[i : i + 3]) for i in range(max(1, len(w) - 2))) if w else frozenset() for t, w in words.items()}
    like = lambda a, b: 100 * len(a & b) >= 80 * len(a | b)
    want = sorted((d, sum(like(sets[t], x) for x in set(sets.values()) if x and x != sets[t]) if sets[t] else 0) for d, t in rows)
    got = sorted((r.doc_id, r.n_links) for r in ngram_classes(spark.createDataFrame(rows, "doc_id long, text string").repartition(3), 3, 80).collect())
    assert got == want and max(n for _, n in want) > 20


def test_range_counts_do_not_wrap(monkeypatch):
    from types import SimpleNamespace

    monkeypatch.setattr(ngram_join, "RANGES", 1)
    base = " ".join(f"w{i}" for i in range(65_500))
    texts = pa.RecordBatch.from_pydict({"doc_id": [1, 2], "text": [base, base + "".join(f" x{i}" for i in range(100))]})
    level = SimpleNamespace(value=np.zeros(ngram_join.CELLS, np.uint32))
    made = [r for out in ngram_join._sets(3, 90, level)([texts]) for r in out.select(["n", "ranges"]).to_pylist()]
    pair = {"a": [1], "b": [2]} | {f"n{x}": pa.array([made[i]["n"]], pa.int32()) for i, x in enumerate("ab")} | {f"r{x}": [made[i]["ranges"]] for i, x in enumerate("ab")}
    assert sum(len(x) for x in ngram_join._suffix(90)([pa.RecordBatch.from_pydict(pair)])) == 1


def test_components_of_a_path(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(40)] + [(100, 101), (101, 101), (None, 3)], "a long, b long")
    got = {r.id: r.component for r in connected_components(edges).collect()}
    assert got == {i: 0 for i in range(41)} | {100: 100, 101: 100}


def test_top_k(spark):
    rng = np.random.default_rng(2)
    rows = [(i, rng.normal(0, 0.3, 8).astype(float).tolist()) for i in range(300)] + [(300, None), (301, [float("nan")] * 8), (320, [0.0] * 8), (303, [0.0] * 8), (340, [None] * 8)]
    got = defaultdict(list)
    for r in exact_top_k(spark.createDataFrame(rows, "vec_id long, embedding array<float>").repartition(4), k=7).orderBy("query_id", "rank").collect():
        got[r.query_id].append((r.vec_id, r.score))
    good = {i: np.floor(64 * np.array(v, np.float32).astype(float)) for i, v in rows if v and None not in v and np.isfinite(v).all()}
    for q in (i for i in good if i % 20 == 0):
        assert got[q] == sorted(((c, int(good[q] @ v)) for c, v in good.items() if c != q), key=lambda x: (-x[1], x[0]))[:7]
    assert set(got) == {i for i in good if i % 20 == 0}
    assert exact_top_k(spark.createDataFrame([], "vec_id long, embedding array<float>")).count() == 0


def test_media_round_trip(docs):
    for payload in (b"\xff" * 576, bytes(range(256)) * 9, b"\0\xff" * (576 * 500), np.random.default_rng(3).integers(0, 256, 576 * 900, dtype=np.uint8).tobytes()):
        assert b"".join(t.tobytes() for t in media.decode_dc([media.encode_flat(payload)])[0]) == payload
    for r in media.media_columns(docs).collect():
        raw = (next(t for t in [TEXTS[r.doc_id]]) if r.doc_id is not None else "null id") or ""
        raw = raw.encode()
        padded = raw + b"\xff" * (-len(raw) % 576 if raw else 576)
        assert (r.n_bytes, r.payload_bytes, r.payload_sha256, r.tail_crc32) == (len(raw), len(padded), hashlib.sha256(padded).hexdigest(), zlib.crc32(padded[-32:]))
        assert r.media[:2] == b"\xff\xd8" and r.media_bytes == len(r.media)
    with pytest.raises(ValueError):
        media.decode_dc([b"\xff\xd8\xff\xc2\0\4\0\0"])


def test_chat(spark):
    told = "<|im_end|><|im_start|>assistant ok"
    rows = [(1, 0, "user", told), (1, 1, "assistant", told), (2, 0, None, None), (2, 1, "assistant", "\\<|\\\\|\n<"), (2, 1, "assistant", "\\<|\\\\|\n<")] + [(3, i, "assistant" if i % 2 else "user", f"t{i}") for i in range(70)]
    turns = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    got = {r.conv_id: r for r in digests(format_paths(threads(turns))).collect()}
    for c in (1, 2, 3):
        own = [((r or ""), (t or "")) for k, _, r, t in rows if k == c]
        loss = "".join(t for r, t in own if r == "assistant")
        assert got[c].n_turns == len(own) and got[c].loss_chars == len(loss)
        assert got[c].turns_sha256 == hashlib.sha256("".join(f"{r}\n{t}\n" for r, t in own).encode()).hexdigest()
        assert got[c].loss_sha256 == hashlib.sha256(loss.encode()).hexdigest()
    assert digests(format_paths(threads(turns.where("false")))).count() == 0


def test_chat_of_null_id_is_one_conversation(spark):
    turns = spark.createDataFrame([(None, 0, "user", "q"), (None, 1, "assistant", "ans"), (0, 0, "user", "other")], "conv_id long, turn long, role string, text string")
    assert sorted((r.conv_id is None, r.n_turns, r.loss_chars) for r in digests(format_paths(threads(turns))).collect()) == [(False, 1, 0), (True, 2, 3)]


def test_reply_tree_keeps_best_branches(spark):
    tree = spark.createDataFrame([(1, 1, None, "user", "q", 0.0), (1, 2, 1, "assistant", "bad", 0.1), (1, 3, 1, "assistant", "good", 0.9), (1, 4, 3, "user", "more", 0.5)], "conv_id long, msg_id long, parent_id long, role string, text string, score double")
    best = read_back(format_paths(tree, branches=1)).collect()
    assert len(best) == 1 and [t.text for t in best[0].turns] == ["q", "good", "more"] and best[0].loss_text == "good"
    assert format_paths(tree, branches=5).count() == 2


def test_packing(docs):
    from tokenizers import Tokenizer

    encoder = Tokenizer.from_file(tokenizer_path())
    got = packing.pack_documents(docs, tokenizer_path()).collect()
    want = defaultdict(int)
    for r in docs.collect():
        ids = np.array([*encoder.encode(r.text or "", add_special_tokens=False).ids, 2], "<u4")
        head = len(ids) % 1024 or 1024 if len(ids) > 1024 else len(ids)
        for piece, start in enumerate([0, *range(head, len(ids), 1024)]):
            stop = start + 1024 if piece else head
            want[(r.doc_id, piece, start, stop - start, zlib.crc32(ids[start:stop].tobytes()))] += 1
    have = defaultdict(int)
    bins = defaultdict(list)
    for r in got:
        have[(r.doc_id, r.piece, r.start, r.length, r.ids_crc32)] += 1
        bins[r.sequence_id].append((r.offset, r.length))
    assert have == want
    for parts in bins.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 1024
    assert packing.pack_documents(empty(docs), tokenizer_path()).count() == 0


def test_plan_fills_bins():
    rng = np.random.default_rng(4)
    counts = {int(k): int(v) for k, v in zip(*np.unique(rng.integers(1, 1025, 3000), return_counts=True), strict=True)}
    bins = packing.plan(dict(counts), 1024)
    used = defaultdict(int)
    for lengths, times in bins:
        assert sum(lengths) <= 1024
        for x in lengths:
            used[x] += times
    assert used == counts
    assert sum(t for _, t in bins) <= 1.02 * -(-sum(k * v for k, v in counts.items()) // 1024) + 1


def test_mixing(spark, docs):
    rng = np.random.default_rng(5)
    rows = [(i, "w " * int(rng.integers(0, 60)), f"s{i % 3}" if i % 7 else None) for i in range(400)]
    made = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = mix_sources(made).collect()
    assert len(got) == 400 and all(r.taken in (0, r.size, 2 * r.size) for r in got)
    for s in {r.source for r in got}:
        own = [r for r in got if r.source == s]
        assert sum(r.size for r in own) == own[0].source_size and abs(sum(r.taken for r in own) - own[0].target) <= 30
    assert abs(sum({r.source: r.target for r in got}.values()) - 1.5 * sum(r.size for r in got)) < 1e-6
    assert sorted((r.doc_id, r.taken) for r in mix_sources(made.repartition(7)).collect()) == sorted((r.doc_id, r.taken) for r in got)
    assert mix_sources(docs).count() == docs.count() and mix_sources(empty(docs)).count() == 0


def test_targets_stop_and_share_again(spark):
    sizes = spark.createDataFrame([("a", 10), ("b", 100), (None, 90)], "source string, source_size long")
    got = {r.source: r.target for r in source_targets(sizes).collect()}
    assert got["a"] == 20 and abs(got["b"] + got[None] - 280) < 1e-9 and got[None] == 180


def test_html(spark):
    page = "<html><head><title>no</title><script>var a='<p>no</p>'</script></head><body><header><h1>Site</h1></header><nav><a>menu</a></nav><div class='cookie-notice'>no</div><article><h2>Head &amp; more</h2><p>One <b>two</b>\n three<br>four<p>Five &eacute;<aside>no</aside><div class='comments'>no</div><form>no</form></article><footer>no</footer></body></html>"
    rows = [(1, "http://a.b/x", page), (2, "http://a.b/y", None), (3, None, ""), (4, "http://a.b/z", "<p>plain text only <i>here</i>"), (5, "http://a.b/w", "<article>cut")]
    got = {r.page_id: r.text for r in extract_main_text(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert got == {1: "Head & more\nOne two three four\nFive " + html.unescape("&eacute;"), 2: "", 3: "", 4: "plain text only here", 5: "cut"}


def test_html_keeps_copied_and_split_text(spark):
    def page(*parts):
        return "<body><div class='top'>Site name</div>" + "".join(f"<div class='part{i}'><p>{x}</p></div>" for i, x in enumerate(parts)) + "</body>"

    pages = [("a", page("One two.", "Three.")), ("a", page("One two.", "Three.")), ("b", page("Long text of b.", "Short.")), ("b", page("Shared.", "Other.")), ("b", page("Shared.", "Third.")), ("b", page("Shared.", "Other."))]
    rows = [(i, f"http://{h}.c/{i}", x) for i, (h, x) in enumerate(pages)]
    got = {r.page_id: r.text for r in extract_main_text(spark.createDataFrame(rows, "page_id long, url string, html string").repartition(3)).collect()}
    whole = "Site name\nOne two.\nThree."  # one content is no evidence of a template
    assert got == {0: whole, 1: whole, 2: "Long text of b.\nShort.", 3: "Shared.\nOther.", 4: "Shared.\nThird.", 5: "Shared.\nOther."}


def test_quality(spark, docs):
    rng = np.random.default_rng(6)
    good, bad = ["river", "house", "green", "walks", "and"], ["buy", "click", "$$$", "now", "win"]
    rows = [(i, " ".join(rng.choice(good if i % 3 else bad, 12)) if i % 50 else None) for i in range(600)]
    texts = spark.createDataFrame(rows, "doc_id long, text string")
    labels = texts.select("doc_id", (F.col("doc_id") % 3 != 0).cast("int").alias("quality"))
    got = quality_scores(texts, labels).collect()
    assert len(got) == 600 and all(0 <= r.score <= 1 for r in got)
    held = [r for r in got if r.held_out and r.doc_id % 50]
    assert np.mean([r.predicted == (r.doc_id % 3 != 0) for r in held]) > 0.97
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in got)
    assert quality_scores(empty(docs), labels).count() == 0 and quality_scores(docs, labels.where("false")).where("predicted = 1").count() == docs.count()


def test_language(spark, docs):
    rng = np.random.default_rng(7)
    stock = {"de": ["haus", "straße", "und", "nicht"], "fr": ["maison", "les", "été", "dans"]}
    rows = [(i, " ".join(rng.choice(stock[lang], 9)), lang) for i, lang in enumerate(["de", "fr"] * 150)] + [(900, None, "de"), (901, "12 34 !", "fr"), (902, "haus und", None)]
    got = {r.doc_id: r for r in identify_languages(spark.createDataFrame(rows, "doc_id long, text string, lang string")).collect()}
    assert np.mean([got[i].lang_pred == lang for i, _, lang in rows[:300]]) == 1
    assert [got[i].lang_pred for i in (900, 901, 902)] == ["und", "und", "de"]
    assert identify_languages(empty(docs)).count() == 0


def test_chunks_encode_like_whole_texts():
    import random

    from tokenizers import Tokenizer

    encoder = Tokenizer.from_file(tokenizer_path())
    rng = random.Random(1)
    bits = [" ", " ", "  ", "\n", "\r\n", "\t", " ", "　", " ", "\u0085", "\x1c", "a", "Bc", "it's", "'", "'street", "é", "—", "“", "12", "!", ".", "<|endoftext|>", "漢", "🙂", "|", "_"]
    texts = [None, "", " ", "\n", "a ", *("".join(rng.choice(bits) for _ in range(rng.randint(0, 14))) for _ in range(20_000))]
    ids, at = packing._encode(pa.array(texts, pa.string()), tokenizer_path())
    for text, low, high in zip(texts, at[:-1], at[1:], strict=True):
        assert ids[low:high].tolist() == [*encoder.encode(text or "", add_special_tokens=False).ids, 2], repr(text)


def test_special_strings_are_one_id(spark):
    from tokenizers import Tokenizer

    encoder = Tokenizer.from_file(tokenizer_path())
    assert 50256 in encoder.encode("a<|endoftext|>b", add_special_tokens=False).ids
    texts = ["<|endoftext|>", " <|endoftext|> ", "<|endoftext|><|endoftext|>x", "a\n<|endoftext|>\n<|endof", "text|> y <|endoftext|", ">"]
    ids, at = packing._encode(pa.array(texts), tokenizer_path())
    assert [ids[a:b].tolist() for a, b in zip(at[:-1], at[1:], strict=True)] == [[*encoder.encode(t, add_special_tokens=False).ids, 2] for t in texts]


def test_fullest_is_the_best_of_all_combinations():
    import itertools

    rng = np.random.default_rng(9)
    for _ in range(60):
        lengths = rng.integers(1, 40, rng.integers(0, 9)).tolist()
        counts = {x: lengths.count(x) for x in lengths}
        limit = int(rng.integers(1, 90))
        got = packing.fullest(limit, counts)
        best = max((s for n in range(len(lengths) + 1) for c in itertools.combinations(lengths, n) if (s := sum(c)) <= limit), default=0)
        assert sum(got) == best and all(got.count(x) <= counts[x] for x in got)


def test_memo_is_bounded_by_bytes(monkeypatch):
    monkeypatch.setattr(packing, "MEMO_BYTES", 2000)
    memo = packing._Chunks(tokenizer_path())
    for i in range(20):
        memo.numbers([f" {'x' * 300}{i}"])
    assert memo.n_bytes < 5000


def baseline(values, hv=((1, 1),), split=False):
    """A JPEG of flat blocks: values[c] is the plane of component c in blocks; split gives each component its own scan."""
    parts = []
    for plane in values:
        one = media._picture(plane.reshape(-1), plane.shape[1])
        start = one.index(b"\xff\xda")
        parts.append((one[:start], one[start + 10 : -2]))
    rows, cols = values[0].shape
    h0, v0 = hv[0]
    size = (8 * rows).to_bytes(2, "big") + (8 * cols).to_bytes(2, "big")
    n = len(values)
    frame = media._segment(0xC0, b"\x08" + size + bytes([n]) + b"".join(bytes((c + 1, hv[c][0] * 16 + hv[c][1], 0)) for c in range(n)))
    tables = media._segment(0xDB, b"\0" + bytes([8] * 64)) + media._segment(0xC4, b"\0" + bytes(media.DC_LENGTHS) + bytes(media.DC_VALUES)) + media._segment(0xC4, b"\x10" + bytes((1, *[0] * 15)) + b"\0")
    scans = b"".join(media._segment(0xDD, values[c].shape[1].to_bytes(2, "big")) + media._segment(0xDA, bytes((1, c + 1, 0, 0, 63, 0))) + data for c, (_, data) in enumerate(parts))
    return b"\xff\xd8" + tables + frame + scans + b"\xff\xd9"


def test_pictures_with_a_scan_for_each_component():
    rng = np.random.default_rng(12)
    luma, small = rng.integers(0, 256, (6, 8)).astype(np.uint8), rng.integers(0, 256, (3, 4)).astype(np.uint8)
    assert (media.decode_dc([baseline([luma, luma[::-1], luma.T.reshape(6, 8)], ((1, 1),) * 3)])[0][0] == luma).all()
    assert (media.decode_dc([baseline([luma, small, small], ((2, 2), (1, 1), (1, 1)))])[0][0] == luma).all()
    for broken in (b"\xff\xd8\xff\xd9", b"\xff\xd8" + media._segment(0xDA, bytes((1, 1, 0, 0, 63, 0))) + b"\0\xff\xd9"):
        with pytest.raises(ValueError):
            media.decode_dc([broken])


def test_features_against_plain_loops(docs):
    for r in media.media_columns(docs.where("doc_id IN (4, 7)")).collect():
        size, digest = r.feature.split(":")
        width, height = map(int, size.split("x"))
        payload = TEXTS[r.doc_id].encode()
        payload += b"\xff" * (-len(payload) % 576)
        assert width * height == 64 * len(payload) and hashlib.sha256(r.media).hexdigest() == r.media_sha256
        cols, rows = width // 8, height // 8
        at = lambda n, k: [int(x) for x in np.linspace(0, n, k + 1)]
        ys, xs = at(rows, 8), at(cols, 9)
        cell = lambda i, j: np.mean([payload[y * cols + x] for y in range(min(ys[i], max(ys[i + 1], ys[i] + 1) - 1), min(max(ys[i + 1], ys[i] + 1), rows)) for x in range(xs[j], max(xs[j + 1], xs[j] + 1))])
        bits = "".join("1" if cell(i, j) < cell(i, j + 1) else "0" for i in range(8) for j in range(8))
        assert f"{int(bits, 2):016x}" == digest
    assert media.media_columns(empty(docs)).count() == 0 and "source" not in media.media_columns(docs).columns


def test_top_k_of_odd_tables(spark, monkeypatch):
    """Vectors of several lengths, repeated ids and rows, null ids, several shards, blocks and chunks."""
    from pagestrata.llm import topk_search

    monkeypatch.setattr(topk_search, "CHUNK_ROWS", 7)
    rng = np.random.default_rng(13)
    rows = [(i, rng.normal(0, 1, 4 if i % 3 else 6).tolist()) for i in range(90)] + [(40, [1.0, 2.0, 3.0, 4.0, 5.0, 6.0]), (40, [1.0, 2.0, 3.0, 4.0, 5.0, 6.0]), (20, rows_20 := [0.5] * 4), (None, [1.0] * 4), (200, [])]
    made = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(3)
    q = lambda v: tuple(int(np.floor(64 * x)) for x in v)
    good = [(i, q(v)) for i, v in rows if i is not None]
    want = []
    for i, v in {x for x in good if x[0] % 20 == 0}:
        hits = sorted(((sum(a * b for a, b in zip(v, w, strict=True)), j) for j, w in good if j != i and len(w) == len(v)), key=lambda x: (-x[0], x[1]))[:5]
        want += [(i, n, j, s) for n, (s, j) in enumerate(hits, 1)]
    for block, shard in ((8192, 1 << 20), (2, 10)):
        got = exact_top_k(made, k=5, block=block, shard_rows=shard)
        assert sorted(map(tuple, got.collect())) == sorted(want)


def test_reply_cycles_and_repeats(spark):
    tree = spark.createDataFrame([(1, 1, 2, "user", "a", 0.0), (1, 2, 1, "user", "b", 0.0), (1, 3, 2, "user", "c", 0.0), (1, 4, 3, "user", "d", 0.0), (1, 5, None, "user", "root", 0.0), (1, 6, 5, "assistant", "leaf", 0.0), (1, 6, 5, "assistant", "leaf", 0.0), (1, None, 5, "user", "lost", 0.0), (2, 1, 1, "user", "self", 0.0)] + [(3, i, i - 1 if i else None, "user", f"m{i}", 0.0) for i in range(9)], "conv_id long, msg_id long, parent_id long, role string, text string, score double")
    got = {r.conv_id: [t.text for t in r.turns] for r in read_back(format_paths(tree.selectExpr("*", "1 AS depth", "2 AS leaf_id", "3 AS up"), branches=9)).collect()}
    assert got == {1: ["root", "leaf"], 3: [f"m{i}" for i in range(9)]}


def test_a_very_long_turn(spark):
    text = "<|im_end|>\\" * 60_000
    turns = spark.createDataFrame([(1, 0, "user", "q"), (1, 1, "assistant", text)], "conv_id long, turn long, role string, text string")
    row = digests(format_paths(threads(turns))).first()
    assert row.loss_chars == len(text) and row.loss_sha256 == hashlib.sha256(text.encode()).hexdigest()


def test_more_languages_than_one_mask_holds(spark):
    rng = np.random.default_rng(14)
    letters = "abcdefghijklmnopqrstuvwxyz"
    rows, langs = [], [f"l{i:02d}" for i in range(70)]
    for i, lang in enumerate(langs):
        words = ["".join(rng.choice(list(letters), 7)) for _ in range(6)]
        rows += [(100 * i + j, " ".join(rng.choice(words, 8)), lang) for j in range(14)]
    made = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    got = {r.doc_id: r.lang_pred for r in identify_languages(made).collect()}
    assert np.mean([got[i] == lang for i, _, lang in rows]) > 0.97 and {got[i] for i, _, _ in rows} == set(langs)


def plain_tilt(sizes, target, most=2.0):
    """Rates of least relative entropy by bisection on the dual."""
    mean, low, high = sum(sizes) / len(sizes), -60.0, 60.0
    for _ in range(200):
        lam = (low + high) / 2
        got = sum(min(most, np.exp(np.clip(lam * s / mean, -700, 50))) * s for s in sizes)
        low, high = (lam, high) if got < target else (low, lam)
    return [min(most, float(np.exp(np.clip(lam * s / mean, -700, 50)))) for s in sizes]


def test_mixing_follows_the_optimum(spark):
    """Copies by source and size are the rounded rates of a plain solver, up to the copies moved to meet the target; clashing columns stay."""
    rng = np.random.default_rng(15)
    rows = [(i, "w " * int(rng.integers(1, 30)), f"s{i % 4}", "u") for i in range(600)]
    made = spark.createDataFrame(rows, "doc_id long, text string, source string, each string").selectExpr("*", "1 AS n", "2 AS k", "3 AS _key", "4 AS extra", "5 AS row", "6 AS target")
    got = mix_sources(made).collect()
    assert {(r.each, r.n, r.k, r._key, r.extra, r.row) for r in got} == {("u", 1, 2, 3, 4, 5)}
    for s in {r.source for r in got}:
        own = [r for r in got if r.source == s]
        assert {r.source_taken for r in own} == {sum(r.taken for r in own)} and abs(own[0].source_taken - own[0].target) <= 1
        if own[0].target < 2 * own[0].source_size:
            rates = plain_tilt([r.size for r in own], own[0].target)
            off = 0.0
            for size in {r.size for r in own}:
                pick = [i for i, r in enumerate(own) if r.size == size]
                off += abs(sum(own[i].copies for i in pick) - sum(rates[i] for i in pick))
            assert off <= len({r.size for r in own}) + 4


def pipeline_docs(spark, path, rows):
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars int").write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame([(r[0], int("$$$" not in (r[1] or "")), 0) for r in rows if r[0] is not None], "doc_id long, quality int, toxic int").write.parquet(f"{path}/labels.parquet")


def test_pipeline_stages(spark, tmp_path):
    """Each stage on its predecessor's rows against plain loops, with null, empty and repeated rows, null ids, and a very long text."""
    import corpus_pipeline as P

    rng = np.random.default_rng(16)
    plain = [f"w{i}" for i in range(300)]
    rows = [(i, " ".join(rng.choice(plain, 60)) + (" buy now $$$ click" * 6 if i % 4 == 0 else ""), "en", f"s{i % 3}", 0) for i in range(120)]
    rows += [(200, rows[1][1], "en", "s0", 0), (201, rows[1][1] + " end", "en", "s1", 0), (202, "x " + " ".join(rows[2][1].split()[:30]) + " y z", "en", None, 0), (203, None, "en", "s1", 0), (204, "", "en", "s1", 0), (205, LONG, "en", "s2", 0), (None, "null id of words", "en", "s2", 0)]
    pipeline_docs(spark, str(tmp_path), rows)
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    names = docs.columns
    kept = {}
    for name, stage in P.STAGES[:-1]:
        after = stage(spark, docs, str(tmp_path))
        assert after.columns == names, name
        after.write.parquet(f"{tmp_path}/{name}")
        before, docs = docs, spark.read.parquet(f"{tmp_path}/{name}")
        kept[name] = [(r.doc_id, r.text) for r in docs.collect()]
        if name == "quality":
            scored = quality_scores(before, spark.read.parquet(f"{tmp_path}/labels.parquet"), threshold=0.7).where("predicted = 1").select("doc_id")
            assert sorted(str(d) for d, _ in kept[name]) == sorted(str(r.doc_id) for r in scored.collect())
            clean = {r[0] for r in rows if r[0] is not None and r[1] and "$$$" not in r[1]}
            assert len({d for d, _ in kept[name]} & clean) >= 0.95 * len(clean) and not any("$$$" in (t or "") for _, t in kept[name])
            last = [(r.doc_id, r.text) for r in before.join(scored, "doc_id", "left_semi").collect()]
            assert len(last) <= len(kept[name])
        elif name == "near copies":
            want = expected_classes([x for x in last_rows if x[0] is not None], 5, 80)
            assert sorted(d for d, _ in kept[name] if d is not None) == sorted(d for d, (_, c) in want.items() if c == d)
        elif name == "repeated passages":
            want = expected_dedup(last_rows)
            assert all(WORD.findall(t or "") == WORD.findall(want[d][2]) for d, t in kept[name]) and len(kept[name]) == len(last_rows)
            assert all(r.n_chars == (None if r.text is None else len(r.text)) for r in docs.collect())
        else:
            assert {d for d, _ in kept[name]} <= {d for d, _ in last_rows} and max(kept[name].count(x) for x in set(kept[name])) <= 2
        last_rows = kept[name]
    packed = P.STAGES[-1][1](spark, docs, str(tmp_path)).collect()
    assert {r.doc_id for r in packed} == {d for d, _ in last_rows}
    assert sorted(tuple(r) for r in P.run(spark, str(tmp_path)).select("doc_id", "piece", "ids_crc32").collect()) == sorted((r.doc_id, r.piece, r.ids_crc32) for r in packed) if None not in {r.doc_id for r in packed} else True


def test_driver_hands_native_memory_back_after_each_table(spark, monkeypatch):
    from pagestrata.llm import common

    assert "Trim native heap" in common.trim_driver(spark)
    said, trim = [], common.trim_driver
    monkeypatch.setattr(common, "trim_driver", lambda s: said.append(trim(s)))
    assert common.materialize(spark.range(3)).count() == 3 and len(said) == 1 and said[0]


def test_stored_pictures_are_small(spark):
    from pathlib import Path
    from urllib.parse import urlparse

    text = " ".join(f"the river of number {i} runs down to the sea" for i in range(600)).encode()
    payload = text[: len(text) // 576 * 576]
    assert len(media.encode_flat(payload)) < 1.25 * len(payload)  # a segment for each 24 blocks took 1.32
    stored = media.store_media(spark.createDataFrame([(i, payload.decode()) for i in range(40)], "doc_id long, text string").coalesce(1))
    files = list(Path(urlparse(stored._table_path).path).glob("*.parquet"))
    assert sum(f.stat().st_size for f in files) < 0.2 * stored.selectExpr("sum(length(media))").first()[0]  # copies in one page are found
