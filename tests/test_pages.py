import duckdb
import numpy as np
import pandas as pd
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from pagestrata import catalog
from pagestrata.functions import geometry as G
from pagestrata.functions import text as X
from pagestrata.functions import vocabulary as V
from pagestrata.operators import evidence as E
from pagestrata.operators import labels as L
from pagestrata.operators import lines as W
from pagestrata.operators import pages as P
from pagestrata.sources import page_segments, page_words, text_pages
from pagestrata.streaming import answer, collect, run_jobs

SF = "/root/testdata/sf0.001"


def one(spark, column, value):
    return spark.createDataFrame([(value,)], "x string").select(column.alias("y")).first()[0]


@pytest.mark.parametrize("text, hit", [("Fig. 1", True), ("Figure 2.1", True), ("Tab 3.1.2", True), ("1.2.3", True), ("Abbildung 4.1", True), ("Fig 1: something here", True), ("12 Sand", True), ("This is Fig. 1", False), ("We refer to Table 2", False), ("Abbildungen are useful", False), ("123 m", False)])
def test_captions(spark, text, hit):
    assert one(spark, X.any_of(F.col("x"), [X.CAPTION]), text) is hit


@pytest.mark.parametrize("raw, label", [("`\"Title.\"`", "title_page"), ("**MAPS**", "map"), ("**Map.**", "unknown"), ("Geo Profile:", "geo_profile"), ("foo", "unknown")])
def test_label_cleanup(spark, raw, label):
    assert one(spark, L.normalise_label(F.col("x")), raw) == label


def test_greedy_clusters_keep_founding_keys(spark):
    row = spark.sql("SELECT array(10d, 15d, 21d, 11d, 40d) AS k").select(G.greedy_clusters(F.col("k"))).first()
    assert list(row[0]) == [0, 0, 1, 0, 2]


@pytest.mark.parametrize("x0, y0, sizes", [([100] * 3, [100, 145, 190], [3]), ([100, 102, 300, 298], [100, 130, 100, 130], [2, 2]), ([100, 104, 108], [100, 130, 160], [3]), ([100, 300, 500], [100, 300, 500], []), ([100] * 3, [100, 160, 210], [])])
def test_aligned_clusters(x0, y0, sizes):
    got = G.aligned_clusters(np.array(x0, float), np.array(y0, float), np.full(len(x0), 10.0), 5.0)
    assert sorted(map(len, got)) == sorted(sizes)


def test_union_area():
    assert G.union_area_of(np.array([[0, 0, 2, 2], [1, 1, 3, 3], [5, 5, 5, 9]], float)) == 7
    assert G.union_area_of(np.zeros((0, 4))) == 0


def test_blocks_are_components():
    boxes = np.array([[0, 0, 10, 10], [0, 20, 10, 30], [0, 60, 10, 70], [50, 22, 60, 28]], float)
    assert G.block_labels(boxes).tolist() == [0, 0, 1, 2]


def test_angles(spark):
    row = spark.range(1).select(*[G.segment_angle(F.lit(0.0), F.lit(0.0), F.lit(x), F.lit(y)) for x, y in ((-1.0, -1.0), (-1.0, 0.0), (0.0, 1.0))], G.angle_bin(F.lit(180.0))).first()
    assert [round(v, 6) for v in row] == [45, 0, 90, 35]


def test_empty_and_null_texts_have_no_pages(spark):
    docs = spark.createDataFrame([(1, None), (2, ""), (3, " \n "), (4, "a b")], "doc_id long, text string")
    assert [r.doc_id for r in text_pages(docs).collect()] == [4]


@pytest.mark.parametrize("name", ["words_layout", "lines_rebuild", "merged_y_lines", "text_blocks", "greedy_clusters_x1", "page_class_cascade", "document_result", "document_languages", "eval_confusion", "eval_comparison", "line_score", "phone_hits", "date_hits", "front_page_flag", "word_density", "map_flag", "sidebars", "boreprofile_flag", "page_features", "outlier_trim", "rotated_boxes", "train_val_split", "hsv_bins"])
def test_same_as_sql(spark, name):
    con = duckdb.connect()
    for t in ("part", "documents", "embeddings", "labels", "conversations", "benchmark"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    tidy = lambda d: d[sorted(d.columns)].astype(str).sort_values(sorted(d.columns)).reset_index(drop=True)
    got = tidy(catalog.QUERIES[name](spark, SF).toPandas())
    assert len(got)
    pd.testing.assert_frame_equal(got, tidy(con.execute(catalog.ORACLES[name]).df()))


def test_every_class_of_the_rules_is_met(spark):
    labels = {r.label for r in catalog.QUERIES["page_class_full"](spark, SF).select("label").distinct().collect()}
    assert labels == {"text", "boreprofile", "geo_profile", "map", "title_page", "unknown"}


def test_jobs_run_once(spark, tmp_path):
    inbox, out, states, check = (str(tmp_path / x) for x in ("in", "out", "states", "check"))
    spark.createDataFrame([("report.pdf", "one two three four five six seven\nmore words here"), ("bad.txt", "x"), ("lost.pdf", None)], "file string, text string").write.parquet(inbox)
    for _ in range(2):
        run_jobs(spark, inbox, out, states, check)
    assert spark.read.parquet(out).count() == 1
    assert {r.file: r.error for r in spark.read.parquet(states).collect()} == {"report.pdf": None, "bad.txt": "400", "lost.pdf": "422"}
    got = collect(spark, "report.pdf", out, states)
    assert got["has_finished"] and len(got["data"]) == 1
    with pytest.raises(KeyError):  # a finished result is given once
        collect(spark, "report.pdf", out, states)
    assert collect(spark, "bad.txt", out, states)["error"] == "400"
    more = spark.createDataFrame([("report.pdf", "again one two three"), ("bad.txt", "x"), ("wait.pdf", "y")], "file string, text string")
    assert collect(spark, "wait.pdf", out, states, more) == {"has_finished": False}
    more.where("file = 'report.pdf'").write.mode("append").parquet(inbox)
    run_jobs(spark, inbox, out, states, check)
    assert collect(spark, "report.pdf", out, states)["has_finished"]


def test_a_failing_request_does_not_stop_the_others(spark, tmp_path):
    inbox, out, states, check = (str(tmp_path / x) for x in ("in", "out", "states", "check"))
    spark.createDataFrame([("good1.pdf", "one two"), ("break.pdf", "boom"), ("good2.pdf", "three")], "file string, text string").write.parquet(inbox)

    def work(requests):
        return answer(requests.withColumn("text", F.when(F.col("text") == "boom", F.raise_error(F.lit("broken"))).otherwise(F.col("text"))))

    run_jobs(spark, inbox, out, states, check, work)
    assert {r.file: r.error for r in spark.read.parquet(states).collect()} == {"good1.pdf": None, "good2.pdf": None, "break.pdf": "Internal Server Error"}
    assert {r.file for r in spark.read.parquet(out).collect()} == {"good1.pdf", "good2.pdf"}


def test_tree_model_learns(spark, tmp_path):
    from pagestrata.plans import models as M

    pages = E.with_language(text_pages(spark.read.parquet(f"{SF}/documents.parquet"), words=True))
    segs = page_segments(spark.read.parquet(f"{SF}/embeddings.parquet"))
    f = M.page_features(pages, segs).persist()
    assert len(M.feature_names(f)) == 17
    labels = f.select("doc_id", "page", F.when(F.col("line_count") > 20, "text").otherwise("map").alias("label"))
    wanted = M.with_targets(f, labels, ["map", "text"])
    model, score, chosen = M.search(wanted, M.random_forest(trees=5, depth=4), {"numTrees": [3, 5], "maxDepth": [2, 4]}, tries=2, folds=2)
    assert score > 0.9 and set(chosen) == {"numTrees", "maxDepth"}
    M.save(model, ["map", "text"], str(tmp_path), spark)
    model, classes = M.load(str(tmp_path), spark)
    assert M.tree_classifier(model, classes)(pages, segs).select("label").distinct().count() == 2
    with pytest.raises(ValueError):
        M.classifier("none such")
    assert M.flat({"a": {"b": 1, "c": {"d": 2}}, "e": 3}) == {"a.b": 1, "a.c.d": 2, "e": 3}
    assert len(M.run_name()) == 15
    logits = lambda s: s.withColumn("logits", F.array(F.lit(0.0), F.lit(2.0)))
    samples = spark.createDataFrame([("f", 1)], "filename string, page int")
    assert M.layout_classifier(logits, ["text", "map"])(samples).first().label == "map"


def plain_lines(words):
    """Lines of words (block, line, text, x0, y0, x1, y1) as boxes that change while lines are made."""
    boxes = [list(w[3:]) for w in words]
    groups = {}
    for i, w in enumerate(words):
        groups.setdefault(w[:2], []).append(i)
    for own in groups.values():
        first = boxes[own[0]]
        first[:] = [min(boxes[i][0] for i in own), min(boxes[i][1] for i in own), max(boxes[i][2] for i in own), max(boxes[i][3] for i in own)]
    lines, last = [], None
    for i in (i for own in groups.values() for i in own):
        if last is None or abs(boxes[i][1] - boxes[last][1]) > 2:
            lines.append([])
        lines[-1].append(i)
        last = i
    return [(" ".join(words[i][2] for i in g), min(boxes[i][0] for i in g), min(boxes[i][1] for i in g), max(boxes[i][2] for i in g), max(boxes[i][3] for i in g)) for g in lines]


def test_lines_from_words(spark):
    rng = np.random.default_rng(3)
    rows = [(0, 0, "Hello", 10.0, 20.0, 50.0, 30.0), (0, 0, "World", 60.0, 20.0, 100.0, 30.0)]
    for b in range(6):
        for line in range(3):
            y = 100.0 * b + 12 * line
            rows += [(b + 1, line, f"w{b}{line}{k}", 20.0 * k, y + float(rng.choice([0, 1, 1.5, 3, 4])), 20.0 * k + 15, y + 14) for k in range(4)]
    words = [(1, 1, b, line, n, t, *box) for n, (b, line, t, *box) in enumerate(rows)]
    got = W.lines_from_words(spark.createDataFrame(words, "doc_id long, page int, block_no int, line_no int, word_no int, text string, x0 double, y0 double, x1 double, y1 double").repartition(3)).orderBy("line_no").collect()
    assert [(r.text, r.x0, r.y0, r.x1, r.y1) for r in got] == plain_lines(rows)
    assert (got[0].text, got[0].x0, got[0].x1, got[0].font_size) == ("Hello World", 10.0, 100.0, 10.0)


@pytest.mark.parametrize("words, keyword, ratio", [(["Bern", "THUN", "7"], 0, 0.0), (["Bern", "THUN", "7"], 1, 1.0), (["Bern", "thun", "A1", "x", "ZUG", "1.5", "b", "c"], 0, 0.5)])
def test_map_like_ratio(words, keyword, ratio):
    entries = [(50.0 + 30 * (i // 3), [w]) for i, w in enumerate(words)]
    assert E.map_like_ratio(entries, keyword) == ratio


def test_sidebars_rise():
    column = lambda values, x=50.0: [(10.0 * i, x, v) for i, v in enumerate(values)]
    assert E.sidebars(E.depth_entries(column(["0.5", "1,50m", "2"]))) == [[0.5, 1.5, 2.0]]
    assert E.sidebars(E.depth_entries(column(["1", "1", "2"]))) == [] and E.sidebars(E.depth_entries(column(["1", "2"]))) == []
    assert E.depth_entries([(2.0, 0.0, "-2.0"), (1.0, 0.0, ".5"), (0.0, 0.0, "abc")]) == [(1.0, 0.0, 5.0), (2.0, 0.0, 2.0)]


def plain_title(lines):
    """Whether lines (x0, y0, x1, y1, words) pass the gates and layouts of a title page, by plain loops."""
    from statistics import stdev

    def trim(values, where):
        if len(values) < 3 or stdev(values) == 0:
            return values
        options = [(stdev(values[:i] + values[i + 1 :]) / stdev(values), i) for i in where]
        best = min(options)
        return values[: best[1]] + values[best[1] + 1 :] if best[0] < 0.6 else values

    if not 3 <= len(lines) <= 35:
        return False, False, False
    boxes, sizes = [list(x[:4]) for x in lines], [abs(x[3] - x[1]) for x in lines]
    groups = []
    for i in sorted(range(len(lines)), key=lambda i: (lines[i][1], lines[i][0])):
        if groups and lines[groups[-1][-1]][3] >= lines[i][1] and lines[i][3] >= lines[groups[-1][-1]][1]:
            groups[-1].append(i)
        else:
            groups.append([i])
    tops = []
    for g in groups:
        hull = [min(lines[i][0] for i in g), min(lines[i][1] for i in g), max(lines[i][2] for i in g), max(lines[i][3] for i in g)]
        boxes[g[0]] = hull
        tops.append(hull[1])
    gaps = trim([b - a for a, b in zip(tops, tops[1:], strict=False)], (0, len(tops) - 2))
    if gaps and sum(gaps) / len(gaps) <= 35:
        return False, False, False

    def clusters(key, among):
        left, out = sorted(among, key=lambda i: (boxes[i][1], i)), []
        while left:
            group, todo = [], [left[0]]
            left = left[1:]
            while todo:
                i = todo.pop()
                group.append(i)
                near = [j for j in left if abs(key(j) - key(i)) < 30.6 and abs(boxes[j][1] - boxes[i][1]) < 5 * sizes[i]]
                todo += near
                left = [j for j in left if j not in near]
            if len(group) > 1:
                out.append(group)
        return out

    total = sum(x[4] for x in lines)
    center = lambda i: boxes[i][0] + 0.5 * (boxes[i][2] - boxes[i][0])
    wide = lambda g: len(v := trim([boxes[i][0] for i in sorted(g)], range(len(g)))) > 1 and stdev(v) >= 30.6
    centered = sum(lines[i][4] for g in clusters(center, range(len(lines))) if wide(g) for i in g) / total > 0.75
    free, held = list(range(len(lines))), 0
    for key in (lambda i: boxes[i][0], lambda i: boxes[i][2], center):
        got = [i for g in clusters(key, free) for i in g]
        held += sum(lines[i][4] for i in got)
        free = [i for i in free if i not in got]
    return True, centered, held / total > 0.8


def test_title_layouts_against_a_plain_model():
    rng = np.random.default_rng(4)
    seen = set()
    for _ in range(400):
        n = int(rng.integers(2, 9))
        y = np.cumsum(rng.choice([5, 12, 40, 48, 90], n)).astype(float)
        mid, left = 300.0, 50.0
        lines = []
        for k in range(n):
            w = float(rng.integers(20, 300))
            kind = rng.integers(0, 3)
            x0 = mid - w / 2 if kind == 0 else left if kind == 1 else float(rng.integers(0, 300))
            lines.append((x0, y[k], x0 + w, y[k] + float(rng.choice([10, 20])), int(rng.integers(1, 5))))
        boxes = np.array([x[:4] for x in lines])
        got = E.title_evidence(boxes, np.array([x[4] for x in lines]), 612.0)[1:]
        want = plain_title(lines)
        assert tuple(map(bool, got)) == (want if want[0] else (False, False, False))
        seen.add(want)
    assert len(seen) >= 4


def test_blocks_and_areas_against_plain_loops():
    rng = np.random.default_rng(5)
    for _ in range(60):
        n = int(rng.integers(1, 25))
        x, y = rng.integers(0, 60, n), rng.integers(0, 200, n)
        boxes = np.stack([x, y, x + rng.integers(1, 30, n), y + rng.integers(1, 12, n)], axis=1).astype(float)
        grid = np.zeros((100, 220), bool)
        for a, b, c, d in boxes.astype(int):
            grid[a:c, b:d] = True
        assert G.union_area_of(boxes) == grid.sum()
        label = list(range(n))
        for _ in range(n):
            for i in range(n):
                for j in range(n):
                    a, b = boxes[i], boxes[j]
                    if a[0] < b[2] and b[0] < a[2] and a[1] - 15 < b[3] and b[1] < a[3] + 15:
                        label[i] = label[j] = min(label[i], label[j])
        assert (G.block_labels(boxes) == np.unique(label, return_inverse=True)[1]).all()


def test_profiles_and_documents(spark):
    rows = [("f.pdf", 2, "geo_profile", None, 3, False), ("f.pdf", 1, "boreprofile", "de", 60, False), ("f.pdf", 3, "text", "fr", 900, True)]
    d = L.documents(spark.createDataFrame(rows, "filename string, page int, label string, language string, words int, is_frontpage boolean"))
    one = d.first()
    assert one.metadata.page_count == 3 and one.metadata.languages == ["de"] and [p.page for p in one.pages] == [1, 2, 3]
    assert all(sum(p.classification.values()) == 1 and len(p.classification) == 8 for p in one.pages) and one.pages[1].metadata.language is None
    stable = L.apply_profile(d, "stable").first()
    assert [set(p.classification) for p in stable.pages] == [{"text", "boreprofile", "map", "title_page", "unknown"}] * 3 and stable.pages[1].classification["unknown"] == 1
    assert L.apply_profile(d, "dev").first().profile_version.endswith("dev") and "profile_version" not in L.apply_profile(d, "other").columns
    summed = spark.range(1).select(L.stable_vector(F.create_map(F.lit("table"), F.lit(2), F.lit("unknown"), F.lit(1), F.lit("odd"), F.lit(4), F.lit("map"), F.lit(3))).alias("v")).first().v
    assert summed == {"text": 0, "boreprofile": 0, "map": 3, "title_page": 0, "unknown": 7}
    app = spark.range(1).select(L.app_vector(F.create_map(F.lit("map"), F.lit(1), F.lit("odd"), F.lit(2))).alias("v")).first().v
    assert app == {"Maps": 1, "odd": 2}
    assert L.classified_only(d).count() == 1


def test_sinks_and_sources(spark, tmp_path):
    from pagestrata import sinks as K
    from pagestrata import sources as S

    rows = [("a.pdf", 1, "text", "de", 60, False), ("a.pdf", 2, "map", None, 3, False), ("b.pdf", 1, "geo_profile", None, 9, True)]
    d = L.documents(spark.createDataFrame(rows, "filename string, page int, label string, language string, words int, is_frontpage boolean"))
    at = lambda x: str(tmp_path / x)
    K.write_documents(d, at("docs"))
    assert spark.read.json(at("docs")).count() == 2
    K.write_one_json(d, at("one.json"))
    got = S.ground_truth(spark, at("one.json"))
    keys = {(r.filename, r.page): r.label for r in S.labelled_keys(got, catalog.V.CLASSES).collect()}
    assert keys == {("a.pdf", 1): 0, ("a.pdf", 2): 2, ("b.pdf", 1): 3}
    with pytest.raises(Exception, match="no such class"):
        S.labelled_keys(got, ["text"]).collect()
    K.write_truth(spark.createDataFrame([("c.pdf", "map")], "filename string, label string"), at("truth"))
    assert spark.read.json(at("truth")).first().pages[0].classification.map == 1
    pred = spark.createDataFrame([("a.pdf", 1, "map"), ("b.pdf", 1, "text")], "filename string, page int, label string")
    real = spark.createDataFrame([("a.pdf", 1, "text"), ("b.pdf", 1, "text")], "filename string, page int, label string")
    K.write_confusion(L.confusion(pred, real), at("conf"))
    assert spark.read.option("header", True).csv(at("conf")).columns == ["Class", "True_Positives", "False_Negatives", "False_Positives"]
    diff = L.comparison(pred, real)
    K.write_comparison(diff, at("diff"))
    K.write_misclassified(diff, at("mis"))
    assert spark.read.option("header", True).csv(at("mis/by_class")).first().true_class == "text"
    K.write_metrics({"f1": 0.5}, "run", spark, at("metrics"))
    K.write_metrics({"f1": 0.6}, "run2", spark, at("metrics"))
    assert spark.read.parquet(at("metrics")).count() == 2
    K.write_class_pages(d, at("pages"), catalog.V.SAMPLE_CAPS)
    assert {r.label for r in spark.read.parquet(at("pages")).collect()} == {"text", "map", "geo_profile"}
    K.write_split(L.split_rows(spark.range(10).withColumnRenamed("id", "doc_id"), "doc_id", 0.25), at("split"))
    assert spark.read.parquet(at("split")).where("split = 'val'").count() == 2
    assert {r.label: r.support for r in L.report(pred, real).collect()}["text"] == 2
    files = tmp_path / "pdf" / "map"
    files.mkdir(parents=True)
    for name in ("x.pdf", "y.PDF", "z.txt"):
        (files / name).write_bytes(b"%PDF")
    assert S.pdf_files(spark, str(tmp_path / "pdf")).count() == 2 and S.pdf_files(spark, str(files / "y.PDF")).count() == 1
    assert S.pdf_files(spark, str(files / "z.txt")).count() == 0 and S.pdf_files(spark, str(tmp_path / "none")).count() == 0
    assert S.object_listing(spark, str(tmp_path / "pdf"), 1).count() == 1
    assert [tuple(r) for r in S.classified_files(S.pdf_files(spark, str(tmp_path / "pdf")), ["map"]).select("label").distinct().collect()] == [("map",)]
    page = "filename string, page int, words array<struct<text: string, x0: double, y0: double, x1: double, y1: double>>, image binary, width double, height double"
    sample = S.layout_samples(spark.createDataFrame([("f", 1, [("w", -5.0, 10.0, 306.0, 800.0)], None, 612.0, 792.0)], page), pred).first()
    assert sample.bboxes == [[0, 12, 500, 1010]] and sample.label is None
    with pytest.raises(Exception, match="no label"):
        L.labelled(spark.createDataFrame([("f", 1)], "filename string, page int"), pred).collect()
    graphics = spark.sql("SELECT true AS digital, array(1, 2) AS drawings, array(named_struct('xref', 1, 'rotation', 90, 'places', array(named_struct('x0', 0d, 'y0', 0d, 'x1', 10d, 'y1', 20d)))) AS images, named_struct('a', 0d, 'b', 1d, 'c', -1d, 'd', 0d, 'e', 100d, 'f', 0d) AS matrix")
    row = S.page_graphics(graphics).first()
    assert row.n_drawings == 2 and tuple(row.image_boxes[0]) == (80.0, 0.0, 100.0, 10.0)
    assert S.page_graphics(graphics.withColumn("digital", F.lit(False))).first().image_boxes == []


def test_descriptions_and_their_noise(spark):
    pages = E.with_language(text_pages(spark.createDataFrame([(1, "der Sand und die Kiesel\nnicht Ton\n\nSand")], "doc_id long, text string"), words=True))
    clusters = P.material_clusters(pages)
    words = page_words(pages)
    got = {r.cluster: (r.n_lines, r.n_words, r.valid) for r in P.description_noise(clusters, words).collect()}
    assert got == {0: (2, 6, True)}


def test_vision_hook(spark):
    from pagestrata.plans import vision as N

    class Throttled(Exception):
        response = {"Error": {"Code": "ThrottlingException"}}

    calls, slept, counts = [], [], {}

    def send(image):
        calls.append(image)
        if len(calls) < 3:
            raise Throttled
        return "Map."

    now = [0.0]
    limiter = N.Limiter(2.0, clock=lambda: now[0], sleep=lambda s: (slept.append(s), now.__setitem__(0, now[0] + s)))
    assert N.ask(send, b"x", limiter, retries=6, counts=counts, sleep=lambda s: None) == "Map." and counts == {"throttles": 2, "retries": 2} and slept == [0.5, 0.5]
    assert N.ask(lambda _: 1 / 0, b"x", limiter) is None and not N.is_throttled(ValueError())
    assert N.delay(0, draw=lambda a, b: 1.0) == 0.4 and N.delay(9, draw=lambda a, b: b) == 12.0
    pages = spark.createDataFrame([(1, 1, bytearray(b"map")), (2, 1, bytearray(b"odd")), (3, 1, bytearray(b"fail"))], "doc_id long, page int, image binary")
    client = lambda: lambda image: {b"map": "`Maps.`", b"odd": "nothing known"}[bytes(image)]
    got = N.vision_classifier(client, lambda rest: rest.withColumn("label", F.lit("text")), qps=1000)(pages)
    assert {r.doc_id: r.label for r in got.collect()} == {1: "map", 2: "text", 3: "text"}
    assert len(N.fit_image(lambda s: b"x" * int(1000 * s * s), 300)) <= 300 and len(N.compress(lambda q: b"x" * q, 40)) <= 40


def test_layout_gives_out_pages_in_slices():
    """What is made of one large batch never stands in memory at once; lines are those of smaller batches."""
    from pagestrata import sources as S

    text = "\n".join(" ".join(f"Wort{i}x" if i % 7 else f"{i}.5" for i in range(k % 30)) for k in range(3000))
    docs = pa.RecordBatch.from_pydict({"doc_id": [1, 2, 3], "text": [text, None, text[:90000]]})
    for words in (False, True, "digits"):
        made = list(S._lay_out(["doc_id"], words)(iter([docs])))
        assert len(made) > 1 and max(len(b.column("lines").flatten()) for b in made) <= S.SLICE_LINES + S.LINES_PER_PAGE
        rows = pa.Table.from_batches(made).to_pylist()
        assert [(r["doc_id"], r["page"]) for r in rows] == [(d, p) for d in (1, 3) for p in range(1, 1 + sum(r["doc_id"] == d for r in rows))]
        lines = [x for r in rows if r["doc_id"] == 1 for x in r["lines"]]
        assert " ".join(x["text"] for x in lines).split() == text.split()
        if words is True:
            whole = lines
            assert all(abs(x["others"] - sum(w["x1"] - w["x0"] for w in x["words"][1:])) < 1e-6 for x in lines)
        if words == "digits":
            assert [[w for w in x["words"] if any(map(str.isdigit, w["text"]))] for x in whole] == [x["words"] for x in lines]


def test_boxes_of_many_pages_against_each_page_alone():
    rng = np.random.default_rng(7)
    for _ in range(60):
        count = rng.integers(0, 45, 12)
        of = np.repeat(np.arange(12), count)
        corner = np.stack([rng.integers(0, 300, len(of)), rng.integers(0, 900, len(of))], axis=1).astype(float)
        boxes = np.concatenate([corner, corner + rng.integers(0, [200, 25], (len(of), 2))], axis=1)
        boxes[rng.random(len(of)) < 0.02, 3] += 600  # reaches over many lines
        block, steps = G.paged_blocks(boxes, of), G.paged_blocks(boxes, of, steps=2)
        area, (gap, there) = G.paged_union_area(boxes, of, 12), E.title_gaps(boxes, of, 12)
        assert (block == steps).all()
        for p in range(12):
            own = boxes[of == p]
            assert (np.unique(block[of == p], return_inverse=True)[1] == G.block_labels(own)).all()
            assert abs(area[p] - G.union_area_of(own)) < 1e-6
            if 3 <= len(own) <= 35:
                plain = E.title_evidence(own, np.ones(len(own), int), 612.0)[0]
                assert (plain is None and not there[p]) or abs(plain - gap[p]) < 1e-9
    assert len(set(block[of == int(of[0])])) and block.max() + 1 == sum(len(set(block[of == p])) for p in range(12))


def test_keywords_by_line_against_each_line_alone():
    page = ["ein sand und mehr", "herr sand", "", "kies", "das ende kies", "karte"]
    joined, starts = "".join(x + "\n" for x in page), [0, *np.cumsum([len(x) + 1 for x in page]).tolist()]
    for terms in (E._MATERIAL, E._MAP, E._GEO):
        plain = {i for i, x in enumerate(page) if any(t in x for t in terms.include["de"]) and not any(t in x for t in terms.exclude.get("de", ()))}
        assert terms.lines("de", joined, starts) == plain and terms.any("de", joined, starts) == bool(plain)


@pytest.mark.parametrize("words", [True, "digits"])
def test_evidence_is_the_same_whichever_words_a_line_holds(spark, words):
    docs = spark.createDataFrame([(i, "\n".join(f"{k}.5 Sand und Kies {i}m\nTel. 044 123 45 67 \nKarte 1:25000" for k in range(i + 3))) for i in range(6)] + [(9, None)], "doc_id long, text string")
    found = E.evidence(E.with_language(text_pages(docs, words=words)), shape=True).drop("lang")
    bare = text_pages(docs, words=True).withColumn("lines", F.transform("lines", lambda x: x.dropFields("others")))
    plain = E.evidence(E.with_language(bare), shape=True).drop("lang")
    assert sorted(found.collect()) == sorted(plain.collect()) and found.where("n_sidebars > 0 AND clues > 0 AND summed_area > 0").count()


def passes(df) -> int:
    return df._jdf.queryExecution().executedPlan().toString().count("MapInArrow")


@pytest.mark.parametrize("name", ["page_class_cascade", "geo_profile_flag", "map_flag", "class_samples", "document_result", "tree_model_predictions"])
def test_pages_are_gone_through_once(spark, name):
    """What a query makes of evidence, twice or more, reads the stored evidence and never goes through texts again."""
    assert passes(catalog.QUERIES[name](spark, SF)) == 0


def test_features_take_one_pass_over_pages(spark):
    assert passes(catalog.QUERIES["page_features"](spark, SF)) == 2  # layout and evidence


def test_training_reads_stored_rows(spark, monkeypatch):
    from pagestrata.plans import models as M

    given = []
    monkeypatch.setattr(M, "train", lambda rows, _: given.append(rows))
    catalog._trained(spark, SF)
    plan = given[0]._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and "MapInArrow" not in plan and given[0].count()


def test_front_pages_by_any_of_their_groups(spark):
    texts = ["", "a", *[" ".join(g[-1] for g in t[:k]) for t in V.FRONT_PAGES for k in range(1, len(t) + 1)], *[" ".join(g[0] for g in t[-k:]) for t in V.FRONT_PAGES for k in range(1, len(t) + 1)]]
    got = spark.createDataFrame([(x,) for x in texts], "text string").select("text", X.front_page(F.col("text"), V.FRONT_PAGES).alias("front")).collect()
    assert all(r.front == any(10 * sum(any(x in r.text for x in g) for g in t) >= 7 * len(t) for t in V.FRONT_PAGES) for r in got) and {r.front for r in got} == {True, False}
