"""Trained operators on held-out rows, vector operators against brute force, and the pipeline."""

from __future__ import annotations

import math
import random
import zlib
from collections import Counter
from pathlib import Path

import numpy as np
import pytest

import corpus_pipeline
from pyspark.sql import functions as F
from tidegate.llm import html, langid, neardup, topk, toxicity
from tidegate.llm.queries import ORACLES, QUERIES

SF_DIR = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, lang string, source string, n_chars long, score double"
tables = pytest.mark.skipif(not Path(SF_DIR).exists(), reason="no test tables")


def fold(doc_id, n):
    return zlib.crc32(b"" if doc_id is None else str(doc_id).encode()) % n


@pytest.fixture(scope="module")
def talk(spark):
    """Two languages by their letters; insults make a text toxic, most of all next to a group."""
    rng = random.Random(3)
    letters = {"aa": "abcdef", "bb": "efghijé"}
    rows, labels = [], []
    for i in range(600):
        lang = "aa" if i % 3 else "bb"
        text = ["".join(rng.choice(letters[lang]) for _ in range(rng.randint(2, 6))) for _ in range(rng.randint(5, 60))]
        toxic = i % 5 == 0
        if toxic:
            for _ in range(2):
                text.insert(rng.randrange(len(text)), rng.choice(["Blockhead", "nitwit", "oaf"]))
        rows.append((i, " ".join(text), lang if i % 11 else None, "s", 1, 2.0))
        labels.append((i, 1, int(toxic)))
    rows += [(900, None, "aa", None, None, None), (901, "", "aa", "", 0, 0.0), (902, "12 !?", None, "s", 1, 1.0),
             (None, "abc fed", None, "s", 1, 1.0), (5, rows[5][1], "aa", "s", 1, 2.0),
             (903, "abc fed " * 20000, "aa", "s", 1, 1.0)]
    labels += [(900, 1, 1), (None, 1, 1), (5000, 0, 0), (7, None, None), (8, 1, 7)]
    return spark.createDataFrame(rows, DOCS), spark.createDataFrame(labels, "doc_id long, quality int, toxic int"), rows


def test_language_of_held_out_documents(spark, talk):
    docs, _, rows = talk
    found = langid.identify(spark, docs).collect()
    assert Counter((r["doc_id"], r["held_out"]) for r in found) == Counter((r[0], fold(r[0], 5) == 0) for r in rows)
    truth = {r[0]: r[2] for r in rows}
    judged = [r["lang_pred"] == truth[r["doc_id"]] for r in found if r["held_out"] and truth[r["doc_id"]] and (r["doc_id"] or 0) < 900]
    assert np.mean(judged) > 0.97
    unknown = {r["doc_id"] for r in found if r["lang_pred"] == "und"}
    assert unknown == {900, 901, 902}
    assert all(0 <= r["score"] <= 1 for r in found)
    kept = langid.known_language(spark, docs)
    assert kept.columns == docs.columns and kept.filter("doc_id >= 900").count() == 1


def test_nothing_labelled(spark, talk):
    docs, labels, _ = talk
    bare = docs.limit(3).withColumn("lang", docs["lang"].substr(9, 1).try_cast("int").cast("string"))
    assert {r["lang_pred"] for r in langid.identify(spark, bare).collect()} == {"und"}
    scores = toxicity.score_documents(spark, docs.limit(3), labels.limit(0)).collect()
    assert [r["score"] for r in scores] == [0.5] * 3


def test_toxicity_of_held_out_documents(spark, talk):
    docs, labels, rows = talk
    found = toxicity.score_documents(spark, docs, labels).collect()
    assert Counter((r["doc_id"], r["held_out"]) for r in found) == Counter((r[0], fold(r[0], 4) == 2) for r in rows)
    own = [r for r in found if r["held_out"] and r["doc_id"] is not None and r["doc_id"] < 600]
    assert np.mean([r["predicted"] == (r["doc_id"] % 5 == 0) for r in own]) > 0.95
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.3) for r in found)


def test_pairs_count_for_more_than_both_terms():
    rng = np.random.default_rng(0)
    sample = []
    for _ in range(1500):
        a, b = rng.random() < 0.5, rng.random() < 0.5
        sample.append((np.array(sorted({10 * a + 1, 20 * b + 2, int(rng.integers(100, 130))})), int(a == b)))
    machine = toxicity.fit(sample)
    wrong = [abs(machine.score(x) - y) > 0.5 for x, y in sample]
    assert np.mean(wrong) < 0.1  # no sum of weights for single terms gets under one quarter


def rare_pairs(n, seed):
    """Some rows are toxic by an insult; two rare terms that tell nothing alone make a row toxic together."""
    rng = np.random.default_rng(seed)
    for _ in range(n):
        found, draw, toxic = set(rng.integers(100, 900, 15).tolist()), rng.random(), rng.random() < 0.1
        found |= {7} if toxic else set()
        pair = draw < 0.006
        found |= {1, 2} if pair else {1} if draw < 0.021 else {2} if draw < 0.036 else set()
        yield np.array(sorted(found)), bool(toxic or pair), pair


def test_rare_pairs_of_harmless_terms_are_learned():
    machine = toxicity.fit([(x, int(y)) for x, y, _ in rare_pairs(8000, 1)])
    judged = [(machine.score(x) >= toxicity.THRESHOLD, y, pair) for x, y, pair in rare_pairs(4000, 2)]
    assert np.mean([found for found, _, pair in judged if pair]) > 0.8
    assert np.mean([found for found, y, _ in judged if not y]) < 0.01


def test_every_kept_term_has_factors():
    machine = toxicity.fit([(x, int(y)) for x, y, _ in rare_pairs(1000, 3)])
    assert len(machine.at) > 700 and (machine.factors != 0).all()


def test_calibration_is_that_of_the_log_odds():
    rng = np.random.default_rng(2)
    odds = rng.normal(0, 1, 20000)
    labels = (rng.random(20000) < toxicity.logistic(2.5 * odds + 1)).astype(float)
    assert toxicity.calibration(odds, labels) == pytest.approx((2.5, 1), abs=0.1)
    assert toxicity.calibration(-odds, labels) == (1.0, 0.0)


def unusable(n):
    return [(n, None, 1), (n + 1, [], 1), (n + 2, [float("nan")] * 8, 1), (n + 3, [1.0] * 7 + [None], 1),
            (n + 4, [0.0] * 8, 1), (n + 5, [float("inf")] * 8, 2)]


@pytest.fixture(scope="module")
def vectors(spark):
    rng = np.random.default_rng(5)
    rows = []
    for i in range(300):
        x = rng.standard_normal(8)
        if i % 3 == 1:
            x = np.array(rows[i - 1][1]) + rng.normal(0, 0.12, 8)
        if i % 10 == 9:
            x = np.array(rows[0][1])
        rows.append((i, [float(v) for v in x.astype(np.float32)], None if i % 50 == 7 else i % 4 // 2))
    rows += unusable(1000)
    return spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int"), rows


def usable(row):
    return bool(row[1]) and all(v is not None and np.isfinite(v) for v in row[1])


def test_top_k(spark, vectors):
    frame, rows = vectors
    good = [(r[0], np.floor(1024 * np.array(r[1])).astype(int)) for r in rows if usable(r)]
    expected = set()
    for i, q in good:
        if i % 20 == 0:
            best = sorted((-int(q @ v), j) for j, v in good if j != i)[:10]
            expected |= {(i, rank, j, -s) for rank, (s, j) in enumerate(best, 1)}
    assert {tuple(r) for r in topk.top_k(spark, frame, every=20).collect()} == expected
    few = frame.filter("vec_id < 4")
    assert topk.top_k(spark, few, every=20).count() == 3
    assert topk.top_k(spark, frame.limit(0)).count() == 0


@pytest.mark.parametrize("scale", [1.0, 3e6, 1e9, 1e14])
def test_top_k_is_exact_for_components_of_any_size(spark, scale):
    rng = np.random.default_rng(6)
    rows = [(i, (rng.standard_normal(8) * scale).tolist()) for i in range(400)]
    rows += [(1000 + i, rows[i % 7][1]) for i in range(30)] + [(2000, [scale * 1e30] + [0.0] * 7)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(3)
    whole = {i: [math.floor(1024 * x) for x in v] for i, v in rows[:-1]}
    want = set()
    for i in whole:
        if i % 100 == 0:
            scores = sorted((-sum(a * b for a, b in zip(whole[i], whole[j])), j) for j in whole if j != i)
            want |= {(i, n, j, -s if abs(s) < 1 << 63 else None) for n, (s, j) in enumerate(scores[:10], 1)}
    assert {tuple(r) for r in topk.top_k(spark, frame).collect()} == want


def test_near_vectors(spark, vectors):
    frame, rows = vectors
    found = {r["vec_id"]: r for r in neardup.near_duplicates(spark, frame).collect()}
    assert len(found) == len(rows)
    good = [r for r in rows if usable(r) and r[2] is not None and any(r[1])]
    x = neardup.normed(np.array([r[1] for r in good]))
    label = np.array([r[2] for r in good])
    near = (x @ x.T >= neardup.COSINE) & (label[:, None] == label[None, :])
    np.fill_diagonal(near, False)
    links = {r[0]: int(n) for r, n in zip(good, near.sum(1))}
    total = sum(found[i]["n_links"] for i in found)
    assert 0.9 * near.sum() <= total <= near.sum()
    for i, row in found.items():
        assert row["n_links"] <= links.get(i, 0)
        assert row["kept"] == (row["component_id"] == i)
        assert row["component_id"] <= i
    assert neardup.near_duplicates(spark, frame.limit(0)).count() == 0


def test_every_word_of_a_block_counts():
    """Blocks that differ in words far beyond the beginning are seen differently."""
    page = "<html><body><article><p>" + "same " * 60 + "{}</p></article></body></html>"
    one, other = (html.seen(html.blocks_of(page.format(end))) for end in ("alpha alpha", "omega omega"))
    assert (one.word[:60] == other.word[:60]).all() and len(one.word) == 62
    model = html.Labeller.fresh()
    a, b = (model.inputs([seen])[0] for seen in (one, other))
    assert not np.allclose(a, b)


def test_copies_of_a_page_do_not_fill_the_sample(spark, monkeypatch):
    monkeypatch.setattr(html, "SAMPLE_PAGES", 3)
    seen = []
    monkeypatch.setattr(html, "rows", lambda batches, *names: seen.append(1) or iter([]))
    pages = [(i, f"<article><p>text {0 if i < 40 else i} of a page</p></article>") for i in range(44)]
    frame = spark.createDataFrame(pages, "page_id long, html string")
    saved = html.saved
    kept = {}

    def noted(session, table, name):
        kept[name] = saved(session, table, name)
        return kept[name]

    monkeypatch.setattr(html, "saved", noted)
    monkeypatch.setattr(html, "fit", lambda held: html.Labeller.keeping_all())
    html.train(spark, frame)
    assert kept["page-sample"].count() == 3 and kept["page-sample"].select("html").distinct().count() == 3


def test_planted_near_vectors_are_found(spark):
    """Pairs at just over the threshold among many others, in labels of text, one of them large."""
    rng = np.random.default_rng(4)
    x, y = neardup.pairs_at(neardup.COSINE + 1e-4, 32, 600, seed=9)
    others = rng.standard_normal((3000, 32))
    rows = [(i, v.tolist(), "1.2" if i % 3 else "1.9") for i, v in enumerate(x)]
    rows += [(1000 + i, (3 * v).tolist(), "1.2" if i % 3 else "1.9") for i, v in enumerate(y)]
    rows += [(2000 + i, v.tolist(), "1.2") for i, v in enumerate(others)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label string").repartition(4)
    found = {r["vec_id"]: r for r in neardup.near_duplicates(spark, frame).collect()}
    linked = [found[1000 + i]["component_id"] == i for i in range(len(x))]
    assert np.mean(linked) >= 0.94
    assert all(found[i]["component_id"] == i for i in found if i < 1000 or i >= 2000)
    # labels that differ in their fraction only are different labels
    other = frame.withColumn("label", F.when(F.col("vec_id") < 1000, 1.25).otherwise(1.5))
    assert all(r["n_links"] == 0 for r in neardup.near_duplicates(spark, other).collect())


@pytest.mark.parametrize("n", [10_000, 100_000, 1_000_000])
def test_recall_does_not_fall_with_the_table(n):
    code = neardup.code_for(64, n)
    x, y = neardup.pairs_at(neardup.COSINE, 64, 400, seed=77)
    a, b = (set(zip(*(part.tolist() for part in code.decode(z)))) for z in (x, y))
    assert len({row for row, _ in a & b}) >= 0.94 * len(x)


def test_list_decoding_finds_all_directions_in_reach():
    code = neardup.Code(8, 16)
    x = neardup.normed(np.random.default_rng(1).standard_normal((40, 8)))
    row, found = code.decode(x)
    y = x @ code.turn
    value = (y[:, :4] @ code.left.T)[:, :, None] + (y[:, 4:] @ code.right.T)[:, None, :]
    assert set(zip(row.tolist(), found.tolist())) == set(
        zip(*(z.tolist() for z in np.nonzero(value.reshape(40, -1) >= code.least)))
    )


ODD_PAGE = """<html><head><title>t</title></head><body><div class="top-menu"><a href=/a>Home</a> <a href=/b>News</a></div>
<article><h1>On &amp; off</h1><p>First   line<br>goes on, and on it goes, with commas.<p>Second line, which is long enough to be read.
<script>if (a < b) { "<p>no</p>" }</script></article><!-- <p>hidden</p> --><footer>&copy; all rights</footer>"""


def test_blocks_of_odd_pages():
    texts = [b.text for b in html.blocks_of(ODD_PAGE)]
    assert texts == ["Home News", "On & off", "First line goes on, and on it goes, with commas.",
                     "Second line, which is long enough to be read.", "© all rights"]
    for page in (None, "", "<", "<<p>", "</p></div>", "<p", "<!-- open", "<script>open", "a" * 10**6):
        html.blocks_of(page)


def test_gradients_of_the_labeller():
    rng = np.random.default_rng(1)
    model = html.Labeller.fresh()
    blocks = [html.blocks_of(ODD_PAGE), html.blocks_of("<p>one</p><p>two words</p>")]
    pages, truth = [html.seen(b) for b in blocks], [rng.integers(0, 2, len(b)).astype(float) for b in blocks]

    def loss():
        p = np.concatenate(model.scores(pages))
        y = np.concatenate(truth)
        return -(y * np.log(p) + (1 - y) * np.log(1 - p)).mean()

    found = model.gradients(pages, truth)
    for name, weights in model.weights.items():
        for at in rng.choice(np.flatnonzero(found[name].ravel() != 0), 3):
            old = weights.ravel()[at]
            weights.ravel()[at] = old + 1e-5
            high = loss()
            weights.ravel()[at] = old - 1e-5
            low = loss()
            weights.ravel()[at] = old
            assert found[name].ravel()[at] == pytest.approx((high - low) / 2e-5, rel=1e-3, abs=1e-8)


@tables
def test_main_text_of_pages(spark, monkeypatch):
    monkeypatch.setattr(html, "EPOCHS", 4)
    pages = spark.read.parquet(f"{SF_DIR}/pages.parquet")
    rows = {r["page_id"]: r["html"] for r in pages.collect()}
    odd = spark.createDataFrame([(-1, None, None), (-2, "u", ""), (-3, "u", "<p>")], "page_id long, url string, html string")
    found = {r["page_id"]: r for r in html.extract(spark, pages.unionByName(odd)).collect()}
    exact = [
        found[i]["text"] == "\n".join(b.text for b in html.blocks_of(page) if html.marked(b)) for i, page in rows.items()
    ]
    assert np.mean(exact) > 0.9
    assert all(r["n_chars"] == len(r["text"]) for r in found.values())
    assert [found[i]["text"] for i in (-1, -2, -3)] == ["", "", ""]
    assert html.extract(spark, odd.filter("page_id = -2")).first()["text"] == ""
    assert html.extract(spark, pages.limit(0)).count() == 0


@tables
@pytest.mark.parametrize("name", ORACLES)
def test_query_equals_its_sql(spark, name):
    import __spark_entry__ as entry
    from tools.check_oracle import connect, difference

    assert set(QUERIES) <= set(entry.queries())
    assert difference(spark, connect(SF_DIR), SF_DIR, name) is None


@tables
def test_pipeline_stages(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    extra = spark.createDataFrame([(9001, None, None, "s", 0), (9002, "", "en", "s", 0)], docs.schema)
    docs = docs.unionByName(extra)
    kept = []
    for _, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, SF_DIR)
        assert out.columns == docs.columns
        docs = spark.createDataFrame(out.collect(), docs.schema)
        kept.append(docs)
    assert {r["doc_id"] for r in kept[0].collect()}.isdisjoint({9001, 9002})
    texts = [r["text"] for r in kept[1].collect()]
    assert len(texts) == len(set(texts)) < kept[0].count()
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, SF_DIR).collect()
    assert Counter(r["doc_id"] for r in packed if r["piece"] == 0) == Counter(r["doc_id"] for r in docs.collect())
