"""Operators that work text by text, against brute force and held-out rows."""

import functools
import itertools
import json
import random
import re
import struct
import time
import zlib

import numpy as np
import pyarrow as pa
import pytest
import xxhash
from pyspark.sql import functions as F

from tillwatch.llm import html_main, language, licenses, packing, piece_lattice, quality, queries, rules
from tillwatch.llm.common import held_out, table

SCHEMA = "doc_id long, text string, _n string, stats string"
LONG = "word and other words, " * 20000
ODD = ["", None, " \n\t ", "a", "a" * 5000, "é ü 日本語", "\x00\x01", LONG, "same text here", "same text here", "12 34 !?"]


@pytest.fixture(scope="module")
def odd(spark):
    """Null, empty and long texts, repeated rows, null ids, and columns with the names of the operators' own."""
    rows = [(k, text, "x", "y") for k, text in enumerate(ODD)] + [(1, None, "x", "y"), (8, "same text here", "x", "y"), (None, "same text here", None, None)]
    return spark.createDataFrame(rows, SCHEMA)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="module")
def no_labels(spark):
    return spark.createDataFrame([], "doc_id long, quality int, toxic int")


# Quality rules.

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def base_stats(text):
    words, windows, covered, seen, repeated = WORD.findall(text or ""), {}, set(), set(), 0
    for k in range(len(words) - 4):
        windows.setdefault(tuple(words[k : k + 5]), []).append(k)
    for places in windows.values():
        if len(places) > 1:
            covered.update(at for k in places for at in range(k, k + 5))
    for line in (text or "").split("\n"):
        if WORD.search(line):
            repeated += line in seen
            seen.add(line)
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text or "")), repeated, len(covered)


def test_base_statistics_equal_brute_force(spark, sf_dir, odd):
    more = spark.createDataFrame(
        [(100, "a b c d e a b c d e", "", ""), (101, "\n\n x \n x \nx", "", ""), (102, "a " * 40, "", ""), (103, "a\x1fb\x85c \x0b\x0c d", "", ""), (104, "1 2 3 4 5 6 1 2 3 4 5 7 3 4 5 7 x", "", "")], SCHEMA
    )
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", F.lit("").alias("_n"), F.lit("").alias("stats")).union(odd).union(more)
    for row in rules.with_stats(docs).select("text", "stats").collect():
        s = row.stats
        assert (s.n_words, s.word_chars, s.n_symbols, s.n_dup_lines, s.n_repeat_words) == base_stats(row.text)
        assert s.base_failed == (s.n_words < 10 or 100 * s.n_repeat_words > 20 * s.n_words)


def test_rules_are_learned_and_ordered(spark):
    rows = [(k, k % 100 / 100, (k * 7) % 50 / 50, int(k % 100 > 80 or (k * 7) % 50 < 5), k % 3 == 0) for k in range(3000)]
    learned = rules.learn_rules(spark.createDataFrame(rows, "id int, a double, b double, bad int, part boolean"), ("a", "b"))
    assert 2 <= len(learned) <= rules.MAX_RULES
    judged = spark.createDataFrame(rows, "id int, a double, b double, bad int, part boolean").withColumn("rule", rules.first_rule(learned))
    assert judged.where((F.col("bad") == 1) != F.col("rule").isNotNull()).count() < 60


def test_rules_of_odd_rows(odd, empty, no_labels):
    found, learned = rules.judged(odd, no_labels)
    assert learned == [] and found.count() == odd.count()
    assert found.columns[:3] == ["doc_id", "text", "_n"]
    assert {row.doc_id for row in found.where("kept").collect()} == set()
    assert rules.judged(empty, no_labels)[0].count() == 0


def test_rules_reject_and_keep_held_out_documents(spark):
    sf_dir = "/root/testdata/sf0.01"
    found = queries.op3_quality_rules(spark, sf_dir).join(table(spark, sf_dir, "labels"), "doc_id").where(held_out())
    right = found.where(~F.col("base_failed")).select(F.avg((F.col("kept") == (F.col("quality") == 1)).cast("int"))).first()[0]
    assert right > 0.97


# Quality classifier.


def test_isotonic_is_the_best_rising_fit():
    xs, ones, counts = np.arange(6.0), np.array([0, 3, 1, 2, 5, 4]), np.array([5, 5, 5, 5, 5, 5])
    centres, means = quality.isotonic(xs, ones, counts)
    assert (np.diff(means) > 0).all() and (np.diff(centres) > 0).all()
    assert means.tolist() == pytest.approx([0.0, 0.4, 0.9])


def test_fourier_features_approximate_the_kernel():
    x = np.random.default_rng(0).normal(size=(40, quality.N_STATS))
    z = quality.fourier(x)[:, :-1]
    exact = np.exp(-((x[:, None] - x[None]) ** 2).sum(axis=2) / 2 / quality.N_STATS)
    assert np.abs(z @ z.T - exact).max() < 0.4 and np.abs(z @ z.T - exact).mean() < 0.08


def test_normal_equations_equal_one_matrix(spark):
    draw = np.random.default_rng(1)
    x, y = draw.normal(size=(200, quality.N_STATS)), draw.integers(0, 2, 200)
    rows = spark.createDataFrame([(row.tolist(), int(label)) for row, label in zip(x, y, strict=True)], "features array<double>, y int").repartition(5)
    mean, scale = np.zeros(quality.N_STATS), np.ones(quality.N_STATS)
    gram, right = quality._normal_equations(rows, mean, scale)
    z = quality.fourier(x)
    assert np.allclose(gram, z.T @ z) and np.allclose(right, z.T @ y)


def test_quality_of_held_out_documents(spark):
    sf_dir = "/root/testdata/sf0.01"
    found = queries.op7_quality_classifier(spark, sf_dir)
    assert found.count() == 1000 and found.where("score < 0 or score > 1 or (score >= 0.5) <> (predicted = 1)").isEmpty()
    labelled = found.join(table(spark, sf_dir, "labels"), "doc_id").where("held_out")
    assert labelled.select(F.avg((F.col("predicted") == F.col("quality")).cast("int"))).first()[0] > 0.95


def test_every_score_equals_brute_force(spark, sf_dir):
    """The whole query in one process: moments, one matrix, the best rising fit by its max-min formula, straight lines between its blocks."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text").orderBy("doc_id").collect()
    marks = {}
    for row in table(spark, sf_dir, "labels").where("quality in (0, 1)").collect():
        marks.setdefault(row.doc_id, set()).add(row.quality)
    stats = np.array([quality.text_stats(row.text) for row in docs])
    learned = [k for k, row in enumerate(docs) if zlib.crc32(str(row.doc_id).encode()) % 3 != 1 and len(marks.get(row.doc_id, ())) == 1]
    y = np.array([min(marks[docs[k].doc_id]) for k in learned], float)
    part = np.array([xxhash.xxh64(struct.pack("<q", docs[k].doc_id), seed=42).intdigest() % 4 == 0 for k in learned])
    mean, scale = stats[learned].mean(axis=0), np.maximum(stats[learned].std(axis=0), 1e-6)
    z = quality.fourier((stats - mean) / scale)
    fit = z[learned][~part]
    raw = z @ np.linalg.solve(fit.T @ fit + quality.RIDGE * np.eye(fit.shape[1]), fit.T @ y[~part])
    cells = np.round(np.clip(raw[learned][part], -1, 2) / quality.GRID)
    xs, at = np.unique(cells, return_inverse=True)
    n, ones = np.bincount(at), np.bincount(at, y[part])
    best = [max(min(ones[a : b + 1].sum() / n[a : b + 1].sum() for b in range(i, len(xs))) for a in range(i + 1)) for i in range(len(xs))]
    blocks = [list(block) for _, block in itertools.groupby(range(len(xs)), key=lambda i: round(best[i], 12))]
    centres = [np.average(xs[block], weights=n[block]) * quality.GRID for block in blocks]
    expected = np.interp(raw, centres, [best[block[0]] for block in blocks])
    found = {row.doc_id: row for row in queries.op7_quality_classifier(spark, sf_dir).collect()}
    assert len(found) == len(docs)
    assert [found[row.doc_id].score for row in docs] == pytest.approx(expected.tolist(), abs=1e-6)
    assert all(row.predicted == (row.score >= 0.5) for row in found.values())


def test_quality_of_odd_rows(spark, odd, empty, no_labels):
    scored = quality.scored(odd, no_labels)
    assert scored.count() == odd.count() and scored.where("score <> 0.5 or predicted <> 1").isEmpty()
    assert quality.scored(empty, no_labels).count() == 0
    one_class = spark.createDataFrame([(k, 1, 0) for k in range(11)] + [(3, 0, 0), (None, 1, 0)], "doc_id long, quality int, toxic int")
    assert quality.scored(odd, one_class).where("score is null or score < 0.5").isEmpty()


# Language.


def test_gradients_equal_differences():
    network = language.ByteNetwork.fresh(["a", "b", "c"], 0, 4)
    network.inputs, network.recurrent = [x.astype(float) for x in network.inputs], [x.astype(float) for x in network.recurrent]
    network.output, network.bias = network.output.astype(float), network.bias.astype(float)
    draw = np.random.default_rng(0)
    data, labels = draw.integers(97, 105, (5, 6)), draw.integers(0, 3, 5)
    _, gradients = network.gradients(data, labels)
    for value, gradient in zip(network.parameters(), gradients, strict=True):
        at = np.unravel_index(np.abs(gradient).argmax(), gradient.shape)
        losses = []
        for step in (1e-3, -2e-3):
            value[at] += step
            losses.append(network.gradients(data, labels)[0])
        value[at] += 1e-3
        assert (losses[0] - losses[1]) / 2e-3 == pytest.approx(gradient[at], rel=1e-2)


def test_languages_of_held_out_documents(spark):
    sf_dir = "/root/testdata/sf0.01"
    docs = table(spark, sf_dir, "documents")
    network = language.fit_language(docs)
    found = language.identify(docs, network).where(held_out())
    assert found.select(F.avg((F.col("lang") == F.col("lang_pred")).cast("int"))).first()[0] > 0.97
    assert found.where("score <= 0 or score > 1").isEmpty()
    # A text in parts is read as its parts, by every position.
    both = language.language_spans(docs.where("doc_id in (0, 1)").agg(F.concat_ws(" ", F.collect_list("text")).alias("text")), network)
    assert len({span.lang for span in both.first().language_spans}) >= 2


def test_every_language_equals_brute_force(spark, sf_dir):
    """One byte at a time, one unit at a time, both ways; a document has the mean over all positions of its units."""
    docs = table(spark, sf_dir, "documents")
    network = language.fit_language(docs)

    def states(data, way):
        given, weights = network.inputs[way].astype(float), network.recurrent[way].astype(float)
        size, state, out = len(weights), np.zeros(len(weights)), []
        for byte in data:
            x, back = given[byte], state @ weights
            update, reset = (1 / (1 + np.exp(-(x + back)[k * size : (k + 1) * size])) for k in range(2))
            state = update * state + (1 - update) * np.tanh(x[2 * size :] + reset * back[2 * size :])
            out.append(state)
        return out

    @functools.cache
    def unit_sum(unit):
        data = b" " + unit.encode() + b" "
        both = np.hstack([states(data, 0), states(data[::-1], 1)[::-1]])[1:-1]
        scores = np.exp(both @ network.output.astype(float) + network.bias)
        return (scores / scores.sum(axis=1, keepdims=True)).sum(axis=0), len(both)

    found = {row.doc_id: row for row in queries.op1_byte_network_language(spark, sf_dir).collect()}
    for row in docs.select("doc_id", "text").collect():
        units = [unit_sum(unit) for unit in re.findall(r"\S{1,24}", (row.text or "").lower()) if any(map(str.isalpha, unit))]
        if not units:
            assert (found[row.doc_id].lang_pred, found[row.doc_id].score) == ("und", 0.0)
            continue
        pooled = sum(total for total, _ in units) / sum(n for _, n in units)
        assert found[row.doc_id].score == pytest.approx(pooled.max(), abs=1e-4)
        assert pooled[network.languages.index(found[row.doc_id].lang_pred)] == pytest.approx(pooled.max(), abs=2e-4)
    assert len(found) == docs.count()


def test_language_of_odd_rows(spark, odd, empty):
    assert language.fit_language(empty.withColumn("lang", F.lit(None).cast("string"))) is None
    nothing = language.identify(odd, None)
    assert nothing.where("lang_pred <> 'und' or score <> 0").isEmpty() and nothing.count() == odd.count()
    network = language.train([("en", "word"), ("fr", "été"), ("en", "other"), ("fr", "même")], steps=5)
    found = {row.doc_id: row.lang_pred for row in language.identify(odd, network).collect()}
    assert [found[k] for k in (0, 1, 2, 6, 10)] == ["und"] * 5
    assert {found[k] for k in (3, 4, 5, 7, 8)} <= {"en", "fr"}
    assert language.identify(empty, network).isEmpty()


# Licences.


def test_licences_are_found_and_inherited(spark):
    notice = licenses.TEMPLATES["GPL-3.0"][1]
    rows = [
        (1, "a/LICENSE", "Released under the MIT License."),
        (2, "a/b/x.py", "nothing here"),
        (3, "a/b/y.py", "# Licensed under the Apache License, Version 2.0\ncode " * 2),
        (4, "a/b/c/COPYING", notice.replace("and/or", "and/or\n")),
        (5, "a/b/c/d/z", None),
        (6, "other/z", ""),
        (7, None, "text"),
        (7, None, "text"),
        (8, "a/b/c", LONG),
    ]
    found = licenses.scan_licenses(spark.createDataFrame(rows, "doc_id int, path string, text string")).collect()
    assert sorted((row.doc_id, row.license, row.origin) for row in found if row.license) == [
        (1, "MIT", "header"),
        (2, "MIT", "directory"),
        (3, "Apache-2.0", "header"),
        (4, "GPL-3.0", "header"),
        (5, "GPL-3.0", "directory"),
        (8, "MIT", "directory"),
    ]
    assert len(found) == 9
    assert licenses.scan_licenses(spark.createDataFrame([], "doc_id int, path string, text string, license string")).isEmpty()


def test_no_close_text_is_passed_over():
    """The anchors leave out nothing that the full cosine would find."""
    texts = [text for group in licenses.TEMPLATES.values() for text in group]
    terms = sorted({term for text in texts for term in licenses.terms_of(text)})
    frequencies = {term: 1000 - k for k, term in enumerate(terms)}
    index = licenses.TemplateIndex(licenses.TEMPLATES, frequencies, 1000, 0.6)
    draw = np.random.default_rng(0)
    for text in texts:
        words = licenses.terms_of(text)
        for share in (0.2, 0.4, 0.6, 0.8):
            part = [word for word in words if draw.random() < share] + ["zzz"] * int(draw.integers(0, 3))
            if part and index.best(licenses.Counter(part))[0] >= 0.6:
                assert not index.anchors.isdisjoint(part)


def brute_windows(index, words):
    """Every window of every template, telling word or not, by its bag of words."""
    found = set()
    for template, sizes in enumerate(index.sizes):
        for size in sizes:
            for end in range(1, len(words) + size):
                start, stop = max(0, end - size), min(end, len(words))
                bag = licenses.Counter(words[start:stop])
                weights = {word: count * index.idf.get(word, index.unseen) for word, count in bag.items()}
                dot = sum(weight * dict(index.postings.get(word, ())).get(template, 0.0) for word, weight in weights.items())
                cosine = round(min(1.0, dot / sum(weight**2 for weight in weights.values()) ** 0.5), licenses.DIGITS)
                if cosine >= index.min_cosine:
                    found.add((cosine, template, start, stop))
    return found


def test_all_word_windows_equal_brute_force():
    draw = np.random.default_rng(1)
    notices = [text for group in licenses.TEMPLATES.values() for text in group]
    terms = sorted({term for text in notices for term in licenses.terms_of(text)})
    for _ in range(12):
        index = licenses.TemplateIndex(licenses.TEMPLATES, {term: int(draw.integers(0, 1000)) for term in terms}, 1000, 0.6)
        words = []
        for _ in range(4):
            words += ["zzz", *draw.choice(["noise", "license", "the", "qqq"], int(draw.integers(0, 60))).tolist()]
            words += [word for word in licenses.terms_of(str(draw.choice(notices))) if draw.random() < 0.9]
        words += ["far"] * 200 * int(draw.integers(0, 2)) + licenses.terms_of(str(draw.choice(notices)))[:10]
        found = index.windows(words)
        assert len(found) > 3 and set(found) == brute_windows(index, words)
        for _, _, start, end in (notices_of := index.notices(words)):
            assert sum(a < end and start < b for _, _, a, b in notices_of) == 1


def test_notices_wherever_lines_break():
    index = licenses.TemplateIndex(licenses.TEMPLATES, {}, 100, 0.6)
    gpl = licenses.TEMPLATES["GPL-3.0"][0]
    for width in (1, 2, 3, 5):
        words = gpl.split()
        wrapped = "\n".join("# " + " ".join(words[k : k + width]) for k in range(0, len(words), width))
        assert index.scan(wrapped)[:3] == (1.0, "GPL-3.0", ["GPL-3.0"])
    mit = licenses.TEMPLATES["MIT"][0]
    line = " ".join(f"word{k}" for k in range(40))
    assert index.scan(f"{line} {mit} {line}")[:3] == (1.0, "MIT", ["MIT"])
    assert index.scan(f"{line} {mit} {line}\n{gpl}.\nAll rights reserved. {line}")[2] == ["GPL-3.0", "MIT"]
    cut = " ".join(licenses.TEMPLATES["MIT"][2].split()[:22])
    assert index.scan(f"{line} {cut} {line}")[1] == "MIT"
    assert index.scan(None) == index.scan("") == index.scan(line) == (0.0, "", [], 0.0, "")


def test_notices_of_very_long_texts():
    """A megabyte of telling words, and of one notice again and again, in seconds."""
    index = licenses.TemplateIndex(licenses.TEMPLATES, {}, 100, 0.6)
    started = time.monotonic()
    assert index.scan("license " * 125_000)[2] == []
    assert index.scan("Released under the MIT License. " * 32_000)[:3] == (1.0, "MIT", ["MIT"])
    assert time.monotonic() - started < 40


def test_inheritance_over_the_table_equals_brute_force(spark, sf_dir):
    rows = queries.op2_license_scan(spark, sf_dir).collect()
    assert len(rows) == table(spark, sf_dir, "documents").count()
    files = {}
    for row in rows:
        if row.origin == "header" and row.path.rsplit("/", 1)[-1].startswith("LICENSE"):
            folder = row.path.rpartition("/")[0]
            files.setdefault(folder, []).append(row)
    inherited = 0
    for row in rows:
        if row.origin == "header":
            assert row.origin_path == row.path
            continue
        parts = row.path.split("/")[:-1]
        above = next((files["/".join(parts[:n])] for n in range(len(parts), -1, -1) if "/".join(parts[:n]) in files), None)
        assert (row.license is None) == (above is None)
        if above:
            inherited += 1
            first = min(above, key=lambda file: (-file.score, file.path))
            assert (row.license, row.origin, row.origin_path, row.licenses) == (first.license, "directory", first.path, first.licenses)
    assert inherited


def test_licences_of_deep_directories(spark):
    deep = "/".join(["d"] * 40)
    rows = [(1, f"{deep}/x/LICENSE", "Released under the MIT License."), (2, f"{deep}/y/COPYING", "Released under the ISC License"), (3, f"/{deep}//x/z/f", ""), (4, f"{deep}/y/f", ""), (5, f"{deep}/f", "")]
    found = {row.doc_id: row.license for row in licenses.scan_licenses(spark.createDataFrame(rows, "doc_id int, path string, text string")).collect()}
    assert found == {1: "MIT", 2: "ISC", 3: "MIT", 4: "ISC", 5: None}


def test_reserved_rights_are_a_licence(spark):
    """Every planted line of documents, among them 'All rights reserved.', which stands back behind a notice that grants rights."""
    sf_dir = "/root/testdata/sf0.01"
    names = {"GNU General Public": "GPL-3.0", "CC BY-NC": "CC-BY-NC-4.0", "MIT License": "MIT", "Apache License": "Apache-2.0", "All rights reserved": "Proprietary"}
    texts = {row.doc_id: row.text or "" for row in table(spark, sf_dir, "documents").collect()}
    assert any("All rights reserved" in text for text in texts.values())
    for row in queries.op2_license_scan(spark, sf_dir).collect():
        planted = next((name for words, name in names.items() if words in texts[row.doc_id]), None)
        assert (row.license if row.origin == "header" else None) == planted
        assert planted is None or row.licenses == [planted]
    rows = [(1, "a", "All rights reserved.\n" + licenses.TEMPLATES["BSD-3-Clause"][1][:250])]
    assert licenses.scan_licenses(spark.createDataFrame(rows, "doc_id int, path string, text string")).first().license == "BSD-3-Clause"


# Main text of pages.

PAGE = """<!doctype html><html><head><title>T</title><style>p{}</style></head><body class="has-sidebar">
<!-- <p>no</p> --><header><p>Site name and a long slogan that goes on and on for a while, really</p></header>
<nav><ul><li><a href="/">Home</a><li><a href="/x">Other things to read</a></ul></nav><div class="cookie-notice">We use cookies to give you a very pleasant time here</div>
<div id="content"><h1>Head &amp; line</h1><p>First   paragraph with <b>enough</b> text to be the main thing on this page,<br>and more.</p><p>Short.</p>
<script>if (a < b) document.write("<p>no</p>");</script><p title="the hidden a > b">Second paragraph, again with enough text that it counts &#233;&nbsp;&lt;tag&gt;.</p><p>End.</p></div>
<aside><p>Related: a long list of other articles that you might like to read some day</p></aside><form><p>Subscribe to the newsletter with your address and more</p><input></form>
<section class="comments"><p>A reader comment that is quite long and has an opinion on everything here</p></section><footer>&copy; all of it</footer></body></html>"""


def test_main_text_of_a_page():
    assert html_main.main_blocks(PAGE) == [
        "Head & line",
        "First paragraph with enough text to be the main thing on this page, and more.",
        "Short.",
        "Second paragraph, again with enough text that it counts é <tag>.",
        "End.",
    ]


@pytest.mark.parametrize("old, new", [("</head>", ""), ("</head><body ", "<body "), ("<h1>", "<svg class='menu' viewBox='0 0 1 1'/><h1>"), ("<h1>", "<svg><title>no</title></svg><h1>"), ("<h1>", "<select><h1>"), ("<head>", "<head class=sidebar>")])
def test_pages_with_open_ends(old, new):
    """A head without an end, and elements that are empty or never closed, leave the text as it is."""
    assert old in PAGE and html_main.main_blocks(PAGE.replace(old, new)) == html_main.main_blocks(PAGE) != []


PARAGRAPHS = [f"Paragraph {k} of the article, with enough text in it to be taken for the main thing on any page." for k in range(8)]


def page_of(body):
    return f"<html><body><div><p>A blurb outside that is a line of some length, though not the article itself.</p></div>{body}</body></html>"


@pytest.mark.parametrize("name", ["post hentry tag-python", "post tag python", "layout has-sidebar", "no-sidebar", "with-ads", "comment-free", "category-x tags-y"])
def test_containers_with_misleading_names(name):
    body = "".join(f"<p>{text}</p>" for text in PARAGRAPHS)
    assert html_main.main_blocks(page_of(f'<div class="{name}">{body}</div>')) == PARAGRAPHS
    # what such a name means elsewhere is left out all the same
    rest = f'<div class="{name}">A short aside with a misleading name, of a line or so, that is none of the article.</div>'
    assert html_main.main_blocks(page_of(f"<div>{body}</div>{rest}")) == PARAGRAPHS


@pytest.mark.parametrize("name", ["comments", "post-comments", "comment-list", "share-buttons", "cookie-notice", "related-posts", "sidebar", "ad", "newsletter-signup"])
def test_what_surely_surrounds_an_article_may_be_the_longer_text(name):
    body = "".join(f"<p>{text}</p>" for text in PARAGRAPHS)
    assert html_main.main_blocks(f'<body><article><p>{PARAGRAPHS[0]}</p></article><div class="{name}">{body}</div></body>') == PARAGRAPHS[:1]
    assert html_main.main_blocks(f'<body><div><p>{PARAGRAPHS[0]}</p></div><div class="{name}">{body}</div></body>') == PARAGRAPHS[:1]


def test_end_tags_left_out():
    body = "".join(f"<p>{text}" for text in PARAGRAPHS)
    assert html_main.main_blocks(page_of(f"<article><ul><li class=tags>python<li>An item</ul>{body}</article>")) == ["An item", *PARAGRAPHS]
    assert html_main.main_blocks(page_of(f"<article><ul><li class=tags>python <ul><li>deep</ul><li>An item</ul>{body}</article>")) == ["An item", *PARAGRAPHS]
    assert html_main.main_blocks(page_of(f"<article><p class=share>Share this{body}</article>")) == PARAGRAPHS
    assert html_main.main_blocks(page_of(f"<article><table><tr><td class=ad>Buy<td>A cell</table>{body}</article>")) == ["A cell", *PARAGRAPHS]
    assert html_main.main_blocks(page_of(f"<article>{body}<div class=ad>Buy<p>more</article><p>{'after it ' * 20}")) == PARAGRAPHS


def test_parts_of_one_article():
    half = "".join(f"<p>{text}</p>" for text in PARAGRAPHS[:4]), "".join(f"<p>{text}</p>" for text in PARAGRAPHS[4:])
    gallery = [f"Picture {k}" for k in range(6)]
    links = "".join(f"<p><a href=/{k}>{text}</a></p>" for k, text in enumerate(gallery))
    found = html_main.main_blocks(page_of(f"<article><section>{half[0]}</section><div>{links}</div><section>{half[1]}</section></article>"))
    assert found == PARAGRAPHS[:4] + gallery + PARAGRAPHS[4:]


def test_a_heading_of_its_own():
    body = "".join(f"<p>{text}</p>" for text in PARAGRAPHS)
    assert html_main.main_blocks(f"<body><div class=ad>Buy</div><div><h1>Head</h1></div><div class=x>{body}</div></body>") == ["Head", *PARAGRAPHS]


@pytest.mark.parametrize("tag", ["iframe src=x", "select", "svg", "noscript", "template", "title", "script", "style", "textarea", "div class=ad", "p class=share", "li class=tags", "div class=tag-x", "a", "!--", "form", "table"])
@pytest.mark.parametrize("text", ["", " a few words "])
def test_long_pages_of_one_tag_that_is_never_closed(tag, text):
    html = f"<{tag}>{text}" * (1_000_000 // (len(tag) + len(text) + 2))
    begin = time.perf_counter()
    html_main.main_blocks(html)
    assert time.perf_counter() - begin < 20


def test_a_page_in_one_form_is_read():
    assert html_main.main_blocks("<body><form id=all>" + PAGE.split('<div id="content">')[1].split("</div>")[0] + "</form>")[-1] == "End."


@pytest.mark.parametrize("html", [None, "", "   ", "<", "<p", "<!--", "<script>x", "<nav><a>x</a>", "<" * 20000, '<a "' * 5000, "<div>" * 3000])
def test_broken_pages(html):
    assert isinstance(html_main.main_blocks(html), list)


def test_line_blocks_surge_and_dive():
    assert html_main.main_region([0, 0, 5, 0, 0, 0, 90, 5, 200, 0, 0, 0, 50], 3, 80) == (4, 9)
    assert html_main.main_region([1, 2, 3], 3, 80) == (0, 0)


def test_pages_of_the_table(spark, sf_dir):
    """The articles of these pages, by a reading of their own mark-up."""

    def article(html):
        inner = re.search(r"<article[^>]*>(.*?)(?:</article>|<footer)", html, re.S)[1]
        inner = re.sub(r"</?(p|h1|ul|li|div)\b[^>]*>", "\0", inner).replace("<br>", " ")
        import html as entities

        blocks = [" ".join(entities.unescape(part).split()) for part in re.sub(r"<[^>]*>", "", inner).split("\0")]
        return "\n\n".join(block for block in blocks if block)

    pages = {row.page_id: row.html for row in table(spark, sf_dir, "pages").collect()}
    found = queries.op8_line_block_html(spark, sf_dir).collect()
    assert len(found) == len(pages)
    for row in found:
        assert row.text == article(pages[row.page_id]) and row.n_chars == len(row.text)


# SentencePiece.


@pytest.fixture(scope="module")
def pieces(spark):
    return piece_lattice.piece_table(spark)


def test_encoding_equals_the_library_and_decodes_back(spark, pieces):
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=piece_lattice.model_path(None))
    texts = ["  a", " a", "a  b ", "", None, "\n", "a\nb", "\ta", "é▁x", "日本語 テスト", "a" * 200 + " bb", "x=1;\n\n\n  y=2\t\tz", "\x01 \U0001f600 ok", "=" * 30, " \n \n", LONG, "a b", "a b"]
    rows = spark.createDataFrame([(k, text, "x") for k, text in enumerate(texts)], "k int, text string, word string")
    encoded = piece_lattice.encode(rows, pieces, ["k"])
    found = {row.k: row.ids for row in encoded.collect()}
    decoded = {row.k: row.text for row in piece_lattice.decode(encoded, pieces, ["k"]).collect()}
    for k, text in enumerate(texts):
        assert found[k] == model.encode(text or "")
        assert decoded[k] == model.decode(found[k])
    assert piece_lattice.encode(rows.limit(0), pieces, ["k"]).isEmpty()


def test_merges_of_many_words_equal_those_of_one(pieces):
    """The arrays against the plain rule, on words of the vocabulary's own parts, on ties of scores, and without any pair."""
    rows = piece_lattice._rows(pieces)
    scores = {piece: (number, score) for number, piece, score, byte in rows if byte is None}
    draw = random.Random(10)
    some = draw.sample(sorted(scores), 3000)
    words = ["".join(draw.choices(some, k=draw.randrange(1, 5))) for _ in range(4000)] + ["a", "aaaaaaaaaaaaaaaa", "▁", "▁▁▁▁", "\n", "🧿", "a🧿"]
    words = list(dict.fromkeys(words))
    found = piece_lattice.MergeTable(rows).encode(words)
    assert len(found) > 3500 and "🧿" not in found and "a🧿" not in found
    for word, ids in found.items():
        cuts = piece_lattice.merged_path(word, scores)
        assert np.frombuffer(ids, "<i4").tolist() == [scores[word[low:high]][0] for low, high in zip(cuts, cuts[1:])]
    ties = [(k, piece, score, None) for k, (piece, score) in enumerate({"a": -9.0, "b": -9.0, "c": -9.0, "ab": -1.0, "bc": -1.0, "abc": -2.0, "ca": -1.0}.items())]
    scores = {piece: (number, score) for number, piece, score, _ in ties}
    words = ["".join(word) for n in range(1, 7) for word in itertools.product("abc", repeat=n)]
    for table, kept in ((ties, words), (ties[:3], words), (ties[3:4], [])):
        found = piece_lattice.MergeTable(table).encode(words)
        assert list(found) == kept
        for word, ids in found.items():
            cuts = piece_lattice.merged_path(word, {piece: scores[piece] for _, piece, _, _ in table})
            assert np.frombuffer(ids, "<i4").tolist() == [scores[word[low:high]][0] for low, high in zip(cuts, cuts[1:])]
    assert piece_lattice.MergeTable(ties).encode([]) == {}


def test_words_of_many_texts_are_those_of_each():
    """The words of a part of the rows are found at once; parts end by the bytes of their texts, and none is lost."""
    texts = [None, "", " ", "\n", "a", "  a", "a  ", "▁", "a▁ b", "é\n ü", "\r\n a\tb", " \n \n", "日本 語\n\n  x", "😀 😀😀", "\x00 x", "x" * 99]
    for rows in (texts, texts[::-1], [None], [""], []):
        batch = pa.RecordBatch.from_arrays([pa.array(range(len(rows)), pa.int64()), pa.array(rows, pa.string())], ["key", "text"])
        parts = list(piece_lattice._portions(batch, 20))
        assert [row for part in parts for row in part.to_pylist()] == batch.to_pylist()
        assert len(parts) > 2 or len(rows) < 2
        for part in [batch, *parts]:
            words, ends = piece_lattice._split(part.column(1))
            words = [word.replace(" ", piece_lattice.BLANK) for word in words.to_pylist()]
            found = [words[low:high] for low, high in zip(ends, ends[1:], strict=False)]
            assert found == [piece_lattice.words_of(text) for text in part.column(1).to_pylist()]


def test_turns_of_the_table_equal_the_library(spark, sf_dir):
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=piece_lattice.model_path(None))
    texts = {(row.conv_id, row.turn): row.text for row in table(spark, sf_dir, "conversations").collect()}
    found = queries.op6_sentencepiece_turns(spark, sf_dir).collect()
    assert len(found) == len(texts)
    for row in found:
        ids = model.encode(texts[row.conv_id, row.turn])
        assert (row.ids, row.n_pieces, row.decoded) == (ids, len(ids), model.decode(ids))


def test_viterbi_equals_every_path(spark):
    """A unigram model of a few pieces, against all segmentations."""
    scores = {"▁": -4.0, "a": -3.0, "b": -3.5, "▁a": -5.0, "ab": -4.0, "ba": -4.5, "▁ab": -6.5, "aab": -7.0, "▁ba": -7.0}
    rows = [(k, piece, score, None) for k, (piece, score) in enumerate(scores.items())] + [(100 + b, f"<0x{b:02X}>", 0.0, b) for b in range(256)]
    pieces = spark.createDataFrame(rows, "id int, piece string, score double, byte int")
    words = ["▁", "▁a", "▁ab", "▁aabba", "▁bab", "▁abc", "▁cé", "▁" + "ab" * 50]

    def best(word):
        if not word:
            return 0.0, ()
        found = []
        for size in range(1, 4):
            if word[:size] in scores or size == 1:
                rest, ids = best(word[size:])
                own = scores.get(word[:size], -17.0)
                mine = (list(scores).index(word[:size]),) if word[:size] in scores else tuple(100 + b for b in word[0].encode())
                found.append((own + rest, mine + ids))
        return max(found, key=lambda x: x[0])

    found = {row.word: row.ids for row in piece_lattice.encode_words(spark.createDataFrame([(w,) for w in words], "word string"), pieces, merges=False).collect()}
    value = {k: score for k, score in enumerate(scores.values())}
    for word in words[:-1]:
        total = sum(value[n] for n in found[word] if n < 100)
        assert total == pytest.approx(sum(value[n] for n in best(word)[1] if n < 100))
    assert len(found[words[-1]]) > 30


def test_every_document_is_encoded(spark, sf_dir, pieces):
    """The query reads documents; words that are not sent to the tasks get the same ids there."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=piece_lattice.model_path(None))
    docs = table(spark, sf_dir, "documents")
    texts = {row.doc_id: row.text or "" for row in docs.collect()}
    found = queries.op6_sentencepiece_lattice(spark, sf_dir).collect()
    assert sorted(row.doc_id for row in found) == sorted(texts)
    for row in found:
        assert row.ids == model.encode(texts[row.doc_id]) and row.n_pieces == len(row.ids) and row.decoded == model.decode(row.ids)
    for most in (0, 500):
        for row in piece_lattice.encode(docs, pieces, ["doc_id"], most_words=most).collect():
            assert row.ids == model.encode(texts[row.doc_id])


# Packing.


def unpacked(rows):
    by_sequence = {}
    for row in rows:
        by_sequence.setdefault(row.sequence_id, []).append(row)
    for parts in by_sequence.values():
        at = 0
        for row in sorted(parts, key=lambda row: row.offset):
            assert row.offset == at and row.length > 0
            at += row.length
        assert at <= 2048
    return by_sequence


def test_each_token_is_in_one_piece(spark, sf_dir, odd):
    encoder = packing.Encoder()
    docs = table(spark, sf_dir, "documents").select("doc_id", "text").union(odd.where("doc_id <> 8").dropDuplicates(["doc_id"]).select(F.col("doc_id") + 10**6, "text"))
    texts = {row.doc_id: row.text for row in docs.collect()}
    rows = packing.pack(docs).collect()
    sequences = unpacked(rows)
    tokens = 0
    for doc_id, text in texts.items():
        ids = np.array([*encoder.tokenizer.encode(text or "", add_special_tokens=False).ids, 1], "<u4")
        parts = sorted((row for row in rows if row.doc_id == doc_id), key=lambda row: row.start)
        assert sum(row.length for row in parts) == len(ids) == parts[0].doc_tokens
        for row in parts:
            assert row.ids_crc32 == zlib.crc32(ids[row.start : row.start + row.length].tobytes())
        tokens += len(ids)
    assert len(sequences) * 2048 < 1.03 * tokens + 2048 * 4


def test_packed_ids_can_be_written_out(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").where("doc_id < 20")
    for row in packing.piece_ids(packing.pack(docs), docs).collect():
        assert len(row.ids) == row.length and zlib.crc32(np.array(row.ids, "<u4").tobytes()) == row.ids_crc32


def test_odd_rows_are_packed(odd, empty):
    rows = packing.pack(odd).collect()
    unpacked(rows)
    assert sum(row.start == 0 for row in rows) == odd.count() and packing.pack(empty).isEmpty()


def test_cuts_cost_least():
    """The queue against all windows."""
    draw = np.random.default_rng(3)
    for _ in range(60):
        steps = draw.integers(1, 9, draw.integers(1, 40))
        places, costs = [0, *np.cumsum(steps).tolist()], [0, *draw.integers(0, 6, len(steps)).tolist()]
        best = [0] + [10**9] * len(steps)
        for j in range(1, len(places)):
            for i in range(j):
                if places[j] - places[i] <= 16:
                    best[j] = min(best[j], best[i] + 16 - (places[j] - places[i]) + costs[j])
        cuts = packing.best_cuts(places, costs, 16)
        assert cuts[0] == 0 and cuts[-1] == len(places) - 1
        assert sum(16 - (places[b] - places[a]) + costs[b] for a, b in zip(cuts, cuts[1:], strict=False)) == best[-1]


def test_ids_equal_the_library_for_any_text():
    encoder = packing.Encoder()
    draw = np.random.default_rng(5)
    letters = [" ", "\n", "\t", "\r", "a", "é", "1", "$", "'s", "\xa0", "\x1c", "　", ".", "B", "<|endoftext|>", "日"]
    for _ in range(3000):
        text = "".join(draw.choice(letters, draw.integers(0, 14)))
        assert encoder.encode(text).tolist() == encoder.tokenizer.encode(text, add_special_tokens=False).ids


@pytest.mark.parametrize(
    "change",
    [
        {"normalizer": {"type": "Lowercase"}},
        {"pre_tokenizer": {"type": "ByteLevel", "add_prefix_space": True, "trim_offsets": True, "use_regex": True}},
        {"pre_tokenizer": {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False}},
        {"pre_tokenizer": {"type": "Whitespace"}},
        {"ignore_merges": True},
        {"truncation": {"direction": "Right", "max_length": 2, "strategy": "LongestFirst", "stride": 0}},
        {"padding": {"strategy": {"Fixed": 40}, "direction": "Right", "pad_to_multiple_of": None, "pad_id": 0, "pad_type_id": 0, "pad_token": "!"}},
    ],
    ids=["normalizer", "prefix", "regex", "split", "merges", "truncation", "padding"],
)
def test_ids_equal_the_library_for_other_files(tmp_path, change):
    """A file that does more than split, take bytes and merge goes through the library; a whole text is encoded whatever its limits."""
    import public_tokenizers
    from tokenizers import Tokenizer

    with open(public_tokenizers.path("byte_bpe_50k.json"), encoding="utf-8") as file:
        settings = json.load(file)
    path = tmp_path / "changed.json"
    for key, value in change.items():
        (settings["model"] if key in settings["model"] else settings)[key] = value
    path.write_text(json.dumps(settings), encoding="utf-8")
    encoder = packing.Encoder(str(path))
    whole = Tokenizer.from_file(str(path))
    whole.no_truncation()
    whole.no_padding()
    assert (encoder.fast is not None) == (change.keys() <= {"truncation", "padding"})
    for text in ("Hello World, THIS is some Text", "", " x", "a  b\n\nC's", "superfluousness of antidisestablishment " * 20):
        ids = encoder.encode(text)
        assert ids.tolist() == whole.encode(text, add_special_tokens=False).ids
        encoder.sentence_ends(ids)


def test_languages_beside_other_columns_and_beyond_the_most(spark, monkeypatch):
    network = language.train([("en", "word"), ("fr", "été"), ("en", "other"), ("fr", "même")], steps=5)
    frame = spark.createDataFrame([(1, "some words", "kept", "x", "old")], "doc_id int, text string, _language string, __language string, lang_pred string")
    found = language.identify(frame, network)
    assert found.columns == ["doc_id", "text", "_language", "__language", "lang_pred", "score"]
    (row,) = found.collect()
    assert (row._language, row["__language"], row.lang_pred in ("en", "fr")) == ("kept", "x", True)
    monkeypatch.setattr(language, "MAX_LANGUAGES", 2)
    sizes = {"de": 9, "en": 30, "fr": 9, "it": 6}
    rows = [(k, f"words of {lang}", lang) for k, lang in enumerate(lang for lang, n in sizes.items() for _ in range(n))]
    held = [row for row in rows if zlib.crc32(str(row[0]).encode()) % 3 != 1]
    counts = {lang: sum(row[2] == lang for row in held) for lang in sizes}
    most = sorted(sizes, key=lambda lang: (-counts[lang], lang))[:2]
    units = language.training_units(spark.createDataFrame(rows, "doc_id int, text string, lang string"))
    assert {lang for lang, _ in units} == set(most)
