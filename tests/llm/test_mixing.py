"""Targets, rates and copies of a mix against plain Python."""

import math
import random
import re

import numpy as np
import pytest

from tillwatch.llm import mixing, queries
from tillwatch.llm.common import table

DOCS = "doc_id long, text string, source string"


def expected_targets(sizes, weights, share, most):
    """Literal resharing: the excess goes to the sources below their limit, by weight, until none is above."""
    order = sorted(sizes, key=lambda source: (source is None, source or ""))
    weight = {source: weights[k % len(weights)] for k, source in enumerate(order)}
    limit = {source: most * size for source, size in sizes.items()}
    target = {source: share * sum(sizes.values()) * weight[source] / sum(weight.values()) for source in order}
    while any(target[s] > limit[s] * (1 + 1e-12) for s in order):
        full = [s for s in order if target[s] >= limit[s]]
        excess = sum(target[s] - limit[s] for s in full)
        target |= {s: float(limit[s]) for s in full}
        open_ = [s for s in order if s not in full]
        if not open_:
            break
        for s in open_:
            target[s] += excess * weight[s] / sum(weight[o] for o in open_)
    return target


def expected_rate(size, sizes, target, most):
    """The rate of a size, by halving the tilt."""
    sizes = [s for s in sizes if s]
    mean = sum(sizes) / len(sizes)
    rate = lambda s, tilt: math.exp(min(tilt * s / mean, math.log(most)))
    low, high = -1e4, 1e4
    for _ in range(80):
        tilt = (low + high) / 2
        low, high = (tilt, high) if sum(s * rate(s, tilt) for s in sizes) < target else (low, tilt)
    return rate(size, tilt)


def check(rows, mixed, weights=mixing.WEIGHTS, share=mixing.SHARE, most=mixing.MOST_COPIES):
    """``rows``: (doc_id, text, source)."""
    size = lambda text: len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))
    assert sorted(((r[0], size(r[1]), r[2]) for r in rows), key=repr) == sorted(((m.doc_id, m.size, m.source) for m in mixed), key=repr)
    sizes = {}
    for _, text, source in rows:
        sizes.setdefault(source, []).append(size(text))
    whole = {source: sum(some) for source, some in sizes.items()}
    targets = expected_targets(whole, weights, share, most)
    taken, rates = dict.fromkeys(sizes, 0), {}
    for m in mixed:
        assert m.source_size == whole[m.source]
        assert m.target == pytest.approx(targets[m.source], rel=1e-9, abs=1e-9)
        assert 0 <= m.copies <= most
        taken[m.source] += m.copies * m.size
        if m.size and 0 < targets[m.source] < most * whole[m.source] * 0.999:
            if (m.source, m.size) not in rates:
                rates[m.source, m.size] = expected_rate(m.size, sizes[m.source], targets[m.source], most)
            assert m.rate == pytest.approx(rates[m.source, m.size], rel=1e-3, abs=1e-6)
    for source, words in taken.items():
        # whole copies: off by half of some small document's words
        assert abs(words - targets[source]) <= max(sorted(s for s in sizes[source] if s)[: 1 + len(sizes[source]) // 4], default=0)


def test_mix_of_the_table(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    rows = [tuple(row) for row in docs.select("doc_id", "text", "source").collect()]
    check(rows, mixing.mix(docs).collect())


def test_query_and_rerun_agree(spark, sf_dir):
    first, again = [sorted(map(tuple, queries.op11_entropy_mixture(spark, sf_dir).collect())) for _ in range(2)]
    assert first == again
    docs = table(spark, sf_dir, "documents").repartition(7)
    assert sorted(map(tuple, mixing.op11_entropy_mixture(docs).collect())) == first


def test_nulls_ties_repeats_and_a_hot_source(spark, monkeypatch):
    monkeypatch.setattr(mixing, "BUCKET_ROWS", 50)
    draw = random.Random(4)
    text = lambda n: " ".join(["w"] * n)
    rows = [(k, text(7), "hot") for k in range(900)] + [(k, text(draw.randrange(1, 60)), draw.choice(["hot", "b", None, "", "é", "z"])) for k in range(900, 1500)]
    rows += [(3, text(5), "b")] * 4 + [(None, text(9), None)] * 3 + [(5000, None, "b"), (5001, "", None), (5002, " \t\n", "only blank"), (5003, text(400), "z"), (5004, text(50_000), "long")]
    frame = spark.createDataFrame([(*row, "x", 1.0) for row in rows], f"{DOCS}, key string, size double")
    mixed = mixing.mix(frame).collect()
    check(rows, mixed)
    assert all(m.copies == 1 for m in mixed if not m.size)
    # all of a size and source share one rate, so their copies differ by one at most
    assert len({m.copies for m in mixed if m.source == "hot" and m.size == 7}) <= 2


@pytest.mark.parametrize(("weights", "share", "most"), [((1.0,), 1.0, 2), ((3.0, 1.0), 0.25, 1), ((5.0, 2.0, 1.0), 2.9, 3)])
def test_other_weights(spark, weights, share, most):
    draw = random.Random(6)
    rows = [(k, " ".join(["w"] * draw.randrange(1, 30)), f"s{k % 4}") for k in range(400)]
    check(rows, mixing.mix(spark.createDataFrame(rows, DOCS), weights, share, most).collect(), weights, share, most)


def test_no_documents(spark):
    assert mixing.mix(spark.createDataFrame([], DOCS)).collect() == []


def test_copies_take_the_target():
    draw = np.random.default_rng(7)
    for most in (1, 2, 5):
        sizes = np.sort(draw.choice(2000, 60, replace=False) + 1)[::-1]
        docs, rates = draw.integers(1, 9, 60), draw.uniform(0, most, 60)
        target = float(np.sum(sizes * docs * rates))
        copies = mixing.round_to_copies(sizes, docs, rates, target, most)
        assert (copies >= 0).all() and (copies <= docs * most).all()
        assert abs(float(np.sum(copies * sizes)) - target) <= sizes[-5]
