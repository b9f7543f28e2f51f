"""Language ID, toxicity and LM scores: held-out accuracy, brute force, edges."""

import itertools
import math
import random
import zlib
from collections import Counter

import pytest

from hourglass.llm import language, lattice, toxicity
from hourglass.llm.queries import QUERIES
from hourglass.llm.storage import table
from llm_edge import EDGE
from pyspark.sql import functions as F

SF = "/root/testdata/sf0.01"


def test_language_held_out_accuracy(spark):
    rows = QUERIES["op4_language"](spark, SF).join(table(spark, SF, "documents").select("doc_id", "lang"), "doc_id").collect()
    held = [r for r in rows if r.held_out]
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in rows)
    assert sum(r.lang == r.lang_pred for r in held) >= 0.97 * len(held)
    assert all(0 <= r.score <= 1 for r in rows)


def test_language_edge_rows(frame):
    teach = [(100 + i, "der die das und ist ein haus am see", "de") for i in range(30)] + [(200 + i, "the house is on the lake and it is old", "en") for i in range(30)]
    rows = frame(teach + [(i, t, None) for i, t in EDGE] + [(50, "12 34 !?", "en"), (51, "HAUS UND SEE", "de")])
    got = {(r.doc_id, r.lang_pred, r.held_out) for r in language.query(rows).collect()}
    pred = {d: p for d, p, _ in got}
    assert pred[1] == pred[2] == pred[3] == pred[50] == "und" and pred[51] == "de" and pred[4] in ("de", "en")
    assert language.query(frame([])).collect() == []
    untaught = {r.lang_pred for r in language.query(frame([(i, t) for i, t in EDGE])).collect()}
    assert untaught == {"und"}


def test_language_long_texts_are_counted_whole():
    import numpy as np
    text = "ab" * (language.SLICE // 2) + " the end of it"
    a, b = language.features([text, "x", text]), language.features([text])
    assert np.allclose(a[0], b[0]) and np.allclose(a[0], a[2])
    assert np.abs(language.features([text[:-14]])[0] - b[0]).max() > 1e-5


def test_toxicity_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.1"
    labels = table(spark, sf, "labels").select("doc_id", "toxic")
    rows = QUERIES["op10_toxicity"](spark, sf).join(labels, "doc_id").collect()
    held = [r for r in rows if r.held_out]
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) and r.predicted == (r.score >= 0.5) for r in rows)
    found = sum(r.predicted and r.toxic for r in held)
    assert found >= 0.85 * sum(r.toxic for r in held)
    assert sum(r.predicted and not r.toxic for r in held) <= 0.01 * len(held)


def test_toxicity_edge_rows(spark, frame):
    toxic = [(100 + i, f"you are an idiot and a pathetic clown number {i}") for i in range(40)]
    clean = [(200 + i, f"what a lovely day it is, number {i}, in the garden") for i in range(120)]
    labels = spark.createDataFrame([(i, 1) for i, _ in toxic] + [(i, 0) for i, _ in clean] + [(100, 0), (None, 1), (200, None), (9999, 1)],
                                   "doc_id long, toxic int")
    docs = frame(toxic + clean + EDGE)
    got = {r.doc_id: r.score for r in toxicity.query(docs, labels).collect()}
    assert toxicity.query(docs, labels).count() == len(toxic + clean + EDGE)
    assert min(got[i] for i, _ in toxic) > 0.5 > max(got[i] for i, _ in clean) and got[1] == got[2] and 0 <= got[7] < 0.5
    nobody = spark.createDataFrame([], "doc_id long, toxic int")
    alone = {r.doc_id: r.score for r in toxicity.query(docs, nobody).collect()}
    assert alone[100] > alone[200]
    assert toxicity.query(frame([]), nobody).collect() == []


def test_label_model_discounts_voters_that_repeat_each_other():
    """Voters 0, 1 and 2 are copies; voter 3 is as accurate on its own. One
    fresh vote beside a copy must count more than two more copies."""
    rng = random.Random(1)
    cells = Counter()
    for _ in range(20000):
        y = rng.random() < 0.3
        a, b = rng.random() < (0.7 if y else 0.1), rng.random() < (0.7 if y else 0.1)
        cells[(a, a, a, b), int(y) if rng.random() < 0.3 else -1] += 1
    model = toxicity.fit_label_model([[int(v) for v in k[0]] for k in cells], list(cells.values()), [k[1] for k in cells])
    copies, fresh = model.posterior([[1, 1, 1, 0], [1, 1, 1, 1]])
    exact = lambda a, b: 1 / (1 + 0.7 / 0.3 * math.prod((0.1 / 0.7 if v else 0.9 / 0.3) for v in (a, b)))
    assert abs(copies - exact(1, 0)) < 0.1 and abs(fresh - exact(1, 1)) < 0.05


def segmentations(s, pieces):
    """All ways to cut ``s`` in pieces."""
    if not s:
        yield ()
    for k in range(1, len(s) + 1):
        if s[:k] in pieces:
            for rest in segmentations(s[k:], pieces):
                yield (s[:k], *rest)


@pytest.fixture(scope="module")
def small_lattice():
    pieces, weights, _ = lattice.vocabulary(lattice.DEFAULT_VOCABULARY)
    total = sum(weights) * 1.005
    return lattice.Lattice(lattice.DEFAULT_VOCABULARY, [math.log(w / total) for w in weights] + [math.log(0.005 / 1.005)])


def test_forward_adds_all_segmentations(small_lattice):
    pieces, _, _ = lattice.vocabulary(lattice.DEFAULT_VOCABULARY)
    known = {p: i for i, p in enumerate(pieces) if p}
    words = sorted(["the", "then", "there", "theory", "a", "aa", "zebra", "internationally", "straße", "x1y2"])
    for word, alpha in small_lattice.forward(words):
        s = lattice.MARK + word
        brute = sum(math.exp(sum(small_lattice.logs[known[p]] for p in cut)) for cut in segmentations(s, known))
        assert alpha[len(s)] == pytest.approx(math.log(brute), rel=1e-9)
        assert small_lattice.forward_long(s)[len(s)] == pytest.approx(alpha[len(s)], rel=1e-9)


def test_expected_uses_of_pieces(small_lattice):
    pieces, _, _ = lattice.vocabulary(lattice.DEFAULT_VOCABULARY)
    known = {p: i for i, p in enumerate(pieces) if p}
    for word in ("theory", "international"):
        s, expected = lattice.MARK + word, Counter()
        cuts = {cut: math.exp(sum(small_lattice.logs[known[p]] for p in cut)) for cut in segmentations(s, known)}
        for cut, p in cuts.items():
            for piece in cut:
                expected[known[piece]] += 3 * p / sum(cuts.values())
        got = [0.0] * len(small_lattice.logs)
        (_, alpha), = small_lattice.forward([word])
        small_lattice.expect(word, 3, alpha, got)
        assert {i: pytest.approx(x, rel=1e-6) for i, x in expected.items()} == {i: x for i, x in enumerate(got) if x}


def brute_base(rows):
    held = lambda i: zlib.crc32(str(i).encode()) % 10 == 0
    words = {k: (t or "").encode().lower().split() for k, (i, t) in enumerate(rows)}
    taught = [k for k, (i, _) in enumerate(rows) if i is not None and not held(i) or i is None]
    c = Counter(itertools.chain.from_iterable([*words[k], None] for k in taught))
    n, v = sum(c.values()), len(c)
    return [(len(words[k]) + 1, sum(c[w] > 0 for w in [*words[k], None]), n,
             sum(math.log10((c[w] + 0.1) / (n + 0.1 * (v + 1))) for w in [*words[k], None])) for k in range(len(rows))]


@pytest.mark.parametrize("hot", [0, 3, 1 << 18])
def test_lm_scores_equal_brute_force(frame, hot):
    rng = random.Random(5)
    rows = EDGE + [(1000 + i, " ".join(rng.choice(["the", "The", "cat", "sat", "on", f"mat{i % 7}", "über", "\U0001f642", "qq" * (i % 5)]) for _ in range(i)))
                   for i in range(60)]
    got = lattice.score(frame(rows), F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(10)) == 0, hot=hot).collect()
    key = lambda x: (x[0], x[1], x[2], round(x[3], 6))
    assert sorted(key((r.n_tokens, r.n_known, r.train_tokens, r.base_score)) for r in got) == sorted(map(key, brute_base(rows)))
    assert all(r.score < 0 and math.isfinite(r.score) for r in got)
    by = {r.doc_id: r for r in got}
    assert by[1].score == by[2].score == by[3].score and by[7].score == by[9].score


def test_lm_marginals_do_not_depend_on_the_broadcast_and_empty_tables(frame):
    rows = [(i, f"some words of text {i} and more") for i in range(30)]
    a, b = ({r.doc_id: r.score for r in lattice.score(frame(rows), F.col("doc_id") % 10 == 0, hot=h).collect()} for h in (0, 1000))
    assert a == {k: pytest.approx(x) for k, x in b.items()}
    assert lattice.query(frame([])).collect() == []


def test_lm_learns_from_training_documents(spark):
    """The fitted pieces describe held-out texts better than those of the
    vocabulary file."""
    docs = table(spark, "/root/testdata/sf0.001", "documents")
    held = F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(10)) == 0
    fitted, plain = (lattice.score(docs, held, rounds=r).filter("held_out").agg(F.sum("score")).first()[0] for r in (1, 0))
    assert fitted > plain
