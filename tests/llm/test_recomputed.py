"""Scores, features, votes and digests of the queries computed again in plain Python."""

import hashlib
import math
import random
import struct
import zlib

import pytest
from pyspark.sql import functions as F

from hourglass.llm import bpe, language, lattice, toxicity
from llm_edge import EDGE

WORDS = "the quick brown fox jumps over the lazy dog and runs to town Häuser ñandú straße naïve".split()


def texts(seed, n=60):
    rng = random.Random(seed)
    return [" ".join(rng.choice(WORDS) for _ in range(rng.randrange(1, 30))) for _ in range(n)]


def test_bpe_query_equals_the_library(frame):
    from public_tokenizers import path
    from tokenizers import Tokenizer
    tok = Tokenizer.from_file(path("byte_bpe_50k.json"))
    tok.no_truncation()
    tok.no_padding()
    rows = [(100 + i, t) for i, t in enumerate(texts(1))] + EDGE
    want = []
    for i, t in rows:
        ids = tok.encode(t or "", add_special_tokens=False).ids
        decoded = tok.decode(ids, skip_special_tokens=False)
        want.append((i, len(ids), hashlib.sha256(struct.pack(f"<{len(ids)}I", *ids)).hexdigest(), hashlib.sha256(decoded.encode()).hexdigest()))
    got = [(r.doc_id, r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in bpe.digests(frame(rows)).collect()]
    assert sorted(got, key=str) == sorted(want, key=str)


def plain_features(text):
    """Square roots of the counts of hashed byte pairs and triples, of length 1."""
    mask, data = (1 << 32) - 1, bytes(b if b >= 128 or chr(b).isalpha() else 32 for b in (text or "").lower().encode()) + b"   "
    out = [0.0] * (language.DIM + 1)
    for i in range(len(data) - 2):
        a, b, c = data[i:i + 3]
        two = (a * 0x9E3779B1 + b * 0x85EBCA77) & mask
        three = ((two ^ (c * 0xC2B2AE3D & mask)) * 0x27D4EB2F & mask) >> 20
        out[two >> 20] += 1
        out[three] += 1
    norm = math.sqrt(sum(out))
    return [math.sqrt(x) / max(norm, 1e-9) for x in out[:-1]] + [1.0]


def test_language_features_and_duels(frame):
    rows = [(i, t, "en" if i % 2 else "de") for i, t in enumerate(texts(2))] + [(100 + i, "un gato y la casa " + str(i), "es") for i in range(20)]
    some = [t for _, t, _ in rows[:12]] + ["", "Ünï \U0001f642 a1b", "x" * 3000]
    got = language.features(some)
    for x, t in zip(got, some):
        want = plain_features(t)
        assert max(abs(a - b) for a, b in zip(x.tolist(), want)) < 1e-5, t
    model = language.fit(frame(rows), F.lit(True))
    langs, scores = language.predict_rows(model, some)
    for t, found, score in zip(some, langs, scores):
        if not language.has_letter(t):
            assert (found, score) == (language.UNKNOWN, 0.0)
            continue
        x, key, product = plain_features(t), "", 1.0
        for _ in range(2):
            names = model.classes[key]
            p = {n: [] for n in names}
            votes = {n: 0 for n in names}
            for d in model.duels[key]:
                m = sum(a * b for a, b in zip(x, d.weights))
                q = 1 / (1 + math.exp(-(d.slope * m + d.shift)))
                votes[d.first if m > 0 else d.second] += 1
                p[d.first].append(q)
                p[d.second].append(1 - q)
            total = sum(map(sum, p.values())) or 1.0
            key = max(names, key=lambda n: votes[n] + sum(p[n]) / total / 2)
            product *= min(p[key], default=1.0)
        assert found == key and abs(score - product) < 1e-3, (t, found, key)


def test_null_ids_are_never_held_out(frame):
    rows = frame([(None, "the house"), (1, "the house"), (4, "das haus")])
    assert {r.doc_id: r.held_out for r in language.query(rows).collect()} == {
        None: False, 1: zlib.crc32(b"1") % 3 == 1, 4: zlib.crc32(b"4") % 3 == 1}
    labels = rows.select("doc_id", F.lit(0).alias("toxic"))
    assert {r.doc_id: r.held_out for r in toxicity.query(rows, labels).collect()} == {
        None: False, 1: zlib.crc32(b"1") % 5 == 0, 4: zlib.crc32(b"4") % 5 == 0}


def matches(pattern, text):
    text, n = (text or "").lower(), len(pattern.text)
    return sum(text.startswith(pattern.text, i) and (i == 0 or not text[i - 1].isalpha())
               and (not pattern.whole or i + n == len(text) or not text[i + n].isalpha()) for i in range(len(text)))


def test_toxicity_votes_densities_and_scores(spark, frame):
    rng = random.Random(3)
    insults = ["idiot", "idiots", "you moron", "Dummkopf", "garbage", "clown", "trashy", "go to hell", "blöder", "zorgwyx zorgwyxen zorgwy"]
    rows = [(i, " ".join(rng.choice(insults) if rng.random() < 0.3 else rng.choice(WORDS) for _ in range(20))) for i in range(40)]
    rows += [(100 + i, t) for i, t in enumerate(texts(4, 160))]
    labels = spark.createDataFrame([(i, int(i < 100)) for i, _ in rows], "doc_id long, toxic int")
    model = toxicity.fit(frame(rows), labels, F.lit(True))
    assert any(p.text.startswith("zorg") for p in model.patterns)          # a mined voter
    some = [t for _, t in rows[::7]] + [None, "", "idiot", "word " * 999 + "idiot", "word " * 1001 + "idiot"]
    width = len(model.patterns)
    for t, x, s in zip(some, toxicity.densities(model.patterns, some), model.scores(some)):
        words, found = len((t or "").split()), [matches(p, t) for p in model.patterns]
        voters = [sum(n for p, n in zip(model.patterns, found) if p.voter == v) for v in range(toxicity.VOTERS)]
        vote = [int(n > 0 and (n >= toxicity.DENSE * words if v < len(toxicity.LEXICON) else n > 1 and n >= toxicity.DENSE_MINED * words))
                for v, n in enumerate(voters)]
        dense = [min(1.0, 50 * n / max(words, 1)) if n > 1 or (n and p.voter < len(toxicity.LEXICON)) else 0.0 for p, n in zip(model.patterns, found)]
        assert x[:width].tolist() == pytest.approx(dense) and x[width:-1].tolist() == vote and x[-1] == 1, t
        assert toxicity.votes(model.patterns, t) == sum(b << v for v, b in enumerate(vote))
        z = sum(a * b for a, b in zip([*dense, *vote, 1.0], model.weights))
        assert s == pytest.approx(1 / (1 + math.exp(-max(-40, min(40, z)))), abs=1e-9)


def segmentations(s, known):
    if not s:
        yield ()
    for k in range(1, len(s) + 1):
        if s[:k] in known:
            for rest in segmentations(s[k:], known):
                yield (s[:k], *rest)


@pytest.mark.parametrize("hot", [0, 1000])
def test_document_scores_over_all_segmentations(spark, frame, hot):
    small = ["cat", "dogs", "at", "home", "the", "sea"]
    rng = random.Random(5)
    rows = [(i, " ".join(rng.choice(small) for _ in range(rng.randrange(0, 12)))) for i in range(25)] + [(90, None), (91, "Cat THE zq")]
    docs = frame(rows, extra=False)
    held = F.col("doc_id") % 10 == 0
    pieces, _, _ = lattice.vocabulary(lattice.DEFAULT_VOCABULARY)
    known = {p: i for i, p in enumerate(pieces) if p}
    words = lattice.word_counts(docs.select("doc_id", "text", F.coalesce(held, F.lit(False)).alias("held_out")))
    path = lattice.DEFAULT_VOCABULARY
    logs = lattice.piece_logs(words, sum(i % 10 != 0 for i, _ in rows), path, lattice.ROUNDS)
    for r in lattice.score(docs, held, hot=hot).collect():
        text = dict(rows)[r.doc_id]
        want = logs[-1] / math.log(10)
        for w in (text or "").lower().split():
            want += math.log10(sum(math.exp(sum(logs[known[p]] for p in cut)) for cut in segmentations(lattice.MARK + w, known)))
        assert r.score == pytest.approx(want, rel=1e-9), (r.doc_id, text)
