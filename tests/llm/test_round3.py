"""Collocations, min-max hashing and conversation repair against brute force."""

import collections
import hashlib
import itertools
import random
import re
import zlib

import numpy as np
import pytest

from hourglass.llm import collocations, minhash, repair
from llm_edge import EDGE
from test_pairs import corpus


# ---- collocations -------------------------------------------------------------
def phrases(rows, min_count, top):
    lower = lambda t: "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t)
    f, n = collections.Counter(), collections.Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for piece in re.split("[.,;:!?\x0a-\x0d]", lower(text or "")):
            w = re.findall("[^ \t]+", piece)
            n[lang] += len(w)
            f.update((lang, *w[i:i + k]) for k in (1, 2, 3) for i in range(len(w) - k + 1))
    candidates = {p: a for p, a in f.items() if len(p) > 2 and a >= min_count}
    out = []
    for (lang, *w), a in candidates.items():
        if any(100 * c >= 50 * a and q[0] == lang and len(q) > len(w) + 1
               and any(list(q[i:i + len(w)]) == w for i in range(1, len(q) - len(w) + 1)) for q, c in candidates.items()):
            continue
        score, k, left, right = min((10 ** 6 * a * a // (f[(lang, *w[:k])] * f[(lang, *w[k:])]), k, f[(lang, *w[:k])], f[(lang, *w[k:])])
                                    for k in range(1, len(w)))
        out.append((lang, score, a, " ".join(w), left, right))
    kept = []
    for lang, group in itertools.groupby(sorted(out, key=lambda r: (r[0], -r[1], -r[2], r[3].encode())), key=lambda r: r[0]):
        kept += [(lang, i + 1, p, a, x, y, n[lang], s) for i, (_, s, a, p, x, y) in enumerate(group) if i < top]
    return sorted(kept)


def test_collocations_equal_brute_force(spark, frame, monkeypatch):
    rng = random.Random(3)
    words = ["new", "York", "is", "the", "big", "city", "Ünï", "of"]
    rows = []
    for i in range(150):
        text = "".join(rng.choice(words) + rng.choice([" ", " ", " ", "\t", ", ", ".\n", "! ", "  "]) for _ in range(rng.randrange(40)))
        rows.append((i % 140, text, rng.choice(["en", "de", None, "und", "a\nb"])))
    rows += [(i, t, "en") for i, t in EDGE]
    want = phrases([(lang, t) for _, t, lang in rows], 4, 30)
    got = lambda: sorted(tuple(r) for r in collocations.collocations(frame(rows).repartition(3), 4, 30).collect())
    assert got() == want and len(want) > 60
    assert all(collocations.hot_beginnings(frame(rows), 50))
    monkeypatch.setattr(collocations, "HOT", 50)  # some words and pairs are dealt out
    monkeypatch.setattr(collocations.phrase_counts, "__defaults__", (4, 50))
    assert got() == want


def test_windows_go_on_over_blocks_and_cuts_end_pieces(monkeypatch):
    monkeypatch.setattr(collocations, "WINDOWS", 5)
    text = b"a b c d e f g h. i j k l m n"
    seen = [w for lang, vocabulary, packed in collocations._blocks([text, b"o p"], ["x", "y"])
            for w in collocations._joined(lang, vocabulary, packed, 3).to_pylist()]
    assert sorted(seen) == sorted(["x\na b c", "x\nb c d", "x\nc d e", "x\nd e f", "x\ne f g", "x\nf g h", "x\ng h ", "x\nh  ", "x\ni j k", "x\nj k l",
                                   "x\nk l m", "x\nl m n", "x\nm n ", "x\nn  ", "y\no p ", "y\np  "])
    assert list(collocations._cut(b"aaa. bbb. ccc", 4)) == [b"aaa. bbb.", b" ccc"]
    assert list(collocations._cut(b"aaaaaaaa", 4)) == [b"aaaaaaaa"]


def test_collocations_of_nothing(spark, frame):
    assert collocations.collocations(frame([(1, None), (2, " .,! ")])).count() == 0
    assert collocations.collocations(frame([(1, "x")]).filter("false")).count() == 0


# ---- min-max hashing ----------------------------------------------------------
def linked(rows, width, percent):
    def shingled(text):
        w = (text or "").encode().lower().split()
        return frozenset() if not w else frozenset([tuple(w)]) if len(w) < width else frozenset(tuple(w[i:i + width]) for i in range(len(w) - width + 1))

    sets = [(i, shingled(t)) for i, t in rows if i is not None]
    up = {i: i for i, _ in sets}

    def top(i):
        while up[i] != i:
            i = up[i]
        return i

    for (a, x), (b, y) in itertools.combinations(sets, 2):
        if top(a) != top(b) and 100 * len(x & y) >= percent * len(x | y) > 0:
            lo, hi = sorted((top(a), top(b)))
            up[hi] = lo
    return sorted(((i, len(shingled(t)), None if i is None else top(i), i is None or top(i) == i) for i, t in rows), key=str)


@pytest.mark.parametrize("seed", [1, 2])
def test_near_duplicates_equal_all_pairs(spark, frame, seed, monkeypatch):
    monkeypatch.setattr(minhash, "PART", 3)
    monkeypatch.setattr(minhash, "TILE", 2)
    monkeypatch.setattr(minhash, "COLUMNS", 50)
    monkeypatch.setattr(minhash, "PARTNERS", 2)
    rows = corpus(seed) + [(i if i is None else 5000 + i, t) for i, t in EDGE] + [(3, "some other words that stand alone here")]
    got = minhash.near_duplicates(frame(rows).repartition(5))
    assert sorted((tuple(r) for r in got.collect()), key=str) == linked(rows, 4, 80)


def test_min_max_values_estimate_the_similarity():
    rng = np.random.default_rng(0)
    for share in (0.2, 0.5, 0.8):
        n = 400
        both = int(2 * n * share / (1 + share))
        agree = []
        for _ in range(40):
            pool = rng.integers(0, 1 << 63, 2 * n - both, dtype="u8")
            a, b = np.sort(pool[:n]), np.sort(pool[n - both:])
            least, greatest = minhash.min_max(np.concatenate([a, b]), np.array([len(a), len(b)]))
            agree.append(np.mean(np.concatenate([least[:, 0] == least[:, 1], greatest[:, 0] == greatest[:, 1]])))
        assert abs(np.mean(agree) - both / (2 * n - both)) < 0.02
    assert minhash.bands(least, greatest).shape == (2, 2 * minhash.PERMUTATIONS // minhash.ROWS)


def test_entries_that_stand_alone_are_neither_sorted_nor_joined(spark):
    rng = np.random.default_rng(4)
    own = rng.integers(-1 << 62, 1 << 62, (3000, 32))
    own[1::100, 5] = own[0, 0]  # a bucket of 31
    own[2:4, 31] = own[2, 31]
    own[7, 2] = own[7, 3]  # twice in one node
    rows = [(i, 10 + i, x.tolist()) for i, x in enumerate(own)]
    nodes = spark.createDataFrame(rows, "doc long, n long, buckets array<long>").repartition(3)
    led = minhash.leaders(nodes)
    assert "SortAggregate" not in led._jdf.queryExecution().toString()
    assert sorted(map(tuple, led.select("bucket", "l.*").collect())) == sorted([(own[0, 0], 0, 10), (own[2, 31], 2, 12)])
    entries = [tuple(r) for r in minhash.may_share(nodes, led).select("doc", "n", "bucket").collect()]
    want = {(i, n, b) for i, n, x in rows for b in x if b in (own[0, 0], own[2, 31])}
    assert len(want) == 33 and want <= set(entries) and len(entries) < 1000
    assert set(entries) <= {(i, n, b) for i, n, x in rows for b in x}


def test_near_duplicates_of_nothing(spark, frame):
    assert minhash.near_duplicates(frame([(1, "x")]).filter("false")).collect() == []
    assert [tuple(r) for r in minhash.near_duplicates(frame([(None, "a b"), (1, None)])).orderBy("doc_id").collect()] == [
        (None, 1, None, True), (1, 0, 1, True)]


# ---- repair -------------------------------------------------------------------
def after_damage(rows):
    out = []
    for conv, turn, role, text in rows:
        kind = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        out += [(turn, "user" if kind == 4 else role, text)] * (0 if kind == 0 else 2 if kind == 3 else 1)
    return sorted(out, key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), r[2].encode()))


def repaired(rows):
    """Bellman over all states with whole audits; inserts as long as they help."""
    seen, faults = set(), []
    for _, role, text in rows:
        words = re.findall("[^ \t-\r]", text)
        faults.append("blank" if not words else "duplicate" if (role, text) in seen else "truncated" if words[-1] not in ".!?" else None)
        seen.add((role, text))
    moves = {0: {"s": 1, "u": 2}, 1: {"u": 2}, 2: {"a": 3}, 3: {"u": 2}}

    def inserted(best):
        for _ in range(3):
            for p, (cost, audit, lines) in list(best.items()):
                for x, q in moves[p].items():
                    if x != "s":
                        found = (cost + 5, audit + "I", (*lines, ("user:" if x == "u" else "assistant:")))
                        best[q] = min(best.get(q, found), found, key=lambda v: v[:2])
        return best

    best = inserted({0: (0, "", ())})
    for (_, role, text), fault in zip(rows, faults):
        after = {}

        def to(q, cost, audit, lines):
            after[q] = min(after.get(q, (cost, audit, lines)), (cost, audit, lines), key=lambda v: v[:2])

        for p, (cost, audit, lines) in best.items():
            to(p, cost + 2, audit + "D", lines)
            if fault in ("blank", "duplicate"):
                continue
            late = 5 if fault == "truncated" else 0
            for x, q in moves[p].items():
                if role[:1] == x:
                    to(q, cost + late, audit + "K", (*lines, f"{role}:{text}"))
                if x != "s":
                    to(q, cost + late + 1, audit + "R", (*lines, ("user:" if x == "u" else "assistant:") + text))
        best = inserted(after)
    cost, audit, lines = min((best[q] for q in (0, 3) if q in best), key=lambda v: v[:2])
    turns = [t for t, *_ in rows if t is not None]
    initials = [r[:1] for _, r, _ in rows]
    return (max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0, *(faults.count(f) for f in ("blank", "duplicate", "truncated")),
            sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:])), cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest())


def conversations(seed, n, longest):
    rng = random.Random(seed)
    rows = []
    for conv in [*range(n), None]:
        for turn in range(rng.randrange(1, longest)):
            role = rng.choice(["user", "assistant", "user", "assistant", "system", "tool", "", None])
            text = rng.choice(["Yes.", "No", "What? ", "ok!\n\t", " ", "", None, "Ünï.", "a. b", "same", "Same."])
            rows.append((conv, rng.choice([turn, turn, turn, turn + 3, None]), role, text))
    return rows + rng.choices(rows, k=n)


@pytest.mark.parametrize("segment,fan", [(256, 16), (3, 2)])
def test_repair_equals_brute_force(spark, segment, fan, monkeypatch):
    monkeypatch.setattr(repair, "SEGMENT", segment)
    monkeypatch.setattr(repair, "FAN", fan)
    rows = conversations(segment, 60, 25)
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], "conv_id long, turn long, role string, text string, audit string, part int")
    got = {r[0]: tuple(r)[1:] for r in repair.repair(df.repartition(4)).collect()}
    want = {c: repaired(after_damage([r for r in rows if r[0] == c])) for c in {r[0] for r in rows}}
    assert got == want
    assert len({len(w[6]) for w in want.values()}) > 10


@pytest.mark.parametrize("insert", [5, 1])  # at 5 a deletion is always cheaper
def test_chained_segments_find_the_same_derivation(monkeypatch, insert):
    monkeypatch.setattr(repair, "INSERTS", {p: [(q, insert, e) for q, _, e in moves] for p, moves in repair.INSERTS.items()})
    rng, seen = random.Random(5), set()
    for _ in range(200):
        steps = [repair.edits(rng.choice("xsuaoSUAO")) for _ in range(rng.randrange(1, 14))]
        cut = rng.randrange(len(steps) + 1)
        whole = repair.lightest(steps, 0, repair.ACCEPTED)
        parts = [{p: [(i["q"], i["cost"], i["audit"]) for i in repair._items(part, False) if i["p"] == p] for p in repair.STATES}
                 for part in (steps[:cut], steps[cut:])]
        assert repair.lightest(parts, 0, repair.ACCEPTED) == whole
        best = min(whole.values())
        seen.add("I" in best[1])
        assert list(repair.lightest(parts, 0, repair.ACCEPTED, every=False).values()) == [best]
    assert (True in seen) == (insert == 1)


def test_repair_of_nothing(spark):
    schema = "conv_id long, turn long, role string, text string"
    assert repair.repair(spark.createDataFrame([], schema)).collect() == []
    gone = next((c, t) for c in range(100) for t in range(3) if zlib.crc32(f"{c}:{t}".encode()) % 20 == 0)
    got = repair.repair(spark.createDataFrame([(*gone, "user", "x")], schema)).collect()
    assert [tuple(r) for r in got] == [(gone[0], 0, 0, 0, 0, 0, 0, "", hashlib.sha256().hexdigest())]
    long = "word " * 400_000 + "."
    alone = next((c, 0) for c in range(100) if zlib.crc32(f"{c}:0".encode()) % 20 > 4)
    got = repair.repair(spark.createDataFrame([(*alone, "user", long)], schema)).first()
    assert (got.cost, got.audit) == (2, "D")
