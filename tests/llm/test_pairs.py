"""Jaccard join, nearest neighbours and WARC against brute force."""

import itertools
import random

import duckdb
import pytest

from hourglass.llm import jaccard, nearest, warc
from hourglass.llm.shingles import shingle_sets
from hourglass.llm.storage import new_path
from llm_edge import EDGE
from oracle_compare import digest
from pyspark.sql import functions as F


def shingled(text):
    w = (text or "").encode().lower().split()
    return frozenset() if not w else frozenset([tuple(w)]) if len(w) < 5 else frozenset(tuple(w[i:i + 5]) for i in range(len(w) - 4))


def groups(rows, percent=80):
    sets = {}
    for i, t in rows:
        if i is not None:
            sets.setdefault(i, []).append(shingled(t))
    up = {i: i for i in sets}

    def top(i):
        while up[i] != i:
            i = up[i]
        return i

    for a, b in itertools.combinations(sorted(sets), 2):
        if top(a) != top(b) and any(100 * len(x & y) >= percent * len(x | y) > 0 for x in sets[a] for y in sets[b]):
            lo, hi = sorted((top(a), top(b)))
            up[hi] = lo
    return {i: top(i) for i in sets}


def corpus(seed, families=12, words=300):
    """Families of copies that differ in some words, so that some link only
    through others."""
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(words)]
    passage = [rng.choice(vocabulary) for _ in range(40)]
    rows = []
    for _ in range(families):
        base = [rng.choice(vocabulary) for _ in range(rng.choice([3, 5, 8, 20, 60, 150]))]
        if rng.random() < 0.4:
            base += passage
        for _ in range(rng.choice([1, 2, 25])):
            w = list(base)
            for _ in range(rng.choice([0, 0, 1, 1, 2, 3, 5])):
                w[rng.randrange(len(w))] = rng.choice(vocabulary)
            rows.append((len(rows), " ".join(w[:-1] if rng.random() < 0.3 else w)))
    return rows


def test_shingles_equal_brute_force():
    import numpy as np
    import pyarrow as pa
    texts = [t for _, t in corpus(1)] + [t for _, t in EDGE] + ["A b  C", "a B c", "a\x1cb c", None, ""]
    _, found, n = shingle_sets(pa.array(texts))
    sets = [set(x.tolist()) for x in np.split(found, np.cumsum(n)[:-1])]
    want = [shingled(t) for t in texts]
    assert [len(s) for s in sets] == [len(w) for w in want]
    for i, j in itertools.combinations(range(len(texts)), 2):
        assert len(sets[i] & sets[j]) == len(want[i] & want[j])


@pytest.mark.parametrize("seed,percent,small", [(1, 80, 32), (2, 80, 2), (3, 60, 2)])
def test_components_equal_all_pairs(frame, monkeypatch, seed, percent, small):
    monkeypatch.setattr(jaccard, "SMALL_BUCKET", small)
    rows = corpus(seed) + [(i and 5000 + i, t) for i, t in EDGE] + [(6000, "a b c d e f"), (6000, "q r s t u v"), (6001, "A B C D E F"), (6002, "q r s t u v")]
    got = jaccard.join(frame(rows), percent=percent).collect()
    want = groups(rows, percent)
    assert len(got) == len(rows)
    assert {(r.doc_id, r.component_id) for r in got} == {(i, want.get(i)) for i, _ in rows}
    assert sorted(r.n_shingles for r in got) == sorted(len(shingled(t)) for _, t in rows)


@pytest.mark.parametrize("seed,percent,part", [(1, 80, 256), (4, 80, 3), (3, 60, 2)])
def test_links_equal_all_pairs(frame, monkeypatch, seed, percent, part):
    monkeypatch.setattr(jaccard, "PART", part)
    monkeypatch.setattr(jaccard, "COLUMNS", 16 * part)
    monkeypatch.setattr(jaccard, "TILE", 1 + part // 3)
    monkeypatch.setattr(jaccard, "DEALT", 1 + part // 2)
    mixed = [(6000, "a b c d e f"), (6000, "q r s t u v"), (6001, "A B C D E F"), (6002, "q r s t u v"), (6003, "a b c d e f"), (6003, "q R s t u v")]
    rows = corpus(seed) + [(i and 5000 + i, t) for i, t in EDGE] + mixed
    rows += [(7000 + k % 7, t) for k, (_, t) in enumerate(corpus(seed)[:40])] + [(8000 + i, t) for i, t in corpus(seed)[:30]]
    sets = {}
    for i, t in rows:
        if i is not None and t and t.split():
            sets.setdefault(i, set()).add(shingled(t))
    alike = lambda x, y: 100 * len(x & y) >= percent * len(x | y)
    want = {i: sum(j != i and any(alike(x, y) for x in sets[i] for y in sets[j]) for j in sets) for i in sets}
    got = jaccard.query(frame(rows)).collect() if percent == jaccard.PERCENT else jaccard.linked(frame(rows), percent=percent).collect()
    assert len(got) == len(rows) and max(want.values()) > 25
    assert {(r.doc_id, r.n_links) for r in got} == {(i, want.get(i, 0)) for i, _ in rows}


def test_chains_reach_their_smallest_member(spark):
    edges = [(i, i + 1) for i in range(1, 40)] + [(100 + i, 100) for i in range(1, 30)] + [(200, 201), (201, 202), (202, 200)]
    rng = random.Random(2)
    rng.shuffle(edges)
    got = dict(map(tuple, jaccard.components(spark.createDataFrame(edges, "a long, b long")).collect()))
    assert got == {**{i: 1 for i in range(1, 41)}, **{100 + i: 100 for i in range(30)}, **{200 + i: 200 for i in range(3)}}


def test_join_of_empty_tables_and_of_nothing_alike(frame):
    assert jaccard.join(frame([])).collect() == []
    rows = [(i, f"only {i} here are words of {i} its own {i} kind") for i in range(5)]
    assert {(r.doc_id, r.component_id) for r in jaccard.join(frame(rows)).collect()} == {(i, i) for i in range(5)}


VECTORS = [(i, [float((i * 7 + d * 3) % 11 - 5) for d in range(6)]) for i in range(120)] + [
    (200, None), (201, []), (202, [0.0] * 6), (203, [1.0, None, 1.0, 1.0, 1.0, 1.0]), (204, [1.0, float("nan"), 1.0, 1.0, 1.0, 1.0]),
    (205, [float("inf")] + [1.0] * 5), (206, [1.0, 2.0]), (220, [2.0, 1.0]), (221, [1e-44] * 6), (222, [3e38] * 6), (None, [1.0] * 6), (40, [1.0] * 6)]


@pytest.mark.parametrize("sizes", [(8192, 8192, 512), (3, 17, 8)])
def test_neighbours_equal_brute_force(spark, sizes):
    df = spark.createDataFrame(VECTORS, "vec_id long, embedding array<float>").withColumn("score", F.lit(1.0)).withColumn("id", F.lit("x"))
    con = duckdb.connect()
    con.register("embeddings", df.filter("vec_id IS NOT NULL AND vec_id <> 40").toArrow())
    cur = con.execute(nearest.ORACLE_SQL)
    columns, want = [d[0] for d in cur.description], cur.fetchall()
    block, slice_rows, tile = sizes
    got = nearest.search(df.filter("vec_id IS NULL OR vec_id <> 40"), F.col("id") % 20 == 0, query_block=block, slice_rows=slice_rows, tile=tile) \
        .select("query_id", "rank", F.col("id").alias("vec_id"), "score")
    assert digest(got.columns, [tuple(r) for r in got.collect()]) == digest(columns, want)


def test_repeated_ids_many_ties_and_few_candidates(spark):
    same = spark.createDataFrame([(i % 50, [1.0, 2.0]) for i in range(100)], "vec_id long, embedding array<float>")
    rows = nearest.query(same).collect()
    assert {r.query_id for r in rows} == {0, 20, 40} and all(r.vec_id != r.query_id and r.score == 5.0 for r in rows)
    assert [r.vec_id for r in sorted(rows, key=lambda r: r["rank"]) if r.query_id == 40][:4] == [0, 0, 1, 1]
    few = spark.createDataFrame([(0, [1.0]), (1, [2.0]), (2, [3.0])], "vec_id long, embedding array<double>")
    assert [(r.vec_id, r["rank"]) for r in nearest.query(few).orderBy("rank").collect()] == [(2, 1), (1, 2)]
    assert nearest.query(few.limit(0)).collect() == [] and nearest.query(few.limit(1)).collect() == []


PAGES = [(1, "http://a", "<p>same</p>"), (2, "http://b\r\nx", "<p>same</p>"), (9, None, "<p>same</p>"), (3, "http://c", None), (4, "u", ""),
         (5, "http://long", "Ä\U0001f642 é\r\n\r\n" * 9000), (6, "http://long2", "Ä\U0001f642 é\r\n\r\n" * 9000), (7, "u", "0\r\n\r\nWARC/1.1\r\n"),
         (7, "u", "0\r\n\r\nWARC/1.1\r\n"), (8, "w", "x" * 16384)]


def pages_frame(spark, rows=PAGES):
    return spark.createDataFrame([(*r, "x") for r in rows], "page_id long, url string, html string, payload string")


def test_archives_equal_sql(spark):
    con = duckdb.connect()
    con.register("pages", pages_frame(spark).toArrow())
    cur = con.execute(warc.ORACLE_SQL)
    columns, want = [d[0] for d in cur.description], cur.fetchall()
    got = warc.query(pages_frame(spark))
    assert digest(got.columns, [tuple(r) for r in got.collect()]) == digest(columns, want)
    assert warc.query(pages_frame(spark).limit(0)).collect() == []


def test_round_trip_with_small_segments_over_many_files(spark):
    path = new_path(spark, "test-warc")
    warc.write_pages(pages_frame(spark), path, segment_bytes=700, chunk_bytes=97, records_per_file=3)
    rows = warc.read_records(spark, path).collect()
    assert len(rows) == len(PAGES) and all(r.problem is None for r in rows)
    by = {r.record_id: r for r in rows}
    assert by["urn:page:6"].payload.decode() == PAGES[5][2] and by["urn:page:6"].segments > 100
    assert by["urn:page:2"].record_type == "revisit" and by["urn:page:2"].refers_to == "urn:page:9" and by["urn:page:2"].uri == "http://b%0D%0Ax"


LONG = "l\u00f6ng " * 9000
REPEATED = [(1, "a", LONG), (1, "a", LONG), (1, "b", LONG + "."), (2, "c", LONG + "."), (2, "c", "short"), (2, "c", "short"), (0, None, LONG), (0, None, LONG),
            (3, "d", "short"), (3, "e", "short"), (3, "e", "other"), (-4, "f", "other"), (None, "n", LONG), (None, "n", LONG), (None, None, LONG + "!"),
            (None, None, None), (None, "", ""), (1, "a", None)]


@pytest.mark.parametrize("copies", [1000, 1])
def test_repeated_and_null_ids_longer_than_a_segment(spark, monkeypatch, copies):
    monkeypatch.setattr(warc, "COPIES", copies, raising=False)
    con = duckdb.connect()
    con.register("pages", pages_frame(spark, REPEATED).toArrow())
    cur = con.execute(warc.ORACLE_SQL)
    columns, want = [d[0] for d in cur.description], cur.fetchall()
    got = warc.query(pages_frame(spark, REPEATED))
    assert digest(got.columns, [tuple(r) for r in got.collect()]) == digest(columns, want)
    path = new_path(spark, "test-repeated")
    warc.write_pages(pages_frame(spark, REPEATED), path)
    rows = warc.read_records(spark, path).collect()
    by = {r.record_id: r for r in rows}
    assert len(by) == len(rows) == len(REPEATED) and all(r.problem is None for r in rows)
    assert all(by[r.refers_to].stated_digest == r.stated_digest for r in rows if r.record_type == "revisit")


def test_missing_segments_and_broken_payloads_are_told(spark):
    whole = list(warc.page_records("urn:a", "u", b"x" * 5000, None, 1000, 512, b"2024-01-01T00:00:00Z"))
    other = list(warc.page_records("urn:b", "u", b"y" * 5000, None, 1000, 512, b"2024-01-01T00:00:00Z"))
    wrong = warc._record(b"response", "urn:c", b"HTTP/1.1 200 OK\r\nTransfer-Encoding: chunked\r\n\r\n5\r\nabc", b"2024-01-01T00:00:00Z")
    plain = warc._record(b"response", "urn:d", b"HTTP/1.1 200 OK\r\nContent-Length: 3\r\n\r\nabcdef", b"2024-01-01T00:00:00Z")
    swapped = [other[0].replace(b"y" * 100, b"z" * 100, 1), *other[1:]]
    records = [*reversed(whole[:2] + whole[3:]), *reversed(swapped), wrong, plain]
    path = new_path(spark, "test-broken")
    spark.createDataFrame([(bytearray(r),) for r in records], "r binary").select(F.col("r").cast("string")) \
        .write.option("lineSep", warc.END).text(path)
    by = {r.record_id: r for r in warc.read_records(spark, path).collect()}
    assert by["urn:a"].payload is None and "segments" in by["urn:a"].problem
    assert by["urn:b"].payload is None and "digest" in by["urn:b"].problem
    assert by["urn:c"].payload is None and by["urn:c"].problem and by["urn:d"].payload == b"abc"


def test_a_cluster_twice_as_large_sends_twice_the_bytes(frame, monkeypatch):
    """Each set is told by its differences to the first one of its component."""
    sent, kept = [], jaccard.written

    def written(df, tag):
        out = kept(df, tag)
        if tag == "jaccard-differences":
            sent.append((out.count(), out.agg(F.sum(F.length("diffs"))).first()[0], out.agg(F.max("n")).first()[0]))
        return out

    monkeypatch.setattr(jaccard, "written", written)
    base = [f"w{i}" for i in range(120)]
    for n in (40, 80):
        rows = [(0, " ".join(base))] + [(1 + i, " ".join([*base[:i + 10], f"x{i}", *base[i + 11:]])) for i in range(n)]
        got = jaccard.linked(frame(rows)).collect()
        assert {(r.component_id, r.n_links) for r in got} == {(0, n)}
    (a, small, size), (b, large, _) = sent
    assert (a, b) == (41, 81) and large == 2 * small
    assert small / 8 / 40 <= 10 < size          # five shingles lacking and five new, not the whole set
