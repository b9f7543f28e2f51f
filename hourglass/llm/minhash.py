"""Near-duplicate documents by min-max hashing (operator 12).

``PERMUTATIONS`` random permutations of the shingles' hashes are evaluated; of each, both
the least and the greatest value of a set are kept, so that 64 evaluations give
128 signature values. Either agrees between two sets with a chance of their
similarity; that a set's least and greatest agree is negatively correlated
between the two, which lowers the estimate's variance. A band has ``ROWS``
values, either least or greatest ones of different permutations, which are
independent; with 32 bands of four a pair of similarity 0.8 meets in none with a
chance of 5 in 10^8, and fewer for more similar ones.

Equal sets are one node. Each node is first verified against the least document
of each of its buckets, on the full shingle sets; linked nodes get a common
label. Buckets that hold different labels still (of those with the same nodes
one) are then compared whole: their full sets, as products of matrices that
tell which set holds which shingle, in pairs of parts of ``PART`` sets or
``PART_SHINGLES`` shingles, so that no task holds a large bucket. A
part gives the links that join labels and makes no row for any other pair. A
verification ships a text to its partner's place, where the partner's set is
made once for thousands of pairs. Components are the smallest reachable doc_id.

Defined cases: null, empty or blank texts have no shingles and are linked with
nothing; a text of fewer words than a shingle is one shingle of all its words;
equal texts are linked; rows with equal doc_id count as one document, linked if any of its texts
is; a row without doc_id is linked with nothing, has component null and is kept;
texts are read whole; other columns are ignored; empty tables give empty
results. Shingles are compared by 64-bit hashes.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hourglass.llm.jaccard import components, marked, sifted
from hourglass.llm.storage import BATCH_ROWS, batch_rows, written

WIDTH, PERCENT = 4, 80
PERMUTATIONS, ROWS, SEED = 64, 4, 20
#: Sets of a bucket in a part, and their shingles, about; sets and columns of a
#: matrix; pairs of a document in a task's group.
PART, PART_SHINGLES, TILE, COLUMNS, PARTNERS = 4096, 1_000_000, 512, 4096, 4096


def min_max(found, sizes):
    """The least and greatest values of each non-empty set under each permutation, as
    arrays of (PERMUTATIONS, sets); ``found`` holds the sets one after the other."""
    import numpy as np
    rng = np.random.default_rng(SEED)
    odd = rng.integers(0, 1 << 63, PERMUTATIONS, dtype="u8") * np.uint64(2) + np.uint64(1)
    flip = rng.integers(0, 1 << 63, PERMUTATIONS, dtype="u8")
    starts = np.cumsum(sizes) - sizes
    least, greatest = np.empty((2, PERMUTATIONS, len(sizes)), "u8")
    for k in range(PERMUTATIONS if len(sizes) else 0):
        x = (found ^ flip[k]) * odd[k]
        np.minimum.reduceat(x, starts, out=least[k])
        np.maximum.reduceat(x, starts, out=greatest[k])
    return least, greatest


def bands(least, greatest):
    """(sets, bands) hashes of ROWS least or ROWS greatest values each."""
    import numpy as np

    from hourglass.llm.shingles import mixed
    out = []
    for values in (least, greatest):
        for at in range(0, PERMUTATIONS, ROWS):
            h = np.full(values.shape[1], len(out) + 1, "u8")
            for k in range(at, at + ROWS):
                h = mixed(h * np.uint64(0x9E3779B97F4A7C15) + mixed(values[k]))
            out.append(h)
    return np.stack(out, 1)


def signatures(docs: DataFrame, width: int) -> DataFrame:
    """(doc_id, n, signature, buckets) of each row: the size of its set, a digest
    of it, and its bands."""
    def run(batches):
        import hashlib

        import numpy as np
        import pyarrow as pa

        from hourglass.llm.shingles import shingle_sets, sliced
        for whole in batches:
            for batch in sliced(whole, 1):
                _, found, sizes = shingle_sets(batch.column(1), width)
                own = np.flatnonzero(sizes)
                least, greatest = min_max(found, sizes[own])
                tokens = bands(least, greatest).view("i8")
                digests = [hashlib.blake2b(x.tobytes(), digest_size=16).hexdigest() for x in np.split(found, np.cumsum(sizes[own])[:-1])] if len(own) else []
                full = dict(zip(own.tolist(), range(len(own))))
                ends = np.concatenate([[0], np.cumsum(np.where(sizes > 0, tokens.shape[1], 0))]).astype("i4")
                rows = [full.get(i) for i in range(batch.num_rows)]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), pa.array(sizes, pa.int64()), pa.array([None if i is None else digests[i] for i in rows], pa.string()),
                     pa.ListArray.from_arrays(pa.array(ends), pa.array(tokens.ravel()))],
                    names=["doc_id", "n", "signature", "buckets"])

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, n long, signature string, buckets array<long>")


def leaders(nodes: DataFrame) -> DataFrame:
    """(bucket, l): the least document of each bucket of several ``nodes`` (doc, n,
    buckets), and a set size of it. Single longs, unlike a struct, are summed up by hashing,
    without a sort of all entries."""
    return nodes.select("doc", "n", F.explode("buckets").alias("bucket")).groupBy("bucket") \
        .agg(F.min("doc").alias("_doc"), F.min_by("n", "doc").alias("_n"), F.max("doc").alias("_most")) \
        .filter("_doc < _most").select("bucket", F.struct(F.col("_doc").alias("doc"), F.col("_n").alias("n")).alias("l"))


def may_share(nodes: DataFrame, led: DataFrame) -> DataFrame:
    """(doc, n, bucket) of the buckets that ``led`` (bucket) has: all of them, and few
    others, so that a join with ``led`` doesn't shuffle and sort the entries that stand alone."""
    import numpy as np
    bits, known = marked(led.select(F.col("bucket").alias("h")))

    def sift(batches):
        import pyarrow as pa
        held = np.frombuffer(known.value, "u1")
        for batch in batches:
            lists = batch.column(2)
            buckets, counts = lists.flatten().to_numpy(), lists.value_lengths().to_numpy()
            h = (buckets.view("u8") & np.uint64(bits - 1)).astype("i8")
            kept = (held[h >> 3] >> (7 - (h & 7)).astype("u1") & 1).astype(bool)
            yield pa.RecordBatch.from_arrays([pa.array(np.repeat(batch.column(0).to_numpy(), counts)[kept]),
                                              pa.array(np.repeat(batch.column(1).to_numpy(), counts)[kept]), pa.array(buckets[kept])],
                                             names=["doc", "n", "bucket"])

    return nodes.select("doc", "n", "buckets").mapInArrow(sift, "doc long, n long, bucket long")


def verified(pairs: DataFrame, docs: DataFrame, width: int, percent: int) -> DataFrame:
    """The pairs (a, b) of which a text of a and one of b reach the similarity,
    by their whole sets. Rows meet at b, whose sets are made once for at most
    ``PARTNERS`` partners, about."""
    salts = pairs.groupBy("b").agg(F.count(F.lit(1)).alias("_c")).selectExpr("b", f"cast(ceil(_c / {PARTNERS}) AS int) AS k")
    dealt = written(pairs.join(salts, "b").withColumn("salt", F.pmod(F.xxhash64("a"), F.col("k")).cast("int")).select("a", "b", "salt"), "minhash-dealt")
    texts = sifted(docs, dealt.select(F.explode(F.array("a", "b")).alias("id")))
    left = dealt.join(texts.withColumnRenamed("doc_id", "a"), "a").select("b", "salt", "a", "text")
    right = dealt.select("b", "salt").distinct().join(texts.withColumnRenamed("doc_id", "b"), "b") \
        .select("b", "salt", F.lit(None).cast("long").alias("a"), "text")

    def run(batches):
        import numpy as np
        import pyarrow as pa

        from hourglass.llm.shingles import shingle_sets, sliced
        now, sets = None, []
        for whole in batches:
            for batch in sliced(whole, 3):
                _, found, sizes = shingle_sets(batch.column(3), width)
                good = []
                own = np.split(found, np.cumsum(sizes)[:-1])
                for b, salt, a, x in zip(*(batch.column(i).to_pylist() for i in range(3)), own):
                    if (b, salt) != now:
                        now, sets = (b, salt), []
                    if a is None:  # the texts of b come first
                        sets.append(x.copy())
                        continue
                    for y in sets:
                        shared = len(np.intersect1d(x, y, assume_unique=True)) if 100 * min(len(x), len(y)) >= percent * max(len(x), len(y)) else 0
                        if shared and 100 * shared >= percent * (len(x) + len(y) - shared):
                            good.append((a, b))
                            break
                if good:
                    yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*good)], names=["a", "b"])

    with batch_rows(docs.sparkSession, BATCH_ROWS):
        return written(left.union(right).repartition("b", "salt").sortWithinPartitions("b", "salt", F.col("a").asc_nulls_first())
                       .mapInArrow(run, "a long, b long").distinct(), "minhash-links")


def joining(sets: list, docs, labels, where, i: int, j: int, percent: int) -> list[tuple[int, int]]:
    """Links (greater doc, smaller doc) between sets of part i and of part j that
    have different labels: as many as it takes to join all labels that are
    linked, by the whole sets."""
    import numpy as np
    sizes = np.array([len(x) for x in sets], "i8")
    _, column, often = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    kept = often > 1
    row, column = np.repeat(np.arange(len(sets)), sizes)[kept[column]], (np.cumsum(kept) - 1)[column[kept[column]]]
    order = np.argsort(column, kind="stable")
    row, column, n = row[order], column[order], int(kept.sum())
    up: dict[int, int] = {}

    def top(x: int) -> int:
        while up.get(x, x) != x:
            x = up[x]
        return x

    out = []
    one, two = np.flatnonzero(where == i), np.flatnonzero(where == j)
    for x in (one[k:k + TILE] for k in range(0, len(one), TILE)):
        for y in (two[k:k + TILE] for k in range(0, len(two), TILE)):
            if i == j and y[-1] < x[0]:
                continue
            if len(np.unique(labels[np.concatenate([x, y])])) == 1:
                continue
            shared = np.zeros((len(x), len(y)), "f4")
            for at in range(0, n, COLUMNS):
                lo, hi = np.searchsorted(column, (at, at + COLUMNS))
                sides = []
                for side in (x, y):
                    place = np.full(len(sets), -1)
                    place[side] = np.arange(len(side))
                    mine = place[row[lo:hi]] >= 0
                    dense = np.zeros((len(side), min(COLUMNS, n - at)), "f4")
                    dense[place[row[lo:hi][mine]], column[lo:hi][mine] - at] = 1
                    sides.append(dense)
                shared += sides[0] @ sides[1].T  # whole numbers below 2^24
            good = (shared > 0) & (100 * shared >= percent * (sizes[x][:, None] + sizes[y][None, :] - shared)) & (labels[x][:, None] != labels[y][None, :])
            for p, q in zip(*np.nonzero(good)):
                p, q = x[p], y[q]
                a, b = top(int(labels[p])), top(int(labels[q]))
                if a != b:
                    up[a] = b
                    out.append((int(max(docs[p], docs[q])), int(min(docs[p], docs[q]))))
    return out


def linked_within(entries: DataFrame, docs: DataFrame, width: int, percent: int) -> DataFrame:
    """(a, b), a > b: links that join the different labels of each bucket of
    entries (bucket, doc, n, label)."""
    each = entries.groupBy("bucket").agg(F.count(F.lit(1)).alias("_c"), F.sum("n").alias("_n"),
                                         F.bit_xor(F.xxhash64("doc")).alias("_x"), F.bit_xor(F.xxhash64(F.lit(1), "doc")).alias("_y"))
    sizes = each.groupBy("_c", "_n", "_x", "_y").agg(F.min("bucket").alias("bucket")).selectExpr(  # of buckets with the same nodes one
        "bucket", f"cast(least(_c, greatest(ceil(_c / {PART}), ceil(_n / {PART_SHINGLES}))) AS int) AS k")
    parts = written(entries.join(sizes, "bucket").withColumn("part", F.pmod(F.xxhash64("doc"), F.col("k")).cast("int"))
                    .withColumn("q", F.explode(F.sequence(F.lit(0), F.col("k") - 1)))
                    .select("bucket", F.least("part", "q").alias("i"), F.greatest("part", "q").alias("j"), "part", "doc", "label"), "minhash-parts")
    texts = sifted(docs, parts.select(F.col("doc").alias("id")))

    def run(batches):
        import numpy as np
        import pyarrow as pa

        from hourglass.llm.shingles import shingle_sets, sliced

        def told(key, group):
            part, doc, label, sets = zip(*group)
            found = joining(sets, np.array(doc), np.array(label), np.array(part), *key[1:], percent) if len(group) > 1 else []
            if found:
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*found)], names=["a", "b"])

        now, group = None, []
        for whole in batches:
            for batch in sliced(whole, 6):
                _, found, sizes = shingle_sets(batch.column(6), width)
                for bucket, i, j, part, doc, label, own in zip(*(batch.column(k).to_pylist() for k in range(6)), np.split(found, np.cumsum(sizes)[:-1])):
                    if (bucket, i, j) != now:
                        if group:
                            yield from told(now, group)
                        now, group = (bucket, i, j), []
                    group.append((part, doc, label, own.copy()))
        if group:
            yield from told(now, group)

    rows = parts.join(texts.withColumnRenamed("doc_id", "doc"), "doc").select("bucket", "i", "j", "part", "doc", "label", "text")
    with batch_rows(docs.sparkSession, BATCH_ROWS):
        return written(rows.repartition("bucket", "i", "j").sortWithinPartitions("bucket", "i", "j").mapInArrow(run, "a long, b long").distinct(),
                       "minhash-rest")


def near_duplicates(docs: DataFrame, width: int = WIDTH, percent: int = PERCENT) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept), a row for each row of ``docs``
    (doc_id, text)."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    with batch_rows(docs.sparkSession, BATCH_ROWS):
        rows = written(signatures(docs, width), "minhash-signatures")
    sets = rows.filter("n > 0 AND doc_id IS NOT NULL")
    first = written(sets.groupBy("signature").agg(F.min("doc_id").alias("node")), "minhash-nodes")
    nodes = written(sets.join(first, "signature").filter("doc_id = node").dropDuplicates(["node", "signature"])
                    .select(F.col("node").alias("doc"), "n", "buckets"), "minhash-sets")
    led = written(leaders(nodes), "minhash-leaders")
    shared = written(may_share(nodes, led).join(led, "bucket"), "minhash-shared")  # buckets of several nodes
    near = f"100 * least(n, l.n) >= {percent} * greatest(n, l.n)"
    tried = written(shared.filter(f"doc > l.doc AND {near}").select(F.col("doc").alias("a"), F.col("l.doc").alias("b")).distinct(), "minhash-led")
    links = verified(tried, docs, width, percent)
    labels = components(links)
    labelled = shared.select("bucket", "doc", "n").join(labels.withColumnsRenamed({"id": "doc", "component": "label"}), "doc", "left") \
        .withColumn("label", F.coalesce("label", "doc"))
    split = labelled.groupBy("bucket").agg(F.min("label").alias("_a"), F.max("label").alias("_b")).filter("_a < _b").select("bucket")
    links = links.union(linked_within(labelled.join(split, "bucket"), docs, width, percent))
    # A document of several texts ties their nodes.
    several = sets.select("doc_id", "signature").distinct().groupBy("doc_id").agg(F.count(F.lit(1)).alias("_c")).filter("_c > 1").select("doc_id")
    tied = sets.join(several, "doc_id").join(first, "signature").select(F.col("doc_id").alias("a"), F.col("node").alias("b"))
    reached = components(links.union(tied))
    return rows.select("doc_id", "n", "signature").join(first, "signature", "left") \
        .withColumn("node", F.when(F.col("doc_id").isNotNull(), F.coalesce("node", "doc_id"))) \
        .join(reached.withColumnRenamed("id", "node"), "node", "left") \
        .select("doc_id", F.col("n").alias("n_shingles"), F.coalesce("component", "node").alias("component_id")) \
        .withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))


def query(docs: DataFrame) -> DataFrame:
    return near_duplicates(docs)


ORACLE_SQL = rf"""
WITH RECURSIVE words AS (
  SELECT DISTINCT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w
  FROM documents),
sets AS (
  SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < {WIDTH} THEN [array_to_string(w, ' ')]
                      ELSE list_distinct(list_transform(range(1, len(w) - {WIDTH} + 2), lambda i: array_to_string(w[i:i + {WIDTH - 1}], ' '))) END AS s
  FROM words),
distinct_sets AS (SELECT list_sort(s) AS s, min(doc_id) AS node FROM sets GROUP BY ALL HAVING len(s) > 0),
shingles AS (SELECT node, len(s) AS n, unnest(s) AS shingle FROM distinct_sets),
pairs AS (
  SELECT a.node AS a, b.node AS b FROM shingles a JOIN shingles b ON a.shingle = b.shingle AND a.node < b.node
    AND 100 * least(a.n, b.n) >= {PERCENT} * greatest(a.n, b.n)
  GROUP BY a.node, b.node, a.n, b.n HAVING 100 * count(*) >= {PERCENT} * (a.n + b.n - count(*))),
links AS (SELECT a, b FROM pairs UNION ALL SELECT b, a FROM pairs),
reached AS (SELECT node AS origin, node AS place FROM distinct_sets UNION SELECT r.origin, l.b FROM reached r JOIN links l ON l.a = r.place),
least_ AS (SELECT origin AS node, min(place) AS component FROM reached GROUP BY origin)
SELECT d.doc_id, CAST(len(s.s) AS BIGINT) AS n_shingles, coalesce(l.component, d.doc_id) AS component_id, d.doc_id = coalesce(l.component, d.doc_id) AS kept
FROM documents d JOIN sets s USING (doc_id) LEFT JOIN distinct_sets n ON n.s = list_sort(s.s) LEFT JOIN least_ l USING (node)
"""
