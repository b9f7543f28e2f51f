"""N-gram Jaccard join with adaptive multi-match prefixes (operator 5).

Texts with equal shingle sets are one node. Of two sets that reach the
similarity, each holds at least alpha = ceil(t n) shared shingles of its n, so
in a common order of all shingles the first n - alpha + l of either (its
l-prefixes) share at least l. Rare shingles come first in the order, by a
count of all shingles in a table of fixed size. Each document picks its own l:
a longer prefix costs entries in the index, but a partner must then share l
shingles, which spares verifications; the estimated cost of both decides. Two
prefixes of different l must share the smaller number.

Links are found without pairing whole groups. First every document is
verified against one leader of its buckets (documents whose prefixes share a
shingle), the one with the fewest shingles of its own; linked documents get a
common label. Then only buckets that still hold different labels are joined,
between documents of different labels, and a pair is verified if the
shingles that two documents can share at most (by size and by the place of
the shared shingle) reach the similarity and it shares enough of them. Pairs
within a label are linked already, so no component is missed: the result is
that of all pairs. Verification compares the whole shingle sets.

Components are found by alternating stars over the verified links. Every
step's table is written to the shared folder.

The query also counts each document's links, all of them. Linked documents are
in one component, so the sets of a component are compared with each other. Once,
each set meets its component's first set and is told by its differences to that
one: C being the first set and D(A) what A lacks of it or has besides,
|A & B| = |C| - |C \\ A| - |C \\ B| + |D(A) & D(B)|. Only these numbers, no texts,
are dealt to parts of some thousands of sets; each pair of parts is
compared by itself, as products of matrices that tell which set differs where. A part's task gives sums for
each set, weighted by the copies of its partner, and no pairs. Bytes grow with
the component's sets up to a part's size, the time with their square.

Defined cases: null, empty or blank texts have no shingles and are linked with
nothing (their component is their own id); a text of fewer words than a
shingle is one shingle of all its words; equal texts are linked; rows with
equal doc_id count as one document; a row without doc_id is linked with
nothing and has component null; other columns are ignored; empty tables give
empty results; ``n_links`` counts other doc_ids, each once. Shingles are compared by 64-bit hashes.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from hourglass.llm.storage import small_batches, written

WIDTH = 5
PERCENT = 80
#: Counters of shingles, and how many of them travel in a row.
COUNTERS, PER_ROW = 1 << 20, 1 << 12
#: Bits of the filter of texts for each id in it, and at most (16 MB).
BITS_PER_ID, MAX_BITS = 8, 1 << 27
MAX_MATCHES = 4
#: Documents in a bucket whose pairs are made before they are judged.
SMALL_BUCKET = 32
#: Sets in a part of a component, and their differences altogether, about; sets
#: and columns of a matrix; sets of a component in a task that finds differences.
PART, PART_NUMBERS, TILE, COLUMNS, DEALT = 4096, 2_000_000, 1024, 4096, 4096
#: Cost of verifying a candidate, in index entries.
VERIFY_COST = 20.0


def counted(hashes: DataFrame, make, columns: list[str], counters: int = COUNTERS):
    """Counts of the hashes in the arrays that ``make(batch)`` yields by their lowest bits
    over all rows, as one numpy array of ``counters`` numbers. Tasks count
    into a table of that size; tables are summed by parts."""
    import numpy as np

    def count(batches):
        import pyarrow as pa
        total = np.zeros(counters, "i8")
        for batch in batches:
            for h in make(batch):
                total += np.bincount((h & np.uint64(counters - 1)).astype("i8"), minlength=counters)
        parts = total.reshape(-1, PER_ROW)
        used = np.flatnonzero(parts.any(1))
        kind = "<u2" if total.max(initial=0) < 1 << 16 else "<u8"
        yield pa.RecordBatch.from_arrays([pa.array(used, pa.int32()), pa.array([parts[i].astype(kind).tobytes() for i in used], pa.binary())],
                                         names=["part", "counts"])

    def add(batches):
        import pyarrow as pa
        sums: dict[int, object] = {}
        for batch in batches:
            for part, raw in zip(batch.column(0).to_pylist(), batch.column(1)):
                raw = raw.as_py()
                x = np.frombuffer(raw, "<u2" if len(raw) == 2 * PER_ROW else "<u8").astype("u8")
                sums[part] = sums[part] + x if part in sums else x
        if sums:
            yield pa.RecordBatch.from_arrays([pa.array(list(sums), pa.int32()), pa.array([x.astype("<u8").tobytes() for x in sums.values()],
                                                                                        pa.binary())], names=["part", "counts"])

    schema = "part int, counts binary"
    rows = hashes.select(*columns).mapInArrow(count, schema).repartition("part").mapInArrow(add, schema).collect()
    out = np.zeros(counters, "i8")  # a table of fixed size, whatever the input
    for r in rows:
        out[r["part"] * PER_ROW:(r["part"] + 1) * PER_ROW] = np.frombuffer(r["counts"], "<u8")
    return out


def prefix_matches(n: int, alpha: int, rare_first, background: float) -> int:
    """The cheapest number of matches: entries of the prefix, and the
    documents that share a shingle of it spread over matches to verify."""
    best = (math.inf, 1)
    for k in range(1, min(MAX_MATCHES, alpha) + 1):
        size = n - alpha + k
        shared = sum(max(0.0, c - background) for c in rare_first[:size])
        best = min(best, (size + VERIFY_COST * shared / k, k))
    return best[1]


def prefixes(docs: DataFrame, width: int, percent: int) -> DataFrame:
    """(doc_id, n, signature, matches, prefix) of each row: the size of its set,
    a digest of it, and its adaptive prefix in the common order."""
    def hashes(batch):
        from hourglass.llm.shingles import shingle_sets, sliced
        for part in sliced(batch, 0):
            yield shingle_sets(part.column(0), width)[1]

    import numpy as np

    counts = counted(docs, hashes, ["text"])
    used = counts[counts > 0]
    usual = float(np.median(used)) if len(used) else 0.0
    # Counters of shingles that are nowhere twice hold about this many.
    background = usual + 4 * math.sqrt(usual)
    spark = docs.sparkSession
    table = spark.sparkContext.broadcast(counts.astype("<u4").tobytes())  # 4 * COUNTERS bytes

    def run(batches):
        import hashlib

        import numpy as np
        import pyarrow as pa

        from hourglass.llm.shingles import shingle_sets, sliced
        often = np.frombuffer(table.value, "<u4")
        for whole in batches:
            for batch in sliced(whole, 1):
                _, found, sizes = shingle_sets(batch.column(1), width)
                digests, matches, kept, ends, pos = [], [], [], [0], 0
                for n in sizes.tolist():
                    own = found[pos:pos + n]
                    pos += n
                    if not n:
                        digests.append(None)
                        matches.append(0)
                        ends.append(ends[-1])
                        continue
                    digests.append(hashlib.blake2b(own.tobytes(), digest_size=16).hexdigest())
                    alpha = -(-percent * n // 100)
                    c = often[(own & np.uint64(COUNTERS - 1)).astype("i8")]
                    order = np.lexsort((own, c))[:n - alpha + MAX_MATCHES]
                    k = prefix_matches(n, alpha, c[order].tolist(), background)
                    matches.append(k)
                    kept.append(own[order[:n - alpha + k]].view("i8"))
                    ends.append(ends[-1] + len(kept[-1]))
                flat = np.concatenate(kept) if kept else np.zeros(0, "i8")
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), pa.array(sizes, pa.int64()), pa.array(digests, pa.string()), pa.array(matches, pa.int32()),
                     pa.ListArray.from_arrays(pa.array(np.array(ends, "i4")), pa.array(flat))],
                    names=["doc_id", "n", "signature", "matches", "prefix"])

    return docs.select("doc_id", "text").mapInArrow(
        run, "doc_id long, n long, signature string, matches int, prefix array<long>")


def _least_overlap(a: str, b: str, percent: int) -> str:
    """SQL: how many shingles sets of these sizes must share at least."""
    return f"cast(ceil({percent} * ({a} + {b}) / {100 + percent}) AS long)"


def marked(hashed: DataFrame):
    """(bits, broadcast): a table of bits in which each of the different 64-bit hashes
    ``hashed`` (h) is marked at its remainder, with ``BITS_PER_ID`` bits for each hash,
    ``MAX_BITS`` at most."""
    import numpy as np
    bits = min(MAX_BITS, 1 << max(16, (BITS_PER_ID * hashed.count()).bit_length()))
    block = 1 << 13  # bits that travel in a row

    def mark(batches):
        import pyarrow as pa
        found = [np.unique((b.column(0).to_numpy().view("u8") & np.uint64(bits - 1)).astype("i8")) for b in batches]
        marks = np.unique(np.concatenate(found)) if found else np.zeros(0, "i8")
        starts = np.flatnonzero(np.diff(marks // block, prepend=-1))
        rows = []
        for lo, hi in zip(starts, [*starts[1:], len(marks)]):
            one = np.zeros(block, bool)
            one[marks[lo:hi] % block] = True
            rows.append((int(marks[lo] // block), np.packbits(one).tobytes()))
        yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.int32()), pa.array([r[1] for r in rows], pa.binary())], names=["part", "marks"])

    table = np.zeros(bits // 8, "u1")  # at most MAX_BITS / 8 bytes
    # A block's ids meet in one task, so that the driver gets each bit once.
    for r in hashed.repartition(F.expr(f"(h & {bits - 1}L) div {block}")).mapInArrow(mark, "part int, marks binary").collect():
        table[r["part"] * block // 8:(r["part"] + 1) * block // 8] |= np.frombuffer(r["marks"], "u1")
    return bits, hashed.sparkSession.sparkContext.broadcast(table.tobytes())


def parted(rows: DataFrame, key: str, ids: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``rows`` in two parts, by their column ``key``: those that ``ids`` (id) may name, that
    is all of them and few others (more, beyond ``MAX_BITS``), and the rest, those
    without a key among them. A join with ``ids`` needs the first part only."""
    import numpy as np
    bits, known = marked(ids.select(F.xxhash64(F.col("id").cast("long")).alias("h")).distinct())

    def sift(named: bool):
        def run(batches):
            import pyarrow as pa
            held = np.frombuffer(known.value, "u1")
            for batch in batches:
                hashes = batch.column(batch.num_columns - 1)
                h = (hashes.fill_null(0).to_numpy().view("u8") & np.uint64(bits - 1)).astype("i8")
                may = (held[h >> 3] >> (7 - (h & 7)).astype("u1") & 1).astype(bool) & hashes.is_valid().to_numpy(zero_copy_only=False)
                kept = batch.filter(pa.array(may == named))
                yield pa.RecordBatch.from_arrays(kept.columns[:-1], names=kept.schema.names[:-1])
        return run

    hashed = rows.select("*", F.when(F.col(key).isNotNull(), F.xxhash64(F.col(key).cast("long"))).alias("_hash"))
    return hashed.mapInArrow(sift(True), rows.schema), hashed.mapInArrow(sift(False), rows.schema)


def sifted(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """(doc_id, text) of the documents that ``ids`` (id) may name, so that a join with
    ``ids`` doesn't shuffle every text."""
    return parted(docs.filter("doc_id IS NOT NULL").select("doc_id", "text"), "doc_id", ids)[0]


def verified(pairs: DataFrame, docs: DataFrame, width: int, percent: int) -> DataFrame:
    """The pairs (a, b) whose whole sets reach the similarity. Texts are
    shuffled only of documents that may be in a pair; the join decides."""
    import numpy as np

    texts = sifted(docs, pairs.select(F.explode(F.array("a", "b")).alias("id"))).withColumnRenamed("doc_id", "id")
    both = pairs.join(texts.withColumnsRenamed({"id": "a", "text": "text_a"}), "a") \
        .join(texts.withColumnsRenamed({"id": "b", "text": "text_b"}), "b").select("a", "b", "text_a", "text_b")

    def check(batches):
        import pyarrow as pa

        from hourglass.llm.shingles import shingle_sets, sliced
        for whole in batches:
            for batch in sliced(whole, 2, 3):
                sides = []
                for ids_, column in ((0, 2), (1, 3)):  # of an id that stands in many rows, the set is made once
                    index, firsts = {}, []
                    for i, x in enumerate(zip(batch.column(ids_).to_pylist(), batch.column(column).to_pylist())):
                        if x not in index:
                            index[x] = len(firsts)
                            firsts.append(i)
                        sides.append(index[x])
                    _, found, sizes = shingle_sets(batch.column(column).take(pa.array(firsts)), width)
                    cuts = np.cumsum(sizes)[:-1]
                    sides.append(np.split(found, cuts))
                n = batch.num_rows
                a, sets_a, b, sets_b = sides[:n], sides[n], sides[n + 1:2 * n + 1], sides[2 * n + 1]
                good = []
                for i, j in zip(a, b):
                    x, y = sets_a[i], sets_b[j]
                    shared = len(np.intersect1d(x, y, assume_unique=True))
                    good.append(shared > 0 and 100 * shared >= percent * (len(x) + len(y) - shared))
                yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], names=["a", "b"]).filter(pa.array(good, pa.bool_()))

    return both.mapInArrow(check, "a long, b long").distinct()


def components(links: DataFrame) -> DataFrame:
    """(id, component): the smallest id that each linked id reaches. Alternating
    stars: all larger neighbours of an id are tied to its smallest one, then
    all smaller ones, until nothing changes."""
    def star(edges: DataFrame, larger: bool) -> DataFrame:
        if larger:
            near = edges.select("u", "v").union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        else:
            near = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
        near = near.distinct()
        least = near.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        tied = near.join(least, "u")
        if larger:
            return tied.filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u <> v").distinct()
        return tied.select(F.col("v").alias("u"), F.col("m").alias("v")).union(least.select("u", F.col("m").alias("v"))) \
            .filter("u <> v").distinct()

    edges, before = written(links.select(F.col("a").alias("u"), F.col("b").alias("v")).filter("u <> v").distinct(), "links"), None
    while True:
        edges = written(star(star(edges, True), False), "stars")
        state = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if state == before:
            break
        before = state
    return edges.select(F.col("u").alias("id"), F.col("v").alias("component")).union(
        edges.select(F.col("v").alias("id"), F.col("v").alias("component"))).distinct()


def _buckets(prefix_rows: DataFrame) -> DataFrame:
    """(token, doc, n, matches, pos, own): entries of the prefixes whose shingle
    another prefix has, too; ``own`` are the shingles before it that no other
    has, ``pos`` all before it."""
    entries = prefix_rows.select(F.col("doc_id").alias("doc"), "n", "matches", F.posexplode("prefix").alias("pos", "token"))
    by_token = W.partitionBy("token")
    shared = entries.withColumn("_least", F.min("doc").over(by_token)).withColumn("_most", F.max("doc").over(by_token)) \
        .filter("_least < _most").select("token", "doc", "n", "matches", "pos")
    by_doc = W.partitionBy("doc").orderBy("pos", "token")
    return shared.withColumn("own", F.greatest(F.lit(0), F.col("pos") - (F.row_number().over(by_doc) - 1)))


def _may_link(a: str, b: str, percent: int) -> str:
    """SQL: sizes are near enough, and the shingles that two entries of one
    token can share at most (those before it that others have, it, and those
    after it) are enough."""
    at_most = (f"least({a}.pos - {a}.own, {b}.pos - {b}.own) + 1 + least({a}.n - {a}.pos, {b}.n - {b}.pos) - 1")
    return (f"100 * least({a}.n, {b}.n) >= {percent} * greatest({a}.n, {b}.n) "
            f"AND {at_most} >= {_least_overlap(a + '.n', b + '.n', percent)}")


def _led(buckets: DataFrame, percent: int) -> DataFrame:
    """(a, b): each document with the leader that most of its buckets have."""
    leader = F.min(F.struct("own", "doc", "n", "pos")).over(W.partitionBy("token"))
    led = buckets.withColumn("l", leader).select(F.struct("doc", "n", "pos", "own").alias("x"), "l") \
        .filter("x.doc <> l.doc").filter(_may_link("x", "l", percent))
    return led.groupBy(F.col("x.doc").alias("a"), F.col("l.doc").alias("b")).agg(F.count(F.lit(1)).alias("c")) \
        .groupBy("a").agg(F.max_by("b", F.struct("c", -F.col("b"))).alias("b"))


def _rest(buckets: DataFrame, labels: DataFrame, percent: int) -> DataFrame:
    """(a, b): all pairs of different labels that may link: enough common
    shingles in their prefixes, and enough that they can share altogether (the
    common ones up to the last, and what either has after that). Entries that
    can't reach any partner in their bucket, and buckets of one label, go first."""
    rows = buckets.join(labels, F.col("doc") == F.col("id"), "left").drop("id") \
        .withColumn("label", F.coalesce("component", "doc")).drop("component")
    by_token = W.partitionBy("token")
    partner = f"greatest(_least_n, cast(ceil({percent} * n / 100) AS long))"
    for _ in range(2):
        rows = rows.withColumns({"_a": F.min("label").over(by_token), "_b": F.max("label").over(by_token),
                                 "_least_n": F.min("n").over(by_token)}).filter("_a < _b") \
            .filter(f"n - own >= {_least_overlap('n', partner, percent)}").drop("_a", "_b", "_least_n")
    rows = written(rows.withColumns({"_a": F.min("label").over(by_token), "_b": F.max("label").over(by_token),
                                     "_size": F.count(F.lit(1)).over(by_token)})
                   .filter("_a < _b").drop("_a", "_b"), "jaccard-rest")
    # The shared shingles of a document's whole prefix, by which a pair is judged.
    own = written(buckets.join(rows.select("doc").distinct(), "doc", "left_semi").groupBy("doc", "n", "matches")
                  .agg(F.array_sort(F.collect_list(F.struct("pos", "token"))).alias("t"))
                  .select("doc", "n", "matches", F.col("t.token").alias("tokens"), F.col("t.pos").alias("places"))
                  .withColumn("mixed", F.size(F.array_distinct("places")) < F.size("places")), "jaccard-own")  # mixed: texts of one id
    common = "array_intersect(x.tokens, y.tokens)"
    last = lambda t: f"{t}.places[array_position({t}.tokens, element_at({common}, -1)) - 1]"
    at_most = f"size({common}) + least(x.n - {last('x')}, y.n - {last('y')}) - 1"
    enough = (f"(x.mixed OR y.mixed OR (size({common}) >= least(x.matches, y.matches) "
              f"AND {at_most} >= {_least_overlap('x.n', 'y.n', percent)}))")
    meet = f"x.token = y.token AND x.doc < y.doc AND x.label <> y.label AND {_may_link('x', 'y', percent)}"
    ids = [F.col("x.doc").alias("a"), F.col("y.doc").alias("b")]
    # Small buckets: their few pairs first, each of which then meets its two prefixes.
    few = rows.filter(F.col("_size") <= SMALL_BUCKET)
    met = few.alias("x").join(few.alias("y"), F.expr(meet)).select(*ids).distinct()
    met = met.join(own.alias("x"), F.col("a") == F.col("x.doc")).join(own.alias("y"), F.col("b") == F.col("y.doc")) \
        .filter(f"size({common}) > 0 AND {enough}").select("a", "b")
    # Large buckets: prefixes go along, so that a pair that can't link is never made.
    many = rows.filter(F.col("_size") > SMALL_BUCKET).join(own, ["doc", "n", "matches"])
    found = many.alias("x").join(many.alias("y"), F.expr(f"{meet} AND {enough}")).select(*ids)
    return met.union(found).distinct()


def _joined(docs: DataFrame, width: int, percent: int) -> tuple[DataFrame, DataFrame]:
    """The rows of ``prefixes``, and (id, component) of the linked documents."""
    rows = written(prefixes(docs, width, percent), "jaccard-prefixes")
    nodes = rows.filter("n > 0 AND doc_id IS NOT NULL")
    first = nodes.groupBy("signature").agg(F.min("doc_id").alias("node"))
    members = nodes.select("doc_id", "signature").join(first, "signature")  # copies are one node
    same = written(members.select(F.col("doc_id").alias("a"), F.col("node").alias("b")).distinct(), "jaccard-same")
    nodes = nodes.join(first.select(F.col("node").alias("doc_id")).distinct(), "doc_id", "left_semi")
    buckets = written(_buckets(nodes), "jaccard-buckets")
    led = written(verified(written(_led(buckets, percent), "jaccard-led"), docs, width, percent), "jaccard-links")
    labels = components(led)
    rest = written(_rest(buckets, labels, percent), "jaccard-pairs")
    found = verified(rest, docs, width, percent)
    links = led.union(found).union(same.filter("a <> b"))
    return rows, components(links)


def _told(rows: DataFrame, reached: DataFrame) -> DataFrame:
    return rows.select("doc_id", F.col("n").alias("n_shingles")) \
        .join(reached.withColumnRenamed("id", "doc_id"), "doc_id", "left") \
        .select("doc_id", "n_shingles", F.coalesce("component", "doc_id").alias("component_id"))


def join(docs: DataFrame, width: int = WIDTH, percent: int = PERCENT) -> DataFrame:
    """(doc_id, n_shingles, component_id), a row for each row of ``docs``
    (doc_id, text)."""
    small_batches(docs.sparkSession)
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return _told(*_joined(docs, width, percent))


def differences(sets: DataFrame, docs: DataFrame, width: int) -> DataFrame:
    """(component, node, weight, mixed, n, lacks, diffs) of rows (component,
    node, doc_id, weight, mixed): a set's size, how many shingles of its
    component's first set it lacks, and these and those that it has besides, as
    packed numbers. Rows meet the first text in groups of about ``DEALT``."""
    leaders = sets.groupBy("component").agg(F.min(F.struct("doc_id", "node")).alias("l"), F.count(F.lit(1)).alias("_c")).filter("_c > 1") \
        .selectExpr("component", "l.doc_id AS doc_id", "l.node AS node", f"cast(ceil(_c / {DEALT}) AS int) AS k")
    texts = sifted(docs, sets.join(leaders.select("component"), "component").select(F.col("doc_id").alias("id")))
    salted = sets.join(leaders.select("component", "k"), "component").withColumn("salt", F.pmod(F.xxhash64("node"), F.col("k")).cast("int"))
    columns = ["component", "salt", "lead", "node", "weight", "mixed", "text"]
    members = salted.withColumn("lead", F.lit(False)).join(texts, "doc_id").select(*columns)
    first = leaders.select("component", "node", "doc_id", F.explode(F.sequence(F.lit(0), F.col("k") - 1)).alias("salt")) \
        .withColumns({"lead": F.lit(True), "weight": F.lit(0).cast("long"), "mixed": F.lit(False)}).join(texts, "doc_id").select(*columns)

    def run(batches):
        import hashlib

        import numpy as np
        import pyarrow as pa

        from hourglass.llm.shingles import shingle_sets, sliced
        now, core, held = None, None, set()
        for whole in batches:
            for batch in sliced(whole, 6):
                _, found, n = shingle_sets(batch.column(6), width)
                out = []
                for component, salt, lead, node, weight, mixed, own in zip(*(batch.column(k).to_pylist() for k in range(6)), np.split(found, np.cumsum(n)[:-1])):
                    if (component, salt) != now:
                        now, core, held = (component, salt), None, set()
                    # Texts that aren't of their node (its document has several) are left out, copies too.
                    if hashlib.blake2b(own.tobytes(), digest_size=16).hexdigest() != node or (not lead and node in held):
                        continue
                    if lead:
                        core = own.copy()
                        continue
                    held.add(node)
                    lacks = np.setdiff1d(core, own, assume_unique=True)
                    diffs = np.concatenate([lacks, np.setdiff1d(own, core, assume_unique=True)])
                    out.append((component, node, weight, mixed, len(own), len(lacks), diffs.tobytes()))
                if out:
                    kinds = (pa.int64(), pa.string(), pa.int64(), pa.bool_(), pa.int64(), pa.int64(), pa.binary())
                    yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), kinds)],
                                                     names=["component", "node", "weight", "mixed", "n", "lacks", "diffs"])

    return members.union(first).repartition("component", "salt").sortWithinPartitions("component", "salt", F.desc("lead")) \
        .mapInArrow(run, "component long, node string, weight long, mixed boolean, n long, lacks long, diffs binary")


def compared(parts: DataFrame, percent: int) -> DataFrame:
    """(node, other, links) of rows (component, i, j, part, node, weight, mixed,
    n, lacks, diffs), of which those with equal component, i and j are compared:
    sums of the linked nodes' weights, and the pairs that have a mixed node."""
    def links(group):
        import numpy as np
        i, j = group[0][:2]
        where = np.array([g[2] for g in group])
        weights, mixed = np.array([g[4] for g in group], "i8"), np.array([g[5] for g in group], bool)
        sizes, lacks = np.array([g[6] for g in group], "i8"), np.array([g[7] for g in group], "i8")
        diffs = [np.frombuffer(g[8], "u8") for g in group]
        core = sizes[0] + 2 * lacks[0] - len(diffs[0])  # the first set's size: n + lacks - besides
        _, column, often = np.unique(np.concatenate(diffs), return_inverse=True, return_counts=True)
        kept = often > 1
        row, column = np.repeat(np.arange(len(diffs)), [len(d) for d in diffs])[kept[column]], (np.cumsum(kept) - 1)[column[kept[column]]]
        order = np.argsort(column, kind="stable")
        row, column = row[order], column[order]
        a, b = np.flatnonzero(where == i), np.flatnonzero(where == j)
        sums = np.zeros(len(group), "i8")
        out = []
        for x in (a[k:k + TILE] for k in range(0, len(a), TILE)):
            for y in (b[k:k + TILE] for k in range(0, len(b), TILE)):
                shared = core - lacks[x][:, None] - lacks[y][None, :]
                for at in range(0, int(kept.sum()), COLUMNS):
                    lo, hi = np.searchsorted(column, (at, at + COLUMNS))
                    sides = []
                    for side in (x, y):
                        place = np.full(len(group), -1)
                        place[side] = np.arange(len(side))
                        mine = place[row[lo:hi]] >= 0
                        dense = np.zeros((len(side), min(COLUMNS, int(kept.sum()) - at)), "f4")
                        dense[place[row[lo:hi][mine]], column[lo:hi][mine] - at] = 1
                        sides.append(dense)
                    shared = shared + (sides[0] @ sides[1].T).astype("i8")
                good = (x[:, None] != y[None, :]) & (shared > 0) & (100 * shared >= percent * (sizes[x][:, None] + sizes[y][None, :] - shared))
                sums[x] += good @ weights[y]
                if i != j:
                    sums[y] += good.T @ weights[x]
                for k, m in zip(*np.nonzero(good & (mixed[x][:, None] | mixed[y][None, :]))):
                    one, two = group[x[k]][3], group[y[m]][3]
                    out += [(one, two, 0)] if i == j else [(one, two, 0), (two, one, 0)]
        return out + [(group[k][3], None, int(sums[k])) for k in np.flatnonzero(sums)]

    def run(batches):
        import pyarrow as pa

        def told(group):
            out = links(group) if len(group) > 1 else []
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), (pa.string(), pa.string(), pa.int64()))],
                                                 names=["node", "other", "links"])

        now, group = None, []
        for batch in batches:
            for component, *row in zip(*(batch.column(k).to_pylist() for k in range(10))):
                if (component, *row[:2]) != now:
                    yield from told(group)
                    now, group = (component, *row[:2]), []
                group.append(row)
        yield from told(group)

    rows = parts.select("component", "i", "j", "part", "node", "weight", "mixed", "n", "lacks", "diffs")
    return rows.repartition("component", "i", "j").sortWithinPartitions("component", "i", "j") \
        .mapInArrow(run, "node string, other string, links long")


def link_counts(docs: DataFrame, rows: DataFrame, reached: DataFrame, width: int, percent: int) -> DataFrame:
    """(doc_id, n_links): how many other documents each is linked with, of those
    in components; the nodes are signatures. Documents of several texts ("mixed")
    are counted by pairs, so that no document counts twice for another."""
    nodes = rows.filter("n > 0 AND doc_id IS NOT NULL")
    members = nodes.select("doc_id", F.col("signature").alias("node")).distinct()
    several = members.groupBy("doc_id").agg(F.count(F.lit(1)).alias("c")).filter("c > 1").select("doc_id", F.lit(True).alias("mixed"))
    members = written(members.join(several, "doc_id", "left").withColumn("mixed", F.coalesce("mixed", F.lit(False))), "jaccard-members")
    weights = members.groupBy("node").agg(F.count_if(~F.col("mixed")).alias("weight"), F.max("mixed").alias("mixed"))
    texts = nodes.groupBy(F.col("signature").alias("node"), "n").agg(F.min("doc_id").alias("doc_id"))
    every = written(weights.join(texts, "node").join(reached.withColumnRenamed("id", "doc_id"), "doc_id"), "jaccard-nodes")
    sets = written(differences(every, docs, width), "jaccard-differences")
    sizes = sets.groupBy("component").agg(F.count(F.lit(1)).alias("nodes"), F.sum(F.length("diffs") / 8).alias("numbers")) \
        .selectExpr("component", f"cast(least(nodes, greatest(ceil(nodes / {PART}), ceil(numbers / {PART_NUMBERS}))) AS int) AS k")
    parts = sets.join(sizes, "component").withColumn("part", F.pmod(F.xxhash64("node"), F.col("k")).cast("int")) \
        .withColumn("q", F.explode(F.sequence(F.lit(0), F.col("k") - 1))).withColumns({"i": F.least("part", "q"), "j": F.greatest("part", "q")})
    found = written(compared(parts, percent), "jaccard-counts")
    pairs = found.filter("other IS NOT NULL").select("node", "other") \
        .union(weights.filter("mixed").select("node", F.col("node").alias("other")))
    mixed = members.filter("mixed").select("doc_id", "node")
    others = mixed.select(F.col("doc_id").alias("m"), F.col("node").alias("other"))
    # Of a document with one text: copies and linked documents with one text, and mixed ones.
    sums = found.groupBy("node").agg(F.sum("links").alias("links"))
    beside = pairs.join(others, "other").groupBy("node").agg(F.count_distinct("m").alias("beside"))
    single = members.filter("NOT mixed").join(weights.select("node", "weight"), "node").join(sums, "node", "left") \
        .join(beside, "node", "left").selectExpr("doc_id", "weight - 1 + coalesce(links, 0) + coalesce(beside, 0) AS n_links")
    # Of a mixed one: the documents of all nodes that any of its own is linked with.
    around = mixed.join(pairs, "node").select("doc_id", "other").distinct()
    ones = around.join(weights.select(F.col("node").alias("other"), "weight"), "other").groupBy("doc_id").agg(F.sum("weight").alias("ones"))
    more = around.join(others, "other").groupBy("doc_id").agg(F.count_distinct("m").alias("more"))
    return single.union(ones.join(more, "doc_id").selectExpr("doc_id", "ones + more - 1 AS n_links"))


def linked(docs: DataFrame, width: int = WIDTH, percent: int = PERCENT) -> DataFrame:
    """``join``, with ``n_links``: how many other documents the document is linked with."""
    small_batches(docs.sparkSession)
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    rows, reached = _joined(docs, width, percent)
    reached = written(reached, "jaccard-reached")
    counts = link_counts(docs, rows, reached, width, percent)
    return _told(rows, reached).join(counts, "doc_id", "left").withColumn("n_links", F.coalesce("n_links", F.lit(0)))


def query(docs: DataFrame) -> DataFrame:
    return linked(docs)
