"""Conversation structure repair by Knuth's lightest derivations (operator 13).

A repair is a derivation in a weighted hypergraph. An item (place, p, q) says
that the rows before ``place`` turn the grammar's state p into q; its weight is
(cost, audit), the edits' initials in order. Deductions extend an item by one
edit of the next row (Keep, Rerole, Delete), by an inserted row, or by another
item over the rows that follow (two antecedents). An agenda pops the lightest
item, which is final then, until the goal items are.

Weights are superior functions: of equal cost, two audits of the same rows are
never one the beginning of the other (that would only add inserts, which cost),
so appending the same or a later audit keeps their order, and a deduction never
yields less than its antecedents when items are popped by cost, place, audit:
an edit without cost goes to a later place.

Plan. The damaged rows are written once, ordered by conversation and turn over
range partitions, so that a long conversation lies in several. Faults need the
first place of a row's role and text, by an aggregate. Rows become one symbol
each; ``SEGMENT`` rows of a conversation are one segment, whose items between
all states come from the agenda. ``FAN`` segments at a time are then chained by
the same agenda until one is left. The chosen audit and the rows in order give
the digest of the repaired conversation, which is hashed as rows stream by:
SHA-256 runs through a conversation from its first byte to its last, so that
this step takes a conversation through one task, a row at a time.

Defined cases: null conv_id, turn, role and text are one space where text is
needed; a null conv_id is a conversation of its own; null turns come first and
have no part in gaps; rows of equal turn are ordered by role, then text, by
bytes (equal rows stay side by side); a role that is empty or begins with
another letter than s, u or a can't be kept; empty and very long texts and
repeated rows are rows as all others; a conversation without rows after the
damage has zeros, an empty audit and the digest of no bytes; other columns are
ignored; empty tables give empty results.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from hourglass.llm.storage import BATCH_ROWS, batch_rows, written

SEGMENT, FAN = 256, 16
#: Bytes of audits in an Arrow batch, about.
BATCH_BYTES = 16 << 20
KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 1, 2, 5, 5
#: Grammar (s?(ua)+)?: next state by state and initial; 0 start, 1 after s, 2 after u, 3 after ua.
NEXT = {0: {"s": 1, "u": 2}, 1: {"u": 2}, 2: {"a": 3}, 3: {"u": 2}}
STATES, ACCEPTED = (0, 1, 2, 3), (0, 3)
INSERTS = {p: [(q, INSERT, "I") for x, q in moves.items() if x in "ua"] for p, moves in NEXT.items()}
BLANKS = " \t\n\x0b\x0c\r"


def lightest(steps: list[dict], start: int, goals, every: bool = True) -> dict:
    """{q: (cost, audit)} of the lightest derivations from ``start`` over all
    ``steps`` to the states ``goals``; to the lightest of them if not ``every``.
    A step has for each state its (next state, cost, audit). The agenda ends
    when the goals are final."""
    import heapq
    agenda, final, found, end = [(0, 0, "", start)], set(), {}, len(steps)
    while agenda:
        cost, place, audit, state = heapq.heappop(agenda)
        if (place, state) in final:
            continue
        final.add((place, state))
        if place == end and state in goals:
            found[state] = (cost, audit)
            if not every or len(found) == len(goals):
                break
        for to, more, own in INSERTS[state]:
            if (place, to) not in final:
                heapq.heappush(agenda, (cost + more, place, audit + own, to))
        if place < end:
            for to, more, own in steps[place].get(state, ()):
                if (place + 1, to) not in final:
                    heapq.heappush(agenda, (cost + more, place + 1, audit + own, to))
    return found


def edits(symbol: str) -> dict:
    """The edits of a row by state. A symbol is the row's initial, in capitals if
    truncated, ``x`` if the row must go, ``o`` (``O``) for another initial."""
    if symbol == "x":
        return {p: [(p, DELETE, "D")] for p in STATES}
    late = TRUNCATED if symbol.isupper() else 0
    out = {}
    for p, moves in NEXT.items():
        out[p] = [(p, DELETE, "D")] + [(q, REROLE + late, "R") for x, q in moves.items() if x in "ua"]
        if symbol.lower() in moves:
            out[p].append((moves[symbol.lower()], KEEP + late, "K"))
    return out


def illegal(initials: str) -> int:
    return sum(pair not in ("su", "ua", "au") for pair in map("".join, zip(initials, initials[1:])))


def damaged(conversations: DataFrame) -> DataFrame:
    """(conv, turn, role, text): the rows after the damage; ``conv`` is the id as
    text, a space for null."""
    rows = conversations.select(
        F.coalesce(F.col("conv_id").cast("string"), F.lit(" ")).alias("conv"), F.col("turn").cast("long").alias("turn"),
        F.coalesce("role", F.lit(" ")).alias("role"), F.coalesce("text", F.lit(" ")).alias("text"))
    kind = F.crc32(F.concat_ws(":", "conv", F.coalesce(F.col("turn").cast("string"), F.lit(" ")))) % 20
    return rows.withColumn("kind", kind).filter("kind <> 0").select(
        "conv", "turn", F.when(F.col("kind") == 4, "user").otherwise(F.col("role")).alias("role"),
        F.when(F.col("kind") == 1, "").when(F.col("kind") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text")).alias("text"),
        F.explode(F.when(F.col("kind") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("_copy")).drop("_copy")


def ordered(rows: DataFrame) -> DataFrame:
    """The rows of ``damaged`` written in order, with their place (``part``,
    ``at``) and a digest of the text. Beginnings of texts part the ranges, whole texts
    order the rows."""
    begun = rows.withColumns({"_head": F.substring("text", 1, 32), "digest": F.unhex(F.sha2("text", 256))})
    keys = ["conv", "turn", "role"]
    placed = begun.repartitionByRange(*keys, "_head").sortWithinPartitions(*keys, "text") \
        .withColumns({"part": F.spark_partition_id(), "at": F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))})
    return written(placed.drop("_head"), "repair-rows")


def faulty(rows: DataFrame) -> DataFrame:
    """(conv, turn, role, part, at, fault, initial) of the rows of ``ordered``; ``fault`` is null,
    blank, duplicate or truncated."""
    place = F.struct("part", "at")
    again = rows.groupBy("conv", "role", "digest").agg(F.min(place).alias("_first"), F.count(F.lit(1)).alias("_c")) \
        .filter("_c > 1").drop("_c")
    last = F.right(F.rtrim("text", F.lit(BLANKS)), F.lit(1))
    seen = rows.select("conv", "turn", "role", "digest", "part", "at", last.alias("_last")).join(again, ["conv", "role", "digest"], "left")
    fault = (F.when(F.col("_last") == "", "blank").when(place > F.col("_first"), "duplicate")
             .when(~F.col("_last").isin(".", "!", "?"), "truncated"))
    return seen.select("conv", "turn", "part", "at", fault.alias("fault"), F.substring("role", 1, 1).alias("initial"))


def segments(rows: DataFrame) -> DataFrame:
    """(conv, part, seg, symbols, initials) of the rows of ``faulty``."""
    known = F.when(F.col("initial").isin("s", "u", "a"), F.col("initial")).otherwise("o")
    symbol = (F.when(F.col("fault").isin("blank", "duplicate"), "x").when(F.col("fault") == "truncated", F.upper(known)).otherwise(known))
    rows = rows.select("conv", "part", F.floor(F.col("at") / SEGMENT).alias("seg"), "at", symbol.alias("s"), known.alias("i"))
    joined = lambda c: F.array_join(F.transform("r", lambda x: x[c]), "")  # noqa: E731
    return rows.groupBy("conv", "part", "seg").agg(F.array_sort(F.collect_list(F.struct("at", "s", "i"))).alias("r")) \
        .select("conv", "part", "seg", joined("s").alias("symbols"), joined("i").alias("initials"))


CHAINED = "conv string, place long, alone boolean, first string, last string, illegal long, items array<struct<p:int,q:int,cost:long,audit:string>>"


def _row_items(batches):
    import pyarrow as pa
    types = _types()
    for batch in batches:
        out = []
        for r in batch.to_pylist():
            steps = [edits(x) for x in r["symbols"]]
            items = _items(steps, r["alone"])
            out.append((r["conv"], r["place"], r["alone"], r["initials"][0], r["initials"][-1], illegal(r["initials"]), items))
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), types.types)] if out else [pa.array([], t) for t in types.types],
                                         schema=types)


def _items(steps: list[dict], alone: bool) -> list[dict]:
    """Items between all states, or the derivations of whole conversations."""
    return [{"p": p, "q": q, "cost": cost, "audit": audit} for p in (STATES[:1] if alone else STATES)
            for q, (cost, audit) in lightest(steps, p, ACCEPTED if alone else STATES, every=not alone).items()]


def _types():
    import pyarrow as pa
    item = pa.struct([("p", pa.int32()), ("q", pa.int32()), ("cost", pa.int64()), ("audit", pa.string())])
    return pa.schema([("conv", pa.string()), ("place", pa.int64()), ("alone", pa.bool_()), ("first", pa.string()), ("last", pa.string()),
                      ("illegal", pa.int64()), ("items", pa.list_(item))])


def _chain(batches):
    """Chains the items of the segments ``parts`` of each row."""
    import pyarrow as pa
    types = _types()
    for batch in batches:
        for r in batch.to_pylist():
            steps, bad = [], 0
            for before, part in zip([None, *r["parts"]], r["parts"]):
                bad += part["illegal"] + (illegal(before["last"] + part["first"]) if before else 0)
                steps.append({p: [(i["q"], i["cost"], i["audit"]) for i in part["items"] if i["p"] == p] for p in STATES})
            row = (r["conv"], r["place"], r["alone"], r["parts"][0]["first"], r["parts"][-1]["last"], bad, _items(steps, r["alone"]))
            yield pa.RecordBatch.from_arrays([pa.array([c], t) for c, t in zip(row, types.types)], schema=types)


def derivations(parts: DataFrame) -> DataFrame:
    """(conv, illegal, cost, audit) of the segments of each conversation."""
    spark = parts.sparkSession
    order = W.partitionBy("conv").orderBy("part", "seg")
    numbered = parts.withColumns({"place": F.row_number().over(order).cast("long") - 1,
                                  "alone": F.count(F.lit(1)).over(W.partitionBy("conv")) == 1}) \
        .select("conv", "place", "alone", "symbols", "initials")
    with batch_rows(spark, BATCH_ROWS):
        level = written(numbered.mapInArrow(_row_items, CHAINED), "repair-items")
    done = level.filter("alone")
    rest = level.filter("NOT alone")
    longest = (rest.agg(F.max("place")).first()[0] or 0) + 1  # segments of the longest conversation
    rows = SEGMENT
    while longest > 1:
        longest, rows = -(-longest // FAN), rows * FAN
        grouped = rest.groupBy("conv", F.floor(F.col("place") / FAN).alias("place")) \
            .agg(F.array_sort(F.collect_list(F.struct("place", "first", "last", "illegal", "items"))).alias("parts"))
        chains = grouped.select("conv", "place", F.lit(longest == 1).alias("alone"), "parts")
        with batch_rows(spark, min(BATCH_ROWS, max(1, BATCH_BYTES // (11 * rows)))):  # a row holds 11 audits of so many rows
            rest = written(chains.mapInArrow(_chain, CHAINED), "repair-chain")
    if rest is not level:
        done = done.union(rest.filter("alone"))
    best = F.array_min(F.transform("items", lambda i: F.struct(i["cost"], i["audit"])))
    return done.select("conv", "illegal", best.alias("b")).select("conv", "illegal", "b.cost", "b.audit")


class Repaired:
    """The digest of a conversation whose rows come one after the other."""

    def __init__(self, audit: str):
        import hashlib
        self.audit, self.place, self.rows, self.hash = audit, 0, 0, hashlib.sha256()
        self.odd = (len(audit) - audit.count("D")) % 2  # a system row leads

    def _add(self, role: str | None, text: str) -> None:
        role = role if role is not None else ("user", "assistant")[(self.rows - self.odd) % 2]
        self.hash.update((("\n" if self.rows else "") + role + ":" + text).encode())
        self.rows += 1

    def _inserts(self) -> None:
        while self.audit[self.place:self.place + 1] == "I":
            self._add(None, "")
            self.place += 1

    def row(self, role: str, text: str) -> None:
        self._inserts()
        edit = self.audit[self.place]
        self.place += 1
        if edit != "D":
            self._add(role if edit == "K" else None, text)

    def digest(self) -> str:
        self._inserts()
        return self.hash.hexdigest()


def digests(rows: DataFrame, audits: DataFrame) -> DataFrame:
    """(conv, repaired_sha256): the rows of ``ordered`` in order, edited as the
    audit of their conversation says, hashed as they come."""
    def run(batches):
        import pyarrow as pa
        now = None
        for batch in batches:
            out = []
            for conv, audit, role, text in zip(*(batch.column(k).to_pylist() for k in (0, 3, 4, 5))):
                if audit is not None:  # the first row of its conversation
                    if now is not None:
                        out.append((now[0], now[1].digest()))
                    now = conv, Repaired(audit)
                else:
                    now[1].row(role, text)
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*out)], names=["conv", "repaired_sha256"])
        if now is not None:
            yield pa.RecordBatch.from_arrays([pa.array([now[0]]), pa.array([now[1].digest()])], names=["conv", "repaired_sha256"])

    none = F.lit(None).cast("string")
    both = audits.select("conv", F.lit(-1).alias("part"), F.lit(0).cast("long").alias("at"), "audit", none.alias("role"), none.alias("text")) \
        .union(rows.select("conv", "part", "at", none.alias("audit"), "role", "text"))
    return both.repartition("conv").sortWithinPartitions("conv", "part", "at").mapInArrow(run, "conv string, repaired_sha256 string")


def repair(conversations: DataFrame) -> DataFrame:
    """A row for each conv_id of ``conversations`` (conv_id, turn, role, text)."""
    rows = ordered(damaged(conversations))
    faults = written(faulty(rows), "repair-faults")
    found = written(derivations(segments(faults)), "repair-audits")
    with batch_rows(conversations.sparkSession, BATCH_ROWS):
        hashed = written(digests(rows, found), "repair-digests")
    kinds = ["blank", "duplicate", "truncated"]
    counts = faults.groupBy("conv", "turn").agg(*[F.count_if(F.col("fault") == f).alias(f) for f in kinds]).groupBy("conv").agg(
        F.coalesce(F.max("turn") - F.min("turn") + 1 - F.count("turn"), F.lit(0)).alias("gaps"), *[F.sum(f).alias(f) for f in kinds])
    ids = conversations.select("conv_id", F.coalesce(F.col("conv_id").cast("string"), F.lit(" ")).alias("conv")).distinct()
    zeros = {c: F.coalesce(c, F.lit(0).cast("long")) for c in ("gaps", *kinds, "illegal", "cost")}
    return ids.join(counts, "conv", "left").join(found, "conv", "left").join(hashed, "conv", "left") \
        .withColumns(zeros | {"audit": F.coalesce("audit", F.lit("")), "repaired_sha256": F.coalesce("repaired_sha256", F.sha2(F.lit(""), 256))}) \
        .select("conv_id", "gaps", *kinds, "illegal", "cost", "audit", "repaired_sha256")


def query(conversations: DataFrame) -> DataFrame:
    return repair(conversations)


def oracle_sql() -> str:
    """The same by a recursion over rows with the lightest (cost, audit) of each
    state, costs padded to nine digits so that text order decides."""
    add = lambda v, cost, edit: f"lpad(CAST(CAST(substr({v}, 1, 9) AS INTEGER) + {cost} AS VARCHAR), 9, '0') || substr({v}, 10) || '{edit}'"  # noqa: E731
    late = f"(CASE WHEN fault = 'truncated' THEN {TRUNCATED} ELSE 0 END)"
    lasting = lambda x: f"CASE WHEN coalesce(fault, '') NOT IN ('blank', 'duplicate') THEN {x} END"  # noqa: E731
    keep = lambda v, x: lasting(f"CASE WHEN initial = '{x}' THEN {add(v, late, 'K')} END")  # noqa: E731
    again = lambda v: lasting(add(v, f"({REROLE} + {late})", "R"))  # noqa: E731
    gone = lambda v: add(v, DELETE, "D")  # noqa: E731
    new = lambda v: add(v, INSERT, "I")  # noqa: E731
    return rf"""
WITH RECURSIVE bits AS (
  SELECT range AS i, range AS c, 0 AS k FROM range(256)
  UNION ALL SELECT i, CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, k + 1 FROM bits WHERE k < 8),
crc_table AS (SELECT list(c ORDER BY i) AS t FROM bits WHERE k = 8),
keyed AS (
  SELECT coalesce(CAST(conv_id AS VARCHAR), ' ') AS conv, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
         coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ') AS key FROM conversations),
kinds AS (
  SELECT conv, turn, role, text, xor(list_reduce(list_concat([4294967295], list_transform(string_split(key, ''), lambda x: CAST(ascii(x) AS BIGINT))),
         lambda a, b: xor(a >> 8, t[(xor(a, b) & 255) + 1])), 4294967295) % 20 AS kind FROM keyed, crc_table),
rows_ AS (
  SELECT conv, turn, CASE WHEN kind = 4 THEN 'user' ELSE role END AS role,
         CASE kind WHEN 1 THEN '' WHEN 2 THEN translate(text, '.!?', '') ELSE text END AS text,
         unnest(CASE WHEN kind = 3 THEN [0, 1] ELSE [0] END) AS copy FROM kinds WHERE kind <> 0),
placed AS (SELECT *, row_number() OVER (PARTITION BY conv ORDER BY turn NULLS FIRST, role, text, copy) AS i, substr(role, 1, 1) AS initial,
                  regexp_extract(text, '([^ 	-])[ 	-]*$', 1) AS ending FROM rows_),
faults AS (
  SELECT *, CASE WHEN ending = '' THEN 'blank' WHEN row_number() OVER (PARTITION BY conv, role, text ORDER BY i) > 1 THEN 'duplicate'
                 WHEN ending NOT IN ('.', '!', '?') THEN 'truncated' END AS fault,
         lag(initial) OVER (PARTITION BY conv ORDER BY i) AS before FROM placed),
counts AS (
  SELECT conv, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (fault = 'blank') AS blank,
         count(*) FILTER (fault = 'duplicate') AS duplicate, count(*) FILTER (fault = 'truncated') AS truncated,
         count(*) FILTER (before || initial NOT IN ('su', 'ua', 'au')) AS illegal, count(*) AS n FROM faults GROUP BY conv),
lightest AS (
  SELECT conv, CAST(0 AS BIGINT) AS i, '000000000' AS v0, CAST(NULL AS VARCHAR) AS v1, {new("'000000000'")} AS v2, {new(new("'000000000'"))} AS v3 FROM counts
  UNION ALL
  SELECT conv, i, n0, n1, least(n2, {new('n0')}, {new('n1')}, {new('n3')}),
         least(n3, {new(f"least(n2, {new('n0')}, {new('n1')})")}) FROM (
    SELECT l.conv, f.i, {gone('v0')} AS n0, least({gone('v1')}, {keep('v0', 's')}) AS n1,
           least({gone('v2')}, {again('v0')}, {again('v1')}, {again('v3')}, {keep('v0', 'u')}, {keep('v1', 'u')}, {keep('v3', 'u')}) AS n2,
           least({gone('v3')}, {again('v2')}, {keep('v2', 'a')}) AS n3
    FROM lightest l JOIN faults f ON f.conv = l.conv AND f.i = l.i + 1)),
best AS (
  SELECT conv, CAST(substr(v, 1, 9) AS BIGINT) AS cost, substr(v, 10) AS audit FROM (
    SELECT l.conv, least(v0, v3) AS v FROM lightest l JOIN counts c ON c.conv = l.conv AND c.n = l.i)),
edits AS (SELECT conv, audit, unnest(string_split(audit, '')) AS edit, unnest(range(1, length(audit) + 1)) AS j FROM best WHERE audit <> ''),
outcome AS (
  SELECT *, sum(CASE WHEN edit <> 'I' THEN 1 ELSE 0 END) OVER so_far AS i, sum(CASE WHEN edit <> 'D' THEN 1 ELSE 0 END) OVER so_far - 1 AS o,
         length(replace(audit, 'D', '')) % 2 AS odd FROM edits WINDOW so_far AS (PARTITION BY conv ORDER BY j)),
lines AS (
  SELECT e.conv, j, CASE WHEN edit = 'K' THEN f.role WHEN (o - odd) % 2 = 0 THEN 'user' ELSE 'assistant' END || ':' ||
         CASE WHEN edit = 'I' THEN '' ELSE f.text END AS line
  FROM outcome e LEFT JOIN faults f ON f.conv = e.conv AND f.i = e.i WHERE edit <> 'D'),
hashed AS (SELECT conv, sha256(string_agg(line, chr(10) ORDER BY j)) AS h FROM lines GROUP BY conv)
SELECT ids.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated,
       coalesce(illegal, 0) AS illegal, coalesce(cost, 0) AS cost, coalesce(audit, '') AS audit, coalesce(h, sha256('')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id, coalesce(CAST(conv_id AS VARCHAR), ' ') AS conv FROM conversations) ids
LEFT JOIN counts USING (conv) LEFT JOIN best USING (conv) LEFT JOIN hashed USING (conv)
"""


ORACLE_SQL = oracle_sql()
