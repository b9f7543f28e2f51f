"""Personal data by candidate gradient boosting (operator 1, native).

Generators propose spans of four kinds. The base generators find what is
surely of its kind (patterns with checks: octets, Luhn, digit counts); the
loose ones propose everything that might be, in the text that base spans
leave: spaced or bracketed addresses, other separators, numbers without a
plus sign. Boosted trees judge proposals by format and context (digits,
groups, separators, lead, cue words before, neighbours). Each is labelled by
whether it would pass the base check once its format is normalised, over all
documents; as features are small integers, all that training needs is the
count of proposals and labels per combination (at most ``MAX_CELLS``), and
the trees become CASE expressions. A kind's threshold is the lowest score
from which on in held-out documents at least ``PRECISION`` of the loose
proposals, the only ones it decides about, carry the label; a kind that never
gets there adds nothing. Base spans stay, and take part in the training only.

Everything happens inside the row, in SQL functions: a text is split at a
generator's matches, and positions are prefix sums of piece lengths (in
blocks, so that a text with very many matches costs no square).

Defined cases: null text counts as empty and has no spans; positions are code
points, ends exclusive; U+0001 in a text counts as U+0002; repeated rows give
repeated results; empty tables learn nothing and give empty results; input
columns named like an output column are replaced.
"""

from __future__ import annotations

import math
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

KINDS = ["email", "ip", "card", "phone"]
FEATURES = {"size": 8, "groups": 5, "separator": 4, "lead": 3, "cue": 5, "edge": 4}  # levels of each
MAX_CELLS = 2 * 2 * len(KINDS) * math.prod(FEATURES.values())
PRECISION = 0.98
TREES = 30
CONTEXT = 24
MARK, FILL = "\\u0001", "\\u0003"

# Base patterns. Possessive and anchored so that each is linear in the text:
# a match of the plain pattern can only start where its first run starts.
BASE = {
    "email": r"(?:\\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++(?:\\.[0-9]++){3}+",
    "card": r"(?<![0-9])(?<![0-9][\\x20-])[0-9](?:[\\x20-]?[0-9]){13,18}+(?![\\x20-]?[0-9])",
    "phone": r"\\+[0-9][\\x20().0-9-]+[0-9]",
}
DIGITS = "regexp_replace({m}, '[^0-9]+', '')"
LUHN = """aggregate(sequence(1, length({d})), 0L, (luhn, j) -> luhn + CASE WHEN (length({d}) - j) % 2 = 0 THEN
    cast(substr({d}, j, 1) AS int) ELSE (2 * cast(substr({d}, j, 1) AS int)) div 10
    + (2 * cast(substr({d}, j, 1) AS int)) % 10 END) % 10 = 0"""
OCTETS = r"{m} rlike '^0*(25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])(\\.0*(25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])){{3}}$'"
CHECKS = {
    "email": "true",
    "ip": OCTETS,
    "card": LUHN.format(d=DIGITS),
    "phone": "length(" + DIGITS + ") BETWEEN 10 AND 15",
}
# Loose patterns: what might be of the kind.
AT, DOT = r"(?:\\x20?@\\x20?|\\x20?[(\\[]\\x20?at\\x20?[)\\]]\\x20?)", r"(?:\\x20?\\.\\x20?|\\x20?[(\\[]\\x20?dot\\x20?[)\\]]\\x20?)"
LOOSE = {
    "email": rf"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]++{AT}[A-Za-z0-9-]++(?:{DOT}[A-Za-z0-9-]++){{0,8}}+",
    "ip": r"(?<![0-9.])[0-9]{1,4}(?:\\x20?\\.\\x20?[0-9]{1,4}){3}(?![0-9])",
    "card": r"(?<![0-9])[0-9](?:[\\x20._/-]{0,2}[0-9]){11,18}+(?![0-9])",
    "phone": r"(?<![0-9+])(?:\\+|00)?\\x20?\\(?[0-9]{1,4}\\)?(?:[\\x20./-]{1,2}\\(?[0-9]{2,5}\\)?){1,5}(?![0-9])",
}
#: What a text must hold for a generator to be tried at all.
NEEDS = {"email": "contains({t}, '@')", "ip": "contains({t}, '.')", "card": "true", "phone": "contains({t}, '+')"}
LOOSE_NEEDS = {"email": r"({t} rlike '@|[(\\[]\\x20?at\\x20?[)\\]]')", "ip": "contains({t}, '.')", "card": "true", "phone": "true"}
#: The label: would it pass once its format is normalised?
LABELS = {
    "email": "regexp_replace(regexp_replace(replace({m}, ' ', ''), '[(\\\\[]at[)\\\\]]', '@'), '[(\\\\[]dot[)\\\\]]', '.') rlike "
             "'^[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+([.][A-Za-z0-9-]+)+$'",
    "ip": OCTETS.replace("{m}", "replace({m}, ' ', '')"),
    "card": "(length(" + DIGITS + ") BETWEEN 14 AND 19 AND " + LUHN.format(d=DIGITS) + ")",
    "phone": "(length(" + DIGITS + r") BETWEEN 10 AND 15 AND ({m} rlike '^(\\+|00)' OR {m} rlike '\\(?[0-9]{{3}}\\)?[\\x20.-][0-9]{{3}}[\\x20.-][0-9]{{4}}$'))",
}


def let(value: str, name: str, body: str) -> str:
    """``body`` with ``name`` for ``value``, which is computed once."""
    return f"transform(array({value}), {name} -> {body})[0]"


def pieces(text: str, pattern: str, needs: str) -> str:
    """The text cut at its matches; those have odd indexes."""
    return (f"CASE WHEN {needs.format(t=text)} THEN split(regexp_replace({text}, '{pattern}', '{MARK}$0{MARK}'), '{MARK}')"
            f" ELSE array({text}) END")


def running(array: str, item: str, op: str) -> str:
    """What comes before each element and, last, all: ``op`` of ``acc`` and
    ``item`` (of ``x``), from 0 on. In blocks of 128, then over the blocks, so
    that growing an array by one never copies a long one."""
    inner = (f"transform(sequence(0, cast((size({array}) - 1) div 128 AS int)), k -> aggregate(slice({array}, k * 128 + 1, 128), "
             f"array(0), (accs, x) -> concat(accs, array({op.format(a='element_at(accs, -1)', x=item)}))))")
    before = f"aggregate(blocks, array(0), (accs, x) -> concat(accs, array({op.format(a='element_at(accs, -1)', x='element_at(x, -1)')})))"
    return let(inner, "blocks", let(before, "offs", "concat(flatten(transform(blocks, (b, k) -> transform("
               f"slice(b, 1, size(b) - 1), x -> {op.format(a='offs[k]', x='x')}))), array(element_at(offs, -1)))"))


def starts(parts: str) -> str:
    """Where each piece starts."""
    return running(parts, "length(x)", "{a} + {x}")


def spans(text: str, kind: str, pattern: str, needs: str, check: str, base: int) -> str:
    """The matches that pass ``check``: kind, start, end, match, context."""
    span = (f"named_struct('kind', {KINDS.index(kind)}, 'base', {base}, 's', at[i], 'e', at[i] + length(p[i]), 'm', p[i], "
            f"'b', right(p[i - 1], {CONTEXT}), 'a', left(p[i + 1], 1))")
    found = f"transform(filter(sequence(1, size(p) - 2, 2), i -> {check.format(m='p[i]')}), i -> {span})"
    return let(pieces(text, pattern, needs), "p", f"CASE WHEN size(p) < 3 THEN array() ELSE {let(starts('p'), 'at', found)} END")


def replaced(text: str, pattern: str, needs: str, check: str, by: str) -> str:
    """The text with the matches that pass ``check`` replaced."""
    return let(pieces(text, pattern, needs), "p", f"CASE WHEN size(p) < 3 THEN {text} ELSE array_join(transform(p, (x, i) -> "
               f"CASE WHEN i % 2 = 1 AND {check.format(m='x')} THEN {by} ELSE x END), '') END")


def features(c: str) -> dict[str, str]:
    """SQL of the features of the span ``c``: format, then context."""
    d = f"length({DIGITS.format(m=c + '.m')})"
    left, right = f"right({c}.b, 1)", f"{c}.a"
    return {
        "size": f"CASE WHEN {c}.kind = 0 THEN least(7, length({c}.m) div 6) WHEN {d} < 7 THEN 0 WHEN {d} < 10 THEN 1 WHEN {d} = 10 THEN 2 "
                f"WHEN {d} = 11 THEN 3 WHEN {d} < 14 THEN 4 WHEN {d} < 16 THEN 5 WHEN {d} = 16 THEN 6 ELSE 7 END",
        "groups": f"least(4, size(split(trim({c}.m), '[^0-9A-Za-z]+')) - 1)",
        "separator": f"CASE WHEN {c}.m rlike '[(\\\\[]' THEN 3 WHEN {c}.m rlike '[\\\\x20/_]' THEN 2 WHEN {c}.m rlike '[.-]' THEN 1 ELSE 0 END",
        "lead": f"CASE WHEN {c}.m rlike '^(\\\\+|00)' OR contains({c}.m, '@') THEN 2 WHEN {c}.m rlike '^\\\\(' THEN 1 ELSE 0 END",
        "cue": f"CASE WHEN lower({c}.b) rlike 'phone|tel|call|fax|mobil|whatsapp' THEN 4 WHEN lower({c}.b) rlike 'card|visa|credit|account' "
               f"THEN 3 WHEN lower({c}.b) rlike 'ip|host|server|addr' THEN 2 WHEN lower({c}.b) rlike 'mail|contact|write|reach' THEN 1 ELSE 0 END",
        "edge": f"(CASE WHEN {left} = '' OR {left} rlike '\\\\s' THEN 0 ELSE 2 END + CASE WHEN {right} = '' OR {right} rlike '[\\\\s.,;:!?)]' THEN 0 ELSE 1 END)",
    }


@dataclass
class Model:
    """Trees over the features, as nested tuples (feature, limit, low, high) or
    leaf values, and each kind's threshold (None: it adds nothing)."""
    prior: float = 0.0
    trees: list = field(default_factory=list)
    thresholds: dict[str, float | None] = field(default_factory=dict)

    def score(self, cell: dict[str, int]) -> float:
        return self.prior + sum(_value(t, cell) for t in self.trees)

    def sql(self, f: str) -> str:
        """The score as SQL over a struct ``f`` of features."""
        return " + ".join([repr(self.prior) + "D"] + [_sql(t, f) for t in self.trees])


def _value(tree, cell) -> float:
    while isinstance(tree, tuple):
        tree = tree[2] if cell[tree[0]] <= tree[1] else tree[3]
    return tree


def _sql(tree, f: str) -> str:
    if isinstance(tree, tuple):
        return f"CASE WHEN {f}.{tree[0]} <= {tree[1]} THEN {_sql(tree[2], f)} ELSE {_sql(tree[3], f)} END"
    return f"({tree!r}D)"


def boost(cells: list[dict], trees: int = TREES, rate: float = 0.3, depth: int = 3) -> tuple[float, list]:
    """Gradient boosting of the logistic loss over weighted cells (features, n,
    positives): each tree takes Newton steps in its leaves."""
    total, positive = sum(c["n"] for c in cells), sum(c["positives"] for c in cells)
    if not total:
        return 0.0, []
    prior = math.log((positive + 1) / (total - positive + 1))
    scores = [prior] * len(cells)
    names = ["kind", *FEATURES]

    def grow(rows: list[int], grad, hess, left: int):
        g, h = sum(grad[i] for i in rows), sum(hess[i] for i in rows)
        best = (1e-6, None)
        if left:
            for name in names:
                by: dict[int, list[float]] = {}
                for i in rows:
                    x = by.setdefault(cells[i][name], [0.0, 0.0])
                    x[0] += grad[i]
                    x[1] += hess[i]
                low = [0.0, 0.0]
                for v in sorted(by)[:-1]:
                    low[0] += by[v][0]
                    low[1] += by[v][1]
                    gain = low[0] ** 2 / (low[1] + 1) + (g - low[0]) ** 2 / (h - low[1] + 1) - g ** 2 / (h + 1)
                    if gain > best[0]:
                        best = (gain, (name, v))
        if best[1] is None:
            return rate * g / (h + 1)
        name, v = best[1]
        return (name, v, grow([i for i in rows if cells[i][name] <= v], grad, hess, left - 1),
                grow([i for i in rows if cells[i][name] > v], grad, hess, left - 1))

    out = []
    for _ in range(trees):
        p = [1 / (1 + math.exp(-max(-30, min(30, s)))) for s in scores]
        grad = [c["positives"] - c["n"] * q for c, q in zip(cells, p)]
        hess = [c["n"] * q * (1 - q) for c, q in zip(cells, p)]
        tree = grow(list(range(len(cells))), grad, hess, depth)
        out.append(tree)
        scores = [s + _value(tree, c) for s, c in zip(scores, cells)]
    return prior, out


def calibrated(model: Model, held: list[dict], precision: float = PRECISION) -> dict[str, float | None]:
    """Per kind, the lowest score from which on the held-out proposals (with
    one failure more, to be careful) are right often enough."""
    out: dict[str, float | None] = {}
    for k, kind in enumerate(KINDS):
        n = good = 0
        out[kind] = None
        scored = sorted(((model.score(c), c["n"], c["positives"]) for c in held if c["kind"] == k), reverse=True)
        for j, (s, m, g) in enumerate(scored):
            n, good = n + m, good + g
            if (j + 1 == len(scored) or scored[j + 1][0] < s) and good >= precision * (n + 1):
                out[kind] = s
    return out


def _text(df: DataFrame, text_col: str) -> DataFrame:
    """Adds ``_t``, the text, and ``_masked``, in which base spans are blotted
    out by as many fillers."""
    df = df.withColumn("_t", F.expr(f"translate(coalesce(`{text_col}`, ''), '{MARK}', '\\u0002')"))
    masked = "_t"
    for kind in KINDS:
        df = df.withColumn(f"_m_{kind}", F.expr(replaced(masked, BASE[kind], NEEDS[kind], CHECKS[kind], f"repeat('{FILL}', length(x))")))
        masked = f"_m_{kind}"
    return df.withColumn("_masked", F.col(masked)).drop(*[f"_m_{k}" for k in KINDS])


def _base(kinds=tuple(KINDS)) -> str:
    return "concat(" + ", ".join(spans("_t", k, BASE[k], NEEDS[k], CHECKS[k], 1) for k in kinds) + ")"


def _proposed() -> str:
    return "concat(" + ", ".join(spans("_masked", k, LOOSE[k], LOOSE_NEEDS[k], "length({m}) >= 7", 0) for k in KINDS) + ")"


def proposals(docs: DataFrame, text_col: str = "text") -> list[dict]:
    """Counts of proposals and labels: held (a fifth of the documents, by hash of
    doc_id), base, kind, features, n, positives."""
    held = F.pmod(F.xxhash64(F.lit("pii"), F.col("doc_id")), F.lit(5)) == 0
    rows = _text(docs.select(held.alias("held"), F.col(f"`{text_col}`").alias("text")), "text")
    c = rows.select("held", F.explode(F.expr(f"concat({_base()}, {_proposed()})")).alias("c"))
    label = "CASE c.kind " + " ".join(f"WHEN {k} THEN {LABELS[kind].format(m='c.m')}" for k, kind in enumerate(KINDS)) + " END"
    c = c.select("held", F.expr("c.base = 1").alias("base"), F.expr("c.kind").alias("kind"), F.expr(label).alias("y"),
                 *[F.expr(x).alias(n) for n, x in features("c").items()])
    by = ["held", "base", "kind", *FEATURES]
    cells = c.groupBy(*by).agg(F.count(F.lit(1)).alias("n"), F.count_if("y").alias("positives"))
    return [r.asDict() for r in cells.orderBy(*by).collect()]  # at most MAX_CELLS


def fit(docs: DataFrame, text_col: str = "text", precision: float = PRECISION) -> Model:
    """Learns from the proposals in all documents but the held ones, whose loose
    proposals give the thresholds."""
    cells = proposals(docs, text_col)
    model = Model(*boost([x for x in cells if not x["held"]]))
    model.thresholds = calibrated(model, [x for x in cells if x["held"] and not x["base"]], precision)
    return model


def accepted(model: Model, kind: str, c: str) -> str:
    """SQL: whether the trees accept the loose span ``c`` of ``kind``."""
    threshold = model.thresholds.get(kind)
    if threshold is None:
        return "false"
    struct = "named_struct('kind', " + f"{c}.kind, " + ", ".join(f"'{n}', {x}" for n, x in features(c).items()) + ")"
    # The sums of the same tree values may round otherwise in SQL.
    return let(struct, "f", f"({model.sql('f')}) >= {threshold - 1e-9!r}D")


def find(df: DataFrame, model: Model, text_col: str = "text", into: str = "pii") -> DataFrame:
    """Adds ``pii`` (or ``into``): an array of (kind, base, start, end, text), by start, kind
    and end; ``base`` tells base spans from what the trees add."""
    keep = [c for c in df.columns if c != into]
    rows = _text(df, text_col)
    added = [f"filter({spans('_masked', k, LOOSE[k], LOOSE_NEEDS[k], 'length({m}) >= 7', 0)}, c -> {accepted(model, k, 'c')})"
             for k in KINDS if model.thresholds.get(k) is not None]
    every = f"concat({', '.join([_base(), *added])})"
    names = "element_at(array(" + ", ".join(f"'{k}'" for k in KINDS) + "), x.kind + 1)"
    shown = (f"transform(array_sort(transform({every}, x -> named_struct('s', x.s, 'kind', x.kind, 'e', x.e, 'base', x.base, 'm', x.m))), "
             f"x -> named_struct('kind', {names}, 'base', x.base = 1, 'start', x.s, 'end', x.e, 'text', x.m))")
    return rows.select(*[F.col(f"`{c}`") for c in keep], F.expr(shown).alias(into))


def redact(df: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """``df`` with what the spans cover of the text replaced by ``[EMAIL]``,
    ``[IP]``, ``[CARD]`` or ``[PHONE]``, the kind of the first of spans that
    overlap; a null text stays null."""
    rows = find(df.withColumn("_own", F.col(f"`{text_col}`")), model, "_own", "_pii")
    rows = rows.withColumn("_ends", F.expr(f"CASE WHEN size(_pii) > 0 THEN {running('_pii', 'x.end', 'greatest({a}, {x})')} END"))
    # Up to which place all before a span is told; texts are cut in blocks of 256 spans, then in those.
    told = let("_ends[k * 256 + j]", "done", "CASE WHEN x.start >= done THEN concat(substring(block, done - _ends[k * 256] + 1, "
               "x.start - done), '[', upper(x.kind), ']') ELSE '' END")
    block = "substring(_own, _ends[k * 256] + 1, _ends[least(size(_pii), (k + 1) * 256)] - _ends[k * 256])"
    parts = ("transform(sequence(0, cast((size(_pii) - 1) div 256 AS int)), k -> "
             + let(block, "block", f"array_join(transform(slice(_pii, k * 256 + 1, 256), (x, j) -> {told}), '')") + ")")
    text = f"CASE WHEN size(_pii) > 0 THEN concat(array_join({parts}, ''), substring(_own, element_at(_ends, -1) + 1)) ELSE _own END"
    return rows.withColumn(text_col, F.expr(text)).select(*[F.col(f"`{c}`") for c in df.columns])


def digests(docs: DataFrame) -> DataFrame:
    """Counts and digest of the base spans, and all spans as text."""
    docs = docs.select("doc_id", "text")
    found = find(docs, fit(docs)).select("doc_id", "pii")
    told = "array_join(transform({}, x -> concat_ws(':', x.kind, x.start, x.end)), ',')"
    counts = [F.expr(f"cast(size(filter(pii, x -> x.base AND x.kind = '{k}')) AS bigint)").alias(f"n_{k}") for k in KINDS]
    return found.select("doc_id", *counts, F.sha2(F.expr(told.format("filter(pii, x -> x.base)")), 256).alias("base_sha256"),
                        F.expr(told.format("pii")).alias("spans"))
