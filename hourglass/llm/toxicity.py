"""Toxicity by weak supervision (operator 10).

Patterns are words and word beginnings: fixed lexicons of insults by theme,
and beginnings mined from labelled training texts. A voter is a theme of the
lexicon or one mined beginning, and votes when its patterns are dense enough
in a text. A generative label model says how texts of either class vote: for
each class a tree over the voters (each voter depends on at most one other,
the trees being of the largest mutual information), so that it knows the
voters' accuracies and which of them only repeat each other. It is fitted by
expectation maximisation on the counts of vote patterns of all training
documents, labelled or not; there are at most 2**VOTERS patterns, which is all
that the driver gets. Its posteriors are the labels on which a linear
(logistic) classifier over the densities of all single patterns is trained,
and that classifier scores every text.

Mining and the classifier use a bounded sample of labelled training rows
(``max_rows``, chosen by a hash of doc_id, whole texts); votes are counted
over all training documents. Voting and scoring are map-only.

Defined cases: a null or empty text has no matches and gets the score of such
texts; texts of any length are read whole; repeated rows get equal scores; a row without doc_id is not held
out; several labels of a doc_id count as
toxic if one is; without any labels the lexicon alone starts the label model;
with an empty corpus nothing is learned and scores are 0; input columns named
like an output column are replaced.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import lru_cache

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hourglass.llm.storage import small_batches

#: Voters at most: the themes and the mined beginnings.
VOTERS = 14
#: Labelled rows of either class in the sample, at most about.
MAX_ROWS = 3000
#: A voter votes when this part of a text's words match: of a lexicon's theme,
#: of a mined beginning (then of two words at least: once may be chance).
DENSE, DENSE_MINED = 0.001, 0.008

# Insults by theme; a trailing * stands for any ending.
LEXICON = {
    "wits": ["idiot*", "moron*", "imbecil*", "imbécil*", "stupid*", "estúpid*", "dumb", "dimwit*", "halfwit*", "cretin*", "crétin*",
             "dumm", "dummkopf", "blöd*", "débile*", "tonto", "tonta"],
    "worth": ["worthless", "pathetic", "useless", "loser", "losers", "failure", "wertlos", "versager", "minable", "inútil", "nulidad"],
    "filth": ["trash", "garbage", "scum", "vermin", "filth", "filthy", "dreck", "abschaum", "ordure", "racaille", "basura", "escoria"],
    "disgust": ["disgusting", "disgust", "repulsive", "revolting", "loathsome", "ekelhaft", "widerlich", "dégoûtant*", "asqueros*"],
    "mockery": ["clown", "clowns", "buffoon", "laughable", "ridiculous", "pitiful", "payaso", "payasa", "bouffon"],
    "hate": ["hate you", "kill yourself", "shut up", "go to hell", "halt die klappe", "ta gueule", "cállate", "verpiss dich"],
}


@dataclass(frozen=True)
class Pattern:
    """``text`` at the beginning of a word, or the whole of it."""
    text: str
    whole: bool
    voter: int


def lexicon() -> list[Pattern]:
    return [Pattern(w.rstrip("*"), not w.endswith("*"), i) for i, words in enumerate(LEXICON.values()) for w in words]


class Matcher:
    """Counts the patterns in a text, in one pass over it."""

    def __init__(self, patterns: tuple[Pattern, ...]):
        import ahocorasick
        self.n = len(patterns)
        found: dict[str, list[tuple[int, bool]]] = {}
        for i, p in enumerate(patterns):
            found.setdefault(p.text, []).append((i, p.whole))
        self.automaton = ahocorasick.Automaton()
        for text, own in found.items():
            self.automaton.add_word(text, (len(text), own))
        if found:
            self.automaton.make_automaton()

    def count(self, text: str | None) -> tuple[dict[int, int], int]:
        """(matches by pattern, words)"""
        text = (text or "").lower()
        out: dict[int, int] = {}
        if self.n:
            for end, (size, own) in self.automaton.iter(text):
                if end >= size and text[end - size].isalpha():
                    continue
                ended = end + 1 == len(text) or not text[end + 1].isalpha()
                for i, whole in own:
                    if ended or not whole:
                        out[i] = out.get(i, 0) + 1
        return out, len(text.split())


@lru_cache(maxsize=4)
def matcher(patterns: tuple[Pattern, ...]) -> Matcher:
    return Matcher(patterns)


def votes(patterns: tuple[Pattern, ...], text: str | None) -> int:
    """The voters that vote for the text, as bits."""
    return _votes(patterns, *matcher(patterns).count(text))


def _votes(patterns: tuple[Pattern, ...], found: dict[int, int], words: int) -> int:
    total: dict[int, int] = {}
    for i, n in found.items():
        total[patterns[i].voter] = total.get(patterns[i].voter, 0) + n
    return sum(1 << v for v, n in total.items()
               if (n >= DENSE * words if v < len(LEXICON) else n > 1 and n >= DENSE_MINED * words))


def densities(patterns: tuple[Pattern, ...], texts: list[str | None]):
    """A row per text: for each pattern how dense it is, up to one in fifty
    words, for each voter its vote, and a constant."""
    import numpy as np
    out = np.zeros((len(texts), len(patterns) + VOTERS + 1))
    out[:, -1] = 1
    for row, text in enumerate(texts):
        found, words = matcher(patterns).count(text)
        for i, n in found.items():
            if n > 1 or patterns[i].voter < len(LEXICON):
                out[row, i] = min(1.0, 50 * n / max(words, 1))
        bits = _votes(patterns, found, words)
        for v in range(VOTERS):
            out[row, len(patterns) + v] = bits >> v & 1
    return out


def _texts(batch, name: str) -> list[str | None]:
    return batch.column(batch.schema.get_field_index(name)).to_pylist()


def _added(df: DataFrame, fields: list[T.StructField], work, text_col: str) -> DataFrame:
    names = [f.name for f in fields]
    keep = [f for f in df.schema.fields if f.name not in names]

    def run(batches):
        import pyarrow as pa
        for whole in batches:
            for at in range(0, whole.num_rows, 1000):
                batch = whole.slice(at, 1000)
                yield pa.RecordBatch.from_arrays([batch.column(batch.schema.get_field_index(f.name)) for f in keep]
                                                 + work(_texts(batch, text_col)), names=[f.name for f in keep] + names)

    small_batches(df.sparkSession)
    return df.mapInArrow(run, T.StructType(keep + fields))


def sampled(docs: DataFrame, labels: DataFrame, max_rows: int) -> tuple[DataFrame, dict[int, float]]:
    """Texts of at most about ``max_rows`` labelled rows of either class, with
    ``toxic``, and how many rows one of each class stands for."""
    counts = {r["toxic"]: r["count"] for r in labels.groupBy("toxic").count().collect()}
    share = {t: min(1.0, max_rows / n) for t, n in counts.items()}
    dice = F.pmod(F.xxhash64(F.lit("toxic"), "doc_id"), F.lit(1 << 20)) / (1 << 20)
    chosen = labels.filter(dice < F.when(F.col("toxic") == 1, share.get(1, 1.0)).otherwise(share.get(0, 1.0))) \
        .limit(3 * max_rows)
    # Bounded by max_rows, so broadcast: the texts needn't be shuffled.
    return docs.join(F.broadcast(chosen), "doc_id").select("doc_id", "text", "toxic"), {t: 1 / s for t, s in share.items()}


def mine(sample: DataFrame, stands_for: dict[int, float], known: list[Pattern], limit: int) -> list[Pattern]:
    """Beginnings of words that are dense in toxic texts and not in others, none
    of which begins another or a known pattern."""

    def run(batches):
        from collections import Counter

        import pyarrow as pa
        import regex
        find = regex.compile(r"\p{L}+").findall
        for batch in batches:
            seen: dict[int, Counter] = {0: Counter(), 1: Counter()}
            for text, toxic in zip(_texts(batch, "text"), _texts(batch, "toxic")):
                words = find((text or "").lower())
                found = Counter()
                for w, n in Counter(words).items():
                    for k in range(4, min(len(w), 9) + 1):
                        found[w[:k]] += n
                seen[toxic].update(p for p, n in found.items() if n > 1 and n >= DENSE_MINED * len(words))
            every = list(seen[0].keys() | seen[1].keys())
            yield pa.RecordBatch.from_arrays([pa.array(every, pa.string()), pa.array([seen[0][p] for p in every], pa.int64()),
                                              pa.array([seen[1][p] for p in every], pa.int64())], names=["p", "clean", "toxic"])

    texts = {r["toxic"]: r["count"] for r in sample.groupBy("toxic").count().collect()}
    if not texts.get(1):
        return []
    w0, w1 = stands_for.get(0, 1.0), stands_for.get(1, 1.0)
    sums = sample.mapInArrow(run, "p string, clean long, toxic long").groupBy("p") \
        .agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic"))
    rate = (F.col("toxic") * w1) / (F.col("toxic") * w1 + (F.col("clean") + 1) * w0)
    # Right often and for many; of beginnings that tell the same, the longest.
    best = sums.filter((F.col("toxic") >= max(3, texts[1] // 200)) & (rate >= 0.5)) \
        .orderBy(F.desc(F.round(rate * rate * F.log1p("toxic"), 2)), F.desc(F.length("p")), "p").limit(400).collect()
    out: list[Pattern] = []
    for r in best:
        p = r["p"]
        if len(out) < limit and not any(p.startswith(q.text) or q.text.startswith(p) for q in [*out, *known]):
            out.append(Pattern(p, False, len(LEXICON) + len(out)))
    return out


@dataclass
class LabelModel:
    """For each class a tree over the voters: ``parents[v]`` (-1: none) and
    ``tables[y][v][parent's vote]``, the chance that v votes."""
    prior: float = 0.1
    parents: list[int] = field(default_factory=list)
    tables: list = field(default_factory=list)

    def posterior(self, bits):
        """Chance of class 1 for each vote pattern (rows of 0 and 1)."""
        import numpy as np
        bits = np.asarray(bits)
        logs = np.tile(np.log([1 - self.prior, self.prior]), (len(bits), 1))
        for v, parent in enumerate(self.parents):
            given = bits[:, parent] if parent >= 0 else np.zeros(len(bits), int)
            for y in (0, 1):
                p = np.array(self.tables[y][v])[given]
                logs[:, y] += np.log(np.where(bits[:, v] == 1, p, 1 - p))
        return 1 / (1 + np.exp(np.clip(logs[:, 0] - logs[:, 1], -60, 60)))


def fit_label_model(bits, n, labels, rounds: int = 8, unlabelled: float = 0.05) -> LabelModel:
    """``bits``: vote patterns, ``n``: documents with each, ``labels``: 0, 1 or
    -1 for unknown. Labelled documents start the model and stay what they
    are while it is fitted; without any, two votes or more start as toxic.
    Documents without a label count ``unlabelled`` as much, so that they refine
    the model rather than pull it to clusters of their own."""
    import numpy as np
    bits, n, labels = np.asarray(bits, int).reshape(len(n), -1), np.asarray(n, float), np.asarray(labels)
    voters = bits.shape[1]
    known = labels >= 0
    q = np.where(known, labels, np.where(bits.sum(1) >= 2, 0.9, 0.05)).astype(float)
    weight = n * known if (known & (labels == 1)).any() else n  # first from labels alone, if there are any
    model = LabelModel()
    for _ in range(rounds):
        by = [weight * (1 - q), weight * q]
        mass = [w.sum() + 2 for w in by]
        # Mutual information of two voters, given the class.
        info = np.zeros((voters, voters))
        for w, m in zip(by, mass):
            one = (w @ bits + 0.1) / (m + 0.2)
            both = (bits.T @ (bits * w[:, None]) + 0.02) / (m + 0.2)
            for a, b in ((1, 1), (1, 0), (0, 1), (0, 0)):
                pa, pb = (one if a else 1 - one)[:, None], (one if b else 1 - one)[None, :]
                pab = {(1, 1): both, (1, 0): one[:, None] - both, (0, 1): one[None, :] - both,
                       (0, 0): 1 - one[:, None] - one[None, :] + both}[a, b].clip(1e-9)
                info += m * pab * np.log(pab / (pa * pb))
        parents, tree = [-1] * voters, [0]
        while len(tree) < voters:  # the tree of the largest sum
            gain, v, p = max((info[v, p], -v, p) for v in range(voters) if v not in tree for p in tree)
            parents[-v] = p if gain > 0 else -1
            tree.append(-v)
        tables = []
        for w, m in zip(by, mass):
            rows, own = [], ((w @ bits + 0.01) / m).clip(1e-5, 1 - 1e-5)  # rare cases lean on the voter's own rate
            for v in range(voters):
                g = bits[:, parents[v]] if parents[v] >= 0 else np.zeros(len(bits), int)
                rows.append([float(((w * (g == k)) @ bits[:, v] + own[v]) / ((w * (g == k)).sum() + 1)) for k in (0, 1)])
            tables.append(rows)
        model = LabelModel(float(np.clip(mass[1] / sum(mass), 1e-4, 0.9)), parents, tables)
        q = np.where(known, np.maximum(labels, 0), model.posterior(bits))
        weight = np.where(known, n, unlabelled * n) if (known & (labels == 1)).any() else n
    return model


def fit_classifier(x, goal, weight, decay: float = 1e-6, rounds: int = 30) -> list[float]:
    """Logistic regression on soft labels, by Newton steps."""
    import numpy as np
    w = np.zeros(x.shape[1])
    weight = weight / weight.sum()
    reg = np.full(x.shape[1], decay)
    reg[-1] = 1e-8
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        h = (x * (weight * p * (1 - p) + 1e-12)[:, None]).T @ x + np.diag(reg)
        w = w - np.linalg.solve(h, x.T @ (weight * (p - goal)) + reg * w)
    return [float(v) for v in w]


@dataclass
class Model:
    patterns: tuple[Pattern, ...] = ()
    label_model: LabelModel = field(default_factory=LabelModel)
    weights: list[float] = field(default_factory=list)

    def scores(self, texts: list[str | None]):
        import numpy as np
        if not self.weights:
            return np.zeros(len(texts))
        return 1 / (1 + np.exp(-np.clip(densities(self.patterns, texts) @ np.array(self.weights), -40, 40)))


def fit(docs: DataFrame, labels: DataFrame, train: Column, max_rows: int = MAX_ROWS) -> Model:
    """``docs``: doc_id, text. ``labels``: doc_id, toxic. ``train``: a condition
    over doc_id for the rows whose labels and texts are learned from."""
    import numpy as np
    labels = labels.filter(train & F.col("toxic").isNotNull() & F.col("doc_id").isNotNull()).groupBy("doc_id") \
        .agg(F.max((F.col("toxic") == 1).cast("int")).alias("toxic"))
    docs = docs.select("doc_id", "text").filter(train)
    sample, stands_for = sampled(docs, labels, max_rows)
    if sample.isEmpty():  # no labels: the label model's posteriors are all there is
        dice = F.pmod(F.xxhash64(F.lit("toxic"), "doc_id"), F.lit(1 << 20)) / (1 << 20)
        sample = docs.filter(dice < 2 * max_rows / max(docs.count(), 1)).withColumn("toxic", F.lit(0))
    known = lexicon()
    patterns = tuple(known + mine(sample, stands_for, known, VOTERS - len(LEXICON)))
    voters = 1 + max(p.voter for p in patterns)

    def vote(texts):
        import pyarrow as pa
        return [pa.array([votes(patterns, t) for t in texts], pa.int32())]

    field_ = [T.StructField("votes", T.IntegerType())]
    cells = _added(docs, field_, vote, "text").select("doc_id", "votes").join(labels, "doc_id", "left") \
        .groupBy("votes", F.coalesce("toxic", F.lit(-1)).alias("label")).count().collect()  # at most 3 * 2**VOTERS
    if not cells:
        return Model()
    cells.sort()
    spread = lambda b: [b >> v & 1 for v in range(voters)]
    label_model = fit_label_model([spread(c["votes"]) for c in cells], [c["count"] for c in cells], [c["label"] for c in cells])

    def rows(texts):
        import pyarrow as pa
        return [pa.array([x.tolist() for x in densities(patterns, texts)], pa.list_(pa.float64())), *vote(texts)]

    drawn = _added(sample, [T.StructField("x", T.ArrayType(T.DoubleType())), *field_], rows, "text") \
        .groupBy("x", "votes", "toxic").count().collect()  # the sample's, equal rows as one
    drawn.sort()
    goal = label_model.posterior([spread(r["votes"]) for r in drawn])
    weight = np.array([r["count"] * stands_for.get(r["toxic"], 1.0) for r in drawn])
    return Model(patterns, label_model, fit_classifier(np.array([r["x"] for r in drawn]), goal, weight))


def score(df: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """Adds ``score`` (0 to 1) and ``predicted`` (1 from 0.5 on)."""
    fields = [T.StructField("score", T.DoubleType()), T.StructField("predicted", T.IntegerType())]

    def work(texts):
        import pyarrow as pa
        s = model.scores(texts)
        return [pa.array(s, pa.float64()), pa.array((s >= 0.5).astype("i4"), pa.int32())]

    return _added(df, fields, work, text_col)


def query(docs: DataFrame, labels: DataFrame) -> DataFrame:
    fold = F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(5))
    model = fit(docs, labels.select("doc_id", "toxic"), fold != 0)
    return score(docs.select("doc_id", "text"), model).select("doc_id", F.coalesce(fold == 0, F.lit(False)).alias("held_out"), "score", "predicted")
