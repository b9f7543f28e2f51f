"""Language identification by hierarchical discrimination (operator 4).

The family of a text's language is decided first, then the language within
the family, each by one-versus-one linear support vector machines over hashed
byte n-grams of the whole text. A vote is the sign of a margin; a margin also
gives a probability (fitted on rows that the machine hasn't seen). A class is
as probable as it is in the duel that is worst for it, however many classes
there are, and the score of a prediction is the probability of the family times
that of the language in it.

The machines are fitted in a task on a bounded sample of labelled rows, at
most ``max_rows`` over all languages (whole texts, chosen by a hash of
doc_id); the driver gets only their weights. Predicting is map-only.

Defined cases: a null text, or one without a letter, is ``und`` with score 0,
as is everything if nothing was learned; with one learned language every
other text is that language with score 1; rows without a language teach
nothing; ties in votes go to the larger probability, then to the name that
sorts first; texts of any length are counted whole; repeated rows get equal
predictions; a row without doc_id is not held out and teaches nothing; input columns named like
an output column are replaced.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hourglass.llm.storage import small_batches

UNKNOWN = "und"
DIM = 4096
#: Rows that the machines are fitted on at most, over all languages.
MAX_ROWS = 2000
#: Bytes of text whose n-grams are counted at a time, and of how many texts at most: a byte
#: takes some forty bytes of numbers meanwhile, a text three rows of ``DIM``.
SLICE, TEXTS = 1 << 17, 64

# Families of ISO 639-1 codes. Other codes are families of their own.
FAMILIES = {
    "germanic": ["da", "de", "en", "is", "nl", "no", "sv"],
    "romance": ["ca", "es", "fr", "gl", "it", "pt", "ro"],
    "slavic": ["bg", "cs", "hr", "pl", "ru", "sk", "sl", "sr", "uk"],
    "finnic": ["et", "fi"],
    "indic": ["bn", "hi", "mr", "ur"],
    "turkic": ["az", "kk", "tr"],
}
FAMILY_OF = {code: family for family, codes in FAMILIES.items() for code in codes}


def has_letter(text: str | None) -> bool:
    return text is not None and any(map(str.isalpha, text))


def _plain() -> bytes:
    """ASCII that isn't a letter counts as a space."""
    return bytes(b if b >= 128 or chr(b).isalpha() else 32 for b in range(256))


PLAIN = _plain()


def features(texts: list[str | None]):
    """A row per text: square roots of the counts of hashed byte pairs and
    triples, of length 1, and a constant for the bias."""
    import numpy as np
    out = np.zeros((len(texts), DIM + 1), "f4")

    def count(rows: list[int], parts: list[bytes], starts: list[int]) -> None:
        """``starts``: how many n-grams of each part count, from its beginning;
        those behind would reach into the next part."""
        joined = np.frombuffer(b"   ".join(parts) + b"   ", "u1").astype("u4")
        row, at = np.full(len(joined), -1, "i8"), 0
        for k, (part, n) in enumerate(zip(parts, starts)):
            row[at:at + n] = k
            at += len(part) + 3
        here = np.flatnonzero(row >= 0)
        row, a, b, c = row[here] * DIM, joined[here], joined[here + 1], joined[here + 2]
        two = a * 0x9E3779B1 + b * 0x85EBCA77
        three = (two ^ (c * 0xC2B2AE3D)) * np.uint32(0x27D4EB2F) >> 20
        found = np.bincount(np.concatenate([row + (two >> 20), row + three]), minlength=len(parts) * DIM)
        np.add.at(out, (np.array(rows),), np.pad(found.reshape(len(parts), DIM), ((0, 0), (0, 1))).astype("f4"))

    rows, parts, starts, held = [], [], [], 0
    for i, t in enumerate(texts):
        data = (t or "").lower().encode("utf-8", "replace").translate(PLAIN)
        for at in range(0, max(len(data), 1), SLICE):
            last = at + SLICE >= len(data)
            rows.append(i)
            parts.append(data[at:] if last else data[at:at + SLICE + 2])
            starts.append(len(parts[-1]) + 1 if last else SLICE)
            held += len(parts[-1])
            if held > SLICE or len(parts) >= TEXTS:
                count(rows, parts, starts)
                rows, parts, starts, held = [], [], [], 0
    if parts:
        count(rows, parts, starts)
    for at in range(0, len(out), TEXTS):
        some = out[at:at + TEXTS]
        np.sqrt(some, out=some)
        some /= np.maximum(np.linalg.norm(some, axis=1, keepdims=True), 1e-9)
    out[:, DIM] = 1
    return out


@dataclass
class Duel:
    """A linear support vector machine of two classes: positive margins are
    for ``first``; sigmoid(slope * margin + shift) is its probability."""
    first: str
    second: str
    weights: list[float]
    slope: float = 4.0
    shift: float = 0.0


@dataclass
class Model:
    """Duels between families (key "") and between the languages of a family."""
    classes: dict[str, list[str]] = field(default_factory=dict)
    duels: dict[str, list[Duel]] = field(default_factory=dict)


def fit_duel(first: str, second: str, x, of, rounds: int = 150, decay: float = 1e-4) -> Duel:
    """Fits on the rows of ``x`` whose class in ``of`` is one of the two. Squared hinge
    loss by accelerated gradient steps; classes weigh the same. A fifth of
    the rows is left for the probability."""
    import numpy as np
    own = np.flatnonzero((of == first) | (of == second))
    y = np.where(of[own] == first, 1.0, -1.0).astype("f4")
    held = np.arange(len(y)) % 5 == 4
    if min((y[~held] > 0).sum(), (y[~held] < 0).sum()) == 0 or held.sum() < 20:
        held[:] = False
    a, b = x[own[~held]], y[~held]
    c = np.where(b > 0, 0.5 / max(1, (b > 0).sum()), 0.5 / max(1, (b < 0).sum())).astype("f4")
    w = v = np.zeros(x.shape[1], "f4")
    step = 1 / (2 * 2 + 2 * decay)  # rows have length of at most sqrt(2)
    for k in range(rounds):
        slack = np.maximum(0, 1 - b * (a @ v))
        grad = -2 * (a.T @ (c * b * slack)) + 2 * decay * v
        w, before = v - step * grad, w
        v = w + k / (k + 3) * (w - before)
    m, t = (x[own[held]] @ w, y[held] > 0) if held.any() else (a @ w, y > 0)
    slope, shift = 1.0, 0.0
    goal = np.where(t, (t.sum() + 1) / (t.sum() + 2), 1 / ((~t).sum() + 2))
    z = np.stack([m, np.ones_like(m)], 1).astype("f8")
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(z @ (slope, shift), -30, 30)))
        h = (z * (p * (1 - p))[:, None]).T @ z + np.eye(2) * 1e-3
        d = np.linalg.solve(h, z.T @ (p - goal) + 1e-3 * np.array([slope, shift]))
        slope, shift = slope - d[0], shift - d[1]
    return Duel(first, second, [float(q) for q in w], float(max(slope, 0.1)), float(shift))


def fit_rows(texts: list[str], langs: list[str]) -> Model:
    import numpy as np
    langs = np.array(langs, object)
    families = np.array([FAMILY_OF.get(l, l) for l in langs], object)
    x, model = features(texts), Model()

    def level(name: str, of, names: list[str]) -> None:
        model.classes[name] = names
        model.duels[name] = []
        for i, p in enumerate(names):
            for q in names[i + 1:]:
                model.duels[name].append(fit_duel(p, q, x, of))

    level("", families, sorted(set(families)))
    for f in model.classes[""]:
        level(f, langs, sorted(set(langs[families == f])))
    return model


def fit(docs: DataFrame, train: Column, text_col: str = "text", lang_col: str = "lang",
        max_rows: int = MAX_ROWS, seed: int = 5) -> Model:
    """Fits on rows where ``train`` holds, that have a language and a letter.
    ``docs`` needs doc_id, whose hash chooses the sample, evenly by language."""
    small_batches(docs.sparkSession)
    rows = docs.filter(train).select("doc_id", F.col(f"`{text_col}`").alias("text"), F.col(f"`{lang_col}`").alias("lang")) \
        .filter(F.col("lang").isNotNull() & F.col("text").rlike(r"\p{L}"))
    counts = {r["lang"]: r["count"] for r in rows.groupBy("lang").count().collect()}  # a row per language
    if not counts:
        return Model()
    each = max(1, max_rows // len(counts))
    share = F.create_map(*[F.lit(v) for l, n in counts.items() for v in (l, min(1.0, each / n))])
    dice = F.pmod(F.xxhash64(F.lit(seed), "doc_id"), F.lit(1 << 20)) / (1 << 20)
    sample = rows.filter(dice < share[F.col("lang")]).limit(2 * max_rows).drop("doc_id").coalesce(1)

    def run(batches):
        import pickle

        import pyarrow as pa
        found = pa.Table.from_batches(list(batches)).sort_by([("lang", "ascending"), ("text", "ascending")])
        model = fit_rows(found["text"].to_pylist(), found["lang"].to_pylist())
        yield pa.RecordBatch.from_arrays([pa.array([pickle.dumps(model)])], names=["model"])

    import pickle
    return pickle.loads(sample.mapInArrow(run, "model binary").first()[0])


def predict_rows(model: Model, texts: list[str | None]) -> tuple[list[str], list[float]]:
    import numpy as np
    langs, scores = [UNKNOWN] * len(texts), [0.0] * len(texts)
    rows = np.array([i for i, t in enumerate(texts) if model.classes and has_letter(t)], int)
    if not len(rows):
        return langs, scores
    x = features([texts[i] for i in rows])

    def level(name: str, x):
        """Class number of each row, and its least probability in a duel."""
        names = model.classes[name]
        if len(names) == 1:
            return np.zeros(len(x), int), np.ones(len(x))
        votes, p = np.zeros((len(x), len(names))), np.zeros((len(x), len(names)))
        least = np.ones((len(x), len(names)))
        for d in model.duels[name]:
            m = x @ np.array(d.weights, "f4")
            i, j = names.index(d.first), names.index(d.second)
            q = 1 / (1 + np.exp(-np.clip(d.slope * m + d.shift, -30, 30)))
            votes[:, i] += m > 0
            votes[:, j] += m <= 0
            p[:, i] += q
            p[:, j] += 1 - q
            least[:, i] = np.minimum(least[:, i], q)
            least[:, j] = np.minimum(least[:, j], 1 - q)
        p /= p.sum(1, keepdims=True)
        best = (votes + p / 2).argmax(1)
        return best, least[np.arange(len(x)), best]

    family, p = level("", x)
    for f, name in enumerate(model.classes[""]):
        own = np.flatnonzero(family == f)
        if len(own):
            lang, q = level(name, x[own])
            for i, l, s in zip(rows[own].tolist(), lang.tolist(), (p[own] * q).tolist()):
                langs[i], scores[i] = model.classes[name][l], s
    return langs, scores


def predict(df: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """Adds ``lang_pred`` and ``score`` (0 to 1)."""
    fields = [T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())]
    keep = [f for f in df.schema.fields if f.name not in ("lang_pred", "score")]

    def run(batches):
        import pyarrow as pa
        for whole in batches:
            for at in range(0, whole.num_rows, 1000):
                batch = whole.slice(at, 1000)
                langs, scores = predict_rows(model, batch.column(batch.schema.get_field_index(text_col)).to_pylist())
                yield pa.RecordBatch.from_arrays(
                    [batch.column(batch.schema.get_field_index(f.name)) for f in keep]
                    + [pa.array(langs, pa.string()), pa.array(scores, pa.float64())], names=[f.name for f in keep + fields])

    small_batches(df.sparkSession)
    return df.mapInArrow(run, T.StructType(keep + fields))


def fold(n: int) -> Column:
    return F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(n))


def query(docs: DataFrame) -> DataFrame:
    model = fit(docs, fold(3) != 1)
    found = predict(docs.select("doc_id", "text"), model)
    return found.select("doc_id", F.coalesce(fold(3) == 1, F.lit(False)).alias("held_out"), "lang_pred", "score")
