"""Language-model scores by subword lattices (operator 9).

The vocabulary of a published tokenizer gives the pieces; nothing about it is
trained. A text's words, lower-cased and each led by the word mark, are
lattices of pieces: every segmentation counts, with the product of its pieces'
probabilities, and the forward recursion in log space adds them all. Pieces
don't cross words, so a text's marginal probability is the product of those of
its words and of the end, and each distinct word of the corpus is computed
once. Piece probabilities start from the scores in the vocabulary file and
are fitted to the training documents by expectation maximisation over the same
lattices: expected counts of pieces, from all training words and their counts.

Words go through the recursion in sorted order, so that the forward variables
of a shared beginning are computed once. Word counts and word scores are
tables; the ``HOT`` words at most that the training documents use most are
broadcast, which settles most occurrences in the scan, and the others are
joined by shuffle, pre-aggregated per text.

The plain unigram score over whole words is given beside it (``base_score``).

Defined cases: a null or empty text is only the end; repeated rows are scored
each; without training documents all counts are 0 and pieces keep their start
probabilities; a character outside the vocabulary is its bytes; any length of
word is whole; extra columns are ignored; empty tables give empty results.
"""

from __future__ import annotations

import math
import os
from functools import lru_cache

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hourglass.llm.storage import small_batches, written

DEFAULT_VOCABULARY = "piece_bpe_32k.model"
#: Words whose scores are broadcast, at most.
HOT = 1 << 18
#: Words a task counts before it hands its counts on.
COUNTED = 300_000
ROUNDS = 1
MARK = "▁"
#: Longer words share no beginnings; their recursion keeps two numbers a character.
LONG = 1000
SMOOTHING = 0.1
LOG10 = math.log(10)


def vocabulary_path(path: str) -> str:
    """A bare file name is looked up in the installed tokenizer package."""
    if os.path.sep in path:
        return path
    import public_tokenizers
    return public_tokenizers.path(path)


@lru_cache(maxsize=2)
def vocabulary(path: str) -> tuple[list[str | None], list[float], list[int]]:
    """(piece or None, start weight) by id, and the ids of the 256 bytes. Scores
    that can't be log probabilities are ranks, and weigh 1 / (rank + 1)."""
    import sentencepiece
    model = sentencepiece.SentencePieceProcessor(model_file=vocabulary_path(path))
    n = model.get_piece_size()
    scores = [model.get_score(i) for i in range(n)]
    ranks = min(scores) < -100
    pieces, weights, byte_ids = [], [], [0] * 256
    for i in range(n):
        piece = model.id_to_piece(i)
        if model.is_byte(i):
            byte_ids[int(piece[3:5], 16)] = i
        plain = not (model.is_byte(i) or model.is_control(i) or model.is_unknown(i) or model.is_unused(i))
        pieces.append(piece if plain else None)
        weights.append((1 / (1 - scores[i]) if ranks else math.exp(scores[i])) if plain else 1e-6)
    return pieces, weights, byte_ids


class Lattice:
    """The recursions over the segmentations of words. ``logs``: natural log
    probabilities by piece id; the last is that of the end."""

    def __init__(self, path: str, logs: list[float]):
        pieces, _, self.byte_ids = vocabulary(path)
        self.logs = logs
        #: Nodes by character; the entry "" is the piece's id.
        self.root: dict = {}
        for i, piece in enumerate(pieces):
            if piece:
                node = self.root
                for c in piece:
                    node = node.setdefault(c, {})
                node[""] = i
        self._bytes: dict[str, float] = {}

    def spelled(self, c: str) -> float:
        """Log probability of a character's bytes."""
        found = self._bytes.get(c)
        if found is None:
            found = self._bytes[c] = sum(self.logs[self.byte_ids[b]] for b in c.encode("utf-8", "replace"))
        return found

    def edges(self, s: str, at: int):
        """(piece id or -1 for bytes, end) of the edges that start at ``at``."""
        node, end = self.root, at
        if "" not in self.root.get(s[at], ()):
            yield -1, at + 1
        for c in s[at:at + 64]:
            node = node.get(c)
            if node is None:
                return
            end += 1
            if "" in node:
                yield node[""], end

    def forward_long(self, s: str) -> list[float]:
        import array
        logs, out = self.logs, array.array("d", [-math.inf]) * (len(s) + 1)
        out[0] = 0.0
        for i in range(len(s)):
            for piece, j in self.edges(s, i):
                x = out[i] + (logs[piece] if piece >= 0 else self.spelled(s[i]))
                y = out[j]
                out[j] = x if y == -math.inf else max(x, y) + math.log1p(math.exp(-abs(x - y)))
        return out

    def forward(self, words):
        """(word, forward variables) of words in sorted order. The variables of
        the common beginning of two words are kept, with the trie nodes that
        are open at each place; the list given is reused."""
        exp, log, logs = math.exp, math.log, self.logs
        alpha, open_, before = [0.0], [[]], ""
        for word in words:
            s = MARK + word
            if len(s) > LONG:
                yield word, self.forward_long(s)
                continue
            depth, shared = 0, min(len(before), len(s))
            while depth < shared and before[depth] == s[depth]:
                depth += 1
            del alpha[depth + 1:], open_[depth + 1:]
            for j in range(depth, len(s)):
                c, nodes, terms = s[j], [], []
                for i, node in open_[j]:
                    node = node.get(c)
                    if node is not None:
                        nodes.append((i, node))
                        if "" in node:
                            terms.append(alpha[i] + logs[node[""]])
                node = self.root.get(c)
                if node is not None:
                    nodes.append((j, node))
                if node is not None and "" in node:
                    terms.append(alpha[j] + logs[node[""]])
                else:
                    terms.append(alpha[j] + self.spelled(c))
                open_.append(nodes)
                if len(terms) == 1:
                    alpha.append(terms[0])
                else:
                    top = max(terms)
                    alpha.append(top + log(sum([exp(t - top) for t in terms])))
            before = s
            yield word, alpha

    def expect(self, word: str, count: float, alpha: list[float], expected) -> None:
        """Adds the expected uses of pieces in ``count`` words."""
        import array
        exp, logs, s = math.exp, self.logs, MARK + word
        n, total = len(s), alpha[len(s)]
        beta = array.array("d", [0.0]) * (n + 1)
        for i in range(n - 1, -1, -1):
            terms = []
            for piece, j in self.edges(s, i):
                x = (logs[piece] if piece >= 0 else self.spelled(s[i])) + beta[j]
                terms.append(x)
                uses = count * exp(alpha[i] + x - total)
                if piece >= 0:
                    expected[piece] += uses
                else:
                    for b in s[i].encode("utf-8", "replace"):
                        expected[self.byte_ids[b]] += uses
            top = max(terms)
            beta[i] = top if len(terms) == 1 else top + math.log(sum([exp(t - top) for t in terms]))


def words_of(text: str | None) -> list[bytes]:
    """Words between ASCII blanks, A to Z lower-cased."""
    return (text or "").encode("utf-8", "replace").lower().split()


def word_counts(docs: DataFrame) -> DataFrame:
    """(word, c) of all words of ``docs`` (text, held_out): occurrences in
    texts that are not held out."""
    def run(batches):
        from collections import Counter

        import pyarrow as pa

        def told(counts):
            return pa.RecordBatch.from_arrays([pa.array([w.decode() for w in counts], pa.string()),
                                               pa.array(list(counts.values()), pa.int64())], names=["word", "n"])

        counts: Counter = Counter()
        for batch in batches:
            for text, held in zip(batch.column(0), batch.column(1).to_pylist()):
                words = words_of(text.as_py())
                if held:
                    for w in set(words):
                        counts.setdefault(w, 0)
                else:
                    counts.update(words)
                if len(counts) > COUNTED:
                    yield told(counts)
                    counts = Counter()
        if counts:
            yield told(counts)

    return docs.select("text", "held_out").mapInArrow(run, "word string, n long") \
        .groupBy("word").agg(F.sum("n").alias("c"))


def piece_logs(words: DataFrame, ends: int, path: str, rounds: int) -> list[float]:
    """Natural log probabilities of the pieces and, last, of the end."""
    import numpy as np
    _, weights, _ = vocabulary(path)
    start = np.array([*weights, 0.0])
    start[-1] = start.sum() / 200  # texts of some hundred pieces, to begin with
    start /= start.sum()
    p = start
    for _ in range(rounds):
        logs = [float(x) for x in np.log(p)]

        def run(batches, logs=logs):
            import pyarrow as pa
            lattice, expected = Lattice(path, logs), np.zeros(len(logs))
            for batch in batches:
                for c, (word, alpha) in zip(batch.column(1).to_pylist(), lattice.forward(batch.column(0).to_pylist())):
                    lattice.expect(word, c, alpha, expected)
            used = np.flatnonzero(expected)
            yield pa.RecordBatch.from_arrays([pa.array(used, pa.int32()), pa.array(expected[used])], names=["piece", "uses"])

        sums = words.filter("c > 0").mapInArrow(run, "piece int, uses double") \
            .groupBy("piece").agg(F.sum("uses").alias("uses")).collect()  # a row per piece
        uses = np.zeros(len(p))
        for r in sums:
            uses[r["piece"]] = r["uses"]
        uses[-1] = ends
        p = uses + SMOOTHING * len(start) * start
        p /= p.sum()
    return [round(float(x), 12) for x in np.log(p)]


def scored_words(words: DataFrame, logs: list[float], path: str) -> DataFrame:
    """Adds ``lattice``: the log10 marginal probability of each word."""
    def run(batches):
        import pyarrow as pa
        lattice = Lattice(path, logs)
        for batch in batches:
            column = batch.column(0).to_pylist()
            found = [alpha[len(word) + 1] / LOG10 for word, alpha in lattice.forward(column)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(found, pa.float64())],
                                             names=["word", "c", "lattice"])

    return words.mapInArrow(run, "word string, c long, lattice double")


def hot_words(words: DataFrame, limit: int = HOT) -> list[tuple[str, int, float]]:
    """The words used at least so often that there are at most ``limit``."""
    level = F.floor(8 * F.log2(F.col("c"))).cast("int")
    levels = words.filter("c > 0").groupBy(level.alias("l")).count().collect()  # 8 for each power of two
    n, least = 0, None
    for r in sorted(levels, reverse=True):
        if n + r["count"] > limit:
            break
        n, least = n + r["count"], r["l"]
    if least is None:
        return []
    rows = words.filter("c > 0").filter(level >= least).collect()
    return [(r["word"], r["c"], r["lattice"]) for r in rows]


def score(docs: DataFrame, held_out: Column, vocabulary_file: str = DEFAULT_VOCABULARY, rounds: int = ROUNDS,
          hot: int = HOT) -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score)
    of each row of ``docs`` (doc_id, text)."""
    small_batches(docs.sparkSession)
    docs = docs.select("doc_id", "text", F.coalesce(held_out, F.lit(False)).alias("held_out"))
    counts = written(word_counts(docs), "lm-counts")
    words = written(counts.repartitionByRange("word").sortWithinPartitions("word"), "lm-words")
    ends = docs.filter("NOT held_out").count()
    n, v = words.agg(F.coalesce(F.sum("c"), F.lit(0)), F.count_if(F.col("c") > 0)).first()
    n, v = n + ends, v + (ends > 0)
    logs = piece_logs(words, ends, vocabulary_file, rounds)
    words = written(scored_words(words, logs, vocabulary_file), "lm-scores")
    spark = docs.sparkSession
    known = spark.sparkContext.broadcast(sorted(hot_words(words, hot)))  # at most ``hot`` words
    rest = math.log10(n + 0.1 * (v + 1))

    def plain(c: int) -> float:
        return math.log10(c + 0.1) - rest

    def run(batches):
        from collections import Counter

        import numpy as np
        import pyarrow as pa
        number = {w.encode(): i for i, (w, _, _) in enumerate(known.value)}
        base = np.array([plain(c) for _, c, _ in known.value] + [0.0])
        lattice = np.array([x for _, _, x in known.value] + [0.0])
        schema = pa.schema([("uid", pa.int64()), ("doc_id", pa.int64()), ("held_out", pa.bool_()), ("n_tokens", pa.int64()),
                            ("n_known", pa.int64()), ("base_score", pa.float64()), ("score", pa.float64()),
                            ("word", pa.string()), ("times", pa.int64())])
        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                rows = []
                part = batch.slice(at, 500)
                for uid, doc, text, held in zip(*(part.column(i) for i in range(4))):
                    uid, words = uid.as_py(), words_of(text.as_py())
                    ids = np.array([number.get(w, -1) for w in words], "i8")
                    found = int((ids >= 0).sum())
                    rows.append((uid, doc.as_py(), held.as_py(), len(words) + 1, found + (ends > 0),
                                 float(base[ids].sum()) + plain(ends), float(lattice[ids].sum()) + logs[-1] / LOG10, None, None))
                    if found < len(words):
                        other = Counter(w for w, i in zip(words, ids.tolist()) if i < 0)
                        rows += [(uid, None, None, None, None, None, None, w.decode(), k) for w, k in other.items()]
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)

    parts = written(docs.select(F.monotonically_increasing_id().alias("uid"), F.col("doc_id").cast("long").alias("doc_id"), "text", "held_out")
                    .mapInArrow(run, "uid long, doc_id long, held_out boolean, n_tokens long, n_known long, base_score double, "
                                     "score double, word string, times long"), "lm-parts")
    other = parts.filter("word IS NOT NULL").select("uid", "word", "times").join(words, "word").groupBy("uid").agg(
        F.sum(F.when(F.col("c") > 0, F.col("times")).otherwise(0)).alias("known_"),
        F.sum(F.col("times") * (F.log10(F.col("c") + 0.1) - rest)).alias("base_"),
        F.sum(F.col("times") * F.col("lattice")).alias("lattice_"))
    add = lambda a, b: F.col(a) + F.coalesce(F.col(b), F.lit(0))
    return parts.filter("word IS NULL").join(other, "uid", "left").select(
        "doc_id", "held_out", "n_tokens", add("n_known", "known_").alias("n_known"), F.lit(n).cast("long").alias("train_tokens"),
        add("base_score", "base_").alias("base_score"), add("score", "lattice_").alias("score"))


def query(docs: DataFrame) -> DataFrame:
    return score(docs, F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(10)) == 0)
