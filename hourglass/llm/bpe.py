"""BPE encoding and decoding by prefix-sharing trie traversal (operator 3).

``encode`` gives, for a text column, exactly the ids of byte-level BPE over a
published vocabulary file: the text is cut at special tokens, then into words
by the vocabulary's word pattern, and each *distinct* word is encoded once.

Words are encoded without running merges. Two facts about rank-ordered merges
are used: a token sequence is the encoding of its bytes exactly when every
adjacent pair of tokens keeps its boundary, and so each prefix of a word has
exactly one possible last token. ``PrefixTrie`` walks the trie of the batch's
distinct words depth first. A node stands for a prefix; its state is the
longest suffix that begins some vocabulary token, and its last token is the
one suffix token whose boundary with the last token of the remaining prefix
holds. States and last tokens of a prefix are computed once for all words
that share it; following last tokens backwards from a word's node gives its
ids.

Everything is map-only: each task keeps the tokens of words it has met in a
dictionary of bounded size, so no text is shuffled and memory does not grow
with the input. A lost executor only repeats its own tasks.

Defined cases: null text counts as empty; an empty text has no ids and decodes
to the empty string; texts of any length are encoded whole; repeated rows give
repeated results; empty tables give empty results; input columns named
like an output column are replaced by it; any other column is kept as it is.
"""

from __future__ import annotations

import json
import os
from array import array
from collections.abc import Iterator
from functools import lru_cache

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hourglass.llm.storage import small_batches

DEFAULT_VOCABULARY = "byte_bpe_50k.json"
#: Words whose ids a task remembers at most; then it starts anew.
MAX_REMEMBERED = 200_000
#: Characters of the pattern's white space (Unicode White_Space).
SPACE = "\\t-\\r \\x85\\xa0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000"
# Fixed value: the word pattern of the vocabulary, with white space spelled out.
WORD = (rf"'s|'t|'re|'ve|'m|'ll|'d| ?\p{{L}}+| ?\p{{N}}+| ?[^{SPACE}\p{{L}}\p{{N}}]+"
        rf"|[{SPACE}]+(?![^{SPACE}])|[{SPACE}]+")
NEVER = 1 << 60


def vocabulary_path(path: str) -> str:
    """A bare file name is looked up in the installed tokenizer package."""
    if os.path.sep in path:
        return path
    import public_tokenizers
    return public_tokenizers.path(path)


def byte_letters() -> dict[str, int]:
    """The letter that stands for each byte in byte-level vocabularies:
    visible Latin-1 characters stand for themselves, the others follow
    from code point 256 on."""
    visible = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 255 and b != 173]
    hidden = [b for b in range(256) if b not in set(visible)]
    return {chr(b): b for b in visible} | {chr(256 + i): b for i, b in enumerate(hidden)}


class State:
    """What a prefix may end with: ``ends`` are the tokens that are suffixes of
    it with their lengths, longest first; ``after`` are the next states met.
    States are beginnings of tokens, so there are no more than those."""

    __slots__ = ("suffix", "ends", "after")

    def __init__(self, suffix: bytes, ends: list[tuple[int, int]]):
        self.suffix, self.ends, self.after = suffix, ends, {}


class Vocabulary:
    """Tokens as bytes, merges by rank, and what the trie walk asks of them."""

    def __init__(self, path: str):
        with open(vocabulary_path(path), encoding="utf-8") as f:
            spec = json.load(f)
        letters = byte_letters()
        spell = lambda s: bytes(letters[c] for c in s)
        ids = spec["model"]["vocab"]
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"] if t["special"]}
        self.id_of = {spell(s): i for s, i in ids.items() if s not in self.special}
        self.bytes_of = {i: b for b, i in self.id_of.items()}
        self.bytes_of |= {i: s.encode() for s, i in self.special.items()}
        self.rank: dict[tuple[int, int], int] = {}
        #: For a token: rank of the merge that makes it (-1: a byte) and its parts.
        self.made = dict.fromkeys(self.bytes_of, -1)
        self.parts: dict[int, tuple[int, int]] = {}
        for r, m in enumerate(spec["model"]["merges"]):
            a, b = (ids[x] for x in (m.split(" ") if isinstance(m, str) else m))
            self.rank[a, b] = r
            whole = self.id_of[self.bytes_of[a] + self.bytes_of[b]]
            if whole not in self.parts:
                self.parts[whole], self.made[whole] = (a, b), r
        self.beginnings = {b[:k] for b in self.id_of for k in range(1, len(b) + 1)}
        #: Answers of boundary_holds so far, by left << 32 | right.
        self.borders: dict[int, bool] = {}
        self._states: dict[bytes, State] = {}

    def boundary_holds(self, left: int, right: int) -> bool:
        """Whether merging the joined bytes of two tokens leaves both as they
        are. Walks back in time: whichever side's border token was formed
        last is undone, and at each moment the pair across the border must
        not have been merged before either of them was used up. Of equal
        ranks the left one goes first."""
        x, y, x_used, y_used = left, right, NEVER, NEVER
        holds = None
        while holds is None:
            r = self.rank.get((x, y))
            if r is not None and r < x_used and r <= y_used:
                holds = False
            elif self.made[x] < 0 and self.made[y] < 0:
                holds = True
            elif self.made[x] > self.made[y]:
                x_used, x = self.made[x], self.parts[x][1]
            else:
                y_used, y = self.made[y], self.parts[y][0]
        if len(self.borders) > 250_000:
            self.borders.clear()
        self.borders[left << 32 | right] = holds
        return holds

    def whole(self, token: int) -> bool:
        """Whether merging a token's own bytes gives the token."""
        if self.made[token] < 0:
            return True
        a, b = self.parts[token]
        x, y, limit = a, b, self.made[token]
        x_used = y_used = limit
        while self.made[x] >= 0 or self.made[y] >= 0:
            if self.made[x] > self.made[y]:
                x_used, x = self.made[x], self.parts[x][1]
            else:
                y_used, y = self.made[y], self.parts[y][0]
            r = self.rank.get((x, y))
            if r is not None and r < x_used and r <= y_used:
                return False
        return self.whole(a) and self.whole(b)

    def state(self, suffix: bytes) -> State:
        """The state of a prefix whose longest suffix that begins a token is
        ``suffix``."""
        found = self._states.get(suffix)
        if found is None:
            ends = [(self.id_of[suffix[k:]], len(suffix) - k) for k in range(len(suffix)) if suffix[k:] in self.id_of]
            found = self._states[suffix] = State(suffix, [x for x in ends if self.whole(x[0])])
        return found

    def step(self, state: State, byte: int) -> State:
        """The state after one more byte."""
        to = state.suffix + bytes((byte,))
        while to not in self.beginnings:
            to = to[1:]
        found = state.after[byte] = self.state(to)
        return found


@lru_cache(maxsize=2)
def vocabulary(path: str) -> Vocabulary:
    return Vocabulary(path)


class PrefixTrie:
    """The trie of inserted words, walked depth first.

    Sorting puts the words in the order of that walk, so the trie needs no
    node objects: the stacks below are the path from the root to the current
    node, and each word goes on from the deepest node it shares with the
    word before it."""

    def __init__(self, vocab: Vocabulary):
        self.vocab = vocab
        self.words: list[bytes] = []

    def insert(self, words) -> None:
        self.words.extend(words)

    def encodings(self) -> Iterator[tuple[bytes, list[int]]]:
        step, answer, ask = self.vocab.step, self.vocab.borders.get, self.vocab.boundary_holds
        states: list[State] = [self.vocab.state(b"")]
        last: list[int] = [-1]          # last token of the prefix of this depth
        length: list[int] = [0]         # its length
        before = b""
        for word in sorted(set(self.words)):
            depth, shared = 0, min(len(before), len(word))
            while depth < shared and before[depth] == word[depth]:
                depth += 1
            del states[depth + 1:], last[depth + 1:], length[depth + 1:]
            state = states[depth]
            for d in range(depth, len(word)):
                byte = word[d]
                state = state.after.get(byte) or step(state, byte)
                for token, n in state.ends:
                    left = last[d + 1 - n]
                    if left < 0:
                        break
                    holds = answer(left << 32 | token)
                    if holds or holds is None and ask(left, token):
                        break
                else:
                    raise ValueError(f"no token ends {word[:d + 1]!r}")
                states.append(state)
                last.append(token)
                length.append(n)
            before, ids, d = word, [], len(word)
            while d:
                ids.append(last[d])
                d -= length[d]
            ids.reverse()
            yield word, ids


class Encoder:
    """Encodes texts in batches; remembers a bounded number of words."""

    def __init__(self, path: str, max_remembered: int = MAX_REMEMBERED):
        import regex
        self.vocab = vocabulary(path)
        self.find = regex.compile(WORD).findall
        self.cut = regex.compile("(" + "|".join(map(regex.escape, self.vocab.special)) + ")").split \
            if self.vocab.special else None
        self.max_remembered = max_remembered
        self.known: dict[str, bytes] = {}
        self.special = {s: i.to_bytes(4, "little") for s, i in self.vocab.special.items()}

    def words(self, text: str) -> list[str]:
        if self.cut is None or not any(s in text for s in self.special):
            return self.find(text)
        out: list[str] = []
        for k, piece in enumerate(self.cut(text)):
            out.extend([piece] if k % 2 else self.find(piece))
        return out

    def pack(self, texts) -> Iterator[bytes]:
        """The ids of each text as little-endian unsigned 32-bit integers."""
        size, group = 0, []
        for text in texts:
            found = self.words(text or "")
            group.append(found)
            size += len(found)
            if size > 250_000:
                yield from self._group(group)
                size, group = 0, []
        yield from self._group(group)

    def _group(self, group: list[list[str]]) -> Iterator[bytes]:
        met = set().union(*group)
        fresh = met - self.known.keys()
        if len(self.known) + len(fresh) > self.max_remembered:  # keep what is in use now
            self.known = {w: self.known[w] for w in met - fresh}
        special = fresh & self.special.keys()
        trie = PrefixTrie(self.vocab)
        by_bytes = {w.encode("utf-8", "surrogatepass"): w for w in fresh - special}
        trie.insert(by_bytes)
        for word, ids in trie.encodings():
            self.known[by_bytes[word]] = array("I", ids).tobytes()
        for s in special:
            self.known[s] = self.special[s]
        get = self.known.__getitem__
        for found in group:
            yield b"".join(map(get, found))


@lru_cache(maxsize=2)
def encoder(path: str, max_remembered: int) -> Encoder:
    """One for each Python worker, so that its later tasks know the words of earlier ones."""
    return Encoder(path, max_remembered)


def unpack(vocab: Vocabulary, packed: bytes) -> str:
    """The text of packed ids; bytes that aren't UTF-8 become U+FFFD."""
    import numpy as np
    return b"".join(map(vocab.bytes_of.__getitem__, np.frombuffer(packed, "<u4").tolist())).decode("utf-8", "replace")


def _mapped(df: DataFrame, fields: list[T.StructField], make) -> DataFrame:
    """``df`` with new columns that ``make()(batch) -> list of arrays`` gives."""
    names = {f.name for f in fields}
    keep = [f for f in df.schema.fields if f.name not in names]

    def run(batches):
        import pyarrow as pa
        work = make()
        for batch in batches:
            arrays = [batch.column(batch.schema.get_field_index(f.name)) for f in keep]
            yield pa.RecordBatch.from_arrays(arrays + work(batch), names=[f.name for f in keep + fields])

    small_batches(df.sparkSession)
    return df.mapInArrow(run, T.StructType(keep + fields))


def encode(df: DataFrame, text_col: str = "text", vocabulary_file: str = DEFAULT_VOCABULARY,
           packed: bool = False, decoded: bool = False, max_remembered: int = MAX_REMEMBERED) -> DataFrame:
    """Adds ``n_tokens`` (long) and ``token_ids`` — an int array, or with
    ``packed`` a binary of little-endian unsigned 32-bit integers — and with
    ``decoded`` the text decoded from those ids as ``decoded_text``."""
    fields = [T.StructField("n_tokens", T.LongType()),
              T.StructField("token_ids", T.BinaryType() if packed else T.ArrayType(T.IntegerType()))]
    if decoded:
        fields.append(T.StructField("decoded_text", T.StringType()))

    def make():
        import numpy as np
        import pyarrow as pa
        enc = encoder(vocabulary_file, max_remembered)

        def work(batch):
            texts = batch.column(batch.schema.get_field_index(text_col))
            ids = list(enc.pack(t.as_py() for t in texts))
            sizes = np.array([len(x) // 4 for x in ids], "i8")
            if packed:
                column = pa.array(ids, pa.binary())
            else:
                ends = np.concatenate([[0], sizes.cumsum()]).astype("i4")
                column = pa.ListArray.from_arrays(pa.array(ends), pa.array(np.frombuffer(b"".join(ids), "<i4")))
            out = [pa.array(sizes), column]
            if decoded:
                out.append(pa.array([unpack(enc.vocab, x) for x in ids], pa.string()))
            return out

        return work

    return _mapped(df, fields, make)


def decode(df: DataFrame, ids_col: str = "token_ids", vocabulary_file: str = DEFAULT_VOCABULARY) -> DataFrame:
    """Adds ``decoded_text`` for a column of ids (int array or packed binary);
    null ids decode to the empty text."""

    def make():
        import numpy as np
        import pyarrow as pa
        vocab = vocabulary(vocabulary_file)

        def one(x):
            x = x.as_py() or b""
            return unpack(vocab, x if isinstance(x, bytes) else np.array(x, "<u4").tobytes())

        return lambda batch: [pa.array([one(x) for x in batch.column(batch.schema.get_field_index(ids_col))],
                                       pa.string())]

    return _mapped(df, [T.StructField("decoded_text", T.StringType())], make)


def digests(docs: DataFrame, vocabulary_file: str = DEFAULT_VOCABULARY) -> DataFrame:
    """Round trip of every text, as token count and SHA-256 of ids and of the
    decoded text."""
    done = encode(docs.select("doc_id", "text"), vocabulary_file=vocabulary_file, packed=True, decoded=True)
    return done.select("doc_id", "n_tokens", F.sha2("token_ids", 256).alias("ids_sha256"),
                       F.sha2(F.col("decoded_text").cast("binary"), 256).alias("decoded_sha256"))
