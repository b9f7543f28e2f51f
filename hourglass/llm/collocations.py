"""Phrase collocation mining by marginalising the longest windows (operator 11).

Every word occurrence of a piece opens one window: the word and its one and two
successors in lead columns, padded with '' at the piece's end. Only these longest windows
are counted; a phrase occurs as often as windows begin with it, so ROLLUP over
the window's columns gives the counts of all shorter phrases by summing
prefixes, and no text is read again for them.

Tasks count the windows of about two million words at a time (each chunk with
a dictionary of its own words, so counts are exact) and send sums. Windows meet
by their first word, so that the sums of its pairs are whole where they meet, and
pairs below ``min_count``, of which no phrase comes, go on as their first word
only. A word that begins a ``HOT``-th of all windows is dealt by pairs instead, such
a pair by whole windows; these words and pairs, at most ``HOT`` of each, are counted first.
ROLLUP sums what is left to pairs, words and languages. What remains (phrases
of at least ``min_count``) is joined with the counts of its parts; scores are
exact in decimals of up to 38 digits, for counts below 10^15.

Defined cases: null texts are empty, null ``lang`` is ``und``; empty texts,
texts of separators alone and empty tables give no rows; repeated rows and
equal doc_ids count as often as they stand there; texts are read whole, long
ones in slices cut where pieces end; ties have the contract's order and are
unique, as phrases of a language are distinct; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from hourglass.llm.storage import BATCH_ROWS, batch_rows, written

MIN_COUNT, TOP = 10, 2000
#: Bytes of text gathered before their windows are counted, and windows counted
#: at a time: their words, numbered from 1, take 21 bits.
CHUNK_BYTES, WINDOWS = 12 << 20, (1 << 21) - 8
#: Share of all windows (one in so many) from which the windows of a word or pair are dealt out.
HOT = 20_000
#: Parts of a language's phrases that are ranked by themselves first.
SALTS = 64
#: Partitions of the window sums for each partition of documents.
SPREAD = 8
UNKNOWN = "und"


def _cut(text: bytes, most: int):
    """A long text in slices of about ``most`` bytes that end where pieces end,
    or a single slice where no piece ends."""
    import re
    at = 0
    while len(text) - at > most:
        end = re.compile(rb"[.,;:!?\x0a-\x0d]").search(text, at + most)
        if end is None:
            break
        yield text[at:end.end()]
        at = end.end()
    yield text[at:]


def _tokens(texts: list[bytes]):
    """(words, text number, word begins a piece) of lower-cased texts: words as
    one Arrow array in order."""
    import numpy as np
    import pyarrow as pa
    data = np.frombuffer(b"\n".join(texts), "u1").copy()  # a newline ends a piece
    ends = np.cumsum([len(t) + 1 for t in texts])
    upper = (data >= 65) & (data <= 90)
    data[upper] += 32
    stops = np.isin(data, np.frombuffer(b".,;:!?\n\x0b\x0c\r", "u1"))
    inside = ~(stops | (data == 32) | (data == 9))
    first = np.flatnonzero(inside & ~np.concatenate([[False], inside[:-1]]))
    last = np.flatnonzero(inside & ~np.concatenate([inside[1:], [False]])) + 1
    pieces = np.searchsorted(np.flatnonzero(stops), first)
    fresh = np.concatenate([[True], pieces[1:] != pieces[:-1]])[:len(first)]
    offsets = np.concatenate([[0], np.cumsum(last - first)]).astype("i4")
    words = pa.StringArray.from_buffers(len(first), pa.py_buffer(offsets.tobytes()), pa.py_buffer(data[inside].tobytes()))
    return words, np.searchsorted(ends, first, side="right"), fresh


def _blocks(texts: list[bytes], langs: list[str]):
    """(language, vocabulary, windows) of the texts in blocks of ``WINDOWS``: all
    windows of a language, each as three 21-bit numbers of words in the vocabulary."""
    import numpy as np
    import pyarrow as pa
    words, text, fresh = _tokens(texts)
    names = list(dict.fromkeys(langs))
    numbers = {x: i for i, x in enumerate(names)}
    lang = np.array([numbers[x] for x in langs])[text]
    n = len(words)
    for lo in range(0, n, WINDOWS):
        size = min(n, lo + WINDOWS) - lo
        part = words.slice(lo, size + 2).dictionary_encode()
        code = np.concatenate([part.indices.to_numpy(zero_copy_only=False).astype("i8") + 1, [0, 0]])  # under 2^21; 0 pads
        begins = np.concatenate([fresh[lo:lo + size + 2], [True, True]])
        second = np.where(begins[1:size + 1], 0, code[1:size + 1])
        third = np.where(begins[1:size + 1] | begins[2:size + 2], 0, code[2:size + 2])
        packed = (code[:size] << 42) | (second << 21) | third
        vocabulary = pa.concat_arrays([pa.array([""]), part.dictionary.cast(pa.string())])
        for number in np.unique(lang[lo:lo + size]):
            yield names[number], vocabulary, packed[lang[lo:lo + size] == number]


def _joined(lang: str, vocabulary, packed, words: int):
    """The leading words of packed windows as strings, the language and a newline
    before them."""
    import pyarrow as pa
    import pyarrow.compute as pc
    columns = [vocabulary.take(pa.array((packed >> shift) & 0x1FFFFF)) for shift in (42, 21, 0)[:words]]
    return pc.binary_join_element_wise(lang, pc.binary_join_element_wise(*columns, " ") if words > 1 else columns[0], "\n")


def _chunks(batches, make):
    """What ``make`` yields of the blocks of (lang, text) batches, gathered to
    chunks of texts."""
    texts, langs, held = [], [], 0
    for batch in batches:
        for lang, text in zip(batch.column(0).to_pylist(), batch.column(1)):
            for part in _cut(bytes(text.as_buffer()), CHUNK_BYTES):
                texts.append(part)
                langs.append(lang)
                held += len(part) + 1
                if held >= CHUNK_BYTES:
                    for block in _blocks(texts, langs):
                        yield from make(*block)
                    texts, langs, held = [], [], 0
    for block in _blocks(texts, langs) if texts else ():
        yield from make(*block)


def _texts(docs: DataFrame) -> DataFrame:
    return docs.select(F.coalesce(F.col("lang"), F.lit(UNKNOWN)).alias("lang"), "text").filter("text IS NOT NULL AND text <> ''")


def hot_beginnings(docs: DataFrame, hot: int) -> tuple[frozenset, frozenset]:
    """Words and pairs (with their language) that begin about a ``hot``-th of all
    windows or more: at most ``hot`` of each."""
    def often(lang, vocabulary, packed):
        import numpy as np
        import pyarrow as pa
        yield pa.RecordBatch.from_arrays([pa.array([0], pa.int32()), pa.array([""]), pa.array([len(packed)], pa.int64())], names=["words", "p", "c"])
        for words, shift in ((1, 42), (2, 21)):
            found, times = np.unique(packed >> shift, return_counts=True)
            many = times * hot >= len(packed)
            if words == 2:
                many &= (found & 0x1FFFFF) > 0
            yield pa.RecordBatch.from_arrays([pa.array(np.full(many.sum(), words), pa.int32()), _joined(lang, vocabulary, found[many] << shift, words),
                                              pa.array(times[many], pa.int64())], names=["words", "p", "c"])

    sums = written(_texts(docs).mapInArrow(lambda batches: _chunks(batches, often), "words int, p string, c long")
                   .groupBy("words", "p").agg(F.sum("c").alias("c")), "phrase-hot")
    total = sums.filter("words = 0").agg(F.sum("c")).first()[0] or 0
    rows = sums.filter(f"words > 0 AND c * {hot} >= {total}").select("words", "p").collect()
    return tuple(frozenset(r["p"] for r in rows if r["words"] == words) for words in (1, 2))


def windows(docs: DataFrame, hot: tuple[frozenset, frozenset]) -> DataFrame:
    """(level, window, c) of ``docs`` (lang, text): sums of longest windows, one row
    or more for each distinct one; ``level`` 1 if its first word is hot, 2 if its pair
    is, else 0. A window is one string, its language and a newline before the
    words, which hold none; as one column it takes half the shuffle."""
    def sums(lang, vocabulary, packed):
        import numpy as np
        import pyarrow as pa
        import pyarrow.compute as pc
        seen, times = np.unique(packed, return_counts=True)
        hot_words, hot_pairs = (pa.array(sorted(x), pa.string()) for x in hot)
        for at in range(0, len(seen), 1 << 16):
            some = seen[at:at + (1 << 16)]
            level = np.zeros(len(some), "i4")
            for words, shift, known in ((1, 42, hot_words), (2, 21, hot_pairs)):
                begin, where = np.unique(some >> shift, return_inverse=True)
                is_hot = pc.is_in(_joined(lang, vocabulary, begin << shift, words), known).to_numpy(zero_copy_only=False)
                level[is_hot[where]] = words
            yield pa.RecordBatch.from_arrays([pa.array(level), _joined(lang, vocabulary, some, 3), pa.array(times[at:at + (1 << 16)], pa.int64())],
                                             names=["level", "window", "c"])

    return _texts(docs).mapInArrow(lambda batches: _chunks(batches, sums), "level int, window string, c long")


def phrase_counts(docs: DataFrame, min_count: int = MIN_COUNT, hot: int = HOT) -> DataFrame:
    """(words, lang, w1, w2, w3, f): words 0 being the total of each language, for
    1 to 3 the phrases that occur at least ``min_count`` times, unused
    columns null."""
    tasks = max(1, SPREAD * docs._jdf.queryExecution().toRdd().getNumPartitions())
    found = windows(docs, hot_beginnings(docs, hot)) \
        .withColumn("place", F.expr(f"cast(pmod(xxhash64(substring_index(window, ' ', level + 1)), {tasks}) AS int)"))
    longest = found.repartitionById(tasks, "place").groupBy("place", "level", "window").agg(F.sum("c").alias("c")) \
        .withColumn("p", F.substring_index("window", "\n", -1)) \
        .selectExpr("place", "level", "left(window, length(window) - length(p) - 1) AS lang", "split(p, ' ') AS w", "c")
    # A frequent window is a phrase, and part of its pair; other windows only that.
    pairs = longest.selectExpr("place", "level", "lang", "w[0] AS w1", "w[1] AS w2",
                               f"explode(if(c >= {min_count} AND w[2] <> '', array(w[2], cast(null AS string)), array(cast(null AS string)))) AS w3", "c") \
        .groupBy("place", "level", "lang", "w1", "w2", "w3").agg(F.sum("c").alias("c")) \
        .withColumn("w2", F.when(F.col("level") == 2, F.col("w2")).when(F.col("c") >= min_count, F.col("w2")).otherwise("")) \
        .groupBy("place", "lang", "w1", "w2", "w3").agg(F.sum("c").alias("c")).drop("place")
    known = written(pairs, "phrase-windows")
    shorter = docs.sparkSession.sql("""
        SELECT 2 - bit_count(grouping_id()) AS words, lang, w1, w2, CAST(NULL AS string) AS w3, sum(c) AS f
        FROM {known} WHERE w3 IS NULL GROUP BY lang, ROLLUP (w1, w2)""", known=known)
    frequent = known.filter("w3 IS NOT NULL").selectExpr("3 AS words", "lang", "w1", "w2", "w3", "c AS f")
    return shorter.filter(f"words = 0 OR (f >= {min_count} AND coalesce(w2, 'x') <> '')").union(frequent)


def collocations(docs: DataFrame, min_count: int = MIN_COUNT, top: int = TOP) -> DataFrame:
    """Each language's ``top`` phrases of two or three words with the counts of
    the lowest-scoring cut."""
    with batch_rows(docs.sparkSession, BATCH_ROWS):
        counts = written(phrase_counts(docs, min_count), "phrase-counts")
    total = counts.filter("words = 0").select("lang", F.col("f").alias("n"))
    one = counts.filter("words = 1").select("lang", "w1", "f")
    two = counts.filter("words = 2").select("lang", "w1", "w2", F.col("f").alias("a"))
    three = counts.filter("words = 3").select("lang", "w1", "w2", "w3", F.col("f").alias("a"))
    first = one.withColumnRenamed("f", "l1")

    def last(of: str) -> DataFrame:
        return one.select("lang", F.col("w1").alias(of), F.col("f").alias("r1"))

    def score(l: str, r: str) -> str:  # noqa: E741
        d = lambda c: f"cast({c} AS decimal(15,0))"
        return f"cast(cast(1000000 AS decimal(7,0)) * ({d('a')} * {d('a')}) div ({d(l)} * {d(r)}) AS long)"

    inside = three.select("lang", "a", F.explode(F.array(F.struct("w1", "w2"), F.struct(F.col("w2").alias("w1"), F.col("w3").alias("w2")))).alias("p")) \
        .groupBy("lang", F.col("p.w1").alias("w1"), F.col("p.w2").alias("w2")).agg(F.max("a").alias("longer"))
    pairs = two.join(inside, ["lang", "w1", "w2"], "left").filter("longer IS NULL OR 100 * longer < 50 * a") \
        .join(first, ["lang", "w1"]).join(last("w2"), ["lang", "w2"]) \
        .selectExpr("lang", "concat(w1, ' ', w2) AS phrase", "a", "l1 AS l", "r1 AS r", f"{score('l1', 'r1')} AS score")
    heads = two.select("lang", "w1", "w2", F.col("a").alias("l2"))
    tails = two.select("lang", F.col("w1").alias("w2"), F.col("w2").alias("w3"), F.col("a").alias("r2"))
    triples = three.join(first, ["lang", "w1"]).join(tails, ["lang", "w2", "w3"]).join(heads, ["lang", "w1", "w2"]).join(last("w3"), ["lang", "w3"]) \
        .selectExpr("lang", "concat(w1, ' ', w2, ' ', w3) AS phrase", "a", "l1", "r2", "l2", "r1", f"{score('l1', 'r2')} AS s1", f"{score('l2', 'r1')} AS s2") \
        .selectExpr("lang", "phrase", "a", "if(s1 <= s2, l1, l2) AS l", "if(s1 <= s2, r2, r1) AS r", "least(s1, s2) AS score")
    order = [F.desc("score"), F.desc("a"), F.col("phrase")]
    # First among a ``SALTS``-th of a language's phrases, then among those that are left.
    some = W.partitionBy("lang", F.pmod(F.xxhash64("phrase"), F.lit(SALTS))).orderBy(*order)
    left = pairs.union(triples).withColumn("_rank", F.row_number().over(some)).filter(F.col("_rank") <= top).drop("_rank")
    return left.withColumn("rank", F.row_number().over(W.partitionBy("lang").orderBy(*order))).filter(F.col("rank") <= top) \
        .join(total, "lang").select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")


def query(docs: DataFrame) -> DataFrame:
    return collocations(docs)


ORACLE_SQL = rf"""
WITH pieces AS (
  SELECT coalesce(lang, '{UNKNOWN}') AS lang,
         unnest(regexp_split_to_array(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece
  FROM documents WHERE text IS NOT NULL),
words AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM pieces),
grams AS (
  SELECT lang, k, unnest(list_transform(range(1, len(w) - k + 2), lambda i: array_to_string(w[i:i + k - 1], ' '))) AS phrase
  FROM words, (VALUES (1), (2), (3)) AS ks(k)),
f AS (SELECT lang, k, phrase, count(*) AS a FROM grams GROUP BY ALL),
total AS (SELECT lang, CAST(sum(a) AS BIGINT) AS n FROM f WHERE k = 1 GROUP BY lang),
candidates AS (SELECT lang, k, phrase, string_split(phrase, ' ') AS w, a FROM f WHERE k > 1 AND a >= {MIN_COUNT}),
places AS (
  SELECT lang, phrase, a, cut, array_to_string(w[1:cut], ' ') AS head, array_to_string(w[cut + 1:k], ' ') AS tail
  FROM (SELECT *, unnest(range(1, k)) AS cut FROM candidates)),
cuts AS (
  SELECT p.lang, p.phrase, p.a, cut, x.a AS l, y.a AS r,
         CAST((CAST(1000000 AS HUGEINT) * p.a * p.a) // (CAST(x.a AS HUGEINT) * y.a) AS BIGINT) AS score
  FROM places p JOIN f x ON x.lang = p.lang AND x.phrase = head JOIN f y ON y.lang = p.lang AND y.phrase = tail),
lowest AS (SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) = 1),
within AS (
  SELECT lang, phrase, max(a) AS longer FROM (
    SELECT lang, w[1] || ' ' || w[2] AS phrase, a FROM candidates WHERE k = 3
    UNION ALL SELECT lang, w[2] || ' ' || w[3], a FROM candidates WHERE k = 3) GROUP BY ALL),
ranked AS (
  SELECT lang, phrase, a, l, r, score, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank
  FROM lowest l LEFT JOIN within i USING (lang, phrase) WHERE longer IS NULL OR 100 * longer < 50 * a)
SELECT lang, CAST(rank AS BIGINT) AS rank, phrase, a, l, r, n, score FROM ranked JOIN total USING (lang) WHERE rank <= {TOP}
"""
