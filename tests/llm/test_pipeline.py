"""The pipeline against brute force, on its own input at each stage."""

import random
import re

import corpus_pipeline as P
from hourglass.llm import bpe, pii
from hourglass.llm.storage import written
from llm_edge import EDGE
from test_pairs import corpus, groups
from test_pii import brute


def test_stages_on_edge_rows(spark, frame):
    words = "der die das und ist haus see wald berg tal".split()
    rows = [(1000 + i, " ".join([words[(i * k) % 10] for k in range(1, 40)]) + f" nummer {i} mail x{i}@y.com", "de", f"src{i % 5}") for i in range(60)] \
        + [(2000 + i, f"the quick brown fox {i} jumps over the lazy dog and runs {i * i} miles to town", "en", f"src{i % 5}") for i in range(60)] \
        + [(3000 + i, t, "en", "src1") for i, t in corpus(4)] + [(i, t, None, None) for i, t in EDGE]
    docs = frame(rows)
    for name, stage in P.STAGES:
        before = [tuple(r) for r in docs.select("doc_id", "text").collect()]
        docs = written(stage(spark, docs, ""), f"test-{name}")
        after = docs.collect()
        if name != "tokens":
            assert docs.columns == P.COLUMNS
        ids = [r.doc_id for r in after]
        if name == "language_id":
            assert {i for i, t in before if t and re.search(r"[^\W\d_]", t)} == set(ids) and not {1, 2, 3} & set(ids)
        elif name == "near_duplicates":
            want = groups(before)
            assert sorted(i for i in ids if i is not None) == sorted(set(want.values())) and ids.count(None) == 1
        elif name == "personal_data":
            assert len(ids) == len(before) and not any(brute(r.text) for r in after) and all(r.n_chars == len(r.text) for r in after)
            assert sum("[EMAIL]" in r.text for r in after) >= 50
        elif name == "mixture":
            assert set(ids) <= {i for i, _ in before} and len(ids) >= 0.6 * len(before)
    vocab = bpe.vocabulary(bpe.DEFAULT_VOCABULARY)
    texts = {(i, t) for i, t in before}
    assert all((r.doc_id, b"".join(vocab.bytes_of[x] for x in r.token_ids).decode()) in texts and r.n_tokens == len(r.token_ids) for r in after)


def test_different_texts_under_one_id_are_documents_of_their_own(spark, frame):
    base = [f"w{i}" for i in range(40)]
    near = " ".join([*base[:-1], "x"])
    alone = "one text that stands alone here and has words of its own in it"
    other = "another text under that id which nobody else has and which must not go"
    rows = [(1, " ".join(base), "en", "a"), (7, near, "en", "a"), (7, other, "en", "b"),     # one of 7's texts is linked
            (8, alone, "en", "b"), (8, alone[::-1], "en", "a"), (8, alone, "en", "a"),     # none of 8's is; one row twice
            (9, None, "en", "a"), (9, "", "en", "a"), (9, None, "de", "a"), (None, alone, "en", "z")]
    for order in (rows, rows[::-1]):
        got = P.near_duplicates(spark, frame(order).repartition(3), "").collect()
        assert sorted(((r.doc_id, r.text, r.lang, r.source) for r in got), key=str) == sorted([
            (1, " ".join(base), "en", "a"), (7, other, "en", "b"), (8, alone, "en", "a"), (8, alone[::-1], "en", "a"),
            (9, None, "de", "a"), (9, "", "en", "a"), (None, alone, "en", "z")], key=str)


def shuffled_bytes(df):
    """Bytes of the rows that the plan of ``df`` has dealt out, after it ran."""
    total, todo, seen = 0, [df._jdf.queryExecution().executedPlan()], set()
    while todo:
        node = todo.pop()
        kind = node.getClass().getSimpleName()
        if kind == "AdaptiveSparkPlanExec":
            todo.append(node.executedPlan())
        elif kind.endswith("QueryStageExec"):
            todo.append(node.plan())
        if kind == "ShuffleExchangeExec" and node.id() not in seen:
            seen.add(node.id())
            total += node.metrics().apply("dataSize").value()
        todo += [node.children().apply(i) for i in range(node.children().size())]
    return total


def test_texts_that_stay_are_not_dealt_out(spark, frame):
    """At the end only texts of ids that go or stand more than once meet those ids."""
    rng = random.Random(8)
    rows = [(i, " ".join(f"w{rng.randrange(10 ** 6)}" for _ in range(300)), "en", "a") for i in range(300)]
    rows += [(1000 + i, rows[i][1] + " end", "en", "b") for i in range(10)] + rows[20:25]      # near copies; rows that stand twice
    size = sum(len(r[1]) for r in rows)
    df = P.near_duplicates(spark, frame(rows), "")
    assert sorted(r.doc_id for r in df.collect()) == list(range(300))
    assert 0 < shuffled_bytes(df) < size / 3


def test_work_on_a_batch_needs_little_memory(spark):
    """Of texts of 1 MB altogether, hashed or counted by slices."""
    import tracemalloc

    import pyarrow as pa

    from hourglass.llm import language, shingles
    rng = random.Random(9)
    texts = [" ".join(f"w{rng.randrange(10 ** 6)}" for _ in range(260)) for _ in range(500)]
    column = pa.array(texts)
    for work, most in ((lambda: shingles.shingle_sets(column), 17e6), (lambda: language.features(texts), 30e6)):
        work()
        tracemalloc.start()
        work()
        peak = tracemalloc.get_traced_memory()[1]
        tracemalloc.stop()
        assert peak < most


def test_slices_of_any_size_give_the_same_shingles(monkeypatch):
    import pyarrow as pa

    from hourglass.llm import language, shingles
    rng = random.Random(10)
    texts = [t for _, t in EDGE] + [None, "", "x" * 5000 + " a b", "y " * 900 + "z" * 700, " " * 800 + "q"] \
        + ["".join(rng.choice("aB é\t\n字") for _ in range(rng.randrange(400))) for _ in range(60)]
    whole, counts = shingles.shingle_sets(pa.array(texts)), language.features(texts)
    for size in (16, 100, 1000):
        monkeypatch.setattr(shingles, "HASHED", size)
        monkeypatch.setattr(language, "SLICE", size)
        monkeypatch.setattr(language, "TEXTS", 1 + size // 50)
        assert all((a == b).all() for a, b in zip(shingles.shingle_sets(pa.array(texts)), whole))
        assert (language.features(texts) == counts).all()


WORDS = {
    "de": "der die das und ist nicht haus wald auf mit einem wir gehen schnee", "en": "the and is not house forest on with we walk through snow this which",
    "nl": "het een en niet huis bos wij lopen door sneeuw naar zijn deze voor", "sv": "och inte huset skogen med vi genom detta som till hade vintern",
    "es": "el los una y no casa bosque con nosotros nieve hacia esta por", "fr": "le les une et pas maison avec nous dans neige vers cette pour",
    "pl": "nie jest dom las przez my idziemy do ten oraz kiedy zima", "fi": "ei ole talo metsä me kävelemme läpi tämä kun talvi ja",
    "tr": "ve bir değil ev orman biz yürüyoruz bu için kar kış ile", "hi": "और नहीं घर जंगल हम बर्फ यह के लिए साथ", "zh": "和 不 房子 森林 我们 走 雪 这个 冬天 一起",
    "xx": "qua zzu bxi wopq vvyx kjq zxo qwy"}


def test_languages_of_many_families_are_kept(spark, frame):
    """Twelve languages in eight families, four of them in one: clean texts stay, whatever their number."""
    rng = random.Random(6)
    rows = [(100 * k + i, " ".join(rng.choice(words.split()) for _ in range(30)), lang) for k, (lang, words) in enumerate(WORDS.items(), 1)
            for i in range(60)]
    kept = {r.doc_id: r.lang for r in P.language_id(spark, frame(rows), "").collect()}
    assert kept == {i: lang for i, _, lang in rows}


def test_run_equals_its_stages_and_empty_tables(spark, frame):
    assert P.run(spark, "/root/testdata/sf0.001").columns == ["doc_id", "lang", "source", "n_tokens", "token_ids"]
    docs = frame([], extra=False)
    for name, stage in P.STAGES:
        docs = written(stage(spark, docs, ""), f"test-empty-{name}")
        assert docs.count() == 0
    assert pii.KINDS == ["email", "ip", "card", "phone"]
