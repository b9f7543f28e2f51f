"""BPE against the tokenizers library, an exact round trip, edge cases."""

import hashlib
import random
import struct

import pytest

from hourglass.llm import bpe
from llm_edge import EDGE


@pytest.fixture(scope="module")
def library():
    import public_tokenizers
    from tokenizers import Tokenizer
    return Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))


def ids(packed):
    return list(struct.unpack(f"<{len(packed) // 4}I", packed))


def test_every_code_point_is_split_and_encoded_like_the_library(library):
    texts = ["a" + chr(c) + "1" + chr(c) + " " + chr(c) for c in range(0, 0x30000, 7) if not 0xd800 <= c < 0xe000]
    got = [ids(x) for x in bpe.Encoder("byte_bpe_50k.json").pack(texts)]
    assert got == [x.ids for x in library.encode_batch(texts, add_special_tokens=False)]


def test_random_texts_special_tokens_and_a_small_memory(library):
    rng = random.Random(1)
    alphabet = ["a", "the", " the", "ing", " ", "  ", "\n", "\t", "'s", "'", "12", "!", "?!", "é", "中", "\U0001f642", "<|endoftext|>", "\x1c", "\xa0"]
    texts = ["".join(rng.choice(alphabet) for _ in range(rng.randrange(50))) for _ in range(3000)]
    got = list(bpe.Encoder("byte_bpe_50k.json", max_remembered=50).pack(texts))
    want = library.encode_batch(texts, add_special_tokens=False)
    assert [ids(x) for x in got] == [x.ids for x in want]
    vocab = bpe.vocabulary("byte_bpe_50k.json")
    assert [bpe.unpack(vocab, x) for x in got] == library.decode_batch([x.ids for x in want], skip_special_tokens=False)


def test_bytes_that_are_not_utf8_decode_like_the_library(library):
    vocab = bpe.vocabulary("byte_bpe_50k.json")
    rng = random.Random(2)
    some = [[rng.randrange(50257) for _ in range(12)] for _ in range(300)]
    assert [bpe.unpack(vocab, struct.pack(f"<{len(x)}I", *x)) for x in some] == library.decode_batch(some, skip_special_tokens=False)


def test_all_tokens_encode_to_themselves():
    vocab = bpe.vocabulary("byte_bpe_50k.json")
    assert all(vocab.whole(t) for t in vocab.id_of.values())


def test_query_on_edge_rows(frame, library):
    rows = bpe.digests(frame(EDGE)).collect()
    assert len(rows) == len(EDGE)
    want = sorted((i is not None, i, hashlib.sha256((t or "").encode()).hexdigest(), len(library.encode(t or "", add_special_tokens=False).ids))
                  if i is not None else (False, 0, hashlib.sha256(t.encode()).hexdigest(), len(library.encode(t, add_special_tokens=False).ids))
                  for i, t in EDGE)
    assert sorted((r.doc_id is not None, r.doc_id or 0, r.decoded_sha256, r.n_tokens) for r in rows) == want


def test_arrays_packed_and_decode(frame):
    df = frame([(1, "Hello  wörld<|endoftext|>"), (2, None)])
    a = {r.doc_id: r for r in bpe.decode(bpe.encode(df)).collect()}
    b = {r.doc_id: r for r in bpe.decode(bpe.encode(df, packed=True)).collect()}
    assert a[1].decoded_text == b[1].decoded_text == "Hello  wörld<|endoftext|>" and a[2].decoded_text == ""
    assert a[1].token_ids == ids(b[1].token_ids) and a[1].token_ids[-1] == 50256 and a[1].n_tokens == len(a[1].token_ids)
    assert a[1].label == "z"  # other columns stay


def test_empty_table(frame):
    assert bpe.digests(frame([])).collect() == []
