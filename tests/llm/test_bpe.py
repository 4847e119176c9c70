import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from strata.llm.bpe import ByteBpe, decode, encode

FILE = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def known():
    return Tokenizer.from_file(FILE), ByteBpe(open(FILE, encoding="utf-8").read())


def test_random_texts_encode_and_decode_as_the_library_does(known):
    library, own = known
    random.seed(4)
    letters = [chr(i) for i in [*range(0x250), *range(0x2000, 0x2070), 0x3000, 0x4E00, 0x1F600, 0xFEFF, 0x1680, 0x300, 0x661, 0xB2]]
    for k in range(3000):
        pool, most = (letters, 30) if k % 2 else ("aab  \n\t'sreteST12!", 60)
        text = "".join(random.choice(pool) for _ in range(random.randint(0, most))) + ("<|endoftext|>x" if k % 7 == 0 else "")
        ids = library.encode(text, add_special_tokens=False).ids
        assert own.encode(text) == ids, repr(text)
        assert own.decode(ids) == library.decode(ids, skip_special_tokens=False)


@pytest.mark.parametrize("text", ["a" * 40_000, " " * 20_000, "ab" * 20_000, "é́" * 9_999, "\n \n" * 5_000])
def test_long_pieces(known, text):
    assert known[1].encode(text) == known[0].encode(text, add_special_tokens=False).ids


def test_every_prefix_has_the_right_last_token(known):
    own, word = known[1], b" internationalizationing"
    for end in range(1, len(word) + 1):
        merged = [bytes([b]) for b in word[:end]]  # merging by rank, pair by pair
        while True:
            ranked = [(own.pair.get((rank(own, a), rank(own, b))), i) for i, (a, b) in enumerate(zip(merged, merged[1:]))]
            best = min(((r, i) for r, i in ranked if r is not None), default=None)
            if best is None:
                break
            i = best[1]
            merged[i:i + 2] = [merged[i] + merged[i + 1]]
        assert b"".join(own.bytes_of_id[i] for i in own.encode_piece(word[:end])) == word[:end]
        assert [own.bytes_of_id[i] for i in own.encode_piece(word[:end])] == merged


def rank(own, piece):
    ids = {v: k for k, v in own.bytes_of_id.items()} if not hasattr(own, "_back_ids") else own._back_ids
    own._back_ids = ids
    return own.id_of.index(ids[piece])


def test_operator_on_edge_rows(known, edge, nothing):
    out = encode(edge, FILE, ("ids", "decoded", "n_tokens", "ids_sha256", "decoded_sha256"))
    rows = {(r.doc_id, r.ids_sha256): r for r in out.collect()}
    assert out.count() == edge.count()
    for r in edge.collect():
        text = r.text or ""
        ids = known[0].encode(text, add_special_tokens=False).ids
        got = rows[r.doc_id, hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()]
        assert got.ids == ids and got.n_tokens == len(ids) and got.decoded == text
        assert got.decoded_sha256 == hashlib.sha256(text.encode()).hexdigest()
    back = {r.doc_id: r.text for r in decode(encode(edge, FILE), FILE).collect()}
    assert back[10] == next(r.text for r in edge.collect() if r.doc_id == 10)
    assert encode(nothing, FILE).count() == 0
