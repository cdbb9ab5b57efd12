"""Decoding of token ids."""

import random

import public_tokenizers

from tessella.llm import byte_bpe


def test_decoding_needs_no_query():
    own = byte_bpe.Codec(public_tokenizers.path(byte_bpe.VOCABULARY), public_tokenizers.PATTERN)
    for texts in ([], [""], ["", ""], ["", "one two", "", "né\U0001f600 \0 x\n\n", "", "abc" * 100]):
        ids = own.encode(texts)
        con, own.con = own.con, None
        assert own.decode(ids) == [t.encode() for t in texts]
        own.con = con


def test_known_pieces_are_neither_copied_nor_lost():
    own = byte_bpe.Codec(public_tokenizers.path(byte_bpe.VOCABULARY), public_tokenizers.PATTERN)
    r, marks = random.Random(5), ["a", "bc", " ", " ", "  ", "\n", "\t", " ", " ", "\x1f", "\x85", "\0", "7", "'s", "é"]
    texts = ["".join(r.choices(marks, k=r.randint(0, 9))) for _ in range(3000)]
    cut = [own.pattern.findall(t) for t in texts[:300]]
    alone = dict(zip(words := list(set().union(*cut)), own.contract([w.encode() for w in words]), strict=True))
    want = [" ".join(str(i) for w in c for i in alone[w]) for c in cut]
    for kept in (10**6, 5):  # with few entries kept, pieces of a batch are of two generations
        own.kept, got = kept, []
        for k in range(0, 3000, 50):
            got += own.encode(texts[k : k + 50])
        assert got[:300] == want and own.decode(got) == [t.encode() for t in texts]
    assert own._ids({"a", " bc"}) is own.known
    assert own.encode(texts[:50] * 2) == want[:50] * 2
