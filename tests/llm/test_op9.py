from __future__ import annotations

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st

from contrail.llm import op9_bpe
from contrail.llm.op9_bpe import PerfectHash, decode, encode
from contrail.llm.queries import op9_byte_bpe, vocabulary
from tests.llm.helpers import no_docs, odd_docs


@pytest.fixture(scope="module")
def reference():
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=vocabulary().ranks, special_tokens={})


@settings(max_examples=200, deadline=None)
@given(st.binary(min_size=1, max_size=60))
def test_merge_equals_the_library_on_single_pieces(piece):
    r = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=vocabulary().ranks, special_tokens={})
    assert vocabulary().encode(piece) == r._core_bpe.encode_single_piece(piece)


def test_perfect_hash_is_minimal_and_exact():
    keys = [f"k{i}".encode() for i in range(3000)]
    h = PerfectHash(keys)
    assert sorted(h.slot(k) for k in keys) == list(range(3000))
    assert all(h.slot(f"x{i}".encode()) == -1 for i in range(500))
    assert PerfectHash([]).slot(b"a") == -1


def test_texts_and_round_trip(spark, reference):
    docs = odd_docs(spark, [(20, "<|endoftext|> don't  stop\n\n\n  x", "en", "s", 1, 0, "", 0), (21, "a" * 5000, "en", "s", 1, 0, "", 0)])
    got = decode(encode(docs, vocabulary(), public_tokenizers.PATTERN), vocabulary())
    assert [c for c in got.columns if c not in ("ids", "decoded")] == [c for c in docs.columns if c != "ids"]
    for r in got.collect():
        t = r.text or ""
        assert np.frombuffer(r.ids, "<u4").tolist() == reference.encode_ordinary(t)
        assert bytes(r.decoded) == t.encode()
    assert encode(no_docs(spark), vocabulary(), public_tokenizers.PATTERN).count() == 0


def test_frequent_words_stay_known_while_rare_ones_pass():
    class Counting:
        def __init__(self):
            self.met = []

        def encode(self, piece):
            self.met.append(piece)
            return [len(piece)]

    words = Counting()
    memo = op9_bpe._Memo(words, 100 * op9_bpe._ENTRY)
    for i in range(1000):
        assert memo["the"] == np.array([3], "<u4").tobytes()
        assert memo[f"rare{i}"] == np.array([len(f"rare{i}")], "<u4").tobytes()
        assert len(memo) + len(memo.older) <= 100
    assert words.met.count(b"the") == 1 and len(words.met) == 1001


def test_merge_looks_up_new_pairs_only():
    class Counting(dict):
        met = 0

        def get(self, *key):
            Counting.met += 1
            return super().get(*key)

    vocab = op9_bpe.Vocabulary(vocabulary().ranks)
    vocab.ranks = Counting(vocab.ranks)
    pieces = [w.encode() for w in (" enver\u00f6ch", " inthesnded", " ererkeitlich", "Queci\u00f3nmi", " \u00e9eauqueque")]
    for piece in pieces:
        got = vocab.merge(piece)
        assert b"".join(vocab.pieces[i] for i in got) == piece
        # two pairs at most change with a merge; the pairs of single bytes are in a table
        assert Counting.met <= 2 * (len(piece) - len(got))
        Counting.met = 0


def test_bytes_without_an_id_may_merge_but_not_stay():
    vocab = op9_bpe.Vocabulary({b"a": 0, b"ab": 1, b"aba": 2})
    assert vocab.merge(b"abab") == [1, 1] and vocab.merge(b"aba") == [2]
    with pytest.raises(KeyError):
        vocab.merge(b"abb")


def test_query(spark, reference):
    import hashlib

    sf = "/root/testdata/sf0.001"
    want = {}
    for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect():
        ids = reference.encode_ordinary(r.text or "")
        want[r.doc_id] = (len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256((r.text or "").encode()).hexdigest())
    assert {r.doc_id: tuple(r)[1:] for r in op9_byte_bpe(spark, sf).collect()} == want
