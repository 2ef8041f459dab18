import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from cohortlens.llm import token_codes as tc
from cohortlens.llm.queries import tokenizer_file
from cohortlens.llm.token_codes import WordEncoder, decode_levels, encode_levels, read_id, token_table


@settings(max_examples=80, deadline=None)
@given(st.lists(st.one_of(st.integers(0, 300), st.integers(0, 2**32 - 1)), max_size=1500))
def test_codes_round_trip_and_random_access(ids):
    levels = encode_levels(np.array(ids, np.uint64))
    assert decode_levels(levels).tolist() == ids
    for i in range(0, len(ids), 7):
        assert read_id(levels, i) == ids[i]


@pytest.fixture(scope="module")
def path():
    return tokenizer_file("word_bpe_49k.json")


TEXTS = ["", " ", "Hello, World!", "it's  a\ttest\n", "<|endoftext|>", "<|ENDOFTEXT|> x", "a.b,c. d, e.. f.,", "é É é",
         "x y z", "12,000.", "don't. 'S", "ΑΣ ς. İ", "日本語。", "word " * 400, "y" * 5000, " a.", "\x1c b\x85c", "Á. B,"]


def test_words_give_the_ids_of_whole_texts(path):
    coder = WordEncoder(path)
    ids, counts = coder.encode([t.encode() for t in TEXTS])
    want = [coder.tokenizer.encode(t, add_special_tokens=False).ids for t in TEXTS]
    assert counts.tolist() == [len(w) for w in want]
    assert ids.tolist() == [i for w in want for i in w]


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text(max_size=30), max_size=4))
def test_any_texts(texts):
    path = tokenizer_file("word_bpe_49k.json")
    coder = test_any_texts.__dict__.setdefault("coder", WordEncoder(path))
    ids, _ = coder.encode([t.encode() for t in texts])
    assert ids.tolist() == [i for t in texts for i in coder.tokenizer.encode(t, add_special_tokens=False).ids]


def test_files_match_brute_force(make_docs, path):
    rows = [(i * 3 % 29, t) for i, t in enumerate(TEXTS)] + [(50, None), (51, "same"), (51, "same"), (None, "no id")]
    got = token_table(make_docs(rows), path, end_id=1).collect()
    tokenizer, start, want = WordEncoder(path).tokenizer, 0, []
    for i, t in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] or "")):
        ids = tokenizer.encode(t or "", add_special_tokens=False).ids + [1]
        want.append((i, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    assert sorted(map(tuple, got), key=repr) == sorted(want, key=repr)


def test_empty_table(make_docs, path):
    assert token_table(make_docs([]), path).collect() == []


def test_tails_of_words_are_read_from_their_bytes():
    import pyarrow as pa

    words = ["a.", ".", "", "B,", "1.", "..", "é.", "x", "ab,,", "[.", "{,", "@.", "`.", "z.", "A."]
    for column in (pa.array(words, pa.large_string()), pa.array(["q."] + words, pa.large_string())[1:]):
        last, tail = tc._tails(column)
        raw = [w.encode() for w in words]
        assert tail.tolist() == [w[-1:] in (b".", b",") and w[-2:-1].isalpha() for w in raw]
        assert last.tolist() == [w[-1] if w else 0 for w in raw]
    assert [len(x) for x in tc._tails(pa.array([], pa.large_string()))] == [0, 0]
