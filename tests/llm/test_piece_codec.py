import random
import zlib
from types import SimpleNamespace

import numpy as np
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st

from cohortlens.llm.piece_codec import UNIGRAM, ModelFile, PieceCodec, build_tokenizer, check_parity, parity, piece_table
from cohortlens.llm.queries import tokenizer_file

PATH = tokenizer_file("piece_bpe_32k.model")
CODEC = PieceCodec(PATH)
TEXTS = ["", " ", "a", "  a", "a  b   c ", "▁x", "a▁b", "<s> x </s>", "<0x41>", "\n\n a", "\t", "日本語 テスト", "emoji 😀 ok",
         "é x", "<unk>", "a\x00b", "word " * 300, "x" * 500, " lead", "trail ", " \n ", "Ünï cödé.\nNext line, here."]


def test_parity_and_round_trip():
    ids, counts = CODEC.encode(TEXTS)
    check_parity(PATH, TEXTS, ids, counts, range(len(TEXTS)))
    for text, back in zip(TEXTS, CODEC.decode(ids, counts), strict=True):
        assert back == text.replace("▁", " ").encode()


@settings(max_examples=200, deadline=None)
@given(st.lists(st.text(alphabet=st.one_of(st.sampled_from("ab \n▁é"), st.characters(codec="utf-8")), max_size=25), max_size=5))
def test_any_texts(texts):
    ids, counts = CODEC.encode(texts)
    check_parity(PATH, texts, ids, counts, range(len(texts)))


def test_a_difference_is_an_error():
    ids, counts = CODEC.encode(["some words"])
    with pytest.raises(ValueError, match="differ"):
        check_parity(PATH, ["some words"], ids + 1, counts, [0])


def varint(n):
    out = b""
    while n > 127:
        out, n = out + bytes([n & 127 | 128]), n >> 7
    return out + bytes([n])


def part(number, value):
    return varint(number << 3 | 2) + varint(len(value)) + value


def test_unigram_model(tmp_path):
    pieces = [("<unk>", 0.0, 2), ("<s>", 0.0, 3), ("</s>", 0.0, 3), *((f"<0x{i:02X}>", -20.0, 6) for i in range(256)),
              ("▁", -2.0, 1), ("▁he", -3.0, 1), ("llo", -3.5, 1), ("▁hello", -5.0, 1), ("l", -4.0, 1), ("o", -4.0, 1),
              ("h", -5.0, 1), ("e", -5.0, 1), ("w", -5.0, 1), ("or", -4.5, 1), ("ld", -4.5, 1)]
    body = b"".join(part(1, part(1, p.encode()) + b"\x15" + np.float32(s).tobytes() + b"\x18" + varint(k)) for p, s, k in pieces)
    body += part(2, b"\x18" + varint(UNIGRAM) + varint(35 << 3) + b"\x01") + part(3, part(1, b"identity"))
    path = tmp_path / "unigram.model"
    path.write_bytes(body)
    model = sentencepiece.SentencePieceProcessor(model_file=str(path))
    codec = PieceCodec(str(path))
    assert codec.model.kind == UNIGRAM and build_tokenizer(ModelFile(body)).get_vocab_size() == len(pieces)
    texts = ["hello world", "  hello   hello ", "held é", "", "low"]
    normal = [codec.normalise(t) for t in texts]
    ids, counts = codec.encode(normal)
    check_parity(str(path), texts, ids, counts, range(len(texts)))
    assert model.decode(ids[:counts[0]].tolist()) == "hello world"
    assert [b.decode() for b in codec.decode(ids, counts)] == normal


def test_documents(make_docs):
    rows = list(enumerate(TEXTS)) + [(100, None), (None, "no id"), (5, "twice"), (5, "twice")]
    got = piece_table(make_docs(rows), PATH, parity_every=1, with_ids=True).collect()
    model = sentencepiece.SentencePieceProcessor(model_file=PATH)
    want = []
    for i, t in rows:
        ids = np.array(model.encode(t or ""), "<u4").tobytes()
        want.append((i, len(ids) // 4, zlib.crc32(ids), "▁" not in (t or ""), ids))
    assert sorted(((*r[:4], bytes(r.ids)) for r in got), key=repr) == sorted(want, key=repr)
    assert piece_table(make_docs([]), PATH).collect() == []


def test_every_document_is_compared_with_the_library(make_docs):
    rows = list(enumerate(TEXTS)) + [(100, None), (None, "no id"), (5, "twice"), (5, "twice")]
    got = piece_table(make_docs(rows), PATH).collect()
    assert len(got) == len(rows) and all(r.parity is True for r in got)
    assert {r.parity for r in piece_table(make_docs(rows), PATH, parity_every=0).collect()} == {None}


def test_a_difference_shows_in_its_row():
    texts = ["some words", "other words", "third"]
    ids, counts = CODEC.encode(texts)
    ids = ids.copy()
    ids[counts[0]] += 1
    assert parity(PATH, texts, ids, counts, [0, 1]) == [True, False, None]


def test_flags_of_words_equal_the_comparison_of_whole_texts():
    rng = random.Random(8)
    alphabet = "ab é.日😀x" + chr(0x301) + chr(0xFF41) + "\n"
    texts = ["".join(rng.choices(alphabet, k=rng.randint(0, 30))) for _ in range(400)] + TEXTS
    coder = PieceCodec(PATH)
    coder.set_check(True)
    normal = [coder.normalise(t) for t in texts]
    ids, counts = coder.encode(normal)
    assert coder.simple.sum() > 50
    assert coder.parity(texts, normal, ids, counts, range(len(texts))) == parity(PATH, texts, ids, counts, range(len(texts)))


def test_a_wrong_word_shows_in_exactly_its_texts():
    coder = PieceCodec(PATH)
    coder.set_check(True)
    real = coder.tokenizer

    class Wrong:
        def encode_batch_fast(self, words, add_special_tokens):
            out = real.encode_batch_fast(words, add_special_tokens=add_special_tokens)
            return [SimpleNamespace(ids=[*e.ids[:-1], e.ids[-1] + 1] if w == "▁bad" else e.ids)
                    for w, e in zip(words, out, strict=True)]
    coder.tokenizer = Wrong()
    texts = ["good words", "a bad word", "worse", "bad", "badly said", "not  bad here", "the bad bad end"]
    ids, counts = coder.encode(texts)
    wrong = [t in ("a bad word", "bad", "the bad bad end") for t in texts]
    assert coder.parity(texts, texts, ids, counts, range(len(texts))) == [not w for w in wrong]
    assert parity(PATH, texts, ids, counts, range(len(texts))) == [not w for w in wrong]
