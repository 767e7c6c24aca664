import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from astrolode.llm import bpe

PATH = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


def test_same_ids_as_the_library_on_any_characters(library):
    rnd = random.Random(3)

    def char():
        kind = rnd.randrange(6)
        if kind < 2:
            return rnd.choice(" \t\n'estrand")
        low, high = [(32, 127), (0x80, 0x600), (0x600, 0xD7FF), (0xE000, 0x110000)][kind - 2]
        return chr(rnd.randrange(low, high))

    texts = ["".join(char() for _ in range(rnd.randrange(80))) for _ in range(1500)]
    texts += ["", " ", "ȺȾ Σς ΣΑΣ İ", "don't we'LL 's ''s", "a\x1cb \x1f c\x85d", "1½²Ⅷ٣", "ṩ é",
              "<|endoftext|>x<|startoftext|> <|ENDOFTEXT|>", "a" * 301, "ab" * 400, "\u0000​"]
    ours = list(bpe.vocabulary(PATH).encode_batch(texts))
    theirs = library.encode_batch(texts, add_special_tokens=False)
    for text, ids, want in zip(texts, ours, theirs, strict=True):
        assert np.frombuffer(ids, "<u4").tolist() == want.ids, repr(text)
        assert bpe.vocabulary(PATH).decode(ids).decode() == library.decode(
            want.ids, skip_special_tokens=False)


def test_one_long_word_and_a_full_cache(library, monkeypatch):
    monkeypatch.setattr(bpe, "CACHED_WORDS", 50)
    monkeypatch.setattr(bpe, "CHUNK_CHARS", 500)
    rnd = random.Random(5)
    vocab = bpe.Vocabulary(PATH)
    texts = ["".join(rnd.choice("etaoinshr") for _ in range(20_000))]
    texts += [" ".join("".join(rnd.choice("etaoin") for _ in range(6)) for _ in range(90))
              for _ in range(20)]
    got = [np.frombuffer(x, "<u4").tolist() for x in vocab.encode_batch(texts)]
    assert got == [e.ids for e in library.encode_batch(texts, add_special_tokens=False)]
    assert len(vocab._cache) < 400


def test_query_rows(odd_docs, odd_rows, library):
    got = sorted(map(tuple, bpe.round_trip(odd_docs, PATH).collect()), key=str)
    want = []
    for key, text in odd_rows:
        ids = library.encode(text or "", add_special_tokens=False).ids
        raw = np.array(ids, "<u4").tobytes()
        back = library.decode(ids, skip_special_tokens=False)
        want.append((key, len(ids), hashlib.sha256(raw).hexdigest(),
                     hashlib.sha256(back.encode()).hexdigest()))
    assert got == sorted(want, key=str)


def test_encode_and_decode_frames(odd_docs, no_docs, odd_rows, library):
    encoded = bpe.encode(odd_docs, PATH)
    texts = {r["doc_id"]: r["text"] for r in bpe.decode(encoded, PATH).collect()}
    for key, text in odd_rows:
        if key is not None:
            ids = library.encode(text or "", add_special_tokens=False).ids
            assert texts[key] == library.decode(ids, skip_special_tokens=False)
    assert bpe.round_trip(no_docs, PATH).collect() == []
    assert bpe.decode(bpe.encode(no_docs, PATH), PATH).collect() == []


def test_a_file_in_another_order_is_refused(tmp_path):
    import json

    spec = json.load(open(PATH, encoding="utf-8"))
    spec["model"]["merges"].reverse()
    wrong = tmp_path / "wrong.json"
    wrong.write_text(json.dumps(spec))
    with pytest.raises(ValueError):
        bpe.Vocabulary(str(wrong))
