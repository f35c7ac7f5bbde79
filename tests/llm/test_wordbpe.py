import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from barloom.llm.wordbpe import WordEncoder, vocabulary_path


@pytest.fixture(scope="module")
def both():
    from tokenizers import Tokenizer

    return WordEncoder(cache_chunks=50, kept_chunks=10), Tokenizer.from_file(vocabulary_path())


WORDS = st.sampled_from(["the", "The,", "don't", "Ünïcode", "naïve.", "été!!", "ﬁne", "İstanbul", "ΣΑΣ", "a_b", "x<|endoftext|>y", "日本", "éte", "́a", "12th", "'s", "a'll", "\t", " ", " ", "|", "***", "ß", "µm"])


@settings(max_examples=200, deadline=None)
@given(st.one_of(st.text(max_size=60), st.lists(WORDS, max_size=12).map(" ".join), st.lists(WORDS, max_size=8).map("\n".join)))
def test_same_ids_as_the_tokenizer(both, text):
    encoder, tokenizer = both
    try:
        text.encode()
    except UnicodeEncodeError:
        return
    assert np.frombuffer(encoder.ids(text), np.uint32).tolist() == tokenizer.encode(text, add_special_tokens=False).ids


def test_null_and_empty(both):
    assert both[0].ids(None) == b"" == both[0].ids("")


def test_other_vocabularies_encode_whole_texts():
    import public_tokenizers
    from tokenizers import Tokenizer

    path = public_tokenizers.path("byte_bpe_50k.json")
    encoder, tokenizer = WordEncoder(path), Tokenizer.from_file(path)
    assert not encoder.by_chunks and WordEncoder().by_chunks
    for text in ("The quick  brown\nfox", "", "naïve 日本"):
        assert np.frombuffer(encoder.ids(text), np.uint32).tolist() == tokenizer.encode(text, add_special_tokens=False).ids


def test_long_chunks_are_not_kept(both):
    encoder = WordEncoder()
    list(encoder.ids_of(["x" * 5000 + " y", "z" * 100]))
    assert max(map(len, encoder.known)) <= 64 and max(map(len, encoder.runs)) <= 64


def test_more_than_a_hundred_thousand_chunks_are_learned_once(monkeypatch):
    encoder, asked = WordEncoder(), []
    learn = encoder._run
    monkeypatch.setattr(encoder, "_run", lambda run: encoder.runs.get(run) or asked.append(run) or learn(run))
    texts = [" ".join("".join(chr(97 + (i // 26**j) % 26) for j in range(4)) for i in range(at, at + 1000)) for at in range(0, 120_000, 1000)]
    first = list(encoder.ids_of(texts))
    n = len(asked)
    assert n >= 120_000 and list(encoder.ids_of(texts)) == first and len(asked) == n
