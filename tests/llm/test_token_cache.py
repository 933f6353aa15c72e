"""What the cached encoder sends to the tokenizer: words once, whatever line ends stand beside them, and often-met ones stay."""

import random

import public_tokenizers
import pytest
from tokenizers import Tokenizer

from skewkit.llm import tokens

PATHS = [public_tokenizers.path(n) for n in ("word_bpe_49k.json", "byte_bpe_50k.json")]


class Listening:
    """A tokenizer that notes the texts it gets."""

    def __init__(self, inner):
        self.inner, self.sent = inner, []

    def encode_batch(self, texts, **options):
        self.sent += texts
        return self.inner.encode_batch(texts, **options)


def listening(path, size=10_000):
    encoder = tokens.CachedEncoder(path, size, special_tokens=True)
    encoder.tokenizer = Listening(encoder.tokenizer)
    return encoder


@pytest.mark.parametrize("path", PATHS)
def test_words_beside_line_feeds_are_sent_once(path):
    encoder = listening(path)
    encoder.encode(["one two three.\nOne\nTwo end."])
    encoder.tokenizer.sent.clear()
    text = "one\nOne two\nTwo three.\nTwo two.\nOne"
    assert encoder.encode([text])[0].tolist() == Tokenizer.from_file(path).encode(text, add_special_tokens=False).ids
    assert encoder.tokenizer.sent == []


@pytest.mark.parametrize("path", PATHS)
def test_a_full_cache_keeps_words_met_often(path):
    rng = random.Random(4)
    encoder = listening(path, 200)
    plain = Tokenizer.from_file(path)
    for _ in range(8):
        text = "x " + " ".join(f"often{'abcdefgh'[i % 8]} " + "".join(rng.choices("klmnop", k=9)) for i in range(150))
        assert encoder.encode([text])[0].tolist() == plain.encode(text, add_special_tokens=False).ids
        assert len(encoder.codes) <= 400
    sent = " ".join(encoder.tokenizer.sent).split()
    assert all(sent.count(f"often{c}") == 1 for c in "abcdefgh")


@pytest.mark.parametrize("path", PATHS)
def test_keys_with_odd_white_space(path):
    plain = Tokenizer.from_file(path)
    texts = ["a\n\nb", "a \nb", "a\n b", "\na", " a", "a\n", "a ", "a\t b", "a\t\nb", "\t a", "\n", " ", "\n \n", "a\r\nb", "x (7) 8-9\n1.2\n(a)",
             "a b.\nC", "\x1c a\x1c\nb", "a<|endoftext|>\nb <|endoftext|>\n<|endoftext|>", "é\ńx ́y\nİa\nİb"]
    encoder = listening(path)
    for some in (texts, [t + u for t in texts for u in texts]):
        for text, ids in zip(some, encoder.encode(some), strict=True):
            assert ids.tolist() == plain.encode(text, add_special_tokens=False).ids, text


@pytest.mark.parametrize("path", PATHS)
def test_latin_words_are_sent_without_punctuation_and_capitals(path):
    encoder = listening(path)
    encoder.encode(["a été straße ###, *** ."])
    encoder.tokenizer.sent.clear()
    text = "a été### straße, été, straße###, Été STRASSE Straße. İst <|endoftext|>. ŉ×! ΑΣ, don't!"
    library = Tokenizer.from_file(path)
    assert encoder.encode([text, None, ""])[0].tolist() == library.encode(text, add_special_tokens=False).ids
    sent = "".join(encoder.tokenizer.sent)
    assert "été#" not in sent and "straße" not in sent
    assert ("Été" in sent) == (library.encode("A").ids != library.encode("a").ids)
