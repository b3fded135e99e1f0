import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from starledger.llm import tokens

PATH = public_tokenizers.path("byte_bpe_50k.json")
WORDS = ["plain", "élan", "straße", "слово", "λόγος", "ﬁn", "字", "ıİ", "ǅ", "x2", "it's", "end.", "più,", "a-b", "###", "ª", "ʼn", "ét"]


class Counted:
    """A tokenizer whose calls for texts are kept."""

    def __init__(self, path):
        self.real, self.asked = Tokenizer.from_file(path), []

    def __getattr__(self, name):
        return getattr(self.real, name)

    def encode_batch_fast(self, texts, **options):
        self.asked += texts
        return self.real.encode_batch_fast(texts, **options)


def test_words_of_letters_go_to_the_model_alone(monkeypatch):
    counted = Counted(PATH)
    monkeypatch.setattr(tokens, "_load", lambda path: counted)
    own = tokens._Ids(PATH)
    counted.asked.clear()
    text = "Only words of letters, été слово.\nin lines and lines"
    assert np.frombuffer(own.encode([text])[0], "<u4").tolist() == counted.real.encode(text, add_special_tokens=False).ids
    assert counted.asked == []


@pytest.mark.parametrize("size", [2, 10**6])
def test_letters_of_all_scripts_have_the_ids_of_the_tokenizer(size, monkeypatch):
    t, own = Tokenizer.from_file(PATH), tokens._Ids(PATH)
    own.plain.half = own.spaced.half = size // 2
    rng = np.random.default_rng(3)
    texts = WORDS + [" ".join(rng.choice(WORDS, int(n))) for n in rng.integers(1, 7, 500)]
    for at in range(0, len(texts), 20):
        some = texts[at : at + 20]
        assert own.encode(some) == [np.array(t.encode(x, add_special_tokens=False).ids, "<u4").tobytes() for x in some]
