"""Words given to a byte-level vocabulary's library together."""

import random

import numpy as np
from tokenizers import Tokenizer

from gleanery.llm import tokens, words


class Counting:
    def __init__(self, inner):
        self.inner, self.given = inner, 0

    def encode_batch_fast(self, texts, **options):
        self.given += len(texts)
        return self.inner.encode_batch_fast(texts, **options)


def test_words_are_given_together_with_the_same_ids():
    rng = random.Random(3)
    letters = "abcXYZÀßÿİıǀɏɐ×中'1"
    texts = [" ".join("".join(rng.choices(letters, k=rng.randrange(0, 9))) for _ in range(60)) for _ in range(40)]
    texts += ["", " ", "a", " a", "  a  b ", " don't", "a b c", " Ġa b", "x\n y\n\n z", "tab\ta b", "<|endoftext|> a", " ".join(f"word{c}" for c in "abcdefgh") + "."]
    own = tokens.Encoder(tokens.BYTE_BPE, tokens.PATTERNS["byte_bpe_50k.json"])
    want = Tokenizer.from_file(tokens.BYTE_BPE)
    assert [np.frombuffer(p, "<u4").tolist() for p in own.encode(texts)] == [want.encode(t, add_special_tokens=False).ids for t in texts]
    words = [" " + "".join(rng.choices("abcdefghij", k=9)) for _ in range(2000)]
    counting = own._tokenizer = Counting(own._tokenizer)
    own.encode(["".join(words)])
    assert counting.given < len(words) / 20


def test_signs_digits_and_lines_are_given_together_with_the_same_ids():
    rng = random.Random(4)
    parts = [rng.choice(" \n") + "".join(rng.choices("abcÀß019$&*'-_~", k=rng.randrange(1, 9))) for _ in range(2000)]
    parts += ["a", " ", "\n\n", " a b", " ×", "\t1", ",", " é\n", "\x1c", " 中", "\n 1"]
    own = tokens.Encoder(tokens.BYTE_BPE, tokens.PATTERNS["byte_bpe_50k.json"])
    want = own.encode_parts(parts)
    counting = own._tokenizer = Counting(own._tokenizer)
    assert own.encode_spaced(parts) == want
    assert counting.given < len(parts) / 20


def test_parts_met_since_the_last_time_stay_known():
    given = []
    parts = words.Parts(lambda new: (given.extend(new), [p.encode() for p in new])[1], None, 8)
    for i in range(20):
        parts.encode([f"often a{i} b{i} c{i}"])
    assert given.count("often") == 1
