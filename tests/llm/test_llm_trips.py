"""Ids spelled and decoded once per distinct part."""

import numpy as np
import public_tokenizers
import tiktoken

from gleanery.llm import bpe


def test_distinct_parts_are_decoded_once():
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=bpe.read_ranks(bpe.RANKS), special_tokens={})
    texts = ["", "some words, some words.", "\n some", "é,é a_,b", "!!,.x", "🙂 some", "it's 12\n\nx "]
    own, runs = bpe.Codec(), []
    decode_runs = own.decode_runs
    own.decode_runs = lambda given: (runs.extend(given), decode_runs(given))[1]
    for _ in range(3):
        packed, spelled, decoded = own.round_trip(texts)
        ids = [library.encode_ordinary(t) for t in texts]
        assert [np.frombuffer(p, "<i4").tolist() for p in packed] == ids
        assert spelled == ["".join(f" {i}" for i in of_text) for of_text in ids]
        assert decoded == [t.encode() for t in texts]
    assert 0 < len(runs) < sum(len(own._pattern.findall(t)) for t in texts)
