"""Token ids against the tokenizers' own libraries."""

import zlib

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from gleanery.llm import bpe, packing, token_files, tokens

ODD = [
    "", " ", "\n", "a, b ,c", "a  ,b", "!!,.x", "x\0,y\1z", "é,é, a_,b", "\n,a", "..", ",", "a.b.c  d", "it's, we'll.", "１２,３", "ab\t.c",
    "½, x", "a  b  c", "\x1c.\x85,", "日本語、テキスト。", "🙂🙂 é,", "<|endoftext|> x", "aaaa" * 50, "ab" * 300, "x" * 5000,
    " lead", "trail ", "two\n\nlines\n", "A" * 33 + " " * 40 + "z",
]


#: Every sign of the first blocks before and after blanks, stops and letters.
SIGNS = [f"a{c}. b{c}{c},1{c} {c}x" for c in map(chr, [*range(0x3001), 0xFEFF, 0xFF0C, 0x1F642]) if not 0xD800 <= ord(c) < 0xE000]


def docs(spark, texts, extra=""):
    rows = [(i, t, "x") for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, "doc_id long, text string, ids string")


@pytest.fixture(scope="module")
def reference():
    ranks = bpe.read_ranks(bpe.RANKS)
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_merges_rise():
    assert bpe.rising_merges(bpe.read_ranks(bpe.RANKS))
    assert not bpe.rising_merges({b"a": 0, b"b": 1, b"c": 2, b"abc": 3, b"ab": 4})


def test_codec_equals_the_library(reference):
    codec = bpe.Codec()
    spaces = [f"a{chr(c)}{chr(c)} b{chr(c)}!{chr(c)}1" for c in [*range(0x3001), 0xFEFF, 0x180E, 0x200B] if not 0xD800 <= c < 0xE000]
    texts = [*ODD, *spaces, *SIGNS]
    got = codec.encode(texts)
    assert [np.frombuffer(p, "<u4").tolist() for p in got] == [reference.encode_ordinary(t) for t in texts]
    assert codec.decode(got) == [t.encode() for t in texts]
    assert bpe.Codec(cached=3).encode(ODD) == got[: len(ODD)]  # a cache that is emptied all the time


def test_encode_decode_and_digests(spark, reference):
    df = docs(spark, [*ODD, None, ODD[3]])
    coded = bpe.encode(df).collect()
    assert {r["doc_id"]: r["ids"] for r in coded} == {i: reference.encode_ordinary(t or "") for i, t in enumerate([*ODD, None, ODD[3]])}
    back = bpe.decode(bpe.encode(df).withColumn("ids", F.when(F.col("doc_id") > 0, F.col("ids")))).collect()
    assert {r["doc_id"]: r["decoded"] for r in back} == {0: None} | {i: (t or "").encode() for i, t in enumerate([*ODD, None, ODD[3]]) if i}
    sums = {r["doc_id"]: r for r in bpe.digests(df).collect()}
    import hashlib

    for i, t in enumerate([*ODD, None]):
        ids = reference.encode_ordinary(t or "")
        assert sums[i]["n_tokens"] == len(ids)
        assert sums[i]["ids_sha256"] == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert sums[i]["decoded_sha256"] == hashlib.sha256((t or "").encode()).hexdigest()
    assert bpe.digests(df.limit(0)).count() == 0


SPECIAL = ["end <|endoftext|> here", "<|endoftext|>", "a<|ENDOFTEXT|>b", "<|startoftext|>x, y.<|endoftext|><|endoftext|>", "<|endoftext", "x" * 50 + "<|endoftext|>"]


def library(path):
    found = Tokenizer.from_file(path)
    return lambda text: found.encode(text, add_special_tokens=False).ids


@pytest.mark.parametrize("path", [tokens.BYTE_BPE, tokens.WORD_BPE])
def test_encoder_equals_the_library(path):
    own, ids = tokens.encoder(path), library(path)
    texts = [*ODD, *SIGNS, *SPECIAL]
    assert [t for t, p in zip(texts, own.encode(texts), strict=True) if np.frombuffer(p, "<u4").tolist() != ids(t)] == []


def test_plain_words_go_to_the_library_together(monkeypatch):
    own, ids = tokens.Encoder(tokens.WORD_BPE, None), library(tokens.WORD_BPE)
    letters = [chr(c) for c in range(0x250) if tokens._PLAIN.fullmatch(chr(c))]
    words = [w for c in letters for w in (c, f"a{c}B", c * 3, f"E{c}")] + ["strasse" * 9, "it's", "x1", "\u0130x", "e\u0301", ""]
    alone, given = own.encode_parts, []
    monkeypatch.setattr(own, "encode_parts", lambda parts: given.extend(parts) or alone(parts))
    assert [np.frombuffer(p, "<u4").tolist() for p in own.encode_words(words)] == [ids(w) for w in words]
    assert given == ["it's", "x1", "\u0130x", "e\u0301", ""]


def test_token_files(spark, tmp_path):
    rows = [(k, t) for k, t in zip([7, 3, 3, None, 12, -5], ["b, c", "a" * 3000, "a" * 3000, "null <|endoftext|> key", None, "word " * 9000], strict=True)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    root = str(tmp_path / "t")
    manifest = token_files.write_tokens(df, root, length=64, rows=4)
    ids = library(tokens.WORD_BPE)
    want = [(k, [*ids(t or ""), 1]) for k, t in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0))]
    got = token_files.read_tokens(spark, root).orderBy("start").collect()
    start = 0
    for r, (k, own) in zip(got, want, strict=True):
        assert (r["key"], r["start"], r["n_tokens"]) == (k, start, len(own))
        assert r["ids_crc32"] == zlib.crc32(np.array(own, "<u4").tobytes())
        start += len(own)
    whole = []
    for row in manifest.orderBy("part").collect():
        file = token_files.TokenFile(root, row["file"])
        for k in range(-(-row["n_ids"] // 64)):
            values, mask = file.sequence(k)
            assert values.dtype == np.uint16 and len(values) == len(mask) == 64 and not values.flags.owndata
            whole += values[mask.to_numpy(zero_copy_only=False)].tolist()
    assert whole == [i for _, own in want for i in own]


def test_token_files_of_nothing(spark, tmp_path):
    root = str(tmp_path / "t")
    assert token_files.write_tokens(docs(spark, ["a"]).limit(0), root).count() == 0
    assert token_files.read_tokens(spark, root).count() == 0


def test_first_fit_decreasing():
    random = np.random.default_rng(1)
    for n in (0, 1, 2, 7, 100):
        sizes = random.integers(1, 65, n)
        bins, room = packing.first_fit_decreasing(sizes, 64), []
        want = np.empty(n, int)
        for piece in np.argsort(-sizes, kind="stable"):
            fits = next((b for b, left in enumerate(room) if left >= sizes[piece]), len(room))
            room = [*room, 64] if fits == len(room) else room
            room[fits] -= sizes[piece]
            want[piece] = fits
        assert bins.tolist() == want.tolist()


def test_packing(spark):
    texts = [None, "", "a b <|endoftext|> c", "word " * 9000, *(f"n{i} " * (i % 90) for i in range(300)), "same", "same"]
    df = docs(spark, texts).withColumn("doc_id", F.when(F.col("doc_id") != 2, F.least("doc_id", F.lit(304))))
    rows = packing.pack(df, group=50, with_ids=True).collect()
    by_doc, by_sequence = {}, {}
    for r in rows:
        assert r["ids_crc32"] == zlib.crc32(np.array(r["ids"], "<u4").tobytes()) and len(r["ids"]) == r["length"]
        by_doc.setdefault(r["doc_id"], []).append(r)
        by_sequence.setdefault(r["sequence_id"], []).append(r)
    for of in by_sequence.values():
        of.sort(key=lambda r: r["offset"])
        assert [r["offset"] for r in of] == np.cumsum([0, *(r["length"] for r in of)])[:-1].tolist()
        assert sum(r["length"] for r in of) <= 2048
    ids = library(tokens.BYTE_BPE)
    for k, t in enumerate(texts[:304]):
        own = sorted(by_doc[None if k == 2 else k], key=lambda r: r["start"])
        assert [i for r in own for i in r["ids"]] == [*ids(t or ""), 1] and {r["doc_tokens"] for r in own} == {len(ids(t or "")) + 1}
    assert len(by_doc[304]) == 2
    total = sum(r["length"] for r in rows)
    assert len(by_sequence) <= total / 2048 + 8
    stored = {r["sequence_id"]: (r["n_ids"], r["stored"]) for r in packing.padded(packing.pack(df, group=50)).collect()}
    assert all(s == (n if n & (n - 1) == 0 else 2048) for n, s in stored.values())
    assert packing.pack(df.limit(0)).count() == 0
