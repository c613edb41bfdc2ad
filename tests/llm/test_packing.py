from __future__ import annotations

import random
import struct

import public_tokenizers
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from clickloom.llm import packing

PATH = public_tokenizers.path("word_bpe_49k.json")


def test_encoder_is_the_tokenizer():
    whole = Tokenizer.from_file(PATH)
    texts = [
        "", " ", "It's don't WE'LL x's", "a\tb c d\x1ce\x85f", "É école ŒUVRE Straße ΣΑΣ İstanbul", "中文字 日本語。한국어 각",
        "x" * 300, "end.,!?;:#%&$*| ..., a|b |c| 12,345.67 3rd a1b2", "<|endoftext|> a<|startoftext|>b", "😀👍🏽 ½ ² ǅ ﬁ", "line\r\nbreak \n\n x", "ª º ʰ x̸ ≠",
    ]
    random.seed(3)
    letters = "abzÉéß .,'!\n\t1²中́<|>ſK"
    texts += ["".join(random.choice(letters) for _ in range(40)) for _ in range(400)]
    for text, ids in zip(texts, packing.encoder(PATH)(texts), strict=True):
        expected = whole.encode(text, add_special_tokens=False).ids
        assert ids == struct.pack(f"<{len(expected)}I", *expected), text


def test_lowering_first_changes_nothing():
    """Capitals whose small letter composes with a mark though they do not, special tokens in capitals, runs of Latin letters."""
    whole = Tokenizer.from_file(PATH)
    marks = [chr(c) for c in range(0x300, 0x370)]
    texts = [f"{chr(c)}{m}x {chr(c).lower()}{m}." for c in range(65, 91) for m in marks]
    texts += ["<|ENDOFTEXT|> A", "<|endoftext|> A", "A<|StartOfText|>", "\u212a \u212b A\u0323\u0302"]
    random.seed(4)
    letters = [chr(c) for c in range(0x40, 0x1A0)] + list(".,'|")
    texts += [" ".join("".join(random.choices(letters, k=random.randint(1, 9))) for _ in range(5)) for _ in range(2000)]
    for text, ids, one in zip(texts, packing.encoder(PATH)(texts), whole.encode_batch(texts, add_special_tokens=False), strict=True):
        assert ids == struct.pack(f"<{len(one.ids)}I", *one.ids), text


def test_a_worker_keeps_one_small_table():
    """Words and the runs of letters they start with share one bounded table."""
    words = packing._Words(PATH)
    for word in (b"word.", b"word,", b"word", b"\xc3\x89t\xc3\xa9!"):
        assert words[word] == words.whole(word)
    assert set(words) == {b"word", b"word.", b"word,", b".", b",", b"!", b"\xc3\x89t\xc3\xa9", b"\xc3\x89t\xc3\xa9!"}
    assert packing.WORDS_KEPT <= 300_000


def test_every_code_point_before_marks():
    """Alone, at the end of a word and inside one, each with a mark behind it."""
    whole, encode = Tokenizer.from_file(PATH), packing.encoder(PATH)
    points = [chr(c) for c in range(0x110000) if not 0xD800 <= c < 0xE000 and (c < 0x3400 or c % 7 == 0 or chr(c).isalpha() and c > 0xF000 and c < 0x20000)]
    for start in range(0, len(points), 4000):
        texts = [t for c in points[start : start + 4000] for t in (f"{c}?", f"Ab{c}.,", f"{c}b! {c}")]
        for text, ids, one in zip(texts, encode(texts), whole.encode_batch(texts, add_special_tokens=False), strict=True):
            assert ids == struct.pack(f"<{len(one.ids)}I", *one.ids), (text, hex(ord(text[0])))


def test_cut():
    for length in [1, 2, 63, 64, 65, 700, 1023, 1024, 1025, 2047, 2048, 2049, 9999]:
        pieces = packing.cut(length, 2048, 32)
        assert sum(pieces) == length and all(p > 0 for p in pieces)
        assert all(p in {2048 // j for j in range(1, 32)} for p in pieces[:-1])


def test_round_trip(spark, make_docs, odd_docs):
    whole = Tokenizer.from_file(PATH)
    docs = [(i, t) for i, t in odd_docs if i not in (None, 4)] + [(100 + i, "some words " * (37 * i % 900)) for i in range(80)]
    rows = packing.pack(make_docs(docs)).collect()
    pieces, sequences = {}, {}
    for r in rows:
        pieces.setdefault(r.id, []).append(r)
        sequences.setdefault(r.sequence_id, []).append(r)
    for name, text in docs:
        own = sorted(pieces.pop(name), key=lambda r: r.start)
        ids = whole.encode(text or "", add_special_tokens=False).ids + [1]
        assert b"".join(bytes(r.ids) for r in own) == struct.pack(f"<{len(ids)}I", *ids)
        assert all(r.doc_tokens == len(ids) and r.length * 4 == len(r.ids) for r in own)
        assert [r.start for r in own] == [sum(x.length for x in own[:i]) for i in range(len(own))]
    assert not pieces
    for own in sequences.values():
        own.sort(key=lambda r: r.offset)
        assert [r.offset for r in own] == [sum(x.length for x in own[:i]) for i in range(len(own))]
        assert sum(r.length for r in own) <= 2048
    assert sum(r.length for r in rows) > 0.8 * 2048 * (len(sequences) - 3)


def test_odd_rows(spark, make_docs, odd_docs):
    pieces = packing.pack(make_docs(odd_docs)).withColumn("len", F.col("length"))
    total = {r.id: r.n for r in pieces.groupBy("id").agg(F.sum("len").alias("n")).collect()}
    assert total[1] == total[2] == total[3] == 1 and total[4] == 2 * total[5] and total[None] == total[5] + 1
    assert packing.pack(make_docs(odd_docs).filter("false")).count() == 0
