"""Byte-level BPE against the tokenizer library, text by text."""

from __future__ import annotations

import random

import numpy as np
import public_tokenizers
import pytest

from ledgerwright.llm import byte_bpe

TEXTS = [
    "",
    " ",
    "\n\n  \n x",
    "It's we'll THEY'RE 'sx ''s",
    "café Àß 12½3 Ⅷ 漢字かな \U0001f600‍\U0001f600 é",
    "tab\tand\x0b\x1c\x85   end  ",
    "࢏౜ a\U00010940b Ᲊ 3\U00011de0 \U0001ccf0",
    "a" * 3000 + " " * 700 + "!?" * 400,
    "<|endoftext|> is text",
    "\x00\x01 nul",
    None,
]


def rows():
    rng = random.Random(5)
    syllables = "ka lo mi ne ru sa ti vo én üb".split()
    texts = [" ".join("".join(rng.choices(syllables, k=rng.randint(1, 4))) for _ in range(rng.randint(0, 200))) for _ in range(60)]
    texts += TEXTS + [" the" * 20_000]
    out = [(k, t, 1) for k, t in enumerate(texts)]
    return [*out, out[2], (None, "no id", None), (None, None, None)]


@pytest.mark.parametrize("block,shard", [(1, 1), (4000, 50), (byte_bpe.BLOCK, byte_bpe.SHARD)])
def test_ids_and_bytes_as_the_library(spark, block, shard):
    given = rows()
    docs = spark.createDataFrame(given, "doc_id long, text string, ids int").repartition(3)
    path, cut = public_tokenizers.path(byte_bpe.VOCABULARY), public_tokenizers.PATTERN
    library = byte_bpe.encoding(path, cut)
    encoded = byte_bpe.encode(docs, path, cut, block, shard)
    found = [(r.doc_id, np.frombuffer(r.ids, "<u4").tolist(), bytes(r.data)) for r in byte_bpe.decode(encoded, path).collect()]
    expected = [(i, library.encode_ordinary(t or ""), (t or "").encode()) for i, t, _ in given]
    key = lambda x: (x[0] is None, x[0] or 0, x[1])
    assert sorted(found, key=key) == sorted(expected, key=key)


def test_classes_are_those_of_the_library():
    cut = public_tokenizers.PATTERN
    library = byte_bpe.encoding(public_tokenizers.path(byte_bpe.VOCABULARY), cut)
    split = byte_bpe.splitter(cut)
    rng = random.Random(1)
    characters = [chr(c) for c in range(0x300)] + [chr(rng.randrange(0xE000, 0x110000)) for _ in range(3000)]
    characters += [chr(rng.randrange(0x300, 0xD800)) for _ in range(3000)]
    for _ in range(300):
        text = "".join(rng.choices([" ", " ", "a", "1", "'", "\n", *rng.choices(characters, k=12)], k=40))
        ids = [i for word in split(text) for i in library.encode_ordinary(word.decode())]
        assert ids == library.encode_ordinary(text) and b"".join(split(text)) == text.encode()


def test_no_rows(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert byte_bpe.decode(byte_bpe.encode(docs)).collect() == []
