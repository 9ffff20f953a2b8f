from __future__ import annotations

import base64
import random

import public_tokenizers
import pytest
import tiktoken

from storelens.llm import bpe

PATH, PATTERN = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN


@pytest.fixture(scope="module")
def library():
    with open(PATH, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    return tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_same_ids_as_the_library(library):
    rng = random.Random(2)
    blanks = [chr(x) for x in bpe.BLANK_POINTS]
    letters = [*"aabcdefghij  \n\t\r's!?.,0919", "é", "ß", "中", "\U0001f600", "\x00", "́", "‍", *blanks]
    coder = bpe.codec(PATH, PATTERN)
    for _ in range(5000):
        text = "".join(rng.choices(letters, k=rng.randint(0, 16)))
        assert coder.encode(text).tolist() == library.encode_ordinary(text), repr(text)


def test_long_pieces(library):
    coder = bpe.codec(PATH, PATTERN)
    for text in ("a" * 30_000, "abcdefg" * 5_000, "é" * 4_000, " " * 5_000 + "x", "x" + "\n" * 3_000, "=-" * 9_000):
        ids = coder.encode(text)
        assert ids.tolist() == library.encode_ordinary(text)
        assert coder.decode(ids) == text.encode()


def test_documents(rows):
    df = rows("doc_id bigint, text string, ids string", (1, "Hello world", "old"), (2, None, "old"), (2, "", "old"))
    got = bpe.encode_documents(df, PATH, PATTERN).collect()
    assert [(r["doc_id"], bytes(r["decoded"])) for r in got] == [(1, b"Hello world"), (2, b""), (2, b"")]
    assert len(got[0]["ids"]) == 2 and got[1]["ids"] == []
    assert bpe.encode_documents(rows("doc_id bigint, text string"), PATH, PATTERN).count() == 0
