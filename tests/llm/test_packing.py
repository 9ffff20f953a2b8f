from __future__ import annotations

import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from storelens.llm import packing

PATH = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(PATH)


def test_words_encode_as_whole_texts(tokenizer):
    rng = random.Random(4)
    letters = [*"aAbcdEfg  \n\t's!?.,0919", "É", "ß", "Σ", "ς", "中", "\U0001f600", "́", "İ", "\xa0", "\x1c", " ", "\x85"]
    texts = ["".join(rng.choices(letters, k=rng.randint(0, 20))) for _ in range(3000)]
    texts += ["", "a <|endoftext|> b", "<|startoftext|>x"]
    want = [np.array(tokenizer.encode(t, add_special_tokens=False).ids, "<u4").tobytes() for t in texts]
    assert packing.WordCodec(PATH).encode(texts) == want


@pytest.mark.parametrize("sizes", [[(0, 10_000)], [(0, 5), (1, 1), (2, 90_000), (3, 2_050)], [(k, 700) for k in range(60)], []])
def test_dealing_fills_windows_in_proportion(sizes):
    total, served, filled = sum(n for _, n in sizes), Counter(), Counter()
    for window, source, tokens in packing.deal(sizes):
        assert tokens > 0
        served[source] += tokens
        filled[window] += tokens
    assert served == Counter(dict(sizes))
    assert all(filled[w] == packing.WINDOW for w in range(total // packing.WINDOW))
    ahead = Counter()
    for window, source, tokens in packing.deal(sizes):
        ahead[source] += tokens
        due = dict(sizes)[source] * min((window + 1) * packing.WINDOW, total) / total
        assert ahead[source] <= due + packing.LEAST_PIECE * len(sizes) + 1


@pytest.mark.parametrize("block_tokens", [1 << 21, 3_000])
def test_pieces(rows, tokenizer, block_tokens):
    rng = random.Random(8)
    data = []
    for i in range(150):
        source = rng.choice(["a"] * 6 + ["b", "c", None])
        data.append((i, source, " ".join(rng.choices(["the", "Zebra,", "naïve", "x1"], k=rng.choice((0, 3, 40, 900))))))
    data += [(900, "a", None), (None, "b", "null id")]
    df = rows("doc_id bigint, source string, text string, start string", *[(*x, "old") for x in data])
    pieces = packing.pack(df, PATH, block_tokens).collect()
    ids = {i: np.array([*tokenizer.encode(t or "", add_special_tokens=False).ids, 1], "<u4") for i, _, t in data}
    found, windows, shares = defaultdict(list), defaultdict(list), defaultdict(Counter)
    for p in pieces:
        own = ids[p["doc_id"]]
        cut = own[p["start"] : p["start"] + p["length"]]
        assert p["doc_tokens"] == len(own) and p["ids_crc32"] == zlib.crc32(cut.tobytes())
        found[p["doc_id"]].append((p["start"], p["length"]))
        windows[p["sequence_id"]].append((p["offset"], p["length"]))
        shares[p["sequence_id"]][p["source"]] += p["length"]
    for i, own in ids.items():
        at = 0
        for start, length in sorted(found[i]):
            assert start == at
            at += length
        assert at == len(own)
    sizes = []
    for own in windows.values():
        at = 0
        for offset, length in sorted(own):
            assert offset == at
            at += length
        sizes.append(at)
    total = sum(map(len, ids.values()))
    blocks = -(-total // block_tokens)
    assert max(sizes) <= packing.WINDOW and sum(s < packing.WINDOW for s in sizes) <= blocks
    if blocks == 1:
        share = sum(len(ids[i]) for i, s, _ in data if s == "a") / total
        full = [c["a"] / packing.WINDOW for k, c in shares.items() if sum(c.values()) == packing.WINDOW]
        assert all(abs(x - share) < 0.1 for x in full)


def test_repeated_rows_and_empty(rows):
    df = rows("doc_id bigint, source string, text string", (1, "a", "same"), (1, "a", "same"))
    assert sorted((p["doc_id"], p["length"]) for p in packing.pack(df, PATH).collect()) == [(1, 2), (1, 2)]
    assert packing.pack(rows("doc_id bigint, source string, text string"), PATH).count() == 0


@pytest.mark.parametrize("block_tokens", [1 << 21, 15_000])
def test_another_mixture(rows, block_tokens):
    rng = random.Random(12)
    many = {"a": 240, "b": 60, None: 20, "c": 10}
    sources = [s for s, n in many.items() for _ in range(n)]
    rng.shuffle(sources)
    data = [(i, s, " ".join(["the"] * rng.randint(100, 300))) for i, s in enumerate(sources)]
    df = rows("doc_id bigint, source string, text string", *data)
    pieces = packing.pack(df, PATH, block_tokens, {"a": 1, "b": 2, None: 1, "nowhere": 5}).collect()
    pieces.sort(key=lambda p: (p["sequence_id"], p["offset"]))
    # Whole: every token of every document once, and in full windows but for the last of a block.
    spans = defaultdict(list)
    for p in pieces:
        spans[p["doc_id"], p["doc_tokens"]].append((p["start"], p["start"] + p["length"]))
    assert len(spans) == len(data)
    for (_, n), own in spans.items():
        own.sort()
        assert [0, *(e for _, e in own)] == [*(b for b, _ in own), n]
    sizes, served, total = Counter(), Counter(), 0
    for p in pieces:
        sizes[p["source"]] += p["length"]
    filled = Counter()
    for p in pieces:
        filled[p["sequence_id"]] += p["length"]
    blocks = -(-sum(sizes.values()) // block_tokens)
    assert max(filled.values()) <= packing.WINDOW and sum(n < packing.WINDOW for n in filled.values()) <= blocks
    slack = packing.WINDOW + packing.LEAST_PIECE * 4
    for p in pieces:
        served[p["source"]] += p["length"]
        total += p["length"]
        if max(served["b"], 2 * served[None]) < min(sizes["b"], 2 * sizes[None]) - slack:
            assert abs(served["b"] - total / 2) < slack and abs(served["a"] - total / 4) < slack
        if served["c"] > slack:
            assert served["a"] >= sizes["a"] - slack
    with pytest.raises(ValueError):
        packing.pack(df, PATH, shares={"a": 0})


def test_shares_of_the_table_deal_as_by_default():
    sizes = [(0, 5_000), (1, 1_000), (2, 90_000)]
    assert Counter(packing.deal(sizes, shares=dict(sizes))) == Counter(packing.deal(sizes))


def test_words_are_encoded_in_short_runs_with_a_mark_between(tokenizer, monkeypatch):
    """A text holding the mark itself keeps its ids, and no run holds more words than it should."""
    coder, seen = packing.WordCodec(PATH), []
    ids = coder._ids
    monkeypatch.setattr(coder, "_ids", lambda text: seen.append(text) or ids(text))
    texts = [" ".join(f"w{i}x" for i in range(1000)), "a\x01b \x01 \x01\x01 c", "", "\x01"]
    assert coder.short(texts) == [np.array(tokenizer.encode(t, add_special_tokens=False).ids, "<u2").tobytes() for t in texts]
    assert max(len(text.split(packing.MARK)) for text in seen if "w1x" in text) == packing.TOGETHER + 1


def test_special_tokens_are_told_by_their_case(tokenizer):
    texts = ["<|ENDOFTEXT|>", "A <|EndOfText|> b", "<|endoftext|> <|ENDOFTEXT|>"]
    want = [np.array(tokenizer.encode(t, add_special_tokens=False).ids, "<u4").tobytes() for t in texts]
    assert packing.WordCodec(PATH).encode(texts) == want


def test_plain_words_share_pieces(tokenizer, monkeypatch):
    """Plain words are not normalized and parted again; others, and those of another tokenizer, are."""
    texts = ["Don't (don't) DON'T. don't'sx --'s ''ll <|ENDOFTEXT|> a<|endoftext|>b", "don't! \x01! é Don't, x1! ~'T'"]
    want = [np.array(tokenizer.encode(t, add_special_tokens=False).ids, "<u2").tobytes() for t in texts]
    coder, seen = packing.WordCodec(PATH), []
    encode = coder._encode
    monkeypatch.setattr(coder, "_encode", lambda words: seen.extend(words) or encode(words))
    assert coder.short(texts) == want
    assert {*seen} == {b"a<|endoftext|>b", b"\x01!", "é".encode(), b"x1!"}
    assert coder.parted
    other = packing.WordCodec(PATH)
    other.parted = False
    assert other.short(texts) == want
