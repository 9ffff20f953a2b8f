from __future__ import annotations

import random

import numpy as np

from storelens.llm import language


def sample(rng, letters, n):
    return " ".join("".join(rng.choices(letters, k=rng.randint(2, 7))) for _ in range(n))


def test_automaton_accepts_substrings_only():
    rng = random.Random(3)
    text = [rng.randrange(3) for _ in range(60)]
    moves = language.suffix_automaton(np.array(text))
    parts = {tuple(text[i:j]) for i in range(60) for j in range(i + 1, min(i + 6, 61))}

    def accepts(word):
        state = 0
        for symbol in word:
            state = moves[state].get(symbol)
            if state is None:
                return False
        return True

    words = {tuple(rng.randrange(3) for _ in range(rng.randint(1, 5))) for _ in range(500)}
    assert all(accepts(w) == (w in parts) for w in words)


def test_phrases_are_longest_matches():
    rng = random.Random(4)
    known = {"x": [sample(rng, "abcde", 60)], "y": [sample(rng, "bcdef", 60)]}
    model = language.Languages(known)
    text = sample(rng, "abcdefg", 900)
    symbols = language.to_symbols(text, model.symbols).tolist()
    for row, name in zip(model.phrases([np.array(symbols, np.uint8)]), model.names):
        learnt = [s for t in known[name] for s in (*language.to_symbols(t, model.symbols).tolist(), 0)]
        joined = bytes(learnt)
        count = 0
        for at in range(0, len(symbols), language.BLOCK):
            block, phrase = bytes(symbols[at : at + language.BLOCK]), b""
            for symbol in block:
                phrase += bytes([symbol])
                if phrase not in joined:
                    count += 1
                    phrase = bytes([symbol]) if bytes([symbol]) in joined else b""
        assert row[0] == count


def test_languages_are_told_apart(rows):
    rng = random.Random(6)
    letters = {"aa": "abcdef", "bb": "defghi", "cc": "éèàbcd"}
    data = [(i, sample(rng, letters[lang], 40), lang) for i, lang in enumerate([*letters] * 40)]
    data += [(1000, None, "aa"), (1001, "", "bb"), (1002, "12 !? 9", None), (1003, "ABCFED fab", None), (None, "def", None)]
    df = rows("doc_id bigint, text string, lang string, score string", *[(*x, "old") for x in data])
    got = {r["doc_id"]: r for r in language.identify(df).collect()}
    assert all(got[i]["lang_pred"] == lang for i, _, lang in data[:120])
    assert [got[i]["lang_pred"] for i in (1000, 1001, 1002)] == ["und"] * 3 and got[1002]["score"] == 0
    assert got[1003]["lang_pred"] == "aa" and 0 < got[1003]["score"] <= 1
    assert got[0]["lang"] == "aa"


def test_nothing_labelled_and_empty(rows):
    df = rows("doc_id bigint, text string, lang string", (1, "abc", None))
    assert language.identify(df).first()["lang_pred"] == "und"
    assert language.identify(df.limit(0)).count() == 0


def test_letters_of_every_script_count(rows):
    rng = random.Random(9)
    letters = {
        "en": "abcdefghijklmnopqrstuvwxyz",
        "el": "αβγδεζηθικλμνξοπρστυφχψω",
        "ru": "абвгдежзийклмнопрстуфхцчшщъыьэюя",
        "ja": [chr(0x3041 + k) for k in range(80)],
        "ko": [chr(0xAC00 + 28 * k) for k in range(300)],
        "zh": [chr(0x4E00 + k) for k in range(9000)],
    }
    data = [(i, sample(rng, letters[x], 200), x) for i, x in enumerate(["en"] * 60 + [x for x in letters for _ in range(8)])]
    data += [(1000 + i, sample(rng, letters[x][: len(letters[x]) // 9], 30), None) for i, x in enumerate(letters)]
    df = rows("doc_id bigint, text string, lang string", *data)
    got = {r["doc_id"]: r["lang_pred"] for r in language.identify(df).collect()}
    assert [got[1000 + i] for i in range(6)] == [*letters]


def test_codes_tell_all_letters_apart():
    letters = [c for c in map(chr, range(0x3400, 0x9FFF)) if c.isalpha()]
    symbols = language.letter_map({"zh": ["".join(letters)]})
    codes = {language.to_symbols(c, symbols).tobytes() for c in letters}
    assert len(codes) == len(letters) and language.to_symbols("q", symbols).tolist() == [language.OTHER]
    assert not any(code[:k] in codes for code in codes for k in range(1, len(code)))
    joined = language.to_symbols(letters[9000] + " " + letters[0], symbols).tolist()
    assert joined == [*language.to_symbols(letters[9000], symbols), 0, *language.to_symbols(letters[0], symbols)]


def test_samples_come_from_whole_texts(rows):
    rng = random.Random(10)
    header = sample(rng, "abcdef", 500)
    data = [(i, sample(rng, "abcdef", 600), "aa") for i in range(30)]
    data += [(100 + i, header + " " + sample(rng, "uvwxyz", 900), "zz") for i in range(30)]
    data += [(200, "abc d", "short"), (201, "", "short"), (300, sample(rng, "uvwxyz", 40), None)]
    df = rows("doc_id bigint, text string, lang string", *data)
    got = language.sample_texts(df)
    assert got["short"] in (["abc d"], ["abc d", ""], [""]) and len(header) > 2048
    texts = [t for _, t, lang in data if lang == "zz"]
    assert all(any(part in text for text in texts) for part in got["zz"])
    # At most 8 segments of 128 characters of each text, and parts of it that follow the header.
    assert sum(map(len, got["zz"])) <= 30 * 1024 and sum(set(p) <= set("uvwxyz ") for p in got["zz"]) > 30
    assert {r["doc_id"]: r["lang_pred"] for r in language.identify(df.filter("doc_id < 200 or doc_id = 300")).collect()}[300] == "zz"
    whole = rows("doc_id bigint, text string, lang string", (1, "é" * 1000, "aa"))
    assert [*language.sample_texts(whole).values()] in ([["é" * 1000]], [])
