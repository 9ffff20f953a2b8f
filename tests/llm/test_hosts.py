from __future__ import annotations

import random
import re
from collections import Counter

import numpy as np
import pytest
from brute import words

from storelens.llm import hosts


def expected(text):
    text = text or ""
    w = words(text)
    windows = [tuple(w[i : i + 8]) for i in range(len(w) - 7)]
    count = Counter(windows)
    covered = {i + k for i, x in enumerate(windows) if count[x] > 1 for k in range(8)}
    lines = [line for line in text.split("\n") if words(line)]
    return (len(w), sum(map(len, w)), len(re.findall("[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(covered), len(lines))


def sample(seed, n):
    rng = random.Random(seed)
    texts = [None, "", "\n", " \t\n", "#", "a\na\na \n a", "\x85 \xa0 é", "one two three four five six seven eight " * 2, "a " * 9, "a " * 8]
    for _ in range(n):
        letters = rng.choice(["ab \n", "aé# \n\t", "ab  \x0b\x0c\r\n<>&", "xyz \n\U0001f600"])
        texts.append("".join(rng.choices(letters, k=rng.randint(0, 120))))
    return texts


def test_measures_against_brute_force():
    texts = sample(1, 300)
    found = hosts.measures([(t or "").encode() for t in texts])
    got = list(zip(*(found[name].tolist() for name in hosts.MEASURES)))
    assert got == [expected(t) for t in texts]
    assert all(len(v) == 0 for v in hosts.measures([]).values())


def test_windows_do_not_reach_into_the_next_text():
    eight = b"a b c d e f g h"
    assert hosts.measures([eight, eight])["n_repeat_words"].tolist() == [0, 0]
    assert hosts.measures([eight + b" " + eight])["n_repeat_words"].tolist() == [16]


def documents(rows, *data):
    return rows("doc_id bigint, source string, text string, kept string, lang string", *[(*d, "old", "l") for d in data])


GOOD = " ".join(f"word{i}" for i in range(40))
BAD = "too short"


def test_a_failing_host_goes_and_small_hosts_stay_near_the_prior(rows):
    data = [(i, "spam", BAD if i % 10 else GOOD) for i in range(200)]
    data += [(1000 + i, f"good{i % 20}", GOOD if i % 25 else BAD) for i in range(2000)]
    data += [(5000, "new", BAD), (5001, "new", GOOD), (5002, None, GOOD), (5003, None, BAD), (None, "good1", GOOD)]
    got = {r["doc_id"]: r for r in hosts.judge(documents(rows, *data)).collect()}
    assert not any(got[i]["kept"] for i in range(200))
    assert all(got[1000 + i]["kept"] == bool(i % 25) for i in range(2000))
    assert got[5001]["kept"] and not got[5000]["kept"]
    assert got[5002]["kept"] and not got[5003]["kept"] and got[5002]["host_rate"] is None
    assert got[None]["kept"] and got[1000]["lang"] == "l"


def test_prior_from_hosts(rows, spark):
    """Rates drawn from a known beta distribution are found again; equal rates give the most weight."""
    rng = np.random.default_rng(3)
    rates = rng.beta(2.0, 6.0, 4000)
    data = [(f"h{i}", int(n), int(rng.binomial(n, p))) for i, (n, p) in enumerate(zip(rng.integers(5, 200, 4000), rates))]
    prior = hosts.fit_prior(rows("source string, docs bigint, failed bigint", *data))
    assert prior.rate == pytest.approx(0.25, abs=0.01) and prior.weight == pytest.approx(8.0, rel=0.1)
    alike = hosts.fit_prior(rows("source string, docs bigint, failed bigint", ("a", 100, 20), ("b", 50, 10)))
    assert alike == hosts.Prior(0.2, hosts.MOST_PRIOR)
    one = hosts.fit_prior(rows("source string, docs bigint, failed bigint", ("a", 10, 4)))
    assert one == hosts.Prior(0.4, hosts.MOST_PRIOR)


def test_host_verdicts_count_each_rule(rows):
    judged = hosts.measured(documents(rows, (1, "a", BAD), (2, "a", GOOD), (3, "b", GOOD)))
    assert sorted((r["doc_id"], r["n_words"]) for r in judged.collect()) == [(1, 2), (2, 40), (3, 40)]


def test_a_very_long_text_and_an_empty_table(rows):
    text = "word " * 1_000_000
    (r,) = hosts.judge(documents(rows, (1, "a", text))).collect()
    assert r["n_words"] == 1_000_000 and r["n_repeat_words"] == 1_000_000 and r["base_failed"] and not r["kept"]
    assert hosts.judge(documents(rows)).count() == 0
