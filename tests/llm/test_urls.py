from __future__ import annotations

import random
import re
from collections import Counter
from itertools import combinations

import pytest
from pyspark.sql import functions as F

from storelens.llm import urls


def parts(url):
    found = re.match(r"(?s)^.*?://([^/?#]*)([^?#]*)", url or "")
    if not found:
        return "", ""
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return found[1].translate(lower), found[2]


def fixed(url):
    host, path = parts(url)
    fits = [
        (len(h + p), h + p, v) for v, h, p in urls.RULES if (host == h or host.endswith("." + h)) and path.startswith(p)
    ]
    return max(fits)[1:] if fits else None


URLS = [
    None, "", "no scheme", "http://", "HTTP://WWW.Example.COM/en/1", "http://www.example.com/de/1", "http://example.com",
    "http://example.com?x=/en/", "https://a.b.example.com/en/9?q=1#f", "http://myexample.com/en/1", "x://y://com/",
    "https://shop.net/es/", "https://shop.net/ES/", "https://net/fr/a", "http://a.org/en/1", "http://com/", "http://x.com#/",
    "http://É.com/en/", "http://x.com:80/", "://com/x\n/y",
]


def test_hosts_paths_and_fixed_rules(rows):
    df = rows("page_id bigint, url string", *enumerate(URLS))
    for row in urls.judge_urls(df).collect():
        url = URLS[row["page_id"]]
        assert (row["host"], row["path"]) == parts(url), url
        if fixed(url):
            assert (row["rule"], row["verdict"]) == fixed(url), url
        else:
            assert row["rule"] is None and row["verdict"] in ("allow", "block")


def brute_rules(data, support, confidence):
    need = support * len(data)
    joint, whole = Counter(), Counter()
    for items, label in data:
        for n in range(1, len(items) + 1):
            for part in combinations(sorted(items), n):
                whole[part] += 1
                joint[part, label] += 1
    rules = {k: v / whole[k[0]] for k, v in joint.items() if v >= need and v / whole[k[0]] >= confidence}
    return {
        k: c
        for k, c in rules.items()
        if not any(rules.get((tuple(x for x in k[0] if x != t), k[1]), -1) >= c for t in k[0] if len(k[0]) > 1)
    }


@pytest.mark.parametrize("support, confidence", [(0.05, 0.7), (0.2, 0.9)])
def test_mined_rules_and_matches(rows, support, confidence):
    rng = random.Random(7)
    data = []
    for _ in range(120):
        items = rng.sample("abcdef", rng.randint(1, 4))
        data.append((items, "block" if {"a", "b"} <= set(items) or rng.random() < 0.15 else "allow"))
    mined = urls.mine(rows("tokens array<string>, label string", *data), support, confidence)
    got = {(tuple(r["tokens"]), r["verdict"]): r["confidence"] for r in mined.collect()}
    want = brute_rules(data, support, confidence)
    assert got.keys() == want.keys() and all(abs(got[k] - want[k]) < 1e-12 for k in want)
    asked = [(str(i), list(c)) for i, c in enumerate(combinations("abcdefx", 3))]
    matched = urls.match(rows("url string, tokens array<string>", *asked), mined)
    found = {r["url"]: r["mined"] for r in matched.collect()}
    support_of = {(tuple(r["tokens"]), r["verdict"]): r["support"] for r in mined.collect()}
    for url, items in asked:
        holding = [(c, support_of[k], len(k[0]), k[1]) for k, c in want.items() if set(k[0]) <= set(items)]
        assert found.get(url) == (max(holding)[3] if holding else None)


def test_repeated_rows_clashing_columns_and_empty(rows):
    df = rows("page_id bigint, url string, host string, note string", (1, "http://a.com/", "old", "n"), (1, "http://a.com/", "old", "m"))
    got = urls.judge_urls(df).select("page_id", "host", "note", "verdict").collect()
    assert sorted(map(tuple, got)) == [(1, "a.com", "m", "allow"), (1, "a.com", "n", "allow")]
    assert urls.judge_urls(df.limit(0)).count() == 0


def test_no_python_on_the_main_path(rows):
    df = rows("page_id bigint, url string", *enumerate(URLS))
    plan = urls.judge_urls(df)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow", plan) and F is not None
