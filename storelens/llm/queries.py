"""One query for each operator, over its whole table, and check SQL where SQL can express it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

import public_tokenizers

from storelens.llm import bpe, exact, hosts, language, lm, manifest, near, neighbours, packing, passages, quality, turns, urls
from storelens.llm.common import fold, table

QUERIES: dict[str, Callable] = {}
ORACLE_SQL: dict[str, str] = {}


def query(function: Callable) -> Callable:
    QUERIES[function.__name__] = function
    return function


@query
def op1_substring_dedup(spark, folder) -> DataFrame:
    found = passages.remove_repeats(table(spark, folder, "documents").select("doc_id", "text"))
    return found.select("doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))


@query
def op2_exact_dedup(spark, folder) -> DataFrame:
    marked = exact.mark_copies(table(spark, folder, "documents").select("doc_id", "text"))
    return marked.select("doc_id", "keep_id", "group_size", "kept", "text_sha256")


@query
def op3_nearest(spark, folder) -> DataFrame:
    return neighbours.nearest(table(spark, folder, "embeddings").select("vec_id", "embedding"))


@query
def op4_byte_bpe(spark, folder) -> DataFrame:
    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    documents = table(spark, folder, "documents").select("doc_id", "text")
    found = bpe.encode_documents(documents, path, public_tokenizers.PATTERN)
    return found.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


@query
def op5_recurrent_lm(spark, folder) -> DataFrame:
    documents = table(spark, folder, "documents").select("doc_id", "text")
    held_out = fold("doc_id", 7) == 2
    scored = lm.score_documents(documents, ~held_out)
    return scored.select(
        "doc_id", held_out.alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score"
    )


@query
def op6_language_id(spark, folder) -> DataFrame:
    found = language.identify(table(spark, folder, "documents").select("doc_id", "text", "lang"))
    return found.select("doc_id", (fold("doc_id", 4) == 2).alias("held_out"), "lang_pred", "score")


@query
def op7_minhash(spark, folder) -> DataFrame:
    documents = table(spark, folder, "documents").select("doc_id", "text")
    found = near.near_components(documents, size=3, percent=85)
    return found.select("doc_id", "n_shingles", "component_id", "kept")


@query
def op8_url_rules(spark, folder) -> DataFrame:
    judged = urls.judge_urls(table(spark, folder, "pages").select("page_id", "url"))
    return judged.select("page_id", "host", "path", "rule", "verdict")


@query
def op9_packing(spark, folder) -> DataFrame:
    documents = table(spark, folder, "documents").select("doc_id", "source", "text")
    return packing.pack(documents, public_tokenizers.path("word_bpe_49k.json")).drop("ids", "source")


@query
def op10_quality(spark, folder) -> DataFrame:
    documents = table(spark, folder, "documents").select("doc_id", "text")
    scored = quality.quality_scores(documents, table(spark, folder, "labels"))
    return scored.select("doc_id", (fold("doc_id", 4) == 2).alias("held_out"), "score", "predicted")


@query
def op11_conversation_repair(spark, folder) -> DataFrame:
    conversations = table(spark, folder, "conversations").select("conv_id", "turn", "role", "text")
    return turns.reports(turns.repair(turns.damage(conversations)))


@query
def op12_merkle_manifest(spark, folder) -> DataFrame:
    documents = table(spark, folder, "documents").select("doc_id", "source", "lang", "n_chars", "text")
    tampered = F.when(fold("doc_id", 2) == 0, F.translate("text", "\n", "")).otherwise(F.col("text"))
    proven = manifest.manifest(documents, tampered)
    proof = F.sha2("siblings", 256).alias("proof_sha256")
    return proven.select("doc_id", "leaf", "subroot", "root", proof, "folded_root", "verified")


@query
def op13_host_rules(spark, folder) -> DataFrame:
    judged = hosts.judge(table(spark, folder, "documents").select("doc_id", "source", "text"))
    return judged.select("doc_id", *hosts.MEASURES[:5], "base_failed", "kept")


_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

ORACLE_SQL["op2_exact_dedup"] = f"""
SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
       doc_id = max(doc_id) OVER same AS kept, sha256(t) AS text_sha256
FROM (SELECT doc_id, {_LOWER} AS t FROM documents)
WINDOW same AS (PARTITION BY t)
"""

_WORDS = r"regexp_extract_all({}, '[^\x20\x09-\x0D]+')"

ORACLE_SQL["op1_substring_dedup"] = f"""
WITH d AS (SELECT doc_id, {_WORDS.format("coalesce(text, '')")} AS w FROM documents),
p AS (SELECT doc_id, w, unnest(range(1, len(w) - 33)) AS i FROM d WHERE len(w) >= 35),
k AS (SELECT doc_id, i, array_to_string(w[i:i + 34], ' ') AS t FROM p),
r AS (SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY t) AS c FROM k) WHERE c > 1),
gone AS (SELECT DISTINCT doc_id, unnest(range(i, i + 35)) AS i FROM r),
g AS (SELECT doc_id, list(i) AS gone FROM gone GROUP BY doc_id),
j AS (SELECT d.doc_id, w, coalesce(gone, []) AS gone FROM d LEFT JOIN g USING (doc_id))
SELECT doc_id, len(w)::BIGINT AS n_words, len(gone)::BIGINT AS n_removed,
       sha256(array_to_string(list_filter(w, lambda x, i: NOT list_contains(gone, i)), ' ')) AS kept_sha256
FROM j
"""

ORACLE_SQL["op7_minhash"] = f"""
WITH RECURSIVE d AS (SELECT doc_id, {_WORDS.format(_LOWER)} AS w FROM documents),
s AS (SELECT doc_id, unnest(CASE WHEN len(w) >= 3
             THEN list_distinct(list_transform(range(1, len(w) - 1), lambda i: array_to_string(w[i:i + 2], ' ')))
             WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END) AS t FROM d),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
c AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM s a JOIN s b ON a.t = b.t AND a.doc_id < b.doc_id
      GROUP BY ALL),
l AS (SELECT a, b FROM c JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * c >= 85 * (x.n + y.n - c)),
e AS (SELECT a, b FROM l UNION ALL SELECT b, a FROM l),
reach AS (SELECT a, b FROM e UNION SELECT r.a, e.b FROM reach r JOIN e ON r.b = e.a)
SELECT d.doc_id, coalesce(n, 0)::BIGINT AS n_shingles, least(d.doc_id, coalesce(m, d.doc_id)) AS component_id,
       d.doc_id = least(d.doc_id, coalesce(m, d.doc_id)) AS kept
FROM d LEFT JOIN n USING (doc_id) LEFT JOIN (SELECT a AS doc_id, min(b) AS m FROM reach GROUP BY a) USING (doc_id)
"""


def _crc32(text: str) -> str:
    """DuckDB SQL for the checksum of a text of ASCII characters; reads the list of the CTE `crc`."""
    codes = f"list_transform(string_split({text}, ''), lambda x: ascii(x)::BIGINT)"
    step = "lambda c, b: xor(c >> 8, crc_of[xor(c & 255, b) + 1])"
    return f"xor(list_reduce(list_concat([4294967295::BIGINT], {codes}), {step}), 4294967295::BIGINT)"


_CRC = """crc AS (SELECT list_transform(range(256), lambda x: list_reduce(list_concat([x], range(8)), lambda c, b:
  CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384::BIGINT) ELSE c >> 1 END)) AS crc_of)"""

# A label is the cost in nine digits, then the audit, so that the least label is wanted. Labels
# q0 to q3 belong to the states of the pattern, which start at nothing, after s, after u, after a.
_STATES = range(4)
_MOVES = {0: 2, 1: 2, 2: 3, 3: 2}


def _plus(label: str, cost: str, edit: str) -> str:
    return f"printf('%09d', left({label}, 9)::BIGINT + {cost}) || substr({label}, 10) || '{edit}'"


def _inserted(labels: list[str]) -> list[str]:
    into = {2: [0, 1, 3], 3: [2]}
    return [
        f"list_min([{', '.join([labels[q], *[_plus(labels[p], '5', 'I') for p in into[q]]])}])" if q in into else labels[q]
        for q in _STATES
    ]


def _closed(source: str) -> str:
    """Labels after any insertions; a third one in a row leads nowhere new."""
    named = [f"q{q}" for q in _STATES]
    once = ", ".join(f"{x} AS q{q}" for q, x in enumerate(_inserted(named)))
    return f"SELECT * REPLACE ({once}) FROM (SELECT * REPLACE ({once}) FROM {source})"


def _used(q: int) -> str:
    """The label of state q after one more row: deleted, kept or reroled."""
    ways = [_plus(f"q{q}", "2", "D")]
    if q == 1:
        ways.append(f"CASE WHEN NOT gone AND initial = 's' THEN {_plus('q0', 'more', 'K')} END")
    for p in [p for p in _STATES if _MOVES[p] == q]:
        letter = "u" if q == 2 else "a"
        ways.append(f"CASE WHEN NOT gone AND initial = '{letter}' THEN {_plus(f'q{p}', 'more', 'K')} END")
        ways.append(f"CASE WHEN NOT gone THEN {_plus(f'q{p}', '1 + more', 'R')} END")
    return f"list_min([{', '.join(ways)}]) AS q{q}"


ORACLE_SQL["op11_conversation_repair"] = f"""
WITH RECURSIVE {_CRC},
k AS (SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
      {_crc32("coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ')")} % 20 AS k FROM conversations, crc),
d AS (SELECT conv_id, turn, CASE WHEN k = 4 THEN 'user' ELSE role END AS role,
      CASE k WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
      unnest(range(CASE k WHEN 3 THEN 2 ELSE 1 END)) AS copy FROM k WHERE k <> 0),
r AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text, copy) AS i,
      row_number() OVER (PARTITION BY conv_id, role, text ORDER BY turn NULLS FIRST, copy) > 1 AS again,
      regexp_replace(text, '[\x20\x09-\x0D]+', '', 'g') AS bare FROM d),
f AS (SELECT *, bare = '' AS blank, bare <> '' AND again AS repeated,
      bare <> '' AND NOT again AND right(bare, 1) NOT IN ('.', '!', '?') AS cut, left(role, 1) AS initial,
      lag(left(role, 1)) OVER (PARTITION BY conv_id ORDER BY i) AS before FROM r),
c AS (SELECT conv_id, count(*) AS n, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
      count(*) FILTER (blank) AS blank, count(*) FILTER (repeated) AS duplicate, count(*) FILTER (cut) AS truncated,
      count(*) FILTER (before || initial NOT IN ('su', 'ua', 'au')) AS illegal FROM f GROUP BY conv_id),
steps AS (
  SELECT conv_id, 0::BIGINT AS i, n, '000000000' AS q0, NULL::VARCHAR AS q1, NULL::VARCHAR AS q2, NULL::VARCHAR AS q3 FROM c
  UNION ALL
  SELECT conv_id, i, n, {", ".join(_used(q) for q in _STATES)}
  FROM (SELECT s.* EXCLUDE (i), f.i, f.initial, blank OR repeated AS gone, CASE WHEN cut THEN 5 ELSE 0 END AS more
        FROM ({_closed("steps")}) s JOIN f ON f.conv_id IS NOT DISTINCT FROM s.conv_id AND f.i = s.i + 1)),
best AS (SELECT conv_id, list_min([q0, q3]) AS label FROM ({_closed("steps")}) WHERE i = n),
-- The label is walked once more, to make the turns that it stands for.
made AS (
  SELECT conv_id, 0::BIGINT AS pos, 0::BIGINT AS i, 0 AS q, substr(label, 10) AS audit, '' AS line FROM best
  UNION ALL
  SELECT m.conv_id, m.pos + 1, CASE WHEN e = 'I' THEN m.i ELSE m.i + 1 END,
         CASE WHEN e = 'D' THEN q WHEN e = 'K' AND f.initial = 's' THEN 1 WHEN q = 2 THEN 3 ELSE 2 END, audit,
         CASE WHEN e = 'D' THEN NULL WHEN e = 'K' THEN f.role || ':' || f.text
              ELSE CASE WHEN q = 2 THEN 'assistant' ELSE 'user' END || ':' || CASE WHEN e = 'I' THEN '' ELSE f.text END END
  FROM (SELECT *, substr(audit, pos + 1, 1) AS e FROM made WHERE pos < length(audit)) m
  LEFT JOIN f ON f.conv_id IS NOT DISTINCT FROM m.conv_id AND f.i = m.i + 1),
texts AS (SELECT conv_id, string_agg(line, chr(10) ORDER BY pos) AS whole FROM made WHERE pos > 0 GROUP BY conv_id)
SELECT o.conv_id, coalesce(gaps, 0)::BIGINT AS gaps, coalesce(blank, 0)::BIGINT AS blank, coalesce(duplicate, 0)::BIGINT AS duplicate,
       coalesce(truncated, 0)::BIGINT AS truncated, coalesce(illegal, 0)::BIGINT AS illegal,
       coalesce(left(label, 9)::BIGINT, 0) AS cost, coalesce(substr(label, 10), '') AS audit,
       sha256(coalesce(whole, '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) o
LEFT JOIN c ON c.conv_id IS NOT DISTINCT FROM o.conv_id
LEFT JOIN best ON best.conv_id IS NOT DISTINCT FROM o.conv_id
LEFT JOIN texts ON texts.conv_id IS NOT DISTINCT FROM o.conv_id
"""


def _field(name: str) -> str:
    return f"coalesce(strlen({name}::VARCHAR) || ':' || {name}, '-')"


# Levels of either tree that the check query writes out: 3 ** 14 leaves or sources.
_LEVELS = range(14)


def _tree(name: str, leaves: str) -> str:
    """CTEs with the nodes of each level of trees; `leaves` has tree, i, h. A last node stays as it is."""
    parts = [f"{name}0 AS (SELECT *, count(*) OVER (PARTITION BY tree) AS n FROM ({leaves}))"]
    for level in _LEVELS:
        parts.append(
            f"{name}{level + 1} AS (SELECT *, count(*) OVER (PARTITION BY tree) AS n FROM (SELECT tree, i // 3 AS i, list(h ORDER BY i) AS kids, "
            f"CASE WHEN any_value(n) = 1 THEN any_value(h) ELSE sha256(string_agg(h, '' ORDER BY i)) END AS h "
            f"FROM {name}{level} GROUP BY tree, i // 3))"
        )
    return ", ".join(parts)


def _walked(name: str, start: str) -> str:
    """CTEs that take rows with tree, i, now and proof up the tree, one level each."""
    parts = [f"{name}w0 AS ({start})"]
    for level in _LEVELS:
        others = "array_to_string(list_concat({0}, {1}), '')".format("p.kids[:w.i % 3]", "p.kids[w.i % 3 + 2:]")
        folded = "sha256(array_to_string(list_concat(list_concat(p.kids[:w.i % 3], [now]), p.kids[w.i % 3 + 2:]), ''))"
        parts.append(
            f"{name}w{level + 1} AS (SELECT w.* REPLACE (w.i // 3 AS i, CASE WHEN b.n = 1 THEN now ELSE {folded} END AS now, "
            f"proof || CASE WHEN b.n = 1 THEN '' ELSE {others} END AS proof) "
            f"FROM {name}w{level} w JOIN {name}{level} b ON b.tree IS NOT DISTINCT FROM w.tree AND b.i = w.i "
            f"JOIN {name}{level + 1} p ON p.tree IS NOT DISTINCT FROM w.tree AND p.i = w.i // 3)"
        )
    return ", ".join(parts)


_LAST = len(_LEVELS)
ORACLE_SQL["op12_merkle_manifest"] = f"""
WITH {_CRC},
d AS (SELECT *, CASE WHEN {_crc32("doc_id::VARCHAR")} % 2 = 0 THEN replace(text, chr(10), '') ELSE text END AS t FROM documents, crc),
l AS (SELECT doc_id, source, sha256({" || ".join(_field(c) for c in ("doc_id", "source", "lang", "n_chars", "text"))}) AS h,
      sha256({" || ".join(_field(c) for c in ("doc_id", "source", "lang", "n_chars", "t"))}) AS other FROM d),
o AS (SELECT *, row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, h) - 1 AS i FROM l),
{_tree("a", "SELECT source AS tree, i, h FROM o")},
subroots AS (SELECT tree AS source, h AS subroot, row_number() OVER (ORDER BY tree NULLS FIRST) - 1 AS i FROM a{_LAST}),
{_tree("b", "SELECT 0 AS tree, i, subroot AS h FROM subroots")},
{_walked("a", "SELECT source AS tree, i, other AS now, '' AS proof, doc_id, h AS leaf FROM o")},
{_walked("b", f"SELECT 0 AS tree, s.i, now, proof, doc_id, leaf, subroot FROM aw{_LAST} w JOIN subroots s ON s.source IS NOT DISTINCT FROM w.tree")}
SELECT doc_id, leaf, subroot, h AS root, sha256(proof) AS proof_sha256, now AS folded_root, now = h AS verified
FROM bw{_LAST}, (SELECT h FROM b{_LAST})
"""

_REPEAT_WORDS = "[^\\x20\\x09-\\x0D]+"
ORACLE_SQL["op13_host_rules"] = f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, source, coalesce(text, '') AS t FROM documents),
w AS (SELECT r, doc_id, source, t, regexp_extract_all(t, '{_REPEAT_WORDS}') AS w FROM d),
u AS (SELECT r, unnest(w) AS x, generate_subscripts(w, 1) AS i FROM w),
p AS (SELECT r, i, string_agg(x, ' ') OVER eight AS t, count(*) OVER eight AS n FROM u
      WINDOW eight AS (PARTITION BY r ORDER BY i ROWS BETWEEN CURRENT ROW AND 7 FOLLOWING)),
k AS (SELECT r, i, count(*) OVER (PARTITION BY r, t) AS c FROM p WHERE n = 8),
g AS (SELECT r, count(DISTINCT j) AS n FROM (SELECT r, unnest(range(i, i + 8)) AS j FROM k WHERE c > 1) GROUP BY r),
x AS (SELECT r, unnest(string_split(t, chr(10))) AS line FROM d),
y AS (SELECT r, count(*) AS lines, count(*) - count(DISTINCT line) AS again FROM x WHERE regexp_matches(line, '{_REPEAT_WORDS}') GROUP BY r),
m AS (SELECT doc_id, source, len(w)::BIGINT AS n_words, length(array_to_string(w, ''))::BIGINT AS word_chars,
      length(regexp_replace(t, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols, coalesce(again, 0)::BIGINT AS n_dup_lines,
      coalesce(n, 0)::BIGINT AS n_repeat_words, coalesce(lines, 0)::BIGINT AS n_lines
      FROM w LEFT JOIN g USING (r) LEFT JOIN y USING (r)),
b AS (SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed FROM m),
f AS (SELECT *, base_failed OR 10 * n_symbols > n_words OR (n_words > 0 AND (word_chars < 3 * n_words OR word_chars > 10 * n_words))
      OR 10 * n_dup_lines > 3 * n_lines AS failed FROM b),
h AS (SELECT source, count(*)::DOUBLE AS docs, (count(*) FILTER (failed))::DOUBLE AS bad FROM f WHERE source IS NOT NULL GROUP BY source),
s AS (SELECT count(*) AS k, sum(docs) AS n, sum(bad) / sum(docs) AS rate, sum(docs * docs) AS squares, sum(bad * bad / docs) AS spread FROM h),
q AS (SELECT *, rate * (1 - rate) AS inside, n - squares / n AS wide FROM s),
a AS (SELECT *, CASE WHEN k < 2 OR inside = 0 OR wide <= k - 1 THEN 0
      ELSE (spread - n * rate * rate - (k - 1) * inside) / ((wide - (k - 1)) * inside) END AS alike FROM q),
z AS (SELECT rate, CASE WHEN alike > 0 THEN least(greatest((1 - alike) / alike, 2.0), 1000.0) ELSE 1000.0 END AS weight FROM a),
v AS (SELECT source, (bad + rate * weight) / (docs + weight) > 0.5 AS rejected FROM h, z)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND NOT coalesce(rejected, false) AS kept
FROM f LEFT JOIN v USING (source)
"""
