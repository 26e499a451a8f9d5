"""The registered queries in DuckDB SQL, where SQL can express them on whole tables."""

from __future__ import annotations

from deskrisk.llm.licences import COPYRIGHT_LINE, KNOWN, SEPARATORS, SPELLINGS


def _text(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def _canonical(line: str) -> str:
    out = f"trim(regexp_replace(lower({line}), {_text(SEPARATORS)}, ' ', 'g'))"
    for variant, usual in SPELLINGS:
        out = f"regexp_replace({out}, '\\b{variant}\\b', '{usual}', 'g')"
    return f"CASE WHEN regexp_matches(lower({line}), {_text(COPYRIGHT_LINE)}) THEN '' ELSE {out} END"


def _lines(text: str) -> str:
    return f"list_filter(list_transform(string_split(coalesce({text}, ''), chr(10)), lambda x: {_canonical('x')}), lambda x: x <> '')"


LICENCES = f"""
WITH known AS (
  SELECT sha256(array_to_string({_lines('t')}, ' ')) AS digest, min(l) AS licence
  FROM (VALUES {", ".join(f"({_text(n)}, {_text(t)})" for n, t in KNOWN)}) AS k(l, t) GROUP BY 1
),
doc AS (SELECT doc_id, {_lines('text')} AS lines FROM documents),
unit AS (
  SELECT doc_id, FALSE AS whole, sha256(unnest(lines)) AS digest FROM doc
  UNION ALL SELECT doc_id, TRUE, sha256(array_to_string(lines, ' ')) FROM doc
)
SELECT doc_id, count(licence) FILTER (NOT whole) AS n_notices,
  coalesce(array_to_string(list_sort(list(DISTINCT licence) FILTER (licence IS NOT NULL)), ','), '') AS licences,
  coalesce(max(licence) FILTER (whole), '') AS whole_text
FROM unit LEFT JOIN known USING (digest) GROUP BY doc_id
"""

_WORDS = (
    "list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), "
    "'[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+'), lambda x: x <> '')"
)
LEAKS = f"""
WITH item AS (SELECT item_id, {_WORDS} AS w FROM benchmark),
win AS (
  SELECT DISTINCT item_id, n, array_to_string(list_slice(w, a, a + n - 1), ' ') AS win
  FROM (SELECT item_id, w, least(len(w), 10) AS n, unnest(generate_series(1, len(w) - least(len(w), 10) + 1)) AS a
        FROM item WHERE len(w) > 0)
),
doc AS (SELECT doc_id, {_WORDS} AS w FROM documents),
size AS (SELECT DISTINCT n FROM win),
place AS (
  SELECT doc_id, n, a, array_to_string(list_slice(w, a, a + n - 1), ' ') AS win
  FROM (SELECT doc_id, w, n, unnest(generate_series(1, len(w) - n + 1)) AS a FROM doc JOIN size ON len(w) >= n)
),
hit AS (SELECT place.doc_id, place.a, place.n, win.item_id FROM place JOIN win ON place.n = win.n AND place.win = win.win),
word AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(generate_series(a, a + n - 1)) AS p FROM hit) GROUP BY 1),
found AS (SELECT doc_id, list_sort(list(DISTINCT CAST(item_id AS VARCHAR))) AS items FROM hit GROUP BY 1)
SELECT doc.doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, CAST(coalesce(len(items), 0) AS BIGINT) AS n_items,
  sha256(coalesce(array_to_string(items, ','), '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM doc LEFT JOIN word USING (doc_id) LEFT JOIN found USING (doc_id)
"""

SQL = {"op7_decontamination": LEAKS, "op9_licence_scan": LICENCES}
