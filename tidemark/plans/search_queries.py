"""Keyword search over the documents."""

from __future__ import annotations

from pyspark.sql import DataFrame

from tidemark.operators import search
from tidemark.plans.registry import query
from tidemark.plans.tables import Tables

SEARCH_FOR = "Tion der the"
TERMS = ("tion", "der", "the")

_SCORE = " + ".join(f"(length(lower(text)) - length(replace(lower(text), '{w}', ''))) // {len(w)}" for w in TERMS)
_SEARCH_SQL = f"SELECT doc_id, ({_SCORE})::BIGINT AS score FROM documents WHERE {_SCORE} > 0 ORDER BY score DESC, doc_id LIMIT 5"
_HOLDS = " OR ".join(f"contains(lower(line), '{w}')" for w in TERMS)


@query("keyword_search", _SEARCH_SQL)
def keyword_search(t: Tables) -> DataFrame:
    return search.keyword_search(t.raw("documents"), SEARCH_FOR)


@query("search_snippets", f"""
    WITH lines AS (SELECT doc_id, score, unnest(string_split(text, chr(10))) AS line,
        generate_subscripts(string_split(text, chr(10)), 1) AS n FROM documents JOIN ({_SEARCH_SQL}) USING (doc_id)),
    hits AS (SELECT doc_id, score, n, row_number() OVER (PARTITION BY doc_id ORDER BY n) AS snippet_number FROM lines WHERE {_HOLDS})
    SELECT h.doc_id, h.score, h.snippet_number::INTEGER AS snippet_number, string_agg(l.line, chr(10) ORDER BY l.n) AS snippet
    FROM hits h JOIN lines l ON l.doc_id = h.doc_id AND l.n BETWEEN h.n - 2 AND h.n + 2
    WHERE snippet_number <= 3 GROUP BY 1, 2, 3""")
def search_snippets(t: Tables) -> DataFrame:
    return search.search_snippets(t.raw("documents"), SEARCH_FOR)
