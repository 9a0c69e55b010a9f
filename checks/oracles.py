"""Checking SQL for the registered queries, put together from shared WITH parts."""

from __future__ import annotations

TERMS = r"regexp_extract_all(lower({0}), '[\p{{L}}\p{{N}}]+')"


def _terms(text: str) -> str:
    return TERMS.format(text)


def _tokens(text: str) -> str:
    return f"list_filter(regexp_split_to_array({text}, '[ \\t\\n\\x0B\\f\\r]+'), lambda x: x <> '')"


def _trimmed(text: str) -> str:
    return f"trim({text}, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13))"


def _elements(text: str) -> str:
    return (
        f"list_filter(list_transform(string_split({text}, chr(10)), "
        f"lambda x: {_trimmed('x')}), lambda x: x <> '')"
    )


def _sentences(text: str) -> str:
    line = f"regexp_replace({text}, '[ \\t\\x0B\\f\\r]+', ' ', 'g')"
    marked = f"regexp_replace({line}, '([.!?]) ', '\\1' || chr(10), 'g')"
    return (
        f"list_filter(list_transform(string_split({marked}, chr(10)), lambda x: trim(x)), "
        "lambda x: x <> '')"
    )


def _html_text(html: str) -> str:
    for pattern in (
        r"(?s)<!--.*?-->",
        r"(?is)<script\b.*?</script>",
        r"(?is)<style\b.*?</style>",
    ):
        html = f"regexp_replace({html}, '{pattern}', '', 'g')"
    html = f"regexp_replace({html}, '\\s+', ' ', 'g')"
    block = r"(?i)</?(article|body|br|div|footer|h1|head|html|li|nav|p|title|ul)\b[^>]*>"
    html = f"regexp_replace({html}, '{block}', chr(10), 'g')"
    html = f"regexp_replace({html}, '(?s)<[^>]*>', '', 'g')"
    for entity, plain in (
        ("&nbsp;", "' '"),
        ("&middot;", "'·'"),
        ("&copy;", "'©'"),
        ("&quot;", "'\"'"),
        ("&#39;", "chr(39)"),
        ("&lt;", "'<'"),
        ("&gt;", "'>'"),
        ("&amp;", "'&'"),
    ):
        html = f"replace({html}, '{entity}', {plain})"
    return f"array_to_string({_elements(html)}, chr(10))"


def _key(*parts: str) -> str:
    joined = " || chr(31) || ".join(f"{part}::VARCHAR" for part in parts)
    return f"md5({joined})"


# ---- WITH parts


def _chunk_parts(source: str, size: int = 500, overlap: int = 50) -> str:
    """``chunks(doc_key, chunk_no, content)`` from ``source`` = a select of (doc_key, text)."""
    return f"""
chunk_source AS ({source}),
sentence_words AS (
  SELECT doc_key, i, string_split(s[i], ' ') AS w
  FROM (SELECT doc_key, {_sentences('text')} AS s FROM chunk_source), unnest(range(1, len(s) + 1)) AS t(i)),
units AS (
  SELECT doc_key, i, r, array_to_string(w[r * {size} + 1 : (r + 1) * {size}], ' ') AS t,
    least(len(w) - r * {size}, {size}) AS n
  FROM sentence_words, unnest(range(0, (len(w) + {size} - 1) // {size})) AS x(r)),
running AS (
  SELECT doc_key, t, row_number() OVER o AS u,
    sum(n) OVER (PARTITION BY doc_key ORDER BY i, r)::BIGINT AS p
  FROM units WINDOW o AS (PARTITION BY doc_key ORDER BY i, r)),
listed AS (
  SELECT doc_key, list_concat([0::BIGINT], list(p ORDER BY u)) AS ps, list(t ORDER BY u) AS ts
  FROM running GROUP BY doc_key),
bounds AS (
  SELECT doc_key, 0::BIGINT AS chunk_no, 1::BIGINT AS s,
    (len(list_filter(ps, lambda x: x <= {size})) - 1)::BIGINT AS e
  FROM listed
  UNION ALL
  SELECT doc_key, chunk_no + 1, s2,
    (len(list_filter(ps, lambda x: x <= ps[s2] + {size})) - 1)::BIGINT
  FROM (
    SELECT b.doc_key, b.chunk_no, l.ps,
      (len(list_filter(l.ps, lambda x:
        x < greatest(l.ps[b.e + 1] - {overlap}, l.ps[b.e + 2] - {size}))) + 1)::BIGINT AS s2
    FROM bounds b JOIN listed l ON b.doc_key = l.doc_key WHERE b.e < len(l.ts))),
chunks AS (
  SELECT b.doc_key, b.chunk_no, array_to_string(l.ts[b.s : b.e], ' ') AS content
  FROM bounds b JOIN listed l ON b.doc_key = l.doc_key)"""


def _vector_parts(name: str, source: str, dim: int = 256) -> str:
    """``<name>_cells(id, dim, weight)`` and ``<name>_norms`` from a select of (id, text)."""
    return f"""
{name}_counts AS (
  SELECT id, ('0x' || substr(md5(term), 1, 8))::BIGINT % {dim} AS dim, count(*) AS n
  FROM (SELECT id, unnest({_terms('text')}) AS term FROM ({source})) GROUP BY ALL),
{name}_cells AS (
  SELECT id, dim, (n / sqrt(sum(n * n) OVER (PARTITION BY id)))::FLOAT::DOUBLE AS weight
  FROM {name}_counts),
{name}_norms AS (SELECT id, sqrt(sum(weight * weight)) AS norm FROM {name}_cells GROUP BY id)"""


DOCUMENT_CHUNKS = (
    _chunk_parts("SELECT source || '/' || doc_id AS doc_key, text FROM documents")
    + f""",
base AS (
  SELECT {_key('doc_key', 'chunk_no', 'content')} AS id, doc_key AS pdf_name, content FROM chunks)"""
)
BASE = DOCUMENT_CHUNKS + "," + _vector_parts("base", "SELECT id, content AS text FROM base")
QUESTIONS = "questions AS (SELECT item_id AS query_id, text AS query FROM benchmark)"
EVAL_QUESTIONS = f"""questions AS (
  SELECT a.conv_id || '-' || a.turn AS query_id, a.text AS query, b.text AS ground_truth,
    CASE WHEN len({_tokens('a.text')}) <= 20 THEN 'simple' ELSE 'reasoning' END AS evolution_type
  FROM conversations a JOIN conversations b ON a.conv_id = b.conv_id AND b.turn = a.turn + 1
  WHERE a.role = 'user' AND b.role = 'assistant')"""


def _hit_parts(k: int, base: str = BASE, questions: str = QUESTIONS) -> str:
    """``hits(query_id, rank, id, score, pdf_name, content)``: nearest chunks by cosine.

    Rows without a common bucket score 0, so every question is scored against every chunk."""
    return f"""{base},
{questions},
{_vector_parts('asked', 'SELECT query_id AS id, query AS text FROM questions')},
products AS (
  SELECT a.id AS query_id, b.id, sum(a.weight * b.weight) AS product
  FROM asked_cells a JOIN base_cells b ON a.dim = b.dim GROUP BY ALL),
scored AS (
  SELECT q.query_id, b.id, b.pdf_name, b.content,
    round(coalesce(p.product / (n.norm * m.norm), 0), 6) AS score
  FROM questions q CROSS JOIN base b
  LEFT JOIN products p ON p.query_id = q.query_id AND p.id = b.id
  LEFT JOIN asked_norms n ON n.id = q.query_id LEFT JOIN base_norms m ON m.id = b.id),
hits AS (
  SELECT * FROM (
    SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, id) AS rank,
      id, score, pdf_name, content FROM scored)
  WHERE rank <= {k})"""


def _keyword_parts(
    k: int, docs: str, questions: str = "questions", name: str = "found"
) -> str:
    """``<name>(query_id, rank, id, score)`` by BM25 over ``docs`` = a select of (id, text)."""
    return f"""
{name}_docs AS ({docs}),
{name}_terms AS (
  SELECT id, term, count(*) AS tf FROM (SELECT id, unnest({_terms('text')}) AS term FROM {name}_docs)
  GROUP BY ALL),
{name}_sizes AS (SELECT id, len({_terms('text')}) AS dl FROM {name}_docs),
{name}_mean AS (SELECT avg(dl) AS mean_length, count(*) AS n FROM {name}_sizes),
{name}_rarity AS (SELECT term, count(*) AS df FROM {name}_terms GROUP BY term),
{name}_asked AS (
  SELECT DISTINCT query_id, unnest({_terms('query')}) AS term FROM {questions}),
{name}_scores AS (
  SELECT a.query_id, t.id,
    round(sum(ln(1 + (m.n - r.df + 0.5) / (r.df + 0.5)) * t.tf * 2.2
      / (t.tf + 1.2 * (0.25 + 0.75 * s.dl / m.mean_length))), 6) AS score
  FROM {name}_asked a JOIN {name}_terms t ON a.term = t.term JOIN {name}_rarity r ON r.term = t.term
  JOIN {name}_sizes s ON s.id = t.id CROSS JOIN {name}_mean m GROUP BY ALL),
{name} AS (
  SELECT * FROM (
    SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, id) AS rank,
      id, score FROM {name}_scores)
  WHERE rank <= {k})"""


def _best_sentence(hits: str, max_tokens: int) -> str:
    """``answers(query_id, result)`` from ``hits`` and ``questions``."""
    return f"""
found_sentences AS (
  SELECT h.query_id, h.rank, i AS no, s[i] AS sentence,
    len(list_intersect({_terms('s[i]')}, {_terms('q.query')})) AS shared
  FROM (SELECT query_id, rank, {_sentences('content')} AS s FROM {hits}) h
  JOIN questions q ON q.query_id = h.query_id, unnest(range(1, len(s) + 1)) AS t(i)),
best AS (
  SELECT query_id, sentence FROM (
    SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY shared DESC, rank, no) AS place
    FROM found_sentences WHERE shared > 0) WHERE place = 1),
answers AS (
  SELECT q.query_id, coalesce(array_to_string(({_tokens('b.sentence')})[1:{max_tokens}], ' '), '')
    AS result
  FROM questions q LEFT JOIN best b ON b.query_id = q.query_id)"""


EVAL_ROWS = f"""{_hit_parts(2, questions=EVAL_QUESTIONS)},
{_best_sentence('hits', 300)},
contexts AS (
  SELECT query_id, string_agg(content, chr(10) || chr(10) ORDER BY rank) AS context,
    string_agg(content, ' ' ORDER BY rank) AS context_words
  FROM hits GROUP BY query_id),
eval AS (
  SELECT q.query_id, q.query AS inputs, a.result AS answer, coalesce(c.context, '') AS context,
    coalesce(c.context_words, '') AS context_words, q.ground_truth, q.evolution_type
  FROM questions q JOIN answers a ON a.query_id = q.query_id
  LEFT JOIN contexts c ON c.query_id = q.query_id)"""

SIMILARITY = f"""{_vector_parts('said', 'SELECT query_id AS id, answer AS text FROM eval')},
{_vector_parts('true', 'SELECT query_id AS id, ground_truth AS text FROM eval')},
similarity AS (
  SELECT e.query_id, round(coalesce(
    (SELECT sum(s.weight * t.weight) FROM said_cells s JOIN true_cells t ON s.dim = t.dim
      WHERE s.id = e.query_id AND t.id = e.query_id) / (n.norm * m.norm), 0), 6) AS similarity
  FROM eval e LEFT JOIN said_norms n ON n.id = e.query_id
  LEFT JOIN true_norms m ON m.id = e.query_id)"""
TOKEN_F1 = f"""
answer_words AS (SELECT query_id, term, count(*) AS n FROM (
  SELECT query_id, unnest({_terms('answer')}) AS term FROM eval) GROUP BY ALL),
truth_words AS (SELECT query_id, term, count(*) AS n FROM (
  SELECT query_id, unnest({_terms('ground_truth')}) AS term FROM eval) GROUP BY ALL),
both_words AS (
  SELECT a.query_id, sum(least(a.n, t.n)) AS n FROM answer_words a
  JOIN truth_words t ON a.query_id = t.query_id AND a.term = t.term GROUP BY a.query_id),
f1 AS (
  SELECT e.query_id, round(coalesce(2.0::DOUBLE * b.n /
    (len({_terms('answer')}) + len({_terms('ground_truth')})), 0), 6) AS token_f1
  FROM eval e LEFT JOIN both_words b ON b.query_id = e.query_id)"""


def _share(wanted: str, given: str) -> str:
    total = f"len(list_distinct({_terms(wanted)}))"
    both = f"len(list_intersect({_terms(wanted)}, {_terms(given)}))"
    return f"CASE WHEN {total} > 0 THEN round({both} / {total}, 6) ELSE 0.0::DOUBLE END"


RELEVANCE = f"""
relevance AS (
  SELECT query_id, {_share('inputs', 'answer')} AS question_covered,
    {_share('answer', 'context_words')} AS answer_grounded FROM eval)"""
ALL_METRICS = f"""{EVAL_ROWS}, {SIMILARITY}, {TOKEN_F1}, {RELEVANCE},
metrics AS (
  SELECT e.query_id, e.inputs, e.answer, e.context, e.ground_truth, e.evolution_type,
    s.similarity, f.token_f1, r.question_covered, r.answer_grounded
  FROM eval e JOIN similarity s ON s.query_id = e.query_id JOIN f1 f ON f.query_id = e.query_id
  JOIN relevance r ON r.query_id = e.query_id)"""
FIGURES = ", ".join(
    f"round(avg({m}), 6) AS {m}_mean, round(var_pop({m}), 6) AS {m}_variance, "
    f"round(quantile_cont({m}, 0.9), 6) AS {m}_p90"
    for m in ("similarity", "token_f1", "question_covered", "answer_grounded")
)


def _nearest(score: str) -> str:
    return f"""
WITH e AS (SELECT vec_id, embedding::DOUBLE[] AS v, label FROM embeddings),
s AS (SELECT q.vec_id AS query_id, b.vec_id AS id, b.label, round({score}, 6) + 0.0::DOUBLE AS score
  FROM e q CROSS JOIN e b),
hits AS (SELECT * FROM (SELECT query_id, row_number() OVER (
    PARTITION BY query_id ORDER BY score DESC, id) AS rank, id, label, score FROM s))
"""


COSINE = _nearest("list_cosine_similarity(q.v, b.v)")
TOP5 = "SELECT query_id, rank, id, score FROM hits WHERE rank <= 5"

SNAPSHOTS = """
first AS (SELECT doc_id, text AS content FROM documents
  WHERE doc_id IN (SELECT doc_id FROM labels)),
second AS (SELECT doc_id, replace(text, ',', '') AS content FROM documents
  WHERE doc_id NOT IN (SELECT doc_id FROM labels WHERE toxic = 1)),
third AS (SELECT doc_id, text AS content FROM documents
  WHERE doc_id NOT IN (SELECT doc_id FROM labels WHERE quality = 0))"""


def _diff(old: str, new: str, version: int) -> str:
    return f"""
SELECT coalesce(n.doc_id, o.doc_id) AS doc_id,
  CASE WHEN n.doc_id IS NULL THEN o.content ELSE n.content END AS content,
  CASE WHEN o.doc_id IS NULL THEN 'insert' WHEN n.doc_id IS NULL THEN 'delete'
    ELSE 'update_postimage' END AS _change_type,
  {version}::BIGINT AS _commit_version
FROM {old} o FULL OUTER JOIN {new} n ON o.doc_id = n.doc_id
WHERE o.content IS DISTINCT FROM n.content"""


def _cells(source: str, key: str) -> str:
    return (
        f"WITH {_vector_parts('v', source)} "
        f"SELECT id AS {key}, dim, weight FROM v_cells"
    )


DOCUMENT_CELLS = _cells("SELECT doc_id AS id, text FROM documents", "doc_id")
LABELS = "SELECT doc_id, quality, toxic FROM labels"

LABEL_CELLS = """
WITH e AS (SELECT vec_id, embedding::DOUBLE[] AS v FROM embeddings),
means AS (
  SELECT label, i, avg(embedding[i]::DOUBLE) AS x FROM embeddings, unnest(range(1, 65)) AS t(i)
  GROUP BY ALL),
centres AS (SELECT label, list(x ORDER BY i) AS c FROM means GROUP BY label),
near AS (
  SELECT vec_id, label, row_number() OVER (
    PARTITION BY vec_id ORDER BY list_distance(v, c), label) AS place FROM e CROSS JOIN centres)"""

ORACLES = {
    "src_binary_files": """
SELECT page_id, strlen(line) + 1 AS length, md5(line) AS digest
FROM (SELECT page_id, regexp_replace(html, '[\\r\\n]+', ' ', 'g') AS line FROM pages)""",
    "src_one_file": """
SELECT page_id, strlen(regexp_replace(html, '[\\r\\n]+', ' ', 'g')) + 1 AS length
FROM pages""",
    "src_table_scan": "SELECT doc_id, lang, source, n_chars FROM documents",
    "src_csv_file": "SELECT conv_id, turn, role, text FROM conversations",
    "src_csv_lines": """
SELECT conv_id, turn, text AS question, role AS evolution_type, turn = 0 AS episode_done
FROM conversations""",
    "sink_overwrite": LABELS,
    "sink_append_dedup": "SELECT DISTINCT md5(text) AS id, n_chars FROM documents",
    "sink_create_table": LABELS,
    "sink_evolve_schema": f"SELECT doc_id, lang, {_key('doc_id', 'text')} AS id FROM documents",
    "preview_topn": """
SELECT source, doc_id, n_chars FROM documents ORDER BY source, doc_id LIMIT 20""",
    "project_rename": """
SELECT doc_id, source AS pdf_name, text AS content, length(text) AS size FROM documents""",
    "elements_nonempty": f"""
SELECT doc_id, array_to_string(e, chr(10)) AS content, len(e) AS element_count
FROM (SELECT doc_id, {_elements('text')} AS e FROM documents)""",
    "explode_elements": f"""
SELECT doc_id, i - 1 AS position, e[i] AS element
FROM (SELECT doc_id, {_elements('text')} AS e FROM documents), unnest(range(1, len(e) + 1)) AS t(i)""",
    "vector_prefix": """
SELECT vec_id AS id, i - 1 AS position, embedding[i]::DOUBLE AS value
FROM embeddings, unnest(range(1, least(len(embedding), 20) + 1)) AS t(i)""",
    "text_replace": "SELECT doc_id, replace(text, ',', '') AS content FROM documents",
    "text_truncate": "SELECT doc_id, substring(text, 1, 100) AS snippet FROM documents",
    "prompt_format": """
SELECT doc_id, 'Sum up this ' || lang || ' text from ' || source || ' in ' || lang || ':' || chr(10)
  || text AS prompt FROM documents""",
    "coalesce_fields": """
SELECT event_id, upper(state) AS state, CASE WHEN contains(upper(state), 'ERR') THEN 'failed'
  WHEN contains(upper(state), 'SIGN') THEN 'provisioning'
  WHEN contains(upper(state), 'VIEW') THEN 'online' ELSE 'unknown' END AS kind
FROM (SELECT event_id, coalesce(CASE WHEN event_id % 2 = 0 THEN json_extract_string(props, '$.k') END,
  event_type, 'UNKNOWN') AS state FROM events)""",
    "passages_format": f"""{COSINE}
SELECT query_id, rank, source AS file, text FROM hits JOIN documents ON doc_id = id
WHERE rank <= 2""",
    "clean_code_input": r"""
SELECT conv_id, turn, regexp_replace(regexp_replace(
  ' ```python' || chr(10) || text || chr(10) || '``` ', '^[\s`]+|[\s`]+$', '', 'g'),
  '^python\s*', '') AS code
FROM conversations""",
    "reply_field": "SELECT event_id, json_extract_string(props, '$.k') AS reply FROM events",
    "extract_html_text": f"SELECT page_id, {_html_text('html')} AS text FROM pages",
    "split_sentences": f"""
SELECT doc_id, i - 1 AS sentence_no, s[i] AS sentence
FROM (SELECT doc_id, {_sentences('text')} AS s FROM documents), unnest(range(1, len(s) + 1)) AS t(i)
""",
    "count_tokens": f"SELECT doc_id, len({_tokens('text')}) AS tokens FROM documents",
    "count_tokens_model": f"""
SELECT doc_id, coalesce(list_sum(list_transform({_tokens('text')}, lambda x: (len(x) + 3) // 4)), 0)
  ::BIGINT AS tokens FROM documents""",
    "chunk_windows": f"""
SELECT doc_id, i AS chunk_no, array_to_string(w[i * 450 + 1 : i * 450 + 500], ' ') AS content
FROM (SELECT doc_id, {_tokens('text')} AS w FROM documents),
  unnest(range(0, 1 + (greatest(len(w) - 51, 0)) // 450)) AS t(i)
WHERE len(w) > 0""",
    "chunk_sentences": f"""WITH RECURSIVE
{_chunk_parts('SELECT doc_id AS doc_key, text FROM documents')}
SELECT doc_key AS doc_id, chunk_no, content FROM chunks""",
    "chunk_documents": f"""WITH RECURSIVE
{_chunk_parts(f"SELECT page_id AS doc_key, {_html_text('html')} AS text FROM pages", 120, 20)}
SELECT url AS pdf_name, doc_key AS page_id, chunk_no, content
FROM chunks JOIN pages ON page_id = doc_key""",
    "hash_embed": DOCUMENT_CELLS,
    "embed_batches": DOCUMENT_CELLS,
    "embed_queries": _cells("SELECT item_id AS id, text FROM benchmark", "query_id"),
    "check_vectors": """
SELECT vec_id AS id, CASE label WHEN 1 THEN 'width' WHEN 2 THEN 'zero' WHEN 3 THEN 'not finite'
  WHEN 4 THEN 'null' ELSE 'none' END AS fault FROM embeddings""",
    "embed_documents": f"""WITH RECURSIVE {BASE}
SELECT b.id, b.pdf_name, b.content, (SELECT count(*) FROM base_cells c WHERE c.id = b.id) AS filled
FROM base b""",
    "content_key": f"SELECT doc_id, {_key('source', 'doc_id', 'text')} AS id FROM documents",
    "dense_id": """
SELECT lang, doc_id, row_number() OVER (ORDER BY lang, doc_id) - 1 AS id FROM documents""",
    "change_rows": f"WITH {SNAPSHOTS} {_diff('first', 'second', 1)}",
    "apply_changes": f"""WITH {SNAPSHOTS},
changes AS ({_diff('first', 'second', 1)} UNION ALL {_diff('second', 'third', 2)}),
latest AS (
  SELECT * FROM (SELECT *, row_number() OVER (
    PARTITION BY doc_id ORDER BY _commit_version DESC) AS place FROM changes) WHERE place = 1)
SELECT doc_id, content, _commit_version, _change_type = 'delete' AS _deleted FROM latest
UNION ALL
SELECT doc_id, content, 0::BIGINT, false FROM first
WHERE doc_id NOT IN (SELECT doc_id FROM latest)""",
    "sync_index": f"""WITH {SNAPSHOTS}
SELECT doc_id, content, 64::BIGINT AS width FROM third""",
    "index_stats": """
SELECT count(*) AS row_count, count(DISTINCT vec_id) AS key_count, 
  max(len(embedding)) AS width, 0::BIGINT AS last_version, 0::BIGINT AS tombstone_count
FROM embeddings""",
    "vector_topk_cosine": COSINE + TOP5,
    "vector_topk_l2": _nearest("-list_distance(q.v, b.v)") + TOP5,
    "vector_topk_dot": _nearest("list_dot_product(q.v, b.v)") + TOP5,
    "vector_topk_ivf_all_cells": COSINE + TOP5,
    "vector_topk_ivf_bounded": COSINE + TOP5,
    "vector_topk_ivf_label_cells": LABEL_CELLS + """,
scored AS (
  SELECT p.vec_id AS query_id, b.vec_id AS id, round(-list_distance(q.v, b.v), 6) + 0.0::DOUBLE AS score
  FROM near p JOIN near m ON m.label = p.label AND m.place = 1
  JOIN e q ON q.vec_id = p.vec_id JOIN e b ON b.vec_id = m.vec_id WHERE p.place <= 3)
SELECT query_id, rank, id, score FROM (SELECT query_id, id, score, row_number() OVER (
  PARTITION BY query_id ORDER BY score DESC, id) AS rank FROM scored) WHERE rank <= 5""",
    "index_cells": LABEL_CELLS + """
SELECT (dense_rank() OVER (ORDER BY label) - 1)::INTEGER AS cell, row_count
FROM (SELECT label, count(*) AS row_count FROM near WHERE place = 1 GROUP BY label)""",
    "ivf_recall": LABEL_CELLS + """,
exact AS (
  SELECT q.vec_id AS query_id, b.vec_id AS id, row_number() OVER (
    PARTITION BY q.vec_id ORDER BY round(-list_distance(q.v, b.v), 6) DESC, b.vec_id) AS rank
  FROM e q CROSS JOIN e b),
places AS (
  SELECT p.place FROM exact x JOIN near m ON m.vec_id = x.id AND m.place = 1
  JOIN near p ON p.vec_id = x.query_id AND p.label = m.label WHERE x.rank <= 5)
SELECT probes, count(place) AS found_hits,
  round(count(place) / (SELECT count(*) FROM places), 6) AS recall
FROM range(1, (SELECT count(*) FROM centres) + 1) AS t(probes) LEFT JOIN places ON place <= probes
GROUP BY probes""",
    "search_columns": COSINE + "SELECT query_id, rank, id, score, label FROM hits WHERE rank <= 5",
    "keyword_topk": f"""WITH {QUESTIONS},
{_keyword_parts(3, 'SELECT doc_id AS id, text FROM documents')}
SELECT query_id, rank, id, score FROM found""",
    "keyword_top1_truncated": f"""WITH {QUESTIONS},
{_keyword_parts(1, 'SELECT doc_id AS id, text FROM documents')}
SELECT query_id, id, score, substring(text, 1, 100) AS snippet
FROM found JOIN documents ON doc_id = id""",
    "rerank_overlap": f"""WITH RECURSIVE {_hit_parts(5)},
rarity AS (
  SELECT term, count(*) AS df FROM (
    SELECT id, unnest(list_distinct({_terms('content')})) AS term FROM base) GROUP BY term),
shared AS (
  SELECT h.query_id, h.id, unnest(list_intersect({_terms('q.query')}, {_terms('h.content')})) AS term
  FROM hits h JOIN questions q ON q.query_id = h.query_id),
sums AS (
  SELECT query_id, id, round(sum(ln(1 + ((SELECT count(*) FROM base) - df + 0.5) / (df + 0.5))), 6)
    AS score
  FROM shared s JOIN rarity r ON r.term = s.term GROUP BY ALL),
placed AS (
  SELECT h.query_id, h.id, coalesce(s.score, 0) AS score, row_number() OVER (
    PARTITION BY h.query_id ORDER BY coalesce(s.score, 0) DESC, h.id) AS rank
  FROM hits h LEFT JOIN sums s ON s.query_id = h.query_id AND s.id = h.id)
SELECT query_id, rank, id, score FROM placed WHERE rank <= 3""",
    "rerank_model": f"""WITH RECURSIVE {_hit_parts(5)},
shares AS (
  SELECT h.query_id, h.id, {_share('q.query', 'h.content')} AS score
  FROM hits h JOIN questions q ON q.query_id = h.query_id),
placed AS (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, id) AS rank FROM shares)
SELECT query_id, rank, id, score FROM placed WHERE rank <= 3""",
    "batch_retrieve": f"""WITH RECURSIVE {_hit_parts(2)}
SELECT query_id, rank, id, score, pdf_name, content FROM hits""",
    "two_hop_lookup": f"""WITH RECURSIVE {_hit_parts(1)},
second AS (SELECT query_id, replace(content, ',', '') AS query FROM hits),
{_keyword_parts(1, f"SELECT page_id AS id, {_html_text('html')} AS text FROM pages", 'second')}
SELECT query_id, rank, id, score FROM found""",
    "stuff_context": f"""WITH RECURSIVE {_hit_parts(3)}
SELECT query_id, string_agg(content, chr(10) || chr(10) ORDER BY rank) AS context
FROM hits GROUP BY query_id""",
    "generate": f"""
SELECT doc_id, array_to_string(({_tokens("'Answer in brief: ' || text")})[1:300], ' ') AS reply
FROM documents""",
    "extractive_answer": f"""WITH {QUESTIONS},
{_keyword_parts(2, 'SELECT doc_id AS id, text FROM documents')},
hits AS (SELECT query_id, rank, text AS content FROM found JOIN documents ON doc_id = id),
{_best_sentence('hits', 20)}
SELECT query_id, result FROM answers""",
    "chain_pipe": f"""
SELECT item_id AS query_id, array_to_string(({_tokens(
        "'In plain words, tell a newcomer about this: ' || text")})[1:12], ' ') AS answer
FROM benchmark""",
    "chain_map": f"""
SELECT doc_id, 'Answer this: ' || text AS c, 'Watch ' || source AS d, len({_terms('text')}) AS e
FROM documents""",
    "chain_assign": f"""
SELECT doc_id, 'Answer this: ' || text AS c, 'Again: Watch ' || source AS d,
  len({_terms('text')}) AS e FROM documents""",
    "eval_dataset": f"""WITH RECURSIVE {EVAL_ROWS}
SELECT query_id, inputs, answer, context, ground_truth FROM eval""",
    "eval_similarity": f"""WITH RECURSIVE {EVAL_ROWS}, {SIMILARITY}
SELECT query_id, similarity FROM similarity""",
    "eval_token_f1": f"""WITH RECURSIVE {EVAL_ROWS}, {TOKEN_F1}
SELECT query_id, token_f1 FROM f1""",
    "eval_relevance": f"""WITH RECURSIVE {EVAL_ROWS}, {RELEVANCE}
SELECT query_id, question_covered, answer_grounded FROM relevance""",
    "eval_judged": f"""WITH RECURSIVE {EVAL_ROWS}
SELECT query_id, {_share('ground_truth', 'answer')} AS judged FROM eval""",
    "eval_rows": f"WITH RECURSIVE {ALL_METRICS} SELECT * FROM metrics",
    "eval_summary": f"""WITH RECURSIVE {ALL_METRICS}
SELECT count(*) AS row_count, {FIGURES} FROM metrics""",
    "eval_by_group": f"""WITH RECURSIVE {ALL_METRICS}
SELECT evolution_type, count(*) AS row_count, {FIGURES} FROM metrics GROUP BY evolution_type""",
    "count_by_location": """
SELECT n_name, count(*) AS row_count FROM customer JOIN nation ON n_nationkey = c_nationkey
GROUP BY n_name""",
    "count_rows": "SELECT count(*) AS row_count FROM lineitem",
    "chart_top_groups": """
SELECT event_type, count(*) AS row_count, round(sum(value), 2) AS total FROM events
GROUP BY event_type ORDER BY total DESC, event_type LIMIT 3""",
}

_PROMPT = """
'You are given passages from a document collection, each under its file name.' || chr(10)
|| 'Reply to the request at the end in a few words, with what the passages say and nothing else. '
|| 'If they' || chr(10) || 'say nothing about it, reply: not found.' || chr(10) || chr(10)
|| coalesce(c.context, '') || chr(10) || chr(10) || 'Request: ' || q.query || chr(10)"""
_CONTEXTS = """
contexts AS (
  SELECT query_id, string_agg('[' || rank || '] ' || pdf_name || chr(10) || content,
    chr(10) || chr(10) ORDER BY rank) AS context
  FROM hits GROUP BY query_id)"""
ORACLES["embed_documents_append"] = ORACLES["embed_documents"]
ORACLES["sink_change_feed"] = ORACLES["change_rows"]
ORACLES["sink_change_feed_added_column"] = f"""WITH {SNAPSHOTS}
SELECT coalesce(s.doc_id, f.doc_id) AS doc_id, coalesce(s.content, f.content) AS content,
  length(s.content) AS size, length(s.content) AS held_size, 1::BIGINT AS _commit_version,
  CASE WHEN f.doc_id IS NULL THEN 'insert' WHEN s.doc_id IS NULL THEN 'delete'
    ELSE 'update_postimage' END AS _change_type
FROM first f FULL JOIN second s ON s.doc_id = f.doc_id"""
_NEW = "SELECT doc_id, content, {}::BIGINT AS _commit_version{} FROM {} WHERE doc_id NOT IN (SELECT doc_id FROM first)"
ORACLES["append_change_feed"] = f"""WITH {SNAPSHOTS}
{_NEW.format(1, ", 'insert' AS _change_type", "second")}"""
ORACLES["overwrite_change_feed"] = f"""WITH {SNAPSHOTS} {_diff('first', 'second', 1)}
UNION ALL
SELECT o.doc_id, o.content, 'update_preimage', 1::BIGINT FROM first o JOIN second n ON o.doc_id = n.doc_id
WHERE o.content IS DISTINCT FROM n.content"""
ORACLES["table_version"] = f"WITH {SNAPSHOTS} SELECT doc_id, content FROM second"
ORACLES["version_diff"] = f"WITH {SNAPSHOTS} {_diff('first', 'second', 2)}"
ORACLES["sync_index_appends"] = f"""WITH {SNAPSHOTS}
SELECT doc_id, content, 0::BIGINT AS _commit_version FROM first
UNION ALL {_NEW.format(1, "", "second")}
UNION ALL {_NEW.format(2, "", "third")} AND doc_id NOT IN (SELECT doc_id FROM second)"""
ORACLES["keyword_topk_stored"] = ORACLES["keyword_topk"]
ORACLES["build_prompt"] = f"""WITH RECURSIVE {_hit_parts(2)}, {_CONTEXTS}
SELECT q.query_id, {_PROMPT} AS prompt
FROM questions q LEFT JOIN contexts c ON c.query_id = q.query_id"""
ORACLES["rag_answer"] = f"""WITH RECURSIVE {_hit_parts(2)}, {_CONTEXTS}, {_best_sentence('hits', 300)}
SELECT q.query_id, q.query, {_PROMPT} AS prompt, a.result
FROM questions q LEFT JOIN contexts c ON c.query_id = q.query_id
JOIN answers a ON a.query_id = q.query_id"""
