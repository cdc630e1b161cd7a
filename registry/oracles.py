"""DuckDB SQL for the registered queries, over the same tables in full."""

from __future__ import annotations

from chunkwright.functions.text import KEY_TERM_STOP_WORDS

from .views import COPY_OFFSET, OPTIONS, PAIRED

_STOP = ", ".join(f"'{w}'" for w in KEY_TERM_STOP_WORDS)
_HASH = OPTIONS.config_hash()
_WORDS = r"regexp_extract_all(lower({0}), '[\p{{L}}\p{{N}}_]+')"
_TOKENS = "regexp_extract_all(lower({0}), '[a-zA-Z0-9]+')"
_COUNT = r"len(regexp_extract_all(chunk_text, '\S+'))"
_UNIT = (
    "list_transform(embedding, lambda x: x / greatest(sqrt(list_dot_product(embedding, embedding)), 1e-12))"
)

# Named steps, each depending on those listed with it.
_STEPS: dict[str, tuple[str, str]] = {
    "docs": (
        "",
        "SELECT 'doc-' || (d.doc_id // 4) AS doc_id, 'c-' || d.doc_id AS chunk_id, d.text AS chunk_text, "
        "e.embedding::DOUBLE[] AS embedding, d.doc_id AS ord, d.lang FROM documents d "
        "LEFT JOIN embeddings e ON d.doc_id = e.vec_id",
    ),
    "chunks": ("docs", "SELECT doc_id, chunk_id, chunk_text, embedding, ord FROM docs WHERE embedding IS NOT NULL"),
    "copied": (
        "chunks",
        "SELECT * FROM chunks UNION ALL SELECT doc_id, chunk_id || '-copy', chunk_text, "
        f"list_transform(embedding, lambda x: x * 2), ord + {COPY_OFFSET} FROM docs "
        "WHERE embedding IS NOT NULL AND lang <> 'en'",
    ),
    "units": ("copied", f"SELECT ord, {_UNIT} AS u FROM copied"),
    "sims": (
        "units",
        "SELECT a.ord AS l, b.ord AS r, round(list_dot_product(a.u, b.u), 10) AS sim "
        "FROM units a JOIN units b ON a.ord <> b.ord",
    ),
    "annotated": (
        "sims",
        f"SELECT c.*, {_COUNT} AS n_tokens, CASE WHEN {_COUNT} NOT BETWEEN 5 AND 350 "
        f"THEN 'Token length (' || {_COUNT} || ') out of bounds.' WHEN EXISTS (SELECT 1 FROM sims s "
        "JOIN copied o ON o.ord = s.l WHERE s.r = c.ord AND s.l < s.r AND s.sim >= 0.98 AND "
        r"len(regexp_extract_all(o.chunk_text, '\S+')) BETWEEN 5 AND 350) "
        "THEN 'Near-duplicate chunk (via exact)' END AS reject_reason FROM copied c",
    ),
    "valid": ("annotated", "SELECT * FROM annotated WHERE reject_reason IS NULL"),
    "near": (
        "valid",
        "SELECT l AS golden_ord, r AS ord, sim, row_number() OVER (PARTITION BY l ORDER BY sim DESC, r) AS rank "
        "FROM sims JOIN valid a ON a.ord = l JOIN valid b ON b.ord = r QUALIFY rank <= 3",
    ),
    "distractors": (
        "near",
        "SELECT golden_ord AS bundle_id, n.rank, v.doc_id, v.chunk_id, v.chunk_text, n.sim "
        "FROM near n JOIN valid v ON v.ord = n.ord",
    ),
    "types": ("", "SELECT unnest(['factual', 'keyword']) AS query_type"),
    "requests": (
        "distractors,types",
        "SELECT v.ord AS bundle_id, t.query_type, v.doc_id, v.chunk_id, v.chunk_text, "
        "substr(sha256(length(v.chunk_text) || ':' || v.chunk_text || coalesce(d.n, 0) || '|' || "
        "coalesce(d.texts, '') || length(t.query_type) || ':' || t.query_type || "
        f"'{OPTIONS.temperature}|{OPTIONS.answer_tokens}|{_HASH}'), 1, 16) AS request_key "
        "FROM valid v CROSS JOIN types t LEFT JOIN (SELECT bundle_id, count(*) AS n, "
        "string_agg(length(chunk_text) || ':' || chunk_text, '' ORDER BY chunk_text) AS texts "
        "FROM distractors GROUP BY bundle_id) d ON d.bundle_id = v.ord",
    ),
    "foreign_words": (
        "distractors",
        f"SELECT DISTINCT bundle_id, unnest({_WORDS.format('chunk_text')}) AS term FROM distractors",
    ),
    "own_words": (
        "valid",
        f"SELECT ord AS bundle_id, unnest({_WORDS.format('chunk_text')}) AS term, "
        f"generate_subscripts({_WORDS.format('chunk_text')}, 1) AS pos FROM valid",
    ),
    "own_terms": (
        "own_words,foreign_words",
        "SELECT bundle_id, term, row_number() OVER (PARTITION BY bundle_id ORDER BY count(*) DESC, min(pos)) AS place "
        f"FROM own_words o WHERE regexp_matches(term, '^[a-z]+$') AND length(term) > 2 AND term NOT IN ({_STOP}) "
        "AND NOT EXISTS (SELECT 1 FROM foreign_words f WHERE f.bundle_id = o.bundle_id AND f.term = o.term) "
        "GROUP BY bundle_id, term QUALIFY place <= 5",
    ),
    "completions": (
        "requests,own_terms",
        "SELECT request_key, min(query) AS query FROM requests JOIN (SELECT bundle_id, "
        "string_agg(term, ' ' ORDER BY place) AS query FROM own_terms GROUP BY bundle_id) USING (bundle_id) "
        "GROUP BY request_key",
    ),
    "stored": (
        "completions",
        "SELECT * FROM completions WHERE request_key IN (SELECT request_key FROM requests WHERE query_type = 'keyword')",
    ),
    "queries": ("completions", "SELECT * FROM requests JOIN completions USING (request_key)"),
    "slots": (
        "queries",
        f"SELECT bundle_id, query_type, 0 AS slot, {_TOKENS.format('chunk_text')} AS toks FROM queries UNION ALL "
        f"SELECT q.bundle_id, q.query_type, d.rank, {_TOKENS.format('d.chunk_text')} "
        "FROM queries q JOIN distractors d USING (bundle_id)",
    ),
    "sized": (
        "slots",
        "SELECT *, len(toks) AS dl, count(*) OVER w AS n_docs, avg(len(toks)) OVER w AS avgdl "
        "FROM slots WINDOW w AS (PARTITION BY bundle_id, query_type)",
    ),
    "tf": (
        "sized",
        "SELECT bundle_id, query_type, slot, term, count(*) AS tf, any_value(dl) AS dl, any_value(n_docs) AS n_docs, "
        "any_value(avgdl) AS avgdl FROM (SELECT *, unnest(toks) AS term FROM sized) "
        "GROUP BY bundle_id, query_type, slot, term",
    ),
    "raw_idf": (
        "tf",
        "SELECT bundle_id, query_type, term, "
        "ln(any_value(n_docs) - count(*) + 0.5) - ln(count(*) + 0.5) AS idf FROM tf "
        "GROUP BY bundle_id, query_type, term",
    ),
    "idf": (
        "raw_idf",
        "SELECT bundle_id, query_type, term, CASE WHEN idf < 0 THEN 0.25 * avg(idf) OVER "
        "(PARTITION BY bundle_id, query_type) ELSE idf END AS idf FROM raw_idf",
    ),
    "asked": (
        "queries",
        "SELECT bundle_id, query_type, term, count(*) AS times FROM "
        f"(SELECT bundle_id, query_type, unnest({_TOKENS.format('query')}) AS term FROM queries) "
        "GROUP BY bundle_id, query_type, term",
    ),
    "matched": (
        "asked,tf,idf",
        "SELECT bundle_id, query_type, slot, sum(times * idf * tf * 2.5 / (tf + 1.5 * (0.25 + 0.75 * dl / avgdl))) "
        "AS score, count(*) AS hits FROM asked JOIN tf USING (bundle_id, query_type, term) "
        "JOIN idf USING (bundle_id, query_type, term) GROUP BY bundle_id, query_type, slot",
    ),
    "scored": (
        "matched,slots",
        "SELECT s.bundle_id, s.query_type, s.slot, coalesce(m.score, 0) AS score, coalesce(m.hits, 0) AS hits "
        "FROM slots s LEFT JOIN matched m USING (bundle_id, query_type, slot)",
    ),
    "figures": (
        "scored,asked",
        "SELECT bundle_id, query_type, g.score AS golden_score, coalesce(d.best, 0) AS best_distractor_score, "
        "1 + coalesce(d.above, 0) AS golden_rank, g.score - coalesce(d.best, 0) AS margin, "
        "g.hits / greatest(a.n, 1) AS golden_coverage, coalesce(d.hits, 0) / greatest(a.n, 1) AS best_distractor_coverage "
        "FROM (SELECT * FROM scored WHERE slot = 0) g "
        "LEFT JOIN (SELECT o.bundle_id, o.query_type, max(o.score) AS best, arg_max(o.hits, (o.score, -o.slot)) AS hits, "
        "count(*) FILTER (o.score > z.score) AS above FROM scored o JOIN scored z ON z.bundle_id = o.bundle_id "
        "AND z.query_type = o.query_type AND z.slot = 0 WHERE o.slot > 0 GROUP BY o.bundle_id, o.query_type) d "
        "USING (bundle_id, query_type) "
        "JOIN (SELECT bundle_id, query_type, count(*) AS n FROM asked GROUP BY ALL) a USING (bundle_id, query_type)",
    ),
    "gated": (
        "figures",
        "SELECT *, golden_rank = 1 AND margin >= 0.5 AND golden_coverage >= 0.6 "
        "AND golden_coverage - best_distractor_coverage >= 0.2 AS ok FROM figures",
    ),
    "labelled": (
        "queries",
        "SELECT request_key, min(CASE WHEN toxic = 1 THEN 0.2 WHEN quality = 1 THEN 0.9 ELSE 0.5 END)::DOUBLE AS score, "
        "min('quality ' || quality) AS answer FROM queries q JOIN labels l ON l.doc_id = q.bundle_id GROUP BY request_key",
    ),
    "judged": (
        "queries,labelled,gated",
        "SELECT q.bundle_id, q.query_type, q.request_key, q.query, q.chunk_text, l.score, l.answer, g.ok, "
        "coalesce(l.score >= 0.8, true) AS good, "
        f"('0x' || substr(md5('{OPTIONS.seed}:' || q.request_key), 1, 8))::BIGINT / 4294967296.0 < 0.5 AS picked "
        "FROM queries q JOIN gated g USING (bundle_id, query_type) LEFT JOIN labelled l USING (request_key)",
    ),
    "gate": (
        "judged",
        "SELECT *, NOT ok AND picked AS judged, CASE WHEN ok THEN 'nonllm' WHEN picked AND good THEN 'hybrid_llm' END "
        "AS evaluation FROM judged",
    ),
    "letters": (
        "copied",
        "SELECT ord, list_filter(" + _WORDS.format("chunk_text") + ", lambda w: regexp_matches(w, '^[a-z]+$')) AS words "
        "FROM copied",
    ),
    "letter_words": (
        "letters",
        "SELECT ord, term, count(*) AS tf, min(pos) AS pos FROM (SELECT ord, unnest(words) AS term, "
        "generate_subscripts(words, 1) AS pos FROM letters) GROUP BY ord, term",
    ),
    "wanted": (
        "letter_words",
        "SELECT ord AS golden_ord, term, row_number() OVER (PARTITION BY ord ORDER BY tf DESC, pos) AS place "
        f"FROM letter_words WHERE length(term) > 2 AND term NOT IN ({_STOP}) QUALIFY place <= 5",
    ),
    "text_hits": (
        "wanted,letters",
        "SELECT golden_ord, ord, score, row_number() OVER (PARTITION BY golden_ord ORDER BY score DESC, ord) AS rank FROM ("
        "SELECT w.golden_ord, l.ord, round(sum(ln(1 + (t.n - f.df + 0.5) / (f.df + 0.5)) * l.tf * 2.2 / "
        "(l.tf + 1.2 * (0.25 + 0.75 * len(d.words) / t.avgdl))), 10) AS score, count(*) AS held "
        "FROM wanted w JOIN letter_words l ON l.term = w.term JOIN letters d ON d.ord = l.ord "
        "JOIN (SELECT term, count(*) AS df FROM letter_words GROUP BY term) f ON f.term = w.term "
        "CROSS JOIN (SELECT count(*) AS n, avg(len(words)) AS avgdl FROM letters) t "
        "WHERE l.ord <> w.golden_ord GROUP BY w.golden_ord, l.ord) h "
        "JOIN (SELECT golden_ord, count(*) AS asked FROM wanted GROUP BY golden_ord) USING (golden_ord) "
        "WHERE held = asked",
    ),
}


def _with(needs: str, query: str, known: dict[str, tuple[str, str]] = _STEPS) -> str:
    ordered: list[str] = []

    def add(name: str) -> None:
        if name in ordered:
            return
        for need in filter(None, known[name][0].split(",")):
            add(need)
        ordered.append(name)

    for need in filter(None, needs.split(",")):
        add(need)
    # Materialised, so that a step used twice is computed once.
    steps = ",\n".join(f"{name} AS MATERIALIZED ({known[name][1]})" for name in ordered)
    return (f"WITH {steps}\n" if steps else "") + query


# The same steps over all documents, with a vector or without.
_ALL_STEPS = _STEPS | {
    "copied": ("docs", "SELECT doc_id, chunk_id, chunk_text, embedding, ord FROM docs"),
    "units": ("copied", _STEPS["units"][1] + " WHERE embedding IS NOT NULL"),
}

# The same steps for sets of two golden chunks or three, which ``goldens`` has as one row each.
_SET_STEPS = _STEPS | {
    "types": ("", "SELECT unnest(['factual', 'keyword', 'comparison']) AS query_type"),
    "members": (
        "valid",
        "SELECT *, first_value(ord) OVER (PARTITION BY doc_id, number ORDER BY place) AS bundle_id FROM ("
        "SELECT *, least(place // 2, greatest(n // 2, 1) - 1) AS number FROM (SELECT *, count(*) OVER (PARTITION BY doc_id) AS n, "
        "row_number() OVER (PARTITION BY doc_id ORDER BY md5('42:' || ord), ord) - 1 AS place FROM valid))",
    ),
    "goldens": (
        "members",
        "SELECT bundle_id AS ord, any_value(doc_id) AS doc_id, string_agg(chunk_id, ',' ORDER BY ord) AS chunk_id, "
        "string_agg(chunk_text, ' ' ORDER BY ord) AS chunk_text, count(*) AS chunks FROM members GROUP BY bundle_id",
    ),
    "near": (
        "valid,members,sims",
        "SELECT golden_ord, ord, sim, row_number() OVER (PARTITION BY golden_ord ORDER BY sim DESC, ord) AS rank FROM ("
        "SELECT m.bundle_id AS golden_ord, s.r AS ord, max(s.sim) AS sim FROM members m JOIN sims s ON s.l = m.ord "
        "JOIN members o ON o.ord = s.r AND o.bundle_id <> m.bundle_id GROUP BY ALL) QUALIFY rank <= 3",
    ),
    "requests": (
        "goldens,distractors,types",
        _STEPS["requests"][1].replace("FROM valid v", "FROM goldens v").replace(_HASH, PAIRED.config_hash())
        + " WHERE v.chunks > 1 OR t.query_type <> 'comparison'",
    ),
    "own_words": ("goldens", _STEPS["own_words"][1].replace("FROM valid", "FROM goldens")),
}


def _pairs(table: str, threshold: float, extra: str = "") -> str:
    return (
        f"SELECT a.ord AS left_ord, b.ord AS right_ord, round(list_dot_product(a.u, b.u), 4) AS sim FROM "
        f"(SELECT ord, {_UNIT} AS u FROM {table}) a JOIN (SELECT ord, {_UNIT} AS u FROM {table}) b "
        f"ON a.ord < b.ord WHERE round(list_dot_product(a.u, b.u), 10) >= {threshold} {extra}"
    )


def _knn(table: str) -> str:
    return (
        "SELECT a.ord AS golden_ord, b.ord, row_number() OVER (PARTITION BY a.ord ORDER BY "
        "round(list_dot_product(a.u, b.u), 10) DESC, b.ord)::INTEGER AS rank, round(list_dot_product(a.u, b.u), 4) AS sim "
        f"FROM (SELECT ord, {_UNIT} AS u FROM {table}) a JOIN (SELECT ord, {_UNIT} AS u FROM {table}) b "
        "ON a.ord <> b.ord QUALIFY rank <= 3"
    )


_ALL_FIELDS = (
    "SELECT CASE WHEN lang = 'fr' THEN NULL ELSE doc_id END AS doc_id, CASE WHEN lang = 'fr' THEN NULL ELSE chunk_id END "
    "AS chunk_id, CASE WHEN lang = 'fr' THEN '' ELSE chunk_text END AS chunk_text, "
    "CASE WHEN lang = 'fr' OR embedding IS NULL THEN NULL ELSE len(embedding)::INTEGER END AS width, "
    "CASE WHEN lang = 'fr' THEN 'not JSON' WHEN embedding IS NULL THEN 'no embedding' ELSE '' END AS error FROM docs"
)
_PLAIN = "SELECT doc_id, chunk_id, chunk_text, len(embedding)::INTEGER AS width, '' AS error FROM chunks"
_DROPPED = (
    "SELECT c.ord FROM {0} c WHERE NOT EXISTS (SELECT 1 FROM (" + _pairs("chunks", 0.3) + ") p WHERE p.right_ord = c.ord)"
)
_BM25 = ["golden_score", "best_distractor_score", "golden_coverage", "best_distractor_coverage"]
_TRUTH = _with(
    "gated,queries",
    "SELECT q.query, q.doc_id AS expected_doc_ids, q.chunk_id, q.query_type, 'nonllm' AS evaluation, "
    "round(g.margin, 4) + 0.0 AS margin FROM queries q JOIN gated g USING (bundle_id, query_type) WHERE g.ok",
)


def _sample(table: str, key: str, size: str) -> str:
    return f"SELECT {key} FROM {table} ORDER BY md5('42:' || {key}), {key} LIMIT ({size})"


def _greedy(table: str) -> str:
    """Rows that a first-come scan keeps."""
    steps = (
        f",\npairs AS MATERIALIZED ({_pairs(table, 0.3)}),\n"
        "numbered AS MATERIALIZED (SELECT c.ord, row_number() OVER (ORDER BY c.ord) AS place, "
        f"coalesce(p.earlier, []) AS earlier FROM {table} c LEFT JOIN (SELECT right_ord, list(left_ord) AS earlier "
        "FROM pairs GROUP BY right_ord) p ON p.right_ord = c.ord),\n"
        "scan(place, kept) AS (SELECT 0::BIGINT, []::BIGINT[] UNION ALL SELECT n.place, "
        "CASE WHEN list_has_any(s.kept, n.earlier) THEN s.kept ELSE list_append(s.kept, n.ord) END "
        "FROM scan s JOIN numbered n ON n.place = s.place + 1)\n"
        f"SELECT unnest(kept) AS ord FROM scan WHERE place = (SELECT count(*) FROM {table})"
    )
    last = f"SELECT ord FROM {table}"
    return _with(table, last).replace("WITH ", "WITH RECURSIVE ", 1).replace("\n" + last, steps)


ORACLES: dict[str, str] = {
    "scan_jsonl": _with(
        "docs", "SELECT doc_id, chunk_id, chunk_text, len(embedding)::INTEGER AS width, '' AS error FROM docs "
        "WHERE lang <> 'fr' AND embedding IS NOT NULL",
    ),
    "scan_json_file": _with("chunks", _PLAIN),
    "scan_object_store": _with("chunks", _PLAIN),
    "scan_object_store_prefixes": _with(
        "chunks", "SELECT doc_id, chunk_id, chunk_text, len(embedding)::INTEGER AS width FROM chunks"
    ),
    "scan_paths": _with("chunks", _PLAIN),
    "input_type_dispatch": _with(
        "chunks", "SELECT doc_id, chunk_id, chunk_text, len(embedding)::INTEGER AS width FROM chunks"
    ),
    "load_order": _with(
        "copied", "SELECT doc_id, string_agg(chunk_id, ',' ORDER BY chunk_id) AS chunk_ids FROM copied GROUP BY doc_id"
    ),
    "number_lines": _with("chunks", "SELECT chunk_id, row_number() OVER (ORDER BY ord) - 1 AS place FROM chunks"),
    "stream_upsert": _with(
        "docs", "SELECT doc_id, chunk_id, chunk_text || CASE WHEN lang = 'en' THEN '!' ELSE '' END AS chunk_text FROM docs "
        f"WHERE lang <> 'fr' AND embedding IS NOT NULL AND {_COUNT} BETWEEN 5 AND 350",
    ),
    "incremental_load": _with("docs", _ALL_FIELDS),
    "stream_ingest": _with(
        "docs", "SELECT doc_id, chunk_id, chunk_text FROM docs WHERE lang <> 'fr' AND embedding IS NOT NULL "
        f"AND {_COUNT} BETWEEN 5 AND 350",
    ),
    "resolve_fields": _with("docs", _ALL_FIELDS),
    "quarantine": _with(
        "docs", "SELECT CASE WHEN lang = 'fr' THEN 'not JSON' ELSE 'no embedding' END AS error, chunk_id FROM docs "
        "WHERE lang = 'fr' OR embedding IS NULL",
    ),
    "check_dims": _with("chunks", "SELECT len(embedding)::INTEGER AS width, count(*) AS rows FROM chunks GROUP BY ALL"),
    "token_length_filter": _with(
        "docs", f"SELECT doc_id, chunk_id, {_COUNT}::INTEGER AS n_tokens FROM docs WHERE {_COUNT} BETWEEN 5 AND 350"
    ),
    "reject_reason": _with(
        "annotated", "SELECT doc_id, chunk_id, n_tokens::INTEGER AS n_tokens, CASE WHEN reject_reason IS NULL "
        "THEN 'Validated' END AS status, reject_reason FROM annotated",
    ),
    "split_valid_rejected": _with(
        "annotated", "SELECT CASE WHEN reject_reason IS NULL THEN 'valid' WHEN reject_reason LIKE 'Token%' THEN 'length' "
        "ELSE 'duplicate' END AS part, count(*) AS rows FROM annotated GROUP BY ALL",
    ),
    "incremental_validate": _with(
        "annotated", "SELECT doc_id, chunk_id, n_tokens::INTEGER AS n_tokens, CASE WHEN reject_reason IS NULL "
        "THEN 'Validated' END AS status, reject_reason FROM annotated",
    ),
    "incremental_validate_greedy": _greedy("copied"),
    "drop_vectors": _with("chunks", "SELECT doc_id, chunk_id, chunk_text, ord FROM chunks"),
    "stage_guard": _with("chunks", "SELECT doc_id, chunk_id FROM chunks"),
    "l2_normalize": _with(
        "units", "SELECT ord, (generate_subscripts(u, 1) - 1)::INTEGER AS pos, round(unnest(u), 6) + 0.0 AS x FROM units"
    ),
    "cosine_matrix_join": _with("chunks", _pairs("chunks", 0.3)),
    "near_duplicate_pairs": _with("copied", _pairs("copied", 0.98)),
    "near_duplicate_pairs_capped": _with(
        "sims", "SELECT l AS left_ord, r AS right_ord, round(sim, 4) AS sim FROM (SELECT *, row_number() OVER "
        "(PARTITION BY l ORDER BY sim DESC, r) AS place FROM sims) WHERE place <= 20 AND sim >= 0.3 AND r > l",
    ),
    "pairs_lsh": _with(
        "copied",
        f"SELECT DISTINCT right_ord, true AS holds FROM ({_pairs('turned', 0.98)}) UNION ALL SELECT -1, true",
    ).replace(
        "\nSELECT DISTINCT right_ord",
        ",\nturned AS MATERIALIZED (SELECT ord, embedding FROM copied UNION ALL SELECT ord + "
        f"{2 * COPY_OFFSET}, list_transform(embedding, lambda x, i: x * (1 + 0.1 * sin(i - 1 + ord))) FROM copied)\n"
        "SELECT DISTINCT right_ord",
    ),
    "dedup_any_earlier": _with("chunks", _DROPPED.format("chunks")),
    "dedup_fallback": _with("chunks", _DROPPED.format("docs")),
    "dedup_greedy": _greedy("chunks"),
    "dedup_sampled": _with(
        "sims",
        "SELECT DISTINCT least(l, r) AS left_ord, greatest(l, r) AS right_ord, round(sim, 4) AS sim FROM ("
        "SELECT *, row_number() OVER (PARTITION BY l ORDER BY sim DESC, r) AS place FROM sims WHERE l IN ("
        + _sample("copied", "ord", "300")
        + ")) WHERE place <= 9 AND sim >= 0.98",
    ),
    "knn_join": _with("copied", _knn("copied")),
    "search_strategy": _with("chunks", _knn("chunks")),
    "knn_ivf_all_cells": _with("chunks", _knn("chunks")),
    "vector_search": _with(
        "valid",
        "SELECT golden_ord, ord, (row_number() OVER (PARTITION BY golden_ord ORDER BY service_rank))::INTEGER AS rank, sim "
        "FROM (SELECT l AS golden_ord, r AS ord, row_number() OVER (PARTITION BY l ORDER BY sims.sim DESC, r) AS service_rank, "
        "round(sims.sim, 4) AS sim FROM sims WHERE l IN (SELECT ord FROM valid) QUALIFY service_rank <= 24) "
        "WHERE ord IN (SELECT ord FROM valid) QUALIFY rank <= 3",
    ),
    "key_terms": (
        "SELECT d.doc_id, coalesce(t.terms, '') AS terms FROM documents d LEFT JOIN (SELECT doc_id, "
        "string_agg(term, ' ' ORDER BY place) AS terms FROM (SELECT doc_id, term, row_number() OVER "
        "(PARTITION BY doc_id ORDER BY count(*) DESC, min(pos)) AS place FROM (SELECT doc_id, "
        f"unnest({_WORDS.format('text')}) AS term, generate_subscripts({_WORDS.format('text')}, 1) AS pos FROM documents) "
        f"WHERE regexp_matches(term, '^[a-z]+$') AND length(term) > 2 AND term NOT IN ({_STOP}) "
        "GROUP BY doc_id, term QUALIFY place <= 5) GROUP BY doc_id) t USING (doc_id)"
    ),
    "text_search": _with(
        "text_hits",
        "SELECT golden_ord, ord, rank::INTEGER AS rank, round(score, 4) AS score FROM text_hits WHERE rank <= 13",
        _ALL_STEPS,
    ),
    "hybrid_search": _with(
        "text_hits,sims",
        "SELECT golden_ord, ord, (row_number() OVER (PARTITION BY golden_ord ORDER BY round(s, 10) DESC, ord))::INTEGER AS rank, "
        "round(s, 6) AS sim FROM (SELECT golden_ord, ord, sum(1.0::DOUBLE / (60 + rank)) AS s FROM ("
        "SELECT golden_ord, ord, rank FROM text_hits WHERE rank <= 13 UNION ALL SELECT l, r, row_number() OVER "
        "(PARTITION BY l ORDER BY sim DESC, r) AS place FROM sims QUALIFY place <= 8) GROUP BY golden_ord, ord) "
        "QUALIFY rank <= 3",
        _ALL_STEPS,
    ),
    "sample_exact": _with(
        "chunks", "SELECT doc_id, chunk_id FROM chunks WHERE ord IN ("
        + _sample("chunks", "ord", "SELECT greatest(1, floor(count(*) * 0.1)::BIGINT) FROM chunks") + ")",
    ),
    "sample_documents": _with(
        "chunks", "SELECT doc_id, arg_min(chunk_id, (md5('42:' || ord), ord)) AS chunk_id FROM chunks WHERE doc_id IN ("
        + _sample("(SELECT DISTINCT doc_id FROM chunks)", "doc_id",
                  "SELECT greatest(1, floor(count(DISTINCT doc_id) * 0.5)::BIGINT) FROM chunks")
        + ") GROUP BY doc_id",
    ),
    "escalation_sample": _with(
        "docs", "SELECT doc_id, chunk_id, ('0x' || substr(md5('42:' || chunk_id), 1, 8))::BIGINT / 4294967296.0 < "
        f"{OPTIONS.escalation_rate} AS escalated FROM docs",
    ),
    "top_k_cut": _with(
        "docs", "SELECT doc_id, chunk_id, (row_number() OVER (PARTITION BY doc_id ORDER BY length(chunk_text) DESC, ord))"
        "::INTEGER AS rank FROM docs QUALIFY rank <= 2",
    ),
    "build_bundles": _with(
        "distractors", "SELECT v.ord AS bundle_id, d.rank::INTEGER AS rank, d.doc_id, d.chunk_id, d.chunk_text, "
        "round(d.sim, 4) AS sim FROM valid v LEFT JOIN distractors d ON d.bundle_id = v.ord",
    ),
    "multi_golden_bundles": _with(
        "goldens,distractors",
        "SELECT g.ord AS bundle_id, g.chunk_id AS golden_ids, d.rank::INTEGER AS rank, d.doc_id, d.chunk_id, "
        "round(d.sim, 4) AS sim FROM goldens g LEFT JOIN distractors d ON d.bundle_id = g.ord",
        _SET_STEPS,
    ),
    "multi_golden_requests": _with("requests", "SELECT bundle_id, query_type, request_key FROM requests", _SET_STEPS),
    "multi_golden_scores": _with(
        "scored", "SELECT bundle_id, query_type, slot::INTEGER AS slot, round(score, 4) + 0.0 AS score FROM scored", _SET_STEPS
    ),
    "expand_query_types": _with("valid,types", "SELECT ord AS bundle_id, query_type FROM valid CROSS JOIN types"),
    "build_prompt": _with(
        "requests",
        "SELECT bundle_id, query_type, 'Write one short ' || query_type || ' search query. The wanted text below must be "
        "enough to answer it; the look-alike text must not answer it.' || chr(10) || chr(10) || 'Wanted text:' || chr(10) || "
        "r.chunk_text || chr(10) || chr(10) || 'Look-alike text:' || chr(10) || coalesce(d.texts, '') || chr(10) || chr(10) "
        "|| 'Query:' AS prompt FROM requests r LEFT JOIN (SELECT bundle_id, string_agg(chunk_text, chr(10) || '---' || chr(10) "
        "ORDER BY rank) AS texts FROM distractors GROUP BY bundle_id) d USING (bundle_id)",
    ),
    "request_key": _with("requests", "SELECT bundle_id, query_type, request_key FROM requests"),
    "chunk_key": _with("docs", f"SELECT ord, substr(sha256(chunk_text || '|{_HASH}'), 1, 16) AS key FROM docs"),
    "completion_lookup": _with(
        "stored", "SELECT bundle_id, query_type, query, CASE WHEN query IS NULL THEN 'pending' ELSE 'answered' END AS status "
        "FROM requests LEFT JOIN stored USING (request_key)",
    ),
    "completion_merge": _with(
        "stored", "SELECT request_key, upper(query) AS query, 1::BIGINT AS created FROM completions",
    ),
    "assemble_queries": _with(
        "stored", "SELECT bundle_id, query_type, query FROM requests JOIN stored USING (request_key)"
    ),
    "extractive_queries": _with("completions", "SELECT request_key, query FROM completions"),
    "cache_stats": _with(
        "stored", "SELECT CASE WHEN query IS NULL THEN 'pending' ELSE 'answered' END AS status, count(*) AS requests, "
        "coalesce(sum(strlen(query)), 0)::BIGINT AS bytes FROM requests LEFT JOIN stored USING (request_key) GROUP BY ALL",
    ),
    "tokenize": f"SELECT doc_id, array_to_string({_TOKENS.format('text')}, ' ') AS tokens FROM documents",
    "bm25_local": _with(
        "scored", "SELECT bundle_id, query_type, slot::INTEGER AS slot, round(score, 4) AS score FROM scored"
    ),
    "overlap_score": _with(
        "scored", "SELECT bundle_id, query_type, slot::INTEGER AS slot, hits::DOUBLE AS score FROM scored"
    ),
    "golden_rank": _with("figures", "SELECT bundle_id, query_type, golden_rank::INTEGER AS golden_rank FROM figures"),
    "score_margin": _with("figures", "SELECT bundle_id, query_type, round(margin, 4) + 0.0 AS margin FROM figures"),
    "coverage": _with(
        "figures", "SELECT bundle_id, query_type, round(golden_coverage, 4) AS golden_coverage, "
        "round(best_distractor_coverage, 4) AS best_distractor_coverage FROM figures",
    ),
    "nonllm_accept": _with("gated", "SELECT bundle_id, query_type, ok AS accepted FROM gated"),
    "nonllm_metrics": _with(
        "figures", "SELECT bundle_id, query_type, golden_rank::INTEGER AS bm25_rank, round(margin, 4) + 0.0 AS bm25_margin, "
        + ", ".join(f"round({c}, 4) AS {c}" for c in _BM25) + " FROM figures",
    ),
    "evaluation_mode": _with(
        "gate",
        "SELECT 'none' AS mode, 'none' AS evaluation, count(*) AS rows FROM gate UNION ALL "
        "SELECT 'nonllm', 'nonllm', count(*) FROM gate WHERE ok HAVING count(*) > 0 UNION ALL "
        "SELECT 'llm', 'llm', count(*) FROM gate WHERE good HAVING count(*) > 0 UNION ALL "
        "SELECT 'hybrid', evaluation, count(*) FROM gate WHERE evaluation IS NOT NULL GROUP BY evaluation",
    ),
    "answer_join": _with(
        "judged", "SELECT bundle_id, query_type, coalesce(answer, substr(chunk_text, 1, 256)) AS answer FROM judged"
    ),
    "judge_accept": _with(
        "judged", "SELECT bundle_id, query_type, score AS judge_score, good AS open, coalesce(score >= 0.8, false) AS strict "
        "FROM judged",
    ),
    "hybrid_gate": _with(
        "gate", "SELECT bundle_id, query_type, judged, evaluation, evaluation IS NOT NULL AS accepted FROM gate"
    ),
    "expected_doc_ids": _with("queries", "SELECT bundle_id, query_type, doc_id AS expected_doc_ids FROM queries"),
    "context_chunks": _with("queries", "SELECT bundle_id, query_type, doc_id, chunk_id, chunk_text AS chunk FROM queries"),
    "ground_truth_rows": _TRUTH,
    "write_ground_truth": _TRUTH,
    "write_rejected": _with(
        "annotated", "SELECT doc_id, chunk_id, chunk_text, reject_reason FROM annotated WHERE reject_reason IS NOT NULL"
    ),
}
_PROMPTS = ORACLES["build_prompt"].split("\nSELECT bundle_id, query_type, 'Write", 1)[1]
ORACLES["pending_requests"] = _with(
    "stored", "SELECT DISTINCT request_key, 'Write" + _PROMPTS
) + " WHERE request_key NOT IN (SELECT request_key FROM stored)"
ORACLES["whole_run"] = _with(
    "figures,gated,queries",
    "SELECT q.bundle_id, q.query_type, q.query, g.golden_rank::INTEGER AS golden_rank, round(g.margin, 4) + 0.0 AS margin, "
    "g.ok AS accepted FROM queries q JOIN gated g USING (bundle_id, query_type) WHERE q.bundle_id IN ("
    + _sample("valid", "ord", "SELECT greatest(1, floor(count(*) * 0.25)::BIGINT) FROM valid")
    + ")",
)

ORACLES["chunk_documents"] = r"""
WITH t AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '\S+') AS toks FROM documents),
s AS (SELECT doc_id, toks, unnest(generate_series(0, greatest(len(toks) - 21, 0) // 80)) AS k FROM t WHERE len(toks) > 0)
SELECT doc_id::VARCHAR AS doc_id, doc_id || '#' || k AS chunk_id,
       array_to_string(toks[k * 80 + 1 : k * 80 + 100], ' ') AS chunk_text FROM s
"""
ORACLES["stopword_ratio_filter"] = _with(
    "docs",
    "SELECT doc_id, chunk_id, round(ratio, 6) AS stopword_ratio FROM (SELECT doc_id, chunk_id, "
    f"len(list_filter(words, lambda w: w IN ({_STOP}))) / greatest(len(words), 1) AS ratio FROM (SELECT doc_id, chunk_id, "
    f"list_filter({_WORDS.format('chunk_text')}, lambda w: regexp_matches(w, '^[a-z]+$')) AS words FROM docs)) "
    "WHERE ratio <= 0.3",
)
ORACLES["ranking_metrics"] = """
WITH found AS (
  SELECT source, doc_id, row_number() OVER (PARTITION BY source ORDER BY n_chars DESC, doc_id) AS rank FROM documents
),
wanted AS (SELECT source, doc_id FROM documents WHERE doc_id IN (SELECT doc_id FROM labels WHERE quality = 1)),
hits AS (SELECT w.source, f.rank FROM wanted w LEFT JOIN found f ON f.doc_id = w.doc_id AND f.rank <= 10),
gains AS (
  SELECT source, coalesce(sum(1 / log2(rank + 1)), 0) AS gain, coalesce(max(1 / rank), 0) AS mrr, count(*) AS n
  FROM hits GROUP BY source
)
SELECT source AS query_key,
       round(gain / list_sum(list_transform(generate_series(1, least(n, 10)), lambda r: 1 / log2(r + 1))), 6) AS ndcg,
       round(mrr, 6) AS mrr
FROM gains
"""
ORACLES["target_bundles"] = (
    "SELECT lang, doc_id, bundles FROM (SELECT d.lang, d.doc_id, w.bundles, row_number() OVER (PARTITION BY d.lang ORDER BY "
    "md5('42:' || d.doc_id), d.doc_id) AS place FROM documents d JOIN (SELECT lang, greatest(1, ceil(count(*) / 2))::INTEGER "
    "AS bundles FROM documents JOIN labels USING (doc_id) GROUP BY lang) w ON w.lang = d.lang) WHERE place <= bundles"
)
ORACLES["judge_requests"] = _with(
    "judged",
    "SELECT DISTINCT request_key AS query_key, query, coalesce(answer, substr(chunk_text, 1, 256)) AS answer, "
    "chunk_text AS context FROM judged WHERE NOT ok AND picked AND score IS NULL",
)
ORACLES["backend_info"] = _with(
    "chunks", "SELECT 'ivf' AS backend, count(*) AS rows, any_value(len(embedding))::INTEGER AS width FROM chunks"
)
ORACLES["knn_ivf"] = _with(
    "chunks",
    "SELECT ord AS golden_ord, 3::BIGINT AS rows, true AS holds FROM chunks "
    "UNION ALL SELECT -1, 3 * count(*), true FROM chunks",
)
ORACLES["stage_reuse"] = (
    "SELECT *, true AS validated_reused, true AS bundles_reused, false AS requests_reused FROM (" + ORACLES["whole_run"] + ")"
)
