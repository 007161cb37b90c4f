"""The SQL that each core query must agree with, for DuckDB."""

from __future__ import annotations

from packloom.functions import stopwords
from packloom.functions.text import SPACES

WS = " || ".join(f"chr({o})" for o in SPACES)
WS_CLASS = "[" + "".join(f"\\x{{{o:X}}}" for o in SPACES) + "]"
STOP = "[" + ", ".join(f"'{w}'" for w in stopwords.load()) + "]"
STRIPPED = f"SELECT doc_id, trim(text, {WS}) AS t FROM documents WHERE length(trim(coalesce(text, ''), {WS})) > 0"
LONG = "SELECT query_id, rank, chunk_index, score FROM ranked WHERE rank <= {k}"
USABLE = "len(embedding) = 384 AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x))) = 0"


def snippet(text: str, most: int = 200) -> str:
    return f"CASE WHEN length({text}) > {most} THEN substring({text}, 1, {most}) || '...' ELSE {text} END"


def fixed(size: int, overlap: int) -> str:
    """CTEs that end in ``fixed`` (doc_id, chunk_id, text, start_char)."""
    step, width = 4 * (size - overlap), 4 * size
    return f"""docs AS ({STRIPPED}),
        win AS (SELECT doc_id, t, length(t) > {width + 3} AS many,
            unnest(range(0, CASE WHEN length(t) <= {width + 3} THEN 1 ELSE 1 + CAST(ceil((length(t) - {width}) / {step}.0) AS BIGINT) END)) AS i FROM docs),
        part AS (SELECT doc_id, i, i * {step} AS a, CASE WHEN many THEN substring(t, i * {step} + 1, {width}) ELSE t END AS p FROM win),
        bare AS (SELECT doc_id, i, trim(p, {WS}) AS text, a + length(p) - length(ltrim(p, {WS})) AS start_char FROM part),
        fixed AS (SELECT doc_id, row_number() OVER (PARTITION BY doc_id ORDER BY i) - 1 AS chunk_id, text, start_char FROM bare WHERE length(text) > 0)"""


def sentence(size: int, overlap: int) -> str:
    """The chunks of sentence mode, by recursion over each document's windows."""
    width = 4 * size
    back = f"greatest(s + 1, e - least(e - s, {4 * overlap}))" if overlap else "e"
    end = f"""CASE WHEN s + {width} >= length(t) THEN length(t) ELSE s + coalesce(nullif(length(
        regexp_extract(substring(t, s + 1, {width + 1}), '(?s)^(.+[.!?]){WS_CLASS}', 1)), 0), {width}) END"""
    return f"""WITH RECURSIVE docs AS ({STRIPPED}),
        r AS (SELECT doc_id, t, 0::BIGINT AS s, CASE WHEN greatest(1, length(t) // 4) <= {size} THEN length(t) ELSE {end} END AS e
              FROM (SELECT *, 0::BIGINT AS s FROM docs)
              UNION ALL
              SELECT doc_id, t, s, {end} AS e FROM (SELECT doc_id, t, {back} AS s FROM r WHERE e < length(t))),
        part AS (SELECT doc_id, s, substring(t, s + 1, e - s) AS p FROM r),
        bare AS (SELECT doc_id, s, trim(p, {WS}) AS text, s + length(p) - length(ltrim(p, {WS})) AS start_char FROM part),
        chunked AS (SELECT doc_id, row_number() OVER (PARTITION BY doc_id ORDER BY s) - 1 AS chunk_id, text, start_char FROM bare WHERE length(text) > 0)
        {CHUNK_ROWS.format(source="chunked")}"""


CHUNK_ROWS = """SELECT doc_id, CAST(chunk_id AS INTEGER) AS chunk_id, CAST(start_char AS INTEGER) AS start_char, CAST(start_char + length(text) AS INTEGER) AS end_char,
    CAST(greatest(1, length(text) // 4) AS INTEGER) AS token_count, CAST(length(text) AS INTEGER) AS char_count, md5(text) AS text_md5 FROM {source}"""


def tokens(table: str, key: str) -> str:
    """(key, term, tf) of a table's texts."""
    return f"""SELECT {key}, term, count(*) AS tf FROM (SELECT {key}, unnest(w || list_transform(range(1, greatest(len(w), 1)), lambda i: w[i] || ' ' || w[i + 1])) AS term FROM (
        SELECT {key}, list_filter(regexp_extract_all(lower(text), '[\\p{{L}}\\p{{N}}_]{{2,}}'), lambda x: NOT list_contains({STOP}, x)) AS w FROM {table} WHERE text IS NOT NULL)) GROUP BY ALL"""


TFIDF = f"""counts AS ({tokens("documents", "doc_id")}),
    vocab AS (SELECT term, row_number() OVER (ORDER BY term) - 1 AS feature_index, df, ctf, ln((1.0 + (SELECT count(*) FROM documents)) / (1 + df)) + 1 AS idf
        FROM (SELECT term, count(*) AS df, CAST(sum(tf) AS BIGINT) AS ctf FROM counts GROUP BY term ORDER BY ctf DESC, term LIMIT 5000)),
    raw AS (SELECT doc_id, term, tf, tf * idf AS w FROM counts JOIN vocab USING (term)),
    weights AS (SELECT doc_id AS chunk_index, term, tf, w / sqrt(sum(w * w) OVER (PARTITION BY doc_id)) AS weight FROM raw)"""
ASKED = f"""qraw AS (SELECT item_id, term, tf * idf AS w FROM ({tokens("benchmark_items", "item_id")}) JOIN vocab USING (term)),
    asked AS (SELECT item_id AS query_id, term, w / sqrt(sum(w * w) OVER (PARTITION BY item_id)) AS q FROM qraw),
    scores AS (SELECT query_id, chunk_index, round(sum(q * weight), 6) AS score FROM asked JOIN weights USING (term) GROUP BY ALL),
    ranked AS (SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, chunk_index) AS INTEGER) AS rank, chunk_index, score FROM scores WHERE score > 0)"""
POINTS = "SELECT {key}, point, count(*) AS n FROM (SELECT {key}, unicode(unnest(string_split(lower(text), ''))) AS point FROM {table} WHERE text IS NOT NULL) WHERE point > 0 AND point < 256 GROUP BY ALL"
HISTOGRAMS = f"""h AS ({POINTS.format(key="doc_id", table="documents")}), g AS ({POINTS.format(key="item_id", table="benchmark_items")}),
    hn AS (SELECT doc_id, sqrt(sum(n * n)) AS norm FROM h GROUP BY doc_id), gn AS (SELECT item_id, sqrt(sum(n * n)) AS norm FROM g GROUP BY item_id),
    dot AS (SELECT item_id, doc_id, sum(g.n * h.n) AS d FROM g JOIN h USING (point) GROUP BY ALL),
    hits AS (SELECT item_id AS query_id, doc_id AS chunk_index, round(d / (hn.norm * gn.norm), 6) AS score FROM dot JOIN hn USING (doc_id) JOIN gn USING (item_id)),
    dense AS (SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, chunk_index) AS INTEGER) AS rank, chunk_index, score FROM hits)"""


def cosine(table: str, where: str, k: int, usable: str = "TRUE") -> str:
    """CTE ``ranked`` of the queries ``where`` against all rows of a vector table."""
    return f"""v AS (SELECT vec_id, embedding::DOUBLE[] AS e FROM {table} WHERE {usable}),
        s AS (SELECT q.vec_id AS query_id, v.vec_id AS chunk_index, round(list_cosine_similarity(q.e, v.e), 6) AS score FROM v AS q, v WHERE {where}),
        ranked AS (SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, chunk_index) AS INTEGER) AS rank, chunk_index, score FROM s)"""


RULES = """rules AS (SELECT pack_id, 'R' || r AS rule, NOT coalesce((pack_version IS NULL AND r IN (1, 2)) OR (pack_version <> '1.1' AND r = 2), FALSE) AS ok FROM packs, range(1, 19) AS t(r))"""
COVERAGE = """cov AS (SELECT pack_id, coalesce(c, 0) AS num_chunks, coalesce(m, 0) AS num_citations, CASE WHEN coalesce(c, 0) > 0 THEN coalesce(m, 0) / c * 100 ELSE 0.0 END AS share
    FROM (SELECT pack_id, count(*) AS c FROM chunks GROUP BY pack_id) FULL JOIN (SELECT pack_id, count(*) AS m FROM citations GROUP BY pack_id) USING (pack_id))"""
WRITTEN = """written AS (SELECT row_number() OVER (ORDER BY vec_id) - 1 AS chunk_index, text, CAST(embedding[1] AS DOUBLE) AS first_value, CAST(embedding[384] AS DOUBLE) AS last_value, 384 AS dimension,
    chunk_id, doc_id, start_char, end_char, page_number FROM chunk_vectors JOIN chunks USING (chunk_index) WHERE len(embedding) = 384 AND text IS NOT NULL)"""
PACKED = f"WITH {WRITTEN} SELECT chunk_index, text, first_value, last_value, dimension FROM written"


def oracle_sql() -> dict[str, str]:
    """SQL by query name."""
    return {
        "token_count_estimate": "SELECT doc_id, CAST(greatest(1, length(text) // 4) AS INTEGER) AS token_count FROM documents WHERE text IS NOT NULL",
        "chunk_fixed_512_50": f"WITH {fixed(512, 50)} {CHUNK_ROWS.format(source='fixed')}",
        "chunk_fixed_200_30": f"WITH {fixed(200, 30)} {CHUNK_ROWS.format(source='fixed')}",
        "chunk_sentence_512_50": sentence(512, 50),
        "chunk_sentence_200_30": sentence(200, 30),
        "chunk_no_overlap": sentence(128, 0),
        "chunk_counts_per_doc": f"WITH {fixed(512, 50)} SELECT doc_id, count(*) AS chunks FROM fixed GROUP BY doc_id",
        "chunk_info": f"SELECT doc_id, chunk_id, token_count, char_count, {snippet('text', 100)} AS preview FROM chunks",
        "chunk_snippet": f"SELECT chunk_index, {snippet('text')} AS snippet FROM chunks",
        "paragraph_boundaries": """SELECT chunk_index, array_to_string(list_transform(range(1, len(p)), lambda i: CAST(list_sum(list_transform(p[1:i], lambda x: length(x) + 2)) AS BIGINT) - 2), ',') AS boundaries
            FROM (SELECT chunk_index, string_split(text, chr(10) || chr(10)) AS p FROM chunks WHERE text IS NOT NULL)""",
        "pack_stats": """SELECT 'loaded' AS status, count(*) AS num_chunks, CAST(min(length(text)) AS INTEGER) AS min_chunk_length, CAST(max(length(text)) AS INTEGER) AS max_chunk_length,
            round(avg(length(text)), 6) AS avg_chunk_length, (SELECT CAST(max(len(embedding)) AS INTEGER) FROM chunk_vectors) AS embedding_dimension, TRUE AS has_citations,
            (SELECT count(*) FROM citations) AS num_citations FROM chunks WHERE text IS NOT NULL""",
        "char_histogram_embedding": f"SELECT item_id, CAST(point AS INTEGER) AS point, round(n / CAST(sum(n) OVER (PARTITION BY item_id) AS BIGINT), 6) AS share FROM ({POINTS.format(key='item_id', table='benchmark_items')})",
        "embedder_hash": "SELECT pack_id, substring(md5(concat_ws('_', embedder_name, CAST(dimensions AS VARCHAR))), 1, 16) AS hash FROM packs",
        "hash_embedding_props": "SELECT item_id, 384 AS dimension, 1.0::DOUBLE AS norm FROM benchmark_items",
        "register_latest": "SELECT s.doc_id, s.seq, s.title, s.path, s.page_count, f.first_seq FROM source_documents s JOIN (SELECT doc_id, max(seq) AS seq, min(seq) AS first_seq FROM source_documents GROUP BY doc_id) f USING (doc_id, seq)",
        "index_metadata": "SELECT (SELECT count(DISTINCT doc_id) FROM source_documents) AS document_count, (SELECT count(*) FROM chunks) AS chunk_count",
        "page_line_estimate": "SELECT chunk_index, CAST(start_char // 2000 + 1 AS INTEGER) AS page_number, CAST(start_char // 80 + 1 AS INTEGER) AS line_number FROM chunks",
        "term_frequency": f"SELECT doc_id, term, count(*) AS tf FROM (SELECT doc_id, unnest(string_split_regex(lower(t), '{WS_CLASS}+')) AS term FROM ({STRIPPED})) GROUP BY ALL",
        "term_frequency_stats": f"SELECT doc_id, CAST(len(w) AS INTEGER) AS document_length, CAST(len(list_distinct(w)) AS INTEGER) AS unique_terms FROM (SELECT doc_id, string_split_regex(lower(t), '{WS_CLASS}+') AS w FROM ({STRIPPED}))",
        "l2_normalize": """SELECT vec_id, CAST(i - 1 AS INTEGER) AS place, round(e[i] / sqrt(list_sum(list_transform(e, lambda x: x * x))), 6) AS value
            FROM (SELECT vec_id, embedding::DOUBLE[] AS e, unnest(range(1, len(embedding) + 1)) AS i FROM embeddings)""",
        "cosine_topk": f"WITH {cosine('embeddings', 'q.vec_id = 0', 10)} {LONG.format(k=10)}",
        "cosine_topk_batch": f"WITH {cosine('embeddings', 'q.vec_id % 50 = 0', 10)} {LONG.format(k=10)}",
        "cosine_self_top1": f"WITH {cosine('embeddings', 'q.vec_id % 50 = 0', 1)} {LONG.format(k=1)}",
        "text_dense_topk": f"WITH {HISTOGRAMS} SELECT query_id, rank, chunk_index, score FROM dense WHERE rank <= 5",
        "citations": f"""SELECT chunk_id, doc_id, coalesce(start_char, 0) AS start_char, coalesce(end_char, 0) AS end_char, {snippet('text')} AS snippet,
            array_to_string(coalesce(paragraph_boundaries, []), ',') AS paragraph_boundaries, page_number, line_number, '' AS context_before, '' AS context_after FROM chunks""",
        "citations_cumulative": f"""WITH {fixed(200, 30)}, c AS (SELECT *, sum(length(text)) OVER (PARTITION BY doc_id ORDER BY chunk_id) AS e FROM fixed)
            SELECT CAST(doc_id AS VARCHAR) || '#' || printf('%05d', chunk_id) AS chunk_ref, printf('p-%04d', chunk_id) AS para_id, CAST(e - length(text) AS BIGINT) AS start_char, CAST(e AS BIGINT) AS end_char, substring(text, 1, 200) AS snippet FROM c""",
        "citation_lookup": """SELECT k.chunk_index, c.citation_id, c.snippet FROM chunks k LEFT JOIN
            (SELECT * FROM citations WHERE chunk_index IS NOT NULL QUALIFY row_number() OVER (PARTITION BY chunk_index ORDER BY citation_id) = 1) c USING (chunk_index)""",
        "search_with_citations": f"""WITH {cosine('chunk_vectors', 'q.vec_id % 50 = 0', 5, USABLE + ' AND list_max(list_transform(embedding, lambda x: abs(x))) > 0')},
            c AS (SELECT * FROM citations WHERE chunk_index IS NOT NULL QUALIFY row_number() OVER (PARTITION BY chunk_index ORDER BY citation_id) = 1)
            SELECT r.query_id, r.rank, cv.chunk_index, r.score, c.citation_id, c.snippet FROM ranked r JOIN chunk_vectors cv ON cv.vec_id = r.chunk_index LEFT JOIN c ON c.chunk_index = cv.chunk_index WHERE r.rank <= 5""",
        "tfidf_vocab": f"WITH {TFIDF} SELECT term, CAST(feature_index AS INTEGER) AS feature_index, df, ctf FROM vocab",
        "tfidf_idf": f"WITH {TFIDF} SELECT term, round(idf, 6) AS idf FROM vocab",
        "tfidf_weights": f"WITH {TFIDF} SELECT chunk_index, term, tf, round(weight, 6) AS weight FROM weights",
        "tfidf_topk": f"WITH {TFIDF}, {ASKED} {LONG.format(k=5)}",
        "tfidf_sidecar_roundtrip": f"WITH {TFIDF}, {ASKED} {LONG.format(k=5)}",
        "tfidf_top_features": f"""WITH {TFIDF}, r AS (SELECT chunk_index, term, round(weight, 6) AS weight FROM weights),
            o AS (SELECT chunk_index, CAST(row_number() OVER (PARTITION BY chunk_index ORDER BY weight DESC, term) AS INTEGER) AS rank, term, weight FROM r) SELECT * FROM o WHERE rank <= 10""",
        "dense_vs_lexical": f"""WITH {TFIDF}, {ASKED}, {HISTOGRAMS}
            SELECT 'dense' AS method, query_id, rank, chunk_index, score FROM dense WHERE rank <= 5 UNION ALL SELECT 'lexical', query_id, rank, chunk_index, score FROM ranked WHERE rank <= 5""",
        "result_format": f"""WITH {TFIDF}, {ASKED} SELECT query_id, string_agg(printf('%d. [Score: %.4f] %s', rank, CAST(round(CAST(score AS DECIMAL(18, 6)), 4) AS DOUBLE), {snippet('text')}), chr(10) || chr(10) ORDER BY rank) AS output
            FROM ranked JOIN documents ON doc_id = chunk_index WHERE rank <= 5 GROUP BY query_id""",
        "pack_roundtrip_zip": PACKED,
        "pack_roundtrip_dir": PACKED,
        "pack_roundtrip_legacy": PACKED,
        "pack_roundtrip_csv": PACKED,
        "pack_manifest_sources": """SELECT CAST(row_number() OVER (ORDER BY first_seq) - 1 AS INTEGER) AS place, doc_id, title, path, CAST(page_count AS BIGINT) AS page_count, CAST(char_count AS BIGINT) AS char_count
            FROM source_documents s JOIN (SELECT doc_id, max(seq) AS seq, min(seq) AS first_seq FROM source_documents GROUP BY doc_id) f USING (doc_id, seq)""",
        "enriched_terms": f"""SELECT chunk_index, term, count(*) AS tf FROM (SELECT chunk_index, unnest(string_split_regex(lower(t), '{WS_CLASS}+')) AS term FROM (
            SELECT chunk_index, trim(text, {WS}) AS t FROM chunks WHERE length(trim(coalesce(text, ''), {WS})) > 0)) GROUP BY ALL""",
        "chunk_fixed_repeated_ids": f"""WITH r AS (SELECT row_number() OVER () AS row, doc_id, trim(text, {WS}) AS t FROM chunks WHERE length(trim(coalesce(text, ''), {WS})) > 0),
            win AS (SELECT row, doc_id, t, length(t) > 259 AS many, unnest(range(0, CASE WHEN length(t) <= 259 THEN 1 ELSE 1 + CAST(ceil((length(t) - 256) / 216.0) AS BIGINT) END)) AS i FROM r),
            bare AS (SELECT row, doc_id, i, trim(CASE WHEN many THEN substring(t, i * 216 + 1, 256) ELSE t END, {WS}) AS p FROM win),
            c AS (SELECT doc_id, CAST(row_number() OVER (PARTITION BY row ORDER BY i) - 1 AS INTEGER) AS chunk_id, length(p) AS n FROM bare WHERE length(p) > 0)
            SELECT doc_id, chunk_id, count(*) AS n, CAST(sum(n) AS BIGINT) AS characters FROM c GROUP BY ALL""",
        "stream_window_counts": """SELECT date_trunc('day', ingested_at)::TIMESTAMP AS day, source, count(*) AS documents, CAST(sum(length(text)) AS BIGINT) AS characters FROM documents
            WHERE ingested_at IS NOT NULL AND source IS NOT NULL AND date_trunc('day', ingested_at) + INTERVAL 1 DAY <= (SELECT max(ingested_at) - INTERVAL 7 DAY FROM documents WHERE source IS NOT NULL) GROUP BY ALL""",
        "pack_citations_roundtrip": f"WITH {WRITTEN} SELECT chunk_index AS line, chunk_id, doc_id, start_char, end_char, page_number FROM written",
        "manifest_validation": f"WITH {RULES} SELECT pack_id, rule, ok FROM rules",
        "citation_coverage": f"WITH {COVERAGE} SELECT pack_id, num_chunks, num_citations, round(share, 6) AS coverage, share >= 95 AS coverage_ok FROM cov",
        "pack_verdict": f"""WITH {RULES}, {COVERAGE} SELECT pack_id, pack_version IS NOT NULL AND bool_and(ok) AS valid, coalesce(any_value(share >= 95), FALSE) AS coverage_ok
            FROM rules JOIN packs USING (pack_id) LEFT JOIN cov USING (pack_id) GROUP BY pack_id, pack_version""",
        "suffix_filter_sorted": "SELECT path FROM source_documents WHERE lower(path) LIKE '%.pdf'",
        "document_text_from_pages": f"SELECT doc_id, md5(t) AS text_md5, length(t) AS n_chars FROM (SELECT doc_id, string_agg(coalesce(text, ''), '' ORDER BY chunk_index) AS t FROM chunks GROUP BY doc_id) WHERE length(trim(t, {WS})) > 0",
        "stream_chunk_counts": f"WITH {fixed(512, 50)} SELECT doc_id, count(*) AS chunks FROM fixed GROUP BY doc_id",
    }
