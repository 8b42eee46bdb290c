"""One SQL statement per query key."""

from __future__ import annotations

from passagerank.oracle.parts import FEATURES, PARTS, SEED, compose, rnd, tokens
from passagerank.oracle.stemming import stems_of

CUTOFFS = (5, 10, 15, 20, 30, 100, 200, 500, 1000)
BLANKS = "regexp_replace(text, '\\s+', ' ', 'g')"


def _scored(run: str, digits: int = 4) -> str:
    return f"SELECT qid, doc_id, CAST(rank AS BIGINT) AS rank, {rnd('score', digits)} AS score FROM {run}"


def _per_query(columns: dict[str, str], digits: int = 6) -> str:
    listed = ", ".join(f"{rnd('coalesce(' + sql + ', 0)', digits)} AS {name}" for name, sql in columns.items())
    return f"SELECT qid, {listed} FROM needs LEFT JOIN placed USING (qid) GROUP BY qid"


_OVER_R = "/any_value(needs.r)"
MEASURES: dict[str, dict[str, str]] = {
    "map": {"map": "sum(CASE WHEN rel = 1 THEN rels/pos END)" + _OVER_R},
    "rprec": {"rprec": "count(*) FILTER (WHERE rel = 1 AND pos <= placed.r)" + _OVER_R},
    "bpref": {
        "bpref": "sum(CASE WHEN rel = 1 THEN CASE WHEN nonrels = 0 THEN 1 "
        "ELSE 1-least(nonrels, placed.r)/least(placed.r, placed.m) END END)" + _OVER_R
    },
    "recip_rank": {"recip_rank": "1/min(CASE WHEN rel = 1 THEN pos END)"},
    "iprec": {
        f"iprec_{p // 10}_{p % 10}": f"max(CASE WHEN rels*10 >= {p}*placed.r THEN rels/pos END)" for p in range(11)
    },
    "precision": {f"p_{k}": f"count(*) FILTER (WHERE rel = 1 AND pos <= {k})/{k}" for k in CUTOFFS},
    "recall": {f"recall_{k}": f"count(*) FILTER (WHERE rel = 1 AND pos <= {k})" + _OVER_R for k in CUTOFFS},
}


def _zero_if_none(sql: str) -> str:
    """R can be 0 for a judged query."""
    return f"CASE WHEN any_value(needs.r) > 0 THEN {sql} ELSE 0 END" if sql.endswith(_OVER_R) else sql


_NDCG = "SELECT qid, " + ", ".join(
    f"{rnd(f'coalesce(CASE WHEN i{k} > 0 THEN d{k}/i{k} END, 0)')} AS ndcg_{k}" for k in (1, 3, 5, 10)
) + (
    " FROM (SELECT qid, " + ", ".join(
        f"sum(CASE WHEN pos <= {k} THEN (pow(2, coalesce(rating, 0))-1)/log2(1+pos) END) AS d{k}" for k in (1, 3, 5, 10)
    ) + " FROM needs LEFT JOIN placed USING (qid) GROUP BY qid) JOIN (SELECT qid, " + ", ".join(
        f"sum(CASE WHEN ip <= {k} THEN (pow(2, rating)-1)/log2(1+ip) END) AS i{k}" for k in (1, 3, 5, 10)
    ) + " FROM (SELECT qid, rating, row_number() OVER (PARTITION BY qid ORDER BY rating DESC, doc_id) AS ip FROM qrels) "
    "GROUP BY qid) USING (qid)"
)


def _report() -> str:
    columns = {n: _zero_if_none(s) for m in MEASURES.values() for n, s in m.items()}
    means = ", ".join(f"coalesce({sql}, 0) AS {name}" for name, sql in columns.items())
    per_query = f"SELECT qid, {means} FROM needs LEFT JOIN placed USING (qid) GROUP BY qid"
    rows = [
        f"SELECT '{name}' AS measure, avg({name}) AS value FROM ({per_query})" for name in columns
    ]
    rows.append("SELECT 'gm_map' AS measure, exp(avg(ln(greatest(ap, 1e-5)))) AS value FROM aps")
    rows.append("SELECT 'num_q' AS measure, count(*) AS value FROM needs")
    rows.append("SELECT 'num_ret' AS measure, count(*) AS value FROM placed")
    rows.append("SELECT 'num_rel' AS measure, sum(r) AS value FROM needs")
    rows.append("SELECT 'num_rel_ret' AS measure, sum(rel) AS value FROM placed")
    union = " UNION ALL ".join(
        f"SELECT measure, CAST(value AS DOUBLE) AS value FROM ({row})" for row in rows
    )
    return f"SELECT measure, {rnd('value')} AS value FROM ({union})"


def _experiment() -> str:
    runs = (
        "SELECT 'bm25' AS name, qid, doc_id, score FROM run UNION ALL SELECT 'sample', qid, doc_id, score FROM ltr "
        "UNION ALL SELECT 'overlap', qid, doc_id, score FROM tied"
    )
    placed = (
        f"SELECT name, u.qid, u.doc_id, rating, CASE WHEN rating >= 1 THEN 1 ELSE 0 END AS rel, row_number() OVER "
        f"(PARTITION BY name, u.qid ORDER BY score DESC, CAST(u.doc_id AS VARCHAR) DESC) AS pos "
        f"FROM ({runs}) u LEFT JOIN qrels ON u.qid = qrels.qid AND u.doc_id = qrels.doc_id"
    )
    counted = f"SELECT *, sum(rel) OVER (PARTITION BY name, qid ORDER BY pos) AS rels FROM ({placed})"
    ks = (1, 3, 5, 10)
    ideal = "SELECT qid, " + ", ".join(
        f"sum(CASE WHEN ip <= {k} THEN (pow(2, rating)-1)/log2(1+ip) END) AS i{k}" for k in ks
    ) + " FROM (SELECT qid, rating, row_number() OVER (PARTITION BY qid ORDER BY rating DESC, doc_id) AS ip FROM qrels) GROUP BY qid"
    systems = "SELECT * FROM needs, (VALUES ('bm25'), ('sample'), ('overlap')) v(name)"
    values = (
        "SELECT s.name, s.qid, CASE WHEN any_value(s.r) > 0 THEN coalesce(sum(CASE WHEN rel = 1 THEN rels/pos END), 0)"
        "/any_value(s.r) ELSE 0 END AS map, coalesce(1/min(CASE WHEN rel = 1 THEN pos END), 0) AS recip_rank, "
        + ", ".join(
            f"CASE WHEN any_value(i{k}) > 0 THEN coalesce(sum(CASE WHEN pos <= {k} THEN "
            f"(pow(2, coalesce(rating, 0))-1)/log2(1+pos) END), 0)/any_value(i{k}) ELSE 0 END AS ndcg_{k}" for k in ks
        )
        + f" FROM ({systems}) s JOIN ({ideal}) i ON s.qid = i.qid LEFT JOIN ({counted}) c "
        "ON s.name = c.name AND s.qid = c.qid GROUP BY s.name, s.qid"
    )
    columns = ["map", "recip_rank", *[f"ndcg_{k}" for k in ks]]
    return f"SELECT name, {', '.join(f'{rnd(f'avg({c})')} AS {c}' for c in columns)} FROM ({values}) GROUP BY name"


_LAMBDA = f"""
    SELECT qid, doc_id, {rnd('coalesce(sum(g), 0.0)')} AS grad, {rnd('coalesce(sum(h), 0.0)')} AS hess FROM (
      SELECT qid, doc_id, 0.0::DOUBLE AS g, 0.0::DOUBLE AS h FROM ltr
      UNION ALL
      SELECT qid, unnest([i, j]) AS doc_id, unnest([rho*delta, -rho*delta]) AS g,
             unnest([rho*(1-rho)*delta, rho*(1-rho)*delta]) AS h FROM (
        SELECT a.qid, a.doc_id AS i, b.doc_id AS j, 1/(1+exp(a.score-b.score)) AS rho,
               abs(a.gain-b.gain)*abs(a.disc-b.disc)/m.best AS delta
        FROM (SELECT *, pow(2, label)-1 AS gain, 1/log2(1+row_number() OVER (PARTITION BY qid ORDER BY score DESC, doc_id))
              AS disc FROM ltr) a
        JOIN (SELECT *, pow(2, label)-1 AS gain, 1/log2(1+row_number() OVER (PARTITION BY qid ORDER BY score DESC, doc_id))
              AS disc FROM ltr) b ON a.qid = b.qid AND a.label > b.label
        JOIN (SELECT qid, sum((pow(2, label)-1)/log2(1+ip)) AS best FROM (SELECT qid, label, row_number() OVER
              (PARTITION BY qid ORDER BY label DESC, doc_id) AS ip FROM ltr) GROUP BY qid) m ON m.qid = a.qid))
    GROUP BY qid, doc_id"""

_SAFE = "translate({}, 'ßäçèéêíñóöü', 'ABCDEFGHIJK')"
_SPELL = f"""
    SELECT qid, query, corrected, corrected <> query AS changed FROM typos JOIN (
      SELECT qid, string_agg(coalesce(fix, original), ' ' ORDER BY spot) AS corrected FROM (
        SELECT qid, unnest(string_split(query, ' ')) AS original, unnest(range(1, len(string_split(query, ' '))+1)) AS spot
        FROM typos) LEFT JOIN (
        SELECT word, term AS fix FROM (
          SELECT word, term, row_number() OVER (PARTITION BY word ORDER BY d, df DESC, term) AS rn FROM (
            SELECT word, term, df, levenshtein({_SAFE.format('word')}, {_SAFE.format('term')}) AS d FROM (
              SELECT DISTINCT unnest(string_split(query, ' ')) AS word FROM typos) JOIN surface
              ON abs(length(word)-length(term)) <= 2
            WHERE word <> '' AND word NOT IN (SELECT term FROM surface)) WHERE d <= 2) WHERE rn = 1)
      ON original = word GROUP BY qid) USING (qid)"""

PARTS["mended"] = _SPELL


def _coverage(k: int) -> str:
    return (
        "SELECT qid, doc_id, row_number() OVER (PARTITION BY qid ORDER BY cover DESC, rank)-1 AS rank, "
        "CAST(rank AS BIGINT) AS prior_rank, " + rnd("cover") + " AS score FROM ("
        "SELECT run.qid, run.doc_id, rank, CASE WHEN len(qw) > 0 THEN len(list_intersect(qw, w))/len(qw) ELSE 0 END AS cover "
        f"FROM run JOIN tok USING (doc_id) JOIN (SELECT qid, list_distinct({tokens('query')}) AS qw FROM topics) USING (qid) "
        f"WHERE rank < {k})"
    )


# One boosting step from scores of zero: pairs in the order of documents, Newton steps per leaf.
_STEP = f"""
    SELECT qid, doc_id, {rnd('coalesce(0.1*sum(g) OVER leaves / nullif(sum(h) OVER leaves, 0), 0.0)')} AS score FROM (
      SELECT cand.qid, cand.doc_id, g, h, CASE
        WHEN f_tf/1e9 <= 2.5 THEN CASE WHEN f_sample/1e9 <= 4.000000123 THEN 5 ELSE 6 END
        WHEN f_tf/1e9 <= 5.5 THEN 3 WHEN f_pl2/1e9 <= 3.000000123 THEN 7 ELSE 8 END AS leaf
      FROM cand LEFT JOIN (
        SELECT qid, doc_id, sum(g) AS g, sum(h) + 0.001 AS h FROM (
          SELECT qid, unnest([i, j]) AS doc_id, unnest([0.5*delta, -0.5*delta]) AS g, unnest([0.25*delta, 0.25*delta]) AS h FROM (
            SELECT a.qid, a.doc_id AS i, b.doc_id AS j, abs(a.gain-b.gain)*abs(a.disc-b.disc)/m.best AS delta
            FROM (SELECT *, pow(2, label)-1 AS gain, 1/log2(1+row_number() OVER (PARTITION BY qid ORDER BY doc_id)) AS disc
                  FROM ltr) a
            JOIN (SELECT *, pow(2, label)-1 AS gain, 1/log2(1+row_number() OVER (PARTITION BY qid ORDER BY doc_id)) AS disc
                  FROM ltr) b ON a.qid = b.qid AND a.label > b.label
            JOIN (SELECT qid, sum((pow(2, label)-1)/log2(1+ip)) AS best FROM (SELECT qid, label, row_number() OVER
                  (PARTITION BY qid ORDER BY label DESC, doc_id) AS ip FROM ltr) GROUP BY qid) m ON m.qid = a.qid))
        GROUP BY qid, doc_id) pulls ON pulls.qid = cand.qid AND pulls.doc_id = cand.doc_id)
    WINDOW leaves AS (PARTITION BY leaf)"""

# Two trees with a weight of a half.
_GIVEN = f"""
    SELECT qid, doc_id, row_number() OVER (PARTITION BY qid ORDER BY total DESC, rank)-1 AS rank, {rnd('total')} AS score FROM (
      SELECT qid, doc_id, rank, 0.5 * CASE WHEN f_tf/1e9 <= 3.5 THEN 0.25 WHEN f_sample/1e9 <= 6.000000123 THEN 0.5 ELSE 2.0 END
        + 0.5 * CASE WHEN f_tf/1e9 <= 1.5 THEN -1.0 ELSE 1.0 END AS total FROM cand)"""

_IDS = "SELECT CAST(qid AS VARCHAR) AS qid, CAST(doc_id AS VARCHAR) AS doc_id, CAST(rank AS BIGINT) AS rank, "
# What must hold of any trained run: all candidates of a query, ranked densely by score, ties in candidate order.
_TRAINED = (
    "SELECT qid, count(*) AS n_rows, true AS same_candidates, true AS dense_ranks, true AS by_score, true AS stable_ties, "
    "true AS gains, true AS importances_sum_to_one, true AS same_after_reload FROM ltr GROUP BY qid"
)

_STATEMENTS: dict[str, str] = {
    "run_trec_file": _IDS + "CAST(round(score, 2) AS DOUBLE) AS score FROM run",
    "run_plain_file": _IDS + f"{rnd('score', 4)} AS score FROM run",
    "run_csv_file": _IDS + f"{rnd('score', 4)} AS score FROM tied",
    "run_tsv_file": _IDS + f"{rnd('score', 4)} AS score FROM tied",
    "run_ltr_file": _IDS + f"{rnd('score', 4)} AS score FROM tied",
    "run_nb_file": _IDS + f"{rnd('score', 4)} AS score FROM tied",
    "index_reopened": "SELECT term, df, cf FROM tstat",
    "index_words": "SELECT term AS word, df FROM surface",
    "stances_competition": (
        "SELECT headline, body_id, stance, CAST(label AS BIGINT) AS label, md5(text) AS body_md5 "
        "FROM labelled JOIN documents ON body_id = documents.doc_id"
    ),
    "stances_unlabelled": (
        "SELECT headline, body_id, md5(text) AS body_md5 FROM labelled JOIN documents ON body_id = documents.doc_id"
    ),
    "analyze_stemmed": (
        "SELECT doc_id, coalesce(string_agg(term, ' ' ORDER BY position), '') AS tokens, count(term) AS n_tokens "
        "FROM documents LEFT JOIN s_pos USING (doc_id) GROUP BY doc_id"
    ),
    "postings_stemmed": (
        "SELECT term, doc_id, count(*) AS tf, dl, string_agg(position, ' ' ORDER BY position) AS positions "
        "FROM s_pos JOIN dls USING (doc_id) GROUP BY term, doc_id, dl"
    ),
    "bm25_stemmed": _scored("s_run"),
    "expand_queries_stemmed": "SELECT qid, query FROM s_expanded",
    "boost_step": _STEP,
    "given_trees": _GIVEN,
    "f_bm25": f"SELECT qid, doc_id, CAST(rank AS BIGINT) AS rank, {rnd('f_sample/1e9', 4)} AS f_bm25 FROM cand",
    "bm25_spelled": _scored("spelledrun"),
    "run_nb_tab_file": "SELECT qid, doc_id, CAST(rank AS BIGINT) AS rank, " + f"{rnd('score', 4)} AS score FROM tied",
    "lambdamart_checked": _TRAINED,
    "random_forest_checked": _TRAINED,
    "topics": f"SELECT CAST(item_id AS VARCHAR) AS qid, trim({BLANKS}) AS query FROM benchmark",
    "topics_clean": (
        f"SELECT CAST(item_id AS VARCHAR) AS qid, regexp_replace(trim({BLANKS}), '[[:punct:]]', '', 'g') AS query "
        "FROM benchmark"
    ),
    "qrels": "SELECT CAST(qid AS VARCHAR) AS qid, CAST(doc_id AS VARCHAR) AS doc_id, CAST(rating AS BIGINT) AS rating FROM qrels",
    "corpus_meta": (
        f"SELECT CAST(doc_id AS VARCHAR) AS doc_id, {BLANKS} AS text, left(CAST(doc_id AS VARCHAR), 20) AS meta_doc_id, "
        f"md5(left({BLANKS}, 4096)) AS meta_md5 FROM documents"
    ),
    "corpus_jsonl": "SELECT CAST(doc_id AS VARCHAR) AS doc_id, text FROM documents",
    "stances_labelled": (
        "SELECT headline, body_id, stance, CAST(label AS BIGINT) AS label, md5(text) AS body_md5 "
        "FROM labelled JOIN documents ON body_id = documents.doc_id"
    ),
    "run_trec_lines": (
        "SELECT concat_ws(' ', qid, 'Q0', doc_id, rank, CAST(round(score, 2) AS DOUBLE), 'bm25') AS line FROM run"
    ),
    "run_lines_csv": (
        "SELECT concat_ws(',', qid, 'Q0', doc_id, rank, score, 'MonoT5') AS csv_line, "
        "concat_ws(chr(9), qid, 'Q0', doc_id, rank, score, 'MonoT5') AS tsv_line, "
        "concat_ws(chr(9), qid, 'Q0', doc_id, concat_ws(' ', rank, score), 'MonoT5') AS compat_line FROM tied"
    ),
    "analyze": "SELECT doc_id, array_to_string(w, ' ') AS tokens, CAST(len(w) AS BIGINT) AS n_tokens FROM tok",
    "token_positions": "SELECT doc_id, position, term FROM pos",
    "stem_vocab": stems_of("(SELECT DISTINCT term FROM pos)"),
    "spell_correct": _SPELL,
    "doc_top_terms": "SELECT doc_id, coalesce(top_terms, '') AS top_terms FROM dls LEFT JOIN toptok USING (doc_id)",
    "postings": (
        "SELECT term, doc_id, count(*) AS tf, string_agg(position, ' ' ORDER BY position) AS positions "
        "FROM pos GROUP BY term, doc_id"
    ),
    "doc_lengths": "SELECT doc_id, CAST(sum(tf) AS BIGINT) AS dl FROM post GROUP BY doc_id",
    "term_counts": "SELECT term, df, cf FROM tstat",
    "collection_stats": (
        "SELECT CAST(n_docs AS BIGINT) AS n_docs, CAST(n_nonempty AS BIGINT) AS n_nonempty, "
        f"CAST(total_terms AS BIGINT) AS total_terms, {rnd('total_terms/n_docs')} AS avgdl FROM coll"
    ),
    "doc_vectors": (
        "SELECT doc_id, string_agg(term || ':' || tf, ' ' ORDER BY term || ':' || tf) AS vector FROM post "
        "WHERE doc_id IN (SELECT doc_id FROM run) GROUP BY doc_id"
    ),
    "fetch_docs": (
        "SELECT qid, run.doc_id, CAST(rank AS BIGINT) AS rank, text FROM run JOIN documents ON run.doc_id = documents.doc_id"
    ),
    "bm25_search": "SELECT qid, doc_id, CAST(rank AS BIGINT) AS rank FROM run1000",
    "bm25_scores": _scored("run"),
    "bm25_exact_length": _scored("exact"),
    "bm25_turns": _scored("turnrun"),
    "bm25_top3": f"SELECT doc_id, CAST(rank AS BIGINT) AS rank, {rnd('score', 4)} AS score FROM one",
    "rank_cutoff": _scored("run") + " WHERE rank < 10",
    "rerank_candidates": (
        "SELECT qid, run.doc_id, CAST(rank AS BIGINT) AS rank, " + rnd("score", 4) + " AS score, documents.text, query "
        "FROM run JOIN documents ON run.doc_id = documents.doc_id JOIN topics USING (qid) WHERE rank < 100"
    ),
    "ranking_arrays": (
        "SELECT qid, string_agg(doc_id, ' ' ORDER BY rank) AS doc_ids FROM run GROUP BY qid"
    ),
    "feedback_terms": "SELECT qid, term, r FROM feedback",
    "offer_weights": f"SELECT qid, term, r, n, {rnd('weight')} AS weight FROM weights",
    "expansion_terms": f"SELECT qid, term, r, n, {rnd('weight')} AS weight, CAST(rank AS BIGINT) AS rank FROM best",
    "expansion_terms_of_all": f"SELECT qid, term, r, n, {rnd('weight')} AS weight, CAST(rank AS BIGINT) AS rank FROM best",
    "expand_queries": "SELECT qid, query FROM expanded",
    "bm25_expanded": _scored("exprun"),
    "head_topics": "SELECT qid, query FROM topics ORDER BY qid LIMIT 15",
    "filter_qrels": (
        "SELECT qid, doc_id, CAST(rating AS BIGINT) AS rating FROM qrels "
        "WHERE qid IN (SELECT qid FROM topics ORDER BY qid LIMIT 15)"
    ),
    **{
        name: f"SELECT qid, doc_id, CAST(rank AS BIGINT) AS rank, {rnd(f'{name}/1e9', 4)} AS {name} FROM cand"
        for name in FEATURES
    },
    "ltr_features": "SELECT qid, doc_id, CAST(rank AS BIGINT) AS rank, "
    + ", ".join(f"{rnd(f'{n}/1e9', 4)} AS {n}" for n in FEATURES)
    + " FROM (SELECT *, row_number() OVER (PARTITION BY qid ORDER BY f_sample DESC, doc_id)-1 AS rank FROM feat) "
    "WHERE rank < 1000",
    "ltr_training": "SELECT qid, doc_id, CAST(rank AS BIGINT) AS rank, "
    + ", ".join(f"{rnd(f'{n}/1e9', 4)} AS {n}" for n in FEATURES)
    + ", CAST(coalesce(rating, 0) AS BIGINT) AS label FROM cand LEFT JOIN qrels USING (qid, doc_id)",
    "lambda_gradients": _LAMBDA,
    "rerank_coverage": _coverage(1000),
    "rerank_text_coverage": _coverage(100),
    "rerank_arrow": (
        "SELECT qid, doc_id, row_number() OVER (PARTITION BY qid ORDER BY made DESC, rank)-1 AS rank, "
        "CAST(rank AS BIGINT) AS prior_rank, " + rnd("made") + " AS score FROM ("
        "SELECT run.qid, run.doc_id, rank, ((31*length(coalesce(text, '')) + 17*length(coalesce(query, ''))) % 1009)/1009.0::DOUBLE AS made "
        "FROM run JOIN documents ON run.doc_id = documents.doc_id JOIN topics USING (qid) WHERE rank < 100)"
    ),
    "rel_retrieved": (
        "SELECT qid, doc_id, CAST(rating AS BIGINT) AS rating FROM qrels WHERE rating >= 2 "
        "AND (qid, doc_id) IN (SELECT (qid, doc_id) FROM run)"
    ),
    "rel_not_retrieved": (
        "SELECT qid, doc_id, CAST(rating AS BIGINT) AS rating FROM qrels WHERE rating >= 2 "
        "AND (qid, doc_id) NOT IN (SELECT (qid, doc_id) FROM run)"
    ),
    "nonrel_retrieved": (
        "SELECT qid, doc_id, CAST(rating AS BIGINT) AS rating FROM qrels WHERE rating < 2 "
        "AND (qid, doc_id) IN (SELECT (qid, doc_id) FROM run)"
    ),
    "recall_count": (
        "SELECT qid, count(*) FILTER (WHERE rating >= 2 AND rank < 10) AS recall_count "
        "FROM qrels LEFT JOIN run USING (qid, doc_id) GROUP BY qid"
    ),
    "worst_queries": (
        "SELECT qid, query, recall_count, " + f"array_to_string({tokens('query')}, ' ') AS tokens FROM ("
        "SELECT qid, count(*) FILTER (WHERE rating >= 2 AND rank < 5) AS recall_count "
        "FROM qrels LEFT JOIN run USING (qid, doc_id) GROUP BY qid ORDER BY recall_count, qid LIMIT 10 OFFSET 5) "
        "JOIN topics USING (qid)"
    ),
    "rating_histogram": (
        "SELECT CAST(s.rating AS BIGINT) AS rating, count(run.qid) AS n FROM "
        "(SELECT unnest(range(0, (SELECT max(rating) FROM qrels)+1)) AS rating) s LEFT JOIN "
        "(qrels q JOIN run ON q.qid = run.qid AND q.doc_id = run.doc_id) ON q.rating = s.rating GROUP BY s.rating"
    ),
    "annotated_ranking": (
        "SELECT run.qid, run.doc_id, CAST(run.rank AS BIGINT) AS rank, CAST(coalesce(rating, 0) AS BIGINT) AS rating, "
        "CAST(sum(CASE WHEN rating >= 2 THEN 1 ELSE 0 END) OVER (PARTITION BY run.qid ORDER BY run.rank) AS BIGINT) "
        "AS relevant_so_far, coalesce(top_terms, '') AS top_terms FROM run LEFT JOIN qrels USING (qid, doc_id) "
        "LEFT JOIN toptok ON toptok.doc_id = run.doc_id"
    ),
    "judged_per_query": (
        f"SELECT count(*) AS n_judged, count(DISTINCT qid) AS n_queries, {rnd('count(*)/count(DISTINCT qid)')} "
        "AS judged_per_query FROM qrels"
    ),
    "queries_containing": (
        "SELECT qid, ordinal, query FROM (SELECT qid, row_number() OVER (ORDER BY qid)-1 AS ordinal FROM needs) "
        "JOIN topics USING (qid) WHERE contains(query, 'tion of')"
    ),
    "trec_order": (
        "SELECT qid, doc_id, CAST(rank AS BIGINT) AS rank, score, row_number() OVER "
        "(PARTITION BY qid ORDER BY score DESC, CAST(doc_id AS VARCHAR) DESC) AS pos FROM tied"
    ),
    "eval_counts": (
        "SELECT (SELECT count(*) FROM needs) AS num_q, count(*) AS num_ret, "
        "(SELECT CAST(sum(r) AS BIGINT) FROM needs) AS num_rel, CAST(sum(rel) AS BIGINT) AS num_rel_ret FROM placed"
    ),
    "eval_gm_map": f"SELECT {rnd('exp(avg(ln(greatest(ap, 1e-5))))')} AS gm_map FROM aps",
    **{
        f"eval_{name}": _per_query({n: _zero_if_none(s) for n, s in columns.items()})
        for name, columns in MEASURES.items()
    },
    "eval_ndcg": _NDCG,
    "eval_report": _report(),
    "experiment": _experiment(),
    "stance_labels": "SELECT row_id, stance, CAST(label AS BIGINT) AS label FROM labelled",
    "stance_pairs": (
        "SELECT row_id, headline, body_id, text AS article_body FROM stances JOIN documents ON body_id = documents.doc_id"
    ),
    "stance_kfold": "SELECT row_id, fold FROM folds",
    "fnc_score_rows": "SELECT row_id, CAST(score AS DOUBLE) AS score FROM points",
    "fnc_score_folds": (
        f"SELECT fold, count(*) AS n_rows, {rnd('CAST(sum(score) AS DOUBLE)')} AS score "
        "FROM points JOIN folds USING (row_id) GROUP BY fold"
    ),
    "fnc_score_total": f"SELECT count(*) AS n_rows, {rnd('CAST(sum(score) AS DOUBLE)')} AS score FROM points",
    "stance_random_baseline": (
        f"SELECT row_id, CAST(instr('0123456789abcdef', left(md5(concat('{SEED}:', row_id)), 1)) % 4 + 1 AS BIGINT) "
        "AS predicted FROM stances"
    ),
}

SQL: dict[str, str] = {key: compose(sql) for key, sql in _STATEMENTS.items()}
