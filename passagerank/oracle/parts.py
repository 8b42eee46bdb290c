"""Named common table expressions, and a composer that pulls in what a statement uses."""

from __future__ import annotations

import re

from passagerank.oracle.stemming import stems_of

WORD = r"[\p{L}\p{N}]+"
TOKEN = WORD + r"(?:[.''’]" + WORD + ")*"
STOP = (
    "'a','an','and','are','as','at','be','but','by','for','if','in','into','is','it','no','not','of','on','or',"
    "'such','that','the','their','then','there','these','they','this','to','was','will','with'"
)
DEPTH = 1000
SEED = 42


def rnd(expr: str, digits: int = 6) -> str:
    scale = f"1e{digits}"
    return f"floor(({expr})*{scale}+0.5)/{scale}"


def tokens(expr: str) -> str:
    bare = f"list_transform(regexp_extract_all(lower({expr}), '{TOKEN}'), lambda x: regexp_replace(x, '[''’]s$', ''))"
    return f"list_filter({bare}, lambda x: x NOT IN ({STOP}))"


def fixed(weight: str) -> str:
    return f"CAST(sum(CAST(floor(({weight})*1e9+0.5) AS BIGINT)) AS BIGINT)"


N = "(SELECT n_docs FROM coll)"
NE = "(SELECT n_nonempty FROM coll)"
T = "(SELECT total_terms FROM coll)"
AVGDL = "(SELECT total_terms/n_docs FROM coll)"
AVGDL_NE = "(SELECT total_terms/n_nonempty FROM coll)"

BYTE_LENGTH = (
    "CASE WHEN dl < 24 THEN dl ELSE 24 + "
    "((CAST(dl-24 AS INTEGER) >> greatest(CAST(floor(log2(greatest(dl-24,1)+0.5)) AS INTEGER)-3,0)) "
    "<< greatest(CAST(floor(log2(greatest(dl-24,1)+0.5)) AS INTEGER)-3,0)) END"
)


def bm25_search(length: str) -> str:
    return (
        f"qtf * ln(1+({NE}-df+0.5)/(df+0.5)) * tf / (tf + 0.9*((1-0.4) + 0.4*({length})/{AVGDL_NE}))"
    )


WEIGHTS = {
    "f_sample": f"tf*9*qtf/((8+qtf)*(1.2*(0.25+0.75*dl/{AVGDL})+tf)) * log2(({N}-df+0.5)/(df+0.5))",
    "f_tf": "tf",
    "f_pl2": (
        "qtf/(tfn+1)*(tfn*log2(tfn/lam)+(lam-tfn)*log2(exp(1))+0.5*log2(2*pi()*tfn))"
    ),
    "f_tf_idf": f"qtf*(1.2*tf/(tf+1.2*(0.25+0.75*dl/{AVGDL})))*log2({N}/df+1)",
    "f_dlh13": (
        f"qtf*(tf*log2((tf*{AVGDL}/dl)*({N}/cf)) + CASE WHEN tf < dl "
        "THEN 0.5*log2(2*pi()*tf*(1-tf/dl)) ELSE 0 END)/(tf+0.5)"
    ),
    "f_hiemstra_lm": f"log2(1+0.15*tf*{T}/(0.85*cf*dl))",
}
FEATURES = tuple(WEIGHTS)


def run_of(topic_terms: str, weight: str, k: int) -> str:
    return f"""
        SELECT qid, doc_id, total/1e9 AS score, rn-1 AS rank FROM (
          SELECT *, row_number() OVER (PARTITION BY qid ORDER BY total DESC, doc_id) AS rn FROM (
            SELECT qid, doc_id, {fixed(weight)} AS total
            FROM post JOIN {topic_terms} USING (term) JOIN tstat USING (term) GROUP BY qid, doc_id))
        WHERE rn <= {k}"""


def terms_of(topics: str) -> str:
    return f"""
        SELECT qid, term, count(*) AS qtf FROM (
          SELECT qid, unnest({tokens('query')}) AS term FROM {topics}) GROUP BY qid, term"""


def _pairs(table: str, key: str, text: str) -> str:
    return f"""
        SELECT DISTINCT {key}, w[i] || ' ' || w[i+1] AS pair FROM (
          SELECT {key}, w, unnest(range(1, len(w))) AS i FROM (
            SELECT {key}, regexp_extract_all(lower({text}), '{WORD}') AS w FROM {table}))"""


PARTS: dict[str, str] = {
    # ---- corpus and index
    "tok": f"SELECT doc_id, {tokens('text')} AS w FROM documents",
    "pos": "SELECT doc_id, unnest(w) AS term, unnest(range(0, len(w))) AS position FROM tok",
    "dls": "SELECT doc_id, len(w) AS dl FROM tok",
    "post": (
        "SELECT term, doc_id, tf, dl FROM "
        "(SELECT term, doc_id, count(*) AS tf FROM pos GROUP BY term, doc_id) JOIN dls USING (doc_id)"
    ),
    "tstat": "SELECT term, count(*) AS df, CAST(sum(tf) AS BIGINT) AS cf FROM post GROUP BY term",
    # every token as it stands in a text, in lower case
    "surface": (
        "SELECT term, count(*) AS df FROM (SELECT doc_id, unnest(list_distinct("
        f"regexp_extract_all(lower(text), '{TOKEN}'))) AS term FROM documents) GROUP BY term"
    ),
    "coll": (
        "SELECT CAST(count(*) AS DOUBLE) AS n_docs, CAST(count(*) FILTER (WHERE dl > 0) AS DOUBLE) AS n_nonempty, "
        "CAST(sum(dl) AS DOUBLE) AS total_terms FROM dls"
    ),
    "toptok": (
        "SELECT doc_id, string_agg(term, ' ' ORDER BY tf DESC, term) AS top_terms FROM ("
        "SELECT doc_id, term, tf, row_number() OVER (PARTITION BY doc_id ORDER BY tf DESC, term) AS rn FROM post) "
        "WHERE rn <= 10 GROUP BY doc_id"
    ),
    # ---- topics
    "topics": "SELECT item_id AS qid, text AS query FROM benchmark",
    "turns": (
        "SELECT conv_id || '-' || turn AS qid, text AS query FROM conversations WHERE role = 'user'"
    ),
    "plain": (
        "SELECT qid, trim(regexp_replace(regexp_replace(lower(query), '[[:punct:]]', '', 'g'), '\\s+', ' ', 'g')) "
        "AS query FROM topics"
    ),
    "typos": (
        "SELECT qid, array_to_string(list_transform(string_split(query, ' '), lambda w: CASE WHEN length(w) >= 6 AND "
        "length(w) % 2 = 0 THEN substring(w, 1, 2) || substring(w, 4) ELSE w END), ' ') AS query FROM plain"
    ),
    "qterm": terms_of("topics"),
    "onetopic": "SELECT 'q' AS qid, 'the then thenly erha tion of this ouer' AS query",
    "oneterm": terms_of("onetopic"),
    "turnterm": terms_of("turns"),
    # ---- judgements
    "tpair": _pairs("topics", "qid", "query"),
    "dpair": _pairs("documents", "doc_id", "text"),
    "tsize": "SELECT qid, count(*) AS n FROM tpair GROUP BY qid",
    "qrels": (
        "SELECT qid, doc_id, CASE WHEN s*100 >= n*80 THEN 3 WHEN s*10 >= n THEN 2 WHEN s*20 >= n THEN 1 ELSE 0 END "
        "AS rating FROM (SELECT qid, doc_id, count(*) AS s FROM tpair JOIN dpair USING (pair) GROUP BY qid, doc_id) "
        "JOIN tsize USING (qid)"
    ),
    # ---- runs
    "run1000": run_of("qterm", bm25_search(BYTE_LENGTH), 1000),
    "run": run_of("qterm", bm25_search(BYTE_LENGTH), DEPTH),
    "exact": run_of("qterm", bm25_search("dl"), DEPTH),
    "turnrun": run_of("turnterm", bm25_search(BYTE_LENGTH), DEPTH),
    "one": run_of("oneterm", bm25_search(BYTE_LENGTH), 3),
    "tied": run_of("qterm", "1", DEPTH),
    # ---- expansion
    "feedback": (
        "SELECT qid, term, count(*) AS r FROM run JOIN post USING (doc_id) GROUP BY qid, term"
    ),
    "weights": (
        f"SELECT qid, term, r, df AS n, r*ln(CASE WHEN odds < 0 THEN 0.001 ELSE odds END) AS weight FROM ("
        f"SELECT *, ((r+0.5)*({N}-df-{DEPTH}+r+0.5))/((df-r+0.5)*({DEPTH}-r+0.5)) AS odds "
        "FROM feedback JOIN tstat USING (term))"
    ),
    "ownterm": (
        f"SELECT DISTINCT qid, term FROM (SELECT qid, {tokens('word')}[1] AS term FROM ("
        "SELECT qid, unnest(string_split(query, ' ')) AS word FROM topics)) WHERE term IS NOT NULL"
    ),
    "best": (
        "SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY qid ORDER BY floor(weight*1e9+0.5) DESC, term)-1 AS rank "
        "FROM weights WHERE NOT EXISTS (SELECT 1 FROM ownterm o WHERE o.qid = weights.qid AND o.term = weights.term)) "
        "WHERE rank < 10"
    ),
    "expanded": (
        "SELECT qid, query || coalesce(' ' || extra, '') AS query FROM topics LEFT JOIN "
        "(SELECT qid, string_agg(term, ' ' ORDER BY rank) AS extra FROM best GROUP BY qid) USING (qid)"
    ),
    "expterm": terms_of("expanded"),
    "exprun": run_of("expterm", bm25_search(BYTE_LENGTH), DEPTH),
    "spelled": "SELECT qid, corrected AS query FROM mended",
    "spelledterm": terms_of("spelled"),
    "spelledrun": run_of("spelledterm", bm25_search(BYTE_LENGTH), DEPTH),
    # ---- features
    "feat": (
        "SELECT qid, doc_id, " + ", ".join(f"{fixed(w)} AS {n}" for n, w in WEIGHTS.items())
        + f" FROM (SELECT *, tf*log2(1+{AVGDL}/dl) AS tfn, cf/{N} AS lam FROM post JOIN qterm USING (term) "
        "JOIN tstat USING (term)) GROUP BY qid, doc_id"
    ),
    "cand": (
        "SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY qid ORDER BY f_sample DESC, doc_id)-1 AS rank "
        f"FROM feat) WHERE rank < {DEPTH}"
    ),
    "ltr": (
        "SELECT qid, doc_id, rank, coalesce(rating, 0) AS label, f_sample/1e9 AS score "
        "FROM cand LEFT JOIN qrels USING (qid, doc_id)"
    ),
    # ---- evaluation
    "needs": (
        "SELECT qid, count(*) FILTER (WHERE rating >= 1) AS r, count(*) FILTER (WHERE rating < 1) AS m "
        "FROM qrels GROUP BY qid"
    ),
    "placed": (
        "SELECT qid, doc_id, rating, r, m, pos, rel, "
        "sum(rel) OVER w AS rels, sum(CASE WHEN rating < 1 THEN 1 ELSE 0 END) OVER w AS nonrels FROM ("
        "SELECT run.qid, run.doc_id, rating, r, m, CASE WHEN rating >= 1 THEN 1 ELSE 0 END AS rel, "
        "row_number() OVER (PARTITION BY run.qid ORDER BY score DESC, CAST(run.doc_id AS VARCHAR) DESC) AS pos "
        "FROM run JOIN needs USING (qid) LEFT JOIN qrels ON run.qid = qrels.qid AND run.doc_id = qrels.doc_id) "
        "WINDOW w AS (PARTITION BY qid ORDER BY pos)"
    ),
    "aps": (
        "SELECT qid, coalesce(sum(CASE WHEN rel = 1 THEN rels/pos END)/any_value(needs.r), 0) AS ap "
        "FROM needs LEFT JOIN placed USING (qid) GROUP BY qid"
    ),
    # ---- stance
    "stances": (
        "SELECT d.doc_id AS row_id, concat_ws(' ', source, lang, d.doc_id) AS headline, d.doc_id AS body_id, "
        "CASE WHEN quality=1 AND toxic=0 THEN 'agree' WHEN quality=0 AND toxic=1 THEN 'disagree' "
        "WHEN quality=1 THEN 'discuss' ELSE 'unrelated' END AS stance, 1+(d.doc_id*7+3)%4 AS predicted "
        "FROM documents d JOIN labels l ON d.doc_id = l.doc_id"
    ),
    "labelled": (
        "SELECT *, CASE stance WHEN 'agree' THEN 1 WHEN 'disagree' THEN 2 WHEN 'discuss' THEN 3 ELSE 4 END AS label "
        "FROM stances"
    ),
    "points": (
        "SELECT *, CASE WHEN label = predicted THEN 0.25 ELSE 0 END "
        "+ CASE WHEN label = predicted AND label <> 4 THEN 0.5 ELSE 0 END "
        "+ CASE WHEN label < 4 AND predicted < 4 THEN 0.25 ELSE 0 END AS score FROM labelled"
    ),
    "folds": (
        "SELECT row_id, CAST(floor(p*10/size) AS BIGINT) AS fold FROM (SELECT row_id, count(*) OVER () AS size, "
        f"row_number() OVER (ORDER BY md5(concat('{SEED}:', row_id)), row_id)-1 AS p FROM stances)"
    ),
}

#: Relations that have a stemmed counterpart, named with ``s_`` in front.
_STEMMED = ("post", "tstat", "qterm", "run", "feedback", "weights", "ownterm", "best", "expanded")
_READS = re.compile(rf"\b(FROM|JOIN)\s+({'|'.join(_STEMMED)})\b|\b({'|'.join(_STEMMED)})\.")


def stemmed(sql: str) -> str:
    """A statement over the stemmed relations instead of the plain ones."""
    return _READS.sub(lambda m: f"{m[1]} s_{m[2]}" if m[1] else f"s_{m[3]}.", sql)


def _stems(select: str) -> str:
    """``select`` with the stem of every ``term`` in its place."""
    return f"SELECT * EXCLUDE (term, stem), stem AS term FROM ({select}) JOIN stemmap USING (term)"


PARTS |= {
    "anyterm": f"SELECT term FROM pos UNION SELECT unnest({tokens('query')}) AS term FROM topics",
    "stemmap": stems_of("anyterm"),
    "s_pos": _stems("SELECT doc_id, term, position FROM pos"),
    "s_post": (
        "SELECT term, doc_id, tf, dl FROM "
        "(SELECT term, doc_id, count(*) AS tf FROM s_pos GROUP BY term, doc_id) JOIN dls USING (doc_id)"
    ),
    "s_qterm": (
        "SELECT qid, term, count(*) AS qtf FROM ("
        + _stems(f"SELECT qid, unnest({tokens('query')}) AS term FROM topics") + ") GROUP BY qid, term"
    ),
    "s_ownterm": f"SELECT DISTINCT qid, term FROM ({_stems(PARTS['ownterm'])})",
    **{f"s_{name}": stemmed(PARTS[name]) for name in ("tstat", "run", "feedback", "weights", "best", "expanded")},
}

_LITERAL = re.compile(r"'(?:[^']|'')*'")


def _uses(sql: str) -> list[str]:
    code = _LITERAL.sub("''", sql)
    return [name for name in PARTS if re.search(rf"\b(?:FROM|JOIN)\s+{name}\b", code)]


def compose(select: str) -> str:
    """Put every part that ``select`` reads, directly or not, in front of it."""
    order: list[str] = []

    def add(sql: str) -> None:
        for name in _uses(sql):
            if name not in order and PARTS[name] is not sql:
                add(PARTS[name])
                if name not in order:
                    order.append(name)

    add(select)
    if not order:
        return select
    return "WITH " + ",\n".join(f"{n} AS MATERIALIZED ({PARTS[n]})" for n in order) + "\n" + select
