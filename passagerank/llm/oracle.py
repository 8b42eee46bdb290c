"""The same results as plain SQL, where SQL can express them.

The other operators hash with functions SQL engines do not share, decode by dynamic programming or
draw by keyed hashes; their tests hold them against brute-force versions.
"""

_NAMES = "s|INST|SYS|ANS|NEXT|ROLE|SAY"

OP2 = rf"""
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]'
  UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]'
), marked AS (
  SELECT *, lag(role) OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS before,
    length(text) + len(regexp_extract_all(text, '[<\[]\\*/?(?:{_NAMES})[>\]]')) AS written
  FROM turns
), costs AS (
  SELECT *, CASE WHEN before = role THEN length('[NEXT]')
    WHEN role = 'system' THEN length('[SYS]  [/SYS]')
    WHEN role = 'user' THEN length('[INST]  [/INST]')
    WHEN role = 'assistant' THEN length('[ANS]  </s>')
    ELSE length('[ROLE] [SAY]  [/ROLE]') + length(role)
      + len(regexp_extract_all(role, '[<\[]\\*/?(?:{_NAMES})[>\]]')) END AS marks
  FROM marked
)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
  CAST(sum(CASE WHEN role = 'assistant' THEN length(text) ELSE 0 END) AS BIGINT) AS loss_chars,
  sha256(string_agg(CASE WHEN role = 'assistant' THEN text ELSE '' END, '' ORDER BY turn NULLS FIRST, role, text)) AS loss_sha256,
  CAST(length('<s>') + sum(written + marks) AS BIGINT) AS formatted_chars
FROM costs GROUP BY conv_id
"""

_CAPITALS, _SMALL = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_TERMS = (
    rf"regexp_extract_all(translate(text, '{_CAPITALS}', '{_SMALL}'), "
    r"'[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')"
)

OP12 = f"""
WITH rows AS (
  SELECT row_number() OVER () AS row_, doc_id, {_TERMS} AS terms FROM documents WHERE text IS NOT NULL
), held AS (SELECT row_, doc_id, terms, len(terms) AS n FROM rows WHERE len(terms) > 0
), total AS (SELECT count(*) AS c, sum(n)::BIGINT AS l FROM held
), postings AS (
  SELECT row_, term, count(*) AS tf FROM (SELECT row_, unnest(terms) AS term FROM held) GROUP BY row_, term
), weights AS (
  SELECT term, floor(1000 * ln((2 * c + 2)::DOUBLE / (2 * count(*) + 1)))::BIGINT AS w
  FROM postings, total GROUP BY term, c
), asked AS (
  SELECT item_id, term, count(*) AS times
  FROM (SELECT item_id, unnest({_TERMS}) AS term FROM benchmark WHERE text IS NOT NULL) GROUP BY item_id, term
), lengths AS (SELECT row_, doc_id, 100 - 25 + (25 * n * c) // l AS m FROM held, total
), scores AS (
  SELECT item_id, row_, doc_id, sum(times * w * ((1000000000 * tf) // (1000 * tf + 12 * m)))::BIGINT AS score
  FROM asked JOIN weights USING (term) JOIN postings USING (term) JOIN lengths USING (row_)
  GROUP BY item_id, row_, doc_id
), ranked AS (
  SELECT item_id, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id NULLS LAST) AS rank, doc_id, score
  FROM scores WHERE score > 0
)
SELECT item_id, rank::INTEGER AS rank, doc_id, score FROM ranked WHERE rank <= 20
"""

#: Every string of 400 bytes by its digest; bytes as two hexadecimal digits each.
OP11 = """
WITH docs AS (
  SELECT row_number() OVER () AS row_, doc_id, hex(encode(coalesce(text, ''))) AS digits FROM documents
), strings AS (
  SELECT row_, start, md5(substr(digits, 2 * start + 1, 800)) AS held
  FROM (SELECT row_, digits, unnest(range(0, length(digits) // 2 - 399)) AS start FROM docs WHERE length(digits) >= 800)
), repeated AS (
  SELECT row_, start FROM strings SEMI JOIN (SELECT held FROM strings GROUP BY held HAVING count(*) > 1) USING (held)
), marked AS (
  SELECT row_, start, coalesce(start > lag(start) OVER (PARTITION BY row_ ORDER BY start) + 400, true)::INTEGER AS first_ FROM repeated
), numbered AS (SELECT row_, start, sum(first_) OVER (PARTITION BY row_ ORDER BY start) AS span FROM marked
), spans AS (SELECT row_, span, min(start) AS a, max(start) + 400 AS b FROM numbered GROUP BY row_, span
), gaps AS (
  SELECT row_, a, coalesce(lag(b) OVER (PARTITION BY row_ ORDER BY a), 0) AS from_, a AS to_ FROM spans
  UNION ALL SELECT row_, 1000000000 AS a, max(b) AS from_, 1000000000 AS to_ FROM spans GROUP BY row_
), kept AS (
  SELECT row_, string_agg(substr(digits, 2 * from_ + 1, 2 * (to_ - from_)), '' ORDER BY a) AS digits
  FROM gaps JOIN docs USING (row_) GROUP BY row_
), lost AS (SELECT row_, sum(b - a)::BIGINT AS n, count(*) AS spans FROM spans GROUP BY row_)
SELECT doc_id, length(docs.digits) // 2 AS n_bytes, coalesce(n, 0)::BIGINT AS n_removed, coalesce(spans, 0)::BIGINT AS n_spans,
  sha256(unhex(coalesce(kept.digits, docs.digits))) AS kept_sha256
FROM docs LEFT JOIN kept USING (row_) LEFT JOIN lost USING (row_)
"""

#: The checksum of a run by its table of bytes; near words by what is left of them without one letter.
OP13 = rf"""
WITH RECURSIVE bytes AS (
  SELECT list_transform(range(256), lambda n: list_reduce([n, 0, 0, 0, 0, 0, 0, 0, 0],
    lambda c, z: CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END)) AS steps
), runs AS (
  SELECT concat(doc_id, ':') AS id, unnest(regexp_extract_all(translate(text, '{_CAPITALS}', '{_SMALL}'), '[A-Za-z\x{{C0}}-\x{{FF}}]+')) AS run
  FROM documents WHERE text IS NOT NULL
), spelled AS (
  SELECT run, list_prepend(4294967295::BIGINT, flatten(list_transform(string_split(id || run, ''), lambda c: CASE WHEN ord(c) < 128
    THEN [ord(c)::BIGINT] ELSE [192 + ord(c)::BIGINT // 64, 128 + ord(c)::BIGINT % 64] END))) AS codes
  FROM runs WHERE length(run) >= 7
), hashed AS (
  SELECT run, xor(4294967295, list_reduce(codes, lambda c, b: xor(c // 256, steps[xor(c % 256, b) + 1]))) AS h FROM spelled, bytes
), slipped AS (
  SELECT CASE WHEN h % 31 = 0 THEN substr(run, 1, h % length(run)) || substr(run, h % length(run) + 2) ELSE run END AS word FROM hashed
), words AS (SELECT word, count(*) AS n FROM slipped WHERE length(word) >= 7 GROUP BY word HAVING count(*) >= 2
), less AS (
  SELECT word, n, i, substr(word, 1, i) || substr(word, i + 2) AS rest FROM (SELECT word, n, unnest(range(0, length(word))) AS i FROM words)
), pairs AS (
  SELECT a.word, b.word AS other, b.n FROM less a JOIN less b ON a.i = b.i AND a.rest = b.rest AND a.word <> b.word
  UNION SELECT a.word, b.word, b.n FROM less a JOIN words b ON a.rest = b.word
  UNION SELECT b.word, a.word, a.n FROM less a JOIN words b ON a.rest = b.word
), best AS (
  SELECT word, other, n, count(*) OVER (PARTITION BY word) AS n_near, row_number() OVER (PARTITION BY word ORDER BY n DESC, other) AS place
  FROM pairs
), formed AS (
  SELECT words.word, words.n, coalesce(n_near, 0) AS n_near, CASE WHEN best.n >= 10 * words.n THEN other END AS form,
    CASE WHEN best.n >= 10 * words.n THEN best.n END AS form_n
  FROM words LEFT JOIN best ON words.word = best.word AND place = 1
), led AS (
  SELECT word, word AS at FROM formed
  UNION ALL SELECT led.word, formed.form FROM led JOIN formed ON led.at = formed.word WHERE formed.form IS NOT NULL
)
SELECT formed.word, formed.form, led.at AS root, formed.n, formed.n_near, formed.form_n
FROM formed JOIN led ON formed.word = led.word JOIN formed last_ ON led.at = last_.word AND last_.form IS NULL
"""

SQL: dict[str, str] = {"op2_chat": OP2, "op11_suffix_dedup": OP11, "op12_ranked_search": OP12, "op13_variants": OP13}
