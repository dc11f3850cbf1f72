"""DuckDB oracle SQL for every checked query in ``__spark_entry__``.

Each string runs on the pre-registered views (``documents`` ...).  The SQL is
written independently of the Spark code from the same rules: DuckDB's RE2
``\\s``/``\\d``/``\\b`` are ASCII, which agrees with the Unicode forms on the
given tables (no Unicode blanks or digits occur); Unicode edge cases are
covered by pytest instead.
"""

from __future__ import annotations

# parameters of the checked queries (must equal __spark_entry__.QCFG)
BATCH = 100
SHARD = 100
SAMPLE = 500
OTHERS_PCT = 12.0
LO, HI = 10, 1000

RE_PIECE = r"''(?i:[sdmt]|ll|ve|re)|[^\r\n\p{L}\p{N}]?\p{L}+|\p{N}{1,3}| ?[^\s\p{L}\p{N}]+|\s+"
RE_SPECIAL = r"<\|endoftext\|>|<\|fim_prefix\|>|<\|fim_middle\|>|<\|fim_suffix\|>|<\|endofprompt\|>"
RE_R_EMAIL = r"\b[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Z|a-z]{2,}\b"
RE_R_PHONE = r"\b\d{3}[-.]?\d{3}[-.]?\d{4}\b"
RE_R_SSN = r"\b\d{3}-\d{2}-\d{4}\b"


def clean(t: str) -> str:
    return r"trim(regexp_replace(" + t + r", '\s+', ' ', 'g'))"


def pii(t: str) -> str:
    return (r"regexp_replace(regexp_replace(" + t + r", '[^\s]+@[^\s]+', '[EMAIL]', 'g'), "
            r"'\+?\d[\d\s\-]{7,}\d', '[PHONE]', 'g')")


def pieces(t: str) -> str:
    return "regexp_extract_all(" + t + ", '" + RE_PIECE + "', 0)"


def nmatch(t: str, p: str) -> str:
    return "CAST(len(regexp_extract_all(" + t + ", '" + p + "', 0)) AS BIGINT)"


def words(t: str) -> str:
    c = clean(t)
    return "(CASE WHEN " + c + " = '' THEN []::VARCHAR[] ELSE string_split(" + c + ", ' ') END)"


D = "d AS (SELECT doc_id, lang AS label, text, " + clean("text") + " AS clean FROM documents)"

# conversation turns as a second corpus, ordered by (conv_id, turn)
D_CONV = ("d AS (SELECT row_number() OVER (ORDER BY conv_id, turn) - 1 AS doc_id, NULL AS label, text, "
          + clean("text") + " AS clean FROM conversations)")

GRAMS = "unnest(list_transform(range(1, len(ch) - 1), lambda i: ch[i] || ch[i + 1] || ch[i + 2]))"


def lang_ctes(target: str = D, train: str = "documents") -> str:
    """Character 3-gram naive Bayes, add-0.5, trained on the labelled rows of ``train``,
    scoring the corpus of the ``d`` CTE given as ``target``."""
    return target + """,
tr AS (SELECT lang AS label, """ + clean("text") + " AS clean FROM " + train + """),
gt AS (
  SELECT label, """ + GRAMS + """ AS gram
  FROM (SELECT label, string_split(' ' || lower(clean) || ' ', '') AS ch FROM tr)),
g AS (
  SELECT doc_id, """ + GRAMS + """ AS gram
  FROM (SELECT doc_id, string_split(' ' || lower(clean) || ' ', '') AS ch FROM d)),
gc AS (SELECT label AS lang, gram, count(*) AS n FROM gt WHERE label IS NOT NULL GROUP BY 1, 2),
vv AS (SELECT count(DISTINCT gram) AS v FROM gc),
nl AS (SELECT lang, sum(n) AS big_n FROM gc GROUP BY 1),
pr AS (SELECT label AS lang, count(*) AS docs FROM tr WHERE label IS NOT NULL GROUP BY 1),
meta AS (
  SELECT nl.lang, ln(pr.docs / (SELECT sum(docs) FROM pr)) AS lp, ln(0.5 / (nl.big_n + 0.5 * vv.v)) AS lu
  FROM nl JOIN pr USING (lang) CROSS JOIN vv),
dg AS (SELECT doc_id, gram, count(*) AS c FROM g WHERE gram IN (SELECT gram FROM gc) GROUP BY 1, 2),
kk AS (SELECT doc_id, sum(c) AS k FROM dg GROUP BY 1),
ss AS (
  SELECT dg.doc_id, gc.lang, sum(dg.c * (ln(gc.n + 0.5) - ln(0.5))) AS s
  FROM dg JOIN gc USING (gram) GROUP BY 1, 2),
sc AS (
  SELECT kk.doc_id, meta.lang, meta.lp + kk.k * meta.lu + coalesce(ss.s, 0) AS score
  FROM kk CROSS JOIN meta LEFT JOIN ss ON ss.doc_id = kk.doc_id AND ss.lang = meta.lang),
sr AS (
  SELECT doc_id, lang, score,
         row_number() OVER (PARTITION BY doc_id ORDER BY score DESC, lang) AS rn,
         max(score) OVER (PARTITION BY doc_id) AS mx
  FROM sc),
det AS (
  SELECT doc_id, max(CASE WHEN rn = 1 THEN lang END) AS lang, 1.0 / sum(exp(score - mx)) AS prob
  FROM sr GROUP BY doc_id),
dl AS (
  SELECT d.doc_id, coalesce(det.lang, 'unknown') AS lang, coalesce(det.prob, 0.0) AS prob
  FROM d LEFT JOIN det USING (doc_id))"""


LANG = lang_ctes(D)
# trained on even documents, odd ones scored
HELD_OUT = lang_ctes(D.replace("FROM documents", "FROM documents WHERE doc_id % 2 <> 0"), "documents WHERE doc_id % 2 = 0")

# the waterfall, dedup in batches of BATCH light-filter survivors
def pipe(target: str = D) -> str:
    return lang_ctes(target) + PIPE_TAIL


PIPE_TAIL = f""",
sv AS (SELECT doc_id, clean, row_number() OVER (ORDER BY doc_id) - 1 AS svpos FROM d WHERE clean <> ''),
f AS (SELECT sv.doc_id, sv.svpos, dl.lang, sv.clean, {pii('sv.clean')} AS pt FROM sv JOIN dl USING (doc_id)),
f2 AS (
  SELECT *, pt <> clean AS pii0, CAST(len({pieces('pt')}) AS BIGINT) AS n_tokens,
         regexp_matches(pt, '{RE_SPECIAL}') AS special, svpos // {BATCH} AS batch_id
  FROM f),
fi AS (
  SELECT doc_id, doc_id = min(doc_id) OVER (PARTITION BY batch_id, lower(pt)) AS is_first
  FROM f2 WHERE lang = 'en'),
fate AS (
  SELECT f2.doc_id,
         CASE WHEN f2.lang <> 'en' THEN 'non_english'
              WHEN NOT fi.is_first THEN 'duplicate'
              WHEN f2.special THEN 'tokenization_error'
              WHEN f2.n_tokens < {LO} OR f2.n_tokens > {HI} THEN 'length_filtered' END AS reason,
         f2.lang, (f2.lang = 'en' AND f2.pii0) AS pii_found, f2.n_tokens, f2.pt
  FROM f2 LEFT JOIN fi USING (doc_id)
  UNION ALL
  SELECT doc_id, 'light_empty', NULL, false, NULL, NULL FROM d WHERE clean = ''),
kept AS (SELECT doc_id, pt AS text, n_tokens FROM fate WHERE reason IS NULL),
reasons AS (
  SELECT reason, count(*) AS n FROM fate
  WHERE reason IN ('empty', 'non_english', 'duplicate', 'tokenization_error', 'length_filtered')
  GROUP BY reason
  UNION ALL
  SELECT 'pii_replaced', count(*) FROM fate WHERE pii_found HAVING count(*) > 0),
acc AS (
  SELECT count(*) AS total,
         count(*) FILTER (WHERE reason = 'malformed') AS malformed,
         count(*) FILTER (WHERE reason = 'light_empty') AS light_empty,
         count(*) FILTER (WHERE reason IN ('empty', 'non_english', 'duplicate', 'tokenization_error', 'length_filtered')) AS dropped_true,
         count(*) FILTER (WHERE pii_found) AS pii_replaced,
         count(*) FILTER (WHERE reason IS NULL) AS kept
  FROM fate),
kp AS (
  SELECT doc_id, unnest(p) AS piece, unnest(range(0, len(p))) AS pos
  FROM (SELECT doc_id, {pieces('text')} AS p FROM kept)),
voc AS (
  SELECT piece, count(*) AS freq, row_number() OVER (ORDER BY count(*) DESC, piece) - 1 AS token_id
  FROM kp GROUP BY piece),
enc AS (
  SELECT kp.doc_id, list(voc.token_id ORDER BY kp.pos) AS toks
  FROM kp JOIN voc USING (piece) GROUP BY kp.doc_id),
shuf AS (
  SELECT doc_id, row_number() OVER (ORDER BY md5('42:' || CAST(doc_id AS VARCHAR)), doc_id) - 1 AS pos
  FROM kept),
out AS (
  SELECT k.doc_id, k.text, e.toks, s.pos, s.pos // {SHARD} AS shard_id
  FROM kept k JOIN enc e USING (doc_id) JOIN shuf s USING (doc_id))"""

PIPE = pipe(D)


def hist(vals_cte: str, k: int) -> str:
    """Equal-width histogram over ``x`` of ``vals_cte`` (same arithmetic as Spark)."""
    return f"""{vals_cte},
hs AS (SELECT min(x) AS lo0, max(x) AS hi0, count(*) AS n FROM vals),
hb AS (SELECT CASE WHEN lo0 = hi0 THEN lo0 - 0.5 ELSE lo0 END AS lo,
              CASE WHEN lo0 = hi0 THEN hi0 + 0.5 ELSE hi0 END AS hi, n FROM hs WHERE n > 0),
hc AS (SELECT least(CAST(floor((x - lo) * {float(k)} / (hi - lo)) AS INTEGER), {k - 1}) AS bin, count(*) AS c
       FROM vals CROSS JOIN hb GROUP BY 1)
SELECT CAST(r.range AS INTEGER) AS bin,
       round(lo + r.range * ((hi - lo) / {k}), 6) AS lo,
       round(lo + (r.range + 1) * ((hi - lo) / {k}), 6) AS hi,
       CAST(coalesce(c, 0) AS BIGINT) AS n,
       round(coalesce(c, 0) / (n * ((hi - lo) / {k})), 6) AS density
FROM range({k}) r CROSS JOIN hb LEFT JOIN hc ON hc.bin = r.range"""


def integer_hist(cap: int) -> str:
    """Unit bins over ``total`` of ``pct``, and one row for the values past the last edge."""
    return f""",
      e AS (SELECT least(max(total) + 2, {cap}) - 1 AS last_edge, max(total) AS mx FROM pct),
      c AS (SELECT CASE WHEN total > last_edge THEN last_edge ELSE least(total, last_edge - 1) END AS bin, count(*) AS n
            FROM pct CROSS JOIN e WHERE total >= 0 GROUP BY 1),
      x AS (SELECT r.range AS bin, last_edge, mx, coalesce(c.n, 0) AS n
            FROM e CROSS JOIN range(e.last_edge + CASE WHEN mx > last_edge THEN 1 ELSE 0 END) r LEFT JOIN c ON c.bin = r.range)
      SELECT CAST(bin AS INTEGER) AS bin, bin AS lo, CASE WHEN bin < last_edge THEN bin + 1 ELSE mx END AS hi,
             CAST(n AS BIGINT) AS n,
             CASE WHEN bin < last_edge THEN round(n / (SELECT sum(n) FROM x WHERE bin < last_edge), 4) END AS density,
             round(n / (SELECT sum(n) FROM x), 4) AS share
      FROM x"""


PIIC = ("pc AS (SELECT doc_id, " + nmatch("text", RE_R_EMAIL) + " AS emails, "
        + nmatch("text", RE_R_PHONE) + " AS phones, " + nmatch("text", RE_R_SSN) + " AS ssns FROM documents), "
        "pct AS (SELECT doc_id, emails, phones, ssns, emails + phones + ssns AS total FROM pc)")


def pii_summary(src: str) -> str:
    return f"""SELECT count(*) AS texts, count(*) FILTER (WHERE total > 0) AS texts_with_pii,
  round(CASE WHEN count(*) > 0 THEN count(*) FILTER (WHERE total > 0) / count(*) * 100 ELSE 0 END, 4) AS pii_rate_pct,
  CAST(coalesce(sum(total), 0) AS BIGINT) AS total_pii,
  round(CASE WHEN count(*) > 0 THEN coalesce(sum(total), 0) / count(*) ELSE 0 END, 4) AS mean_pii_per_text
FROM {src}"""


CD = "cd AS (SELECT doc_id, " + clean("text") + " AS text FROM documents)"

DOC_VOCAB = CD + f""",
dp AS (
  SELECT doc_id, unnest(p) AS piece, unnest(range(0, len(p))) AS pos
  FROM (SELECT doc_id, {pieces('text')} AS p FROM cd)),
dv AS (
  SELECT piece, count(*) AS freq, row_number() OVER (ORDER BY count(*) DESC, piece) - 1 AS token_id
  FROM dp GROUP BY piece),
de AS (
  SELECT cd.doc_id, CAST(count(dp.piece) AS BIGINT) AS n_tokens,
         coalesce(string_agg(CAST(dv.token_id AS VARCHAR), ' ' ORDER BY dp.pos), '') AS tokens
  FROM cd LEFT JOIN dp USING (doc_id) LEFT JOIN dv USING (piece) GROUP BY cd.doc_id)"""


def dedup(scope_batch: bool) -> str:
    part = "PARTITION BY svpos // " + str(BATCH) + ", lower(pt)" if scope_batch else "PARTITION BY lower(pt)"
    return CD + f""",
x AS (SELECT doc_id, {pii('text')} AS pt, row_number() OVER (ORDER BY doc_id) - 1 AS svpos FROM cd)
SELECT doc_id, doc_id = min(doc_id) OVER ({part}) AS is_first FROM x"""


SAMPLE_PAIRS = PIPE + f""",
smp AS (SELECT pos, toks FROM out WHERE pos < {SAMPLE}),
bag AS (SELECT pos AS id, t AS token, count(*) AS n FROM (SELECT pos, unnest(toks) AS t FROM smp) GROUP BY 1, 2),
nrm AS (SELECT id, sqrt(sum(n * n)) AS norm FROM bag GROUP BY id),
u AS (SELECT bag.id, token, n / norm AS w FROM bag JOIN nrm USING (id)),
dots AS (SELECT a.id AS i, b.id AS j, round(sum(a.w * b.w), 12) AS c FROM u a JOIN u b ON a.token = b.token AND a.id < b.id GROUP BY 1, 2),
allp AS (SELECT a.pos AS i, b.pos AS j FROM smp a JOIN smp b ON a.pos < b.pos),
vals AS (SELECT coalesce(dots.c, 0.0) AS x FROM allp LEFT JOIN dots USING (i, j))"""


ORACLE: dict[str, str] = {
    "clean_text": "SELECT doc_id, " + clean("text") + " AS clean_text FROM documents",
    "pii_replace": "WITH " + CD + ", x AS (SELECT doc_id, text, " + pii("text") + " AS pii_text FROM cd) "
                   "SELECT doc_id, pii_text, pii_text <> text AS pii_found FROM x",
    "pii_replace_by_lang": "WITH " + D + ", x AS (SELECT label AS lang, " + pii("clean") + " <> clean AS pii_found FROM d) "
                           "SELECT lang, pii_found, count(*) AS n FROM x GROUP BY 1, 2",
    "pii_counts": "WITH " + PIIC + " SELECT * FROM pct",
    "pii_summary": "WITH " + PIIC + " " + pii_summary("pct"),
    "pii_histogram": "WITH " + PIIC + integer_hist(20),
    "lang_profile": "WITH " + LANG + " SELECT lang, gram, n FROM gc",
    "lang_detect": "WITH " + LANG + " SELECT doc_id, lang, round(prob, 4) AS prob FROM dl",
    "english_filter": "WITH " + LANG + " SELECT doc_id, lang = 'en' AS is_english FROM dl",
    "lang_accuracy": "WITH " + HELD_OUT + " SELECT d.label, count(*) AS n, count(*) FILTER (WHERE d.label = dl.lang) AS correct "
                     "FROM d JOIN dl USING (doc_id) GROUP BY d.label",
    "lang_reliability": "WITH " + HELD_OUT + """, x AS (
        SELECT round(prob, 4) AS p, CASE WHEN d.label = dl.lang THEN 1 ELSE 0 END AS ok FROM d JOIN dl USING (doc_id) WHERE d.label IS NOT NULL)
      SELECT CAST(least(floor(p * 10), 9) AS INTEGER) AS bin, count(*) AS n, CAST(sum(ok) AS BIGINT) AS correct,
             round(avg(ok), 4) AS accuracy, round(avg(p), 4) AS mean_prob, round(avg(p) - avg(ok), 4) AS gap
      FROM x GROUP BY 1""",
    "lang_distribution": "WITH " + LANG + """, c AS (SELECT lang, count(*) AS n FROM dl GROUP BY lang)
      SELECT lang, n, round(n / sum(n) OVER () * 100, 4) AS pct FROM c ORDER BY n DESC, lang LIMIT 5""",
    "lang_major_others": "WITH " + LANG + f""", c AS (SELECT lang, count(*) AS n FROM dl GROUP BY lang),
      s AS (SELECT lang, n, n / sum(n) OVER () * 100 AS pct FROM c),
      gg AS (SELECT CASE WHEN pct >= {OTHERS_PCT} THEN lang ELSE 'Others' END AS lang_group, sum(n) AS n FROM s GROUP BY 1)
      SELECT lang_group, CAST(n AS BIGINT) AS n, round(n / sum(n) OVER () * 100, 4) AS pct FROM gg""",
    "lang_confidence": "WITH " + LANG + """ SELECT count(*) AS docs, count(DISTINCT lang) AS languages,
      round(avg(prob), 4) AS mean, round(min(prob), 4) AS min, round(quantile_cont(prob, 0.25), 4) AS q1,
      round(quantile_cont(prob, 0.5), 4) AS median, round(quantile_cont(prob, 0.75), 4) AS q3, round(max(prob), 4) AS max
      FROM dl""",
    "token_pieces": "WITH " + CD + " SELECT doc_id, CAST(len(" + pieces("text") + ") AS BIGINT) AS n_pieces FROM cd",
    "token_vocab": "WITH " + DOC_VOCAB + " SELECT token_id, piece, freq FROM dv",
    "token_encode": "WITH " + DOC_VOCAB + " SELECT doc_id, n_tokens, tokens FROM de",
    "token_decode": "WITH " + CD + " SELECT doc_id, array_to_string(" + pieces("text") + ", '') AS text FROM cd",
    "token_special_errors": "WITH " + CD + " SELECT count(*) FILTER (WHERE regexp_matches(text, '" + RE_SPECIAL
                            + "')) AS n_special, count(*) AS n_docs FROM cd",
    "length_filter": "WITH " + CD + ", x AS (SELECT doc_id, CAST(len(" + pieces("text") + ") AS BIGINT) AS n FROM cd) "
                     f"SELECT doc_id, n AS n_tokens, n BETWEEN {LO} AND {HI} AS in_window FROM x",
    "text_stats": "WITH " + CD + ", x AS (SELECT doc_id, CAST(length(text) AS BIGINT) AS char_count, CAST(len("
                  + words("text") + ") AS BIGINT) AS word_count, CAST(len(" + pieces("text") + ") AS BIGINT) AS token_count FROM cd) "
                  "SELECT doc_id, char_count, word_count, token_count, "
                  "round(CASE WHEN token_count > 0 THEN char_count / token_count ELSE 0.0 END, 4) AS avg_token_length FROM x",
    "quality_score": "WITH x AS (SELECT doc_id, text, " + words("text") + r""" AS w FROM documents)
      SELECT doc_id, round(CAST(
        (CASE WHEN len(w) < 10 OR len(w) > 2000 THEN 0.7 ELSE 1.0 END)
        * (CASE WHEN (regexp_matches(text, '\p{Lu}') AND NOT regexp_matches(text, '[\p{Ll}\p{Lt}]'))
                  OR (regexp_matches(text, '\p{Ll}') AND NOT regexp_matches(text, '[\p{Lu}\p{Lt}]')) THEN 0.8 ELSE 1.0 END)
        * (CASE WHEN regexp_matches(text, '[.!?]') THEN 1.0 ELSE 0.9 END)
        * (CASE WHEN len(w) > 0 AND len(list_distinct(w)) / len(w) < 0.3 THEN 0.6 ELSE 1.0 END) AS DOUBLE), 4) AS score
      FROM x""",
    "dedup_global": "WITH " + dedup(False),
    "dedup_batch": "WITH " + dedup(True),
    "dedup_deliveries": "WITH " + CD + f""",
      x AS (SELECT doc_id, {pii('text')} AS pt FROM cd)
      SELECT doc_id, row_number() OVER (PARTITION BY lower(pt) ORDER BY doc_id % 2, doc_id) = 1 AS is_first FROM x""",
    "token_duplicates": "WITH " + DOC_VOCAB + """, k AS (SELECT tokens, count(*) AS c FROM de GROUP BY tokens),
      t AS (SELECT CAST(sum(c) AS BIGINT) AS total, count(*) AS uniq FROM k)
      SELECT total, uniq AS "unique", total - uniq AS duplicates,
             round(CASE WHEN total > 0 THEN (total - uniq) / total * 100 ELSE 0.0 END, 4) AS duplicate_pct FROM t""",
    "record_fates": "WITH " + PIPE + """ SELECT fate.doc_id, reason, lang, pii_found, fate.n_tokens, kept.text
      FROM fate LEFT JOIN kept USING (doc_id)""",
    "drop_reasons": "WITH " + PIPE + " SELECT reason, n FROM reasons",
    "drop_shares": "WITH " + PIPE + " SELECT reason, n, round(n / sum(n) OVER () * 100, 4) AS pct FROM reasons",
    "fate_accounting": "WITH " + PIPE + """ SELECT total, malformed, light_empty, dropped_true, pii_replaced, kept,
      dropped_true + pii_replaced AS dropped_ref FROM acc""",
    "data_flow": "WITH " + PIPE + """, s AS (
        SELECT 'input' AS stage, kept + dropped_true AS n FROM acc UNION ALL
        SELECT 'dropped', dropped_true FROM acc UNION ALL
        SELECT 'output', kept FROM acc UNION ALL
        SELECT 'input_reference', kept + dropped_true + pii_replaced FROM acc)
      SELECT stage, CAST(n AS BIGINT) AS n,
             round(CASE WHEN (SELECT kept + dropped_true FROM acc) > 0 THEN n / (SELECT kept + dropped_true FROM acc) * 100 ELSE 0 END, 4) AS pct
      FROM s""",
    "prepare_tokens": "WITH " + PIPE + """ SELECT doc_id, CAST(len(toks) AS BIGINT) AS n_tokens,
      array_to_string(toks, ' ') AS tokens FROM out""",
    "shuffle_rank": "WITH " + PIPE + " SELECT doc_id, pos FROM out",
    "shard_manifest": "WITH " + PIPE + """ SELECT 'shard_' || format('{:04d}', CAST(shard_id AS INTEGER)) || '.jsonl' AS file, count(*) AS n,
      CAST(sum(CAST('0x' || substr(md5('{"tokens":[' || array_to_string(toks, ',') || ']}'), 1, 15) AS HUGEINT)) AS VARCHAR) AS checksum
      FROM out GROUP BY 1""",
    "shard_sizes": "WITH " + PIPE + " SELECT CAST(shard_id AS INTEGER) AS shard_id, count(*) AS n FROM out GROUP BY 1",
    "token_length_stats": "WITH " + PIPE + """, v AS (SELECT CAST(len(toks) AS DOUBLE) AS x FROM out)
      SELECT count(x) AS count, round(avg(x), 4) AS mean, round(quantile_cont(x, 0.5), 4) AS median,
             round(min(x), 4) AS min, round(max(x), 4) AS max, round(stddev_pop(x), 4) AS std FROM v""",
    "token_length_histogram": "WITH " + hist(PIPE + ", vals AS (SELECT CAST(len(toks) AS DOUBLE) AS x FROM out)", 50),
    "vocab_richness": "WITH " + PIPE + """, m AS (
        SELECT len(""" + words("text") + """) AS w, len(list_distinct(""" + words("lower(text)") + """)) AS u FROM kept)
      SELECT count(*) AS texts, round(avg(u), 6) AS mean_unique_words, round(avg(u / w), 6) AS mean_lexical_diversity
      FROM m WHERE w > 0""",
    "vocab_histogram": "WITH " + hist(PIPE + ", vals AS (SELECT CAST(len(list_distinct(" + words("lower(text)")
                                      + ")) AS DOUBLE) AS x FROM kept)", 30),
    "residual_pii": "WITH " + PIPE + ", rp AS (SELECT " + nmatch("text", RE_R_EMAIL) + " + " + nmatch("text", RE_R_PHONE)
                    + " + " + nmatch("text", RE_R_SSN) + " AS total FROM kept), s AS (" + pii_summary("rp")
                    + ") SELECT *, pii_rate_pct > 1.0 AS warn FROM s",
    "cosine_mean_all": "WITH " + PIPE + """,
      bag AS (SELECT doc_id AS id, t AS token, count(*) AS n FROM (SELECT doc_id, unnest(toks) AS t FROM out) GROUP BY 1, 2),
      nrm AS (SELECT id, sqrt(sum(n * n)) AS norm FROM bag GROUP BY id),
      u AS (SELECT bag.id, token, n / norm AS w FROM bag JOIN nrm USING (id)),
      dots AS (SELECT sum(a.w * b.w) AS c FROM u a JOIN u b ON a.token = b.token AND a.id < b.id),
      nn AS (SELECT count(*) AS s FROM out)
      SELECT s AS sequences, CAST(s * (s - 1) / 2 AS BIGINT) AS pairs, round(c / (s * (s - 1) / 2), 6) AS mean_cosine
      FROM nn CROSS JOIN dots""",
    "cosine_to_centroid": "WITH " + hist(PIPE + """,
      bag AS (SELECT doc_id AS id, t AS token, count(*) AS n FROM (SELECT doc_id, unnest(toks) AS t FROM out) GROUP BY 1, 2),
      nrm AS (SELECT id, sqrt(sum(n * n)) AS norm FROM bag GROUP BY id),
      u AS (SELECT bag.id, token, n / norm AS w FROM bag JOIN nrm USING (id)),
      cen AS (SELECT token, sum(w) AS s FROM u GROUP BY token),
      dots AS (SELECT id, sum(w * s) / (SELECT sqrt(sum(s * s)) FROM cen) AS c FROM u JOIN cen USING (token) GROUP BY id),
      vals AS (SELECT round(coalesce(c, 0), 12) AS x FROM out LEFT JOIN dots ON dots.id = out.doc_id),
      sm AS (SELECT count(*) AS sequences, round(avg(x), 6) AS mean, round(quantile_cont(x, 0.5), 6) AS median FROM vals)
      """, 50).replace("SELECT CAST(r.range", "SELECT sm.*, CAST(r.range") + " CROSS JOIN sm",
    "cosine_pairs": "WITH " + hist(PIPE + """,
      bag AS (SELECT pos AS id, t AS token, count(*) AS n FROM (SELECT pos, unnest(toks) AS t FROM out) GROUP BY 1, 2),
      nrm AS (SELECT id, sum(n * n)::DOUBLE AS sq FROM bag GROUP BY id),
      nn AS (SELECT count(*) AS s FROM out),
      prs AS (SELECT pos AS i, (pos + d.range) % s AS j FROM out CROSS JOIN nn CROSS JOIN range(1, 9) d
              WHERE d.range <= s // 2 AND (2 * d.range < s OR pos < s // 2)),
      dots AS (SELECT i, j, sum(a.n * b.n)::DOUBLE AS dot FROM prs JOIN bag a ON a.id = i JOIN bag b ON b.id = j AND a.token = b.token
               GROUP BY 1, 2),
      vals AS (SELECT coalesce(dot / sqrt(p.sq * q.sq), 0) AS x FROM prs LEFT JOIN dots USING (i, j)
               LEFT JOIN nrm p ON p.id = i LEFT JOIN nrm q ON q.id = j),
      sm AS (SELECT (SELECT s FROM nn) AS sequences, count(*) AS pairs, round(avg(x), 6) AS mean, round(quantile_cont(x, 0.5), 6) AS median,
                    (SELECT round(CASE WHEN s <= 17 THEN 0 ELSE least(1, sqrt(8 * ln(2 / 0.05) / s)) END, 6) FROM nn) AS bound95 FROM vals)
      """, 50).replace("SELECT CAST(r.range", "SELECT sm.*, CAST(r.range") + " CROSS JOIN sm",
    "jsonl_line_order": "SELECT row_number() OVER (ORDER BY doc_id) - 1 AS ord, doc_id FROM documents",
    "input_report": "WITH " + LANG + ", " + PIIC + """,
      v AS (SELECT pct.total FROM pct JOIN d USING (doc_id) WHERE d.clean <> ''),
      dv AS (SELECT dl.* FROM dl JOIN d USING (doc_id) WHERE d.clean <> ''),
      m AS (SELECT 'lines' AS metric, CAST(count(*) AS DOUBLE) AS value FROM d
            UNION ALL SELECT 'json_errors', 0.0
            UNION ALL SELECT 'empty', CAST(count(*) FILTER (WHERE clean = '') AS DOUBLE) FROM d
            UNION ALL SELECT 'valid', CAST(count(*) AS DOUBLE) FROM v
            UNION ALL SELECT 'languages', CAST(count(DISTINCT lang) AS DOUBLE) FROM dv
            UNION ALL SELECT 'mean_confidence', avg(prob) FROM dv
            UNION ALL SELECT 'median_confidence', quantile_cont(prob, 0.5) FROM dv
            UNION ALL SELECT 'pii_texts', CAST(count(*) FILTER (WHERE total > 0) AS DOUBLE) FROM v
            UNION ALL SELECT 'pii_rate_pct', count(*) FILTER (WHERE total > 0) / count(*) * 100 FROM v
            UNION ALL SELECT 'pii_total', CAST(sum(total) AS DOUBLE) FROM v
            UNION ALL SELECT 'pii_mean_per_text', sum(total) / count(*) FROM v)
      SELECT 'input' AS section, metric, round(value, 4) AS value FROM m""",
    "output_report": "WITH " + PIPE + """,
      o AS (SELECT *, CAST(len(toks) AS DOUBLE) AS ln, len(""" + words("text") + """) AS w,
                   len(list_distinct(""" + words("lower(text)") + """)) AS u,
                   """ + nmatch("text", RE_R_EMAIL) + " + " + nmatch("text", RE_R_PHONE) + " + " + nmatch("text", RE_R_SSN) + """ AS p
            FROM out),
      dd AS (SELECT count(*) AS n, count(DISTINCT array_to_string(toks, ',')) AS uq FROM o),
      m AS (SELECT 'records' AS metric, CAST(count(*) AS DOUBLE) AS value FROM o
            UNION ALL SELECT 'shards', CAST(count(DISTINCT shard_id) AS DOUBLE) FROM o
            UNION ALL SELECT 'duplicates', CAST(n - uq AS DOUBLE) FROM dd
            UNION ALL SELECT 'duplicate_pct', CASE WHEN n > 0 THEN (n - uq) / n * 100 ELSE 0 END FROM dd
            UNION ALL SELECT 'token_len_mean', avg(ln) FROM o
            UNION ALL SELECT 'token_len_median', quantile_cont(ln, 0.5) FROM o
            UNION ALL SELECT 'token_len_min', min(ln) FROM o
            UNION ALL SELECT 'token_len_max', max(ln) FROM o
            UNION ALL SELECT 'token_len_std', stddev_pop(ln) FROM o
            UNION ALL SELECT 'mean_unique_words', avg(u) FROM o WHERE w > 0
            UNION ALL SELECT 'mean_lexical_diversity', avg(u / w) FROM o WHERE w > 0
            UNION ALL SELECT 'residual_pii_texts', CAST(count(*) FILTER (WHERE p > 0) AS DOUBLE) FROM o
            UNION ALL SELECT 'residual_pii_rate_pct', count(*) FILTER (WHERE p > 0) / count(*) * 100 FROM o
            UNION ALL SELECT 'residual_pii_total', CAST(sum(p) AS DOUBLE) FROM o
            UNION ALL SELECT 'residual_pii_warn', CASE WHEN count(*) FILTER (WHERE p > 0) / count(*) * 100 > 1.0 THEN 1.0 ELSE 0.0 END FROM o
            UNION ALL SELECT 'dropped_true', CAST(dropped_true AS DOUBLE) FROM acc
            UNION ALL SELECT 'dropped_reference', CAST(dropped_true + pii_replaced AS DOUBLE) FROM acc
            UNION ALL SELECT 'pii_replaced', CAST(pii_replaced AS DOUBLE) FROM acc
            UNION ALL SELECT 'input_true', CAST(kept + dropped_true AS DOUBLE) FROM acc)
      SELECT 'output' AS section, metric, round(value, 4) AS value FROM m""",
    "jsonl_tolerant_scan": r"""WITH lines AS (
        SELECT CAST(to_json({'text': text}) AS VARCHAR) AS value FROM documents
        UNION ALL SELECT regexp_replace(text, '[\r\n]+', ' ', 'g') FROM documents
        UNION ALL SELECT CAST(to_json({'conv_id': conv_id, 'turn': turn, 'role': role}) AS VARCHAR) FROM conversations),
      k AS (SELECT value, trim(regexp_replace(value, '\s+', ' ', 'g')) = '' AS blank,
                   coalesce(try(json_type(value)) = 'OBJECT'
                        AND coalesce(try(json_type(value, '$.text')) = 'VARCHAR', true), false) AS ok
            FROM lines),
      r AS (SELECT blank OR NOT ok AS err,
                   CASE WHEN ok AND NOT blank THEN coalesce(try(json_extract_string(value, '$.text')), '') END AS text
            FROM k)
      SELECT count(*) AS total,
             count(*) FILTER (WHERE NOT err AND trim(regexp_replace(text, '\s+', ' ', 'g')) = '') AS empty,
             count(*) FILTER (WHERE err) AS json_errors,
             count(*) FILTER (WHERE NOT err AND trim(regexp_replace(text, '\s+', ' ', 'g')) <> '') AS valid
      FROM r""",
    "jsonl_fates": "WITH " + PIPE + r""",
      raw AS (SELECT regexp_replace(text, '[\r\n]+', ' ', 'g') AS value FROM documents),
      rk AS (SELECT trim(regexp_replace(value, '\s+', ' ', 'g')) = '' AS blank,
                    coalesce(try(json_type(value)) = 'OBJECT'
                      AND coalesce(try(json_type(value, '$.text')) = 'VARCHAR', true), false) AS ok FROM raw),
      allf AS (SELECT coalesce(reason, 'kept') AS reason FROM fate
               UNION ALL SELECT CASE WHEN blank THEN 'light_empty' ELSE 'malformed' END FROM rk WHERE blank OR NOT ok
               UNION ALL SELECT 'light_empty' FROM conversations)
      SELECT reason, count(*) AS n FROM allf GROUP BY reason""",
    "shard_record_shapes": "WITH " + PIPE + """
      SELECT 'object' AS shape, count(*) AS n, CAST(sum(len(toks)) AS BIGINT) AS tokens FROM out
      UNION ALL SELECT 'list', count(*), CAST(sum(len(toks)) AS BIGINT) FROM out
      UNION ALL SELECT 'other', count(*), CAST(0 AS BIGINT) FROM documents""",
    "prepare_text": "WITH " + PIPE + " SELECT doc_id, text FROM kept",
    "prepare_dual": "WITH " + PIPE + " SELECT doc_id, text, array_to_string(toks, ' ') AS tokens FROM out",
    "drop_reasons_merged": "SELECT reason, CAST(sum(n) AS BIGINT) AS n FROM (SELECT * FROM (WITH " + pipe(D)
                           + " SELECT reason, n FROM reasons) UNION ALL SELECT * FROM (WITH " + pipe(D_CONV)
                           + " SELECT reason, n FROM reasons)) GROUP BY reason",
    "residual_pii_histogram": "WITH " + PIPE + ", pct AS (SELECT " + nmatch("text", RE_R_EMAIL) + " + "
                              + nmatch("text", RE_R_PHONE) + " + " + nmatch("text", RE_R_SSN) + " AS total FROM kept)" + integer_hist(10),
    "lexical_diversity_histogram": "WITH " + hist(PIPE + ", m AS (SELECT len(" + words("text") + ") AS w, len(list_distinct("
                                                  + words("lower(text)") + ")) AS u FROM kept), "
                                                  "vals AS (SELECT u / w AS x FROM m WHERE w > 0)", 30),
    "token_bag": "WITH " + PIPE + """ SELECT doc_id, CAST(t AS BIGINT) AS token, count(*) AS n
      FROM (SELECT doc_id, unnest(toks) AS t FROM out) GROUP BY 1, 2""",
    "lang_confidence_histogram": "WITH " + hist(LANG + ", vals AS (SELECT round(prob, 4) AS x FROM dl)", 50),
    "light_filter_counts": r"""WITH lines AS (
        SELECT CAST(to_json({'text': text}) AS VARCHAR) AS value FROM documents
        UNION ALL SELECT regexp_replace(text, '[\r\n]+', ' ', 'g') FROM documents
        UNION ALL SELECT CAST(to_json({'conv_id': conv_id, 'turn': turn, 'role': role}) AS VARCHAR) FROM conversations),
      k AS (SELECT value, trim(regexp_replace(value, '\s+', ' ', 'g')) = '' AS blank,
                   coalesce(try(json_type(value)) = 'OBJECT'
                     AND coalesce(try(json_type(value, '$.text')) = 'VARCHAR', true), false) AS ok FROM lines),
      r AS (SELECT blank, NOT blank AND NOT ok AS malformed,
                   CASE WHEN ok AND NOT blank THEN coalesce(try(json_extract_string(value, '$.text')), '') ELSE '' END AS text
            FROM k),
      e AS (SELECT *, NOT malformed AND trim(regexp_replace(text, '\s+', ' ', 'g')) = '' AS light_empty FROM r)
      SELECT count(*) AS lines, count(*) FILTER (WHERE blank) AS blank, count(*) FILTER (WHERE malformed) AS malformed,
             count(*) FILTER (WHERE light_empty) AS light_empty,
             count(*) FILTER (WHERE NOT malformed AND NOT light_empty) AS survivors
      FROM e""",
    "shard_assign": "WITH " + PIPE + " SELECT doc_id, CAST(shard_id AS INTEGER) AS shard_id FROM out",
    "run_summary": "WITH " + PIPE + f""", o AS (SELECT count(*) AS n, count(DISTINCT shard_id) AS s FROM out)
      SELECT 'records_after_cleaning' AS key, n AS value FROM o
      UNION ALL SELECT 'shards', s FROM o
      UNION ALL SELECT 'shard_size', {SHARD}
      UNION ALL SELECT 'dropped_true', dropped_true FROM acc
      UNION ALL SELECT 'dropped_reference', dropped_true + pii_replaced FROM acc""",
}
