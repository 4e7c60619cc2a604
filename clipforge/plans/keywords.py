"""Keywords of document titles (the first line of each document).

Stop words: the 50 words found in the most documents (a rule over the corpus).
``keyword_scores`` gives every candidate phrase with its score. The greedy near-duplicate
filter of ``keywords_topk`` is sequential per title: a recursive statement in SQL.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from clipforge.functions import constants as C
from clipforge.operators.keywords import keyword_candidates, top_document_words, top_keywords
from clipforge.plans.registry import register
from clipforge.sources.tables import Tables

N_STOPWORDS = 50


_END = "('.', '!', '?')"


_CANDIDATES_SQL = rf"""
t AS (SELECT doc_id, regexp_extract_all(split_part(text, chr(10), 1), '\p{{L}}+|[.!?]') AS toks FROM documents),
tok AS (SELECT doc_id, unnest(toks) AS raw, unnest(range(0, len(toks))) AS pos FROM t),
x AS (SELECT *, lag(raw) OVER w AS p, lead(raw) OVER w AS nx,
             coalesce(sum(CASE WHEN raw IN {_END} THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id ORDER BY pos
                      ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS sent
      FROM tok WINDOW w AS (PARTITION BY doc_id ORDER BY pos)),
words AS (SELECT doc_id, pos, sent, raw, lower(raw) AS w, CASE WHEN p NOT IN {_END} THEN lower(p) END AS l,
                 CASE WHEN nx NOT IN {_END} THEN lower(nx) END AS r, (p IS NULL OR p IN {_END}) AS ss
          FROM x WHERE raw NOT IN {_END}),
stops AS (SELECT word FROM (SELECT word, count(*) AS n FROM
            (SELECT DISTINCT doc_id, unnest(regexp_extract_all(lower(text), '\p{{L}}+')) AS word FROM documents) GROUP BY 1)
          ORDER BY n DESC, word LIMIT {N_STOPWORDS}),
per AS (SELECT doc_id, w, count(*) AS tf,
               sum(CASE WHEN NOT ss AND regexp_matches(raw, '^\p{{Lu}}') AND NOT regexp_matches(raw, '^\p{{Lu}}+$') THEN 1 ELSE 0 END) AS tc,
               sum(CASE WHEN regexp_matches(raw, '^\p{{Lu}}{{2,}}$') THEN 1 ELSE 0 END) AS ta, median(sent) AS ms,
               count(DISTINCT sent) AS nsw, count(l) AS nl, count(DISTINCT l) AS dl, count(r) AS nr, count(DISTINCT r) AS dr,
               bool_or(w IN (SELECT word FROM stops)) AS st
        FROM words GROUP BY 1, 2),
doc AS (SELECT doc_id, max(sent) + 1 AS ns FROM words GROUP BY 1),
mean AS (SELECT doc_id, avg(tf) AS mt, stddev_pop(tf) AS sd, max(tf) AS xt FROM per WHERE NOT st GROUP BY 1),
rel AS (SELECT per.*, ns, mt, sd, 1 + (CASE WHEN nl > 0 THEN dl / nl ELSE 0 END + CASE WHEN nr > 0 THEN dr / nr ELSE 0 END) * tf / xt AS rel
        FROM per JOIN doc USING (doc_id) LEFT JOIN mean USING (doc_id)),
s AS (SELECT doc_id, w, rel * ln(ln(3 + ms)) / (greatest(tc, ta) / (1 + ln(tf)) + tf / (mt + sd) / rel + nsw / ns / rel) AS s FROM rel),
k AS (SELECT words.doc_id, pos, sent, words.w, st, s,
             lead(words.w, 1) OVER v AS w1, lead(sent, 1) OVER v AS n1, lead(st, 1) OVER v AS t1, lead(s, 1) OVER v AS s1,
             lead(words.w, 2) OVER v AS w2, lead(sent, 2) OVER v AS n2, lead(st, 2) OVER v AS t2, lead(s, 2) OVER v AS s2
      FROM words JOIN per USING (doc_id, w) JOIN s USING (doc_id, w) WINDOW v AS (PARTITION BY words.doc_id ORDER BY pos)),
c AS (SELECT doc_id, w AS phrase, s AS prod, s AS total FROM k WHERE NOT st
      UNION ALL SELECT doc_id, w || ' ' || w1, s * s1, s + s1 FROM k WHERE NOT st AND NOT t1 AND n1 = sent
      UNION ALL SELECT doc_id, w || ' ' || w1 || ' ' || w2, s * s1 * s2, s + s1 + s2 FROM k WHERE NOT st AND NOT t2 AND n1 = sent AND n2 = sent)
"""


@register("keyword_scores", sql=f"""
WITH {_CANDIDATES_SQL}
SELECT doc_id, phrase, round(max(prod) / (count(*) * (1 + max(total))), 6) AS score FROM c GROUP BY 1, 2
""")
def q_keyword_scores(spark, data_dir):
    d = Tables(spark, data_dir).spread("documents", "doc_id", "text")
    titles = d.select("doc_id", F.substring_index("text", "\n", 1).alias("title"))
    c = keyword_candidates(titles, "doc_id", "title", top_document_words(d, "text", N_STOPWORDS))
    return c.select("doc_id", "phrase", F.round("score", 6).alias("score"))


# The SQL engine's edit distance counts bytes: Latin-1 letters are first read as single ASCII
# characters that no lower-cased phrase holds.
_LATIN = "".join(chr(c) for c in range(0xDF, 0x100) if chr(c).isalpha())
_ASCII = "ABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789"[:len(_LATIN)]


# Candidates are numbered best first; each step of the recursion judges the next one of every title.
@register("keywords_topk", sql=f"""
WITH RECURSIVE {_CANDIDATES_SQL},
best AS MATERIALIZED (
  SELECT doc_id, phrase, translate(phrase, '{_LATIN}', '{_ASCII}') AS letters, row_number() OVER (PARTITION BY doc_id ORDER BY score, phrase) AS n
  FROM (SELECT doc_id, phrase, round(max(prod) / (count(*) * (1 + max(total))), 12) AS score FROM c GROUP BY 1, 2)),
pick(doc_id, n, kept) AS (
  SELECT doc_id, 1, [{{'phrase': phrase, 'letters': letters}}] FROM best WHERE n = 1
  UNION ALL
  SELECT p.doc_id, p.n + 1,
         CASE WHEN len(list_filter(p.kept, lambda x: 1 - levenshtein(x.letters, b.letters) / greatest(length(x.letters), length(b.letters)) > {C.KEYWORD_DEDUP_LIMIT})) = 0
              THEN list_append(p.kept, {{'phrase': b.phrase, 'letters': b.letters}}) ELSE p.kept END
  FROM pick p JOIN best b ON b.doc_id = p.doc_id AND b.n = p.n + 1 WHERE len(p.kept) < {C.KEYWORDS_TOP})
SELECT doc_id, array_to_string(list_transform(arg_max(kept, n), lambda x: x.phrase), '|') AS keywords FROM pick GROUP BY 1
""")
def q_keywords_topk(spark, data_dir):
    d = Tables(spark, data_dir).spread("documents", "doc_id", "text")
    titles = d.select("doc_id", F.substring_index("text", "\n", 1).alias("title"))
    stop = top_document_words(d, "text", N_STOPWORDS)
    kw = top_keywords(keyword_candidates(titles, "doc_id", "title", stop), "doc_id")
    return kw.select("doc_id", F.array_join("keywords", "|").alias("keywords"))
