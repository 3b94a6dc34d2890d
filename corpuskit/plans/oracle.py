"""DuckDB SQL with the results of the queries in ``catalogue``."""

from __future__ import annotations

from ..functions import text as T
from ..operators.dedup.minhash import M, permutations
from ..operators.dedup.tfidf import STOP
from ..operators.quality import FEATURES, WEIGHTS

WS, SOLID, WORD, DAY = T.WS, T.SOLID, T.WORD, T.DAY


def strings(xs) -> str:
    return ", ".join("'" + x.replace("'", "''") + "'" for x in xs)


def stripped(c: str) -> str:
    return f"regexp_replace({c}, '^{WS}+|{WS}+$', '', 'g')"


def collapsed(c: str) -> str:
    return f"trim(regexp_replace({c}, '{WS}+', ' ', 'g'))"


_ROLE = f"""CASE WHEN r IN ({strings(T.USER_NAMES)}, '') THEN 'User' WHEN r IN ({strings(T.ASSISTANT_NAMES)}) THEN 'Assistant'
  ELSE upper(substr(r, 1, 1)) || substr(r, 2) END"""
TURNS = f"""c AS (SELECT conv_id, turn, text, was, {_ROLE} AS role FROM (SELECT conv_id, turn, text, role AS was, lower({stripped('role')}) AS r FROM conversations))"""

ROLE_NORMALIZE = f"WITH {TURNS} SELECT conv_id, turn, was AS role, role AS normal_role FROM c"

CONV_VALID_LENGTH = f"""WITH {TURNS} SELECT conv_id AS conversation_id, count(*) AS n_messages, sum(length(text))::BIGINT AS total_length FROM c
GROUP BY conv_id HAVING bool_and(role IS NOT NULL AND text IS NOT NULL) AND sum(length(text)) <= 4000"""

_WORDS = f"regexp_extract_all(lower(text), '{WORD}+')"
_STOPS = f"len(list_filter(w, lambda x: list_contains([{strings(sorted(T.STOPWORDS))}], x)))"
STOPWORD_RATIO = f"SELECT doc_id, len(w)::BIGINT AS n_words, round(CASE WHEN len(w) > 0 THEN {_STOPS} / len(w) ELSE 1.0 END, 6) AS ratio FROM (SELECT doc_id, {_WORDS} AS w FROM documents)"
STOPWORD_FILTER = f"""SELECT conv_id AS conversation_id FROM (SELECT conv_id, sum(len(w)) AS n, sum({_STOPS}) AS s FROM (SELECT conv_id, {_WORDS} AS w FROM conversations) GROUP BY conv_id)
WHERE n < 20 OR s / n <= 0.1"""

_BLOCKED = ["tionnt", "schst", "eauou", ".com"]
BLOCKLIST_MESSAGES = f"""SELECT conv_id AS conversation_id, count(*) AS n_messages, sum(length(text))::BIGINT AS total_length FROM conversations
WHERE text <> '' AND NOT ({" OR ".join(f"contains(text, '{w}')" for w in _BLOCKED)}) GROUP BY conv_id"""

_HIT = """CASE WHEN role = 'Assistant' AND (contains(text, 'eau') OR contains(text, 'ung')) THEN 'User'
  WHEN role = 'User' AND (contains(text, 'onth') OR contains(text, 'lich')) THEN 'Assistant' END"""
_NTH = "row_number() OVER (PARTITION BY conv_id ORDER BY turn) - 1 AS n"
ROLE_TRANSFER_INTENDED = f"WITH {TURNS} SELECT conv_id AS conversation_id, {_NTH}, coalesce({_HIT}, role) AS role FROM c"
ROLE_TRANSFER_REFERENCE = f"""WITH {TURNS}, s AS (SELECT *, coalesce({_HIT}, CASE WHEN role <> 'User' THEN role END) AS sets FROM c)
SELECT conv_id AS conversation_id, {_NTH}, last_value(sets IGNORE NULLS) OVER (PARTITION BY conv_id ORDER BY turn ROWS UNBOUNDED PRECEDING) AS role FROM s"""

EXACT_DEDUP_CONV = f"""WITH {TURNS}, h AS (SELECT conv_id, md5(string_agg(role || ':' || text, '||' ORDER BY turn)) AS h FROM c GROUP BY conv_id)
SELECT min(conv_id) AS conversation_id FROM h GROUP BY h"""
EXACT_DEDUP_DOCS = "SELECT doc_id, lang, source FROM documents QUALIFY row_number() OVER (PARTITION BY md5(text) ORDER BY doc_id) = 1"
EXACT_DEDUP_SHA256 = "SELECT min(doc_id) AS doc_id, sha256(text) AS digest FROM documents GROUP BY sha256(text)"
BLOOM_DEDUP = f"SELECT min(doc_id) AS doc_id FROM documents GROUP BY {collapsed('lower(text)')}"
BLOOM_PARAMS = """SELECT source, bits::BIGINT AS bits, (floor(bits / n * ln(2)) + 1)::BIGINT AS hashes
FROM (SELECT source, count(*) AS n, floor(-count(*) * ln(0.001) / pow(ln(2), 2)) + 1 AS bits FROM documents GROUP BY source)"""


def _qa(source: str) -> str:
    return f"""s AS (SELECT conv_id, turn, text, role, sum((role = 'User')::INT) OVER (PARTITION BY conv_id ORDER BY turn) AS seg FROM {source}),
p AS (SELECT conv_id, seg, max(text) FILTER (role = 'User') AS question, string_agg(text || chr(10), ' ' ORDER BY turn) FILTER (role = 'Assistant' AND {stripped('text')} <> '') AS answer FROM s WHERE seg > 0 GROUP BY conv_id, seg),
q AS (SELECT conv_id AS conversation_id, row_number() OVER (PARTITION BY conv_id ORDER BY seg) - 1 AS n, question, answer FROM p WHERE question <> '' AND answer IS NOT NULL)"""


QA_PAIRS = f"""WITH {TURNS}, h AS (SELECT conv_id, md5(string_agg(role || ':' || text, '||' ORDER BY turn)) AS h FROM c GROUP BY conv_id HAVING sum(length(text)) <= 32768),
k AS (SELECT c.* FROM c JOIN (SELECT min(conv_id) AS conv_id FROM h GROUP BY h) USING (conv_id)), {_qa('k')} SELECT * FROM q"""
QA_DEDUP_EXACT = f"""WITH {TURNS}, {_qa('c')} SELECT conversation_id, n, question FROM q
QUALIFY row_number() OVER (PARTITION BY {collapsed('lower(question)')} ORDER BY conversation_id, n) = 1"""
FIRST_500 = "SELECT conv_id, turn, role FROM conversations ORDER BY conv_id, turn LIMIT 500"
SUMMARY_STATS = "SELECT count(DISTINCT conv_id) AS conversations, count(*) AS messages, count(DISTINCT role) AS participants, sum(length(text))::BIGINT AS characters FROM conversations"
REPRESENTATIVE_LONGEST = f"""WITH {TURNS}, f AS (SELECT conv_id, arg_min(role, turn) AS role, count(*) AS n, sum(length(text))::BIGINT AS length FROM c GROUP BY conv_id)
SELECT role, n, conv_id AS conversation_id, length FROM f QUALIFY row_number() OVER (PARTITION BY role, n ORDER BY length DESC, conv_id) = 1"""

# --- quality

_SCORED = f"""d AS (SELECT doc_id, text, lang, (doc_id % 100) / 100.0::DOUBLE AS conf, (doc_id * 37 % 1500)::DOUBLE AS ppl,
  len(list_filter(string_split({collapsed('text')}, ' '), lambda w: w <> '')) AS nw FROM documents),
e AS (SELECT *, CASE WHEN nw > 0 THEN length(text) / nw ELSE 0.0 END AS per FROM d),
f AS (SELECT doc_id, text, lang, conf, ppl, conf AS f_lang, least(1.0, ppl / 1000) AS f_ppl, least(5.0, per) / 5 AS f_chars, least(15.0, per) / 15 AS f_words,
  CASE WHEN length(text) = 0 THEN 0.0 ELSE length(regexp_replace(text, '[\\p{{L}}\\p{{N}}{T.BLANK}]', '', 'g')) / length(text) END AS f_special FROM e),
z AS (SELECT *, 1 / (1 + exp(-({" + ".join(f"{n} * {w}" for n, w in WEIGHTS.items())}))) AS s, greatest(0.0, least(1.0, conf * (1 - least(1.0, ppl / 1000)))) AS fb FROM f)"""
QUALITY_FEATURES = f"WITH {_SCORED} SELECT doc_id, {', '.join(f'round({n}, 6) AS {n}' for n in FEATURES)} FROM z"
QUALITY_SCORE = f"WITH {_SCORED} SELECT doc_id, round(s, 6) AS score FROM z"
QUALITY_FALLBACK = f"WITH {_SCORED} SELECT doc_id, round(fb, 6) AS score FROM z"
QUALITY_FILTER = f"WITH {_SCORED} SELECT doc_id, lang AS language, round(s, 6) AS score FROM z WHERE {stripped('text')} <> '' AND lang IN ('en', 'fr') AND s >= 0.6"
LANGUAGE_TARGET_FILTER = "SELECT lang, count(*) AS n, sum(n_chars)::BIGINT AS chars FROM documents WHERE lang IN ('en', 'de') GROUP BY lang"
QUALITY_VS_LABELS = f"WITH {_SCORED} SELECT quality, count(*) AS n, round(avg(s), 6) AS mean_score FROM z JOIN labels USING (doc_id) GROUP BY quality"
WORD_PERPLEXITY = f"""WITH t AS (SELECT doc_id, unnest({_WORDS}) AS w FROM documents), n AS (SELECT w, count(*) AS n FROM t GROUP BY w),
m AS (SELECT w, log10((n + 1) / (SELECT sum(n) + count(*) FROM n)) AS logp FROM n)
SELECT doc_id, round(pow(10.0, -sum(logp) / count(*)), 3) AS perplexity FROM t JOIN m USING (w) GROUP BY doc_id"""



def _by_language(docs: str, words: str) -> str:
    """Bigram perplexities: ``words`` is (doc_id, lang, w) of the texts to score, ``docs`` of those to fit on."""
    pairs = "SELECT doc_id, lang, p.b AS b, p.x AS x, count(*) AS n FROM (SELECT doc_id, lang, unnest(list_transform(range(1, len(w) + 1), lambda i: {{'b': CASE WHEN i = 1 THEN '<s>' ELSE w[i - 1] END, 'x': w[i]}})) AS p FROM {}) GROUP BY ALL"
    return f"""fp AS MATERIALIZED ({pairs.format(docs)}), pb AS MATERIALIZED (SELECT lang, b, x, sum(n) AS n FROM fp GROUP BY ALL), pw AS (SELECT lang, x, sum(n) AS n FROM pb GROUP BY ALL),
pt AS MATERIALIZED (SELECT lang, sum(n) + count(*) + 1 AS al FROM pw GROUP BY lang),
m1 AS MATERIALIZED (SELECT lang, x, 0.4::DOUBLE * (n + 1) / al AS p FROM pw JOIN pt USING (lang)),
pf AS MATERIALIZED (SELECT *, sum(n) OVER (PARTITION BY lang, b) AS of FROM pb),
m2 AS MATERIALIZED (SELECT pf.lang, pf.b, pf.x, log10(0.6::DOUBLE * pf.n / pf.of + p) AS lp FROM pf JOIN m1 ON m1.lang = pf.lang AND m1.x = pf.x),
sp AS MATERIALIZED ({pairs.format(words)}),
pp AS (SELECT doc_id, pow(10.0, -sum(sp.n * coalesce(m2.lp, log10(m1.p), log10(0.4::DOUBLE / al))) / sum(sp.n)) AS ppl
  FROM sp LEFT JOIN m2 ON m2.lang = sp.lang AND m2.b = sp.b AND m2.x = sp.x LEFT JOIN m1 ON m1.lang = sp.lang AND m1.x = sp.x LEFT JOIN pt ON pt.lang = sp.lang GROUP BY doc_id)"""


def _languages() -> str:
    """Naive Bayes on character n-grams, fitted on all labels."""
    return f"""t AS (SELECT doc_id, text, lang, {collapsed('lower(text)')} AS t FROM documents),
g AS MATERIALIZED (SELECT doc_id, g, count(*) AS n FROM (SELECT doc_id, substr(t, i::INT, 3) AS g FROM (SELECT doc_id, t, unnest(range(1, length(t) - 1)) AS i FROM t WHERE length(t) >= 3)) GROUP BY ALL),
c AS MATERIALIZED (SELECT lang, g, sum(n) AS n FROM g JOIN t USING (doc_id) WHERE lang IS NOT NULL GROUP BY ALL), ct AS (SELECT lang, ln(1 / (sum(n) + (SELECT count(DISTINCT g) FROM c))) AS base FROM c GROUP BY lang),
cs AS (SELECT doc_id, c.lang, sum(g.n * ln(c.n + 1)) AS s FROM g JOIN c USING (g) GROUP BY ALL),
cz AS (SELECT z.doc_id, ct.lang, z.size * base + coalesce(s, 0) AS s FROM (SELECT doc_id, sum(n) AS size FROM g GROUP BY doc_id) z CROSS JOIN ct LEFT JOIN cs ON cs.doc_id = z.doc_id AND cs.lang = ct.lang),
nb AS MATERIALIZED (SELECT doc_id, lang AS language, 1 / sum(exp(s - top)) OVER (PARTITION BY doc_id) AS confidence FROM (SELECT *, max(s) OVER (PARTITION BY doc_id) AS top FROM cz)
  QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY s DESC, lang) = 1)"""


LANGID_NB = f"WITH {_languages()} SELECT doc_id, language, round(confidence, 6) AS confidence FROM nb"
PERPLEXITY_BY_LANGUAGE = f"WITH w AS (SELECT doc_id, lang, {_WORDS} AS w FROM documents WHERE lang IS NOT NULL), {_by_language('w', 'w')} SELECT doc_id, round(ppl, 3) AS perplexity FROM pp"
QUALITY_END_TO_END = f"""WITH {_languages()}, w AS (SELECT doc_id, lang, {_WORDS} AS w FROM documents WHERE lang IS NOT NULL), v AS (SELECT doc_id, language AS lang, {_WORDS} AS w FROM documents JOIN nb USING (doc_id)), {_by_language('w', 'v')},
d AS (SELECT doc_id, text, language, confidence, ppl, len(list_filter(string_split({collapsed('text')}, ' '), lambda w: w <> '')) AS nw,
  CASE WHEN length(text) = 0 THEN 0.0 ELSE length(regexp_replace(text, '[\\p{{L}}\\p{{N}}{T.BLANK}]', '', 'g')) / length(text) END AS special FROM documents LEFT JOIN nb USING (doc_id) LEFT JOIN pp USING (doc_id)),
e AS (SELECT *, CASE WHEN nw > 0 THEN length(text) / nw ELSE 0.0 END AS per FROM d),
z AS (SELECT *, 1 / (1 + exp(-({WEIGHTS['f_lang']} * round(coalesce(confidence, 0.0), 6) + {WEIGHTS['f_ppl']} * least(1.0, coalesce(ppl, 'inf'::DOUBLE) / 1000) + {WEIGHTS['f_chars']} * least(5.0, per) / 5 + {WEIGHTS['f_words']} * least(15.0, per) / 15 + {WEIGHTS['f_special']} * special))) AS s FROM e)
SELECT doc_id, language, round(confidence, 4) AS confidence, round(ppl, 2) AS perplexity, round(s, 4) AS score FROM z WHERE {stripped('text')} <> '' AND language IN ('en', 'fr') AND s >= 0.6"""

# --- formatting


def _text(x: str) -> str:
    return f"SELECT doc_id, {x} AS text FROM documents"


_PUNCT = r"""regexp_replace({}, '[!-/:-@\[-`{{-~]', '', 'g')"""
_NUMBERS = r"regexp_replace({}, '\p{{Nd}}+(?:\.\p{{Nd}}+)?', '[NUMBER]', 'g')"
_URLS = "regexp_replace({}, 'https?://" + SOLID.replace("{", "{{").replace("}", "}}") + r"+|www\." + SOLID.replace("{", "{{").replace("}", "}}") + "+', '[URL]', 'g')"
_EMAILS = "regexp_replace({}, '" + (SOLID + "+@" + SOLID + r"+\." + SOLID + "+").replace("{", "{{").replace("}", "}}") + "', '[EMAIL]', 'g')"
REPLACE_URLS, REPLACE_EMAILS, REPLACE_NUMBERS, STRIP_PUNCT = (_text(x.format("text")) for x in (_URLS, _EMAILS, _NUMBERS, _PUNCT))
COLLAPSE_WS, LOWERCASE, NFC = _text(collapsed("text")), _text("lower(text)"), _text("nfc_normalize(text)")
HTML_STRIP = "SELECT page_id, regexp_replace(html, '<[^>]*>', '', 'g') AS text FROM pages"
PAGE_URLS = f"SELECT page_id, {_URLS.format(chr(39) + 'see ' + chr(39) + ' || url || ' + chr(39) + ' now' + chr(39))} AS text FROM pages"


def _normalized(text: str) -> str:
    """A line at a time; the patterns' look-ahead isn't needed for texts in which no slash follows a range."""
    full = r"\1/\2 to \1/\3"
    x = f"regexp_replace(regexp_replace(l, '({DAY})/({DAY})~({DAY})', '{full}', 'g'), '({DAY})/({DAY})[-~]({DAY})', '{full}', 'g')"
    m = f"regexp_extract(l, '({DAY})/', 1)"
    for _ in range(2):  # neighbours share a comma
        x = rf"regexp_replace({x}, '(^|[、，,]){WS}*({DAY})~({DAY}){WS}*($|[、，,])', '\1' || {m} || '/\2 to ' || {m} || '/\3\4', 'g')"
    return f"array_to_string(list_transform(string_split({text}, chr(10)), lambda l: CASE WHEN {m} = '' THEN l ELSE {x} END), chr(10))"


FORMAT_TEXT_ALL = _text("lower(" + collapsed(_PUNCT.format(_NUMBERS.format(_EMAILS.format(_URLS.format(_normalized("regexp_replace(text, '<[^>]*>', '', 'g')")))))) + ")")
_DATED = """o AS (SELECT o_orderkey, m || '/' || d || '~' || (d + 1) || '、' || (d + 2) || '~' || (d + 3) || ', ' || d || '~' || d || chr(10) || 'no ' || d || '~' || d || chr(10)
  || '2023/' || m || '/' || d || '、' || d || '、' || m || ', ' || m || '-' || d AS text FROM (SELECT o_orderkey, month(o_orderdate) AS m, day(o_orderdate) AS d FROM orders))"""
NORMALIZE_DATES = f"WITH {_DATED} SELECT o_orderkey, {_normalized('text')} AS text FROM o"


def _replaced() -> str:
    x = "text"
    for p in (rf"20\p{{Nd}}{{2}}/{DAY}/{DAY}", rf"20\p{{Nd}}{{2}}-{DAY}-{DAY}", f"{DAY}/{DAY}~{DAY}", f"{DAY}/{DAY}[-~]{DAY}", f"{DAY}/{DAY}", f"{DAY}-{DAY}", f"{DAY}~{DAY}"):
        x = f"regexp_replace({x}, '{p}', '[DATE]', 'g')"
    for _ in range(4):
        x = rf"regexp_replace({x}, '(\[DATE\][、,，] ?){DAY}', '\1[DATE]', 'g')"
    return x


REPLACE_DATES = f"WITH {_DATED} SELECT o_orderkey, {_replaced()} AS text FROM o"

# --- near duplicates

_NORMAL = f"t AS (SELECT doc_id, text, {collapsed('lower(text)')} AS t FROM documents)"


def _grams(n: int, distinct: str) -> str:
    return f"g AS (SELECT {distinct} doc_id, substr(t, i::INT, {n}) AS g FROM (SELECT doc_id, t, unnest(range(1, length(t) - {n - 2})) AS i FROM t WHERE length(t) >= {n}))"


CHAR_NGRAMS_COUNT = f"WITH {_NORMAL}, {_grams(5, '')} SELECT doc_id, count(g) AS n, count(DISTINCT g) AS n_distinct FROM t LEFT JOIN g USING (doc_id) GROUP BY doc_id"


def _hex(c: str, at: int, n: int = 8) -> str:
    return f"('0x' || substr({c}, {at}, {n}))::UBIGINT"


def _signed(n: int) -> str:
    mod = " + ".join(_hex("m", at) for at in (1, 9, 17, 25))
    sums = ", ".join(f"min(({a}::UBIGINT * h + {b}::UBIGINT) % {M}::UBIGINT)::BIGINT AS s{i}" for i, (a, b) in enumerate(permutations(128)[:n]))
    return f"{_NORMAL}, {_grams(5, 'DISTINCT')}, h AS (SELECT doc_id, ({mod}) % {M}::UBIGINT AS h FROM (SELECT doc_id, md5(g) AS m FROM g)), s AS MATERIALIZED (SELECT doc_id, {sums} FROM h GROUP BY doc_id)"


MINHASH_SIGNATURE = f"WITH {_signed(8)} SELECT doc_id, {', '.join(f's{i}' for i in range(8))} FROM t LEFT JOIN s USING (doc_id)"
_BANDS = " UNION ALL ".join(f"SELECT doc_id, {b} AS band, concat_ws(',', {', '.join(f's{i}' for i in range(8 * b, 8 * b + 8))}) AS key FROM s" for b in range(16))
_LSH = f"{_signed(128)}, b AS MATERIALIZED ({_BANDS})"
LSH_CANDIDATES = f"WITH {_LSH} SELECT size, count(*) AS buckets FROM (SELECT count(*) AS size FROM b GROUP BY band, key) GROUP BY size"
_MATCHES = " + ".join(f"(x.s{i} = y.s{i})::INT" for i in range(128))
_EDGES = f"""{_LSH}, p AS (SELECT DISTINCT x.doc_id AS a, y.doc_id AS b FROM b x JOIN b y ON x.band = y.band AND x.key = y.key AND x.doc_id < y.doc_id),
e AS MATERIALIZED (SELECT a, b FROM p JOIN s x ON x.doc_id = a JOIN s y ON y.doc_id = b WHERE {_MATCHES} >= 0.8 * 128
  UNION SELECT x.doc_id, y.doc_id FROM t x JOIN t y ON x.t = y.t AND length(x.t) BETWEEN 1 AND 4 AND x.doc_id < y.doc_id)"""
_COMPONENTS = """y AS MATERIALIZED (SELECT a, b FROM e UNION SELECT b, a FROM e),
r AS (SELECT a AS id, a AS comp FROM y UNION SELECT y.b, r.comp FROM r JOIN y ON y.a = r.id),
k AS MATERIALIZED (SELECT id, min(comp) AS comp FROM r GROUP BY id)"""
_SIZES = "SELECT comp, count(*) AS members, sum(id)::BIGINT AS ids FROM k GROUP BY comp"


def _best(length: str, source: str, key: str) -> str:
    return f"v AS (SELECT id, comp, first_value(id) OVER (PARTITION BY comp ORDER BY {length} DESC, id) AS kept_id FROM k JOIN {source} ON {key} = id)"


def _survivors(edges: str, length: str, source: str, key: str, out: str) -> str:
    return f"WITH RECURSIVE {edges}, {_COMPONENTS}, {_best(length, source, key)} SELECT {out} FROM {source} WHERE {key} NOT IN (SELECT id FROM v WHERE id <> kept_id)"


MINHASH_PAIRS = f"WITH RECURSIVE {_EDGES}, {_COMPONENTS} {_SIZES}"
_NODE = "n AS (SELECT doc_id, min(doc_id) OVER (PARTITION BY {}) AS node FROM {})"
#: Pairs of rows with different signatures (fingerprints), of each the first; the others are tied to that.
_ALL = ", ".join(f"s{i}" for i in range(128))
MINHASH_SIMILARITY = f"""WITH {_EDGES}, {_NODE.format(_ALL, 's')}, m AS (SELECT a, b, x.node AS m, y.node AS o FROM e JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b)
SELECT a AS src, b AS dst, ({_MATCHES}) / 128.0::DOUBLE AS similarity FROM m JOIN s x ON x.doc_id = a JOIN s y ON y.doc_id = b WHERE (m = a AND o = b) OR (m = o AND m = a)
UNION ALL SELECT min(x.doc_id) OVER (PARTITION BY t), doc_id, 1.0 FROM t x WHERE length(t) BETWEEN 1 AND 4 QUALIFY min(x.doc_id) OVER (PARTITION BY t) <> doc_id"""
MINHASH_CLUSTERS = f"WITH RECURSIVE {_EDGES}, {_COMPONENTS} SELECT id AS doc_id, comp FROM k"
MINHASH_DEDUP = _survivors(_EDGES, "length(text)", "documents", "doc_id", "doc_id")
MINHASH_REMOVED = f"WITH RECURSIVE {_EDGES}, {_COMPONENTS}, {_best('length(text)', 'documents', 'doc_id')} SELECT id AS doc_id, kept_id FROM v WHERE id <> kept_id"

_VOTES = ", ".join(f"sum(CASE WHEN (h >> {k}) & 1 = 1 THEN 1 ELSE -1 END) AS b{k}" for k in range(64))
_PACKED = " + ".join(f"CASE WHEN b{k} > 0 THEN {1 << k}::UHUGEINT ELSE 0::UHUGEINT END" for k in range(64))
_FP = f"""{_NORMAL}, {_grams(5, '')}, h AS (SELECT doc_id, {_hex('md5(g)', 17, 16)} AS h FROM g), s AS (SELECT doc_id, {_VOTES} FROM h GROUP BY doc_id),
f AS MATERIALIZED (SELECT doc_id, CASE WHEN b0 IS NOT NULL THEN {_PACKED} END AS u FROM t LEFT JOIN s USING (doc_id)),
fp AS MATERIALIZED (SELECT doc_id, (CASE WHEN u >= {1 << 63}::UHUGEINT THEN u::HUGEINT - {1 << 64}::HUGEINT ELSE u::HUGEINT END)::BIGINT AS fp FROM f)"""
SIMHASH_VALUE = f"WITH {_FP} SELECT doc_id, fp FROM fp"
#: Texts of less than five characters are tied to equal ones only.
_SIM = f"""{_FP}, e AS MATERIALIZED (SELECT x.doc_id AS a, y.doc_id AS b FROM fp x JOIN fp y ON x.doc_id < y.doc_id AND bit_count(xor(x.fp, y.fp)) <= 3
  UNION SELECT x.doc_id, y.doc_id FROM t x JOIN t y ON x.t = y.t AND length(x.t) BETWEEN 1 AND 4 AND x.doc_id < y.doc_id)"""
SIMHASH_PAIRS = f"WITH RECURSIVE {_SIM}, {_COMPONENTS} {_SIZES}"
SIMHASH_NEAR = f"""WITH {_FP}, {_NODE.format('fp', '(SELECT * FROM fp WHERE fp IS NOT NULL)')}, d AS (SELECT node, any_value(fp) AS fp FROM n JOIN fp USING (doc_id) GROUP BY node)
SELECT x.node AS src, y.node AS dst, bit_count(xor(x.fp, y.fp))::INT AS distance FROM d x JOIN d y ON x.node < y.node AND bit_count(xor(x.fp, y.fp)) <= 3
UNION ALL SELECT node, doc_id, 0 FROM n WHERE node <> doc_id
UNION ALL SELECT min(doc_id) OVER (PARTITION BY t), doc_id, 0 FROM t WHERE length(t) BETWEEN 1 AND 4 QUALIFY min(doc_id) OVER (PARTITION BY t) <> doc_id"""
SIMHASH_DEDUP = _survivors(_SIM, "length(text)", "documents", "doc_id", "doc_id")

_COS = "list_cosine_similarity(x.embedding::DOUBLE[], y.embedding::DOUBLE[])"
COSINE_PAIRS = f"SELECT x.vec_id AS src, y.vec_id AS dst, round({_COS}, 4) AS cosine FROM embeddings x JOIN embeddings y ON x.vec_id < y.vec_id AND {_COS} >= 0.4"
SEMANTIC_DEDUP = _survivors(f"e AS MATERIALIZED (SELECT x.vec_id AS a, y.vec_id AS b FROM embeddings x JOIN embeddings y ON x.vec_id < y.vec_id AND {_COS} >= 0.4)", "len(embedding)", "embeddings", "vec_id", "vec_id, label")

_LCS = f"""m AS MATERIALIZED (SELECT conv_id * 1000 + turn AS id, text, {collapsed('lower(text)')} AS t FROM conversations),
g AS MATERIALIZED (SELECT id, length(t) AS n, i::INT AS p, substr(t, i::INT, 20) AS g FROM (SELECT id, t, unnest(range(1, length(t) - 18)) AS i FROM m WHERE length(t) >= 20)),
j AS (SELECT x.id AS a, y.id AS b, x.p AS p, x.p - y.p AS d, least(x.n, y.n) AS n FROM g x JOIN g y ON x.g = y.g AND x.id < y.id),
u AS (SELECT *, p - row_number() OVER (PARTITION BY a, b, d ORDER BY p) AS run FROM j),
w AS (SELECT a, b, max(r) + 19 AS common, any_value(n) AS shorter FROM (SELECT a, b, d, run, count(*) AS r, any_value(n) AS n FROM u GROUP BY a, b, d, run) GROUP BY a, b),
q AS MATERIALIZED (SELECT a, b, common, shorter FROM w WHERE common / shorter >= 0.5)"""
#: Texts that are equal count as one node, the first, which the others are tied to.
LCS_PAIRS = f"""WITH {_LCS}, n AS (SELECT id, min(id) OVER (PARTITION BY t) AS node FROM m)
SELECT a AS src, b AS dst, common::BIGINT AS common, shorter::BIGINT AS shorter FROM q JOIN n x ON x.id = a JOIN n y ON y.id = b WHERE (x.node = a AND y.node = b) OR (x.node = y.node AND x.node = a)"""
LCS_DEDUP = _survivors(f"{_LCS}, e AS MATERIALIZED (SELECT a, b FROM q)", "length(text)", "m", "m.id", "id").replace("SELECT id, comp, first_value(id)", "SELECT k.id, comp, first_value(k.id)").replace("length(text) DESC, id)", "length(text) DESC, k.id)").replace("m.id = id", "m.id = k.id")

_TFIDF = f"""w AS (SELECT doc_id, list_filter({_WORDS}, lambda x: length(x) >= 2 AND NOT list_contains([{strings(STOP)}], x)) AS w FROM documents),
u AS (SELECT doc_id, unnest(list_concat(w, list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]))) AS term FROM w),
c AS MATERIALIZED (SELECT doc_id, term, count(*) AS tf FROM u GROUP BY doc_id, term),
i AS (SELECT term, ln((1 + (SELECT count(*) FROM documents)) / (1 + count(*))) + 1 AS idf FROM c GROUP BY term ORDER BY sum(tf) DESC, term LIMIT 10000),
x AS MATERIALIZED (SELECT doc_id, term, tf * idf AS x FROM c JOIN i USING (term)),
v AS MATERIALIZED (SELECT doc_id, term, x / sqrt(sum(x * x) OVER (PARTITION BY doc_id)) AS w FROM x),
q AS MATERIALIZED (SELECT a.doc_id AS a, b.doc_id AS b, sum(a.w * b.w) AS cosine FROM v a JOIN v b ON a.term = b.term AND a.doc_id < b.doc_id GROUP BY 1, 2 HAVING 1 - sum(a.w * b.w) <= 0.2)"""
TFIDF_PAIRS = f"WITH {_TFIDF} SELECT a AS src, b AS dst, round(cosine, 6) AS cosine FROM q"
DBSCAN_DEDUP = _survivors(f"{_TFIDF}, e AS MATERIALIZED (SELECT a, b FROM q)", "length(text)", "documents", "doc_id", "doc_id").replace(", v AS (SELECT id", ", vv AS (SELECT id").replace("FROM v WHERE id", "FROM vv WHERE id")

PAIR_SHAPES = """SELECT conv_id, turn, 0 AS n, 'User' AS role, text AS content FROM conversations WHERE text <> '' AND role <> ''
UNION ALL SELECT conv_id, turn, 1, 'Assistant', role FROM conversations WHERE text <> '' AND role <> ''"""
GENERIC_SHAPES = f"""WITH {TURNS} SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn) - 1 AS n, CASE WHEN conv_id % 4 = 0 THEN was ELSE role END AS role, text AS content
FROM c WHERE text <> '' AND conv_id % 4 <> 3"""
