"""The catalogue's queries in DuckDB SQL over the same tables."""

from __future__ import annotations

from corpusloom.functions import minhash
from corpusloom.functions.markup import HTML_RULES
from corpusloom.functions.pii import MORE_PATTERNS, PATTERNS
from corpusloom.functions.prompts import CHAT_START, PROMPT_TEMPLATE, TURN_PARTS
from corpusloom.operators.sft import METRICS
from corpusloom.plans import catalog as c

SQL: dict[str, str] = {}


def quoted(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def with_(*ctes: str, select: str) -> str:
    return "WITH RECURSIVE " + ",\n".join(ctes) + "\n" + select


def words(column: str) -> str:
    return f"list_filter(string_split_regex({column}, '[ \\t\\n\\r\\f]+'), lambda w: w <> '')"


def bucket(key: str, modulus: int) -> str:
    return f"(('0x' || substr(md5({key}::varchar), 1, 7))::bigint % {modulus})"


# --- ids, words, repetition ------------------------------------------------

SQL["add_id"] = """
SELECT 'id-' || lpad((row_number() OVER (ORDER BY doc_id) - 1)::varchar, 10, '0') AS id,
       doc_id, source
FROM documents"""

SQL["add_id_fill"] = """
SELECT coalesce(given, 'id-' || lpad((row_number() OVER (ORDER BY doc_id) + most)::varchar, 10, '0')) AS id, doc_id, source
FROM (SELECT doc_id, source, max(2 * doc_id) FILTER (WHERE doc_id % 3 <> 0) OVER () AS most,
             CASE WHEN doc_id % 3 <> 0 THEN 'id-' || lpad((2 * doc_id)::varchar, 10, '0') END AS given FROM documents)"""

SQL["word_count"] = f"SELECT doc_id, len({words('text')})::bigint AS word_count FROM documents"
SQL["word_count_filter"] = f"SELECT * FROM ({SQL['word_count']}) WHERE word_count >= 50"


def top_ngrams(source: str, ns: tuple[int, ...]) -> list[str]:
    """CTE ``tops(doc_id, n, top_count, top_length, chars)`` of relation ``source``."""
    grams = " UNION ALL ".join(
        f"""SELECT doc_id, {n} AS n,
                   unnest(list_transform(range(1, len(w) - {n - 2}),
                          lambda i: {" || ' ' || ".join(f"w[i + {k}]" for k in range(n))})) AS gram
            FROM worded WHERE len(w) >= {n}"""
        for n in ns
    )
    values = ", ".join(f"({n})" for n in ns)
    return [
        f"worded AS (SELECT doc_id, text, {words('text')} AS w FROM {source})",
        f"grams AS ({grams})",
        "counted AS (SELECT doc_id, n, gram, count(*) AS k FROM grams GROUP BY ALL)",
        """best AS (SELECT doc_id, n, k, length(gram) AS len FROM counted
                    QUALIFY row_number() OVER (PARTITION BY doc_id, n ORDER BY k DESC, length(gram) DESC) = 1)""",
        f"""tops AS (SELECT d.doc_id, v.n, coalesce(k, 0)::bigint AS top_count,
                            coalesce(len, 0)::bigint AS top_length, length(d.text) AS chars
                     FROM {source} d CROSS JOIN (VALUES {values}) v(n)
                     LEFT JOIN best b ON b.doc_id = d.doc_id AND b.n = v.n)""",
    ]


SQL["ngram_repetition"] = with_(
    *top_ngrams("documents", (2, 3, 4)),
    select="SELECT doc_id, n::bigint AS n, top_count, top_length FROM tops",
)
LIMITS = {2: 20, 3: 18, 4: 16}
for n, percent in LIMITS.items():
    SQL[f"ngram_filter_{n}"] = with_(
        *top_ngrams("documents", (n,)),
        select=f"SELECT doc_id FROM tops WHERE top_count * top_length * 100 <= chars * {percent}",
    )


def heuristic(source: str) -> list[str]:
    """CTE ``heuristic(doc_id, word_count)``."""
    limits = " ".join(f"WHEN {n} THEN {p}" for n, p in LIMITS.items())
    return [
        *top_ngrams(source, tuple(LIMITS)),
        f"""heuristic AS (
          SELECT doc_id, len(w)::bigint AS word_count FROM worded
          WHERE len(w) >= 50 AND doc_id NOT IN (
            SELECT doc_id FROM tops
            WHERE top_count * top_length * 100 > chars * (CASE n {limits} END)))""",
    ]


SQL["heuristic_filter"] = with_(
    *heuristic("documents"), select="SELECT doc_id, word_count FROM heuristic"
)

# --- personal data ---------------------------------------------------------

SQL["pii_findings"] = " UNION ALL ".join(
    f"""SELECT doc_id, {quoted(entity)} AS entity,
               unnest(range(len(found))) AS position, unnest(found) AS value
        FROM (SELECT doc_id, regexp_extract_all(text, {quoted(pattern)}) AS found FROM documents)"""
    for entity, pattern in PATTERNS.items()
)


def pii_replaced(source: str, tagged: bool = True) -> str:
    text = "text"
    for entity, pattern in PATTERNS.items():
        tag = f"<{entity}>" if tagged else ""
        text = f"regexp_replace({text}, {quoted(pattern)}, {quoted(tag)}, 'g')"
    return f"SELECT doc_id, {text} AS text FROM {source}"


SQL["pii_replace"] = pii_replaced("documents")
SQL["pii_redact"] = pii_replaced("documents", tagged=False)


def pii_rewritten(rewrite: str) -> str:
    ctes, source = [], "documents"
    for i, pattern in enumerate(PATTERNS.values()):
        ctes.append(
            f"""s{i} AS (SELECT doc_id, array_to_string(list_transform(
                  list_zip(string_split_regex(text, {quoted(pattern)}),
                           regexp_extract_all(text, {quoted(pattern)})),
                  lambda p: p[1] || coalesce({rewrite}, '')), '') AS text FROM {source})"""
        )
        source = f"s{i}"
    return with_(*ctes, select=f"SELECT doc_id, text FROM {source}")


SQL["pii_mask"] = pii_rewritten("repeat('*', length(p[2]))")
SQL["pii_hash"] = pii_rewritten("sha256(p[2])")

SQL["pii_encrypt"] = f"""
SELECT doc_id, text, {" OR ".join(f"regexp_matches(text, {quoted(p)})" for p in PATTERNS.values())} AS has_entity FROM documents"""

_PLANTED = """planted AS (SELECT doc_id, text || ' card 4111 1111 ' || n || ' ' || lpad((doc_id % 10000)::varchar, 4, '0') || ', SSN 123-45-' || n
    || ', DE89 3704 0044 0532 ' || n || ' 00, 00:1b:44:11:3a:b7, https://example.org/' || n AS text
  FROM (SELECT doc_id, text, lpad((doc_id * 7919 % 10000)::varchar, 4, '0') AS n FROM documents))"""


def luhn(value: str) -> str:
    """Every second digit from the right counts twice; 10 or more as the sum of its digits."""
    digits = f"list_reverse(string_split(regexp_replace({value}, '[^0-9]', '', 'g'), ''))"
    return f"""list_sum(list_transform({digits}, lambda d, i: CASE WHEN i % 2 = 1 THEN d::int
      ELSE (2 * d::int) // 10 + (2 * d::int) % 10 END)) % 10 = 0"""


_CARD = quoted(MORE_PATTERNS["CREDIT_CARD"])
SQL["pii_more_findings"] = with_(
    _PLANTED,
    select=" UNION ALL ".join(
        f"""SELECT doc_id, {quoted(entity)} AS entity, unnest(range(len(found))) AS position, unnest(found) AS value
            FROM (SELECT doc_id, list_filter(regexp_extract_all(text, {quoted(pattern)}),
                         lambda v: {luhn('v') if entity == 'CREDIT_CARD' else 'true'}) AS found FROM planted)"""
        for entity, pattern in MORE_PATTERNS.items()
    ),
)
SQL["pii_more_replace"] = with_(
    _PLANTED,
    f"""cards AS (SELECT doc_id, array_to_string(list_transform(
          list_zip(string_split_regex(text, {_CARD}), regexp_extract_all(text, {_CARD})),
          lambda p: p[1] || CASE WHEN p[2] IS NULL THEN '' WHEN {luhn('p[2]')} THEN '<CREDIT_CARD>' ELSE p[2] END), '') AS text
        FROM planted)""",
    select=f"SELECT doc_id, regexp_replace(text, {quoted(MORE_PATTERNS['US_SSN'])}, '<US_SSN>', 'g') AS text FROM cards",
)

# --- Unicode and extraction ------------------------------------------------

SQL["unicode_repair"] = """
SELECT doc_id, CASE WHEN doc_id % 5 = 3 THEN text || ' it’s café' ELSE text END AS text FROM documents"""
SQL["unicode_noop"] = "SELECT doc_id, text FROM documents"


def with_rules(column: str, rules: list[tuple[str, str]]) -> str:
    for pattern, replacement in rules:
        replacement = replacement.replace("$1", "\\1")
        column = f"regexp_replace({column}, {quoted(pattern)}, {quoted(replacement)}, 'g')"
    return column


SQL["wiki_extract"] = """
SELECT doc_id, source || ' is a thing of Place and a link, <5 {{unclosed ' || chr(10) || 'Text' || chr(10) || text || chr(10)
  || 'one' || chr(10) || 'two [[three]]' || chr(10) || chr(10) || 'Category:Shown' AS text
FROM documents"""


def _html(column: str) -> str:
    return f"regexp_replace({with_rules(column, HTML_RULES)}, '^ | $', '', 'g')"


_TITLE = "regexp_extract(html, '(?is)<title[^>]*>(.*?)</title>', 1)"
SQL["page_extract"] = (
    f"SELECT page_id, url, {_html(_TITLE)} AS title, {_html('html')} AS text FROM pages"
)

# --- language --------------------------------------------------------------

_LANGUAGE = [
    """chars AS (SELECT doc_id, lang, regexp_extract_all(lower(text), '(?s).') AS ch FROM documents)""",
    """docgrams AS (
         SELECT doc_id, lang, gram, count(*) AS k FROM (
           SELECT doc_id, lang, unnest(ch) AS gram FROM chars
           UNION ALL
           SELECT doc_id, lang, unnest(list_transform(range(1, len(ch)), lambda i: ch[i] || ch[i + 1]))
           FROM chars
           UNION ALL
           SELECT doc_id, lang, unnest(list_transform(range(1, len(ch) - 1),
                                       lambda i: ch[i] || ch[i + 1] || ch[i + 2]))
           FROM chars)
         GROUP BY ALL)""",
    """profile AS (
         SELECT lang, gram, row_number() OVER (PARTITION BY lang ORDER BY k DESC, gram) AS rank
         FROM (SELECT lang, gram, sum(k) AS k FROM docgrams GROUP BY ALL)
         QUALIFY rank <= 300)""",
]
_IDENTIFIED = [
    *_LANGUAGE,
    """own AS (
         SELECT doc_id, gram, row_number() OVER (PARTITION BY doc_id ORDER BY k DESC, gram) AS rank
         FROM docgrams QUALIFY rank <= 300)""",
    """distances AS (
         SELECT d.doc_id, l.lang,
                sum(CASE WHEN o.gram IS NULL THEN 0 WHEN p.rank IS NULL THEN 300
                         ELSE abs(o.rank - p.rank) END)::bigint AS distance
         FROM documents d CROSS JOIN (SELECT DISTINCT lang FROM profile) l
         LEFT JOIN own o ON o.doc_id = d.doc_id
         LEFT JOIN profile p ON p.lang = l.lang AND p.gram = o.gram
         GROUP BY ALL)""",
    """identified AS (
         SELECT doc_id, upper(lang) AS language, distance FROM distances
         QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY distance, lang) = 1)""",
]
SQL["language_profile"] = with_(*_LANGUAGE, select="SELECT lang, gram, rank FROM profile")
SQL["language_identify"] = with_(*_IDENTIFIED, select="SELECT * FROM identified")
SQL["language_stats"] = with_(
    *_IDENTIFIED, select="SELECT language, count(*) AS documents FROM identified GROUP BY ALL"
)
SQL["language_select"] = with_(
    *_IDENTIFIED, select="SELECT doc_id, language FROM identified WHERE language = 'FR'"
)

# --- exact and fuzzy duplicates --------------------------------------------

SQL["exact_duplicates"] = """
SELECT doc_id, group_id, copies FROM (
  SELECT doc_id, min(doc_id) OVER g AS group_id, count(*) OVER g AS copies
  FROM documents WINDOW g AS (PARTITION BY md5(text)))
WHERE doc_id <> group_id"""
SQL["exact_dedup"] = """
SELECT doc_id, source FROM documents
WHERE doc_id IN (SELECT min(doc_id) FROM documents GROUP BY md5(text))"""


def shingle_ctes(source: str) -> list[str]:
    """CTE ``shingled(doc_id, hs)``: the distinct 5-gram hashes of each text."""
    step = "c[i]::bigint"
    for k in range(1, c.FUZZY.char_ngrams):
        step = f"(({step}) * {minhash.RADIX} + c[i + {k}]) % {minhash.PRIME}"
    return [
        f"""points AS (SELECT doc_id, list_transform(regexp_extract_all(text, '(?s).'),
                                                   lambda x: unicode(x)::bigint) AS c FROM {source})""",
        f"""shingled AS (SELECT doc_id, list_distinct(list_transform(
              range(1, greatest(len(c) - {c.FUZZY.char_ngrams - 2}, 1)), lambda i: {step})) AS hs FROM points)""",
    ]


def minhash_ctes(source: str) -> list[str]:
    """CTE ``sig(doc_id, k, v)``."""
    count = c.FUZZY.num_buckets * c.FUZZY.hashes_per_bucket
    pairs = minhash.coefficients(c.FUZZY.seed, count)
    values = ", ".join(f"({k}, {a}, {b})" for k, (a, b) in enumerate(pairs))
    return [
        *shingle_ctes(source),
        f"coef AS (SELECT * FROM (VALUES {values}) t(k, a, b))",
        f"""sig AS (SELECT doc_id, k, list_min(list_transform(hs,
              lambda h: (a::bigint * h + b) % {minhash.PRIME})) AS v
            FROM shingled CROSS JOIN coef WHERE len(hs) > 0)""",
    ]


def edge_ctes(source: str, anchors: int = 1) -> list[str]:
    """CTEs ``bands(doc_id, band, bucket)`` and ``edges(src, dst)``."""
    rows = c.FUZZY.hashes_per_bucket
    return [
        *minhash_ctes(source),
        f"""bands AS (SELECT doc_id, (k // {rows})::bigint AS band,
                             md5(string_agg(v::varchar, ',' ORDER BY k)) AS bucket
                      FROM sig GROUP BY doc_id, k // {rows})""",
        f"""anchors AS (SELECT * FROM bands QUALIFY
              row_number() OVER (PARTITION BY band, bucket ORDER BY doc_id) <= {anchors})""",
        """edges AS (SELECT DISTINCT a.doc_id AS src, b.doc_id AS dst
                     FROM anchors a JOIN bands b USING (band, bucket) WHERE b.doc_id > a.doc_id)""",
    ]


OVERLAP = """overlap AS (
  SELECT src, dst, shared, len_a + len_b - shared AS total FROM (
    SELECT e.src, e.dst, len(list_intersect(a.hs, b.hs)) AS shared, len(a.hs) AS len_a, len(b.hs) AS len_b
    FROM edges e JOIN shingled a ON a.doc_id = e.src JOIN shingled b ON b.doc_id = e.dst))"""
GROUPS = [
    "sym AS (SELECT src AS a, dst AS b FROM edges UNION SELECT dst, src FROM edges)",
    """reach(node, root) AS (
         SELECT a, a FROM sym UNION SELECT s.b, r.root FROM reach r JOIN sym s ON s.a = r.node)""",
    "groups AS (SELECT node AS doc_id, min(root) AS group_id FROM reach GROUP BY node)",
]

SQL["shingle_counts"] = with_(
    *shingle_ctes("documents"), select="SELECT doc_id, len(hs)::bigint AS shingles FROM shingled"
)
SQL["minhash_signature"] = with_(
    *minhash_ctes("documents"),
    select="SELECT doc_id, k::bigint AS position, v AS value FROM sig",
)
SQL["lsh_buckets"] = with_(*edge_ctes("documents"), select="SELECT doc_id, band, bucket FROM bands")
SQL["fuzzy_candidates"] = with_(*edge_ctes("documents"), select="SELECT src, dst FROM edges")
SQL["fuzzy_jaccard"] = with_(
    *edge_ctes("documents"),
    OVERLAP,
    select="SELECT src, dst, shared, total FROM overlap WHERE shared * 10 >= total * 8",
)
SQL["fuzzy_verified"] = with_(
    *edge_ctes("documents", 2),
    OVERLAP,
    select="SELECT src, dst FROM overlap WHERE shared * 10 >= total * 8",
)
SQL["fuzzy_groups"] = with_(
    *edge_ctes("documents"), *GROUPS, select="SELECT doc_id, group_id FROM groups"
)
SQL["fuzzy_dedup"] = with_(
    *edge_ctes("documents"),
    *GROUPS,
    select="""SELECT doc_id FROM documents
              WHERE doc_id NOT IN (SELECT doc_id FROM groups WHERE doc_id <> group_id)""",
)

# --- semantic duplicates ---------------------------------------------------

_ASSIGNED = [
    """vectors AS (
         SELECT vec_id, embedding, label FROM embeddings
         UNION ALL
         SELECT vec_id + 1000000, list_transform(embedding, lambda x, i:
           (x::double + ((i - 1 + vec_id) % 3 - 1)::double * 0.001::double)::float), label FROM embeddings
         UNION ALL
         SELECT vec_id + 2000000, embedding, label FROM embeddings)""",
    """centroids AS (
         SELECT label, list(x ORDER BY i) AS c FROM (
           SELECT label, i, avg(x::double) AS x FROM (
             SELECT label, unnest(embedding) AS x, generate_subscripts(embedding, 1) AS i FROM embeddings)
           GROUP BY label, i)
         GROUP BY label)""",
    """units AS (SELECT vec_id, label, embedding::double[] AS v,
                        sqrt(list_dot_product(embedding::double[], embedding::double[])) AS norm
                 FROM vectors)""",
    """assigned AS (
         SELECT u.vec_id, u.label, u.v, u.norm, n.label AS cluster,
                list_dot_product(u.v, n.c) / (u.norm * sqrt(list_dot_product(n.c, n.c))) AS sim
         FROM units u CROSS JOIN centroids n
         QUALIFY row_number() OVER (PARTITION BY u.vec_id ORDER BY sim DESC) = 1)""",
    """ranked AS (SELECT *, row_number() OVER (PARTITION BY cluster ORDER BY round(sim, 9), vec_id) AS rank
                  FROM assigned)""",
    """nearest AS (
         SELECT a.vec_id, max(list_dot_product(a.v, b.v) / (a.norm * b.norm)) AS max_sim
         FROM ranked a JOIN ranked b ON a.cluster = b.cluster AND b.rank < a.rank GROUP BY a.vec_id)""",
]
SQL["semantic_assign"] = with_(
    *_ASSIGNED,
    select="""SELECT vec_id, cluster::bigint AS cluster,
                     round(sim * 1000000)::bigint AS sim_millionths FROM assigned""",
)
SQL["semantic_rank"] = with_(
    *_ASSIGNED, select="SELECT cluster::bigint AS cluster, vec_id, rank FROM ranked"
)
SQL["semantic_pairs"] = with_(
    *_ASSIGNED,
    select=f"""SELECT vec_id, round(max_sim * 1000000)::bigint AS sim_millionths
               FROM nearest WHERE max_sim > {c.COSINE_FLOOR}""",
)
SQL["semantic_duplicates"] = with_(
    *_ASSIGNED, select="SELECT vec_id FROM nearest WHERE max_sim > 1 - 0.01"
)
SQL["semantic_dedup"] = with_(
    *_ASSIGNED,
    select="""SELECT vec_id, label::bigint AS label FROM vectors
              WHERE vec_id NOT IN (SELECT vec_id FROM nearest WHERE max_sim > 1 - 0.01)""",
)
SQL["semantic_clusters"] = """
SELECT vec_id, true AS at_nearest, true AS centroid_is_mean, true AS few_clusters FROM embeddings"""
SQL["text_embed"] = f"""
WITH worded AS (SELECT doc_id, {words('text')} AS w FROM documents)
SELECT doc_id, axis, round((count(*) / any_value(n))::float::double * 1000000)::bigint AS millionths
FROM (SELECT doc_id, len(w) AS n, {bucket('token', c.EMBED_DIM)} AS axis
      FROM (SELECT doc_id, w, unnest(w) AS token FROM worded))
GROUP BY doc_id, axis"""

# --- instruction pairs -----------------------------------------------------

_EDGE = "'^[\\s\\x{A0}\\x{3000}]+|[\\s\\x{A0}\\x{3000}]+$'"


def strip(expression: str) -> str:
    return f"regexp_replace({expression}, {_EDGE}, '', 'g')"


_CONTEXT = "'\n　 ' || text || ' \t'"
_QUESTION = "' ' || source || ' \n'"
_ANSWER = "'  ' || regexp_extract(text, '^([^.]*\\.)', 1)"
SQL["qa_to_sft"] = f"""
SELECT {strip(_CONTEXT)} || '\n\n' || {strip(_QUESTION)} AS input, {strip(_ANSWER)} AS output
FROM documents"""

_PAIRS = """pairs AS (
  SELECT u.conv_id, u.turn, u.text AS input, a.text AS output
  FROM conversations u JOIN conversations a ON a.conv_id = u.conv_id AND a.turn = u.turn + 1
  WHERE u.role = 'user' AND a.role = 'assistant')"""
SQL["sft_messages"] = with_(
    _PAIRS,
    select="""SELECT conv_id, turn, 0::bigint AS position, 'user' AS role, input AS content FROM pairs
              UNION ALL SELECT conv_id, turn, 1::bigint, 'assistant', output FROM pairs""",
)
_HEAD, _REST = PROMPT_TEMPLATE.split("{input}")
_MIDDLE, _TAIL = _REST.split("{output}")
SQL["prompt_render"] = with_(
    _PAIRS,
    select=f"""SELECT conv_id, turn, {quoted(_HEAD)} || input || {quoted(_MIDDLE)} || output
                      || {quoted(_TAIL)} AS prompt FROM pairs""",
)
_REWARDS = ", ".join(
    f"((length(output) + length(input) + length(output) * {i}) % 5 + 1)::double AS {metric}"
    for i, metric in enumerate(METRICS)
)
_SCORED = [
    _PAIRS,
    f"rewarded AS (SELECT *, {_REWARDS} FROM pairs)",
    "scored AS (SELECT *, (helpfulness + correctness + coherence) / 3 AS overall FROM rewarded)",
]
SQL["sft_score"] = with_(
    *_SCORED, select=f"SELECT conv_id, turn, {', '.join(METRICS)}, overall FROM scored"
)
SQL["sft_filter"] = with_(
    *_SCORED, select="SELECT conv_id, turn, input, output FROM scored WHERE overall > 3.5"
)
_BEFORE, _AFTER, _END = map(quoted, TURN_PARTS)
SQL["conversation_render"] = f"""
SELECT conv_id, {quoted(CHAT_START)} || string_agg(
         {_BEFORE} || role || {_AFTER} || text || {_END}, '' ORDER BY turn) AS conversation
FROM conversations GROUP BY conv_id"""

# --- training corpus -------------------------------------------------------

_WORDED = f"worded AS (SELECT doc_id, source, {words('text')} AS w FROM documents)"
_VOCAB = [
    _WORDED,
    f"""vocab AS (
          SELECT token, count, (row_number() OVER (ORDER BY count DESC, token) + 1)::bigint AS token_id
          FROM (SELECT token, count(*) AS count FROM (SELECT unnest(w) AS token FROM worded) GROUP BY token)
          QUALIFY token_id <= {c.VOCAB_SIZE + 1})""",
    """stream AS (
         SELECT doc_id, source, pos, coalesce(token_id, 1) AS token_id
         FROM (SELECT doc_id, source, unnest(w) AS token, generate_subscripts(w, 1) AS pos FROM worded)
         LEFT JOIN vocab USING (token)
         UNION ALL SELECT doc_id, source, len(w) + 1, 0 FROM worded)""",
]
SQL["build_vocab"] = with_(*_VOCAB[:2], select="SELECT token, count, token_id FROM vocab")
SQL["tokenize_eod"] = SQL["tokenize_vocab_join"] = with_(
    *_VOCAB,
    select="""SELECT doc_id, string_agg(token_id::varchar, ' ' ORDER BY pos) AS token_ids,
                     count(*) AS n_tokens FROM stream GROUP BY doc_id""",
)
_SIZED = f"sized AS (SELECT doc_id, source, (len({words('text')}) + 1)::bigint AS n_tokens FROM documents)"
_WINDOWS = """windows AS (
  SELECT source, doc_id, n_tokens,
         (sum(n_tokens) OVER (PARTITION BY source ORDER BY doc_id) - n_tokens)::bigint AS start FROM sized)"""
SQL["sequence_windows"] = with_(
    _SIZED,
    _WINDOWS,
    select=f"""SELECT source, doc_id, n_tokens, start, start // {c.SEQ_LENGTH} AS first_sample,
                      (start + n_tokens - 1) // {c.SEQ_LENGTH} AS last_sample FROM windows""",
)
SQL["sequence_samples"] = with_(
    *_VOCAB,
    _SIZED,
    _WINDOWS,
    select=f"""SELECT source, sample, count(*) AS n_tokens,
                      sum(token_id * (spot % {c.SEQ_LENGTH} + 1))::bigint AS weighted_sum
               FROM (SELECT s.source, token_id, start + pos - 1 AS spot, spot // {c.SEQ_LENGTH} AS sample
                     FROM stream s JOIN windows w USING (doc_id))
               GROUP BY source, sample""",
)
_PER_STEP = 2 * c.SEQ_LENGTH * c.GLOBAL_BATCH
_STEPS = f"""steps AS (SELECT source, (sum(n_tokens) * 2)::bigint AS bytes,
  ceil(sum(n_tokens) * 2 / {_PER_STEP})::bigint AS steps FROM sized GROUP BY source)"""
SQL["epoch_steps"] = with_(_SIZED, _STEPS, select="SELECT source, bytes, steps FROM steps")
SQL["epoch_steps_total"] = with_(
    _SIZED, _STEPS, select="SELECT count(*) AS files, sum(steps)::bigint AS steps FROM steps"
)
SQL["split_by_weight"] = f"""
SELECT o_orderkey, CASE WHEN b < 998 THEN 'train' WHEN b < 999 THEN 'validation' ELSE 'test' END AS split
FROM (SELECT o_orderkey, {bucket('o_orderkey', 1000)} AS b FROM orders)"""
SQL["pack_by_offset"] = with_(
    _PAIRS,
    f"""examples AS (SELECT conv_id, turn,
          (len({words('input')}) + len({words('output')}) + 1)::bigint AS n_tokens FROM pairs)""",
    select=f"""SELECT conv_id, turn, n_tokens,
                      ((sum(n_tokens) OVER (ORDER BY conv_id, turn) - n_tokens) // {c.PACK_LENGTH})::bigint AS bin
               FROM examples""",
)
SQL["pack_ffd"] = with_(
    _PAIRS,
    f"""examples AS (SELECT conv_id || '-' || turn AS id,
          (7 * (len({words('input')}) + len({words('output')}) + 1))::bigint AS n_tokens FROM pairs)""",
    select=f"""SELECT id, n_tokens, greatest(1, (n_tokens + {c.PACK_LENGTH - 1}) // {c.PACK_LENGTH})::bigint AS n_parts,
                      true AS in_one_run, true AS within_capacity, true AS first_fit FROM examples""",
)
SQL["sft_packed"] = with_(
    _PAIRS,
    *_VOCAB[:2],
    f"""parts AS (SELECT conv_id || '-' || turn AS id, conv_id % 2 AS half,
          {words(f"{quoted(_HEAD)} || input || {quoted(_MIDDLE)}")} AS given, {words(f"output || {quoted(_TAIL)}")} AS answer FROM pairs)""",
    """said AS (SELECT id, half, unnest(given || answer) AS token, generate_subscripts(given || answer, 1) AS pos FROM parts)""",
    """summed AS (SELECT id, sum(pos * coalesce(token_id, 1)) AS w FROM said LEFT JOIN vocab USING (token) GROUP BY id)""",
    select="""SELECT half, id, len(given) + len(answer) + 1 AS n_tokens, len(answer) + 1 AS n_loss, w::bigint AS weighted_sum,
                     true AS within_capacity FROM parts JOIN summed USING (id)""",
)
_WEIGHTS = ", ".join(f"({quoted(s)}, {w}::double)" for s, w in c.BLEND.items())
SQL["blend_sources"] = with_(
    f"""rates AS (SELECT source, per_row / max(per_row) OVER () AS rate FROM (
          SELECT source, any_value(weight) / count(*) AS per_row
          FROM documents JOIN (VALUES {_WEIGHTS}) w(source, weight) USING (source) GROUP BY source))""",
    select=f"""SELECT doc_id, source FROM documents JOIN rates USING (source)
               WHERE ('0x' || substr(md5(doc_id::VARCHAR), 1, 13))::BIGINT::DOUBLE / 4503599627370496.0::DOUBLE < rate""",
)
SQL["sample_preview"] = f"""
SELECT doc_id FROM documents WHERE {bucket('doc_id', 1_000_000)} < {round(c.PREVIEW * 1_000_000)}"""

# --- files in, files out ----------------------------------------------------

SQL["jsonl_round_trip"] = f"""
SELECT doc_id, text || ' — "read"\n\\' AS text, len({words('text')}) + 3 AS word_count, lang, n_chars, 2::bigint AS n_sizes,
       (SELECT count(*) FROM documents WHERE doc_id % 10 = 0) AS rejected_lines
FROM documents"""
SQL["multi_scan"] = "SELECT doc_id, text, lang FROM documents WHERE lang IN ('de', 'fr')"
SQL["split_scan"] = with_(
    _PAIRS,
    select=f"""SELECT conv_id, turn, input, output, CASE WHEN b < 8 THEN 'train' WHEN b < 9 THEN 'validation' ELSE 'test' END AS split
               FROM (SELECT *, {bucket('conv_id', 10)} AS b FROM pairs)""",
)
SQL["dump_scan"] = """
SELECT doc_id, 'Page No. ' || doc_id AS title, 'https://xx.wikipedia.org/wiki/Page_No._' || doc_id AS url, 'xx' AS language, text
FROM documents WHERE doc_id % 10 > 1"""
SQL["batch_modify"] = "SELECT doc_id, replace(text, 'e', '3') AS text FROM documents"
SQL["sft_dual_sink"] = with_(
    *_SCORED,
    select="""SELECT *, (SELECT count(*) FROM pairs WHERE conv_id % 7 = 0) AS rejected_lines FROM (
                SELECT 'sft_data_score' AS sink, conv_id, turn, input, output, overall FROM scored
                UNION ALL SELECT 'filtered_data', conv_id, turn, input, output, NULL FROM scored WHERE overall > 3.5)""",
)

# --- whole runs ------------------------------------------------------------

_CURATED = [
    *heuristic("documents"),
    "replaced AS (" + pii_replaced("documents WHERE doc_id IN (SELECT doc_id FROM heuristic)") + ")",
    """deduped AS (SELECT * FROM replaced
                   WHERE doc_id IN (SELECT min(doc_id) FROM replaced GROUP BY md5(text)))""",
    *edge_ctes("deduped"),
    *GROUPS,
    """curated AS (SELECT doc_id, text, word_count FROM deduped JOIN heuristic USING (doc_id)
                   WHERE doc_id NOT IN (SELECT doc_id FROM groups WHERE doc_id <> group_id))""",
]
SQL["curated_corpus"] = with_(*_CURATED, select="SELECT doc_id, text, word_count FROM curated")
SQL["curation_funnel"] = with_(
    *_CURATED,
    select=" UNION ALL ".join(
        f"SELECT {quoted(stage)} AS stage, {i}::bigint AS position, count(*) AS documents FROM {relation}"
        for i, (stage, relation) in enumerate(
            [
                ("input", "documents"),
                ("cleaning", "documents"),
                ("heuristic", "heuristic"),
                ("pii", "replaced"),
                ("exact_duplicates", "deduped"),
                ("fuzzy_dedup", "curated"),
            ]
        )
    ),
)
_FULL = [
    *_IDENTIFIED,
    "english AS (SELECT doc_id, text, source FROM documents JOIN identified USING (doc_id) WHERE language = 'EN')",
    *heuristic("english"),
    "replaced AS (" + pii_replaced("english WHERE doc_id IN (SELECT doc_id FROM heuristic)") + ")",
    *_CURATED[len(heuristic("documents")) + 1 :],
    f"""axes AS (SELECT doc_id, len(w) AS n, {bucket('token', c.EMBED_DIM)} AS axis
                  FROM (SELECT doc_id, w, unnest(w) AS token FROM (SELECT doc_id, {words('text')} AS w FROM curated)))""",
    """means AS (SELECT doc_id, axis, (count(*) / any_value(n))::float::double AS x FROM axes GROUP BY doc_id, axis)""",
    "norms AS (SELECT doc_id, sqrt(sum(x * x)) AS norm FROM means GROUP BY doc_id)",
    "centre AS (SELECT axis, sum(x) AS c FROM means GROUP BY axis)",
    """placed AS (SELECT doc_id, row_number() OVER (ORDER BY round(sim, 9), doc_id) AS rank FROM (
                  SELECT doc_id, sum(x * c) / any_value(norm) / (SELECT sqrt(sum(c * c)) FROM centre) AS sim
                  FROM means JOIN centre USING (axis) JOIN norms USING (doc_id) GROUP BY doc_id))""",
    """alike AS (SELECT b.doc_id FROM means a JOIN means b USING (axis)
                 JOIN placed p ON p.doc_id = a.doc_id JOIN placed q ON q.doc_id = b.doc_id
                 JOIN norms m ON m.doc_id = a.doc_id JOIN norms n ON n.doc_id = b.doc_id
                 WHERE p.rank < q.rank GROUP BY a.doc_id, b.doc_id
                 HAVING sum(a.x * b.x) / any_value(m.norm) / any_value(n.norm) > 0.99)""",
]
SQL["curated_full"] = with_(
    *_FULL,
    select="""SELECT doc_id, text, word_count, 'EN' AS language FROM curated
              WHERE doc_id NOT IN (SELECT doc_id FROM alike)""",
)
SQL["language_curated"] = f"""
SELECT lang, count(*) AS documents FROM documents
WHERE doc_id IN (SELECT min(doc_id) FROM documents WHERE len({words('text')}) >= 50 GROUP BY md5(text))
GROUP BY lang"""
