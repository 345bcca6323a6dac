"""The numbered queries: each operator over the whole of its table, and their SQL."""

from pyspark.sql import functions as F

from tractscope.llm import (
    class_lm,
    feistel_shards,
    html_extract,
    jaccard_join,
    language_id,
    merkle_manifest,
    phrase_mining,
    piece_encode,
    quality_gam,
    quality_rules,
    source_mix,
    topk_search,
    url_filter,
)
from tractscope.llm.folds import held_out
from tractscope.llm.tables import seeded_hash_sql
from tractscope.session import write_once

QUERIES = {}
ORACLE = {}


def query(function):
    QUERIES[function.__name__] = function
    return function


def table(spark, sf_dir, name):
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


URL_RULES = {
    "net/": "block",
    "example.net/en/": "allow",
    "example.com/de/": "block",
    "org/fr/": "allow",
}


@query
def op1_url_filter(spark, sf_dir):
    """Verdict on the url of every page: the longest rule, else the model."""
    rows = url_filter.example_urls()
    labelled = spark.createDataFrame(rows, "url string, blocked int")
    model = url_filter.train(labelled)
    pages = table(spark, sf_dir, "pages")
    return url_filter.judge(pages, model, URL_RULES, keep=("page_id",))


@query
def op2_topk_search(spark, sf_dir):
    """The 5 best rows for every 50th vector, against all others."""
    vectors = table(spark, sf_dir, "embeddings")
    return topk_search.search(vectors, vectors.where(F.col("vec_id") % 50 == 0), 5)


ORACLE["op2_topk_search"] = """
WITH sound AS (
    SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS w
    FROM embeddings
    WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
      AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
),
terms AS (SELECT vec_id, unnest(w) AS w, generate_subscripts(w, 1) AS t FROM sound),
scored AS (
    SELECT q.vec_id AS query_id, d.vec_id, sum(q.w * d.w)::BIGINT AS score
    FROM terms q JOIN terms d ON q.t = d.t AND q.vec_id <> d.vec_id
    WHERE q.vec_id % 50 = 0 GROUP BY ALL
),
ranked AS (
    SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INT AS rank
    FROM scored
)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 5
"""


@query
def op3_html_extract(spark, sf_dir):
    """Main text of every page."""
    return html_extract.extract_text(table(spark, sf_dir, "pages"))


@query
def op4_source_mix(spark, sf_dir):
    """Words that a mix of all documents takes, sources weighing 1, 2, 3 in turn."""
    docs = table(spark, sf_dir, "documents")
    sized = docs.select("doc_id", "source", source_mix.word_count(F.col("text")).alias("size"))
    return source_mix.mix(sized).select(
        "doc_id",
        "size",
        "source_size",
        "target",
        (F.col("size") * F.col("repeats")).alias("taken"),
        "source",
    )


ORACLE["op4_source_mix"] = rf"""
WITH docs AS (
    SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '{source_mix.WORD}')) AS size,
           {seeded_hash_sql("doc_id", 0)} AS place
    FROM documents
),
sources AS (
    SELECT source, sum(size)::BIGINT AS source_size,
           (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1.0::DOUBLE AS weight
    FROM docs GROUP BY source
),
-- The source that is clamped first has the least room for its weight.
filling AS (
    SELECT *, source_size * 3.0::DOUBLE AS cap,
           sum(source_size) OVER ()::DOUBLE AS total,
           coalesce(sum(source_size * 3.0::DOUBLE) OVER before, 0) AS full_before,
           sum(weight) OVER rest AS open_weight
    FROM sources
    WINDOW before AS (ORDER BY source_size * 3 / weight, source
                      ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING),
           rest AS (ORDER BY source_size * 3 / weight, source
                    ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)
),
share AS (
    SELECT arg_min((total - full_before) / open_weight, cap / weight) AS share FROM filling
    WHERE cap > weight * ((total - full_before) / open_weight)
),
targets AS (
    SELECT source, source_size,
           coalesce(least(cap, weight * (SELECT share FROM share)), cap) AS target FROM filling
),
plan AS (
    SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size) ELSE 0 END AS whole
    FROM targets
),
placed AS (
    SELECT d.*, p.source_size, p.target, p.whole, p.target - p.whole * p.source_size AS open,
           sum(d.size) OVER (PARTITION BY d.source ORDER BY d.place, d.doc_id, d.size) AS upto
    FROM docs d JOIN plan p ON d.source IS NOT DISTINCT FROM p.source
),
rests AS (
    SELECT *, upto <= open AND size > 0 AS extra,
           open - coalesce(sum(size) FILTER (upto <= open) OVER (PARTITION BY source), 0) AS rest
    FROM placed
),
ranked AS (
    SELECT *, row_number() OVER (
        PARTITION BY source, NOT extra AND size > 0 AND abs(size - rest) < rest
        ORDER BY abs(size - rest), place, doc_id) AS nth
    FROM rests
)
SELECT doc_id, size, source_size, target, source,
       (size * (whole + CASE WHEN extra THEN 1
                             WHEN size > 0 AND abs(size - rest) < rest AND nth = 1 THEN 1
                             ELSE 0 END))::BIGINT AS taken
FROM ranked
"""


@query
def op5_feistel_shards(spark, sf_dir):
    """All documents shuffled into eight shards whose counts differ by one at most."""
    text = F.coalesce(F.col("text"), F.lit(""))
    slim = table(spark, sf_dir, "documents").select(
        "doc_id",
        (F.octet_length(text) + 1).cast("long").alias("size"),
        F.crc32(F.encode(text, "UTF-8")).alias("text_crc32"),
    )
    slim = write_once(slim, "shard-sizes")
    return feistel_shards.assign_shards(slim, ["doc_id", "text_crc32", "size"]).select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("rows").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
        "row_number",
    )


@query
def op6_language_id(spark, sf_dir):
    """Language of every document, learnt from the documents that are not held out."""
    docs = table(spark, sf_dir, "documents")
    found = language_id.identify(docs, language_id.train(docs))
    return found.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")


@query
def op7_quality_gam(spark, sf_dir):
    """Quality of every document, learnt from the labels that are not held out."""
    docs = table(spark, sf_dir, "documents")
    model = quality_gam.train(docs, table(spark, sf_dir, "labels"))
    scored = quality_gam.classify(docs, model)
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", "predicted")


@query
def op8_jaccard_join(spark, sf_dir):
    """Components of documents linked by the Jaccard similarity of their shingles."""
    return jaccard_join.link_components(table(spark, sf_dir, "documents"))


@query
def op9_piece_round_trip(spark, sf_dir):
    """Every document encoded and decoded with the 32k piece vocabulary."""
    return piece_encode.round_trip(table(spark, sf_dir, "documents"))


@query
def op10_quality_rules(spark, sf_dir):
    """Measurements, failure bits and verdict of every document."""
    rows = quality_rules.ledger(table(spark, sf_dir, "documents"))
    base = quality_rules.passes(quality_rules.BASE_POLICY)
    return rows.select(
        "doc_id",
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        (~base).alias("base_failed"),
        (base & quality_rules.passes(quality_rules.POLICY)).alias("kept"),
        "failed_rules",
        "n_lines",
        "n_upper",
        "n_lower",
        "n_exclaims",
    )


def _rules_sql():
    bits = [f"CASE WHEN {r.fails} THEN {1 << r.bit} ELSE 0 END" for r in quality_rules.RULES]
    return " + ".join(bits)


_BASE = quality_rules.policy_mask(quality_rules.BASE_POLICY)
_ALL = _BASE | quality_rules.policy_mask(quality_rules.POLICY)
ORACLE["op10_quality_rules"] = rf"""
WITH texts AS (
    SELECT doc_id, coalesce(text, '') AS text,
           regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words
    FROM documents
),
windows AS (
    SELECT doc_id, k, count(*) OVER (PARTITION BY doc_id, words[k : k + 4]) AS found
    FROM (SELECT doc_id, words, unnest(range(1, len(words) - 3)) AS k FROM texts)
),
covered AS (
    SELECT doc_id, count(DISTINCT word) AS n
    FROM (SELECT doc_id, unnest(range(k, k + 5)) AS word FROM windows WHERE found > 1)
    GROUP BY doc_id
),
lines AS (
    SELECT doc_id, count(*) AS n, count(*) - count(DISTINCT line) AS duplicates
    FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM texts)
    WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY doc_id
),
measures AS (
    SELECT t.doc_id, len(words) AS n_words,
           length(array_to_string(words, '')) AS word_chars,
           length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) AS n_symbols,
           coalesce(l.n, 0) AS n_lines, coalesce(l.duplicates, 0) AS n_dup_lines,
           coalesce(c.n, 0) AS n_repeat_words,
           length(regexp_replace(text, '[^A-Z]', '', 'g')) AS n_upper,
           length(regexp_replace(text, '[^a-z]', '', 'g')) AS n_lower,
           length(regexp_replace(text, '[^!]', '', 'g')) AS n_exclaims
    FROM texts t LEFT JOIN lines l USING (doc_id) LEFT JOIN covered c USING (doc_id)
),
judged AS (SELECT *, ({_rules_sql()})::BIGINT AS failed_rules FROM measures)
SELECT *, failed_rules & {_BASE} <> 0 AS base_failed, failed_rules & {_ALL} = 0 AS kept
FROM judged
"""

# The closure by repeated minima: each step gives a document the smallest id among its links.
ORACLE["op8_jaccard_join"] = r"""
WITH RECURSIVE texts AS (
    SELECT doc_id, regexp_extract_all(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x20\x09-\x0D]+') AS words
    FROM documents
),
shingles AS (
    SELECT DISTINCT doc_id, words[k : k + 4] AS shingle
    FROM (SELECT doc_id, words, unnest(range(1, greatest(len(words) - 3, 2))) AS k
          FROM texts WHERE len(words) > 0)
),
sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
links AS (
    SELECT a.doc_id AS a, b.doc_id AS b
    FROM shingles a JOIN shingles b ON a.shingle = b.shingle AND a.doc_id <> b.doc_id
    JOIN sizes x ON x.doc_id = a.doc_id JOIN sizes y ON y.doc_id = b.doc_id
    GROUP BY a.doc_id, b.doc_id, x.n, y.n HAVING 100 * count(*) >= 75 * (x.n + y.n - count(*))
),
reached(doc_id, other) AS (
    SELECT doc_id, doc_id FROM documents
    UNION
    SELECT r.doc_id, l.b FROM reached r JOIN links l ON l.a = r.other
)
SELECT r.doc_id, coalesce(any_value(s.n), 0) AS n_shingles, min(other) AS component_id
FROM reached r LEFT JOIN sizes s ON s.doc_id = r.doc_id GROUP BY r.doc_id
"""


@query
def op11_merkle_manifest(spark, sf_dir):
    """Every document's leaf, proof and folded root in a manifest of all documents."""
    return merkle_manifest.document_proofs(table(spark, sf_dir, "documents"))


# The table of crc32 follows from its polynomial; a path step is the side of a sibling and it.
ORACLE["op11_merkle_manifest"] = """
WITH RECURSIVE crc_table AS (
    SELECT list_transform(range(256), lambda i: list_reduce(range(8),
        lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, i)) AS t
),
crcs AS (
    SELECT doc_id, xor(4294967295, list_reduce(
        list_transform(string_split(doc_id::VARCHAR, ''), lambda c: ascii(c)::BIGINT),
        lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1]), 4294967295)) AS crc
    FROM (SELECT DISTINCT doc_id FROM documents), crc_table
),
fields AS (
    SELECT doc_id, lang,
           coalesce(strlen(doc_id::VARCHAR) || ':' || doc_id, '-')
           || coalesce(strlen(source) || ':' || source, '-')
           || coalesce(strlen(lang) || ':' || lang, '-') AS front,
           n_chars, coalesce(strlen(text) || ':' || text, '-') AS back
    FROM documents
),
leaves AS (
    SELECT row_number() OVER () AS id, f.doc_id, lang,
           sha256(front || coalesce(strlen(n_chars::VARCHAR) || ':' || n_chars, '-') || back) AS leaf,
           CASE WHEN crc % 7 = 0 AND n_chars IS NOT NULL THEN sha256(
               front || strlen((n_chars::HUGEINT + 1)::VARCHAR) || ':' || (n_chars::HUGEINT + 1)
               || back) END AS changed
    FROM fields f LEFT JOIN crcs USING (doc_id)
),
placed AS (
    SELECT *, coalesce('=' || lang, '-') AS tree,
           row_number() OVER (PARTITION BY lang ORDER BY doc_id, leaf) - 1 AS pos,
           count(*) OVER (PARTITION BY lang) AS n
    FROM leaves
),
nodes(tree, level, pos, h, n) AS (
    SELECT tree, 0, pos, leaf, n FROM placed
    UNION ALL
    SELECT tree, level + 1, pos // 2, sha256(string_agg(h, '' ORDER BY pos)), any_value((n + 1) // 2)
    FROM nodes WHERE n > 1 GROUP BY tree, level, pos // 2
),
subroots AS (
    SELECT tree, level AS height, h, row_number() OVER (ORDER BY tree) - 1 AS pos,
           count(*) OVER () AS n
    FROM nodes WHERE n = 1
),
tops(level, pos, h, n) AS (
    SELECT 0, pos, h, n FROM subroots
    UNION ALL
    SELECT level + 1, pos // 2, sha256(string_agg(h, '' ORDER BY pos)), any_value((n + 1) // 2)
    FROM tops WHERE n > 1 GROUP BY level, pos // 2
),
steps AS (
    SELECT p.id, n.level, (p.pos >> n.level) & 1 AS bit, s.h AS sibling
    FROM placed p JOIN nodes n ON n.tree = p.tree AND n.pos = p.pos >> n.level AND n.n > 1
    LEFT JOIN nodes s ON s.tree = n.tree AND s.level = n.level AND s.pos = xor(n.pos, 1)
    UNION ALL
    SELECT p.id, r.height + t.level, (r.pos >> t.level) & 1, s.h
    FROM placed p JOIN subroots r ON r.tree = p.tree
    JOIN tops t ON t.pos = r.pos >> t.level AND t.n > 1
    LEFT JOIN tops s ON s.level = t.level AND s.pos = xor(t.pos, 1)
),
paths AS (
    SELECT id, list(coalesce(bit || sibling, '-') ORDER BY level) AS path,
           sha256(string_agg(coalesce(sibling, ''), '' ORDER BY level)) AS proof
    FROM steps GROUP BY id
),
folded AS (
    SELECT p.doc_id, p.leaf, r.h AS subroot, (SELECT h FROM tops WHERE n = 1) AS root,
           coalesce(proof, sha256('')) AS proof_sha256,
           list_reduce(coalesce(path, []), lambda node, step: CASE step[1]
               WHEN '0' THEN sha256(node || step[2:]) WHEN '1' THEN sha256(step[2:] || node)
               ELSE sha256(node) END, coalesce(changed, leaf)) AS folded_root
    FROM placed p JOIN subroots r ON r.tree = p.tree LEFT JOIN paths USING (id)
)
SELECT *, folded_root = root AS verified FROM folded
"""


@query
def op12_phrase_collocations(spark, sf_dir):
    """The best collocations of each language, of all documents."""
    return phrase_mining.mine(table(spark, sf_dir, "documents"))


ORACLE["op12_phrase_collocations"] = r"""
WITH pieces AS (
    SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex(translate(coalesce(text, ''),
        'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece
    FROM documents
),
words AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM pieces),
grams AS (
    SELECT lang, m, array_to_string(w[k : k + m - 1], ' ') AS phrase
    FROM (SELECT lang, w, m, unnest(range(1, len(w) - m + 2)) AS k
          FROM words, (SELECT unnest(range(1, 6)) AS m))
),
counts AS (SELECT lang, m, phrase, count(*) AS f FROM grams GROUP BY ALL HAVING f >= 100),
totals AS (SELECT lang, count(*) AS n FROM grams WHERE m = 1 GROUP BY lang),
candidates AS (
    SELECT lang, m, phrase, f AS a, string_split(phrase, ' ') AS w FROM counts WHERE m > 1
),
cuts AS (
    SELECT c.lang, c.phrase, c.a, k, x.f AS l, y.f AS r, n,
           ((1000::HUGEINT * c.a * n) // (x.f::HUGEINT * y.f))::BIGINT AS score
    FROM (SELECT *, unnest(range(1, m)) AS k FROM candidates) c
    JOIN totals USING (lang)
    JOIN counts x ON x.lang = c.lang AND x.phrase = array_to_string(c.w[: k], ' ')
    JOIN counts y ON y.lang = c.lang AND y.phrase = array_to_string(c.w[k + 1 :], ' ')
),
weakest AS (
    SELECT *, row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) AS nth FROM cuts
),
kept AS (
    SELECT * FROM weakest s WHERE nth = 1 AND NOT EXISTS (
        FROM candidates c WHERE c.lang = s.lang AND c.a >= s.a AND c.phrase <> s.phrase
        AND contains(' ' || c.phrase || ' ', ' ' || s.phrase || ' '))
)
SELECT lang, rank, phrase, a, l, r, n, score FROM (
    SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank
    FROM kept) WHERE rank <= 2000
"""


@query
def op13_class_lm(spark, sf_dir):
    """Every document scored by a class model learnt from those that are not held out."""
    return class_lm.document_scores(table(spark, sf_dir, "documents"))
