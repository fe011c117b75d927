"""Queries of the corpus operators over whole tables, with DuckDB SQL where SQL can express them."""

from __future__ import annotations

from fractions import Fraction
from functools import cache

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cellgrid.llm import byte_bpe, exact_dedup, lattice_dedup, line_dedup, lm_score, ngram_join, packing, phrases, pii, secrets, toxicity, vector_codes, vector_tree
from cellgrid.session import read_table


@cache
def tokenizer_path(name: str) -> str:
    """Where a public vocabulary lies."""
    import public_tokenizers

    return public_tokenizers.path(name)


def _documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_table(spark, sf_dir, "documents")


@cache
def tagger() -> pii.Tagger:
    """The personal-data tagger, trained once a driver from generated labelled spans."""
    return pii.fit(pii.labelled_examples())


def op1_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.find_pii(_documents(spark, sf_dir), tagger())

    def text(spans: str):
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")

    def count(kind: str):
        return F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    return found.select("doc_id", *map(count, pii.KINDS), F.sha2(text("base"), 256).alias("base_sha256"), text("spans").alias("spans"))


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _documents(spark, sf_dir)
    return toxicity.classify(docs, toxicity.train(docs, read_table(spark, sf_dir, "labels")))


def op3_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.dedup(_documents(spark, sf_dir).select("doc_id", "text"))


def op4_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    ranks = byte_bpe.read_ranks(tokenizer_path("byte_bpe_50k.tiktoken"))
    encoded = byte_bpe.encode(_documents(spark, sf_dir), ranks)
    return byte_bpe.digests(byte_bpe.decode(encoded, ranks))


def op5_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    target = read_table(spark, sf_dir, "labels").filter("quality = 1").select("doc_id")
    return lm_score.score(_documents(spark, sf_dir), target)


def op6_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = line_dedup.dedup_lines(_documents(spark, sf_dir).select("doc_id", "text"))
    return done.select("doc_id", "n_lines", "n_dropped", F.sha2("kept_text", 256).alias("kept_sha256"))


def op7_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.digests(secrets.scan(_documents(spark, sf_dir)))


def op8_vector_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = read_table(spark, sf_dir, "embeddings")
    return vector_tree.search(vectors, vectors.filter("vec_id % 20 = 0"), k=20)


def op9_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    with open(tokenizer_path("word_bpe_49k.json"), encoding="utf-8") as f:
        return packing.pack(_documents(spark, sf_dir), f.read())


def op10_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.jaccard_components(_documents(spark, sf_dir), words=4, threshold=Fraction(85, 100))


def op11_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_codes.compress(read_table(spark, sf_dir, "embeddings"))


def op12_lattice_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lattice_dedup.near_duplicates(read_table(spark, sf_dir, "embeddings"), threshold=0.93)


def op13_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases.collocations(_documents(spark, sf_dir), least=30, top=2000)


def pii_base(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The columns of op1_pii that the base patterns alone decide."""
    return op1_pii(spark, sf_dir).drop("spans")


QUERIES = {q.__name__: q for q in (pii_base, op1_pii, op2_toxicity, op3_exact_dedup, op4_byte_bpe, op5_lm_scoring, op6_line_dedup, op7_secrets, op8_vector_tree, op9_packing, op10_ngram_join, op11_vector_codes, op12_lattice_dedup, op13_phrases)}



def _matches(kind: str, order: int, pattern: str, group: int, keep: str) -> str:
    """SELECT of one kind's matches: doc_id, kind, order, start (code points) and end, those that keep holds for; m is the
    match, v the group. The texts between the matches give the places."""
    quoted = pattern.replace("'", "''")
    return f"""SELECT doc_id, '{kind}' AS kind, {order} AS o, pos AS s, pos + length(m) AS e FROM (
        SELECT doc_id, ms[i] AS m, vs[i] AS v, CAST(list_sum(list_transform(gaps[1:i], lambda x: length(x))) + coalesce(list_sum(list_transform(ms[1:i - 1], lambda x: length(x))), 0) AS BIGINT) AS pos
        FROM (SELECT doc_id, ms, vs, gaps, unnest(range(1, len(ms) + 1)) AS i FROM (SELECT doc_id, regexp_extract_all(t, '{quoted}') AS ms, regexp_extract_all(t, '{quoted}', {group}) AS vs, string_split_regex(t, '{quoted}') AS gaps FROM texts))) WHERE {keep}"""


_TEXTS = "texts AS (SELECT doc_id, coalesce(text, '') AS t FROM documents)"
_DIGITS = "regexp_replace(m, '[^0-9]', '', 'g')"
#: Every second digit from the right counts twice, less 9 where that has two digits.
_LUHN = f"list_sum(list_transform(range(1, length({_DIGITS}) + 1), lambda k: (CAST(substr(reverse({_DIGITS}), k, 1) AS INTEGER) * (2 - k % 2) - CASE WHEN k % 2 = 0 AND CAST(substr(reverse({_DIGITS}), k, 1) AS INTEGER) > 4 THEN 9 ELSE 0 END))) % 10 = 0"
_PARTS = "len(list_filter(string_split(m, '.'), lambda p: length(ltrim(p, '0')) > 3 OR CAST('0' || right(ltrim(p, '0'), 3) AS INTEGER) > 255)) = 0"


def _listed(spans: str) -> str:
    return f"coalesce(string_agg(kind || ':' || s || ':' || e, ',' ORDER BY s, o) FILTER ({spans}), '')"


def _codes_sql(rounds: int) -> str:
    """The codebooks of so many rounds, each a pair of tables: the nearest entries of all parts, and the moved entries."""

    def assigned(k: int) -> str:
        return f"""a{k} AS MATERIALIZED (SELECT vec_id, part, arg_min(entry, d * 16 + entry) AS entry, min(d) AS d FROM (
            SELECT parts.vec_id, parts.part, c.entry, list_sum(list_transform(list_zip(parts.x, c.x), lambda z: (z[1] - z[2]) * (z[1] - z[2]))) AS d FROM parts JOIN c{k} c USING (part)) GROUP BY ALL)"""

    steps = []
    for k in range(rounds):
        steps.append(assigned(k))
        steps.append(f"""c{k + 1} AS MATERIALIZED (SELECT c.part, c.entry, coalesce(m.x, c.x) AS x FROM c{k} c LEFT JOIN (
            SELECT part, entry, list(v ORDER BY j) AS x FROM (SELECT a.part, a.entry, j, CAST(floor(sum(x[j]) / count(*)) AS BIGINT) AS v
            FROM (SELECT part, entry, x, unnest(range(1, len(x) + 1)) AS j FROM a{k} JOIN parts USING (vec_id, part)) a GROUP BY ALL) GROUP BY ALL) m USING (part, entry))""")
    steps.append(assigned(rounds))
    return f"""WITH kept AS MATERIALIZED (SELECT vec_id, label, list_transform(embedding, lambda v: CAST(floor(4096 * CAST(v AS DOUBLE)) AS BIGINT)) AS x FROM embeddings WHERE embedding IS NOT NULL AND NOT list_bool_or(list_transform(embedding, lambda v: v IS NULL OR NOT isfinite(v)))),
        parts AS MATERIALIZED (SELECT vec_id, p AS part, x[p * (len(x) // 8) + 1:(p + 1) * (len(x) // 8)] AS x FROM (SELECT vec_id, x, unnest(range(0, 8)) AS p FROM kept)),
        c0 AS MATERIALIZED (SELECT part, row_number() OVER (PARTITION BY part ORDER BY vec_id) - 1 AS entry, x FROM parts WHERE vec_id IN (SELECT vec_id FROM kept ORDER BY vec_id LIMIT 16)), {", ".join(steps)},
        codes AS (SELECT vec_id, string_agg(printf('%02x', entry), '' ORDER BY part) AS code, CAST(sum(d) AS BIGINT) AS error FROM a{rounds} GROUP BY vec_id)
        SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error,
        (SELECT sha256(string_agg(array_to_string(x, ','), ',' ORDER BY part, entry)) FROM c{rounds}) AS codebooks_sha256 FROM codes JOIN kept USING (vec_id)"""


ORACLE_SQL = {
    "op11_vector_codes": _codes_sql(vector_codes.ROUNDS),
    "op13_phrases": r"""
        WITH pieces AS (SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece FROM documents),
        cut AS MATERIALIZED (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM pieces),
        grams AS (SELECT lang, g.k AS k, w, unnest(range(1, len(w) - g.k + 2)) AS i FROM cut, (SELECT unnest([1, 2, 3, 4]) AS k) g WHERE len(w) >= g.k),
        f AS MATERIALIZED (SELECT lang, w[i:i + k - 1] AS p, k, count(*) AS f FROM grams GROUP BY ALL),
        n AS (SELECT lang, sum(f) AS n FROM f WHERE k = 1 GROUP BY lang),
        c AS MATERIALIZED (SELECT lang, p, k, f AS a FROM f WHERE k > 1 AND f >= 30),
        cuts AS (SELECT c.lang, c.p, c.a, j, l.f AS l, r.f AS r, CAST(2000000 * CAST(a AS HUGEINT) // (l.f + r.f) AS BIGINT) AS score FROM (SELECT *, unnest(range(1, k)) AS j FROM c) c
        JOIN f l ON l.lang = c.lang AND l.p = c.p[1:j] JOIN f r ON r.lang = c.lang AND r.p = c.p[j + 1:]),
        best AS (SELECT lang, p, a, l, r, score FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, p ORDER BY score, j) = 1),
        longer AS (SELECT lang, p[i:i + m - 1] AS p, max(a) AS longer FROM (SELECT *, unnest(range(1, k - m + 2)) AS i FROM (SELECT *, unnest(range(2, k)) AS m FROM c)) GROUP BY ALL)
        SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, array_to_string(p, ' ')) AS rank, array_to_string(p, ' ') AS phrase, a, l, r, CAST(n AS BIGINT) AS n, score
        FROM best LEFT JOIN longer USING (lang, p) JOIN n USING (lang) WHERE longer IS NULL OR 100 * longer < 80 * a QUALIFY rank <= 2000""",
    "op12_lattice_dedup": """
        WITH RECURSIVE v AS MATERIALIZED (SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS x FROM embeddings WHERE label IS NOT NULL AND embedding IS NOT NULL
        AND NOT list_bool_or(list_transform(embedding, lambda v: v IS NULL OR NOT isfinite(v))) AND list_bool_or(list_transform(embedding, lambda v: v <> 0))),
        l AS MATERIALIZED (SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.label = b.label AND a.vec_id <> b.vec_id WHERE list_cosine_similarity(a.x, b.x) >= 0.93),
        reach(a, b) AS (SELECT vec_id, vec_id FROM embeddings UNION SELECT reach.a, l.b FROM reach JOIN l ON reach.b = l.a),
        n AS (SELECT a, count(*) AS n FROM l GROUP BY a)
        SELECT vec_id, coalesce(max(n), 0) AS n_links, min(b) AS component_id, vec_id = min(b) AS kept FROM embeddings JOIN reach ON reach.a = vec_id LEFT JOIN n ON n.a = vec_id GROUP BY vec_id""",
    "pii_base": f"""WITH {_TEXTS}, found AS (
        {_matches("email", 0, "[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+([.][A-Za-z0-9-]+)+", 0, "true")} UNION ALL {_matches("ip", 1, "[0-9]+([.][0-9]+)([.][0-9]+)([.][0-9]+)", 0, _PARTS)} UNION ALL
        {_matches("card", 2, "[0-9]([ -]?[0-9])+", 0, f"length({_DIGITS}) BETWEEN 14 AND 19 AND {_LUHN}")} UNION ALL {_matches("phone", 3, "[+][0-9][ ().0-9-]+[0-9]", 0, f"length({_DIGITS}) BETWEEN 10 AND 15")})
        SELECT doc_id, count(*) FILTER (kind = 'email') AS n_email, count(*) FILTER (kind = 'ip') AS n_ip, count(*) FILTER (kind = 'card') AS n_card, count(*) FILTER (kind = 'phone') AS n_phone,
        sha256({_listed("kind IS NOT NULL")}) AS base_sha256 FROM texts LEFT JOIN found USING (doc_id) GROUP BY doc_id""",
    "op7_secrets": f"""WITH {_TEXTS}, found AS (
        {" UNION ALL ".join(_matches(r.kind, k, r.pattern, r.group, f"length(v) >= {r.least}") for k, r in enumerate(secrets.BASE + secrets.MORE))})
        SELECT doc_id, {", ".join(f"count(*) FILTER (kind = '{r.kind}') AS n_{r.kind}" for r in secrets.BASE)},
        sha256({_listed("kind IN ('assign', 'access', 'hex')")}) AS base_sha256, {_listed("kind IS NOT NULL")} AS spans FROM texts LEFT JOIN found USING (doc_id) GROUP BY doc_id""",
    "op10_ngram_join": r"""
        WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
        g AS (SELECT DISTINCT doc_id, array_to_string(w[i:i + 3], ' ') AS gram FROM (SELECT doc_id, w, unnest(range(1, greatest(2, len(w) - 2))) AS i FROM w WHERE len(w) > 0)),
        n AS (SELECT doc_id, count(*) AS n FROM g GROUP BY doc_id),
        p AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM g a JOIN g b ON a.gram = b.gram AND a.doc_id <> b.doc_id GROUP BY ALL),
        l AS (SELECT a, b FROM p JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * c >= 85 * (x.n + y.n - c)),
        reach(a, b) AS (SELECT doc_id, doc_id FROM documents UNION SELECT reach.a, l.b FROM reach JOIN l ON reach.b = l.a)
        SELECT doc_id, coalesce(n.n, 0) AS n_shingles, min(reach.b) AS component_id FROM documents LEFT JOIN n USING (doc_id) JOIN reach ON reach.a = doc_id GROUP BY ALL""",
    "op3_exact_dedup": """
        SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
               doc_id = max(doc_id) OVER same AS kept, sha256(coalesce(text, '')) AS text_sha256
        FROM documents WINDOW same AS (PARTITION BY coalesce(text, ''))""",
    "op6_line_dedup": r"""
        WITH split AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS parts FROM documents),
        lines AS (SELECT doc_id, unnest(parts) AS line, generate_subscripts(parts, 1) AS pos FROM split),
        keyed AS (SELECT doc_id, line, pos, translate(regexp_replace(regexp_replace(line, '^[ \t-\r]+', ''), '[ \t-\r]+$', ''),
                  'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM lines),
        common AS (SELECT key, max(doc_id) AS last FROM keyed WHERE length(key) >= 40
                   GROUP BY key HAVING count(DISTINCT doc_id) >= 5),
        marked AS (SELECT doc_id, line, pos, last IS NOT NULL AND last <> doc_id AS gone
                   FROM keyed LEFT JOIN common USING (key))
        SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
               sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT gone), '')) AS kept_sha256
        FROM marked GROUP BY doc_id""",
}
