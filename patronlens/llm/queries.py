"""One query per operator of this folder, and SQL for those it can express."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from patronlens.llm import (
    bpe,
    exact_dedup,
    language_id,
    line_dedup,
    merkle,
    mixing,
    quality,
    secret_scan,
    set_join,
    token_files,
    url_filter,
    vector_graph,
    whitening,
)
from patronlens.llm.common import table


def tokenizer() -> str:
    """The vocabulary that the fixed queries name."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def op1_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document: where its ids start in the files, how many there are, and their check sum, read back from the files."""
    return token_files.read_documents(token_files.write_token_files(table(spark, sf_dir, "documents"), tokenizer()))


def op2_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document: its lines, those on five sources or more that went, and the digest of what is left."""
    out = line_dedup.drop_boilerplate(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_lines", "n_removed", F.sha2("text", 256).alias("text_sha256"))


def op3_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document: whether it was held out of the fit, its score and the class."""
    return quality.report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op4_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document: its leaf of the tree, its tokens and how often it is chosen."""
    return mixing.report(table(spark, sf_dir, "documents"))


def op5_vector_graph(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per vector: its links at a cosine of 0.9 or more, its component, and whether it stays."""
    return vector_graph.report(table(spark, sf_dir, "embeddings"))


def op6_bpe_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document: number and digest of its ids, and the digest of the text decoded from them."""
    return bpe.digests(table(spark, sf_dir, "documents"), tokenizer())


def op7_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document: the copy that stays, the size of its group, and the digest of its text."""
    return exact_dedup.exact_groups(table(spark, sf_dir, "documents"))


def op8_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document: secrets by plain patterns, and literals of sensitive names."""
    return secret_scan.report(table(spark, sf_dir, "documents"))


def op9_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per page: host, path, the rule that decides, and the verdict."""
    return url_filter.judge(table(spark, sf_dir, "pages"))


def op10_set_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document: its class of near copies, its number of links, and whether it stays."""
    return set_join.report(table(spark, sf_dir, "documents"))


def op11_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document: whether it was held out, its language, and how sure that is."""
    return language_id.report(table(spark, sf_dir, "documents"))


def op12_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document: its leaf, the roots above it, its proof, and the root that follows when some rows are changed."""
    tampered = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 7 == 0, F.lit(False))
    return merkle.report(table(spark, sf_dir, "documents"), tampered)


def op13_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per vector and component: the whitened entry, with the share of variance and the error of the fit."""
    return whitening.report(table(spark, sf_dir, "embeddings"))


QUERIES = {
    f.__name__: f
    for f in (
        op1_token_files, op2_line_dedup, op3_quality, op4_mixing, op5_vector_graph, op6_bpe_round_trip, op7_exact_dedup,
        op8_secret_scan, op9_url_filter, op10_set_join, op11_language_id, op12_merkle_manifest, op13_whitening,
    )
}

SQL = {
    "op2_line_dedup": """
        WITH lines AS (
            SELECT doc_id, source, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
                   generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS pos
            FROM documents),
        keyed AS (SELECT *, trim(line, ' ' || chr(9) || chr(13)) AS bare FROM lines),
        common AS (
            SELECT bare FROM keyed WHERE bare <> '' GROUP BY bare
            HAVING count(DISTINCT coalesce('s' || source, '')) >= 5)
        SELECT doc_id, count(*) AS n_lines, count(c.bare) AS n_removed,
               sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE c.bare IS NULL), '')) AS text_sha256
        FROM keyed LEFT JOIN common c ON keyed.bare = c.bare
        GROUP BY doc_id""",
    "op4_mixing": r"""
        WITH rows AS (
            SELECT doc_id, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
                   CASE WHEN source = 'src0' THEN 'crawl' WHEN regexp_matches(source, '^src[1-9]$') THEN 'forum'
                        ELSE 'reference' END AS domain,
                   len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS n_tokens
            FROM documents),
        leaf AS (
            SELECT domain, lang, source, sum(n_tokens)::BIGINT AS tokens, 1::BIGINT AS w, (sum(n_tokens) * 4)::BIGINT AS room
            FROM rows GROUP BY ALL),
        lan AS (
            SELECT domain, lang, sum(room)::BIGINT AS room,
                   CASE lang WHEN 'en' THEN 55 WHEN 'de' THEN 18 WHEN 'fr' THEN 16 WHEN 'es' THEN 11 ELSE 1 END AS w
            FROM leaf GROUP BY ALL),
        dom AS (
            SELECT domain, sum(room)::BIGINT AS room, (SELECT sum(tokens)::BIGINT FROM leaf) AS have,
                   CASE domain WHEN 'crawl' THEN 33 WHEN 'forum' THEN 30 ELSE 37 END AS w
            FROM lan GROUP BY ALL),
        dom1 AS (
            SELECT *, coalesce(sum(room) OVER o, 0) AS taken, sum(w) OVER () - coalesce(sum(w) OVER o, 0) AS rest
            FROM dom WINDOW o AS (ORDER BY room / w::DOUBLE, domain ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
        dom2 AS (SELECT *, room * rest <= (have - taken) * w AS is_full FROM dom1),
        dom3 AS (
            SELECT domain, CASE WHEN is_full THEN room ELSE
                   ((have - sum(CASE WHEN is_full THEN room ELSE 0 END) OVER ()) * w)
                   // sum(CASE WHEN is_full THEN 0 ELSE w END) OVER () END AS have FROM dom2),
        lan1 AS (
            SELECT *, coalesce(sum(room) OVER o, 0) AS taken,
                   sum(w) OVER (PARTITION BY domain) - coalesce(sum(w) OVER o, 0) AS rest
            FROM lan JOIN dom3 USING (domain)
            WINDOW o AS (PARTITION BY domain ORDER BY room / w::DOUBLE, lang
                         ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
        lan2 AS (SELECT *, room * rest <= (have - taken) * w AS is_full FROM lan1),
        lan3 AS (
            SELECT domain, lang, CASE WHEN is_full THEN room ELSE
                   ((have - sum(CASE WHEN is_full THEN room ELSE 0 END) OVER p) * w)
                   // sum(CASE WHEN is_full THEN 0 ELSE w END) OVER p END AS have
            FROM lan2 WINDOW p AS (PARTITION BY domain)),
        leaf1 AS (
            SELECT *, coalesce(sum(room) OVER o, 0) AS taken,
                   sum(w) OVER (PARTITION BY domain, lang) - coalesce(sum(w) OVER o, 0) AS rest
            FROM leaf JOIN lan3 USING (domain, lang)
            WINDOW o AS (PARTITION BY domain, lang ORDER BY room / w::DOUBLE, source
                         ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
        leaf2 AS (SELECT *, room * rest <= (have - taken) * w AS is_full FROM leaf1),
        leaf3 AS (
            SELECT domain, lang, source, tokens, CASE WHEN is_full THEN room ELSE
                   ((have - sum(CASE WHEN is_full THEN room ELSE 0 END) OVER p) * w)
                   // sum(CASE WHEN is_full THEN 0 ELSE w END) OVER p END AS budget
            FROM leaf2 WINDOW p AS (PARTITION BY domain, lang)),
        leaf4 AS (
            SELECT domain, lang, source, CASE WHEN tokens > 0 THEN budget // tokens ELSE 0 END AS epochs,
                   CASE WHEN tokens > 0 THEN budget % tokens ELSE 0 END AS prefix
            FROM leaf3),
        ranked AS (
            SELECT *, sum(n_tokens) OVER (
                       PARTITION BY domain, lang, source
                       ORDER BY substr(md5('17:' || epochs::BIGINT || ':' || doc_id), 1, 15), doc_id
                       ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS running
            FROM rows JOIN leaf4 USING (domain, lang, source))
        SELECT doc_id, domain, lang, source, n_tokens,
               (epochs + CASE WHEN prefix > 0 AND running <= prefix THEN 1 ELSE 0 END)::BIGINT AS copies
        FROM ranked""",
    "op5_vector_graph": """
        WITH RECURSIVE v AS (
            SELECT vec_id, CASE WHEN len(list_filter(embedding, lambda c: c IS NULL OR NOT isfinite(c))) = 0
                                 AND len(list_filter(embedding, lambda c: c <> 0)) > 0
                                THEN embedding::DOUBLE[] END AS x
            FROM embeddings),
        links AS (
            SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.vec_id <> b.vec_id AND a.x IS NOT NULL AND b.x IS NOT NULL
            WHERE list_cosine_similarity(a.x, b.x) >= 0.9),
        counts AS (SELECT a, count(*) AS n FROM links GROUP BY a),
        reach AS (
            SELECT vec_id AS node, vec_id AS found FROM v
            UNION
            SELECT r.node, l.b FROM reach r JOIN links l ON l.a = r.found),
        roots AS (SELECT node, min(found) AS root FROM reach GROUP BY node)
        SELECT vec_id, coalesce(n, 0)::BIGINT AS n_links, root AS component_id, vec_id = root AS kept,
               -- What the search is to reach: of the links of every vector that takes part, all.
               CASE WHEN x IS NOT NULL THEN 1.0::DOUBLE END AS audited_recall
        FROM v JOIN roots ON node = vec_id LEFT JOIN counts ON a = vec_id""",
    "op10_set_join": r"""
        WITH RECURSIVE split AS (
            SELECT doc_id, list_filter(string_split_regex(lower(coalesce(text, '')), '\s+'), lambda w: w <> '') AS w
            FROM documents),
        shingles AS (
            SELECT DISTINCT doc_id, hash(array_to_string(w[k:k + 4], ' ')) AS s
            FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS k FROM split WHERE len(w) > 0)),
        sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
        common AS (
            SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS n
            FROM shingles a JOIN shingles b ON a.s = b.s AND a.doc_id <> b.doc_id GROUP BY ALL),
        links AS (
            SELECT a, b FROM common c JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b
            WHERE c.n >= 0.8 * (x.n + y.n - c.n)),
        counts AS (SELECT a, count(*) AS n FROM links GROUP BY a),
        reach AS (
            SELECT doc_id AS node, doc_id AS found FROM documents
            UNION
            SELECT r.node, l.b FROM reach r JOIN links l ON l.a = r.found),
        roots AS (SELECT node, min(found) AS root FROM reach GROUP BY node)
        SELECT doc_id, root AS class_id, coalesce(n, 0)::BIGINT AS n_links, doc_id = root AS kept
        FROM documents JOIN roots ON node = doc_id LEFT JOIN counts ON a = doc_id""",
    "op7_exact_dedup": r"""
        WITH d AS (
            SELECT doc_id, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g')) AS text_sha256
            FROM documents)
        SELECT doc_id, min(doc_id) OVER (PARTITION BY text_sha256) AS keep_id,
               count(*) OVER (PARTITION BY text_sha256) AS group_size,
               row_number() OVER (PARTITION BY text_sha256 ORDER BY doc_id) = 1 AS kept, text_sha256
        FROM d""",
    "op12_merkle_manifest": r"""
        WITH RECURSIVE d AS (
            SELECT doc_id, lang, CASE WHEN lang IS NULL THEN 'n' ELSE 's' || lang END AS tree,
                   'x' || coalesce(strlen(doc_id::VARCHAR) || ':' || doc_id::VARCHAR, '-') AS a,
                   coalesce(strlen(source) || ':' || source, '-') || coalesce(strlen(lang) || ':' || lang, '-') AS b,
                   coalesce(strlen(text) || ':' || text, '-') AS c, n_chars,
                   coalesce(list_reduce(
                       [4294967295::UBIGINT] || list_transform(string_split(doc_id::VARCHAR, ''), lambda s: ascii(s)::UBIGINT),
                       lambda k, s: list_reduce(
                           [xor(k, s)] || list_transform(range(8), lambda i: i::UBIGINT),
                           lambda y, i: CASE WHEN y & 1 = 1 THEN xor(y >> 1, 3988292384::UBIGINT) ELSE y >> 1 END)), 1)
                       AS crc
            FROM documents),
        leaves AS (
            SELECT *, sha256(substr(a, 2) || b || coalesce(strlen(n_chars::VARCHAR) || ':' || n_chars, '-') || c) AS leaf,
                   CASE WHEN xor(crc, 4294967295::UBIGINT) % 7 = 0
                        THEN sha256(substr(a, 2) || b || coalesce(strlen((n_chars + 1)::VARCHAR) || ':' || (n_chars + 1), '-') || c)
                        END AS changed
            FROM d),
        placed AS (
            SELECT doc_id, tree, leaf, coalesce(changed, leaf) AS claimed,
                   row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos
            FROM leaves),
        nodes AS (
            SELECT tree, 0 AS level, pos, leaf AS digest, count(*) OVER (PARTITION BY tree) AS n FROM placed
            UNION ALL
            SELECT tree, level + 1, pos // 2, sha256(string_agg(digest, '' ORDER BY pos)), (any_value(n) + 1) // 2
            FROM nodes WHERE n > 1 GROUP BY tree, level, pos // 2),
        subroots AS (
            SELECT tree, digest, level AS height, row_number() OVER (ORDER BY tree) - 1 AS pos FROM nodes WHERE n = 1),
        tops AS (
            SELECT 0 AS level, pos, digest, count(*) OVER () AS n FROM subroots
            UNION ALL
            SELECT level + 1, pos // 2, sha256(string_agg(digest, '' ORDER BY pos)), (any_value(n) + 1) // 2
            FROM tops WHERE n > 1 GROUP BY level, pos // 2),
        steps AS (
            SELECT p.tree, p.pos, n.level, n.digest, n.pos < (p.pos >> n.level) AS is_before
            FROM placed p JOIN nodes n ON n.tree = p.tree AND n.pos = xor(p.pos >> n.level, 1)
            UNION ALL
            SELECT p.tree, p.pos, s.height + t.level, t.digest, t.pos < (s.pos >> t.level)
            FROM placed p JOIN subroots s USING (tree) JOIN tops t ON t.pos = xor(s.pos >> t.level, 1)),
        heights AS (
            SELECT tree, height + (SELECT max(level) FROM tops) AS height FROM subroots),
        fold AS (
            SELECT tree, pos, 0 AS level, claimed AS digest FROM placed
            UNION ALL
            SELECT f.tree, f.pos, f.level + 1,
                   sha256(CASE WHEN s.is_before THEN s.digest || f.digest ELSE f.digest || coalesce(s.digest, '') END)
            FROM fold f JOIN heights h USING (tree)
            LEFT JOIN steps s ON s.tree = f.tree AND s.pos = f.pos AND s.level = f.level
            WHERE f.level < h.height),
        proofs AS (SELECT tree, pos, sha256(string_agg(digest, '' ORDER BY level)) AS proof_sha256 FROM steps GROUP BY tree, pos)
        SELECT p.doc_id, p.leaf, s.digest AS subroot, r.digest AS root, coalesce(q.proof_sha256, sha256('')) AS proof_sha256,
               f.digest AS folded_root, f.digest = r.digest AS verified
        FROM placed p JOIN subroots s USING (tree) JOIN heights h USING (tree)
        JOIN fold f ON f.tree = p.tree AND f.pos = p.pos AND f.level = h.height
        LEFT JOIN proofs q ON q.tree = p.tree AND q.pos = p.pos
        CROSS JOIN (SELECT digest FROM tops WHERE n = 1) r""",
}
