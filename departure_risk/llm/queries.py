"""The registered queries of the operators, with production parameters, over whole tables."""

from pyspark.sql import DataFrame, SparkSession, functions as F  # noqa: F401

SQL: dict[str, str] = {}


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def op1_simple8b_tokens(spark: SparkSession, folder: str) -> DataFrame:
    import public_tokenizers

    from departure_risk.llm import tokens

    written = tokens.write_tokens(table(spark, folder, "documents"), public_tokenizers.path("byte_bpe_50k.json"))
    return tokens.read_tokens(written)


def op2_spaced_seed_overlaps(spark: SparkSession, folder: str) -> DataFrame:
    from departure_risk.llm import decontaminate

    return decontaminate.overlaps(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


def op3_byte_network_quality(spark: SparkSession, folder: str) -> DataFrame:
    from departure_risk.llm import quality

    documents = table(spark, folder, "documents")
    return quality.scores(documents, quality.train(documents, table(spark, folder, "labels")))


def op4_mixing_tree(spark: SparkSession, folder: str) -> DataFrame:
    from departure_risk.llm import mixing

    return mixing.mix_words(table(spark, folder, "documents"))


def op5_warc_dictionary(spark: SparkSession, folder: str) -> DataFrame:
    from departure_risk.llm import warc

    return warc.read_archives(warc.write_archives(table(spark, folder, "pages"))).drop("file")


SQL["op5_warc_dictionary"] = """
    SELECT page_id, payload_bytes, payload_digest,
           CASE WHEN payload_bytes >= 100 AND page_id <> first THEN 'revisit' ELSE 'response' END AS record_type,
           CASE WHEN payload_bytes >= 100 AND page_id <> first THEN first END AS refers_to
    FROM (SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes, sha256(coalesce(html, '')) AS payload_digest,
                 min(page_id) OVER (PARTITION BY sha256(coalesce(html, ''))) AS first FROM pages)"""


#: host, path and verdict of the url rules.
URL_RULES = [("org", "/", "allow"), ("example.org", "/es/", "block"), ("example.org", "/en/1", "block"),
             ("com", "/fr/", "allow"), ("com", "/de/", "block")]


def op6_host_graph_verdicts(spark: SparkSession, folder: str) -> DataFrame:
    from departure_risk.llm import hostgraph

    return hostgraph.judged(table(spark, folder, "pages"), URL_RULES)


def op7_pivot_top_k(spark: SparkSession, folder: str) -> DataFrame:
    from departure_risk.llm import topk

    return topk.top_k(table(spark, folder, "embeddings"), k=20, query_every=20)


SQL["op7_pivot_top_k"] = """
    WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: floor(64 * x::DOUBLE)) AS v FROM embeddings
               WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
    s AS (SELECT q.vec_id AS query_id, c.vec_id, list_dot_product(q.v, c.v)::BIGINT AS score
          FROM v q JOIN v c ON c.vec_id <> q.vec_id WHERE q.vec_id % 20 = 0),
    r AS (SELECT query_id, (row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id))::INT AS rank, vec_id, score FROM s)
    SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 20"""


def op8_chosen_path_near_duplicates(spark: SparkSession, folder: str) -> DataFrame:
    from departure_risk.llm import neardup

    return neardup.near_duplicates(table(spark, folder, "documents"))


SQL["op8_chosen_path_near_duplicates"] = """
    WITH RECURSIVE w AS (
        SELECT doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
               'abcdefghijklmnopqrstuvwxyz'), '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS w FROM documents),
    s AS (SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
          ELSE list_distinct(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' '))) END AS s FROM w),
    e AS (SELECT doc_id, len(s) AS n, unnest(s) AS x FROM s),
    p AS (SELECT a.doc_id AS a, b.doc_id AS b FROM e a JOIN e b ON a.x = b.x AND a.doc_id <> b.doc_id
          GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING 100 * count(*) >= 75 * (a.n + b.n - count(*))),
    r AS (SELECT doc_id AS a, doc_id AS b FROM documents UNION SELECT r.a, p.b FROM r JOIN p ON r.b = p.a),
    c AS (SELECT a, min(b) AS component_id FROM r GROUP BY a)
    SELECT doc_id, len(s)::BIGINT AS n_shingles, component_id, doc_id = component_id AS kept
    FROM s JOIN c ON c.a = s.doc_id"""


def op10_deletion_neighbour_lines(spark: SparkSession, folder: str) -> DataFrame:
    from departure_risk.llm import linededup

    return linededup.line_report(table(spark, folder, "documents"))


SQL["op10_deletion_neighbour_lines"] = """
    WITH l AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS t, generate_subscripts(string_split(text, chr(10)), 1) - 1 AS line
               FROM documents),
    w AS (SELECT doc_id, line, list_filter(string_split_regex(translate(t, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                 'abcdefghijklmnopqrstuvwxyz'), '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS w FROM l),
    c AS (SELECT w, min((doc_id, line)) AS f FROM w WHERE len(w) > 0 GROUP BY w),
    v AS (SELECT w, f, unnest(range(1, len(w) + 1)) AS i FROM c WHERE len(w) >= 6),
    d AS (SELECT w, f, i, list_concat(w[1:i - 1], w[i + 1:]) AS k FROM v),
    p AS (SELECT a.w, b.f FROM d a JOIN d b ON a.i = b.i AND a.k = b.k WHERE a.w <> b.w
          UNION ALL SELECT d.w, c.f FROM d JOIN c ON d.k = c.w WHERE len(c.w) >= 6
          UNION ALL SELECT c.w, d.f FROM d JOIN c ON d.k = c.w WHERE len(c.w) >= 6),
    n AS (SELECT w, min(f) AS f FROM (SELECT w, f FROM c UNION ALL SELECT w, f FROM p) GROUP BY w),
    r AS (SELECT w.doc_id, w.line FROM w JOIN n ON w.w = n.w WHERE (w.doc_id, w.line) > n.f)
    SELECT d.doc_id, coalesce(len(string_split(d.text, chr(10))), 0)::BIGINT AS n_lines, count(r.line) AS n_removed,
           coalesce(string_agg(r.line::VARCHAR, ',' ORDER BY r.line), '') AS removed
    FROM documents d LEFT JOIN r ON r.doc_id = d.doc_id GROUP BY d.doc_id, d.text"""


def op9_gated_recurrent_scores(spark: SparkSession, folder: str) -> DataFrame:
    from departure_risk.llm import lm

    return lm.scores(table(spark, folder, "documents"))


def op11_dictionary_novelty_secrets(spark: SparkSession, folder: str) -> DataFrame:
    from departure_risk.llm import secrets

    return secrets.report(secrets.findings(table(spark, folder, "documents")))


#: crc32 of the decimal digits of doc_id, as DuckDB has no such function: a byte, then eight shifts.
_CRC = """xor(list_reduce(list_concat([4294967295::BIGINT], flatten(list_transform(string_split(doc_id::VARCHAR, ''),
    lambda b: [ascii(b)::BIGINT, -1, -1, -1, -1, -1, -1, -1, -1]))), lambda c, x: CASE WHEN x >= 0 THEN xor(c, x)
    ELSE xor(c >> 1, 3988292384 * (c & 1)) END), 4294967295)"""


def op12_path_copying_manifest(spark: SparkSession, folder: str) -> DataFrame:
    from departure_risk.llm import merkle

    third = F.crc32(F.col("doc_id").cast("string")) % 3 == 0
    lowered = F.translate("text", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return merkle.report(merkle.manifest(table(spark, folder, "documents"), third, {"text": lowered}))


def _leaf_sql(text: str) -> str:
    fields = ["doc_id::VARCHAR", "source", "lang", "n_chars::VARCHAR", text]
    return "sha256(concat(" + ", ".join(f"coalesce(strlen({f}) || ':' || {f}, '-')" for f in fields) + "))"


SQL["op12_path_copying_manifest"] = f"""
    WITH RECURSIVE leaf AS (
        SELECT doc_id, lang, {_leaf_sql("text")} AS leaf,
               CASE WHEN {_CRC} % 3 = 0 THEN {_leaf_sql("translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')")}
                    ELSE {_leaf_sql("text")} END AS changed,
               row_number() OVER (PARTITION BY lang ORDER BY doc_id) - 1 AS place FROM documents),
    lower_level AS (
        SELECT lang, 0 AS level, list(leaf ORDER BY place) AS nodes FROM leaf GROUP BY lang
        UNION ALL
        SELECT lang, level + 1, list_transform(range(0, len(nodes), 8), lambda i: sha256(array_to_string(nodes[i + 1:i + 8], '')))
        FROM lower_level WHERE len(nodes) > 1),
    subroot AS (SELECT lang, level AS height, nodes[1] AS subroot, row_number() OVER (ORDER BY lang NULLS FIRST) - 1 AS place
                FROM lower_level WHERE len(nodes) = 1),
    upper_level AS (
        SELECT 0 AS level, list(subroot ORDER BY place) AS nodes FROM subroot
        UNION ALL
        SELECT level + 1, list_transform(range(0, len(nodes), 8), lambda i: sha256(array_to_string(nodes[i + 1:i + 8], '')))
        FROM upper_level WHERE len(nodes) > 1),
    way AS (
        SELECT doc_id, l.lang, leaf, changed, n.level, l.place // (8 ** n.level)::BIGINT AS spot, n.nodes
        FROM leaf l JOIN lower_level n ON l.lang IS NOT DISTINCT FROM n.lang WHERE len(n.nodes) > 1
        UNION ALL
        SELECT doc_id, l.lang, leaf, changed, s.height + n.level, s.place // (8 ** n.level)::BIGINT, n.nodes
        FROM leaf l JOIN subroot s ON l.lang IS NOT DISTINCT FROM s.lang JOIN upper_level n ON len(n.nodes) > 1),
    near AS (SELECT doc_id, level, array_to_string(nodes[spot - spot % 8 + 1:spot], '') AS before,
                    array_to_string(nodes[spot + 2:spot - spot % 8 + 8], '') AS after FROM way),
    proof AS (SELECT doc_id, sha256(string_agg(before || after, '' ORDER BY level)) AS proof_sha256, list(before ORDER BY level) AS b,
                     list(after ORDER BY level) AS a FROM near GROUP BY doc_id),
    folded AS (
        SELECT l.doc_id, 0 AS level, changed AS digest, coalesce(b, []) AS b, coalesce(a, []) AS a
        FROM leaf l LEFT JOIN proof p ON p.doc_id = l.doc_id
        UNION ALL
        SELECT doc_id, level + 1, sha256(b[level + 1] || digest || a[level + 1]), b, a FROM folded WHERE level < len(b))
    SELECT l.doc_id, l.leaf, s.subroot, u.nodes[1] AS root, coalesce(p.proof_sha256, sha256('')) AS proof_sha256,
           f.digest AS folded_root, f.digest = u.nodes[1] AS verified
    FROM leaf l JOIN subroot s ON l.lang IS NOT DISTINCT FROM s.lang JOIN upper_level u ON len(u.nodes) = 1
         LEFT JOIN proof p ON p.doc_id = l.doc_id JOIN folded f ON f.doc_id = l.doc_id AND f.level = len(f.b)"""


def op13_cube_divergence(spark: SparkSession, folder: str) -> DataFrame:
    from departure_risk.llm import divergence

    return divergence.audit(table(spark, folder, "documents"))


SQL["op13_cube_divergence"] = r"""
    WITH d AS (SELECT row_number() OVER () AS id, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
                      regexp_extract_all(coalesce(text, ''), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS w FROM documents),
    t AS (SELECT id, lang, source, translate(unnest(w), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS term FROM d),
    kept AS (SELECT lang, term, count(*) AS n FROM t GROUP BY lang, term HAVING count(DISTINCT id) >= 30),
    whole AS (SELECT lang, count(*) AS v, sum(n) AS total FROM kept GROUP BY lang),
    grp AS (SELECT DISTINCT lang, source FROM d),
    own AS (SELECT lang, source, term, count(*) AS n FROM t SEMI JOIN kept USING (lang, term) GROUP BY lang, source, term),
    size AS (SELECT lang, source, sum(n) AS total FROM own GROUP BY lang, source),
    p AS (SELECT g.lang, g.source, k.term, coalesce(o.n, 0) AS n,
                 1 + (1000000000::HUGEINT * (coalesce(o.n, 0) + 5)) // (coalesce(s.total, 0) + 5 * w.v) AS p,
                 1 + (1000000000::HUGEINT * (k.n + 5)) // (w.total + 5 * w.v) AS q
          FROM grp g JOIN kept k USING (lang) JOIN whole w USING (lang) LEFT JOIN size s USING (lang, source)
               LEFT JOIN own o ON o.lang = g.lang AND o.source = g.source AND o.term = k.term),
    f AS (SELECT a.lang, a.source, b.source AS item, sum(abs(a.p - b.p)) AS value
          FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
    r AS (SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(f.value, 0) AS value
          FROM grp a JOIN grp b ON a.lang = b.lang AND a.source <> b.source
               LEFT JOIN f ON f.lang = a.lang AND f.source = a.source AND f.item = b.source
          UNION ALL SELECT lang, source, 'term', term, p - q FROM p WHERE n > 0 AND p > q),
    n AS (SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS rank FROM r)
    SELECT lang, source, part, item, value::BIGINT AS value, rank::INT AS rank FROM n WHERE part = 'pair' OR rank <= 50"""


QUERIES = {f.__name__: f for f in [op1_simple8b_tokens, op2_spaced_seed_overlaps, op3_byte_network_quality,
                                   op4_mixing_tree, op5_warc_dictionary, op6_host_graph_verdicts, op7_pivot_top_k,
                                   op8_chosen_path_near_duplicates, op9_gated_recurrent_scores,
                                   op10_deletion_neighbour_lines, op11_dictionary_novelty_secrets, op12_path_copying_manifest, op13_cube_divergence]}
