"""One query per operator over its whole table, and SQL where SQL can express it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from aisleflow.llm import (
    decontaminate,
    hidden_markov,
    languages,
    licences,
    metric_search,
    near_copies,
    pages,
    repeats,
    sentencepieces,
    spelling,
    toxicity,
    vector_codes,
    weak_labels,
)
from aisleflow.llm.common import materialised, read_table

PIECES = "/opt/tokenizers/piece_bpe_32k.model"


def _remainder(n: int):
    """crc32 of the doc_id as text, modulo n; null if the id is."""
    return F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(n))


def op1_languages(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    model = languages.learn(docs, _remainder(4) != 2)
    return languages.identify(docs.select("doc_id", "text"), model).select(
        "doc_id",
        F.coalesce(_remainder(4) == 2, F.lit(False)).alias("held_out"),
        "lang_pred",
        F.col("lang_score").alias("score"),
        F.size("lang_spans").alias("n_spans"),
    )


def op2_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeats.remove_repeats(read_table(spark, sf_dir, "documents").select("doc_id", "text")).select(
        "doc_id",
        F.col("rep_bytes").alias("n_bytes"),
        F.col("rep_removed").alias("n_removed"),
        F.col("rep_spans").alias("n_spans"),
        F.sha2("rep_kept", 256).alias("kept_sha256"),
    )


def op3_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pages.extract(read_table(spark, sf_dir, "pages"))


def op4_hidden_markov(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    return hidden_markov.score_texts(docs, _remainder(5) != 1).select(
        "doc_id",
        F.coalesce(_remainder(5) == 1, F.lit(False)).alias("held_out"),
        "n_tokens",
        "n_known",
        "train_tokens",
        "base_score",
        "score",
    )


def op5_licences(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licences.scan(read_table(spark, sf_dir, "documents"), licences.known_digests(spark))


def op9_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.contamination(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


def op6_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return weak_labels.quality(read_table(spark, sf_dir, "documents"))


def op7_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metric_search.top_k(read_table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0)


def op8_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    encoded = sentencepieces.encode(read_table(spark, sf_dir, "documents"), PIECES)
    return encoded.select("doc_id", F.when(F.col("ids").isNotNull(), F.size("ids")).alias("n_ids"), "ids", "round_trip")


def op10_near_copies(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_copies.classes(read_table(spark, sf_dir, "documents"))


def op11_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = materialised(spelling.words(read_table(spark, sf_dir, "documents").select("doc_id", "text")), "words")
    return spelling.group_variants(counts)


def op12_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels")
    model = toxicity.learn(docs.select("doc_id", "text"), labels.select("doc_id", "toxic"), _remainder(4) != 2)
    return toxicity.score(docs, model).select(
        "doc_id",
        F.coalesce(_remainder(4) == 2, F.lit(False)).alias("held_out"),
        "score",
        (F.col("score") >= toxicity.TOXIC_FROM).cast("int").alias("predicted"),
    )


def op13_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    coded, codebook = vector_codes.compress(read_table(spark, sf_dir, "embeddings"))
    digest = F.lit(vector_codes.codebook_digest(codebook)).alias("codebooks_sha256")
    return vector_codes.with_label_error(coded).select("vec_id", "code", "error", "label_error", digest)


QUERIES = {
    "op1_languages": op1_languages,
    "op2_repeats": op2_repeats,
    "op3_pages": op3_pages,
    "op4_hidden_markov": op4_hidden_markov,
    "op5_licences": op5_licences,
    "op6_quality": op6_quality,
    "op7_top_k": op7_top_k,
    "op8_pieces": op8_pieces,
    "op9_decontaminate": op9_decontaminate,
    "op10_near_copies": op10_near_copies,
    "op11_spelling": op11_spelling,
    "op12_toxicity": op12_toxicity,
    "op13_vector_codes": op13_vector_codes,
}

_LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_WORDS = "coalesce(regexp_extract_all(" + _LOWER + ", '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+'), [])"


def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


_KNOWN_SQL = ", ".join(f"({_quoted(name)}, {_quoted(text)})" for name, text in licences.KNOWN.items())



def _codes_sql() -> str:
    """Rounds of nearest entries and their means, each round over all parts."""
    near = """
        SELECT r, p, e, least FROM (
            SELECT r, x.p, x.v, b.e,
                   list_sum(list_transform(list_zip(x.v, b.v), lambda z: (z[1] - z[2]) * (z[1] - z[2])))::BIGINT AS least
            FROM x JOIN b{k} AS b ON x.p = b.p)
        QUALIFY row_number() OVER (PARTITION BY r, p ORDER BY least, e) = 1"""
    rounds = "".join(
        f""", a{k} AS ({near.format(k=k)}
        ), m{k} AS (
            SELECT p, e, list(c ORDER BY i) AS v FROM (
                SELECT a.p, a.e, i, floor(sum(x.v[i])::DOUBLE / count(*))::BIGINT AS c
                FROM a{k} AS a JOIN x USING (r, p), unnest(range(1, len(x.v) + 1)) AS t(i) GROUP BY 1, 2, 3)
            GROUP BY p, e
        ), b{k + 1} AS (SELECT b.p, b.e, coalesce(m.v, b.v) AS v FROM b{k} AS b LEFT JOIN m{k} AS m USING (p, e))"""
        for k in range(vector_codes.ROUNDS)
    )
    return f"""
        WITH v AS (
            SELECT row_number() OVER (ORDER BY vec_id) AS r, vec_id, label, len(embedding) // {vector_codes.PARTS} AS d,
                   list_transform(embedding, lambda x: floor({vector_codes.SCALE} * x::DOUBLE)::BIGINT) AS q
            FROM embeddings
            WHERE len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
        ), x AS (
            SELECT r, p, q[p * d + 1:(p + 1) * d] AS v FROM v, unnest(range({vector_codes.PARTS})) AS t(p)
        ), b0 AS (SELECT p, r - 1 AS e, v FROM x WHERE r <= {vector_codes.ENTRIES}){rounds}, last AS ({near.format(k=vector_codes.ROUNDS)}
        ), coded AS (
            SELECT r, string_agg(printf('%02x', e), '' ORDER BY p) AS code, sum(least)::BIGINT AS error FROM last GROUP BY r
        ), book AS (
            SELECT sha256(string_agg(array_to_string(v, ','), ',' ORDER BY p, e)) AS s FROM b{vector_codes.ROUNDS}
        )
        SELECT vec_id, code, error, sum(error) OVER (PARTITION BY label)::BIGINT AS label_error,
               (SELECT s FROM book) AS codebooks_sha256
        FROM coded JOIN v USING (r)"""


_SPELLING_SQL = f"""
        WITH RECURSIVE nibbles AS (
            SELECT list_transform(range(16), lambda i: list_reduce(list_prepend(i, range(4)),
                   lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS t
        ), runs AS (
            SELECT coalesce(doc_id::VARCHAR, '') || ':' || run AS k, run
            FROM (SELECT doc_id, translate(unnest(regexp_extract_all(coalesce(text, ''), '[A-Za-zÀ-ÿ]{{{spelling.LEAST_LENGTH},}}')),
                                           '{spelling.UPPER}', '{spelling.LOWER}') AS run FROM documents)
        ), bits AS (
            SELECT k, run, count(*) AS n, list_transform(range(2 * strlen(k)), lambda i:
                   (instr('0123456789ABCDEF', substr(hex(encode(k)), (i + 1 - 2 * (i % 2) + 1)::BIGINT, 1)) - 1)::BIGINT) AS b
            FROM runs GROUP BY k, run
        ), hashed AS (
            SELECT run, n, xor(list_reduce(list_prepend(4294967295::BIGINT, b),
                   lambda c, x: xor(c >> 4, t[(xor(c, x) & 15) + 1])), 4294967295) AS h FROM bits, nibbles
        ), counts AS (
            SELECT w AS word, sum(n)::BIGINT AS n FROM (
                SELECT n, CASE WHEN h % {spelling.SPOILED} = 0
                               THEN substr(run, 1, (h % length(run))::BIGINT) || substr(run, (h % length(run) + 2)::BIGINT) ELSE run END AS w
                FROM hashed)
            WHERE length(w) >= {spelling.LEAST_LENGTH} GROUP BY w HAVING sum(n) >= {spelling.LEAST_COUNT}
        ), cut AS (
            SELECT word, i, substr(word, 1, i - 1) || substr(word, i + 1) AS rest FROM counts, unnest(range(1, length(word) + 1)) AS t(i)
        ), near AS (
            SELECT a.word AS word, b.word AS other FROM cut AS a JOIN cut AS b ON a.i = b.i AND a.rest = b.rest AND length(a.word) = length(b.word)
            WHERE a.word <> b.word
            UNION SELECT cut.word, counts.word FROM cut JOIN counts ON cut.rest = counts.word
            UNION SELECT counts.word, cut.word FROM cut JOIN counts ON cut.rest = counts.word
        ), best AS (
            SELECT near.word AS word, count(*)::BIGINT AS n_near, arg_min(other, (-c.n, encode(other))) AS other, max(c.n) AS other_n
            FROM near JOIN counts AS c ON c.word = other GROUP BY near.word
        ), formed AS (
            SELECT word, n, coalesce(n_near, 0)::BIGINT AS n_near,
                   CASE WHEN other_n >= {spelling.RATIO} * n THEN other END AS form,
                   CASE WHEN other_n >= {spelling.RATIO} * n THEN other_n END AS form_n
            FROM counts LEFT JOIN best USING (word)
        ), ends AS (
            SELECT word, word AS root, form AS onward FROM formed
            UNION ALL SELECT ends.word, f.word, f.form FROM ends JOIN formed AS f ON f.word = ends.onward
        )
        SELECT formed.word AS word, form, root, n, n_near, form_n
        FROM formed JOIN ends ON ends.word = formed.word WHERE onward IS NULL"""

ORACLE_SQL = {
    "op11_spelling": _SPELLING_SQL,
    "op13_vector_codes": _codes_sql(),
    "op2_repeats": f"""
        WITH d AS (
            SELECT row_number() OVER () AS r, doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents
        ), w AS (
            SELECT r, doc_id, i, substr(h, 2 * i + 1, {2 * repeats.WIDTH}) AS s
            FROM (SELECT *, unnest(range(0, len(h) // 2 - {repeats.WIDTH - 1})) AS i FROM d WHERE doc_id IS NOT NULL)
        ), smallest AS (
            SELECT s, min(doc_id) AS m FROM w GROUP BY s
        ), gone AS (
            SELECT r, i, i - lag(i) OVER (PARTITION BY r ORDER BY i) AS step
            FROM w JOIN smallest USING (s) WHERE m < doc_id
        ), runs AS (
            SELECT r, min(i) AS a, max(i) + {repeats.WIDTH} AS b
            FROM (SELECT r, i, sum(CASE WHEN step <= {repeats.WIDTH} THEN 0 ELSE 1 END) OVER (PARTITION BY r ORDER BY i) AS k FROM gone)
            GROUP BY r, k
        ), parts AS (
            SELECT r, a, b, coalesce(lag(b) OVER (PARTITION BY r ORDER BY a), 0) AS e FROM runs
        ), kept AS (
            SELECT r, count(*) AS n_spans, sum(b - a)::BIGINT AS n_removed, max(b) AS e,
                   string_agg(substr(h, 2 * e + 1, 2 * (a - e)), '' ORDER BY a) AS k
            FROM parts JOIN d USING (r) GROUP BY r
        )
        SELECT doc_id, (len(h) // 2)::BIGINT AS n_bytes, coalesce(n_removed, 0)::BIGINT AS n_removed,
               coalesce(n_spans, 0)::BIGINT AS n_spans,
               sha256(unhex(coalesce(k, '') || substr(h, 2 * coalesce(e, 0) + 1))) AS kept_sha256
        FROM d LEFT JOIN kept USING (r)""",
    "op5_licences": f"""
        WITH known AS (
            SELECT sha256({licences.canonical_sql("t")}) AS digest, min(name) AS licence
            FROM (VALUES {_KNOWN_SQL}) AS k(name, t) GROUP BY 1
        ), seen AS (
            SELECT doc_id, sha256({licences.canonical_sql("text")}) AS digest FROM documents
        )
        SELECT doc_id, seen.digest AS digest, licence FROM seen LEFT JOIN known ON seen.digest = known.digest""",
    "op7_top_k": """
        WITH v AS (
            SELECT row_number() OVER () AS r, vec_id,
                   list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)::BIGINT) AS e
            FROM embeddings
            WHERE vec_id IS NOT NULL AND len(embedding) > 0
                  AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
        ), scored AS (
            SELECT q.r AS q, q.vec_id AS query_id, c.vec_id AS vec_id, list_dot_product(q.e, c.e)::BIGINT AS score
            FROM v AS q JOIN v AS c ON q.r <> c.r AND len(q.e) = len(c.e) WHERE q.vec_id % 100 = 0
        )
        SELECT query_id, rank::INTEGER AS rank, vec_id, score
        FROM (SELECT *, row_number() OVER (PARTITION BY q ORDER BY score DESC, vec_id) AS rank FROM scored) WHERE rank <= 10""",
    "op9_decontaminate": f"""
        WITH d AS (
            SELECT row_number() OVER () AS r, doc_id, {_WORDS.format("text")} AS w FROM documents
        ), b AS (
            SELECT item_id, w, least(len(w), 10) AS n FROM (SELECT item_id, {_WORDS.format("text")} AS w FROM benchmark)
            WHERE len(w) > 0
        ), bw AS (
            SELECT DISTINCT item_id, n, array_to_string(w[i:i + n - 1], ' ') AS g
            FROM (SELECT *, unnest(range(1, len(w) - n + 2)) AS i FROM b)
        ), sizes AS (SELECT DISTINCT n FROM b),
        dw AS (
            SELECT r, i, n, array_to_string(w[i:i + n - 1], ' ') AS g
            FROM (SELECT r, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM d, sizes)
        ), hits AS (
            SELECT r, i, dw.n AS n, item_id FROM dw JOIN bw ON dw.n = bw.n AND dw.g = bw.g
        ), covered AS (
            SELECT r, count(DISTINCT p) AS n_hit FROM (SELECT r, unnest(range(i, i + n)) AS p FROM hits) GROUP BY r
        ), named AS (
            SELECT r, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS items
            FROM (SELECT DISTINCT r, item_id::VARCHAR AS item_id FROM hits WHERE item_id IS NOT NULL) GROUP BY r
        )
        SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit,
               coalesce(n_items, 0)::BIGINT AS n_items, sha256(coalesce(items, '')) AS items_sha256,
               coalesce(n_hit, 0) > 0 AS contaminated
        FROM d LEFT JOIN covered USING (r) LEFT JOIN named USING (r)""",
}
