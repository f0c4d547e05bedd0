"""The queries of the dealt operators, each with the SQL that must give the same rows where SQL can express it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from jobgauge.llm import (
    chat_format, decontaminate, jaccard_join, line_dedup, merkle, mixing, pii, quality, repair, secret_scan, sharding, substring_dedup, topk,
)

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None) -> Callable[[Query], Query]:
    def register(function: Query) -> Query:
        QUERIES[function.__name__] = function
        if sql is not None:
            ORACLES[function.__name__] = sql
        return function

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


CONTROL_TEXT = "</s>[INST] ok [/INST]"

_CHAT_TAILS = chat_format.CONTROL_TAILS


@query(
    rf"""
    WITH added AS (
        SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
        UNION ALL SELECT -1, 0, 'user', '{CONTROL_TEXT}' UNION ALL SELECT -1, 1, 'assistant', '{CONTROL_TEXT}'
    ),
    escaped AS (
        SELECT *, length(regexp_replace(text, '([<\[])(\\*)({_CHAT_TAILS})', '\1\\\2\3', 'g')) AS chars,
               length(regexp_replace(role, '([<\[])(\\*)({_CHAT_TAILS})', '\1\\\2\3', 'g')) AS role_chars,
               lag(role) OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS role_before
        FROM added
    ),
    marked AS (SELECT *, role_before IS NULL OR role_before <> role AS opens FROM escaped)
    SELECT conv_id, count(*) AS n_turns,
           sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
           CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
           sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
           CAST(sum(chars + CASE WHEN opens THEN role_chars + length('<|role|><|says|><|end|>') ELSE length('<|turn|>') END) AS BIGINT)
               AS formatted_chars,
           count(*) FILTER (opens) AS n_blocks
    FROM marked GROUP BY conv_id
    """
)
def op1_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    control = spark.range(2).select(
        F.lit(-1).cast("long").alias("conv_id"),
        F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
        F.lit(CONTROL_TEXT).alias("text"),
    )
    return chat_digest(chat_format.format_conversations(turns.unionByName(control)))


def chat_digest(formatted: DataFrame) -> DataFrame:
    """What the formatted text and its loss spans say, read back from them."""
    read = formatted.select(
        "conv_id",
        "formatted",
        "n_blocks",
        chat_format.read_turns(F.col("formatted")).alias("turns"),
        F.concat_ws("", chat_format.read_loss(F.col("formatted"), F.col("loss_spans"))).alias("loss"),
    )
    lines = F.transform("turns", lambda turn: F.concat(turn["role"], F.lit("\n"), turn["text"], F.lit("\n")))
    return read.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(F.concat_ws("", lines), 256).alias("turns_sha256"),
        F.char_length("loss").cast("long").alias("loss_chars"),
        F.sha2("loss", 256).alias("loss_sha256"),
        F.char_length("formatted").cast("long").alias("formatted_chars"),
        "n_blocks",
    )


@query(
    rf"""
    WITH lines AS (
        SELECT doc_id, coalesce(source, chr(1)) AS site, generate_subscripts(string_split(text, chr(10)), 1) AS pos,
               unnest(string_split(text, chr(10))) AS line
        FROM documents WHERE text IS NOT NULL
    ),
    keyed AS (SELECT *, trim(regexp_replace(line, '[\t\r]', ' ', 'g')) AS key FROM lines),
    spread AS (
        SELECT key, min(doc_id) AS first_doc FROM keyed WHERE key <> ''
        GROUP BY key HAVING count(DISTINCT site) >= {line_dedup.MIN_SITES}
    ),
    marked AS (
        SELECT keyed.*, first_doc IS NOT NULL AND first_doc <> doc_id AS gone FROM keyed LEFT JOIN spread USING (key)
    )
    SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_removed,
           sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT gone), '')) AS kept_sha256
    FROM marked GROUP BY doc_id
    """
)
def op2_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents").select("doc_id", "source", "text")
    return line_dedup.dedup_lines(documents).select(
        "doc_id",
        F.col("_n_lines").alias("n_lines"),
        F.size("_removed").cast("long").alias("n_removed"),
        F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256"),
    )


@query(
    rf"""
    WITH RECURSIVE sized AS (
        SELECT doc_id, source, md5('mix' || chr(10) || doc_id) AS draw,
               CAST(coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS BIGINT) AS size
        FROM documents
    ),
    sources AS (
        SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
               [5.0::DOUBLE, 2.0, 1.0][1 + (row_number() OVER (ORDER BY source IS NULL, source) - 1) % 3] AS weight
        FROM sized GROUP BY source
    ),
    shared AS (
        SELECT 0 AS step, (SELECT sum(source_size) / sum(weight) FROM sources) AS share
        UNION ALL
        SELECT step + 1, (
            SELECT (sum(source_size) - sum(CASE WHEN weight * share > 3 * source_size THEN 3 * source_size ELSE 0 END))
                   / sum(CASE WHEN weight * share > 3 * source_size THEN 0 ELSE weight END) FROM sources)
        FROM shared WHERE step < 30
    ),
    targets AS (
        SELECT *, least(weight * (SELECT share FROM shared WHERE step = 30), 3 * source_size::DOUBLE) AS target FROM sources
    ),
    laid AS (
        SELECT doc_id, size, source_size, target, CAST(floor(target) AS BIGINT) AS needed,
               sum(size) OVER (PARTITION BY s.source ORDER BY draw, doc_id, size ROWS UNBOUNDED PRECEDING) - size AS start
        FROM sized s JOIN targets t ON s.source IS NOT DISTINCT FROM t.source
    )
    SELECT doc_id, size, source_size, target,
           CAST(CASE WHEN size = 0 THEN 0 ELSE greatest(0, least(size, needed - start))
               + greatest(0, least(size, needed - source_size - start))
               + greatest(0, least(size, needed - 2 * source_size - start)) END AS BIGINT) AS taken
    FROM laid
    """
)
def op8_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents").select("doc_id", "source", "text")
    return mixing.mix(documents).drop("source")


@query(
    rf"""
    WITH words AS (
        SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                          '[^\x20\x09-\x0D]+') AS w
        FROM documents
    ),
    shingles AS (
        SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 4 THEN [array_to_string(w, ' ')]
            ELSE list_transform(range(1, len(w) - 2), lambda i: array_to_string(w[i:i + 3], ' ')) END) AS s
        FROM words
    ),
    sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
    rare AS (SELECT s FROM shingles GROUP BY s HAVING count(*) > 1),
    shared AS (SELECT * FROM shingles SEMI JOIN rare USING (s)),
    common AS (
        SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c
        FROM shared a JOIN shared b ON a.s = b.s AND a.doc_id < b.doc_id GROUP BY 1, 2
    ),
    links AS (
        SELECT a, b FROM common JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b
        WHERE 100 * c >= 85 * (x.n + y.n - c)
    ),
    both_ways AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
    reach AS (
        WITH RECURSIVE r(a, b) AS (SELECT a, b FROM both_ways UNION SELECT r.a, w.b FROM r JOIN both_ways w ON r.b = w.a)
        SELECT a, min(b) AS least FROM r GROUP BY a
    )
    SELECT words.doc_id, coalesce(n, 0) AS n_shingles, least(words.doc_id, coalesce(reach.least, words.doc_id)) AS component_id
    FROM words LEFT JOIN sizes USING (doc_id) LEFT JOIN reach ON reach.a = words.doc_id
    """
)
def op5_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    linked = jaccard_join.link_documents(table(spark, sf_dir, "documents"))
    return linked.select("doc_id", "n_shingles", "component_id")


@query(
    rf"""
    WITH items AS (
        SELECT CAST(item_id AS VARCHAR) AS item, regexp_extract_all(
            translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
            '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
        FROM benchmark WHERE text IS NOT NULL
    ),
    windows AS (
        SELECT DISTINCT item, least(len(w), 10) AS k, unnest(CASE WHEN len(w) < 10 THEN [array_to_string(w, ' ')]
            ELSE list_transform(range(1, len(w) - 8), lambda i: array_to_string(w[i:i + 9], ' ')) END) AS s
        FROM items WHERE len(w) > 0
    ),
    words AS (
        SELECT doc_id, regexp_extract_all(
            translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
            '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
        FROM documents
    ),
    lengths AS (SELECT DISTINCT k FROM windows),
    places AS (
        SELECT doc_id, k, unnest(range(1, len(w) - k + 2)) AS i, w FROM words, lengths WHERE len(w) >= k
    ),
    hits AS (
        SELECT doc_id, p.k, i, item FROM places p JOIN windows x ON x.k = p.k AND x.s = array_to_string(w[i:i + p.k - 1], ' ')
    ),
    covered AS (SELECT doc_id, count(DISTINCT pos) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + k)) AS pos FROM hits) GROUP BY 1),
    named AS (
        SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
        FROM (SELECT DISTINCT doc_id, item FROM hits) GROUP BY 1
    )
    SELECT doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
           sha256(coalesce(items, '')) AS items_sha256, n_hit IS NOT NULL AS contaminated
    FROM words LEFT JOIN covered USING (doc_id) LEFT JOIN named USING (doc_id)
    """
)
def op10_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    return hit_digest(decontaminate.find_contamination(documents, table(spark, sf_dir, "benchmark")))


def hit_digest(found: DataFrame) -> DataFrame:
    n_hit = F.aggregate("_spans", F.lit(0), lambda total, span: total + span["end"] - span["first"]).cast("long")
    return found.select(
        "doc_id",
        F.col("_n_words").alias("n_words"),
        n_hit.alias("n_hit"),
        F.size("_items").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", "_items"), 256).alias("items_sha256"),
        (n_hit > 0).alias("contaminated"),
    )


@query()
def op4_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = quality.fit_quality(documents, table(spark, sf_dir, "labels"))
    return quality.score_quality(documents, model).select(
        "doc_id",
        quality.held_out("doc_id").alias("held_out"),
        F.col("_score").alias("score"),
        (F.col("_score") >= 0.5).cast("int").alias("predicted"),
    )


@query(
    """
    WITH vectors AS (
        SELECT row_number() OVER () AS place, vec_id,
               list_transform(embedding, lambda x: CAST(floor(64 * CAST(x AS DOUBLE)) AS BIGINT)) AS q
        FROM embeddings
        WHERE vec_id IS NOT NULL AND len(embedding) > 0
          AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    ),
    scored AS (
        SELECT a.place, a.vec_id AS query_id, b.vec_id,
               CAST(list_sum(list_transform(range(1, len(a.q) + 1), lambda i: a.q[i] * b.q[i])) AS BIGINT) AS score
        FROM vectors a JOIN vectors b ON a.place <> b.place AND len(a.q) = len(b.q) WHERE a.vec_id % 20 = 0
    ),
    ranked AS (
        SELECT query_id, row_number() OVER (PARTITION BY place ORDER BY score DESC, vec_id) AS rank, vec_id, score FROM scored
    )
    SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM ranked WHERE rank <= 20
    """
)
def op9_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    embeddings = table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    return topk.top_k(embeddings, F.col("vec_id") % 20 == 0, 20)


@query()
def op3_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    return span_digest(secret_scan.scan_secrets(documents, secret_scan.fit_secret_net(documents)))


def span_digest(scanned: DataFrame) -> DataFrame:
    def joined(spans: str) -> F.Column:
        return F.concat_ws(",", F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])))

    def count(kind: str) -> F.Column:
        return F.size(F.filter("_base", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    return scanned.select(
        "doc_id", *map(count, ("assign", "access", "hex")), F.sha2(joined("_base"), 256).alias("base_sha256"), joined("_spans").alias("spans")
    )


@query(
    rf"""
    WITH words AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
    windows AS (
        SELECT doc_id, i, array_to_string(w[i:i + 19], ' ') AS s
        FROM (SELECT doc_id, w, unnest(range(1, len(w) - 18)) AS i FROM words WHERE len(w) >= 20)
    ),
    later AS (
        SELECT doc_id, i FROM (SELECT doc_id, i, row_number() OVER (PARTITION BY s ORDER BY doc_id, i) AS r FROM windows)
        WHERE r > 1
    ),
    gone AS (SELECT DISTINCT doc_id, unnest(range(i, i + 20)) AS i FROM later),
    placed AS (SELECT doc_id, unnest(w) AS word, generate_subscripts(w, 1) AS i FROM words),
    kept AS (
        SELECT p.doc_id, count(*) AS n, string_agg(word, ' ' ORDER BY p.i) AS text
        FROM placed p ANTI JOIN gone g ON p.doc_id = g.doc_id AND p.i = g.i GROUP BY p.doc_id
    )
    SELECT words.doc_id, len(w) AS n_words, len(w) - coalesce(n, 0) AS n_removed, sha256(coalesce(text, '')) AS kept_sha256
    FROM words LEFT JOIN kept USING (doc_id)
    """
)
def op6_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    return substring_dedup.remove_repeats(documents).select(
        "doc_id",
        F.col("_n_words").alias("n_words"),
        F.col("_n_removed").alias("n_removed"),
        F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256"),
    )


@query()
def op7_pii_surrogates(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    replaced = pii.replace_pii(documents, key=b"surrogates of the test tables")
    return replaced.select(
        "doc_id",
        F.size("_entities").cast("long").alias("n_entities"),
        F.concat_ws(",", F.transform("_entities", lambda e: F.concat_ws(":", e["kind"], e["start"], e["end"]))).alias("spans"),
        "text",
    )


#: The CRC-32 of a list of bytes in hexadecimal digits, a column named bytes, by the table of the reversed polynomial.
_CRC_TABLE = """
    SELECT list(list_reduce(range(8), lambda c, i: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, n) ORDER BY n) AS t
    FROM range(256) AS x(n)
"""
_CRC = """xor(list_reduce(list_transform(regexp_extract_all(hex(encode(bytes)), '..'), lambda h: ('0x' || h)::BIGINT),
    lambda c, b: xor(c >> 8, t[1 + (xor(c, b) & 255)]), 4294967295::BIGINT), 4294967295)"""


@query(
    f"""
    WITH RECURSIVE crc AS ({_CRC_TABLE}),
    placed AS (
        SELECT doc_id, coalesce(text, '') AS bytes, row_number() OVER (ORDER BY doc_id NULLS FIRST, md5(text) NULLS FIRST) - 1 AS number,
               count(*) OVER () AS n
        FROM documents
    ),
    grid AS (SELECT n, CAST(floor(sqrt(n - 1)) AS BIGINT) + 1 AS high FROM placed LIMIT 1),
    cells AS (SELECT n, high, (n + high - 1) // high AS low FROM grid),
    steps AS (
        SELECT number, 0 AS step, number // low AS h, number % low AS l FROM placed, cells
        UNION ALL
        SELECT number, step + 1,
               CASE WHEN step % 2 = 0 THEN (h + ('0x' || substr(md5('{sharding.SEED}:' || step % {sharding.ROUNDS} || ':' || l), 1, 15))::BIGINT % high) % high
                    ELSE h END,
               CASE WHEN step % 2 = 1 THEN (l + ('0x' || substr(md5('{sharding.SEED}:' || step % {sharding.ROUNDS} || ':' || h), 1, 15))::BIGINT % low) % low
                    ELSE l END
        FROM steps, cells WHERE step = 0 OR step % {sharding.ROUNDS} <> 0 OR h * low + l >= n
    ),
    ends AS (
        SELECT number, h * low + l AS place FROM steps, cells WHERE step > 0 AND step % {sharding.ROUNDS} = 0 AND h * low + l < n
    )
    SELECT doc_id, octet_length(encode(bytes)) + 1 AS size, {_CRC} AS text_crc32, 'rows' AS law,
           CAST(place % {sharding.SHARDS} AS INTEGER) AS shard, place // {sharding.SHARDS} AS slot, CAST(NULL AS INTEGER) AS grown_shard
    FROM placed JOIN ends USING (number), crc
    """
)
def op11_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Equal texts are rows like any other: the law is that of the rows, whatever they hold."""
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    text = F.coalesce("document.text", F.lit(""))
    return sharding.shard_documents(documents).select(
        "document.doc_id",
        (F.octet_length(text) + 1).cast("long").alias("size"),
        F.crc32(text).alias("text_crc32"),
        F.lit("rows").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def _added(path: str, cost: int | str, letters: str) -> str:
    """A path, twelve digits of cost and the audit, with more of both; NULL stays NULL."""
    return f"(lpad(CAST(substr({path}, 1, 12)::BIGINT + {cost} AS VARCHAR), 12, '0') || substr({path}, 13) || '{letters}')"


_ADD_REROLE = f"{repair.REROLE} + extra"
_MAY = "CASE WHEN may THEN {} END"
_BY_ROW = {
    "s0": _added("s0", repair.DELETE, "D"),
    "s1": f"least({_added('s1', repair.DELETE, 'D')}, CASE WHEN may AND initial = 's' THEN {_added('s0', 'extra', 'K')} END)",
    "s2": "least(" + ", ".join(
        [_added("b2", repair.DELETE, "D")]
        + [_MAY.format(_added(s, _ADD_REROLE, "R")) for s in ("s0", "s1", "b3")]
        + [f"CASE WHEN may AND initial = 'u' THEN {_added(s, 'extra', 'K')} END" for s in ("s0", "s1", "b3")]
    ) + ")",
    "s3": f"least({_added('b3', repair.DELETE, 'D')}, {_MAY.format(_added('b2', _ADD_REROLE, 'R'))}, "
          f"CASE WHEN may AND initial = 'a' THEN {_added('b2', 'extra', 'K')} END)",
}
_B2 = "least(s2, " + ", ".join(_added(s, repair.INSERT, "I") for s in ("s0", "s1", "s3")) + ")"
_B3 = f"least(s3, {_added('b2', repair.INSERT, 'I')})"


@query(
    rf"""
    WITH RECURSIVE crc AS ({_CRC_TABLE}),
    keyed AS (
        SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
               coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ') AS bytes
        FROM conversations
    ),
    kinds AS (SELECT conv_id, turn, role, text, {_CRC} % 20 AS kind FROM keyed, crc),
    damaged AS (
        SELECT conv_id, turn, CASE kind WHEN 4 THEN 'user' ELSE role END AS role,
               CASE kind WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text
        FROM kinds, range(2) AS copies(copy) WHERE kind <> 0 AND (copy = 0 OR kind = 3)
    ),
    ranked AS (
        SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS i, substr(role, 1, 1) AS initial
        FROM damaged
    ),
    faults AS (
        SELECT *, CASE WHEN NOT regexp_matches(text, '[^ 	-
]') THEN 'blank'
                       WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 THEN 'duplicate'
                       WHEN NOT regexp_matches(text, '[.!?][ 	-
]*\z') THEN 'truncated' END AS fault,
               lag(initial) OVER (PARTITION BY conv_id ORDER BY i) AS before
        FROM ranked
    ),
    turns AS (
        SELECT *, fault IS NULL OR fault = 'truncated' AS may, CASE WHEN fault = 'truncated' THEN {repair.TRUNCATED} ELSE 0 END AS extra
        FROM faults
    ),
    counts AS (
        SELECT conv_id, count(*) AS n, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
               count(*) FILTER (fault = 'blank') AS blank, count(*) FILTER (fault = 'duplicate') AS duplicate,
               count(*) FILTER (fault = 'truncated') AS truncated,
               count(*) FILTER (before IS NOT NULL AND before || initial NOT IN ('su', 'ua', 'au')) AS illegal
        FROM turns GROUP BY conv_id
    ),
    paths AS (
        SELECT conv_id, 0::BIGINT AS i, '000000000000' AS s0, NULL::VARCHAR AS s1, NULL::VARCHAR AS s2, NULL::VARCHAR AS s3 FROM counts
        UNION ALL
        SELECT p.conv_id, t.i, {', '.join(_BY_ROW.values())}
        FROM (SELECT *, {_B3} AS b3 FROM (SELECT *, {_B2} AS b2 FROM paths)) p
        JOIN turns t ON t.conv_id IS NOT DISTINCT FROM p.conv_id AND t.i = p.i + 1
    ),
    ends AS (
        SELECT p.conv_id, least(s0, {_B3}) AS best
        FROM (SELECT *, {_B2} AS b2 FROM paths) p JOIN counts c ON c.conv_id IS NOT DISTINCT FROM p.conv_id AND c.n = p.i
    ),
    audits AS (SELECT conv_id, substr(best, 1, 12)::BIGINT AS cost, substr(best, 13) AS audit FROM ends),
    letters AS (
        SELECT conv_id, unnest(string_split(audit, '')) AS letter, generate_subscripts(string_split(audit, ''), 1) AS spot FROM audits WHERE audit <> ''
    ),
    edits AS (
        SELECT *, count(*) FILTER (letter <> 'I') OVER (PARTITION BY conv_id ORDER BY spot) AS i,
               count(*) FILTER (letter <> 'D') OVER (PARTITION BY conv_id ORDER BY spot) AS out
        FROM letters
    ),
    placed AS (
        SELECT e.conv_id, spot, letter, out, role, text,
               max(CASE WHEN out = 1 AND letter = 'K' AND initial = 's' THEN 1 ELSE 0 END) OVER (PARTITION BY e.conv_id) AS shift
        FROM edits e LEFT JOIN turns t ON t.conv_id IS NOT DISTINCT FROM e.conv_id AND t.i = e.i AND e.letter <> 'I'
        WHERE letter <> 'D'
    ),
    repaired AS (
        SELECT conv_id, string_agg(
            CASE WHEN letter = 'K' THEN role WHEN (out - shift) % 2 = 1 THEN 'user' ELSE 'assistant' END || ':' || coalesce(text, ''), chr(10) ORDER BY spot) AS text
        FROM placed GROUP BY conv_id
    )
    SELECT c.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
           coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, coalesce(cost, 0) AS cost, coalesce(audit, '') AS audit,
           sha256(coalesce(r.text, '')) AS repaired_sha256
    FROM (SELECT DISTINCT conv_id FROM conversations) c
    LEFT JOIN counts n ON n.conv_id IS NOT DISTINCT FROM c.conv_id
    LEFT JOIN audits a ON a.conv_id IS NOT DISTINCT FROM c.conv_id
    LEFT JOIN repaired r ON r.conv_id IS NOT DISTINCT FROM c.conv_id
    """
)
def op12_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    return repair.repair_report(turns, repair.repair(repair.damaged(turns)))


def _leaf_sql(text: str) -> str:
    fields = [f"{name}::VARCHAR" for name in merkle.FIELDS[:-1]] + [text]
    return "sha256(" + " || ".join(f"coalesce(octet_length(encode({f})) || ':' || {f}, '-')" for f in fields) + ")"


@query(
    rf"""
    WITH RECURSIVE crc AS ({_CRC_TABLE}),
    hashed AS (
        SELECT doc_id, source, {_leaf_sql('text')} AS leaf, {_leaf_sql("replace(text, chr(10), '')")} AS altered, doc_id::VARCHAR AS bytes
        FROM documents
    ),
    leaves AS (
        SELECT doc_id, source, leaf, CASE WHEN {_CRC} % 2 = 0 THEN altered ELSE leaf END AS shown,
               row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS i, count(*) OVER (PARTITION BY source) AS n
        FROM hashed, crc
    ),
    nodes AS (
        SELECT source, 0 AS level, i, n, leaf AS digest FROM leaves
        UNION ALL
        SELECT source, level + 1, i // 3, (n + 2) // 3, sha256(string_agg(digest, '' ORDER BY i)) FROM nodes WHERE n > 1
        GROUP BY source, level, i // 3, n
    ),
    subroots AS (SELECT source, level AS height, digest, row_number() OVER (ORDER BY source NULLS FIRST) - 1 AS i FROM nodes WHERE n = 1),
    top AS (
        SELECT 0 AS level, i, count(*) OVER () AS n, digest FROM subroots
        UNION ALL
        SELECT level + 1, i // 3, (n + 2) // 3, sha256(string_agg(digest, '' ORDER BY i)) FROM top WHERE n > 1 GROUP BY level, i // 3, n
    ),
    climbs AS (
        SELECT l.source, l.i, l.shown AS own, 0 AS level, height, CASE height WHEN 0 THEN s.i ELSE l.i END AS spot, s.i AS place, '' AS proof
        FROM leaves l JOIN subroots s ON s.source IS NOT DISTINCT FROM l.source
        UNION ALL
        SELECT c.source, c.i, sha256(lefts || own || rights), c.level + 1, height,
               CASE WHEN c.level + 1 = height THEN place ELSE spot // 3 END, place, proof || lefts || rights
        FROM climbs c, LATERAL (
            SELECT coalesce(string_agg(digest, '' ORDER BY i) FILTER (i < spot), '') AS lefts,
                   coalesce(string_agg(digest, '' ORDER BY i) FILTER (i > spot), '') AS rights, max(n) AS n
            FROM (
                SELECT i, n, digest FROM nodes x WHERE c.level < height AND x.source IS NOT DISTINCT FROM c.source AND x.level = c.level AND x.i // 3 = spot // 3
                UNION ALL
                SELECT i, n, digest FROM top x WHERE c.level >= height AND x.level = c.level - height AND x.i // 3 = spot // 3 AND x.n > 1
            )
        ) WHERE n IS NOT NULL
    ),
    ended AS (SELECT source, i, arg_max(own, level) AS own, arg_max(proof, level) AS proof FROM climbs GROUP BY source, i)
    SELECT doc_id, leaf, s.digest AS subroot, r.digest AS root, sha256(proof) AS proof_sha256, own AS folded_root, own = r.digest AS verified
    FROM leaves l JOIN ended e ON e.source IS NOT DISTINCT FROM l.source AND e.i = l.i
    JOIN subroots s ON s.source IS NOT DISTINCT FROM l.source, (SELECT digest FROM top WHERE n = 1) r
    """
)
def op13_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle_report(table(spark, sf_dir, "documents").select(*merkle.FIELDS))


def merkle_report(documents: DataFrame) -> DataFrame:
    """Every document's proof, and what it proves of the document whose text lost its line feeds where the CRC-32 is even."""
    columns = {name: F.col(name) for name in merkle.FIELDS}
    altered = columns | {"text": F.replace("text", F.lit("\n"), F.lit(""))}
    leaf, other = merkle.leaf_digest(list(columns.values())), merkle.leaf_digest(list(altered.values()))
    shown = F.when(F.crc32(F.col("doc_id").cast("string")) % 2 == 0, other).otherwise(leaf)
    made = merkle.manifest(documents, leaf, carried=F.struct("doc_id", shown.alias("shown")))
    root = F.lit(made.root).cast("string")
    folded = merkle.folded(F.col("carried.shown"), F.col("proof")).alias("folded_root")
    report = made.proofs.select(
        "carried.doc_id", "leaf", "subroot", root.alias("root"), merkle.proof_digest(F.col("proof")).alias("proof_sha256"), folded
    )
    return report.withColumn("verified", F.col("folded_root") == F.col("root"))
