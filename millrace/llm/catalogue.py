"""The queries of this subpackage, each on its whole table, and their SQL where SQL can say the same."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm import decontaminate, lines, merkle, mixing, mtree, quality, rules, sharding, simhash, spelling, substrings, toxicity, warc
from millrace.llm.shared import shared_folder, table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None):
    """Register a query under its function's name, with its SQL if there is any."""

    def register(fn):
        QUERIES[fn.__name__] = fn
        if sql:
            SQL[fn.__name__] = sql
        return fn

    return register


# A-Z lower-cased and nothing else
_LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


@query()
def op1_simhash(spark: SparkSession, folder: str) -> DataFrame:
    """Near-duplicate group of every document."""
    found = simhash.near_duplicates(table(spark, folder, "documents"))
    return found.select("doc_id", simhash.hex_fingerprint(F.col("fp")).alias("fingerprint"), "component_id")


@query(f"""
    WITH split AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS ls FROM documents),
    line AS (SELECT doc_id, unnest(ls) AS line, unnest(range(1, len(ls) + 1)) AS pos FROM split),
    keyed AS (
        SELECT *, {_LOWER.format("trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13))")} AS key FROM line),
    firsts AS (SELECT key, min(doc_id) AS first FROM keyed WHERE length(key) >= 10 GROUP BY key),
    marked AS (
        SELECT keyed.*, coalesce(keyed.doc_id > firsts.first, false) AS gone FROM keyed LEFT JOIN firsts ON keyed.key = firsts.key)
    SELECT doc_id, count(*) AS n_lines, CAST(sum(CASE WHEN gone THEN 1 ELSE 0 END) AS BIGINT) AS n_dropped,
        sha256(coalesce(string_agg(CASE WHEN NOT gone THEN line END, chr(10) ORDER BY pos), '')) AS kept_sha256
    FROM marked GROUP BY doc_id
""")
def op3_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """Lines of every document, and the digest of what stays of it."""
    return lines.kept_text_digests(table(spark, folder, "documents"))


_WORDS = "regexp_extract_all(" + _LOWER.format("coalesce(text, '')") + r", '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"


@query(f"""
    WITH item AS (SELECT CAST(item_id AS VARCHAR) AS item_id, {_WORDS} AS ws FROM benchmark),
    pattern AS (
        SELECT DISTINCT item_id, least(len(ws), 10) AS n, array_to_string(ws[i:i + least(len(ws), 10) - 1], ' ') AS p
        FROM (SELECT item_id, ws, unnest(range(1, greatest(len(ws) - 8, 2))) AS i FROM item WHERE len(ws) > 0)),
    doc AS (SELECT doc_id, {_WORDS} AS ws FROM documents),
    place AS (
        SELECT doc_id, n, i, array_to_string(ws[i:i + n - 1], ' ') AS p
        FROM (SELECT doc_id, ws, n, unnest(range(1, len(ws) - n + 2)) AS i
              FROM doc, (SELECT DISTINCT n FROM pattern) WHERE len(ws) >= n)),
    found AS (SELECT place.doc_id, place.n, place.i, pattern.item_id FROM place JOIN pattern USING (n, p)),
    hit AS (
        SELECT doc_id, count(DISTINCT k) AS n_hit
        FROM (SELECT doc_id, unnest(range(i, i + n)) AS k FROM found) GROUP BY doc_id),
    hit_item AS (
        SELECT doc_id, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS ids
        FROM (SELECT DISTINCT doc_id, item_id FROM found) GROUP BY doc_id)
    SELECT doc_id, CAST(len(ws) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
        sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
    FROM doc LEFT JOIN hit USING (doc_id) LEFT JOIN hit_item USING (doc_id)
""")
def op8_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    """Benchmark items and hit words of every document."""
    found = decontaminate.contamination(table(spark, folder, "documents"), table(spark, folder, "benchmark"))
    return found.select(
        "doc_id", "n_words", "n_hit", F.size("item_ids").cast("long").alias("n_items"),
        F.sha2(F.array_join("item_ids", ","), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"),
    )


@query()
def op4_sharding(spark: SparkSession, folder: str) -> DataFrame:
    """Shard and place in it of every document, near equal bytes in 16 shards, and its shard once there are 17.

    Both maps are versions of one stored table; ``next_shard`` and ``next_version`` are of the rebalanced one.
    """
    docs = table(spark, folder, "documents")
    first, grown = sharding.stored_growth(docs, 16, 17, f"{shared_folder(spark)}/slot_map")
    placed = sharding.place(docs, 16, slot_map=first)
    placed = placed.withColumn("next_shard", grown.column(F.col("virtual_slot"))).withColumn("next_version", F.lit(grown.version))
    return placed.select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", F.col("position").cast("long").alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"), "virtual_slot", "map_version", "next_shard", "next_version",
    )


@query()
def op5_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    """Base statistics of every document and the verdict of the learned list."""
    stats, _ = rules.judged(table(spark, folder, "documents"), table(spark, folder, "labels"))
    return stats.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


@query()
def op10_mixing(spark: SparkSession, folder: str) -> DataFrame:
    """Words the mix takes of every document."""
    mixed = mixing.mix(table(spark, folder, "documents"))
    return mixed.select("doc_id", "size", "source_size", "target", "taken", "copies", "rate")


@query()
def op7_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    """Toxicity score of every document."""
    return toxicity.scored(table(spark, folder, "documents"), table(spark, folder, "labels"))


# base32 of a hex digest: each five of its 160 bits pick a letter
_BITS = "array_to_string(list_transform(range(1, 41), lambda i: substr('0000000100100011010001010110011110001001101010111100110111101111', 4 * (strpos('0123456789abcdef', substr(sha1(payload), i, 1)) - 1) + 1, 4)), '')"


@query(f"""
    WITH page AS (SELECT page_id, coalesce(html, '') AS payload FROM pages),
    bits AS (SELECT page_id, strlen(payload) AS payload_bytes, {_BITS} AS b FROM page),
    digest AS (
        SELECT page_id, payload_bytes, array_to_string(list_transform(range(0, 32), lambda k: substr(
            'ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', CAST(1 + 16 * CAST(substr(b, 5 * k + 1, 1) AS INT) + 8 * CAST(substr(b, 5 * k + 2, 1) AS INT)
            + 4 * CAST(substr(b, 5 * k + 3, 1) AS INT) + 2 * CAST(substr(b, 5 * k + 4, 1) AS INT) + CAST(substr(b, 5 * k + 5, 1) AS INT) AS INT), 1)), '')
            AS payload_digest FROM bits),
    first AS (SELECT *, max(page_id) OVER (PARTITION BY payload_digest) AS first FROM digest)
    SELECT page_id, payload_bytes, payload_digest, CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
        CASE WHEN page_id <> first THEN first END AS refers_to FROM first
""")
def op9_warc(spark: SparkSession, folder: str) -> DataFrame:
    """Every page as an archive record, written and read back."""
    path = f"{shared_folder(spark)}/warc"
    warc.write(table(spark, folder, "pages"), path)
    records = warc.read(spark, path, with_payload=False).where("sound")
    return records.select(
        F.col("record_id").cast("long").alias("page_id"), "payload_bytes", "payload_digest", "record_type",
        F.col("refers_to").cast("long").alias("refers_to"))


_PIECE = r"[^.!?,;:\n]+|[.!?,;:\n]"


@query(f"""
    WITH split AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '{_PIECE}') AS ps FROM documents),
    piece AS (SELECT doc_id, unnest(ps) AS piece, unnest(range(1, len(ps) + 1)) AS pos FROM split),
    placed AS (
        SELECT *, coalesce(sum(length(piece)) OVER (PARTITION BY doc_id ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS start,
            CASE WHEN piece NOT IN ('.', '!', '?', ',', ';', ':', chr(10)) THEN regexp_extract_all({_LOWER.format("piece")}, '[^\\x20\\x09-\\x0D]+') ELSE [] END AS ws
        FROM piece),
    unit AS (
        SELECT doc_id, pos, len(ws) AS n_words, row_number() OVER (PARTITION BY doc_id ORDER BY pos) AS u,
            row_number() OVER (PARTITION BY array_to_string(ws, ' ') ORDER BY doc_id, pos) > 1 AS marked
        FROM placed WHERE len(ws) > 0),
    island AS (SELECT *, u - row_number() OVER (PARTITION BY doc_id ORDER BY u) AS g FROM unit WHERE marked),
    run AS (SELECT doc_id, min(pos) AS low, max(pos) AS high, count(*) AS n FROM island GROUP BY doc_id, g HAVING sum(n_words) >= 25),
    ended AS (
        SELECT run.*, CASE WHEN piece IN ('.', '!', '?', ',', ';', ':', chr(10)) THEN high + 1 ELSE high END AS past
        FROM run LEFT JOIN piece ON piece.doc_id = run.doc_id AND piece.pos = run.high + 1),
    gone AS (
        SELECT placed.doc_id, ended.low, any_value(ended.n) AS n, min(start) AS a, max(start + length(piece)) AS b
        FROM placed JOIN ended ON placed.doc_id = ended.doc_id AND pos BETWEEN low AND past GROUP BY placed.doc_id, ended.low),
    summed AS (
        SELECT doc_id, sum(n) AS n_removed, sum(b - a) AS removed_chars,
            string_agg(CAST(a AS BIGINT) || '-' || CAST(b AS BIGINT), ',' ORDER BY a) AS spans FROM gone GROUP BY doc_id),
    kept AS (
        SELECT placed.doc_id, string_agg(piece, '' ORDER BY pos) AS kept FROM placed
        WHERE NOT EXISTS (SELECT 1 FROM ended WHERE ended.doc_id = placed.doc_id AND pos BETWEEN low AND past) GROUP BY placed.doc_id)
    SELECT d.doc_id, coalesce(n_units, 0) AS n_units, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed, CAST(coalesce(removed_chars, 0) AS BIGINT) AS removed_chars,
        sha256(coalesce(spans, '')) AS spans_sha256, sha256(coalesce(kept, '')) AS kept_sha256
    FROM split d LEFT JOIN summed USING (doc_id) LEFT JOIN kept USING (doc_id)
        LEFT JOIN (SELECT doc_id, count(*) AS n_units FROM unit GROUP BY doc_id) USING (doc_id)
""")
def op6_substring_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """Repeated passages of every document by place, and the digest of what stays of it."""
    found = substrings.deduplicated(table(spark, folder, "documents"))
    span = lambda s: F.concat_ws("-", s["start"], s["end"])
    return found.select(
        "doc_id", "n_units", "n_removed", F.aggregate("removed", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["start"]).alias("removed_chars"),
        F.sha2(F.array_join(F.transform("removed", span), ","), 256).alias("spans_sha256"), F.sha2("kept_text", 256).alias("kept_sha256"))


@query()
def op2_quality_classifier(spark: SparkSession, folder: str) -> DataFrame:
    """Quality score of every document from both views."""
    return quality.co_trained(table(spark, folder, "documents"), table(spark, folder, "labels"))


# Checksum of a text as SQL: eight steps a byte, over the bytes of its hex form.
_CRC_BIT = "xor(CASE WHEN c % 2 = 1 THEN 3988292384 ELSE 0 END, c >> 1)"
_CRC = """xor(list_reduce(list_prepend(CAST(4294967295 AS BIGINT), list_transform(range(1, strlen({0}) + 1), lambda i: CAST(
    16 * (strpos('0123456789ABCDEF', substr(hex({0}), 2 * i - 1, 1)) - 1) + strpos('0123456789ABCDEF', substr(hex({0}), 2 * i, 1)) - 1 AS BIGINT))),
    lambda s, b: list_reduce(list_prepend(xor(s, b), CAST(range(0, 8) AS BIGINT[])), lambda c, k: """ + _CRC_BIT + """)), 4294967295)"""


def _merkle_sql(levels: int) -> str:
    """Trees of up to three to the ``levels`` leaves, level by level, and the fold of every leaf along them."""

    def tree(name: str, first: str) -> str:
        out = [f"{name}0 AS ({first})"]
        for k in range(levels):
            out.append(f"""{name}{k + 1} AS (
                SELECT t, CASE WHEN n = 1 THEN p ELSE p // 3 END AS p, CASE WHEN n = 1 THEN any_value(h) ELSE sha256(string_agg(h, '' ORDER BY p0)) END AS h,
                    (n + 2) // 3 AS n FROM (SELECT t, p, p AS p0, n, h, p // 3 AS up FROM {name}{k}) GROUP BY t, n, up, CASE WHEN n = 1 THEN p ELSE p // 3 END)""")
        return ", ".join(out)

    def climb(name: str, start: str) -> str:
        out = [f"{name}_up0 AS ({start})"]
        for k in range(levels):
            out.append(f"""{name}_up{k + 1} AS (
                SELECT u.r, u.t, u.p // 3 AS p, u.proof || coalesce(s.lows, '') || coalesce(s.highs, '') AS proof,
                    CASE WHEN s.n > 1 THEN sha256(coalesce(s.lows, '') || u.f || coalesce(s.highs, '')) ELSE u.f END AS f
                FROM {name}_up{k} u LEFT JOIN (
                    SELECT a.t, a.p, a.n, string_agg(b.h, '' ORDER BY b.p) FILTER (b.p < a.p) AS lows, string_agg(b.h, '' ORDER BY b.p) FILTER (b.p > a.p) AS highs
                    FROM {name}{k} a JOIN {name}{k} b ON a.t = b.t AND a.p // 3 = b.p // 3 GROUP BY a.t, a.p, a.n) s ON s.t = u.t AND s.p = u.p)""")
        return ", ".join(out)

    def leaf(text: str) -> str:
        fields = ["CAST(doc_id AS VARCHAR)", "source", "lang", "CAST(n_chars AS VARCHAR)", text]
        return "sha256(" + " || ".join(f"coalesce(CAST(strlen({f}) AS VARCHAR) || ':' || {f}, '-')" for f in fields) + ")"

    return f"""
    WITH d AS (
        SELECT doc_id, dense_rank() OVER (ORDER BY source NULLS FIRST) - 1 AS t, {leaf("text")} AS h,
            CASE WHEN {_CRC.format("CAST(doc_id AS VARCHAR)")} % 2 = 0 THEN {leaf("replace(text, chr(10), '')")} ELSE {leaf("text")} END AS f FROM documents),
    placed AS (SELECT *, row_number() OVER (PARTITION BY t ORDER BY doc_id) - 1 AS p, count(*) OVER (PARTITION BY t) AS n FROM d),
    {tree("a", "SELECT t, p, n, h FROM placed")},
    {tree("b", f"SELECT 0 AS t, t AS p, (SELECT count(*) FROM a{levels}) AS n, h FROM a{levels}")},
    {climb("a", "SELECT doc_id AS r, t, p, '' AS proof, f FROM placed")},
    {climb("b", f"SELECT r, 0 AS t, t AS p, proof, f FROM a_up{levels}")}
    SELECT doc_id, placed.h AS leaf, a{levels}.h AS subroot, (SELECT h FROM b{levels}) AS root, sha256(proof) AS proof_sha256, b_up{levels}.f AS folded_root,
        b_up{levels}.f = (SELECT h FROM b{levels}) AS verified
    FROM placed JOIN a{levels} ON a{levels}.t = placed.t JOIN b_up{levels} ON r = doc_id"""


@query(_merkle_sql(11))
def op12_merkle(spark: SparkSession, folder: str) -> DataFrame:
    """Leaf, roots and proof of every document, and what its tampered form folds to."""
    return merkle.manifest(table(spark, folder, "documents"), tampered=merkle.stripped_of_newlines())


_RUNS = "unnest(regexp_extract_all(" + _LOWER.format("coalesce(text, '')") + ", '[a-zÀ-ÿ]+'))"


@query(f"""
    WITH RECURSIVE run AS MATERIALIZED (
        SELECT CAST(doc_id AS VARCHAR) || ':' || r AS k, r, m
        FROM (SELECT doc_id, r, count(*) AS m FROM (SELECT doc_id, {_RUNS} AS r FROM documents) GROUP BY ALL) WHERE length(r) >= 6),
    summed AS MATERIALIZED (SELECT r, m, {_CRC.format("k")} AS h FROM run),
    result AS (SELECT CASE WHEN h % 199 = 0 THEN substr(r, 1, CAST(h % length(r) AS INT)) || substr(r, CAST(h % length(r) AS INT) + 2) ELSE r END AS word, m FROM summed),
    word AS MATERIALIZED (SELECT word, CAST(sum(m) AS BIGINT) AS n FROM result WHERE length(word) >= 6 GROUP BY word HAVING sum(m) >= 5),
    part AS MATERIALIZED (
        SELECT word, n, word AS v, -1 AS i FROM word
        UNION ALL SELECT word, n, substr(word, 1, CAST(i AS INT)) || substr(word, CAST(i AS INT) + 2), i FROM (SELECT word, n, unnest(range(0, length(word))) AS i FROM word)),
    near AS MATERIALIZED (
        SELECT DISTINCT a.word, a.n, b.word AS other, b.n AS other_n FROM part a JOIN part b ON a.v = b.v
        WHERE a.word <> b.word AND (a.i = b.i OR a.i = -1 OR b.i = -1)),
    best AS (SELECT *, row_number() OVER (PARTITION BY word ORDER BY other_n DESC, other) AS r, count(*) OVER (PARTITION BY word) AS n_near FROM near),
    formed AS MATERIALIZED (
        SELECT word.word, word.n, coalesce(n_near, 0) AS n_near, CASE WHEN other_n >= 5 * word.n THEN other END AS form, CASE WHEN other_n >= 5 * word.n THEN other_n END AS form_n
        FROM word LEFT JOIN (SELECT * FROM best WHERE r = 1) b ON b.word = word.word),
    chain AS (
        SELECT word, word AS root, 0 AS d FROM formed
        UNION ALL SELECT chain.word, formed.form, d + 1 FROM chain JOIN formed ON formed.word = chain.root WHERE formed.form IS NOT NULL)
    SELECT formed.word, form, root, n, n_near, form_n
    FROM formed JOIN (SELECT word, arg_max(root, d) AS root FROM chain GROUP BY word) USING (word)
""")
def op13_spelling(spark: SparkSession, folder: str) -> DataFrame:
    """Form and root of every word of all documents."""
    return spelling.variants(table(spark, folder, "documents"), damaged=spelling.DAMAGED)


@query("""
    WITH v AS (
        SELECT vec_id, CAST(list_transform(embedding, lambda x: floor(64 * CAST(x AS DOUBLE))) AS DOUBLE[]) AS v FROM embeddings
        WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
    s AS (
        SELECT q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(q.v, c.v) AS BIGINT) AS score
        FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % 20 = 0)
    SELECT * FROM (SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INT) AS rank, vec_id, score FROM s)
    WHERE rank <= 20
""")
def op11_topk(spark: SparkSession, folder: str) -> DataFrame:
    """The 20 best partners of every twentieth vector."""
    return mtree.top_k(table(spark, folder, "embeddings"), lambda i: i % 20 == 0)
