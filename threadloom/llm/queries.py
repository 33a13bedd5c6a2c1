"""One query per operator over its whole table, and the DuckDB SQL of those that SQL can state."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from threadloom.llm import chat, exact, langid, lattice, licenses, mixing, packing, periodic, pii, quality, simhash, trie, warc


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mixture(table(spark, sf_dir, "documents"))


def op2_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    index, folder = warc.archive(table(spark, sf_dir, "pages"))
    return warc.read_archives(index, folder).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op3_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = langid.fit(docs.filter(langid.taught(docs)))
    return docs.select(
        "doc_id", (~langid.taught(docs)).alias("held_out"), langid.predict(F.col("text"), model).alias("_p")
    ).select("doc_id", "held_out", F.col("_p.lang").alias("lang_pred"), F.col("_p.score").alias("score"))


def op4_lattice(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lattice.near_vectors(table(spark, sf_dir, "embeddings"))


def op5_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


def conversation_messages(conversations: DataFrame) -> DataFrame:
    """Each conversation as a reply chain by turn (ties by role and text); a message's score is the length of its text."""
    order = Window.partitionBy("conv_id").orderBy("turn", "role", "text")
    place = F.row_number().over(order)
    return conversations.select(
        F.col("conv_id").alias("tree"), place.alias("node"), F.when(place > 1, place - 1).alias("parent"), "role", "text",
        F.length("text").alias("score"),
    )


def op6_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    given = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    extra = spark.range(2).select(
        F.lit(-7).cast("long"), F.col("id"), F.when(F.col("id") == 0, "user").otherwise("assistant"), F.lit(r"\### Assistant: </turn> ok")
    )
    formatted = chat.format_paths(chat.reply_paths(conversation_messages(given.union(extra)), branches=1))
    turns = chat.read_turns(F.col("formatted"))
    said = F.concat_ws("", F.transform(turns, lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))))
    loss = chat.loss_text(F.col("formatted"), F.col("loss_spans"))
    return formatted.select(
        F.col("tree").alias("conv_id"), F.size(turns).cast("long").alias("n_turns"), F.sha2(said, 256).alias("turns_sha256"),
        F.length(loss).cast("long").alias("loss_chars"), F.sha2(loss, 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )


def op7_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    labels = table(spark, sf_dir, "labels").select("doc_id", F.col("quality").cast("double").alias("label"))
    return quality.score(table(spark, sf_dir, "documents"), labels, F.col("source"), F.col("lang"))


def op8_exact(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact.exact_groups(table(spark, sf_dir, "documents"))


def op9_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.packed_pieces(table(spark, sf_dir, "documents"))


def op10_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(table(spark, sf_dir, "documents"), licenses.template_rows(spark))


def op11_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trie.prefix_trie(*trie.rebuilt(table(spark, sf_dir, "conversations")))


def op12_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    base = F.filter("spans", lambda s: s["base"])
    counts = [F.size(F.filter(base["kind"], lambda k: k == kind)).cast("long").alias(f"n_{kind}") for kind in pii.KINDS]  # noqa: B023
    return pii.find(docs, pii.fit(docs)).select("doc_id", *counts, F.sha2(pii.spelled(base), 256).alias("base_sha256"), pii.spelled(F.col("spans")).alias("spans"))


def op13_periodic(spark: SparkSession, sf_dir: str) -> DataFrame:
    return periodic.periodic_runs(table(spark, sf_dir, "documents"), planted=True)


QUERIES = {
    "op1_mixing": op1_mixing,
    "op2_warc": op2_warc,
    "op3_language": op3_language,
    "op4_lattice": op4_lattice,
    "op5_simhash": op5_simhash,
    "op6_chat": op6_chat,
    "op7_quality": op7_quality,
    "op8_exact": op8_exact,
    "op9_packing": op9_packing,
    "op10_licenses": op10_licenses,
    "op11_trie": op11_trie,
    "op12_pii": op12_pii,
    "op13_periodic": op13_periodic,
}


def _template_values() -> str:
    """The templates as SQL rows."""
    quote = lambda x: "'" + x.replace("'", "''") + "'"
    rows = [(name, i, text) for name, texts in licenses.TEMPLATES.items() for i, text in enumerate(texts)]
    return ",\n    ".join(f"({quote(name)}, {i}, {quote(text)})" for name, i, text in rows)


SQL = {
    "op1_mixing": r"""
WITH rows AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size,
    coalesce(doc_id::VARCHAR, 'null:' || md5(coalesce(text, ''))) AS name FROM documents
), sizes AS (
  SELECT source, sum(size)::BIGINT AS size,
    CASE (row_number() OVER (ORDER BY source ASC NULLS LAST) - 1) % 3 WHEN 0 THEN 3.0 WHEN 1 THEN 1.0 ELSE 2.0 END::DOUBLE AS weight
  FROM rows GROUP BY source
), levels AS (
  SELECT *, size * 2.0::DOUBLE AS cap, CASE WHEN size > 0 THEN size * 2.0::DOUBLE / weight ELSE -1 END AS level,
    CASE WHEN size > 0 THEN weight ELSE 0 END AS open_weight, sum(size) OVER () * 1.5::DOUBLE AS total FROM sizes
), shares AS (
  SELECT source, size, cap, level, open_weight,
    (total - coalesce(sum(cap) OVER (ORDER BY level, source ASC NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
      / nullif(sum(open_weight) OVER (ORDER BY level, source ASC NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING), 0) AS share
  FROM levels
), water AS (
  SELECT arg_min(share, level) AS share FROM shares WHERE level > share
), targets AS (
  SELECT s.source, s.size, least(s.cap, coalesce(s.open_weight * w.share, s.cap)) AS target FROM shares s, water w
), rated AS (
  SELECT r.doc_id, r.source, r.size, t.size AS source_size, t.target, coalesce(t.target / nullif(t.size, 0), 0) AS rate,
    ('0x' || substr(md5('0:' || r.name), 1, 13))::BIGINT / 4503599627370496.0::DOUBLE AS u
  FROM rows r JOIN targets t ON r.source IS NOT DISTINCT FROM t.source
)
SELECT doc_id, source, size, source_size, target,
  (floor(rate) + (u < rate - floor(rate))::INT)::BIGINT AS copies, size * (floor(rate) + (u < rate - floor(rate))::INT)::BIGINT AS taken
FROM rated""",
    "op8_exact": r"""
WITH rows AS (
  SELECT doc_id, coalesce(text, '') AS text, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', '', 'g') AS plain FROM documents
), ranked AS (
  SELECT doc_id, sha256(plain) AS text_sha256, count(*) OVER (PARTITION BY plain) AS group_size,
    first_value(doc_id) OVER (PARTITION BY plain ORDER BY length(text) DESC, doc_id ASC NULLS LAST) AS keep_id,
    row_number() OVER (PARTITION BY plain ORDER BY length(text) DESC, doc_id ASC NULLS LAST) AS place
  FROM rows
)
SELECT doc_id, keep_id, group_size, place = 1 AS kept, text_sha256 FROM ranked""",
    "op2_warc": r"""
WITH rows AS (
  SELECT page_id, coalesce(html, '') AS html FROM pages
), marked AS (
  SELECT page_id, octet_length(encode(html)) AS payload_bytes, sha1(html) AS digest,
    first_value(page_id) OVER (PARTITION BY html ORDER BY page_id NULLS LAST) AS first_id,
    row_number() OVER (PARTITION BY html ORDER BY page_id NULLS LAST) AS place FROM rows
)
SELECT page_id, payload_bytes::BIGINT AS payload_bytes,
  array_to_string([
    substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', ((('0x' || substr(digest, (i // 4) * 5 + 1, 5))::INT >> (15 - 5 * (i % 4))) & 31)::INT + 1, 1)
    FOR i IN range(32)], '') AS payload_digest,
  CASE WHEN place > 1 THEN 'revisit' ELSE 'response' END AS record_type, CASE WHEN place > 1 THEN first_id END AS refers_to
FROM marked""",
    "op6_chat": r"""
WITH rows AS (
  SELECT conv_id, turn, role, text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok' UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'
), clean AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text,
    row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role NULLS FIRST, text NULLS FIRST) AS place FROM rows
), joined AS (
  SELECT conv_id, count(*) AS n_turns, string_agg(role || chr(10) || text || chr(10), '' ORDER BY place) AS said,
    coalesce(string_agg(text, '' ORDER BY place) FILTER (role = 'assistant'), '') AS loss,
    sum(24 + length(replace(replace(role, '\', '\\'), '<|', '<\|')) + length(replace(replace(text, '\', '\\'), '<|', '<\|'))) AS chars
  FROM clean GROUP BY conv_id
)
SELECT conv_id, n_turns, sha256(said) AS turns_sha256, length(loss)::BIGINT AS loss_chars, sha256(loss) AS loss_sha256,
  chars::BIGINT AS formatted_chars FROM joined""",
    "op10_licenses": r"""
WITH templates(license, template, text) AS (
  VALUES
    TEMPLATES
), texts AS (
  SELECT doc_id, row_number() OVER () AS text_no, string_split(trim(regexp_replace(lower(text), '[^\p{L}\p{N}]+', ' ', 'g')), ' ') AS words
  FROM documents WHERE text IS NOT NULL
), ours AS (
  SELECT doc_id, text_no, len(words) - 1 AS n, unnest(range(1, len(words))) AS place, unnest([words[i] || ' ' || words[i + 1] FOR i IN range(1, len(words))]) AS bigram
  FROM texts
), split AS (
  SELECT license, template, string_split(trim(regexp_replace(lower(text), '[^\p{L}\p{N}]+', ' ', 'g')), ' ') AS words FROM templates
), theirs AS (
  SELECT license, template, n AS m, bigram, count(*) AS k FROM (
    SELECT license, template, len(words) - 1 AS n, unnest([words[i] || ' ' || words[i + 1] FOR i IN range(1, len(words))]) AS bigram FROM split
  ) GROUP BY ALL
), met AS (
  SELECT o.doc_id, o.text_no, o.n, o.place, o.bigram, t.license, t.template, t.m, t.k, count(*) OVER (PARTITION BY o.text_no, t.license, t.template) AS hits
  FROM ours o JOIN theirs t USING (bigram)
), hits AS (
  SELECT * FROM met WHERE 3 * hits >= 2 * m
), counted AS (
  SELECT s.doc_id, s.text_no, s.license, s.template, s.m, s.place, least(s.m, s.n + 1 - s.place) AS size, h.bigram, h.k, count(*) AS ours
  FROM hits s JOIN hits h ON h.text_no = s.text_no AND h.license = s.license AND h.template = s.template AND h.place >= s.place AND h.place < s.place + s.m GROUP BY ALL
), scored AS (
  SELECT doc_id, text_no, license, place, size, 2.0::DOUBLE * sum(least(ours, k)) / (size + m) AS dice
  FROM counted GROUP BY doc_id, text_no, license, template, m, place, size HAVING dice >= 0.8
), reached AS (
  SELECT *, max(place + size) OVER (PARTITION BY text_no, license ORDER BY place RANGE BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS reach FROM scored
)
SELECT doc_id, license, max(dice) AS dice, count(DISTINCT place) FILTER (reach IS NULL OR reach <= place) AS statements FROM reached GROUP BY doc_id, text_no, license""".replace("TEMPLATES", _template_values()),
    "op11_trie": r"""
WITH own AS (
  SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
    row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) - 1 AS place
  FROM conversations WHERE conv_id IS NOT NULL
), crc AS (
  SELECT [list_reduce([i::BIGINT] || range(8), lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) FOR i IN range(256)] AS steps
), sizes AS (
  SELECT conv_id, count(*) AS n, conv_id - conv_id % 5 AS base, xor(list_reduce(
      [4294967295::BIGINT] || [ord(x)::BIGINT FOR x IN string_split(conv_id::VARCHAR, '')], lambda c, x: xor(c >> 8, steps[(xor(c, x) & 255) + 1])
    ), 4294967295) % 9 AS h
  FROM own, crc GROUP BY conv_id, steps
), moved AS (
  SELECT s.conv_id, s.base, s.h, least(s.h, coalesce(b.n, 0)) AS m FROM sizes s LEFT JOIN sizes b ON b.conv_id = s.base
), turns AS (
  SELECT m.conv_id, o.place, o.role, o.text FROM moved m JOIN own o ON o.conv_id = m.base AND o.place < m.h
  UNION ALL SELECT o.conv_id, o.place + m.m - m.h, o.role, o.text FROM own o JOIN moved m USING (conv_id) WHERE o.place >= m.h
), members AS (
  SELECT conv_id, place + 1 AS depth, octet_length(encode(text)) AS bytes, place + 1 = count(*) OVER (PARTITION BY conv_id) AS last,
    string_agg(md5(length(role) || ':' || role || text), '') OVER (PARTITION BY conv_id ORDER BY place) AS prefix
  FROM turns
  UNION ALL SELECT conv_id, 0, 0, conv_id NOT IN (SELECT conv_id FROM turns), '' FROM sizes
), nodes AS (
  SELECT depth, prefix, min(conv_id) AS conv_id, count(*) AS n_convs, max(bytes) AS bytes,
    sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (last), '')) AS ends_sha256
  FROM members GROUP BY depth, prefix
), linked AS (
  SELECT n.*, p.conv_id AS parent_conv_id, p.prefix AS above FROM nodes n LEFT JOIN nodes p ON p.depth = n.depth - 1 AND starts_with(n.prefix, p.prefix)
), families AS (
  SELECT above AS prefix, count(*) AS n_children FROM linked WHERE above IS NOT NULL GROUP BY above
), whole AS (
  SELECT l.*, coalesce(f.n_children, 0) AS n_children FROM linked l LEFT JOIN families f USING (prefix)
)
SELECT a.conv_id, a.depth, a.parent_conv_id, a.n_convs, a.n_children, count(*) FILTER (b.n_children = 0) AS n_leaves,
  sum((b.n_convs - 1) * b.bytes)::BIGINT AS saved_tokens, a.ends_sha256
FROM whole a JOIN whole b ON starts_with(b.prefix, a.prefix) GROUP BY ALL""",
}
