"""One query for each operator of this package, over whole tables, and its SQL where SQL can express it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tillsight.llm import (
    chat, decontaminate, divergence, filter_audit, licences, line_dedup, mixing, packing, quality_classifier, quality_rules, sharding, simhash,
    suffix_dedup,
)
from tillsight.llm.tables import read, utf8_size


def held_out(doc_id):
    """Rows kept away from training."""
    return F.coalesce(F.pmod(F.crc32(doc_id.cast("string")), F.lit(3)) == 1, F.lit(False))


def quality_model(spark: SparkSession, docs: DataFrame, folder: str) -> quality_classifier.Model:
    labels = read(spark, folder, "labels").filter(~held_out(F.col("doc_id")))
    return quality_classifier.fit(docs, labels)


def op1_decontaminate(spark: SparkSession, folder: str) -> DataFrame:
    found = decontaminate.matches(read(spark, folder, "documents"), read(spark, folder, "benchmark"))
    return found.drop("key")


def op2_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """How much of each document goes, and a digest of what stays."""
    docs = read(spark, folder, "documents").select("doc_id", "text", F.size(F.split("text", "\n")).cast("long").alias("n"))
    removed = F.aggregate("removed_spans", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["start"])
    return line_dedup.dedup_lines(docs).select(
        "doc_id", F.coalesce("n", F.lit(0)).alias("n_lines"), removed.alias("n_removed_lines"),
        F.size("removed_spans").cast("long").alias("n_removed_chunks"),
        F.sha2(F.coalesce("text", F.lit("")).cast("binary"), 256).alias("kept_sha256"))


def op3_sharding(spark: SparkSession, folder: str) -> DataFrame:
    docs = read(spark, folder, "documents").withColumn("size", utf8_size(F.col("text")) + 1)
    docs = docs.withColumn("text_crc32", F.crc32(F.coalesce("text", F.lit("")).cast("binary")))
    placed = sharding.shards(docs, 8, keep=["doc_id", "size", "text_crc32"])
    return placed.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
                         F.lit(None).cast("int").alias("grown_shard"))


def op4_chat_format(spark: SparkSession, folder: str) -> DataFrame:
    tricky = "\\### Assistant: </turn> ok"
    turns = read(spark, folder, "conversations").select("conv_id", "turn", "role", "text").unionByName(
        spark.range(2).select(F.lit(-7).cast("long").alias("conv_id"), F.col("id").alias("turn"),
                              F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
                              F.lit(tricky).alias("text")))
    done = chat.format_conversations(turns)
    told = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    masked = F.transform("loss_spans", lambda s: chat.unescape(
        F.substr(F.col("formatted"), (s["start"] + 1).cast("int"), (s["end"] - s["start"]).cast("int"))))
    done = done.withColumn("loss", F.array_join(masked, ""))
    return done.select("conv_id", F.size("turns").cast("long").alias("n_turns"), F.sha2(told, 256).alias("turns_sha256"),
                       F.char_length("loss").cast("long").alias("loss_chars"), F.sha2("loss", 256).alias("loss_sha256"),
                       F.char_length("formatted").cast("long").alias("formatted_chars"))


def op5_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    found = quality_rules.judge(read(spark, folder, "documents"))
    return found.select("doc_id", *quality_rules.STATS, "base_failed", "kept")


def op6_mixing(spark: SparkSession, folder: str) -> DataFrame:
    return mixing.mix(read(spark, folder, "documents").select("doc_id", "source"))


def op7_suffix_dedup(spark: SparkSession, folder: str) -> DataFrame:
    done = suffix_dedup.without_repeats(read(spark, folder, "documents"), 100)
    removed = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["b"] - s["a"])
    return done.select("doc_id", "n_bytes", removed.alias("n_removed"), F.size("spans").cast("long").alias("n_spans"),
                       F.sha2("kept", 256).alias("kept_sha256"))


def op8_simhash_near_dedup(spark: SparkSession, folder: str) -> DataFrame:
    found = simhash.near_copies(read(spark, folder, "documents"), shingle=4, max_bits=4)
    return found.select("doc_id", F.lower(F.lpad(F.hex("fingerprint"), 16, "0")).alias("fingerprint"), "component_id")


def op9_licence_scan(spark: SparkSession, folder: str) -> DataFrame:
    found = licences.scan(read(spark, folder, "documents"))
    return found.select("doc_id", F.array_join("licences", ",").alias("licences"),
                        F.array_join("sentence_ids", ",").alias("sentence_ids"), "n_sentences")


def op10_quality_classifier(spark: SparkSession, folder: str) -> DataFrame:
    docs = read(spark, folder, "documents")
    model = quality_model(spark, docs, folder)
    scored = docs.select("doc_id", held_out(F.col("doc_id")).alias("held_out"),
                         quality_classifier.scorer(docs, model).alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def op11_packing(spark: SparkSession, folder: str) -> DataFrame:
    """Pieces of the packed sequences, with a digest of their ids."""
    import public_tokenizers

    packed = packing.pack(read(spark, folder, "documents"), public_tokenizers.path("word_bpe_49k.json"), end_id=2, width=4096)
    return packed.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


def op12_divergence(spark: SparkSession, folder: str) -> DataFrame:
    return divergence.audit(read(spark, folder, "documents"))


def op13_filter_audit(spark: SparkSession, folder: str) -> DataFrame:
    found = filter_audit.audit(read(spark, folder, "documents"), read(spark, folder, "labels"))
    return found.drop("filter")


QUERIES = {f.__name__: f for f in (
    op1_decontaminate, op2_line_dedup, op3_sharding, op4_chat_format, op5_quality_rules, op6_mixing,
    op7_suffix_dedup, op8_simhash_near_dedup, op9_licence_scan, op10_quality_classifier, op11_packing, op12_divergence, op13_filter_audit)}

_OP2 = r"""
WITH d AS (SELECT doc_id, text, string_split(coalesce(text, ''), chr(10)) AS ls FROM documents),
l AS (SELECT doc_id, unnest(range(0, len(ls))) AS i, unnest(ls) AS line FROM d),
p AS (SELECT doc_id, i AS a, lead(i) OVER w + 1 AS b, line || chr(10) || lead(line) OVER w AS two FROM l
      WHERE regexp_matches(line, '[^\x20\x09-\x0D]') WINDOW w AS (PARTITION BY doc_id ORDER BY i)),
gone AS (SELECT doc_id, a, b FROM p WHERE b IS NOT NULL QUALIFY row_number() OVER (PARTITION BY two ORDER BY doc_id, a) > 1),
opens AS (SELECT *, coalesce(a >= lag(b) OVER (PARTITION BY doc_id ORDER BY a), TRUE) AS opens FROM gone),
spans AS (SELECT doc_id, min(a) AS a, max(b) AS b FROM
          (SELECT *, count(*) FILTER (opens) OVER (PARTITION BY doc_id ORDER BY a) AS span FROM opens) GROUP BY doc_id, span),
cut AS (SELECT doc_id, sum(b - a) AS lines, count(*) AS chunks FROM spans GROUP BY doc_id),
kept AS (SELECT doc_id, string_agg(line, chr(10) ORDER BY i) AS text FROM l
         WHERE NOT EXISTS (SELECT 1 FROM spans WHERE spans.doc_id = l.doc_id AND a <= i AND i < b) GROUP BY doc_id)
SELECT d.doc_id, CASE WHEN d.text IS NULL THEN 0 ELSE len(ls) END::BIGINT AS n_lines, coalesce(lines, 0)::BIGINT AS n_removed_lines,
       coalesce(chunks, 0)::BIGINT AS n_removed_chunks, sha256(coalesce(kept.text, '')) AS kept_sha256
FROM d LEFT JOIN cut USING (doc_id) LEFT JOIN kept USING (doc_id)
"""

_OP4 = r"""
WITH t AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
           UNION ALL SELECT -7, unnest([0, 1]), unnest(['user', 'assistant']), '\### Assistant: </turn> ok'),
e AS (SELECT *, replace(replace(text, '</turn>', '\t'), '### ', '\h') AS controls,
             replace(replace(replace(text, '\', '\b'), '</turn>', '\t'), '### ', '\h') AS everything,
             replace(replace(replace(replace(role, '\', '\b'), '</turn>', '\t'), '### ', '\h'), ':', '\c') AS r FROM t),
f AS (SELECT *, CASE
        WHEN NOT contains(text, '</turn>') AND NOT contains(text, '### ')
             AND NOT regexp_matches(text, '\\[thb]') THEN text
        WHEN replace(replace(replace(controls, '\t', '</turn>'), '\h', '### '), '\b', '\') = text
             AND NOT contains(controls, '</turn>') AND NOT contains(controls, '### ') THEN controls
        ELSE everything END AS escaped FROM e)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
       coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
       sum(length('### ' || r || ': ' || escaped || '</turn>' || chr(10)))::BIGINT AS formatted_chars
FROM f GROUP BY conv_id
"""


def _op9() -> str:
    quoted = lambda x: "'" + x.replace("'", "''") + "'"
    known = licences.known_sentences()
    exact = ", ".join(f"{quoted(t)}: {quoted(i)}" for t, i in known)
    inner = ", ".join(f"{{'t': {quoted(t)}, 'i': {quoted(i)}}}" for t, i in known if len(t) >= licences.LONG)
    cleaned = "coalesce(text, '')"
    for found, put in licences.CLEANED:
        put = put.replace("$1", "\\1").replace("\n", "' || chr(10) || '")
        cleaned = f"regexp_replace({cleaned}, {quoted(found)}, '{put}', 'g')"
    listed = [(name, "".join(f"{i} " for i in ids)) for name, ids in licences.rules()]
    pattern = "|".join(f"({ids})" for _, ids in listed)
    names = ", ".join(f"{quoted(ids)}: {quoted(name)}" for name, ids in listed)
    return f"""
WITH known AS (SELECT MAP {{{exact}}} AS exact, [{inner}] AS inner_),
p AS (SELECT doc_id, row_number() OVER () AS r, regexp_split_to_array({cleaned}, {quoted(licences.PARAGRAPH_END)}) AS parts FROM documents),
q AS (SELECT r, doc_id, unnest(parts) AS part, unnest(range(0, len(parts))) AS i FROM p),
s AS (SELECT r, doc_id, i, part, regexp_split_to_array(part, {quoted(licences.SENTENCE_END)}) AS together,
             regexp_split_to_array(part, {quoted(licences.LINE_END)}) AS by_line FROM q),
u AS (SELECT r, i, 0 AS way, unnest(together) AS sentence, unnest(range(0, len(together))) AS k FROM s
      UNION ALL SELECT r, i, 1, unnest(by_line), unnest(range(0, len(by_line))) FROM s WHERE contains(part, chr(10))),
n AS (SELECT r, i, way, k, trim(regexp_replace(lower(sentence), '[^a-z0-9]+', ' ', 'g')) AS sentence FROM u),
f AS (SELECT r, i, way, k, sentence,
             CASE WHEN exact[sentence] IS NOT NULL THEN [exact[sentence]] WHEN length(sentence) <= {licences.LONG} THEN [] ELSE
               list_transform(list_sort(list_transform(list_filter(inner_, lambda x: contains(sentence, x.t)),
                 lambda x: {{'at': instr(sentence, x.t), 'i': x.i}})), lambda x: x.i) END AS ids FROM n, known),
w AS (SELECT r, i, way, flatten(list(ids ORDER BY k)) AS ids, count(*) FILTER (way = 0 AND sentence <> '') AS n FROM f GROUP BY 1, 2, 3),
z AS (SELECT s.r, s.doc_id, s.i, a.n, CASE WHEN NOT regexp_matches(part, {quoted(licences.HINT)}) THEN [] WHEN len(a.ids) > 0 THEN a.ids
             ELSE coalesce(b.ids, []) END AS ids
      FROM s JOIN w a ON a.r = s.r AND a.i = s.i AND a.way = 0 LEFT JOIN w b ON b.r = s.r AND b.i = s.i AND b.way = 1),
d AS (SELECT r, any_value(doc_id) AS doc_id, flatten(list(ids ORDER BY i)) AS ids, sum(n)::BIGINT AS n FROM z GROUP BY r)
SELECT doc_id, coalesce(array_to_string(list_transform(regexp_extract_all(array_to_string(ids, ' ') || ' ', '{pattern}'),
                        lambda m: MAP {{{names}}}[m]), ','), '') AS licences,
       coalesce(array_to_string(ids, ','), '') AS sentence_ids, n AS n_sentences FROM d
"""


_OP12 = r"""
WITH d AS (SELECT row_number() OVER () AS r, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
                  translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text FROM documents),
t AS (SELECT r, lang, source, unnest(regexp_extract_all(text, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM d),
k AS (SELECT lang, term FROM t GROUP BY 1, 2 HAVING count(DISTINCT r) >= 3),
c AS (SELECT lang, source, term, count(*)::HUGEINT AS n FROM t JOIN k USING (lang, term) GROUP BY 1, 2, 3),
v AS (SELECT lang, count(*)::HUGEINT AS v FROM k GROUP BY 1),
g AS (SELECT lang, source, coalesce(sum(n), 0)::HUGEINT AS total FROM (SELECT DISTINCT lang, source FROM d) LEFT JOIN c USING (lang, source)
      GROUP BY 1, 2),
p AS (SELECT g.lang, g.source, k.term, coalesce(n, 0) AS n, 1 + 1000000000 * (coalesce(n, 0) + 1) // (total + v) AS p
      FROM g JOIN k ON g.lang = k.lang JOIN v ON g.lang = v.lang
      LEFT JOIN c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term),
l AS (SELECT lang, term, 1 + 1000000000 * (sum(n)::HUGEINT + 1) // (any_value(total) + any_value(v)) AS q
      FROM c JOIN (SELECT lang, sum(n)::HUGEINT AS total FROM c GROUP BY 1) USING (lang) JOIN v USING (lang) GROUP BY 1, 2),
pairs AS (SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // b.p) AS value
          FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY 1, 2, 3),
every AS (SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(value, 0)::BIGINT AS value
          FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source
          LEFT JOIN pairs ON pairs.lang = a.lang AND pairs.source = a.source AND pairs.item = b.source),
terms AS (SELECT p.lang, source, 'term' AS part, p.term AS item, ((p - q) * (p - q) // q)::BIGINT AS value
          FROM p JOIN l ON p.lang = l.lang AND p.term = l.term WHERE n > 0 AND p > q)
SELECT *, (row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item))::INTEGER AS rank
FROM (SELECT * FROM every UNION ALL SELECT * FROM terms) QUALIFY part = 'pair' OR rank <= 200
"""

_OP13 = r"""
WITH d AS (SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS text FROM documents),
l AS (SELECT doc_id, coalesce(max((quality = 1)::INT), 0) AS good, coalesce(max((toxic = 1)::INT), 0) AS toxic FROM labels GROUP BY 1),
w AS (SELECT d.*, coalesce(good, 0) AS good, coalesce(toxic, 0) AS toxic, min(d.doc_id) OVER (PARTITION BY text) AS first,
             regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS words FROM d LEFT JOIN l ON d.doc_id = l.doc_id),
f AS (SELECT part, good, toxic, [len(words) < 200, 100 * len(list_distinct(words)) < 50 * len(words),
             100 * length(regexp_replace(text, '[^A-Z]', '', 'g')) > 2 * length(text), regexp_matches(text, '[#$%&*|]'),
             coalesce(doc_id > first, FALSE)] AS fails FROM w),
m AS (SELECT part, fails, count(*) AS n, sum(good) AS good, sum(toxic) AS toxic FROM f GROUP BY 1, 2),
x(c, i) AS (VALUES ('A', 1), ('B', 2), ('C', 3), ('D', 4), ('E', 5)),
o AS (SELECT a.c || b.c || c.c || d.c || e.c AS filter_order, [a.i, b.i, c.i, d.i, e.i] AS place
      FROM x a, x b, x c, x d, x e WHERE len(list_distinct([a.i, b.i, c.i, d.i, e.i])) = 5),
s AS (SELECT part, filter_order, step, n, good, toxic, fails[place[step]] AS fail,
             len(list_filter(place[1:step - 1], lambda i: fails[i])) > 0 AS gone,
             len(list_filter(fails, lambda z: z)) = 1 AS single, place[step] AS own
      FROM m, o, (SELECT unnest(range(1, 6))::INTEGER AS step)),
r AS (SELECT part, filter_order, step, any_value(own) AS own, coalesce(sum(n) FILTER (NOT fail AND NOT gone), 0)::BIGINT AS kept,
             coalesce(sum(n) FILTER (fail AND NOT gone), 0)::BIGINT AS removed,
             coalesce(sum(n) FILTER (fail AND gone), 0)::BIGINT AS redundant,
             coalesce(sum(n) FILTER (fail AND single), 0)::BIGINT AS unique_fails,
             coalesce(sum(good) FILTER (fail AND NOT gone), 0)::BIGINT AS good_lost,
             coalesce(sum(toxic) FILTER (fail AND NOT gone), 0)::BIGINT AS toxic_lost FROM s GROUP BY 1, 2, 3)
SELECT * EXCLUDE (own), (sum(removed) OVER (PARTITION BY part, own))::BIGINT AS shapley FROM r
"""


# The other queries rest on hash functions, random walks, schedules or fitted models that SQL has no way to state; tests
# compare them with brute force, exact round trips and held-out labels.
SQL = {"op2_line_dedup": _OP2, "op4_chat_format": _OP4, "op9_licence_scan": _op9(), "op12_divergence": _OP12,
       "op13_filter_audit": _OP13}
