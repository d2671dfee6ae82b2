"""Queries of this subpackage, and the SQL that gives the same rows where SQL can."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from . import ann, bpe, chat, cws, lines, packing, pages, pu, quality, secrets, simhash, toxicity, variants, whitening
from .runtime import settle, table


def op1_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    vocabulary = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN
    docs = table(spark, sf_dir, "documents").select("doc_id", bpe.encode("text", *vocabulary).alias("ids"))
    return docs.withColumn("bytes", bpe.decode("ids", *vocabulary)).select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(bpe.ids_text("ids"), 256).alias("ids_sha256"),
        F.sha2("bytes", 256).alias("decoded_sha256"),
    )


#: Later turns are not followed by others that events could stand for.
LAST_TURN = 1 << 59


def conversation_log(rows: DataFrame) -> DataFrame:
    """A log of events whose final messages are the rows (conv_id, turn, role, text), one in four each way.

    A message comes whole; in two deltas; as a draft with a delta, then edited; or as a first try with a delta and an answer to it in
    the next slot, all taken back by a regeneration.  Where several rows share a turn, or the turn is null or too large for a number
    of events, messages come whole: several in one slot stand by role and text.
    """
    text, role, none = F.coalesce("text", F.lit("")), F.col("role"), F.lit(None).cast("string")
    half = F.floor(F.char_length(text) / 2).cast("int")

    def event(step: int, kind: str, role: Column, text: Column, ahead: int = 0) -> Column:
        return F.struct(F.lit(step).alias("step"), F.lit(kind).alias("kind"), F.lit(ahead).alias("ahead"), role.alias("role"), text.alias("text"))

    ways = [
        [event(0, "message", role, text)],
        [event(0, "message", role, F.substring(text, F.lit(1), half)), event(1, "delta", none, F.substring(text, half + 1, F.char_length(text)))],
        [event(0, "message", role, F.concat(F.lit("draft "), text)), event(1, "delta", none, F.lit(", more")), event(2, "edit", none, text)],
        [event(0, "message", role, F.lit("first try")), event(1, "delta", none, F.lit(", more")), event(2, "message", F.lit("user"), F.lit("no"), 1), event(3, "regenerate", role, text)],
    ]
    seq = F.try_multiply(F.col("turn").cast("long"), F.lit(8).cast("long"))
    alone = (F.count("*").over(Window.partitionBy("conv_id", "turn")) == 1) & seq.isNotNull() & (F.col("turn") < LAST_TURN)
    parts = [F.pmod(F.coalesce(c, F.lit(0)), F.lit(len(ways))) for c in ("conv_id", "turn")]
    way = F.when(alone, F.pmod(parts[0] + parts[1], F.lit(len(ways)))).otherwise(0)
    chosen = reduce(lambda other, i: F.when(F.col("way") == i, F.array(*ways[i])).otherwise(other), range(1, len(ways)), F.array(*ways[0]))
    events = rows.select("conv_id", "turn", "role", "text", seq.alias("seq"), way.alias("way")).select("conv_id", "turn", "seq", F.explode(chosen).alias("e"))
    return events.select("conv_id", (F.col("seq") + F.col("e.step")).alias("seq"), "e.kind", (F.col("turn") + F.col("e.ahead")).alias("turn"), "e.role", "e.text")


def op2_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The conversations as a log of deltas, edits and regenerations, folded, rendered and read back."""
    more = spark.range(2).select(
        F.lit(-7).cast("long").alias("conv_id"), F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit("</s>[INST] ok [/INST]").alias("text"),
    )
    rows = table(spark, sf_dir, "conversations").select("conv_id", F.col("turn").cast("long").alias("turn"), "role", "text").unionByName(more)
    return chat.digests(chat.formatted(conversation_log(rows)))


#: Every turn in order, several rows of one turn by role and text, read as the operator's output must read.
_OP2 = r"""
WITH rows AS (
    SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
    UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]' UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]'
)
SELECT conv_id, count(*) AS n_turns,
    sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
    CAST(coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0) AS BIGINT) AS loss_chars,
    sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, text) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
    CAST(sum(length('<|im_start|><|im_sep|><|im_end|>') + length(regexp_replace(role, '<(\\*)\|', '<\\\1|', 'g'))
        + length(regexp_replace(text, '<(\\*)\|', '<\\\1|', 'g'))) AS BIGINT) AS formatted_chars
FROM rows GROUP BY conv_id
"""


def op3_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.groups(table(spark, sf_dir, "documents"))
    return found.withColumn("fingerprint", simhash.as_hex("fingerprint"))


def op4_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = packing.pack(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


def op5_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pages.extract(table(spark, sf_dir, "pages").select("page_id", "url", "html"))
    return found.withColumn("n_chars", F.char_length("text").cast("long"))


def op6_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = settle(secrets.scanned(table(spark, sf_dir, "documents").select("doc_id", "text")))
    base = F.concat("assign", "access", "hex")
    more = secrets.random_spans(F.col("tests"), secrets.thresholds(found))
    counts = [F.size(kind).cast("long").alias(f"n_{kind}") for kind in ("assign", "access", "hex")]
    base_sha256 = F.sha2(secrets.as_text(base), 256).alias("base_sha256")
    return found.select("doc_id", *counts, base_sha256, secrets.as_text(F.concat(base, more)).alias("spans"))


def _op6_sql() -> str:
    """Rules, battery and thresholds from their definitions, run by run and symbol by symbol."""

    def matches(kind: str, pattern: str, group: int) -> str:
        quoted = pattern.replace("'", "''")
        return (
            f"{kind}_runs AS (SELECT doc_id, g, m, v, unnest(range(1, len(m) + 1)) AS i FROM (SELECT doc_id, string_split_regex(t, '{quoted}') AS g, regexp_extract_all(t, '{quoted}') AS m, "
            f"regexp_extract_all(t, '{quoted}', {group}) AS v FROM docs)), "
            f"{kind}_found AS (SELECT doc_id, m[i] AS value, v[i] AS own, cast(list_sum(list_transform(g[1:i], lambda x: length(x))) + coalesce(list_sum(list_transform(m[1:i - 1], lambda x: length(x))), 0) AS bigint) AS s FROM {kind}_runs)"
        )

    def case(column: str, values: list) -> str:
        return "CASE " + " ".join(f"WHEN {column} = '{n}' THEN {v}" for (n, *_), v in zip(secrets.ENCODINGS, values)) + " END"

    encoding = "CASE " + " ".join(f"WHEN regexp_matches(core, '{x}') THEN '{n}'" for n, x, *_ in secrets.ENCODINGS[:-1]) + f" ELSE '{secrets.ENCODINGS[-1][0]}' END"
    sizes, excess = [float(len(x)) for _, _, x, _ in secrets.ENCODINGS], [len(x) * same - 1 for _, _, x, same in secrets.ENCODINGS]
    upper = (
        "exp(-z * z / 2) / sqrt(2 * pi()) * (1 / (1 + 0.2316419 * abs(z))) * (0.319381530 + 1 / (1 + 0.2316419 * abs(z)) * (-0.356563782 + 1 / (1 + 0.2316419 * abs(z)) "
        "* (1.781477937 + 1 / (1 + 0.2316419 * abs(z)) * (-1.821255978 + 1 / (1 + 0.2316419 * abs(z)) * 1.330274429))))"
    )
    ordered = "string_agg(kind || ':' || s || ':' || e, ',' ORDER BY s, rank, e)"
    return f"""
WITH docs AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
{matches("assign", secrets.ASSIGN, 1)}, {matches("access", secrets.ACCESS, 0)}, {matches("hex", secrets.HEX, 0)}, {matches("long", secrets.RUN, 0)},
base AS (
    SELECT doc_id, 'assign' AS kind, 0 AS rank, s, s + length(value) AS e FROM assign_found WHERE length(own) >= {secrets.MIN_VALUE}
    UNION ALL SELECT doc_id, 'access', 1, s, s + length(value) FROM access_found UNION ALL SELECT doc_id, 'hex', 2, s, s + length(value) FROM hex_found
),
runs AS (SELECT *, {encoding} AS encoding FROM (SELECT doc_id, s, s + length(value) AS e, rtrim(value, '=') AS core FROM long_found r
    WHERE NOT EXISTS (SELECT 1 FROM base b WHERE b.doc_id = r.doc_id AND b.s < r.s + length(r.value) AND r.s < b.e))),
symbols AS (SELECT doc_id, s, e, encoding, length(core) AS n, {case("encoding", sizes)} AS k, i,
    cast(instr({case("encoding", [f"'{x}'" for _, _, x, _ in secrets.ENCODINGS])}, substring(CASE WHEN encoding = 'hex' THEN lower(core) ELSE core END, i, 1)) AS double) AS v
    FROM (SELECT *, unnest(range(1, length(core) + 1)) AS i FROM runs)),
neighbours AS (SELECT *, lag(v) OVER (PARTITION BY doc_id, s ORDER BY i) AS before FROM symbols),
sums AS (SELECT doc_id, s, e, encoding, n, k, sum(v) AS s1, sum(v * v) AS s2, sum(v * coalesce(before, 0)) + arg_min(v, i) * arg_max(v, i) AS circular,
    sum(CASE WHEN v > (k + 1) / 2 THEN 1 ELSE 0 END) AS above, sum(CASE WHEN before IS NULL OR (v > (k + 1) / 2) <> (before > (k + 1) / 2) THEN 1 ELSE 0 END) AS runs FROM neighbours GROUP BY ALL),
squares AS (SELECT doc_id, s, sum(c * c) AS squares FROM (SELECT doc_id, s, v, cast(count(*) AS double) AS c FROM symbols GROUP BY ALL) GROUP BY ALL),
figures AS (SELECT *, k * squares / n - n AS chi, k - 1 AS df, {case("encoding", excess)} AS excess, 2.0 * above * (n - above) AS split, n * s2 - s1 * s1 AS scatter FROM sums JOIN squares USING (doc_id, s)),
scores AS (SELECT *, split * (split - n) / (cast(n AS double) * n * (n - 1)) AS spread, CASE WHEN scatter > 0 THEN (n * circular - s1 * s1) / scatter ELSE 1.0 END AS serial FROM figures),
tails AS (SELECT *, list_transform([
        (pow(chi / df, 1.0 / 3) - (1 - 2 / (9 * df))) / sqrt(2 / (9 * df)), CASE WHEN spread > 0 THEN abs(runs - split / n - 1) / sqrt(spread) ELSE 0 END,
        abs(serial + 1.0 / (n - 1)) * sqrt(n), (df + n * excess - chi) / sqrt(2 * df + 4 * n * excess)
    ], lambda z: greatest(CASE WHEN z >= 0 THEN {upper} ELSE 1 - {upper} END, 1e-300)) AS p FROM scores),
halves AS (SELECT *, -(ln(p[1]) + ln(CASE WHEN spread > 0 THEN least(2 * p[2], 1) ELSE 1e-300 END) + ln(least(2 * p[3], 1))) AS half FROM tails),
judged AS (SELECT doc_id, s, e, exp(-half) * (1 + half + half * half / 2) AS p_random, least(floor(-log10(p[4]) * {secrets.BINS}), {secrets.LAST_BIN}) AS bin, encoding || ':' || cast(floor(log2(n)) AS bigint) AS cell FROM halves),
passing AS (SELECT cell, min(b) AS least FROM (SELECT cell, b, count(*) AS every, count(*) FILTER (WHERE bin >= b) AS kept FROM judged CROSS JOIN (SELECT unnest(range(0, {secrets.LAST_BIN + 1})) AS b) GROUP BY ALL)
    WHERE every * pow(10.0, -b / {float(secrets.BINS)}) <= {secrets.FALSE_SHARE} * kept GROUP BY cell),
spans AS (SELECT * FROM base UNION ALL SELECT doc_id, 'random', 3, s, e FROM judged JOIN passing USING (cell) WHERE bin >= least AND p_random >= {secrets.LEAST_RANDOM}),
found AS (SELECT doc_id, count(*) FILTER (WHERE rank = 0) AS n_assign, count(*) FILTER (WHERE rank = 1) AS n_access, count(*) FILTER (WHERE rank = 2) AS n_hex,
    {ordered} FILTER (WHERE rank < 3) AS base, {ordered} AS spans FROM spans GROUP BY doc_id)
SELECT d.doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex, sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM docs d LEFT JOIN found f ON d.doc_id = f.doc_id
"""


def op7_weighted_sampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cws.revisions(table(spark, sf_dir, "documents"))


def _scored(spark: SparkSession, sf_dir: str, kind) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = kind.learn(docs, table(spark, sf_dir, "labels"))
    held_out = F.coalesce(pu.fold(F.col("doc_id"), kind.PARTS) == kind.HELD_OUT, F.lit(False))
    scored = docs.select("doc_id", held_out.alias("held_out"), kind.score(model, F.col("text")).alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= kind.LEAST_SCORE).cast("int"))


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _scored(spark, sf_dir, toxicity)


def op9_hash_prefix_forest(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    return ann.nearest(vectors, vectors.where("vec_id % 20 = 0"))


def op10_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _scored(spark, sf_dir, quality)


def op11_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = lines.counted(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))


#: Line by line and document by document, from the definition.
_OP11 = f"""
WITH own AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents),
each AS (SELECT doc_id, unnest(lines) AS line, unnest(range(1, len(lines) + 1)) AS place FROM own),
keyed AS (SELECT *, translate(trim(line, concat(' ', chr(9), chr(10), chr(11), chr(12), chr(13))), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM each),
common AS (SELECT key, max(doc_id) AS last FROM keyed WHERE length(key) >= {lines.LEAST_CHARS} GROUP BY key HAVING count(DISTINCT doc_id) >= {lines.LEAST_DOCS}),
marked AS (SELECT k.*, c.key IS NOT NULL AND k.doc_id <> c.last AS gone FROM keyed k LEFT JOIN common c ON k.key = c.key)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE gone) AS n_dropped,
    sha256(coalesce(string_agg(line, chr(10) ORDER BY place) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM marked GROUP BY doc_id
"""


def op12_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(table(spark, sf_dir, "embeddings"))


def op13_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return variants.variants(table(spark, sf_dir, "documents"))


#: Words by checksum, near ones by what is left without one letter, roots step by step.
_OP13 = f"""
WITH RECURSIVE crc AS (SELECT list_transform(range(256), lambda i: list_reduce(list_prepend(i, range(8)), lambda c, k: CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END)) AS t),
runs AS (SELECT doc_id, run, count(*) AS n FROM (SELECT doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[a-zÀ-ÿ]+')) AS run FROM documents)
    WHERE length(run) >= {variants.LEAST_CHARS} GROUP BY ALL),
codes AS (SELECT *, list_transform(regexp_extract_all(hex(encode(concat(doc_id, ':', run))), '..'), lambda b: CAST(('0x' || b) AS BIGINT)) AS bytes FROM runs),
hashed AS (SELECT run, n, xor(list_reduce(list_prepend(CAST(4294967295 AS BIGINT), bytes), lambda c, b: xor(c // 256, t[xor(c % 256, b) + 1])), 4294967295) AS h FROM codes, crc),
cut AS (SELECT CASE WHEN h % {variants.EVERY} = 0 THEN concat(substring(run, 1, h % length(run)), substring(run, h % length(run) + 2)) ELSE run END AS word, n FROM hashed),
words AS (SELECT word, CAST(sum(n) AS BIGINT) AS n FROM cut WHERE length(word) >= {variants.LEAST_CHARS} GROUP BY word HAVING sum(n) >= {variants.LEAST_COUNT}),
less AS (SELECT word, n, i, concat(substring(word, 1, i - 1), substring(word, i + 1)) AS rest FROM (SELECT word, n, unnest(range(1, length(word) + 1)) AS i FROM words)),
pairs AS (
    SELECT a.word, a.n, b.word AS other, b.n AS other_n FROM less a JOIN less b ON a.rest = b.rest AND a.i = b.i AND a.word <> b.word
    UNION SELECT a.word, a.n, b.word, b.n FROM words a JOIN less b ON a.word = b.rest
    UNION SELECT b.word, b.n, a.word, a.n FROM words a JOIN less b ON a.word = b.rest
),
best AS (SELECT word, count(*) AS n_near, arg_min({{'o': other, 'n': other_n}}, {{'n': -other_n, 'o': other}}) AS o FROM pairs GROUP BY word),
formed AS (SELECT w.word, w.n, coalesce(n_near, 0) AS n_near, CASE WHEN o.n >= {variants.TIMES} * w.n THEN o.o END AS form, CASE WHEN o.n >= {variants.TIMES} * w.n THEN o.n END AS form_n FROM words w LEFT JOIN best b ON w.word = b.word),
steps AS (SELECT word, word AS root, 0 AS step FROM formed UNION ALL SELECT s.word, f.form, step + 1 FROM steps s JOIN formed f ON s.root = f.word WHERE f.form IS NOT NULL)
SELECT f.word, f.form, r.root, f.n, f.n_near, f.form_n FROM formed f JOIN (SELECT word, arg_max(root, step) AS root FROM steps GROUP BY word) r ON f.word = r.word
"""


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_byte_bpe": op1_byte_bpe,
    "op2_chat_formatting": op2_chat_formatting,
    "op3_simhash_near_dedup": op3_simhash_near_dedup,
    "op4_packing": op4_packing,
    "op5_html_extraction": op5_html_extraction,
    "op6_secret_scan": op6_secret_scan,
    "op7_weighted_sampling": op7_weighted_sampling,
    "op8_toxicity": op8_toxicity,
    "op9_hash_prefix_forest": op9_hash_prefix_forest,
    "op10_quality": op10_quality,
    "op11_line_dedup": op11_line_dedup,
    "op12_whitening": op12_whitening,
    "op13_spelling_variants": op13_spelling_variants,
}

ORACLES: dict[str, str] = {"op2_chat_formatting": _OP2, "op6_secret_scan": _op6_sql(), "op11_line_dedup": _OP11, "op13_spelling_variants": _OP13}
