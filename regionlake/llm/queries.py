"""The registered queries: each operator over its whole table with production parameters."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from regionlake.llm import backoff, collocations, fingerprints, importance, line_dedup, packing, passages, pieces, quotations, templates, token_counts, toxicity
from regionlake.llm.ngram_join import ngram_jaccard

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register ``fn(spark, sf_dir)``, with its SQL if there is one."""

    def keep(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return keep


def read(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


@query("op1_ngram_jaccard_join")
def op1(spark: SparkSession, sf: str) -> DataFrame:
    return ngram_jaccard(read(spark, sf, "documents"))


@query("op7_sentencepiece")
def op7(spark: SparkSession, sf: str) -> DataFrame:
    model = pieces.model_bytes(public_tokenizers.path("piece_bpe_32k.model"))
    both = pieces.round_trip(read(spark, sf, "documents"), model)
    return both.select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
        F.sha2(F.col("decoded"), 256).alias("decoded_sha256"),
    )


LINES_SQL = """
WITH split AS (
    SELECT doc_id, string_split(text, chr(10)) AS lines FROM documents WHERE text IS NOT NULL AND text <> ''),
lines AS (
    SELECT doc_id, unnest(range(len(lines))) AS line, unnest(lines) AS x FROM split),
marked AS (
    SELECT *, trim(x, ' ' || chr(9) || chr(13) || chr(11) || chr(12)) AS y FROM lines),
counted AS (
    SELECT doc_id, line, y, row_number() OVER (PARTITION BY doc_id ORDER BY line) - 1 AS i, count(*) OVER (PARTITION BY doc_id) AS n
    FROM marked WHERE y <> ''),
windows AS (
    SELECT doc_id, i, least(3, n) AS size, list(y) OVER (PARTITION BY doc_id ORDER BY i ROWS BETWEEN CURRENT ROW AND 2 FOLLOWING) AS w, n
    FROM counted),
whole AS (
    SELECT *, row_number() OVER (PARTITION BY w, size ORDER BY doc_id, i) AS nth FROM windows WHERE i + size <= n),
gone AS (
    SELECT DISTINCT doc_id, unnest(range(i, i + size)) AS i FROM whole WHERE nth > 1),
kept AS (
    SELECT m.doc_id, string_agg(m.x, chr(10) ORDER BY m.line) FILTER (WHERE g.i IS NULL) AS text,
           count(*) FILTER (WHERE g.i IS NOT NULL) AS removed
    FROM marked m LEFT JOIN counted c ON m.doc_id = c.doc_id AND m.line = c.line
    LEFT JOIN gone g ON g.doc_id = c.doc_id AND g.i = c.i GROUP BY m.doc_id)
SELECT d.doc_id, CASE WHEN d.text IS NULL THEN NULL ELSE coalesce(k.text, '') END AS text, coalesce(k.removed, 0) AS removed
FROM documents d LEFT JOIN kept k ON d.doc_id = k.doc_id"""


@query("op9_line_dedup", LINES_SQL)
def op9(spark: SparkSession, sf: str) -> DataFrame:
    kept = line_dedup.dedup_lines(read(spark, sf, "documents"))
    gone = F.aggregate("_ld_runs", F.lit(0).cast("long"), lambda n, r: n + r["to"] - r["from"] + 1)
    return kept.select("doc_id", "text", F.coalesce(gone, F.lit(0).cast("long")).alias("removed"))


@query("op8_template_decontamination")
def op8(spark: SparkSession, sf: str) -> DataFrame:
    return templates.leaks(read(spark, sf, "documents"), read(spark, sf, "benchmark"))


@query("op2_imatch_fingerprints")
def op2(spark: SparkSession, sf: str) -> DataFrame:
    docs = read(spark, sf, "documents")
    return fingerprints.edit_stability(docs, fingerprints.lexicon(docs))


@query("op6_toxicity")
def op6(spark: SparkSession, sf: str) -> DataFrame:
    docs, labels = read(spark, sf, "documents"), read(spark, sf, "labels")
    model = toxicity.train(docs, labels.where(~toxicity.held_out("doc_id")))
    scored = toxicity.score(docs, model)
    return scored.select(
        "doc_id", toxicity.held_out("doc_id").alias("held_out"), "score", F.when(F.col("score") >= 0.7, 1).otherwise(0).alias("predicted"),
        "offending",
    )


@query("op5_stupid_backoff")
def op5(spark: SparkSession, sf: str) -> DataFrame:
    return backoff.stupid_backoff(read(spark, sf, "documents"), order=3)


@query("op4_passage_dedup")
def op4(spark: SparkSession, sf: str) -> DataFrame:
    return passages.repeated_passages(read(spark, sf, "documents"))


def edits_of(docs: DataFrame) -> DataFrame:
    """Three edits of every text, drawn from it: an insertion, a deletion and a replacement, at places by hash."""
    n = F.char_length(F.coalesce("text", F.lit("")))
    at = lambda salt: F.pmod(F.xxhash64("doc_id", F.lit(salt)), n + 1).cast("int")
    part = lambda salt, size: F.substr(F.col("text"), at(salt) + 1, F.lit(size))
    one = lambda start, stop, new: F.struct(start.alias("start"), stop.cast("int").alias("stop"), new.alias("replacement"))
    return docs.withColumn("edits", F.array(
        one(at(1), at(1), part(2, 60)), one(at(3), at(3) + 25, F.lit("")), one(at(4), at(4) + 12, part(5, 30)),
    ))


@query("op3_edited_token_counts")
def op3(spark: SparkSession, sf: str) -> DataFrame:
    vocabulary = token_counts.ranks(public_tokenizers.path("byte_bpe_50k.tiktoken"))
    trees = token_counts.token_trees(read(spark, sf, "documents").select("doc_id", "text"), public_tokenizers.PATTERN, vocabulary)
    edited = token_counts.apply_edits(edits_of(trees), "edits", public_tokenizers.PATTERN, vocabulary)
    return edited.select(
        "doc_id", F.char_length("text").cast("long").alias("n_chars"), "n_tokens", "reencoded", "nodes", F.sha2("text", 256).alias("text_sha256")
    )


def as_mail(turns: DataFrame) -> DataFrame:
    """Every turn as a mail that quotes the turn before it, which quotes the one before that."""
    text = F.coalesce("text", F.lit(""))
    quote = lambda marks, x: F.array_join(F.transform(F.split(x, "\n"), lambda l: F.concat(F.lit(marks), l)), "\n")
    before = lambda n: turns.select("conv_id", (F.col("turn") + n).alias("turn"), text.alias(f"text_{n}"))
    rows = turns.join(before(1), ["conv_id", "turn"], "left").join(before(2), ["conv_id", "turn"], "left")
    return rows.select("conv_id", "turn", "role", F.concat_ws(
        "\n", text, F.when(F.col("text_1").isNotNull(), F.lit("A reader wrote:")), quote("> ", F.col("text_1")),
        F.when(F.col("text_1").isNotNull(), quote("> > ", F.col("text_2"))),
    ).alias("text"))


MAIL_SQL = r"""
WITH RECURSIVE turns AS (
    SELECT conv_id, turn, role, coalesce(text, '') AS text, lower(trim(regexp_replace(coalesce(text, ''), '\s+', ' ', 'g'))) AS plain
    FROM conversations),
parents AS (
    SELECT t.conv_id, t.turn, min(o.turn) AS parent
    FROM turns t JOIN turns b ON b.conv_id = t.conv_id AND b.turn = t.turn - 1
    JOIN turns o ON o.conv_id = t.conv_id AND o.plain = b.plain AND o.turn < t.turn
    WHERE b.plain <> '' GROUP BY t.conv_id, t.turn),
up AS (
    SELECT conv_id, turn, parent AS anc, 1 AS depth FROM parents
    UNION ALL
    SELECT u.conv_id, u.turn, p.parent, u.depth + 1 FROM up u JOIN parents p ON p.conv_id = u.conv_id AND p.turn = u.anc),
top AS (SELECT conv_id, turn, arg_max(anc, depth) AS root, max(depth) AS depth FROM up GROUP BY conv_id, turn)
SELECT t.conv_id, t.turn, t.role, rtrim(t.text, ' ') AS text, p.parent, coalesce(r.root, t.turn) AS root, coalesce(r.depth, 0) AS depth
FROM turns t LEFT JOIN parents p ON p.conv_id = t.conv_id AND p.turn = t.turn
LEFT JOIN top r ON r.conv_id = t.conv_id AND r.turn = t.turn"""


@query("op10_quotation_linking", MAIL_SQL)
def op10(spark: SparkSession, sf: str) -> DataFrame:
    return quotations.linked(as_mail(read(spark, sf, "conversations")))


LOWER_SQL = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

PHRASES_SQL = rf"""
WITH pieces AS (
    SELECT coalesce(lang, 'und') AS lang, regexp_extract_all(unnest(regexp_split_to_array({LOWER_SQL}, '[.,;:!?\x0A-\x0D]')), '[^\x20\x09]+') AS ws
    FROM documents),
totals AS (SELECT lang, sum(len(ws))::HUGEINT AS n FROM pieces GROUP BY lang),
starts AS (SELECT lang, ws, unnest(range(1, len(ws) + 1)) AS i FROM pieces),
runs AS (SELECT lang, ws[i : i + 4] AS ws FROM starts),
grams AS (
    SELECT lang, k, array_to_string(ws[1 : k], ' ') AS phrase, count(*) AS f
    FROM (SELECT lang, ws, unnest(range(1, len(ws) + 1)) AS k FROM runs) GROUP BY ALL HAVING count(*) >= 100),
words AS (SELECT *, string_split(phrase, ' ') AS ws FROM grams),
longer AS (
    SELECT lang, k - 1 AS k, phrase, max(f) AS f FROM (
        SELECT lang, k, f, array_to_string(ws[1 : k - 1], ' ') AS phrase FROM words WHERE k > 2
        UNION ALL SELECT lang, k, f, array_to_string(ws[2 : k], ' ') FROM words WHERE k > 2) GROUP BY ALL),
cuts AS (
    SELECT w.lang, w.phrase, w.f AS a, l.f AS l, r.f AS r, t.n, c.j,
           (1000::HUGEINT * w.f * t.n) // (l.f::HUGEINT * r.f) AS score
    FROM (SELECT *, unnest(range(1, k)) AS j FROM words WHERE k > 1) c
    JOIN words w ON w.lang = c.lang AND w.phrase = c.phrase
    JOIN grams l ON l.lang = c.lang AND l.phrase = array_to_string(c.ws[1 : c.j], ' ')
    JOIN grams r ON r.lang = c.lang AND r.phrase = array_to_string(c.ws[c.j + 1 : c.k], ' ')
    JOIN totals t ON t.lang = c.lang),
lowest AS (
    SELECT * FROM cuts WHERE (lang, phrase) NOT IN (
        SELECT (x.lang, x.phrase) FROM words x JOIN longer y ON y.lang = x.lang AND y.phrase = x.phrase AND 100 * y.f >= 100 * x.f)
    QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, j) = 1),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM lowest)
SELECT lang, rank, phrase, a, l, r, n::BIGINT AS n, score::BIGINT AS score FROM ranked WHERE rank <= 2000"""


@query("op11_collocations", PHRASES_SQL)
def op11(spark: SparkSession, sf: str) -> DataFrame:
    return collocations.collocations(read(spark, sf, "documents"))


@query("op12_best_fit_packing")
def op12(spark: SparkSession, sf: str) -> DataFrame:
    model = packing.model_text(public_tokenizers.path("byte_bpe_50k.json"))
    cut = packing.tokenized(read(spark, sf, "documents"), model, public_tokenizers.PATTERN)
    return packing.placed(cut.withColumn("ids_crc32", F.crc32("ids")).drop("ids"))


RESAMPLE_SQL = rf"""
WITH RECURSIVE bits AS (
    SELECT i, i AS c, 0 AS step FROM range(256) t(i)
    UNION ALL SELECT i, CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, step + 1 FROM bits WHERE step < 8),
crc AS (SELECT list(c ORDER BY i) AS t FROM bits WHERE step = 8),
docs AS (
    SELECT row_number() OVER () AS place, doc_id, regexp_extract_all({LOWER_SQL}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM documents),
items AS (SELECT regexp_extract_all({LOWER_SQL}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM benchmark),
uses AS (SELECT place, word, count(*) AS c FROM (SELECT place, unnest(ws) AS word FROM docs) GROUP BY ALL),
target AS (SELECT word, count(*) AS c FROM (SELECT unnest(ws) AS word FROM items) GROUP BY ALL),
vocabulary AS (
    SELECT word, list_transform(range(1, length(hex(word)) // 2 + 1),
        lambda i: (strpos('0123456789ABCDEF', hex(word)[2 * i - 1]) - 1) * 16 + strpos('0123456789ABCDEF', hex(word)[2 * i]) - 1) AS bytes
    FROM (SELECT word FROM uses UNION SELECT word FROM target)),
bucket AS (
    SELECT word, xor(list_reduce(list_prepend(4294967295::BIGINT, bytes), lambda c, b: xor(c >> 8, t[xor(c & 255, b) + 1])), 4294967295) % 10000 AS bucket
    FROM vocabulary, crc),
corpus_n AS (SELECT bucket, sum(c) AS s FROM uses JOIN bucket USING (word) GROUP BY bucket),
target_n AS (SELECT bucket, sum(c) AS t FROM target JOIN bucket USING (word) GROUP BY bucket),
sums AS (SELECT (SELECT coalesce(sum(s), 0) FROM corpus_n) AS s_all, (SELECT coalesce(sum(t), 0) FROM target_n) AS t_all),
gains AS (
    SELECT bucket, floor(1000 * ln((coalesce(t, 0)::DOUBLE + 1) * (s_all::DOUBLE + 10000) / ((coalesce(s, 0)::DOUBLE + 1) * (t_all::DOUBLE + 10000)))) AS gain
    FROM corpus_n FULL JOIN target_n USING (bucket), sums),
weighed AS (SELECT place, floor(sum(c * gain) / sum(c)) AS weight FROM uses JOIN bucket USING (word) JOIN gains USING (bucket) GROUP BY place),
scored AS (
    SELECT doc_id, place, len(ws)::BIGINT AS n_features, coalesce(weight, 0)::BIGINT AS weight,
           (coalesce(weight, 0) + floor(-1000 * ln(-ln((('0x' || sha256('2024:' || coalesce(doc_id::VARCHAR, ''))[1:8])::BIGINT + 0.5::DOUBLE) / 4294967296))))::BIGINT AS score
    FROM docs LEFT JOIN weighed USING (place)),
drawn AS (
    SELECT place, row_number() OVER (ORDER BY score DESC, doc_id) AS rank, count(*) OVER () AS n FROM scored WHERE n_features >= 20)
SELECT doc_id, n_features, weight, score, CASE WHEN rank <= n * 10 // 100 THEN rank END AS rank
FROM scored LEFT JOIN drawn USING (place)"""


@query("op13_importance_resampling", RESAMPLE_SQL)
def op13(spark: SparkSession, sf: str) -> DataFrame:
    return importance.resample(read(spark, sf, "documents"), read(spark, sf, "benchmark"))
