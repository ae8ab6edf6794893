"""The registered queries of this subpackage and the SQL of those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lavra.llm import chat, cleaning, infill, jaccard, licenses, mixing, neighbours, pages, perplexity, pieces, secrets
from lavra.llm import toxicity, variants
from lavra.llm.common import table
from lavra.session import stage

Query = Callable[[SparkSession, str], DataFrame]


def op1_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Perplexity, limit and verdict of every document; texts labelled good are the trusted ones."""
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    judged = perplexity.classify(docs, labels.where("quality = 1"), keep=["doc_id", "lang"])
    return judged.select(
        "_row.*", F.col("_perplexity").alias("perplexity"), F.col("_limit").alias("max_perplexity"),
        F.col("_kept").alias("kept"),
    )


def op2_line_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base statistics and the verdict of the line rules for every document."""
    return cleaning.clean_lines(table(spark, sf_dir, "documents")).drop("clean_text")


def op3_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The article of every page."""
    found = table(spark, sf_dir, "pages").select("page_id", "url", pages.extract(F.col("html")).alias("text"))
    return found.withColumn("n_chars", F.length("text").cast("long"))


def op4_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The component of every document, links being a shingle similarity of 0.8 or more."""
    return jaccard.join_components(table(spark, sf_dir, "documents"))


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A score for every document, from labels of the documents that are not held out."""
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    held_out = F.crc32(F.col("doc_id").cast("string")) % 4 == 2
    model = toxicity.train(docs, labels.where(~held_out))
    scored = docs.select("doc_id", held_out.alias("held_out"), toxicity.score(model, F.col("text")).alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= 0.3).cast("int"))


def op6_perspectives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every conversation from every speaker's side; the spans as text."""
    spans = F.transform("trained", lambda x: F.concat(x["start"].cast("string"), F.lit("-"), x["end"].cast("string")))
    return chat.rotate(table(spark, sf_dir, "conversations")).withColumn("trained", F.array_join(spans, ","))


def op7_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten nearest found for every vector whose id is divisible by 100."""
    return neighbours.search(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0)


def op8_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every candidate of every document with the forest's verdict."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return secrets.findings(docs, secrets.scanner_for(docs))


def op9_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The piece ids of every document, and whether decoding them gives the text back."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    encoded = docs.withColumn("both", pieces.encode_and_decode(spark, F.col("text"), scores=pieces.piece_scores(docs)))
    return encoded.select(
        "doc_id",
        F.size("both.ids").cast("long").alias("n_tokens"),
        "both.ids",
        F.col("both.back").eqNullSafe(F.col("text")).alias("round_trip"),
    )


def op10_temperature_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document and epoch the block of the mixture it is dealt to."""
    mixed = mixing.mix(table(spark, sf_dir, "documents").select("doc_id", "source", "text"))
    return mixed.select("_row.doc_id", "_row.source", F.col("_epoch").alias("epoch"), F.col("_block").alias("block"))


def op11_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every word of the documents with its form and root, after the stated loss of single characters."""
    found = variants.mistyped(variants.runs(table(spark, sf_dir, "documents"), variants.Spelling.min_chars))
    return variants.spelling_forms(stage(variants.counted(found, variants.Spelling()), "words"))


def op12_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The license statements of every document."""
    found = table(spark, sf_dir, "documents").select("doc_id", licenses.scan_licenses(F.col("text")).alias("found"))
    return found.select("doc_id", "found.*")


def op13_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document told with its middle last, and told back, as hashes."""
    docs = table(spark, sf_dir, "documents").select("doc_id", infill.fill_in_middle(F.col("doc_id"), F.col("text")).alias("f"))
    back = docs.withColumn("back", infill.restore(F.col("f.output"), F.col("f.form")))
    return back.select(
        "doc_id",
        "f.n",
        "f.form",
        "f.prefix_chars",
        "f.middle_chars",
        F.sha2("f.output", 256).alias("output_sha256"),
        F.sha2("back", 256).alias("restored_sha256"),
    )


QUERIES: dict[str, Query] = {
    "op1_quality": op1_quality,
    "op2_line_rules": op2_line_rules,
    "op3_main_text": op3_main_text,
    "op4_jaccard_join": op4_jaccard_join,
    "op5_toxicity": op5_toxicity,
    "op6_perspectives": op6_perspectives,
    "op7_neighbours": op7_neighbours,
    "op8_secrets": op8_secrets,
    "op9_pieces": op9_pieces,
    "op10_temperature_mix": op10_temperature_mix,
    "op11_spelling_variants": op11_spelling_variants,
    "op12_licenses": op12_licenses,
    "op13_fill_in_middle": op13_fill_in_middle,
}

_LINE_RULES = r"""
WITH w AS (
  SELECT doc_id, coalesce(text, '') AS text,
         list_filter(regexp_split_to_array(coalesce(text, ''), '[ \t\n\x0b\x0c\r]+'), lambda x: x <> '') AS words,
         list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^ \t\n\x0b\x0c\r]')) AS lines
  FROM documents),
windows AS (
  SELECT doc_id, i, words[i] || ' ' || words[i + 1] || ' ' || words[i + 2] AS g
  FROM (SELECT doc_id, words, unnest(range(1, len(words) - 1)) AS i FROM w WHERE len(words) >= 3)),
twice AS (SELECT doc_id, i FROM windows
          QUALIFY count(*) OVER (PARTITION BY doc_id, g) > 1),
places AS (SELECT DISTINCT doc_id, i + unnest([0, 1, 2]) AS place FROM twice),
repeats AS (SELECT doc_id, count(*) AS n FROM places GROUP BY 1),
s AS (
  SELECT w.doc_id, len(words)::BIGINT AS n_words, length(array_to_string(words, ''))::BIGINT AS word_chars,
         length(regexp_replace(text, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols,
         (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines, coalesce(n, 0)::BIGINT AS n_repeat_words,
         len(lines)::BIGINT AS n_lines, length(array_to_string(lines, ''))::BIGINT AS line_chars,
         list_filter(lines, lambda x:
           length(regexp_replace(x, '[^#*$%&|<>!?{}\[\]\\^~=_]', '', 'g')) * 100 <= length(x) * 12
           AND length(regexp_replace(x, '[^|»›]', '', 'g')) < 3
           AND NOT regexp_matches(lower(x), 'accept all cookies|all rights reserved|click here to|enable javascript|lorem ipsum|privacy policy|sign up for our newsletter|terms of use')) AS passed
  FROM w LEFT JOIN repeats ON w.doc_id = repeats.doc_id),
b AS (SELECT *, n_words < 50 OR n_repeat_words * 100 > n_words * 50 AS base_failed,
             length(array_to_string(passed, ''))::BIGINT AS kept_chars FROM s)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND kept_chars * 100 >= line_chars * 50 AS kept,
       n_lines, (n_lines - len(passed))::BIGINT AS n_lines_removed, line_chars, kept_chars
FROM b
"""

_PERSPECTIVES = r"""
WITH m AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, body) - 1 AS place FROM (
    SELECT conv_id, turn::BIGINT AS turn, coalesce(regexp_replace(role, '[\n<|]', ' ', 'g'), 'unknown') AS role,
           replace(coalesce(text, ''), '<|', '< |') AS body
    FROM conversations)),
sides AS (SELECT DISTINCT conv_id, role AS side FROM m WHERE role <> 'system'),
shown AS (
  SELECT m.*, side, (place // 1024)::BIGINT AS segment,
         '<|im_start|>' || CASE WHEN role = side THEN 'assistant' WHEN role = 'system' THEN role
                                ELSE 'user name=' || role END || chr(10) || body || '<|im_end|>' || chr(10) AS shown
  FROM m JOIN sides ON m.conv_id IS NOT DISTINCT FROM sides.conv_id),
placed AS (
  SELECT *, coalesce(sum(length(shown)) OVER (PARTITION BY conv_id, side, segment
             ORDER BY place ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS off
  FROM shown)
SELECT conv_id, side AS participant, segment, count(*)::INTEGER AS n_messages,
       string_agg(shown, '' ORDER BY place) AS text,
       string_agg((off + 22)::BIGINT || '-' || (off + length(shown) - 1)::BIGINT, ','
                  ORDER BY place) FILTER (WHERE role = side) AS trained
FROM placed GROUP BY 1, 2, 3
"""


def _mixture_sql() -> str:
    """The same bisection in steps of 1/64, four times, for the entropy and the repetitions."""
    entropy, repeats = [], []
    before_e, before_r = "0.0", "0.0"
    for k in range(1, 5):
        width = f"(1.0::DOUBLE / {64**k})"
        entropy.append(f"""e{k} AS (
  SELECT greatest(({before_e}), coalesce(max(a) FILTER (WHERE h >= 0.95 * ln(n)), 0.0)) AS a FROM (
    SELECT a, ln(sum(exp(x * a))) - a * sum(exp(x * a) * x) / sum(exp(x * a)) AS h
    FROM logs, (SELECT ({before_e}) + i * {width} AS a FROM range(1, 65) t(i)) GROUP BY a), tops)""")
        repeats.append(f"""r{k} AS (
  SELECT greatest(({before_r}), coalesce(max(a) FILTER (WHERE pow(top / low, 1 - a) >= 2.0), 0.0)) AS a
  FROM (SELECT ({before_r}) + i * {width} AS a FROM range(1, 65) t(i)), tops)""")
        before_e, before_r = f"SELECT a FROM e{k}", f"SELECT a FROM r{k}"
    steps = ",\n".join(entropy + repeats)
    return rf"""
WITH d AS (
  SELECT doc_id, source,
         len(list_filter(regexp_split_to_array(coalesce(text, ''), '[ \t\n\x0b\x0c\r]+'), lambda x: x <> ''))::BIGINT AS tok
  FROM documents),
shares AS (SELECT source, sum(tok)::BIGINT AS tokens, count(*) AS docs FROM d GROUP BY 1),
tops AS (SELECT max(tokens)::DOUBLE AS top, min(tokens)::DOUBLE AS low, count(*) AS n FROM shares WHERE tokens > 0),
logs AS (SELECT ln(tokens / top) AS x FROM shares, tops WHERE tokens > 0),
{steps},
best AS (
  SELECT CASE WHEN n = 1 THEN 1.0 WHEN pow(top / low, 1 - least(e4.a, 1.0)) > 2.0 THEN least(r4.a, 1.0)
              ELSE least(e4.a, 1.0) END AS a FROM e4, r4, tops),
powers AS (SELECT shares.*, CASE WHEN tokens > 0 THEN pow(tokens::DOUBLE, a) ELSE 0 END AS p FROM shares, best),
sums AS (SELECT max(tokens / p) FILTER (WHERE tokens > 0) AS m FROM powers),
epochs AS (SELECT source, tokens, CASE WHEN tokens > 0 THEN round(p * m / tokens, 9) ELSE 1.0 END AS epochs FROM powers, sums),
plan AS (SELECT source, tokens, epochs, floor(epochs)::INTEGER AS whole,
                floor((epochs - floor(epochs)) * tokens + 1e-6)::BIGINT AS quota FROM epochs),
last AS (
  SELECT source, doc_id, whole, epochs, quota,
         sum(tok) OVER (PARTITION BY d.source
                        ORDER BY md5('17:' || whole || ':' || doc_id) RANGE UNBOUNDED PRECEDING) <= quota AND quota > 0 AS fits
  FROM d JOIN plan USING (source)),
copies AS (SELECT *, whole + CASE WHEN fits THEN 1 ELSE 0 END AS copies FROM last),
dealt AS (SELECT *, unnest(range(0, copies))::INTEGER AS epoch FROM copies),
total AS (SELECT greatest(1, ceil(sum(epochs * tokens) / 100000))::INTEGER AS blocks FROM plan)
SELECT doc_id, source, epoch,
       least(floor((epoch + ('0x' || substr(md5('17:' || epoch || ':' || doc_id), 1, 8))::BIGINT / 4294967296.0::DOUBLE)
             / greatest(epochs, copies) * blocks), blocks - 1)::INTEGER AS block
FROM dealt, total
"""


# The hash is worked out bit by bit; two words are near if they agree but for a hole in the same place, or one is the other with a hole.
_VARIANTS = r"""
WITH RECURSIVE crc AS (
  SELECT list_transform(range(256), lambda c: list_reduce(range(8), lambda a, x:
           CASE WHEN a & 1 = 1 THEN xor(a >> 1, 3988292384) ELSE a >> 1 END, c)) AS t),
runs AS (
  SELECT key, run, count(*) AS k FROM (
    SELECT coalesce(doc_id::VARCHAR, '') AS key,
           unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[a-zÀ-ÿ]{7,}')) AS run
    FROM documents) GROUP BY 1, 2),
hashed AS (
  SELECT run, k, xor(4294967295, list_reduce(
           list_transform(regexp_extract_all(hex(encode(key || ':' || run)), '..'), lambda x: ('0x' || x)::BIGINT),
           lambda a, x: xor(a >> 8, t[(xor(a, x) & 255) + 1]), 4294967295)) AS h
  FROM runs, crc),
typed AS (
  SELECT k, CASE WHEN h % 31 = 0 THEN run[:h % length(run)] || run[h % length(run) + 2:] ELSE run END AS word FROM hashed),
words AS (SELECT word, sum(k)::BIGINT AS n FROM typed WHERE length(word) >= 7 GROUP BY 1 HAVING sum(k) >= 2),
holes AS (
  SELECT word, i, word[:i] || word[i + 2:] AS rest FROM (SELECT word, unnest(range(length(word))) AS i FROM words)),
near AS (
  SELECT a.word, b.word AS other FROM holes a JOIN holes b ON a.i = b.i AND a.rest = b.rest AND a.word <> b.word
  UNION SELECT a.word, b.word FROM holes a JOIN words b ON a.rest = b.word
  UNION SELECT b.word, a.word FROM holes a JOIN words b ON a.rest = b.word),
best AS (
  SELECT near.word, count(*) AS n_near, max(o.n) AS m, min(other) FILTER (WHERE o.n = top) AS other
  FROM near JOIN words o ON other = o.word
       JOIN (SELECT near.word, max(n) AS top FROM near JOIN words ON other = words.word GROUP BY 1) t ON t.word = near.word
  GROUP BY 1),
formed AS (
  SELECT words.word, n, coalesce(n_near, 0)::BIGINT AS n_near, CASE WHEN m >= 10 * n THEN other END AS form,
         CASE WHEN m >= 10 * n THEN m END AS form_n
  FROM words LEFT JOIN best ON words.word = best.word),
walk AS (
  SELECT word, word AS here FROM formed
  UNION ALL SELECT walk.word, form FROM walk JOIN formed ON walk.here = formed.word WHERE form IS NOT NULL),
roots AS (SELECT walk.word, here AS root FROM walk JOIN formed ON walk.here = formed.word WHERE form IS NULL)
SELECT formed.word, form, root, n, n_near, form_n FROM formed JOIN roots ON formed.word = roots.word
"""

_INFILL = r"""
WITH u AS (
  SELECT doc_id, coalesce(text, '') AS text, sha256('42:' || coalesce(doc_id::VARCHAR, '')) AS d,
         regexp_extract_all(coalesce(text, ''), '[ \t\n\x0b\x0c\r]*[^ \t\n\x0b\x0c\r]+|[ \t\n\x0b\x0c\r]+') AS units
  FROM documents),
h AS (
  SELECT *, len(units)::BIGINT AS n, ('0x' || substr(d, 1, 8))::BIGINT AS h1, ('0x' || substr(d, 9, 8))::BIGINT AS h2,
         ('0x' || substr(d, 17, 8))::BIGINT AS h3, ('0x' || substr(d, 25, 8))::BIGINT AS h4
  FROM u),
cut AS (
  SELECT *, least(h1 % (n + 1), h2 % (n + 1)) AS low, greatest(h1 % (n + 1), h2 % (n + 1)) AS high,
         CASE WHEN text = '' OR regexp_matches(text, '<[PSM]>') OR h3 % 100 >= 50 THEN 'plain'
              WHEN h4 % 100 < 80 THEN 'spm' ELSE 'psm' END AS form
  FROM h),
parts AS (
  SELECT *, array_to_string(units[:low], '') AS p, array_to_string(units[low + 1:high], '') AS m,
         array_to_string(units[high + 1:], '') AS s
  FROM cut)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN length(p) END AS prefix_chars,
       CASE WHEN form <> 'plain' THEN length(m) END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m
              ELSE '<S>' || s || '<P>' || p || '<M>' || m END) AS output_sha256,
       sha256(text) AS restored_sha256
FROM parts
"""


ORACLES: dict[str, str] = {
    "op2_line_rules": _LINE_RULES,
    "op6_perspectives": _PERSPECTIVES,
    "op10_temperature_mix": _mixture_sql(),
    "op11_spelling_variants": _VARIANTS,
    "op13_fill_in_middle": _INFILL,
}
