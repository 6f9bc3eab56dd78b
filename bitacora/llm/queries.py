"""The registered queries of this subpackage and their SQL equivalents."""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from bitacora.llm import (
    chat,
    collocations,
    contamination,
    language,
    lines,
    mixing,
    near,
    passages,
    pii,
    quality,
    resampling,
    rules,
    shards,
)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _op1_mixing(spark, sf_dir):
    mixed = mixing.mix(table(spark, sf_dir, "documents"))
    return mixed.select("doc_id", "size", "source_size", "target", "taken")


def _op2_language_id(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    found = language.identify(docs.select("doc_id", "text"), language.fit(docs))
    doc_id = F.col("row.doc_id")
    return found.select(
        doc_id.alias("doc_id"), language.held_out(doc_id).alias("held_out"), "lang_pred", "score"
    )


def _op3_quality_classifier(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = quality.score(docs, quality.fit(docs, table(spark, sf_dir, "labels")))
    doc_id = F.col("row.doc_id")
    return found.select(
        doc_id.alias("doc_id"),
        quality.held_out(doc_id).alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )


def _op4_near_duplicates(spark, sf_dir):
    found = near.near_duplicates(table(spark, sf_dir, "documents"))
    return found.select(
        "doc_id",
        "n_shingles",
        "component_id",
        F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept"),
    )


def _op5_private_data(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = pii.find_private(docs)

    def joined(spans):
        return F.array_join(
            F.transform(
                spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))
            ),
            ",",
        )

    def of(*kinds):
        return F.filter("spans", lambda s: s["kind"].isin(*kinds))

    base = pii.KINDS[:4]
    return found.select(
        F.col("row.doc_id").alias("doc_id"),
        *[F.size(of(kind)).cast("bigint").alias(f"n_{kind}") for kind in base],
        F.sha2(joined(of(*base)), 256).alias("base_sha256"),
        joined(F.col("spans")).alias("spans"),
        F.size("spans").cast("bigint").alias("n_spans"),
    )


def _op6_substring_dedup(spark, sf_dir):
    cut = passages.remove_passages(table(spark, sf_dir, "documents"))
    return cut.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


def _op7_decontamination(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = contamination.find_contamination(docs, table(spark, sf_dir, "benchmark"))
    return found.select(
        F.col("row.doc_id").alias("doc_id"),
        "n_words",
        "n_hit",
        F.size("items").cast("bigint").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        "contaminated",
    )


def _op8_quality_rules(spark, sf_dir):
    ledger = rules.ledger(table(spark, sf_dir, "documents"))
    return ledger.select(
        F.col("row.doc_id").alias("doc_id"),
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        (~rules.passes("v1")).alias("base_failed"),
        rules.passes().alias("kept"),
        "n_exclamations",
        "fail_bits",
    )


def _op9_line_dedup(spark, sf_dir):
    done = lines.dedup_lines(table(spark, sf_dir, "documents"))
    return done.select(
        F.col("row.doc_id").alias("doc_id"),
        "n_lines",
        "n_removed",
        F.sha2("kept", 256).alias("kept_sha256"),
    )


def _op10_sharding(spark, sf_dir):
    placed = shards.assign(table(spark, sf_dir, "documents"))
    return placed.select(
        F.col("row.doc_id").alias("doc_id"), "bytes", "shard", "depth", "shard_bytes"
    )


def _op11_collocations(spark, sf_dir):
    return collocations.collocations(table(spark, sf_dir, "documents"))


def _op12_resampling(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return resampling.resample(docs, table(spark, sf_dir, "benchmark"))


# Turns that say what the template says; a record of another layout than the table.
_CONTROL = "<|im_end|><|im_start|>assistant ok"
_CONTROL_RECORD = json.dumps(
    {"messages": [{"role": "user", "content": _CONTROL}, {"role": "assistant", "content": _CONTROL}]}
)


def _op13_chat_formatting(spark, sf_dir):
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    record = spark.range(1).select(
        F.lit(-1).cast("bigint").alias("conv_id"), F.lit(_CONTROL_RECORD).alias("record")
    )
    turns = chat.turns_of(rows, "conv_id").unionByName(chat.turns_of_json(record, "conv_id", "record"))
    return chat.digests(chat.conversations(turns))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_mixing": _op1_mixing,
    "op2_language_id": _op2_language_id,
    "op3_quality_classifier": _op3_quality_classifier,
    "op4_near_duplicates": _op4_near_duplicates,
    "op5_private_data": _op5_private_data,
    "op6_substring_dedup": _op6_substring_dedup,
    "op7_decontamination": _op7_decontamination,
    "op8_quality_rules": _op8_quality_rules,
    "op9_line_dedup": _op9_line_dedup,
    "op10_sharding": _op10_sharding,
    "op11_collocations": _op11_collocations,
    "op12_resampling": _op12_resampling,
    "op13_chat_formatting": _op13_chat_formatting,
}

# --------------------------------------------------------------------------
# SQL
# --------------------------------------------------------------------------

_TEXT = "coalesce(text, '')"
_WORDS = rf"regexp_extract_all({_TEXT}, '[^\x20\x09-\x0D]+')"

_OP1 = f"""
WITH d AS (SELECT doc_id, source, len({_WORDS}) AS size,
    md5(coalesce(doc_id::VARCHAR, '') || ':' || md5({_TEXT})) AS key FROM documents),
s AS (SELECT source, sum(size)::BIGINT AS source_size FROM d GROUP BY source),
w AS (SELECT *, [5.0, 2.0, 1.0][((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3)::INT + 1]::DOUBLE
    AS weight, (2 * source_size)::DOUBLE AS most FROM s),
sums AS (SELECT *, sum(most) OVER (ORDER BY most / weight, source NULLS LAST) AS words_to,
    sum(weight) OVER (ORDER BY most / weight, source NULLS LAST) AS weight_to,
    sum(weight) OVER () AS weights, 1.5 * sum(source_size) OVER () AS wanted FROM w),
reached AS (SELECT *, words_to - most + most / weight * (weights - weight_to + weight) <= wanted AS is_full FROM sums),
unit AS (SELECT (max(wanted) - coalesce(sum(most) FILTER (WHERE is_full), 0))
    / nullif(sum(weight) FILTER (WHERE NOT is_full), 0) AS unit FROM reached),
t AS (SELECT source, source_size, CASE WHEN is_full THEN most ELSE weight * unit END::DOUBLE AS target
    FROM reached, unit),
p AS (SELECT d.*, source_size, target, coalesce(sum(size) OVER (PARTITION BY d.source ORDER BY key, doc_id, size
    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
    FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source),
e AS (SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size) ELSE 0 END AS epochs FROM p)
SELECT doc_id, size::BIGINT AS size, source_size, target, (epochs * size
    + least(size, greatest(0, floor(target) - epochs * source_size - before)))::BIGINT AS taken FROM e
"""

_OP4 = rf"""
WITH RECURSIVE d AS (SELECT doc_id, regexp_extract_all(
    translate({_TEXT}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS ws FROM documents),
s AS (SELECT doc_id, unnest(list_distinct(CASE WHEN len(ws) < 4 THEN [ws]
    ELSE list_transform(range(1, len(ws) - 2), lambda i: ws[i:i + 3]) END)) AS g FROM d WHERE len(ws) > 0),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
c AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM s a JOIN s b USING (g) WHERE a.doc_id <> b.doc_id GROUP BY ALL),
e AS (SELECT a, b FROM c JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * c >= 80 * (x.n + y.n - c)),
r(a, b) AS (SELECT a, b FROM e UNION SELECT r.a, e.b FROM r JOIN e ON r.b = e.a),
m AS (SELECT a, min(b) AS least FROM r GROUP BY a)
SELECT d.doc_id, coalesce(n, 0)::BIGINT AS n_shingles, least(d.doc_id, coalesce(least, d.doc_id)) AS component_id,
    d.doc_id = least(d.doc_id, coalesce(least, d.doc_id)) AS kept
    FROM d LEFT JOIN n USING (doc_id) LEFT JOIN m ON m.a = d.doc_id
"""

_OP6 = f"""
WITH d AS (SELECT doc_id, {_WORDS} AS ws FROM documents),
i AS (SELECT doc_id, ws, unnest(range(1, len(ws) - 11)) AS i FROM d WHERE len(ws) >= 13),
w AS (SELECT doc_id, i, array_to_string(ws[i:i + 12], ' ') AS g FROM i),
f AS (SELECT doc_id, i, min(doc_id) OVER (PARTITION BY g) AS first FROM w),
gone AS (SELECT DISTINCT doc_id, i + k AS i FROM f, range(13) AS r(k) WHERE first < doc_id),
l AS (SELECT doc_id, unnest(ws) AS word, unnest(range(1, len(ws) + 1)) AS i FROM d),
k AS (SELECT l.doc_id, count(gone.i) AS n_removed,
    string_agg(word, ' ' ORDER BY l.i) FILTER (WHERE gone.i IS NULL) AS kept
    FROM l LEFT JOIN gone ON l.doc_id = gone.doc_id AND l.i = gone.i GROUP BY l.doc_id)
SELECT d.doc_id, len(ws)::BIGINT AS n_words, coalesce(n_removed, 0)::BIGINT AS n_removed,
    sha256(coalesce(kept, '')) AS kept_sha256 FROM d LEFT JOIN k ON k.doc_id = d.doc_id
"""

_OP7 = rf"""
WITH b AS (SELECT doc_id, regexp_extract_all(translate({_TEXT}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM documents),
i AS (SELECT item_id, regexp_extract_all(translate({_TEXT}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM benchmark),
v AS (SELECT item_id, least(13, len(ws)) AS n, ws, unnest(range(1, greatest(1, len(ws) - 12) + 1)) AS i
    FROM i WHERE len(ws) > 0),
w AS (SELECT DISTINCT item_id, n, array_to_string(ws[i:i + n - 1], ' ') AS g FROM v),
p AS (SELECT doc_id, ws, unnest(range(1, len(ws) + 1)) AS i FROM b),
o AS (SELECT doc_id, i, n, array_to_string(ws[i:i + n - 1], ' ') AS g FROM p, (SELECT DISTINCT n FROM w) WHERE i + n - 1 <= len(ws)),
h AS (SELECT o.doc_id, o.i, o.n, w.item_id FROM o JOIN w ON w.g = o.g AND w.n = o.n),
c AS (SELECT doc_id, count(DISTINCT i + k)::BIGINT AS n_hit FROM h, range(13) AS r(k) WHERE k < n GROUP BY doc_id),
t AS (SELECT doc_id, count(*)::BIGINT AS n_items, string_agg(item_id::VARCHAR, ',' ORDER BY item_id::VARCHAR) AS items
    FROM (SELECT DISTINCT doc_id, item_id FROM h) GROUP BY doc_id)
SELECT b.doc_id, len(ws)::BIGINT AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
    sha256(coalesce(items, '')) AS items_sha256,
    coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(ws) AS contaminated
    FROM b LEFT JOIN c ON c.doc_id = b.doc_id LEFT JOIN t ON t.doc_id = b.doc_id
"""

_OP8 = rf"""
WITH d AS (SELECT doc_id, {_TEXT} AS t, {_WORDS} AS ws FROM documents),
m AS (SELECT doc_id, t, len(ws)::BIGINT AS n_words,
    length(regexp_replace(t, '[\x20\x09-\x0D]', '', 'g'))::BIGINT AS word_chars,
    (length(t) - length(translate(t, '#*$%&|<>', '')))::BIGINT AS n_symbols,
    (length(t) - length(translate(t, '!', '')))::BIGINT AS n_exclamations,
    list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS ls FROM d),
g AS (SELECT doc_id, unnest(list_transform(range(1, len(ws) - 3), lambda i: ws[i:i + 4])) AS g,
    unnest(range(1, len(ws) - 3)) AS i FROM d WHERE len(ws) >= 5),
twice AS (SELECT doc_id, i FROM (SELECT *, count(*) OVER (PARTITION BY doc_id, g) AS n FROM g) WHERE n > 1),
hit AS (SELECT doc_id, count(DISTINCT i + k)::BIGINT AS n FROM twice, range(5) AS r(k) GROUP BY doc_id),
a AS (SELECT m.*, (len(ls) - len(list_distinct(ls)))::BIGINT AS n_dup_lines, len(ls) AS n_lines,
    coalesce(hit.n, 0) AS n_repeat_words, regexp_matches(t, '\p{{L}}') AS letters
    FROM m LEFT JOIN hit ON m.doc_id IS NOT DISTINCT FROM hit.doc_id),
b AS (SELECT *, n_words < 10 AS b0, 100 * n_repeat_words > 20 * n_words AS b1, 2 * n_symbols > n_words AS b2,
    2 * n_exclamations > n_words AS b3, word_chars < 2 * n_words OR word_chars > 24 * n_words AS b4,
    2 * n_dup_lines > n_lines AS b5, NOT letters AS b6 FROM a)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, b0 OR b1 AS base_failed,
    NOT (b0 OR b1 OR b2 OR b3) AS kept, n_exclamations, (b0::BIGINT + 2 * b1::BIGINT + 4 * b2::BIGINT
    + 8 * b3::BIGINT + 16 * b4::BIGINT + 32 * b5::BIGINT + 64 * b6::BIGINT) AS fail_bits FROM b
"""

_OP9 = rf"""
WITH d AS (SELECT doc_id, {_TEXT} AS t, string_split({_TEXT}, chr(10)) AS ls FROM documents),
l AS (SELECT doc_id, unnest(ls) AS line, unnest(range(len(ls))) AS i FROM d),
f AS (SELECT doc_id, line, i FROM l WHERE regexp_matches(line, '[^\x20\x09-\x0D]')),
w AS (SELECT doc_id, [line, lead(line, 1) OVER o, lead(line, 2) OVER o] AS g,
    [i, lead(i, 1) OVER o, lead(i, 2) OVER o] AS pl FROM f WINDOW o AS (PARTITION BY doc_id ORDER BY i)),
n AS (SELECT *, row_number() OVER (PARTITION BY g ORDER BY doc_id, pl[1]) AS n FROM w WHERE pl[3] IS NOT NULL),
gone AS (SELECT DISTINCT doc_id, unnest(pl) AS i FROM n WHERE n > 1),
k AS (SELECT l.doc_id, count(gone.i) AS n_removed,
    coalesce(string_agg(line, chr(10) ORDER BY l.i) FILTER (WHERE gone.i IS NULL), '') AS kept
    FROM l LEFT JOIN gone USING (doc_id, i) GROUP BY l.doc_id)
SELECT doc_id, CASE WHEN t = '' THEN 0 ELSE len(ls) END::BIGINT AS n_lines, n_removed::BIGINT AS n_removed,
    sha256(kept) AS kept_sha256 FROM d JOIN k USING (doc_id)
"""

_OP10 = f"""
WITH d AS (SELECT doc_id, strlen({_TEXT})::BIGINT AS bytes,
    ('0x' || substr(md5(coalesce(doc_id::VARCHAR, '') || ':' || md5({_TEXT})), 1, 15))::BIGINT AS bits FROM documents),
p AS (SELECT depth, bits >> (60 - depth) AS prefix, sum(bytes)::BIGINT AS shard_bytes,
    min(bits) = max(bits) AS single FROM d, range(61) AS r(depth) GROUP BY ALL),
s AS (SELECT d.doc_id, d.bytes, d.bits, min(depth) AS depth FROM d JOIN p ON p.prefix = d.bits >> (60 - p.depth)
    WHERE shard_bytes <= {shards.LIMIT} OR single OR depth = 60 GROUP BY ALL)
SELECT doc_id, bytes, left(right(bin(bits | (1::BIGINT << 60)), 60), s.depth) AS shard, s.depth::BIGINT AS depth,
    shard_bytes FROM s JOIN p ON p.depth = s.depth AND p.prefix = s.bits >> (60 - s.depth)
"""

_LOWER = f"translate({_TEXT}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

_OP11 = rf"""
WITH w AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS ws FROM (SELECT coalesce(lang, 'und') AS lang,
    unnest(string_split_regex({_LOWER}, '[.,;:!?\x0A-\x0D]')) AS piece FROM documents)),
i AS (SELECT lang, ws, k, unnest(range(1, len(ws) - k + 2)) AS i FROM w, range(1, 4) AS r(k) WHERE len(ws) >= k),
g AS (SELECT lang, k, array_to_string(ws[i:i + k - 1], ' ') AS g, count(*)::BIGINT AS c FROM i GROUP BY ALL),
n AS (SELECT lang, sum(c)::BIGINT AS n FROM g WHERE k = 1 GROUP BY lang),
c AS (SELECT lang, k, g AS phrase, string_split(g, ' ') AS ws, c AS a FROM g WHERE k > 1 AND c >= 10),
s AS (SELECT c.lang, c.k, phrase, a, x.c AS l, y.c AS r, (a::HUGEINT * a * 1000000) // (x.c::HUGEINT * y.c) AS score,
    row_number() OVER (PARTITION BY c.lang, phrase ORDER BY (a::HUGEINT * a * 1000000) // (x.c::HUGEINT * y.c), j) AS cut
    FROM (SELECT *, unnest(range(1, k)) AS j FROM c) c
    JOIN g x ON x.lang = c.lang AND x.g = array_to_string(c.ws[1:j], ' ')
    JOIN g y ON y.lang = c.lang AND y.g = array_to_string(c.ws[j + 1:], ' ')),
m AS (SELECT lang, g, max(a) AS longer FROM (SELECT lang, a, unnest([array_to_string(ws[1:2], ' '),
    array_to_string(ws[2:3], ' ')]) AS g FROM c WHERE k = 3) GROUP BY ALL),
o AS (SELECT s.lang, phrase, a, l, r, n, score::BIGINT AS score,
    row_number() OVER (PARTITION BY s.lang ORDER BY score DESC, a DESC, phrase) AS rank
    FROM s JOIN n ON n.lang = s.lang LEFT JOIN m ON m.lang = s.lang AND m.g = phrase
    WHERE cut = 1 AND NOT coalesce(100 * longer >= 50 * a, false))
SELECT lang, rank, phrase, a, l, r, n, score FROM o WHERE rank <= 2000
"""

# A CRC is a fold over the bytes, which blob functions give two hexadecimal digits each.
_CRC = """list_reduce([4294967295::BIGINT] || list_transform(range(1, octet_length(encode(g)) + 1),
    lambda j: ('0x' || substr(hex(encode(g)), 2 * j - 1, 2))::BIGINT),
    lambda c, b: xor(t[(xor(c, b) & 255) + 1], c >> 8))"""

_OP12 = rf"""
WITH RECURSIVE e(v, x, k) AS (SELECT range, range, 0 FROM range(256) UNION ALL SELECT v,
    CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END, k + 1 FROM e WHERE k < 8),
tab AS (SELECT list(x ORDER BY v) AS t FROM e WHERE k = 8),
d AS (SELECT row_number() OVER () AS nr, doc_id, regexp_extract_all({_LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws
    FROM documents),
b AS (SELECT regexp_extract_all({_LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM benchmark),
f AS (SELECT nr, unnest(ws || list_transform(range(1, len(ws)), lambda i: ws[i] || ' ' || ws[i + 1])) AS g FROM d),
h AS (SELECT unnest(ws || list_transform(range(1, len(ws)), lambda i: ws[i] || ' ' || ws[i + 1])) AS g FROM b),
u AS (SELECT g, xor({_CRC}, 4294967295) % 10000 AS bucket FROM (SELECT g FROM f UNION SELECT g FROM h), tab),
q AS (SELECT nr, bucket FROM f JOIN u USING (g)),
s AS (SELECT bucket, count(*) AS s FROM q GROUP BY bucket),
t AS (SELECT bucket, count(*) AS t FROM h JOIN u USING (g) GROUP BY bucket),
z AS (SELECT (SELECT count(*) FROM q)::DOUBLE AS S, (SELECT count(*) FROM h)::DOUBLE AS T),
gain AS (SELECT bucket, floor(1000 * ln((coalesce(t.t, 0) + 1)::DOUBLE * (z.S + 10000)
    / ((s.s + 1)::DOUBLE * (z.T + 10000))))::BIGINT AS gain FROM s LEFT JOIN t USING (bucket), z),
w AS (SELECT nr, count(*)::BIGINT AS n, floor(sum(gain)::DOUBLE / count(*))::BIGINT AS weight FROM q JOIN gain USING (bucket)
    GROUP BY nr),
v AS (SELECT doc_id, len(ws) AS n_words, coalesce(n, 0) AS n_features, coalesce(weight, 0) AS weight,
    coalesce(weight, 0) + floor(-1000 * ln(-ln((('0x' || left(sha256('7:' || coalesce(doc_id::VARCHAR, '')), 8))::BIGINT
    + 0.5::DOUBLE) / 4294967296::DOUBLE)))::BIGINT AS score FROM d LEFT JOIN w USING (nr)),
r AS (SELECT *, n_words >= 20 AS able, row_number() OVER (PARTITION BY n_words >= 20
    ORDER BY score DESC, doc_id NULLS LAST, n_features) AS place, count(*) FILTER (WHERE n_words >= 20) OVER () AS n FROM v)
SELECT doc_id, n_features, weight, score, CASE WHEN able AND place <= 25 * n // 100 THEN place END AS rank FROM r
"""

_OP13 = rf"""
WITH c AS (SELECT conv_id, turn, role, text FROM conversations UNION ALL SELECT -1, i, ['user', 'assistant'][i + 1],
    '{_CONTROL}' FROM range(2) AS r(i)),
e AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text,
    replace(replace(replace(coalesce(role, ''), '\', '\\'), chr(10), '\n'), '<', '\l') AS r,
    regexp_replace(coalesce(text, ''), '<(\\*)\|', '<\\\1|', 'g') AS t FROM c),
f AS (SELECT *, '<|im_start|>' || r || chr(10) || t || '<|im_end|>' || chr(10) AS s FROM e)
SELECT conv_id, count(*)::BIGINT AS n_turns,
    sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS LAST, s)) AS turns_sha256,
    coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0)::BIGINT AS loss_chars,
    sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS LAST, s) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
    sum(length(s))::BIGINT AS formatted_chars FROM f GROUP BY conv_id
"""

ORACLES: dict[str, str] = {
    "op1_mixing": _OP1,
    "op4_near_duplicates": _OP4,
    "op6_substring_dedup": _OP6,
    "op7_decontamination": _OP7,
    "op8_quality_rules": _OP8,
    "op9_line_dedup": _OP9,
    "op10_sharding": _OP10,
    "op11_collocations": _OP11,
    "op12_resampling": _OP12,
    "op13_chat_formatting": _OP13,
}
