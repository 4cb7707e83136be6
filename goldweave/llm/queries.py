"""The training-data operators as queries over the test tables."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from goldweave.llm import (
    byte_bpe, divergence, jaccard, licenses, packing, periodic, quality, secrets, simhash, spotsigs,
    token_counts, token_files, warc,
)
from goldweave.llm.tables import read, texts
from goldweave.session import scratch

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None):
    def register(fn):
        QUERIES[fn.__name__] = fn
        if sql is not None:
            SQL[fn.__name__] = sql
        return fn

    return register


def _secret_sql() -> str:
    """Matches from the lengths of gaps and matches; each window's entropy counted anew."""
    known = [("assign", secrets.ASSIGN), ("access", secrets.ACCESS), ("hex", "[0-9a-f]{24,}")]
    patterns = known + [(c.name, f"{c.run}{{{c.window},}}") for c in secrets.CLASSES]
    found, spans = [], []
    for k, (kind, pattern) in enumerate(patterns):
        p = pattern.replace("'", "''")
        found.append(
            f"SELECT doc_id, {k} AS rank, '{kind}' AS kind, unnest(regexp_extract_all(t, '{p}')) AS m, "
            f"unnest(string_split_regex(t, '{p}')[:-2]) AS gap, "
            f"generate_subscripts(regexp_extract_all(t, '{p}'), 1) AS i FROM d")
    assign = secrets.ASSIGN.replace("'", "''")
    spans.append(
        f"SELECT doc_id, rank, kind, s, e FROM placed WHERE rank IN (1, 2) OR (rank = 0 AND "
        f"length(regexp_extract(m, '{assign}', 1)) >= {secrets.MIN_VALUE})")
    for k, c in enumerate(secrets.CLASSES, start=len(known)):
        rules = [f"regexp_matches(m, '{n}')" for n in c.needs]
        rules += [f"NOT regexp_matches(m, '{a}')" for a in secrets.ALLOWED]
        spans.append(f"""
SELECT doc_id, {k}, '{c.name}', min(s + o), max(s + o) + {c.window} FROM (
  SELECT *, sum(new) OVER (PARTITION BY doc_id, i ORDER BY o) AS island FROM (
    SELECT *, coalesce((o > lag(o) OVER (PARTITION BY doc_id, i ORDER BY o) + {c.window})::INT, 1) AS new
    FROM (SELECT *, unnest(range(0, length(m) - {c.window} + 1)) AS o FROM placed
          WHERE rank = {k} AND {' AND '.join(rules)})
    WHERE list_aggregate(string_split(substr(m, o + 1, {c.window}), ''), 'entropy') >= {c.bits}))
GROUP BY doc_id, i, island""")
    text = "kind || ':' || s || ':' || e"
    return f"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
found AS ({' UNION ALL '.join(found)}),
placed AS (SELECT *, e - length(m) AS s FROM (SELECT *, CAST(sum(length(gap) + length(m)) OVER (
  PARTITION BY doc_id, rank ORDER BY i) AS BIGINT) AS e FROM found)),
spans AS ({' UNION ALL '.join(spans)}),
per AS (SELECT doc_id, count(*) FILTER (rank = 0) AS n_assign, count(*) FILTER (rank = 1) AS n_access,
  count(*) FILTER (rank = 2) AS n_hex,
  string_agg({text}, ',' ORDER BY s, rank) FILTER (rank < 3) AS base,
  string_agg({text}, ',' ORDER BY s, rank) AS every FROM spans GROUP BY doc_id)
SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access,
  coalesce(n_hex, 0) AS n_hex, sha256(coalesce(base, '')) AS base_sha256,
  coalesce(every, '') AS spans
FROM d LEFT JOIN per USING (doc_id)"""


@query(_secret_sql())
def op1_secret_scans(spark: SparkSession, folder: str) -> DataFrame:
    found = secrets.find_secrets(read(spark, folder, "documents"))

    def count(kind: str):
        return F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    return found.select(
        "doc_id", count("assign"), count("access"), count("hex"),
        F.sha2(secrets.span_text(F.col("base")), 256).alias("base_sha256"),
        secrets.span_text(F.col("found")).alias("spans"))


@query()
def op2_ngram_jaccard_join(spark: SparkSession, folder: str) -> DataFrame:
    return jaccard.near_duplicates(read(spark, folder, "documents"))


@query()
def op3_token_files(spark: SparkSession, folder: str) -> DataFrame:
    path = scratch(spark, "tokens")
    token_files.write_tokens(
        read(spark, folder, "documents"), path, public_tokenizers.path("word_bpe_49k.json"),
        end_id=2)
    return token_files.read_tokens(spark, path, digest=True)


def _quality_sql() -> str:
    lengths = sorted(quality.NGRAM_SHARES)
    grams = ", ".join(
        f"CASE WHEN i + {n - 1} <= len(ws) THEN array_to_string(ws[i:i + {n - 1}], ' ') END AS g{n}"
        for n in lengths)
    twice = ", ".join(
        f"(g{n} IS NOT NULL AND count(*) OVER (PARTITION BY doc_id, g{n}) > 1)::INT AS d{n}"
        for n in lengths)
    cover = ", ".join(
        f"max(d{n}) OVER (PARTITION BY doc_id ORDER BY i ROWS {n - 1} PRECEDING) AS c{n}"
        for n in lengths)
    shares = ", ".join(
        f"sum(CASE WHEN c{n} = 1 THEN length(w) ELSE 0 END) / greatest(sum(length(w)), 1) AS s{n}"
        for n in lengths)
    passed = " AND ".join(f"coalesce(s{n}, 0) <= {m}" for n, m in quality.NGRAM_SHARES.items())
    failed = (f"(coalesce(n_words, 0) < {quality.MIN_WORDS} OR 100 * coalesce(n_repeat_words, 0) > "
              f"{quality.BASE_PERCENT} * coalesce(n_words, 0))")
    blank = r"[\x20\x09-\x0D]"
    return rf"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
w AS (SELECT doc_id, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS ws FROM d),
words AS (SELECT doc_id, ws, unnest(ws) AS w, generate_subscripts(ws, 1) AS i FROM w),
grams AS (SELECT doc_id, i, w, {grams} FROM words),
twice AS (SELECT doc_id, i, w, {twice} FROM grams),
cover AS (SELECT doc_id, w, {cover} FROM twice),
per AS (SELECT doc_id, count(*) AS n_words, CAST(sum(length(w)) AS BIGINT) AS word_chars,
  CAST(sum(c5) AS BIGINT) AS n_repeat_words, {shares} FROM cover GROUP BY doc_id),
lines AS (SELECT doc_id, unnest(string_split(t, chr(10))) AS line,
  generate_subscripts(string_split(t, chr(10)), 1) AS i FROM d),
ranked AS (SELECT doc_id, line, row_number() OVER (PARTITION BY doc_id, line ORDER BY i) AS nth
  FROM lines WHERE regexp_matches(line, '[^\x20\x09-\x0D]')),
dup AS (SELECT doc_id, count(*) AS n_dup_lines,
  sum(length(regexp_replace(line, '{blank}', '', 'g'))) AS line_chars
  FROM ranked WHERE nth > 1 GROUP BY doc_id),
symbols AS (SELECT doc_id, length(t) AS n_text,
  length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) AS n_symbols FROM d)
SELECT doc_id, coalesce(n_words, 0) AS n_words, coalesce(word_chars, 0) AS word_chars, n_symbols,
  coalesce(n_dup_lines, 0) AS n_dup_lines, coalesce(n_repeat_words, 0) AS n_repeat_words,
  {failed} AS base_failed,
  NOT {failed} AND {passed}
    AND coalesce(line_chars, 0) / greatest(coalesce(word_chars, 0), 1) <= {quality.LINE_SHARE}
    AND n_symbols / greatest(n_text, 1) <= {quality.SYMBOL_SHARE} AS kept
FROM symbols LEFT JOIN per USING (doc_id) LEFT JOIN dup USING (doc_id)"""


@query(_quality_sql())
def op4_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    return quality.quality(read(spark, folder, "documents")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        "base_failed", "kept")


@query()
def op5_retrieval_packing(spark: SparkSession, folder: str) -> DataFrame:
    return packing.digest(packing.pack(
        read(spark, folder, "documents"), public_tokenizers.path("byte_bpe_50k.json"), end_id=1))


@query()
def op6_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    return token_counts.count_tokens(
        read(spark, folder, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


@query()
def op7_license_scans(spark: SparkSession, folder: str) -> DataFrame:
    return licenses.scan_licenses(read(spark, folder, "documents"))


@query()
def op8_byte_bpe(spark: SparkSession, folder: str) -> DataFrame:
    ranks, pattern = public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN
    return byte_bpe.round_trip(read(spark, folder, "documents"), ranks, pattern)


@query("""
WITH p AS (SELECT page_id, coalesce(html, '') AS h, encode(coalesce(html, '')) AS b FROM pages),
m AS (SELECT page_id, octet_length(b) AS n, sha1(h) AS d FROM p),
r AS (SELECT *, min(page_id) OVER (PARTITION BY d) AS f FROM m),
bits AS (SELECT page_id, n, f, d, list_reduce(list_transform(range(32), lambda k: substr(
  'ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + CAST(concat('0b', substr(list_reduce(list_transform(
  range(1, 41), lambda j: lpad(bin(CAST(concat('0x', substr(d, j, 1)) AS INTEGER)), 4, '0')),
  lambda x, y: x || y), 5 * k + 1, 5)) AS INTEGER), 1)), lambda x, y: x || y) AS b32 FROM r)
SELECT page_id, n AS payload_bytes, b32 AS payload_digest,
  CASE WHEN page_id = f THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id = f THEN NULL ELSE f END AS refers_to, CAST(NULL AS VARCHAR) AS problem FROM bits""")
def op9_warc(spark: SparkSession, folder: str) -> DataFrame:
    path = scratch(spark, "warc")
    warc.write_warc(read(spark, folder, "pages"), path)
    return warc.read_warc(spark, path)


def _spot_sql() -> str:
    anchors = "|".join(sorted(spotsigs.ANCHORS, key=len, reverse=True))
    groups = rf"regexp_extract_all(trim(regexp_replace(lower(x), '[^\p{{L}}\p{{N}}]+', ' ', 'g')), '(?:(?:{anchors}) )*[^ ]+')"
    return f"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
n AS (SELECT doc_id, t, coalesce(lead(t) OVER (ORDER BY doc_id DESC),
  first_value(t) OVER (ORDER BY doc_id DESC)) AS o, length(t) // 2 AS h FROM d),
e AS (SELECT doc_id, t, o, substr(t, 1, length(t) - h) || substr(o, 1, h) AS e FROM n),
every AS (SELECT DISTINCT x FROM (SELECT t AS x FROM e UNION ALL SELECT e FROM e)),
g AS (SELECT x, {groups} AS gs FROM every),
r AS (SELECT x, unnest(gs) AS own, unnest(list_append(gs[2:], '')) AS after FROM g),
c AS (SELECT x, contains(own, ' ') AS spot, max(contains(own, ' ')) OVER (PARTITION BY x) AS spots,
  substr(md5(CASE WHEN contains(own, ' ') THEN array_to_string(string_split(own, ' ')[-2:], ' ')
    ELSE own END || ' ' || string_split(after, ' ')[-1]), 1, {spotsigs.DIGITS}) AS s FROM r),
sets AS (SELECT x, list_sort(list(DISTINCT s)) AS v FROM c WHERE spot = spots GROUP BY x),
j AS (SELECT doc_id, length(t) AS n_chars, sha256(e) AS edited_sha256, coalesce(a.v, []) AS a,
  coalesce(b.v, []) AS b, coalesce(k.v, []) AS k FROM e LEFT JOIN sets a ON a.x = t
  LEFT JOIN sets b ON b.x = e LEFT JOIN sets k ON k.x = o),
l AS (SELECT *, len(list_intersect(a, b)) AS ab, len(list_intersect(a, k)) AS ak FROM j)
SELECT doc_id, n_chars, edited_sha256, array_to_string(a, '') AS fingerprint,
  array_to_string(b, '') AS edited_fingerprint,
  CASE WHEN a = b THEN 1.0::DOUBLE ELSE ab / (len(a) + len(b) - ab) END AS near_edited,
  CASE WHEN a = k THEN 1.0::DOUBLE ELSE ak / (len(a) + len(k) - ak) END AS near_next FROM l"""


@query(_spot_sql())
def op10_document_fingerprints(spark: SparkSession, folder: str) -> DataFrame:
    return spotsigs.compare_edited(read(spark, folder, "documents"))


def _planted_sql() -> str:
    """Words of each text with the planted periods, as ``ws``; CRC-32 bit by bit."""
    return r"""
d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws FROM documents),
c AS (SELECT doc_id, ws, len(ws) AS n, CAST(xor(list_reduce(list_concat([4294967295],
  flatten(list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda s: list_concat(
    [CAST(ascii(s) AS BIGINT)], list_transform(range(8), lambda z: CAST(-1 AS BIGINT)))))),
  lambda x, y: CASE WHEN y >= 0 THEN xor(x, y) WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END),
  4294967295) AS BIGINT) AS h FROM d),
g AS (SELECT *, (h // 10) % greatest(n, 1) AS a, 3 + (h // 10) % 8 AS k FROM c),
t AS (SELECT doc_id, n, CASE WHEN h % 10 = 0 AND n > 0 THEN list_transform(range(n), lambda i:
  ws[1 + CASE WHEN i >= a THEN a + (i - a) % (1 + (n - a) // k) ELSE i END]) ELSE ws END AS ws FROM g)"""


@query(f"""
WITH {_planted_sql()},
w AS (SELECT doc_id, n, unnest(ws) AS w, generate_subscripts(ws, 1) - 1 AS i FROM t),
m AS (SELECT x.doc_id, y.i - x.i AS q, x.i FROM w x JOIN w y
  ON x.doc_id = y.doc_id AND x.w = y.w AND y.i > x.i AND y.i - x.i <= x.n // 3),
s AS (SELECT doc_id, q, i - row_number() OVER (PARTITION BY doc_id, q ORDER BY i) AS island, i FROM m),
f AS (SELECT doc_id, q, min(i) AS st, count(*) + q AS len FROM s GROUP BY doc_id, q, island
  HAVING count(*) + q >= greatest(24, 3 * q)),
r AS (SELECT doc_id, st, len, min(q) AS q FROM f GROUP BY ALL),
b AS (SELECT doc_id, st, len, q FROM r QUALIFY row_number() OVER (
  PARTITION BY doc_id ORDER BY CAST(len AS DOUBLE) / q DESC, st, q) = 1),
a AS (SELECT doc_id, count(*) AS n_runs,
  string_agg(st || ',' || len || ',' || q || chr(10), '' ORDER BY st, q) AS runs FROM r GROUP BY doc_id),
o AS (SELECT DISTINCT doc_id, unnest(range(st + q, st + len)) AS i FROM r),
k AS (SELECT w.doc_id, string_agg(w.w, ' ' ORDER BY w.i) AS txt FROM w ANTI JOIN o
  ON w.doc_id = o.doc_id AND w.i = o.i GROUP BY w.doc_id)
SELECT t.doc_id, coalesce(n_runs, 0) AS n_runs, CAST(st AS BIGINT) AS start, CAST(len AS BIGINT) AS length,
  CAST(q AS BIGINT) AS period, CAST(1000 * len // q AS BIGINT) AS exponent_milli,
  sha256(coalesce(runs, '')) AS runs_sha256, sha256(coalesce(txt, '')) AS collapsed_sha256
FROM t LEFT JOIN b USING (doc_id) LEFT JOIN a USING (doc_id) LEFT JOIN k USING (doc_id)""")
def op11_periodic_runs(spark: SparkSession, folder: str) -> DataFrame:
    found = periodic.find_runs(planted(read(spark, folder, "documents")), id_col="id")
    best = F.aggregate(
        "runs", F.lit(None).cast("struct<start:bigint,length:bigint,period:bigint>"),
        # By start, then period: an equal exponent does not replace what stands.
        lambda b, r: F.when(
            b.isNull() | (r["length"] * b["period"] > b["length"] * r["period"]), r).otherwise(b))
    lines = F.transform("runs", lambda r: F.concat(
        r["start"], F.lit(","), r["length"], F.lit(","), r["period"], F.lit("\n")))
    return found.withColumn("best", best).select(
        F.col("id").alias("doc_id"), F.size("runs").cast("long").alias("n_runs"),
        "best.start", "best.length", "best.period",
        F.expr("1000 * best.length div best.period").alias("exponent_milli"),
        F.sha2(F.array_join(lines, ""), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"))


def planted(documents: DataFrame) -> DataFrame:
    """Documents as ``id`` and ``text``, with a period planted in those whose id's CRC-32 ends in 0.

    A null id has no CRC-32 and its texts stay as they are.
    """
    rows = texts(documents, "doc_id", "text").withColumn("h", F.crc32(F.col("id").cast("string")))
    rows = rows.withColumn("words", F.when(
        F.col("h") % 10 == 0, F.regexp_extract_all("text", F.lit(r"[^\x20\x09-\x0D]+"), F.lit(0))))
    rows = rows.withColumns({"n": F.size("words"), "g": F.expr("h div 10")})
    return rows.select("id", F.expr("""
      CASE WHEN n > 0 THEN concat_ws(' ', slice(concat(
        slice(words, 1, cast(g % n as int)),
        flatten(array_repeat(
          slice(words, cast(g % n as int) + 1, cast(1 + (n - g % n) div (3 + g % 8) as int)),
          cast((n - g % n) div (1 + (n - g % n) div (3 + g % 8)) + 1 as int)))), 1, n))
      ELSE text END""").alias("text"))


def _divergence_sql() -> str:
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    price = "CAST(1 + 1000000000 * (CAST({} AS HUGEINT) + 5) // ({} + 5 * v) AS BIGINT)"
    return rf"""
WITH d AS (SELECT row_number() OVER () AS id, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
  coalesce(text, '') AS t FROM documents),
w AS (SELECT id, lang, source, unnest(regexp_extract_all(
  translate(t, '{upper}', '{upper.lower()}'), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM d),
kept AS (SELECT lang, term, count(*) AS c FROM w GROUP BY lang, term HAVING count(DISTINCT id) >= 30),
size AS (SELECT lang, count(*) AS v, sum(c) AS n FROM kept GROUP BY lang),
g AS (SELECT DISTINCT lang, source FROM d),
c AS (SELECT lang, source, term, count(*) AS c FROM w JOIN kept USING (lang, term) GROUP BY ALL),
total AS (SELECT lang, source, sum(c) AS n FROM c GROUP BY ALL),
p AS (SELECT g.lang, g.source, kept.term, coalesce(c.c, 0) AS c,
  {price.format("coalesce(c.c, 0)", "coalesce(total.n, 0)")} AS p, {price.format("kept.c", "size.n")} AS q
  FROM g JOIN kept USING (lang) JOIN size USING (lang) LEFT JOIN c USING (lang, source, term)
  LEFT JOIN total USING (lang, source)),
s AS (SELECT a.lang, a.source, b.source AS item, CAST(sum(abs(a.p - b.p)) AS BIGINT) AS value
  FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
pair AS (SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(value, 0) AS value
  FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN s ON s.lang = a.lang AND s.source = a.source AND s.item = b.source),
term AS (SELECT lang, source, 'term' AS part, term AS item, p - q AS value FROM p WHERE c > 0 AND p > q)
SELECT *, CAST(row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS INT) AS rank
FROM (SELECT * FROM pair UNION ALL SELECT * FROM term) QUALIFY part = 'pair' OR rank <= 50"""


@query(_divergence_sql())
def op12_source_divergence(spark: SparkSession, folder: str) -> DataFrame:
    return divergence.audit(read(spark, folder, "documents"))


@query()
def op13_simhash_neardup(spark: SparkSession, folder: str) -> DataFrame:
    return simhash.near_duplicates(read(spark, folder, "documents"))


@query()
def pipeline(spark: SparkSession, folder: str) -> DataFrame:
    import corpus_pipeline  # stands outside of the package, and imports from it

    return corpus_pipeline.run(spark, folder)
