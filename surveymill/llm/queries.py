"""The queries of the operators in this subpackage, and their DuckDB SQL where SQL can express them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from surveymill.llm import boilerplate, collisions, collocations, packing, quality, sampling, secrets, simhash, simple8b, topk, urls, warc, whitening
from surveymill.llm.common import table


def op1_simple8b_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    read = simple8b.token_files(table(spark, sf_dir, "documents"))
    return read.select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


def op2_host_reputation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The number in a page's path names the document it shows. Outcomes are that document's labels: bad if of low
    quality or toxic."""
    pages, labels = table(spark, sf_dir, "pages"), table(spark, sf_dir, "labels")
    shown = pages.select("page_id", F.regexp_extract(urls.path_of(F.col("url")), "/([0-9]{1,18})", 1).alias("number"))
    bad = labels.select("doc_id", ((F.col("quality") == 0) | (F.col("toxic") == 1)).alias("bad"))
    outcomes = shown.join(bad, F.col("number").try_cast("long") == F.col("doc_id")).select("page_id", "bad")
    return urls.judge_urls(pages, outcomes)


def op3_simhash_trie_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    hexed = F.lpad(F.lower(F.hex("fp")), 16, "0")
    return found.select("doc_id", hexed.alias("fingerprint"), "component_id")


def op4_differencing_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = packing.pack(table(spark, sf_dir, "documents"))
    return pieces.select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset"
    )


def op5_rule_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    entries = quality.ledger(table(spark, sf_dir, "documents"))
    base, kept = quality.passes(quality.BASE, F.col("failed")), quality.passes(quality.POLICY, F.col("failed"))
    return entries.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        (~base).alias("base_failed"), kept.alias("kept"), "failed",
    )


def op6_randomness_battery(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secrets.find_secrets(table(spark, sf_dir, "documents"))
    names = F.array(*map(F.lit, secrets.KINDS))

    def listed(spans):
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", names[s["kind"]], s["start"], s["end"])), ",")

    def count(kind):
        number = secrets.KINDS.index(kind)
        return F.size(F.filter("spans", lambda s: s["kind"] == number)).cast("long").alias(f"n_{kind}")

    base = F.filter("spans", lambda s: s["kind"] < secrets.KINDS.index("random"))
    return found.select(
        "doc_id", count("assign"), count("access"), count("hex"),
        F.sha2(listed(base), 256).alias("base_sha256"), listed("spans").alias("spans"),
    )


def op7_warc_revisits(spark: SparkSession, sf_dir: str) -> DataFrame:
    records = warc.archived(table(spark, sf_dir, "pages"))
    return records.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op8_sampled_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    sampled = sampling.sample_pieces(docs)
    return sampled.select(
        F.col("key").alias("doc_id"), F.size("ids").cast("long").alias("n_pieces"),
        F.xxhash64("ids").alias("ids_hash"), F.crc32("decoded").alias("decoded_crc32"),
    )


def op9_no_random_access_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_k(table(spark, sf_dir, "embeddings"), "id % 50 = 0")


def op10_site_relative_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents of a source are the pages of a host."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", "text")
    lines = F.coalesce(F.size(F.split("text", "\n")), F.lit(0)).cast("long")
    cleaned = boilerplate.drop_boilerplate(docs.withColumn("n_lines", F.when(F.col("text").isNull(), 0).otherwise(lines)))
    return cleaned.select("doc_id", "n_lines", F.octet_length("text").cast("long").alias("kept_bytes"), F.md5("text").alias("kept_md5"))


def op11_collision_counting_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collisions.nearest_neighbours(table(spark, sf_dir, "embeddings"), "id % 20 = 0")


def op12_polarisation_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = whitening.whiten(table(spark, sf_dir, "embeddings"))
    each = rows.select("*", F.posexplode(F.arrays_zip("whitened", "explained")).alias("place", "of"))
    return each.select(
        F.col("id").alias("vec_id"), (F.col("place") + 1).alias("component"), "n", F.col("deviation").cast("long").alias("deviation"),
        "of.whitened", "of.explained", "identity_error",
    )


def op13_phrase_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(table(spark, sf_dir, "documents"))


QUERIES = {
    f.__name__: f
    for f in (
        op1_simple8b_token_files, op2_host_reputation, op3_simhash_trie_join, op4_differencing_packing, op5_rule_ledger,
        op6_randomness_battery, op7_warc_revisits, op8_sampled_pieces, op9_no_random_access_top_k, op10_site_relative_lines,
        op11_collision_counting_neighbours, op12_polarisation_whitening, op13_phrase_collocations,
    )
}

_WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"

_REPUTATION = """
WITH hosted AS (
  SELECT page_id,
    translate(regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    regexp_extract(coalesce(url, ''), '(?s)^.*?://[^/?#]*([^?#]*)', 1) AS path
  FROM pages
), outcomes AS (
  SELECT page_id, max(CASE WHEN quality = 0 OR toxic = 1 THEN 1 ELSE 0 END) AS bad
  FROM hosted JOIN labels ON doc_id = TRY_CAST(regexp_extract(path, '/([0-9]{{1,18}})', 1) AS BIGINT) GROUP BY page_id
), hosts AS (
  SELECT host, count(o.bad) AS n, coalesce(sum(o.bad), 0)::BIGINT AS bad, string_split(host, '.') AS labels
  FROM hosted h LEFT JOIN outcomes o USING (page_id) GROUP BY host
), parts AS (
  SELECT host, n, bad, array_to_string(labels[-2:], '.') AS last_two, array_to_string(labels[-3:], '.') AS last_three, labels[-1] AS last_one
  FROM hosts
), placed AS (
  SELECT host, n, bad,
    CASE WHEN {suffixes} THEN last_three ELSE last_two END AS domain,
    CASE WHEN {suffixes} THEN last_two ELSE last_one END AS suffix
  FROM parts
), domains AS (SELECT domain, suffix, sum(n) AS n, sum(bad) AS bad FROM placed GROUP BY ALL
), suffixes AS (SELECT suffix, sum(n) AS n, sum(bad) AS bad FROM domains GROUP BY ALL
), members AS (
  SELECT 'host' AS level, n::DOUBLE AS n, bad::DOUBLE AS bad FROM placed UNION ALL
  SELECT 'domain', n::DOUBLE, bad::DOUBLE FROM domains UNION ALL
  SELECT 'suffix', n::DOUBLE, bad::DOUBLE FROM suffixes
), sums AS (
  SELECT level, count(*) - 1 AS m1, sum(n) AS n, sum(bad) / sum(n) AS p, sum(n * n) / sum(n) AS heavy, sum(bad * bad / n) AS shares
  FROM members WHERE n > 0 GROUP BY level
), spreads AS (
  SELECT level, n, p, shares - n * p * p - p * (1 - p) * m1 AS between, p * (1 - p) * (n - heavy - m1) AS room FROM sums
), priors AS (
  SELECT level, n, p,
    CASE WHEN room > 0 AND between / room > 1 / ({strongest} + 1)
      THEN greatest({weakest}, 1 / (between / room) - 1) ELSE {strongest} END AS strength
  FROM spreads
), overall AS (
  SELECT coalesce((SELECT (n * p + 1) / (n + 2) FROM priors WHERE level = 'host'), 0.5) AS share,
    coalesce((SELECT strength FROM priors WHERE level = 'host'), {strongest}) AS host_s,
    coalesce((SELECT strength FROM priors WHERE level = 'domain'), {strongest}) AS domain_s,
    coalesce((SELECT strength FROM priors WHERE level = 'suffix'), {strongest}) AS suffix_s
), drawn AS (
  SELECT p.host, p.n, p.bad, host_s, share AS overall,
    (d.bad + domain_s * ((s.bad + suffix_s * share) / (s.n + suffix_s))) / (d.n + domain_s) AS parent
  FROM placed p JOIN domains d USING (domain, suffix) JOIN suffixes s USING (suffix), overall
), counted AS (
  SELECT *, bad + host_s * parent AS a, n - bad + host_s * (1 - parent) AS b FROM drawn
), points AS (
  SELECT host, n, bad, overall, (bad + host_s * parent) / (n + host_s) AS share, a, b,
    unnest(list_transform(range(-{points}, {points} + 1), lambda k: ln(a / b) + sqrt(1 / a + 1 / b) * (k * {step}))) AS odds FROM counted
), reputed AS (
  SELECT host, n, bad, share, sum(CASE WHEN 1 / (1 + exp(-odds)) > {multiple} * overall THEN f ELSE 0 END) / sum(f) AS above
  FROM (SELECT *, exp(-a * ln(1 + exp(-odds)) - b * ln(1 + exp(odds)) - (a * ln(a / (a + b)) + b * ln(b / (a + b)))) AS f FROM points) p
  GROUP BY ALL
), judged AS (
  SELECT h.page_id, h.host, h.path, d.n, d.bad, round(share, 6) AS share, round(above, 6) AS above,
    CASE WHEN round(above, 6) >= {certainty} THEN 'block' ELSE 'allow' END AS method,
    CASE {rules} END AS rule
  FROM hosted h JOIN reputed d USING (host)
)
SELECT page_id, host, path, rule, CASE rule {verdicts} ELSE method END AS verdict, n AS n_labelled, bad AS n_bad, share, above FROM judged
"""


def _reputation_sql() -> str:
    longest = sorted(urls.RULES, key=lambda rule: (len(rule[0]), rule[0]), reverse=True)
    fits = []
    for rule, _ in longest:
        host, slash, path = rule.partition("/")
        fits.append(
            f"WHEN (h.host = '{host}' OR ends_with(h.host, '.{host}')) AND starts_with(h.path, '{slash}{path}') THEN '{rule}'"
        )
    return _REPUTATION.format(
        suffixes=f"(regexp_full_match(last_two, '({'|'.join(urls.REGISTRIES)})[.][a-z][a-z]') OR list_contains({list(urls.SHARED_SUFFIXES)}, last_two))",
        strongest=f"{urls.STRONGEST}::DOUBLE", weakest=f"{urls.WEAKEST}::DOUBLE", multiple=f"{urls.BAD_MULTIPLE}::DOUBLE",
        certainty=f"{urls.CERTAINTY}::DOUBLE", points=urls.POINTS, step=f"{urls.STEP}::DOUBLE",
        rules=" ".join(fits), verdicts=" ".join(f"WHEN '{rule}' THEN '{verdict}'" for rule, verdict in urls.RULES),
    )


_LEDGER = rf"""
WITH split AS (
  SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text, {_WORDS} AS words FROM documents
), counted AS (
  SELECT r, doc_id, len(words)::BIGINT AS n_words, coalesce(list_sum(list_transform(words, lambda w: length(w))), 0)::BIGINT AS word_chars,
    len(regexp_extract_all(text, '[#*$%&|<>]'))::BIGINT AS n_symbols,
    list_filter(string_split(text, chr(10)), lambda l: regexp_matches(l, '[^\x20\x09-\x0D]')) AS lines,
    len(regexp_extract_all(text, '[A-Z]')) AS n_upper, len(regexp_extract_all(text, '[A-Za-z]')) AS n_letters
  FROM split
), numbered AS (
  SELECT r, unnest(words) AS word, generate_subscripts(words, 1) AS i FROM split
), windows AS (
  SELECT r, i, CASE WHEN lead(word, 4) OVER w IS NOT NULL THEN concat_ws(' ', word, lead(word, 1) OVER w, lead(word, 2) OVER w,
    lead(word, 3) OVER w, lead(word, 4) OVER w) END AS win
  FROM numbered WINDOW w AS (PARTITION BY r ORDER BY i)
), twice AS (
  SELECT r, i, CASE WHEN win IS NOT NULL AND count(*) OVER (PARTITION BY r, win) > 1 THEN 1 ELSE 0 END AS again FROM windows
), covered AS (
  SELECT r, max(again) OVER (PARTITION BY r ORDER BY i ROWS BETWEEN 4 PRECEDING AND CURRENT ROW) AS c FROM twice
), repeats AS (SELECT r, sum(c)::BIGINT AS n_repeat_words FROM covered GROUP BY r
), measured AS (
  SELECT r, doc_id, n_words, word_chars, n_symbols, (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines,
    coalesce(n_repeat_words, 0) AS n_repeat_words, len(lines) AS n_lines, n_upper, n_letters
  FROM counted LEFT JOIN repeats USING (r)
), judged AS (
  SELECT *, ({{failed}})::BIGINT AS failed FROM measured
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, (failed & {{base}}) <> 0 AS base_failed,
  (failed & {{policy}}) = 0 AS kept, failed
FROM judged
"""


def _ledger_sql() -> str:
    failed = " + ".join(f"CASE WHEN {test} THEN {1 << bit} ELSE 0 END" for bit, (_, test) in enumerate(quality.RULES))
    return _LEDGER.format(failed=failed, base=quality.BASE.mask, policy=quality.POLICY.mask)


_PHRASES = r"""
WITH docs AS (
  SELECT row_number() OVER () AS doc, coalesce(lang, '{no_lang}') AS lang,
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text FROM documents
), pieces AS (
  SELECT doc, lang, unnest(regexp_split_to_array(text, '[.,;:!?\x0A-\x0D]')) AS piece FROM docs
), numbered AS (SELECT row_number() OVER () AS p, lang, regexp_extract_all(piece, '[^\x20\x09]+') AS words FROM pieces
), tokens AS (SELECT p, lang, unnest(words) AS word, generate_subscripts(words, 1) AS i FROM numbered
), totals AS (SELECT lang, count(*) AS n FROM tokens GROUP BY lang
), ahead AS (
  SELECT lang, word AS w1, lead(word, 1) OVER w AS w2, lead(word, 2) OVER w AS w3, lead(word, 3) OVER w AS w4, lead(word, 4) OVER w AS w5
  FROM tokens WINDOW w AS (PARTITION BY p ORDER BY i)
), counted AS (
  SELECT lang, [w1] AS words, count(*) AS f FROM ahead GROUP BY lang, w1 HAVING count(*) >= {min_count} UNION ALL
  SELECT lang, [w1, w2], count(*) FROM ahead WHERE w2 IS NOT NULL GROUP BY lang, w1, w2 HAVING count(*) >= {min_count} UNION ALL
  SELECT lang, [w1, w2, w3], count(*) FROM ahead WHERE w3 IS NOT NULL GROUP BY lang, w1, w2, w3 HAVING count(*) >= {min_count} UNION ALL
  SELECT lang, [w1, w2, w3, w4], count(*) FROM ahead WHERE w4 IS NOT NULL GROUP BY lang, w1, w2, w3, w4 HAVING count(*) >= {min_count} UNION ALL
  SELECT lang, [w1, w2, w3, w4, w5], count(*) FROM ahead WHERE w5 IS NOT NULL GROUP BY lang, w1, w2, w3, w4, w5 HAVING count(*) >= {min_count}
), inside AS (
  SELECT c.lang, c.words[s.s : s.s + z.z - 1] AS words, max(c.f) AS longer
  FROM counted c JOIN (SELECT unnest([2, 3, 4]) AS z) z ON len(c.words) > z.z JOIN (SELECT unnest([1, 2, 3, 4]) AS s) s ON s.s + z.z - 1 <= len(c.words)
  GROUP BY ALL
), candidates AS (
  SELECT c.lang, c.words, c.f FROM counted c LEFT JOIN inside i USING (lang, words)
  WHERE len(c.words) >= 2 AND NOT coalesce(100::HUGEINT * i.longer >= {contained}::HUGEINT * c.f, false)
), cuts AS (
  SELECT c.lang, c.words, c.f AS a, k.k, l.f AS l, r.f AS r, t.n,
    ({scale}::HUGEINT * c.f * t.n) // (l.f::HUGEINT * r.f) AS score
  FROM candidates c JOIN (SELECT unnest([1, 2, 3, 4]) AS k) k ON k.k < len(c.words)
    JOIN counted l ON l.lang = c.lang AND l.words = c.words[: k.k] JOIN counted r ON r.lang = c.lang AND r.words = c.words[k.k + 1 :]
    JOIN totals t ON t.lang = c.lang
), worst AS (SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, words ORDER BY score, k) = 1
), ranked AS (
  SELECT lang, array_to_string(words, ' ') AS phrase, a, l, r, n, score::BIGINT AS score FROM worst
)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase)::BIGINT AS rank, phrase, a, l, r, n, score
FROM ranked QUALIFY rank <= {top}
"""


def _phrases_sql() -> str:
    return _PHRASES.format(
        no_lang=collocations.NO_LANG, min_count=collocations.MIN_COUNT, contained=collocations.CONTAINED,
        scale=collocations.SCALE, top=collocations.TOP,
    )


ORACLES: dict[str, str] = {
    "op13_phrase_collocations": _phrases_sql(),
    "op2_host_reputation": _reputation_sql(),
    "op5_rule_ledger": _ledger_sql(),
    "op7_warc_revisits": f"""
        WITH payloads AS (
          SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes, sha256(coalesce(html, '')) AS payload_digest FROM pages
        ), found AS (
          SELECT *, CASE WHEN payload_bytes >= {warc.MIN_PAYLOAD} THEN min(page_id) OVER (PARTITION BY payload_digest) END AS original
          FROM payloads
        )
        SELECT page_id, payload_bytes, payload_digest, CASE WHEN original <> page_id THEN 'revisit' ELSE 'response' END AS record_type,
          CASE WHEN original <> page_id THEN original END AS refers_to
        FROM found""",
    "op9_no_random_access_top_k": f"""
        WITH rows AS (
          SELECT row_number() OVER () AS place, vec_id AS id,
            list_transform(embedding, lambda c: floor({topk.SCALE} * c::DOUBLE)::BIGINT) AS x
          FROM embeddings
          WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda c: c IS NULL OR NOT isfinite(c))) = 0
        ), scored AS (
          SELECT q.place, q.id AS query_id, v.id AS vec_id, list_dot_product(q.x::DOUBLE[], v.x::DOUBLE[])::BIGINT AS score
          FROM rows q JOIN rows v ON q.id % 50 = 0 AND q.place <> v.place
        ), ranked AS (
          SELECT *, row_number() OVER (PARTITION BY place ORDER BY score DESC, vec_id)::INTEGER AS rank FROM scored
        )
        SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= {topk.K}""",
    "op10_site_relative_lines": f"""
        WITH docs AS (SELECT row_number() OVER () AS r, doc_id, source, text, string_split(text, chr(10)) AS lines FROM documents
        ), lines AS (
          SELECT r, source, unnest(list_distinct(lines)) AS line FROM docs WHERE source IS NOT NULL
        ), counts AS (SELECT source, line, count(*) AS n FROM lines WHERE trim(line) <> '' GROUP BY ALL
        ), totals AS (SELECT source, count(*) AS pages FROM documents GROUP BY source
        ), common AS (
          SELECT source, list(line) AS boiler FROM counts JOIN totals USING (source)
          WHERE (n + {boilerplate.DEVIATIONS ** 2}::DOUBLE / 2 - {boilerplate.DEVIATIONS}::DOUBLE * sqrt(n * (pages - n) / pages + {boilerplate.DEVIATIONS ** 2}::DOUBLE / 4))
            / (pages + {boilerplate.DEVIATIONS ** 2}::DOUBLE) > {boilerplate.RATIO}::DOUBLE GROUP BY source
        ), cleaned AS (
          SELECT doc_id, lines, CASE WHEN boiler IS NULL THEN text
            ELSE array_to_string(list_filter(lines, lambda l: trim(l) = '' OR NOT list_contains(boiler, l)), chr(10)) END AS kept
          FROM docs LEFT JOIN common USING (source)
        )
        SELECT doc_id, coalesce(len(lines), 0)::BIGINT AS n_lines, strlen(kept)::BIGINT AS kept_bytes, md5(kept) AS kept_md5 FROM cleaned""",
}
