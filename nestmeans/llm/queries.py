"""Queries over the given tables, one for each operator, and their SQL where SQL can tell."""

from __future__ import annotations

from pyspark.sql import functions as F

from nestmeans.llm import (
    decontaminate, html_text, jaccard, language, manifest, packing, pii, quality, secret_scan, url_filter, vector_codes, vector_graph,
    warc,
)
from nestmeans.llm.common import ascii_lower, table

# URL rules and the labels of host names that are listed.
URL_RULES = (
    ("com/", "allow"),
    ("example.com/en/", "block"),
    ("www.example.com/en/", "allow"),
    ("net/es/", "block"),
    ("net/fr/", "block"),
)
LISTED_LABELS = ("adult-x", "casino-win", "free-bets", "spam-farm")


def op1_url_filter(spark, folder):
    """Verdict on every page's url; the list holds the corpus's hosts that carry a listed label."""
    pages = table(spark, folder, "pages")
    hosts = pages.select(url_filter.url_host(F.col("url")).alias("host"))
    named = F.array(*[F.lit(x) for x in LISTED_LABELS])
    listed = hosts.where(F.arrays_overlap(F.split("host", r"\."), named))
    return url_filter.judge_urls(pages, listed, URL_RULES)


_OP1 = f"""
WITH cut AS (
  SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest
  FROM pages
), parts AS (
  SELECT page_id,
    translate(regexp_extract(rest, '^([^/?#]*)', 1),
      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path
  FROM cut
), marked AS (
  SELECT page_id, coalesce(host, '') AS host, coalesce(path, '') AS path,
    list_has_any(string_split(coalesce(host, ''), '.'), {list(LISTED_LABELS)}) AS listed
  FROM parts
), ruled AS (
  SELECT *, CASE
    {" ".join(
        f"WHEN (host = '{r[:r.index('/')]}' OR ends_with(host, '.{r[:r.index('/')]}')) "
        f"AND starts_with(path, '{r[r.index('/'):]}') THEN '{r}'"
        for r, _ in sorted(URL_RULES, key=lambda x: -len(x[0])))}
    END AS rule
  FROM marked
)
SELECT page_id, host, path, rule, listed, CASE
    {" ".join(f"WHEN rule = '{r}' THEN '{v}'" for r, v in URL_RULES)}
    WHEN listed THEN 'block' ELSE 'allow' END AS verdict
FROM ruled
"""

QUERIES = {"op1_url_filter": op1_url_filter}
ORACLES = {"op1_url_filter": _OP1}


def op8_pii(spark, folder):
    """Personal data of every document."""
    spans = pii.scan(table(spark, folder, "documents"))
    base, every = F.col("base"), F.concat("base", "added")
    return spans.select(
        "doc_id",
        *[pii.count_of(base, k.name).alias(f"n_{k.name}") for k in pii.BASE],
        F.sha2(pii.written(base), 256).alias("base_sha256"),
        pii.written(every).alias("spans"),
        F.array_join(F.transform(every, lambda s: F.format_string("%.2f", s["score"])), ",").alias("scores"),
    )


QUERIES["op8_pii"] = op8_pii


def op2_html_text(spark, folder):
    """Main text of every page."""
    return html_text.extract(table(spark, folder, "pages"))


QUERIES["op2_html_text"] = op2_html_text


def op6_warc(spark, folder):
    """Every page through WARC archives and back."""
    found = warc.round_trip(spark, table(spark, folder, "pages"))
    return found.where("kind = 'record'").select(
        warc.page_id_of(F.col("record_id")).alias("page_id"), "payload_bytes", "payload_digest", "record_type",
        warc.page_id_of(F.col("refers_to")).alias("refers_to"),
    )


QUERIES["op6_warc"] = op6_warc


def op9_jaccard(spark, folder):
    """Classes of documents linked by the similarity of their word shingles."""
    return jaccard.similar_documents(table(spark, folder, "documents"))


QUERIES["op9_jaccard"] = op9_jaccard


def op3_decontaminate(spark, folder):
    """Benchmark items found in documents."""
    return decontaminate.leaks(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


QUERIES["op3_decontaminate"] = op3_decontaminate


def op5_pack(spark, folder):
    """All documents packed into windows."""
    return packing.pack(table(spark, folder, "documents"))


QUERIES["op5_pack"] = op5_pack


def op7_language(spark, folder):
    """Language of every document."""
    return language.identify(table(spark, folder, "documents"))


QUERIES["op7_language"] = op7_language


def op10_quality(spark, folder):
    """Quality of every document."""
    return quality.grade(table(spark, folder, "documents"), table(spark, folder, "labels"))


QUERIES["op10_quality"] = op10_quality


def op4_vector_graph(spark, folder):
    """Links and classes of near-duplicate vectors within a label."""
    return vector_graph.near_duplicates(table(spark, folder, "embeddings"))


QUERIES["op4_vector_graph"] = op4_vector_graph


def op11_secrets(spark, folder):
    """Secrets of every document; a document is a repository and its source the owner."""
    found = secret_scan.scan(table(spark, folder, "documents"))
    spans = F.col("spans")
    base = F.filter(spans, secret_scan.is_base)
    return found.select(
        "doc_id",
        *[secret_scan.count_of(spans, "kind", k.name).alias(f"n_{k.name}") for k in secret_scan.BASE],
        F.sha2(secret_scan.written(base), 256).alias("base_sha256"),
        secret_scan.written(spans).alias("spans"),
        F.array_join(F.transform(spans, lambda s: s["verdict"]), ",").alias("verdicts"),
        secret_scan.count_of(spans, "verdict", "live").alias("n_live"),
    )


QUERIES["op11_secrets"] = op11_secrets

_NAMED = "|".join(
    secret_scan.either_case(w) for w in ("password", "passwd", "secret", "token", "api_?key")
)
# kind, plain pattern, group of the value, test of a match m and its value v
_SECRETS = (
    ("assign", rf"""({_NAMED})["'']?\x20*[:=]\x20*["'']?([A-Za-z0-9+/_.=-]+)""", 2, "length(v) >= 12"),
    ("access", "AKIA[A-Z0-9]+", 0, "length(v) >= 18"),
    ("hex", "[0-9a-f]+", 0, "length(v) >= 16"),
    ("service", "[A-Za-z0-9_-]+", 0, "length(v) >= 16 AND regexp_full_match(v, 'gh[opsu]_[A-Za-z0-9]{36}|"
     "xox[abp]-[A-Za-z0-9-]{16,}|sk_live_[A-Za-z0-9]{16,}|AIza[A-Za-z0-9_-]{35}')"),
    ("private", r"-----BEGIN [A-Z ]*PRIVATE KEY-----[A-Za-z0-9+/=\x20\x09-\x0D]*", 0,
     r"regexp_matches(v, 'PRIVATE KEY-----[A-Za-z0-9+/=\x20\x09-\x0D]{32,}$')"),
    ("mixed", "[A-Za-z0-9_-]+", 0, "length(v) >= 24 AND regexp_matches(v, '[a-z]') AND regexp_matches(v, '[A-Z]') "
     "AND regexp_matches(v, '[0-9]')"),
)


def _spans_sql(place: int, kind: str, pattern: str, group: int, test: str) -> str:
    """Spans of one kind: matches and the stretches between them, unnested side by side."""
    return rf"""
  SELECT rid, doc_id, source, {place} AS place, '{kind}' AS kind, CAST(upto - length(m) AS BIGINT) AS s, CAST(upto AS BIGINT) AS e, sha256(v) AS value,
    len(list_distinct(string_split(v, ''))) >= {secret_scan.LEAST_SYMBOLS} AND regexp_matches(v, '[0-9]')
      AND regexp_matches(v, '[A-Za-z]') AND NOT regexp_matches(lower(v), '{secret_scan.PLACEHOLDERS}') AS random
  FROM (
    SELECT *, sum(length(gap) + length(m)) OVER (PARTITION BY rid ORDER BY i) AS upto,
      {f"regexp_extract(m, '{pattern}', {group})" if group else "m"} AS v
    FROM (
      SELECT rid, doc_id, source, unnest(m) AS m, unnest(g[1:len(m)]) AS gap, unnest(range(len(m))) AS i
      FROM (SELECT *, regexp_extract_all(text, '{pattern}') AS m, string_split_regex(text, '{pattern}') AS g FROM docs)
    )
  ) WHERE {test}"""


ORACLES["op11_secrets"] = f"""
WITH docs AS (
  SELECT row_number() OVER () AS rid, doc_id, source, coalesce(text, '') AS text FROM documents
), proposed AS ({" UNION ALL ".join(_spans_sql(i + 1, *k) for i, k in enumerate(_SECRETS))}
), spans AS (
  SELECT * FROM proposed p WHERE place <= 3 OR NOT EXISTS (
    SELECT 1 FROM proposed b WHERE b.rid = p.rid AND b.place <= 3 AND b.s < p.e AND p.s < b.e)
), owners AS (
  SELECT value, count(*) AS n FROM (SELECT DISTINCT value, source FROM spans) GROUP BY value
), judged AS (
  SELECT s.*, CASE WHEN n > {secret_scan.MAX_OWNERS} THEN 'example' WHEN random THEN 'live' ELSE 'plain' END AS verdict
  FROM spans s JOIN owners USING (value)
), kept AS (
  SELECT rid, count(*) FILTER (place = 1) AS n_assign, count(*) FILTER (place = 2) AS n_access, count(*) FILTER (place = 3) AS n_hex,
    string_agg(kind || ':' || s || ':' || e, ',' ORDER BY s, place) FILTER (place <= 3) AS base,
    string_agg(kind || ':' || s || ':' || e, ',' ORDER BY s, place) AS spans,
    string_agg(verdict, ',' ORDER BY s, place) AS verdicts, count(*) FILTER (verdict = 'live') AS n_live
  FROM judged WHERE kind <> 'mixed' OR verdict = 'live' GROUP BY rid
)
SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex,
  sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans, coalesce(verdicts, '') AS verdicts,
  coalesce(n_live, 0) AS n_live
FROM docs LEFT JOIN kept USING (rid)
"""


_MANIFEST = ("doc_id", "source", "lang", "n_chars", "text")


def op12_manifest(spark, folder):
    """Merkle manifest of all documents; a third of them is tampered with and must not verify."""
    docs = table(spark, folder, "documents")
    tampered = F.crc32(F.col("doc_id").cast("string")) % 3 == 0
    values = [ascii_lower(F.col(c)) if c == "text" else F.col(c) for c in _MANIFEST]
    changed = F.when(tampered, manifest.leaf_of(values))
    found = manifest.manifest(docs, list(_MANIFEST), others={"changed": changed})
    root = manifest.folded(F.coalesce("changed", "leaf"), F.col("path"))
    found = found.select("doc_id", "leaf", "subroot", "root", manifest.proof(F.col("path")).alias("proof_sha256"), root.alias("folded_root"))
    return found.withColumn("verified", F.col("folded_root") == F.col("root"))


QUERIES["op12_manifest"] = op12_manifest


def _manifest_sql(levels: int = 7, upper: int = 3, arity: int = manifest.ARITY) -> str:
    """Runs of every level by grouping, then every leaf's way up; holds for arity ** levels documents a
    language and arity ** upper languages."""
    def part(c, text="text"):
        value = f"CAST({text if c == 'text' else c} AS VARCHAR)"
        return f"coalesce(strlen({value}) || ':' || {value}, '-')"

    lower = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    crc = (
        "xor(list_reduce(CAST(string_split(CAST(doc_id AS VARCHAR), '') AS VARCHAR[]).list_transform(lambda c: CAST(ascii(c) AS BIGINT)), "
        "lambda a, c: list_reduce(CAST(range(8) AS BIGINT[]), lambda b, i: xor(b >> 1, (b & 1) * 3988292384), xor(a, c)), "
        "CAST(4294967295 AS BIGINT)), CAST(4294967295 AS BIGINT))"
    )
    sql = f"""
WITH hashed AS MATERIALIZED (
  SELECT doc_id, lang, sha256({" || ".join(part(c) for c in _MANIFEST)}) AS leaf,
    CASE WHEN {crc} % 3 = 0 THEN sha256({" || ".join(part(c, lower) for c in _MANIFEST)}) END AS changed
  FROM documents
), l0 AS MATERIALIZED (
  SELECT doc_id, lang AS g, leaf AS h, changed,
    row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS i FROM hashed
)"""
    def climb(name, count):
        out = ""
        for n in range(count):
            out += f""", {name}{n}r AS MATERIALIZED (
  SELECT g, i // {arity} AS i, list(h ORDER BY i) AS m, sum(count(*)) OVER (PARTITION BY g) AS n FROM {name}{n} GROUP BY g, i // {arity}
), {name}{n + 1} AS MATERIALIZED (
  SELECT g, i, CASE WHEN n = 1 THEN m[1] ELSE sha256(list_aggregate(m, 'string_agg', '')) END AS h FROM {name}{n}r
)"""
        return out

    sql += climb("l", levels)
    sql += f""", u0 AS MATERIALIZED (
  SELECT 0 AS g, g AS lang, h, row_number() OVER (ORDER BY g NULLS FIRST) - 1 AS i FROM l{levels}
)""" + climb("u", upper)
    sql += """, w0 AS (
  SELECT doc_id, g AS lang, h AS leaf, g, i, coalesce(changed, h) AS cur, '' AS proof FROM l0
)"""
    place = f"(w.i % {arity})"
    others = f"m[1:{place}] || m[{place} + 2:]"

    def walk(source, run, target, subroot):
        return f""", {target} AS (
  SELECT doc_id, lang, leaf, {subroot}w.g, w.i // {arity} AS i,
    CASE WHEN n = 1 THEN cur ELSE sha256(list_aggregate(m[1:{place}] || [cur] || m[{place} + 2:], 'string_agg', '')) END AS cur,
    proof || CASE WHEN n = 1 OR len({others}) = 0 THEN '' ELSE list_aggregate({others}, 'string_agg', '') END AS proof
  FROM {source} w JOIN {run} r ON r.g IS NOT DISTINCT FROM w.g AND r.i = w.i // {arity}
)"""

    for n in range(levels):
        sql += walk(f"w{n}", f"l{n}r", f"w{n + 1}", "")
    sql += f""", x0 AS (
  SELECT doc_id, leaf, u.h AS subroot, w.lang, u.g, u.i, cur, proof FROM w{levels} w JOIN u0 u ON u.lang IS NOT DISTINCT FROM w.lang
)"""
    for n in range(upper):
        sql += walk(f"x{n}", f"u{n}r", f"x{n + 1}", "subroot, ")
    return sql + f"""
SELECT doc_id, leaf, subroot, u.h AS root, sha256(proof) AS proof_sha256, cur AS folded_root, cur = u.h AS verified
FROM x{upper}, u{upper} u
"""


ORACLES["op12_manifest"] = _manifest_sql()


def op13_vector_codes(spark, folder):
    """Codes of all embeddings by codebooks trained on all of them."""
    return vector_codes.coded(table(spark, folder, "embeddings"))


QUERIES["op13_vector_codes"] = op13_vector_codes


def _codes_sql(parts: int = vector_codes.PARTS, entries: int = vector_codes.ENTRIES, rounds: int = vector_codes.ROUNDS) -> str:
    """All distances in every round."""
    sql = f"""
WITH kept AS MATERIALIZED (
  SELECT row_number() OVER (ORDER BY vec_id NULLS LAST, embedding) AS rid, vec_id, label,
    list_transform(embedding, lambda x: CAST(floor(CAST(x AS DOUBLE) * {vector_codes.SCALE}) AS BIGINT)) AS v
  FROM embeddings WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), cut AS MATERIALIZED (
  SELECT rid, p, v[p * (len(v) // {parts}) + 1 : (p + 1) * (len(v) // {parts})] AS v FROM kept, range({parts}) t(p)
), book0 AS MATERIALIZED (SELECT p, rid - 1 AS e, v AS c FROM cut WHERE rid <= {entries})"""
    for n in range(rounds + 1):
        sql += f""", near{n} AS MATERIALIZED (
  SELECT rid, p, min(d) AS d, arg_min(e, d * {entries} + e) AS e FROM (
    SELECT rid, p, e, list_sum(list_transform(list_zip(v, c), lambda x: (x[1] - x[2]) * (x[1] - x[2]))) AS d
    FROM cut JOIN book{n} USING (p)
  ) GROUP BY rid, p
)"""
        if n < rounds:
            sql += f""", sums{n} AS (
  SELECT p, e, i, sum(x) AS s, count(*) AS n
  FROM (SELECT p, e, unnest(v) AS x, unnest(range(len(v))) AS i FROM cut JOIN near{n} USING (rid, p)) GROUP BY p, e, i
), mean{n} AS (SELECT p, e, list(CAST((s - ((s % n) + n) % n) // n AS BIGINT) ORDER BY i) AS c FROM sums{n} GROUP BY p, e
), book{n + 1} AS MATERIALIZED (SELECT p, e, coalesce(m.c, b.c) AS c FROM book{n} b LEFT JOIN mean{n} m USING (p, e))"""
    return sql + f""", told AS (
  SELECT vec_id, label, string_agg(lower(printf('%02x', e)), '' ORDER BY p) AS code, CAST(sum(d) AS BIGINT) AS error
  FROM kept JOIN near{rounds} USING (rid) GROUP BY rid, vec_id, label
), hashed AS (
  SELECT sha256(coalesce(string_agg(array_to_string(c, ','), ',' ORDER BY p, e), '')) AS codebooks_sha256 FROM book{rounds}
)
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, codebooks_sha256
FROM told, hashed
"""


ORACLES["op13_vector_codes"] = _codes_sql()
