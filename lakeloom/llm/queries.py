"""The ten operators' queries over the driver's tables, with SQL where SQL can express them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import public_tokenizers
from lakeloom.llm import bpe, conversations, exact_dedup, line_dedup, lm, mixing, ngram_join, passages, quality, spelling, suffix_dedup, token_files, urls
from lakeloom.llm.base import ORACLES, QUERIES, documents, register  # noqa: F401

_OP8 = """
WITH t AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
g AS (SELECT text, max(doc_id) AS keep_id, count(*) AS group_size FROM t GROUP BY text)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(text) AS text_sha256
FROM t JOIN g USING (text)
"""


@register("op8_exact_dedup", _OP8)
def op8_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_dedup(documents(spark, sf_dir))


_OP10 = r"""
WITH t AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
s AS (SELECT doc_id, string_split(text, chr(10)) AS lines FROM t),
l AS (SELECT doc_id, unnest(lines) AS line, generate_subscripts(lines, 1) AS pos FROM s),
k AS (SELECT doc_id, pos, line, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM l),
d AS (SELECT key, max(doc_id) AS keeper FROM k WHERE length(key) >= 20 GROUP BY key HAVING count(DISTINCT doc_id) >= 3),
m AS (SELECT k.doc_id, pos, line, keeper IS NOT NULL AND keeper <> k.doc_id AS dropped FROM k LEFT JOIN d ON k.key = d.key)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE dropped) AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT dropped), '')) AS kept_sha256
FROM m GROUP BY doc_id
"""


@register("op10_line_dedup", _OP10)
def op10_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    kept = line_dedup.apply_bitmaps(docs, line_dedup.keep_bitmaps(docs))
    return kept.select(line_dedup.null_id().alias("doc_id"), "n_lines", "n_dropped", F.sha2("kept_text", 256).alias("kept_sha256"))


@register("op7_lm_score")
def op7_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm.score(documents(spark, sf_dir))


@register("op6_quality_rules")
def op6_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = quality.judge(documents(spark, sf_dir), public_tokenizers.path("piece_bpe_32k.model"))
    return judged.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "band", "chars_per_token", "byte_share", "token_entropy")


@register("op4_token_files")
def op4_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    files = token_files.write_token_files(documents(spark, sf_dir), public_tokenizers.path("word_bpe_49k.json"), end_id=2)
    return token_files.read_digests(*files)


@register("op9_bpe")
def op9_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path("byte_bpe_50k.json")
    decoded = bpe.decode(bpe.encode(documents(spark, sf_dir), path), path)
    return decoded.select(
        "doc_id", F.expr("octet_length(ids) div 4").cast("long").alias("n_tokens"), F.sha2("ids", 256).alias("ids_sha256"), F.sha2("text", 256).alias("decoded_sha256")
    )


@register("op1_ngram_join")
def op1_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.link_components(documents(spark, sf_dir)).drop("text_key", "component_key")


def _op5_sql(rounds: int = 30) -> str:
    """The same graph, seeds and walks, one CTE a round; with damping 0.7 what 30 rounds leave is below a 40,000th."""
    rules = sorted(urls.RULES, key=lambda r: -len(r[1]))
    fits = [f"((host = '{d}' OR ends_with(host, '.{d}')) AND starts_with(path, '/{p}'))" for d, p in (r.split("/", 1) for _, r in rules)]
    rule = "CASE " + " ".join(f"WHEN {f} THEN '{r}'" for f, (_, r) in zip(fits, rules, strict=True)) + " END"
    verdict = "CASE " + " ".join(f"WHEN {f} THEN '{v}'" for f, (v, _) in zip(fits, rules, strict=True)) + " END"
    lower = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'"
    href, link = urls.HREF.replace("'", "''"), urls.LINK.replace("'", "''")
    steps = "".join(
        f"""
, s{i + 1} AS MATERIALIZED (SELECT h.host, h.allowed + 0.7::DOUBLE * coalesce(f.t, 0) AS t, 1 + 0.7::DOUBLE * coalesce(f.ta, 0) AS ta, h.blocked + 0.7::DOUBLE * coalesce(b.d, 0) AS d, 1 + 0.7::DOUBLE * coalesce(b.da, 0) AS da FROM hosts h
  LEFT JOIN (SELECT e.dst AS host, sum(s.t / e.out_n) AS t, sum(s.ta / e.out_n) AS ta FROM w e JOIN s{i} s ON s.host = e.src GROUP BY 1) f ON f.host = h.host
  LEFT JOIN (SELECT e.src AS host, sum(s.d / e.in_n) AS d, sum(s.da / e.in_n) AS da FROM w e JOIN s{i} s ON s.host = e.dst GROUP BY 1) b ON b.host = h.host)"""
        for i in range(rounds)
    )
    return f"""
WITH p AS (SELECT page_id, translate(regexp_extract(coalesce(url, ''), '{urls.URL}', 1), {lower}) AS host, regexp_extract(coalesce(url, ''), '{urls.URL}', 2) AS path, coalesce(html, '') AS html FROM pages)
, base AS (SELECT page_id, host, path, {rule} AS rule, {verdict} AS ruled FROM p)
, hrefs AS (SELECT host AS src, unnest(regexp_extract_all(html, '{href}', 1)) AS href FROM p WHERE host <> '')
, links AS MATERIALIZED (SELECT DISTINCT src, dst, path FROM (SELECT src, translate(regexp_extract(href, '{link}', 1), {lower}) AS dst, regexp_extract(href, '{link}', 2) AS path FROM hrefs) WHERE dst <> '' AND dst <> src)
, urls AS (SELECT host, path, sum(page) AS pages FROM (SELECT host, path, 1 AS page FROM base WHERE host <> '' UNION ALL SELECT dst, path, 0 FROM links) GROUP BY host, path)
, judged AS (SELECT host, pages, greatest(pages, 1) AS n, {verdict} AS ruled FROM urls)
, counted AS (SELECT host, sum(pages) AS pages, sum(n) AS n, coalesce(sum(n) FILTER (WHERE ruled = 'allow'), 0) AS a, coalesce(sum(n) FILTER (WHERE ruled = 'block'), 0) AS b, coalesce(sum(pages) FILTER (WHERE ruled IS NULL), 0) AS rest FROM judged GROUP BY host)
, shares AS (SELECT host, a::DOUBLE / CASE WHEN pages > 0 THEN a + b + rest ELSE n END AS allowed, b::DOUBLE / CASE WHEN pages > 0 THEN a + b + rest ELSE n END AS blocked FROM counted)
, hosts AS MATERIALIZED (SELECT host, CASE WHEN blocked >= 0.5 AND blocked > allowed THEN 0.0::DOUBLE ELSE allowed END AS allowed, CASE WHEN blocked >= 0.5 AND blocked > allowed THEN 1.0::DOUBLE ELSE blocked END AS blocked FROM shares)
, above AS (SELECT host, i, array_to_string(parts[i:], '.') AS up FROM (SELECT host, parts, unnest(range(2, len(parts) + 1)) AS i FROM (SELECT host, string_split(host, '.') AS parts FROM hosts)))
, up AS (SELECT a.host AS src, arg_min(a.up, a.i) AS dst FROM above a JOIN hosts h ON h.host = a.up WHERE a.up <> '' GROUP BY a.host)
, e AS (SELECT src, dst FROM links UNION SELECT src, dst FROM up UNION SELECT dst, src FROM up)
, w AS MATERIALIZED (SELECT src, dst, count(*) OVER (PARTITION BY src) AS out_n, count(*) OVER (PARTITION BY dst) AS in_n FROM e)
, s0 AS (SELECT host, allowed AS t, 1.0::DOUBLE AS ta, blocked AS d, 1.0::DOUBLE AS da FROM hosts){steps}
, scores AS (SELECT h.host, allowed + greatest(0, 1 - allowed - blocked) * CASE WHEN ta > 1 THEN (t - allowed) / (ta - 1) ELSE 0 END AS trust,
    blocked + greatest(0, 1 - allowed - blocked) * CASE WHEN da > 1 THEN (d - blocked) / (da - 1) ELSE 0 END AS distrust FROM hosts h JOIN s{rounds} s ON s.host = h.host)
, bad AS (SELECT host FROM scores WHERE round(distrust, 6) >= 0.5 AND round(distrust, 6) > round(trust, 6))
SELECT page_id, host, path, rule, coalesce(ruled, CASE WHEN host IN (SELECT host FROM bad) THEN 'block' ELSE 'allow' END) AS verdict FROM base
"""


@register("op5_url_filter", _op5_sql())
def op5_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urls.judge(spark.read.parquet(f"{sf_dir}/pages.parquet"))


def mixing_sql(docs: str, rate: float, columns: str) -> str:
    """Raking of ``docs`` (a table or subquery) in SQL, one CTE a step."""
    topic = "CASE " + " ".join(f"WHEN {c} THEN '{n}'" for n, c in mixing.TOPICS) + f" ELSE '{mixing.OTHER_TOPIC}' END"
    dims = ", ".join(mixing.DIMS)
    shares = "".join(
        f"\n, t_{d} AS (SELECT {d}, CASE WHEN sum(tokens) > 0 THEN pow(sum(tokens)::DOUBLE, {p}) ELSE 0 END AS weight FROM cells GROUP BY {d})" for d, p in mixing.TEMPERS.items()
    )
    steps, last = "", "c0"
    for i in range(8):
        for d in mixing.DIMS:
            name = f"c{i + 1}_{d}"
            have = f"sum(probability * tokens) OVER (PARTITION BY {d})"
            steps += f"\n, {name} AS MATERIALIZED (SELECT * REPLACE (CASE WHEN {have} > 0 THEN least(1.0::DOUBLE, probability * ({d}_share * budget) / {have}) ELSE probability END AS probability) FROM {last})"
            last = name
    share = ", ".join(f"(SELECT t.weight / (SELECT sum(weight) FROM t_{d}) FROM t_{d} t WHERE t.{d} = cells.{d}) AS {d}_share" for d in mixing.DIMS)
    return f"""
WITH d0 AS (SELECT * EXCLUDE (source, lang, text), source AS source_0, lang AS lang_0, text AS text_0, CASE WHEN source <> '' THEN source ELSE 'unknown' END AS source, CASE WHEN lang <> '' THEN lang ELSE 'unknown' END AS lang, coalesce(text, '') AS text,
  len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) AS n_tokens FROM {docs})
, d AS (SELECT *, {topic} AS topic FROM d0)
, cells AS MATERIALIZED (SELECT {dims}, sum(n_tokens) AS tokens FROM d GROUP BY {dims}){shares}
, c0 AS MATERIALIZED (SELECT {dims}, tokens, {float(rate)}::DOUBLE AS probability, {float(rate)}::DOUBLE * (SELECT sum(tokens) FROM cells) AS budget, {share} FROM cells){steps}
SELECT {columns} FROM (SELECT d.*, round(c.probability, 9) AS probability, ('0x' || substr(sha256(coalesce(doc_id::VARCHAR, '')), 1, 13))::BIGINT::DOUBLE / pow(2, 52) < round(c.probability, 9) AS kept FROM d JOIN {last} c USING ({dims}))
"""


@register("op3_source_mixing", mixing_sql("documents", 0.5, "doc_id, source, lang, topic, n_tokens, probability, kept"))
def op3_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix(documents(spark, sf_dir), rate=0.5)
    return mixed.select("row.doc_id", "source", "lang", "topic", "n_tokens", "probability", "kept")


@register("op2_suffix_dedup")
def op2_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    left = suffix_dedup.remove_repeats(documents(spark, sf_dir))
    return left.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


def crc32_sql(text: str) -> str:
    """The unsigned crc32 of the UTF-8 bytes of a text without code points above U+07FF, bit by bit."""
    bit = "lambda c, i: xor(c >> 1, 3988292384 * (c & 1))"
    byte = f"lambda c, b: list_reduce([0, 0, 0, 0, 0, 0, 0, 0]::BIGINT[], {bit}, xor(c, b))"
    codes = f"list_transform(range(1, length({text}) + 1), lambda i: unicode(substr({text}, i::INTEGER, 1))::BIGINT)"
    octets = f"flatten(list_transform({codes}, lambda u: CASE WHEN u < 128 THEN [u] ELSE [192 + (u >> 6), 128 + (u & 63)] END))"
    return f"xor(4294967295::BIGINT, list_reduce({octets}, {byte}, 4294967295::BIGINT))"


def _op13_sql() -> str:
    """The edit lattice layer by layer: for each state the least (cost, audit), with the text it gives."""
    states = {"z": {"s": "s", "u": "u"}, "s": {"u": "u"}, "u": {"a": "a"}, "a": {"u": "u"}}
    roles = {"u": "user", "a": "assistant"}

    def way(q, cost, edit, line=None):
        text = f"d.{q}.t" if line is None else f"d.{q}.t || {line} || chr(10)"
        return f"{{'c': d.{q}.c + {cost}, 'a': d.{q}.a || '{edit}', 't': {text}}}"

    def least(ways):
        return f"list_sort([{', '.join(ways)}])[1]"

    def step(edges):
        return "{" + ", ".join(f"'{q}': {least(w)}" for q, w in edges.items()) + "}"

    added = {q: [f"d.{q}", *[way(p, 5, "I", f"'{roles[r]}:'") for p, n in states.items() for r, to in n.items() if to == q and r != "s"]] for q in states}
    edits = {q: [way(q, 2, "D")] for q in states}
    for p, n in states.items():
        for r, to in n.items():
            kept = f"(CASE WHEN r.i = '{r}' AND r.f < 2 THEN 5 * r.f ELSE 1000000 END)"
            edits[to].append(way(p, kept, "K", "r.role || ':' || r.text"))
            if r != "s":
                edits[to].append(way(p, "(CASE WHEN r.f < 2 THEN 1 + 5 * r.f ELSE 1000000 END)", "R", f"'{roles[r]}:' || r.text"))
    apply = lambda value, body: f"list_transform([{value}], lambda d: {body})[1]"
    layer = apply(apply("d", step(added)), step(edits))
    empty = "{'c': %d, 'a': '', 't': ''}"
    first = "{" + ", ".join(f"'{q}': {empty % (0 if q == 'z' else 1000000)}" for q in states) + "}"
    end = apply("ways", f"{least(['d.z', added['a'][0], *added['a'][1:]])}")
    space = r"[^\x20\x09-\x0D]"
    key = "coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ')"
    return f"""
WITH c AS (SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text, {crc32_sql(key)} % 20 AS k FROM conversations)
, damaged AS (SELECT conv_id, turn, CASE WHEN k = 4 THEN 'user' ELSE role END AS role, CASE WHEN k = 1 THEN '' WHEN k = 2 THEN translate(text, '.!?', '') ELSE text END AS text, unnest(range(CASE WHEN k = 3 THEN 2 ELSE 1 END)) AS copy FROM c WHERE k <> 0)
, o AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text, copy) AS pos, substr(role, 1, 1) AS i FROM damaged)
, f AS (SELECT *, CASE WHEN NOT regexp_matches(text, '{space}') THEN 2 WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY pos) > 1 THEN 3
    WHEN right(rtrim(text, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), 1) IN ('.', '!', '?') THEN 0 ELSE 1 END AS f,
    lag(i) OVER (PARTITION BY conv_id ORDER BY pos) || i AS pair FROM o)
, g AS (SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (WHERE f = 2) AS blank, count(*) FILTER (WHERE f = 3) AS duplicate,
    count(*) FILTER (WHERE f = 1) AS truncated, count(*) FILTER (WHERE pair NOT IN ('su', 'ua', 'au')) AS illegal,
    list_reduce(list({{'i': i, 'f': f, 'role': role, 'text': text, 'd': {first}}} ORDER BY pos), lambda x, r: {{'i': r.i, 'f': r.f, 'role': r.role, 'text': r.text, 'd': {layer.replace('[d]', '[x.d]')}}}, {{'i': '', 'f': 0, 'role': '', 'text': '', 'd': {first}}}).d AS ways FROM f GROUP BY conv_id)
, w AS (SELECT conv_id, gaps, blank, duplicate, truncated, illegal, {end} AS way FROM g)
SELECT u.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal,
  coalesce(way.c, 0)::BIGINT AS cost, coalesce(way.a, '') AS audit, sha256(coalesce(left(way.t, length(way.t) - 1), '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) u LEFT JOIN w ON w.conv_id IS NOT DISTINCT FROM u.conv_id
"""


@register("op13_conversation_repair", _op13_sql())
def op13_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversations.repair(conversations.damaged(spark.read.parquet(f"{sf_dir}/conversations.parquet")))


_OP12 = f"""
WITH RECURSIVE r AS (SELECT coalesce(doc_id::VARCHAR, '') AS doc, translate(unnest(regexp_extract_all(coalesce(text, ''), '{spelling.RUN}')), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS run FROM documents)
, c AS (SELECT doc, run, count(*) AS n FROM r WHERE length(run) >= 5 GROUP BY ALL)
, h AS (SELECT *, {crc32_sql("(doc || ':' || run)")} AS h FROM c)
, d AS (SELECT CASE WHEN h % 97 = 0 THEN left(run, h % length(run)) || substr(run, h % length(run) + 2) ELSE run END AS word, n FROM h)
, v AS MATERIALIZED (SELECT word, sum(n)::BIGINT AS n FROM d WHERE length(word) >= 5 GROUP BY word HAVING sum(n) >= 3)
, p AS (SELECT word, n, unnest(range(1, length(word) + 1)) AS i FROM v)
, x AS MATERIALIZED (SELECT word, n, left(word, i - 1) AS a, substr(word, i + 1) AS b FROM p)
, k AS (SELECT l.word, r.word AS near, r.n AS near_n FROM x l JOIN x r ON l.a = r.a AND l.b = r.b AND length(l.word) = length(r.word) AND l.word <> r.word
  UNION SELECT v.word, x.word, x.n FROM v JOIN x ON x.a || x.b = v.word UNION SELECT x.word, v.word, v.n FROM v JOIN x ON x.a || x.b = v.word)
, b AS (SELECT word, count(*) AS n_near, list_sort(list({{'n': -near_n, 'w': near}}))[1] AS best FROM k GROUP BY word)
, f AS MATERIALIZED (SELECT v.word, v.n, coalesce(n_near, 0) AS n_near, CASE WHEN -best.n >= 2 * v.n THEN best.w END AS form, CASE WHEN -best.n >= 2 * v.n THEN (-best.n)::BIGINT END AS form_n FROM v LEFT JOIN b ON b.word = v.word)
, w AS (SELECT word, word AS root, form AS next FROM f UNION ALL SELECT w.word, w.next, f.form FROM w JOIN f ON f.word = w.next)
SELECT f.word, f.form, w.root, f.n, f.n_near, f.form_n FROM f JOIN w ON w.word = f.word AND w.next IS NULL
"""


@register("op12_spelling_variants", _OP12)
def op12_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.variants(spelling.damaged_runs(documents(spark, sf_dir)))


_OP11 = r"""
WITH t AS (SELECT doc_id, row_number() OVER () AS row_no, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents)
, k AS (SELECT doc_id, row_no, unnest(range(1, len(w) - 11)) AS i, w FROM t)
, x AS MATERIALIZED (SELECT doc_id, row_no, i, array_to_string(w[i:i + 12], ' ') AS passage FROM k)
, m AS (SELECT passage, min(coalesce(doc_id, -9223372036854775808)) AS least FROM x GROUP BY passage)
, g AS (SELECT DISTINCT row_no, unnest(range(i, i + 13)) AS i FROM x JOIN m USING (passage) WHERE least < coalesce(doc_id, -9223372036854775808))
, r AS (SELECT row_no, list(i) AS gone FROM g GROUP BY row_no)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(len(gone), 0)::BIGINT AS n_removed,
  sha256(array_to_string(list_transform(list_filter(range(1, len(w) + 1), lambda i: NOT list_contains(coalesce(gone, []), i)), lambda i: w[i]), ' ')) AS kept_sha256
FROM t LEFT JOIN r USING (row_no)
"""


@register("op11_passage_dedup", _OP11)
def op11_passage_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = passages.remove_passages(documents(spark, sf_dir))
    return kept.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))
