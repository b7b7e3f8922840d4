"""DuckDB SQL for the corpus queries that SQL can express."""

from __future__ import annotations

from carestrata.llm import decontam, mixing, quality

OP8 = """
WITH payloads AS (
    SELECT page_id, encode(coalesce(html, '')) AS payload FROM pages
), digests AS (
    SELECT page_id, octet_length(payload) AS payload_bytes, sha1(payload) AS payload_digest FROM payloads
), responses AS (
    SELECT *, CASE WHEN payload_bytes >= 1000 THEN max(page_id) OVER (PARTITION BY payload_bytes, payload_digest) ELSE page_id END AS response
    FROM digests
)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN response = page_id THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN response <> page_id THEN response END AS refers_to
FROM responses
"""

_UNIFORM = "CAST(('0x' || substr(md5({seed} || ':' || doc_id || ':' || j), 1, 13)) AS BIGINT) / 4503599627370496.0"

OP3 = f"""
WITH weighed AS (
    SELECT source, count(*) AS n_docs, pow(CAST(count(*) AS DOUBLE), {mixing.TEMPERATURE}) AS weight FROM documents GROUP BY source
), rates AS (
    SELECT source, sum(n_docs) OVER () * weight / sum(weight) OVER () / n_docs AS rate FROM weighed
), split AS (
    SELECT source, greatest(1, CAST(ceil(rate / {mixing.PART_RATE}) AS INTEGER)) AS parts FROM rates
), parts AS (
    SELECT source, parts, rate / parts AS mu FROM split JOIN rates USING (source)
), terms AS (
    SELECT source, parts, k, exp(-mu) * pow(mu, k) / gamma(k + 1) AS p
    FROM (SELECT *, unnest(range(CAST(ceil(mu + 12 * sqrt(mu) + 24) AS BIGINT) + 1)) AS k FROM parts)
), cumulated AS (
    SELECT source, parts, list(c ORDER BY k) AS cdf
    FROM (SELECT source, parts, k, sum(p) OVER (PARTITION BY source ORDER BY k) AS c FROM terms) GROUP BY source, parts
), drawn AS (
    SELECT documents.*, cdf, unnest(range(1, parts + 1)) AS j
    FROM documents JOIN cumulated ON documents.source IS NOT DISTINCT FROM cumulated.source
), counted AS (
    SELECT doc_id, text, lang, source, n_chars, sum(len(list_filter(cdf, lambda c: c <= {_UNIFORM.format(seed=f"'{mixing.SEED}'")}))) AS n
    FROM drawn GROUP BY doc_id, text, lang, source, n_chars
), copies AS (
    SELECT doc_id, text, lang, source, n_chars, CAST(unnest(range(1, CAST(n AS BIGINT) + 1)) AS INTEGER) AS copy FROM counted
)
SELECT *, md5('order {mixing.SEED}:' || doc_id || ':' || copy) AS shuffle_key FROM copies
"""

_MASKED = "concat_ws(' ', {m}, {words})"


def _mask_keys(places: list[tuple[int, ...]]) -> str:
    return "[" + ", ".join(_MASKED.format(m=m, words=", ".join(f"w[{p + 1}]" for p in places_of)) for m, places_of in enumerate(places)) + "]"


_WORDS = r"list_filter(regexp_split_to_array(regexp_replace(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '^[\x20\x09-\x0D]+', ''), '[\x20\x09-\x0D]+'), lambda x: x <> '')"


def _windows(name: str, key: str, source: str) -> str:
    """Windows of 13 words (items and documents of fewer words have none) with one key for each mask."""
    width = decontam.WINDOW
    return f"""{name}_words AS (SELECT {key}, {_WORDS} AS words FROM {source}),
{name}_windows AS (
    SELECT {key}, words[i : i + {width - 1}] AS w
    FROM (SELECT {key}, words, unnest(range(1, len(words) - {width - 2})) AS i FROM {name}_words WHERE len(words) >= {width})
)"""


_EQUAL = " + ".join(f"CAST(d.w[{i}] = b.w[{i}] AS INTEGER)" for i in range(1, decontam.WINDOW + 1))

#: as the operator, for benchmark items of at least 13 words, which all given items are
OP10 = f"""
WITH {_windows("d", "doc_id", "documents")},
{_windows("b", "item_id", "benchmark")},
b_distinct AS (SELECT w, min(item_id) AS item_id FROM b_windows GROUP BY w),
b_keys AS (SELECT *, unnest({_mask_keys(decontam.MASKS)}) AS k FROM b_distinct),
d_keys AS (SELECT doc_id, w, unnest({_mask_keys(decontam.MASKS)}) AS k FROM d_windows),
met AS (SELECT d.doc_id, d.w, b.item_id FROM d_keys d JOIN b_keys b USING (k) WHERE {_EQUAL} >= {decontam.MIN_EQUAL}),
found AS (SELECT doc_id, count(DISTINCT w) AS n_windows, min(item_id) AS item_id FROM met GROUP BY doc_id)
SELECT doc_id, n_windows IS NOT NULL AS contaminated, coalesce(n_windows, 0) AS n_windows, item_id
FROM documents LEFT JOIN found USING (doc_id)
"""


def _op1() -> str:
    space = r"[\x20\x09-\x0D]+"
    removed = lambda body: f"(length(t) - length(regexp_replace(t, '[{body}]+', '', 'g')))"
    classes = [removed(body) for body in quality.CHAR_CLASSES.values()]
    listed = ", ".join(f"'{w}'" for w in quality.COMMON_WORDS)
    counts = ", ".join(f"len(list_filter(c, lambda x: x = '{w}'))" for w in quality.COMMON_WORDS)
    n_classes, n_words = len(quality.CHAR_CLASSES) + 1, len(quality.COMMON_WORDS)
    sums = lambda name, n: "[" + ", ".join(f"sum({name}[{i}])" for i in range(1, n + 1)) + "]"

    def distance(counts: str, reference: str) -> str:
        p, q = f"({counts}[i] / list_sum({counts}))", f"({reference}[i] / list_sum({reference}))"
        part = lambda a: f"CASE WHEN {a} > 0 THEN {a} * log2(2 * {a} / ({p} + {q})) ELSE 0 END"
        terms = f"list_transform(range(1, len({counts}) + 1), lambda i: {part(p)} + {part(q)})"
        return f"CASE WHEN list_sum({counts}) > 0 AND list_sum({reference}) > 0 THEN sqrt(greatest(list_sum({terms}) / 2, 0)) ELSE 0 END"

    return rf"""
WITH texts AS (
    SELECT doc_id, coalesce(lang, '') AS language, coalesce(text, '') AS t,
           list_filter(regexp_split_to_array(coalesce(text, ''), '{space}'), lambda x: x <> '') AS w
    FROM documents
), counted AS (
    SELECT *, list_filter(list_transform(w, lambda x: lower(x)), lambda x: x IN ({listed})) AS c,
           list_filter(string_split(t, chr(10)), lambda x: regexp_replace(x, '{space}', '', 'g') <> '') AS lines
    FROM texts
), measured AS (
    SELECT doc_id, language, length(t) AS n_chars, len(w) AS n_words, length(t) - {removed(r"\x20\x09-\x0D")} AS word_chars,
           {removed("#*$%&|<>")} AS n_symbols, len(lines) - len(list_distinct(lines)) AS n_dup_lines,
           [{", ".join(classes)}, length(t) - ({" + ".join(classes)})] AS classes, [{counts}] AS common
    FROM counted
), windows AS (
    SELECT doc_id, i, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] AS win
    FROM (SELECT doc_id, w, unnest(range(1, len(w) - 1)) AS i FROM texts WHERE len(w) >= 3)
), repeated AS (
    SELECT doc_id, i FROM (SELECT *, count(*) OVER (PARTITION BY doc_id, win) AS n FROM windows) WHERE n > 1
), covered AS (
    SELECT doc_id, count(DISTINCT p) AS n_repeat_words FROM (SELECT doc_id, unnest([i, i + 1, i + 2]) AS p FROM repeated) GROUP BY doc_id
), by_language AS (
    SELECT language, {sums("classes", n_classes)} AS rc, {sums("common", n_words)} AS rw FROM measured GROUP BY language
), refs AS (
    SELECT * FROM by_language WHERE language <> ''
    UNION ALL SELECT '', {sums("classes", n_classes)}, {sums("common", n_words)} FROM measured
), judged AS (
    SELECT m.*, coalesce(n_repeat_words, 0) AS n_repeat_words, {distance("classes", "rc")} AS char_distance,
           {distance("common", "rw")} AS word_distance, list_sum(common) AS n_common
    FROM measured m LEFT JOIN refs USING (language) LEFT JOIN covered USING (doc_id)
), failed AS (
    SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM judged
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND NOT (n_chars >= {quality.MIN_CHARS} AND char_distance > {quality.MAX_CHAR_DISTANCE})
       AND NOT (n_common >= {quality.MIN_COMMON} AND word_distance > {quality.MAX_WORD_DISTANCE}) AS kept
FROM failed
"""


def _op11(k: int = 8, rounds: int = 10, dims: int = 64, seed: int = 3) -> str:
    distance = "list_sum(list_transform(range(1, len(v.x) + 1), lambda i: (v.x[i] - c.x[i]) * (v.x[i] - c.x[i])))"
    steps = [f"""
vectors AS MATERIALIZED (
    SELECT row_number() OVER () AS r, vec_id, list_transform(embedding, lambda e: CAST(floor(1024 * CAST(e AS DOUBLE)) AS BIGINT)) AS x
    FROM embeddings
    WHERE len(embedding) = {dims} AND len(list_filter(embedding, lambda e: e IS NULL OR NOT isfinite(e))) = 0
), c0 AS MATERIALIZED (
    SELECT row_number() OVER (ORDER BY h NULLS LAST, x) - 1 AS cluster, x
    FROM (SELECT x, sha256('{seed}:' || vec_id) AS h FROM vectors ORDER BY h NULLS LAST, x LIMIT {k})
)"""]

    def assigned(n: int) -> str:
        return f"""a{n} AS MATERIALIZED (
    SELECT r, vec_id, x, cluster, distance FROM (
        SELECT v.r, v.vec_id, v.x, c.cluster, {distance} AS distance,
               row_number() OVER (PARTITION BY v.r ORDER BY {distance}, c.cluster) AS place
        FROM vectors v CROSS JOIN c{n} c
    ) WHERE place = 1
)"""

    for n in range(rounds):
        steps += [assigned(n), f"""
s{n} AS (
    SELECT cluster, i, CAST(sum(e) AS BIGINT) AS s, count(*) AS n
    FROM (SELECT cluster, unnest(x) AS e, unnest(range(1, {dims + 1})) AS i FROM a{n}) GROUP BY cluster, i
), m{n} AS (SELECT cluster, list((s - ((s % n + n) % n)) // n ORDER BY i) AS x FROM s{n} GROUP BY cluster),
c{n + 1} AS MATERIALIZED (SELECT c.cluster, coalesce(m.x, c.x) AS x FROM c{n} c LEFT JOIN m{n} m USING (cluster))"""]
    return f"""WITH {", ".join([*steps, assigned(rounds)])}
SELECT vec_id, CAST(a.cluster AS INTEGER) AS cluster, CAST(distance AS BIGINT) AS distance,
       CAST(sum(distance) OVER (PARTITION BY a.cluster) AS BIGINT) AS cluster_inertia,
       CAST(sum(distance) OVER () AS BIGINT) AS inertia, sha256(array_to_string(c.x, ',')) AS centroid_sha256
FROM a{rounds} a JOIN c{rounds} c USING (cluster)
"""


_ESCAPED = r"replace(replace(replace({}, '\', '\b'), '### ', '\h## '), '</turn>', '\l/turn>')"

OP12 = rf"""
WITH rows AS (
    SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
    UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok' UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'
)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, md5(text))) AS turns_sha256,
       CAST(sum(CASE WHEN role = 'assistant' THEN length(text) ELSE 0 END) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, md5(text)) FILTER (role = 'assistant'), '')) AS loss_sha256,
       CAST(sum(length({_ESCAPED.format("text")}) + length(replace({_ESCAPED.format("role")}, ': ', '\c ')) + {len("### : </turn>") + 1}) AS BIGINT) AS formatted_chars
FROM rows GROUP BY conv_id
"""


def llm_sql() -> dict[str, str]:
    return {
        "op1_distribution_divergence": _op1(),
        "op3_poisson_mix": OP3,
        "op8_arc_to_warc": OP8,
        "op10_spaced_seed_leaks": OP10,
        "op11_subvector_centroids": _op11(),
        "op12_event_sourced_chat": OP12,
    }
