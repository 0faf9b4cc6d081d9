"""SQL with the same results as the queries, where SQL can express them."""

from __future__ import annotations

from tillwright.llm import bag_ranking as ranking
from tillwright.llm import host_quality as quality
from tillwright.llm import link_trust as trust
from tillwright.llm import sharded_lloyd as lloyd

_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def _rest(url: str) -> str:
    return f"CASE WHEN instr({url}, '://') > 0 THEN substr({url}, instr({url}, '://') + 3) ELSE '' END"


def _host(url: str) -> str:
    return f"translate(regexp_extract({_rest(url)}, '^([^/?#]*)', 1), '{_UPPER}', '{_UPPER.lower()}')"


def _ruled(field: str) -> str:
    rules = sorted(trust.RULES, key=lambda rule: -len(rule.text))
    cases = " ".join(
        f"WHEN (host = '{r.host}' OR host LIKE '%.{r.host}') AND starts_with(path, '{r.path}') THEN '{getattr(r, field)}'"
        for r in rules
    )
    return f"CASE {cases} END"


def link_trust_sql() -> str:
    link = trust.LINK.replace("'", "''")
    first = f"{{0}} // 100 * {100 - trust.PASSED}"
    passed = f"// 100 * {trust.PASSED}"
    rounds = "".join(
        f""",
round{k} AS MATERIALIZED (
  SELECT host, sum(trust)::BIGINT AS trust, sum(distrust)::BIGINT AS distrust FROM (
    SELECT host, trust, distrust FROM round0
    UNION ALL SELECT dst, trust // links_out {passed}, 0 FROM degrees JOIN round{k - 1} ON src = host
    UNION ALL SELECT src, 0, distrust // links_in {passed} FROM degrees JOIN round{k - 1} ON dst = host)
  GROUP BY host)"""
        for k in range(1, trust.ROUNDS + 1)
    )
    return f"""
WITH placed AS (
  SELECT page_id, {_host("url")} AS host, regexp_extract({_rest("url")}, '^[^/?#]*([^?#]*)', 1) AS path
  FROM (SELECT page_id, coalesce(url, '') AS url FROM pages)),
judged AS (SELECT *, {_ruled("text")} AS rule, {_ruled("verdict")} AS ruled FROM placed),
links AS (
  SELECT {_host("coalesce(url, '')")} AS src, unnest(regexp_extract_all(html, '{link}', 1)) AS link FROM pages),
edges AS (
  SELECT DISTINCT src, dst
  FROM (SELECT src, {_host("'x:' || substr(link, instr(link, '//'))")} AS dst FROM links)
  WHERE src <> '' AND dst <> '' AND src <> dst),
degrees AS MATERIALIZED (
  SELECT *, count(*) OVER (PARTITION BY src) AS links_out, count(*) OVER (PARTITION BY dst) AS links_in FROM edges),
kinds AS (
  SELECT host, 2 * count(*) FILTER (ruled = 'allow') > count(*) AS good, 2 * count(*) FILTER (ruled = 'block') > count(*) AS bad
  FROM judged WHERE host <> '' GROUP BY host),
seeds AS (
  SELECT host,
    CASE WHEN good THEN {trust.MASS} // greatest(count(*) FILTER (good) OVER (), 1) ELSE 0 END AS trust,
    CASE WHEN bad THEN {trust.MASS} // greatest(count(*) FILTER (bad) OVER (), 1) ELSE 0 END AS distrust
  FROM kinds WHERE good OR bad),
round0 AS MATERIALIZED (
  SELECT host, ({first.format("trust")})::BIGINT AS trust, ({first.format("distrust")})::BIGINT AS distrust FROM seeds){rounds},
bad AS (
  SELECT host FROM round{trust.ROUNDS}
  WHERE distrust > trust AND distrust >= (SELECT max(distrust) // 100 * {trust.LEAST_PERCENT} FROM round0))
SELECT page_id, host, path, rule,
  coalesce(ruled, CASE WHEN host IN (SELECT host FROM bad) THEN 'block' ELSE 'allow' END) AS verdict
FROM judged"""


def host_quality_sql() -> str:
    word = r"[^\x20\x09-\x0D]"
    failed = {rule: f"100 * {figure} > {percent} * {whole}" for rule, (figure, whole, percent) in quality.RULES.items()}
    base = f"(n_words < {quality.LEAST_WORDS} OR 100 * n_repeat_words > 20 * n_words)"
    failed = {"any": " OR ".join([base, *failed.values()]), **failed}
    rates, shares = [], []
    for rule in failed:
        mean = f"(sum(k_{rule}) OVER () / sum(n) OVER ())"
        between = (
            f"(sum(k_{rule} * k_{rule} / n) OVER () / sum(n) OVER () - {mean} * {mean}"
            f" - {mean} * (1 - {mean}) * count(*) OVER () / sum(n) OVER ())"
        )
        strength = (
            f"least(greatest(CASE WHEN {between} > 0 THEN {mean} * (1 - {mean}) / {between} - 1"
            f" ELSE {quality.MOST_STRENGTH} END, {quality.LEAST_STRENGTH}), {quality.MOST_STRENGTH})"
        )
        rates.append(f"(k_{rule} + {strength} * {mean}) / (n + {strength}) AS rate_{rule}, {mean} AS mean_{rule}")
    for rule in quality.RULES:
        often = f"greatest({quality.WATCHED_RATE}, {quality.WATCHED_TIMES} * mean_{rule})"
        shares.append(f"CASE WHEN rate_{rule} >= {often} THEN 0.5 ELSE 1.0 END AS share_{rule}")
    above = " OR ".join(
        f"100 * {figure} > {percent} * share_{rule} * {whole}" for rule, (figure, whole, percent) in quality.RULES.items()
    )
    return f"""
WITH docs AS (
  SELECT row_number() OVER () AS id, doc_id, source, coalesce(text, '') AS text FROM documents),
split AS MATERIALIZED (
  SELECT *, regexp_extract_all(text, '{word}+') AS words,
    list_filter(string_split(text, chr(10)), lambda line: regexp_matches(line, '{word}')) AS lines
  FROM docs),
windows AS (
  SELECT id, unnest(range(1, len(words) - {quality.WINDOW - 2})) AS i, words FROM split WHERE len(words) >= {quality.WINDOW}),
repeated AS (
  SELECT id, i FROM (
    SELECT id, i, count(*) OVER (PARTITION BY id, array_to_string(words[i:i + {quality.WINDOW - 1}], ' ')) AS n FROM windows)
  WHERE n > 1),
covered AS (
  SELECT id, count(DISTINCT i + k) AS n FROM repeated, range({quality.WINDOW}) AS steps(k) GROUP BY id),
figures AS MATERIALIZED (
  SELECT id, doc_id, source, len(words) AS n_words,
    length(regexp_replace(text, '[\\x20\\x09-\\x0D]', '', 'g')) AS word_chars,
    length(text) - length(regexp_replace(text, '[{quality.SYMBOLS}]', '', 'g')) AS n_symbols,
    len(lines) - len(list_distinct(lines)) AS n_dup_lines,
    coalesce(n, 0) AS n_repeat_words, len(lines) AS n_lines
  FROM split LEFT JOIN covered USING (id)),
hosts AS (
  SELECT source, count(*) AS n, {", ".join(f"count(*) FILTER ({f}) AS k_{rule}" for rule, f in failed.items())}
  FROM figures GROUP BY source),
rates AS (SELECT source, {", ".join(rates)} FROM hosts),
verdicts AS (SELECT source, rate_any >= {quality.REJECTED_RATE} AS rejected, {", ".join(shares)} FROM rates)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, {base} AS base_failed,
  NOT ({base} OR rejected OR {above}) AS kept
FROM figures JOIN verdicts ON figures.source IS NOT DISTINCT FROM verdicts.source"""


def bag_ranking_sql(most: int = 20) -> str:
    """Every document scored by itself, without classes."""
    term = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
    terms = f"regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_UPPER.lower()}'), '{term}')"
    return f"""
WITH docs AS MATERIALIZED (
  SELECT *, len(terms) AS n FROM (SELECT row_number() OVER () AS doc, doc_id, {terms} AS terms FROM documents)),
items AS MATERIALIZED (
  SELECT item, item_id, unnest({terms}) AS term FROM (SELECT row_number() OVER () AS item, item_id, text FROM benchmark)),
totals AS (SELECT count(*)::BIGINT AS all_docs, sum(n)::BIGINT AS all_terms FROM docs WHERE n > 0),
lengths AS (
  SELECT doc, doc_id, {ranking.LEAST_M} + ({ranking.LENGTH_SHARE} * n * all_docs) // all_terms AS m
  FROM docs, totals WHERE n > 0),
tfs AS MATERIALIZED (
  SELECT doc, term, count(*) AS tf FROM (SELECT doc, unnest(terms) AS term FROM docs)
  WHERE term IN (SELECT term FROM items) GROUP BY ALL),
weights AS (
  SELECT term, floor(1000 * ln((2 * any_value(all_docs) + 2)::DOUBLE / (2 * count(*) + 1)::DOUBLE))::BIGINT AS w
  FROM tfs, totals GROUP BY term),
scores AS (
  SELECT item, item_id, doc, doc_id,
    sum(w * (({ranking.UNIT} * tf) // (1000 * tf + {ranking.SATURATION} * m)))::BIGINT AS score
  FROM items JOIN tfs USING (term) JOIN weights USING (term) JOIN lengths USING (doc) GROUP BY ALL)
SELECT item_id, rank::INTEGER AS rank, doc_id, score FROM (
  SELECT *, row_number() OVER (PARTITION BY item ORDER BY score DESC, doc_id NULLS LAST) AS rank FROM scores WHERE score > 0)
WHERE rank <= {most}"""


def sharded_lloyd_sql() -> str:
    """Every component of every vector as a row."""
    nearest = """
near{k} AS MATERIALIZED (
  SELECT id, vec_id, distance, cluster FROM (
    SELECT id, any_value(vec_id) AS vec_id, c.cluster, sum((v.x - c.x) * (v.x - c.x))::BIGINT AS distance,
      row_number() OVER (PARTITION BY id ORDER BY sum((v.x - c.x) * (v.x - c.x)), c.cluster) AS nth
    FROM components AS v JOIN centroids{k} AS c USING (place) GROUP BY id, c.cluster)
  WHERE nth = 1)"""
    update = """
means{k} AS (
  SELECT cluster, place, sum(x) AS total, count(*) AS n
  FROM components JOIN near{before} USING (id) GROUP BY cluster, place),
centroids{k} AS MATERIALIZED (
  SELECT cluster, place, coalesce(((total - ((total % n) + n) % n) // n)::BIGINT, c.x) AS x
  FROM centroids{before} AS c LEFT JOIN means{k} USING (cluster, place))"""
    rounds = ",".join(
        step
        for k in range(1, lloyd.ROUNDS + 1)
        for step in (nearest.format(k=k - 1), update.format(k=k, before=k - 1))
    )
    last = lloyd.ROUNDS
    return f"""
WITH vectors AS MATERIALIZED (
  SELECT row_number() OVER () AS id, vec_id,
    list_transform(embedding, lambda x: floor({lloyd.SCALE} * x::DOUBLE)::BIGINT) AS vector
  FROM embeddings
  WHERE len(embedding) = {lloyd.COMPONENTS} AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = {lloyd.COMPONENTS}),
components AS MATERIALIZED (
  SELECT id, vec_id, unnest(vector) AS x, unnest(range({lloyd.COMPONENTS})) AS place FROM vectors),
seeds AS (
  SELECT id, row_number() OVER (ORDER BY sha256('1:' || vec_id::VARCHAR), vector) - 1 AS cluster
  FROM vectors WHERE vec_id IS NOT NULL QUALIFY cluster < {lloyd.CLUSTERS}),
centroids0 AS MATERIALIZED (SELECT cluster, place, x FROM components JOIN seeds USING (id)),{rounds},{nearest.format(k=last)},
digests AS (
  SELECT cluster, sha256(string_agg(x::VARCHAR, ',' ORDER BY place)) AS centroid_sha256 FROM centroids{last} GROUP BY cluster)
SELECT vec_id, cluster::INTEGER AS cluster, distance,
  sum(distance) OVER (PARTITION BY cluster)::BIGINT AS cluster_inertia, sum(distance) OVER ()::BIGINT AS inertia, centroid_sha256
FROM near{last} JOIN digests USING (cluster)"""


ORACLE = {
    "op2_link_trust": link_trust_sql(),
    "op6_host_quality": host_quality_sql(),
    "op12_bag_ranking": bag_ranking_sql(),
    "op13_sharded_lloyd": sharded_lloyd_sql(),
}
