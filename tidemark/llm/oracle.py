"""SQL for DuckDB that gives the rows of this package's queries, where SQL can express them."""

from __future__ import annotations

from tidemark.llm import licenses, line_rules, sharding, url_reputation
from tidemark.llm.common import LOWER, UPPER


def _text(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def _licenses() -> str:
    rules = ",\n".join(
        f"({r.number}, {_text(r.label)}, {r.priority}, [{', '.join(map(_text, r.keywords))}], {_text(r.pattern)}, "
        f"{str(r.base).lower()}, {licenses.CONFIDENCE[r.priority]})"
        for r in licenses.RULES
    )
    return rf"""
WITH rules(rule, label, priority, keywords, pattern, base, confidence) AS (VALUES
{rules}
), docs AS (
  SELECT row_number() OVER () AS r, doc_id,
    regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words
  FROM documents
), gated AS (
  SELECT r, rule, pattern, ' ' || array_to_string(words, '  ') || ' ' AS spaced
  FROM docs JOIN rules ON list_has_all(words, keywords)
), found AS (
  SELECT r, rule, string_split_regex(spaced, pattern) AS betweens, regexp_extract_all(spaced, pattern) AS insides
  FROM gated
), each AS (
  SELECT r, rule, generate_subscripts(insides, 1) AS i, unnest(insides) AS inside,
    unnest(betweens[1:len(insides)]) AS between
  FROM found WHERE len(insides) > 0
), lengths AS (
  SELECT r, rule, i, (length(inside) - length(replace(inside, ' ', ''))) // 2 AS inside,
    (length(between) - length(replace(between, ' ', ''))) // 2 AS between
  FROM each
), places AS (
  SELECT r, rule, inside, sum(between + inside) OVER (PARTITION BY r, rule ORDER BY i) AS stop FROM lengths
), detections AS (
  SELECT r, rule, label, priority, base, confidence, stop - inside AS first, stop - 1 AS last
  FROM places JOIN rules USING (rule)
), judged AS (
  SELECT *, NOT EXISTS (
    SELECT 1 FROM detections b
    WHERE b.r = a.r AND b.first <= a.first AND b.last >= a.last AND b.priority >= a.priority
      AND (b.first < a.first OR b.last > a.last OR b.priority > a.priority OR b.rule < a.rule)) AS stays
  FROM detections a
), summed AS (
  SELECT r, count(*) FILTER (base) AS n_base, min(first) FILTER (base) AS first_word,
    max(first) FILTER (base) AS last_word,
    string_agg(DISTINCT label, ',' ORDER BY label) FILTER (base) AS base_labels,
    string_agg(DISTINCT label, ',' ORDER BY label) FILTER (base OR stays) AS labels,
    max(confidence) FILTER (base OR stays) AS score, count(*) FILTER (stays) AS n_detections
  FROM judged GROUP BY r
)
SELECT doc_id, len(words)::BIGINT AS n_words, coalesce(n_base, 0)::BIGINT AS n_base,
  first_word::BIGINT AS first_word, last_word::BIGINT AS last_word, coalesce(base_labels, '') AS base_labels,
  coalesce(labels, '') AS labels, coalesce(score, 0)::DOUBLE AS score,
  coalesce(n_detections, 0)::BIGINT AS n_detections
FROM docs LEFT JOIN summed USING (r)
"""


def _sharding() -> str:
    def draw(name: str, weight: float) -> str:
        digest = f"('0x' || substr(md5(k || '/{name}'), 1, {sharding.DRAW_DIGITS}))::BIGINT"
        return f"-ln(({digest} + 0.5) / {16 ** sharding.DRAW_DIGITS}.0) / {weight}"

    def winner(children: list[tuple[str, float, str]]) -> str:
        if len(children) == 1:
            return children[0][2]
        best = f"list_min([{', '.join(f'({draw(n, w)}, {_text(n)})' for n, w, _ in children)}])[2]"
        return f"(CASE {best} {' '.join(f'WHEN {_text(n)} THEN {v}' for n, _, v in children)} END)"

    def place(tree: list[sharding.Leaf]) -> str:
        regions: dict[str, dict[str, list[sharding.Leaf]]] = {}
        for x in tree:
            regions.setdefault(x.region, {}).setdefault(x.rack, []).append(x)
        return winner([
            (f"region-{r}", float(sum(x.weight for v in racks.values() for x in v)), winner([
                (f"rack-{k}", float(sum(x.weight for x in v)), winner([
                    (f"shard-{x.shard}", x.weight, str(x.shard)) for x in v])) for k, v in racks.items()]))
            for r, racks in regions.items()])

    tree = sharding.even_tree()
    grown = sharding.with_new_region(tree)
    return f"""
WITH RECURSIVE steps(i, c, k) AS (
  SELECT i::UBIGINT, i::UBIGINT, 0 FROM range(256) t(i)
  UNION ALL
  SELECT i, CASE WHEN c & 1 = 1 THEN xor(3988292384::UBIGINT, c >> 1) ELSE c >> 1 END, k + 1 FROM steps WHERE k < 8
), crc(t) AS (SELECT list(c ORDER BY i) FROM steps WHERE k = 8
), docs AS (
  SELECT doc_id, coalesce(doc_id::VARCHAR, '') AS k, encode(coalesce(text, '')) AS b FROM documents
), sums AS (
  SELECT doc_id, k, octet_length(b) + 8 AS size,
    xor(list_reduce(
      list_prepend(4294967295::UBIGINT, list_transform(
        range(octet_length(b)), lambda i: ('0x' || substr(hex(b), 2 * i + 1, 2))::UBIGINT)),
      lambda a, x: xor(t[(xor(a, x) & 255)::BIGINT + 1], a >> 8)), 4294967295::UBIGINT)::BIGINT AS text_crc32
  FROM docs, crc
), placed AS (
  SELECT doc_id, size, text_crc32, {place(tree)} AS shard, {place(grown)} AS grown_shard,
    ('0x' || substr(md5(k), 1, 6))::BIGINT % {sharding.SLOT_BUCKETS} AS bucket
  FROM sums
)
SELECT doc_id, size::BIGINT AS size, text_crc32, 'key' AS law, shard,
  row_number() OVER (PARTITION BY shard ORDER BY bucket, doc_id, text_crc32, size) - 1 AS slot, grown_shard
FROM placed
"""


def _line_rules() -> str:
    spaces = r"[\x20\x09-\x0D]"
    symbols = "[" + line_rules.SYMBOLS.replace("|", r"\|") + "]"
    n = line_rules.WINDOW
    return rf"""
WITH docs AS (
  SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text FROM documents
), split AS (
  SELECT r, doc_id, text, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS words,
    list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines
  FROM docs
), grams AS (
  SELECT r, unnest(range(1, len(words) - {n - 2})) AS i,
    unnest(list_transform(range(1, len(words) - {n - 2}), lambda i: array_to_string(words[i:i + {n - 1}], ' '))) AS g
  FROM split WHERE len(words) >= {n}
), again AS (
  SELECT r, i FROM grams QUALIFY count(*) OVER (PARTITION BY r, g) > 1
), covered AS (
  SELECT r, sum(n) AS n_repeat_words
  FROM (SELECT r, least({n}, coalesce(lead(i) OVER (PARTITION BY r ORDER BY i) - i, {n})) AS n FROM again) GROUP BY r
), failing AS (
  SELECT r, doc_id, text, words, lines, list_filter(lines, lambda x:
      (length(x) - length(regexp_replace(x, '{symbols}', '', 'g'))) * 100 > length(x) * {line_rules.MAX_SYMBOL_PERCENT}
      OR regexp_matches(x, '{line_rules.SHOUTS}') OR regexp_matches(x, '{line_rules.RULERS}')
      OR regexp_matches(x, '{line_rules.SEPARATORS}')
      OR (length(x) <= {line_rules.BOILERPLATE_CHARS} AND regexp_matches(x, '{line_rules.BOILERPLATE}'))) AS failed
  FROM split
), measured AS (
  SELECT doc_id, len(words)::BIGINT AS n_words, length(array_to_string(words, ''))::BIGINT AS word_chars,
    (length(text) - length(regexp_replace(text, '{symbols}', '', 'g')))::BIGINT AS n_symbols,
    (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines,
    coalesce(n_repeat_words, 0)::BIGINT AS n_repeat_words, len(failed)::BIGINT AS n_failed_lines,
    (length(array_to_string(words, ''))
      - length(regexp_replace(array_to_string(failed, ''), '{spaces}', '', 'g')))::BIGINT AS kept_chars
  FROM failing LEFT JOIN covered USING (r)
), based AS (
  SELECT *, n_words < {line_rules.MIN_WORDS}
    OR 100 * n_repeat_words > {line_rules.MAX_REPEATED_PERCENT} * n_words AS base_failed
  FROM measured
)
SELECT *, NOT base_failed AND kept_chars * 100 >= word_chars * {line_rules.MIN_KEPT_PERCENT} AS kept FROM based
"""


def _url_filters() -> str:
    u = url_reputation
    rules = ", ".join(f"({_text(h)}, {_text(p)}, {_text(v)})" for h, p, v in u.RULES)
    long = f"regexp_extract(bare, '[^.]*\\.[^.]*$') IN ({', '.join(map(_text, u.SUFFIXES))}) AND len(string_split(bare, '.')) > 2"
    address = "regexp_full_match(bare, '[0-9]+\\.[0-9]+\\.[0-9]+\\.[0-9]+') OR starts_with(bare, '[')"
    bare = "regexp_replace(regexp_replace(regexp_replace(host, '^.*@', ''), ':[0-9]*$', ''), '\\.+$', '')"

    def last(labels: int) -> str:
        """The last labels of a host, joined."""
        return f"array_to_string(string_split(bare, '.')[-{labels}:], '.')"

    def strength(groups: str, mean: str) -> str:
        m = mean
        return f"""(SELECT 1 / least(greatest(coalesce(
          (sum((bad - n * {m}) * (bad - n * {m})) - sum(n * {m} * (1 - {m}))) / nullif(sum(n * (n - 1) * {m} * (1 - {m})), 0),
          {u.LEAST_SPREAD}::DOUBLE), {u.LEAST_SPREAD}), {u.MOST_SPREAD}) - 1 AS s FROM {groups})"""

    return f"""
WITH rules(rule_host, rule_path, rule_verdict) AS (VALUES {rules}
), rest AS (
  SELECT row_number() OVER () AS r, page_id,
    CASE WHEN contains(url, '://') THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest
  FROM pages
), raw AS (
  SELECT *, regexp_extract(rest, '^[^/?#]*') AS raw FROM rest
), parts AS (
  SELECT r, page_id, translate(raw, '{UPPER}', '{LOWER}') AS host,
    regexp_extract(substr(rest, length(raw) + 1), '^[^?#]*') AS path
  FROM raw
), fitting AS (
  SELECT r, arg_max((rule_host || rule_path, rule_verdict), length(rule_host || rule_path)) AS best
  FROM parts JOIN rules ON (host = rule_host OR ends_with(host, '.' || rule_host)) AND starts_with(path, rule_path)
  GROUP BY r
), parsed AS (
  SELECT page_id, host, path, best[1] AS rule, best[2] AS verdict FROM parts LEFT JOIN fitting USING (r)
), hosts AS (
  SELECT host, count(verdict) AS n, count(*) FILTER (verdict = 'block') AS bad,
    CASE WHEN {address} THEN bare WHEN {long} THEN {last(2)} ELSE {last(1)} END AS suffix,
    CASE WHEN {address} THEN bare WHEN {long} THEN {last(3)} ELSE {last(2)} END AS domain
  FROM (SELECT *, {bare} AS bare FROM parsed) GROUP BY host, bare
), s0 AS (
  SELECT suffix, sum(n) AS n, sum(bad) AS bad,
    (SELECT (sum(bad) + 1) / (sum(n) + 2) FROM hosts) AS m FROM hosts GROUP BY suffix
), s1 AS (
  SELECT suffix, (bad + s * m) / (n + s) AS m FROM s0, {strength("s0", "m")}
), d0 AS (
  SELECT domain, any_value(m) AS m, sum(n) AS n, sum(bad) AS bad FROM hosts JOIN s1 USING (suffix) GROUP BY domain
), d1 AS (
  SELECT domain, (bad + s * m) / (n + s) AS m FROM d0, {strength("d0", "m")}
), h0 AS (
  SELECT host, hosts.n, hosts.bad, m FROM hosts JOIN d1 USING (domain)
), h1 AS (
  SELECT host, n, bad, n + s AS size, (bad + s * m) / (n + s) AS m FROM h0, {strength("h0", "m")}
)
SELECT page_id, host, path, rule,
  coalesce(verdict, CASE WHEN m - {u.Z} * sqrt(m * (1 - m) / (size + 1)) >= {u.MAX_BAD} THEN 'block' ELSE 'allow' END) AS verdict,
  n AS host_outcomes, bad AS host_blocked
FROM parsed JOIN h1 USING (host)
"""


ORACLE = {
    "op1_license_scans": _licenses(),
    "op5_sharding": _sharding(),
    "op6_url_filters": _url_filters(),
    "op9_quality_rules": _line_rules(),
}
