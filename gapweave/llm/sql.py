"""DuckDB SQL for the corpus queries that SQL can express over whole tables."""

from __future__ import annotations

from gapweave.llm import urltree

EXACT_DEDUP = r"""
    WITH n AS (SELECT doc_id, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g')) AS text_sha256 FROM documents)
    SELECT doc_id, min(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
           row_number() OVER (PARTITION BY text_sha256 ORDER BY doc_id NULLS LAST) = 1 AS kept, text_sha256
    FROM n WINDOW w AS (PARTITION BY text_sha256)
"""


def path_template_tree() -> str:
    """The tree of op9, one group of subqueries a level."""
    rules = sorted(urltree.RULES, key=lambda r: (-len(r[1]), r[1]))

    def fits(rule: str) -> str:
        host, path = rule[: rule.index("/")], rule[rule.index("/") :]
        return f"((host = '{host}' OR ends_with(host, '.{host}')) AND starts_with(path, '{path}'))"

    rule_of = "CASE " + " ".join(f"WHEN {fits(r)} THEN '{r}'" for _, r in rules) + " END"
    blocked = "CASE " + " ".join(f"WHEN rule = '{r}' THEN {int(v == 'block')}" for v, r in rules) + " END"
    sql = rf"""
    WITH u AS (SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages),
    p AS (SELECT page_id, translate(regexp_extract(rest, '^([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
                 regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM u),
    q AS (SELECT *, {rule_of} AS rule, list_transform(list_transform(list_filter(string_split(path, '/'), lambda x: x <> ''),
                 lambda x: regexp_replace(x, '^(.+)\.[A-Za-z0-9]{{1,5}}$', '\1')),
                 lambda x: CASE WHEN regexp_full_match(x, '[0-9]+') OR (regexp_full_match(x, '[0-9A-Fa-f-]{{8,}}') AND regexp_matches(x, '[0-9]')) THEN '*' ELSE x END) AS segs FROM p),
    t AS (SELECT page_id, host, path, rule, {blocked} AS blocked,
                 CASE WHEN len(segs) > {urltree.DEPTH} THEN list_append(list_slice(segs, 1, {urltree.DEPTH}), '**') ELSE segs END AS shape FROM q),
    s0 AS MATERIALIZED (SELECT host, shape, count(*) AS n, count(blocked) AS known, coalesce(sum(blocked), 0) AS blocked, '' AS template FROM t GROUP BY host, shape)"""
    for i in range(urltree.DEPTH + 1):
        sql += f""",
    r{i} AS MATERIALIZED (SELECT *, coalesce(shape[{i + 1}], '') AS segment FROM s{i}),
    n{i} AS MATERIALIZED (SELECT host, template, segment, sum(n) AS n, sum(known)::DOUBLE AS known, sum(blocked)::DOUBLE AS blocked FROM r{i} GROUP BY host, template, segment),
    a{i} AS (SELECT host, template, count(*) AS children, sum(n) AS n_all FROM n{i} GROUP BY host, template),
    b{i} AS MATERIALIZED (SELECT host, template, segment, CASE WHEN segment NOT IN ('', '*', '**') AND children > {urltree.MAX_CHILDREN} AND n < {urltree.MIN_SHARE} * n_all THEN '*' ELSE segment END AS branch,
        known, blocked FROM n{i} JOIN a{i} USING (host, template)),
    k{i} AS (SELECT host, template, branch, sum(known) AS k, sum(blocked) AS b FROM b{i} WHERE branch NOT IN ('', '*', '**') GROUP BY host, template, branch HAVING sum(known) > 0),
    l{i} AS (SELECT *, lag(k) OVER w AS k0, lag(b) OVER w AS b0 FROM k{i} WINDOW w AS (PARTITION BY host, template ORDER BY b / k, branch)),
    d{i} AS (SELECT *, coalesce(CAST(abs(b / k - b0 / k0) > {urltree.SIGNIFICANT} * sqrt((b + b0) / (k + k0) * (1 - (b + b0) / (k + k0)) * (1 / k + 1 / k0)) + 1e-9 AS INTEGER), 0) AS differs FROM l{i}),
    e{i} AS (SELECT *, sum(differs) OVER (PARTITION BY host, template ORDER BY b / k, branch ROWS UNBOUNDED PRECEDING) AS kind FROM d{i}),
    g{i} AS (SELECT host, template, branch, CASE WHEN count(*) OVER w > 1 THEN '#' || min(branch) OVER w ELSE branch END AS merged FROM e{i} WINDOW w AS (PARTITION BY host, template, kind)),
    m{i} AS (SELECT host, template, segment, coalesce(merged, branch) AS symbol FROM b{i} LEFT JOIN g{i} USING (host, template, branch)),
    s{i + 1} AS MATERIALIZED (SELECT host, shape, n, known, blocked, CASE WHEN symbol = '' THEN template ELSE template || '/' || symbol END AS template
        FROM r{i} JOIN m{i} USING (host, template, segment))"""
    last = f"s{urltree.DEPTH + 1}"
    return f"""{sql},
    base AS (SELECT (coalesce(sum(blocked), 0) + 1)::DOUBLE / (coalesce(sum(known), 0) + 2) AS base FROM {last}),
    h AS (SELECT host, (sum(blocked) + {urltree.SMOOTH} * any_value(base)) / (sum(known) + {urltree.SMOOTH}) AS host_rate FROM {last}, base GROUP BY host),
    l AS (SELECT host, template, round((sum(blocked) + {urltree.SMOOTH} * any_value(host_rate)) / (sum(known) + {urltree.SMOOTH}), 9) AS purity FROM {last} JOIN h USING (host) GROUP BY host, template)
    SELECT page_id, t.host, path, rule, CASE WHEN coalesce(t.blocked = 1, purity >= {urltree.LIMIT}) THEN 'block' ELSE 'allow' END AS verdict, f.template AS template, purity
    FROM t JOIN {last} AS f ON t.host = f.host AND t.shape = f.shape JOIN l ON l.host = f.host AND l.template = f.template"""
