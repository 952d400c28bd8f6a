"""DuckDB SQL that gives the rows of the registered queries, where SQL can express them."""

from siltstone.llm.url_filter import LISTED_HOSTS, RULES

_HOST = "translate(regexp_extract(rest, '^[^/?#]*', 0), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


def _rules() -> tuple[str, str]:
    fit = [(f"(host = '{h}' OR ends_with(host, '.{h}')) AND starts_with(path, '{p}')", h + p, said) for said, h, p in sorted(RULES, key=lambda r: -len(r[1] + r[2]))]
    return " ".join(f"WHEN {c} THEN '{r}'" for c, r, _ in fit), " ".join(f"WHEN {c} THEN '{v}'" for c, _, v in fit)


_RULE, _VERDICT = _rules()
_LISTED = " OR ".join(f"host = '{h}' OR ends_with(host, '.{h}')" for h in LISTED_HOSTS)

ORACLES = {
    "op1_url_filter": f"""
WITH cut AS (SELECT page_id, CASE WHEN position('://' IN url) > 0 THEN substring(url, position('://' IN url) + 3) ELSE '' END AS rest FROM pages),
parts AS (SELECT page_id, {_HOST} AS host, regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM cut)
SELECT page_id, host, path, CASE {_RULE} END AS rule, CASE {_VERDICT} WHEN {_LISTED} THEN 'block' ELSE 'allow' END AS verdict FROM parts""",
}
