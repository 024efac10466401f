"""DuckDB building blocks for the oracle statements.

Written from the rules themselves: names are compared pair by pair on their tokens, without the
blocking that the Spark side uses, so that an error in it would show.
"""

from __future__ import annotations

from quotebook.fixtures import duckdb_views
from quotebook.functions import vocabulary as v

WS = (
    r"\t-\r\x1c-\x1f \x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"
)
DIGITS = r"[0-9]+(_[0-9]+)*"


def words(names: tuple) -> str:
    return "(" + ", ".join(f"'{w}'" for w in dict.fromkeys(names)) + ")"


def strip(e: str) -> str:
    return f"regexp_replace({e}, '^[{WS}]+|[{WS}]+$', '', 'g')"


def expand(e: str) -> str:
    for short, long in (("ent", "enterprise"), ("lab", "laboratories")):
        for _ in range(2):  # neighbours share their separator
            e = rf"regexp_replace({e}, '(^|[^\p{{L}}\p{{N}}_]){short}($|[^\p{{L}}\p{{N}}_])', '\1{long}\2', 'gi')"
    return e


def canonical(e: str) -> str:
    return strip(expand(e))


def norm(e: str) -> str:
    out = f"regexp_replace(lower({canonical(e)}), '[^a-z0-9]', '', 'g')"
    for w in v.KEY_NOISE:
        out = f"replace({out}, '{w}', '')"
    return out


def stem(t: str) -> str:
    return f"CASE WHEN length({t}) > 4 AND {t} LIKE '%s' AND {t} NOT LIKE '%ss' THEN left({t}, length({t}) - 1) ELSE {t} END"


def tokens(e: str) -> str:
    low = f"lower({canonical(e)})"
    both = (
        f"list_concat(regexp_extract_all({low}, '[a-z0-9]+'), "
        f"regexp_extract_all(regexp_replace({low}, '[-''/]', '', 'g'), '[a-z0-9]+'))"
    )
    kept = f"list_filter({both}, lambda w: length(w) > 1 AND w NOT IN {words(v.STOP_TOKENS)})"
    return f"list_sort(list_distinct(list_transform({kept}, lambda w: {stem('w')})))"


def identity(list_expr: str) -> str:
    return f"list_filter({list_expr}, lambda t: length(t) >= 4 AND t NOT IN {words(v.DESCRIPTOR_TOKENS)})"


def variants(e: str) -> str:
    pieces = (
        f"list_concat(list_concat([{e}], regexp_extract_all({e}, '\\(([^)]+)\\)', 1)), "
        f"string_split_regex({e}, '(?i)\\b(formerly|previously|known as)\\b'))"
    )
    cleaned = f"list_filter(list_transform({pieces}, lambda p: trim(p, ' \t-–—,()')), lambda p: length(p) >= 3)"
    return f"flatten(list_transform({cleaned}, lambda p: [p, {expand('p')}]))"


def significant(e: str, drop_limited: bool = True) -> str:
    fluff = tuple(w for w in v.TRAILING_WORDS if drop_limited or w not in ("limited", "ltd"))
    runs = f"regexp_extract_all(lower({e}), '[a-z0-9]+')"
    last = f"coalesce(list_max(list_transform({runs}, lambda w, i: CASE WHEN w IN {words(fluff)} THEN 0 ELSE i END)), 0)"
    return f"list_slice({runs}, 1, {last})"


def acronyms(e: str) -> str:
    one = [
        f"list_aggregate(list_transform({significant(e, d)}, lambda w: left(w, 1)), 'string_agg', '')" for d in (True, False)
    ]
    return f"list_sort(list_distinct(list_filter([{one[0]}, {one[1]}], lambda a: length(a) BETWEEN 2 AND 6)))"


def chunks(e: str) -> str:
    return f"regexp_extract_all({e}, '\\(([^)]+)\\)', 1)"


def float_of(e: str) -> str:
    pattern = rf"^[+-]?(({DIGITS}(\.({DIGITS})?)?|\.{DIGITS})(e[+-]?{DIGITS})?|inf(inity)?|nan)$"
    return f"CASE WHEN regexp_matches({e}, '{pattern}', 'i') THEN TRY_CAST(replace({e}, '_', '') AS DOUBLE) END"


def clean_value(e: str) -> str:
    return strip(f"replace(replace(replace({e}, '₹', ''), ',', ''), '%', '')")


def parse_float(e: str) -> str:
    return f"CASE WHEN {e} NOT IN ('', 'N/A', '-') THEN {float_of(clean_value(e))} END"


def clean_price(e: str) -> str:
    s = strip(f"replace(replace(replace(replace({e}, '₹', ''), ',', ''), ' ', ''), chr(10), '')")
    return (
        f"CASE WHEN contains({s}, '.') THEN {float_of(s)} "
        f"WHEN regexp_matches({s}, '^[+-]?{DIGITS}$') THEN TRY_CAST(replace({s}, '_', '') AS DOUBLE) END"
    )


def slug_ascii(e: str) -> str:
    return f"trim(regexp_replace(regexp_replace(lower({e}), '[^a-z0-9{WS}-]', '', 'g'), '[{WS}-]+', '-', 'g'), '-')"


def slug_unicode(e: str) -> str:
    kept = rf"regexp_replace({strip(f'lower({e})')}, '[^\p{{L}}\p{{N}}_{WS}-]', '', 'g')"
    return f"trim(regexp_replace({kept}, '[{WS}_-]+', '-', 'g'), '-')"


def joined(list_expr: str) -> str:
    """A list as text, empty rather than null without elements."""
    return f"coalesce(array_to_string({list_expr}, '|'), '')"


# --- resolution --------------------------------------------------------------------------------


def match_ctes(primary: str, secondary: str, alias: str = "fx_alias") -> str:
    """CTEs over ``primary(ord, company, slug)`` and ``secondary(company, short_name)``.

    scored(company, short_name, slug, ord, tier, jaccard), best(…, ambiguous), resolved(…, slug).
    """
    return f"""
p_names AS (SELECT ord, company, slug, {tokens('company')} AS toks FROM {primary}),
s_dist AS (SELECT DISTINCT company, coalesce(short_name, '') AS short_name FROM {secondary}),
a_keys AS (SELECT ord, secondary_name, primary_name, {norm('secondary_name')} AS k FROM {alias}),
a_first AS (SELECT k, arg_min(primary_name, ord) AS primary_name FROM a_keys WHERE k <> '' GROUP BY k),
s_names AS (
  SELECT row_number() OVER (ORDER BY s.company, s.short_name) AS sid, s.company, s.short_name,
         {tokens('s.company')} AS toks, coalesce(e.primary_name, f.primary_name) AS mapped_name
  FROM s_dist s LEFT JOIN a_keys e ON e.secondary_name = s.company LEFT JOIN a_first f ON f.k = {norm('s.company')}),
p_var AS (SELECT DISTINCT slug, unnest({variants('company')}) AS variant FROM p_names),
s_hint AS (
  SELECT sid, company AS hint FROM s_names UNION SELECT sid, short_name FROM s_names UNION
  SELECT sid, mapped_name FROM s_names WHERE mapped_name IS NOT NULL),
s_var AS (SELECT DISTINCT sid, unnest({variants('hint')}) AS variant FROM s_hint),
p_feat AS (
  SELECT row_number() OVER () AS pv, slug, {norm('variant')} AS nrm, {tokens('variant')} AS toks,
         list_concat(list_concat(list_transform({chunks('variant')}, lambda c: {norm('c')}),
                                 list_transform({chunks('variant')}, lambda c: {norm(norm('c'))})),
                     {acronyms('variant')}) AS shorts
  FROM p_var),
s_feat AS (SELECT row_number() OVER () AS sv, sid, {norm('variant')} AS nrm, {tokens('variant')} AS toks FROM s_var),
p_tok AS (SELECT pv, slug, len(toks) AS n, unnest(toks) AS t FROM p_feat),
s_tok AS (SELECT sv, sid, len(toks) AS n, unnest(toks) AS t FROM s_feat),
shared AS (
  SELECT sv, any_value(sid) AS sid, pv, any_value(p_tok.slug) AS slug, any_value(s_tok.n) AS n, any_value(p_tok.n) AS m, count(*) AS k
  FROM s_tok JOIN p_tok USING (t) GROUP BY sv, pv),
hits AS (
  SELECT sid, p.slug, 95 AS tier FROM s_feat s JOIN p_feat p USING (nrm) WHERE nrm <> ''
  UNION ALL SELECT sid, slug, 88 FROM shared WHERE k = least(n, m) AND k >= 2
  UNION ALL SELECT sid, p.slug, 82 FROM s_feat s JOIN (SELECT slug, unnest(shorts) AS nrm FROM p_feat) p USING (nrm) WHERE length(nrm) >= 3
  UNION ALL SELECT sid, slug, 70 FROM shared WHERE k >= 2 AND k < least(n, m) AND k / (n + m - k) >= 0.72),
full_shared AS (
  SELECT sid, slug, any_value(n) AS n, any_value(m) AS m, count(*) AS k
  FROM (SELECT sid, len(toks) AS n, unnest(toks) AS t FROM s_names) a
  JOIN (SELECT slug, len(toks) AS m, unnest(toks) AS t FROM p_names) b USING (t) GROUP BY sid, slug),
tiers AS (SELECT sid, slug, tier FROM hits GROUP BY sid, slug, tier),
pair_tiers AS (
  SELECT t.sid, t.slug, t.tier, p.ord, coalesce(f.k / (f.n + f.m - f.k), 0.0) AS jaccard
  FROM tiers t JOIN p_names p USING (slug) LEFT JOIN full_shared f ON f.sid = t.sid AND f.slug = t.slug),
scored AS (SELECT sid, slug, max(tier) AS tier, any_value(ord) AS ord, any_value(jaccard) AS jaccard FROM pair_tiers GROUP BY sid, slug),
{best_cte('best', 'scored', 'sid')},
s_ident AS (
  SELECT sid, step, hint, {identity(tokens('hint'))} AS ids
  FROM (SELECT sid, 0 AS step, company AS hint FROM s_names UNION ALL SELECT sid, 1, short_name FROM s_names WHERE short_name <> '')
  WHERE sid NOT IN (SELECT sid FROM scored)),
s_ident_tok AS (SELECT sid, step, hint, len(ids) AS n, unnest(ids) AS t FROM s_ident),
p_index AS (SELECT slug, company, ord, unnest(toks) AS t FROM p_names),
p_df AS (SELECT t, count(*) AS df, min(slug) AS slug, min(company) AS company FROM p_index GROUP BY t),
unique_token AS (
  SELECT sid, step, min(slug) AS slug FROM (
    SELECT sid, step, slug FROM s_ident_tok JOIN p_index USING (t) GROUP BY sid, step, slug, n HAVING count(*) = n)
  GROUP BY sid, step HAVING count(*) = 1),
unique_prefix AS (
  SELECT sid, step, slug FROM (
    SELECT sid, step, any_value(hint) AS hint, count(*) AS present, max(df) AS df, max(slug) AS slug, max(company) AS company
    FROM s_ident_tok JOIN p_df USING (t) GROUP BY sid, step)
  WHERE present = 1 AND df = 1 AND {norm('hint')} <> '' AND length({norm('company')}) >= 4
    AND (starts_with({norm('hint')}, {norm('company')}) OR starts_with({norm('company')}, {norm('hint')}))),
picked AS (
  SELECT sid, slug, 0 AS step FROM best WHERE NOT ambiguous
  UNION ALL SELECT sid, slug, 1 + step FROM unique_token UNION ALL SELECT sid, slug, 3 + step FROM unique_prefix),
resolved AS (
  SELECT s.company, s.short_name, arg_min(picked.slug, step) AS slug, CAST(min(step) AS INTEGER) AS step
  FROM picked JOIN s_names s USING (sid) GROUP BY s.company, s.short_name)"""


def best_cte(name: str, pairs: str, key: str) -> str:
    return f"""{name} AS (
  SELECT {key}, slug, tier, jaccard,
         tier < 95 AND next_tier IS NOT NULL AND tier = next_tier AND abs(jaccard - next_jaccard) < 0.2 AS ambiguous
  FROM (SELECT *, row_number() OVER w AS rank, lead(tier) OVER w AS next_tier, lead(jaccard) OVER w AS next_jaccard
        FROM {pairs} WINDOW w AS (PARTITION BY {key} ORDER BY tier DESC, jaccard DESC, ord)) WHERE rank = 1)"""


def fixture_match(keep_short: bool = True) -> str:
    short = "short_name" if keep_short else "CAST(NULL AS VARCHAR) AS short_name"
    return (
        f"{duckdb_views('fx_primary_raw', 'fx_secondary_raw', 'fx_alias')}, "
        f"m_secondary AS (SELECT company, {short} FROM fx_secondary_raw), "
        f"{match_ctes('fx_primary_raw', 'm_secondary')}"
    )
