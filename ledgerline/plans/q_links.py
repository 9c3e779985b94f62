"""Registered queries: link audit over the page table (M)."""

from __future__ import annotations

from ledgerline.operators import links as M
from ledgerline.plans.catalog import register
from ledgerline.sources import derived as D

PAGES = D.pages_sql()
_PAT = M.HREF_PATTERN.replace("'", "''")

EXTRACT_SQL = (
    f"select page_id, source_url, position, href from ("
    f"select page_id, url as source_url, generate_subscripts(g1, 1) as position, unnest(g1) as a, unnest(g2) as b "
    f"from (select page_id, url, regexp_extract_all(html, '{_PAT}', 1) as g1, "
    f"regexp_extract_all(html, '{_PAT}', 2) as g2 from {PAGES} p) x) y, "
    f"lateral (select regexp_replace(case when a <> '' then a else b end, '^\\s+|\\s+$', '', 'g') as href) h "
    f"where href <> ''")

KIND_SQL = (
    "case when starts_with(href, '#') or href in ('.', '..') then 'anchor' "
    "when regexp_matches(href, '^(mailto:|tel:|javascript:|data:)', 'i') then 'skip' "
    "when regexp_matches(href, '^(https?://)', 'i') then 'remote' else 'local' end")
KINDS_SQL = f"select *, {KIND_SQL} as kind from ({EXTRACT_SQL}) e"

_HOST = "regexp_extract({u}, '^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)', 1)"
_PATH = ("case when regexp_extract({u}, '^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*([^?#]*)', 1) = '' then '/' "
         "else regexp_extract({u}, '^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*([^?#]*)', 1) end")
# Dot segments fold into a growing path text: ``..`` cuts its last segment, ``.`` adds nothing.
_FOLDED = ("list_reduce(string_split(j, '/')[2:], lambda acc, x: case when x = '..' then "
           "regexp_replace(acc, '/[^/]*$', '') when x = '.' then acc else acc || '/' || x end, '')")
_DOTLESS = (f"case when {_FOLDED} = '' then '/' when regexp_matches(j, '/[.][.]?$') then {_FOLDED} || '/' "
            f"else {_FOLDED} end")
CHECK_SQL = (
    f"with k as ({KINDS_SQL}), bare as (select *, regexp_replace(href, '[?#].*$', '') as b, "
    f"{_PATH.format(u='source_url')} as sp from k), "
    f"joined as (select *, case when starts_with(b, '/') then b else regexp_replace(sp, '/[^/]*$', '') || '/' || b "
    f"end as j from bare), "
    f"t as (select * exclude (b, sp, j), case when kind <> 'local' then null when b = '' then sp "
    f"when contains(j, '/.') then {_DOTLESS} else j end as target_path, "
    f"{_HOST.format(u='source_url')} as host from joined), "
    f"known as (select distinct {_HOST.format(u='url')} as h, {_PATH.format(u='url')} as p from {PAGES} pg) "
    f"select page_id, source_url, position, href, kind, target_path, "
    f"(kind <> 'local' or exists (select 1 from known where known.h = t.host and known.p = t.target_path)) as ok, "
    f"case when not (kind <> 'local' or exists (select 1 from known where known.h = t.host and "
    f"known.p = t.target_path)) then 'Missing: ' || target_path when kind = 'remote' then 'skipped' else '' end "
    f"as error from t")

SUMMARY_SQL = (
    f"select page_id, count(*) as checked, count(*) filter (where not ok) as broken, "
    f"count(*) filter (where kind = 'anchor') as anchors, count(*) filter (where kind = 'skip') as skipped, "
    f"count(*) filter (where kind = 'remote') as remote, count(*) filter (where kind = 'local') as local "
    f"from ({CHECK_SQL}) c group by page_id")


@register("link_extract", EXTRACT_SQL)
def link_extract(spark, sf_dir):
    return M.extract_links(D.pages(spark, sf_dir))


@register("link_kinds", KINDS_SQL)
def link_kinds(spark, sf_dir):
    return M.classify(M.extract_links(D.pages(spark, sf_dir)))


@register("link_broken_local", CHECK_SQL)
def link_broken_local(spark, sf_dir):
    pages = D.pages(spark, sf_dir)
    return M.check_local(M.classify(M.extract_links(pages)), pages)


@register("link_summary", SUMMARY_SQL)
def link_summary(spark, sf_dir):
    pages = D.pages(spark, sf_dir)
    return M.link_summary(M.check_local(M.classify(M.extract_links(pages)), pages))
