"""Metadata fixtures derived from the driver tables (shared SQL text, both engines).

* fetch log: every ``events`` row is one conditional fetch attempt of a bulk
  archive (cycle from the user, table from the event id, status from the
  event type, ETag from the value) -- the input of freshness and current-state;
* review log: every ``events`` row is one entry (evidence, metric or decision) on the issues of a
  cycle and table -- the input of the issue status as of a time;
* run results: every ``events`` row is one run-results JSON document with one
  result (``model.*`` ids for the eight tables, plus ``test.*`` / ``seed.*``
  ids that the parser must skip; error events carry a non-numeric time);
* pages: the ``pages`` html plus a rendered footer of anchors, mailto/tel/
  javascript links, remote links, relative and query/fragment links, blank
  hrefs and single-quoted hrefs, so every branch of the link audit is hit.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.plans.joins import spread
from ledgerline.sources.layouts import ALL_TABLES

_TABLE_OF_EVENT = "case event_id % 8 " + " ".join(
    f"when {i} then '{t}'" for i, t in enumerate(ALL_TABLES)) + " end"

FETCH_FIELDS = {
    "cycle": "cast(1994 + 2 * (user_id % 4) as int)",
    "table_name": _TABLE_OF_EVENT,
    "fetch_id": "event_id",
    "fetched_at": "ts",
    "fetch_status": ("case event_type when 'error' then 'error' when 'view' then 'not_modified' "
                     "else 'downloaded' end"),
    "http_status": "cast(case event_type when 'error' then 500 when 'view' then 304 else 200 end as bigint)",
    "etag": ("case when event_id % 5 < 2 then null when event_id % 5 = 2 then '' else case when event_id % 2 = 0 then 'W/' else '' end "
             "|| cast(cast(floor(value) as bigint) % 3 as string) end"),
    "last_modified": ("case when event_id % 7 = 0 then null when event_id % 11 = 0 then 'yesterday' else case cast(floor(value) as bigint) % 3 "
                      "when 0 then 'Mon, 01 Jan 2024 10:00:00 GMT' when 1 then 'Tue, 02 Jan 2024 10:00:00 GMT' else 'Wed, 03 Jan 2024 09:59:59 GMT' end end"),
}

#: Operations on source files: fetches, loads and audits, each silent about the other kinds' columns.
_KIND = "case event_type when 'signup' then 'load' when 'purchase' then 'audit' else 'fetch' end"
_FETCHED = "event_type = 'click'"
OPERATION_FIELDS = {
    "cycle": "cast(1994 + 2 * (user_id % 4) as int)",
    "table_name": _TABLE_OF_EVENT,
    "op_id": "event_id",
    "op_time": "cast(ts as {naive})",
    "last_operation": _KIND,
    "operation_status": ("case event_type when 'error' then 'error' when 'view' then 'not_modified' when 'click' then 'downloaded' "
                         "when 'signup' then case when event_id % 6 = 0 then 'failed' else 'success' end "
                         "else case when event_id % 3 = 0 then 'warn' else 'pass' end end"),
    "quality_status": "case when event_type = 'purchase' then case when event_id % 3 = 0 then 'warn' else 'pass' end end",
    "http_status": f"cast(case when {_KIND} = 'fetch' then case event_type when 'error' then 500 when 'view' then 304 else 200 end end as bigint)",
    "content_length": f"case when {_FETCHED} then cast(floor(value) as bigint) * 1000 + event_id % 1000 end",
    "row_count": "case when event_type = 'signup' and event_id % 6 <> 0 then cast(floor(value) as bigint) + event_id % 100 end",
    "duration_ms": "case when event_type = 'signup' then cast(floor(value) as bigint) * 7 end",
    "response_date": f"case when {_KIND} = 'fetch' then 'day ' || cast(event_id % 30 as string) end",
    "last_modified": f"case when {_FETCHED} and event_id % 4 <> 0 then 'day ' || cast(event_id % 28 as string) end",
    "etag": f"case when {_FETCHED} then 'W/' || cast(event_id % 1000 as string) end",
    "error_text": "case when event_type = 'error' then 'HTTP 500' when event_type = 'signup' and event_id % 6 = 0 then 'load stopped' else '' end",
}

REVIEW_FIELDS = {
    "cycle": "cast(1996 + 2 * (user_id % 4) as bigint)",
    "table_name": _TABLE_OF_EVENT,
    "log_id": "event_id",
    "logged_at": "cast(ts as {naive})",
    "kind": "case event_type when 'error' then 'decision' when 'view' then 'evidence' else 'metric' end",
    "decision": ("case when event_type = 'error' then case cast(floor(value) as bigint) % 4 when 0 then 'accept' "
                 "when 1 then 'keep_warning' when 2 then 'investigate_load' else 'reopen' end end"),
}

_RUN_ID = "case event_id % 10 " + " ".join(
    f"when {i} then 'model.ledger.{t}'" for i, t in enumerate(ALL_TABLES)) + \
    " when 8 then 'test.ledger.not_null_cm_CMTE_ID' else 'seed.ledger.issue' end"
_EXEC_TIME = ("case when event_type = 'error' then '\"n/a\"' when value is null then 'null' "
              "else cast(cast(value as decimal(12,3)) as string) end")
RUN_FIELDS = {
    "cycle": "cast(1994 + 2 * (user_id % 4) as int)",
    "run_id": "event_id",
    "started_at": "ts",
    "json_text": "'{\"results\":[{\"unique_id\":\"' || " + _RUN_ID + " || '\",\"execution_time\":' || "
                 + _EXEC_TIME + " || '}]}'",
}

_FOOTER = (
    "'<footer><a href=\"#top\">top</a><a href=\".\">here</a>"
    "<a href=''mailto:desk' || cast(page_id % 7 as string) || '@news.example''>mail</a>"
    "<a href=\"Tel:+1555' || cast(page_id % 10 as string) || '\">call</a>"
    "<a href=\"JavaScript:void(0)\">js</a>"
    "<a href=\"HTTPS://ext' || cast(page_id % 5 as string) || '.example/a\">ext</a>"
    "<a href=\"http://mirror.example/p?id=' || cast(page_id as string) || '\">mirror</a>"
    "<a href=\"   \">blank</a>"
    "<a href=\"?view=all\">view</a><a href=\"./' || cast(page_id % 11 as string) || '\">dot</a>"
    "<a href=\"x/../' || cast(page_id % 11 as string) || '#c\">up</a><a href=\"../../up.html\">top</a>"
    "<a href=\"x/..\">dir</a>"
    "<a href = \"  rel/page' || cast(page_id % 4 as string) || '.html \">rel</a>"
    "<a href=\"/' || cast(page_id % 13 as string) || '?q=1#frag\">self</a></footer>'"
)
PAGE_FIELDS = {
    "page_id": "page_id",
    "url": "url",
    "html": "html || " + _FOOTER,
}


def fields_sql(fields: dict[str, str]) -> str:
    return ", ".join(f"{expr} as {name}" for name, expr in fields.items())


def _frame(spark: SparkSession, sf_dir: str, table: str, fields: dict[str, str]) -> DataFrame:
    src = spread(spark.read.parquet(f"{sf_dir}/{table}.parquet"))
    return src.select(*[F.expr(e).alias(n) for n, e in fields.items()])


def fetch_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _frame(spark, sf_dir, "events", FETCH_FIELDS)


def operations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _frame(spark, sf_dir, "events", {k: e.replace("{naive}", "timestamp_ntz") for k, e in OPERATION_FIELDS.items()})


def operations_sql() -> str:
    return f"(select {fields_sql(OPERATION_FIELDS).replace('{naive}', 'timestamp')} from events)"


def review_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _frame(spark, sf_dir, "events", {k: e.replace("{naive}", "timestamp_ntz") for k, e in REVIEW_FIELDS.items()})


def review_log_sql() -> str:
    return f"(select {fields_sql(REVIEW_FIELDS).replace('{naive}', 'timestamp')} from events)"


def run_results_docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _frame(spark, sf_dir, "events", RUN_FIELDS)


def pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _frame(spark, sf_dir, "pages", PAGE_FIELDS)


def fetch_log_sql() -> str:
    return f"(select {fields_sql(FETCH_FIELDS)} from events)"


def run_results_sql() -> str:
    return f"(select {fields_sql(RUN_FIELDS)} from events)"


def pages_sql() -> str:
    return f"(select {fields_sql(PAGE_FIELDS)} from pages)"
