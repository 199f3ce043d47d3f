"""Registered queries of the record-cleaning operators, each with its oracle."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import values
from ..config import Config
from ..functions import missing as M
from ..functions import normalize as N
from ..functions import text as T
from ..operators import dedup, infer, ledger, merge, rules, score, security, semantic
from ..operators.clean import LINE, clean
from ..sources import generators, sinks, tables
from . import oracle as O
from . import pipeline, report
from .leads import FIELDS, LEADS, TYPES, leads, lined

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def add(f: Query) -> Query:
        QUERIES[name] = f
        if sql is not None:
            ORACLE[name] = sql
        return f

    return add


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _cleaned(spark, sf_dir, cfg=Config()):
    return clean(lined(spark, sf_dir), TYPES, cfg)


def _until(spark, sf_dir, step, cfg=Config()):
    return pipeline.records(lined(spark, sf_dir), cfg, types=TYPES, until=step)


def _line():
    return F.col(LINE).alias("line_no")


# -- text and missing values -------------------------------------------------------------------------------------------

_LEADS = f"leads AS ({LEADS})"


@query("sanitize_fields", O.sql(_LEADS, "SELECT line_no, " + ", ".join(f"{O.sanitized(f, f)} AS {f}" for f in FIELDS) + " FROM leads"))
def _(spark, sf_dir):
    return leads(spark, sf_dir).select("line_no", *(M.sanitize(F.col(f), f).alias(f) for f in FIELDS))


@query("missing_indicators", O.sql(_LEADS, "SELECT line_no, " + ", ".join(f"{O.missing(f)} AS {f}_was_missing" for f in FIELDS) + " FROM leads"))
def _(spark, sf_dir):
    return M.indicators(leads(spark, sf_dir), FIELDS).select("line_no", *(f"{f}_was_missing" for f in FIELDS))


@query("strip_emojis", O.sql(_LEADS, f"SELECT line_no, {O.emoji('first_name')} AS first_name, {O.emoji('job_title')} AS job_title FROM leads"))
def _(spark, sf_dir):
    return leads(spark, sf_dir).select("line_no", T.strip_emojis(F.col("first_name")).alias("first_name"), T.strip_emojis(F.col("job_title")).alias("job_title"))


@query("clean_whitespace", f"SELECT doc_id, {O.squeeze('text')} AS text FROM documents")
def _(spark, sf_dir):
    return _table(spark, sf_dir, "documents").select("doc_id", T.clean_whitespace(F.col("text")).alias("text"))


@query("fingerprint_sha256", f"SELECT doc_id, sha256(lower({O.strip('text')})) AS fingerprint FROM documents")
def _(spark, sf_dir):
    return _table(spark, sf_dir, "documents").select("doc_id", T.fingerprint(F.col("text")).alias("fingerprint"))


@query("row_ids", O.sql(_LEADS, f"SELECT line_no, {O.ROW_ID} AS row_id FROM leads"))
def _(spark, sf_dir):
    return leads(spark, sf_dir).select("line_no", T.row_uuid("run", F.col("line_no")).alias("row_id"))


# -- normalisers -------------------------------------------------------------------------------------------------------


def _normal(name: str, field: str):
    @query(name, O.sql(O.NORMAL, f"SELECT line_no, v_{field} AS value, st_{field} AS status FROM v"))
    def _(spark, sf_dir):
        from ..operators.clean import normalizer

        c = F.col(field)
        r = normalizer(TYPES[field], c, field, Config())
        gone = M.is_missing(c)
        rows = leads(spark, sf_dir).select("line_no", gone.alias("gone"), r.alias("r"))
        return rows.select("line_no", F.when(~F.col("gone"), F.col("r.value")).alias("value"), F.when(F.col("gone"), "MISSING").otherwise(F.col("r.status")).alias("status"))


for _name, _field in (("norm_email", "email"), ("norm_phone", "phone"), ("norm_first_name", "first_name"), ("norm_last_name", "last_name"), ("norm_job_title", "job_title"), ("norm_company", "company"), ("norm_date_iso", "join_date"), ("parse_currency", "salary")):
    _normal(_name, _field)


@query("norm_customer_phone", r"SELECT c_custkey, CASE WHEN length(d) = 10 THEN concat(d[1:3], '-', d[4:6], '-', d[7:10]) WHEN length(d) = 7 THEN concat(d[1:3], '-', d[4:7]) ELSE 'Not Provided' END AS phone FROM (SELECT c_custkey, CASE WHEN length(x) = 11 AND starts_with(x, '1') THEN substr(x, 2) ELSE x END AS d FROM (SELECT c_custkey, regexp_replace(concat('1', lpad(CAST(c_custkey * 7919 % 10000000000 AS VARCHAR), 10, '0')), '\D', '', 'g') AS x FROM customer))")
def _(spark, sf_dir):
    raw = F.concat(F.lit("1"), F.lpad((F.col("c_custkey") * 7919 % 10000000000).cast("string"), 10, "0"))
    return _table(spark, sf_dir, "customer").select("c_custkey", N.phone(raw)["value"].alias("phone"))


# -- duplicates --------------------------------------------------------------------------------------------------------

_MARKS = "SELECT line_no, fingerprint, is_duplicate, duplicate_of FROM m"


def _dedup(strategy: str, key: str | None = None):
    @query(f"dedup_{strategy}", O.sql(O.marked(strategy, key), _MARKS))
    def _(spark, sf_dir):
        cfg = Config(strategy=strategy)
        return dedup.mark(_cleaned(spark, sf_dir, cfg), cfg).select(_line(), "fingerprint", "is_duplicate", "duplicate_of")


for _s in ("email_only", "phone_only", "composite"):
    _dedup(_s)


@query("dedup_all_fields", O.sql(_LEADS, "SELECT c_name, c_mktsegment, row_number() OVER (PARTITION BY c_mktsegment, c_nationkey ORDER BY c_custkey) > 1 AS is_duplicate FROM customer"))
def _(spark, sf_dir):
    rows = _table(spark, sf_dir, "customer").select(F.col("c_mktsegment").alias("segment"), F.col("c_nationkey").cast("string").alias("nation"), F.col("c_custkey").cast("long").alias(LINE))
    cfg = Config(strategy="all_fields")
    marked = dedup.mark(clean(rows, {}, cfg), cfg)
    names = _table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_mktsegment")
    return marked.join(names, marked[LINE] == names["c_custkey"]).select("c_name", "c_mktsegment", "is_duplicate")


@query("dedup_documents_exact", f"SELECT doc_id, row_number() OVER (PARTITION BY lower({O.strip('text')}) ORDER BY doc_id) > 1 AS is_duplicate, first_value(doc_id) OVER (PARTITION BY lower({O.strip('text')}) ORDER BY doc_id) AS keeper FROM documents")
def _(spark, sf_dir):
    docs = _table(spark, sf_dir, "documents").select("doc_id", T.fingerprint(F.col("text")).alias("fp"))
    first = docs.groupBy("fp").agg(F.min("doc_id").alias("keeper"))
    return docs.join(first, "fp").select("doc_id", (F.col("doc_id") != F.col("keeper")).alias("is_duplicate"), "keeper")


def _enriched(name: str, fields: list[str]):
    @query(name, O.sql(O.ENRICHED, f"SELECT line_no, {', '.join(fields)} FROM e2 WHERE NOT is_duplicate"))
    def _(spark, sf_dir):
        out = dedup.enrich(dedup.mark(_cleaned(spark, sf_dir)))
        return out.where("not is_duplicate").select(_line(), *(F.col("clean")[f].alias(f) for f in fields))


_enriched("enrich_gap_fill", ["first_name", "last_name", "job_title", "company", "join_date"])
_enriched("enrich_recency", ["email", "phone", "salary"])

# -- scores and routes -------------------------------------------------------------------------------------------------


@query("confidence_scores", O.sql(O.SCORED, "SELECT line_no, round(score, 6) AS score FROM sc"))
def _(spark, sf_dir):
    out = dedup.enrich(dedup.mark(_cleaned(spark, sf_dir)))
    return out.select(_line(), F.round(score.confidence(out, ["email", "phone"]), 6).alias("score"))


@query("route_status", O.sql(O.ROUTED, "SELECT line_no, status, failure_reason, round(confidence_score, 6) AS confidence_score FROM r"))
def _(spark, sf_dir):
    return _until(spark, sf_dir, "route").select(_line(), "status", "failure_reason", F.round("confidence_score", 6).alias("confidence_score"))


_FILLED = " + ".join(f"CASE WHEN coalesce(CAST({f} AS VARCHAR), '') <> '' THEN 1 ELSE 0 END" for f in FIELDS)
_WRONG = " OR ".join(f"st_{f} = 'INVALID'" for f in FIELDS)


@query("route_generic_mode", O.sql(O.SCORED, f"SELECT line_no, CASE WHEN is_duplicate THEN 'REJECTED' WHEN (score >= 0.7 AND NOT lacking) OR (({_FILLED}) >= 3 AND NOT ({_WRONG})) THEN 'CLEAN' ELSE 'AI_REQUIRED' END AS status, round(CASE WHEN is_duplicate THEN 0 WHEN (score >= 0.7 AND NOT lacking) THEN score WHEN ({_FILLED}) >= 3 AND NOT ({_WRONG}) THEN greatest(0.7, score) ELSE score END, 6) AS confidence_score FROM sc"))
def _(spark, sf_dir):
    return _until(spark, sf_dir, "route", Config(generic_mode=True)).select(_line(), "status", F.round("confidence_score", 6).alias("confidence_score"))


@query("health_report", O.sql(O.ROUTED, "SELECT count(*) AS total, count_if(status = 'CLEAN')::BIGINT AS clean, count_if(status = 'AI_REQUIRED')::BIGINT AS ai_required, count_if(status = 'REJECTED')::BIGINT AS rejected, round(count_if(status = 'CLEAN') / count(*), 6) AS clean_ratio, round(count_if(status = 'AI_REQUIRED') / count(*), 6) AS ai_ratio, round(count_if(status = 'REJECTED') / count(*), 6) AS rejected_ratio, count_if(status = 'AI_REQUIRED') / count(*) > 0.5 AS warn FROM r"))
def _(spark, sf_dir):
    got = report.health(_until(spark, sf_dir, "route"))
    return got.withColumns({c: F.round(c, 6) for c in ("clean_ratio", "ai_ratio", "rejected_ratio")})


@query("ai_sample_top5", O.sql(O.ROUTED, "SELECT line_no, email, first_name, last_name FROM r WHERE status = 'AI_REQUIRED' ORDER BY line_no LIMIT 5"))
def _(spark, sf_dir):
    return report.first_repairs(_until(spark, sf_dir, "route")).select(_line(), *(F.col("clean")[f].alias(f) for f in ("email", "first_name", "last_name")))


@query("status_by_segment", O.sql(O.ROUTED, "SELECT company, status, count(*) AS n, round(avg(confidence_score), 6) AS mean_score FROM r GROUP BY company, status"))
def _(spark, sf_dir):
    rows = _until(spark, sf_dir, "route").select(F.col("clean")["company"].alias("company"), "status", "confidence_score")
    return rows.groupBy("company", "status").agg(F.count("*").alias("n"), F.round(F.avg("confidence_score"), 6).alias("mean_score"))


# -- rules -------------------------------------------------------------------------------------------------------------

_S = O.strip
_EXISTS = f"lower({_S("coalesce({c}, '')")}) NOT IN {O.inlist(values.RULE_NULLS)}"
_DIGITS = rf"length(regexp_replace({_S("coalesce({c}, '')")}, '\D', '', 'g'))"
_PHONE = f"({_S("coalesce({c}, '')")} <> '' AND CASE WHEN starts_with({_S("coalesce({c}, '')")}, '+') THEN {_DIGITS} >= 7 ELSE {_DIGITS} BETWEEN 7 AND 15 END)"
_EMAIL = f"regexp_matches({_S("coalesce({c}, '')")}, '{values.EMAIL}')"
_ONEOF = f"lower({_S("coalesce({c}, 'nan')")}) IN {{v}}"


def _rule(name: str, text: str, where: str):
    @query(name, O.sql(_LEADS, f"SELECT line_no FROM leads WHERE {where}"))
    def _(spark, sf_dir):
        return rules.apply(leads(spark, sf_dir), rules.parse(text)).select("line_no")


_rule("rule_existence", "Column[last_name] == True\nColumn[company] == True", _EXISTS.replace("{c}", "last_name") + " AND " + _EXISTS.replace("{c}", "company"))
_rule("rule_valid_phone", "column[phone] == valid", _PHONE.replace("{c}", "phone"))
_rule("rule_valid_email", "# mail\nColumn[email] == Valid", _EMAIL.replace("{c}", "email"))
_rule("rule_exact", 'Column[job_title] == "HEAD OF HR"', _ONEOF.replace("{c}", "job_title").replace("{v}", "('head of hr')"))
_rule("rule_multi_or", 'Column[company] == "BUILDING" OR "machinery"', _ONEOF.replace("{c}", "company").replace("{v}", "('building', 'machinery')"))
_CHAIN = 'Column[email] == Valid\nColumn[phone] == Valid\nColumn[last_name] == True\nColumn[company] == "BUILDING" OR "MACHINERY"'
_CONDS = [_EMAIL.replace("{c}", "email"), _PHONE.replace("{c}", "phone"), _EXISTS.replace("{c}", "last_name"), _ONEOF.replace("{c}", "company").replace("{v}", "('building', 'machinery')")]


@query("rule_chain_counts", O.sql(_LEADS, " UNION ALL ".join(f"SELECT {i + 1} AS rule_no, {O.q(line)} AS rule, count_if({' AND '.join([*_CONDS[:i], f'NOT ({c})'])})::BIGINT AS dropped FROM leads" for i, (line, c) in enumerate(zip(_CHAIN.split("\n"), _CONDS)))))
def _(spark, sf_dir):
    return rules.drop_counts(leads(spark, sf_dir), rules.parse(_CHAIN))


# -- typing and headers ------------------------------------------------------------------------------------------------


@query("infer_column_types", "SELECT * FROM (VALUES ('a', 'email'), ('b', 'currency'), ('c', 'date'), ('mobile', 'phone'), ('title', 'job_title'), ('who', 'none')) AS t(column_name, kind)")
def _(spark, sf_dir):
    orders = _table(spark, sf_dir, "orders")
    rows = orders.select(F.concat(F.lit("u"), F.col("o_custkey").cast("string"), F.lit("@corp.net")).alias("a"), F.round("o_totalprice", 2).cast("decimal(18,2)").cast("string").alias("b"), F.date_format("o_orderdate", "yyyy-MM-dd").alias("c"), F.lit("x").alias("mobile"), F.lit("y").alias("title"), F.lit("some words here").alias("who"), F.col("o_orderkey").cast("long").alias(LINE))
    kinds = infer.column_types(rows)
    return spark.createDataFrame([(c, kinds.get(c, "none")) for c in rows.columns if c != LINE], "column_name string, kind string")


@query("dedup_columns", "SELECT * FROM (VALUES (0, 'name'), (1, 'name_1'), (2, 'e_mail'), (3, 'name_2')) AS t(i, column_name)")
def _(spark, sf_dir):
    names = infer.unique_names([infer.normal_header(n) for n in ["Name", " name ", "E Mail", "NAME"]])
    return spark.createDataFrame(list(enumerate(names)), "i int, column_name string")


@query("line_numbers", "SELECT count(*) AS n, min(l) AS first, max(l) AS last, count(DISTINCT l) AS distinct_lines FROM (SELECT row_number() OVER () AS l FROM lineitem)")
def _(spark, sf_dir):
    rows = tables.with_lines(_table(spark, sf_dir, "lineitem").select("l_orderkey"))
    return rows.agg(F.count("*").alias("n"), F.min(LINE).alias("first"), F.max(LINE).alias("last"), F.count_distinct(LINE).alias("distinct_lines"))


# -- repair ------------------------------------------------------------------------------------------------------------

_REPLIES = ['{"email": "clean@example.com", "phone": "123-456-7890"}', "NOT JSON", '```json\n{"job": "Boss"}\n```', '```\n{"mail": "a@b.co"}\n```', 'Sure. {"first": "Ann"} Input: {"x": 1}', "[1, 2]", "null", "{}", "```json\n{bad}\n```", '{"company": "Acme", "extra": "1"} trailing']
_VERDICTS = ["OBJECT", "INVALID_FORMAT", "OBJECT", "OBJECT", "OBJECT", "INVALID_FORMAT", "INVALID_FORMAT", "OBJECT", "INVALID_FORMAT", "OBJECT"]
_VALUES = [("email", "clean@example.com"), ("phone", "123-456-7890")], [], [("job_title", "Boss")], [("email", "a@b.co")], [("first_name", "Ann")], [], [], [], [], [("company", "Acme"), ("extra", "1")]


def _replies(spark):
    return spark.createDataFrame(list(enumerate(_REPLIES)), "id int, reply string")


@query("semantic_parse_replies", "SELECT * FROM (VALUES " + ", ".join(f"({i}, '{v}')" for i, v in enumerate(_VERDICTS)) + ") AS t(id, verdict)")
def _(spark, sf_dir):
    return _replies(spark).select("id", semantic.verdict(F.col("reply")).alias("verdict"))


@query("semantic_key_alias", "SELECT * FROM (VALUES " + ", ".join(f"({i}, '{k}', '{v}')" for i, kv in enumerate(_VALUES) for k, v in kv) + ") AS t(id, name, value)")
def _(spark, sf_dir):
    rows = _replies(spark).where(semantic.verdict(F.col("reply")) == "OBJECT")
    return rows.select("id", F.explode(semantic.reply_map(F.col("reply"))).alias("name", "value"))


@query("semantic_merge_policy", "SELECT n_nationkey, CASE WHEN n_nationkey % 5 = 0 THEN n_name WHEN n_nationkey % 5 IN (1, 2) THEN n_name WHEN n_nationkey % 5 = 3 THEN 'new' ELSE n_name END AS company, CASE WHEN n_nationkey % 5 = 2 THEN 'Not Provided' WHEN n_nationkey % 5 = 3 THEN 'new' ELSE n_name END AS phone, CASE WHEN n_nationkey % 2 = 0 THEN n_name || '@x.io' WHEN n_nationkey % 5 = 3 THEN 'new' ELSE n_name END AS email FROM nation")
def _(spark, sf_dir):
    k = F.col("n_nationkey") % 5
    new = F.when(k == 0, F.lit(None).cast("string")).when(k == 1, " ").when(k == 2, "Not Provided").when(k == 3, "new")
    answer = F.when(k == 4, F.create_map().cast("map<string,string>")).otherwise(F.create_map(F.lit("company"), new, F.lit("phone"), new, F.lit("email"), new))
    old = F.col("n_name")
    mail = F.when(F.col("n_nationkey") % 2 == 0, F.concat(old, F.lit("@x.io"))).otherwise(old)
    rows = _table(spark, sf_dir, "nation").select("n_nationkey", "n_name", answer.alias("m"), mail.alias("mail"))
    return rows.select("n_nationkey", semantic.merged("company", old, F.col("m")).alias("company"), semantic.merged("phone", old, F.col("m")).alias("phone"), semantic.merged("email", F.col("mail"), F.col("m")).alias("email"))


@query("semantic_null_resolver", O.sql(O.REPAIRED, "SELECT line_no, status, failure_reason, round(confidence_score, 6) AS confidence_score, email, phone FROM x"))
def _(spark, sf_dir):
    return _until(spark, sf_dir, "repair").select(_line(), "status", "failure_reason", F.round("confidence_score", 6).alias("confidence_score"), F.col("clean")["email"].alias("email"), F.col("clean")["phone"].alias("phone"))


# -- merge and verify --------------------------------------------------------------------------------------------------


@query("reject_empty_names", O.sql(O.DONE, "SELECT line_no, first_name, last_name FROM z WHERE failure_reason = 'EMPTY_NAME'"))
def _(spark, sf_dir):
    done = _until(spark, sf_dir, "finish").where(F.col("failure_reason") == "EMPTY_NAME")
    return done.select(_line(), F.col("clean")["first_name"].alias("first_name"), F.col("clean")["last_name"].alias("last_name"))


@query("stragglers", O.sql(O.ROUTED, f"SELECT line_no, CASE WHEN status = 'CLEAN' AND coalesce(first_name, '') IN ('', {O.q(O.P)}) AND coalesce(last_name, '') IN ('', {O.q(O.P)}) THEN 'EMPTY_NAME' WHEN status = 'AI_REQUIRED' THEN 'UNFINISHED_PROCESSING' ELSE failure_reason END AS failure_reason FROM r"))
def _(spark, sf_dir):
    return _until(spark, sf_dir, "finish", Config(repair=False)).select(_line(), "failure_reason")


@query("verify_conservation", O.sql(O.DONE, "SELECT count(*) AS n_input, count_if(status = 'CLEAN')::BIGINT AS n_final, count_if(status = 'REJECTED')::BIGINT AS n_rejected, 0::BIGINT AS n_overlap, 0::BIGINT AS n_missing, 0::BIGINT AS n_ghost FROM z"))
def _(spark, sf_dir):
    done = _until(spark, sf_dir, "finish")
    return merge.conservation(done.select("row_id"), done.where("status = 'CLEAN'"), done.where("status = 'REJECTED'"))


@query("verify_set_operations", "SELECT (SELECT count(*) FROM (SELECT c_custkey FROM customer INTERSECT SELECT o_custkey FROM orders)) AS overlap, (SELECT count(*) FROM (SELECT c_custkey FROM customer EXCEPT SELECT o_custkey FROM orders)) AS missing, (SELECT count(*) FROM (SELECT o_custkey FROM orders EXCEPT SELECT c_custkey FROM customer)) AS ghosts")
def _(spark, sf_dir):
    ids = _table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("row_id"))
    out = _table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("row_id")).distinct()
    got = merge.conservation(ids, out, ids.limit(0))
    return got.select((F.col("n_input") - F.col("n_missing")).alias("overlap"), F.col("n_missing").alias("missing"), F.col("n_ghost").alias("ghosts"))


_FINAL = "row_id, first_name, last_name, email, phone, job_title AS position, company, join_date, salary"


@query("flatten_clean", O.sql(O.DONE, f"SELECT {_FINAL} FROM z WHERE status = 'CLEAN'"))
def _(spark, sf_dir):
    return pipeline.outputs(_until(spark, sf_dir, "finish"))[0].drop(LINE)


@query("flatten_rejected", O.sql(O.DONE, f"SELECT {_FINAL}, round(confidence_score, 6) AS confidence_score, failure_reason, 'run' AS run_id, status, {', '.join(f'raw_{f}' for f in FIELDS)} FROM z WHERE status = 'REJECTED'"))
def _(spark, sf_dir):
    return pipeline.outputs(_until(spark, sf_dir, "finish"))[1].drop(LINE).withColumn("confidence_score", F.round("confidence_score", 6))


@query("prune_empty_columns", "SELECT n_nationkey, n_name FROM nation")
def _(spark, sf_dir):
    rows = _table(spark, sf_dir, "nation").select("n_nationkey", "n_name", F.lit(O.P).alias("a"), F.lit(" ").alias("b"), F.lit(None).cast("string").alias("c"), F.lit("NaN").alias("d"))
    return merge.prune(rows)


@query("restore_integers", "SELECT c_custkey, CAST(c_nationkey AS BIGINT) AS whole, CAST(c_acctbal AS DOUBLE) AS part FROM customer")
def _(spark, sf_dir):
    rows = _table(spark, sf_dir, "customer").select("c_custkey", F.col("c_nationkey").cast("double").alias("whole"), F.col("c_acctbal").cast("double").alias("part"))
    return merge.restore_integers(rows)


# -- ledger and audit --------------------------------------------------------------------------------------------------

_VALUE_ROWS = " UNION ALL ".join(
    part
    for f in FIELDS
    for part in (
        f"SELECT row_id || ':{f}' AS item_id, 'MISSING' AS reason, coalesce(raw_{f}, 'nan') AS original, coalesce(CAST({f} AS VARCHAR), 'None') AS new FROM z WHERE {O.missing(f'raw_{f}')} AND {O.strip(f'coalesce(raw_{f}, {O.q('nan')})')} <> {O.strip(f'coalesce(CAST({f} AS VARCHAR), {O.q('None')})')}",
        f"SELECT row_id || ':{f}', 'INVALID', coalesce(raw_{f}, 'nan'), coalesce(CAST({f} AS VARCHAR), 'None') FROM z WHERE st_{f} IN ('INVALID', 'ERROR')",
    )
)


@query("ledger_values", O.sql(O.DONE, f"SELECT * FROM ({_VALUE_ROWS})"))
def _(spark, sf_dir):
    rows = ledger.values_rejected(_until(spark, sf_dir, "finish"))
    return rows.select("item_id", "reason", *(F.get_json_object("details", f"$.{k}").alias(k) for k in ("original", "new")))


@query("ledger_rows", O.sql(O.DONE, "SELECT 'run' AS run_id, 'ROW_REJECTED' AS type, row_id AS item_id, failure_reason AS reason, email FROM z WHERE status = 'REJECTED'"))
def _(spark, sf_dir):
    return ledger.rows_rejected(_until(spark, sf_dir, "finish")).select("run_id", "type", "item_id", "reason", F.get_json_object("details", "$.clean.email").alias("email"))


@query("ledger_columns", "SELECT 'run' AS run_id, 'COLUMN_REJECTED' AS type, item_id, 'Entirely empty or Not Provided' AS reason FROM (VALUES ('a'), ('b')) AS t(item_id)")
def _(spark, sf_dir):
    rows = _table(spark, sf_dir, "region").select("r_name", F.lit("").alias("a"), F.lit("none").alias("b"))
    return ledger.columns_rejected(spark, "run", merge.empty_columns(rows), O.P).drop("details")


_AUDIT = "SELECT row_id, 'ROW_PROCESSED' AS action FROM z UNION ALL SELECT row_id, 'DUPLICATE_DETECTED' FROM z WHERE is_duplicate UNION ALL SELECT duplicate_of, 'ROW_ENRICHED' FROM z WHERE filled > 0 UNION ALL SELECT duplicate_of, 'ROW_UPDATED_FROM_NEWER' FROM z WHERE updated > 0 UNION ALL SELECT row_id, 'ROW_RESOLVED' FROM r WHERE status = 'AI_REQUIRED' UNION ALL SELECT row_id, 'EMPTY_NAME_REJECTION' FROM z WHERE failure_reason = 'EMPTY_NAME'"


@query("audit_events", O.sql(O.DONE, _AUDIT))
def _(spark, sf_dir):
    return ledger.audit(_until(spark, sf_dir, "finish")).select("row_id", "action")


@query("action_counts", O.sql(O.DONE, f"SELECT action, count(*) AS n FROM ({_AUDIT}) GROUP BY action"))
def _(spark, sf_dir):
    return report.action_counts(ledger.audit(_until(spark, sf_dir, "finish")))


# -- readers and sinks --------------------------------------------------------------------------------------------------

_NULLED = ", ".join(f"CASE WHEN {f} NOT IN {O.inlist(values.CSV_NULLS)} THEN {f} END AS {f}" for f in FIELDS)


def _round_trip(spark, rows):
    """Rows written as one CSV file under the shared folder, and read again."""
    path = f"{pipeline.shared_folder(spark)}/tidewright/csv-{uuid.uuid4().hex}.csv"
    return tables.read_csv(spark, sinks.write_csv(rows, path))


@query("csv_round_trip", O.sql(_LEADS, f"SELECT line_no, {_NULLED} FROM leads"))
def _(spark, sf_dir):
    return _round_trip(spark, lined(spark, sf_dir)).withColumnRenamed(LINE, "line_no")


@query("csv_output_order", O.sql(O.DONE, "SELECT row_number() OVER (ORDER BY line_no) AS line_no, row_id, position FROM (SELECT line_no, row_id, job_title AS position FROM z WHERE status = 'CLEAN')"))
def _(spark, sf_dir):
    final = pipeline.outputs(_until(spark, sf_dir, "finish"))[0]
    return _round_trip(spark, final.select("row_id", "position", LINE)).select(F.col(LINE).alias("line_no"), "row_id", "position")


# a canonical name beside the header that was found has only what a normaliser made
_HEADERS = {"first_name": "fname", "last_name": "surname", "email": "mail", "phone": "tel", "job_title": "role", "company": "company", "join_date": "join_date", "salary": "salary"}


@query("clean_alias_headers", O.sql(O.CLEAN, "SELECT line_no, " + ", ".join(f"{'v' if f in values.CANONICAL else 'c'}_{f} AS {f}" for f in FIELDS) + ", c_email AS mail, c_phone AS tel FROM p1"))
def _(spark, sf_dir):
    rows = lined(spark, sf_dir).withColumnsRenamed(_HEADERS)
    done = clean(rows, infer.column_types(rows))
    return done.select(_line(), *(F.col("clean")[f].alias(f) for f in [*FIELDS, "mail", "tel"]))


# -- security ----------------------------------------------------------------------------------------------------------

# a file a page, whose name and first bytes depend on its number
_KIND = "page_id % 8"
_GATE = f"""SELECT page_id, CASE {_KIND} WHEN 0 THEN '.exe' WHEN 1 THEN '.txt' WHEN 2 THEN '.db' WHEN 3 THEN '.DOCX' ELSE '.csv' END AS ext,
  CASE {_KIND} WHEN 2 THEN concat('SQLite format 3', chr(0), 'x') WHEN 3 THEN concat('PK', chr(3), chr(4), 'zz') WHEN 4 THEN concat('a,b', chr(0)) WHEN 5 THEN concat('=cmd|', page_id::VARCHAR)
    WHEN 6 THEN repeat('x', 2000) ELSE 'a,b' END AS body FROM pages"""


@query("file_gate_branches", f"""SELECT page_id, CASE WHEN {_KIND} = 6 THEN 'FILE_SIZE_EXCEEDED' WHEN {_KIND} = 0 THEN 'HAZARDOUS_FILE_DETECTED' WHEN {_KIND} = 1 THEN 'UNSUPPORTED_FILE_TYPE' WHEN {_KIND} = 4 THEN 'INVALID_FILE_SIGNATURE'
  WHEN {_KIND} = 5 THEN 'DANGEROUS_PATTERN_DETECTED' WHEN {_KIND} = 3 THEN 'INVALID_DOCX' ELSE 'OK' END AS verdict, octet_length(encode(body))::BIGINT AS length, sha256(body) AS sha256 FROM ({_GATE})""")
def _(spark, sf_dir):
    rows = spark.sql(_GATE.replace("chr(0)", "char(0)").replace("::VARCHAR", "::STRING").replace("FROM pages", "FROM {pages}"), pages=_table(spark, sf_dir, "pages"))
    files = rows.select(F.concat(F.lit("/in/"), F.col("page_id").cast("string"), F.col("ext")).alias("path"), F.col("body").cast("binary").alias("content")).withColumn("length", F.length("content").cast("long"))
    got = security.verdicts(files, Config(max_file_bytes=1000))
    return got.select(F.regexp_extract("path", r"(\d+)\.", 1).cast("long").alias("page_id"), F.substring_index("verdict", ":", 1).alias("verdict"), "length", "sha256")


_SIGNED = "SELECT c_custkey, concat(CASE c_custkey % 6 WHEN 0 THEN '=' WHEN 1 THEN ' +' WHEN 2 THEN '-' WHEN 3 THEN '@' ELSE '' END, c_name) AS x FROM customer"


def _signed(spark, sf_dir):
    k = F.col("c_custkey") % 6
    return _table(spark, sf_dir, "customer").select("c_custkey", F.concat(F.when(k == 0, "=").when(k == 1, " +").when(k == 2, "-").when(k == 3, "@").otherwise(""), "c_name").alias("x"))


@query("csv_injection_neutralise", rf"SELECT c_custkey, CASE WHEN regexp_matches(x, '^\s*[=+\-@]') THEN '''' || x ELSE x END AS x FROM ({_SIGNED})")
def _(spark, sf_dir):
    return security.neutralise_all(_signed(spark, sf_dir))


@query("csv_injection_count", rf"SELECT count_if(regexp_matches(x, '^\s*[=+\-@]'))::BIGINT AS dangerous_cells FROM ({_SIGNED})")
def _(spark, sf_dir):
    return security.dangerous_cells(_signed(spark, sf_dir), ["x"])


_ASCII = [p.decode("latin-1") for p in values.BYTE_PATTERNS]
_FIRST = "CASE " + " ".join(f"WHEN contains(html, {'chr(127) || ' + O.q(p[1:]) if p[0] == chr(127) else O.q(p)}) THEN {'chr(127) || ' + O.q(p[1:]) if p[0] == chr(127) else O.q(p)}" for p in _ASCII) + " END"


@query("malware_scan_pages", f"SELECT page_id, {_FIRST} AS pattern FROM pages")
def _(spark, sf_dir):
    return _table(spark, sf_dir, "pages").select("page_id", security.first_byte_pattern(F.col("html").cast("binary")).alias("pattern"))


_TEXT = "CASE " + " ".join(f"WHEN contains(lower(text), lower({O.q(p)})) THEN {O.q(p)}" for p in values.TEXT_PATTERNS) + " END"


@query("dangerous_text_scan", f"SELECT doc_id, {_TEXT} AS pattern FROM documents")
def _(spark, sf_dir):
    return _table(spark, sf_dir, "documents").select("doc_id", security.first_text_pattern(F.col("text")).alias("pattern"))


@query("file_gate_verdicts", f"SELECT page_id, CASE WHEN p IS NULL THEN 'OK' ELSE 'MALWARE_PATTERN_DETECTED: ' || p END AS verdict, sha256(html) AS sha256 FROM (SELECT page_id, html, {_FIRST} AS p FROM pages)")
def _(spark, sf_dir):
    files = _table(spark, sf_dir, "pages").select("page_id", F.concat(F.lit("/in/"), F.col("page_id").cast("string"), F.lit(".csv")).alias("path"), F.col("html").cast("binary").alias("content")).withColumn("length", F.length("content").cast("long"))
    got = security.verdicts(files).withColumn("page_id", F.regexp_extract("path", r"(\d+)\.csv$", 1).cast("long"))
    return got.select("page_id", "verdict", "sha256")


@query("file_hash", "SELECT doc_id, md5(text) AS md5, sha256(text) AS sha256 FROM documents")
def _(spark, sf_dir):
    h = security.hashes(F.col("text"))
    return _table(spark, sf_dir, "documents").select("doc_id", h["md5"].alias("md5"), h["sha256"].alias("sha256"))


@query("blocklist_probe", "SELECT doc_id FROM documents WHERE sha256(text) IN (SELECT sha256(text) FROM documents WHERE doc_id < 10)")
def _(spark, sf_dir):
    docs = _table(spark, sf_dir, "documents").select("doc_id", F.col("text").alias("content"))
    known = docs.where("doc_id < 10").select(F.sha2(F.col("content").cast("binary"), 256).alias("sha256")).distinct()
    return security.blocked(docs, known).select("doc_id")


# -- generators --------------------------------------------------------------------------------------------------------


@query("generate_messy")
def _(spark, sf_dir):
    return generators.messy_records(spark, 1000, seed=999)


@query("generate_adversarial")
def _(spark, sf_dir):
    return generators.adversarial_records(spark)


@query("clean_generated")
def _(spark, sf_dir):
    rows = tables.with_lines(generators.messy_records(spark, 200, seed=7))
    done = pipeline.records(rows)
    return done.groupBy("status", "failure_reason").agg(F.count("*").alias("n"))
