"""DuckDB SQL that says the same as the operators, built up as a chain of common table expressions."""

from __future__ import annotations

from .. import values
from ..functions.text import emoji_class
from .leads import FIELDS, LEADS

P = values.PLACEHOLDER


def q(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def inlist(xs: list[str]) -> str:
    return "(" + ", ".join(map(q, xs)) + ")"


def strip(x: str) -> str:
    return rf"regexp_replace({x}, '^\s+|\s+$', '', 'g')"


def emoji(x: str) -> str:
    return f"regexp_replace({x}, '[{emoji_class()}]+', '', 'g')"


def squeeze(x: str) -> str:
    return strip(rf"regexp_replace({x}, '\s+', ' ', 'g')")


def unquote(x: str) -> str:
    s = strip(x)
    return f"(CASE WHEN starts_with({s}, '''') AND length({s}) > 1 THEN {strip(f'substr({s}, 2)')} ELSE {s} END)"


def missing(x: str) -> str:
    return f"({x} IS NULL OR lower({unquote(x)}) IN {inlist(values.MISSING)})"


def sanitized(x: str, name: str) -> str:
    stand_in = "NULL" if any(w in name for w in values.NUMERIC_WORDS) and name not in values.PLACEHOLDER_FIELDS else q(P)
    return f"(CASE WHEN {missing(x)} THEN {stand_in} ELSE {unquote(strip(emoji(x)))} END)"


def cap(w: str) -> str:
    return f"(upper({w}[1]) || lower({w}[2:]))"


def title(x: str) -> str:
    return rf"array_to_string(list_transform(regexp_extract_all({x}, '(\p{{L}}+|[^\p{{L}}]+)'), lambda w: {cap('w')}), '')"


def _honorifics(x: str) -> str:
    for h in values.HONORIFICS_STOP:
        x = rf"regexp_replace({x}, '(?i)\b{h}\.?\s*', '', 'g')"
    for h in values.HONORIFICS_SPACE:
        x = rf"regexp_replace({x}, '(?i)\b{h}\s+', '', 'g')"
    return x


def _acronyms(x: str) -> str:
    for a in values.ACRONYMS:
        x = rf"regexp_replace({x}, '(?i)\b{a}\b', '{a}', 'g')"
    return x


ROW_ID = "(SELECT concat_ws('-', h[1:8], h[9:12], h[13:16], h[17:20], h[21:32]) FROM (SELECT sha256('run:' || CAST(line_no AS VARCHAR)) AS h))"
EXT = r"(?:ext\.?|extension|x)\s*"

#: Normalised values: v_* and st_* of each typed column.
_STEP1 = rf"""
leads AS ({LEADS}),
a AS (SELECT *,
  regexp_replace(lower({strip(emoji('email'))}), '\s+', '', 'g') AS e,
  regexp_replace({strip(emoji('phone'))}, '^[''"]+', '') AS ph,
  {_honorifics(squeeze(emoji('first_name')))} AS f0, {_honorifics(squeeze(emoji('last_name')))} AS l0,
  {squeeze(emoji('job_title'))} AS j0, upper({strip('salary')}) AS s0 FROM leads),
b AS (SELECT *,
  regexp_extract(ph, '(?i){EXT}(\d+)', 1) AS ext,
  regexp_replace(regexp_replace(ph, '(?is){EXT}\d+.*$', ''), '\D', '', 'g') AS dg,
  {title(squeeze("regexp_replace(regexp_replace(f0, '\"[^\"]*\"', '', 'g'), '\\([^)]*\\)', '', 'g')"))} AS f1,
  {title(squeeze("regexp_replace(regexp_replace(l0, '\"[^\"]*\"', '', 'g'), '\\([^)]*\\)', '', 'g')"))} AS l1,
  array_to_string(list_transform(string_split(j0, ' '), lambda w, i: CASE WHEN i > 1 AND lower(w) IN {inlist(values.SMALL_WORDS)} THEN lower(w) ELSE {cap('w')} END), ' ') AS j1,
  TRY_CAST(regexp_extract(s0, '(-?\d+(?:\.\d+)?)', 1) AS DOUBLE) * (CASE WHEN contains(s0, 'K') THEN 1e3 WHEN contains(s0, 'M') THEN 1e6 WHEN contains(s0, 'B') THEN 1e9 ELSE 1.0 END) AS v_salary0
  FROM a),
c AS (SELECT *, CASE WHEN length(dg) = 11 AND starts_with(dg, '1') THEN substr(dg, 2) ELSE dg END AS d FROM b),
n AS (SELECT *,
  CASE WHEN {missing('email')} THEN 'MISSING' WHEN regexp_matches(e, '{values.EMAIL}') THEN 'VALID' ELSE 'INVALID' END AS st_email,
  CASE WHEN {missing('phone')} THEN 'MISSING' WHEN length(d) IN (7, 10) THEN 'VALID' WHEN length(d) = 0 THEN 'MISSING' ELSE 'INVALID' END AS st_phone,
  {{names}},
  CASE WHEN {missing('job_title')} THEN 'MISSING' ELSE 'VALID' END AS st_job_title,
  CASE WHEN {missing('company')} THEN 'MISSING' ELSE 'VALID' END AS st_company,
  CASE WHEN {missing('join_date')} THEN 'MISSING' WHEN TRY_CAST(join_date AS DATE) IS NOT NULL THEN 'VALID' ELSE 'INVALID' END AS st_join_date,
  CASE WHEN {missing('salary')} THEN 'MISSING' WHEN v_salary0 IS NULL THEN 'ERROR' ELSE 'VALID' END AS st_salary,
  {_acronyms('j1')} AS j2 FROM c),
v AS (SELECT line_no, first_name, last_name, email, phone, job_title, company, join_date, salary,
  st_first_name, st_last_name, st_email, st_phone, st_job_title, st_company, st_join_date, st_salary,
  CASE st_first_name WHEN 'VALID' THEN f1 WHEN 'INVALID' THEN first_name END AS v_first_name,
  CASE st_last_name WHEN 'VALID' THEN l1 WHEN 'INVALID' THEN last_name END AS v_last_name,
  CASE st_email WHEN 'VALID' THEN e WHEN 'INVALID' THEN email END AS v_email,
  CASE WHEN {missing('phone')} THEN NULL WHEN length(d) = 10 THEN concat(d[1:3], '-', d[4:6], '-', d[7:10], CASE WHEN ext <> '' THEN ' x' || ext ELSE '' END)
       WHEN length(d) = 7 THEN concat(d[1:3], '-', d[4:7], CASE WHEN ext <> '' THEN ' x' || ext ELSE '' END) ELSE {q(P)} END AS v_phone,
  CASE st_job_title WHEN 'VALID' THEN j2 END AS v_job_title,
  CASE st_company WHEN 'VALID' THEN {strip('company')} END AS v_company,
  CASE st_join_date WHEN 'VALID' THEN strftime(TRY_CAST(join_date AS DATE), '%Y-%m-%d') WHEN 'INVALID' THEN join_date END AS v_join_date,
  CASE st_salary WHEN 'VALID' THEN v_salary0 END AS v_salary FROM n)"""


def _name_status(raw: str, x0: str, x1: str, last: bool) -> str:
    titled = " OR ".join(f"contains(upper({strip(f"regexp_extract({x0}, '\\(([^)]+)\\)', 1)")}), {q(t)})" for t in values.TITLES_IN_NAMES)
    short = rf"WHEN length(regexp_replace({x1}, '\.+$', '')) <= 2 THEN 'INVALID' " if last else ""
    return rf"CASE WHEN {missing(raw)} THEN 'MISSING' WHEN {titled} THEN 'INVALID' WHEN regexp_matches({x1}, '[\d()]') THEN 'INVALID' {short}WHEN length({x1}) < 2 THEN 'INVALID' ELSE 'VALID' END AS st_{raw}"


NORMAL = _STEP1.replace("{names}", _name_status("first_name", "f0", "f1", False) + ",\n  " + _name_status("last_name", "l0", "l1", True))

#: Clean values c_*.
CLEAN = (
    NORMAL
    + ",\np1 AS (SELECT *, "
    + f"{ROW_ID} AS row_id, "
    + ", ".join((f"coalesce(v_{f}, {sanitized(f, f)}) AS c_{f}" if f != "salary" else "v_salary AS c_salary") for f in FIELDS)
    + " FROM v)"
)


def _part(label: str) -> str:
    return f"CASE WHEN lower({strip(f'c_{label}')}) <> '' THEN '{label}:' || lower({strip(f'c_{label}')}) END"


KEYS = {
    "email_only": f"coalesce({_part('email')}, 'row_id:' || row_id)",
    "phone_only": f"coalesce({_part('phone')}, 'row_id:' || row_id)",
    "composite": f"concat_ws('|', {_part('email')}, {_part('first_name')}, {_part('last_name')})",
}


def marked(strategy: str = "composite", key: str | None = None) -> str:
    return (
        CLEAN
        + f""",
k AS (SELECT *, sha256({key or KEYS[strategy]}) AS fingerprint FROM p1),
m AS (SELECT *, row_number() OVER w > 1 AS is_duplicate, CASE WHEN row_number() OVER w > 1 THEN first_value(row_id) OVER w END AS duplicate_of,
      first_value(TRY_CAST(c_join_date AS DATE)) OVER w AS owner_date, row_number() OVER w AS rn FROM k WINDOW w AS (PARTITION BY fingerprint ORDER BY line_no))"""
    )


def _survivor(f: str) -> str:
    newer = "TRY_CAST(c_join_date AS DATE) > owner_date"
    if f == "salary":
        return f"coalesce(max_by(c_{f}, line_no) FILTER (WHERE rn > 1 AND c_{f} <> 0 AND {newer}), max(c_{f}) FILTER (WHERE rn = 1), min_by(c_{f}, line_no) FILTER (WHERE rn > 1 AND c_{f} <> 0)) AS g_{f}"
    update = f"max_by(c_{f}, line_no) FILTER (WHERE rn > 1 AND c_{f} <> '' AND {newer}), " if f in values.MUTABLE else ""
    return f"coalesce({update}max(nullif(c_{f}, '')) FILTER (WHERE rn = 1), min_by(c_{f}, line_no) FILTER (WHERE rn > 1 AND c_{f} <> ''), max(c_{f}) FILTER (WHERE rn = 1)) AS g_{f}"


_SAYS = {f: f"c_{f} <> 0" if f == "salary" else f"c_{f} <> ''" for f in FIELDS}
_FILLS = {f: f"coalesce(gap_{f} AND line_no = first_{f}, false)" for f in FIELDS}
#: What each duplicate gave its keeper, beside the marks.
GIVEN = (
    marked().replace("\nm AS (", "\nm0 AS (")
    + ",\nm1 AS (SELECT *, "
    + ", ".join(f"coalesce({'first_value(c_salary) OVER w IS NULL' if f == 'salary' else f'first_value(c_{f}) OVER w = {q("")} OR first_value(c_{f}) OVER w IS NULL'}, true) AS gap_{f}, min(CASE WHEN rn > 1 AND {_SAYS[f]} THEN line_no END) OVER (PARTITION BY fingerprint) AS first_{f}" for f in FIELDS)
    + " FROM m0 WINDOW w AS (PARTITION BY fingerprint ORDER BY line_no)),\nm AS (SELECT *, "
    + " + ".join(f"CASE WHEN rn > 1 AND {_FILLS[f]} THEN 1 ELSE 0 END" for f in FIELDS)
    + " AS filled, "
    + " + ".join(f"CASE WHEN rn > 1 AND {_SAYS[f]} AND TRY_CAST(c_join_date AS DATE) > owner_date AND NOT {_FILLS[f]} THEN 1 ELSE 0 END" for f in FIELDS if f in values.MUTABLE)
    + " AS updated FROM m1)"
)
ENRICHED = (
    GIVEN
    + ",\ng AS (SELECT fingerprint, "
    + ", ".join(map(_survivor, FIELDS))
    + " FROM m GROUP BY fingerprint),\ne2 AS (SELECT m.line_no, m.row_id, m.fingerprint, m.is_duplicate, m.duplicate_of, m.filled, m.updated, "
    + ", ".join(f"m.{f} AS raw_{f}, m.st_{f}" for f in FIELDS)
    + ", "
    + ", ".join(f"CASE WHEN m.is_duplicate THEN m.c_{f} ELSE g.g_{f} END AS {f}" for f in FIELDS)
    + " FROM m JOIN g USING (fingerprint))"
)

_INVALIDS = " ".join(f"- CASE WHEN st_{f} = 'INVALID' THEN 0.5::DOUBLE ELSE 0::DOUBLE END" for f in FIELDS)
_ODD = rf"(regexp_matches(job_title, '[^\x00-\x7F]') OR regexp_matches(job_title, '[/|]') OR regexp_matches(job_title, '(?i)\b({'|'.join(values.BUZZWORDS)})\b'))"
SCORED = (
    ENRICHED
    + f""",
sc AS (SELECT *, greatest(0::DOUBLE, 1::DOUBLE
  - CASE WHEN coalesce(email, '') = '' THEN 0.3::DOUBLE ELSE 0::DOUBLE END - CASE WHEN coalesce(phone, '') = '' THEN 0.1::DOUBLE ELSE 0::DOUBLE END
  {_INVALIDS} - CASE WHEN job_title <> '' AND {_ODD} THEN 0.6::DOUBLE ELSE 0::DOUBLE END) AS score,
  coalesce(email, '') = '' OR coalesce(phone, '') = '' AS lacking FROM e2)"""
)
ROUTED = (
    SCORED
    + """,
r AS (SELECT *, CASE WHEN is_duplicate THEN 'REJECTED' WHEN score >= 0.7 AND NOT lacking THEN 'CLEAN' ELSE 'AI_REQUIRED' END AS status,
  CASE WHEN is_duplicate THEN 'DUPLICATE' END AS failure_reason, CASE WHEN is_duplicate THEN 0::DOUBLE ELSE score END AS confidence_score FROM sc)"""
)
REPAIRED = (
    ROUTED
    + """,
x AS (SELECT * REPLACE (CASE WHEN status = 'AI_REQUIRED' THEN 'CLEAN' ELSE status END AS status, CASE WHEN status = 'AI_REQUIRED' THEN 0.8::DOUBLE ELSE confidence_score END AS confidence_score) FROM r)"""
)
DONE = (
    REPAIRED
    + f""",
z AS (SELECT * REPLACE (CASE WHEN nameless THEN 'REJECTED' ELSE status END AS status, CASE WHEN nameless THEN 'EMPTY_NAME' ELSE failure_reason END AS failure_reason)
  FROM (SELECT *, status = 'CLEAN' AND coalesce(first_name, '') IN ('', {q(P)}) AND coalesce(last_name, '') IN ('', {q(P)}) AS nameless FROM x))"""
)


def sql(chain: str, select: str) -> str:
    return f"WITH {chain.lstrip().lstrip(',')}\n{select}"
