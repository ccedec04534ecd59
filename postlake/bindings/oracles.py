"""DuckDB SQL for the posting queries, written against the given tables.

Each text is a chain of common table expressions that restates the whole flow,
from orders to the table a query needs.
"""

from __future__ import annotations

from postlake import vocabulary as V
from postlake.bindings.tables import AS_OF, SOURCE_NAMES, STACKS, STALE_DAYS, TITLES, YEARS

DAY = f"DATE '{AS_OF}'"


def case(index: str, values) -> str:
    arms = " ".join(f"WHEN {i} THEN '{v}'" for i, v in enumerate(values))
    return f"CASE {index} {arms} END"


def named(column: str, labels, otherwise: str) -> str:
    """The label of a value, from a vocabulary's pairs."""
    arms = " ".join(f"WHEN {value!r} THEN '{label}'" for value, label in labels.items())
    return f"CASE {column} {arms} ELSE '{otherwise}' END"


def bracket(column: str, edges, labels) -> str:
    """The label of the first edge that is not below the value, else the last label."""
    arms = " ".join(f"WHEN {column} <= {edge} THEN '{label}'" for edge, label in zip(edges, labels))
    return f"CASE {arms} ELSE '{labels[-1]}' END"


def whole_words(text: str, terms) -> str:
    return f"regexp_matches(lower({text}), '\\b({'|'.join(terms)})\\b')"


def rounded(value: str, places: int) -> str:
    return f"CAST(round(CAST({value} AS DECIMAL(38,8)), {places}) AS DOUBLE)"


def stamp(column: str) -> str:
    return f"strftime({column}, '%Y-%m-%d %H:%M:%S')"


POSTS = f"""
posts AS (
  SELECT o.o_orderkey AS id, CAST((o.o_orderkey + t.shift) % 5 AS INTEGER) AS src, p.pull,
    {case("(o.o_orderkey + t.shift) % 5", SOURCE_NAMES)} AS source_id,
    CASE WHEN o.o_orderkey % 53 <> 0 THEN c.c_name END AS company,
    CASE WHEN o.o_orderkey % 41 = 0 THEN NULL
         WHEN o.o_orderkey % 37 = 0 THEN '  ' || n.n_name || '   Remote '
         ELSE n.n_name END AS loc,
    {case("o.o_orderkey % 11", TITLES)}
      || CASE WHEN p.pull = 1 AND o.o_orderkey % 29 = 0 THEN ' II' ELSE '' END AS title,
    CASE WHEN o.o_orderkey % 31 <> 0 THEN CAST(o.o_orderdate AS DATE) END AS created,
    CASE WHEN (o.o_orderkey + t.shift) % 5 IN (1, 2) AND o.o_orderkey % 7 = 0
         THEN CAST(o.o_orderdate AS DATE) + 30 END AS closing,
    CASE WHEN o.o_orderkey % 3 <> 0 THEN o.o_totalprice END AS salary_min,
    CASE WHEN o.o_orderkey % 3 <> 0 AND o.o_orderkey % 2 = 0
         THEN o.o_totalprice + CAST(500 AS DOUBLE) END AS salary_max,
    '<p>' || {case("o.o_orderkey % 6", YEARS)} || '</p>  <b>'
      || {case("o.o_orderkey % 4", STACKS)} || '</b>' AS descr,
    CAST(CAST(o.o_orderdate AS DATE)
      + CAST(o.o_orderkey % 20 + p.pull * (1 + o.o_orderkey % 40) AS INTEGER) AS TIMESTAMP) AS seen_at
  FROM orders o
  JOIN customer c ON c.c_custkey = o.o_custkey
  JOIN nation n ON n.n_nationkey = c.c_nationkey
  CROSS JOIN (VALUES (0), (1)) p(pull)
  JOIN (VALUES (0), (1)) t(shift) ON t.shift = 0 OR o.o_orderkey % 23 = 0
)"""


def role_family(title: str) -> str:
    arms = " ".join(f"WHEN {whole_words(title, terms)} THEN '{label}'" for label, terms in V.ROLE_FAMILIES)
    return f"CASE {arms} ELSE '{V.ROLE_DEFAULT}' END"


_PAID = "source_id IN ('adzuna', 'lever', 'rippling')"
NORM = POSTS + f""",
shaped AS (
  SELECT *, source_id || '-' || CAST(id AS VARCHAR) AS posting_id,
    coalesce(company, 'Unknown') AS company_name,
    CASE WHEN src = 4 AND id % 4 = 0 THEN coalesce(loc || ', XX', 'XX') WHEN src = 4 THEN coalesce(loc, '') ELSE loc END AS location_raw,
    'https://' || source_id || '.example/' || CAST(id AS VARCHAR) AS url
  FROM posts
),
placed AS (
  SELECT *, CASE WHEN trim(coalesce(location_raw, '')) = '' THEN 'Unknown'
    ELSE regexp_replace(trim(location_raw), '\\s+', ' ', 'g') END AS location_normalized
  FROM shaped
),
norm AS (
  SELECT posting_id, source_id, company_name, company_name AS display_name, location_raw,
    location_normalized, title AS job_title, {role_family("title")} AS role_family,
    created AS date_posted, closing AS closing_date,
    trim(regexp_replace(regexp_replace(descr, '<[^>]+>', ' ', 'g'), '\\s+', ' ', 'g')) AS description,
    url AS posting_url,
    CASE WHEN src = 2 OR (src = 4 AND id % 2 = 0) THEN url || '/apply' ELSE url END AS apply_url,
    CASE WHEN {_PAID} THEN salary_min END AS salary_min,
    CASE WHEN {_PAID} THEN salary_max END AS salary_max,
    CASE WHEN {_PAID} THEN CASE WHEN id % 2 = 0 THEN 'EUR' ELSE 'USD' END END AS currency,
    CASE src WHEN 0 THEN CASE WHEN id % 2 = 0 THEN 'permanent' ELSE 'full_time' END
      WHEN 2 THEN 'Full-time' WHEN 3 THEN 'SALARIED_FT'
      WHEN 4 THEN CASE WHEN id % 4 <> 0 THEN 'FullTime' END END AS employment_type,
    seen_at, (company IS NULL OR loc IS NULL OR created IS NULL) AS is_incomplete,
    lower(company_name) || '|' || lower(title) || '|' || lower(location_normalized) AS dedup_key
  FROM placed
)"""

CONTENT = ("posting_id, source_id, company_name, display_name, location_raw, location_normalized, "
           "job_title, role_family, date_posted, closing_date, description, posting_url, apply_url, "
           "salary_min, salary_max, currency, employment_type, is_incomplete, dedup_key")

GROUPED = NORM + f""",
grouped AS (
  SELECT {CONTENT}, min(seen_at) AS first_seen_at, max(seen_at) AS last_seen_at
  FROM norm GROUP BY {CONTENT}
)"""
LATEST = GROUPED + """,
latest AS (
  SELECT * EXCLUDE (rn) FROM (
    SELECT *, row_number() OVER (PARTITION BY posting_id
      ORDER BY last_seen_at DESC, first_seen_at DESC) AS rn FROM grouped) WHERE rn = 1
)"""
STAGING = LATEST + """,
staging AS (
  SELECT * EXCLUDE (rn, dedup_key) FROM (
    SELECT *, row_number() OVER (PARTITION BY dedup_key ORDER BY first_seen_at, posting_id) AS rn
    FROM latest) WHERE rn = 1
)"""

STALE = (f"(coalesce(closing_date < {DAY}, false) OR last_seen_at < "
         f"CAST({DAY} - {STALE_DAYS} AS TIMESTAMP))")
FACTS = STAGING + f""",
facts AS (
  SELECT posting_id, md5(lower(company_name)) AS company_id, md5(location_normalized) AS location_id,
    source_id, job_title, role_family, date_posted, closing_date, first_seen_at, last_seen_at,
    is_incomplete
  FROM staging
),
live AS (SELECT * FROM facts WHERE NOT {STALE}),
arch AS (SELECT * FROM facts WHERE {STALE}),
both_ AS (SELECT *, false AS is_archived FROM live UNION ALL SELECT *, true FROM arch),
companies AS (
  SELECT md5(lower(company_name)) AS company_id, min(company_name) AS company_name
  FROM staging GROUP BY 1
),
locations AS (
  SELECT md5(location_normalized) AS location_id, location_normalized, min(location_raw) AS location_raw
  FROM staging GROUP BY location_normalized
)"""


def experience(relation: str, title: str, text: str) -> str:
    """A chain adding the four experience columns to a relation, ending in ``experienced``."""
    def year(pattern):
        return (f"TRY_CAST(nullif(regexp_extract(lower({text}), '{pattern}', 1), '') AS INTEGER)")
    return f"""
found_ AS (
  SELECT *, ({whole_words(title, V.FRESHER_TITLE)} OR {whole_words(text, V.FRESHER_TEXT)}) AS is_fresher,
    {year(V.YEARS_LOW)} AS low_, {year(V.YEARS_HIGH)} AS high_, {year(V.YEARS_SINGLE)} AS single_
  FROM {relation}
),
bounded_ AS (
  SELECT *, CAST(CASE WHEN is_fresher THEN 0 WHEN low_ BETWEEN 0 AND 20 THEN low_
      WHEN single_ BETWEEN 0 AND 20 THEN single_
      WHEN {whole_words(title, V.ASSUMED_SENIOR_TITLE)} THEN 5 END AS INTEGER) AS min_years_exp,
    CAST(CASE WHEN is_fresher THEN 1 WHEN high_ BETWEEN 0 AND 25 THEN high_ END AS INTEGER) AS max_years_exp
  FROM found_
),
experienced AS (
  SELECT * EXCLUDE (low_, high_, single_),
    CASE WHEN is_fresher OR min_years_exp <= 1 THEN 'FRESHER' WHEN min_years_exp <= 2 THEN 'JUNIOR'
      WHEN min_years_exp <= 5 THEN 'MID' WHEN min_years_exp <= 8 THEN 'SENIOR'
      WHEN min_years_exp > 8 THEN 'LEAD'
      WHEN {whole_words(title, V.LEVEL_BY_TITLE[0][1])} THEN 'LEAD'
      WHEN {whole_words(title, V.LEVEL_BY_TITLE[1][1])} THEN 'SENIOR'
      ELSE 'UNSPECIFIED' END AS experience_level
  FROM bounded_
)"""


DETAILS = FACTS + "," + experience("staging", "job_title", "description") + """,
details AS (
  SELECT posting_id, description, posting_url, apply_url, salary_min, salary_max, currency,
    employment_type, last_seen_at, min_years_exp, max_years_exp, is_fresher, experience_level
  FROM experienced
)"""

_SKILL_ROWS = ", ".join(f"('{s}')" for s in V.SKILLS)
MENTIONS_ONLY = f""",
skills AS (SELECT md5(lower(s)) AS skill_id, s AS skill_name FROM (VALUES {_SKILL_ROWS}) v(s)),
mentions AS (
  SELECT DISTINCT p.posting_id, s.skill_id
  FROM staging p CROSS JOIN skills s
  WHERE regexp_matches(lower(p.job_title || ' ' || coalesce(p.description, '')),
                       '\\b' || lower(s.skill_name) || '\\b')
)"""
_KEY = "o_orderkey"
STAR = DETAILS + MENTIONS_ONLY + f""",
applications AS (
  SELECT {case(f"{_KEY} % 5", SOURCE_NAMES)} || '-' || CAST({_KEY} AS VARCHAR) AS posting_id,
    CAST(o_orderdate AS DATE) + 3 AS date_applied,
    {case(f"({_KEY} // 10) % 5", V.APPLICATION_STATUSES)} AS status
  FROM orders WHERE {_KEY} % 10 < 3
),
hidden AS (
  SELECT {case(f"{_KEY} % 5", SOURCE_NAMES)} || '-' || CAST({_KEY} AS VARCHAR) AS posting_id
  FROM orders WHERE {_KEY} % 97 = 0
),
tracker AS (
  SELECT f.posting_id, c.company_name, f.job_title, l.location_normalized AS location, f.date_posted,
    f.closing_date, f.last_seen_at,
    (f.is_archived OR coalesce(f.closing_date < {DAY}, false)
      OR f.last_seen_at < CAST({DAY} - 7 AS TIMESTAMP)) AS is_likely_closed,
    a.date_applied, f.role_family, coalesce(a.status, 'NOT_APPLIED') AS status
  FROM both_ f JOIN companies c USING (company_id)
  LEFT JOIN locations l USING (location_id) LEFT JOIN applications a USING (posting_id)
),
velocity AS (
  SELECT CAST(year(f.date_posted) AS BIGINT) AS year, CAST(month(f.date_posted) AS BIGINT) AS month,
    c.company_name, count(DISTINCT f.posting_id) AS postings_posted
  FROM live f JOIN companies c USING (company_id) GROUP BY 1, 2, 3
),
trend AS (
  SELECT CAST(year(f.date_posted) AS BIGINT) AS year, CAST(month(f.date_posted) AS BIGINT) AS month,
    s.skill_name, count(DISTINCT f.posting_id) AS postings_mentioning_skill
  FROM mentions m JOIN skills s USING (skill_id) JOIN live f USING (posting_id) GROUP BY 1, 2, 3
),
activity AS (
  SELECT c.company_id, c.company_name, count(DISTINCT f.posting_id) AS total_postings,
    count(DISTINCT CASE WHEN f.last_seen_at < CAST({DAY} - 3 AS TIMESTAMP) THEN f.posting_id END)
      AS likely_closed_postings,
    count(DISTINCT CASE WHEN f.last_seen_at >= CAST({DAY} - 3 AS TIMESTAMP) THEN f.posting_id END)
      AS active_postings,
    min(f.first_seen_at) AS earliest_first_seen, max(f.last_seen_at) AS latest_last_seen
  FROM live f JOIN companies c USING (company_id) GROUP BY 1, 2
),
posting_skills AS (
  SELECT m.posting_id, count(DISTINCT s.skill_name) AS matched_skill_count,
    string_agg(s.skill_name, ', ' ORDER BY s.skill_name) AS matched_skills,
    sum(CASE WHEN lower(s.skill_name) IN ('sql', 'python', 'spark', 'dbt', 'databricks')
        THEN 1.5 ELSE 1.0 END) AS points,
    count(DISTINCT CASE WHEN s.skill_name IN ('SQL', 'Python', 'Docker') THEN s.skill_name END) AS wanted_hits
  FROM mentions m JOIN skills s USING (skill_id) GROUP BY 1
),
inputs AS (
  SELECT f.*, c.company_name, l.location_normalized AS location, d.* EXCLUDE (posting_id, last_seen_at),
    coalesce(ps.matched_skills, '') AS matched_skills,
    coalesce(ps.matched_skill_count, 0) AS matched_skill_count, ps.points, ps.wanted_hits,
    (coalesce(f.closing_date < {DAY}, false) OR f.last_seen_at < CAST({DAY} - 7 AS TIMESTAMP))
      AS is_likely_closed
  FROM live f JOIN companies c USING (company_id) LEFT JOIN locations l USING (location_id)
  LEFT JOIN details d USING (posting_id) LEFT JOIN posting_skills ps USING (posting_id)
  WHERE f.posting_id NOT IN (SELECT posting_id FROM hidden)
)"""


def seniority(level: str) -> str:
    def fit(rule: dict) -> str:
        arms = []
        for name, score in rule["levels"]:
            flag = "is_fresher OR " if name == "FRESHER" and rule["fresher_flag"] is not None else ""
            arms.append(f"WHEN {flag}experience_level = '{name}' THEN {score}")
        arms += [f"WHEN {whole_words('job_title', terms)} THEN {score}" for terms, score in rule["titles"]]
        return f"CASE {' '.join(arms)} ELSE {rule['default']} END"
    named = " ".join(f"WHEN {level} = '{kind}' THEN {fit(rule)}" for kind, rule in V.SENIORITY_SCORES.items() if kind != "OTHER")
    return f"CASE {named} ELSE {fit(V.SENIORITY_SCORES['OTHER'])} END"


def factors(wanted_roles: str, remote: str, min_salary: str, level: str, skill: str | None = None) -> str:
    skill = skill or "least(CAST(1.0 AS DOUBLE), CAST(coalesce(points, 0) AS DOUBLE) / 6.0)"
    return f"""
    CAST({skill} AS DOUBLE) AS skill_f,
    CAST(CASE WHEN list_contains({wanted_roles}, role_family) THEN 1.0
      WHEN role_family = 'OTHER' THEN 0.2 ELSE 0.4 END AS DOUBLE) AS role_f,
    CAST(CASE WHEN {remote} = 'ANY' OR regexp_matches(lower(location), 'remote|india|bengaluru|bangalore')
      THEN 1.0 ELSE 0.4 END AS DOUBLE) AS location_f,
    CAST(CASE WHEN salary_max IS NULL AND salary_min IS NULL THEN 0.7
      WHEN salary_max >= {min_salary} THEN 1.0 WHEN salary_min >= {min_salary} THEN 1.0
      ELSE 0.3 END AS DOUBLE) AS salary_f,
    CAST({seniority(level)} AS DOUBLE) AS seniority_f,
    CAST(CASE WHEN date_posted >= {DAY} - 7 THEN 1.0 WHEN date_posted >= {DAY} - 14 THEN 0.8
      WHEN date_posted >= {DAY} - 30 THEN 0.6 ELSE 0.4 END AS DOUBLE) AS recency_f"""


def _w(value: float) -> str:
    return f"CAST({value} AS DOUBLE)"


SCORE = rounded("(" + " + ".join(f"{_w(w)} * {name}_f" for name, w in V.MATCH_WEIGHTS.items())
                + ") * CAST(100 AS DOUBLE)", 1)


def match_chain(roles: tuple[str, ...], remote: str, min_salary: float, level: str,
                skill: str | None = None) -> str:
    listed = "[" + ", ".join(f"'{r}'" for r in roles) + "]"
    shown = {"skill": "skill_match_score", "role": "role_match_score", "location": "location_match_score",
             "salary": "salary_match_score", "seniority": "seniority_match_score", "recency": "recency_score"}
    parts = ", ".join(f"{rounded(f'{n}_f * CAST(100 AS DOUBLE)', 1)} AS {label}" for n, label in shown.items())
    return STAR + f""",
scored AS (SELECT *, {factors(listed, f"'{remote}'", _w(min_salary), f"'{level}'", skill)} FROM inputs),
matches AS (
  SELECT posting_id, company_name, job_title, role_family, location, date_posted, salary_min, salary_max,
    currency, employment_type, posting_url, apply_url, matched_skills, matched_skill_count,
    is_likely_closed, is_fresher, experience_level, min_years_exp, max_years_exp,
    {SCORE} AS match_score, {parts}, first_seen_at, last_seen_at
  FROM scored
)"""


DEFAULT_MATCH = match_chain(("DE", "DA", "BI"), "ANY", 0.0, "ENTRY")


def select(chain: str, body: str) -> str:
    """A statement from a chain and its body; a body may open with further table expressions."""
    return f"WITH {chain.strip()}\n{body.strip()}"
