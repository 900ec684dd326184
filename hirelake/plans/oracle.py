"""DuckDB SQL that recomputes each registered query independently.

The driver runs these against the same parquet tables (registered as views)
and compares them with the Spark results.  The raw-posting rules mirror
``hirelake.sources.testdata``; validation and enrichment mirror the
operators.  Written for DuckDB: ``lambda x: ...`` lambdas, ``||`` for text
(NULL-propagating like Spark's ``concat``), RE2 regexes.
"""

from __future__ import annotations

from hirelake.functions import fixed


def _strip(x: str) -> str:
    return f"regexp_replace({x}, '^\\s+|\\s+$', '', 'g')"


def _clean(x: str) -> str:
    return f"nullif({_strip(x)}, '')"


def _sql_list(words: list[str]) -> str:
    return ", ".join("'" + w.replace("'", "''") + "'" for w in words)


def _contains_any(x: str, words: list[str]) -> str:
    return "(" + " OR ".join(f"contains({x}, '{w}')" for w in words) + ")"


RAW = """
items AS (
  SELECT l_orderkey, min(l_partkey) AS p1, max(l_partkey) AS p2, min(l_suppkey) AS s1
  FROM lineitem GROUP BY l_orderkey
),
ndocs AS (SELECT count(*) AS n FROM documents),
base AS (
  SELECT o.o_orderkey AS k, o.o_custkey AS cust, o.o_orderdate AS od, o.o_orderpriority AS prio,
         p.p_name, p.p_brand, p.p_type, q.p_brand AS q_brand, q.p_type AS q_type,
         s.s_name, n.n_name, d.text AS _desc
  FROM orders o
  LEFT JOIN items i ON o.o_orderkey = i.l_orderkey
  LEFT JOIN part p ON p.p_partkey = i.p1
  LEFT JOIN part q ON q.p_partkey = i.p2
  LEFT JOIN supplier s ON s.s_suppkey = i.s1
  LEFT JOIN customer c ON c.c_custkey = o.o_custkey
  LEFT JOIN nation n ON n.n_nationkey = c.c_nationkey
  LEFT JOIN documents d ON d.doc_id = o.o_orderkey % (SELECT n FROM ndocs)
),
raw AS (
  SELECT
    CAST(k AS VARCHAR) AS id,
    CASE WHEN k % 20 = 7 THEN 'example.com/jobs/' || CAST(k AS VARCHAR)
         WHEN k % 50 = 9 THEN ''
         ELSE 'https://example.com/jobs/' || CAST(k AS VARCHAR) END AS url,
    CASE substr(prio, 1, 1) WHEN '1' THEN 'Lead ' WHEN '2' THEN 'Senior  ' WHEN '4' THEN 'Junior ' ELSE ' ' END
      || p_name || ' ' || p_type || ' engineer' AS title,
    s_name AS company_name,
    CAST(NULL AS VARCHAR) AS company_logo,
    p_type AS category,
    CASE WHEN k % 3 = 0 THEN '[''' || p_brand || ''', ''' || p_type || ''', ''' || q_brand || ''', ''' || lower(q_type) || ''', ''' || _skill || ''']'
         WHEN k % 3 = 1 THEN p_brand || ', ' || p_type || ',' || q_brand || ' ,' || q_type || ', ' || _skill END AS tags,
    CASE WHEN k % 7 = 0 THEN 'part_time' ELSE 'full_time' END AS job_type,
    strftime(od, '%Y-%m-%dT%H:%M:%SZ') AS publication_date,
    CASE WHEN cust % 7 = 0 THEN 'Worldwide'
         WHEN cust % 11 = 0 THEN NULL
         WHEN cust % 13 = 0 THEN n_name || ','
         WHEN cust % 3 = 0 THEN 'Remote, ' || n_name
         ELSE n_name END AS candidate_required_location,
    CASE k % 6
      WHEN 1 THEN '$' || CAST(40 + k % 90 AS VARCHAR) || 'k - $' || CAST(50 + k % 90 + k % 40 AS VARCHAR) || 'k'
      WHEN 2 THEN '€' || CAST(40 + k % 90 AS VARCHAR) || ',000 - €' || CAST(50 + k % 90 + k % 40 AS VARCHAR) || ',000'
      WHEN 3 THEN '£' || CAST(15 + k % 60 AS VARCHAR) || '/hr'
      WHEN 4 THEN CAST(k + 100000 AS VARCHAR) || '-' || CAST(k + 140000 AS VARCHAR) || ' USD'
      WHEN 5 THEN '$' || CAST(40 + k % 90 AS VARCHAR) || 'k'
    END AS salary,
    _desc AS description,
    ['remotive', 'remoteok', 'arbeitnow', 'jsearch'][(k % 4) + 1] AS source,
    CAST(od AS TIMESTAMP) + INTERVAL 1 DAY AS _landed_at,
    k AS _pos
  FROM (SELECT *, upper([{skills}][(k % {nsk}) + 1]) AS _skill FROM base)
)"""

RAW = RAW.replace("{skills}", _sql_list(fixed.SKILL_KEYWORDS)).replace("{nsk}", str(len(fixed.SKILL_KEYWORDS)))

# Tags: list text or CSV -> strip each, drop quotes of list items, lower,
# drop blanks, order-preserving distinct.
_TAG_ITEMS = (
    "CASE WHEN tags IS NULL OR {s} = '' THEN []::VARCHAR[] "
    "WHEN starts_with({s}, '[') AND ends_with({s}, ']') THEN "
    "list_transform(string_split(regexp_replace({s}, '^[\\[\\]]+|[\\[\\]]+$', '', 'g'), ','), "
    "lambda x: regexp_replace(regexp_replace(x, '^\\s+|\\s+$', '', 'g'), '^''|''$', '', 'g')) "
    "ELSE string_split({s}, ',') END"
).format(s=_strip("tags"))

VALIDATED = f"""
validated AS (
  SELECT
    TRY_CAST(id AS BIGINT) AS id,
    {_clean('source')} AS source,
    {_strip('url')} AS url,
    {_clean('title')} AS title,
    {_clean('company_name')} AS company_name,
    {_clean('company_logo')} AS company_logo,
    {_clean('category')} AS category,
    list_filter(
      list_transform({_TAG_ITEMS}, lambda x: lower(regexp_replace(x, '^\\s+|\\s+$', '', 'g'))),
      lambda x: x <> ''
    ) AS _tag_list,
    {_clean('job_type')} AS job_type,
    timezone('UTC', CAST(replace(publication_date, 'Z', '+00:00') AS TIMESTAMPTZ)) AS publication_date,
    {_clean('candidate_required_location')} AS candidate_required_location,
    {_clean('salary')} AS salary,
    {_clean('description')} AS description,
    _landed_at AS ingested_at,
    COALESCE(
      CASE WHEN TRY_CAST(id AS BIGINT) <= 0 THEN '{fixed.MSG_GT_ZERO}' END,
      CASE WHEN url IS NULL THEN '{fixed.MSG_STR_TYPE}'
           WHEN {_strip('url')} = '' THEN '{fixed.MSG_STR_SHORT}'
           WHEN NOT regexp_matches({_strip('url')}, '^https?://') THEN '{fixed.MSG_URL_PREFIX}' END,
      CASE WHEN {_clean('title')} IS NULL THEN '{fixed.MSG_BLANK}' END,
      CASE WHEN {_clean('company_name')} IS NULL THEN '{fixed.MSG_BLANK}' END,
      CASE WHEN {_clean('source')} IS NULL THEN '{fixed.MSG_STR_TYPE}' END
    ) AS error_message,
    _pos
  FROM raw
)"""

BRONZE = """
bronze AS (
  SELECT id, source, url, title, company_name, company_logo, category,
         list_filter(_tag_list, lambda x, i: list_position(_tag_list, x) = i) AS tags,
         job_type, publication_date,
         candidate_required_location, salary, description, ingested_at
  FROM validated WHERE error_message IS NULL
)"""

_SAL_PATTERN = fixed.SALARY_PATTERN.replace("'", "''")

SILVER = f"""
sal AS (
  SELECT *,
    coalesce(nullif(salary, ''), nullif(description, '')) AS _stext
  FROM bronze
),
sal2 AS (
  SELECT *,
    regexp_extract_all(_stext, '{_SAL_PATTERN}', 1) AS _nums,
    regexp_extract_all(_stext, '{_SAL_PATTERN}', 2) AS _ks,
    regexp_matches(_stext, '(?i)/hr|hour|hourly') AS _hourly
  FROM sal
),
sal3 AS (
  SELECT *,
    list_filter(
      list_transform(range(1, len(_nums) + 1), lambda i:
        CASE WHEN _hourly AND (CAST(replace(_nums[i], ',', '') AS DOUBLE) * CASE WHEN coalesce(_ks[i], '') <> '' THEN 1000.0 ELSE 1.0 END) < 1000.0
             THEN CAST(replace(_nums[i], ',', '') AS DOUBLE) * CASE WHEN coalesce(_ks[i], '') <> '' THEN 1000.0 ELSE 1.0 END * 2000.0
             ELSE CAST(replace(_nums[i], ',', '') AS DOUBLE) * CASE WHEN coalesce(_ks[i], '') <> '' THEN 1000.0 ELSE 1.0 END END),
      lambda v: v >= 10000.0 AND v <= 1000000.0) AS _vals
  FROM sal2
),
silver AS (
  SELECT
    id AS job_id, source, title, company_name, category,
    regexp_replace({_strip('title')}, '\\s+', ' ', 'g') AS role,
    CASE WHEN candidate_required_location IS NULL OR candidate_required_location = '' THEN 'Unknown'
         WHEN contains(lower({_strip('candidate_required_location')}), 'worldwide')
           OR contains(lower({_strip('candidate_required_location')}), 'global') THEN 'Global'
         WHEN contains(candidate_required_location, ',')
           THEN coalesce(nullif({_strip("string_split(candidate_required_location, ',')[-1]")}, ''), 'Unknown')
         ELSE coalesce(nullif({_strip('candidate_required_location')}, ''), 'Unknown') END AS country,
    tags,
    publication_date,
    CAST(publication_date AS DATE) AS published_date,
    CAST(date_trunc('month', publication_date) AS DATE) AS published_month,
    CASE WHEN len(_vals) > 0 THEN list_min(_vals) END AS salary_min,
    CASE WHEN len(_vals) > 0 THEN list_max(_vals) END AS salary_max,
    CASE WHEN len(_vals) > 0 THEN
      CASE WHEN contains(_stext, '€') OR contains(upper(_stext), 'EUR') THEN 'EUR'
           WHEN contains(_stext, '£') OR contains(upper(_stext), 'GBP') THEN 'GBP'
           ELSE 'USD' END END AS salary_currency,
    CASE WHEN {_contains_any("lower(title || ' ' || coalesce(description, ''))", fixed.SENIORITY_LEAD)} THEN 'Lead'
         WHEN {_contains_any("lower(title || ' ' || coalesce(description, ''))", fixed.SENIORITY_SENIOR)} THEN 'Senior'
         WHEN {_contains_any("lower(title || ' ' || coalesce(description, ''))", fixed.SENIORITY_JUNIOR)} THEN 'Junior'
         ELSE 'Mid-level' END AS seniority
  FROM sal3
)"""


def with_layers(body: str, upto: str = "silver") -> str:
    """``WITH`` prefix holding the raw -> ``upto`` CTE chain, then ``body``."""
    ctes = [RAW, VALIDATED]
    if upto in ("bronze", "silver", "gold"):
        ctes.append(BRONZE)
    if upto in ("silver", "gold"):
        ctes.append(SILVER)
    if upto == "gold":
        ctes.append(GOLD)
    return "WITH " + ",".join(ctes) + "\n" + body


GOLD = """
gold_country AS (SELECT country, published_month, count(*) AS job_count FROM silver GROUP BY ALL),
gold_skill AS (
  SELECT skill, published_month, count(*) AS job_count
  FROM (SELECT unnest(tags) AS skill, published_month FROM silver) GROUP BY ALL
),
gold_role AS (SELECT role, published_month, count(*) AS job_count FROM silver GROUP BY ALL),
gold_time AS (SELECT published_month, count(*) AS job_count FROM silver GROUP BY ALL)"""


def rules_sql(id_: str, url: str, title: str, company: str, source: str) -> str:
    """First validation error of a record given its raw field expressions."""
    return f"""COALESCE(
      CASE WHEN {id_} IS NULL THEN '{fixed.MSG_INT_TYPE}'
           WHEN TRY_CAST({_strip(id_)} AS BIGINT) IS NULL THEN '{fixed.MSG_INT_PARSE}'
           WHEN TRY_CAST({_strip(id_)} AS BIGINT) <= 0 THEN '{fixed.MSG_GT_ZERO}' END,
      CASE WHEN {url} IS NULL THEN '{fixed.MSG_STR_TYPE}'
           WHEN {_strip(url)} = '' THEN '{fixed.MSG_STR_SHORT}'
           WHEN NOT regexp_matches({_strip(url)}, '^https?://') THEN '{fixed.MSG_URL_PREFIX}' END,
      CASE WHEN {_clean(title)} IS NULL THEN '{fixed.MSG_BLANK}' END,
      CASE WHEN {_clean(company)} IS NULL THEN '{fixed.MSG_BLANK}' END,
      CASE WHEN {_clean(source)} IS NULL THEN '{fixed.MSG_STR_TYPE}' END)"""


_PAYLOAD = "json_object(" + ", ".join(f"'{f}', r.{f}" for f in fixed.CANONICAL_FIELDS) + ")::VARCHAR"

DEAD = f"""
dead AS (
  SELECT ('0x' || substr(md5('{fixed.DEFAULT_SOURCE}|' || CAST(v._pos AS VARCHAR) || '|1|' || {_PAYLOAD}), 1, 15))::BIGINT AS id,
         '{fixed.DEFAULT_SOURCE}' AS source, {_PAYLOAD} AS raw_data, v.error_message, false AS resolved, 0 AS retry_count,
         r._landed_at AS created_at, CAST(NULL AS TIMESTAMP) AS resolved_at,
         r.id AS p_id, r.url AS p_url, r.title AS p_title, r.company_name AS p_company, r.source AS p_source
  FROM validated v JOIN raw r ON r._pos = v._pos
  WHERE v.error_message IS NOT NULL
),
retry AS (
  SELECT *,
    {rules_sql('p_id', 's_url', 'p_title', 'p_company', 'p_source')} AS retry_error
  FROM (SELECT *, CASE WHEN p_url IS NOT NULL AND p_url <> '' AND NOT starts_with(p_url, 'http://')
                        AND NOT starts_with(p_url, 'https://') THEN 'https://' || ltrim(p_url, '/')
                       ELSE p_url END AS s_url
        FROM dead WHERE NOT resolved)
)"""


def with_dead(body: str) -> str:
    """CTE chain up to bronze plus the dead letters and their retry."""
    return "WITH " + ",".join([RAW, VALIDATED, BRONZE, SILVER, GOLD, DEAD]) + "\n" + body


def _ascii_words(x: str) -> str:
    """Non-ASCII letters and digits become '_' so RE2's ASCII ``\\b`` sees
    word characters where Python and Java (Unicode mode) do."""
    return (f"regexp_replace(regexp_replace({x}, '[^\\x00-\\x7F\\P{{L}}]', '_', 'g'), "
            f"'[^\\x00-\\x7F\\P{{N}}]', '_', 'g')")


_TERM_RX = "\\b[a-zA-Z0-9+#\\-\\.]+\\b"

RESUMES = f"""
resume_docs AS (
  SELECT d.doc_id, concat_ws(' ', p.p_name, [{_sql_list(fixed.TECH_TERMS)}][(d.doc_id % {len(fixed.TECH_TERMS)}) + 1],
                             'developer.', d.text) AS text
  FROM documents d LEFT JOIN part p ON p.p_partkey = d.doc_id % (SELECT count(*) FROM part)
),
res_tok AS (
  SELECT doc_id, unnest(toks) AS t, generate_subscripts(toks, 1) AS pos
  FROM (SELECT doc_id, regexp_extract_all({_ascii_words('lower(text)')}, '{_TERM_RX}', 0) AS toks FROM resume_docs)
),
res_kept AS (
  SELECT doc_id, t, min(pos) AS p FROM res_tok
  WHERE t NOT IN ({_sql_list(fixed.RESUME_STOPWORDS)})
    AND (length(t) > 1 OR t IN ({_sql_list(fixed.SHORT_TERMS_KEPT)}))
  GROUP BY doc_id, t
),
res_rank AS (
  SELECT doc_id, t, row_number() OVER (PARTITION BY doc_id ORDER BY p) AS rn FROM res_kept
),
resume_skills AS (
  SELECT d.doc_id AS resume_id,
         coalesce(list(r.t ORDER BY r.rn) FILTER (WHERE r.t IS NOT NULL), []::VARCHAR[]) AS skills
  FROM resume_docs d LEFT JOIN res_rank r ON r.doc_id = d.doc_id
  GROUP BY d.doc_id
),
job_terms AS (
  SELECT id AS job_id, title, publication_date,
    list_filter(list_concat(list_transform(tags, lambda x: lower(x)), regexp_extract_all(lower(title), '{_TERM_RX}', 0)),
                lambda x, i: list_position(list_concat(list_transform(tags, lambda y: lower(y)),
                                                       regexp_extract_all(lower(title), '{_TERM_RX}', 0)), x) = i) AS terms
  FROM bronze
),
candidates AS (
  SELECT b.id AS job_id, b.title, b.publication_date FROM bronze b
  ORDER BY b.publication_date DESC, b.id LIMIT {fixed.CANDIDATE_JOBS}
),
cand_terms AS (
  SELECT DISTINCT c.job_id, unnest(j.terms) AS term FROM candidates c JOIN job_terms j ON j.job_id = c.job_id
),
resume_pairs AS (
  SELECT r.resume_id, ct.job_id, count(*) AS overlap
  FROM (SELECT resume_id, unnest(skills) AS term FROM resume_skills) r
  JOIN cand_terms ct ON ct.term = r.term
  GROUP BY r.resume_id, ct.job_id
),
scored AS (
  SELECT p.resume_id, p.job_id, c.publication_date, p.overlap AS score,
         CAST(floor(p.overlap / len(s.skills) * 100) AS INTEGER) AS match_percent
  FROM resume_pairs p JOIN resume_skills s ON s.resume_id = p.resume_id
  JOIN candidates c ON c.job_id = p.job_id
  WHERE p.overlap > 0
)"""


def with_resumes(body: str) -> str:
    return "WITH " + ",".join([RAW, VALIDATED, BRONZE, SILVER, RESUMES]) + "\n" + body


SUBSCRIPTIONS = """
sub_ev AS (
  SELECT e.event_id, e.ts,
    CASE WHEN e.event_type = 'signup' THEN 'subscribe' ELSE 'unsubscribe' END AS action,
    '  User' || CAST(e.user_id AS VARCHAR) || '@Example.com ' AS email,
    ' user ' || CAST(e.user_id AS VARCHAR) AS name,
    CASE WHEN kk % 10 = 0 THEN []::VARCHAR[]
         WHEN kk % 10 = 1 THEN ['  ']
         ELSE list_transform(string_split(p.p_name, ' '), lambda w: ' ' || upper(w)) END AS skills
  FROM (SELECT *, CAST(json_extract_string(props, '$.k') AS BIGINT) AS kk FROM events
        WHERE event_type IN ('signup', 'error')) e
  LEFT JOIN part p ON p.p_partkey = e.kk
),
subs AS (
  SELECT
    arg_min(event_id, (ts, event_id)) FILTER (WHERE action = 'subscribe') AS id,
    arg_max(trim(name), (ts, event_id)) FILTER (WHERE action = 'subscribe') AS name,
    lower(trim(email)) AS email,
    arg_max(list_filter(list_transform(skills, lambda s: lower(trim(s))), lambda s: s <> ''), (ts, event_id))
      FILTER (WHERE action = 'subscribe') AS skills,
    arg_max(action, (ts, event_id)) = 'subscribe' AS active,
    arg_min(ts, (ts, event_id)) FILTER (WHERE action = 'subscribe') AS created_at
  FROM sub_ev GROUP BY lower(trim(email))
  HAVING count(*) FILTER (WHERE action = 'subscribe') > 0
)"""


def with_subs(body: str, extra: str = "") -> str:
    ctes = [RAW, VALIDATED, BRONZE, SILVER, SUBSCRIPTIONS]
    if extra:
        ctes.append(extra)
    return "WITH " + ",".join(ctes) + "\n" + body
