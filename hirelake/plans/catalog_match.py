"""Registered matching, recommendation, alert and change-log queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from hirelake.functions import fixed
from hirelake.operators import alerts as A
from hirelake.operators import changes as C
from hirelake.operators import matching as M
from hirelake.operators import topk as K
from hirelake.operators.strategy import materialize
from hirelake.plans import layers as L
from hirelake.plans import oracle as O
from hirelake.plans.catalog import register
from hirelake.sources import testdata as TD


# --- term sets and résumé matching (SET2-SET4, JN5, REC1-REC7) ------------------

@register("job_terms", O.with_resumes("SELECT job_id, terms FROM job_terms"))
def q_job_terms(spark, sf):
    """SET2: tag and title terms of every posting."""
    return M.job_terms_frame(L.bronze(spark, sf))


@register("resume_skills", O.with_resumes("SELECT resume_id, skills FROM resume_skills"))
def q_resume_skills(spark, sf):
    """REC1 over every document (whole texts)."""
    return M.resume_skill_frame(TD.resumes(spark, sf)).select("resume_id", "skills")


@register("candidate_jobs", O.with_resumes("SELECT job_id AS id, title, publication_date FROM candidates"))
def q_candidate_jobs(spark, sf):
    """REC2: the 2000 newest postings."""
    return M.candidate_jobs(L.bronze(spark, sf), n=fixed.CANDIDATE_JOBS).select("id", "title", "publication_date")


@register("resume_match", O.with_resumes("SELECT resume_id, job_id, overlap FROM resume_pairs"))
def q_resume_match(spark, sf):
    """JN5 / SET3: shared-term counts of résumés x candidate postings."""
    skills = M.resume_skill_frame(TD.resumes(spark, sf))
    return M.resume_match(skills, M.candidate_jobs(L.bronze(spark, sf), n=fixed.CANDIDATE_JOBS)).select(
        "resume_id", "job_id", "overlap")


@register("score_jobs", O.with_resumes(
    "SELECT resume_id, job_id, publication_date, score, match_percent FROM scored"))
def q_score_jobs(spark, sf):
    """REC3."""
    skills = M.resume_skill_frame(TD.resumes(spark, sf))
    return M.score_jobs(skills, M.candidate_jobs(L.bronze(spark, sf), n=fixed.CANDIDATE_JOBS))


@register("score_jobs_roles", O.with_resumes(
    "SELECT resume_id, job_id, publication_date, overlap + CASE WHEN bonus THEN 2 ELSE 0 END AS score, "
    "CASE WHEN n > 0 THEN CASE WHEN bonus THEN least(100, pct + 15) ELSE pct END WHEN bonus THEN 100 ELSE 0 END AS match_percent "
    "FROM (SELECT x.resume_id, x.job_id, c.publication_date, x.overlap, x.bonus, len(s.skills) AS n, "
    "CAST(CASE WHEN len(s.skills) > 0 THEN floor(x.overlap / len(s.skills) * 100) ELSE 0 END AS INTEGER) AS pct FROM ("
    "SELECT resume_id, job_id, max(overlap) AS overlap, bool_or(bonus) AS bonus FROM ("
    "SELECT resume_id, job_id, overlap, false AS bonus FROM resume_pairs UNION ALL "
    "SELECT d.doc_id, c.job_id, 0, true FROM documents d "
    "JOIN part p ON p.p_partkey = d.doc_id % (SELECT count(*) FROM part) AND d.doc_id % 5 = 0 "
    "JOIN candidates c ON contains(lower(c.title), lower(p.p_type))) GROUP BY resume_id, job_id) x "
    "JOIN candidates c ON c.job_id = x.job_id JOIN resume_skills s ON s.resume_id = x.resume_id)"))
def q_score_jobs_roles(spark, sf):
    """REC3 with recommended roles: bonus and role-only matches."""
    skills = M.resume_skill_frame(TD.resumes(spark, sf, with_roles=True))
    return M.score_jobs(skills, M.candidate_jobs(L.bronze(spark, sf), n=fixed.CANDIDATE_JOBS), role_matches=True)


@register("recommend_top_n", O.with_resumes(
    "SELECT resume_id, job_id, publication_date, score, match_percent, rank, "
    f"CASE WHEN match_percent >= {fixed.TIER_STRONG} THEN 'strong' WHEN match_percent >= {fixed.TIER_GOOD} "
    "THEN 'good' ELSE 'weak' END AS tier FROM ("
    "SELECT *, row_number() OVER (PARTITION BY resume_id ORDER BY score DESC, match_percent DESC, "
    "publication_date DESC, job_id) AS rank FROM scored) WHERE rank <= 10"))
def q_recommend_top_n(spark, sf):
    """REC4 + REC5: ten best postings per résumé with their match tier."""
    skills = M.resume_skill_frame(TD.resumes(spark, sf))
    scored = M.score_jobs(skills, M.candidate_jobs(L.bronze(spark, sf), n=fixed.CANDIDATE_JOBS))
    return M.recommend_top_n(scored, 10).withColumn("tier", M.match_tier(F.col("match_percent")))


_ALL_RANKED = (
    "SELECT *, row_number() OVER (PARTITION BY resume_id ORDER BY score DESC, match_percent DESC, "
    "publication_date DESC, job_id) AS rank FROM scored")
_TIER = (f"CASE WHEN match_percent >= {fixed.TIER_STRONG} THEN 'strong' WHEN match_percent >= {fixed.TIER_GOOD} "
         "THEN 'good' ELSE 'weak' END AS tier")


def _over_all(body: str) -> str:
    """SQL over the scores of all postings instead of the newest ones."""
    return O.with_resumes(body).replace(f"LIMIT {fixed.CANDIDATE_JOBS}", "")


def _top_all(spark, sf, n: int = 10):
    skills = M.resume_skill_frame(TD.resumes(spark, sf))
    return K.top_matches(skills, L.bronze(spark, sf, {"tags"}), n)


@register("recommend_top_n_all", _over_all(
    f"SELECT r.resume_id, r.job_id, r.publication_date, r.score, r.match_percent, r.rank, {_TIER}, b.title, b.company_name, "
    "b.source, b.url, b.tags, s.salary_min, s.salary_max, s.salary_currency, s.seniority "
    f"FROM ({_ALL_RANKED}) r JOIN bronze b ON b.id = r.job_id LEFT JOIN silver s ON s.job_id = r.job_id WHERE rank <= 10"))
def q_recommend_top_n_all(spark, sf):
    """REC4 over all postings, with what a reader is shown of each."""
    top = _top_all(spark, sf).withColumn("tier", M.match_tier(F.col("match_percent")))
    return K.with_display(materialize(top), L.enriched(spark, sf))


@register("match_tier_all", _over_all(
    f"SELECT resume_id, job_id, match_percent, {_TIER} FROM ({_ALL_RANKED}) WHERE rank <= 10"))
def q_match_tier_all(spark, sf):
    """REC5 of the best of all postings."""
    return _top_all(spark, sf).select("resume_id", "job_id", "match_percent", M.match_tier(F.col("match_percent")).alias("tier"))


def _dict_terms_sql() -> str:
    hits = ", ".join(
        f"CASE WHEN regexp_matches({O._ascii_words('lower(text)')}, '\\b{t}\\b') THEN '{t}' END"
        for t in fixed.TECH_TERMS)
    return (f"SELECT doc_id AS resume_id, CASE WHEN len(f) > 0 THEN f ELSE "
            f"[{O._sql_list(fixed.TECH_TERMS_DEFAULT)}] END AS terms FROM ("
            f"SELECT doc_id, list_filter([{hits}], lambda x: x IS NOT NULL) AS f FROM resume_docs)")


@register("dict_resume_skills", O.with_resumes(_dict_terms_sql()))
def q_dict_resume_skills(spark, sf):
    """REC6 over every document."""
    return M.dict_resume_skills(TD.resumes(spark, sf))


def _dict_recommend_sql() -> str:
    text = ("lower(title || ' ' || '[' || coalesce(array_to_string(list_transform(tags, lambda t: '''' || t || ''''), ', '), '') "
            "|| ']' || ' ' || coalesce(category, 'None'))")
    hits = " + ".join(f"CASE WHEN list_contains(r.terms, '{t}') AND contains(j.txt, '{t}') THEN 1 ELSE 0 END"
                      for t in fixed.TECH_TERMS)
    return O.with_resumes(
        "SELECT resume_id, job_id, match_score, rank FROM ("
        "SELECT resume_id, job_id, match_score, row_number() OVER (PARTITION BY resume_id "
        "ORDER BY match_score DESC, job_id) AS rank FROM ("
        f"SELECT r.resume_id, j.job_id, CAST(floor(({hits}) / len(r.terms) * 100) AS INTEGER) AS match_score "
        f"FROM ({_dict_terms_sql()}) r, (SELECT job_id, {text} AS txt FROM silver) j) WHERE match_score > 0"
        ") WHERE rank <= 10")


@register("dict_recommend", _dict_recommend_sql())
def q_dict_recommend(spark, sf):
    """REC7: dictionary recommender over all résumés and all silver postings."""
    return M.dict_recommend(TD.resumes(spark, sf), L.silver(spark, sf), 10)


# --- change logs (CHG1, CHG2) and bookmark joins (JN2, JN3) ----------------------

@register("subscription_apply", O.with_subs(
    "SELECT id, name, email, skills, active, created_at, CAST(NULL AS TIMESTAMP) AS last_sent_at FROM subs"))
def q_subscription_apply(spark, sf):
    """CHG2: subscription table after folding the change log."""
    return C.subscription_state(TD.subscription_events(spark, sf))


@register("merge_subscription_skills", O.with_subs(
    "SELECT id, list_sort(list_distinct(list_concat(skills, list_filter(list_transform("
    "string_split(replace(name, ' ', ','), ','), lambda s: lower(trim(s))), lambda s: s <> '')))) AS skills FROM subs"))
def q_merge_subscription_skills(spark, sf):
    """SET4: chosen skills merged with custom comma-separated text (here: the name's words)."""
    st = C.subscription_state(TD.subscription_events(spark, sf))
    return st.select("id", M.merge_subscription_skills(
        F.col("skills"), F.regexp_replace("name", " ", ",")).alias("skills"))


BOOKMARKS_SQL = """
bm_ev AS (
  SELECT event_id, ts,
    CASE WHEN event_type = 'signup' THEN 'add' WHEN event_type = 'error' THEN 'remove' ELSE 'note' END AS action,
    CAST(json_extract_string(props, '$.k') AS BIGINT) * 100 + user_id AS job_id,
    'note ' || CAST(event_id AS VARCHAR) AS notes
  FROM events WHERE event_type IN ('signup', 'error', 'click')
),
bm_rm AS (SELECT job_id, max((ts, event_id)) FILTER (WHERE action = 'remove') AS rm FROM bm_ev GROUP BY job_id),
bm_after AS (SELECT e.* FROM bm_ev e JOIN bm_rm r USING (job_id) WHERE r.rm IS NULL OR (e.ts, e.event_id) > r.rm),
bookmarks AS (
  SELECT * FROM (
    SELECT job_id,
      arg_min(event_id, (ts, event_id)) FILTER (WHERE action = 'add') AS id,
      arg_min(ts, (ts, event_id)) FILTER (WHERE action = 'add') AS bookmarked_at,
      arg_min(notes, (ts, event_id)) FILTER (WHERE action = 'add') AS add_notes,
      min((ts, event_id)) FILTER (WHERE action = 'add') AS add_o,
      arg_max(notes, (ts, event_id)) FILTER (WHERE action = 'note') AS note_notes,
      max((ts, event_id)) FILTER (WHERE action = 'note') AS note_o
    FROM bm_after GROUP BY job_id) WHERE id IS NOT NULL
)"""


@register("bookmark_apply", O.with_subs(
    "SELECT id, job_id, CASE WHEN note_o IS NOT NULL AND note_o > add_o THEN note_notes ELSE add_notes END AS notes, "
    "bookmarked_at FROM bookmarks", BOOKMARKS_SQL))
def q_bookmark_apply(spark, sf):
    """CHG1: bookmark table after folding the change log."""
    return C.bookmark_state(TD.bookmark_events(spark, sf))


@register("bookmarks_list", O.with_subs(
    "SELECT k.id, k.job_id, CASE WHEN note_o IS NOT NULL AND note_o > add_o THEN note_notes ELSE add_notes END AS notes, "
    f"k.bookmarked_at, CASE WHEN b.id IS NULL THEN '{fixed.BOOKMARK_DELETED_TITLE}' ELSE b.title END AS title, "
    f"CASE WHEN b.id IS NULL THEN '{fixed.BOOKMARK_DELETED_COMPANY}' ELSE b.company_name END AS company_name, "
    f"b.url, CASE WHEN b.id IS NULL THEN '{fixed.BOOKMARK_DELETED_SOURCE}' ELSE b.source END AS source "
    "FROM bookmarks k LEFT JOIN bronze b ON b.id = k.job_id", BOOKMARKS_SQL))
def q_bookmarks_list(spark, sf):
    """JN2."""
    return C.bookmarks_list(C.bookmark_state(TD.bookmark_events(spark, sf)), L.bronze(spark, sf))


@register("bookmark_lookup", O.with_subs(
    "SELECT s.*, b.url, b.description FROM silver s LEFT JOIN bronze b ON b.id = s.job_id "
    "WHERE s.job_id IN (SELECT job_id FROM bookmarks)", BOOKMARKS_SQL))
def q_bookmark_lookup(spark, sf):
    """JN3: silver + bronze columns of the bookmarked postings."""
    bm = C.bookmark_state(TD.bookmark_events(spark, sf))
    return C.bookmark_lookup(L.silver(spark, sf), L.bronze(spark, sf), bm)


# --- alerts (ALR1-ALR6, JN4) -------------------------------------------------------

ALERT_AS_OF = "2001-08-02 12:00:00"

# last_sent_at of the alert run: derived from the subscription id so that
# never-sent, recently-sent (not due) and old windows all occur.
_LAST_SENT = ("CASE WHEN id % 4 = 0 THEN NULL ELSE TIMESTAMP '{a}' - to_days(CAST(id % 120 AS INTEGER)) "
              "- to_hours(CAST(id % 30 AS INTEGER)) END").format(a=ALERT_AS_OF)


def _as_of():
    return F.lit(ALERT_AS_OF).cast("timestamp")


def _alert_subs(spark, sf):
    st = C.subscription_state(TD.subscription_events(spark, sf))
    last = F.when(F.col("id") % 4 == 0, F.lit(None).cast("timestamp")).otherwise(
        _as_of() - F.make_interval(days=(F.col("id") % 120).cast("int"), hours=(F.col("id") % 30).cast("int")))
    return st.withColumn("last_sent_at", last)


def _jobs(spark, sf):
    """Postings with silver display columns (digest only)."""
    return L.enriched(spark, sf)


def _postings(spark, sf):
    """Postings for matching: bronze columns only (no enrichment needed)."""
    return L.bronze(spark, sf)


ALERT_SQL = f"""
asubs AS (SELECT id, name, email, skills, active, created_at, {_LAST_SENT} AS last_sent_at FROM subs),
due AS (
  SELECT *, coalesce(last_sent_at, TIMESTAMP '{ALERT_AS_OF}' - INTERVAL 1 DAY) AS since FROM asubs
  WHERE active AND (last_sent_at IS NULL OR TIMESTAMP '{ALERT_AS_OF}' - last_sent_at >= INTERVAL 23 HOURS)
),
jt AS (
  SELECT id AS job_id, ingested_at, publication_date,
    list_concat(list_transform(tags, lambda x: lower(x)), regexp_extract_all(lower(title), '{O._TERM_RX}', 0)) AS terms
  FROM bronze
),
matches AS (
  SELECT DISTINCT d.id AS sub_id, j.job_id FROM due d JOIN jt j ON j.ingested_at >= d.since
  WHERE (len(d.skills) = 0 AND d.skills IS NOT NULL) OR len(list_intersect(d.skills, j.terms)) > 0
)"""


@register("alert_due", O.with_subs("SELECT id, email, since FROM due", ALERT_SQL))
def q_alert_due(spark, sf):
    """ALR1 (not forced)."""
    return A.alert_due(_alert_subs(spark, sf), _as_of()).select("id", "email", "since")


@register("alert_match", O.with_subs("SELECT sub_id, job_id FROM matches", ALERT_SQL))
def q_alert_match(spark, sf):
    """ALR2 / JN4 over all due subscribers."""
    due = A.alert_due(_alert_subs(spark, sf), _as_of())
    return A.alert_match(due, _postings(spark, sf))


@register("alert_summary", O.with_subs(
    "SELECT d.id AS sub_id, d.email, coalesce(c.n, 0) AS match_count, "
    f"CASE WHEN coalesce(c.n, 0) > 0 THEN '{fixed.ALERT_SUBJECT_PREFIX}' || CAST(c.n AS VARCHAR) || "
    f"'{fixed.ALERT_SUBJECT_SUFFIX}' END AS subject, coalesce(c.n, 0) > 0 AS sent "
    "FROM due d LEFT JOIN (SELECT sub_id, count(*) AS n FROM matches GROUP BY sub_id) c ON c.sub_id = d.id",
    ALERT_SQL))
def q_alert_summary(spark, sf):
    """ALR4."""
    due = A.alert_due(_alert_subs(spark, sf), _as_of())
    return A.alert_summary(due, A.alert_counts(due, _postings(spark, sf)))


@register("alerts_sent", O.with_subs("SELECT count(DISTINCT sub_id) AS alerts_sent FROM matches", ALERT_SQL))
def q_alerts_sent(spark, sf):
    """ALR4: how many subscribers get an alert."""
    due = A.alert_due(_alert_subs(spark, sf), _as_of())
    return A.alerts_sent(A.alert_summary(due, A.alert_counts(due, _postings(spark, sf))))


@register("alert_advance_state", O.with_subs(
    f"SELECT a.id, CASE WHEN d.id IS NOT NULL THEN TIMESTAMP '{ALERT_AS_OF}' ELSE a.last_sent_at END AS last_sent_at "
    "FROM asubs a LEFT JOIN due d ON d.id = a.id", ALERT_SQL))
def q_alert_advance_state(spark, sf):
    """ALR5."""
    subs = _alert_subs(spark, sf)
    due = A.alert_due(subs, _as_of())
    return A.alert_advance_state(subs, due, _as_of()).select("id", "last_sent_at")


@register("alert_digest", O.with_subs(
    "SELECT m.sub_id, m.job_id, b.title, b.company_name, b.url, "
    "CASE WHEN coalesce(s.salary_min, 0) <> 0 AND coalesce(s.salary_max, 0) <> 0 THEN "
    "coalesce(s.salary_currency, '$') || format('{:,}', CAST(floor(s.salary_min) AS BIGINT)) || ' - ' || "
    "coalesce(s.salary_currency, '$') || format('{:,}', CAST(floor(s.salary_max) AS BIGINT)) "
    "WHEN coalesce(b.salary, '') <> '' THEN b.salary ELSE 'Not specified' END AS salary_display, "
    "CASE WHEN s.seniority IS NOT NULL AND s.seniority <> '' AND s.seniority <> 'Unspecified' THEN s.seniority END AS seniority_badge, "
    "upper(coalesce(nullif(b.source, ''), 'remotive')) AS source_badge, "
    "coalesce(nullif(b.candidate_required_location, ''), 'Remote') AS location, "
    "strftime(b.publication_date, '%b %d, %Y') AS published, b.publication_date "
    "FROM matches m JOIN bronze b ON b.id = m.job_id LEFT JOIN silver s ON s.job_id = m.job_id", ALERT_SQL))
def q_alert_digest(spark, sf):
    """ALR3."""
    due = A.alert_due(_alert_subs(spark, sf), _as_of())
    return A.alert_digest(A.alert_match(due, _postings(spark, sf)), _jobs(spark, sf))


@register("alert_preview", O.with_subs(
    "SELECT sub_id, job_id, publication_date, rank FROM ("
    "SELECT s.id AS sub_id, j.job_id, j.publication_date, row_number() OVER (PARTITION BY s.id "
    "ORDER BY j.publication_date DESC, j.job_id) AS rank FROM subs s JOIN jt j "
    "ON (len(s.skills) = 0) OR len(list_intersect(s.skills, j.terms)) > 0) WHERE rank <= 5", ALERT_SQL))
def q_alert_preview(spark, sf):
    """ALR6 for every subscriber."""
    return A.alert_preview(C.subscription_state(TD.subscription_events(spark, sf)), _postings(spark, sf))


@register("skill_overlap", O.with_subs(
    "SELECT m.sub_id, m.job_id, len(list_intersect(d.skills, j.terms)) AS overlap "
    "FROM matches m JOIN due d ON d.id = m.sub_id JOIN jt j ON j.job_id = m.job_id", ALERT_SQL))
def q_skill_overlap(spark, sf):
    """SET3: size of the skill / term intersection of every alert match."""
    from hirelake.functions import terms as T
    from hirelake.operators.matching import skill_overlap
    due = A.alert_due(_alert_subs(spark, sf), _as_of())
    jobs = _postings(spark, sf)
    m = A.alert_match(due, jobs)
    s = due.select(F.col("id").alias("sub_id"), T.skill_set(F.col("skills")).alias("_skills"))
    j = jobs.select(F.col("id").alias("job_id"), T.job_terms(F.col("tags"), F.col("title")).alias("_terms"))
    return m.join(s, "sub_id").join(j, "job_id").select(
        "sub_id", "job_id", skill_overlap(F.col("_skills"), F.col("_terms")).alias("overlap"))


@register("match_tier", O.with_resumes(
    "SELECT resume_id, job_id, match_percent, "
    f"CASE WHEN match_percent >= {fixed.TIER_STRONG} THEN 'strong' WHEN match_percent >= {fixed.TIER_GOOD} "
    "THEN 'good' ELSE 'weak' END AS tier FROM ("
    "SELECT *, row_number() OVER (PARTITION BY resume_id ORDER BY score DESC, match_percent DESC, "
    "publication_date DESC, job_id) AS rank FROM scored) WHERE rank <= 10"))
def q_match_tier(spark, sf):
    """REC5: tier of every recommended posting."""
    skills = M.resume_skill_frame(TD.resumes(spark, sf))
    scored = M.score_jobs(skills, M.candidate_jobs(L.bronze(spark, sf), n=fixed.CANDIDATE_JOBS))
    return M.recommend_top_n(scored, 10).select(
        "resume_id", "job_id", "match_percent", M.match_tier(F.col("match_percent")).alias("tier"))
