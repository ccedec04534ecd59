"""Rule-based match score of postings against profiles."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from postlake import vocabulary as V
from postlake.functions.numbers import steady_round
from postlake.functions.text import first_match, has_word
from postlake.functions.time import day, likely_closed
from postlake.operators.aliases import canonical, closure
from postlake.operators.profiles import current_profile
from postlake.plans.star import Star, current_companies

FACTORS = tuple(V.MATCH_WEIGHTS)


# --- factors, each in [0, 1] --------------------------------------------------
def skill_factor(points: Column) -> Column:
    return F.least(F.lit(1.0), F.coalesce(points, F.lit(0.0)) / V.SKILL_POINTS_FULL)


def relative_skill_factor(matched: Column, wanted: Column) -> Column:
    """Share of a profile's skills that the posting mentions, case folded."""
    def lowered(values):
        return F.transform(values, F.lower)
    hits = F.size(F.array_intersect(lowered(F.coalesce(matched, F.array().cast("array<string>"))),
                                    lowered(wanted)))
    return F.when(F.size(wanted) > 0, hits / F.size(wanted)).otherwise(0.0).cast("double")


def role_factor(family: Column, wanted: Column) -> Column:
    return (F.when(wanted, V.ROLE_WANTED)
            .when(family == V.ROLE_DEFAULT, V.ROLE_UNCLASSIFIED)
            .otherwise(V.ROLE_UNWANTED))


def listed_place(location: Column, terms=V.LOCATION_TERMS) -> Column:
    """Whether the location names remote work or one of the listed places."""
    hits = [F.lower(location).contains(term) for term in terms]
    flag = hits[0]
    for hit in hits[1:]:
        flag = flag | hit
    return F.coalesce(flag, F.lit(False))


def location_factor(anywhere: Column, listed: Column) -> Column:
    return F.when(anywhere | listed, V.LOCATION_FIT).otherwise(V.LOCATION_MISFIT)


def best_salary(low: Column, high: Column) -> Column:
    """The figure a wanted salary is held against; NULL when none is stated."""
    return F.greatest(low, high)


def salary_factor(best: Column, wanted: Column) -> Column:
    return (F.when(best.isNull(), V.SALARY_UNKNOWN)
            .when(best >= wanted, V.SALARY_FIT).otherwise(V.SALARY_MISFIT))


def seniority_factor(seeking: str, fresher: Column, level: Column, title: Column) -> Column:
    """Fit of a posting's level for someone seeking ``ENTRY``, ``SENIOR`` or ``OTHER``."""
    rule = V.SENIORITY_SCORES[seeking]
    cases = []
    for name, score in rule["levels"]:
        hit = level == name
        if name == "FRESHER" and rule["fresher_flag"] is not None:
            hit = fresher | hit
        cases.append((hit, score))
    cases += [(has_word(title, words), score) for words, score in rule["titles"]]
    return first_match(cases, rule["default"])


def recency_factor(posted: Column, as_of) -> Column:
    return first_match([(posted >= day(as_of, days), s) for days, s in V.RECENCY_STEPS], V.RECENCY_OLD)


def weighted_score(factors: dict[str, Column]) -> Column:
    total = F.lit(0.0)
    for name, weight in V.MATCH_WEIGHTS.items():
        total = total + F.lit(weight) * factors[name]
    return total * 100.0


# --- inputs -------------------------------------------------------------------
def posting_skills(mentions: DataFrame, skills: DataFrame) -> DataFrame:
    """Skill count, names and points per posting."""
    favoured = F.lower("skill_name").isin(*V.FAVOURED_SKILLS)
    points = F.when(favoured, V.SKILL_POINTS_FAVOURED).otherwise(V.SKILL_POINTS_OTHER)
    names = F.array_sort(F.collect_set("skill_name"))  # at most the dictionary
    return (
        mentions.join(skills, "skill_id", "inner").groupBy("posting_id")
        .agg(names.alias("skill_names"), F.sum(points).alias("skill_points"))
        .select("posting_id", "skill_names", "skill_points",
                F.size("skill_names").cast("bigint").alias("matched_skill_count"),
                F.array_join("skill_names", ", ").alias("matched_skills"))
    )


def match_inputs(star: Star, as_of) -> DataFrame:
    """Visible live postings with everything the factors read."""
    company = current_companies(star.companies).select("company_id", "company_name")
    place = star.locations.select("location_id", F.col("location_normalized").alias("location"))
    details = star.details.drop("description", "last_seen_at")
    hidden = star.hidden.select("posting_id").filter(F.col("posting_id").isNotNull())
    # Everything keyed by posting first, so that one partitioning of the facts serves all three joins.
    return (
        star.facts.join(hidden, "posting_id", "left_anti")
        .join(details, "posting_id", "left")
        .join(posting_skills(star.mentions, star.skills), "posting_id", "left")
        .join(company, "company_id", "inner")
        .join(place, "location_id", "left")
        .withColumns({
            "matched_skills": F.coalesce("matched_skills", F.lit("")),
            "matched_skill_count": F.coalesce("matched_skill_count", F.lit(0).cast("bigint")),
            "is_likely_closed": likely_closed(F.col("closing_date"), F.col("last_seen_at"), as_of),
        })
    )


def _seeking(level: Column) -> Column:
    return F.when(level.isin("ENTRY", "SENIOR"), level).otherwise("OTHER")


def equivalent_skills(star: Star, wanted: DataFrame, names: DataFrame) -> tuple[DataFrame, Column]:
    """Canonical skill names per posting, and those that a profile wants.

    ``wanted`` is the profile's row; both sides go through the closure ``names`` of the aliases.
    """
    skills = canonical(star.skills, "skill_name", names)
    held = (star.mentions.join(skills, "skill_id").groupBy("posting_id")
            .agg(F.collect_set("skill_name").alias("canonical_names")))  # at most the dictionary
    each = canonical(wanted.select(F.explode("target_skills").alias("skill_name")), "skill_name", names)
    return held, each.agg(F.collect_set("skill_name").alias("w")).scalar()


def job_match(star: Star, as_of, profile_id: str = "default",
              profile_skills_only: bool = False, aliases: DataFrame | None = None) -> DataFrame:
    """Score of every visible live posting for one profile.

    With ``aliases`` (``name, alias``) the skill factor is the share of the profile's skills that
    the posting mentions under any equivalent name.

    The profile is a single row, read as a scalar subquery: its fields are
    constants to the scan of postings and no join is planned for it.
    """
    stored = current_profile(star.profiles, profile_id)
    p = stored.select(F.struct("*")).scalar()
    posts = match_inputs(star, as_of).withColumn("p", p)
    seeking = _seeking(F.col("p.seniority_level"))
    seniority = F.lit(None).cast("double")
    for kind in ("OTHER", "SENIOR", "ENTRY"):
        score = seniority_factor(kind, F.col("is_fresher"), F.col("experience_level"), F.col("job_title"))
        seniority = F.when(seeking == kind, score).otherwise(seniority)
    skill = (relative_skill_factor(F.col("skill_names"), F.col("p.target_skills"))
             if profile_skills_only else skill_factor(F.col("skill_points")))
    if aliases is not None:
        held, wanted = equivalent_skills(star, stored, closure(aliases))
        posts = posts.join(held, "posting_id", "left").withColumn("canonical_wanted", wanted)
        skill = relative_skill_factor(F.col("canonical_names"), F.col("canonical_wanted"))
    factors = {
        "skill": skill,
        "role": role_factor(F.col("role_family"),
                            F.array_contains(F.col("p.target_roles"), F.col("role_family"))),
        "location": location_factor(F.col("p.remote_preference") == "ANY",
                                    listed_place(F.col("location"))),
        "salary": salary_factor(best_salary(F.col("salary_min"), F.col("salary_max")),
                                F.col("p.min_salary")),
        "seniority": seniority,
        "recency": recency_factor(F.col("date_posted"), as_of),
    }
    scored = posts.withColumns({f"_{name}": column for name, column in factors.items()})
    score = weighted_score({name: F.col(f"_{name}") for name in FACTORS})
    shown = {"recency": "recency_score", **{n: f"{n}_match_score" for n in FACTORS if n != "recency"}}
    return scored.select(
        "posting_id", "company_name", "job_title", "role_family", "location", "date_posted",
        "salary_min", "salary_max", "currency", "employment_type", "posting_url", "apply_url",
        "matched_skills", "matched_skill_count", "is_likely_closed", "is_fresher",
        "experience_level", "min_years_exp", "max_years_exp",
        steady_round(score, 1).alias("match_score"),
        *[steady_round(F.col(f"_{n}") * 100.0, 1).alias(shown[n]) for n in FACTORS],
        "first_seen_at", "last_seen_at")


# --- many profiles --------------------------------------------------------------
_KINDS = tuple(V.SENIORITY_SCORES)
_SPREAD = V.MATCH_WEIGHTS["salary"] * (V.SALARY_FIT - V.SALARY_MISFIT) * 100.0
_ROUNDING = 0.11  # scores are ranked after rounding to one decimal


def _rank() -> list[Column]:
    return [F.desc_nulls_last("best_salary"), F.asc("posting_id")]


def _tops(df: DataFrame, keys: list[str], order: list[Column], k: int) -> DataFrame:
    window = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(window)).filter(F.col("_rn") <= k)


def segment_tops(star: Star, as_of, k: int) -> DataFrame:
    """The postings that can reach some profile's top k.

    Apart from salary, a posting's factors take few values.  Among postings with
    the same ones, and salary stated, the score never falls as the salary rises,
    so for every profile alike the order is salary down, then id; without a salary
    it is the id.  The first k of each such segment are therefore enough, and the
    number of segments does not grow with the data.
    """
    posts = match_inputs(star, as_of)
    seniority = F.array(*[
        seniority_factor(kind, F.col("is_fresher"), F.col("experience_level"), F.col("job_title"))
        for kind in _KINDS])
    segments = posts.select(
        "posting_id", "role_family",
        skill_factor(F.col("skill_points")).alias("skill"),
        listed_place(F.col("location")).alias("listed"),
        seniority.alias("seniority"),
        recency_factor(F.col("date_posted"), as_of).alias("recency"),
        best_salary(F.col("salary_min"), F.col("salary_max")).alias("best_salary"),
    ).withColumn("paid", F.col("best_salary").isNotNull())
    keys = ["role_family", "skill", "listed", "seniority", "recency", "paid"]
    return _tops(segments, keys, _rank(), k).drop("_rn")


def profile_classes(profiles: DataFrame) -> DataFrame:
    """Each profile with the key of its class: wanted families, place, seniority."""
    wanted = F.array_sort(F.array_distinct(F.array_intersect(
        F.col("target_roles"), F.array(*[F.lit(f) for f, _ in V.ROLE_FAMILIES], F.lit(V.ROLE_DEFAULT)))))
    return profiles.select(
        "profile_id", "min_salary",
        wanted.alias("wanted"),
        (F.col("remote_preference") == "ANY").alias("anywhere"),
        _seeking(F.col("seniority_level")).alias("seeking"),
    )


def match_profiles(star: Star, profiles: DataFrame, as_of, k: int = 5) -> DataFrame:
    """The k best postings of every profile, ties by salary (highest first) and id.

    No posting-profile cross product: postings shrink to segment tops, profiles to
    classes, and the two meet by role family.  Per class only candidates within
    the salary factor's reach of its k-th best can ever rank, so each profile then
    meets a short, exact candidate list by its class key.
    """
    people = profile_classes(profiles)
    class_keys = ["wanted", "anywhere", "seeking"]
    families = F.array(*[F.lit(f) for f, _ in V.ROLE_FAMILIES], F.lit(V.ROLE_DEFAULT))
    classes = people.select(*class_keys).distinct().select(
        *class_keys, F.explode(families).alias("role_family"))
    position = F.array_position(F.array(*[F.lit(kind) for kind in _KINDS]), F.col("seeking"))
    base = weighted_score({
        "skill": F.col("skill"),
        "role": role_factor(F.col("role_family"), F.array_contains("wanted", F.col("role_family"))),
        "location": location_factor(F.col("anywhere"), F.col("listed")),
        "salary": F.lit(0.0),
        "seniority": F.element_at("seniority", position.cast("int")),
        "recency": F.col("recency"),
    })
    candidates = (classes.join(segment_tops(star, as_of, k), "role_family", "inner")
                  .withColumn("base", base.cast("decimal(38,8)").cast("double")))
    # The k-th best base is reached by k candidates whatever the wanted salary; one that
    # trails it by more than the salary factor can add, and rounding can hide, is behind all.
    # A class holds a bounded number of candidates, so its window is small.
    whole_class = (Window.partitionBy(*class_keys).orderBy(F.desc("base"), F.asc("posting_id"))
                   .rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    kth = F.nth_value("base", k).over(whole_class)
    reach = (candidates.withColumn("floor", F.coalesce(kth, F.lit(0.0)))
             .filter(F.col("base") >= F.col("floor") - F.lit(_SPREAD + _ROUNDING))
             .withColumn("paid", F.col("best_salary").isNotNull()))
    # Equal base and both paid or both unpaid: the same order for every profile again.
    reach = _tops(reach, [*class_keys, "base", "paid"], _rank(), k).select(
        *class_keys, "posting_id", "base", "best_salary")
    pay = F.lit(V.MATCH_WEIGHTS["salary"] * 100.0) * salary_factor(
        F.col("best_salary"), F.col("min_salary"))
    scored = people.join(reach, class_keys, "inner").select(
        "profile_id", "posting_id", "best_salary",
        steady_round(F.col("base") + pay, 1).alias("match_score"))
    ranked = _tops(scored, ["profile_id"], [F.desc("match_score"), *_rank()], k)
    return ranked.select("profile_id", "posting_id", "match_score",
                         F.col("_rn").alias("match_rank"))
