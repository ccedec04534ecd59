"""Word lists, labels, weights and limits that results depend on.

Everything here is data.  The functions that read these lists take them as
arguments with these values as defaults, so a deployment can bring its own.
"""

# --- sources -----------------------------------------------------------------
SOURCES = {
    "adzuna": "Adzuna",
    "greenhouse": "Greenhouse",
    "lever": "Lever",
    "rippling": "Rippling",
    "ashby": "Ashby",
}

COUNTRIES = (
    "at", "au", "be", "br", "ca", "ch", "de", "es", "fr", "gb",
    "in", "it", "lu", "mx", "nl", "nz", "pl", "sg", "us", "za",
)

# --- role families, in rule order: the first matching family wins ------------
ROLE_FAMILIES = (
    ("DE", ("data engineer", "data engineering", "analytics engineer", "etl",
            "pipeline", "big data", "database engineer", "warehouse engineer")),
    ("BI", ("business intelligence", "bi developer", "bi engineer", "bi analyst",
            "tableau developer", "power bi developer")),
    ("DS", ("data scientist", "data science", "machine learning", "ml engineer",
            "mle", "ai engineer", "nlp", "deep learning", "computer vision")),
    ("DA", ("data analyst", "data analytics", "business analyst", "product analyst",
            "reporting analyst", "operations analyst", "quantitative analyst")),
    ("SWE", ("software engineer", "software developer", "backend", "frontend",
             "full stack", "fullstack", "devops", "sre", "systems engineer",
             "programmer", "ios developer", "android developer", "web developer",
             "platform engineer")),
)
ROLE_DEFAULT = "OTHER"

ROLE_LABELS = {
    "DE": "Data Engineering",
    "DA": "Data Analytics",
    "DS": "Data Science",
    "SWE": "Software Engineering",
    "BI": "Business Intelligence",
}
ROLE_LABEL_DEFAULT = "Other Tech"

# --- skill dictionary --------------------------------------------------------
SKILLS = (
    "SQL", "Python", "BigQuery", "Tableau", "Power BI", "Excel", "Airflow",
    "Spark", "Kafka", "Docker", "AWS", "GCP", "Azure", "Snowflake",
    "Pandas", "ETL", "Machine Learning", "Data Modeling", "Java",
    "JavaScript", "React", "Statistics", "Git", "Linux", "Kubernetes",
    "Looker", "dbt", "Redshift", "Databricks", "R", "SAS", "NumPy",
    "DAX", "Power Query", "A/B Testing", "Data Visualization", "Dashboarding",
    "Orchestration", "CI/CD", "Terraform", "PostgreSQL", "MySQL", "MongoDB",
    "NoSQL", "REST", "API", "JSON", "Pipeline", "MLflow", "PySpark",
    "Scikit-learn", "Polars",
)
FAVOURED_SKILLS = ("sql", "python", "spark", "dbt", "databricks")

# --- experience: regular-expression fragments over lower-cased text ----------
FRESHER_TITLE = ("intern", "internship", "trainee", "apprentice", "co-op",
                 "fresher", "graduate", "new grad", "entry level")
FRESHER_TEXT = (r"freshers?", r"new grads?", r"college grads?", r"entry level",
                r"no experience required", r"0\s*years?", r"0\s*-\s*1\s*years?")
YEARS_LOW = r"(\d+)\s*(?:-|to)\s*\d+\+?\s*(?:years?|yrs?)"
YEARS_HIGH = r"\d+\s*(?:-|to)\s*(\d+)\+?\s*(?:years?|yrs?)"
YEARS_SINGLE = (
    r"(?:at least|minimum|min\.?|over)?\s*(\d+)\+?\s*(?:years?|yrs?)(?:\s+of)?"
    r"(?:\s+relevant|\s+demonstrated|\s+professional|\s+working)?\s*experience"
)
ASSUMED_SENIOR_TITLE = ("senior", r"sr\.?", "lead", "principal", "staff")
ASSUMED_SENIOR_YEARS = 5
MAX_LOW_YEARS = 20
MAX_HIGH_YEARS = 25
LEVEL_BY_YEARS = ((1, "FRESHER"), (2, "JUNIOR"), (5, "MID"), (8, "SENIOR"))
LEVEL_ABOVE = "LEAD"
LEVEL_BY_TITLE = (
    ("LEAD", ("lead", "principal", "staff", "architect", "director")),
    ("SENIOR", ("senior", r"sr\.?")),
)
LEVEL_DEFAULT = "UNSPECIFIED"

# --- match score -------------------------------------------------------------
MATCH_WEIGHTS = {"skill": 0.35, "role": 0.25, "location": 0.15,
                 "salary": 0.10, "seniority": 0.10, "recency": 0.05}
SKILL_POINTS_FULL = 6.0
SKILL_POINTS_FAVOURED = 1.5
SKILL_POINTS_OTHER = 1.0
ROLE_WANTED, ROLE_UNCLASSIFIED, ROLE_UNWANTED = 1.0, 0.2, 0.4
LOCATION_FIT, LOCATION_MISFIT = 1.0, 0.4
LOCATION_TERMS = ("remote", "india", "bengaluru", "bangalore")
SALARY_UNKNOWN, SALARY_FIT, SALARY_MISFIT = 0.7, 1.0, 0.3
RECENCY_STEPS = ((7, 1.0), (14, 0.8), (30, 0.6))
RECENCY_OLD = 0.4
# (posting level -> score), then (title words -> score), then the default.
SENIORITY_SCORES = {
    "ENTRY": {
        "levels": (("FRESHER", 1.0), ("JUNIOR", 0.95), ("MID", 0.5),
                   ("SENIOR", 0.2), ("LEAD", 0.2)),
        "fresher_flag": 1.0,
        "titles": (
            (("intern", "junior", "entry", "associate", "graduate", "fresher"), 1.0),
            (("lead", "principal", "staff", "director", "head", "vp", "manager"), 0.2),
            (("senior", r"sr\.?"), 0.3),
        ),
        "default": 0.85,
    },
    "SENIOR": {
        "levels": (("SENIOR", 1.0), ("LEAD", 1.0), ("MID", 0.8), ("FRESHER", 0.2)),
        "fresher_flag": 0.2,
        "titles": (
            (("senior", r"sr\.?", "lead", "staff", "principal"), 1.0),
            (("intern", "junior", "entry", "graduate"), 0.2),
        ),
        "default": 0.7,
    },
    "OTHER": {
        "levels": (("MID", 1.0), ("JUNIOR", 0.85), ("SENIOR", 0.85)),
        "fresher_flag": None,
        "titles": (),
        "default": 0.8,
    },
}

# A missing profile field, in the matching mart.
PROFILE_FALLBACK = {
    "target_roles": ["DE", "DA", "BI"],
    "target_skills": ["SQL", "Python"],
    "preferred_locations": ["Remote", "India"],
    "remote_preference": "ANY",
    "min_salary": 0.0,
    "seniority_level": "ENTRY",
}
# The profile shown when none is stored.
PROFILE_DEFAULT = {
    "profile_id": "default",
    "target_roles": ["DE", "DA", "BI"],
    "target_skills": ["SQL", "Python", "Databricks", "Spark", "dbt"],
    "preferred_locations": ["Remote", "India", "Bengaluru"],
    "remote_preference": "ANY",
    "min_salary": 0.0,
    "currency": "INR",
    "seniority_level": "ENTRY",
}

# --- tracking, retention, calendar -------------------------------------------
APPLICATION_STATUSES = ("SAVED", "APPLIED", "INTERVIEW", "OFFER", "REJECTED")
NOT_APPLIED = "NOT_APPLIED"
CLOSED_AFTER_DAYS = 7            # tracker and matching
ACTIVITY_CLOSED_AFTER_DAYS = 3   # company activity
RAW_RETENTION_DAYS = 30
POSTING_RETENTION_DAYS = 7
WATERMARK_DEFAULT_DAYS = 30
LONGEVITY_EDGES = (3, 7, 14, 30)
LONGEVITY_LABELS = ("0-3 days", "4-7 days", "8-14 days", "15-30 days", "30+ days")
SEASONS = {12: "Winter", 1: "Winter", 2: "Winter", 3: "Spring", 4: "Spring",
           5: "Spring", 6: "Summer", 7: "Summer", 8: "Summer"}
SEASON_DEFAULT = "Fall / Autumn"
EXPORT_COLUMNS = (
    ("posting_id", "Posting ID"),
    ("company_name", "Company"),
    ("job_title", "Job Title"),
    ("location", "Location"),
    ("date_posted", "Date Posted"),
    ("closing_date", "Closing Date"),
    ("date_applied", "Date Applied"),
    ("is_likely_closed", "Likely Closed"),
    ("last_seen_at", "Last Seen"),
)
