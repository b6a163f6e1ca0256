"""A small role graph, company and college pools for the generator: parameters, to be replaced by files
in production (sources.readers reads them)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

PROFILE_DDL = "role string, skill_paths array<array<string>>, supporting_skills array<string>, templates array<struct<name:string,skills:array<string>,problem:string,outcomes:array<string>,architecture:array<string>>>, domains array<string>, company_domains array<string>, degrees array<string>, themes array<string>, titles array<string>"
ROLES = [
    ("backend_developer", [["Python", "Django", "PostgreSQL"], ["Java", "Spring Boot", "Kafka"], ["Docker", "Kubernetes"]], ["Redis", "REST APIs", "Git"],
     [("order ledger", ["Python", "PostgreSQL", "Redis"], "Kept orders and payments consistent.", ["cut failed orders by a third", "halved reconciliation work"], ["Microservices", "Event-Driven"]),
      ("partner gateway", ["Java", "Kafka", "REST APIs"], "Gave partners one stable interface.", ["onboarded partners in days"], ["Microservices"])],
     ["Financial Services", "Internet"], ["Fintech", "Internet"], ["B.Tech Computer Science", "MCA"], ["built service endpoints", "tuned slow queries", "moved jobs to queues", "wrote load tests", "cleaned old modules"], ["Backend Engineer", "Service Developer"]),
    ("data_engineer", [["Python", "Airflow", "SQL"], ["PySpark", "Kafka", "AWS"], ["Terraform", "Docker"]], ["dbt", "Git"],
     [("event lake", ["PySpark", "AWS", "Airflow"], "Made raw events usable within the hour.", ["late data fell by half", "cost per query fell"], ["Batch", "Streaming"]),
      ("metric store", ["SQL", "dbt"], "Gave teams one set of figures.", ["fewer disputed reports"], ["Batch"])],
     ["Retail", "Internet"], ["Retail", "Analytics"], ["B.Tech Computer Science", "M.Sc Statistics"], ["owned daily pipelines", "checked data contracts", "backfilled history", "wrote lineage docs"], ["Data Engineer", "Pipeline Engineer"]),
    ("devops_engineer", [["Docker", "Kubernetes", "Helm"], ["Terraform", "AWS"], ["Jenkins", "GitOps", "Monitoring"]], ["Linux", "Bash"],
     [("release train", ["Jenkins", "Kubernetes", "Helm"], "Turned releases into routine.", ["releases went from weekly to daily"], ["Pipelines"]),
      ("cluster renewal", ["Terraform", "AWS"], "Rebuilt clusters from code.", ["recovery in minutes"], ["Infrastructure as Code"])],
     ["IT Services & Consulting", "Internet"], ["Cloud", "IT Services"], ["B.E Information Technology"], ["kept clusters healthy", "automated rollbacks", "wrote runbooks"], ["DevOps Engineer", "Reliability Engineer"]),
    ("frontend_developer", [["JavaScript", "React", "CSS"], ["TypeScript", "Next.js"], ["Jest", "Cypress"]], ["HTML", "Figma"],
     [("checkout pages", ["React", "TypeScript"], "Made checkout quick on small phones.", ["abandonment fell"], ["Single Page App"]),
      ("component kit", ["React", "CSS", "Jest"], "Gave teams shared components.", ["screens ship in half the time"], ["Library"])],
     ["Retail", "E-Learning / EdTech"], ["Retail", "Education"], ["B.Sc Computer Science", "BCA"], ["built accessible screens", "cut bundle size", "tested on real devices"], ["Frontend Developer", "UI Engineer"]),
    ("generic_engineering", [["Python", "SQL"], ["Java", "Git"]], ["Linux"],
     [("internal tool", ["Python", "SQL"], "Replaced spreadsheets.", ["hours saved weekly"], ["Monolith"])],
     ["Internet"], ["Technology"], ["B.Tech Computer Science"], ["delivered features", "fixed defects"], ["Software Engineer"]),
]
ADJACENT = {"backend_developer": "data_engineer", "data_engineer": "backend_developer", "devops_engineer": "backend_developer", "frontend_developer": "backend_developer", "generic_engineering": "backend_developer"}
MISMATCH = {"backend_developer": ["frontend_developer"], "data_engineer": ["frontend_developer"], "devops_engineer": ["frontend_developer", "data_engineer"], "frontend_developer": ["data_engineer", "devops_engineer"], "generic_engineering": ["frontend_developer"]}
COMPANIES = [(f"tier_{t}", f"{name} {t}", domain, f"₹{pay} LPA") for t, pay in ((1, 42), (2, 24), (3, 16), (4, 11), (5, 7)) for name, domain in (("Northwind Pay", "Fintech"), ("Blue Basket", "Retail"), ("Cloud Yard", "Cloud Computing"), ("Learn Lane", "Education"), ("Data Forge", "Analytics"))]
COLLEGES = [(f"tier_{t}", f"{name} {t}") for t in (1, 2, 3) for name in ("Institute of Technology", "City University", "State College")]
# Words of a domain that lead to a branch of figures, searched in this order, as substrings.
METRIC_BRANCHES = [
    ("money", ["fintech", "financial", "payment", "banking", "trading", "insurance", "bank", "bfsi", "nbfc", "lending", "wealth", "capital", "fund", "property casualty", "p c insurance"]),
    ("mobile", ["mobile", "android", "ios", "app", "consumer app", "mobile app development"]),
    ("data", ["data", "analytics", "ml", "machine learning", "ai", "science", "kpo", "research", "data science", "big data", "bi ", "business intelligence", "artificial intelligence"]),
    ("platform", ["devops", "infra", "cloud", "platform", "sre", "reliability", "cloud computing", "it services", "it infrastructure", "managed services", "consulting", "internet", "telecom", "software product", "saas", "paas", "it & information"]),
    ("security", ["security", "cyber", "appsec", "pentest", "information security", "cybersecurity"]),
    ("web", ["frontend", "ui", "web", "design", "advertising", "marketing", "media", "ott", "e learning", "edtech", "education"]),
    ("games", ["game", "gaming", "entertainment", "sports", "fantasy"]),
    ("retail", ["retail", "e commerce", "ecommerce", "marketplace", "d2c", "direct to consumer", "fmcg", "grocery", "food", "consumer goods", "fashion", "apparel"]),
    ("health", ["health", "pharma", "medical", "life science", "hospital", "clinical", "pharmaceutical", "biotech", "diagnostics"]),
    ("people", ["recruitment", "staffing", "hr tech", "human resource", "bpm", "bpo", "outsourc"]),
    ("industry", ["manufactur", "industrial", "automotive", "auto component", "semiconductor", "hardware", "electronic", "equipment"]),
]
#: Five figures of each branch: a stage's maps take two neighbours, so there are three maps for entry and four for later stages.
METRIC_NAMES = {
    "money": ["payments_checked", "booking_errors", "ledgers_closed", "late_postings", "claims_paid"],
    "mobile": ["daily_users", "crashes", "screens_built", "slow_starts", "reviews_won"],
    "data": ["rows_a_day", "late_jobs", "tables_owned", "bad_rows", "models_served"],
    "platform": ["deploys_a_week", "failed_changes", "hosts_kept", "pages_at_night", "clusters_moved"],
    "security": ["findings_closed", "false_alarms", "hosts_scanned", "overdue_patches", "reviews_done"],
    "web": ["page_views", "slow_pages", "components_built", "broken_links", "sign_ups"],
    "games": ["players", "bug_escapes", "levels_shipped", "lost_sessions", "items_sold"],
    "retail": ["orders_a_day", "cart_loss", "listings_kept", "returns", "stores_served"],
    "health": ["records_kept", "audit_findings", "visits_booked", "missed_slots", "labs_linked"],
    "people": ["profiles_screened", "drop_outs", "roles_filled", "idle_days", "offers_made"],
    "industry": ["parts_traced", "downtime", "lines_watched", "scrap", "sensors_read"],
    "other": ["requests", "error_rate", "users_served", "slow_calls", "tasks_done"],
}


def profiles(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(ROLES, PROFILE_DDL)


def companies(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(COMPANIES, "tier string, name string, domain string, ctc string")


def colleges(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(COLLEGES, "tier string, name string")
