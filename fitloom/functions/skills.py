"""Skill normalisation as one column expression: split, expand, canonicalise, reject, distinct by key."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import clean, key, titleize

# Compound skills that stand for several.
MULTI = {
    "javascript/typescript": ["JavaScript", "TypeScript"], "ecs/eks": ["ECS", "EKS"], "alb/nlb": ["ALB", "NLB"],
    ".net (c#, asp.net)": [".NET", "C#", "ASP.NET"], "awsazure devops": ["AWS", "Azure DevOps"], "awsazure devops/ado": ["AWS", "Azure DevOps"],
}
# Canonical name of a skill's key.
CANONICAL = {
    "java": "Java", "python": "Python", "javascript": "JavaScript", "typescript": "TypeScript", "react": "React", "react js": "React",
    "reactjs": "React", "react.js": "React", "node.js": "Node.js", "node js": "Node.js", "nodejs": "Node.js", "spring boot": "Spring Boot",
    "docker": "Docker", "kubernetes": "Kubernetes", "terraform": "Terraform", "ansible": "Ansible", "git": "Git", "nextjs": "Next.js",
    "next js": "Next.js", "swift ui": "SwiftUI", "swiftui": "SwiftUI", "objective c": "Objective-C", "objective-c": "Objective-C",
    "pytorch": "PyTorch", "tensorflow": "TensorFlow", "keras": "Keras", "pandas": "Pandas", "numpy": "NumPy", "matplotlib": "Matplotlib",
    "pyspark": "PySpark", "hugging face": "Hugging Face", "scikit learn": "scikit-learn", "scikitlearn": "scikit-learn", "fast api": "FastAPI",
    "restful api": "REST APIs", "restful apis": "REST APIs", "rest api development": "REST APIs", "rest api integration": "REST APIs",
    "rest api": "REST APIs", "ci/cd": "CI/CD", "ci cd": "CI/CD", "cicd": "CI/CD", "ci/cd pipelines": "CI/CD", "ci cd pipelines": "CI/CD",
    "shell": "Shell Scripting", "shell scripting": "Shell Scripting", "unix shell scripting": "Shell Scripting",
    "google cloud platform": "GCP", "google cloud services": "GCP", "microsoft azure": "Azure", "azure cloud": "Azure",
    "azure cloud services": "Azure", "amazon web services": "AWS", "aws services": "AWS", "aws cloud": "AWS", "aws cloud services": "AWS",
    "helm charts": "Helm", "helm chart": "Helm", "power bi": "Power BI", "qlikview": "QlikView", "mlflow": "MLflow", "ml flow": "MLflow",
    "postgresql": "PostgreSQL", "mysql": "MySQL", "mongodb": "MongoDB", "redis": "Redis", "aws code pipeline": "AWS CodePipeline",
    "github actions": "GitHub Actions", "github copilot": "GitHub Copilot", "aws opensearch": "Amazon OpenSearch",
    "aws open search": "Amazon OpenSearch", "azure devops/ado": "Azure DevOps",
    "oracle database administration (dba)": "Oracle Database", "oracle database administration dba": "Oracle Database",
    "oracle (9i, 10g, 11g, 12c, 19c)": "Oracle Database", "ios sdk": "iOS SDK", "postgres": "PostgreSQL", "chatgpt": "OpenAI APIs",
    "vector databases": "Vector Databases",
}
# Skills too generic to keep, by exact key, part of the key and ending; and those kept all the same.
GENERIC = [
    "ai", "ml", "analytics", "frameworks", "programming", "project management", "cloud technologies", "data pipelines",
    "enterprise applications", "machine learning algorithms", "classification/regression techniques", "business analytics",
    "data engineering", "cloud architectures", "application development", "cloud platform", "data structures and algorithms",
    "architecture", "leadership", "communication", "problem solving",
]
GENERIC_PARTS = [
    "enterprise applications", "cloud technologies", "machine learning algorithms", "project management",
    "application development frameworks", "transaction management frameworks", "data access frameworks", "data quality frameworks",
    "modern test frameworks", "public, private and hybrid cloud technologies",
]
GENERIC_ENDINGS = [" frameworks", " methodologies"]
KEPT = ["azure synapse analytics", "adobe analytics"]
# Keys written in capitals, and keys written as titles.
CAPITALS = ["aws", "gcp", "sql", "nlp", "dbt", "dvc", "iam", "api"]
TITLES = ["bash", "docker", "kubernetes", "terraform", "grafana", "prometheus", "ansible", "jenkins"]


def _table(values: dict) -> Column:
    return F.create_map(*(F.lit(x) if isinstance(x, str) else F.array(*map(F.lit, x)) for pair in values.items() for x in pair))


def split_list(c: Column) -> Column:
    """A string to its items; null gives no items."""
    return F.coalesce(F.split(c, r"[,;\n\r|]+"), F.array().cast("array<string>"))


def _generic(k: Column) -> Column:
    parts, ends = F.lit(False), F.lit(False)
    for p in GENERIC_PARTS:
        parts = parts | k.contains(p)
    for e in GENERIC_ENDINGS:
        ends = ends | k.endswith(e)
    return F.when(k == "", True).when(k.isin(KEPT), False).otherwise(k.isin(GENERIC) | ends | parts)


def _expand(t: Column, k: Column) -> Column:
    parts = F.filter(F.transform(F.split(t, "/"), lambda p: F.trim(p)), lambda p: p != "")
    slashed = t.contains("/") & (k != "ci/cd") & F.size(parts).between(2, 3)
    return F.coalesce(F.try_element_at(_table(MULTI), k), F.when(slashed, parts), F.array(t))


def _canonical(t: Column, k: Column) -> Column:
    return (
        F.when(t == "", "")
        .when(k.isin(list(CANONICAL)), F.try_element_at(_table(CANONICAL), k))
        .when(k.rlike(r"^aws\s*\(.*\)$"), "AWS")
        .when(k.rlike(r"^azure\s*\(.*\)$"), "Azure")
        .when(k.rlike(r"^gcp\s*\(.*\)$"), "GCP")
        .when(k.startswith("oracle ") & k.contains("database"), "Oracle Database")
        .when(k == "rest", "REST APIs")
        .when(k == "apis", "APIs")
        .when(k.isin(CAPITALS), F.upper(t))
        .when(k.isin(TITLES), titleize(t))
        .otherwise(t)
    )


def is_generic(c: Column) -> Column:
    return _generic(key(c))


def expand(c: Column) -> Column:
    """The skills that one item stands for."""
    return _expand(clean(c), key(c))


def canonical(c: Column) -> Column:
    return _canonical(clean(c), key(c))


def _keyed(items: Column) -> Column:
    """Items cleaned, with their keys, (t, k): lambdas would work a key out anew at each use."""
    return F.transform(items, lambda x: F.struct(clean(x).alias("t"), key(x).alias("k")))


def normalize(items: Column) -> Column:
    """An array of raw skills to canonical ones, generic ones left out, the first of each key kept, in order."""
    raw = _keyed(F.coalesce(items, F.array().cast("array<string>")))
    wide = _keyed(F.flatten(F.transform(raw, lambda r: _expand(r["t"], r["k"]))))
    named = F.transform(wide, lambda r: _canonical(r["t"], r["k"]))
    good = F.filter(F.transform(named, lambda s: F.struct(key(s).alias("k"), s.alias("s"))), lambda p: ~_generic(p["k"]))

    def first(acc: Column, p: Column) -> Column:
        return F.when(F.exists(acc, lambda q: q["k"] == p["k"]), acc).otherwise(F.concat(acc, F.array(p)))

    kept = F.aggregate(good, F.array().cast("array<struct<k:string,s:string>>"), first)
    return F.transform(kept, lambda p: p["s"])
