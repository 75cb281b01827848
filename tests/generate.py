"""Seeded fixture rows, drawn from the md5 of a key so that reruns and retries agree.

Both generators take a frame with one row per wanted row, for instance ``spark.range(n)`` or a key
column of a table, and stay row-wise.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Titles with their keywords, and the value lists that rows are drawn from.
TITLES = (
    ("Python Data Engineer", ("python", "sql", "aws", "docker")),
    ("JavaScript Developer", ("javascript", "react", "node")),
    ("Java Backend Engineer", ("java", "sql", "aws")),
    ("DevOps Engineer", ("docker", "kubernetes", "aws", "python")),
    ("ML Engineer", ("python", "machine learning", "data science", "sql")),
    ("Go Developer", ("golang", "docker", "postgresql")),
    ("Scala / Spark Engineer", ("scala", "sql", "aws")),
    ("Cloud Architect", ("aws", "azure", "gcp", "cloud", "docker")),
    ("Rust Systems Engineer", ("rust", "docker")),
    ("Full Stack Developer", ("javascript", "react", "node", "sql", "python")),
)
COMPANIES = ("TechCorp", "DataWave", "CloudSoft", "FinDev", "InnoSys",
             "Bytely", "Stackr", "DevHouse", "Nexigen", "Pivotal")
LOCATIONS = ("London", "Manchester", "Edinburgh", "Bristol", "Remote")
CONTRACTS = ("permanent", "contract", None)
LANGUAGES = ("Python", "JavaScript", "Java", "SQL", "TypeScript",
             "Go", "Rust", "Scala", "C++", "C#")
COUNTRIES = ("United Kingdom", "United States", "France", "Germany", "India")
ROLES = ("Back-end developer", "Full-stack developer", "Data scientist",
         "DevOps engineer", "ML engineer", "Front-end developer")
LEVELS = ("Bachelor's", "Master's", "Some college", "PhD")
REMOTE = ("Hybrid", "Remote", "In-person")
DATABASES = ("PostgreSQL;MySQL", "PostgreSQL", "MySQL;MongoDB", "DynamoDB")
PLATFORMS = ("AWS", "Azure", "GCP", "AWS;GCP")


def draw(seed: Column, name: str, n: int) -> Column:
    """A whole number in [0, n), the same for the same seed text and name."""
    digest = F.md5(F.concat(seed, F.lit(f":{name}")))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("long") % F.lit(n)


def _pick(seed: Column, name: str, values: tuple) -> Column:
    literals = F.array(*[F.lit(v).cast("string") for v in values])
    return F.get(literals, draw(seed, name, len(values)).cast("int"))


def generate_postings(keys: DataFrame, key: str, ds: str) -> DataFrame:
    """Nested postings, one per row of ``keys``; ``ds`` names a column of ISO dates."""
    seed = F.concat(F.col(ds), F.col(key).cast("string"))
    titles = F.array(*[
        F.struct(F.lit(t).alias("title"), F.array(*map(F.lit, words)).alias("words"))
        for t, words in TITLES
    ])
    drawn = keys.select(
        seed.alias("seed"),
        F.col(ds).alias("ds"),
        F.get(titles, draw(seed, "title", len(TITLES)).cast("int")).alias("t"),
        ((draw(seed, "min", 56) + 35) * 1000).cast("double").alias("low"),
        ((draw(seed, "span", 21) + 5) * 1000).cast("double").alias("span"),
    )
    seed, title, words = F.col("seed"), F.col("t.title"), F.col("t.words")
    return drawn.select(
        F.substring(F.md5(seed), 1, 12).alias("id"),
        title.alias("title"),
        F.struct(_pick(seed, "company", COMPANIES).alias("display_name")).alias("company"),
        F.struct(_pick(seed, "location", LOCATIONS).alias("display_name")).alias("location"),
        F.col("low").alias("salary_min"),
        (F.col("low") + F.col("span")).alias("salary_max"),
        _pick(seed, "contract", CONTRACTS).alias("contract_type"),
        F.struct(F.lit("Technology").alias("label")).alias("category"),
        F.concat(
            F.lit("Vacancy: "), title, F.lit(". You will use "), F.array_join(words, ", "),
            F.lit(" from day to day, and mostly "), F.array_join(F.slice(words, 1, 2), " and "),
            F.lit("."),
        ).alias("description"),
        F.concat(F.col("ds"), F.lit("T08:30:00Z")).alias("created"),
    )


def _sample(seed: Column, name: str, size: Column) -> Column:
    """``size`` languages without replacement, ordered by their own draw."""
    ranked = F.array_sort(F.array(*[
        F.struct(F.md5(F.concat(seed, F.lit(f":{name}:{v}"))).alias("r"), F.lit(v).alias("v"))
        for v in LANGUAGES
    ]))
    return F.array_join(F.slice(F.transform(ranked, lambda x: x["v"]), F.lit(1), size), ";")


def generate_survey(keys: DataFrame, key: str) -> DataFrame:
    """Survey rows, one per row of ``keys``; all text, as a CSV would hold them."""
    seed = F.col(key).cast("string")
    return keys.select(
        seed.alias("ResponseId"),
        _pick(seed, "country", COUNTRIES).alias("Country"),
        _pick(seed, "role", ROLES).alias("DevType"),
        draw(seed, "years", 21).cast("string").alias("YearsCodePro"),
        _pick(seed, "level", LEVELS).alias("EdLevel"),
        _pick(seed, "remote", REMOTE).alias("RemoteWork"),
        _sample(seed, "used", (draw(seed, "n_used", 4) + 2).cast("int"))
        .alias("LanguageHaveWorkedWith"),
        _sample(seed, "wanted", F.lit(3)).alias("LanguageWantToWorkWith"),
        _pick(seed, "database", DATABASES).alias("DatabaseHaveWorkedWith"),
        _pick(seed, "platform", PLATFORMS).alias("PlatformHaveWorkedWith"),
        ((draw(seed, "pay", 151) + 30) * 1000).cast("string").alias("ConvertedCompYearly"),
    )
