"""Fixed values that results depend on: rules, label maps, thresholds, token lists, formats."""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class Rule:
    """A case-insensitive keyword rule: any of ``any_of`` and none of ``none_of``, LIKE patterns."""

    column: str
    label: str
    any_of: tuple[str, ...]
    none_of: tuple[str, ...] = ()


# Keyword rules per skill.
SKILL_RULES = (
    Rule("skill_python", "Python", ("%python%",)),
    Rule("skill_javascript", "JavaScript", ("%javascript%", "%typescript%")),
    Rule("skill_java", "Java", ("%java%",), ("%javascript%",)),
    Rule("skill_sql", "SQL", ("% sql%", "%postgresql%", "%mysql%")),
    Rule("skill_react", "React", ("%react%",)),
    Rule("skill_node", "Node.js", ("%node%",)),
    Rule("skill_devops", "DevOps", ("%docker%", "%kubernetes%", "%k8s%")),
    Rule("skill_cloud", "Cloud", ("%aws%", "%azure%", "%gcp%", "%cloud%")),
    Rule("skill_ml", "ML/DS", ("%machine learning%", "% ml %", "%data science%")),
    Rule("skill_go", "Go", ("%golang%", "% go %")),
    Rule("skill_rust", "Rust", ("%rust%",)),
    Rule("skill_scala", "Scala", ("%scala%",)),
)

# Benchmark column -> survey names whose best average it takes.
BENCHMARK_SPEC = {
    "so_python_usd": ("Python",),
    "so_js_usd": ("JavaScript", "TypeScript"),
    "so_java_usd": ("Java",),
    "so_sql_usd": ("SQL",),
    "so_react_usd": ("React.js",),
    "so_node_usd": ("Node.js",),
    "so_go_usd": ("Go",),
    "so_rust_usd": ("Rust",),
    "so_scala_usd": ("Scala",),
}

# Flag column -> benchmark column that prices it. DevOps, Cloud and ML have none.
BENCHMARK_PAIRS = {
    "skill_python": "so_python_usd",
    "skill_javascript": "so_js_usd",
    "skill_java": "so_java_usd",
    "skill_sql": "so_sql_usd",
    "skill_react": "so_react_usd",
    "skill_node": "so_node_usd",
    "skill_go": "so_go_usd",
    "skill_rust": "so_rust_usd",
    "skill_scala": "so_scala_usd",
}

# Posting skill label -> survey skill name, for the comparison table.
COMPARISON_MAP = {
    "Python": "Python",
    "JavaScript": "JavaScript",
    "Java": "Java",
    "SQL": "SQL",
    "React": "React.js",
    "Node.js": "Node.js",
    "Go": "Go",
    "Rust": "Rust",
    "Scala": "Scala",
}

# Thresholds and rates.
USD_TO_GBP = 0.79
PAY_MIN, PAY_MAX = 10_000, 500_000
MIN_RESPONDENTS = 5
MIN_POSTINGS = 3
MIN_LABELLED = 20
MIN_SERIES_POINTS = 3
FORECAST_MONTHS = 6
TREES, LEARNING_RATE, LEAVES, MIN_LEAF_ROWS, MODEL_SEED = 300, 0.05, 31, 20, 42
CHANGEPOINT_SCALE = 0.3
PANEL_TERMS, PANEL_SERIES, PANEL_BUCKETS = 12, 8, 50

# Timestamp text of a posting; the Z is a literal, not a zone.
CREATED_FORMAT = "yyyy-MM-dd'T'HH:mm:ss'Z'"

# Cells that pandas.read_csv takes for a missing value by default.
NA_TOKENS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
)

# Market position labels.
ABOVE, BELOW, LEVEL = "UK above global", "UK below global", "Parity"
