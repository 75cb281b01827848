from pyspark.sql import functions as F

from skillscope.defaults import SKILL_RULES, Rule
from skillscope.operators.tagging import flag_columns, keyword_flags, total_flags, unpivot_flags


def flags(spark, *texts):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, description string")
    tagged = keyword_flags(df, "description")
    total = total_flags(flag_columns(SKILL_RULES))
    return [r.asDict() for r in tagged.withColumn("total", total).orderBy("i").collect()]


def hits(row):
    return {c[len("skill_"):] for c in flag_columns(SKILL_RULES) if row[c] == 1}


def test_rules(spark):
    wanted = {
        "Java and JavaScript": {"javascript"},
        "JAVA": {"java"},
        "TypeScript with java": {"javascript", "java"},
        "NoSQL": set(),
        "mysql": {"sql"},
        "x sql": {"sql"},
        "scalable trust, reactive": {"scala", "rust", "react"},
        "go": set(),
        "we go far": {"go"},
        "Golang": {"go"},
        "html ml": set(),
        "an ML job": {"ml"},
        "AWS or K8S\nnode": {"cloud", "devops", "node"},
        "": set(),
    }
    for row, (text, expected) in zip(flags(spark, *wanted), wanted.items()):
        assert hits(row) == expected, text
        assert row["total"] == len(expected)


def test_null_text_gives_null_flags(spark):
    row = flags(spark, None)[0]
    assert all(row[c] is None for c in flag_columns(SKILL_RULES)) and row["total"] is None


def test_types_and_kept_columns(spark):
    df = spark.createDataFrame([(1, "x", "Python")], "a int, b string, t string")
    tagged = keyword_flags(df, "t", SKILL_RULES, ["a"])
    assert tagged.columns == ["a"] + flag_columns(SKILL_RULES)
    assert {t for _, t in tagged.dtypes} == {"int"}


def test_patterns_are_like_patterns(spark):
    rule = Rule("f", "F", ("a_c%",), ("%Z",))
    df = spark.createDataFrame([("ABCdef",), ("abcz",), ("xabc",)], "t string")
    assert [r["f"] for r in keyword_flags(df, "t", [rule]).collect()] == [1, 0, 0]


def test_unpivot_is_the_union_of_filters(spark):
    texts = ["python java", "rust", "nothing", None, "python python", "x sql node react"]
    df = spark.createDataFrame(list(enumerate(texts)), "i int, t string")
    tagged = keyword_flags(df, "t")
    tall = sorted((r["skill"], r["i"]) for r in unpivot_flags(tagged, ["i"]).collect())
    branches = []
    for rule in SKILL_RULES:
        rows = tagged.filter(F.col(rule.column) == 1).collect()
        branches += [(rule.label, r["i"]) for r in rows]
    assert tall == sorted(branches) and len(tall) == 7
