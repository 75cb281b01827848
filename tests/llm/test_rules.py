from brute import rule_counts

from skillscope.llm.rules import quality_rules

SCHEMA = "doc_id long, text string"
PROSE = "This is a line of plain prose that ends in a full stop, as it should do.\n"
OTHER = "Another sentence follows here with quite different words, and it closes properly too.\n"
MENU = "Home | About | Contact | Login | Help\n"
TEXTS = [None, "", " \t\n", "a", "#*$%&|<>é😀 # x", "a b c d e f g h " * 5, "x " * 30, PROSE * 3, PROSE + PROSE.upper() + "and so on, further still.\n",
         PROSE + OTHER + MENU, MENU * 4 + PROSE, "\n\n" + PROSE + "\n" + "p q r s t u v w " * 2 + "z " * 7,
         "All rights reserved by us\n" + PROSE + OTHER, "😀 " * 25]


def test_counts_and_verdicts(spark):
    made = spark.createDataFrame([(i, t, 5) for i, t in enumerate(TEXTS)] + [(None, PROSE * 3, 5)], SCHEMA + ", n_words int")
    got = {r["doc_id"]: r for r in quality_rules(made).collect()}
    for i, text in enumerate(TEXTS):
        r = got[i]
        want = rule_counts(text)
        assert (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"], r["base_failed"]) == want, text
        assert not (r["base_failed"] and r["kept"])
    assert got[9]["kept"] and got[9]["n_lines_removed"] == 1 and "Login" not in got[9]["cleaned"] and "plain" in got[9]["cleaned"]
    assert got[12]["kept"] and not got[12]["cleaned"].startswith("All rights")
    assert got[None]["n_words"] == rule_counts(PROSE * 3)[0] and len(got) == len(TEXTS) + 1


def test_losing_too_much_rejects(spark):
    menus = "".join(f"Item {i} | About {i} | Contact {i} | Help {i}\n" for i in range(9))
    got = quality_rules(spark.createDataFrame([(1, menus + PROSE)], SCHEMA)).first()
    assert not got["base_failed"] and not got["kept"] and got["lost_share"] > 0.5
    assert quality_rules(spark.createDataFrame([(1, menus + PROSE)], SCHEMA), max_loss=0.9).first()["kept"]
    assert quality_rules(spark.createDataFrame([], SCHEMA)).count() == 0
