import re

from moodmart.llm import licenses

TEXTS = ["", " ", "--", "A b", "-a--B9-", "x\n\nYY z\n--\n", "É é ß漢字 İK 😀a", "a\r\tb\x0b0/9:;@[`{|}~\x7f\x80", None]


def test_lines_are_cut_into_their_words_once(spark):
    files = spark.createDataFrame(list(enumerate(TEXTS)), "key int, text string")
    lines = licenses.lines_with_words(files)
    found = {(row["key"], row["position"]): row["words"] for row in lines.collect()}
    lower = str.maketrans({upper: upper.lower() for upper in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"})
    expected = {
        (key, place): words
        for key, text in enumerate(TEXTS)
        for place, line in enumerate((text or "").split("\n"))
        if (words := re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", line.translate(lower)))
    }
    assert found == expected
    plan = lines._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("translate(") == 1
