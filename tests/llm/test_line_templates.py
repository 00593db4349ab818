from __future__ import annotations

from salesmart.llm.line_templates import deduplicated
from tests.llm.helpers import docs

LONG = [f"word{chr(97 + i)}{chr(97 + i // 5)}" for i in range(24)]


def left(spark, texts):
    rows = deduplicated(docs(spark, texts)).collect()
    assert all(r.n_lines - r.n_dropped == (0 if r.text in (None, "") and r.n_dropped else (r.text or "").count("\n") + (r.text is not None)) for r in rows)
    return [r.text for r in sorted(rows, key=lambda r: r.doc_id)]


def test_first_document_keeps_recurring_lines(spark):
    shared = "This work is licensed under some terms."
    texts = [f"one line of its own\n{shared}", f"{shared}\nanother line all of its own\n{shared}", shared]
    assert left(spark, texts) == [texts[0], "another line all of its own", ""]


def test_variable_fields(spark):
    texts = [f"Page {i} of 20{i} printed on 2024-01-0{i}\nkept{chr(97 + i)} words that nobody else has" for i in range(1, 4)]
    got = left(spark, texts)
    assert got[0] == texts[0] and got[1:] == [t.split("\n")[1] for t in texts[1:]]


def test_one_quarter_of_a_long_line_may_vary(spark):
    varied = [" ".join(LONG[:n] + ["other", "words"] + LONG[n + 2 :]) for n in (3, 10, 22)]
    assert left(spark, [" ".join(LONG), *varied]) == [" ".join(LONG), "", "", ""]
    leading = ["different", *LONG[1:]]
    two_quarters = [*LONG[:4], "x", *LONG[5:20], "y", *LONG[21:]]
    longer = [*LONG, "more"]
    for other in (leading, two_quarters, longer):
        assert left(spark, [" ".join(LONG), " ".join(other)]) == [" ".join(LONG), " ".join(other)]


def test_short_lines_need_many_documents(spark):
    few = [f"The end.\nsome text number {chr(97 + i)} here now" for i in range(10)]
    assert left(spark, few) == few
    many = [f"All rights reserved.\n{chr(97 + i % 26)}{chr(97 + i // 26)} {i} x y z {'q' * i}" for i in range(60)]
    got = left(spark, many)
    assert sum("All rights" in t for t in got) == 1 and got[0].startswith("All rights")
    assert left(spark, ["End"] * 60) == ["End"] * 60


def test_repeats_within_one_document_stay(spark):
    text = "\n".join(["the same five words here"] * 4)
    frame = docs(spark, [text])
    assert [r.text for r in deduplicated(frame.union(frame)).collect()] == [text, text]


def test_odd_rows(spark):
    shared = "a shared line of seven words here"
    frame = docs(spark, [None, "", "\n \n", shared, shared]).selectExpr("*", "'mine' as n_lines", "'mine' as other")
    frame = frame.union(frame.where("doc_id = 3").selectExpr("null", "text", "lang", "source", "n_chars", "n_lines", "other"))
    got = {r.doc_id: r for r in deduplicated(frame).collect()}
    assert {i: r.text for i, r in got.items()} == {0: None, 1: "", 2: "\n \n", 3: shared, 4: "", None: shared}
    assert got[0].n_lines == 0 and got[4].n_dropped == 1 and got[4].other == "mine"
    assert deduplicated(frame.where("false")).collect() == []
    long = docs(spark, ["\n".join(f"line {chr(97 + i % 26)} is number {i} of many" + "z" * (i % 50) for i in range(5000))] * 2)
    assert sorted(len(r.text) for r in deduplicated(long).collect())[0] == 0


def test_no_passage_is_lost_through_chains(spark):
    """Line 2 differs from line 1 in one quarter, line 3 from line 2 in another, copies of each."""
    second = [*LONG[:4], "x", *LONG[5:]]
    third = [*second[:20], "y", *second[21:]]
    fourth = [*third[:10], "z", *third[11:]]
    chain = [" ".join(words) for words in (LONG, second, third, fourth)]
    assert left(spark, chain) == [chain[0], "", chain[2], chain[3]]
    assert left(spark, [*chain[:3], chain[2], chain[1], chain[2]]) == [chain[0], "", chain[2], "", "", ""]
    assert left(spark, [chain[0], chain[2], chain[1]]) == [chain[0], chain[2], ""]


def test_rows_that_repeat_an_id_are_one_document(spark):
    rows = docs(spark, ["unused", "The end.", "The end."])
    many = rows.where("doc_id = 1").crossJoin(spark.range(49).select()).union(rows.where("doc_id = 2"))
    assert {r.text for r in deduplicated(many).collect()} == {"The end."}
    others = docs(spark, ["unused"] * 3 + ["The end."] * 48).where("doc_id > 2")
    got = [r.text for r in deduplicated(many.union(others)).collect()]
    assert got.count("The end.") == 49 and got.count("") == 49
