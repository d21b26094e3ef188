"""Template windows against plain containment, and re-parameterised questions."""

import pytest

from tickloom.llm.decontaminate import contaminated

QUESTION = "A train leaves the station near Oldtown at 9 hours and travels 120 km before Maria stops it for 15 minutes again."


def run(spark, docs, items):
    frame = spark.createDataFrame([(i, t, 0, "x") for i, t in docs], "doc_id long, text string, item_id int, template string")
    bench = spark.createDataFrame(items, "item_id long, text string")
    return {(r.doc_id, r.item_id): r for r in contaminated(frame, bench).collect()}


def test_documents(spark):
    for size in ("sf0.001", "sf0.01"):
        folder = f"/root/testdata/{size}"
        docs, bench = (spark.read.parquet(f"{folder}/{t}.parquet") for t in ("documents", "benchmark"))
        squeezed = {r.doc_id: " ".join(r.text.lower().split()) for r in docs.collect()}
        asked = {r.item_id: " ".join(r.text.lower().split()) for r in bench.collect()}
        want = {(d, i) for d, t in squeezed.items() for i, q in asked.items() if q in t}
        assert {(r.doc_id, r.item_id) for r in contaminated(docs, bench).collect()} == want
        assert want


def test_new_values_in_the_same_places_are_found(spark):
    other = QUESTION.replace("Oldtown", "Newburg").replace("120", "355").replace("km", "miles").replace("Maria", "Petra").replace("15", "twenty")
    found = run(spark, [(1, "Intro. " + other.upper()[:0] + other + " More."), (2, "A train leaves the house."), (3, None), (4, "")], [(7, QUESTION)])
    assert set(found) == {(1, 7)}


def test_places_must_correspond(spark):
    item = "Then 5 apples and 5 pears were added to the large basket by them."
    same = item.replace("5", "8")
    mixed = "Then 5 apples and 6 pears were added to the large basket by them."
    found = run(spark, [(1, same), (2, mixed)], [(1, item)])
    assert found[1, 1].n_windows > found[2, 1].n_windows if (2, 1) in found else (1, 1) in found
    assert (1, 1) in found and found[1, 1].first_word == 0


def test_windows_of_places_prove_nothing(spark):
    assert run(spark, [(1, "1 2 3 4 5 6 7 8 9 10 11 12")], [(1, "9 8 7 6 5 4 3 2 1 0 1 2")]) == {}


@pytest.mark.parametrize("short", ["four little words here", "one"])
def test_short_items_are_one_window(spark, short):
    found = run(spark, [(1, f"and {short}"), (2, "none of it")], [(1, short), (2, ""), (3, None)])
    assert set(found) == ({(1, 1)} if short != "one" else set())  # a number word alone is a place


def test_repeats_and_empty_tables(spark):
    found = run(spark, [(1, QUESTION), (1, QUESTION), (None, QUESTION)], [(1, QUESTION), (1, QUESTION), (None, QUESTION)])
    assert set(found) == {(1, 1)}
    assert run(spark, [], [(1, QUESTION)]) == {}
    assert run(spark, [(1, QUESTION)], []) == {}
    assert set(run(spark, [(1, "filler " * 60_000 + QUESTION)], [(1, QUESTION)])) == {(1, 1)}


def test_verbatim_passages_of_any_kinds_are_found(spark):
    dense = "Add 45 to 37 and 12 to 8 and 90 to 17 for Anna and Otto Berg"
    docs = [(1, "Intro. " + QUESTION.upper()), (2, QUESTION.title()), (3, f"so: {dense} then"), (4, "now Compute 45 * 37 - 12 + 8 or not")]
    found = run(spark, docs, [(7, QUESTION), (8, dense), (9, "Compute 45 * 37 - 12 + 8")])
    assert set(found) == {(1, 7), (2, 7), (3, 8), (4, 9)}


def test_documents_in_capitals(spark):
    docs, bench = (spark.read.parquet(f"/root/testdata/sf0.1/{t}.parquet") for t in ("documents", "benchmark"))
    squeezed = {r.doc_id: " ".join(r.text.lower().split()) for r in docs.collect()}
    asked = {r.item_id: " ".join(r.text.lower().split()) for r in bench.collect()}
    want = {(d, i) for d, t in squeezed.items() for i, q in asked.items() if q in t}
    got = {(r.doc_id, r.item_id) for r in contaminated(docs, bench).collect()}
    assert want <= got and {(6420, 37), (8376, 101), (1699, 130)} <= got


def test_names_at_sentence_starts(spark):
    item = "Tom has 5 apples. Tom gives 3 to Mary. Mary buys 2 pears. How many apples does Tom have?"
    other = "Ann has 7 apples. Ann gives 4 to Jane. Jane buys 9 pears. How many apples does Ann have?"
    mixed = "Ann has 7 apples. Eve gives 4 to Jane. Lucy buys 9 pears. How many carrots did Paul eat?"
    assert set(run(spark, [(1, other), (2, mixed)], [(1, item)])) == {(1, 1)}


def test_what_stands_before_a_passage_changes_nothing(spark):
    item = "Once 12 old sailors had left with the morning tide"
    found = run(spark, [(1, "Problem Seven " + item), (2, "Problem Seven " + item.replace("12", "31"))], [(1, item)])
    assert (1, 1) in found and (2, 1) in found


def test_short_items_need_words_or_a_whole_line(spark):
    items = [(1, "the"), (2, "He has 5 apples."), (3, "Paris")]
    docs = [(1, "so the river"), (2, "and he has 7 apples in the bag"), (3, "He went to Paris then")]
    assert run(spark, docs, items) == {}
    docs = [(1, "first\nthe\nlast"), (2, "It is so. He has 5 apples. Good."), (3, "Where?\nParis")]
    assert set(run(spark, docs, items)) == {(1, 1), (2, 2), (3, 3)}
