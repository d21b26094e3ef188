"""Figures of the rules against plain counting, verdicts on planted lines."""

import re

import pytest

from tickloom.llm.quality import judge, judged

PROSE = "This is a plain sentence with enough words in it. "


def plain(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    runs = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
    again = {r for r in runs if runs.count(r) > 1}
    inside = {i + k for i, r in enumerate(runs) if r in again for k in range(5)}
    seen, dup = set(), 0
    for line in (text or "").split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            dup += line in seen
            seen.add(line)
    symbols = len(re.findall(r"[#*$%&|<>]", text or ""))
    failed = len(words) < 10 or 100 * len(inside) > 20 * len(words)
    return len(words), sum(map(len, words)), symbols, dup, len(inside), failed


def figures(r):
    return r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed


def test_documents(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    texts = {r.doc_id: r.text for r in docs.collect()}
    for r in judged(docs).collect():
        if len(texts[r.doc_id]) < 6000:
            assert figures(r) == plain(texts[r.doc_id])
        assert r.kept <= (not r.base_failed)


def test_verdicts_follow_the_labels():
    import pyarrow.parquet as pq

    docs = pq.read_table("/root/testdata/sf0.01/documents.parquet").to_pandas()
    labels = pq.read_table("/root/testdata/sf0.01/labels.parquet").to_pandas()
    rows = docs.merge(labels, on="doc_id")
    verdicts = [(judge(t), q) for t, q in zip(rows["text"], rows["quality"], strict=True)]
    passed = [(r.kept, q) for r, q in verdicts if not r.base_failed]
    assert sum(kept == bool(q) for kept, q in passed) > 0.98 * len(passed)


@pytest.mark.parametrize("text", ["", "   ", "a\xa0b c d", "x\x1fy \x0b z\x0c", "one two three four five " * 3, "é" * 50, "a\n\na\n a\na ", "a b c d e f a b c d e"])
def test_odd_texts(text):
    assert figures(judge(text)) == plain(text)


@pytest.mark.parametrize(
    ("line", "fault"),
    [
        ("Home | About | News | Contact", "navigation"),
        ("All rights reserved.", "boilerplate"),
        ("a&& b%% c## d** e$$", "symbols"),
        ("no no no no no no no no no", "stutter"),
        ("Menu", "fragment"),
        (PROSE.strip(), None),
    ],
)
def test_line_rules(line, fault):
    body = "\n".join(f"Line {n} of the text says {n * 7} things about topic {n * 13} today." for n in range(40))
    report = judge(f"{body}\n{line}")
    assert report.faults == ({fault: 1} if fault else {})
    assert report.kept
    assert (line in report.clean.split("\n")) == (fault is None)


def test_losing_too_much_rejects():
    lines = [f"Item {n} | Shop {n} | Help {n} | Top {n}" for n in range(30)]
    assert not judge("\n".join(lines)).kept
    assert judge("\n".join(f"Sentence number {n} is about subject {n * 3} and place {n * 5}." for n in range(30))).kept


def test_nulls_repeats_and_clashing_columns(spark):
    rows = [(1, None, "k", 0)] * 2 + [(None, "a " * 9, "k", 0), (3, "w " * 200_000, "k", 0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, kept string, n_words int")
    got = judged(docs).collect()
    assert sorted(((r.doc_id, r.n_words, r.kept, r.base_failed) for r in got), key=str) == [(1, 0, False, True)] * 2 + [(3, 200_000, False, True), (None, 9, False, True)]
    assert judged(docs.limit(0)).collect() == []
