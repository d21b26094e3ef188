"""The stages in order, each on what the one before kept, and the registration."""

import re

import public_tokenizers
from tokenizers import Tokenizer

import __spark_entry__ as contract
import corpus_pipeline as pipeline
from tickloom.llm.queries import ORACLES, QUERIES


def test_registered():
    assert set(QUERIES) | {"pipeline"} <= set(contract.queries())
    assert set(ORACLES) <= set(contract.oracle_sql())
    assert sorted(int(re.match(r"op(\d+)_", n)[1]) for n in QUERIES) == list(range(1, 11))
    assert [n for n, _ in pipeline.STAGES] == ["toxicity", "near_duplicates", "decontamination", "pii", "bpe"]


def test_stages_on_planted_documents(spark, tmp_path):
    filler = [f"Sentence {i} speaks of thing {i * 7} and of place {i * 13} in the year of the {i}th harvest by the river." for i in range(400)]
    toxic = [f"{filler[i]} You grobnak and vileworm {i}." for i in range(0, 400, 4)]
    question = "The quick surveyor counted every single lantern along the northern harbour wall before the evening tide came in."
    long = " ".join(f"w{i}" for i in range(300))
    rows = [(i, t, "en", "s", len(t)) for i, t in enumerate(filler + toxic)]
    rows += [(2000, long, "en", "s", 1), (2001, long.upper(), "en", "s", 1), (2002, long.replace("w150", "other"), "en", "s", 1)]
    rows += [(3000, f"Before it. {question} After it.", "en", "s", 1), (3001, "Write to jane.doe@mail.example.org about the lantern.", "en", "s", 1)]
    rows += [(3002, None, None, None, None), (None, "a text without an id stays", "en", "s", 1)]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{tmp_path}/documents.parquet")
    labels = [(i, 1, int(i >= 400)) for i in range(500)]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([(1, question)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")

    docs, ids = spark.read.parquet(f"{tmp_path}/documents.parquet"), []
    columns = docs.columns
    for name, stage in pipeline.STAGES[:-1]:
        out = f"{tmp_path}/{name}"
        stage(spark, docs, str(tmp_path)).write.parquet(out)
        docs = spark.read.parquet(out)
        assert docs.columns == columns
        ids.append({r.doc_id for r in docs.select("doc_id").collect()})
    assert ids[0] == {r[0] for r in rows} - set(range(400, 500))
    assert {2000, 2001, 2002} & ids[1] == {2000}
    assert ids[1] - ids[2] == {3000}
    assert ids[2] == ids[3] and {3002, None} <= ids[3]
    texts = {r.doc_id: r.text for r in docs.collect()}
    assert "jane.doe" not in texts[3001] and texts[3001].startswith("Write to ")
    library = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    result = {r.doc_id: r.n_tokens for r in pipeline.run(spark, str(tmp_path)).collect()}
    assert result == {i: len(library.encode(t or "", add_special_tokens=False).ids) for i, t in texts.items()}


def test_near_duplicates_link_by_fingerprint_and_by_similarity(spark):
    often = "alpha beta gamma " * 50  # three shingles outweigh the others in each bit of a fingerprint
    ends = [" ".join(f"{kind}{i}" for i in range(30)) for kind in "xyz"]
    block = " ".join(f"w{i}" for i in range(200))
    texts = {1: often + ends[0], 2: often + ends[1], 3: often + ends[1] + " and more", 4: block, 5: block + " " + ends[2], 6: ends[2]}
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    left = pipeline.near_duplicates(spark, docs, "").collect()
    assert sorted(r.doc_id for r in left) == [1, 4, 6]
