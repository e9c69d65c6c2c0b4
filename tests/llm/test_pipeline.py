"""The pipeline over the awkward rows, stage by stage."""

import corpus_pipeline
import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

from tests.llm import helpers


def _tables(spark, folder, rows):
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    docs.write.parquet(f"{folder}/documents.parquet")
    leak = helpers.prose(500, 40)
    spark.createDataFrame([(1, leak)], "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    return docs, leak


def test_stages(spark, tmp_path):
    leak = helpers.prose(500, 40)
    rows = [(k, helpers.prose(k, 60), "en", "s", 1) for k in range(40)]
    rows += [(100, helpers.prose(1, 60), "en", "s", 1), (101, None, None, None, None), (102, "", "en", "s", 0), (103, "123 !!", "en", "s", 1)]
    rows += [(104, helpers.prose(600, 30) + " " + leak, "en", "s", 1), (105, helpers.prose(601, 30) + " password=hunter22 " + helpers.prose(602, 30), "en", "s", 1), (None, helpers.prose(603, 60), "en", "s", 1)]
    docs, _ = _tables(spark, str(tmp_path), rows)
    names, kept = [n for n, _ in corpus_pipeline.STAGES], {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, str(tmp_path))
        assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"]
        path = f"{tmp_path}/{name}"
        docs.write.parquet(path)
        docs = spark.read.parquet(path)
        kept[name] = {r["doc_id"]: r for r in docs.collect()}
    assert names == ["language", "near_duplicates", "decontaminate", "secrets", "encode"]
    assert not {101, 102, 103} & kept["language"].keys() and len(kept["language"]) == 44
    assert 100 not in kept["near_duplicates"] and 1 in kept["near_duplicates"] and None in kept["near_duplicates"]
    assert kept["near_duplicates"].keys() - kept["decontaminate"].keys() == {104}
    assert "password=[secret] " in kept["secrets"][105]["text"] and kept["secrets"][105]["n_chars"] == len(kept["secrets"][105]["text"])
    assert kept["secrets"][3] == kept["decontaminate"][3]
    library = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    for r in corpus_pipeline.STAGES[-1][1](spark, docs, str(tmp_path)).collect():
        want = library.encode(kept["secrets"][r["doc_id"]]["text"], add_special_tokens=False).ids
        assert np.frombuffer(r["ids"], "<u4").tolist() == want and r["n_tokens"] == len(want)


def test_empty(spark, tmp_path):
    _tables(spark, str(tmp_path), [])
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
