"""Extra columns with names that SQL text cannot hold."""

from lapframe.llm import line_dedup, toxicity

ODD = "doc_id long, text string, `my col` int, `a.b` string, `row` int, `score` double, `n_lines` int, `rest` string"


def test_odd_names_pass_line_dedup_and_toxicity(sent):
    line = "one two three four five six seven eight nine"
    rows = [(1, line, 1, "x", 2, 0.5, 3, "r"), (2, f"other\n{line}", 2, None, 3, None, 4, None), (None, None, None, None, None, None, None, None)]
    docs = sent.createDataFrame(rows, ODD)
    cut = line_dedup.dedup_lines(docs).select("row.*")
    assert cut.columns == docs.columns
    got = {r["doc_id"]: tuple(r) for r in cut.collect()}
    assert got[1] == rows[0] and got[2][0] == 2 and got[2][1].strip() == "other" and got[2][2:] == rows[1][2:] and got[None] == rows[2]
    labels = sent.createDataFrame([(1, 1), (2, 0)], "doc_id long, toxic int")
    scored = toxicity.score(docs, toxicity.train(docs, labels))
    assert scored.select("row.*").columns == docs.columns
    assert sorted(map(str, (tuple(r) for r in scored.select("row.*").collect()))) == sorted(map(str, rows))


def test_a_row_without_an_id_is_not_held_out(sent, tmp_path):
    sent.createDataFrame([(None, "a b"), (5, "c d")], "doc_id long, text string").write.parquet(str(tmp_path / "documents.parquet"))
    sent.createDataFrame([(5, 1)], "doc_id long, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    got = {r["doc_id"]: r["held_out"] for r in toxicity.query(sent, str(tmp_path)).collect()}
    assert got[None] is False and got[5] in (True, False)
