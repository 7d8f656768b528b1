"""The notes step at size: one shuffle by document for the entities, parts that follow the rows."""

from scribeflow.operators import extract as X
from scribeflow.operators import validate as V
from scribeflow.plans import queries as Q
from scribeflow.sources import fixtures as fx

ENT = ("doc_id long, type string, name string, value_text string, value_num double, unit string, confidence double, source string, "
       "start_char long, end_char long, page int, tok_pos struct<page:bigint,table:bigint,row:bigint>")


def _ent(doc, name, value, source, pos):
    return (doc, "test_result", name, value, None, "u", 0.9, source, None, None, None, pos)


def test_merged_entities_are_dealt_by_document_once(spark):
    tab = spark.createDataFrame([_ent(1, "Glucose", "a", "t", (1, 0, 2)), _ent(1, "glucose", "b", "t", (2, 0, 1)), _ent(1, "iron", "c", "t", (1, 0, 1)),
                                 _ent(None, "iron", "d", "t", (1, 0, 1))], ENT)
    txt = spark.createDataFrame([_ent(1, "GLUCOSE", "x", "r", (0, 0, 1)), _ent(1, "zinc", "z", "r", (0, 0, 9)), _ent(1, "Zinc", "y", "r", (0, 0, 3)),
                                 _ent(None, "iron", "e", "r", (0, 0, 0)), _ent(2, "iron", "f", "r", (0, 0, 0))], ENT)
    ents = X.merge_entities(tab, txt)
    got = {(r["doc_id"], r["seq"], r["name"], r["value_text"]) for r in ents.collect()}
    assert got == {(1, 0, "iron", "c"), (1, 1, "glucose", "b"), (1, 2, "Zinc", "y"), (None, 0, "iron", "d"), (2, 0, "iron", "f")}
    # text hits alone: the window, the findings and the report by document add no shuffle of them
    rep = V.validation_report(spark.range(3).withColumnRenamed("id", "doc_id"), V.findings(X.merge_entities(None, txt), *Q.rules(spark)))
    plan = rep._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning(doc_id") == 2, plan  # the documents and the hits


def test_notes_have_a_file_for_every_so_many_rows(spark, tmp_path, monkeypatch):
    d = str(tmp_path)
    spark.range(90).selectExpr("id AS o_orderkey").write.parquet(f"{d}/orders.parquet")
    spark.range(300).selectExpr(
        "id % 90 AS l_orderkey", "IF(id = 5, NULL, id) AS l_partkey", "id AS l_suppkey", "CAST(id % 7 AS int) AS l_linenumber",
        "CAST(id % 50 AS double) AS l_quantity", "CAST(id AS double) AS l_extendedprice").write.parquet(f"{d}/lineitem.parquet")
    monkeypatch.setattr(fx, "DEALT_ROWS", 15)
    assert fx.spread_of(spark, d, "lineitem") == 20
    notes, rows = Q.notes(spark, d), Q.trows(spark, d)
    assert len(notes.inputFiles()) > spark.sparkContext.defaultParallelism < len(rows.inputFiles())
    for dealt, plain in ((notes, fx.notes(spark, d)), (rows, fx.table_rows(spark, d))):
        assert sorted(map(str, dealt.collect())) == sorted(map(str, plain.collect()))
    # a line without a part is no row and takes no number: order 5 has the lines 5, 95, 185 and 275
    assert rows.count() == 299 and sorted(r["row_index"] for r in rows.where("doc_id = 5").collect()) == [1, 2, 3]
