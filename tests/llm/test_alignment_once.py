"""Texts are encoded once: the result reads what the first pass wrote."""

from barloom.llm import alignment as al


def test_result_does_not_read_the_texts_again(spark):
    docs = spark.createDataFrame([(1, "some text of words"), (2, None)], "doc_id long, text string")
    plan = al.alignment(docs)._jdf.queryExecution().executedPlan().toString()
    assert "FileScan" in plan and "pairs" in plan and "Scan ExistingRDD" not in plan and "LocalTableScan" not in plan
