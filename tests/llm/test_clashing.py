"""Pipeline filters keep every column as it is, also columns named like their helper columns."""

from pyspark.sql import functions as F

from scorelake.llm import cotrain, decontaminate, simhash

SF = "/root/testdata/sf0.001"
CLASH = ["__quality", "__fp", "__row", "__hits", "__n_words", "__items", "__id", "__QUALITY_"]


def test_filters_with_clashing_columns(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    odd = docs.withColumns({c: F.concat(F.lit(f"{c}-"), F.col("doc_id").cast("string")) for c in CLASH})
    model = cotrain.fit(docs, spark.read.parquet(f"{SF}/labels.parquet"))
    bench = spark.read.parquet(f"{SF}/benchmark.parquet")
    for keep in (lambda d: cotrain.keep_good(d, model), simhash.keep_one, lambda d: decontaminate.decontaminate(d, bench)):
        plain = {r["doc_id"] for r in keep(docs).select("doc_id").collect()}
        got = keep(odd)
        assert got.columns == odd.columns
        rows = got.collect()
        assert {r["doc_id"] for r in rows} == plain
        for r in rows:
            assert all(r[c] == f"{c}-{r['doc_id']}" for c in CLASH)
