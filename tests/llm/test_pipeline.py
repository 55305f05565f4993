"""The pipeline's stages, each on the rows its predecessor kept, against plain versions."""

import duckdb
import public_tokenizers
from fixtures import DATA, odd_docs
from test_simhash import plain_components, plain_print
from tokenizers import Tokenizer

import corpus_pipeline
from tidemark.llm import decontaminate, quality


def test_stages_on_a_small_folder(spark, tmp_path):
    con = duckdb.connect()
    con.execute(f"COPY (SELECT * FROM '{DATA}/documents.parquet' WHERE doc_id < 60) TO '{tmp_path}/part.parquet'")
    con.execute(f"COPY (SELECT * FROM '{DATA}/benchmark.parquet') TO '{tmp_path}/benchmark.parquet'")
    docs = spark.read.parquet(f"{tmp_path}/part.parquet")
    items = [tuple(r) for r in spark.read.parquet(f"{tmp_path}/benchmark.parquet").select("item_id", "text").collect()]
    leaked = [(1000 + i, f"{' '.join(f'word{j}x{i}' for j in range(70))} {items[i][1]}", "en", "src", None) for i in range(3)]
    copies = [(2000 + r.doc_id, r.text, r.lang, r.source, r.n_chars) for r in docs.limit(5).collect()] + [(None, None, None, None, None), (3000, "", None, None, 0)]
    docs = docs.union(spark.createDataFrame(leaked + copies, docs.schema))
    folder = str(tmp_path)
    docs.write.parquet(f"{folder}/documents.parquet")
    before = docs.collect()
    steps = [before]
    for name, stage in corpus_pipeline.STAGES:
        df = stage(spark, spark.createDataFrame(steps[-1], docs.schema), folder)
        steps.append(df.collect())
        if name != "tokens":
            assert df.columns == docs.columns
    cleaned, lined, near, clean, coded = steps[1:]
    assert sorted(r.doc_id for r in cleaned) == sorted(r.doc_id for r in before if quality.measures(r.text)[6])
    assert {r.doc_id: r.text for r in cleaned} == {r.doc_id: quality.measures(r.text)[9] for r in before if quality.measures(r.text)[6]}
    assert sorted(r.doc_id for r in lined) == sorted(r.doc_id for r in cleaned)
    groups = plain_components([plain_print(r.text) for r in lined])
    want = {}
    for r in lined:
        g = groups[plain_print(r.text)]
        want[g] = min(want.get(g, r.doc_id), r.doc_id)
    assert sorted(r.doc_id for r in near) == sorted(want.values())
    block = decontaminate.block_of(items, decontaminate.Q, decontaminate.EDIT_RATE)
    assert sorted(r.doc_id for r in clean) == sorted(r.doc_id for r in near if not decontaminate.matches(r.text, block))
    assert not {1000, 1001, 1002} & {r.doc_id for r in clean} and {1000, 1001, 1002} <= {r.doc_id for r in near}
    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    text = {r.doc_id: r.text for r in clean}
    assert sorted(r.doc_id for r in coded) == sorted(text)
    for r in coded:
        assert r.ids == library.encode(text[r.doc_id], add_special_tokens=False).ids and r.n_tokens == len(r.ids) and r.round_trip
    whole = corpus_pipeline.run(spark, folder).collect()
    assert sorted((r.doc_id, r.n_tokens) for r in whole) == sorted((r.doc_id, r.n_tokens) for r in coded)


def test_odd_and_empty_tables(spark, tmp_path):
    folder = str(tmp_path)
    odd = odd_docs(spark)
    odd.write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame([(1, None), (2, "")], "item_id bigint, text string").write.parquet(f"{folder}/benchmark.parquet")
    assert corpus_pipeline.run(spark, folder).count() >= 0
    empty = odd.limit(0)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, empty, folder).count() == 0
