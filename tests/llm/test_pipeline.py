import random

import corpus_pipeline
from helpers import documents, sentence


def test_stages_catch_what_they_should(spark, tmp_path):
    r = random.Random(11)
    item = sentence(r, 20)
    passage = sentence(r, 60)
    rows = [(k, "\n".join([sentence(r, 60), sentence(r, 30)]), f"s{k % 3}") for k in range(20)]
    near = rows[0][1].split()
    near[7] = "changed"
    rows += [(50, rows[1][1], "s1"), (51, " ".join(near), "s0"), (52, sentence(r, 30) + " " + item.upper() + " " + sentence(r, 9), "s1"),
             (53, sentence(r, 40) + "\n" + passage, "s2"), (54, sentence(r, 40) + "\n" + passage, "s2"), (55, "too short", "s0"),
             (56, None, "s0"), (57, "w1 " * 100, "s0"), (58, rows[2][1], "s2"), (58, rows[2][1], "s2")]
    documents(spark, rows).write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    docs = spark.read.parquet(str(tmp_path / "documents.parquet"))
    kept = []
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, str(tmp_path))
        assert out.columns == docs.columns and [f.dataType for f in out.schema] == [f.dataType for f in docs.schema], name
        path = str(tmp_path / name.replace(" ", "_"))
        out.write.parquet(path)
        docs = spark.read.parquet(path)
        kept.append({x["doc_id"]: x["text"] for x in docs.collect()})
    assert not {55, 56, 57} & set(kept[0]) and set(range(20)) | {50, 51, 52, 53, 54, 58} == set(kept[0])
    assert not {50, 58} & set(kept[1]) and passage in kept[1][53] and passage not in kept[1][54]
    assert 0 in kept[2] and 51 not in kept[2]
    assert 52 not in kept[3] and set(range(20)) <= set(kept[3])
    pieces = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert {p["doc_id"] for p in pieces} == set(kept[3])
