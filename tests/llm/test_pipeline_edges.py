"""Every stage on nulls, empty and long texts, repeated rows, clashing columns and empty tables."""

import random

import pytest

import corpus_pipeline

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, node long, kept string, row int, `count` int"


def rows():
    r = random.Random(12)
    words = "the of and to in is that for it was with as on be at by this have from or".split() + [f"stone{k}" for k in range(300)]

    def prose(n):
        return " ".join(" ".join(r.choices(words, k=9)).capitalize() + "." for _ in range(n))

    base = [prose(12) for _ in range(30)]
    out = [(k, t, "en", "s", len(t), k, "x", 1, None) for k, t in enumerate(base)]
    out += [(100, base[3], None, None, None, None, None, None, None), (3, base[3], "en", "s", len(base[3]), 3, "x", 1, None), (101, base[4] + " More.", "en", None, 1, 1, "y", 2, 3)]
    out += [(None, prose(8), None, None, None, None, None, None, None), (102, None, "en", "s", 0, 1, "x", 1, 1), (103, "", "en", "s", 0, 1, "x", 1, 1), (104, prose(3000), "en", "s", 1, 1, "x", 1, 1)]
    return out


@pytest.mark.parametrize("name, stage", corpus_pipeline.STAGES)
def test_stage(spark, tmp_path, name, stage):
    bench = spark.createDataFrame([(1, " ".join(rows()[5][1].split()[:25])), (2, None), (3, "")], "item_id long, text string")
    bench.write.parquet(f"{tmp_path}/benchmark.parquet")
    docs = spark.createDataFrame(rows(), SCHEMA).repartition(3)
    got = stage(spark, docs, str(tmp_path))
    kept = [r.doc_id for r in got.collect()]
    if name != corpus_pipeline.STAGES[-1][0]:
        assert got.columns == docs.columns
    ids = [r[0] for r in rows()]
    if name == "quality classifier":
        assert not {102, 103} & set(kept) and len(kept) > 25
    elif name == "MinHash near-dedup":
        assert sorted(kept, key=str) == sorted(set(ids) - {100, 101}, key=str)
    elif name == "benchmark decontamination":
        assert sorted(kept, key=str) == sorted((i for i in ids if i != 5), key=str)
    else:
        assert sorted(kept, key=str) == sorted(ids, key=str) and got.where("not lossless").count() == 0
    assert stage(spark, docs.where("false"), str(tmp_path)).count() == 0
