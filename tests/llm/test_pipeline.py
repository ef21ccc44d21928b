"""Stages of the corpus pipeline on a small messy table: what each keeps."""

import random

import pytest

COLUMNS = "doc_id long, text string, lang string, source string, n_chars long"


def _words(rng, n):
    return " ".join("".join(rng.choice("abcdefghijklmnop") for _ in range(6)) for _ in range(n))


def _rows():
    rng = random.Random(9)
    rows = [(i, "\n".join(_words(rng, 12) for _ in range(4)), "en", "s") for i in range(12)]
    near = rows[0][1].split(" ")
    near[7] = "other"
    rows.append((20, " ".join(near), "en", "t"))            # near copy of 0
    rows.append((21, rows[1][1], "de", None))                # copy of 1
    rows += [(22, None, None, None), (23, "", "en", "s")]
    return [(i, t, lang, s, None if t is None else len(t)) for i, t, lang, s in rows]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(_rows(), COLUMNS)


def test_lines_stage_keeps_the_first_of_each_line(spark, docs):
    from corpus_pipeline import lines

    got = {r.doc_id: r for r in lines(spark, docs, "").collect()}
    texts = {r[0]: r[1] for r in _rows()}
    assert 21 not in got                                     # all its lines are those of 1
    assert all(got[i].text == texts[i] for i in range(12))   # the first of each line stays
    assert got[22].text is None and got[23].text == ""
    assert all(r.text is None or r.n_chars == len(r.text) for r in got.values())
    assert lines(spark, docs, "").columns == docs.columns
    assert lines(spark, docs.limit(0), "").count() == 0


def test_near_duplicates_stage_keeps_one_of_each_group(spark, docs):
    from corpus_pipeline import near_duplicates

    def shingles(text):
        words = (text or "").lower().split()
        return {tuple(words[i: i + 5]) for i in range(max(len(words) - 4, 1))} if words else set()

    sets = {r[0]: shingles(r[1]) for r in _rows()}
    expected = {i for i, own in sets.items() if not any(
        j < i and own and sets[j] and 100 * len(own & sets[j]) >= 80 * len(own | sets[j]) for j in sets)}
    got = near_duplicates(spark, docs, "")
    assert sorted(r.doc_id for r in got.collect()) == sorted(expected) and got.columns == docs.columns
    assert 20 not in expected or len(sets[0] & sets[20]) * 100 < 80 * len(sets[0] | sets[20])
    assert near_duplicates(spark, docs.limit(0), "").count() == 0


def test_benchmark_stage_drops_documents_with_a_passage(spark, docs, tmp_path):
    from pyspark.sql import functions as F

    import corpus_pipeline as pipeline

    item = " ".join(_rows()[3][1].split()[4:34])
    given = spark.read.parquet("/root/testdata/sf0.001/benchmark.parquet")
    text = next(c for c in ("text", "question", "prompt", "passage") if c in given.columns)
    given.limit(1).withColumn(text, F.lit(item)).write.parquet(f"{tmp_path}/benchmark.parquet")
    got = pipeline.benchmark_passages(spark, docs, str(tmp_path))
    assert {r.doc_id for r in got.collect()} == {r[0] for r in _rows()} - {3} and got.columns == docs.columns


def test_stages_are_those_dealt():
    from corpus_pipeline import STAGES

    assert [name for name, _ in STAGES] == ["toxicity", "line dedup", "MinHash near-dedup", "benchmark decontamination", "best-fit packing"]
