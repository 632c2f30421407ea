import corpus_pipeline
from posgraph.llm import packing, quality
from posgraph.llm.common import tokenizer_path

from tokenizers import Tokenizer

from tests.conftest import SF_SMALL
from tests.llm import test_decontaminate, test_exact, test_neardup, test_packing
from tests.llm.util import docs, documents


def test_stages_against_brute_force(spark, tmp_path):
    left, seen = documents(spark), documents(spark).count()
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before = {r["doc_id"]: r for r in left.collect()}
        stage(spark, left, SF_SMALL).write.parquet(str(tmp_path / name))
        left = spark.read.parquet(str(tmp_path / name))
        assert left.columns == ["doc_id", "text", "lang", "source", "n_chars"]
        after = {r["doc_id"]: r for r in left.collect()}
        assert all(before[d] == r for d, r in after.items()) and len(after) <= seen
        pairs = [(d, r["text"]) for d, r in before.items()]
        if name == "exact":
            assert set(after) == {r[0] for r in test_exact.brute(pairs) if r[3]}
        elif name == "near":
            assert set(after) == {r[0] for r in test_neardup.brute(pairs) if r[3]}
        elif name == "quality":
            labels = spark.read.parquet(f"{SF_SMALL}/labels.parquet")
            model = quality.train(documents(spark), labels)
            assert set(after) == {d for d, t in pairs if model.score(quality.features(t)[None, :])[0] >= 0.3}
        elif name == "benchmark":
            def w(t):
                return "".join(c if c.isalnum() else " " for c in t.lower()).split()
            bench = [w(r["text"]) for r in spark.read.parquet(f"{SF_SMALL}/benchmark.parquet").collect()]
            clean = {d for d, t in pairs if not any(
                test_decontaminate.brute_score_fast(i, w(t or "")) >= len(i) for i in bench)}
            assert set(after) == clean
        seen = len(after)
    rows = corpus_pipeline.STAGES[-1][1](spark, left, SF_SMALL).collect()
    test_packing.check(rows, {r["doc_id"]: r["text"] for r in left.collect()})


def test_run_equals_its_stages(spark):
    got = corpus_pipeline.run(spark, SF_SMALL)
    assert got.columns == ["doc_id", "piece", "start", "length", "ids_crc32", "ids", "sequence_id", "offset"]
    left = documents(spark)
    for _, stage in corpus_pipeline.STAGES[:-1]:
        left = stage(spark, left, SF_SMALL)
    want = packing.best_fit(left, tokenizer_path())
    cols = ["doc_id", "piece", "start", "length", "ids_crc32"]
    assert sorted(map(tuple, got.select(*cols).collect())) == sorted(map(tuple, want.select(*cols).collect()))


def test_sequences_hold_the_ids_of_the_tokenizer(spark):
    df = documents(spark).limit(150).unionAll(docs(spark, [(None, "no id"), (None, None), (7, "twice"), (7, "twice")])
                                              .select(documents(spark).columns))
    packed = corpus_pipeline.packing_stage(spark, df, SF_SMALL)
    rows = packed.collect()
    exact = Tokenizer.from_file(tokenizer_path())
    want = sorted((r["doc_id"] or 0, exact.encode(r["text"] or "", add_special_tokens=False).ids + [0]) for r in df.collect())
    seqs = {r["sequence_id"]: r["ids"] for r in packing.sequences(packed).collect()}
    assert all(len(i) <= packing.LENGTH for i in seqs.values())
    assert sum(map(len, seqs.values())) == sum(len(i) for _, i in want) == sum(r["length"] for r in rows)
    assert all(seqs[r["sequence_id"]][r["offset"]:r["offset"] + r["length"]] == r["ids"] for r in rows)
    whole = {d for d, i in want if len(i) <= packing.LENGTH}
    assert sorted((r["doc_id"] or 0, r["ids"]) for r in rows if (r["doc_id"] or 0) in whole) == [w for w in want if w[0] in whole]


def test_odd_rows_and_clashing_columns(spark, tmp_path):
    long = " ".join(f"word{i}" for i in range(9_000))
    good = [(i, f"A plain sentence with words, number {i}. It goes on for a while here.") for i in range(30)]
    df = docs(spark, good + [(50, None), (51, ""), (52, long), (53, long + " end"), (54, good[3][1] + "  "), (2, good[2][1]),
                             (None, "One more plain sentence without an id. It stays as it is.")], clashes=True)
    for t in ("labels", "benchmark"):
        spark.read.parquet(f"{SF_SMALL}/{t}.parquet").write.parquet(str(tmp_path / f"{t}.parquet"))
    for name, stage in corpus_pipeline.STAGES[1:-1]:
        columns = df.columns
        stage(spark, df, str(tmp_path)).write.parquet(str(tmp_path / name))
        df = spark.read.parquet(str(tmp_path / name))
        assert df.columns == columns
    left = sorted(r["doc_id"] if r["doc_id"] is not None else -1 for r in df.collect())
    assert left == [-1, *range(30), 50, 52]  # 51 equals 50, 53 is near 52, 54 equals 3, 2 came twice
    packed = corpus_pipeline.STAGES[-1][1](spark, df, str(tmp_path)).collect()
    assert {r["doc_id"] for r in packed} == {None, *range(30), 50, 52}
    kept = corpus_pipeline.STAGES[0][1](spark, df, str(tmp_path))
    assert kept.columns == df.columns and kept.count() <= len(left)


def test_empty_documents(spark, tmp_path):
    for t in ("documents", "labels", "benchmark"):
        spark.read.parquet(f"{SF_SMALL}/{t}.parquet").limit(0).write.parquet(str(tmp_path / f"{t}.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
