"""Each stage of the pipeline on its own input, against brute force."""

import corpus_pipeline as cp
from tests.llm import test_decontamination as leaks
from tests.llm import test_line_dedup as lines
from tests.llm import test_minhash_dedup as near
from tests.llm import test_mixing as mixing
from tests.llm.common import SF, documents, frame
from wardstat.llm import toxicity
from wardstat.session import scratch_path, stored


def test_stages_in_order(spark):
    docs = spark.read.parquet(SF + "/documents.parquet").limit(120)
    assert [f for _, f in cp.STAGES] == [cp.drop_toxic, cp.drop_lines, cp.drop_near_duplicates, cp.drop_leaks, cp.mix_sources]
    columns, seen = docs.columns, []
    for _, stage in cp.STAGES:
        before = {r.doc_id: r for r in docs.collect()}
        out = stored(stage(spark, docs, SF), scratch_path(spark, "stage"))
        after = {r.doc_id: r for r in out.collect()}
        rows = [(i, r.text) for i, r in before.items()]
        seen.append(len(before) - len(after))
        if stage is not cp.mix_sources:
            assert out.columns == columns
        if stage is cp.drop_toxic:
            lexicon = toxicity.learn_on_training_part(docs, spark.read.parquet(SF + "/labels.parquet"))
            assert set(after) == {i for i, t in rows if lexicon.score(t)[1] < 0.3} and all(after[i] == before[i] for i in after)
        elif stage is cp.drop_lines:
            want = {i: t for i, t, _, _ in lines.brute(rows)}
            assert {i: r.text for i, r in after.items()} == want and all(r.n_chars == len(r.text) for r in after.values())
        elif stage is cp.drop_near_duplicates:
            assert set(after) == {i for i, _, _, kept in near.brute(rows) if kept} and all(after[i] == before[i] for i in after)
        elif stage is cp.drop_leaks:
            bench = [(r.item_id, leaks.tokens(r.text)) for r in spark.read.parquet(SF + "/benchmark.parquet").collect()]
            bad = set()
            for i, t in rows:
                w, own = leaks.tokens(t), set(leaks.tokens(t))
                if any(len(x) >= 5 and sum(y in own for y in x) >= len(x) - len(x) // 5 and leaks.distance(x, w) <= len(x) // 5 for _, x in bench):
                    bad.add(i)
            assert set(after) == set(before) - bad
        else:
            domain = {r.doc_id: r.d for r in docs.select("doc_id", mixing.mixing.stage_settings()[0].alias("d")).collect()}
            full = [(i, r.text, domain[i], r.lang, r.source) for i, r in before.items()]
            want = [w for w in mixing.brute(full, mixing.mixing.stage_settings()[1], (1, 1), 4, 7) if w[-1] > 0]
            assert sorted(map(tuple, out.collect()), key=str) == want
        docs = out
    assert sum(seen) > 0


def test_near_duplicates_from_four_fifths(spark):
    rows = documents()
    for i in range(40):                                     # pairs that share 40 of 50 shingles
        base = " ".join(f"shared{i}x{j}" for j in range(44))
        rows += [(10_000 + 2 * i + k, base + "".join(f" own{i}x{k}x{j}" for j in range(5))) for k in range(2)]
    want = {i for i, _, _, kept in near.brute(rows, 80) if kept}
    assert not want & set(range(10_001, 10_080, 2)) and want < {i for i, _, _, kept in near.brute(rows) if kept}
    assert {r.doc_id for r in cp.drop_near_duplicates(spark, frame(spark, rows), SF).collect()} == want


def test_matches_follow_from_the_similarity():
    assert (near.mh.matches_for(85), near.mh.matches_for(80), near.mh.matches_for(100)) == (42, 37, 64)


def test_empty_documents(spark):
    docs = spark.read.parquet(SF + "/documents.parquet").filter("false")
    for _, stage in cp.STAGES:
        docs = stored(stage(spark, docs, SF), scratch_path(spark, "stage"))
    assert docs.count() == 0
