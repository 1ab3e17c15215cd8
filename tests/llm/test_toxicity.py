import random
import time

from tests.llm.common import SF, frame
from wardstat.llm import toxicity as tox


def test_folding():
    assert tox.fold("Ѕtup1d, ÍDI0T!  x​y") == " stupid idiot xy " and tox.fold(None) == "  " and tox.fold("2024 a1b") == " 2024 aib "
    assert tox.fold("tr@sh $cum") == " trash scum "


def test_exceptions_shield_and_length_normalises():
    lex = tox.Lexicon({" idiot ": 2.0, " foul": 1.0}, (" the idiot novel ",), (-1.0, 2.0, -0.5))
    assert lex.weigh(tox.fold("an idiot")) == (2.0, 2) and lex.weigh(tox.fold("the Idiot novel")) == (0.0, 3)
    assert lex.weigh(tox.fold("idiot idiot fouling")) == (5.0, 3) and lex.weigh(tox.fold("")) == (0.0, 0)
    assert lex.probability(2.0, 5) > lex.probability(2.0, 500) and 0 < lex.score(None)[1] < 1
    assert tox.Lexicon({}).weigh(" a ") == (0.0, 1)


def planted(n=400):
    rng = random.Random(1)
    rows, labels = [], []
    for i in range(n):
        body = rng.choices([f"w{j}x" for j in range(300)], k=60)
        bad = i % 8 == 0
        if bad:
            body[5] = rng.choice(["zonk", "Ζ0nk", "grumpel" + rng.choice("abc")])
        elif i % 24 == 1:
            body[5:7] = ["zonk", "island"]
        rows.append((i, " ".join(body)))
        labels.append((i, 1, int(bad)))
    return rows, labels


def test_learns_terms_beginnings_and_exceptions(spark):
    rows, labels = planted()
    docs, lab = frame(spark, rows), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    lex = tox.learn_on_training_part(docs, lab, min_odds=1.0)
    assert any(p.startswith(" grum") for p in lex.weights) and " zonk island " in lex.exceptions
    got = {r.doc_id: r.score for r in tox.score(docs, lex).collect()}
    held = [i for i, _, _ in labels if tox_crc(i) % 4 == 2]
    hits = [(got[i] >= 0.3) == (i % 8 == 0) for i in held]
    assert sum(hits) / len(hits) > 0.95


def tox_crc(i):
    import zlib

    return zlib.crc32(str(i).encode())


def test_held_out_labels_on_real_texts(spark):
    docs, lab = spark.read.parquet(SF.replace("0.001", "0.1") + "/documents.parquet"), spark.read.parquet(SF.replace("0.001", "0.1") + "/labels.parquet")
    lex = tox.learn_on_training_part(docs, lab)
    rows = tox.score(docs, lex).join(lab, "doc_id").select("doc_id", "score", "toxic").collect()
    held = [r for r in rows if tox_crc(r.doc_id) % 4 == 2]
    found = sum(r.score >= 0.3 for r in held if r.toxic) / sum(r.toxic for r in held)
    wrong = sum(r.score >= 0.3 for r in held if not r.toxic) / sum(1 - r.toxic for r in held)
    assert found >= 0.9 and wrong <= 0.02


def test_odd_rows_and_no_labels(spark):
    rows = [(1, None), (2, ""), (None, "x"), (3, "a " * 50_000), (3, "a " * 50_000)]
    docs = frame(spark, rows).withColumn("folded", tox.F.lit("f")).withColumn("toxic", tox.F.lit(9))
    lab = spark.createDataFrame([(1, None, None), (None, 1, 1)], "doc_id long, quality int, toxic int")
    lex = tox.learn_on_training_part(docs, lab)
    assert lex.weights == {} and tox.score(docs, lex).count() == 5
    assert sorted(tox.reject_toxic(docs, lex).columns) == sorted(docs.columns) and tox.reject_toxic(docs, lex).count() == 5
    assert tox.score(frame(spark, []), lex).collect() == []


def test_weights_against_a_naive_matcher():
    rng = random.Random(2)
    for _ in range(300):
        terms = {" " + "".join(rng.choice("ab") for _ in range(rng.randrange(1, 4))) + rng.choice(["", " "]): rng.random() for _ in range(4)}
        phrases = tuple({f" {rng.choice(['a', 'ab', 'b'])} {rng.choice(['a', 'ba', 'bb'])} " for _ in range(3)} - set(terms))
        folded = " " + " ".join("".join(rng.choice("ab") for _ in range(rng.randrange(1, 4))) for _ in range(30)) + " "
        places = lambda p: [i for i in range(len(folded)) if folded.startswith(p, i)]
        shields = [(i, i + len(p)) for p in phrases for i in places(p)]
        want = sum(w for p, w in terms.items() for i in places(p) if not any(x <= i and i + len(p) <= y for x, y in shields))
        got, n = tox.Lexicon(terms, phrases).weigh(folded)
        assert abs(got - want) < 1e-9 and n == 30


def test_very_long_texts_take_linear_time():
    lex = tox.Lexicon({" idiot ": 2.0}, (" the idiot novel ",))
    t0 = time.time()
    assert lex.weigh(" " + "the idiot novel an idiot x " * 70_000)[0] == 140_000.0
    assert time.time() - t0 < 10


def test_copies_with_different_labels_do_not_depend_on_partitions(spark):
    rows, labels = planted()
    copies = [(10_000 + i, t) for i, t in rows[:160]]
    lab = spark.createDataFrame(labels + [(10_000 + i, 1, i % 2) for i in range(160)], "doc_id long, quality int, toxic int")
    one, many = (tox.learn_on_training_part(frame(spark, rows + copies).repartition(k), lab.repartition(k), min_odds=1.0) for k in (1, 17))
    assert one.weights == many.weights and one.exceptions == many.exceptions and one.curve == many.curve
