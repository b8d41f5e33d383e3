"""The pipeline's stages, each on what the one before kept."""

import corpus_pipeline as P
import pytest
from conftest import SMALL
from pyspark.sql import functions as F

from sievework.llm import common, simhash
from sievework.operators import graph


def test_pipeline_end_to_end(spark):
    docs = common.table(spark, SMALL, "documents")
    sizes = [docs.count()]
    for name, stage in P.STAGES[:-1]:
        docs = common.stored(stage(spark, docs, SMALL), name)
        assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"]
        sizes.append(docs.count())
    assert sizes[0] >= sizes[1] >= sizes[2] == sizes[3] > 0
    packed = P.pack(spark, docs, SMALL)
    assert packed.select("doc_id").distinct().count() == sizes[3]
    assert P.run(spark, SMALL).count() == packed.count()


@pytest.fixture(scope="module")
def made(spark):
    words = lambda seed, n: " ".join(f"w{(seed * 7919 + k * 104729 + k * k * seed) % 5003}" for k in range(n))
    shared = words(777, 60)
    rows = [(1, words(1, 200)), (2, words(1, 200)), (3, words(1, 200).replace("w1", "w1", 1) + " tail"), (4, words(4, 150) + " " + shared + " é" + words(44, 50)), (5, words(5, 150) + " " + shared), (6, None), (7, ""), (None, "no id")]
    return spark.createDataFrame([(i, t, "en", "s", len(t or "")) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long").withColumn("extra", F.lit(3)), shared


def test_near_copies_leave_one(spark, made):
    left = {r.doc_id for r in P.drop_near_copies(spark, made[0], SMALL).collect()}
    assert left == {1, 4, 5, 6, None}


def test_repeated_passages_go_and_columns_stay(spark, made):
    docs, shared = made
    got = {r.doc_id: r for r in P.cut_repeats(spark, docs.where("doc_id in (4, 5, 6, 7)"), SMALL).collect()}
    assert all(shared[5:-5] not in (r.text or "") for r in got.values())
    assert got[6].text is None and got[7].text == "" and got[4].extra == 3
    assert got[4].n_chars == len(got[4].text) > 500


def test_stages_take_odd_rows(spark):
    """Nulls everywhere, ties, repeated rows, very long and empty texts, an id that is text in one stage, columns named like results."""
    long = "".join(f"q{k * 7919 % 10007} " for k in range(30_000))
    rows = [(1, None), (2, ""), (3, "a"), (4, "same text here"), (5, "same text here"), (5, "same text here"), (None, "no id"), (7, long), (8, "x" * 5000), (9, " \t\n")]
    docs = spark.createDataFrame([(i, t, None, "s", None) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    clash = ["kept", "n_removed", "n_bytes", "spans", "rest", "block", "id", "component_id", "node", "score", "_null", "_text", "_no_text"]
    docs = docs.select("*", *[F.lit("clash").alias(c) for c in clash])
    kept = {"toxicity": len(rows), "near_dedup": 6, "suffix_dedup": len(rows)}
    for name, stage in P.STAGES[:-1]:
        out = stage(spark, docs, SMALL)
        got = out.collect()
        assert out.columns == docs.columns and len(got) == kept[name] and all(r.kept == r.rest == "clash" for r in got)
        texts = {r.doc_id: r.text for r in got}
        assert texts[1] is None and texts.get(2, "") == "" and (2 in texts) == (name != "near_dedup")
    assert {r.doc_id for r in P.drop_near_copies(spark, docs, SMALL).collect()} == {1, 3, 4, 7, 8, None}
    assert {r.doc_id: len(r.text or "") for r in P.cut_repeats(spark, docs, SMALL).collect()}[8] == 0
    packed = P.pack(spark, docs, SMALL)
    assert packed.where("piece = 0").count() == len(rows)
    named = docs.withColumn("doc_id", F.concat(F.lit("d"), F.col("doc_id")))
    assert {r.doc_id for r in P.drop_near_copies(spark, named, SMALL).collect()} == {"d1", "d3", "d4", "d7", "d8", None}


def test_stages_take_empty_tables(spark, made):
    none = made[0].where("false")
    for _, stage in P.STAGES:
        assert stage(spark, none, SMALL).count() == 0


def test_a_passage_over_fifty_short_words_goes(spark):
    """51 words in under 240 bytes; fifty are left, also next to another repeat."""
    passage = " ".join(str(k) for k in range(100, 151))
    fifty = " ".join(str(k) for k in range(200, 250))
    rows = [(1, "one é " + passage + " two"), (2, passage), (3, f"three {fifty} four"), (4, f"five {fifty}"), (5, " ".join(str(k) for k in range(300, 351)))]
    assert len(passage) < P.PASSAGE
    docs = spark.createDataFrame([(i, t, "en", "s", len(t)) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    got = {r.doc_id: r.text for r in P.cut_repeats(spark, docs, SMALL).collect()}
    assert got == dict(rows) | {1: "one é  two", 2: ""}


def test_near_copies_meet_by_fingerprints_and_are_checked(spark, monkeypatch):
    """Fingerprints that differ in few bits are linked on choices of blocks; shingles decide, also where fingerprints are equal or far apart."""
    line = lambda seed, n: " ".join(f"w{seed}-{k}" for k in range(n))
    again = " ".join(["one two three four five six seven"] * 300)
    texts = {1: line(1, 400), 2: line(1, 400) + " " + line(2, 4), 3: line(3, 200), 4: line(3, 200) + " " + line(4, 45), 5: again + " " + line(5, 30), 6: again + " " + line(6, 30), 7: line(7, 90)}
    fp = {i: simhash.fingerprint(t) for i, t in texts.items()}
    apart = lambda i, j: (fp[i] ^ fp[j]).bit_count()
    assert 0 < apart(1, 2) <= simhash.DISTANCE < apart(3, 4) and apart(5, 6) <= simhash.DISTANCE
    linked = []

    def seen(*args, made=simhash.near_links):
        out = made(*args)
        linked.extend((r.a % 2**64, r.b % 2**64) for r in out.collect())
        return out

    monkeypatch.setattr(simhash, "near_links", seen)
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    assert {r.doc_id for r in P.drop_near_copies(spark, docs, SMALL).collect()} == {1, 3, 5, 6, 7}
    assert {frozenset((fp[1], fp[2]))} <= {frozenset(p) for p in linked}


def test_few_links_take_no_rounds(spark, made, monkeypatch):
    """Rounds over few links filled check_h's disk with files of empty partitions; the same groups come without them, and with them of many."""
    rounds = []

    def counted(df, *args, made=type(made[0]).checkpoint):
        rounds.append(df)
        return made(df, *args)

    monkeypatch.setattr(type(made[0]), "checkpoint", counted)
    groups = lambda: sorted(map(tuple, simhash.similar_components(made[0]).collect()))
    here = groups()
    assert not rounds and (3, 1) in here
    monkeypatch.setattr(simhash, "LINKS_HERE", 0)
    assert groups() == here and rounds


def test_components_in_the_driver_equal_rounds(spark):
    """A chain, a star, copies of an edge, a loop, open ends and no edge at all, also in ids that are no longs."""
    edges = [(i, i + 1) for i in range(-40, 40)] + [(900, i) for i in range(1000, 1100, 7)] + [(7000, 6000), (6000, 7000), (5, 5), (None, 3), (8000, None)]
    df = spark.createDataFrame(edges, "a long, b long")
    for some in (df, df.where("false"), df.selectExpr("string(a) as a", "string(b) as b")):
        here, far = (sorted(map(tuple, graph.connected_components(some, few=n).collect())) for n in (1000, 0))
        assert here == far and len(here) == len({n for n, _ in here})
    assert len(graph.connected_components(df, few=1000).collect()) == 81 + 16 + 2
