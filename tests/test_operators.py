"""Hand-worked rows and properties of the operators that SQL does not express."""

import json
import random
import re

import duckdb
import numpy as np
import pandas as pd
import pytest
from conftest import SMALL
from pyspark.sql import functions as F

from sievework.functions import dates
from sievework.functions import geometry as G
from sievework.functions import text as X
from sievework.operators import graph, planning, quotas, ranking, search, similarity, tables
from sievework.plans import registry
from sievework.sources import files


def one(spark, column, **values):
    df = spark.createDataFrame([tuple(values.values())], list(values)) if values else spark.range(1)
    return df.select(column.alias("r")).first()["r"]


def test_terms_and_ranges():
    assert search.split_terms("red|+blue+ car") == [["red", " blue "], ["car"]]
    assert search.parse_range("2-5") == (2, 5) and search.parse_range("7") == (7, 7)
    with pytest.raises(ValueError):
        search.parse_range("5-2")
    assert search.parse_boolean("a AND b c".split()) == [["a", "b"], ["c"]]
    for bad in ("AND a", "a OR", "a AND OR b", ""):
        with pytest.raises(ValueError):
            search.parse_boolean(bad.split())
    assert search.slug("Red|blue+Car!!") == "red-blue-car"


def test_search_null_text_and_words(spark):
    df = spark.createDataFrame([(1, None), (2, "Cowboys ride"), (3, "a nightingale"), (4, "night owl"), (5, "Überall night-time")], "doc_id int, text string")
    ids = lambda c: {r.doc_id for r in df.where(c).collect()}
    assert ids(search.search_terms(F.col("text"), "cowboy")) == {2}
    assert ids(search.exclude_words(F.col("text"), "night")) == {1, 2, 3}
    with pytest.raises(ValueError):
        search.run_search(df, search.DatasetSpec("d", "*", ("text",)), {"limit": 0})
    with pytest.raises(ValueError):
        search.run_search(df, search.DatasetSpec("d", "*", ("missing",)), {})


def test_pages_concatenate(spark):
    spec = search.DatasetSpec("d", "documents.parquet", ("text",), extras={"doc_id": "doc_id"}, order=("doc_id",))
    df = spark.read.parquet(spec.path(SMALL))
    page = lambda start: [r.doc_id for r in search.run_search(df, spec, {"start": start, "limit": 70}).collect()]
    assert page(0) + page(70) + page(140) == [r.doc_id for r in search.run_search(df, spec, {}).collect()]


def test_best_copy_lead_and_ties(spark):
    def pick(rows):
        pdf = pd.DataFrame(rows, columns=["tier", "score", "role", "captioned", "age", "path"])
        df = spark.createDataFrame(pdf.assign(g=1))
        path = ranking.choose_best_copies(df, "g").first()["path"]
        assert pdf["path"][ranking.best_copy(pdf)] == path
        return path

    assert pick([(3, 5.0, 1, True, 1, "a"), (2, 7.9, 1, True, 1, "b")]) == "a"
    assert pick([(3, 5.0, 1, True, 1, "a"), (2, 8.0, 1, True, 1, "b")]) == "b"
    assert pick([(3, 5.0, 1, True, 1, "a"), (2, 7.0, 1, True, 1, "b"), (1, 8.0, 1, True, 1, "c")]) == "c"
    assert pick([(3, 5.0, 1, True, 1, "a"), (2, 8.0, 1, True, 1, "b"), (1, 10.0, 1, True, 1, "c")]) == "b"
    assert pick([(3, 5.0, 2, True, 1, "a"), (3, 4.95, 1, True, 1, "b")]) == "b"
    assert pick([(3, 5.0, 1, False, 1, "a"), (3, 5.0, 1, True, 9, "b")]) == "b"


def test_gap_tiers_cut_at_the_largest_gap(spark):
    df = spark.createDataFrame([(i, s) for i, s in enumerate([10.0, 9.9, 9.8, 9.0, 5.0, 4.9, 4.8, 4.7])], "id int, score double")
    got = {r.id: r.tier for r in ranking.gap_tiers(df, "score", "id", 2).collect()}
    assert [got[i] for i in range(8)] == [1, 1, 1, 1, 2, 2, 2, 2]


def test_largest_remainder_sums_and_caps(spark):
    rng = random.Random(2)
    for total in (1, 7, 50, 10_000):
        counts = [(f"k{i}", rng.randrange(1, 60)) for i in range(9)]
        got = quotas.largest_remainder(spark.createDataFrame(counts, "key string, n long"), "key", "n", total).collect()
        assert sum(r.quota for r in got) == min(total, sum(n for _, n in counts)) and all(r.quota <= r.n for r in got)


def test_bucket_merge():
    b = pd.DataFrame([(1, 1024, 768, 20), (1, 1024, 704, 3), (1, 768, 1024, 2), (2, 512, 384, 9)], columns=["tier", "width", "height", "n"])
    out = quotas.merge_small_buckets(b)
    assert out["to"].tolist() == [0, 0, 2, 3]
    two = pd.DataFrame([(1, 640, 512, 5), (1, 640, 480, 4)], columns=["tier", "width", "height", "n"])
    assert quotas.merge_small_buckets(two)["n_after"].tolist() == [9, 0]


def test_shard_plan_and_year_bands():
    counts, children = {0: 100, 1: 60, 2: 30}, {0: [1, 2]}
    assert quotas.shard_plan(counts, children, 0, most=70) == [{"region": 1, "exclude": [], "rows": 60}, {"region": 2, "exclude": [], "rows": 30}, {"region": 0, "exclude": [1, 2], "rows": 10}]
    bands = quotas.year_bands(lambda a, b: 10 * (b - a + 1), 1900, 1909, most=30)
    assert bands[0][0] == 1900 and bands[-1][1] == 1909 and all(b - a < 3 for a, b in bands)


def test_components_and_steps(spark):
    rng = random.Random(4)
    edges = [(rng.randrange(300), rng.randrange(300)) for _ in range(220)] + [(1000 + i, 1001 + i) for i in range(40)]
    root = {}

    def find(x):
        root.setdefault(x, x)
        while root[x] != x:
            x = root[x]
        return x

    for a, b in edges:
        x, y = find(a), find(b)
        root[max(x, y)] = min(x, y)
    df = spark.createDataFrame(edges, "a long, b long")
    got = {r.node: r.component for r in graph.connected_components(df).collect()}
    assert got == {x: find(x) for x in root if any(x in e and e[0] != e[1] for e in edges)}
    path = spark.createDataFrame([(i, i + 1) for i in range(6)], "a long, b long")
    steps = similarity.steps_from(path, spark.createDataFrame([(0,)], "node long"))
    assert {r.node: r.steps for r in steps.collect()} == {i: i for i in range(7)}
    assert graph.connected_components(df.where("false")).count() == 0


def test_steps_reach_the_end_of_a_long_chain(spark):
    path = spark.createDataFrame([(i, i + 1) for i in range(54)], "a long, b long").coalesce(1)
    steps = similarity.steps_from(path, spark.createDataFrame([(0,)], "node long"))
    assert {r.node: r.steps for r in steps.collect()} == {i: i for i in range(55)}


def test_neighbours_do_not_depend_on_blocks(spark):
    v = spark.read.parquet(f"{SMALL}/embeddings.parquet").select(F.col("vec_id").alias("id"), "embedding")
    a, b = (similarity.cosine_neighbours(v, v, "id", "embedding", 4, blocks=n).collect() for n in (1, 7))
    key = lambda rows: sorted((r.id, r.other, round(r.cos, 9)) for r in rows)
    assert key(a) == key(b)


def test_verdict_precedence(spark):
    t, f = F.lit(True), F.lit(False)
    v = lambda *c: one(spark, similarity.pair_verdict(*c))
    assert v(f, t, t, t, t, t) == "UNHASHED" and v(t, t, t, t, t, t) == "FLAT" and v(t, f, t, t, t, t) == "COLOUR"
    assert v(t, f, f, t, t, t) == "HASH" and v(t, f, f, f, t, t) == "MIRROR" and v(t, f, f, f, f, t) == "WIN" and v(t, f, f, f, f, f) == "FAR"
    assert one(spark, similarity.verified(t, F.lit(10), F.lit(0.5), F.lit(0.9))) is False
    assert one(spark, similarity.verified(t, F.lit(None).cast("int"), F.lit(0.5), F.lit(0.9))) is True


def test_text_functions(spark):
    t = lambda c, s: one(spark, c(F.col("s")), s=s)
    assert t(lambda c: X.sentences(c, X.ENGLISH_ABBREVIATIONS), "Dr. Smith came. He left! why? No. 5 is here. End") == ["Dr. Smith came.", "He left! why?", "No. 5 is here.", "End"]
    assert t(X.trim_questions, "Really? Yes it is. Is it?") == "Yes it is." and t(X.trim_questions, "Only this?") == "Only this?"
    assert t(lambda c: X.truncate_words(c, 4), "One two. Three four. Five.") == "One two. Three four."
    assert t(lambda c: X.cut_before_sentence(c, "watermark"), "Nice hill. It has a Watermark. More.") == "Nice hill."
    assert t(lambda c: X.cut_before_script(c), "English one. Это русский. More.") == "English one."
    assert t(X.transliterate, "Щука ЩУКА é ж") == "Shchuka SHCHUKA e zh"
    assert t(X.drop_medium, "A monochrome old house") == "An old house" and t(X.drop_medium, "An old house") == "An old house"
    assert t(X.ascii_url, "http://bücher.de/ä b?q=é") == "http://xn--bcher-kva.de/%C3%A4%20b?q=%C3%A9"
    assert t(X.first_json, 'x [bad] {"a": [1, 2]} y') == '{"a":[1,2]}' and t(X.first_json, "none") is None
    assert t(X.decode_entities, "a &eacute; &#65;") == "a é A"
    assert json.loads(t(X.drop_paths, '{"a": "C:\\\\x", "b": {"c": "/home/u", "d": 1}, "e": ["/root/z", "k"]}')) == {"b": {"d": 1}, "e": ["k"]}
    assert t(X.drop_emoji, "hi \U0001f600  there") == "hi there"
    assert [r.n for r in spark.createDataFrame([("img10",), ("img2",), ("Img1",)], "n string").orderBy(X.natural_key(F.col("n"))).collect()] == ["Img1", "img2", "img10"]


def test_bucket_grid_and_tiers(spark):
    assert [len(G.bucket_grid(r)) for r in (1024, 768, 512)] == [65, 49, 33]
    assert (1184, 880) in G.bucket_grid(1024) and (1168, 880) not in G.bucket_grid(1024)
    sizes = spark.createDataFrame([(2400, 600), (640, 480), (400, 300)], "w long, h long")
    got = [r.t for r in sizes.select(G.assign_tier(F.col("w"), F.col("h")).alias("t")).collect()]
    assert (got[0].tier, got[0].bw, got[0].bh) == (768, 1024, 576)
    assert (got[1].tier, got[1].bw, got[1].bh) == (512, 560, 464)
    assert got[2] is None


def test_captions_by_hand(spark):
    t = lambda c, s: one(spark, c(F.col("s")), s=s)
    assert t(X.clean_import_caption, "A hill , see www.a.b/c #tag\r\n---\n@user\nmail a@b") == "A hill, see\nmail a@b"
    assert t(X.strip_russian_medium, "Text., Цветная фотография. Это чёрно-белый снимок, цветной") == "Text., Фотография. Это снимок,"
    assert t(X.strip_russian_medium, "Цветная no tail") == "Цветная no tail"
    p = X.budgeted_prefix(20)
    assert one(spark, p(F.col("s")), s=["root", "middle name", "deepest folder"]) == "root__middle_n"
    assert one(spark, p(F.col("s")), s=["root", "sub"]) == "root__sub"


def test_tables(spark):
    log = spark.createDataFrame([(1, 1, "a", "done"), (2, 1, "b", "done"), (3, 2, "a", "done"), (4, 2, "a", "undo"), (5, 1, "b", "done"), (6, 3, "c", "done"), (7, 3, None, "undo_run")], "seq int, run int, item string, kind string")
    assert {(r.item, r.seq) for r in planning.latest_done(log, "item", "seq", "run", "kind").collect()} == {("a", 1), ("b", 5)}
    old = spark.createDataFrame([(1, "x")], "k int, v string")
    new = spark.createDataFrame([(1, "y"), (2, None)], "k int, v string")
    assert {(r.k, r.v) for r in tables.upsert(old, new, ["k"], ["v"]).collect()} == {(1, "y"), (2, None)}
    assert {(r.k, r.v) for r in tables.insert_ignore(old, new, ["k"]).collect()} == {(1, "x"), (2, None)}
    assert one(spark, planning.choose_priority(F.col("p"), 0.1), p=[0.3, 0.35, 0.2]) == 0


def test_folder_scan_and_arrow_files(spark, tmp_path):
    import pyarrow as pa

    (tmp_path / "d").mkdir()
    (tmp_path / "d" / "A.JPG").write_bytes(b"\xff\xd8\xff")
    (tmp_path / "d" / "a.txt").write_text("caption")
    g = files.sidecar_groups(files.scan_folder(spark, str(tmp_path))).collect()
    assert len(g) == 1 and len(g[0].sidecars) == 1
    t = pa.table({"x": [1, 2, 3]})
    with pa.OSFile(str(tmp_path / "s.arrow"), "wb") as f, pa.ipc.new_stream(f, t.schema) as w:
        w.write_table(t)
    assert sorted(r.x for r in files.read_arrow_streams(spark, str(tmp_path / "s.arrow"), "x long").collect()) == [1, 2, 3]


def test_result_does_not_depend_on_partitions(spark):
    from sievework.plans import registry

    q = registry.queries()["w04_floor_and_percent"]
    got = []
    for n in ("1", "7"):
        spark.conf.set("spark.sql.shuffle.partitions", n)
        got.append(sorted(map(tuple, q(spark, SMALL).collect())))
    spark.conf.set("spark.sql.shuffle.partitions", "4")
    assert got[0] == got[1]


@pytest.mark.parametrize("name, column", [("x06_import_caption", "caption"), ("x17_cut_before_phrase", "t"), ("x18_cut_before_script", "t")])
def test_caption_queries_take_whole_texts(spark, name, column):
    from sievework.plans import registry

    texts = {r.doc_id: r.text for r in registry.load(spark, SMALL, "documents").collect() if r.text}
    got = {r.doc_id: r[column] or "" for r in registry.queries()[name](spark, SMALL).collect()}
    long = {i: " ".join(t.split()[-3:]) for i, t in texts.items() if len(t) > 600 and re.fullmatch(r"[A-Za-z ]+", " ".join(t.split()[-3:]).rstrip("."))}
    kept = sum(" ".join(last.rstrip(".").split()) in " ".join(got[i].split()) for i, last in long.items())
    assert len(long) > 50 and kept > 0.9 * len(long)


def test_numbers_over_the_whole_table(spark):
    df = spark.createDataFrame([((k * 37) % 101, k) for k in range(500)] + [(None, 500)], "a int, k int").repartition(7)
    got = {r.k: r.n for r in tables.numbered(df, [F.col("a").desc(), F.col("k")], "n").collect()}
    want = sorted(range(501), key=lambda k: (k == 500, -((k * 37) % 101) if k < 500 else 0, k))
    assert [got[k] for k in want] == list(range(1, 502))
    assert tables.numbered(df.where("false"), [F.col("k")], "n").count() == 0


def test_russian_text_rules(spark):
    t = lambda c, s: one(spark, c(F.col("s")), s=s)
    assert t(X.sentences, "Дом на ул. Ленина, 1905 г. Снимок А. С. Петрова. «Вид.» Мост… Река!") == ["Дом на ул. Ленина, 1905 г. Снимок А. С. Петрова.", "«Вид.»", "Мост…", "Река!"]
    assert t(X.sentences, "Он ушёл. она нет. (Да.) — Нет") == ["Он ушёл. она нет.", "(Да.)", "— Нет"]
    assert t(X.trim_questions, "Это мост через реку, правда? Где он?") == "Это мост через реку."
    assert t(X.trim_questions, "Что это? Мост.") == "Что это? Мост." and t(X.trim_questions, "Старый мост тут!") == "Старый мост тут!"
    assert t(X.trim_questions, "Узнали? Старый мост через реку!") == "Старый мост через реку."
    assert t(X.transliterate, "Ёж ЖУК Їжак ґ ў Щ") == "Yozh ZHUK Yizhak g u Shch"
    assert t(X.transliterate, "и\u0306ö日") == "yo_"
    assert t(X.repair_homoglyphs, "Cтapый, cat (Mocквa) ĸoт_1") == "Старый, cat (Москва) кот_1"
    lines = lambda c: X.strip_footer(F.split(c, "\n"), lambda x: X.footer_line(x, "Старый Город", F.array(F.lit("ещё тут"))))
    assert t(lines, "Текст\nСтарый город\nещё\n\nСТАРЫЙ ГОРОД | фото\nещё тут:\nhttp://a.b/c\nПодписывайтесь!") == ["Текст", "Старый город", "ещё"]
    assert t(lines, "Переходите " + "слово " * 12) == ["Переходите " + "слово " * 12]
    assert t(X.description, "Вид. С разрешения автора. Мост<br>www.x.y<br/>Точка поставлена условно. Река ,;") == "Вид. Мост Река"
    assert t(lambda c: X.description(F.nullif(c, F.lit("none"))), "none") == ""
    assert t(X.strip_markup, "<p>A &amp; B</p>----- www.a.b ,c<br>;") == "A & B ,c"
    assert t(lambda c: X.cap_text(c, 12), "one two, three four") == "one two..." and t(lambda c: X.cap_text(c, 50), "one two,") == "one two,"


def test_whole_texts_are_taken(spark):
    from sievework.plans import registry

    sql = registry.oracle_sql()
    for name in ("x04_result_slug", "x05_social_caption", "x08_drop_segments", "x32_model_reply"):
        assert "left(text" not in sql[name]


def brute_tiers(rows, tiers, window=0.25):
    """Tiers by borders found one by one at the largest gap near each ideal place."""
    order = sorted(rows, key=lambda r: (-r[1], r[0]))
    n, borders, before = len(order), [], 0
    for i in range(1, tiers):
        ideal, reach = n * i / tiers, max(1, int(n / tiers * window))
        places = range(max(before + 1, int(ideal) - reach), min(n - 1, int(ideal) + reach) + 1)
        if places:
            before = max(places, key=lambda k: (order[k - 1][1] - order[k][1], -abs(k - ideal)))
            borders.append(before)
    return {ident: 1 + sum(k > b for b in borders) for k, (ident, _) in enumerate(order, 1)}


def test_score_and_sort_equals_brute_force(spark):
    from sievework.plans import registry

    parts = registry.load(spark, SMALL, "part").collect()
    want = brute_tiers([(p.p_partkey, p.p_retailprice + p.p_size * 3) for p in parts], 5)
    placed = {p.p_partkey: p.p_brand for p in parts}
    got = registry.queries()["c05_score_and_sort"](spark, SMALL).collect()
    assert {r.id: r.tier for r in got} == want and set(want.values()) == {1, 2, 3, 4, 5}
    assert all(r.stale == (placed[r.id] != f"Brand#{r.tier}") for r in got)


def test_first_of_no_sentences(spark, tmp_path):
    rows = spark.createDataFrame([(1, ""), (2, " \n\t"), (3, None), (4, "One. Two.")], "doc_id long, text string")
    rows.write.parquet(str(tmp_path / "documents.parquet"))
    got = {r.doc_id: (r.n, r["first"]) for r in registry.queries()["x14_sentences"](spark, str(tmp_path)).collect()}
    assert got == {1: (0, None), 2: (0, None), 3: (None, None), 4: (2, "One.")}


def test_subject_of_equal_scores_spoke_first(spark, tmp_path):
    rows = [(c, t, role, "x" * 100) for c in range(40) for t, role in enumerate(("user", "assistant", "system") if c % 2 else ("system", "assistant", "user"))]
    rows += [(40, 0, None, "long " * 100), (40, 1, "user", "short"), (41, 0, "system", None), (41, 1, "user", "")]
    spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(7, "text", "turn").write.parquet(str(tmp_path / "conversations.parquet"))
    got = {r.conv_id: r.subject for r in registry.queries()["c11_subject_choice"](spark, str(tmp_path)).collect()}
    assert got == {c: "user" if c % 2 or c == 40 else "system" for c in range(42)}


def test_ledger_keeps_values_of_one_moment(spark, tmp_path):
    rows = spark.sql("select timestamp_ntz'2024-01-01 10:00:00' as ts, 'view' as event_type, v as value from values (1.5D), (200D), (200D), (3D) t(v)")
    rows.write.parquet(str(tmp_path / "events.parquet"))
    assert [tuple(r)[1:] for r in registry.queries()["d15_ledger_seed"](spark, str(tmp_path)).collect()] == [("view", 3, 2)]


def test_years_beyond_four_digits(spark):
    at = {253402300799: "9999-12-31", 253402300800: "10000-01-01", 520000000000: "18448-02-22", -50000000000: "0385-07-25", -62167219201: "-1-12-31"}
    df = spark.createDataFrame([(k,) for k in at], "s long").select("s", dates.month_of(F.col("s")).alias("month"), dates.iso_day(F.col("s")).alias("day"))
    assert {r.s: (r.month, r.day) for r in df.collect()} == {k: (v[:-3], v) for k, v in at.items()}


def test_neighbours_of_equal_and_empty_vectors(spark, tmp_path):
    rng = np.random.default_rng(5)
    v = rng.standard_normal((700, 64), dtype=np.float32)
    v[rng.permutation(700)[:60]] = v[3]
    v[[10, 500]] = 0
    v[[20, 30]] = v[3] * 2, v[40]
    pd.DataFrame({"vec_id": rng.permutation(700).astype("int64"), "embedding": list(v), "label": np.arange(700, dtype="int32") % 5}).to_parquet(tmp_path / "embeddings.parquet")
    duck = duckdb.connect()
    duck.execute(f"create view embeddings as select * from '{tmp_path}/embeddings.parquet'")
    for name in ("j14_cosine_neighbours", "j14_symmetric_pairs", "m03_vote_shares"):
        df = registry.queries()[name](spark, str(tmp_path))
        want = duck.execute(f"select {', '.join(df.columns)} from ({registry.oracle_sql()[name]})").fetchall()
        assert sorted(repr(tuple(r)) for r in df.collect()) == sorted(map(repr, want))


def test_tiles_send_few_copies(spark):
    n = 300_000
    q, b = similarity._in_tiles(spark.range(n), spark.range(n))
    assert q.count() <= 3 * n and b.count() <= 12 * n
    assert q.select("g", "b").distinct().count() == b.select("g", "b").distinct().count()


def test_steps_over_branches_and_rings(spark):
    rng = random.Random(6)
    pairs = {(i, rng.randrange(max(0, i - 3), i)) for i in range(1, 90)} | {(0, 7), (20, 41), (5, 80)}
    near = {i: {b for e in pairs for a, b in (e, e[::-1]) if a == i} for i in range(90)}
    want, front = {0: 0}, [0]
    while front:
        front = [b for a in front for b in near[a] if want.setdefault(b, want[a] + 1) == want[a] + 1]
    df = spark.createDataFrame(sorted(pairs), "a long, b long").coalesce(1)
    got = similarity.steps_from(df, spark.createDataFrame([(0,)], "node long")).collect()
    assert {r.node: r.steps for r in got} == want and len(got) == 90


def test_pairs_of_codes(spark):
    rng = random.Random(8)
    codes = {i * 3 - 50: rng.choice((0, -1, rng.getrandbits(63), -rng.getrandbits(63), -(7 << 60))) for i in range(400)}
    df = spark.createDataFrame([*codes.items(), (9999, None)], "id long, h long")
    dist = {(a, b): ((codes[a] ^ codes[b]) & (1 << 64) - 1).bit_count() for a in codes for b in codes if a < b}
    for most in (3, 22):
        got = similarity.hamming_pairs(df, "id", "h", most).select("a", "dist", "b").collect()
        assert sorted((r.a, r.b, r.dist) for r in got) == sorted((a, b, d) for (a, b), d in dist.items() if d <= most)
    near = [sorted((d, a, b) for (a, b), d in dist.items() if i in (a, b) and d <= 22)[:5] for i in codes]
    got = similarity.nearest_pairs(df, "id", "h", 5, 22).collect()
    assert sorted((r.dist, r.a, r.b) for r in got) == sorted(set(sum(near, [])))


def test_only_winners_leave_a_tile(spark):
    df = spark.range(3000).select("id", F.lit(5).cast("long").alias("h"))
    near = similarity.hamming_neighbours(df, "id", "h", 3, 22)
    assert near.count() == 9000 and near.where("dist > 0 or other > 3").count() == 0


def test_sentences_are_cut_once(spark):
    df = spark.createDataFrame([("One two three. Really? Fine, right?",), ("Is it? No.",), ("Plain one.",), ("",), (None,)], "text string")
    trimmed, cut = X.trim_questions(F.col("text")), X.cut_before_script(F.concat("text", F.lit(" Last. \u0416 end. Not. \u0416")))
    assert [r.t for r in df.select(trimmed.alias("t")).collect()] == ["One two three.", "Is it? No.", "Plain one.", "", None]
    assert [r.t for r in df.select(cut.alias("t")).collect()] == ["One two three. Really? Fine, right? Last.", "Is it? No. Last.", "Plain one. Last.", "Last.", None]
    for column in (trimmed, cut):
        plan = df.select(column.alias("t"))._jdf.queryExecution().optimizedPlan().toString()
        assert plan.count("split(") == 1


def test_csv_goes_to_parts(spark, tmp_path):
    rows = spark.range(120_001).select(F.col("id").alias("doc_id"), F.concat(F.lit('a "b",\n'), F.col("id").cast("string")).alias("text"))
    for name, write in (("result", lambda p: search.write_result(rows.coalesce(1), p, {}, {})), ("manifest", lambda p: files.write_manifest(rows.coalesce(1), p))):
        path = str(tmp_path / name)
        write(path)
        sizes = [spark.read.option("header", True).option("escape", '"').option("multiLine", True).csv(str(p)).count() for p in (tmp_path / name).glob("part-*.csv")]
        assert sorted(sizes) == [20_001, 50_000, 50_000]
        back = files.read_manifest(spark, path, "doc_id long, text string")
        assert back.exceptAll(rows).isEmpty() and back.count() == 120_001
    assert search.write_result(rows, str(tmp_path / "one"), {}, {}, single=True) == 120_001 and len(list((tmp_path / "one").glob("part-*.csv"))) == 1


def test_strata_are_cut_before_they_meet(spark):
    df = spark.range(5000).select("id", F.when(F.col("id") % 3 == 0, "R").otherwise("N").alias("mode"), (F.col("id") % 4).alias("y"), (F.col("id") % 50).cast("double").alias("area"))
    out = quotas.stratified_target(df, "mode", "y", "area", "id", 100, "R", 0.6)
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2
    rows = [r.asDict() for r in df.collect()]
    want = set()
    for mode, n in (("R", 60), ("N", 40)):
        for y in range(4):
            pool = sorted((r for r in rows if r["mode"] == mode and r["y"] == y), key=lambda r: (-r["area"], r["id"]))
            want |= {r["id"] for r in pool[: n // 4]}
    assert {r.id for r in out.collect()} == want


def test_bytes_that_are_utf8_stay_out_of_python(spark):
    texts = {b"plain": "plain", "\ufeffмир😀".encode(): "мир😀", "мир".encode("utf-16"): "мир",
             b"\xfe\xff" + "м😀".encode("utf-16-be"): "м😀", "мир".encode("cp1251"): "мир", b"\xff\xfe\x00\xd8": "\ufffd", b"": "", b"\x98a": "\ufffda", b"\xed\xa0\x80": "\u043d\xa0\u0402"}
    df = spark.createDataFrame([(bytearray(k),) for k in texts] + [(None,)], "raw binary").select("raw", X.decode_text(F.col("raw")).alias("text"))
    assert {r.raw and bytes(r.raw): r.text for r in df.collect()} == texts | {None: None}
    assert "CASE WHEN" in str(df._jdf.queryExecution().optimizedPlan()).split("_decode_other(")[1][:60]
