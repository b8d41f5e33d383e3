"""The corpus operators against brute force, round trips and edge cases."""

import base64
import hashlib
import random
import zlib
from collections import Counter

import numpy as np
import pytest
from compare import assert_same
from conftest import SMALL
from pyspark.sql import functions as F

from sievework.llm import chat, common, media, packing, pieces, sharding, simhash, suffix, toxicity, warc, weighted

ODD = [(1, None), (2, ""), (3, "a"), (4, "the same text here"), (5, "the same text here"), (5, "the same text here"), (None, "no id"), (7, "ünï\r\n\tcode ▁ 🙂 " * 40), (8, "word " * 3000), (9, "x" * 5000)]


@pytest.fixture(scope="module")
def odd(spark):
    """Nulls, empty and long texts, ties, repeated rows, and extra columns whose names clash with results."""
    df = spark.createDataFrame([(i, t, None if i == 4 else "en", f"s{k % 3}", len(t or "")) for k, (i, t) in enumerate(ODD)], "doc_id long, text string, lang string, source string, n_chars long")
    for c in ("length", "shard", "score", "spans", "id", "fp", "ids", "kept", "payload", "_rank", "bucket"):
        df = df.withColumn(c, F.lit("clash"))
    return df


@pytest.fixture(scope="module")
def empty(odd):
    return odd.where("false")


def documents(spark):
    return common.table(spark, SMALL, "documents")


def texts(spark):
    return {r.doc_id: r.text for r in documents(spark).collect()}


# packing


def test_packing_places_every_piece_without_gaps(spark):
    import public_tokenizers
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    rows = packing.op1_pattern_packing(spark, SMALL).collect()
    by = {}
    for r in rows:
        by.setdefault(r.doc_id, []).append(r)
    for i, t in texts(spark).items():
        ids = np.array([*tok.encode(t, add_special_tokens=False).ids, 1], dtype="<u4")
        cut = [ids[a : a + 4096] for a in range(0, len(ids), 4096)]
        got = sorted(by[i], key=lambda r: r.piece)
        assert [(r.length, r.ids_crc32, r.start) for r in got] == [(len(c), zlib.crc32(c.tobytes()), 4096 * k) for k, c in enumerate(cut)]
    check_layout(rows, 4096)
    total = sum(r.length for r in rows)
    assert len({r.sequence_id for r in rows}) <= -(-total // 4096) * 1.02 + 1


def check_layout(rows, limit):
    ends = {}
    for r in sorted(rows, key=lambda r: (r.sequence_id, r.offset)):
        assert r.offset == ends.get(r.sequence_id, 0)
        ends[r.sequence_id] = r.offset + r.length
    assert max(ends.values(), default=0) <= limit


def test_packing_odd_rows(odd, empty):
    rows = packing.pack_documents(odd).collect()
    check_layout(rows, 4096)
    assert Counter(r.id for r in rows)[5] == 2 and any(r.id is None for r in rows)
    assert [r.length for r in rows if r.id == 1] == [1]
    assert packing.pack_documents(empty).count() == 0


def test_packing_of_one_row_without_end(spark):
    """A row repeated many times falls to many groups when ranks are counted, and is packed once each."""
    same = spark.range(0, 30_000, 1, 4).select(F.lit(5).alias("doc_id"), F.lit("the same text").alias("text"))
    rows = packing.pack_documents(same).collect()
    check_layout(rows, 4096)
    assert len(rows) == 30_000


@pytest.mark.parametrize("seed", range(4))
def test_plan_uses_each_length_once_and_is_near_the_bound(seed):
    rng = np.random.default_rng(seed)
    lengths = np.minimum(512, np.exp(rng.normal(4, 1.2, 3000)).astype(int) + 1)
    h = dict(zip(*(x.tolist() for x in np.unique(lengths, return_counts=True)), strict=True))
    plan = packing.plan_packing(h, 512, (16, 32))
    used = Counter()
    for length, _, count, _, _, _ in plan.rows:
        used[length] += count
    assert dict(used) == h
    assert plan.sequences <= -(-lengths.sum() // 512) * 1.01 + 2


def test_nnls_matches_projection():
    rng = np.random.default_rng(0)
    a, x = rng.random((20, 8)), np.maximum(0, rng.normal(size=8))
    assert np.allclose(packing.nnls(a, a @ x), x, atol=1e-6)


@pytest.mark.parametrize("text", ["a\x1cb", "\x1f", "a \x1d. \x1e's B!\x1c", "x\x85y\xa0z", "end <|endoftext|> more", "<|startoftext|>\x1c z", "<|ENDOFTEXT|> a"])
def test_word_ids_are_the_tokenizers_own(text):
    import public_tokenizers
    from tokenizers import Tokenizer

    path = public_tokenizers.path("word_bpe_49k.json")
    assert packing.WordTokenizer(path).encode([text])[0].tolist() == Tokenizer.from_file(path).encode(text, add_special_tokens=False).ids


def test_word_ids_of_random_unicode_are_the_tokenizers_own():
    import public_tokenizers
    from tokenizers import Tokenizer

    path = public_tokenizers.path("word_bpe_49k.json")
    tok, own, rng = packing.WordTokenizer(path), Tokenizer.from_file(path), random.Random(1)
    odd = [*"abcXYZ '.,!İıΣσςßǅÉé\u0300\u0301\u0307\x1c\x1d\x1e\x1f\x85\u2003\u3000\n\r\t\x0b 0123٣½Ⅷ日本語한글🙂👍🏽\u200d\u200b_-<>|/[]K\ufeff\u0345ẞﬁ", "'s", "'ll", "<|endoftext|>", "</w>", "İSTANBUL", "ΣΑΣ", "the ", " word"]
    ranges = [(32, 0x3000), (0x1F000, 0x20000), (0, 0xD800)]
    letter = lambda: rng.choice(odd) if rng.random() < 0.9 else chr(rng.randrange(*rng.choice(ranges)))
    texts = ["".join(letter() for _ in range(rng.randrange(40))) for _ in range(10_000)]
    for lo in range(0, len(texts), 100):
        for text, ids in zip(texts[lo : lo + 100], tok.encode(texts[lo : lo + 100]), strict=True):
            assert ids.tolist() == own.encode(text, add_special_tokens=False).ids, repr(text)


# sharding


def test_hilbert_curve_is_a_walk_over_every_cell():
    for dims, bits in ((2, 3), (3, 2)):
        side = 1 << bits
        cells = np.stack(np.meshgrid(*[np.arange(side)] * dims, indexing="ij"), axis=-1).reshape(-1, dims)
        at = sharding.hilbert_index(cells, bits)
        walk = cells[np.argsort(at)]
        assert sorted(at) == list(range(side**dims))
        assert (np.abs(np.diff(walk, axis=0)).sum(axis=1) == 1).all()


def test_shards_hold_the_law(spark, odd, empty):
    rows = sharding.op2_hilbert_sharding(spark, SMALL).collect()
    size = Counter(r.shard for r in rows)
    assert set(size) == set(range(24)) and max(size.values()) - min(size.values()) <= 1
    for s in size:
        assert sorted(r.slot for r in rows if r.shard == s) == list(range(size[s]))
    t = texts(spark)
    assert all(r.size == len(t[r.doc_id].encode()) + 8 and r.text_crc32 == zlib.crc32(t[r.doc_id].encode()) for r in rows)
    small = sharding.shard_documents(odd, 3)
    assert small.count() == len(ODD) and {r["size"] for r in small.where("doc_id = 1").collect()} == {8}
    assert sharding.shard_documents(empty).count() == 0


def test_shards_prune_and_keep_equal_texts_together(spark):
    """Ranges of language, source and size rule out far more shards than those of hashed shards do; copies are parted by borders only."""
    rows = sharding.op2_hilbert_sharding(spark, SMALL).collect()
    docs = {r.doc_id: r for r in documents(spark).collect()}
    hashed = {i: zlib.crc32(str(i).encode()) % 24 for i in docs}
    own = {r.doc_id: r.shard for r in rows}

    def read(shard_of):
        total = 0
        for f in (lambda d: d.lang, lambda d: d.source, lambda d: len(d.text or "")):
            spans = {}
            for i, d in docs.items():
                v = f(d)
                lo, hi = spans.get(shard_of[i], (v, v))
                spans[shard_of[i]] = (min(lo, v), max(hi, v))
            values = sorted(f(d) for d in docs.values())
            total += sum(lo <= v <= hi for v in (values[0], values[len(values) // 2], values[-1]) for lo, hi in spans.values())
        return total

    assert read(own) < 0.7 * read(hashed)
    for r in rows:
        assert r.min_size <= r.size <= r.max_size and r.min_cat_lang <= docs[r.doc_id].lang <= r.max_cat_lang and r.min_cat_source <= docs[r.doc_id].source <= r.max_cat_source
    groups = {}
    for i, d in docs.items():
        groups.setdefault(d.text, set()).add(own[i])
    assert sum(len(g) > 1 for g in groups.values()) <= 23 and all(max(g) - min(g) == len(g) - 1 for g in groups.values())
    where = sorted((r.shard, r.slot, docs[r.doc_id].text) for r in rows)
    runs = Counter(t for k, (*_, t) in enumerate(where) if k == 0 or where[k - 1][2] != t)
    assert max(runs.values()) == 1


def test_category_axis_follows_the_values_order(spark):
    values = ["site-www-alpha", "site-www-beta", "site-www-b", None, "site-www-é", "site-www-"]
    df = spark.createDataFrame([(v, i) for i, v in enumerate(values)], "c string, n int")
    skip = sharding._shared_start("site-www-", "site-www-é")
    got = {r.c: r.x for r in df.select("c", sharding._code(F.col("c"), skip).alias("x")).collect()}
    assert skip == 9 and sorted(got, key=lambda v: got[v]) == sorted(got, key=lambda v: (v is not None, (v or "").encode()))
    assert sharding._shared_start(None, None) == 0 and sharding._shared_start("ab", "abc") == 2


def test_bytes_law_is_near_equal(spark):
    rows = sharding.shard_documents(documents(spark), 6, "bytes").collect()
    total = Counter()
    for r in rows:
        total[r.shard] += r["size"]
    assert max(total.values()) - min(total.values()) <= 2 * max(r["size"] for r in rows)


# chat


def test_chat_digests_match_sql(spark):
    assert_same(chat.op3_budgeted_windows(spark, SMALL), SMALL, chat.OP3_SQL)


def test_chat_round_trip_of_hostile_texts(spark):
    hostile = ["<|turn|>", "<|end|>x<|text|>", "<\\|end|>", "</s>[INST] ok [/INST]", "[\\/INST]", "<<SYS>>a<</SYS>>", "\\<|", "", None, "<\\\\|again|>", "a\nb"]
    rows = [(1, k, "assistant" if k % 2 else "user", t) for k, t in enumerate(hostile)] + [(None, None, None, "x"), (2, 0, "system", "sys"), (2, 0, "system", "sys")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumn("window", F.lit("clash")).withColumn("pos", F.lit(0))
    got = {r.conv: r for r in chat.conversation_digests(chat.format_windows(df, 300, 60)).collect()}
    want = "".join(f"{'assistant' if k % 2 else 'user'}\n{t or ''}\n" for k, t in enumerate(hostile))
    assert got[1].turns_sha256 == hashlib.sha256(want.encode()).hexdigest() and got[1].n_turns == len(hostile)
    assert got[1].loss_sha256 == hashlib.sha256("".join(t or "" for t in hostile[1::2]).encode()).hexdigest()
    assert got[2].n_turns == 2 and got[None].n_turns == 1
    assert chat.format_windows(df.where("false")).count() == 0


def test_windows_keep_budget_system_turn_and_single_targets(spark):
    rows = [(1, 0, "system", "be brief")] + [(1, k, "assistant" if k % 2 else "user", f"word{k} " * (5 + k % 7)) for k in range(1, 120)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    out = chat.parse_windows(chat.format_windows(df, 400, 80)).orderBy("window").collect()
    assert len(out) > 3 and all(w.tokens <= 400 for w in out)
    assert all(w.turns[0].role == "system" for w in out)
    assert any(t.again and t.role != "system" for w in out for t in w.turns)
    assert "".join(w.loss_text for w in out) == "".join(t for _, k, r, t in rows if r == "assistant")
    for w in out:
        assert all(s.start + s.length <= len(w.formatted) for s in w.loss)


def test_random_turns_keep_the_budget(spark):
    """Windows hold at most the budget unless the system turn and one turn exceed it, for any sizes."""
    rng = random.Random(6)
    rows = []
    for c in range(60):
        most = rng.choice([5, 40, 120, 300])
        if c % 3:
            rows.append((c, 0, "system", "s " * rng.choice([0, 10, 90, 150, 196, 230])))
        rows += [(c, k, rng.choice(["user", "assistant"]), "w " * rng.randrange(most)) for k in range(1, rng.randrange(2, 40))]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    size = {}
    for c, _, role, text in rows:
        size.setdefault(c, []).append((role, len(text.split()) + chat.OVERHEAD))
    repeated = 0
    for w in chat.parse_windows(chat.format_windows(df, 200, 60)).collect():
        head = size[w.conv][0][1] if size[w.conv][0][0] == "system" else 0
        counts = [(t, len(t.text.split()) + chat.OVERHEAD) for t in w.turns]
        assert w.tokens == sum(n for _, n in counts)
        repeated += sum(t.again and t.role != "system" for t, _ in counts)
        fresh = [n for t, n in counts if not t.again and t.role != "system"]
        assert w.tokens <= 200 or (len(fresh) <= 1 and w.tokens == head + sum(fresh) and len(counts) <= 2)
    assert repeated > 50


# media


def test_media_payloads_read_back(spark, odd, empty):
    t = texts(spark)
    for r in media.op4_signature_sniffing(spark, SMALL).collect():
        raw = t[r.doc_id].encode()
        pay = raw + b" " * ((-len(raw)) % 192 or (0 if raw else 192))
        assert (r.n_bytes, r.payload_bytes, r.payload_sha256, r.tail_crc32) == (len(raw), len(pay), hashlib.sha256(pay).hexdigest(), zlib.crc32(pay[-16:]))
        assert r.media_sha256 == hashlib.sha256(media.to_wav(pay)).hexdigest() and r.feature.startswith("type=audio/wav;")
    assert media.media_features(media.text_as_media(odd)).count() == len(ODD)
    assert media.media_features(media.text_as_media(empty)).count() == 0


def png(w=2, h=2):
    chunk = lambda k, d: len(d).to_bytes(4, "big") + k + d + zlib.crc32(k + d).to_bytes(4, "big")
    head = w.to_bytes(4, "big") + h.to_bytes(4, "big") + b"\x08\x00\x00\x00\x00"
    return b"\x89PNG\r\n\x1a\n" + chunk(b"IHDR", head) + chunk(b"IDAT", zlib.compress(b"\x00" * (h * (w + 1)))) + chunk(b"IEND", b"")


def test_sniffing_corrects_types_and_carves(spark):
    import gzip
    import io
    import zipfile

    z = io.BytesIO()
    with zipfile.ZipFile(z, "w") as f:
        f.writestr("a.txt", "hello")
    gif = b"GIF89a\x01\x00\x01\x00\x00\x00\x00,\x00\x00\x00\x00\x01\x00\x01\x00\x00\x02\x02D\x01\x00;"
    cases = {"image/png": png(), "application/zip": z.getvalue(), "application/gzip": gzip.compress(b"abc" * 99), "image/gif": gif, "audio/wav": media.to_wav(b"\x80" * 192)}
    rows = [(k, v, "text/plain") for k, v in cases.items()] + [("none", b"BM RIFF GIF89a %PDF- \xff\xd8\xff", "x/y"), ("null", None, None)]
    rows.append(("inside", b"junk" + png() + b"more" + gif, "x/y"))
    df = spark.createDataFrame(rows, "k string, b binary, d string")
    got = {r.id: r for r in media.sniff_media(df, "k", "b", "d").collect()}
    for k in cases:
        assert got[k].actual == k and got[k].corrected
    assert got["none"].actual == "x/y" and not got["none"].media and got["null"].actual is None
    assert [bytes(c) for c in got["inside"].carved] == [png(), gif]
    assert media.find_media(png()[:-1]) == []


# toxicity


def test_toxicity_held_out_accuracy_and_spans(spark):
    random.seed(3)
    words = ["".join(random.choices("abcdefgh", k=5)) for _ in range(400)]
    bad = ["vileword", "nastyish"]
    rows = []
    for i in range(600):
        toxic = i % 5 == 0
        ws = random.choices(words, k=60)
        if toxic:
            ws[10:12] = random.choices(bad, k=2)
        rows.append((i, " ".join(ws), int(toxic)))
    docs = spark.createDataFrame(rows, "doc_id long, text string, toxic int").withColumn("score", F.lit("clash"))
    model = toxicity.fit_on(docs, docs.select("doc_id", "toxic"))
    got = toxicity.tag_toxic(docs, model).collect()
    assert all((r.score >= toxicity.THRESHOLD) == (r.id % 5 == 0) for r in got)
    spans = next(r.spans for r in got if r.id == 5)
    assert {rows[5][1][s.start : s.stop] for s in spans} <= set(bad) and spans
    assert {r.doc_id for r in toxicity.drop_toxic(docs, model).collect()} == {i for i in range(600) if i % 5}


def test_toxicity_windows_come_from_whole_texts():
    """Every featured word is in a window, as a toxic token in a toxic text, wherever it stands."""
    number = {"=vileword": 1, "vile": 2}
    words = ["plain"] * 5000
    for k in (0, 3, 40, 41, 2500, 4999):
        words[k] = "vileword"
    win, state = toxicity.text_windows(words, 1, number, 0)
    assert (win[:, toxicity.CONTEXT, 0] == 1).all() and len(win) == 4 and ((win[:, :, 0] == 1) == (state == 1)).all()
    assert int((state == 1).sum()) == 6 and (state[0][: toxicity.CONTEXT] == -1).all()
    win, state = toxicity.text_windows(words, 0, number, 0)
    assert (state < 1).all() and toxicity.text_windows([], 1, number, 3)[0].shape[0] == 0
    assert toxicity.text_windows(["plain"] * 9, 0, number, 22)[0].shape[0] == 1


def test_toxicity_fit_on_tables_equals_fit_on_texts(spark):
    rng = random.Random(4)
    rows = []
    for i in range(400):
        ws = ["w" + "".join(rng.choices("abcdefgh", k=4)) for _ in range(30)]
        if i % 4 == 0:
            ws[rng.randrange(30)] = rng.choice(["vileword", "nastyish", "grimly"])
        rows.append((i, " ".join(ws), int(i % 4 == 0)))
    docs = spark.createDataFrame(rows, "doc_id long, text string, toxic int")
    got = toxicity.fit_on(docs.select("doc_id", "text"), docs.select("doc_id", "toxic"))
    known = [r for r in rows if zlib.crc32(str(r[0]).encode()) % 4 != 2]
    want = toxicity.fit([t for _, t, _ in known], [y for _, _, y in known])
    assert set(got.weights) == set(want.weights) and {"=vileword", "=nastyish", "=grimly"} <= set(got.weights)
    assert all(abs(got.weights[f] - w) < 0.5 for f, w in want.weights.items())
    scores = [[m.score([p for _, _, p in m.tag(t)[0]]) for _, t, _ in rows] for m in (got, want)]
    assert max(abs(a - b) for a, b in zip(*scores, strict=True)) < 0.1


def test_toxicity_scores_spread_on_few_labels(spark):
    """Six toxic texts pass no bound on chance; the best features still tell held-out texts apart."""
    rng = random.Random(9)
    rows = [(i, " ".join(["w" + "".join(rng.choices("abcdefgh", k=3)) for _ in range(25)] + (["vileword"] if i % 16 == 0 else [])), int(i % 16 == 0)) for i in range(130)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, toxic int")
    model = toxicity.fit_on(docs, docs)
    score = {i: model.score([p for _, _, p in model.tag(t)[0]]) for i, t, _ in rows}
    held = [(score[i], y) for i, _, y in rows if zlib.crc32(str(i).encode()) % 4 == 2]
    assert min(s for s, y in held if y) > sorted(s for s, y in held if not y)[int(0.9 * sum(1 - y for _, y in held))]


def test_toxicity_scores_do_not_depend_on_the_sample_shares():
    """The word stands in all toxic texts and in one clean text of twenty; one text in twenty is toxic."""
    clean = [f"a b c d{i % 7} " + ("vileword" if i % 20 == 0 else "e") for i in range(1900)]
    toxic = [f"a b c d{i % 7} vileword" for i in range(100)]
    every = toxicity.fit(clean + toxic, [0] * 1900 + [1] * 100)
    some = toxicity.fit(clean[:100] + toxic, [0] * 100 + [1] * 100, {0: 1900, 1: 100})
    score = lambda m: m.score([p for _, _, p in m.tag("a b vileword")[0]])
    assert 0.3 < score(every) < 0.7 and abs(score(some) - score(every)) < 0.1


def test_toxicity_odd_rows(spark, odd, empty):
    labels = spark.createDataFrame([(3, 1), (8, 0), (None, 1), (4, None)], "doc_id long, toxic int")
    model = toxicity.fit_on(odd, labels)
    assert toxicity.tag_toxic(odd, model).count() == len(ODD)
    assert toxicity.drop_toxic(odd, model).columns == odd.columns
    assert toxicity.tag_toxic(empty, toxicity.fit_on(empty, labels.where("false"))).count() == 0
    out = toxicity.op5_crf_toxicity(spark, SMALL).collect()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) and 0 <= r.score <= 1 for r in out)


def test_sparse_marginals_equal_full_forward_backward():
    m = toxicity.ToxicModel({"=bad": 2.5, "=worse": 1.2}, -1.5, ((0.4, -0.7), (-0.2, 0.9)), (0.0, 1.0, 0.0))
    words = "a bad b c worse d d d bad worse e".split()
    spans, n = m.tag(" ".join(words))
    emit = np.exp([[0, m.bias + sum(m.weights.get(f, 0) for f in toxicity.token_features(w))] for w in words])
    step = np.exp(np.array(m.step))
    f, b = [emit[0]], [np.ones(2)]
    for e in emit[1:]:
        f.append((f[-1] @ step) * e)
    for e in emit[:0:-1]:
        b.append(step @ (e * b[-1]))
    p = [(x * y)[1] / (x * y).sum() for x, y in zip(f, b[::-1], strict=True)]
    hit = [i for i, w in enumerate(words) if w in ("bad", "worse")]
    assert np.allclose([q for _, _, q in spans], [p[i] for i in hit]) and n == len(words)


# fingerprints


def test_weighted_sampling_estimates_generalised_jaccard(spark):
    t = sorted(texts(spark).items())
    got = {r.doc_id: r for r in weighted.op6_weighted_sampling(spark, SMALL).collect()}
    errors = []
    for k, (i, own) in enumerate(t):
        following = t[(k + 1) % len(t)][1]
        changed = weighted.edited(own, following)
        assert got[i].edited_sha256 == hashlib.sha256(changed.encode()).hexdigest() and got[i].n_chars == len(own)
        assert got[t[(k + 1) % len(t)][0]].fingerprint is not None
        errors.append(got[i].near_edited - weighted.generalised_jaccard(own, changed))
    assert abs(np.mean(errors)) < 0.03 and np.std(errors) < 0.08
    same = {}
    for i, own in t:
        assert same.setdefault(own, got[i].fingerprint) == got[i].fingerprint


def test_weighted_sampling_odd_rows(spark, odd, empty):
    out = weighted.fingerprint_documents(odd).collect()
    assert len(out) == len(ODD)
    one = weighted.fingerprint_documents(odd.where("doc_id = 8")).collect()
    assert len(one) == 1 and one[0].near_next == 1.0 and one[0].near_edited == 1.0
    assert weighted.fingerprint_documents(empty).count() == 0
    s = weighted.Sampler(64, held=40)
    assert (s.signature("a b c " * 50 + " ".join(map(str, range(100)))) == weighted.Sampler(64).signature("a b c " * 50 + " ".join(map(str, range(100))))).all()


def test_weighted_sampling_draws_common_words_once(monkeypatch):
    drawn = Counter()
    plain = weighted.draw
    monkeypatch.setattr(weighted, "draw", lambda words, *a: drawn.update(words) or plain(words, *a))
    common = [f"c{k}" for k in range(40)]
    s = weighted.Sampler(16, held=400)
    lines = [" ".join([*common, *(f"w{i}_{k}" for k in range(20))]) for i in range(100)]
    got = [s.signature(x) for x in lines]
    assert max(drawn[w] for w in common) == 1 and len(s.at) <= 400
    assert all((weighted.Sampler(16).signature(x) == y).all() for x, y in zip(lines, got, strict=True))


def test_weighted_sampling_together_and_alone(spark):
    t = sorted(texts(spark).items())
    own = [x for _, x in t]
    changed = [weighted.edited(x, own[(k + 1) % len(own)]) for k, x in enumerate(own)]
    alone = [[weighted.Sampler().signature(x) for x in xs] for xs in (own, changed)]
    small = weighted.Sampler(held=300)  # long texts in parts, short ones together, what is held dropped again and again
    assert (small.signatures(own + changed) == np.concatenate(alone)).all()
    for rows in (7, weighted.TOGETHER):  # batches that end amid what is taken together, and with it
        with common.batches_of(spark, rows):
            got = {r.doc_id: r for r in weighted.op6_weighted_sampling(spark, SMALL).collect()}
        assert len(got) == len(t)
        for k, (i, _) in enumerate(t):
            mine, theirs, following = alone[0][k], alone[1][k], alone[0][(k + 1) % len(t)]
            assert (got[i].fingerprint, got[i].edited_fingerprint) == (mine.tobytes().hex(), theirs.tobytes().hex())
            assert (got[i].near_edited, got[i].near_next) == ((mine == theirs).mean(), (mine == following).mean())


# WARC


def test_warc_types_and_digests(spark):
    pages = {r.page_id: r.html for r in common.table(spark, SMALL, "pages").collect()}
    last = {}
    for i, h in pages.items():
        last[h or ""] = max(i, last.get(h or "", i))
    for r in warc.op7_content_addressed_warc(spark, SMALL).collect():
        raw = (pages[r.page_id] or "").encode()
        assert r.payload_bytes == len(raw) and r.payload_digest == base64.b32encode(hashlib.sha1(raw).digest()).decode()
        own = last[pages[r.page_id] or ""]
        assert (r.record_type, r.refers_to) == (("response", None) if own == r.page_id else ("revisit", own))


def test_warc_reconstruction_and_odd_rows(spark):
    rows = [(1, "http://a/\r\nX: y", "same"), (2, None, "same"), (2, None, "same"), (3, "u", None), (4, "v", ""), (None, "w", "same")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("payload", F.lit("clash")).withColumn("owner", F.lit("clash"))
    path = common.scratch(spark, "warc-test")
    warc.write_archive(pages, path)
    index = warc.read_index(spark, path).collect()
    assert len(index) == len(rows)
    kinds = sorted((r.source_id, r.record_type, r.refers_to) for r in index)
    assert kinds == [("", "response", ""), ("1", "revisit", "2"), ("2", "response", ""), ("2", "response", ""), ("3", "revisit", "4"), ("4", "response", "")]
    records = [bytes(r.record) for r in warc.read_records(spark, path).collect()]
    assert len(records) == len(rows) and all(x.startswith(b"WARC/1.1\r\n") and x.endswith(b"\r\n\r\n") for x in records)
    for x in records:
        head, _, body = x.partition(b"\r\n\r\n")
        n = int(next(line for line in head.split(b"\r\n") if line.startswith(b"Content-Length")).split(b": ")[1])
        assert body == body[:n] + b"\r\n\r\n"
    assert spark.read.parquet(f"{path}/payloads").count() == 2
    none = common.scratch(spark, "warc-none")
    warc.write_archive(pages.where("false"), none)
    assert warc.read_index(spark, none).count() == 0
    large = common.scratch(spark, "warc-large")
    warc.write_archive(pages, large, min_bytes=5)
    assert {r.record_type for r in warc.read_index(spark, large).collect()} == {"response"}


# suffixes


def brute_repeats(items, length):
    seen = Counter(t[k : k + length] for t in items for k in range(len(t) - length + 1))
    out = []
    for t in items:
        m = np.zeros(len(t) + 1, dtype=int)
        for k in range(len(t) - length + 1):
            if seen[t[k : k + length]] > 1:
                m[k] += 1
                m[k + length] -= 1
        out.append(np.cumsum(m[:-1]) > 0)
    return out


@pytest.mark.parametrize("q", [2, 3, 5, 7, 11, 13])
def test_difference_cover(q):
    period, residues = suffix.difference_cover(q)
    assert period == q * q + q + 1 and len(residues) == q + 1 and residues[0] == 0
    assert {(a - b) % period for a in residues for b in residues} == set(range(period))


@pytest.mark.parametrize("seed", range(3))
def test_suffix_dedup_equals_brute_force(spark, seed):
    rng = random.Random(seed)
    base = ["".join(rng.choices("abcd é", k=rng.randrange(0, 400))) for _ in range(25)]
    passage = "".join(rng.choices("xyz ", k=130))
    items = base + [base[3][:200] + passage + base[4], passage[:70] + base[5], passage * 2, base[6], base[6], "", "a" * 300, "ab" * 90]
    raw = [t.encode() for t in items]
    df = spark.createDataFrame(list(enumerate(items)), "doc_id long, text string").withColumn("kept", F.lit("clash"))
    got = {r.doc_id: r for r in suffix.find_repeats(df, 60, 5).collect()}
    for i, (t, m) in enumerate(zip(raw, brute_repeats(raw, 60), strict=True)):
        kept = bytes(np.frombuffer(t, dtype=np.uint8)[~m]) if t else b""
        runs = int((np.diff(np.r_[0, m.astype(int)]) == 1).sum())
        assert (got[i].n_bytes, got[i].n_removed, len(got[i].spans), bytes(got[i].kept)) == (len(t), int(m.sum()), runs, kept)


def test_suffix_dedup_odd_rows(odd, empty):
    out = suffix.find_repeats(odd).collect()
    assert len(out) == len(ODD)
    assert next(r.n_removed for r in out if r.doc_id == 9) == 5000
    assert suffix.find_repeats(empty).count() == 0


def test_suffix_dedup_planted_passages(spark, tmp_path):
    """The query on passages of over 50 words in two documents each: from 400 bytes on they go, shorter ones stay, nothing else is cut."""
    rng = random.Random(8)
    line = lambda n, least, most: " ".join("".join(rng.choices("abcdefgh", k=rng.randint(least, most))) for _ in range(n))
    passages = [line(51 + k, 2 + k % 7, 6 + k % 7) for k in range(20)]
    items = [*[f"{line(80, 3, 7)}\n{p}\n{line(30, 3, 7)}" for p in passages for _ in range(2)], line(90, 3, 7), "", None]
    assert 0 < sum(len(p) < 390 for p in passages) < 20
    spark.createDataFrame(list(enumerate(items)), "doc_id long, text string").write.parquet(str(tmp_path / "documents.parquet"))
    got = {r.doc_id: r for r in suffix.op8_suffix_dedup(spark, str(tmp_path)).collect()}
    raw = [(t or "").encode() for t in items]
    for i, (t, m) in enumerate(zip(raw, brute_repeats(raw, 400), strict=True)):
        kept = bytes(np.frombuffer(t, dtype=np.uint8)[~m]) if t else b""
        assert (got[i].n_bytes, got[i].n_removed, got[i].text) == (len(t), int(m.sum()), kept.decode())
        assert got[i].kept_sha256 == hashlib.sha256(kept).hexdigest()
        if i < 40 and not 390 < len(passages[i // 2]) < 400:  # a few bytes around both may be equal by chance
            assert (passages[i // 2] in got[i].text) == (len(passages[i // 2]) < 400)


# SimHash


def brute_fingerprint(text, n=3):
    import re

    import xxhash

    t = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    w = re.findall(r"[^\x20\x09-\x0D]+", t)
    sh = [" ".join(w[k : k + n]) for k in range(len(w) - n + 1)] if len(w) >= n else ([" ".join(w)] if w else [])
    h = [xxhash.xxh64_intdigest(s.encode(), 42) for s in sh]
    return sum(1 << b for b in range(64) if h and 2 * sum((x >> b) & 1 for x in h) > len(h))


def brute_components(codes, distance):
    ids = sorted(codes)
    root = {i: i for i in ids}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in ids:
        for b in ids:
            if a < b and (codes[a] ^ codes[b]).bit_count() <= distance:
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {i: find(i) for i in ids}


def test_simhash_matches_brute_force(spark):
    codes = {i: brute_fingerprint(t) for i, t in texts(spark).items()}
    want = brute_components(codes, 3)
    for r in simhash.op9_simhash_components(spark, SMALL).collect():
        assert (r.fingerprint, r.component_id) == (f"{codes[r.doc_id]:016x}", want[r.doc_id])


@pytest.mark.parametrize("hot", [4096, 8])
def test_near_components_of_dense_codes(spark, monkeypatch, hot):
    """Chains and dense groups, with small and with split buckets."""
    monkeypatch.setattr(simhash, "HOT", hot)
    rng = random.Random(hot)
    centre = rng.getrandbits(64)
    codes = {}
    for i in range(120):
        x = centre if i % 2 else rng.getrandbits(64)
        for b in rng.sample(range(64), rng.randrange(0, 5)):
            x ^= 1 << b
        codes[i] = x
    codes |= {200: 0, 201: 0, 202: 7, 203: 63}
    rows = [(i, x - (1 << 64) if x >> 63 else x) for i, x in codes.items()]
    got = {r.id: r.component_id for r in simhash.near_components(spark.createDataFrame(rows, "id long, fp long")).collect()}
    assert got == brute_components(codes, 3)


def test_link_bucket_by_flips_equals_pairs(monkeypatch):
    rng = random.Random(1)
    x = np.array(sorted({rng.getrandbits(12) for _ in range(600)}), dtype=np.uint64)
    want = brute_components({int(v): int(v) for v in x}, 1)
    monkeypatch.setattr(simhash, "HOT", 4)
    a, b = simhash.link_bucket(x, 1)
    root = {int(v): int(v) for v in x}

    def find(v):
        while root[v] != v:
            v = root[v]
        return v

    for p, q in zip(a.tolist(), b.tolist(), strict=True):
        assert (p ^ q).bit_count() == 1
        u, v = find(p), find(q)
        root[max(u, v)] = min(u, v)
    assert {v: find(v) for v in root} == want


def test_simhash_odd_rows(odd, empty):
    prints = common.stored(simhash.fingerprints(odd.where("doc_id is not null")), "t")
    rows = simhash.near_components(prints).collect()
    assert {r.fp for r in rows if r.id in (1, 2)} == {0} and len(rows) == len(ODD) - 1
    assert {r.component_id for r in rows if r.id in (1, 2)} == {1}
    assert simhash.near_components(common.stored(simhash.fingerprints(empty), "t")).count() == 0


@pytest.mark.parametrize("held", [65536, 2])
def test_similar_components_finds_near_copies_and_leaves_the_rest(spark, monkeypatch, held):
    monkeypatch.setattr(simhash, "HELD", held)
    rng = random.Random(5)
    vocabulary = ["".join(rng.choices("abcdefghij", k=rng.randrange(2, 9))) for _ in range(900)]
    rows, want = [], {}
    for g in range(40):
        ws = rng.choices(vocabulary, k=300)
        rows.append((10 * g, " ".join(ws)))
        for c in range(1, 4):
            near = list(ws)
            for _ in range(4):
                near[rng.randrange(300)] = rng.choice(vocabulary)
            rows.append((10 * g + c, " ".join(near)))
            want[10 * g + c] = 10 * g
        rows.append((10 * g + 9, " ".join(ws[:150] + rng.choices(vocabulary, k=150))))
    got = {r.id: r.component_id for r in simhash.similar_components(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert all(got[i] == c for i, c in want.items())
    assert all(got[10 * g + 9] == 10 * g + 9 for g in range(40))


def shingle_likeness(a, b, k=5):
    x, y = ({tuple(w[i : i + k]) for i in range(len(w) - k + 1)} for w in (a.split(), b.split()))
    return len(x & y) / len(x | y)


def similar_by_brute_force(texts):
    root = {i: i for i in texts}

    def find(v):
        while root[v] != v:
            v = root[v]
        return v

    for i in texts:
        for j in texts:
            if i < j and shingle_likeness(texts[i], texts[j]) >= 0.8:
                u, v = sorted((find(i), find(j)))
                root[v] = u
    return {i: find(i) for i in texts}


def similar(spark, texts):
    got = simhash.similar_components(spark.createDataFrame(list(texts.items()), "doc_id long, text string"))
    return {r.id: r.component_id for r in got.collect()}


def test_added_and_cut_copies_just_above_the_likeness_are_linked(spark):
    rng = random.Random(11)
    word = lambda: "".join(rng.choices("abcdefghij", k=rng.randrange(2, 9)))
    texts = {}
    for g in range(30):
        ws = [word() for _ in range(204)]
        more = [word() for _ in range(48)]
        texts |= {10 * g: " ".join(ws), 10 * g + 1 + g % 3: " ".join([ws + more, more + ws, ws[:166]][g % 3])}
        assert 0.8 <= shingle_likeness(*[texts[i] for i in (10 * g, 10 * g + 1 + g % 3)]) < 0.82
    assert similar(spark, texts) == {i: i - i % 10 for i in texts}


def test_a_key_shared_by_all_loses_no_member(spark, monkeypatch):
    """A chain whose ends are far apart, all on one line of words, in any order of ids and with few pairs sent at once."""
    monkeypatch.setattr(simhash, "HELD", 2)
    monkeypatch.setattr(simhash, "MANY", 4)
    rng = random.Random(12)
    line = [f"w{i}" for i in range(400)]
    steps = list(range(0, 200, 6))
    rng.shuffle(steps)
    texts = {i: " ".join(line[s : s + 200]) for i, s in enumerate(steps)}
    texts |= {100 + i: " ".join(line[190:210] + [f"x{i}-{j}" for j in range(100)]) for i in range(20)}
    want = similar_by_brute_force(texts)
    assert len({want[i] for i in range(len(steps))}) == 1 and want[119] == 119
    assert similar(spark, texts) == want


def test_all_rows_of_a_key_that_are_apart_are_paired():
    rng = np.random.default_rng(3)
    node, comp = np.arange(60), rng.integers(0, 7, 60)
    n, pos = rng.integers(90, 110, 60), rng.integers(0, 20, 60)
    prev, first = rng.integers(0, 5, 60), rng.random(60) < 0.1
    got = {tuple(sorted(p)) for a, b in simhash.cross_pairs(node, comp, n, pos, prev, first, 0.8) for p in zip(a.tolist(), b.tolist(), strict=True)}
    apart = {(i, j) for i in range(60) for j in range(i + 1, 60) if comp[i] != comp[j] and 9 * min(n[i] - pos[i], n[j] - pos[j]) >= 4 * (n[i] + n[j])}
    want = {(i, j) for i, j in apart if prev[i] != prev[j] or first[i] or first[j]}
    assert got == want and len(apart) > len(want) > 100


def test_every_similar_pair_is_given_by_a_key_of_its_prefixes():
    rng = np.random.default_rng(8)
    for _ in range(400):
        both = int(rng.integers(1, 200))
        own = int(rng.integers(0, both // 4 + 1))
        other = both // 4 - own if rng.random() < 0.7 else 0
        pool = rng.choice(2**62, both + own + other, replace=False).astype(np.uint64) * np.uint64(4)
        x, y = np.sort(pool[: both + own]), np.sort(np.concatenate([pool[:both], pool[both + own :]]))
        common = np.sort(rng.choice(pool, len(pool) // 3, replace=False))
        place = rng.permutation(len(common)) + 1
        px, py = simhash.prefix_of(x, common, place, 0.8), simhash.prefix_of(y, common, place, 0.8)
        given = 0
        for k in np.intersect1d(px, py):
            i, j = int(np.flatnonzero(px == k)[0]), int(np.flatnonzero(py == k)[0])
            prev = np.array([px[i - 1] if i else 0, py[j - 1] if j else 0])
            given += len(list(simhash.cross_pairs(np.array([1, 2]), np.array([1, 2]), np.array([len(x), len(y)]), np.array([i, j]), prev, np.array([i == 0, j == 0]), 0.8)))
        assert given >= 1


def test_parities_keep_every_similar_pair():
    """The bits in which two parities differ are never more than the elements in which the sets do, at the limit too."""
    rng = np.random.default_rng(21)
    kept = 0
    for _ in range(300):
        both = int(rng.integers(4, 900))
        own = int(rng.integers(0, both // 2 + 1))
        pool = rng.integers(0, 2**63, both + 2 * own, dtype=np.int64).astype(np.uint64)
        x, y = np.unique(pool[: both + own]), np.unique(np.concatenate([pool[:both], pool[both + own :]]))
        similar_ = len(np.intersect1d(x, y)) >= 0.8 * len(np.union1d(x, y)) - 1e-9
        rows = np.frombuffer(simhash.parity_of(x) + simhash.parity_of(y), dtype=np.uint64).reshape(2, -1)
        assert np.bitwise_count(rows[0] ^ rows[1]).sum() <= len(np.setxor1d(x, y))
        pair = (np.array([1, 2]), np.array([1, 2]), np.array([len(x), len(y)]), np.zeros(2, int), np.zeros(2, int), np.ones(2, bool), 0.8)
        given, plain = (len(list(simhash.cross_pairs(*pair, parity))) for parity in (rows, None))
        assert given == plain if similar_ else given <= plain
        kept += similar_
    assert 50 < kept < 250


def test_strings_of_one_key_are_told_apart_by_their_digests(monkeypatch):
    """Where two strings of a block share a key, the digests decide, in what is sent and in what the answers mean."""
    block = suffix.Block(b"abcabdabc", np.array([9]))
    monkeypatch.setattr(suffix.Block, "keys", lambda self, at, length: np.zeros(len(at), dtype=np.uint64))
    at = np.array([0, 3, 6])
    rows, twice = block.sent(at, 3)
    told = block.told(at, 3, 2)
    assert len(rows) == 2 and told[0] == told[2] != told[1]
    assert twice[told[0]] and not twice[told[1]]


def test_likeness_decides_exactly(spark):
    """Pairs from 0.70 to 0.90: linked from 0.8 on, left alone below, at exactly 0.8 linked."""
    rng = random.Random(13)
    word = lambda: "".join(rng.choices("abcdefghij", k=rng.randrange(3, 9)))
    texts = {}
    for g in range(40):
        ws = [word() for _ in range(164)]
        texts |= {10 * g: " ".join(ws), 10 * g + 1: " ".join(ws[: 116 + g] if g % 2 else ws + [word() for _ in range(20 + g)])}
    ws = [word() for _ in range(164)]
    texts |= {1000: " ".join(ws), 1001: " ".join(ws[:132])}
    like = [shingle_likeness(texts[i], texts[i + 1]) for i in texts if i % 10 == 0]
    assert like[-1] == 0.8 and sum(0.7 <= x < 0.8 for x in like) > 10 and sum(x >= 0.8 for x in like) > 10
    assert similar(spark, texts) == similar_by_brute_force(texts)


# SentencePiece


@pytest.fixture(scope="module")
def model():
    import public_tokenizers

    return pieces.PieceModel(public_tokenizers.path("piece_bpe_32k.model"))


def test_pieces_round_trip_and_best_score(spark, model):
    import public_tokenizers
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    scores = {sp.id_to_piece(i): sp.get_score(i) for i in range(sp.vocab_size()) if not (sp.is_byte(i) or sp.is_control(i) or sp.is_unknown(i))}
    longest = max(map(len, scores))

    def best(text):
        t = pieces.SPACE + text.replace(" ", pieces.SPACE)
        at = [0.0] + [-1e300] * len(t)
        for e in range(1, len(t) + 1):
            at[e] = max([at[e - 1] + model.floor, *[at[s] + scores[t[s:e]] for s in range(max(0, e - longest), e) if t[s:e] in scores]])
        return at[-1]

    for t in list(texts(spark).values())[:40]:
        ids, score = model.encode(t)
        assert model.decode(ids) == t and score == pytest.approx(best(t) if t else 0.0)
    for t in ["", " ", "  a  b ", "a\n\nb\t c", "▁x ▁", "日本語 🙂 é\x00", "x" * 3000]:
        assert model.decode(model.encode(t)[0]) == t


def test_pieces_query_and_odd_rows(spark, odd, empty):
    import public_tokenizers

    t = texts(spark)
    for r in pieces.op10_sentencepiece(spark, SMALL).collect():
        assert r.decoded_sha256 == hashlib.sha256(t[r.doc_id].encode()).hexdigest() and r.n_tokens == len(r.ids)
        assert r.ids_crc32 == zlib.crc32(np.array(r.ids, dtype="<i4").tobytes())
    path = public_tokenizers.path("piece_bpe_32k.model")
    got = pieces.decode_pieces(pieces.encode_pieces(odd, path), path).collect()
    assert sorted(r.decoded for r in got) == sorted(x or "" for _, x in ODD)
    assert pieces.encode_pieces(empty, path).count() == 0


def test_pieces_take_few_calls(model):
    """A held part costs no call of its own and a new one no call for each place; also for characters without a piece."""
    import sys

    text = " ".join(f"word{k % 40} çédille{k % 7} 一ก{k % 5}" for k in range(400))

    def calls():
        n = 0

        def count(frame, event, arg):
            nonlocal n
            n += event == "call"

        sys.setprofile(count)
        try:
            ids, _ = model.encode(text)
        finally:
            sys.setprofile(None)
        assert model.decode(ids) == text
        return n

    model.cache.clear()
    new = calls()
    assert new <= 4 * len(model.cache) and calls() <= 5
