"""Each operator against a brute-force version, an exact round trip or held-out accuracy, and its edge cases."""

import hashlib
import io
import math
import random
import re
import time
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from sievewright.llm import chat, deep_shallow, langid, licences, lm, media, mixing, neardup, packing, quality, registry, repeats, shingles
from sievewright.llm.components import connected
from sievewright.llm.common import crc_fold

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
WORDS = [a + b for a in ("lo", "mi", "ta", "ren", "sho") for b in ("ka", "ve", "dun", "si", "or")]


def sentence(rng, n):
    return " ".join(rng.choice(WORDS) + str(rng.randrange(30)) for _ in range(n))


@pytest.fixture(scope="module")
def rows():
    """Texts with copies, near copies, shared passages, blanks, nulls, long and odd ones."""
    rng = random.Random(3)
    passage = sentence(rng, 60)
    base = [sentence(rng, rng.randrange(60, 200)) for _ in range(30)]
    texts = list(base)
    for t in base[:8]:
        texts += [t, t.upper(), t.replace(" ", "\n", 2)]
        w = t.split()
        for k in (1, 3, 5):
            v = list(w)
            for i in rng.sample(range(len(v)), k):
                v[i] = "changed"
            texts.append(" ".join(v))
    texts += [f"{sentence(rng, 30)} {passage} {sentence(rng, 30)}" for _ in range(12)]
    texts += [None, "", " \t\n", "one", "one two", "one two", "Ünïcödé ß x y 🎈" * 40, "a" * 300, "ab" * 400, sentence(rng, 4000), "x </s> [INST] <|im_end|>\\", "\x1c\x1d　"]
    out = [(i, t, None if i % 17 == 0 else ("en", "de")[i % 2], None if i % 13 == 0 else f"s{i % 4}", None) for i, t in enumerate(texts)]
    return out + [out[2], out[-1]]  # repeated rows


@pytest.fixture(scope="module")
def docs(spark, rows):
    return spark.createDataFrame(rows, SCHEMA).repartition(5).cache()


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


def words_of(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


# --- quality rules


def brute_base(text):
    w = words_of(text)
    windows = Counter(zip(w, w[1:], w[2:], strict=False))
    covered = {j for i in range(len(w) - 2) if windows[tuple(w[i : i + 3])] > 1 for j in range(i, i + 3)}
    lines = [x for x in (text or "").split("\n") if words_of(x)]
    return len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text or ""), len(lines) - len(set(lines)), len(covered)


def test_quality_base_equals_brute_force(spark, docs, rows):
    labels = spark.createDataFrame([(0, 1), (1, 0)], "doc_id long, quality int")
    got = quality.judge(docs, quality.train(docs, labels)).collect()
    assert len(got) == len(rows)
    text = {r[0]: r[1] for r in rows}
    for r in got:
        base = brute_base(text[r["doc_id"]])
        assert tuple(r[n] for n in quality.BASE_STATS) == base
        failed = base[0] < 50 or 100 * base[4] > 50 * base[0]
        assert r["base_failed"] == failed and not (failed and r["kept"]) and 0 <= r["score"] <= 1


def test_quality_trees_keep_good_and_reject_junk(spark):
    rng = random.Random(5)
    rows, labels = [], []
    for i in range(400):
        bad = i % 4 == 0
        text = sentence(rng, 80)
        rows.append((i, text.replace(" ", "*** ### ") if bad else text, "en", "s", None))
        if i < 300:
            labels.append((i, int(not bad)))
    docs = spark.createDataFrame(rows, SCHEMA)
    forest = quality.train(docs, spark.createDataFrame(labels, "doc_id long, quality int"))
    kept = {r["doc_id"]: r["kept"] for r in quality.judge(docs, forest).collect()}
    assert all(kept[i] == (i % 4 != 0) for i in range(300, 400))


def test_quality_rejects_toxic_documents_of_good_form(spark):
    rng = random.Random(12)
    bad = ["awful", "Nasty!", "vile,"]
    rows, labels = [], []
    for i in range(400):
        words = sentence(rng, 80).split()
        if i % 8 == 0:
            words[rng.randrange(80)] = rng.choice(bad)
        rows.append((i, " ".join(words), "en", "s", None))
        if i < 300:
            labels.append((i, 1, int(i % 8 == 0)))
    docs = spark.createDataFrame(rows, SCHEMA)
    forest = quality.train(docs, spark.createDataFrame(labels, "doc_id long, quality int, toxic int"))
    assert {b"awful", b"nasty", b"vile"} <= forest.lexicon
    kept = {r["doc_id"]: r["kept"] for r in quality.judge(docs, forest).collect()}
    assert all(kept[i] == (i % 8 != 0) for i in range(300, 400))


def test_quality_falls_along_constrained_features():
    rng = np.random.default_rng(0)
    x = rng.random((3000, len(quality.FEATURES)))
    j = quality.FEATURES.index("symbols_per_word")
    y = (rng.random(3000) < 0.5 + 0.4 * np.sin(6 * x[:, j])).astype(float)
    forest = quality.fit(x, y)
    probe = np.repeat(x[:20], 50, axis=0)
    probe[:, j] = np.tile(np.linspace(0, 1, 50), 20)
    assert (np.diff(forest.margin(probe).reshape(20, 50), axis=1) <= 1e-9).all()


def test_quality_without_labels_keeps_what_passes(spark, docs, none):
    empty = spark.createDataFrame([], "doc_id long, quality int")
    assert quality.train(docs, empty) is None
    assert all(r["kept"] == (not r["base_failed"]) for r in quality.judge(docs, None).collect())
    assert quality.judge(none, None).count() == 0


def test_clashing_names_are_replaced_and_others_kept(spark):
    df = spark.createDataFrame([(1, sentence(random.Random(1), 60), 9, "x")], "doc_id long, text string, kept int, other string")
    row = quality.judge(df, None).first()
    assert row["kept"] is True and row["other"] == "x"
    row = mixing.assign(df.withColumn("source", F.lit("s")).withColumn("size", F.lit("y"))).first()
    assert row["size"] == 60 and row["other"] == "x"
    row = repeats.remove_repeats(df.withColumn("n_bytes", F.lit("z"))).first()
    assert row["n_removed"] == 0 and row["other"] == "x"


# --- packing


def test_packing_round_trip(spark, docs, rows, none):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(registry.tokenizer_path())
    got = packing.pack_documents(docs, registry.tokenizer_path()).collect()
    whole = defaultdict(list)
    for r in got:
        assert zlib.crc32(r["ids"]) == r["ids_crc32"] and len(r["ids"]) == 4 * r["length"]
        whole[r["doc_id"]].append((r["start"], np.frombuffer(r["ids"], "<u4").tolist(), r["doc_tokens"]))
    times = Counter(r[0] for r in rows)
    for doc, text in {r[0]: r[1] for r in rows}.items():
        ids = tokenizer.encode(text or "", add_special_tokens=False).ids + [1]
        pieces = sorted(whole[doc])[:: times[doc]]
        assert [x for _, p, _ in pieces for x in p] == ids and pieces[0][2] == len(ids)
    places = defaultdict(list)
    for r in got:
        places[r["sequence_id"]].append((r["offset"], r["length"]))
    for some in places.values():
        at = 0
        for offset, length in sorted(some):
            assert offset == at
            at += length
        assert at <= packing.CAPACITY
    assert packing.pack_documents(none, registry.tokenizer_path()).count() == 0


@pytest.mark.parametrize("seed", range(5))
def test_histogram_packing_places_every_piece(seed):
    rng = random.Random(seed)
    lengths = [rng.choice([rng.randrange(1, 2049), 2048, 700, 1]) for _ in range(3000)]
    patterns = packing.histogram_packing(Counter(lengths))
    placed = Counter()
    for pattern, packs in patterns:
        assert sum(pattern) <= 2048 and packs > 0
        for x in pattern:
            placed[x] += packs
    assert placed == Counter(lengths)
    assert sum(n for _, n in patterns) * 2048 < 1.10 * sum(lengths)  # a third of the short ones share one awkward length


def test_histogram_packing_wastes_little_on_rests():
    rng = random.Random(0)
    lengths = [min(2048, int(rng.lognormvariate(6.5, 1)) + 1) for _ in range(5000)]
    patterns = packing.histogram_packing(Counter(lengths))
    assert sum(n for _, n in patterns) * 2048 < 1.01 * sum(lengths)


def test_word_encoder_equals_tokenizer():
    from tokenizers import Tokenizer

    tokenizer, own = Tokenizer.from_file(registry.tokenizer_path()), packing.WordEncoder(registry.tokenizer_path())
    rng = random.Random(2)
    letters = "abcXYZéÉßİΣςσ''s'T!?.,-_<|>0129 \t\n ​́中文🎈ǅﬁ"
    for text in ["", "<|endoftext|> <|startoftext|>x", "don't STOP'S it's", *("".join(rng.choice(letters) for _ in range(rng.randrange(60))) for _ in range(800))]:
        assert np.frombuffer(own.encode(text), "<u4").tolist() == tokenizer.encode(text, add_special_tokens=False).ids, text


# --- near duplicates


def brute_components(texts, k, percent):
    sets = {}
    for d, text in texts.items():
        w = words_of(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
        sets[d] = {tuple(w[i : i + k]) for i in range(len(w) - k + 1)} if len(w) >= k else ({tuple(w)} if w else set())
    parent = {d: d for d in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    ids = sorted(sets)
    for i, a in enumerate(ids):
        for b in ids[i + 1 :]:
            both = len(sets[a] & sets[b])
            if both and 100 * both >= percent * (len(sets[a]) + len(sets[b]) - both):
                x, y = find(a), find(b)
                parent[max(x, y)] = min(x, y)
    return {d: (len(sets[d]), find(d)) for d in sets}


@pytest.mark.parametrize(("small", "depth"), [(32, 4), (2, 2)])
def test_components_equal_brute_force(docs, rows, small, depth):
    """Also with tiny nodes, so that large nodes, centres and the last level's blocks are used."""
    got = neardup.components_of(docs, words=4, small=small, depth=depth).collect()
    want = brute_components({r[0]: r[1] for r in rows}, 4, 80)
    assert len(got) == len(rows)
    for r in got:
        assert (r["n_shingles"], r["component_id"]) == want[r["doc_id"]]
        assert r["kept"] == (r["doc_id"] == r["component_id"])


def test_chain_of_near_copies_is_one_component(spark):
    rng = random.Random(9)
    w = sentence(rng, 150).split()
    texts = []
    for i in range(60):
        texts.append(" ".join(w))
        w[(i * 7) % 150] = f"new{i}"
    rows = [(i, t, "en", "s", None) for i, t in enumerate(texts)]
    got = neardup.components_of(spark.createDataFrame(rows, SCHEMA), words=4, small=4, depth=2).collect()
    want = brute_components(dict(enumerate(texts)), 4, 80)
    assert {r["doc_id"]: r["component_id"] for r in got} == {d: c for d, (_, c) in want.items()}


def test_hot_group_of_uneven_copies_equals_brute_force(spark, monkeypatch):
    """One text with none to a third of its words changed, and a second such group: candidates
    abound, links are few, and the last level needs several blocks."""
    monkeypatch.setattr(neardup, "BLOCK_ROWS", 40)
    rng = random.Random(4)
    texts = []
    for _ in range(2):
        base = sentence(rng, 90).split()
        for k in range(110):
            w = list(base)
            for i in rng.sample(range(len(w)), k % 30):
                w[i] = f"new{rng.randrange(50)}"
            texts.append(" ".join(w))
    rows = [(i, t, "en", "s", None) for i, t in enumerate(texts)]
    got = neardup.components_of(spark.createDataFrame(rows, SCHEMA), words=4, small=8, depth=3).collect()
    want = brute_components(dict(enumerate(texts)), 4, 80)
    assert {r["doc_id"]: r["component_id"] for r in got} == {d: c for d, (_, c) in want.items()}


def test_near_duplicates_edge_cases(spark, docs, none):
    assert neardup.components_of(none).count() == 0
    assert neardup.drop_near_duplicates(none).count() == 0
    kept = neardup.drop_near_duplicates(docs)
    assert kept.columns == docs.columns
    df = spark.createDataFrame([(None, "a b c d e f", None, None, None), (None, None, None, None, None), (3, "a b c d e f", None, None, None)], SCHEMA)
    assert {(r["doc_id"], r["component_id"]) for r in neardup.components_of(df).collect()} == {(None, None), (3, 3)}


def test_near_duplicates_with_clashing_names(spark):
    rng = random.Random(9)
    one, two = sentence(rng, 80), sentence(rng, 80)
    names = ["id", "text", "rep", "sig", "node", "a", "b", "k1", "n", "component", "__own", "n_shingles", "kept"]
    rows = [(i, t, *["x"] * (len(names) - 1)) for i, t in [(1, one), (2, one), (3, two), (3, two), (3, two + " more"), (4, None), (4, None)]]
    df = spark.createDataFrame(rows, "doc_id long, text string, " + ", ".join(f"{n} string" for n in names if n != "text"))
    got = {(r["doc_id"], r["component_id"]) for r in neardup.components_of(df).collect()}
    assert got == {(1, 1), (2, 1), (3, 3), (4, 4)}
    left = neardup.drop_near_duplicates(df.drop("__own"))
    assert left.columns == df.drop("__own").columns and sorted(r["doc_id"] for r in left.collect()) == [1, 3, 4, 4]
    again = neardup.drop_near_duplicates(df.drop("__own").orderBy(F.desc("text"))).where("doc_id = 3").first()["text"]
    assert again == left.where("doc_id = 3").first()["text"]


def test_other_columns_never_clash(spark):
    """Names that operators use inside, as columns of the caller."""
    rng = random.Random(2)
    names = ["id", "block", "data", "ids", "keys", "n_bytes", "round", "held_out", "length", "start", "piece", "label", "labels", "choices", "score", "media", "tile", "dhash", "n_words", "kept_text", "size", "words", "x"]
    df = spark.createDataFrame([(i, sentence(rng, 60), "en", "s", *["z"] * len(names)) for i in range(4)], "doc_id long, text string, lang string, source string, " + ", ".join(f"{n} string" for n in names))
    assert lm.score(df, F.lit(False)).count() == 4
    assert packing.pack_documents(df, registry.tokenizer_path()).count() >= 4
    assert licences.scan(df).count() == media.text_media(df).count() == 4
    assert quality.judge(df, None).select("id").distinct().collect() == [("z",)]
    assert repeats.remove_repeats(df, as_text=True).select("kept_text", "block", "data").count() == 4
    assert langid.identify(df.withColumn("held", F.lit(False)), langid.train(df, F.lit(True)), keep=["doc_id"]).count() == 4
    assert mixing.assign(df).select("id", "x", "taken").count() == 4


def test_ids_of_any_type(spark):
    rng = random.Random(6)
    df = spark.createDataFrame([(f"d{i}", sentence(rng, 70)) for i in range(5)] + [(None, "x y z")], "doc_id string, text string")
    assert {r["doc_id"] for r in lm.score(df, F.lit(False)).collect()} == {None, *(f"d{i}" for i in range(5))}
    assert {r["doc_id"] for r in packing.pack_documents(df, registry.tokenizer_path()).collect()} == {None, *(f"d{i}" for i in range(5))}
    with pytest.raises(TypeError):
        repeats.remove_repeats(df)


def test_texts_beyond_slices_and_blocks(spark, monkeypatch):
    """One text larger than a slice of texts, a block of every kind and the capacity of a pack."""
    rng = random.Random(8)
    long = sentence(rng, 260_000)
    assert len(long) > 1_500_000
    monkeypatch.setattr("sievewright.llm.common.SLICE_CHARS", 500_000)
    monkeypatch.setattr(lm, "BLOCK", 400_000)
    monkeypatch.setattr(repeats, "BLOCK", 300_000)
    rows = [(1, long), (2, long[400_000:700_000]), (3, "short one"), (4, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(1)
    stats = {r["doc_id"]: r["n_words"] for r in quality.judge(df, None).collect()}
    assert stats == {1: 260_000, 2: len(rows[1][1].split()), 3: 2, 4: 0}
    cut = {r["doc_id"]: (r["n_bytes"], r["n_removed"]) for r in repeats.remove_repeats(df).collect()}
    assert cut == {1: (len(long), 0), 2: (300_000, 300_000), 3: (9, 0), 4: (0, 0)}
    assert {r["doc_id"]: r["n_tokens"] for r in lm.score(df, F.lit(False), rounds=1).collect()} == {d: len((t or "").split()) + 1 for d, t in rows}
    assert {r["doc_id"]: r["n_words"] for r in licences.scan(df).collect()}[3] == 2
    pieces = packing.pack_documents(df, registry.tokenizer_path(), with_ids=False).groupBy("doc_id").agg(F.sum("length").alias("n"), F.max("doc_tokens").alias("all")).collect()
    assert all(r["n"] == r["all"] for r in pieces) and len(pieces) == 4


def test_connected_components(spark):
    rng = random.Random(1)
    edges = [(i, i + 1) for i in range(20)] + [(rng.randrange(100, 200), rng.randrange(100, 200)) for _ in range(70)]
    parent = {}

    def find(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        x, y = find(a), find(b)
        parent[max(x, y)] = min(x, y)
    got = {r["node"]: r["component"] for r in connected(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert all(got.get(x, x) == find(x) for x in parent)


def test_signatures_estimate_similarity():
    rng = np.random.default_rng(0)
    x = rng.integers(0, 2**63, 1000).astype(np.uint64)
    y = np.concatenate([x[:800], rng.integers(0, 2**63, 200).astype(np.uint64)])
    s = shingles.signatures([np.sort(x), np.sort(y)], 1024)
    assert abs((s[0] == s[1]).mean() - 800 / 1200) < 0.06


# --- language


def test_language_held_out_accuracy(spark, sf_small):
    got = registry.op4_language(spark, sf_small).join(spark.read.parquet(f"{sf_small}/documents.parquet").select("doc_id", "lang"), "doc_id")
    rows = got.where("held_out AND lang IS NOT NULL").collect()
    assert sum(r["lang"] == r["lang_pred"] for r in rows) >= 0.97 * len(rows)
    assert all(0 <= r["score"] <= 1 for r in rows)


def test_language_edge_cases(spark, docs, rows, none):
    model = langid.train(docs, crc_fold(F.col("doc_id"), 3) != 1)
    got = {r["doc_id"]: r for r in langid.identify(docs, model, keep=["doc_id"]).collect()}
    for doc, text, *_ in rows:
        assert (got[doc]["lang_pred"] == "und") == (not any(c.isalpha() for c in text or ""))
    assert langid.train(none, F.lit(True)) is None
    assert langid.identify(none, None).count() == 0
    assert langid.identify(docs, None, keep=["doc_id"]).where("lang_pred <> 'und' OR score <> 0").count() == 0


def test_ngrams_do_not_depend_on_slices(monkeypatch):
    text = "äbc dé" * 50
    whole = langid.ngram_counts(text)
    monkeypatch.setattr(langid, "SLICE", 7)
    cut = langid.ngram_counts(text)
    assert (whole[0] == cut[0]).all() and (whole[1] == cut[1]).all()


def test_ftrl_is_sparse_and_separates():
    rows = [(np.array([i % 2, 5, langid.SPACE]), np.array([1.0, 1.0, 1.0]), i % 2) for i in range(200)]
    w = langid.fit_ftrl(rows, 2)
    assert np.count_nonzero(w[10:1000]) == 0 and w[0, 0] > w[0, 1] and w[1, 1] > w[1, 0]


# --- language model


def test_lm_base_and_held_out_gain(spark, sf_small):
    got = registry.op5_lm(spark, sf_small).collect()
    texts = spark.read.parquet(f"{sf_small}/documents.parquet").select("doc_id", "text").collect()
    tokens = lambda t: [*(t or "").encode().lower().split(), b"\n"]
    held = lambda d: zlib.crc32(str(d).encode()) % 5 == 1
    c = Counter(w for r in texts if not held(r["doc_id"]) for w in tokens(r["text"]))
    n, v = sum(c.values()), len(c)
    by = {r["doc_id"]: r for r in got}
    for r in texts:
        w, g = tokens(r["text"]), by[r["doc_id"]]
        assert (g["n_tokens"], g["n_known"], g["train_tokens"], g["held_out"]) == (len(w), sum(x in c for x in w), n, held(r["doc_id"]))
        assert g["base_score"] == pytest.approx(sum(math.log10((c[x] + 0.5) / (n + 0.5 * (v + 1))) for x in w), rel=1e-9)
    out = [r for r in got if r["held_out"]]
    assert sum(r["score"] for r in out) > sum(r["base_score"] for r in out) + 0.1 * sum(r["n_tokens"] for r in out)


def test_lm_blocks_keep_tokens():
    words = lm.Words(["a b a", None, "B c \n a"])
    again = lm.Words.unpacked(*words.packed(np.ones(words.token.size, bool)), words.lengths)
    assert (again.token == words.token).all() and (again.hash == words.hash).all() and (again.tail == words.tail).all()
    some = again.only(np.array([True, False, True]))
    assert some.lengths.tolist() == [4, 4] and some.token.size == 8


def test_lm_rows_grow_with_the_corpus():
    assert [lm.outer_rows(n) for n in (0, 10**6, 4 << 28, 5 << 28, 10**15)] == [1 << 13, 1 << 13, 1 << 14, 1 << 15, 1 << 16]


@pytest.mark.parametrize("span", [1.0, 200.0])
def test_lm_softmax_equals_the_formula(span):
    z = np.random.default_rng(2).uniform(-span, span, (30, 7)).astype(np.float32)
    want = np.exp(z.astype(float) - z.max(axis=1, keepdims=True))
    want /= want.sum(axis=1, keepdims=True)
    chosen = z.argmax(axis=1)
    assert lm._chosen_log(z.copy(), chosen) == pytest.approx(np.log(want[np.arange(30), chosen]), abs=1e-4)
    assert lm._softmax(z.copy())[0] == pytest.approx(want, abs=1e-5)


@pytest.mark.parametrize("passes", [2, 48])
def test_lm_gradient_steps_equal_a_plain_loop(monkeypatch, passes):
    monkeypatch.setattr(lm, "PASSES", passes)
    rng = np.random.default_rng(5)
    gradient, rows = rng.normal(size=(40, 6)).astype(np.float32), [rng.integers(0, 9, 40) for _ in range(3)]
    weights, past, used = np.zeros((9, 6), np.float32), np.zeros(9, np.float32), np.zeros(9, np.int64)
    lm._add_rows(weights, past, used, rows, gradient)
    for row in range(9):
        total = sum((gradient[i].astype(float) for r in rows for i in range(40) if r[i] == row), np.zeros(6))
        assert weights[row] == pytest.approx(-lm.RATE * total / np.sqrt((total**2).sum() + 1e-6), abs=1e-4)
        assert used[row] == sum(int((r == row).sum()) for r in rows)


def test_lm_score_equals_a_plain_softmax(spark):
    """A tiny corpus without training rounds: class shares, shares inside classes, pair weights."""
    train, held = ["x y x z", "x y q", "z q"], ["x y", "q new"]
    rows = [(i, t, False) for i, t in enumerate(train)] + [(10 + i, t, True) for i, t in enumerate(held)]
    got = {r["doc_id"]: r["score"] for r in lm.score(spark.createDataFrame(rows, "doc_id long, text string, out boolean"), F.col("out"), rounds=0).collect()}
    count = Counter(w for t in train for w in [*t.split(), "\n"])
    pair = Counter(p for t in train for p in zip([None, *t.split()], [*t.split(), "\n"], strict=True))
    order = sorted(count, key=lambda w: -count[w])
    kind = lambda w: 0 if w in order[: lm.HEAD] else lm.HEAD // lm.GROUP + lm.tail_class(w.encode())
    n = np.zeros(lm.CLASSES)
    n[0] = sum(count.values())
    share = (n + 0.5) / (n + 0.5).sum()

    def inside(before, w):
        if w not in count:
            return math.log(0.5 / 0.5)  # an empty class: c = N = V = 0
        seen = [x for x in order if pair[before, x]]
        base = {x: count[x] / sum(count.values()) for x in order}
        weight = dict.fromkeys(order, 0.0)
        total = sum(pair[before, x] for x in seen)
        for _ in range(3000):
            norm = sum(base[x] * math.exp(weight[x]) for x in order)
            for x in seen:
                weight[x] += 0.1 * (pair[before, x] - total * base[x] * math.exp(weight[x]) / norm - weight[x] / lm.PRIOR)
        return math.log(base[w]) + weight[w] - math.log(sum(base[x] * math.exp(weight[x]) for x in order))

    for doc, t in enumerate(held):
        words = [*t.split(), "\n"]
        want = sum(math.log(share[kind(w)]) + inside(b, w) for b, w in zip([None, *t.split()], words, strict=True)) / math.log(10)
        assert got[10 + doc] == pytest.approx(want, abs=5e-3)


def test_lm_factors_sum_to_one():
    head = np.sort(np.random.default_rng(1).integers(0, 2**63, lm.HEAD).astype(np.uint64))
    model = lm.Model(10, 5, head, np.arange(lm.HEAD), np.full(lm.CLASSES, 9), np.full(lm.CLASSES, 3), np.full(lm.HEAD, -np.log(lm.GROUP), np.float32))
    model.outer += np.random.default_rng(0).normal(size=model.outer.shape).astype(np.float32)
    words = lm.Words(["a b c a b"])
    rows, inner = lm.contexts(words, model.places(words)[0])
    assert lm._softmax(lm.outer_logits(model, rows))[0].sum(axis=1) == pytest.approx(1, rel=1e-4)
    assert lm._softmax(lm.inner_logits(model, inner, np.zeros(inner.size, int)))[0].sum(axis=1) == pytest.approx(1, rel=1e-4)


def test_lm_skip_feature_over_classes():
    kinds, words = np.arange(6) % lm.CLASSES, lm.Words(["a b c d e"])
    other = kinds.copy()
    other[words.token[0]] = lm.CLASSES - 1  # the third word before the fourth
    rows, changed = lm.contexts(words, kinds)[0], lm.contexts(words, other)[0]
    assert rows.shape[1] == lm.FEATURES == 5 and lm.TAIL == 32 and lm.STEP == 4096
    assert np.flatnonzero(rows[3] != changed[3]).tolist() == [4]


def test_lm_pairs_sum_to_one_and_follow_counts():
    group, n = np.array([0, 0, 0, 1, 1]), np.array([8, 1, 0, 0, 0])
    base = np.log([0.1, 0.3, 0.6, 0.5, 0.5]).astype(np.float32)
    got = np.exp(lm.fit_pairs(group, n, base))
    assert np.bincount(group, got) == pytest.approx(1, rel=1e-5)
    assert got[0] > 0.5 and got[3:] == pytest.approx(0.5)
    weights = np.log(got[:2] / np.exp(base[:2]) * np.exp(base[2]) / got[2])
    assert weights / lm.PRIOR == pytest.approx(n[:2] - 9 * got[:2], abs=1e-3)


def test_lm_previous_word_raises_one_tail_word_over_another(spark):
    twins: dict[int, list[str]] = {}
    for i in range(2000):
        twins.setdefault(lm.tail_class(f"w{i:04d}".encode()), []).append(f"w{i:04d}")
    left, right = twins[lm.tail_class(b"w1000")][:2]
    common = " ".join(f"c{i} c{i} c{i}" for i in range(lm.HEAD))
    train = [common] * 30 + [f"x {left}", f"y {right}"] * 20
    held = [f"x {left}", f"x {right}"]
    rows = [(i, t, False) for i, t in enumerate(train)] + [(1000 + i, t, True) for i, t in enumerate(held)]
    got = {r["doc_id"]: r["score"] for r in lm.score(spark.createDataFrame(rows, "doc_id long, text string, out boolean"), F.col("out")).collect()}
    assert got[1000] > got[1001] + 1


def test_lm_edge_cases(spark, docs, rows, none):
    got = lm.score(docs, F.lit(False)).collect()
    assert len(got) == len(rows) and all(math.isfinite(r["score"]) and r["score"] < 0 for r in got)
    assert lm.score(none, F.lit(False)).count() == 0
    only = lm.score(docs, F.lit(True)).collect()
    assert {r["train_tokens"] for r in only} == {0} and {r["n_known"] for r in only} == {0}
    assert all(math.isfinite(r["score"]) for r in only)


# --- suffix-array deduplication


@pytest.mark.parametrize("alphabet", [1, 2, 26])
def test_windows_are_sorted(alphabet):
    rng = np.random.default_rng(alphabet)
    t = rng.integers(0, alphabet, 700).astype(np.uint8)
    t = np.concatenate([t, t[:300], t[200:]])
    starts = np.arange(t.size - 49)
    order, run = deep_shallow.sort_windows(np.concatenate([t, np.zeros(16, np.uint8)]), starts, 50)
    raw = t.tobytes()
    shown = [raw[i : i + 50] for i in starts[order]]
    assert shown == sorted(shown)
    assert [shown[i] == shown[i + 1] for i in range(len(shown) - 1)] == [bool(run[i] == run[i + 1]) for i in range(len(shown) - 1)]


def brute_repeats(texts):
    first, out = {}, {}
    for d in sorted(texts):
        raw = (texts[d] or "").encode()
        cut = bytearray(len(raw))
        for i in range(len(raw) - 49):
            if first.setdefault(raw[i : i + 50], d) < d:
                cut[i : i + 50] = b"\x01" * 50
        runs = sum(1 for i in range(len(cut)) if cut[i] and not (i and cut[i - 1]))
        out[d] = (len(raw), sum(cut), runs, bytes(b for b, c in zip(raw, cut, strict=True) if not c))
    return out


@pytest.mark.parametrize("block", [2_000_000, 700])
def test_repeats_equal_brute_force(monkeypatch, docs, rows, block):
    """Also with blocks smaller than texts, so that pieces, buckets and seams are used."""
    monkeypatch.setattr(repeats, "BLOCK", block)
    got = repeats.remove_repeats(docs).collect()
    want = brute_repeats({r[0]: r[1] for r in rows})
    assert len(got) == len(rows)
    for r in got:
        assert (r["n_bytes"], r["n_removed"], r["n_spans"], bytes(r["kept_bytes"])) == want[r["doc_id"]], r["doc_id"]
        assert sum(s["end"] - s["start"] for s in r["spans"]) == r["n_removed"]


def test_repeats_edge_cases(spark, none):
    assert repeats.remove_repeats(none).count() == 0
    same = "q" * 80
    df = spark.createDataFrame([(None, same, None, None, None), (4, same, None, None, None), (4, same, None, None, None), (4, "z" + same, None, None, None)], SCHEMA)
    got = sorted((r["doc_id"] is None, r["n_bytes"], r["n_removed"]) for r in repeats.remove_repeats(df).collect())
    assert got == [(False, 80, 0), (False, 80, 0), (False, 81, 0), (True, 80, 80)]


# --- licences


def brute_licences(text):
    w = [x.lower() for x in re.findall(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub(rb"[A-Z]", lambda m: m[0].lower(), (text or "").encode()))]
    places, labels = [], set()
    for phrase, label in licences.BASE.items():
        p = phrase.encode().split()
        for i in range(len(w) - len(p) + 1):
            if w[i : i + len(p)] == p:
                places.append(i)
                labels.add(label)
    return len(w), len(places), min(places, default=None), max(places, default=None), ",".join(sorted(labels))


def test_licence_base_equals_brute_force(spark, docs, none):
    rng = random.Random(4)
    parts = ["MIT License", "mit", "license", "GNU General Public License", "Apache\nLicense", "cc by", "CC-BY", "CC BY NC", "é", "x1", "_", ".", "mit license mit license"]
    texts = [" ".join(rng.choice(parts) for _ in range(rng.randrange(12))) for _ in range(300)]
    df = spark.createDataFrame([(i, t, None, None, None) for i, t in enumerate(texts)], SCHEMA).unionByName(docs)
    assert licences.scan(df).count() == df.count()
    got = {r["doc_id"]: r for r in licences.scan(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()}
    for i, t in enumerate(texts):
        r = got[i]
        assert (r["n_words"], r["n_base"], r["first_word"], r["last_word"], r["base_labels"]) == brute_licences(t), t
        assert set(filter(None, r["base_labels"].split(","))) <= set(filter(None, r["labels"].split(","))) and 0 <= r["score"] <= 1
    assert licences.scan(none).count() == 0
    empty = licences.scan(docs.where("text IS NULL")).first()
    assert (empty["n_words"], empty["n_base"], empty["first_word"], empty["labels"], empty["score"]) == (0, 0, None, "", 0.0)


@pytest.mark.parametrize(
    ("expression", "choices"),
    [
        ("MIT", [{"mit"}]),
        ("MIT OR Apache-2.0", [{"mit"}, {"apache"}]),
        ("MIT AND (GPL-2.0-only OR BSD-3-Clause)", [{"mit", "gpl"}, {"mit", "bsd"}]),
        ("GPL-2.0-or-later WITH Classpath-exception-2.0 OR MIT", [{"gpl"}, {"mit"}]),
        ("MIT OR Apache-2.0 AND ISC", [{"mit"}, {"apache", "isc"}]),
        ("Unknown-1.0", []),
    ],
)
def test_licence_expressions(expression, choices):
    assert list(map(set, licences.evaluate(expression))) == choices


@pytest.mark.parametrize("bad", ["", "AND MIT", "MIT OR", "(MIT", "MIT)", "MIT MIT", "()"])
def test_malformed_expressions(bad):
    with pytest.raises(ValueError):
        licences.evaluate(bad)


def test_licence_tags():
    row = licences.scan_text("# SPDX-License-Identifier: (MIT OR GPL-2.0+) AND BSD-3-Clause */ rest\nLicense: ISC")
    assert row[5] == "bsd,gpl,isc,mit" and row[1] == 0


@pytest.mark.parametrize("form", ["{}", "({})"])
def test_licence_tags_of_any_length(form):
    names = ["MIT"] * 58 + ["ISC", "BSD-3-Clause"]
    row = licences.scan_text("SPDX-License-Identifier: " + form.format(" AND ".join(names)) + " */ rest")
    assert row[5] == "bsd,isc,mit" and row[6] == 1 - 0.5**3
    far = licences.scan_text("SPDX-License-Identifier: " + form.format(f"MIT OR{' ' * 3000}ISC OR x{'y' * 3000} OR Zlib"))
    assert far[5] == "isc,mit,zlib"


@pytest.mark.parametrize("line", ["MIT AND", "MIT OR (ISC", "(MIT", "MIT ) ISC", "MIT ISC", "AND MIT", "", "MIT OR (ISC AND Zlib) WITH", "(MIT) (ISC)", "MIT WITH a OR ISC AND (Zlib OR"])
def test_licence_tags_equal_the_longest_start_that_parses(line):
    tokens, want = licences._SPLIT.findall(line), set()
    for n in range(len(tokens), 0, -1):
        try:
            want = set().union(*licences.evaluate(" ".join(tokens[:n])))
            break
        except ValueError:
            pass
    assert set().union(*licences.tag_choices(line)[1]) == want
    assert licences.tag_choices(line)[0] >= want


def test_licence_choices_of_or_and_and_differ():
    either, both = (licences.scan_text(f"License: MIT {op} GPL-2.0") for op in ("OR", "AND"))
    assert either[5] == both[5] == "gpl,mit"
    assert (either[7], either[8], both[7], both[8]) == ("gpl|mit", "", "gpl+mit", "gpl,mit")
    assert either[6] == 1 - 0.5**2 and both[6] == 1 - 0.5**3
    assert licences.scan_text("License: MIT OR (MIT AND ISC)")[5:9:2] == ("isc,mit", "mit")


def test_licence_expression_of_ten_thousand_names():
    names = ["MIT", "Unknown-1", "ISC"] * 3334
    row = licences.scan_text("License: " + " AND ".join(names))
    assert row[7] == "isc+mit" and row[8] == "isc,mit"
    row = licences.scan_text("License: (" + ") AND (".join(["MIT OR ISC", "Zlib OR MPL-2.0", "EPL-2.0 OR BSL-1.0"] * 3000) + ")")
    assert len(row[7].split("|")) == 8 and row[8] == ""


def test_licence_unknown_names_are_names_of_their_own():
    row = lambda e: licences.scan_text(f"License: {e}")  # noqa: E731  labels 5, score 6, choices 7, required 8
    assert row("Foo OR MIT")[5:] == ("mit", 0.75, "?|mit", "")
    assert row("LicenseRef-A OR (LicenseRef-B AND MIT)")[5:] == ("mit", 0.75, "?|mit", "")
    assert row("(LicenseRef-Own AND MIT) OR LicenseRef-Shop")[5:] == ("mit", 0.75, "?|mit", "")
    assert row("Foo AND MIT")[5:] == ("mit", 0.875, "mit", "mit")
    assert row("Foo WITH MIT")[5:] == ("", 0.0, "", "") and row("MIT WITH Foo")[8] == "mit"
    assert row("Foo OR (Foo AND MIT)")[5:] == ("mit", 0.75, "?", "") and row("Foo")[5:] == ("", 0.0, "", "")
    assert licences.scan_text("sublicense: MIT")[5] == "" and licences.scan_text("ālicense: MIT")[5] == "" and licences.scan_text("(license: MIT)")[5] == "mit"
    assert licences.scan_text("The License:MIT\nLICENCE: ISC")[8] == "isc,mit"


def test_licence_required_equals_all_truth_assignments():
    rng = random.Random(8)
    names = {"MIT": "mit", "ISC": "isc", "GPL-2.0": "gpl", "Foo": None, "Bar": None}

    def make(depth):
        if depth == 0 or rng.random() < 0.2:
            return rng.choice(list(names))
        a, b = make(depth - 1), make(depth - 1)
        op = rng.choice(["or", "or", "and", "and", "with"])
        return (op, a, rng.choice(list(names)) if op == "with" else b)

    def text(e):
        return e if isinstance(e, str) else f"({text(e[1])} {e[0].upper()} {text(e[2])})"

    def holds(e, true):
        if isinstance(e, str):
            return e in true
        left = holds(e[1], true)
        return left if e[0] == "with" else left or holds(e[2], true) if e[0] == "or" else left and holds(e[2], true)

    for _ in range(400):
        e = make(4)
        models = [m for k in range(32) if holds(e, m := {n for i, n in enumerate(names) if k >> i & 1})]
        want = {names[n] for n in set.intersection(*models) if names[n]}
        postfix = licences.to_postfix(text(e).lower())
        assert licences.required_labels(postfix) == want, text(e)
        least = [m for m in models if not any(x < m for x in models)]
        got, bits = licences._minimal(postfix)
        as_names = {frozenset(n for n in names if (label := names[n] or f"?{n.lower()}") in bits and c >> bits[label] & 1) for c in got}
        assert as_names == set(map(frozenset, least)), text(e)


def test_licence_lines_of_many_names_take_no_time():
    rng = random.Random(1)
    names = [s + ("1.0" if s[-1] == "-" else "") for s in licences.IDENTIFIERS]
    clause = lambda: "(" + " OR ".join(rng.sample(names, 3)) + ")"
    either = lambda: "(" + " AND ".join(rng.sample(names, 9)) + ")"
    for make, op in ((clause, " AND "), (either, " OR ")):
        line = "License: " + op.join(make() for _ in range(60_000 // 40))
        start = time.perf_counter()
        row = licences.scan_text(line)
        assert time.perf_counter() - start < 1.0  # about 0.1 s; a loaded machine is slower
        assert len(row[5].split(",")) == 18 and row[7] == "*"


# --- mixing


def test_mixing_meets_targets(spark, sf_small, none):
    got = registry.op8_mixing(spark, sf_small).collect()
    source = {r["doc_id"]: r["source"] for r in spark.read.parquet(f"{sf_small}/documents.parquet").select("doc_id", "source").collect()}
    taken, size, goal, large = Counter(), Counter(), {}, Counter()
    for r in got:
        s = source[r["doc_id"]]
        taken[s] += r["taken"]
        size[s] += r["size"]
        goal[s] = r["target"]
        large[s] = max(large[s], r["size"])
        assert r["taken"] <= 2 * r["size"] and r["taken"] % max(r["size"], 1) == 0
    assert all(abs(taken[s] - goal[s]) <= large[s] for s in goal)
    assert sum(goal.values()) == pytest.approx(1.5 * sum(size.values()))
    assert all(r["source_size"] == size[source[r["doc_id"]]] for r in got)
    again = registry.op8_mixing(spark, sf_small).collect()
    assert sorted(map(tuple, got), key=str) == sorted(map(tuple, again), key=str)
    assert mixing.assign(none).count() == 0 and mixing.schedule(mixing.assign(none)).count() == 0


def test_water_filling():
    assert mixing.targets({"a": 100, "b": 10, "c": 100}) == pytest.approx({"a": 177.0, "b": 20.0, "c": 118.0})
    goal = mixing.targets({"a": 1, "b": 1000, None: 50})
    assert goal["a"] == 2 and sum(goal.values()) == pytest.approx(1.5 * 1051) and all(goal[k] <= 2 * s + 1e-9 for k, s in {"a": 1, "b": 1000, None: 50}.items())
    assert mixing.targets({}) == {} and mixing.targets({"a": 0}) == {"a": 0.0}


def test_schedule_is_sorted_and_inverts_demand(docs, rows):
    assigned = mixing.assign(docs)
    assert assigned.count() == len(rows)
    parts = mixing.schedule(assigned, 3).withColumn("p", F.spark_partition_id()).collect()
    assert [r["position"] for r in sorted(parts, key=lambda r: r["p"])] == sorted(r["position"] for r in parts)
    b, e = 0.5, 1.5
    for t in (0.0, 0.2, 0.9, 1.0):
        part = (b * t + (e - b) * t * t / 2) / ((b + e) / 2)
        x = docs.limit(1).select(mixing.inverse_demand(F.lit(part), F.lit(b), F.lit(e))).first()[0]
        assert x == pytest.approx(t, abs=1e-9)


# --- media


def test_media_payload_round_trip(docs, rows, none):
    got = media.text_media(docs).collect()
    text = {r[0]: r[1] for r in rows}
    assert len(got) == len(rows)
    for r in got:
        raw = (text[r["doc_id"]] or "").encode()
        full = raw + b"\xff" * (max(1, -(-len(raw) // 576)) * 576 - len(raw))
        assert (r["n_bytes"], r["payload_bytes"], r["payload_sha256"], r["tail_crc32"]) == (len(raw), len(full), hashlib.sha256(full).hexdigest(), zlib.crc32(full[-32:]))
        shown = np.frombuffer(full, np.uint8).reshape(-1, 24).astype(float)
        means = brute_means(shown, 8, 9)
        close = np.abs(np.diff(means, axis=1)) < 1e-6
        bits = np.unpackbits(np.frombuffer(bytes.fromhex(r["dhash"]), np.uint8)).reshape(8, 8).astype(bool)
        assert ((bits == (np.diff(means, axis=1) > 0)) | close).all()
        assert np.abs(np.load(io.BytesIO(r["tile"])) - brute_means(shown, 16, 16)).max() <= 0.5 + 1e-6
        assert hashlib.sha256(r["media"]).hexdigest() == r["media_sha256"] and len(r["media"]) == r["media_bytes"]
    assert media.text_media(none).count() == 0


def brute_means(plane, rows, cols):
    """Area means by the overlap of every sample with every cell."""
    def overlap(n, cells):
        edges = [i * n / cells for i in range(cells + 1)]
        return np.array([[max(0.0, min(a + 1, edges[c + 1]) - max(a, edges[c])) for a in range(n)] for c in range(cells)])

    y, x = overlap(plane.shape[0], rows), overlap(plane.shape[1], cols)
    return y @ plane @ x.T / (plane.size / rows / cols)


def test_media_scales_by_the_largest_sample():
    assert media.plane(b"P5 2 1 15\n\x0f\x00").tolist() == [[255.0, 0.0]]
    grey = media.features_of(b"P5 2 2 65535\n" + (1000).to_bytes(2, "big") * 4)[2]
    assert set(np.load(io.BytesIO(grey)).ravel()) == {4}
    assert media.features_of(b"P5 1 1 15\n\x10")[3] is None and media.features_of(b"P5 1 1 0\n\x00")[3] is None


def bmp(bits, packed, masks, body, cols, rows):
    head = np.array([40, cols, rows], "<i4").tobytes() + np.array([1, bits], "<u2").tobytes() + np.array([packed, len(body), 0, 0, 0, 0], "<u4").tobytes()
    extra = np.array(masks, "<u4").tobytes()
    start = 14 + len(head) + len(extra)
    return b"BM" + np.array([start + len(body), 0, start], "<u4").tobytes() + head + extra + body


def test_bmp_masks():
    five = np.array([31 << 11, 63 << 5, 31, 0], "<u2").tobytes()
    assert media.decode(bmp(16, 3, [0xF800, 0x7E0, 0x1F], five, 4, -1)).tolist() == [[[255, 0, 0], [0, 255, 0], [0, 0, 255], [0, 0, 0]]]
    assert media.decode(bmp(16, 0, [], np.array([31 << 10, 31], "<u2").tobytes(), 2, 1)).tolist() == [[[255, 0, 0], [0, 0, 255]]]
    wide = np.array([0x0A0B0C00], "<u4").tobytes()
    assert media.decode(bmp(32, 3, [0xFF000000, 0xFF0000, 0xFF00], wide, 1, 1)).tolist() == [[[10, 11, 12]]]
    with pytest.raises(ValueError):
        media.decode(bmp(32, 3, [0, 0xFF0000, 0xFF00], wide, 1, 1))
    with pytest.raises(ValueError):
        media.decode(bmp(24, 3, [], bytes(4), 1, 1))


@pytest.mark.parametrize("shape", [(1, 1), (7, 5), (24, 24), (3, 40)])
def test_codecs(shape):
    plane = np.random.default_rng(0).integers(0, 256, shape).astype(np.uint8)
    assert (media.decode(media.encode_pgm(plane)) == plane).all()
    assert (media.decode(media.encode_bmp(plane)) == plane).all()


def test_other_forms():
    assert media.decode(b"P2\n# c\n2 2\n255\n0 10\n20 30\n").tolist() == [[0, 10], [20, 30]]
    assert media.decode(b"P1 2 2\n1 0\n0 1\n").tolist() == [[0, 255], [255, 0]]
    assert media.decode(b"P4 9 1\n" + bytes([0b10000000, 0b10000000])).tolist() == [[0] + [255] * 7 + [0]]
    assert media.decode(b"P6 1 1 255\n\x01\x02\x03").tolist() == [[[1, 2, 3]]]
    assert media.decode(b"P5 1 1 65535\n\x01\x02").tolist() == [[258]]
    pixels = bytes([1, 2, 3, 4, 5, 6, 0, 0])
    head = b"BM" + (54 + 8).to_bytes(4, "little") + bytes(4) + (54).to_bytes(4, "little") + (40).to_bytes(4, "little") + (2).to_bytes(4, "little") + (1).to_bytes(4, "little") + (1).to_bytes(2, "little") + (24).to_bytes(2, "little") + bytes(24)
    assert media.decode(head + pixels).tolist() == [[[3, 2, 1], [6, 5, 4]]]


def test_area_resize_is_the_mean_of_areas():
    plane = np.arange(48.0).reshape(6, 8)
    assert media.area_resize(plane, 3, 4).tolist() == plane.reshape(3, 2, 4, 2).mean(axis=(1, 3)).tolist()
    assert media.area_resize(plane, 5, 7).mean() == pytest.approx(plane.mean())


def test_broken_pictures_get_nulls(spark):
    df = spark.createDataFrame([(1, b"P5 9 9 255\n"), (2, b""), (3, None), (4, b"BM")], "doc_id long, media binary")
    assert all(r["dhash"] is None and r["tile"] is None for r in media.media_features(df).collect())


# --- chat


def test_chat_round_trip(spark):
    hard = ["plain", None, "", "<|im_end|>\n", "a\\", "\\<|x", "<\\|", "</s>[INST] ok [/INST]", "line\nline", "🎈<|im_start|>user\n"]
    rng = random.Random(6)
    rows = []
    for conv in range(40):
        for turn in range(rng.randrange(1, 8)):
            rows.append((conv, turn, rng.choice(["system", "user", "assistant", None, "odd\nrole", "r\\"]), rng.choice(hard)))
    got = {r["conv_id"]: r for r in chat.digests(chat.expand(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string"))).collect()}
    by = defaultdict(list)
    for conv, turn, role, text in rows:
        by[conv].append((turn, role or "unknown", text or ""))
    assert set(got) == set(by)
    for conv, turns in by.items():
        turns.sort()
        said = "".join(f"{r}\n{t}\n" for _, r, t in turns)
        loss = "".join(t for _, r, t in turns if r == "assistant")
        r = got[conv]
        assert (r["n_turns"], r["turns_sha256"]) == (len(turns), hashlib.sha256(said.encode()).hexdigest())
        assert (r["loss_chars"], r["loss_sha256"]) == (len(loss), hashlib.sha256(loss.encode()).hexdigest())


def test_every_reply_is_an_example(spark):
    rows = [(1, 0, "user", "a"), (1, 1, "assistant", "b"), (1, 2, "user", "c"), (1, 3, "assistant", "d"), (1, 4, "user", "e"), (2, 0, "user", "x")]
    got = chat.expand(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")).orderBy("conv_id", "example").collect()
    assert [(r["conv_id"], r["n_turns"], r["loss_len"]) for r in got] == [(1, 2, 1), (1, 4, 1), (1, 5, 0), (2, 1, 0)]
    assert [r["formatted"][r["loss_start"] : r["loss_start"] + r["loss_len"]] for r in got] == ["b", "d", "", ""]
    empty = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert chat.digests(chat.expand(empty)).count() == 0


def test_chat_plan_has_no_python(spark, sf_small, capsys):
    registry.op10_chat(spark, sf_small).explain("formatted")
    assert not re.search("Python|Pandas|Arrow", capsys.readouterr().out)


# --- SQL twins


def test_twins(spark, sf_small):
    import duckdb

    con = duckdb.connect()
    for t in ("documents", "conversations"):
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{sf_small}/{t}.parquet'")
    for name, sql in registry.ORACLE_SQL.items():
        got, want = registry.QUERIES[name](spark, sf_small), con.sql(sql)
        columns = sorted(got.columns)
        assert columns == sorted(want.columns)
        assert sorted(map(str, (tuple(r[c] for c in columns) for r in got.collect()))) == sorted(map(str, con.sql(f"SELECT {', '.join(columns)} FROM ({sql})").fetchall()))
