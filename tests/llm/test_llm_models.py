"""Near duplicates, vector search, classifiers, SentencePiece and the pipeline
against brute force, the reference tokenizer, held-out labels and round trips."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from recaudo.llm import folds, near_dedup, quality, sentencepieces, toxicity, vp_search
from recaudo.llm.common import read_table

LARGER = "/root/testdata/sf0.01"


# --- near duplicates -----------------------------------------------------------
def components_by_brute_force(rows, width, percent=80):
    sets = []
    for _, t in rows:
        w = "".join(c.lower() if "A" <= c <= "Z" else c for c in t or "")
        for space in "\t\n\x0b\x0c\r":
            w = w.replace(space, " ")
        w = [x for x in w.split(" ") if x]
        sets.append({tuple(w[i:i + width]) for i in range(max(1, len(w) - width + 1))} if w else set())
    parent = list(range(len(rows)))

    def root(k):
        while parent[k] != k:
            parent[k] = parent[parent[k]]
            k = parent[k]
        return k
    for i, a in enumerate(sets):
        for j in range(i):
            both = len(a & sets[j])
            if a and sets[j] and 100 * both >= percent * (len(a) + len(sets[j]) - both):
                parent[root(i)] = root(j)
    least = {}
    for k, (i, _) in enumerate(rows):
        least[root(k)] = min(least.get(root(k), i), i)
    return {i: (len(sets[k]), least[root(k)]) for k, (i, _) in enumerate(rows)}


def near_rows():
    rnd = random.Random(3)
    word = lambda: "".join(rnd.choice("abcdefgh") for _ in range(rnd.randrange(2, 7)))
    rows, n = [], 0

    def add(words):
        nonlocal n
        rows.append(((n * 37) % 1009, " ".join(words)))
        n += 1
    for size in (1, 2, 3, 4, 5, 30, 120):                    # pairs around the threshold
        for edits in (0, 1, 2, 3):
            text = [word() for _ in range(size)]
            add(text)
            for _ in range(3):
                other = list(text)
                for _ in range(edits):
                    other[rnd.randrange(size)] = word()
                add(other)
    base = [word() for _ in range(140)]                       # many variants of one text: like it, unlike each other
    variants = [base]
    for _ in range(150):
        v = list(base)
        for _ in range(2):
            v[rnd.randrange(140)] = word()
        variants.append(v)
    rnd.shuffle(variants)
    for v in variants:
        add(v)
    passage = [word() for _ in range(60)]                     # a passage many texts share
    for _ in range(60):
        add([word() for _ in range(80)] + passage)
    rows += [(2000, None), (2001, ""), (2002, " \t\n"), (2003, "One TWO"), (2004, "one\ttwo"), (2005, "Ä b"), (2006, "ä b")]
    return rows


def test_near_components_against_brute_force(spark):
    rows = near_rows()
    expected = components_by_brute_force(rows, 4)
    docs = spark.createDataFrame([(i, t, "clash", b"x") for i, t in rows], "doc_id long, text string, component_id string, labels binary")
    got = {r.doc_id: r for r in near_dedup.near_duplicates(docs, width=4).collect()}
    assert {i: (r.n_shingles, r.component_id) for i, r in got.items()} == expected
    assert all(r.kept == (i == r.component_id) for i, r in got.items())


def test_pairs_inside_a_boilerplate_region_that_are_no_hubs(spark):
    rnd = random.Random(12)
    word = lambda: "".join(rnd.choice("abcdefghijklmnop") for _ in range(6))
    shared, rows = [word() for _ in range(200)], []
    for k in range(260):                                      # every two 0.79 similar by the shared text
        own = [word() for _ in range(27)]
        rows.append((3 * k, " ".join(shared + own)))
        if k % 5 == 0:                                        # a partner that shares three more words: 0.81
            rows.append(((3 * k * 7919 + 1) % 7907 * 3 + 1, " ".join(shared + own[:3] + [word() for _ in range(24)])))
    expected = components_by_brute_force(rows, 4)
    assert sum(i != c for i, (_, c) in expected.items()) == 52
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in near_dedup.near_duplicates(docs, width=4).collect()}
    assert got == expected


def test_near_duplicates_of_repeated_rows_and_empty_tables(spark):
    text = "one two three four five six"
    docs = spark.createDataFrame([(1, text), (1, text), (2, text.upper()), (3, "other words stand here alone now")], "doc_id long, text string")
    out = near_dedup.near_duplicates(docs).collect()
    assert sorted((r.doc_id, r.component_id) for r in out) == [(1, 1), (1, 1), (2, 1), (3, 3)]
    assert sorted(r.doc_id for r in near_dedup.drop_near_duplicates(docs).collect()) == [1, 1, 3]
    assert near_dedup.near_duplicates(docs.limit(0)).count() == 0


def test_region_scan_by_blocks_finds_the_same_neighbours():
    import pyarrow as pa
    rng = np.random.default_rng(1)
    labels = np.sort(rng.integers(0, 3, (500, 4)).astype(">u4").view("S16").ravel())
    batch = pa.RecordBatch.from_arrays([pa.array(np.zeros(500, np.int32)), pa.array([x.ljust(16, b"\0") for x in labels.tolist()], pa.binary()), pa.array(np.arange(500)), pa.array(np.full(500, 9))],
                                       ["tree", "label", "id", "n"])
    pairs = lambda block: {(r["a"], r["b"]) for b in near_dedup._scan(2, 4, 8, block, 80)(batch.slice(k, 50) for k in range(0, 500, 50)) for r in b.to_pylist() if r["b"] is not None}
    whole, parts = pairs(10_000), pairs(100)
    assert {(k, k - 1) for k in range(1, 500) if labels[k][:8] == labels[k - 1][:8]} <= whole
    assert len(whole - parts) <= 0.02 * len(whole)          # regions that a block cuts look smaller, never emptier


# --- vectors -------------------------------------------------------------------
def nearest_by_brute_force(rows, asked, k):
    out = {}
    for i, q in asked:
        found = []
        for j, x in rows:
            if i != j and len(x) == len(q):
                s = 0.0
                for a, b in zip(q, x):
                    s += a * b
                found.append((-s, j))
        out[i] = [(j, -s) for s, j in sorted(found)[:k]]
    return out


def test_vector_search_is_exact_at_factor_one(spark):
    rng = np.random.default_rng(7)
    rows = [(i, [float(np.float32(v)) for v in rng.normal(size=8) * (1 + i % 5)]) for i in range(400)]
    rows += [(1000 + i, [1.0] * 8) for i in range(60)] + [(2000 + i, [0.5, 0.25]) for i in range(4)]
    bad = [(3000, None), (3001, []), (3002, [0.0] * 8), (3003, [1.0, None] + [0.0] * 6), (3004, [float("nan")] * 8), (3005, [float("inf")] * 8)]
    df = spark.createDataFrame(rows + bad, "vec_id long, embedding array<double>")
    got = {}
    for r in vp_search.nearest_neighbours(df, df.filter("vec_id % 20 = 0"), k=7, shard_rows=64, block_rows=16).orderBy("query_id", "rank").collect():
        got.setdefault(r.query_id, []).append((r.vec_id, r.score))
    expected = nearest_by_brute_force(rows, [(i, v) for i, v in rows if i % 20 == 0], 7)
    assert got == {i: v for i, v in expected.items() if v}
    assert vp_search.nearest_neighbours(df.limit(0)).count() == 0


@pytest.mark.parametrize("case", ["ties", "huge", "tiny", "mixed"])
def test_vector_search_with_ties_and_far_norms(case):
    rng = np.random.default_rng(3)
    x = rng.normal(size=(900, 12))
    if case == "ties":                                     # distinct vectors, most products equal
        x = np.unique(rng.integers(0, 2, (900, 12)), axis=0)[1:].astype(float)
    elif case == "huge":
        x[17] *= 1e8
    elif case == "tiny":
        x[::2] *= 1e-9
    else:
        x *= 10.0 ** rng.integers(-60, 60, 900)[:, None]
    ids = rng.permutation(len(x)) * 3
    rows = [(int(i), list(map(float, v))) for i, v in zip(ids, x)]
    got = {}
    for r in vp_search.search_shard(ids, x, ids[:60], x[:60], 7, 1.0).itertuples():
        got.setdefault(r.query_id, []).append((r.vec_id, r.score))
    assert got == nearest_by_brute_force(rows, rows[:60], 7)


def test_relaxed_pruning_keeps_recall(spark):
    table = read_table(spark, LARGER, "embeddings")
    asked = table.filter("vec_id % 20 = 0")
    ids = lambda f: {(r.query_id, r.vec_id) for r in vp_search.nearest_neighbours(table, asked, factor=f, shard_rows=128).collect()}
    exact, relaxed = ids(1.0), ids(1.5)
    rows = [(r.vec_id, list(map(float, r.embedding))) for r in table.collect()]
    brute = nearest_by_brute_force(rows, [r for r in rows if r[0] % 20 == 0], 20)
    assert exact == {(i, j) for i, found in brute.items() for j, _ in found}
    assert len(exact & relaxed) >= 0.9 * len(exact)


# --- classifiers ---------------------------------------------------------------
def held_out_accuracy(scored, labels, label):
    rows = scored.filter("held_out").join(labels.select(F.col("doc_id").alias("i"), label), F.col("doc_id") == F.col("i")).collect()
    return sum(r.predicted == r[label] for r in rows) / len(rows), len(rows)


def test_quality_on_held_out_labels(spark):
    docs, labels = read_table(spark, LARGER, "documents"), read_table(spark, LARGER, "labels")
    scored = quality.quality_scores(docs, labels).cache()
    assert scored.count() == docs.count() and scored.filter("score < 0 or score > 1 or score is null").count() == 0
    accuracy, n = held_out_accuracy(scored, labels, "quality")
    assert n > 100 and accuracy > 0.97


def test_quality_features_against_a_plain_version():
    # the same bytes in the same words give the same features, whatever stands around them
    a, b = quality.features("ab  cd\n".encode(), 1 << 16), quality.features("\tab cd".encode(), 1 << 16)
    assert sorted(a) == sorted(b) and len(a) == (2 + 2) + (1 + 1) + 2 + 1
    assert len(quality.features(b"", 16)) == len(quality.features(b" \n", 16)) == 0
    assert len(quality.features(b"x" * 300_000, 1 << 16)) == 300_000 + 299_999 + 1


def test_classifiers_without_labels_and_with_odd_rows(spark):
    docs = spark.createDataFrame([(1, None, 9), (2, "", 9), (None, "word " * 50_000, 9), (2, "x", 9)], "doc_id long, text string, score int")
    none = spark.createDataFrame([(1, None, None)], "doc_id long, quality int, toxic int")
    assert [r.score for r in quality.quality_scores(docs, none).collect()] == [0.5] * 4
    model = toxicity.fit(folds.labelled_sample(docs, none, "toxic", F.lit(True), 10))
    assert [(r.score, r.passages) for r in toxicity.score(docs, model).collect()] == [(0.5, [])] * 4
    assert toxicity.score(docs.limit(0), model).count() == quality.quality_scores(docs.limit(0), none).count() == 0


def test_labelled_sample_is_bounded_and_leaves_the_fold_out(spark):
    docs, labels = read_table(spark, LARGER, "documents"), read_table(spark, LARGER, "labels")
    import zlib
    rows = folds.labelled_sample(docs, labels, "toxic", ~folds.fold_is(5, 0), 50).collect()
    assert len(rows) == 50 and all(zlib.crc32(str(r.doc_id).encode()) % 5 for r in rows)


def segments_by_definition(scores):
    """Maximal segments by their recursive definition: the best one, then those left and right of it."""
    best, at = 0.0, None
    for i in range(len(scores)):
        for j in range(i + 1, len(scores) + 1):
            s = sum(scores[i:j])
            if s > best + 1e-9:
                best, at = s, (i, j)
    if at is None:
        return []
    i, j = at
    return segments_by_definition(scores[:i]) + [(i, j, best)] + [(a + j, b + j, s) for a, b, s in segments_by_definition(scores[j:])]


def test_maximal_segments_against_the_definition():
    rnd = random.Random(5)
    for _ in range(200):
        scores = [rnd.choice([-3, -2, -1, 1, 2, 4]) + rnd.random() / 64 for _ in range(rnd.randrange(0, 18))]
        got = toxicity.maximal_segments([(k, k + 1, s) for k, s in enumerate(scores)])
        assert [(a, b) for a, b, _ in got] == [(a, b) for a, b, _ in segments_by_definition(scores)]


def test_toxic_passages_and_held_out_labels(spark):
    docs, labels = read_table(spark, "/root/testdata/sf0.1", "documents"), read_table(spark, "/root/testdata/sf0.1", "labels")
    model = toxicity.fit(folds.labelled_sample(docs, labels, "toxic", ~folds.fold_is(5, 0), toxicity.MAX_TRAIN))
    wanted = docs.join(labels.select("doc_id"), "doc_id", "left_semi")
    scored = toxicity.score(wanted, model).select("*", folds.fold_is(5, 0).alias("held_out"), (F.col("score") >= 0.5).cast("int").alias("predicted")).cache()
    accuracy, n = held_out_accuracy(scored, labels, "toxic")
    assert n > 500 and accuracy > 0.97
    text = {r.doc_id: r.text for r in wanted.collect()}
    for r in scored.filter("size(passages) > 0").limit(50).collect():
        for p in r.passages:
            inside = text[r.doc_id][p.start:p.end]
            assert inside == inside.strip() and any(model.word(w) is not None for w in toxicity.WORD.findall(inside.lower()))


def test_toxic_phrases_of_fixed_wording_are_learned(spark):
    rnd = random.Random(21)
    words = ["".join(rnd.choice("abcdefghijklmnop") for _ in range(rnd.randrange(3, 9))) for _ in range(400)]
    rows = []
    for k in range(500):
        text = [rnd.choice(words) for _ in range(60)]
        if k % 5 == 0:
            text[:0] = ["you", "filthy", "vermin", "crawl"]       # always after the same words
        rows.append((k, int(k % 5 == 0), " ".join(text)))
    table = lambda part: spark.createDataFrame(part, "doc_id long, label int, text string")
    model = toxicity.fit(table(rows[:350]))
    got = {r.doc_id: r.score >= 0.5 for r in toxicity.score(table(rows[350:]), model).collect()}
    assert all(got[k] == (y == 1) for k, y, _ in rows[350:])


# --- SentencePiece -------------------------------------------------------------
ODD = ["", " ", "a", "  two  spaces ", "tab\tand\nline\r\n", "▁", "x▁y ▁ ▁▁z", "<s> </s> <unk> <0x0A>", "中文 テスト 😀 \x00\x01", "ſ ﬁ Å Å", "a" * 5000, " " * 700, "!" * 333 + "?" * 40, "the" * 3000]


@pytest.fixture(scope="module")
def pieces():
    return sentencepieces.Pieces(sentencepieces.load_model())


def test_encoding_equals_the_reference_tokenizer(spark, pieces):
    import sentencepiece
    whole = sentencepiece.SentencePieceProcessor(model_file=sentencepieces.MODEL)
    rnd = random.Random(9)
    texts = ODD + ["".join(rnd.choice("abet hin   ..,!!|%%\n\té中😀ſ12<s>") for _ in range(rnd.randrange(60))) for _ in range(1500)]
    texts += ["".join(rnd.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(20_000))]
    texts += [r.text for r in read_table(spark, LARGER, "documents").select("text").limit(300).collect()]
    for t in texts:
        ids = pieces.encode(t).tolist()
        assert pieces.decode(ids) == t
        if "▁" not in t:
            assert ids == whole.encode(t), t[:80]


def test_stream_commits_early_with_a_bounded_window(pieces):
    rnd = random.Random(1)
    read = 0

    def chars():
        nonlocal read
        for _ in range(20_000):
            read += 1
            yield rnd.choice("etaoinshrdlu")
    done, ahead = 0, 0
    for p in pieces.stream(chars()):
        done += len(p)
        ahead = max(ahead, read - done)
    assert done == 20_000 and ahead < 20 * pieces.longest


def test_unigram_lattice_against_whole_viterbi():
    rnd = random.Random(2)
    vocabulary = {"a": -3.0, "b": -3.2, "c": -4.0, "ab": -4.5, "bc": -4.2, "abc": -6.0, "ca": -5.0, "aab": -6.1, "▁": -2.0, "▁a": -3.5}
    model = {"kind": sentencepieces.UNIGRAM, "prefix": True, "pieces": [("<unk>", 0.0, 2)] + [(p, s, 1) for p, s in vocabulary.items()] + [(f"<0x{b:02X}>", 0.0, 6) for b in range(256)]}
    p = sentencepieces.Pieces(model)
    for _ in range(300):
        text = "".join(rnd.choice("abc d") for _ in range(rnd.randrange(1, 90)))
        marked = "▁" + text.replace(" ", "▁")
        best = [0.0] + [-1e18] * len(marked)
        for end in range(1, len(marked) + 1):
            for size in range(1, min(p.longest, end) + 1):
                piece = marked[end - size:end]
                if piece in vocabulary or size == 1:
                    best[end] = max(best[end], best[end - size] + vocabulary.get(piece, p.unknown))
        got = sum(vocabulary.get(x, p.unknown) for u in p.unit.findall(marked) for x in p.stream(u))
        assert got == pytest.approx(best[-1]) and p.decode(p.encode(text).tolist()) == text


def test_encode_and_decode_tables(spark):
    docs = spark.createDataFrame([(k, t, b"") for k, t in enumerate(ODD)] + [(100, None, b""), (100, None, b"")], "doc_id long, text string, ids binary")
    out = sentencepieces.encode(docs).cache()
    assert out.filter("not round_trip").count() == 0 and out.count() == len(ODD) + 2
    back = {r.doc_id: r.text for r in sentencepieces.decode(out).collect()}
    assert back == dict(enumerate(ODD)) | {100: ""}
    assert all(r.n_tokens == len(r.ids) for r in out.collect()) and sentencepieces.encode(docs.limit(0)).count() == 0


# --- pipeline ------------------------------------------------------------------
def test_pipeline_stages_against_brute_force(spark):
    docs = read_table(spark, LARGER, "documents")
    columns, labels = docs.columns, {r.doc_id: r.quality for r in read_table(spark, LARGER, "labels").collect()}
    kept = {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before = docs
        docs = stage(spark, before, LARGER).cache()
        assert docs.columns == columns
        kept[name] = (before.collect(), docs.collect())
    before, after = kept["quality_classifier"]
    ids = {r.doc_id for r in after}
    assert all(labels.get(r.doc_id) != 1 or r.doc_id in ids for r in before) and len(ids) < len(before)
    before, after = kept["exact_dedup"]
    groups = {}
    for r in before:
        groups.setdefault("".join(c for c in r.text if c not in " \t\n\x0b\x0c\r"), []).append((-len(r.text), r.doc_id))
    assert {r.doc_id for r in after} == {min(g)[1] for g in groups.values()}
    before, after = kept["near_dedup"]
    part = components_by_brute_force([(r.doc_id, r.text) for r in before], 5)
    assert {r.doc_id for r in after} == {c for _, c in part.values()}
    before, after = kept["mixing"]
    assert {tuple(r) for r in after} <= {tuple(r) for r in before}
    last = corpus_pipeline.run(spark, LARGER).collect()
    text = {r.doc_id: r.text for r in after}
    assert sorted(r.doc_id for r in last) == sorted(r.doc_id for r in after) and all(r.round_trip for r in last)
    p = sentencepieces.Pieces(sentencepieces.load_model())
    assert all(p.decode(r.ids) == text[r.doc_id] for r in last)


def test_pipeline_stages_on_odd_and_empty_tables(spark):
    rows = [(None, None, None, None, None), (1, None, None, "s", 0), (2, "", "en", None, 0), (2, "", "en", None, 0), (9, "twice", "en", "s", 5), (9, "twice", "en", "s", 5), (3, "one two three four five six", None, "s", 5),
            (4, "One two  three four five six", None, "s", 5), (5, "word " * 40_000, "en", "t", 9)]
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    for given in (spark.createDataFrame(rows, schema), spark.createDataFrame([], schema)):
        docs = given
        for name, stage in corpus_pipeline.STAGES:
            docs = stage(spark, docs, LARGER)
            if name != "sentencepiece":
                assert docs.columns == given.columns
        out = docs.collect()
        assert all(r.round_trip for r in out) and (out or given.isEmpty())


def test_near_duplicates_with_null_ids(spark):
    docs = spark.createDataFrame([(None, "a b c d e f"), (None, None), (7, "a b c d e f"), (8, "a b c d e f")], "doc_id long, text string")
    got = sorted(((r.doc_id, r.component_id, r.kept) for r in near_dedup.near_duplicates(docs).collect()), key=str)
    assert (7, 7, True) in got and (8, 7, False) in got and len(got) == 4
