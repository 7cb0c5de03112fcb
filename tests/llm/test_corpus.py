"""The corpus operators against brute force, and on awkward rows and empty tables."""

import itertools
import math
import re
import zlib
from collections import Counter

import duckdb
import numpy as np
import pyarrow as pa
import pytest
import xxhash
from pyspark.sql import functions as F

import corpus_pipeline
from tradewind.llm import ann, golay, language, line_dedup, mixing, mixing_lm, packing, quality, sharding, simhash, topk
from tradewind.llm.registry import ORACLE, QUERIES

SMALL = "/root/testdata/sf0.001"
M64 = (1 << 64) - 1


@pytest.fixture
def documents(spark):
    """Documents with every awkward row, and two more columns that clash with names of results."""

    def make(rows):
        ddl = "doc_id long, text string, lang string, source string, n_chars long, shard int, score double"
        full = [(i, t, lang, s, None if t is None else len(t), 7, 0.5) for i, t, lang, s in rows]
        return spark.createDataFrame(full, ddl)

    return make


@pytest.fixture
def awkward(documents):
    long = " ".join(f"word{i % 97}x{i}" for i in range(30_000))
    return documents(
        [
            (1, "one two three four", "en", "a"),
            (1, "one two three four", "en", "a"),
            (2, None, None, None),
            (3, "", "en", "a"),
            (None, "no id at all here", "fr", None),
            (4, long, "en", "b"),
            (5, "12 34 !!", "de", "b"),
            (6, "\n\n\t ", None, "a"),
        ]
    )


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{SMALL}/documents.parquet")


@pytest.fixture(scope="module")
def texts(docs):
    return {r.doc_id: r.text for r in docs.select("doc_id", "text").collect()}


def jump(key, shards):
    last, at = -1, 0
    while at < shards:
        last = at
        key = (key * 2862933555777941757 + 1) & M64
        at = int((last + 1) * ((1 << 31) / ((key >> 33) + 1)))
    return last


def test_shards_follow_the_jumps(spark, docs):
    keys = dict(docs.select("doc_id", F.xxhash64("doc_id")).collect())
    rows = QUERIES["op5_jump_sharding"](spark, SMALL).toPandas()
    assert len(rows) == docs.count()
    for r in rows.itertuples():
        assert (r.shard, r.grown_shard) == (jump(keys[r.doc_id] & M64, 24), jump(keys[r.doc_id] & M64, 25))
    assert set(rows[rows.grown_shard != rows.shard].grown_shard) <= {24}
    for _, slots in rows.groupby("shard").slot:
        assert sorted(slots) == list(range(len(slots)))


def test_shards_of_awkward_rows(awkward):
    rows = sharding.shard_by_key(awkward).toPandas()
    assert len(rows) == 8 and not rows.duplicated(["shard", "slot"]).any()
    assert set(rows[rows["size"] == 8].text_crc32) == {0}


def test_golay_keys_meet_within_two_bits():
    words = np.arange(1 << golay.CHECK)  # one word of every syndrome
    near = golay.near_indices(words)
    for weight in (1, 2):
        for bits in itertools.combinations(range(golay.BITS), weight):
            other = golay.near_indices(words ^ sum(1 << b for b in bits))
            assert ((near[:, :, None] == other[:, None, :]) & (near[:, :, None] >= 0)).any(axis=(1, 2)).all()


def plain_fingerprint(text, n=3):
    words = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "").encode().split()
    grams = [b" ".join(words[i : i + n]) for i in range(max(1, len(words) - n + 1))] if words else []
    hashes = [xxhash.xxh64_intdigest(g, 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def components_of(prints, bits):
    root = {d: d for d in prints}

    def find(d):
        while root[d] != d:
            d = root[d]
        return d

    for a, b in itertools.combinations(sorted(prints), 2):
        if (prints[a] ^ prints[b]).bit_count() <= bits:
            x, y = sorted((find(a), find(b)))
            root[y] = x
    return {d: find(d) for d in prints}


@pytest.mark.parametrize("bucket", [64, 1])
def test_near_duplicates_equal_all_pairs(docs, texts, bucket):
    prints = {d: plain_fingerprint(t) for d, t in texts.items()}
    rows = simhash.near_duplicates(docs, bucket=bucket).collect()
    assert {r.doc_id: r.fingerprint for r in rows} == {d: f"{p:016x}" for d, p in prints.items()}
    assert {r.doc_id: r.component_id for r in rows} == components_of(prints, 2)


def test_links_near_a_crowded_key(spark):
    base = 0x0123456789ABCDEF
    prints = [base, base ^ 1, base ^ 3, base ^ (1 << 63), base ^ (7 << 40), 0, 1 << 50]
    signed = [p - (1 << 64) if p >> 63 else p for p in prints]
    frame = spark.createDataFrame([(p,) for p in signed], "fp long")
    from tradewind.llm.common import Steps
    from tradewind.llm.components import components

    for bucket in (64, 1):
        steps = Steps(spark)
        found = {r.node: r.root for r in components(simhash.links(frame, steps, 2, bucket), steps).collect()}
        together = {found.get(s, s) for s in signed[:4]}
        assert len(together) == 1 and signed[4] not in found and found[0] == found[1 << 50]


@pytest.mark.parametrize("rows_a_task", [250_000, 50])
def test_components_of_a_chain_a_star_and_repeats(spark, monkeypatch, rows_a_task):
    from tradewind.llm import components
    from tradewind.llm.common import Steps

    monkeypatch.setattr(components, "ROWS_A_TASK", rows_a_task)
    pairs = [(i, i + 1) for i in range(60)] + [(500, i) for i in range(100, 200)] + [(7, 7), (900, 901), (901, 900), (900, 901)]
    rows = components.components(spark.createDataFrame(pairs, "a long, b long"), Steps(spark)).collect()
    want = {i: 0 for i in range(61)} | {i: 100 for i in [*range(100, 200), 500]} | {900: 900, 901: 900}
    assert len(rows) == len(want) and {r.node: r.root for r in rows} == want
    none = spark.createDataFrame([(7, 7)], "a long, b long")
    assert components.components(none, Steps(spark)).count() == 0


def test_near_duplicates_of_awkward_rows(awkward):
    rows = simhash.near_duplicates(awkward).collect()
    zero = {(r.doc_id, r.component_id) for r in rows if r.fingerprint == "0" * 16}
    assert len(rows) == 8 and zero == {(2, 2), (3, 2), (6, 2)}


def test_topk_equals_sql(spark):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW embeddings AS SELECT * FROM '{SMALL}/embeddings.parquet'")
    want = con.execute(ORACLE["op7_columnar_topk"]).fetchall()
    assert sorted(map(tuple, QUERIES["op7_columnar_topk"](spark, SMALL).collect())) == sorted(want)


def test_topk_of_awkward_vectors(spark):
    ok, nan, inf = [0.5, 0.25], [float("nan"), 1.0], [float("inf"), 0.0]
    rows = [(0, ok), (1, ok), (2, None), (3, [None, 1.0]), (4, nan), (5, inf), (6, [0.0, 0.0]), (7, ok), (7, ok)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    got = topk.top_k(frame, k=3).orderBy("rank").collect()
    assert [(r.query_id, r.vec_id, r.score) for r in got] == [(0, 1, 1280), (0, 7, 1280), (0, 7, 1280)]
    got = ann.neighbours(frame, k=5).orderBy("rank").collect()
    assert [r.vec_id for r in got] == [1, 7, 7] and got[0].score == pytest.approx(1.0)
    assert topk.top_k(frame.limit(0)).count() == ann.neighbours(frame.limit(0)).count() == 0


def test_neighbours_recall(spark):
    rows = spark.read.parquet(f"{SMALL}/embeddings.parquet").toPandas()
    x = np.array(rows.embedding.tolist(), dtype=float)
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    got = QUERIES["op9_collision_ann"](spark, SMALL).toPandas()
    hits, ids = 0, rows.vec_id.to_numpy()
    for q in np.nonzero(ids % 50 == 0)[0]:
        score = x @ x[q]
        score[q] = -9
        hits += len(set(got[got.query_id == ids[q]].vec_id) & set(ids[np.argsort(-score)[:5]]))
    assert hits / (5 * got.query_id.nunique()) >= 0.9


def test_packing_is_whole(spark, texts):
    rows = QUERIES["op10_vector_packing"](spark, SMALL).toPandas()
    encode = packing.word_ids(packing.tokenizer_path()).tokenizer.encode
    for r in rows.itertuples():
        ids = np.array(encode(texts[r.doc_id], add_special_tokens=False).ids + [2], dtype="<u4")
        assert (r.doc_tokens, r.ids_crc32) == (len(ids), zlib.crc32(ids[r.start : r.start + r.length].tobytes()))
    assert (rows.groupby("doc_id").length.sum() == rows.groupby("doc_id").doc_tokens.first()).all()
    rows = rows.sort_values(["sequence_id", "offset"])
    assert (rows.groupby("sequence_id").length.cumsum() - rows.length == rows.offset).all()
    assert rows.groupby("sequence_id").length.sum().max() <= 4096


def test_packing_limits():
    rng = np.random.default_rng(1)
    demand = np.column_stack([rng.integers(0, 50, 400), np.ones(400, dtype=int), rng.integers(0, 20, 400)])
    bins, places = packing.dot_product_bins(demand, (100, 6, 45))
    for b in range(bins.max() + 1):
        assert (demand[bins == b].sum(axis=0) <= (100, 6, 45)).all() and sorted(places[bins == b]) == list(range((bins == b).sum()))
    with pytest.raises(ValueError, match="limit"):
        packing.dot_product_bins(np.array([[101, 1, 0]]), (100, 6, 45))


def test_packing_of_awkward_rows(awkward):
    rows = packing.pack_documents(awkward, packing.tokenizer_path()).toPandas()
    assert rows[rows.doc_id.isin([2, 3, 6])].length.tolist() == [1, 1, 1]
    assert packing.pack_documents(awkward.limit(0), packing.tokenizer_path()).count() == 0


def test_word_ids_equal_the_tokenizer():
    held = packing.word_ids(packing.tokenizer_path())
    texts = ["DON'T they're.", "<|endoftext|>x <|ENDOFTEXT|>", "eİ$\t H̱a ΟΔΟΣ, a b", "é,É. naïve!! 1,2", "", " \n x", "x \x0b\x1c "]
    ids, begin = held.of(pa.array(texts))
    for i, text in enumerate(texts):
        assert ids[begin[i] : begin[i + 1]].tolist() == held.tokenizer.encode(text, add_special_tokens=False).ids
    sliced, _ = held.of(pa.array(["skipped", *texts]).slice(1))
    assert sliced.tolist() == ids.tolist()


def test_quality_on_held_out_documents(spark):
    rows = QUERIES["op1_nnpu_quality"](spark, "/root/testdata/sf0.01").toPandas()
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet").toPandas()
    held = rows[rows.held_out].merge(labels, on="doc_id")
    good, bad = held[held.quality == 1].score, held[held.quality == 0].score
    assert (good.to_numpy()[:, None] > bad.to_numpy()).mean() > 0.97


def test_quality_of_awkward_rows(spark, awkward):
    labels = spark.createDataFrame([(1, 1, 0), (4, 1, 0)], "doc_id long, quality int, toxic int")
    rows = quality.quality_scores(awkward, labels).collect()
    assert len(rows) == 8 and all(0 <= r.score <= 1 for r in rows)
    assert {r.score for r in quality.quality_scores(awkward, labels.limit(0)).collect()} == {0.5}


def test_forward_backward_equals_enumeration():
    rng = np.random.default_rng(2)
    potential, moves, start = rng.random((4, 3)), rng.random((3, 3)), rng.random(3)
    total = np.zeros((4, 3))
    for path in itertools.product(range(3), repeat=4):
        w = start[path[0]] * np.prod([potential[t, c] for t, c in enumerate(path)])
        w *= np.prod([moves[a, b] for a, b in zip(path, path[1:], strict=False)])
        for t, c in enumerate(path):
            total[t, c] += w
    got, _, _ = language.marginals([p[None] for p in potential], moves, start, np.ones(4, dtype=int))
    assert np.allclose(np.vstack(got), total / total.sum(axis=1, keepdims=True))


def test_language_on_held_out_and_mixed_text(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = language.languages(docs).join(docs.select("doc_id", "lang"), "doc_id").filter("held_out").toPandas()
    assert (rows.lang_pred == rows.lang).mean() > 0.97


def test_language_of_text_without_ascii_spaces():
    rng = np.random.default_rng(3)
    letters = {"a": "bcdefg", "b": "qrstuv"}
    windows = [(n, ["".join(rng.choice(list(x), 5)) for _ in range(10)]) for n, x in letters.items() for _ in range(40)]
    model = language.fit([(n, [f"^{w}$" for w in words]) for n, words in windows])
    a, b = ([w for n, words in windows for w in words if n == lang][:60] for lang in letters)
    texts = ["".join(a[:3] + b + a[3:6]), "\u00a0".join(a[:3] + b + a[3:6]), "\u3000".join(a + b[:4])]
    names, scores, words = language.label_documents([t.encode() for t in texts], language.Emissions(model))
    assert names == ["b", "b", "a"] and max(scores) < 0.99 and words[0] == math.ceil(330 / 24) and words[1:] == [66, 64]
    for n in (1, 23, 24, 25, 47, 48, 49, 50, 71, 72, 73):
        word = "".join(rng.choice(list(letters["a"]), n))
        edged = f"^{word}$"
        trigrams = [p[i : i + 3] for p in language.pieces(word) for i in range(len(p) - 2)]
        assert trigrams == [edged[i : i + 3] for i in range(n)]


def test_language_of_awkward_rows(awkward):
    rows = {(r.doc_id, r.lang_pred) for r in language.languages(awkward).collect()}
    assert {(2, "und"), (3, "und"), (5, "und"), (6, "und")} <= rows
    assert language.languages(awkward.limit(0)).count() == 0


def test_language_model_scores(spark, texts):
    rows = QUERIES["op4_context_mixing"](spark, SMALL).toPandas().set_index("doc_id")
    tokens = {d: (t or "").encode().lower().split() + [b""] for d, t in texts.items()}
    counts = Counter(w for d, ws in tokens.items() if zlib.crc32(str(d).encode()) % 5 != 1 for w in ws)
    n, v = sum(counts.values()), len(counts)
    for d, words in tokens.items():
        r = rows.loc[d]
        assert (r.n_tokens, r.n_known, r.train_tokens) == (len(words), sum(counts[w] > 0 for w in words), n)
        assert r.base_score == pytest.approx(sum(math.log10((counts[w] + 0.5) / (n + 0.5 * (v + 1))) for w in words))
    assert rows.score.max() < 0


def test_word_probabilities_sum_to_one():
    model = mixing_lm.Model(
        [np.zeros(2 << b, dtype=np.int32) for b in mixing_lm.SIZES],
        mixing_lm.Mixer().weights,
        mixing_lm.squash(np.tile(np.linspace(-mixing_lm.EDGE, mixing_lm.EDGE, mixing_lm.BINS), 8)),
    )
    mixing_lm.count_tables([b"ab", b"", b"abc"], np.array([5, 2, 3]), 1, model.tables)
    ready = model.prepared()
    # The first byte of a word: every byte but the space goes on, and the space ends the text.
    layout = mixing_lm.Layout.of([bytes([b]) for b in range(256) if b != 32])
    assert layout.first[1] == 2
    end = 10 ** ready.log10([b""])[0]
    assert 0 < end < 1 and ready.log10([b"ab"])[0] > ready.log10([b"zq"])[0]


def test_class_experts_sum_to_one_over_all_words(documents):
    taught = [("one two two three", "a"), ("one four four five", "b"), ("one one two six", "a")] * 20
    ids = (i for i in itertools.count() if zlib.crc32(str(i).encode()) % 5 != 1)
    rows = [(next(ids), t, lang, "s") for t, lang in taught]
    words = ["", *sorted({w for t, _ in taught for w in t.split()})]
    held = [i for i in range(1000) if zlib.crc32(str(i).encode()) % 5 == 1][: len(words)]
    rows += [(i, w, None, "s") for i, w in zip(held, words, strict=True)]

    def probability(classes):
        got = {r.doc_id: 10**r.score for r in mixing_lm.score_documents(documents(rows), most_classes=classes).collect()}
        return np.array([got[i] for i in held])

    alone = probability(1)
    lm = np.r_[alone[0], alone[1:] / alone[0]]
    by_class = np.zeros((len(words), 3))
    for t, lang in taught:
        for w in [*t.split(), ""]:
            by_class[words.index(w), "ab".index(lang)] += 1
    share = (by_class.sum(axis=0) + 1) / (by_class.sum(axis=0) + 1).sum()
    ratio = (by_class + 0.1 * share) / (by_class.sum(axis=1, keepdims=True) + 0.1) / share
    expert = lm[:, None] * ratio
    rest = 1 - lm.sum()
    whole = expert.sum(axis=0) + rest
    assert abs(whole - 1).max() > 0.01
    expert = expert / whole
    assert np.allclose(expert.sum(axis=0) + rest / whole, 1)
    texts = np.array([40, 20, 0]) + 0.5
    first = np.vstack([np.ones(3), expert[1:]])
    assert np.allclose(probability(3), (first * expert[0]) @ (texts / texts.sum()), rtol=1e-6)


def test_language_model_of_awkward_rows(awkward):
    rows = mixing_lm.score_documents(awkward).collect()
    assert len(rows) == 8 and sorted(r.n_tokens for r in rows)[:3] == [1, 1, 1]
    assert mixing_lm.score_documents(awkward.limit(0)).count() == 0


def test_large_counts_are_halved_together():
    counts = np.array([1 << 40, 3 << 40, 5, 7, 1 << 50, 1, 0, 1 << 33, 0, 0])
    small = mixing_lm.in_32_bits(counts).astype(float).reshape(-1, 2)
    assert small.dtype == float and small.max() < 2**31 and (small[1] == (5, 7)).all()
    assert small[0, 1] / small[0, 0] == pytest.approx(3) and ((small > 0) == (counts.reshape(-1, 2) > 0)).all()


@pytest.mark.parametrize("most", [20_000, 300])
def test_every_word_counts_in_its_prefixes(spark, monkeypatch, most):
    # More types than a table of fixed size held; the rare ones count like the others. Half begin alike.
    monkeypatch.setattr(mixing_lm, "GROUP", 100_000)
    monkeypatch.setattr(mixing_lm, "HEAD_WORDS", most)
    counts = {f"{'http://a' * (i % 2)}{i * 7919 % 100_003:x}".encode(): i % 3 for i in range(60_000)}
    counts |= {b"": 9, b"a\x01": 2, b"\xff" * 40: 1}
    words = spark.createDataFrame(list(counts.items()), "word binary, trained long")
    heads = mixing_lm.count_heads(words)
    sizes = Counter(r.head for r in words.select(heads.column().alias("head")).toLocalIterator())
    assert max(sizes.values()) <= most and sorted(map(bytes, sizes)) == heads.strings
    assert heads.of(list(counts)) == set(heads.strings) and any(x.startswith(b"http://a") for x in heads.strings)
    shared = spark.sparkContext.broadcast(heads)
    bits = {w: "".join(f"{b:08b}" for b in w + b" ") for w in counts}
    want = Counter()
    for w, path in bits.items():
        for d in range(len(path) + 1):
            want[path[:d]] += counts[w]
    seen = 0
    for part in mixing_lm.by_head(words, shared, 3).rdd.glom().toLocalIterator():
        rows = [{"word": bytes(r.word), "trained": r.trained, "head": bytes(r["head"])} for r in part]
        batches = pa.Table.from_pylist(rows).to_batches(max_chunksize=1000)
        for _, some, prefixes in mixing_lm.with_prefixes(iter(batches), heads):
            got = prefixes.rows(np.arange(len(some)))
            expected = [[want[bits[w][: 8 * i + k]] for k in range(9)] for w in some for i in range(len(w) + 1)]
            assert (got == np.array(expected)).all()
            seen += len(some)
    assert seen == len(counts)


def passage(tag, words):
    return " ".join(f"{tag}{i}" for i in range(words))


def test_later_runs_of_lines_go(documents):
    run = passage("a", 30) + "\n\n" + passage("b", 30)
    rows = [
        (1, f"first\n{run}\nend", "en", "s"),
        (2, f"{run}\nmore here", "en", "s"),
        (3, f"x\n{passage('a', 30)}\ny", "en", "s"),
        (4, "\n".join([passage("c", 20)] * 6), "en", "s"),
        (5, passage("d", 60), "en", "s"),
        (6, "first\nx\n" + passage("d", 60) + "  \ny", "en", "s"),
    ]
    kept = {r.doc_id: r.text for r in line_dedup.dedup_lines(documents(rows))[0].collect()}
    want = {d: t for d, t, _, _ in rows}
    want[2], want[4], want[6] = "more here", passage("c", 20), "first\nx\ny"
    assert kept == want


def test_repeats_whose_lines_first_occur_apart(documents):
    lines = [passage(tag, 30) for tag in "abc"]
    rows = [(i, f"only {i}\n{line}\nend {i}", "en", "s") for i, line in enumerate(lines)]
    rows += [(10, "\n".join(["x", *lines, "y"]), "en", "s"), (11, "\n".join(["z", *lines, "end"]), "en", "s")]
    kept = {r.doc_id: r.text for r in line_dedup.dedup_lines(documents(rows))[0].collect()}
    assert kept == {d: t for d, t, _, _ in rows} | {11: "z\nend"}


def test_no_later_run_of_lines_is_missed(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    runs = {r.id: [(x["first"], x["last"]) for x in r.runs] for r in line_dedup.repeated_runs(docs).collect()}
    seen, later = set(), 0
    for r in docs.orderBy("doc_id").collect():
        lines = [(p, x.rstrip(" "), len(x.encode().split())) for p, x in enumerate((r.text or "").split("\n"))]
        lines = [x for x in lines if x[2]]
        for i in range(len(lines)):
            ends = [j for j, n in enumerate(itertools.accumulate(x[2] for x in lines[i : i + 50]), i) if n >= 50]
            if not ends:
                break
            run = lines[i : ends[0] + 1]
            if (key := tuple(x[1] for x in run)) in seen:
                later += 1
                assert all(any(a <= p <= b for a, b in runs[r.doc_id]) for p, _, _ in run)
            seen.add(key)
    assert later > 100


def test_line_dedup_keeps_every_long_line_once(spark, texts):
    rows = QUERIES["op2_winnowing_lines"](spark, SMALL).collect()
    long = lambda ts: Counter(x.rstrip(" ") for t in ts for x in t.split("\n") if len(x.encode().split()) >= 50)
    before, after = long(texts.values()), long(r.text for r in rows)
    assert set(before) == set(after) and set(after.values()) == {1}
    assert len(rows) == len(texts)


def test_line_dedup_of_awkward_rows(awkward):
    rows = line_dedup.dedup_lines(awkward)[0]
    assert set(awkward.columns) < set(rows.columns) and rows.count() == 8
    assert rows.filter("doc_id = 2").first().text is None
    assert line_dedup.dedup_lines(awkward.limit(0))[0].count() == 0


def test_mixing_meets_its_weights(spark, docs):
    rows, names = mixing.mix(docs, mixing.Target(repeats=2.0))
    frame = rows.toPandas()
    assert set(frame.doc_id) == {r.doc_id for r in docs.select("doc_id").collect()} and frame["pass"].max() <= 1
    for _, part in frame.groupby("source"):
        part = part.sort_values(["offset", "pass"])
        assert (part.tokens.cumsum() - part.tokens == part.offset).all()


def test_mixing_draws_the_same_again(docs):
    drawn = lambda df: sorted((r.doc_id, r["pass"], r.offset) for r in mixing.mix(df)[0].collect())
    assert drawn(docs.repartition(5)) == drawn(docs.coalesce(1))


@pytest.mark.parametrize("target", [0.5, 0.9])
def test_exponent_reaches_the_entropy(spark, target):
    tokens = np.array([1000.0, 100.0, 10.0, 1.0])
    frame = spark.createDataFrame([(float(t),) for t in tokens], "t double")
    a = mixing.solve_exponent(frame, mixing.Target(None, target), None)
    w = (tokens / tokens.sum()) ** a
    w /= w.sum()
    assert -(w * np.log(w)).sum() / math.log(4) == pytest.approx(target, abs=1e-4)


def test_mixing_of_awkward_rows(awkward):
    rows, _ = mixing.mix(awkward)
    assert {r.doc_id for r in rows.collect()} == {1, 2, 3, None, 4, 5, 6}
    assert mixing.mix(awkward.limit(0))[0].count() == 0


def plain_mixing(rows, repeats):
    """Weight by source and, without a budget, passes over each, from token counts in plain Python."""
    tokens = Counter()
    for source, n in rows:
        tokens[source] += n
    total = sum(tokens.values())
    low, high = 0.0, 1.0
    most = max(tokens.values())
    passes = lambda a: max((t / total) ** (a - 1) for t in tokens.values()) / (most / total) ** (a - 1)
    if passes(0.0) <= repeats * (1 + 1e-12):
        high = 0.0
    for _ in range(60 if high else 0):
        middle = (low + high) / 2
        low, high = (low, middle) if passes(middle) <= repeats * (1 + 1e-12) else (middle, high)
    z = sum((t / total) ** high for t in tokens.values())
    weight = {s: (t / total) ** high / z for s, t in tokens.items()}
    return weight, tokens, most / weight[max(tokens, key=tokens.get)]


def words_of(text):
    return len(re.findall("[^ \t-\r]+", text or ""))


def test_mixing_weights_blocks_and_places(docs):
    rows, names = mixing.mix(docs, mixing.Target(repeats=2.0), block_tokens=20_000)
    frame = rows.toPandas()
    weight, tokens, whole = plain_mixing([(r.source, words_of(r.text)) for r in docs.collect()], 2.0)
    for source, part in frame.groupby("source"):
        assert np.allclose(part[names["weight"]], weight[source], rtol=1e-6)
        assert (part[names["tokens"]] == part.text.map(words_of)).all()
        full, rest = divmod(weight[source] * whole, tokens[source])
        times = part.groupby("doc_id").size()
        assert set(times) <= {int(full), int(full) + 1} or rest < 1
        drawn = part[names["tokens"]].sum()
        assert weight[source] * whole - 1e-6 * whole <= drawn <= weight[source] * whole + part[names["tokens"]].max()
        assert (part[names["block"]] == np.floor(part[names["offset"]] / max(weight[source] * 20_000, 1.0))).all()
        for _, one in part.groupby(names["pass"]):  # each pass is a permutation: no document twice
            assert one.doc_id.is_unique
    # Every block but the last holds all sources at their weights, within a document.
    for _, block in frame[frame[names["block"]] < frame[names["block"]].max()].groupby(names["block"]):
        for source, part in block.groupby("source"):
            largest = frame[frame.source == source][names["tokens"]].max()
            assert abs(part[names["tokens"]].sum() - weight[source] * 20_000) <= 2 * largest
    assert frame[names["place"]].nunique() > 0.99 * len(frame)


def test_many_equal_rows_are_mixed_in_several_parts(documents):
    rows = [(1, "the same text", "en", "s")] * 400 + [(i, f"text number {i}", "en", "s") for i in range(2, 802)]
    mixed, names = mixing.mix(documents(rows), per_task=50)
    frame = mixed.toPandas()
    assert len(frame) == 1200 and sorted(frame[names["offset"]]) == list(range(0, 3600, 3))
    alike = np.sort(frame[frame.doc_id == 1][names["offset"]].to_numpy() // 3)
    assert (np.diff(alike) > 1).sum() >= 4  # not one run of 400


def instructions(n):
    """Examples of a prompt and an answer: all tokens count, only the answer's bear loss."""
    pick = np.random.default_rng(7)
    prompt, answer = pick.integers(0, 40, n), pick.integers(1, 60, n)
    return [(int(i), int(p + a), int(a)) for i, (p, a) in enumerate(zip(prompt, answer, strict=True))]


def test_packing_under_a_loss_limit(spark):
    rows = instructions(600)
    items = spark.createDataFrame(rows, "id long, tokens long, loss long").withColumn("segment", F.lit(1))
    path = f"{mixing.Steps(spark).folder}/items"
    items.write.parquet(path)
    limits = {"tokens": 400, "segment": 12, "loss": 150}
    stored = spark.read.parquet(path)
    frame = packing.pack(stored, limits, "tokens").toPandas()
    assert sorted(frame.id) == [r[0] for r in rows]
    sums = frame.groupby("sequence_id")[["tokens", "loss", "segment"]].sum()
    assert (sums.tokens <= 400).all() and (sums.loss <= 150).all() and (sums.segment <= 12).all()
    # The loss limit binds: sequences are full of loss, not of tokens, and without it they are fewer.
    assert (sums.loss >= 140).mean() > 0.8 and sums.tokens.mean() < 350
    free = packing.pack(stored, limits | {"loss": 400}, "tokens").toPandas()
    assert free.sequence_id.nunique() < frame.sequence_id.nunique()
    for _, one in frame.groupby("sequence_id"):
        one = one.sort_values("offset")
        assert (one.tokens.cumsum() - one.tokens == one.offset).all()


def test_a_document_is_cut_at_the_smaller_limit(documents):
    docs = documents([(1, "word " * 500, "en", "s"), (2, None, None, None)])
    frame = packing.pack_documents(docs, packing.tokenizer_path(), longest=64, segments=4, loss_tokens=32).toPandas()
    assert frame.length.max() == 32 and frame.groupby("sequence_id").length.sum().max() <= 32


def test_vectors_without_components_and_clashing_columns(spark):
    ddl = "vec_id long, embedding array<float>, row string, id string, vec string, q_row int, score string, rank int"
    empty = spark.createDataFrame([(i, [], "r", "i", "v", 1, "s", 2) for i in range(41)], ddl)
    rows = topk.top_k(empty).collect()
    assert {(r.query_id, r.rank, r.vec_id, r.score) for r in rows} == {
        (q, i + 1, c, 0) for q in (0, 20, 40) for i, c in enumerate([c for c in range(41) if c != q][:20])
    }
    assert ann.neighbours(empty).count() == 0  # zero vectors have no cosine
    pick = np.random.default_rng(3)
    vectors = [(i, [float(x) for x in pick.normal(size=4)], "r", "i", "v", 1, "s", 2) for i in range(60)]
    got = {(r.query_id, r.rank): r.vec_id for r in topk.top_k(spark.createDataFrame(vectors, ddl)).collect()}
    scaled = np.floor(64 * np.array([np.float32(v[1]) for v in vectors], dtype=np.float64))
    for q in (0, 20, 40):
        order = sorted((c for c in range(60) if c != q), key=lambda c: (-(scaled[q] @ scaled[c]), c))
        assert [got[q, i + 1] for i in range(20)] == order[:20]


def plain_line_dedup(rows):
    """Texts without later runs of 50 words in lines that occur before, comparing every pair of places."""
    lines = []
    for doc_id, text in rows:
        for place, line in enumerate((text or "").split("\n")):
            if line.split():
                lines.append((doc_id, place, line.rstrip(" "), len(re.findall("[^ \t-\r]+", line))))
    places = {}
    gone = set()
    for i, (_, _, line, _) in enumerate(lines):
        for j in places.get(line, ()):
            if i and j and lines[i - 1][:3:2] == (lines[i][0], lines[j - 1][2]) and lines[j - 1][0] == lines[j][0]:
                continue  # inside a longer run
            n, words = 0, 0
            while i + n < len(lines) and j + n < i + n and lines[i + n][2] == lines[j + n][2]:
                if lines[i + n][0] != lines[i][0] or lines[j + n][0] != lines[j][0]:
                    break
                words, n = words + lines[i + n][3], n + 1
            if words >= 50:
                first, last = lines[i][1], lines[i + n - 1][1]
                gone |= {(lines[i][0], p) for p in range(first, last + 1)}
        places.setdefault(line, []).append(i)
    out = {}
    for doc_id, text in rows:
        kept = [x for p, x in enumerate((text or "").split("\n")) if (doc_id, p) not in gone]
        out[doc_id] = None if text is None else "\n".join(kept)
    return out


def test_pipeline_stages(spark, docs, tmp_path):
    """Each stage on what the stage before it kept, next to plain Python; then all of them by ``run``."""
    now, columns, model = docs, docs.columns, quality.train(docs, spark.read.parquet(f"{SMALL}/labels.parquet"))
    for i, (name, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, now, SMALL).write.parquet(f"{tmp_path}/{i}")
        later = spark.read.parquet(f"{tmp_path}/{i}")
        before, after = now.collect(), later.collect()
        texts = {r.doc_id: r.text for r in before}
        if name == "quality classifier":
            score = {r.doc_id: float(model(quality.features(r.text.encode())[None])[0]) for r in before}
            assert {r.doc_id: r.text for r in after} == {d: t for d, t in texts.items() if score[d] >= 0.7}
            assert 0 < len(after) < len(before)
        if name == "line dedup":
            assert {r.doc_id: r.text for r in after} == plain_line_dedup(sorted(texts.items()))
            assert all(r.n_chars == len(r.text) for r in after) and len(after) == len(before)
        if name == "SimHash near-dedup":
            groups = components_of({r.doc_id: plain_fingerprint(r.text) for r in before}, 2)
            assert sorted(r.doc_id for r in after) == sorted(set(groups.values()))
            assert all(texts[r.doc_id] == r.text for r in after)
        if name == "mixing sources":
            weight, tokens, whole = plain_mixing([(r.source, words_of(r.text)) for r in before], 2.0)
            drawn = Counter(r.doc_id for r in after)
            assert set(drawn) == set(texts) and all(texts[r.doc_id] == r.text for r in after)
            for source, t in tokens.items():
                full, rest = divmod(weight[source] * whole, t)
                times = {drawn[r.doc_id] for r in before if r.source == source and words_of(r.text)}
                assert times <= {int(full), int(full) + 1} or rest < 1 or t - rest < 1
        if name == "packing":
            held = {}
            words = packing.word_ids(packing.tokenizer_path())
            for r in after:
                held.setdefault(r.doc_id, []).append((r.start, r.length, r.ids_crc32, r.doc_tokens))
            for d, pieces in held.items():
                ids = np.array([*words.tokenizer.encode(texts[d], add_special_tokens=False).ids, 2], dtype="<u4")
                wanted = [(s, min(4096, len(ids) - s), zlib.crc32(ids[s : s + 4096]), len(ids)) for s in range(0, len(ids), 4096)]
                copies = sum(r.doc_id == d for r in before)
                assert sorted(pieces) == sorted(wanted * copies)
        if name != "packing":
            assert later.columns == columns
        now = later
    piece = lambda r: (r.doc_id, r.start, r.length, r.ids_crc32, r.doc_tokens)
    assert sorted(map(piece, corpus_pipeline.run(spark, SMALL).collect())) == sorted(map(piece, now.collect()))


def test_pipeline_without_labels_rejects_nothing(spark, docs, tmp_path):
    spark.read.parquet(f"{SMALL}/labels.parquet").limit(0).write.parquet(f"{tmp_path}/labels.parquet")
    kept = corpus_pipeline.good_quality(spark, docs, str(tmp_path))
    assert kept.columns == docs.columns and kept.count() == docs.count()


def test_awkward_rows_go_through_all_stages(spark, awkward, tmp_path):
    spark.read.parquet(f"{SMALL}/labels.parquet").limit(0).write.parquet(f"{tmp_path}/labels.parquet")
    for rows, least in ((awkward, 6), (awkward.limit(0), 0)):
        now = rows
        for i, (name, stage) in enumerate(corpus_pipeline.STAGES):
            stage(spark, now, str(tmp_path)).write.mode("overwrite").parquet(f"{tmp_path}/{least}-{i}")
            now = spark.read.parquet(f"{tmp_path}/{least}-{i}")
            assert name == "packing" or now.columns == awkward.columns
        assert now.select("doc_id").distinct().count() >= min(least, 1) and now.count() >= least - 1


def test_a_sample_is_bounded_by_rows_not_ids(spark, docs):
    """One id that fills a third of the rows with different texts adds no more than its share."""
    labels = spark.read.parquet(f"{SMALL}/labels.parquet")
    many = docs.select("doc_id", "text").unionByName(
        spark.range(400).select(F.lit(3).cast("long").alias("doc_id"), F.concat(F.lit("text "), F.col("id")).alias("text"))
    )
    sizes = []
    kept, quality_fit = quality.fit_nnpu, lambda p, u: sizes.append((len(p), len(u)))
    quality.fit_nnpu = quality_fit
    try:
        quality.train(many, labels, positives=20, unlabelled=50)
    finally:
        quality.fit_nnpu = kept
    assert sizes[0][0] <= 40 and sizes[0][1] <= 90
