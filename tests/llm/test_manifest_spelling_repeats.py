"""Merkle manifest, spelling groups and byte-string dedup against plain Python, and on awkward rows."""

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from tradewind.llm import merkle, spelling, suffix_dedup
from tradewind.llm.common import Steps, ordered
from tradewind.llm.registry import ORACLE, QUERIES

SMALL = "/root/testdata/sf0.001"


@pytest.fixture
def documents(spark):
    """Documents with two more columns that clash with names the operators use."""

    def make(rows):
        ddl = "doc_id long, text string, lang string, source string, n_chars long, row int, word string, level int, data string"
        full = [(i, t, lang, s, None if t is None else len(t), 7, "w", 0, "d") for i, t, lang, s in rows]
        return spark.createDataFrame(full, ddl)

    return make


@pytest.fixture
def awkward(documents):
    long = " ".join(f"word{i % 97}x{i}" for i in range(30_000))
    rows = [
        (1, "One two three four", "en", "a"),
        (1, "One two three four", "en", "a"),
        (1, "another text of the same id", "en", "a"),
        (2, None, None, None),
        (3, "", "en", "a"),
        (None, "no id at all here", "fr", None),
        (None, "no id at all here", "fr", None),
        (4, long, "en", "b"),
        (5, "é" * 500, "", "b"),
        (6, "ab" * 400, None, "a"),
        (7, "\n\n\t ", "Zü", "a"),
    ]
    return documents(rows + [(i, f"filler {i % 5}", "en", "f") for i in range(10, 95)])


def as_dicts(df):
    return [r.asDict() for r in df.collect()]


@pytest.mark.parametrize("name", ["op11_spelling_groups", "op12_bwt_dedup", "op13_merkle_manifest"])
def test_query_equals_its_sql(spark, name):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{SMALL}/documents.parquet'")
    result = con.execute(ORACLE[name])
    columns = [c[0] for c in result.description]
    got = QUERIES[name](spark, SMALL).select(*columns).collect()
    assert sorted(map(tuple, got), key=str) == sorted(result.fetchall(), key=str)


# ---------------------------------------------------------------- Merkle manifest


def sha(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def lowered(text):
    return None if text is None else "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)


def leaf_of(d, text):
    values = (d["doc_id"], d["source"], d["lang"], d["n_chars"], text)
    return sha(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in values])


def climb(nodes):
    """The root over some digests, and the (before, after) siblings of each, level by level."""
    paths, groups = [[] for _ in nodes], [[i] for i in range(len(nodes))]
    while len(nodes) > 1:
        up, up_groups = [], []
        for start in range(0, len(nodes), 8):
            run, members = nodes[start : start + 8], []
            for k in range(len(run)):
                for m in groups[start + k]:
                    paths[m].append(("".join(run[:k]), "".join(run[k + 1 :])))
                    members.append(m)
            up.append(sha(*run))
            up_groups.append(members)
        nodes, groups = up, up_groups
    return nodes[0], paths


def manifest_of(docs):
    trees = []
    for lang in sorted({d["lang"] for d in docs}, key=lambda v: (v is not None, (v or "").encode())):
        leaves = [
            (d["doc_id"] is not None, d["doc_id"] or 0, leaf_of(d, d["text"]), leaf_of(d, lowered(d["text"])))
            for d in docs
            if d["lang"] == lang
        ]
        leaves.sort()
        trees.append((leaves, *climb([x[2] for x in leaves])))
    root, tops = climb([subroot for _, subroot, _ in trees])
    out = []
    for (leaves, subroot, paths), top in zip(trees, tops, strict=True):
        for (known, number, leaf, changed), path in zip(leaves, paths, strict=True):
            doc_id = number if known else None
            folded = changed if zlib.crc32(str("" if doc_id is None else doc_id).encode()) % 3 == 0 else leaf
            for before, after in path + top:
                folded = sha(before, folded, after)
            proof = sha(*[before + after for before, after in path + top])
            out.append((doc_id, leaf, subroot, root, proof, folded, folded == root))
    return sorted(out, key=str)


def test_manifest_of_documents(spark):
    got = sorted((tuple(r) for r in QUERIES["op13_merkle_manifest"](spark, SMALL).collect()), key=str)
    assert got == manifest_of(as_dicts(spark.read.parquet(f"{SMALL}/documents.parquet")))
    assert 0 < sum(r[-1] for r in got) < len(got)


def test_manifest_of_awkward_rows(awkward):
    got = sorted((tuple(r) for r in merkle.merkle_manifest(awkward).collect()), key=str)
    assert got == manifest_of(as_dicts(awkward))


@pytest.mark.parametrize("n", [0, 1, 2, 9, 65])
def test_manifest_of_few_rows(documents, n):
    # One language, then as many languages as rows: a tree at the top of up to three levels.
    for lang in (lambda i: "en", lambda i: f"l{i}"):
        docs = documents([(i, f"Text {i}", lang(i), "s") for i in range(n)])
        got = sorted((tuple(r) for r in merkle.merkle_manifest(docs).collect()), key=str)
        assert got == (manifest_of(as_dicts(docs)) if n else [])


def test_any_change_of_a_row_is_found(documents):
    rows = [(i, f"Text {i}", "en", "s") for i in range(20)]
    roots = {r.root for r in merkle.merkle_manifest(documents(rows)).collect()}
    for changed in ((3, "Text 3.", "en", "s"), (3, "Text 3", "de", "s"), (30, "Text 3", "en", "s"), (3, "Text 3", "en", None)):
        other = {r.root for r in merkle.merkle_manifest(documents(rows[:3] + [changed] + rows[4:])).collect()}
        assert len(roots) == len(other) == 1 and roots != other


def test_order_numbers_are_gapless_and_split(spark):
    steps = Steps(spark)
    df = spark.range(5000).select((F.col("id") % 3).alias("k"), (-F.col("id")).alias("v"))
    got = ordered(df.repartition(7), [F.col("k"), F.col("v")], "at", steps, "o").collect()
    assert [r.at for r in sorted(got, key=lambda r: (r.k, r.v))] == list(range(5000))


# ---------------------------------------------------------------- spelling groups


def spelling_of(docs):
    counts = Counter()
    for doc_id, text in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = lowered(run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % 199 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            counts[run] += 1
    words = {w: n for w, n in counts.items() if len(w) >= 6 and n >= 5}
    near, patterns = defaultdict(set), defaultdict(set)
    for w in words:
        for i in range(len(w)):
            shorter = w[:i] + w[i + 1 :]
            if shorter in words:
                near[w].add(shorter)
                near[shorter].add(w)
            patterns[i, shorter, len(w)].add(w)
    for same in patterns.values():
        for w in same:
            near[w] |= same - {w}
    form = {}
    for w, n in words.items():
        best = min(near[w], key=lambda x: (-words[x], x), default=None)
        if best is not None and words[best] >= 5 * n:
            form[w] = best
    out = []
    for w, n in words.items():
        root = w
        while root in form:
            root = form[root]
        out.append((w, form.get(w), root, n, len(near[w]), words[form[w]] if w in form else None))
    return sorted(out, key=str)


def test_spelling_groups_of_documents(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text").collect()
    got = sorted((tuple(r) for r in QUERIES["op11_spelling_groups"](spark, SMALL).collect()), key=str)
    assert got == spelling_of(docs) and any(r[1] for r in got)


@pytest.fixture
def variants(documents):
    """Chains of forms, ties, letters above ASCII, words in capitals, a word of 5000 letters, and many near ones."""
    pick = random.Random(5)
    words = Counter({"colour": 700, "color": 900, "colours": 130, "colourz": 20, "xolourz": 5, "élèvesé": 40, "eleves": 60})
    words |= {"élèves": 8, "abcdefg": 50, "abcdefh": 50, "abcdefi": 10, "q" * 5000: 30, "q" * 5001: 5, "q" * 4999 + "r": 6}
    for _ in range(300):
        w = list("interrelation")
        for _ in range(pick.randint(0, 2)):
            w[pick.randrange(len(w))] = pick.choice("abc")
        words["".join(w[: pick.randint(11, 13)])] += pick.randint(1, 12)
    bag = [w if pick.random() < 0.8 else w.upper() if w.isascii() else w for w, n in words.items() for _ in range(n)]
    pick.shuffle(bag)
    rows = [(i, " ".join(bag[i * 50 : i * 50 + 50]) + " ok.", "en", "s") for i in range(-(-len(bag) // 50))]
    return documents([*rows, (None, "colour colour", None, None), (None, "colour colour", None, None), (3, None, "en", "s"), (4, "", "en", "s")])


@pytest.mark.parametrize("rows_a_group", [20_000, 3])
def test_spelling_groups_of_variants(variants, monkeypatch, rows_a_group):
    """Also with groups of more than three words dealt again by longer keys, which must lose no pair."""
    monkeypatch.setattr(spelling, "GROUP_ROWS", rows_a_group)
    got = sorted((tuple(r) for r in spelling.spelling_groups(variants).collect()), key=str)
    assert got == spelling_of([(d["doc_id"], d["text"]) for d in as_dicts(variants)])
    chains = {r[0]: r for r in got}
    assert chains["xolourz"][1:3] == ("colourz" if chains["colourz"][3] >= 25 else None, chains["xolourz"][2])


def test_spelling_groups_of_nothing(documents):
    assert spelling.spelling_groups(documents([])).collect() == []
    assert spelling.spelling_groups(documents([(1, None, None, None), (2, "few words", "en", "s")])).collect() == []


def test_near_pairs_share_rows_of_the_sorted_list():
    pick = random.Random(1)
    for short in (6, 7, 12):
        words = sorted({"".join(pick.choice("ab") for _ in range(pick.choice((short, short + 1)))) for _ in range(150)})
        shared = 2
        groups = np.array([int(w[:shared].replace("a", "0").replace("b", "1"), 2) for w in words])
        a, b = spelling.near_pairs([w.encode() for w in words], groups, short, shared)
        got = {(words[i], words[j]) for i, j in zip(a, b, strict=True)}
        assert len(got) == len(a)

        def near(x, y):
            if len(x) == len(y):
                return sum(p != q for p, q in zip(x, y, strict=True)) == 1
            return any(y[:i] + y[i + 1 :] == x for i in range(len(y)))

        assert got == {
            (x, y) for x in words for y in words if len(x) == short and x[:shared] == y[:shared] and x != y and near(x, y)
        }


# ---------------------------------------------------------------- repeated byte strings


def without_repeats(docs, length=400):
    seen = Counter()
    for _, text in docs:
        data = (text or "").encode()
        seen.update(data[p : p + length] for p in range(len(data) - length + 1))
    out = []
    for doc_id, text in docs:
        data = (text or "").encode()
        gone = bytearray(len(data))
        for p in range(len(data) - length + 1):
            if seen[data[p : p + length]] > 1:
                gone[p : p + length] = b"\1" * length
        kept = bytes(b for b, g in zip(data, gone, strict=True) if not g)
        spans = len(re.findall(b"\1+", bytes(gone)))
        out.append((doc_id, len(data), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def digests(found):
    return found.select(
        F.col("id").alias("doc_id"),
        F.octet_length("data").cast("long"),
        (F.octet_length("data") - F.octet_length("kept")).cast("long"),
        F.size("spans").cast("long"),
        F.sha2("kept", 256),
    )


def test_repeats_of_documents(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text").collect()
    got = sorted((tuple(r) for r in QUERIES["op12_bwt_dedup"](spark, SMALL).collect()), key=str)
    assert got == without_repeats(docs) and sum(r[2] for r in got) > 10_000


@pytest.fixture
def passages(documents):
    """Passages at every alignment, of 399 to 401 bytes, cut at their ends, changed in the middle, periodic, and copies."""
    pick = random.Random(3)

    def noise(n):
        return "".join(pick.choice("abcdefgh ijklé") for _ in range(n))

    shared, exact, short = noise(900), noise(400), noise(399)
    rows = []
    for i in range(60):
        cut = shared[pick.randint(0, 60) : len(shared) - pick.randint(0, 60)]
        if i % 3 == 0:
            at = pick.randrange(len(cut))
            cut = cut[:at] + "#" + cut[at:]
        rows.append((i, noise(pick.randint(0, 40)) + cut + noise(pick.randint(0, 300)), "en", "s"))
    rows += [(100 + i, noise(17 + i) + exact.strip() + noise(i), "en", "s") for i in range(4)]
    rows += [(110 + i, noise(30) + "<" + short + ">" + noise(30), "en", "s") for i in range(2)]
    rows += [(120, "ab" * 700, "en", "s"), (121, "z" * 399, "en", "s"), (122, "z" * 399, "en", "s"), (123, "y" * 400, "en", "s")]
    rows += [(124, "x" * 401, "en", "s"), (125, (shared + noise(3)) * 2, "en", "s")]
    rows += [(130, rows[5][1], None, None)] * 30 + [(None, None, None, None), (131, "", "en", "s")]
    return documents(rows)


@pytest.mark.parametrize("group, bucket", [(4_000, 4 << 20), (5, 3_000)])
def test_repeats_of_passages(passages, monkeypatch, group, bucket):
    """Also with small buckets, small shards and chunks, and every common gram dealt over several buckets."""
    monkeypatch.setattr(suffix_dedup, "GROUP", group)
    monkeypatch.setattr(suffix_dedup, "BUCKET_BYTES", bucket)
    if group == 5:
        monkeypatch.setattr(suffix_dedup, "SHARD", 300)
        monkeypatch.setattr(suffix_dedup, "CHUNK", 500)
        monkeypatch.setattr(suffix_dedup, "SLICE", 2_000)
    got = sorted((tuple(r) for r in digests(suffix_dedup.remove_repeats(passages)).collect()), key=str)
    assert got == without_repeats([(d["doc_id"], d["text"]) for d in as_dicts(passages)])


@pytest.mark.parametrize("length", [32, *range(64, 73), 270, 399, 400])
def test_repeats_of_any_length(length):
    """Bytes beside the whole letters of a string, up to 14 of them, count at both ends."""
    pick = random.Random(length)
    shared = bytes(pick.choices(b"abcd ", k=2 * length))
    texts = [bytes(pick.choices(b"abcd ", k=pick.randint(0, 30))) + shared[i : i + length + pick.randint(-2, 9)] for i in range(60)]
    texts += [t[:-1] + bytes([t[-1] ^ 1]) for t in texts] + [b"ab" * length]
    texts = [t for t in texts if len(t) >= length]
    found = suffix_dedup.anchors(list(enumerate(texts)), length)
    row, place, strings = (found[c] for c in ("row", "place", "strings"))
    pieces = [texts[r][p : p + n + length - 1] for r, p, n in zip(row, place, strings, strict=True)]
    got = suffix_dedup.repeated_strings(pieces, found["ahead"], strings, np.ones(len(pieces), np.int64), length)
    each = [p[i : i + length] for p, n in zip(pieces, strings, strict=True) for i in range(n)]
    seen = Counter(each)
    assert list(got) == [seen[s] > 1 for s in each]
    assert 0 < sum(got) < len(got) == sum(len(t) - length + 1 for t in texts)


def test_repeats_shorter_than_the_query_looks_for(documents):
    """A passage of 51 words and 305 bytes is no repeat of 400 bytes; asked for its own length, it is."""
    pick = random.Random(9)

    def words(n):
        return " ".join("".join(pick.choices("abcdefghijkl", k=5)) for _ in range(n))

    passage = words(51)
    docs = [(i, f"{words(80)} {passage} {words(40 + i)}") for i in range(4)] + [(9, words(200))]
    rows = documents([(i, t, "en", "s") for i, t in docs])
    for length, caught in ((400, 0), (len(passage), 4)):
        got = sorted((tuple(r) for r in digests(suffix_dedup.remove_repeats(rows, length)).collect()), key=str)
        assert got == without_repeats(docs, length) and sum(r[2] > 0 for r in got) == caught
    with pytest.raises(ValueError, match="at least 32"):
        suffix_dedup.remove_repeats(rows, 31)


def test_repeats_of_awkward_rows(awkward, documents):
    found = suffix_dedup.remove_repeats(awkward)
    got = sorted((tuple(r) for r in digests(found).collect()), key=str)
    assert got == without_repeats([(d["doc_id"], d["text"]) for d in as_dicts(awkward)])
    for row in found.collect():
        rest, at = b"", 0
        for span in row.spans:
            rest, at = rest + row.data[at : span.start], span.stop
        assert rest + row.data[at:] == row.kept
    assert suffix_dedup.remove_repeats(documents([])).collect() == []


def test_merged_transforms_are_those_of_all_pieces():
    """Merging shards by their interleave gives the order of all suffixes, and blocks of common prefixes."""
    pick = np.random.default_rng(4)
    pieces = [list(pick.integers(1, 4, pick.integers(1, 30))) for _ in range(40)]
    texts, shards, base, places = [], [], 0, []
    for part in (pieces[:15], pieces[15:16], pieces[16:]):
        codes = np.concatenate([np.array([*p, 0]) for p in part])
        ends = np.cumsum([len(p) + 1 for p in part]) - 1
        end = np.repeat(ends, [len(p) + 1 for p in part])
        order, before, longer = suffix_dedup.transform(codes, end, len(part))
        shards.append((order, before, longer, len(part)))
        places += [(base + i, order[i]) for i in range(len(order))]
        texts += [tuple(codes[p : e + 1]) for p, e in zip(order, end[order], strict=True)]
        base += len(order)
    for rounds in (1, 3, 60):
        rows, block = suffix_dedup.interleave(shards, rounds)
        merged = [texts[r][:rounds] for r in rows]
        assert merged == sorted(merged)
        for (one, b), (two, c) in zip(zip(merged, block, strict=True), list(zip(merged, block, strict=True))[1:], strict=False):
            whole = 0 not in one and 0 not in two and len(one) == len(two) == rounds
            if whole:
                assert (one == two) == (b == c)
