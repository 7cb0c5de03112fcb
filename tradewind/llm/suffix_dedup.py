"""Removal of long byte strings that occur twice, by merging Burrows-Wheeler transforms of shards."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tradewind.llm.common import Steps, some_rows, table

GRAM = 32  # bytes of an anchor
SYMBOL = 8  # bytes that the transforms take as one letter
SHARD = 1 << 16  # letters whose suffixes are sorted at a time
SLICE = 1 << 18  # bytes that a task hashes at a time; positions there need 22 bits at most
CHUNK = 1 << 20  # strings of one text that are handled at a time
BUCKET_BYTES = 2 << 20
GROUP = 4_000  # pieces that may meet by one key; those of a key with more are split
WIDTHS = (64, 8, 1)  # distances to the anchor that pieces of a key are split by, one after another
LOW = np.uint64((1 << 22) - 1)


def _windows_least(keys: np.ndarray, width: int) -> np.ndarray:
    """Least key of every ``width`` consecutive ones, by doubling."""
    least, size = keys, 1
    while size * 2 <= width:
        least, size = np.minimum(least[:-size], least[size:]), size * 2
    rest = width - size
    return np.minimum(least[: len(least) - rest], least[rest:]) if rest else least


def _gram_hashes(data: np.ndarray) -> np.ndarray:
    multiplier = np.uint64(0x9E3779B97F4A7C15)
    h, size = (data.astype(np.uint64) + np.uint64(1)) * multiplier, 1
    h ^= h >> np.uint64(29)
    while size < GRAM:
        h = h[:-size] * np.uint64((0xD6E8FEB86659FD93 * (2 * size + 1)) & ((1 << 64) - 1)) + h[size:]
        h ^= h >> np.uint64(32)
        size *= 2
    return h * multiplier


def anchors(texts: list[tuple[int, bytes]], length: int) -> dict[str, np.ndarray]:
    """Every string of ``length`` bytes of some (row, text) pairs, in runs with one anchor.

    The anchor of a string is the place of its gram with the least hash (of equal ones the
    last), so equal strings have equal anchors at equal distances. Strings at consecutive
    places that share their anchor are one piece: place, number of strings, distance to the
    anchor, hash of the anchor's gram, and 128 bits of checksum over the bytes of all of them.
    """
    width = length - GRAM + 1
    owner = [r for r, _ in texts]
    ends = np.cumsum([len(t) for _, t in texts])
    starts = np.r_[0, ends[:-1]]
    blob = b"".join(t for _, t in texts)
    h = _gram_hashes(np.frombuffer(blob, np.uint8))
    keys = (h & ~LOW) | (LOW - np.arange(len(h), dtype=np.uint64))
    at = (LOW - (_windows_least(keys, width) & LOW)).astype(np.int64)
    valid = np.zeros(len(at) + 1, np.int8)
    np.add.at(valid, starts, 1)
    np.add.at(valid, ends - length + 1, -1)
    valid = np.cumsum(valid[:-1]).astype(bool)
    change = at[1:] != at[:-1]
    low = np.flatnonzero(valid & np.r_[True, change | ~valid[:-1]])
    high = np.flatnonzero(valid & np.r_[change | ~valid[1:], True])
    view = memoryview(blob)
    sums = b"".join(
        [xxhash.xxh3_128_digest(view[a:b]) for a, b in zip(low.tolist(), (high + length).tolist(), strict=True)]
    )
    check = np.frombuffer(sums, np.int64).reshape(-1, 2)
    text = np.searchsorted(ends, low, side="right")
    return {
        "row": np.array(owner, np.int64)[text], "place": low - starts[text], "strings": high - low + 1,
        "ahead": at[low] - low, "gram": h[at[low]].view(np.int64), "one": check[:, 0], "two": check[:, 1],
    }


def _all_anchors(batches: Iterator[pa.RecordBatch], length: int) -> Iterator[pa.RecordBatch]:
    held: list[tuple[int, bytes]] = []
    bases: list[int] = []
    size = 0

    def made() -> pa.RecordBatch:
        columns = anchors([(i, t) for i, (_, t) in enumerate(held)], length)
        at = columns["row"]
        columns["row"] = np.array([r for r, _ in held], np.int64)[at]
        columns["place"] = columns["place"] + np.array(bases, np.int64)[at]
        return pa.RecordBatch.from_arrays([pa.array(v.astype(np.int64)) for v in columns.values()], names=list(columns))

    for batch in some_rows(batches, "data", SLICE):
        for row, text in zip(batch.column("row").to_pylist(), batch.column("data").to_pylist(), strict=True):
            for base in range(0, len(text) - length + 1, CHUNK):
                held.append((row, text[base : base + CHUNK + length - 1]))
                bases.append(base)
                size += len(held[-1][1])
                if size >= SLICE:
                    yield made()
                    held.clear(), bases.clear()
                    size = 0
    if held:
        yield made()


def _stable(codes: np.ndarray) -> np.ndarray:
    """Stable order of non-negative numbers below 2**32, by 16 bits at a time."""
    order = np.argsort((codes & 0xFFFF).astype(np.uint16), kind="stable")
    if codes.max(initial=0) < 1 << 16:
        return order
    return order[np.argsort((codes[order] >> 16).astype(np.uint16), kind="stable")]


def suffix_order(codes: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Sorted places of all suffixes, by doubling; 0 ends every piece, at ``end`` of each place."""
    _, rank = np.unique(codes, return_inverse=True)
    size, place = 1, np.arange(len(codes))
    while True:
        ahead = place + size
        pair = rank.astype(np.int64) * (len(codes) + 1) + np.where(ahead <= end, rank[np.minimum(ahead, end)] + 1, 0)
        order = np.argsort(pair, kind="stable")
        new = np.cumsum(np.r_[False, pair[order][1:] != pair[order][:-1]])
        same = new[-1] == rank.max()
        rank = np.empty_like(new)
        rank[order] = new
        size *= 2
        if same or size > (end - place).max():
            return order


def transform(codes: np.ndarray, end: np.ndarray, pieces: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Places of the sorted suffixes, the letter before each (0: none), and the row of the suffix one longer.

    The rows of the ends come first, in the order of the pieces.
    """
    order = suffix_order(codes, end)
    before = np.where((order > 0) & (codes[order - 1] > 0), codes[order - 1], 0)
    longer = np.full(len(order), -1, np.int64)
    known = np.flatnonzero(before)
    # Suffixes with one letter before them keep their order when that letter is put in front.
    longer[known[_stable(before[known])]] = pieces + np.arange(len(known))
    return order, before, longer


def interleave(shards: list[tuple[np.ndarray, np.ndarray, np.ndarray, int]], rounds: int) -> tuple[np.ndarray, np.ndarray]:
    """Merge the transforms of shards: (rows in merged order, block of each).

    A row is numbered through all shards. At first the shards lie one after another. A round goes
    through the rows in their order and deals each one's longer suffix to the place of its
    first letter, which orders the rows by one more letter without comparing suffixes. Rows of
    one block share as many letters as there were rounds, so a border that no round made is a
    common prefix of ``rounds`` letters or more. Ends early when a round makes no border.
    """
    base = np.cumsum([0] + [len(s[1]) for s in shards])
    before = np.concatenate([s[1] for s in shards])
    longer = np.concatenate([np.where(s[2] >= 0, s[2] + b, -1) for s, b in zip(shards, base, strict=False)])
    ends = np.concatenate([b + np.arange(s[3]) for s, b in zip(shards, base, strict=False)])
    rows, block, blocks = np.arange(len(before)), np.zeros(len(before), np.int64), 1
    for _ in range(rounds):
        letter = before[rows]
        some = np.flatnonzero(letter)
        some = some[_stable(letter[some])]
        first, old = letter[some], block[some]
        border = np.r_[True, (first[1:] != first[:-1]) | (old[1:] != old[:-1])][: len(some)]
        rows = np.concatenate([ends, longer[rows[some]]])
        block = np.concatenate([np.zeros(len(ends), np.int64), np.cumsum(border)])
        if block[-1] + 1 == blocks:
            break
        blocks = block[-1] + 1
    return rows, block


def repeated_strings(
    pieces: list[bytes], ahead: np.ndarray, strings: np.ndarray, copies: np.ndarray, length: int
) -> np.ndarray:
    """Whether each string of each piece (flat, piece by piece) occurs twice, in these pieces or their copies.

    Letters are ``SYMBOL`` bytes, cut at whole letters from the anchor, so equal strings of one
    anchor are cut alike. The merged transforms give the blocks that share all whole letters of a
    string; strings of a block are equal if the bytes before and after those letters are.
    """
    inner = (length - SYMBOL + 1) // SYMBOL
    sizes = np.array([len(p) for p in pieces])
    offset = np.cumsum(sizes) - sizes
    blob = b"".join(pieces) + bytes(2 * SYMBOL)
    word = np.ndarray((len(blob) - 7,), ">u8", blob, strides=(1,))
    skip = ahead % SYMBOL
    letters = (sizes - skip) // SYMBOL
    piece = np.repeat(np.arange(len(pieces)), letters + 1)
    nth = np.arange(len(piece)) - np.repeat(np.cumsum(letters + 1) - letters - 1, letters + 1)
    whole = nth < letters[piece]
    at = skip[piece] + SYMBOL * nth  # within the piece
    codes = np.zeros(len(piece), np.int64)
    codes[whole] = np.unique(word[(offset[piece] + at)[whole]].astype(np.uint64), return_inverse=True)[1] + 1
    end = np.repeat(np.cumsum(letters + 1) - 1, letters + 1)

    shards, orders, cut = [], [], 0
    border = np.cumsum(letters + 1)
    while cut < len(pieces):
        low = int(border[cut - 1]) if cut else 0
        last = max(cut + 1, int(np.searchsorted(border, low + SHARD, side="right")))
        high = int(border[last - 1])
        order, before, longer = transform(codes[low:high], end[low:high] - low, last - cut)
        shards.append((order, before, longer, last - cut))
        orders.append(order + low)
        cut = last
    rows, block = interleave(shards, inner)
    place = np.concatenate(orders)[rows]

    first = np.cumsum(strings) - strings  # flat number of a piece's first string
    found = np.zeros(int(strings.sum()), bool)
    owner, spot = piece[place], at[place]
    useful = whole[place] & (spot <= strings[owner] + SYMBOL - 2)
    owner, spot, block = owner[useful], spot[useful], block[useful]
    weight = copies[owner]
    heavy = np.bincount(block, weights=weight, minlength=1) >= 2 if len(block) else np.zeros(1, bool)
    # A string may repeat within its own block only; one that overlaps itself is in it several times.
    owner, spot, weight, block = (x[heavy[block]] for x in (owner, spot, weight, block))
    for before in range(SYMBOL):
        some = np.flatnonzero((spot >= before) & (spot - before < strings[owner]))
        if not len(some):
            continue
        own, start, blk = owner[some], spot[some] - before, block[some]
        after = offset[own] + start + before + inner * SYMBOL
        rest = length - before - inner * SYMBOL
        near = min(rest, SYMBOL - before)  # share a word with the bytes before; up to six bytes may follow them
        right = word[after].astype(np.uint64) >> np.uint64(8 * (SYMBOL - near))
        if before:
            left = word[offset[own] + start].astype(np.uint64) >> np.uint64(8 * (SYMBOL - before))
            right = right | (left << np.uint64(8 * near))
        keys = [right, blk]
        if rest > near:
            keys.insert(0, word[after + near].astype(np.uint64) >> np.uint64(8 * (SYMBOL - rest + near)))
        sort = np.lexsort(keys)
        border = np.r_[True, np.logical_or.reduce([k[sort][1:] != k[sort][:-1] for k in keys])]
        total = np.add.reduceat(weight[some][sort], np.flatnonzero(border))
        twice = sort[(total >= 2)[np.cumsum(border) - 1]]
        found[first[own[twice]] + start[twice]] = True
    return found


RUNS = "one long, two long, low long, high long"


def _bucket(rows: pa.Table, length: int) -> pa.Table:
    """Runs of repeated strings of a bucket's pieces, numbered within each piece."""
    pieces = rows.column("piece").to_pylist()
    ahead, strings, copies, one, two = (
        rows.column(c).to_numpy() for c in ("ahead", "strings", "copies", "one", "two")
    )
    found = repeated_strings(pieces, ahead, strings, copies, length)
    owner = np.repeat(np.arange(len(pieces)), strings)
    nth = np.arange(len(owner)) - (np.cumsum(strings) - strings)[owner]
    step = owner[1:] != owner[:-1]
    low = np.flatnonzero(found & np.r_[True, ~found[:-1] | step])
    high = np.flatnonzero(found & np.r_[~found[1:] | step, True])
    return pa.table({"one": one[owner[low]], "two": two[owner[low]], "low": nth[low], "high": nth[high]})


PIECE = ("key", "one", "two", "copies", "ahead", "strings", "piece")


def _split(pieces: DataFrame, width: int, length: int) -> DataFrame:
    """Pieces by ranges of ``width`` distances to the anchor, keyed by the bytes that all strings of a range hold.

    Equal strings have equal distances and equal bytes in the middle, so they get one key. Members
    of a key differ in fewer than ``width`` bytes at either end; at a width of one in none.
    """
    ranges = F.sequence(
        F.floor((F.col("ahead") - F.col("strings") + 1) / width).cast("long"), F.floor(F.col("ahead") / width).cast("long")
    )
    each = pieces.withColumn("range", F.explode(ranges))
    far = F.least(F.col("ahead"), (F.col("range") + 1) * width - 1)
    near = F.greatest(F.col("ahead") - F.col("strings") + 1, F.col("range") * width)
    each = each.withColumns({"far": far, "near": near, "shift": F.col("ahead") - far})
    part = F.expr(f"substring(piece, cast(shift + 1 as int), cast(far - near + {length} as int))")
    middle = F.expr(f"substring(part, cast(far - range * {width} + 1 as int), {length - width + 1})")
    return each.withColumn("part", part).select(
        F.xxhash64("key", "range", middle).alias("key"),
        F.xxhash64(F.lit(1), "far", "part").alias("one"),
        F.xxhash64(F.lit(2), "far", "part").alias("two"),
        F.col("one").alias("of_one"), F.col("two").alias("of_two"), "shift", "copies",
        F.col("far").alias("ahead"), (F.col("far") - F.col("near") + 1).alias("strings"), F.col("part").alias("piece"),
    )


def _in_groups(pieces: DataFrame, length: int, steps: Steps) -> tuple[DataFrame, list[DataFrame]]:
    """Pieces whose key has at most ``GROUP`` of them, and for every split the places of its parts in the wholes.

    The pieces of a key that has more are split by distance, each range keyed by what its strings
    have in common, equal parts counted as one; what is still too large is split finer, down to
    single strings, of which a key has one.
    """
    ready, places = None, []
    for turn, width in enumerate((0, *WIDTHS)):
        if width:
            parts = steps.keep(_split(pieces, width, length), f"parts{turn}")
            places.append(parts.select("one", "two", "of_one", "of_two", "shift"))
            first = [F.first(c).alias(c) for c in ("ahead", "strings", "piece")]
            pieces = parts.groupBy("key", "one", "two").agg(F.sum("copies").alias("copies"), *first).select(*PIECE)
            pieces = steps.keep(pieces, f"split{turn}")
        sizes = pieces.groupBy("key").agg(F.count(F.lit(1)).alias("kinds"))
        large = steps.keep(sizes.filter(F.col("kinds") > GROUP).select("key"), f"large{turn}")
        some = width != 1 and large.limit(1).count() > 0
        fit = pieces.join(large, "key", "left_anti") if some else pieces
        ready = fit if ready is None else ready.unionByName(fit)
        if not some:
            break
        pieces = pieces.join(large, "key", "left_semi")
    return ready, places


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Join overlapping spans, and the bytes outside them."""
    for batch in some_rows(batches, "data", 8 * SLICE):
        kept, spans = [], []
        for data, found in zip(batch.column("data").to_pylist(), batch.column("found").to_pylist(), strict=True):
            merged: list[list[int]] = []
            for span in sorted((s["start"], s["stop"]) for s in found or ()):
                if merged and span[0] <= merged[-1][1]:
                    merged[-1][1] = max(merged[-1][1], span[1])
                else:
                    merged.append(list(span))
            spans.append([{"start": a, "stop": b} for a, b in merged])
            edges = [0, *(e for span in merged for e in span), len(data)]
            kept.append(b"".join(data[a:b] for a, b in zip(edges[::2], edges[1::2], strict=True)) if merged else data)
        span_type = pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64())]))
        yield pa.RecordBatch.from_arrays(
            [batch.column("id"), batch.column("data"), pa.array(spans, span_type), pa.array(kept, pa.binary())],
            names=["id", "data", "spans", "kept"],
        )


def remove_repeats(docs: DataFrame, length: int = 400, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, data, spans, kept): the bytes of every text, the spans in strings that occur twice, and the rest.

    A span is a maximal run of bytes that lie in a string of ``length`` bytes which also starts
    anywhere else, in the same text or another. Strings do not cross texts, and all are judged on
    the input. ``kept`` is binary, as a span may end inside a character.

    1. Every string has an anchor, the gram with the least hash in it; strings that follow each
       other with one anchor are a piece. Only pieces whose gram occurs twice can hold repeats.
    2. Equal pieces become one with a count. Pieces are dealt to buckets by their gram, so that all
       occurrences of a string meet. The pieces of a gram that is in more than ``GROUP`` different
       ones are first split by distance to the anchor and dealt by the bytes their strings share.
    3. In a bucket, shards of pieces get their Burrows-Wheeler transform each; the transforms are
       merged by refining their interleave letter by letter, and the blocks that share a string's
       letters are the repeated intervals. These go back to all copies of their pieces.

    ``length`` may be any number from ``GRAM`` up.
    A null text counts as empty; one shorter than ``length`` has no spans; repeated rows remove
    each other when they are long enough; ids may be null or repeated and are only carried along;
    other columns are not read; an empty table gives no rows.
    """
    if length < GRAM:
        raise ValueError(f"length must be at least {GRAM}")
    spark = docs.sparkSession
    steps = Steps(spark)
    data = F.coalesce(F.col(text_col).cast("binary"), F.lit(b""))
    texts = docs.select(F.monotonically_increasing_id().alias("row"), F.col(id_col).alias("id"), data.alias("data"))
    texts = steps.keep(texts, "texts")
    names = ("row", "place", "strings", "ahead", "gram", "one", "two")
    long = texts.filter(F.octet_length("data") >= length).select("row", "data")
    pieces = steps.keep(
        long.mapInArrow(lambda batches: _all_anchors(batches, length), ", ".join(f"{n} long" for n in names)), "pieces"
    )
    where = F.struct("row", "place", "strings", "ahead")
    distinct = pieces.groupBy("gram", "one", "two").agg(F.count(F.lit(1)).alias("copies"), F.min(where).alias("at"))
    distinct = steps.keep(distinct, "distinct")
    grams = distinct.groupBy("gram").agg(F.sum("copies").alias("all")).filter("`all` > 1").drop("all")
    chosen = steps.keep(distinct.join(grams, "gram", "left_semi").select("gram", "one", "two", "copies", "at.*"), "chosen")
    steps.drop("distinct")
    bytes_of = F.expr(f"substring(data, cast(place + 1 as int), cast(strings + {length - 1} as int))")
    cut = chosen.join(texts.select("row", "data"), "row").select(F.col("gram").alias("key"), *PIECE[1:-1], bytes_of.alias("piece"))
    ready, places = _in_groups(steps.keep(cut, "cut"), length, steps)
    amount = ready.agg(F.sum(F.col("strings") + length)).first()[0] or 0
    buckets = max(1, -(-amount // BUCKET_BYTES))
    dealt = ready.withColumn("bucket", F.pmod(F.xxhash64("key"), F.lit(buckets)))
    runs = steps.keep(dealt.groupBy("bucket").applyInArrow(lambda rows: _bucket(rows, length), RUNS), "found")
    for place in reversed(places):
        lifted = runs.join(place, ["one", "two"]).select(
            F.col("of_one").alias("one"), F.col("of_two").alias("two"),
            (F.col("low") + F.col("shift")).alias("low"), (F.col("high") + F.col("shift")).alias("high"),
        )
        runs = runs.unionByName(lifted)
    spans = pieces.join(runs, ["one", "two"]).select(
        "row", F.struct((F.col("place") + F.col("low")).alias("start"), (F.col("place") + F.col("high") + length).alias("stop")).alias("span")
    )
    spans = steps.keep(spans.groupBy("row").agg(F.collect_list("span").alias("found")), "spans")
    span_type = "array<struct<start:bigint,stop:bigint>>"
    schema = f"id {docs.schema[id_col].dataType.simpleString()}, data binary, spans {span_type}, kept binary"
    return texts.join(spans, "row", "left").select("id", "data", "found").mapInArrow(_cut, schema)


def op12_bwt_dedup(spark: SparkSession, folder: str) -> DataFrame:
    found = remove_repeats(table(spark, folder, "documents"))
    return found.select(
        F.col("id").alias("doc_id"),
        F.octet_length("data").cast("long").alias("n_bytes"),
        (F.octet_length("data") - F.octet_length("kept")).cast("long").alias("n_removed"),
        F.size("spans").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )
