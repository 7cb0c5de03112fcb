"""Repeated runs of lines, found by winnowing and deleted, in built-in expressions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tradewind.llm.common import Steps, fresh, table

WORD = r"[^\x20\x09-\x0D]+"


def _lines(text: Column) -> Column:
    return F.split(text, "\n", -1)


def line_table(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(id, th, pos, h, words, idx, start): the lines with words of every distinct (id, text).

    ``idx`` numbers them within a text and ``start`` is the number of words before a line.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(F.col(id_col).alias("id"), F.xxhash64(text).alias("th"), F.posexplode(_lines(text)).alias("pos", "line"))
    rows = rows.select("id", "th", "pos", F.xxhash64(F.rtrim("line")).alias("h"), F.regexp_count("line", F.lit(WORD)).alias("words"))
    rows = rows.filter("words > 0").distinct()
    along = Window.partitionBy("id", "th").orderBy("pos")
    return rows.withColumns(
        {"idx": F.row_number().over(along), "start": F.sum(F.col("words").cast("long")).over(along) - F.col("words")}
    )


def winnow(lines: DataFrame, run_words: int, gram_words: int) -> DataFrame:
    """(id, th, gram, run, idx): the selected grams of every text, once for each run that selects them.

    A gram is the shortest run of lines from its first line with ``gram_words`` words. From every
    line on, the smallest of the grams that begin within ``run_words`` - ``gram_words`` words is
    selected. These all end within the shortest run of ``run_words`` words from that line, so two
    equal runs of that many words have a selected gram in common, at the same place in both.
    ``run`` is the hash of the run: a gram may also stand elsewhere, amid other lines.
    """
    along = Window.partitionBy("id", "th").orderBy("start")
    gram = along.rangeBetween(0, gram_words - 1)
    full = F.sum("words").over(gram) >= gram_words
    grams = lines.withColumn("gram", F.when(full, F.xxhash64(F.collect_list("h").over(gram))))
    least = F.min(F.when(F.col("gram").isNotNull(), F.struct("gram", "idx"))).over(along.rangeBetween(0, run_words - gram_words))
    run = along.rangeBetween(0, run_words - 1)
    whole = F.sum("words").over(run) >= run_words
    picked = grams.select("id", "th", F.when(whole, least).alias("m"), F.xxhash64(F.collect_list("h").over(run)).alias("run"))
    return picked.filter("m is not null").select("id", "th", "m.gram", "run", "m.idx")


def repeated_runs(docs: DataFrame, run_words: int = 50, gram_words: int = 25, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, th, runs): line positions, first and last, of the later repeats in each text (of hash th).

    A selected gram is matched with the one before it in the same text, or else with its first
    occurrence in the order of ids and text hashes, in both cases among those that an equal run
    selects: so every later run of ``run_words`` words meets an earlier one. A gram has one match a
    run, so a passage that a third of all texts share adds a few rows each. A match gives a
    diagonal, a pair of texts with a shift, along which equal lines are extended both ways. Runs of
    at least ``run_words`` words count. Every match lies earlier, so the first of them always stays.
    """
    steps = Steps(docs.sparkSession)
    lines = steps.keep(line_table(docs, id_col, text_col), "lines")
    grams = steps.keep(winnow(lines, run_words, gram_words), "grams")
    place = F.struct(F.col("id").isNull().alias("none"), F.col("id"), F.col("th"), F.col("idx"))
    first = grams.groupBy("gram", "run").agg(F.min(place).alias("f"), F.count(F.lit(1)).alias("n")).filter("n > 1")
    same = Window.partitionBy("id", "th", "gram", "run").orderBy("idx")
    met = grams.withColumn("before", F.lag("idx").over(same)).join(first.select("gram", "run", "f"), ["gram", "run"])
    met = met.filter(F.col("before").isNotNull() | (F.col("f") != place))
    own = F.col("before").isNotNull()
    diagonals = met.select(
        "id", "th",
        F.when(own, F.col("id")).otherwise(F.col("f.id")).alias("id2"),
        F.when(own, F.col("th")).otherwise(F.col("f.th")).alias("th2"),
        (F.col("idx") - F.when(own, F.col("before")).otherwise(F.col("f.idx"))).alias("shift"),
    ).distinct()
    packed = lines.groupBy("id", "th").agg(F.sort_array(F.collect_list(F.struct("idx", "h", "words", "pos"))).alias("seq"))
    packed = steps.keep(packed, "packed")
    other = packed.select(F.col("id").alias("oid"), F.col("th").alias("oth"), F.col("seq.h").alias("other"))
    mine = packed.select(F.col("id").alias("mid"), F.col("th").alias("mth"), "seq")
    pairs = diagonals.join(mine, F.col("id").eqNullSafe(F.col("mid")) & (F.col("th") == F.col("mth")))
    pairs = pairs.join(other, F.col("id2").eqNullSafe(F.col("oid")) & (F.col("th2") == F.col("oth")))
    low = F.greatest(F.lit(1), F.col("shift") + 1)
    high = F.least(F.size("seq"), F.size("other") + F.col("shift"))
    equal = lambda i: F.element_at("seq", i)["h"] == F.element_at("other", i - F.col("shift"))
    along = F.when(low <= high, F.filter(F.sequence(low, F.greatest(low, high)), equal))
    hits = pairs.select("id", "th", "id2", "th2", "shift", F.explode(F.transform(along, lambda i: F.element_at("seq", i))).alias("l"))
    diagonal = ["id", "th", "id2", "th2", "shift"]
    numbered = hits.withColumn("island", F.col("l.idx") - F.row_number().over(Window.partitionBy(*diagonal).orderBy("l.idx")))
    runs = numbered.groupBy(*diagonal, "island").agg(
        F.sum("l.words").alias("words"), F.min("l.pos").alias("first"), F.max("l.pos").alias("last")
    )
    found = runs.filter(F.col("words") >= run_words).groupBy("id", "th").agg(F.collect_set(F.struct("first", "last")).alias("runs"))
    found = steps.keep(found, "runs")
    for name in ("lines", "grams", "packed"):
        steps.drop(name)
    return found


def dedup_lines(
    docs: DataFrame, run_words: int = 50, gram_words: int = 25, id_col: str = "doc_id", text_col: str = "text"
) -> tuple[DataFrame, str, str]:
    """All rows and columns with later repeated runs deleted from the text, and two new column names.

    The two hold the lines before and the lines deleted. A line's trailing spaces do not count;
    lines without words are only deleted inside a run. Texts are ordered by id, null last, then
    by hash; rows of equal id and text are one text, and each of them gets its result. A
    null text stays null; a text without a repeated run is unchanged; an empty table stays so.
    """
    runs = repeated_runs(docs, run_words, gram_words, id_col, text_col)
    names = [fresh(n, docs.columns) for n in ("runs_", "run_id_", "run_th_", "n_lines", "n_removed")]
    found, rid, rth, before, removed = names
    runs = runs.select(F.col("id").alias(rid), F.col("th").alias(rth), F.col("runs").alias(found))
    same = F.col(id_col).eqNullSafe(F.col(rid)) & (F.xxhash64(F.coalesce(F.col(text_col), F.lit(""))) == F.col(rth))
    joined = docs.join(runs.hint("shuffle_hash"), same, "left")
    lines = _lines(F.col(text_col))
    inside = lambda p: F.exists(F.col(found), lambda r: p.between(r["first"], r["last"]))
    kept = F.filter(lines, lambda x, p: ~inside(p))
    changed = joined.withColumns(
        {
            before: F.when(F.col(text_col).isNull(), 0).otherwise(F.size(lines)),
            removed: F.when(F.col(found).isNull() | F.col(text_col).isNull(), 0).otherwise(F.size(lines) - F.size(kept)),
            text_col: F.when(F.col(found).isNull(), F.col(text_col)).otherwise(F.array_join(kept, "\n")),
        }
    )
    return changed.select(*docs.columns, before, removed), before, removed


def op2_winnowing_lines(spark: SparkSession, folder: str) -> DataFrame:
    rows, before, removed = dedup_lines(table(spark, folder, "documents").select("doc_id", "text"))
    return rows.select("doc_id", "text", F.col(before).alias("n_lines"), F.col(removed).alias("n_removed"))
