"""Benchmark decontamination: exact n-gram windows of test items found in training texts.

Every window of an item hangs on its longest word, its anchor. A scan over the documents looks each word up in a
broadcast hash table of anchors and verifies the whole window around a hit in the same generated code, so only true
occurrences leave the scan. Benchmarks too large for one table are taken in blocks of a fixed number of windows, one scan
each.
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chronogeo.llm.tables import cut, order_of, with_key, without

WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
ANY_CASE_WORD = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
BETWEEN_WORDS = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
BLOCK = 100_000  # windows in a broadcast table, some 20 MB
END = " "  # stands after the last word of a text; no word contains it


def word_list(text: Column) -> Column:
    return F.regexp_extract_all(F.translate(text, UPPER, UPPER.lower()), F.lit(WORD), 0)


def any_case_words(text: Column) -> Column:
    """The words of `word_list` as they are written. Splitting a text is several times faster than matching each word."""
    return F.array_remove(F.split(text, BETWEEN_WORDS), "")


def small_letters(word: Column) -> Column:
    """A-Z in lower case and all else as it is, in the fast way where nothing else is."""
    return F.when(F.octet_length(word) == F.char_length(word), F.lower(word)).otherwise(F.translate(word, UPPER, UPPER.lower()))


def item_windows(benchmark: DataFrame, size: int) -> DataFrame:
    """(item_id, window, len, anchor, at): anchor is the longest word of the window and at its place in it."""
    items = benchmark.select("item_id", word_list(F.coalesce(F.col("text").cast("string"), F.lit(""))).alias("words"))
    first = F.explode(F.sequence(F.lit(1), F.greatest(F.lit(1), F.size("words") - size + 1)))
    cut_out = items.filter(F.size("words") > 0).select("item_id", "words", first.alias("first")).select(
        "item_id", F.slice("words", F.col("first"), F.lit(size)).alias("w"))
    longest = F.array_max(F.transform("w", lambda t, i: F.struct(F.length(t).alias("n"), t.alias("t"), (-i).alias("i"))))
    return cut_out.withColumn("best", longest).select(
        "item_id", F.array_join("w", " ").alias("window"), F.size("w").alias("len"),
        F.col("best.t").alias("anchor"), (-F.col("best.i")).alias("at")).distinct()


def occurrences(docs: DataFrame, windows: DataFrame, n_windows: int) -> DataFrame:
    """(doc_id, ord, tkey, window, first, len) for each occurrence; and a row per document with first = its number of words
    and no window. `windows`: (window, len, anchor, at), one row each."""
    words = with_key(docs).select("doc_id", "ord", "tkey", F.concat(any_case_words(F.col("text")), F.array(F.lit(END))).alias("words"))
    spread = words.select("doc_id", "ord", "tkey", "words", F.posexplode("words").alias("pos", "word")).withColumn("word", small_letters(F.col("word")))
    end = docs.sparkSession.createDataFrame([(None, 1, END, 0)], "window string, len int, anchor string, at int")
    blocks = max(1, math.ceil(n_windows / BLOCK))
    parts = []
    for k in range(blocks):
        part = windows if blocks == 1 else windows.filter(F.pmod(F.xxhash64("window"), F.lit(blocks)) == k)
        table = part.unionByName(end) if k == 0 else part
        begin = F.col("pos") - F.col("at")
        same = F.when(F.col("window").isNull(), F.lit(True)).when(begin < 0, F.lit(False)).otherwise(
            small_letters(F.array_join(F.slice("words", begin + 1, F.col("len")), " ")) == F.col("window"))
        parts.append(spread.join(F.broadcast(table), (F.col("word") == F.col("anchor")) & same)
                     .select("doc_id", "ord", "tkey", "window", begin.alias("first"), "len"))
    return reduce(DataFrame.unionByName, parts)


def find_contamination(docs: DataFrame, benchmark: DataFrame, size: int = 13, percent: int = 5) -> DataFrame:
    """(doc_id, ord, tkey, copies, n_words, hit, items): per document the places of hit words and the items found.

    Words are runs of letters, digits and characters beyond ASCII, with A-Z in lower case. A window is `size` consecutive
    words of an item; a shorter item, unless it has no words, is one window. A document is contaminated if at least
    `percent` of its words, and one at least, are hit. Null texts have no words. Items without an id make hits but don't
    count. Rows with equal id and text are one document with `copies` rows. Other columns are ignored.
    """
    pairs = cut(item_windows(benchmark, size))
    windows = cut(pairs.select("window", "len", "anchor", "at").distinct())
    found = cut(occurrences(docs, windows, windows.count()).groupBy("ord", "tkey", "doc_id").agg(
        F.max(F.when(F.col("window").isNull(), F.col("first"))).cast("long").alias("n_words"),
        F.sum(F.when(F.col("window").isNull(), 1).otherwise(0)).alias("copies"),
        F.collect_set(F.when(F.col("window").isNotNull(), F.struct("first", "len"))).alias("spans"),
        F.collect_set("window").alias("windows")))
    hit = F.array_distinct(F.flatten(F.transform("spans", lambda s: F.sequence(s["first"], s["first"] + s["len"] - 1))))
    items = (found.select("ord", "tkey", F.explode("windows").alias("window"))
             .join(pairs.filter(F.col("item_id").isNotNull()).select("window", "item_id"), "window")
             .groupBy("ord", "tkey").agg(F.array_sort(F.collect_set(F.col("item_id").cast("string"))).alias("items")))
    none = F.array().cast("array<string>")
    share = F.size("hit") * 100 >= F.col("n_words") * percent
    return (found.join(items, ["ord", "tkey"], "left")
            .select("doc_id", "ord", "tkey", "copies", "n_words", hit.alias("hit"), F.coalesce("items", none).alias("items"))
            .withColumn("contaminated", (F.size("hit") > 0) & share))


def report(docs: DataFrame, benchmark: DataFrame, size: int = 13, percent: int = 5) -> DataFrame:
    """(doc_id, n_words, n_hit, items, contaminated), one row per input row."""
    found = find_contamination(docs, benchmark, size, percent)
    return (found.withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), "copies")))
            .select("doc_id", "n_words", F.size("hit").cast("long").alias("n_hit"), "items", "contaminated"))


def decontaminate(docs: DataFrame, benchmark: DataFrame, remove: str = "documents", size: int = 13, percent: int = 5) -> DataFrame:
    """The input without contaminated documents, or (remove="spans") with the hit words cut out of every text.

    All columns stay. See find_contamination for what is hit. A word goes with the separators behind it.
    """
    found = find_contamination(docs, benchmark, size, percent).select("ord", "tkey", "hit", "contaminated")
    text = F.coalesce(F.col("row.text").cast("string"), F.lit(""))
    rows = (docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))
            .select("row", order_of(F.col("row.doc_id")).alias("ord"), F.xxhash64(text).alias("tkey")))
    if remove == "documents":
        gone = cut(found.filter("contaminated").select("ord", "tkey"))  # as a small table it is sent to the rows, which stay where they are
        return rows.join(gone, ["ord", "tkey"], "left_anti").select("row.*")
    pieces = F.regexp_extract_all(text, F.lit(f"{ANY_CASE_WORD}(?:(?!{ANY_CASE_WORD})[\\s\\S])*"), 0)
    rest = F.concat(F.regexp_extract(text, f"^(?:(?!{ANY_CASE_WORD})[\\s\\S])*", 0), F.array_join(without(pieces, F.col("hit")), ""))
    cleaned = F.when(F.size("hit") > 0, rest).otherwise(F.col("row.text"))
    return (rows.join(found.filter(F.size("hit") > 0).select("ord", "tkey", "hit"), ["ord", "tkey"], "left")
            .select(*[cleaned.alias(c) if c == "text" else F.col("row")[c].alias(c) for c in docs.columns]))
