"""Line deduplication by winnowing.

Of every window of `run` lines the smallest line hash is selected, the last one where equal; neighbouring windows mostly
select the same line, so fewer lines are selected than there are windows. Equal windows select equal lines at equal
places, so a repeated run of at least `run` lines is guaranteed to share one. Selected lines that occur once are dropped;
the others are joined by their hash and extended to both sides over the windows that selected them. A window that also
stands at an earlier place marks its lines, and overlapping windows join to the whole repeated run. Places are compared
with the earliest one of an equal window, never in pairs.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chronogeo.llm.tables import cut, discard, order_of, with_key, without

BLANK = r"^[\x20\x09-\x0D]*$"


def selected_lines(docs: DataFrame, run: int) -> DataFrame:
    """(ord, tkey, print, at, around): the selected lines, their hash and number, and the lines of the windows that select them.

    Minima grow line by line with zip_with over the whole array, and the line that is selected never moves back from one
    window to the next, so a text costs time in proportion to its lines.
    """
    numbered = F.transform(F.split("text", "\n", -1), lambda t, i: F.struct(i.alias("i"), t.alias("t")))
    filled = F.filter(numbered, lambda s: ~s["t"].rlike(BLANK))
    lines = F.transform(filled, lambda s: F.struct(
        F.xxhash64(s["t"]).alias("print"), (-s["i"]).alias("back"), F.unhex(F.md5(s["t"])).alias("content")))
    rows = docs.select("ord", "tkey", lines.alias("lines")).filter(F.size("lines") >= run)
    low = F.transform("lines", lambda s: F.struct(s["print"], s["back"]))
    for k in range(1, run):
        low = F.zip_with(low, F.slice("lines", k + 1, F.size("lines")), lambda a, b: F.least(a, F.struct(b["print"], b["back"])))
    rows = rows.select("ord", "tkey", "lines", F.slice(low, 1, F.size("lines") - run + 1).alias("low"))
    starts = F.filter(F.transform("low", lambda s, p: F.struct(p.alias("p"), s["print"].alias("print"), s["back"].alias("back"))),
                      lambda x: ~F.get("low", x["p"] - 1)["back"].eqNullSafe(x["back"]))
    rows = rows.select("ord", "tkey", "lines", starts.alias("starts"))
    picks = F.zip_with("starts", F.slice("starts", 2, F.size("starts")), lambda a, b: F.struct(
        a["print"].alias("print"), (-a["back"]).alias("at"),
        F.transform(F.slice("lines", a["p"] + 1, F.coalesce(b["p"], F.size("lines") - run + 1) - a["p"] + run - 1),
                    lambda s: F.struct(s["content"].alias("content"), (-s["back"]).alias("at"))).alias("around")))
    return rows.select("ord", "tkey", F.explode(picks).alias("s")).select("ord", "tkey", "s.*")


def extended(picks: DataFrame, run: int) -> DataFrame:
    """(ord, tkey, content, at): the windows around selected lines, the hash of their lines and the lines' numbers."""
    windows = F.transform(F.sequence(F.lit(1), F.size("around") - run + 1), lambda k: F.slice("around", k, run))
    lines = [F.col("w")[k] for k in range(run)]
    return picks.select("ord", "tkey", F.explode(windows).alias("w")).select(
        "ord", "tkey", F.unhex(F.md5(F.concat(*[x["content"] for x in lines]))).alias("content"),
        F.array(*[x["at"] for x in lines]).alias("at"))


def later_runs(docs: DataFrame, run: int) -> DataFrame:
    """(ord, tkey, gone): numbers of the lines of windows that stand at an earlier place of the corpus.

    Aggregates are written before they are joined, so that adaptive execution can split a join on a frequent line; every
    table goes after its last reader.
    """
    picks = cut(selected_lines(docs, run))
    place = F.struct("ord", "at")
    shared = cut(picks.groupBy("print").agg(F.min(place).alias("a"), F.max(place).alias("b")).filter("a < b").select("print"))
    near = extended(picks.join(shared, "print"), run)
    earliest = cut(near.groupBy("content").agg(F.min(place).alias("lead"), F.max(place).alias("last")).filter("lead < last"))
    later = cut(near.join(earliest.select("content", "lead"), "content").filter(F.struct("ord", "at") > F.col("lead"))
                .groupBy("ord", "tkey").agg(F.array_distinct(F.flatten(F.collect_set("at"))).alias("gone")))
    discard(picks, shared, earliest)
    return later


def remove_lines(docs: DataFrame, run: int = 2, stats: bool = False) -> DataFrame:
    """The input with `text` without the lines of repeated runs; with `stats`, also the columns n_lines and n_removed.

    A run of at least `run` lines that are not blank goes if the same lines stand in that order at an earlier place: in a
    document with a smaller doc_id (null: after all others) or further up in the same text. Lines are what newlines
    separate; blank ones (only white space) are skipped in comparisons and stay. Null text stays null and has no lines;
    shorter texts stay as they are. Rows with an equal id and different texts keep a run that only they share at the same
    place. A repeated row comes out as often as it went in. All other columns are kept.
    """
    found = later_runs(with_key(docs), run)
    text = F.coalesce(F.col("row.text").cast("string"), F.lit(""))
    rows = (docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))
            .select("row", order_of(F.col("row.doc_id")).alias("ord"), F.xxhash64(text).alias("tkey"))
            .join(found.hint("merge"), ["ord", "tkey"], "left"))  # the same plan at every size: what is found grows with the input
    lines = F.split(text, "\n", -1)
    kept = F.when(F.col("gone").isNull(), F.col("row.text")).otherwise(F.array_join(without(lines, F.col("gone")), "\n"))
    n_lines = F.when(F.col("row.text").isNull(), 0).otherwise(F.size(lines))
    return rows.select(
        *[kept.alias(c) if c == "text" else F.col("row")[c].alias(c) for c in docs.columns],
        *[n_lines.cast("long").alias("n_lines"), F.coalesce(F.size("gone"), F.lit(0)).cast("long").alias("n_removed")][:2 * stats])
