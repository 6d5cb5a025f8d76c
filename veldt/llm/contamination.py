"""Benchmark decontamination with a positional inverted index, in DataFrame operations only.

The index holds a posting (term, document, position) for every training word that any test item uses. Each window of an
item's words is looked up from its rarest term: that term's postings, moved back by its offset in the window, are the
possible starts; they are intersected with the moved postings of the second rarest term, and what is left is compared
word by word with the document. ``proximity_matches`` asks the same index for two terms near each other in any order.

Defined results: a null or wordless text has no words and no hits; a null or wordless item has no window; rows with a
null id are matched like others; repeated rows give repeated rows; a missing id of an item is the text ''; empty tables
give rows without hits, or no rows. Extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from veldt.llm.common import lower_ascii, written

WINDOW = 10
BETWEEN = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: a vocabulary of test terms of at most so many rows (8 bytes each) may be broadcast; a larger one is shuffled
BROADCAST_TERMS = 1_000_000


def words_of(text: Column) -> Column:
    found = F.split(lower_ascii(F.coalesce(text, F.lit(""))), BETWEEN)
    return F.filter(found, lambda w: w != "")


def item_windows(items: DataFrame, item_id: str, text: str, window: int) -> DataFrame:
    """(wid, words, item) for each distinct window of each item; wid is the words' hash."""
    rows = items.select(F.coalesce(F.col(item_id).cast("string"), F.lit("")).alias("item"), words_of(F.col(text)).alias("w"))
    n = F.size("w")
    starts = F.when(n >= window, F.sequence(F.lit(1), n - window + 1)).when(n > 0, F.array(F.lit(1)))
    rows = rows.select("item", "w", F.explode(starts).alias("at"))
    rows = rows.select("item", F.slice("w", F.col("at"), window).alias("words"))
    return rows.withColumn("wid", F.xxhash64("words")).distinct()


def keyed(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    """Documents with a row key; equal keys only make more candidates, which are compared with each row's own words."""
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    return rows.withColumn("doc", F.xxhash64("doc_id", "text"))


def known_terms(terms: DataFrame) -> DataFrame:
    terms = written(terms)
    return F.broadcast(terms) if terms.count() <= BROADCAST_TERMS else terms


def positional_index(rows: DataFrame, terms: DataFrame) -> DataFrame:
    """Postings (term, doc, pos) of the given terms in keyed documents, as a stored table."""
    found = rows.select("doc", F.posexplode(words_of(F.col("text"))).alias("pos", "word"))
    found = found.select(F.xxhash64("word").alias("term"), "doc", "pos")
    return written(found.join(known_terms(terms), "term", "left_semi"))


def by_rarity(windows: DataFrame, index: DataFrame, skip_absent: bool = False) -> DataFrame:
    """(wid, words, first, second): the two rarest terms of each window with their offsets. Windows with a term that
    never occurs are left out; with ``skip_absent`` only such terms are, and the rarest of the others stand."""
    placed = windows.select("wid", "words").distinct()
    placed = placed.select("wid", "words", F.posexplode("words").alias("off", "word"))
    placed = placed.withColumn("term", F.xxhash64("word")).drop("word")
    known = index.groupBy("term").agg(F.count("*").alias("cf"))
    placed = placed.join(known, "term", "inner" if skip_absent else "left").groupBy("wid", "words")
    ranked = placed.agg(F.array_sort(F.collect_list(F.struct(F.coalesce("cf", F.lit(0)).alias("cf"), "off", "term"))).alias("t"))
    return ranked.filter("t[0].cf > 0").select(
        "wid", "words", F.col("t")[0].alias("first"), F.get("t", F.lit(1)).alias("second")
    )


def candidates(windows: DataFrame, index: DataFrame) -> DataFrame:
    """(doc, start, words, wid) where the two rarest terms of a window stand at their places."""
    ranked = written(by_rarity(windows, index))
    first = ranked.select(F.col("first.term").alias("term"), F.col("first.off").alias("off"), "second", "wid", "words")
    listed = index.join(known_terms(first.select("term").distinct()), "term", "left_semi")
    starts = listed.join(first, "term").withColumn("start", F.col("pos") - F.col("off")).filter("start >= 0")
    starts = starts.select("doc", "start", "second", "wid", "words")
    others = ranked.select(F.col("second.term").alias("term")).filter("term IS NOT NULL").distinct()
    others = index.join(known_terms(others), "term", "left_semi")
    alone = starts.filter("second IS NULL").drop("second")
    pairs = starts.filter("second IS NOT NULL").withColumn("term", F.col("second.term"))
    pairs = pairs.withColumn("pos", F.col("start") + F.col("second.off")).drop("second")
    pairs = pairs.join(others, ["doc", "pos", "term"], "left_semi").drop("pos", "term")
    return pairs.unionByName(alone)


def phrase_matches(
    docs: DataFrame,
    items: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    window: int = WINDOW,
) -> tuple[DataFrame, DataFrame]:
    """Documents with their matches, and the windows of the items.

    The first has a row per row of ``docs``: doc_id, doc (row key), n_words, matches (start, length, wid). The second
    has (wid, item); joined by wid they give exact phrase matches by item.
    """
    rows = keyed(docs, doc_id, text)
    windows = written(item_windows(items, item_id, item_text, window))
    terms = windows.select(F.explode("words").alias("word")).select(F.xxhash64("word").alias("term")).distinct()
    found = candidates(windows, positional_index(rows, terms))
    found = found.groupBy("doc").agg(F.collect_set(F.struct("start", "wid", "words")).alias("found"))
    rows = rows.join(found, "doc", "left").withColumn("w", words_of(F.col("text")))
    real = F.filter("found", lambda c: F.slice(F.col("w"), c["start"] + 1, F.size(c["words"])) == c["words"])
    real = F.transform(real, lambda c: F.struct(c["start"].alias("start"), F.size(c["words"]).alias("length"), c["wid"].alias("wid")))
    rows = rows.select("doc_id", "doc", F.size("w").cast("long").alias("n_words"), real.alias("matches"))
    return rows, windows.select("wid", "item").distinct()


def contamination(docs: DataFrame, items: DataFrame, **names) -> DataFrame:
    """A row per row of ``docs``: doc_id, doc, n_words, n_hit, items (sorted), contaminated."""
    rows, windows = phrase_matches(docs, items, **names)
    covered = F.transform("matches", lambda m: F.sequence(m["start"], m["start"] + m["length"] - 1))
    hits = F.coalesce(F.size(F.array_distinct(F.flatten(covered))), F.lit(0))
    wids = F.array_distinct(F.transform("matches", lambda m: m["wid"]))
    rows = written(rows.select("doc_id", "doc", "n_words", hits.cast("long").alias("n_hit"), wids.alias("wids")))
    by_item = rows.select("doc", F.explode("wids").alias("wid")).distinct().join(windows, "wid")
    by_item = by_item.groupBy("doc").agg(F.array_sort(F.collect_set("item")).alias("items"))
    return rows.join(by_item, "doc", "left").select(
        "doc_id",
        "doc",
        "n_words",
        "n_hit",
        F.coalesce("items", F.array().cast("array<string>")).alias("items"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


def proximity_matches(docs: DataFrame, items: DataFrame, within: int, doc_id: str = "doc_id", text: str = "text",
                      item_id: str = "item_id", item_text: str = "text") -> DataFrame:
    """(doc_id, item): documents where the two rarest terms of an item stand at most ``within`` words apart.

    Terms that no document holds are passed over; an item with fewer than two different terms left has no match.
    """
    rows = keyed(docs, doc_id, text)
    whole = items.select(F.coalesce(F.col(item_id).cast("string"), F.lit("")).alias("item"), words_of(F.col(item_text)).alias("words"))
    whole = whole.select("item", F.array_distinct("words").alias("words")).withColumn("wid", F.xxhash64("item", "words"))
    terms = whole.select(F.explode("words").alias("word")).select(F.xxhash64("word").alias("term")).distinct()
    index = positional_index(rows, terms)
    ranked = by_rarity(whole, index, skip_absent=True).filter("second IS NOT NULL").join(whole.select("wid", "item").distinct(), "wid")
    cell = F.floor(F.col("pos") / (within + 1))
    left = index.join(ranked.select(F.col("first.term").alias("term"), F.col("second.term").alias("other"), "item"), "term")
    left = left.select("doc", "other", "item", F.col("pos").alias("p"), F.explode(F.array(cell - 1, cell, cell + 1)).alias("cell"))
    right = index.select("doc", F.col("term").alias("other"), "pos", cell.alias("cell"))
    near = left.join(right, ["doc", "other", "cell"]).filter(F.abs(F.col("p") - F.col("pos")) <= within)
    near = near.select("doc", "item").distinct()
    return rows.select("doc_id", "doc").distinct().join(near, "doc").select("doc_id", "item")
