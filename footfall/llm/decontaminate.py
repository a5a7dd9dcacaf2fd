"""Benchmark decontamination as a prefix-filtered set join.

An item is cut into windows of consecutive words, a window into its shingles of three words (fewer
in a shorter item). A window can only occur where all its shingles do, so one shingle is a
sufficient prefix: the rarest in the corpus. Only places where that one occurs, and where position
and length leave room for the whole window, become candidates, and a candidate counts when every
shingle of the window stands at its place. Shingles are compared as text, so containment is exact.
DataFrame functions only.

The corpus is read once: its shingles meet the items' shingles in one join (a broadcast while the
items' side is small, else a shuffle), and all later steps work on what that join leaves.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from footfall.llm.common import BROADCAST_ROWS, ROW_KEY, ascii_lower, fresh, row_key
from footfall.session import staged

#: Runs of these separate words; A-Z are lower-cased or word characters before it applies.
SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
SHINGLE = 3


def words_of(text: Column) -> Column:
    """Lower-cased words: runs of a-z, 0-9 and all characters beyond ASCII. Null text has none."""
    return F.filter(
        F.split(F.coalesce(ascii_lower(text), F.lit("")), SEPARATORS), lambda w: w != ""
    )


def _shingles(words: Column, size: int) -> Column:
    """All runs of ``size`` words, each joined by one space, in order."""
    if size == 1:
        return words
    last = F.size(words) - size
    starts = F.when(last >= 0, F.sequence(F.lit(0), last)).otherwise(F.array().cast("array<int>"))
    return F.transform(starts, lambda i: F.concat_ws(" ", *(F.get(words, i + k) for k in range(size))))


def item_windows(items: DataFrame, window: int, id_col: str = "item_id", text_col: str = "text") -> DataFrame:
    """``item, window_id, n, size, words``: the distinct windows of each item (ids as text, null as ``null``).

    An item shorter than a window is one window; an item without words has none.
    """
    words = items.select(
        F.coalesce(F.col(id_col).cast("string"), F.lit("null")).alias("item"), words_of(F.col(text_col)).alias("words")
    ).where(F.size("words") > 0)
    n = F.least(F.lit(window), F.size("words"))
    cut = words.select("item", "words", F.explode(F.sequence(F.lit(1), F.size("words") - n + 1)).alias("start"))
    cut = cut.select("item", F.slice("words", F.col("start"), F.least(F.lit(window), F.size("words"))).alias("words")).distinct()
    return cut.select(
        "item", F.md5(F.array_join("words", " ")).alias("window_id"), F.size("words").alias("n"),
        F.least(F.lit(SHINGLE), F.size("words")).alias("size"), "words",
    )


def window_shingles(windows: DataFrame) -> DataFrame:
    """``window_id, n, size, offset, shingle`` for each shingle of each distinct window."""
    one = windows.select("window_id", "n", "size", "words").dropDuplicates(["window_id"])
    by_size = [
        one.where(F.col("size") == k).select(
            "window_id", "n", "size", F.posexplode(_shingles(F.col("words"), k)).alias("offset", "shingle")
        )
        for k in range(1, SHINGLE + 1)
    ]
    return by_size[0].unionByName(by_size[1]).unionByName(by_size[2])


def _corpus_matches(docs: DataFrame, id_col: str, text_col: str, needed: DataFrame) -> DataFrame:
    """``key, doc, n_words, size, pos, shingle`` where a wanted shingle occurs, and one row (size 0) per document."""
    wanted = needed.select("size", "shingle").distinct()
    n_wanted = wanted.count()
    sizes = sorted(row["size"] for row in wanted.select("size").distinct().collect())  # 1, 2, 3 at most
    small = n_wanted <= BROADCAST_ROWS // 10  # at most some 10 MB of short texts
    split = docs.select(*row_key(id_col, text_col), F.col(id_col).alias("doc"), words_of(F.col(text_col)).alias("words"))
    marker = wanted.sparkSession.range(1).select(F.lit(0).alias("size"), F.lit("").alias("shingle"))
    found = None
    for k in sizes or [SHINGLE]:
        texts = _shingles(F.col("words"), k)
        keys = wanted.where(F.col("size") == k)
        if found is None:  # the marker rows come with the first size
            texts = F.concat(F.array(F.lit("")), texts)
            keys = keys.unionByName(marker)
        shift = 1 if found is None else 0
        places = split.select(*ROW_KEY, "doc", F.size("words").alias("n_words"), F.posexplode(texts).alias("pos", "shingle"))
        places = places.withColumn("pos", F.col("pos") - shift)
        part = places.join(F.broadcast(keys) if small else keys, "shingle")
        found = part if found is None else found.unionByName(part)
    return found


def contamination(
    docs: DataFrame, items: DataFrame, window: int = 13, share: int = 20,
    id_col: str = "doc_id", text_col: str = "text", item_id_col: str = "item_id", item_text_col: str = "text",
) -> DataFrame:
    """One row per row of ``docs``: ``key_hi, key_lo, doc, n_words, n_hit, n_items, items, contaminated``.

    ``n_hit`` counts words inside any occurrence of an item's window, ``items`` lists the items found
    (sorted as strings). Contaminated: n_hit > 0 and share * n_hit >= n_words. Null and empty texts
    have no words and are clean; items without words find nothing; with no items all is clean.
    Repeated rows are judged alike; items that share an id are one item.
    """
    windows = staged(item_windows(items, window, item_id_col, item_text_col), "windows")
    pieces = staged(window_shingles(windows), "shingles")
    matches = staged(_corpus_matches(docs, id_col, text_col, pieces), "matches")
    places = matches.where("size > 0").select(*ROW_KEY, "n_words", "size", "pos", "shingle").distinct()
    rarity = matches.where("size > 0").groupBy("size", "shingle").agg(F.count(F.lit(1)).alias("n_found"))
    # a window with a shingle that never occurs cannot occur: its inner join leaves fewer shingles
    ranked = pieces.join(rarity, ["size", "shingle"]).groupBy("window_id").agg(
        F.min(F.struct("n_found", "offset", "shingle")).alias("first"), F.count(F.lit(1)).alias("n_known"),
        F.first("n").alias("n"), F.first("size").alias("size"),
    )
    prefix = ranked.where(F.col("n_known") == F.col("n") - F.col("size") + 1).select(
        "window_id", "n", "size", F.col("first.offset").alias("offset"), F.col("first.shingle").alias("shingle")
    )
    start = F.col("pos") - F.col("offset")
    candidates = (
        places.join(prefix, ["size", "shingle"])
        .where((start >= 0) & (start + F.col("n") <= F.col("n_words")))
        .select(*ROW_KEY, "window_id", "n", "size", start.alias("start"))
    )
    expected = candidates.join(pieces.select("window_id", "offset", "shingle"), "window_id").select(
        *ROW_KEY, "window_id", "n", "size", "start", (F.col("start") + F.col("offset")).alias("pos"), "shingle"
    )
    occurrences = staged(
        expected.join(places.drop("n_words"), [*ROW_KEY, "size", "pos", "shingle"])
        .groupBy(*ROW_KEY, "window_id", "start")
        .agg(F.first("n").alias("n"), F.first("size").alias("size"), F.count(F.lit(1)).alias("n_equal"))
        .where(F.col("n_equal") == F.col("n") - F.col("size") + 1),
        "occurrences",
    )
    hit = (
        occurrences.select(*ROW_KEY, F.explode(F.sequence(F.col("start"), F.col("start") + F.col("n") - 1)).alias("pos"))
        .distinct().groupBy(*ROW_KEY).agg(F.count(F.lit(1)).alias("n_hit"))
    )
    found = (
        occurrences.select(*ROW_KEY, "window_id").distinct().join(windows.select("window_id", "item"), "window_id")
        .groupBy(*ROW_KEY).agg(F.array_sort(F.collect_set("item")).alias("items"))
    )
    rows = matches.where("size = 0").select(*ROW_KEY, "doc", F.col("n_words").cast("long").alias("n_words"))
    joined = rows.join(hit.join(found, ROW_KEY), ROW_KEY, "left")
    n_hit = F.coalesce("n_hit", F.lit(0))
    return joined.select(
        *ROW_KEY, "doc", "n_words", n_hit.cast("long").alias("n_hit"),
        F.coalesce(F.size("items"), F.lit(0)).cast("long").alias("n_items"),
        F.coalesce("items", F.array().cast("array<string>")).alias("items"),
        ((n_hit > 0) & (share * n_hit >= F.col("n_words"))).alias("contaminated"),
    )


def drop_contaminated(docs: DataFrame, items: DataFrame, **options) -> DataFrame:
    """``docs`` without the contaminated rows; all columns as they were."""
    judged = contamination(docs, items, **options)
    bad = staged(judged.where("contaminated").select(*ROW_KEY).distinct(), "contaminated")
    hi, lo = row_key(options.get("id_col", "doc_id"), options.get("text_col", "text"))
    names = [fresh("key_hi", docs.columns), fresh("key_lo", docs.columns)]
    marked = docs.withColumn(names[0], hi).withColumn(names[1], lo)
    bad = bad.toDF(*names)
    n_bad = bad.count()
    return marked.join(F.broadcast(bad) if n_bad <= BROADCAST_ROWS else bad, names, "left_anti").select(
        *(F.col(f"`{c}`") for c in docs.columns)
    )
