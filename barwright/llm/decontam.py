"""Benchmark decontamination by winnowing.

Every run of ``gram`` words is hashed, and of each ``window - gram + 1`` neighbouring hashes the
smallest is a fingerprint. Two texts that share ``window`` words share those hashes and so their
smallest one: no shared span of that length is missed. Document fingerprints that a benchmark item
has too are extended to the windows around them, and these are compared word by word with the item's.
Items shorter than a window are looked up whole, by runs of their own length.

Fingerprints and windows of the items are broadcast only if they are counted to be few; else both
joins are shuffled, and only the ids of matching documents meet the texts again.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barwright.llm.common import word_array

WINDOW, GRAM = 10, 5
#: Most item windows that are broadcast (some 100 bytes each).
BROADCAST_WINDOWS = 200_000


def _places(words, width: int) -> Column:
    """0-based starts of all runs of ``width`` words."""
    last = F.size(words) - width
    return F.when(last >= 0, F.sequence(F.lit(0), F.greatest(last, F.lit(0)))).otherwise(F.array().cast("array<int>"))


def _runs(words, width: int, kind: int) -> Column:
    """Hashes of all runs of ``width`` words."""
    return F.transform(_places(words, width), lambda i: F.xxhash64(F.lit(kind), F.slice(words, i + 1, width)))


def _minima(grams, span: int) -> Column:
    """The smallest of each ``span`` neighbouring hashes."""
    return F.transform(_places(grams, span), lambda i: F.least(*[F.get(grams, i + k) for k in range(span)]))


def _text(words, start, width) -> Column:
    return F.array_join(F.slice(words, start + 1, width), " ")


def overlaps(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, gram: int = GRAM) -> DataFrame:
    """Per document: n_words, n_hit, n_items, items_sha256, contaminated, item_ids and text_key (xxhash64 of its text).

    Reads ``doc_id``, ``text`` of ``docs`` and ``item_id``, ``text`` of ``benchmark``; other columns are
    left alone. A word is hit if it lies in a run of ``window`` words that an item has too, or in a
    whole item of fewer words. Null and wordless texts have no words and no hit. A repeated row is
    returned as often as it comes; an item without id hits words but is not counted or named. An
    empty benchmark hits nothing, an empty table of documents gives an empty result. Texts of any length
    count whole.
    """
    span = window - gram + 1
    items = benchmark.select("item_id", word_array(F.col("text")).alias("words")).filter(F.size("words") > 0)
    words, mark, kind = F.col("words"), F.col("mark"), F.col("kind")
    width = F.least(F.size(words), F.lit(window))
    windows = (
        items.select("item_id", "words", width.alias("width"))
        .select("item_id", "width", "words", F.explode(F.sequence(F.lit(0), F.size(words) - F.col("width"))).alias("at"))
        .select("item_id", "width", _text(words, F.col("at"), F.col("width")).alias("run"), F.lit(True).alias("hit"))
        .distinct()
    )
    sizes = windows.groupBy("width").count().collect()  # a row per width, so at most ``window``
    short = sorted(r["width"] for r in sizes if r["width"] < window)
    few = sum(r["count"] for r in sizes) <= BROADCAST_WINDOWS
    known = F.broadcast if few else lambda df: df

    long_items = items.filter(F.size(words) >= window).select(_runs(words, gram, 0).alias("grams"))
    prints = long_items.select(F.explode(_minima(F.col("grams"), span)).alias("mark"), F.lit(0).alias("kind"))
    for n in short:
        whole = items.filter(F.size(words) == n)
        prints = prints.union(whole.select(F.xxhash64(F.lit(n), words), F.lit(n)))
    prints = prints.distinct()

    own = ["doc_id", "text_key", "n_words"]
    texts = docs.select("doc_id", F.xxhash64("text").alias("text_key"), word_array(F.col("text")).alias("words"))
    texts = texts.select("doc_id", "text_key", F.size(words).alias("n_words"), "words")
    marks = [_minima(F.col("grams"), span), *(_runs(words, n, n) for n in short)]
    marked = texts.select(*own, "words", _runs(words, gram, 0).alias("grams")).select(
        *own, "words", F.array_distinct(F.concat(*marks)).alias("marks")
    )
    nothing = F.array(F.lit(None).cast("bigint"))  # a null mark stands for the document itself
    if few:
        found = marked.select(*own, "words", F.explode(F.concat(nothing, "marks")).alias("mark"))
        found = found.join(known(prints), "mark", "left").filter(mark.isNull() | kind.isNotNull())
    else:
        met = marked.select("doc_id", "text_key", F.explode("marks").alias("mark")).join(prints, "mark").distinct()
        same = F.col("d.doc_id").eqNullSafe(F.col("m.doc_id")) & (F.col("d.text_key") == F.col("m.text_key"))
        once = texts.dropDuplicates(["doc_id", "text_key"])
        found = once.alias("d").join(met.alias("m"), same).select(*[f"d.{c}" for c in own], "words", "mark", "kind")
        found = found.unionByName(texts.select(*own), allowMissingColumns=True)

    around = F.flatten(F.transform(
        F.filter(_places(words, gram), lambda i: F.xxhash64(F.lit(0), F.slice(words, i + 1, gram)) == mark),
        lambda p: F.sequence(p - (span - 1), p),
    ))
    starts = F.filter(F.array_distinct(around), lambda s: (s >= 0) & (s <= F.size(words) - window))
    for n in short:
        alike = F.filter(_places(words, n), lambda i: F.xxhash64(F.lit(n), F.slice(words, i + 1, n)) == mark)
        starts = F.when(kind == n, alike).otherwise(starts)
    starts = F.when(mark.isNull(), F.array(F.lit(None).cast("int"))).otherwise(starts)
    near = found.select(*own, "words", F.when(kind == 0, window).otherwise(kind).alias("width"), F.explode(starts).alias("at"))
    near = near.select(*own, "at", "width", _text(words, F.col("at"), F.col("width")).alias("run"))
    placed = near.join(known(windows), ["run", "width"], "left").filter("at is null or hit")
    by_doc = placed.groupBy(*own).agg(
        F.count(F.when(F.col("at").isNull(), 1)).alias("copies"),
        F.collect_set(F.when(F.col("at").isNotNull(), F.struct("at", "width"))).alias("runs"),
        F.sort_array(F.collect_set(F.col("item_id").cast("string"))).alias("item_ids"),
    )
    covered = F.aggregate(
        F.sort_array("runs"),
        F.struct(F.lit(0).alias("n"), F.lit(0).alias("end")),
        lambda acc, r: F.struct(
            (acc["n"] + F.greatest(F.lit(0), r["at"] + r["width"] - F.greatest(acc["end"], r["at"]))).alias("n"),
            F.greatest(acc["end"], r["at"] + r["width"]).alias("end"),
        ),
        lambda acc: acc["n"],
    )
    return by_doc.select(
        "doc_id",
        F.col("n_words").cast("bigint").alias("n_words"),
        covered.cast("bigint").alias("n_hit"),
        F.size("item_ids").cast("bigint").alias("n_items"),
        F.sha2(F.array_join("item_ids", ","), 256).alias("items_sha256"),
        (F.size("runs") > 0).alias("contaminated"),
        "item_ids",
        "text_key",
        F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))).alias("copy"),
    ).drop("copy")


def without_overlaps(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """The documents that share no window with a benchmark item, with the columns of ``docs``.

    Every row is judged by its own text, whether its doc_id is null or shared.
    """
    hit = overlaps(docs, benchmark, **options).filter("contaminated")
    hit = hit.select(F.col("doc_id").alias("hit_id"), F.col("text_key").alias("hit_key")).distinct()
    same = docs["doc_id"].eqNullSafe(hit["hit_id"]) & (F.xxhash64(docs["text"]) == hit["hit_key"])
    return docs.join(hit, same, "left_anti")
