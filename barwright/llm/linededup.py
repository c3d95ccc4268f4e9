"""Line dedup over a corpus: a deletion-neighbourhood join on words.

Two lines are near if their words are equal, or if both have at least ``min_words`` words and one
inserted, deleted or replaced word turns one into the other. A line goes if an earlier line, by
(doc_id, line number), is near it. Words are runs of letters and digits in lower case.

1. Lines with equal words fold into one class, known by its earliest place.
2. One edit leaves the first or the last half of the words as it is. Only classes that share a half
   with another class can have a near one; the others drop out here, without any variants.
3. The rest emit all variants with one word deleted, as a hash keyed by the deleted place. Lines
   that give the same variant by deleting the same place are all within one replacement, so the
   earliest of them stands for the whole key and no pairs are made; a line that equals another one's
   variant is within one deletion. The work is linear in the variants, also for a template line
   that makes up a third of the corpus.
4. Every claimed pair is verified on the words: common head and tail cover all but one word.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from barwright.llm.common import discard, split_words, stage

MIN_WORDS = 8
#: Up to so many shared classes (8 bytes each) are broadcast; more meet the lines in a shuffle.
BROADCAST_CLASSES = 500_000
_PLACES = 2**31
_LAST = "1" + "0" * 28
_CLASS = ["c1", "c2", "n"]


def _order() -> Column:
    """(doc_id, line number) as one number; rows without doc_id come last."""
    packed = F.col("doc_id").cast("decimal(19,0)") * F.lit(_PLACES).cast("decimal(18,0)") + F.col("line_no")
    return F.coalesce(packed.cast("decimal(38,0)"), F.lit(_LAST).cast("decimal(38,0)"))


def _line_rows(docs: DataFrame) -> DataFrame:
    texts = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.xxhash64("text").alias("text_key"), "text")
    lines = texts.filter("text is not null").select(
        "doc_id", "text_key", F.posexplode(F.split("text", "\n")).alias("line_no", "line")
    )
    return lines.select("doc_id", "text_key", "line_no", split_words(F.lower("line")).alias("words"))


def _half(joined, n, side: str) -> Column:
    """Hash of the first or last half of what would be ``n`` words of a line."""
    head = F.floor(n / 2).cast("int")
    count = head if side == "head" else head - n
    return F.xxhash64(F.lit(side), n, F.call_function("substring_index", joined, F.lit(" "), count.cast("int")))


def _earliest(keyed: DataFrame) -> DataFrame:
    """Claims (order, c1, partner) from rows (h, len, pos, order, c1); pos is -1 for a whole line."""
    by_place = keyed.groupBy("h", "len", "pos").agg(F.min("order").alias("m"))
    whole, variant = F.col("pos") < 0, F.col("pos") >= 0
    by_text = by_place.groupBy("h", "len").agg(
        F.min(F.when(whole, F.col("m"))).alias("whole_m"), F.min(F.when(variant, F.col("m"))).alias("variant_m")
    )
    partner = F.when(whole, F.col("variant_m")).otherwise(F.least("m", "whole_m"))
    return (
        keyed.join(by_place.join(by_text, ["h", "len"]), ["h", "len", "pos"])
        .select("order", "c1", partner.alias("partner")).filter("partner < order").distinct()
    )


def _variants(shared: DataFrame) -> DataFrame:
    """(h, len, pos, order, c1): the hash of the whole words and of the words without each place."""
    words = shared.repartition("c1").select(
        "order", "c1", F.size("words").alias("n"), F.posexplode("words").alias("pos", "word")
    )
    words = words.select("*", F.xxhash64("word", "pos").alias("x"), F.xxhash64("word", F.col("pos") - 1).alias("y"))
    line = W.partitionBy("c1")
    head = line.orderBy("pos").rowsBetween(W.unboundedPreceding, -1)
    tail = line.orderBy(F.col("pos").desc()).rowsBetween(W.unboundedPreceding, -1)
    before = F.coalesce(F.bit_xor("x").over(head), F.lit(0))
    after = F.coalesce(F.bit_xor("y").over(tail), F.lit(0))
    scanned = words.select("order", "c1", "n", "pos", "x", before.alias("before"), after.alias("after"))
    without = scanned.select(F.col("before").bitwiseXOR(F.col("after")).alias("h"), (F.col("n") - 1).alias("len"), "pos", "order", "c1")
    whole = scanned.filter("pos = n - 1").select(
        F.col("before").bitwiseXOR(F.col("x")), "n", F.lit(-1), "order", "c1"
    )
    return without.union(whole)


def _common_head(a, b) -> Column:
    """How many words agree from the start."""
    differs = F.array_position(F.zip_with(a, b, lambda x, y: x.eqNullSafe(y)), False)
    return F.when(differs == 0, F.least(F.size(a), F.size(b))).otherwise(differs - 1)


def _within_one_edit(a, b) -> Column:
    agreeing = _common_head(a, b) + _common_head(F.reverse(a), F.reverse(b))
    return agreeing >= F.greatest(F.size(a), F.size(b)) - 1


def line_decisions(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """Per line: doc_id, text_key, line_no (from 0), n_words, kept, first_doc_id, first_line_no.

    The last two name the earliest near line of a line that goes. Reads ``doc_id`` and ``text`` only; lines
    end at line feeds. A line without words is kept, a null text has no lines, an empty one has one.
    Rows that share a doc_id tie: lines at the same place of theirs never remove each other. Rows
    without doc_id come after all others and tie among themselves; of their lines only those go that
    equal an earlier one. Lines of any length count whole. An empty table gives an empty result.
    """
    spark = docs.sparkSession
    n, joined = F.col("n"), F.col("joined")
    halves = [_half(joined, m, side) for m in (n, n - 1) for side in ("head", "tail")]
    lines = _line_rows(docs).select("doc_id", "text_key", "line_no", F.size("words").alias("n"), F.array_join("words", " ").alias("joined"))
    rows = lines.select(
        "doc_id", "text_key", "line_no", "n", F.xxhash64(joined).alias("c1"), F.xxhash64(F.lit(1), joined).alias("c2"),
        F.when(n >= min_words, F.array(*halves)).alias("halves"),
    )
    rows, rows_path = stage(rows, "lines")
    classes = rows.filter("n > 0").groupBy(*_CLASS).agg(F.min(_order()).alias("order"))
    classes, classes_path = stage(classes, "classes")

    # any member's halves will do: they are equal within a class
    halved = rows.filter("halves is not null").select("c1", F.explode("halves").alias("half"))
    shared_halves = (
        halved.groupBy("half").agg(F.min("c1").alias("a"), F.max("c1").alias("b")).filter("a < b").select("half")
    )
    shared = halved.join(shared_halves, "half", "left_semi").select("c1").distinct()
    shared, shared_path = stage(shared, "shared")
    few = shared.count() <= BROADCAST_CLASSES
    # the earliest line of each class brings the words; only documents that hold one are split again
    firsts, firsts_path = stage(classes.join(F.broadcast(shared) if few else shared, "c1", "left_semi"), "firsts")
    holders = firsts.select(F.floor(F.col("order") / F.lit(_PLACES).cast("decimal(10,0)")).cast("bigint").alias("doc_id")).distinct()
    held = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text").filter("doc_id is not null")
    held = held.join(F.broadcast(holders) if few else holders, "doc_id", "left_semi")
    texts = _line_rows(held).select("doc_id", "line_no", "words", F.array_join("words", " ").alias("joined"))
    texts = texts.select("words", F.size("words").alias("n"), F.xxhash64(joined).alias("c1"), F.xxhash64(F.lit(1), joined).alias("c2"), _order().alias("order"))
    texts = texts.join(F.broadcast(firsts) if few else firsts, [*_CLASS, "order"], "left_semi").dropDuplicates(["c1"]).select("order", "c1", "words")
    texts, texts_path = stage(texts, "texts")

    claims = _earliest(_variants(texts))
    near = (
        claims.join(texts.select("c1", F.col("words").alias("own_words")), "c1")
        .join(texts.select(F.col("order").alias("partner"), F.col("words").alias("other_words")), "partner")
        .filter(_within_one_edit(F.col("own_words"), F.col("other_words")))
        .groupBy("order", "c1").agg(F.min("partner").alias("partner"))
    )
    decided = classes.join(near, ["order", "c1"], "left").select(*_CLASS, "order", F.least("order", "partner").alias("first"))
    decided, _ = stage(decided, "decided")
    discard(spark, classes_path, shared_path, firsts_path, texts_path)

    own = _order()
    out = rows.join(decided, _CLASS, "left").select(
        "doc_id", "text_key", F.col("line_no").cast("bigint").alias("line_no"), F.col("n").cast("bigint").alias("n_words"),
        F.when(F.col("first") < own, F.col("first")).alias("first"),
    )
    first = F.col("first")
    line = F.pmod(first, F.lit(_PLACES).cast("decimal(38,0)"))
    return out.select(
        "doc_id", "text_key", "line_no", "n_words", first.isNull().alias("kept"),
        ((first - line) / F.lit(_PLACES).cast("decimal(10,0)")).cast("bigint").alias("first_doc_id"),
        line.cast("bigint").alias("first_line_no"),
    )


def without_repeated_lines(docs: DataFrame, **options) -> DataFrame:
    """The documents with the lines that line_decisions keeps, and the columns of ``docs``.

    A document that had words and keeps no line with words goes; all other rows stay, null and
    wordless texts as they are. ``n_chars``, if there, counts the new text.
    """
    decisions = line_decisions(docs, **options)
    gone = (
        decisions.groupBy("doc_id", "text_key").agg(
            F.collect_set(F.when(~F.col("kept"), F.col("line_no").cast("int"))).alias("gone"),
            F.max(F.col("kept") & (F.col("n_words") > 0)).alias("speaks"),
        )
        .filter(F.size("gone") > 0)
        .select(F.col("doc_id").alias("gone_id"), F.col("text_key").alias("gone_key"), "gone", "speaks")
    )
    same = docs["doc_id"].cast("bigint").eqNullSafe(gone["gone_id"]) & (F.xxhash64(docs["text"]) == gone["gone_key"])
    lines = F.split(docs["text"], "\n")
    stay = F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), gone["gone"])
    text = F.when(gone["gone"].isNull(), docs["text"]).otherwise(
        F.array_join(F.transform(stay, lambda i: F.get(lines, i)), "\n")
    )
    joined = docs.join(gone, same, "left").filter(gone["gone"].isNull() | gone["speaks"])
    new = {"text": text.alias("text")}
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        new["n_chars"] = F.when(gone["gone"].isNull(), docs["n_chars"]).otherwise(F.char_length(text).cast(kind)).alias("n_chars")
    return joined.select(*[new.get(c, docs[c]) for c in docs.columns])
